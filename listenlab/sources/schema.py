"""Declared schemas, column lists and the US state dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw play event, one JSON object per line. Declared so the reader skips the
# schema-inference pass and types do not depend on which files are present.
LISTEN_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("itemInSession", T.IntegerType()),
        T.StructField("auth", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("registration", T.LongType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("ts", T.LongType()),  # epoch milliseconds, UTC
    ]
)

RAW_COLUMNS = [f.name for f in LISTEN_SCHEMA.fields]

# Cleaned listen: the 19 raw columns with `level` renamed, then three date parts.
CLEAN_COLUMNS = [
    "userId", "lastName", "firstName", "gender", "song", "artist",
    "duration", "sessionId", "itemInSession", "auth", "subscription",
    "city", "state", "zip", "lat", "lon", "registration", "userAgent", "ts",
    "year", "month", "month_name",
]

NATIONWIDE = "Nationwide"

# --- fixed values -----------------------------------------------------------
# The 51 US states (50 states and the District of Columbia), full name and
# postal code, in the order the dashboard lists them. Map ties resolve by this
# order, so it is part of the result.
US_STATES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"), ("Idaho", "ID"), ("Illinois", "IL"),
    ("Indiana", "IN"), ("Iowa", "IA"), ("Kansas", "KS"), ("Kentucky", "KY"), ("Louisiana", "LA"),
    ("Maine", "ME"), ("Maryland", "MD"), ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"),
    ("Mississippi", "MS"), ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"),
    ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"), ("New York", "NY"), ("North Carolina", "NC"),
    ("North Dakota", "ND"), ("Ohio", "OH"), ("Oklahoma", "OK"), ("Oregon", "OR"), ("Pennsylvania", "PA"),
    ("Rhode Island", "RI"), ("South Carolina", "SC"), ("South Dakota", "SD"), ("Tennessee", "TN"),
    ("Texas", "TX"), ("Utah", "UT"), ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"),
    ("West Virginia", "WV"), ("Wisconsin", "WI"), ("Wyoming", "WY"), ("District of Columbia", "DC"),
]
# ---------------------------------------------------------------------------

STATE_CODES = [code for _, code in US_STATES]


def us_states(spark: SparkSession) -> DataFrame:
    """The state dimension as a 51-row DataFrame `(position, NAME, state)`."""
    rows = [(i, name, code) for i, (name, code) in enumerate(US_STATES, 1)]
    return spark.createDataFrame(rows, "position int, NAME string, state string")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def us_states_sql() -> str:
    """SQL text of the state dimension as a constant array of structs `(position, NAME, state)`."""
    items = ", ".join(
        f"named_struct('position', {i}, 'NAME', {_sql_str(name)}, 'state', {_sql_str(code)})"
        for i, (name, code) in enumerate(US_STATES, 1)
    )
    return f"array({items})"


def state_codes_sql() -> str:
    """SQL text of the 51 codes as an IN list body."""
    return ", ".join(_sql_str(c) for c in STATE_CODES)


def us_states_array() -> Column:
    """The state dimension as a constant array of structs `(position, NAME, state)`.

    A 51-element literal: exploding it next to a per-artist row gives the
    artist x state grid without a join. Built from SQL text (one parse instead
    of some two hundred column-building calls); Catalyst folds it to a constant.
    """
    return F.expr(us_states_sql())
