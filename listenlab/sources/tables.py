"""Listen events derived from the driver's star-schema tables.

One listen per `lineitem` row: the order is the session, the customer the
user, the part the song and its brand the artist, the customer's nation the
city and (for 23 nations) the US state. The shape follows the test fixture so
that the same rows can be produced by an independent SQL engine.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import mis_encode
from .schema import RAW_COLUMNS

# --- fixed values -----------------------------------------------------------
# Nation key -> US state code used by the fixture; nations 23 and 24 have none
# here (nation 24 is later given "PR", a code outside the 51 states).
NATION_STATE_CODES = [
    (0, "AL"), (1, "AK"), (2, "AZ"), (3, "AR"), (4, "CA"), (5, "CO"), (6, "CT"), (7, "DE"),
    (8, "FL"), (9, "GA"), (10, "HI"), (11, "ID"), (12, "IL"), (13, "IN"), (14, "IA"), (15, "KS"),
    (16, "KY"), (17, "LA"), (18, "ME"), (19, "MD"), (20, "MA"), (21, "MI"), (22, "MN"),
]
NULL_USER_CUSTKEY = 7
NULL_ARTIST_BRAND = "Brand#25"
OUTSIDE_STATES_NATION = 24
OUTSIDE_STATES_CODE = "PR"
# Orders whose key is a multiple of it have no date here.
UNDATED_ORDERS = 97
# Added to every song, so that cleaning has text to repair.
SONG_SUFFIX = " ü"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_millis_utc(ntz):
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC wall-clock time.

    A difference of two zone-less timestamps, so it does not depend on the
    session time zone.
    """
    return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ntz)


def listens_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned listens over the driver tables (all 22 clean columns plus `ts_ms`)."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    codes = spark.createDataFrame(NATION_STATE_CODES, "idx int, code string")

    # lineitem x orders is the large equi-join (sort-merge on the order key);
    # customer and part are left to Spark's size-checked automatic broadcast,
    # which falls back to a shuffle join when they outgrow the threshold. The
    # nation table and the 23-row code list have a fixed size: broadcast.
    j = (
        l.join(o, l.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .join(p, l.l_partkey == p.p_partkey)
        .join(F.broadcast(codes), codes.idx == c.c_nationkey, "left")
    )
    orderdate = F.when(F.col("o_orderkey") % UNDATED_ORDERS != 0, F.col("o_orderdate"))
    return j.select(
        F.nullif(F.col("o_custkey"), F.lit(NULL_USER_CUSTKEY)).alias("userId"),
        F.col("c_name").alias("lastName"),
        F.col("c_mktsegment").alias("firstName"),
        F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat("p_name", F.lit(SONG_SUFFIX)).alias("song"),
        F.nullif(F.col("p_brand"), F.lit(NULL_ARTIST_BRAND)).alias("artist"),
        F.col("l_quantity").alias("duration"),
        F.col("o_orderkey").alias("sessionId"),
        F.col("l_linenumber").alias("itemInSession"),
        F.lit("Logged In").alias("auth"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 10 == 0), "paid")
        .otherwise("free")
        .alias("subscription"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_nationkey") == OUTSIDE_STATES_NATION, F.lit(OUTSIDE_STATES_CODE))
        .otherwise(F.col("code"))
        .alias("state"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip"),
        F.col("c_nationkey").cast("double").alias("lat"),
        (-F.col("c_nationkey")).cast("double").alias("lon"),
        F.col("o_custkey").alias("registration"),
        F.lit("fixture").alias("userAgent"),
        _epoch_millis_utc(orderdate).alias("ts_ms"),
        orderdate.alias("ts"),
        F.year(orderdate).alias("year"),
        F.month(orderdate).alias("month"),
        F.date_format(orderdate, "MMMM").alias("month_name"),
    )


# A handle of a derived frame is its logical plan, whose joins and columns take a few hundred milliseconds to analyse.
# Every query still reads and joins the tables when it runs.
@lru_cache(maxsize=8)
def listen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw play events (the JSON shape): `level` for subscription, `ts` in epoch ms, `song` mis-encoded 0, 1 or 2 times."""
    v = listens_view(spark, sf_dir)
    song, layers = F.col("song"), F.col("sessionId") % 3
    v = v.withColumn("song", F.when(layers == 0, song).when(layers == 1, mis_encode(song)).otherwise(mis_encode(song, 2)))
    return v.select(
        *[
            F.col("subscription").alias("level") if name == "level"
            else F.col("ts_ms").alias("ts") if name == "ts"
            else F.col(name)
            for name in RAW_COLUMNS
        ]
    )


@lru_cache(maxsize=8)
def listens(spark: SparkSession, sf_dir: str, mode: str = "strict") -> DataFrame:
    """Raw events from the driver tables, passed through `clean_listens`."""
    from ..operators.clean import clean_listens

    return clean_listens(listen_events(spark, sf_dir), mode=mode)
