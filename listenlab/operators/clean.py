"""Cleaning: raw play events to the cleaned listen table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import repair_columns
from ..sources.schema import RAW_COLUMNS

_MS_PER_DAY = 86_400_000
# Epoch milliseconds of the years 1 to 9999, the range of Spark's calendar functions.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999

# --- fixed values -----------------------------------------------------------
# Full English month names (the 'MMMM' date pattern), January first.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
# ---------------------------------------------------------------------------


def clean_listens(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """Repair `artist`/`song`, keep the 19 event columns (`level` -> `subscription`),
    turn epoch milliseconds into a timestamp and add `year`, `month`, `month_name`.

    Projections of built-in expressions: filters on the result still reach the
    scan, and no Python worker is involved. Date parts are taken from the UTC
    calendar day of the epoch value, so they do not move with the session time
    zone; the month name is a lookup by month number (the same text as
    `date_format(..., 'MMMM')`, without a formatter call per row).

    An event without a usable `ts` (NULL, or outside the years 1 to 9999) has
    NULL for `ts` and all three date parts; one bad value never ends the job.
    """
    fixed = repair_columns(raw, ["song", "artist"], mode)
    given = F.col("ts").try_cast("bigint")
    ms = F.when(given.between(FIRST_MS, LAST_MS), given)
    day = F.date_from_unix_date(F.floor(ms / F.lit(_MS_PER_DAY)).cast("int"))
    month = F.month(day)
    # Guarded: a lookup at a NULL index must not depend on how the expression is run.
    name = F.when(month.isNotNull(), F.element_at(F.array(*map(F.lit, MONTH_NAMES)), F.coalesce(month, F.lit(1))))
    changed = {"level": F.col("level").alias("subscription"), "ts": F.timestamp_millis(ms).alias("ts")}
    kept = [changed.get(c, F.col(c)) for c in RAW_COLUMNS]
    return fixed.select(*kept, F.year(day).alias("year"), month.alias("month"), name.alias("month_name"))
