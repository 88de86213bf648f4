"""Batch jobs for a cluster: ingest raw events once, then publish every dashboard table.

The dashboard re-ran a query for each selection and kept the result in process.
Here every selection is answered ahead of time: one table per question, with a
`location` (or `artist`) column covering all selections, written next to the
cleaned data. A page then reads one small table instead of querying the listens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import counts, kpis, maps, mix, monthly, summaries
from .operators.clean import clean_listens
from .plans.pre_aggregated import plays, usage
from .sources.files import accepted, new_output_path, read_clean, read_raw_listens, rejected, remove, write_clean

# Table name -> operator over one of the two pre-aggregated tables. Each covers every location or artist.
FROM_PLAYS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "top_artists": counts.top_artists_all,
    "bottom_artists": counts.bottom_artists,
    "bottom_artists_prompt": lambda d: summaries.bottom_artists_prompt(counts.bottom_artists(d)),
    "top_songs": counts.top_songs_all,
    "state_map": maps.state_map_all,
    "map_summary": lambda d: summaries.map_summary_prompt(maps.map_stats_all(d), "Nationwide"),
    "qa_context": lambda d: summaries.qa_context(counts.artist_state_listens_all(d)),
}
FROM_USAGE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "subscription_mix": mix.subscription_mix_all,
    "kpis": lambda d: kpis.kpi_cards(kpis.kpis(d)),
    "monthly_listening": monthly.monthly_listening_all,
    "monthly_summary": lambda d: summaries.monthly_summary_prompt(monthly.monthly_seconds_all(d)),
    "monthly_table_prompt": lambda d: summaries.table_prompt(monthly.monthly_listening_all(d)),
    "states": counts.states_list,
}
DASHBOARD_TABLES = {**FROM_PLAYS, **FROM_USAGE}


def ingest_json(
    spark: SparkSession,
    json_dir: str,
    clean_dir: str,
    rejects_dir: str,
    mode: str = "strict",
    time_ordered: bool = False,
) -> tuple[DataFrame, int]:
    """Read raw JSON events, clean them, store them (`write_clean`); return the stored table and the number of rejects.

    Malformed lines go to `rejects_dir` as text, with their file, instead of
    counting as listens without user, artist or time.

    `time_ordered=True` skips the rebalance shuffle for event logs written in
    arrival order (each input split then spans one or two months).
    """
    raw = read_raw_listens(spark, json_dir)
    rejected(raw.withColumn("file", F.col("_metadata.file_path"))).write.mode("overwrite").parquet(rejects_dir)
    write_clean(clean_listens(accepted(raw), mode=mode), clean_dir, rebalance=not time_ordered)
    return read_clean(spark, clean_dir), spark.read.parquet(rejects_dir).count()


def publish_dashboard_tables(spark: SparkSession, clean_dir: str, out_dir: str) -> dict[str, str]:
    """Write every dashboard table as Parquet under `out_dir`; return name -> path.

    The listens are read twice, for `plays` and `usage`; both sums are written
    to the shared folder, and every table is a job over one of them. Most
    results are bounded by locations, months and k; the state maps and question
    contexts grow with the number of artists.
    """
    listens = read_clean(spark, clean_dir)
    sep = "" if out_dir.endswith("/") else "/"
    written = {}
    for base, tables in ((plays, FROM_PLAYS), (usage, FROM_USAGE)):
        folder = new_output_path(spark, base.__name__)
        base(listens).write.parquet(folder)
        rows = spark.read.parquet(folder)
        for name, build in tables.items():
            written[name] = f"{out_dir}{sep}{name}"
            build(rows).write.mode("overwrite").parquet(written[name])
        remove(spark, folder)
    return written
