"""Clean play events as they land, into Parquet partitioned like `write_clean`'s.

The sink folder is the stream's own: its log lists the files to read, so a
batch must not write there (`write_clean` refuses). Read both folders and
union them where batch and stream go together.

The dashboard's input is a folder of JSON event files that keeps growing. A
file-source stream reads each new batch of files like `read_listens` does
(numeric fields as text, cast to the declared types), runs `clean_listens`
and appends to Parquet partitioned by `year, month`. The checkpoint records
which files are done, so a restarted or failed query resumes without
reprocessing or losing files; on a cluster it must live on shared storage,
like `spark.checkpoint.dir`. `availableNow` processes what is there and stops
(a scheduled job); omit it for an always-on query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_listens
from ..sources.files import text_schema, typed_listens
from ..sources.schema import CLEAN_COLUMNS


def start_clean_ingest(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    mode: str = "strict",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    reader = spark.readStream.schema(text_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    clean = clean_listens(typed_listens(reader.json(source_dir)), mode=mode).select(*CLEAN_COLUMNS)
    writer = (
        clean.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy("year", "month")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
