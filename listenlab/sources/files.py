"""File sources and sinks: raw JSON events in, cleaned Parquet out and back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import CLEAN_COLUMNS, LISTEN_SCHEMA, RAW_COLUMNS


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session without one (a test) gets a local folder,
    registered as the checkpoint directory; on a cluster the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            d = None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            # A machine-local folder is invisible to executors on other hosts.
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="listenlab-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # Spark Connect: nothing to register
            pass
    return d


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared directory. It goes when the driver's JVM exits."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    path = f"{base}{sep}listenlab/{name}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    return path


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that no DataFrame reads any more."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def text_schema() -> T.StructType:
    """The event schema with every non-text field read as text (see `typed_listens`)."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in LISTEN_SCHEMA.fields])


def typed_listens(raw_text: DataFrame) -> DataFrame:
    """Cast events read with `text_schema` to the declared types; unparsable values become NULL.

    Event logs often quote numbers ("userId": "13") or leave them empty
    ("userId": ""). Read straight into a long column, Spark's JSON parser turns
    such a value into NULL and keeps the rest of the row, so every quoted user
    id would be lost. Read as text, a quoted or bare number survives the cast
    with the same value, and only text that is not a number becomes NULL.

    `ts` may carry a fraction of a millisecond, which is cut off. Ids and
    counts must be whole (`13.0` is, `13.5` becomes NULL).
    """
    return raw_text.select(*[_typed(f).alias(f.name) for f in LISTEN_SCHEMA.fields])


def _typed(f: T.StructField):
    c = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return c
    if isinstance(f.dataType, (T.LongType, T.IntegerType)):
        # Integral fields also accept a number written with a fraction or
        # exponent ("1.538173362E12"), which the integral cast alone rejects.
        d = c.try_cast("double")
        usable = F.lit(True) if f.name == "ts" else d == F.floor(d)
        return F.coalesce(c.try_cast(f.dataType), F.when(usable, d.try_cast(f.dataType)))
    return c.try_cast(f.dataType)


#: Where the reader keeps the text of a line that is no JSON object of events.
CORRUPT = "_corrupt_record"


def read_raw_listens(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with every field as text, and a malformed line's text in `_corrupt_record`."""
    schema = T.StructType([*text_schema().fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def accepted(raw: DataFrame) -> DataFrame:
    """The events among raw lines, typed."""
    return typed_listens(raw.where(F.col(CORRUPT).isNull()))


def rejected(raw: DataFrame) -> DataFrame:
    """The malformed lines, with the fields that could still be read."""
    return raw.where(F.col(CORRUPT).isNotNull())


def read_listens(spark: SparkSession, path: str, exact_types: bool = False) -> DataFrame:
    """Read a directory of JSON-lines play events into the declared schema.

    Declared, so there is no inference pass. By default numeric fields are
    read as text and cast (`typed_listens`), which keeps quoted numbers;
    `exact_types=True` reads them as JSON numbers only. A malformed line is a
    row of NULLs here, as it is with an inferred schema; `read_raw_listens`
    tells such lines apart.
    """
    if exact_types:
        return spark.read.schema(LISTEN_SCHEMA).json(path)
    return typed_listens(spark.read.schema(text_schema()).json(path))


#: Events in one file of `write_listens`. One task reads a whole gzip file, so this bounds its work.
EVENTS_PER_FILE = 1_000_000


def write_listens(events: DataFrame, path: str) -> None:
    """Write raw play events as JSON lines (the ingest format), compressed with gzip.

    As plain text every line repeats the 19 field names, which are more than
    half of it. Readers of JSON lines know a `.json.gz` file by its name. The
    fastest level costs no more time than writing the plain text.
    """
    (
        events.select(*RAW_COLUMNS)
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", EVENTS_PER_FILE)
        .json(path)
    )


def _refuse_stream_folder(spark: SparkSession, path: str) -> None:
    """A stream's sink lists its files in a log; files written beside it would never be read."""
    fs, log = _file_system(spark, f"{path.rstrip('/')}/_spark_metadata")
    if fs.exists(log):
        raise ValueError(f"{path} belongs to a streaming ingest; write batches to a folder of their own")


def write_clean(clean: DataFrame, path: str, rebalance: bool = True) -> None:
    """Store cleaned listens as Parquet partitioned by `year, month`.

    Later reads prune partitions on date filters and get vectorised,
    column-pruned scans instead of re-parsing JSON and re-running the repair.

    Rows are rebalanced by `(year, month)` first. Writing straight from the
    input partitions would leave one file per month in every task (tasks x
    months small files when the input is not time-ordered); a plain hash
    repartition on the month would send a whole month to one task. The
    rebalance lets AQE split a large month into advisory-size partitions and
    merge small ones, so each task writes about one file of a useful size.

    The rebalance is one shuffle of the cleaned rows. For input already in
    time order (event logs written as they arrive), each task holds one or two
    months, and `rebalance=False` gives nearly the same layout without it.

    Inside each task rows are sorted by `year, month, state, artist`. The
    writer needs the partition columns first anyway, and the extra keys
    cluster each file so that row-group statistics let a `state = ...` or
    `artist = ...` filter skip most of a month's row groups.
    """
    _refuse_stream_folder(clean.sparkSession, path)
    rows = clean.select(*CLEAN_COLUMNS)
    if rebalance:
        rows = rows.hint("rebalance", "year", "month")
    (
        rows.sortWithinPartitions("year", "month", "state", "artist")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read cleaned listens written by `write_clean`, in the declared column order."""
    return spark.read.option("basePath", path).parquet(path).select(*CLEAN_COLUMNS)
