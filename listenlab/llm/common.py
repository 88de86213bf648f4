"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import new_output_path

# The white space of every contract, [\x20\x09-\x0D].
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: A word: a run of anything that is not white space.
WORD = f"[^{SPACE_CLASS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet under the shared folder and read it back: cuts the lineage durably.

    The folder is in the one that the cluster names in `spark.checkpoint.dir`. It
    goes when the driver's JVM exits; results still being read are never removed.
    """
    path = new_output_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text, as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text, as a long; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context, as `--py-files` would.

    Operators with Python tasks call it, so that they also run where the package is only on the driver's path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_listenlab_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    own = tempfile.mkdtemp(dir=sc._temp_dir)  # the driver serves the file from here until the context stops
    copy = os.path.join(own, "src", os.path.basename(package))
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(own, "listenlab-package"), "zip", os.path.join(own, "src")))
    sc._listenlab_shipped = True


def hash_sample(df: DataFrame, rows: int, *key: str, seed: int = 0) -> DataFrame:
    """The `rows` rows of `df` with the smallest hashes of `key` (all, if fewer), alike at every run.

    Rows that cannot be among them go first, by a bound on the hash, so that no task sends more than its share.
    """
    n, unit = df.count(), 1 << 30
    chance = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(unit))
    near = df.filter(chance < unit * 2 * rows // n) if n > 2 * rows else df
    return near.orderBy(chance, *key).limit(rows)


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that what a task builds for a batch of texts stays small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def portions(texts: list[str | None], chars: int) -> Iterator[list[str | None]]:
    """The same texts, in lists of up to `chars` characters or of one longer text."""
    part, n = [], 0
    for t in texts:
        if part and n + len(t or "") > chars:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t or "")
    if part:
        yield part


class BoundedCache(dict):
    """What `make` gives for a text, for at most 2 * `most` texts of up to `longest` characters.

    Entries live in two generations. When the young one is full it becomes the old one, whose entries come back as
    they are asked for, so frequent texts stay. Forgetting only costs time.
    """

    def __init__(self, make: Callable[[str], object], most: int, longest: int = 64):
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, text: str):
        value = self.old.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[text] = value
        return value


_held: dict[Hashable, object] = {}


def held(key: Hashable, build: Callable[[], object]):
    """One object that a Python worker keeps between tasks, until another is asked for: workers outlive operators."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]
