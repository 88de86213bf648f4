"""A session configured the way the library expects (bench, tests, local runs)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None, app: str = "listenlab") -> SparkSession:
    """Local session: UTC, AQE with skew-join splitting, no UI.

    On a cluster the same settings belong in the job's configuration; there
    `spark.sql.shuffle.partitions` should follow the data size (AQE coalesces
    small partitions, so err high) and `spark.checkpoint.dir` must name a
    shared folder.
    """
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LISTENLAB_DRIVER_MEMORY", "8g"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Configuration for a cluster run over `input_bytes` of listen data.

    - Scan splits of `partition_bytes / 2` give every core several tasks and
      keep one task's input bounded.
    - The initial shuffle width aims at about `partition_bytes` per partition
      for an input-sized shuffle, clamped to 2-20 partitions per core. Every
      map task writes one segment per partition and every reducer fetches one
      block per map task, so a wider setting costs more than it saves. The
      only input-sized shuffles are the derived view's joins; the operators
      shuffle map-side partial aggregates. AQE coalesces small shuffles down to
      the advisory size, splits skewed partitions of joins and rebalances, and
      converts joins to broadcasts when a side turns out small.
    - Pass the result to `SparkSession.builder.config(map=...)` together with a
      shared `spark.checkpoint.dir`.
    """
    shuffle = min(max(2 * total_cores, -(-input_bytes // partition_bytes)), 20 * total_cores)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
    }
