"""Sources and sinks: JSON events, cleaned Parquet, and the streaming ingest."""

from __future__ import annotations

import os
from collections import Counter

from pyspark.sql import functions as F

import listenlab as L
from listenlab.sources import files
from listenlab.sources.tables import listen_events
from listenlab.streaming import start_clean_ingest


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_json_round_trip(spark, sf_small, tmp_path):
    events = listen_events(spark, sf_small)
    path = str(tmp_path / "events")
    files.write_listens(events, path)
    back = files.read_listens(spark, path)
    assert back.schema == L.LISTEN_SCHEMA
    assert _rows(back) == _rows(events)


def _events(n):
    """Events with nulls, quotes, line breaks and other scripts, each third one twice."""
    rows = []
    for i in range(n):
        text = [None, "", 'a "b" \\ c', "line\nbreak", "café 東京 \U0001f600", f"song {i * 7919 % 10007}"][i % 6]
        number = None if i % 5 == 0 else i
        row = (number, text, "x", "F", text, text, i / 7, i, i % 9, "Logged In", "free", text, None, "00123", 1.5, -2.5, number, "agent", number)
        rows += [row] * (2 if i % 3 == 0 else 1)
    return rows


def test_events_are_written_compressed_and_read_back_whole(spark, tmp_path):
    rows = _events(3_000)
    events = spark.createDataFrame(rows, L.LISTEN_SCHEMA).repartition(2)
    plain, path = str(tmp_path / "plain"), str(tmp_path / "events")
    events.write.json(plain)
    files.write_listens(events, path)

    def size(d):
        return sum(os.path.getsize(os.path.join(d, f)) for f in os.listdir(d) if f.startswith("part-"))

    assert size(path) * 3 < size(plain)
    assert _rows(files.read_listens(spark, path)) == Counter(rows)
    assert _rows(files.read_listens(spark, path, exact_types=True)) == Counter(rows)
    assert files.rejected(files.read_raw_listens(spark, path)).collect() == []


def test_no_event_file_holds_more_than_its_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "EVENTS_PER_FILE", 100, raising=False)
    rows, path = _events(600), str(tmp_path / "events")
    files.write_listens(spark.createDataFrame(rows, L.LISTEN_SCHEMA).coalesce(1), path)
    per_file = [r["count"] for r in files.read_listens(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == len(rows) and max(per_file) <= 100
    assert _rows(files.read_listens(spark, path)) == Counter(rows)


def test_clean_parquet_round_trip(spark, sf_small, tmp_path):
    clean = L.clean_listens(listen_events(spark, sf_small))
    path = str(tmp_path / "clean")
    files.write_clean(clean, path)
    years = sorted(d for d in os.listdir(path) if d.startswith("year="))
    assert years and all(any(m.startswith("month=") for m in os.listdir(os.path.join(path, y))) for y in years)
    # the rebalance leaves one file per month here (no month exceeds the advisory partition size)
    for y in years:
        for m in os.listdir(os.path.join(path, y)):
            parts = [f for f in os.listdir(os.path.join(path, y, m)) if f.endswith(".parquet")]
            assert len(parts) == 1, (y, m, parts)
    # each file is ordered by state then artist (NULLs first), so row-group statistics are narrow
    import pyarrow.parquet as pq

    def key(r):
        return (r["state"] is not None, r["state"] or "", r["artist"] is not None, r["artist"] or "")

    for y in years:
        for m in os.listdir(os.path.join(path, y)):
            for f in os.listdir(os.path.join(path, y, m)):
                if f.endswith(".parquet"):
                    t = pq.ParquetFile(os.path.join(path, y, m, f)).read(columns=["state", "artist"]).to_pylist()
                    assert [key(r) for r in t] == sorted(key(r) for r in t)
    back = files.read_clean(spark, path)
    assert back.columns == L.CLEAN_COLUMNS
    assert _rows(back) == _rows(clean.select(*L.CLEAN_COLUMNS))


def test_shared_dir_comes_from_session(spark):
    d = files.shared_dir(spark)
    assert d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        assert d == conf
    assert files.new_output_path(spark, "x") != files.new_output_path(spark, "x")


def test_streaming_ingest_exactly_once(spark, sf_small, tmp_path):
    events = listen_events(spark, sf_small).orderBy("sessionId", "itemInSession")
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    first = events.where(F.col("sessionId") % 2 == 0)
    second = events.where(F.col("sessionId") % 2 == 1)
    files.write_listens(first, src + "/batch1")
    os.makedirs(src, exist_ok=True)

    q = start_clean_ingest(spark, src + "/*", sink, ckpt)
    q.awaitTermination(120)
    assert _rows(files.read_clean(spark, sink)) == _rows(L.clean_listens(first).select(*L.CLEAN_COLUMNS))

    # new files arrive; a restarted query picks up only those
    files.write_listens(second, src + "/batch2")
    q = start_clean_ingest(spark, src + "/*", sink, ckpt)
    q.awaitTermination(120)
    assert _rows(files.read_clean(spark, sink)) == _rows(L.clean_listens(events).select(*L.CLEAN_COLUMNS))


def test_cluster_settings_scale_with_input():
    from listenlab.session import cluster_settings

    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 20 * 8000  # clamped below 409,600
    mid = cluster_settings(1 << 40, 8000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 16000  # 2 per core floor (1 TiB / 256 MiB = 4096)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_jobs_ingest_and_publish(spark, sf_small, tmp_path):
    from listenlab import jobs

    src, clean, out = (str(tmp_path / n) for n in ("json", "clean", "tables"))
    files.write_listens(listen_events(spark, sf_small), src)
    stored, n_rejects = jobs.ingest_json(spark, src, clean, clean + "_rejects")
    assert n_rejects == 0
    # JSON written from the fixture, read, cleaned and stored equals the cleaned fixture rows, in both modes
    expect = _rows(L.clean_listens(listen_events(spark, sf_small)).select(*L.CLEAN_COLUMNS))
    assert _rows(stored) == expect
    assert _rows(jobs.ingest_json(spark, src, clean + "_compat", clean + "_rejects", mode="compat", time_ordered=True)[0]) == _rows(
        L.clean_listens(listen_events(spark, sf_small), mode="compat").select(*L.CLEAN_COLUMNS)
    )
    written = jobs.publish_dashboard_tables(spark, clean, out)
    assert set(written) == set(jobs.DASHBOARD_TABLES)
    top = spark.read.parquet(written["top_artists"])
    assert _rows(top) == _rows(L.top_artists_all(L.clean_listens(listen_events(spark, sf_small))))
    # every table equals its operator over the listens themselves
    for name, build in jobs.DASHBOARD_TABLES.items():
        assert _rows(spark.read.parquet(written[name])) == _rows(build(stored)), name


def test_write_clean_without_rebalance(spark, sf_small, tmp_path):
    clean = L.clean_listens(listen_events(spark, sf_small))
    path = str(tmp_path / "clean_nr")
    files.write_clean(clean, path, rebalance=False)
    assert _rows(files.read_clean(spark, path)) == _rows(clean.select(*L.CLEAN_COLUMNS))


def test_read_listens_keeps_quoted_numbers(spark, tmp_path):
    path = tmp_path / "quoted"
    path.mkdir()
    (path / "a.json").write_text(
        '{"userId": 12, "duration": 60.5, "ts": 1704067200000, "level": "paid"}\n'
        '{"userId": "13", "duration": "30", "ts": "1704067200001", "level": "free"}\n'
        '{"userId": "", "duration": "n/a", "ts": 1704067200002, "level": "free", "registration": 1.538173362E12}\n'
    )
    df = files.read_listens(spark, str(path))
    assert df.schema == L.LISTEN_SCHEMA
    got = sorted((r.ts, r.userId, r.duration) for r in df.collect())
    assert got == [(1704067200000, 12, 60.5), (1704067200001, 13, 30.0), (1704067200002, None, None)]
    assert sorted(r.registration for r in df.collect() if r.registration is not None) == [1538173362000]
    exact = files.read_listens(spark, str(path), exact_types=True).collect()
    assert sum(r.userId is None for r in exact) == 2  # the JSON-number reader loses the quoted "13" too


def test_shared_dir_refuses_local_folder_on_a_cluster():
    import pytest as _pytest

    class _Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class _Session:
        conf = _Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with _pytest.raises(ValueError, match="shared by the cluster"):
        files.shared_dir(_Session())


LINES = """{"userId": "13", "artist": "A", "song": "s", "level": "free", "duration": 60, "ts": 1538173362000}
{"userId": 13.0, "artist": "A", "song": "s", "level": "free", "duration": "60.5", "ts": 1538173362000.5}
{"userId": 13.5, "artist": "A", "song": "s", "level": "free", "duration": 60, "ts": 1.538173362E12}
{"userId": "", "artist": "A", "song": "s", "level": "free", "duration": 60, "ts": 9000000000000000000}
{"userId": 14, "artist": "A", "song": "s", "level": "paid", "duration": 60, "ts": 10000000000000000}
{"userId": 15, "artist": "A", "ts": 15381733
not json
"""


def test_ingest_of_bad_lines(spark, tmp_path):
    from listenlab import jobs

    src = tmp_path / "json"
    src.mkdir()
    (src / "events.json").write_text(LINES)
    stored, n_rejects = jobs.ingest_json(spark, str(src), str(tmp_path / "clean"), str(tmp_path / "rejects"))
    assert n_rejects == 2
    rejects = spark.read.parquet(str(tmp_path / "rejects"))
    assert {r[files.CORRUPT] for r in rejects.collect()} == set(LINES.splitlines()[5:7])
    assert all(r.file.endswith("events.json") for r in rejects.collect())
    got = Counter((r.userId, r.duration, str(r.ts), r.month_name) for r in stored.collect())
    at = "2018-09-28 22:22:42"
    assert got == Counter(
        [(13, 60.0, at, "September"), (13, 60.5, at, "September"), (None, 60.0, at, "September"), (None, 60.0, "None", None), (14, 60.0, "None", None)]
    )
    assert L.kpis(stored).first().total_users == 3


def test_batch_does_not_write_into_a_stream_folder(spark, tmp_path):
    import pytest

    (tmp_path / "sink" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="streaming ingest"):
        files.write_clean(L.clean_listens(spark.createDataFrame([], L.LISTEN_SCHEMA)), str(tmp_path / "sink"))
