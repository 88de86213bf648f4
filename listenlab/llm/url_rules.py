"""URL filter rules by a sort-merge range join.

A rule (verdict, host, path) fits a url whose host is the rule's host or one
of its subdomains and whose path starts with the rule's path. The longest
fitting rule (host and path together, then the longer host) decides; of rules
with equal host and path, `block` wins. A url that no rule fits is allowed.

The canonical key of a host is its labels in reverse, each followed by a dot:
`www.example.com` becomes `com.example.www.`. A rule's host then covers the
interval of keys that start with its key. Pages and rules are sorted by key
together; a sweep keeps the stack of the rules whose interval holds the current
key (intervals nest or are disjoint, so closing rules are always on top).

How it runs: splitters cut the order of (key, salt) into ranges. They come from
a bounded sample (`SPLITTER_SAMPLE` rows with the smallest hashes) and decide
only which task sees a row. The salt, a hash of the row, lets one hot host span
many ranges; a rule goes to every range that its interval meets. Pages are
exchanged once; nothing is broadcast that grows with the pages.

Defined results: null urls and urls without `://` have an empty host and path,
which no rule fits. Rules with a null or empty host or a null path are ignored.
Repeated rows are judged one by one. Empty tables give empty results. Extra
columns of `pages` do not take part; `keep` names those to return, which come
first, and host, path, rule, verdict replace columns of the same name.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_sample, ship

SPLITTER_SAMPLE = 16_384
MAX_RANGES = 4096
ROWS_PER_RANGE = 50_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host up to the first of / ? #, A-Z lower-cased; the path up to ? or #."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:stop]


def host_key(host: str) -> str:
    return "".join(f"{label}." for label in reversed(host.split("."))) if host else ""


def key_end(key: str) -> str:
    """The first key after all that start with `key`, which ends in a dot."""
    return key[:-1] + chr(ord(".") + 1)


class Sweep:
    """The stack of active rules while keys arrive in ascending order."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, str], list[int]]] = []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, verdict: str) -> None:
        self._close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        if len(path) not in lengths:
            bisect.insort(lengths, len(path))
        if paths.get(path) != "block":
            paths[path] = verdict

    def judge(self, key: str, path: str) -> tuple[str, str, str] | None:
        """The key, path and verdict of the longest rule that fits."""
        self._close(key)
        best, size = None, (-1, -1)
        for at, paths, lengths in self.stack:
            for n in reversed(lengths):
                if n <= len(path) and path[:n] in paths:
                    if (len(at) + n, len(at)) > size:
                        best, size = (at, path[:n], paths[path[:n]]), (len(at) + n, len(at))
                    break
        return best



def apply_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """`keep` columns of every row of `pages`, with host, path, rule and verdict.

    `rules` has the columns verdict (allow or block), host and path.
    """
    spark = pages.sparkSession
    ship(spark)
    src = pages.select(*keep, F.col(url_col).alias("__url"), F.xxhash64(url_col, *keep).alias("__salt"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(MAX_RANGES, max(4 * parts, pages.count() // ROWS_PER_RANGE)))
    sample = hash_sample(src.select("__url", "__salt"), SPLITTER_SAMPLE, "__salt", "__url").collect()
    spread = [(host_key(split_url(u)[0]), xxhash.xxh64_intdigest(str(s)) >> 1) for u, s in sample]
    spread.sort()
    splitters = sorted({spread[i * len(spread) // n] for i in range(1, n)}) if spread else []

    carried = [f for f in src.schema.fields if f.name in keep]
    fields = [("__range", T.IntegerType()), ("__key", T.StringType()), ("__kind", T.IntegerType()), ("__host", T.StringType()), ("__path", T.StringType()), ("__verdict", T.StringType())]
    mid = T.StructType([*(T.StructField(f.name, f.dataType) for f in carried), *(T.StructField(*f) for f in fields)])

    def place_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys, hosts, paths = [], [], [], []
            for url, salt in zip(b.column(len(keep)).to_pylist(), b.column(len(keep) + 1).to_pylist(), strict=True):
                host, path = split_url(url)
                key = host_key(host)
                at.append(bisect.bisect_right(splitters, (key, xxhash.xxh64_intdigest(str(salt)) >> 1)))
                keys.append(key)
                hosts.append(host)
                paths.append(path)
            text, one = pa.string(), [1] * b.num_rows
            cols = [pa.array(at, pa.int32()), pa.array(keys, text), pa.array(one, pa.int32()), pa.array(hosts, text), pa.array(paths, text), pa.nulls(b.num_rows, text)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + cols, names=mid.names)

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for verdict, host, path in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if host and path is not None and verdict in ("allow", "block"):
                    host = host.translate(_LOWER)
                    key = host_key(host)
                    first, last = bisect.bisect_right(splitters, (key, -1)), bisect.bisect_left(splitters, (key_end(key), -1))
                    rows += [(r, key, 0, host, path, verdict) for r in range(first, last + 1)]
            cols = list(zip(*rows, strict=True)) or [()] * len(fields)
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[f[0] for f in fields])

    placed = src.mapInArrow(place_pages, mid)
    opened = rules.select("verdict", "host", "path").mapInArrow(place_rules, T.StructType([T.StructField(*f) for f in fields]))
    both = placed.unionByName(opened, allowMissingColumns=True)

    kept = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    out = T.StructType(
        [*(T.StructField(f.name, f.dataType) for f in carried if f.name in kept)]
        + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, active = None, Sweep()
        for b in batches:
            k = len(keep)
            rows, rule, verdict = [], [], []
            ranges, keys, kinds, hosts, paths, verdicts = (b.column(k + i).to_pylist() for i in range(6))
            for i, (r, key, kind) in enumerate(zip(ranges, keys, kinds, strict=True)):
                if r != at:
                    at, active = r, Sweep()
                if kind == 0:
                    active.open(key, paths[i], verdicts[i])
                    continue
                won = active.judge(key, paths[i])
                rows.append(i)
                rule.append(won and ".".join(reversed(won[0][:-1].split("."))) + won[1])
                verdict.append(won[2] if won else "allow")
            took = b.take(pa.array(rows, pa.int64()))
            cols = [took.column(keep.index(c)) for c in kept] + [took.column(k + 3), took.column(k + 4)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=out.names)

    ordered = both.repartition("__range").sortWithinPartitions("__range", "__key", "__kind")
    return ordered.mapInArrow(sweep, out)
