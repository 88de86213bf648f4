"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Of the ways to write a byte string in tokens, BPE picks the one in which each pair
of neighbours is a pair that BPE itself leaves apart. So each prefix of a
string has one valid last token: the token that ends there, and whose left neighbour,
the last token of the prefix before it, stays apart from it. `PrefixEncoder`
stores that token for every prefix. The ids follow by walking back; bytes
appended later extend the table, and an edit re-computes it from the edited place only,
until it meets the old one again.

Texts are first cut by the vocabulary's pattern; each match is encoded by itself. Tokens
that end at a byte come from an Aho-Corasick automaton over the vocabulary, so the time is linear in
the bytes, also for one match of a million letters.

How it runs: `encode` is one `mapInArrow` over the documents, without a shuffle. The different matches of a batch are found first. Those
that the worker's bounded cache (`CACHE_MATCHES`) doesn't know are encoded together by length,
in one array of prefix tables. Each Python worker loads the vocabulary from its path once; forgetting only costs time.

Defined results: a null text encodes as an empty one, to no ids. Special tokens are not recognised.
Rows stand for themselves; ids and nulls in other columns pass through. An empty table gives an empty result.
The columns token_ids, n_tokens replace those of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import held, portions, ship, small

CACHE_MATCHES = 100_000
KNOWN_PAIRS = 400_000
PORTION = 1_000_000
#: Longer matches are encoded one by one, and not kept.
TABLE_BYTES = 64
IDS = np.dtype("<u4")
#: What stands before the first token.
START = 0x7FFFFFFF

# The characters that Unicode calls white space, as the pattern's \s means them.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _ranges(kind: str) -> str:
    """The characters of a Unicode category as ranges for a character class."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return "".join(f"{re.escape(x[0])}-{re.escape(x[-1])}" for x in regex.findall(rf"\p{{{kind}}}+", every))


def _with_ranges(pattern: str) -> str:
    """`pattern` for the re module, which cuts faster: categories and white space as ranges."""
    ranges = {r"\p{L}": _ranges("L"), r"\p{N}": _ranges("N"), r"\s": SPACES}
    out, inside = "", False
    for piece in re.split(r"(\\p\{[LN]\}|\\s|\\S|\\.|\[|\])", pattern):
        inside = piece == "[" or inside and piece != "]"
        if piece in ranges:
            piece = ranges[piece] if inside else f"[{ranges[piece]}]"
        elif piece == r"\S":
            piece = f"[^{SPACES}]"
        out += piece
    return out


class IntMap:
    """Small numbers by non-negative 64-bit keys, many at a time: open addressing in arrays at most half full."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def __len__(self) -> int:
        return self.n

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            held = self.keys[at]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[hit]]
            more = ~hit & (held != -1)
            left, at = left[more], at[more]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray | list[int]) -> None:
        """`keys`: different ones that are not in the map."""
        values = np.asarray(values, np.int32)
        if 2 * (self.n + len(keys)) > len(self.keys):
            old = self.keys != -1
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            self.__init__((2 * len(keys)).bit_length())
        self.n += len(keys)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several for a place one stays
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)


class Vocabulary:
    """Ranks of byte strings, and which pairs of tokens BPE leaves apart."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        # For each token that merges can make: (part, rank of the merge that takes the part up), from a byte upward.
        self.right: dict[int, list[tuple[bytes, float]]] = {}
        self.left: dict[int, list[tuple[bytes, float]]] = {}
        self.apart = IntMap()
        self.ending = ahocorasick.Automaton()
        for token in sorted(self.ranks, key=self.ranks.__getitem__):
            halves = self._halves(token)
            if halves is None:
                continue  # no merge makes it; only a whole match can be it
            rank = self.ranks[token]
            never = float("inf")
            if len(token) == 1:
                self.right[rank] = self.left[rank] = [(token, never)]
            else:
                a, b = (self.ranks[x] for x in halves)
                self.right[rank] = [*self.right[b][:-1], (halves[1], rank), (token, never)]
                self.left[rank] = [*self.left[a][:-1], (halves[0], rank), (token, never)]
            self.ending.add_word(token.decode("latin-1"), (rank, len(token)))
        self.longest = max(map(len, self.ranks))
        self.stay_apart = lru_cache(KNOWN_PAIRS // 10)(self.stay_apart)  # for one pair at a time
        self.ending.make_automaton()
        self._grow_trie()

    def _grow_trie(self) -> None:
        """Nodes for the beginnings of the tokens that merges can make: the next node by node and byte, and the token of each node."""
        nodes, token_of = {b"": 0}, [-1]
        keys = []
        for token in sorted(self.ranks):
            if self.ranks[token] not in self.right:
                continue
            for i in range(1, len(token) + 1):
                if token[:i] not in nodes:
                    keys.append(nodes[token[: i - 1]] << 8 | token[i - 1])
                    nodes[token[:i]] = len(token_of)
                    token_of.append(-1)
            token_of[nodes[token]] = self.ranks[token]
        self.next_node = IntMap()
        self.next_node.add(np.array(keys, np.int64), np.arange(1, len(token_of)))
        self.token_of = np.array(token_of, np.int32)

    def _halves(self, token: bytes) -> tuple[bytes, ...] | None:
        """The two parts whose merge makes `token`; a single byte is its own; None if merges don't make it."""
        parts = [token[i : i + 1] for i in range(len(token))]
        own = self.ranks[token]
        while len(parts) > 2:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1)]
            rank, i = min(ranked)
            if rank >= own:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return tuple(parts) if all(self.ranks.get(p) in self.right or len(token) == 1 for p in parts) else None

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether BPE of the bytes of a and b leaves the two tokens.

        While both grow from bytes, the parts at their common border change in the order of the merges
        that take them up. The tokens join if the two parts that meet at some time merge before that; of equal merges the left one comes first.
        """
        return a == START or self._stay_apart(self.right[a], self.left[b])

    def all_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`stay_apart` of many pairs; those asked for the first time are worked out one by one."""
        pairs = a.astype(np.int64) << 32 | b
        known = self.apart.get(pairs)
        if (known < 0).any():
            new = np.unique(pairs[known < 0])
            if len(self.apart) + len(new) > KNOWN_PAIRS:
                self.apart = IntMap()
            self.apart.add(new, [self._stay_apart(self.right[x >> 32], self.left[x & 0xFFFFFFFF]) for x in new.tolist()])
            known[known < 0] = self.apart.get(pairs[known < 0])
        return known == 1

    def _stay_apart(self, right: list[tuple[bytes, float]], left: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        while True:
            (x, x_up), (y, y_up) = right[i], left[j]
            joined = self.ranks.get(x + y)
            if joined is not None and joined < x_up and joined <= y_up:
                return False
            if i + 1 == len(right) and j + 1 == len(left):
                return True
            if x_up <= y_up and i + 1 < len(right):
                i += 1
            else:
                j += 1


class PrefixEncoder:
    """A byte string with the unique valid last token of each prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self._fill(start, None)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put `new` for data[start:stop]; returns how many prefixes were computed again."""
        tail, old = self.data[stop:], self.last[stop:]
        self.data = self.data[:start] + new + tail
        self.last = self.last[:start] + [-1] * (len(self.data) - start)
        return self._fill(start, (start + len(new), old))

    def _fill(self, start: int, old: tuple[int, list[int]] | None) -> int:
        """Compute the prefixes that end after `start`.

        `old`: where unchanged bytes begin again and the last tokens there were. Once as many of them in a row as
        the longest token has bytes come out as before, all later ones do.
        """
        v, last = self.vocabulary, self.last
        longest = v.longest
        back = max(0, start - longest if start else 0)
        same = 0
        at = start - 1
        for end, (token, size) in v.ending.iter(self.data[back:].decode("latin-1")):
            end += back
            if end < start or last[end] >= 0:
                continue
            begin = end + 1 - size
            if begin and not v.stay_apart(last[begin - 1], token):
                continue
            last[end] = token
            at = end
            if old and end >= old[0]:
                same = same + 1 if old[1][end - old[0]] == token else 0
                if same >= longest:
                    last[end + 1 :] = old[1][end + 1 - old[0] :]
                    break
        return at + 1 - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class Tokenizer:
    """Encodes and decodes texts by a rank file and the pattern that cuts texts."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = v = Vocabulary(path)
        self.cut = re.compile(_with_ranges(pattern)).findall
        top = max(v.bytes_of) + 1
        self.packed = [t.to_bytes(IDS.itemsize, "little") for t in range(top)]
        self.bytes_of = [v.bytes_of.get(t, b"") for t in range(top)]
        self.sizes = np.array([len(x) for x in self.bytes_of])
        # Ids by match, in two generations: a full young one becomes the old one, whose entries come back as they are asked for.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode_matches(self, matches: list[str]) -> Iterator[bytes]:
        """The ids of each of `matches`, which differ."""
        data = [m.encode("utf-8") for m in matches]
        whole, packed = self.vocabulary.ranks.get, self.packed
        ids = {x: packed[rank] for x, rank in zip(data, map(whole, data), strict=True) if rank is not None}
        rest = sorted((x for x in data if x not in ids), key=len)
        while rest and len(rest[-1]) > TABLE_BYTES:
            long = rest.pop()
            ids[long] = self.encode_match(long)
        for _, same in groupby(rest, lambda x: -(-len(x) // 4)):
            same = list(same)
            ids.update(zip(same, self.encode_together(same), strict=True))
        return map(ids.__getitem__, data)

    def encode_together(self, matches: list[bytes]) -> Iterator[bytes]:
        """The ids of each of `matches`, of about equal and bounded length, by one prefix table for all of them.

        A row holds the last token of each prefix of a match. From each place on, all matches walk down the trie of tokens
        in step; a token that stays apart from the last one before it is the last one where it ends.
        """
        v = self.vocabulary
        width = max(map(len, matches))
        sizes = np.array(list(map(len, matches)))
        data = np.frombuffer(b"".join([m.ljust(width, b"\0") for m in matches]), np.uint8).reshape(-1, width).astype(np.int64)
        last = np.full((len(matches), width + 1), -1, np.int32)
        last[:, 0] = START
        for begin in range(width):
            rows = np.flatnonzero(sizes > begin)
            node = np.zeros(len(rows), np.int64)
            for end in range(begin + 1, width + 1):
                node = v.next_node.get(node << 8 | data[rows, end - 1])
                on = (node >= 0) & (sizes[rows] >= end)
                rows, node = rows[on], node[on].astype(np.int64)
                if not len(rows):
                    break
                token = v.token_of[node]
                found = np.flatnonzero((token >= 0) & (last[rows, end] < 0))
                if begin:
                    found = found[v.all_apart(last[rows[found], begin], token[found])]
                last[rows[found], end] = token[found]
        # Back from the end of each match, one token at a time.
        rows, end, taken = np.arange(len(matches)), sizes.copy(), []
        while len(rows):
            token = last[rows, end]
            taken.append((rows, token))
            end = end - self.sizes[token]
            rows, end = rows[end > 0], end[end > 0]
        row, token = (np.concatenate(x)[::-1] for x in zip(*taken, strict=True))
        order = np.argsort(row, kind="stable")
        ids = token[order].astype(IDS).tobytes()
        ends = (np.cumsum(np.bincount(row, minlength=len(matches))) * IDS.itemsize).tolist()
        start = 0
        for stop in ends:
            yield ids[start:stop]
            start = stop

    def encode_match(self, data: bytes) -> bytes:
        """The ids of one match, of any length."""
        whole = self.vocabulary.ranks.get(data)
        return self.packed[whole] if whole is not None else b"".join(map(self.packed.__getitem__, PrefixEncoder(self.vocabulary, data).ids()))

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers; texts are taken up to `PORTION` characters at a time."""
        for portion in portions(texts, PORTION):
            yield from self._encode_portion(portion)

    def _encode_portion(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.cut(t) if t else [] for t in texts]
        known = self.young
        missing = []
        for match in set().union(*cut):
            if match not in known:
                ids = self.old.get(match)
                if ids is None:
                    missing.append(match)
                else:
                    known[match] = ids
        known.update(zip(missing, self._encode_matches(missing), strict=True))
        out = [b"".join(map(known.__getitem__, matches)) for matches in cut]
        for match in missing:
            if len(match) > TABLE_BYTES:
                del known[match]
        if len(known) > CACHE_MATCHES:
            self.old, self.young = known, {}
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, IDS).tolist()))


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """The tokenizer that this process keeps."""
    return held((path, pattern), lambda: Tokenizer(path, pattern))


def _replaced(docs: DataFrame, new: list[T.StructField]) -> tuple[DataFrame, T.StructType]:
    """`docs` without the columns that `new` replaces, and the schema with both."""
    names = [f.name for f in new]
    src = docs.select(*[c for c in docs.columns if c not in names])
    return src, T.StructType([*src.schema.fields, *new])


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """`docs` with token_ids (array of int) and n_tokens."""
    ship(docs.sparkSession)
    src, out = _replaced(docs, [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())])
    at = src.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for b in small(batches):
            ids = [np.frombuffer(x, IDS).astype(np.int32) for x in t.encode_all(b.column(at).to_pylist())]
            sizes = [len(x) for x in ids]
            flat = np.concatenate(ids) if ids else np.array([], np.int32)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat)
            yield pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(sizes, pa.int64())], names=out.names)

    return src.mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """`encoded` with the column decoded: the bytes of its ids; null ids give null."""
    ship(encoded.sparkSession)
    src, out = _replaced(encoded, [T.StructField("decoded", T.BinaryType())])
    at = src.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for b in small(batches):
            rows = [None if x.as_py() is None else t.decode(np.array(x.as_py(), IDS).tobytes()) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.binary())], names=out.names)

    return src.mapInArrow(run, out)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and return (id, n_tokens, ids_sha256, decoded_sha256).

    The ids and the decoded bytes never leave the Python worker, so nothing but the digests is moved.
    """
    ship(docs.sparkSession)
    src = docs.select(id_col, text_col)
    texts = [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
    out = T.StructType([src.schema[0], T.StructField("n_tokens", T.LongType()), *texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for b in small(batches):
            n, ids_hex, decoded_hex = [], [], []
            for ids in t.encode_all(b.column(1).to_pylist()):
                n.append(len(ids) // IDS.itemsize)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded_hex.append(hashlib.sha256(t.decode(ids)).hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=out.names)

    return src.mapInArrow(run, out)


def token_lengths(docs: DataFrame, path: str, pattern: str, text_col: str = "text", group_cols: tuple[str, ...] = ()) -> DataFrame:
    """A row per document: the group columns and n_tokens; the ids stay in the worker."""
    ship(docs.sparkSession)
    src = docs.select(*group_cols, text_col)
    out = T.StructType([*src.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for b in small(batches):
            n = [len(x) // IDS.itemsize for x in t.encode_all(b.column(len(group_cols)).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=out.names)

    return src.mapInArrow(run, out)
