"""Encoding of a text column with a public byte-level BPE tokenizer.

Texts are cut into runs that the tokenizer's own splitting pattern never crosses (`runs`), so a run is encoded once per worker
and looked up afterwards. Long texts are encoded by tree concatenation: both halves are encoded on their
own, wherever the cut falls, then a window around the join is encoded again and grown until it meets a
boundary of both sides; from there on the halves' ids hold. A long run without any boundary is joined the same way on
the level of byte pairs. Texts above `spread_chars` are cut into leaves that are encoded in different tasks.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The splitting pattern of the tokenizer (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode White_Space (fixed values). Python's own \s also has the separators 1C to 1F.
_WS = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: A superset of the pattern's pieces: an optional blank and what follows up to white space, or white space.
RUN = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?=[{_WS}]|\\Z)|[{_WS}]+")
LEAF_CHARS = 1 << 13
LONG_RUN = 1 << 8
CACHE_RUNS = 1 << 17
SPREAD_CHARS = 1 << 20


class Cache(dict):
    """Ids of runs, filled on demand and emptied when it is full, so that its size doesn't follow the corpus."""

    def __init__(self, encode, limit: int = CACHE_RUNS):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, run: str) -> list[int]:
        ids = self.encode(run)
        if len(run) <= LONG_RUN:
            if len(self) >= self.limit:
                self.clear()
            self[run] = ids
        return ids


@dataclass
class Node:
    """A stretch of a text: where its runs begin (offsets in the whole text) and their ids."""

    starts: list[int]
    ids: list[list[int]]
    end: int


class TreeEncoder:
    def __init__(self, vocabulary: bytes, pattern: str = PATTERN, leaf_chars: int = LEAF_CHARS, long_run: int = LONG_RUN):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        self.bpe = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(pattern)
        self.leaf_chars, self.long_run = leaf_chars, long_run
        self.cache = Cache(self._run)
        self.lengths = Cache(lambda run: len(self.cache[run]))

    # -- a run

    def _run(self, run: str) -> list[int]:
        if len(run) <= self.long_run:
            return self.bpe.encode_ordinary(run)
        return list(chain.from_iterable(self._piece(p.encode()) for p in self.pieces.findall(run)))

    def _piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a long one by halves."""
        if len(piece) <= self.long_run:
            return self.bpe._encode_single_piece(piece)
        half = len(piece) // 2
        return self._join_ids(self._piece(piece[:half]), self._piece(piece[half:]))

    def _agree(self, a: int, b: int) -> bool:
        """Whether ids a, b may stand side by side: a sequence is the encoding of its bytes if each pair in it is that of its own."""
        return self.bpe._encode_single_piece(self.bpe.decode_single_token_bytes(a) + self.bpe.decode_single_token_bytes(b)) == [a, b]

    def _join_ids(self, left: list[int], right: list[int]) -> list[int]:
        k = 1
        while True:
            l, r = min(k, len(left)), min(k, len(right))
            window = self.bpe._encode_single_piece(self.bpe.decode_bytes(left[len(left) - l :] + right[:r]))
            if (l == len(left) or self._agree(left[-l - 1], window[0])) and (r == len(right) or self._agree(window[-1], right[r])):
                return left[: len(left) - l] + window + right[r:]
            k *= 2

    # -- a text

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for an empty one and for NULL."""
        if not text:
            return []
        if len(text) <= self.leaf_chars:
            return list(chain.from_iterable(map(self.cache.__getitem__, RUN.findall(text))))
        return list(chain.from_iterable(self.tree(text, 0, len(text)).ids))

    def count(self, text: str | None) -> int:
        """Number of ids of a text. Runs don't depend on each other, so those of a long text needn't be held at once."""
        if not text:
            return 0
        if len(text) <= self.leaf_chars:
            return sum(map(self.lengths.__getitem__, RUN.findall(text)))
        return sum(self.lengths[m[0]] for m in RUN.finditer(text))

    def tree(self, text: str, lo: int, hi: int) -> Node:
        if hi - lo <= self.leaf_chars:
            return self.leaf(text[lo:hi], lo)
        mid = (lo + hi) // 2
        return self.join(text, self.tree(text, lo, mid), self.tree(text, mid, hi))

    def leaf(self, text: str, at: int) -> Node:
        runs = RUN.findall(text)
        starts = np.cumsum([at, *map(len, runs)])[:-1].tolist()
        return Node(starts, list(map(self.cache.__getitem__, runs)), at + len(text))

    def join(self, text: str, left: Node, right: Node) -> Node:
        """Both nodes as one. A run's end depends on what follows it only up to the next run, so all but the left side's last hold; splitting has no memory,
        so once a run of the window begins where one of the right side does, that and all later ones hold."""
        if not left.starts or not right.starts:
            return left if left.starts else right
        at, cut = left.starts[-1], right.starts[0]
        new: list[tuple[int, list[int]]] = []
        for m in RUN.finditer(text, at, right.end):
            k = bisect_left(right.starts, m.start())
            if m.start() >= cut and k < len(right.starts) and right.starts[k] == m.start():
                break
            new.append((m.start(), self._spanning(text, m.start(), m.end(), left, right, cut)))
        else:
            k = len(right.starts)
        return Node(left.starts[:-1] + [s for s, _ in new] + right.starts[k:], left.ids[:-1] + [i for _, i in new] + right.ids[k:], right.end)

    def _spanning(self, text: str, lo: int, hi: int, left: Node, right: Node, cut: int) -> list[int]:
        """Ids of the run text[lo:hi]. If both sides are parts of one long piece, their ids are joined instead of encoding all of it again."""
        run = text[lo:hi]
        if len(run) > self.long_run and lo == left.starts[-1] and lo < cut < hi and (len(right.starts) == 1 or right.starts[1] >= hi):
            if self.pieces.fullmatch(run) and (len(right.starts) == 1 or right.starts[1] == hi) and self.pieces.fullmatch(text[cut:hi]) and self.pieces.fullmatch(text[lo:cut]):
                return self._join_ids(left.ids[-1], right.ids[0])
        return self.cache[run]


_encoders: dict[tuple, TreeEncoder] = {}


def encoder(vocabulary: bytes, pattern: str = PATTERN) -> TreeEncoder:
    """One encoder per Python worker."""
    key = (hash(vocabulary), pattern)
    if key not in _encoders:
        _encoders[key] = TreeEncoder(vocabulary, pattern)
    return _encoders[key]


def load_vocabulary(df: DataFrame, path: str):
    """The vocabulary file (under 1 MB) as a broadcast variable; executors need no copy of their own."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _id_lists(lists: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))))


#: Texts per step within an Arrow batch, to bound the ids held at once.
STEP = 512


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN, spread_chars: int = SPREAD_CHARS) -> DataFrame:
    """`<key>, ids array<int>` for each row of `df`, without special tokens; their strings in a text are ordinary text.

    NULL and empty texts give an empty list. Keys may be NULL or repeated: each row gives one row (of repeated keys with texts above `spread_chars`,
    equal rows are told apart). Other columns are ignored.
    """
    voc = load_vocabulary(df, vocabulary)
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    short = rows.where(F.coalesce(F.length("_text"), F.lit(0)) <= spread_chars)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(voc.value, pattern)
        for b in batches:
            for i in range(0, b.num_rows, STEP):
                part = b.slice(i, STEP)
                yield pa.RecordBatch.from_arrays([part.column(0), _id_lists([enc.encode(t) for t in part.column(1).to_pylist()])], names=[key, "ids"])

    near = short.mapInArrow(encode, f"`{key}` {kind}, ids array<int>")
    return near.unionByName(_encode_spread(rows.where(F.length("_text") > spread_chars), key, kind, voc, pattern, spread_chars // 4))


def _encode_spread(long: DataFrame, key: str, kind: str, voc, pattern: str, leaf: int) -> DataFrame:
    """Ids of very long texts: leaves of a text are encoded in different tasks and joined as a tree, one text per group.
    A group holds one text and its ids, which is a row of the result anyway."""
    cuts = F.sequence(F.lit(0), F.length("_text") - 1, F.lit(leaf))
    leaves = long.withColumn("_row", F.monotonically_increasing_id()).select("_row", "_key", F.explode(F.transform(cuts, lambda c: F.struct(c.alias("at"), F.substring("_text", c + 1, F.lit(leaf)).alias("part")))).alias("_l"))
    leaves = leaves.select("_row", "_key", "_l.at", "_l.part").repartition("_row", "at")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(voc.value, pattern)
        for b in batches:
            for i in range(b.num_rows):
                at, part = b.column(2)[i].as_py(), b.column(3)[i].as_py()
                node = enc.tree(part, 0, len(part))
                starts = pa.array([[at + s for s in node.starts]], pa.list_(pa.int64()))
                ids = pa.array([node.ids], pa.list_(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*b.slice(i, 1).columns, starts, ids], names=["_row", "_key", "at", "part", "starts", "ids"])

    def join(t: pa.Table) -> pa.Table:
        enc = encoder(voc.value, pattern)
        t = t.sort_by("at")
        text = "".join(t.column("part").to_pylist())
        nodes = [Node(s, i, a + len(p)) for s, i, a, p in zip(*(t.column(c).to_pylist() for c in ("starts", "ids", "at", "part")), strict=True)]
        while len(nodes) > 1:
            nodes = [enc.join(text, *nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return pa.Table.from_arrays([t.column("_key").slice(0, 1).combine_chunks(), _id_lists([list(chain.from_iterable(nodes[0].ids))])], names=[key, "ids"])

    nodes = leaves.mapInArrow(encode, f"_row long, _key {kind}, at int, part string, starts array<long>, ids array<array<int>>")
    return nodes.groupBy("_row").applyInArrow(join, f"`{key}` {kind}, ids array<int>")


def count_tokens(batches: Iterator[pa.RecordBatch], voc, pattern: str = PATTERN) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """For mapInArrow functions: each batch (text last) with the token counts of its texts; NULL and empty texts count 0."""
    enc = encoder(voc.value, pattern)
    for b in batches:
        yield b, np.fromiter((enc.count(t) for t in b.column(b.num_columns - 1).to_pylist()), np.int64, b.num_rows)
