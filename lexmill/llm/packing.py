"""Filling fixed-capacity containers with items.

The plan is made on the histogram of item sizes, which a capacity bounds, never on the items: sums of one, two
and three sizes are looked up as exact complements of the gap a large item leaves, and a combination is consumed as often as
its counts allow at once. What finds no complement goes by best fit. The items then find their places by
their rank among the items of equal size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.tokenize import VOCABULARY, count_tokens, load_vocabulary
from lexmill.session import cut

#: A pattern of sizes and the number of containers filled with it.
Step = tuple[tuple[int, ...], int]


class Complements:
    """Which gaps can be filled exactly by one, two or three of the sizes still available."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        """Index the pair sums. Counts only fall, so an index that is out of date has too many sums, never too few."""
        there = (self.counts > 0).astype(np.float64)
        n = 1 << (2 * len(there)).bit_length()
        self.pairs = np.rint(np.fft.irfft(np.fft.rfft(there, n) ** 2, n))[: len(there)] > 0

    def _pair(self, gap: int, largest: int) -> tuple[int, int] | None:
        top = min(largest, gap - 1)
        if top < 1:
            return None
        a = np.arange(top, (gap - 1) // 2, -1)
        ok = (self.counts[a] > 0) & (self.counts[gap - a] > 0) & ((a * 2 != gap) | (self.counts[a] > 1))
        k = int(ok.argmax()) if len(a) else 0
        return (int(a[k]), int(gap - a[k])) if len(a) and ok[k] else None

    def fill(self, gap: int, largest: int) -> tuple[int, ...] | None:
        """Sizes, none above `largest`, that add up to the gap: one if there is one, else two, else three."""
        if gap <= largest and self.counts[gap] > 0:
            return (gap,)
        stale = False
        if self.pairs[gap]:
            if pair := self._pair(gap, largest):
                return pair
            stale = True
        a = np.arange(min(largest, gap - 2), 0, -1)
        a = a[(self.counts[a] > 0) & self.pairs[gap - a]]
        for first in a.tolist():
            self.counts[first] -= 1
            pair = self._pair(gap - first, first)
            self.counts[first] += 1
            if pair:
                return (first, *pair)
            stale = True
        if stale:
            self.refresh()
        return None


def plan_containers(sizes: dict[int, int], capacity: int) -> list[Step]:
    """Patterns that use each size (1 to capacity) exactly as often as it is counted, none above the capacity.

    Sizes are taken from the largest down. Steps are bulk steps, so their number follows the number of
    different sizes, not of items.
    """
    if bad := [s for s in sizes if not 0 < s <= capacity]:
        raise ValueError(f"sizes outside 1 to {capacity}: {bad[:5]}")
    counts = np.zeros(capacity + 1, np.int64)
    for s, n in sizes.items():
        counts[s] = n
    index, steps = Complements(counts), []
    left: dict[int, int] = {}
    for s in np.flatnonzero(counts)[::-1].tolist():
        if s == capacity:
            steps.append(((s,), int(counts[s])))
            counts[s] = 0
            continue
        while counts[s] > 0:
            counts[s] -= 1
            fill = index.fill(capacity - s, s)
            counts[s] += 1
            if not fill:
                left[s] = int(counts[s])
                counts[s] = 0
                break
            pattern = (s, *fill)
            need = {x: pattern.count(x) for x in pattern}
            times = min(int(counts[x]) // k for x, k in need.items())
            for x, k in need.items():
                counts[x] -= times * k
            steps.append((pattern, times))
    return steps + _best_fit(left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[Step]:
    """Best fit decreasing in bulk: containers with equal contents are handled together."""
    by_gap: dict[int, list[Step]] = {}
    gaps = np.zeros(capacity + 1, np.int64)
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            k = int(np.argmax(gaps[s:] > 0)) + s
            if gaps[k] > 0:
                pattern, times = by_gap[k].pop()
                use = min(n, times)
                gaps[k] -= use
                if use < times:
                    by_gap[k].append((pattern, times - use))
                new, gap = (*pattern, s), k - s
            else:
                # as many new containers as hold all that is left, filled with this size alone
                each = capacity // s
                use, new, gap = (n // each, (s,) * each, capacity - s * each) if n >= each else (1, (s,) * n, capacity - s * n)
                n -= use * len(new) - use
            n -= use
            gaps[gap] += use
            by_gap.setdefault(gap, []).append((new, use))
    return [step for steps in by_gap.values() for step in steps]


class Places:
    """Where the item of a given size and rank goes: containers and, for reports, their number."""

    def __init__(self, steps: list[Step]):
        cursor: dict[int, int] = {}
        rows, base = [], 0
        for pattern, times in steps:
            for size in set(pattern):
                each, at = pattern.count(size), cursor.get(size, 0)
                rows.append((size, at, base, each))
                cursor[size] = at + times * each
            base += times
        rows.sort()
        self.containers = base
        self.size, self.rank, self.base, self.each = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else ([], [], [], [])))
        self.key = (self.size << 40) + self.rank

    def find(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Containers by size and rank; items of size 0 take no room and are spread over all containers (0 if there are none)."""
        out = rank % max(self.containers, 1)
        some = size > 0
        if some.any():
            k = np.searchsorted(self.key, (size[some] << 40) + rank[some], "right") - 1
            out[some] = self.base[k] + (rank[some] - self.rank[k]) // self.each[k]
        return out


def ranked_pieces(docs: DataFrame, key: str, text: str, capacities: dict[int, int], vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of the documents for each capacity, with rank among the equal sizes of their partition: `budget_id, <key>, piece, tokens, _part, _rank`.

    A document above the capacity is cut into full pieces and a rest; others are one piece, also empty ones. Checkpointed, because texts are
    encoded only once and ranks must not change.
    """
    voc = load_vocabulary(docs, vocabulary)
    kind = docs.schema[key].dataType.simpleString()
    budgets = sorted(capacities.items())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = {b: np.zeros(c + 1, np.int64) for b, c in budgets}
        for batch, tokens in count_tokens(batches, voc):
            for b, c in budgets:
                n = np.maximum(1, -(-tokens // c))
                row = np.repeat(np.arange(len(tokens)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                size = np.minimum(tokens[row] - piece * c, c)
                order = np.argsort(size, kind="stable")
                sizes, first, count = np.unique(size[order], return_index=True, return_counts=True)
                rank = np.empty(len(size), np.int64)
                rank[order] = np.arange(len(size)) - np.repeat(first, count) + np.repeat(seen[b][sizes], count)
                seen[b][sizes] += count
                columns = [np.full(len(size), b, np.int32), None, piece, size, np.full(len(size), part, np.int32), rank]
                arrays = [batch.column(0).take(pa.array(row)) if x is None else pa.array(x) for x in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["budget_id", key, "piece", "tokens", "_part", "_rank"])

    rows = docs.select(key, text).mapInArrow(pieces, f"budget_id int, `{key}` {kind}, piece long, tokens long, _part int, _rank long")
    return cut(rows)


def pack_documents(docs: DataFrame, key: str, text: str, capacities: dict[int, int], vocabulary: str = VOCABULARY) -> DataFrame:
    """`budget_id, container_id, <key>, piece, tokens`: each document once per budget, in one container, or cut into pieces if it is larger than the capacity.

    NULL and empty texts have 0 tokens and are put into some container. Repeated keys are different items. Without
    documents, or capacities, there are no rows. Per budget, at most capacity + 1 numbers reach the driver.
    """
    if any(c < 1 for c in capacities.values()):
        raise ValueError("capacities must be positive")
    rows = ranked_pieces(docs, key, text, capacities, vocabulary)
    parts = rows.groupBy("budget_id", "tokens", "_part").agg(F.count("*").alias("_n"))
    sizes = {b: {} for b in capacities}
    for r in parts.where("tokens > 0").groupBy("budget_id", "tokens").agg(F.sum("_n").alias("n")).collect():
        sizes[r.budget_id][r.tokens] = r.n
    places = docs.sparkSession.sparkContext.broadcast({b: Places(plan_containers(sizes[b], c)) for b, c in capacities.items()})
    before = Window.partitionBy("budget_id", "tokens").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = rows.join(offsets, ["budget_id", "tokens", "_part"]).select("budget_id", key, "piece", "tokens", (F.col("_rank") + F.col("_before")).alias("_rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            budget, size, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            out = np.zeros(len(budget), np.int64)
            for one in np.unique(budget).tolist():
                at = budget == one
                out[at] = places.value[one].find(size[at].astype(np.int64), rank[at].astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), b.column(1), b.column(2), b.column(3)], names=["budget_id", "container_id", key, "piece", "tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return placed.mapInArrow(assign, f"budget_id int, container_id long, `{key}` {kind}, piece long, tokens long")


def packing_report(packed: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """Per budget: containers, tokens, capacity and the share of room that is used."""
    room = F.create_map(*[F.lit(x) for b, c in sorted(capacities.items()) for x in (b, c)])
    per = packed.groupBy("budget_id").agg(F.count_distinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"))
    return per.withColumn("capacity", room[F.col("budget_id")]).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity")))
