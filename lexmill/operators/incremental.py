"""Processing only new or changed records.

Every record version gets its sequence number once, on arrival. What is done is kept as disjoint closed intervals of sequence
numbers; what is to do are the gaps that those intervals leave in the available ranges, whether at the end or
(late commits, failures) in the middle. All steps work per block of numbers, so no task holds the whole ledger.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.session import cut

#: Sequence numbers per block: intervals are merged and subtracted within a block by one task.
BLOCK_BITS = 16
INTERVALS = "lo long, hi long"


def number_arrivals(rows: DataFrame, first: int = 0, seq: str = "seq") -> tuple[DataFrame, int]:
    """The rows with the numbers `first`, `first` + 1, ... without gaps, and the number behind the last one.

    The rows are numbered where they lie, without a shuffle: the driver gets one count per partition. They are written to the
    checkpoint folder first, because numbers must not change if a lost executor makes Spark compute a partition again.
    """
    placed = cut(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    offsets, nxt = [], first
    for r in sorted(placed.groupBy(part.alias("p")).count().collect()):
        offsets.append((r.p, nxt))
        nxt += r["count"]
    starts = _literals(rows.sparkSession, offsets, "_part long, _start long")
    placed = placed.join(F.broadcast(starts), part == F.col("_part"))
    return placed.select(*rows.columns, (F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(seq)), nxt


def ranges_of(spark: SparkSession, *ranges: tuple[int, int]) -> DataFrame:
    """Closed intervals `lo, hi` from (first, behind the last) pairs, such as the arrivals of deliveries; empty ones are left out."""
    return _literals(spark, [(a, b - 1) for a, b in ranges if b > a], INTERVALS)


def _literals(spark: SparkSession, pairs: list[tuple[int, int]], schema: str) -> DataFrame:
    """A few pairs of numbers as rows of one partition."""
    values = F.array(*[F.struct(F.lit(a), F.lit(b)) for a, b in pairs]) if pairs else F.array()
    names = ", ".join(f"{c.split()[0]}:bigint" for c in schema.split(", "))
    return spark.range(0, 1, 1, 1).select(F.inline(values.cast(f"array<struct<{names}>>")))


def to_intervals(numbers: DataFrame, seq: str = "seq", block_bits: int = BLOCK_BITS) -> DataFrame:
    """Disjoint closed intervals `block, lo, hi` covering exactly the given numbers (repeated ones count once, NULL is left out)."""
    n = numbers.where(F.col(seq).isNotNull()).select(F.col(seq).alias("n"), F.shiftright(seq, block_bits).alias("block"))
    n = n.repartition("block").dropDuplicates(["block", "n"])
    island = F.col("n") - F.row_number().over(Window.partitionBy("block").orderBy("n"))
    return n.withColumn("_i", island).groupBy("block", "_i").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).drop("_i")


def split_blocks(intervals: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The same numbers as intervals that don't cross a block's border."""
    size = 1 << block_bits
    blocks = F.sequence(F.shiftright("lo", block_bits), F.shiftright("hi", block_bits))
    cutup = intervals.where("lo <= hi").select("lo", "hi", F.explode(blocks).alias("block"))
    return cutup.select("block", F.greatest("lo", F.col("block") * size).alias("lo"), F.least("hi", (F.col("block") + 1) * size - 1).alias("hi"))


def merge_intervals(*parts: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Union of intervals as disjoint, maximal intervals within blocks."""
    all_ = None
    for p in parts:
        p = split_blocks(p.select("lo", "hi"), block_bits)
        all_ = p if all_ is None else all_.unionByName(p)
    w = Window.partitionBy("block").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("lo") > reach + 1), 1).otherwise(0)
    run = all_.withColumn("_o", opens).withColumn("_r", F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("block", "_r").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_r")


def _borders(intervals: DataFrame, block_bits: int, **weights: int) -> DataFrame:
    """Two rows per interval and block: +weight where it begins, -weight behind its end."""
    cutup = split_blocks(intervals.select("lo", "hi"), block_bits)
    start = cutup.select("block", F.col("lo").alias("at"), *[F.lit(w).alias(k) for k, w in weights.items()])
    return start.unionByName(cutup.select("block", (F.col("hi") + 1).alias("at"), *[F.lit(-w).alias(k) for k, w in weights.items()]))


def subtract_intervals(available: DataFrame, processed: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Gaps: what `processed` leaves of `available`, as disjoint intervals `block, lo, hi`. Intervals of either side may overlap.

    Per block, the borders of both sets are swept in order; a stretch belongs to the result while an available
    interval is open and no processed one is.
    """
    both = _borders(available, block_bits, da=1, dp=0).unionByName(_borders(processed, block_bits, da=0, dp=1))
    at = both.repartition("block").groupBy("block", "at").agg(F.sum("da").alias("da"), F.sum("dp").alias("dp"))
    w = Window.partitionBy("block").orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = at.select("block", F.col("at").alias("lo"), (F.lead("at").over(w) - 1).alias("hi"), F.sum("da").over(run).alias("oa"), F.sum("dp").over(run).alias("op"))
    return swept.where("oa > 0 and op = 0 and hi >= lo").select("block", "lo", "hi")


def pending(records: DataFrame, processed: DataFrame, seq: str = "seq", block_bits: int = BLOCK_BITS, available: DataFrame | None = None) -> DataFrame:
    """The records whose sequence number lies in a gap that `processed` leaves of `available` (`lo, hi` intervals; the records' own numbers, if not
    given), each as often as it is in `records`. Records and the borders of the gaps are merged in order, block by block."""
    gaps = subtract_intervals(to_intervals(records, seq, block_bits) if available is None else available, processed, block_bits)
    marks = _borders(gaps, block_bits, _open=1).select(F.col("block").alias("_block"), F.col("at").alias("_at"), "_open")
    rows = records.select("*", F.shiftright(seq, block_bits).alias("_block"), F.col(seq).alias("_at"), F.lit(0).alias("_open"), F.lit(True).alias("_record"))
    # equal numbers are peers of the frame, so a border at a number counts for it
    merged = rows.unionByName(marks, allowMissingColumns=True).withColumn("_gap", F.sum("_open").over(Window.partitionBy("_block").orderBy("_at")))
    return merged.where("_record and _gap > 0").select(*records.columns)


class CommitConflict(RuntimeError):
    """Another run committed first; what this one wrote doesn't count. Run again: the gaps are found anew."""


class IntervalLedger:
    """Runs over a growing table, each record version exactly once.

    `arrive` numbers the versions (`keys` and `version` columns) that the log doesn't have yet, from the high-water mark on; a number is never
    given twice and never changes. `run` processes the gaps and commits output and merged intervals together. Whatever is written goes into a
    folder of its own first; a commit is one record that names it, published under the next free number, which the file system gives to one writer only. Of two runs
    at the same time one commits, and the other raises CommitConflict. What breaks off leaves no record, so the next run finds the same gaps; results that
    appear late below the highest processed number are gaps like any other.

    NULL keys and versions are values like any other. Of rows with the same keys and version one is kept. Empty deliveries and runs are committed, too.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], version: list[str] | None = None):
        self.spark, self.path, self.identity = spark, path.rstrip("/"), [*keys, *(version or [])]
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._p = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(self._conf)
        self._fs.mkdirs(self._p(f"{self.path}/commits"))

    def commits(self) -> list[dict]:
        """The commit records in order."""
        names = sorted(n for s in self._fs.listStatus(self._p(f"{self.path}/commits")) if (n := s.getPath().getName()).isdigit())
        out = []
        for n in names:
            stream = self._fs.open(self._p(f"{self.path}/commits/{n}"))
            try:
                out.append(json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"number": int(n)})
            finally:
                stream.close()
        return out

    def _of(self, kind: str) -> list[dict]:
        return [c for c in self.commits() if c["kind"] == kind]

    def _publish(self, number: int, record: dict) -> bool:
        """Create the commit record of that number; False if it exists."""
        draft, final = self._p(f"{self.path}/_draft-{uuid.uuid4().hex}"), self._p(f"{self.path}/commits/{number:010d}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            else:
                kinds = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
                options = self.spark.sparkContext._gateway.new_array(kinds, 1)
                options[0] = kinds.NONE
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(draft, final, options)
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            self._fs.delete(draft, False)
        return True

    def _commit(self, record: dict, seen: list[dict]) -> int:
        """Publish behind the commits seen so far; commits of the other kind that came between don't matter, one of the same kind is a conflict."""
        number = (seen[-1]["number"] if seen else 0) + 1
        while not self._publish(number, record):
            since = [c for c in self.commits() if c["number"] >= number]
            if any(c["kind"] == record["kind"] for c in since):
                self._fs.delete(self._p(f"{self.path}/{record['folder']}"), True)
                raise CommitConflict(json.dumps({"number": number, "error": "another writer committed first"}))
            number = since[-1]["number"] + 1
        return number

    def log(self) -> DataFrame | None:
        """All numbered versions; None before the first delivery."""
        folders = [f"{self.path}/{c['folder']}" for c in self._of("arrivals")]
        return self.spark.read.parquet(*folders) if folders else None

    def arrive(self, records: DataFrame) -> int:
        """Number and keep the versions that are new; returns how many there are."""
        seen = self.commits()
        known = [c for c in seen if c["kind"] == "arrivals"]
        new = records.dropDuplicates(self.identity)
        if known:
            old = self.spark.read.parquet(*[f"{self.path}/{c['folder']}" for c in known]).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.identity)])
            new = new.join(old, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.identity)], "left_anti")
        first = known[-1]["next"] if known else 0
        numbered, nxt = number_arrivals(new.select(*records.columns), first)
        folder = f"data/{uuid.uuid4().hex}"
        numbered.write.parquet(f"{self.path}/{folder}")
        self._commit({"kind": "arrivals", "folder": folder, "first": first, "next": nxt}, seen)
        return nxt - first

    def available(self) -> DataFrame:
        return ranges_of(self.spark, *[(c["first"], c["next"]) for c in self._of("arrivals")])

    def processed(self) -> DataFrame:
        """Intervals committed so far; none before the first run."""
        done = self._of("run")
        return self.spark.read.parquet(f"{self.path}/{done[-1]['folder']}/intervals") if done else self.spark.createDataFrame([], f"block long, {INTERVALS}")

    def pending(self) -> DataFrame | None:
        log = self.log()
        return None if log is None else pending(log, self.processed(), available=self.available())

    def run(self, transform: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame], DataFrame] | None = None) -> int | None:
        """Process what is pending and commit it; returns the commit's number, None before the first delivery.

        `transform` makes the output of the pending records; they have their number in `seq`. With `done`, only the numbers (`seq`) that it gives for the
        output are processed; the others stay gaps for the next run.
        """
        seen, todo = self.commits(), self.pending()
        if todo is None:
            return None
        todo, before = cut(todo), self.processed()
        folder = f"data/{uuid.uuid4().hex}"
        transform(todo).write.parquet(f"{self.path}/{folder}/output")
        output = self.spark.read.parquet(f"{self.path}/{folder}/output")
        numbers = to_intervals((todo if done is None else done(output)).select("seq"))
        merge_intervals(before, numbers).write.parquet(f"{self.path}/{folder}/intervals")
        return self._commit({"kind": "run", "folder": folder}, seen)

    def output(self) -> DataFrame | None:
        """The committed output of all runs."""
        folders = [f"{self.path}/{c['folder']}/output" for c in self._of("run")]
        return self.spark.read.parquet(*folders) if folders else None

    def remove(self) -> None:
        """Delete the ledger and all it holds."""
        self._fs.delete(self._p(self.path), True)
