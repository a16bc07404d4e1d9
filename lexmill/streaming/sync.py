"""Continuous sync: arriving records are processed in micro-batches, metadata is rewritten when it changes, late attempts are folded into state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexmill.operators.catalog import rows_digest


def incoming(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    """Files that arrive in a folder, a bounded number per batch: the back-pressure of the sync."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def run_batches(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what is there, batch by batch, then stop. A batch that fails is repeated with the same number, so `process` must write by number."""
    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class MetadataSink:
    """Rewrites a metadata file when its rows changed, at most every `every` batches and at the end."""

    def __init__(self, rows: Callable[[], DataFrame], write: Callable[[DataFrame], None], every: int = 5):
        self.rows, self.write, self.every, self.batches, self.last = rows, write, every, 0, ""

    def batch(self) -> None:
        self.batches += 1
        if self.batches % self.every == 0:
            self.flush()

    def flush(self) -> bool:
        digest = rows_digest(self.rows()).first().digest
        if digest == self.last:
            return False
        self.write(self.rows())
        self.last = digest
        return True


def attempt_counts(stream: DataFrame, time: str, late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Attempts per status and time window, waiting for late ones."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), "status").agg(F.count("*").alias("n"))


LATEST = "unit_id string, status string, finished_at timestamp, attempts long"


def latest_status(stream: DataFrame) -> DataFrame:
    """Per unit the latest status and the number of attempts, as of each batch; a late attempt counts, but doesn't replace a newer status."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, at, n = state.get if state.exists else (None, None, 0)
        for b in batches:
            n += len(b)
            new = b.loc[b["finished_at"].notna()].sort_values(["finished_at", "status"])
            if len(new) and (at is None or new["finished_at"].iloc[-1].to_pydatetime() >= at):
                status, at = new["status"].iloc[-1], new["finished_at"].iloc[-1].to_pydatetime()
        state.update((status, at, n))
        yield pd.DataFrame({"unit_id": [key[0]], "status": [status], "finished_at": [pd.Timestamp(at) if at else pd.NaT], "attempts": [n]})

    rows = stream.select("unit_id", "status", F.col("finished_at").cast("timestamp").alias("finished_at"))
    return rows.groupBy("unit_id").applyInPandasWithState(update, LATEST, "status string, finished_at timestamp, attempts long", "update", GroupStateTimeout.NoTimeout)
