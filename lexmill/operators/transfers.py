"""Transfers of files and jobs as tables of states: ranged downloads that resume, uploads with verification, a ledger of remote jobs."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import ids
from lexmill.functions.costs import machine_cost
from lexmill.session import cut, latest

PART = "part"


def part_plan(files: DataFrame, on_disk: DataFrame, parts: int = 4, least: int = 1 << 23) -> DataFrame:
    """`path, part, first, last, have, state, start`: what is still to be fetched of each file (path, size), given the parts on disk (path, part, have).

    A file is cut into closed byte ranges, at most `parts`, none below `least` bytes. A partial part resumes at `start`, one that is too long is fetched anew, a complete one has no start. Files of
    unknown size are one part without an end; empty files have none.
    """
    ranges = F.when(F.col("size").isNull(), F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.lit(None).cast("bigint").alias("last")))).otherwise(ids.byte_ranges(F.coalesce("size", F.lit(0)), F.lit(parts), least))
    cutup = files.select("path", F.posexplode(ranges).alias(PART, "r")).select("path", PART, "r.first", "r.last")
    have = on_disk.groupBy(F.col("path").alias("_p"), F.col(PART).alias("_n")).agg(F.max("have").alias("have"))
    both = cutup.join(have, (F.col("path") == F.col("_p")) & (F.col(PART) == F.col("_n")), "left").drop("_p", "_n")
    state = ids.part_status(F.col("have"), F.col("last") - F.col("first") + 1)
    state = F.when(F.col("last").isNull() & F.col("have").isNotNull(), "oversize").otherwise(state)  # of unknown size: fetched anew
    start = F.when(F.col("state") == "complete", None).when(F.col("state") == "partial", F.col("first") + F.col("have")).otherwise(F.col("first"))
    return both.withColumn("state", state).withColumn("start", start)


def download_outcome(expected_size: Column, size: Column, expected_sha: Column, sha: Column) -> Column:
    """What becomes of an assembled file: `done`, or why it is fetched again, in a single stream. Unknown sizes and digests aren't checked."""
    return F.when(size.isNull(), "missing").when(size != expected_size, "wrong size").when(F.lower(sha) != F.lower(expected_sha), "wrong digest").otherwise("done")


Fetch = Callable[[str, int, "int | None"], Iterator[bytes]]


def read_file(source: str, first: int, last: int | None, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Bytes `first` to `last` of a file all workers can open; other sources give a function of the same kind."""
    with open(source, "rb") as f:
        f.seek(first)
        left = None if last is None else last - first + 1
        while data := f.read(chunk if left is None else min(chunk, left)):
            left = None if left is None else left - len(data)
            yield data
            if left == 0:
                return


def _digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for data in iter(partial(f.read, 1 << 20), b""):
            h.update(data)
    return h.hexdigest()


def download(files: DataFrame, fetch: Fetch = read_file, parts: int = 4, least: int = 1 << 23) -> DataFrame:
    """`path, size, sha256, outcome, error` of files (path, source, size, sha256) fetched to `path`, a folder all workers share.

    Ranges are fetched in parallel into part files, which a broken-off run leaves for the next one to resume. Then each file's parts are put together, checked, and renamed to `path` in one step; if the check fails, the file is
    fetched once more in a single stream. A file that is already there with the right size isn't touched. Failures are rows.
    """

    def there(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, k, os.path.getsize(f"{p}.{PART}{k}")) for p in b["path"] for k in range(parts) if os.path.exists(f"{p}.{PART}{k}")]
            yield pd.DataFrame(rows, columns=["path", PART, "have"])

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                error = None
                try:
                    resume = r["state"] == "partial"
                    with open(f"{r['path']}.{PART}{int(r[PART])}", "ab" if resume else "wb") as f:
                        for data in fetch(r["source"], int(r["start"]), None if pd.isna(r["last"]) else int(r["last"])):
                            f.write(data)
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                out.append((r["path"], error))
            yield pd.DataFrame(out, columns=["path", "error"])

    def put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                path, whole, error = r["path"], f"{r['path']}.whole", r["error"]
                size, sha = (None if pd.isna(r["size"]) else int(r["size"])), r["sha256"]
                good = lambda p, size=size, sha=sha: os.path.exists(p) and (size is None or os.path.getsize(p) == size) and (sha is None or _digest(p) == sha.lower())
                try:
                    if not good(path):
                        pieces = [p for k in range(parts) if os.path.exists(p := f"{path}.{PART}{k}")]
                        if error is None:
                            with open(whole, "wb") as f:
                                for p in pieces:
                                    for data in read_file(p, 0, None):
                                        f.write(data)
                        if not good(whole):
                            with open(whole, "wb") as f:
                                for data in fetch(r["source"], 0, None):
                                    f.write(data)
                        if good(whole):
                            os.replace(whole, path)
                            error = None
                            for p in pieces:
                                os.remove(p)
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                    if os.path.exists(whole):
                        os.remove(whole)
                at = path if os.path.exists(path) else whole if os.path.exists(whole) else None
                out.append((path, None if at is None else os.path.getsize(at), None if at is None else _digest(at), error))
            yield pd.DataFrame(out, columns=["path", "got", "got_sha", "error"])

    wanted = files.select("path", "source", F.col("size").cast("bigint").alias("size"), "sha256")
    plan = part_plan(wanted, wanted.select("path").mapInPandas(there, "path string, part int, have bigint"), parts, least).where("start is not null")
    fetched = plan.join(wanted.select("path", "source"), "path").repartition("path", PART).mapInPandas(get, "path string, error string")
    errors = cut(fetched.groupBy("path").agg(F.max("error").alias("error")))  # nothing is put together before all parts are there, and nothing is fetched twice
    done = wanted.join(errors, "path", "left").repartition("path").mapInPandas(put_together, "path string, got bigint, got_sha string, error string")
    whole = wanted.select(F.col("path").alias("_p"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    return done.join(whole, F.col("path") == F.col("_p")).select("path", F.col("got").alias("size"), F.col("got_sha").alias("sha256"), download_outcome(F.col("_size"), F.col("got"), F.col("_sha"), F.col("got_sha")).alias("outcome"), "error")


def upload_plan(files: DataFrame) -> DataFrame:
    """`path, step` of files (path, expected, local, sha256, hub_size, hub_sha256): the next step of each.

    `clear`: the Hub has the same bytes, the local copy can go; `done`: it has gone; `upload`: the local copy is complete and the Hub has none or another; `fetch`: nothing complete anywhere;
    `wait`: the file's size isn't known. Where a digest is unknown, sizes decide.
    """
    whole = F.coalesce(F.col("local") == F.col("expected"), F.lit(False))
    same = F.coalesce(F.col("hub_size") == F.col("expected"), F.lit(False)) & F.coalesce(F.col("hub_sha256") == F.col("sha256"), F.lit(True))
    step = F.when(F.col("expected").isNull(), "wait").when(same & F.col("local").isNotNull(), "clear").when(same, "done").when(whole, "upload").otherwise("fetch")
    return files.select("path", step.alias("step"))


def job_ledger(events: DataFrame, rates: DataFrame) -> DataFrame:
    """`job_id, flavor, status, seconds, cost` of job events (job_id, flavor, status, seconds, at): each job's latest state, and what it cost at its flavor's hourly rate (flavor, hourly); NULL for a
    flavor without a rate or a job that hasn't ended."""
    now = latest(events, ["job_id"], ["at"], ["flavor", "status", "seconds"])
    r = rates.select(F.col("flavor").alias("_f"), "hourly")
    return now.join(r, F.col("flavor") == F.col("_f"), "left").select("job_id", "flavor", "status", "seconds", machine_cost(F.col("hourly"), F.col("seconds")).alias("cost"))
