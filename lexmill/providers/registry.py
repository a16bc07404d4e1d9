"""Profiles `family[:variant]`: a registry of what makes documents of work units, and the worker that runs it."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "unit_id string, status string, payload string, pages int, seconds double, error string"


@dataclass(frozen=True)
class Family:
    """`start(variant)` runs once per task and gives a function of a unit's row (a dict) to `(payload, pages)`."""

    name: str
    start: Callable[[str | None], Callable[[dict], tuple[str, int]]]
    description: str = ""
    remote: bool = False


_families: dict[str, Family] = {}


def register(family: Family) -> Family:
    _families[family.name] = family
    return family


def family_of(profile: str) -> tuple[Family, str | None]:
    """Family and variant of a profile; an unknown family is an error before any work is done."""
    name, _, variant = profile.partition(":")
    if name not in _families:
        raise KeyError(f"unknown profile family {name!r}; known: {', '.join(sorted(_families))}")
    return _families[name], variant or None


def run_units(units: DataFrame, profile: str) -> DataFrame:
    """Results of a profile over units. The engine starts once per task; a unit that fails is a failed row, never a failed task."""
    family, variant = family_of(profile)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = family.start(variant)
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                began = time.monotonic()
                try:
                    payload, pages = engine(row)
                    result = ("success", payload, pages, None)
                except Exception as e:  # noqa: BLE001
                    result = ("failed", None, 0, f"{type(e).__name__}: {e}")
                out.append((row["unit_id"], *result[:3], time.monotonic() - began, result[3]))
            yield pd.DataFrame(out, columns=["unit_id", "status", "payload", "pages", "seconds", "error"])

    return units.mapInPandas(work, RESULT)


# ---- answers of services


def is_retryable(status: Column) -> Column:
    """Too many requests and server errors are worth another attempt."""
    return (status == 429) | (status >= 500)


def retry_after(status: Column, header: Column, attempt: Column, most: float = 60.0) -> Column:
    """Seconds to wait: what the service asks for, else doubling; NULL if it is no use."""
    asked = header.try_cast("double")
    return F.when(is_retryable(status), F.least(F.lit(most), F.coalesce(asked, F.pow(F.lit(2.0), attempt))))


def is_credit_error(message: Column) -> Column:
    return F.lower(message).contains("credit balance")


def stop_on_credit(attempts: DataFrame, order: list[str]) -> DataFrame:
    """Attempts up to the first credit error; later ones aren't made. The first one is a single aggregate, then attempts are filtered where they lie."""
    place = F.struct(*order)
    first = attempts.where(is_credit_error(F.coalesce("error", F.lit("")))).agg(F.min(place))
    return attempts.where(F.coalesce(place <= first.scalar(), F.lit(True)))


class ServiceError(RuntimeError):
    """A service's answer that is no result: its status, and the seconds it asks to wait."""

    def __init__(self, status: int, message: str = "", wait: float | None = None):
        super().__init__(f"{status} {message}".strip())
        self.status, self.wait = status, wait


class Throttled:
    """An engine around a remote one: at most `per_second` calls by a task, several attempts where another one may help (too many requests, server errors), and none at all once credit has run out.

    What a service limits is the sum over tasks: give each its share. `clock` and `sleep` are parameters for tests.
    """

    def __init__(self, call: Callable[[dict], tuple[str, int]], per_second: float = 1.0, attempts: int = 4, most: float = 60.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.call, self.gap, self.attempts, self.most, self.clock, self.sleep = call, 1.0 / per_second, attempts, most, clock, sleep
        self.free_at, self.exhausted = 0.0, False
        self.notes: list[str] = []

    def __call__(self, row: dict) -> tuple[str, int]:
        if self.exhausted:
            raise ServiceError(402, "not called: credit balance is exhausted")
        for attempt in range(self.attempts):
            if (wait := self.free_at - self.clock()) > 0:
                self.sleep(wait)
            self.free_at = self.clock() + self.gap
            try:
                return self.call(row)
            except ServiceError as e:
                self.exhausted = "credit balance" in str(e).lower()
                if self.exhausted or attempt == self.attempts - 1 or not (e.status == 429 or e.status >= 500):
                    raise
                pause = min(self.most, 2.0**attempt if e.wait is None else e.wait)
                self.notes.append(f"attempt {attempt + 1} got {e.status}; next one in {pause:g} s")
                self.sleep(pause)
        raise AssertionError("unreachable")


register(Family("text", lambda variant: lambda row: (str(row.get("text") or ""), 1), "passes a unit's own text on"))
