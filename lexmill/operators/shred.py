"""Columnar shredding of nested JSON and reconstruction of flat tables.

A record is walked once and shredded into one column per declared leaf path; an entry is (repetition level, definition level,
value): the repetition level says which repeated ancestor the entry continues, the definition level how many steps of the path
exist. Tables are rebuilt from those level sequences only: each repeated ancestor becomes a table whose rows carry
the positions of all repeated ancestors (the parent-child link).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "array<struct<tbl:string,idx:array<int>,vals:array<string>>>"
_ROWS = pa.list_(pa.struct([("tbl", pa.string()), ("idx", pa.list_(pa.int32())), ("vals", pa.list_(pa.string()))]))


LIST, MAP = "[]", "{}"


@dataclass(frozen=True)
class Path:
    """A leaf path such as `texts[].prov[].bbox.l`. `[]` marks a list, `[][]` a list of lists, `{}` an object with any keys, whose values are the elements and whose keys their leaf `$key`.

    A step is (name, mark); the inner list of a list of lists has no name.
    """

    steps: tuple[tuple[str, str], ...]

    @classmethod
    def parse(cls, text: str) -> Path:
        steps: list[tuple[str, str]] = []
        for name, marks in re.findall(r"([^.\[{]+)((?:\[\]|\{\})*)(?:\.|$)", text):
            every = re.findall(r"\[\]|\{\}", marks) or [""]
            steps += [(name, every[0]), *[("", m) for m in every[1:]]]
        return cls(tuple(steps))

    @property
    def repeats(self) -> int:
        return sum(bool(mark) for _, mark in self.steps)

    def defined_at(self, level: int) -> int:
        """Definition level at which the `level`-th repeated step has an element."""
        return [i + 1 for i, (_, mark) in enumerate(self.steps) if mark][level - 1]


@dataclass(frozen=True)
class Table:
    """A flat table: a row for each element of the repeated ancestor at `level` of its leaf paths, which share their repeated steps.

    A leaf with fewer repeated steps than `level` gives the value of the enclosing element. With `outer`, an element
    of the level above that has no elements of its own gives one row, with position -1.
    """

    name: str
    leaves: tuple[str, ...]
    level: int
    outer: bool = False


Entry = tuple[int, int, Any]


class Shredder:
    """Shreds records into the columns of several leaf paths in one walk over the tree of their steps.

    A single value where a list is usual is a list of one; a scalar where an object with one leaf is usual counts as that leaf (`"parent": "#/body"`).
    """

    def __init__(self, leaves: Iterable[str]):
        self.paths = {x: Path.parse(x) for x in leaves}
        self.tree: dict[tuple[str, str], Any] = {}
        for x, path in self.paths.items():
            node = self.tree
            for step in path.steps[:-1]:
                node = node.setdefault(step, {})
            node[path.steps[-1]] = x if not isinstance(node.get(path.steps[-1]), dict) else {**node[path.steps[-1]], ("", ""): x}

    def __call__(self, record: Any) -> dict[str, list[Entry]]:
        columns: dict[str, list[Entry]] = {x: [] for x in self.paths}

        def absent(node: Any, rep: int, defined: int) -> None:
            if isinstance(node, dict):
                for below in node.values():
                    absent(below, rep, defined)
            else:
                columns[node].append((rep, defined, None))

        def element(node: Any, value: Any, rep: int, level: int, defined: int, repeated: bool) -> None:
            """A step's value, or an element of its list."""
            if not isinstance(node, dict):
                columns[node].append((rep, defined, value))
            elif isinstance(value, dict) or isinstance(value, list) and any(not name for name, _ in node):
                fields(node, value, rep, level, defined)
            elif not repeated and value is not None and not isinstance(value, list) and len(node) == 1 and isinstance(leaf := next(iter(node.values())), str):
                columns[leaf].append((rep, defined + 1, value))
            else:
                absent(node, rep, defined)

        def fields(node: dict, value: Any, rep: int, level: int, defined: int) -> None:
            for (name, mark), below in node.items():
                child = value.get(name) if name and isinstance(value, dict) else value if not name else None
                if not mark:
                    if child is None:
                        absent(below, rep, defined)
                    else:
                        element(below, child, rep, level, defined + 1, False)
                    continue
                if mark == MAP:
                    items = [v | {"$key": k} if isinstance(v, dict) else {"$key": k, "$value": v} for k, v in child.items()] if isinstance(child, dict) else []
                else:
                    items = child if isinstance(child, list) else [] if child is None else [child]
                if not items:
                    absent(below, rep, defined)
                for k, item in enumerate(items):
                    element(below, item, rep if k == 0 else level + 1, level + 1, defined + 1, True)

        if isinstance(record, dict):
            fields(self.tree, record, 0, 0, 0)
        else:
            absent(self.tree, 0, 0)
        return columns


def shred(record: Any, path: Path | str) -> list[Entry]:
    """One column of a record."""
    text = path if isinstance(path, str) else ".".join(f"{n}{m}" for n, m in path.steps).replace(".[]", "[]")
    return Shredder([text])(record)[text]


def positions(column: list[Entry], path: Path) -> Iterator[tuple[tuple[int, ...], int, Any]]:
    """Entries with the positions of their repeated ancestors, as far as those exist: (positions, definition level, value)."""
    at = [-1] * path.repeats
    levels = [path.defined_at(k + 1) for k in range(path.repeats)]
    for rep, defined, value in column:
        there = sum(defined >= d for d in levels)
        if rep == 0:
            at = [0] * path.repeats
        else:
            at[rep - 1] += 1
            at[rep:] = [0] * (path.repeats - rep)
        yield tuple(at[:there]), defined, value


def rebuild(columns: dict[str, list[Entry]], table: Table) -> Iterator[tuple[list[int], list[str | None]]]:
    """Rows (positions, values as strings) of a table, from the level sequences of its leaves."""
    paths = [Path.parse(x) for x in table.leaves]
    deepest = next(i for i, p in enumerate(paths) if p.repeats >= table.level)
    looked: list[dict[tuple[int, ...], Any]] = []
    for text, p in zip(table.leaves, paths, strict=True):
        depth, full = min(p.repeats, table.level), len(p.steps)
        looked.append({at: v for at, d, v in positions(columns[text], p) if len(at) == depth and d == full})
    seen: set[tuple[int, ...]] = set()
    for at, _, _ in positions(columns[table.leaves[deepest]], paths[deepest]):
        key = at[: table.level]
        if key in seen or len(key) < table.level - table.outer:
            continue
        seen.add(key)
        vals = [look.get(key[: min(p.repeats, table.level)]) for look, p in zip(looked, paths, strict=True)]
        yield [*key, *[-1] * (table.level - len(key))], [v if v is None or isinstance(v, str) else json.dumps(v) for v in vals]


def _reject(x: str) -> None:
    raise ValueError(x)


def plain(payload: str | None) -> str | None:
    """The text of a readable payload's object; None if it is no complete, valid JSON object."""
    if decode(payload) is None:
        return None
    return payload if payload.lstrip()[:1] == "{" else json.loads(payload)


def decode(payload: str | None) -> Any:
    """The object in a payload, also if it was encoded once more as a JSON string; None if it is no complete, valid JSON object."""
    if payload is None:
        return None
    try:
        o = json.loads(payload, parse_constant=_reject)
        o = json.loads(o, parse_constant=_reject) if isinstance(o, str) else o
    except (ValueError, RecursionError):
        return None
    return o if isinstance(o, dict) else None


def newest_deliveries(df: DataFrame, keys: dict[str, Column], payload: str, order: str) -> DataFrame:
    """`<keys>, _payload`: the latest readable delivery of each record, decoded once if it was encoded twice.

    NULL, truncated or otherwise unreadable payloads don't count, nor do NULL keys; a later unreadable delivery leaves the older one in force. Of ties in `order` one is taken by content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("_payload")
            texts = [plain(x) for x in b.column(at).to_pylist()]
            keep = [i for i, x in enumerate(texts) if x is not None]
            kept = b.take(pa.array(keep, pa.int64()))
            yield kept.set_column(at, "_payload", pa.array([texts[i] for i in keep], pa.string()))

    src = df.select(*[e.alias(k) for k, e in keys.items()], F.col(order).alias("_order"), F.col(payload).alias("_payload"))
    src = src.where(F.col("_payload").isNotNull() & F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    readable = src.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema))
    return readable.groupBy(*keys).agg(F.max_by("_payload", F.struct("_order", "_payload")).alias("_payload"))


def shred_tables(df: DataFrame, keys: dict[str, Column], payload: str, order: str, tables: list[Table]) -> DataFrame:
    """Rows `<keys>, tbl, idx, vals` of the latest readable delivery of each record, as of newest_deliveries; superseded deliveries are never shredded.

    Absent or NULL fields give NULL values. Only the payload in force crosses the shuffle; it is walked once for all tables.
    """
    shredder = Shredder(sorted({x for t in tables for x in t.leaves}))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out = [], []
            for i, text in enumerate(b.column("_payload").to_pylist()):
                columns = shredder(json.loads(text))
                keep.append(i)
                out.append([{"tbl": t.name, "idx": idx, "vals": vals} for t in tables for idx, vals in rebuild(columns, t)])
            kept = b.drop_columns(["_payload"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out, _ROWS)], names=[*kept.schema.names, "_rows"])

    newest = newest_deliveries(df, keys, payload, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in newest.schema if f.name != "_payload") + f", _rows {ROWS}"
    return newest.mapInArrow(rows, schema).select(*keys, F.inline("_rows"))


def decoded(df: DataFrame, key: str, payload: str, order: str) -> DataFrame:
    """`<key>, payload` of each record's latest readable delivery, as plain JSON of one object whose single values where `references`, `contents`, `pages` or
    `sections` are lists are lists of one. For readers with a fixed schema."""

    def tidy(o: Any) -> Any:
        if isinstance(o, dict):
            return {k: [tidy(v)] if k in ("references", "contents", "sections") and v is not None and not isinstance(v, list) else tidy(v) for k, v in o.items()}
        return [tidy(x) for x in o] if isinstance(o, list) else o

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if (o := decode(t)) is None else json.dumps(tidy(o)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=[key, "_order", "payload"])

    src = df.where(F.col(key).isNotNull() & F.col(payload).isNotNull()).select(key, F.col(order).alias("_order"), F.col(payload).alias("payload"))
    kinds = {f.name: f.dataType.simpleString() for f in src.schema}
    plain = src.mapInArrow(run, f"`{key}` {kinds[key]}, _order {kinds['_order']}, payload string").where("payload is not null")
    return plain.groupBy(key).agg(F.max_by("payload", F.struct("_order", "payload")).alias("payload"))
