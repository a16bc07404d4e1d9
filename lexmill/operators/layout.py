"""Positioned text items of pages: reading, classification by geometry, page texts, made-up geometry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import markers
from lexmill.functions.text import clean, normalize, squash
from lexmill.operators.report import merge_paragraphs
from lexmill.operators.shred import decode

ITEM = "struct<pos:int,page:int,label:string,text:string,l:double,t:double,r:double,b:double,cells:array<array<string>>,width:double,height:double>"
#: Page size where a layout gives none, in points (fixed values).
WIDTH, HEIGHT = 612.0, 792.0


def _list(x: object) -> list:
    return x if isinstance(x, list) else [] if x is None else [x]


def _number(x: object, default: float = 0.0) -> float:
    try:
        return float(x)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default


def reading_order(doc: dict) -> Iterator[dict]:
    """Objects of a layout in the order of its body tree, each once; without such a tree, in the order of its lists. Furniture isn't part of the body."""
    objects = {o.get("self_ref"): o for k in ("texts", "tables", "groups", "pictures") for o in _list(doc.get(k)) if isinstance(o, dict)}
    seen: set[str] = set()

    def below(node: dict) -> Iterator[dict]:
        for c in _list(node.get("children")):
            ref = c.get("$ref") if isinstance(c, dict) else c
            if ref in objects and ref not in seen:
                seen.add(ref)
                yield objects[ref]
                yield from below(objects[ref])

    body = doc.get("body")
    found = below(body) if isinstance(body, dict) and body.get("children") else iter([o for k in ("texts", "tables") for o in _list(doc.get(k)) if isinstance(o, dict)])
    return (o for o in found if o.get("content_layer") != "furniture")


def read_items(doc: dict) -> list[dict]:
    """Items with text and a place, boxes from the bottom left and upright; a table's text is its cells."""
    sizes = {int(k): p.get("size") or {} for k, p in (doc.get("pages") or {}).items() if isinstance(p, dict) and str(k).isdigit()}
    out = []
    for o in reading_order(doc):
        prov = next((p for p in _list(o.get("prov")) if isinstance(p, dict)), None)
        label = str(o.get("label") or "").lower()
        if prov is None or label == "picture":
            continue
        cells = None
        text = o.get("text") or ""
        if label == "table":
            grid = (o.get("data") or {}).get("grid") or []
            cells = [[str((c or {}).get("text") or "") for c in _list(row)] for row in grid]
            text = " ".join(" | ".join(row) for row in cells)
        page = int(_number(prov.get("page_no"), 1))
        box, size = prov.get("bbox") or {}, sizes.get(page, {})
        height = _number(size.get("height"), HEIGHT)
        l, t, r, b = (_number(box.get(k)) for k in "ltrb")
        if str(box.get("coord_origin", "")).upper() == "TOPLEFT":
            t, b = height - t, height - b
        out.append({"pos": len(out), "page": page, "label": label, "text": str(text), "l": l, "t": max(t, b), "r": r, "b": min(t, b), "cells": cells, "width": _number(size.get("width"), WIDTH), "height": height})
    return out


def layout_items(docs: DataFrame, key: str, payload: str) -> DataFrame:
    """`<key>, pos, page, label, text, l, t, r, b, cells, width, height` of readable layouts; items without text are left out."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([[] if (d := decode(x)) is None else read_items(d) for x in s], dtype=object)

    rows = docs.select(key, F.inline(F.pandas_udf(run, f"array<{ITEM}>")(F.col(payload))))
    return rows.withColumn("text", clean(F.col("text"))).where("text != ''")


def classify_items(items: DataFrame, doc: str = "granule_id") -> DataFrame:
    """`kind` (footer, header, sidenote, body) and `rank` (reading order by place) of each item, by its place relative to the page's main column.

    The column's edges are the upper medians over wide items, or fixed shares of the width. The first three items of a page are
    looked at again: body lines that read like running heads are headers.
    """
    page = Window.partitionBy(doc, "page")
    w, h, l, t, r, b = (F.col(c) for c in ("width", "height", "l", "t", "r", "b"))
    wide = (r - l) > 0.4 * w

    def edge(c: Column, share: float) -> Column:
        there = F.array_sort(F.collect_list(F.when(wide, c)).over(page))
        return F.coalesce(F.try_element_at(there, (F.floor(F.size(there) / 2) + 1).cast("int")), share * w)

    d = items.withColumn("_l", edge(l, 0.15)).withColumn("_r", edge(r, 0.85))
    text = F.col("text")
    top = text.rlike(markers.HEAD_STAT) | text.rlike(markers.PUBLIC_LAW) | text.rlike(markers.PRIVATE_LAW) | text.rlike(markers.PAGE_NUMBER) | (F.length("text") < 60)
    beside = (r <= F.col("_l") + 0.02 * w) | (l >= F.col("_r") - 0.02 * w)
    narrow = ((r - l) < 0.25 * w) & (l > F.col("_r") - 0.3 * w) & (l > 0.6 * w)
    kind = F.when((t < 0.06 * h) | text.rlike(markers.PRINT_CODE), "footer").when((b > 0.93 * h) & top, "header").when(beside | narrow, "sidenote").otherwise("body")
    d = d.withColumn("kind", kind).withColumn("rank", F.row_number().over(page.orderBy(-F.bround(t / 4), l, "pos")))
    return d.withColumn("kind", F.when((F.col("rank") <= 3) & (F.col("kind") == "body") & markers.is_running_head(text), "header").otherwise(F.col("kind"))).drop("_l", "_r")


def page_texts(classified: DataFrame, doc: str = "granule_id") -> DataFrame:
    """Normalised body and sidenote text per page."""
    part = lambda k: normalize(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("rank", "text")))), lambda x: x["text"]), "\n"))
    return classified.groupBy(doc, F.col("page").alias("pdf_page")).agg(part("body").alias("body"), part("sidenote").alias("sidenote"))


def source_chars(items: DataFrame, doc: str = "granule_id") -> DataFrame:
    """Characters of a layout's text, blanks squashed."""
    return items.groupBy(doc).agg(F.sum(F.length(squash(F.col("text")))).alias("source_chars"))


def marker_runs(lines: DataFrame, doc: str, order: list[str], marker: Column) -> DataFrame:
    """Lines that begin a run of consecutive marker lines, with the run's number (`run`)."""
    w = Window.partitionBy(doc).orderBy(*order)
    begins = marker & ~F.coalesce(F.lag(marker).over(w), F.lit(False))
    return lines.withColumn("_b", begins).withColumn("run", F.sum(F.col("_b").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_b").drop("_b")


def after_markers(lines: DataFrame, doc: str, order: list[str], marker: Column, k: Column) -> DataFrame:
    """The line that follows the k-th marker line of its document."""
    w = Window.partitionBy(doc).orderBy(*order)
    n = F.sum(marker.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("_after", F.lag(F.when(marker, n)).over(w)).where(F.col("_after") == k).drop("_after")


def fill_geometry(items: DataFrame, doc: str = "granule_id") -> DataFrame:
    """Boxes for items that have none (all zero): equal slots down the page, in order."""
    empty = (F.col("l") == 0) & (F.col("t") == 0) & (F.col("r") == 0) & (F.col("b") == 0)
    w = Window.partitionBy(doc, "page", "_empty")
    d = items.withColumn("_empty", empty).withColumn("_i", F.row_number().over(w.orderBy("pos")) - 1).withColumn("_slot", 0.87 * F.col("height") / F.count("*").over(w))
    top = 0.95 * F.col("height") - F.col("_i") * F.col("_slot")
    made = {"l": 0.1 * F.col("width"), "r": 0.9 * F.col("width"), "t": top, "b": top - F.col("_slot")}
    return d.select(*[(F.when(F.col("_empty"), made[c]).otherwise(F.col(c)) if c in made else F.col(c)).alias(c) for c in items.columns], F.col("_empty").alias("synthesized"))


#: Places of made-up items by role, as shares of the page: left, right, top, bottom (fixed values).
BODY_BOX, NOTE_BOX, HEAD_TOP, FOOT_TOP = (0.12, 0.78, 0.92, 0.14), (0.82, 0.97), (0.985, 0.945), (0.125, 0.065)


def place_lines(items: DataFrame, page: list[str], order: str = "first_pos") -> DataFrame:
    """Boxes for merged transcription items (role, text, width, height), such that classify_items tells their roles apart: `l, t, r, b`."""
    w, h = F.col("width"), F.col("height")
    so_far = Window.partitionBy(*page).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    count = lambda *roles: F.sum(F.col("role").isin(*roles).cast("int")).over(so_far) - 1
    bodies = F.greatest(F.lit(1), F.sum((F.col("role") == "body").cast("int")).over(Window.partitionBy(*page)))
    step = (BODY_BOX[2] - BODY_BOX[3]) * h / bodies
    row = F.greatest(F.lit(0), count("body"))
    role, head, foot = F.col("role"), F.col("role").isin("running-head", "page-number"), F.col("role") == "footnote"
    t = (
        F.when(head, F.greatest((HEAD_TOP[1] + 0.01) * h, HEAD_TOP[0] * h - count("running-head", "page-number") * 0.01 * h))
        .when(foot, F.greatest((FOOT_TOP[1] + 0.01) * h, FOOT_TOP[0] * h - count("footnote") * 0.01 * h))
        .otherwise(BODY_BOX[2] * h - row * step)
    )
    line = F.least(step * 0.8, F.lit(12.0))
    low = F.when(role == "body", F.col("t") - line).otherwise(F.col("t") - F.least(line, 0.009 * h))
    note, number = role == "sidenote", role == "page-number"
    left = F.when(note, NOTE_BOX[0] * w).when(number, 0.80 * w).otherwise(BODY_BOX[0] * w)
    right = F.when(note, NOTE_BOX[1] * w).when(number, 0.95 * w).otherwise(BODY_BOX[1] * w)
    return items.withColumn("l", left).withColumn("r", right).withColumn("t", t).withColumn("b", F.greatest(low, F.lit(0.0)))


def transcribed_items(lines: DataFrame, doc: str = "granule_id", width: float = 612.0, height: float = 792.0) -> DataFrame:
    """Layout items of transcribed pages, for classify_items: `<doc>, page, pos, role, label, text, l, t, r, b, width, height, lines`.

    `lines` has doc, page (from 1 within what was transcribed), first_page (of that range in the document; NULL: 1), pos, role, text, starts_paragraph. Lines are merged into paragraphs by role, pages
    renumbered, and items placed where their role stands on a printed page. Blank lines are left out.
    """
    there = lines.withColumn("page", F.col("page") + F.coalesce("first_page", F.lit(1)) - 1)
    merged = merge_paragraphs(there, [doc, "page"]).withColumn("width", F.lit(width)).withColumn("height", F.lit(height))
    placed = place_lines(merged, [doc, "page"])
    label = F.when(F.col("role") == "footnote", "footnote").otherwise("text")
    return placed.select(doc, "page", F.col("first_pos").alias("pos"), "role", label.alias("label"), "text", "l", "t", "r", "b", "width", "height", "lines")
