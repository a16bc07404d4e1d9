"""String and sequence comparison: indel and partial ratios, edit distance of tokens, alignments.

All work bit-parallel on Python integers: a row of the dynamic programme is one integer.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r"\w+|[^\w\s]")


def _positions(a: Sequence[Hashable]) -> dict[Hashable, int]:
    at: dict[Hashable, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    return at


def common_length(a: Sequence[Hashable], b: Sequence[Hashable], at: dict[Hashable, int] | None = None) -> int:
    """Length of the longest common subsequence."""
    at = _positions(a) if at is None else at
    every = (1 << len(a)) - 1
    row = every
    for x in b:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & every
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Normalised indel similarity from 0 to 100; two empty strings are equal."""
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def edit_distance(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Levenshtein distance of two sequences.

    Equal ends are cut off; then bands around the diagonal are tried, each four times as wide as the one before, until the distance lies within. So the time grows with the length times the
    distance, not with the square of the length.
    """
    first = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[first:], b[first:]
    last = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - last], b[: len(b) - last]
    if not a or not b:
        return len(a) + len(b)
    band = max(64, 2 * abs(len(a) - len(b)))
    while 4 * band < max(len(a), len(b)):
        if (found := _banded_distance(a, b, band)) <= band:
            return found
        band *= 4
    return _banded_distance(a, b, max(len(a), len(b)))


#: Columns whose parts of the position masks are cut out together.
STRETCH = 4096


def _banded_distance(a: Sequence[Hashable], b: Sequence[Hashable], band: int) -> int:
    """The distance, if it is at most `band`; else some larger number.

    A column of the table is kept as two integers of vertical differences, for the rows within `band` of the diagonal; the window moves down one row per column (Hyyrö 2003). The distance
    is followed along the window's last row, then along the last row of the table.
    """
    n, width = len(a), 2 * band + 1
    every, at = (1 << width) - 1, _positions(a)
    up, down = (1 << band + 1) - 1 << band, 0
    score, cut, base = min(band, n), {}, 0
    for j, x in enumerate(b, 1):
        shift = j - band - 1  # rows before the window
        if shift - base >= STRETCH:
            cut, base = {}, shift
        if x not in cut:
            cut[x] = at.get(x, 0) >> base & (1 << width + STRETCH) - 1
        eq = (cut[x] >> shift - base if shift > base else cut[x] if shift >= 0 else cut[x] << -shift) & every
        diagonal = (((eq & up) + up) ^ up) & every | eq | down
        right, left = down | ~(diagonal | up) & every, diagonal & up
        if j + band <= n:
            score += not diagonal >> width - 1
        else:
            row = n - j + band
            if row < 0:
                return band + 1
            score += (right >> row & 1) - (left >> row & 1)
        up, down = left | ~(diagonal >> 1 | right) & every, diagonal >> 1 & right
    return score if n - len(b) <= band else band + 1


@dataclass(frozen=True)
class Place:
    score: float
    start: int
    end: int


def best_place(needle: str, text: str, least: float = 0.0) -> Place:
    """The window of `text` most like `needle` (as long as it, or shorter at the text's ends); the earliest of equals. Without a window of score `least`, the score is -1.

    How many characters a window shares with the needle, whatever their order, bounds its score; windows are
    looked at from the highest bound down, until the bound is below the best score.
    """
    n, m = len(needle), len(text)
    if not n or not m:
        return Place(100.0 if n == m else 0.0, 0, 0)
    if n > m:
        return Place(best_place(text, needle, least).score, 0, m)
    starts = np.concatenate([np.zeros(n - 1, np.int64), np.arange(m - n + 1), np.arange(m - n + 1, m)])
    ends = np.concatenate([np.arange(1, n), np.arange(n, m + 1), np.full(n - 1, m)])
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    shared = np.zeros(len(starts), np.int64)
    for c in set(needle):
        seen = np.concatenate([[0], np.cumsum(chars == ord(c))])
        shared += np.minimum(seen[ends] - seen[starts], needle.count(c))
    bound = 200.0 * shared / (n + ends - starts)
    at, best = _positions(needle), Place(-1.0, 0, 0)
    for k in np.lexsort((starts, -bound)).tolist():
        if bound[k] < max(best.score, least):
            break
        s, e = int(starts[k]), int(ends[k])
        score = 200.0 * common_length(needle, text[s:e], at) / (n + e - s)
        if score >= least and (score > best.score or score == best.score and s < best.start):
            best = Place(score, s, e)
    return best


def partial_ratio(a: str, b: str, least: float = 0.0) -> float:
    return best_place(a, b, least).score if len(a) <= len(b) else best_place(b, a, least).score


def opcodes(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[str, int, int, int, int]]:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()


def word_error_rate(reference: str, text: str) -> float:
    a, b = TOKEN.findall(reference), TOKEN.findall(text)
    return edit_distance(a, b) / len(a) if a else float(bool(b))


# ---- columns


def arrow_function(rows: Callable[..., list], kind: str, *columns: Column) -> Column:
    """A function of lists of values to a list of results as an Arrow function of columns. Structs are dicts; a missing one has NULL fields."""
    names = T._parse_datatype_string(kind).names if kind.startswith("struct<") else None

    def run(*series: pd.Series) -> pd.Series:
        return pd.Series(rows(*series), dtype=object)

    def run_struct(*series: pd.Series) -> pd.DataFrame:
        found = rows(*series)
        return pd.DataFrame({n: pd.Series([None if r is None else r[n] for r in found], dtype=object) for n in names})

    f = run_struct if names else run
    f.__annotations__ = {"series": pd.Series, "return": pd.DataFrame if names else pd.Series}
    return F.pandas_udf(f, kind)(*columns)


def pairwise(f: Callable, kind: str) -> Callable[..., Column]:
    """A function of two or more strings as an Arrow function of columns; NULL if any of them is."""

    def rows(*series: pd.Series) -> list:
        return [None if any(x is None for x in xs) else f(*xs) for xs in zip(*series, strict=True)]

    return lambda *columns: arrow_function(rows, kind, *columns)


ratio_col = pairwise(ratio, "double")
partial_ratio_col = pairwise(partial_ratio, "double")
wer = pairwise(word_error_rate, "double")


def cer(reference: Column, text: Column) -> Column:
    """Character error rate, which may exceed 1; an empty reference gives 0 or 1. Stays in the JVM."""
    return F.when(reference != "", F.levenshtein(reference, text) / F.length(reference)).when(reference.isNotNull() & text.isNotNull(), (text != "").cast("double"))


def within_error(reference: Column, text: Column, most: float) -> Column:
    """Whether the error rate is at most `most`, with a threshold distance that cuts the computation short."""
    return F.levenshtein(reference, text, threshold=1 << 20).isNotNull() & (cer(reference, text) <= most)


SEGMENTS = "array<struct<op:string,reference:string,generated:string>>"


def align_texts(reference: str, text: str, most: int = 400) -> list[dict[str, str]]:
    """Token alignment as segments with both sides' text, the first `most` of them."""
    a, b = TOKEN.findall(reference), TOKEN.findall(text)
    return [{"op": op, "reference": " ".join(a[i1:i2]), "generated": " ".join(b[j1:j2])} for op, i1, i2, j1, j2 in opcodes(a, b)[:most]]


align = pairwise(align_texts, SEGMENTS)


def equal_share(segments: Column, reference: Column) -> Column:
    """Characters in equal segments over those of the reference; 0 without a reference."""
    same = F.aggregate(segments, F.lit(0), lambda n, s: n + F.when(s["op"] == "equal", F.length(s["reference"])).otherwise(0))
    return F.when(F.length(reference) > 0, same / F.length(reference)).otherwise(0.0)


def largest_differences(segments: Column, most: int = 25, cut: int = 400) -> Column:
    """The longest differing segments, longest first, in document order among equals, with texts cut."""
    weight = lambda s: F.length(s["reference"]) + F.length(s["generated"])
    ranked = F.array_sort(F.filter(F.transform(segments, lambda s, i: F.struct((-weight(s)).alias("w"), i.alias("i"), s.alias("s"))), lambda x: x["s"]["op"] != "equal"))
    return F.transform(F.slice(ranked, 1, most), lambda x: F.struct(x["s"]["op"].alias("op"), F.substring(x["s"]["reference"], 1, cut).alias("reference"), F.substring(x["s"]["generated"], 1, cut).alias("generated")))


def set_overlap(reference: Column, found: Column) -> Column:
    """Precision, recall and F1 of two arrays as sets; two empty sets agree fully. Each step is evaluated once per row."""
    once = lambda value, f: F.transform(F.array(value), f)[0]
    sets = F.struct(F.array_distinct(reference).alias("r"), F.array_distinct(found).alias("h"))
    sizes = once(sets, lambda s: F.struct(F.size(s["r"]).alias("r"), F.size(s["h"]).alias("h"), F.size(F.array_intersect(s["r"], s["h"])).alias("both")))

    def scores(n: Column) -> Column:
        p = F.when(n["h"] > 0, n["both"] / n["h"]).otherwise((n["r"] == 0).cast("double"))
        q = F.when(n["r"] > 0, n["both"] / n["r"]).otherwise((n["h"] == 0).cast("double"))
        f1 = F.when(p + q > 0, 2 * p * q / (p + q)).otherwise(0.0)
        return F.struct(F.bround(p, 4).alias("precision"), F.bround(q, 4).alias("recall"), F.bround(f1, 4).alias("f1"), n["r"].alias("reference"), n["h"].alias("hypothesis"), n["both"].alias("matched"))

    return once(sizes, scores)
