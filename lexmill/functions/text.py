"""Text functions as columns. Patterns name Unicode classes, so Spark and DuckDB read them alike."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Quotation marks and dashes that count as their plain forms (fixed values).
QUOTES = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "′": "'", "″": '"', "´": "'", "`": "'"}
DASHES = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-"}
SOFT_HYPHEN = "\xad"
_PLAIN = QUOTES | DASHES


def _compose(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Unicode compatibility composition, which Spark has no function for."""
    return F.pandas_udf(_compose, "string")(c)


def normalize(c: Column, compose: bool = True) -> Column:
    """Comparable text: composed, plain quotes and dashes, words joined across line ends, single blanks, none before closing or after opening
    punctuation. Pass compose=False for text known to be composed; it then stays in the JVM."""
    t = nfkc(c) if compose else c
    t = F.translate(F.regexp_replace(t, SOFT_HYPHEN, ""), "".join(_PLAIN), "".join(_PLAIN.values()))
    t = F.regexp_replace(t, r"([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])", "$1$2")
    t = F.regexp_replace(t, r"[ \t\r\f\x0B\x{A0}]+", " ")
    t = F.regexp_replace(t, r"\s*\n\s*", " ")
    t = F.regexp_replace(t, r"\s+([,.;:)\]])", "$1")
    t = F.regexp_replace(t, r"([(\[])\s+", "$1")
    return strip(t)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Words, and every other character that isn't blank."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"), F.lit(0))


def blank_tokens(c: Column) -> Column:
    """What blanks separate; none in blank text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def clean(c: Column) -> Column:
    """Without soft hyphens, with single blanks within lines."""
    return strip(F.regexp_replace(F.regexp_replace(c, SOFT_HYPHEN, ""), r"[ \t\x{A0}]+", " "))


def squash(c: Column) -> Column:
    """All white space as single blanks."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def line_key(role: Column, text: Column) -> Column:
    """What makes two transcribed lines the same: role and normalised text, without case."""
    return F.struct(role.alias("role"), F.lower(normalize(text)).alias("text"))


def role_text(lines: Column, roles: list[str]) -> Column:
    """Normalised text of the lines with one of the roles, in order."""
    kept = F.filter(lines, lambda x: x["role"].isin(roles))
    return normalize(F.array_join(F.transform(kept, lambda x: x["text"]), "\n"))


#: Roles of transcribed lines; the first of TEXT_ROLES stands for unknown ones (fixed values).
ROLES = ["running-head", "sidenote", "body", "footnote", "page-number"]
TEXT_ROLES = ["body", "footnote"]


def clean_lines(lines: Column, drop_empty: bool = True) -> Column:
    """Stripped lines; unknown roles are body text."""
    tidy = F.transform(lines, lambda x: F.struct(F.when(x["role"].isin(ROLES), x["role"]).otherwise("body").alias("role"), strip(F.coalesce(x["text"], F.lit(""))).alias("text")))
    return F.filter(tidy, lambda x: x["text"] != "") if drop_empty else tidy


def line_chars(lines: Column) -> Column:
    """Characters of all lines, blanks squashed."""
    return F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(squash(x["text"])))


def numbered_lines(lines: Column) -> Column:
    """Lines as `n. [role] text`, for prompts."""
    return F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". ["), x["role"], F.lit("] "), x["text"])), "\n")


def trim_xml(xml: Column, limit: int) -> Column:
    """The document without its first meta element, cut before the last closing tag within `limit` characters."""
    body = F.regexp_replace(xml, r"(?s)^(.*?)<meta\b.*?</meta>", "$1<meta/>")
    head = F.substring(body, 1, limit)
    back = F.length(head) - F.locate("/<", F.reverse(head)) - 1
    return F.when(F.length(body) <= limit, body).when(F.locate("/<", F.reverse(head)) > 0, head.substr(F.lit(1), back)).otherwise(head)
