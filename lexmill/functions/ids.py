"""Identifiers, page labels, dates and numerals of the corpus as columns. What can't be parsed is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import squash, strip

# Forms of granule, front and back matter, and law ids.
_GRANULE = r"^STATUTE-(\d+)-Pg([A-Za-z]*)(\d+)(?:-(\d+))?$"
_MATTER = r"^STATUTE-(\d+)-(FrontMatter|BackMatter)-(\d+)-Pg(.+)$"
_PLAW = r"^PLAW-(\d+)(publ|pvtl)(\d+)$"


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """A group of the first match, NULL without a match or with an empty group."""
    g = F.regexp_extract(c, pattern, n)
    return F.when(g != "", g)


def integer(c: Column) -> Column:
    return strip(c.cast("string")).try_cast("int")


def iso_date(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 10).try_cast("date")


def page_number(label: Column) -> Column:
    """Of a page label, its number if it is all digits (`371`, not `B3`)."""
    return group(strip(label), r"^(\d+)$").cast("int")


# ---- granules and pages


def page_label(c: Column) -> Column:
    """Comparable page label: lower case, no language suffix; blank is NULL."""
    label = F.regexp_replace(F.lower(strip(c)), "@.*$", "")
    return F.when(label != "", label)


def page_of_identifier(c: Column) -> Column:
    return page_label(F.substring_index(c, "/", -1))


def page_of_citation(c: Column) -> Column:
    """`64 Stat. B3` gives `b3`."""
    return page_label(group(c, r"Stat\.\s*([A-Za-z]*\d+)"))


def granule_volume(c: Column) -> Column:
    return group(c, r"^STATUTE-(\d+)-").cast("int")


def granule_page(c: Column) -> Column:
    """Start page label of a granule id; NULL for front and back matter."""
    return page_label(F.concat(F.regexp_extract(c, _GRANULE, 2), group(c, _GRANULE, 3)))


def granule_ordinal(c: Column) -> Column:
    """Position among the granules that start on the page, from 1."""
    return F.when(c.rlike(_GRANULE), F.coalesce(group(c, _GRANULE, 4).cast("int"), F.lit(1)))


def granule_id(volume: Column, page: Column, ordinal: Column) -> Column:
    base = F.concat(F.lit("STATUTE-"), volume.cast("string"), F.lit("-Pg"), F.upper(page))
    return F.when(ordinal == 1, base).otherwise(F.concat(base, F.lit("-"), ordinal.cast("string")))


def matter_parts(c: Column) -> Column:
    """Kind and part of a front or back matter id; NULL for others."""
    return F.when(c.rlike(_MATTER), F.struct(F.regexp_extract(c, _MATTER, 2).alias("kind"), F.regexp_extract(c, _MATTER, 3).cast("int").alias("part")))


def page_sort_key(c: Column) -> Column:
    """Natural order of granule ids: letters, number, position; other ids come last."""
    return F.when(
        c.rlike(_GRANULE),
        F.struct(F.lower(F.regexp_extract(c, _GRANULE, 2)).alias("prefix"), F.regexp_extract(c, _GRANULE, 3).cast("int").alias("page"), granule_ordinal(c).alias("position")),
    ).otherwise(F.struct(F.lit("~").alias("prefix"), F.lit(0).alias("page"), F.lit(0).alias("position")))


def package_of_granule(c: Column) -> Column:
    return group(c, r"^(STATUTE-\d+)-Pg.+$")


def stat_page_label(start: Column, pdf_page: Column) -> Column:
    """Label of a granule's pdf_page-th page, from the label of its first page."""
    prefix, number = F.regexp_extract(start, r"^([A-Za-z]*)(\d+)$", 1), group(start, r"^([A-Za-z]*)(\d+)$", 2).cast("int")
    return F.concat(prefix, (number + pdf_page - 1).cast("string"))


def page_identifier(volume: Column, page: Column) -> Column:
    return F.concat(F.lit("/us/stat/"), volume.cast("string"), F.lit("/"), F.lower(page.cast("string")))


# ---- laws


def plaw_congress(c: Column) -> Column:
    return group(c, _PLAW, 1).cast("int")


def plaw_number(c: Column) -> Column:
    return group(c, _PLAW, 3).cast("int")


def plaw_is_private(c: Column) -> Column:
    return F.when(c.rlike(_PLAW), F.regexp_extract(c, _PLAW, 2) == "pvtl")


def pl_number(c: Column) -> Column:
    """`PLAW-118publ5` gives `118-5`, a private law `118-pvt3`."""
    return F.concat(group(c, _PLAW, 1), F.when(plaw_is_private(c), "-pvt").otherwise("-"), group(c, _PLAW, 3))


def law_copy_path(c: Column) -> Column:
    """Where the other publisher keeps its copy of a law, relative to its root."""
    return F.concat_ws("/", group(c, _PLAW, 1), F.lit("plaws"), F.concat(group(c, _PLAW, 2), group(c, _PLAW, 3)), F.concat(c, F.lit("_uslm.xml")))


def law_identifier(congress: Column, number: Column, private: Column) -> Column:
    ok = (congress > 0) & (number > 0)
    return F.when(ok, F.concat_ws("/", F.lit("/us"), F.when(private, "pvtl").otherwise("pl"), congress.cast("string"), number.cast("string")))


#: Years of the first public law numbers, and of the last chapter numbers (fixed values).
FIRST_NUMBERED_YEAR, LAST_CHAPTER_YEAR = 1901, 1957


def law_identifiers(congress: Column, number: Column, private: Column, approved: Column, chapter: Column, is_law: Column) -> Column:
    """Primary and alternate identifier: acts by date and chapter before public laws were numbered, both while chapters lasted, then by number."""
    by_number = F.when(is_law, law_identifier(congress, number, private))
    by_chapter = F.when(is_law & approved.isNotNull() & chapter.isNotNull(), F.concat(F.lit("/us/act/"), F.date_format(approved, "yyyy-MM-dd"), F.lit("/ch"), chapter))
    year = F.year(approved)
    early = F.coalesce(year < FIRST_NUMBERED_YEAR, F.lit(False))
    both = by_number.isNotNull() & by_chapter.isNotNull() & F.coalesce(year <= LAST_CHAPTER_YEAR, F.lit(False))
    return F.struct(F.when(early, by_chapter).otherwise(F.coalesce(by_number, by_chapter)).alias("primary"), F.when(~early & both, by_chapter).alias("alternate"))


def slug(c: Column) -> Column:
    return F.concat(F.lit("id"), F.regexp_replace(c, "[^A-Za-z0-9]+", "_"))


# ---- numerals, dates, headings

#: Values of Roman numerals (fixed values).
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def roman_value(c: Column) -> Column:
    """Value of a Roman numeral by the subtractive rule, however it is written; NULL if it has other characters."""
    s = F.lower(strip(c))
    value = F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])
    digits = F.transform(F.filter(F.split(s, ""), lambda x: x != ""), lambda x: value[x])
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("right"))
    total = F.aggregate(F.reverse(digits), start, lambda a, v: F.struct((a["sum"] + F.when(v < a["right"], -v).otherwise(v)).alias("sum"), v.alias("right")), lambda a: a["sum"])
    return F.when(s.rlike("^[ivxlcdm]+$"), total)


def chapter_number(c: Column) -> Column:
    """A chapter's number as digits, from digits or a Roman numeral."""
    s = F.regexp_replace(strip(c), r"\.+$", "")
    return F.coalesce(group(s, r"^(\d+)$"), F.nullif(roman_value(s), F.lit(0)).cast("string"))


def us_date(c: Column) -> Column:
    """`March 3, 1853` or `Mar. 3, 1853` as a date."""
    t = strip(F.regexp_replace(c, r"\.", ""))
    return F.coalesce(F.try_to_date(t, "MMMM d, yyyy"), F.try_to_date(t, "MMM d, yyyy"))


def ordinal(c: Column) -> Column:
    teen = (c % 100).between(10, 20)
    end = F.when(~teen & (c % 10 == 1), "st").when(~teen & (c % 10 == 2), "nd").when(~teen & (c % 10 == 3), "rd").otherwise("th")
    return F.concat(c.cast("string"), end)


# Headings in capitals before a dash, and of sections.
DASH_HEADING = r"(?s)^([A-Z][A-Z0-9 ,;'’\-]{2,}?)\.\s*[-—–]+\s*(.*)$"
SECTION_HEADING = r"(?s)^([A-Z0-9][A-Z0-9 ,;:'’\-()]{3,}?\.)(?:\s+(.*))?$"


def split_heading(c: Column) -> Column:
    """`IN GENERAL.-For purposes` as heading and text."""
    hit = c.rlike(DASH_HEADING)
    return F.struct(
        F.when(hit, F.concat(strip(F.regexp_extract(c, DASH_HEADING, 1)), F.lit("."))).alias("heading"),
        F.when(hit, strip(F.regexp_extract(c, DASH_HEADING, 2))).otherwise(c).alias("text"),
    )


def split_section_heading(c: Column) -> Column:
    """A leading run of capitals that ends with a period is the heading."""
    hit = c.rlike(SECTION_HEADING)
    return F.struct(F.when(hit, strip(F.regexp_extract(c, SECTION_HEADING, 1))).alias("heading"), F.when(hit, strip(F.regexp_extract(c, SECTION_HEADING, 2))).otherwise(c).alias("text"))


#: What a level's number looks like in its text, and the characters a number's value has (fixed values).
NUMBER_FORMS = (r"(?i)^(?:SEC(?:TION)?\.?\s*)?(\d+[A-Za-z]?)\.?$", r"^\(([A-Za-z0-9]{1,4})\)$")
NUMBER_CHARACTERS = "A-Za-z0-9.\\-"


def num_value(value: Column, text: Column) -> Column:
    """Number of a level: its value attribute without odd characters, else what its text says."""
    t = squash(text)
    return F.when(value != "", F.regexp_replace(strip(value), f"[^{NUMBER_CHARACTERS}]", "")).otherwise(F.coalesce(*[group(t, p) for p in NUMBER_FORMS]))


#: Roman numerals of levels (fixed values).
_ROMAN_LEVEL = r"^(i{1,3}|iv|v|vi{0,3}|ix|x{1,3}|xi{1,3}|xiv|xv)$"


def level_of(designator: Column, current: Column) -> Column:
    """Level of a parenthesised designator, given the level it follows (NULL: none)."""
    low = current.isin("subparagraph", "clause")
    top = current.isNull() | current.isin("section", "subsection")
    return (
        F.when(designator.rlike(r"^\d+$"), F.when(current.isin("clause", "subclause"), "subclause").otherwise("paragraph"))
        .when(designator.rlike(_ROMAN_LEVEL) & low, "clause")
        .when(designator.rlike("^[a-z]+$"), F.when(~top & low, "clause").otherwise("subsection"))
        .when(designator.rlike("^[A-Z]+$"), "subparagraph")
        .otherwise("subsection")
    )


# ---- profiles, ranges, numbers of pages


def profile_family(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def profile_variant(c: Column) -> Column:
    """What follows the first colon; NULL without one."""
    return group(c, r"(?s)^[^:]*:(.+)$")


def profile_folder(c: Column) -> Column:
    return F.regexp_replace(c, "[:/]", "-")


def psm_of_variant(c: Column) -> Column:
    """Page segmentation mode of a variant such as `psm6`."""
    return group(c, r"^psm(\d+)$").cast("int")


def unit_stem(stem: Column, first: Column, last: Column, tag: Column) -> Column:
    """File stem of a work unit: the document's, its page range and its tag."""
    pages = F.when(first.isNotNull(), F.concat(F.lit("-p"), first.cast("string"), F.lit("-"), last.cast("string"))).otherwise("")
    return F.concat(stem, pages, F.coalesce(F.concat(F.lit("-"), tag), F.lit("")))


def page_range(c: Column) -> Column:
    """`3` or `3-7` as first and last page; NULL if it is no range, or reversed, or begins before 1."""
    first = group(c, r"^\s*(\d+)\s*(?:-\s*\d+\s*)?$").cast("int")
    last = F.coalesce(group(c, r"^\s*\d+\s*-\s*(\d+)\s*$").cast("int"), first)
    return F.when((first >= 1) & (last >= first), F.struct(first.alias("first"), last.alias("last")))


def volume_list(c: Column) -> Column:
    """`1-3,7` as sorted distinct numbers; a reversed range or something else is an error."""
    parts = F.filter(F.transform(F.split(c, ","), lambda t: strip(t)), lambda t: t != "")

    def expand(t: Column) -> Column:
        lo = F.regexp_extract(t, r"^(\d+)", 1).try_cast("int")
        hi = F.coalesce(group(t, r"-\s*(\d+)$").cast("int"), lo)
        ok = t.rlike(r"^\d+(\s*-\s*\d+)?$") & (hi >= lo)
        return F.when(ok, F.sequence(lo, hi)).otherwise(F.raise_error(F.concat(F.lit("bad range "), t)).cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, expand))))


def byte_ranges(size: Column, parts: Column, least: int) -> Column:
    """[0, size) as at most `parts` closed ranges, none below `least` bytes unless the file is; lengths differ by one at most, longer ones first."""
    n = F.greatest(F.lit(1), F.least(parts, F.greatest(F.lit(1), F.floor(size / least)))).cast("long")
    base, rest = F.floor(size / n), size % n
    one = lambda i: F.struct((i * base + F.least(i, rest)).cast("long").alias("first"), ((i + 1) * base + F.least(i + 1, rest) - 1).cast("long").alias("last"))
    return F.when(size > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), one)).when(size == 0, F.array().cast("array<struct<first:bigint,last:bigint>>")).otherwise(F.raise_error("size must not be negative").cast("array<struct<first:bigint,last:bigint>>"))


def part_status(size: Column, expected: Column) -> Column:
    """State of a downloaded part: missing, partial, complete or oversize."""
    return F.when(size.isNull(), "missing").when(size < expected, "partial").when(size == expected, "complete").otherwise("oversize")


# ---- eras and periods

#: Eras and periods as closed ranges of volumes, the volumes that are scanned, and granule classes (fixed values).
ERAS = [("scanned-pre-1951", 1, 64), ("scanned-1951-2002", 65, 116), ("digital-2003+", 117, 137)]
PERIODS = [("1789-1850", 1, 9), ("1851-1900", 10, 31), ("1901-1950", 32, 64), ("1951-1975", 65, 89), ("1976-2002", 90, 116)]
LAST_SCANNED = 116
CLASSES = ["PUBLICLAW", "PRIVATELAW", "PROCLAMATION", "TREATY", "HCONRES", "SCONRES"]
ERA_CLASSES = {"digital-2003+": ["PUBLICLAW", "PRIVATELAW"]}


def _bucket(volume: Column, ranges: list[tuple[str, int, int]]) -> Column:
    out = F.lit(None).cast("string")
    for name, lo, hi in reversed(ranges):
        out = F.when(volume.between(lo, hi), name).otherwise(out)
    return out


def era(volume: Column) -> Column:
    return _bucket(volume, ERAS)


def period(volume: Column) -> Column:
    return _bucket(volume, PERIODS)


def is_scanned(volume: Column) -> Column:
    return volume <= LAST_SCANNED


def boundary_volumes() -> list[int]:
    """First and last volumes of the periods."""
    return sorted({v for _, lo, hi in PERIODS for v in (lo, hi)})


def class_allowed(era_: Column, granule_class: Column) -> Column:
    """Whether granules of the class have a reference text of their own in the era."""
    ok = granule_class.isin(CLASSES)
    for name, allowed in ERA_CLASSES.items():
        ok = ok & ((era_ != name) | granule_class.isin(allowed))
    return F.coalesce(ok, F.lit(False))


def default_profile(volume: Column) -> Column:
    return F.when(volume <= LAST_SCANNED, "scanned").otherwise("digital")


def issued_on_or_after(issued: Column, floor: Column) -> Column:
    """Date floor that keeps missing and unreadable dates."""
    return F.coalesce(iso_date(issued) >= floor, F.lit(True))
