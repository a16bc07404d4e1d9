"""Reading of legal XML documents. Namespaces are told apart only where names would clash; bad XML gives NULL."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import ids
from lexmill.functions.fuzzy import arrow_function
from lexmill.functions.text import DASHES, QUOTES, SOFT_HYPHEN

USLM, DC = "http://schemas.gpo.gov/xml/uslm", "http://purl.org/dc/elements/1.1/"
#: Counted structure elements and elements that are no body text (fixed values).
STRUCTURE = ["section", "subsection", "paragraph", "subparagraph", "clause", "subclause", "heading", "content", "note", "sidenote", "table", "page", "quotedContent", "longTitle", "enactingFormula", "action", "p"]
NOT_TEXT = {"meta", "sidenote", "note", "page", "legislativeHistory", "centerRunningHead"}
NOT_PAGE_TEXT = {"meta", "note", "legislativeHistory", "centerRunningHead"}

for _prefix, _uri in (("", USLM), ("dc", DC), ("xsi", "http://www.w3.org/2001/XMLSchema-instance")):
    ET.register_namespace(_prefix, _uri)

_PLAIN = str.maketrans(QUOTES | DASHES | {SOFT_HYPHEN: None})


def normalize_text(text: str) -> str:
    """The same as functions.text.normalize, for use within Python functions."""
    import unicodedata

    t = unicodedata.normalize("NFKC", text).translate(_PLAIN)
    t = re.sub(r"(\w)-\s*\n\s*(\w)", r"\1\2", t)
    t = re.sub(r"[ \t\r\f\v\xa0]+", " ", t)
    t = re.sub(r"\s*\n\s*", " ", t)
    return re.sub(r"([(\[])\s+", r"\1", re.sub(r"\s+([,.;:)\]])", r"\1", t)).strip()


def parse(xml: str | bytes | None) -> ET.Element | None:
    """The root element, with comments and processing instructions kept, so that text after one is a part of its own."""
    if not xml:
        return None
    try:
        return ET.fromstring(xml, ET.XMLParser(target=ET.TreeBuilder(insert_comments=True, insert_pis=True)))
    except (ET.ParseError, ValueError):
        return None


def name(el: ET.Element) -> str:
    """Local name; comments and processing instructions have none."""
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def child(el: ET.Element | None, *path: str) -> ET.Element | None:
    for step in path:
        el = next((c for c in el if name(c) == step), None) if el is not None else None
    return el


def text_of(el: ET.Element | None) -> str:
    return "".join(el.itertext()) if el is not None else ""


def spoken(el: ET.Element, skip: set[str], top: bool = True) -> Iterator[str]:
    """Text parts in document order without the subtrees to skip; what follows those still counts."""
    if name(el) and name(el) not in skip:
        if el.text:
            yield el.text
        for c in el:
            yield from spoken(c, skip, False)
    if not top and el.tail:
        yield el.tail


def body_text(root: ET.Element) -> str:
    main = child(root, "main")
    return normalize_text(" ".join(spoken(root if main is None else main, NOT_TEXT)))


def sections(root: ET.Element) -> list[tuple[str, str]]:
    """Number and first 40 characters of each section."""
    out = []
    for s in (e for e in root.iter() if name(e) == "section"):
        num = child(s, "num")
        value = "" if num is None else num.get("value") or normalize_text(num.text or "")
        parts = [" ".join(c.itertext()) for c in s if c is not num and name(c) and name(c) not in NOT_TEXT]
        out.append((value.strip(), normalize_text(" ".join(parts))[:40]))
    return out


def sidenotes(root: ET.Element) -> list[str]:
    return [normalize_text(" ".join(e.itertext())) for e in root.iter() if name(e) == "sidenote"]


def identifiers(root: ET.Element) -> tuple[list[str], list[str]]:
    """Distinct identifiers of structure elements and of pages, sorted."""
    found: tuple[set[str], set[str]] = (set(), set())
    for e in root.iter():
        if i := name(e) and e.get("identifier"):
            found[name(e) == "page" or i.startswith("/us/stat/")].add(i)
    return sorted(found[0]), sorted(found[1])


def structure_counts(root: ET.Element) -> dict[str, int]:
    counts = dict.fromkeys(STRUCTURE, 0)
    for e in root.iter():
        if name(e) in counts:
            counts[name(e)] += 1
    return counts


def page_label(label: str | None) -> str | None:
    return (re.sub("@.*$", "", label.strip().lower()) or None) if label else None


def page_of(identifier: str | None) -> str | None:
    return page_label(identifier.rpartition("/")[2]) if identifier else None


def page_texts(root: ET.Element, start: str | None = None) -> list[dict[str, str]]:
    """Body and sidenote text by page label, cut at the page markers; text before the first belongs to the start page, if that is known."""
    texts: dict[str, tuple[list[str], list[str]]] = {}
    current = page_label(start)

    def walk(el: ET.Element, top: bool) -> None:
        nonlocal current
        tag = name(el)
        if tag == "page":
            current = page_of(el.get("identifier")) or current
        elif tag == "sidenote":
            add(1, " ".join(el.itertext()))
        elif tag and tag not in NOT_PAGE_TEXT:
            add(0, el.text)
            for c in el:
                walk(c, False)
        if not top:
            add(0, el.tail)

    def add(which: int, text: str | None) -> None:
        if current is not None and text:
            texts.setdefault(current, ([], []))[which].append(text)

    walk(root, True)
    return [{"label": p, "body": normalize_text(" ".join(b)), "sidenote": normalize_text(" ".join(s))} for p, (b, s) in texts.items()]


# ---- columns


def of_document(f: Callable[[ET.Element], object], kind: str) -> Callable[[Column], Column]:
    """A function of a root element as an Arrow function of XML; NULL for NULL and for bad XML."""

    return lambda xml: arrow_function(lambda s: [None if (r := parse(x)) is None else f(r) for x in s], kind, xml)


body_text_col = of_document(body_text, "string")
sections_col = of_document(lambda r: [{"num": n, "start": s} for n, s in sections(r)], "array<struct<num:string,start:string>>")
sidenotes_col = of_document(sidenotes, "array<string>")
identifiers_col = of_document(lambda r: dict(zip(("structure", "pages"), identifiers(r), strict=True)), "struct<structure:array<string>,pages:array<string>>")
structure_col = of_document(structure_counts, "map<string,int>")


def page_texts_col(xml: Column, start: Column) -> Column:
    rows = lambda x, s: [None if (r := parse(a)) is None else page_texts(r, b) for a, b in zip(x, s, strict=True)]
    return arrow_function(rows, "array<struct<label:string,body:string,sidenote:string>>", xml, start)


def is_xml(c: Column) -> Column:
    """Whether it parses; guards the xpath functions, which fail on bad XML."""
    return F.coalesce(of_document(lambda r: True, "boolean")(c), F.lit(False))


# ---- MODS records


def _at(*steps: str) -> str:
    return "/" + "".join(f"/*[local-name()='{s}']" if "[" not in s else f"/*[local-name()='{s.split('[')[0]}'][{s.split('[', 1)[1]}" for s in steps)


def mods_record(xml: Column) -> Column:
    """The fields of a MODS document as a struct, by built-in xpath functions; empty text is NULL, and the record of bad XML is. Lettered pages have labels but no numbers."""
    good = is_xml(xml)

    def text(*steps: str, attr: str = "") -> Column:
        value = F.trim(F.xpath_string(xml, F.lit(_at(*steps) + attr)))
        return F.when(value != "", value)

    def number(*steps: str) -> Column:
        return ids.integer(text(*steps))

    ext = lambda *s: ("extension", *s)
    extent = ("part[@type='article']", "extent[@unit='pages']")
    start, end = text(*extent, "start"), text(*extent, "end")
    spans = F.coalesce(text(*ext("statuteAtLarge", "pages"), attr="/@pages"), F.concat(start, F.lit("-"), F.coalesce(end, F.lit(""))))
    laws, bills = F.xpath_int(xml, F.lit(f"count({_at(*ext('law'))})")), F.xpath_int(xml, F.lit(f"count({_at(*ext('bill'))})"))
    bill = F.struct(*[text(*ext("bill"), attr=f"/@{a}").alias(a) for a in ("type", "number", "congress")])
    root = F.regexp_replace(F.xpath_string(xml, F.lit("/*/@ID")), "^id-", "")
    fields = {
        "granule_id": F.coalesce(text(*ext("accessId")), F.when(root != "", root)), "granule_class": text(*ext("granuleClass")), "title": text("titleInfo", "title"), "number": text(*ext("number")),
        "congress": number(*ext("congress")), "session": number(*ext("session")), "volume": number(*ext("volume")), "page_start_label": start, "page_end_label": end,
        "page_start": ids.page_number(start), "page_end": ids.page_number(end), "page_range": spans, "total_pages": number(*ext("totalPages")), "citation": text("identifier[@type='preferred citation']"),
        "granule_date": text(*ext("granuleDate")), "is_private": F.when(laws > 0, F.coalesce(text(*ext("law"), attr="/@isPrivate") == "true", F.lit(False))),
        "is_appropriation": F.coalesce(text(*ext("isAppropriation")) == "true", F.lit(False)), "chapter": text(*ext("chapter")), "bill": F.when(bills > 0, bill),
        "part_number": number(*ext("partNumber")), "pdf_url": text("location", "url[@displayLabel='PDF rendition']"),
    }
    return F.when(good, F.struct(*[c.alias(k) for k, c in fields.items()]))
