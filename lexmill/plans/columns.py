"""Queries of the scalar functions and small operators over the tables, with DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import costs, fuzzy, ids, markers, text
from lexmill.operators import catalog, layout, metrics, report
from lexmill.plans.reference import _GRANULES, _ID, _PACKAGES, _VOLUME, _granules, _items, _packages, _quote
from lexmill.session import latest, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


_LINES = "select distinct item_id, coalesce(text, orig) t from page_items"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_items").select("item_id", F.coalesce("text", "orig").alias("t")).distinct()


# ---- ids and page labels


@query(f"""
with g as ({_GRANULES}), v as (select granule_id, {_VOLUME} volume from g)
select granule_id, volume, (row_number() over (partition by volume order by case when regexp_matches(granule_id, {_ID}) then lower(regexp_extract(granule_id, {_ID}, 2)) else '~' end,
  coalesce(try_cast(regexp_extract(granule_id, {_ID}, 3) as int), 0), case when regexp_matches(granule_id, {_ID}) then coalesce(try_cast(nullif(regexp_extract(granule_id, {_ID}, 4), '') as int), 1) else 0 end, granule_id))::int place from v""")
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    """Granules in the natural order of their page labels."""
    w = Window.partitionBy("volume").orderBy(ids.page_sort_key(F.col("granule_id")), "granule_id")
    return _granules(spark, d).select("granule_id", "volume", F.row_number().over(w).alias("place"))


@query(f"""
with g as ({_GRANULES}) select granule_id, nullif(lower(regexp_replace(trim(citation), '@.*$', '')), '') label, nullif(lower(regexp_extract(citation, 'Stat\\.\\s*([A-Za-z]*[0-9]+)', 1)), '') cited_page,
  try_cast(trim(number) as int) number, try_cast(substring(date_issued::varchar, 1, 10) as date) issued, lower(regexp_extract('/us/stat/9/' || page_range, '[^/]*$')) identifier_page from g""")
def label_forms(spark: SparkSession, d: str) -> DataFrame:
    """Page labels of citations and identifiers, numbers and dates that may not be ones."""
    c = F.col
    return _granules(spark, d).select("granule_id", ids.page_label(c("citation")).alias("label"), ids.page_of_citation(c("citation")).alias("cited_page"), ids.integer(c("number")).alias("number"), ids.iso_date(c("date_issued")).alias("issued"),
                                      ids.page_of_identifier(F.concat(F.lit("/us/stat/9/"), c("page_range"))).alias("identifier_page"))


_R = "upper(regexp_extract(t, '(?i)\\b(m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3}))\\b[.]', 1))"
_DIGIT = "case substr(s, i::int, 1) when 'I' then 1 when 'V' then 5 when 'X' then 10 when 'L' then 50 when 'C' then 100 when 'D' then 500 when 'M' then 1000 else 0 end"


@query(f"""
with l as (select item_id, {_R} s from ({_LINES}) where t is not null), r as (select distinct s from l where s <> ''),
v as (select s, sum(case when {_DIGIT} < {_DIGIT.replace('i::int', 'i::int + 1')} then -({_DIGIT}) else {_DIGIT} end)::int v from (select s, unnest(range(1, len(s) + 1)) i from r) group by s)
select item_id, v roman, v::varchar chapter from l join v using (s)""")
def roman_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Values of the first Roman numeral with a period in each line, and chapter numbers made of them."""
    s = F.upper(F.regexp_extract("t", r"(?i)\b(m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3}))\b[.]", 1))
    found = _lines(spark, d).select("item_id", s.alias("s")).where("s <> ''")
    return found.select("item_id", ids.roman_value(F.col("s")).alias("roman"), ids.chapter_number(F.concat("s", F.lit("."))).alias("chapter"))


_SECTION_HEADING = _quote(r"(?s)^([A-Z0-9][A-Z0-9 ,;:'’\-()]{3,}?\.)(?:\s+(.*))?$")


@query(f"""
select item_id, case when h then trim(regexp_extract(t, {_SECTION_HEADING}, 1)) end heading, case when h then trim(regexp_extract(t, {_SECTION_HEADING}, 2)) else t end rest
from (select *, regexp_matches(t, {_SECTION_HEADING}) h from ({_LINES}) where t is not null)""")
def section_headings(spark: SparkSession, d: str) -> DataFrame:
    """Headings in capitals at a line's begin."""
    h = ids.split_section_heading(F.col("t"))
    return _lines(spark, d).where("t is not null").select("item_id", h["heading"].alias("heading"), h["text"].alias("rest"))


_LEVELS = ["section", "subsection", "paragraph", "subparagraph", "clause", "subclause"]
_DES = _quote(r"^\(([A-Za-z]{1,4}|[0-9]{1,3})\)")


@query(f"""
with l as (select item_id, regexp_extract(t, {_DES}, 1) x, case item_id % 7 {' '.join(f"when {i} then '{v}'" for i, v in enumerate(_LEVELS))} end cur from ({_LINES}) where regexp_matches(t, {_DES}))
select item_id, x designator, cur "current", case when regexp_matches(x, '^[0-9]+$') then case when cur in ('clause', 'subclause') then 'subclause' else 'paragraph' end
  when regexp_matches(x, '^(i{{1,3}}|iv|v|vi{{0,3}}|ix|x{{1,3}}|xi{{1,3}}|xiv|xv)$') and cur in ('subparagraph', 'clause') then 'clause'
  when regexp_matches(x, '^[a-z]+$') then case when cur in ('subparagraph', 'clause') then 'clause' else 'subsection' end when regexp_matches(x, '^[A-Z]+$') then 'subparagraph' else 'subsection' end level from l""")
def designator_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels of parenthesised designators, each after one of the levels or none."""
    now = F.lit(None).cast("string")
    for i, v in enumerate(_LEVELS):
        now = F.when(F.pmod("item_id", F.lit(7)) == i, v).otherwise(now)
    x = _lines(spark, d).where(F.col("t").rlike(r"^\(([A-Za-z]{1,4}|[0-9]{1,3})\)")).select("item_id", F.regexp_extract("t", r"^\(([A-Za-z]{1,4}|[0-9]{1,3})\)", 1).alias("designator"), now.alias("current"))
    return x.withColumn("level", ids.level_of(F.col("designator"), F.col("current")))


@query(f"""
with l as (select item_id, trim(regexp_replace(regexp_extract(t, '^[^ ]+( [^ ]+)?'), '\\s+', ' ', 'g')) s, case when item_id % 3 = 0 then regexp_extract(t, '^[^ ]+') else '' end v from ({_LINES}) where t is not null)
select item_id, case when v <> '' then regexp_replace(trim(v), '[^A-Za-z0-9.\\-]', '', 'g') else coalesce(nullif(regexp_extract(s, '(?i)^(?:SEC(?:TION)?\\.?\\s*)?([0-9]+[A-Za-z]?)\\.?$', 1), ''), nullif(regexp_extract(s, '^\\(([A-Za-z0-9]{{1,4}})\\)$', 1), '')) end number from l""")
def number_values(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of levels, from a value attribute (every third line's first word) or the first two words."""
    s, v = F.regexp_extract("t", "^[^ ]+( [^ ]+)?", 0), F.regexp_extract("t", "^[^ ]+", 0)
    return _lines(spark, d).where("t is not null").select("item_id", ids.num_value(F.when(F.pmod("item_id", F.lit(3)) == 0, v).otherwise(""), s).alias("number"))


@query("""
with u as (select distinct unit_id, profile, page_range from units)
select unit_id, profile, page_range, split_part(profile, ':', 1) family, nullif(regexp_extract(profile, '(?s)^[^:]*:(.+)$', 1), '') variant, replace(replace(profile, ':', '-'), '/', '-') folder,
  nullif(regexp_extract(regexp_extract(profile, '(?s)^[^:]*:(.+)$', 1), '^psm([0-9]+)$', 1), '') psm, case when r and a >= 1 and b >= a then a end "first", case when r and a >= 1 and b >= a then b end "last",
  unit_id || case when r and a >= 1 and b >= a then '-p' || a || '-' || b else '' end || coalesce('-' || nullif(regexp_extract(profile, '@(.*)$', 1), ''), '') stem
from (select *, regexp_matches(page_range, '^\\s*[0-9]+\\s*(-\\s*[0-9]+\\s*)?$') r, try_cast(regexp_extract(page_range, '^\\s*([0-9]+)', 1) as int) a, coalesce(try_cast(regexp_extract(page_range, '-\\s*([0-9]+)\\s*$', 1) as int), try_cast(regexp_extract(page_range, '^\\s*([0-9]+)', 1) as int)) b from u)""")
def unit_names(spark: SparkSession, d: str) -> DataFrame:
    """Families, variants, folders, page ranges and file stems of units."""
    p, r = F.col("profile"), ids.page_range(F.col("page_range"))
    tag = F.nullif(F.regexp_extract(p, "@(.*)$", 1), F.lit(""))
    u = table(spark, d, "units").select("unit_id", "profile", "page_range").distinct().withColumn("first", r["first"]).withColumn("last", r["last"])
    return u.select("*", ids.profile_family(p).alias("family"), ids.profile_variant(p).alias("variant"), ids.profile_folder(p).alias("folder"), ids.psm_of_variant(ids.profile_variant(p)).alias("psm"), ids.unit_stem(F.col("unit_id"), F.col("first"), F.col("last"), tag).alias("stem"))


@query("""
with p as (select distinct package_id, congress a, coalesce(session, 1) s from packages where package_id is not null and congress is not null)
select package_id, a, s, list_sort(list_distinct(list_concat(range(a, a + s + 1), [a::bigint + 1, 7]))) volumes from p""".replace("select package_id, a, s, list_sort", "select package_id, a congress, s as session, array_to_string(list_sort").replace("7])))", "7]))), ' ')"))
def volume_lists(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of lists such as `7, 81-83, 82`."""
    p = table(spark, d, "packages").where("package_id is not null and congress is not null").select("package_id", "congress", F.coalesce("session", F.lit(1)).alias("session")).distinct()
    said = F.format_string(" 7, %d-%d,%d", F.col("congress"), F.col("congress") + F.col("session"), F.col("congress") + 1)
    return p.withColumn("volumes", F.array_join(ids.volume_list(said).cast("array<string>"), " "))


# ---- texts

_SPACE = "[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0085}\\x{000B}\\x{001C}-\\x{001F}]"


def _sql_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


@query(f"""
select item_id, {_sql_strip("regexp_replace(replace(t, chr(173), ''), '[ \\t\\x{00A0}]+', ' ', 'g')")} clean, {_sql_strip(f"regexp_replace(t, '{_SPACE}+', ' ', 'g')")} squashed,
  len(list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> ''))::int words from (select distinct item_id, orig t from page_items where orig is not null)""")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "page_items").where("orig is not null").select("item_id", F.col("orig").alias("t")).distinct()
    return o.select("item_id", text.clean(F.col("t")).alias("clean"), text.squash(F.col("t")).alias("squashed"), F.size(text.blank_tokens(F.col("t"))).alias("words"))


_PAGE_LINES = "select granule_id, page_no, item_no, item_id, case when item_no % 4 = 0 then 'sidenote' when item_no % 4 = 1 then 'odd' else 'body' end as role, trim(regexp_replace(t, '\\s+', ' ', 'g')) t from (select distinct granule_id, page_no, item_no, item_id, regexp_replace(coalesce(text, orig), '[^a-zA-Z0-9 ]', '', 'g') t from page_items where granule_id is not null)"


def _page_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Each page's lines as an array of (role, text); plain letters, digits and blanks only, which both engines treat alike."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", "orig"), "[^a-zA-Z0-9 ]", ""), r"\s+", " "))
    role = F.when(F.col("item_no") % 4 == 0, "sidenote").when(F.col("item_no") % 4 == 1, "odd").otherwise("body")
    i = table(spark, d, "page_items").where("granule_id is not null").select("granule_id", "page_no", "item_no", "item_id", role.alias("role"), t.alias("text")).distinct()
    every = F.array_sort(F.collect_list(F.struct("item_no", "item_id", "role", "text")))
    return i.groupBy("granule_id", "page_no").agg(F.transform(every, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("lines"))


@query(f"""
with p as ({_PAGE_LINES}), c as (select * exclude role, case when role = 'odd' then 'body' else role end as role from p where t <> ''), n as (select *, row_number() over (partition by granule_id, page_no order by item_no, item_id) n from c),
every as (select distinct granule_id, page_no from p),
s as (select granule_id, page_no, coalesce(string_agg(t, ' ' order by item_no, item_id) filter (role = 'body'), '') body, coalesce(string_agg(t, ' ' order by item_no, item_id) filter (role = 'sidenote'), '') sidenote, sum(length(t))::int chars,
  string_agg(n || '. [' || role || '] ' || t, chr(10) order by n) said from n group by 1, 2)
select granule_id, page_no, coalesce(body, '') body, coalesce(sidenote, '') sidenote, coalesce(chars, 0)::int chars, coalesce(said, '') said from every left join s using (granule_id, page_no)""")
def page_line_texts(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned lines of each page: body and sidenote text, characters, and the numbered form for prompts."""
    c = _page_arrays(spark, d).withColumn("lines", text.clean_lines(F.col("lines")))
    return c.select("granule_id", "page_no", text.role_text(F.col("lines"), text.TEXT_ROLES).alias("body"), text.role_text(F.col("lines"), ["sidenote"]).alias("sidenote"), text.line_chars(F.col("lines")).alias("chars"), text.numbered_lines(F.col("lines")).alias("said"))


@query(f"with p as ({_PAGE_LINES}) select role, lower(t) as text, count(*) lines from p group by 1, 2")
def line_keys(spark: SparkSession, d: str) -> DataFrame:
    """Lines that count as the same, by role and text."""
    lines = _page_arrays(spark, d).select(F.inline("lines"))
    return lines.groupBy(text.line_key(F.col("role"), F.col("text")).alias("k")).agg(F.count("*").alias("lines")).select("k.role", "k.text", "lines")


_TRIM = 60


@query(f"""
with x as (select item_id, '<a><meta><n>' || item_id || '</n></meta><p>' || t || '</p><q>' || t || '</q></a>' x from (select item_id, regexp_replace(t, '[^a-zA-Z0-9 ]', '', 'g') t from ({_LINES}) where t is not null)),
b as (select item_id, regexp_replace(x, '(?s)^(.*?)<meta\\b.*?</meta>', '\\1<meta/>') b from x)
select item_id, case when length(b) <= {_TRIM} then b when instr(reverse(b[:{_TRIM}]), '/<') > 0 then b[:{_TRIM} - instr(reverse(b[:{_TRIM}]), '/<') - 1] else b[:{_TRIM}] end short from b""")
def trimmed_xml(spark: SparkSession, d: str) -> DataFrame:
    """Documents without metadata, cut before a closing tag."""
    t = F.regexp_replace("t", "[^a-zA-Z0-9 ]", "")
    x = F.concat(F.lit("<a><meta><n>"), F.col("item_id").cast("string"), F.lit("</n></meta><p>"), t, F.lit("</p><q>"), t, F.lit("</q></a>"))
    return _lines(spark, d).where("t is not null").select("item_id", text.trim_xml(x, _TRIM).alias("short"))


# ---- signs of lines


def _like(word: str, right: str, least: float) -> str:
    """SQL: whether the common subsequence of a word and the right one makes them `least` alike (200 x length / both lengths)."""
    subs = sorted({"".join(c for k, c in enumerate(right) if mask >> k & 1) for mask in range(1, 1 << len(right))}, key=lambda s: (-len(s), s))
    lcs = "case " + " ".join(f"when regexp_matches({word}, '{'|'.join('.*'.join(s) for s in subs if len(s) == n)}') then {n}" for n in range(len(right), 0, -1)) + " else 0 end"
    return f"(200.0 * ({lcs}) / (length({word}) + {len(right)}) >= {least})"


def _hit(*patterns: str) -> str:
    return " or ".join(f"regexp_matches(t, {_quote(p)})" for p in patterns)


@query(f"""
with l as (select *, regexp_matches(t, {_quote(markers.CHAPTER)}) chap, trim(regexp_extract(t, {_quote(markers.CHAPTER)}, 2)) rest, regexp_matches(t, {_quote(markers.CHAPTER_DAMAGED)}) dam, lower(regexp_extract(t, {_quote(markers.CHAPTER_DAMAGED)}, 1)) w,
  regexp_matches(t, {_quote(markers.CLOSING)}) clo, trim(regexp_replace(lower(regexp_extract(t, {_quote(markers.CLOSING)}, 1)), '\\s+', ' ', 'g')) verb, regexp_extract(t, {_quote(markers.CLOSING)}, 2) said from ({_LINES}) where t is not null),
s as (select *, {_hit(markers.PUBLIC_LAW, markers.PRIVATE_LAW, markers.DOC_TITLE, markers.PROCLAMATION)} or (chap and (regexp_matches(t, '^\\s*[\\[({{]') or rest = '' or regexp_matches(rest, {_quote(markers.CHAPTER_TITLE)})))
  or (not chap and dam and (w = '' or {_like('w', 'chap', markers.LIKE_CHAP)} or {_like('w', 'chapter', markers.LIKE_CHAPTER)})) starts,
  clo and (verb in ('approved', 'agreed to', 'passed') or (regexp_matches(said, {_quote(markers.MONTH_FIRST)}) and {_like('verb', 'approved', markers.LIKE_APPROVED)})) ends from l)
select item_id, starts, ends, starts or {_hit(markers.WHEREAS, markers.ENACTING, markers.SECTION)} signals from s""")
def line_signs(spark: SparkSession, d: str) -> DataFrame:
    """Which lines begin or close a document, or show that one has begun."""
    return markers.line_signs(_lines(spark, d).where("t is not null"), "t").select("item_id", "starts", "ends", "signals")


# ---- costs and scores


@query("""
with t as (select distinct result_id, coalesce(pages, 1) p, result_id % 7 k from unit_results)
select result_id, ceil((p * 100) * 800 / 750)::bigint tokens, round((ceil((p * 100) * 800 / 750) + 400) * 3.0 / 1e6 + 1500 * 15.0 / 1e6, 8)::double projected, least(60.0, power(2.0, k))::double delay,
  round(least(100, greatest(0, p * 3.0 - 10)), 4)::double as text, round((least(100, greatest(0, p * 3.0 - 10)) + least(100, greatest(0, k * 20.0)) + 50) / 3, 1)::double overall, case when p % 5 = 0 then 1.0 else round((p - 1)::double / (p + 3), 4) end::double kept from t""")
def cost_columns(spark: SparkSession, d: str) -> DataFrame:
    """Projected costs, delays between attempts, scores within bounds, and kept characters."""
    p, k = F.col("p"), F.col("k")
    t = table(spark, d, "unit_results").select("result_id", F.coalesce("pages", F.lit(1)).alias("p"), F.pmod("result_id", F.lit(7)).alias("k")).distinct()
    j = report.judge_scores(p * 3.0 - 10, k * 20.0, F.lit(50.0))
    kept = report.character_accounts(F.when(p % 5 == 0, 0).otherwise(p + 3), p - 1)
    return t.select("result_id", costs.image_tokens(p * 100, F.lit(800)).alias("tokens"), F.round(costs.projected_page_cost(p * 100, F.lit(800), F.lit("x"), {"x": (3.0, 15.0, 0.0, 0.0)}, "x"), 8).alias("projected"), costs.retry_delay(k).alias("delay"),
                    F.round(j["text"], 4).alias("text"), F.round(j["overall"], 1).alias("overall"), kept.alias("kept"))


_TEXTS = "t as (select distinct item_id, granule_id, page_no, item_no, profile from (select *, case item_no % 3 when 0 then 'digital' when 1 then 'scanned' else 'vlm' end profile from page_items where granule_id is not null and page_no is not null))"
_CLEAN = "regexp_replace({c}, '[^a-zA-Z0-9 ]', '', 'g')"


@query(f"""
with r as (select distinct item_id, {_CLEAN.format(c='orig')} b, {_CLEAN.format(c='text')} a from page_items)
select item_id, round(case when b <> '' and a is not null then levenshtein(b, a) / length(b) end, 6) cer, round(case when b <> '' and a is not null then levenshtein(b, a) / length(b) end, 6) sidenote_cer from r""")
def page_scores(spark: SparkSession, d: str) -> DataFrame:
    """Error rates of candidate texts; none where a text is missing."""
    p = lambda c: F.regexp_replace(c, "[^a-zA-Z0-9 ]", "")
    r = table(spark, d, "page_items").select("item_id", p("orig").alias("ref_body"), p("text").alias("body")).distinct()
    s = metrics.score_pages(r.select("item_id", "ref_body", "body", F.col("ref_body").alias("ref_sidenote"), F.col("body").alias("sidenote")))
    return s.select("item_id", F.round("cer", 6).alias("cer"), F.round("sidenote_cer", 6).alias("sidenote_cer"))


@query("""
with g as (select granule_id, page_start p, lower(case when page_start % 4 = 0 then null else 'B' || page_start end) label, coalesce(page_start, 0) % 3 k, volume from (select *, try_cast(regexp_extract(granule_id, '^STATUTE-([0-9]+)-', 1) as int) volume from granules qualify row_number() over (partition by granule_id order by updated_at desc) = 1)),
v as (select distinct volume, label from g where k = 0 and label is not null), s as (select distinct granule_id, label from g where k <= 1 and label is not null)
select g.granule_id, case when g.label is null then 'no page label' when v.label is not null then 'volume' when s.label is not null then 'slice' else 'no text for the page' end source,
  case when v.label is not null then 'v' || g.label when s.label is not null then 's' || g.label end body from g left join v on g.volume = v.volume and g.label = v.label left join s on g.granule_id = s.granule_id and g.label = s.label""")
def first_available(spark: SparkSession, d: str) -> DataFrame:
    """Publisher texts of pages: from the volume, else from the granule's slice, else why there is none."""
    g = _granules(spark, d).select("granule_id", "volume", F.when(F.col("page_start") % 4 == 0, None).otherwise(F.concat(F.lit("B"), F.col("page_start").cast("string"))).alias("stat_page"), (F.coalesce("page_start", F.lit(0)) % 3).alias("k"))
    label = F.lower("stat_page")
    v = g.where("k = 0 and stat_page is not null").select("volume", label.alias("label")).distinct().select("*", F.concat(F.lit("v"), "label").alias("body"), F.lit("").alias("sidenote"))
    s = g.where("k <= 1 and stat_page is not null").select("granule_id", label.alias("label")).distinct().select("*", F.concat(F.lit("s"), "label").alias("body"), F.lit("").alias("sidenote"))
    return report.first_available(g.drop("k"), v, s).select("granule_id", "source", "body")


@query(f"""
with {_TEXTS}, c as (select granule_id, page_no pdf_page, profile candidate, count(*) n from t group by all)
select granule_id, pdf_page, max(case when candidate = 'digital' then printf('%.3f', n / 7.0) end) digital, max(case when candidate = 'scanned' then case when n > 3 then 'text' else printf('%.3f', n / 7.0) end end) scanned from c where candidate in ('digital', 'scanned') group by 1, 2""")
def page_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pages by candidates: error rates or why there is none."""
    profile = F.when(F.col("item_no") % 3 == 0, "digital").when(F.col("item_no") % 3 == 1, "scanned").otherwise("vlm")
    t = table(spark, d, "page_items").where("granule_id is not null and page_no is not null").select("item_id", "granule_id", "page_no", "item_no", profile.alias("candidate")).distinct()
    n = t.groupBy("granule_id", F.col("page_no").alias("pdf_page"), "candidate").agg(F.count("*").alias("n")).where("candidate != 'vlm'")
    return report.page_by_candidate(n.withColumn("cer", F.when((F.col("candidate") == "scanned") & (F.col("n") > 3), None).otherwise(F.col("n") / 7.0)).withColumn("source", F.lit("text")), ["digital", "scanned"])


@query("""
with t as (select distinct result_id, profile, status, pages, seconds from unit_results)
select count(*) pages, sum(pages)::bigint input_tokens, sum(result_id)::bigint output_tokens, round(sum(seconds), 4) cost_usd, array_to_string(list_sort(list(distinct profile)), ' ') models, count(*) filter (result_id % 4 > 0) disputed, round(avg(result_id % 4), 6) mean_disagreements from t""")
def corpus_totals(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "unit_results").select("result_id", "profile", "status", "pages", "seconds").distinct()
    r = report.corpus_totals(t.select(F.col("pages").alias("input_tokens"), F.col("result_id").alias("output_tokens"), F.col("seconds").alias("cost_usd"), F.array_compact(F.array("profile")).alias("models"), (F.col("result_id") % 4).alias("disagreement_count")))
    return r.select("pages", "input_tokens", "output_tokens", F.round("cost_usd", 4).alias("cost_usd"), F.array_join("models", " ").alias("models"), "disputed", F.round("mean_disagreements", 6).alias("mean_disagreements"))


@query("""
with t as (select distinct result_id, split_part(profile, ':', 1) variant, profile engine, case when pages > 5 then 'A' end tier, status, pages, seconds, seconds / 2 model, pages * 900 tokens, case when result_id % 3 = 0 then 'n' || result_id % 5 end host from unit_results)
select variant, engine, coalesce(tier, 'B') tier, count(*) units, coalesce(sum(pages) filter (ok), 0)::bigint pages, round(sum(model) filter (ok) / nullif(sum(pages) filter (ok), 0), 6) model_per_page, round(sum(tokens) filter (ok) / nullif(sum(pages) filter (ok), 0), 6) tokens_per_page,
  coalesce(sum(case when tokens > 0 and tokens >= 4500 then 1 else 0 end + case when result_id % 2 = 0 then 1 else 0 end) filter (ok), 0)::bigint capped, count(*) filter (status = 'partial') "partial", count(*) filter (not ok) failed, coalesce(sum(result_id % 2) filter (ok), 0)::bigint synthesized,
  array_to_string(list_sort(list(distinct coalesce(host, '?'))), ', ') hosts from (select *, coalesce(status <> 'failed', false) ok from t) group by 1, 2, 3""")
def timing_details(spark: SparkSession, d: str) -> DataFrame:
    """Model time, tokens, cut pages and machines per variant and tier."""
    t = table(spark, d, "unit_results").select("result_id", "profile", "status", "pages", "seconds").distinct()
    n = F.col("pages") * 900
    page = lambda i, tokens, stop: F.struct(F.lit(i).alias("page"), F.lit(0.0).alias("seconds"), tokens.cast("bigint").alias("tokens"), stop.alias("stop_reason"))
    full = t.select(
        ids.profile_family(F.col("profile")).alias("variant"), F.col("profile").alias("engine"), F.when(F.col("pages") > 5, "A").alias("tier"), F.lit(None).cast("string").alias("era"), "status", "pages", "seconds", (F.col("seconds") / 2).alias("model_seconds"), n.alias("tokens"),
        F.array(page(1, n, F.lit("stop")), page(2, F.lit(1), F.when(F.col("result_id") % 2 == 0, "length"))).alias("page_times"), F.lit(4500).cast("bigint").alias("max_new_tokens"), (F.col("result_id") % 2).alias("synthesized"),
        F.when(F.col("result_id") % 3 == 0, F.concat(F.lit("n"), (F.col("result_id") % 5).cast("string"))).alias("host"),
    )
    r = report.timing_notes(full)
    return r.select("variant", "engine", "tier", "units", "pages", *[F.round(c, 6).alias(c) for c in ("model_per_page", "tokens_per_page")], "capped", "partial", "failed", "synthesized", "hosts")


# ---- the ledger's units


_UNITS = "u as (select distinct unit_id, granule_id, package_id, profile from units)"


def _units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "units").select("unit_id", "granule_id", "package_id", "profile").distinct()


@query(f"with {_UNITS}, g as ({_GRANULES}) select u.unit_id, u.profile, u.granule_id, g.granule_class, g.granule_id is not null found from u left join g on u.granule_id = g.granule_id")
def work_units(spark: SparkSession, d: str) -> DataFrame:
    g = _granules(spark, d).where("granule_id is not null").select("granule_id", "granule_class")
    return catalog.work_units(_units(spark, d), g).select("unit_id", "profile", "granule_id", "granule_class", "found")


_PL = "regexp_extract(package_id, '^PLAW-([0-9]+)(publ|pvtl)([0-9]+)$', {n})"
_PL_NUMBER = f"case when {_PL.format(n=1)} <> '' then {_PL.format(n=1)} || case when {_PL.format(n=2)} = 'pvtl' then '-pvt' else '-' end || {_PL.format(n=3)} end"


@query(f"""
with p as ({_PACKAGES}), s as (select package_id, {_PL_NUMBER} pl from p where collection = 'PLAW' and {_PL_NUMBER} is not null), l as (select distinct package_id, {_PL_NUMBER} pl from units)
select l.package_id, l.pl pl_number, s.package_id ledger from l left join s using (pl)""")
def law_units(spark: SparkSession, d: str) -> DataFrame:
    s = _packages(spark, d).where("collection = 'PLAW'").select(ids.pl_number(F.col("package_id")).alias("pl_number"), F.col("package_id").alias("ledger")).where("pl_number is not null")
    return catalog.law_units(table(spark, d, "units").select("package_id").distinct(), s).select("package_id", "pl_number", "ledger")


@query(f"""
with g as (select granule_id, granule_class, total_pages, row_number() over (order by granule_id) pos from ({_GRANULES}) where granule_id is not null), keep as (select distinct granule_id from slices where matched)
select granule_id, granule_class from g where granule_id in (select granule_id from keep where granule_id is not null) and granule_class in ('PUBLICLAW', 'TREATY') and coalesce(total_pages <= 3, true) order by pos limit 25""")
def select_units(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 units of the requested ids, classes and length: the limit is the operator's own."""
    g = _granules(spark, d).where("granule_id is not null").select("granule_id", "granule_class", F.col("total_pages").alias("est_pages"), F.col("granule_id").alias("pos"))
    keep = table(spark, d, "slices").where("matched and granule_id is not null").select("granule_id").distinct()
    return catalog.select_units(g, keep, ["PUBLICLAW", "TREATY"], 3, 25).select("granule_id", "granule_class")


@query("select granule_id unit, null package_id from slices union all select package_id, package_id from packages")
def combine_units(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "slices").select(F.col("granule_id").alias("unit")), table(spark, d, "packages").select(F.col("package_id").alias("unit"), "package_id")
    return catalog.combine_units(a, b).select("unit", F.col("package_id").cast("string").alias("package_id"))


@query("select 'granule' what, granule_id as value, count(*) n from units where granule_id is not null group by 2 union all select 'profile', profile, count(*) from unit_results where profile is not null group by 2")
def distinct_units(spark: SparkSession, d: str) -> DataFrame:
    """Distinct granules and profiles, with their rows."""
    a, b = catalog.distinct_values(table(spark, d, "units"), "granule_id"), catalog.distinct_values(table(spark, d, "unit_results"), "profile")
    return a.select(F.lit("granule").alias("what"), "value", "n").unionByName(b.select(F.lit("profile").alias("what"), "value", "n"))


@query(f"""
with g as ({_GRANULES}) select granule_id, case when cls in ('PROCLAMATION', 'TREATY') then 'presidentialDoc' when cls in ('HCONRES', 'SCONRES') then 'resolution' else 'pLaw' end doc_type,
  case when cls not in ('PROCLAMATION', 'TREATY', 'HCONRES', 'SCONRES') and regexp_matches(number, '^[0-9]+$') then number::int end law_number, cls = 'PRIVATELAW' is_private,
  try_cast(nullif(regexp_extract(package_id, '^STATUTE-([0-9]+)', 1), '') as int) volume, page_start start_page, date_issued::varchar date_issued from (select *, coalesce(nullif(granule_class, ''), 'PUBLICLAW') cls from g)""")
def granule_identities(spark: SparkSession, d: str) -> DataFrame:
    who = catalog.identity_of_granule({c: F.col(c) for c in ("granule_class", "number", "congress", "package_id", "page_start", "granule_id", "date_issued", "title")})
    return _granules(spark, d).select(F.col("granule_id").alias("_g"), who.alias("i")).select(F.col("_g").alias("granule_id"), *[F.col(f"i.{c}").alias(c) for c in ("doc_type", "law_number", "is_private", "volume", "start_page", "date_issued")])


@query(f"""
with p as ({_PACKAGES}) select package_id, 'pLaw' doc_type, try_cast(nullif({_PL.format(n=1)}, '') as int) congress, try_cast(nullif({_PL.format(n=3)}, '') as int) law_number, coalesce({_PL.format(n=2)} = 'pvtl', false) is_private, volume, pages start_page from p""")
def law_identities(spark: SparkSession, d: str) -> DataFrame:
    who = catalog.identity_of_law(F.col("package_id"), F.col("volume"), F.col("pages"), F.col("date_issued"), F.col("title"))
    return _packages(spark, d).select(F.col("package_id").alias("_p"), who.alias("i")).select(F.col("_p").alias("package_id"), *[F.col(f"i.{c}").alias(c) for c in ("doc_type", "congress", "law_number", "is_private", "volume", "start_page")])


@query("select l.hub_path, case when l.sha256 is not null and h.sha256 is not null then l.sha256 = h.sha256 end same from (select distinct hub_path, sha256 from file_decisions where hub_path is not null) l join (select distinct hub_path, sha256 from hub_entries where size is not null and hub_path is not null) h using (hub_path)")
def same_contents(spark: SparkSession, d: str) -> DataFrame:
    """Whether two binary copies are equal."""
    l = table(spark, d, "file_decisions").where("hub_path is not null").select("hub_path", F.col("sha256").alias("a")).distinct()
    h = table(spark, d, "hub_entries").where("size is not null and hub_path is not null").select("hub_path", F.col("sha256").alias("b")).distinct()
    return l.join(h, "hub_path").select("hub_path", catalog.same_content(F.col("a").cast("binary"), F.col("b").cast("binary")).alias("same"))


@query("""
with c as (select distinct unit_id granule_id, null::varchar package_id, nullif(page_range, '') page_range, profile module_used, started_at conversion_date, result_id, status from unit_results)
select coalesce(granule_id, package_id) document, coalesce(page_range, '') page_range, module_used "module", result_id, status from c qualify row_number() over (partition by coalesce(granule_id, package_id), coalesce(page_range, ''), module_used order by conversion_date desc nulls last, result_id desc, status desc) = 1""")
def latest_conversions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "unit_results").select(F.col("unit_id").alias("granule_id"), F.lit(None).cast("string").alias("package_id"), F.nullif("page_range", F.lit("")).alias("page_range"), F.col("profile").alias("module_used"), F.col("started_at").alias("conversion_date"), "result_id", "status").distinct()
    return catalog.latest_conversions(c, ["result_id", "status"])


@query(f"""
with g as ({_GRANULES}), x as (select granule_id, {_VOLUME} v, page_start s, coalesce(page_end, page_start) e from g)
select granule_id, case when v is not null and s is not null then v end volume, case when v is not null then s end start_page, case when v is not null and s is not null then greatest(s, s + 2) end end_page from x""")
def pages_of_xml(spark: SparkSession, d: str) -> DataFrame:
    """Volume and page span of laws, from their XML's citation and page markers of that volume."""
    g = _granules(spark, d)
    v, s = F.col("volume"), F.col("page_start")
    mark = lambda volume, page: F.concat(F.lit('<page identifier="/us/stat/'), volume.cast("string"), F.lit("/"), page.cast("string"), F.lit('"/>'))
    x = F.concat(F.lit("<pLaw><meta><citableAs>"), v.cast("string"), F.lit(" Stat. "), s.cast("string"), F.lit("</citableAs></meta>"), mark(v, s), mark(v, s + 2), mark(v, s + 1), mark(v + 1, s + 9), F.lit("</pLaw>"))
    where = catalog.law_pages_of_xml(F.coalesce(x, F.lit("<pLaw/>")))
    return g.select("granule_id", *[where[c].alias(c) for c in ("volume", "start_page", "end_page")])


@query("select p.profile, count(*) n from (select distinct profile, unit_id granule_id from unit_results where status = 'success') p join (select distinct granule_id from slices where matched and granule_id is not null) g using (granule_id) group by 1".replace("p.profile, count(*) n", "distinct p.profile").replace(" group by 1", ""))
def profiles_with_output(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "unit_results").where("status = 'success'").select("profile", F.col("unit_id").alias("granule_id")).distinct()
    return report.profiles_with_output(o, table(spark, d, "slices").where("matched and granule_id is not null"))


@query("""
with r as (select distinct result_id, case result_id % 5 when 0 then 429 when 1 then 503 when 2 then 404 else 200 end status, case when result_id % 3 = 0 then '7' when result_id % 3 = 1 then 'soon' end header, result_id % 8 attempt from unit_results)
select result_id, status = 429 or status >= 500 retry, case when status = 429 or status >= 500 then least(60.0, coalesce(try_cast(header as double), power(2.0, attempt))) end wait from r""")
def retries(spark: SparkSession, d: str) -> DataFrame:
    """Which answers of a service are worth another attempt, and when."""
    from lexmill.providers.registry import is_retryable, retry_after

    k = F.col("result_id")
    r = table(spark, d, "unit_results").select("result_id", F.when(k % 5 == 0, 429).when(k % 5 == 1, 503).when(k % 5 == 2, 404).otherwise(200).alias("status"), F.when(k % 3 == 0, "7").when(k % 3 == 1, "soon").alias("header"), (k % 8).alias("attempt")).distinct()
    return r.select("result_id", is_retryable(F.col("status")).alias("retry"), retry_after(F.col("status"), F.col("header"), F.col("attempt")).alias("wait"))


@query("""
with a as (select distinct result_id, profile, started_at, case when result_id % 97 = 5 then 'Your credit balance is too low' end error from unit_results where started_at is not null),
f as (select min((started_at, result_id)) s from a where error is not null) select result_id, profile from a, f where f.s is null or (started_at, result_id) <= f.s""")
def attempts_until_credit(spark: SparkSession, d: str) -> DataFrame:
    """Attempts up to the first that fails for want of credit."""
    from lexmill.providers.registry import stop_on_credit

    a = table(spark, d, "unit_results").where("started_at is not null").select("result_id", "profile", "started_at", F.when(F.col("result_id") % 97 == 5, "Your credit balance is too low").alias("error")).distinct()
    return stop_on_credit(a, ["started_at", "result_id"]).select("result_id", "profile")


# ---- comparison

_TOK = _quote(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")


@query(f"""
with p as (select distinct item_id, regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') a, regexp_replace(orig, '[^\\x00-\\x7F]', '?', 'g') b from page_items where text is not null and orig is not null),
t as (select item_id, regexp_extract_all(b, {_TOK}) r, regexp_extract_all(a, {_TOK}) h from p), k as (select *, list_distinct(list_concat(r, h)) every from t),
c as (select item_id, len(r) n, array_to_string(list_transform(r, lambda x: chr(33 + list_position(every, x)::int)), '') r, array_to_string(list_transform(h, lambda x: chr(33 + list_position(every, x)::int)), '') h from k)
select item_id, round(case when n > 0 then levenshtein(r, h) / n else (h <> '')::int::double end, 6) wer from c""")
def ascii_word_errors(spark: SparkSession, d: str) -> DataFrame:
    """Word error rates; other than ASCII characters count as `?`, as in character_errors."""
    plain = lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", "?")
    both = table(spark, d, "page_items").where("text is not null and orig is not null").select("item_id", plain("text").alias("a"), plain("orig").alias("b")).distinct()
    return both.select("item_id", F.round(fuzzy.wer(F.col("b"), F.col("a")), 6).alias("wer"))


@query("""
with i as (select distinct granule_id, page_no, item_no, item_id, text a, orig b from page_items where granule_id is not null), p as (select *, row_number() over (partition by granule_id, page_no order by item_no, item_id) n from i),
d as (select *, lower(regexp_replace(coalesce(a, ''), '[^a-zA-Z0-9]', '', 'g')) <> lower(regexp_replace(coalesce(b, ''), '[^a-zA-Z0-9]', '', 'g')) differs from p)
select granule_id, page_no, count(*)::int lines, count(*) filter (differs) differing from d group by 1, 2""".replace("count(*)::int lines, count(*) filter (differs) differing", "count(*)::int lines"))
def adjudicated_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages by adjudication of themselves: lines of equal transcriptions stay as they are."""
    p = _page_arrays(spark, d)
    both = p.select("granule_id", "page_no", F.col("lines").alias("a"), F.col("lines").alias("b"), F.lit(None).cast(f"array<struct<run:int,lines:array<{metrics.LINE}>,reason:string>>").alias("resolutions"))
    m = metrics.merge_transcriptions(both.withColumn("runs", metrics.transcription_runs(F.col("a"), F.col("b"))), ["granule_id", "page_no"])
    return m.where("unresolved = 0 and size(disagreements) = 0").select("granule_id", "page_no", F.size("lines").alias("lines"))


@query("""
with i as (select distinct granule_id, page_no, item_no, item_id from page_items where granule_id is not null), p as (select granule_id, page_no, list(item_id order by item_no, item_id) l from i group by 1, 2)
select granule_id, page_no, array_to_string(list_transform(range(1, len(l) + 1), lambda k: case when k = 1 then 'x' || l[1] when k = 2 then 'b' || l[2] else 'a' || l[k] end), ' ') lines, (len(l) >= 3)::int unresolved from p""")
def resolved_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of two made-up transcriptions: the first line differs and gets the resolution x, the second differs and is resolved to B's, the last differs and stays A's."""
    i = table(spark, d, "page_items").where("granule_id is not null").select("granule_id", "page_no", "item_no", "item_id").distinct()
    p = i.groupBy("granule_id", "page_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "item_id"))), lambda x: x["item_id"].cast("string")).alias("l"))
    line = lambda prefix, x: F.struct(F.lit("body").alias("role"), F.concat(F.lit(prefix), x).alias("text"))
    n = F.size("l")
    at = F.when(F.col("n") <= 2, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array(F.lit(0), F.lit(1), F.col("n") - 1))
    p = p.withColumn("n", n).withColumn("a", F.transform("l", lambda x: line("a", x))).withColumn("b", F.transform("l", lambda x: line("b", x)))
    run = F.transform(at, lambda k, j: F.struct((j + 1).cast("int").alias("run"), F.lit("replace").alias("op"), k.cast("int").alias("a_from"), (k + 1).cast("int").alias("a_to"), k.cast("int").alias("b_from"), (k + 1).cast("int").alias("b_to"), F.slice("a", k + 1, 1).alias("a"), F.slice("b", k + 1, 1).alias("b")))
    first, second = F.element_at("l", 1), F.try_element_at("l", F.lit(2))
    done = F.array(F.struct(F.lit(1).alias("run"), F.array(line("x", first)).alias("lines"), F.lit("image").alias("reason")), F.struct(F.lit(2).alias("run"), F.array(line("b", second)).alias("lines"), F.lit("image").alias("reason")))
    m = metrics.merge_transcriptions(p.withColumn("runs", run).withColumn("resolutions", done), ["granule_id", "page_no"])
    return m.select("granule_id", "page_no", F.array_join(F.transform("lines", lambda x: x["text"]), " ").alias("lines"), F.col("unresolved").cast("int").alias("unresolved"))


@query("with p as (select distinct package_id, coalesce(congress, 0) % 2 = 0 h, coalesce(session, 0) % 2 = 0 t from packages) select package_id, h, t, case when h and t then 'both' when h then 'head' when t then 'tail' else 'none' end label from p")
def clip_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "packages").select("package_id", (F.coalesce("congress", F.lit(0)) % 2 == 0).alias("h"), (F.coalesce("session", F.lit(0)) % 2 == 0).alias("t")).distinct()
    return p.withColumn("label", metrics.clip_label(F.struct(F.col("h").alias("head_found"), F.col("t").alias("tail_found"))))


# ---- XML


_DOC_ITEMS = "select distinct granule_id, page_no, item_no, item_id, label, regexp_replace(coalesce(text, orig), '[^a-zA-Z0-9]+', '', 'g') t from page_items where granule_id is not null and page_no is not null"
_KIND = "case when item_no % 5 = 0 then 'section' when item_no % 5 = 1 then 'sidenote' else 'p' end"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """A document per granule: page markers, and each line as a section, sidenote or paragraph."""
    t = F.regexp_replace(F.coalesce("text", "orig"), "[^a-zA-Z0-9]+", "")
    i = table(spark, d, "page_items").where("granule_id is not null and page_no is not null").select("granule_id", "page_no", "item_no", "item_id", t.alias("t")).distinct()
    k = F.col("item_no") % 5
    n = F.col("item_no").cast("string")
    one = F.when(k == 0, F.concat(F.lit('<section identifier="/us/x/s'), n, F.lit('"><num value="'), n, F.lit('"/><content>'), "t", F.lit("</content></section>"))).when(k == 1, F.concat(F.lit("<sidenote><p>"), "t", F.lit("</p></sidenote>"))).otherwise(F.concat(F.lit("<p>"), "t", F.lit("</p>")))
    first = F.row_number().over(Window.partitionBy("granule_id", "page_no").orderBy("item_no", "item_id")) == 1
    i = i.withColumn("x", F.concat(F.when(first, F.concat(F.lit('<page identifier="/us/stat/7/'), F.col("page_no").cast("string"), F.lit('"/>'))).otherwise(""), one))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "item_no", "item_id", "x"))), lambda x: x["x"])
    return i.groupBy("granule_id").agg(F.concat(F.lit("<pLaw xmlns='http://schemas.gpo.gov/xml/uslm'><main>"), F.array_join(parts, ""), F.lit("</main></pLaw>")).alias("xml"))


@query(f"""
with i as ({_DOC_ITEMS}), k as (select *, {_KIND} kind from i)
select granule_id, count(*) filter (kind = 'section')::int sections, count(*) filter (kind = 'sidenote')::int sidenotes, count(*) filter (kind <> 'section')::int paragraphs, count(distinct page_no)::int pages,
  coalesce(string_agg(t, ' ' order by page_no, item_no, item_id) filter (kind <> 'sidenote' and t <> ''), '') body, count(distinct case when kind = 'section' then item_no end)::int identifiers,
  coalesce(string_agg(item_no || ':' || t[:40], ';' order by page_no, item_no, item_id) filter (kind = 'section'), '') starts, coalesce(string_agg(t, ';' order by page_no, item_no, item_id) filter (kind = 'sidenote'), '') notes from k group by 1""")
def xml_contents(spark: SparkSession, d: str) -> DataFrame:
    """Structure, body text, sections, sidenotes and identifiers of documents."""
    from lexmill.functions import xml

    x = F.col("xml")
    r = _documents(spark, d).select("granule_id", xml.structure_col(x).alias("n"), xml.body_text_col(x).alias("body"), xml.sections_col(x).alias("s"), xml.sidenotes_col(x).alias("notes"), xml.identifiers_col(x).alias("i"))
    count = lambda k: F.col("n")[k].cast("int")
    return r.select("granule_id", count("section").alias("sections"), count("sidenote").alias("sidenotes"), count("p").alias("paragraphs"), count("page").alias("pages"), "body", F.size("i.structure").alias("identifiers"),
                    F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["num"], x["start"])), ";").alias("starts"), F.array_join("notes", ";").alias("notes"))


@query(f"""
with i as ({_DOC_ITEMS}), k as (select *, {_KIND} kind from i)
select granule_id, page_no::varchar label, coalesce(string_agg(t, ' ' order by item_no, item_id) filter (kind <> 'sidenote' and t <> ''), '') body, coalesce(string_agg(t, ' ' order by item_no, item_id) filter (kind = 'sidenote' and t <> ''), '') sidenote from k
group by 1, 2 having count(*) filter (t <> '') > 0""")
def xml_pages(spark: SparkSession, d: str) -> DataFrame:
    """Texts of a document's pages, cut at its page markers."""
    from lexmill.functions import xml

    r = _documents(spark, d).select("granule_id", F.inline(xml.page_texts_col(F.col("xml"), F.lit(None).cast("string"))))
    return r.select("granule_id", "label", "body", "sidenote")


def _element(name: str, value, attrs: str = ""):
    return F.coalesce(F.concat(F.lit(f"<{name}{attrs}>"), value.cast("string"), F.lit(f"</{name}>")), F.lit(""))


_MODS_TITLE = "nullif(trim(regexp_replace(title, '[^a-zA-Z0-9 ]', '', 'g')), '')"


@query(f"""
with g as ({_GRANULES}) select granule_id, granule_class, {_MODS_TITLE} title, number, congress, page_start, page_end, page_start::varchar || '-' || coalesce(page_end::varchar, '') page_range, total_pages, citation, date_issued::varchar date_issued,
  case when granule_class in ('PUBLICLAW', 'PRIVATELAW') then granule_class = 'PRIVATELAW' end is_private, case when number is not null then 'hr' end bill from g where granule_id is not null""")
def mods_records(spark: SparkSession, d: str) -> DataFrame:
    """The fields of MODS records made of the granules."""
    from lexmill.functions.xml import mods_record

    return _mods(spark, d).select("granule_id", mods_record(F.col("xml")).alias("m")).select(
        "granule_id", *[F.col(f"m.{c}").alias(c) for c in ("granule_class", "title", "number", "congress", "page_start", "page_end", "page_range", "total_pages", "citation")], F.col("m.granule_date").alias("date_issued"), F.col("m.is_private").alias("is_private"), F.col("m.bill.type").alias("bill"))


def _mods(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    law = F.when(c("granule_class").isin("PUBLICLAW", "PRIVATELAW"), F.concat(F.lit('<extension><law isPrivate="'), F.when(c("granule_class") == "PRIVATELAW", "true").otherwise("false"), F.lit('"/></extension>'))).otherwise("")
    bill = F.when(c("number").isNotNull(), F.concat(F.lit('<extension><bill type="hr" number="'), c("number"), F.lit('" congress="1"/></extension>'))).otherwise("")
    title = F.nullif(F.trim(F.regexp_replace("title", "[^a-zA-Z0-9 ]", "")), F.lit(""))
    ext = lambda n, v: F.concat(F.lit("<extension>"), _element(n, v), F.lit("</extension>"))
    x = F.concat(
        F.lit('<mods xmlns="http://www.loc.gov/mods/v3" ID="id-x">'), F.lit("<titleInfo>"), _element("title", title), F.lit("</titleInfo>"), ext("accessId", c("granule_id")), ext("granuleClass", c("granule_class")), ext("number", c("number")), ext("congress", c("congress")),
        ext("totalPages", c("total_pages")), ext("granuleDate", c("date_issued")), law, bill, F.lit('<part type="article"><extent unit="pages">'), _element("start", c("page_start")), _element("end", c("page_end")), F.lit("</extent></part>"),
        _element("identifier", c("citation"), ' type="preferred citation"'), F.lit("</mods>"),
    )
    return _granules(spark, d).where("granule_id is not null").select("granule_id", "package_id", "granule_class", "title", "number", F.col("date_issued").cast("string").alias("issued"), "status", x.alias("xml"))


@query(f"""
with g as ({_GRANULES}) select granule_id, package_id, coalesce(nullif(case when page_start % 2 = 0 then granule_class end, ''), granule_class) granule_class, coalesce(nullif(case when page_start % 2 = 0 then title end, ''), {_MODS_TITLE}) title,
  date_issued::varchar date_issued, page_start, citation, congress, case when coalesce(status = 'verified', false) then 'downloaded' else 'pending' end status from g where granule_id is not null""")
def granule_rows(spark: SparkSession, d: str) -> DataFrame:
    """Granule rows of summaries, every second of which lacks class and title, and of MODS records."""
    from lexmill.functions.xml import mods_record

    m = _mods(spark, d).withColumn("page_start", mods_record(F.col("xml"))["page_start"])
    some = lambda c: F.when(F.col("page_start") % 2 == 0, F.col(c)).alias(c)
    s = m.select("granule_id", "package_id", some("granule_class"), some("title"), "number", F.lit(None).cast("string").alias("granule_date"), F.col("issued").alias("date_issued"), (F.col("status") == "verified").alias("has_file"))
    mods = m.select(F.col("granule_id").alias("_g"), mods_record(F.col("xml")).alias("m")).select(F.col("_g").alias("granule_id"), *[F.col(f"m.{c}").alias(c) for c in ("granule_class", "title", "number", "granule_date", "page_start", "page_end", "page_range", "total_pages", "citation", "congress")])
    return catalog.granule_row(s, mods).select("granule_id", "package_id", "granule_class", "title", "date_issued", "page_start", "citation", "congress", "status")


# ---- splitting of volumes

_SPLIT_CLASSES = ("PUBLICLAW", "PRIVATELAW", "PROCLAMATION", "TREATY")
_SPLIT = f"""
with g as (select granule_id, granule_class, {_VOLUME} volume, lower(regexp_extract(granule_id, {_ID}, 2)) pre, regexp_extract(granule_id, {_ID}, 3)::int page, coalesce(try_cast(nullif(regexp_extract(granule_id, {_ID}, 4), '') as int), 1) nth
  from ({_GRANULES}) where granule_class in {_SPLIT_CLASSES} and regexp_matches(granule_id, {_ID})),
p as (select *, list_position({list(_SPLIT_CLASSES)}, granule_class) c, row_number() over (partition by volume, granule_class order by pre, page, nth, granule_id) k from g),
o as (select *, row_number() over (partition by volume, pre || page order by c, k) ordinal from p),
s as (select *, case when k % 3 = 0 then granule_id else 'STATUTE-' || volume || '-Pg' || upper(pre) || page || case when ordinal > 1 then '-' || ordinal else '' end end id from o)"""


def _volumes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Volumes made of the granules, and their listing: laws in their containers, presidential documents in theirs; every third document of a class has no citation, but its page as first marker."""
    listing = _granules(spark, d).where(F.col("granule_class").isin(*_SPLIT_CLASSES) & ids.granule_page(F.col("granule_id")).isNotNull()).select("volume", "granule_id", "granule_class")
    k = F.row_number().over(Window.partitionBy("volume", "granule_class").orderBy(ids.page_sort_key(F.col("granule_id")), "granule_id"))
    page = F.upper(ids.granule_page(F.col("granule_id")))
    g = listing.withColumn("k", k).withColumn("page", page).withColumn("c", F.array_position(F.array(*[F.lit(x) for x in _SPLIT_CLASSES]), F.col("granule_class")))
    cite = F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("<citableAs>"), F.col("volume").cast("string"), F.lit(" Stat. "), "page", F.lit("</citableAs>")))
    tag = F.when(F.col("c") <= 2, "pLaw").otherwise("presidentialDoc")
    doc = F.concat(F.lit("<component><"), tag, F.lit("><meta>"), cite, F.lit('</meta><main><page identifier="/us/stat/'), F.col("volume").cast("string"), F.lit("/"), F.lower("page"), F.lit('"/><p>'), "granule_id", F.lit("</p></main></"), tag, F.lit("></component>"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("k", doc.alias("x")))), lambda x: x["x"])
    per = g.groupBy("volume", "c").agg(F.array_join(parts, "").alias("x"))
    wrap = F.element_at(F.array(*[F.lit(x) for x in ("publicLaws", "privateLaws", 'collection role="proclamations"', 'collection role="treaties"')]), F.col("c").cast("int"))
    name = F.substring_index(wrap, " ", 1)
    per = per.withColumn("x", F.concat(F.lit("<"), wrap, F.lit(">"), "x", F.lit("</"), name, F.lit(">")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", "x"))), lambda x: x["x"]), "")
    volumes = per.groupBy("volume").agg(F.concat(F.lit("<statutesAtLarge xmlns='http://schemas.gpo.gov/xml/uslm'>"), whole, F.lit("</statutesAtLarge>")).alias("xml"))
    return volumes, listing


def _cut(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from lexmill.operators import split

    volumes, listing = _volumes(spark, d)
    return split.slices(split.volume_events(volumes), listing), listing


@query(f"{_SPLIT} select volume, id granule_id, granule_class, case when k % 3 = 0 then pre || page else pre || page end start_page, case when k % 3 = 0 then nth else ordinal end::int ordinal, k % 3 <> 0 cited, id in (select granule_id from g) matched, md5('x') <> '' as has_xml from s".replace("end::int ordinal", "end ordinal").replace(", md5('x') <> '' as has_xml", ""))
def volume_slices(spark: SparkSession, d: str) -> DataFrame:
    """Documents cut from volumes, with their ids: by citation, page and order, or by their place in the listing."""
    cut, _ = _cut(spark, d)
    return cut.select("volume", "granule_id", "granule_class", "start_page", F.col("ordinal").cast("long").alias("ordinal"), F.col("citable_as").isNotNull().alias("cited"), "matched")


@query(f"{_SPLIT} select volume, granule_class, count(*) documents, count(*) filter (id in (select granule_id from g)) matched from s group by 1, 2")
def volume_summary(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.operators.split import split_summary

    return split_summary(_cut(spark, d)[0])


@query(f'{_SPLIT} select volume, granule_class "group", count(*) documents, count(*) listed, true aligned from s group by 1, 2')
def volume_alignment(spark: SparkSession, d: str) -> DataFrame:
    from lexmill.operators.split import alignment

    return alignment(*_cut(spark, d))


# ---- layout


@query(f"""
with i as (select distinct item_id, granule_id, page_no, item_no, coalesce(text, orig) t from page_items where granule_id is not null),
c as (select granule_id, sum(length({_sql_strip(f"regexp_replace(t, '{_SPACE}+', ' ', 'g')")}))::bigint n from i group by 1) select granule_id, n source_chars from c""")
def source_characters(spark: SparkSession, d: str) -> DataFrame:
    """Characters of each granule's lines, blanks squashed."""
    return layout.source_chars(_items(spark, d).where("granule_id is not null")).withColumnRenamed("granule_id", "g").select(F.col("g").alias("granule_id"), "source_chars")


# ---- transfers


_HUB_PATH = "regexp_replace(trim(lower(hub_path)), '^(\\./|/)+', '')"
_HUB_NOW = f"select {_HUB_PATH} path, size, sha256 from hub_entries where size is not null qualify row_number() over (partition by {_HUB_PATH} order by committed_at desc) = 1"


@query(f"""
with f as ({_HUB_NOW}), n as (select path, size, greatest(1, least(4, greatest(1, size // 100000))) n from f), p as (select path, size, n, unnest(range(0, n)) part from n where size > 0),
r as (select path, part::int part, part * (size // n) + least(part, size % n) a, (part + 1) * (size // n) + least(part + 1, size % n) - 1 b from p),
d as (select *, case when part = 0 then 10 when part = 1 then b - a + 1 when part = 2 then b - a + 2 end have from r),
s as (select *, case when have is null then 'missing' when have < b - a + 1 then 'partial' when have = b - a + 1 then 'complete' else 'oversize' end state from d)
select path, part, a "first", b "last", have, state, case when state = 'complete' then null when state = 'partial' then a + have else a end "start" from s""")
def download_parts(spark: SparkSession, d: str) -> DataFrame:
    """Byte ranges still to be fetched of the Hub's files, where ten bytes of each first part are there, all of each second, and too many of each third."""
    from lexmill.operators.transfers import part_plan

    f = _hub_now(spark, d).select("path", "size")
    length = F.col("last") - F.col("first") + 1
    every = part_plan(f, spark.createDataFrame([], "path string, part int, have bigint"), 4, 100_000)
    have = every.select("path", "part", F.when(F.col("part") == 0, F.lit(10)).when(F.col("part") == 1, length).when(F.col("part") == 2, length + 1).cast("bigint").alias("have")).where("have is not null")
    return part_plan(f, have, 4, 100_000)


def _hub_now(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace(text.strip(F.lower("hub_path")), r"^(\./|/)+", "")
    return latest(table(spark, d, "hub_entries").where("size is not null"), {"path": path}, ["committed_at"], ["size", "sha256"])


@query(f"""
with h as ({_HUB_NOW}), l as (select {_HUB_PATH} path, expected, local, sha256 from file_decisions qualify row_number() over (partition by {_HUB_PATH} order by recorded_at desc) = 1)
select l.path, case when expected is null then 'wait' when coalesce(h.size = expected, false) and coalesce(h.sha256 = l.sha256, true) then case when local is not null then 'clear' else 'done' end when coalesce(local = expected, false) then 'upload' else 'fetch' end step
from l left join h using (path)""")
def upload_steps(spark: SparkSession, d: str) -> DataFrame:
    """The next step of each file of the ledger: upload, clear, fetch, done or wait."""
    from lexmill.operators.transfers import upload_plan

    path = F.regexp_replace(text.strip(F.lower("hub_path")), r"^(\./|/)+", "")
    l = latest(table(spark, d, "file_decisions"), {"path": path}, ["recorded_at"], ["expected", "local", "sha256"])
    h = _hub_now(spark, d).select("path", F.col("size").alias("hub_size"), F.col("sha256").alias("hub_sha256"))
    return upload_plan(l.join(h, "path", "left"))


@query("""
with e as (select unit_id job_id, split_part(profile, ':', 1) flavor, status, seconds, started_at "at" from unit_results where started_at is not null),
n as (select * from e qualify row_number() over (partition by job_id order by "at" desc, flavor desc, status desc, seconds desc) = 1)
select job_id, flavor, status, seconds, case flavor when 'vlm' then round(1.8 * seconds / 3600, 4) when 'scanned' then round(0.6 * seconds / 3600, 4) end cost from n""")
def job_costs(spark: SparkSession, d: str) -> DataFrame:
    """Latest state and cost of jobs; flavors without a rate have none."""
    from lexmill.operators.transfers import job_ledger

    e = table(spark, d, "unit_results").where("started_at is not null").select(F.col("unit_id").alias("job_id"), ids.profile_family(F.col("profile")).alias("flavor"), "status", "seconds", F.col("started_at").alias("at"))
    return job_ledger(e, spark.createDataFrame([("vlm", 1.8), ("scanned", 0.6)], "flavor string, hourly double"))


# ---- transcriptions


@query("""
with i as (select distinct granule_id, page_no + 2 page, item_no pos, item_id, case item_no % 7 when 0 then 'running-head' when 3 then 'sidenote' when 5 then 'footnote' when 6 then 'page-number' else 'body' end as role, coalesce(text, orig) t, item_no % 2 = 0 starts
  from page_items where granule_id is not null and page_no is not null),
o as (select *, case when starts or row_number() over (partition by granule_id, page, role order by pos) = 1 then 1 else 0 end o from i where trim(t) <> ''),
g as (select *, sum(o) over (partition by granule_id, page, role order by pos rows unbounded preceding) item from o),
m as (select granule_id, page, role, item, min(pos) pos, count(*) lines from g group by 1, 2, 3, 4),
c as (select *, greatest(1, sum((role = 'body')::int) over (partition by granule_id, page)) bodies, sum((role = 'body')::int) over w - 1 body, sum((role in ('running-head', 'page-number'))::int) over w - 1 head, sum((role = 'footnote')::int) over w - 1 foot from m
  window w as (partition by granule_id, page order by pos rows unbounded preceding)),
s as (select *, (0.92::double - 0.14::double) * 792 / bodies step from c),
t as (select *, case when role in ('running-head', 'page-number') then greatest((0.945::double + 0.01::double) * 792, 0.985::double * 792 - head * 0.01::double * 792) when role = 'footnote' then greatest((0.065::double + 0.01::double) * 792, 0.125::double * 792 - foot * 0.01::double * 792)
  else 0.92::double * 792 - greatest(0, body) * step end t, least(step * 0.8::double, 12.0::double) line from s)
select granule_id, page, role, pos, round(case role when 'sidenote' then 0.82::double when 'page-number' then 0.80::double else 0.12::double end * 612, 3) l, round(case role when 'sidenote' then 0.97::double when 'page-number' then 0.95::double else 0.78::double end * 612, 3) r,
  round(t, 3) t, round(greatest(0.0::double, case when role = 'body' then t - line else t - least(line, 0.009::double * 792) end), 3) b, lines from t""")
def placed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Transcribed lines as layout items: merged into paragraphs, pages renumbered from the third on, placed by role."""
    n = F.col("item_no")
    role = F.when(n % 7 == 0, "running-head").when(n % 7 == 3, "sidenote").when(n % 7 == 5, "footnote").when(n % 7 == 6, "page-number").otherwise("body")
    i = table(spark, d, "page_items").where("granule_id is not null and page_no is not null").select("granule_id", F.col("page_no").alias("page"), F.lit(3).alias("first_page"), n.alias("pos"), "item_id", role.alias("role"), F.coalesce("text", "orig").alias("text"), (n % 2 == 0).alias("starts_paragraph")).distinct()
    return layout.transcribed_items(i).select("granule_id", "page", "role", "pos", *[F.round(c, 3).alias(c) for c in "lrtb"], "lines")
