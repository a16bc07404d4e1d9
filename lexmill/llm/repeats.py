"""Lines and blocks of lines repeated across the documents of one source.

The suffixes of a source's concatenated line identifiers are sorted by prefix doubling: suffixes are ranked by their first line, then by the
ranks of their first and second 2^k lines, which ranks them by their first 2^(k+1) lines. Equal ranks are the intervals of the suffix array with a common
prefix of that length. Only intervals that stand in enough documents are ranked on: a block is no more widespread than its lines, so nothing else can be part of a
repeated block, and the sort ends when no interval is left. The longest repeated block that begins at a line is then found downwards, by halves.

Every step is a join or an aggregation on positions or ranks; no task ever holds a document, a source or the places of a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.session import cut

MIN_DOCS, MIN_SHARE = 8, 0.1
#: Pages per group of a document's lines: the lines are numbered within groups, which are then put one behind the other.
GROUP_PAGES = 64


def line_id(text: Column) -> Column:
    """Identifier of a line by its letters and digits, without case; NULL if it has none."""
    bare = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")
    return F.when(bare != "", F.xxhash64(bare))


def source_lines(items: DataFrame, doc: Column, source_of: DataFrame, text: Column, pos: list[str], item: str = "item_id", page: Column | None = None) -> DataFrame:
    """`source, doc, chunk, n, item, line` of the items that have a source and a letter or digit: the n-th such line of a group of pages.

    `source_of` has `doc` (unique) and `source`. Items with a NULL document or one without source are left out, and so are blank and NULL texts.
    Repeated rows of an item count once. Other columns may have any name. Without `page`, a document is one group. The result is written to the checkpoint folder, so that the
    items are read and the identifiers computed once.
    """
    chunk = F.lit(0) if page is None else F.floor(F.coalesce(page, F.lit(0)) / GROUP_PAGES).cast("int")
    mine = items.select(doc.alias("doc"), F.struct(*pos).alias("pos"), F.col(item).alias("item"), line_id(text).alias("line"), chunk.alias("chunk")).where("doc is not null and line is not null")
    known = source_of.where("doc is not null and source is not null").select(F.col("doc").alias("_d"), "source")
    order = Window.partitionBy("doc", "chunk").orderBy("pos", "item", "line")
    again = F.coalesce(F.struct("pos", "item", "line") == F.lag(F.struct("pos", "item", "line")).over(order), F.lit(False))
    lines = mine.join(known, F.col("doc") == F.col("_d")).withColumn("_again", again)
    lines = lines.withColumn("n", F.sum((~F.col("_again")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return cut(lines.where("not _again").select("source", "doc", "chunk", "n", "item", "line"))


def widespread_lines(lines: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """`source, line, need, source_docs`: the lines in at least `need` documents of their source, which is at least `min_docs` and `min_share` of its documents."""
    sizes = lines.groupBy(F.col("source").alias("_s")).agg(F.count_distinct("doc").alias("source_docs"))
    docs = lines.select("source", "line", "doc").distinct().groupBy("source", "line").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    # the share is compared as it is stated, so that rounding can't decide
    wide = docs.join(sizes, F.col("source") == F.col("_s")).where(F.col("docs") >= min_share * F.col("source_docs"))
    need = F.greatest(F.lit(min_docs), F.ceil(min_share * F.col("source_docs") - 1e-9)).cast("long")
    return wide.select("source", "line", need.alias("need"), "source_docs")


def _positions(lines: DataFrame) -> Column:
    """Of lines joined with `_offsets`, the position in the document."""
    return (F.col("n") + F.coalesce("_offset", F.lit(0))).alias("at")


def _offsets(lines: DataFrame) -> DataFrame:
    """`_d, _c, _offset` of the groups of pages that stand behind other lines of their document; there is one row per group."""
    sizes = lines.groupBy("doc", "chunk").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("doc").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(F.col("doc").alias("_d"), F.col("chunk").alias("_c"), before.alias("_offset")).where("_offset > 0")


def _ranked(pairs: DataFrame) -> DataFrame:
    """Distinct rows with their `rank` in sort order; written, because numbers must not change."""
    keys = pairs.columns
    return cut(pairs.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()))


def _in_enough_docs(tests: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct `keys` that stand in `need` documents."""
    return tests.select(*keys, "doc", "need").distinct().groupBy(*keys).agg(F.count("*").alias("_docs"), F.max("need").alias("_need")).where("_docs >= _need").select(*keys)


def occurrences(lines: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """`source, doc, at, item, lines, block, source_docs`: for each line that begins a repeated block the length of the longest one, and an identifier of its content.

    `at` is the line's position in its document. A block is repeated if it stands in at least `min_docs` documents of the source and `min_share` of them.
    Empty inputs give no rows.
    """
    wide = widespread_lines(lines, min_docs, min_share)
    first = _ranked(wide.select("source", "line"))
    named = wide.join(first, ["source", "line"]).select(F.col("source").alias("_s"), F.col("line").alias("_l"), "need", "source_docs", "rank")
    here = lines.join(named, (F.col("source") == F.col("_s")) & (F.col("line") == F.col("_l")))
    here = here.join(_offsets(lines), (F.col("doc") == F.col("_d")) & (F.col("chunk") == F.col("_c")), "left")
    begun = cut(here.select("source", "doc", _positions(here), "item", "need", "source_docs", "rank"))

    # upwards: suffixes ranked by their first 2^k lines, as far as those are repeated
    levels, halves = [begun.select("doc", "at", "need", "rank")], []
    while not levels[-1].isEmpty():
        k = len(levels) - 1
        ahead = levels[k].select(F.col("doc").alias("_d"), (F.col("at") - (1 << k)).alias("_at"), F.col("rank").alias("right"))
        pairs = levels[k].join(ahead, (F.col("doc") == F.col("_d")) & (F.col("at") == F.col("_at"))).select("doc", "at", "need", F.col("rank").alias("left"), "right")
        halves.append(_ranked(_in_enough_docs(pairs, ["left", "right"])))
        levels.append(cut(pairs.join(halves[k], ["left", "right"]).select("doc", "at", "need", "rank")))
    levels.pop()

    # downwards: a block is lengthened by 2^k lines if the longer one is repeated: it stands in enough documents at places of this length, or begins a block found longer (`implied`)
    state = begun.select("source", "doc", "at", "item", "need", "source_docs", F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("block"))
    implied: DataFrame | None = None

    def joined(k: int, rank: str) -> Column:
        return F.xxhash64(F.lit(k), F.col("block"), F.col(rank))

    for k in reversed(range(len(levels))):
        ranks = levels[k].select(F.col("doc").alias("_d"), F.col("at").alias("_at"), "rank")
        tests = state.join(ranks, (F.col("doc") == F.col("_d")) & (F.col("at") + F.col("lines") == F.col("_at")), "left").drop("_d", "_at")
        tried = tests.where("rank is not null")
        good = _in_enough_docs(tried.where("lines > 0"), ["block", "rank"]).unionByName(tried.where("lines = 0").select("block", "rank").distinct())
        if implied is not None:
            good = good.unionByName(implied).distinct()
        good = cut(good)
        known = good.select(F.col("block").alias("_b"), F.col("rank").alias("_r"), joined(k, "rank").alias("_longer"))
        found = F.col("_longer").isNotNull()
        grown = tests.join(known, (F.col("block") == F.col("_b")) & (F.col("rank") == F.col("_r")), "left")
        state = cut(grown.select("source", "doc", "at", "item", "need", "source_docs", (F.col("lines") + F.when(found, 1 << k).otherwise(0)).alias("lines"), F.coalesce("_longer", "block").alias("block")))
        if k:
            # what begins a repeated block is repeated: its first half, and that with the first half of the second
            parts = good.join(halves[k - 1], "rank").select("block", "left", "right")
            first_half = parts.select("block", F.col("left").alias("rank"))
            implied = first_half.unionByName(parts.select(joined(k - 1, "left").alias("block"), F.col("right").alias("rank"))).distinct()
            # only where a place may still be lengthened from
            live = state.select("block").union(first_half.select(joined(k - 1, "rank"))).distinct()
            implied = cut(implied.join(live, "block", "left_semi"))
    return state.select("source", "doc", "at", "item", "lines", "block", "source_docs")


def maximal(found: DataFrame) -> DataFrame:
    """The occurrences that are part of no longer repeated block: the line before begins none that covers them."""
    before = found.select(F.col("doc").alias("_d"), (F.col("at") + 1).alias("_at"), F.col("lines").alias("_before"))
    alone = found.join(before, (F.col("doc") == F.col("_d")) & (F.col("at") == F.col("_at")), "left")
    return alone.where(F.col("_before").isNull() | (F.col("_before") <= F.col("lines"))).drop("_d", "_at", "_before")


def blocks(found: DataFrame) -> DataFrame:
    """`source, lines, first_item, places, docs, source_docs`: blocks of repeated lines, with the places and documents where they stand in no longer repeated block, and the least
    item that begins one there."""
    per_doc = maximal(found).groupBy("source", "lines", "block", "doc").agg(F.count("*").alias("n"), F.min("item").alias("i"), F.max("source_docs").alias("s"))
    whole = per_doc.groupBy("source", "lines", "block").agg(F.min("i").alias("first_item"), F.sum("n").alias("places"), F.count("*").alias("docs"), F.max("s").alias("source_docs"))
    return whole.drop("block")


def repeated_items(found: DataFrame, min_lines: int = 1) -> DataFrame:
    """The `item`s of the lines that are part of a repeated block of at least `min_lines` lines; each once."""
    if min_lines == 1:
        return found.select("item").distinct()  # such a line begins a block, too
    # a line is part of one if a block begins at most min_lines - 1 lines before it
    covered = found.where(F.col("lines") >= min_lines).select(F.col("doc").alias("_d"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(min_lines - 1)), lambda k: F.col("at") + k)).alias("_at"))
    return found.join(covered, (F.col("doc") == F.col("_d")) & (F.col("at") == F.col("_at")), "left_semi").select("item").distinct()


def strip_items(items: DataFrame, found: DataFrame, doc: Column, text: Column, pos: list[str], item: str = "item_id") -> DataFrame:
    """`doc, text, removed`: the lines of each document without the found ones, in reading order, and how many were removed."""
    mine = items.select(doc.alias("doc"), F.struct(*pos, item).alias("pos"), F.col(item).alias("item"), text.alias("line")).where("doc is not null")
    out = mine.join(found.select(F.col("item").alias("_i"), F.lit(True).alias("_out")), F.col("item") == F.col("_i"), "left")
    kept = F.array_sort(F.collect_list(F.when(F.col("_out").isNull(), F.struct("pos", "line"))))
    return out.groupBy("doc").agg(F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("text"), F.count("_out").alias("removed"))
