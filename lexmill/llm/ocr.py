"""Repair of text from scanned pages: page furniture, words broken across lines, misread characters, paragraphs.

The pages are put in reading order once, in groups of pages. Words and pairs of neighbours are counted over all lines, without the halves of broken words. A Levenshtein automaton,
whose single edits include the merges and splits typical of misread print, runs along the trie of all vocabulary words; what both accept are all candidates of a form. How print
is misread is a list of usual confusions and what the corpus itself shows. Candidates are ranked by edits, frequency and neighbours.

No table of words, pairs or forms is held by the driver or broadcast, but for the COMMON words that need no look-up. The vocabulary is cut into shards for the tries; forms, candidates and
neighbours meet by joins. Nothing is decided by an absolute size of the corpus: a word needs MIN_COUNT occurrences, everything else is a ratio.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions.fuzzy import arrow_function
from lexmill.session import cut

WORD = re.compile(r"[^\W_]+(?:[-'’‐‑][^\W_]+)*")
#: What printers and scanners leave where a word is broken: hyphens, a soft hyphen, a not sign. Dashes don't break words.
BREAKS = "-‐‑\xad¬"
BROKEN = re.compile(f"([^\\W_]+(?:[-'’‐‑][^\\W_]+)*)[{BREAKS}]$")
#: Occurrences that make a form a word, and a pair of words usual.
MIN_COUNT, MIN_PAIRS = 5, 5
#: Letters of forms that are looked up.
MIN_LETTERS, MAX_LETTERS = 3, 64
#: A form this many times rarer than a word it can be misread from is a misreading, not a word. A neighbour fits a word this many times better than the form.
DOMINANCE = 20
#: A word with a smaller share of small initials is a proper name, which nothing is corrected to, unless it is as common as NAME_SHARE of all words (months, Congress).
SMALL_SHARE, NAME_SHARE = 0.5, 1e-4
#: Common words that need no look-up; this bounds what is broadcast.
COMMON = 20_000
#: Words per trie.
SHARD_WORDS = 50_000
#: How printed characters are misread, as (printed, read) (fixed values).
CONFUSIONS = [
    ("e", "c"), ("c", "e"), ("o", "a"), ("a", "o"), ("b", "h"), ("h", "b"), ("n", "u"), ("u", "n"), ("s", "f"), ("s", "ſ"), ("f", "ſ"), ("t", "f"),
    ("m", "rn"), ("rn", "m"), ("u", "ii"), ("d", "cl"), ("w", "vv"), ("li", "h"), ("in", "m"), ("ni", "m"), ("ti", "d"), ("i", "l"), ("l", "i"), ("g", "q"),
    ("i", "1"), ("l", "1"), ("s", "5"), ("o", "0"), ("b", "6"), ("b", "8"), ("s", "8"), ("g", "9"), ("a", "4"), ("z", "2"), ("e", "3"), ("t", "7"),
]
#: Costs of edits: a usual confusion, another substitution within the word, any other edit. Branches beyond MOST can't be accepted.
USUAL, PLAIN, EDGE, MOST = 1.0, 6.0, 20.0, 20.5
#: A substitution that isn't listed is usual if it is this share of all single edits between rare forms and words, and seen in so many pairs.
LEARNED_SHARE, LEARNED_PAIRS = 0.002, 10
#: After a hyphen these words stand for themselves (fixed values).
SUSPENDED = {"and", "or", "nor", "to", "but"}


# ---- candidates


class Channel:
    """Usual confusions by what is read, for one direction of reading."""

    def __init__(self, usual: list[tuple[str, str]], backwards: bool = False):
        turn = (lambda x: x[::-1]) if backwards else (lambda x: x)
        self.single = {(p, r) for p, r in usual if len(p) == len(r) == 1}
        self.merged: dict[str, list[str]] = {}
        self.split: dict[str, list[str]] = {}
        for printed, read in usual:
            if len(printed) == 2:
                self.merged.setdefault(read, []).append(turn(printed))
            elif len(read) == 2:
                self.split.setdefault(turn(read), []).append(printed)


def trie_of(words: Iterator[str]) -> dict:
    """Nested dicts of characters; the key "" holds the word that ends at a node."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def bound(form: str) -> int:
    """Edits within which a form's candidates lie."""
    return 1 if len(form) < 6 else 2 if len(form) < 9 else 3


class Automaton:
    """Levenshtein automata over the trie of some words and that of the words reversed.

    The states are (characters of the form consumed, edits used). Of two or three edits at most one lies in the first half of the form, or at most one in the
    second. So the forward trie is searched with one edit in the first half, and the reversed trie likewise: neither opens many branches near its root.
    """

    def __init__(self, words: list[str], usual: list[tuple[str, str]]):
        self.forward, self.backward = trie_of(words), trie_of(w[::-1] for w in words)
        self.usual, self.turned = Channel(usual), Channel(usual, True)

    def candidates(self, form: str, errors: int | None = None, most: float = MOST) -> dict[str, float]:
        """All words at most `errors` edits from the form whose edits cost no more than `most`, with the least cost."""
        errors, n, out = bound(form) if errors is None else errors, len(form), {}
        half = n // 2
        self._search(self.forward, form, errors, half - 1 if errors > 1 else 0, most, self.usual, (1, n - 2), out)
        if errors > 1:
            back: dict[str, float] = {}
            self._search(self.backward, form[::-1], errors, n - half, most, self.turned, (2, n - 1), back)
            for w, cost in back.items():
                out[w[::-1]] = min(cost, out.get(w[::-1], cost))
        out.pop(form, None)
        return out

    @staticmethod
    def _search(root: dict, read: str, errors: int, free: int, most: float, ch: Channel, within: tuple[int, int], out: dict[str, float]) -> None:
        """Add what is found to `out`. Before character `free` only the first edit may begin; `within` are the characters whose substitution is a plain edit."""
        n, single, merged, split = len(read), ch.single, ch.merged, ch.split

        def run(node: dict, i: int, used: int, cost: float) -> None:
            while True:
                if used < errors and cost < most and (not used or i >= free):
                    u, edge, c = used + 1, cost + EDGE <= most, read[i : i + 1]
                    if edge and c:
                        run(node, i + 1, u, cost + EDGE)
                    for p, child in node.items():
                        if not p:
                            continue
                        if edge:
                            run(child, i, u, cost + EDGE)
                        if c and p != c:
                            like = (p, c) in single or c.isdigit() and p.isalpha()
                            then = cost + (USUAL if like else PLAIN if within[0] <= i < within[1] else EDGE)
                            if then <= most:
                                run(child, i + 1, u, then)
                    usual = c and cost + USUAL <= most
                    for p in merged.get(c, ()) if usual else ():
                        if (child := node.get(p[0])) and (child := child.get(p[1])):
                            run(child, i + 1, u, cost + USUAL)
                    for p in split.get(read[i : i + 2], ()) if usual else ():
                        if child := node.get(p):
                            run(child, i + 2, u, cost + USUAL)
                if i == n:
                    w = node.get("")
                    if w is not None and cost < out.get(w, most + 1):
                        out[w] = cost
                    return
                node = node.get(read[i])
                if node is None:
                    return
                i += 1

        run(root, 0, 0, 0.0)


def look_up(forms: DataFrame, words: DataFrame, usual: list[tuple[str, str]]) -> DataFrame:
    """`form, word, cost`: all candidates among `words` (word) of the distinct `forms` (form).

    The words are cut into shards of about SHARD_WORDS, each with its own trie, and every form meets every shard. Forms are spread over as many tasks as a shuffle has;
    each task has the words of its shards.
    """
    spark = forms.sparkSession
    shards = words.count() // SHARD_WORDS + 1
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    w = words.select(F.pmod(F.hash("word"), F.lit(shards)).alias("shard"), copies.alias("salt"), F.lit(0).alias("is_form"), F.col("word").alias("x"))
    f = forms.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.hash("form"), F.lit(spread)).alias("salt"), F.lit(1).alias("is_form"), F.col("form").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine, automaton = None, [], None
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for shard, salt, is_form, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (shard, salt) != at:
                    at, mine, automaton = (shard, salt), [], None
                if not is_form:
                    mine.append(x)
                    continue
                automaton = automaton or Automaton(mine, usual)
                for word, cost in automaton.candidates(x).items():
                    for column, value in zip(out, (x, word, cost), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.float64())], names=["form", "word", "cost"])

    return w.unionByName(f).repartition(spread, "shard", "salt").sortWithinPartitions("shard", "salt", "is_form").mapInArrow(run, "form string, word string, cost double")


# ---- page furniture

_ALIKE = str.maketrans({"0": "O", "1": "I", "l": "I", "5": "S", "8": "B", "6": "B", "4": "A", "G": "C", "—": "-", "–": "-", "‐": "-", "\xad": "-", "¬": "-"})
_D = "[OISBA2379]"
_N, _END = f"{_D}+", r"[.,;:]*"
_PAGE, _DATE = f"[A-Z]?{_N}", f"[A-Z]{{3,5}}[.,]* {_N}[.,]* {_N}"
_KIND = r"[A-Z.,]{3,}(?: [A-Z.,]{2,}){0,3}"
#: Running heads: volume page, law with number and date, chapter with date, congress with session and chapters. Matched on
#: text whose look-alike characters are made equal.
HEADS = re.compile(
    "|".join([
        f"{_N} [S5][TF][AO][TF]{_END} {_PAGE}", f"{_PAGE} {_N} [S5][TF][AO][TF]{_END}",
        f"{_KIND} {_N} ?- ?{_N} ?- ?{_DATE}", f"(?:{_PAGE} )?{_KIND} ?- ?CH{_END} {_N} ?- ?{_DATE}",
        f"{_N}[A-Z]{{2}} CON[CO]{_END} SESS{_END} [IVX]+{_END} CHS?{_END} {_N}[.,]* {_N}[.,]* {_N}",
        rf"[A-Z-]+(?: [A-Z-]+)* CON[CO]RESS{_END} CH{_END} {_N}[.,]* {_N}[.,]* [\[(I]?{_PAGE}[\])]?",
    ])
)
_NUMBER = re.compile(r"(?:page|pg\.?|p\.)? ?[\[\-–— ]*([a-z]?[0-9loisb]+)[\]\-–— ]*\.?", re.I)
GRANULE_PAGE = re.compile(r"-Pg([A-Za-z]?)(\d+)(?:-\d+)?$", re.I)


def alike(text: str) -> str:
    return text.translate(_ALIKE).upper()


#: Characters one of which is among the last three of a running head that doesn't end with `Stat.`
_TAIL = frozenset("0123456789lISOB]")


def is_running_head(text: str) -> bool:
    """Whether a whole line is a running head."""
    if len(text) > 90 or _TAIL.isdisjoint(text[-3:]) and text[-5:-1].lower() not in ("stat", "sfat", "stot"):
        return False
    return HEADS.fullmatch(alike(text).rstrip(".,;:")) is not None


def is_page_number(text: str, page: str | None) -> bool:
    """Whether a line holds only the number of its page."""
    if page is None or len(text) > 16:
        return False
    m = _NUMBER.fullmatch(text)
    return m is not None and alike(m[1]) == alike(page)


@functools.lru_cache(64)
def first_page(granule: str | None) -> tuple[str, int] | None:
    """Letter and number of a granule's first page, from its id."""
    m = GRANULE_PAGE.search(granule or "")
    return (m[1].upper(), int(m[2])) if m else None


def page_label(granule: str | None, page_no: int | None) -> str | None:
    """The printed number of a granule's page: its first page, and the pages since."""
    first = first_page(granule)
    return first[0] + str(first[1] + page_no - 1) if first and page_no is not None else None


# ---- lines in reading order

#: Pages of a granule that one group has, and pages of the neighbouring groups that it sees before and after them.
GROUP_PAGES, SEEN_BEFORE, SEEN_AFTER = 64, 1, 2
GROUP = ["granule", "grp"]


def content_lines(items: DataFrame, granule: Column, text: Column, notices: DataFrame | None = None) -> DataFrame:
    """`granule, page_no, item_no, item_id, text, aside`: the lines. NULL texts are left out; a line without a granule is its own. Items in
    `notices` (`item`) stand aside: no word goes on in them, and paragraphs go on behind them."""
    own = F.concat(F.lit("?"), F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    lines = items.select(F.coalesce(granule, own).alias("granule"), "page_no", "item_no", "item_id", text.alias("text")).where("text is not null")
    if notices is None:
        return lines.withColumn("aside", F.lit(False))
    known = notices.select(F.col("item").alias("_item")).distinct().withColumn("aside", F.lit(True))
    return lines.join(known, F.col("item_id") == F.col("_item"), "left").drop("_item").withColumn("aside", F.coalesce("aside", F.lit(False)))


ORDERED = "granule string, grp int, own boolean, page_no int, item_no int, item_id long, text string, aside boolean, furniture boolean"
COUNTED = "a string, b string, n long, small long"
#: Distinct words and pairs that a task counts before it hands them on.
FLUSH = 200_000


@dataclass
class Pages:
    """`lines` (ORDERED): the lines of each group of pages in reading order, group by group; `own` lines belong to the group, the others are pages of its neighbours. `counts` (COUNTED): occurrences of
    words (b NULL; `small`: with a small initial) and of pairs of neighbours in a line, without the halves of broken words."""

    lines: DataFrame
    counts: DataFrame


class Tally:
    """Words and pairs as printed, until they are handed on."""

    def __init__(self) -> None:
        self.words: Counter = Counter()
        self.pairs: Counter = Counter()
        self.group: tuple | None = None
        self.goes_on = False

    def add(self, group: tuple, own: bool, aside: bool, text: str) -> None:
        """The next line of running text, or a notice."""
        if group != self.group:
            self.group, self.goes_on = group, False
        words = WORD.findall(text)
        tail = tail_of(text, words)
        if own:
            ws = words[self.goes_on and not aside : len(words) - (tail is not None)]
            self.words.update(ws)
            self.pairs.update(zip(ws, ws[1:], strict=False))
        if not aside:
            self.goes_on = tail is not None

    def hand_on(self) -> list[pa.Array]:
        words, small, pairs = Counter(), Counter(), Counter()
        for w, n in self.words.items():
            words[w.lower()] += n
            small[w] += n if w[0].islower() else 0
        for (x, y), n in self.pairs.items():
            pairs[x.lower(), y.lower()] += n
        self.words.clear()
        self.pairs.clear()
        a, b = [*words, *(p[0] for p in pairs)], [*[None] * len(words), *(p[1] for p in pairs)]
        return [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array([*words.values(), *pairs.values()], pa.int64()), pa.array([*(small[w] for w in words), *[0] * len(pairs)], pa.int64())]


def tail_of(text: str, words: list[str]) -> str | None:
    """The word that a line breaks off at its end."""
    return words[-1] if words and text[-1] in BREAKS and text.endswith(words[-1], 0, -1) else None


def in_order(lines: DataFrame) -> Pages:
    """Lines in reading order, with single blanks and `furniture`, and the counts of their words. Blank lines are left out. A long granule
    has several groups, so no task needs a whole granule. Repeated rows of an item count once; NULL page numbers stand before others, and a line there is furniture only as a running head.

    Both come from one pass over the lines, and are written to the checkpoint folder, where every further step reads them in this order.
    """
    page = F.coalesce("page_no", F.lit(0))
    at, group = F.pmod(page, F.lit(GROUP_PAGES)), F.floor(page / GROUP_PAGES).cast("int")
    groups = F.array_compact(F.array(group, F.when((at < SEEN_AFTER) & (group != 0), group - 1), F.when(at >= GROUP_PAGES - SEEN_BEFORE, group + 1)))
    spread = lines.select("granule", "page_no", "item_no", "item_id", "text", "aside", group.alias("_mine"), F.explode(groups).alias("grp")).withColumn("own", F.col("_mine") == F.col("grp"))
    columns, counted = ([x.split()[0] for x in t.split(", ")] for t in (ORDERED, COUNTED))
    sorted_ = spread.select(*columns[:-1]).repartition(*GROUP).sortWithinPartitions(*GROUP, "page_no", "item_no", "item_id", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tally, empty = None, Tally(), None

        def counts() -> pa.RecordBatch:
            found = tally.hand_on()
            return pa.RecordBatch.from_arrays([*[pa.nulls(len(found[0]), t) for t in empty], *found], names=[*columns, *counted])

        for b in batches:
            granules, grps, owns, pages, items, texts, asides = (b.column(c).to_pylist() for c in ("granule", "grp", "own", "page_no", "item_id", "text", "aside"))
            keep, flags, flat = [], [], []
            for i, raw in enumerate(texts):
                text = " ".join(raw.split())
                line = (granules[i], grps[i], items[i], text)
                if not text or line == last:
                    continue
                last = line
                furniture = is_running_head(text) or is_page_number(text, page_label(granules[i], pages[i]))
                keep.append(i)
                flags.append(furniture)
                flat.append(text)
                if not furniture:
                    tally.add((granules[i], grps[i]), owns[i], asides[i], text)
            b = b.take(pa.array(keep, pa.int64())).set_column(6, "text", pa.array(flat, pa.string()))
            none = [pa.nulls(len(keep), t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(flags, pa.bool_()), *none], names=[*columns, *counted])
            empty = [*(c.type for c in b.columns), pa.bool_()]
            if len(tally.pairs) > FLUSH:
                yield counts()
        if empty:
            yield counts()

    both = cut(sorted_.mapInArrow(read, f"{ORDERED}, {COUNTED}"))
    counts = both.where("n is not null").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("small").alias("small"))
    return Pages(both.where("n is null").select(*columns), counts)


@dataclass(slots=True)
class Line:
    own: bool
    aside: bool
    item: int
    words: list[str]  # as printed
    head: str  # the word the line begins with, if it begins with one
    broken: str | None  # the word that the line ends in a break of


def read_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Line]]:
    """The lines of each group in order, without furniture."""
    at, group, lines, find = None, None, [], WORD.findall
    for b in batches:
        b = b.filter(pc.invert(b.column("furniture")))
        for granule, grp, own, item, text, aside in zip(*(b.column(c).to_pylist() for c in ("granule", "grp", "own", "item_id", "text", "aside")), strict=True):
            if granule != at or grp != group:
                if lines:
                    yield lines
                at, group, lines = granule, grp, []
            words = find(text)
            lines.append(Line(own, aside, item, words, words[0] if words and text.startswith(words[0]) else "", tail_of(text, words)))
    if lines:
        yield lines


# ---- the corpus's own language

@dataclass
class Lexicon:
    """`words` (word, n, name), `forms` (form, n: all that occur), `pairs` (a, b, n), the usual confusions, and common words that are never in doubt."""

    words: DataFrame
    forms: DataFrame
    pairs: DataFrame
    usual: list[tuple[str, str]]
    common: frozenset[str]


def _one_edit(word: Column, form: Column) -> Column:
    """Of equally long strings that differ in one character: (printed, read)."""
    at = F.filter(F.sequence(F.lit(1), F.length(form)), lambda i: F.substr(word, i, F.lit(1)) != F.substr(form, i, F.lit(1)))
    return F.when((F.length(word) == F.length(form)) & (F.size(at) == 1), F.struct(F.substr(word, at[0], F.lit(1)).alias("p"), F.substr(form, at[0], F.lit(1)).alias("r")))


def learn(pages: Pages, min_count: int = MIN_COUNT) -> Lexicon:
    """The lexicon of all lines."""
    return lexicon(cut(pages.counts), min_count)


def lexicon(counts: DataFrame, min_count: int = MIN_COUNT) -> Lexicon:
    """The lexicon from counts as of Pages. A form with `min_count` occurrences is a word, unless it is a misreading of a much commoner one."""
    single = counts.where(F.col("b").isNull() & (F.col("n") >= min_count) & ~F.col("a").rlike("^[0-9]*$") & (F.length("a") <= MAX_LETTERS))
    total = counts.where("b is null").agg(F.sum("n")).first()[0] or 0
    name = (F.col("small") < SMALL_SHARE * F.col("n")) & (F.col("n") < NAME_SHARE * total)
    words = cut(single.select(F.col("a").alias("word"), "n", name.alias("name")))
    inner = _looked_up(words.select(F.col("word").alias("form"), F.col("n").alias("nf")))
    found = cut(look_up(inner.select("form"), _targets(words), CONFUSIONS).join(inner, "form").join(words.select("word", "n"), "word"))
    rarer = found.where(F.col("n") >= DOMINANCE * F.col("nf"))
    # substitutions that come up again and again between rare forms and common words are usual, too
    edits = rarer.select(_one_edit(F.col("word"), F.col("form")).alias("e"), "nf").where("e is not null").groupBy("e").agg(F.sum("nf").alias("mass"), F.count("*").alias("pairs"))
    edits = edits.select("e.*", "mass", "pairs").collect()  # at most one row per pair of characters
    mass = sum(r.mass for r in edits)
    more = [(r.p, r.r) for r in edits if r.mass >= LEARNED_SHARE * mass and r.pairs >= LEARNED_PAIRS]
    usual = sorted({*CONFUSIONS, *more})
    if set(more) - set(CONFUSIONS):
        found = cut(look_up(inner.select("form"), _targets(words), usual).join(inner, "form").join(words.select("word", "n"), "word"))
        rarer = found.where(F.col("n") >= DOMINANCE * F.col("nf"))
    wrong = rarer.where(F.col("cost") < PLAIN).select(F.col("form").alias("word")).distinct()
    right = cut(words.join(wrong, "word", "left_anti"))
    doubtful = found.where(F.col("cost") < PLAIN).select("form", "word").join(right.select("word"), "word", "left_semi").select(F.col("form").alias("word")).distinct()
    sure = right.where(~F.col("word").contains("-")).join(doubtful, "word", "left_anti").orderBy(F.desc("n"), "word").limit(COMMON)
    forms, pairs = counts.where("b is null").select(F.col("a").alias("form"), "n"), counts.where("b is not null").select("a", "b", "n")
    return Lexicon(right, forms, pairs, usual, frozenset(r.word for r in sure.select("word").collect()))


def _looked_up(forms: DataFrame) -> DataFrame:
    """The forms that can be misread words: MIN_LETTERS to MAX_LETTERS characters with a letter, no compounds."""
    c = F.col("form")
    return forms.where(F.length(c).between(MIN_LETTERS, MAX_LETTERS) & ~c.contains("-") & c.rlike(r"\p{L}"))


def _targets(words: DataFrame) -> DataFrame:
    """The words that forms are corrected to."""
    return words.where(~F.col("name") & (F.length("word") >= MIN_LETTERS)).select("word")


# ---- repair


@dataclass
class Repairs:
    """`joins` (item_id, joined, taker, between), `fixes` (item_id, at, printed, fixed): words whose first part ends a line and goes on in the line `taker`, behind the items
    `between`; the misread words of lines, `at` the n-th of the line."""

    ordered: DataFrame
    joins: DataFrame
    fixes: DataFrame


SEEN = "kind string, item_id long, at int, printed string, form string, before string, after string, edge string, taker long, tail string, head string"


def examine(lines: DataFrame, common: frozenset[str]) -> DataFrame:
    """What has to be looked up, in reading order (SEEN): words (`kind` w) that aren't common, with their neighbours, also in the lines before and after; `edge` says that a word begins a line behind a broken
    one, or ends a broken one. And the lines (`kind` j) that may go on with the broken word of a line, up to one where nothing can go on."""
    names = [x.split()[0] for x in SEEN.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.string()]
    known = lines.sparkSession.sparkContext.broadcast(common)

    def word_rows(lines: list[Line], k: int, have: frozenset[str]) -> Iterator[tuple]:
        x = lines[k]
        low = [w.lower() for w in x.words]
        behind = bool(k and lines[k - 1].broken)
        for i in [i for i, w in enumerate(low) if w not in have]:
            w = low[i]
            if len(w) < MIN_LETTERS or len(w) > MAX_LETTERS or "-" in w or w.isdigit():
                continue
            edge = "first" if behind and not i else "last" if x.broken and i == len(low) - 1 else None
            before = low[i - 1] if i else lines[k - 1].words[-1].lower() if k and not behind and lines[k - 1].words else ""
            after = low[i + 1] if i + 1 < len(low) else lines[k + 1].words[0].lower() if k + 1 < len(lines) and not x.broken and lines[k + 1].words else ""
            yield "w", x.item, i, x.words[i], w, before, after, edge, None, None, None

    def join_rows(lines: list[Line], k: int, have: frozenset[str]) -> Iterator[tuple]:
        tail, n = lines[k].broken, 0
        for j in range(k + 1, len(lines)):
            y = lines[j]
            yield "j", lines[k].item, n, None, None, None, None, None, y.item, tail, y.head
            n += 1
            # `coast- and river-borne`: nothing goes on; nor behind another broken word, nor behind a word that is surely whole
            if y.head in SUSPENDED or y.broken or y.head and (tail + y.head).lower() in have:
                return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        have = known.value

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            out.clear()
            return batch

        for every in read_groups(batches):
            lines = [x for x in every if not x.aside]
            for k, x in enumerate(lines):
                if x.own:
                    out.extend(word_rows(lines, k, have))
                    if x.broken:
                        out.extend(join_rows(lines, k, have))
            for x in every:
                if x.own and x.aside:
                    out.extend(word_rows([x], 0, have))
            if len(out) > 20_000:
                yield flush()
        yield flush()

    return lines.select(*[c for c in lines.columns if c not in ("page_no", "item_no")]).mapInArrow(run, SEEN)


def repair(pages: Pages, lex: Lexicon) -> Repairs:
    """What is broken and misread in the lines of in_order.

    A known word is only corrected along usual confusions, and if both neighbours fit another reading DOMINANCE times better. An unknown form is corrected to a word DOMINANCE times as common along usual confusions, of
    which a long word may have several; one other substitution within it is accepted in a word of ten letters, or, with any other single edit, where both neighbours fit.
    """
    seen = cut(examine(pages.lines, lex.common))
    words, whole = seen.where("kind = 'w'"), F.lower(F.concat("tail", "head"))
    joins = seen.where("kind = 'j'").select("item_id", "at", "taker", "head", F.col("tail"), whole.alias("plain"), F.lower(F.concat_ws("-", "tail", "head")).alias("compound"))
    asked = words.select("form").union(joins.select(F.explode(F.array("plain", "compound")))).distinct()
    known = lex.words.select(F.col("word").alias("form"), F.lit(True).alias("known"))
    forms = cut(_looked_up(asked).join(known, "form", "left").join(lex.forms.select("form", F.col("n").alias("nf")), "form", "left").withColumn("nf", F.coalesce("nf", F.lit(1))))
    targets = lex.words.select("word", "n")
    rows = look_up(forms.select("form"), _targets(lex.words), lex.usual).join(targets, "word").join(forms, "form")
    rows = rows.where(F.when(F.col("known"), F.col("cost") < PLAIN).otherwise(F.col("n") >= DOMINANCE * F.col("nf")))
    usual, long_ = F.col("cost") < PLAIN, F.length("form") >= 10
    found = cut(rows.select("form", "word", "n", "nf", "known", usual.alias("usual"), (usual | (long_ & (F.col("cost") < 2 * PLAIN))).alias("alone"), (F.col("cost") - 0.1 * F.log("n")).alias("score")))
    fixes = _misread(words, found, lex)
    joined = cut(_joined(joins, found.where("known is null and alone"), lex))
    taken, done = joined.select(F.col("taker").alias("item_id")), joined.select("item_id")
    first, last = F.col("edge") == "first", F.col("edge") == "last"
    open_ = fixes.where("edge is null").unionByName(fixes.where(first).join(taken, "item_id", "left_anti")).unionByName(fixes.where(last).join(done, "item_id", "left_anti"))
    return Repairs(pages.lines, joined, open_.select("item_id", "at", "printed", "fixed"))


def _misread(words: DataFrame, found: DataFrame, lex: Lexicon) -> DataFrame:
    """`item_id, at, printed, edge, fixed` of the examined words that have an accepted candidate."""
    keys, facts = ["item_id", "at", "printed", "edge", "form", "word"], ["n", "nf", "known", "usual", "alone", "score"]
    asked = F.array(*[F.struct(F.lit(side).alias("side"), a.alias("a"), b.alias("b")) for side, a, b in (
        ("wb", F.col("before"), F.col("word")), ("wa", F.col("word"), F.col("after")), ("fb", F.col("before"), F.col("form")), ("fa", F.col("form"), F.col("after")))])
    sides = words.join(found, "form").select(*keys, *facts, F.inline(asked))
    counted = sides.join(lex.pairs.select("a", "b", F.col("n").alias("pairs")), ["a", "b"], "left").groupBy(*keys)
    both = counted.agg(*[F.max(c).alias(c) for c in facts], *[F.max(F.when(F.col("side") == s, F.coalesce("pairs", F.lit(0)))).alias(s) for s in ("wb", "wa", "fb", "fa")])
    fits = lambda w, f: ((F.col(w) >= MIN_PAIRS) & (F.col(w) >= DOMINANCE * F.col(f))).cast("int")
    both = both.withColumn("fit", fits("wb", "fb") + fits("wa", "fa"))
    rare = F.col("n") >= DOMINANCE**2 * F.col("nf")
    context = (F.length("form") > 4) & F.col("form").rlike(r"^\p{L}+$") & rare & (F.col("fit") == 2)
    accepted = F.when(F.col("known"), F.col("usual") & (F.col("fit") == 2)).otherwise(F.col("alone") | context)
    best = F.min(F.struct((F.col("score") - 2.0 * F.col("fit")).alias("score"), "word"))
    return both.where(accepted).groupBy("item_id", "at", "printed", "edge").agg(best.alias("b")).select("item_id", "at", "printed", "edge", F.col("b.word").alias("fixed"))


def _joined(joins: DataFrame, found: DataFrame, lex: Lexicon) -> DataFrame:
    """`item_id, joined, taker, between`: for each broken word the first line that goes on with it."""
    best = found.groupBy("form").agg(F.min(F.struct("score", "word")).alias("b")).select("form", F.col("b.word").alias("fixed"))
    asked = F.array(*[F.struct(F.lit(k).alias("what"), f.alias("form")) for k, f in (("plain", F.col("plain")), ("compound", F.col("compound")), ("head", F.lower("head")))])
    keys = ["item_id", "at", "taker", "head", "plain", "compound"]
    each = joins.select(*keys, F.inline(asked))
    info = lex.words.select(F.col("word").alias("form"), "n").join(best, "form", "full")
    d = each.join(info, "form", "left").groupBy(*keys).agg(*[F.max(F.when(F.col("what") == w, F.col(v))).alias(f"{w}_{v}") for w in ("plain", "compound", "head") for v in ("n", "fixed")])
    a, b = F.coalesce("plain_n", F.lit(0)), F.coalesce("compound_n", F.lit(0))
    initial, head_known = F.substring("head", 1, 1).rlike(r"^\p{Ll}"), F.col("head_n").isNotNull()
    fragment = ~head_known & initial & ~F.col("head").rlike("[0-9]")
    word = F.when((a > 0) | (b > 0), F.when(a >= b, F.col("plain")).otherwise(F.col("compound"))).otherwise(F.coalesce("plain_fixed", "compound_fixed", F.when(fragment, F.col("plain"))))
    sure = (a > 0) | (b > 0) | F.col("plain_fixed").isNotNull() | F.col("compound_fixed").isNotNull()
    before = Window.partitionBy("item_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # behind a line that may go on with a word of its own, only a known word goes on
    whole = F.max(initial & head_known).over(before)
    d = d.withColumn("word", F.when(F.col("head") != "", word)).withColumn("ok", F.col("word").isNotNull() & (sure | ~F.coalesce(whole, F.lit(False))))
    first = d.groupBy("item_id").agg(F.min(F.when(F.col("ok"), F.struct("at", "word", "taker"))).alias("f"), F.collect_list(F.struct("at", "taker")).alias("l")).where("f is not null")
    return first.select("item_id", F.col("f.word").alias("joined"), F.col("f.taker").alias("taker"), F.transform(F.filter("l", lambda x: x["at"] < F.col("f.at")), lambda x: x["taker"]).alias("between"))


def findings(r: Repairs) -> DataFrame:
    """`item_id, kind, fixed`: furniture, words broken across lines, misread words."""
    furniture = r.ordered.where("own and furniture").select("item_id", F.lit("furniture").alias("kind"), F.lit("").alias("fixed"))
    hyphens = r.joins.select("item_id", F.lit("hyphen").alias("kind"), F.col("joined").alias("fixed"))
    misread = r.fixes.select("item_id", F.lit("misread").alias("kind"), "fixed")
    return furniture.unionByName(hyphens).unionByName(misread).distinct()


# ---- paragraphs

#: What begins a new paragraph wherever it stands (fixed values).
OPENERS = re.compile(r"(?:sec(?:tion)?[.,]? ?[0-9l]|§|article|\([0-9a-z]{1,4}\)|[*†‡\[|])", re.I)


def piece(text: str, joined: str | None, taken: bool | None, fixes: list | None) -> str:
    """The line's part of the repaired text: with the whole of the word that it breaks off, without the rest of one that begins before it, its misread words right."""
    if joined:
        m = BROKEN.search(text)
        whole = m[1] + joined[len(m[1]) :] if joined.startswith(m[1].lower()) else joined
        text = text[: m.start()] + whole
    if taken:
        m = WORD.match(text)
        text = text[m.end() :] if m else text
    for _, form, word in sorted(tuple(x) if not isinstance(x, dict) else tuple(x.values()) for x in (fixes if fixes is not None else ())):
        right = word.upper() if form.isupper() and len(form) > 1 and form.isalpha() else word.capitalize() if not form[0].islower() and not form[0].isdigit() else word
        text = re.sub(rf"(?<!\w){re.escape(form)}(?!\w)", right, text, count=1)
    return text.strip()


#: A line this much shorter than the granule's usual ones (their upper quartile) may end a paragraph.
SHORT = 0.8


def paragraphs_of(r: Repairs) -> DataFrame:
    """`granule, para_no, text, notices`: continuous paragraphs of each granule, from 1, without furniture; the notices that stand within a paragraph or behind it
    (para_no 0: before the first) are kept beside it.

    A line opens a paragraph if it carries a number or mark, or if the line of running text before it ends a sentence short of the granule's usual width. Lines are read and numbered within groups of pages;
    the last line and the number of paragraphs of the groups before are handed on.
    """
    none = F.lit(None)
    info = r.joins.select("item_id", "joined", none.cast("boolean").alias("taken"), none.cast("boolean").alias("between"))
    info = info.unionByName(r.joins.select(F.col("taker").alias("item_id"), none.cast("string").alias("joined"), F.lit(True).alias("taken"), none.cast("boolean").alias("between")))
    info = info.unionByName(r.joins.select(F.explode("between").alias("item_id"), none.cast("string").alias("joined"), none.cast("boolean").alias("taken"), F.lit(True).alias("between")))
    info = info.groupBy("item_id").agg(F.max("joined").alias("joined"), F.max("taken").alias("taken"), F.max("between").alias("between"))
    fixes = r.fixes.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("at", "printed", "fixed"))).alias("fixes"))
    lines = r.ordered.where("not furniture").join(info, "item_id", "left").join(fixes, "item_id", "left")
    width = r.ordered.where("own and not furniture").groupBy(F.col("granule").alias("_g")).agg((SHORT * F.percentile(F.length("text"), 0.75)).alias("width"))
    lines = lines.join(width, F.col("granule") == F.col("_g")).withColumn("running", ~F.col("aside") & F.col("between").isNull())

    order = Window.partitionBy(*GROUP).orderBy("page_no", "item_no", "item_id")
    this = F.when(F.col("running"), F.struct("text", "joined"))
    lines = lines.withColumn("before", F.last(this, True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    ends = lines.where("own").groupBy(*GROUP).agg(F.max_by(this, F.when(F.col("running"), F.struct("page_no", "item_no", "item_id"))).alias("end"))
    handed = F.last("end", True).over(Window.partitionBy("granule").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(*[F.col(c).alias(f"_{c}") for c in GROUP], handed.alias("handed"))
    same = [F.col(c) == F.col(f"_{c}") for c in GROUP]
    lines = lines.where("own").join(ends, same, "left").withColumn("before", F.coalesce("before", "handed"))
    mark, ended = F.col("text").rlike(f"(?i)^{OPENERS.pattern}"), F.col("before.text").rlike(r"[.:;\]]$") & (F.length("before.text") < F.col("width")) & F.col("before.joined").isNull()
    opens = F.col("running") & F.col("taken").isNull() & (F.col("before").isNull() | mark | (ended & ~F.col("text").rlike(r"^\p{Ll}")))
    lines = lines.withColumn("opens", F.coalesce(opens, F.lit(False)).cast("int"))
    lines = lines.withColumn("n", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("handed", *[f"_{c}" for c in GROUP])
    before = F.sum("opened").over(Window.partitionBy("granule").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1))
    offsets = lines.groupBy(*GROUP).agg(F.sum("opens").alias("opened")).select(*[F.col(c).alias(f"_{c}") for c in GROUP], F.coalesce(before, F.lit(0)).alias("offset"))
    lines = lines.join(offsets, same).withColumn("para_no", F.col("n") + F.col("offset"))
    rows = lambda *columns: [piece(*x) for x in zip(*columns, strict=True)]
    lines = lines.withColumn("piece", arrow_function(rows, "string", F.col("text"), F.col("joined"), F.coalesce("taken", F.lit(False)), F.col("fixes")))

    def parts(keep: Column) -> Column:
        there = F.array_sort(F.collect_list(F.when(keep & (F.col("piece") != ""), F.struct("page_no", "item_no", "item_id", "piece"))))
        return F.transform(there, lambda x: x["piece"])

    return lines.groupBy("granule", "para_no").agg(F.array_join(parts(F.col("running")), " ").alias("text"), parts(~F.col("running")).alias("notices"))
