"""The text problems: brute force, round trips, held-out accuracy, and cases of nulls, ties, repeated rows, empty tables and clashing columns."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.llm import langid, ocr, packing, queries, repeats, tokenize

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenize.VOCABULARY, "rb") as f:
        return f.read()


# ---- 7


@pytest.mark.parametrize("leaf, run", [(5, 7), (16, 4), (8192, 256)])
def test_encoding_by_halves_is_exact(vocabulary, leaf, run):
    enc, rng = tokenize.TreeEncoder(vocabulary, leaf_chars=leaf, long_run=run), random.Random(1)
    alphabet = "ab é\n\t'st 12日  \x1c\x85 　.,-\r 😀|<>endoftext"
    for _ in range(1500):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70)))
        assert enc.encode(s) == enc.bpe.encode_ordinary(s), repr(s)
        assert enc.count(s) == len(enc.encode(s))


@pytest.mark.parametrize("s", ["a" * 20000, "日本語" * 4000, "ab" * 9000 + " x", " " * 9999 + "x", "=-" * 9000, "the" * 6000 + "\n" * 3001, "x" * 8192 + " y"])
def test_long_unsplit_texts(vocabulary, s):
    enc = tokenize.TreeEncoder(vocabulary)
    assert enc.encode(s) == enc.bpe.encode_ordinary(s)


def test_encoding_of_a_frame(spark, vocabulary):
    enc = tokenize.TreeEncoder(vocabulary)
    texts = [None, "", " ", "Words and <|endoftext|> words", "long text, " * 400, "y" * 3000, "same", "same", "ﬁ 😀 \x00"]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "null key", 1, "x")], "doc_id long, text string, ids int, _key string")
    for spread in (1 << 20, 500):
        got = {r.doc_id: r.ids for r in tokenize.encode_texts(df, "doc_id", "text", spread_chars=spread).collect()}
        assert got == {i: enc.bpe.encode_ordinary(t or "") for i, t in enumerate(texts)} | {None: enc.bpe.encode_ordinary("null key")}
    assert tokenize.encode_texts(df.limit(0), "doc_id", "text").count() == 0


def test_ids_of_the_whole_table(spark, vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenize.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r.ids for r in queries.p7_ids(spark, DATA).collect()}
    assert got == {k: t.encode(v, add_special_tokens=False).ids for k, v in text.items()}


# ---- 8


def _check_plan(sizes, capacity):
    steps = packing.plan_containers(sizes, capacity)
    used = Counter()
    for pattern, times in steps:
        assert times > 0 and sum(pattern) <= capacity
        for s in pattern:
            used[s] += times
    assert used == Counter({s: n for s, n in sizes.items() if n})
    return sum(times for _, times in steps)


def test_plans_use_every_item_once_and_fill_well():
    rng = random.Random(2)
    for capacity in (1, 7, 64, 512):
        for _ in range(30):
            sizes = {s: rng.choice([1, 1, 2, 5, 1000]) for s in range(1, capacity + 1) if rng.random() < rng.choice([0.02, 0.3, 0.9])}
            n = _check_plan(sizes, capacity)
            total = sum(s * k for s, k in sizes.items())
            assert n >= -(-total // capacity)
            # never worse than one item per container, or two half-empty ones
            assert n <= max(1, 2 * total / capacity + 1)
    assert _check_plan({300: 10, 212: 10, 100: 4, 112: 2, 400: 2}, 512) == 13  # the least possible number
    assert packing.plan_containers({}, 10) == []
    with pytest.raises(ValueError):
        packing.plan_containers({11: 1}, 10)


def test_exact_complements_of_three():
    assert packing.Complements(packing.np.array([0, 0, 1, 1, 0, 1, 0, 0, 0, 0, 0])).fill(10, 10) == (5, 3, 2)
    assert packing.Complements(packing.np.array([0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0])).fill(10, 10) is None  # one five is no pair


def test_packing_of_a_frame(spark, vocabulary):
    enc = tokenize.TreeEncoder(vocabulary)
    texts = [None, "", *["word " * n for n in (1, 5, 9, 9, 9, 40, 100, 7, 3)], "same text", "same text"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, tokens int")
    got = packing.pack_documents(df, "doc_id", "text", {1: 16, 2: 64}).collect()
    for budget, capacity in ((1, 16), (2, 64)):
        mine = [r for r in got if r.budget_id == budget]
        fill, pieces = Counter(), defaultdict(list)
        for r in mine:
            fill[r.container_id] += r.tokens
            pieces[r.doc_id].append((r.piece, r.tokens))
        assert max(fill.values()) <= capacity
        for i, t in enumerate(texts):
            n = enc.count(t)
            p = sorted(pieces[i])
            assert sum(k for _, k in p) == n and [x for x, _ in p] == list(range(max(1, -(-n // capacity))))
            assert len(p) == 1 or all(k == capacity for _, k in p[:-1])
    report = {r.budget_id: r for r in packing.packing_report(packing.pack_documents(df, "doc_id", "text", {1: 16, 2: 64}), {1: 16, 2: 64}).collect()}
    assert report[1].fill > 0.8 and report[2].capacity == 64
    assert packing.pack_documents(df.limit(0), "doc_id", "text", {1: 16}).count() == 0
    assert packing.pack_documents(df.where("text is null"), "doc_id", "text", {1: 16}).count() == 1


def test_whole_table_is_packed(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    got = queries.p8_pack(spark, DATA)
    assert [r["count"] for r in got.select("budget_id", "doc_id").distinct().groupBy("budget_id").count().collect()] == [docs] * 3
    assert all(r.fill > 0.98 for r in queries.p8_report(spark, DATA).where("containers > 50").collect())


# ---- 6


def _lines(spark, data, page=None):
    """data: (source, doc, lines); `page` gives a line's page from its place"""
    flat = [(s, d, n, i, t, page(n) if page else 0) for i, (s, d, n, t) in enumerate((s, d, n, t) for s, d, ts in data for n, t in enumerate(ts))]
    items = spark.createDataFrame(flat, "_s string, doc string, pos int, item_id long, text string, page int")
    of = spark.createDataFrame(sorted({(d, s) for s, d, _ in data}), "doc string, source string")
    return repeats.source_lines(items, F.col("doc"), of, F.col("text"), ["pos"], page=F.col("page")), {i: (s, d, t) for s, d, _, i, t, _ in flat}


def _bare(text):
    return "".join(c for c in text.lower() if c.isalnum())


def _longest(data, least, share):
    """Brute force: by place of each line the longest repeated block that begins there."""
    docs = defaultdict(set)
    texts = {(s, d): [_bare(t) for t in ts if _bare(t)] for s, d, ts in data}
    for (s, d), ts in texts.items():
        for i in range(len(ts)):
            for j in range(i + 1, len(ts) + 1):
                docs[s, tuple(ts[i:j])].add(d)
    every = Counter(s for (s, _), ts in texts.items() if ts)
    out = {}
    for (s, d), ts in texts.items():
        for i in range(len(ts)):
            n = max((j - i for j in range(i + 1, len(ts) + 1) if len(docs[s, tuple(ts[i:j])]) >= max(least, share * every[s])), default=0)
            if n:
                out[d, i] = (n, tuple(ts[i : i + n]))
    return out


def test_repeated_blocks_against_brute_force(spark):
    rng = random.Random(4)
    phrases = [["Share!", "Note."], ["a", "b", "c", "d", "e", "f", "g"], ["c", "d", "e"], ["x1"] * 5, ["Note.", "a", "b", "c"]]
    data = []
    for i in range(40):
        ts = []
        for _ in range(rng.randint(0, 5)):
            ts += rng.choice(phrases) if rng.random() < 0.7 else [f"own {rng.randint(0, 60)}", "..."]
        data.append((rng.choice("aab"), f"d{i}", ts))
    lines, _ = _lines(spark, data, lambda n: n * 30)
    for least, share in ((2, 0.0), (5, 0.05), (3, 0.3)):
        want = _longest(data, least, share)
        found = repeats.occurrences(lines, least, share)
        got = {(r.doc, r["at"]): r for r in found.collect()}
        assert {k: r.lines for k, r in got.items()} == {k: n for k, (n, _) in want.items()}
        # the same content has the same identifier, other content another one
        names = {(got[k].source, block): got[k].block for k, (_, block) in want.items()}
        assert all(got[k].block == names[got[k].source, block] for k, (_, block) in want.items()) and len(set(names.values())) == len(names)
        alone = [(k, v) for k, v in want.items() if want.get((k[0], k[1] - 1), (0,))[0] <= v[0]]
        per = Counter((got[k].source, block) for k, (_, block) in alone)
        assert sorted((r.lines, r.places) for r in repeats.blocks(found).collect()) == sorted((len(block), n) for (_, block), n in per.items())
        for least_lines in (1, 3):
            covered = {(d, i + j) for (d, i), (n, _) in want.items() if n >= least_lines for j in range(n)}
            assert repeats.repeated_items(found, least_lines).count() == len(covered)


def test_a_long_block_comes_out_whole(spark):
    block = [f"Line {i} of the notice" for i in range(20)]
    data = [("s", f"d{i}", [f"own {i}", *block, f"more {i}"] + (block[:7] if i == 0 else [])) for i in range(30)] + [("s", "e", ["Line 3 of the notice"] * 9), ("t", "f", ["z"])]
    lines, _ = _lines(spark, data)
    got = rows(repeats.blocks(repeats.occurrences(lines, 8, 0.1)).select("source", "lines", "places", "docs", "source_docs"))
    assert got == [("s", 1, 9, 1, 31), ("s", 20, 30, 30, 31), ("s", 7, 1, 1, 31)]
    assert repeats.repeated_items(repeats.occurrences(lines), 2).count() == 30 * 20 + 7
    assert repeats.occurrences(lines.limit(0)).count() == 0


def test_source_lines_and_stripping(spark):
    items = spark.createDataFrame([(1, "G1", 1, "keep", 0), (2, "g1 ", 2, "Drop", 0), (2, "g1 ", 2, "Drop", 0), (3, None, 1, "x", 0), (4, "g2", 1, None, 0), (5, "g3", 1, "y", 0)], "item_id long, g string, n int, text string, source int")
    of = spark.createDataFrame([("g1", "s"), ("g2", "s"), ("g3", None)], "doc string, source string")
    lines = repeats.source_lines(items, F.lower(F.trim("g")), of, F.col("text"), ["n"])
    assert sorted(r.item for r in lines.collect()) == [1, 2]
    found = spark.createDataFrame([(2,)], "item long")
    assert ("g1", "keep", 2) in rows(repeats.strip_items(items, found, F.lower(F.trim("g")), F.col("text"), ["n"]))


# ---- 4


def _brute_candidates(read, words, errors, most, usual):
    """Brute force: for each word a table of the least cost by characters of the form, characters of the word, and edits."""
    n, out = len(read), {}
    single = {(p, r) for p, r in usual if len(p) == len(r) == 1}
    odd = [(p, r) for p, r in usual if len(p) != len(r)]
    for w in words:
        best = {(0, 0, 0): 0.0}
        for i in range(n + 1):
            for j in range(len(w) + 1):
                for k in range(errors + 1):
                    if (cost := best.get((i, j, k))) is None:
                        continue
                    steps = []
                    if i < n and j < len(w):
                        if w[j] == read[i]:
                            steps.append((1, 1, 0, 0.0))
                        else:
                            like = (w[j], read[i]) in single or read[i].isdigit() and w[j].isalpha()
                            steps.append((1, 1, 1, ocr.USUAL if like else ocr.PLAIN if 1 <= i < n - 2 else ocr.EDGE))
                    steps += [(1, 0, 1, ocr.EDGE)] * (i < n) + [(0, 1, 1, ocr.EDGE)] * (j < len(w))
                    steps += [(len(r), len(p), 1, ocr.USUAL) for p, r in odd if read.startswith(r, i) and w.startswith(p, j)]
                    for di, dj, dk, c in steps:
                        key = (i + di, j + dj, k + dk)
                        if key[2] <= errors and cost + c < best.get(key, 1e9):
                            best[key] = cost + c
        least = min(best.get((n, len(w), k), 1e9) for k in range(errors + 1))
        if least <= most and w != read:
            out[w] = least
    return out


def test_candidates_are_complete_against_brute_force():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdelmnorsu") for _ in range(rng.randint(3, 9))) for _ in range(120)} | {"modern", "modem", "shall", "relief", "government"})
    automaton = ocr.Automaton(words, ocr.CONFUSIONS)
    for _ in range(60):
        read = rng.choice(words)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(read) + 1)
            read = read[:i] + rng.choice(["rn", "m", "c", "", "xe", "1", "ii"]) + read[i + rng.randint(0, 2) :]
        for errors in (1, 2, 3):
            for most in (ocr.MOST, 1e6):
                assert automaton.candidates(read, errors, most) == _brute_candidates(read, words, errors, most, ocr.CONFUSIONS), (read, errors)
    assert automaton.candidates("", 1) == {} and "modern" in automaton.candidates("modem")


WORDS = "whoever destroys public records shall be fined and the secretary attorney-general of united states according to plat recorded obligations preserve military duty-free term lands coast alike president section cases laws committee appropriation".split()


def _lexicon(spark, words, pairs=(), names=()):
    rows_ = [(w, None, n, 0 if w in names else n) for w, n in words.items()] + [(a, b, n, 0) for (a, b), n in dict(pairs).items()]
    return ocr.lexicon(spark.createDataFrame(rows_, "a string, b string, n long, small long"))


def _ordered(spark, *lines, notices=()):
    """lines: granule, page, text"""
    df = spark.createDataFrame([(i, g, p, i, t, None) for i, (g, p, t) in enumerate(lines)], "item_id long, granule_id string, page_no int, item_no int, text string, orig string")
    return ocr.in_order(ocr.content_lines(df, F.col("granule_id"), F.coalesce("text", "orig"), df.where(F.col("item_id").isin(list(notices))).select(F.col("item_id").alias("item"))))


@pytest.fixture(scope="module")
def lex(spark):
    words = dict.fromkeys(WORDS, 1000) | {"fhall": 9, "sec": 900, "see": 1000, "thamkole": 50, "filler": 4_000_000}
    pairs = {("records", "shall"): 50, ("shall", "be"): 50, ("to", "see"): 50, ("see", "the"): 50, ("the", "lands"): 60, ("lands", "of"): 70}
    return _lexicon(spark, words, pairs, {"thamkole"})


def test_corrections(spark, lex):
    assert "fhall" not in {r.word for r in lex.words.collect()} and "filler" in lex.common and "sec" not in lex.common
    cases = {
        "fhall": "shall", "dcstroys": "destroys", "rnilitary": "military", "mi1itary": "military", "piiblic": "public", "6nited": "united", "secretary": None, "quilnorra": None, "1790": None, "of": None, "destroy": None,
        "cornrnittee": "committee", "comrnittcc": "committee", "approprialian": "appropriation", "appropriotian": "appropriation",  # several edits
        "thamkale": None, "appropriations": None, "x" * 200: None,
        "to sec the": "see", "a sec b": None,  # a known word that its neighbours contradict
        "the lankz of": None, "the landz of": "lands",  # another edit, where both neighbours fit
    }
    ordered = _ordered(spark, *[(f"g{i}", 1, t) for i, t in enumerate(cases)])
    got = {r.item_id: r.fixed for r in ocr.repair(ordered, lex).fixes.collect()}
    assert {t: got.get(i) for i, t in enumerate(cases)} == cases


def test_neighbours_of_a_line_s_ends_are_in_the_lines_before_and_after(spark, lex):
    ordered = _ordered(spark, ("g", 1, "Whoever destroys the"), ("g", 1, "landz"), ("g", 1, "of the president"), ("h", 1, "landz"))
    assert rows(ocr.repair(ordered, lex).fixes.select("item_id", "fixed")) == [(1, "lands")]


def test_planted_double_errors_are_repaired(spark):
    """Words of the test data's own vocabulary with two usual confusions each."""
    rng = random.Random(8)
    ordered = ocr.in_order(queries._page_lines(spark, "/root/testdata/sf0.01"))
    lex = ocr.learn(ordered)
    right = sorted(r.word for r in lex.words.where("not name and n >= 20 and length(word) >= 7 and not contains(word, '-')").collect())
    planted = {}
    for w in right:
        for _ in range(6):
            read, at = w, 0
            for _ in range(2):
                places = [(i, p, r) for p, r in ocr.CONFUSIONS for i in range(at, len(read)) if read.startswith(p, i)]
                if not places:
                    break
                i, p, r = rng.choice(places)
                read, at = read[:i] + r + read[i + len(p) :], i + len(r)
            else:
                planted[read] = w
    read = sorted(planted)
    got = {r.item_id: r.fixed for r in ocr.repair(_ordered(spark, *[(f"g{i}", 1, t) for i, t in enumerate(read)]), lex).fixes.collect()}
    share = sum(got.get(i) == planted[t] for i, t in enumerate(read)) / len(read)
    assert len(read) > 140 and share >= 0.9, share


def test_confusions_are_learned_from_the_corpus(spark):
    letters = "bdfghlmprstvwz"
    words = {f"{a}k{b}orane": 2000 for a in letters for b in letters[:4]}
    counts = words | {w.replace("k", "x"): 20 for w in list(words)[:40]}  # a press whose k reads x
    learned = _lexicon(spark, counts)
    assert ("k", "x") in learned.usual and ("k", "q") not in learned.usual
    odd = list(words)[50].replace("k", "x")
    assert rows(ocr.repair(_ordered(spark, ("g", 1, odd)), learned).fixes.select("fixed")) == [(list(words)[50],)]


@pytest.mark.parametrize(
    "text, head",
    [("64 STAT. 69", True), ("50 STAT. B2", True), ("37 10 Stat.", True), ("PUBLIC LAW 86–537–AUG. 22, 1988", True), ("PUBLIG LAW 86 - 537 - AUG, 22, l988", True), ("11 PRIVATE LAWS-CH. 597-MAY. 23, 1899", True), ("56TH CONG. SESS. I. CHS. 500, 501. 1913.", True),
     ("NINTH CONGRESS. Ch. 66. 1996. [B4", True), ("SEC. 2. No contracts shall be 64", False), ("as amended by Public Law 86-537, Aug. 22, 1988", False), ("FILESTAMP JOB 8866 TRAY 00000 SHEET 00", False), ("", False), ("1934", False)],
)
def test_running_heads(text, head):
    assert ocr.is_running_head(text) is head


def test_page_numbers():
    for text in ("41", "[4l]", "- 41 -", "— 41 —", "Page 41", "41."):
        assert ocr.is_page_number(text, ocr.page_label("STATUTE-46-Pg40-2", 2)), text
    for text in ("42", "$41.", "(41)", "41 apples", "1941"):
        assert not ocr.is_page_number(text, "41")
    assert ocr.page_label("STATUTE-1-PgB1", 3) == "B3" and ocr.page_label(None, 1) is None and ocr.page_label("x", None) is None


def test_broken_words_go_on_behind_furniture_and_notices(spark, lex):
    cases = [
        (["Whoever destroys obli-", "7", "By the Thamsaquay staff", "@64 STAT. 8", "@gations shall be fined"], ("obligations", 4), []),
        (["the Attorney-", "General of"], ("attorney-general", 1), []),
        (["duty\xad", "free lands"], ("duty-free", 1), []),
        (["applies to coast-", "and river-borne lands"], None, []),
        (["are as follows—", "the lands"], None, []),
        (["of Thamko-", "wick shall be"], ("thamkowick", 1), []),
        (["the mili-", "fary lands"], ("military", 1), []),  # misread in its second part
        (["last mili-"], None, []),
        (["Whoever dcstroys mili-", "tary lauds alike"], ("military", 1), ["destroys", "lands"]),
        (["the secretary-", "(a) of records", "— and", "", "of"], None, []),
    ]
    flat = [(f"STATUTE-{k}-Pg7", 2 if t[:1] == "@" else 1, t.lstrip("@")) for k, (texts, *_) in enumerate(cases) for t in texts]
    starts = [sum(len(c[0]) for c in cases[:k]) for k in range(len(cases))]
    r = ocr.repair(_ordered(spark, *flat), lex)
    joins, fixes = {x.item_id: (x.joined, x.taker) for x in r.joins.collect()}, defaultdict(list)
    for x in r.fixes.orderBy("item_id", "at").collect():
        fixes[x.item_id].append(x.fixed)
    for at, (texts, want, misread) in zip(starts, cases, strict=True):
        assert joins.get(at) == (want and (want[0], at + want[1])), texts
        assert [w for i in range(len(texts)) for w in fixes[at + i]] == misread, texts
    assert {f for f in rows(ocr.findings(r)) if f[1] == "furniture"} == {(1, "furniture", ""), (3, "furniture", "")}


def test_repair_of_a_frame(spark):
    body = ["Whoever destroys public records shall be fined.", "The secretary shall preserve public records alike."] * 30
    items = [(i, f"STATUTE-9-Pg{7 + i}", 1, 0, t, None, 0) for i, t in enumerate(body)]
    items += [(100, "STATUTE-9-Pg500", 1, 1, "Whoever  dcstroys public rec-", None, 0), (101, "STATUTE-9-Pg500", 1, 2, "500", "500", 0), (101, "STATUTE-9-Pg500", 1, 2, "500", "500", 0), (102, "STATUTE-9-Pg500", 2, 3, None, "ords shall be fined.", 0), (103, None, 1, 1, "Whoever shall be", None, 0), (104, "STATUTE-9-Pg500", None, 1, "", "x", 0)]
    df = spark.createDataFrame(items, "item_id long, granule_id string, page_no int, item_no int, text string, orig string, _own int")
    lines = ocr.content_lines(df, F.trim("granule_id"), F.coalesce("text", "orig"))
    ordered = ocr.in_order(lines)
    lex = ocr.learn(ordered)
    assert {"whoever", "records"} <= {r.word for r in lex.words.collect()}
    repaired = ocr.repair(ordered, lex)
    assert rows(ocr.findings(repaired)) == [(100, "hyphen", "records"), (100, "misread", "destroys"), (101, "furniture", "")]
    texts = {(r.granule, r.para_no): r.text for r in ocr.paragraphs_of(repaired).collect()}
    assert texts["STATUTE-9-Pg500", 1] == "Whoever destroys public records shall be fined."
    aside = ocr.in_order(ocr.content_lines(df, F.trim("granule_id"), F.coalesce("text", "orig"), df.where("item_no = 1 and page_no = 1 and granule_id is null").select(F.col("item_id").alias("item"))))
    alone = {(r.granule, r.para_no): (r.text, r.notices) for r in ocr.paragraphs_of(ocr.repair(aside, lex)).collect()}
    assert alone["?103", 0] == ("", ["Whoever shall be"]) and alone["STATUTE-9-Pg500", 1][0] == texts["STATUTE-9-Pg500", 1]
    empty = ocr.in_order(ocr.content_lines(df.limit(0), F.trim("granule_id"), F.col("text")))
    nothing = ocr.repair(empty, ocr.learn(empty))
    assert ocr.findings(nothing).count() == 0 and ocr.paragraphs_of(nothing).count() == 0


def test_paragraphs_go_on_behind_notices(spark, lex):
    texts = ["The secretary shall preserve obli-", "By the staff of Torkole", "64 STAT. 8", "gations of the secretary.", "SEC. 2. The secretary shall", "preserve obligations."]
    got = ocr.paragraphs_of(ocr.repair(_ordered(spark, *[("STATUTE-9-Pg7", 1, t) for t in texts]), lex))
    assert [(r.para_no, r.text, r.notices) for r in got.orderBy("para_no").collect()] == [(1, "The secretary shall preserve obligations of the secretary.", ["By the staff of Torkole"]), (2, "SEC. 2. The secretary shall preserve obligations.", [])]


def test_groups_of_pages_see_across_their_borders(spark, lex):
    n = ocr.GROUP_PAGES * 3
    ordered = _ordered(spark, *[("STATUTE-9-Pg1", p, "the secretary shall preserve obli-" if p % 2 else "gations of the secretary") for p in range(1, n)])
    r = ocr.repair(ordered, lex)
    assert rows(ocr.findings(r)) == sorted([(p - 1, "hyphen", "obligations") for p in range(1, n - 1) if p % 2], key=str)
    # one paragraph, though three groups of pages read it
    got = ocr.paragraphs_of(r).collect()
    assert [x.para_no for x in got] == [1] and got[0].text.count("obligations of the secretary") == n // 2 - 1
    # a line behind pages of furniture only still knows the line before them
    sparse = _ordered(spark, ("STATUTE-9-Pg1", 1, "the secretary shall preserve"), ("STATUTE-9-Pg1", ocr.GROUP_PAGES + 9, "the lands of the president."), ("STATUTE-9-Pg1", ocr.GROUP_PAGES + 9, "Sec. 2. The lands"))
    assert [x.para_no for x in ocr.paragraphs_of(ocr.repair(sparse, lex)).orderBy("para_no").collect()] == [1, 2]


# ---- 9


def test_labels(spark):
    pairs = [("en", "en"), (" EN ", "en"), ("en-US", "en"), ("pt_BR", "pt"), ("fre", "fr"), ("Dutch", "nl"), ("español", "es"), ("xx", None), ("und", None), ("", None), (None, None), ("-", None)]
    got = spark.createDataFrame(pairs, "label string, want string").select(langid.label_code(F.col("label")).alias("x"), "want").collect()
    assert all(r.x == r.want for r in got)


def test_paragraphs_are_runs_of_lines():
    assert langid.paragraphs("a\nb\n \t\r\nc\r\n\r\n\xa0\n\nd") == ["a\nb", "c\r", "d"] and langid.paragraphs("\n \n") == [] and langid.paragraphs("a\rb") == ["a\rb"]


@pytest.fixture(scope="module")
def trained(spark):
    return langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text", "lang", 60)


def test_held_out_accuracy(spark, trained):
    """Trained on sf0.01; paragraphs of another table, whose labels are mostly right."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("want", langid.label_code(F.col("lang"))).where("want is not null and length(text) > 200").select("doc_id", "text", "want").collect()
    got = langid.languages(trained, [r.text for r in docs])
    main = got[4][: len(docs)]
    right = sum(langid.LANGS[m] == r.want for m, r in zip(main, docs, strict=True) if m >= 0)
    assert right / len(docs) > 0.88  # some labels are wrong on purpose
    sure = got[3][: len(docs)]
    assert sure.min() >= 0 and sure.max() <= 1.0 + 1e-6


SENTENCES = {
    "en": "The Secretary shall publish the records and the court may suspend the regulations.", "fr": "Le Gouvernement adopte le présent accord au moyen d'un échange de notes.", "es": "El Gobierno comunicará por escrito los derechos de aduana a partir de la fecha de su firma.",
    "de": "Der Reeder übernimmt die Schiffspapiere im Falle einer Streitigkeit.", "it": "La Commissione adotta le misure necessarie per un periodo di quattro anni.", "pt": "A secretaria aprova as medidas necessárias de acordo com as leis do país.", "nl": "De Regering neemt de noodzakelijke maatregelen voor de duur van vier jaren.",
}


@pytest.mark.parametrize("fold", [str, str.upper, lambda s: s.translate(str.maketrans("éáàíóüãçú", "eaaiouacu"))])
def test_sentences_in_any_spelling(trained, fold):
    langs, confidence, _ = langid.classify(trained, [fold(s) for s in SENTENCES.values()])
    assert [langid.LANGS[k] for k in langs] == list(SENTENCES) and confidence.min() > 0.8


def test_no_sentence_no_language(trained):
    langs, *_ = langid.classify(trained, ["", "12 §§ 1/2", "5,735 9,639 6,257", "Torbelby", "漢字漢字漢字 Закон", "a3f9" * 200, "ad valorem"])
    assert (langs == -1).all() and len(langid.classify(trained, [])[0]) == 0


def test_a_very_long_paragraph(trained):
    text = (SENTENCES["it"] + " ") * 20_000
    assert len(text) > langid.STEP_CHARS
    langs, confidence, letters = langid.classify(trained, [SENTENCES["fr"], text, SENTENCES["de"]])
    assert [langid.LANGS[k] for k in langs] == ["fr", "it", "de"] and letters[1] == sum(map(str.isalpha, text))


def test_issues_of_a_frame(spark, trained):
    en, fr = SENTENCES["en"], SENTENCES["fr"]
    docs = [(1, en, "en"), (2, en, "fr"), (3, f"{en}\n\n{en}\n\n{fr}", "English"), (4, None, None), (5, " \n", "en"), (6, fr, None), (7, "12 34", None), (8, f"{fr}\r\n\r\n" * 300 + en, "fr-FR")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, para_no string")
    found = langid.detect_languages(df, "doc_id", "text", trained, "lang")
    assert rows(langid.language_issues(found, "doc_id").select("doc_id", "para_no", "lang")) == [(2, 0, "en"), (3, 3, "fr"), (6, 0, "fr"), (8, 301, "en")]
    assert found.where("para_no = 0").count() == len(docs) and found.where("doc_id = 4").count() == 1
    assert langid.detect_languages(df.limit(0), "doc_id", "text", trained, "lang").count() == 0


# ---- queries


def test_found_lines_equal_their_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("granules", "page_items"):
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    for name in ("p6_found", "p6_blocks", "p6_clean"):
        df, rel = queries.QUERIES[name](spark, DATA), con.sql(queries.SQL[name])
        assert rows(df.select(*sorted(df.columns))) == sorted((tuple(r[rel.columns.index(c)] for c in sorted(rel.columns)) for r in rel.fetchall()), key=str)


@pytest.mark.parametrize("name", ["p4_found", "p4_paragraphs", "p6_blocks", "p6_clean", "p9_found", "p9_langs"])
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
