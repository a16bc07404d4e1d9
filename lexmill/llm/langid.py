"""Languages of documents and of their paragraphs.

A multinomial naive Bayes over hashed character n-grams. Its log-probability matrix (2**16 rows, one column per language) is broadcast; a batch
of texts becomes one array of letters, one array of n-gram numbers and one sum per paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Codes, ISO 639 codes and names of the languages, in English and in the language itself (fixed values).
LABELS = {
    "en": ["en", "eng", "english"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
    "es": ["es", "spa", "spanish", "castilian", "español", "espanol", "castellano"],
    "de": ["de", "deu", "ger", "german", "deutsch"],
    "it": ["it", "ita", "italian", "italiano"],
    "pt": ["pt", "por", "portuguese", "português", "portugues"],
    "nl": ["nl", "nld", "dut", "dutch", "flemish", "nederlands"],
}
LANGS = list(LABELS)
#: Documents per language in the training sample (expected number; twice as many at most), and the longest of them.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
HASH_BITS = 16
ORDERS = (3, 5)
#: Characters that are scored together, and n-grams whose rows of the matrix are held at once, to bound memory.
STEP_CHARS, BLOCK = 1 << 20, 1 << 21
SMOOTHING = 0.05
#: A sentence has at least so many letters and words, and so likely n-grams under its language (nats per n-gram, relative to the training text's mean).
MIN_LETTERS, MIN_WORDS, MAX_LOSS = 16, 4, 2.0


def _fold_table() -> np.ndarray:
    """Letters a to z as 1 to 26, also with accents or as capitals, 27 other letters of the table, 28 to drop, 0 what separates words."""
    import unicodedata

    out = np.zeros(0x3000, np.uint8)
    for cp in range(0x250):
        base = unicodedata.normalize("NFKD", chr(cp).lower())[:1]
        if "a" <= base <= "z":
            out[cp] = ord(base) - 96
        elif chr(cp).isalpha():
            out[cp] = 27
    out[0xDF] = 19  # sharp s
    out[0x250:0x300], out[0x370:0x2000] = 27, 27
    for cp in (0xAD, *range(0x300, 0x370), *range(0x200B, 0x200E)):
        out[cp] = 28
    return out


FOLD = _fold_table()


def letters_of(text: str) -> np.ndarray:
    """Letter numbers of a text, one per code point, runs of separators not yet merged."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return FOLD[np.minimum(cp, len(FOLD) - 1)]


def ngrams(text: str, starts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """N-gram numbers for each order of all pieces of `text` that begin at `starts`, where each piece's n-grams begin, letters and words per piece.

    Pieces must be separated by something that is no letter.
    """
    code = letters_of(text)
    keep = code != 28
    keep[1:] &= (code[1:] != 0) | (code[:-1] != 0)
    at = np.concatenate([[0], np.cumsum(keep)])[starts]
    code = code[keep].astype(np.uint32)
    edges = np.append(at, len(code))
    solid = np.concatenate([[0], np.cumsum(code != 0)])
    heads = np.concatenate([[0], np.cumsum((code != 0) & (np.concatenate([[0], code[:-1]]) == 0))])
    letters, words = np.diff(solid[edges]), np.diff(heads[edges])
    grams, begins = [], []
    for n in ORDERS:
        size = max(len(code) - n + 1, 0)
        h = np.zeros(size, np.uint32)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h ^= code[k : k + size] + np.uint32(k * 29 + 1)
        h *= np.uint32(0x9E3779B1)
        grams.append(h >> np.uint32(32 - HASH_BITS))
        begins.append(np.minimum(at, size))
    return grams, begins, letters, words


@dataclass
class Model:
    """Log-probabilities by order: float32 arrays of 2**HASH_BITS rows and one column per language (padded to 8), and the mean per n-gram of each language's own text."""

    logp: list[np.ndarray]
    own: np.ndarray

    def score(self, text: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums of log-probabilities (pieces by languages), numbers of n-grams, letters and words."""
        grams, begins, letters, words = ngrams(text, starts)
        total, number = np.zeros((len(starts), 8)), np.zeros(len(starts), np.int64)
        for table, h, at in zip(self.logp, grams, begins, strict=True):
            ends = np.append(at[1:], len(h))
            number += ends - at
            some = np.flatnonzero(ends > at)
            for lo in range(0, len(h), BLOCK):
                hi = min(lo + BLOCK, len(h))
                here = some[(at[some] < hi) & (ends[some] > lo)]
                total[here] += np.add.reduceat(table[h[lo:hi]], np.maximum(at[here], lo) - lo, axis=0)
        return total[:, : len(LANGS)], number, letters, words


def fit(pieces: list[tuple[str, int]]) -> Model:
    """A model of texts and the numbers of their languages."""
    counts = [np.full((1 << HASH_BITS, 8), SMOOTHING, np.float64) for _ in ORDERS]
    for k in range(len(LANGS)):
        own = [t for t, lang in pieces if lang == k]
        text, starts = joined(own)
        grams, *_ = ngrams(text, starts)
        for c, h in zip(counts, grams, strict=True):
            c[:, k] += np.bincount(h, minlength=1 << HASH_BITS)
    model = Model([np.log(c / c.sum(0)).astype(np.float32) for c in counts], np.zeros(len(LANGS)))
    for k in range(len(LANGS)):
        text, starts = joined([t for t, lang in pieces if lang == k])
        total, number, *_ = model.score(text, starts)
        model.own[k] = total[:, k].sum() / max(number.sum(), 1)
    return model


def joined(texts: list[str]) -> tuple[str, np.ndarray]:
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return "\n".join(texts) + "\n", starts[:-1]


def portions_of(texts: list[str]) -> Iterator[list[str]]:
    """The texts in lists of about STEP_CHARS characters; a longer text is a list of its own."""
    part: list[str] = []
    chars = 0
    for t in texts:
        if part and chars + len(t) > STEP_CHARS:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    yield part


def _scored(model: Model, texts: list[str]) -> tuple[np.ndarray, ...]:
    """Scores of texts; a text longer than STEP_CHARS is scored by stretches, which are added up."""
    if len(texts) > 1 or len(texts[0]) <= STEP_CHARS:
        return model.score(*joined(texts))
    parts = [model.score(*joined([texts[0][i : i + STEP_CHARS]])) for i in range(0, len(texts[0]), STEP_CHARS)]
    return tuple(sum(x[1:], x[0]) for x in zip(*parts, strict=True))


def paragraphs(text: str) -> list[str]:
    """Runs of lines (ended by a line feed) that are not blank."""
    out, run = [], []
    for line in text.split("\n"):
        if line and not line.isspace():
            run.append(line)
        elif run:
            out.append("\n".join(run))
            run = []
    if run:
        out.append("\n".join(run))
    return out


def classify(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language (-1: no sentence in one of the languages), confidence and letters of each text.

    The confidence is the posterior probability, with the log-likelihood divided by the highest order of the overlapping n-grams.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    total, number, letters, words = (np.concatenate(x) for x in zip(*(_scored(model, t) for t in portions_of(texts)), strict=True))
    best = total.argmax(1)
    top = total.max(1, keepdims=True)
    confidence = 1 / np.exp((total - top) / max(ORDERS)).sum(1)
    loss = model.own[best] - top[:, 0] / np.maximum(number, 1)
    best[(letters < MIN_LETTERS) | (words < MIN_WORDS) | (loss > MAX_LOSS)] = -1
    return best, confidence, letters


def label_code(c: Column) -> Column:
    """The language a label names, by code, region variant or name; NULL if it names none of them."""
    word = F.regexp_extract(F.trim(F.lower(c), F.lit(" \t\r\n\xa0")), r"^([^-_]+)", 1)
    codes = F.create_map(*[F.lit(x) for code, names in LABELS.items() for n in names for x in (n, code)])
    return F.when(word != "", F.try_element_at(codes, word))


def train(docs: DataFrame, key: str, text: str, label: str, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on a bounded sample of labelled rows: about `sample_docs` texts per language, none above SAMPLE_CHARS, chosen by a hash of the key.

    Labels may be wrong: a first model sorts the sample's paragraphs, a second one is fitted on what it is sure of.
    """
    known = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), label_code(F.col(label)).alias("_lang"))
    sizes = {r._lang: r["count"] for r in known.groupBy("_lang").count().collect() if r._lang}
    share = F.create_map(*[F.lit(x) for k in LANGS for x in (k, float(sample_docs) / max(sizes.get(k, 0), 1))])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("langid"), F.col("_key")), 11) / float(1 << 53)
    chosen = known.where(F.col("_lang").isNotNull() & (draw < share[F.col("_lang")]) & (F.length("_text") <= SAMPLE_CHARS))
    rows = chosen.select("_lang", "_text").limit(2 * sample_docs * len(LANGS)).collect()
    pieces = [(p, LANGS.index(r._lang)) for r in rows for p in paragraphs(r._text)]
    first = fit(pieces)
    langs, confidence, _ = classify(first, [p for p, _ in pieces])
    sure = [(p, int(k)) for (p, _), k, c in zip(pieces, langs, confidence, strict=True) if k >= 0 and c > 0.99]
    return fit(sure) if sure else first




def detect_languages(docs: DataFrame, key: str, text: str, model: Model, label: str | None = None) -> DataFrame:
    """`<key>, para_no, lang, confidence, main, label_lang`: para_no 0 the document, with its main language, k > 0 each paragraph with its own.

    The main language has the most letters in paragraphs with a sentence; ties go to the first of LANGS. Texts and paragraphs without a sentence in
    one of the languages have NULL lang and confidence; of NULL, empty and blank texts there is only row 0. A document's confidence is the
    letter-weighted mean of the confidences of its paragraphs in the main language, times their share of all its letters in sentences.
    label_lang is what the label column means, NULL if it names none of the languages. Repeated keys are different documents.
    """
    code = label_code(F.col(label)) if label else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("_key"), code.alias("_code"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = pa.array(LANGS)

    def named(lang: np.ndarray) -> pa.Array:
        return names.take(pa.array(lang, mask=lang < 0))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in portions(b):
                row, number, lang, confidence, main = languages(shared.value, part.column(2).to_pylist())
                head = part.select(["_key", "_code"]).take(pa.array(row))
                columns = [head.column(0), pa.array(number.astype(np.int32)), named(lang), pa.array(confidence, pa.float64(), mask=lang < 0), named(main), head.column(1)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "para_no", "lang", "confidence", "main", "label_lang"])

    return rows.mapInArrow(detect, f"`{key}` {kind}, para_no int, lang string, confidence double, main string, label_lang string")


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about STEP_CHARS characters."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)) // STEP_CHARS
    edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a)


def languages(model: Model, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Rows of a list of texts: which text, paragraph number (0: the text), language, confidence, the text's main language (-1: none)."""
    paras = [paragraphs(t) if t else [] for t in texts]
    lang, conf, letters = classify(model, [p for ps in paras for p in ps])
    n, size = np.array([len(ps) for ps in paras], np.int64), len(texts)
    doc = np.repeat(np.arange(size), n)
    some = lang >= 0
    weight, weighted = np.zeros((size, len(LANGS))), np.zeros((size, len(LANGS)))
    np.add.at(weight, (doc[some], lang[some]), letters[some])
    np.add.at(weighted, (doc[some], lang[some]), (letters * conf)[some])
    every, at = weight.sum(1), np.arange(size)
    main = np.where(every > 0, weight.argmax(1), -1)
    sure = weighted[at, main] / np.maximum(every, 1)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + 1
    return np.concatenate([at, doc]), np.concatenate([np.zeros(size, np.int64), number]), np.concatenate([main, lang]), np.concatenate([sure, conf]), np.concatenate([main, main[doc]])


def language_issues(found: DataFrame, key: str) -> DataFrame:
    """Of detect_languages with labels: documents whose label isn't their main language (para_no 0), and paragraphs in another than the main language."""
    wrong = (F.col("para_no") == 0) & F.col("lang").isNotNull() & ~F.col("label_lang").eqNullSafe(F.col("lang"))
    return found.where(wrong | ((F.col("para_no") > 0) & (F.col("lang") != F.col("main")))).select(key, "para_no", "lang", "confidence")
