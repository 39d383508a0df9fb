"""Language identification of mixed-language text: script ranges, word scores, and Viterbi spans.

The fit counts character grams of one to three letters (with word borders) of labelled texts by language, and the
scripts a language is written in. A word's script leaves its candidate languages; its score for a candidate is the mean over
the orders of the log-probability of its grams. A Viterbi pass over the words of a whole text, with a penalty for every
switch of language, labels spans; the language of most letters is the document's. All texts of a batch take a step together,
so a step is one NumPy operation over the batch.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masklens.llm.common import stored, worker_state

#: languages that are learned at most (those of most rows), and labelled rows of each that the model is fitted on at most
LANGUAGES, EXAMPLES = 256, 2_000
ORDERS, BUCKETS, SMOOTHING = 3, 1 << 15, 0.5
#: what a switch of language costs, in units of log-probability; share of a language's letters that makes a script one of its own
SWITCH, OWN_SCRIPT = 8.0, 0.01
#: a word in a script of other languages only, for a language
FOREIGN = -50.0
#: distinct words that a worker remembers, and (words x languages) of one Viterbi pass
MEMO_WORDS, CELLS = 300_000, 1 << 23
WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: fixed values: first code point of a range of the Unicode standard, and the script in use from there on
SCRIPTS = ((0x0, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"),
           (0x700, "Syriac"), (0x750, "Arabic"), (0x780, "Thaana"), (0x7C0, "Nko"), (0x8A0, "Arabic"), (0x900, "Devanagari"),
           (0x980, "Bengali"), (0xA00, "Gurmukhi"), (0xA80, "Gujarati"), (0xB00, "Oriya"), (0xB80, "Tamil"), (0xC00, "Telugu"),
           (0xC80, "Kannada"), (0xD00, "Malayalam"), (0xD80, "Sinhala"), (0xE00, "Thai"), (0xE80, "Lao"), (0xF00, "Tibetan"),
           (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"),
           (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1D00, "Latin"),
           (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C80, "Coptic"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"), (0x3040, "Kana"),
           (0x3130, "Hangul"), (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "Yi"), (0xA640, "Cyrillic"), (0xA720, "Latin"),
           (0xA960, "Hangul"), (0xAB30, "Latin"), (0xAC00, "Hangul"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
           (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"),
           (0x20000, "Han"), (0x40000, "Other"))
RANGES = np.array([first for first, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def letters_only(word: str) -> str:
    """A run of word characters without what is no letter (as fractions and Roman numerals are none)."""
    return word if word.isalpha() else "".join([c for c in word if c.isalpha()])


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class Grams(NamedTuple):
    """Of some words: per order the gram buckets and where each word's begin; per word its letters and its script."""

    buckets: list
    starts: list
    letters: np.ndarray
    scripts: np.ndarray


def grams(words: list[str]) -> Grams:
    """Words are of letters only and not empty."""
    codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    last = np.repeat(begins + sizes, sizes)  # where the word of a place ends
    buckets, starts = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, ORDERS + 1):
        places = np.arange(len(codes) - n + 1)
        h = h[:len(places)] * np.uint64(0x100000001B3) + codes[n - 1:]
        inside = places + n <= last[:len(places)]
        buckets.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.int64)[inside])
        starts.append(np.r_[0, np.cumsum(sizes - n + 1)[:-1]])
    first = codes[begins + 1].astype(np.int64)
    return Grams(buckets, starts, sizes - 2, SCRIPT_OF_RANGE[np.searchsorted(RANGES, first, side="right") - 1])


class Model:
    """Gram log-probabilities and candidate scripts of each language (in code-point order of their names)."""

    def __init__(self, languages: list[str], gram_counts: np.ndarray, script_counts: np.ndarray):
        """Counts of (language, order, bucket), and letters of (language, script)."""
        self.languages = languages
        total = gram_counts.sum(axis=2, keepdims=True)
        table = np.log((gram_counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)) / ORDERS
        self.table = np.ascontiguousarray(table.transpose(1, 2, 0), dtype=np.float32)
        share = script_counts / np.maximum(1, script_counts.sum(axis=1, keepdims=True))
        self.candidates = np.ascontiguousarray((share >= OWN_SCRIPT).T)
        #: what a text in scripts of no learned language is called: the language of most learned letters
        self.usual = int(script_counts.sum(axis=1).argmax()) if languages else -1

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, languages) scores, 0 for a word's best candidate; the letters of each word; whether it has a candidate (a word
        whose script no language uses scores 0 for all)."""
        told = grams(words)
        scores = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        for n in range(ORDERS):
            scores += np.add.reduceat(self.table[n][told.buckets[n]], told.starts[n], axis=0)
        able = self.candidates[told.scripts]
        known = able.any(axis=1)
        best = np.where(able, scores, -np.inf).max(axis=1, initial=-np.inf)
        scores = np.where(able, scores - np.where(known, best, 0)[:, None], FOREIGN)
        scores[~known] = 0
        return scores, told.letters, known


class WordScores(dict):
    """Rows of the distinct words seen so far; a new word gets the next row and is scored with its batch."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.scores = np.zeros((0, len(model.languages)), dtype=np.float32)
        self.letters, self.known = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(letters_only(word))
        return row

    def rows(self, lists: list[list[str]]) -> list[np.ndarray]:
        if len(self) > MEMO_WORDS:
            self.clear()
            self.scores, self.letters, self.known = self.scores[:0], self.letters[:0], self.known[:0]
        found = [np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words)) for words in lists]
        if self.new:
            n = len(self.new)
            new = np.zeros((n, self.scores.shape[1]), dtype=np.float32), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
            filled = [i for i, w in enumerate(self.new) if w]
            if filled:
                for own, got in zip(new, self.model.score([self.new[i] for i in filled]), strict=True):
                    own[filled] = got
            self.scores, self.letters, self.known = (np.concatenate([a, b]) for a, b in zip((self.scores, self.letters, self.known), new, strict=True))
            self.new = []
        return found


def viterbi(scores: np.ndarray, lengths: list[int], switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of texts laid end to end (``lengths`` words each, none empty): the path of the largest
    sum of scores less ``switch`` for each change. Ties keep the language, then take the first."""
    size = np.array(lengths, dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    at, size = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)[order], size[order]
    stay = np.empty(scores.shape, dtype=bool)
    top = np.empty(len(scores), dtype=np.int32)  # the best language up to the word before
    path = np.empty(len(scores), dtype=np.int32)
    value = scores[at].astype(np.float64)
    live = len(at)
    for t in range(1, int(size[0])):
        while size[live - 1] <= t:
            live -= 1
        rows, now = at[:live] + t, value[:live]
        top[rows] = best = now.argmax(axis=1)
        change = now[np.arange(live), best][:, None] - switch
        stay[rows] = kept = now >= change
        now[:] = np.where(kept, now, change) + scores[rows]
        now -= now.max(axis=1, keepdims=True)
    state = value.argmax(axis=1).astype(np.int32)
    live = 0
    for t in range(int(size[0]) - 1, -1, -1):
        while live < len(at) and size[live] > t:
            live += 1
        rows, own = at[:live] + t, state[:live]
        path[rows] = own
        if t:
            state[:live] = np.where(stay[rows, own], own, top[rows])
    return path


def judge(model: Model, rows: np.ndarray, table: WordScores, path: np.ndarray) -> tuple[str, float]:
    """The language of most letters in its spans (ties: the first by name), and the score: its share of the letters times its
    probability by the words of its spans."""
    letters = table.letters[rows]
    if not letters.sum():
        return UNKNOWN, 0.0
    share = np.bincount(path, weights=letters, minlength=len(model.languages)) / letters.sum()
    best = int(share.argmax())
    total = table.scores[rows[path == best]].sum(axis=0, dtype=np.float64)
    if not table.known[rows].any():  # no word in a script of a learned language
        return model.languages[model.usual], 0.0
    return model.languages[best], float(share[best] / np.exp(total - total[best]).clip(max=1e300).sum().clip(min=1.0))


def spans_of(path: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of words of one language."""
    begins = np.flatnonzero(np.r_[True, path[1:] != path[:-1]]) if len(path) else np.zeros(0, dtype=np.int64)
    ends = np.r_[begins[1:], len(path)]
    return [{"first": int(b), "words": int(e - b), "lang": languages[path[b]]} for b, e in zip(begins, ends, strict=True)]


def held_out(doc_id):
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0 (null: not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def sample_texts(docs: DataFrame, path: str, languages: int = LANGUAGES, examples: int = EXAMPLES, seed: int = 13) -> DataFrame:
    """(lang, text) of at most ``examples`` rows of each of the ``languages`` most frequent labels of docs (doc_id, lang, text)
    that are not held out and have an id, by a seeded hash of the id and text."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rates = stored(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
                   .select("lang", (F.lit(2.0 * examples) / F.col("count")).alias("rate")), f"{path}/rates")
    drawn = F.xxhash64(F.lit(seed), "doc_id", "text")
    some = (known.where("text <> ''").join(F.broadcast(rates), "lang").withColumn("drawn", drawn)
            .where(F.pmod("drawn", F.lit(1 << 30)) < F.col("rate") * (1 << 30)).select("lang", "text", "drawn"))
    some = stored(some, f"{path}/some")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "text"))
    return some.withColumn("turn", turn).where(F.col("turn") <= examples).select("lang", "text")


def fit(texts: DataFrame) -> Model:
    """A model of texts (lang, text). Gram counts are added up in tasks and then by Spark; the driver gets one table of
    (languages x (ORDERS x BUCKETS + scripts)) numbers."""
    width = ORDERS * BUCKETS + len(SCRIPT_NAMES)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
            for lang, own in seen.items():
                clean = [(w, n) for spelt, n in own.items() if (w := letters_only(spelt))]
                if not clean:
                    continue
                got = counts.setdefault(lang, np.zeros(width, dtype=np.int64))
                told, n = grams([w for w, _ in clean]), np.array([n for _, n in clean])
                for k in range(ORDERS):
                    each = np.repeat(n, np.diff(np.r_[told.starts[k], len(told.buckets[k])]))
                    got[k * BUCKETS:(k + 1) * BUCKETS] += np.bincount(told.buckets[k], weights=each, minlength=BUCKETS).astype(np.int64)
                got[ORDERS * BUCKETS:] += np.bincount(told.scripts, weights=told.letters * n, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        for lang, got in counts.items():
            slots = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots)), pa.array(slots, pa.int32()), pa.array(got[slots], pa.int64())],
                                             names=["lang", "slot", "n"])

    found: pd.DataFrame = texts.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    whole = np.zeros((len(languages), width))
    at = {lang: i for i, lang in enumerate(languages)}
    whole[[at[lang] for lang in found["lang"]], found["slot"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return Model(languages, whole[:, :ORDERS * BUCKETS].reshape(len(languages), ORDERS, BUCKETS), whole[:, ORDERS * BUCKETS:])


def identify(texts: DataFrame, model: Model) -> DataFrame:
    """``row`` (from texts), ``lang``, ``score`` and ``spans`` (array of first word, words, lang) of every whole text (row, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    languages = model.languages
    key = f"language-{zlib.crc32(model.table.tobytes())}-{hashlib.sha256(repr(languages).encode()).hexdigest()}"
    kind = texts.schema["row"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        told = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
        table = worker_state(key, lambda: WordScores(shared.value))
        for batch in batches:
            lists = [words_of(value.as_py()) for value in batch.column(1)]
            rows = table.rows(lists)
            names, scores, spans = [UNKNOWN] * len(lists), [0.0] * len(lists), [[] for _ in lists]
            todo = [i for i, own in enumerate(rows) if len(own)] if languages else []
            todo.sort(key=lambda i: -len(rows[i]))
            while todo:
                some, size = [], 0
                while todo and (not some or (size + len(rows[todo[0]])) * len(languages) <= CELLS):
                    some.append(todo.pop(0))
                    size += len(rows[some[-1]])
                paths = viterbi(table.scores[np.concatenate([rows[i] for i in some])], [len(rows[i]) for i in some])
                for i, path in zip(some, np.split(paths, np.cumsum([len(rows[i]) for i in some])[:-1]), strict=True):
                    names[i], scores[i] = judge(table.model, rows[i], table, path)
                    spans[i] = spans_of(path, languages) if names[i] != UNKNOWN else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(spans, told)],
                                             names=["row", "lang", "score", "spans"])

    return texts.select("row", "text").mapInArrow(
        run, f"row {kind}, lang string, score double, spans array<struct<first: long, words: long, lang: string>>")


def identify_documents(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` (0 to 1) and ``spans``.

    The model is fitted on the texts and labels of at most ``EXAMPLES`` rows a language that have an id and are not held
    out, of at most ``LANGUAGES`` languages. A prediction reads the whole text and nothing else. ``lang_pred`` is the
    language of most letters in the text's spans (ties: the first by name); ``und``, with score 0 and no spans, for a null text,
    one without letters, and every text where nothing was learned. A text whose letters are all in scripts of no
    learned language gets the language of most learned letters and score 0. ``spans`` count words, which are runs of
    letters, from 0. Null ids are predicted and not held out; repeated rows get equal results; an empty table gives
    an empty result; other columns are not read.

    Scale: one pass over ids and labels for the rates, one over the texts for the sample, one for the predictions; nothing is
    shuffled but the sample's counts. The broadcast model has LANGUAGES x (ORDERS x BUCKETS) numbers at most.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(sample_texts(own, path))
    found = identify(own.select(F.col("doc_id").alias("row"), "text"), model)
    return found.select(F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), F.col("lang").alias("lang_pred"),
                        "score", "spans")
