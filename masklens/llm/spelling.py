"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by a squared distance of 1 or 2. Words of one
length whose letters fall alike into a few classes form blocks; in a block pair the squared distances of all words come
from one NumPy product of the two letter-count matrices, and only pairs at 1 or 2 are verified letter by letter. An
edit moves a word at most one step between classes, so a block meets only those blocks of its own and the next length
whose class counts are one step away.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored

RUNS = r"[A-Za-zÀ-ÿ]"
SHORTEST, LEAST_COUNT, RATIO = 7, 2, 10
#: one in so many occurrences (by crc32) loses a letter: the noise whose variants are to be found
NOISE = 31
#: letters by class, each with about a sixth of English prose; letters above 127 join the last one
CLASSES = ("ecvx", "toqz", "aijk", "dns", "hlr", "bfgmpuwy")
#: words of a block, and code points of its words, at most; pairs that are verified at once
BLOCK_WORDS, BLOCK_LETTERS, SLICE = 1024, 1 << 18, 1 << 15
#: visitors that a block meets in one product (one block more at most)
TOGETHER = 4096
LETTERS = np.array([*range(97, 123), *range(192, 256)])
#: distinct words that a counting task holds before it passes them on
HELD = 100_000
NEAR = "word string, n_near long, best_n long, best_word string"


def lowered(text: str) -> str:
    """Only A-Z lower-cased."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of docs (doc_id, text): words of ``shortest`` letters or more with ``least`` occurrences or more. Where ``noise``
    divides the crc32 of ``<doc_id>:<lower-cased run>``, the run's letter at crc32 % length is left out."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        # a run that is shorter gives no word; the pattern still takes maximal runs, as it starts where a run starts
        find = re.compile(RUNS + "{%d,}" % shortest).findall

        def told(seen: dict):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["word", "n"])

        crc32, (seen, get) = zlib.crc32, fresh()
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = value.as_py()
                if not text:
                    continue
                begun = crc32(f"{'' if row is None else row}:".encode())
                for word, n in Counter(find(lowered(text))).items():
                    h = crc32(word.encode(), begun)
                    if not h % noise:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < shortest:
                            continue
                    seen[word] = get(word, 0) + n
                if len(seen) >= HELD:
                    yield told(seen)
                    seen, get = fresh()
        if seen:
            yield told(seen)

    def fresh() -> tuple:
        seen: dict = {}
        return seen, seen.get

    return (docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


def class_counts(word):
    """Letters of a word column by class, the last class with all other letters."""
    length = F.length(word)
    own = [length - F.length(F.translate(word, c, "")) for c in CLASSES[:-1]]
    return F.array(*own, length - sum(own[1:], own[0]))


def neighbour_steps() -> list[tuple[int, list[int]]]:
    """(0 or 1 letters more, change of the class counts) to the blocks that a block meets, each pair of blocks once."""
    k = len(CLASSES)
    unit = np.eye(k, dtype=int)
    same = [(0, [0] * k)] + [(0, list(map(int, unit[i] - unit[j]))) for i, j in itertools.combinations(range(k), 2)]
    return same + [(1, list(map(int, unit[i]))) for i in range(k)]


def blocks(words: DataFrame) -> DataFrame:
    """Words (word, n) packed by length and class counts: ``length``, ``cell``, ``part``, ``letters`` (Latin-1 bytes of all words),
    ``counts``. A block of more words or letters than the bounds is cut into parts by a hash."""
    placed = words.select("word", "n", F.length("word").alias("length"), class_counts(F.col("word")).alias("cell"))
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_LETTERS) / F.col("length"))))
    many = placed.groupBy("length", "cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
    packed = (placed.join(many, ["length", "cell"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
              .groupBy("length", "cell", "part").agg(F.collect_list(F.struct("word", "n")).alias("own")))
    return packed.select("length", "cell", "part", F.encode(F.array_join(F.col("own")["word"], ""), "ISO-8859-1").alias("letters"),
                         F.col("own")["n"].alias("counts"))


def letter_counts(words: np.ndarray) -> np.ndarray:
    """How often each letter is in each word (rows of Latin-1 codes)."""
    place = np.zeros(256, dtype=np.int64)
    place[LETTERS] = np.arange(len(LETTERS))
    at = place[words] + len(LETTERS) * np.arange(len(words))[:, None]
    # sums of squares are whole numbers: exact in single precision while they are below 2 ** 24
    kind = np.float32 if words.shape[1] < 4096 else np.float64
    return np.bincount(at.ravel(), minlength=len(LETTERS) * len(words)).reshape(len(words), len(LETTERS)).astype(kind)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of words ``a`` and ``b`` (rows of codes, ``b`` of the same length or one more) that are one edit apart; in a
    block met with itself (``same``) each pair once."""
    x, y = letter_counts(a), letter_counts(b)
    far = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    near = (far <= 2) & (far >= 1)
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    length, keep = a.shape[1], [np.zeros(0, dtype=bool)]
    step = max(1, SLICE * 16 // length)
    for at in range(0, len(i), step):
        p, q = a[i[at:at + step]], b[j[at:at + step]]
        if b.shape[1] == length:
            keep.append((p != q).sum(axis=1) == 1)
        else:  # what agrees from the left and what agrees from the right make up the shorter word
            left = np.cumprod(p == q[:, :length], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
            right = np.cumprod((p == q[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
            keep.append(left + right >= length)
    kept = np.concatenate(keep)
    return i[kept], j[kept]


def best_near(words: np.ndarray, others: np.ndarray, counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple:
    """For the words (places ``i``) near others (places ``j``): place, number of near words, n and place of the best one."""
    text = others[j].reshape(-1).view(f"S{others.shape[1]}")
    order = np.lexsort((text, -counts[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    return i[first], np.diff(np.r_[first, len(i)]), counts[j[first]], j[first]


def near_words(words: DataFrame, path: str) -> DataFrame:
    """Per word with a near word: ``n_near``, and its near word of largest n (ties: the first in code-point order)."""
    packed = stored(blocks(words), f"{path}/blocks")
    steps = F.array(*[F.struct(F.lit(longer).alias("longer"), F.array(*map(F.lit, step)).alias("step"))
                      for longer, step in neighbour_steps()])
    asked = (packed.select("length", "cell", "part", "letters", "counts", F.explode(steps).alias("to"))
             .select((F.col("length") + F.col("to")["longer"]).alias("length"),
                     F.zip_with("cell", F.col("to")["step"], lambda c, s: c + s).alias("cell"), F.col("part").alias("from"),
                     F.col("letters").alias("a"), F.col("counts").alias("an"), F.col("to")["longer"].alias("longer"),
                     F.forall(F.col("to")["step"], lambda s: s == 0).alias("home"))
             .where(F.forall("cell", lambda c: c >= 0)))
    # the parts of one block meet each other once
    met = asked.join(packed, ["length", "cell"]).where(~F.col("home") | (F.col("from") <= F.col("part"))).select(
        "length", F.concat_ws(",", "cell", F.col("part").cast("string")).alias("block"), "longer",
        (F.col("home") & (F.col("from") == F.col("part"))).alias("same"), "a", "an", F.col("letters").alias("b"), F.col("counts").alias("bn"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            met: dict = {}  # a block's visitors of one length are met together, up to a bound
            for r, key in enumerate(zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True)):
                met.setdefault(key, []).append(r)
            for (length, _, longer, same), rows in met.items():
                own = np.frombuffer(batch.column(6)[rows[0]].as_buffer(), dtype=np.uint8).reshape(-1, length)
                own_n = batch.column(7)[rows[0]].values.to_numpy()
                while rows:
                    some, size = [], 0
                    while rows and (not some or size < TOGETHER):
                        some.append(rows.pop())
                        size += len(batch.column(5)[some[-1]])
                    other = np.concatenate([np.frombuffer(batch.column(4)[r].as_buffer(), dtype=np.uint8) for r in some]
                                           ).reshape(-1, length - longer)
                    other_n = np.concatenate([batch.column(5)[r].values.to_numpy() for r in some])
                    i, j = near_pairs(other, own, same)
                    if not len(i):
                        continue
                    for x, y, n, at, to in ((other, own, own_n, i, j), (own, other, other_n, j, i)):
                        word, many, best_n, best = best_near(x, y, n, at, to)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x[w].tobytes().decode("latin-1") for w in word]), pa.array(many, pa.int64()),
                             pa.array(best_n, pa.int64()), pa.array([y[w].tobytes().decode("latin-1") for w in best])],
                            names=["word", "n_near", "best_n", "best_word"])

    found = met.mapInArrow(run, NEAR).groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best_word").alias("word"))).alias("best"))
    return found.select("word", "n_near", (-F.col("best")["less"]).alias("best_n"), F.col("best")["word"].alias("best_word"))


def variant_groups(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
                   least: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z lower-cased, less
    one letter in the occurrences that ``word_counts`` picks; those of ``shortest`` letters and ``least`` occurrences
    (``n``) count. Words are near if exactly one inserted, deleted or replaced letter parts them. A word's
    ``form`` is its near word of the largest n (ties: the first in code-point order) if that n is at least ``ratio`` times its
    own, else null; ``root`` is the last word reached by following forms, the word itself without one. Null
    and empty texts have no words; a null id counts as the empty text; repeated rows count again; an empty table
    gives an empty result; other columns are not read.

    Scale: counts are added up in the tasks before the shuffle, so a hot word is one row a task; everything
    after goes by the distinct words. A block holds at most ``BLOCK_WORDS`` words; a word that is near to
    many is summed up in the block pairs first. Forms grow by ``ratio``, so few rounds of joins find the roots.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    words = stored(word_counts(own, shortest, least), f"{path}/words")
    near = near_words(words, path)
    told = F.col("best_n") >= ratio * F.col("n")
    formed = stored(words.join(near, "word", "left").select(
        "word", F.when(told, F.col("best_word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(told, F.col("best_n")).alias("form_n")), f"{path}/formed")
    roots = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), f"{path}/roots0")
    k = 0
    while True:
        k += 1
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("top"))
        far = stored(roots.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"),
                                                           F.col("top").isNotNull().alias("moved")), f"{path}/roots{k}")
        roots = far.select("word", "root")
        if not far.where("moved").limit(1).count():
            break
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
