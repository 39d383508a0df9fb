"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The fit takes a bounded sample of labelled documents. Every word of theirs, and every beginning of a longer word, is a
term; a term's weight is its inverse document frequency over all documents times the share of chi-square by which its
presence tells the label (0 to 1), so words that say nothing count for almost nothing but none is left out by a limit.
``feature_counts`` reads every whole text once. ``BlockMaxIndex`` keeps the postings of the examples in blocks with the
largest weight of each term in each block, visits blocks by their bound and stops when no block left can hold a
nearer example, so its neighbours are exact. Votes weighted by distance give the score; the neighbours are the evidence.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored, worker_state

#: labelled documents that the model is fitted on, at most (taken by a seeded hash of their id), and the length up to which a
#: text serves as an example: together they bound the vocabulary, the index and what the driver holds
MAX_EXAMPLES, EXAMPLE_LETTERS = 2_000, 50_000
#: the beginning of so many letters of a longer word is a term too
STEM = 5
BLOCK, FIRST_BLOCKS = 64, 4
#: terms of at least one in so many examples have full rows, most postings first and so many at most; their sums bound the rest
FREQUENT, FULL_ROWS = 16, 512
NEIGHBOURS = 15
#: weight of the share of toxic examples beside the votes, and distance added to each vote's
PRIOR_WEIGHT, SOFT = 1.0, 0.05
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+")
MEMO_WORDS, MEMO_TEXTS = 200_000, 20_000

COUNTS = "row {kind}, terms array<int>, counts array<int>"


class Examples(NamedTuple):
    """Labelled examples: id, label 0 or 1, sparse unit vector (terms ascending, weights)."""

    ids: list
    labels: list
    vectors: list


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1 ... of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class BlockMaxIndex:
    """Inverted index over at most ``MAX_EXAMPLES`` sparse unit vectors."""

    def __init__(self, examples: Examples, weights: np.ndarray):
        """``weights``: of each term; those of weight 0 add nothing to any cosine."""
        self.weights, terms = weights, len(weights)
        self.prior = float(np.mean(examples.labels)) if examples.labels else 0.0
        filled = [i for i, (t, _) in enumerate(examples.vectors) if len(t)]
        empty = [examples.labels[i] for i, (t, _) in enumerate(examples.vectors) if not len(t)]
        own = (len(empty) - 1) / len(empty) if empty else 0.0  # as for equal texts: one of them never votes
        self.empty_score = (own * sum(empty) + PRIOR_WEIGHT * self.prior) / (own * len(empty) + PRIOR_WEIGHT)
        # examples of one heaviest term stand together, so that blocks are alike
        filled.sort(key=lambda i: (int(examples.vectors[i][0][np.argmax(examples.vectors[i][1])]), examples.ids[i]))
        self.ids = np.array([examples.ids[i] for i in filled], dtype=np.int64)
        self.labels = np.array([examples.labels[i] for i in filled], dtype=np.float64)
        self.blocks = -(-len(filled) // BLOCK)
        term = np.concatenate([examples.vectors[i][0] for i in filled] or [np.zeros(0, dtype=np.int64)])
        place = np.repeat(np.arange(len(filled)), [len(examples.vectors[i][0]) for i in filled])
        weight = np.concatenate([examples.vectors[i][1] for i in filled] or [np.zeros(0)])
        many = np.bincount(term, minlength=terms)
        full = np.argsort(-many, kind="stable")[:FULL_ROWS]
        full = full[many[full] * FREQUENT > len(filled)]
        self.row = np.full(terms, -1)
        self.row[full] = np.arange(len(full))
        in_row = self.row[term] >= 0
        self.rows = np.zeros((len(full), len(filled)))
        self.rows[self.row[term[in_row]], place[in_row]] = weight[in_row]
        self.first = np.arange(0, len(filled), BLOCK)
        term, place, weight = term[~in_row], place[~in_row], weight[~in_row]
        order = np.lexsort((place, term))
        term, self.place, self.weight = term[order], place[order], weight[order]
        # an entry: the postings of one term in one block
        key = term * max(1, self.blocks) + self.place // BLOCK
        self.start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        self.size = np.diff(np.r_[self.start, len(key)])
        self.block = self.place[self.start] // BLOCK
        self.most = np.maximum.reduceat(self.weight, self.start) if len(key) else np.zeros(0)
        self.entry = np.searchsorted(term[self.start], np.arange(terms + 1))

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of the largest positive cosine, and all that tie with the last, as (cosine, place), by falling cosine
        and then by id."""
        if not self.blocks:
            return []
        rows = self.row[terms]
        full = rows >= 0
        sums = weights[full] @ self.rows[rows[full]]
        terms, weights = terms[~full], weights[~full]
        sizes = self.entry[terms + 1] - self.entry[terms]
        entries, of = spread(self.entry[terms], sizes), np.repeat(weights, sizes)
        block = self.block[entries]
        # at most: the largest sum so far in the block, and each other term's largest weight there
        bound = np.maximum.reduceat(sums, self.first) + np.bincount(block, self.most[entries] * of, minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        least, at, step = 0.0, 0, FIRST_BLOCKS
        while at < self.blocks and bound[order[at]] > 0 and bound[order[at]] >= least - 1e-9:
            visit = np.zeros(self.blocks, dtype=bool)
            visit[order[at:at + step]] = True
            visit &= bound >= least - 1e-9
            own = visit[block]
            take = entries[own]
            posts = spread(self.start[take], self.size[take])
            sums += np.bincount(self.place[posts], self.weight[posts] * np.repeat(of[own], self.size[take]), minlength=len(sums))
            at, step = at + step, step * 2
            least = float(np.partition(sums, -k)[-k]) if len(sums) >= k else 0.0
        cosine = np.round(sums, 12)
        last = max(np.partition(cosine, -k)[-k], 1e-12) if len(cosine) >= k else 1e-12
        near = np.flatnonzero(cosine >= last)
        near = near[np.lexsort((self.ids[near], -cosine[near]))]
        return [(float(cosine[p]), int(p)) for p in near]

    def score(self, terms, counts) -> tuple[float, list[tuple[int, float, int]]]:
        """Score 0 to 1 and the evidence: (example's id, cosine, label) of the voters.

        Of the examples equal to the text itself one never votes, so that a label that was learned is not scored by itself:
        the votes of m equal ones count (m - 1) / m.
        """
        terms, weights = unit_vector(terms, counts, self.weights)
        if not len(terms):
            return self.empty_score, []
        near = self.top(terms, weights)
        equal = sum(cosine >= 1.0 for cosine, _ in near)
        votes = [(1.0 if cosine < 1.0 else (equal - 1) / equal) / (1.0 - cosine + SOFT) for cosine, _ in near]
        yes = sum(v * self.labels[place] for v, (_, place) in zip(votes, near, strict=True))
        score = (yes + PRIOR_WEIGHT * self.prior) / (sum(votes) + PRIOR_WEIGHT)
        return min(1.0, max(0.0, float(score))), [
            (int(self.ids[p]), cosine, int(self.labels[p])) for cosine, p in near]


def unit_vector(terms, counts, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a weight above 0 and their shares of the vector of length 1."""
    t = np.asarray(terms, dtype=np.int64)
    w = (1.0 + np.log(np.asarray(counts, dtype=np.float64))) * weights[t]
    t, w = t[w > 0], w[w > 0]
    norm = math.sqrt(float(w @ w))
    return t, w / norm if norm else w


def held_out(doc_id):
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1 (null: not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def sample_labels(labels: DataFrame, most: int = MAX_EXAMPLES, seed: int = 8) -> DataFrame:
    """At most ``most`` labelled ids to learn from; an id with several labels is toxic if any of them is."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
            .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most))


def text_terms(text: str | None) -> Counter:
    """Words of a whole text and beginnings (``stem-``) of the longer ones, with their counts."""
    got: Counter = Counter()
    for word, n in Counter(WORDS.findall(text.lower())).items() if text else ():
        got[word] += n
        if len(word) > STEM:
            got[word[:STEM] + "-"] += n
    return got


def learn_terms(texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Terms of ``texts`` (text, label) whose presence depends on the label, and their chi-square as a share (0 to 1] of its
    largest value, the number of texts."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        df, both = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = text_terms(text.as_py())
                df.update(own.keys())
                if label:
                    both.update(own.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64()), pa.array([both[w] for w in df], pa.int64())],
            names=["term", "df", "both"])

    size = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    n, pos = size["n"], size["pos"] or 0
    if not 0 < pos < n:
        return [], np.zeros(0)
    seen = (texts.select("text", "label").mapInArrow(run, "term string, df long, both long").groupBy("term")
            .agg(F.sum("df").alias("df"), F.sum("both").alias("both")).toPandas().sort_values("term"))
    df, both = seen["df"].to_numpy(dtype=float), seen["both"].to_numpy(dtype=float)
    cross = both * n - df * pos
    share = np.divide(cross * cross, df * (n - df) * pos * (n - pos), out=np.zeros(len(df)), where=df < n)
    kept = share > 0
    return seen["term"].to_numpy(dtype=object)[kept].tolist(), share[kept]


def feature_counts(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``row`` (from docs), the terms of the vocabulary in each whole ``text`` (null: none) and their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = "toxicity-" + hashlib.sha256("\0".join(vocabulary).encode("utf-8", "surrogatepass")).hexdigest()
    kind = docs.schema["row"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        place, seen = worker_state(key, lambda: ({w: i for i, w in enumerate(shared.value)}, {}))

        def own(word: str) -> tuple:
            if len(seen) >= MEMO_WORDS:
                seen.clear()
            found = place.get(word), place.get(word[:STEM] + "-") if len(word) > STEM else None
            got = seen[word] = tuple([t for t in found if t is not None])
            return got

        for batch in batches:
            terms, counts, ends = [], [], [0]
            for value in batch.column(1):
                text, got = value.as_py(), {}
                for word, n in Counter(WORDS.findall(text.lower())).items() if text else ():
                    told = seen.get(word)
                    for t in own(word) if told is None else told:
                        got[t] = got.get(t, 0) + n
                terms += got
                counts += got.values()
                ends.append(len(terms))
            cut = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(cut, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(counts, pa.int32()))], names=["row", "terms", "counts"])

    return docs.select("row", "text").mapInArrow(run, COUNTS.format(kind=kind))


def document_frequencies(counted: DataFrame, terms: int) -> np.ndarray:
    """In how many rows of ``counted`` each term is. A task sends one number a term that it has seen, at most."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["term", "n"])

    found = counted.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(terms)
    out[found["term"].to_numpy(dtype=np.int64)] = found["n"]
    return out


def score_documents(docs: DataFrame, labels: DataFrame, path: str, *, doc_id: str = "doc_id",
                    text: str = "text", row: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` (double, 0 to 1), ``predicted`` (int) and
    ``evidence`` (array of neighbour id, cosine, label). With ``row``, a column that tells rows apart even where ids are
    shared or null, results carry it in place of ``doc_id``, and ``held_out`` is left out.

    The model is fitted on at most ``MAX_EXAMPLES`` labelled documents that are not held out and have at most
    ``EXAMPLE_LETTERS`` letters (of several texts of an id the first in order); all their terms count. Document frequencies
    count all documents; every whole text is scored by its words alone. All examples that tie at the last place vote,
    and one equal to the text itself never does. A text without any term (also null and empty) gets the smoothed share of
    toxic examples among those without terms; with labels of one kind only every score is that kind, and
    with no labels at all 0. Null ids are scored and not held out; repeated rows get equal scores; an empty
    table gives an empty result; other columns are not read.

    Scale: one pass over the texts for the fit (only sampled rows go on), one for the terms; the sample, the vocabulary, its
    frequencies and the index are bounded by the constants of this module, which is why the driver may hold and send them.
    """
    own = docs.select(F.col(row or doc_id).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = stored(sample_labels(labels), f"{path}/sample")
    texts = (own.where((F.col("text").isNull()) | (F.length("text") <= EXAMPLE_LETTERS)).join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")))
    texts = stored(texts, f"{path}/texts")
    vocabulary, share = learn_terms(texts)
    counted = stored(feature_counts(own, vocabulary), f"{path}/counts")
    total = counted.count()
    weights = share * (np.log((1.0 + total) / (1.0 + document_frequencies(counted, len(vocabulary)))) + 1.0)
    known = feature_counts(texts.select(F.struct("doc_id", "label").alias("row"), "text"), vocabulary).collect()
    known.sort(key=lambda r: r["row"]["doc_id"])
    index = BlockMaxIndex(Examples([r["row"]["doc_id"] for r in known], [r["row"]["label"] for r in known],
                                   [unit_vector(r["terms"], r["counts"], weights) for r in known]), weights)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memo, index = {}, shared.value
        evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
        for batch in batches:
            scores, proofs = [], []
            ends = batch.column(1).offsets.to_numpy()
            terms, counts = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in (1, 2))
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                key = hashlib.blake2b(terms[a:b].tobytes() + counts[a:b].tobytes(), digest_size=16).digest()
                if key not in memo:
                    if len(memo) >= MEMO_TEXTS:
                        memo.clear()
                    score, near = index.score(terms[a:b], counts[a:b])
                    memo[key] = score, [{"doc_id": i, "cosine": c, "label": y} for i, c, y in near]
                score, near = memo[key]
                scores.append(score)
                proofs.append(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(proofs, evidence)],
                names=["row", "score", "evidence"])

    kind = counted.schema["row"].dataType.simpleString()
    scored = counted.mapInArrow(
        run, f"row {kind}, score double, evidence array<struct<doc_id: long, cosine: double, label: int>>")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    if row:
        return scored.select(F.col("row").alias(row), "score", predicted, "evidence")
    return scored.select(F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "score", predicted, "evidence")
