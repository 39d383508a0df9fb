"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct five-word shingles. One permutation scatters the shingles over the
universe; a second one, shifted circularly by 0, 1, 2 ..., gives every coordinate of the signature, so two
permutations replace one per coordinate. Bands of coordinates are the candidates' buckets; links are
confirmed on full sets and joined to components.

Documents with equal sets are one class. In each bucket every class is first checked against the bucket's
smallest class (one candidate per row, not all pairs). Only buckets that still hold classes of different
components afterwards are searched on: their members meet in bounded chunks inside tasks, which emit
links and never pairs, so no link that shares a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import connected_components, stored

WORDS_PER_SHINGLE = 5
#: a pair shares no band with probability (1 - 0.8**5)**32, about 3e-6, at similarity 0.80, and below 8e-9 at 0.85
BANDS, ROWS_PER_BAND = 32, 5
COORDINATES = BANDS * ROWS_PER_BAND
#: shingles whose coordinates are computed at once (cache-sized), and members of a bucket that meet at once
SLICE, CHUNK = 1 << 15, 256
SIGNATURES = "row long, n_shingles long, k1 long, k2 long, bands array<long>"


def scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of 32-bit numbers: odd multiplications and xor-shifts, each one-to-one."""
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    return x


def shifted(x: np.ndarray, k: int) -> np.ndarray:
    """The second permutation after a circular shift of the universe by ``k`` (wraps modulo 2**32)."""
    y = x + np.uint32(k)
    y ^= y >> np.uint32(16)
    y *= np.uint32(0x7FEB352D)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x846CA68B)
    y ^= y >> np.uint32(16)
    return y


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles (A-Z lower-cased, words between ASCII blanks)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if len(words) < WORDS_PER_SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(w.tobytes(), seed=len(words))], dtype=np.uint64)
    h = np.zeros(len(words) - WORDS_PER_SHINGLE + 1, dtype=np.uint64)
    for j in range(WORDS_PER_SHINGLE):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += w[j:j + len(h)]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return np.unique(h)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, COORDINATES) minima for sets that are not empty, computed slice by slice."""
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= SLICE):
            size += len(sets[end])
            end += 1
        starts = np.cumsum([0, *map(len, sets[at:end - 1])])
        x = scatter(np.concatenate(sets[at:end]).astype(np.uint32))
        for k in range(COORDINATES):
            out[at:end, k] = np.minimum.reduceat(shifted(x, k), starts)
        at = end
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def sign(docs: DataFrame) -> DataFrame:
    """Columns ``SIGNATURES`` for docs (row, text); empty sets and null rows have no key and no bands."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            rows = batch.column(0).to_pylist()
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            filled = [i for i, s in enumerate(sets) if len(s) and rows[i] is not None]
            k1, k2, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if filled:
                cut = signatures([sets[i] for i in filled]).reshape(len(filled), BANDS, ROWS_PER_BAND)
                for i, own in zip(filled, cut, strict=True):
                    key = xxhash.xxh3_128_intdigest(sets[i].tobytes())
                    k1[i], k2[i] = (key >> 64) - (1 << 63), (key & ((1 << 64) - 1)) - (1 << 63)
                    bands[i] = [xxhash.xxh3_64_intdigest(b.tobytes(), seed=j) - (1 << 63) for j, b in enumerate(own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["row", "n_shingles", "k1", "k2", "bands"])

    return docs.mapInArrow(run, SIGNATURES)


def as_sets(docs: DataFrame) -> DataFrame:
    """(id, items binary): the full shingle sets of docs (id, text)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())],
                names=["id", "items"])

    return docs.mapInArrow(run, "id long, items binary")


def near_duplicates(docs: DataFrame, path: str, *, percent: int = 85, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (set size), ``component_id`` (smallest doc_id reachable by
    links, itself included), ``kept`` (doc_id = component_id).

    Links: 100 * intersection >= ``percent`` * union of the sets. A text of fewer than five words is one
    shingle, its whole sequence; null and empty texts and texts of blanks have an empty set and link with
    nothing. Repeated rows and rows that share an id share a component; rows without an id link with
    nothing. An empty table gives an empty result; other columns are not read.

    Scale: texts are read twice, sets go only to candidates, equal sets are pre-aggregated, a hot bucket
    costs one candidate per member and then meets in chunks of at most ``CHUNK`` members, each chunk pair a
    row of its own. All tables between steps are written under ``path``.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).alias("text"))
    signed = stored(sign(own), f"{path}/signed")
    classes = stored(signed.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("row").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), f"{path}/classes")
    member = classes.select("id", "n", F.explode("bands").alias("bucket"))
    heads = stored(member.groupBy("bucket").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("many"))
                   .where("many > 1"), f"{path}/heads")
    full = stored(member.join(heads, "bucket").select("bucket", "id", "n", "head"), f"{path}/full")
    stars = stored(full.where("id <> head").select("head", "id").distinct(), f"{path}/stars")
    wanted = full.select("id").distinct()
    texts = own.withColumnRenamed("row", "id").join(wanted, "id", "left_semi").dropDuplicates(["id"])
    sets = stored(as_sets(texts), f"{path}/sets")

    def confirm(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64),
                            percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            got = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
            yield got.filter(pa.array(keep, pa.bool_()))

    pairs = (stars.join(sets.withColumnRenamed("items", "x"), "id")
             .join(sets.select(F.col("id").alias("head"), F.col("items").alias("y")), "head").select("head", "id", "x", "y"))
    links = stored(pairs.mapInArrow(confirm, "a long, b long"), f"{path}/links")
    first = stored(connected_components(links, f"{path}/first"), f"{path}/first_map")

    # buckets whose members are not of one component yet: every pair across components is compared
    mapped = stored(full.join(first, F.col("id") == F.col("node"), "left")
                    .select("bucket", "id", "n", F.coalesce("component", "id").alias("comp")), f"{path}/mapped")
    split = (mapped.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                          F.count(F.lit(1)).alias("many"),
                                          F.sum(F.xxhash64("id") % (1 << 40)).alias("s1"),
                                          F.sum(F.xxhash64(F.lit(1), "id") % (1 << 40)).alias("s2"))
             .where("lo < hi"))
    once = stored(split.groupBy("many", "s1", "s2").agg(F.min("bucket").alias("bucket")), f"{path}/once")
    chunks = F.ceil(F.col("many") / CHUNK).cast("long")
    open_rows = (mapped.join(once.select("bucket", "many"), "bucket").withColumn("chunks", chunks)
                 .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))))
    # a chunk meets itself and every other chunk: its rows go to the chunk pairs that it is part of
    met = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "bucket", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), "chunk", "id", "n", "comp")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        """Links across components within one chunk, or between two; found components are merged as it goes."""
        rows = rows.sort_values(["n", "id"])
        ids, n, comp, chunk = (rows[c].to_numpy() for c in ("id", "n", "comp", "chunk"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["items"]]
        between = rows["c1"].iloc[0] != rows["c2"].iloc[0]
        comp, found = comp.copy(), []
        for i in range(len(ids)):
            last = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
            for j in range(i + 1, last):
                if comp[i] != comp[j] and (not between or chunk[i] != chunk[j]) and similar(sets[i], sets[j], percent):
                    found.append((int(ids[i]), int(ids[j])))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    more = stored(met.join(sets, "id").groupBy("bucket", "c1", "c2").applyInPandas(search, "a long, b long"),
                  f"{path}/more")
    reach = connected_components(links.union(more), f"{path}/all")
    told = stored(classes.select("k1", "k2", "id").join(reach, F.col("id") == F.col("node"), "left")
                  .select("k1", "k2", F.coalesce("component", "id").alias("component")), f"{path}/told")
    out = signed.select("row", "n_shingles", "k1", "k2")
    linked = out.where("k1 is not null").join(told, ["k1", "k2"]).select("row", "n_shingles", "component")
    alone = out.where("k1 is null").select("row", "n_shingles", F.col("row").alias("component"))
    # rows that share an id have one component: the smallest of theirs
    return linked.union(alone).select(F.col("row").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                                      F.col("row").eqNullSafe(F.col("component")).alias("kept"))
