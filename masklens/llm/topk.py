"""Exact top-k by inner product: columnar branch-and-bound over blocks of vectors.

Candidates are kept in blocks in vertical layout (one row per dimension). For a block of queries the
partial inner products grow dimension block by dimension block; after each, what the dimensions left can
still add is bounded by the remaining masses (Cauchy-Schwarz), and the candidates that can no longer reach
a query's k best are compacted away. What is left at the end has its exact product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masklens.llm.common import stored

QUERY_BLOCK, CANDIDATE_BLOCK = 1_024, 8_192
QUERY_SLICE = 64  # queries whose first partial products are held at once
DIMENSION_BLOCK = 16
#: packed queries that are broadcast at once, at most (one block more)
ROUND_BYTES = 48 << 20
PACK = "block long, ids binary, width int, cells binary"
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def quantize(vector: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component; integers in doubles, exact up to 2**53."""
    return np.floor(256.0 * vector.astype(np.float64))


def top_products(queries: np.ndarray, query_ids: np.ndarray, cells: np.ndarray, ids: np.ndarray,
                 k: int, floors: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, product) of each query's k largest products, ties to the smaller id.

    ``queries`` is (queries, dimensions); ``cells`` is (dimensions, candidates), both of integral doubles.
    Candidates with the query's own id take no part. ``floors``: by query, a product below which none is asked for.
    """
    width = cells.shape[0]
    largest = lambda x: float(np.abs(x).max(initial=0.0))
    if largest(queries) * largest(cells) * max(1, width) >= 2.0 ** 53:
        yield from _wide_products(queries, query_ids, cells, ids, k)
        return
    cuts = list(range(0, width, DIMENSION_BLOCK)) + [width]
    left_q = [np.sqrt((queries[:, c:] ** 2).sum(axis=1)) for c in cuts]
    left_c = [np.sqrt((cells[c:] ** 2).sum(axis=0)) for c in cuts]
    first = queries[:, :cuts[1]] @ cells[:cuts[1]] if width else np.zeros((len(queries), len(ids)))
    for qi, own in enumerate(query_ids):
        alive = np.flatnonzero(ids != own)
        partial = first[qi, alive]
        for step in range(1, len(cuts)):
            if step > 1:
                a, b = cuts[step - 1], cuts[step]
                partial = partial + queries[qi, a:b] @ cells[a:b, alive]
            if cuts[step] == width or len(alive) <= k and floors is None:
                continue
            slack = left_q[step][qi] * left_c[step][alive] * (1 + 1e-9) + 1e-6
            floor = np.partition(partial - slack, len(alive) - k)[len(alive) - k] if len(alive) > k else -np.inf
            keep = partial + slack >= (floor if floors is None else max(floor, floors[qi]))
            alive, partial = alive[keep], partial[keep]
        best = np.lexsort((ids[alive], -partial))[:k]
        for i in best:
            yield int(own), int(ids[alive[i]]), int(partial[i])


def _wide_products(queries, query_ids, cells, ids, k):
    """The same with whole numbers of any size, for components that doubles cannot add exactly; the
    products are held to 64 bits."""
    as_int = np.vectorize(int, otypes=[object])
    q, c = as_int(queries) if queries.size else queries, as_int(cells) if cells.size else cells
    for qi, own in enumerate(query_ids):
        scores = q[qi].dot(c) if cells.shape[0] else np.zeros(len(ids), dtype=object)
        ranked = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != own)
        for s, i in ranked[:k]:
            yield int(own), i, min(LONG_MAX, max(LONG_MIN, -s))


def usable(vector):
    """Not null, and no component null, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))), F.lit(False))


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors (row long, vector array) of a partition, in vertical layout.

    Shorter vectors of a block are filled with zeros, which add nothing to a product.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        serial, ids, vectors = 0, [], []

        def block() -> pd.DataFrame:
            width = max(map(len, vectors), default=0)
            cells = np.zeros((width, len(ids)))
            for i, v in enumerate(vectors):
                cells[:len(v), i] = quantize(v)
            return pd.DataFrame({"block": [(TaskContext.get().partitionId() << 32) + serial],
                                 "ids": [np.array(ids, dtype=np.int64).tobytes()], "width": [width],
                                 "cells": [cells.tobytes()]})

        for batch in batches:
            for row, vector in zip(batch["row"], batch["vector"], strict=True):
                ids.append(row)
                vectors.append(np.asarray(vector))
                if len(ids) == size:
                    yield block()
                    serial, ids, vectors = serial + 1, [], []
        if ids:
            yield block()

    return rows.mapInPandas(run, PACK)


def unpack(ids: bytes, cells: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, dtype=np.int64)
    return own, np.frombuffer(cells).reshape(width, len(own))


def exact_top_k(vectors: DataFrame, queries: DataFrame, path: str, *, k: int = 5, vec_id: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k largest inner products with
    ``vectors`` (components floor(256 x)), ties to the smaller id, the query's own id left out.

    Null vectors, vectors with null or non-finite components and null ids take no part. Vectors of
    different lengths meet as if filled with zeros; empty vectors score 0. With fewer than k candidates all
    are returned. A candidate id that occurs in several rows is one candidate per row; a query id that
    occurs in several rows is asked once, with the row of the largest vector. Empty tables give an empty
    result; other columns are not read.

    Scale: queries and candidates are packed into blocks of bounded size. The packed queries go out by broadcast in rounds of
    ``ROUND_BYTES``; in a round every task reads its candidate blocks where they are stored, so no candidate is shuffled or copied, and
    carries each query's k-th product on from block to block as a bound. A round leaves k rows per query and task, which are
    written; the driver holds one round's queries.
    """
    take = lambda df: df.select(F.col(vec_id).cast("long").alias("row"), F.col(vector).alias("vector")).where(
        F.col(vec_id).isNotNull() & usable(F.col(vector)))
    asked = take(queries).groupBy("row").agg(F.max("vector").alias("vector"))
    parts = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    packed_q = stored(pack(asked.coalesce(parts), QUERY_BLOCK), f"{path}/queries")
    packed_c = stored(pack(take(vectors), CANDIDATE_BLOCK), f"{path}/candidates")
    width_bytes = F.octet_length("cells") + F.octet_length("ids")
    sizes = packed_q.select("block", width_bytes.alias("size")).orderBy("block").collect()  # two numbers a block
    rounds: list[list[int]] = [[]]
    held = 0
    for r in sizes:
        if held >= ROUND_BYTES:
            rounds.append([])
            held = 0
        rounds[-1].append(r["block"])
        held += r["size"]
    spark = vectors.sparkSession

    def run_round(blocks: list[int]) -> DataFrame:
        rows = packed_q.where(F.col("block").isin(blocks)).orderBy("block").collect()
        shared = spark.sparkContext.broadcast([(bytes(r["ids"]), bytes(r["cells"]), r["width"]) for r in rows])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[int, list[tuple[int, int]]] = {}  # by query: (-product, id) of the k best so far
            asked = [(own, cells) for own, cells in (unpack(*r) for r in shared.value)]
            for batch in batches:
                for r in batch.itertuples(index=False):
                    ids, cells = unpack(r.ids, r.cells, r.width)
                    for own, asked_cells in asked:
                        width = min(len(asked_cells), r.width)
                        rows_of = np.ascontiguousarray(asked_cells[:width].T)
                        for at in range(0, len(own), QUERY_SLICE):
                            some = own[at:at + QUERY_SLICE]
                            floors = np.array([-best[q][k - 1][0] if len(best.get(q, ())) >= k else -np.inf for q in some.tolist()])
                            for q, i, score in top_products(rows_of[at:at + QUERY_SLICE], some, cells[:width], ids, k, floors):
                                best.setdefault(q, []).append((-score, i))
                            for q in some.tolist():
                                if q in best:
                                    best[q] = sorted(best[q])[:k]
            if best:
                yield pd.DataFrame([(q, i, -s) for q, own in best.items() for s, i in own], columns=["query_id", "vec_id", "score"])

        return packed_c.select("ids", "width", "cells").mapInPandas(run, "query_id long, vec_id long, score long")

    near = [stored(run_round(blocks), f"{path}/near/{n}") for n, blocks in enumerate(rounds)]
    found = spark.read.schema(near[0].schema).parquet(*[f"{path}/near/{n}" for n in range(len(near))])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
