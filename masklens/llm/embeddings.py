"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors at cosine ``c`` or more are at most ``epsilon = sqrt(2 - 2c)`` apart, and so are their
projections on any orthonormal directions. Vectors are sorted by label and by the grid cells (of width
epsilon) of their projections on the leading principal directions, and cut into sequence intervals. Pairs
of intervals whose boxes are further apart than epsilon are skipped; the others are joined recursively,
halving intervals and skipping again, down to small products that are checked in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import connected_components, stored
from masklens.llm.topk import usable

#: principal directions come from at most so many vectors (they only decide what is skipped, never what links)
SAMPLE = 4_096
DIRECTIONS = 6
INTERVAL, LEAF = 512, 64
ROUNDING = 1e-9

INTERVALS = ("interval long, label string, c_lo long, c_hi long, lo array<double>, hi array<double>, size int, "
             "width int, keys binary, counts binary, vectors binary")
FOUND = "k1 long, k2 long, links long, a long, b long"


def principal_directions(vectors: list[np.ndarray], most: int = DIRECTIONS) -> np.ndarray:
    """Orthonormal rows, by falling variance; empty without vectors."""
    width = max((len(v) for v in vectors), default=0)
    if not width:
        return np.zeros((0, 0))
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x -= x.mean(axis=0)
    _, directions = np.linalg.eigh(x.T @ x)
    return directions[:, ::-1].T[:most].copy()


def project(unit: np.ndarray, directions: np.ndarray) -> np.ndarray:
    width = min(unit.shape[1], directions.shape[1])
    return unit[:, :width] @ directions[:, :width].T


def as_units(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    x /= np.abs(x).max(axis=1, keepdims=True)  # first by the largest component: no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_matrix(a: np.ndarray, b: np.ndarray, pa: np.ndarray, pb: np.ndarray, least: float, epsilon: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors; ``pa``, ``pb`` their projections) have cosine >= least."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    width = min(a.shape[1], b.shape[1])
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i == j or k == m:
            continue
        gap = np.maximum(0, np.maximum(pa[i:j].min(0) - pb[k:m].max(0), pb[k:m].min(0) - pa[i:j].max(0)))
        if float(gap @ gap) > epsilon * epsilon * (1 + 1e-6) + ROUNDING:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            cosine = a[i:j, :width] @ b[k:m, :width].T
            sure = cosine >= least + ROUNDING
            for x, y in np.argwhere((cosine >= least - ROUNDING) & ~sure):  # at the limit: sum exactly
                sure[x, y] = math.fsum(a[i + x, :width] * b[k + y, :width]) >= least
            out[i:j, k:m] = sure
        elif j - i >= m - k:
            mid = (i + j) // 2
            todo += [(i, mid, k, m), (mid, j, k, m)]
        else:
            mid = (k + m) // 2
            todo += [(i, j, k, mid), (i, j, mid, m)]
    return out


def component_stars(linked: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its component) for the nodes of a two-sided link matrix that have a link."""
    if not linked.any():
        return []
    far = np.iinfo(np.int64).max
    la, lb = ids_a.copy(), ids_b.copy()
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], far).min(axis=1))
        nb = np.minimum(lb, np.where(linked, na[:, None], far).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return sorted({(int(i), int(r)) for i, r in [*zip(ids_a, la, strict=True), *zip(ids_b, lb, strict=True)] if i != r})


def near_duplicates(vectors: DataFrame, path: str, *, least: float = 0.98, vec_id: str = "vec_id",
                    vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id
    reachable, itself included), ``kept`` (vec_id = component_id).

    Vectors link if their labels are equal and not null and their cosine in double precision is at least
    ``least``. Null and zero vectors, vectors with null or non-finite components, and null ids link with
    nothing. Vectors of different lengths meet as if filled with zeros. Repeated rows are separate vectors
    that link with each other; rows that share an id share a component. An empty table gives an empty
    result; other columns are not read.

    Scale: equal vectors are one class with a count, so copies are never paired. The rest are sorted by a
    range partitioning that ends in the class key, so a hot label or cell is spread over many tasks; an
    interval has at most ``INTERVAL`` classes, and a pair of intervals is one row. All links must be
    counted, so the work grows with the pairs of intervals that are near each other.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("row"), F.col(label).cast("string").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("fit", F.col("row").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
                           & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)))
    keyed = stored(rows.withColumn("k1", F.when(F.col("fit"), F.xxhash64("label", "vector")))
                   .withColumn("k2", F.when(F.col("fit"), F.xxhash64(F.lit(9), "vector", "label"))), f"{path}/keyed")
    classes = stored(keyed.where("fit").groupBy("k1", "k2").agg(
        F.min("row").alias("id"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"),
        F.first("vector").alias("vector")), f"{path}/classes")

    some = classes.orderBy(F.xxhash64(F.lit(3), "k1")).limit(SAMPLE).select("vector").collect()
    directions = principal_directions([np.array(r["vector"]) for r in some])
    epsilon = math.sqrt(max(0.0, 2.0 - 2.0 * least))
    cells = min(DIRECTIONS, len(directions))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.floor(project(as_units(list(batch["vector"])), directions) / max(epsilon, 1e-6)).astype(np.int64)
            batch["cells"] = [list(map(int, x)) for x in at]
            yield batch

    placed = classes.mapInPandas(place, "k1 long, k2 long, id long, n long, label string, vector array<double>, "
                                        "cells array<long>")
    order = ["label", *[F.element_at("cells", i + 1) for i in range(cells)], "k1", "k2"]
    parts = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        serial, held = 0, []

        def interval() -> pd.DataFrame:
            nonlocal serial
            serial += 1
            unit = as_units([r.vector for r in held])
            at = project(unit, directions)
            first = [int(r.cells[0]) if cells else 0 for r in held]
            return pd.DataFrame([{
                "interval": (TaskContext.get().partitionId() << 32) + serial, "label": held[0].label,
                "c_lo": min(first), "c_hi": max(first), "lo": at.min(0), "hi": at.max(0), "size": len(held),
                "width": unit.shape[1], "keys": np.array([(r.k1, r.k2, r.id) for r in held], dtype=np.int64).tobytes(),
                "counts": np.array([r.n for r in held], dtype=np.int64).tobytes(), "vectors": unit.tobytes()}])

        for batch in batches:
            for r in batch.itertuples(index=False):
                if held and (len(held) == INTERVAL or held[0].label != r.label):
                    yield interval()
                    held = []
                held.append(r)
        if held:
            yield interval()

    packed = stored(ranged.mapInPandas(cut, INTERVALS), f"{path}/intervals")
    boxes = packed.select("interval", "label", "c_lo", "c_hi", "lo", "hi")
    left = boxes.select(F.col("interval").alias("i"), "label", F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"),
                        F.explode(F.sequence("c_lo", "c_hi")).alias("cell"))
    right = boxes.select(F.col("interval").alias("j"), "label", F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"),
                         F.explode(F.sequence(F.col("c_lo") - 1, F.col("c_hi") + 1)).alias("cell"))
    gap = F.zip_with(F.zip_with("lo_i", "hi_j", lambda x, y: F.greatest(x - y, F.lit(0.0))),
                     F.zip_with("lo_j", "hi_i", lambda x, y: F.greatest(x - y, F.lit(0.0))),
                     lambda x, y: F.greatest(x, y))
    near = (left.join(right, ["label", "cell"]).where("i <= j")
            .withColumn("gap", F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x))
            .where(F.col("gap") <= epsilon * epsilon * (1 + 1e-6) + ROUNDING).select("i", "j").distinct())
    side = lambda s, k: packed.select(F.col("interval").alias(k), *[
        F.col(c).alias(f"{c}_{s}") for c in ("size", "width", "keys", "counts", "vectors")])
    pairs = stored(near, f"{path}/near").join(side("a", "i"), "i").join(side("b", "j"), "j")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                own = [(np.frombuffer(k, dtype=np.int64).reshape(n, 3), np.frombuffer(c, dtype=np.int64),
                        np.frombuffer(v).reshape(n, w)) for n, w, k, c, v in (
                    (r.size_a, r.width_a, r.keys_a, r.counts_a, r.vectors_a),
                    (r.size_b, r.width_b, r.keys_b, r.counts_b, r.vectors_b))]
                (ka, na, a), (kb, nb, b) = own
                linked = linked_matrix(a, b, project(a, directions), project(b, directions), least, epsilon)
                tall = [(ka, linked @ nb)]
                if r.i == r.j:
                    np.fill_diagonal(linked, False)
                    tall = [(ka, linked @ na)]
                else:
                    tall.append((kb, linked.T @ na))
                out = [(int(k[0]), int(k[1]), int(n), None, None) for ks, sums in tall
                       for k, n in zip(ks, sums, strict=True) if n]
                out += [(None, None, None, x, y) for x, y in component_stars(linked, ka[:, 2], kb[:, 2])]
                names = ["k1", "k2", "links", "a", "b"]  # column by column: keys must not pass through floats
                yield pd.DataFrame({c: pd.array([x[i] for x in out], dtype="Int64") for i, c in enumerate(names)})

    found = stored(pairs.mapInPandas(match, FOUND), f"{path}/found")
    reach = connected_components(found.where("a is not null").select("a", "b"), f"{path}/components")
    links = found.where("k1 is not null").groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    told = stored(classes.drop("vector", "label").join(links, ["k1", "k2"], "left")
                  .join(reach, F.col("id") == F.col("node"), "left")
                  .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                          F.coalesce("component", "id").alias("component")), f"{path}/told")
    alone = keyed.where("not fit").select(F.col("row").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                          F.col("row").alias("component_id"))
    linked = (keyed.where("fit").select("row", "k1", "k2").join(told, ["k1", "k2"])
              .select(F.col("row").alias("vec_id"), "n_links", F.col("component").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
