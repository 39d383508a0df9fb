"""Mixing sources to target weights: whole passes plus a subset-sum fit of the rest.

``mix`` counts documents by exact length in each source, gives every source a target, fits the part of a
target that whole passes do not fill by a bounded-knapsack dynamic program over the length counts, and
selects that many documents of each length by a seeded hash.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masklens.llm.common import stored

#: documents of one source and length are ranked in hash buckets of about this many rows
BUCKET_ROWS = 5_000
#: the dynamic program works on the last few document lengths of a budget
WINDOW_LENGTHS = 4


def fit_budget(lengths: list[int], counts: list[int], budget: int, seed: int = 0) -> list[int]:
    """How many documents of each length to take so that their sum comes nearest to ``budget``.

    ``lengths`` are distinct and positive. The bulk is taken in proportion to the counts, so that the
    subset keeps the mix of lengths; the last ``WINDOW_LENGTHS`` longest lengths are fitted by a bounded
    knapsack over the documents left, as bit sets of reachable sums. The result is exact whenever some
    subset of the documents left reaches the remaining sum, else the nearest sum (the lower on a tie).
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget <= 0 or not total:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    left = [c - t for c, t in zip(counts, take, strict=True)]
    rest = budget - sum(n * t for n, t in zip(lengths, take, strict=True))
    longest = max(lengths)
    window = WINDOW_LENGTHS * longest
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        more = max(0, min(left[i], (rest - window) // lengths[i]))
        take[i] += more
        left[i] -= more
        rest -= more * lengths[i]
    if rest <= 0:
        return take
    mask = (1 << (rest + longest + 1)) - 1
    order = [i for i in range(len(lengths)) if left[i]]
    random.Random(seed).shuffle(order)
    reach, steps = 1, []
    for i in order:
        if reach >> rest & 1:
            break
        many, part = min(left[i], (rest + longest) // lengths[i]), 1
        while many > 0 and not reach >> rest & 1:
            part = min(part, many)
            steps.append((i, part, reach))
            reach |= reach << part * lengths[i] & mask
            many -= part
            part *= 2
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    over = reach >> (rest + 1)
    above = rest + (over & -over).bit_length() if over else None
    at = below if above is None or rest - below <= above - rest else above
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            take[i] += part
            at -= part * lengths[i]
    return take


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row per source (``_null``, ``_src``, ``source_size``): its target by capped proportional shares.

    Sources get the weights in turn by code point, null last. Sorted by the level at which they reach
    their cap, the capped sources are a prefix; each stands at its cap if the level of all that remains
    at its place reaches it. One row per source is sorted, not one per document.
    """
    by_name = Window.orderBy("_null", "_src")
    by_level = Window.orderBy(F.col("_level"), "_null", "_src")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    ranked = (sizes.groupBy("_null", "_src").agg(F.sum("_words").alias("source_size"))
              .withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
              .withColumn("_level", F.col("_cap") / F.col("_w")))
    prior = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    budget = F.sum("source_size").over(every) * F.lit(float(share))
    at = (ranked.withColumn("_mine", (budget - F.coalesce(F.sum("_cap").over(prior), F.lit(0.0)))
                            / F.sum("_w").over(onward))
          .withColumn("_full", F.col("_level") <= F.col("_mine")))
    # past the first source below its cap the level only falls: that source's is the common one
    level = F.max(F.when(~F.col("_full"), F.col("_mine"))).over(every)
    return at.withColumn("_lv", level).select(
        "_null", "_src", "source_size", "_full",
        F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * F.col("_lv"))).alias("target"))


def mix(docs: DataFrame, path: str, *, size: str, key: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 20) -> DataFrame:
    """``docs`` plus ``source_size``, ``target``, ``copies`` and ``taken`` (= copies * size).

    ``size`` names a long column that holds each document's number of words. ``weights`` go to the sources
    in turn by code point (null is a source of its own, the last one); targets share ``share`` of all
    words and stop at ``most`` times the source's words, the excess going to the others by weight. A
    document is taken ``floor(target / source_size)`` times, and once more if it is in the fitted subset,
    never more than ``most`` times. Reruns select the same documents: the order is a seeded hash of the
    key, then the key.

    Defined cases: a null size counts as 0; documents of size 0 follow the whole passes (taken 0); a
    source with no words has target 0 and 0 copies; repeated rows are separate documents (equal keys are
    interchangeable); an empty table gives an empty result; other columns pass through, except that
    columns named as the four results are replaced.

    Scale: documents meet per (source, length, hash bucket), about ``BUCKET_ROWS`` rows at most, so a
    source with a third of all rows is split; sources are only grouped after aggregation by length.
    ``path`` is a scratch folder that all executors share.
    """
    rows = docs.count()
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    named = (docs.drop("source_size", "target", "copies", "taken")
             .withColumn("_null", F.col(source).isNull()).withColumn("_src", F.coalesce(F.col(source), F.lit("")))
             .withColumn("_words", F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")))
             .withColumn("_hash", F.xxhash64(F.lit(seed), F.col(key)))
             .withColumn("_bucket", F.pmod("_hash", F.lit(buckets))))
    cells = stored(named.groupBy("_null", "_src", "_words", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
                   .select("*", (F.col("_words") * F.col("_n")).alias("_mass")), f"{path}/cells")
    by_length = cells.groupBy("_null", "_src", "_words").agg(F.sum("_n").alias("_n"))
    targets = stored(source_targets(cells.select("_null", "_src", F.col("_mass").alias("_words")),
                                    weights, share, most), f"{path}/targets")

    def fitted(hist: pd.DataFrame) -> pd.DataFrame:
        words, target = int(hist["source_size"].iloc[0]), float(hist["target"].iloc[0])
        hist = hist.sort_values("_words")
        lengths, counts = [int(x) for x in hist["_words"]], [int(x) for x in hist["_n"]]
        whole = most if bool(hist["_full"].iloc[0]) else min(most, int(target // words)) if words else 0
        if not words:
            whole = 0
        extra = [0] * len(lengths)
        if whole < most and words:
            some = [i for i, n in enumerate(lengths) if n]
            got = fit_budget([lengths[i] for i in some], [counts[i] for i in some],
                             round(target - whole * words), seed)
            for i, n in zip(some, got, strict=True):
                extra[i] = n
        return pd.DataFrame({"_null": hist["_null"], "_src": hist["_src"], "_words": lengths, "source_size": words,
                             "target": target, "_whole": whole, "_extra": extra})

    plan = stored(by_length.join(targets, ["_null", "_src"]).groupBy("_null", "_src").applyInPandas(
        fitted, "_null boolean, _src string, _words long, source_size long, target double, _whole long, _extra long"),
        f"{path}/plan")
    so_far = (Window.partitionBy("_null", "_src", "_words").orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    cell_plan = stored(cells.join(plan, ["_null", "_src", "_words"])
                       .withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
                       .select("_null", "_src", "_words", "_bucket", "source_size", "target", "_whole",
                               F.greatest(F.lit(0), F.col("_extra") - F.col("_before")).alias("_extra")),
                       f"{path}/cell_plan")
    rank = F.row_number().over(Window.partitionBy("_null", "_src", "_words", "_bucket").orderBy("_hash", key))
    return (named.join(cell_plan, ["_null", "_src", "_words", "_bucket"])
            .withColumn("copies", F.col("_whole") + (rank <= F.col("_extra")).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("_words"))
            .drop("_null", "_src", "_words", "_hash", "_bucket", "_whole", "_extra"))
