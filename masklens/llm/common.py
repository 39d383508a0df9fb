"""Helpers shared by the corpus operators: tables, scratch tables in the shared folder, components."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.session import ensure_checkpoint_dir

# one word: a run without space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run inside the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    """Write a table and read it again: lineage is cut and a lost executor costs no rerun of it."""
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def worker_state(key, build):
    """One object per Python worker process, built on first use and kept for the tasks that follow, until another one is asked for."""
    store = vars(sys.modules.setdefault("_corpus_worker_state", types.ModuleType("_corpus_worker_state"))).setdefault("held", {})
    if key not in store:
        store.clear()  # a later stage's state takes the place of an earlier one's
        store[key] = build()
    return store[key]


def word_count(text):
    """Number of words in a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def connected_components(edges: DataFrame, path: str) -> DataFrame:
    """Smallest reachable node for every node of an edge list.

    ``edges`` has long columns ``a``, ``b`` (undirected; loops and repeats allowed, nulls not). Returns
    ``node``, ``component`` for nodes that occur in an edge with another node. Each round hooks every node
    to its smallest neighbour, shortcuts the pointers to their roots by repeated self-joins, and carries
    on with the edges between different roots; every round at least halves the roots that still have
    edges. A pointer always leads to a smaller node, so the last root is the smallest node. Tables live
    under ``path``; nothing but row counts reaches the driver.
    """
    spark = edges.sparkSession
    live = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), f"{path}/edges0")
    maps: list[DataFrame] = []
    k = 0
    while live.limit(1).count():
        k += 1
        both = live.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            live.select(F.col("b").alias("node"), F.col("a").alias("to")))
        ptr = stored(both.groupBy("node").agg(F.min("to").alias("to"))
                     .select("node", F.least("node", "to").alias("to")), f"{path}/hook{k}")
        hop = 0
        while True:
            hop += 1
            up = ptr.select(F.col("node").alias("to"), F.col("to").alias("top"))
            nxt = stored(ptr.join(up, "to", "left")
                         .select("node", F.coalesce("top", "to").alias("to"),
                                 (F.coalesce("top", "to") < F.col("to")).alias("moved")),
                         f"{path}/jump{k}-{hop}")
            ptr = nxt.select("node", "to")
            if not nxt.where("moved").limit(1).count():
                break
        maps.append(ptr)
        pa = ptr.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        pb = ptr.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        live = stored(live.join(pa, "a").join(pb, "b").where("ra <> rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                      f"{path}/edges{k}")
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    out = maps[0]
    for i, m in enumerate(maps[1:]):
        out = stored(out.join(m.select(F.col("node").alias("to"), F.col("to").alias("top")), "to", "left")
                     .select("node", F.coalesce("top", "to").alias("to")), f"{path}/map{i}")
    return out.select("node", F.col("to").alias("component"))
