"""A training-data pipeline of five corpus operators; part of the subpackage ``masklens.llm``.

``run`` applies ``STAGES`` to the documents; each stage's result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.llm.bpe import encode_documents
from masklens.llm.common import scratch, stored, table, word_count
from masklens.llm.minhash import near_duplicates
from masklens.llm.mixing import mix
from masklens.llm.pii import KINDS, pseudonymize
from masklens.llm.queries import bounded_batches, pii_key, tokenizer_text
from masklens.llm.toxicity import score_documents


def keyed(docs: DataFrame, path: str) -> tuple[DataFrame, str]:
    """The rows with a key of their own in a column of an unused name, written once: decisions go by it, as ids may be
    shared or null."""
    key = "row_key"
    while key in docs.columns:
        key += "_"
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), f"{path}/keyed", codec="zstd"), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; the columns stay as they are.

    Every row is decided by its own text: rows that share an id, and rows without one, are kept or go each for
    itself. Null and empty texts score the share of toxic examples, and stay. Without labels all rows stay; an empty
    table gives an empty one.
    """
    bounded_batches(spark)
    path = scratch(spark, "stage-toxicity")
    rows, key = keyed(docs, path)
    scored = score_documents(rows, table(spark, sf_dir, "labels"), path, row=key)
    toxic = stored(scored.where("predicted = 1").select(key), f"{path}/toxic")
    return rows.join(toxic, key, "left_anti").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id (rows without an id come last; of several rows of
    one id the first read); the columns stay as they are.

    Documents link at a Jaccard similarity of their five-word shingles of 0.80 or more. Rows are compared by
    their own texts, so rows that share an id stay unless their texts are alike, and rows without an id take part.
    Null and empty texts, and texts of blanks, link with nothing and stay. An empty table gives an empty one.
    """
    bounded_batches(spark)
    path = scratch(spark, "stage-minhash")
    rows, key = keyed(docs, path)
    found = near_duplicates(rows, path, percent=80, doc_id=key).select(F.col("doc_id").alias(key), "component_id")
    # only groups of several rows are looked at: a row links with another one, or its group is itself
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    grouped = stored(found.join(several, "component_id").join(rows.select(key, "doc_id"), key), f"{path}/grouped")
    first = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key))[key].alias("first"))
    lost = stored(grouped.join(first, "component_id").where(F.col(key) != F.col("first")).select(key), f"{path}/lost")
    return rows.join(lost, key, "left_anti").select(docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with validated personal data permuted; ``n_chars`` is the new text's length where it changed.

    The key is the session's (see ``pii_key``). Rows and columns stay: null and empty texts as they are, repeated rows alike, an
    empty table empty.
    """
    bounded_batches(spark)
    found = [f"n_{k}" for k in KINDS]
    changed = pseudonymize(docs.drop(*found), pii_key(spark))
    total = sum((F.col(c) for c in found), F.lit(0))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(total > 0, F.length("text")).otherwise(F.col("n_chars"))
                                     .cast(docs.schema["n_chars"].dataType))
    return changed.select([c for c in docs.columns if c not in found])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document that is taken several times is repeated, one that is not taken goes.

    Rows count one by one, whatever their ids. Documents without words (null, empty, blanks) have size 0 and follow the whole
    passes of their source; a null source is one of the sources, the last. Ties between rows of a size go by the
    operator's seed. An empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in ("source_size", "target", "copies", "taken")]
    sized = docs.select(*own, word_count(F.col("text")).alias("_size"))
    mixed = mix(sized, scratch(spark, "stage-mix"), size="_size")
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, beside the other columns.

    Null and empty texts have no ids, repeated rows equal ones; an empty table gives an empty one.
    """
    bounded_batches(spark)
    return encode_documents(docs, tokenizer_text())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("pii pseudonyms", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe encoding", encode),
]

#: toxicity, MinHash, Feistel permutations, the knapsack and BPE are not SQL: the stages have brute-force tests
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    path = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{path}/{k}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
