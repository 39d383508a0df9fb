"""One query per corpus operator, over its whole table; the digest columns come from the operator's rows."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masklens.llm.bpe import encode_documents
from masklens.llm.common import scratch, stored, table, word_count
from masklens.llm.embeddings import near_duplicates
from masklens.llm.language import identify_documents
from masklens.llm.licenses import scan
from masklens.llm.minhash import near_duplicates as near_duplicate_documents
from masklens.llm.mixing import mix
from masklens.llm.pii import KINDS, pseudonymize
from masklens.llm.spelling import variant_groups
from masklens.llm.suffixes import remove_repeats
from masklens.llm.topk import exact_top_k
from masklens.llm.toxicity import score_documents
from masklens.llm.warc import as_records, read_records, write_bundles
from masklens.llm.whitening import whiten

#: session setting that holds the secret of the pseudonyms
PII_KEY = "spark.masklens.pii.key"
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
TOKENIZER = "word_bpe_49k.json"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to source weights 1, 2, 3 (repeating), at most 3 passes a source."""
    path = scratch(spark, "op1")
    sizes = stored(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")),
                   f"{path}/sizes")
    return mix(sizes, path, size="size").select("doc_id", "size", "source_size", "target", "taken", "source")


def pii_key(spark: SparkSession) -> bytes:
    """The secret in the session's ``spark.masklens.pii.key``; where there is none, one drawn for this run that nobody keeps, so
    values are linked within the run and can't be put back."""
    given = spark.conf.get(PII_KEY, None)
    return given.encode() if given else secrets.token_bytes(32)


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with validated personal data permuted within its format, and counts by kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, pii_key(spark)).select("doc_id", "text", *[f"n_{k}" for k in KINDS])


def tokenizer_text(name: str = TOKENIZER) -> str:
    """A tokenizer file's content, read on the driver from the installed vocabulary files."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op3_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole document with the word-level BPE vocabulary, and decode the ids again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, tokenizer_text(), with_ids=False)


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages as seekable bundles and read every record back through index and seek tables."""
    path = scratch(spark, "op4")
    index = write_bundles(as_records(table(spark, sf_dir, "pages"), path), f"{path}/bundles")
    return read_records(index, f"{path}/bundles").select(
        F.col("record_id").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard similarity of five-word shingles of 0.85 or more."""
    return near_duplicate_documents(table(spark, sf_dir, "documents"), scratch(spark, "op5"), percent=85)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from every whole document the 50-byte passages that begin in a document of a smaller id."""
    return remove_repeats(table(spark, sf_dir, "documents"), scratch(spark, "op6"), width=50).drop("spans")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest inner products of every 50th vector with all other vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), scratch(spark, "op7"), k=5)


def op8_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole document by its nearest labelled examples."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), scratch(spark, "op8"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label at cosine 0.98 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), scratch(spark, "op9"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all pages: own notices, and those inherited along the URL's directories."""
    return scan(table(spark, sf_dir, "pages"), scratch(spark, "op10"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened principal components of all vectors, fitted on the distinct ones."""
    return whiten(table(spark, sf_dir, "embeddings"), scratch(spark, "op11"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents one edit apart, with the more common form of each."""
    return variant_groups(table(spark, sf_dir, "documents"), scratch(spark, "op12"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from the labels that are not held out."""
    return identify_documents(table(spark, sf_dir, "documents"), scratch(spark, "op13")).drop("spans")


_QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pii_pseudonyms": op2_pii_pseudonyms,
    "op3_bpe_prefix_dp": op3_bpe_prefix_dp,
    "op4_warc_bundles": op4_warc_bundles,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_exact_topk": op7_exact_topk,
    "op8_toxicity_knn": op8_toxicity_knn,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language_id": op13_language_id,
}


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches of bounded size: long texts and packed blocks are large rows."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)


def _bounded(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {name: _bounded(fn) for name, fn in _QUERIES.items()}

ORACLES: dict[str, str] = {
    "op4_warc_bundles": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex,
                     max(page_id) OVER (PARTITION BY body) AS last FROM p),
        b AS (SELECT *, '0b' || array_to_string(list_transform(string_split(hex, ''), lambda c:
                  substr(bin(strpos('0123456789abcdef', c) + 15), 2)), '') AS bits FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(list_sum(list_transform(range(5), lambda j:
                       CAST(substr(bits, CAST(3 + 5 * i + j AS BIGINT), 1) AS INTEGER) * (16 >> CAST(j AS INTEGER)))) AS BIGINT) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
        FROM b""",
    "op7_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
                   FROM embeddings WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
