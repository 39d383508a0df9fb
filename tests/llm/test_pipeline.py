import collections
import re

import corpus_pipeline
from masklens.llm import pii
from tests.llm.data import documents


def test_stages_on_odd_rows(spark, tmp_path):
    """Each stage on the odd table: what it returns has the columns of documents and follows its rule."""
    docs = documents(spark)
    sf_dir = "/root/testdata/sf0.001"
    toxic = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert toxic.columns == docs.columns and toxic.count() == docs.count()  # nothing here is toxic
    unique = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert unique.columns == docs.columns
    ids = [r.doc_id for r in unique.select("doc_id").collect()]
    assert 0 in ids and 200 not in ids and {300, 301, 302, 303} <= set(ids)
    assert ids.count(303) == 1 and None not in ids  # repeated rows; a copy of document 1 without an id
    private = spark.createDataFrame([(1, "ip 10.0.0.1", "en", "s", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    hidden = corpus_pipeline.hide_personal_data(spark, private, sf_dir)
    row = hidden.first()
    assert hidden.columns == private.columns and row.n_chars == len(row.text) and row.text != "ip 10.0.0.1"
    spark.conf.set("spark.masklens.pii.key", "a secret")
    try:
        row = corpus_pipeline.hide_personal_data(spark, private, sf_dir).first()
    finally:
        spark.conf.unset("spark.masklens.pii.key")
    assert row.text == "ip " + pii.Pseudonyms(b"a secret").image("ip", "10.0.0.1")
    mixed = corpus_pipeline.mix_sources(spark, docs.drop("target"), sf_dir)
    assert mixed.columns == docs.drop("target").columns


def test_near_duplicates_link_at_080(spark):
    """Long copies with single words changed, at 0.82 and 0.78, against brute force."""
    def shingles(words):
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    first = [f"a{i}" for i in range(1000)]
    near = [f"x{i}" if i % 51 == 25 else w for i, w in enumerate(first)]  # about 2% of the words
    far = [f"y{i}" if i % 41 == 20 else w for i, w in enumerate(first)]
    a, b, c = map(shingles, (first, near, far))
    assert 0.80 < len(a & b) / len(a | b) < 0.85 and len(a & c) / len(a | c) < 0.80 and len(b & c) / len(b | c) < 0.80
    docs = documents(spark, [(1, " ".join(first), "s"), (2, " ".join(near), "s"), (3, " ".join(far), "s")])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 3]


def test_rows_of_shared_and_null_ids_are_decided_one_by_one(spark, tmp_path):
    """No row goes or stays for another row's text; unlike texts of one id all stay."""
    clean, other = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    toxic = "idiot scum " * 5
    labelled = [(100 + i, toxic + f"t{i}" if i % 2 else f"{clean} c{i}", "s") for i in range(80)]
    spark.createDataFrame([(i, 1, int((i - 100) % 2)) for i, _, _ in labelled], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    rows = [(1, clean, "a"), (1, toxic, "b"), (1, other, "c"), (None, toxic, "d"), (None, other, "e"), (None, None, "f"), (2, clean, "g"), (None, clean, "h")]
    docs = documents(spark, [*rows, *labelled])
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).where("doc_id < 100 or doc_id is null")
    assert sorted(r.source for r in kept.collect()) == list("acefgh")
    unique = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), str(tmp_path))
    assert sorted(r.source for r in unique.collect()) == list("abcf")


def test_stages_of_an_empty_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.encode(spark, docs, sf_dir).count() == 0


def test_last_stages_on_odd_rows(spark):
    from tokenizers import Tokenizer

    docs = documents(spark).drop("target")
    lib = Tokenizer.from_str(corpus_pipeline.tokenizer_text())
    got = corpus_pipeline.encode(spark, docs, "").collect()
    assert len(got) == docs.count()
    texts = {r.row: r.text for r in docs.collect()}
    assert all(r.ids == lib.encode(texts[r.row] or "", add_special_tokens=False).ids for r in got if r.row is not None)
    mixed = corpus_pipeline.mix_sources(spark, docs, "").collect()
    times = collections.Counter(r.row for r in mixed if r.row is not None)
    own = collections.Counter(r.row for r in docs.collect())
    assert set(times) <= set(texts) and all(n <= 3 * own[i] for i, n in times.items()) and all(texts[r.row] == r.text for r in mixed if r.row is not None)
    hidden = corpus_pipeline.hide_personal_data(spark, docs, "")
    assert hidden.count() == docs.count() and hidden.columns == docs.columns


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = got.collect()
    assert rows and {"doc_id", "ids", "n_tokens"} <= set(got.columns) and "text" not in got.columns
    assert all(r.n_tokens == len(r.ids) for r in rows) and all(re.fullmatch("[0-9a-f]{64}", r.ids_sha256) for r in rows)
