import collections
import hashlib
import re
import unicodedata
import zlib

import numpy as np
import pytest

from masklens.llm import embeddings, licenses, minhash, mixing, pii, suffixes, topk, toxicity, warc
from masklens.llm.bpe import PrefixBPE, encode_documents
from masklens.llm.common import connected_components, word_count
from masklens.llm.queries import tokenizer_text
from tests.llm.data import documents

from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def test_components(spark, tmp_path):
    edges = [(i, i + 1) for i in range(10, 60)] + [(5, 60), (80, 81), (81, 80), (90, 90)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c")).collect()
    assert {r.node: r.component for r in got} == {**{i: 5 for i in range(10, 61)}, 5: 5, 80: 80, 81: 80}


# 1 mixing

def test_fit_budget_is_exact_where_a_subset_exists():
    assert sum(n * c for n, c in zip((7, 5, 3), mixing.fit_budget([7, 5, 3], [2, 3, 4], 21), strict=True)) == 21
    assert mixing.fit_budget([10], [3], 14) == [1] and mixing.fit_budget([10], [3], 16) == [2]
    assert mixing.fit_budget([4, 6], [1, 1], 99) == [1, 1] and mixing.fit_budget([], [], 5) == []


def water_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), {}
    while True:
        rest = total - sum(target.values())
        over = [s for s in open_ if weight[s] * rest / sum(weight[x] for x in open_) > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.remove(s)
    rest, w = total - sum(target.values()), sum(weight[x] for x in open_)
    return target | {s: weight[s] * rest / w for s in open_}


def test_mix(spark, docs, tmp_path):
    sized = docs.drop("size", "target").withColumn("words", word_count(F.col("text")))
    got = mixing.mix(sized, str(tmp_path / "a"), size="words").collect()
    again = mixing.mix(sized.repartition(5), str(tmp_path / "b"), size="words").collect()
    key = lambda rows: sorted((str(r.doc_id), r.text or "", r.taken) for r in rows)
    assert len(got) == docs.count() and key(got) == key(again)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert r.words == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and r.taken == r.copies * r.words <= 3 * r.words
        sizes[r.source] += r.words
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in got)
    assert target == pytest.approx(water_targets(sizes))
    for s, want in target.items():
        lengths = [r.words for r in got if r.source == s and r.words]
        assert abs(taken[s] - want) <= max(lengths, default=0) / 2 + 1
    assert mixing.mix(sized.limit(0), str(tmp_path / "c"), size="words").count() == 0


# 2 PII

@pytest.mark.parametrize("size", [1, 2, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    p = pii.Feistel(b"k", "t", size)
    images = [p.apply(x) for x in range(size)]
    assert sorted(images) == list(range(size)) and [p.undo(x) for x in images] == list(range(size))


@pytest.mark.parametrize("kind,value,mold", [
    ("card", "4785 3805 9239 1139", r"4\d{3} \d{4} \d{4} \d{4}"), ("ip", "152.143.123.131", r"\d+(\.\d+){3}"),
    ("phone", "+1 (743) 555-3824", r"\+1 \(\d{3}\) \d{3}-\d{4}"), ("date", "2021-02-28", r"\d{4}-\d\d-\d\d"),
    ("date", "28/02/2021", r"\d\d/\d\d/\d{4}"), ("date", "3/4/2021", r"\d/\d/\d{4}"), ("date", "28.02.2021", r"\d\d\.\d\d\.\d{4}"),
    ("ssn", "123-45-6789", r"\d{3}-\d\d-\d{4}"), ("email", "hein.19@mail5.example.com", r"[a-z]{4}\.\d\d@mail5.example.com")])
def test_pseudonyms_keep_format_and_undo(kind, value, mold):
    names = pii.Pseudonyms(b"key")
    new = names.image(kind, value)
    assert re.fullmatch(mold, new) and new != value
    assert pii.FOUND.fullmatch(new).lastgroup == kind
    assert names.image(kind, new, undo=True) == value


def test_pseudonymize(spark):
    texts = ["card 4785380592391139, again 4785380592391139.", "mail a.b9@x.org!! ip 10.0.0.1", None, "", "no data 123 at all",
             "bad 4785380592391138 and 300.1.1.1 and 31/02/2021", "4785380592391139"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_card int")
    got = {r.doc_id: r for r in pii.pseudonymize(df, b"k").collect()}
    image = got[6].text
    assert got[0].text == f"card {image}, again {image}." and got[0].n_card == 2 and pii.luhn_digit(image[:-1]) == int(image[-1])
    assert "a.b9" not in got[1].text and "10.0.0.1" not in got[1].text and (got[1].n_email, got[1].n_ip) == (1, 1)
    assert [got[i].text for i in (2, 3, 4, 5)] == texts[2:6] and sum(got[5][f"n_{k}"] for k in pii.KINDS) == 0
    assert pii.pseudonymize(df.limit(0), b"k").count() == 0


# 3 BPE

def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    spec = tokenizer_text()
    lib, own = Tokenizer.from_str(spec), PrefixBPE(spec)
    odd = ["", "It's WE'LL <|endoftext|>x<|startoftext|>", "ΟΔΥΣΣΕΥΣ ς", "a\x1cb !\x1f!", "İstanbul É é", "x" * 500, "漢字 12½ ٣"]
    rnd = np.random.default_rng(1)
    odd += ["".join(rnd.choice(list("abcdeinrst's.,! \n"), 60)) for _ in range(300)]
    for text in odd:
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        assert own.decode(want) == lib.decode(want, skip_special_tokens=False)
    for r in encode_documents(docs.withColumn("ids", F.lit(1)), spec).join(docs.select("row", "text"), "row").collect():
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(docs.limit(0), spec).count() == 0


def test_bpe_of_every_code_point():
    """Each code point alone, between letters, doubled and between capitals: the library's ids."""
    from tokenizers import Tokenizer

    spec = tokenizer_text()
    lib, own = Tokenizer.from_str(spec), PrefixBPE(spec)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # assigned ones of any table, and one in 97 of the others
    points = [c for c in points if unicodedata.category(c) != "Cn" or ord(c) in own.later or ord(c) in own.lower or ord(c) % 97 == 0]
    points = [c for c in points if unicodedata.category(c) not in ("Co", "Lo") or ord(c) % 7 == 0 or ord(c) in own.later]
    texts = [f"a{c}b {c} x{c}{c}'S" for c in points]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    bad = [hex(ord(points[i])) for i, (ids, told) in enumerate(zip(own.encode_all(texts), want, strict=True)) if list(ids) != told]
    assert not bad


def test_suffix_automaton_finds_all_tokens():
    """Tokens that end at each place of random words, by the automaton and by trying all."""
    from masklens.llm.bpe import SuffixAutomaton

    import random

    rnd = random.Random(7)
    tokens = {w: i for i, w in enumerate({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(150)})}
    automaton = SuffixAutomaton(tokens)
    for _ in range(300):
        word, state, size = "".join(rnd.choice("abcd") for _ in range(20)), 0, 0
        for at in range(1, 21):
            state, size = automaton.step(state, size, word[at - 1])
            assert size == max(n for n in range(at + 1) if any(word[at - n:at] in t for t in tokens))
            want = sorted(((i, len(t)) for t, i in tokens.items() if word[:at].endswith(t)), key=lambda x: -x[1])
            assert list(automaton.ending(state, size)) == want


def test_bpe_memory_turns_over(monkeypatch):
    """Small memories, shared prefixes and long words change no ids."""
    from masklens.llm import bpe as module
    from tokenizers import Tokenizer

    import random

    monkeypatch.setattr(module, "MEMO_CHUNKS", 30)
    monkeypatch.setattr(module, "MEMO_WORDS", 20)
    monkeypatch.setattr(module, "MEMO_PAIRS", 50)
    spec, rnd = tokenizer_text(), random.Random(5)
    lib, own = Tokenizer.from_str(spec), PrefixBPE(spec)
    texts = [" ".join("".join(rnd.choice(("in", "ter", "na", "tion", "al", "é", "S", ".", "'s", "7")) for _ in range(rnd.randint(1, 40))) for _ in range(25))
             for _ in range(60)]
    for k in range(0, 60, 6):
        assert [list(x) for x in own.encode_all(texts[k:k + 6])] == [e.ids for e in lib.encode_batch(texts[k:k + 6], add_special_tokens=False)]


# 4 WARC

def test_warc_round_trip(spark, tmp_path):
    bodies = [(i, f"http://h/{i}", "same" if i % 3 else "x" * (i * 40_000), 5) for i in range(1, 30)]
    bodies += [(40, None, None, 5), (41, "u", "", 5), (42, "u\r\nv", "é", 5), (43, "u", "é", 5), (43, "u", "é", 5)]
    pages = spark.createDataFrame(bodies, "page_id long, url string, html string, payload int")
    index = warc.write_bundles(warc.as_records(pages, str(tmp_path / "w")), str(tmp_path / "b"))
    got = {r.record_id: r for r in warc.read_records(index, str(tmp_path / "b")).collect()}
    last = {}
    for i, _, body, _ in bodies:
        last[body or ""] = max(last.get(body or "", 0), i)
    for i, _, body, _ in bodies:
        r, raw = got[str(i)], (body or "").encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == warc.payload_digest(raw)
        if last[body or ""] == i:
            assert r.record_type == "response" and bytes(r.payload) == raw and r.refers_to is None
        else:
            assert r.record_type == "revisit" and r.refers_to == str(last[body or ""]) and r.payload is None
    assert index.select("frame").distinct().count() > 1
    some = warc.read_records(index.where("record_id in ('5', '42')"), str(tmp_path / "b")).collect()
    assert sorted(r.record_id for r in some) == ["42", "5"]
    empty = warc.write_bundles(warc.as_records(pages.limit(0), str(tmp_path / "e")), str(tmp_path / "eb"))
    assert warc.read_records(empty, str(tmp_path / "eb")).count() == 0


# 5 MinHash

def components(links, ids):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != root[b]
            root[a] = root[b] = low
    return root


def test_minhash(spark, docs, tmp_path):
    rows = [r for r in docs.collect()]
    sets = {}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets.setdefault(r.doc_id, []).append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    flat = [(i, s) for i, own in sets.items() if i is not None for s in own if s]
    links = [(a, b) for a, s in flat for b, t in flat if a < b and 100 * len(s & t) >= 85 * len(s | t)]
    want = components(links, [i for i in sets if i is not None])
    got = minhash.near_duplicates(docs, str(tmp_path / "m")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id][0])
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]) and r.kept == (r.doc_id == r.component_id)
    assert minhash.near_duplicates(docs.limit(0), str(tmp_path / "e")).count() == 0


def test_minhash_searches_buckets_that_the_smallest_class_does_not_join(spark, tmp_path):
    """A chain 1 - 2 - 3 ... of small changes: far ends are unlike, neighbours link; all is one component."""
    words = [f"v{i}" for i in range(300)]
    rows = []
    for k in range(60):
        words = words[:k * 4] + [f"z{k}"] + words[k * 4 + 1:]
        rows.append((k, " ".join(words), "s"))
    got = minhash.near_duplicates(documents(spark, rows), str(tmp_path / "m")).collect()
    assert {r.component_id for r in got} == {0}


# 6 suffixes

def brute_repeats(rows, width):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for j in range(len(b) - width + 1):
                w = b[j:j + width]
                first[w] = min(first.get(w, i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - width + 1) if i is not None else ():
            if first[b[j:j + width]] < i:
                gone[j:j + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        yield i, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("width", [16, 50])
def test_suffixes(spark, docs, tmp_path, monkeypatch, width):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rnd = np.random.default_rng(3)
    near = ["".join(rnd.choice(list("ab"), 120)) for _ in range(20)]
    rows += [(400 + i, t) for i, t in enumerate(near)] + [(420 - i, near[i][7:90] + near[i + 1][:70]) for i in range(19)]
    rows += [(450, "a" * 500), (451, "a" * 49), (452, "b" + "a" * 60)]
    got = suffixes.remove_repeats(documents(spark, [(i, t, "s") for i, t in rows]).repartition(3), str(tmp_path / "s"), width=width)
    key = lambda x: sorted(map(str, x))
    assert key(tuple(r) for r in got.drop("spans").collect()) == key(brute_repeats(rows, width))
    assert suffixes.remove_repeats(docs.limit(0), str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("most", [0, 3, 40])
def test_suffixes_of_hot_anchors(spark, docs, tmp_path, monkeypatch, most):
    """A passage in many documents, each with neighbours of its own, and hot anchors of few or all units: as by brute force."""
    monkeypatch.setattr(suffixes, "HOT_SHAPES", most)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 6000)
    rnd = np.random.default_rng(5)
    word = lambda n: "".join(rnd.choice(list("abcdefgh "), n))
    passage, other = word(130), word(70)
    rows = [(i, word(rnd.integers(20, 90)) + (passage if i % 3 else other) + word(rnd.integers(0, 90))) for i in range(150)]
    rows += [(200, passage), (201, passage[:60]), (None, passage), (202, None), (3, passage + passage)]
    got = suffixes.remove_repeats(documents(spark, [(i, t, "s") for i, t in rows]).repartition(4), str(tmp_path / "s"), width=50)
    key = lambda x: sorted(map(str, x))
    assert key(tuple(r) for r in got.drop("spans").collect()) == key(brute_repeats(rows, 50))


def test_windows_of_hot_anchors_meet_in_any_bucket(spark, tmp_path, monkeypatch):
    """More buckets than a chunk has anchors: windows of hot anchors are answered from buckets that hold none of its anchors."""
    monkeypatch.setattr(suffixes, "HOT_SHAPES", 0)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 500)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 50)
    rnd = np.random.default_rng(6)
    word = lambda n: "".join(rnd.choice(list("abcdefgh "), n))
    passage = word(130)
    rows = [(i, word(rnd.integers(20, 90)) + passage + word(rnd.integers(0, 90))) for i in range(40)]
    rows += [(50, passage[:60]), (51, word(40)), (None, passage), (52, None)]
    got = suffixes.remove_repeats(documents(spark, [(i, t, "s") for i, t in rows]).repartition(4), str(tmp_path / "s"), width=50)
    key = lambda x: sorted(map(str, x))
    assert key(tuple(r) for r in got.drop("spans").collect()) == key(brute_repeats(rows, 50))


# 7 top-k

@pytest.mark.parametrize("small", [False, True])
def test_topk(spark, tmp_path, monkeypatch, small):
    """Against all products; with ``small`` in many rounds of queries and many blocks a task."""
    if small:
        monkeypatch.setattr(topk, "ROUND_BYTES", 1)
        monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 20)
    rnd = np.random.default_rng(7)
    rows = [(i, list(map(float, rnd.normal(size=33))), 1) for i in range(400)]
    rows += [(500, rows[0][1], 1), (501, rows[0][1], 1), (502, None, 1), (503, [1.0, None], 1), (504, [float("nan")], 1),
             (505, [], 1), (506, [3e30] * 33, 1), (507, [2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = topk.exact_top_k(df, df.where("vec_id % 50 == 0"), str(tmp_path / "k"), k=5).collect()
    cells = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in [i for i in cells if i % 50 == 0]:
        best = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(cells[q], c)))), i)
                      for i, c in cells.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.exact_top_k(df.limit(0), df.limit(0), str(tmp_path / "e")).count() == 0


# 8 toxicity

def test_block_max_index_is_exact():
    """Neighbours with all ties at the last place, against all cosines; one block, many blocks, equal vectors."""
    rnd = np.random.default_rng(8)
    weights = rnd.uniform(0.1, 3, 60) * (rnd.random(60) > 0.1)
    raw = [(sorted(rnd.choice(60, rnd.integers(0, 8), replace=False)), rnd.integers(1, 5, 8)) for _ in range(700)]
    raw += [raw[5], raw[5], ([3], [1]), ([3], [2]), *[([7, 9], [1, 1])] * 30]
    vectors = [toxicity.unit_vector(t, n[:len(t)], weights) for t, n in raw]
    index = toxicity.BlockMaxIndex(toxicity.Examples(list(range(len(raw))), [i % 2 for i in range(len(raw))], vectors), weights)
    for t, w in [*vectors[:80], vectors[-1], vectors[-31]]:
        if not len(t):
            continue
        dense = np.zeros(60)
        dense[t] = w
        sims = {i: round(float(dense[u] @ x), 10) for i, (u, x) in enumerate(vectors) if len(u)}
        last = sorted((s for s in sims.values() if s > 0), reverse=True)[:15][-1]
        got = index.top(t, w)
        assert {int(index.ids[p]) for _, p in got} == {i for i, s in sims.items() if s >= last and s > 0}
        assert [c for c, _ in got] == sorted((c for c, _ in got), reverse=True)


def toxicity_by_brute_force(texts, labelled):
    """Scores from the definitions alone: dictionaries, all cosines, votes."""
    def terms(text):
        got = collections.Counter()
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            got.update([w, w[:5] + "-"] if len(w) > 5 else [w])
        return got

    known = [(terms(t), y) for t, y in labelled]
    n, pos = len(known), sum(y for _, y in known)
    weight = {}
    for w in {w for t, _ in known for w in t}:
        df, both = sum(w in t for t, _ in known), sum(y for t, y in known if w in t)
        chi2 = (both * n - df * pos) ** 2 / (df * (n - df) * pos * (n - pos)) if df < n else 0
        weight[w] = chi2 * (np.log((1 + len(texts)) / (1 + sum(w in terms(t) for t in texts))) + 1)

    def vector(t):
        v = {w: (1 + np.log(c)) * weight[w] for w, c in t.items() if weight.get(w, 0) > 0}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors, prior, out = [(vector(t), y) for t, y in known], pos / n, []
    for text in texts:
        own = vector(terms(text))
        if not own:
            m = [y for v, y in vectors if not v]
            k = (len(m) - 1) / len(m) if m else 0
            out.append((k * sum(m) + prior) / (k * len(m) + 1))
            continue
        cosine = [(round(sum(x * v.get(w, 0) for w, x in own.items()), 10), y) for v, y in vectors if v]
        cosine = sorted([c for c in cosine if c[0] > 0], key=lambda c: -c[0])
        near = [c for c in cosine if c[0] >= cosine[:15][-1][0]]
        m = sum(c >= 1 for c, _ in near)
        votes = [((1 if c < 1 else (m - 1) / m) / (1.05 - c), y) for c, y in near]
        out.append((sum(v * y for v, y in votes) + prior) / (sum(v for v, _ in votes) + 1))
    return out


def test_toxicity_equals_brute_force(spark, tmp_path):
    """The whole score on 20 labelled documents among odd ones; few labels still tell texts apart."""
    import random

    rnd = random.Random(3)
    words = ["lorem", "ipsum", "dolorsit", "amet", "consectetur", "adipiscing", "elit"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 12)) + (["Scumbag", "idiot"] if i % 4 == 0 else [])) for i in range(40)]
    texts += [None, "", "42 !?", "unknown zzz", texts[0], texts[1], "idiot " * 4000]
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score int")
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1 and i < 40][:20]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in ids], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels, str(tmp_path / "t")).collect()}
    want = toxicity_by_brute_force(texts, [(texts[i], int(i % 4 == 0)) for i in ids])
    assert [got[i].score for i in range(len(texts))] == pytest.approx(want, abs=1e-9)
    assert len({round(s, 6) for s in want}) > 5 and got[46].predicted == 1


def test_toxicity_rows_of_shared_and_null_ids(spark, tmp_path):
    rows = [(1, "nice words here", 0), (1, "idiot scum", 1), (None, "idiot scum", 2), (None, None, 3)]
    docs = spark.createDataFrame([*rows, *[(i, ("idiot scum" if i % 2 else "nice words here") + f" w{i % 7}", i) for i in range(10, 60)]],
                                 "doc_id long, text string, key long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 60)], "doc_id long, toxic int")
    got = {r.key: r.predicted for r in toxicity.score_documents(docs, labels, str(tmp_path / "t"), row="key").collect()}
    assert len(got) == 54 and [got[i] for i in range(4)] == [0, 1, 1, 0]


def test_toxicity_held_out(spark, tmp_path):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    odd = spark.createDataFrame([(None, "idiot", 1), (5000, None, 1), (5001, "", 1), (5002, "idiot scum", 1)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs.select("doc_id", "text").union(odd.select("doc_id", "text")), labels,
                                                         str(tmp_path / "t")).collect()}
    for i, r in got.items():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    assert got[5000].score == got[5001].score < 0.5 and got[5002].predicted == 1 and got[5002].evidence
    known = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p and not t for t, p in known) <= 1 and sum(t and p for t, p in known) >= 0.7 * sum(t for t, _ in known)
    none = toxicity.score_documents(docs.limit(3), labels.limit(0), str(tmp_path / "n")).collect()
    assert [r.score for r in none] == [0.0] * 3
    assert toxicity.score_documents(docs.limit(0), labels, str(tmp_path / "e")).count() == 0


# 9 embeddings

def test_embeddings(spark, tmp_path, monkeypatch):
    rnd = np.random.default_rng(9)
    centres = rnd.normal(size=(12, 16))
    rows = [(i, list(map(float, centres[i % 12] + rnd.normal(size=16) * 0.1)), i % 2) for i in range(700)]
    rows += [(800 + i, rows[3][1], 1) for i in range(9)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("inf")] * 16, 1),
                                                          (903, rows[0][1], None), (904, [2 * x for x in rows[0][1]], 0), (904, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    got = embeddings.near_duplicates(df, str(tmp_path / "v")).collect()
    fit = [(k, i, np.array(v), y) for k, (i, v, y) in enumerate(rows) if v and y is not None and np.isfinite(v).all() and any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, _, v, _ in fit])
    ok = (unit @ unit.T >= 0.98) & (np.array([y for *_, y in fit])[:, None] == np.array([y for *_, y in fit]))
    n = {k: int(ok[a].sum()) - 1 for a, (k, *_) in enumerate(fit)}
    want = components([(fit[a][1], fit[b][1]) for a, b in np.argwhere(ok)], [i for i, _, _ in rows])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(
        (i, n.get(k, 0), want[i]) for k, (i, _, _) in enumerate(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.limit(0), str(tmp_path / "e")).count() == 0


# 10 licences

def test_licenses(spark, tmp_path):
    pages = [(1, "https://h/a/LICENSE", "<p>Released under the MIT License.</p>"), (2, "https://h/a/b/c/x.html?q", "<p>text</p>"),
             (3, "https://h/a/b/", "x\nLicensed under the Apache License, Version 2.0\ny"), (4, "https://h/z", None), (5, None, "none"),
             (6, "https://H/a/y", ""), (7, "https://k/a/y", "released under the mit license"), (7, "https://k/a/y", "released under the mit license"),
             (8, "https://h/a/q", "a licence is a fine thing to have in " + "many words " * 5000)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, host string")
    got = sorted((r.page_id, r.license, r.status, r.inherited_from) for r in licenses.scan(df, str(tmp_path / "l")).collect())
    assert got == [(1, "MIT", "own", None), (2, "Apache-2.0", "inherited", "/a/b/"), (3, "Apache-2.0", "own", None), (4, None, "none", None),
                   (5, None, "none", None), (6, "MIT", "inherited", "/a/"), (7, "MIT", "own", None), (7, "MIT", "own", None),
                   (8, "MIT", "inherited", "/a/")]
    assert licenses.scan(df.limit(0), str(tmp_path / "e")).count() == 0


def nearest_by_brute_force(segments, templates, least):
    """(score, licence) by dictionaries: all cosines, telling words, the margin."""
    own = [licenses.tokens_of(t.text) for t in templates]
    idf = {w: np.log((1 + len(own)) / (1 + sum(w in x for x in own))) + 1 for x in own for w in x}
    far = np.log(1 + len(own)) + 1

    def vector(words):
        return {w: (1 + np.log(words.count(w))) * idf[w] if w in idf else far for w in words}

    vectors, best = [vector(x) for x in own], {}
    for words in segments:
        v = vector(words)
        norm = np.sqrt(sum(x * x for x in v.values()))
        for t, u in zip(templates, vectors, strict=True):
            if t.telling <= set(words) and words:
                score = round(sum(x * u.get(w, 0) for w, x in v.items()) / norm / np.sqrt(sum(x * x for x in u.values())), 6)
                if score >= least:
                    best[t.name] = max(best.get(t.name, 0), score)
    if not best:
        return None
    order = sorted(((s, n) for n, s in best.items()), reverse=True)
    rest = [s for s, n in order if not order[0][1].endswith(n)]
    return order[0][0], "unknown" if rest and order[0][0] - rest[0] < licenses.MARGIN else order[0][1]


def test_nearest_templates_equal_brute_force(spark):
    """Pieces of notices mixed with other words: scores and licences."""
    import random

    rnd, rows, want = random.Random(6), [], {}
    for uid in range(250):
        segments = []
        for k in range(rnd.randint(1, 3)):
            words = licenses.tokens_of(rnd.choice(licenses.NOTICES).text)
            cut = rnd.randint(0, 3)
            words = words[cut // 2:len(words) - cut % 2] + [rnd.choice(("foo", "the", "mit", "license", "3", "bar"))] * rnd.randint(0, 2)
            segments.append(words)
            rows.append((uid, k, words))
        want[uid] = nearest_by_brute_force(segments, licenses.NOTICES, 0.6)
    got = licenses.nearest_templates(spark.createDataFrame(rows, "uid long, k int, words array<string>"), licenses.NOTICES, 0.6)
    found = {r.uid: (r.score, r.license) for r in got.collect()}
    for uid, told in want.items():
        assert (uid in found) == (told is not None)
        if told:
            assert found[uid][0] == pytest.approx(told[0], abs=2e-6) and found[uid][1] == told[1]
    assert len({v[1] for v in found.values()}) > 15


def test_license_key_words_leave_no_template_out(spark):
    """Every segment that holds all telling words of a template passes ``can_tell``."""
    rows = [(i, sorted(t.telling)) for i, t in enumerate(licenses.NOTICES)]
    got = spark.createDataFrame(rows, "i int, words array<string>").where(licenses.can_tell(F.col("words"))).count()
    assert got == len(rows) and all(t.telling and t.telling <= set(licenses.tokens_of(t.text)) for t in licenses.NOTICES)


GPL2 = ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as "
        "published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.")


def test_license_notice_forms(spark, tmp_path):
    """Each notice form, those of the pages among them, gets its own licence; what is not known or not clear is unknown."""
    apache = "Licensed under the Apache License, Version 2.0"
    texts = dict(licenses.TEXTS)
    told = [*[(t.name, t.text) for t in licenses.NOTICES], ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0"),
            ("ISC", "Licensed under the ISC License"), ("MIT", "// SPDX-License-Identifier: MIT"), ("MIT", "Released under the MIT License."),
            ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
            ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("Apache-2.0", f"{apache}."),
            ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-2.0", GPL2), ("GPL-2.0", " * " + GPL2.replace("\n", "\n * ")),
            ("GPL-3.0", GPL2.replace("version 2", "version 3")), ("LGPL-2.1", GPL2.replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1")),
            ("AGPL-3.0", GPL2.replace("GNU General", "GNU Affero General").replace("version 2", "version 3")),
            ("unknown", "licensed under the Example Corp Commercial License, version 3"), ("unknown", f"Licensed under the MIT License. {apache}."),
            (None, texts["BSD-2-Clause"][60:200]), ("MIT", "Released under the <a href='x'>MIT License</a>."),
            ("Apache-2.0", "<!-- SPDX-License-Identifier: Apache-2.0 -->text"), ("Apache-2.0", f"<p>Licensed under\nthe Apache License,\nVersion 2.0 (the \"License\")</p>")]
    df = spark.createDataFrame([(i, f"https://h{i}/x", f"<p>{t}</p>") for i, (_, t) in enumerate(told)],
                               "page_id long, url string, html string")
    got = {r.page_id: (r.own_license, r.status) for r in licenses.scan(df, str(tmp_path / "l")).collect()}
    for i, (name, text) in enumerate(told):
        assert got[i] == (name, "none" if name is None else "unknown" if name == "unknown" else "own"), text


def test_license_files_by_their_whole_text(spark, tmp_path):
    """Licence files with names, years and other wrapping, against the texts; unknown ones declare nothing."""
    texts = dict(licenses.TEXTS)
    files = [(name, texts[name].replace("(c)", "(c) 2020 Jane Doe").replace(". ", ".\n\n")) for name in texts]
    files += [("BSD-2-Clause", texts["BSD-2-Clause"].replace("BSD 2-Clause License ", "")), (None, "see elsewhere"), (None, ""),
              ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1989 Free Software Foundation"),
              ("unknown", "Licensed under the Example License")]
    rows = [(2 * i, f"https://h{i}/LICENSE.txt", t) for i, (_, t) in enumerate(files)] + [(2 * i + 1, f"https://h{i}/a/b", "x") for i in range(len(files))]
    got = {r.page_id: (r.license, r.status) for r in
           licenses.scan(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "l")).collect()}
    for i, (name, _) in enumerate(files):
        assert got[2 * i][0] == name
        assert got[2 * i + 1] == ((None, "none") if name in (None, "unknown") else (name, "inherited"))


def test_license_notice_inside_a_paragraph(spark, tmp_path):
    """Notices inside long one-line paragraphs count; words that notices merely share with other texts do not."""
    prose = "Here we speak about quite different subjects and never mention any terms, " * 40
    mit = ("MIT License Copyright (c) 2024 Example Corp Permission is hereby granted, free of charge, to any person obtaining a copy of "
           "this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies")
    told = [("MIT", "Copyright 2024 Example Corp. All rights reserved. Released under the MIT License. See the file for details."),
            ("CC-BY-NC-4.0", f"{prose}Licensed under CC BY-NC 4.0. {prose}"), ("Apache-2.0", f"{prose}SPDX-License-Identifier: Apache-2.0 {prose}"),
            ("MIT", mit), (None, prose), (None, "Er kam mit 3 Leuten mit in den Saal und ging mit 2 davon"), (None, "mit ihm for mit 4.0"),
            (None, "By."), ("CC-BY-NC-4.0", "CC BY-NC 4.0"), ("GPL-3.0", "GPLv3")]
    df = spark.createDataFrame([(i, f"https://h{i}/x", f"<p>{t}</p>") for i, (_, t) in enumerate(told)],
                               "page_id long, url string, html string")
    got = {r.page_id: r.own_license for r in licenses.scan(df, str(tmp_path / "l")).collect()}
    assert got == {i: name for i, (name, _) in enumerate(told)}


def test_licence_hint_branches_by_first_characters_only(spark):
    """The pattern of key words tries one way for each first character, and finds the words that a list of all of them finds."""
    keys = licenses.key_words(licenses.NOTICES)[0]
    hint = licenses.any_of(keys)
    depth, ways = 0, 1
    for c in hint.replace("\\", ""):
        depth += {"(": 1, ")": -1}.get(c, 0)
        ways += c == "|" and depth == 1
    assert ways == len({k[0] for k in keys}) < len(keys) / 4
    texts = [f"{a}{k.upper()}{b}" for k in keys for a, b in (("", ""), ("x ", " y"), ("x", ""), ("", "é"), ("(", ")."), ("", "-9"))]
    texts += [k[:-1] for k in keys] + ["", " ", "v", "v1", "by-", "lgplv2.1.", "gplv", "apache-2,0"]
    edge = r"(?i)(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = "(" + "|".join(map(re.escape, keys)) + ")"
    assert not df.where(F.col("t").rlike(plain.join(edge)) != F.col("t").rlike(hint.join(edge))).collect()
    assert df.where(F.col("t").rlike(hint.join(edge))).count() > len(keys)
