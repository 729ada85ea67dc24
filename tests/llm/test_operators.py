"""Edge cases, brute force and round trips of the training-data operators."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from wickflow.llm import decontaminate, licenses, pieces, ppm, quality, simhash, tokenfile, toxicity, urlrules, warc
from wickflow.llm.texts import Texts

SCHEMA = "doc_id bigint, text string, lang string, score double, row string, id string"
LONG = " ".join(f"w{i % 700}" for i in range(9_000))
TEXTS = [None, "", " \n\t ", "one", "a b c d", "A b C d", LONG, LONG + " tail", "x\x00y ▁ é中😀", "same line\nsame line\nother"]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", 1.0, "r", "i") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[6], (None, "null id", None, None, None, None)], SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/x?q", "http://a.net/es/1", "ftp://net/es/", "net/es/", None, "http://xnet/es/"]
    pages = spark.createDataFrame([*enumerate(urls), (1, urls[1])], "page_id bigint, url string")
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")
    found = sorted((r.page_id, r.host, r.rule, r.verdict) for r in urlrules.judge_urls(pages, rules).collect())
    assert found == [
        (0, "www.example.com", "www.example.com/en/", "allow"),
        (1, "a.net", "net/es/", "block"),
        (1, "a.net", "net/es/", "block"),
        (2, "net", "net/es/", "block"),
        (3, "", None, "allow"),
        (4, "", None, "allow"),
        (5, "xnet", None, "allow"),
    ]
    assert urlrules.judge_urls(pages.limit(0), rules).count() == 0


def test_url_ranges_do_not_change_the_result(spark, monkeypatch):
    rows = [(i, f"http://{'abc'[i % 3]}.example.com/{'en' if i % 2 else 'de'}/{i}") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")
    whole = sorted(urlrules.judge_urls(pages, rules).collect())
    monkeypatch.setattr(urlrules, "ROWS_PER_RANGE", 7)
    assert sorted(urlrules.judge_urls(pages, rules).collect()) == whole


def test_quality(docs, nothing):
    found = {r.doc_id: r for r in quality.judge(docs.select("doc_id", "text")).collect()}
    assert found[0].base_failed and not found[0].kept and found[0].n_words == 0
    assert found[9].n_dup_lines == 1
    assert found[6].n_repeat_words == 9_000  # every window comes back after 700 words
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 0
    assert quality.filter_documents(nothing).count() == 0


def test_toxicity(spark, docs, nothing):
    rng = random.Random(0)
    plain = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(30)) for _ in range(120)]
    rows = [(i, t + (" foul" if i % 3 == 0 else "")) for i, t in enumerate(plain)]
    own = spark.createDataFrame([*rows, (None, "foul"), (500, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [*((i, int(i % 3 == 0)) for i, _ in rows), (500, None), (None, 1), (3, 0)], "doc_id bigint, toxic int"
    )
    model = toxicity.learn(own, labels)
    scored = toxicity.score_documents(own, model).select("row.doc_id", "score").collect()
    assert len(scored) == len(rows) + 2
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 120 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all((r.score >= 0.7) == (r.doc_id % 3 == 0) for r in held)
    blank = toxicity.learn(nothing, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(docs, blank).select("score").collect()} == {0.5}


def test_decontamination(spark, docs, nothing, monkeypatch):
    items = spark.createDataFrame(
        [(1, " ".join(f"W{i}" for i in range(20, 40))), (2, "a b c"), (3, None), (4, "..."), (1, "a b c"), (5, "zz yy")],
        "item_id bigint, text string",
    )
    found = {r.row.doc_id: r for r in decontaminate.find_matches(docs, items).collect()}
    assert found[0].n_words == 0 and found[0].spans == []
    assert [tuple(s) for s in found[4].spans] == [(0, 3)] and sorted(found[4]["items"]) == [1, 2]
    assert found[6].longest == 20 and len(found[6].spans) == 13
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 8)
    again = {r.row.doc_id: r for r in decontaminate.find_matches(docs, items).collect()}
    assert all(again[i].spans == found[i].spans and set(again[i]["items"]) == set(found[i]["items"]) for i in found)
    assert decontaminate.find_matches(nothing, items).count() == 0
    assert decontaminate.find_matches(docs, items.limit(0)).filter("size(spans) > 0").count() == 0


def test_simhash_plan_covers_the_radius():
    rng = np.random.default_rng(1)
    parts = simhash.plan(rng.integers(0, 2**63, 500, dtype=np.uint64), 10_000)
    assert sum(r + 1 for _, r in parts) == simhash.RADIUS + 1
    assert sum(m.bit_count() for m, _ in parts) <= 64


@pytest.mark.parametrize("heavy", [64, 2])
def test_simhash(spark, docs, nothing, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(2)
    base = [f"t{i}" for i in range(300)]
    near = []
    for k in range(30):
        own = list(base)
        for _ in range(k % 4):
            own[rng.randrange(300)] = f"z{rng.randrange(99)}"
        near.append((100 + k, " ".join(own)))
    extra = spark.createDataFrame(near, "doc_id bigint, text string")
    all_docs = docs.select("doc_id", "text").unionByName(extra)
    rows = all_docs.collect()
    prints = [simhash.fingerprint((r.text or "").encode()) for r in rows]
    assert prints[4] == prints[5] == xxhash.xxh64_intdigest(b"a b c d", 42)
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    smallest = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            smallest[root[i]] = min(smallest.get(root[i], r.doc_id), r.doc_id)
    expected = sorted((str(r.doc_id), format(prints[i], "016x"), smallest.get(root[i])) for i, r in enumerate(rows) if r.doc_id is not None)
    found = simhash.near_duplicates(all_docs).filter("doc_id IS NOT NULL").collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == expected
    kept = simhash.one_of_each(all_docs).filter("doc_id IS NOT NULL").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(smallest.values()))
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_of_each_with_repeated_and_null_ids(spark):
    def words(name, other=None):
        return " ".join(f"{name}{i}" for i in range(300)) + (f" {other}" if other else "")

    a, near = words("a"), words("a", "tail")
    rows = [(3, near), (5, a), (5, words("b")), (7, words("c")), (7, words("d")), (8, words("e")), (8, words("e"))]
    rows += [(None, a), (None, words("c")), (None, words("f")), (None, words("f")), (None, words("g"))]
    assert 0 < (simhash.fingerprint(a.encode()) ^ simhash.fingerprint(near.encode())).bit_count() <= 4
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id or 0, r.text) for r in simhash.one_of_each(docs).collect()))
    expected = [(3, near), (5, words("b")), (7, words("c")), (7, words("d")), (8, words("e")), (0, words("f")), (0, words("g"))]
    assert kept == sorted(expected)


def test_simhash_takes_words_and_radius(spark):
    rng = random.Random(5)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for k in range(12):
        own = list(base)
        for _ in range(k % 5):
            own[rng.randrange(120)] = f"z{rng.randrange(99)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for n, radius in ((5, 9), (2, 1)):
        prints = [simhash.fingerprint(t.encode(), n) for t in texts]
        root = list(range(len(texts)))
        while root != (after := [min(root[j] for j in range(len(texts)) if (prints[i] ^ prints[j]).bit_count() <= radius) for i in range(len(texts))]):
            root = after
        found = sorted(simhash.near_duplicates(docs, words=n, radius=radius).collect())
        assert [(r.fingerprint, r.component_id) for r in found] == [(format(p, "016x"), c) for p, c in zip(prints, root, strict=True)]


def test_token_file(spark, docs, nothing, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenfile.write_tokens(docs, f"{tmp_path}/a", path)
    rows = {(r.doc_id, r.start): np.frombuffer(r.ids, "<u4").tolist() for r in tokenfile.read_tokens(spark, f"{tmp_path}/a").collect()}
    whole, start = Tokenizer.from_file(path), 0
    texts = ["null id", *(t for i, t in enumerate(TEXTS) for _ in range(2 if i == 6 else 1))]
    ids = [None, *(i for i in range(len(TEXTS)) for _ in range(2 if i == 6 else 1))]
    for i, text in zip(ids, texts, strict=True):
        expected = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        assert rows[i, start] == expected
        start += len(expected)
    tokenfile.write_tokens(nothing, f"{tmp_path}/b", path)
    assert tokenfile.read_tokens(spark, f"{tmp_path}/b").count() == 0


def test_planes():
    ids = np.random.default_rng(0).integers(0, 50_257, 20_001).astype("<u4")
    for n in (0, 1, 8192, 20_001):
        assert (tokenfile.from_planes(tokenfile.to_planes(ids[:n]), n) == ids[:n]).all()


def test_pieces_agree_with_the_library(docs, nothing):
    path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as model:
        vocabulary = pieces.Vocabulary(model.read())
    rng = random.Random(1)
    texts = [*TEXTS, "a" * 300, " " * 200, *("".join(rng.choice(" abcdeé▁\n中😀\x00the") for _ in range(rng.randrange(70))) for _ in range(300))]
    ids, at, raw, raw_at = pieces.encode_block(vocabulary, Texts(pa.array(texts)), True)
    for i, text in enumerate(texts):
        expected = vocabulary.library.encode(text or "")
        assert ids[at[i] : at[i + 1]].tolist() == expected
        assert raw[raw_at[i] : raw_at[i + 1]].tobytes().decode() == vocabulary.library.decode(expected)
    assert pieces.encode_documents(docs, path).count() == len(TEXTS) + 2
    assert pieces.encode_documents(nothing, path).count() == 0


def test_loser_tree_merges():
    rng = random.Random(3)
    for k in range(6):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(9))) for _ in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs], lambda x: x))
        assert merged == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("per_range", [250_000, 2])
def test_warc(spark, tmp_path, monkeypatch, per_range):
    monkeypatch.setattr(warc, "RANGE_ENTRIES", per_range)
    rows = [(1, "http://b.com/x", "p" * 2000), (2, None, "p" * 2000), (3, "http://A.com/", None), (4, "http://a.com/", "q" * 10)]
    rows += [(5, "http://a.com/", "q" * 10), (None, "http://b.com/", "p" * 2000), (2, None, "p" * 2000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w")
    records = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert sorted((str(r.id), r.type, r.refers_to) for r in records) == sorted(
        [("1", "revisit", 2), ("2", "response", None), ("2", "response", None), ("3", "response", None)]
        + [("4", "response", None), ("5", "response", None), ("None", "revisit", 2)]
    )
    assert {r.digest for r in records if r.id == 1} == {hashlib.sha1(b"p" * 2000).hexdigest()}
    history = sorted(warc.capture_history(spark, f"{tmp_path}/w").collect())
    keys = [(r.key, r.time, r.id or 0) for r in history]
    assert keys == sorted(keys) and len(keys) == len(rows)


def test_ppm(docs, nothing):
    from pyspark.sql import functions as F

    found = ppm.score_documents(docs, F.col("doc_id") == 7).collect()
    assert len(found) == len(TEXTS) + 2
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].n_tokens == 1 and by_id[0].score < 0
    assert by_id[7].held_out and by_id[7].n_known == by_id[7].n_tokens - 1
    assert by_id[0].train_tokens == sum(r.n_tokens for r in found if not r.held_out)
    assert ppm.score_documents(nothing, F.lit(False)).count() == 0


def ppm_by_hand(train, texts, order=6):
    """log10 probabilities by dictionaries, one symbol after the other."""

    def code(text):
        words = (text or "").encode().lower().split()
        return b" " * order + b"".join(w + b" " for w in words) + b" "

    trie = {}
    for data in map(code, train):
        for i in range(order, len(data)):
            for k in range(order + 1):
                own = trie.setdefault(data[i - k : i], {})
                own[data[i]] = own.get(data[i], 0) + 1

    def symbol(data, i):
        out, excluded = 0.0, set()
        for k in range(order, -1, -1):
            own = {s: n for s, n in trie.get(data[i - k : i], {}).items() if s not in excluded}
            total = sum(own.values())
            if data[i] in own:
                return out + math.log10((own[data[i]] - 0.5) / total)
            if total:
                out += math.log10(len(own) / (2 * total))
            excluded |= set(own)
        return out - math.log10(256 - len(excluded))

    return [sum(symbol(d, i) for i in range(order, len(d))) for d in map(code, texts)]


def test_ppm_predicts_across_words(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    words = ["the", "There", "then", "a", "an", "\u00e9t\u00e9", "other", "he", "\ta\n"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["the other then a there", "there a then other the", None, "", " x ", "unseen zq", "a", "  two  spaces  "]
    held = [i % 3 == 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    expected = ppm_by_hand([t for t, h in zip(texts, held, strict=True) if not h], texts)
    for scale, most, piece in ((25_000, 12 << 20, 2 << 20), (10, 300, 50)):
        monkeypatch.setattr(ppm, "BUCKET_SCALE", scale)
        monkeypatch.setattr(ppm, "BLOCK_BYTES", most)
        monkeypatch.setattr(ppm, "PIECE", piece)
        monkeypatch.setattr(ppm, "STRIDE", piece)
        rows = sorted(ppm.score_documents(docs, F.col("doc_id") % 3 == 2).collect())
        assert [r.score for r in rows] == pytest.approx(expected, abs=1e-9)
        assert [r.n_tokens for r in rows] == [len((t or "").split()) + 1 for t in texts]
        train = {w for t, h in zip(texts, held, strict=True) if not h for w in (t or "").lower().split()}
        assert [r.n_known for r in rows] == [1 + sum(w in train for w in (t or "").lower().split()) for t in texts]
    assert rows[60].score != rows[61].score  # the same words in another order
    alone = ppm.score_documents(docs.filter("doc_id = 65"), F.lit(True)).first()
    assert alone.score == pytest.approx(-11 * math.log10(256))


def test_licenses(spark, docs, nothing):
    templates = spark.createDataFrame(licenses.TEMPLATES, "license string, body string")
    text = LONG + "\nReleased under the MIT  License! " + LONG
    own = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(50, text)], "doc_id bigint, text string"))
    found = licenses.scan(own, templates).collect()
    assert [(r.doc_id, r.license, r.containment) for r in found] == [(50, "MIT", 1.0)]
    assert licenses.scan(nothing, templates).count() == 0


def test_sql_of_quality_matches(spark, docs):
    own = docs.select("doc_id", "text").filter("doc_id < 9")
    with duckdb.connect() as con:
        con.register("documents", own.toPandas())
        expected = sorted(con.execute(quality.ORACLE_SQL).fetchall())
    found = quality.judge(own).select("doc_id", *quality.MEASURES, "base_failed", "kept").collect()
    assert sorted(map(tuple, found)) == expected
    assert re.fullmatch(r"[^;]+", quality.compiled(quality.RULES))


def test_ppm_sends_texts_and_code_lengths_small_and_whole():
    rng = np.random.default_rng(4)
    lengths = np.log10((rng.integers(1, 400, 6_000) - 0.5) / rng.integers(400, 9_000, 6_000))
    sent = ppm._listed(lengths)
    assert np.array_equal(ppm._unlisted(sent, np.float64).view(np.int64), lengths.view(np.int64))
    assert len(sent) < len(ppm._packed(np.unique(lengths))) + 2 * len(lengths)
    counts = np.array([7, 0, 2**62, 7, 1], np.int64)
    assert np.array_equal(ppm._unlisted(ppm._listed(counts), np.int64), counts)
    words = [f"word{x:x}".encode() for x in (rng.zipf(1.3, 60_000) % 3_000).tolist()]
    stream = np.frombuffer(b" ".join(words), np.uint8)
    packed = ppm._text_packed(stream)
    assert pa.decompress(packed, len(stream), "zstd", asbytes=True) == stream.tobytes()
    assert len(packed) < 0.97 * len(pa.compress(stream.tobytes(), "zstd", asbytes=True))
