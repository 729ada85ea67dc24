"""Operators against plain versions of themselves, and edge cases through the pipeline."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa

import corpus_pipeline
from wickflow.llm import decontaminate, toxicity, warc
from wickflow.llm.texts import Texts


def plain_ftrl(rows):
    """FTRL-proximal, one coordinate at a time; rows of (features, label)."""
    z, n = {}, {}

    def weight(f):
        zf, l1 = z.get(f, 0.0), 0.0 if f == toxicity.BIAS else toxicity.L1
        if abs(zf) <= l1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA + toxicity.L2
        return -math.copysign(abs(zf) - l1, zf) / rate

    for _ in range(toxicity.EPOCHS):
        for features, label in rows:
            own = {f: weight(f) for f in [toxicity.BIAS, *features]}
            g = 1 / (1 + math.exp(-sum(own.values()))) - label
            for f, w in own.items():
                sigma = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA
                z[f] = z.get(f, 0.0) + g - sigma * w
                n[f] = n.get(f, 0.0) + g * g
    return {f: weight(f) for f in z if weight(f)}


def toxic_rows(rng, n):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(n):
        label = rng.random() < 0.4
        own = rng.choices(words[:40] if not label else words[25:], k=rng.randint(0, 30))
        rows.append((" ".join(own), int(label)))
    return rows


def test_ftrl_agrees_with_a_plain_loop():
    rows = toxic_rows(random.Random(1), 300)
    table = pa.table({
        "turn": list(range(len(rows))),
        "label": [label for _, label in rows],
        "features": [np.unique(toxicity.features(Texts(pa.array([t])))[1]).astype(np.uint32).tobytes() for t, _ in rows],
    })
    fitted = toxicity._fit(table)
    found = dict(zip(fitted.column("feature").to_pylist(), fitted.column("weight").to_pylist()))
    plain = plain_ftrl([(np.unique(toxicity.features(Texts(pa.array([t])))[1]).tolist(), label) for t, label in rows])
    assert found.keys() == plain.keys() and len(plain) > 5
    assert all(math.isclose(found[f], plain[f], rel_tol=1e-9) for f in plain)


def test_repeated_and_null_ids_do_not_change_the_model(spark):
    rng = random.Random(2)
    rows = [(i, t) for i, (t, _) in enumerate(toxic_rows(rng, 60))]
    rows += [(5, "another text of five"), (5, "and one more"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (7, None)], "doc_id bigint, toxic int")
    first = toxicity.learn(docs, labels)
    again = toxicity.learn(docs.repartition(7), labels)
    assert all(np.array_equal(a, b) for a, b in zip(first, again))
    held = toxicity.score_documents(docs, first).select(toxicity.fold("row.doc_id", 3).alias("f")).collect()
    assert all(r.f is not None for r in held)


def test_archives_agree_with_brute_force(spark, tmp_path):
    rng = random.Random(3)
    shared = ["x" * 999, "y" * 1_000, "é" * 500, "z" * 5_000, "", None]
    rows = [(i, f"http://h{i % 4}.org/{rng.randint(0, 9)}", rng.choice([*shared, f"page {i} " * rng.randint(0, 200)])) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archives(pages.repartition(5), f"{tmp_path}/warc")
    found = sorted((r.id, r.bytes, r.digest, r.type, r.refers_to) for r in warc.read_archives(spark, f"{tmp_path}/warc").collect())
    payloads = {i: (h or "").encode() for i, _, h in rows}
    last = {}
    for i, data in sorted(payloads.items()):
        last[data] = i
    expected = []
    for i, data in payloads.items():
        revisit = len(data) >= 1_000 and last[data] != i
        expected.append((i, len(data), hashlib.sha1(data).hexdigest(), *(("revisit", last[data]) if revisit else ("response", None))))
    assert found == sorted(expected)
    assert sum(r[3] == "revisit" for r in found) > 20


def test_decontamination_agrees_with_its_sql(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, prose(rng.choice([0, 1, 4, 9, 10, 11, 25]))) for i in range(12)] + [(3, prose(14)), (None, prose(12)), (20, None)]
    rows = []
    for i in range(80):
        own = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            item = rng.choice(items)[1] or ""
            own += [item.upper() if rng.random() < 0.2 else item, prose(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "-"]).join(own)))
    rows += [rows[3], (None, items[4][1]), (90, None), (91, "")]
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 400)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted(map(str, (tuple(r) for r in decontaminate.digests(docs, benchmark).collect())))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    assert found == sorted(map(str, con.sql(decontaminate.ORACLE_SQL).fetchall()))


def test_every_stage_takes_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, and an empty table."""
    long = " ".join(f"word{i % 900}" for i in range(20_000))
    good = " ".join(["the quick brown fox and", "a lazy dog is in the garden of", "my uncle who was there"] * 3)
    odd = [(1, None, None, None, None), (None, good, "en", "a", 1), (2, "", "en", None, 0), (3, long, None, "b", 1)]
    odd += [(4, good + " indeed", "en", "a", 1)] * 2 + [(None, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    labels = spark.createDataFrame([(1, 1, 0), (None, None, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([(1, None), (None, ""), (2, "not there at all")], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, docs, str(tmp_path))
            assert k == 4 or found.schema.simpleString() == docs.schema.simpleString()
            assert set(map(str, found.collect())) <= set(map(str, docs.collect())) or k == 4
            alone = found.collect()
            if k < 4:  # each stage also on what the others drop
                docs = docs if len(alone) < 2 else spark.createDataFrame(alone, schema)
