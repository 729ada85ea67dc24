"""Source divergence: perfect hashes, and the report against brute force and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from wickflow.llm import divergence
from wickflow.llm.texts import span_hashes

SCHEMA = "doc_id bigint, text string, lang string, source string, part string, slot int"


@pytest.mark.parametrize("equal_hashes", [False, True])
def test_perfect_hashes(equal_hashes):
    keys = [f"term{i}".encode() for i in range(3_000)]
    data = np.frombuffer(b"".join(keys), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    hashes = span_hashes(data, bounds[:-1], bounds[1:])
    if equal_hashes:
        hashes[:3] = hashes[0]
    own = divergence.PerfectHash.build(keys, hashes)
    slots = own.slots(hashes, data, bounds)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert [own.keys()[s] for s in slots] == keys
    other = np.frombuffer(b"term3000no" + keys[5] + b"x", np.uint8)
    ends = np.array([0, 8, 10, 10 + len(keys[5]), 11 + len(keys[5])])
    asked = np.array([hashes[7], hashes[8], hashes[5], hashes[9]])  # equal hashes are no proof
    assert own.slots(asked, other, ends).tolist() == [-1, -1, slots[5], -1]


def brute(rows, least, top):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    rows = [tuple(x or "" for x in r[1:4]) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)) for t, _, _ in rows]
    df, groups = Counter(), defaultdict(Counter)
    for (_, lang, source), own in zip(rows, terms, strict=True):
        df.update({(lang, t) for t in own})
        groups[lang, source].update(own)
    kept = defaultdict(set)
    for (lang, t), n in df.items():
        if n >= least:
            kept[lang].add(t)

    def share(lang, count):
        total = sum(count[t] for t in kept[lang])
        bottom = total + 5 * len(kept[lang])
        return {t: 1 + 10**9 * (count[t] + 5) // bottom for t in kept[lang]}

    out = []
    for (lang, source), count in groups.items():
        p = share(lang, count)
        q = share(lang, sum((c for (own, _), c in groups.items() if own == lang), Counter()))
        pairs = []
        for (own, other), c in groups.items():
            if own == lang and other != source:
                r = share(lang, c)
                pairs.append((-sum(abs(p[t] - r[t]) for t in p), other.encode()))
        above = sorted((q[t] - p[t], t.encode()) for t in p if count[t] and p[t] > q[t])[:top]
        for part, own in (("pair", sorted(pairs)), ("term", above)):
            out += [(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(own)]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = [f"{'abcdefghé'[i % 9]}w{'xyz'[i % 3] * (i % 7)}" for i in range(80)] + ["Ünder", "naïve", "中文", "😀x", "The", "the"]
    rows = [(i, None, None, None, "p", 1) for i in range(3)] + [(3, "", "en", "a", "p", 1), (4, "1 2 3", "xx", "", "p", 1)]
    for i in range(5, 300):
        own = rng.choices(words[: rng.choice([20, len(words)])], k=rng.randint(0, 60))
        source = rng.choice(["a", "a", "a", "b", "c", "é", None])
        rows.append((i, rng.choice([" ", "7", "\n", "_"]).join(own), rng.choice(["en", "en", "de", None]), source, "p", 1))
    rows += [(300, "the " * 40_000, "en", "b", "p", 1), rows[50], rows[50], (None, "the end", "de", "z", "p", 1)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_divergence_agrees_with_brute_force(spark, monkeypatch, small):
    if small:  # several shards, rounds and blocks, and dense slots handed on early
        monkeypatch.setattr(divergence, "SHARD_TERMS", 7)
        monkeypatch.setattr(divergence, "MATRIX", 60)
        monkeypatch.setattr(divergence, "ROUND_BYTES", 500)
    docs = spark.createDataFrame(corpus(), SCHEMA)
    found = sorted(tuple(r) for r in divergence.divergence(docs, least=5, top=7).collect())
    assert found == brute(corpus(), 5, 7)


def test_slots_are_handed_on(spark, monkeypatch):
    kept = ["abc", "def"]
    data = np.frombuffer(b"abcdef", np.uint8)
    bounds = np.array([0, 3, 6])
    row = divergence.PerfectHash.build([k.encode() for k in kept], span_hashes(data, bounds[:-1], bounds[1:])).packed()
    monkeypatch.setattr(divergence, "DENSE_BYTES", 8)
    import pyarrow as pa
    from types import SimpleNamespace

    shard = SimpleNamespace(lang="en", part=0, **row)
    shared = SimpleNamespace(value=[shard])
    batch = pa.RecordBatch.from_pydict({"text": ["abc def ABC x", "abc"], "lang": ["en", "en"], "source": ["a", "b"]})
    out = pa.Table.from_batches(divergence._recounted(shared, 1)(iter([batch, batch])))
    assert out.num_rows == 6 and sum(out.column("n").to_pylist()) == 8


def test_sql_and_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert divergence.divergence(docs).count() == 0
    rows = [r for r in corpus() for _ in range(2)]
    found = sorted(tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, SCHEMA)).collect())
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "part", "slot"])
    con = duckdb.connect()
    con.register("documents", documents)
    assert found == sorted(con.sql(divergence.ORACLE_SQL).fetchall())
