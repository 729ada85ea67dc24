"""Strings that occur twice, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from wickflow.llm import repeats
from wickflow.llm.suffixgroups import suffix_array

SCHEMA = "doc_id bigint, text string, key string, spans int"


def test_suffix_arrays_agree_with_sorting():
    rng = random.Random(5)
    for _ in range(2_000):
        symbols = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 25))] + [0]
        expected = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert suffix_array(np.array(symbols)).tolist() == expected


def brute(rows, window=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for text in texts:
        for at in range(len(text) - window + 1):
            own = text[at : at + window]
            seen[own] = seen.get(own, 0) + 1
    found = []
    for (i, _), text in zip(rows, texts, strict=True):
        gone = bytearray(len(text))
        for at in range(len(text) - window + 1):
            if seen[text[at : at + window]] > 1:
                gone[at : at + window] = b"\1" * window
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        found.append((i, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(70), prose(30)
    texts = [None, "", "short", "a" * 199, "b" * 200, "c" * 201, "c" * 199 + "d", "xy" * 150, "é" * 120]
    texts += [prose(100) for _ in range(6)]
    texts += [prose(rng.randint(0, 40)) + passage + prose(rng.randint(0, 40)) for _ in range(25)]
    texts += [prose(20) + passage[: rng.randint(150, 260)] + prose(20) for _ in range(10)]
    near = prose(200)
    for _ in range(20):
        at = rng.randrange(len(near))
        texts.append(near[:at] + rng.choice(["", "#", "##"]) + near[at + 1 :])
    texts += [near, near, line + passage + line, (line + " ") * 4]
    long = prose(3_000)
    texts += [long + passage, "tail " + long[500:9_000]]
    rows = list(enumerate(texts))
    return [*rows, (None, texts[-1]), (None, "null id"), (3, texts[30]), (3, texts[30]), (4, passage)]


def digests(spark, rows):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    found = repeats.find_repeats(docs).select("row.doc_id", "text", "spans", "row.key")
    assert {r.key for r in found.select("key").collect()} <= {"k"}
    out = found.mapInArrow(
        repeats._digested, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("chunk", [4_000, 3])
def test_repeats_agree_with_brute_force(spark, monkeypatch, chunk):
    rows = corpus()
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    assert digests(spark, rows) == brute(rows)


def test_anchors_of_pieces_are_those_of_the_whole(monkeypatch):
    from wickflow.llm.texts import Texts
    import pyarrow as pa

    texts = Texts(pa.array([t for _, t in corpus()]))
    whole = repeats.anchors(texts)
    monkeypatch.setattr(repeats, "PIECE", 700)
    cut = repeats.anchors(texts)
    assert all(np.array_equal(whole[c], cut[c]) for c in whole)


def test_heavy_surroundings_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HEAVY", 30)
    rows = corpus()
    assert digests(spark, rows) == brute(rows)


def test_nothing_to_remove(spark):
    assert digests(spark, []) == []
    assert digests(spark, [(1, None), (2, "a")]) == brute([(1, None), (2, "a")])


def test_texts_are_not_searched_again_for_spans(spark):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in corpus()], SCHEMA)
    plan = repeats.repeated_spans(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # spans are merged; anchors are read as stored
