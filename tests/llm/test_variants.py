"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from wickflow.llm import variants

SCHEMA = "doc_id bigint, text string, word string, n int"


def brute_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def brute(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def edited(rng, word):
    at = rng.randrange(len(word) + 1)
    return word[:at] + rng.choice(["", "q", "é", "z"]) + word[at + rng.choice([0, 1]) :]


def corpus():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(7, 10))) for _ in range(60)]
    base += ["aaaaaaaa", "aaaaaaaaa", "x" * 300, "x" * 301, "x" * 299 + "y", "ÀÿßÖöü÷×"]
    rows = [(None, "Zyzzyva zyzzyva zyzzyvas"), (1, None), (2, ""), (3, "abc 123456789 short")]
    for i in range(4, 60):
        words = []
        for _ in range(80):
            word = base[min(int(rng.expovariate(0.1)), len(base) - 1)]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2, 3])):
                word = edited(rng, word)
            words.append(rng.choice([word, word.capitalize(), word.upper()]))
        rows.append((i, rng.choice([" ", "-", "1"]).join(words)))
    rows += [(i, "chainword " * 12) for i in range(100, 160)] + [(i, "chainwords") for i in range(200, 250)]
    rows += [(i, "chainwordss") for i in range(300, 304)]
    return [*rows, rows[40], (7, rows[20][1])]


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], SCHEMA)
    words = variants.word_counts(docs).filter("n >= 2")
    return sorted(tuple(r) for r in variants.spelling_variants(words).collect())


@pytest.mark.parametrize("group", [8_192, 5])
def test_variants_agree_with_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(variants, "GROUP", group)
    rows = corpus()
    expected = brute(brute_counts(rows))
    assert any(r[1] and r[1] != r[2] for r in expected)
    assert found(spark, rows) == expected


def test_every_word_against_every_word():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(200)})
    index = variants.PositionIndex(words)
    a, b = index.near(variants.np.arange(len(words)))
    pairs = {(words[x], words[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    assert pairs == {(v, w) for v in words for w in words if one_edit(v, w)}


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "one two"), (3, "singleword")]) == []
