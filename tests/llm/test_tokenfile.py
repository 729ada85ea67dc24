"""Token files: the encoder against its library, and ranges read by the index."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wickflow.llm import tokenfile
from wickflow.llm.texts import Texts

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("cached", [600_000, 40])
def test_encoder_agrees_with_the_library(monkeypatch, cached):
    monkeypatch.setattr(tokenfile, "CACHED", cached)
    monkeypatch.setattr(tokenfile, "TOGETHER", 7)
    rng = random.Random(3)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", ",", "'s", "1", "23", "é", "中", "😀", " ", "\u0085", "<|", "-", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4_000)]
    with open(FILE, "rb") as file:
        encoder = tokenfile.Encoder(file.read())
    library = Tokenizer.from_file(FILE)
    for first in range(0, len(texts), 400):
        own = texts[first : first + 400]
        ids, at = encoder.encode(Texts(pa.array(own)))
        found = [ids[a:b].tolist() for a, b in zip(at, at[1:])]
        assert found == [e.ids for e in library.encode_batch(own, add_special_tokens=False)]


def test_ranges_open_only_their_chunks(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(0, 300)))) for i in range(200)]
    docs = spark.createDataFrame([*rows, (200, None), (None, "null id")], "doc_id bigint, text string")
    path = f"{tmp_path}/tokens"
    monkeypatch.setattr(tokenfile, "CHUNK_IDS", 500)
    tokenfile.write_tokens(docs.repartition(4), path, FILE)
    whole = tokenfile.read_tokens(spark, path).orderBy("start").collect()
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in whole])
    total = len(stream)
    for first, stop in [(0, 1), (700, 2_300), (total - 3, total), (0, total), (5, 5), (total, total + 9), (-4, 2)]:
        found = tokenfile.read_range(spark, path, first, stop).orderBy("start").collect()
        ids = [np.frombuffer(r.ids, "<u4") for r in found]
        assert np.array_equal(np.concatenate([stream[:0], *ids]), stream[max(0, first) : max(0, stop)])
        ends = {r.start + len(r.ids) // 4 for r in whole} | {r.start for r in whole}
        assert all(r.start in ends | {first} for r in found)
    opened = tokenfile.chunks_of_range(spark, path, 700, 2_300)[0]
    sizes = [r.n_ids for r in opened.select("n_ids").collect()]
    assert sum(sizes) - max(sizes) * 2 <= 1_600 and len(sizes) < spark.read.parquet(path).count() / 3
    assert tokenfile.read_range(spark, f"{tmp_path}/tokens", 0, 0).count() == 0
    tokenfile.write_tokens(docs.limit(0), f"{tmp_path}/none", FILE)
    assert tokenfile.read_range(spark, f"{tmp_path}/none", 0, 10).count() == 0
