"""Operator 2: toxicity by FTRL-proximal logistic regression on hashed n-grams.

Features of a text are its distinct lower-cased words (runs of letters, digits and non-ASCII), pairs of neighbours and pairs
with one word between, each hashed to 32 bits. A label and its text are learned from by
FTRL-proximal steps: each coordinate has its own rate, and the L1 term leaves all but a
few thousand weights at exactly zero, so the weights are small enough to broadcast.

Fitting reads at most ``MAX_TRAINING`` labelled rows, those with the smallest hash of
the id (a documented bound; scoring reads everything). They are dealt in slices of about
``SLICE`` rows, each slice is fitted by one task, and the weights are averaged.

Edge cases: a null or empty text has no features and gets the score of the bias alone.
Rows with a null label or id are not learned from, and a null id counts as an empty one
where ids deal rows to folds; of several labels of an id the largest counts, of several
texts of an id the one with the smallest hash is learned from. Without usable labels
every score is 0.5 and nothing is rejected. Repeated rows are scored one by one. Labels
and other columns never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.columns import apart
from wickflow.llm.texts import LOWER, NOT_ALNUM, Texts, blocks, mixed, span_hashes, words
from wickflow.session import scratch_path

MAX_TRAINING = 16_384
SLICE = 4_096
EPOCHS = 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 5.0, 0.01
THRESHOLD = 0.7
BIAS = -1
SIEVE_BITS = 18
BLOCK_BYTES = 1 << 20


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of every word, pair and skip pair, repeats included."""
    starts, ends, first = words(texts, NOT_ALNUM)
    hashes = span_hashes(LOWER[texts.data], starts, ends)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    owners, found = [owner], [hashes]
    for gap, salt in ((1, 0x2545F4914F6CDD1D), (2, 0xD6E8FEB86659FD93)):
        same = np.flatnonzero(owner[:-gap] == owner[gap:]) if len(owner) > gap else np.empty(0, np.int64)
        owners.append(owner[same])
        found.append(mixed(hashes[same] * np.uint64(salt) + hashes[same + gap]))
    return np.concatenate(owners), (np.concatenate(found) >> np.uint64(32)).astype(np.int64)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in blocks(batches, "text", BLOCK_BYTES):
        owner, feature = features(texts)
        pairs = np.unique(owner << 32 | feature)
        own = [row.astype(np.uint32).tobytes() for row in np.split(pairs, np.searchsorted(pairs >> 32, np.arange(1, len(texts))))]
        yield pa.RecordBatch.from_arrays(
            [part.column("slice"), part.column("turn"), part.column("label"), pa.array(own, pa.binary())],
            ["slice", "turn", "label", "features"],
        )


def _fit(table: pa.Table) -> pa.Table:
    """Weights of one slice, by ``EPOCHS`` passes in the order of ``turn``."""
    table = table.sort_by("turn")
    rows = [np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("features").to_pylist()]
    labels = table.column("label").to_pylist()
    known = np.unique(np.concatenate([np.array([BIAS]), *rows]))
    rows = [np.searchsorted(known, np.concatenate([[BIAS], row])) for row in rows]
    z, n = np.zeros(len(known)), np.zeros(len(known))
    l1 = np.full(len(known), L1)
    l1[0] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        over = np.abs(pull) - l1[at]
        return np.where(over > 0, -np.sign(pull) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    w = weights(np.arange(len(known)))
    used = np.flatnonzero(w)
    return pa.table({"feature": pa.array(known[used], pa.int64()), "weight": pa.array(w[used], pa.float64())})


def fit(labelled: DataFrame, text: str, label: str, id_column: str) -> tuple[np.ndarray, np.ndarray]:
    """Features in ascending order and their weights, fitted to at most ``MAX_TRAINING`` rows."""
    path = scratch_path(labelled.sparkSession, "labelled")
    labelled.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")
    ).write.parquet(path)  # so that documents are read once
    rows = labelled.sparkSession.read.parquet(path)
    slices = max(1, -(-rows.count() // SLICE))
    sliced = rows.select(
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(slices)).cast("int").alias("slice"),
        F.xxhash64("id").alias("turn"),
        "label",
        "text",
    )
    fitted = (
        sliced.mapInArrow(_featurise, "slice int, turn bigint, label int, features binary")
        .groupBy("slice")
        .applyInArrow(_fit, "feature bigint, weight double")
        .groupBy("feature")
        .agg((F.sum("weight") / slices).alias("weight"))
        .toPandas()
        .sort_values("feature")
    )
    return fitted["feature"].to_numpy(np.int64), fitted["weight"].to_numpy(np.float64)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, id_column: str, text: str, learn: Column | None
) -> DataFrame:
    """Texts with labels, at most ``MAX_TRAINING`` rows; ``learn`` is a condition on the id."""
    usable = labels.select(F.col(id_column), F.col(label)).dropna()
    if learn is not None:
        usable = usable.filter(learn)
    chosen = (
        usable.groupBy(id_column)
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64(id_column), id_column)
        .limit(MAX_TRAINING)
    )
    own = docs.select(F.col(id_column), F.col(text).alias("text")).join(F.broadcast(chosen), id_column)
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).getField("text")
    return own.groupBy(id_column).agg(F.max("label").alias("label"), first.alias("text"))


def scorer(known: np.ndarray, weights: np.ndarray):
    """A function that gives the scores of a block of texts."""
    bias = float(weights[known == BIAS].sum())
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    mask = (1 << SIEVE_BITS) - 1
    sieve[known[known >= 0] & mask] = True

    def score(texts: Texts) -> np.ndarray:
        owner, feature = features(texts)
        maybe = np.flatnonzero(sieve[feature & mask])
        owner, feature = owner[maybe], feature[maybe]
        at = np.searchsorted(known, feature)
        at[at == len(known)] = 0
        hit = np.flatnonzero(known[at] == feature) if len(known) else np.empty(0, np.int64)
        pairs = np.unique(owner[hit] << 32 | at[hit])
        total = bias + np.bincount(pairs >> 32, weights[pairs & 0xFFFFFFFF], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

    return score


def score_documents(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of the rows (default: all), as the struct ``row``, and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed, row = apart(docs, text, columns)
    back = [c for c in ("rest", "text") if c == "rest" or columns is None or text in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(*shared.value)
        for part, texts in blocks(batches, "text", BLOCK_BYTES):
            scores = pa.array(score(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in back), scores], [*back, "score"])

    kinds = [f"{c} {packed.schema[c].dataType.simpleString()}" for c in back]
    return packed.mapInArrow(run, ", ".join([*kinds, "score double"])).select(row.alias("row"), "score")


def fold(id_column: str, folds: int) -> Column:
    """The remainder that deals a row to a fold; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def learn(docs: DataFrame, labels: DataFrame, held_out: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Weights from the rows outside the held-out fold, or from all labelled rows."""
    condition = fold("doc_id", 3) != 1 if held_out else None
    return fit(labelled_sample(docs, labels, "toxic", "doc_id", "text", condition), "text", "label", "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model, columns=["doc_id"])
    return scored.select(
        "row.doc_id",
        (fold("row.doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


query = op2_toxicity
ORACLE_SQL = None
