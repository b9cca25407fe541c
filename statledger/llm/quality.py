"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax, SGD in numpy.

Method. Features of a text are its words (runs without ASCII white space, case kept), its pairs of neighbouring words and
its UTF-8 byte n-grams of ``GRAMS``, hashed into ``BUCKETS`` vectors for each kind. A pair is hashed by the difference of its words' hashes,
so all pairs of equal words share a vector. A document is the mean of its features' vectors; a softmax layer gives the
class. Vectors and layer are learned together by stochastic gradient descent over a bounded sample of labelled
documents. For scoring, vectors and layer are multiplied out to one number a bucket, which gives the same scores.

Sample. At most ``LEARN_ROWS`` labelled documents, those with the smallest hash of doc_id, with their whole texts; a document is taken
while the texts before it hold less than ``LEARN_BYTES`` bytes. Both bound the single training task (features take some 20 bytes for
each byte of text). Every document is scored, whole, whatever its length. An empty table gives no rows.

Defined results. Labels other than 0 and 1, null ids and labels without a document teach nothing; of contradicting
labels of a doc_id the smaller counts; of repeated doc_ids each row is scored, and one text teaches. Empty and null texts get the score of the bias
alone. With no labels the score is 0.5; with one class only, the smoothed share of that class. A null doc_id is not held out.
Extra columns, of either table, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import small_batches, tidied
from .words import hashes, mix, slices

LEARN_BYTES = 32 << 20
LEARN_ROWS, SIZE, EPOCHS, RATE, CUT = 3000, 8, 12, 8.0, 0.7
BITS = 16
BUCKETS, GRAMS = 1 << BITS, (3, 4)
KINDS = 2 + len(GRAMS)
_MODEL = "weights binary, bias double"


def _gram_buckets(raw: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that begins at each byte, for each n."""
    b = raw.astype(np.uint32)
    out = []
    for k, n in enumerate(GRAMS):
        size = max(len(b) - n + 1, 0)
        value = np.full(size, n, np.uint32) * np.uint32(0x9E3779B1)
        for j in range(n):
            value ^= b[j : j + size] << np.uint32(8 * j)
            value *= np.uint32(0x85EBCA6B)
            value ^= value >> np.uint32(15)
        out.append((value >> np.uint32(32 - BITS)) + np.uint32((k + 2) * BUCKETS))
    return out


def _features(column: pa.Array):
    """Bucket numbers and their row bounds for words, pairs and each n, slice by slice."""
    for row, raw, offsets in slices(column):
        words, first = hashes(raw, offsets, fold=False)
        top = np.uint64(64 - BITS)
        pairs = mix(words[1:] - words[:-1])
        last = np.minimum(first[:-1], len(pairs))
        parts = [((words >> top).astype(np.uint32), first[:-1], first[1:]),
                 ((pairs >> top).astype(np.uint32) + np.uint32(BUCKETS), last, np.clip(first[1:] - 1, last, len(pairs)))]
        for n, buckets in zip(GRAMS, _gram_buckets(raw), strict=True):
            start = np.minimum(offsets[:-1], len(buckets))
            parts.append((buckets, start, np.clip(offsets[1:] - n + 1, start, len(buckets))))
        yield row, parts


def _bags(batches):
    """label, distinct buckets and their shares of each document."""
    for batch in batches:
        labels, found = batch.column(0), []
        for _, parts in _features(batch.column(1)):
            for i in range(len(parts[0][1])):
                every = np.concatenate([b[x[i] : y[i]] for b, x, y in parts])
                buckets, counts = np.unique(every, return_counts=True)
                found.append((buckets.astype("<u4").tobytes(), (counts / max(len(every), 1)).astype("<f4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [labels, pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())],
            names=["label", "buckets", "shares"])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> tuple[np.ndarray, float]:
    """One number a bucket and a bias: the difference of both classes' logits is their weighted sum."""
    total = KINDS * BUCKETS
    ones = sum(y for y, _, _ in bags)
    if ones in (0, len(bags)):
        return np.zeros(total, np.float32), float(np.log((ones + 1) / (len(bags) - ones + 1)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.5, 0.5, (total, SIZE)).astype(np.float32)
    layer, bias = rng.uniform(-0.5, 0.5, (SIZE, 2)).astype(np.float32), np.log(
        np.array([len(bags) - ones, ones], np.float32) / len(bags))
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            y, buckets, shares = bags[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            own = vectors[buckets]
            mean = shares @ own
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= rate * np.float32(0.02) * np.outer(mean, p)
            bias -= rate * np.float32(0.02) * p
            norm = np.float32(1) / max(np.sqrt(shares @ shares), np.float32(1e-3))
            vectors[buckets] = own - rate * np.outer(shares * norm, back)
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return weights.astype(np.float32), float(bias[1] - bias[0])


def _trained(bags: pa.Table) -> pa.Table:
    rows = [(r["label"], np.frombuffer(r["buckets"], "<u4"), np.frombuffer(r["shares"], "<f4"))
            for r in sorted(bags.to_pylist(), key=lambda r: (r["label"], r["buckets"]))]
    weights, bias = train(rows)
    return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": [bias]})


def _scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    scores = np.empty(len(column))
    for row, parts in _features(column):
        n = len(parts[0][1])
        total, count = np.zeros(n), np.zeros(n)
        for buckets, start, stop in parts:
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(weights[buckets], dtype=np.float64, out=sums[1:])
            total += sums[stop] - sums[start]
            count += stop - start
        scores[row : row + n] = 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -500, 500)))
    return scores


def _scoring(model):
    def run(batches):
        weights = np.frombuffer(model.value[0], np.float32)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(1), weights, model.value[1]))], names=["doc_id", "score"])

    return tidied(run)


def _keeping(model, place: int, cut: float):
    """The rows that reach the cut."""

    def run(batches):
        weights = np.frombuffer(model.value[0], np.float32)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(place), weights, model.value[1]) >= cut))

    return tidied(run)


def held_out(doc_id="doc_id"):
    """True for documents that never teach."""
    return F.coalesce(F.expr(f"crc32(CAST(CAST({doc_id} AS STRING) AS BINARY)) % 4 = 2"), F.lit(False))


def within_bytes(taught: DataFrame, most: int) -> DataFrame:
    """doc_id of the documents before which, in order of hash, lie less than ``most`` bytes of text; at most LEARN_ROWS rows come in."""
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = taught.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    return sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("before") < most).select("doc_id")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[bytes, float]:
    """Weights a bucket and bias, learned in one task from the bounded sample."""
    small_batches(docs.sparkSession)
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    sample = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LEARN_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most LEARN_ROWS pairs of numbers are sent to the executors
    taught = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    taught = taught.join(F.broadcast(within_bytes(taught, LEARN_BYTES)), "doc_id", "left_semi")
    bags = taught.select("label", "text").mapInArrow(_bags, "label int, buckets binary, shares binary")
    model = bags.groupBy(F.lit("all")).applyInArrow(_trained, _MODEL).toArrow().to_pylist()
    return (model[0]["weights"], model[0]["bias"]) if model else (np.zeros(KINDS * BUCKETS, np.float32).tobytes(), 0.0)


def score(docs: DataFrame, model: tuple[bytes, float]) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scoring(sent), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return docs.mapInArrow(_keeping(sent, docs.columns.index("text"), cut), docs.schema)
