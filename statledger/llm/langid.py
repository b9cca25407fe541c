"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Method. Each byte's table row feeds the gates of a forward and a backward recurrent layer of ``HIDDEN`` units (update and reset gates as
clipped straight lines, candidate state clipped to [-1, 1]). From both states together a softmax labels every byte with
a language; a document's probabilities are the means over its bytes. Texts are worked on whole, in segments of ``SEGMENT`` bytes that
run side by side; both layers begin anew in each segment. Training is backpropagation through time with Adam steps over
segments whose bytes all carry their document's language.

Sample. Of the documents that can teach, the ``LEARN_ROWS`` with the smallest hash of doc_id, and the ``LEARN_LEAST`` with the smallest
hash of each language, so that a rare language stays however large the table grows. Of each document at most ``LEARN_SEGMENTS`` segments of
``LEARN_BYTES`` bytes, spread evenly over its text. It bounds the single training task. Every document is labelled, whole, in
segments of ``SEGMENT`` bytes; a text of any length is worked on in batches of them. An empty table gives no rows.

Defined results. A null text, or one without a letter, is ``und`` with score 0. Documents with a null lang, id or text and texts without a letter teach nothing. With no
language to learn all are ``und``. Ties go to the language first by name. Repeated rows are labelled each. Documents with a null id
are not held out. Other columns are not looked at.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import small_batches
from .words import slices

LEARN_ROWS, LEARN_LEAST, LEARN_SEGMENTS, LEARN_BYTES = 3000, 50, 3, 48
PARTS = 32
HIDDEN, SEGMENT, EPOCHS, BATCH, RATE = 8, 128, 5, 256, 0.02
WIDE = 2048  # segments that run side by side
_f = np.float32


def start_weights(languages: int, rng, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Small random weights of both directions: byte tables of gates and candidate, recurrent weights, an output layer."""
    w, scale = {}, 0.5 / np.sqrt(hidden)
    for d in ("forward", "backward"):
        w[f"{d}.gate_table"] = rng.normal(0.5, 0.2, (2 * hidden, 257))
        w[f"{d}.state_table"] = rng.normal(0, 0.5, (hidden, 257))
        w[f"{d}.gates"] = rng.normal(0, scale / 2, (2 * hidden, hidden))
        w[f"{d}.state"] = rng.normal(0, scale, (hidden, hidden))
        w[f"{d}.out"] = rng.normal(0, scale, (languages, hidden))
    w["bias"] = np.zeros((languages, 1))
    return {k: v.astype(_f) for k, v in w.items()}


def _states(w: dict, d: str, codes: np.ndarray, kept: list | None = None) -> np.ndarray:
    """States after each step, (steps, hidden, segments). Code 256 pads: there the state stays zero."""
    gates, state = w[f"{d}.gates"], w[f"{d}.state"]
    steps, n = codes.shape
    hidden = len(state)
    kind = state.dtype
    h, out = np.zeros((hidden, n), kind), np.empty((steps, hidden, n), kind)
    g, c = np.empty((2 * hidden, n), kind), np.empty((hidden, n), kind)
    for t in range(steps) if d == "forward" else range(steps - 1, -1, -1):
        np.matmul(gates, h, out=g)
        g += w[f"{d}.gate_table"].take(codes[t], 1)
        if kept is not None:
            kept.append([t, h, g.copy()])
        np.clip(g, 0, 1, out=g)
        update, reset = g[:hidden], g[hidden:]
        np.matmul(state, h * reset, out=c)
        c += w[f"{d}.state_table"].take(codes[t], 1)
        if kept is not None:
            kept[-1].append(c.copy())
        np.clip(c, -1, 1, out=c)
        new = out[t]
        np.subtract(c, h, out=new)
        new *= update
        new += h
        if codes[t].max() == 256:
            new[:, codes[t] == 256] = 0
        h = new
    return out


def probabilities(w: dict, codes: np.ndarray, states: dict | None = None) -> np.ndarray:
    """Language probabilities of every byte, (steps, languages, segments)."""
    states = states or {d: _states(w, d, codes) for d in ("forward", "backward")}
    z = np.matmul(w["forward.out"], states["forward"])
    z += np.matmul(w["backward.out"], states["backward"])
    z += w["bias"]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def gradients(w: dict, codes: np.ndarray, language: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the mean cross-entropy of all bytes, and that mean, by backpropagation through time."""
    n = codes.shape[1]
    solid = codes < 256
    kept: dict[str, list] = {"forward": [], "backward": []}
    states = {d: _states(w, d, codes, kept[d]) for d in kept}
    p = probabilities(w, codes, states)
    count = max(int(solid.sum()), 1)
    loss = float(-(np.log(np.maximum(p[:, language, np.arange(n)], 1e-12)) * solid).sum() / count)
    p[:, language, np.arange(n)] -= 1
    p *= (solid[:, None, :] / count).astype(p.dtype)
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["bias"] = p.sum((0, 2))[:, None]
    for d, steps in kept.items():
        gates, state, out = w[f"{d}.gates"], w[f"{d}.state"], w[f"{d}.out"]
        hidden = len(state)
        g[f"{d}.out"] = np.tensordot(p, states[d], ((0, 2), (0, 2)))
        flow = np.zeros((hidden, n), p.dtype)
        for t, before, raw_gate, raw in reversed(steps):
            flow = flow + out.T @ p[t]
            flow[:, codes[t] == 256] = 0
            gate = np.clip(raw_gate, 0, 1)
            update, reset = gate[:hidden], gate[hidden:]
            d_raw = flow * update * (np.abs(raw) < 1)
            back = state.T @ d_raw
            d_gate = np.vstack([flow * (np.clip(raw, -1, 1) - before), back * before]) * ((raw_gate > 0) & (raw_gate < 1))
            g[f"{d}.state"] += d_raw @ (before * reset).T
            g[f"{d}.gates"] += d_gate @ before.T
            np.add.at(g[f"{d}.gate_table"].T, codes[t], d_gate.T)
            np.add.at(g[f"{d}.state_table"].T, codes[t], d_raw.T)
            flow = flow * (1 - update) + back * reset + gates.T @ d_gate
    return g, loss


def train(codes: np.ndarray, language: np.ndarray, languages: int, seed: int = 3, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights learned from segments (rows of ``codes``) and the language number of each."""
    rng = np.random.default_rng(seed)
    w = start_weights(languages, rng)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    total = epochs * -(-len(codes) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for i in range(0, len(codes), BATCH):
            chosen = order[i : i + BATCH]
            g, _ = gradients(w, np.ascontiguousarray(codes[chosen].T), language[chosen])
            step += 1
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v = v / max(size, 1.0)
                first[k] = _f(0.9) * first[k] + _f(0.1) * v
                second[k] = _f(0.98) * second[k] + _f(0.02) * v * v
                move = (first[k] / _f(1 - 0.9**step)) / (np.sqrt(second[k] / _f(1 - 0.98**step)) + _f(1e-6))
                w[k] = w[k] - _f(RATE * (1 - step / (total + 1))) * move
    return w


def _excerpts(batches):
    """Segments of taught documents, padded with 256."""
    for batch in batches:
        langs, cut = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            many = min(LEARN_SEGMENTS, -(-len(raw) // LEARN_BYTES))
            for at in np.linspace(0, max(len(raw) - LEARN_BYTES, 0), many).astype(int):
                codes = np.full(LEARN_BYTES, 256, "<u2")
                piece = raw[at : at + LEARN_BYTES]
                codes[: len(piece)] = piece
                langs.append(lang)
                cut.append(codes.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(cut, pa.binary())], names=["lang", "codes"])


def _trained(rows: pa.Table) -> pa.Table:
    pairs = sorted(zip(rows["lang"].to_pylist(), rows["codes"].to_pylist(), strict=True))
    names = sorted({lang for lang, _ in pairs})
    codes = np.stack([np.frombuffer(c, "<u2") for _, c in pairs]).astype(np.int64)
    w = train(codes, np.array([names.index(lang) for lang, _ in pairs]), len(names))
    out = io.BytesIO()
    np.savez(out, **w)
    return pa.table({"langs": pa.array([names], pa.list_(pa.string())), "weights": pa.array([out.getvalue()], pa.binary())})


def _pooled(w: dict, raw: np.ndarray, offsets: np.ndarray, languages: int) -> np.ndarray:
    """Mean probabilities of the bytes of each row."""
    sizes = np.diff(offsets)
    many = -(-sizes // SEGMENT)
    row = np.repeat(np.arange(len(sizes)), many)
    start = offsets[:-1][row] + SEGMENT * (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
    length = np.minimum(offsets[1:][row] - start, SEGMENT)
    sums = np.zeros((len(sizes), languages))
    padded = np.concatenate([raw, np.zeros(SEGMENT, np.uint8)]).astype(np.int16)
    by_length = np.argsort(-length, kind="stable")  # segments of like length side by side
    for i in range(0, len(row), WIDE):
        chosen = by_length[i : i + WIDE]
        steps = int(length[chosen[0]])
        place = np.arange(steps)[:, None]
        codes = padded[start[chosen][None, :] + place].astype(np.int64)
        short = length[chosen] < steps
        if short.any():
            codes[place >= length[chosen][None, :]] = 256
        p = probabilities(w, codes)
        if short.any():
            p *= (codes < 256)[:, None, :]
        np.add.at(sums, row[chosen], p.sum(0).T)
    return sums / np.maximum(sizes, 1)[:, None]


def _labelling(model):
    def run(batches):
        names, blob = model.value
        w = dict(np.load(io.BytesIO(blob)))
        for batch in batches:
            p = np.zeros((batch.num_rows, len(names)))
            for row, raw, offsets in slices(batch.column(1)):
                p[row : row + len(offsets) - 1] = _pooled(w, raw, offsets, len(names))
            best = p.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([names[i] for i in best], pa.string()), pa.array(p[np.arange(len(best)), best])],
                names=["doc_id", "letter", "lang", "p"])

    return run


def held_out(doc_id="doc_id"):
    """True for documents that never teach."""
    return F.coalesce(F.expr(f"crc32(CAST(CAST({doc_id} AS STRING) AS BINARY)) % 5 = 0"), F.lit(False))


def _has_letter():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def teachers(docs: DataFrame, rows: int | None = None, least: int | None = None) -> DataFrame:
    """doc_id of the documents in the sample: the first ``rows`` by hash, and the first ``least`` of each language."""
    rows, least = LEARN_ROWS if rows is None else rows, LEARN_LEAST if least is None else least
    ids = docs.select("doc_id", "lang").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # only about twice as many ids as wanted, those of the smallest hashes, reach the one task that takes the first of them
    n = docs.agg(F.approx_count_distinct("doc_id")).first()[0]
    low = docs.select("doc_id")
    if n > 2 * rows:
        low = low.where(F.xxhash64("doc_id") < -(2**63) + 2**64 * 2 * rows // n)
    first = low.distinct().orderBy(*order).limit(rows)
    each = ids.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):  # a language's ids are cut in PARTS tasks, so that one task gets PARTS * least of them
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        each = each.withColumn("n", place).where(F.col("n") <= least)
    return first.union(each.select("doc_id")).distinct()


def fit(docs: DataFrame) -> tuple[list[str], bytes] | None:
    """Languages and weights, learned in one task from the bounded sample."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out()).where(_has_letter())
    # at most LEARN_ROWS ids, and LEARN_LEAST a language, are sent to the executors
    taught = docs.join(F.broadcast(teachers(docs)), "doc_id", "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    segments = taught.select("lang", "text").mapInArrow(_excerpts, "lang string, codes binary")
    model = segments.groupBy(F.lit("all")).applyInArrow(_trained, "langs array<string>, weights binary").collect()
    return (list(model[0]["langs"]), bytes(model[0]["weights"])) if model else None


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (columns doc_id, text, lang)."""
    model = fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _has_letter().alias("letter"))
    if model is None:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = rows.mapInArrow(_labelling(sent), "doc_id long, letter boolean, lang string, p double")
    return found.select(
        "doc_id", held_out().alias("held_out"), F.when(F.col("letter"), F.col("lang")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letter"), F.col("p")).otherwise(0.0).alias("score"))
