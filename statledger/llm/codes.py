"""Product codes of vectors, every part's nearest codebook entry found by Orchard search.

Method. Components become integers, vectors are cut into ``PARTS`` equal parts. Each part position has a codebook, begun with the parts of the
first vectors and moved ``ROUNDS`` times to the means of the parts nearest to its entries. A nearest entry is looked for as follows: every entry keeps
a list of all entries sorted by distance from it; a search starts at the best of ``STARTS`` spread entries, walks the list of the entry it stands at,
jumps to the list of each better one, marks what it has visited, and stops where the list is beyond twice its present distance: an entry that far
from the present one can't be nearer. Ties go to the lower index, so the walk stops only strictly beyond. All arithmetic is on whole numbers.

Defined results. Rows whose vector is null or holds null or non-finite components are dropped. Every other row gives one row, zero and empty
vectors, repeated ids and rows and null ids too. Vectors shorter than the longest one, whose length is rounded up to a multiple of ``PARTS``, are filled up
with zeros. Where ids repeat, entries begin with the smaller vector; null ids come last. With fewer rows than ``ENTRIES`` the codebooks
are that small; without rows the result is empty. Components are held within the largest size at which squared distances fit 64 bits (for 64 dimensions
about 131,000 in absolute value). A label_error beyond 64 bits is null. Other columns are not looked at.

At scale. The vectors are read once for each round, and only sums and counts of entries (``PARTS`` x ``ENTRIES`` rows a task) are shuffled; the codebooks
are all that reaches the driver. Codes are written once; errors are summed by label before the shuffle. Labels with the most rows,
``HEAVY`` at most, are joined back by broadcast, the others by their key, so a label that holds a third of all rows stays where its rows are.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import folder, stored

PARTS, ENTRIES, ROUNDS, UNITS = 4, 256, 4, 1024
STARTS, STEP, HEAVY = 8, 16, 1000
QUERIES = 4096  # parts that are searched together


def whole_numbers(vectors: pa.ListArray, width: int, bound: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``width`` components."""
    lengths = np.diff(vectors.offsets.to_numpy())
    with np.errstate(over="ignore"):
        flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * UNITS)
    flat = np.clip(flat, -bound, bound).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def largest(width: int) -> int:
    """The largest component at which four times a part's squared distance fits a signed 64-bit number."""
    return math.isqrt((1 << 58) // max(1, width // PARTS))


class Orchard:
    """Exact search among the entries of one codebook (entries x components)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        far = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        #: For every entry all entries from the nearest to the farthest, ties by index, and their squared distances.
        self.lists = np.argsort(far, axis=1, kind="stable")
        self.far = np.take_along_axis(far, self.lists, 1)
        self.starts = self._spread(far)

    @staticmethod
    def _spread(far: np.ndarray) -> list[int]:
        """A few entries, each the one farthest from those before it."""
        chosen = [0]
        least = far[0].copy()
        while len(chosen) < min(STARTS, len(far)):
            chosen.append(int(least.argmax()))
            least = np.minimum(least, far[chosen[-1]])
        return chosen

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row and its squared distance."""
        found = [self._search(parts[i : i + QUERIES]) for i in range(0, len(parts), QUERIES)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(parts), len(self.entries)
        visited = np.zeros((n, size), bool)
        best, least = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        for entry in self.starts:
            visited[:, entry] = True
            distance = ((parts - self.entries[entry]) ** 2).sum(1)
            better = (distance < least) | (distance == least) & (entry < best)
            best[better], least[better] = entry, distance[better]
        place, active = np.zeros(n, np.int64), np.arange(n)
        while len(active):
            # the next stretch of the list of the entry that each search stands at
            at, span = best[active], place[active][:, None] + np.arange(STEP)
            inside = span < size
            span = np.minimum(span, size - 1)
            near = inside & (self.far[at[:, None], span] <= 4 * least[active][:, None])
            entry = self.lists[at[:, None], span]
            ask = near & ~visited[active[:, None], entry]
            query, column = np.nonzero(ask)
            asked = entry[query, column]
            visited[active[query], asked] = True
            distance = np.full(entry.shape, np.iinfo(np.int64).max)
            distance[query, column] = ((parts[active[query]] - self.entries[asked]) ** 2).sum(1)
            shortest = distance.min(1)
            winner = np.where(distance == shortest[:, None], entry, size).min(1)
            jump = ask.any(1) & ((shortest < least[active]) | (shortest == least[active]) & (winner < at))
            best[active[jump]], least[active[jump]] = winner[jump], shortest[jump]
            place[active] = np.where(jump, 0, place[active] + STEP)
            # a list ends where it is beyond twice the present distance, or with its last entry
            active = active[jump | near[:, -1] & (place[active] < size)]
        return best, least


def _summing(books, width: int):
    """Sums and counts of the parts nearest to each entry, one row for each used entry of a task."""

    def run(batches):
        searches = [Orchard(b) for b in books.value]
        bound, piece = largest(width), width // PARTS
        total = {}
        for batch in batches:
            rows = whole_numbers(batch.column(0), width, bound)
            for p, search in enumerate(searches):
                parts = rows[:, p * piece : (p + 1) * piece]
                if not len(parts):
                    continue
                code, _ = search.nearest(parts)
                order = np.argsort(code, kind="stable")
                used, start, count = np.unique(code[order], return_index=True, return_counts=True)
                # a batch's sums fit 64 bits; a task's are Python's whole numbers
                for e, sums, n in zip(used.tolist(), np.add.reduceat(parts[order], start, axis=0).tolist(), count.tolist(), strict=True):
                    old = total.get((p, e))
                    total[p, e] = ([a + b for a, b in zip(old[0], sums, strict=True)], old[1] + n) if old else (sums, n)
        rows = [(p, e, i, s, n) for (p, e), (sums, n) in total.items() for i, s in enumerate(sums)]
        names = ("part", "entry", "place", "total", "n")
        types = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))

    return run


def _coding(books, width: int):
    def run(batches):
        searches = [Orchard(b) for b in books.value]
        bound, piece = largest(width), width // PARTS
        for batch in batches:
            rows = whole_numbers(batch.column(1), width, bound)
            found = [s.nearest(rows[:, p * piece : (p + 1) * piece]) for p, s in enumerate(searches)] if len(rows) else []
            codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8) if found else np.zeros((0, PARTS), np.uint8)
            error = np.sum([f[1] for f in found], axis=0, dtype=np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding (array of double) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(e.isNotNull() & ~F.coalesce(F.exists(e, odd), F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", e.alias("embedding"))


def codebooks(kept: DataFrame, width: int) -> list[np.ndarray]:
    """The codebook of each part position (entries x components) after all rounds."""
    spark, piece = kept.sparkSession, width // PARTS
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    begun = whole_numbers(pa.array([r[0] for r in first], pa.list_(pa.float64())), width, largest(width))
    books = [begun[:, p * piece : (p + 1) * piece].copy() for p in range(PARTS)]
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(books)
        sums = kept.select("embedding").mapInArrow(_summing(sent, width), "part int, entry int, place int, total decimal(38,0), n long")
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
        sent.destroy()
    return books


def digest(books: list[np.ndarray]) -> str:
    """Lowercase hex SHA-256 of all components by part, entry and place, as decimal numbers between commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row that takes part."""
    spark, kept = vectors.sparkSession, usable(vectors)
    kind = kept.schema["label"].dataType.simpleString()
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = PARTS * max(1, -(-longest // PARTS))
    books = codebooks(kept, width)
    coded = stored(kept.select("vec_id", "embedding", "label").mapInArrow(
        _coding(spark.sparkContext.broadcast(books), width), f"vec_id long, label {kind}, code binary, error long"), "codes", folder(spark))
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n"))
    by_label = stored(by_label.select(F.struct("label").alias("key"), F.col("sum").try_cast("long").alias("label_error"), "n"), "labels")
    heavy = by_label.orderBy(F.desc("n"), "key").limit(HEAVY)
    rows = coded.withColumn("key", F.struct("label")).join(
        F.broadcast(heavy.select("key", F.col("label_error").alias("heavy_error"), F.lit(True).alias("is_heavy"))), "key", "left")
    out = ("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
    light = rows.where("is_heavy is null").drop("heavy_error").join(by_label.drop("n"), "key")
    return rows.where("is_heavy").withColumnRenamed("heavy_error", "label_error").select(*out).unionByName(light.select(*out))
