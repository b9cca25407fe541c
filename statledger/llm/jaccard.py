"""Exact n-gram Jaccard join of documents by ordered sets, shared prefixes and tries.

Method. A document's set holds the hashes of its distinct word 5-grams. All sets are ordered alike, rare hashes
first; rarity comes from counts of all hashes over all documents in a table of fixed size, so any mistake in it
costs time and never a link. Two sets over the threshold share a hash among the first ``n - ceil(t * n) + 1`` of
each (prefix filter). Links are then looked for in two rounds:

1. every set is compared with the one set that is the smallest holder of most of its shared prefix hashes;
2. all pairs that share a hash early enough in both and that round 1 has not put into one component are compared.

Pairs inside one component need no comparison, because only components are asked for. Sets to be compared with one
centre are put into a trie in their common order; one walk with the centre's set shares the overlaps of equal
beginnings and leaves subtrees whose remaining lengths cannot reach the needed overlap.

Defined results. Null, empty and blank texts have no set: ``n_shingles`` 0, linked with nothing. Rows with one
``doc_id`` are one document to the links. A row without ``doc_id`` takes no part: ``component_id`` null. Texts with
fewer words than the size have one shingle, the whole sequence. Repeated rows all come back. Other columns are
not looked at. Links use 64-bit hashes of words and runs.

At scale. Copies collapse by digest before anything is paired. Hash counts are partial sums of fixed size. A centre
with many partners is split into units of ``UNIT`` sets. No set of documents, links or components reaches the
driver: it gets a table of classes of counts (2 MB) and a bitmap (128 KB) that only spares work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .shared import folder, joined_by_key, small_batches, stored, tidied
from .words import hashes, shingles, slices

WORDS, PERCENT = 5, 80
BUCKETS, PARTS, UNIT = 1 << 20, 16, 512
BITS = 1_048_573
SENT = 500_000  # ids that are sent to all executors at most; more are joined by a shuffle
HOT, STEP = 64, 1.05  # holders beyond which a token's rows are dealt by size; step of the classes of sizes


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row, in row order."""
    for _, raw, offsets in slices(column):
        words, first = hashes(raw, offsets)
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield np.unique(shingles(words[a:b], size))


def _counting(size: int):
    """Partial counts of shingle buckets: one row for each of the table's parts."""

    def run(batches):
        total, held, waiting = np.zeros(BUCKETS, np.int64), [], 0
        for batch in batches:
            for tokens in _sets(batch.column(0), size):
                held.append((tokens & np.uint64(BUCKETS - 1)).astype(np.int32))
                waiting += len(tokens)
                if waiting > 1 << 20:
                    total += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=BUCKETS)
        if total.any():
            blocks = [x.astype(np.int64).tobytes() for x in np.split(total, PARTS)]
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(range(PARTS), pa.int32()), "counts": pa.array(blocks, pa.binary())})

    return tidied(run)


def _summing(batches):
    """Sum the blocks of each part as they stream by."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            block = np.frombuffer(block.as_buffer(), np.int64)
            sums[part] = sums[part] + block if part in sums else block
    for part, block in sums.items():
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "counts": pa.array([block.tobytes()], pa.binary())})


def _classes(batches):
    """The frequency classes of summed parts, a quarter of the counts' bytes."""
    for batch in batches:
        counts = (np.frombuffer(block.as_buffer(), np.int64) for block in batch.column(1))
        classes = [np.minimum(np.log2(c + 1.0) * 1500, 65535).astype(np.uint16).tobytes() for c in counts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.binary())], names=["part", "classes"])


def rarity(docs: DataFrame, size: int) -> np.ndarray:
    """Frequency class of every shingle bucket over all documents (16 bits, finer than one in a thousand)."""
    partial = docs.select("text").mapInArrow(_counting(size), "part int, counts binary")
    for keys in ([F.col("part"), F.spark_partition_id() % 32], [F.col("part")]):
        partial = partial.repartition(PARTS, *keys).mapInArrow(_summing, "part int, counts binary")
    order = np.zeros((PARTS, BUCKETS // PARTS), np.uint16)
    found = partial.mapInArrow(_classes, "part int, classes binary").toArrow()
    for part, classes in zip(found["part"].to_pylist(), found["classes"], strict=True):
        order[part] = np.frombuffer(classes.as_buffer(), np.uint16)
    return order.reshape(-1)


def _ordered(tokens: np.ndarray, order: np.ndarray) -> np.ndarray:
    return tokens[np.argsort(order[tokens & np.uint64(BUCKETS - 1)], kind="stable")]


def _summaries(size: int, percent: int, order):
    """doc_id, set size, digest and ordered prefix of each document."""

    def run(batches):
        for batch in batches:
            sizes, digests, ends, prefixes = [], [], [0], []
            for tokens in _sets(batch.column(1), size):
                n = len(tokens)
                sizes.append(n)
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if n else None)
                if n:
                    prefixes.append(_ordered(tokens, order.value)[: n + (-percent * n // 100) + 1])
                ends.append(ends[-1] + (len(prefixes[-1]) if n else 0))
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "n", "digest", "prefix"])

    return tidied(run)


def _whole_sets(size: int, order, wanted):
    """Ordered sets of the documents whose bit is set."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            place = ids % BITS
            hit = (wanted.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            rows = np.flatnonzero(hit)
            if len(rows):
                sets = [_ordered(t, order.value).tobytes() for t in _sets(batch.column(1).take(pa.array(rows)), size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows], pa.int64()), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return tidied(run)


class Trie:
    """Ordered sets with shared beginnings; runs without a branch are kept as one array."""

    class _Node:
        __slots__ = ("run", "next", "ends", "low", "high")

        def __init__(self, run: np.ndarray, size: int):
            self.run, self.next, self.ends, self.low, self.high = run, {}, [], size, size

    def __init__(self) -> None:
        self.root = self._Node(np.zeros(0, np.uint64), 0)
        self.root.low, self.root.high = 1 << 62, 0

    def add(self, name, tokens: np.ndarray) -> None:
        node, at, size = self.root, 0, len(tokens)
        while True:
            node.low, node.high = min(node.low, size), max(node.high, size)
            if at == size:
                node.ends.append((name, size))
                return
            child = node.next.get(int(tokens[at]))
            if child is None:
                child = self._Node(tokens[at:], size)
                child.ends.append((name, size))
                node.next[int(tokens[at])] = child
                return
            m = min(len(child.run), size - at)
            differ = np.flatnonzero(child.run[:m] != tokens[at : at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(child.run):  # part the run
                upper = self._Node(child.run[:same], size)
                upper.low, upper.high = child.low, child.high
                child.run = child.run[same:]
                upper.next[int(child.run[0])] = child
                node.next[int(tokens[at])] = upper
                child = upper
            node, at = child, at + same

    def similar(self, tokens: np.ndarray, percent: int) -> Iterator:
        """Names of the sets over the threshold with an ordered set."""
        size, whole = len(tokens), 100 + percent
        place = np.argsort(tokens)
        by_value = tokens[place]
        stack = [(self.root, 0, 0, 0)]
        while stack:
            node, depth, overlap, used = stack.pop()
            alive = True
            for i in range(0, len(node.run), 64):
                run = node.run[i : i + 64]
                at = np.minimum(np.searchsorted(by_value, run), size - 1)
                hits = np.flatnonzero(by_value[at] == run)
                depth, overlap = depth + len(run), overlap + len(hits)
                if len(hits):
                    used = int(place[at[hits[-1]]]) + 1
                if (whole * (overlap + node.high - depth) < percent * (size + node.high)
                        or whole * (overlap + size - used) < percent * (size + node.low)):
                    alive = False
                    break
            if alive:
                yield from (name for name, n in node.ends if whole * overlap >= percent * (size + n))
                stack.extend((child, depth, overlap, used) for child in node.next.values())


def _walking(percent: int):
    """Linked pairs of sorted units: a unit's centre sets come first, then its partners in tries of ``UNIT`` sets."""

    def flush(unit, centres, held, found):
        if centres and held:
            trie = Trie()
            for b, tokens in held:
                trie.add(b, tokens)
            for centre in centres:
                found.extend((unit[0], b) for b in trie.similar(centre, percent))

    def run(batches):
        unit, centres, held, found = None, [], [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for a, salt, b, blob in zip(*columns, batch.column(3), strict=True):
                if (a, salt) != unit or len(held) >= UNIT:
                    flush(unit, centres, held, found)
                    held = []
                    if (a, salt) != unit:
                        unit, centres = (a, salt), []
                tokens = np.frombuffer(blob.as_buffer(), np.uint64).copy()
                if b is None:
                    centres.append(tokens)
                else:
                    held.append((b, tokens))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})
            found = []
        flush(unit, centres, held, found)
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return tidied(run)


def _linked(docs: DataFrame, pairs: DataFrame, size: int, percent: int, order, where: str) -> DataFrame:
    """The pairs (``a``, ``b``) over the threshold, stored. Sets are made again from the texts of their documents."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(_bitmap(pairs.select(F.col("a").alias("node")).union(pairs.select("b"))))
    if wanted.value.any():
        sets = stored(docs.where("doc_id is not null").mapInArrow(
            _whole_sets(size, order, wanted), "node long, tokens binary"), "whole", where)
        units = pairs.groupBy("a").agg(F.ceil(F.count("*") / UNIT).alias("units"))
        salted = pairs.join(units, "a").select("a", F.expr("pmod(xxhash64(b), units)").alias("salt"), "b")
        partners = salted.join(sets, salted["b"] == sets["node"]).select("a", "salt", "b", "tokens")
        centres = salted.select("a", "salt").distinct().join(sets, F.col("a") == sets["node"])
        rows = centres.select("a", "salt", F.lit(None).cast("long").alias("b"), "tokens").union(partners)
        in_units = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        pairs = in_units.mapInArrow(_walking(percent), "a long, b long")
    links = stored(pairs, "links", where)
    wanted.destroy()
    return links


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """One bit for each id modulo a prime: which documents may be asked for."""
    place = F.expr(f"pmod(node, {BITS})")
    words = nodes.select(place.alias("p")).groupBy(F.expr("p div 32").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(p % 32 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(BITS // 32 + 1, np.uint32)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint8)


def met(mixed: DataFrame, percent: int) -> DataFrame:
    """Rows of ``mixed`` (token, node, n, pos, colour, main, holders) with those of another colour than ``main`` that hold the same token.

    A token of more than ``HOT`` holders brings only rows together whose sizes can go with each other and that hold it early enough for that: sizes are
    classed in steps of ``STEP``, and a row goes to each class that it may have links in, if its position leaves room for the overlap needed
    with the smallest size of that class. So documents that share one long passage, and too little beside it, don't meet at all.
    """
    least = f"greatest(floor(power({STEP}D, j)), ceil({percent} * n / 100))"
    last = f"n - ceil({percent} * (n + {least}) / {100 + percent})"
    reach = int(np.log(100 / percent) / np.log(STEP)) + 1
    size = f"cast(floor(ln(n) / ln({STEP}D)) as int)"
    classes = f"filter(sequence({size} - {reach}, {size} + {reach}), j -> pos <= {last})"
    dealt = mixed.withColumn("own", F.expr(f"if(holders <= {HOT}, 0, {size})")).withColumn(
        "other", F.explode(F.expr(f"if(holders <= {HOT}, array(0), {classes})")))
    fewer = dealt.where("colour <> main").select(
        "token", F.col("own").alias("other"), F.col("other").alias("own"), F.col("node").alias("node2"), F.col("n").alias("m"),
        F.col("pos").alias("pos2"), F.col("colour").alias("colour2"))
    return dealt.join(fewer, ["token", "own", "other"])


def jaccard_components(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (columns doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    where = folder(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(rarity(docs, size))
    summaries = docs.mapInArrow(
        _summaries(size, percent, order), "doc_id long, n long, digest binary, prefix array<long>")
    summaries = stored(summaries, "sets", where)

    named = summaries.where("doc_id is not null and n > 0")
    nodes = stored(named.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.count("*").alias("rows")), "nodes", where)
    whole = nodes.select("node", "n", "prefix")
    postings = whole.select(
        F.posexplode("prefix").alias("pos", "token"), "node", "n")
    often = postings.groupBy("token").agg(F.count("*").alias("holders")).where("holders > 1").select("token")
    shared = stored(postings.join(often, "token").select("token", "node", "n", "pos"), "shared", where)

    alike = f"{percent} * greatest(n, m) <= 100 * least(n, m)"
    # a shared hash so early in both that the needed overlap can still follow
    need = f"ceil({percent} * (n + m) / {100 + percent})"
    early = f"pos <= n - {need} and pos2 <= m - {need}"
    # an overlap has at most the shared prefix hashes and what follows the prefix of one of the two
    enough = f"{100 + percent} * (votes + ceil({percent} * greatest(n, m) / 100) - 1) >= {percent} * (n + m)"
    heads = shared.groupBy("token").agg(F.min(F.struct("node", "n")).alias("head")).select(
        "token", F.col("head.node").alias("a"), F.col("head.n").alias("m"))
    votes = shared.join(heads, "token").where("a <> node").where(alike).groupBy("node", "n", "a", "m").agg(
        F.count("*").alias("votes")).where(enough)
    stars = votes.groupBy("node").agg(F.max(F.struct("votes", (-F.col("a")).alias("last"))).alias("top")).select(
        (-F.col("top.last")).alias("a"), F.col("node").alias("b"))
    links = _linked(docs, stored(stars, "stars", where), size, percent, order, f"{where}/first")

    known = components(links)
    coloured = stored(shared.join(known, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("component", "node").alias("colour")), "coloured", where)
    main = coloured.groupBy("token", "colour").count().groupBy("token").agg(
        F.max(F.struct("count", "colour")).alias("top"), F.count("*").alias("colours"), F.sum("count").alias("holders")).where("colours > 1").select(
        "token", F.col("top.colour").alias("main"), "holders")
    rest = met(coloured.join(main, "token"), percent).where(
        "colour <> colour2 and (colour = main or node < node2)").where(alike).where(early).select(
        F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
    ones = whole.select(F.col("node").alias("a"), "n", F.col("prefix").alias("prefix2"))
    others = whole.select(F.col("node").alias("b"), F.col("n").alias("m"), "prefix")
    rest = rest.join(ones, "a").join(others, "b").withColumn("votes", F.size(F.array_intersect("prefix", "prefix2"))).where(
        enough).select("a", "b").distinct()
    more = _linked(docs, stored(rest, "rest", where), size, percent, order, f"{where}/second")
    order.destroy()

    copies = joined_by_key(named.select("digest", "doc_id"), nodes.select("digest", "node", "rows"), "digest").where(
        "doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    groups = components(links.union(more).union(copies))
    return summaries.join(groups, summaries["doc_id"] == groups["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _sent(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= SENT else ids


def one_of_each(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each component: the one with the smallest doc_id.

    Rows without doc_id or without words stay. Rows that share a doc_id are told apart by their texts, so each is judged by its own; of rows with
    the same doc_id and text one stays, the smallest by all columns, which must be of types that have an order.
    """
    where, key = folder(docs.sparkSession), max([*docs.columns, "key"], key=len) + "_"  # a name that none of them has
    digest = F.xxhash64("text")
    apart = docs.where("doc_id is not null").select("doc_id", digest.alias("digest")).groupBy("doc_id").agg(
        F.min("digest").alias(f"{key}low"), F.max("digest").alias(f"{key}high")).where(F.col(f"{key}low") != F.col(f"{key}high"))
    apart = stored(apart.select("doc_id", f"{key}low"), "apart", where)
    several = not apart.isEmpty()
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    if several:  # an id's other texts have keys beyond all ids, so ids stay first in every order
        beyond = F.xxhash64("doc_id", "text").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
        keyed = keyed.join(_sent(apart), "doc_id", "left").withColumn(
            key, F.when(F.col(f"{key}low").isNull() | (F.col(f"{key}low") == digest), F.col(key)).otherwise(beyond)).select(*docs.columns, key)
    found = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), size, percent).where("doc_id is not null and n_shingles > 0")
    found = stored(found.select(F.col("doc_id").alias(key), "component_id"), "components", where)
    gone = found.where(F.col(key) != F.col("component_id")).select(key).distinct()
    if several:  # the first of a component by the ids themselves
        ids = keyed.where(F.col(key) >= 1 << 62).select(key, F.col("doc_id").cast("long").alias("id")).distinct()
        named = found.distinct().join(ids, key, "left").withColumn("id", F.coalesce("id", key))
        first = named.groupBy("component_id").agg(F.min(F.struct("id", key)).alias("first"))
        gone = named.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_anti").select(key)
    again = found.groupBy(key).count().where("count > 1").select(key)
    kept = keyed.join(_sent(gone), key, "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(_sent(again), key, "left_anti").select(docs.columns)
    same = kept.join(_sent(again), key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return once.unionByName(same)
