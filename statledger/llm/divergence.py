"""Divergence of the sources of each language in their use of terms, with late string materialization.

Method. Terms are counted by 64-bit digests: only digests, groups and numbers are shuffled. A language keeps the digests that enough of its
documents hold. A second pass takes the least and the greatest string of each kept digest; where they differ, several terms share the digest and
the terms of such digests are counted again by their strings. Strings come back just for these two tables and for terms that are returned.
All numbers are whole: a term with ``count`` occurrences in a group has the rate 1 + floor(``SCALE`` * (count + ``SMOOTH``) / (N + ``SMOOTH`` * V)), N being the
group's occurrences of kept terms and V the number of terms its language keeps.

Terms are runs of bytes that are ASCII letters or beyond ASCII; A-Z count as a-z. Null text, lang and source are ''.

Defined results. Each row of the documents counts once, repeated ids and rows too. Every occurring group (lang, source) takes part, without terms
too. A language with one source has no pairs; where a language keeps no terms its pairs have the value 0 and there are no term rows. Terms whose
rate is not above the language's are left out. Ties are ranked by the UTF-8 bytes of the item. Long texts are read in whole, in pieces. Empty tables
give no rows. Other columns are not looked at.

At scale. Tasks add up the counts of ``HELD`` words before they send them, and Spark adds up those of a task. Which digests are kept goes to the second pass as a bitmap of
fixed size: what it lets through beyond them falls out in a join. Differences of sources are summed in blocks of terms of bounded size, all pairs of sources
within a block at once, so nothing is sent for a pair of sources and a term. The first ranks of a group are cut within each task first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import folder, small_batches, stored, tidied
from .words import hashes, slices

LEAST_DOCUMENTS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
BITS, BITMAP = 64, 1 << 26  # bits of a digest, bits of the bitmap
#: Words added up in a task, rows sent at once, terms that a task remembers to have sent, cells of a block of terms by sources.
HELD, SENT, KNOWN, CELLS = 1 << 19, 1 << 15, 1 << 18, 1 << 15
#: Every byte that is neither an ASCII letter nor beyond ASCII.
_NO_TERM = np.ones(256, bool)
_NO_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def digests(terms: list[bytes], bits: int = BITS) -> np.ndarray:
    """Digest of each term."""
    if not terms:
        return np.zeros(0, np.int64)
    text = b" ".join(terms)
    words, _ = hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]), _NO_TERM)
    return _narrow(words, bits)


def _narrow(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> np.uint64(64 - bits)).view(np.int64)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def _counting(bits: int):
    """Occurrences and documents of each digest in each group, added up over about ``HELD`` words."""

    def summed(groups: dict, held: list) -> Iterator[pa.RecordBatch]:
        group, digest, n, docs = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((digest, group))
        group, digest, n, docs = group[order], digest[order], n[order], docs[order]
        start = _starts(group, digest)
        if not len(start):
            return
        lang, source = (pa.array([key[i] for key in groups], pa.string()).take(pa.array(group[start])) for i in (0, 1))
        columns = [lang, source, *(pa.array(x, pa.int64()) for x in (digest[start], np.add.reduceat(n, start), np.add.reduceat(docs, start)))]
        whole = pa.RecordBatch.from_arrays(columns, names=["lang", "source", "digest", "n", "docs"])
        for i in range(0, len(start), SENT):
            yield whole.slice(i, SENT)

    def run(batches):
        groups, held, many = {}, [], 0
        for batch in batches:
            own = np.array([groups.setdefault(key, len(groups)) for key in zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True)], np.int64)
            for row, raw, offsets in slices(batch.column(0)):
                words, first = hashes(raw, offsets, _NO_TERM)
                words, owner = _narrow(words, bits), np.repeat(np.arange(len(first) - 1), np.diff(first))
                order = np.lexsort((words, owner))
                words, owner = words[order], owner[order]
                start = _starts(owner, words)
                held.append((own[row + owner[start]], words[start], np.diff(np.append(start, len(words))), np.ones(len(start), np.int64)))
                many += len(start)
                if many >= HELD:
                    yield from summed(groups, held)
                    held, many = [], 0
        if held:
            yield from summed(groups, held)

    return tidied(run)


def _naming(bitmap, bits: int):
    """Each term of a batch whose digest is in the bitmap, with its digest."""

    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            terms: set[bytes] = set()
            for _, raw, _ in slices(_apart(batch.column(0))):
                terms.update(_TERM.findall(raw.tobytes().translate(_LOWER)))
            terms -= sent
            if len(sent) < KNOWN:
                sent |= terms
            own = sorted(terms)
            digest = digests(own, bits)
            keep = _in(bitmap.value, digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[keep]), pa.array([own[i].decode() for i in np.flatnonzero(keep)], pa.string())], names=["digest", "term"])

    return tidied(run)


def _apart(texts: pa.Array) -> pa.Array:
    """The texts with a blank behind each, so that they can be looked at together."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))


def _recounting(bitmap, bits: int):
    """Occurrences of each term whose digest is in the bitmap, by document."""

    def run(batches):
        for batch in batches:
            out = []
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), strict=True):
                found: dict[bytes, int] = {}
                for term in _TERM.findall((text or "").encode().translate(_LOWER)):
                    found[term] = found.get(term, 0) + 1
                own = list(found)
                digest = digests(own, bits)
                out += [(lang, source, int(digest[i]), own[i].decode(), found[own[i]]) for i in np.flatnonzero(_in(bitmap.value, digest))]
            types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["lang", "source", "digest", "term", "n"])

    return tidied(run)


def _place(digest: np.ndarray) -> np.ndarray:
    return (digest.view(np.uint64) % np.uint64(BITMAP)).astype(np.int64)


def _in(bitmap: bytes, digest: np.ndarray) -> np.ndarray:
    place = _place(digest)
    return (np.frombuffer(bitmap, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap(digest: DataFrame):
    """A broadcast bitmap of the places of all digests; its size is fixed, and so is what the driver gets."""
    place = digest.select(F.pmod("digest", F.lit(BITMAP)).alias("place"))
    bits = place.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
    out = np.zeros(BITMAP // 64, np.int64)
    for rows in bits.repartition(16).mapInArrow(_packed, "word binary, bits binary").collect():
        out[np.frombuffer(rows["word"], np.int64)] = np.frombuffer(rows["bits"], np.int64)
    return digest.sparkSession.sparkContext.broadcast(out.tobytes())


def _packed(batches):
    for batch in batches:
        word, bits = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array([word.tobytes()], pa.binary()), pa.array([bits.tobytes()], pa.binary())], names=["word", "bits"])


def _differences(rows: pa.Table) -> pa.Table:
    """Sums of the absolute differences of the rates of all pairs of sources over one block of terms.

    A row without a digest brings a source and the rate of the terms that it doesn't hold.
    """
    source, digest, term, rate = (rows[c] for c in ("source", "digest", "term", "rate"))
    names = sorted(set(source.to_pylist()))
    place = {s: i for i, s in enumerate(names)}
    at = np.array([place[s] for s in source.to_pylist()])
    keys: dict[tuple, int] = {}
    column = np.array([-1 if d is None else keys.setdefault((d, t), len(keys)) for d, t in zip(digest.to_pylist(), term.to_pylist(), strict=True)])
    rate = rate.to_numpy()
    rates = np.zeros((len(names), len(keys)), np.int64)
    rates += np.bincount(at[column < 0], rate[column < 0], len(names)).astype(np.int64)[:, None]
    rates[at[column >= 0], column[column >= 0]] = rate[column >= 0]
    out = {"source": [], "item": [], "value": []}
    for i, name in enumerate(names):
        value = np.abs(rates - rates[i]).sum(1)
        others = [j for j in range(len(names)) if j != i]
        out["source"] += [name] * len(others)
        out["item"] += [names[j] for j in others]
        out["value"] += value[others].tolist()
    lang = rows["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), "source": pa.array(out["source"], pa.string()),
                     "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})


def term_counts(docs: DataFrame, least: int, bits: int, where: str) -> tuple[DataFrame, DataFrame]:
    """Kept terms of each group (lang, source, digest, term, n) and the strings of kept digests (digest, least, greatest).

    ``term`` is null but for digests that several terms share.
    """
    counted = docs.mapInArrow(_counting(bits), "lang string, source string, digest long, n long, docs long")
    counted = stored(counted.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "digests", where)
    enough = counted.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "digest")
    enough = stored(enough, "kept", where)
    digest = enough.select("digest").distinct()
    named = docs.select("text").mapInArrow(_naming(_bitmap(digest), bits), "digest long, term string")
    named = named.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    named = stored(named.join(digest, "digest", "left_semi"), "names", where)
    kept = counted.join(enough, ["lang", "digest"], "left_semi").select("lang", "source", "digest", F.lit(None).cast("string").alias("term"), "n")
    shared = named.where("least <> greatest").select("digest")
    if not shared.isEmpty():
        again = docs.mapInArrow(_recounting(_bitmap(shared), bits), "lang string, source string, digest long, term string, n long")
        again = again.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
        again = stored(again.join(shared, "digest", "left_semi"), "again", where)
        enough = again.groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "digest", "term")
        kept = kept.join(shared, "digest", "left_anti").unionByName(again.join(enough, ["lang", "digest", "term"], "left_semi").drop("docs"))
    return stored(kept, "counts", where), named


def _rate(n):
    exact = (F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(28,0)")).cast("decimal(38,0)")
    return 1 + F.call_function("div", exact, (F.col("total") + SMOOTH * F.col("v")).cast("decimal(38,0)"))


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, bits: int = BITS) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank."""
    spark, where = docs.sparkSession, folder(docs.sparkSession)
    small_batches(spark)
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts, named = term_counts(docs, least, bits, where)
    by_lang = counts.groupBy("lang", "digest", "term").agg(F.sum("n").alias("n"))
    langs = stored(by_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total")), "langs", where)
    groups = docs.select("lang", "source").groupBy("lang", "source").agg(F.count("*").alias("rows"))
    groups = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(
        langs.select("lang", "v"), "lang", "left")
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(sources, "lang").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), "sources")
    groups = groups.withColumn("blocks", F.expr(f"cast(greatest(1, ceil(v * sources / {CELLS})) as int)"))
    groups = stored(groups.withColumn("rest", F.when(F.col("v") > 0, _rate(F.lit(0))).otherwise(0)), "groups", where)

    rated = counts.join(groups, ["lang", "source"]).withColumn("rate", _rate(F.col("n")))
    block = F.pmod(F.xxhash64("digest", "term"), "blocks").cast("int")
    cells = rated.select("lang", "source", block.alias("block"), "digest", "term", "rate").unionByName(groups.select(
        "lang", "source", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("digest"),
        F.lit(None).cast("string").alias("term"), F.col("rest").alias("rate")))
    pairs = cells.groupBy("lang", "block").applyInArrow(_differences, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    overall = by_lang.join(langs, "lang").select("lang", F.struct("digest", "term").alias("key"), _rate(F.col("n")).alias("overall"))
    terms = rated.withColumn("key", F.struct("digest", "term")).join(overall, ["lang", "key"])
    terms = terms.withColumn("value", F.col("rate") - F.col("overall")).where("value > 0")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    terms = terms.withColumn("near", F.rank().over(first)).where(F.col("near") <= top).select("lang", "source", "digest", "term", "value")
    terms = terms.join(named, "digest").select("lang", "source", F.lit("term").alias("part"), F.coalesce("term", "least").alias("item"), "value")

    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return pairs.unionByName(terms).withColumn("rank", F.row_number().over(ranked)).where((F.col("part") == "pair") | (F.col("rank") <= top))
