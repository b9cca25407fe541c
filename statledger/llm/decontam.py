"""Benchmark decontamination by latent semantic retrieval, then longest common subsequences and answers.

Method. Benchmark items are cut into passages of at most ``PASSAGE`` words. A term weighs less the more different words stand before it
somewhere in the documents: common words have many such neighbours, words of a passage few, in however many documents it stands. Passages are
vectors of these weights. A randomised SVD, whose products run over partitions of passages, gives the latent space: its rank doubles until it
holds ``ENERGY`` of the squared weight of every passage, up to ``MOST``. Documents are cut into windows of ``WINDOW`` words, half overlapping, and
folded in. A window and a passage are candidates if their cosine is ``COSINE`` or more (less for shorter passages, which fill less of a window) and the window's
share of the passage is half of ``LIKELY`` or more, as a window may hold just half of a passage. Passages that the space does not hold,
such as those of common words alone, have the windows with their rarest words as candidates, so many of them that a hit holds one at least.
Each candidate is bounded first by the words that its surroundings and the passage have in common, each as often as in both; the longest common subsequences are
taken from the largest bound down, until no bound is above the cover found. The cover is the smaller of the shares of the words and of their weight that a
subsequence holds. A document is contaminated if it covers ``SURE`` of a passage, or ``LIKELY`` of it and ``ANSWER`` of its answer, which is its last
quarter, ``LEAST_TERMS`` words at least. No hit has fewer than ``LEAST_TERMS`` words in common, or all words of a passage with fewer: an item of one or two
words is held by each document that has them in order.

Words are runs of letters and digits (all bytes beyond ASCII count as letters), A-Z and Latin-1 capitals lower-cased.

Defined results. Null and empty texts of either table give nothing. A null item_id stays null in the result; items with an equal id and
text count once. Every row of the documents is judged, repeated ones and such without doc_id too. Ties of a document and item show the
largest cover. Long texts are read in whole, in pieces. Empty tables give no rows. Other columns are not looked at.

At scale. Two passes over the texts without shuffling them, for ``TOGETHER`` blocks of the benchmark at once. What is sent to executors is
bounded: a benchmark of more than ``BLOCK_CHARS`` code points, or whose passages times terms exceed ``CELLS``, makes several blocks, each with its
own space. The driver gets one terms x rank matrix a product, summed on Spark, and ``REGISTERS`` numbers a term.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, tidied
from .words import NO_WORD, hashes, mix, slices

PASSAGE, WINDOW, ENERGY, RANK, MOST = 64, 32, 0.95, 64, 256
COSINE, LEAST_TERMS, SURE, LIKELY, ANSWER = 0.25, 3, 0.6, 0.4, 0.8
BLOCK_CHARS, CELLS, TERM_BLOCK, TERM_BYTES, TOGETHER = 400_000, 1 << 22, 1024, 1 << 16, 8
REGISTERS, PRIOR, LATENT = 16, 30, 0.1  # bitmaps of a term's neighbours; neighbours that each term has besides; least weight in the space
PIECE = 1 << 17  # bytes of documents that are searched together
PAIRS = 1 << 20  # windows by passages, or words by passages, that are looked at together
_HITS = "doc_id long, item_id long, cosine double, cover double, answer double"


def _words(texts: list[str]) -> list[np.ndarray]:
    found = []
    for _, raw, offsets in slices(pa.array(texts, pa.large_string())):
        words, first = hashes(raw, offsets, NO_WORD, fold_latin=True)
        found += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    return found


def passages(items: list[tuple[int | None, str]]) -> list[tuple[int | None, np.ndarray]]:
    """Item id and word hashes of each passage; long items are cut into half-overlapping ones."""
    out = []
    for (item_id, _), words in zip(items, _words([t for _, t in items]), strict=True):
        starts = [0] if len(words) <= PASSAGE else [*range(0, len(words) - PASSAGE, PASSAGE // 2), len(words) - PASSAGE]
        out += [(item_id, words[a : a + PASSAGE]) for a in starts if len(words)]
    return out


class Terms:
    """Place of word hashes in a sorted vocabulary."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.some = np.zeros(1 << 16, bool)
        self.some[(vocabulary >> np.uint64(48)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and their term numbers."""
        at = np.flatnonzero(self.some[(words >> np.uint64(48)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.vocabulary, words[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[term] == words[at]
        return at[same], term[same]


def _neighbours(vocabulary):
    """Bitmaps of the words that stand before each term.

    A neighbour sets one bit: its hash chooses the register and, by its trailing zeros, the bit, so that the number of bits set grows with the logarithm of
    the number of neighbours. Bitmaps of tasks are joined by OR.
    """

    def run(batches):
        terms = Terms(vocabulary.value)
        seen = np.zeros(len(vocabulary.value) * REGISTERS, np.int64)
        for batch in batches:
            for _, raw, offsets in slices(batch.column(0), PIECE):
                words, first = hashes(raw, offsets, NO_WORD, fold_latin=True)
                at, term = terms.find(words)
                before = np.where(np.isin(at, first, assume_unique=False), np.uint64(0), words[at - 1])
                before = mix(before + np.uint64(1))
                register = (before >> np.uint64(60)).astype(np.int64) % REGISTERS
                low = before & (~before + np.uint64(1)) & np.uint64((1 << 60) - 1)
                np.bitwise_or.at(seen, term * REGISTERS + register, low.view(np.int64))
        seen = seen.reshape(-1, REGISTERS)
        held = np.flatnonzero(seen.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), *(pa.array(seen[held, i]) for i in range(REGISTERS))], names=["term", *(f"r{i}" for i in range(REGISTERS))])

    return tidied(run)


def _counts(bits: np.ndarray) -> np.ndarray:
    """About how many neighbours set so many bits."""
    n = np.exp2(np.arange(0, 50, 1 / 16))
    chance = np.exp2(-np.arange(1, 60, dtype=np.float64)) / REGISTERS
    expected = REGISTERS * (1 - np.exp(n[:, None] * np.log1p(-chance))).sum(1)
    return np.interp(bits, np.append(0, expected), np.append(0, n))


def weights_of(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Weight of each term: 1 with no neighbour in the documents, near 0 with as many as any."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f"r{i}" for i in range(REGISTERS)]
    rows = docs.select("text").mapInArrow(_neighbours(sent), "term long, " + ", ".join(f"{n} long" for n in names))
    rows = rows.groupBy("term").agg(*(F.bit_or(n).alias(n) for n in names))
    bits = np.zeros(len(vocabulary))
    found = rows.select("term", sum((F.bit_count(n) for n in names), F.lit(0)).alias("bits")).toArrow()
    bits[found["term"].to_numpy()] = found["bits"].to_numpy()
    sent.destroy()
    many = _counts(bits)
    top = many.max(initial=0) + 2 * PRIOR
    return np.log(top / (many + PRIOR)) / np.log(top / PRIOR)


def _product(basis):
    """The sum over a partition's passages ``a`` of ``a (a' basis)``, in blocks of ``TERM_BLOCK`` terms and ``TERM_BYTES`` at most, one term at least.

    Each block is a row that the driver gets, and large rows take its heap several times over.
    """

    def run(batches):
        matrix = basis.value
        total = np.zeros_like(matrix)
        for batch in batches:
            for term, weight in zip(batch.column(0), batch.column(1), strict=True):
                term, weight = term.values.to_numpy(), weight.values.to_numpy()
                total[term] += np.outer(weight, weight @ matrix[term])
        step = max(1, min(TERM_BLOCK, TERM_BYTES // (total.itemsize * total.shape[1])))
        for i in range(0, len(total), step):
            yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int64()), "sums": pa.array([total[i : i + step].tobytes()], pa.binary())})

    return tidied(run)


def _summed(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s.as_py(), np.float64) for s in rows["sums"])
    return pa.table({"block": rows["block"][:1], "sums": pa.array([total.tobytes()], pa.binary())})


def latent_space(rows: DataFrame, size: int, vectors: list[tuple[list[int], list[float]]], limit: int, seed: int = 5) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages ``rows`` (terms, weights), by a randomised range finder.

    ``vectors`` are the same passages, to see what the space holds of each; ``limit`` is the largest possible rank. What a space
    of rank ``MOST`` doesn't hold is looked for by overlap.
    """
    context = rows.sparkSession.sparkContext

    def product(basis: np.ndarray) -> np.ndarray:
        sent = context.broadcast(basis)
        parts = rows.mapInArrow(_product(sent), "block long, sums binary")
        blocks = parts.groupBy("block").applyInArrow(_summed, "block long, sums binary").toArrow()
        sent.destroy()
        out = np.empty(basis.shape)
        for block, sums in zip(blocks["block"].to_pylist(), blocks["sums"], strict=True):
            values = np.frombuffer(sums.as_buffer(), np.float64).reshape(-1, basis.shape[1])
            out[block : block + len(values)] = values
        return out

    rng, rank, limit = np.random.default_rng(seed), RANK, min(limit, MOST)
    while True:
        rank = min(rank, limit)
        basis = rng.standard_normal((size, min(rank + 8, size)))
        for _ in range(2):
            basis, _ = np.linalg.qr(product(basis))
        energy, turn = np.linalg.eigh(basis.T @ product(basis))
        space = basis @ turn[:, np.argsort(-energy)[:rank]]
        held = (((np.array(w) @ space[t]) ** 2).sum() >= ENERGY * (np.array(w) ** 2).sum() for t, w in vectors)
        if rank == limit or all(held):
            return space
        rank *= 2


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    place: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        place[x] = place.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = place.get(x)
        if hit:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def weighted_common(passage: np.ndarray, weights: np.ndarray, region: np.ndarray) -> float:
    """Largest weight of a common subsequence of the passage's words and the region."""
    best = np.zeros(len(region) + 1)
    for word, weight in zip(passage.tolist(), weights.tolist(), strict=True):
        best[1:] = np.maximum(best[1:], best[:-1] + weight * (region == word))
        np.maximum.accumulate(best, out=best)
    return float(best[-1])


class Index:
    """Latent benchmark passages and what is needed to fold documents in."""

    def __init__(self, found: list[tuple[int | None, np.ndarray]], vocabulary: np.ndarray, weights: np.ndarray, space: np.ndarray):
        self.terms = Terms(vocabulary)
        self.items = [i for i, _ in found]
        self.own = [self.terms.find(w)[1] for _, w in found]
        self.reach = np.array([len(t) for t in self.own])
        self.weights = [weights[t] for t in self.own]
        self.total = np.array([w.sum() for w in self.weights])
        self.least = np.maximum(np.ceil(LIKELY * self.reach - 1e-9).astype(np.int64), np.minimum(LEAST_TERMS, self.reach))
        in_space = np.where(weights >= LATENT, weights, 0)
        self.loadings = (in_space[:, None] * space).astype(np.float32)
        self.weighs = in_space > 0
        latent = np.stack([self.loadings[t].sum(0) for t in self.own])
        self.size = np.maximum(np.linalg.norm(latent, axis=1), 1e-12)
        self.latent = (latent / self.size[:, None]).T.copy()
        self.cosine = (COSINE * np.sqrt(np.minimum(1, self.reach / WINDOW))).astype(np.float32)
        #: For each passage and term the place among the passage's different terms, from 1; how often they stand in it, and their weights.
        self.slot = np.zeros((len(found), len(vocabulary)), np.uint8)
        self.times, self.each = np.zeros((len(found), PASSAGE + 1), np.int64), np.zeros((len(found), PASSAGE + 1))
        full = np.zeros(len(found))
        self.anchors: list[np.ndarray] = []
        for p, t in enumerate(self.own):
            terms, times = np.unique(t, return_counts=True)
            self.slot[p, terms] = np.arange(1, len(terms) + 1)
            self.times[p, 1 : len(terms) + 1], self.each[p, 1 : len(terms) + 1] = times, weights[terms]
            full[p] = ((times * weights[terms]) ** 2).sum()
            # the rarest terms, without which the others are too few or too light for a hit
            order = np.argsort(-weights[terms], kind="stable")
            heavy, many = np.cumsum((times * weights[terms])[order]), np.cumsum(times[order])
            enough = (self.total[p] - heavy < LIKELY * self.total[p] - 1e-9) | (self.reach[p] - many < self.least[p])
            self.anchors.append(terms[order[: int(enough.argmax()) + 1]])
        #: Passages that the space doesn't hold.
        self.outside = np.flatnonzero(self.size**2 < ENERGY * full)

    def search(self, raw: np.ndarray, offsets: np.ndarray, first_only: bool = False) -> Iterator[tuple[int, int, float, float, float]]:
        """Row, passage, cosine, cover and answer's cover of every hit in a slice of documents; of one a row with ``first_only``."""
        words, first = hashes(raw, offsets, NO_WORD, fold_latin=True)
        at, term = self.terms.find(words)
        if not len(at):
            return
        half = WINDOW // 2
        many = np.maximum(-(-np.diff(first) // half), 1)  # half windows of each row
        begin = np.cumsum(many) - many
        row = np.searchsorted(first, at, "right") - 1
        block = begin[row] + (at - first[row]) // half
        used, start = np.unique(block, return_index=True)
        owner = np.searchsorted(begin, used, "right") - 1
        window, passage, cosine = self._latent(term, block, used, owner)
        more_w, more_p = self._anchored(term, block, used)
        window, passage, cosine = np.append(window, more_w), np.append(passage, more_p), np.append(cosine, np.zeros(len(more_w)))
        key, unique = np.unique(owner[window] * np.int64(1 << 40) + window * np.int64(1 << 16) + passage, return_index=True)
        window, passage, cosine = window[unique], passage[unique], cosine[unique]
        if not len(key):
            return
        # the surroundings of each candidate, as a stretch of the terms found
        r = owner[window]
        from_word = first[r] + (used[window] - begin[r]) * half
        reach = self.reach[passage]
        a = np.searchsorted(at, np.maximum(from_word - reach, first[r]))
        b = np.searchsorted(at, np.minimum(from_word + WINDOW + reach, first[r + 1]))
        bound = self._bounds(term, a, b, passage)
        keep = np.flatnonzero(bound >= LIKELY - 1e-9)
        keep = keep[np.lexsort((a[keep], -bound[keep], passage[keep], r[keep]))]
        best: tuple | None = None
        where = (-1, -1)
        for c in keep.tolist():
            here = int(r[c]), int(passage[c])
            if here != where:
                if best:
                    yield *where, *best
                    if first_only and here[0] == where[0]:
                        continue
                where, best = here, None
            if best and (first_only or bound[c] <= best[1]):
                continue
            hit = self._checked(float(cosine[c]), term[a[c] : b[c]], here[1])
            if hit and (not best or hit[1:] > best[1:]):
                best = hit
        if best:
            yield *where, *best

    def _latent(self, term: np.ndarray, block: np.ndarray, used: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows and passages with the cosine and share that candidates have, and their cosines; so many at a time that memory stays bounded."""
        heavy = self.weighs[term]
        term, block = term[heavy], block[heavy]
        at = np.searchsorted(block, used)
        step, found = max(1, PAIRS // len(self.items)), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        for i in range(0, len(used), step):
            to = min(i + step + 1, len(used))  # one more, as a window is a block with the next one of its row
            sums = self._folded(term, at, block, used, i, to)
            paired = np.flatnonzero((used[i + 1 : to] == used[i : to - 1] + 1) & (owner[i + 1 : to] == owner[i : to - 1]))
            window = sums.copy()
            window[paired] += sums[paired + 1]
            window = window[: min(step, len(used) - i)]
            dots = window @ self.latent
            length = np.maximum(np.linalg.norm(window, axis=1), 1e-12)
            w, p = np.nonzero((dots >= self.cosine * length[:, None]) & (dots >= LIKELY / 2 * self.size))
            found.append((w + i, p, dots[w, p] / length[w]))
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def _folded(self, term: np.ndarray, at: np.ndarray, block: np.ndarray, used: np.ndarray, i: int, to: int) -> np.ndarray:
        """Sum of the loadings of the terms of each half window."""
        out = np.zeros((to - i, self.loadings.shape[1]), np.float32)
        end = int(at[to]) if to < len(used) else len(term)
        own = block[at[i] : end]
        if len(own):
            change = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            out[np.searchsorted(used[i:to], own[change])] = np.add.reduceat(self.loadings[term[at[i] : end]], change, axis=0)
        return out

    def _anchored(self, term: np.ndarray, block: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half windows with an anchor of the passages outside the space, where those around hold enough of the passage's weight."""
        found_w, found_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.outside):
            order = np.argsort(term, kind="stable")
            begin = np.searchsorted(term[order], np.arange(self.slot.shape[1] + 1))
        for p in self.outside.tolist():
            near = np.concatenate([order[begin[t] : begin[t + 1]] for t in self.anchors[p].tolist()])
            if not len(near):
                continue
            window = np.searchsorted(used, np.unique(block[near]))
            if len(window) > 8:
                place = np.flatnonzero(self.slot[p][term])
                held = np.bincount(block[place] - block[0], self.each[p][self.slot[p][term[place]]], int(block[-1] - block[0]) + 1)
                around = -(-int(self.reach[p]) // (WINDOW // 2)) + 1
                sums = np.append(0, np.cumsum(held))
                middle = used[window] - block[0]
                sums = sums[np.minimum(middle + around + 2, len(held))] - sums[np.maximum(middle - around, 0)]
                window = window[sums >= LIKELY * self.total[p] - 1e-6]
            found_w.append(window)
            found_p.append(np.full(len(window), p))
        return np.concatenate(found_w), np.concatenate(found_p)

    def _bounds(self, term: np.ndarray, a: np.ndarray, b: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """Largest cover that each stretch of terms can have: words in common, each as often as in both."""
        out, many = np.zeros(len(a)), b - a
        ends = np.cumsum(many)
        i = 0
        while i < len(a):
            to = max(i + 1, int(np.searchsorted(ends, ends[i] - many[i] + PAIRS, "right")))
            n = many[i:to]
            own = np.repeat(np.arange(to - i), n)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a[i:to], n)
            slot = self.slot[passage[i:to][own], term[place]].astype(np.int64)
            held = np.flatnonzero(slot)
            key, times = np.unique(own[held] * (PASSAGE + 1) + slot[held], return_counts=True)
            own, slot = np.divmod(key, PASSAGE + 1)
            p = passage[i:to][own]
            times = np.minimum(times, self.times[p, slot])
            p = passage[i:to]
            plain = np.bincount(own, times, to - i)
            weight = np.bincount(own, times * self.each[passage[i:to][own], slot], to - i)
            out[i:to] = np.where(plain >= self.least[p], np.minimum(plain / self.reach[p], weight / self.total[p]), 0)
            i = to
        return out

    def _checked(self, cosine: float, region: np.ndarray, p: int) -> tuple[float, float, float] | None:
        """Cosine, cover and answer's cover of a region's terms that passes."""
        passage, weights = self.own[p], self.weights[p]
        region = region[self.slot[p][region] > 0]
        held = common(passage, region)
        if held < self.least[p]:
            return None
        cover = min(held / len(passage), weighted_common(passage, weights, region) / self.total[p])
        if cover < LIKELY - 1e-9:
            return None
        last = max(len(passage) // 4, LEAST_TERMS)
        answer = weighted_common(passage[-last:], weights[-last:], region) / weights[-last:].sum()
        return (cosine, cover, answer) if cover >= SURE - 1e-9 or answer >= ANSWER - 1e-9 else None


def _searching(indexes):
    def run(batches):
        own = [Index(*i) for i in indexes.value]
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for row, raw, offsets in slices(batch.column(1), PIECE):
                for index in own:
                    rows += [(ids[row + r], index.items[p], c, cover, answer) for r, p, c, cover, answer in index.search(raw, offsets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), *[pa.float64()] * 3))],
                names=["doc_id", "item_id", "cosine", "cover", "answer"])

    return tidied(run)


def _clean(indexes, place: int):
    """The rows without a hit."""

    def run(batches):
        own = [Index(*i) for i in indexes.value]
        for batch in batches:
            kept = np.ones(batch.num_rows, bool)
            for row, raw, offsets in slices(batch.column(place), PIECE):
                for index in own:
                    for r, *_ in index.search(raw, offsets, True):
                        kept[row + r] = False
            yield batch.filter(pa.array(kept))

    return tidied(run)


def parted(found: list[tuple[int | None, np.ndarray]]) -> Iterator[tuple[list[tuple[int | None, np.ndarray]], np.ndarray]]:
    """Passages and their vocabulary, halved until a matrix of both has ``CELLS`` cells at most."""
    if not found:
        return
    vocabulary = np.unique(np.concatenate([w for _, w in found]))
    if len(found) * len(vocabulary) <= CELLS or len(found) == 1:
        yield found, vocabulary
        return
    half = len(found) // 2
    yield from parted(found[:half])
    yield from parted(found[half:])


def _index(docs: DataFrame, found: list[tuple[int | None, np.ndarray]], vocabulary: np.ndarray, weights: np.ndarray) -> tuple:
    rows, terms = [], Terms(vocabulary)
    in_space = np.where(weights >= LATENT, weights, 0)
    for _, words in found:
        term, count = np.unique(terms.find(words)[1], return_counts=True)
        rows.append((term.tolist(), (count * in_space[term]).tolist()))
    frame = docs.sparkSession.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(4)
    return found, vocabulary, weights, latent_space(frame, len(vocabulary), rows, min(len(found), len(vocabulary)))


def _parts(benchmark: DataFrame) -> Iterator[tuple[list[tuple[int | None, np.ndarray]], np.ndarray]]:
    """Passages and vocabulary of each block of the benchmark."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_CHARS)
    for block in range(blocks):
        chosen = items.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {block}")).orderBy("item_id", "text")
        yield from parted(passages([(r["item_id"], r["text"]) for r in chosen.collect()]))


def together(docs: DataFrame, benchmark: DataFrame) -> Iterator[list[tuple]]:
    """What an ``Index`` is made of for each block of the benchmark, ``TOGETHER`` blocks at once, whose terms are looked for in one pass."""
    small_batches(docs.sparkSession)
    parts = _parts(benchmark)
    while some := list(islice(parts, TOGETHER)):
        vocabulary = np.unique(np.concatenate([v for _, v in some]))
        weights = weights_of(docs, vocabulary)
        yield [_index(docs, found, own, weights[np.searchsorted(vocabulary, own)]) for found, own in some]


def indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple]:
    """What an ``Index`` is made of, for each block of the benchmark."""
    for some in together(docs, benchmark):
        yield from some


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, cover and answer of every document and benchmark item that it holds."""
    spark, found = docs.sparkSession, None
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for some in together(docs, benchmark):
        hits = docs.mapInArrow(_searching(spark.sparkContext.broadcast(some)), _HITS)
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], _HITS)
    best = F.max(F.struct("cover", "answer", "cosine")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.cover", "best.answer")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    kept = docs
    for some in together(docs, benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(some)
        kept = kept.mapInArrow(_clean(sent, docs.columns.index("text")), docs.schema)
    return kept
