"""Byte-level BPE by overlapping chunks: pre-tokenise in parallel, stitch, encode the pieces, decode by joining bytes.

Method. A text of more than ``CHUNK`` code points is cut into chunks that overlap by ``OVERLAP``. Chunks are dealt out
and pre-tokenised independently of each other. The pattern looks only forward from where a match begins, so once two
neighbours share a boundary inside their overlap, everything to the right of it is the same. ``stitch`` takes the first
such boundary; where a pre-token is longer than the overlap it goes on matching from the last sure boundary until it
meets one. The stitched segments are dealt out again and their pre-tokens encoded by merges of lowest rank, then the ids of a
document are put together in order. Shorter texts are one chunk each and need neither shuffle.

Defined results. A null text counts as empty: no ids, digests of no bytes. Every row comes back, repeated rows and null
ids included. Special tokens in a text are ordinary text. Other columns are not looked at.

At scale. Only texts longer than a chunk are shuffled. A task holds one batch, one document's boundaries and a cache of
at most ``CACHED`` distinct pieces. The vocabulary (fixed, about 1 MB) is read on the driver and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, tidied

CHUNK, OVERLAP, CACHED, SHORT = 1 << 16, 1 << 10, 400_000, 256
_NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of one piece: the adjacent pair of lowest rank is joined, leftmost first, until none is in ``ranks``."""
    if piece in ranks:
        return [piece]
    return _merge_short(piece, ranks) if len(piece) <= SHORT else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    rank = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == _NEVER:
            break
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], _NEVER)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
    return parts


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same with a heap of pairs over a linked list, for pieces of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here
    before = list(range(-1, n - 1))
    gone = bytearray(n)
    heap = []

    def offer(i: int) -> None:
        if end[i] < n:
            r = ranks.get(piece[i : end[end[i]]], _NEVER)
            if r < _NEVER:
                heapq.heappush(heap, (r, i, end[end[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone[end[i]] = 1
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    parts, i = [], 0
    while i < n:
        parts.append(piece[i : end[i]])
        i = end[i]
    return parts


class Codec(dict):
    """Ids of pieces, as little-endian 32-bit integers; a cache of bounded size that fills itself."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def __missing__(self, piece: str) -> bytes:
        ids = np.array([self.ranks[t] for t in merge(piece.encode(), self.ranks)], "<u4").tobytes()
        if len(self) >= CACHED:
            self.clear()
        if len(piece) <= SHORT:
            self[piece] = ids
        return ids

    def encode(self, pieces: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def boundaries(pattern, text: str, whole: bool) -> np.ndarray:
    """Ends of the pre-tokens of a chunk; unless it ends its text, without those that more text could move."""
    ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
    return ends if whole else ends[ends < len(text)]


def stitch(pattern, chunks: list[str], ends: list[np.ndarray], step: int) -> Iterator[tuple[str, np.ndarray]]:
    """Segments of a text and the ends of their pre-tokens, from its overlapping chunks and their boundaries.

    Chunk ``k`` begins at ``k * step``. The segments join to the text, and their pre-tokens to the text's.
    """
    last = len(chunks) - 1
    known = [np.append([0], e) + k * step for k, e in enumerate(ends)]  # a chunk's own start is a boundary to itself
    at, start, sure = 0, 0, known[0]

    def text_of(a: int, b: int) -> str:
        first, final = a // step, min((b - 1) // step, last)
        joined = "".join(c if k == final else c[:step] for k, c in enumerate(chunks[first : final + 1], first))
        return joined[a - first * step : b - first * step]

    def segment(stop: int) -> tuple[str, np.ndarray]:
        return text_of(start, stop), sure[(sure > start) & (sure <= stop)] - start

    while at < last:
        k = at + 1
        common = np.intersect1d(sure[sure >= k * step], known[k], assume_unique=True)
        if len(common):
            meet, to = int(common[0]), k
        else:
            meet, to, reach = -1, last, 1
            begin = int(sure[-1])
            while meet < 0:
                final = min(at + reach, last)
                stop = final * step + len(chunks[final])
                sets = {j: set(known[j].tolist()) for j in range(k, final + 1)}
                fresh = []
                for m in pattern.finditer(text_of(begin, stop)):
                    e = begin + m.end()
                    if e == stop and final < last:
                        break
                    fresh.append(e)
                    j = min(e // step, final)
                    if j >= k and e in sets[j]:
                        meet, to = e, j
                        break
                else:
                    break  # the end of the text
                reach *= 2
            sure = np.concatenate([sure, np.array(fresh, np.int64)])
            if meet < 0:
                break
        yield segment(meet)
        at, start = to, meet
        sure = known[to][known[to] >= meet]
    size = last * step + len(chunks[last])
    if start < size:
        yield segment(size)


def _whole(vocabulary, pattern: str):
    """Short texts: ids and decoded bytes in one go."""

    def run(batches):
        codec, find = Codec(vocabulary.value), regex.compile(pattern).findall
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = codec.encode(find(text.as_py() or ""))
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in ((0, pa.int64()), (1, pa.string()), (2, pa.string())))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return tidied(run)


def _chop(batches):
    """Overlapping chunks of long texts."""
    for batch in batches:
        for key, doc_id, text in zip(*batch.columns, strict=True):
            text = text.as_py()
            for k in range(-(-len(text) // CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()], pa.int64()), pa.array([doc_id.as_py()], pa.int64()), pa.array([k], pa.int64()),
                     pa.array([(k + 1) * CHUNK >= len(text)]), pa.array([text[k * CHUNK : (k + 1) * CHUNK + OVERLAP]])],
                    names=["key", "doc_id", "k", "last", "text"])


def _pretokenise(pattern: str):
    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            found = [boundaries(compiled, text.as_py(), last.as_py()).astype("<i4").tobytes()
                     for last, text in zip(batch.column(3), batch.column(4), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(4), pa.array(found, pa.binary())], names=["key", "doc_id", "k", "text", "ends"])

    return tidied(run)


def _stitched(pattern: str):
    def run(chunks: pa.Table) -> pa.Table:
        rows = sorted(chunks.select(["k", "text", "ends"]).to_pylist(), key=lambda r: r["k"])
        ends = [np.frombuffer(r["ends"], "<i4").astype(np.int64) for r in rows]
        found = list(stitch(regex.compile(pattern), [r["text"] for r in rows], ends, CHUNK))
        n = len(found)
        return pa.table({
            "key": pa.array([chunks["key"][0].as_py()] * n, pa.int64()), "doc_id": pa.array([chunks["doc_id"][0].as_py()] * n, pa.int64()),
            "k": pa.array(range(n), pa.int64()), "text": pa.array([t for t, _ in found], pa.string()),
            "ends": pa.array([e.astype("<i4").tobytes() for _, e in found], pa.binary())})

    return run


def _pieces(vocabulary):
    """Ids of stitched segments."""

    def run(batches):
        codec = Codec(vocabulary.value)
        for batch in batches:
            found = []
            for text, ends in zip(batch.column(3), batch.column(4), strict=True):
                text, ends = text.as_py(), np.frombuffer(ends.as_buffer(), "<i4").tolist()
                found.append(codec.encode(text[a:b] for a, b in zip([0, *ends], ends, strict=False)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], names=["key", "doc_id", "k", "ids"])

    return tidied(run)


def _digests(vocabulary):
    def run(pieces: pa.Table) -> pa.Table:
        tokens = [b""] * len(vocabulary.value)
        for token, rank in vocabulary.value.items():
            tokens[rank] = token
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for row in sorted(pieces.select(["k", "ids"]).to_pylist(), key=lambda r: r["k"]):
            n += len(row["ids"]) // 4
            ids.update(row["ids"])
            decoded.update(b"".join(map(tokens.__getitem__, np.frombuffer(row["ids"], "<u4").tolist())))
        return pa.table({"doc_id": pa.array([pieces["doc_id"][0].as_py()], pa.int64()), "n_tokens": pa.array([n], pa.int64()),
                         "ids_sha256": [ids.hexdigest()], "decoded_sha256": [decoded.hexdigest()]})

    return run


_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digests(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes of every row of ``docs`` (columns doc_id, text)."""
    small_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary_path))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    short = docs.where(~is_long).mapInArrow(_whole(vocabulary, pattern), _OUT)
    # the id only tells rows of one run apart; with the hash, rows never mix should a rerun number them anew
    keyed = docs.where(is_long).select(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "text").alias("key"), "doc_id", "text")
    chunks = keyed.mapInArrow(_chop, "key long, doc_id long, k long, last boolean, text string").repartition("key", "k")
    ends = chunks.mapInArrow(_pretokenise(pattern), "key long, doc_id long, k long, text string, ends binary")
    segments = ends.groupBy("key").applyInArrow(_stitched(pattern), "key long, doc_id long, k long, text string, ends binary")
    ids = segments.repartition("key", "k").mapInArrow(_pieces(vocabulary), "key long, doc_id long, k long, ids binary")
    return short.union(ids.groupBy("key").applyInArrow(_digests(vocabulary), _OUT))
