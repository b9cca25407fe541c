"""Hand-made cases of the training-data operators: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from statledger.llm import ann, bpe, chat, decontam, graph, jaccard, langid, pii, quality, urls, warc, words

TEXTS = "doc_id long, text string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# words and graph


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    texts = ["The the  end", "", None, "é" * 50 + " x", "a" * 300, "THE\tend\n", "x"]
    found = []
    for size in (words.PIECE, 16):
        monkeypatch.setattr(words, "PIECE", size)
        each = []
        for _, raw, offsets in words.slices(pa.array(texts), size):
            h, first = words.hashes(raw, offsets)
            each += [h[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        found.append(each)
    assert found[0] == found[1] and [len(x) for x in found[0]] == [3, 0, 0, 2, 1, 2, 1]
    assert found[0][0][0] == found[0][0][1] == found[0][5][0] and found[0][0][2] == found[0][5][1]


def test_components_of_random_graphs(spark):
    random.seed(3)
    pairs = [(i, i + 1) for i in range(40)] + [(random.randrange(100, 160), random.randrange(100, 160)) for _ in range(45)] + [(500, i) for i in range(400, 450)]
    parent = {x: x for p in pairs for x in p}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    found = graph.components(spark.createDataFrame(pairs, "a long, b long"))
    assert dict(map(tuple, found.collect())) == {x: top(x) for x in parent if any(x in p and p[0] != p[1] for p in pairs)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_take_no_round(spark, monkeypatch):
    rounds, stored = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name, where: rounds.append(name) or stored(df, name, where))
    stars = [(1, 5), (1, 9), (9, 1), (2, 4), (7, 7)]
    assert dict(map(tuple, graph.components(spark.createDataFrame(stars, "a long, b long")).collect())) == {1: 1, 5: 1, 9: 1, 2: 2, 4: 2}
    assert rounds == ["stars0"]
    for chain, root in (([(1, 2), (2, 3)], 1), ([(3, 5), (4, 5)], 3)):
        assert {r["component"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()} == {root}


# byte-level BPE


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_stitching_equals_one_pass():
    random.seed(1)
    pattern = regex.compile(public_tokenizers.PATTERN)
    for _ in range(150):
        text = "".join(random.choices(random.choice(["ab  \n", "a", "  ", "a1 .é'st\n\t", "aaaaaaaaaaaaaaaaaaa b"]), k=random.choice([10, 200, 700])))
        step, over = random.choice([(7, 3), (16, 8), (64, 16)])
        chunks = [text[k * step : (k + 1) * step + over] for k in range(-(-len(text) // step))]
        ends = [bpe.boundaries(pattern, c, (k + 1) * step >= len(text)) for k, c in enumerate(chunks)]
        found = list(bpe.stitch(pattern, chunks, ends, step))
        pieces = [t[a:b] for t, e in found for a, b in zip([0, *e.tolist()], e.tolist())]
        assert "".join(t for t, _ in found) == text and pieces == pattern.findall(text)


def test_merges_of_any_length(encoder):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    random.seed(2)
    for n in (1, 5, 300, 2000):
        piece = "".join(random.choices("abcdeftheandé ñ中😀", k=n)).encode()
        assert [ranks[t] for t in bpe._merge_short(piece, ranks)] == [ranks[t] for t in bpe._merge_long(piece, ranks)] == encoder._core_bpe.encode_single_piece(piece)


def test_bpe_cases(spark, monkeypatch, encoder):
    monkeypatch.setattr(bpe, "CHUNK", 64)
    monkeypatch.setattr(bpe, "OVERLAP", 16)
    texts = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "<|endoftext|> don't  \n\n x"), (5, "word and more. " * 40),
             (6, "a" * 1000), (7, " " * 333 + "b"), (8, "é😀 ñ 12345 " * 30), (9, "word and more. " * 40)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, key string, k int")
    found = rows(bpe.encode_digests(frame, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    expected = []
    for doc_id, text in texts:
        ids = encoder.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    assert bpe.encode_digests(frame.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


# nearest vectors


@pytest.mark.parametrize("power", [530, -560, 1000])
def test_neighbours_of_vectors_whose_squares_leave_the_range(spark, power):
    rng = np.random.default_rng(3)
    small = rng.normal(size=(600, 4)).clip(-7, 7)
    frame = spark.createDataFrame([(i, [float(x) for x in np.ldexp(v, power)]) for i, v in enumerate(small)], "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.nearest(frame, every=20, k=20).orderBy("query_id", "rank").collect()]
    assert len(found) == 600
    products = small[::20] @ small.T
    for i in range(30):
        products[i, 20 * i] = -np.inf
        assert [r[2] for r in found[20 * i : 20 * i + 20]] == list(np.argsort(-products[i], kind="stable")[:20])
    with np.errstate(over="ignore", under="ignore"):
        assert np.allclose([r[3] for r in found], [np.ldexp(small[q] @ small[v], 2 * power) for q, _, v, _ in found])


def _nearest(vectors, every, k):
    found = []
    for q, x in vectors:
        if q % every == 0:
            scored = sorted((-float((np.array(x) * np.array(y)).sum()), c) for c, y in vectors if c != q)
            found += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scored[:k])]
    return found


@pytest.mark.parametrize("hot", [0, 60])
def test_exact_search_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(ann, "LEAF", 4)
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(size=6).round(2)] if i >= hot else [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(150)]
    odd = [(1000, None), (1001, [0.0] * 6), (1002, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
           (1004, [float("inf")] * 6), (1005, [1.0]), (1006, []), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in [*vectors, *odd, vectors[7]]], "vec_id long, embedding array<double>, shard string")
    found = sorted(map(tuple, ann.nearest(frame, every=10, k=5, shard=40).collect()))
    expected = sorted(_nearest(vectors, 10, 5))
    assert [x[:3] for x in found] == [x[:3] for x in expected] and np.allclose([x[3] for x in found], [x[3] for x in expected])


@pytest.mark.parametrize("shard", [4096, 40])
def test_repeated_ids_with_other_vectors_take_one_place(spark, monkeypatch, shard):
    monkeypatch.setattr(ann, "LEAF", 4)
    rng = np.random.default_rng(24)
    vectors = [(7 if i < 50 else i, [float(x) for x in rng.normal(size=5) + (4 if i < 50 else 0)]) for i in range(150)]
    vectors += [(60, [float(x) for x in rng.normal(size=5)])]
    best = {}
    for q, x in vectors:
        for c, y in vectors:
            if q % 10 == 0 and c != q:
                best[q, c] = max(best.get((q, c), -np.inf), float((np.array(x) * np.array(y)).sum()))
    expected = []
    for q in sorted({q for q, _ in best}):
        expected += [(q, rank + 1, c) for rank, (_, c) in enumerate(sorted((-s, c) for (a, c), s in best.items() if a == q)[:5])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert sorted(tuple(r)[:3] for r in ann.nearest(frame, every=10, k=5, shard=shard).collect()) == expected


def _clusters(seed, n, centres, size=8):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size)) * 5
    return middle[np.arange(n) % centres] + rng.normal(size=(n, size)) * 0.2


@pytest.mark.parametrize("kind", ["float", "double"])
def test_regions_of_clusters_give_the_results_of_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "LEAF", 8)
    points = _clusters(5, 800, 16).astype(np.float32)
    points[40] *= np.float32(1e-3)  # a short query
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    vectors += [vectors[3]] * 400  # a third of all rows are one row
    frame = spark.createDataFrame([(*v, "x") for v in vectors], f"vec_id long, embedding array<{kind}>, side string")
    found = sorted(map(tuple, ann.nearest(frame, every=20, k=6, shard=30).collect()))
    expected = sorted(_nearest(vectors[:800], 20, 6))
    assert [x[:3] for x in found] == [x[:3] for x in expected] and np.allclose([x[3] for x in found], [x[3] for x in expected])


def test_vanishing_and_huge_vectors_side_by_side(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(300, 4))
    points[::40] *= 1e-250
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    found = sorted(map(tuple, ann.nearest(frame, every=20, k=5, shard=20).collect()))
    assert [x[:3] for x in found] == [x[:3] for x in sorted(_nearest([(i, v) for i, v in enumerate(points)], 20, 5))]


def test_queries_ask_few_shards_of_clustered_vectors(spark):
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(_clusters(7, 3200, 32))], "vec_id long, embedding array<double>")
    vectors = ann.usable(frame)
    norm = float(np.sqrt((_clusters(7, 3200, 32) ** 2).sum(1).max()))
    top = ann.top_of(vectors, 3200, 8, norm, 0, 100)
    shards = int(top.parts.sum())
    assert shards >= 24 and ann.asked_shards(vectors.withColumn("floor", F.lit(float("-inf"))), top, 0, 1.0, True).count() == 3200 * (shards - 1)
    exact = ann.nearest(frame, every=20, k=5, shard=100).where("rank = 5").select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    asked = ann.asked_shards(vectors.join(exact, "vec_id"), top, 0, 1.0, True).count()
    assert asked <= 160 * shards / 4


def test_relaxed_search_keeps_recall_on_the_sample(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    exact = {tuple(r)[:3:2] for r in ann.nearest(frame).collect()}
    relaxed = {tuple(r)[:3:2] for r in ann.nearest(frame, factor=1.3, shard=512).collect()}
    assert len(exact & relaxed) >= 0.9 * len(exact)


def test_few_vectors(spark):
    frame = spark.createDataFrame([(20, [1.0, 0.0]), (21, [2.0, 0.0]), (22, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(frame).orderBy("rank").collect()] == [(20, 1, 21, 2.0), (20, 2, 22, 2.0)]
    assert ann.nearest(frame.limit(0)).count() == 0


# quality


def test_quality_cases(spark):
    good = "a calm sentence about rivers and the people who live near them"
    docs = [(i, f"{good} {i}" if i % 2 else f"$$$ !! %%% ### {i} $$$ !! %%%") for i in range(60)] + [(None, "no id"), (100, None), (101, ""), (100, "again")]
    labels = [(i, i % 2) for i in range(60)] + [(1, 1), (None, 1), (500, 0), (3, None), (5, 7)]
    frame = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality.quality_scores(frame, marks).collect()
    assert len(found) == len(docs)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in found if r["doc_id"] is not None and r["doc_id"] < 60)
    assert len({r["score"] for r in found if r["doc_id"] == 101}) == 1 and [r["held_out"] for r in found if r["doc_id"] is None] == [False]
    assert {r["score"] for r in quality.quality_scores(frame, marks.limit(0)).collect()} == {0.5}
    assert {round(r["score"], 6) for r in quality.quality_scores(frame, marks.where("quality = 1")).collect()} == {
        round((n := sum(1 for i, y in {*labels} if y == 1 and i is not None and i < 60 and not _held(i)) + 1) / (n + 1), 6)}
    assert quality.quality_scores(frame.limit(0), marks).count() == 0
    assert quality.kept(frame, marks).columns == frame.columns


def _held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


# chats


def test_chat_cases(spark):
    turns = [
        (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (4, 0, "user", "hi"),
        (4, 1, "assistant", "no"), (5, 1, "assistant", "yes"), (5, 0, "user", "hi"), (5, 2, "user", "<|im_end|>x"), (6, 0, None, None), (6, 0, None, None),
        (None, 0, "user", "lost"), (7, None, "user", "late"), (7, 3, "user", "early"), (8, 0, "us", "erhi"), (9, 0, "", ""), (9, 1, "user", "z"),
    ]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, place int, s0 string")
    found = {r["conv_id"]: tuple(r)[1:] for r in chat.rendered(frame).collect()}
    assert set(found) == {4, 5, 7, 8, 9}
    assert found[5][2] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user\n< |im_end|>x<|im_end|>\n"
    assert found[7] == (2, 1, "<|im_start|>user\nearly<|im_end|>\n<|im_start|>user\nlate<|im_end|>\n")
    twice = frame.where("conv_id in (2, 3)")
    assert [tuple(r)[:3] for r in chat.rendered(twice).collect()] == [(2, 2, 2)]
    assert chat.rendered(frame.limit(0)).count() == 0


# urls


def test_url_cases(spark):
    given = [
        ("HTTP://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"), ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.org/casino", "x.org", "/casino", "org/", "allow"), ("http://casino-win.net/a", "casino-win.net", "/a", None, "block"),
        ("http://casinos.net/a", "casinos.net", "/a", None, "allow"), ("http://spam-farm.net", "spam-farm.net", "", None, "block"),
        ("http://spam.net/spam", "spam.net", "/spam", None, "allow"), ("http://a.com/fr/casino", "a.com", "/fr/casino", "com/fr/", "allow"),
        ("http://acom/fr/", "acom", "/fr/", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("://#x", "", "", None, "allow"), ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("a://b?c://casino/", "b", "", None, "block"), ("www.casino.com/a", "", "", None, "block"), ("http://x.net/search?q=porn", "x.net", "/search", None, "block"),
        ("http://x.net/go#xxx", "x.net", "/go", None, "block"), ("http://x.net/%63a%73ino/", "x.net", "/%63a%73ino/", None, "block"),
        ("http://x.net/?a=free%20pills", "x.net", "/", None, "block"), ("http://x.net/%ff%zz%4", "x.net", "/%ff%zz%4", None, "allow"),
        ("http://x.net/" + "a/" * 50_000 + "?bet&win", "x.net", "/" + "a/" * 50_000, None, "block"), ("http://é.com/de/?", "é.com", "/de/", "com/de/", "block"),
    ]
    frame = spark.createDataFrame([(i, g[0], "x") for i, g in enumerate(given)], "page_id long, url string, host string")
    found = {r["page_id"]: tuple(r)[1:5] for r in urls.judged(frame).collect()}
    assert found == {i: g[1:] for i, g in enumerate(given)}
    own = spark.createDataFrame([("Q", 0.5), ("f", 0.6), ("f", 0.1), ("x", None), ("", 3.0), (None, 2.0)], "term string, weight double")
    found = {r["page_id"]: (r["verdict"], r["n_soft"]) for r in urls.judged(frame, rules=(), vocabulary=own).collect()}
    assert found[0] == ("block", 2) and {v for i, (v, _) in found.items() if i} == {"allow"}
    assert all(v == ("allow", 0) for v in ((r["verdict"], r["n_soft"]) for r in urls.judged(frame, (), own.limit(0)).collect()))
    assert urls.judged(frame.limit(0)).count() == 0 and urls.judged(frame.union(frame)).count() == 2 * len(given)


# languages


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(langid, "_f", np.float64)
    rng = np.random.default_rng(0)
    w = langid.start_weights(3, rng, 4)
    codes = rng.integers(0, 6, (7, 5))
    codes[5:, 2] = 256
    language = rng.integers(0, 3, 5)
    g, _ = langid.gradients(w, codes, language)
    for name, value in w.items():
        place = (0, int(codes[3, 1])) if name.endswith("table") else tuple(rng.integers(0, s) for s in value.shape)
        kept, losses = value[place], []
        for step in (1e-5, -1e-5):
            value[place] = kept + step
            losses.append(langid.gradients(w, codes, language)[1])
        value[place] = kept
        assert g[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-9)


def test_language_cases(spark):
    kinds = {"aa": "tak tok tik ", "bb": "zuzu mumu zozo "}
    docs = [(i, kinds[lang] * 30, lang) for i, lang in enumerate(["aa", "bb"] * 40)] + [
        (200, None, "aa"), (201, "", "bb"), (202, "123 !!", "aa"), (203, "zozo", None), (None, "tok tik", "aa"), (204, kinds["aa"] * 900, None)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, letter string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.languages(frame).collect()}
    assert all(found[i][0] == lang for i, _, lang in docs[:80]) and found[204][0] == "aa" and found[203][0] == "bb" and found[None][0] == "aa"
    assert found[200] == found[201] == found[202] == ("und", 0.0)
    assert {r["lang_pred"] for r in langid.languages(frame.where("lang is null")).collect()} == {"und"}
    assert langid.languages(frame.limit(0)).count() == 0


# decontamination


def test_common_subsequences():
    random.seed(5)
    for _ in range(100):
        a, b = (np.array(random.choices(range(6), k=random.randrange(0, 90)), np.uint64) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common(a, b) == table[-1][-1]


def test_rows_for_the_driver_are_small(spark):
    from types import SimpleNamespace

    import pyarrow as pa

    matrix = np.arange(3000 * 264, dtype=np.float64).reshape(3000, 264)
    passage = pa.RecordBatch.from_pydict({"terms": pa.array([[0, 2999]], pa.list_(pa.int32())), "weights": pa.array([[1.0, 2.0]])})
    blocks = [b.to_pylist()[0] for b in decontam._product(SimpleNamespace(value=matrix))([passage])]
    assert max(len(b["sums"]) for b in blocks) <= decontam.TERM_BYTES
    whole = np.concatenate([np.frombuffer(b["sums"]).reshape(-1, 264) for b in sorted(blocks, key=lambda b: b["block"])])
    assert np.array_equal(whole[[0, 1, 2999]], np.outer([1, 0, 2], matrix[0] + 2 * matrix[2999]))
    counts = np.array([0, 1, 5, 10**6, 2**44], np.int64)
    part = pa.RecordBatch.from_pydict({"part": pa.array([3], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})
    row, = next(jaccard._classes([part])).to_pylist()
    assert row["part"] == 3 and np.frombuffer(row["classes"], np.uint16).tolist() == [0, 1500, 3877, 29897, 65535]
    frame = spark.createDataFrame([("a b c d e f",), ("a b c d e",), (None,)], "text string")
    order = jaccard.rarity(frame, 5)
    assert order.dtype == np.uint16 and sorted(order[order > 0].tolist()) == [1500, 2377] and len(order) == jaccard.BUCKETS


def test_latent_space_equals_svd(spark):
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(30, 12)) @ rng.normal(size=(12, 50))
    vectors = [(list(range(50)), [float(x) for x in row]) for row in matrix]
    frame = spark.createDataFrame(vectors, "terms array<int>, weights array<double>").repartition(3)
    space = decontam.latent_space(frame, 50, vectors, 30)
    assert np.allclose(matrix @ space @ space.T, matrix, atol=1e-6)


def test_decontamination_cases(spark):
    random.seed(7)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    item = [word() for _ in range(30)]
    fill = lambda n: " ".join(word() for _ in range(n))
    swapped = [word() if i % 4 == 1 else w for i, w in enumerate(item)]
    docs = [(1, f"{fill(200)} {' '.join(item)} {fill(200)}"), (2, f"{fill(90)} {' '.join(swapped)}"), (3, fill(400)), (4, None), (5, ""), (6, " ".join(item).upper()),
            (None, " ".join(item)), (7, " ".join(item[:6]) + fill(50)), (8, f"{fill(3000)} {' '.join(item)}"), (1, f"{fill(20)} {' '.join(item)}")]
    docs += [(i, fill(60)) for i in range(20, 120)]
    frame = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, cover double")
    bench = spark.createDataFrame([(9, " ".join(item)), (9, " ".join(item)), (10, None), (11, ""), (None, fill(25)), (12, fill(200))], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame, bench).collect()}
    assert found == {(i, 9) for i in (1, 2, 6, None, 8)}
    kept = decontam.clean(frame, bench)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 7, *range(20, 120)}
    assert decontam.contaminated(frame, bench.limit(0)).count() == 0 and decontam.contaminated(frame.limit(0), bench).count() == 0


def test_passage_of_a_third_of_all_documents(spark):
    random.seed(12)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    item, fill = " ".join(word() for _ in range(30)), lambda: " ".join(word() for _ in range(50))
    docs = spark.createDataFrame([(i, f"{fill()} {item} {fill()}" if i % 3 == 0 else fill()) for i in range(90)], TEXTS)
    found = decontam.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(0, 90, 3))


def test_benchmark_in_blocks(spark, monkeypatch):
    random.seed(8)
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 400)
    items = [(i, " ".join("".join(random.choices("abcdefghij", k=6)) for _ in range(20))) for i in range(8)]
    docs = spark.createDataFrame([(i, f"other words here {t} and there") for i, t in items] + [(100 + i, f"plain {i} text") for i in range(90)], TEXTS)
    found = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(8)}


def test_orthogonal_passages_keep_the_space_small(spark, monkeypatch):
    """More orthogonal passages than the largest rank: the space stays bounded, and copies and paraphrases are found by overlap."""
    random.seed(23)
    monkeypatch.setattr(decontam, "RANK", 4)
    monkeypatch.setattr(decontam, "MOST", 8, raising=False)
    monkeypatch.setattr(decontam, "TERM_BLOCK", 100, raising=False)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    items = [(i, [word() for _ in range(40)]) for i in range(40)]
    docs = [(i, [word() for _ in range(30)] + [word() if j % 3 == 1 else w for j, w in enumerate(item)]) for i, item in items]
    docs += [(100 + i, [word() for _ in range(50)]) for i in range(60)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], TEXTS)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert [index[-1].shape[1] for index in decontam.indexes(frame, bench)] == [8]
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame, bench).collect()} == {(i, i) for i in range(40)}
    monkeypatch.setattr(decontam, "CELLS", 20_000, raising=False)
    parts = list(decontam.indexes(frame, bench))
    assert len(parts) == 2 and all(len(index[0]) * len(index[1]) <= 20_000 for index in parts)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame, bench).collect()} == {(i, i) for i in range(40)}


@pytest.mark.parametrize("copies", ["whole", "likely"])
@pytest.mark.parametrize("many", [1, 90])
def test_paraphrases_of_a_hot_passage(spark, copies, many):
    """The verdict on a paraphrase is the same whatever a third of the documents, or the only other one, hold."""
    random.seed(22)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    item, fill = [word() for _ in range(32)], lambda n: [word() for _ in range(n)]
    sure = [word() if i % 3 == 1 else w for i, w in enumerate(item)]
    likely = [word() if i < 24 and i % 3 else w for i, w in enumerate(item)]
    held = {"whole": item, "likely": likely}[copies]
    docs = [(i, fill(30) + (held if i % 3 == 0 else []) + fill(30)) for i in range(many)]
    docs += [(200, fill(40) + sure + fill(40)), (201, fill(40) + likely), (202, fill(40) + item[:8] + fill(40))]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], TEXTS)
    found = decontam.contaminated(frame, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in found) == [*range(0, many, 3), 200, 201]


def test_copies_of_sparse_and_short_passages(spark):
    """Four words that tell something among 64, two at most in any window; items of one and two words among plain and heavy words."""
    random.seed(21)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    common = [word() for _ in range(40)]
    plain = lambda n: [random.choice(common) for _ in range(n)]
    sparse, other = plain(64), [word() for _ in range(60)]
    for at in (5, 25, 45, 60):
        sparse[at] = word()
    items = [(1, sparse), (2, [word()]), (3, [word(), word()]), (4, other)]
    docs = [(1000 + i, plain(200)) for i in range(300)]
    docs += [(200 + i, plain(100 + i) + sparse + plain(100)) for i in range(16)]
    docs += [(400 + i, plain(50 + i) + item + plain(50)) for i, (_, item) in enumerate(items[1:3])]
    docs += [(300 + i, plain(50 + i) + other[:14] + item + other[20:34] + plain(50)) for i, (_, item) in enumerate(items[1:3])]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], TEXTS)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame, bench).collect()}
    assert {x for x in found if x[1] < 4} == {*((200 + i, 1) for i in range(16)), (300, 2), (301, 3), (400, 2), (401, 3)}


# Jaccard join


def _components(docs, size=5, percent=80):
    sets, own = {}, {}
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        found = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        sets[doc_id, text] = found
        own[doc_id] = doc_id
    keys = [k for k in sets if k[0] is not None]

    def top(x):
        while own[x] != x:
            x = own[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a[0]), top(b[0])))
                own[y] = x
    return sorted(((d, len(sets[d, t]), None if d is None else top(d)) for d, t in docs), key=str)


def test_jaccard_cases(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "UNIT", 4)
    random.seed(9)
    base = [f"w{i}" for i in range(80)]
    docs = [(0, " ".join(base))]
    for i in range(1, 40):  # a group of near copies, some too far from each other
        copy = list(base)
        for _ in range(random.randrange(0, 4)):
            copy[random.randrange(80)] = f"x{random.randrange(1000)}"
        docs.append((i, " ".join(copy)))
    passage = " ".join(f"p{i}" for i in range(60))  # a passage that many share
    docs += [(100 + i, passage + " " + " ".join(f"q{i}_{j}" for j in range(random.choice([5, 12, 60])))) for i in range(25)]
    docs += [(200, None), (201, ""), (202, "  \n"), (203, "one two"), (204, "ONE two"), (205, "one two three"), (206, "a b c d e"), (207, "A b c d e"),
             (208, "É b c d e f"), (209, "é b c d e f"), (None, " ".join(base)), (210, "r s t u v"), (210, "r s t u v"), (211, " ".join(base) + " end")]
    frame = spark.createDataFrame([(*d, 3, "x") for d in docs], "doc_id long, text string, n long, node string")
    found = rows(jaccard.jaccard_components(frame))
    assert found == _components(docs)
    kept = jaccard.one_of_each(frame)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == frame.columns
    assert sorted(i for i in ids if i is not None) == sorted({c for _, n, c in found if c is not None}) and ids.count(None) == 1
    assert jaccard.jaccard_components(frame.limit(0)).count() == 0


def test_documents_of_one_passage_do_not_meet(spark, monkeypatch):
    """Documents of which 85 % are one shared passage are no links; the rows that are brought together grow no faster than the documents."""
    monkeypatch.setattr(jaccard, "HOT", 8)
    made, real = [], jaccard.met

    def counted(mixed, percent):
        made.append(real(mixed, percent).count())
        return real(mixed, percent)

    monkeypatch.setattr(jaccard, "met", counted)
    passage = " ".join(f"p{i}" for i in range(214))
    for many in (60, 120):
        docs = [(i, passage + " " + " ".join(f"q{i}_{j}" for j in range(36))) for i in range(many)] 
        rest = passage + " " + " ".join(f"r{i}" for i in range(300))
        docs += [(1000, rest), (1001, rest + " end")]
        found = jaccard.jaccard_components(spark.createDataFrame(docs, TEXTS)).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in found) == [*((i, i) for i in range(many)), (1000, 1000), (1001, 1000)]
    assert made[1] <= 2.2 * made[0] + 50


def test_one_of_each_keeps_other_texts_of_an_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abc"]
    docs = [(1, texts[0], 5), (1, texts[1], 4), (1, texts[0] + " end", 3), (2, texts[1], 2), (3, texts[2], 9), (3, texts[2], 8), (4, "", 1), (4, "", 1), (None, texts[0], 0)]
    kept = jaccard.one_of_each(spark.createDataFrame(docs, "doc_id long, text string, rows long")).collect()
    first = [tuple(r) for r in kept if r["text"].startswith("a") and r["doc_id"]]
    assert len(first) == 1 and first[0] in docs
    assert sorted((tuple(r) for r in kept if tuple(r) not in first), key=str) == sorted([(1, texts[1], 4), (3, texts[2], 8), (4, "", 1), (4, "", 1), (None, texts[0], 0)], key=str)


def test_trie_equals_counting():
    rng = np.random.default_rng(10)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    sets += [s[: max(len(s) - 2, 1)] for s in sets[:20]]
    trie = jaccard.Trie()
    for i, s in enumerate(sets):
        trie.add(i, s)
    for s in sets:
        expected = {i for i, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))}
        assert set(trie.similar(s, 80)) == expected


# personal data


def test_personal_data_cases(spark):
    texts = [
        (1, "a@b.c_d@e.f x@y@z.com"), (2, "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255"), (3, "card 4111 1111 1111 1111, 4111 1111 1111 1112"), (4, "+1 (234) 567-8901 + 1 1 +12"),
        (5, None), (6, ""), (7, "é😀 foo@bar.com... 😀 a.b@c-d.e"), (8, "+1+2+3 " * 2000), (9, "a@b.co " * 2000), (10, "a" * 100_000 + "@"), (None, "x@y.zz"), (1, "a@b.c_d@e.f x@y@z.com"),
    ]
    texts += [(100 + i, f'token = "{hashlib.md5(str(i).encode()).hexdigest()}" and page room{i} of 2024') for i in range(40)]
    frame = spark.createDataFrame([(*t, "keep", 7) for t in texts], "doc_id long, text string, _base string, row int")
    found = {r["doc_id"]: r for r in pii.personal_data(frame).collect()}
    spans = {i: found[i]["spans"] for i in found}
    assert spans[1] == "email:0:5,email:5:11,email:14:21" and spans[2] == "ip:0:7,ip:8:15,ip:26:41" and spans[3] == "card:5:24"
    assert spans[4] == "phone:0:17" and spans[5] == spans[6] == "" and spans[7] == "email:3:14,email:20:29" and found[9]["n_email"] == 2000
    assert found[5]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(spans[100 + i] == "secret:9:41" for i in range(40))
    red = {(r["doc_id"], r["text"], r["_base"], r["row"]) for r in pii.redacted(frame).collect()}
    assert (7, "é😀 [EMAIL]... 😀 [EMAIL]", "keep", 7) in red and (5, None, "keep", 7) in red and (4, "[PHONE] + 1 1 +12", "keep", 7) in red
    assert pii.personal_data(frame.limit(0)).count() == 0 and pii.personal_data(frame.union(frame)).count() == 2 * len(texts)


def test_reliabilities_find_the_bad_labeler():
    random.seed(11)
    counts: dict[str, int] = {}
    for _ in range(3000):
        truth = random.random() < 0.4
        votes = "".join("2" if random.random() < 0.2 else str(int(truth if random.random() < right else not truth)) for right in (0.95, 0.9, 0.85, 0.5))
        counts[votes] = counts.get(votes, 0) + 1
    belief, table = pii.reliabilities(counts)
    right = [(labeler[1][1] + labeler[0][0]) / 2 for labeler in table]
    assert right[0] > right[2] > right[3] and abs(right[3] - 0.4) < 0.1 and belief["1110"] > 0.9 > 0.1 > belief["0001"]


# WARC


def test_warc_cases(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 4000)
    big, other = "é<p>" * 400, "x" * 999
    pages = [(1, "http://a/\r\nb", big), (2, None, big), (3, "http://c", big), (3, "http://c2", big), (4, "u", other), (5, "u", other), (6, "u", None), (7, "u", ""), (None, "u", big),
             (8, "u", "y" * 300_000)]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, key int")
    found = rows(warc.round_trip(frame))
    expected = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        refers = 3 if html == big and page_id in (1, 2) else None
        expected.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers))
    assert found == sorted(expected, key=str)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_archives_are_verified():
    import io

    good = b"".join(warc.record(i, "u", b"payload %d" % i * 1000, None) for i in range(5))
    assert [f["warc-record-id"] for f in warc.records(io.BytesIO(good).read)] == [f"<urn:page:{i}>" for i in range(5)]
    with pytest.raises(warc.Malformed, match="truncated"):
        list(warc.records(io.BytesIO(good[:-20]).read))
    with pytest.raises(warc.Malformed):
        list(warc.records(io.BytesIO(good[:300] + b"\x00\x01\x02" + good[303:]).read))
    with pytest.raises(warc.Malformed, match="digest"):
        bad = warc.zlib.compressobj(6, warc.zlib.DEFLATED, 31)
        raw = warc.zlib.decompress(warc.record(1, "u", b"payload", None), 31).replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n")
        list(warc.records(io.BytesIO(bad.compress(raw) + bad.flush()).read))


def test_a_rare_language_keeps_its_teachers(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 7, "rare").otherwise("common").alias("lang"))
    ids = {r[0] for r in langid.teachers(frame, rows=100, least=3).collect()}
    assert len([i for i in ids if i % 1000 == 7]) >= 3 and 100 <= len(ids) <= 106
    assert langid.teachers(frame.limit(0)).count() == 0


def test_the_quality_sample_is_bounded_by_bytes(spark):
    frame = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("\u00e9"), 50).alias("text"))
    order = [r[0] for r in frame.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    for most, taken in ((1, 1), (100, 1), (101, 2), (1000, 10), (10**6, 50)):
        assert sorted(r[0] for r in quality.within_bytes(frame, most).collect()) == sorted(order[:taken])
    assert quality.within_bytes(frame.limit(0), 10).count() == 0
