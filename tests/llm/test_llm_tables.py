"""Registered training-data queries against SQL, brute force, original libraries and held-out labels on the small sample."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences

import __spark_entry__ as entry_point
import corpus_pipeline
from statledger.llm import bpe, decontam, jaccard, pii, quality
from statledger.llm import oracles, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert not differences(QUERIES[name](spark, FOLDER), con, ORACLES[name])


def test_registered():
    found = entry_point.queries()
    assert {*QUERIES, "pipeline"} <= set(found) and set(ORACLES) <= set(entry_point.oracle_sql())
    assert [f"op{n}" for n in range(1, 14)] == [name.split("_")[0] for name in QUERIES]


def test_bpe_equals_the_original_library(spark, documents, encoder):
    found = {r["doc_id"]: r for r in QUERIES["op1_byte_bpe"](spark, FOLDER).collect()}
    assert len(found) == len(documents)
    for doc_id, text in documents:
        ids = encoder.encode_ordinary(text or "")
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_scores"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(tested) > 50 and np.mean([r["predicted"] == labels[r["doc_id"]] for r in tested]) > 0.93


def test_languages_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_languages"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in tested]) > 0.97


def test_benchmark_hits_equal_shared_runs(spark, con, documents):
    """In the sample, items are planted whole; a document holds one if it holds all its runs of five words."""
    words = lambda text: re.findall(r"\w+", text.lower())
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    items = [(i, runs(words(t))) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    expected = set()
    for doc_id, text in documents:
        own = runs(words(text or ""))
        expected |= {(doc_id, i) for i, r in items if r and len(r & own) >= 0.5 * len(r)}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_benchmark_hits"](spark, FOLDER).collect()}
    assert found == expected and expected


def _base(text):
    spans = []
    for number, (kind, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(digits)))
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".") if p.isdigit()),
                    "card": 12 <= len(digits) <= 19 and luhn % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                spans.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}", m.end()))
    return sorted(spans)


def test_personal_data_equals_brute_force(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op9_personal_data"](spark, FOLDER).collect()}
    total = 0
    for doc_id, text in documents:
        spans, row = _base(text or ""), found[doc_id]
        total += len(spans)
        assert row["base_sha256"] == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [sum(s[1] == n for s in spans) for n in range(4)]
        assert {s[2] for s in spans} <= set(row["spans"].split(","))
    assert total


def test_pipeline_stages(spark, encoder):
    """Each stage against its operator's own results or brute force, on the stage's input."""
    from statledger.llm.shared import stored, table

    docs = table(spark, FOLDER, "documents")
    columns, texts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), name)
        if name == "quality":
            keep = {r["doc_id"] for r in quality.quality_scores(before, table(spark, FOLDER, "labels")).where("predicted = 1").collect()}
            assert {r["doc_id"] for r in docs.collect()} == keep
        elif name == "near_duplicates":
            keep = {r["component_id"] for r in jaccard.jaccard_components(before).collect()}
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(keep) and len(keep) < before.count()
        elif name == "decontaminate":
            hit = {r["doc_id"] for r in decontam.contaminated(before, table(spark, FOLDER, "benchmark")).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()} - hit
        elif name == "personal_data":
            old, texts = {r["doc_id"]: r["text"] for r in before.collect()}, {r["doc_id"]: r for r in docs.collect()}
            assert set(old) == set(texts) and not any(_base(r["text"]) for r in texts.values())
            assert all(r["n_chars"] == len(r["text"]) for r in texts.values() if r["text"] != old[r["doc_id"]])
            assert all(texts[i]["text"] == t for i, t in old.items() if not re.search("[0-9@]", t))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    for row in docs.collect():
        ids = encoder.encode_ordinary(texts[row["doc_id"]]["text"])
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert docs.count() == len(texts)
    assert pii.KINDS[-1] == "secret"


def test_cosine_search_finds_what_every_subsequence_finds(spark, documents):
    """Recall of the latent search against subsequences of every window, on the sample and on paraphrases of its items; and no search beside it."""
    import random

    import pyarrow as pa

    from statledger.llm.words import slices

    docs, bench = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "benchmark"))
    (made,) = decontam.indexes(docs, bench)
    cosine, every = decontam.Index(*made), decontam.Index(*made)
    assert not len(cosine.outside)
    every.outside, every.anchors = np.arange(len(every.items)), [np.unique(t) for t in every.own]
    random.seed(4)
    texts = [t or "" for _, t in documents]
    other = " ".join(texts[:100]).split()
    for item in bench.collect() * 4:
        share, base = random.choice([0.5, 0.6, 0.7, 0.8, 0.9]), random.choice(texts).split()
        said, at = [w if random.random() < share else random.choice(other) for w in item["text"].split()], random.randrange(len(base) + 1)
        texts.append(" ".join(base[:at] + said + base[at:]))
    found = []
    for index in (cosine, every):
        found.append({(row + r, p) for row, raw, offsets in slices(pa.array(texts, pa.large_string()), decontam.PIECE) for r, p, *_ in index.search(raw, offsets)})
    assert len(found[1]) > 80 and found[0] <= found[1] and len(found[0]) >= 0.9 * len(found[1])
