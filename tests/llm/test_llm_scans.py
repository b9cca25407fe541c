"""Licence scan, vector codes and source divergence against brute force and in odd cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from statledger.llm import codes, divergence, licenses, oracles, queries

FOLDER = "/root/testdata/sf0.01"


# licence scan


def _words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _places(words):
    return [(i, label) for phrase, label in licenses.PHRASES for n in [len(phrase.split())] for i in range(len(words) - n + 1)
            if words[i : i + n] == phrase.split()]


def _longest(words, templates):
    """Longest run of a template that ends at each word, by looking at every run."""
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((n for n in range(1, end + 1) if tuple(words[end - n : end]) in runs), default=0) for end in range(1, len(words) + 1)]


def test_matching_statistics_equal_brute_force():
    random.seed(5)
    for _ in range(60):
        templates = [random.choices(range(4), k=random.randint(1, 9)) for _ in range(3)]
        automaton = licenses.Automaton(templates)
        words = random.choices(range(5), k=30)
        found = list(automaton.statistics(words))
        assert [n for _, n in found] == _longest(words, templates)
        for end, (state, n) in enumerate(found, 1):
            run = words[end - n : end]
            places = {(s, j) for s, t in enumerate(templates) for j in range(n, len(t) + 1) if t[j - n : j] == run} if n else set()
            assert set(automaton.places[state]) == places or not n


def test_places_equal_brute_force_on_the_sample(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op11_license_scan(spark, FOLDER).collect()
    assert len(rows) == len(texts) and any(r["n_base"] for r in rows)
    for r in rows:
        words = _words(texts[r["doc_id"]])
        places = sorted(_places(words))
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_licence_spans(spark):
    grant, bsd = licenses.TEMPLATES[1][0], licenses.TEMPLATES[2][0]
    changed = grant.replace("obtaining a copy of this software", "who gets this program").upper()
    half = " ".join(grant.split()[:30])
    long = "plain words follow here. " * 60_000
    texts = [(1, None), (2, ""), (2, ""), (3, "x" + grant), (4, "Intro. " + changed + " end"), (5, long + bsd + " and " + long), (None, "Apache\nLICENSE, cc-by"),
             (7, "permission is hereby granted"), (8, "mit license mit licenses MIT  licensé MIT LICENSE"), (9, half), (10, grant + " " + grant)]
    frame = spark.createDataFrame([(i, t, "a", 1) for i, t in texts], "doc_id long, text string, labels string, score int")
    found = {(r["doc_id"], r["n_words"]): r for r in licenses.license_scan(frame).collect()}
    assert licenses.license_scan(frame).count() == len(texts)
    assert (found[1, 0]["labels"], found[1, 0]["score"], found[1, 0]["first_word"], found[1, 0]["spans"]) == ([], 0.0, None, [])
    row = {i: r for (i, _), r in found.items()}
    n = len(_words(grant))
    span = row[4]["spans"][0]
    assert row[4]["labels"] == ["mit"] and span["first_word"] == 1 and span["end_word"] == len(_words(changed)) + 1
    assert n - 12 <= span["covered"] < n and row[4]["score"] == pytest.approx(span["covered"] / n)
    span = [s for s in row[5]["spans"] if s["label"] == "bsd"][0]
    assert (span["first_word"], span["covered"], span["cover"]) == (240_000, len(_words(bsd)), 1.0) and row[5]["labels"] == ["bsd"]
    assert row[None]["base_labels"] == row[None]["labels"] == ["apache", "cc-by"] and row[None]["score"] == 1.0
    assert row[7]["labels"] == [] and 0 < row[7]["score"] < 0.1
    assert (row[8]["n_base"], row[8]["first_word"], row[8]["last_word"]) == (2, 0, 6)
    assert row[9]["labels"] == ["mit"] and row[9]["n_base"] == 0
    assert row[10]["spans"][0]["covered"] == n and row[10]["spans"][0]["end_word"] == n
    assert licenses.license_scan(frame.limit(0)).count() == 0
    own = licenses.license_scan(frame.where("doc_id = 8"), templates=(), phrases=(("licenses mit", "own"),)).first()
    assert (own["n_base"], own["base_labels"]) == (1, ["own"])


def test_chain_keeps_order_and_gaps():
    assert licenses.chained([(5, 5, 5), (12, 10, 5)]) == (10, 0, 12)
    assert licenses.chained([(5, 5, 5), (6 + licenses.GAP + 5, 10, 5)]) == (5, 0, 5)
    assert licenses.chained([(5, 10, 5), (12, 5, 5)]) == (5, 0, 5)
    assert licenses.chained([(5, 5, 5), (8, 8, 6)]) == (8, 0, 8)
    assert licenses.chained([]) == (0, 0, 0)


# vector codes


def _coded(rows, entries, rounds):
    """Codes by looking at every entry, with Python's whole numbers."""
    kept = [(i, x, label) for i, x, label in rows if x is not None and all(c is not None and np.isfinite(c) for c in x)]
    width = 4 * max(1, -(-max(len(x) for _, x, _ in kept) // 4))
    whole = [[int(np.floor(c * 1024)) for c in x] + [0] * (width - len(x)) for _, x, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    piece, codes_of, errors, books = width // 4, [[] for _ in kept], [0] * len(kept), []
    for p in range(4):
        parts = [w[p * piece : (p + 1) * piece] for w in whole]
        book = [parts[k] for k in order]
        for turn in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book)) for x in parts]
            if turn < rounds:
                for i in range(len(book)):
                    own = [x for x, (_, n) in zip(parts, near) if n == i]
                    if own:
                        book[i] = [sum(c) // len(own) for c in zip(*own)]
        books.append(book)
        for k, (d, i) in enumerate(near):
            codes_of[k].append(i)
            errors[k] += d
    total = collections.Counter()
    for (_, _, label), e in zip(kept, errors):
        total[label] += e
    h = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in cs), e, total[label], h) for (i, _, label), cs, e in zip(kept, codes_of, errors)), key=str)


@pytest.mark.parametrize("entries", [5, 40])
def test_codes_equal_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(codes, "ENTRIES", entries)
    monkeypatch.setattr(codes, "STEP", 3)
    monkeypatch.setattr(codes, "HEAVY", 1)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.choice([-1.0, -0.5, -0.0001, 0.0, 0.3, 2.0], 8)], int(i % 5) if i % 7 else None) for i in range(200)]
    rows += [(500, [1.0] * 8, 1)] * 60 + [(3, [0.25] * 8, 2), (None, [0.1] * 8, None), (600, [], 1), (601, [1.0, -2.0, 0.001], 4), (602, [0.0] * 8, 9)]
    odd = [(700, None, 1), (701, [1.0, None], 1), (702, [float("nan")] * 8, 1), (703, [1.0] * 7 + [float("inf")], 1)]
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows + odd], "vec_id long, embedding array<double>, label int, code string, error int")
    found = codes.vector_codes(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == _coded(rows, entries, codes.ROUNDS)


def test_search_is_exact_with_ties():
    rng = np.random.default_rng(2)
    entries = rng.integers(-500, 500, (200, 4))
    entries[50:60] = entries[0]
    parts = np.concatenate([rng.integers(-600, 600, (500, 4)), entries])
    code, error = codes.Orchard(entries).nearest(parts)
    every = ((parts[:, None, :] - entries[None]) ** 2).sum(2)
    assert (code == every.argmin(1)).all() and (error == every.min(1)).all()


def test_codes_of_large_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>, label string"
    found = codes.vector_codes(spark.createDataFrame([(1, [1e300, -1e300], "a"), (2, [1e308, 0.0], "a"), (3, [1.0, 0.5], None)], schema)).collect()
    assert len(found) == 3 and all(r["error"] >= 0 for r in found)
    assert codes.vector_codes(spark.createDataFrame([], schema)).count() == 0
    assert codes.vector_codes(spark.createDataFrame([(1, None, "a")], schema)).count() == 0


# source divergence


def _diverged(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower)), lang or "", source or "") for t, lang, source in rows]
    groups = sorted({(lang, source) for _, lang, source in docs})
    held, count = collections.Counter(), collections.Counter()
    for words, lang, source in docs:
        held.update((lang, w) for w in set(words))
        count.update((lang, source, w) for w in words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (x, w), n in held.items() if x == lang and n >= least)
        own = [s for x, s in groups if x == lang]
        total = {s: sum(count[lang, s, w] for w in kept) for s in own}
        rate = lambda n, all_n: 1 + 10**9 * (n + 5) // (all_n + 5 * len(kept))  # noqa: B023, E731
        p = {(s, w): rate(count[lang, s, w], total[s]) for s in own for w in kept}
        q = {w: rate(sum(count[lang, s, w] for s in own), sum(total.values())) for w in kept}
        for s in own:
            found = {"pair": [(-sum(abs(p[s, w] - p[o, w]) for w in kept), o.encode()) for o in own if o != s],
                     "term": [(q[w] - p[s, w], w.encode()) for w in kept if count[lang, s, w] and p[s, w] > q[w]]}
            for part, values in found.items():
                ranked = list(enumerate(sorted(values), 1))
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in (ranked[:top] if part == "term" else ranked)]
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 5])
def test_divergence_equals_brute_force(spark, monkeypatch, bits):
    """With digests of 5 bits nearly all terms share theirs with others."""
    monkeypatch.setattr(divergence, "CELLS", 64)
    monkeypatch.setattr(divergence, "HELD", 50)
    random.seed(6)
    words = [f"{a}{b}" for a in ("der", "é", "Äh", "z", "no", "q") for b in ("", "x", "ß", "Aa", "日")] + ["common"] * 10
    rows = [(" ".join(random.choices(words, k=random.randint(0, 25))), random.choice(["en", "fr"]), random.choice(["a", "b", "c"])) for _ in range(80)]
    rows += [("common words-and 5numbers", "en", "hot")] * 60 + [(None, None, None), ("", "", "b"), ("once", "xx", "a"), ("", "xx", "b"), (None, "en", "silent")]
    rows.append(("tail " * 70_000 + "common", "fr", "b"))
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "text string, lang string, source string, term string, rank int")
    found = divergence.source_divergence(frame, least=5, top=4, bits=bits).collect()
    assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found) == _diverged(rows, 5, 4)
    assert [r for r in found if r["part"] == "term"] and any(r["value"] == 0 for r in found)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_new_queries_have_sql():
    assert {"op12_vector_codes", "op13_source_divergence"} <= set(oracles.oracle_sql())
