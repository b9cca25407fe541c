"""Personal data by fixed formats, and by weak supervision over further candidates; built-in DataFrame functions only.

Method. Four fixed formats (email, ip, card, phone) give the base spans. Further candidates are runs of at least ``SHORTEST`` letters, digits and
signs with a digit in them. Labelers vote on each for, against or not at all: by format (known formats, key shapes, number shapes),
by gazetteer (words that announce private or harmless values) and by context (assignment, address, quotes). The numbers of candidates with
each pattern of votes and shape are counted over all documents; on these counts expectation-maximisation estimates every labeler's
reliability and each pattern's probability of being private. With them a logistic classifier over shape and context learns the final
decision, which is applied to each candidate as an expression. It adds spans of kind ``secret`` that overlap no base span.

Positions. Matches and the gaps between them have known lengths; their running sums are the places, in code points.

Defined results. A null text counts as empty: no spans. Every row comes back, repeated rows and null ids included. Without
candidates nothing is added. In redacted text, overlapping spans become one mark, of the kind that begins first. Empty tables give no rows.
Other columns are not looked at.

At scale. Two passes without shuffling texts. Only vote patterns and shapes are grouped: at most 3**7 * 5 * 4 * 3 of them, whatever the
input, reach the driver, where the model is fitted. The formats match in time linear in the text: loops don't backtrack, and a start inside a
run that failed is not tried again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The contract's formats; ``\\G`` and the look-behind only keep the engine from trying again inside a run.
FORMATS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*FORMATS, "secret")
SHORTEST, CONTEXT, BLOCK, ROUNDS = 8, 32, 512, 40
CANDIDATE = f"[A-Za-z0-9_+/=-]{{{SHORTEST},}}+"
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_IP = rf"^(?:{_PART}|0++)(?:\.(?:{_PART}|0++)){{3}}$"
#: Words that announce private and harmless values.
PRIVATE = "token|key|apikey|secret|password|passwd|pwd|auth|bearer|credential|account|konto|cuenta|compte|iban|card|passport|ssn|pin"
HARMLESS = "page|seite|chapter|kapitel|version|isbn|issn|doi|figure|fig|table|year|section|article|volume|vol|http|https|www"


_PLACES = "array<struct<start:int,end:int>>"


def _empty(kind: str) -> Column:
    return F.from_json(F.lit("[]"), kind)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where ``body`` uses it for each element of an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(matches: Column, gaps: Column) -> Column:
    """Start and end of each match, from its text and the lengths of the gaps; in blocks, so that long lists stay cheap."""

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + step["size"]
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    def one(done: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(done["at"].alias("at"), _empty(_PLACES).alias("out")), add)
        return _let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(done["out"], i["out"]).alias("out")))

    def run(steps: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), _empty(_PLACES).alias("out")), one)["out"]

    return _let(F.transform(matches, lambda m, i: F.struct(F.element_at(gaps, i + 1).alias("gap"), F.length(m).alias("size"))), run)


def _matched(pattern: str, when: Column, each: Callable[[Column, Column, Column], Column], kind: str) -> Column:
    """``each`` (text, gap before, place) of every match of a pattern; none where ``when`` is not true."""

    def split(m: Column) -> Column:
        return F.when(F.size(m) > 0, _let(F.split("_text", pattern, -1), lambda g: _let(F.transform(g, F.length), lambda n: _let(
            _places(m, n), lambda p: F.transform(p, lambda x, i: each(F.element_at(m, i + 1), F.element_at(g, i + 1), x)))))).otherwise(_empty(kind))

    found = F.when(when, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return _let(found, split)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (start, kind, end) and ``_more``: text, left context and place of each candidate, and whether it meets a base span."""
    docs = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    digit, at, plus = F.col("_text").rlike("[0-9]"), F.contains("_text", F.lit("@")), F.contains("_text", F.lit("+"))
    guard = {"email": at, "ip": digit, "card": digit, "phone": digit & plus}

    def base(number: int, kind: str) -> Column:
        spans = _matched(FORMATS[kind], guard[kind], lambda text, _, p: F.struct(
            p["start"].alias("start"), F.lit(number).alias("kind"), p["end"].alias("end"), _valid(kind, text).alias("valid")),
            "array<struct<start:int,kind:int,end:int,valid:boolean>>")
        return F.transform(F.filter(spans, lambda s: s["valid"]), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    def candidates(spans: Column) -> Column:
        return _matched(CANDIDATE, digit, lambda text, gap, p: F.struct(
            text.alias("text"), F.substring(gap, -CONTEXT, CONTEXT).alias("left"), p["start"].alias("start"), p["end"].alias("end"),
            F.exists(spans, lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"])).alias("known")),
            "array<struct<text:string,left:string,start:int,end:int,known:boolean>>")

    docs = docs.withColumn("_base", F.array_sort(F.concat(*[base(n, k) for n, k in enumerate(FORMATS)])))
    return docs.withColumn("_more", F.filter(_let(F.col("_base"), candidates), lambda c: c["text"].rlike("[0-9]")))


def _vote(for_it: Column | None, against: Column | None) -> Column:
    """1 for, 0 against, 2 no vote."""
    out = F.lit("2")
    if against is not None:
        out = F.when(against, "0").otherwise(out)
    return out if for_it is None else F.when(for_it, "1").otherwise(out)


def _votes(c: Column) -> list[Column]:
    text, left = c["text"], c["left"]
    mixed = text.rlike("[A-Z]") & text.rlike("[a-z]") & (F.length(text) >= 20)
    return [
        _vote(c["known"], None),
        _vote(text.rlike("^[0-9a-fA-F]{20,}$") | mixed, text.rlike("^[A-Za-z]+-?[0-9]{1,4}$")),
        _vote(text.rlike("^[0-9]{12,19}$"), text.rlike("^[0-9]{1,8}$|^[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}$")),
        _vote(left.rlike(rf"(?i)(?<![A-Za-z])(?:{PRIVATE})[^A-Za-z0-9]{{0,6}}$"), None),
        _vote(None, left.rlike(rf"(?i)(?<![A-Za-z])(?:{HARMLESS})[^A-Za-z0-9]{{0,6}}$")),
        _vote(left.rlike("[=:] ?[\"']?$"), left.rlike("[/.@]$")),
        _vote(text.rlike("(?:[a-z][0-9]|[0-9][a-z]).*(?:[a-z][0-9]|[0-9][a-z])"), text.rlike("^[a-z]{4,}[0-9]?[a-z]*$")),
    ]


def _shape(c: Column) -> list[Column]:
    """Length class, share of digits and surroundings of a candidate."""
    text, left = c["text"], c["left"]
    size, digits = F.length(text), F.length(F.regexp_replace(text, "[^0-9]", ""))
    long = F.when(size < 12, 0).when(size < 16, 1).when(size < 20, 2).when(size < 32, 3).otherwise(4)
    share = F.when(digits == size, 3).when(digits * 2 > size, 2).when(digits * 5 > size, 1).otherwise(0)
    before = F.when(left.rlike("[\"'=:]$"), 2).when(left.rlike("[/.@]$"), 1).otherwise(0)
    return [x.cast("int") for x in (long, share, before)]


_SIZES = (5, 4, 3)


def reliabilities(counts: dict[str, float], rounds: int = ROUNDS) -> tuple[dict[str, float], list[list[list[float]]]]:
    """Probability of being private of each pattern of votes, and each labeler's vote probabilities by class.

    Expectation-maximisation over patterns ("0", "1", "2" for each labeler) with their numbers, begun at the share of votes for.
    """
    if not counts:
        return {}, []
    width = len(next(iter(counts)))
    belief = {v: (v.count("1") + 0.5) / (v.count("1") + v.count("0") + 1) for v in counts}
    table: list[list[list[float]]] = []
    for _ in range(rounds):
        weight = [sum(n * (1 - belief[v]) for v, n in counts.items()), sum(n * belief[v] for v, n in counts.items())]
        table = [[[1.0, 1.0, 1.0] for _ in (0, 1)] for _ in range(width)]
        for v, n in counts.items():
            for i, x in enumerate(v):
                table[i][0][int(x)] += n * (1 - belief[v])
                table[i][1][int(x)] += n * belief[v]
        table = [[[x / sum(row) for x in row] for row in labeler] for labeler in table]
        prior = math.log((weight[1] + 1) / (weight[0] + 1))
        for v in counts:
            z = prior + sum(math.log(table[i][1][int(x)] / table[i][0][int(x)]) for i, x in enumerate(v))
            belief[v] = 1 / (1 + math.exp(-max(min(z, 500), -500)))
    return belief, table


def classifier(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 300) -> list[list[float]]:
    """Weights of a logistic classifier over classes of shape; rows of shape, number and probability of being private."""
    weights = [[0.0] * n for n in _SIZES]
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(rounds):
        moves = [[0.0] * n for n in _SIZES]
        for shape, n, belief in rows:
            z = sum(weights[i][x] for i, x in enumerate(shape))
            error = n * (belief - 1 / (1 + math.exp(-max(min(z, 500), -500)))) / total
            for i, x in enumerate(shape):
                moves[i][x] += error
        weights = [[w + 4.0 * (m - 1e-3 * w) for w, m in zip(*pair, strict=True)] for pair in zip(weights, moves, strict=True)]
    return weights


def fit(docs: DataFrame) -> list[list[float]]:
    """The final classifier, from the votes on all candidates of all documents."""
    one = _found(docs.select("text")).select(F.explode("_more").alias("c"))
    keyed = one.select(F.concat(*_votes(F.col("c"))).alias("votes"), F.array(*_shape(F.col("c"))).alias("shape"))
    rows = keyed.groupBy("votes", "shape").count().collect()
    counts: dict[str, float] = {}
    for row in rows:
        counts[row["votes"]] = counts.get(row["votes"], 0.0) + row["count"]
    belief, _ = reliabilities(counts)
    shapes: dict[tuple[int, ...], list[float]] = {}
    for row in sorted(rows, key=lambda r: (r["votes"], r["shape"])):
        held = shapes.setdefault(tuple(row["shape"]), [0.0, 0.0])
        held[0] += row["count"]
        held[1] += row["count"] * belief[row["votes"]]
    return classifier([(shape, n, private / n) for shape, (n, private) in sorted(shapes.items())])


def _private(c: Column, weights: list[list[float]]) -> Column:
    parts = [F.element_at(F.array(*map(F.lit, w)), x + 1) for w, x in zip(weights, _shape(c), strict=True)]
    return sum(parts[1:], parts[0]) > 0


def with_spans(docs: DataFrame, weights: list[list[float]]) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: start, number in ``KINDS`` and end of base and of all spans, in order."""
    found, columns = _found(docs), docs.columns
    added = F.filter("_more", lambda c: ~c["known"] & _private(c, weights))
    added = F.transform(added, lambda c: F.struct(c["start"].alias("start"), F.lit(len(FORMATS)).alias("kind"), c["end"].alias("end")))
    return found.select(*columns, "_text", "_base", F.array_sort(F.concat("_base", added)).alias("_spans"))


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = with_spans(docs, fit(docs))

    def count(number: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{k}") for n, k in enumerate(FORMATS)]
    return rows.select("doc_id", *counts, F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("_spans").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns, their spans replaced by marks such as ``[EMAIL]``. Rows without spans keep their text."""
    # the row is carried whole, so that none of its names can clash
    rows = with_spans(docs.select(F.struct("*").alias("row"), "text"), fit(docs))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        before = F.col("_text").substr(done["at"] + 1, s["start"] - done["at"])
        mark = F.element_at(marks, s["kind"] + 1)
        out = F.when(fresh, F.concat(done["out"], F.array(before, mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = _let(F.aggregate("_spans", start, step), lambda done: F.concat(
        F.array_join(done["out"], ""), F.col("_text").substr(done["at"] + 1, F.length("_text"))))
    new = F.when(F.size("_spans") > 0, text).otherwise(F.col("text")).alias("text")
    return rows.select(*[new if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
