"""Core operators, with the hot-key paths forced by tiny limits and checked against brute force."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from frames import frame, ts, tuples
from pyspark.sql import functions as F

from statledger.functions.timeparts import ts_lit
from statledger.operators import bounds, counters, joins, ordered, rollup, timewindow

AT = "2024-01-31 00:00:00"


def samples(seed: int, hot_share: float = 0.4, n: int = 600):
    """Random samples of a few keys, one of them hot, with bursts, gaps, ties in time and undated rows."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else rng.choice(["a", "b", None])
        if rng.random() < 0.3:
            at = start + timedelta(days=3, seconds=rng.randrange(30))  # burst
        else:
            at = start + timedelta(seconds=rng.randrange(20 * 86400))
        rows.append((key, None if rng.random() < 0.02 else at, i, rng.randrange(1000)))
    return rows


def brute_previous(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1] or datetime.min, r[2]))
        for i, r in enumerate(group):
            out[r[2]] = (group[i - 1][2] if i else None, i == len(group) - 1)
    return out


@pytest.mark.parametrize("hot_rows", [None, 10_000, 40, 5])
@pytest.mark.parametrize("seed", [1, 2])
def test_previous_row_is_the_same_however_hot_keys_are_sliced(spark, seed, hot_rows):
    rows = samples(seed)
    df = spark.createDataFrame(rows, "k STRING, at TIMESTAMP_NTZ, id BIGINT, v BIGINT").repartition(3)
    got = ordered.with_previous(df, ["k"], ["at", "id"], {"prev_id": "id"}, is_last="newest", hot_rows=hot_rows)
    assert got.columns == ["k", "at", "id", "v", "prev_id", "newest"]
    assert {r["id"]: (r["prev_id"], r["newest"]) for r in got.collect()} == brute_previous(rows)


@pytest.mark.parametrize("least", [1, 7, 100])
def test_previous_row_is_the_same_however_many_rows_a_range_holds(spark, monkeypatch, least):
    monkeypatch.setattr(ordered, "RANGE_ROWS", least)
    rows = samples(3)
    df = spark.createDataFrame(rows, "k STRING, at TIMESTAMP_NTZ, id BIGINT, v BIGINT").repartition(3)
    got = ordered.with_previous(df, ["k"], ["at", "id"], {"prev_id": "id"}, is_last="newest", hot_rows=5)
    assert {r["id"]: (r["prev_id"], r["newest"]) for r in got.collect()} == brute_previous(rows)


def test_low_limits_do_not_make_a_range_of_a_few_rows(spark, monkeypatch):
    """Ranges follow the rows, not the limit that makes a key hot; the default limit deals as before."""
    dealt, deal = [], ordered.deal_by_range
    monkeypatch.setattr(ordered, "deal_by_range", lambda rows, keys, order, ranges: dealt.append(ranges) or deal(rows, keys, order, ranges))
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), ts_lit(AT).alias("at"), "id")
    got = ordered.with_previous(df, ["k"], ["at", "id"], {"p": "id"}, hot_rows=20)
    assert dealt == [2] and got.filter("p is null").count() == 7 and got.filter("p = id - 7").count() == 2993
    assert [ordered.ranges_of(n, 20) for n in (100_000, 6_000_000)] == [2, 120]
    assert ordered.ranges_of(50_000_000, ordered.HOT_ROWS) == 80


def test_facts_without_a_key_stay_out_of_the_join(spark):
    facts = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 100), ("b", 101)], "k STRING, i INT")
    got = joins.lookup_join(facts, spark.createDataFrame([("a", 1), (None, 2)], "k STRING, n INT"), ["k"], "left", hot_rows=10)
    assert tuples(got) == tuples(facts.select("k", "i", F.when(F.col("k") == "a", 1).alias("n")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnotnull(k") >= 2 and "isnull(k" in plan


@pytest.mark.parametrize("burst_ids", [1, 900])
def test_bursts_within_one_second_are_parted(spark, burst_ids):
    """90 % of a key in one second, in equal rows or not, and undated rows: no range is above twice the mean."""
    at = datetime(2024, 1, 15, 10)
    rows = [("hot", at, i % burst_ids) for i in range(900)] + [("hot", at + timedelta(days=i - 50), 1000 + i) for i in range(95)]
    rows += [("hot", None, 2000 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "k STRING, at TIMESTAMP_NTZ, id INT").repartition(3)
    sizes = [r["count"] for r in ordered.deal_by_range(df, ["k"], ["at", "id"], 10).groupBy("__range").count().collect()]
    assert sum(sizes) == len(rows) and len(sizes) == 10 and max(sizes) <= 2 * len(rows) / 10
    got = ordered.with_previous(df, ["k"], ["at", "id"], {"p_at": "at", "p": "id"}, is_last="newest", hot_rows=80).collect()
    expected, last = [], (None, None)
    for k, t, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or at, r[2])):
        expected.append((k, t, i, *last))
        last = (t, i)
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(expected, key=str) and sum(r["newest"] for r in got) == 1


def test_hot_key_with_one_timestamp(spark):
    df = spark.createDataFrame([("k", datetime(2024, 1, 1), i) for i in range(50)], "k STRING, at TIMESTAMP_NTZ, id INT")
    got = ordered.with_previous(df, ["k"], ["at", "id"], {"p": "id"}, hot_rows=5)
    assert {r["id"]: r["p"] for r in got.collect()} == {i: (i - 1 if i else None) for i in range(50)}


@pytest.mark.parametrize("cell_days", [1, 5, 400])
def test_span_join_equals_a_plain_range_join(spark, cell_days):
    rng, start = random.Random(7), datetime(2023, 12, 20)

    def when():
        return None if rng.random() < 0.05 else start + timedelta(hours=rng.randrange(24 * 60))

    facts = [(rng.choice(["hot", "hot", "a", None]), when(), i) for i in range(300)]
    spans = [(rng.choice(["hot", "a", "b", None]), when(), when(), i) for i in range(40)] + [("a", start, start, 99)]
    want = sorted(
        (f[2], s[3]) for f in facts for s in spans
        if None not in (f[0], f[1], s[1], s[2]) and f[0] == s[0] and s[1] <= f[1] < s[2]
    )
    f = spark.createDataFrame(facts, "k STRING, at TIMESTAMP_NTZ, i INT")
    s = spark.createDataFrame(spans, "k STRING, low TIMESTAMP_NTZ, high TIMESTAMP_NTZ, j INT")
    got = joins.span_join(f, s, ["k"], "at", "low", "high", cell_days=cell_days)
    assert got.columns == ["k", "at", "i", "low", "high", "j"]
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want and want
    assert joins.span_join(f.limit(0), s, ["k"], "at", "low", "high").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("weight", [None, "n"])
def test_lookup_join_equals_a_plain_join(spark, how, weight):
    rng = random.Random(3)
    facts = [(rng.choice(["hot"] * 5 + ["a", "b", "gone", None]), i) for i in range(300)]
    counts = defaultdict(int)
    for k, _ in facts:
        counts[k] += 1
    f = spark.createDataFrame(facts, "k STRING, id INT")
    look = spark.createDataFrame([(k, counts[k], f"name {k}") for k in ("hot", "a", "b", "unused")], "k STRING, n INT, name STRING")
    got = joins.lookup_join(f, look, ["k"], how, weight=weight, hot_rows=50)
    assert tuples(got, "k", "id", "n", "name") == tuples(f.join(look, ["k"], how), "k", "id", "n", "name")


def test_counter_restarts(spark):
    df = frame(
        spark, "k STRING, at TIMESTAMP_NTZ, boot TIMESTAMP_NTZ, x BIGINT",
        ("a", ts("2024-01-01 02:00"), ts("2024-01-01 00:00"), 10),
        ("a", ts("2024-01-01 04:00"), ts("2024-01-01 00:00"), 25),
        ("a", ts("2024-01-01 06:00"), ts("2024-01-01 05:00"), 30),  # restarted, already above the old value
        ("a", ts("2024-01-01 08:00"), ts("2024-01-01 05:00"), 31),
        ("b", ts("2024-01-01 08:00"), ts("2024-01-01 05:00"), 7),
    )
    got = counters.counter_delta(df, ["k"], "at", ["x"], epoch="boot")
    assert tuples(got, "k", "x", "x_delta", "seconds") == [
        ("a", 10, 10, 7200), ("a", 25, 15, 7200), ("a", 30, 30, 3600), ("a", 31, 1, 7200), ("b", 7, 7, 10800),
    ]


def test_a_step_keeps_what_it_reads_several_times(spark):
    """The last samples and the marked batch are joined once, not for each of their uses."""
    kind, kept = "k STRING, at TIMESTAMP_NTZ, x BIGINT", []
    last = frame(spark, kind, ("a", ts("2024-01-01 02:00"), 5), ("b", ts("2024-01-01 02:00"), 3))
    batch = frame(spark, kind, ("a", ts("2024-01-01 03:00"), 9), ("a", ts("2024-01-01 01:00"), 4), ("c", ts("2024-01-01 03:00"), 1))
    plain = [tuples(df) for df in counters.counter_step(batch, last, ["k"], "at", ["x"])]
    got = counters.counter_step(batch, last, ["k"], "at", ["x"], keep=lambda df: kept.append(df.persist()) or kept[-1])
    assert [tuples(df) for df in got] == plain and len(plain[0]) == 3 and len(plain[1]) == 3
    plan = got[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(kept) == 2 and plan.count("InMemoryRelation") >= 3
    for df in kept:
        df.unpersist()


@pytest.mark.parametrize("policy, fallen, seconds", [("cumulative", 4, 60), ("previous", 9, 0), ("zero", 0, 60)])
def test_counter_fall_policies(spark, policy, fallen, seconds):
    df = frame(
        spark, "k STRING, at TIMESTAMP_NTZ, x BIGINT", ("a", ts("2024-01-01 00:00"), 9), ("a", ts("2024-01-01 00:01"), 4),
    )
    got = counters.counter_delta(df, ["k"], "at", ["x"], on_reset=policy, first="zero")
    assert tuples(got, "x", "x_delta", "seconds") == [(4, fallen, seconds), (9, 0, 0)]


def test_increments_within_an_epoch_add_up(spark):
    rng = random.Random(5)
    rows, expected = [], 0
    for key in range(20):
        at, boot, x = datetime(2024, 1, 1), datetime(2023, 12, 31, 23), 0
        for _ in range(30):
            at += timedelta(minutes=120)
            if rng.random() < 0.2:
                boot, x = at - timedelta(minutes=rng.randrange(1, 100)), 0
            step = rng.randrange(50)
            x, expected = x + step, expected + step
            rows.append((key, at, boot, x))
    df = spark.createDataFrame(rows, "k INT, at TIMESTAMP_NTZ, boot TIMESTAMP_NTZ, x BIGINT")
    got = counters.counter_delta(df, ["k"], "at", ["x"], epoch="boot", hot_rows=10)
    assert got.agg(F.sum("x_delta")).first()[0] == expected


def test_truncated_mean_can_flag_ordinary_rows(spark):
    df = frame(spark, "k STRING, v INT", *[("job", 100)] * 8, ("job", 101), ("once", 5), *[("flat", 7)] * 3)
    b = bounds.sigma_bounds(df, ["k"], "v")
    assert sorted(r["k"] for r in b.collect()) == ["flat", "job"]
    assert tuples(bounds.outliers(df, b, ["k"], "v"), "k", "v") == [("job", 101)]
    assert tuples(bounds.outliers(df, b, ["k"], "v", hot_rows=2), "k", "v") == [("job", 101)]


def test_small_samples_stay_inside_the_widened_bounds(spark):
    rng = random.Random(7)
    rows = [(k, rng.randrange(1, 500)) for k in range(200) for _ in range(rng.randrange(2, 11))]
    df = spark.createDataFrame(rows, "k INT, v INT")
    b = bounds.sigma_bounds(df, ["k"], "v")
    j = df.join(b, "k").filter(
        (F.col("v") < F.col("LowerBound") - 1e-9) | (F.col("v") >= F.col("UpperBound") + 1 + 1e-9)
    )
    assert j.count() == 0


def test_sample_size_counts_null_values(spark):
    df = frame(spark, "k STRING, v INT", ("a", 4), ("a", None), ("n", None), ("n", None))
    assert tuples(bounds.sigma_bounds(df, ["k"], "v"), "k", "Mean", "SampleSize") == [("a", 4, 2), ("n", None, 2)]


def test_window_sees_a_weekly_snapshot_once(spark):
    stamps = ["2024-01-24 02:23:59", "2024-01-24 02:24:00", "2024-01-24 02:24:01", AT, "2024-01-31 00:00:01", None]
    df = frame(spark, "d TIMESTAMP_NTZ", *[(ts(s),) for s in stamps])
    assert [r["d"] for r in timewindow.recent(df, "d", 6.9, AT).orderBy("d").collect()] == [ts(stamps[2]), ts(AT)]


def test_window_prunes_partitions(spark, tmp_path):
    df = frame(spark, "d TIMESTAMP_NTZ, snapshot_date STRING", *[
        (ts(f"2024-01-{d:02d} 12:00"), f"2024-01-{d:02d}") for d in range(1, 31)
    ])
    df.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).write.partitionBy("snapshot_date").parquet(str(tmp_path / "h"))
    got = timewindow.recent(spark.read.parquet(str(tmp_path / "h")), "d", 6.9, AT)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "PushedFilters: [IsNotNull(d), GreaterThan(d" in plan
    assert got.count() == 7


def test_retention_keeps_undated_rows_and_is_idempotent(spark):
    df = frame(spark, "Date TIMESTAMP_NTZ, v INT", (ts("2023-01-01"), 1), (ts("2024-01-21"), 2), (None, 3))
    kept = timewindow.apply_retention(df, 10, AT)
    assert tuples(kept, "v") == [(2,), (3,)]
    assert tuples(timewindow.apply_retention(kept, 10, AT), "v") == [(2,), (3,)]


def test_delete_keeps_unknowns(spark):
    df = frame(spark, "v INT", (-1,), (1,), (None,))
    assert tuples(timewindow.drop_where(df, F.col("v") < 0)) == [(1,), (None,)]


def test_seed_is_idempotent(spark):
    have = frame(spark, "k STRING, v STRING", ("a", "mine"))
    seeds = frame(spark, "k STRING, v STRING", ("a", "default"), ("b", "default"))
    once = joins.seed_missing(have, seeds, ["k"])
    assert tuples(once) == [("a", "mine"), ("b", "default")]
    assert tuples(joins.seed_missing(once, seeds, ["k"])) == tuples(once)


def test_upsert_stamps_touched_rows_only(spark):
    old = frame(spark, "k STRING, v STRING, Date TIMESTAMP_NTZ", ("a", "1", ts("2023-01-01")), ("b", "2", ts("2023-01-01")))
    changes = frame(spark, "k STRING, v STRING", ("b", None), ("c", "3"))
    got = joins.upsert(old, changes, ["k"], "Date", F.lit(AT).cast("timestamp_ntz"))
    assert tuples(got) == [("a", "1", ts("2023-01-01")), ("b", None, ts(AT)), ("c", "3", ts(AT))]


def test_update_takes_one_row_per_key_and_keeps_unmatched(spark):
    target = frame(spark, "k STRING, v INT", ("a", 1), ("b", 2))
    source = frame(spark, "k STRING, v INT, d TIMESTAMP_NTZ", ("a", 8, ts("2024-01-01")), ("a", 9, ts("2024-01-02")))
    assert tuples(joins.update_from(target, source, ["k"], ["v"], newest_by="d")) == [("a", 9), ("b", 2)]


def test_pivot_defaults_to_zero(spark):
    df = frame(spark, "s STRING, name STRING, v BIGINT", ("x", "a", 5), ("x", "a", 9), ("x", "b", -3), ("y", "c", 1))
    wanted = {n: F.col("name") == n for n in ("a", "b")}
    assert tuples(counters.pivot_counters(df, ["s"], "name", "v", wanted)) == [("x", 9, 0), ("y", 0, 0)]


def test_ratio_skips_missing_and_zero_bases(spark):
    df = frame(spark, "s STRING, name STRING, v BIGINT", ("x", "p", 1), ("x", "q", 3), ("y", "p", 1), ("y", "q", 0), ("z", "p", 1))
    got = counters.counter_ratio(df, ["s"], "v", F.col("name") == "p", F.col("name") == "q", "r")
    assert [(r["s"], float(r["r"])) for r in got.collect()] == [("x", 0.333)]


def test_rate_steps(spark):
    df = frame(spark, "n BIGINT, s BIGINT", (100, 120), (7, 1), (5, 59))
    assert tuples(df.select("s", counters.per_minute(F.col("n"), F.col("s")).alias("r"))) == [(1, 700), (120, 50), (59, 5)]


def test_usage_share_needs_reads(spark):
    df = frame(
        spark, "t STRING, s BIGINT, c BIGINT, u BIGINT", ("read", 1, 2, 0), ("written", 0, 0, 5), ("mixed", 3, 0, 1),
        ("mixed", None, None, None),
    )
    got = rollup.usage_share(df, ["t"], "s", "c", "u").select(
        "t", "TotalAccesses", *[F.col(c).cast("double") for c in ("PercentAccessesAreWrites", "PercentReadsAreIndexSeeks")]
    )
    assert tuples(got) == [("mixed", 4, 25.0, 100.0), ("read", 3, 0.0, 33.33)]


def test_single_value_ignores_nulls(spark):
    df = frame(spark, "k STRING, v INT", ("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("d", 5), ("d", None))
    assert tuples(rollup.single_valued(df, ["k"], "v")) == [("a",), ("d",)]


def test_duration_buckets(spark):
    label, order = rollup.duration_bucket(F.col("m"))
    df = frame(spark, "m BIGINT", (999_999,), (1_000_000,), (4_999_999,), (5_000_000,), (30_000_000,), (None,))
    assert [tuple(r) for r in df.select(label, order).collect()] == [
        ("1 Sec", 1), ("5 Sec", 2), ("5 Sec", 2), ("30 Sec", 3), ("> 30 Sec", 4), ("> 30 Sec", 4),
    ]


def test_joined_text_is_distinct_and_sorted(spark):
    df = frame(spark, "k STRING, c STRING", ("t", "b"), ("t", "a"), ("t", "b"), ("u", None), ("u", "x&<y>"))
    assert tuples(rollup.joined_text(df, ["k"], "c", "w")) == [("t", "a;b"), ("u", "x&<y>")]


def test_top_k_cuts_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    per = ordered.top_k_per(df, ["k"], 2, [F.desc("id")])
    assert tuples(per, "k", "id") == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    assert per._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    top = ordered.top_k(df, 2, [F.desc("id")])
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
