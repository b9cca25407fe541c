"""Joins against dimensions, bounds and update sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, hot_keys, latest_per


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    weight: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join facts to a table with one row per key, whatever the spread of the keys.

    Lookup rows of keys with more than ``hot_rows`` facts number at most
    ``rows / hot_rows``; they are broadcast and their facts are not shuffled at
    all. The remaining keys are all small and take the ordinary join. ``weight``
    names a lookup column that already holds the fact count of the key; without
    it the facts are counted first.
    """
    keys = list(keys)
    rest_columns = [c for c in lookup.columns if c not in keys]
    every = facts
    if how == "left":  # facts without a key match nothing, and a shuffle would put all of them into one task
        facts = facts.filter(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    if weight is None:
        heavy = F.broadcast(hot_keys(facts, keys, hot_rows).select(*keys))
        hot = F.broadcast(lookup.join(heavy, keys, "left_semi"))
        # a hot key need not be in the lookup, so the heavy list alone decides who goes where
        hot_part = facts.join(heavy, keys, "left_semi").join(hot, keys, how)
        cold_facts = facts.join(heavy, keys, "left_anti")
    else:
        # One struct for both sides of the split keeps their plans equal, so the lookup is computed once.
        packed = F.struct(*rest_columns).alias("__hot")
        hot = F.broadcast(lookup.filter(F.col(weight) > hot_rows).select(*keys, packed))
        marked = facts.join(hot, keys, "left")
        hot_part = marked.filter(F.col("__hot").isNotNull()).select(*facts.columns, "__hot.*")
        cold_facts = marked.filter(F.col("__hot").isNull()).select(*facts.columns)
    cold_part = cold_facts.join(lookup, keys, how)
    out = hot_part.unionByName(cold_part)
    if how == "left":
        out = out.unionByName(every.filter(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))), allowMissingColumns=True)
    return out.select(*every.columns, *rest_columns)


CELL_DAYS = 28


def _cell(ts, days: int):
    """Number of the stretch of ``days`` days that holds a time."""
    return F.floor(F.unix_date(F.col(ts).cast("date")) / days)


def span_join(
    facts: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, low: str, high: str, *, cell_days: int = CELL_DAYS
) -> DataFrame:
    """Facts with the columns of each span of their key that holds their time: ``low <= at < high``.

    Both sides are joined by key and cell of time: a fact lies in one cell, a span is repeated for each cell it
    touches, and the exact limits are part of the join. So a fact meets only the spans of its own time, a key's facts are
    spread over its cells, and Spark may split what is still uneven. Facts or spans without a key, time or limit match nothing.
    """
    cells = spans.filter(F.col(low) < F.col(high)).withColumn(
        "__cell", F.explode(F.sequence(_cell(low, cell_days), _cell(high, cell_days)))
    ).alias("s")
    placed = facts.withColumn("__cell", _cell(at, cell_days)).alias("f")
    same = reduce(lambda a, b: a & b, (F.col(f"f.`{k}`") == F.col(f"s.`{k}`") for k in [*keys, "__cell"]))
    within = (F.col(f"f.`{at}`") >= F.col(f"s.`{low}`")) & (F.col(f"f.`{at}`") < F.col(f"s.`{high}`"))
    extra = [F.col(f"s.`{c}`") for c in spans.columns if c not in keys]
    return placed.join(cells, same & within).select(*[F.col(f"f.`{c}`") for c in facts.columns], *extra)


NAMES = "UTF8_LCASE_RTRIM"


def name_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on names as databases compare them by default: whatever their case and trailing blanks.

    The names of the left side come back. Spark joins by the sort keys of the names, so the plan is that of any equal join.
    """
    rest = [c for c in right.columns if c not in keys]
    other = right.select(*[F.collate(k, NAMES).alias(f"__{k}") for k in keys], *rest)
    same = reduce(lambda a, b: a & b, (F.collate(F.col(k), NAMES) == F.col(f"__{k}") for k in keys))
    return left.join(other, same, how).select(*left.columns, *([] if how in ("left_semi", "left_anti") else rest))


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    newest_by: str | None = None,
    keep_old: bool = True,
) -> DataFrame:
    """Overwrite ``columns`` of the rows that have a match; the others keep their value.

    A NULL in the source leaves the old value, unless ``keep_old`` is false.

    The source is first cut to one row per key (the newest by ``newest_by``, else
    the greatest values), so a key that matches twice still gives one row.
    """
    keys, columns = list(keys), list(columns)
    ts = newest_by or columns[0]
    one = latest_per(source.select(*dict.fromkeys([*keys, ts, *columns])), keys, ts)
    new = one.select(*keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = target.join(new, keys, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    present = set(target.columns)
    out = [
        (
            F.when(hit, F.coalesce(F.col(f"__new_{c}"), F.col(c)) if keep_old else F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in present
            else F.col(f"__new_{c}").alias(c)
        )
        if c in columns
        else F.col(c)
        for c in dict.fromkeys([*target.columns, *columns])
    ]
    return joined.select(*out)


def seed_missing(existing: DataFrame, seeds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the seed rows whose key is not there yet; existing rows are never changed."""
    fresh = seeds.dropDuplicates(list(keys)).join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert(
    old: DataFrame, changes: DataFrame, keys: Sequence[str], stamp: str, as_of_col, *, newest_by: str | None = None
) -> DataFrame:
    """Apply changed rows by key, add new ones and stamp every touched row.

    A changed row replaces all its non-key values. Of several changes to a key the newest by ``newest_by`` counts,
    else the one with the greatest values.
    """
    keys = list(keys)
    values = [c for c in old.columns if c not in keys and c != stamp]
    one = changes.select(*dict.fromkeys([*keys, *([newest_by] if newest_by else []), *values]))
    one = latest_per(one, keys, newest_by or values[0]) if newest_by or values else one.distinct()
    tagged = one.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__hit"))
    joined = old.join(tagged, keys, "full_outer")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return joined.select(
        *[
            F.col(c)
            if c in keys
            else F.when(hit, as_of_col).otherwise(F.col(c)).alias(c)
            if c == stamp
            else F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            for c in old.columns
        ]
    )


def only_if(df: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``df`` if ``found`` has any row, else none. ``found`` is read up to its first row."""
    return df.filter(found.exists())


def union_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames of the same shape, each marked with its name in column ``tag``."""
    parts = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
