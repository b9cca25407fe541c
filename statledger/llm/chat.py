"""Chat formatting with cumulative-snapshot collapse; built-in DataFrame functions only.

Method. A logged conversation often recurs as a longer snapshot of itself. Every turn gets a hash of its place, role and text; the
running sum of these hashes over a conversation is the rolling hash of each of its prefixes (120 bits, in three sums). A
conversation whose whole hash is the hash of a proper prefix of another one is left out by an anti-join; of equal
conversations the one with the smallest conv_id stays. What is left is rendered turn by turn.

Defined results. Turns are ordered by turn (null last), then role, then text; rows repeated exactly count once. A null role or
text counts as empty. Rows without conv_id belong to no conversation and are not rendered. Markers of the template inside a text are
broken by a blank after ``<``. An empty table gives no rows. Other columns are not looked at.

At scale. Turns are sorted and summed per conversation in a stream that spills; a rendered conversation is one row by its
nature. Prefix hashes are reduced to distinct (length, hash) before the anti-join, so a first turn that many conversations share
is one row there. Texts are shuffled for kept conversations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_SUMS = ("s0", "s1", "s2")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text and the rolling hash of the prefix that ends there."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    placed = rows.withColumn("place", F.row_number().over(in_order))
    digest = F.sha2(F.concat_ws("\u0000", F.col("place").cast("string"), F.length("role").cast("string"), "role", "text"), 256)
    placed = placed.withColumn("digest", digest)
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    parts = [F.sum(F.conv(F.substring("digest", 1 + 10 * i, 10), 16, 10).cast("long")).over(so_far).alias(s) for i, s in enumerate(_SUMS)]
    return placed.select("conv_id", "place", "role", "text", *parts)


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that no longer one begins with."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct("place", *_SUMS)).alias("last")).select("conv_id", "last.*")
    whole = last.groupBy("place", *_SUMS).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    final = last.select("conv_id", F.col("place").alias("n_turns"))
    proper = prefixes.join(final, "conv_id").where("place < n_turns").select("place", *_SUMS).distinct()
    return whole.join(proper, ["place", *_SUMS], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def rendered(conversations: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """conv_id, n_turns, n_copies and chat: one row for each maximal conversation."""
    prefixes = turns(conversations)
    kept = maximal(prefixes.drop("role", "text"))

    def safe(name: str):
        out = F.col(name)
        for marker in (start, end):
            out = F.replace(out, F.lit(marker), F.lit(marker[0] + " " + marker[1:]))
        return out

    line = F.concat(F.lit(start), safe("role"), F.lit("\n"), safe("text"), F.lit(end + "\n"))
    lines = prefixes.select("conv_id", "place", line.alias("line")).join(kept, "conv_id")
    parts = lines.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("parts"))
    return parts.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies", F.array_join("parts.line", "").alias("chat"))
