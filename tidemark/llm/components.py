"""Connected components of a link table, by alternating star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``links`` has a and b (long). Gives node, root: each linked node with the smallest node it reaches.

    A large-star step ties the larger neighbours of a node to the smallest of all, a small-star step the smaller ones;
    when neither changes a table, all are stars around their smallest: rounds are logarithmic in the longest path. Every round is written to the shared folder. A
    hub's rows shrink to one a task before minima are shuffled, and the joins are plain ones that Spark splits.
    Links of a node with itself and null ends add nothing; repeated links count once."""
    u, v = F.col("u"), F.col("v")
    state = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "links")
    before = _mark(state)
    while before[0]:
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        old, state = state, stored(small, "links")
        discard(old)
        now = _mark(state)
        if now == before:
            break
        before = now
    return state.select(u.alias("node"), v.alias("root"))


def _mark(state: DataFrame) -> tuple:
    """Numbers that tell two link tables apart: one row."""
    return tuple(state.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
