"""Scores of predicted requests, SQL texts and results against their gold versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.functions.text import normalize_sql, strip


def request_scores(pairs: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """Share of requests equal as a whole, by intent, by metric name and by time."""
    g, p = F.col(gold), F.col(pred)

    def same(a: Column, b: Column) -> Column:
        return F.avg(a.eqNullSafe(b).cast("int"))

    return pairs.agg(F.count(F.lit(1)).alias("rows"), same(g, p).alias("exact"),
                     same(g["intent"], p["intent"]).alias("intent"),
                     same(g["metric"]["name"], p["metric"]["name"]).alias("metric"),
                     same(g["time"], p["time"]).alias("time"))


def asset_scores(pairs: DataFrame, gold: str = "gold_assets", pred: str = "pred_assets") -> DataFrame:
    """Mean precision, recall and F1 of asset sets; rows where both are empty do not count."""
    empty = F.array().cast("array<string>")
    g = F.array_distinct(F.coalesce(gold, empty))
    p = F.array_distinct(F.coalesce(pred, empty))
    hit = F.size(F.array_intersect(g, p))
    scores = pairs.select(g.alias("g"), p.alias("p"), hit.alias("hit")).filter(F.size("g") + F.size("p") > 0)

    def part(top: Column, bottom: Column) -> Column:
        return F.coalesce(ratio(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    return scores.agg(F.avg(part(F.col("hit"), F.size("p"))).alias("precision"),
                      F.avg(part(F.col("hit"), F.size("g"))).alias("recall"),
                      F.avg(part(2 * F.col("hit"), F.size("g") + F.size("p"))).alias("f1"))


def result_matches(gold: DataFrame, pred: DataFrame, columns: Sequence[str], key: str = "example") -> DataFrame:
    """Per example: are the two stored results the same multiset, and do they share a row.

    Copies of a row combine before the shuffle; an example's rows are compared row by row, then summed up.
    """
    digest = F.xxhash64(*columns), F.md5(F.to_json(F.struct(*columns)))
    sides = [df.select(key, digest[0].alias("h1"), digest[1].alias("h2"), F.lit(a).alias("g"), F.lit(b).alias("p"))
             for df, a, b in ((gold, 1, 0), (pred, 0, 1))]
    rows = sides[0].unionByName(sides[1]).groupBy(key, "h1", "h2").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    return rows.groupBy(key).agg(F.bool_and(F.col("g") == F.col("p")).alias("equal"),
                                 F.bool_or((F.col("g") > 0) & (F.col("p") > 0)).alias("overlap"))


def execution_rates(examples: DataFrame, matches: DataFrame, key: str = "example") -> DataFrame:
    """Share of examples whose prediction ran, and whose result equals the gold one.

    examples(example, ran_gold, ran_pred). Two results without rows are equal.
    """
    both = F.col("ran_gold") & F.col("ran_pred")
    joined = examples.join(matches, key, "left")
    return joined.agg(F.count(F.lit(1)).alias("rows"),
                      F.avg(F.col("ran_pred").cast("int")).alias("execution"),
                      F.avg((both & F.coalesce("equal", F.lit(True))).cast("int")).alias("result_match"),
                      F.avg((both & F.coalesce("overlap", F.lit(False))).cast("int")).alias("partial_match"))


def corpus_rates(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact match over all, execution match over what the gold SQL could run, coverage, failures.

    rows(sql_gold, sql_pred, ran_gold, equal).
    """
    exact = normalize_sql(F.col("sql_gold")) == normalize_sql(F.col("sql_pred"))
    hit = F.when(F.col("ran_gold"), F.col("equal").cast("int"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(exact.cast("int")).alias("exact"),
        F.coalesce(F.avg(hit), F.lit(0.0)).alias("execution"), F.avg(F.col("ran_gold").cast("int")).alias("coverage"),
        F.coalesce(F.sum(1 - hit), F.lit(0)).alias("failures"))


def text_match(a: Column, b: Column) -> Column:
    return F.lower(strip(a)) == F.lower(strip(b))


def structural_match(a: Column, b: Column) -> Column:
    """Equal once comments are out, space is squeezed and case is dropped."""
    def plain(sql: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(sql, r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
        return F.lower(F.regexp_replace(strip(bare), r"\s+", " "))
    return plain(a) == plain(b)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, in double; NULL for a zero vector."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)
    return ratio(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
