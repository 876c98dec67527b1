"""The labelled sentiment corpus: build, split, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.functions.text import content_id
from tidemark.operators.ranking import first_of_each_text, split_by_share

CLASSES = (0, 1, 2)
SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}


def combined(*sources: DataFrame, order: str = "row") -> DataFrame:
    """All sources one after the other, each text once: its first row."""
    parts = [s.withColumn("part_", F.lit(i)) for i, s in enumerate(sources)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return first_of_each_text(rows, "text", ["part_", order]).drop("part_")


def with_ids(rows: DataFrame, order: str = "row") -> DataFrame:
    """id = prefix of the text's SHA-256; rows sharing one hash text and row key instead."""
    named = rows.withColumn("id", content_id(F.col("text")))
    shared = named.groupBy("id").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").select(
        "id", F.lit(True).alias("shared_"))
    again = content_id(F.concat("text", F.col(order).cast("string")))
    return (named.join(shared, "id", "left")
            .withColumn("id", F.when(F.col("shared_"), again).otherwise(F.col("id"))).drop("shared_"))


def stratified_split(rows: DataFrame, seed: int = 42, key: str = "id", label: str = "label") -> DataFrame:
    return split_by_share(rows, SHARES, seed, key, by=[label])


def manifest(rows: DataFrame) -> DataFrame:
    """Row counts per split by label and by source, per split and per source in all."""
    facts = F.array(
        F.struct(F.col("split").alias("split"), F.lit("label").alias("kind"), F.col("label").cast("string").alias("value")),
        F.struct("split", F.lit("source").alias("kind"), F.col("source").alias("value")),
        F.struct("split", F.lit("rows").alias("kind"), F.lit("all").alias("value")),
        F.struct(F.lit("all").alias("split"), F.lit("source").alias("kind"), F.col("source").alias("value")))
    return rows.select(F.explode(facts).alias("f")).groupBy("f.split", "f.kind", "f.value").agg(
        F.count(F.lit(1)).alias("n"))


def confusion(rows: DataFrame, true: str = "y_true", pred: str = "y_pred", classes: Sequence[int] = CLASSES) -> DataFrame:
    return (rows.groupBy(true).pivot(pred, list(classes)).agg(F.count(F.lit(1)))
            .na.fill(0).withColumnsRenamed({str(c): f"pred_{c}" for c in classes}))


def report(rows: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The rows are counted once per (true, predicted) pair; everything after works on those few counts.
    """
    cells = rows.groupBy(F.col(true).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("t").alias("cls"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("claimed")))
    sums = cells.select(F.explode(sides).alias("s")).groupBy("s.cls").agg(
        F.sum("s.tp").alias("tp"), F.sum("s.support").alias("support"), F.sum("s.claimed").alias("claimed"))
    share = {"precision": ratio(F.col("tp"), F.col("claimed")), "recall": ratio(F.col("tp"), F.col("support")),
             "f1": ratio(2 * F.col("tp"), F.col("claimed") + F.col("support"))}
    per_class = sums.select(F.col("cls").cast("string").alias("name"),
                            *[F.coalesce(e, F.lit(0.0)).alias(n) for n, e in share.items()], "support", "tp")
    total = F.sum("support")
    macro = per_class.agg(F.lit("macro avg").alias("name"), *[F.avg(n).alias(n) for n in share], total.alias("support"))
    weighted = per_class.agg(F.lit("weighted avg").alias("name"),
                             *[(F.sum(F.col(n) * F.col("support")) / total).alias(n) for n in share],
                             total.alias("support"))
    right = F.sum("tp") / total
    accuracy = per_class.agg(F.lit("accuracy").alias("name"), *[right.alias(n) for n in share], total.alias("support"))
    out = per_class.drop("tp")
    for part in (accuracy, macro, weighted):
        out = out.unionByName(part)
    return out


def compare_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Two reports side by side: F1 of both, absolute gain and relative gain in percent."""
    a = base.select("name", F.col("f1").alias("base_f1"))
    b = tuned.select("name", F.col("f1").alias("tuned_f1"))
    gain = F.col("tuned_f1") - F.col("base_f1")
    return a.join(b, "name").select("name", "base_f1", "tuned_f1", gain.alias("gain"),
                                    (ratio(gain, F.col("base_f1")) * 100).alias("gain_percent"))


def loss_gain(rows: DataFrame, base: str, tuned: str) -> DataFrame:
    return rows.agg(F.avg(base).alias("base_loss"), F.avg(tuned).alias("tuned_loss"),
                    (F.avg(base) - F.avg(tuned)).alias("loss_decrease"))
