"""Keep-first, exact ranks within huge groups, splits, samples and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Rows of one bucket of a rank, about: what one task numbers.
BUCKET_ROWS = 100_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``, as an aggregate: copies of one key shrink map-side."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first_")
    return df.groupBy(*keys).agg(first).select(*keys, "first_.*").select(*df.columns)


def first_of_each_text(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """The first row of each text by ``order``, nulls first. Texts are neither keys nor aggregated: their digests and the order
    columns find the leads, one aggregate a column that combines map-side, and the rows meet those in a semi join. Rows that
    tie in all of ``order`` count once."""
    keyed = df.withColumn("digest_", F.coalesce(F.md5(text), F.lit("")))
    levels = []
    for column in order:
        levels += [(f"{column}_given_", F.col(column).isNotNull()), (column, F.col(column))]
    leads = keyed.select("digest_", *[c.alias(n) for n, c in levels])
    carried: list[str] = []
    for at in range(len(levels) - 1, -1, -1):
        name = levels[at][0]
        given = F.col(levels[at - 1][0]) if at % 2 else F.lit(True)  # rows without a value are one row by now
        leads = leads.groupBy("digest_", *[n for n, _ in levels[:at]]).agg(F.min(name).alias(name), *[
            F.when(given, F.min_by(c, name)).otherwise(F.first(c)).alias(c) for c in carried])
        carried.insert(0, name)
    leads = leads.select(F.col("digest_").alias("lead_"), *[F.col(c).alias(f"{c}_lead_") for c in order])
    same = F.col("digest_") == F.col("lead_")
    for column in order:
        same &= F.col(column).eqNullSafe(F.col(f"{column}_lead_"))
    tied = W.partitionBy("digest_").orderBy(*order)
    return (keyed.join(leads, same, "left_semi").withColumn("tie_", F.row_number().over(tied)).filter("tie_ = 1")
            .select(*df.columns))


def seeded_hash(seed: int, *cols: str) -> Column:
    """A hex digest that orders rows pseudo-randomly and the same way on every run."""
    return F.md5(F.concat(F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def ranked(df: DataFrame, order_hash: str, by: Sequence[str] = (), tie: Sequence[str] = (),
           name: str = "rank") -> DataFrame:
    """Exact 0-based rank by a uniform hex column, with no task that holds a whole group.

    The hash's first digits cut each group into equal buckets, as many digits as leave some ``BUCKET_ROWS``
    rows in a bucket if one group holds them all; the rows are counted for that. Bucket counts (combined
    map-side) give each bucket's offset; rows are then numbered only within their bucket. Adds the rank and
    ``group_rows``, the size of the row's group.
    """
    prefix = 1
    rows = df.count()
    while rows > BUCKET_ROWS * 16 ** prefix:
        prefix += 1
    cut = df.withColumn("bucket_", F.substring(order_hash, 1, prefix))
    groups = [*by, "bucket_"]
    counts = cut.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_"))
    along = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    offsets = counts.select(
        *groups,
        F.coalesce(F.sum("n_").over(along.orderBy("bucket_").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("offset_"),
        F.sum("n_").over(along).alias("group_rows"))
    inside = W.partitionBy(*groups).orderBy(order_hash, *tie)
    return (cut.join(offsets, groups)
            .withColumn(name, F.col("offset_") + F.row_number().over(inside) - 1)
            .drop("bucket_", "offset_"))


def split_by_share(df: DataFrame, shares: dict[str, float], seed: int, key: str,
                   by: Sequence[str] = (), name: str = "split") -> DataFrame:
    """Assigns splits by rank in a seeded order, within each stratum when ``by`` is given.

    Cut points are whole row counts, floor(rows * cumulative share); the last split takes the rest.
    """
    out = ranked(df.withColumn("hash_", seeded_hash(seed, key)), "hash_", by, [key], name="rank_")
    label, edge = None, 0.0
    names = list(shares)
    for split in names[:-1]:
        edge = round(edge + shares[split], 9)
        inside = F.col("rank_") < F.floor(F.round(F.col("group_rows") * F.lit(edge), 6))
        label = F.when(inside, split) if label is None else label.when(inside, split)
    return out.withColumn(name, label.otherwise(names[-1])).drop("hash_", "rank_", "group_rows")


def split_by_size(df: DataFrame, sizes: dict[str, int], seed: int, key: str, shard_rows: int) -> DataFrame:
    """Fixed-size splits in a seeded order, with shard number and id ``split_nn_000000``; the rest goes."""
    out = ranked(df.withColumn("hash_", seeded_hash(seed, key)), "hash_", (), [key], name="rank_")
    split, base, edge = None, None, 0
    for name, rows in sizes.items():
        inside = F.col("rank_") < edge + rows
        split = F.when(inside, name) if split is None else split.when(inside, name)
        base = F.when(inside, F.lit(edge)) if base is None else base.when(inside, F.lit(edge))
        edge += rows
    out = (out.filter(F.col("rank_") < edge).withColumn("split", split)
           .withColumn("pos_", F.col("rank_") - base)
           .withColumn("shard", F.floor(F.col("pos_") / shard_rows)))
    in_shard = F.col("pos_") - F.col("shard") * shard_rows
    row_id = F.when(F.col("split") == "train",
                    F.format_string("%s_%02d_%06d", F.col("split"), F.col("shard"), in_shard)).otherwise(
        F.format_string("%s_%06d", F.col("split"), F.col("pos_")))
    return out.withColumn("id", row_id).drop("hash_", "rank_", "group_rows", "pos_")


def sample_rows(df: DataFrame, rows: int, seed: int, key: str) -> DataFrame:
    """A repeatable sample of exactly ``rows`` rows (all rows when there are fewer)."""
    out = ranked(df.withColumn("hash_", seeded_hash(seed, key)), "hash_", (), [key], name="rank_")
    return out.filter(F.col("rank_") < rows).drop("hash_", "rank_", "group_rows")


def top(df: DataFrame, by: str, k: int, tie: Sequence[str], descending: bool = True) -> DataFrame:
    """The k first rows in a total order; NULLs last."""
    lead = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(lead, *tie).limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], by: str, k: int, tie: Sequence[str],
                  descending: bool = True, name: str = "rank") -> DataFrame:
    """The k first rows of every group; Spark keeps k rows per group and task before the shuffle."""
    lead = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    w = W.partitionBy(*group).orderBy(lead, *tie)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
