"""Co-movement of return series: against a benchmark, and pairwise for all tickers."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.functions.staging import landed

#: Tickers and returns of a tile, about, and the tiles that fewer tickers are dealt to while each still holds some 256.
TILE, TILE_VALUES, SPREAD = 2048, 1 << 22, 8
_MOMENTS = "a string, b string, n long, sa double, sb double, sab double, saa double, sbb double"
#: Pairs of one batch on their way out.
_BATCH = 65_536
#: Days of a year, and one for rows without a date.
_DAYS = 367


class _Year:
    """A tile's returns of one year: tickers, and of each return its ticker's place in them, its day and its value."""

    def __init__(self, series: pa.StructArray):
        tickers, days, rets = series.flatten()
        self.tickers = tickers.to_pylist()
        self.row = np.repeat(np.arange(len(self.tickers)), pc.list_value_length(days).to_numpy())
        self.day = days.flatten().to_numpy().astype(np.int64)
        there = np.zeros(len(self.tickers) * _DAYS, bool)
        there[self.row * _DAYS + self.day] = True
        if np.count_nonzero(there) < len(self.row):
            raise ValueError("a ticker has two returns of one date")
        value = rets.flatten().to_numpy(zero_copy_only=False)
        known = ~np.isnan(value)
        self.row, self.day, self.value = self.row[known], self.day[known], value[known]

    def grid(self, place: dict[str, int], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether there is a return, and the return, by coded day (-1: left out) and place."""
        at = np.array([place.setdefault(t, len(place)) for t in self.tickers], np.int64)
        wanted = code[self.day] >= 0
        day, column = code[self.day[wanted]], at[self.row[wanted]]
        seen, x = np.zeros((2, code.max(initial=-1) + 1, len(place)))
        seen[day, column], x[day, column] = 1.0, self.value[wanted]
        return seen, x


class _PairSums:
    """Sums of all pairs of two tiles, added up year by year as matrix products over dates x tickers grids."""

    def __init__(self, tiles: tuple[int, int]):
        self.tiles = tiles
        self.places: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.sums = np.zeros((6, 0, 0))  # n, sa, sb, sab, saa, sbb

    def add(self, left: _Year, right: _Year) -> None:
        common = np.intersect1d(left.day, right.day)
        if not len(common):
            return
        code = np.full(_DAYS, -1)
        code[common] = np.arange(len(common))
        (seen_a, x_a), (seen_b, x_b) = (side.grid(place, code) for side, place in zip((left, right), self.places))
        self._grow()
        count_a, count_b = seen_a.astype(np.float32), seen_b.astype(np.float32)  # at most a year's days: exact
        for total, one, other in zip(self.sums, (count_a, x_a, seen_a, x_a, x_a * x_a, seen_a),
                                     (count_b, seen_b, x_b, x_b, seen_b, x_b * x_b)):
            total += one.T @ other

    def _grow(self) -> None:
        need = tuple(map(len, self.places))
        if need[0] > self.sums.shape[1] or need[1] > self.sums.shape[2]:
            grown = np.zeros((6, *need))
            grown[:, :self.sums.shape[1], :self.sums.shape[2]] = self.sums
            self.sums = grown

    def rows(self, least_days: int) -> Iterator[pa.RecordBatch]:
        """The pairs a < b with as many common dates, one at least."""
        names = sorted(self.places[0].keys() | self.places[1].keys())
        rank = {name: i for i, name in enumerate(names)}
        rank_a, rank_b = (np.array([rank[t] for t in place], np.int64) for place in self.places)
        texts, step = pa.array(names, pa.string()), max(1, _BATCH // max(1, len(rank_b)))
        for top in range(0, len(rank_a), step):
            part = self.sums[:, top:top + step]
            wanted = part[0] >= max(1, least_days)
            if self.tiles[0] == self.tiles[1]:
                wanted &= rank_a[top:top + step, None] < rank_b
            at = np.flatnonzero(wanted)
            n, sa, sb, sab, saa, sbb = part.reshape(6, -1).take(at, axis=1)
            i, j = np.divmod(at, len(rank_b))
            a, b = rank_a[top + i], rank_b[j]
            swap = a > b
            yield pa.RecordBatch.from_arrays(
                [texts.take(pa.array(np.where(swap, b, a))), texts.take(pa.array(np.where(swap, a, b))),
                 pa.array(n.astype(np.int64)),
                 *[pa.array(s, from_pandas=True) for s in (np.where(swap, sb, sa), np.where(swap, sa, sb), sab,
                                                           np.where(swap, sbb, saa), np.where(swap, saa, sbb))]],
                names=[f.split()[0] for f in _MOMENTS.split(", ")])


def _moments(least_days: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, done = None, set()
        for batch in batches:
            for row, tiles in enumerate(zip(batch.column("tile_a").to_pylist(), batch.column("tile_b").to_pylist())):
                if sums is None or sums.tiles != tiles:
                    if sums is not None:
                        yield from sums.rows(least_days)
                    if tiles in done:
                        raise ValueError("the years of two tiles must follow each other")
                    sums = _PairSums(tiles)
                    done.add(tiles)
                sums.add(_Year(batch.column("left")[row].values), _Year(batch.column("right")[row].values))
        if sums is not None:
            yield from sums.rows(least_days)

    return run


def packed_returns(returns: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Each ticker's year as one row (ticker, year, days, rets), landed: the returns are made once, whoever reads them.
    ``assets`` (column ticker) keeps these only."""
    rows = returns.filter(F.col("ret").isNotNull()).select("date", "ticker", "ret")
    if assets is not None:
        rows = rows.join(assets.select("ticker").distinct(), "ticker", "left_semi")
    day = F.coalesce(F.dayofyear("date"), F.lit(0)).cast("smallint")  # rows without a date are of one date
    packed = rows.groupBy("ticker", F.coalesce(F.year("date"), F.lit(0)).alias("year")).agg(
        F.collect_list(F.struct(day.alias("day"), "ret")).alias("values"))
    return landed(packed.select("ticker", "year", F.col("values.day").alias("days"), F.col("values.ret").alias("rets")), "packed")


def pair_statistics(returns: DataFrame, tiles: int | None = None, assets: DataFrame | None = None,
                    least: float | None = None, least_days: int = 1, packed: DataFrame | None = None) -> DataFrame:
    """Correlation and covariance of every pair a < b over the dates both have.

    Tickers are hashed into tiles of about 2048. Each tile's years are shuffled once, to a partition of its own; a task for
    each two of these reads both, and nothing is sent or stored once for each pair of tiles. The years pass
    one after the other through the task, which holds one year's grid and the pairs' sums and
    emits every pair once: no row per pair is shuffled.
    With ``assets`` (column ticker) others leave before the tiles, whose number follows; ``least`` keeps pairs of that
    correlation or more, ``least_days`` those with as many common dates. ``packed`` are the ``packed_returns``, where the
    caller has them.
    """
    held = (packed_returns(returns, assets) if packed is None else packed).filter(F.col("ticker").isNotNull())
    if tiles is None:
        n, values = held.agg(F.count_distinct("ticker"), F.coalesce(F.sum(F.size("days")), F.lit(0))).first()
        tiles = max(1, -(-n // TILE), -(-values // TILE_VALUES), min(SPREAD, -(-n // 256)))
    placed = held.withColumn("tile", F.pmod(F.xxhash64("ticker"), F.lit(tiles)).cast("int")).repartitionById(tiles, F.col("tile"))
    years = placed.groupBy("tile", "year").agg(F.collect_list(F.struct("ticker", "days", "rets")).alias("series"))
    left = years.select(F.col("tile").alias("tile_a"), F.col("year").alias("year_a"), F.col("series").alias("left"))
    right = years.select(F.col("tile").alias("tile_b"), "year", F.col("series").alias("right"))
    # all pairs of tiles are asked for: each task reads one partition of either side
    met = left.hint("shuffle_replicate_nl").join(
        right, (F.col("year") == F.col("year_a")) & (F.col("tile_a") <= F.col("tile_b")))
    total = met.select("tile_a", "tile_b", "left", "right").mapInArrow(_moments(least_days), _MOMENTS)
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    cross = n * F.col("sab") - sa * sb
    spread_a, spread_b = n * F.col("saa") - sa * sa, n * F.col("sbb") - sb * sb
    found = total.filter(n >= least_days).select(
        "a", "b", "n", ratio(cross, F.sqrt(spread_a * spread_b)).alias("correlation"),
        ratio(cross, (n * (n - 1)).cast("double")).alias("covariance"))
    return found if least is None else found.filter(F.col("correlation") >= least)


def mirrored(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, correlation) in both orders, made once."""
    return pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b"), "correlation"),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "correlation"))).alias("p")).select("p.*")


def correlation_matrix(returns: DataFrame, tiles: int | None = None) -> DataFrame:
    """Long form, both orders and the diagonal of ones."""
    packed = packed_returns(returns)  # every ticker with a return is in it
    pairs = pair_statistics(returns, tiles, packed=packed).select("a", "b", "correlation")
    own = packed.select("ticker").distinct().select(
        F.col("ticker").alias("a"), F.col("ticker").alias("b"), F.lit(1.0).alias("correlation"))
    return mirrored(pairs).unionByName(own)


def market_returns(returns: DataFrame) -> DataFrame:
    """Equal-weighted mean return per date."""
    return returns.groupBy("date").agg(F.avg("ret").alias("bench"))


def benchmark_returns(returns: DataFrame, ticker: str | None = None) -> DataFrame:
    if ticker is None:
        return market_returns(returns)
    return returns.filter(F.col("ticker") == ticker.upper()).select("date", F.col("ret").alias("bench"))


def against(returns: DataFrame, benchmark: DataFrame) -> DataFrame:
    """beta, alpha, tracking error and information ratio per ticker. One benchmark row per date."""
    both = returns.join(benchmark, "date").filter(F.col("ret").isNotNull() & F.col("bench").isNotNull())
    excess = F.col("ret") - F.col("bench")
    return both.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("days"),
        F.regr_slope("ret", "bench").alias("beta"),
        F.regr_intercept("ret", "bench").alias("alpha"),
        F.stddev_samp(excess).alias("tracking_error"),
        ratio(F.avg(excess), F.stddev_samp(excess)).alias("information_ratio"))


def pairs(returns: DataFrame, wanted: DataFrame) -> DataFrame:
    """Correlation, covariance and mean spread for a table of pairs (a, b).

    Where one ticker is compared with many, as ``a``, it is looked up by ticker and date, not by its own few values."""
    left = returns.select(F.col("ticker").alias("a"), "date", F.col("ret").alias("ra"))
    right = returns.select(F.col("ticker").alias("b"), "date", F.col("ret").alias("rb"))
    both = wanted.join(right, "b").join(left, ["a", "date"]).filter(
        F.col("ra").isNotNull() & F.col("rb").isNotNull())
    return both.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.corr("ra", "rb").alias("correlation"),
        F.covar_samp("ra", "rb").alias("covariance"), F.avg(F.col("ra") - F.col("rb")).alias("mean_spread"))


def asset_pairs(spark, assets: list[str]) -> DataFrame:
    return spark.createDataFrame(list(itertools.combinations(sorted(assets), 2)), "a string, b string")
