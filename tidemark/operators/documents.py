"""Document chunks, nearest chunks, context and question/answer rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.staging import landed
from tidemark.functions.text import strip
from tidemark.operators.ranking import first_of_each_text, keep_first, top_per_group

# Chunk sizes and the separators tried in order; the empty one cuts between characters.
CHUNK_SIZE, CHUNK_OVERLAP = 1500, 500
SEPARATORS = ("\n\n", "\n", ". ", " ", "")
#: Chunks that a worker holds before they leave it, about.
CHUNK_ROWS = 1000

#: Rows of a block; pivots of a larger table of items, and rings around each.
BLOCK_ROWS, PIVOTS, RINGS = 4096, 256, 64
#: Bounds of queries to rings that a worker holds at once; of what they open it sends ``BLOCK_ROWS`` vectors at a time.
VISITS = 1 << 18
#: Pairs of a query and an item measured at once, about; products of a query and an item held at once.
PAIRS, PRODUCTS = 1 << 15, 1 << 22
#: Rows of a ring that is searched as one where the caller names no number, and of smaller rings that are sent together: queries
#: and items are sent once for each such block of the other side. Items of a block whose nearest one stands for them when the
#: k-th distance is bounded.
RING_ROWS, BESIDE = 1 << 16, 64
#: Queries of a block that open its rings together.
BESIDE_QUERIES = 256


def _pieces(text: str, size: int, separators: Sequence[str]) -> Iterator[tuple[str, bool]]:
    """Pieces shorter than ``size`` with the separator leading the later piece; True marks a hard break.

    A piece that stays too long is cut again by finer separators, apart from its neighbours.
    """
    at = next(i for i, sep in enumerate(separators) if sep in text)
    separator, finer = separators[at], separators[at + 1:]
    if separator:
        first, *rest = text.split(separator)
        parts = [first] + [separator + part for part in rest]
    else:
        parts = list(text)
    for part in parts:
        if not part:
            continue
        if len(part) < size or not finer:
            yield part, False
        else:
            yield "", True
            yield from _pieces(part, size, finer)
            yield "", True


def chunk_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: Sequence[str] = SEPARATORS) -> list[tuple[int, str]]:
    """Greedy chunks of at most ``size`` characters that repeat up to ``overlap`` trailing characters, each with the place
    of its first character in the text."""
    chunks: list[tuple[int, str]] = []
    held: list[str] = []
    length = start = place = 0  # place: where the held pieces from ``start`` on end

    def emit() -> None:
        joined = "".join(held[start:])
        if chunk := joined.strip():
            chunks.append((place - len(joined.lstrip()), chunk))

    for piece, hard in _pieces(text, size, separators) if text else ():
        if hard:
            if start < len(held):
                emit()
            held, length, start = [], 0, 0
            continue
        if length + len(piece) > size and start < len(held):
            emit()
            while length > overlap or (length and length + len(piece) > size):
                length -= len(held[start])
                start += 1
        held.append(piece)
        length += len(piece)
        place += len(piece)
    if start < len(held):
        emit()
    return chunks


def chunks(documents: DataFrame, key: str, text: str = "text", size: int = CHUNK_SIZE,
           overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """key, chunk_no from 0, chunk, chunk_start (characters before it). Documents are cut where they lie, one after the
    other, and their chunks leave a worker every ``CHUNK_ROWS``; nothing is shuffled."""
    kept = documents.select(key, F.col(text).alias("text_"))
    schema = T.StructType([T.StructField(key, kept.schema[0].dataType), T.StructField("chunk_no", T.IntegerType()),
                           T.StructField("chunk", T.StringType()), T.StructField("chunk_start", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, str, int]] = []
            for at, value in enumerate(batch.column("text_")):
                rows += [(at, no, c, place) for no, (place, c) in enumerate(chunk_text(value.as_py() or "", size, overlap))]
                if len(rows) >= CHUNK_ROWS or at + 1 == batch.num_rows and rows:
                    row, no, chunk, place = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(row)), pa.array(no, pa.int32()), pa.array(chunk, pa.string()),
                         pa.array(place, pa.int64())], names=schema.names)
                    rows = []

    return kept.mapInArrow(cut, schema)


def _closest(queries: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries, items and distances of the k nearest rows of one block to each query by (distance, id).

    Products of whole blocks say which rows may be among them, up to their rounding; those are measured exactly, at most some
    ``PAIRS`` at once or one query's.
    """
    sizes = (items ** 2).sum(axis=1)
    step = max(1, min(256, PRODUCTS // max(1, len(items))))
    for at in range(0, len(queries), step):
        part = queries[at:at + step]
        rough = sizes - 2 * (part @ items.T)  # squared distance less the query's own square
        slack = 1e-9 * (sizes.max(initial=0) + (part ** 2).sum(axis=1)) + 1e-300
        near = np.ones(rough.shape, bool)
        if len(items) > k:  # everything within the k-th distance, so that ties are settled by id
            least, whole = rough, len(items) // BESIDE
            if whole >= k:  # the k-th of the least of any k groups is no less than the k-th of all
                least = rough[:, :whole * BESIDE].reshape(len(part), whole, BESIDE).min(axis=2)
            near = rough <= (np.partition(least, k - 1, axis=1)[:, k - 1] + slack)[:, None]
        held = near.sum(axis=1).cumsum()
        first = 0
        while first < len(part):
            last = max(first + 1, int(np.searchsorted(held, PAIRS + (held[first - 1] if first else 0), "right")))
            row, item = np.nonzero(near[first:last])
            row += first
            distance = np.sqrt(((items[item] - part[row]) ** 2).sum(axis=1))
            order = np.lexsort((ids[item], distance, row))  # rows are in order, so each keeps its places
            order = order[np.arange(len(row)) - np.searchsorted(row, row, "left") < k]
            yield at + row[order], item[order], distance[order]
            first = last


def _hits(query_ids, queries, item_ids, items, k) -> pd.DataFrame:
    found = list(_closest(queries, items, item_ids, k)) if len(item_ids) else []
    if not found:
        return pd.DataFrame({"query_id": [], "item_id": [], "distance": []}).astype(
            {"query_id": "int64", "item_id": "int64", "distance": "float64"})
    row, item, distance = map(np.concatenate, zip(*found))
    return pd.DataFrame({"query_id": query_ids[row], "item_id": item_ids[item], "distance": distance})


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


_HIT = "query_id long, item_id long, distance double"


def _nearest_in_blocks(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Blocks of either side meet pairwise, each meeting a task of bounded size. Few queries are one block, and then
    no item is sent twice."""
    def blocks(df: DataFrame) -> int:
        return max(1, -(-df.count() // BLOCK_ROWS))

    item_blocks, query_blocks = blocks(items), blocks(queries)

    def placed(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return (df.select(key, "vector").withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _hits(np.array([]), np.empty((0, 0)), np.array([]), np.empty((0, 0)), k)
        return _hits(left["query_id"].to_numpy(), _matrix(left["vector"]),
                     right["item_id"].to_numpy(), _matrix(right["vector"]), k)

    asked = placed(queries, "query_id", "query_block", query_blocks, "item_block", item_blocks)
    held = placed(items, "item_id", "item_block", item_blocks, "query_block", query_blocks)
    keys = ["query_block", "item_block"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, _HIT)


class Rings:
    """Items around pivots: every item belongs to its nearest pivot, and to a ring of those about as far away. By the
    triangle inequality an item of a ring with distances from ``low`` to ``high`` lies at least as far from a query as the
    query's own distance to the pivot lies outside these; a ring beyond the k-th hit is never opened.

    At most ``PIVOTS`` pivots and ``RINGS`` rings of each, whatever the table; a ring of more rows is cut by hash.
    Neighbouring rings of up to ``RING_ROWS`` rows together are a shelf (``Shelves``), which is what queries and items are sent to."""

    def __init__(self, pivots: np.ndarray, edges: dict[int, np.ndarray] | None = None):
        self.pivots, self.edges = pivots, edges or {}
        self.squares = (pivots ** 2).sum(axis=1)
        self.cell = self.low = self.high = self.rows = self.parts = np.zeros(0)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        square = (vectors ** 2).sum(axis=1)[:, None] + self.squares - 2 * (vectors @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0))

    def nearest_pivot(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = self.distances(vectors).argmin(axis=1)
        return cell, np.sqrt(((vectors - self.pivots[cell]) ** 2).sum(axis=1))

    def ring(self, cell: np.ndarray, away: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cell), np.int64)
        for c in np.unique(cell).tolist():
            mine = cell == c
            out[mine] = np.searchsorted(self.edges[c], away[mine], "left")
        return out

    def measured(self, rows: list, block_rows: int) -> None:
        """Takes in what each ring holds: rows (cell, ring, n, low, high)."""
        self.place = {(r[0], r[1]): i for i, r in enumerate(rows)}
        self.keys = np.array([(r[0], r[1]) for r in rows])
        self.cell, self.rows, self.low, self.high = (np.array([r[i] for r in rows]) for i in (0, 2, 3, 4))
        self.parts = -(-self.rows // block_rows)

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        """The least distance of each query to anything in each ring, less what products may be off."""
        away = self.distances(vectors)[:, self.cell]
        slack = 1e-6 * (np.sqrt((vectors ** 2).sum(axis=1))[:, None] + np.sqrt(self.squares)[self.cell]) + 1e-12
        return np.maximum(np.maximum(away - self.high, self.low - away) - slack, 0)

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """For each query the nearest rings that hold k items together, as a mask."""
        order = np.argsort(bounds, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        mask = np.zeros(bounds.shape, bool)
        np.put_along_axis(mask, order, held < k, axis=1)
        return mask


class Shelves(Rings):
    """Rings next to each other as one of up to ``RING_ROWS`` rows: a query meets it once, however many of the rings it opens."""

    def __init__(self, rings: Rings, block_rows: int):
        self.rings, self.of, self.starts = rings, np.zeros(len(rings.rows), np.int64), []
        self.order = np.lexsort((rings.keys[:, 1], rings.keys[:, 0])) if len(rings.rows) else self.of
        rows: list[int] = []
        for at, ring in enumerate(self.order.tolist()):
            if not rows or rows[-1] + rings.rows[ring] > RING_ROWS:
                rows.append(0)
                self.starts.append(at)
            rows[-1] += int(rings.rows[ring])
            self.of[ring] = len(rows) - 1
        self.cell, self.rows = np.arange(len(rows)), np.array(rows)
        self.keys = np.stack([self.cell, np.zeros_like(self.cell)], axis=1)
        self.parts = -(-self.rows // max(block_rows, RING_ROWS))

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(self.rings.bounds(vectors)[:, self.order], self.starts, axis=1)

    def placed(self, ringed: DataFrame) -> DataFrame:
        """Items with the place of their ring (``at``) and the key of their shelf."""
        kind = ringed.select("item_id", "vector").schema.simpleString()[7:-1] + ", at bigint, cell bigint, ring bigint"

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                at = np.array([self.rings.place[key] for key in zip(pdf["cell"].tolist(), pdf["ring"].tolist())], np.int64)
                yield pdf[["item_id", "vector"]].assign(at=at, cell=self.of[at], ring=0)

        return ringed.mapInPandas(run, kind)


def _opened(rings: Rings, queries: pd.DataFrame, items: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest items of a block to each query, or those of them within the query's ``limit``, out of the rings that may hold
    one: where no limit is known, the k-th hit in the nearest rings is one."""
    vectors, item_vectors, item_ids = _matrix(queries["vector"]), _matrix(items["vector"]), items["item_id"].to_numpy()
    here, at = np.unique(items["at"].to_numpy(), return_inverse=True)
    held = Rings(rings.pivots)
    held.cell, held.low, held.high, held.rows = rings.cell[here], rings.low[here], rings.high[here], np.bincount(at)
    ids, limits = queries["query_id"].to_numpy(), queries["limit"].to_numpy(dtype=np.float64, na_value=np.nan)
    limits, found = np.where(np.isnan(limits), np.inf, limits), []
    order = np.argsort(held.distances(vectors).argmin(axis=1), kind="stable")
    for first in range(0, len(order), BESIDE_QUERIES):
        mine = order[first:first + BESIDE_QUERIES]
        part, bounds, limit = vectors[mine], held.bounds(vectors[mine]), limits[mine].copy()

        def hits(rings_open: np.ndarray) -> pd.DataFrame:
            if rings_open.mean() > 0.5:
                return _hits(ids[mine], part, item_ids, item_vectors, k)
            those = np.flatnonzero(rings_open[at])
            return _hits(ids[mine], part, item_ids[those], item_vectors[those], k)

        if np.isinf(limit).any():
            near = held.first(bounds, k).any(axis=0)
            if near.mean() <= 0.5:
                early = hits(near).groupby("query_id")["distance"].agg(["size", "max"])
                early = early["max"].where(early["size"] >= k).reindex(ids[mine]).to_numpy()
                limit = np.fmin(limit, early)
        wanted = ~(bounds > limit[:, None])
        if wanted.any():
            found.append(hits(wanted.any(axis=0)))
    return pd.concat(found) if found else _hits(np.array([]), np.empty((0, 0)), np.array([]), np.empty((0, 0)), k)


def _ringed(items: DataFrame, k_rows: int, n: int) -> tuple[Rings, DataFrame]:
    """The rings of a table of items, and the items with their cell, ring and part."""
    pivots = items.orderBy(F.xxhash64("item_id"), "item_id").limit(min(PIVOTS, -(-n // k_rows))).select("vector").toPandas()
    rings = Rings(_matrix(pivots["vector"]))

    def to_pivots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell, away = rings.nearest_pivot(_matrix(pdf["vector"]))
                yield pdf.assign(cell=cell, away=away)

    placed = landed(items.select("item_id", "vector").mapInPandas(
        to_pivots, items.select("item_id", "vector").schema.simpleString()[7:-1] + ", cell bigint, away double"), "placed")
    shares = [i / RINGS for i in range(1, RINGS)]
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("away", shares).alias("at")).collect()
    for r in cells:  # a row for each pivot
        step = max(1, RINGS * k_rows // r["n"])
        rings.edges[r["cell"]] = np.unique(r["at"][step - 1::step]) if r["n"] > k_rows else np.zeros(0)

    def to_rings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(ring=rings.ring(pdf["cell"].to_numpy(), pdf["away"].to_numpy()))

    kind = placed.schema.simpleString()[7:-1]
    ringed = placed.mapInPandas(to_rings, kind + ", ring bigint")
    rows = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)), F.min("away"), F.max("away")).collect()  # bounded, see Rings
    rings.measured([tuple(r) for r in rows], k_rows)
    return rings, ringed


def _meet(rings: Rings, asked: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Hits of queries (query_id, vector, limit, cell, ring, parts) in the shelves they ask for. A shelf's rows and its queries are
    both cut into parts of bounded size; queries into ones of some four times ``BLOCK_ROWS``, since each part gets the shelf's rows."""
    ring = ["cell", "ring"]
    sizes = asked.groupBy(*ring).agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK_ROWS)).cast("int").alias("groups"),
                                     F.first("parts").alias("parts"))
    left = (asked.join(sizes.select(*ring, "groups"), ring)
            .withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))))
    right = (items.join(sizes, ring).withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts")).cast("int"))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))))
    keys = [*ring, "part", "group"]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _hits(np.array([]), np.empty((0, 0)), np.array([]), np.empty((0, 0)), k)
        return _opened(rings, left, right, k)

    return left.select(*keys, "query_id", "vector", "limit").groupBy(*keys).cogroup(
        right.select(*keys, "item_id", "vector", "at").groupBy(*keys)).applyInPandas(search, _HIT)


def _visits(rings: Rings, k: int, later: bool):
    """Queries with each ring they ask for: the first ones, or with a column ``limit`` all others within it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, min(512, VISITS // max(1, len(rings.cell))))
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                bounds = rings.bounds(_matrix(part["vector"]))
                mask = rings.first(bounds, k)
                limit = part["limit"].to_numpy(dtype=np.float64, na_value=np.nan) if later else np.full(len(part), np.nan)
                if later:
                    mask = ~mask & ~(bounds > limit[:, None])
                queries, opened = np.nonzero(mask)
                ids, vectors = part["query_id"].to_numpy(), part["vector"].to_numpy()
                for first in range(0, len(queries), BLOCK_ROWS):
                    query, ring = queries[first:first + BLOCK_ROWS], opened[first:first + BLOCK_ROWS]
                    yield pd.DataFrame({"query_id": ids[query], "vector": vectors[query], "limit": limit[query], "cell": rings.keys[ring, 0],
                                        "ring": rings.keys[ring, 1], "parts": rings.parts[ring]})

    return run


def nearest_by_pivots(queries: DataFrame, items: DataFrame, k: int, n: int, block_rows: int) -> DataFrame:
    """Hits (some more than k a query) in two rounds: the shelves nearest to each query that hold k items, whose k-th hit is the
    limit; then every other shelf that may hold something within the limit. Of a shelf only rings that may are searched."""
    rings, ringed = _ringed(items, block_rows, n)
    shelves = Shelves(rings, block_rows)
    placed = shelves.placed(ringed)
    kind = queries.select("query_id", "vector").schema.simpleString()[7:-1] + ", limit double, cell bigint, ring bigint, parts bigint"
    early = landed(_meet(rings, queries.select("query_id", "vector").mapInPandas(_visits(shelves, k, False), kind), placed, k), "hits")
    limit = early.groupBy("query_id").agg(F.try_element_at(F.sort_array(F.collect_list("distance")), F.lit(k)).alias("limit"))
    late = queries.select("query_id", "vector").join(limit, "query_id", "left").mapInPandas(_visits(shelves, k, True), kind)
    return early.union(_meet(rings, late, placed, k))


def nearest(queries: DataFrame, items: DataFrame, k: int = 8, block_rows: int | None = None) -> DataFrame:
    """The k nearest items of every query by Euclidean distance, exact, ties by item id.

    queries(query_id, vector), items(item_id, vector). A table of at most ``block_rows`` items (``RING_ROWS``) meets the
    queries block by block; of a larger one each query opens only the rings that may hold a hit; small rings are sent together.
    """
    n, block_rows = items.count(), block_rows or RING_ROWS
    hits = _nearest_in_blocks(queries, items, k) if n <= block_rows else nearest_by_pivots(
        queries, items, k, n, max(block_rows, -(-n // (PIVOTS * RINGS))))
    return top_per_group(hits, ["query_id"], "distance", k, ["item_id"], descending=False)


def distinct_hits(hits: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Hits with their text, copies of one text dropped after the first, renumbered, cut to k.

    ``hits`` holds a bounded number of rows per query. They meet the texts' digests first; texts come to the hits that stay.
    """
    keyed = texts.select("item_id", "text", F.md5("text").alias("digest"))
    own = keyed.groupBy("item_id", "digest").agg(F.first("text").alias("text"))
    shown = hits.join(keyed.select("item_id", "digest"), "item_id")
    first = keep_first(shown, ["query_id", "digest"], ["rank"]).withColumnRenamed("rank", "raw_rank")
    kept = top_per_group(first, ["query_id"], "raw_rank", k, ["item_id"], descending=False)
    same = (F.col("item_id") == F.col("item_id_")) & F.col("digest").eqNullSafe(F.col("digest_"))
    return kept.join(own.withColumnsRenamed({"item_id": "item_id_", "digest": "digest_"}), same).select(
        *[c for c in hits.columns if c != "rank"], "text", "digest", "raw_rank", "rank")


def context(hits: DataFrame, separator: str = "\n\n---\n\n") -> DataFrame:
    """One string per query of its hits in rank order; at most k hits per query."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda h: h["text"]), separator).alias("context"),
        F.count(F.lit(1)).alias("hits"))


def new_chunks(incoming: DataFrame, existing: DataFrame, text: str = "text") -> DataFrame:
    """Incoming rows whose text is not there yet, one per text."""
    keyed = incoming.withColumn("digest", F.md5(text))
    known = existing.select(F.md5(text).alias("digest"))
    first = [c for c in incoming.columns if c != text]
    return first_of_each_text(keyed.join(known, "digest", "left_anti").drop("digest"), text, first)


# Alternative column names, tried in order.
QA_COLUMNS = {
    "doc": ("doc_name", "doc", "document", "document_name"),
    "url": ("pdf_url", "url", "document_url"),
    "question": ("question", "prompt", "query"),
    "answer": ("answer", "final_answer", "ground_truth", "reference_answer", "label"),
}


def _first_filled(df: DataFrame, names: Sequence[str]) -> Column:
    tries = [F.when(strip(F.col(n).cast("string")) != "", F.col(n).cast("string")) for n in names if n in df.columns]
    return F.coalesce(*tries) if tries else F.lit(None).cast("string")


def _stem(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def question_answer_rows(df: DataFrame, blocked: DataFrame, base_url: str) -> DataFrame:
    """doc, url, question, answer and the row's other columns; rows without document or URL go.

    ``blocked`` holds lower-cased document names (column ``doc``) without extension.
    """
    named = df.select("*", *[_first_filled(df, names).alias(f"{part}_") for part, names in QA_COLUMNS.items()])
    base = F.regexp_extract(F.split_part("url_", F.lit("?"), F.lit(1)), r"([^/]*)$", 1)
    file = F.when(F.lower(base).endswith(".pdf"), base).otherwise(F.concat(base, F.lit(".pdf")))
    own = F.when(F.lower("doc_").endswith(".pdf"), F.col("doc_")).otherwise(F.concat("doc_", F.lit(".pdf")))
    full = named.filter(F.coalesce("doc_", "url_").isNotNull()).withColumns({
        "url_": F.coalesce("url_", F.concat(F.lit(base_url), own)),
        "doc_": F.coalesce("doc_", _stem(file))})
    kept = full.withColumn("key_", F.lower(_stem(F.col("doc_")))).join(
        blocked.select(F.col("doc").alias("key_")).distinct(), "key_", "left_anti")
    extra = [c for c in df.columns if c not in {n for names in QA_COLUMNS.values() for n in names}]
    return kept.select(*extra, F.col("doc_").alias("doc"), F.col("url_").alias("url"),
                       F.col("question_").alias("question"), F.col("answer_").alias("answer"))


def question_answers(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("question").isNotNull() & F.col("answer").isNotNull())


def documents_to_fetch(rows: DataFrame, order: str) -> DataFrame:
    """One URL per document: that of its first row."""
    return rows.groupBy("doc").agg(F.min_by("url", order).alias("url"))


# The grades of an answer; retrieval grades are missing where nothing was retrieved.
GRADES = ("correctness", "groundedness", "relevance", "retrieval_relevance")


def grade_averages(graded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of true per grade; missing grades do not count."""
    return graded.groupBy(*by).agg(*[F.avg(F.col(g).cast("int")).alias(g) for g in GRADES])


def applicable_grades(graded: DataFrame, retrieved: str) -> DataFrame:
    """Clears the two retrieval grades of rows without retrieved documents."""
    have = F.col(retrieved) > 0
    return graded.withColumns({g: F.when(have, F.col(g)) for g in ("groundedness", "retrieval_relevance")})
