"""Exact top-k by inner product, with a table of distances to pivots that rules candidates out.

Vectors become whole numbers. With one more coordinate, ``sqrt(M - |x|^2)`` for a candidate ``x`` (``M`` the largest squared norm) and 0 for a query, the
squared distance of query and candidate is ``|q|^2 + M - 2 q.x``: the largest product is the smallest distance, and distances obey the triangle
inequality. For every candidate a table holds the distances to many pivots; for a query the largest difference between its
own distances to the pivots and the candidate's is a lower bound of their distance, and so gives an upper bound of the product.

Candidates lie in blocks, by nearest pivot and the distance to it. A query is first held against the ranges of a block's distances. In a
block that stays, candidates that the pivots rule out go, pivot by pivot; the others are evaluated exactly, in the order of their bounds, until the
next bound is below the k-th best product so far. That starts from the k-th best product within the query's own block. Distances are
taken with a margin above their rounding, so nothing that belongs to the result is ruled out; products are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.llm.stored import stored
from chronoloom.session import scratch_path

PIVOTS = 64
SAMPLE_ROWS = 2048
"""Rows, lowest by hash, among which pivots are chosen. Pivots decide how much is ruled out, not what is found."""

BLOCK_ROWS = 512
TASK_BYTES = 32 << 20
QUERY_BYTES = 8 << 20
"""Vectors of queries that are held against all candidates at once; more queries go through in further rounds."""

LARGEST = 1 << 26
ROUND = 32
"""Candidates of a query evaluated at once."""

NO_BAR = -(1 << 62)
BLOCK = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("asks", T.ArrayType(T.BooleanType())),
        T.StructField("bars", T.ArrayType(T.LongType())),
        T.StructField("values", T.ArrayType(T.IntegerType())),
        *[T.StructField(name, T.ArrayType(T.FloatType())) for name in ("distances", "low", "high")],
    ]
)


def _rows(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows (id, asks, values) of the vectors that take part, in whole numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            offsets, parts = lists.offsets.to_numpy(), lists.values.fill_null(math.nan).to_numpy()
            good = np.isfinite(parts)
            wrong = np.concatenate([[0], np.cumsum(~good)])
            keep = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            whole = np.floor(scale * np.where(good, parts, 0.0))
            outside = np.concatenate([[0], np.cumsum(np.abs(whole) >= LARGEST)])
            if (keep & (outside[offsets[1:]] > outside[offsets[:-1]])).any():
                raise ValueError(f"a component times {scale} is {LARGEST} or more")
            whole = np.clip(whole, -LARGEST, LARGEST).astype(np.int32)
            values = pa.ListArray.from_arrays(lists.offsets, pa.array(whole))
            out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("asks"), values], ["id", "asks", "values"])
            yield out.filter(pa.array(keep))

    return vectors.mapInArrow(scan, "id bigint, asks boolean, values array<int>")


def _dense(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array, with zeros for components that they lack."""
    flat = lists.flatten().to_numpy()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(lists) * dims and (sizes == dims).all():
        return flat.reshape(len(lists), dims).astype(np.int64)
    out = np.zeros((len(lists), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass
class Space:
    """What the whole table fixes: rows, components of a vector, the largest squared norm, and the pivots."""

    rows: int
    dims: int
    largest: int
    pivots: np.ndarray

    @property
    def slack(self) -> float:
        """Above the rounding of two distances kept in single precision."""
        return 1e-6 * (2 * math.sqrt(self.largest) + 1)

    def number(self, values: np.ndarray) -> np.ndarray:
        """Values in a type whose products are exact and fast: sums of products stay below 2^53 where the largest norm does."""
        return values.astype(np.float64) if self.largest < 1 << 53 else values

    def rest(self, values: np.ndarray) -> np.ndarray:
        """The further coordinate of candidates."""
        return np.sqrt(np.maximum(self.largest - (values * values).sum(axis=1), 0).astype(np.float64))

    def distances(self, values: np.ndarray, candidate: bool) -> np.ndarray:
        """Distances of candidates or queries to the pivots, which are candidates."""
        norm = (values * values).sum(axis=1).astype(np.float64)
        pivot_norm = (self.pivots * self.pivots).sum(axis=1).astype(np.float64)
        square = norm[:, None] + pivot_norm[None, :] - 2.0 * (values.astype(np.float64) @ self.pivots.T.astype(np.float64))
        gap = self.rest(values)[:, None] * candidate - self.rest(self.pivots)[None, :]
        return np.sqrt(np.maximum(square + gap * gap, 0))

    def most(self, norm: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The largest product that a query of this squared norm can have with a candidate no nearer than ``distance``."""
        near = np.maximum(distance - self.slack, 0)
        total = norm + float(self.largest)
        return (total - near * near) / 2 + 1e-9 * total + 1e-6


def _space(rows: DataFrame) -> Space:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = dims = largest = 0
        for batch in batches:
            if batch.num_rows:
                width = int(pc.max(pc.list_value_length(batch.column("values"))).as_py() or 0)
                values = _dense(batch.column("values"), width)
                count, dims = count + batch.num_rows, max(dims, width)
                largest = max(largest, int((values * values).sum(axis=1).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (count, dims, largest)], ["n", "dims", "largest"])

    total = rows.mapInArrow(measure, "n bigint, dims bigint, largest bigint").agg(F.sum("n"), F.max("dims"), F.max("largest")).first()
    count, dims, largest = (int(x or 0) for x in total)
    sample = rows.select("values").orderBy(F.xxhash64("values"), "values").limit(SAMPLE_ROWS).collect() if count else []
    space = Space(count, dims, largest, np.zeros((0, dims), dtype=np.int64))
    if sample:
        values = _dense(pa.array([row["values"] for row in sample], pa.list_(pa.int64())), dims)
        space.pivots = values[:1]
        nearest = space.distances(values, True)[:, 0]
        while len(space.pivots) < PIVOTS and nearest.max() > 0:  # the row farthest from the pivots so far is the next one
            chosen = values[[int(nearest.argmax())]]
            nearest = np.minimum(nearest, Space(count, dims, largest, chosen).distances(values, True)[:, 0])
            space.pivots = np.concatenate([space.pivots, chosen])
    return space


def _top(scores: np.ndarray, same: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest product of each row among the columns that are not the row's own; ``NO_BAR`` where there are fewer."""
    scores = np.where(same, NO_BAR, scores)
    return np.partition(scores, -k, axis=1)[:, -k].astype(np.int64) if scores.shape[1] >= k else np.full(len(scores), NO_BAR)


def build_table(rows: DataFrame, space: Space, k: int) -> DataFrame:
    """The pivot table in blocks (see ``BLOCK``): candidates with their distances, the ranges of these, and for queries among them
    the k-th best product within the block. Blocks hold candidates of one nearest pivot at nearly one distance from it; ranges of pivot, distance and id
    deal them out, so vectors that are all alike are split as well."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = space.distances(_dense(batch.column("values"), space.dims), True)
            near = far.argmin(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(far.astype(np.float32).ravel()), len(space.pivots)).cast(pa.list_(pa.float32()))
            own = pa.array(far[np.arange(len(far)), near].astype(np.float32))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(near.astype(np.int32)), own], ["id", "asks", "values", "distances", "near", "far"])

    def block(rows: pa.Table) -> pa.RecordBatch:
        ids, asks = rows.column("id").combine_chunks(), rows.column("asks").combine_chunks()
        values = _dense(rows.column("values").combine_chunks(), space.dims)
        far = rows.column("distances").combine_chunks().flatten().to_numpy().reshape(len(values), -1)
        asking = np.flatnonzero(asks.to_numpy(zero_copy_only=False))
        numbers, plain = space.number(values), ids.fill_null(0).to_numpy()
        same = (plain[asking][:, None] == plain[None, :]) & ids.is_valid().to_numpy(zero_copy_only=False)[None, :]
        bars = np.full(len(values), NO_BAR)
        bars[asking] = _top(numbers[asking] @ numbers.T, same, k)
        parts = [ids, asks, pa.array(bars), pa.array(values.astype(np.int32).ravel()), *[pa.array(x) for x in (far.ravel(), far.min(axis=0), far.max(axis=0))]]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in parts], BLOCK.fieldNames())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, pivot = 0, -1
        for batch in batches:
            near, low = batch.column("near").to_numpy(), 0
            while low < batch.num_rows:
                if size and (near[low] != pivot or size >= BLOCK_ROWS):
                    yield block(pa.Table.from_batches(held))
                    held, size = [], 0
                pivot = near[low]
                high = min(low + BLOCK_ROWS - size, int(np.searchsorted(near, pivot, "right")))
                held.append(batch.slice(low, high - low))
                size, low = size + high - low, high
        if size:
            yield block(pa.Table.from_batches(held))

    far = rows.mapInArrow(measure, "id bigint, asks boolean, values array<int>, distances array<float>, near int, far float")
    wanted = math.ceil(space.rows * 4 * (space.dims + len(space.pivots) + 4) / TASK_BYTES)
    order = ["near", "far", "id"]
    dealt = far.repartitionByRange(max(wanted, rows.sparkSession.sparkContext.defaultParallelism), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(gather, BLOCK)


def _parts(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
    for at in range(batch.num_rows):
        yield {name: batch.column(name)[at].values for name in BLOCK.fieldNames()}


def _asking(table: DataFrame, dims: int) -> DataFrame:
    """The queries among a table's candidates: rows (id, values, bar), rows equal in id and vector once."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _parts(batch):
                values = pa.FixedSizeListArray.from_arrays(own["values"], dims).cast(pa.list_(pa.int32())) if dims else pa.array([[]] * len(own["ids"]), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([own["ids"], values, own["bars"]], ["id", "values", "bar"]).filter(own["asks"])

    return table.select(*BLOCK.fieldNames()).mapInArrow(pick, "id bigint, values array<int>, bar bigint").groupBy("id", "values").agg(F.max("bar").alias("bar"))


class _Search:
    """A round of queries held against one block of candidates after the other."""

    def __init__(self, space: Space, ids: np.ndarray, values: np.ndarray, bars: np.ndarray, k: int) -> None:
        self.space, self.ids, self.k = space, ids, k
        self.values = space.number(values)
        self.norm = (values * values).sum(axis=1).astype(np.float64)
        self.far = space.distances(values, False)
        self.bar = bars.copy()  # the k-th best product known so far
        none = np.zeros(0, np.int64)
        self.query, self.score, self.id, self.none = none, none, none, np.zeros(0, bool)

    def _add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        old = np.isin(self.query, query)
        query, score, ids, none = (np.concatenate([mine[old], new]) for mine, new in ((self.query, query), (self.score, score), (self.id, ids), (self.none, none)))
        order = np.lexsort((ids, none, -score, query))
        query, score, ids, none = (x[order] for x in (query, score, ids, none))
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        full = place == self.k - 1
        self.bar[query[full]] = np.maximum(self.bar[query[full]], score[full])
        self.query, self.score, self.id, self.none = (
            np.concatenate([mine[~old], new[keep]]) for mine, new in ((self.query, query), (self.score, score), (self.id, ids), (self.none, none))
        )

    def block(self, own: dict[str, pa.Array]) -> None:
        low, high = own["low"].to_numpy(), own["high"].to_numpy()
        gap = np.maximum(np.maximum(self.far - high, low - self.far), 0).max(axis=1)
        live = np.flatnonzero(self.space.most(self.norm, gap) >= self.bar)
        if not len(live):
            return
        ids, none = own["ids"].fill_null(0).to_numpy(), own["ids"].is_null().to_numpy(zero_copy_only=False)
        far = own["distances"].to_numpy().reshape(len(ids), -1).T
        bounds = np.zeros((len(live), len(ids)), dtype=np.float32)
        for pivot in range(len(far)):
            np.maximum(bounds, np.abs(self.far[live, pivot].astype(np.float32)[:, None] - far[pivot][None, :]), out=bounds)
            if pivot % 16 == 15:
                left = self.space.most(self.norm[live], bounds.min(axis=1)) >= self.bar[live]
                live, bounds = live[left], bounds[left]
                if not len(live):
                    return
        values = self.space.number(own["values"].to_numpy().reshape(len(ids), -1).astype(np.int64))
        order = np.argsort(bounds, axis=1)
        for at in range(0, len(ids), ROUND):
            left = self.space.most(self.norm[live], bounds[np.arange(len(live)), order[:, at]]) >= self.bar[live]
            live, bounds, order = live[left], bounds[left], order[left]
            if not len(live):
                return
            some = order[:, at : at + ROUND]
            score = np.einsum("qd,qcd->qc", self.values[live], values[some]).astype(np.int64)
            good = (score >= self.bar[live][:, None]) & ~((ids[some] == self.ids[live][:, None]) & ~none[some])
            if good.any():
                query = np.broadcast_to(live[:, None], some.shape)[good]
                self._add(query, score[good], ids[some][good], none[some][good])


def search_table(table: DataFrame, space: Space, ids: np.ndarray, values: np.ndarray, bars: np.ndarray, k: int) -> DataFrame:
    """The ``k`` best candidates of each of the given queries: rows (query, score, id, rank)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Search(space, ids, values, bars, k)
        for batch in batches:
            for own in _parts(batch):
                found.block(own)
        yield pa.RecordBatch.from_arrays([pa.array(found.query), pa.array(found.score), pa.array(found.id, mask=found.none)], ["query", "score", "id"])

    found = table.mapInArrow(search, "query bigint, score bigint, id bigint")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def nearest_by_product(
    vectors: DataFrame, asks: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """For every row where ``asks`` holds, the ``k`` rows with the largest inner product among all rows of another id.

    Components are multiplied by ``scale`` and rounded down; the product of the whole numbers is the score. Returns ``query_id`` long, ``rank`` int from
    1, the id and ``score`` long; equal scores rank by id, rows without an id last. All candidates are in the pivot table and the result is exact.

    Vectors that are null or hold null or non-finite components take no part; rows without an id are candidates only. Queries equal in id and
    vector are one, queries of one id and several vectors are searched for one by one; repeated candidates rank each. Missing components count as
    0, so an empty vector scores 0 with all. Components that reach ``LARGEST`` are an error, as scores would leave 64 bits. Fewer than ``k`` other rows
    give fewer ranks, an empty table none. Other columns do not matter. Ids must be whole numbers.
    """
    if not isinstance(vectors.schema[id_column].dataType, T.IntegralType):
        raise ValueError(f"{id_column} must be a whole number, as it decides ties")
    spark = vectors.sparkSession
    asking = F.coalesce(asks & F.col(id_column).isNotNull(), F.lit(False))
    rows = _rows(vectors.select(F.col(id_column).cast("bigint").alias("id"), asking.alias("asks"), F.col(vector_column).cast("array<double>").alias("vector")), scale)
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField(id_column, T.LongType()), T.StructField("score", T.LongType())])
    space = _space(rows)
    if not space.rows:
        return spark.createDataFrame([], result)
    table = stored(build_table(rows, space, k), "pivot-table", **{"parquet.block.size": str(8 << 20)})
    queries = stored(_asking(table, space.dims), "pivot-queries")
    wanted = max(1, math.ceil(queries.count() * 8 * (space.dims + len(space.pivots) + 4) / QUERY_BYTES))
    folder = scratch_path(spark, "pivot-found")
    out = None
    for number in range(wanted):
        own = queries.where(F.pmod(F.xxhash64("id", "values"), F.lit(wanted)) == number).collect()  # some QUERY_BYTES at most
        if not own:
            continue
        ids, bars = (np.array([row[name] for row in own], dtype=np.int64) for name in ("id", "bar"))
        values = _dense(pa.array([row["values"] for row in own], pa.list_(pa.int64())), space.dims)
        found = search_table(table, space, ids, values, bars, k)
        names = spark.createDataFrame([(at, int(x)) for at, x in enumerate(ids)], "query bigint, query_id bigint")
        out = found.join(names, "query").select("query_id", "rank", F.col("id").alias(id_column), "score")
        if wanted > 1:
            out.write.parquet(f"{folder}/{number}")
    if wanted > 1 and out is not None:
        return spark.read.schema(result).parquet(f"{folder}/*")
    return spark.createDataFrame([], result) if out is None else out
