"""Near duplicates among embeddings by an exact subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.llm.graph import components
from chronoloom.llm.stored import stored
from chronoloom.llm.tasks import tidy

BLOCKS = 4
CELL_DIMS = 10
"""Coordinates of a block, at most, whose signs make up its cell."""
TILE = 2048
"""Vectors of a cell compared at once; larger cells are cut into tiles, and each pair of tiles is a task's group of its own."""
PART_BYTES = 32 << 20
"""Vectors dealt to a task for comparison, about."""
SLACK = 1e-6
SEED = 5


def _packed(column: pa.Array) -> pa.Array:
    """Each row's components as bytes, in the column's own precision; null for null, for nulls or non-finite values within, and for zero vectors."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    parts = column.values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    low, high = offsets[0], offsets[-1]
    flat = np.ascontiguousarray(parts[low:high])
    at = offsets - low
    count = lambda hit: np.concatenate([[0], np.cumsum(hit)])
    odd, some = count(~np.isfinite(flat)), count(flat != 0)
    good = (odd[at[1:]] == odd[at[:-1]]) & (some[at[1:]] > some[at[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    bytes_ = flat.tobytes()
    size = flat.itemsize
    return pa.array([bytes_[a * size : b * size] if g else None for a, b, g in zip(at[:-1].tolist(), at[1:].tolist(), good.tolist())], pa.binary())


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _packed(batch.column("embedding"))], names=["vec_id", "label", "vector"])


def _doubles(packed: pa.Array, kind: str) -> np.ndarray:
    """Packed rows of one length as a matrix of doubles, each row scaled by a power of two to components of at most 1, which changes no cosine."""
    rows = np.stack([np.frombuffer(v.as_buffer(), dtype=kind) for v in packed]).astype(np.float64)
    _, exponent = np.frexp(np.abs(rows).max(axis=1, keepdims=True))
    return np.ldexp(rows, -exponent)


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation, so that no block of coordinates holds little of the distances by the way the vectors were made."""
    draw = np.random.Generator(np.random.PCG64(SEED)).normal(size=(dims, dims))
    q, r = np.linalg.qr(draw)
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    """Coordinates of each block: as even as can be."""
    ends = np.linspace(0, dims, min(BLOCKS, dims) + 1).round().astype(int)
    return list(zip(ends[:-1].tolist(), ends[1:].tolist()))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors / np.abs(vectors).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(vectors).max(axis=1, keepdims=True)


def budgets(dims: int, cosine: float) -> list[float]:
    """Squared distance that each block may hold: of the whole budget 2 - 2 cos, its share of the coordinates."""
    return [(2 - 2 * cosine) * (high - low) / dims + SLACK for low, high in blocks(dims)]


def cells(part: np.ndarray, budget: float) -> list[tuple[int, np.ndarray]]:
    """Cells of a block that vectors reach: (cell, rows), the sign pattern of the first CELL_DIMS coordinates.

    Two vectors within the budget both lie within half their distance of their middle, so both reach the middle's cell: the cells whose squared
    distance is a quarter of the budget or less. A cell's squared distance is the sum of squares of the coordinates whose signs it flips.
    """
    dims = min(CELL_DIMS, part.shape[1])
    head = part[:, :dims]
    home = ((head >= 0) << np.arange(dims)).sum(axis=1)
    square = head * head
    out = [(home, np.arange(len(part)))]
    reach = budget / 4
    for n in range(1, dims + 1):
        any_ = False
        for flipped in combinations(range(dims), n):
            rows = np.flatnonzero(square[:, list(flipped)].sum(axis=1) <= reach)
            if len(rows):
                any_ = True
                out.append((home[rows] ^ sum(1 << k for k in flipped), rows))
        if not any_:
            break
    return [(c, r) for c, r in out]


def _placed(cosine: float, kind: str):
    """Rows (label, dims, cell, node) for each cell that a vector reaches; the cell's number holds block and signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("vector")).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                dims = int(size) // np.dtype(kind).itemsize
                vectors = _doubles(part.column("vector"), kind)
                turned = unit_rows(vectors) @ rotation(dims)
                label, node = part.column("label").to_numpy().astype(np.int64), part.column("node")
                for number, ((low, high), budget) in enumerate(zip(blocks(dims), budgets(dims, cosine))):
                    found = cells(turned[:, low:high], budget)
                    rows = np.concatenate([r for _, r in found])
                    sign = np.concatenate([c for c, _ in found])
                    names = ["label", "dims", "cell", "node"]
                    arrays = [pa.array(label[rows]), pa.array(np.full(len(rows), dims, dtype=np.int32)), pa.array((number << 16 | sign).astype(np.int32)), node.take(pa.array(rows))]
                    for at in range(0, len(rows), 20_000):
                        yield pa.RecordBatch.from_arrays([a.slice(at, 20_000) for a in arrays], names=names)

    return run


def _tile_links(dims: int, cell: int, tiles: tuple[int, int], tile: np.ndarray, node: np.ndarray, vectors: np.ndarray, cosine: float):
    """Links within a tile or between two: (rows of nodes, links of each, a root of each).

    A pair may meet in several cells and blocks. It counts in the first block in which it is within the budget, and there in the cell of its middle; so once.
    """
    unit = unit_rows(vectors)
    turned = unit @ rotation(dims)
    number, sign = cell >> 16, cell & 0xFFFF
    parts, limit = blocks(dims), budgets(dims, cosine)
    left = np.flatnonzero(tile == tiles[0])
    right = np.flatnonzero(tile == tiles[1])
    a, b = np.nonzero(unit[left] @ unit[right].T >= cosine - 1e-9)
    a, b = left[a], right[b]
    if tiles[0] == tiles[1]:
        a, b = a[a < b], b[a < b]
    if not len(a):
        return None
    keep = []
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        size = np.sqrt(np.einsum("ij,ij->i", vectors[x], vectors[x]) * np.einsum("ij,ij->i", vectors[y], vectors[y]))
        good = np.einsum("ij,ij->i", vectors[x], vectors[y]) / size >= cosine
        for k, (low, high) in enumerate(parts[: number + 1]):
            gap = turned[x, low:high] - turned[y, low:high]
            within = np.einsum("ij,ij->i", gap, gap) <= limit[k]
            good &= within if k == number else ~within
        low, high = parts[number]
        width = min(CELL_DIMS, high - low)
        middle = ((turned[x, low : low + width] + turned[y, low : low + width] >= 0) << np.arange(width)).sum(axis=1)
        keep.append(good & (middle == sign))
    keep = np.concatenate(keep)
    a, b = a[keep], b[keep]
    if not len(a):
        return None
    root = np.arange(len(node))
    while True:  # the smallest row that links lead to, within these pairs
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return a, b, root


def _links(cosine: float, kind: str):
    """Partial results (node, n, root) of the groups of a partition that is sorted by group.

    ``n`` counts rows linked to the node, copies included; (node, root) connects the node to another one that links lead to.
    """

    def group(key: tuple, rows: pa.Table):
        tile, copies = rows.column("tile").to_numpy(), rows.column("copies").to_numpy()
        node = rows.column("node").to_numpy()
        vectors = _doubles(rows.column("vector").combine_chunks(), kind)
        got = _tile_links(key[1], key[2], (key[3], key[4]), tile, node, vectors, cosine)
        if got is None:
            return None
        a, b, root = got
        n = np.bincount(a, weights=copies[b], minlength=len(node)) + np.bincount(b, weights=copies[a], minlength=len(node))
        hit = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(n[hit].astype(np.int64)), pa.array(node[root[hit]])], names=["node", "n", "root"])

    names = ("label", "dims", "cell", "tile_a", "tile_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in names]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if batch.num_rows > 1 else np.zeros(0, dtype=int)
            bounds = [0, *change.tolist(), batch.num_rows]
            for low, high in zip(bounds, bounds[1:]):
                if high == low:
                    continue
                key = tuple(int(k[low]) for k in keys)
                if key != held_key and held:
                    if sum(h.num_rows for h in held) > 1 and (out := group(held_key, pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held_key = key
                held.append(batch.slice(low, high - low))
        if held and sum(h.num_rows for h in held) > 1 and (out := group(held_key, pa.Table.from_batches(held))) is not None:
            yield out

    return run


def _label(vectors: DataFrame) -> Column:
    """A number for each label, the same for equal labels only; null for null. Numbers with fractions count as they are."""
    kind = vectors.schema["label"].dataType
    if isinstance(kind, T.IntegralType):
        return F.col("label").cast("long")
    value = F.col("label") + F.lit(0.0) if isinstance(kind, T.FractionalType) else F.col("label")  # 0.0 and -0.0 are equal
    return F.when(F.col("label").isNotNull(), F.xxhash64(value))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """One row for each row of ``vectors(vec_id, embedding, label)``: vec_id, n_links, component_id, kept.

    Two vectors link if their labels are equal and not null, they have the same number of components, and their cosine in double precision is at least ``cosine``. ``n_links`` counts
    the other rows linked with a row; ``component_id`` is the smallest id that links lead to, ``kept`` whether that is the row's own.

    Equal vectors of a label are one node with a count, so copies are not paired. The join is exact: nodes of unit length are rotated and
    cut into blocks; a pair within the squared distance of the cosine is within some block's share of it, and meets in the cell of
    that block that holds the pair's middle. Cells with more than TILE nodes are cut into tiles, and pairs of tiles are compared apart.

    Vectors that are null, zero, empty or hold null or non-finite components, and those with a null label, link with nothing; repeated rows are equal vectors; null ids are passed
    over as smallest ids; an empty table gives an empty table. Other columns are ignored.
    """
    spark = vectors.sparkSession
    part = vectors.schema["embedding"].dataType.elementType
    kind = "f4" if isinstance(part, T.FloatType) else "f8"
    embedding = F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>")
    rows = vectors.select("vec_id", _label(vectors).alias("label"), embedding.alias("embedding")).mapInArrow(tidy(_keyed), "vec_id long, label long, vector binary")
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull() & F.col("label").isNotNull(), F.xxhash64("label", "vector")))
    rows = stored(rows, "vector-rows")
    nodes = stored(
        rows.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")),
        "vector-nodes",
    )
    key = "label long, dims int, cell int, node long"
    light = nodes.select("label", "vector", "node")
    cells_of = stored(light.mapInArrow(tidy(_placed(cosine, kind)), key), "vector-places")
    full = cells_of.groupBy("label", "dims", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = stored(full.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "vector-cells")
    # Vectors travel to the cells they share with others only; which these are is found on keys.
    placed = cells_of.join(full, ["label", "dims", "cell"]).join(nodes.select("node", "copies", "vector"), "node")
    tiled = placed.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("label", "dims", "cell", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile", "node", "copies", "vector")
    group = ["label", "dims", "cell", "tile_a", "tile_b"]
    total = full.agg(F.coalesce(F.sum(F.col("n") * F.col("tiles")), F.lit(0))).first()[0]
    width = nodes.agg(F.coalesce(F.max(F.octet_length("vector")), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, -(-total * (width + 40) // PART_BYTES))
    dealt = tiled.repartition(parts, *group).sortWithinPartitions(*group)
    partial = stored(dealt.mapInArrow(tidy(_links(cosine, kind)), "node long, n long, root long"), "vector-links")
    counts = partial.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(partial.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    known = nodes.select("node", "copies", "least").join(counts, "node", "left").join(roots, "node", "left")
    known = known.select("node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"), "least")
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "root").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
