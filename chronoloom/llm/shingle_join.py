"""Near duplicates by a Jaccard join on word shingles with PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm import arrowtext
from chronoloom.llm.graph import components
from chronoloom.llm.stored import fresh, stored
from chronoloom.llm.tasks import tidy

SHINGLE = 5
LOW, HIGH = 80, 100
"""Sets link if HIGH * intersection >= LOW * union."""
BAND_GROWTH = 1.6
COMMON_SAMPLE = 16
"""One in so many distinct texts is looked at for common shingles."""
MOST_COMMON = 100_000
"""Common shingles kept, at most. Which shingles count as common changes how long the join takes, not what it finds."""
FLUSH = 1 << 20
FILTER_BITS = 1 << 23
KNOWN_PAIRS = 1 << 21
"""Pairs a task remembers in order not to write them again; more are written again and dropped afterwards."""
TILE = 4096
"""Members of a group whose sketches are compared at once; larger groups are cut into tiles, each pair of tiles apart."""
PER_BUCKET = 2
"""Shingles in a bucket of a sketch, on average at most."""


@cache
def bands(largest: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size bands: band i has sizes from ``bands()[i]`` up to the next one."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, int(ends[-1] * BAND_GROWTH)))
    return np.array(ends)


def partitions(band: int) -> int:
    """Parts of the shingle domain in a band: one more than the most shingles in which two linked sets can differ.

    With J the similarity, sets of sizes p and q differ in at most ``(p + q) (1 - J) / (1 + J)`` shingles, and neither is above the band's upper end.
    """
    top = int(bands()[band + 1]) - 1
    return 2 * top * (HIGH - LOW) // (HIGH + LOW) + 1


def signatures(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Signatures of one set of distinct shingle hashes; sets that link share at least one.

    A pair is found in the band of its larger set, so a set signs for its own band and, if it could be the smaller one there, for the next.
    The domain is cut into ``partitions(band)`` parts by hash. Two linked sets differ in fewer shingles than there are
    parts, so in some part they do not differ: the signatures are the sets' projections on each part. (This is
    PartEnum with subsets of one part.) A projection without shingles, or with ``common`` ones only, says little. For
    such parts all that share them sign once more, with the prefix that any two linked sets must share a shingle of: their first
    ``size - ceil(J size) + 1`` shingles, common ones last.
    """
    size = len(values)
    own = int(np.searchsorted(bands(), size, "right")) - 1
    chosen = [own]
    if size * HIGH >= int(bands()[own + 1]) * LOW:
        chosen.append(own + 1)
    if len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        rare = common[at] != values
    else:
        rare = np.ones(size, dtype=bool)
    out = []
    spread = arrowtext.mix(values)
    for band in chosen:
        parts = partitions(band)
        salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        part = (spread % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        start = np.flatnonzero(np.diff(part[order], prepend=-1))
        sums = np.add.reduceat(arrowtext.mix(values[order] ^ salt), start)
        telling = np.logical_or.reduceat(rare[order], start)
        where = part[order][start].astype(np.uint64)
        out.append(arrowtext.mix((sums + where * np.uint64(0xC2B2AE3D27D4EB4F)) ^ salt)[telling])
        if telling.sum() < parts:
            length = size - -(-size * LOW // HIGH) + 1
            prefix = np.concatenate((values[rare], values[~rare]))[:length]
            out.append(arrowtext.mix(prefix + (salt ^ np.uint64(0x51ED270B27D4EB4F))))
    return np.concatenate(out)


def set_key(values: np.ndarray) -> int:
    """A hash of a set of shingle hashes."""
    total = np.sum(arrowtext.mix(values + np.uint64(0xA24BAED4963EE407)), dtype=np.uint64)
    return int(arrowtext.mix((total + np.uint64(len(values))).reshape(1)).view(np.int64)[0])


def sketch(values: np.ndarray) -> bytes:
    """How many shingles of a set fall in each bucket of the hash range, a byte each; a power of two of buckets.

    Should a bucket hold more than a byte can say, the sketch is a single 0, which rules nothing out.
    """
    bits = max(int(-(-len(values) // PER_BUCKET) - 1).bit_length(), 3)
    counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"\0"


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches with as many buckets as the shortest has; neighbouring buckets are added up."""
    buckets = min(map(len, sketches))
    if buckets == 1:
        return np.zeros((len(sketches), 1), dtype=np.int32)
    return np.stack([np.frombuffer(x, dtype=np.uint8).reshape(buckets, -1).sum(axis=1, dtype=np.int32) for x in sketches])


def could_link(size_a: int, sketch_a: bytes, size_b: int, sketch_b: bytes) -> bool:
    """Whether two sets may be similar enough, by their sizes and sketches; never false for sets that link.

    Sets differ in at least as many shingles as the counts of their buckets do, summed over all buckets.
    """
    if min(size_a, size_b) * HIGH < max(size_a, size_b) * LOW:
        return False
    a, b = _folded([sketch_a, sketch_b])
    return int(np.abs(a - b).sum()) * (HIGH + LOW) <= (size_a + size_b) * (HIGH - LOW)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [batch.column(k).to_pylist() for k in ("size_a", "sketch_a", "size_b", "sketch_b")]
        yield batch.select(["a", "b"]).filter(pa.array([could_link(*x) for x in zip(*sides)], pa.bool_()))


class _Fresh:
    """Pairs not met before in this task. Groups that share members are dealt to one task, so most repeated pairs end here."""

    def __init__(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = arrowtext.mix(arrowtext.mix(a.view(np.uint64)) + b.view(np.uint64))
        key, at = np.unique(key, return_index=True)
        new = ~np.isin(key, self.known, assume_unique=True)
        if len(self.known) < KNOWN_PAIRS:
            self.known = np.concatenate((self.known, key[new]))
        return a[at[new]], b[at[new]]


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a group's members from different components that may link, of a partition sorted by group."""
    names = ("grp", "tile_a", "tile_b")

    fresh = _Fresh()

    def pairs(key: tuple, rows: pa.Table) -> pa.RecordBatch | None:
        node, root, size, tile = (rows.column(k).to_numpy() for k in ("node", "root", "size", "tile"))
        table = _folded(rows.column("sketch").to_pylist())
        found_a, found_b = [], []
        for i in np.flatnonzero(tile == key[1]):
            # Within a tile each pair is met once, in order; between two tiles the second one holds the partners.
            j = np.flatnonzero((tile == key[2]) & (root != root[i]) & ((node < node[i]) if key[1] == key[2] else True))
            j = j[np.minimum(size[i], size[j]) * HIGH >= np.maximum(size[i], size[j]) * LOW]
            j = j[np.abs(table[j] - table[i]).sum(axis=1) * (HIGH + LOW) <= (size[i] + size[j]) * (HIGH - LOW)]
            found_a.append(np.full(len(j), node[i]))
            found_b.append(node[j])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        a, b = fresh.of(np.maximum(a, b), np.minimum(a, b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

    held, held_key = [], None
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in names]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            if high == low:
                continue
            key = tuple(int(k[low]) for k in keys)
            if key != held_key and held:
                if (out := pairs(held_key, pa.Table.from_batches(held))) is not None:
                    yield out
                held = []
            held_key = key
            held.append(batch.slice(low, high - low))
    if held and (out := pairs(held_key, pa.Table.from_batches(held))) is not None:
        yield out


def _sets(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's shingle set, sorted; rows without words have none."""
    data, offsets = arrowtext.text_bytes(batch.column(name))
    rows, values = arrowtext.shingles(arrowtext.words(data, offsets, arrowtext.NOT_SPACE, arrowtext.LOWER), SHINGLE)
    ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    for row in range(batch.num_rows):
        if ends[row + 1] > ends[row]:
            yield row, values[ends[row] : ends[row + 1]]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrowtext.slices(batches, "text"):
        node, size = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
        sketches: list[bytes | None] = [None] * batch.num_rows
        for row, values in _sets(batch, "text"):
            node[row], size[row], sketches[row] = set_key(values), len(values), sketch(values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size), pa.array(node, mask=size == 0), batch.column("text_hash"), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "node", "text_hash", "sketch"],
        )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrowtext.slices(batches, "text"):
        for _, values in _sets(batch, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["shingle"])


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that stand in at least four of the sampled distinct texts, the most frequent MOST_COMMON."""
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(COMMON_SAMPLE)) == 0).select("text").distinct()
    counts = sample.mapInArrow(tidy(_shingle_rows), "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n >= 4")
    top = counts.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle")
    return np.sort(np.array([r[0] for r in top.collect()], dtype=np.int64).view(np.uint64))


def _signed(common, parts: int):
    """Signatures of the distinct sets of a partition, packed by the part of the shuffle they go to.

    A packed row holds nodes, how many signatures each has here, and the signatures.
    """

    def flush(nodes: list[int], signs: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in signs])
        sign = np.concatenate(signs)
        owner = np.repeat(np.arange(len(nodes)), sizes)
        to = (sign % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((owner, to))
        sign, owner, to = sign[order], owner[order], to[order]
        start = np.flatnonzero(np.diff(to, prepend=-1))
        ids = np.array(nodes, dtype=np.int64)
        rows = []
        for low, high in zip(start.tolist(), [*start[1:].tolist(), len(to)]):
            first = np.flatnonzero(np.diff(owner[low:high], prepend=-1))
            count = np.diff(np.append(first, high - low))
            rows.append((ids[owner[low:high][first]].tobytes(), count.astype(np.int32).tobytes(), sign[low:high].tobytes()))
        binary = [pa.array([r[k] for r in rows], pa.binary()) for k in range(3)]
        return pa.RecordBatch.from_arrays([pa.array(to[start].astype(np.int32)), *binary], names=["part", "nodes", "counts", "signs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        nodes, signs, held = [], [], 0
        for batch in arrowtext.slices(batches, "text"):
            for _, values in _sets(batch, "text"):
                key = set_key(values)
                if key in seen:
                    continue
                seen.add(key)
                nodes.append(key)
                signs.append(signatures(values, common.value))
                held += len(signs[-1])
                if held >= FLUSH:
                    yield flush(nodes, signs)
                    nodes, signs, held = [], [], 0
        if nodes:
            yield flush(nodes, signs)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets that share a signature, from the packed rows of one part: (grp, node, leader, second, third), each distinct list of members once.

    The leaders are the smallest and the largest member, and the smallest by another hash.
    """
    signs, nodes = [], []
    for batch in batches:
        for k in range(batch.num_rows):
            own = np.frombuffer(batch.column("nodes")[k].as_buffer(), dtype=np.int64)
            signs.append(np.frombuffer(batch.column("signs")[k].as_buffer(), dtype=np.uint64))
            nodes.append(np.repeat(own, np.frombuffer(batch.column("counts")[k].as_buffer(), dtype=np.int32)))
    if not signs:
        return
    sign, node = np.concatenate(signs), np.concatenate(nodes)
    del signs, nodes
    order = np.argsort(sign, kind="stable")
    sign, node = sign[order], node[order]
    shared = np.zeros(len(sign), dtype=bool)
    shared[1:] = sign[1:] == sign[:-1]
    shared[:-1] |= shared[1:]
    sign, node = sign[shared], node[shared]
    order = np.lexsort((node, sign))
    sign, node = sign[order], node[order]
    fresh = np.ones(len(sign), dtype=bool)
    fresh[1:] = (sign[1:] != sign[:-1]) | (node[1:] != node[:-1])
    sign, node = sign[fresh], node[fresh]
    if not len(sign):
        return
    start = np.flatnonzero(np.append(True, sign[1:] != sign[:-1]))
    size = np.diff(np.append(start, len(sign)))
    key = arrowtext.mix(np.add.reduceat(arrowtext.mix(node.view(np.uint64)), start) + size.astype(np.uint64))
    keep = np.zeros(len(start), dtype=bool)
    keep[np.unique(key, return_index=True)[1]] = True
    keep &= size > 1
    member = np.repeat(keep, size)
    other = arrowtext.mix(node.view(np.uint64) ^ np.uint64(0x7A5662C8D27D4EB1))
    least = np.minimum.reduceat(other, start)
    third = node[np.flatnonzero(other == np.repeat(least, size))][: len(start)]
    leaders = [np.repeat(x, size)[member] for x in (node[start], node[start + size - 1], third)]
    out = [np.repeat(key.view(np.int64), size)[member], node[member], *leaders]
    for low in range(0, len(out[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[low : low + 100_000]) for x in out], names=["grp", "node", "leader", "second", "third"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets reach the similarity. Rows with one ``b`` stand together, so its set is made once."""
    for batch in batches:
        for part in arrowtext.slices(iter([batch]), "text_a"):
            b = part.column("b").to_numpy()
            first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            of_b = np.cumsum(np.append(True, b[1:] != b[:-1])) - 1
            sets_a = dict(_sets(part, "text_a"))
            sets_b = dict(_sets(part.take(pa.array(first)), "text_b"))
            good = np.zeros(part.num_rows, dtype=bool)
            for row, x in sets_a.items():
                y = sets_b[of_b[row]]
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                good[row] = HIGH * both >= LOW * (len(x) + len(y) - both)
            if good.any():
                yield part.select(["a", "b"]).filter(pa.array(good))


def _hash_filter(hashes: DataFrame):
    """A test, as a column of ``text_hash``, that all of these hashes pass and few others: FILTER_BITS bits, whatever the input."""
    place = F.pmod(F.col("text_hash"), F.lit(FILTER_BITS))
    words = hashes.select((place / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(text_hash, {FILTER_BITS}) % 64 as int))").alias("bit"))
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bit")).collect():  # at most FILTER_BITS / 64 rows
        table[row[0]] = row[1]
    shared = hashes.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            yield batch.filter(pa.array(bits[batch.column("text_hash").to_numpy() % FILTER_BITS].astype(bool)))

    return run


def _unless_apart(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sketches do not rule out, so that few texts need be read."""
    known = lambda k: nodes.select(F.col("node").alias(k), F.col("size").alias(f"size_{k}"), F.col("sketch").alias(f"sketch_{k}"))
    return pairs.join(known("a"), "a").join(known("b"), "b").mapInArrow(tidy(_possible), "a long, b long")


def _verified(pairs: DataFrame, hashed: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the candidate pairs (a, b) of set keys that link."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    places = stored(sets.join(wanted, "node").groupBy("node").agg(F.min("text_hash").alias("text_hash")), "join-places")
    near = hashed.select("text", "text_hash").mapInArrow(tidy(_hash_filter(places)), "text string, text_hash long")
    texts = near.join(places, "text_hash").groupBy("node").agg(F.min("text").alias("text"))
    texts = stored(texts, "join-texts")
    side = lambda k: texts.select(F.col("node").alias(k), F.col("text").alias(f"text_{k}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return stored(joined.mapInArrow(tidy(_linked), "a long, b long"), "join-links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is their component's smallest by ``near_duplicates``, with all their columns.

    Documents linked with nothing stay. Rows without an id stay only where no row of their component has one.
    """
    own, text = fresh(docs, "gone_id", "gone_hash")
    gone = near_duplicates(docs).where("not doc_id <=> component_id").select(F.col("doc_id").alias(own), F.col("text_hash").alias(text)).distinct()
    same = (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(text)) & docs["doc_id"].eqNullSafe(F.col(own))
    return docs.join(gone, same, "left_anti")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, text_hash.

    Words are runs of other characters than white space, A to Z lower-cased; a document's set has its distinct shingles of SHINGLE words, or all
    words as one shingle if there are fewer. Documents link if their sets' Jaccard similarity is at least LOW / HIGH, decided on whole sets of
    64-bit shingle hashes; ``component_id`` is the smallest id that links lead to. Null and empty texts have no shingles and are linked with
    nothing; null ids are passed over as smallest ids; rows with equal sets are one node, so copies and repeated rows cost one set for each
    partition; other columns are ignored.

    Candidates: sets sharing a signature are compared with three leaders among them, the links found are joined into
    components, and then all pairs that share a signature across components are compared. What is left within a component need
    not be compared, so a group of copies costs three comparisons a member. Sketches go first: a pair whose sketches are further
    apart than any linked sets can be is not compared, and no pair is written before that.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    sets = stored(hashed.mapInArrow(tidy(_keyed), "doc_id long, n_shingles long, node long, text_hash long, sketch binary"), "join-sets")
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select("text").mapInArrow(tidy(_signed(common, parts)), "part int, nodes binary, counts binary, signs binary")
    groups = stored(packed.repartition(parts, "part").mapInArrow(tidy(_groups), "grp long, node long, leader long, second long, third long"), "join-groups")

    members = groups.select("node").distinct()
    nodes = stored(sets.join(members, "node").groupBy("node").agg(F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")), "join-nodes")
    stars = groups.select("node", F.explode(F.array("leader", "second", "third")).alias("leader")).where("node <> leader")
    stars = stored(stars.select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")).distinct(), "join-stars")
    links = _verified(stored(_unless_apart(stars, nodes), "join-possible"), hashed, sets)
    roots = components(links)
    placed = groups.join(roots, "node", "left").select("grp", "leader", "node", F.coalesce("root", "node").alias("root"))
    placed = placed.distinct()
    mixed = placed.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
    mixed = stored(mixed.where("low <> high and n > 3").select("grp", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "join-mixed")
    if not mixed.isEmpty():
        rows = placed.join(mixed, "grp").join(nodes, "node").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        rows = rows.select("leader", "grp", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile", "node", "root", "size", "sketch")
        dealt = rows.repartition(parts, "leader", "tile_a", "tile_b").sortWithinPartitions("grp", "tile_a", "tile_b")
        crossing = dealt.mapInArrow(tidy(_crossing), "a long, b long").distinct().join(stars, ["a", "b"], "left_anti")
        more = _verified(stored(crossing, "join-crossing"), hashed, sets)
        roots = components(links.union(more))

    placed = sets.join(roots, "node", "left").select("doc_id", "n_shingles", "text_hash", F.coalesce("root", "node").alias("root"))
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return placed.join(smallest, "root", "left").select("doc_id", "n_shingles", component.alias("component_id"), "text_hash")
