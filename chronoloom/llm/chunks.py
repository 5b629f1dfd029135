"""Repeated passages found by content-defined chunking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm import arrowtext
from chronoloom.llm.mixing import n_words
from chronoloom.llm.stored import stored

MEAN_BITS = 5
"""A byte ends a chunk if this many bits of the gear hash are zero: one byte in 2^5."""
GEAR_WINDOW = 16
"""Bytes that the tested bits of the gear hash depend on."""
LONGEST = 256
"""A chunk without a cut is cut after so many bytes."""
MIN_WORDS = 25
"""Words that a whole text has at least, to be reported where several documents hold it."""
PASSAGE_WORDS = 50
"""Whole words in a row that make a passage in texts that differ: one of over 50 words may have its first or last word joined to another."""

HOT_ROWS = 1000
"""Rows of one value that may meet in a task in any case."""
MOST_HOT = 20_000
"""Values that are broadcast at most, those of more than their share of all rows."""

_GEAR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def gear_cuts(data: np.ndarray) -> np.ndarray:
    """Ends of chunks by content: places at which the rolling gear hash has zeros in its tested bits.

    The gear hash shifts left by one for every byte and adds that byte's number, so its bit k depends on the last k + 1 bytes. The tested
    bits are the highest of the lowest GEAR_WINDOW, which lets all places be hashed at once in GEAR_WINDOW steps.
    """
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    mask = np.uint32(((1 << MEAN_BITS) - 1) << (GEAR_WINDOW - MEAN_BITS))
    gear = _GEAR[data]
    rolled = gear.copy()
    for k in range(1, GEAR_WINDOW):
        if k < len(gear):
            rolled[k:] += gear[:-k] << np.uint32(k)
    return np.flatnonzero((rolled & mask) == 0) + 1


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of the chunks of all texts of a buffer, row ends among them; no chunk is longer than LONGEST."""
    ends = np.unique(np.concatenate([_cuts(data), offsets[1:]])) if len(data) else np.zeros(0, dtype=np.int64)
    ends = ends[ends > 0]
    start = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    extra = (ends - start - 1) // LONGEST
    if extra.any():
        long = np.flatnonzero(extra)
        forced = [start[i] + LONGEST * np.arange(1, extra[i] + 1) for i in long]
        ends = np.unique(np.concatenate([ends, *forced]))
    return ends


def _cuts(data: np.ndarray) -> np.ndarray:
    """Cuts by content in a buffer of texts; those in the first GEAR_WINDOW bytes of a text depend on the text before it."""
    found = [np.zeros(0, dtype=np.int64)]
    for low, high in _pieces(len(data)):
        at = max(low - GEAR_WINDOW, 0)
        cuts = at + gear_cuts(data[at:high])
        found.append(cuts[cuts > low])
    return np.concatenate(found)


def _pieces(size: int) -> list[tuple[int, int]]:
    return [(low, min(low + arrowtext.PIECE_BYTES, size)) for low in range(0, size, arrowtext.PIECE_BYTES)]


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit digests of spans of the buffer; starts and ends both ascend."""
    out = []
    at = 0
    while at < len(end):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + arrowtext.PIECE_BYTES, "right")))
        low, high = start[at], end[stop - 1]
        up, down = arrowtext.POWERS.get(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(arrowtext.BYTE_KEYS[data[low:high]] * up[: high - low], out=sums[1:])
        begin, finish = start[at:stop] - low, end[at:stop] - low
        out.append(arrowtext.mix((sums[finish] - sums[begin]) * down[begin] + (finish - begin).astype(np.uint64)))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts of a buffer."""
    inside = arrowtext.NOT_SPACE[data] != 0
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def _longest(rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The greatest of ``rank[low:high]`` for each pair; 0 where that is empty."""
    out = np.zeros(len(low), dtype=np.uint64)
    size = high - low
    step = 1
    while len(rank):
        at = np.flatnonzero((size >= step) & (size < 2 * step))
        out[at] = np.maximum(rank[low[at]], rank[high[at] - step])
        if not (size >= 2 * step).any():
            break
        rank = np.maximum(rank[:-step], rank[step:])  # now over twice as many from each place
        step *= 2
    return out


def windows(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """All runs of ``words`` words: row, number of the first word, start and end (bytes in the row), digest and anchor.

    The anchor is the longest chunk that lies in the run, by its length and digest; a run without a whole chunk is its own anchor. It depends on the
    bytes of the run only, so equal runs have equal anchors, and runs that begin one after another mostly have the same.
    """
    first, last = word_spans(data, offsets)
    row = np.searchsorted(offsets, first, "right") - 1
    at = np.flatnonzero(row[: max(len(row) - words + 1, 0)] == row[words - 1 :])
    start, end = first[at], last[at + words - 1]
    cuts = _cuts(data)
    length = np.minimum(np.diff(cuts), (1 << 16) - 1).astype(np.uint64)
    rank = (length << np.uint64(48)) | (digests(data, cuts[:-1], cuts[1:]) >> np.uint64(16))
    low = np.searchsorted(cuts, start + GEAR_WINDOW)  # a cut depends on the bytes before it, which must be the run's own
    high = np.maximum(np.searchsorted(cuts, end, "right") - 1, low)
    digest = digests(data, start, end)
    anchor = arrowtext.mix(_longest(rank, low, high))
    anchor = np.where(high > low, anchor, digest)
    row = row[at]
    number = at - np.searchsorted(first, offsets)[row]
    return row, number, start - offsets[row], end - offsets[row], digest.view(np.int64), anchor.view(np.int64)


def _anchors(words: int):
    """The anchors of each distinct text of a partition, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in arrowtext.slices(batches, "text"):
            keys = batch.column("text_key").to_numpy()
            fresh = np.zeros(batch.num_rows, dtype=bool)
            for k, key in enumerate(keys.tolist()):
                if key not in seen:
                    seen.add(key)
                    fresh[k] = True
            row, *_, anchor = windows(*arrowtext.text_bytes(batch.filter(pa.array(fresh)).column("text")), words)
            if len(row):
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))
                row, anchor = np.unique(np.stack((row[new], anchor[new])), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(keys[fresh][row]), pa.array(anchor)], names=["text_key", "anchor"])

    return run


def _windows(words: int):
    """The runs of words whose anchors several texts hold; ``anchors`` has these for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            known = np.unique(batch.column("anchors").flatten().to_numpy())  # an anchor that is another text's too is in both lists
            row, number, start, end, digest, anchor = windows(*arrowtext.text_bytes(batch.column("text")), words)
            at = np.flatnonzero(_among(anchor, known))
            key = batch.column("text_key").to_numpy()[row[at]]
            for k in range(0, len(at), 100_000):
                part = at[k : k + 100_000]
                arrays = [pa.array(x) for x in (digest[part], key[k : k + 100_000], number[part], start[part], end[part])]
                yield pa.RecordBatch.from_arrays(arrays, names=["digest", "text_key", "number", "start", "end"])

    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Those of ``rows`` whose value of ``name`` several texts hold, with the smallest key of these as ``keep_key``.

    Rows are combined before they are shuffled to be counted. Values of very many rows then take their key by a broadcast, so that these rows don't meet in one task.
    """
    counts = rows.groupBy(name).agg(F.min("text_key").alias("keep_key"), F.max("text_key").alias("last"), F.count(F.lit(1)).alias("n"))
    held = stored(counts.where("keep_key < last").drop("last"), f"chunk-{name}")
    total = held.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT_ROWS, total // MOST_HOT)
    often = F.broadcast(held.where(hot).drop("n"))
    return rows.join(often, name).union(rows.join(often, name, "left_anti").join(held.where(~hot).drop("n"), name))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """Passages that several documents of ``docs(doc_id, text)`` hold: one row for each document and passage.

    Columns: doc_id, start and end (bytes of the text in UTF-8), n_words, keep_doc_id, kept. Of all texts that hold the same ``passage_words`` words in a row,
    with the same bytes between them, the one with the smallest text key, a hash, keeps them. A passage is a run of words, as long as can be, whose every
    ``passage_words`` words are kept by the same text: ``keep_doc_id`` has all of them, and ``kept`` says that it is this document. So no passage loses its last
    copy, and whether two documents share one doesn't depend on others. Passages of different keepers that follow one another overlap.

    A text of ``min_words`` words or more that several documents have in full has one more row for each of them, over the whole text; the smallest id keeps it,
    and has the rows of the text's passages. Texts are compared by runs with equal anchors (``windows``), which finds all equal runs.

    Documents without repeated passages have no row. Null and empty texts have none. Texts and runs of words are told apart by 64-bit hashes. Null ids
    are passed over as smallest ids; repeated rows are equal texts; long texts are cut whole; other columns are ignored.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).where("text <> ''")
    texts = stored(keyed.groupBy("text_key").agg(F.min("doc_id").alias("text_doc"), F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("size")), "chunk-texts")
    long = keyed.select("text_key", "text").where(F.octet_length("text") >= 2 * passage_words - 1)
    anchors = stored(long.mapInArrow(_anchors(passage_words), "text_key long, anchor long"), "chunk-anchors")
    wanted = _shared(anchors, "anchor").groupBy("text_key").agg(F.collect_set("anchor").alias("anchors"))
    rows = "digest long, text_key long, number long, start long, end long"
    found = long.dropDuplicates(["text_key"]).join(wanted, "text_key").mapInArrow(_windows(passage_words), rows)
    shared = _shared(stored(found, "chunk-windows"), "digest")

    by_text = Window.partitionBy("text_key").orderBy("number")
    follows = (F.col("number") == F.lag("number").over(by_text) + 1) & (F.col("keep_key") == F.lag("keep_key").over(by_text))
    runs = shared.withColumn("begins", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("begins").over(by_text))
    runs = runs.groupBy("text_key", "run", "keep_key").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.count(F.lit(1)) + passage_words - 1).alias("n_words"))
    runs = stored(runs.drop("run"), "chunk-runs")

    own = runs.join(texts.select("text_key", F.col("text_doc").alias("doc_id")), "text_key")
    keepers = texts.select(F.col("text_key").alias("keep_key"), F.col("text_doc").alias("keep_doc_id"))
    parts_of = own.join(keepers, "keep_key").select("doc_id", "start", "end", "n_words", "keep_doc_id", (F.col("text_key") == F.col("keep_key")).alias("kept"))
    copies = keyed.select("doc_id", "text_key", n_words(F.col("text")).alias("n_words")).where(F.col("n_words") >= min_words)
    copied = copies.join(texts.where("n > 1"), "text_key").select(
        "doc_id", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"), "n_words", F.col("text_doc").alias("keep_doc_id"), F.expr("doc_id <=> text_doc").alias("kept")
    )
    return parts_of.union(copied)
