"""Ranked lexical search over an index whose posting lists are blocked geometrically.

The documents of a scan are gathered into shards. A shard has, for every term that some query asks for, the posting list of the term,
and each longer list is cut into blocks of documents that resemble each other: documents are assigned to the most
similar of some members of the list, by the cosine of short sketches of their vectors. Of each block the index stores
the coordinatewise maximum of its documents' vectors, over the terms that queries use along with the list's own term. The weighted sum of
these maxima bounds every score in the block. A search takes a query's lists by falling share of the score and skips a block
where this bound stays below the score of the worst document to report so far; the lists that are left are skipped together once the sum of
their maxima does. All numbers are integers and bounds are never rounded down, so what is skipped cannot belong to the result.

An index is a table of shards, one row each, and any split of it into tasks gives the same result. A shard travels as one packed value: its arrays of
some million numbers would be held by Spark's reader and in Arrow batches for all shards of a task at once. Terms are told apart by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.llm import arrowtext
from chronoloom.llm.stored import stored
from chronoloom.llm.tasks import tidy

QUERY_BYTES = 1 << 18
"""Text of queries that is searched for at once; more queries are searched for in further blocks."""

TEXT_BYTES = 1 << 19
"""Text whose words are found at once; bounds a task's memory with some 50 bytes for each."""

SHARD_CELLS = 1 << 22
"""Documents of a shard times terms of the queries, at most; bounds a task's memory."""

SHARD_DOCS = 1024
BLOCK_DOCS = 32
"""Documents of a block on average; lists of less than twice as many are one block, and those below ``BARE_DOCS`` are compared without a summary."""

BARE_DOCS = 8
SKETCH = 32
PAIRS = 1 << 22
"""Pairs of terms used together for which summaries are cut to what is asked for; beyond, they hold all terms."""

STORAGE = {"compression": "uncompressed", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
"""How an index is written: packed shards are not packed again, and row groups are cut by size after any row, not after a hundred."""

INDEX = T.StructType(
    [T.StructField("ids", T.ArrayType(T.LongType()))]
    + [T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("doc_first", "doc_terms", "doc_units", "list_terms", "list_most", "list_first", "postings", "block_first", "block_lists", "summaries")]
)


def pack(row: pa.RecordBatch) -> bytes:
    """The arrays of a shard (see ``INDEX``) as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpack(value: pa.Buffer) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(value, options=pa.ipc.IpcReadOptions(use_threads=False)).read_next_batch()
    return {name: row.column(name)[0].values for name in INDEX.fieldNames()}


@dataclass
class Queries:
    """A block of queries over a vocabulary of term hashes; a query is its terms' places in the vocabulary and their repeats."""

    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    beside: list[np.ndarray] | None = field(default=None)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary's place of each hash, -1 where it has none."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def used_beside(self) -> None:
        """Fill ``beside``: for each term the terms of all queries that have it, itself included."""
        if sum(len(t) ** 2 for t in self.terms) > PAIRS:
            return
        size = len(self.vocabulary)
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *[(t[:, None] * size + t[None, :]).ravel() for t in self.terms]]))
        self.beside = np.split(pairs % max(size, 1), np.searchsorted(pairs // max(size, 1), np.arange(1, size)))

    def columns(self, term: int) -> np.ndarray | slice:
        """The coordinates of the summaries of a term's list."""
        return slice(None) if self.beside is None else self.beside[term]

    def width(self, term: int) -> int:
        return len(self.vocabulary) if self.beside is None else len(self.beside[term])


def read_queries(ids: list, texts: list[str | None]) -> Queries:
    data, offsets = arrowtext.text_bytes(pa.array(texts, pa.string()))
    found = arrowtext.words(data, offsets, arrowtext.ALNUM, arrowtext.LOWER)
    vocabulary, place = np.unique(found.hash, return_inverse=True)
    own = [np.unique(place[low:high], return_counts=True) for low, high in zip(found.first[:-1], found.first[1:], strict=True)]
    out = Queries(ids, vocabulary, [t.astype(np.int64) for t, _ in own], [n.astype(np.int64) for _, n in own])
    out.used_beside()
    return out


@dataclass
class Vectors:
    """Occurrences of query terms in a batch of texts, by row and term, and all terms of each row."""

    row: np.ndarray
    term: np.ndarray
    count: np.ndarray
    size: np.ndarray


def _vectors(column: pa.Array, queries: Queries) -> Vectors:
    data, offsets = arrowtext.text_bytes(column)
    found = arrowtext.words(data, offsets, arrowtext.ALNUM, arrowtext.LOWER)
    size = np.diff(found.first)
    place = queries.places(found.hash)
    keys = (np.repeat(np.arange(len(size)), size) * max(len(queries.vocabulary), 1) + place)[place >= 0]
    keys, count = np.unique(keys, return_counts=True)
    return Vectors(keys // max(len(queries.vocabulary), 1), keys % max(len(queries.vocabulary), 1), count, size)


@dataclass
class Statistics:
    """Documents with a term, all terms, and the weight of each term of the vocabulary."""

    documents: int
    terms: int
    weights: np.ndarray


def corpus_statistics(docs: DataFrame, queries: Queries) -> Statistics:
    """Counts over all rows of ``docs`` (``id``, ``text``): summed in each task first, a number for each query term and task at most."""
    size = len(queries.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 2, dtype=np.int64)
        for piece in arrowtext.slices(batches, "text", TEXT_BYTES):
            found = _vectors(piece.column("text"), queries)
            sums[:size] += np.bincount(found.term, minlength=size)
            sums[size] += np.count_nonzero(found.size)
            sums[size + 1] += found.size.sum()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["place", "n"])

    rows = docs.select("text").mapInArrow(tidy(count), "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    sums = {row.place: row.n for row in rows}
    total = sums.get(size, 0)
    weights = [math.floor(1000 * math.log((2 * total + 2) / (2 * sums.get(t, 0) + 1))) for t in range(size)]
    return Statistics(total, sums.get(size + 1, 0), np.array(weights, dtype=np.int64))


class _Shard:
    """Documents gathered for a shard, and its index row."""

    def __init__(self, queries: Queries, statistics: Statistics) -> None:
        self.queries, self.statistics = queries, statistics
        size = max(len(queries.vocabulary), 1)
        self.room = max(1, min(SHARD_DOCS, SHARD_CELLS // size))
        signs = np.random.Generator(np.random.PCG64(11)).integers(0, 2, (size, SKETCH))
        self.signs = (2 * signs - 1).astype(np.float32)
        self.clear()

    def clear(self) -> None:
        self.ids, self.rows, self.terms, self.units, self.held = [], [], [], [], 0

    def add(self, ids: pa.Array, found: Vectors, low: int, high: int) -> None:
        """Rows ``low`` to ``high`` of a batch. Units are occurrences damped by the length of the text, in millionths."""
        all_docs, all_terms = self.statistics.documents, max(self.statistics.terms, 1)
        at = slice(*np.searchsorted(found.row, [low, high]))
        size = found.size[found.row[at]]
        damped = 100 - 25 + (25 * size * all_docs) // all_terms
        self.ids.append(pc.take(ids, pa.array(np.arange(low, high))))  # a slice would hold the whole batch with its texts
        self.rows.append(found.row[at] - low + self.held)
        self.terms.append(found.term[at])
        self.units.append((1_000_000_000 * found.count[at]) // (1000 * found.count[at] + 12 * damped))
        self.held += high - low

    def _dense(self, row: np.ndarray, term: np.ndarray, unit: np.ndarray) -> np.ndarray:
        out = np.zeros((self.held, len(self.queries.vocabulary)), dtype=np.int32)
        out[row, term] = unit
        return out

    def _blocks(self, members: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The members of a list by block, and where blocks begin."""
        wanted = len(members) // BLOCK_DOCS
        if wanted < 2:
            return members, np.zeros(1, dtype=np.int64)
        centres = members[np.linspace(0, len(members) - 1, wanted).astype(np.int64)]
        nearest = np.argmax(sketches[members] @ sketches[centres].T, axis=1)
        order = np.argsort(nearest, kind="stable")
        return members[order], np.flatnonzero(np.diff(nearest[order], prepend=-1))

    def row(self) -> pa.RecordBatch:
        row, term, unit = (np.concatenate(x) for x in (self.rows, self.terms, self.units))
        dense = self._dense(row, term, unit)
        sketches = np.multiply(dense, self.statistics.weights, dtype=np.float32) @ self.signs
        sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)
        order = np.argsort(term, kind="stable")
        postings = row[order]
        list_terms, list_first = np.unique(term[order], return_index=True)
        list_first = np.append(list_first, len(postings))
        most = np.maximum.reduceat(unit[order], list_first[:-1]) if len(list_terms) else list_first[:0]
        block_first, block_lists, summaries = [], [], []
        for k in np.flatnonzero(np.diff(list_first) >= BARE_DOCS):
            low, high = list_first[k], list_first[k + 1]
            postings[low:high], starts = self._blocks(postings[low:high], sketches)
            columns = self.queries.columns(int(list_terms[k]))
            own = dense[postings[low:high]][:, columns]
            summaries.append(np.maximum.reduceat(own, starts, axis=0).ravel())
            block_first.append(low + starts)
            block_lists.append(np.full(len(starts), k))
        none = np.zeros(0, dtype=np.int64)
        parts = [
            np.searchsorted(row, np.arange(self.held + 1)),
            term,
            unit,
            list_terms,
            most,
            list_first,
            postings,
            np.concatenate([none, *block_first]),
            np.concatenate([none, *block_lists]),
            np.concatenate([none.astype(np.int32), *summaries]),
        ]
        columns = [pa.concat_arrays(self.ids), *[pa.array(x.astype(np.int32, copy=False)) for x in parts]]
        listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns]
        self.clear()
        return pa.RecordBatch.from_arrays(listed, INDEX.fieldNames())


def build_index(docs: DataFrame, queries: Queries, statistics: Statistics) -> DataFrame:
    """The index of all rows of ``docs`` (``id`` long, ``text``) for a block of queries, a row a shard: the value that ``pack`` makes of its arrays (see ``INDEX``).

    ``doc_first``, ``doc_terms`` and ``doc_units`` are the documents' vectors, row by row; ``list_first`` cuts ``postings`` into lists and ``block_first``
    into blocks; ``summaries`` holds the blocks' maxima one after the other, each as wide as ``Queries.width`` of its list's term.
    """

    def packed(shard: _Shard) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pack(shard.row())], pa.binary())], ["shard"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(queries, statistics)
        for piece in arrowtext.slices(batches, "text", TEXT_BYTES):
            found, low = _vectors(piece.column("text"), queries), 0
            while low < piece.num_rows:
                high = min(piece.num_rows, low + shard.room - shard.held)
                shard.add(piece.column("id"), found, low, high)
                low = high
                if shard.held >= shard.room:
                    yield packed(shard)
        if shard.held:
            yield packed(shard)

    return docs.select("id", "text").mapInArrow(tidy(gather), "shard binary")


class _Best:
    """The best documents of a query so far: by falling score, then by id, rows without an id last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.id, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this cannot be among the best any more."""
        return int(self.score[-1]) if len(self.score) >= self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        keep = score >= self.least
        if keep.any():
            score, ids, none = (np.concatenate([old, new[keep]]) for old, new in ((self.score, score), (self.id, ids), (self.none, none)))
            best = np.lexsort((ids, none, -score))[: self.k]
            self.score, self.id, self.none = score[best], ids[best], none[best]


class _Searcher:
    """Searches shards one after the other, with what the earlier ones found as a bar for the later ones."""

    def __init__(self, queries: Queries, weights: np.ndarray, k: int) -> None:
        self.queries = queries
        self.best = [_Best(k) for _ in queries.ids]
        self.weights = [weights[terms] * repeats for terms, repeats in zip(queries.terms, queries.repeats, strict=True)]
        self.seen_columns: dict[tuple[int, int], np.ndarray] = {}

    def _columns(self, query: int, term: int) -> np.ndarray:
        """Where the summaries of a list hold the query's terms."""
        terms = self.queries.terms[query]
        if self.queries.beside is None:
            return terms
        if (query, term) not in self.seen_columns:
            self.seen_columns[query, term] = np.searchsorted(self.queries.beside[term], terms)
        return self.seen_columns[query, term]

    def shard(self, parts: dict[str, pa.Array]) -> None:
        ids, none = parts["ids"].fill_null(0).to_numpy(), parts["ids"].is_null().to_numpy(zero_copy_only=False)
        doc_first, doc_terms, doc_units, list_terms, most, list_first, postings, block_first, block_lists, summaries = (parts[n].to_numpy() for n in INDEX.fieldNames()[1:])
        size = len(self.queries.vocabulary)
        dense = np.zeros((len(ids), size), dtype=np.int32)
        dense[np.repeat(np.arange(len(ids)), np.diff(doc_first)), doc_terms] = doc_units
        list_of = np.full(size, -1)
        list_of[list_terms] = np.arange(len(list_terms))
        blocks = np.searchsorted(block_lists, np.arange(len(list_terms) + 1))
        widths = np.array([self.queries.width(int(t)) for t in list_terms], dtype=np.int64)
        summary_first = np.concatenate([[0], np.cumsum(np.diff(blocks) * widths)])
        block_end = np.append(block_first[1:], 0)
        last = blocks[1:][np.diff(blocks) > 0] - 1
        block_end[last] = list_first[block_lists[last] + 1]
        for query, terms in enumerate(self.queries.terms):
            lists = list_of[terms]
            here = np.flatnonzero(lists >= 0)
            share = self.weights[query][here] * most[lists[here]]
            order = np.argsort(-share, kind="stable")
            rest = np.cumsum(share[order][::-1])[::-1]
            best, seen = self.best[query], np.zeros(len(ids), dtype=bool)
            for k, left in zip(here[order], rest, strict=True):
                if left < best.least:
                    break  # documents in none of the lists before this one have no more than these maxima
                at = lists[k]
                if blocks[at] == blocks[at + 1]:
                    docs = postings[list_first[at] : list_first[at + 1]]
                else:
                    own = slice(blocks[at], blocks[at + 1])
                    maxima = summaries[summary_first[at] : summary_first[at + 1]].reshape(-1, widths[at])
                    bounds = maxima[:, self._columns(query, int(terms[k]))] @ self.weights[query]
                    kept = bounds >= best.least
                    docs = np.concatenate([postings[:0], *[postings[a:b] for a, b in zip(block_first[own][kept], block_end[own][kept], strict=True)]])
                docs = docs[~seen[docs]]
                if len(docs):
                    seen[docs] = True
                    score = dense[np.ix_(docs, terms)] @ self.weights[query]
                    best.add(score, ids[docs], none[docs])


def search_index(index: DataFrame, queries: Queries, statistics: Statistics, k: int) -> DataFrame:
    """The ``k`` best documents of every query: rows (query, score, id, rank). A task keeps ``k`` rows a query, and ranks are made in two steps."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _Searcher(queries, statistics.weights, k)
        for batch in batches:
            for value in batch.column("shard"):
                searcher.shard(unpack(value.as_buffer()))
        for query, best in enumerate(searcher.best):
            if len(best.score):
                ids = pa.array(best.id, mask=best.none)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query)), pa.array(best.score), ids], ["query", "score", "id"])

    found = index.mapInArrow(tidy(search), "query bigint, score bigint, id bigint")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    found = found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return found.select("query", "score", "id", "rank")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The ``k`` best documents for the text of each item, over all rows and whole texts.

    Returns the item's id, ``rank`` int from 1, the document's id as long and ``score`` long. Terms are runs of letters and digits (any character
    beyond ASCII is one), A-Z lower-cased. A term's weight falls with the documents that have it, its occurrences are damped by
    the document's length (see ``corpus_statistics`` and ``_Shard.add``); all but the logarithm is in integers. Equal scores rank by id, rows without an id last.

    Items go through in blocks of ``QUERY_BYTES``, each with its own index of all documents; an index is written to the shared folder. Items equal in id and text are
    one; items of one id and several texts are searched for one by one. Null and empty items and documents have no terms:
    an item without terms, or whose terms no document has, gets no rows, as do empty tables. Repeated documents are ranked each. Other
    columns do not matter. Document ids must be whole numbers.
    """
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        raise ValueError(f"{id_column} must be a whole number, as it decides ties")
    docs = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    items = items.select(F.col(item_column).alias("id"), F.col(item_text).cast("string").alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / QUERY_BYTES))
    spark, kind = docs.sparkSession, items.schema["id"].dataType
    schema = T.StructType([T.StructField(item_column, kind), T.StructField("rank", T.IntegerType()), T.StructField(id_column, T.LongType()), T.StructField("score", T.LongType())])
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()  # at most some QUERY_BYTES of text
        own = sorted((row for row in own if row.text), key=lambda row: (row.text, str(row.id)))
        if not own:
            continue
        queries = read_queries([row.id for row in own], [row.text for row in own])
        if not len(queries.vocabulary):
            continue
        statistics = corpus_statistics(docs, queries)
        index = stored(build_index(docs, queries, statistics), "lexical-index", **STORAGE)
        names = spark.createDataFrame([(at, row.id) for at, row in enumerate(own)], T.StructType([T.StructField("query", T.LongType()), T.StructField("item", kind)]))
        found = search_index(index, queries, statistics, k).join(names, "query")
        found = found.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], schema) if out is None else out
