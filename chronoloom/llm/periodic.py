"""Periodic runs of words: maximal stretches that repeat a shorter word sequence several times over.

The runs of a text are found with its dictionary of basic factors. For each power of two ``L`` every stretch of ``L`` words that
occurs more than once in its text has a name; names of length ``2L`` are pairs of names of length ``L``. The next occurrence of the
same factor, if at most ``2L`` words on, gives a distance; occurrences that follow each other at one distance form an
arithmetic progression, which proposes that distance as a period. The proposal is extended both ways by comparing names
from the longest factors down, and proposals of the same run are made one.

A run of smallest period ``q`` and at least ``4q`` words is proposed at the first ``L >= q``: a factor of ``q`` words or more cannot
occur again inside the run before ``q`` words are over, so its positions there all have distance ``q``, and there are more than ``q`` of them.
Only factors that occur again are kept from level to level, so texts without repetition end after a few levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm import arrowtext

LEAST_EXPONENT = 4
"""Runs of fewer repetitions are not found with certainty by progressions of three occurrences."""

RUN = "struct<start:bigint,length:bigint,period:bigint>"


@dataclass
class Runs:
    """Runs over concatenated texts, by start and period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _named(keys: np.ndarray) -> np.ndarray:
    """A name from 1 on for each key that occurs more than once, 0 for the others."""
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts > 1
    return (np.cumsum(again) * again)[place].astype(np.int32)


def basic_factors(ids: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Names of repeated factors, level by level: ``out[k][i]`` names the ``2**k`` words from ``i`` on, 0 if they occur once.

    ``ids`` tells words of different texts apart; ``end`` is where the text of each word ends, and no factor goes beyond it.
    """
    total, levels, size = len(ids), [_named(ids)], 1
    while True:
        names = levels[-1]
        at = np.flatnonzero(names)
        at = at[at + 2 * size <= end[at]]
        at = at[names[at + size] > 0]
        longer = np.zeros(total, dtype=np.int32)
        longer[at] = _named(names[at].astype(np.int64) * (int(names.max(initial=0)) + 1) + names[at + size])
        if not longer.any():
            return levels
        levels.append(longer)
        size *= 2


def _proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches ``low`` to ``high`` of places whose factor comes again ``step`` words on, ``step`` times and more in a row."""
    at = np.flatnonzero(names)
    at = at[np.argsort(names[at], kind="stable")]
    gaps = np.zeros(len(names) + 1, dtype=np.int64)
    near = (names[at[1:]] == names[at[:-1]]) & (at[1:] - at[:-1] <= 2 * size)
    gaps[at[:-1][near]] = (at[1:] - at[:-1])[near]
    bounds = np.flatnonzero(np.diff(gaps, prepend=0, append=0))  # the last gap is 0, as a border
    low, high = bounds[:-1], bounds[1:]
    step = gaps[low]
    keep = (step > 0) & (high - low > step)
    return low[keep], high[keep], step[keep]


def find_runs(ids: np.ndarray, end: np.ndarray, least_length: int, exponent: int) -> Runs:
    """All runs of at least ``max(least_length, exponent * period)`` words over concatenated texts (see ``basic_factors``)."""
    levels = basic_factors(ids, end)
    found = [_proposals(names, 1 << k) for k, names in enumerate(levels)]
    left = np.concatenate([low for low, _, _ in found])
    right = np.concatenate([high + (1 << k) - 1 for k, (_, high, _) in enumerate(found)])  # words before this equal those a period on
    step = np.concatenate([step for _, _, step in found])
    total = len(ids)
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        at = np.maximum(left - size, 0)
        same = (left >= size) & (names[at] > 0) & (names[at] == names[at + step])
        left = left - size * same
        at = np.minimum(right, total - 1)
        ahead = np.minimum(right + step, total - 1)
        same = (right + step < total) & (names[at] > 0) & (names[at] == names[ahead])
        right = right + size * same
    length = right + step - left
    keep = length >= np.maximum(least_length, exponent * step)
    runs = np.unique(np.stack([left[keep], step[keep], length[keep]], axis=1), axis=0)
    return Runs(runs[:, 0], runs[:, 2], runs[:, 1])


def _batch(batch: pa.RecordBatch, least_length: int, exponent: int) -> pa.RecordBatch:
    texts = [(text or "").encode().split() for text in batch.column(1).to_pylist()]  # bytes split at exactly the six white-space bytes
    counts = np.array([len(words) for words in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    total = int(first[-1])
    words = pa.array([word for text in texts for word in text], pa.binary()).dictionary_encode()
    row = np.repeat(np.arange(len(texts)), counts)
    ids = row * (len(words.dictionary) + 1) + words.indices.to_numpy(zero_copy_only=False)
    runs = find_runs(ids, np.repeat(first[1:], counts), least_length, exponent)
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, runs.start + runs.period, 1)
    np.add.at(edge, runs.start + runs.length, -1)
    dropped = np.cumsum(edge[:-1]) > 0
    cut = np.searchsorted(runs.start, first)
    own = row[runs.start] if total else row
    collapsed = []
    for k, text in enumerate(texts):
        if cut[k] < cut[k + 1]:
            gone = dropped[first[k] : first[k + 1]]
            text = [word for word, drop in zip(text, gone, strict=True) if not drop]
        collapsed.append(b" ".join(text))
    parts = [runs.start - first[own], runs.length, runs.period]
    listed = pa.ListArray.from_arrays(
        pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in parts], ["start", "length", "period"])
    )
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(counts), listed, pa.array(collapsed, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"]
    )


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 6, exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """The periodic runs of every whole text and the text with each run cut down to its first period.

    Returns a row per row of ``docs``: the id (its type is kept), ``n_words`` long, ``runs`` (array of start, length and period, in words
    from 0, by start and period), ``collapsed`` string (the words no run drops, joined by one space). Words are what stands between white
    space (bytes 20 and 09 to 0D). A run has its smallest period, at least ``exponent`` repetitions of it (no fewer than 4) and ``least_length`` words.

    One pass without a shuffle; rows are handled a few MB of text at a time, a longer text alone. Null and empty texts have no words, no
    runs and an empty ``collapsed``. Repeated rows and ids, null ids and other columns do not matter: each row stands for itself. An
    empty table gives an empty table.
    """
    if exponent < LEAST_EXPONENT:
        raise ValueError(f"runs of fewer than {LEAST_EXPONENT} periods are not found with certainty")
    schema = docs.schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrowtext.slices(batches, "text"):
            yield _batch(piece, least_length, exponent)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = schema[id_column].dataType.simpleString()
    out = rows.mapInArrow(scan, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
    return out.select(F.col("id").alias(id_column), "n_words", "runs", "collapsed")
