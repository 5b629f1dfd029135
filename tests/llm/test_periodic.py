"""Periodic runs of words against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from chronoloom.llm import periodic
from chronoloom.llm.queries import QUERIES, with_loops

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    """All runs: for each period the stretches where words equal those a period on, if no shorter period fits them."""
    found = []
    _, ids = np.unique(np.array(words, dtype=object), return_inverse=True) if words else (None, np.zeros(0, int))
    n = len(ids)
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[0], (ids[:-q] == ids[q:]).astype(int), [0]])
        edges = np.flatnonzero(np.diff(same))
        for low, high in zip(edges[::2], edges[1::2], strict=True):
            length = int(high - low) + q
            if length >= max(least, exponent * q):
                own = ids[low : low + length]
                if not any((own[:-p] == own[p:]).all() for p in range(1, q)):
                    found.append((int(low), length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def looped(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(WORD.findall(text or ""))
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = looped(doc_id, text)
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    shape = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shape, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_random_words_by_brute_force():
    draw = random.Random(7)
    for _ in range(400):
        rows = []
        for _ in range(draw.randint(1, 4)):
            row = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(0, 70))]
            if len(row) > 8:
                low = draw.randrange(len(row) - 4)
                period = draw.randint(1, max(1, (len(row) - low) // 4))
                for i in range(low + period, min(len(row), low + period * draw.randint(3, 8) + 1)):
                    row[i] = row[i - period]
            rows.append(row)
        first = np.cumsum([0] + [len(r) for r in rows])
        ids = np.array([100 * k + w for k, r in enumerate(rows) for w in r], dtype=np.int64)
        got = periodic.find_runs(ids, np.repeat(first[1:], [len(r) for r in rows]), 6, 4)
        want = [(s + int(first[k]), length, q) for k, r in enumerate(rows) for s, length, q in brute(r)]
        assert list(zip(got.start.tolist(), got.length.tolist(), got.period.tolist(), strict=True)) == want


def test_query_by_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = QUERIES["op11_periodic_runs"](spark, sf_dir).select(columns).collect()
    assert sorted(map(tuple, rows)) == sorted(expected(r.doc_id, r.text) for r in texts)
    assert sum(r.n_runs > 0 for r in rows) > 5


def test_loops_are_made_from_own_words(spark):
    texts = [(i, " ".join(f"w{i}_{k}" for k in range(i % 40)) + "\n" * (i % 3)) for i in range(400)] + [(None, "a b"), (7, None)]
    rows = with_loops(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    wanted = {(i, tuple(looped(i, t) if i is not None else t.split())) for i, t in texts}
    assert {(r.doc_id, tuple((r.text or "").split())) for r in rows} == wanted


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "a " * 6, "b", "a b " * 4 + "c", "é\u00a0x " * 50_000, "a b " * 4 + "c", "x y x y x y x"]
    rows = [(None if i < 2 else i // 2, t, "r", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, runs string, n_words int")
    found = periodic.periodic_runs(docs).collect()
    assert len(found) == len(texts)
    shown = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found)
    wanted = [
        ("None", 0, [], ""),
        ("None", 0, [], ""),
        ("1", 0, [], ""),
        ("1", 6, [(0, 6, 1)], "a"),
        ("2", 1, [], "b"),
        ("2", 9, [(0, 8, 2)], "a b c"),
        ("3", 50_000, [(0, 50_000, 1)], "é\u00a0x"),
        ("3", 9, [(0, 8, 2)], "a b c"),
        ("4", 7, [], "x y x y x y x"),
    ]
    assert shown == sorted(wanted)
    assert found[0].asDict().keys() == {"doc_id", "n_words", "runs", "collapsed"}
    assert periodic.periodic_runs(docs.limit(0)).collect() == []
    names = spark.createDataFrame([("one", "z " * 8)], "doc_id string, text string")
    assert [tuple(r.runs[0]) for r in periodic.periodic_runs(names).collect()] == [(0, 8, 1)]
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=3)
