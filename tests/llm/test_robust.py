"""Ties, tiny batches and clashing column names in the operators that the pipeline uses."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regexes import texts

from chronoloom.llm import bpe, embedding_join, exact_dedup, licenses, mixing, quality, shingle_join, urls
from chronoloom.llm.stored import fresh


@pytest.mark.parametrize("words", range(9))
def test_pooling_few_words(words):
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, 2 * quality.DIMS)).astype(np.float32)
    batch = pa.record_batch([pa.array([" ".join("abcdefgh"[:words]), None, ""])], names=["text"])
    out = quality.pooled(batch, "text", vectors)
    assert out.shape[0] == 3 and np.isfinite(out).all() and not out[1:].any()


def test_classifying_a_partition_of_four_words(spark):
    docs = spark.createDataFrame([(i, "one two three four" if i % 2 else "five six") for i in range(12)], "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 12


def test_alike_rows_share_their_copies(spark):
    """Rows without ids and of one size are told apart by their places, so sources meet their targets."""
    rows = [(None, "w w w", "a")] * 100 + [(None, "w w w", "b")] * 33 + [(1, "v v", "c")] * 7 + [(i, "x " * (i % 9), "d") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(rows)
    for source in "abcd":
        own = [r for r in found if r.source == source]
        largest = max(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * largest
        assert all(r.taken <= 3 * r.size for r in own)
    again = mixing.mix_sources(docs).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    mixed = Counter((r.doc_id, r.source) for r in mixing.mixed_documents(docs).collect())
    assert mixed == Counter({k: n for k, n in sum((Counter({(r.doc_id, r.source): r.copies}) for r in found), Counter()).items() if n})


def test_clashing_columns(spark):
    """Names that the stages would use themselves are columns like any other."""
    odd = ["dedup_at", "gone_id", "gone_hash", "mix_size", "mix_copies", "mix_source", "mix_place", "mix_m", "mix_part", "mix_n", "mix_before", "quality_score", "score", "__score", "__at", "at", "node", "rate", "m"]
    assert fresh(spark.createDataFrame([(1,)], "A int"), "a", "b", "b") == ["a_", "b", "b_"]
    texts = ["alpha beta gamma delta epsilon zeta", "alpha  beta gamma delta epsilon zeta", "one two", None, "", "one two"]
    rows = [(i, t, "s", *[f"{c}{i}" for c in odd]) for i, t in enumerate(texts)] + [(None, "one two", "s", *["z"] * len(odd))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in odd))
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    for stage in (exact_dedup.distinct_documents, shingle_join.one_of_each, mixing.mixed_documents, lambda d: quality.accepted(d, labels)):
        out = stage(docs)
        assert out.columns == docs.columns
        wanted = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in out.collect()} <= wanted
    assert exact_dedup.distinct_documents(docs).count() == 3
    scored = quality.fit_quality(docs, labels).score(docs, "mark")
    assert scored.columns == [*docs.columns, "mark"]


def test_many_copies_of_one_text(spark):
    """A digest that most rows share is joined by a broadcast and compared in several shares."""
    rows = [(i, "same  text" if i % 3 else "same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = exact_dedup.exact_duplicates(docs).collect()
    assert len(found) == 3500
    assert {r.keep_id for r in found if r.doc_id < 3000} == {0} and {r.group_size for r in found if r.doc_id < 3000} == {3000}
    assert all(r.kept and r.group_size == 1 for r in found if r.doc_id >= 5000)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 5000)
    known = bpe._Encoded(lambda word: (word.encode(), word))
    for i in range(1000):
        assert known[f"w{i}" * 20] == (f"w{i}".encode() * 20, f"w{i}" * 20)
        assert len(known) + len(known.older) < 40


def test_every_rule_finds_what_its_pattern_says():
    """The gate words of a rule stand in all that its pattern matches."""
    for rule in licenses.signature_rules():
        for text in texts(rule.pattern):
            if re.search(rf"(?<![^ ]){rule.pattern}(?![^ ])", text):
                assert set(rule.gate) <= set(text.split(" ")), (rule, text)


def plain_finds(detector, words):
    """Suppression by comparing each find with all that are kept."""
    text, kept = " ".join(words), []
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    for rank, rule, pattern in detector.rules:
        if not set(words).issuperset(rule.gate):
            continue
        for hit in pattern.finditer(text):
            new = licenses.Find(rule.label, int(np.searchsorted(starts, hit.start())), int(np.searchsorted(starts, hit.end())), rank, rule.score)
            if not any(k.start <= new.start and new.end <= k.end for k in kept):
                kept = [k for k in kept if not (new.start <= k.start and k.end <= new.end and new.label.startswith(k.label + "-"))] + [new]
    return sorted(kept, key=lambda f: (f.start, f.end, f.rank))


def test_suppression_by_brute_force():
    detector, draw = licenses.Detector(licenses.signature_rules()), random.Random(3)
    pieces = [t for rule in detector.rules for t in texts(rule[1].pattern, 6)[:2]] + ["and", "the", "under", "license", "gnu"]
    for _ in range(60):
        words = " ".join(draw.choice(pieces) for _ in range(draw.randint(1, 25))).split()
        assert detector.finds(words, set(words)) == plain_finds(detector, words)


def test_many_finds_take_little_longer():
    detector = licenses.Detector(licenses.signature_rules())
    times = []
    for n in (2000, 16_000):
        words = ["mit", "license"] * n
        began = time.perf_counter()
        assert len(detector.finds(words, set(words))) == n
        times.append(time.perf_counter() - began)
    assert times[1] < 30 * times[0] + 0.5


def test_labels_with_fractions_and_large_components(spark):
    near = [1.0, 2.0, 3.0, 4.0]
    rows = [(0, 1.2, near), (1, 1.7, near), (2, 1.2, [x * 1e100 for x in near]), (3, 1.2, [x * 1e-200 for x in near]), (4, None, near), (5, 0.0, near), (6, -0.0, near), (7, 1.2, [4.0, -3.0, 2.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, label double, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_duplicates(table).collect()}
    assert found == {0: (2, 0), 1: (0, 1), 2: (2, 0), 3: (2, 0), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7)}


def test_aliases_through_relative_links_and_bases(spark):
    page = lambda head: f"<html><head>{head}</head><body></body></html>"
    canonical = lambda to: page(f'<link rel="canonical" href="{to}">')
    rows = [
        (1, "http://good.com/a/b/x.html", canonical("../../blocked/x.html")),
        (2, "http://good.com/blocked/x.html", ""),
        (3, "http://other.com/p", page('<base href="http://bad.net/q/"><link rel="canonical" href="r">')),
        (4, "http://bad.net/q/r", ""),
        (5, "http://third.com/d/p", page('<base href="../e/"><link rel="canonical" href="./f">')),
        (6, "http://third.com/e/f", ""),
        (7, "http://four.com/x", page('<!-- <body> --><link rel="canonical" href="http://bad.net/z">')),
        (8, "http://five.com/x", page('<!-- <link rel="canonical" href="http://bad.net/z"> -->')),
        (9, "http://six.com/a", canonical("/../../k/./m/")),
        (10, "http://six.com/k/m/", ""),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = [urls.Rule("block", "net"), urls.Rule("block", "good.com", "/blocked/"), urls.Rule("block", "third.com", "/e/"), urls.Rule("block", "six.com", "/k/")]
    found = {r.page_id: r.verdict for r in urls.judge_urls(table, rules).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "block", 8: "allow", 9: "block", 10: "block"}


def test_dots_in_paths(spark):
    paths = {"/a/../b": "/b", "/a/./b/": "/a/b/", "/a/b/..": "/a/", "/..": "/", "/.": "/", "/a/...": "/a/...", "/a.b/.c": "/a.b/.c", "/../../x": "/x", "": "", "/a//../b": "/a/b"}
    rows = spark.createDataFrame(list(paths.items()), "path string, want string").select("path", "want", urls.without_dots(F.col("path")).alias("got")).collect()
    assert {r.path: r.got for r in rows} == paths
