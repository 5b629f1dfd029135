"""Operators that read each text by itself: quality, licences, tokens; and the words they share."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chronoloom.llm import arrowtext, bpe, licenses, quality
from chronoloom.llm.queries import ORACLES, QUERIES

ODD = [None, "", " \t\n", "Ab", "MIT License", "x" * 300_000, "é ü–Ab 漢字 12", "a  b\x0bc d", "MIT License"]


def odd_rows(spark, texts=ODD):
    rows = [(i // 2 if i else None, t, "clash", 1.0, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, score double, source string")


def test_words_are_runs_of_a_class():
    texts = ["Ab cd  ab", "", "x", None, "é ü-Ab", "  ", "q" * 100]
    data, offsets = arrowtext.text_bytes(pa.array(texts))
    found = arrowtext.words(data, offsets, arrowtext.NOT_SPACE, arrowtext.LOWER)
    assert np.diff(found.first).tolist() == [len((t or "").split()) for t in texts]
    assert found.hash[0] == found.hash[2] == arrowtext.word_hash("ab")
    assert len(set(found.hash.tolist())) == len(found.hash) - 1


def test_words_do_not_depend_on_pieces(monkeypatch):
    texts = ["one two three " * 50, "y" * 5000, "", "four five"]
    data, offsets = arrowtext.text_bytes(pa.array(texts))
    whole = arrowtext.words(data, offsets, arrowtext.NOT_SPACE)
    monkeypatch.setattr(arrowtext, "PIECE_BYTES", 64)
    cut = arrowtext.words(data, offsets, arrowtext.NOT_SPACE)
    assert whole.hash.tolist() == cut.hash.tolist() and whole.first.tolist() == cut.first.tolist()


def test_slices_keep_every_row():
    batch = pa.record_batch([pa.array(["ab"] * 10 + ["c" * 50, None, ""])], names=["text"])
    parts = list(arrowtext.slices(iter([batch]), "text", 6))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in parts) <= 4


def test_licenses_by_brute_force(spark, sf_dir):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op3_license_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = word.findall(texts[row.doc_id].translate(lower))
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_license_rules_resolve_overlaps():
    rules = licenses.signature_rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted(r.priority for r in rules)
    detector = licenses.Detector(rules)

    def labels(text):
        words = text.split()
        gates = {g for r in rules for g in r.gate if g in words}
        return [(f.label, f.start, f.end) for f in detector.finds(words, gates)]

    assert labels("licensed under the gnu general public license version 3 now") == [("gpl-3.0", 0, 9)]
    assert labels("gnu general public license") == [("gpl", 0, 4)]
    assert labels("spdx license identifier mit or mit license") == [("mit", 0, 4), ("mit", 5, 7)]
    assert labels("cc by nc 4 0") == [("cc-by-nc-4.0", 0, 5)]
    assert labels("gnu lesser general public license version 2 1") == [("lgpl-2.1", 0, 8)]
    assert labels("an apache helicopter") == []


def test_licenses_of_odd_rows(spark):
    rows = licenses.scan_licenses(odd_rows(spark)).collect()
    assert len(rows) == len(ODD)
    assert sorted(r.n_words for r in rows) == sorted(len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) for t in ODD)
    assert [(r.labels, r.n_base, r.first_word) for r in rows if r.n_base] == [("mit", 1, 0)] * 2
    assert licenses.scan_licenses(odd_rows(spark).limit(0)).count() == 0


@pytest.fixture(scope="module")
def library():
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json")), public.path("word_bpe_49k.json")


def test_bpe_is_the_library(library):
    theirs, path = library
    ours = bpe.WordBpe(path)
    texts = ["Hello  World's 12 café!!", "<|endoftext|> hi<|startoftext|>x<|e", "İI Σς ΑΣ", "á e", "", "\xa0 \x1c x y　z", "naïve ﬁ ①②", "漢字 👩‍👩‍👧 ǅ ß ẞ", "x" * 5000, "'S 'LL it's'd'rex", "\x00\x01 ﻿", "aaaa" * 40]
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        assert ours.encoded(text)[1] == theirs.decode(ids, skip_special_tokens=False) == ours.decode(ids)


def test_bpe_forgets_words_without_harm(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 1200)
    ours = bpe.WordBpe(library[1])
    text = "one two three four five six one two seven one"
    assert ours.encode(text) == library[0].encode(text, add_special_tokens=False).ids
    assert len(ours.known) <= 3 and len(ours.known.older) <= 3


def test_bpe_query_is_the_library(spark, sf_dir, library):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for row in QUERIES["op4_bpe_roundtrip"](spark, sf_dir).collect():
        ids = library[0].encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library[0].decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_of_odd_rows(spark, library):
    rows = bpe.encode_documents(odd_rows(spark), library[1]).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(library[0].encode(t or "", add_special_tokens=False).ids) for t in ODD)
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert bpe.encoding_digests(odd_rows(spark).limit(0), library[1]).count() == 0


def test_quality_holds_out_a_fold(spark, sf_dir):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert rows == QUERIES["op1_quality_classifier"](spark, sf_dir).collect()


def test_quality_of_odd_rows(spark):
    docs = odd_rows(spark, ODD + ["fine words here", "bad !! $$$ !!"] * 40)
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert quality.classify(docs.limit(0), labels).count() == 0
    alone = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in alone} == {0.5} and {r.predicted for r in alone} == {1}


def test_temperature_softens_overconfident_scores():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 5))
    y = (draw.random(400) < 0.5).astype(int)  # nothing to learn
    net = quality.fit_network(x, y, np.arange(400) % 4 == 0, epochs=40)
    assert net.temperature > 1.5


def test_oracles_are_of_queries():
    assert set(ORACLES) <= set(QUERIES)
