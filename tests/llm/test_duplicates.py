"""Exact and near duplicates, repeated passages and embeddings, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoloom.llm import chunks, embedding_join, exact_dedup, graph, shingle_join
from chronoloom.llm.queries import QUERIES
from chronoloom.session import scratch_path

DOCS = "doc_id long, text string, node string, at string, kept boolean, text_hash long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "n", "a", True, 7) for i, t in rows], DOCS)


class Sets:
    """Components by union, smallest id first."""

    def __init__(self, ids):
        self.to = {i: i for i in ids}

    def find(self, x):
        while self.to[x] != x:
            self.to[x] = x = self.to[self.to[x]]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.to[max(a, b)] = min(a, b)


def shingle_sets(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def linked_by_force(sets):
    found, seen = Sets(sets), defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for g in sets[i] for j in seen[g])
        for j, n in common.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                found.join(i, j)
        for g in sets[i]:
            seen[g].append(i)
    return {i: (len(s), found.find(i)) for i, s in sets.items()}


def prose(draw, n, words=400):
    return [f"w{draw.randrange(words)}" for _ in range(n)]


def near_copies(seed, shared=()):
    draw, rows = random.Random(seed), []
    for k in range(40):
        words = prose(draw, draw.randint(1, 120))
        if shared and k % 2:
            words[len(words) // 2 : len(words) // 2] = shared
        rows.append(" ".join(words))
        for _ in range(draw.randint(0, 3)):
            other = list(words)
            for _ in range(draw.randint(0, 4)):
                other[draw.randrange(len(other))] = f"v{draw.randrange(50)}"
            rows.append(" ".join(other))
    return list(enumerate(rows))


def test_components_of_any_shape(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 30)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    edges += [(5, 5), (1, 2), (2, 1)]
    force = Sets(range(300))
    for a, b in edges:
        force.join(a, b)
    rows = graph.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows}) == len({x for a, b in edges if a != b for x in (a, b)})
    members = defaultdict(set)
    for r in rows:
        members[r.root].add(force.find(r.node))
    assert all(len(m) == 1 for m in members.values()) and len(members) == len({force.find(r.node) for r in rows})
    words = graph.components(spark.createDataFrame([("b", "a"), ("b", "c")], "a string, b string")).collect()
    assert {r.node for r in words} == {"a", "b", "c"} and len({r.root for r in words}) == 1
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_duplicates_of_odd_rows(spark):
    rows = [(3, "a  b"), (1, "a\tb"), (None, "a b"), (2, None), (5, ""), (4, "   "), (6, "x" * 200_000), (7, "x" * 200_000), (8, "A b"), (1, "a b"), (None, "alone")]
    got = exact_dedup.exact_duplicates(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    by = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[(3, 1, 4, sha("a b"))] == 1 and by[(1, 1, 4, sha("a b"))] == 2 and by[(None, 1, 4, sha("a b"))] == 1
    assert by[(2, 2, 2, sha(""))] == 1 and by[(5, 2, 2, sha(""))] == 1 and by[(4, 4, 1, sha(" "))] == 1
    assert by[(7, 6, 2, sha("x" * 200_000))] == 1 and by[(None, None, 1, sha("alone"))] == 1
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_distinct_documents_keep_columns(spark):
    docs = docs_of(spark, [(2, "a"), (1, "a"), (3, "b"), (4, None)])
    path = scratch_path(spark, "test-docs")
    docs.write.parquet(path)
    for frame in (docs, spark.read.parquet(path)):
        out = exact_dedup.distinct_documents(frame)
        assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_state_goes_on_over_batches_and_runs(spark):
    """Entries of earlier batches, and of an earlier run of the stream, are met by later rows."""
    source, out, checkpoint = (scratch_path(spark, f"test-{k}") for k in ("source", "state", "stream"))
    schema = "digest binary, doc_id long, at struct<file:string,row:long>"
    frame = lambda rows: spark.createDataFrame([(bytes([d]), i, ("f", i)) for d, i in rows], schema)
    for part in ([(1, 5), (2, 6)], [(1, 3), (1, 9)]):
        frame(part).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(frame([]).schema).option("maxFilesPerTrigger", 1).parquet(source)
    exact_dedup.run_state(stream(), checkpoint, out)
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
    frame([(2, 1), (3, 8)]).coalesce(1).write.mode("append").parquet(source)
    exact_dedup.run_state(stream(), checkpoint, out)
    got = {r.digest[0]: (r["first"].doc_id, r.n) for r in exact_dedup.state_entries(spark, out).collect()}
    assert got == {1: (3, 3), 2: (1, 2), 3: (8, 1)}


def test_hits_are_checked_byte_by_byte(spark, monkeypatch):
    """With a digest that tells nothing apart, bytes alone decide."""
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "b b"), (5, "b\nb"), (6, None)]
    real = exact_dedup.F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: real(exact_dedup.F.substring(c, 1, 0), n))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(docs_of(spark, rows)).collect()}
    assert got == {1: (1, 2, True), 3: (1, 2, False), 2: (2, 1, True), 4: (4, 2, True), 5: (4, 2, False), 6: (6, 1, True)}


def test_sets_that_link_share_a_signature():
    draw = np.random.default_rng(2)
    none = np.zeros(0, dtype=np.uint64)
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 17, 30, 61, 100, 257, 1000, 5000]:
        for _ in range(25):
            a = np.unique(draw.integers(1, 1 << 62, size, dtype=np.uint64))
            most = size * 100 // 80 - size  # additions that keep the similarity
            add, drop = draw.integers(0, most + 1), 0
            while 100 * (size - drop - 1) >= 80 * (size + add) and draw.random() < 0.97:
                drop += 1
            b = np.unique(np.concatenate((a[draw.permutation(len(a))[drop:]], draw.integers(1, 1 << 62, add, dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            assert shingle_join.could_link(len(a), shingle_join.sketch(a), len(b), shingle_join.sketch(b))
            assert 100 * both >= 80 * (len(a) + len(b) - both)
            for common in (none, np.sort(a[: len(a) // 2]), np.sort(np.union1d(a, b))):
                assert len(np.intersect1d(shingle_join.signatures(a, common), shingle_join.signatures(b, common)))


def test_sketches_rule_out_other_sets():
    draw = np.random.default_rng(6)
    for size in (40, 300, 3000, 20_000):
        a, b = (np.unique(draw.integers(1, 1 << 64, size, dtype=np.uint64)) for _ in range(2))
        assert not shingle_join.could_link(len(a), shingle_join.sketch(a), len(b), shingle_join.sketch(b))


@pytest.mark.parametrize("shared", [(), tuple(f"s{k}" for k in range(60))])
def test_near_duplicates_by_brute_force(spark, shared, monkeypatch):
    monkeypatch.setattr(shingle_join, "COMMON_SAMPLE", 1)  # passages shared by half the texts count as common
    rows = near_copies(5, shared)
    expected = linked_by_force(shingle_sets(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == expected and len({c for _, c in got.values()}) < len(got) - 20


def test_near_duplicates_of_the_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_ngram_join"](spark, sf_dir).collect()}
    assert got == linked_by_force(shingle_sets(rows))


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (9, "one two"), (4, "One TWO"), (4, "one two"), (5, "one two three"), (None, "one two"), (7, long), (6, long + " end"), (None, "q")]
    docs = docs_of(spark, rows)
    got = shingle_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (9, 1, 4), (4, 1, 4), (4, 1, 4), (5, 1, 5), (None, 1, 4), (7, 29_996, 6), (6, 29_997, 6), (None, 1, None)]
    )
    left = shingle_join.one_of_each(docs)
    assert left.columns == docs.columns and Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 3, 4, 4, 5, 6, None])
    assert shingle_join.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_across_components_of_a_group(spark, tile, monkeypatch):
    """A chain in which the smallest member of a group is linked with none of the others."""
    monkeypatch.setattr(shingle_join, "TILE", tile)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words[:50] + [f"x{i}" for i in range(50)])]
    for k in range(8):
        words[10 * k + 3] = f"z{k}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == linked_by_force(shingle_sets(rows)) and got[8][1] == 1


def test_chunks_resist_shifts():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 123, 4000).astype(np.uint8)
    ends = chunks.chunk_ends(data, np.array([0, len(data)]))
    moved = np.concatenate((draw.integers(97, 123, 137).astype(np.uint8), data))
    again = chunks.chunk_ends(moved, np.array([0, len(moved)])) - 137
    assert ends[-1] == 4000 and np.diff(ends, prepend=0).max() <= chunks.LONGEST
    assert set(ends[ends > 300].tolist()) <= set(again.tolist())
    flat = chunks.chunk_ends(np.full(5000, 97, dtype=np.uint8), np.array([0, 5000]))
    assert np.diff(flat, prepend=0).max() <= chunks.LONGEST and flat[-1] == 5000


def test_passages_by_brute_force(spark, sf_dir):
    """Documents that share more than 50 words are found; those without a common run of a dozen words are left alone."""
    texts = {r[0]: (r[1] or "").split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}

    def sharing(n):
        held = defaultdict(set)
        for i, w in texts.items():
            for k in range(len(w) - n + 1):
                held[tuple(w[k : k + n])].add(i)
        return set().union(*(s for s in held.values() if len(s) > 1))

    rows = QUERIES["op10_repeated_passages"](spark, sf_dir).collect()
    found = {r.doc_id for r in rows}
    assert sharing(51) <= found <= sharing(12)
    assert all(r.kept == (r.doc_id == r.keep_doc_id) or not r.kept for r in rows)


def test_passages_of_planted_documents(spark):
    draw = random.Random(4)
    passage = " ".join(prose(draw, 55, 5000))
    rows = [(i, " ".join(prose(draw, 80, 5000) + ([passage] if i < 12 else []) + prose(draw, 60, 5000))) for i in range(40)]
    copy = " ".join(prose(draw, 40, 5000))
    rows += [(50, copy), (51, copy), (51, copy), (None, copy), (60, None), (61, ""), (62, "short"), (63, "short"), (64, "é " * 40_000)]
    got = chunks.repeated_passages(docs_of(spark, rows)).collect()
    assert {r.doc_id for r in got} == {*range(12), 50, 51, None}
    texts = dict(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 12:
            cut = texts[r.doc_id].encode()[r.start : r.end].decode()
            assert passage.find(cut.strip()[5:-5]) >= 0 and r.n_words >= chunks.MIN_WORDS and r.keep_doc_id < 12
    assert sorted((r.doc_id or 0, r.keep_doc_id, r.kept) for r in got if r.doc_id in (50, 51, None)) == [(0, 50, False), (50, 50, True), (51, 50, False), (51, 50, False)]
    assert sum(r.kept for r in got if r.doc_id is not None and r.doc_id < 12) >= 1
    assert chunks.repeated_passages(docs_of(spark, rows).limit(0)).count() == 0


def common_prose(draw, n):
    """Words of a small vocabulary, so that short chunks repeat by chance everywhere."""
    return [draw.choice(("of", "the", "a", "in", "it", "was", "to", "on")) for _ in range(n)]


def spans_of(rows, got):
    texts = dict(rows)
    return [(r, texts[r.doc_id].encode()[r.start : r.end].decode()) for r in got]


def test_every_passage_is_kept_once(spark):
    draw = random.Random(5)
    passages = [" ".join(common_prose(draw, 60)) for _ in range(20)]
    rows = [(i, " ".join([*common_prose(draw, 70), f"x{i}", passages[i % 20], f"y{i}", *common_prose(draw, 70)])) for i in range(60)]
    got = spans_of(rows, chunks.repeated_passages(docs_of(spark, rows)).collect())
    for k, passage in enumerate(passages):
        here = [r for r, text in got if text == passage]
        assert sorted(r.doc_id for r in here) == [k, k + 20, k + 40]
        assert [r.doc_id for r in here if r.kept] == [here[0].keep_doc_id] and len({r.keep_doc_id for r in here}) == 1


def test_passages_are_whole(spark):
    """Passages of 51 words, short ones among them, are found from their first byte to their last."""
    draw = random.Random(6)
    passages = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) + draw.choice("xyz") for _ in range(51)) for _ in range(150)]
    rows = [(i, " ".join([f"p{i}", *prose(draw, 30, 5000), f"x{i}", passages[i % 150], f"y{i}", *prose(draw, 30, 5000)])) for i in range(300)]
    got = spans_of(rows, chunks.repeated_passages(docs_of(spark, rows)).collect())
    assert sorted((r.doc_id, r.n_words, text) for r, text in got) == [(i, 51, passages[i % 150]) for i in range(300)]


def test_passages_need_one_partner(spark):
    """Pieces that each stand in some other document make no passage if no document has them in a row."""
    draw = random.Random(7)
    pieces = [" ".join(prose(draw, 20, 5000)) for _ in range(30)]
    rows = [(i, " ".join(draw.sample(pieces, 12))) for i in range(25)]
    assert chunks.repeated_passages(docs_of(spark, rows)).count() == 0


def test_passages_of_very_many_documents(spark, monkeypatch):
    draw = random.Random(9)
    passage = " ".join(prose(draw, 60, 5000))
    rows = [(i, " ".join([*prose(draw, 60, 5000), f"x{i}", *([passage] if i < 30 else []), f"y{i}"])) for i in range(40)]
    docs = docs_of(spark, rows)
    at_once = sorted(chunks.repeated_passages(docs).collect())
    monkeypatch.setattr(chunks, "HOT_ROWS", 20)
    assert len(at_once) == 30 and sorted(chunks.repeated_passages(docs).collect()) == at_once


def test_passages_of_copies(spark):
    """The document that stays of a group of copies is judged like any other."""
    draw = random.Random(8)
    rows = []
    for k in range(12):
        passage = " ".join(prose(draw, 60, 5000))
        copy = " ".join([*prose(draw, 40, 5000), f"x{k}", passage, f"y{k}", *prose(draw, 40, 5000)])
        rows += [(10 * k, copy), (10 * k + 1, copy), (10 * k + 2, " ".join([*prose(draw, 40, 5000), f"u{k}", passage, f"v{k}", *prose(draw, 40, 5000)]))]
    whole = {i: len(t) for i, t in rows}
    got = chunks.repeated_passages(docs_of(spark, rows)).collect()
    for k in range(12):
        parts = [r for r in got if r.doc_id // 10 == k and r.end - r.start < whole[r.doc_id]]
        assert sorted(r.doc_id for r in parts) == [10 * k, 10 * k + 2] and sum(r.kept for r in parts) == 1
        assert sorted((r.doc_id, r.kept) for r in got if r.doc_id // 10 == k and r not in parts) == [(10 * k, True), (10 * k + 1, False)]


def vectors_by_force(rows, cosine=0.98):
    good = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.append((k, np.array(v, dtype=np.float32).astype(float), label))
    links, found = Counter(), Sets(range(len(rows)))
    for n, (a, x, la) in enumerate(good):
        for b, y, lb in good[:n]:
            if la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                found.join(a, b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[found.find(k)] = min(least.get(found.find(k), i), i)
    return Counter((i, links[k], least[found.find(k)], i == least[found.find(k)]) for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("tile", [4, 2048])
def test_embeddings_by_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(embedding_join, "TILE", tile)
    draw = np.random.default_rng(7)
    rows = []
    for k in range(120):
        base = draw.normal(size=64)
        for _ in range(draw.integers(1, 4)):
            rows.append((base + draw.normal(size=64) * draw.choice([0, 0.05, 0.15, 0.2]), int(k % 3)))
    hub = draw.normal(size=64)
    rows += [(hub + draw.normal(size=64) * 0.1, 1) for _ in range(40)] + [(hub, 1)] * 5
    order = draw.permutation(len(rows))
    rows = [(int(i), [float(np.float32(x)) for x in v], label) for i, (v, label) in zip(order, rows)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = Counter(tuple(r) for r in embedding_join.near_duplicates(frame).collect())
    assert got == vectors_by_force(rows) and max(r[1] for r in got) > 30


def test_embeddings_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0), (7, [1.0, None], 0), (8, [nan, 1.0], 0)]
    rows += [(9, [inf, 1.0], 0), (10, [], 0), (11, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0], 0), (12, [-1.0, 0.0], 0), (13, [1e-30, 1e-32], 0), (14, [1.0], 0), (15, [3.0], 0)]
    frame = spark.createDataFrame([(*r, "n", 5) for r in rows], "vec_id long, embedding array<float>, label int, node string, n_links long")
    got = Counter(tuple(r) for r in embedding_join.near_duplicates(frame).collect())
    assert got == vectors_by_force(rows)
    assert embedding_join.near_duplicates(frame.limit(0)).count() == 0
