"""Ranked lexical search and exact top-k by inner product against brute force."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chronoloom.llm import lexical, pivots

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranks(docs, items, k=20):
    """Rows (item, rank, doc, score) of plain lists of (id, text)."""
    bags = [(doc, collections.Counter(terms(text))) for doc, text in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    total, all_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, bag in bags for t in bag)
    weight = lambda t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
    out = []
    for item, text in set(items):
        scored = []
        for (doc, bag), n in zip(bags, sizes, strict=True):
            if n:
                m = 100 - 25 + (25 * n * total) // all_terms
                scored.append((sum(weight(t) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m)) for t in terms(text) if bag[t]), doc))
        best = sorted(((s, d) for s, d in scored if s > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, r, d, s) for r, (s, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def random_corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    text = lambda: " ".join(words[min(119, int(draw.expovariate(0.06)))] for _ in range(draw.randint(0, 60)))
    docs = [(i, text()) for i in range(n)]
    docs += [(n + i, docs[i % 7][1]) for i in range(n // 4)]  # ties
    return docs, [(i, text()) for i in range(12)]


def test_blocks_skipped_change_nothing(monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 150)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 6)
    monkeypatch.setattr(lexical, "BARE_DOCS", 4)
    docs, items = random_corpus(3, 400)
    for pairs in (lexical.PAIRS, 0):  # summaries of what is asked for, and of all terms
        monkeypatch.setattr(lexical, "PAIRS", pairs)
        queries = lexical.read_queries([i for i, _ in items], [t for _, t in items])
        found = lexical._vectors(pa.array([t for _, t in docs]), queries)
        total = int((found.size > 0).sum())
        df = np.bincount(found.term, minlength=len(queries.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for n in df])
        shard = lexical._Shard(queries, lexical.Statistics(total, int(found.size.sum()), weights))
        searcher, compared = lexical._Searcher(queries, weights, 5), []
        plain = lexical._Best.add
        monkeypatch.setattr(lexical._Best, "add", lambda self, score, *a: (compared.append(len(score)), plain(self, score, *a))[1])
        for low in range(0, len(docs), 150):
            shard.add(pa.array([i for i, _ in docs]), found, low, min(len(docs), low + 150))
            row = shard.row()
            searcher.shard({name: row.column(name)[0].values for name in lexical.INDEX.fieldNames()})
        monkeypatch.setattr(lexical._Best, "add", plain)
        got = [(items[q][0], r, int(d), int(s)) for q, best in enumerate(searcher.best) for r, (s, d) in enumerate(zip(best.score, best.id, strict=True), 1)]
        assert sorted(got, key=str) == brute_ranks(docs, items, 5)
        assert sum(compared) < 0.9 * len(docs) * len(items)  # some blocks and lists were skipped


def test_blocks_hold_their_maxima():
    docs, items = random_corpus(5, 300)
    queries = lexical.read_queries([i for i, _ in items], [t for _, t in items])
    found = lexical._vectors(pa.array([t for _, t in docs]), queries)
    shard = lexical._Shard(queries, lexical.Statistics(300, 9000, np.ones(len(queries.vocabulary), np.int64)))
    shard.add(pa.array([i for i, _ in docs]), found, 0, len(docs))
    row = {name: values[0].values.to_numpy() for name, values in zip(lexical.INDEX.fieldNames(), shard.row().columns, strict=True)}
    dense = np.zeros((len(docs), len(queries.vocabulary)), dtype=int)
    dense[np.repeat(np.arange(len(docs)), np.diff(row["doc_first"])), row["doc_terms"]] = row["doc_units"]
    at, several = 0, 0
    for first, k in zip(row["block_first"], row["block_lists"], strict=True):
        later = row["block_first"][row["block_first"] > first]
        end = min([row["list_first"][k + 1], *later.tolist()])
        term = int(row["list_terms"][k])
        columns = queries.columns(term)
        maxima = row["summaries"][at : at + queries.width(term)]
        members = row["postings"][first:end]
        assert (dense[members][:, term] > 0).all()
        assert maxima.tolist() == dense[members][:, columns].max(axis=0).tolist()
        at, several = at + len(maxima), several + (len(members) < row["list_first"][k + 1] - row["list_first"][k])
    assert at == len(row["summaries"]) and several > 10


def test_shards_travel_packed(spark):
    docs, items = random_corpus(7, 300)
    queries = lexical.read_queries([i for i, _ in items], [t for _, t in items])
    table = spark.createDataFrame(docs, "id long, text string").coalesce(1)
    statistics = lexical.corpus_statistics(table, queries)
    index = lexical.build_index(table, queries, statistics)
    assert [field.dataType.typeName() for field in index.schema] == ["binary"]  # readers and batches hold no shard's arrays
    (value,) = index.collect()
    shard = lexical._Shard(queries, statistics)
    shard.add(pa.array([i for i, _ in docs]), lexical._vectors(pa.array([t for _, t in docs]), queries), 0, len(docs))
    row, parts = shard.row(), lexical.unpack(pa.py_buffer(value[0]))
    assert {name: row.column(name)[0].values.to_pylist() for name in lexical.INDEX.fieldNames()} == {name: part.to_pylist() for name, part in parts.items()}
    assert len(value[0]) < row.nbytes / 2


def test_row_groups_of_an_index_are_cut_by_size(spark, tmp_path):
    shards = spark.range(40).coalesce(1).select(F.expr("cast(repeat(sha2(cast(id as string), 256), 16384) as binary)").alias("shard"))  # 1 MB each
    shards.write.options(**lexical.STORAGE).parquet(str(tmp_path / "index"))
    (file,) = (tmp_path / "index").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(at).total_byte_size for at in range(meta.num_row_groups)) < 12 << 20


@pytest.mark.parametrize("limit", [None, 200])
def test_ranks_by_brute_force(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(lexical, "QUERY_BYTES", limit)  # several blocks of queries
    docs, items = random_corpus(11, 200)
    docs += [(None, "w1 w2 w3"), (None, None), (5000, ""), (5001, None), (7, docs[7][1]), (5002, "É ü-w1 W2 " * 3000)]
    items += [(20, None), (21, ""), (22, "none of these"), (None, "w1 W2"), (3, items[3][1]), (3, "w5 w5 w5 É")]
    left = spark.createDataFrame([(i, t, 1.0, "x") for i, t in docs], "doc_id long, text string, score double, rank string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    rows = lexical.rank_documents(left, right).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str) == brute_ranks(docs, items)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id int, text string")
    assert [tuple(r) for r in lexical.rank_documents(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]
    assert lexical.rank_documents(docs.limit(0), items).collect() == []
    assert lexical.rank_documents(docs, items.limit(0)).collect() == []
    assert lexical.rank_documents(docs, spark.createDataFrame([(1, "!? ..")], items.schema)).collect() == []
    assert lexical.rank_documents(docs.where("false"), items).columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        lexical.rank_documents(docs.select(F.col("doc_id").cast("string"), "text"), items)


def brute_products(rows, asks, k, scale=256):
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for i, v in {(i, tuple(v)) for i, v in whole if i is not None and asks(i)}:
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in whole if j != i]
        best = sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(i, r, j, s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out, key=str)


def vectors(seed, n, dims=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, dims))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] * draw.uniform(0.5, 2) + 0.2 * draw.normal(size=dims)]) for i in range(n)]
    return rows + [(n + i, rows[3][1]) for i in range(n // 3)]  # a third alike


@pytest.mark.parametrize("limit", [None, 1000])
def test_products_by_brute_force(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(pivots, "QUERY_BYTES", limit)  # several rounds of queries
    rows = vectors(1, 600)
    rows += [(None, rows[0][1]), (2000, None), (2001, [None] * 6), (2002, [float("nan")] + [0.0] * 5), (2010, [0.0] * 6), (2020, [1.0, 2.0]), (2030, []), (10, rows[11][1]), (10, rows[10][1])]
    table = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    found = pivots.nearest_by_product(table, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_products(rows, lambda i: i % 10 == 0, 5)


def test_pivots_rule_candidates_out():
    rows = vectors(2, 3000, 4)
    values = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    ids = np.array([i for i, _ in rows])
    norm = (values * values).sum(axis=1)
    space = pivots.Space(len(rows), 4, int(norm.max()), values[::100])
    far = space.distances(values, True)
    asking = np.arange(0, len(rows), 50)
    products = values[asking] @ values.T
    # bounds hold for every pair, and often say more than nothing
    gap = np.abs(space.distances(values[asking], False)[:, None, :] - far[None, :, :].astype(np.float32)).max(axis=2)
    bound = space.most(norm[asking][:, None].astype(float), gap)
    assert (bound >= products).all()
    best = np.sort(products, axis=1)[:, -6]
    assert (bound < best[:, None]).mean() > 0.3
    search = pivots._Search(space, ids[asking], values[asking], np.full(len(asking), pivots.NO_BAR), 5)
    for low in range(0, len(rows), 512):
        own = far[low : low + 512].astype(np.float32)
        parts = (ids[low : low + 512], values[low : low + 512].astype(np.int32).ravel(), own.ravel(), own.min(axis=0), own.max(axis=0))
        search.block(dict(zip(("ids", "values", "distances", "low", "high"), map(pa.array, parts), strict=True)))
    got = sorted(zip(ids[asking][search.query].tolist(), search.id.tolist(), search.score.tolist(), strict=True))
    whole = brute_products(rows, lambda i: i % 50 == 0, 5)
    assert got == sorted((q, i, s) for q, _, i, s in whole)


def test_products_of_nothing(spark):
    table = spark.createDataFrame([(0, [1.0, -0.5])], "vec_id int, embedding array<double>")
    asks = F.col("vec_id") % 50 == 0
    assert pivots.nearest_by_product(table, asks).collect() == []
    assert pivots.nearest_by_product(table.limit(0), asks).collect() == []
    assert pivots.nearest_by_product(table, F.lit(False)).columns == ["query_id", "rank", "vec_id", "score"]
    assert pivots.nearest_by_product(spark.createDataFrame([(i, []) for i in (0, 1)], "vec_id long, embedding array<float>"), asks).count() == 1
    alike = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(120)], "vec_id long, embedding array<float>")
    found = pivots.nearest_by_product(alike, asks).collect()
    assert sorted(tuple(r)[1:] for r in found if r.query_id == 0) == [(r, r, 0) for r in range(1, 6)]
    with pytest.raises(Exception, match="component"):
        pivots.nearest_by_product(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>"), asks).collect()
