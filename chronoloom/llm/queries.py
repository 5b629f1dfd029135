"""The operators over their whole tables, as registered queries, and their SQL twins."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import bpe, chunks, embedding_join, exact_dedup, lexical, licenses, mixing, periodic, pivots, quality, shingle_join, urls, wrappers

TOKENIZER = "word_bpe_49k.json"

URL_RULES = [
    urls.Rule("block", "net"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let Python workers find this package also where a session was started from another folder."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in known if p] + [ROOT])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoding_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_pages(_table(spark, sf_dir, "pages"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(_table(spark, sf_dir, "documents"))


WORD = r"[^\x20\x09-\x0D]+"


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text of ``docs``, where every tenth document by the checksum of its id repeats some of its own words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    n, g = F.size("w").cast("bigint"), F.floor(F.col("h") / 10)
    at = words.select("doc_id", "text", "w", n.alias("n"), (g % F.greatest(n, F.lit(1))).alias("a"), g.alias("g"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    at = at.select("doc_id", "text", "w", F.col("n").cast("int").alias("n"), F.col("a").cast("int").alias("a"), period.alias("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    loop = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    looped = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), loop), F.lit(1), F.col("n")), " ")
    return at.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_loops(_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", "n_words", "collapsed", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        "n_runs",
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.nearest_by_product(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_bpe_roundtrip": op4_bpe_roundtrip,
    "op5_source_mix": op5_source_mix,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_ngram_join": op7_ngram_join,
    "op8_html_text": op8_html_text,
    "op9_url_filter": op9_url_filter,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_exact_top_k": op13_exact_top_k,
}

_REACH = """reach AS (
  SELECT {id} AS id, {id} AS seen FROM {table}
  UNION
  SELECT reach.id, edges.b FROM reach JOIN edges ON reach.seen = edges.a
)"""
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Queries without an entry have no SQL form: a trained network, licence rules, byte pairs, entropy balancing, wrappers and chunks by content.
ORACLES = {
    "op2_exact_dedup": """
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)""",
    "op6_embedding_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), edges AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
    AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.98
), {_REACH.format(id="vec_id", table="embeddings")}, c AS (SELECT id AS vec_id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT c.vec_id, (SELECT count(*) FROM edges WHERE a = c.vec_id) AS n_links, c.component_id, c.vec_id = c.component_id AS kept FROM c""",
    "op7_ngram_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS k FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
edges AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.i >= 80 * (na.n_shingles + nb.n_shingles - p.i)
), {_REACH.format(id="doc_id", table="documents")}, c AS (SELECT id AS doc_id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT c.doc_id, coalesce(n.n_shingles, 0) AS n_shingles, c.component_id FROM c LEFT JOIN n USING (doc_id)""",
    "op12_lexical_search": f"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), q AS (
  SELECT item_id, term, count(*) AS r FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_TERM}')) AS term FROM benchmark)
  GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), total GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op13_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    # The pages of the tables declare no canonical links or redirects, so their rules alone decide; aliases are tested on a fixture.
    "op9_url_filter": f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT * FROM (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}) t(verdict, rule_host, rule_path)
), m AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
}
