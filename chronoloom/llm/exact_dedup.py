"""Exact deduplication of texts as a stream with disk-backed state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm.stored import fresh, stored
from chronoloom.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",  # stores of an ended stream are unloaded by it
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every state partition reserves some MB of disk
}

COMPARED = 512
"""Copies compared with one copy of their group's recorded text."""

FREQUENT = 1024


def normalised(text: Column) -> Column:
    """Runs of white space (space, tab to carriage return) as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def located(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with ``at``, the place of each row's content: its file and its row there.

    Rows that do not come straight from files are written to the shared folder first and located there.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    if "_metadata" not in docs.columns:
        try:
            return docs.select("doc_id", "text", at.alias("at"))
        except AnalysisException:
            pass
    path = scratch_path(docs.sparkSession, "dedup-content")
    docs.select("doc_id", "text").write.parquet(path)
    return docs.sparkSession.read.parquet(path).select("doc_id", "text", at.alias("at"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay by ``exact_duplicates``, with all their columns."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    (name,) = fresh(docs, "dedup_at")
    try:
        rows = docs.select("*", at.alias(name))
    except AnalysisException:
        docs = stored(docs, "dedup-input")
        rows = docs.select("*", at.alias(name))
    dropped = exact_duplicates(docs).where("not kept").select(F.col("at").alias(name))
    return rows.join(dropped, name, "left_anti").drop(name)


def _order() -> Column:
    """Smallest id first, rows without one last, the place in the input between equal ids."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")


def first_seen(digests: DataFrame) -> DataFrame:
    """Keyed state of a stream of (digest, doc_id, at): one entry for each digest, with its first row and its rows counted.

    There is no watermark, so no entry ever expires. Rows of a batch are combined per digest before they are dealt to the state,
    so a digest that a third of all rows share costs one entry a task.
    """
    return digests.groupBy("digest").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n"))


def run_state(stream: DataFrame, checkpoint: str, out: str) -> None:
    """Run the keyed state over a stream until its input is used up; what changed in each batch goes to ``out/batch=N``.

    A batch that is run again overwrites its own folder, and the checkpoint lets a later call go on with newer input.
    """
    spark = stream.sparkSession
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    try:
        query = (
            first_seen(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_entries(spark: SparkSession, out: str) -> DataFrame:
    """The newest entry of each digest: (digest, first, n)."""
    changes = spark.read.parquet(out)
    newest = changes.groupBy("digest").agg(F.max(F.struct("batch", "first", "n")).alias("e"))
    return newest.select("digest", "e.first", "e.n")


def exact_duplicates(docs: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: doc_id, at, keep_id, keep_at, group_size, kept, text_sha256.

    Texts are equal if they agree after white space is normalised; null is an empty text, and empty texts are equal to each other.
    Of equal texts the row with the smallest id stays; a null id comes last, and of rows with one id and text, the first in
    the input stays. Digests stream through RocksDB state (``first_seen``), ``files_per_batch`` digest files a batch, all at once by
    default. State holds digest, first id, place of the first row's content and the count. Each further row with a known digest is a hit: its bytes are compared
    with those at the recorded place, and rows that differ there are grouped by their bytes instead. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = located(docs)
    path = scratch_path(spark, "dedup-digests")
    hashed = rows.select("doc_id", "at", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))
    hashed.write.parquet(path)
    digests = spark.read.parquet(path)
    reader = spark.readStream.schema(digests.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = scratch_path(spark, "dedup-state")
    run_state(reader.parquet(path), scratch_path(spark, "dedup-stream"), out)
    known = state_entries(spark, out) if _has_files(spark, out) else digests.limit(0).select("digest", _order().alias("first"), F.lit(0).cast("long").alias("n"))

    grouped = _with_entries(digests, known).select(
        "doc_id", "at", "digest", F.col("first.doc_id").alias("keep_id"), F.col("first.at").alias("keep_at"), F.col("n").alias("group_size")
    )
    grouped = stored(grouped, "dedup-groups")
    differing = stored(_differing(rows, grouped.where("group_size > 1")), "dedup-differing")
    if not differing.isEmpty():
        grouped = _regrouped(grouped, rows, differing)
    return grouped.withColumn("kept", F.col("at") == F.col("keep_at")).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def _has_files(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _differing(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Places of rows whose bytes are not those of the row recorded for their digest."""
    text = rows.select("at", normalised(F.col("text")).alias("bytes"))
    members = stored(hits.select("at", "keep_at", "group_size").join(text, "at"), "dedup-bytes")
    # The recorded text of a large group goes to several tasks, once for each COMPARED of its copies, so that they meet it in many.
    shares = F.ceil(F.col("group_size") / COMPARED).cast("int")
    recorded = members.where("at = keep_at").select("keep_at", F.col("bytes").alias("keep_bytes"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    copies = members.where("at <> keep_at").withColumn("share", F.pmod(F.xxhash64("at"), shares).cast("int"))
    return copies.join(recorded, ["keep_at", "share"]).where("bytes <> keep_bytes").select("at")


def _with_entries(digests: DataFrame, known: DataFrame) -> DataFrame:
    """Each row of ``digests`` with the entry of its digest. Entries that hold more than one in FREQUENT of all rows, and so are
    fewer than FREQUENT, are broadcast; their rows need not meet in one task."""
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * FREQUENT > total
    frequent, rare = F.broadcast(known.where(often)), known.where(~often)
    return digests.join(frequent, "digest").unionByName(digests.join(frequent, "digest", "left_anti").join(rare, "digest"))


def _regrouped(grouped: DataFrame, rows: DataFrame, differing: DataFrame) -> DataFrame:
    """Groups of one digest but different bytes, split by the bytes themselves."""
    text = rows.select("at", normalised(F.col("text")).alias("bytes"))
    mixed = grouped.join(grouped.join(differing, "at", "left_semi").select("digest").distinct(), "digest", "left_semi").join(text, "at")
    by_bytes = mixed.groupBy("digest", "bytes").agg(F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n"))
    split = mixed.select("doc_id", "at", "digest", "bytes").join(by_bytes, ["digest", "bytes"])
    split = split.select("at", F.col("first.doc_id").alias("keep_id2"), F.col("first.at").alias("keep_at2"), F.col("n").alias("n2"))
    joined = grouped.join(split, "at", "left")
    return joined.select(
        "doc_id",
        "at",
        "digest",
        F.when(F.col("n2").isNull(), F.col("keep_id")).otherwise(F.col("keep_id2")).alias("keep_id"),
        F.coalesce("keep_at2", "keep_at").alias("keep_at"),
        F.coalesce("n2", "group_size").alias("group_size"),
    )
