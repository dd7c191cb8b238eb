"""Bronze -> silver as a Structured Streaming job.

The reference runs the daily transform as a scheduled batch; the same work as
an incremental file stream picks up every newly landed day exactly once (the
file source keeps a log of processed files in the checkpoint), and re-runs
are safe because each micro-batch rebuilds the days it touches from all files
of those days, however the files are spread over batches.
``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can start it once a day; a long-running trigger works as well.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lodestone import schemas
from lodestone.operators import envelope
from lodestone.plans.daily import flatten_checked, land_documents
from lodestone.session import shared_path
from lodestone.sources.bronze import BRONZE_SCHEMA, read_bronze


def bronze_stream(spark: SparkSession, bronze_root: str, feed: str, max_files_per_trigger: int | None = None,
                  whole_text: bool = False):
    """NDJSON bronze files (one document per line); ``whole_text`` for
    pretty-printed landing files (one document per file)."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.text(os.path.join(bronze_root, feed), wholetext=whole_text)
    return docs if whole_text else docs.where(F.length(F.trim("value")) > 0)


def start_landing(spark: SparkSession, bronze_root: str, silver_root: str, feed: str, checkpoint: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None, whole_text: bool = False,
                  on_missing: str = "fail", complete: bool = True):
    """Start the stream; returns the StreamingQuery."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the days of the batch (a handful of strings), then those days whole
        days = sorted(r[0] for r in batch.select("ingested_at").distinct().collect())
        if days:
            docs = read_bronze(batch.sparkSession, os.path.join(bronze_root, feed), days=days, whole_text=whole_text)
            land_documents(docs, silver_root, feed, days, on_missing=on_missing, complete=complete)

    writer = (bronze_stream(spark, bronze_root, feed, max_files_per_trigger, whole_text).writeStream
              .foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


# --------------------------------------------------------------------------
# Landing by document. ``start_landing`` rebuilds the days that a batch touches
# from all their files. Here only the batch's own documents are read: a state
# store knows the documents that have come, and a batch writes under its own number.

BATCH = "batch"


def documents_once(docs: DataFrame, delay: str) -> DataFrame:
    """Each document (load day and text) of a file stream once, however often
    it is delivered. The state holds a 16-byte name of every document that
    arrived within ``delay`` of the newest file; time is that of arrival (the
    file's), not the load day, so a document of a day long past is not late."""
    named = docs.withColumn("document", F.md5(F.concat_ws("\n", "ingested_at", "value")))
    return named.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["document"]).select("value", "ingested_at")


def _stored(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def write_batch(docs: DataFrame, silver_root: str, feed: str, batch_id: int, on_missing: str = "fail", complete: bool = True,
                spark: SparkSession | None = None) -> None:
    """Valid rows to ``<feed>/ingested_at=<day>/batch=<n>``, rejects and refused
    documents likewise below ``_rejects``. A batch that is run again after a
    failure replaces exactly what it wrote before.

    The batch is read once, since every reading is a run of the stream's plan with its state: its
    documents are stored as Parquet, and so are their checked rows. All else reads these in ``spark``, the
    session that started the stream. Spark turns adaptive execution off in
    the session of a stream with state, and without it every task of a
    write has a file in every day."""
    spark = spark or docs.sparkSession
    folder = shared_path(spark, "landing-batch")
    checked = envelope.check_envelope(docs, feed, complete=complete)
    if feed == "fred":  # its rows come from ``top``; the text is kept of refused documents
        checked = checked.withColumn("value", F.when(F.col("envelope_error").isNotNull(), F.col("value")))
    else:
        checked = checked.drop("top")
    checked = _stored(checked, spark, f"{folder}/documents")
    refused = checked.where(F.col("envelope_error").isNotNull()).select(
        F.lit("document").alias("level"), F.col("envelope_error").alias("reject_reasons"), F.col("value").alias("document"), "ingested_at")
    rows = flatten_checked(checked, feed, on_missing=on_missing)
    # null if valid: row groups without rejects are skipped by their statistics
    rows = _stored(rows.withColumn("reject_reasons", F.when(F.size("reject_reasons") > 0, F.array_join("reject_reasons", ","))), spark, f"{folder}/rows")
    valid = rows.where(F.col("reject_reasons").isNull()).drop("reject_reasons")
    rejects = rows.where(F.col("reject_reasons").isNotNull()).withColumn("level", F.lit("row")).unionByName(refused, allowMissingColumns=True)
    for rows, path in ((valid.withColumn("loaded_at", F.current_timestamp()), os.path.join(silver_root, feed)),
                       (rejects, os.path.join(silver_root, "_rejects", feed))):
        (rows.withColumn(BATCH, F.lit(batch_id)).hint("rebalance", "ingested_at").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("ingested_at", BATCH).parquet(path))


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = {PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           # without the count of its rows a put needs no look-up
           "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


FILES = "spark.sql.streaming.checkpointFileManagerClass"
# Hadoop's FileContext, which Spark asks first, starts ``readlink`` processes for each rename
# in a local or mounted folder, and every state partition renames its files in every batch.
# There its FileSystem renames by the same system call without them.
BY_FILE_SYSTEM = {FILES: "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}


def _is_local(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark._jvm, spark._jsparkSession.sparkContext().hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).getUri().getScheme() == "file"


@contextmanager
def state_on_disk(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whose memory does
    not grow with the number of names; Spark's default holds them all in the
    executors' heap. A session that names a provider keeps it, and a
    checkpoint stays with the provider that it began with. A checkpoint in
    a local or mounted folder is written by Hadoop's FileSystem, unless the
    session names a file manager; elsewhere Spark chooses."""
    wanted = {} if spark.conf.get(PROVIDER, None) is not None else dict(ON_DISK)
    if spark.conf.get(FILES, None) is None and _is_local(spark, checkpoint):
        wanted.update(BY_FILE_SYSTEM)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_document_landing(spark: SparkSession, bronze_root: str, silver_root: str, feed: str, checkpoint: str, delay: str = "30 days",
                           available_now: bool = True, max_files_per_trigger: int | None = None, on_missing: str = "fail", complete: bool = True):
    """Land NDJSON bronze files document by document, each exactly once: the
    file source gives every file to one batch, the state drops documents that
    came before in another file, and batches overwrite themselves. Cost is that
    of the new files. Returns the StreamingQuery; its progress has the metric
    ``documents`` (see ``Counters``). A table is landed this way or by
    ``start_landing``, not by both: their folders differ."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.text(os.path.join(bronze_root, feed)).where(F.length(F.trim("value")) > 0) \
        .select("value", "ingested_at", F.col("_metadata.file_modification_time").alias("arrived"))
    new = documents_once(docs.observe("delivered", F.count(F.lit(1)).alias("n")), delay).observe("documents", F.count(F.lit(1)).alias("n"))
    writer = new.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_batch(batch, silver_root, feed, batch_id, on_missing, complete, spark))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    with state_on_disk(spark, checkpoint):
        return writer.start()


def read_landed(spark: SparkSession, silver_root: str, feed: str) -> DataFrame:
    """The silver rows that ``start_document_landing`` wrote, in the table's own columns."""
    schema = schemas.silver_with_partition(feed)
    return spark.read.schema(schema).parquet(os.path.join(silver_root, feed)).select(*schema.names)


class Counters(StreamingQueryListener):
    """FLT-7 for streams: (batch, metric, n) of every observed count of the
    queries of a session, as they make progress; no job counts anything."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, str, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += [(event.progress.batchId, name, row["n"]) for name, row in event.progress.observedMetrics.items()]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
