"""Back-fill of the old object layout into day partitions (MIG-1..10).

Old key:  ``bronze/2026-04-08 08:00:00/metal_prices-2026-04-08 08:00:00.json``
New key:  ``bronze/metal/ingested_at=2026-04-08`` (the day's folder; Spark names the files in it)

The reference walks a listing one object at a time. Here the listing is a
DataFrame (``layer``, ``old_key`` and, for bronze, the ``content`` text) and
every decision is a column: classify, extract the day, build the new key,
pick the winner per new key, count. Files are then written in parallel by
``run_backfill``. Nothing is deleted: the delete candidates are a table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import config
from lodestone.sources import inventory

PARTITION = config.PARTITION_MARKER.rstrip("=")
OUTCOMES = ("migrated", "failed", "unclassified", "already_partitioned", "folder", "not_parquet")


def classify_feed(key: Column) -> Column:
    """MIG-3: first matching name in the fixed order; null when none matches."""
    expr = None
    for feed, patterns in config.FEED_PATTERNS:
        cond = None
        for p in patterns:
            c = key.contains(p)
            cond = c if cond is None else cond | c
        expr = F.when(cond, F.lit(feed)) if expr is None else expr.when(cond, F.lit(feed))
    return expr


def extract_day(key: Column) -> Column:
    """MIG-4: second path segment, text before the first blank; null when the
    key has no second segment or that text is empty. Not checked to be a date
    (as in the reference); ``day_is_date`` in the manifest tells."""
    seg = F.when(F.size(F.split(key, "/")) >= 2, F.split(key, "/").getItem(1))
    day = F.split(seg, " ").getItem(0)
    return F.when(F.length(day) > 0, day)


def classify(listing: DataFrame) -> DataFrame:
    """MIG-2..6: one row per listed object with its feed, day, outcome and,
    when migrated, the new key. Narrow: no shuffle."""
    key, layer = F.col("old_key"), F.col("layer")
    feed = classify_feed(key)
    day = extract_day(key)
    bad_content = F.lit(False)
    if "content" in listing.columns:
        # MIG-6: bronze content must parse as JSON (any value, as json.loads).
        bad_content = (layer == "bronze") & F.try_parse_json(F.col("content")).isNull()
    outcome = (F.when(key.contains(config.PARTITION_MARKER), F.lit("already_partitioned"))
               .when(key.endswith("/"), F.lit("folder"))
               .when((layer == "silver") & ~key.endswith(".parquet"), F.lit("not_parquet"))
               .when(feed.isNull(), F.lit("unclassified"))
               .when(day.isNull(), F.lit("failed"))
               .when(bad_content, F.lit("failed"))
               .otherwise(F.lit("migrated")))
    m = listing.select(
        layer.alias("layer"), key.alias("old_key"), feed.alias("feed"), day.alias("ingest_day"),
        day.try_cast("date").isNotNull().alias("day_is_date"), outcome.alias("outcome"),
        *([F.col("content")] if "content" in listing.columns else []))
    new_key = F.when(F.col("outcome") == "migrated", F.concat_ws(
        "/", "layer", "feed", F.concat(F.lit(config.PARTITION_MARKER), F.col("ingest_day"))))
    return m.withColumn("new_key", new_key)


def manifest(listing: DataFrame) -> DataFrame:
    """MIG-8 on top of ``classify``: whether each migrated object is the winner
    of its new key (the greatest old key among the migrated ones: listing
    order, last write wins)."""
    from lodestone.operators.joins import bounded
    from lodestone.session import materialize

    # Contents are judged once; only keys go on.
    m = materialize(classify(listing).drop("content"))
    # Conditional max instead of a filter first: a filter on ``outcome`` would be
    # pushed to the scan and re-compute the whole classification there.
    # ``new_key`` is null exactly when the object is not migrated.
    winners = (m.groupBy("new_key")
               .agg(F.max(F.when(F.col("outcome") == "migrated", F.col("old_key"))).alias("winner_key"))
               .where(F.col("new_key").isNotNull()))
    # One row per new key (feeds x days x layers): measured, then broadcast, so
    # the listing is not shuffled on new_key (null for every skipped object).
    w, small = bounded(winners)
    w = F.broadcast(w) if small else w
    return (m.join(w, "new_key", "left")
            .withColumn("is_winner", F.coalesce(F.col("winner_key") == F.col("old_key"), F.lit(False)))
            .drop("winner_key"))


def summary(man: DataFrame, complete_layers: DataFrame | None = None) -> DataFrame:
    """MIG-10 / AGG-3: counts per layer and the deletion gate. ``ok_to_delete``
    needs no failure, no unclassified object, something migrated, and a
    complete listing of the layer (T-20)."""
    agg = man.groupBy("layer").agg(
        F.count("*").alias("n_listed"),
        *[F.sum(F.when(F.col("outcome") == o, 1).otherwise(0)).cast("bigint").alias(f"n_{o}") for o in OUTCOMES])
    if complete_layers is not None:
        agg = agg.join(complete_layers, "layer", "left")
    else:
        agg = agg.withColumn("listing_complete", F.lit(True))
    return agg.withColumn("ok_to_delete", (F.col("n_failed") == 0) & (F.col("n_unclassified") == 0)
                          & (F.col("n_migrated") > 0) & F.coalesce(F.col("listing_complete"), F.lit(False)))


def delete_candidates(man: DataFrame) -> DataFrame:
    """MIG-9: only objects that were actually migrated (T-12), never deleted here."""
    return man.where(F.col("outcome") == "migrated").select("layer", "old_key", "new_key")


def list_objects(spark: SparkSession, root: str, layer: str, with_content: bool = False,
                 previous: DataFrame | None = None) -> DataFrame:
    """MIG-1: the objects of ``<root>/<layer>`` with keys relative to ``root``,
    listed in tasks (``sources.inventory``; ``previous`` is an earlier inventory of
    the layer to bring up to date). With content, tasks read each object as
    text (null where it is not UTF-8). Names that begin with ``_`` or ``.``
    are not objects of the layout."""
    base = root.rstrip("/")
    found = inventory.inventory(spark, f"{base}/{layer}", previous).where("NOT is_dir")
    key = F.substring("path", F.lit(len(inventory.store(base)[1]) + 2), F.length("path"))
    found = found.withColumn("old_key", key).where(~F.col("old_key").rlike("(^|/)[_.]"))
    if with_content:
        texts = inventory.contents(base, found).withColumn("old_key", key)
        text = F.col("content").cast("string")
        return texts.select(F.lit(layer).alias("layer"), "old_key", F.when(F.is_valid_utf8(text), text).alias("content"), "path")
    return found.select(F.lit(layer).alias("layer"), "old_key", "path")


def relative_key(path: Column, base: str) -> Column:
    """``file:///r/bronze/a b.json`` -> ``bronze/a b.json`` for ``base='/r'`` (or its URI)."""
    local = F.url_decode(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/"))
    prefix = "/" + inventory.store(base)[1].strip("/") + "/"
    return F.when(local.startswith(prefix), F.substring(local, F.lit(len(prefix) + 1), F.length(local)))


def listing_complete(spark: SparkSession, root: str, man: DataFrame) -> DataFrame:
    """(layer, listing_complete): whether every object that is in the old
    layout now is in the manifest (T-20)."""
    found = None
    for layer in ("bronze", "silver"):
        now = list_objects(spark, root, layer).select("layer", "old_key").where(~F.col("old_key").contains(config.PARTITION_MARKER))
        missing = now.join(man.select("old_key"), "old_key", "left_anti").agg(F.count("*").alias("n"))
        one = missing.select(F.lit(layer).alias("layer"), (F.col("n") == 0).alias("listing_complete"))
        found = one if found is None else found.unionByName(one)
    return found


def _winners(man: DataFrame, feed: str) -> DataFrame:
    """(old_key, ingest_day) of the objects that win a day of the feed: one per day at most, so as many as the calendar has days."""
    return man.where(F.col("is_winner") & (F.col("feed") == feed)).select("old_key", "ingest_day")


# --------------------------------------------------------------------------
# Reconciliation (MIG-6, MIG-7): every winner is proven by itself. Counts and
# content sums are per day folder, which is per winner, since a folder has one.

LEDGER = ("layer string, feed string, ingest_day string, n_expected bigint, n_read bigint, n_written bigint, "
          "content_read decimal(38,0), content_written decimal(38,0)")


def _content(columns: list[str]) -> Column:
    """Order-free sum of row hashes over ``columns`` (by name, so that files
    with other column orders or further columns agree)."""
    return F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(columns)]).cast("decimal(38,0)"))


FILE = "_lodestone_file"


def files_of(spark: SparkSession, paths: list[str], root: str) -> DataFrame:
    """(FILE, ingest_day, n) of old silver files, with their rows as the Parquet footers
    say: no column is read, so Spark takes the row counts of the row groups.
    Files without a readable footer have no row here. It is stored, one row a file, before the day is
    taken from the name: a filter on the day would else be pushed to
    the scan, and take the name of the file apart for every row."""
    from lodestone.session import materialize

    files = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(*paths)
    per_file = materialize(files.select(F.col("_metadata.file_path").alias(FILE)).groupBy(FILE).agg(F.count("*").alias("n")))
    return per_file.select(FILE, extract_day(relative_key(F.col(FILE), root)).alias("ingest_day"), "n")


def expected_rows(files: DataFrame) -> DataFrame:
    """(ingest_day, n_expected) of ``files_of``."""
    return files.groupBy("ingest_day").agg(F.sum("n").alias("n_expected"))


def _by_day(rows: DataFrame, day: str, columns: list[str], n: str, content: str) -> DataFrame:
    return rows.groupBy(F.col(day).cast("string").alias("ingest_day")).agg(F.count("*").alias(n), _content(columns).alias(content))


def silver_rows(spark: SparkSession, paths: list[str], files: DataFrame, tolerant: bool) -> DataFrame:
    """The rows of some old silver files with their new partition (by ``files_of``), columns
    merged. ``tolerant`` gives up a damaged file where its damage begins;
    otherwise it fails the job. Pages that carry a checksum are held against it
    as they are read: damage that still decompresses would else be
    found by whoever decodes the values, beyond the reader's tolerance, or not at all."""
    rows = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").option("parquet.page.verify-checksum.enabled", "true") \
        .option("ignoreCorruptFiles", str(tolerant).lower()).parquet(*paths)
    days = files.select(FILE, F.col("ingest_day").alias(PARTITION))  # as many as the calendar has days
    return rows.withColumn(FILE, F.col("_metadata.file_path")).join(F.broadcast(days), FILE).drop(FILE)


def bronze_rows(winners: DataFrame, root: str) -> DataFrame:
    """The documents of some old bronze objects (old_key), one line each."""
    base = inventory.store(root)[1]
    texts = inventory.contents(root, winners.select(F.concat(F.lit(base + "/"), "old_key").alias("path")))
    key = F.substring("path", F.lit(len(base) + 2), F.length("path"))
    return texts.select(F.to_json(F.try_parse_json(F.col("content").cast("string"))).alias("value"), extract_day(key).alias(PARTITION))


def _write_days(rows: DataFrame, target: str, layer: str) -> None:
    writer = rows.hint("rebalance", PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION)
    writer.text(target) if layer == "bronze" else writer.parquet(target)


def move_feed(spark: SparkSession, man: DataFrame, root: str, out: str, layer: str, feed: str) -> DataFrame | None:
    """Write the winners of one feed and layer and return their ledger
    (None: the feed has no winner).

    Silver: footers give the expected rows; every column of every row is then
    read once, tolerating damage, for count and content sum. Only files that
    give all their rows are written, by a read that tolerates nothing, so a
    half-damaged file publishes no half day. Bronze: one document per file.
    Last, the written days are read back. The write replaces whole
    day folders, so what stands in a written day is of this run; days that
    were not written are not looked at, whatever an earlier run left there."""
    from lodestone.session import materialize

    target = f"{out}/{layer}/{feed}"
    winners = materialize(_winners(man, feed))
    days = winners.select("ingest_day")
    keys = {r["ingest_day"]: r["old_key"] for r in winners.collect()}
    if not keys:
        return None
    # Spark's file readers take no colon in a name: such Parquet files are not read, and so not proven
    paths = {d: f"{root}/{k}" for d, k in keys.items() if ":" not in k}
    rows, columns, read = None, ["value"], days
    if layer == "bronze":
        rows = bronze_rows(winners, root)
        read = days.withColumn("n_expected", F.lit(1).cast("bigint"))
    elif paths:
        try:
            files = files_of(spark, sorted(paths.values()), root)
            rows = silver_rows(spark, sorted(paths.values()), files, tolerant=True)
            columns = [c for c in rows.columns if c != PARTITION]
            read = days.join(expected_rows(files), "ingest_day", "left")
        except AnalysisException:  # not one of the files has a readable schema
            rows = None
    if rows is None:
        return days.select(F.lit(layer).alias("layer"), F.lit(feed).alias("feed"), "ingest_day", *[
            F.lit(None).cast(t).alias(c) for c, t in (part.split(" ") for part in LEDGER.split(", ")[3:])])
    read = materialize(read.join(_by_day(rows, PARTITION, columns, "n_read", "content_read"), "ingest_day", "left"))
    whole = sorted(r["ingest_day"] for r in read.where("n_read = n_expected AND n_expected > 0").select("ingest_day").collect())
    written = read.select("ingest_day", F.lit(None).cast("bigint").alias("n_written"), F.lit(None).cast("decimal(38,0)").alias("content_written")).limit(0)
    if whole:
        _write_days(bronze_rows(winners.where(F.col("ingest_day").isin(whole)), root) if layer == "bronze"
                    else silver_rows(spark, [paths[d] for d in whole], files, tolerant=False), target, layer)
        back = spark.read.schema(rows.schema)  # the partition stays text
        back = (back.text(target) if layer == "bronze" else back.parquet(target)).where(F.col(PARTITION).isin(whole))
        written = materialize(_by_day(back, PARTITION, columns, "n_written", "content_written"))
    return read.join(written, "ingest_day", "left").select(
        F.lit(layer).alias("layer"), F.lit(feed).alias("feed"), "ingest_day", "n_expected", "n_read", "n_written", "content_read", "content_written")


def proven(ledger: DataFrame) -> DataFrame:
    """The ledger with ``is_proven``: as many rows as the file's footer says
    (bronze: one document) were read and stand in the new folder, with the same content."""
    same = (F.col("n_expected") == F.col("n_read")) & (F.col("n_read") == F.col("n_written")) & (F.col("content_read") == F.col("content_written"))
    return ledger.withColumn("is_proven", F.coalesce(same, F.lit(False)))


def _checked(man: DataFrame, ledger: DataFrame) -> DataFrame:
    """Migrated objects whose winner is not proven are failed: they all rest on it."""
    done = proven(ledger).where("is_proven").select(F.concat_ws("/", "layer", "feed", F.concat(F.lit(config.PARTITION_MARKER), "ingest_day")).alias("_folder"))
    m = man.join(done, man["new_key"] == done["_folder"], "left")
    lost = (F.col("outcome") == "migrated") & F.col("_folder").isNull()
    return m.withColumns({"outcome": F.when(lost, F.lit("failed")).otherwise(F.col("outcome")),
                          "new_key": F.when(lost, F.lit(None)).otherwise(F.col("new_key")),
                          "is_winner": F.col("is_winner") & ~lost}).drop("_folder")


def run_backfill(spark: SparkSession, root: str, out_root: str | None = None) -> DataFrame:
    """MIG-6/7: ``backfill_ledger``'s manifest."""
    return backfill_ledger(spark, root, out_root)[0]


def backfill_ledger(spark: SparkSession, root: str, out_root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write every winner into the new layout under ``out_root`` (default
    ``root``) and return the manifest and the ledger (LEDGER, ``is_proven``).

    The manifest alone decides what is moved: one distributed read and write per feed and
    layer (the four feeds are a fixed list). Bronze documents are written as
    one line each. Silver files keep all their columns (schemas of a feed's
    files are merged). A winner that cannot be read, is damaged part way, has no row, or
    does not stand whole in its new folder, does not stop the others; every
    object that counts on it is reported as failed, which keeps the deletion gate shut."""
    from lodestone.session import materialize

    root, out = root.rstrip("/"), (out_root or root).rstrip("/")
    # The manifests are materialised first: the job writes below the folders
    # it lists, and every later read must see the same listing.
    manifests = {"bronze": materialize(manifest(list_objects(spark, root, "bronze", with_content=True).drop("path"))),
                 "silver": materialize(manifest(list_objects(spark, root, "silver").drop("path")))}
    ledger = spark.createDataFrame([], LEDGER)
    result = None
    for layer, man in manifests.items():
        for feed in config.FEEDS:
            moved = move_feed(spark, man, root, out, layer, feed)
            ledger = ledger if moved is None else ledger.unionByName(moved)
        done = materialize(_checked(man, ledger.where(F.col("layer") == layer)))
        result = done if result is None else result.unionByName(done)
    return result, materialize(proven(ledger))
