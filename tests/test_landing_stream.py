"""Landing by document as a stream with state (SRC-14, SRC-15), and counters (FLT-7, FLT-9)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lodestone.operators import validate
from lodestone.plans import daily
from lodestone.streaming import landing
from tests.conftest import rows


def doc(day, value, note=""):
    return json.dumps({"DGS10": {"units": "lin", "observations": [{"date": day, "value": value}], "note": note}})


def deliver(root, day, name, docs):
    p = os.path.join(root, "bronze/fred", f"ingested_at={day}", name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write("\n".join(docs) + "\n")


def run(spark, root):
    landing.start_document_landing(spark, f"{root}/bronze", f"{root}/silver", "fred", f"{root}/ckpt", complete=False).awaitTermination()
    return rows(landing.read_landed(spark, f"{root}/silver", "fred"), "ingested_at", "observation_values")


def test_documents_land_once_over_three_triggers(spark, tmp_dir):
    deliver(tmp_dir, "2026-04-07", "a.txt", [doc("2026-04-07", "1.5"), doc("2026-04-07", "-3"), "{broken", ""])
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5)]
    deliver(tmp_dir, "2026-04-07", "again.txt", [doc("2026-04-07", "1.5"), doc("2026-04-07", "2.5")])  # one of them came before
    deliver(tmp_dir, "2026-04-08", "b.txt", [doc("2026-04-07", "1.5")])  # the same text of another day is another document
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5), ("2026-04-07", 2.5), ("2026-04-08", 1.5)]
    deliver(tmp_dir, "2026-04-08", "c.txt", [doc("2026-04-07", "1.5")])
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5), ("2026-04-07", 2.5), ("2026-04-08", 1.5)]
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5), ("2026-04-07", 2.5), ("2026-04-08", 1.5)]  # nothing new
    rejects = spark.read.parquet(f"{tmp_dir}/silver/_rejects/fred")
    assert rows(rejects, "level", "reject_reasons") == [("document", "not_json"), ("row", "VAL-11")]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_dir, monkeypatch):
    """The first run of the batch dies after its rows are written; the stream runs it again."""
    deliver(tmp_dir, "2026-04-07", "a.txt", [doc("2026-04-07", "1.5"), doc("2026-04-07", "2.5")])
    write = landing.write_batch

    def dies(*a):
        write(*a)
        raise RuntimeError("lost")
    monkeypatch.setattr(landing, "write_batch", dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_dir)
    monkeypatch.undo()
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5), ("2026-04-07", 2.5)]


def test_counters_of_a_stream(spark, tmp_dir):
    deliver(tmp_dir, "2026-04-07", "a.txt", [doc("2026-04-07", "1.5")] * 3 + [doc("2026-04-07", "2.5")])
    counters = landing.Counters()
    spark.streams.addListener(counters)
    run(spark, tmp_dir)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(counters)
    assert {(name, n) for _, name, n in counters.rows if n} == {("delivered", 4), ("documents", 2)}


def test_counters_of_a_landing(spark, tmp_dir):
    raw = spark.createDataFrame([("gold", n, "ok", "2026-04-08T01:00:00", "2026-04-08") for n in ("1", "2", "x")],
                                "keywords string, total_mentions string, status string, news_timestamp string, ingested_at string")
    checked = {"news": validate.check(raw, "news"), "fred": validate.check(spark.createDataFrame(
        [("DGS10", "x", "-1", "lin", "2026-04-08")], "series_id string, observation_date string, observation_values string, units string, ingested_at string"), "fred")}
    assert rows(daily.land_feeds(checked, tmp_dir)) == [("fred", 0, 1, True), ("news", 2, 1, False)]
    assert rows(spark.read.parquet(f"{tmp_dir}/news"), "total_mentions") == [(1,), (2,)]
    assert rows(daily.land_feeds({"news": checked["news"].where(F.lit(False))}, tmp_dir)) == [("news", 0, 0, True)]


def test_a_batch_has_few_files_and_its_state_is_on_disk(spark, tmp_dir):
    """Tasks of the stream do not each write a file in every day, and the names of documents are not held in the heap."""
    days = [f"2026-04-{k:02d}" for k in range(1, 9)]
    for day in days:
        deliver(tmp_dir, day, "a.txt", [doc(day, str(k + 1)) for k in range(50)] + ["{broken"])
    assert len(run(spark, tmp_dir)) == 8 * 50
    for table in ("fred", "_rejects/fred"):
        for day in days:
            found = [f for _, _, files in os.walk(os.path.join(tmp_dir, "silver", table, f"ingested_at={day}")) for f in files if f.endswith(".parquet")]
            assert len(found) == 1
    state = [f for _, _, files in os.walk(os.path.join(tmp_dir, "ckpt", "state")) for f in files]
    assert any(f.endswith(".zip") for f in state)
    assert spark.conf.get(landing.PROVIDER, None) is None  # the session's own setting is as it was


def test_a_local_checkpoint_is_written_without_processes(spark, tmp_dir, monkeypatch):
    """Hadoop's FileContext starts processes for every rename in a local folder; the stream's session names
    the FileSystem's manager there. Elsewhere, and if the session names one, nothing is set."""
    deliver(tmp_dir, "2026-04-07", "a.txt", [doc("2026-04-07", "1.5")])
    write, seen = landing.write_batch, []

    def notes(docs, *a):
        seen.append(docs.sparkSession.conf.get("spark.sql.streaming.checkpointFileManagerClass", None))
        write(docs, *a)
    monkeypatch.setattr(landing, "write_batch", notes)
    assert run(spark, tmp_dir) == [("2026-04-07", 1.5)]
    assert seen and all(c and c.endswith(".FileSystemBasedCheckpointFileManager") for c in seen)
    assert spark.conf.get(landing.FILES, None) is None
    monkeypatch.setattr(landing, "_is_local", lambda spark, path: False)
    with landing.state_on_disk(spark, "/ckpt"):
        assert spark.conf.get(landing.FILES, None) is None
    monkeypatch.undo()
    spark.conf.set(landing.FILES, "mine")
    try:
        with landing.state_on_disk(spark, "/ckpt"):
            assert spark.conf.get(landing.FILES) == "mine"
    finally:
        spark.conf.unset(landing.FILES)
