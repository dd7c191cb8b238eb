"""Listing of an object tree in tasks, and its update (MIG-1)."""

import os
import time

from lodestone.operators import backfill
from lodestone.sources import inventory
from tests.conftest import rows


def put(root, key, text="x"):
    p = os.path.join(root, key)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)


KEYS = ["a/2026-04-08 08:00:00/metal_prices.json", "a/2026-04-08 08:00:00/b/c.json", "a/é x%20y/z.json", "top.json"]


def objects(df):
    return {r["path"]: (r["size"], r["listed"]) for r in df.where("NOT is_dir").collect()}


def test_all_objects_of_a_tree(spark, tmp_dir):
    """Names with colons, blanks, percent signs; empty folders; objects beside folders."""
    for k, key in enumerate(KEYS):
        put(tmp_dir, key, "x" * k)
    os.makedirs(os.path.join(tmp_dir, "empty/inner"))
    for root in (tmp_dir, tmp_dir + "/", "file://" + tmp_dir):
        assert objects(inventory.inventory(spark, root)) == {f"{tmp_dir}/{key}": (k, True) for k, key in enumerate(KEYS)}
    assert inventory.inventory(spark, tmp_dir + "/nothing").count() == 0


def test_update_lists_only_what_changed(spark, tmp_dir):
    for k in range(200):
        put(tmp_dir, f"p{k % 20}/q{k % 3}/o{k}")
    first = inventory.inventory(spark, tmp_dir)
    time.sleep(0.01)
    put(tmp_dir, "p3/q1/new")
    put(tmp_dir, "p4/new/deep/one")
    os.remove(os.path.join(tmp_dir, "p5/q2/o5"))
    now = inventory.inventory(spark, tmp_dir, previous=first)
    want = {os.path.join(d, f) for d, _, fs in os.walk(tmp_dir) for f in fs}
    got = objects(now)
    assert set(got) == want
    again = {os.path.dirname(p)[len(tmp_dir) + 1:] for p, (_, listed) in got.items() if listed}
    assert again == {"p3/q1", "p4/new/deep", "p5/q2"}
    third = objects(inventory.inventory(spark, tmp_dir, previous=now))  # an update of an update
    assert set(third) == want and not any(listed for _, listed in third.values())


def test_contents_in_bounded_batches(spark, tmp_dir):
    for k in range(30):
        put(tmp_dir, f"d/o{k}", str(k) * 100)
    found = inventory.inventory(spark, tmp_dir).where("NOT is_dir")
    got = {r["path"]: bytes(r["content"]) for r in inventory.contents(tmp_dir, found, max_bytes=150).collect()}
    assert got == {f"{tmp_dir}/d/o{k}": (str(k) * 100).encode() for k in range(30)}


def test_listing_of_the_old_layout(spark, tmp_dir):
    """Keys relative to the root, hidden names left out, contents as text."""
    put(tmp_dir, "bronze/2026-04-08 08:00:00/metal_prices-2026-04-08 08:00:00.json", '{"v": "é"}')
    put(tmp_dir, "bronze/2026-04-08 08:00:00/_SUCCESS")
    put(tmp_dir, "bronze/.tmp/metal_prices.json")
    with open(os.path.join(tmp_dir, "bronze/2026-04-08 08:00:00/fred_data.json"), "wb") as f:
        f.write(b"\xff\xfe")
    got = rows(backfill.list_objects(spark, tmp_dir, "bronze", with_content=True), "layer", "old_key", "content")
    assert got == [("bronze", "bronze/2026-04-08 08:00:00/fred_data.json", None),
                   ("bronze", "bronze/2026-04-08 08:00:00/metal_prices-2026-04-08 08:00:00.json", '{"v": "é"}')]
    assert rows(backfill.list_objects(spark, tmp_dir, "bronze"), "old_key") == [(k,) for _, k, _ in got]


def test_backfill_of_keys_with_colons(spark, tmp_dir):
    """Bronze objects move; a Parquet file that Spark cannot be given by name is failed, not lost."""
    put(tmp_dir, "bronze/2026-04-08 08:00:00/metal_prices-2026-04-08 08:00:00.json", '{"v": 1}')
    put(tmp_dir, "silver/2026-04-08 08:00:00/news_data-2026-04-08 08:00:00.parquet")
    man = backfill.run_backfill(spark, tmp_dir, os.path.join(tmp_dir, "out"))
    assert rows(man, "layer", "outcome") == [("bronze", "migrated"), ("silver", "failed")]
    assert spark.read.text(os.path.join(tmp_dir, "out/bronze/metal")).first()["value"] == '{"v":1}'
