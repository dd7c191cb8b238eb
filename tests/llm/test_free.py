"""Classifier, decontamination, LM scoring, near dedup and suffix dedup."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import blocks, decontaminate, lm_scoring, near_dedup, quality_classifier, suffix_dedup
from lodestone.llm.common import pieces, remainder
from tests.llm import brute
from tests.llm.conftest import edge_rows, got, make, prose

DOCS = [(i, t) for i, t, _ in edge_rows()]


# ------------------------------------------------------------- classifier

def labelled(spark, n=150):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(prose(1000 * i + k, 60) for k in range(3))
        if bad:  # one bad passage in a longer text
            text += " " + " ".join(w + "###" for w in prose(i, 70).split())
        rows.append((i, text, "s"))
        labels.append((i, int(not bad), 0, "x"))
    return make(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.train(docs, labels)
    out = {r["doc_id"]: r["__p"] for r in quality_classifier.score(docs, model, "__p").collect()}
    held = [i for i in out if brute.mod(i, 3) == 1]
    assert len(held) > 20 and np.mean([(out[i] >= 0.5) == (i % 4 != 0) for i in held]) >= 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark, 60)
    turned = labels.withColumn("quality", F.when(remainder(F.col("doc_id"), 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality_classifier.train(docs, x) for x in (labels, turned))
    assert all((one[k] == two[k]).all() for k in one)


def test_fit_takes_even_passages_of_long_texts():
    """The bags that tasks send are those of whole texts, cut to FIT_PASSAGES."""
    long = " ".join(prose(k, 64) for k in range(100))
    table = pa.table({"key": [1, 2], "id": ["1", "2"], "y": [0.0, 1.0], "hash": [1, 2], "text": [long, None]})
    bags = [b for r in quality_classifier._bags(iter(table.to_batches())) for b in r.column("x").to_pylist()]
    whole, _ = quality_classifier.Encoder().encode([long])
    assert len(whole) == 100 and len(bags[1]) == 4 * quality_classifier.FEATURES
    assert bags[0] == whole[np.linspace(0, 99, quality_classifier.FIT_PASSAGES).astype(int)].tobytes()


def test_fit_learns_whole_bags_up_to_a_budget(spark, monkeypatch):
    docs = make(spark, [(i, prose(i, 64 * (100 if i % 2 else 3)), "s") for i in range(20)])
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(20)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda x, starts, y: seen.append(np.diff([*starts, len(x)]).tolist()) or {})
    quality_classifier.train(docs, labels)
    assert sorted(seen[0]) == sorted(100 if i % 2 else 3 for i in range(20) if brute.mod(i, 3) != 1)
    quality_classifier.train(docs, labels, budget=250)  # a prefix of whole rows
    assert seen[1] == seen[0][:len(seen[1])] and sum(seen[1]) >= 250 > sum(seen[1][:-1])


def test_pieces_are_bounded_and_whole():
    batch = pa.record_batch({"i": list(range(8)), "text": ["a" * 5, None, "", "b" * 50, "c", "d" * 9, "e" * 9, "f"]})
    got_ = [p.column(0).to_pylist() for p in pieces(batch, 1, rows=3, size=10)]
    assert got_ == [[0, 1, 2], [3], [4, 5], [6, 7]]
    assert list(pieces(batch.slice(0, 0), 1, rows=3)) == []


def test_scores_of_odd_rows(spark, edges):
    docs, labels = labelled(spark, 60)
    model = quality_classifier.train(docs, labels)
    out = quality_classifier.score(edges, model, "__p")
    assert out.columns == [*edges.columns, "__p"] and all(0 <= r["__p"] <= 1 for r in out.collect())
    assert out.count() == len(DOCS)
    by = {r["doc_id"]: r["__p"] for r in out.collect()}
    assert by[4] == by[5]


def test_labels_of_one_class_or_none(spark, edges):
    some = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert quality_classifier.train(edges, some.limit(0)) == 0.5
    assert quality_classifier.train(edges, some) in (0.5, 1.0)


def test_gradient_of_the_attention_model():
    """The fit lowers the loss of a bag problem that no single mean solves."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality_classifier.FEATURES))
    starts, y = np.arange(0, 400, 4), np.arange(100) % 2
    x[starts[y == 1] + 2, 0] += 8
    m = quality_classifier.fit(x, starts, y.astype(float), epochs=40)
    f = quality_classifier.forward(m, x, starts)
    assert ((f["p"] >= 0.5) == (y == 1)).mean() > 0.95
    assert np.allclose(np.add.reduceat(f["a"], starts), 1)


# ------------------------------------------------------------- decontamination

ITEMS = [(1, prose(2, 40)), (2, "one two"), (3, None), (4, ""), (5, "漢字"), (6, prose(2, 40)), (None, "same"), (7, "same same"), (8, prose(77, 30))]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, row string")


def test_contamination_matches_brute_force(edges, items):
    want = brute.contaminated(DOCS, [x for x in ITEMS if x[0] is not None])
    assert got(decontaminate.op4(edges, items)) == sorted(want, key=repr)


def test_small_shards_and_parts_of_the_test_set(edges, items):
    whole = {r[:2] + r[5:] for r in got(decontaminate.op4(edges, items))}
    parts = decontaminate.decontaminate(edges.select("doc_id", "text"), items, max_test_bytes=100).drop("row")
    assert {(r[0], r[1], r[5]) for r in got(parts)} == whole


def test_parts_of_the_test_set_change_no_result(spark, edges, items):
    again = spark.createDataFrame([(9, "ab cd"), (9, "cd ef"), (10, "cd")], "item_id long, text string")
    tests = items.select("item_id", "text").unionByName(again)
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame([(900, "ab cd ef"), (900, "ab cd ef"), (901, "x ab cd")], "doc_id long, text string"))
    parts = decontaminate.decontaminate(docs, tests, max_test_bytes=20).drop("row")
    assert got(parts) == got(decontaminate.op4(docs, tests))
    assert got(parts.where("doc_id >= 900"), "doc_id", "n_hit", "n_items") == [(900, 3, 2), (900, 3, 2), (901, 2, 2)]


def test_index_without_vocabulary_gives_the_same_matches(edges, items):
    docs = edges.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    test = [(str(i), t) for i, t in ITEMS if i is not None]
    words = {w for _, t in test for w in decontaminate.tokens(t)}
    one = decontaminate.search(decontaminate.build_index(docs, None, shard_bytes=500), test)
    two = decontaminate.search(decontaminate.build_index(docs, words), test)
    cols = ("doc_id", "item_id", "start", "stop", "kind")
    assert got(one, *cols) == got(two, *cols) and one.count() > 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(0, 1, "red x green y blue"), (1, 2, "blue green red"), (2, 3, "red x x x x green blue"), (3, 4, "red green"), (4, 5, "red green blue")],
                                 "row long, doc_id long, text string")
    found = decontaminate.search(decontaminate.build_index(docs), [("q", "Red green BLUE")], slop=2)
    assert got(found, "doc_id", "start", "stop", "kind") == [(1, 0, 5, "near"), (2, 0, 3, "near"), (5, 0, 3, "phrase")]


# ------------------------------------------------------------- LM scoring

def test_base_scores_match_brute_force(edges):
    tok = {}
    for i, t in DOCS:
        tok.setdefault((i, t), [*(t or "").encode().lower().split(), b" end"])
    count, train = Counter(), 0
    for i, t in DOCS:
        if brute.mod(i, 7) != 2:
            count.update(tok[(i, t)])
            train += len(tok[(i, t)])
    base = lambda ws: sum(math.log10((count[w] + 1) / (train + len(count) + 1)) for w in ws)
    want = sorted(((i, brute.mod(i, 7) == 2, len(tok[(i, t)]), sum(count[w] > 0 for w in tok[(i, t)]), train, round(base(tok[(i, t)]), 6)) for i, t in DOCS), key=repr)
    out = lm_scoring.op5(edges).withColumn("base_score", F.round("base_score", 6))
    assert got(out, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == want
    assert all(r["score"] < 0 for r in out.collect())


def test_model_beats_unigrams_on_held_out_text(spark):
    rng = random.Random(5)
    step = {w: [f"w{rng.randrange(60)}" for _ in range(3)] for w in (f"w{k}" for k in range(60))}

    def text(seed):
        r, out = random.Random(seed), ["w0"]
        for _ in range(80):
            out.append(r.choice(step[out[-1]]))
        return " ".join(out)
    out = lm_scoring.op5(make(spark, [(i, text(i), "s") for i in range(200)])).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 0.6 * out[1]


def test_lm_blocks_agree(edges):
    docs = edges.select("doc_id", "text")
    held = remainder(F.col("doc_id"), 7) == 2
    one, two = (got(lm_scoring.score(docs, held, b).select("doc_id", "n_known", F.round("score", 6).alias("s"))) for b in (1 << 20, 2000))
    assert one == two


def test_mixture_weights_sum_to_one():
    m = lm_scoring.learn(np.array([5 * lm_scoring.RATIOS * lm_scoring.COUNTS + 9 * lm_scoring.COUNTS + 30]), np.array([100.0]), 1000, 50)
    assert np.allclose(m.sum(1), 1) and m[5, 0] > 0.5


# ------------------------------------------------------------- near dedup

def test_near_classes_match_brute_force(edges):
    assert got(near_dedup.op6(edges)) == sorted(brute.near(DOCS), key=repr)


def edited(base, seed, n):
    r, w = random.Random(seed), base.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
    return " ".join(w)


def test_chains_and_large_groups(spark, monkeypatch):
    base = prose(9, 150)
    rows = [(i, edited(base, i, i % 9), "s") for i in range(120)]
    chain = prose(10, 150)
    for k in range(30):  # each is near the one before, the ends are far apart
        chain = edited(chain, 500 + k, 2)
        rows.append((1000 - k, chain, "s"))
    rows += [(2000 + k, prose(600 + k, 100), "s") for k in range(30)] + [(3000 + k, base, "s") for k in range(5)]
    want = sorted(brute.near([(i, t) for i, t, _ in rows]), key=repr)
    assert got(near_dedup.op6(make(spark, rows))) == want
    # small limits take the ways of large nodes: chunks, dense nodes, deeper levels
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    assert got(near_dedup.op6(make(spark, rows))) == want


def test_pairs_in_large_families_meet_at_the_last_level(spark, monkeypatch):
    """Isolated pairs at 0.8 (80 of 100 words), 20 in each of 40 families of mean similarity 0.45, all sent down to the last level."""
    rows = []
    for i in range(800):
        both = [f"c{i % 40}x{k}" for k in range(56)] + [f"b{i}x{k}" for k in range(24)]
        rows += [(2 * i + h, " ".join(both + [f"u{i}x{h}x{k}" for k in range(10)]), "s") for h in (0, 1)]
    monkeypatch.setattr(near_dedup, "SMALL", 0)
    monkeypatch.setattr(near_dedup, "_dense", lambda rows, table: rows.select("node").limit(0))
    docs = make(spark, rows)
    vertices = near_dedup.sets_of(docs, 1).select("set", "sketch", F.col("doc_id").alias("doc"), F.col("doc_id").alias("vid"))
    now, deeper = near_dedup.first_nodes(vertices.select("vid", "sketch"))
    then = near_dedup.nodes(vertices, deeper, spark.createDataFrame([], "vid long, comp long"), docs, 1)
    met = now.unionByName(then).distinct().groupBy("node", F.expr("vid div 2").alias("pair")).count().where("count = 2")
    assert met.select("pair").distinct().count() == 800


def test_nodes_of_one_component_are_dropped_before_they_are_stored(spark):
    """A large group of near copies, joined by the first wave, is in no node of the second."""
    base = prose(21, 200)
    docs = make(spark, [(i, edited(base, i, 1), "s") for i in range(300)] + [(1000 + i, prose(700 + i, 50), "s") for i in range(20)])
    vertices = near_dedup.sets_of(docs, 4).select("set", "sketch", F.col("doc_id").alias("doc"), F.col("doc_id").alias("vid")).cache()
    table = vertices.select("vid", "sketch")
    now, deeper = near_dedup.first_nodes(table)
    _, comp = near_dedup._linked(now, table, None, None, docs, vertices, 4, 80)
    assert comp.where("vid < 300").select("comp").distinct().count() == 1 and comp.where("vid < 300").count() == 300
    assert near_dedup.nodes(vertices, deeper, comp, docs, 4).count() == 0


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_miss_chance_of_a_pair_at_the_threshold(rounds):
    """All errors counted: trees, both sketches, the screen of the comparison; at most 5 in a million."""
    n, same = near_dedup.COORDS, np.arange(near_dedup.COORDS + 1) / near_dedup.COORDS
    share = np.array([math.comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(n + 1)])

    def apart(levels):
        meet = np.ones(n + 1)
        for _ in range(levels):
            meet = 1 - (1 - same * meet) * (1 - near_dedup.BRANCH * same * meet)
        return 1 - meet
    early, late = (apart(near_dedup.LEVELS * r) for r in (1, rounds))
    never = early ** near_dedup.TREES
    miss = never + (late ** near_dedup.TREES - never) * (share * late ** near_dedup.FURTHER).sum()
    least = near_dedup._least(80)
    assert share[:least].sum() + (share * miss)[least:].sum() < 5e-6


def test_threshold_is_met_exactly(spark):
    words = prose(11, 203).split()  # 200 shingles
    cut = " ".join(words[:163])     # 160 of them: similarity 0.8
    less = " ".join(words[:162])
    assert got(near_dedup.op6(make(spark, [(1, " ".join(words), "s"), (2, cut, "s")])), "doc_id", "component_id") == [(1, 1), (2, 1)]
    assert got(near_dedup.op6(make(spark, [(1, " ".join(words), "s"), (2, less, "s")])), "doc_id", "component_id") == [(1, 1), (2, 2)]


# ------------------------------------------------------------- suffix dedup

def in_order(rows):
    """Null ids first; the test ids that repeat share their texts."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("hot,size", [(20_000, 1 << 20), (1, 1 << 20), (2, 3000)])
def test_removed_spans_match_brute_force(edges, hot, size):
    out = suffix_dedup.suffix_dedup(edges.select("doc_id", "text"), block_bytes=size, hot_runs=hot)
    rows = [(d, t) for d, t in DOCS if d is not None] + [(None, prose(3, 30)), (None, None)]
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.suffixes(in_order(rows)), key=repr)
    for r in out.where("doc_id = 10").collect():
        assert brute.sha(bytes(r["kept"])) == r["kept_sha256"] and len(r["edges"]) == 2 * r["n_spans"]


def test_edges_of_passages_of_just_100_bytes(spark):
    p = prose(12, 40)[:100]
    rows = [(1, "ab " + p + " cd", "s"), (2, "xy" + p + "zz", "s"), (3, p, "s"), (4, p[:99], "s"), (5, p + p, "s"), (6, "ab " + p, "s")]
    out = suffix_dedup.op8(make(spark, rows))
    assert got(out) == sorted(brute.suffixes([(i, t) for i, t, _ in rows]), key=repr)
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {1: 0, 2: 100, 3: 100, 4: 0, 5: 200, 6: 103}


def test_runs_cover_each_window_once():
    buf = np.frombuffer(prose(13, 3000).encode(), np.uint8)
    ends = np.array([50, 149, 1000, len(buf)])
    lo, n, anchor, _ = suffix_dedup.runs(buf, ends)
    windows = np.concatenate([np.arange(s, s + k) for s, k in zip(lo, n, strict=True)])
    want = [s for a, e in zip([0, *ends[:-1]], ends, strict=True) for s in range(a, e - 99)]
    assert windows.tolist() == want
    assert (anchor >= lo + n - 1).all() and (anchor + suffix_dedup.KGRAM <= lo + 100).all()


def test_packed_arrays():
    a = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (blocks.unpack_sorted(blocks.pack_sorted(a), 1000) == a).all()
    assert len(blocks.unplanes(b"", 0, np.uint32)) == 0
    assert blocks.shard_cuts(a, 7)[-1] == 1000


@pytest.mark.parametrize("op", [lm_scoring.op5, near_dedup.op6, suffix_dedup.op8])
def test_empty_tables(nothing, op):
    assert op(nothing).count() == 0


def test_empty_documents_or_test_set(nothing, edges, items):
    assert decontaminate.op4(nothing, items).count() == 0
    assert {r["n_hit"] for r in decontaminate.op4(edges, items.limit(0)).collect()} == {0}
