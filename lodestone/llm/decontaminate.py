r"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: every task turns its documents, a few
megabytes at a time, into shards. A shard stores for each term its postings
(document number and position, one number in the shard's running word count)
and a row with the documents' lengths. Terms that no test item has cannot
match and are left out when a vocabulary is given. Shards are written as a
table and searched one by one, so no list of a frequent term, however long it
is in the corpus, meets in one task.

A test item is cut into windows of ``n`` consecutive words (an item of fewer
words is one window). For each window a search starts from the rarest term of
the shard, shifts its postings by the term's offset, and intersects the next
rarest lists, shifted alike, until the list is empty or all terms agree: an
exact phrase match. A proximity match needs every term of a window, with its
count, inside ``n + slop`` consecutive words of one document in any order.

The test set goes to every task with the search function: its size is checked
against MAX_TEST_BYTES first, and a larger one is cut into parts that are
searched one after another over the same stored index, then of all terms.

ASCII lower case; words are runs of letters, digits and non-ASCII characters.
Null or empty texts have no words and are clean; items without words match
nothing; repeated items and rows each count; null ids of documents are kept,
items without an id match nothing.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import stored

# on UTF-8 bytes: digits, ASCII letters and whatever is not ASCII
WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")
SHARD_BYTES = 4 << 20
MAX_TEST_BYTES = 4 << 20  # of test texts in a task at once; its windows take some 50 times that
INDEX = "shard string, term string, n int, postings binary, docs array<bigint>, rows array<bigint>, ends array<int>"
MATCH = "row long, doc_id long, item_id string, start int, stop int, kind string"


def tokens(text: bytes | str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.lower`` changes A-Z only."""
    raw = text.encode() if isinstance(text, str) else text
    return WORD.findall(raw.lower()) if raw else []


# ---------------------------------------------------------------- index

def _shard(name: str, ids: list, rows: list, texts: list[bytes], vocabulary: set | None) -> pa.RecordBatch:
    term_of: dict[bytes, int] = {}
    places, terms, ends, at = [], [], [], 0
    for text in texts:
        ws = tokens(text)
        if vocabulary is None:
            terms.append(np.fromiter((term_of.setdefault(w, len(term_of)) for w in ws), np.int64, len(ws)))
            places.append(np.arange(at, at + len(ws)))
        else:
            hit = [(i, term_of.setdefault(w, len(term_of))) for i, w in enumerate(ws) if w in vocabulary]
            if hit:
                both = np.array(hit, np.int64)
                places.append(both[:, 0] + at)
                terms.append(both[:, 1])
        at += len(ws)
        ends.append(at)
    term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
    place = np.concatenate(places).astype("<i4") if places else np.zeros(0, "<i4")
    place = place[np.argsort(term, kind="stable")]
    counts = np.bincount(term, minlength=len(term_of))
    cut = np.concatenate([[0], np.cumsum(counts)])
    names = [t.decode() for t in term_of]
    k = len(names)
    none = [None] * k
    return pa.RecordBatch.from_arrays([
        pa.array([name] * (k + 1), pa.string()), pa.array([*names, None], pa.string()), pa.array([*counts.tolist(), len(texts)], pa.int32()),
        pa.array([*(place[cut[i]:cut[i + 1]].tobytes() for i in range(k)), None], pa.binary()),
        pa.array([*none, ids], pa.list_(pa.int64())), pa.array([*none, rows], pa.list_(pa.int64())), pa.array([*none, ends], pa.list_(pa.int32()))],
        names=["shard", "term", "n", "postings", "docs", "rows", "ends"])


def build_index(docs: DataFrame, vocabulary: set | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Postings table of ``docs`` (row long, doc_id long, text), stored."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, rows, texts, size = [], [], [], 0
        for b in batches:
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), strict=True):
                text = text.as_py()
                ids.append(doc_id)
                rows.append(row)
                texts.append(text)
                size += len(text or b"") + 16
                if size >= shard_bytes:
                    yield _shard(f"{part}.{number}", ids, rows, texts, vocabulary)
                    ids, rows, texts, size, number = [], [], [], 0, number + 1
        if texts:
            yield _shard(f"{part}.{number}", ids, rows, texts, vocabulary)
    return stored(docs.select("row", "doc_id", "text").mapInArrow(index, INDEX), "index")


# ---------------------------------------------------------------- search

def windows(items: list[tuple[str, str]], n: int) -> dict[tuple, list[str]]:
    """Window (tuple of words) -> ids of the items that have it."""
    found: dict[tuple, dict] = {}
    for item, text in items:
        ws = tokens(text)
        for i in range(max(1, len(ws) - n + 1) if ws else 0):
            found.setdefault(tuple(w.decode() for w in ws[i:i + n]), {})[item] = None
    return {w: list(ids) for w, ids in found.items()}


def _phrase(window: tuple, lists: dict[str, np.ndarray], doc_end: np.ndarray) -> np.ndarray:
    """Start places of the window, from the rarest term on."""
    order = sorted(range(len(window)), key=lambda k: len(lists[window[k]]))
    starts = lists[window[order[0]]] - order[0]
    for k in order[1:]:
        if not len(starts):
            return starts
        other = lists[window[k]]
        at = np.searchsorted(other, starts + k)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == starts + k)]
    starts = starts[starts >= 0]
    doc = np.searchsorted(doc_end, starts, side="right")
    return starts[starts + len(window) <= doc_end[np.minimum(doc, len(doc_end) - 1)]]


def _near(window: tuple, lists: dict[str, np.ndarray], doc_end: np.ndarray, span: int) -> list[tuple[int, int]]:
    """(start, stop) of each minimal stretch of at most ``span`` words that
    holds every word of the window as often as the window does."""
    need = {w: window.count(w) for w in window}
    rare = min(need, key=lambda w: len(lists[w]))
    found = {}
    for p in lists[rare]:
        lo = doc_end[np.searchsorted(doc_end, p, side="right") - 1] if p >= doc_end[0] else 0
        hi = doc_end[np.searchsorted(doc_end, p, side="right")]
        around = {w: lists[w][np.searchsorted(lists[w], max(lo, p - span + 1)):np.searchsorted(lists[w], min(hi, p + span))] for w in need}
        if any(len(around[w]) < k for w, k in need.items()):
            continue
        every = sorted((int(q), w) for w, qs in around.items() for q in qs)
        have, left, lacking = dict.fromkeys(need, 0), 0, len(window)
        for q, w in every:
            have[w] += 1
            lacking -= have[w] <= need[w]
            while not lacking:
                start, first = every[left]
                if have[first] == need[first]:
                    if q - start < span:
                        found[(start, q + 1)] = None
                    lacking += 1
                have[first] -= 1
                left += 1
    return list(found)


def search_shard(pdf, wins: dict[tuple, list[str]], slop: int | None):
    """(document number, item, start, stop, kind) matches of one shard."""
    meta = pdf[pdf["term"].isna()].iloc[0]
    lists = {t: np.frombuffer(p, "<i4").astype(np.int64) for t, p in zip(pdf["term"], pdf["postings"], strict=True) if isinstance(t, str)}
    doc_end = np.asarray(meta["ends"], np.int64)
    first = np.concatenate([[0], doc_end[:-1]])
    out = []
    for w, items in wins.items():
        if any(x not in lists for x in w):
            continue
        spans = [(int(s), int(s) + len(w), "phrase") for s in _phrase(w, lists, doc_end)]
        if slop is not None:
            exact = {(s, e) for s, e, _ in spans}
            spans += [(s, e, "near") for s, e in _near(w, lists, doc_end, len(w) + slop) if (s, e) not in exact]
        for s, e, kind in spans:
            doc = int(np.searchsorted(doc_end, s, side="right"))
            out += [(doc, item, int(s - first[doc]), int(e - first[doc]), kind) for item in items]
    return meta, out


def count_parts(benchmark: DataFrame, max_test_bytes: int) -> int:
    """Parts of about ``max_test_bytes`` the test set is cut into."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-int(total) // max_test_bytes))


def test_items(benchmark: DataFrame, part: int, n_parts: int) -> list[tuple[str, str]]:
    """(item_id, text) of one part of the test set."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text")
    return [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)) == part).collect()]


def search(index: DataFrame, items: list[tuple[str, str]], n: int = 10, slop: int | None = None) -> DataFrame:
    """Matches of the items: row, doc_id, item_id, start, stop (words of the
    document) and kind (phrase or near)."""
    import pandas as pd

    wins = windows(items, n)

    def find(pdf):
        meta, found = search_shard(pdf, wins, slop)
        return pd.DataFrame([(int(meta["rows"][d]), meta["docs"][d], i, s, e, k) for d, i, s, e, k in found],
                            columns=["row", "doc_id", "item_id", "start", "stop", "kind"]).astype({"doc_id": "Int64"})
    return index.groupBy("shard").applyInPandas(find, MATCH)


FOUND = "shard string, number int, row long, doc_id long, n_words long, starts array<int>, stops array<int>, items array<string>"


def found(index: DataFrame, items: list[tuple[str, str]], n: int = 10) -> DataFrame:
    """One row per indexed document: its place in the index, its words, the
    stretches of them inside exact matches, and the items matched."""
    import pandas as pd

    wins = windows(items, n)

    def judge(pdf):
        meta, matches = search_shard(pdf, wins, None)
        ends = [int(e) for e in meta["ends"]]
        spans: dict[int, dict] = {}
        held: dict[int, dict] = {}
        for d, item, s, e, _ in matches:
            spans.setdefault(d, {})[(s, e)] = None
            held.setdefault(d, {})[item] = None
        out = []
        for d, (row, doc_id) in enumerate(zip(meta["rows"], meta["docs"], strict=True)):
            joined: list[list[int]] = []
            for s, e in sorted(spans.get(d, ())):
                if joined and s <= joined[-1][1]:
                    joined[-1][1] = max(e, joined[-1][1])
                else:
                    joined.append([s, e])
            out.append((meta["shard"], d, int(row), doc_id, ends[d] - (ends[d - 1] if d else 0), [s for s, _ in joined], [e for _, e in joined], list(held.get(d, ()))))
        return pd.DataFrame(out, columns=["shard", "number", "row", "doc_id", "n_words", "starts", "stops", "items"]).astype({"doc_id": "Int64"})
    return index.groupBy("shard").applyInPandas(judge, FOUND)


def verdicts(rows: DataFrame) -> DataFrame:
    """Count the words in the union of the stretches, and name the items."""
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach"))

    def add(acc, s):
        new = F.greatest(F.lit(0), s["stops"] - F.greatest(s["starts"], acc["reach"]))
        return F.struct((acc["hit"] + new).alias("hit"), F.greatest(acc["reach"], s["stops"]).alias("reach"))

    items = F.array_sort(F.array_distinct("items"))
    hit = F.aggregate(F.array_sort(F.arrays_zip("starts", "stops")), zero, add)["hit"]
    return rows.select("row", "doc_id", "n_words", hit.cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_test_bytes: int = MAX_TEST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and row (the
    given ``row`` column, or a number of this run) per document. The parts of
    a large test set are read, searched and stored one by one, and what they
    found is joined per document: the result does not depend on the parts."""
    if "row" not in docs.columns:
        docs = docs.withColumn("row", F.monotonically_increasing_id())
    docs = docs.select("row", F.col("doc_id").cast("long"), "text")
    n_parts = count_parts(benchmark, max_test_bytes)
    if n_parts == 1:
        items = test_items(benchmark, 0, 1)
        return verdicts(found(build_index(docs, {w for _, text in items for w in tokens(text)}), items, n))
    index = build_index(docs)
    parts = [stored(found(index, test_items(benchmark, k, n_parts), n), "found") for k in range(n_parts)]
    every = functools.reduce(DataFrame.unionByName, parts).groupBy("shard", "number").agg(
        *[F.first(c).alias(c) for c in ("row", "doc_id", "n_words")], *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items")])
    return verdicts(every)


def op4(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs.select("doc_id", "text"), benchmark).drop("row")
