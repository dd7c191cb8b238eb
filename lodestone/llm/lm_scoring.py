r"""LM scoring by deleted interpolation.

A bigram model: P(w | h) = a c(hw)/c(h) + b c(w)/N + d / (V+1). The weights
(a, b, d) depend on the bucket of the context frequency, floor(log2(c(h)+1)),
and are learned by expectation-maximisation on held-out counts: every token of
every training document is held out in turn together with its document, so its
counts are those of the other training documents. For EM the tokens enter as
a histogram over (bucket, ratio, count) in quarter octaves, summed over the
whole corpus; its size does not grow with the corpus, so EM runs on the driver.

Counts cover all training documents. They are gathered with ``blocks``: each
block sends its distinct words and word pairs once, as sorted 64-bit hashes
with their counts, and gets corpus counts back. The counts of each token are
stored per document, so the last step is a scan.

Tokens: ASCII lower case, words between ASCII white space, then one end token.
The first token's context is a start mark. Null or empty texts are an end
token alone. Repeated rows count each time. Without training documents only
the uniform term is left. A null id trains as remainder of the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import blocks as B
from lodestone.llm.common import count_blocks, remainder, stored

BLOCK_BYTES = 6 << 20
STEP = 4  # parts of an octave in the EM histogram
RATIOS, COUNTS = 64 * STEP, 64 * STEP
DOCS = "block int, doc_id long, held_out boolean, n_tokens long, n_known long, log_sum double, counts binary, cells array<int>, weights array<long>, distinct_words long"


def _hash(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w)


# the marks hold white space, which no word does
END, START = _hash(b" end"), _hash(b" start")


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with the end marks, context hashes, tokens per text."""
    known: dict[bytes, int] = {}
    ids, lens = [], []
    for t in texts:
        ws = t.lower().split()
        lens.append(len(ws) + 1)
        ids.append(np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws)))
        ids.append(np.array([-1]))
    table = np.array([*map(_hash, known), END], np.uint64)  # -1 is the last
    token = table[np.concatenate(ids)] if ids else np.zeros(0, np.uint64)
    lens = np.array(lens, np.int64)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.cumsum(lens) - lens] = START
    return token, context, lens


def _pair(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hashes of word pairs; of the 64 bits 56 are kept, for shorter lists."""
    return B.mix64(context * np.uint64(0x9E3779B97F4A7C15) + B.mix64(token)) >> np.uint64(8)


def _question(n_shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        token, context, lens = _stream(pdf["text"].tolist())
        train = np.repeat(~pdf["held_out"].to_numpy(bool), lens)
        parts = []
        for keys, bits in ((token, 64), (_pair(context, token), 56)):
            u, inv = np.unique(keys, return_inverse=True)
            parts.append((u, np.bincount(inv, train, len(u)).astype(np.uint64), B.shard_cuts(u, n_shards, bits)))
        out = []
        for s in range(n_shards):
            data, sizes = b"", []
            for u, c, cut in parts:
                lo, hi = cut[s], cut[s + 1]
                sizes.append(hi - lo)
                data += B.pack_sorted(u[lo:hi]) + B.planes(c[lo:hi])
            if any(sizes):
                out.append((int(pdf["block"].iloc[0]), s, np.array(sizes, "<i8").tobytes() + data))
        return pd.DataFrame(out, columns=["block", "shard", "data"])
    return run


def _reply(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of every asked key, and the shard's distinct words as a note to block -1."""
    sizes = [np.frombuffer(d, "<i8", 2) for d in pdf["data"]]
    answers, at = [b""] * len(pdf), [16] * len(pdf)
    distinct = 0
    for part in (0, 1):
        keys, counts = [], []
        for i, d in enumerate(pdf["data"]):
            n = int(sizes[i][part])
            view = memoryview(d)
            keys.append(B.unpack_sorted(view[at[i]:], n))
            counts.append(B.unplanes(view[at[i] + 8 * n:], n, np.uint64))
            at[i] += 16 * n
        u, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(u), np.uint64)
        np.add.at(total, inv, np.concatenate(counts))
        if part == 0:
            distinct = int((total > 0).sum())
        for i, x in enumerate(np.split(total[inv], np.cumsum([len(k) for k in keys])[:-1])):
            answers[i] += B.planes(x)
    shard = pdf["shard"].iloc[0]
    rows = [(b, shard, sizes[i].tobytes() + answers[i]) for i, b in enumerate(pdf["block"])]
    rows.append((-1, shard, np.array([distinct], "<i8").tobytes()))
    return pd.DataFrame(rows, columns=["block", "shard", "data"])


def _octaves(x: np.ndarray) -> np.ndarray:
    """Quarter octaves above 1, from 1 on; 0 for 0."""
    return np.where(x > 0, 1 + np.round(STEP * np.log2(np.maximum(x, 1))), 0).astype(np.int64)


def _own(doc: np.ndarray, key: np.ndarray, n_keys: int) -> np.ndarray:
    """How often each position's key occurs in its own document."""
    _, inv, n = np.unique(doc * n_keys + key, return_inverse=True, return_counts=True)
    return n[inv].astype(np.int64)


def _cells(doc, lens, cu, ch, cb, iu, ib, nu, nb, train) -> tuple[list, list]:
    """Histogram of the held-out counts of training tokens."""
    ou, ob = _own(doc, iu, nu), _own(doc, ib, nb)
    oh = np.empty_like(ou)
    oh[1:] = ou[:-1]
    first = np.cumsum(lens) - lens
    oh[first] = 1  # one start mark a document
    cu, ch, cb = (np.where(train, c - o, 0) for c, o in ((cu, ou), (ch, oh), (cb, ob)))
    bucket = np.log2(ch + 1).astype(np.int64)
    ratio = np.where(cb > 0, 1 + np.round(-STEP * np.log2(np.maximum(cb, 1) / np.maximum(ch, 1))), 0).astype(np.int64)
    cell = (bucket * RATIOS + np.minimum(ratio, RATIOS - 1)) * COUNTS + _octaves(cu)
    u, n = np.unique(cell[train], return_counts=True)
    return u.tolist(), n.tolist()


def _last(pdf: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    cols = [c.split()[0] for c in DOCS.split(", ")]
    notes = notes.sort_values("shard")
    if not len(pdf):
        return pd.DataFrame([(-1, None, None, 0, 0, 0.0, None, None, None, sum(int(np.frombuffer(d, "<i8")[0]) for d in notes["data"]))], columns=cols)
    block = int(pdf["block"].iloc[0])
    token, context, lens = _stream(pdf["text"].tolist())
    counts: list[list] = [[], []]
    for d in notes["data"]:
        n = np.frombuffer(d, "<i8", 2)
        view = memoryview(d)
        counts[0].append(B.unplanes(view[16:], int(n[0]), np.uint64))
        counts[1].append(B.unplanes(view[16 + 8 * int(n[0]):], int(n[1]), np.uint64))
    uu, iu = np.unique(token, return_inverse=True)
    ub, ib = np.unique(_pair(context, token), return_inverse=True)
    cu = np.concatenate(counts[0]).astype(np.int64)[iu]
    cb = np.concatenate(counts[1]).astype(np.int64)[ib]
    first, doc = np.cumsum(lens) - lens, np.repeat(np.arange(len(lens)), lens)
    ch = np.empty_like(cu)
    ch[1:] = cu[:-1]
    ch[first] = cu[first + lens - 1]  # as many starts as ends
    held = pdf["held_out"].to_numpy(bool)
    cells, weights = _cells(doc, lens, cu, ch, cb, iu, ib, len(uu), len(ub), ~np.repeat(held, lens))
    known = np.add.reduceat((cu > 0).astype(np.int64), first)
    logs = np.add.reduceat(np.log10(cu + 1.0), first)
    kind = np.uint32 if not len(cu) or cu.max() < 1 << 32 else np.uint64
    ku, kb = cu.astype(kind), cb.astype(kind)
    both = [B.planes(ku[s:s + n]) + B.planes(kb[s:s + n]) for s, n in zip(first, lens, strict=True)]
    out = pd.DataFrame({"block": block, "doc_id": pdf["doc_id"], "held_out": held, "n_tokens": lens, "n_known": known, "log_sum": logs, "counts": both,
                        "cells": None, "weights": None, "distinct_words": 0})
    note = pd.DataFrame([(block, None, None, 0, 0, 0.0, None, cells, weights, 0)], columns=cols)
    return pd.concat([out[cols].astype({"doc_id": "Int64", "held_out": object}), note.astype({"doc_id": "Int64"})])


def learn(cells: np.ndarray, weights: np.ndarray, n_tokens: int, n_words: int, rounds: int = 60) -> np.ndarray:
    """EM over the histogram: one (pair, word, uniform) mixture per bucket; a
    bucket leans on the mixture of all buckets with the weight of 10 tokens."""
    mixture = np.full((64, 3), 1 / 3)
    if not len(cells):
        return mixture
    bucket, ratio, count = cells // (RATIOS * COUNTS), cells // COUNTS % RATIOS, cells % COUNTS
    p = np.stack([np.where(ratio > 0, 2.0 ** (-(ratio - 1) / STEP), 0), np.where(count > 0, 2.0 ** ((count - 1) / STEP), 0) / max(n_tokens, 1),
                  np.full(len(cells), 1 / (n_words + 1))], 1)
    for _ in range(rounds):
        share = mixture[bucket] * p
        share *= (weights / share.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], 64) for k in range(3)], 1)
        every = sums.sum(0) / sums.sum()
        sums += 10 * every
        mixture = sums / sums.sum(1, keepdims=True)
    return mixture


def score(docs: DataFrame, held_out, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every document; the model learns from rows where ``held_out`` is false."""
    n_blocks = count_blocks(docs, block_bytes)
    blocked = B.in_blocks(docs, n_blocks, held_out.alias("held_out"))
    answers = B.answer(B.ask(blocked, _question(max(1, n_blocks // 2))), _reply)
    table = stored(B.finish(blocked, answers, _last, DOCS), "lm-counts", compression="zstd")

    scored = table.where(F.col("counts").isNotNull())
    n_tokens = scored.where(~F.col("held_out")).agg(F.sum("n_tokens")).first()[0] or 0
    n_words = table.agg(F.sum("distinct_words")).first()[0] or 0
    # a fixed number of cells at most, whatever the size of the corpus
    hist = table.where(F.col("cells").isNotNull()).select(F.explode(F.arrays_zip("cells", "weights")).alias("c")) \
        .groupBy("c.cells").agg(F.sum("c.weights").alias("n")).toPandas()
    mixture = learn(hist["cells"].to_numpy(np.int64), hist["n"].to_numpy(np.float64), n_tokens, n_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = []
            for n, data in zip(b.column("n_tokens").to_pylist(), b.column("counts"), strict=True):
                view = memoryview(data.as_buffer())
                kind = np.uint32 if len(view) == 8 * n else np.uint64
                cu, cb = B.unplanes(view, n, kind).astype(np.int64), B.unplanes(view[len(view) // 2:], n, kind).astype(np.int64)
                ch = np.concatenate([cu[-1:], cu[:-1]])
                m = mixture[np.log2(ch + 1).astype(np.int64)]
                p = m[:, 0] * cb / np.maximum(ch, 1) + m[:, 1] * cu / max(n_tokens, 1) + m[:, 2] / (n_words + 1)
                total.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), b.column("n_tokens"), b.column("n_known"), b.column("log_sum"),
                                              pa.array(total, pa.float64())], names=["doc_id", "held_out", "n_tokens", "n_known", "log_sum", "score"])
    out = scored.select("doc_id", "held_out", "n_tokens", "n_known", "log_sum", "counts").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, log_sum double, score double")
    base = F.col("log_sum") - F.col("n_tokens") * F.log10(F.lit(float(n_tokens + n_words + 1)))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op5(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), remainder(F.col("doc_id"), 7) == 2)
