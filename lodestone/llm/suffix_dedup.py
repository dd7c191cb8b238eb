r"""Suffix-array dedup: remove every byte inside a repeated 100-byte string.

Sorting all suffixes of a corpus would move each byte a hundred times. Here
the suffixes are sampled where their content says so: of each window of
LENGTH bytes, the KGRAM-byte string with the smallest hash is its anchor.
Equal windows have equal anchors at equal offsets, so only suffixes that start
with a common anchor can hold equal windows; consecutive windows with one
anchor form a run, and travel as one suffix record (the run's bytes).

1. Blocks send the hashes of their anchors; shards answer how many distinct
   runs each anchor has in the corpus (``blocks``). Anchors with one run only
   are unique, and their windows are no repeats of another block.
2. The records of the other anchors are range-partitioned by their leading
   bytes, with splitters from a sample of the corpus's anchors. A record that is
   repeated whole inside a block is sent once. An anchor with over HOT_RUNS
   distinct runs would meet in one bucket: its windows are sent one by one,
   range-partitioned by a hash of all their bytes.
3. A bucket cuts its records into window suffixes and sorts them by multikey
   passes: by the first eight bytes, then ties by the next eight, and so on;
   equal neighbours after the last pass are the same string. The first by
   (doc_id, start) stays, the others are answered as repeats. Ranges end
   between different anchors, so strings at a boundary are compared by the
   bucket that holds both.
4. Blocks join the repeats to removed spans.

Documents are ordered by id; null ids come first, and rows that share an id
are ordered by block and text. A row repeated whole is a document of its own: one
of the copies stays. Null texts are empty. Texts under LENGTH bytes stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import blocks as B

LENGTH, KGRAM = 100, 38
SPAN = LENGTH - KGRAM + 1  # anchors a window can choose from; at most 64
PIECE = 1 << 19
BLOCK_BYTES = 4 << 20
HOT_RUNS = 20_000
SAMPLE_BYTES = 8 << 20
FACTOR = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER: dict = {}


def _kgram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the KGRAM bytes from each place on."""
    if "up" not in _POWER:
        _POWER.update(up=_powers(PIECE + LENGTH, FACTOR), down=_powers(PIECE + LENGTH, pow(FACTOR, -1, 1 << 64)))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _POWER["up"][:len(b)], out=total[1:])
    return B.mix64((total[KGRAM:] - total[:-KGRAM]) * _POWER["down"][:len(b) - KGRAM + 1])


def runs(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window start, number of
    windows, anchor place, hash of the anchor's bytes."""
    valid = np.ones(len(buf), bool)
    starts = np.concatenate([[0], ends[:-1]])
    for s, e in zip(starts, ends, strict=True):
        valid[max(s, e - LENGTH + 1):e] = False
    out = []
    for at in range(0, max(0, len(buf) - LENGTH + 1), PIECE):
        n = min(PIECE, len(buf) - LENGTH + 1 - at)
        inside = np.flatnonzero(valid[at:at + n])
        if not len(inside):
            continue
        h = _kgram_hashes(buf[at:at + n + LENGTH - 1])
        m = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while 2 * span <= SPAN:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < SPAN:
            m = np.minimum(m[:-(SPAN - span)], m[SPAN - span:])
        anchor = (m & np.uint64((1 << 20) - 1)).astype(np.int64)[inside]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(inside) != 1) | (np.diff(anchor) != 0)]))
        out.append((inside[new] + at, np.diff(np.append(new, len(inside))), anchor[new] + at, h[anchor[new]]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Block:
    """The documents of a block in order, and its runs."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        pdf = pdf.assign(order=pdf["doc_id"].fillna(-(1 << 63)).astype("int64")).sort_values(["order", "text"], kind="stable")
        self.ids, self.order, self.texts = pdf["doc_id"], pdf["order"].to_numpy(), pdf["text"].tolist()
        self.raw = b"".join(self.texts)
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.lo, self.n, self.anchor, self.key = runs(self.buf, self.ends)
        # runs are in document order: the first of equal ones is the earliest
        seen: dict[bytes, int] = {}
        self.same_as = np.fromiter((seen.setdefault(self.raw[s:s + n + LENGTH - 1], i) for i, (s, n) in enumerate(zip(
            self.lo.tolist(), self.n.tolist(), strict=True))), np.int64, len(self.lo))
        self.first = np.flatnonzero(self.same_as == np.arange(len(self.lo)))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor hashes, and the distinct runs of each."""
        u, n = np.unique(self.key[self.first], return_counts=True)
        return u, n.astype(np.uint32)

    def records(self, totals: np.ndarray, hot_runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What must be compared with other records: first window, number of
        windows, hot or not. Hot anchors' windows go one by one, each
        distinct string once."""
        u, _ = self.keys()
        n = totals[np.searchsorted(u, self.key[self.first])]
        warm, hot = self.first[(n > 1) & (n <= hot_runs)], self.first[n > hot_runs]
        starts = np.concatenate([np.arange(self.lo[i], self.lo[i] + self.n[i]) for i in hot]) if len(hot) else np.zeros(0, np.int64)
        alone: dict[bytes, int] = {}
        for s in starts.tolist():
            alone.setdefault(self.raw[s:s + LENGTH], s)
        single = np.array(list(alone.values()), np.int64)
        return (np.concatenate([self.lo[warm], single]), np.concatenate([self.n[warm], np.ones(len(single), np.int64)]),
                np.concatenate([self.anchor[warm], np.full(len(single), -1)]))

    def route(self, lo: np.ndarray, anchor: np.ndarray, splitters: np.ndarray) -> np.ndarray:
        """Buckets of records: even ones are ranges of the anchor's leading
        bytes, odd ones take hot windows by a hash of all their bytes."""
        bucket, warm = np.zeros(len(lo), np.int64), anchor >= 0
        bucket[warm] = 2 * np.searchsorted(splitters, leading(self.buf, anchor[warm]), side="right")
        lead = [int.from_bytes(hashlib.blake2b(self.raw[s:s + LENGTH], digest_size=7).digest()) for s in lo[~warm].tolist()]
        bucket[~warm] = 2 * (np.array(lead, np.int64) % (len(splitters) + 1)) + 1
        return bucket


def leading(buf: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number."""
    out = np.zeros(len(places), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | buf[places + k].astype(np.uint64)
    return out


def _question(n_shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        u, n = Block(pdf).keys()
        cut = B.shard_cuts(u, n_shards)
        # the upper six bytes say enough: a chance match only adds a comparison
        rows = [(int(pdf["block"].iloc[0]), s, np.array([cut[s + 1] - cut[s]], "<i8").tobytes() + B.pack_sorted(u[cut[s]:cut[s + 1]] >> np.uint64(16)) + B.planes(
            n[cut[s]:cut[s + 1]])) for s in range(n_shards) if cut[s + 1] > cut[s]]
        return pd.DataFrame(rows, columns=["block", "shard", "data"])
    return run


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, counts = [], []
    for d in pdf["data"]:
        n = int(np.frombuffer(d, "<i8", 1)[0])
        keys.append(B.unpack_sorted(memoryview(d)[8:], n))
        counts.append(B.unplanes(memoryview(d)[8 + 8 * n:], n, np.uint32))
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.minimum(np.bincount(inv, np.concatenate(counts)), (1 << 32) - 1).astype(np.uint32)
    parts = np.split(total[inv], np.cumsum([len(k) for k in keys])[:-1])
    return pdf[["block", "shard"]].assign(data=[B.planes(p) for p in parts])


def _totals(notes: pd.DataFrame) -> np.ndarray:
    parts = [B.unplanes(d, len(d) // 4, np.uint32) for d in notes.sort_values("shard")["data"]]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _send(splitters: np.ndarray, hot_runs: int):
    """Records of a block to the buckets of their leading bytes (hot: of their hash)."""
    def run(pdf: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        b = Block(pdf)
        lo, n, anchor = b.records(_totals(notes), hot_runs)
        rows = []
        if len(lo):
            bucket = b.route(lo, anchor, splitters)
            doc = np.searchsorted(b.ends, lo, side="right")
            place = lo - np.concatenate([[0], b.ends])[doc]
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for k in np.split(order, cuts[1:]):
                size = n[k] + LENGTH - 1
                data = b"".join(b.raw[s:s + z] for s, z in zip(lo[k].tolist(), size.tolist(), strict=True))
                rows.append((int(pdf["block"].iloc[0]), int(bucket[k[0]]), np.array([len(k)], "<i8").tobytes() + B.planes(n[k].astype(np.uint8)) + B.planes(
                    b.order[doc[k]].astype("<i8")) + B.planes(doc[k].astype("<u4")) + B.planes(place[k].astype("<u4")) + data))
        return pd.DataFrame(rows, columns=["block", "shard", "data"])
    return run


def multikey_repeats(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the LENGTH-byte strings at ``starts`` equal an earlier one of
    the list: sort by eight bytes, then the ties by the next eight, ..."""
    repeat = np.zeros(len(starts), bool)
    live, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        word = leading(buf, starts[live] + at)
        order = np.lexsort((word, group))
        live, group, word = live[order], group[order], word[order]
        new = np.concatenate([[True], (np.diff(group) != 0) | (word[1:] != word[:-1])])
        group = np.cumsum(new)
        tied = np.bincount(group)[group] > 1
        live, group = live[tied], group[tied]
        if not len(live):
            return repeat
    later = np.concatenate([[False], np.diff(group) == 0])
    repeat[live[later]] = True
    return repeat


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bit per window of each record: 1 where the string starts earlier elsewhere."""
    n, order, doc, place, block, texts = [], [], [], [], [], []
    for blk, d in zip(pdf["block"], pdf["data"], strict=True):
        k, v, at = int(np.frombuffer(d, "<i8", 1)[0]), memoryview(d), 8
        for out, dtype in ((n, np.uint8), (order, np.int64), (doc, np.uint32), (place, np.uint32)):
            out.append(B.unplanes(v[at:], k, dtype))
            at += k * np.dtype(dtype).itemsize
        block.append(np.full(k, blk))
        size = n[-1].astype(np.int64) + LENGTH - 1
        cut = (at + np.concatenate([[0], np.cumsum(size)])).tolist()
        texts += [d[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]
    counts = [len(x) for x in n]
    n, order, doc, place, block = (np.concatenate(x) for x in (n, order, doc, place, block))
    n = n.astype(np.int64)
    rank = np.lexsort((place, doc, block, order))  # documents in order, then places
    seen: dict[bytes, int] = {}
    repeated = np.array([seen.setdefault(texts[i], i) != i for i in rank.tolist()], bool)
    masks = np.zeros(len(n), np.uint64)
    masks[rank[repeated]] = (np.uint64(1) << n[rank[repeated]].astype(np.uint64)) - np.uint64(1)
    firsts = rank[~repeated]
    buf = np.frombuffer(b"".join(texts[i] for i in firsts), np.uint8)
    k = n[firsts]
    offset = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    hit = multikey_repeats(buf, np.repeat(np.cumsum(k + LENGTH - 1) - (k + LENGTH - 1), k) + offset)
    np.bitwise_or.at(masks, np.repeat(firsts, k)[hit], np.uint64(1) << offset[hit].astype(np.uint64))
    return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "data": [B.planes(m) for m in np.split(masks, np.cumsum(counts)[:-1])]})


def _remove(splitters: np.ndarray, hot_runs: int, texts: bool):
    def run(pdf: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        b = Block(pdf)
        kind = notes["kind"].to_numpy()
        lo, n, anchor = b.records(_totals(notes[kind == 0]), hot_runs)
        masks = np.zeros(len(lo), np.uint64)
        if len(lo):
            bucket = b.route(lo, anchor, splitters)
            order = np.argsort(bucket, kind="stable")
            masks[order] = np.concatenate([B.unplanes(d, len(d) // 8, np.uint64) for d in notes[kind == 1].sort_values("shard")["data"]])
        cover = np.zeros(len(b.buf) + 1, np.int32)

        def add(starts, counts):
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + counts + LENGTH - 1, -1)
        later = np.flatnonzero(b.same_as != np.arange(len(b.lo)))
        add(b.lo[later], b.n[later])
        bits = (masks[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1) if len(lo) else np.zeros((0, 64), np.uint64)
        rec, off = np.nonzero(bits)
        repeats = lo[rec] + off
        add(repeats, np.ones(len(repeats), np.int64))
        if (anchor < 0).any():  # the other places of a hot string in this block
            first_of = {b.raw[s:s + LENGTH]: s for s in lo[anchor < 0].tolist()}
            u, _ = b.keys()
            totals = _totals(notes[kind == 0])
            for i in b.first[totals[np.searchsorted(u, b.key[b.first])] > hot_runs]:
                again = [s for s in range(b.lo[i], b.lo[i] + b.n[i]) if first_of[b.raw[s:s + LENGTH]] != s]
                add(np.array(again, np.int64), np.ones(len(again), np.int64))
        covered = np.cumsum(cover[:-1]) > 0
        out, at = [], 0
        for doc_id, text, e in zip(b.ids, b.texts, b.ends.tolist(), strict=True):
            c = covered[at:e]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], c.astype(np.int8), [0]])))
            kept = np.frombuffer(text, np.uint8)[~c].tobytes() if len(edge) else text
            out.append((doc_id, len(text), int(c.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), edge.tolist(), kept if texts else None))
            at = e
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges", "kept"]).astype({"doc_id": "Int64"})
    return run


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, edges array<int>, kept binary"


def sample_splitters(docs: DataFrame, total_bytes: int, n_buckets: int, sample_bytes: int = SAMPLE_BYTES) -> np.ndarray:
    """Ascending leading words that cut the anchors of a sample of about
    ``sample_bytes`` of text into equal parts."""
    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            raw = b"".join(texts)
            if raw:
                buf = np.frombuffer(raw, np.uint8)
                anchor = np.unique(runs(buf, np.cumsum([len(t) for t in texts]))[2])
                yield pa.RecordBatch.from_arrays([pa.array(leading(buf, anchor).view(np.int64))], names=["lead"])
    part = docs.select(F.col("text").cast("binary").alias("text")).sample(min(1.0, sample_bytes / max(total_bytes, 1)), seed=11)
    found = np.sort(part.mapInArrow(leads, "lead long").toPandas()["lead"].to_numpy(np.int64).view(np.uint64))
    at = (np.arange(1, n_buckets) * len(found)) // n_buckets
    return np.unique(found[at]) if len(found) else np.zeros(0, np.uint64)


def suffix_dedup(docs: DataFrame, texts: bool = True, block_bytes: int = BLOCK_BYTES, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, edges (start, stop,
    start, ... of the removed spans, in bytes) and, if asked for, kept (the bytes that stay)."""
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n_blocks = max(1, -(-total // block_bytes))
    blocked = B.in_blocks(docs, n_blocks)
    splitters = sample_splitters(docs, total, n_blocks)
    counted = B.answer(B.ask(blocked, _question(max(1, n_blocks // 2))), _count)
    sent = blocked.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(_send(splitters, hot_runs), B.NOTE)
    compared = B.answer(sent, _compare)
    notes = counted.withColumn("kind", F.lit(0)).unionByName(compared.withColumn("kind", F.lit(1)))
    return B.finish(blocked, notes, _remove(splitters, hot_runs, texts), OUT)


def op8(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs.select("doc_id", "text"), texts=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
