r"""Packing documents into fixed windows by lexical retrieval.

A document is its token ids and one id 0. Whole windows of ``size`` ids are cut
from its beginning and are sequences of their own; what is left (below
``size``) is a piece, and pieces share windows with others like them:

1. ``pieces_of`` encodes every text and stores windows and pieces with their ids.
2. The lexical terms are the token ids, so the statistics of all pieces (in
   how many a term occurs, number, mean length) are a vector as long as the
   tokenizer's vocabulary, whatever the corpus: Spark adds it up.
3. Pieces are dealt into shards of about ``ROWS``. A piece's key is the term that wins
   a draw weighted by rarity (smallest exponential draw over idf), so pieces
   that share rare terms tend to share a key; shards are cut from the keys in
   order by the number of pieces of each key. A key with more pieces than a shard holds is spread
   over several by hash, so copies of one text fill as many shards as they need.
4. A shard is a BM25 inverted index. The next unused piece is the seed of a
   window: its terms' postings give every piece a score, and the unused pieces with the highest
   scores follow it until the window is full. The last one is cut to fit, and its
   rest is the next seed, so only the last window of a shard is not full.

Texts move once, by shard, as ids; a shard is at most a few megabytes. Which piece
goes where depends on the stored pieces alone, so reruns of a task agree.

Null or empty text is the single id 0. Repeated rows are packed as often as
they come. A document without rest has no piece. No documents give no rows.
Tasks hold slices of 4 MB of text, or one longer text with about fifty bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import mix64
from lodestone.llm.byte_bpe import Encoder
from lodestone.llm.common import pieces as slices
from lodestone.llm.common import stored
from lodestone.llm.runs import cut, flat
from lodestone.session import spread

ROWS = 1024  # pieces of a shard, on average
K1, B = 1.2, 0.75
PIECES = "doc_id long, doc_tokens long, start long, length long, ids binary"


def pieces_of(docs: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """Every document in windows of ``size`` ids and a shorter rest: doc_id,
    doc_tokens, start, length, ids (little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for big in batches:
            for b in slices(big, 1, rows=10_000):
                ids, at = encoder.encode(b.column(1))
                ids, at = np.insert(ids, at[1:], 0).astype("<u4"), at + np.arange(len(at))
                n = np.diff(at)
                windows = -(-n // size)
                doc = np.repeat(np.arange(len(n)), windows)
                start = size * (np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows))
                edge = np.append(at[doc] + start, len(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), pa.array(n[doc]), pa.array(start), pa.array(np.diff(edge)),
                                                  cut(ids.view(np.uint8), 4 * edge).cast(pa.binary())], names=["doc_id", "doc_tokens", "start", "length", "ids"])
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).mapInArrow(run, PIECES)


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, term, count) of pieces given as ids, sorted by piece and term."""
    data, at = flat(column)
    ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
    key, n = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at) // 4) << 32 | ids, return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, n


def statistics(rest: DataFrame) -> tuple[dict[int, int], int, float]:
    """In how many pieces each term occurs, the number of pieces and their mean length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for b in batches:
            n = np.bincount(_terms(b.column(0))[1], minlength=len(held))
            n[:len(held)] += held
            held = n
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], names=["term", "n"])
    counts = rest.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = rest.agg(F.count("*").alias("n"), F.sum("length").alias("length")).first()
    return {r["term"]: r["n"] for r in counts.toLocalIterator()}, total["n"], (total["length"] or 0) / max(1, total["n"])


def idf(found: dict[int, int], n: int) -> np.ndarray:
    """BM25's weight of each term, by term."""
    df = np.zeros(max(found, default=0) + 1)
    df[list(found)] = list(found.values())
    return np.log1p((n - df + 0.5) / (df + 0.5))


def _keys(rest: DataFrame, weight: np.ndarray) -> DataFrame:
    """``rest`` with the key of each piece."""
    u = (mix64(np.arange(len(weight), dtype=np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(float) / (1 << 53)
    draw = -np.log(np.maximum(u, 1e-300)) / np.maximum(weight, 1e-12)
    names = rest.columns
    ids = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                data, at = flat(b.column(ids))
                term, at = np.frombuffer(data.tobytes(), "<u4").astype(np.int64), at // 4
                best = np.repeat(np.minimum.reduceat(draw[term], at[:-1]), np.diff(at))
                winner = np.minimum.reduceat(np.where(draw[term] == best, term, len(weight)), at[:-1])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(winner)], names=[*names, "key"])
    return rest.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in rest.dtypes) + ", key long")


def _shards(rest: DataFrame, weight: np.ndarray) -> DataFrame:
    """``rest`` with a shard number; shards hold ``ROWS`` pieces on average, of one key or of neighbouring ones."""
    keyed = _keys(rest, weight)
    per = sorted((r["key"], r["n"]) for r in keyed.groupBy("key").agg(F.count("*").alias("n")).toLocalIterator())  # at most one row per term
    size = np.zeros(len(weight))
    size[[k for k, _ in per]] = [n for _, n in per]
    first = np.cumsum(size) - size
    place = rest.sparkSession.createDataFrame([(int(k), float(first[k]), float(size[k])) for k, _ in per], "key long, first double, size double")
    part = F.pmod(F.xxhash64("row"), F.lit(1 << 40)) / F.lit(1 << 40)
    return keyed.join(F.broadcast(place), "key").withColumn("shard", F.floor((F.col("first") + part * F.col("size")) / ROWS).cast("long"))


def fill(weight: np.ndarray, mean: float, ids: pa.Array, length: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """Windows of the pieces of a shard: (piece, start in it, length, window, offset)."""
    piece, term, n = _terms(ids)
    score = weight[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * length[piece] / mean))
    by_term = np.argsort(term, kind="stable")
    posted, value = piece[by_term], score[by_term]
    begin = np.searchsorted(term[by_term], term)  # of the postings of each entry's term
    count = np.searchsorted(term[by_term], term, side="right") - begin
    entry = np.searchsorted(piece, np.arange(len(length) + 1))
    left, start, out, window, seed, following = length.copy(), np.zeros_like(length), [], 0, 0, 0

    def take(i: int, offset: int) -> int:
        n = min(int(left[i]), size - offset)
        out.append((i, int(start[i]), n, window, offset))
        left[i] -= n
        start[i] += n
        return offset + n
    while True:
        if not left[seed]:
            while following < len(left) and not left[following]:
                following += 1
            if following == len(left):
                return out
            seed = following
        offset = take(seed, 0)
        if offset < size:
            mine = slice(entry[seed], entry[seed + 1])
            at = np.repeat(begin[mine] - np.cumsum(count[mine]) + count[mine], count[mine]) + np.arange(count[mine].sum())
            match = np.bincount(posted[at], value[at], len(left))
            unused = np.flatnonzero(left)
            for i in unused[np.argsort(-match[unused], kind="stable")].tolist():
                offset = take(i, offset)
                if offset == size:
                    seed = i
                    break
        window += 1


def pack(docs: DataFrame, tokenizer: str, size: int = 1024) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece of every document."""
    every = stored(pieces_of(docs, tokenizer, size), "pieces", compression="zstd")
    whole = every.where(F.col("length") == size)
    rest = every.where(F.col("length") < size).withColumn("row", F.monotonically_increasing_id())
    found, n, mean = statistics(rest)
    weight = idf(found, n)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("row").combine_chunks()
        ids = t.column("ids").combine_chunks()
        rows = np.array(fill(weight, mean, ids, t.column("length").to_numpy(), size), np.int64).reshape(-1, 5)
        data, at = flat(ids)
        begin = at[rows[:, 0]] + 4 * rows[:, 1]
        data, moved = np.concatenate([data[b:b + 4 * n] for b, n in zip(begin.tolist(), rows[:, 2].tolist(), strict=True)]), np.append(0, 4 * np.cumsum(rows[:, 2]))
        of = t.take(pa.array(rows[:, 0]))
        shard = of.column("shard").to_numpy()
        return pa.table({"doc_id": of.column("doc_id"), "start": pa.array(of.column("start").to_numpy() + rows[:, 1]), "length": pa.array(rows[:, 2]),
                         "ids": cut(data, moved).cast(pa.binary()), "doc_tokens": of.column("doc_tokens"),
                         "sequence_id": pa.array(2 * (shard << 20 | rows[:, 3])), "offset": pa.array(rows[:, 4])})
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    shared = _shards(rest, weight).select("shard", "row", "doc_id", "doc_tokens", "start", "length", "ids").groupBy("shard").applyInArrow(run, schema)
    alone = whole.select("doc_id", "start", "length", "ids", "doc_tokens", (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(alone)


def op12(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    d = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return d.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
