r"""Audit of how the sources of a language diverge in their words.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased.
A language keeps the terms found in at least ``min_docs`` of its documents (V of
them). A group is a (lang, source); the language as a whole is one more. With
count occurrences of a kept term and N of all kept terms, its share is
p = 1 + floor(SCALE * (count + 1) / (N + V)), and p diverges from q by
floor((p - q)^2 / q). Every group is compared with each other source of its
language (summed over all kept terms, those it lacks too), and with the whole
language (its terms of larger share, the ``top`` first).

1. First pass, exact frequency filter: tasks count documents per (lang, term)
   in a bounded table, Spark adds up, and terms of enough documents are stored.
2. The kept terms of a language are dealt by hash into shards, and a task per
   shard builds a minimal perfect hash with the terms stored in slot order.
3. Second pass: if all shards together are at most ``MAX_BROADCAST`` bytes
   (summed before anything is collected), they are broadcast; a task looks up
   each distinct term of a few megabytes of text, verifies it against the
   stored term, and increments the dense slots of its group. When its slots
   reach ``MAX_SLOTS`` it puts out the non-zero ones and starts anew. A larger
   vocabulary is not broadcast: tasks then send (group, term, count), and each
   shard looks up what was sent to it. Both give the same counts.
4. Counts meet once more by shard, as a dense matrix of groups by slots (at most
   ``CELLS`` cells, but for 64 slots of very many sources), which gives that
   shard's part of every pair and its ``top`` terms of every group.

Terms that are in few documents are never shuffled per group. No key is hot: a
frequent term is one entry per task, a large group is many tasks, and the slots
of a group are spread over the shards.

All numbers are exact integers (N + V below 9.2e15). Null text, lang or source
is ''. A repeated row is a further document. A group without terms has count 0
everywhere; a language without kept terms gives pairs of value 0 and no terms;
a language of one source gives no pairs. Ties go to the smaller item in UTF-8 order. No documents
give no rows. A task holds slices of 4 MB of text, or one longer text with about
ten bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm import perfect_hash
from lodestone.llm.common import pieces, stored
from lodestone.llm.perfect_hash import Lookup, PerfectHash, hashes
from lodestone.llm.runs import flat, runs
from lodestone.session import spread

SCALE = 1_000_000_000
MAX_BROADCAST = 64 << 20
MAX_SLOTS = 32 << 20   # 4-byte counters in a task
MAX_HELD = 400_000     # distinct (group, term) entries in a task's table
CELLS, MOST_KEYS, LEAST_KEYS = 1 << 20, 16_384, 64

_INSIDE = np.zeros(256, bool)
_INSIDE[97:123] = _INSIDE[128:] = True  # after lower-casing
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ------------------------------------------------------------- terms of a slice

class Slice:
    """The terms of a slice of documents: ``words`` (distinct), and for each
    term in the texts its document and its word."""

    def __init__(self, texts: pa.Array):
        data, at = flat(texts)
        terms, self.doc = runs(_LOWER[data], at, _INSIDE)
        coded = terms.dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)

    def per(self, group: np.ndarray, once: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group, word, count) sorted by both, of the documents' group
        numbers; with ``once`` a document counts a word once."""
        n, doc, code = max(1, len(self.words)), self.doc, self.code
        if once:
            both = np.unique(doc * n + code)
            doc, code = both // n, both % n
        key, count = np.unique(group[doc] * n + code, return_counts=True)
        return key // n, key % n, count


def _numbered(columns: list[pa.Array]) -> tuple[np.ndarray, list[tuple[str, ...]]]:
    """Numbers of the distinct rows of some columns, and these rows."""
    known: dict[tuple[str, ...], int] = {}
    out = [known.setdefault(row, len(known)) for row in zip(*[c.to_pylist() for c in columns], strict=True)]
    return np.array(out, np.int64), list(known)


def _slices(batches: Iterator[pa.RecordBatch], names: int) -> Iterator[tuple[Slice, np.ndarray, list[tuple[str, ...]]]]:
    """Slices of (text, names...) with each document's group number and the groups."""
    for big in batches:
        for b in pieces(big, 0, rows=10_000):
            yield Slice(b.column(0)), *_numbered(b.columns[1:1 + names])


def _term_counts(docs: DataFrame, names: list[str], once: bool) -> DataFrame:
    """(names..., term, hash, n): how many terms, or with ``once`` documents,
    as counted by each task; a term may come several times."""
    def table(held: dict[tuple[str, ...], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for group, counts in held.items():
            if counts:
                terms = pa.array(list(counts), pa.binary())
                cols = [pa.array([g] * len(terms), pa.string()) for g in group]
                yield pa.RecordBatch.from_arrays([*cols, terms, pa.array(hashes(terms)), pa.array(list(counts.values()), pa.int64())],
                                                 names=[*names, "term", "hash", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, ...], dict[bytes, int]] = {}
        for s, number, groups in _slices(batches, len(names)):
            g, word, count = s.per(number, once)
            cuts = np.searchsorted(g, np.arange(len(groups) + 1)).tolist()
            for k, group in enumerate(groups):
                mine = held.setdefault(group, {})
                part = slice(cuts[k], cuts[k + 1])
                for w, n in zip(s.words.take(pa.array(word[part])).to_pylist(), count[part].tolist(), strict=True):
                    mine[w] = mine.get(w, 0) + n
            if sum(map(len, held.values())) > MAX_HELD:
                yield from table(held)
                held = {}
        yield from table(held)
    return docs.select("text", *names).mapInArrow(run, "".join(f"{c} string, " for c in names) + "term binary, hash long, n long")


# ------------------------------------------------------------- kept terms and their hashes

def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, hash) of the terms in at least ``min_docs`` documents of the language."""
    each = _term_counts(docs, ["lang"], once=True)
    return each.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.first("hash").alias("hash")) \
        .where(F.col("n") >= min_docs).select("lang", "term", "hash")


def build_shards(kept: DataFrame, per_lang: DataFrame) -> DataFrame:
    """(lang, shard, sizes, bits, keys, rest): a perfect hash per shard."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        of = perfect_hash.build(t.column("term").combine_chunks(), t.column("hash").to_numpy())
        return pa.table({"lang": [key[0].as_py()], "shard": pa.array([key[1].as_py()], pa.int32()), "sizes": pa.array([of.sizes.tolist()], pa.list_(pa.int64())),
                         "bits": pa.array([np.packbits(of.bits).tobytes()], pa.binary()), "keys": pa.array([of.keys.to_pylist()], pa.list_(pa.binary())),
                         "rest": pa.array([of.rest], pa.int32())})
    dealt = kept.join(per_lang.select("lang", "n_shards"), "lang").withColumn("shard", F.pmod("hash", "n_shards").cast("int"))
    return dealt.select("lang", "shard", "term", "hash").groupBy("lang", "shard") \
        .applyInArrow(run, "lang string, shard int, sizes array<long>, bits binary, keys array<binary>, rest int")


def _lookup(sizes: list[int], bits: bytes, keys: pa.Array, rest: int) -> Lookup:
    sizes = np.array(sizes, np.int64)
    return Lookup(PerfectHash(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool), keys, rest))


class Vocabulary:
    """The broadcast shards of all languages. A language's slots are those of its shards, one after the other."""

    def __init__(self, ipc: bytes):
        self.shards: dict[str, dict[int, Lookup]] = {}
        self.n_shards: dict[str, int] = {}
        with pa.ipc.open_stream(ipc) as reader:
            for b in reader:
                for i in range(b.num_rows):
                    lang, shard, sizes, bits, keys, rest, n = (c[i] for c in b.columns)
                    self.shards.setdefault(lang.as_py(), {})[shard.as_py()] = _lookup(sizes.as_py(), bits.as_py(), keys.values, rest.as_py())
                    self.n_shards[lang.as_py()] = n.as_py()
        self.first = {}
        for lang, per in self.shards.items():
            size = np.array([len(per[k].of.keys) if k in per else 0 for k in range(self.n_shards[lang])])
            self.first[lang] = np.concatenate([[0], np.cumsum(size)])

    def size(self, lang: str) -> int:
        return int(self.first[lang][-1]) if lang in self.first else 0

    def slots(self, lang: str, words: pa.Array, h: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, np.int64)
        if lang in self.shards:
            shard = h % self.n_shards[lang]
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(self.n_shards[lang] + 1))
            for k, lookup in self.shards[lang].items():
                mine = order[cuts[k]:cuts[k + 1]]
                slot = lookup.slots(words.take(pa.array(mine)), h[mine])
                out[mine] = np.where(slot >= 0, slot + self.first[lang][k], -1)
        return out


# ------------------------------------------------------------- second pass

COUNTS = "lang string, source string, shard int, slot int, n long"


def _dense_counts(docs: DataFrame, ipc: bytes) -> DataFrame:
    """COUNTS of each task's documents, through the broadcast shards."""
    shared = docs.sparkSession.sparkContext.broadcast(ipc)

    def table(dense: dict[tuple[str, str], np.ndarray], first: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in dense.items():
            at = np.flatnonzero(counts)
            shard = np.searchsorted(first[lang], at, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()) for x in (lang, source)] + [
                pa.array(shard, pa.int32()), pa.array(at - first[lang][shard], pa.int32()), pa.array(counts[at], pa.int64())],
                names=["lang", "source", "shard", "slot", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, dense, seen = Vocabulary(shared.value), {}, 0
        for s, number, groups in _slices(batches, 2):
            h = hashes(s.words)
            g, word, count = s.per(number, once=False)
            seen += int(count.sum())
            cuts = np.searchsorted(g, np.arange(len(groups) + 1)).tolist()
            for lang in {group[0] for group in groups}:
                mine = [k for k, group in enumerate(groups) if group[0] == lang]
                asked = np.unique(np.concatenate([word[cuts[k]:cuts[k + 1]] for k in mine]))
                slot = np.full(len(s.words), -1, np.int64)
                slot[asked] = vocabulary.slots(lang, s.words.take(pa.array(asked)), h[asked])
                for k in mine:
                    at, n = slot[word[cuts[k]:cuts[k + 1]]], count[cuts[k]:cuts[k + 1]]
                    if (at >= 0).any():
                        if groups[k] not in dense:
                            dense[groups[k]] = np.zeros(vocabulary.size(lang), np.int32)
                        dense[groups[k]][at[at >= 0]] += n[at >= 0].astype(np.int32)
            if sum(map(len, dense.values())) > MAX_SLOTS or seen > 1 << 30:
                yield from table(dense, vocabulary.first)
                dense, seen = {}, 0
        yield from table(dense, vocabulary.first)
    return docs.select("text", "lang", "source").mapInArrow(run, COUNTS)


def _routed_counts(docs: DataFrame, shards: DataFrame, per_lang: DataFrame) -> DataFrame:
    """COUNTS through the shards' own tasks, for a vocabulary that is too large to broadcast."""
    def run(key: tuple, sent: pa.Table, shard: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("lang", pa.string()), ("source", pa.string()), ("shard", pa.int32()), ("slot", pa.int32()), ("n", pa.int64()))})
        row = shard.combine_chunks().to_batches()[0]
        lookup = _lookup(row.column("sizes")[0].as_py(), row.column("bits")[0].as_py(), row.column("keys")[0].values, row.column("rest")[0].as_py())
        slot = lookup.slots(sent.column("term").combine_chunks(), sent.column("hash").to_numpy())
        hit = slot >= 0
        got = sent.filter(pa.array(hit))
        return pa.table({"lang": got.column("lang"), "source": got.column("source"), "shard": got.column("shard"), "slot": pa.array(slot[hit], pa.int32()), "n": got.column("n")})
    sums = _term_counts(docs, ["lang", "source"], once=False).groupBy("lang", "source", "term").agg(F.first("hash").alias("hash"), F.sum("n").alias("n"))
    sent = sums.join(per_lang.select("lang", "n_shards"), "lang").withColumn("shard", F.pmod("hash", "n_shards").cast("int"))
    return sent.select("lang", "shard", "source", "term", "hash", "n").groupBy("lang", "shard") \
        .cogroup(shards.groupBy("lang", "shard")).applyInArrow(run, COUNTS)


def recount(docs: DataFrame, shards: DataFrame, per_lang: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """COUNTS of kept terms, summed over all documents."""
    size = F.octet_length("bits") + F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a + F.octet_length(k) + 8)
    if (shards.agg(F.sum(size + 200)).first()[0] or 0) <= max_broadcast:
        table = shards.join(per_lang.select("lang", "n_shards"), "lang").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table, max_chunksize=1024)
        each = _dense_counts(docs, sink.getvalue().to_pybytes())
    else:
        each = _routed_counts(docs, shards, per_lang)
    return each.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------- comparison

def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in three steps of 1000, so that nothing overflows."""
    left, out = count + 1, np.zeros_like(count)
    for _ in range(3):
        digit, left = np.divmod(left * 1000, total)
        out = out * 1000 + digit
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compare(top: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def run(key: tuple, counts: pa.Table, about: pa.Table) -> pa.Table:
        row = about.combine_chunks().to_batches()[0]
        lang, sources, totals = key[0].as_py(), row.column("sources")[0].as_py(), np.array(row.column("totals")[0].as_py(), np.int64)
        keys = row.column("keys")[0].values
        n = 0 if keys is None else len(keys)
        count = np.zeros((len(sources), n), np.int64)
        source = pc.index_in(counts.column("source"), pa.array(sources, pa.string())).to_numpy()
        count[source, counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
        n_kept = row.column("n_kept")[0].as_py()
        p = share(count, (totals + n_kept)[:, None]) if n else count
        q = share(count.sum(axis=0), int(totals.sum()) + n_kept) if n else count.sum(axis=0)
        out = {"source": [], "part": [], "item": [], "value": []}

        def add(source: str, part: str, items: list[str], values: np.ndarray) -> None:
            out["source"] += [source] * len(items)
            out["part"] += [part] * len(items)
            out["item"] += items
            out["value"] += values.tolist()
        for i, source in enumerate(sources):
            others = [j for j in range(len(sources)) if j != i]
            add(source, "pair", [sources[j] for j in others], divergence(p[i], p).sum(axis=1)[others])
            at = np.flatnonzero((count[i] > 0) & (p[i] > q))
            value = divergence(p[i, at], q[at])
            if len(at) > top:
                most = value >= np.partition(value, len(at) - top)[len(at) - top]
                at, value = at[most], value[most]
            names = keys.take(pa.array(at)).to_pylist() if n else []
            order = sorted(range(len(at)), key=lambda k: (-value[k], names[k]))[:top]
            add(source, "term", [names[k].decode() for k in order], value[order] if order else value[:0])
        return pa.table({"lang": pa.array([lang] * len(out["value"]), pa.string()), **{c: pa.array(out[c], pa.string()) for c in ("source", "part", "item")},
                         "value": pa.array(out["value"], pa.int64())})
    return run


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank of every group."""
    d = spread(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]))
    kept = stored(kept_terms(d, min_docs), "kept-terms")
    groups = stored(d.select("lang", "source").distinct(), "groups")
    most = F.greatest(F.lit(LEAST_KEYS), F.least(F.lit(MOST_KEYS), F.floor(F.lit(CELLS) / F.col("n_sources"))))
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("n_sources")) \
        .join(kept.groupBy("lang").agg(F.count("*").alias("n_kept")), "lang", "left") \
        .select("lang", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), F.ceil(F.col("n_kept") / most).cast("long").alias("n_shards"))
    per_lang = stored(per_lang, "languages")
    shards = stored(build_shards(kept, per_lang), "hashes")
    counts = stored(recount(d, shards, per_lang, max_broadcast), "counts")

    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    pair = F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total"))))
    known = totals.groupBy("lang").agg(pair.alias("x")).join(per_lang, "lang") \
        .select("lang", "n_kept", F.col("x.source").alias("sources"), F.col("x.total").alias("totals"))
    about = known.join(shards.select("lang", "shard", "keys"), "lang", "left").withColumn("shard", F.coalesce("shard", F.lit(0)))
    parts = counts.groupBy("lang", "shard").cogroup(about.groupBy("lang", "shard")) \
        .applyInArrow(_compare(top), "lang string, source string, part string, item string, value long")
    parts = stored(parts, "parts")
    pairs = parts.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, parts.where(F.col("part") == "term").select(*pairs.columns))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))


def op11(docs: DataFrame) -> DataFrame:
    return audit(docs)
