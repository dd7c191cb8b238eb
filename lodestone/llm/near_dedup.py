r"""MinHash near-dedup by chosen-path set similarity join.

A document is the set of its ``width``-word shingles. Equal sets are folded into one
vertex first (hot groups of copies end here). Every vertex has a sketch of
COORDS minwise values. In each of TREES independent trees a vertex walks down
from the root: a node picks one coordinate, and with chance BRANCH a second
one, so that 1/0.8 children are expected, and a vertex goes to the child named
by its minwise value there. Two sets of similarity s stay together with chance
s at each choice, so pairs at 0.8 meet in a leaf of a tree with constant
chance, and other pairs thin out. Nodes of one vertex end. After LEVELS levels
nodes of at most SMALL vertices are compared, and so are larger ones whose
pairs are similar on average (DENSE), which further choices would not split. The
others go LEVELS deeper, up to ROUNDS times, and are then compared at any size.

The trees are walked in two waves. The nodes of the FIRST trees are compared
by leaders (below) and give components, so most members of a large group of
near copies are in one component before the other trees are walked; there, a
node whose members are all of one component is dropped when its members are
counted, before it is stored or joined with anything. Pairs of one component
need no further link, so this loses nothing. Large nodes of the FIRST trees
that are not alike go deeper with those of the others.

A pair at 0.8 meets in one tree with chance 0.64, 0.48 or 0.38 at 3, 6 or 9 levels, so
trees that end at three levels are enough and deeper ones are not. The vertices of
nodes that go deeper therefore walk FURTHER more trees from the root, over a
second sketch with coordinates of its own; both ends of a pair that met in such a node do. With the
errors of both sketches and of the comparison counted, a pair at 0.8 is missed
with chance 3e-6 where nodes end at 3 or 6 levels and 4e-6 where all go to 9.

A node is compared exhaustively, but its pairs are never listed:

* first every vertex of a node is paired with one leader (the first vertex, in
  large nodes the one closest to the most frequent value of each coordinate,
  takes those near to it; the next leader comes from the rest). These pairs,
  fewer than the vertices, are confirmed on the full shingle sets and give
  components. Nodes over CHUNK vertices do so in chunks, and once more with
  one vertex per component;
* then, in the nodes that still hold several components, each pair of vertices
  of different components is compared, first by sketch, then, inside the task,
  by the full sets. Only links that join components are returned. The pairs are
  dealt out as a grid of blocks (vertices outside the node's largest component
  against all), so a block holds at most two chunks.

So any two similar sets that meet in a node end in one component. Sketches
only exclude pairs whose estimate is ERRORS standard errors below the threshold.

Components spread the smallest vertex by label passing with pointer jumping;
each round is written to the shared folder.

Null or empty texts, and texts without words, have no set and stay alone. A
null id never names a class unless all its ids are null. Repeated rows are
copies like others. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import mix64
from lodestone.llm.common import by_rows, stored

COORDS, FIRST, TREES, FURTHER, LEVELS, ROUNDS, BRANCH = 128, 3, 15, 24, 3, 3, 0.25
SMALL, CHUNK, DENSE, ERRORS = 64, 4096, 0.5, 5
MAX_BROADCAST = 2_000_000  # vertex keys of 16 bytes, counted first
SETS = "doc_id long, text_hash long, n_shingles long, set binary, sketch binary"


# ------------------------------------------------------------- sets, sketches

def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    ws = (text or b"").lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws))
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)[ids]
    n = min(width, len(ws))
    out = np.full(len(ws) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(ws) - n + 1 + k])
    return np.unique(out)


_RNG = np.random.default_rng(20)
_MUL = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64)
_MUL_2 = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD_2 = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def sketch(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """16 bits of the minwise value at each coordinate."""
    low = np.full(COORDS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(s), 1024):
        low = np.minimum(low, (s[at:at + 1024, None] * mul + add).min(axis=0))
    return (mix64(low) & np.uint64(0xFFFF)).astype("<u2")


def sets_of(docs: DataFrame, width: int, full: bool = False, second: bool = False) -> DataFrame:
    """doc_id, text_hash, n_shingles, a 16-byte name of the set (null: no set), and the
    sketch (``second``: that of the further trees); with ``full`` the sorted hashes of the set in its place."""
    mul, add = (_MUL_2, _ADD_2) if second else (_MUL, _ADD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                ns, names, data = [], [], []
                for t in b.column(2):
                    s = shingles(t.as_py(), width)
                    ns.append(len(s))
                    names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    data.append(None if not len(s) else s.tobytes() if full else sketch(s, mul, add).tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ns, pa.int64()), pa.array(names, pa.binary()), pa.array(data, pa.binary())],
                                                 names=["doc_id", "text_hash", "n_shingles", "set", "sketch"])
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary")).mapInArrow(run, SETS)


# ------------------------------------------------------------- paths

def _matrix(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), "<u2")
    return raw.reshape(-1, COORDS)


def descend(node: np.ndarray, values: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Follow each row (node, sketch) ``levels`` down: (leaf, row number). The
    coordinates a node picks follow from its name alone."""
    row = np.arange(len(node))
    for _ in range(levels):
        draw = mix64(node + np.uint64(0x632BE59BD9B4E019))
        first = (draw % np.uint64(COORDS)).astype(np.int64)
        second = ((draw >> np.uint64(16)) % np.uint64(COORDS)).astype(np.int64)
        both = ((draw >> np.uint64(40)).astype(np.float64) / (1 << 24) < BRANCH) & (second != first)
        coord = np.concatenate([first, second[both]])
        row, parent = np.concatenate([row, row[both]]), np.concatenate([node, node[both]])
        node = mix64(mix64(parent + coord.astype(np.uint64)) + values[row, coord].astype(np.uint64))
    return node, row


MEMBERS = "node long, vid long, comp long"


def _members(node: np.ndarray, ids: np.ndarray, comp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids), pa.array(comp)], names=["node", "vid", "comp"])


def _roots(vertices: DataFrame, first: int, trees: int) -> DataFrame:
    """MEMBERS of some trees after LEVELS, of (vid, sketch, comp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 4096):
                b = big.slice(at, 4096)
                v, ids, comp = _matrix(b.column("sketch")), b.column("vid").to_numpy(), b.column("comp").to_numpy()
                root = np.tile(mix64(np.arange(first, first + trees, dtype=np.uint64)), len(ids))
                node, row = descend(root, np.repeat(v, trees, axis=0), LEVELS)
                yield _members(node, ids[row // trees], comp[row // trees])
    return vertices.select("vid", "sketch", "comp").mapInArrow(run, MEMBERS)


def _deeper(members: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 4096):
                b = big.slice(at, 4096)
                node, row = descend(b.column("node").to_numpy().view(np.uint64), _matrix(b.column("sketch")), LEVELS)
                yield _members(node, b.column("vid").to_numpy()[row], b.column("comp").to_numpy()[row])
    return members.select("node", "vid", "comp", "sketch").mapInArrow(run, MEMBERS)


def _several(rows: DataFrame) -> DataFrame:
    """MEMBERS of the nodes with more than one component, and each node's size n. Stored."""
    per = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return stored(rows.join(per.where(F.col("low") < F.col("high")).select("node", "n"), "node"), "paths")


def _labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of each vid (its own number if it has no link)."""
    return rows.drop("comp").join(comp, "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))


def _dense(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The nodes whose pairs have an average similarity of DENSE or more, as
    told by about CHUNK of their vertices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            v = _matrix(t.column("sketch").combine_chunks())
            shares = [np.unique(c, return_counts=True)[1] / len(v) for c in v.T]
            if np.mean([s @ s for s in shares]) >= DENSE:
                yield pa.RecordBatch.from_arrays([t.column("node").combine_chunks()[:1]], names=["node"])
    some = rows.where(F.pmod(F.xxhash64("vid"), F.ceil(F.col("n") / CHUNK)) == 0).select("node", "vid", F.lit(0).cast("long").alias("chunk"))
    return _dealt(some, table).mapInArrow(run, "node long")


def _alike(rows: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the members of nodes (node, vid, comp, n): those of nodes to compare now, and of those to go deeper."""
    dense = stored(_dense(rows.where(F.col("n") > SMALL), table), "dense")
    told = rows.join(dense.withColumn("dense", F.lit(True)), "node", "left")
    now = (F.col("n") <= SMALL) | F.col("dense").isNotNull()
    return told.where(now).select("node", "vid"), told.where(~now).select("node", "vid", "comp")


def first_nodes(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the first wave's nodes: members (node, vid) of those that are compared, and of those that go deeper with the second wave."""
    return _alike(_several(_roots(table.withColumn("comp", F.col("vid")), 0, FIRST)), table)


def nodes(vertices: DataFrame, deeper: DataFrame, comp: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, vid) of all nodes of the second wave that are compared: those of
    the other trees, and of nodes of the first trees that go ``deeper``."""
    table = vertices.select("vid", "sketch")
    rows = _roots(_labelled(table, comp), FIRST, TREES - FIRST).unionByName(_labelled(deeper, comp).select("node", "vid", "comp"))
    done, deep = _walk(rows, table)
    if deep is not None:
        table = _sets_again(deep.distinct(), docs, vertices, width, second=True)
        done = done.unionByName(_walk(_roots(_labelled(table, comp), TREES, FURTHER), table)[0])
    return done


def _walk(rows: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, vid) of the nodes of some trees that are compared, and the vid
    of the rows that went deeper than LEVELS (None: there are none)."""
    done, deep = None, None
    for k in range(ROUNDS):
        rows = _several(rows)
        now, further = (rows.select("node", "vid"), None) if k == ROUNDS - 1 else _alike(rows, table)
        done = now if done is None else done.unionByName(now)
        if further is None or further.isEmpty():
            break
        deep = further.select("vid") if deep is None else deep
        rows = _deeper(further.join(table, "vid"))
    return done, deep


# ------------------------------------------------------------- comparing

def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal (node, chunk), which come sorted."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        key = b.column("node").to_numpy() * 1_000_003 + b.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            part = b.slice(s, e - s)
            if held and (held[-1].column("node")[0], held[-1].column("chunk")[0]) != (part.column("node")[0], part.column("chunk")[0]):
                yield pa.Table.from_batches(held)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _near(v: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (v == one).sum(axis=1)


def _least(percent: int) -> int:
    """Equal coordinates below which a pair is taken not to be at the threshold (ERRORS standard errors)."""
    p = percent / 100
    return int(np.floor(COORDS * (p - ERRORS * np.sqrt(p * (1 - p) / COORDS))))


def _leader_pairs(members: DataFrame, percent: int) -> DataFrame:
    close = int(COORDS * percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            ids, v = t.column("vid").to_numpy(), _matrix(t.column("sketch").combine_chunks())
            order = np.argsort(ids)
            ids, v = ids[order], v[order]
            left, a, b = np.arange(len(ids)), [], []
            while len(left) > 1:
                lead = 0 if len(left) <= SMALL else _middle(v[left])
                same = _near(v[left], v[left[lead]]) >= close
                same[lead] = False
                hit = left[same]
                a.append(np.minimum(ids[hit], ids[left[lead]]))
                b.append(np.maximum(ids[hit], ids[left[lead]]))
                same[lead] = True
                left = left[~same]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
    return members.mapInArrow(run, "a long, b long").distinct()


def _middle(v: np.ndarray) -> int:
    """The row that has the most frequent value at the most coordinates."""
    agree = np.zeros(len(v), np.int64)
    for column in v.T:
        values, inv, n = np.unique(column, return_inverse=True, return_counts=True)
        agree += inv == n.argmax()
    return int(agree.argmax())


def _split(t: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """Left and right rows of a block, and which pairs are asked for."""
    side = t.column("left").to_numpy()
    x, y = t.filter(pa.array(side)), t.filter(pa.array(~side))
    cx, cy, ix, iy = x.column("comp").to_numpy(), y.column("comp").to_numpy(), x.column("vid").to_numpy(), y.column("vid").to_numpy()
    asked = (cx[:, None] != cy) & (~y.column("wide").to_numpy() | (ix[:, None] < iy))
    return x, y, asked


def _near_rows(members: DataFrame, percent: int) -> DataFrame:
    """The rows of a block that have a near row of another component on the other side."""
    least = _least(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            x, y, asked = _split(t)
            vx, vy = _matrix(x.column("sketch").combine_chunks()), _matrix(y.column("sketch").combine_chunks())
            for i in range(len(x)):
                j = np.flatnonzero(asked[i])
                asked[i, j[_near(vy[j], vx[i]) < least]] = False
            for rows, keep in ((x, asked.any(axis=1)), (y, asked.any(axis=0))):
                if keep.any():
                    yield from rows.filter(pa.array(keep)).select(["node", "chunk", "vid", "comp", "wide", "left"]).to_batches()
    return members.mapInArrow(run, "node long, chunk long, vid long, comp long, wide boolean, left boolean")


def _joining_links(members: DataFrame, percent: int) -> DataFrame:
    """Links on the full sets that join components of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            x, y, asked = _split(t)
            if not len(x) or not len(y):
                continue
            sets = [np.frombuffer(v, "<u8") for v in y.column("items").to_pylist()]
            size = np.array([len(v) for v in sets])
            items, inv = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), size)[np.argsort(inv, kind="stable")]
            end = np.cumsum(np.bincount(inv, minlength=len(items)))
            n_of = np.diff(end, prepend=0)
            ix, iy, root, out = x.column("vid").to_numpy(), y.column("vid").to_numpy(), {}, []

            def find(c):
                while c in root:
                    c = root[c]
                return c
            cx, cy = x.column("comp").to_pylist(), y.column("comp").to_pylist()
            for i, mine in enumerate(x.column("items").to_pylist()):
                mine = np.frombuffer(mine, "<u8")
                at = np.minimum(np.searchsorted(items, mine), len(items) - 1)
                at = at[items[at] == mine]
                k = n_of[at]
                place = np.repeat(end[at] - np.cumsum(k), k) + np.arange(k.sum())
                both = np.bincount(owner[place], minlength=len(sets))
                for j in np.flatnonzero(asked[i] & (100 * both >= percent * (len(mine) + size - both))).tolist():
                    one, other = find(cx[i]), find(cy[j])
                    if one != other:
                        root[max(one, other)] = min(one, other)
                        out.append((min(ix[i], iy[j]), max(ix[i], iy[j])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"])
    return members.mapInArrow(run, "a long, b long").distinct()


def _dealt(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` (node, chunk, vid, ...) with ``table``'s columns by vid, the rows of a (node, chunk) in one task and together."""
    return rows.join(table, "vid").repartition("node", "chunk").sortWithinPartitions("node", "chunk")


def _sets_again(vids: DataFrame, docs: DataFrame, vertices: DataFrame, width: int, **how: bool) -> DataFrame:
    """(vid, sketch): what ``sets_of`` gives for some vertices, each from one of its documents."""
    need = stored(vertices.select("vid", "set", "doc").join(vids, "vid"), "needed")
    small = F.broadcast if need.count() <= MAX_BROADCAST else (lambda d: d)
    texts = by_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), small(need.select(F.col("doc").alias("doc_id"))), ["doc_id"], "left_semi")
    again = sets_of(texts, width, **how).select("set", "sketch")
    return stored(again.join(small(need.select("vid", "set")), "set").select("vid", "sketch").dropDuplicates(["vid"]), "sets")


def _full_sets(vids: DataFrame, docs: DataFrame, vertices: DataFrame, width: int) -> DataFrame:
    """(vid, items): the whole shingle sets of some vertices."""
    return _sets_again(vids, docs, vertices, width, full=True).withColumnRenamed("sketch", "items")


def confirm(pairs: DataFrame, docs: DataFrame, vertices: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those with 100 * intersection >= percent * union of the full sets."""
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "vid")
    full = _full_sets(ends, docs, vertices, width)
    d = pairs.join(full.select(F.col("vid").alias("a"), F.col("items").alias("x")), "a").join(
        full.select(F.col("vid").alias("b"), F.col("items").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column("x"), t.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return stored(d.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")


def _apart(pairs: DataFrame, comp: DataFrame | None) -> DataFrame:
    """The pairs (a, b) that are not in one component yet."""
    if comp is None:
        return pairs
    x, y = (comp.select(F.col("vid").alias(v), F.col("comp").alias(f"comp_{v}")) for v in ("a", "b"))
    both = pairs.join(x, "a", "left").join(y, "b", "left")
    return both.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")


def _linked(shared: DataFrame, table: DataFrame, links: DataFrame | None, comp: DataFrame | None, docs: DataFrame, vertices: DataFrame,
            width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and components after the leaders of some nodes (node, vid) are compared with their members."""
    size = shared.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK)
    chunk = F.coalesce(F.pmod(F.xxhash64("vid"), F.ceil(F.col("size") / CHUNK).cast("long")), F.lit(0).cast("long"))
    rows = shared.join(size, "node", "left").select("node", "vid", chunk.alias("chunk"))
    pairs = stored(_apart(_leader_pairs(_dealt(rows, table), percent), comp), "pairs")
    found = confirm(pairs, docs, vertices, width, percent)
    links = found if links is None else links.unionByName(found)
    comp = components(links)
    if not size.isEmpty():
        one = _open(shared, comp).where(F.col("size") > CHUNK).groupBy("node", "comps", "comp").agg(F.min("vid").alias("vid"))
        rows = one.select("node", "vid", F.pmod(F.xxhash64("vid"), F.ceil(F.col("comps") / CHUNK).cast("long")).alias("chunk"))
        links = links.unionByName(confirm(stored(_apart(_leader_pairs(_dealt(rows, table), percent), comp), "pairs"), docs, vertices, width, percent))
        comp = components(links)
    return links, comp


def _open(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (node, vid, comp) of the nodes with several components, with
    the node's size, its number of components and the largest one (top)."""
    at = shared.join(comp, "vid", "left").withColumn("comp", F.coalesce("comp", "vid"))
    per = at.groupBy("node", "comp").agg(F.count("*").alias("n"))
    several = per.groupBy("node").agg(F.count("*").alias("comps"), F.sum("n").alias("size"), F.max(F.struct("n", "comp"))["comp"].alias("top"))
    return at.join(several.where(F.col("comps") > 1), "node")


def _grid(members: DataFrame) -> DataFrame:
    """Blocks of the pairs (outside the largest component, any): a row is
    left in the blocks of its line and right in those of its column."""
    n = F.ceil(F.col("size") / CHUNK).cast("long")
    mine = F.pmod(F.xxhash64("vid"), n)
    d = members.withColumn("wide", F.col("comp") != F.col("top")).withColumn("n", n).withColumn("mine", mine)
    each = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    left = d.where("wide").select("node", "vid", "comp", "wide", F.lit(True).alias("left"), F.explode(F.transform(each, lambda k: F.col("mine") * F.col("n") + k)).alias("chunk"))
    right = d.select("node", "vid", "comp", "wide", F.lit(False).alias("left"), F.explode(F.transform(each, lambda k: k * F.col("n") + F.col("mine"))).alias("chunk"))
    return left.unionByName(right)


# ------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(vid, comp) of every vertex with a link: the smallest vertex reachable."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("vid"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(label.select(F.col("vid").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        met = label.join(near, label["vid"] == near["a"]).select("vid", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        jump = label.select(F.col("vid").alias("at"), F.col("comp").alias("further"))
        moved = stored(met.join(jump, met["comp"] == jump["at"]).select("vid", "was", F.least("comp", "further").alias("comp")), "labels")
        label = moved.select("vid", "comp")
        if moved.where(F.col("was") != F.col("comp")).isEmpty():
            return label


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document, and text_hash
    (xxhash64, to tell rows of one id apart); ``leads`` is true for one (doc_id,
    text_hash) of each class, the smallest with null ids last, and for every row without a set; links are pairs with 100 * intersection >= ``percent`` * union of ``width``-word shingles."""
    sets = stored(sets_of(docs, width), "shingles")
    vertices = sets.where(F.col("set").isNotNull()).groupBy("set").agg(
        F.min("doc_id").alias("doc"), F.first("sketch").alias("sketch"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("lead"))
    vertices = stored(vertices.withColumn("vid", F.monotonically_increasing_id()), "vertices")
    table = vertices.select("vid", "sketch")
    now, deeper = first_nodes(table)
    links, comp = _linked(now, table, None, None, docs, vertices, width, percent)
    then = nodes(vertices, deeper, comp, docs, width)
    links, comp = _linked(then, table, links, comp, docs, vertices, width, percent)
    shared = now.unionByName(then)

    near = stored(_near_rows(_dealt(_grid(_open(shared, comp)), table), percent), "near")
    if not near.isEmpty():
        full = _full_sets(near.select("vid").distinct(), docs, vertices, width)
        more = stored(_joining_links(_dealt(near, full), percent), "links")
        comp = components(links.unionByName(more))

    member = vertices.select("vid", "set", "doc", "lead").join(comp, "vid")
    least = member.groupBy("comp").agg(F.min("doc").alias("component_id"), F.min("lead").alias("leader"))
    named = member.select("comp", "set").join(least, "comp").select("set", "component_id", "leader")
    alone = vertices.join(comp, "vid", "left_anti").select("set", F.col("doc").alias("component_id"), F.col("lead").alias("leader"))
    d = sets.select("doc_id", "text_hash", "n_shingles", "set").join(named.unionByName(alone), "set", "left")
    comp_id = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    leads = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    one = F.col("set").isNull() | leads.eqNullSafe(F.col("leader"))
    return d.select("doc_id", "text_hash", "n_shingles", comp_id.alias("component_id"), F.col("doc_id").eqNullSafe(comp_id).alias("kept"), one.alias("leads"))


def op6(docs: DataFrame) -> DataFrame:
    return near_dedup(docs.select("doc_id", "text"), width=4).drop("text_hash", "leads")
