r"""Fill-in-the-middle examples cut by a learned rank index.

A text is n units (runs of ASCII letters, or any other single character). Two
cuts are drawn from the SHA-256 of a seed and the doc_id, so reruns agree:
prefix, middle and suffix are put out in the order prefix, suffix, middle
(``psm``) or suffix, prefix, middle (``spm``), each behind its marker. A text
that is empty or holds a marker, and the share drawn for it, stays ``plain``.

The cuts are ranks of units; the text is cut by character offsets. ``fit``
learns the offset of every boundary of a text as a function of its rank: a
segment is a line from its first to its last boundary, rounded down; one that
is more than ``ERROR`` characters off at any boundary is halved, until all
are within the bound (a single boundary always is). What a line is off is
kept in one signed byte a boundary, so a cut is predicted by its segment and
corrected exactly by its residual. ``boundary_index`` gives the segments and
residuals as a table, ``fill_in_middle`` applies them where they are fitted.

All work is narrow: no shuffle but the dealing out of inputs with fewer
splits than cores. Tasks hold slices of at most 4 MB of text, or one longer
text with about thirty bytes for each byte of it.

Null text is empty; a null doc_id is drawn as the empty id. Repeated rows give
the same example. Columns of the documents that are called like a result
column are replaced; others go through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lodestone.llm.common import pieces
from lodestone.llm.runs import flat
from lodestone.session import spread

ERROR = 127  # a residual is one signed byte
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class RankIndex(NamedTuple):
    """Lines over the ranks of boundaries: from rank ``first`` on, the offset
    is ``offset`` plus ``slope`` per rank, rounded down, plus the residual."""
    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def at(self, rank: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, rank, side="right") - 1
        return self.offset[s] + np.floor(self.slope[s] * (rank - self.first[s])).astype(np.int64) + self.residual[rank]


def fit(offsets: np.ndarray, starts: np.ndarray) -> RankIndex:
    """The index of the boundary offsets of several texts, one after the
    other; ``starts`` are the ranks at which a text begins, and the end."""
    residual = np.zeros(len(offsets), np.int8)
    found = []
    s, e = starts[:-1], starts[1:]
    while len(s):
        n = e - s
        slope = (offsets[e - 1] - offsets[s]) / np.maximum(n - 1, 1)
        before = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(before, n)
        rank = np.repeat(s, n) + step
        off = offsets[rank] - np.repeat(offsets[s], n) - np.floor(np.repeat(slope, n) * step).astype(np.int64)
        ok = np.maximum.reduceat(np.abs(off), before) <= ERROR
        within = np.repeat(ok, n)
        residual[rank[within]] = off[within]
        found.append((s[ok], offsets[s[ok]], slope[ok]))
        s, e = s[~ok], e[~ok]
        middle = (s + e) // 2
        s, e = np.concatenate([s, middle]), np.concatenate([middle, e])
    first, offset, slope = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    order = np.argsort(first)
    return RankIndex(first[order], offset[order], slope[order], residual)


def boundaries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, starts): the character offset of every boundary of every
    text, 0 and the length included, and the ranks at which a text begins."""
    data, at = flat(column)
    character = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    begins = character.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[at[:-1][at[:-1] < len(data)]] = True
    unit = np.flatnonzero(begins)
    seen = np.concatenate([[0], np.cumsum(character, dtype=np.int64)])  # characters before each byte
    first = np.searchsorted(unit, at)  # units before each text
    n = np.diff(first)
    starts = first + np.arange(len(at))  # one boundary more than units in each text
    offsets = np.zeros(starts[-1], np.int64)
    last = starts[1:] - 1
    inner = np.ones(len(offsets), bool)
    inner[last] = False
    offsets[inner] = seen[unit] - np.repeat(seen[at[:-1]], n)
    offsets[last] = seen[at[1:]] - seen[at[:-1]]
    return offsets, starts


def boundary_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n, segments (little-endian first rank, offset and slope, 24
    bytes each) and residuals (a signed byte per boundary) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in pieces(big, 1, rows=10_000):
                offsets, starts = boundaries(b.column(1))
                x = fit(offsets, starts)
                cuts = np.searchsorted(x.first, starts)
                kind = np.dtype([("first", "<i8"), ("offset", "<i8"), ("slope", "<f8")])
                lines = np.zeros(len(x.first), kind)
                lines["first"], lines["offset"], lines["slope"] = x.first - np.repeat(starts[:-1], np.diff(cuts)), x.offset, x.slope
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array(np.diff(starts) - 1),
                    pa.array([lines[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    pa.array([x.residual[i:j].tobytes() for i, j in zip(starts[:-1], starts[1:], strict=True)], pa.binary())],
                    names=["doc_id", "n", "segments", "residuals"])
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))) \
        .mapInArrow(run, "doc_id long, n long, segments binary, residuals binary")


def _draw(doc_id: Column, seed: str, k: int) -> Column:
    """The k-th (from 1) group of 8 hex digits of sha256(seed:doc_id) as a number."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 8 * k - 7, 8), 16, 10).cast("long")


def _cuts(docs: DataFrame) -> DataFrame:
    """``docs`` (with __h1, __h2) with __n units and the characters before
    the two cuts, __a and __b."""
    names = docs.columns
    text, h = names.index("text"), [names.index("__h1"), names.index("__h2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in pieces(big, text, rows=10_000):
                offsets, starts = boundaries(b.column(text))
                x, n = fit(offsets, starts), np.diff(starts) - 1
                ranks = [b.column(k).to_numpy() % (n + 1) for k in h]
                cuts = [x.at(starts[:-1] + f(*ranks)) for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n), *map(pa.array, cuts)], names=[*names, "__n", "__a", "__b"])
    more = [StructField(c, LongType()) for c in ("__n", "__a", "__b")]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))


def fill_in_middle(docs: DataFrame, seed: str = "1", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """The documents with n (units), form, prefix_chars, middle_chars (null
    if plain) and output. Of a hundred, ``plain_from`` on stay plain and the
    first ``spm_below`` of the others are spm."""
    d = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))) \
        .withColumns({f"__h{k}": _draw(F.col("doc_id"), seed, k) for k in (1, 2)})
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (_draw(F.col("doc_id"), seed, 3) % 100 >= plain_from)
    form = F.when(plain, "plain").when(_draw(F.col("doc_id"), seed, 4) % 100 < spm_below, "spm").otherwise("psm")
    d = _cuts(spread(d)).withColumns({"form": form, "n": F.col("__n")})
    a, b = F.col("__a").cast("int"), F.col("__b").cast("int")
    prefix, middle, suffix = F.substring(text, F.lit(1), a), F.substring(text, a + 1, b - a), F.substring(text, b + 1, F.length(text))
    output = F.when(F.col("form") == "plain", text) \
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)) \
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut = F.col("form") != "plain"
    return d.withColumns({"prefix_chars": F.when(cut, F.col("__a")), "middle_chars": F.when(cut, F.col("__b") - F.col("__a")), "output": output}) \
        .drop("__h1", "__h2", "__n", "__a", "__b")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts of psm and spm hold no
    marker, and no marker can begin inside another, so the first is the one that was put in."""
    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        first = F.substring_index(F.substring(output, F.lit(len(one) + 1), F.length(output)), two, 1)
        rest = F.substring(output, F.length(first) + F.lit(len(one + two) + 1), F.length(output))
        second = F.substring_index(rest, MIDDLE, 1)
        return first, second, F.substring(rest, F.length(second) + F.lit(len(MIDDLE) + 1), F.length(output))
    p, s, m = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(p, m, s)).otherwise(F.concat(p2, m2, s2))


def op13(docs: DataFrame) -> DataFrame:
    d = fill_in_middle(docs.select("doc_id", "text")).withColumn("restored", restore(F.col("output"), F.col("form")))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                    *[F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")])
