r"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words (all of them, to the end).
Each passage is encoded by hashed word and word-shape counts plus a few surface
rates, then by a learned layer, h = tanh(x W). Gated attention weighs the
passages, a = softmax(w' (tanh(V h) * sigmoid(U h))), and a logistic unit
scores the weighted sum z = sum a h. Weights are learned from document labels
alone, with Adam, on the driver.

The fit reads a bounded sample: the ``MAX_FIT`` labelled training rows with the
smallest hashes of their ids, each with all its passages, in this order until they
have MAX_FIT * FIT_PASSAGES passages or more together; the row that reaches this number is
the last one and is whole too. Tasks count and encode the passages, so the driver gets at most that
many rows of features (100 MB) and those of one text more. The two classes count alike. Scoring covers every passage of
every document, batch by batch in ``mapInArrow``; the model is some 100 KB and goes
out with the function. Only the text enters a score.

Null or empty texts are one empty passage and get the score of that. Labels
other than 0 and 1 are not used; a document with several labels counts once
for each. Without usable labels, or with one class only, every score is the
share of 1 (0.5 without any). Rows are scored one by one, so repeated rows and
null ids change nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lodestone.llm.common import pieces, read_table, remainder

PASSAGE, BINS, RATES, HIDDEN, GATE = 64, 192, 10, 32, 16
MAX_FIT, FIT_PASSAGES, EPOCHS = 4000, 32, 30
FEATURES = BINS + RATES


def _word_row(w: str) -> tuple:
    """(word bin, shape bin, letters, symbols, capitals, digits, length)."""
    n = len(w)
    alpha = sum(c.isalpha() for c in w)
    digit = sum(c.isdigit() for c in w)
    caps = sum(c.isupper() for c in w)
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w[:3] + w[-3:])
    half = BINS // 2
    return zlib.crc32(w.lower().encode()) % half, half + zlib.crc32(shape.encode()) % half, alpha, n - alpha - digit, caps, digit, n


class Encoder:
    """Texts to passage features; remembers frequent words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.rows: list[tuple] = []

    def _ids(self, ws: list[str]) -> np.ndarray:
        known, rows, out = self.known, self.rows, []
        for w in ws:
            i = known.get(w)
            if i is None:
                i = known[w] = len(rows)
                rows.append(_word_row(w))
            out.append(i)
        return np.array(out, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(passages x FEATURES, first passage of each text)."""
        if len(self.rows) > 200_000:  # a bound on memory; no result depends on it
            self.known, self.rows = {}, []
        passage, ids, starts, lines, n = [], [], [], [], 0
        for text in texts:
            text = text or ""
            ws = text.split()
            k = max(1, -(-len(ws) // PASSAGE))
            starts.append(n)
            if ws:
                ids.append(self._ids(ws))
                passage.append(np.arange(len(ws)) // PASSAGE + n)
            lines += [text.count("\n") / (len(ws) + 1)] * k
            n += k
        i = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        p = np.concatenate(passage) if passage else np.zeros(0, np.int64)
        # only the words at hand: the table of a long run is large
        used, local = np.unique(i, return_inverse=True)
        table = np.array([self.rows[j] for j in used], np.float64).reshape(-1, 7)
        x = np.zeros((n, FEATURES), np.float32)
        if len(i):
            r = table[local]
            counts = np.bincount(p, minlength=n).astype(np.float64)
            for c in (0, 1):
                x[:, :BINS] += np.bincount(p * BINS + r[:, c].astype(np.int64), minlength=n * BINS).reshape(n, BINS).astype(np.float32)
            x[:, :BINS] = np.sqrt(x[:, :BINS] / np.maximum(counts, 1)[:, None])
            sums = [np.bincount(p, r[:, c], n) for c in range(2, 7)]
            chars = np.maximum(sums[4], 1)
            pairs = np.unique(p * (len(used) + 1) + local)
            distinct = np.bincount(pairs // (len(used) + 1), minlength=n)
            same = np.zeros(n)
            if len(i) > 1:
                same = np.bincount(p[1:], (i[1:] == i[:-1]) & (p[1:] == p[:-1]), n)
            x[:, BINS:BINS + 8] = np.stack([
                sums[0] / chars, sums[1] / chars * 3, sums[2] / chars, sums[3] / chars * 3, chars / np.maximum(counts, 1) / 10,
                distinct / np.maximum(counts, 1), same / np.maximum(counts, 1), np.log1p(counts) / 4], 1)
        x[:, BINS + 8] = np.minimum(np.array(lines, np.float32) * 5, 2)
        x[:, BINS + 9] = 1
        return x, np.array(starts, np.int64)


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def forward(m: dict, x: np.ndarray, starts: np.ndarray) -> dict:
    bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    h = np.tanh(x @ m["W"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * g) @ m["w"]
    e = np.exp(np.clip(e - np.maximum.reduceat(e, starts)[bag], -60, 0))
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(h * a[:, None], starts, axis=0)
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ m["c"] + m["b"])}


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 7) -> dict:
    """Learn the attention model from bags and their labels."""
    rng = np.random.default_rng(seed)
    shapes = {"W": (FEATURES, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": (1,)}
    m = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k != "b" else np.zeros(1) for k, s in shapes.items()}
    mean, var, step = {k: 0.0 for k in m}, {k: 0.0 for k in m}, 0
    ends = np.append(starts[1:], len(x))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            xs = np.concatenate([x[starts[i]:ends[i]] for i in batch])
            at = np.concatenate([[0], np.cumsum((ends - starts)[batch])[:-1]])
            f = forward(m, xs, at)
            d = weight[batch] * (f["p"] - y[batch]) / len(batch)
            dz = d[:, None] * m["c"]
            da = (f["h"] * dz[f["bag"]]).sum(1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, at)[f["bag"]])
            dg = de[:, None] * m["w"]
            dt, ds = dg * f["g"] * (1 - f["t"] ** 2), dg * f["t"] * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz[f["bag"]] + dt @ m["V"].T + ds @ m["U"].T
            grad = {"W": xs.T @ (dh * (1 - f["h"] ** 2)), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["g"]).T @ de,
                    "c": f["z"].T @ d, "b": d.sum(keepdims=True)}
            step += 1
            for k in m:
                g = grad[k] + 1e-4 * m[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.999 * var[k] + 0.001 * g * g
                m[k] = m[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.999 ** step)) + 1e-8)
    return m


def train(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT, budget: int = MAX_FIT * FIT_PASSAGES) -> dict | float:
    """Fit on at most ``max_fit`` labelled rows that are not held out, whole
    rows until they have ``budget`` passages; a plain
    number (the share of 1) where the labels have one class or none."""
    usable = labels.where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), 3) != 1) & F.col("doc_id").isNotNull())
    chosen = usable.select("doc_id", F.col("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_fit)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id").alias("key"), F.col("doc_id").cast("string").alias("id"), F.col("y").cast("double").alias("y"),
        F.xxhash64("text").alias("hash"), "text")
    order = ["key", "id", "y", "hash"]
    rows = found.mapInArrow(_sizes, "key long, id string, y double, hash long, n long").orderBy(*order).limit(max_fit).collect()
    reach = np.cumsum([r["n"] for r in rows])
    rows = rows[:int(np.searchsorted(reach, budget)) + 1]
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    last = F.struct(*[F.lit(rows[-1][c]).cast(t).alias(c) for c, t in zip(order, ("long", "string", "double", "long"), strict=True)])
    bags = found.where(F.struct(*order) <= last).dropDuplicates(order).mapInArrow(
        lambda batches: _bags(batches, None), "key long, id string, y double, hash long, x binary")
    x_of = {tuple(r[c] for c in order): np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in bags.collect()}
    xs = [x_of[tuple(r[c] for c in order)] for r in rows]
    starts = np.cumsum([0, *map(len, xs[:-1])])
    return fit(np.concatenate(xs).astype(np.float64), starts, y)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text, last column, as its number of passages."""
    for b in batches:
        n = [max(1, -(-len((t.as_py() or "").split()) // PASSAGE)) for t in b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=["key", "id", "y", "hash", "n"])


def _bags(batches: Iterator[pa.RecordBatch], most: int | None = FIT_PASSAGES) -> Iterator[pa.RecordBatch]:
    """The text, last column, as the features of its passages: all of them (None, as the fit asks), or ``most`` spread evenly."""
    enc = Encoder()
    for big in batches:
        for b in pieces(big, big.num_columns - 1, 256):
            data = []
            for text in b.column(b.num_columns - 1).to_pylist():
                x, _ = enc.encode([text])
                if most is not None and len(x) > most:
                    x = x[np.linspace(0, len(x) - 1, most).astype(int)]
                data.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(data, pa.binary())], names=["key", "id", "y", "hash", "x"])


def score(docs: DataFrame, model: dict | float, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``column``, the score of its ``text``."""
    small = model if isinstance(model, float) else {k: v.astype(np.float32) for k, v in model.items()}
    names = [*docs.columns, column]
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder()
        for b in batches:
            for part in pieces(b, at_text, 256):
                texts = part.column(at_text).to_pylist()
                if isinstance(small, float):
                    p = np.full(len(texts), small)
                else:
                    p = forward(small, *enc.encode(texts))["p"].astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], names=names)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    d = score(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return d.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
