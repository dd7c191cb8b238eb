"""Fill-in-the-middle: the learned rank index, the cuts and the round trip."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import fill_in_middle as fim
from tests.llm import brute
from tests.llm.conftest import edge_rows, got, make

DOCS = [(i, t) for i, t, _ in edge_rows()]


def plain_python(doc_id, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    none = form == "plain"
    return doc_id, len(u), form, None if none else len(p), None if none else len(m), brute.sha(out), brute.sha(text)


def test_matches_plain_python(edges):
    assert got(fim.op13(edges)) == sorted((plain_python(*x) for x in DOCS), key=repr)


def test_markers_in_texts_and_beside_cuts(spark):
    texts = ["a <P> b", "<S>", "x<M>y", "<", ">", "<P", "S>", "<<>><P <S <M", "P>S>M>" * 5, "<P" * 30, "é<\U0001d4b3>漢 " * 20]
    docs = make(spark, [(100 * k + j, t, "a") for k in range(20) for j, t in enumerate(texts)])
    assert got(fim.op13(docs)) == sorted((plain_python(r.doc_id, r.text) for r in docs.collect()), key=repr)
    d = fim.fill_in_middle(docs)
    assert d.where(~fim.restore(F.col("output"), F.col("form")).eqNullSafe(F.col("text"))).count() == 0
    assert {r.form for r in d.collect()} == {"plain", "psm", "spm"}


def test_no_documents_and_clashing_columns(nothing, spark):
    assert fim.op13(nothing).collect() == []
    docs = make(spark, [(1, "one two", "a")]).withColumns({c: F.lit("x") for c in ("n", "form", "output", "prefix_chars")})
    d = fim.fill_in_middle(docs)
    assert set(d.columns) == {*docs.columns, "middle_chars"} and d.first()["n"] == 3 and d.first()["source"] == "a"
    assert got(fim.op13(docs)) == [plain_python(1, "one two")]


def offsets_of(text):
    return [0, *[m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S)]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab Z\né漢\U0001d4b3<", max_size=60)), max_size=6))
def test_boundaries_of_any_texts(texts):
    offsets, starts = fim.boundaries(pa.array(texts, pa.string()))
    assert [offsets[i:j].tolist() for i, j in zip(starts[:-1], starts[1:], strict=True)] == [offsets_of(t or "") for t in texts]
    x = fim.fit(offsets, starts)
    assert np.array_equal(x.at(np.arange(len(offsets))), offsets)


def test_index_is_exact_and_within_its_bound():
    """Very uneven texts: long words, then single characters, jumps far above the bound."""
    text = "a" * 5000 + " ." * 3000 + ("word " * 7 + "b" * 900) * 40 + "x" * 100_000
    offsets, starts = fim.boundaries(pa.array([text, "", text[:50], None]))
    x = fim.fit(offsets, starts)
    assert np.array_equal(x.at(np.arange(len(offsets))), offsets)
    assert np.abs(x.residual.astype(int)).max() <= fim.ERROR and len(x.first) < len(offsets) / 10
    even, ends = fim.boundaries(pa.array(["ab " * 10_000]))
    assert len(fim.fit(even, ends).first) == 1  # a straight line is one segment


def test_stored_index_gives_the_offsets_back(spark, edges):
    texts = {}
    for i, t in DOCS:
        texts.setdefault(i, []).append(t or "")
    for r in fim.boundary_index(edges).collect():
        lines = np.frombuffer(bytes(r.segments), [("first", "<i8"), ("offset", "<i8"), ("slope", "<f8")])
        x = fim.RankIndex(lines["first"], lines["offset"], lines["slope"], np.frombuffer(bytes(r.residuals), np.int8))
        assert x.at(np.arange(r.n + 1)).tolist() in [offsets_of(t) for t in texts[r.doc_id]]


def test_narrow_plan(spark):
    docs = spark.range(0, 100, 1, 8).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert "Exchange" not in fim.op13(docs)._jdf.queryExecution().executedPlan().toString()
