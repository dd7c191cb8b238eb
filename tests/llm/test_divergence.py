"""Source divergence audit: perfect hashes, both ways of the second pass, brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm import divergence, perfect_hash
from tests.llm import brute
from tests.llm.conftest import edge_rows, got, make, prose

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def plain_python(rows, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) of (text, lang, source)."""
    held, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, terms = lang or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(brute.LOW))
        held[lang].update(set(terms))
        count[lang, source or ""].update(terms)
    out = []
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= min_docs}
        groups = {s: c for (x, s), c in count.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out, key=repr)


def many(n=120):
    """Documents of three languages and five sources that share some words, a hot source among them."""
    rows = []
    for i in range(n):
        words = prose(i % 7, 30) + " " + prose(i % 3, 20).upper() + " één über 漢字 " + prose(1000 + i, 10)
        rows.append((words, ("en", "fr", None)[i % 5 % 3], ("a", "a", "a", "b", None, "c")[i % 6]))
    return [*rows, ("", "xx", "a"), (None, "xx", "b"), ("once", "yy", "z"), (None, None, None), ("tail " * 3, "en", "only")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string").repartition(5)


@pytest.mark.parametrize("max_broadcast", [divergence.MAX_BROADCAST, 0])
def test_matches_plain_python(spark, max_broadcast):
    rows = many()
    assert got(divergence.audit(frame(spark, rows), max_broadcast=max_broadcast), *COLUMNS) == plain_python(rows)


def test_several_shards_small_tables_and_full_slots(spark, monkeypatch):
    for name, value in (("MOST_KEYS", 20), ("LEAST_KEYS", 4), ("MAX_SLOTS", 50), ("MAX_HELD", 30)):
        monkeypatch.setattr(divergence, name, value)
    rows = many()
    for most in (divergence.MAX_BROADCAST, 0):
        assert got(divergence.audit(frame(spark, rows), top=7, max_broadcast=most), *COLUMNS) == plain_python(rows, top=7)


def test_odd_rows(spark, edges, nothing):
    rows = [(t, "en", s) for _, t, s in edge_rows()]
    assert got(divergence.op11(edges), *COLUMNS) == plain_python(rows)
    assert divergence.op11(nothing).collect() == []
    assert divergence.op11(make(spark, [(1, None, None)])).collect() == []


def test_terms_of_a_slice():
    s = divergence.Slice(pa.array(["Ab ab-AB x1y", None, "", "Éa[b]~ø\x7f"]))
    words = s.words.to_pylist()
    assert [words[c].decode() for c in s.code] == ["ab", "ab", "ab", "x", "y", "Éa", "b", "ø"] and s.doc.tolist() == [0] * 5 + [3] * 3
    g, w, n = s.per(np.zeros(4, np.int64), once=True)
    assert dict(zip([words[k].decode() for k in w], n.tolist(), strict=True)) == {"ab": 1, "x": 1, "y": 1, "Éa": 1, "b": 1, "ø": 1}


def test_perfect_hash_is_minimal_and_verified(monkeypatch):
    keys = pa.array([f"key {i}".encode() for i in range(5000)], pa.binary())
    h = perfect_hash.hashes(keys)
    look = perfect_hash.Lookup(perfect_hash.build(keys, h))
    assert sorted(look.slots(keys, h)) == list(range(5000))
    others = pa.array([f"other {i}".encode() for i in range(5000)], pa.binary())
    assert (look.slots(others, perfect_hash.hashes(others)) == -1).all()
    assert (look.slots(others, h) == -1).all()  # the hashes of keys, but other bytes
    same = np.zeros(5000, np.int64)  # hashes that nothing can part
    look = perfect_hash.Lookup(perfect_hash.build(keys, same))
    assert sorted(look.slots(keys, same)) == list(range(5000)) and (look.slots(others, same) == -1).all()
    empty = perfect_hash.Lookup(perfect_hash.build(keys[:0], h[:0]))
    assert (empty.slots(keys, h) == -1).all()


def test_shares_are_exact():
    count, total = np.array([0, 1, 6, 10**12, 3 * 10**15 - 1]), 3 * 10**15
    assert divergence.share(count, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in count]
    assert divergence.share(np.array([6]), 7).tolist() == [10**9 + 1]


def test_one_source_or_one_word_for_all(spark):
    rows = [("same", "en", "a")] * 40
    assert got(divergence.op11(frame(spark, rows)), *COLUMNS) == plain_python(rows) == []
    rows += [("same " * 50, "en", "b")]
    assert got(divergence.op11(frame(spark, rows)), *COLUMNS) == plain_python(rows)

