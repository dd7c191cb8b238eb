"""Packing: ids as the tokenizer gives them, every id in one piece, full windows, neighbours that are alike."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodestone.llm import byte_bpe, packing
from tests.llm.conftest import edge_rows, make, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(PATH)


def same(encoder, library, texts):
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab'strvelmd  \n\t\xa0  1٣.,!é漢́\x1c\x85​\U0001d4b3͸'", max_size=14)), max_size=6))
def test_ids_of_any_texts(encoder, library, texts):
    same(encoder, library, texts)


def test_ids_of_long_texts_contractions_and_special_tokens(encoder, library, monkeypatch):
    texts = ["we'll they've I'm you're it's don't 'tis ''s '' 's", "a <|endoftext|> b  <|endoftext|>", " x\n\n\n y \t z  ", "x" * 3000, prose(5, 2000), "漢字 かな 한국 русский", None, ""]
    same(encoder, library, texts)
    monkeypatch.setattr(byte_bpe, "PART", 50)
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 20)
    same(encoder, library, [*texts, " a" * 400, "a  b" * 90])


def test_words_by_the_library_if_ids_are_not_in_order(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_word_encoder", lambda vocab, merges: None)
    same(byte_bpe.Encoder(PATH), library, ["some words, it's 12 of them", "é漢"])


def checked(rows, library, df, size):
    """All pieces of all rows, each id once, sequences gapless; the sequences as {id: [(doc_id, start, length)]}."""
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        assert len(r.ids) == 4 * r.length and r.length > 0
        docs[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for (i, n), rs in docs.items():
        rs.sort(key=lambda r: r.start)
        copies = sum(v for (d, m, _), v in want.items() if (d, m) == (i, n))
        at = defaultdict(int)
        for r in rs:
            for k in range(r.start, r.start + r.length):
                at[k] += 1
        assert at == dict.fromkeys(range(n), copies)
        if copies == 1:
            assert (i, n, zlib.crc32(b"".join(bytes(r.ids) for r in rs))) in want
    assert {(i, n) for i, n, _ in want} == set(docs)
    for rs in sequences.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))] and sum(r.length for r in rs) <= size
    return sequences


def test_odd_rows(spark, edges, nothing, library):
    sequences = checked(edge_rows(), library, packing.pack(edges, PATH), 1024)
    assert sum(sum(r.length for r in s) < 1024 for s in sequences.values()) <= 1
    assert packing.op12(nothing).collect() == []
    got = packing.op12(make(spark, [(1, None, None)])).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, zlib.crc32(bytes(4)), 1, got[0].sequence_id, 0)]


def test_small_windows_shards_and_a_hot_group(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "ROWS", 16)
    rows = [(i, prose(i % 40, 5 + i % 60), "a") for i in range(150)] + [(1000 + i, "the same text " * 4, "b") for i in range(80)] + [(7000, "exact", "c")] * 3
    df = packing.pack(make(spark, rows).repartition(4), PATH, size=64)
    sequences = checked(rows, library, df, 64)
    short = [s for s in sequences.values() if sum(r.length for r in s) < 64]
    assert len(short) <= 2 * (len(rows) // 16 + 1)  # one for each shard
    hot = {r.sequence_id >> 21 for s in sequences.values() for r in s if 1000 <= r.doc_id < 1080}
    assert len(hot) >= 4  # the copies are spread over shards


def test_neighbours_share_words():
    """In a shard of documents of four topics, windows are mostly of one topic."""
    rng = random.Random(3)
    topics = [rng.sample(range(1000), 40) for _ in range(4)]
    texts = [np.array([rng.choice(topics[k % 4]) for _ in range(30)] + [2000 + j for j in range(5)], "<u4") for k in range(80)]
    ids = pa.array([t.tobytes() for t in texts], pa.binary())
    found = {int(t): sum(t in x for x in texts) for t in np.unique(np.concatenate(texts))}
    rows = packing.fill(packing.idf(found, 80), 35.0, ids, np.full(80, 35), 140)
    windows = defaultdict(set)
    for piece, _, _, window, _ in rows:
        windows[window].add(piece % 4)
    assert sum(len(w) == 1 for w in windows.values()) >= 16 and len(windows) == 20


def test_reruns_agree(spark):
    docs = make(spark, [(i, prose(i, 20 + i % 50), "a") for i in range(60)]).repartition(3)
    one, two = (sorted((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in packing.op12(docs).collect()) for _ in range(2))
    assert one == two
