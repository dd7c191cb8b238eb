"""Token ids of many texts at once, by a byte-level BPE tokenizer file.

A byte-level BPE tokenizer cuts a text into words by a fixed pattern and then
encodes each word by itself. Here the words of a few megabytes of texts are
found with whole-array steps, each distinct word is encoded once, and the ids
of all words are gathered. Words are encoded by ``tiktoken`` with the ranks of
the file's own vocabulary, if that is numbered in the order of its merges (the
two libraries then agree), and else by ``tokenizers``.

The pattern is the one such tokenizers use:
``'s|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|white space before the last of it|white space``.
Texts with characters outside the Basic Multilingual Plane or unassigned ones,
and texts that hold the name of a special token, are encoded whole by ``tokenizers``.
Texts over ``PART`` bytes are taken in parts that end between a letter and a
blank before a letter, where every word ends.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestone.llm.runs import cut, flat, owners

KNOWN_WORDS = 400_000  # encoded words a task keeps
PART = 1 << 20
_MARK = "\uffff"  # no character
_SAFE = re.compile(rb"[A-Za-z](?= [A-Za-z])")
_LETTER, _DIGIT, _SPACE, _OTHER, _UNSURE = range(5)
_WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def _classes() -> np.ndarray:
    """The class of each character of the Basic Multilingual Plane."""
    kinds = {"L": _LETTER, "N": _DIGIT, "C": _OTHER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x10000)], np.uint8)
    out[[c for c in range(0x10000) if unicodedata.category(chr(c)) in ("Cn", "Cs")]] = _UNSURE
    out[_WHITE] = _SPACE
    return out


def words(chars: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions where a word begins. ``chars`` are the code points of some
    texts, ``kind`` their classes and ``at`` where the texts begin (and the end)."""
    n = len(chars)
    first = np.zeros(n + 1, bool)
    first[at] = True
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    # the last white space before something else stands alone, or a blank goes with what follows
    last = (kind == _SPACE) & ~first[1:]
    last[:-1] &= kind[1:] != _SPACE
    last[-1] = False
    at_last = np.flatnonzero(last)
    begins[at_last] = True
    begins[at_last[chars[at_last] == 32] + 1] = False
    # an apostrophe at the begin of a word, with the letters of a contraction
    mark = np.flatnonzero((chars == 39) & begins[:n])
    if len(mark):
        padded, stop = np.concatenate([chars, [0, 0]]), np.concatenate([first, [True, True]])
        one, two = padded[mark + 1], padded[mark + 2]
        one, two = np.where(stop[mark + 1], 0, one), np.where(stop[mark + 1] | stop[mark + 2], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        begins[mark[short | long] + 1] = False
        begins[mark[long] + 2] = False
        begins[np.concatenate([mark[short] + 2, mark[long] + 3])] = True
    return np.flatnonzero(begins[:n])


def _byte_names() -> dict[str, int]:
    """The characters by which such vocabularies write the 256 bytes: printable ones as they are, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _word_encoder(vocab: dict[str, int], merges: list) -> Callable[[str], np.ndarray] | None:
    """The ids of words that ``_MARK`` parts, marks included; None if the ids do not follow the order of the merges."""
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    if [vocab.get(m) for m in joined] != list(range(256, 256 + len(joined))):
        return None
    import tiktoken
    names = _byte_names()
    ranks = {bytes(names[c] for c in t): i for t, i in vocab.items() if i < 256 + len(joined)}
    return tiktoken.Encoding("words", pat_str=f"[^{_MARK}]+|{_MARK}", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy


class Encoder:
    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.special = [t["content"] for t in file["added_tokens"]]
        self.word = _word_encoder(file["model"]["vocab"], file["model"]["merges"])
        self._forget()

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _numbers(self, distinct: list[bytes]) -> np.ndarray:
        """The number of each distinct word; ``ids`` and ``ends`` hold the ids of all numbered words."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        if new:
            ids, size = self._encoded(new)
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, one after the other, and how many each has."""
        text = _MARK.encode().join(words)
        if self.word is None or text.count(_MARK.encode()) != len(words) - 1:
            got = [self._whole(w.decode()) for w in words]
            return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got])
        ids, mark = self.word(text.decode()), self.word(_MARK)
        at = np.flatnonzero(np.all([ids[k:len(ids) - len(mark) + 1 + k] == m for k, m in enumerate(mark)], axis=0))
        keep = np.ones(len(ids), bool)
        for k in range(len(mark)):
            keep[at + k] = False
        return ids[keep], np.append(at, len(ids)) - np.append(0, at + len(mark))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), and where each text's begin (and the end)."""
        data, at = flat(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        if len(data) <= PART or (np.diff(at) <= PART).all():
            return self._short(data, at)
        parts = [at[:1]]
        for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            mine, here = [], start
            while end - here > PART and (safe := _SAFE.search(data, here + PART, end)):
                here = safe.end()
                mine.append(here)
            parts.append(np.array([*mine, end], np.int64))
        cuts = np.concatenate(parts)
        got = [self._short(data[i:j], np.array([0, j - i])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        ends = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in got])])
        return np.concatenate([ids for ids, _ in got]), ends[np.cumsum([0] + [len(p) for p in parts[1:]])]

    def _short(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        at_char = np.searchsorted(byte_of, at)
        beyond = chars > 0xFFFF
        kind = _classes()[np.where(beyond, 0, chars)] if beyond.any() else _classes()[chars]
        kind[beyond] = _UNSURE
        hard = np.zeros(len(at) - 1, bool)
        hard[owners(at_char, np.flatnonzero(kind == _UNSURE))] = True
        texts = cut(data, at)
        for name in self.special:
            hard |= np.asarray(pc.match_substring(texts, name), bool)
        begin = words(chars, kind, at_char)
        coded = cut(data, np.append(byte_of[begin], len(data))).dictionary_encode()
        found, edge = flat(coded.dictionary)
        found, edge = found.tobytes(), edge.tolist()
        number = self._numbers([found[i:j] for i, j in zip(edge[:-1], edge[1:], strict=True)])[coded.indices.to_numpy()]
        size = self.ends[number + 1] - self.ends[number]
        stop = np.cumsum(size)
        out = self.ids[np.repeat(self.ends[number] - stop + size, size) + np.arange(stop[-1])]
        starts = np.concatenate([[0], stop])[np.searchsorted(begin, at_char)]
        if not hard.any():
            return out, starts
        ids = [np.array(self._whole(t.as_py().decode()), np.uint32) if hard[k] else out[starts[k]:starts[k + 1]] for k, t in enumerate(texts)]
        return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])
