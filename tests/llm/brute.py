"""Plain Python statements of the contracts, for small fixtures."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def mod(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def rules(text):
    text = text or ""
    w = words(text)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    rep = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def contaminated(docs, items):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    wins = defaultdict(set)
    for item, text in items:
        w = tok(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[i:i + 10])].add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, ids = tok(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in wins:
                    hit |= set(range(i, i + n))
                    ids |= wins[k]
        out.append((doc_id, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def near(docs, width=4, percent=80):
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    group = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        group[find(i)].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in group.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d, d == (least[find(i)] if sets[i] else d)) for i, (d, _) in enumerate(docs)]


def lines(docs, chars=40, least=5):
    key = lambda x: x.strip(SPACE).translate(LOW)
    held = defaultdict(list)
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= chars:
                held[k].append(d)
    common = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(v) >= least}
    out = []
    for d, t in docs:
        every = (t or "").split("\n")
        stay = [x for x in every if key(x) not in common or common[key(x)] == d]
        out.append((d, len(every), len(every) - len(stay), sha("\n".join(stay))))
    return out


def suffixes(docs):
    """In the given order of documents."""
    seen, out = set(), []
    for d, t in docs:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            k = b[p:p + 100]
            if k in seen:
                cover[p:p + 100] = b"\x01" * 100
            seen.add(k)
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((d, len(b), sum(cover), len(re.findall(b"\x01+", bytes(cover))), sha(kept)))
    return out


def secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 6)
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out += [(m.start(), 1, m.end())] * (len(m[0]) >= 20)
    for m in re.finditer("[0-9a-f]+", text):
        out += [(m.start(), 2, m.end())] * (len(m[0]) >= 24)
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out)), Counter(k for _, k, _ in out)
