import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, block string, row string, size string, score string, "
          "key string, shard string, node string, host string, target string, spans string")


def make(spark, rows):
    """Documents from (doc_id, text, source), with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *["x"] * 10) for i, t, s in rows], SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


SHARED = "This line is shared by many documents of the corpus."
LONG = " ".join(prose(k, 400) for k in range(40))


def edge_rows():
    """Null ids, texts and sources, empty and very long texts, repeated rows, ties, shared lines and passages."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 40)
    rows = [(1, base, "a"), (2, base, "a"), (3, " ".join(near), "b"), (4, None, "a"), (5, "", None), (6, " \t\n", "b"), (7, "one two", "c"),
            (8, "One  TWO", "c"), (9, LONG, "a"), (10, LONG + " tail", "a"), (11, "x" * 300, "b"), (12, "Überraß é 漢字 𝒳 " * 12, "d"),
            (13, "same same same same same same same same same same same", "d"), (None, prose(3, 30), None), (None, None, None)]
    rows += [(20 + k, f"{prose(30 + k, 12)}\n  {SHARED if k % 2 else SHARED.upper()}\t\n{prose(50 + k, 9)}\n{passage}", "a") for k in range(8)]
    rows += [(40, prose(4, 50), "e"), (40, prose(4, 50), "e"), (41, f"a\n{SHARED}\n{SHARED}\n\nb", "e")]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return make(spark, edge_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, [])


def got(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
