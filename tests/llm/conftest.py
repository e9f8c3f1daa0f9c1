import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, cls string, k string, size string, h string, range string"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, ties, copies, near copies and clashing extra columns."""
    rng = random.Random(11)
    out = []
    base = prose(rng, 120, 5000)
    for i in range(60):
        text = prose(rng, rng.randrange(1, 160), 5000)
        if i % 6 == 0:
            text = base
        elif i % 6 == 1:
            words = base.split()
            words[rng.randrange(len(words))] = "edited"
            text = " ".join(words)
        out.append((i, text, "en", f"s{i % 4}" if i % 3 else "s0"))
    out += [(100, "", "en", "s1"), (101, None, "en", None), (102, "one", None, None), (103, "One two", "fr", "s1"),
            (104, "one TWO", "fr", "s2"), (105, " \t\n", "fr", "s2"), (106, prose(rng, 30_000, 90), "fr", "s9"),
            (None, "text without id one two three", "en", "s1"), (None, "text without id one two three", "en", "s1"),
            (None, None, None, None), (7, out[7][1], "en", out[7][3]), (107, "€ünïcödé ß 日本語 𝒳 text", "de", "ß"),
            (108, "12 34 !!", "de", "s1")]
    return [(d, t, lang, s, None if t is None else len(t), "x", "y", "z", "q", "r") for d, t, lang, s in out]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
