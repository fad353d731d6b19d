import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names clash with outputs."""
    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            names = ["score", "kept", "size", "content", "fp", "digest", "target", "keep_id", "component_id", "n", "key",
                     "_keep", "_n", "_words", "_text", "_s", "row", "keep", "a.b"]
            for name in names:
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Repeatable invented text of n words."""
    def make(n, seed=0, words=400):
        rng = np.random.default_rng(seed)
        syllables = ["ta", "re", "on", "mi", "sol", "fa", "dé", "qui", "ner", "ost"]
        vocabulary = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(words)]
        return " ".join(rng.choice(vocabulary, n))

    return make


@pytest.fixture(scope="session")
def awkward(frame, prose):
    """Null and empty texts, white space only, a very long text, repeated rows, null ids and sources."""
    rows = [(1, None, None), (2, "", "a"), (3, " \t\n ", "b"), (4, prose(40_000, 4), "a"), (5, prose(50, 5), "b"),
            (5, prose(50, 5), "b"), (6, "one", "a"), (None, "no id here", None), (7, "ÀÉ ß \u0000 x" * 30, "c"), (8, prose(50, 5), "a")]
    return frame(rows)


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])
