import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: names that operators use for their own columns
CLASHES = ("score", "size", "pos", "hash", "key", "doc", "node", "root", "raw", "model", "m", "s", "first", "shift",
           "rank", "shard", "_id", "_y", "_line_key", "_gone_id", "_decon_id", "text_key", "host", "path")

EN = ("the quick brown fox jumps over a lazy dog while seven other animals watch from behind the old wooden fence and "
      "nobody in the village says a word about it until the next morning").split()
DE = ("der schnelle braune fuchs springt über den faulen hund und sieben andere tiere schauen zu während niemand im dorf "
      "bis zum nächsten morgen ein wort darüber verliert weil alle schlafen").split()


def prose(words, seed, n):
    """Deterministic text of n words."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(words[(x >> 8) % len(words)] + ("." if (x >> 5) % 11 == 0 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes=False):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clashes:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit("x") for c in CLASHES})
        return df
    return make


@pytest.fixture(scope="session")
def messy(make_docs):
    """Every awkward case at once: nulls in each column, empty and long texts, repeated rows and ids, extra columns."""
    long_text = "\n".join(prose(EN, k, 60) for k in range(300))
    rows = [(1, prose(EN, 1, 80), "en", "a", 1), (2, prose(DE, 2, 80), "de", "b", 2), (3, None, "en", "a", None),
            (4, "", None, None, 0), (None, prose(EN, 5, 40), "en", None, 5), (None, None, None, None, None),
            (5, long_text, "en", "a", 6), (6, prose(EN, 1, 80), "en", "b", 1), (6, prose(EN, 1, 80), "en", "b", 1),
            (7, "   \n\t ", "de", "", 4), (8, "one two three", "en", "c", 3), (8, prose(DE, 9, 50), "de", "c", 3),
            (9, "\U0001f600 ☃ 你好 \x00 ÿ", None, "c", 9), (10, prose(EN, 10, 60).upper(), "en", "a", 4)]
    return make_docs(rows, clashes=True)
