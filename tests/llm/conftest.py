import pytest

SF = "/root/testdata/sf0.001"

#: Columns whose names the operators use themselves.
CLASHES = ("rid", "fp", "key", "component_id", "keep", "size", "source_size", "target", "taken", "hash", "spans", "score",
           "lang_pred", "held_out", "train", "base_score", "word", "host", "path", "rule", "verdict", "item_id", "dt", "a.b", "__rid", "__lang",
           "__id", "__range", "__key", "__cuts", "__new", "__h", "__r", "said", "cuts", "new_text", "row_number", "owner", "repo")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Rows -> DataFrame with the clashing columns added."""
    from pyspark.sql import functions as F

    def make(rows, schema=DOCS, clash=True):
        df = spark.createDataFrame(rows, schema)
        if clash:
            df = df.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHES if c not in df.columns])
        return df
    return make


@pytest.fixture
def odd_docs(frame):
    """Null, empty, wordless and very long texts, repeated rows, null ids, labels and sources."""
    long = "lorem ipsum " * 60_000 + "password = hunter2hunter2 mail me@long.example.org"
    same = "the same words stand in this row twice over"
    rows = [(1, None, "en", "s1", None), (2, "", "en", "s1", 0), (3, " \t\n", None, None, 3), (4, "12 34 !!", "de", "s2", 8),
            (5, long, "en", "s1", len(long)), (6, same, "en", "s2", len(same)), (6, same, "en", "s2", len(same)),
            (None, same, None, "s1", len(same)), (None, None, None, None, None), (7, "\U0001f600 ünïcode \x00 x", "de", None, 13)]
    return frame(rows)
