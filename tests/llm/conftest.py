import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text[, lang[, source]]) tuples, with columns whose names clash with working names."""

    def make(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            for name in ("label", "size", "shard", "score", "n", "id", "rid", "word"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
