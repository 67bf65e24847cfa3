import pytest
from pyspark.sql import types as T

# Columns of documents, and names that the operators use inside.
CLASH = ["fp", "th", "dkey", "words", "n_words", "body", "kept", "key", "sid", "blob", "spans", "score", "rejected", "start", "length"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASH])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with clashing extra columns from (doc_id, text) pairs."""
    def make(rows, parts=3):
        full = [(i, t, "en", None, None if t is None else len(t)) + ("x",) * len(CLASH) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.repartition(parts) if full else df
    return make


def prose(seed, n=60):
    """Deterministic filler words, different for each seed."""
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 100003}" for i in range(n))


#: Nulls, empty, blank, ties, repeated rows, a null id and a very long text.
ODD = [(1, prose(1)), (2, None), (3, ""), (4, " \t\n "), (5, prose(1)), (5, prose(1)), (6, prose(6)), (6, prose(8)), (None, prose(1)), (None, None),
       (7, "\n".join(prose(i, 12) for i in range(1500))), (8, "ü" * 50 + " é ß " + prose(9, 20))]
