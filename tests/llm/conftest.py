import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
TEXTS = [
    None, "", " \n\t ", "one", "One two", "MIT License", LONG, LONG, "the mit license. the Apache License",
    "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p", "ΣΑΣ é <|endoftext|> 日本 🙂 ½",
    *[f"shared line\nown line {i}\n\nshared line " for i in range(12)],
]
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names the operators use for their own
    *[T.StructField(n, T.StringType()) for n in ("fp", "bucket", "kept", "n_lines", "_key", "_k1", "_kept", "words", "hits", "score", "ids")],
])


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and very long texts, copies, repeated rows, clashing column names."""
    rows = [(i, t, "en", "s", len(t or ""), *["x"] * 11) for i, t in enumerate(TEXTS)]
    rows += [rows[9], rows[12], (None, "one", None, None, None, *[None] * 11), (None, None, None, None, None, *[None] * 11)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con
