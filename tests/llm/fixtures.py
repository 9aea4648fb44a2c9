"""Small tables with awkward rows."""

import duckdb

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    """Documents from (doc_id, text) or longer tuples."""
    full = [(*r, *(None,) * (5 - len(r))) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = "the thing was there and " * 20_000
    return docs_of(spark, [
        (1, "the cat sat on the mat", "en", "a", 3), (1, "the cat sat on the mat", "en", "a", 3),
        (2, "the cat sat on the mat", "en", "b", None), (3, "", None, None, 0), (4, None, "fr", "a", None),
        (5, long_text, "en", "a", 5), (None, "some text without an id", None, "b", 1), (None, None, None, None, None),
        (6, "   \n\t ", "de", "", 0), (7, "1234 !!! 5678", "en", "a", 0), (5, "another text of five", "en", "b", 0),
    ])


def clashing(df, names):
    """``df`` with more columns of the given names."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit(f"clash {n}"))
    return df


def table(sf, name, columns="*"):
    return duckdb.sql(f"select {columns} from read_parquet('{sf}/{name}.parquet')").fetchall()
