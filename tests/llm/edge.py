"""Tables that the tests of this folder share: nulls in any column, empty and very long texts, repeated rows, clashing names."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside, in another case too
CLASHING = ("score", "_score", "_Toxicity", "size", "target", "taken", "pieces", "_fp", "_root", "_matches", "_source", "fp", "k", "_plan", "_s", "_b", "_off", "_k", "_y", "_d", "_t",
            "_size", "_pieces", "_at", "_taken", "row", "s", "learn")


def edge_rows(n: int = 40) -> list[tuple]:
    body = "the quick brown fox jumps over the lazy dog and runs away from all of them"
    rows = [(i, f"{body} number {i} {body}", "en", f"s{i % 3}", None) for i in range(n)]
    rows += [(100, None, "en", "s0", 0), (101, "", "en", "s1", 0), (102, "   \n\t ", None, None, None), (103, "word", None, "s2", 4),
             (None, "a text without an id but with some words", "en", None, None), (None, None, None, None, None),
             (104, "long " * 30_000, "en", "s0", None), (105, f"{body} number 0 {body}", "en", "s0", None),
             (1, rows[1][1], "en", "s1", None), (1, rows[1][1], "en", "s1", None), (2, "another text under a repeated id", "en", "s2", None)]
    return rows


def edge_documents(spark: SparkSession, clashing: bool = False) -> DataFrame:
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    return df


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def edge_labels(spark: SparkSession) -> DataFrame:
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None), (4, 0, 1), (4, 1, 0), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def counted(df: DataFrame) -> dict:
    """How often each row occurs."""
    out: dict = {}
    for r in df.collect():
        out[tuple(r)] = out.get(tuple(r), 0) + 1
    return out
