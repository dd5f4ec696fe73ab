"""Small fixtures and frames for the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark: SparkSession, texts: list, ids: list | None = None, langs: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, g, "s", None if t is None else len(t)) for i, t, g in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(n))


#: Nulls, empty and blank texts, ties, repeated rows and a very long text.
ODD_TEXTS = [None, "", " \t\n ", "one", "one", "One two", "é É ß \u2003 x", "a" * 200_000, "w " * 50_000, None]
ODD_IDS = [None, 1, 2, 3, 3, 4, 5, 6, 7, 8]


def clashing(df: DataFrame) -> DataFrame:
    """Extra columns whose names the operators use inside, and one that differs by case only."""
    for name in ("score", "row", "key", "node", "n", "rank", "range", "_c0", "_id", "spans", "term"):
        df = df.selectExpr("*", f"1 AS {name}")
    return df.toDF(*df.columns[:-1], "Text")


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
