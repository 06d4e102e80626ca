import random

import pandas as pd
import pytest

CLASH = ["size", "u", "fp", "score", "words", "n", "rank", "shard", "spans", "ids", "copies", "stratum", "row"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing extra columns."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, "one", "en", None), (None, "two words", "en", "b"),
            (5, "same text here", "en", "b"), (5, "same text here", "en", "b"), (6, "same text here", "de", "c"), (None, None, None, None),
            (7, " ".join(word() for _ in range(30_000)), "en", "a"), (8, "x" * 3000, "fr", "d"),
            (9, "line one\nline one\nline one\n\n", "fr", "d"), (10, "日本語 emoji 🙂 text   end", "es", "d")]
    rows += [(i, " ".join(word() for _ in range(r.randint(3, 80))), r.choice(["en", "de"]), r.choice("abc")) for i in range(11, 60)]
    rows = [(i, t, lang, source, None if t is None else len(t), *[7] * len(CLASH)) for i, t, lang, source in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, i % 3 % 2) for i in range(1, 50)] + [(1, 0, 1), (None, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def duck(tables: dict, sql: str):
    """Rows of DuckDB SQL over Spark DataFrames."""
    import duckdb
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"{name}_", df.toArrow())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_")
    return con.sql(sql).df()


def same(spark_df, duck_df) -> None:
    a, b = spark_df.toPandas(), duck_df
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    norm = lambda df: sorted([tuple(_plain(v) for v in r) for r in df[cols].itertuples(index=False)], key=repr)
    assert norm(a) == norm(b)


def _plain(v):
    if v is None or v is pd.NA or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v.item() if hasattr(v, "item") else v
