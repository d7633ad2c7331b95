"""Messy documents that every operator must take."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, "
          "row string, score double, key string, node long, position int, copies int, "
          "fingerprint string, chunk string, label int, _range string")


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}x{draw.randrange(3)}" for _ in range(n))


def messy_texts() -> list[tuple]:
    long = words(1, 4000)
    passage = words(2, 60)
    near = words(3, 200).split()
    near[100] = "changed"
    return [
        (1, words(4, 80), "en", "a"), (2, words(4, 80), "en", "b"), (2, words(4, 80), "en", "b"),
        (3, None, None, None), (4, "", "en", ""), (None, words(5, 30), "en", "a"),
        (None, None, None, None), (5, long, "de", "a"), (6, long, "de", "c"),
        (7, words(6, 50) + " " + passage + " " + words(7, 20), "en", "a"),
        (8, passage + "\n" + words(8, 5), "en", "b"), (9, words(3, 200), "en", "a"),
        (10, " ".join(near), "en", "a"), (11, "éß 中文🙂" * 90, "fr", "é"), (12, "x", "en", "𝔘"),
        (13, "a b", "en", "~"), (14, " \t\n\r\x0b\x0c", "en", None), (15, "<|endoftext|>hi \\# ", "en", "a"),
        (16, "ab" * 300, "en", "b"), (2**62, words(9, 12), "en", "a"), (-5, words(10, 12), "en", "a"),
    ]


@pytest.fixture(scope="session")
def messy(spark):
    rows = [(i, t, lang, s, 7, 8, "r", 0.5, "k", 9, 1, 2, "f", "c", 3, "g")
            for i, t, lang, s in messy_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def in_sql():
    """Run SQL in DuckDB over tables given as pandas frames."""
    def run(sql: str, **tables: pd.DataFrame) -> list[tuple]:
        with duckdb.connect() as db:
            for name, frame in tables.items():
                db.register(name, frame)
            return db.execute(sql).fetch_df()

    return run


@pytest.fixture(scope="session")
def same():
    """Whether a Spark and a pandas table hold the same rows."""
    def check(got, expected: pd.DataFrame) -> None:
        names = sorted(expected.columns)
        assert sorted(got.columns) == names
        a, b = ([tuple(None if pd.isna(x) else round(float(x), 9) if isinstance(x, float) else x
                       for x in row) for row in rows]
                for rows in (got.select(names).collect(), expected[names].itertuples(index=False)))
        assert sorted(a, key=repr_key) == sorted(b, key=repr_key)

    return check


def repr_key(row: tuple) -> str:
    return repr([None if x is None else str(int(x)) if isinstance(x, (int, float)) and x == int(x)
                 else str(x) for x in row])
