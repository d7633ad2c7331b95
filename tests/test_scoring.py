"""Scores by a model: any finite size, one load a worker, one call a row."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from rows import AS_OF, article

from newsloom.operators import ranking, rollups, scoring
from newsloom.plans.curate import curate


def _rows(raw, n: int = 40):
    return raw([article(article_id=f"r{i:03}", title=f"CSRD report number {i} of the harbour town",
                        url=f"https://h.example/{i}", canonical_url=f"https://h.example/{i}",
                        summary="climate emissions " * i) for i in range(n)]).repartition(3)


def test_scores_of_any_finite_size(raw):
    def load():
        big = np.array([1e6, 2500.125, 1e15, np.nan, np.inf, -3.0])
        return lambda frame: big[frame["words"].to_numpy("int64") % 6]

    scorer = scoring.model_scorer("sizes", load, lambda f: {
        "words": F.floor(F.size(F.split(F.trim(f.summary), " ")) / 2)})
    got = curate(_rows(raw), AS_OF, scorer=scorer)
    scores = {r.relevance_score for r in got.collect()}
    assert scores == {1e6, 2500.125, 1e15}  # what is no finite number, or below the gate, is out
    top = ranking.select_top(got, top_n=5, collapse=False).collect()
    assert {r.relevance_score for r in top} == {1e15}
    assert sum(r.article_count for r in rollups.by_market_day(got).collect()) == got.count()


def test_a_model_is_loaded_once_a_worker_and_called_once_a_row(spark, raw, tmp_path):
    folder = str(tmp_path)

    def load():
        open(os.path.join(folder, f"load-{os.getpid()}-{os.urandom(4).hex()}"), "w").close()

        def model(frame):
            with open(os.path.join(folder, f"call-{os.getpid()}-{os.urandom(4).hex()}"), "w") as out:
                out.write(str(len(frame)))
            return np.full(len(frame), 0.5)

        return model

    _rows(raw).write.parquet(f"{folder}/raw")
    got = curate(spark.read.parquet(f"{folder}/raw"), AS_OF, scorer=scoring.model_scorer("once", load))
    assert got.count() == 40
    loads = [f.split("-")[1] for f in os.listdir(folder) if f.startswith("load-")]
    assert loads and len(loads) == len(set(loads))
    assert sum(int(open(f"{folder}/{f}").read()) for f in os.listdir(folder) if f.startswith("call-")) == 40


def test_linear_model():
    model = scoring.linear({"a": 2.0, "b": -0.5}, bias=1.0)()
    assert list(model(pd.DataFrame({"b": [2.0, 0.0], "a": [1.0, 3.0]}))) == [2.0, 7.0]
