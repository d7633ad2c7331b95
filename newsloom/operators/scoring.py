"""Scores by a model that is no Column expression.

A model is any function from a pandas frame of features to one number a row.
The features are Columns, computed in the JVM, so only they travel, in Arrow
batches; the model is loaded once per Python worker and kept for its next tasks.

Scores may have any size.  A score that is not finite becomes null, which every
threshold of the relevance gate turns away; ranks take it as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .enrichment import Features, Scorer

Model = Callable[[pd.DataFrame], np.ndarray]

#: Models of this Python worker, by name.
_LOADED: dict[str, Model] = {}


def loaded(name: str, load: Callable[[], Model]) -> Model:
    """The worker's copy of a model; ``load`` runs at the first call only."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def tag_features(f: Features) -> dict[str, Column]:
    """Numbers of vocabulary hits and tags, and flags of source and texts."""
    return {
        "core_hits": f.core_hits.cast("double"),
        "core_in_title": f.core_in_title.cast("double"),
        "pillars": F.size(f.esg_pillars).cast("double"),
        "regulations": F.size(f.regulations).cast("double"),
        "topics": F.size(f.topics).cast("double"),
        "regulator": F.coalesce(f.source_type == "regulator", F.lit(False)).cast("double"),
        "no_summary": (F.coalesce(f.summary, F.lit("")) == "").cast("double"),
    }


def model_scorer(name: str, load: Callable[[], Model],
                 inputs: Callable[[Features], Mapping[str, Column]] = tag_features) -> Scorer:
    """A scorer for ``curate``.

    ``name`` identifies the model: another name loads another one.  The scorer is
    marked, so that ``enrich`` keeps its score as a value: filters on it do not run
    the model again.
    """
    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = loaded(name, load)
        for frame in batches:
            scores = pd.Series(np.asarray(model(frame), dtype="float64"))
            yield scores.where(np.isfinite(scores))

    def scorer(f: Features) -> Column:
        return predict(F.struct(*[c.alias(n) for n, c in inputs(f).items()]))

    scorer.runs_python = True
    return scorer


def linear(weights: Mapping[str, float], bias: float = 0.0) -> Callable[[], Model]:
    """Loads a weighted sum of features."""
    def load() -> Model:
        names = list(weights)
        factors = np.array([weights[n] for n in names], dtype="float64")
        return lambda frame: frame[names].to_numpy("float64") @ factors + bias

    return load
