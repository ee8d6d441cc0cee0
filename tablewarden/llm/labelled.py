"""Labelled rows for the classifiers: who may teach, and the bounded sample that does."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Labelled rows that a classifier is fitted on at most: those of the smallest hashes of doc_id.
SAMPLE = 30_000


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text. Rows of fold 0 never teach."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5


def teachers(labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label, part (0 to 3, by hash): one row an id, the majority of its labels (1 on a tie), null labels and held-out ids left out."""
    one = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0)).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    h = F.xxhash64(F.col("doc_id"), F.lit(label))
    return one.select("doc_id", "label", F.pmod(h, F.lit(4)).cast("int").alias("part"), h.alias("_h")).orderBy("_h", "doc_id").limit(sample).drop("_h")


class Scorer:
    """Texts to probabilities: describe(text) -> features, then a fitted model, or the same score for all without one."""

    def __init__(self, describe: Callable[[str], np.ndarray], model, constant: float):
        self.describe, self.model, self.constant = describe, model, constant

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.model is None or not len(texts):
            return np.full(len(texts), self.constant)
        return np.clip(self.model.score(np.stack([self.describe(t or "") for t in texts]).astype(float)), 0, 1)


def fit(docs: DataFrame, chosen: DataFrame, describe: Callable[[str], np.ndarray], model, held_part: int) -> Scorer:
    """Fit model on the chosen rows (doc_id, label, part; SAMPLE at most, so they are sent to all tasks and their features to the driver)."""
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("part", pa.int32()), ("features", pa.binary())])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = map_rows(rows, lambda: lambda c: {k: c[k] for k in ("doc_id", "label", "part")} | {"features": [describe(t or "").astype(np.float32).tobytes() for t in c["text"]]}, schema).dropDuplicates().collect()
    found.sort(key=lambda r: (r["doc_id"], r["features"]))
    y = np.array([r["label"] for r in found], int)
    constant = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Scorer(describe, None, constant)
    x = np.stack([np.frombuffer(r["features"], np.float32) for r in found]).astype(float)
    return Scorer(describe, model.fit(x, y, np.array([r["part"] == held_part for r in found])), constant)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score of every row of docs."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    return map_rows(docs.select("doc_id", "text"), lambda: lambda c: {"doc_id": c["doc_id"], "score": scorer(c["text"]).tolist()}, schema)


def score_column(scorer: Scorer, text: str = "text") -> Column:
    """The score as a column, to filter whole rows by."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([scorer(texts.iloc[i : i + 512].tolist()) for i in range(0, len(texts), 512)] or [np.zeros(0)]))

    return score(F.col(text))


def verdict(scores: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scores.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
