"""Scorers: one interface over a Spark ML pipeline model or a Python model.

``SparkModelScorer`` runs ``PipelineModel.transform`` (all JVM). A Python
model -- any object with ``predict(pandas.DataFrame) -> sequence`` -- runs in
an iterator ``pandas_udf``: Arrow batches in, one model deserialisation per
Python worker (the model travels once as a broadcast, not per task/row).
"""

from __future__ import annotations

import pickle
from typing import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Columns that begin so are the toolkit's own: a model doesn't see them.
INTERNAL = "__textflow_"


class SparkModelScorer:
    flavor = "spark"

    def __init__(self, model: PipelineModel):
        self.model = model

    def score(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def close(self) -> None:
        pass


class PythonModelScorer:
    """Adds ``prediction`` (double) from ``model.predict`` on the input columns."""

    flavor = "python"

    def __init__(self, model, input_cols: tuple[str, ...] | None = None):
        """``input_cols``: what the model sees; by default every column of the
        frame but the ingest time."""
        self.model = model
        self.input_cols = None if input_cols is None else tuple(input_cols)
        self._broadcast = None

    def score(self, df: DataFrame) -> DataFrame:
        # pickled by value: a broadcast alone would name the model's module, which
        # workers started elsewhere cannot import
        if self._broadcast is None:
            self._broadcast = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(self.model))
        shared = self._broadcast
        cols = self.input_cols or tuple(c for c in df.columns if c != "ingest_time" and not c.startswith(INTERNAL))

        @F.pandas_udf("double")
        def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            model = pickle.loads(shared.value)
            for pdf in batches:
                pdf.columns = list(cols)
                yield pd.Series(model.predict(pdf), index=pdf.index).astype("float64")

        return df.withColumn("prediction", predict(F.struct(*[F.col(c) for c in cols])))

    def close(self) -> None:
        if self._broadcast is not None:
            self._broadcast.destroy()
            self._broadcast = None


class TextLengthModel:
    """A rule-based Python model: 1.0 when the text has at least
    ``min_chars`` characters. Stands in for any pickled Python model."""

    def __init__(self, min_chars: int = 2000):
        self.min_chars = min_chars

    def predict(self, pdf: pd.DataFrame):
        lengths = pdf["text"].str.len()
        return (lengths >= self.min_chars).astype("float64").where(lengths.notna(), None)


class NearestCentroidModel:
    """A fitted Python model: the class whose mean over ``features`` (numeric
    columns, or the characters of ``text`` under the name ``text_chars``) is
    nearest. Ties go to the smaller class."""

    def __init__(self, features: tuple[str, ...], centroids: dict[float, tuple[float, ...]]):
        self.features, self.centroids = tuple(features), dict(centroids)

    @classmethod
    def fit(cls, df: DataFrame, features: tuple[str, ...], label_col: str = "label") -> "NearestCentroidModel":
        """Class means as one Spark aggregation; a row for each class comes back."""
        value = {f: F.char_length("text") if f == "text_chars" else F.col(f) for f in features}
        rows = (df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("double").alias("c"))
                .agg(*[F.avg(value[f]).alias(f) for f in features]).collect())
        return cls(features, {r["c"]: tuple(float(r[f]) for f in features) for r in rows})

    def predict(self, pdf: pd.DataFrame):
        chars = pdf["text"].str.len() if "text_chars" in self.features else None
        columns = [chars if f == "text_chars" else pdf[f] for f in self.features]
        best = pd.Series(float("inf"), index=pdf.index)
        out = pd.Series(float("nan"), index=pdf.index)
        for c in sorted(self.centroids):
            distance = sum((col.astype("float64") - m) ** 2 for col, m in zip(columns, self.centroids[c]))
            nearer = distance < best
            best, out = best.where(~nearer, distance), out.where(~nearer, c)
        return out


def save_python_model(spark: SparkSession, model, uri: str) -> None:
    """Store a picklable Python model as one binary file under ``uri``."""
    payload = cloudpickle.dumps(model)
    frame = spark.createDataFrame([(bytearray(payload),)], "content binary").coalesce(1)
    # a one-row, one-column binary file written through Spark so any filesystem works
    frame.write.mode("overwrite").format("parquet").save(uri)


def load_python_model(spark: SparkSession, uri: str):
    row = spark.read.parquet(uri).first()
    return pickle.loads(bytes(row["content"]))


def load_scorer(spark: SparkSession, uri: str, flavor: str = "spark", input_cols=None):
    if flavor == "spark":
        return SparkModelScorer(PipelineModel.load(uri))
    if flavor == "python":
        return PythonModelScorer(load_python_model(spark, uri), input_cols)
    raise ValueError(f"unknown model flavor {flavor!r}")
