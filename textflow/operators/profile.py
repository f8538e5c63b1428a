"""Input validation and class balance, in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_labelled(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """One row: total, positive, negative, null-label, null-text and empty-text
    counts. A single global aggregate (partial per task, one tiny merge)."""
    label = F.col(label_col)
    text = F.col(text_col)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(label == 1).alias("pos_count"),
        F.count_if(label == 0).alias("neg_count"),
        F.count_if(label.isNull()).alias("null_label_count"),
        F.count_if(text.isNull()).alias("null_text_count"),
        F.count_if(F.trim(text) == F.lit("")).alias("empty_text_count"),
    )


def validate_input(df: DataFrame, label_col: str = "label", text_col: str = "text") -> dict:
    """Profile and raise when there is nothing to train on."""
    row = profile_labelled(df, label_col, text_col).first().asDict()
    if row["total_rows"] == 0:
        raise ValueError("input data is empty")
    return row


def class_balance_rows(profile: DataFrame, run_id: str) -> DataFrame:
    """The profile as long ``(run_id, name, value)`` metric rows."""
    names = ["pos_count", "neg_count", "total_rows"]
    stacked = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in names)
    return profile.selectExpr(
        f"'{run_id}' AS run_id", f"stack({len(names)}, {stacked}) AS (name, value)"
    )
