"""Classification metrics from one aggregation pass.

Every count-based metric (accuracy, confusion matrix, per-class and weighted
precision / recall / F1) is a function of the confusion counts over a fixed
label list. Those counts are one global aggregate -- partial per task, one
tiny merge -- and the metrics are column arithmetic on that single row, so
the cost is one scan whatever the data size. Labels absent from the data get
zero counts instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = (0, 1)


def _cell(actual: int, predicted: int) -> str:
    return f"c_{actual}_{predicted}"


def confusion_row(
    df: DataFrame,
    label_col: str = "label",
    prediction_col: str = "prediction",
    labels: tuple[int, ...] = LABELS,
) -> DataFrame:
    """One row with ``c_<actual>_<predicted>`` counts over ``labels``, and over all
    rows ``c_total`` and ``c_right`` (label equals prediction, any label): rows
    outside ``labels`` stay in the denominators. Rows with a null label or
    prediction are only counted as ``c_null``."""
    label = F.col(label_col).cast("double")
    pred = F.col(prediction_col).cast("double")
    return df.agg(
        *[
            F.count_if((label == F.lit(float(a))) & (pred == F.lit(float(p)))).alias(_cell(a, p))
            for a in labels
            for p in labels
        ],
        F.count_if(label.isNotNull() & pred.isNotNull()).alias("c_total"),
        F.count_if(label == pred).alias("c_right"),
        F.count_if(label.isNull() | pred.isNull()).alias("c_null"),
    )


def _support(a: int, labels) -> Column:
    return sum((F.col(_cell(a, p)) for p in labels), F.lit(0))


def _predicted(p: int, labels) -> Column:
    return sum((F.col(_cell(a, p)) for a in labels), F.lit(0))


def _total(labels) -> Column:
    return F.col("c_total")


def _ratio(num: Column, den: Column) -> Column:
    """``num / den``, 0 when ``den`` is 0 (metric undefined)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def _precision(c: int, labels) -> Column:
    return _ratio(F.col(_cell(c, c)), _predicted(c, labels))


def _recall(c: int, labels) -> Column:
    return _ratio(F.col(_cell(c, c)), _support(c, labels))


def _f1(c: int, labels) -> Column:
    p, r = _precision(c, labels), _recall(c, labels)
    return F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def confusion_matrix(row: DataFrame, labels: tuple[int, ...] = LABELS) -> DataFrame:
    """Dense matrix, one row per actual label, a ``pred_<p>`` column per predicted label."""
    parts = ", ".join(
        f"{a}, " + ", ".join(f"{_cell(a, p)}" for p in labels) for a in labels
    )
    names = ", ".join(["label"] + [f"pred_{p}" for p in labels])
    return row.selectExpr(f"stack({len(labels)}, {parts}) AS ({names})")


def class_metrics(row: DataFrame, labels: tuple[int, ...] = LABELS) -> DataFrame:
    """Per class precision, recall, F1 and support (0 when undefined)."""
    per_class = [
        F.struct(
            F.lit(c).alias("class"),
            _precision(c, labels).alias("precision"),
            _recall(c, labels).alias("recall"),
            _f1(c, labels).alias("f1"),
            _support(c, labels).cast("bigint").alias("support"),
        )
        for c in labels
    ]
    return row.select(F.explode(F.array(*per_class)).alias("m")).select("m.*")


def weighted_metrics(row: DataFrame, labels: tuple[int, ...] = LABELS) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    total = _total(labels)

    def weighted(metric) -> Column:
        return _ratio(sum((metric(c, labels) * _support(c, labels) for c in labels), F.lit(0.0)), total)

    return row.select(
        _ratio(F.col("c_right"), total).alias("accuracy"),
        weighted(_precision).alias("weighted_precision"),
        weighted(_recall).alias("weighted_recall"),
        weighted(_f1).alias("weighted_f1"),
        total.cast("bigint").alias("n_rows"),
    )


def binary_counts(row: DataFrame) -> DataFrame:
    """TN, FP, FN, TP and accuracy of a 0/1 problem."""
    tn, fp, fn, tp = (F.col(_cell(0, 0)), F.col(_cell(0, 1)), F.col(_cell(1, 0)), F.col(_cell(1, 1)))
    return row.select(
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        _ratio(F.col("c_right"), F.col("c_total")).alias("accuracy"),
    )


def metric_values(row: DataFrame, labels: tuple[int, ...] = LABELS) -> dict:
    """All count-based metrics of a collected confusion row, as a dict."""
    r = row.first().asDict()
    total = r["c_total"]
    out: dict = {}

    def ratio(n, d):
        return 0.0 if d == 0 else n / d

    weighted = {"precision": 0.0, "recall": 0.0, "f1": 0.0}
    for c in labels:
        support = sum(r[_cell(c, p)] for p in labels)
        predicted = sum(r[_cell(a, c)] for a in labels)
        prec = ratio(r[_cell(c, c)], predicted)
        rec = ratio(r[_cell(c, c)], support)
        f1 = 0.0 if prec + rec == 0 else 2 * prec * rec / (prec + rec)
        out[f"precision_{c}"], out[f"recall_{c}"], out[f"f1_{c}"] = prec, rec, f1
        for name, value in (("precision", prec), ("recall", rec), ("f1", f1)):
            weighted[name] += value * support
    out["accuracy"] = ratio(r["c_right"], total)
    for name, value in weighted.items():
        out[f"weighted_{name}"] = ratio(value, total)
    if tuple(labels) == (0, 1):
        out.update(tn=r["c_0_0"], fp=r["c_0_1"], fn=r["c_1_0"], tp=r["c_1_1"])
    out["n_rows"], out["n_null"] = total, r["c_null"]
    out["n_other"] = total - sum(r[_cell(a, p)] for a in labels for p in labels)
    return out
