"""Train, tune, compare and pick text classifiers.

The three stateless text stages (tokenise, drop stop words, hash) are run
once and their output persisted; only the IDF is fitted (one aggregation
pass) -- once on the training split, and once per fold when tuning, because
the IDF weights depend on the rows they are fitted on. Every classifier and
grid point then reuses those features instead of re-featurising, which the
reference's full-pipeline cross-validation does per fold *and* grid point.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.operators import auc as auc_ops
from textflow.operators import evaluate as ev
from textflow.operators.features import feature_stages, hashing_model, vector_entries
from textflow.operators.layout import spread
from textflow.operators.prep import cap_rows, sample_rows
from textflow.operators.registry import metric_gate
from textflow.operators.splits import fold_column, keyed_splits, random_splits, with_split


@dataclass
class ModelSpec:
    """A classifier with its default settings and a tuning grid.

    ``grid`` maps parameter names to values; they are bound to the estimator
    *instance* (a grid of class-level params would leave every point equal)."""

    name: str
    make: Callable[[], object]
    grid: dict = field(default_factory=dict)
    tune: bool = True


def default_model_specs() -> list[ModelSpec]:
    # The reference's three classifiers, their settings and grids.
    return [
        ModelSpec(
            "LogisticRegression",
            lambda: LogisticRegression(featuresCol="features", labelCol="label",
                                       maxIter=20, regParam=0.1, elasticNetParam=0.0),
            {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
        ),
        ModelSpec(
            "RandomForest",
            lambda: RandomForestClassifier(featuresCol="features", labelCol="label", seed=42,
                                           numTrees=10, maxDepth=5, maxBins=32, subsamplingRate=0.8),
            {"numTrees": [5, 10], "maxDepth": [3, 5]},
        ),
        ModelSpec(
            "LinearSVC",
            lambda: LinearSVC(featuresCol="features", labelCol="label", maxIter=30, regParam=0.1),
            {"regParam": [0.01, 0.1], "maxIter": [20, 30]},
            tune=False,
        ),
    ]


@dataclass
class TrainConfig:
    num_features: int = 1 << 15
    min_doc_freq: int = 5
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    seed: int = 42
    sample_fraction: float = 1.0
    max_rows: int = 0
    enable_cv: bool = False
    cv_folds: int = 2
    split_mode: str = "keyed"          # "keyed" (needs key_col) or "random" (reference)
    key_col: str | None = "doc_id"
    select_on: str = "test"            # the reference picks the best model on test
    select_metric: str = "accuracy"
    parallelism: int = 1               # models trained at once (driver threads)
    cv_parallelism: int = 2            # (fold, grid point) fits at once, as the reference's CV
    certify: bool = False              # also log how near logistic regressions are to their optimum
    auc_mode: str = "exact"            # or "evaluator" (Spark's default numBins=1000 curve)
    storage_level: StorageLevel = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)

    def with_(self, **changes) -> "TrainConfig":
        return dataclasses.replace(self, **changes)


# The reference's three training presets.
PRESETS = {
    "full": TrainConfig(num_features=32768, sample_fraction=1.0, enable_cv=False),
    "tuned": TrainConfig(num_features=16384, sample_fraction=0.3, enable_cv=True, cv_folds=2),
    "quick": TrainConfig(num_features=8192, sample_fraction=0.1, max_rows=50000),
}


@dataclass
class ModelResult:
    name: str
    position: int
    model: PipelineModel
    params: dict
    metrics: dict
    training_seconds: float
    grid: list = field(default_factory=list)   # (grid_id, params, avg_metric)


@dataclass
class TrainingOutcome:
    results: list
    best: ModelResult | None
    profile: dict
    split_sizes: dict

    def results_frame(self, spark: SparkSession) -> DataFrame:
        """One row per model: position, metrics, training time (driver-side, bounded by #models)."""
        names = sorted({k for r in self.results for k in r.metrics})
        schema = T.StructType(
            [T.StructField("model", T.StringType()), T.StructField("position", T.IntegerType())]
            + [T.StructField(n, T.DoubleType()) for n in names]
            + [T.StructField("training_seconds", T.DoubleType())]
        )
        rows = [
            (r.name, r.position, *[_float(r.metrics.get(n)) for n in names], r.training_seconds)
            for r in self.results
        ]
        return spark.createDataFrame(rows, schema)

    def grid_frame(self, spark: SparkSession) -> DataFrame:
        schema = "model string, grid_id int, params string, avg_metric double"
        rows = [(r.name, g[0], g[1], float(g[2])) for r in self.results for g in r.grid]
        return spark.createDataFrame(rows, schema)


def _float(v):
    return None if v is None else float(v)


def param_values(model) -> dict:
    """Effective parameters of a fitted stage as ``{name: value}``."""
    return {p.name: v for p, v in model.extractParamMap().items()}


def grid_points(estimator, grid: dict) -> list[dict]:
    """Cartesian grid bound to ``estimator``'s own Param objects."""
    points = [{}]
    for name, values in grid.items():
        param = estimator.getParam(name)
        points = [{**pt, param: v} for pt in points for v in values]
    return points


def evaluate(predictions: DataFrame, label_col: str = "label", auc_mode: str = "exact") -> dict:
    """All metrics of a scored frame: one confusion pass plus the curve areas.

    ``auc_mode='exact'`` gives the exact areas (``auc.py``); ``'evaluator'``
    uses Spark's ``BinaryClassificationEvaluator`` with its default
    ``numBins=1000``, which down-samples the curve on large inputs -- the
    numbers a default evaluator reports."""
    metrics = ev.metric_values(ev.confusion_row(predictions, label_col))
    if "rawPrediction" in predictions.columns:
        if auc_mode == "evaluator":
            for key, name in (("auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
                metrics[key] = BinaryClassificationEvaluator(
                    labelCol=label_col, rawPredictionCol="rawPrediction", metricName=name
                ).evaluate(predictions)
        else:
            areas = auc_ops.area_values_from_raw(predictions, label_col)
            metrics["auc"] = areas["roc_auc"]
            metrics["pr_auc"] = areas["pr_auc"]
            metrics["n_unscored"] = areas["n_unscored"]
    return metrics


def gradient_norm(model, train: DataFrame, label_col: str = "label", features_col: str = "features", at_zero: bool = False) -> float:
    """Norm of the gradient of the loss that a logistic regression with an L2 penalty
    minimises, at its coefficients or with all of them zero; one aggregation.

    The loss is the mean over the rows plus ``regParam / 2`` times the squared
    coefficients of the standardised features; the norm is taken in their space, as the
    optimiser sees it. Only stored entries of the sparse vectors are touched: a row gives
    ``(bucket, residual * value)`` parts, which are summed per task before the shuffle,
    and a row for each bucket is what remains."""
    scored = train if at_zero else model.transform(train)
    margin = F.lit(0.0) if at_zero else auc_ops.raw_score()
    rows = scored.select((1 / (1 + F.exp(-margin)) - F.col(label_col)).alias("residual"), F.col(features_col))
    # the intercept is an entry of its own, with the value 1 in every row
    entries = F.concat(F.array(F.struct(F.lit(-1).alias("index"), F.lit(1.0).alias("value"))), vector_entries(features_col))
    parts = rows.select("residual", F.explode(entries).alias("e"))
    sums = parts.groupBy(F.col("e.index").alias("bucket")).agg(
        F.sum(F.col("residual") * F.col("e.value")).alias("slope"), F.sum("e.value").alias("total"),
        F.sum(F.col("e.value") * F.col("e.value")).alias("squares"))
    found = {r["bucket"]: r for r in sums.collect()}
    n = found[-1]["total"] if found else 0.0
    norm = (found[-1]["slope"] / n) ** 2 if n else 0.0
    weights, penalty = model.coefficients, float(model.getOrDefault("regParam"))
    for bucket, r in found.items():
        deviation = max(0.0, (r["squares"] - r["total"] ** 2 / n) / (n - 1)) ** 0.5 if bucket >= 0 and n > 1 else 0.0
        if deviation > 0:
            scaled = 0.0 if at_zero else float(weights[bucket]) * deviation
            norm += (r["slope"] / n / deviation + penalty * scaled) ** 2
    return norm ** 0.5


def optimality(model, train: DataFrame) -> dict:
    """``gradient_norm`` and ``gradient_start`` (with all coefficients zero) of a logistic
    regression with an L2 penalty: their ratio says how far the optimiser has got,
    whatever its own stopping rule. Nothing for other models: a forest minimises no such
    loss, and the hinge loss of a linear SVC has a kink where its margins end up, so that
    no single subgradient is near zero at its optimum."""
    if not isinstance(model, LogisticRegressionModel) or model.getOrDefault("elasticNetParam") != 0.0:
        return {}
    return {"gradient_norm": gradient_norm(model, train), "gradient_start": gradient_norm(model, train, at_zero=True)}


def _split(df: DataFrame, cfg: TrainConfig):
    if cfg.split_mode == "keyed":
        if not cfg.key_col:
            raise ValueError("keyed split needs key_col")
        return keyed_splits(df, cfg.key_col, cfg.train_ratio, cfg.val_ratio, cfg.seed)
    return random_splits(df, cfg.train_ratio, cfg.val_ratio, cfg.seed)


#: Bytes that the rows of one training task may take where a forest holds a bin number (an int)
#: for every feature of a row, also for those that its sparse vector leaves out.
TASK_BYTES = 640 << 20


def feature_partitions(rows: int, num_features: int) -> int:
    """Partitions of ``rows`` feature rows such that a task's share stays under ``TASK_BYTES``."""
    return max(1, -(-rows * num_features * 4 // TASK_BYTES))


def deal_rows(hashed: DataFrame, rows: int, num_features: int) -> DataFrame:
    """Feature rows dealt out evenly over as many tasks as their number asks for: the input's
    partitions follow the bytes of its files, and a forest makes each row many times larger.
    Rows that fit in one task stay as they are."""
    needed = feature_partitions(rows, num_features)
    if needed == 1:
        return hashed
    return hashed.repartition(max(needed, hashed.sparkSession.sparkContext.defaultParallelism))


GROUP, DESCRIPTION = "spark.jobGroup.id", "spark.job.description"


def run_fits(spark: SparkSession, tasks: list, workers: int = 1) -> list:
    """The results of ``(label, function)`` tasks, ``workers`` at a time.

    Their threads inherit the caller's local properties -- its scheduler pool above all,
    so that fits share a cluster as its fair scheduler says, and its job tags -- and each
    task's jobs carry a group of its own, ``<caller's group>/<label>``: they can be told
    apart, and one fit be cancelled without the others."""
    context = spark.sparkContext
    outer = context.getLocalProperty(GROUP) or f"fit-{uuid.uuid4().hex[:8]}"

    def run(task):
        label, work = task
        before = {k: context.getLocalProperty(k) for k in (GROUP, DESCRIPTION)}
        context.setLocalProperty(GROUP, f"{outer}/{label}")
        context.setLocalProperty(DESCRIPTION, label)
        try:
            return work()
        finally:
            for key, value in before.items():
                context.setLocalProperty(key, value)

    if workers <= 1 or len(tasks) < 2:
        return [run(t) for t in tasks]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        # a copy of the caller's properties for each task: threads of the pool are used again
        waiting = [pool.submit(inheritable_thread_target(spark)(run), t) for t in tasks]
        return [w.result() for w in waiting]


class Trainer:
    """Featurise once, then fit, tune and evaluate each model spec."""

    def __init__(self, cfg: TrainConfig | None = None, specs: list[ModelSpec] | None = None):
        self.cfg = cfg or TrainConfig()
        self.specs = specs if specs is not None else default_model_specs()
        self._persisted: list[DataFrame] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        df = df.persist(self.cfg.storage_level)
        self._persisted.append(df)
        return df

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

    # featurising -------------------------------------------------------
    def _stages(self):
        return feature_stages(self.cfg.num_features, self.cfg.min_doc_freq)

    def _hash(self, df: DataFrame) -> DataFrame:
        """Term-frequency vectors; the text and token arrays are dropped so
        the cached table holds sparse vectors, not the corpus."""
        return hashing_model(self.cfg.num_features).transform(df).drop("text", "tokens", "filtered")

    def _fit_idf(self, hashed: DataFrame):
        return IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=self.cfg.min_doc_freq).fit(hashed)

    @staticmethod
    def _weigh(idf_model, hashed: DataFrame) -> DataFrame:
        """TF-IDF features only (what the classifiers read)."""
        return idf_model.transform(hashed).drop("rawFeatures")

    # tuning ------------------------------------------------------------
    def _cross_validate(self, estimator, spec: ModelSpec, spark: SparkSession, folds: list):
        """The best point, bound to ``estimator`` (another instance would ignore it), and
        the scored grid."""
        points = grid_points(estimator, spec.grid)

        def score(fold, point):
            fold_train, fold_val = fold
            model = estimator.fit(fold_train, point)
            return ev.metric_values(ev.confusion_row(model.transform(fold_val)))[self.cfg.select_metric]

        tasks = [(f"{spec.name}-fold{k}-point{i}", lambda fold=fold, point=point: score(fold, point))
                 for k, fold in enumerate(folds) for i, point in enumerate(points)]
        values = run_fits(spark, tasks, self.cfg.cv_parallelism)
        sums = [0.0] * len(points)
        for k, value in enumerate(values):
            sums[k % len(points)] += value
        avgs = [s / len(folds) for s in sums]
        best = max(range(len(points)), key=lambda i: (avgs[i], -i))
        grid = [
            (i, ", ".join(f"{p.name}={v}" for p, v in pt.items()), avgs[i]) for i, pt in enumerate(points)
        ]
        return points[best], grid

    def _folds(self, hashed_train: DataFrame) -> list:
        cfg = self.cfg
        key = cfg.key_col
        if key and key in hashed_train.columns:
            tagged = hashed_train.withColumn("fold", fold_column(key, cfg.cv_folds, cfg.seed))
        else:
            tagged = hashed_train.withColumn("fold", (F.rand(cfg.seed) * cfg.cv_folds).cast("int"))
        # hashed_train is the one cached table: a fold is a filter on it, and its IDF weights are
        # applied where a fit or a score reads it. (Spark's estimators hold the blocks they
        # iterate over for as long as a fit lasts; weighted copies of all folds would be held
        # for the whole search.)
        folds = []
        for k in range(cfg.cv_folds):
            fold_train = tagged.where(F.col("fold") != k)
            idf = self._fit_idf(fold_train)
            folds.append((self._weigh(idf, fold_train), self._weigh(idf, tagged.where(F.col("fold") == k))))
        return folds

    # training ----------------------------------------------------------
    def _train_one(self, position: int, spec: ModelSpec, train_feat, eval_feat, idf_model, folds):
        started = time.time()
        estimator = spec.make()
        grid = []
        if self.cfg.enable_cv and spec.tune and spec.grid and folds:
            best_point, grid = self._cross_validate(estimator, spec, train_feat.sparkSession, folds)
            clf = estimator.fit(train_feat, best_point)
        else:
            clf = estimator.fit(train_feat)
        seconds = time.time() - started
        certificate = optimality(clf, train_feat) if self.cfg.certify else {}
        predictions = clf.transform(eval_feat).persist(self.cfg.storage_level)
        try:
            metrics = evaluate(predictions, auc_mode=self.cfg.auc_mode)
        finally:
            predictions.unpersist()
        metrics.update(certificate)
        model = PipelineModel(stages=self._stages()[:3] + [idf_model, clf])
        return ModelResult(spec.name, position, model, param_values(clf), metrics, seconds, grid)

    def fit(self, labelled: DataFrame) -> TrainingOutcome:
        """``labelled`` needs ``label`` (0/1), ``text`` and ``key_col`` for keyed splits."""
        cfg = self.cfg
        missing = [c for c in ("label", "text") if c not in labelled.columns]
        if cfg.split_mode == "keyed" and cfg.key_col not in labelled.columns:
            missing.append(f"{cfg.key_col} (key for keyed splits; or use split_mode='random')")
        if missing:
            raise ValueError(f"training input lacks columns: {', '.join(missing)}")
        # rows that cannot be trained on are counted: the profile's total has them
        dropped = labelled.agg(F.count_if(F.col("label").isNull()).alias("null_label_rows"),
                               F.count_if(F.col("text").isNull() & F.col("label").isNotNull()).alias("null_text_rows"),
                               F.count_if(F.col("text").isNotNull() & F.col("label").isNotNull()).alias("usable_rows")
                               ).first().asDict()
        # a sample or a cap only makes tasks smaller
        usable = dropped.pop("usable_rows")
        data = labelled.where(F.col("label").isNotNull() & F.col("text").isNotNull())
        data = sample_rows(data, cfg.sample_fraction, cfg.seed,
                           key=cfg.key_col if cfg.split_mode == "keyed" else None)
        data = spread(cap_rows(data, cfg.max_rows, cfg.key_col))
        try:
            keep_cols = ["label", "text"] + ([cfg.key_col] if cfg.key_col in data.columns else [])
            eval_name = "test" if cfg.select_on == "test" else "val"
            if cfg.split_mode == "keyed":
                # one scan, one tokenisation: hash every row once, split the cache
                tagged = with_split(data.select(*keep_cols), cfg.key_col, cfg.train_ratio,
                                    cfg.val_ratio, cfg.seed)
                hashed = self._keep(deal_rows(self._hash(tagged), usable, cfg.num_features))
                hashed_train = hashed.where(F.col("split") == "train").drop("split")
                if eval_name == "val" and cfg.val_ratio <= 0:
                    eval_name = "train"
                eval_hashed = hashed.where(F.col("split") == eval_name).drop("split")
            else:
                train, val, test = _split(data, cfg)
                hashed_train = self._keep(deal_rows(self._hash(train.select(*keep_cols)), usable, cfg.num_features))
                eval_split = test if eval_name == "test" else val
                eval_hashed = self._hash(eval_split.select(*keep_cols))
            idf_model = self._fit_idf(hashed_train)
            train_feat = self._keep(self._weigh(idf_model, hashed_train))
            eval_feat = self._keep(self._weigh(idf_model, eval_hashed))
            if cfg.split_mode == "keyed":
                sizes, profile = _split_profile(hashed, eval_name)
            else:
                sizes, profile = _split_profile_frames(data, train_feat, eval_feat)
            profile |= dropped
            needs_cv = cfg.enable_cv and any(s.tune and s.grid for s in self.specs)
            folds = self._folds(hashed_train) if needs_cv else []
            if not needs_cv:
                # features are materialised; the hashed copy is no longer needed
                train_feat.count()
                eval_feat.count()
                hashed_cache = hashed if cfg.split_mode == "keyed" else hashed_train
                hashed_cache.unpersist()

            tasks = [(spec.name, lambda pos=pos, spec=spec: self._train_one(pos, spec, train_feat, eval_feat, idf_model, folds))
                     for pos, spec in enumerate(self.specs)]
            results = run_fits(labelled.sparkSession, tasks, cfg.parallelism)
        finally:
            self.release()
        return TrainingOutcome(results, pick_best(results, cfg.select_metric), profile, sizes)


def _split_profile(hashed: DataFrame, eval_name: str):
    """Rows and positives per split from one aggregate over the cached table."""
    rows = hashed.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("pos")).collect()
    per = {r["split"]: (r["n"], r["pos"]) for r in rows}
    total = sum(n for n, _ in per.values())
    pos = sum(p for _, p in per.values())
    sizes = {"train": per.get("train", (0, 0))[0], "eval": per.get(eval_name, (0, 0))[0],
             "val": per.get("val", (0, 0))[0], "test": per.get("test", (0, 0))[0]}
    return sizes, {"total_rows": total, "pos_count": pos, "neg_count": total - pos}


def _split_profile_frames(data: DataFrame, train_feat: DataFrame, eval_feat: DataFrame):
    """Random splits: sizes of the persisted splits, class counts of all rows."""
    sizes = {"train": train_feat.count(), "eval": eval_feat.count()}
    row = data.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("pos")).first()
    return sizes, {"total_rows": row["n"], "pos_count": row["pos"], "neg_count": row["n"] - row["pos"]}


def pick_best(results: list, metric: str = "accuracy") -> ModelResult | None:
    """Strictly greater wins, so the first model wins ties; none when all are 0."""
    best, best_value = None, 0.0
    for r in results:
        value = r.metrics.get(metric) or 0.0
        if value > best_value:
            best, best_value = r, value
    return best


def record_outcome(outcome: TrainingOutcome, registry, cfg: TrainConfig, prefix: str,
                   experiment: str = "default", publish_above: float | None = None) -> dict:
    """Write the parent run, one child run per model (params, metrics, time),
    register every model as ``<prefix>-<model>`` and the best as ``<prefix>-best``.
    All rows are appended once per table at the end.

    With ``publish_above`` the best model is only published if its selection metric is
    above it (``registry.metric_gate``); the run records whether it was."""
    with registry.batch():
        return _record(outcome, registry, cfg, prefix, experiment, publish_above)


def passes_gate(spark: SparkSession, best: ModelResult, metric: str, minimum: float) -> bool:
    row = spark.createDataFrame([(best.name, _float(best.metrics.get(metric)))], f"model string, {metric} double")
    return not metric_gate(row, metric, minimum).isEmpty()


# Fixed values (the run record's contract): profile figures logged as metrics.
PROFILE_KEYS = ("pos_count", "neg_count", "total_rows", "null_label_rows", "null_text_rows")


def _record(outcome: TrainingOutcome, registry, cfg: TrainConfig, prefix: str, experiment: str,
            publish_above: float | None) -> dict:
    parent = registry.start_run("multi_model_experiment", experiment)
    registry.log_params(parent, {
        "num_features": cfg.num_features, "train_ratio": cfg.train_ratio,
        "val_ratio": cfg.val_ratio, "total_rows": outcome.profile.get("total_rows"),
        "enable_cv": cfg.enable_cv, "sample_fraction": cfg.sample_fraction,
        "split_mode": cfg.split_mode, "select_on": cfg.select_on,
    })
    registry.log_metrics(parent, {k: outcome.profile[k] for k in PROFILE_KEYS})
    versions = {}
    for r in outcome.results:
        run_id = registry.start_run(r.name, experiment, parent_run_id=parent, position=r.position)
        params = {"model_type": r.name, "num_features": cfg.num_features}
        params.update({f"best_{k}": v for k, v in r.params.items()})
        registry.log_params(run_id, params)
        metrics = dict(r.metrics)
        metrics["training_time_seconds"] = r.training_seconds
        metrics.update({f"cv_fold_avg_metric_{g[0]}": g[2] for g in r.grid})
        registry.log_metrics(run_id, metrics)
        versions[r.name] = registry.register_model(f"{prefix}-{r.name.lower()}", r.model, run_id)
    if outcome.best is not None:
        registry.log_params(parent, {"best_model": outcome.best.name})
        registry.log_metrics(parent, {
            "best_overall_accuracy": outcome.best.metrics.get("accuracy"),
            "best_overall_auc": outcome.best.metrics.get("auc"),
        })
        published = publish_above is None or passes_gate(registry.spark, outcome.best, cfg.select_metric, publish_above)
        registry.log_params(parent, {"publish_above": publish_above, "published": str(published).lower()})
        if published:
            versions["best"] = registry.register_model(f"{prefix}-best", outcome.best.model, parent)
    return versions


def save_outcome(spark: SparkSession, outcome: TrainingOutcome, output_root: str,
                 stamp: str | None = None) -> DataFrame:
    """Save every fitted model under ``<root>/models/<name>-<timestamp>`` and
    write a small index table marking the best one; returns the index."""
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    root = output_root.rstrip("/")
    rows = []
    for r in outcome.results:
        path = f"{root}/models/{r.name.lower()}-{stamp}"
        r.model.write().overwrite().save(path)
        rows.append((r.name, path, outcome.best is r, _float(r.metrics.get("accuracy")), stamp))
    index = spark.createDataFrame(rows, "model string, path string, is_best boolean, accuracy double, saved_at string")
    index.coalesce(1).write.mode("append").parquet(f"{root}/models/_index")
    return index
