"""Learning to rank with Spark ML.

Three learners share one interface: trees boosted on gradients of a listwise loss (the
one for production), boosted trees on single rows, and a linear model on differences between the
positive and the negative rows of a group, with pairs weighted by what swapping them would change
in NDCG.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators import boosting, pairwise
from cartwise.operators.boosting import BoostingParams
from cartwise.operators.features import FEATURE_TYPES
from cartwise.operators.metrics import group_metrics, rank_order, top_per_group
from cartwise.operators.ordering import HOT_ROWS, numbered, running_totals
from cartwise.operators.stats import group_sizes
from cartwise.session import materialize
from cartwise.sources import sinks

LABEL = "added_to_cart"


@dataclass
class RankerParams:
    """Settings of the pointwise baseline."""

    trees: int = 20
    learning_rate: float = 0.05
    max_depth: int = 6
    min_rows_per_leaf: int = 50
    feature_fraction: str = "0.8"
    row_fraction: float = 0.8
    seed: int = 42


@dataclass
class Ranker:
    """A fitted model with the feature order it was trained on."""

    model: PipelineModel
    features: list[str]
    params: dict[str, Any] = field(default_factory=dict)
    #: NDCG of every round as (data, round, at 5, at 10), if the learner notes it.
    history: list[tuple[str, int, float, float]] = field(default_factory=list)

    @property
    def trees(self):
        return self.model.stages[-1]


def save_ranker(ranker: Ranker, tables: dict[str, DataFrame], path: str) -> str:
    """Save model, feature order and settings, and the side tables by name."""
    spark = SparkSession.active()
    own = {
        "features": spark.createDataFrame(
            list(enumerate(ranker.features)), "position INT, name STRING"
        ),
        "params": spark.createDataFrame(
            [(name, json.dumps(value)) for name, value in ranker.params.items()],
            "name STRING, value STRING",
        ),
    }
    return sinks.save_model(ranker.model, {**tables, **own}, path)


def load_ranker(
    spark: SparkSession, path: str, tables: tuple[str, ...] = ()
) -> tuple[Ranker, dict[str, DataFrame]]:
    """A saved ranker, ready to predict, and the side tables asked for."""
    model, read = sinks.load_model(spark, path, (*tables, "features", "params"))
    names = [r["name"] for r in read.pop("features").orderBy("position").collect()]
    params = {r["name"]: json.loads(r["value"]) for r in read.pop("params").collect()}
    return Ranker(model, names, params), read


def numeric_features(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that exist with a numeric or boolean type."""
    kinds = dict(df.dtypes)
    return [n for n in names if kinds.get(n) in FEATURE_TYPES]


def fit_ranker(
    train: DataFrame,
    features: Sequence[str],
    val: DataFrame | None = None,
    params: RankerParams | None = None,
) -> Ranker:
    """Boosted trees on the rows of ``train``; ``val`` stops the boosting early.

    The learner reads its input a few times before it keeps its own compact copy,
    so the frames should be written tables, not long plans.
    """
    params = params or RankerParams()
    columns = [*features, LABEL]
    rows = train.select(*columns, F.lit(False).alias("_val"))
    learner = GBTClassifier(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=params.trees,
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        minInstancesPerNode=params.min_rows_per_leaf,
        featureSubsetStrategy=params.feature_fraction,
        subsamplingRate=params.row_fraction,
        seed=params.seed,
    )
    if val is not None:
        rows = rows.unionByName(val.select(*columns, F.lit(True).alias("_val")))
        learner = learner.setValidationIndicatorCol("_val")
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="keep"
    )
    model = Pipeline(stages=[assembler, learner]).fit(rows)
    return Ranker(model, list(features), vars(params))


def fit_listwise(
    train: DataFrame,
    features: Sequence[str],
    val: DataFrame | None = None,
    params: BoostingParams | None = None,
    group: str = "order_id",
) -> Ranker:
    """Trees boosted on pairwise gradients weighted by NDCG changes; see ``boosting``.

    Missing features count as 0, in the fit and in the scores.
    """
    params = params or BoostingParams()
    prepare = _filled_vector(features)
    values = [F.expr(_filled(f)) for f in features]
    boosted = boosting.fit_boosted_pairs(train, values, val, params, LABEL, group)
    settings = {**vars(params), "best_iteration": boosted.best_iteration}
    return Ranker(PipelineModel([*prepare, boosted.model]), list(features), settings, boosted.history)


def _filled(feature: str) -> str:
    """SQL of a feature as a double, with 0 for null and NaN."""
    return f"coalesce(nanvl(CAST(`{feature}` AS DOUBLE), 0D), 0D)"


def _filled_vector(features: Sequence[str]) -> list:
    """Stages that make ``features`` a vector with zeros for nulls and NaN.

    Filling is a stage of the model, so that rows to score may hold nulls too.
    """
    filled = [f"_filled_{i}" for i in range(len(features))]
    columns = ", ".join(f"{_filled(f)} AS {name}" for f, name in zip(features, filled))
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=filled, outputCol="features"),
    ]


def fit_pairwise(
    train: DataFrame,
    features: Sequence[str],
    rounds: int = 2,
    regularization: float = 0.001,
    iterations: int = 30,
    group: str = "order_id",
) -> Ranker:
    """Linear ranker on positive-minus-negative differences of all pairs of a group; see ``pairwise``.

    Every positive row of a group meets every negative row of it, whichever line it was drawn for;
    rows without a group meet those of their line. The first round weighs pairs equally, later
    ones by the NDCG change of a swap at the current scores. ``train`` may be a plan.
    """
    prepare = _filled_vector(features)
    values = [F.expr(_filled(f)) for f in features]
    model = pairwise.fit_linear_pairs(train, values, rounds, regularization, iterations, LABEL, group)
    settings = {"rounds": rounds, "regularization": regularization, "iterations": iterations}
    return Ranker(PipelineModel([*prepare, model]), list(features), settings)


def swap_weights(
    scored: DataFrame, group: str = "order_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """NDCG change of swapping each negative with its positive at the current scores."""
    slim = scored.select("line_key", group, "item_id", LABEL, "score")
    ranked = materialize(
        numbered(slim, [group], rank_order(), "_rank", hot_rows).select(
            "line_key", group, "item_id", LABEL, (1 / F.log2(F.col("_rank") + 1)).alias("_gain")
        ),
        "ranked",
    )
    gains = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("_n_relevant")), lambda i: 1 / F.log2(i + 1)
    )
    relevant = (
        ranked.groupBy(group)
        .agg(F.sum(F.col(LABEL).cast("long")).alias("_n_relevant"))
        .where(F.col("_n_relevant") > 0)
        .select(group, F.aggregate(gains, F.lit(0.0), lambda total, g: total + g).alias("_ideal"))
    )
    upper = ranked.where(F.col(LABEL) == 1).select(
        "line_key", group, F.col("_gain").alias("_pos_gain")
    )
    return (
        ranked.where(F.col(LABEL) == 0)
        .drop(group)
        .join(upper, "line_key")
        .join(relevant, group)
        .select(
            "line_key",
            "item_id",
            (F.abs(F.col("_pos_gain") - F.col("_gain")) / F.col("_ideal")).alias("_weight"),
        )
    )


def predict(ranker: Ranker, df: DataFrame) -> DataFrame:
    """Adds ``score``; features are taken by name, in training order."""
    missing = sorted(set(ranker.features) - set(df.columns))
    if missing:
        raise ValueError(f"features missing: {', '.join(missing)}")
    raw = ranker.model.transform(df)
    score = vector_to_array("rawPrediction")[1] if "rawPrediction" in raw.columns else F.col("prediction")
    return raw.withColumn("score", score).drop(
        "features", "rawPrediction", "probability", "prediction",
        *[c for c in raw.columns if c.startswith("_filled_")],
    )


def predict_top_n(
    ranker: Ranker, df: DataFrame, n: int = 10, group: str = "order_id"
) -> DataFrame:
    """The ``n`` best rows of each group with their rank."""
    return top_per_group(predict(ranker, df), n, group)


def _importances(ranker: Ranker) -> list[float]:
    """Gains of the trees, or sizes of the weights of a linear ranker; both add up to 1."""
    if hasattr(ranker.trees, "featureImportances"):
        return ranker.trees.featureImportances.toArray().tolist()
    sizes = [abs(w) for w in ranker.trees.coefficients.toArray().tolist()]
    return [w / (sum(sizes) or 1.0) for w in sizes]


def feature_importance(ranker: Ranker, spark: SparkSession) -> DataFrame:
    """(feature, importance) of trees or linear weights; one row per feature."""
    values = _importances(ranker)
    return spark.createDataFrame(
        list(zip(ranker.features, values)), "feature STRING, importance DOUBLE"
    )


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def staged_scores(ranker: Ranker, df: DataFrame, stages: Sequence[int]) -> DataFrame:
    """One row per input row and stage m in ``stages``: the score of the first m trees."""
    rows = PipelineModel(ranker.model.stages[:-1]).transform(df)
    return boosting.staged_scores(ranker.trees, rows, ("order_id", "item_id", "line_key", LABEL), stages)


def training_history(ranker: Ranker, df: DataFrame, every: int = 1) -> DataFrame:
    """Mean NDCG@5 and @10 on ``df`` after each ``every`` trees, against the best order of a group."""
    total = ranker.trees.getNumTrees
    stages = sorted({*range(every, total + 1, every), total})
    per_group = group_metrics(
        staged_scores(ranker, df, stages), (5, 10), ("iteration", "order_id")
    )
    return per_group.groupBy("iteration").agg(
        F.avg("ndcg_full_5").alias("ndcg_5"), F.avg("ndcg_full_10").alias("ndcg_10")
    )


def model_info(ranker: Ranker | None, spark: SparkSession, history: DataFrame | None = None):
    """One row describing the fitted model; ``history`` (a row per stage) names the best stage.

    If the history tells data sets apart, the best stage is that of the validation rows.
    """
    schema = (
        "status STRING, n_features INT, n_trees INT, best_iteration INT, "
        "best_ndcg_10 DOUBLE, top_features STRING"
    )
    if ranker is None:
        return spark.createDataFrame([("not_trained", None, None, None, None, None)], schema)
    if history is not None and "data" in history.columns:
        history = history.where("data = 'valid'")
    best = history.orderBy(F.desc("ndcg_10"), "iteration").first() if history is not None else None
    names = [r.feature for r in top_features(feature_importance(ranker, spark), 10).collect()]
    return spark.createDataFrame(
        [
            (
                "trained",
                len(ranker.features),
                getattr(ranker.trees, "getNumTrees", None),
                best.iteration if best else None,
                best.ndcg_10 if best else None,
                ",".join(names),
            )
        ],
        schema,
    )


def group_kfold(
    df: DataFrame,
    folds: int = 3,
    group: str = "order_id",
    hot_rows: int = HOT_ROWS,
    rows_of: str | None = None,
) -> DataFrame:
    """(group, group_size, fold): groups by falling size dealt to the folds back and forth.

    ``rows_of`` names a column that says how many rows a row of ``df`` stands for.
    """
    if rows_of is None:
        sizes = group_sizes(df, group)
    else:
        sizes = df.groupBy(group).agg(F.sum(rows_of).alias("group_size"))
    placed = running_totals(
        sizes,
        [F.col("group_size").desc(), F.col(group)],
        {"_place": F.lit(1)},
        hot_rows,
    )
    turn, seat = F.floor(F.col("_place") / folds), F.col("_place") % folds
    fold = F.when(turn % 2 == 0, seat).otherwise(F.lit(folds - 1) - seat)
    return placed.select(group, "group_size", fold.cast("int").alias("fold"))


def fit_cv(
    df: DataFrame,
    features: Sequence[str],
    folds: int = 3,
    params: BoostingParams | RankerParams | None = None,
    group: str = "order_id",
    featured: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Ranker, DataFrame]:
    """Grouped cross-validation: the model of the best fold and the score of every fold.

    Folds are fitted side by side: jobs of one fold fill the cores that another leaves idle.
    ``RankerParams`` choose the pointwise trees. With ``featured`` the rows of ``df`` are lines
    with ``n_candidates`` and that function makes their featured candidates: lines are dealt to
    the folds, fits learn from all candidates of the other folds, and every candidate held out is
    scored as it is made. Only ``fit_rows`` of ``params`` draws lines for a fit.
    """
    if featured is None:
        keys = [group, "item_id", "line_key", LABEL]
        dealt_rows = group_kfold(df, folds, group)
        df = df.select(*dict.fromkeys([*keys, *features]))
    else:
        dealt_rows = group_kfold(df, folds, group, rows_of="n_candidates")
    stable = materialize(df.join(dealt_rows.select(group, "fold"), group), "folds")
    whole = featured or (lambda rows: rows)
    listwise = (params or BoostingParams()) if not isinstance(params, RankerParams) else None

    def learned(rows: DataFrame, bound: int | None) -> DataFrame:
        """Rows to learn from: all of them, unless the caller set a bound."""
        if featured is None:
            return rows
        lines = boosting.learning_rows(rows, group, bound, listwise.seed, F.col("n_candidates"))
        return featured(lines.drop("fold"))

    def one(fold: int) -> tuple[int, float, Ranker]:
        held_out, rest = stable.where(F.col("fold") == fold), stable.where(F.col("fold") != fold)
        made = whole(held_out.drop("fold"))
        if listwise is None:
            ranker = fit_ranker(whole(rest.drop("fold")), features, made, params)
        else:
            bound = listwise.fit_rows
            ranker = fit_listwise(
                learned(rest, bound), features, learned(held_out, bound and bound // 4), listwise, group
            )
        scored = predict(ranker, made).select(group, "item_id", "line_key", LABEL, "score")
        # Read for the totals and for the best rows of the groups.
        per_group = group_metrics(materialize(scored, "held_out"), (10,), group)
        return fold, per_group.agg(F.avg("ndcg_10")).first()[0], ranker

    with ThreadPoolExecutor(folds) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds)))
    best = max(results, key=lambda r: (r[1], -r[0]))[2]
    scores = df.sparkSession.createDataFrame([r[:2] for r in results], "fold INT, ndcg_10 DOUBLE")
    return best, scores


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.avg("ndcg_10").alias("mean_score"),
        F.stddev_pop("ndcg_10").alias("std_score"),
        F.max_by("fold", F.struct("ndcg_10", -F.col("fold"))).alias("best_fold"),
    )
