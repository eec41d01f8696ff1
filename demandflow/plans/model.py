"""Demand models on Spark ML: fitted and scored on the cluster, no Python in the rows.

The Poisson model is kept as data, a table with one row of coefficients per version: scoring is an
expression over a one-row join, and any engine that reads the table scores the same. Boosted trees are
fitted beside it and judged on the same holdout.
"""

from __future__ import annotations

from functools import reduce
from math import inf, isqrt, nextafter
from operator import add, and_

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.plans.forecast import mae
from demandflow.session import run_folder
from demandflow.sinks.tables import materialize

LABEL = "total_quantity"

# With a log link the effects multiply, so averages enter as logs (a doubled average doubles the
# forecast) and the week as a yearly wave.
_TERMS = """
SELECT *,
       ln(1 + rolling_4wk_avg) AS log_4wk,
       ln(1 + avg_demand_last_12w) AS log_12wk,
       CAST(is_promoted AS DOUBLE) AS promoted,
       sin(2 * pi() * week_of_year / 52) AS season_sin,
       cos(2 * pi() * week_of_year / 52) AS season_cos
FROM __THIS__
"""
FEATURES = ["rolling_4wk_avg", "avg_demand_last_12w", "is_promoted", "discount_pct_feat", "week_of_year"]
_INPUTS = ["log_4wk", "log_12wk", "promoted", "discount_pct_feat", "season_sin", "season_cos"]


MODEL_PREFIX = "glm_poisson_v"


def model_name(version: int) -> str:
    return f"{MODEL_PREFIX}{version}"


def fit_demand_model(training: DataFrame, max_iter: int = 25) -> PipelineModel:
    """Fit on rows with the five features and the label; rows that lack one teach nothing. Every
    iteration is one pass of partial sums over the cluster. Pass a written table, as each iteration reads ``training`` again."""
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="inputs", labelCol=LABEL,
        predictionCol="prediction", maxIter=max_iter, regParam=1e-6,
    )
    stages = [
        SQLTransformer(statement=_TERMS),
        VectorAssembler(inputCols=_INPUTS, outputCol="inputs", handleInvalid="keep"),
        glm,
    ]
    return Pipeline(stages=stages).fit(training.dropna(subset=[*FEATURES, LABEL]))


def glm_predictor(model: PipelineModel):
    """Predictor for ``forecast.score``. Every row comes back; one that lacks a feature has no
    prediction rather than a prediction of zero."""

    def predict(features: DataFrame) -> DataFrame:
        scored = model.transform(features)
        whole = reduce(and_, [F.col(c).isNotNull() for c in FEATURES])
        known = F.when(whole, F.greatest(F.lit(0.0), F.col("prediction")))
        return scored.select(*features.columns, known.alias("prediction"))

    return predict


def model_mae(model: PipelineModel, holdout: DataFrame) -> DataFrame:
    """Model and both naive errors over the complete rows, and whether the model beats them."""
    errors = glm_predictor(model)(holdout.dropna(subset=FEATURES)).agg(
        mae(LABEL, "prediction").alias("mae_holdout"),
        mae(LABEL, "avg_demand_last_12w").alias("mae_naive_avg12w"),
        mae(LABEL, "rolling_4wk_avg").alias("mae_naive_rolling4w"),
    )
    best_naive = F.least("mae_naive_avg12w", "mae_naive_rolling4w")
    return errors.withColumn("beats_naive", F.col("mae_holdout") <= best_naive)


def fit_and_evaluate(training: DataFrame, folder: str) -> tuple[PipelineModel, DataFrame]:
    """Fit on the ``train`` part and judge on the ``test`` part of a training set.

    The set is written once to the shared folder, so neither the iterations nor the evaluation
    repeat the joins behind it, and losing an executor costs nothing.
    """
    rows = materialize(training, f"{folder}/training_set", partition_by=["part"])
    model = fit_demand_model(rows.where("part = 'train'"))
    return model, model_mae(model, rows.where("part = 'test'"))


def coefficients(model: PipelineModel) -> dict[str, float]:
    glm = model.stages[-1]
    return {"intercept": float(glm.intercept), **dict(zip(_INPUTS, map(float, glm.coefficients)))}


def save_coefficients(spark: SparkSession, folder: str, terms: dict[str, float], version: int | None = None) -> int:
    """Write a model as a table of one row; its number follows the highest in the folder unless given."""
    version = version or latest_version(spark, folder) + 1
    columns = ["intercept", *_INPUTS]
    row = spark.createDataFrame([(model_name(version), *[terms[c] for c in columns])], ["model_version", *columns])
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{model_name(version)}")
    return version


def load_coefficients(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/{model_name(version)}")


def coefficient_predictor(terms: DataFrame, version: int):
    """Predictor for ``forecast.score`` from a row of coefficients; a row that lacks a feature has no prediction."""
    name = model_name(version)
    model = terms.where(F.col("model_version") == name).select(
        F.col("model_version").alias("__version"), *[F.col(c).alias(f"__{c}") for c in ("intercept", *_INPUTS)]
    )
    year = 2 * F.pi() * F.col("week_of_year") / 52
    values = {
        "log_4wk": F.ln(1 + F.col("rolling_4wk_avg")), "log_12wk": F.ln(1 + F.col("avg_demand_last_12w")),
        "promoted": F.col("is_promoted").cast("double"), "discount_pct_feat": F.col("discount_pct_feat"),
        "season_sin": F.sin(year), "season_cos": F.cos(year),
    }

    def predict(features: DataFrame) -> DataFrame:
        # one row by its version, so the broadcast is of one row
        joined = features.withColumn("__version", F.lit(name)).join(F.broadcast(model), "__version")
        total = reduce(add, [F.col(f"__{c}") * values[c] for c in _INPUTS], F.col("__intercept"))
        return joined.select(*features.columns, F.exp(total).alias("prediction"))

    return predict


def latest_version(spark: SparkSession, folder: str) -> int:
    """Highest version saved in a folder, 0 when there is none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MODEL_PREFIX}*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return max((int(f.getPath().getName().removeprefix(MODEL_PREFIX)) for f in found), default=0)


def fit_trees(training: DataFrame, trees: int = 20, depth: int = 5) -> PipelineModel:
    """Boosted regression trees on the log of demand, over the same features; incomplete rows teach nothing.

    A tree only sees between which split candidates a value lies, so rows that agree in that for every feature stay
    together in all trees. They are one row here, with their mean and their number as weight, which gives the
    trees of all rows: a split gains the same and a leaf is the same mean, but for rounding, which decides between
    splits that part the rows alike. The rows are read three times, however many trees there are, and what is kept
    for the trees is bounded by the candidates. The model meets raw features with the same candidates.
    """
    settings = dict(featuresCol="inputs", labelCol="log_demand", predictionCol="log_prediction", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=17)
    logs = SQLTransformer(statement=f"SELECT *, ln(1 + {LABEL}) AS log_demand FROM __THIS__")
    rows = logs.transform(training.dropna(subset=[*FEATURES, LABEL]))
    raw = VectorAssembler(inputCols=FEATURES, outputCol="inputs", handleInvalid="keep").transform(rows)
    # a candidate itself lies below its split, and a bucket holds its lower end
    ends = [[-inf, *[nextafter(c, inf) for c in found or [0.0]], inf] for found in split_candidates(GBTRegressor(**settings), raw)]
    buckets = [f"{c}_bucket" for c in FEATURES]
    bucketizer = Bucketizer(splitsArray=ends, inputCols=FEATURES, outputCols=buckets, handleInvalid="keep")
    # without the note that buckets are kinds without an order
    plain = [F.col(b).alias(b, metadata={}) for b in buckets]
    cells = bucketizer.transform(rows).groupBy(*plain).agg(F.avg("log_demand").alias("log_demand"), F.count(F.lit(1)).cast("double").alias("rows"))
    cells = materialize(cells, f"{run_folder(training.sparkSession, 'tree-cells')}/cells")
    assembler = VectorAssembler(inputCols=buckets, outputCol="inputs", handleInvalid="keep")
    # every border between two buckets is a candidate, and no cell is left out in looking for them
    gbt = GBTRegressor(**settings, weightCol="rows", maxBins=max(64, isqrt(cells.count()) + 1))
    return PipelineModel(stages=[logs, bucketizer, assembler, gbt.fit(assembler.transform(cells))])


def split_candidates(gbt: GBTRegressor, rows: DataFrame) -> list[list[float]]:
    """The thresholds of every feature among which ``gbt`` would choose on these rows, by its own search."""
    gbt._transfer_params_to_java()
    ml, learner = rows.sparkSession._jvm.org.apache.spark.ml, gbt._java_obj

    def scala(package, name: str):
        return getattr(getattr(package, f"{name}$"), "MODULE$")

    utils = scala(ml.util, "DatasetUtils")
    instances = utils.extractInstances(learner, rows._jdf, getattr(utils, "extractInstances$default$3")())
    kinds = ml.util.MetadataUtils.getCategoricalFeatures(rows._jdf.schema().apply(gbt.getFeaturesCol()))
    regression = rows.sparkSession._jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()
    strategy = learner.getOldBoostingStrategy(kinds, regression).treeStrategy()
    known = ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, gbt.getFeatureSubsetStrategy())
    found = scala(ml.tree.impl, "RandomForest").findSplits(instances, known, gbt.getSeed())
    return [[split.threshold() for split in feature] for feature in found]


def trees_predictor(model: PipelineModel):
    scorer = PipelineModel(stages=model.stages[1:])

    def predict(features: DataFrame) -> DataFrame:
        scored = scorer.transform(features)
        whole = reduce(and_, [F.col(c).isNotNull() for c in FEATURES])
        known = F.when(whole, F.greatest(F.lit(0.0), F.exp("log_prediction") - 1))
        return scored.select(*features.columns, known.alias("prediction"))

    return predict


def choose_model(predictors: dict, training: DataFrame, holdout: DataFrame, future: DataFrame) -> DataFrame:
    """(model, train_rows, holdout_rows, scored_rows, mae_holdout, is_chosen): every predictor on the same
    holdout; the smallest error is chosen, ties by name."""
    rows = []
    for name, predict in predictors.items():
        judged = predict(holdout.dropna(subset=FEATURES)).agg(F.count("prediction").alias("holdout_rows"), mae(LABEL, "prediction").alias("mae_holdout"))
        rows.append(judged.select(
            F.lit(name).alias("model"),
            training.dropna(subset=[*FEATURES, LABEL]).agg(F.count(F.lit(1))).scalar().alias("train_rows"), "holdout_rows",
            predict(future).agg(F.count("prediction")).scalar().alias("scored_rows"), "mae_holdout",
        ))
    table = reduce(DataFrame.unionByName, rows)
    best = table.agg(F.min(F.struct("mae_holdout", "model"))["model"])
    return table.withColumn("is_chosen", F.col("model") == best.scalar())
