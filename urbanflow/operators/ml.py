"""Spark ML: preprocessing, logistic regression, temporal backtests and scores."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.operators.evaluation import binary_metrics


def category_strings(df: DataFrame, columns: list[str], width: int = 2) -> DataFrame:
    """<name>_cat: zero-padded numbers, whose alphabetical order is the numeric one."""
    return df.withColumns({f"{c}_cat": F.format_string(f"%0{width}d", F.col(c).cast("int")) for c in columns})


def stages(numeric: list[str], flags: list[str], categories: list[str], median_error: float = 0.001) -> list:
    filled = [f"{c}_filled" for c in numeric]
    return [
        Imputer(inputCols=numeric, outputCols=filled, strategy="median", relativeError=median_error),
        VectorAssembler(inputCols=filled, outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        *(StringIndexer(inputCol=c, outputCol=f"{c}_index", stringOrderType="alphabetAsc", handleInvalid="error") for c in categories),
        OneHotEncoder(inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_hot" for c in categories], dropLast=True),
        VectorAssembler(inputCols=["scaled", *flags, *(f"{c}_hot" for c in categories)], outputCol="features"),
    ]


def require_values(train: DataFrame, numeric: list[str]) -> None:
    """A feature without any finite value has no median: an error."""
    row = train.agg(*(F.count(F.when(~F.isnan(F.col(c).cast("double")) & (F.abs(c) < float("inf")), 1)).alias(c) for c in numeric)).first()
    if gone := [c for c in numeric if not row[c]]:
        raise ValueError(f"no valid value of {gone}")


def fit_preprocess(train: DataFrame, numeric: list[str], flags: list[str], categories: list[str], median_error: float = 0.001) -> PipelineModel:
    """median_error: by how much of the rows a median may be off; 0 is exact and dear."""
    require_values(train, numeric)
    return Pipeline(stages=stages(numeric, flags, categories, median_error)).fit(train)


def fit_logistic(train: DataFrame, label: str, numeric: list[str], flags: list[str], categories: list[str]) -> PipelineModel:
    require_values(train, numeric)
    model = LogisticRegression(featuresCol="features", labelCol=label, regParam=0.1, elasticNetParam=0.0, maxIter=100)
    return Pipeline(stages=[*stages(numeric, flags, categories), model]).fit(train)


def probability():
    """Of label 1, in what a fitted regression gives."""
    return vector_to_array("probability")[1]


def score(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(df).select(*keep, probability().alias("score"))


def fitted_state(model: PipelineModel) -> DataFrame:
    """What a pipeline has learned: (stage, name, position, value), the weights of a fitted regression among it.

    Weights have the names of what they weigh: a numeric column or flag, or column=label of a category.
    """
    from pyspark.sql import SparkSession

    rows, names = [], []
    for s in model.stages:
        kind = type(s).__name__
        if kind == "ImputerModel":
            medians = s.surrogateDF.first().asDict()
            rows += [("median", c, i, float(v)) for i, (c, v) in enumerate(sorted(medians.items()))]
            names = list(s.getInputCols())
        elif kind == "StandardScalerModel":
            rows += [(k, "scaled", i, float(v)) for k, vec in (("mean", s.mean), ("std", s.std)) for i, v in enumerate(vec)]
        elif kind == "StringIndexerModel":
            rows += [("label", f"{s.getInputCol()}={x}", i, float(i)) for i, x in enumerate(s.labels)]
        elif kind == "LogisticRegressionModel":
            labels = {x.getOutputCol().removesuffix("_index"): [f"{x.getInputCol()}={v}" for v in x.labels] for x in model.stages if type(x).__name__ == "StringIndexerModel"}
            last = next(x for x in reversed(model.stages) if type(x).__name__ == "VectorAssembler")
            for c in last.getInputCols()[1:]:
                names += labels[c.removesuffix("_hot")][:-1] if c.endswith("_hot") else [c]
            rows += [("weight", n, i, float(v)) for i, (n, v) in enumerate(zip(names, s.coefficients, strict=True))] + [("weight", "intercept", len(names), float(s.intercept))]
    return SparkSession.active().createDataFrame(rows, "stage string, name string, position int, value double")


def score_by_state(df: DataFrame, state: DataFrame, numeric: list[str], flags: list[str], categories: list[str], keep: list[str]) -> DataFrame:
    """Scores from `fitted_state` alone, by column expressions, without the pipeline.  A category that wasn't learned has none."""
    learned: dict[str, dict] = {}
    for r in state.collect():  # some dozens of numbers
        learned.setdefault(r.stage, {})[r.position if r.name == "scaled" else r.name] = r.value
    margin, known = F.lit(learned["weight"]["intercept"]), F.lit(True)
    for i, c in enumerate(numeric):
        x = F.when(F.col(c).isNull() | F.isnan(c), learned["median"][c]).otherwise(F.col(c))
        scale = learned["std"][i]
        margin = margin + F.lit(learned["weight"][c] / scale if scale else 0.0) * (x - learned["mean"][i])
    for c in flags:
        margin = margin + F.lit(learned["weight"][c]) * F.col(c)
    for c in categories:
        own = {name: learned["weight"].get(name, 0.0) for name in learned["label"] if name.startswith(f"{c}=")}
        weight = F.create_map(*(F.lit(x) for item in own.items() for x in item))[F.concat(F.lit(f"{c}="), F.col(c))]
        margin, known = margin + weight, known & weight.isNotNull()
    return df.select(*keep, F.when(known, 1 / (1 + F.exp(-margin))).alias("score"))


def gradient(model: PipelineModel, train: DataFrame, label: str) -> DataFrame:
    """position and value of the gradient of the penalised loss at a fitted regression; close to 0 where it is the optimum."""
    last = model.stages[-1]
    rows = model.transform(train).select((probability() - F.col(label)).alias("r"), F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"))
    sums = rows.select("r", F.posexplode("x").alias("position", "x")).groupBy("position").agg(F.avg(F.col("r") * F.col("x")).alias("slope"), F.var_samp("x").alias("spread"))
    weights = train.sparkSession.createDataFrame([(i, float(w)) for i, w in enumerate([*last.coefficients, 0.0])], "position int, w double")  # the intercept has no penalty
    return sums.join(F.broadcast(weights), "position").select("position", (F.col("slope") + last.getRegParam() * F.col("spread") * F.col("w")).alias("value"))


def vector_checks(df: DataFrame, column: str, size: int) -> DataFrame:
    """rows, rows of another size, rows with a value that isn't finite."""
    odd = F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    return df.select(vector_to_array(column).alias("x")).agg(F.count("*").alias("n_rows"), F.sum((F.size("x") != size).cast("bigint")).alias("n_wrong_size"), F.sum(odd.cast("bigint")).alias("n_not_finite"))


def backtest(df: DataFrame, folds: dict[str, tuple], label: str, numeric: list[str], flags: list[str], categories: list[str]) -> DataFrame:
    """Metrics of each fold: (training condition, validation condition).  The folds are few and fit one by one."""
    out = None
    for name, (train, valid) in folds.items():
        model = fit_logistic(df.where(train), label, numeric, flags, categories)
        rows = binary_metrics(score(model, df.where(valid), [label]), label, "score").withColumn("fold", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out
