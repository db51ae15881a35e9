"""Evaluation of predictions with SQL aggregates, and records of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.windows import running_sum, with_windows


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   digits: int = 6) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, from one pass."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(actual & predicted).alias("tp"),
                    F.count_if(~actual & predicted).alias("fp"),
                    F.count_if(actual & ~predicted).alias("fn"),
                    F.count_if(F.col(label) == F.col(prediction)).alias("hits"))
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return counts.select(
        "n", "tp", "fp", "fn", F.round(F.try_divide("hits", "n"), digits).alias("accuracy"),
        F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"),
        F.round(f1, digits).alias("f1"))


def area_under_curve(df: DataFrame, label: str = "label", score: str = "score", digits: int = 6,
                     **window_options) -> DataFrame:
    """Area under the ROC curve of class 1: how often a 1 scores above a 0, equal scores counting half.

    Rows are counted per score first; a running count over the scores, cut into chunks, then gives
    the zeros below each. Null without rows of both classes; rows with a null label or score are left out.
    """
    counts = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("ones"), F.count_if(F.col(label) != 1).cast("double").alias("zeros"))
    below = with_windows(counts, [], ["score"], {"upto": running_sum("zeros")}, **window_options)
    pairs = F.sum(F.col("ones") * (F.col("upto") - F.col("zeros") / 2))
    return below.agg(F.round(F.try_divide(pairs, F.sum("ones") * F.sum("zeros")), digits).alias("auc"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support of every class, from the counted label pairs."""
    cells = confusion_matrix(df, label, prediction)
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none)
    by_class = cells.select(F.inline(F.array(
        F.struct(F.col("label").cast("double").alias("class"), hit.alias("tp"),
                 F.col("n").alias("support"), none.alias("predicted")),
        F.struct(F.col("prediction").cast("double").alias("class"), none.alias("tp"),
                 none.alias("support"), F.col("n").alias("predicted")),
    ))).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    precision = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("predicted") + F.col("support")), F.lit(0.0))
    return by_class.select(
        "class", F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"),
        F.round(f1, digits).alias("f1"), "support")


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       digits: int = 4) -> DataFrame:
    """RMSE, MAE and R squared from one pass."""
    error = F.col(label) - F.col(prediction)
    sums = df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
                  F.var_pop(label).alias("var"), F.count(F.lit(1)).alias("n"))
    return sums.select(
        "n", F.round(F.sqrt("mse"), digits).alias("rmse"), F.round("mae", digits).alias("mae"),
        F.round(1 - F.try_divide("mse", "var"), digits).alias("r2"))


def log_run(spark: SparkSession, path: str, run_id: str, experiment: str, params: dict[str, str],
            metrics: dict[str, float]) -> None:
    """Append one run to the runs table as rows of (kind, name, text, value)."""
    rows = [(run_id, experiment, "param", k, str(v), None) for k, v in params.items()]
    rows += [(run_id, experiment, "metric", k, None, float(v)) for k, v in metrics.items()]
    spark.createDataFrame(
        rows, "run_id string, experiment string, kind string, name string, text string, value double"
    ).write.mode("append").parquet(path)


def leaderboard(runs: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    """Runs of each experiment ordered by a metric, with their parameters as one text."""
    params = runs.filter(F.col("kind") == "param").groupBy("run_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", "text"))), ", ").alias("params"))
    scores = runs.filter((F.col("kind") == "metric") & (F.col("name") == metric)).select(
        "run_id", "experiment", F.col("value").alias(metric))
    order = F.desc(metric) if higher_is_better else F.asc(metric)
    return scores.join(params, "run_id", "left").orderBy(order, "run_id")
