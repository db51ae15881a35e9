"""Statistics, feature preparation, models, tuning and run records."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import expressions as X
from tidewater.ml import evaluation as E
from tidewater.ml import features as M
from tidewater.ml import models as L
from tidewater.ml import perceptron as N
from tidewater.ml import statistics as ST
from tidewater.operators.layout import persisted
from tidewater.operators.quantiles import exact_quantiles
from tidewater.operators.sampling import split_column, split_two
from tidewater.plans.model_sql import first_components, logistic_fit, md5_bucket, penalised_fit
from tidewater.plans.registry import query
from tidewater.plans.scalars import RIDES
from tidewater.plans.tables import EMPLOYEES, Tables
from tidewater.session import scratch_path
from tidewater.streaming.aggregates import ride_columns

# Statistics


@query("corr_pair", """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem""")
def corr_pair(t):
    return t.lineitem.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@query("cov_pair", """
    SELECT round(covar_samp(l_quantity, l_extendedprice), 4) AS covariance FROM lineitem""")
def cov_pair(t):
    return t.lineitem.agg(F.round(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("covariance"))


_MATRIX = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _MATRIX for b in _MATRIX))
def corr_matrix(t):
    return ST.correlation_matrix(t.lineitem, _MATRIX)


@query("corr_spearman", """
    WITH a AS (SELECT rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS ra,
                      rank() OVER (ORDER BY user_id) + (count(*) OVER (PARTITION BY user_id) - 1) / 2 AS rb FROM events)
    SELECT round(corr(ra, rb), 6) AS rho FROM a""")
def corr_spearman(t):
    return ST.spearman(t.events, "value", "user_id")


@query("quantiles", """
    SELECT quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.5) AS q2,
           quantile_disc(o_totalprice, 0.75) AS q3 FROM orders""")
def quantiles(t):
    exact = exact_quantiles(t.orders, {"o_totalprice": [0.25, 0.5, 0.75]})["o_totalprice"]
    return t.spark.createDataFrame([tuple(exact)], "q1 double, q2 double, q3 double")


def _summary(c: str) -> str:
    def r(value: str) -> str:
        return f"round(CAST({value} AS DECIMAL(38, 10)), 4)::DOUBLE"

    return (f"SELECT '{c}' AS \"column\", {r(f'avg({c})')} AS mean, {r(f'var_samp({c})')} AS variance, "
            f"{r(f'stddev_samp({c})')} AS std, min({c}) AS min, max({c}) AS max FROM lineitem")


@query("summarizer", " UNION ALL ".join(_summary(c) for c in ("l_quantity", "l_discount", "l_tax")))
def summarizer(t):
    return ST.vector_summary(t.lineitem, ["l_quantity", "l_discount", "l_tax"])


def _chi(feature: str) -> str:
    return f"""
    SELECT '{feature}' AS feature, round(sum(power(coalesce(o.n, 0) - e.e, 2) / e.e), 6) AS statistic,
           (count(DISTINCT e.f) - 1) * (count(DISTINCT e.y) - 1) AS dof
    FROM (SELECT a.f, b.y, a.n * b.n / t.n AS e
          FROM (SELECT {feature} AS f, count(*) AS n FROM orders GROUP BY 1) a,
               (SELECT o_orderpriority AS y, count(*) AS n FROM orders GROUP BY 1) b,
               (SELECT count(*) AS n FROM orders) t) e
    LEFT JOIN (SELECT {feature} AS f, o_orderpriority AS y, count(*) AS n FROM orders GROUP BY 1, 2) o
      ON o.f = e.f AND o.y = e.y"""


_MONTH = "month(o_orderdate)"


@query("chi_square", _chi("o_orderstatus") + " UNION ALL " + _chi(_MONTH).replace(f"'{_MONTH}'", "'order_month'"))
def chi_square(t):
    orders = t.orders.withColumn("order_month", F.month("o_orderdate").cast("string"))
    tested = ST.chi_square(orders, ["o_orderstatus", "order_month"], "o_orderpriority")
    return tested.select("feature", "statistic", "dof")


# Feature preparation


@query("string_index", """
    WITH p AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS p_type_idx
               FROM part GROUP BY 1),
    b AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS p_brand_idx
          FROM part GROUP BY 1)
    SELECT p_partkey, p_type_idx, p_brand_idx FROM part JOIN p USING (p_type) JOIN b USING (p_brand)""")
def string_index(t):
    return M.index_strings(t.part, ["p_type", "p_brand"]).select("p_partkey", "p_type_idx", "p_brand_idx")


@query("one_hot", """
    WITH s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i
               FROM customer GROUP BY 1)
    SELECT c_custkey, CAST(CAST(i = 0 AS INTEGER) AS DOUBLE) AS c_mktsegment_0,
           CAST(CAST(i = 1 AS INTEGER) AS DOUBLE) AS c_mktsegment_1,
           CAST(CAST(i = 2 AS INTEGER) AS DOUBLE) AS c_mktsegment_2,
           CAST(CAST(i = 3 AS INTEGER) AS DOUBLE) AS c_mktsegment_3
    FROM customer JOIN s USING (c_mktsegment)""")
def one_hot(t):
    return M.one_hot(t.customer, "c_mktsegment").select("c_custkey", *[f"c_mktsegment_{i}" for i in range(4)])


_RIDE_INPUTS = ["distance", "fare", "passengers", "duration_min"]


def _rides(t: Tables) -> DataFrame:
    """Plausible rides with a numeric row key made of all identifying columns."""
    rides = ride_columns(t.trips).filter(
        (F.col("fare") > 0) & (F.col("distance") > 0) & (F.col("duration_min") > 0) & F.col("passengers").isNotNull())
    return rides.withColumn("ride", F.concat_ws("-", "order_key", "vendor_id", "do_zone", "pu_zone"))


RIDES_ML = RIDES + """,
ml AS (SELECT *, concat_ws('-', order_key, vendor_id, do_zone, pu_zone) AS ride FROM rides
       WHERE fare > 0 AND distance > 0 AND duration_min > 0 AND passengers IS NOT NULL)"""


@query("assemble", f"""
    WITH {RIDES_ML} SELECT ride, distance AS f0, fare AS f1, passengers AS f2, duration_min AS f3 FROM ml""")
def assemble(t):
    vectors = M.assemble(_rides(t), _RIDE_INPUTS).select("ride", "features")
    return M.expand_vector(vectors, "features", ["f0", "f1", "f2", "f3"])


@query("scale_standard", """
    SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6)
             AS o_totalprice_scaled FROM orders""")
def scale_standard(t):
    return M.scaled(t.orders, ["o_totalprice"], "standard", 6).select("o_orderkey", "o_totalprice_scaled")


@query("scale_minmax", """
    SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ())
             / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS o_totalprice_scaled FROM orders""")
def scale_minmax(t):
    return M.scaled(t.orders, ["o_totalprice"], "minmax", 6).select("o_orderkey", "o_totalprice_scaled")


@query("bucketize", f"""
    WITH {EMPLOYEES}
    SELECT employee_id, CASE WHEN age < 25 THEN 0.0::DOUBLE WHEN age < 35 THEN 1 WHEN age < 45 THEN 2 ELSE 3 END AS age_band
    FROM employees""")
def bucketize(t):
    inf = float("inf")
    ages = t.employees.select("employee_id", F.col("age").cast("double").alias("age"))
    return M.bucketed(ages, "age", [-inf, 25, 35, 45, inf], "age_band").select("employee_id", "age_band")


@query("discretize_quantile", """
    WITH q AS (SELECT quantile_disc(o_totalprice, 0.25) AS a, quantile_disc(o_totalprice, 0.5) AS b,
                      quantile_disc(o_totalprice, 0.75) AS c FROM orders)
    SELECT CAST((o_totalprice >= a)::INT + (o_totalprice >= b)::INT + (o_totalprice >= c)::INT AS DOUBLE) AS bucket,
           count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high
    FROM orders, q GROUP BY 1""")
def discretize_quantile(t):
    return M.quantile_buckets(t.orders, "o_totalprice", 4, "bucket").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query("poly_expand", f"""
    WITH {RIDES_ML}
    SELECT ride, distance AS x, distance * distance AS xx, fare AS y, distance * fare AS xy, fare * fare AS yy FROM ml""")
def poly_expand(t):
    return M.polynomial(_rides(t), ["distance", "fare"], 2, ["x", "xx", "y", "xy", "yy"]).select(
        "ride", "x", "xx", "y", "xy", "yy")


def _points(t: Tables) -> DataFrame:
    """Embeddings as vectors with their class."""
    return t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                               F.col("label").cast("double").alias("label"))


@query("pca", f"""
    WITH RECURSIVE {first_components('embedding', 'embeddings', ['vec_id'])}
    SELECT vec_id, round(list_dot_product(x, one.v), 4) AS pc1, round(list_dot_product(x, two.v), 4) AS pc2
    FROM vectors, one, two""")
def pca(t):
    return M.principal_components(_points(t), "features", 2).select(
        "vec_id", F.round("pc1", 4).alias("pc1"), F.round("pc2", 4).alias("pc2"))


@query("vector_columns", """
    SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e0, CAST(embedding[2] AS DOUBLE) AS e1,
           CAST(len(embedding) AS BIGINT) AS width FROM embeddings""")
def vector_columns(t):
    values = vector_to_array(F.col("features"))
    return _points(t).select("vec_id", values[0].alias("e0"), values[1].alias("e1"),
                             F.size(values).cast("bigint").alias("width"))


def _workers(t: Tables) -> DataFrame:
    """Employees with gaps and a label, marked as train or test."""
    return t.employees.select(
        "employee_id", F.when(F.col("age") % 7 != 0, F.col("age").cast("double")).alias("age"), "salary",
        F.coalesce("city", F.lit(" ")).alias("city"), "department",
        X.yes_no_label(F.when(F.col("salary") > 4500, "Yes").otherwise("no")).alias("label"),
        split_column("employee_id", {"train": 0.8, "test": 0.2}).alias("split"))


_MARK = """CASE WHEN CAST(('0x' || substr(md5(employee_id || '#42'), 1, 7)) AS BIGINT) % 10000 < 8000
                THEN 'train' ELSE 'test' END"""


@query("feature_pipeline", f"""
    WITH {EMPLOYEES}, w AS (
      SELECT employee_id, CASE WHEN age % 7 <> 0 THEN CAST(age AS DOUBLE) END AS age, department, {_MARK} AS split
      FROM employees),
    filled AS (SELECT employee_id, department, split,
                      coalesce(age, (SELECT quantile_disc(age, 0.5) FROM w WHERE split = 'train')) AS age FROM w),
    s AS (SELECT avg(age) AS m, stddev_samp(age) AS d FROM filled WHERE split = 'train'),
    i AS (SELECT department, CAST(row_number() OVER (ORDER BY count(*) DESC, department) - 1 AS DOUBLE) AS idx
          FROM filled WHERE split = 'train' GROUP BY 1)
    SELECT employee_id, split, round((age - m) / d, 6) AS age_scaled, idx AS department_idx
    FROM filled JOIN i USING (department), s""")
def feature_pipeline(t):
    """Fill values, indices and scaling learned on the training part, applied to both parts."""
    workers = _workers(t)
    prepared = M.TabularFeatures(["age"], ["department"]).fit(workers.filter(F.col("split") == "train"))
    vectors = prepared.transform(workers).select("employee_id", "split", "features")
    named = M.expand_vector(vectors, "features", ["age_scaled", "department_idx"])
    return named.withColumn("age_scaled", F.round("age_scaled", 6))


# Models. Penalised least squares have a solution that SQL can reach; results of other fits have no oracle.

#: Test rows are fold 0 of one part, training rows fold 1.
_TEST_FOLD = f"CASE WHEN {md5_bucket("ride || '#42'", 10_000)} < 8000 THEN 1 ELSE 0 END"
_RIDE_DATA = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_RIDE_INPUTS, start=1))


def _regression_sql(models: dict[str, tuple[float, float]]) -> str:
    return f"""
    WITH RECURSIVE {RIDES_ML}, data AS (SELECT {_RIDE_DATA}, tip AS y, {_TEST_FOLD} AS fold FROM ml),
    {penalised_fit(models)}
    SELECT model, count(*) AS n, round(sqrt(avg(power(y - z, 2))), 4) AS rmse, round(avg(abs(y - z)), 4) AS mae,
           round(1 - avg(power(y - z, 2)) / var_pop(y), 4) AS r2 FROM errors GROUP BY model"""


def _tuning_sql(maps: list[dict], fold: str, parts: int) -> str:
    """Mean error per trial over the parts; only training rows take part."""
    models = {", ".join(f"{k}={v}" for k, v in sorted(m.items())): (m["regParam"], m.get("elasticNetParam", 0.0))
              for m in maps}
    trials = ", ".join(f"({i}, '{name}')" for i, name in enumerate(models))
    return f"""
    WITH RECURSIVE {RIDES_ML},
    data AS (SELECT {_RIDE_DATA}, tip AS y, {fold} AS fold FROM ml WHERE {_TEST_FOLD} = 1),
    {penalised_fit(models, parts)},
    scores AS (SELECT model, part, sqrt(avg(power(y - z, 2))) AS rmse FROM errors GROUP BY ALL)
    SELECT CAST(trial AS BIGINT) AS trial, model AS params, round(avg(rmse), 6) AS rmse
    FROM scores JOIN (VALUES {trials}) v(trial, model) USING (model) GROUP BY ALL"""


class Tasks:
    """Training tables shared by the model queries."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def regression(self) -> tuple[DataFrame, DataFrame]:
        rides = _rides(self.t).withColumn("label", F.col("tip"))
        return split_two(M.assemble(rides, _RIDE_INPUTS).select("ride", "features", "label"), "ride")

    @cached_property
    def classification(self) -> tuple[DataFrame, DataFrame]:
        rides = _rides(self.t).withColumn("label", (F.col("tip") / F.col("fare") > 0.20).cast("double"))
        return split_two(M.assemble(rides, _CLASS_INPUTS).select("ride", "features", "label"), "ride")

    @cached_property
    def points(self) -> tuple[DataFrame, DataFrame]:
        return split_two(_points(self.t), "vec_id")


def _report(parts: tuple[DataFrame, DataFrame], kinds: dict[str, dict], measure) -> DataFrame:
    """Metrics of several models, a row each; both sides are computed once for all of them."""
    train, test = parts
    read = ["features", "label"]
    with L.training_rows(train, read) as kept, persisted(test.select(*read)) as held:
        report = _stack({name: measure(L.estimator(**spec).fit(kept).transform(held)) for name, spec in kinds.items()})
        return train.sparkSession.createDataFrame(report.collect(), report.schema)


def _regression_report(t: Tables, kinds: dict[str, dict]) -> DataFrame:
    return _report(Tasks(t).regression, kinds, E.regression_metrics)


def _classification_report(t: Tables, kinds: dict[str, dict]) -> DataFrame:
    return _report(Tasks(t).classification, kinds, E.binary_metrics)


def _stack(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        named = df.select(F.lit(name).alias("model"), "*")
        out = named if out is None else out.unionByName(named)
    return out


@query("linear_regression", _regression_sql({"ridge": (0.1, 0.0), "ols": (0.0, 0.0)}))
def linear_regression(t):
    return _regression_report(t, {"ridge": {"kind": "linear_regression"},
                                  "ols": {"kind": "linear_regression", "regParam": 0.0}})


@query("linear_fit", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def linear_fit(t):
    """Ordinary least squares on one input, whose solution SQL can give as well."""
    rows = M.assemble(t.lineitem.withColumn("label", F.col("l_extendedprice")), ["l_quantity"])
    model = L.estimator("linear_regression", regParam=0.0, solver="normal").fit(rows.select("features", "label"))
    fitted = [(round(float(model.coefficients[0]), 4), round(model.intercept, 2), round(model.summary.r2, 6))]
    return t.spark.createDataFrame(fitted, "slope double, intercept double, r2 double")


_ALPHAS = (0.01, 1.0, 10.0)


@query("ridge_sweep", _regression_sql({f"alpha={a}": (a, 0.0) for a in _ALPHAS}))
def ridge_sweep(t):
    return _regression_report(t, {f"alpha={a}": {"kind": "linear_regression", "regParam": a, "elasticNetParam": 0.0}
                                  for a in _ALPHAS})


#: SQL for the metrics of ``E.binary_metrics`` and the area under the curve; it follows a CTE (label, prediction, score).
def _metrics_sql(source: str) -> str:
    return f"""
    c AS (SELECT count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
                 count(*) FILTER (label = prediction) AS hits, count(*) FILTER (label = 1) AS ones FROM {source}),
    places AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place
               FROM {source}),
    a AS (SELECT sum(place) AS ranks FROM places WHERE label = 1)
    SELECT n, tp, fp, fn, round(hits / n, 6) AS accuracy, coalesce(round(tp / nullif(tp + fp, 0), 6), 0) AS precision,
           coalesce(round(tp / nullif(tp + fn, 0), 6), 0) AS recall, coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 6), 0) AS f1,
           round((ranks - ones * (ones + 1) / 2) / nullif(ones * (n - ones), 0), 6) AS auc FROM c, a"""


_CLASS_INPUTS = [*_RIDE_INPUTS, "tip", "hour_of_day"]
_CLASS_DATA = ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(_CLASS_INPUTS, start=1))


@query("logistic_regression", f"""
    WITH RECURSIVE {RIDES_ML},
    data AS (SELECT {_CLASS_DATA}, CASE WHEN tip / fare > 0.20 THEN 1.0::DOUBLE ELSE 0 END AS y, {_TEST_FOLD} AS fold FROM ml),
    {logistic_fit(len(_CLASS_INPUTS), 0.01)}, {_metrics_sql('scored')}""")
def logistic_regression(t):
    train, test = Tasks(t).classification
    fitted = L.fit_score(train, test, "logistic_regression", maxIter=500, tol=1e-12)
    scored = fitted.select("label", "prediction", vector_to_array("rawPrediction")[1].alias("score"))
    return E.binary_metrics(scored).withColumn("auc", E.area_under_curve(scored).scalar())


@query("decision_tree")
def decision_tree(t):
    return _classification_report(t, {"decision_tree": {"kind": "decision_tree"}})


@query("random_forest")
def random_forest(t):
    return _classification_report(t, {"random_forest": {"kind": "random_forest"}})


@query("gbt")
def gbt(t):
    return _classification_report(t, {"gbt": {"kind": "gbt"}})


@query("tree_regressors")
def tree_regressors(t):
    return _regression_report(t, {k: {"kind": k} for k in (
        "decision_tree_regressor", "random_forest_regressor", "gbt_regressor")})


@query("mlp_classifier")
def mlp_classifier(t):
    train, test = Tasks(t).points
    classes = int(t.embeddings.agg(F.max("label").alias("m")).first()["m"]) + 1
    features = vector_to_array("features")
    weights = N.train(train, "vec_id", features, "label", classes, hidden=64, dropout=0.2, epochs=8)
    return E.class_report(N.with_classes(test, weights, features).select("label", "prediction"))


#: The choices that the search draws from.
SEARCH = {"rate": [0.003, 0.01, 0.03], "hidden": [32, 64, 128], "batches": [2, 4, 8]}


@query("random_search_perceptron")
def random_search_perceptron(t):
    """F1 of perceptrons with learning rate, width and mini-batches drawn at random; trials run at the same time."""
    train, test = Tasks(t).points
    classes = int(t.embeddings.agg(F.max("label").alias("m")).first()["m"]) + 1
    features = vector_to_array("features")
    trials = L.random_combinations(SEARCH, 4)
    evaluator = MulticlassClassificationEvaluator(metricName="f1")

    def trial(options: dict):
        def run() -> float:
            weights = N.train(train, "vec_id", features, "label", classes, epochs=6, **options)
            return evaluator.evaluate(N.with_classes(test, weights, features).select("label", "prediction").dropna())
        return run

    scores = L.in_parallel(t.spark, [trial(o) for o in trials])
    best = max(range(len(trials)), key=scores.__getitem__)
    rows = [(i, o["rate"], o["hidden"], o["batches"], round(s, 6), i == best) for i, (o, s) in enumerate(zip(trials, scores))]
    return t.spark.createDataFrame(rows, "trial bigint, rate double, hidden bigint, batches bigint, f1 double, best boolean")


@query("kmeans")
def kmeans(t):
    """Cluster sizes and profiles on scaled ride measures, with the silhouette."""
    vectors = M.assemble(_rides(t), _RIDE_INPUTS, "raw")
    scale = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    clustered = L.fit(L.chain(scale, L.estimator("kmeans")), vectors, ["raw"]).transform(vectors)
    silhouette = ClusteringEvaluator().evaluate(clustered)
    return clustered.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("fare").alias("avg_fare"), F.avg("distance").alias("avg_distance"),
        F.avg("duration_min").alias("avg_duration")).withColumn("silhouette", F.lit(silhouette))


def _guesses(t: Tables) -> DataFrame:
    """Given predictions: a length rule for document quality."""
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").cast("double").alias("label"),
        F.when(F.col("n_chars") > 500, 1.0).otherwise(0.0).alias("prediction"), F.col("n_chars").alias("score"))


_GUESS = """
g AS (SELECT CAST(quality AS DOUBLE) AS label, CASE WHEN n_chars > 500 THEN 1.0::DOUBLE ELSE 0 END AS prediction,
             n_chars AS score
      FROM labels JOIN documents USING (doc_id))"""


@query("evaluate_classifier", f"""
    WITH {_GUESS},
    k AS (SELECT class, count(*) FILTER (label = class AND prediction = class) AS tp,
                 count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS predicted
          FROM g, (VALUES (0.0::DOUBLE), (1.0)) c(class) GROUP BY class)
    SELECT class, coalesce(round(tp / nullif(predicted, 0), 6), 0) AS precision,
           coalesce(round(tp / nullif(support, 0), 6), 0) AS recall,
           coalesce(round(2 * tp / nullif(predicted + support, 0), 6), 0) AS f1, support FROM k""")
def evaluate_classifier(t):
    return E.class_report(_guesses(t))


@query("classifier_metrics", f"""
    WITH {_GUESS}, {_metrics_sql('g')}""")
def classifier_metrics(t):
    """Accuracy, precision, recall, F1 and area under the curve of given predictions and scores."""
    guesses = _guesses(t)
    return E.binary_metrics(guesses).withColumn("auc", E.area_under_curve(guesses).scalar())


@query("confusion_matrix", f"WITH {_GUESS} SELECT label, prediction, count(*) AS n FROM g GROUP BY 1, 2")
def confusion_matrix(t):
    return E.confusion_matrix(_guesses(t))


@query("evaluate_regressor", """
    WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1000 AS z FROM lineitem)
    SELECT count(*) AS n, round(sqrt(avg(power(y - z, 2))), 4) AS rmse, round(avg(abs(y - z)), 4) AS mae,
           round(1 - avg(power(y - z, 2)) / var_pop(y), 4) AS r2 FROM p""")
def evaluate_regressor(t):
    return E.regression_metrics(t.lineitem.select(F.col("l_extendedprice").alias("label"),
                                                  (F.col("l_quantity") * 1000).alias("prediction")))


# Tuning

_LIMITS = {"min_chars": [200, 500, 1000], "min_pages": [1, 3]}


@query("param_grid", f"""
    WITH d AS (SELECT quality, n_chars, length(text) - length(replace(text, chr(10), '')) + 1 AS lines
               FROM labels JOIN documents USING (doc_id)),
    grid AS (SELECT * FROM (VALUES {', '.join(f'({c})' for c in _LIMITS['min_chars'])}) a(min_chars),
                           (VALUES {', '.join(f'({p})' for p in _LIMITS['min_pages'])}) b(min_pages))
    SELECT CAST(min_chars AS BIGINT) AS min_chars, CAST(min_pages AS BIGINT) AS min_pages, count(*) AS n,
           count(*) FILTER ((quality = 1) = (n_chars >= min_chars AND lines >= min_pages)) AS hits
    FROM d, grid GROUP BY 1, 2""")
def param_grid(t):
    """Hits of a two-limit rule at every grid point, from one pass over the labelled documents."""
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    docs = t.labels.join(t.documents, "doc_id").select("quality", "n_chars", lines.alias("lines"))
    points = L.combinations(_LIMITS)
    hits = [F.count_if((F.col("quality") == 1) == (
        (F.col("n_chars") >= p["min_chars"]) & (F.col("lines") >= p["min_pages"]))).alias(f"h{i}")
        for i, p in enumerate(points)]
    wide = docs.agg(F.count(F.lit(1)).alias("n"), *hits)
    rows = F.inline(F.array(*[F.struct(
        F.lit(p["min_chars"]).cast("bigint").alias("min_chars"), F.lit(p["min_pages"]).cast("bigint").alias("min_pages"),
        F.col(f"h{i}").alias("hits")) for i, p in enumerate(points)]))
    return wide.select("n", rows)


_FOLDED = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}


@query("cross_validate", _tuning_sql(L.combinations(_FOLDED), f"{md5_bucket('ride', 9_999)} % 3", 3))
def cross_validate(t):
    train, _ = Tasks(t).regression
    est = L.estimator("linear_regression", maxIter=500, tol=1e-12)
    maps = L.grid(est, _FOLDED)
    fitted = L.cross_validated(train, est, maps, RegressionEvaluator(metricName="rmse"), "ride")
    return L.tuning_table(t.spark, maps, fitted.avgMetrics, "rmse")


_SPLIT = {"regParam": [0.01, 0.1, 1.0]}


@query("train_validation_split", _tuning_sql(
    L.combinations(_SPLIT), f"CASE WHEN {md5_bucket('ride', 9_999)} >= 7999 THEN 0 ELSE 1 END", 1))
def train_validation_split(t):
    train, _ = Tasks(t).regression
    est = L.estimator("linear_regression")
    maps = L.grid(est, _SPLIT)
    fitted = L.validated(train, est, maps, RegressionEvaluator(metricName="rmse"), "ride")
    return L.tuning_table(t.spark, maps, fitted.metrics, "rmse")


@query("random_search")
def random_search(t):
    train, _ = Tasks(t).classification
    est = L.estimator("logistic_regression")
    maps = L.random_grid(est, {"regParam": [0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.25, 0.5, 1.0]}, 4)
    fitted = L.validated(train, est, maps, BinaryClassificationEvaluator(), "ride", columns=["features", "label"])
    return L.tuning_table(t.spark, maps, fitted.metrics, "auc").orderBy(F.desc("auc"), "trial")


@query("model_save_load", f"""
    WITH {RIDES_ML}
    SELECT count(*) AS rows, 0::BIGINT AS different FROM ml
    WHERE CAST(('0x' || substr(md5(ride || '#42'), 1, 7)) AS BIGINT) % 10000 >= 8000""")
def model_save_load(t):
    """Predictions of a fitted chain and of its saved and reloaded copy, and how many differ."""
    rides = _rides(t).withColumn("label", (F.col("tip") / F.col("fare") > 0.20).cast("double"))
    train, test = split_two(rides, "ride")
    stages = L.chain(VectorAssembler(inputCols=_RIDE_INPUTS, outputCol="raw"),
                     StandardScaler(inputCol="raw", outputCol="features"), L.estimator("logistic_regression"))
    model = L.fit(stages, train)
    reloaded = L.save_and_reload(model, scratch_path(t.spark, "model"))
    both = reloaded.transform(model.transform(test).select(
        *[c for c in test.columns], F.col("prediction").alias("first")))
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("first") != F.col("prediction")).alias("different"))


@query("batch_inference", f"""
    WITH {RIDES_ML}
    SELECT CASE WHEN tip / fare > 0.20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, count(*) AS n, 0::BIGINT AS different
    FROM ml WHERE CAST(('0x' || substr(md5(ride || '#42'), 1, 7)) AS BIGINT) % 10000 >= 8000 GROUP BY 1""")
def batch_inference(t):
    """Test rows per label, scored in chunks by a model that each worker loads once; none may differ from the model's own."""
    train, test = Tasks(t).classification
    model = L.fit(L.estimator("logistic_regression"), train)
    path = scratch_path(t.spark, "weights") + "/weights.json"
    L.save_weights(model, path)
    own = model.transform(test).withColumn("own", F.col("prediction")).drop("prediction")
    scored = L.score_in_batches(own, L.linear_loader(path), vector_to_array("features"), model.numFeatures)
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") != F.col("prediction")).alias("different"))


@query("run_leaderboard", f"""
    WITH d AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)),
    runs(run_id, min_chars) AS (VALUES ('a', 200), ('b', 500), ('c', 1000)),
    scored AS (SELECT run_id, min_chars, round(count(*) FILTER ((quality = 1) = (n_chars >= min_chars)) / count(*), 6)
               AS accuracy FROM d, runs GROUP BY 1, 2)
    SELECT run_id, 'length rule' AS experiment, accuracy, 'min_chars=' || min_chars AS params FROM scored""")
def run_leaderboard(t):
    """Log one run per rule variant, then rank the logged runs."""
    path = scratch_path(t.spark, "runs")
    docs = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    for run_id, limit in (("a", 200), ("b", 500), ("c", 1000)):
        hit = (F.col("quality") == 1) == (F.col("n_chars") >= limit)
        accuracy = docs.agg(F.round(F.count_if(hit) / F.count(F.lit(1)), 6).alias("a")).first()["a"]
        E.log_run(t.spark, path, run_id, "length rule", {"min_chars": limit}, {"accuracy": accuracy})
    return E.leaderboard(t.spark.read.parquet(path), "accuracy")
