"""Feature preparation with Spark ML transformers; vectors come back as plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    Bucketizer,
    MinMaxScaler,
    PolynomialExpansion,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.cleaning import apply_fill_values, learn_fill_values
from tidewater.operators.quantiles import exact_quantiles
from tidewater.operators.windows import row_number, with_windows

MAX_DRIVER_LABELS = 100_000


def index_strings(df: DataFrame, columns: Sequence[str], max_labels: int = MAX_DRIVER_LABELS,
                  **window_options) -> DataFrame:
    """Add ``<column>_idx``: 0 for the most frequent value; ties are alphabetical.

    A fitted indexer keeps its labels in the driver, so it serves columns of up to about
    ``max_labels`` values. Wider columns are ranked as a table and joined back.
    """
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    narrow = [c for c in columns if sizes[c] <= max_labels]
    out = string_indexer(narrow).fit(df).transform(df) if narrow else df
    for c in columns:
        if c not in narrow:
            out = _joined_index(out, c, window_options)
    return out


def _joined_index(df: DataFrame, column: str, window_options: dict) -> DataFrame:
    """Index by frequency rank; a null gets the index after the last value, as the indexer does."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_label")).agg(
        F.count(F.lit(1)).alias("_rows"))
    ranked = with_windows(counts, [], [("_rows", "desc"), "_label"], {"_pos": row_number()}, **window_options)
    labels = counts.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    index = F.coalesce(F.col("_pos") - F.lit(1.0), labels)
    joined = df.join(ranked.select("_label", "_pos"), F.col(column) == F.col("_label"), "left")
    return joined.withColumn(f"{column}_idx", index).drop("_label", "_pos")


def string_indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                         stringOrderType="frequencyDesc", handleInvalid="keep")


def one_hot(df: DataFrame, column: str) -> DataFrame:
    """Dummy columns ``<column>_0 ..`` of a string column, one per category found but the last.

    Categories are numbered by falling frequency; the last one is all zeros. A null value gets null
    in every dummy column.
    """
    found = df.filter(F.col(column).isNotNull())
    labels = StringIndexer(inputCol=column, outputCol="_idx").fit(found).labelsArray[0] if not found.isEmpty() else []
    return df.withColumns({f"{column}_{i}": (F.col(column).cast("string") == label).cast("double")
                           for i, label in enumerate(list(labels)[:-1])})


def expand_vector(df: DataFrame, vector: str, names: Sequence[str], digits: int | None = None
                  ) -> DataFrame:
    """Replace a vector column by one double column per component."""
    parts = vector_to_array(F.col(vector))

    def part(i: int) -> Column:
        return parts[i] if digits is None else F.round(parts[i], digits)

    return df.withColumns({name: part(i) for i, name in enumerate(names)}).drop(vector)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features",
             invalid: str = "error") -> DataFrame:
    """Vector of the columns; rows with nulls raise, are skipped, or are kept as NaN."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def scaled(df: DataFrame, columns: Sequence[str], method: str = "standard", digits: int | None = None
           ) -> DataFrame:
    """Add ``<column>_scaled``, by standard score or to the range 0..1."""
    scalers = {
        "standard": lambda: StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True),
        "minmax": lambda: MinMaxScaler(inputCol="_v", outputCol="_s"),
    }
    vectors = assemble(df, columns, "_v")
    out = scalers[method]().fit(vectors).transform(vectors).drop("_v")
    return expand_vector(out, "_s", [f"{c}_scaled" for c in columns], digits)


def bucketed(df: DataFrame, column: str, splits: Sequence[float], output: str) -> DataFrame:
    """Index of the left-closed interval that holds the value."""
    return Bucketizer(splits=list(splits), inputCol=column, outputCol=output).transform(df)


def quantile_buckets(df: DataFrame, column: str, buckets: int, output: str) -> DataFrame:
    """Index of the quantile bucket; the splits are exact quantiles, and equal ones count once.

    A column of missing values only gets null.
    """
    splits = exact_quantiles(df, {column: [i / buckets for i in range(1, buckets)]})[column]
    edges = sorted({s for s in splits if s is not None})
    if not edges:
        return df.withColumn(output, F.lit(None).cast("double"))
    return bucketed(df, column, [float("-inf"), *edges, float("inf")], output)


def polynomial(df: DataFrame, columns: Sequence[str], degree: int, names: Sequence[str]) -> DataFrame:
    """All monomials up to ``degree``, in the transformer's order, as named columns."""
    vectors = assemble(df, columns, "_v")
    expanded = PolynomialExpansion(degree=degree, inputCol="_v", outputCol="_p").transform(vectors)
    return expand_vector(expanded.drop("_v"), "_p", names)


def principal_components(df: DataFrame, vector: str, k: int) -> DataFrame:
    """Scores on the first ``k`` components; each component's largest loading is positive."""
    model = PCA(k=k, inputCol=vector, outputCol="_pc").fit(df)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    scored = expand_vector(model.transform(df), "_pc", [f"pc{i + 1}" for i in range(k)])
    return scored.withColumns({f"pc{i + 1}": F.col(f"pc{i + 1}") * s for i, s in enumerate(signs)})


def sql_projection(df: DataFrame, statement: str) -> DataFrame:
    """Apply a SELECT over ``__THIS__``."""
    return SQLTransformer(statement=statement).transform(df)


class TabularFeatures:
    """Fill values, string indices, scaled numbers and the final vector, learned on training data.

    ``fit`` looks at the training table only; ``transform`` applies the same values to any table,
    so nothing leaks from a test table.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str]):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.fills: dict = {}
        self.model: PipelineModel | None = None

    def fit(self, train: DataFrame) -> TabularFeatures:
        self.fills = learn_fill_values(train, self.numeric, self.categorical)
        filled = apply_fill_values(train, self.fills)
        indices = [f"{c}_idx" for c in self.categorical]
        self.model = Pipeline(stages=[
            string_indexer(self.categorical),
            VectorAssembler(inputCols=self.numeric, outputCol="_numeric"),
            StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
            VectorAssembler(inputCols=["_scaled", *indices], outputCol="features"),
        ]).fit(filled)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        indices = [f"{c}_idx" for c in self.categorical]
        out = self.model.transform(apply_fill_values(df, self.fills))
        return out.drop("_numeric", "_scaled", *indices)
