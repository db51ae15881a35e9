"""Batch file readers and writers."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from tidewater.sources.stores import ARROW_STORES, open_store


def read_csv(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """CSV with header; types are inferred (one extra pass) only when no schema is given."""
    reader = spark.read.options(header=True, **options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines."""
    reader = spark.read.option("multiLine", False)
    return (reader.schema(schema) if schema else reader).json(path)


def read_drifted(spark: SparkSession, paths: Sequence[str], casts: dict[str, str]) -> DataFrame:
    """Union of files whose schemas drifted apart.

    Paths of one schema are read together, so the plan grows with the number of schemas and not
    with the number of files. The named columns are cast to one type, and columns that a schema
    lacks become null. Paths are files, or folders without partition folders.
    """
    alike = footer_schemas(spark, paths)

    def one(kind: str) -> DataFrame:
        df = spark.read.schema(StructType.fromJson(json.loads(kind))).parquet(*alike[kind])
        return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, alike))


#: Key under which Spark's writer keeps the schema in a Parquet footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def footer_schema(path: str) -> str:
    """Schema of a Parquet file, or of the first file in a folder, as Spark's JSON."""
    store, inner = open_store(path)
    if store.get_file_info(inner).type == fs.FileType.Directory:
        inner = min(f.path for f in store.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".parquet"))
    with store.open_input_file(inner) as file:
        footer = pq.ParquetFile(file)
        kept = (footer.metadata.metadata or {}).get(SPARK_SCHEMA)
        # Columns read from Parquet may always be null, whatever the writer said.
        found = StructType.fromJson(json.loads(kept)) if kept else from_arrow_schema(
            footer.schema_arrow, prefer_timestamp_ntz=True)
    return json.dumps(_nullable(json.loads(found.json())), sort_keys=True)


def _nullable(node):
    if isinstance(node, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _nullable(v)
                for k, v in node.items()}
    return [_nullable(x) for x in node] if isinstance(node, list) else node


def footer_schemas(spark: SparkSession, paths: Sequence[str], files_per_task: int = 100) -> dict[str, list[str]]:
    """Schemas, as JSON, and the paths of each. Tasks read the footers; each distinct schema comes once.

    Stores that Arrow cannot open are left to Spark's own reader, a path at a time.
    """
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"at": frame["at"], "kind": [footer_schema(p) for p in frame["path"]]})

    if any("://" in p and p.split("://", 1)[0] not in ARROW_STORES for p in paths):
        alike: dict[str, list[str]] = {}
        for path in paths:
            alike.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
        return alike
    tasks = -(-len(paths) // files_per_task)
    table = spark.createDataFrame(list(enumerate(paths)), "at bigint, path string").repartition(tasks, "at")
    found = table.mapInPandas(read, "at bigint, kind string").groupBy("kind").agg(F.sort_array(F.collect_list("at")).alias("at"))
    rows = sorted(found.collect(), key=lambda r: r["at"][0])
    return {r["kind"]: [paths[i] for i in r["at"]] for r in rows}


def stripped_headers(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks."""
    return df.toDF(*[c.strip() for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    """Text formats keep the microseconds of timestamps, which Spark cuts to milliseconds by default."""
    if fmt in ("json", "csv"):
        options = {**MICROSECONDS, **options}
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000, **options) -> None:
    """Partitioned Parquet without one tiny file per task and directory.

    Rows are gathered by partition value with a rebalancing shuffle. Adaptive execution merges
    small values into one task and splits a value that holds much of the table over several.
    """
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = gathered.write.mode(mode).options(maxRecordsPerFile=max_records_per_file, **options)
    writer.partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; running it again gives the same table."""
    write_partitioned(df, path, partition_by, partitionOverwriteMode="dynamic")


def write_text(df: DataFrame, path: str, line: Column | None = None, mode: str = "overwrite") -> None:
    """One text line per row; JSON of the row unless an expression is given."""
    line = F.to_json(F.struct(*df.columns)) if line is None else line
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """One output file, whatever its size; one task writes it, row by row.

    The rows are computed in parallel and then moved to that task.
    """
    df.repartition(1).write.mode(mode).format(fmt).save(path)
