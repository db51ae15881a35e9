"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

SLICE_BYTES = 16 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text of each row, under fixed names; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def staged(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared scratch folder, in folders by the columns ``by``, and read back.

    Later steps start from these files, so a lost executor costs only the work since then.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def tasks_for(df: DataFrame) -> int:
    """Partitions for a stage that is spread by key: the session's own setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, or one row if that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, int(ends[first]) + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, end to end, and where each row starts and ends."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0]:ends[-1]], (ends - ends[0]).astype(np.int64)
