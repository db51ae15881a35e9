"""Line dedup: lines found in many documents stay only in the document with the largest id.

Lines are exploded as 128-bit hashes with their document and position, never as text. Distinct
documents per hash are counted with map-side partial sums, so a line of every document is a few
rows per task. The join that marks lines has both sides hash-partitioned and splits hot hashes
(adaptive skew join). Documents are reassembled from their own text by the positions that go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.frames import staged

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased, all else as it is."""
    key = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped`` and the ``text`` that is left.

    A null text is one empty line, and so is an empty text. Rows with the same id are one document
    for the counts and each keep a row of their own; a null id counts as one document, smaller than
    all others. A line that stands several times in the document that keeps it stays there each
    time. An empty table gives no rows; other columns are ignored.
    """
    doc_id = F.col(id_col).cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("owner"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")
                       ).withColumn("mark", F.xxhash64("text"))
    lines = rows.select("owner", "mark", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).select(
        "owner", "mark", "pos", line_key(F.col("line")).alias("key")
    ).filter(F.length("key") >= min_chars).select(
        "owner", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    # Staged, so that the join below reads two plain shuffles, of which it can split the hot keys.
    common = staged(lines.groupBy("h1", "h2").agg(
        F.countDistinct("owner").alias("docs"), F.max("owner").alias("keeper")
    ).filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"), "common-lines")
    # Equal rows give equal positions, so the set has each of them once.
    gone = lines.join(common, ["h1", "h2"]).filter(F.col("owner") != F.col("keeper")).groupBy("owner", "mark").agg(
        F.collect_set("pos").alias("gone"))
    split = rows.join(gone, ["owner", "mark"], "left").withColumn("lines", F.split("text", "\n", -1)).withColumn(
        "gone", F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return split.select(
        "doc_id", F.size("lines").cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")).alias("text"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.keeper IS NOT NULL AND k.doc_id <> c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
