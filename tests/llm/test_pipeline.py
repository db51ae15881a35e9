"""Each stage on its own input against plain loops, then all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as P
from compare import DATA
from test_search import brute

SF_DIR = f"{DATA}/sf0.001"


def planted(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    long = docs.filter("length(text) > 600 and lang = 'en'").orderBy("doc_id").limit(3).collect()
    rows = [(10_000 + i, long[0]["text"] + " " * i, "en", "planted", i) for i in range(1, 6)]
    rows += [(10_100 + i, long[1]["text"] + f" and one more thing {i}", "en", "planted", i) for i in range(30)]
    rows += [(10_200, None, "en", "planted", 0), (10_201, "", None, None, None), (10_202, "123 456 !!", "en", "planted", 9)]
    rows += [(None, long[2]["text"], "en", "planted", 7), (10_300, long[2]["text"], "en", "planted", 7),
             (10_300, long[2]["text"], "en", "planted", 7)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumn("label", F.lit("shadow")).withColumn(
        "comp", F.lit(1))


def test_filters_keep_clean_rows_whole(spark):
    docs = planted(spark)
    for stage in (P.good_quality, P.known_language):
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).isEmpty()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = docs.join(labels.filter("quality = 1"), "doc_id", "left_semi").count()
    assert P.good_quality(spark, docs, SF_DIR).join(
        labels.filter("quality = 1"), "doc_id", "left_semi").count() >= 0.97 * good
    named = {r.doc_id for r in P.known_language(spark, docs, SF_DIR).select("doc_id").collect()}
    assert not named & {10_200, 10_201, 10_202}
    assert len(named) >= docs.select("doc_id").distinct().count() - 5


def test_without_a_learned_language_only_texts_without_letters_go(spark):
    rows = [(1, "a text", None), (2, None, None), (3, "12 !!", None), (4, "é", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for known in (docs, docs.withColumn("lang", F.when(P.language_id.held_out(), "en"))):
        assert sorted(map(tuple, P.known_language(spark, known, SF_DIR).collect())) == sorted(
            map(tuple, known.filter("doc_id in (1, 4)").collect()))


def test_dedup_stages(spark):
    docs = planted(spark)
    unique = P.without_copies(spark, docs, SF_DIR)
    assert unique.columns == docs.columns
    squeezed = {}
    for r in docs.collect():
        key = "".join(c for c in r.text or "" if c not in " \t\n\x0b\x0c\r")
        squeezed.setdefault(key, []).append((-len(r.text or ""), r.doc_id is not None, r.doc_id or 0, r.doc_id))
    want = sorted((min(v)[3] for v in squeezed.values()), key=repr)
    assert sorted((r.doc_id for r in unique.collect()), key=repr) == want

    forms = spark.createDataFrame([(1, "a b"), (1, "ab"), (2, "ab"), (3, "c"), (3, "c")], "doc_id long, text string")
    assert sorted(map(tuple, P.without_copies(spark, forms, SF_DIR).collect())) == [(1, "a b"), (3, "c")]

    named = unique.filter("doc_id is not null")
    kept = sorted(r.doc_id for r in P.without_near_copies(spark, named, SF_DIR).collect())
    assert kept == [i for i, label, _, _ in brute([(r.doc_id, r.text) for r in named.collect()]) if i == label]
    # The 30 planted near copies and the document they come from leave one row.
    assert len([i for i in kept if 10_100 <= i < 10_130]) <= 1


def test_near_copies_with_null_and_repeated_ids(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(200)) for w in "ab")
    rows = [(None, a), (None, a + " x"), (None, b), (7, a + " y"), (7, "something else entirely, and clean"), (8, b + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in P.without_near_copies(spark, docs, SF_DIR).collect()]
    assert len(kept) == 3 and (7, rows[4][1]) in kept and (None, b) in kept
    assert len([t for i, t in kept if i is None and t.startswith("a0 ")]) == 1


def test_empty_tables(spark):
    docs = planted(spark).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


def test_whole_pipeline(spark):
    rows = P.run(spark, SF_DIR)
    pieces = rows.collect()
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    kept = {p.doc_id for p in pieces}
    assert 100 < len(kept) < spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
