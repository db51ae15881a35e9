"""Quality classifier and language identification: exact parts against loops, models held out."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from compare import DATA
from tidewater.llm import language_id as L
from tidewater.llm import quality as Q
from tidewater.llm.queries import op4_quality_classifier, op10_language_id

ODD = ["", " ", "a", "é", "12 34 !?", "word " * 9000, "The end", "ÀÉÎ", "日本語 テキスト", "x\n\n\ny"]


def test_chunks_cover_every_byte():
    texts = pa.array(["", "a", "b" * 256, "c" * 257, "é" * 2000, "d" * 5000])
    starts, first = Q.chunks_of(texts)
    raw, ends = Q.text_bytes(texts)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        mine = starts[first[i]:first[i + 1]]
        covered = set()
        for s in mine.tolist():
            covered |= set(range(s, min(s + Q.CHUNK, b)))
        assert covered == set(range(a, b))
        data = Q.chunk_bytes(raw, mine, np.full(len(mine), b))
        assert bytes(data[0][:3]) == raw[a:b].tobytes()[:3].ljust(3, b"\0")


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    network = Q.ByteNetwork.fresh(rng)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    chunks = rng.integers(0, 256, (5, Q.CHUNK)).astype(np.uint8)
    labels = np.array([0, 1, 1, 0, 1], np.float64)

    def loss():
        p = 1 / (1 + np.exp(-network.forward(chunks)[0]))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    gradient = network.gradient(chunks, labels)
    for name, weight in network.weights.items():
        at = np.unravel_index(np.abs(gradient[name]).argmax(), weight.shape)
        old, step = weight[at], 1e-5
        weight[at] = old + step
        up = loss()
        weight[at] = old - step
        down = loss()
        weight[at] = old
        assert abs((up - down) / (2 * step) - gradient[name][at]) < 1e-5, name


def test_quality_on_held_out_documents(spark, tables):
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    found = Q.quality_of_documents(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    assert good.predicted.mean() > 0.98 and bad.predicted.mean() < 0.15
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id)


def odd_documents(spark):
    rows = [(i, t, None, "shadow", 0.5) for i, t in enumerate(ODD)]
    rows += [(50, None, "en", None, None), (None, "The thing of the end", "en", "x", 1.0), (3, ODD[3], None, "x", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, quality_score double")


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, None), (99, 1, 0), (None, 0, 0), (5, None, 1)],
                                   "doc_id long, quality int, toxic int")
    found = Q.quality_of_documents(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in Q.quality_of_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.quality_of_documents(docs.limit(0), labels).collect() == []
    assert Q.classify(docs, None).columns == ["doc_id", "text", "lang", "lang_pred", "quality_score", "quality_pred"]


def test_grams():
    grams, ends = L.grams_of(pa.array(["", "Ab", "é1"]))
    want = [[t[i:i + 4] for i in range(len(t) - 3)] for t in (b"    ", b" ab   ", b" \xc3\xa9    ")]
    assert [grams[a:b].astype("<u4").tobytes() for a, b in zip(ends[:-1], ends[1:])] == [b"".join(w) for w in want]


def test_filters_hold_every_gram_and_correct_for_the_rest():
    rng = np.random.default_rng(8)
    names = [f"l{i:02d}" for i in range(70)]
    grams = {n: rng.integers(0, 1 << 32, 400, dtype=np.uint32) for n in names}
    for languages in (names[:3], names):
        filters = L.LanguageFilters.build(languages, grams)
        for i, name in enumerate(languages):
            per_word = 8 * filters.words[0].itemsize
            first, second = L.slots_of(grams[name], filters.bits)
            word = filters.words[i // per_word]
            assert (word[first] & word[second] >> word.dtype.type(0) & word.dtype.type(1 << i % per_word)).all()
            other = rng.integers(0, 1 << 32, 20_000, dtype=np.uint32)
            first, second = L.slots_of(other, filters.bits)
            rate = np.mean((word[first] & word[second] & word.dtype.type(1 << i % per_word)) != 0)
            assert abs(rate - filters.false[i]) < 0.01


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    found = L.languages_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.98
    assert found.score.between(0, 1).all()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id)


def test_languages_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = {r.doc_id: r for r in L.languages_of_documents(docs).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 4, 50))
    assert found[6].lang_pred == "en"
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.languages_of_documents(unlabelled).collect()} == {"und"}
    assert L.languages_of_documents(docs.limit(0)).collect() == []


def test_copies_of_a_text_count_once_in_the_language_sample(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").filter(
        "lang is not null and text is not null").select("text", "lang").distinct()
    copies = spark.createDataFrame([("zq " * 40 + docs.first().text[:50], "en")], "text string, lang string")
    once = L.learn_filters(docs.union(copies))
    often = L.learn_filters(docs.union(copies.crossJoin(spark.range(20_000)).select("text", "lang")))
    texts = pa.array([r.text for r in docs.limit(50).collect()])
    assert np.array_equal(once.hits(texts)[0], often.hits(texts)[0])


def test_queries_keep_all_rows(tables):
    for query in (op4_quality_classifier, op10_language_id):
        assert query(tables).count() == tables.documents.count()
