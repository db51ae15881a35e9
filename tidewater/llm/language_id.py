"""Language identification with bit-sliced Bloom filters over byte n-grams.

A slot of the filter table holds one bit per language. An n-gram is looked up in two slots; the AND
of their masks is the set of languages whose filter contains it, for all languages at once. A
text's language is the one with the highest share of its n-grams after each language's expected
false positives are taken off.

A language's filter holds the n-grams that make up at least ``MIN_SHARE`` of its learning text, so
it has at most 1 / MIN_SHARE entries, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.frames import fold, slices, text_bytes

GRAM = 4
MIN_SHARE = 1 / 40_000
MIN_RATIO = 0.05
SLOTS_PER_GRAM = 16
LEARN_DOCS = 4000
SLICE = 4 << 20

#: Bytes as the n-grams see them: A-Z in lower case, everything in ASCII that is no letter as a blank.
FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as 32-bit numbers, and each text's offset. One blank goes before a
    text and three after it, so every text has an n-gram and none crosses into the next."""
    raw, ends = text_bytes(pc.binary_join_element_wise(" ", texts, "   ", ""))
    letters = FOLDED[raw].astype(np.uint32)
    if not len(letters):
        return np.zeros(0, np.uint32), ends
    packed = letters[:-3] | letters[1:-2] << 8 | letters[2:-1] << 16 | letters[3:] << 24
    # The last three positions of a text would cross its end.
    counts = np.diff(ends)
    keep = np.ones(len(letters), bool)
    for back in range(1, GRAM):
        keep[ends[1:] - back] = False
    return packed[keep[:-3]], np.concatenate([[0], np.cumsum(counts - GRAM + 1)])


def slots_of(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two slots per n-gram from the high bits of two odd multipliers."""
    shift = np.uint32(32 - bits)
    return (grams * np.uint32(2654435769)) >> shift, (grams * np.uint32(2246822519) ^ grams >> np.uint32(15)) * np.uint32(
        3266489917) >> shift


@dataclass
class LanguageFilters:
    """``words[w][slot]`` has a bit for each of up to 64 languages; ``false`` their false-positive rates."""

    languages: list[str]
    words: list[np.ndarray]
    bits: int
    false: np.ndarray

    @staticmethod
    def build(languages: list[str], grams: dict[str, np.ndarray]) -> LanguageFilters:
        most = max([1, *(len(g) for g in grams.values())])
        bits = min(31, max(10, (SLOTS_PER_GRAM * most - 1).bit_length()))
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        per_word = 8 * np.dtype(kind).itemsize
        words = [np.zeros(1 << bits, kind) for _ in range(max(1, -(-len(languages) // per_word)))]
        false = np.zeros(len(languages))
        for i, language in enumerate(languages):
            bit = kind(1 << i % per_word)
            word = words[i // per_word]
            for slots in slots_of(grams.get(language, np.zeros(0, np.uint32)), bits):
                word[slots] |= bit
            false[i] = np.count_nonzero(word & bit) / len(word)
        return LanguageFilters(languages, words, bits, false ** 2)

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of n-grams per text and language, and the number of n-grams of each text."""
        grams, ends = grams_of(texts)
        counts = np.diff(ends)
        shares = np.zeros((len(counts), len(self.languages)))
        first, second = slots_of(grams, self.bits)
        for w, word in enumerate(self.words):
            masks = word[first] & word[second]
            per_word = 8 * word.dtype.itemsize
            for i in range(w * per_word, min(len(self.languages), (w + 1) * per_word)):
                found = np.add.reduceat(masks >> word.dtype.type(i - w * per_word) & word.dtype.type(1), ends[:-1],
                                        dtype=np.int64) / counts
                shares[:, i] = np.clip((found - self.false[i]) / (1 - self.false[i]), 0, 1)
        return shares, counts

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and share of known n-grams. Ties take the language that comes first."""
        shares, _ = self.hits(texts)
        best = shares.argmax(axis=1) if shares.shape[1] else np.zeros(len(texts), np.int64)
        top = shares.max(axis=1, initial=0.0)
        total = shares.sum(axis=1)
        score = np.where(total > 0, top / np.maximum(total, 1e-12), 0.0)
        letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
        names = self.languages or ["und"]
        return ([names[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())],
                np.where(letters, score, 0.0), np.where(letters, top, 0.0))


def learn_filters(train: DataFrame, max_docs: int = LEARN_DOCS) -> LanguageFilters:
    """Filters from ``train`` (``text``, ``lang``).

    Learns from about ``max_docs`` different texts of each language, chosen by their hash, and counts
    their n-grams in the cluster; copies of a text count once. An n-gram counts as contained if it makes up MIN_SHARE of a
    language's n-grams and at least MIN_RATIO of its highest share in any language, so that stray
    passages in another language do not count.
    """
    per_language = train.select("lang", F.xxhash64("text").alias("hash")).distinct().groupBy("lang").count()
    sample = train.join(F.broadcast(per_language), "lang").filter(
        F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(1e6 * max_docs) / F.col("count")).select(
        "text", "lang").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            for language in pc.unique(batch.column(1)).to_pylist():
                texts = batch.column(0).filter(pc.equal(batch.column(1), language))
                grams, counts = np.unique(grams_of(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    ["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    # At most 1 / MIN_SHARE rows per language.
    shares = counted.join(F.broadcast(totals), "lang").select(
        "lang", "gram", (F.col("n") / F.col("total")).alias("share")).filter(F.col("share") >= MIN_SHARE)
    rows = shares.toPandas()
    languages = sorted(r["lang"] for r in per_language.collect())
    if len(rows):
        highest = rows.groupby("gram")["share"].transform("max")
        rows = rows[rows["share"] >= MIN_RATIO * highest]
    return LanguageFilters.build(
        languages, {lang: part["gram"].to_numpy().astype(np.uint32) for lang, part in rows.groupby("lang")})


def identify(docs: DataFrame, filters: LanguageFilters, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_known`` in place of columns so named.

    ``lang_pred`` is ``und`` for a null text and one without a letter, with score 0. A text with
    letters but without known n-grams gets the first language and score 0. Every row is predicted
    on its own, whatever its other columns hold.
    """
    names = ["lang_pred", "lang_score", "lang_known"]
    kept = docs.drop(*names)
    source = kept.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("lang_known", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            languages, scores, known = shared.value.predict(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(languages), pa.array(scores), pa.array(known)],
                [*batch.schema.names[:-1], *names])

    return source.mapInArrow(run, schema)


def held_out(doc_id_col: str = "doc_id"):
    return fold(F.col(doc_id_col), 4) == 2


def learn_from_documents(docs: DataFrame) -> LanguageFilters:
    """Filters from the text and lang of the documents of the learning folds."""
    return learn_filters(docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
                         .select("text", "lang"))


def languages_of_documents(docs: DataFrame) -> DataFrame:
    filters = learn_from_documents(docs)
    only = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return identify(only, filters).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
