"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all of it. Learned filters slide over the
embedded bytes of a chunk, the highest response of each filter is kept, and a small hidden layer
turns these into one number per chunk. The mean over the chunks, squashed, is the probability that
the document is good.

Fitting is one bounded task: at most about ``LEARN_DOCS`` labelled documents, of each at most
``LEARN_CHUNKS`` chunks spread over the whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.frames import fold, slices, text_bytes

CHUNK, OVERLAP = 256, 32
EMBED, STEP, TAPS, FILTERS, HIDDEN = 8, 2, 3, 32, 16
LEARN_DOCS, LEARN_CHUNKS = 4000, 6
EPOCHS, BATCH, RATE = 6, 128, 0.003
THRESHOLD = 0.3
SLICE = 4 << 20


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start of every chunk in the texts' joined bytes and each text's first chunk.

    Chunks begin every CHUNK - OVERLAP bytes until the whole text is covered; an empty text has one.
    """
    _, ends = text_bytes(texts)
    counts = np.maximum(1, -(-(np.diff(ends) - OVERLAP) // (CHUNK - OVERLAP)))
    first = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    return ends[row] + (np.arange(first[-1]) - first[row]) * (CHUNK - OVERLAP), first


def chunk_bytes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The bytes of each chunk, zeros from the end of its text on."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < stops[:, None]
    if not len(raw):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint8)


@dataclass
class ByteNetwork:
    """Weights by name; every matrix is float32."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> ByteNetwork:
        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        wide = STEP * EMBED
        return ByteNetwork({
            "embed": normal(256, EMBED, scale=0.5), "conv": normal(wide, TAPS * FILTERS, scale=(wide * TAPS) ** -0.5),
            "conv_b": np.zeros(FILTERS, np.float32), "hid": normal(FILTERS + 1, HIDDEN, scale=FILTERS ** -0.5),
            "hid_b": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=HIDDEN ** -0.5),
            "out_b": np.zeros(1, np.float32)})

    def forward(self, chunks: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logit of each chunk, and what the gradient needs."""
        w = self.weights
        steps = CHUNK // STEP
        x = w["embed"][chunks].reshape(len(chunks), steps, STEP * EMBED)
        z = (x.reshape(-1, STEP * EMBED) @ w["conv"]).reshape(len(chunks), steps, TAPS * FILTERS)
        response = z[:, :steps - TAPS + 1, :FILTERS].copy()
        for tap in range(1, TAPS):
            response += z[:, tap:steps - TAPS + 1 + tap, tap * FILTERS:(tap + 1) * FILTERS]
        peak = response.max(axis=1) + w["conv_b"]
        # How full the chunk is: few responses mean little in a short text.
        fill = np.count_nonzero(chunks, axis=1).astype(np.float32) / CHUNK
        pooled = np.concatenate([np.maximum(peak, 0), fill[:, None]], axis=1)
        hidden = np.tanh(pooled @ w["hid"] + w["hid_b"])
        return hidden @ w["out"] + w["out_b"], (x, response, peak, pooled, hidden)

    def gradient(self, chunks: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        logit, (x, response, peak, pooled, hidden) = self.forward(chunks)
        d_logit = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (1 - hidden ** 2)
        d_peak = (d_hidden @ w["hid"][:FILTERS].T) * (peak > 0)
        at = response.argmax(axis=1)
        rows = np.arange(len(chunks))[:, None]
        d_conv = np.empty_like(w["conv"])
        d_embed = np.zeros_like(w["embed"])
        for tap in range(TAPS):
            part = slice(tap * FILTERS, (tap + 1) * FILTERS)
            seen = x[rows, at + tap]
            d_conv[:, part] = np.einsum("nfd,nf->df", seen, d_peak)
            d_seen = (d_peak[:, :, None] * w["conv"][:, part].T).reshape(-1, STEP, EMBED)
            for step in range(STEP):
                letters = chunks[rows, (at + tap) * STEP + step].ravel()
                np.add.at(d_embed, letters, d_seen[:, step])
        return {"embed": d_embed, "conv": d_conv, "conv_b": d_peak.sum(0), "hid": pooled.T @ d_hidden,
                "hid_b": d_hidden.sum(0), "out": hidden.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}

    def fit(self, chunks: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> None:
        """Adam over shuffled batches.

        Every third chunk is cut to a random length first, since short texts are rare among the
        labelled ones and must not count as bad for being short.
        """
        slope = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(chunks))
            for first in range(0, len(order), BATCH):
                batch = order[first:first + BATCH]
                step += 1
                lengths = np.exp(rng.uniform(np.log(6), np.log(CHUNK), len(batch)))
                lengths[rng.random(len(batch)) > 1 / 3] = CHUNK
                seen = np.where(np.arange(CHUNK) < lengths[:, None], chunks[batch], 0)
                for name, g in self.gradient(seen, labels[batch]).items():
                    slope[name] += 0.1 * (g - slope[name])
                    square[name] += 0.01 * (g * g - square[name])
                    rate = RATE * (1 - 0.99 ** step) ** 0.5 / (1 - 0.9 ** step)
                    self.weights[name] -= (rate * slope[name] / (np.sqrt(square[name]) + 1e-7)).astype(np.float32)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability per text, from all its chunks."""
        raw, ends = text_bytes(texts)
        starts, first = chunks_of(texts)
        stops = np.repeat(ends[1:], np.diff(first))
        logits = np.concatenate([
            self.forward(chunk_bytes(raw, starts[i:i + BATCH], stops[i:i + BATCH]))[0]
            for i in range(0, len(starts), BATCH)] or [np.zeros(0)]).astype(np.float64)
        mean = np.add.reduceat(logits, first[:-1]) / np.diff(first)
        return 1 / (1 + np.exp(-np.clip(mean, -50, 50)))


def sample_labels(labels: DataFrame, target: str, max_docs: int) -> DataFrame:
    """About ``max_docs`` labelled ids, chosen by hash; conflicting labels of an id take the higher one."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull()).groupBy("doc_id").agg(
        F.max(target).cast("double").alias("label"))
    total = known.count()
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1e6 * max_docs / max(total, 1))


def fit_classifier(docs: DataFrame, labels: DataFrame, target: str = "quality", max_docs: int = LEARN_DOCS,
                   seed: int = 11) -> ByteNetwork | None:
    """The network fitted to ``labels.target`` (0 or 1) on the texts of ``docs``; None without labels.

    The sample of labels is small by construction, so it is broadcast and the texts stay in place;
    only sampled chunks move to the task that fits.
    """
    sample = sample_labels(labels, target, max_docs)
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            raw, ends = text_bytes(batch.column(1))
            starts, first = chunks_of(batch.column(1))
            picked = [np.unique(np.linspace(a, b - 1, LEARN_CHUNKS).astype(np.int64))
                      for a, b in zip(first[:-1], first[1:])]
            counts = np.array([len(p) for p in picked])
            row = np.repeat(np.arange(len(counts)), counts)
            data = chunk_bytes(raw, starts[np.concatenate(picked)], ends[1:][row])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(2).take(pa.array(row)),
                 pa.array([d.tobytes() for d in data], pa.binary())], ["doc_id", "label", "chunk"])

    chunks = labelled.mapInArrow(cut, "doc_id bigint, label double, chunk binary")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("chunk", "ascending")])
        rng = np.random.default_rng(seed)
        network = ByteNetwork.fresh(rng)
        data = np.frombuffer(b"".join(table["chunk"].to_pylist()), np.uint8).reshape(-1, CHUNK)
        network.fit(data, table["label"].to_numpy().astype(np.float32), rng)
        return pa.table({"weights": pa.array([pickle.dumps(network.weights)], pa.binary())})

    fitted = chunks.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit, "weights binary").collect()
    return ByteNetwork(pickle.loads(fitted[0]["weights"])) if fitted else None


def classify(docs: DataFrame, network: ByteNetwork | None, threshold: float = THRESHOLD,
             text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) and ``quality_pred`` in place of columns so named.

    A null text is scored as an empty one, which is a single chunk of zeros. Without a network (no
    labels) every score is 0.5. Each row is scored on its own.
    """
    names = ["quality_score", "quality_pred"]
    kept = docs.drop(*names)
    source = kept.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = T.StructType([*kept.schema.fields, T.StructField("quality_score", T.DoubleType()),
                           T.StructField("quality_pred", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "_text", SLICE):
            scores = model.score(batch.column(batch.num_columns - 1)) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                [*batch.schema.names[:-1], *names])

    return source.mapInArrow(run, schema)


def held_out(doc_id_col: str = "doc_id"):
    return fold(F.col(doc_id_col), 5) == 0


def learn_from_documents(docs: DataFrame, labels: DataFrame) -> ByteNetwork | None:
    """The network from labelled documents of the learning folds."""
    return fit_classifier(docs.filter(~held_out()), labels)


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    only = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return classify(only, learn_from_documents(only, labels)).select(
        "doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"),
        F.col("quality_pred").alias("predicted"))
