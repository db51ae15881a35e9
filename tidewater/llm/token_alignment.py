"""Alignment of two tokenizers' tokens over the same bytes, and how well it holds corpus-wide.

Both vocabularies encode the whole text; the joined bytes of either's tokens must be the text with
a space before it. Where tokens of both begin at the same byte and both begin with a space, the
document is cut: such anchors split it into windows, mostly words, each a pair of token-id tuples.
How a window aligns depends on its ids alone, so each distinct window is aligned once and found
again in a memo by its ids. Inside a window, the bytes at which a token of either ends cut it into
segments; each segment links the two tokens that hold it, and ends shared by both close a group.

Corpus-wide counts of linked id pairs are partial sums per task. To give every document the counts
of its pairs, the most frequent pairs (a table of a fixed largest size) go to all tasks. The others
are joined by pair; none of those stands in more than a small share of all documents.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.bpe_automaton import AutomatonEncoder
from tidewater.llm.frames import slices, staged, text_bytes
from tidewater.llm.text import PieceCache, assemble, list_offsets, offsets_of, ranges

SLICE = 2 << 20
MEMO_WINDOWS = 500_000
MEMO_PIECES = 1_000_000
#: Most pairs that are sent to every task; 17 bytes each.
FREQUENT_PAIRS = 1 << 17
SPACE = "▁"
BETWEEN = np.uint32(0xFFFFFFFF)


class TokenBytes:
    """The bytes of every token id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])

    def __len__(self) -> int:
        return len(self.lengths)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.starts[ids], self.lengths[ids])]


class ByteLevelTokens(AutomatonEncoder):
    """Ids by a byte-level vocabulary; the names of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokens = TokenBytes([self.bytes.join(np.array([i])) for i in range(len(self.bytes.lengths))])
        self.added, self.cut_added = {}, None
        self.cache.limit = MEMO_PIECES


class PieceTokens:
    """Ids by a sentencepiece model, which sets a space before the text.

    If no piece reaches over the start of a word, words that stand after single spaces are encoded
    one by one, each distinct word once; all other texts go to the library whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = TokenBytes([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)])
        self.by_words = not any(SPACE in p[1:] and p.strip(SPACE) for p in pieces)
        self.cache = PieceCache(self._encode, MEMO_PIECES)

    def _encode(self, texts: list[str]) -> tuple[list[int], list[int]]:
        found = self.model.encode(texts, num_threads=1)
        return [i for ids in found for i in ids], [len(ids) for ids in found]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the offset of each text; no text is null."""
        odd = pc.match_substring_regex(texts, f"^ |  | $|{SPACE}|^$")
        if not self.by_words:
            odd = pc.invert(pc.is_null(texts))
        whole = odd.to_numpy(zero_copy_only=False)
        odd_ids, odd_counts = self._encode(texts.filter(odd).to_pylist())
        lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        coded = lists.flatten().dictionary_encode()
        words = np.arange(len(coded.dictionary) + 1)
        ids, ends = assemble(self.cache, coded.dictionary, words, coded.indices.to_numpy().astype(np.int64),
                             list_offsets(lists))
        starts, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        starts[whole], counts[whole] = offsets_of(np.array(odd_counts, np.int64))[:-1] + len(ids), odd_counts
        starts[~whole], counts[~whole] = ends[:-1], np.diff(ends)
        return np.concatenate([ids, np.array(odd_ids, np.uint32)])[ranges(starts, counts)], offsets_of(counts)


class Windows:
    """Alignments of windows, found by their ids. When full, only what the current slice uses stays."""

    def __init__(self, a: TokenBytes, b: TokenBytes, limit: int = MEMO_WINDOWS):
        self.a, self.b, self.limit = a, b, limit
        self.keys = pa.array([], pa.binary())
        self.groups = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.spans = pa.array([], pa.string())

    def lookup(self, keys: pa.Array) -> np.ndarray:
        """Position of each window, aligning the ones that are new; valid until the next call."""
        coded = keys.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.keys)
        if at.null_count:
            new = coded.dictionary.filter(pc.is_null(at))
            if len(self.keys) + len(new) > self.limit:
                self._keep(np.unique(at.drop_null().to_numpy()))
            self._add(new)
            at = pc.index_in(coded.dictionary, value_set=self.keys)
        return at.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)

    def _add(self, new: pa.Array) -> None:
        raw, ends = text_bytes(new)
        flat = raw.view(np.uint32)
        bounds = ends // 4
        marks = np.flatnonzero(flat == BETWEEN)
        in_a = np.arange(len(flat)) < np.repeat(marks, np.diff(bounds))
        in_b = np.arange(len(flat)) > np.repeat(marks, np.diff(bounds))
        a_ids, b_ids = flat[in_a].astype(np.int64), flat[in_b].astype(np.int64)
        # Both sides of a window have the same bytes, so ends counted over all windows compare.
        a_ends, b_ends = np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids])
        kind = np.zeros(int(a_ends[-1]) + 1, np.uint8)
        kind[a_ends] |= 1
        kind[b_ends] |= 2
        cuts = np.flatnonzero(kind)
        shared = kind[cuts] == 3
        in_cut_a, in_cut_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        pairs = a_ids[in_cut_a] * len(self.b) + b_ids[in_cut_b]
        window_ends = a_ends[np.cumsum(marks - bounds[:-1]) - 1]
        links = np.diff(np.searchsorted(cuts, window_ends, "right"), prepend=0)
        groups = np.diff(np.searchsorted(cuts[shared], window_ends, "right"), prepend=0)
        # The groups of a window as text, written from the places of the shared ends.
        a_cuts, b_cuts = (in_cut_a[shared] + 1).tolist(), (in_cut_b[shared] + 1).tolist()
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        written, i, j = [], 0, 0
        for k, m in zip(a_cuts, b_cuts):
            written.append(",".join(a_text[i:k]) + "|" + ",".join(b_text[j:m]))
            i, j = k, m
        at = offsets_of(groups).tolist()
        spans = pa.array([";".join(written[x:y]) for x, y in zip(at[:-1], at[1:])], pa.string())
        self.starts = np.concatenate([self.starts, np.cumsum(links) - links + len(self.pairs)])
        self.lengths = np.concatenate([self.lengths, links])
        self.groups = np.concatenate([self.groups, groups])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.keys = pa.concat_arrays([self.keys, new])
        self.spans = pa.concat_arrays([self.spans, spans])

    def _keep(self, used: np.ndarray) -> None:
        lengths = self.lengths[used]
        self.pairs = self.pairs[ranges(self.starts[used], lengths)]
        self.keys, self.spans = self.keys.take(pa.array(used)), self.spans.take(pa.array(used))
        self.groups = self.groups[used]
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths


class Aligner:
    """Aligns whole texts by a byte-level vocabulary (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.encoder_a, self.encoder_b = ByteLevelTokens(path_a), PieceTokens(path_b)
        self.a, self.b = self.encoder_a.tokens, self.encoder_b.tokens
        self.windows = Windows(self.a, self.b)

    def __call__(self, texts: pa.Array) -> dict[str, np.ndarray | pa.Array]:
        """Per text (none null) its counts, its groups as text, and its distinct pairs with how often each occurs."""
        spaced = pc.binary_join_element_wise(" ", texts, "")
        a_ids, a_rows = self.encoder_a(spaced)
        b_ids, b_rows = self.encoder_b(texts)
        a_ids, b_ids = a_ids.astype(np.int64), b_ids.astype(np.int64)
        fits = self._same_bytes(spaced, texts, a_ids, a_rows, b_ids, b_rows)
        a_ids, a_rows = only(a_ids, a_rows, fits)
        b_ids, b_rows = only(b_ids, b_rows, fits)
        at, rows = self._windows(a_ids, a_rows, b_ids, b_rows)
        memo = self.windows
        groups, links = offsets_of(memo.groups[at])[rows], offsets_of(memo.lengths[at])[rows]
        pairs = memo.pairs[ranges(memo.starts[at], memo.lengths[at])]
        row = np.repeat(np.arange(len(texts)), np.diff(links))
        every = len(self.a) * len(self.b)
        distinct, times = np.unique(row * every + pairs, return_counts=True)
        spans = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), memo.spans.take(pa.array(at)))
        return {"n_a": np.diff(a_rows), "n_b": np.diff(b_rows), "n_groups": np.diff(groups), "n_links": np.diff(links),
                "groups": pc.binary_join(spans, ";"), "pairs": distinct % every, "times": times,
                "pair_rows": np.searchsorted(distinct // every, np.arange(len(texts) + 1))}

    def _same_bytes(self, spaced: pa.Array, texts: pa.Array, a_ids: np.ndarray, a_rows: np.ndarray,
                    b_ids: np.ndarray, b_rows: np.ndarray) -> np.ndarray:
        """Whether each text is not empty and the tokens of both sides are its bytes after a space."""
        raw, ends = text_bytes(spaced)
        fits = np.diff(ends) > 1
        for tokens, ids, rows in ((self.a, a_ids, a_rows), (self.b, b_ids, b_rows)):
            joined, at = tokens.join(ids), offsets_of(tokens.lengths[ids])[rows]
            fits &= np.diff(at) == np.diff(ends)
            if len(joined) == len(raw) and np.array_equal(at, ends):
                wrong = np.flatnonzero(joined != raw)
                fits[np.searchsorted(ends, wrong, "right") - 1] = False
                continue
            for i in np.flatnonzero(fits).tolist():
                fits[i] = np.array_equal(joined[at[i]:at[i + 1]], raw[ends[i]:ends[i + 1]])
        return fits

    def _windows(self, a_ids: np.ndarray, a_rows: np.ndarray, b_ids: np.ndarray, b_rows: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Place in the memo of every window, and where each text's windows begin."""
        if not len(a_ids):
            return np.zeros(0, np.int64), np.zeros(len(a_rows), np.int64)
        a_starts, b_starts = offsets_of(self.a.lengths[a_ids]), offsets_of(self.b.lengths[b_ids])
        kind = np.zeros(int(a_starts[-1]) + 1, np.uint8)
        kind[a_starts[:-1][self.a.spaced[a_ids]]] |= 1
        kind[b_starts[:-1][self.b.spaced[b_ids]]] |= 2
        # A text starts with a space on both sides, so its start is an anchor like the others.
        a_first = np.flatnonzero(kind[a_starts[:-1]] == 3)
        b_first = np.flatnonzero(kind[b_starts[:-1]] == 3)
        a_counts, b_counts = np.diff(np.append(a_first, len(a_ids))), np.diff(np.append(b_first, len(b_ids)))
        bounds = offsets_of(a_counts + b_counts + 1)
        flat = np.full(bounds[-1], BETWEEN, np.uint32)
        flat[ranges(bounds[:-1], a_counts)] = a_ids
        flat[ranges(bounds[:-1] + a_counts + 1, b_counts)] = b_ids
        keys = pa.Array.from_buffers(pa.binary(), len(a_first), [
            None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(flat)])
        return self.windows.lookup(keys), np.searchsorted(a_first, a_rows)


def only(ids: np.ndarray, rows: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the rows to keep; the others have none."""
    counts = np.where(keep, np.diff(rows), 0)
    return ids[ranges(rows[:-1], counts)], offsets_of(counts)


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per Python worker, so its memo serves all tasks that the worker runs."""
    return Aligner(path_a, path_b)


COUNTS = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"


def link_rows(docs: DataFrame, path_a: str, path_b: str, digest: bool, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs`` its counts, its groups (or their sha256) and its distinct linked pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        for batch in slices(batches, limit=SLICE):
            found = align(batch.column(2))
            groups = found["groups"]
            if digest:
                groups = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()])
            ends = pa.array(found["pair_rows"], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")),
                 groups, pa.ListArray.from_arrays(ends, pa.array(found["pairs"], pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(found["times"], pa.int32()))],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
        pa.default_memory_pool().release_unused()

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, COUNTS + ", pairs array<bigint>, times array<int>")


def pair_counts(links: DataFrame, tokens_b: int) -> DataFrame:
    """``pair``, ``n`` (documents that hold it) and ``best``: whether no pair of the same A id has more.

    An A id has at most as many pairs as B has tokens, which bounds the window's groups.
    """
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {tokens_b}"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``most`` pairs that stand in more documents than all others; sorted, with ``n`` and ``best``.

    A histogram of the counts by eighths of a power of two says from which count on they are taken.
    """
    step = F.floor(F.log2(F.col("n")) * 8).alias("step")
    taken, least = 0, None
    for row in counts.groupBy(step).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(
            F.desc("step")).collect():
        taken += row["pairs"]
        if taken > most:
            break
        least = row["least"]
    found = counts.filter(F.col("n") >= (least if least is not None else 1 << 62)).toPandas().sort_values("pair")
    return found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)


def scored_rows(links: DataFrame, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Each row's sums over its frequent pairs, and its other pairs."""
    shared = links.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            ends = list_offsets(batch.column(7))
            pairs, times = batch.column(7).flatten().to_numpy(), batch.column(8).flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            weight = np.where(hit, times, 0)
            sums = [offsets_of(weight * (values[at] if len(known) else 0))[ends] for values in (best, n)]
            rest = pa.array(offsets_of(~hit)[ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], *(pa.array(np.diff(s), pa.int64()) for s in sums),
                 pa.ListArray.from_arrays(rest, pa.array(pairs[~hit])),
                 pa.ListArray.from_arrays(rest, pa.array(times[~hit]))],
                [*batch.schema.names[:7], "n_best", "count_sum", "pairs", "times"])

    return links.mapInArrow(run, COUNTS + ", n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>")


def align_documents(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, id_col: str = "doc_id",
                    text_col: str = "text", frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """Per row of ``docs`` how the tokens of two vocabularies align over its whole text.

    ``n_a``, ``n_b``: tokens; ``n_groups``: parts between ends that both share; ``n_links``: pairs of
    token occurrences whose bytes overlap; ``n_best``: links whose pair of ids stands in as many
    documents as any pair of the same A id; ``count_sum``: documents per pair, summed over the links;
    ``groups``: ``a1,a2|b1;a3|b2,b3``, or its sha256 with ``digest``. A text that is null or empty, or
    that either vocabulary does not give back byte for byte, has no tokens: zeros and no groups. Each row is a
    document of its own for the counts, repeated rows too. A text without anchors is one window, however
    long. An empty table gives no rows; other columns are ignored. Both vocabulary files must be
    readable by every executor.
    """
    links = staged(link_rows(docs, path_a, path_b, digest, id_col, text_col), "token-links")
    counts = staged(pair_counts(links, len(PieceTokens(path_b).tokens)), "pair-counts")
    scored = staged(scored_rows(links, frequent_pairs(counts, frequent)), "token-scores")
    rest = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    more = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups")


def alignment_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    return align_documents(docs, path_a, path_b, digest=True).withColumnRenamed("groups", "groups_sha256")
