"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens. It starts with one state that loops over all 256 byte tokens, and every
merge (x, y) adds a gadget to it, in the order of the merges: a reader that has just read x may no
longer read y, but may read the new token xy wherever it could read x and then y. A state is thus
fixed by the token read last, and the gadget of (x, y)

* gives the state after xy a copy of the arcs that leave the state after y,
* removes the arc from the state after x on y,
* copies the arcs that still enter on x for the new token xy.

The order matters where x equals y: merges go from left to right, so xx may be followed by x or by
xx, but x may not be followed by xx.

``MergeAutomaton`` keeps the copies by reference (a token's parts and its time of creation), so
50,000 gadgets take a few megabytes, and looks an arc up by following the references back to the
gadget that removed it or to the byte loop. Arcs that were looked up stay in a transition table.

A piece of text has exactly one path through the automaton: its BPE encoding. ``encode_piece``
follows it byte by byte; at each position the table decides which token ends there.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidewater.llm.frames import slices, texts_of
from tidewater.llm.text import PieceCache, assemble, byte_letters, list_offsets, offsets_of, pieces_of_words, ranges

MAX_ARCS = 4_000_000

# Fixed value: the pre-split pattern of byte-level vocabularies of this kind.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class MergeAutomaton:
    """The automaton of a byte-level BPE vocabulary and its arc labels."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]], byte_tokens: list[int]):
        """``labels`` by id; ``merges`` as (x, y, xy) in order; ``byte_tokens`` the id of each byte."""
        self.labels = labels
        self.created = [0] * len(labels)
        self.parts: list[tuple[int, int]] = [(-1, -1)] * len(labels)
        self.removed: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.token_of = {labels[i]: i for i in byte_tokens}
        self.longest = 1
        for time, (x, y, xy) in enumerate(merges, start=1):
            # The gadget makes a token only where the arc to be replaced still exists.
            if self.arc_at(x, y, time):
                self.created[xy], self.parts[xy] = time, (x, y)
                self.token_of[labels[xy]] = xy
                self.longest = max(self.longest, len(labels[xy]))
            self.removed.setdefault((x, y), time)

    def arc_at(self, u: int, v: int, time: int) -> bool:
        """Whether the state after ``u`` has an arc on ``v`` before the gadget of ``time``."""
        while True:
            if self.removed.get((u, v), time) < time:
                return False
            if self.created[u] == self.created[v] == 0:
                return True
            if self.created[u] > self.created[v]:
                time, u = self.created[u], self.parts[u][1]
            else:
                time, v = self.created[v] + 1, self.parts[v][0]

    def arc(self, u: int, v: int) -> bool:
        found = self.arcs.get((u, v))
        if found is None:
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            found = self.arcs[u, v] = self.arc_at(u, v, len(self.labels) + 1)
        return found

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The labels of each piece's path.

        ``last[i]`` is the state after the first i bytes; it depends on those bytes alone, so a
        piece goes on where it parts from the piece before. Sorted pieces share most of their way.
        """
        token_of, arcs, longest, labels = self.token_of, self.arcs, self.longest, self.labels
        paths = []
        last = [-1]
        known = b""
        for piece in pieces:
            same, most = 0, min(len(piece), len(known))
            while same < most and piece[same] == known[same]:
                same += 1
            del last[same + 1:]
            for end in range(same + 1, len(piece) + 1):
                start = end - longest if end > longest else 0
                while True:
                    token = token_of.get(piece[start:end])
                    if token is not None:
                        if start == 0:
                            break
                        before = last[start]
                        open_arc = arcs.get((before, token))
                        if open_arc or open_arc is None and self.arc(before, token):
                            break
                    start += 1
                last.append(token)
            known = piece
            path = []
            end = len(piece)
            while end:
                path.append(last[end])
                end -= len(labels[last[end]])
            path.reverse()
            paths.append(path)
        return paths

    def encode_piece(self, piece: bytes) -> list[int]:
        return self.encode_pieces([piece])[0]

    def decode(self, ids: Sequence[int]) -> bytes:
        """The labels of the arcs, as text: bytes that are not UTF-8 become replacement characters."""
        raw = b"".join([self.labels[i] for i in ids])
        return raw.decode("utf-8", "replace").encode()


class ByteStrings:
    """A byte string per id, joined for many ids by array operations."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return self.data[ranges(self.starts[ids], self.lengths[ids])].tobytes()


class AutomatonEncoder:
    """Ids of whole texts: added tokens first, then pieces by the pattern, then the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        as_byte = {letter: byte for byte, letter in byte_letters().items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        labels = [b""] * size
        for token, i in vocab.items():
            labels[i] = bytes(as_byte[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        byte_tokens = [vocab[letter] for letter in as_byte]
        self.automaton = MergeAutomaton(labels, merges, byte_tokens)
        for content, i in self.added.items():
            labels[i] = content.encode()
        self.numbers = ByteStrings([b"%d," % i for i in range(size)])
        self.bytes = ByteStrings(labels)
        self.pattern = regex.compile(PATTERN)
        self.cut_added = regex.compile("(" + "|".join(
            regex.escape(a) for a in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.cache = PieceCache(self._encode)

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        raw = [p.encode() for p in pieces]
        order = sorted(range(len(raw)), key=raw.__getitem__)
        paths: list[list[int]] = [[]] * len(raw)
        for i, path in zip(order, self.automaton.encode_pieces([raw[i] for i in order])):
            paths[i] = path
        for i, piece in enumerate(pieces):
            if piece.startswith("\0\0") and piece[2:] in self.added:
                paths[i] = [self.added[piece[2:]]]
        return [i for path in paths for i in path], [len(path) for path in paths]

    def _pieces(self, text: str) -> list[str]:
        """Pieces of any text; two NULs before its name mark an added token."""
        if self.cut_added is None:
            return self.pattern.findall(text)
        found = []
        for i, part in enumerate(self.cut_added.split(text)):
            found.extend(["\0\0" + part] if i % 2 else self.pattern.findall(part))
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the offset of each text; no text is null.

        A piece takes at most one blank before it, so a text without two white-space characters in
        a row can be cut at blanks; all other texts are cut by the pattern as a whole.
        """
        by_row = pc.match_substring_regex(texts, r"[\s\pZ\x{85}\x0b\x1c-\x1f][\s\pZ\x{85}\x0b\x1c-\x1f]")
        for mark in self.added:
            by_row = pc.or_(by_row, pc.match_substring(texts, mark))
        odd = by_row.to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._by_blanks(texts)
        pieces = [self._pieces(t) for t in texts.filter(by_row).to_pylist()]
        at = self.cache.lookup(pa.array([p for one in pieces for p in one], pa.string()))
        lengths = self.cache.lengths[at]
        odd_ids = self.cache.ids[ranges(self.cache.starts[at], lengths)]
        odd_ends = offsets_of(lengths)[offsets_of(np.array([len(one) for one in pieces]))]
        ids, ends = self._by_blanks(texts.filter(pc.invert(by_row)))
        starts, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        starts[odd], counts[odd] = odd_ends[:-1] + len(ids), np.diff(odd_ends)
        starts[~odd], counts[~odd] = ends[:-1], np.diff(ends)
        return np.concatenate([ids, odd_ids])[ranges(starts, counts)], offsets_of(counts)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes.join(ids).decode("utf-8", "replace").encode()

    def _by_blanks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        rows = list_offsets(lists)
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        # The first word of a text has no blank before it; all others have one.
        first = np.unique(which[rows[:-1]]) if len(which) else np.zeros(0, np.int64)
        spaced, ends = pieces_of_words(coded.dictionary, self._after_blank, lambda w: self.pattern.findall(" " + w))
        bare, bare_ends = pieces_of_words(coded.dictionary.take(pa.array(first)), self._at_start, self.pattern.findall)
        if len(which):
            which[rows[:-1]] = len(coded.dictionary) + np.searchsorted(first, which[rows[:-1]])
        return assemble(self.cache, pa.concat_arrays([spaced, bare]),
                        np.concatenate([ends, bare_ends[1:] + ends[-1]]), which, rows)

    def _after_blank(self, letters: pa.Array, marks: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The blank belongs to the letters, or to the marks of a word without letters."""
        has_letters = pc.not_equal(letters, "")
        blank = pc.binary_join_element_wise(" ", pc.if_else(has_letters, letters, marks), "")
        return blank, pc.if_else(has_letters, marks, "")

    def _at_start(self, letters: pa.Array, marks: pa.Array) -> tuple[pa.Array, pa.Array]:
        return letters, marks


@functools.lru_cache(maxsize=2)
def automaton_encoder(path: str) -> AutomatonEncoder:
    return AutomatonEncoder(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id``, its ``ids`` and the text ``decoded`` from them.

    Every row of ``docs`` gives one row. A null text counts as empty; an empty text has no ids and
    decodes to an empty text. Repeated rows are encoded alike; a null id stays null. Other columns
    are ignored. ``vocabulary`` is the path of a byte-level tokenizers file that every executor can
    read. One distinct piece is encoded once per slice of texts and cached up to a fixed number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = automaton_encoder(vocabulary)
        for batch in slices(batches):
            ids, ends = encoder(batch.column(1))
            decoded = [encoder.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32))),
                 pa.array(decoded, pa.binary()).cast(pa.string())], ["doc_id", "ids", "decoded"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digest of ``encode_documents``: number of ids, sha256 of the ids and of the decoded text.

    The digests are taken next to the encoder, so that neither ids nor texts leave its task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = automaton_encoder(vocabulary)
        for batch in slices(batches):
            ids, ends = encoder(batch.column(1))
            coded, decoded = [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                coded.append(hashlib.sha256(encoder.numbers.join(ids[a:b])[:-1]).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids[a:b])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
