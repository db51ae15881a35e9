"""Encoding whole texts by a vocabulary, one distinct piece of text at a time.

Tokenizers cut a text into pieces before they merge anything, and a piece's ids depend on the
piece alone. Each task therefore finds the distinct words of a slice of texts, cuts those into
pieces, encodes only pieces that its bounded cache does not hold, and assembles the documents'
ids with array operations. Pieces of plain words (letters of basic Latin and Latin-1, then
punctuation) are found by array operations too; every other word takes the vocabulary's own steps.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 1_000_000

# Letters whose lower case is one letter of the same range and which no normal form changes, then
# printable ASCII that is neither letter, digit nor apostrophe.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-Þà-öø-ÿ]*)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions starts[i] .. starts[i] + lengths[i] - 1, in order."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class PieceCache:
    """Ids of pieces, end to end. When full, it keeps only what the current slice uses."""

    def __init__(self, encode: Callable[[list[str]], tuple[list[int], list[int]]], limit: int = CACHE_PIECES):
        self.encode, self.limit = encode, limit
        self.pieces = pa.array([], pa.string())
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def lookup(self, pieces: pa.Array) -> np.ndarray:
        """Position of each piece, encoding the ones that are new; valid until the next call."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, value_set=self.pieces)
        if at.null_count:
            new = distinct.filter(pc.is_null(at))
            if len(self.pieces) + len(new) > self.limit:
                self._keep(np.unique(at.drop_null().to_numpy()))
            self._add(new)
            at = pc.index_in(distinct, value_set=self.pieces)
        return at.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)

    def _add(self, new: pa.Array) -> None:
        flat, counts = self.encode(new.to_pylist())
        ids, lengths = np.array(flat, np.uint32), np.array(counts, np.int64)
        self.starts = np.concatenate([self.starts, np.cumsum(lengths) - lengths + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.pieces = pa.concat_arrays([self.pieces, new])

    def _keep(self, used: np.ndarray) -> None:
        lengths = self.lengths[used]
        self.ids = self.ids[ranges(self.starts[used], lengths)]
        self.pieces = self.pieces.take(pa.array(used))
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths


def pieces_of_words(words: pa.Array, plain_pieces: Callable[[pa.Array, pa.Array], tuple[pa.Array, pa.Array]],
                    cut: Callable[[str], list[str]], never_plain: Sequence[str] = ()) -> tuple[pa.Array, np.ndarray]:
    """Pieces of distinct words end to end, and the offset of each word.

    ``plain_pieces`` turns the letters and marks of plain words into two pieces each, of which
    either may be empty; ``cut`` cuts one other word. Words that hold one of ``never_plain`` count
    as others.
    """
    found = pc.extract_regex(words, PLAIN)
    plain = pc.is_valid(found)
    for mark in never_plain:
        plain = pc.and_(plain, pc.invert(pc.match_substring(words, mark)))
    first, second = plain_pieces(pc.struct_field(found, "letters"), pc.struct_field(found, "marks"))
    others = [cut(w) for w in words.filter(pc.invert(plain)).to_pylist()]
    other_lengths = np.fromiter(map(len, others), np.int64, len(others))
    is_plain = plain.to_numpy(zero_copy_only=False)
    lengths = np.full(len(words), 2, np.int64)
    lengths[~is_plain] = other_lengths
    offsets = offsets_of(lengths)
    source = np.zeros(offsets[-1], np.int64)
    at = np.flatnonzero(is_plain)
    source[offsets[:-1][at]] = at
    source[offsets[:-1][at] + 1] = at + len(words)
    source[ranges(offsets[:-1][~is_plain], other_lengths)] = 2 * len(words) + np.arange(other_lengths.sum())
    extra = pa.array([p for one in others for p in one], pa.string())
    return pa.concat_arrays([first, second, extra]).take(pa.array(source)), offsets


def assemble(cache: PieceCache, pieces: pa.Array, word_offsets: np.ndarray, which: np.ndarray,
             row_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows end to end and each row's offset.

    ``which`` holds the word of every position, ``row_offsets`` where each row's words begin.
    """
    at = cache.lookup(pieces)
    lengths = cache.lengths[at]
    ids = cache.ids[ranges(cache.starts[at], lengths)]
    ends = offsets_of(lengths)[word_offsets]
    counts = np.diff(ends)[which]
    return ids[ranges(ends[:-1][which], counts)], offsets_of(counts)[row_offsets]


def list_offsets(lists: pa.ListArray) -> np.ndarray:
    ends = lists.offsets.to_numpy().astype(np.int64)
    return ends - ends[0]


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a printable letter: itself, or one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of whole texts by a tokenizers file whose tokens never cross white space.

    Its normalizer lowers case and folds white space, its pre-tokenizer then keeps runs of letters,
    single digits and runs of other marks; so texts are cut at white space first.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.cache = PieceCache(self._encode)

    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        """Ids of all pieces in one list, and how many each piece has."""
        tokenize, letters = self.tokenizer.model.tokenize, self.letters
        flat: list[int] = []
        counts = []
        before = 0
        for piece in pieces:
            if piece.startswith("\0"):
                flat.extend(map(int, piece[1:].split()))
            elif piece.isascii():
                flat.extend([t.id for t in tokenize(piece)] if piece else ())
            else:
                flat.extend([t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))])
            counts.append(len(flat) - before)
            before = len(flat)
        return flat, counts

    def _cut(self, word: str) -> list[str]:
        """Words that are not plain are encoded by the library; a leading NUL marks finished ids."""
        return ["\0" + " ".join(map(str, self.tokenizer.encode(word, add_special_tokens=False).ids))]

    def _plain(self, letters: pa.Array, marks: pa.Array) -> tuple[pa.Array, pa.Array]:
        return pc.utf8_lower(letters), marks

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the offset of each text; no text is null."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        pieces, word_offsets = pieces_of_words(words, self._plain, self._cut, self.added)
        which = coded.indices.to_numpy().astype(np.int64)
        return assemble(self.cache, pieces, word_offsets, which, list_offsets(lists))


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so its cache serves all tasks that the worker runs."""
    return WordEncoder(path)
