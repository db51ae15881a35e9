"""Language-model scoring with a hashed maximum-entropy model.

The next token depends on the words before it through hashed features: the last word, the two last
words together (n-grams), and the words two and three back (skips). The softmax is factored by
classes: P(class | features), then P(word | class, features); all factors start from the corpus's own
counts, so a model without weights is the smoothed unigram model. The most frequent words are members
of 32 classes, with dense rows of weights by hashed feature, trained by gradient steps. One more
class holds all other words. Inside it the features are pairs of hashes of the last word and the
word: one weight for every pair that training has at least twice, so their table grows with the
corpus. A pair is active for one context only, so the weight where its discounted likelihood is
largest follows from counts: with c the pair's count, n that of the context and p the word's prior
share, its factor is ((c - DISCOUNT) / p + rest) / (n + EXTRA), and rest / (n + EXTRA) for a pair
without a weight, where ``rest`` is what discounting left over. Shares sum to one in every context.

1. Slices of texts are staged as arrays of local word numbers with their distinct words.
2. Each slice sends its words with their counts to groups by word hash, which sum them and answer
   each slice with its words' counts in the corpus.
3. Rounds of gradient steps, each over part of the slices: a slice starts from the round's weights,
   and changes are averaged per row over the slices that changed it. All rounds together use every
   training token once. These tables have a fixed size and go to all tasks.
4. Each slice sends its pairs to groups by hashed context, four bytes a pair, which sum them and
   answer each slice. The followers of a word met over ``HOT`` times are dealt over several groups.
5. Slices come together with both answers and are scored.

A group holds its share of the pairs or words of each slice; groups are as many as the tokens ask
for. What stands in every slice costs its group about ten bytes a slice.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.frames import fold, slices, staged, tasks_for, texts_of
from tidewater.llm.text import list_offsets, offsets_of

MEMBERS, CLASSES = 32, 32
VOCABULARY = MEMBERS * CLASSES - 1  # and the end of a text
RARE = CLASSES
CLASS_ROWS, MEMBER_ROWS = 1 << 13, 1 << 15
ROUNDS, BATCH, RATE, STRIPES = 4, 16_384, 0.1, 16
PAIR_MIN, DISCOUNT, EXTRA = 2, 0.75, 1.0
SLICE, HOT, GROUP = 8 << 20, 1 << 22, 1 << 20
LONG_RUN = 48
CONTEXT = 3
BLANK = np.uint64(0x51ED270B)

SLICES = ("chunk bigint, doc_ids array<bigint>, counts array<bigint>, codes binary, words binary, known binary, "
          "n_words bigint, round int")
WORD_ASKS = "stripe int, chunk bigint, words binary, known binary"
WORD_COUNTS = ("stripe int, chunk bigint, c binary, total bigint, types bigint, "
               "top array<struct<word:string,c:bigint>>, hot array<struct<word:string,c:bigint>>")
PAIR_ASKS = "stripe int, chunk bigint, hot bigint, contexts binary, sizes binary, pairs binary, known binary"
PAIR_COUNTS = "stripe int, chunk bigint, hot bigint, first int, c binary, n binary, rest binary"
CHANGES = "name string, stripe int, change binary, touched binary"
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def hashes_of(words: list) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, every bit of which depends on both."""
    out = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xE7037ED1A0B428DB)
    return out ^ (out >> np.uint64(29))


@functools.lru_cache(maxsize=8)
def packer() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray | bytes) -> bytes:
    return packer()[0].compress(values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(packer()[1].decompress(data), kind)


def features_of(hashed: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Local word number (-1: end) and feature hashes of every token.

    A text's end is its last token; before its first word there are blanks.
    """
    ends = offsets_of(counts + 1)
    local = np.full(ends[-1], -1, np.int64)
    last = np.zeros(ends[-1], bool)
    last[ends[1:] - 1] = True
    local[~last] = codes
    seen = np.append(hashed, np.uint64(1))[local]
    row = np.repeat(np.arange(len(counts)), counts + 1)
    place = np.arange(len(local)) - ends[row]
    back = []
    for k in range(1, CONTEXT + 1):
        before = np.full(len(local), BLANK)
        before[k:] = seen[:-k] if k <= len(seen) else before[k:]
        back.append(np.where(place >= k, before, BLANK))
    return local, np.stack([
        back[0] * np.uint64(0x9E3779B97F4A7C15), back[1] * np.uint64(0xC2B2AE3D27D4EB4F),
        back[2] * np.uint64(0x165667B19E3779F9),
        (back[0] * np.uint64(31) + back[1]) * np.uint64(0xD6E8FEB86659FD93)], axis=1)


def read_slices(docs: DataFrame, rounds: int, slice_bytes: int) -> DataFrame:
    """One row per slice: its documents, their word numbers, the distinct words and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=slice_bytes):
            lists = pc.ascii_split_whitespace(pc.ascii_lower(batch.column(1)))
            coded = lists.flatten().dictionary_encode()
            code = coded.indices.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(list_offsets(lists)))
            # White space at the ends of a text leaves empty words, which are none and sort first.
            order = pc.sort_indices(coded.dictionary).to_numpy()
            words = coded.dictionary.take(pa.array(order))
            blank = int(len(words) > 0 and words[0].as_py() == "")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - blank
            code = rank[code] if len(code) else np.zeros(0, np.int64)
            code, row = code[code >= 0], row[code >= 0]
            words = words.slice(blank).to_pylist()
            train = batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                pa.array([np.bincount(row, minlength=batch.num_rows)], pa.list_(pa.int64())),
                pa.array([packed(code.astype("<i4"))], pa.binary()), pa.array([packed("\n".join(words).encode())], pa.binary()),
                pa.array([packed(np.bincount(code[train[row]], minlength=len(words)).astype("<i8"))], pa.binary()),
                pa.array([len(words)], pa.int64()), pa.array([zlib.crc32(b"%d" % chunk) % max(rounds, 1)], pa.int32())],
                ["chunk", "doc_ids", "counts", "codes", "words", "known", "n_words", "round"])
            chunk += 1

    return docs.mapInArrow(run, SLICES)


def is_training(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % 5 != 1


def words_in(data: bytes) -> list[bytes]:
    text = packer()[1].decompress(data)
    return text.split(b"\n") if text else []


def batch_of(rows: list[tuple], kinds: str) -> pa.Table:
    """Rows as a table with the columns of a Spark schema."""
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    pair = pa.list_(pa.struct([("word", pa.string()), ("c", pa.int64())]))
    fields = [f.strip().split(" ", 1) for f in kinds.replace("word:string,c", "word:string;c").split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table([pa.array(list(c), types.get(k, pair)) for c, (_, k) in zip(columns, fields)], [f for f, _ in fields])


def parts_by(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct value with the positions that have it, both in ascending order."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(values[order[a]]), order[a:b]


def word_stripes(hashed: np.ndarray, stripes: int) -> Iterator[tuple[int, np.ndarray]]:
    return parts_by(((hashed >> np.uint64(20)) % np.uint64(stripes)).astype(np.int64))


def count_words(parts: DataFrame, stripes: int, hot: int) -> DataFrame:
    """Per slice and stripe the corpus counts of the slice's words, and per stripe totals, the most frequent words
    and those met over ``hot`` times."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, known in zip(*(batch[c].to_pylist() for c in ("chunk", "words", "known"))):
                words, known = words_in(words), unpacked(known, "<i8")
                rows = [(stripe, chunk, packed(b"\n".join([words[i] for i in at])), packed(known[at]))
                        for stripe, at in word_stripes(hashes_of(words), stripes)]
                yield from batch_of(rows, WORD_ASKS).to_batches()

    def total(table: pa.Table) -> pa.Table:
        asked = [words_in(w) for w in table["words"].to_pylist()]
        coded = pa.chunked_array([pa.array(w, pa.binary()) for w in asked], pa.binary()).combine_chunks().dictionary_encode()
        at = coded.indices.to_numpy()
        known = np.concatenate([unpacked(k, "<i8") for k in table["known"].to_pylist()])
        count = np.bincount(at, known, len(coded.dictionary)).astype(np.int64)
        lexicon = pa.table({"word": coded.dictionary.cast(pa.string()), "c": count}).filter(pa.array(count > 0, pa.bool_()))
        # No more than the vocabulary have the least count at which a word can enter it, but for ties.
        least = np.partition(count, -VOCABULARY)[-VOCABULARY] if len(count) > VOCABULARY else 1
        top = lexicon.filter(pc.greater_equal(lexicon["c"], max(int(least), 1))).sort_by(
            [("c", "descending"), ("word", "ascending")]).slice(0, VOCABULARY)
        stripe, ends = table["stripe"][0].as_py(), offsets_of(np.array([len(w) for w in asked]))
        rows = [(stripe, chunk, packed(count[at[a:b]]), None, None, None, None)
                for chunk, a, b in zip(table["chunk"].to_pylist(), ends[:-1], ends[1:])]
        rows.append((stripe, None, None, int(count.sum()), len(lexicon), top.to_pylist(),
                     lexicon.filter(pc.greater(lexicon["c"], hot)).to_pylist()))
        return batch_of(rows, WORD_COUNTS)

    return parts.select("chunk", "words", "known").mapInArrow(ask, WORD_ASKS).groupBy("stripe").applyInArrow(total, WORD_COUNTS)


@dataclass
class Prior:
    """The vocabulary and the smoothed shares of classes and members; fixed size."""

    words: list[str]
    tokens: int
    types: int
    class_log: np.ndarray
    member_log: np.ndarray
    rare_mass: float

    @staticmethod
    def of(top: list[tuple[str, int]], tokens: int, types: int, ends: int) -> Prior:
        """``top``: the most frequent words with their counts; totals include the ``ends``."""
        mass = np.zeros(CLASSES * MEMBERS)
        mass[:len(top) + 1] = np.array([ends, *(c for _, c in top)]) + 0.5
        rare = max(tokens - ends - sum(c for _, c in top), 0) + 0.5 * (max(types - (ends > 0) - len(top), 0) + 1)
        classes = np.append(mass.reshape(CLASSES, MEMBERS).sum(axis=1), rare)
        with np.errstate(divide="ignore", invalid="ignore"):
            member = np.log(mass.reshape(CLASSES, MEMBERS) / classes[:CLASSES, None])
            return Prior([w for w, _ in top], tokens, types, np.log(classes / classes.sum()).astype(np.float32),
                         np.where(np.isfinite(member), member, -1e9).astype(np.float32), rare)


def softmax(logits: np.ndarray) -> np.ndarray:
    """In place, along the last axis."""
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def run_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each run of rows; runs start at ``first``.

    Short runs are summed together, one row of each at a time, and long ones as a product, which is
    twice as fast as ``np.add.reduceat`` on rows.
    """
    length = np.diff(np.append(first, len(values)))
    out = values.take(first, axis=0)
    long = length > LONG_RUN
    place, live = 1, np.flatnonzero((length > 1) & ~long)
    while len(live):
        out[live] += values.take(first[live] + place, axis=0)
        place += 1
        live = live[length[live] > place]
    for run in np.flatnonzero(long):
        out[run] = np.ones(length[run], values.dtype) @ values[first[run]:first[run] + length[run]]
    return out


class Table:
    """Weight rows that are summed over a token's features."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.bits = len(weights).bit_length() - 1
        self.squares = np.full(len(weights), 1e-6, np.float32)
        self.touched = np.zeros(len(weights), bool)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.uint16)

    def logits(self, rows: np.ndarray, prior: np.ndarray) -> np.ndarray:
        out = prior.copy() if prior.ndim == 2 else np.repeat(prior[None, :], len(rows), axis=0)
        for f in range(rows.shape[1]):
            out += self.weights.take(rows[:, f], axis=0)
        return out

    def step(self, rows: np.ndarray, error: np.ndarray) -> None:
        """One sparse gradient step; a row's rate falls with the squares of its gradients."""
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        sorted_rows = flat[order]
        first = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
        at = sorted_rows[first]
        gradient = run_sums(error.take(order // rows.shape[1], axis=0), first)
        self.squares[at] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        self.weights[at] -= RATE * gradient / np.sqrt(self.squares[at])[:, None]
        self.touched[at] = True


class Model:
    def __init__(self, prior: Prior, classes: np.ndarray, members: np.ndarray):
        self.prior, self.classes, self.members = prior, Table(classes), Table(members)
        self.number = {w: i + 1 for i, w in enumerate(prior.words)}
        hashed = hashes_of(prior.words)
        self.order = np.argsort(hashed)
        self.sorted = hashed[self.order]

    @staticmethod
    def zeros() -> tuple[np.ndarray, np.ndarray]:
        return (np.zeros((CLASS_ROWS, CLASSES + 1), np.float32), np.zeros((MEMBER_ROWS, MEMBERS), np.float32))

    def numbers(self, hashed: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of hashed words (-1: rare)."""
        if not len(self.sorted):
            return np.full(len(hashed), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashed), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashed, self.order[at] + 1, -1)

    def tokens(self, words: list[str], codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary number (-1: rare), local word number (-1: end) and feature hashes of every token."""
        hashed = hashes_of(words)
        local, features = features_of(hashed, codes, counts)
        return np.append(self.numbers(hashed), 0)[local], local, features

    @staticmethod
    def _salted(features: np.ndarray, group: np.ndarray) -> np.ndarray:
        salted = (features ^ (group.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))[:, None])
        return salted * np.uint64(0xE7037ED1A0B428DB)

    def learn(self, target: np.ndarray, features: np.ndarray) -> None:
        for a in range(0, len(target), BATCH):
            t, f = target[a:a + BATCH], features[a:a + BATCH]
            group = np.where(t < 0, RARE, t // MEMBERS)
            rows = self.classes.rows(f)
            error = softmax(self.classes.logits(rows, self.prior.class_log))
            error[np.arange(len(t)), group] -= 1
            self.classes.step(rows, error)
            inside = np.flatnonzero(t >= 0)
            if len(inside):
                group = group[inside]
                rows = self.members.rows(self._salted(f[inside], group))
                error = softmax(self.members.logits(rows, self.prior.member_log[group]))
                error[np.arange(len(inside)), t[inside] % MEMBERS] -= 1
                self.members.step(rows, error)

    def log10(self, target: np.ndarray, features: np.ndarray, rare_counts: np.ndarray) -> np.ndarray:
        """log10 probability of each token; ``rare_counts`` are the training counts of rare tokens."""
        out = np.empty(len(target))
        for a in range(0, len(target), BATCH):
            t, f = target[a:a + BATCH], features[a:a + BATCH]
            group = np.where(t < 0, RARE, t // MEMBERS)
            share = softmax(self.classes.logits(self.classes.rows(f), self.prior.class_log))
            p = share[np.arange(len(t)), group].astype(np.float64)
            inside = np.flatnonzero(t >= 0)
            if len(inside):
                group = group[inside]
                share = softmax(self.members.logits(self.members.rows(self._salted(f[inside], group)), self.prior.member_log[group]))
                p[inside] *= share[np.arange(len(inside)), t[inside] % MEMBERS]
            rare = t < 0
            p[rare] *= (rare_counts[a:a + BATCH][rare] + 0.5) / self.prior.rare_mass
            out[a:a + BATCH] = np.log10(np.maximum(p, 1e-300))
        return out


@dataclass
class Slice:
    ids: list
    counts: np.ndarray
    hashed: np.ndarray
    target: np.ndarray
    local: np.ndarray
    features: np.ndarray
    train: np.ndarray

    @staticmethod
    def of(row: dict, model: Model) -> Slice:
        hashed = hashes_of(words_in(row["words"]))
        counts = np.asarray(row["counts"], np.int64)
        local, features = features_of(hashed, unpacked(row["codes"], "<i4").astype(np.int64), counts)
        train = np.repeat(np.array([is_training(i) for i in row["doc_ids"]], bool), counts + 1)
        return Slice(row["doc_ids"], counts, hashed, np.append(model.numbers(hashed), 0)[local], local, features, train)


class Pairs:
    """The distinct pairs (last word, rare word) of a slice, dealt to groups by hashed context.

    ``at`` are the rare tokens, ``pair`` their pairs. The words in ``hot`` (hash to number of parts)
    have their followers dealt over several groups.
    """

    def __init__(self, s: Slice, hot: dict[int, int], stripes: int):
        width = len(s.hashed) + 1
        first = np.zeros(len(s.local), bool)
        first[offsets_of(s.counts + 1)[:-1]] = True
        before = np.append(-1, s.local[:-1])
        before[first] = width - 1
        self.at = np.flatnonzero(s.target < 0)
        both, self.pair = np.unique(before[self.at] * width + s.local[self.at], return_inverse=True)
        self.known = np.bincount(self.pair[s.train[self.at]], minlength=len(both))
        self.word = both % width
        hashed = np.append(s.hashed, BLANK)
        self.context = hashed[both // width]
        mix = mixed(self.context, hashed[self.word])
        self.hot = np.zeros(len(both), bool)
        part = np.zeros(len(both), np.uint64)
        if hot:
            names = np.array(sorted(hot), np.uint64)
            parts = np.array([hot[int(n)] for n in names], np.uint64)
            place = np.minimum(np.searchsorted(names, self.context), len(names) - 1)
            self.hot = names[place] == self.context
            part[self.hot] = (mix >> np.uint64(36))[self.hot] % parts[place][self.hot]
        cell = mixed(self.context, part)
        self.key = mix.astype(np.uint32)
        self.cell = cell.astype(np.uint32)
        self.stripe = ((cell >> np.uint64(33)) % np.uint64(stripes)).astype(np.int64)

    def dealt(self) -> Iterator[tuple[int, int | None, np.ndarray, np.ndarray]]:
        """Per group: stripe, hot context or None, the pairs and where each context starts among them."""
        for hot in (False, True):
            which = np.flatnonzero(self.hot == hot)
            joined = (self.stripe[which] << 32) + self.cell[which]
            for _, at in parts_by(joined if hot else self.stripe[which]):
                at = which[at]
                at = at[np.argsort(self.cell[at], kind="stable")]
                starts = np.flatnonzero(np.diff(self.cell[at].astype(np.int64), prepend=-1))
                yield (int(self.stripe[at[0]]), int(self.context[at[0]].astype(np.int64)) if hot else None, at, starts)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.slice(row, 1).to_pylist()[0]


def count_pairs(parts: DataFrame, prior: Prior, hot: dict[int, int], stripes: int) -> DataFrame:
    """Per slice and group the counts of its pairs that have a weight (others: 0), and ``n`` and ``rest`` of its
    contexts; per hot context and group a row without slice that holds its part of ``n`` and ``rest``."""
    shared = parts.sparkSession.sparkContext.broadcast((prior, hot))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, hot = shared.value
        model = Model(prior, *Model.zeros())
        for row in rows_of(batches):
            pairs = Pairs(Slice.of(row, model), hot, stripes)
            out = [(stripe, row["chunk"], name, packed(pairs.cell[at[starts]]),
                    packed(np.diff(np.append(starts, len(at))).astype(np.uint32)), pairs.key[at].tobytes(),
                    packed(pairs.known[at].astype(np.uint32))) for stripe, name, at, starts in pairs.dealt()]
            yield from batch_of(out, PAIR_ASKS).to_batches()

    def total(table: pa.Table) -> pa.Table:
        names = ("contexts", "sizes", "pairs", "known")
        asks = [(unpacked(c, "<u4"), unpacked(s, "<u4"), np.frombuffer(p, "<u4"), unpacked(k, "<u4"))
                for c, s, p, k in zip(*(table[n].to_pylist() for n in names))]
        contexts, sizes, keys, known = (np.concatenate(x) for x in zip(*asks))
        keys = (np.repeat(contexts, sizes).astype(np.uint64) << np.uint64(32)) | keys
        distinct, pair = np.unique(keys, return_inverse=True)
        count = np.bincount(pair, known, len(distinct)).astype(np.int64)
        cells = (distinct >> np.uint64(32)).astype(np.uint32)
        starts = np.flatnonzero(np.diff(cells.astype(np.int64), prepend=-1))
        kept = np.where(count >= PAIR_MIN, count, 0)
        n = np.add.reduceat(count, starts)
        rest = n - np.add.reduceat(np.maximum(kept - DISCOUNT, 0), starts)
        cell = np.searchsorted(cells[starts], contexts)
        out, told = [], set()
        ends = offsets_of(np.array([len(a[2]) for a in asks])), offsets_of(np.array([len(a[0]) for a in asks]))
        stripe = table["stripe"][0].as_py()
        for i, (chunk, hot) in enumerate(zip(table["chunk"].to_pylist(), table["hot"].to_pylist())):
            mine, own = slice(ends[0][i], ends[0][i + 1]), cell[ends[1][i]:ends[1][i + 1]]
            # A hot context may have several parts in one group; the cell tells them apart.
            out.append((stripe, chunk, hot, None if hot is None else int(contexts[ends[1][i]].astype(np.int32)),
                        packed(kept[pair[mine]]), packed(n[own]), packed(rest[own])))
            if hot is not None and (hot, int(own[0])) not in told:
                told.add((hot, int(own[0])))
                out.append((stripe, None, hot, None, None, packed(n[own]), packed(rest[own])))
        return batch_of(out, PAIR_COUNTS)

    return parts.select("chunk", "doc_ids", "counts", "codes", "words").mapInArrow(ask, PAIR_ASKS).groupBy(
        "stripe").applyInArrow(total, PAIR_COUNTS)


def hot_totals(answers: DataFrame) -> dict[int, tuple[int, float]]:
    """``n`` and ``rest`` of the hot contexts: at most one per ``HOT`` training tokens, 16 bytes each."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch["hot"], pa.array([int(unpacked(x, "<i8")[0]) for x in batch["n"].to_pylist()], pa.int64()),
                pa.array([float(unpacked(x, "<f8")[0]) for x in batch["rest"].to_pylist()], pa.float64())], ["hot", "n", "rest"])

    rows = answers.filter("chunk is null").select("hot", "n", "rest").mapInArrow(read, "hot bigint, n bigint, rest double")
    return {r[0]: (r[1], r[2]) for r in rows.groupBy("hot").agg(F.sum("n"), F.sum("rest")).collect()}


def learn_round(part: DataFrame, prior: Prior, weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The weights after one round of gradient steps over ``part``, averaged over its slices."""
    shared = part.sparkSession.sparkContext.broadcast((prior, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, start = shared.value
        change = [np.zeros_like(w) for w in start]
        touched = [np.zeros(len(w), np.int64) for w in start]
        for row in rows_of(batches):
            model = Model(prior, *(w.copy() for w in start))
            s = Slice.of(row, model)
            model.learn(s.target[s.train], s.features[s.train])
            for i, table in enumerate((model.classes, model.members)):
                change[i][table.touched] += table.weights[table.touched] - start[i][table.touched]
                touched[i] += table.touched
        for name, values, count in zip(("class", "member"), change, touched):
            for stripe, (v, n) in enumerate(zip(np.split(values, STRIPES), np.split(count, STRIPES))):
                if n.any():
                    v = (v[n > 0] / n[n > 0, None]).astype(np.float16)
                    yield from batch_of([(name, stripe, v.tobytes(), packed(n.astype("<i8")))], CHANGES).to_batches()

    def average(table: pa.Table) -> pa.Table:
        name, stripe = table["name"][0].as_py(), table["stripe"][0].as_py()
        total = count = 0
        for change, touched in zip(table["change"].to_pylist(), table["touched"].to_pylist()):
            n = unpacked(touched, "<i8")
            values = np.zeros((len(n), weights_of[name]), np.float32)
            values[n > 0] = np.frombuffer(change, np.float16).reshape(-1, weights_of[name])
            total, count = total + values * n[:, None], count + n
        return batch_of([(name, stripe, (total / np.maximum(count, 1)[:, None]).astype(np.float32).tobytes(), None)], CHANGES)

    weights_of = {"class": CLASSES + 1, "member": MEMBERS}
    changes = part.select("doc_ids", "counts", "codes", "words").mapInArrow(run, CHANGES)
    # 2 * STRIPES rows, together as large as the weights.
    new = [w.copy() for w in weights]
    for row in changes.groupBy("name", "stripe").applyInArrow(average, CHANGES).collect():
        table = new[row["name"] != "class"]
        size = len(table) // STRIPES
        table[row["stripe"] * size:(row["stripe"] + 1) * size] += np.frombuffer(row["change"], np.float32).reshape(size, -1)
    shared.unpersist()
    return new[0], new[1]


def factors(c: np.ndarray, n: np.ndarray, rest: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """By how much pair features change the prior shares of rare words."""
    return (np.maximum(c - DISCOUNT, 0) / prior + rest + EXTRA) / (n + EXTRA)


def score_slices(parts: DataFrame, answers: DataFrame, prior: Prior, weights: tuple[np.ndarray, np.ndarray],
                 hot: dict[int, int], totals: dict[int, tuple[int, float]], ends: int, stripes: tuple[int, int]) -> DataFrame:
    shared = parts.sparkSession.sparkContext.broadcast((prior, weights, hot, totals))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        prior, weights, hot, totals = shared.value
        model, out = Model(prior, *weights), []
        bottom = np.log10(prior.tokens + 0.5 * (prior.types + 1))
        told = {(r["n"] is None, r["stripe"], r["hot"], r["first"]): r for r in right.to_pylist()}
        for row in left.to_pylist():
            s = Slice.of(row, model)
            known = np.zeros(len(s.hashed) + 1, np.int64)
            for stripe, at in word_stripes(s.hashed, stripes[0]):
                known[at] = unpacked(told[True, stripe, None, None]["c"], "<i8")
            known[-1] = ends  # the local number of an end is -1
            pairs = Pairs(s, hot, stripes[1])
            c, n, rest = (np.zeros(len(pairs.word), k) for k in (np.int64, np.int64, np.float64))
            for stripe, name, at, starts in pairs.dealt():
                first = None if name is None else int(pairs.cell[at[0]].astype(np.int32))
                found = told[False, stripe, name, first]
                sizes = np.diff(np.append(starts, len(at)))
                c[at] = unpacked(found["c"], "<i8")
                n[at] = np.repeat(unpacked(found["n"], "<i8"), sizes) if name is None else totals[name][0]
                rest[at] = np.repeat(unpacked(found["rest"], "<f8"), sizes) if name is None else totals[name][1]
            log10 = model.log10(s.target, s.features, known[s.local])
            share = (known[pairs.word] + 0.5) / prior.rare_mass
            log10[pairs.at] += np.log10(factors(c, n, rest, share))[pairs.pair]
            first, known = offsets_of(s.counts + 1)[:-1], known[s.local]
            out.append(pa.table({
                "doc_id": pa.array(s.ids, pa.int64()), "held_out": pa.array([not is_training(i) for i in s.ids]),
                "n_tokens": s.counts + 1, "n_known": np.add.reduceat((known > 0).astype(np.int64), first),
                "train_tokens": np.full(len(s.ids), prior.tokens, np.int64),
                "base_score": np.add.reduceat(np.log10(known + 0.5) - bottom, first),
                "score": np.add.reduceat(log10, first)}))
        return pa.concat_tables(out)

    return parts.select("chunk", "doc_ids", "counts", "codes", "words").groupBy("chunk").cogroup(
        answers.groupBy("chunk")).applyInArrow(run, SCORES)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                    slice_bytes: int = SLICE, hot: int = HOT) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, token counts, ``base_score`` and ``score``.

    Learns from the rows whose id's crc32 modulo 5 is not 1 and scores all. Tokens are the words
    (runs without ASCII white space, A-Z lower-cased) and the end of the text, so null and empty
    texts have one token. Every row counts, repeated ones too; a null id falls into the fold of an
    empty text. A text longer than ``slice_bytes`` is a slice of its own. Without training rows the
    base score is 0 per token and the model knows no words. An empty table gives no rows; other
    columns are ignored.
    """
    source = texts_of(docs, id_col, text_col).withColumn("train", fold(F.col("doc_id"), 5) != 1)
    parts = staged(read_slices(source, rounds, slice_bytes), "lm-slices", by=("round",))
    asked, spoken = parts.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.aggregate(
        "counts", F.lit(0).cast("bigint"), lambda a, b: a + b)), F.lit(0))).first()
    ends = source.filter("train").count()
    stripes = tuple(max(tasks_for(parts), int(x) // GROUP + 1) for x in (asked, spoken))
    words = staged(count_words(parts, stripes[0], hot), "lm-counts")
    summary = words.filter("chunk is null")
    total, types = summary.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    top = [tuple(r) for r in summary.select(F.inline("top")).orderBy(F.desc("c"), "word").limit(VOCABULARY).collect()]
    often = [tuple(r) for r in summary.select(F.inline("hot")).collect()]  # at most one per ``hot`` training tokens
    parts_of = {int(h): 1 + 2 * c // hot for h, (_, c) in zip(hashes_of([w for w, _ in often]), often)}
    if ends > hot:
        parts_of[int(BLANK)] = 1 + 2 * ends // hot
    prior = Prior.of(top, total + ends, types + (ends > 0), ends)
    weights = Model.zeros()
    for number in range(rounds):
        weights = learn_round(parts.filter(F.col("round") == number), prior, weights)
    pairs = staged(count_pairs(parts, prior, parts_of, stripes[1]), "lm-pairs")
    totals = hot_totals(pairs) if parts_of else {}
    none = {"hot": F.lit(None).cast("bigint"), "first": F.lit(None).cast("int"), "n": F.lit(None).cast("binary"),
            "rest": F.lit(None).cast("binary")}
    names = ["chunk", "stripe", "hot", "first", "c", "n", "rest"]
    answers = words.withColumns(none).select(names).unionByName(pairs.select(names)).filter("chunk is not null")
    return score_slices(parts, answers, prior, weights, parts_of, totals, ends, stripes)
