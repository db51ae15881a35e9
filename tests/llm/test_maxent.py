"""Counts and base scores against a loop, probabilities that sum to one, and gain on held-out text."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from compare import DATA
from tidewater.llm import maxent as M
from tidewater.llm.queries import op8_maxent_scoring

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANKS:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def test_counts_and_base(spark):
    rows = [(i, "The cat\nsat " + "on the mat " * (i % 4) + ("É" if i % 3 else "")) for i in range(60)]
    rows += [(70, None), (71, ""), (72, " \t "), (73, "word " * 30_000), (5, rows[5][1]), (None, "the cat")]
    docs = spark.createDataFrame([(i, t, "shadow", 1) for i, t in rows], "doc_id long, text string, words string, round int")
    counts, texts = Counter(), 0
    def trains(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1
    for i, t in rows:
        if trains(i):
            counts.update(words_of(t))
            counts["\0end"] += 1
    total, types = sum(counts.values()), len(counts)
    found = sorted(map(tuple, M.score_documents(docs.repartition(3)).collect()), key=repr)
    want = []
    for i, t in rows:
        tokens = [*words_of(t), "\0end"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in tokens)
        want.append((i, not trains(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    for row, expected in zip(found, sorted(want, key=repr), strict=True):
        assert row[:5] == expected[:5] and row[5] == pytest.approx(expected[5]) and row[6] < 0
    assert M.score_documents(docs.limit(0)).collect() == []
    nothing = M.score_documents(docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")).collect()
    assert nothing and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in nothing)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    top = [(f"w{i}", 50 - i) for i in range(40)]
    prior = M.Prior.of(top, tokens=2000, types=101, ends=30)
    classes, members = M.Model.zeros()
    classes += rng.normal(0, 0.3, classes.shape).astype(np.float32)
    members += rng.normal(0, 0.3, members.shape).astype(np.float32)
    model = M.Model(prior, classes, members)
    features = np.repeat(rng.integers(0, 1 << 63, (1, 4)).astype(np.uint64), 42, axis=0)
    target = np.array([*range(41), -1])
    # Rare words: 60 known types with all remaining counts, and one unknown type.
    rest = 2000 - 30 - sum(c for _, c in top)
    log10 = model.log10(target, features, np.zeros(42))
    rare = 10 ** log10[-1] / 0.5 * (rest + 0.5 * 61)
    assert (10 ** log10[:-1]).sum() + rare == pytest.approx(1, abs=1e-4)
    plain = M.Model(prior, *M.Model.zeros())
    base = [(c + 0.5) / (2000 + 0.5 * 102) for c in [30, *(c for _, c in top), 7]]
    assert np.allclose(10 ** plain.log10(target, features, np.full(42, 7)), base, rtol=1e-4)


def test_run_sums():
    rng = np.random.default_rng(4)
    lengths = np.array([1, 2, 1, M.LONG_RUN, M.LONG_RUN + 1, 3, 700, 1])
    values = rng.normal(size=(lengths.sum(), 5)).astype(np.float32)
    first = np.cumsum(lengths) - lengths
    want = [values[a:a + n].sum(axis=0) for a, n in zip(first, lengths)]
    assert np.allclose(M.run_sums(values, first), want, atol=1e-4)
    assert np.allclose(M.run_sums(values[:1], np.array([0])), values[:1])


def test_learning_follows_the_gradient():
    rng = np.random.default_rng(7)
    prior = M.Prior.of([("a", 100), ("b", 100), ("c", 100)], tokens=400, types=4, ends=100)
    model = M.Model(prior, *M.Model.zeros())
    codes = np.tile([0, 1, 2], 2000)
    target, _, features = model.tokens(["a", "b", "c"], codes, np.array([len(codes)]))
    before = model.log10(target, features, np.zeros(len(target))).mean()
    for _ in range(20):
        order = rng.permutation(len(target))
        model.learn(target[order], features[order])
    assert model.log10(target, features, np.zeros(len(target))).mean() > before / 3


def test_better_than_base_on_held_out_text(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    found = M.score_documents(docs).filter("held_out").toPandas()
    assert found.score.sum() / found.n_tokens.sum() > found.base_score.sum() / found.n_tokens.sum() + 0.25


def test_query_keeps_all_rows(tables):
    assert op8_maxent_scoring(tables).count() == tables.documents.count()


def pair_scores(rows, trains):
    """Per row the score of a model without gradient steps: prior shares and pair features, by loops."""
    counts, texts = Counter(), [words_of(t) for _, t in rows]
    for (i, _), words in zip(rows, texts):
        if trains(i):
            counts.update(words)
    ends = sum(trains(i) for i, _ in rows)
    tokens, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    top = {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:M.VOCABULARY]}
    pairs, context = Counter(), Counter()
    for (i, _), words in zip(rows, texts):
        for before, word in zip([None, *words], words):
            if word not in top and trains(i):
                pairs[before, word] += 1
                context[before] += 1
    taken = Counter()
    for (before, _), c in pairs.items():
        taken[before] += c - M.DISCOUNT if c >= M.PAIR_MIN else 0
    unknown = 0.5 + sum(c + 0.5 for w, c in counts.items() if w not in top)
    for words in texts:
        score = math.log10((ends + 0.5) / (tokens + 0.5 * (types + 1)))
        for before, word in zip([None, *words], words):
            share = (counts[word] + 0.5) / (tokens + 0.5 * (types + 1))
            if word not in top:
                c, n = pairs[before, word], context[before]
                inside = (counts[word] + 0.5) / unknown
                gain = (c - M.DISCOUNT if c >= M.PAIR_MIN else 0) + (n - taken[before] + M.EXTRA) * inside
                share *= gain / (n + M.EXTRA) / inside
            score += math.log10(share)
        yield score


@pytest.mark.parametrize("slice_bytes,hot", [(M.SLICE, M.HOT), (4000, M.HOT), (4000, 60)])
def test_pairs_equal_loops(spark, slice_bytes, hot):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(4000)]
    rows = [(int(i), " ".join(words[min(int(k), 3999)] for k in rng.zipf(1.2, 60) - 1)) for i in rng.permutation(900)]
    # One text again and again, a hot context with many followers, and odd texts.
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    rows += [(2000 + i, " ".join(f"the q{(7 * i + k) % 90}" for k in range(20))) for i in range(60)]
    rows += [(5000, None), (5001, ""), (5002, " \t"), (5003, "the q1 " * 3000), (None, "the q1"), (5003, "the q1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(((r.doc_id, r.n_tokens, r.score) for r in M.score_documents(docs, rounds=0, slice_bytes=slice_bytes, hot=hot).collect()), key=repr)
    trains = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1
    want = sorted(((i, len(words_of(t)) + 1, s) for (i, t), s in zip(rows, pair_scores(rows, trains))), key=repr)
    for f, w in zip(found, want, strict=True):
        assert f[:2] == w[:2] and f[2] == pytest.approx(w[2], rel=1e-4)


def test_pair_shares_sum_to_one():
    prior = np.array([0.5, 0.3, 0.15, 0.05])
    c, n = np.array([4, 2, 0, 0]), 9
    rest = n - np.maximum(c - M.DISCOUNT, 0).sum()
    assert (prior * M.factors(c, n, rest, prior)).sum() == pytest.approx(1)


def test_rare_words_follow_their_context(spark):
    rng = np.random.default_rng(5)
    pairs = 300
    rows = [" ".join(f"f{j}" for j in range(1100))] * 30
    rows += [f"x{i} y{i}" for i in range(pairs) for _ in range(20)]
    learn = [(next(k for k in range(20 * i, 20 * i + 20) if zlib.crc32(b"%d" % k) % 5 != 1), t)
             for i, t in enumerate(rng.permutation(rows).tolist())]
    apart = [k for k in range(10 ** 8, 10 ** 8 + 20_000) if zlib.crc32(b"%d" % k) % 5 == 1][:2 * pairs]
    asked = [(apart[i], f"x{i} y{i}") for i in range(pairs)]
    asked += [(apart[pairs + i], f"x{i} y{(i + 7) % pairs}") for i in range(pairs)]
    docs = spark.createDataFrame([*learn, *asked], "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.score for r in M.score_documents(docs).filter("held_out").collect()}
    right = np.mean([found[k] for k in apart[:pairs]])
    wrong = np.mean([found[k] for k in apart[pairs:]])
    assert right > wrong + 0.1
