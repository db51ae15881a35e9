"""N-gram join and top-k search against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import ngram_join as N
from tidewater.llm import topk as K
from tidewater.llm.components import connected_components

BLANKS = " \t\n\x0b\x0c\r"


def gram_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANKS:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Class, links and set links per id, for unique ids."""
    sets = {i: frozenset(gram_set(t)) for i, t in rows}
    linked = {i: {j for j in sets if j != i and sets[i] and sets[j]
                  and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9} for i in sets}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            low = min([label[i], *(label[j] for j in linked[i])])
            changed |= low != label[i]
            label[i] = low
    return sorted((i, label[i], len(linked[i]), len({sets[j] for j in linked[i]} - {sets[i]})) for i in sets)


def near_copies(seed=6):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(12):
        base = [random.choice(vocabulary) for _ in range(random.choice([30, 80, 200]))]
        for _ in range(random.choice([1, 2, 6, 40])):
            words = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 3])):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            words += random.choices(vocabulary, k=random.choice([0, 0, 5]))
            rows.append(" ".join(words) if random.random() < 0.8 else "  ".join(w.upper() for w in words) + "\n")
    rows += ["", " \n", None, "one", "One ", "one two three four", "one two three four", "a b c d e", "A b c d e"]
    return list(enumerate(rows, start=10))


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = N.choose_bands(threshold)
        assert 1 - (1 - threshold ** rows) ** bands >= N.RECALL and bands * rows <= N.MAX_HASHES


def test_shingles_are_the_sets():
    texts = [t or "" for _, t in near_copies()] + ["  lead and trail  ", "x", "a a a a a a a a"]
    grams, ends = N.shingles(pa.array(texts), 5)
    assert np.diff(ends).tolist() == [len(gram_set(t)) for t in texts]
    assert N.shingles(pa.array(["", " "]), 5)[1].tolist() == [0, 0, 0]


def test_near_duplicates_against_all_pairs(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(i, t, "shadow", 1) for i, t in rows],
                                 "doc_id long, text string, class_id string, comp int").repartition(5)
    for block in (512, 4):
        found = sorted(map(tuple, N.near_duplicates(docs, block=block).collect()))
        assert found == brute(rows)


def test_blocks_are_bounded_in_ngrams(spark):
    random.seed(9)
    base = [f"w{random.randrange(5000)}" for _ in range(3000)]
    rows = near_copies()[:40]
    for i in range(12):
        words = list(base)
        for _ in range(i * 20):
            words[random.randrange(len(words))] = f"x{random.randrange(5000)}"
        rows.append((1000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert sorted(map(tuple, N.near_duplicates(docs, block_grams=4000).collect())) == want


def test_near_duplicates_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)],
                                 "doc_id long, text string")
    found = sorted(map(tuple, N.near_duplicates(docs).collect()), key=repr)
    assert found == sorted([(1, None, 1, 0), (1, None, 1, 0), (None, None, 1, 0), (2, 2, 0, 0)], key=repr)
    assert N.near_duplicates(docs.limit(0)).collect() == []


def test_rows_that_share_an_id_take_part_with_their_own_texts(spark):
    texts = near_copies()
    ids = [None if i % 3 == 0 else 5 if i % 3 == 1 else i for i, _ in texts]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in zip(ids, texts)], "doc_id long, text string").repartition(5)
    # Rows with the same id and text are one document.
    members = {(i is not None, i or 0, t or ""): n for n, (i, (_, t)) in enumerate(zip(ids, texts))}
    owner = {n: k[1] if k[0] else None for k, n in members.items()}
    found = brute([(n, k[2]) for k, n in members.items()])
    smallest = {}
    for n, label, _, _ in found:
        smallest.setdefault(label, []).append((owner[n] is not None, owner[n] or 0))
    want = {n: (owner[n], min(smallest[label])[1] if min(smallest[label])[0] else None, links, sets)
            for n, label, links, sets in found}
    rows = [want[members[i is not None, i or 0, t or ""]] for i, (_, t) in zip(ids, texts)]
    assert sorted(map(tuple, N.near_duplicates(docs).collect()), key=repr) == sorted(rows, key=repr)
    assert len({label for _, label, _, _ in found}) == N.near_classes(docs).filter("first").select(
        "doc_id", "text_hash").distinct().count()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (101, 90), (90, 102), (7, 7)]
    random.seed(1)
    random.shuffle(chain)
    edges = spark.createDataFrame(chain, "a long, b long")
    found = dict(map(tuple, connected_components(edges).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{i: 90 for i in (90, 100, 101, 102)}}


def test_index_is_exact():
    rng = np.random.default_rng(4)
    for n, dims, spread in ((1, 3, 5), (300, 8, 400), (900, 16, 3), (500, 4, 0)):
        vectors = rng.integers(-spread, spread + 1, (n, dims))
        index = K.ImpactIndex(vectors)
        for query in rng.integers(-spread, spread + 1, (20, dims)):
            barred = rng.choice(n, n // 10, replace=False)
            rows, scores = index.search(query, 10, barred)
            exact = (vectors @ query).astype(float)
            exact[barred] = -np.inf
            assert (scores == exact[rows]).all() and not set(rows) & set(barred)
            best = np.sort(exact)[::-1][:min(10, n - len(barred))]
            assert (np.sort(scores)[::-1][:10] == best).all()
            missed = np.setdiff1d(np.arange(n), rows)
            assert not len(best) or (exact[missed] < best[-1]).all()


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 0.2, 6).tolist(), "s") for i in range(500)]
    rows += [(i, rows[3][1], "s") for i in range(1000, 1040)]
    rows += [(100, [0.5] * 6, "s"), (700, None, "s"), (701, [None, 1.0], "s"), (800, [float("nan")] * 6, "s"),
             (900, [float("inf")] * 6, "s"), (None, [0.1] * 6, "s"), (1100, [0.25, 0.5], "s"), (1201, [1.0, -1.0], "s"),
             (1300, [], "s")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    good = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, q in good:
        if i % 100 == 0:
            scored = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:10]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(scored, start=1)]
    assert sorted(map(tuple, K.search_embeddings(table).collect())) == sorted(want)
    vectors = table.filter(K.usable(table.embedding)).select("vec_id", K.quantised(table.embedding).alias("v")).dropna()
    tiled = K.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10, block=50, chunk=2)
    assert sorted(map(tuple, tiled.collect())) == sorted(want)
    assert K.search_embeddings(table.limit(0)).collect() == []
    large = spark.createDataFrame([(100, [1e17, 1e17]), (101, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large for exact scores"):
        K.search_embeddings(large).collect()
