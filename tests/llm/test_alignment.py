"""Token alignment, vector codes and shards against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from tidewater.llm import kd_shards as S
from tidewater.llm import token_alignment as A
from tidewater.llm import vector_codes as V
from tidewater.llm.text import byte_letters

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None, "", " ", "  ", "a", "Hello world, hello again.", "Hello world, hello again.", " leading", "trailing ",
    "two  spaces   three", "línea única — “quotes” ﬁ ① 你好世界 すし", "你好世界没有空格的一段文字", "tabs\tand\nlines\r\n\r\n  end\n",
    "a<|endoftext|>b <s> x </s> <unk> <0x0A>", "under▁score", "nul\0byte", "it's don't I'LL we've", "12345 6,789.01",
    "é combining ​ zero", " nbsp  em", "👩‍👩‍👧 family 🇩🇪", "word " * 3000, "x" * 5000, "antidisestablishmentarianism " * 40,
]


def brute_alignment(rows):
    """Counts per row by direct use of both libraries and all overlaps of byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATH_A)
    first.encode_special_tokens = True
    first.no_truncation()
    first.no_padding()
    second = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    as_byte = {letter: byte for byte, letter in byte_letters().items()}

    def piece_bytes(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for doc_id, text in rows:
        a = b = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            a_bytes = [bytes(as_byte[c] for c in first.id_to_token(i)) for i in a]
            b_bytes = [piece_bytes(i) for i in b]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a = b = []
        if not a:
            found.append((doc_id, [], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        links, j = [], 0
        for i in range(len(a)):
            while b_ends[j] <= a_ends[i] - len(a_bytes[i]):
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_bytes[k]) < a_ends[i]:
                links.append((a[i], b[k]))
                k += 1
        groups, x, y = [], 0, 0
        for end in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
            p, q = int(np.searchsorted(a_ends, end)) + 1, int(np.searchsorted(b_ends, end)) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        found.append((doc_id, a, b, groups, links))
    counts = Counter(p for *_, links in found for p in set(links))
    highest: dict[int, int] = {}
    for (i, _), n in counts.items():
        highest[i] = max(n, highest.get(i, 0))
    return sorted((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links),
                   sum(counts[p] for p in links), ";".join(groups)) for doc_id, a, b, groups, links in found)


def aligned(df, **options):
    return sorted(tuple(r) for r in A.align_documents(df, PATH_A, PATH_B, **options).collect())


def test_alignment_equals_all_overlaps(spark):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, pairs int")
    expected = brute_alignment(rows)
    assert aligned(df) == expected
    # Without frequent pairs all counts come by the join; the result is the same.
    assert aligned(df, frequent=0) == expected
    assert aligned(df, frequent=40) == expected
    digests = sorted(tuple(r) for r in A.alignment_digests(df, PATH_A, PATH_B).collect())
    assert digests == [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in expected]


def test_alignment_of_documents(spark, tables):
    rows = [(r["doc_id"], r["text"]) for r in tables.documents.collect()]
    assert aligned(tables.documents) == brute_alignment(rows)


def test_alignment_of_odd_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert aligned(df) == []
    rows = [(None, "same text"), (None, "same text"), (7, "same text"), (7, "other text"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = A.align_documents(df, PATH_A, PATH_B).collect()
    assert Counter(r["n_links"] for r in found) == {2: 4, 0: 1}
    assert sorted(r["count_sum"] for r in found) == [0, 5, 7, 7, 7]


def test_memo_keeps_what_is_used(monkeypatch):
    import pyarrow as pa

    align = A.Aligner(PATH_A, PATH_B)
    texts = pa.array([t or "" for t in TEXTS])
    whole = align(texts)
    align.windows.limit = 5
    for i in range(len(texts)):
        one = align(texts.slice(i, 1))
        assert one["groups"][0].as_py() == whole["groups"][i].as_py()
        assert one["n_links"][0] == whole["n_links"][i]


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted((r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])
                   and len(r[1]) % parts == 0), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    matrix = np.floor(256 * np.array([r[1] for r in kept], np.float64)).astype(np.int64)
    cut = matrix.reshape(len(kept), parts, -1).transpose(1, 0, 2)
    books = [part[:entries].copy() for part in cut]
    for turn in range(rounds + 1):
        away = [((part[:, None, :] - book[None]) ** 2).sum(axis=2) for part, book in zip(cut, books)]
        near = [d.argmin(axis=1) for d in away]
        if turn < rounds:
            for part, book, code in zip(cut, books, near):
                for e in range(len(book)):
                    if (code == e).any():
                        book[e] = part[code == e].sum(axis=0) // (code == e).sum()
    error = np.sum([d.min(axis=1) for d in away], axis=0)
    labels = Counter()
    for r, e in zip(kept, error.tolist()):
        labels[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{c[i]:02x}" for c in near), int(error[i]), labels[r[2]], digest)
                   for i, r in enumerate(kept)), key=repr)


def test_orchard_finds_the_nearest_entry():
    rng = np.random.default_rng(5)
    for width, span, size in ((1, 3, 9), (2, 4, 64), (4, 60, 64), (3, 2, 40), (4, 1000, 1)):
        entries = rng.integers(-span, span + 1, (size, width))
        queries = rng.integers(-span - 2, span + 3, (3000, width))
        away = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
        index, best = V.Orchard(entries).nearest(queries)
        assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [round(float(x), 2) for x in rng.normal(0, 0.4, 32)], int(rng.integers(0, 3))) for i in range(400)]
    rows += [(i + 400, rows[i][1], None) for i in range(60)]  # repeated vectors
    rows += [(5, rows[9][1], 1), (5, rows[9][1], 1), (None, rows[3][1], 2)]
    bad = [(900, None, 1), (901, [0.1] * 31 + [float("nan")], 1), (902, [0.1] * 31 + [None], None),
           (903, [float("inf")] * 32, 0), (904, [], 0), (905, [0.5] * 31, 0)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows + bad],
                               "vec_id long, embedding array<double>, label int, codes string, length int")
    found = sorted((tuple(r) for r in V.code_digests(df.repartition(5)).collect()), key=repr)
    assert found == brute_codes(rows)


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert V.code_digests(spark.createDataFrame([], schema)).collect() == []
    two = [(1, [0.5] * 16, 1), (2, [-0.25] * 16, 1)]  # fewer rows than entries
    assert sorted((tuple(r) for r in V.code_digests(spark.createDataFrame(two, schema)).collect()),
                  key=repr) == brute_codes(two)
    mixed = spark.createDataFrame(two + [(3, [0.5] * 32, 1)], schema)  # each length has its own codebooks
    found = V.code_digests(mixed).collect()
    assert len(found) == 3 and len({r["codebooks_sha256"] for r in found}) == 2
    with pytest.raises(Exception, match="64 bits"):
        V.code_digests(spark.createDataFrame([(1, [1e9] * 16, 1)], schema)).collect()


def shards_of(df, n=None, **options):
    return [r.asDict() for r in S.kd_shards(df, shards=n, **options).collect()]


def check_places(found, shards):
    for shard in {r["shard"] for r in found}:
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in found)))


def shard_bytes(found, shards):
    totals = [0] * shards
    for r in found:
        totals[r["shard"]] += r["size"]
    return totals


def test_shards_of_documents(spark, tables):
    docs = tables.documents
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = shards_of(docs, 7)
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    check_places(found, 7)
    totals = shard_bytes(found, 7)
    assert max(totals) - min(totals) <= 2 * max(r["size"] for r in found)
    groups = {}
    for r in found:
        groups.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    small = sum(totals) / 7 * S.GROUP_SHARE
    assert all(len(s) == 1 for t, s in groups.items() if t and len(t.encode()) * 3 < small)


def test_hot_values_are_cut(spark):
    """A third of all rows are one text, another third have one length; sizes still come out near equal."""
    rows = [(i, "same words again" if i % 3 == 0 else f"text {i:08d}" if i % 3 == 1 else "x" * (i % 50), "en", None)
            for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(6)
    found = shards_of(df, 40)
    check_places(found, 40)
    totals = shard_bytes(found, 40)
    assert min(totals) > 0.97 * sum(totals) / 40 and max(totals) < 1.03 * sum(totals) / 40
    again = shards_of(df, target_bytes=sum(totals) // 10 + 1)
    assert len({r["shard"] for r in again}) == 10


def test_shards_of_odd_tables(spark):
    schema = "doc_id long, text string, lang string, n_chars long, shard int, k0 string"
    assert shards_of(spark.createDataFrame([], schema), 40) == []
    rows = [(None, None, None, None, 1, "a"), (None, None, None, None, 1, "a"), (3, "", "de", 0, 2, None),
            (3, "", "de", 0, 2, None), (4, "long " * 40_000, "en", 200_000, 1, "b")]
    found = shards_of(spark.createDataFrame(rows, schema), 3)
    check_places(found, 3)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in found) == [(-1, 16), (-1, 16), (3, 16), (3, 16), (4, 200_016)]
    equal = spark.createDataFrame([(1, "twin", "en", 4, 0, "")] * 120, schema)
    assert set(Counter(r["shard"] for r in shards_of(equal, 40)).values()) == {3}
    dims = shards_of(spark.createDataFrame(rows, schema), 4, dims=[])
    check_places(dims, 4)
    with pytest.raises(ValueError, match="either"):
        shards_of(equal)


def test_written_shards_hold_the_texts(spark, tables):
    written = S.write_shards(tables.documents, dims=["lang", "source", "n_chars"], shards=5, file_rows=20)
    found = [r.asDict() for r in written.collect()]
    check_places(found, 5)
    assert sorted((r["doc_id"], r["text"]) for r in found) == sorted(
        (r["doc_id"], r["text"] or "") for r in tables.documents.collect())
