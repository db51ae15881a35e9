"""Encoding, token files and packing against the tokenizers library and plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewater.llm.bpe_automaton import AutomatonEncoder, encode_documents, encoding_digests
from tidewater.llm.packing import pack, pack_documents, sum_of_squares
from tidewater.llm.text import PieceCache, WordEncoder
from tidewater.llm.token_files import SequenceFile, read_token_files, write_token_files

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  a  b\n\nc ", "It's they'll DON'T 'S", "é́ é ﬁ ı İstanbul ΣΑΣ", "x\x1cy\x85z\xa0w　q",
    "a<|endoftext|>b <|startoftext|> <|endoftext|>", "123 45a6 $5.00 ''' 'll", "日本語 한국어 👩‍👧", "\x0b\x0c\r\n",
    "A" * 300 + "!!!...???" + "b" * 50, "don´t “quote” …", "\0a \0\0b", "aaaaaaaaaaaaaaa aaaa aa a", "word ", " lead",
    "a\n b \nc", "ababab" * 40, "ÀÉÎ Öß × ÷ ÿ",
]


def texts():
    random.seed(5)
    letters = "abcdeérnt ingthß.,\n'1 2"
    return ODD + ["".join(random.choice(letters) for _ in range(random.randint(1, 70))) for _ in range(400)]


@pytest.mark.parametrize("encoder, path", [(AutomatonEncoder, BYTES), (WordEncoder, WORDS)])
def test_encoders_match_the_library(encoder, path):
    library, sample = Tokenizer.from_file(path), texts()
    ids, ends = encoder(path)(pa.array(sample))
    for i, text in enumerate(sample):
        assert ids[ends[i]:ends[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_decoding_matches_the_library():
    library, sample = Tokenizer.from_file(BYTES), texts()
    encoder = AutomatonEncoder(BYTES)
    rng = random.Random(3)
    for ids in [[rng.randrange(50257) for _ in range(30)] for _ in range(200)]:
        assert encoder.decode(np.array(ids)).decode() == library.decode(ids, skip_special_tokens=False)
        assert encoder.automaton.decode(ids) == encoder.decode(np.array(ids))
    ids, ends = encoder(pa.array(sample))
    assert [encoder.decode(ids[a:b]).decode() for a, b in zip(ends[:-1], ends[1:])] == sample


def test_full_cache_keeps_results_right():
    cache = PieceCache(lambda pieces: ([len(p) for p in pieces], [1] * len(pieces)), limit=5)
    for words in (["a", "bb", "ccc"], ["bb", "dddd", "eeeee", "ffffff"], ["a", "bb", "a"]):
        at = cache.lookup(pa.array(words))
        assert [cache.ids[cache.starts[i]] for i in at] == [len(w) for w in words]


def odd_documents(spark):
    rows = [(i, t, "shadow", -1) for i, t in enumerate(texts())]
    rows += [(7, ODD[2], "shadow", -1), (7, ODD[2], "shadow", -1), (None, "no id", None, None), (900, None, None, None)]
    rows += [(901, "long word text. " * 20_000, "x", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, start int").repartition(5)


def test_encoding_digests(spark):
    library, docs = Tokenizer.from_file(BYTES), odd_documents(spark)
    found = sorted(map(tuple, encoding_digests(docs, BYTES).collect()), key=repr)
    want = []
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((row.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert found == sorted(want, key=repr)
    assert encode_documents(docs.filter("doc_id = 3"), BYTES).first().decoded == ODD[3]
    assert encoding_digests(docs.limit(0), BYTES).collect() == []


def test_token_files(spark, tmp_path):
    library, docs = Tokenizer.from_file(WORDS), odd_documents(spark)
    manifest = write_token_files(docs, WORDS, end_id=2, path=str(tmp_path), length=64, rows=8)
    found = sorted(map(tuple, read_token_files(manifest).collect()), key=lambda r: r[1])
    stream = []
    for row in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        stream.append((row.doc_id, library.encode(row.text or "", add_special_tokens=False).ids + [2]))
    start = 0
    for (doc_id, at, n, crc), (want_id, ids) in zip(found, stream, strict=True):
        assert (doc_id, at, n) == (want_id, start, len(ids))
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += n
    first = manifest.orderBy("part").first()
    file = SequenceFile(first.tokens)
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 64
    everything = file.ids(0, first.n_tokens)
    assert np.array_equal(file.ids(30, 100), everything[30:130])
    assert read_token_files(write_token_files(docs.limit(0), WORDS, 2, str(tmp_path / "none"))).collect() == []


def test_sum_of_squares_against_a_plain_loop():
    rng = np.random.default_rng(2)
    for capacity in (10, 33):
        lengths = rng.integers(1, capacity + 1, 400)
        sequence, offset = sum_of_squares(lengths, capacity)
        gaps = []
        for s, at, place in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
            def squares(changed):
                open_gaps = [g for g in changed if 0 < g < capacity]
                return sum(open_gaps.count(g) ** 2 for g in set(open_gaps))
            options = {g: squares([*gaps[:i], g - s, *gaps[i + 1:]]) for i, g in enumerate(gaps) if g >= s}
            options[capacity] = min(options.get(capacity, 1 << 40), squares([*gaps, capacity - s]))
            taken = capacity - place
            assert options[taken] == min(options.values())
            if at == len(gaps):
                gaps.append(capacity)
            assert gaps[at] == taken
            gaps[at] -= s


def test_packing(spark):
    library, docs = Tokenizer.from_file(WORDS), odd_documents(spark)
    rows = pack_documents(docs, WORDS, end_id=1, capacity=256).collect()
    want = {}
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [1]
        for p in range(-(-len(ids) // 256)):
            part = ids[p * 256:(p + 1) * 256]
            key = (row.doc_id, p, p * 256, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    found = {}
    by_sequence = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        found[key] = found.get(key, 0) + 1
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert found == want
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by_sequence) <= sum(r.length for r in rows) / 256 * 1.05 + 2
    assert pack_documents(docs.limit(0), WORDS).collect() == []


def test_equal_pieces_spread_over_groups(spark):
    pieces = spark.range(2000).selectExpr(
        "cast(null as bigint) doc_id", "0 piece", "0L start", "case when id % 10 = 0 then 16L else 5L end length", "7L ids_crc32")
    found = pack(pieces.repartition(4), capacity=16, group_pieces=100).collect()
    full = [r for r in found if r.length == 16]
    assert len(full) == 200 and len({r.sequence_id for r in full}) == 200 and all(r.offset == 0 for r in full)
    groups = {r.sequence_id >> 32 for r in found if r.length == 5}
    assert len(groups) == 18 and min(groups) >= 0
    taken = [(r.sequence_id, r.offset) for r in found]
    assert len(taken) == len(set(taken)) == 2000


def test_files_split_rows_that_share_an_id(spark, tmp_path):
    rows = [(None, "the same words again")] * 3000 + [(7, f"text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins tables as small as this
    try:
        manifest = write_token_files(docs, WORDS, end_id=2, path=str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [r.n_docs for r in manifest.collect()]
    assert sum(files) == 3500 and max(files) < 2000
    found = sorted(map(tuple, read_token_files(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None] * 3000 + [7] * 500
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:]))
