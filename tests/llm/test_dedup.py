"""Line and exact dedup against plain loops."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from tidewater.llm.exact_dedup import KEY_BITS, Buckets, Entry, build_index, exact_groups, index_entries, local_groups
from tidewater.llm.line_dedup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"


def line_rows():
    random.seed(4)
    common = ["This line stands in many documents", "  THIS line stands in many documents\t", "short", "",
              "Ünïcode LINE ÀÉ with more than twenty", "ünïcode line àé with more than twenty", "x" * 19, "X" * 20,
              "ends in a line mark  ", "carriage return at the end of it\r", " \x0b" + "y" * 20]
    rows = [(i, "\n".join(random.choice(common) for _ in range(random.randint(1, 8)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, "\n".join(["only here, only here, only here"] * 500)),
             (44, common[0]), (5, "\n".join(common[:4])), (44, common[0]), (44, common[0])]
    return rows


def test_lines(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, "shadow", 1) for i, t in rows], "doc_id long, text string, pos string, gone int")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(BLANKS).translate(low)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not ((k := x.strip(BLANKS).translate(low)) in holders and len(holders[k]) >= 3
                                         and max(holders[k]) != i)]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert sorted(map(tuple, dedup_lines(docs).collect())) == sorted(want)
    assert dedup_lines(docs.limit(0)).collect() == []


def test_lines_without_id(spark):
    docs = spark.createDataFrame([(None, "a line of more than twenty"), (1, "a line of more than twenty"),
                                  (2, "A line of more than twenty ")], "doc_id long, text string")
    assert sorted(map(tuple, dedup_lines(docs).collect()), key=repr) == [
        (1, 1, 1, ""), (2, 1, 0, "A line of more than twenty "), (None, 1, 1, "")]


def test_exact_groups(spark):
    random.seed(9)
    rows = [(i, random.choice(["ab c", "a b c", "abc", " a\tb\nc\r", "", " ", None, "ABC", "é", "a bc", "x" * 50_000])
             ) for i in range(300)]
    rows += [(500, "unique"), (501, "twin  "), (502, "  twin"), (None, "nameless"), (503, "namele ss")]
    docs = spark.createDataFrame([(i, t, "shadow", b"x") for i, t in rows],
                                 "doc_id long, text string, digest string, prefix binary").repartition(7)
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(str.maketrans("", "", BLANKS)), []).append((i, t or ""))
    want = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is not None, m[0] or 0))[0]
        want += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest(), len(t)) for i, t in members]
    for bucket_bytes in (16 << 20, 40):
        found = sorted(map(tuple, exact_groups(docs, bucket_bytes).collect()), key=repr)
        assert found == sorted(want, key=repr)
    assert exact_groups(docs.limit(0)).collect() == []


def test_one_row_of_each_text_is_kept(spark):
    def found(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(((r.doc_id, r.chars, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs).collect()), key=repr)

    assert found([(1, "a b"), (1, "ab"), (2, "ab")]) == [(1, 2, 1, 3, False), (1, 3, 1, 3, True), (2, 2, 1, 3, False)]
    assert found([(None, "ab"), (None, "a b"), (3, "ab ")]) == sorted(
        [(None, 2, None, 3, False), (None, 3, None, 3, True), (3, 3, None, 3, False)], key=repr)
    twice = found([(1, "a b"), (1, "a b"), (2, "ab")])
    assert [r[:4] for r in twice] == [(1, 3, 1, 3), (1, 3, 1, 3), (2, 2, 1, 3)] and sum(r[4] for r in twice) == 1


def test_buckets_split_and_the_directory_doubles():
    rng = np.random.default_rng(1)
    keys = np.sort(np.concatenate([rng.integers(0, 1 << KEY_BITS, 300), np.full(40, 12345), rng.integers(1 << 30, (1 << 30) + 50, 60)]))
    for first_depth in (0, 2, 5):
        written = []
        buckets = Buckets(100, first_depth, lambda prefix, depth, entries: written.append((prefix, depth, entries)))
        for i, key in enumerate(keys.tolist()):
            buckets.insert(Entry(key, b"", i, b"x" * 10, []))
        buckets.close()
        # Every entry once, in the bucket of its prefix; buckets do not overlap; only one key may overfill one.
        assert [e.chain for _, _, entries in written for e in entries] == list(range(len(keys)))
        ends = -1
        for prefix, depth, entries in written:
            assert all(e.key >> (KEY_BITS - depth) == prefix for e in entries)
            assert prefix << (KEY_BITS - depth) > ends
            ends = ((prefix + 1) << (KEY_BITS - depth)) - 1
            assert len(entries) <= 10 or len({e.key for e in entries}) == 1
        assert max(depth for _, depth, _ in written) == buckets.depth > first_depth


def test_membership_comes_from_the_bucket_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i % 90}") for i in range(400)], "doc_id long, text string").repartition(3)
    local = local_groups(docs.select("doc_id", "text")).cache()
    directory = build_index(local, f"{tmp_path}/index", capacity=200)
    rows = directory.collect()
    assert len(rows) > 20 and sum(r["entries"] for r in rows) == 90
    assert all(r["bytes"] <= 200 for r in rows) and len({(r["prefix"], r["depth"]) for r in rows}) == len(rows)
    entries = index_entries(directory).collect()
    assert sorted(r["grp"] for r in entries) == sorted(r["grp"] for r in local.collect())
    assert len({(bytes(r["digest"]), r["chain"]) for r in entries}) == 90
    local.unpersist()
