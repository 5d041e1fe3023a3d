"""Exact and near duplicates against brute force, and their edge cases."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL, explained, rows
from tidemark.llm import components, exact_dedup, minhash_dedup, queries, shingles

LONG = "word " * 60_000


def frame(spark, data, schema="doc_id long, text string"):
    return spark.createDataFrame(data, schema)


def by_hand(data):
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0]))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(body.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=repr)


MIXED = [(1, "a b"), (2, "ab"), (3, " a\tb "), (4, None), (5, ""), (6, " \n"), (7, LONG), (8, LONG.replace(" ", "\n")), (9, "é x"), (10, "éx "), (-3, "éx ")]


def test_exact_duplicates(spark):
    assert rows(exact_dedup.exact_duplicates(frame(spark, MIXED))) == by_hand(MIXED)


def test_exact_on_colliding_digests(spark):
    short = lambda text: F.substring(F.sha2(text, 256), 1, 1)  # noqa: E731 - 16 digests for all texts
    data = [(k, f"t{k % 40}") for k in range(200)]
    got = exact_dedup.exact_duplicates(frame(spark, data), digest=short)
    assert rows(got.drop("text_sha256")) == sorted((r[:4] for r in by_hand(data)), key=repr)
    assert exact_dedup.keep_one(frame(spark, data), digest=short).count() == 40


def test_exact_repeated_rows_and_null_ids(spark):
    data = [(1, "x"), (1, "x"), (1, "y"), (None, "x"), (None, "z"), (None, "z")]
    got = exact_dedup.exact_duplicates(frame(spark, data))
    kept = [(r["doc_id"], r["group_size"]) for r in got.where("kept").collect()]
    assert sorted(kept, key=repr) == [(1, 1), (1, 3), (None, 2)]
    assert rows(exact_dedup.keep_one(frame(spark, data)).select("doc_id", "text")) == [(1, "x"), (1, "y"), (None, "z")]


def test_exact_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a", "k1", 5, 9), (2, "a ", "k2", 6, 8)], "doc_id long, text string, keep_id string, _digest int, kept int")
    assert rows(exact_dedup.keep_one(df)) == [(2, "a ", "k2", 6, 8)]
    assert exact_dedup.keep_one(df).columns == df.columns


def test_exact_empty_table(spark):
    empty = frame(spark, [])
    assert rows(exact_dedup.exact_duplicates(empty)) == [] and rows(exact_dedup.keep_one(empty)) == []


def test_exact_stays_native_and_combines_before_the_exchange(spark):
    plan = explained(exact_dedup.text_classes(spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert "Python" not in plan and "Arrow" not in plan and "partial_max" in plan and "SortAggregate" not in plan


def shingle_set(text, width):
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def linked_by_hand(data, width, percent):
    sets = [(d, shingle_set(t, width)) for d, t in data]
    parent = {d: d for d, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[:k]:
            both = len(sa & sb)
            if sa and sb and 100 * both >= percent * (len(sa) + len(sb) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return sorted(((d, len(s), top(d), d == top(d)) for d, s in sets), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_of_the_table(spark, width, percent):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = rows(minhash_dedup.near_duplicates(docs, width=width, percent=percent))
    assert got == linked_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], width, percent)


def family(n, size, seed):
    """Texts around the threshold: each changes some words of one base text."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(size)]
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.choice(size, rng.integers(0, 7), replace=False):
            words[at] = f"x{k}_{at}" if rng.random() < 0.5 else f"y{at}"
        out.append((k, " ".join(words)))
    return out


def test_near_duplicates_of_a_large_family(spark):
    data = family(150, 120, 3) + [(1000 + k, f"{' '.join(f'p{j}' for j in range(40))} {' '.join(f'q{k}_{j}' for j in range(60))}") for k in range(100)]
    assert rows(minhash_dedup.near_duplicates(frame(spark, data))) == linked_by_hand(data, 3, 85)


def test_near_edge_cases(spark):
    data = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, LONG), (8, LONG + "word"), (9, "É a b"), (10, "é a b")]
    got = rows(minhash_dedup.near_duplicates(frame(spark, data)))
    assert got == linked_by_hand(data, 3, 85)
    twice = rows(minhash_dedup.near_duplicates(frame(spark, [(5, "a b c"), (5, "d e f"), (2, "d e f"), (None, "a b c"), (9, "a b c")])))
    assert twice == sorted([(5, 1, 2, False), (5, 1, 2, False), (2, 1, 2, True), (None, 1, None, True), (9, 1, 2, False)], key=repr)
    assert rows(minhash_dedup.near_duplicates(frame(spark, []))) == []


def test_near_texts_of_one_id(spark):
    """Every text of an id finds its near copies, whichever class the id names."""
    texts = {c: " ".join(f"{c}{k}" for k in range(60)) for c in "abcdef"}
    data = [(5, t) for t in texts.values()] + [(20 + k, f"{t} more") for k, t in enumerate(texts.values())] + [(90, "other " + texts["c"] + " x y z u v w q r s t")]
    got = rows(minhash_dedup.near_duplicates(frame(spark, data)))
    assert got == linked_by_hand(data, 3, 85) and sum(r[2] == 5 for r in got) >= 12


def test_near_keep_one_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1, "x"), (2, "a b c d e f", 2, "y"), (3, None, 3, "z")], "doc_id long, text string, _gone int, component_id string")
    got = minhash_dedup.keep_one(df, width=5, percent=80)
    assert got.columns == df.columns and rows(got) == [(1, "a b c d e f", 1, "x"), (3, None, 3, "z")]


def test_tensored_minima(spark):
    """Only 2 * halves * rows minima are taken for halves ** 2 tables."""
    keys = minhash_dedup.half_keys([np.arange(50, dtype=np.uint64), np.empty(0, np.uint64)], 10, 2)
    assert keys.shape == (2, 20)
    df = spark.createDataFrame([(1, [1, 2, 3], [4, 5, 6])], "id long, first array<long>, second array<long>")
    assert minhash_dedup._table_keys(df).distinct().count() == 9


@given(st.lists(st.one_of(st.none(), st.text("ab \t\n\x0b\x1fÄ", max_size=30)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_shingles_are_the_sets(texts):
    got = shingles.shingle_sets(pa.array(texts, pa.string()), 3)
    want = [shingle_set(t, 3) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for k in range(len(texts)):
        for j in range(k):
            assert len(np.intersect1d(got[k], got[j])) == len(want[k] & want[j])


def test_shingles_across_blocks_and_portions(monkeypatch):
    words = [f"w{k}" for k in range(30_000)] + ["z" * 200_000, "end"]
    text = " ".join(words)
    [alone] = shingles.shingle_sets(pa.array([text]), 3)
    monkeypatch.setattr(shingles, "PORTION", 1000)
    moved = shingles.shingle_sets(pa.array(["a b c", "  " + text.replace(" ", "\n\n"), None, "a b c"]), 3)
    assert len(alone) == len(words) - 2 and (moved[1] == alone).all() and (moved[0] == moved[3]).all() and not len(moved[2])


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 1), (200, 201), (201, 200)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert rows(components.components(spark.createDataFrame([], "a long, b long"))) == []


def test_query_reads_whole_table(spark):
    assert queries.op10_minhash_near_dedup(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
