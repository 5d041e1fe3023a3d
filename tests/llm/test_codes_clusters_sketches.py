"""Vector codes, clusters and document fingerprints against brute force, and their odd inputs."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL, explained, rows
from tidemark.llm import codebooks, pivots, queries, sketches, vectors
from tidemark.llm.shingles import shingle_sets

points = lambda n, w: st.lists(st.lists(st.integers(-3, 3), min_size=w, max_size=w), min_size=1, max_size=n)


def lloyd(x: np.ndarray, centers: np.ndarray, rounds: int):
    """Full scans; the first of equal distances wins."""
    for _ in range(rounds):
        far = ((x[:, None, :] - centers[None]) ** 2).sum(2)
        number = far.argmin(1)
        centers = np.array([x[number == k].sum(0) // (number == k).sum() if (number == k).any() else c for k, c in enumerate(centers)])
    far = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    return centers, far.argmin(1), far.min(1)


@given(points(30, 2), points(5, 2), points(5, 2), st.lists(st.booleans(), min_size=5, max_size=5))
@settings(max_examples=300, deadline=None)
def test_active_entries_give_full_scans(x, before, after, flags):
    x, before = np.array(x), np.array(before)
    after = np.array([after[k] if flags[k] and k < len(after) else list(b) for k, b in enumerate(before.tolist())])
    moved = (before != after).any(1)
    every = np.ones(len(before), bool)
    code, distance, _ = codebooks.reassign(x, before, every, None, None)
    got, far, compared = codebooks.reassign(x, after, moved, code, distance)
    full = ((x[:, None, :] - after[None]) ** 2).sum(2)
    assert (got == full.argmin(1)).all() and (far == full.min(1)).all()
    assert compared == (len(after) * moved[code].sum() + moved.sum() * (~moved[code]).sum())


@given(points(40, 3), points(8, 3), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_bounds_lose_no_centroid(x, centroids, count):
    x, centroids = np.array(x), np.array(centroids)
    fixed = pivots.farthest(centroids, count)
    to_pivots = np.stack([pivots.squared(x, p) for p in fixed], 1)
    number, best, measured = pivots.nearest(x, to_pivots, centroids, fixed)
    full = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (best == full.min(1)).all()
    assert len(x) <= measured <= full.size and len({tuple(p) for p in fixed.tolist()}) == len(fixed) <= count


def test_bounds_of_large_components():
    random = np.random.default_rng(5)
    x = random.integers(-vectors.LARGEST, vectors.LARGEST, (500, 64))
    centroids = np.concatenate([x[:20], x[:5] + 1, x[:5]])
    fixed = pivots.farthest(centroids, 6)
    number, best, _ = pivots.nearest(x, np.stack([pivots.squared(x, p) for p in fixed], 1), centroids, fixed)
    full = np.stack([pivots.squared(x, c) for c in centroids], 1)
    assert (number == full.argmin(1)).all() and (best == full.min(1)).all()


def odd_vectors(spark):
    v = [[float(i % 7) / 2, -float(i % 5), 0.25 * i, 1.0] for i in range(40)]
    given_rows = [(i, v[i], None if i % 3 == 0 else i % 2, f"r{i}", i) for i in range(40)]
    odd = [(40, None, 1, "null", 0), (41, [1.0, None, 0.0, 0.0], 1, "holds null", 0), (42, [float("nan"), 0.0, 0.0, 0.0], 1, "nan", 0),
           (43, [float("inf"), 0.0, -float("inf"), 0.0], 1, "inf", 0), (44, [1.0, 2.0], 1, "short", 0), (45, [], 1, "empty", 0), (None, [9.0, 9.0, 9.0, 9.0], 1, "no id", 0),
           (3, v[3], 1, "again", 0), (3, v[3], 1, "again", 0)]
    # Columns whose names the operators use themselves.
    return spark.createDataFrame(given_rows + odd, "vec_id long, embedding array<float>, label int, codes string, v int"), v


def test_codes_against_full_scans(spark):
    table, _ = odd_vectors(spark)
    found, books = codebooks.compress(table, parts=2, entries=5, rounds=3, scale=8)
    got = found.select("row.*", F.hex("codes").alias("hex"), "error").collect()
    kept = [r for r in table.collect() if r["embedding"] and len(r["embedding"]) == 4 and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    x = np.floor(8 * np.array([r["embedding"] for r in kept])).astype(int)
    start = x[sorted(range(len(kept)), key=lambda i: (kept[i]["vec_id"] is None, kept[i]["vec_id"] or 0, x[i].tolist()))[:5]]
    parts = [lloyd(x[:, s], start[:, s], 3) for s in (slice(0, 2), slice(2, 4))]
    assert books.books.tolist() == [p[0].tolist() for p in parts]
    want = sorted((r["codes"], "".join(f"{p[1][i]:02X}" for p in parts), int(sum(p[2][i] for p in parts))) for i, r in enumerate(kept))
    assert sorted((r["codes"], r["hex"], r["error"]) for r in got) == want and got[0]["v"] is not None
    one = next(r for r in got if r["codes"] == "r7")
    assert sum((a - b) ** 2 for a, b in zip(books.decoded(bytes.fromhex(one["hex"])), x[7].tolist(), strict=True)) == one["error"]


def test_clusters_against_full_scans(spark):
    table, _ = odd_vectors(spark)
    found, clusters = pivots.cluster(table, count=6, rounds=4, scale=8, width=4, pivots=3)
    kept = [r for r in table.collect() if r["embedding"] and len(r["embedding"]) == 4 and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    x = np.floor(8 * np.array([r["embedding"] for r in kept])).astype(int)
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    order = sorted(range(len(kept)), key=lambda i: (kept[i]["vec_id"] is None, digest(kept[i]["vec_id"]), x[i].tolist()))
    centers, number, distance = lloyd(x, x[order[:6]], 4)
    assert clusters.centroids.tolist() == centers.tolist()
    got = sorted((r["row"]["codes"], r["cluster"], r["distance"]) for r in found.collect())
    assert got == sorted((r["codes"], int(number[i]), int(distance[i])) for i, r in enumerate(kept))


def test_empty_and_few_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    found, books = codebooks.compress(empty)
    assert found.count() == 0 and found.columns == ["row", "codes", "error"] and books.books.size == 0
    found, clusters = pivots.cluster(empty)
    assert found.count() == 0 and found.columns == ["row", "cluster", "distance"] and clusters.sha256 == []
    one = spark.createDataFrame([(7, [0.5] * 64)], "vec_id long, embedding array<double>")
    assert [bytes(r["codes"]) for r in codebooks.compress(one)[0].collect()] == [bytes(8)]
    assert [(r["cluster"], r["distance"]) for r in pivots.cluster(one)[0].collect()] == [(0, 0)]
    null = spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<double>")
    assert codebooks.compress(null)[0].count() == pivots.cluster(null)[0].count() == 0


def test_too_large_components_are_an_error(spark):
    big = spark.createDataFrame([(1, [1e30] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        codebooks.compress(big)[0].collect()
    for wrong in ({"entries": 0}, {"entries": 257}, {"parts": 0}):
        with pytest.raises(ValueError):
            codebooks.compress(big, **wrong)


def test_only_sums_meet(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    found, _ = pivots.cluster(table, rounds=1)
    assert "Exchange" not in explained(found) and "Exchange" not in explained(codebooks.compress(table, rounds=1)[0])


def test_pruning_on_the_given_vectors(spark):
    """Both methods measure fewer pairs than full scans do."""
    x = np.floor(256 * np.array([r["embedding"] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()], float)).astype(int)
    fixed = pivots.farthest(x[:40], 8)
    _, _, measured = pivots.nearest(x, np.stack([pivots.squared(x, p) for p in fixed], 1), x[:40], fixed)
    assert measured < 0.9 * len(x) * 40


# --- fingerprints -----------------------------------------------------------------------


def letters(hashes) -> str:
    """One code per hash below a quarter of the range, else of the least hash."""
    kept = [h for h in hashes if h < 1 << 62] or [min(hashes)] if len(hashes) else []
    spelled = lambda h: "".join(sketches.LETTERS[h >> (58 - 6 * k) & 63] for k in range(8))
    return "".join(sorted({spelled(int(h)) for h in kept}))


def brute(text: str) -> str:
    return letters([int(h) for h in shingle_sets(pa.array([text]), 5)[0]])


def shared(a: str, b: str) -> float:
    if a == b or not a or not b:
        return float(a == b)
    x, y = ({m[k:k + 8] for k in range(0, len(m), 8)} for m in (a, b))
    return len(x & y) / min(len(x), len(y))


def expected(table: list[tuple]) -> list[tuple]:
    order = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other = brute(text), brute(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, shared(own, other), shared(own, brute(following))))
    return sorted(out, key=repr)


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=30))
@settings(max_examples=200, deadline=None)
def test_a_fingerprint_holds_what_lies_below_the_threshold(hashes):
    assert sketches.fingerprint(np.array(sorted(set(hashes)), np.uint64)) == letters(sorted(set(hashes)))


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.op13_scaled_sketches(spark, SMALL))
    assert got == expected(docs)
    likeness = np.array([(r[5], r[6]) for r in got if r[1] >= 400])
    assert (likeness[:, 0] > 0.25).mean() > 0.98 and (likeness[:, 1] < 0.25).mean() > 0.9


@pytest.mark.parametrize("buckets", [1, 2, 3, 7, 50])
def test_every_row_meets_the_next(spark, buckets):
    words = "one two three four five six seven eight nine ten".split()
    table = [(i * i % 101, " ".join(words[k % 10] for k in range(i % 13))) for i in range(0, 50)]
    table = list({r[0]: r for r in table}.values()) + [(500, None), (501, ""), (-3, "ünï\U0001f600 cödé " * 9), (502, "x" * 300_000), (503, "w " * 60_000)]
    got = rows(sketches.beside_edited(spark.createDataFrame(table, "doc_id long, text string"), buckets=buckets))
    want = expected(table)
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in got] == [(r[0], r[1], r[2], r[3], r[4]) for r in want]


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_ties_nulls_and_repeated_rows(spark, buckets):
    """Rows of one id stand side by side; an id that fills several ranges is split, and nothing is lost."""
    table = [(5, f"text number {i} of the very same id") for i in range(60)] + [(5, "again")] * 20 + [(9, "last words here now then"), (None, "no id"), (None, None), (1, "a b c d e")]
    got = sketches.beside_edited(spark.createDataFrame(table, "doc_id long, text string"), buckets=buckets).collect()
    assert sorted((r["id"] is None, r["id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in table)
    nine = next(r for r in got if r["id"] == 9)
    assert {r["next_fingerprint"] for r in got if r["id"] == 5} - {r["fingerprint"] for r in got if r["id"] in (5, 1)} == set()
    assert nine["next_fingerprint"] in {r["fingerprint"] for r in got if r["id"] == 5}
    # A single ring over all rows: what follows is what is there.
    assert sorted(r["next_fingerprint"] for r in got) == sorted(r["fingerprint"] for r in got)
    places = sketches.beside_next(spark.createDataFrame(table, "doc_id long, text string"), "doc_id", "text", buckets).groupBy("place").count().collect()
    assert len(places) > 1 or buckets == 1


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sketches.beside_edited(empty).count() == 0 and sketches.sketched(empty).count() == 0
    table = spark.createDataFrame([(1, "a b c d e f", 7, "old", 0.5)], "doc_id long, text string, hash int, fingerprint string, place double")
    assert sketches.sketched(table).columns == ["doc_id", "text", "hash", "place", "fingerprint"] or sketches.sketched(table).columns == table.columns
    got = sketches.sketched(table).collect()[0]
    assert got["fingerprint"] == brute("a b c d e f") and got["hash"] == 7 and got["place"] == 0.5
    assert sketches.beside_edited(table).collect()[0]["next_fingerprint"] == brute("a b c d e f")
    for bits in (0, 7):
        with pytest.raises(ValueError):
            sketches.sketched(table, bits=bits)


def test_containment_of_unequal_documents(spark):
    long = " ".join(f"word{i}" for i in range(20_000))
    short = " ".join(f"word{i}" for i in range(4_000, 4_400))
    half = " ".join([f"word{i}" for i in range(9_000, 9_200)] + [f"other{i}" for i in range(200)])
    table = sketches.sketched(spark.createDataFrame([(1, long), (2, short), (3, half), (4, None), (5, "")], "id int, text string"))
    mark = {r["id"]: r["fingerprint"] for r in table.collect()}
    pair = lambda a, b, f: spark.range(1).select(f(F.lit(mark[a]), F.lit(mark[b])).alias("x")).collect()[0]["x"]
    assert pair(1, 2, sketches.containment) == 1.0 and pair(1, 2, sketches.resemblance) < 0.04
    assert abs(pair(1, 3, sketches.containment) - 0.5) < 0.15
    assert pair(4, 5, sketches.containment) == 1.0 and pair(1, 4, sketches.containment) == 0.0
    assert abs(len(mark[1]) / 8 - 19_996 / 4) < 300


def test_fingerprints_merge(spark):
    texts = ["a b c d e f g h i j k l m n o p", "q r s", "f g h i j k l m n o p q", "", "t u v w x", "y z"]
    table = sketches.sketched(spark.createDataFrame([(i % 2, i, t) for i, t in enumerate(texts)], "g int, i int, text string"))
    sets = shingle_sets(pa.array(texts), 5)
    union = lambda chosen: letters(sorted({int(h) for i in chosen for h in sets[i]}))
    got = {r["g"]: r["fingerprint"] for r in sketches.merged_by(table, ["g"]).collect()}
    assert got == {0: union([0, 2, 4]), 1: union([1, 3, 5])}
    marks = [r["fingerprint"] for r in table.orderBy("i").collect()]
    for a in range(len(texts)):
        for b in range(len(texts)):
            merged = spark.range(1).select(sketches.merged(F.lit(marks[a]), F.lit(marks[b])).alias("x")).collect()[0]["x"]
            assert merged == union([a, b])
    assert re.fullmatch(r"(?:[A-P][A-Za-z0-9+/]{7})+|.{8}|", marks[0])
