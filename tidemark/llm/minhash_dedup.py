"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of ``halves`` half keys are computed per document, each half key over ``rows`` minima. A table's key pairs half key i
of the first collection with half key j of the second, so ``2 * halves * rows`` minima serve ``halves ** 2`` tables, whose
plain form would need ``2 * rows * halves ** 2``. Two documents of similarity s share no table with probability of at
most ``2 * (1 - s ** rows) ** halves``: 5e-6 at s = 0.85 with the defaults, 1e-7 at 0.9. That is the only way a link can be missed.

Steps, all of them joins and aggregations over stored tables:

1. Documents with equal sets form a class, named by its smallest id, and one of them stands for it. An id with several texts may name
   several classes; each keeps its keys and its set.
2. Keys that several classes share are kept, with the classes that hold them.
3. Classes that cannot reach the threshold go: if x and y are similar, at most a share ``1 - threshold`` of x's shingles is
   absent from all other candidates. This is exact, and it empties the huge buckets of documents that share only a passage.
4. Star: every class is compared with the most central member of each of its buckets, the hub; confirmed links are joined
   into components.
5. Rest: of the classes around a hub, those of different components are compared, unless bounds on what two of them can share rule
   that out: what each shares with any candidate, and what neither lacks of their hub. Both bounds are exact.

Members of one component are never compared again, so a bucket of n copies costs n comparisons, not n^2 / 2.

Nulls and oddities: a null, empty or blank text has an empty set and is linked with nothing. A row without id is
linked with nothing, stays, and has no component. Rows that share an id are one document: their texts are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import portions
from tidemark.llm.components import components
from tidemark.llm.shingles import digest, mix, shingle_sets
from tidemark.session import stored

SEED = 20_240_501


def _minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """For every set and each of ``count`` hash functions, the smallest hash; empty sets give the largest number."""
    seeds = mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))
    out = np.full((len(sets), count), np.iinfo(np.uint64).max, np.uint64)
    full = [k for k, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[k] for k in full])
        at = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
        for j, seed in enumerate(seeds):
            x = (flat ^ seed) * (seed | np.uint64(1))
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xD6E8FEB86659FD93)
            out[full, j] = np.minimum.reduceat(x, at)
    return out


def half_keys(sets: list[np.ndarray], halves: int, rows: int) -> np.ndarray:
    """The two collections side by side: ``2 * halves`` half keys per set."""
    minima = _minima(sets, 2 * halves * rows)
    keys = np.zeros((len(sets), 2 * halves), np.uint64)
    for k in range(2 * halves):
        for r in range(rows):
            keys[:, k] = mix(keys[:, k] * np.uint64(31) + minima[:, k * rows + r])
    return keys


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, halves: int, rows: int) -> DataFrame:
    """``id, n`` (size of the set), ``digest`` of the set, and ``first`` and ``second`` half keys."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = shingle_sets(batch.column(1), width)
            keys = half_keys(sets, halves, rows).view(np.int64)
            a, b = (pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), halves).cast(pa.list_(pa.int64()))
                    for x in (keys[:, :halves], keys[:, halves:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()), a, b], schema=schema)

    rows_ = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows_.mapInArrow(sketch, "id long, n long, digest binary, first array<long>, second array<long>")


def _table_keys(classes: DataFrame) -> DataFrame:
    """A row per class and table: the pair of half keys, numbered, hashed into one key."""
    first = classes.select("id", "second", F.posexplode("first").alias("i", "a"))
    return first.select("id", "i", "a", F.posexplode("second").alias("j", "b")).select(F.xxhash64("i", "j", "a", "b").alias("key"), "id")


def _full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, shingles``: the whole sets of the chosen documents, from their whole texts."""
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = shingle_sets(batch.column(1), width)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(ids, "id", "left_semi").mapInArrow(spell, "id long, shingles array<long>").where(F.size("shingles") > 0)


def _possible(sets: DataFrame, percent: int, rounds: int = 2) -> DataFrame:
    """Sets ``(id, part)`` that can still have a partner, with ``own``: how many of their shingles no other set has."""
    live = sets
    for _ in range(rounds):
        single = live.select("part", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("part").alias("part")).where("c = 1")
        private = single.groupBy("part").agg(F.count(F.lit(1)).alias("own"))
        counted = live.select("id", "part", "shingles").join(private, "part", "left").withColumn("own", F.coalesce("own", F.lit(0)))
        live = stored(counted.where(100 * F.col("own") <= (100 - percent) * F.size("shingles")))
    return live


def _central(live: DataFrame) -> DataFrame:
    """How close a candidate is to all that it shares shingles with, in thousandths of a shingle; only the choice of hubs rests on it.

    Over the members of a group, the mean number of shingles in which they differ from x is least where the sum of
    ``2 * share - 1`` over x's shingles is greatest; the share of members that hold a shingle is taken from its count
    among all candidates, in proportion to x's most frequent one.
    """
    each = live.select("id", F.explode("shingles").alias("s"))
    counts = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = each.join(counts, "s").groupBy("id").agg(F.sum("df").alias("total"), F.max("df").alias("most"))
    sizes = live.groupBy("id").agg(F.min(F.size("shingles")).alias("n"))
    score = F.floor(1000 * (2 * F.col("total") / F.col("most") - F.col("n")))
    return shared.join(sizes, "id").select("id", F.greatest(F.lit(0), score).cast("long").alias("central"))


def _similar(both: Column, left: str, right: str, percent: int) -> Column:
    return 100 * both >= percent * (F.size(left) + F.size(right) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    found = pairs.join(a, "a").join(b, "b")
    return found.where(_similar(F.size(F.array_intersect("sa", "sb")), "sa", "sb", percent)).select("a", "b")


def _against_hubs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For ``pairs(id, hub)``: are they similar, and how the member differs from its hub.

    ``added`` counts the member's shingles that the hub lacks and another candidate has; ``m0..m3`` mark, of 256 cells that the hub's shingles are
    hashed to, those with a shingle that the member lacks; ``size`` is the hub's.
    """
    x = sets.select("id", F.col("shingles").alias("xs"), "own")
    h = sets.select(F.col("id").alias("hub"), F.col("shingles").alias("hs"))
    found = pairs.join(x, "id").join(h, "hub").withColumn("missing", F.array_except("hs", "xs")).withColumn("both", F.size("hs") - F.size("missing"))
    cell = "aggregate(filter(missing, s -> ((s >> 6) & 3) = {k}), 0L, (m, s) -> m | shiftleft(1L, cast(s & 63 as int)))"
    return found.select(
        "id", "hub", _similar(F.col("both"), "xs", "hs", percent).alias("similar"), (F.size("xs") - F.col("both") - F.col("own")).alias("added"),
        F.size("hs").alias("size"), *[F.expr(cell.format(k=k)).alias(f"m{k}") for k in range(4)])


def near_links(docs: DataFrame, sketch: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """Links ``(a, b)`` between class representatives that join up everything similar, besides those of equal sets."""
    named = F.struct("id", "first", "second")
    classes = stored(sketch.where("n > 0 and id is not null").groupBy("digest").agg(F.min(named).alias("c")).select("c.*"))
    keys = _table_keys(classes)
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"))
    members = stored(keys.join(shared, "key"))
    # An id may have several sets: each is told from the others by its number.
    sets = stored(_full_sets(docs, members.select("id").distinct(), id_col, text_col, width).withColumn("part", F.monotonically_increasing_id()))
    live = _possible(sets, percent)
    # An id's sets as one: the least size and the most shared shingles of any of them.
    sizes = live.groupBy("id").agg(F.min(F.size("shingles")).alias("n"), F.max(F.size("shingles") - F.col("own")).alias("c"), F.min("own").alias("own"))
    members = stored(members.join(sizes, "id").join(_central(live), "id", "left"))
    order = F.coalesce("central", F.lit(-1)) * F.lit(2**32) + F.pmod(F.xxhash64("id"), F.lit(2**32))
    hubs = stored(members.groupBy("key").agg(F.max_by("id", order).alias("hub"), F.min("id").alias("low"), F.max("id").alias("high")).where("low < high"))
    placed = stored(members.join(hubs.select("key", "hub"), "key").select("hub", "id", "n", "c").distinct())
    star = stored(_against_hubs(placed.where("id <> hub").select("id", "hub"), live, percent))
    links = star.where("similar").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    found = components(links)

    # Where an id has several sets, its differences are those that all of them have.
    marks = ["m0", "m1", "m2", "m3"]
    apart = star.groupBy("hub", "id").agg(F.max("added").alias("added"), F.max("size").alias("size"), *[F.bit_and(m).alias(m) for m in marks])
    sized = star.groupBy("hub").agg(F.max("size").alias("hub_size"))
    spread = placed.join(found, "id", "left").join(apart.drop("size"), ["hub", "id"], "left").join(sized, "hub")
    spread = stored(spread.select("hub", "id", "n", "c", "hub_size", F.coalesce("component", "id").alias("component"), *[F.coalesce(m, F.lit(0)).alias(m) for m in ["added", *marks]]))
    mixed = spread.groupBy("hub").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("hub")
    open_ = stored(spread.join(mixed, "hub", "left_semi"))
    other = open_.select("hub", *[F.col(c).alias(f"_{c}") for c in ("id", "n", "c", "component", "added", *marks)])
    # What two members can share at most: what each shares with anyone; and, of the hub, what neither lacks, with what both may have added.
    lacking = sum((F.bit_count(F.col(m).bitwiseOR(F.col(f"_{m}"))) for m in marks), F.lit(0))
    both = F.least("c", "_c", F.col("hub_size") - lacking + F.least("added", "_added"))
    fits = 100 * both >= percent * (F.col("n") + F.col("_n") - both)
    rest = open_.join(other, (open_["hub"] == other["hub"]) & (F.col("id") < F.col("_id")) & (F.col("component") != F.col("_component")) & fits)
    rest = rest.select(F.col("id").alias("a"), F.col("_id").alias("b")).distinct()
    return links.unionByName(_confirmed(rest, live, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85,
                    halves: int = 10, rows: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if ``100 * |A and B| >= percent * |A or B|``; a component is named by its smallest id, which stays.
    """
    sketch = stored(sketches(docs, id_col, text_col, width, halves, rows))
    links = near_links(docs, sketch, id_col, text_col, width, percent)
    # Rows of a class hang on its representative; so do the texts of an id that has several.
    named = sketch.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("most")).where("rep < most")
    same = sketch.join(named, "digest").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(same).distinct())
    out = sketch.select("id", "n").join(found, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document stays, with all their columns."""
    gone = near_duplicates(docs, id_col, **options).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
