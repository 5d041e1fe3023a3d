"""Document fingerprints: every shingle hash below a fixed share of all hashes (a threshold-scaled sketch).

A fingerprint keeps, of a document's shingle hashes, all that lie below a fixed threshold, so it grows with the document and two of them are samples by
the same rule: what a short text shares with a very long one can be estimated, which sketches of one size cannot do. Fingerprints
merge without the texts: the union of the hashes is the fingerprint of the union of the shingles. A text with shingles but none below the threshold
keeps its least hash, until it is merged with one that has any, so that short texts have fingerprints too.

A fingerprint is text: 8 letters per hash, of the upper 48 bits in base64, in the order of the letters. The share is ``2**-bits``, so a hash is
below the threshold if its first letter is among the first ``64 >> bits``. :func:`containment`, :func:`resemblance` and :func:`merged` are plain column
expressions on that text.

Shingles are runs of ``width`` words, words are cut at blanks and A-Z lower-cased, fewer words are one shingle. Nulls and oddities: a null text
counts as empty, and its fingerprint is empty; so is that of a text without words. An empty fingerprint is like nothing but an empty one: both
give 1, either alone 0. Equal texts have equal fingerprints, however long; repeated rows are rows of their own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import portions
from tidemark.llm.shingles import shingle_sets

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
CODE = 8  # letters of a hash
WIDTH = 5
BITS = 2  # of all hashes, a quarter is below the threshold


def fingerprint(hashes: np.ndarray, bits: int = BITS) -> str:
    """Of one document's sorted distinct shingle hashes."""
    if not len(hashes):
        return ""
    kept = hashes[:max(1, int(np.searchsorted(hashes, np.uint64(1 << (64 - bits)))))]
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    codes = np.unique(np.frombuffer(base64.b64encode(raw), f"S{CODE}"))
    return codes.tobytes().decode("ascii")


def fingerprints(texts: pa.Array, width: int = WIDTH, bits: int = BITS) -> pa.Array:
    if not 0 < bits <= 6:
        raise ValueError("a share of 1/2 to 1/64")
    return pa.array([fingerprint(h, bits) for h in shingle_sets(texts, width)], pa.string())


def sketched(docs: DataFrame, text_col: str = "text", to: str = "fingerprint", width: int = WIDTH, bits: int = BITS) -> DataFrame:
    """``docs`` with the fingerprint of every whole text; a column of that name is replaced."""
    if not 0 < bits <= 6:
        raise ValueError("a share of 1/2 to 1/64")

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        made = [fingerprints(texts.slice(first, 512), width, bits) for first in range(0, len(texts), 512)]
        return pa.concat_arrays(made) if made else pa.array([], pa.string())

    return docs.withColumn(to, of(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))


def codes(mark: Column) -> Column:
    return F.regexp_extract_all(mark, F.lit(f"(.{{{CODE}}})"), F.lit(1))


def _share(a: Column, b: Column, whole) -> Column:
    shared = F.size(F.array_intersect(codes(a), codes(b)))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(shared / whole(F.length(a) / CODE, F.length(b) / CODE, shared))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller document's shingles that the larger one has, 0 to 1."""
    return _share(a, b, lambda n, m, _: F.least(n, m))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of both documents' shingles that they have in common, 0 to 1."""
    return _share(a, b, lambda n, m, shared: n + m - shared)


def _cleaned(all_codes: Column, bits: int) -> Column:
    below = F.filter(all_codes, lambda c: F.substring(c, 1, 1).isin(list(LETTERS[:64 >> bits])))
    # Letters are not in the order of their values, so the least code is found by where each letter stands in the alphabet.
    value = lambda c: F.translate(c, LETTERS, "".join(sorted(LETTERS)))
    least = F.array_min(F.transform(all_codes, lambda c: F.struct(value(c).alias("v"), c.alias("c"))))["c"]
    return F.when(F.size(below) > 0, F.array_join(F.array_sort(below), "")).when(F.size(all_codes) > 0, least).otherwise("")


def merged(a: Column, b: Column, bits: int = BITS) -> Column:
    """The fingerprint of both documents' shingles together."""
    return _cleaned(F.array_distinct(F.concat(codes(a), codes(b))), bits)


def merged_by(marks: DataFrame, by: list[str], mark: str = "fingerprint", bits: int = BITS) -> DataFrame:
    """One fingerprint per group, of all its documents; ``by`` and ``mark`` are the columns returned.

    Codes are made distinct before they meet, so copies cost nothing; a group's sketch is one value and must fit into a task. Of codes above
    the threshold each task passes on the least one of a group.
    """
    keys = [F.col(f"`{c}`") for c in by]
    each = marks.select(*keys, F.explode_outer(codes(F.col(f"`{mark}`"))).alias("c"))
    below = F.substring("c", 1, 1).isin(list(LETTERS[:64 >> bits]))
    value = F.translate("c", LETTERS, "".join(sorted(LETTERS)))
    low = each.where(below).distinct()
    high = each.where(F.coalesce(~below, F.lit(True))).groupBy(*keys).agg(F.min_by("c", value).alias("c"))
    found = low.unionByName(high).groupBy(*keys).agg(F.collect_set("c").alias("cs"))
    return found.select(*keys, _cleaned(F.col("cs"), bits).alias(mark))


# --- each document beside the next ------------------------------------------------------


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key, by two short searches instead of one long one."""
    if not bounds:
        return F.lit(0)
    size = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[k:k + size] for k in range(0, len(bounds), size)]
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    block = F.size(F.filter(longs([b[0] for b in blocks]), lambda x: x <= key))
    inside = F.size(F.filter(F.get(F.array(*[longs(b) for b in blocks]), block - 1), lambda x: x <= key))
    return F.when(block == 0, 0).otherwise((block - 1) * size + inside).cast("int")


def beside_next(docs: DataFrame, id_col: str, text_col: str, buckets: int | None = None) -> DataFrame:
    """``id, text, place, guest`` in partitions in which every row but a guest is followed by the next one.

    Order is by descending id, null ids last, rows with one id by their texts' hashes, then by the texts; the first row follows the last. Ids are cut into ranges at
    their quantiles; rows of an id that fills several ranges go by hash to its ranges. A range is one partition, sorted by Spark, and the first row of each
    is also sent, as a guest, to the range before it. What the driver sees are one bound and one first row per range.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(id_.alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    key = F.coalesce("id", F.lit(-(1 << 63)))
    shares = [k / buckets for k in range(1, buckets)]
    cuts = rows.select(F.percentile_approx(key, shares or [0.5], 20 * buckets).alias("cuts")).collect()[0]["cuts"] or []
    cuts = cuts if shares else []
    bounds = sorted(set(cuts))
    place = _bucket(key, bounds)
    # An id that is a bound more than once fills the ranges between by itself: its rows are dealt out by hash; the others of its range are greater and come first.
    heavy = {b: cuts.count(b) for b in bounds if cuts.count(b) > 1}
    split = F.lit(buckets).cast("double")
    for value, times in heavy.items():
        split = F.when(key == value, F.shiftrightunsigned(F.col("hash").bitwiseXOR(F.lit(-(1 << 63))), 40) * times / float(1 << 24)).otherwise(split)
    rows = rows.select("*", place.alias("range"), split.cast("int").alias("part"))
    first = F.max(F.struct(F.col("id").isNotNull().alias("id_there"), "id", "hash")).alias("first")
    firsts = sorted(rows.groupBy("range", "part").agg(first).collect(), key=lambda r: (r["range"], r["part"]), reverse=True)
    if not firsts:
        return rows.select("id", "text", F.lit(0).alias("place"), F.lit(False).alias("guest"))
    places = [(r["range"], r["part"], n, (n - 1) % len(firsts), r["first"]["id"], r["first"]["hash"]) for n, r in enumerate(firsts)]
    known = F.broadcast(spark.createDataFrame(places, "range int, part int, place int, before int, first_id long, first_hash long"))
    at = rows.join(known, ["range", "part"])
    own = F.struct(F.col("place").alias("place"), F.lit(False).alias("guest"))
    leads = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))
    sent = F.when(leads, F.array(own, F.struct(F.col("before").alias("place"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    dealt = at.select("id", "text", "hash", F.explode(sent).alias("to")).select("id", "text", "hash", "to.place", "to.guest")
    dealt = dealt.repartitionById(len(firsts), F.col("place"))
    return dealt.sortWithinPartitions("place", "guest", F.col("id").desc_nulls_last(), F.desc("hash"), F.desc("text")).drop("hash")


def halves(text: str, following: str) -> str:
    """The text with its second half, rounded down, replaced by as many first code points of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str], list[str]]]:
    """Portions of rows, their texts and the texts that follow, of partitions made by :func:`beside_next`."""
    held: tuple[pa.RecordBatch, list[str]] | None = None
    for batch in portions(batches):
        texts = batch["text"].to_pylist()
        if held is not None:
            yield held[0], held[1], [*held[1][1:], texts[0]]
        held = (batch, texts)
    if held is not None:
        yield held[0], held[1], [*held[1][1:], ""]  # the last row of a partition is a guest


def beside_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, bits: int = BITS, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text, of the next one, and of the text whose second half the next one's start replaces.

    ``id, n_chars, edited, fingerprint, edited_fingerprint, next_fingerprint``; ``edited`` is the text's sha256. Order and ties are those of :func:`beside_next`.
    """
    fields = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_chars", T.LongType()), *[
        T.StructField(n, T.StringType()) for n in ("edited", "fingerprint", "edited_fingerprint", "next_fingerprint")]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, following in with_next(batches):
            edited = [halves(a, b) for a, b in zip(texts, following, strict=True)]
            marks = fingerprints(pa.array([*texts, following[-1]], pa.large_string()), width, bits)
            out = [batch["id"], pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                   marks.slice(0, len(texts)), fingerprints(pa.array(edited, pa.large_string()), width, bits), marks.slice(1)]
            yield pa.RecordBatch.from_arrays(out, names=fields.fieldNames()).filter(pc.invert(batch["guest"]))

    return beside_next(docs, id_col, text_col, buckets).mapInArrow(measure, fields)
