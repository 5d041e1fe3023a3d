"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Three stages, each grouping on the digest *and* the whole normalised text, so no stage trusts a digest alone:

1. local: the map-side half of the first aggregation leaves one row per text, salt and task;
2. salted: its other half merges a text's rows within each of ``salts`` salts, so a text that makes up a third of
   the table is combined by many tasks;
3. global: the winners of the salts, at most ``salts`` rows per text, are combined into one.

Texts move in the first two exchanges only. Rows then find their class by digest, which stage 3 has proved to stand for
one text; digests that stand for several texts are joined on the text as well.

Nulls and oddities: a null text is the empty text; a null id ranks after every other id; rows that repeat an id
with equal texts are told apart by row number, so one of them stays; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

BLANKS = r"[\x20\x09-\x0D]+"
_SPAN = Decimal(2**65)
_TOP = Decimal(2**63)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Id, code points, text without blanks and its digest; no other column."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (
        docs.select(F.col(id_col).alias("_id"), F.char_length(text).alias("_chars"), F.regexp_replace(text, BLANKS, "").alias("_body"))
        .withColumn("_digest", digest(F.col("_body")))
    )


def _rank() -> Column:
    """Longer first, then the smaller id, as one fixed-width number: hash aggregation can update it in place."""
    by_id = F.coalesce(F.lit(_TOP) - F.col("_id").cast("decimal(20,0)"), F.lit(Decimal(0)))
    return F.col("_chars").cast("decimal(10,0)") * F.lit(_SPAN) + by_id


def _winner(rank: str) -> Column:
    by_id = F.col(rank) % F.lit(_SPAN)
    return F.when(by_id > 0, F.lit(_TOP) - by_id).cast("long")


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct normalised text: ``_digest, _body, _rank`` (of the row that stays), ``_n`` rows."""
    rows = _keyed(docs, id_col, text_col, digest)
    salted = (
        rows.groupBy("_digest", "_body", F.pmod(F.xxhash64("_id", "_chars"), F.lit(salts)).alias("_salt"))
        .agg(F.max(_rank()).alias("_rank"), F.count(F.lit(1)).alias("_n"))
    )
    return salted.groupBy("_digest", "_body").agg(F.max("_rank").alias("_rank"), F.sum("_n").alias("_n"))


def _groups(docs: DataFrame, id_col: str, text_col: str, salts: int,
            digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame | None]:
    """Stored groups of more than one row by digest; and, if digests collide, those texts' own groups."""
    classes = text_classes(docs, id_col, text_col, salts, digest)
    groups = stored(
        classes.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts"), F.max("_rank").alias("_rank"), F.sum("_n").alias("_n"))
        .where((F.col("_n") > 1) | (F.col("_texts") > 1))
    )
    shared = groups.where("_texts > 1").select("_digest")
    if shared.isEmpty():
        return groups.drop("_texts"), None
    return groups.where("_texts = 1").drop("_texts"), stored(classes.join(shared, "_digest", "left_semi"))


def _judged(rows: DataFrame, groups: DataFrame, collided: DataFrame | None) -> DataFrame:
    """Adds ``_keep`` and ``_size`` to rows that hold ``_id, _digest`` and, for collisions, ``_body``."""
    found = rows.join(groups, "_digest", "left")
    if collided is not None:
        theirs = collided.select("_digest", "_body", F.col("_rank").alias("_rank2"), F.col("_n").alias("_n2"))
        found = (
            found.join(theirs, ["_digest", "_body"], "left")
            .withColumn("_rank", F.coalesce("_rank2", "_rank")).withColumn("_n", F.coalesce("_n2", "_n"))
        )
    size = F.coalesce("_n", F.lit(1)).cast("long")
    return found.withColumn("_size", size).withColumn("_keep", F.when(size > 1, _winner("_rank")).otherwise(F.col("_id")))


def _repeats_ids(docs: DataFrame, id_col: str) -> bool:
    return not docs.groupBy(id_col).count().where("count > 1").isEmpty()


def _stays(found: DataFrame, repeated: bool) -> DataFrame:
    """Adds ``_kept``; where ids repeat, one row of an id's equal texts stays (the longest)."""
    stays = F.col("_id").eqNullSafe(F.col("_keep"))
    if not repeated:
        return found.withColumn("_kept", stays)
    text_key = ["_digest", "_body"] if "_body" in found.columns else ["_digest"]
    same = Window.partitionBy(*text_key, "_id").orderBy(F.col("_chars").desc())
    return found.withColumn("_nth", F.row_number().over(same)).withColumn("_kept", stays & (F.col("_nth") == 1))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                     digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts (after deleting blanks) the row with the most code points, then the smallest id, stays.
    """
    groups, collided = _groups(docs, id_col, text_col, salts, digest)
    rows = _keyed(docs, id_col, text_col, digest)
    if collided is None:
        rows = rows.drop("_body")
    found = _stays(_judged(rows, groups, collided), _repeats_ids(docs, id_col))
    return found.select(
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.col("_digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
             digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups, collided = _groups(docs, id_col, text_col, salts, digest)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = F.regexp_replace(text, BLANKS, "")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.char_length(text).alias("_chars"), body.alias("_body"))
    rows = rows.withColumn("_digest", digest(F.col("_body")))
    if collided is None:
        rows = rows.drop("_body")
    found = _stays(_judged(rows, groups, collided), _repeats_ids(docs, id_col))
    return found.where("_kept").select("_row.*")
