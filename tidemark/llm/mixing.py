"""Mixing sources to target weights by temperature.

Weights are the sources' token shares to the power alpha, normalised. Alpha is bisected, 64 points at a time: every round
evaluates them in one aggregation over the sources and keeps the part that holds the target, so no list of sources reaches
the driver. Smaller alphas flatten the mix; the search ends at the larger of two exponents, the one whose entropy is
``entropy`` times that of equal weights and the one at which no source is read more than ``repeats`` times.

A source's budget is its weight times the total, in tokens. It is realised as block permutations: a keyed hash deals the
source's documents into blocks of about ``block`` documents, which follow each other in the order of another hash; every epoch
is one pass over all blocks, and the last, partial one ends within a block, whose documents are taken in hash order while
they fit. A document is therefore read as often as its source has whole epochs, or once more.

A hot source costs what its rows cost: sums are taken by block before anything is ordered, the running sums over blocks are
taken in two levels, and only the one block per source where the budget ends is ordered by document.

Nulls and oddities: null sources are one source of their own; a null or empty text has no tokens and counts as fitting.
Rows that repeat an id are one document of their summed tokens; its source is the smallest named. Rows without id are one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

POINTS = 64
ROUNDS = 4


def token_count(text: Column) -> Column:
    """Words: runs of characters other than blanks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _mix_at(shares: DataFrame, alphas: list[float], total: int) -> dict[float, tuple[float, float]]:
    """For each exponent: entropy of the weights, and the most often that a source would be read."""
    grid = shares.select("tokens", F.explode(F.array(*[F.lit(a) for a in alphas])).alias("alpha"))
    share = F.col("tokens") / F.lit(float(total))
    power = F.pow(share, F.col("alpha"))
    found = grid.groupBy("alpha").agg(
        F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("h"), F.max(power / share).alias("r"))
    return {r["alpha"]: (math.log(r["z"]) - r["h"] / r["z"], r["r"] / r["z"]) for r in found.collect()}


def exponent(shares: DataFrame, total: int, entropy: float, repeats: float) -> float:
    """The exponent in 0..1, to six places, for ``shares(source, tokens)``, all of them with tokens.

    Entropy and repetition both fall as the exponent grows, so the smallest that exceeds neither is searched; where even 1
    exceeds one of them, the sources are as flat as asked for, and 1 leaves them alone.
    """
    sources = shares.count()
    if sources < 2:
        return 1.0
    target = entropy * math.log(sources)
    low, high = 0.0, 1.0
    for turn in range(ROUNDS):
        points = [low + (high - low) * k / POINTS for k in range(POINTS)] + [high]
        at = _mix_at(shares, points, total)
        fine = [p for p in points if at[p][0] <= target + 1e-12 and at[p][1] <= repeats + 1e-12]
        if not fine and not turn:
            return 1.0
        high = min(fine, default=high)
        if high == points[0]:
            break
        low = max(p for p in points if p < high)
    return round(high, 6)


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy: float = 0.95,
          repeats: float = 4.0, budget: int | None = None, block: int = 1000, seed: int = 7) -> DataFrame:
    """One row per document: ``doc_id, source, tokens, weight, block_order, copies`` (how often the mix reads it).

    ``budget`` is the mix's size in tokens, by default that of the input. If the sources' own entropy is below the
    target, alpha is below 1 and small sources are repeated; at ``repeats`` the search stops.
    """
    units = stored(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), token_count(F.col(text_col).cast("string")).alias("tokens"))
        .groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("tokens").alias("tokens")))
    shares = stored(units.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    total = shares.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    size = total if budget is None else budget
    filled = shares.where("tokens > 0")
    alpha = exponent(filled, total, entropy, repeats * total / size if size else repeats) if total else 1.0
    power = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(alpha))
    z = filled.agg(F.coalesce(F.sum(power), F.lit(1.0))).first()[0]
    weight = F.when(F.col("tokens") > 0, F.round(power / F.lit(z), 12)).otherwise(F.lit(0.0))
    plan = stored(
        shares.withColumn("weight", weight).withColumn("budget", F.floor(F.col("weight") * F.lit(float(size))))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).cast("long"))
        .withColumn("left", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0)))
        .withColumn("blocks", F.ceil(F.col("docs") / F.lit(float(block))))
        .select(F.col("source").alias("_s"), "weight", "epochs", "left", "blocks"))

    dealt = stored(
        units.join(plan, units["source"].eqNullSafe(plan["_s"]))
        .select("doc_id", "source", "tokens", "weight", "epochs", "left", F.pmod(_hash(seed, "doc_id"), "blocks").alias("block")))
    # Blocks follow each other in hash order; binned by the hash, a running sum needs one bin's blocks in one place.
    blocks = stored(
        dealt.groupBy("source", "block").agg(F.sum("tokens").alias("t"))
        .withColumn("o", _hash(seed + 1, "source", "block")).withColumn("bin", F.shiftright("o", 52)))
    bins = blocks.groupBy("source", "bin").agg(F.sum("t").alias("bt"))
    base = F.sum("bt").over(Window.partitionBy("source").orderBy("bin")) - F.col("bt")
    bases = bins.select(F.col("source").alias("_s"), F.col("bin").alias("_bin"), base.alias("base"))
    inside = Window.partitionBy("source", "bin").orderBy("o", "block")
    stop = F.col("base") + F.sum("t").over(inside)
    ranked = stored(
        blocks.join(bases, blocks["source"].eqNullSafe(bases["_s"]) & (blocks["bin"] == bases["_bin"]))
        .withColumn("stop", stop).select(F.col("source").alias("_s"), F.col("block").alias("_b"), (F.col("stop") - F.col("t")).alias("start"), "stop", "o"))

    joined = dealt.join(ranked, dealt["source"].eqNullSafe(ranked["_s"]) & (dealt["block"] == ranked["_b"]))
    whole = (F.col("left") > 0) & (F.col("stop") <= F.col("left"))
    cut = (F.col("start") < F.col("left")) & ~whole
    # The block where the budget ends: its documents in hash order, while they fit.
    fit = Window.partitionBy("source", "block").orderBy(_hash(seed + 2, "doc_id"), "doc_id")
    ends = joined.where(cut).withColumn("extra", ((F.col("start") + F.sum("tokens").over(fit)) <= F.col("left")).cast("int"))
    rest = joined.where(~cut).withColumn("extra", whole.cast("int"))
    return rest.unionByName(ends).select(
        "doc_id", "source", "tokens", "weight", F.col("o").alias("block_order"), (F.col("epochs") + F.col("extra")).alias("copies"))


def _unit(*parts: Column) -> Column:
    """A number from 0 up to 1, by hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def mix(docs: DataFrame, id_col: str = "doc_id", seed: int = 7, **options) -> DataFrame:
    """The rows of ``docs`` as the mix reads them, in its order: each as many times as its document has copies, with all its columns.

    Every epoch of a source takes its blocks in a fresh order, and the sources' epochs lie side by side over the whole mix, so copies of a row
    are an epoch apart and any stretch of the result has about the mix's weights. The order is that of the partitions and of the
    rows in them, which writing keeps.
    """
    found = mixed(docs, id_col, seed=seed, **options).where("copies > 0")
    plan = found.select(F.col("doc_id").alias("_doc"), F.struct("source", "block_order", "copies").alias("_plan"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"))
    copies = rows.join(plan, F.col("_id").eqNullSafe(F.col("_doc"))).withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_plan.copies"))))
    block = _unit(F.lit(seed + 3), F.col("_nth"), F.col("_plan.source"), F.col("_plan.block_order"))
    place = ((F.col("_nth") - 1 + block) / F.col("_plan.copies")).alias("_place")
    within = F.xxhash64(F.lit(seed + 4), F.col("_nth"), F.col("_id")).alias("_within")
    laid = copies.select("_row", place, within)
    return laid.repartitionByRange("_place", "_within").sortWithinPartitions("_place", "_within").select("_row.*")
