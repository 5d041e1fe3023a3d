"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches in folded text.

Folding lower-cases, strips accents and invisible characters, replaces look-alike letters of other scripts and digits or
signs that stand for letters, and treats ``l`` as ``i`` (both are written ``1``). The lexicon and its exception phrases
are folded alike, so a disguise of either matches.

Training: the words of at most ``sample`` labelled documents (those whose id hashes lowest; a documented bound) are
counted by label. Copies count once: a document's family is its longest word, and a word's support is the number of
families that hold it. Words that are far likelier in toxic documents get their log odds as weight. A document's density
is the weight of its hits outside exception phrases over its length in words, and a logistic curve fitted to the sample
turns the density into a score.

Nulls and oddities: a null text is empty and scores as a text without hits; labels without id or verdict are left out;
an id labelled twice counts as toxic if any of its labels does. Without toxic or without clean labels, every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import portions, values
from tidemark.session import stored

# Letters of other scripts that look like Latin ones, and digits or signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n", "ω": "w", "ı": "i", "ł": "i", "ø": "o",
    "ß": "ss", "æ": "ae", "œ": "oe",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "moron mountain")

_SIGN = re.compile(r"[@$!|](?=\w)")
_WORD = re.compile(r"[^\W\d_]+")


def _folds() -> dict[int, str | None]:
    """The character table; accents and full-width forms by rule from Unicode's own decompositions."""
    table: dict[int, str | None] = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        plain = "".join(c for c in plain if not unicodedata.combining(c))
        if plain != chr(code):
            table[code] = plain
    table |= {code: None for code in [*range(0x300, 0x370), *range(0x200B, 0x2010), 0xFEFF, 0xAD]}
    table |= {ord(a): b for a, b in (LOOK_ALIKES | DIGITS).items()}
    table |= {ord(c): " " for c in "\t\n\v\f\r\xa0"}
    return {code: plain and plain.replace("l", "i") for code, plain in table.items()} | {ord("l"): "i"}


_FOLDS = _folds()


def fold(text: str) -> str:
    text = text.lower()
    if any(sign in text for sign in SIGNS):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(_FOLDS)


@dataclass(frozen=True)
class Lexicon:
    """Folded words with weights, folded exception phrases, and the curve from log density to score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 0.0
    offset: float = -math.inf
    least: float = field(default=1e-4)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            found.add_word(word, (len(word), weight))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(fold(phrase)), None))
        found.make_automaton()
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def weigh(self, text: str) -> tuple[float, int, int]:
        """Weight of the hits, hits, and words of a text."""
        if not text or not self.weights:
            return 0.0, 0, len(text.split())
        folded, hits, spared = fold(text), [], []
        for last, (size, weight) in self.automaton.iter(folded):
            first, end = last + 1 - size, last + 1
            if (first and folded[first - 1].isalnum()) or (end < len(folded) and folded[end].isalnum()):
                continue
            if weight is None:
                spared.append((first, end))
            else:
                hits.append((first, end, weight))
        if spared:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in spared)]
        return sum(h[2] for h in hits), len(hits), len(text.split())

    def feature(self, weight: float, words: int) -> float:
        return math.log(self.least + weight / (words + 10.0))

    def score(self, weight: float, words: int) -> float:
        if not self.weights:
            return 0.0
        x = self.slope * self.feature(weight, words) + self.offset
        return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0


def _fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Logistic curve by Newton steps, both classes weighing the same."""
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) * len(labels)
    x = np.stack([features, np.ones_like(features)], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        gradient = x.T @ (share * (p - labels)) + ridge * b
        hessian = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000,
          terms: int = 500, support: int = 6, least_odds: float = 40.0, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn from labelled documents: ``labels`` has the id and ``toxic`` (0 or 1).

    Bounds: ``sample`` labelled documents are read, ``terms`` words are kept; only those and the sample's weights and
    labels reach the driver.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_y")).dropna()
        .groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )

    bag = pa.schema([("_y", pa.int32()), ("_words", pa.list_(pa.string()))])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [sorted(set(_WORD.findall(fold(t or "")))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, bag.field(1).type)], schema=bag)

    # At most `sample` rows of an id and a flag: a bounded broadcast.
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
        .join(F.broadcast(chosen), "_id").select("_id", "_y", "_text")
    )
    rows = stored(rows)
    bags = rows.select("_y", "_text").mapInArrow(words, "_y int, _words array<string>")
    bags = bags.withColumn("_family", F.array_max(F.transform("_words", lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"])
    totals = {r["_y"]: r["n"] for r in bags.groupBy("_y").agg(F.count_distinct("_family").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, exceptions)
    each = bags.select("_y", "_family", F.explode("_words").alias("word")).where(F.char_length("word") > 2).distinct()
    counts = each.groupBy("word").agg(F.sum("_y").alias("a"), F.sum(1 - F.col("_y")).alias("b"))
    odds = ((F.col("a") + 0.5) / (toxic + 1.0)) / ((F.col("b") + 0.5) / (clean + 1.0))
    kept = (
        counts.where(F.col("a") >= support).withColumn("odds", odds).where(F.col("odds") >= least_odds)
        .orderBy(F.desc("odds"), "word").limit(terms).collect()
    )
    lexicon = Lexicon({r["word"]: round(math.log(r["odds"]), 6) for r in kept}, exceptions)

    @F.arrow_udf("double")
    def feature(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.feature(w, n) for w, _, n in map(lexicon.weigh, (t or "" for t in values(texts)))], pa.float64())

    points = rows.select(feature("_text").alias("x"), "_y").collect()  # at most `sample` pairs
    slope, offset = _fit(np.array([p["x"] for p in points]), np.array([p["_y"] for p in points], float))
    return Lexicon(lexicon.weights, exceptions, slope, offset)


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> tuple[DataFrame, Column]:
    """``docs`` with one more column, of score, hits, weight and words, and that column; its name is one that ``docs`` does not have."""
    name = "_toxicity"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"

    @F.arrow_udf("struct<score: double, hits: int, weight: double, words: int>")
    def judge(texts: pa.Array) -> pa.Array:
        out = []
        for text in values(texts):
            weight, hits, words = lexicon.weigh(text or "")
            out.append({"score": lexicon.score(weight, words), "hits": hits, "weight": weight, "words": words})
        return pa.array(out, pa.struct([("score", pa.float64()), ("hits", pa.int32()), ("weight", pa.float64()), ("words", pa.int32())]))

    return docs.withColumn(name, judge(F.col(f"`{text_col}`").cast("string"))), F.col(name)


def reject_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns."""
    found, verdict = scored(docs, lexicon, text_col)
    return found.where(verdict["score"] < threshold).select(*[f"`{c}`" for c in docs.columns])
