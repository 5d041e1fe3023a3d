"""Vector codes by product quantisation, trained with active entries.

Vectors are cut into equal parts, each with a codebook of its own, trained by Lloyd's rounds. A part keeps the number of its entry
and its exact squared distance to it. After an update of the codebooks, a part whose entry stayed as it was compares
only the entries that moved with that distance: the others were no nearer before and have not moved. A part whose own entry
moved is compared with all. Of equal distances the lower number wins in both cases, so the codes are those of full scans.

A round is one job: every task reads its vectors with their codes and distances, writes them with the new ones, and adds one row of
sums per entry for all its vectors. Only these sums, ``parts * entries * (width + 1)`` numbers, meet, and go to the driver. The table of the round
before is deleted when the next one is written. A lost executor costs the tasks it ran.

Nulls and oddities: vectors that are null or hold null or non-finite components take no part. The width is that of the vector with the smallest
id whose length is a positive multiple of ``parts``; vectors of another length take no part. Codebooks start with the smallest ids, null
ones last, and of rows with one id the smaller vector first; repeated rows count as often as they are there; with fewer rows
than ``entries`` there are as many entries as rows. Components beyond ``vectors.LARGEST`` after scaling are an error. An empty table
gives no rows and empty codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import vectors as V
from tidemark.session import delete_path, scratch_dir


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return np.square(x[:, None, :] - entries[None, :, :]).sum(2)


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, distance: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and squared distances of one part of some vectors, and how many distances that took.

    ``code`` and ``distance`` are those of the codebook before, or None; ``moved`` marks entries that differ from it.
    """
    if code is None:
        scan = np.arange(len(x))
        code, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    else:
        code, distance = code.copy(), distance.copy()
        scan = np.flatnonzero(moved[code])
        stay = np.flatnonzero(~moved[code])
        others = np.flatnonzero(moved)
        if len(stay) and len(others):
            found = _distances(x[stay], book[others])
            best = found.argmin(1)
            least, number = found[np.arange(len(stay)), best], others[best]
            better = (least < distance[stay]) | (least == distance[stay]) & (number < code[stay])
            code[stay[better]], distance[stay[better]] = number[better], least[better]
        compared = len(stay) * len(others)
        if not len(scan):
            return code, distance, compared
    found = _distances(x[scan], book)
    code[scan] = found.argmin(1)
    distance[scan] = found.min(1)
    return code, distance, len(scan) * len(book) + (0 if len(scan) == len(x) else compared)


class Codebooks:
    """Entries by part: ``books[part, entry, position]``."""

    def __init__(self, books: np.ndarray):
        self.books = books

    @property
    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def decoded(self, codes: bytes) -> list[int]:
        """The vector a code stands for."""
        return [int(x) for part, entry in enumerate(codes) for x in self.books[part, entry]]


def _round(state: DataFrame, books: np.ndarray, moved: np.ndarray, known: bool, path: str) -> DataFrame:
    """Write the table of one round: ``kind`` 0 has the vectors with codes and distances, ``kind`` 1 the sums of each task."""
    parts, entries, width = books.shape
    fields = T.StructType([*state.schema.fields[:3], T.StructField("codes", T.BinaryType()), T.StructField("distances", T.ArrayType(T.LongType())),
                           T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("kind", T.IntegerType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        shape = None
        for batch in V.portions(batches):
            n = batch.num_rows
            x = V.matrix(batch["v"], parts * width)
            codes, distances = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
            if known:
                before = np.frombuffer(b"".join(batch["codes"].to_pylist()), np.uint8).reshape(n, parts).astype(np.int64)
                far = V.matrix(batch["distances"], parts)
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width]
                codes[:, p], distances[:, p], _ = reassign(part, books[p], moved[p], *((before[:, p], far[:, p]) if known else (None, None)))
                np.add.at(sums[p], codes[:, p], np.concatenate([part, np.ones((n, 1), np.int64)], 1))
            raw = codes.astype(np.uint8)
            new = [pa.array([r.tobytes() for r in raw], pa.binary()), V.lists(distances, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.array(np.zeros(n, np.int32))]
            out = pa.RecordBatch.from_arrays([batch["row"], batch["id"], batch["v"], *new], names=fields.fieldNames())
            shape = out.schema
            yield out
        if shape is not None:
            total = pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(shape)[:5]], total, pa.array([1], pa.int32())], schema=shape)

    state.mapInArrow(assign, fields).write.partitionBy("kind").parquet(path)
    return state.sparkSession.read.schema(fields).parquet(path)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096) -> tuple[DataFrame, Codebooks]:
    """``row, codes, error`` of every usable vector, and the codebooks.

    ``row`` is a struct of all columns but the vector, ``codes`` one byte per part, ``error`` the squared distance, over all parts, between the vector
    of ``floor(scale * x)`` and the one its codes stand for.
    """
    if not 0 < entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("1 to 256 entries, one part and no negative number of rounds at least")
    spark = vectors.sparkSession
    rows = V.integers(vectors, id_col, vector_col, scale)
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    whole = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0)).select("id", "v")
    first = whole.orderBy(*order).limit(1).collect()
    size = len(first[0]["v"]) if first else 0
    rows = rows.where(F.size("v") == size) if size else rows.limit(0)
    start = [r["v"] for r in rows.select("id", "v").orderBy(*order).limit(entries).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, size // parts).transpose(1, 0, 2)
    if not start:
        return rows.select("row", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), Codebooks(books)
    path = scratch_dir(spark, "codes")
    rows.write.parquet(path)
    state = spark.read.schema(rows.schema).parquet(path)
    moved, known = np.ones(books.shape[:2], bool), False
    for done in range(rounds + 1):
        behind, path = path, scratch_dir(spark, "codes")
        table = _round(state, books, moved, known, path)
        delete_path(spark, behind)
        state, known = table.where("kind = 0").drop("sums", "kind"), True
        if done == rounds:
            break
        width = books.shape[2]
        totals = V.added(table.where("kind = 1"), parts * len(start) * (width + 1)).reshape(parts, len(start), width + 1)
        updated = V.means(totals, books)
        moved = (updated != books).any(2)
        books = updated
        if not moved.any():  # all later rounds would leave every code as it is
            break
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b)
    return state.select("row", "codes", error.alias("error")), Codebooks(books)
