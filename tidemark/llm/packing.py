"""Packing by power-of-two decomposition.

A document's ids, its end mark included, are cut into whole sequences of ``limit`` ids and, for what is left, the powers of two
of its binary form, longest first. Every piece is a sequence of its own, so no sequence crosses documents and none is
padded; sequences of equal length share a bucket, from which batches of one shape are drawn.

There is no shuffle: a task tokenises, cuts and numbers its own rows. Sequence ids are the position in the task below its
number, as in ``monotonically_increasing_id``, which a repeated attempt of the task gives out again.

Ids come from a byte-level BPE vocabulary in ranks, which gives the ids of the ``tokenizers`` file of the vocabulary at four times its
speed, but for the tokens that the file adds: ``marks=True`` finds these in a text as that file does, gives their ids, and
encodes what lies between. Tests compare it with the unmodified file. Without ``marks`` their strings are ordinary text.

Nulls and oddities: a null or empty text is the end mark alone, one piece of length one. Rows that repeat an id are packed each.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import portions

LIMIT = 1024
VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


@lru_cache(maxsize=4)
def encoding(vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The tokenizer of a rank file; loaded once per Python worker."""
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def added_tokens(tokenizer: str = TOKENIZER) -> dict[str, int]:
    """The tokens that a ``tokenizers`` file adds to its vocabulary, which it finds in a text before anything else."""
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{tokenizer}: only added tokens that match as they are can be found")
    return {t["content"]: t["id"] for t in added}


def encoder(vocabulary: str = VOCABULARY, marks: bool = False, tokenizer: str = TOKENIZER) -> Callable[[str], list[int]]:
    """Ids of a text; with ``marks`` as of the ``tokenizers`` file with ``add_special_tokens=False``."""
    plain = encoding(vocabulary).encode_ordinary
    added = added_tokens(tokenizer) if marks else {}
    if not added:
        return plain
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")

    def encode(text: str) -> list[int]:
        ids: list[int] = []
        for k, part in enumerate(cut.split(text)):
            if k % 2:
                ids.append(added[part])
            elif part:
                ids += plain(part)
        return ids

    return encode


def pieces(length: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``length`` ids."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError("the limit must be a power of two")
    out = [(start, limit) for start in range(0, length - limit + 1, limit)]
    start = length - length % limit
    size = limit >> 1
    while size:
        if length & size:
            out.append((start, size))
            start += size
        size >>= 1
    return out


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end: int = 0,
           vocabulary: str = VOCABULARY, marks: bool = False) -> DataFrame:
    """A row per sequence: ``doc_id, start, length, doc_tokens, sequence_id, offset, bucket, ids``.

    ``bucket`` is the binary logarithm of the length. A batch of rows holds at most about ``2 ** 20`` ids.
    """
    pieces(0, limit)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def flush(cut: list[tuple], flat: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([c[2] for c in cut])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype(np.int32)))
        columns = [pa.array([c[k] for c in cut], pa.int64()) for k in range(4)]
        return pa.RecordBatch.from_arrays([*columns, ids], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, marks)
        for batch in portions(batches):
            cut, flat, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) if text else []
                ids.append(end)
                cut += [(doc_id, start, length, len(ids)) for start, length in pieces(len(ids), limit)]
                flat.append(np.array(ids, np.int64))
                held += len(ids)
                if held >= 1 << 20:
                    yield flush(cut, flat)
                    cut, flat, held = [], [], 0
            if cut:
                yield flush(cut, flat)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(pack, "doc_id long, start long, length long, doc_tokens long, ids array<int>")
    return found.select(
        "doc_id", "start", "length", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"), "ids")


def ids_crc32(ids: list[int]) -> int:
    """Checksum of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def with_checksum(sequences: DataFrame) -> DataFrame:
    """Adds ``ids_crc32``, the checksum of each sequence's ids."""
    @F.arrow_udf("long")
    def check(ids: pa.Array) -> pa.Array:
        flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())

    return sequences.withColumn("ids_crc32", check("ids"))


def write_buckets(sequences: DataFrame, path: str) -> None:
    """One folder per length, so that a reader draws batches of one shape; tasks write what they hold, without an exchange."""
    sequences.write.partitionBy("bucket").parquet(path)
