"""Best-fit packing of token sequences under several capacities.

Documents are encoded, ended with an end id, cut into pieces of at most ``capacity``
tokens (a cut document's first piece takes the remainder) and packed into sequences.

Vector best-fit: a sequence has residual capacities of tokens, documents and attention
cost (the sum of squared piece lengths). It is opened with the longest piece left; then,
among the piece lengths that fit under every constraint, the one that scores best comes
next: ``rule="norm"`` takes the one that leaves the smallest weighted residual norm,
``rule="dot"`` the one whose demand has the largest weighted dot product with the
residual. The defaults of the document and attention capacities are the largest that
``capacity`` tokens can need, so that only tokens bind and as few sequences as possible
come out.

Only lengths matter for that, so the packing is worked out on the counts of the at
most ``capacity`` distinct lengths, whatever the number of pieces: a filled sequence is
a pattern of lengths, used as often as the counts allow, which is what filling one
sequence after another would do. Each pattern uses up a length at least, so there are a
few thousand. Pieces then take their places by rank: the pieces of a length are numbered
through blocks of bounded size (a window per block, plus the block's offset), and the
number gives the sequence and the offset by one broadcast join with the patterns.

The pieces are written to the shared folder before they are numbered, so that a lost
executor cannot change the numbering.

Defined results: a null text counts as empty and gives one piece, the end id; repeated
rows and rows with a null ``doc_id`` are packed like any other; an empty table gives no
sequence; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.encoding import encoder
from squall.llm.work import written

CAPACITY = 2048
END_ID = 0
#: pieces numbered in one window
BLOCK_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every row of ``docs``: the columns of ``PIECES``."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                    rows.append((doc_id, k, s, n, zlib.crc32(ids[s : s + n])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Pattern:
    """``copies`` sequences that hold each ``(length, times)`` of ``items``."""

    copies: int
    items: tuple[tuple[int, int], ...]


def patterns(
    counts: Mapping[int, int],
    capacity: int = CAPACITY,
    max_docs: int | None = None,
    max_attention: int | None = None,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
) -> list[Pattern]:
    """Vector best-fit of pieces, given the number of pieces of each length."""
    limits = np.array([capacity, max_docs or capacity, max_attention or capacity**2], float)
    lengths = np.array(sorted(counts, reverse=True), np.int64)
    demand = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1).astype(float)
    if len(lengths) and (demand > limits).any():
        raise ValueError("a piece does not fit into an empty sequence")
    left = np.array([counts[int(n)] for n in lengths], np.int64)
    share, weight = demand / limits, np.array(weights)
    out = []
    while (left > 0).any():
        used = np.zeros_like(left)
        k = int(np.argmax(left > 0))  # the longest
        residual = np.ones(3)
        while True:
            used[k] += 1
            residual = residual - share[k]
            fits = (used < left) & (share <= residual + 1e-12).all(axis=1)
            if not fits.any():
                break
            if rule == "norm":
                score = -((residual - share) ** 2 * weight).sum(axis=1)
            else:
                score = (share * residual * weight).sum(axis=1)
            k = int(np.argmax(np.where(fits, score, -np.inf)))  # ties: the longest
        held = used > 0
        copies = int((left[held] // used[held]).min())
        left -= copies * used
        out.append(Pattern(copies, tuple((int(lengths[i]), int(used[i])) for i in np.flatnonzero(held))))
    return out


def _places(found: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces per sequence, first sequence, offset) of each pattern's items."""
    rank, sequence, rows = {}, 0, []
    for p in found:
        offset = 0
        for n, times in p.items:
            begin = rank.get(n, 0)
            rank[n] = begin + times * p.copies
            rows.append((n, begin, rank[n], times, sequence, offset))
            offset += n * times
        sequence += p.copies
    return rows


def packed(rows: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """``rows`` (the columns of ``PIECES``) with ``sequence_id`` and ``offset``."""
    spark = rows.sparkSession
    held = written(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in held.groupBy("length").count().collect()}  # at most `capacity` rows
    places = spark.createDataFrame(
        _places(patterns(counts, capacity, **options)),
        "length long, begin long, end long, times long, first_sequence long, first_offset long",
    )
    blocks = max(1, math.ceil(sum(counts.values()) / BLOCK_ROWS))
    held = held.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy("length", "_block").count()
    offsets = offsets.select("length", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row"))
    ranked = held.withColumn("_in", within).join(offsets, ["length", "_block"])
    rank = F.col("_before") + F.col("_in") - 1
    # a few thousand patterns of at most `capacity` lengths: bounded by the capacity alone
    placed = ranked.withColumn("_rank", rank).join(
        F.broadcast(places.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("begin")) & (F.col("_rank") < F.col("end")),
    )
    at = F.col("_rank") - F.col("begin")
    slot = F.pmod(at, F.col("times"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(at / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + slot * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, **options) -> DataFrame:
    """Encode, cut and pack ``docs``: a row per piece with its sequence and offset."""
    return packed(pieces(docs, tokenizer, capacity, end_id), capacity, **options)
