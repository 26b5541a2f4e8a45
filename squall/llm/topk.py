"""Exact top-k search over vectors with a bit-sliced index.

Components are quantised to ``floor(scale * x)`` and the score of two vectors is the
inner product of their quantised components.

Index: rows are dealt evenly into blocks of bounded size. A block keeps, per component
and binary digit, one bitmap over its rows (a slice): component d of row r, less the
block's smallest component, is the sum of ``2^j * slice[d, j][r]``.

Search, per query and block:

1. The query's components are weights. The score is a sum of slices, each shifted by
   the digits of its weight (negative weights take the complement of the slice), so it
   is added up for all rows at once by carry-save adders: AND, OR and XOR on bitmaps.
   Only the ``KEPT`` most significant slices of each component take part; the sum then
   falls short of the score by less than a known slack.
2. The k-th largest sum is found from the most significant slice of the sum downward:
   rows with the slice set are in if no more than k are, else the others are out.
3. Rows whose sum may reach the k-th within the slack are boundary rows. Their
   components are read back from all slices and scored exactly; ties go to the smaller
   ``vec_id``. So the result is exact, however coarse the kept slices are.

Queries are packed too; every pack meets every block once (a stated query set against
all rows, in blocks) by a shuffle on (block, slot): blocks go to each slot, packs to
each block. A task holds one block and one pack at a time. A block gives at most k rows
a query, of which Spark keeps the best k.

Defined results: vectors that are null or hold a null or non-finite component, and rows
with a null ``vec_id``, take no part; shorter vectors count as if zeros followed; a
component beyond ``LIMIT`` counts as ``LIMIT`` (so that scores fit a long); a query's own
row is no candidate, but another row with its ``vec_id`` is; every repeated row is a
query and a candidate of its own; no vectors or no queries give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.work import written

SCALE = 256
#: quantised components are held within this bound
LIMIT = (1 << 26) - 1
#: most significant slices of a component that the bitmap sums use
KEPT = 7
#: bound of a block's slices, and of its rows
BLOCK_BYTES, BLOCK_ROWS = 1 << 23, 1 << 16
#: queries in a pack, and packs that meet a block in one group
PACK, SLOT_PACKS, LEAST_SLOTS = 64, 64, 8
#: boundary rows read back at once
READ = 1 << 13

BLOCK_SCHEMA = "block long, dims int, bits int, low long, rows int, ids binary, slices binary"
HIT_SCHEMA = "block long, place int, query_id long, vec_id long, score long"


def quantised(vector: str | Column, scale: int = SCALE) -> Column:
    """The vector's components as whole numbers; null where the vector takes no part."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))
    )
    return F.when(~bad, whole)


def slices(values: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(slices[dims, bits, words], bits, low) of ``values[rows, dims]``, which holds whole numbers."""
    low = int(values.min()) if values.size else 0
    above = (values - low).astype(np.uint64).T
    bits = max(1, int(above.max()).bit_length()) if above.size else 1
    words = -(-above.shape[1] // 64)
    out = np.zeros((above.shape[0], bits, words * 8), np.uint8)
    for j in range(bits):
        packed = np.packbits((above >> np.uint64(j)).astype(np.uint8) & 1, axis=1, bitorder="little")
        out[:, j, : packed.shape[1]] = packed
    return out.view("<u8"), bits, low


def _added(levels: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of bitmaps, lowest first; ``levels[i]`` holds stacks of bitmaps that count 2^i."""
    out, at = [], 0
    while at < len(levels):
        stack = levels[at][0] if len(levels[at]) == 1 else np.concatenate(levels[at]) if levels[at] else None
        while stack is not None and len(stack) > 1:
            third = len(stack) // 3
            if not third:
                a, b = stack
                total, carry, stack = (a ^ b)[None], (a & b)[None], stack[2:]
            else:
                a, b, c = (stack[k * third : (k + 1) * third] for k in range(3))
                odd = a ^ b
                total, carry, stack = odd ^ c, (a & b) | (odd & c), stack[3 * third :]
            if at + 1 == len(levels):
                levels.append([])
            levels[at + 1].append(carry)
            stack = np.concatenate([total, stack]) if len(stack) else total
        out.append(stack[0] if stack is not None and len(stack) else None)
        at += 1
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


class Block:
    """One block of the index."""

    def __init__(self, dims: int, bits: int, low: int, rows: int, ids: bytes, data: bytes):
        self.dims, self.bits, self.low, self.rows = dims, bits, low, rows
        self.ids = np.frombuffer(ids, "<i8")
        self.words = -(-rows // 64)
        self.slices = np.frombuffer(data, "<u8").reshape(dims, bits, self.words)
        ends = np.zeros(self.words * 64, np.uint8)
        ends[:rows] = 1
        self.present = np.packbits(ends, bitorder="little").view("<u8")

    def values(self, rows: np.ndarray, dims: int) -> np.ndarray:
        """Quantised components [rows, dims] read back from all slices."""
        digits = self.slices[:dims, :, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
        return self.low + (digits.astype(np.int64) << np.arange(self.bits)[None, :, None]).sum(axis=1).T

    def sums(self, weights: np.ndarray, kept: int) -> tuple[list[np.ndarray], int]:
        """Slices of each row's sum, in units of the lowest kept slice, and the slack in these units."""
        drop = max(0, self.bits - kept)
        size, flip = np.abs(weights), np.where(weights < 0, ~np.uint64(0), np.uint64(0))
        levels = [[] for _ in range(int(size.max(initial=0)).bit_length() + self.bits - drop)]
        for i in range(int(size.max(initial=0)).bit_length()):
            d = np.flatnonzero(size >> i & 1)
            for j in range(drop, self.bits):
                levels[i + j - drop].append(self.slices[d, j] ^ flip[d, None])
        lost = int(size.sum()) * ((1 << drop) - 1)
        return _added(levels), -(-lost >> drop) if drop else 0

    def reaching(self, sums: list[np.ndarray], alive: np.ndarray, k: int, slack: int) -> np.ndarray:
        """Bitmap of the rows whose sum is at least the k-th largest less ``slack``."""
        if _count(alive) <= k:
            return alive
        inside, edge, least = np.zeros_like(alive), alive, 0
        for j in range(len(sums) - 1, -1, -1):
            if sums[j] is None:
                continue
            both = inside | edge & sums[j]
            if _count(both) >= k:
                edge, least = edge & sums[j], least | 1 << j
            else:
                inside, edge = both, edge & ~sums[j]
        least = max(0, least - slack)
        more, same = np.zeros_like(alive), alive
        for j in range(max(len(sums), least.bit_length()) - 1, -1, -1):
            digit = sums[j] if j < len(sums) and sums[j] is not None else np.zeros_like(alive)
            if least >> j & 1:
                same = same & digit
            else:
                more, same = more | same & digit, same & ~digit
        return more | same

    def best(self, query: np.ndarray, own: int | None, k: int, kept: int = KEPT) -> list[tuple[int, int]]:
        """The k best (vec_id, score) of the block's rows, but for row ``own``."""
        dims = min(len(query), self.dims)
        weights = query[:dims]
        alive = self.present
        if own is not None:
            alive = alive.copy()
            alive[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        full = np.zeros(self.dims, np.int64)
        full[:dims] = weights
        sums, slack = self.sums(full, kept)
        near = self.reaching(sums, alive, k, slack)
        rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
        out: list[tuple[int, int]] = []
        for at in range(0, len(rows), READ):
            part = rows[at : at + READ]
            score = self.values(part, dims) @ weights
            ids = self.ids[part]
            order = np.lexsort((ids, -score))[:k]
            out = sorted([*out, *zip(ids[order].tolist(), score[order].tolist())], key=lambda x: (-x[1], x[0]))[:k]
        return out


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


_LONG, _INT, _BYTES = pa.int64(), pa.int32(), pa.binary()
_BLOCK = [("block", _LONG), ("dims", _INT), ("bits", _INT), ("low", _LONG), ("rows", _INT), ("ids", _BYTES), ("slices", _BYTES)]
_HIT = [("block", _LONG), ("place", _INT), ("query_id", _LONG), ("vec_id", _LONG), ("score", _LONG)]
_PACK = [("pack", _LONG), ("queries", _INT), ("dims", _INT), ("home", _BYTES), ("place", _BYTES), ("ids", _BYTES), ("vectors", _BYTES)]
PACK_SCHEMA = "pack long, queries int, dims int, home binary, place binary, ids binary, vectors binary"


def index(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The bit-sliced index of ``vectors`` (vec_id, embedding): rows of ``BLOCK_SCHEMA``."""
    rows = vectors.select("vec_id", quantised("embedding", scale).alias("q")).where("vec_id IS NOT NULL AND q IS NOT NULL")
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("q")), F.lit(1))).first()
    held = max(64, min(BLOCK_ROWS, BLOCK_BYTES * 8 // (max(1, dims) * 9)))
    blocks = max(1, math.ceil(n / held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            if not len(batch):
                continue
            ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False))
            lists = batch.column("q")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            part = np.zeros((len(batch), dims), np.int64)
            part[np.arange(dims)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            parts.append(part)
        if ids:
            data, bits, low = slices(np.concatenate(parts))
            all_ids = np.concatenate(ids).astype("<i8")
            row = (TaskContext.get().partitionId(), dims, bits, low, len(all_ids), all_ids.tobytes(), data.tobytes())
            yield _batch(_BLOCK, [row])

    # dealt evenly, without a key: no key can be hot, and Spark sorts rows first, so a repeated task gets the same
    return rows.repartition(blocks).mapInArrow(run, BLOCK_SCHEMA)


def queries(blocks: DataFrame, every: int) -> DataFrame:
    """(home, place, query_id, vector): the rows of the index whose vec_id is divisible by ``every``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [("home", _LONG), ("place", _INT), ("query_id", _LONG), ("vector", _BYTES)]
        for batch in batches:
            for block, *rest in zip(*(batch.column(c).to_pylist() for c in ("block", "dims", "bits", "low", "rows", "ids", "slices"))):
                held = Block(*rest)
                rows = np.flatnonzero(held.ids % every == 0)
                for at in range(0, len(rows), READ):
                    part = rows[at : at + READ]
                    values = held.values(part, held.dims).astype("<i8")
                    yield _batch(schema, [(block, r, i, v.tobytes()) for r, i, v in zip(part.tolist(), held.ids[part].tolist(), values)])

    return blocks.mapInArrow(run, "home long, place int, query_id long, vector binary")


def packs(asked: DataFrame, count: int) -> DataFrame:
    """Queries dealt evenly into ``count`` packs: rows of ``PACK_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("home", "place", "query_id", "vector")))]
        if rows:
            home, place, ids, vectors = zip(*rows)
            put = [np.array(x, "<i8").tobytes() for x in (home, place, ids)]
            yield _batch(_PACK, [(TaskContext.get().partitionId(), len(rows), len(vectors[0]) // 8, *put, b"".join(vectors))])

    return asked.repartition(count).mapInArrow(run, PACK_SCHEMA)


def hits(blocks: DataFrame, packed: DataFrame, n_blocks: int, n_packs: int, k: int, kept: int = KEPT) -> DataFrame:
    """(block, place, query_id, vec_id, score): each query's k best of every block; block and place name the query's row."""
    slots = max(-(-n_packs // SLOT_PACKS), min(n_packs, LEAST_SLOTS))
    none = {n: F.lit(None).cast(t) for n, t in (x.rsplit(" ", 1) for x in f"{BLOCK_SCHEMA}, {PACK_SCHEMA}".split(", "))}
    left = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumn("kind", F.lit(0))
    right = packed.withColumn("slot", F.pmod("pack", F.lit(slots)).cast("int")).withColumn("kind", F.lit(1))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    names = ["slot", "kind", "block", "dims", "bits", "low", "rows", "ids", "slices", "pack", "queries", "home", "place", "vectors"]
    left = left.select(*(F.col(c) if c in left.columns else none[c].alias(c) for c in names))
    right = right.select(*(F.col(c) if c in right.columns else none[c].alias(c) for c in names))
    groups = left.unionByName(right).repartition(min(n_blocks * slots, 1 << 14), "block", "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in names}
                if row["kind"] == 0:
                    held, at = Block(*(row[c] for c in ("dims", "bits", "low", "rows", "ids", "slices"))), row["block"]
                    continue
                if held is None or at != row["block"]:
                    continue  # a block without rows
                home, place, ids = (np.frombuffer(row[c], "<i8") for c in ("home", "place", "ids"))
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(row["queries"], row["dims"])
                out = []
                for h, p, q, v in zip(home.tolist(), place.tolist(), ids.tolist(), vectors):
                    out.extend((h, p, q, *x) for x in held.best(v, p if h == at else None, k, kept))
                yield _batch(_HIT, out)

    return groups.sortWithinPartitions("block", "slot", "kind").mapInArrow(run, HIT_SCHEMA)


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE, kept: int = KEPT) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row whose ``vec_id`` is divisible by ``every``."""
    blocks = written(index(vectors, scale), "slices")
    asked = written(queries(blocks, every), "queries")
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    n_packs = max(1, math.ceil(asked.count() / PACK))
    found = hits(blocks, written(packs(asked, n_packs), "packs"), n_blocks, n_packs, k, kept)
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: DuckDB twin of the registered query
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
