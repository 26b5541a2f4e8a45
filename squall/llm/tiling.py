"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a benchmark item if tiles - runs of at least
``MIN_MATCH`` equal tokens, none overlapping another in the item or the document -
cover at least ``COVERAGE`` of the item's tokens, in whatever order and wherever they
stand in the document. Tokens are runs of letters and digits of the lower-cased text.

Per document:

1. Seeds: the Karp-Rabin hashes of all windows of ``MIN_MATCH`` tokens are joined with
   those of the items; only items whose seeds could reach the coverage go on.
2. Seeds on one diagonal merge into runs of equal tokens, checked token by token.
3. Tiles: the longest run is marked again and again; a run that an earlier tile
   overlaps gives way to its unmarked parts. Ties go to the first place in the item,
   then in the document.

Where a document and an item repeat the same tokens, pairs of places grow with the
product of both. Beyond ``PAIRS`` of them they are not listed: the longest match is found
row by row (``tile_rows``), with the same tiles.

The items are a query set held against every document, in blocks of about
``BLOCK_BYTES`` of text: a block is broadcast, all documents stream past it, and the
blocks' results are united; the driver holds one block at a time. So the broadcast is bounded however large the benchmark
is, and documents are never shuffled.

Defined results: a null or empty text matches nothing; an item of fewer than
``MIN_MATCH`` tokens needs all its tokens in one run; an item without tokens never
matches; repeated documents and repeated items each give their own rows; null ids are
carried; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.shards import map_rows
from squall.llm.text import free_name, whole
from squall.llm.work import marked, masks, written

MIN_MATCH = 5
COVERAGE = 0.8
BLOCK_BYTES = 8 << 20
#: pairs of places of one document and one item that are listed; beyond it tiles are found row by row
PAIRS = 1 << 16
TOKEN = re.compile(r"[^\W_]+")
#: base of the rolling hash, modulo 2^64
BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, item_id long, item_tokens int, tiled int, tiles int, coverage double"


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``width`` ids."""
    count = len(ids) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for k in range(width):
        h = h * BASE + ids[k : k + count]
    return h


def runs(item: list[int], doc: np.ndarray, seeds: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    """Maximal runs (item place, document place, length) of equal tokens from seed places."""
    diagonals = defaultdict(list)
    for i, d in seeds:
        if all(item[i + k] == doc[d + k] for k in range(width)):
            diagonals[d - i].append(i)
    out = []
    for shift, places in diagonals.items():
        places.sort()
        begin = last = places[0]
        for i in [*places[1:], None]:
            if i is not None and i <= last + 1:
                last = i
                continue
            out.append((begin, begin + shift, last + width - begin))
            begin = last = i
    return out


def tile(found: list[tuple[int, int, int]], width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: the tiles (item place, document place, length) of the given runs."""
    heap = [(-n, i, d) for i, d, n in found]
    heapq.heapify(heap)
    in_item, in_doc, tiles = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        n = -n
        free = [i + k not in in_item and d + k not in in_doc for k in range(n)]
        if all(free):
            tiles.append((i, d, n))
            in_item.update(range(i, i + n))
            in_doc.update(range(d, d + n))
            continue
        begin = None
        for k, f in enumerate([*free, False]):
            if f and begin is None:
                begin = k
            elif not f and begin is not None:
                if k - begin >= width:
                    heapq.heappush(heap, (begin - k, i + begin, d + begin))
                begin = None
    return tiles


def _covered(doc: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The tokens of ``doc`` that windows at ``places`` cover, in order, other stretches as one zero each."""
    edge = np.zeros(len(doc) + 1, np.int32)
    edge[places] = 1
    np.subtract.at(edge, places + width, 1)
    inside = np.cumsum(edge[:-1]) > 0
    first = np.concatenate([[True], inside[:-1]]) & ~inside
    return np.where(inside, doc, 0)[inside | first]


def tile_rows(item: list[int], doc: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """As :func:`tile`, without listing places: for items and documents that repeat the same tokens.

    Each round finds the longest unmarked match (the first in the item, then in the
    document) from the lengths of matches that end at each place of the document, a row
    per token of the item. A row touches the places of its token alone, and two rows are
    held, so memory is linear in the document.
    """
    doc, left, tiles = doc.copy(), list(item), []
    while True:
        at = {w: np.flatnonzero(doc == w) for w in set(left) if w}
        best, found = width - 1, None
        before, now = np.zeros(len(doc) + 1, np.int32), np.zeros(len(doc) + 1, np.int32)  # one place on, so that 0 is before all
        touched = np.empty(0, np.int64)
        for i, w in enumerate(left):
            places = at[w] if w else np.empty(0, np.int64)
            now[places + 1] = before[places] + 1
            before[touched + 1] = 0
            if len(places):
                lengths = now[places + 1]
                k = int(lengths.argmax())
                if lengths[k] > best:
                    best = int(lengths[k])
                    found = i - best + 1, int(places[k]) - best + 1
            before, now, touched = now, before, places
        if found is None:
            return tiles
        i, d = found
        tiles.append((i, d, best))
        left[i : i + best] = [0] * best
        doc[d : d + best] = 0


class Block:
    """Some benchmark items with their seeds."""

    def __init__(self, items: list[tuple[int | None, str | None]], min_match: int, coverage: float):
        self.coverage, self.vocabulary, self.items = coverage, {}, []
        by_width = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)]
            if not ids:
                continue
            width = min(min_match, len(ids))
            for i, h in enumerate(rolling(np.array(ids, np.uint64), width).tolist()):
                by_width[width][h].append((len(self.items), i))
            self.items.append((item_id, ids, width))
        self.seeds = {w: (np.array(sorted(s), np.uint64), dict(s)) for w, s in by_width.items()}

    def matches(self, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        get = self.vocabulary.get
        found = tokens(text)
        doc = np.fromiter((get(w, 0) for w in found), np.uint32, len(found))
        del found
        for width, (hashes, places) in self.seeds.items():
            h = rolling(doc, width)
            if not len(h):
                continue
            at = np.searchsorted(hashes, h)
            at[at == len(hashes)] = 0
            hit = np.flatnonzero(hashes[at] == h)
            # document places by hash: each hash's are one stretch of ``hit``
            order = np.argsort(at[hit], kind="stable")
            hit = hit[order]
            kinds, first, often = np.unique(at[hit], return_index=True, return_counts=True)
            seeds = defaultdict(list)  # per item: its places, and the stretch of document places of each
            for kind, begin, n in zip(kinds.tolist(), first.tolist(), often.tolist()):
                for item, i in places[int(hashes[kind])]:
                    seeds[item].append((i, begin, n))
            for item, shared in seeds.items():
                item_id, ids, _ = self.items[item]
                need = math.ceil(self.coverage * len(ids) - 1e-9)
                # no tiling covers more of the item than its seeds do
                if len({i + k for i, _, _ in shared for k in range(width)}) < need:
                    continue
                if sum(n for _, _, n in shared) <= PAIRS:
                    pairs = [(i, d) for i, begin, n in shared for d in hit[begin : begin + n].tolist()]
                    tiles = tile(runs(ids, doc, pairs, width), width)
                else:
                    stretches = {(begin, n) for _, begin, n in shared}  # places of the item that are alike share one
                    near = np.unique(np.concatenate([hit[begin : begin + n] for begin, n in stretches]))
                    tiles = tile_rows(ids, _covered(doc, near, width), width)
                tiled = sum(n for _, _, n in tiles)
                if tiled >= need:
                    yield doc_id, item_id, len(ids), tiled, len(tiles), tiled / len(ids)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row per document and benchmark item that it holds: the columns of ``SCHEMA``."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length(whole("text")) + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for k in range(blocks):
        rows = [tuple(r) for r in items.where(part == k).orderBy("item_id", "text").collect()]  # one block
        held = spark.sparkContext.broadcast(rows)

        def each(held=held):
            return Block(held.value, min_match, coverage).matches

        rows_ = map_rows(docs.select("doc_id", "text"), SCHEMA, each)
        if blocks > 1:  # one block at a time: its result is written before the next one is read
            rows_ = written(rows_, "tiles")
            held.unpersist()
        del rows
        found.append(rows_)
    return reduce(DataFrame.unionByName, found)


def keep_clean(docs: DataFrame, benchmark: DataFrame, null_ids: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; with ``null_ids`` all rows with a null id stay.

    Whether a row goes hangs on its text alone, so hits are named by the text's hash.
    """
    hit, own, mark = free_name(docs, "_hit", "_own", "_mark")
    key = F.xxhash64(whole("text"))
    found = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark, **options)
    found = written(found.select(F.col("doc_id").alias(hit)).distinct(), "hits")
    # only rows that may go are shuffled
    known = marked(docs.withColumn(own, key), own, written(masks(found, hit), "masks"), mark)
    same = F.col(own) == F.col(hit)
    if null_ids:
        same &= F.col("doc_id").isNotNull()
    some = known.where(F.col(mark)).join(found, same, "left_anti")
    return known.where(~F.col(mark)).select(*docs.columns).unionByName(some.select(*docs.columns))
