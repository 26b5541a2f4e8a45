"""SimHash near-dedup with a byte-position inverted index and count filtering.

A text's fingerprint has 64 bits: of its 3-word shingles' XXH64 values (lower-cased
A-Z, repeats included) a bit is 1 if it is set in over half. Two fingerprints link if
they differ in ``MAX_BITS`` bits or fewer; documents of linked fingerprints, directly
or through others, form one component.

Index and count filter: a fingerprint is eight (position, byte) postings. Two that
differ in at most 2 bits differ in at most 2 bytes, so they share at least 6 of their 8
postings; pairs below that minimum need no verification. A posting list of a single
(position, byte) holds a 256th of all fingerprints, and tallying its pairs one by one
grows with the square of the input. So no pair is tallied: the count filter is put into
the key. A pair shares at least 6 postings exactly if it meets under one of the 28
choices of 6 positions, so lists on 6 positions hold the pairs that a tally would keep,
and no others. Each distinct fingerprint is listed under its 28 combinations (48 bits and
the choice); a list agrees on 6 bytes, so it holds at most 2^16 distinct fingerprints
whatever the input, which bounds every group. Within a list, in NumPy, the remaining
16 bits are verified (2 bits or fewer differ) through a table of that size: members
that are one bit apart, or that meet in a value one bit from both, fall into one set,
found without comparing all pairs; each set emits links to its smallest member.

Copies and equal fingerprints are one row before the index, so large groups of copies
cost nothing there. Components are found by star contractions (``components``).

Defined results: a null text counts as empty; a text without words has fingerprint
zero and is linked like any other; a text of one or two words has one shingle, the
whole sequence; rows with a null ``doc_id`` get a fingerprint and their component's
smallest known id (null if it has none); repeated rows each get a result; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.components import connected_components
from squall.llm.shards import map_rows
from squall.llm.text import free_name, whole
from squall.llm.work import marked, masks, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
#: shingles hashed and counted at once, so that a very long text needs no more memory
BLOCK = 1 << 14


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters, ASCII white space
    if not words:
        return 0
    n = min(n, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    ends = (ends - 1).tolist()
    total = len(words) - n + 1
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        spans = zip(starts[at : min(at + BLOCK, total)], ends[at + n - 1 :])
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > total, bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of each row; fp holds the 64 bits, read as a signed integer."""

    def each():
        return lambda doc_id, text: ((doc_id, _signed(fingerprint(text, n))),)

    return map_rows(docs.select("doc_id", "text"), "doc_id long, fp long", each)


def _masks(shared: int) -> list[int]:
    """The mask of the shared bytes for each choice of ``shared`` positions."""
    return [sum(0xFF << (8 * p) for p in keep) for keep in combinations(range(BYTES), shared)]


def _linked(rest: np.ndarray, width: int, max_bits: int) -> np.ndarray:
    """The smallest member each of the distinct ``rest`` values reaches over steps of at most ``max_bits`` bits.

    ``label`` holds, per value of ``width`` bits, the smallest member known near it.
    Members spread their label over one bit flip at a time.
    """
    span = 1 << width
    none = span
    flips = [1 << b for b in range(width)]
    index = np.arange(span)
    mine = rest.copy()
    while True:
        label = np.full(span, none)
        label[rest] = mine
        for _ in range(max_bits):
            label = np.minimum.reduce([label, *(label[index ^ f] for f in flips)])
        new = label[rest]
        if (new == mine).all():
            return mine
        mine = new


def _pairwise(rest: np.ndarray, max_bits: int) -> np.ndarray:
    """As :func:`_linked`, for a few members: every two are compared."""
    near = np.bitwise_count(rest[:, None] ^ rest[None, :]) <= max_bits
    mine = rest.copy()
    while True:
        new = np.where(near, mine[None, :], np.iinfo(rest.dtype).max).min(axis=1)
        if (new == mine).all():
            return mine
        mine = new


def _links(fps: np.ndarray, choices: np.ndarray, masks: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its set) within whole lists, sorted by list.

    Members of a list share its positional bytes, so every pair in it has the least
    tally; what is left to verify are the bits of the other bytes.
    """
    a, b = [], []
    cut = np.flatnonzero((choices[1:] != choices[:-1]) | ((fps ^ np.roll(fps, 1))[1:] & masks[choices[1:]] != 0)) + 1
    for lo, hi in zip([0, *cut], [*cut, len(fps)]):
        if hi - lo < 2:
            continue
        members = np.unique(fps[lo:hi])
        other = ~masks[choices[lo]]
        shifts = [s for s in range(0, 64, 8) if (int(other) >> s) & 0xFF]
        rest = np.zeros(len(members), np.int64)
        for k, s in enumerate(shifts):
            rest |= ((members >> np.uint64(s)) & np.uint64(0xFF)).astype(np.int64) << (8 * k)
        mine = _pairwise(rest, max_bits) if len(rest) <= 512 else _linked(rest, 8 * len(shifts), max_bits)
        order = np.argsort(rest)
        least = members[order][np.searchsorted(rest[order], mine)]
        far = least != members
        a.append(members[far])
        b.append(least[far])
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) links that join every two of the distinct ``fp`` within ``max_bits`` bits, directly or in steps."""
    choices = _masks(BYTES - max_bits)
    masks = np.array(choices, dtype=np.uint64)
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in choices))
    listed = distinct.select("fp", F.posexplode(keys).alias("choice", "key"))
    lists = listed.repartition("choice", "key").sortWithinPartitions("choice", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last, perhaps unfinished, list
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            choice = batch.column("choice").to_numpy(zero_copy_only=False)
            if held is not None:
                fps, choice = np.concatenate([held[0], fps]), np.concatenate([held[1], choice])
            if not len(fps):
                continue
            last = (choice == choice[-1]) & ((fps ^ fps[-1]) & masks[choice[-1]] == 0)
            begin = len(fps) - int(last.sum())
            held = fps[begin:], choice[begin:]
            if begin:
                yield _arrow(*_links(fps[:begin], choice[:begin], masks, max_bits))
        if held is not None:
            yield _arrow(*_links(*held, masks, max_bits))

    return lists.select("choice", "fp").mapInArrow(run, "a long, b long")


def _arrow(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _least(prints: DataFrame, place: Column, max_bits: int) -> DataFrame:
    """(fp, least, rows) by fingerprint: the smallest ``place`` in its component, and the component's rows."""
    distinct = prints.groupBy("fp").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("rows"))
    distinct = written(distinct, "distinct-fingerprints")
    parts = connected_components(links(distinct.select("fp", "least"), max_bits))
    named = distinct.join(parts, distinct["fp"] == parts["node"], "left")
    named = written(named.select("fp", "least", "rows", F.coalesce("component", "fp").alias("component")), "components")
    least = named.groupBy("component").agg(F.min("least").alias("least"), F.sum("rows").alias("rows"))
    return named.select("fp", "component").join(least, "component").select("fp", "least", "rows")


def simhash(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    prints = written(fingerprints(docs, n), "fingerprints")
    ids = _least(prints, F.col("doc_id"), max_bits).select("fp", F.col("least").alias("component_id"))
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` of each component: of its smallest id, null ids last, and of this id's smallest text hash.

    Only rows whose id may go, or that stand there more than once, are shuffled.
    """
    i, h, gone, mark, own = free_name(docs, "_i", "_h", "_gone", "_mark", "_own")
    text_key = F.xxhash64(whole("text"))

    def each():
        return lambda doc_id, k, text: ((doc_id, k, _signed(fingerprint(text, n))),)

    keyed = docs.select("doc_id", text_key.alias("k"), "text")
    prints = written(map_rows(keyed, "doc_id long, k long, fp long", each), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    least = _least(prints, place, max_bits).where("rows > 1").select("fp", "least")
    rows = prints.groupBy("doc_id", "k", "fp").agg(F.count(F.lit(1)).alias("again"))
    judged = rows.join(least, "fp").select("doc_id", "k", "again", (~place.eqNullSafe(F.col("least"))).alias("gone"))
    judged = written(judged.where("gone OR again > 1").select("doc_id", "k", "gone"), "copies")
    known = marked(docs, "doc_id", written(masks(judged, "doc_id"), "masks"), mark)
    some = known.where(F.col(mark)).withColumn(own, text_key)
    named = judged.select(F.col("doc_id").alias(i), F.col("k").alias(h), F.col("gone").alias(gone))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(own) == F.col(h))
    once = some.join(named, same, "left_anti")
    first = some.join(named.where(~F.col(gone)), same, "left_semi").dropDuplicates(["doc_id", own])
    parts = [known.where(~F.col(mark)), once, first]
    return reduce(DataFrame.unionByName, [p.select(*docs.columns) for p in parts])
