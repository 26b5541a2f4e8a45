"""Repeated byte strings: maximal repeats of at least ``LENGTH`` bytes with all occurrences.

Texts are UTF-8 bytes; a repeat never crosses documents but may lie in one. An
enhanced suffix array over every byte of the corpus would need a sort of all suffixes;
a sparse one over content-defined anchors finds the same repeats:

1. Every window of ``LENGTH`` bytes has an anchor (``anchors``); equal windows have
   equal anchors, with the same ``GRAM`` bytes behind them. Windows that share an anchor
   form a segment around it. Segments are known by a 128-bit hash; the texts stay put.
2. A gram that occurs once has no repeat. A segment that occurs again is a repeat from
   end to end, whatever else its gram meets; large groups of copies end here, as counts.
3. Grams with different segments: one text per segment is fetched, and the segments of a
   gram are sorted by what follows the anchor. This is the suffix array of the anchors,
   with the common prefixes of neighbours. A stack scan yields its tree of common-prefix
   intervals. For every interval the left extensions are tested: sorted by what precedes
   the anchor, a second scan yields the subsets that agree further to the left. A subset
   whose left and right agreement add up to ``LENGTH`` and whose right extensions differ
   is a maximal repeat group, with all its occurrences.
4. A gram with over ``GROUP`` different segments (a passage in that many different
   surroundings) is not put into one task: the windows of its segments are counted by
   hash instead, in Spark, which finds the same repeats.

A repeated byte is one covered by a repeated window; the windows at an anchor cover one
stretch around it, so each occurrence gets one span.

Bytes say little about passages: 51 words may have 280 bytes or 500. So the same search
also runs over word codes (``WORD_BYTES`` bytes of a checksum per word, words being runs
of characters other than white space), for passages of ``WORDS`` words or more that
start elsewhere too, and each row can state how many of its words they cover
(``n_repeat_words``) and whether there are any (``has_repeat``). Nothing is removed for
their sake.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` bytes have
no repeats; repeated rows are separate documents, so their strings of that length all
occur elsewhere; a null ``doc_id`` is carried; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.anchors import Anchors
from squall.llm.shards import map_rows
from squall.llm.text import whole
from squall.llm.work import marked, masks, written

LENGTH = 400
GRAM = 200
GROUP = 20_000
#: words of a repeated passage, and bytes that stand for a word
WORDS = 50
WORD_BYTES = 3

TEXT = ["doc_id", "k"]
ANCHORS = "doc_id long, k long, gram long, segment long, times long, place long, left int, right int"
SEGMENTS = "gram long, segment long, left int, right int, bytes binary"


def texts(docs: DataFrame) -> DataFrame:
    """doc_id, k (hash of the text) and the text's bytes."""
    coded = dict(docs.dtypes)["text"] == "binary"
    text = F.coalesce("text", F.lit(bytearray())) if coded else whole("text")
    return docs.select("doc_id", F.xxhash64(text).alias("k"), text.cast("binary").alias("bytes"))


def _arrow(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(c, type=kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The columns of ``ANCHORS``: a row per text, gram and segment, with how often it occurs there.

    Occurrences of a segment that comes again within a piece of text are covered for
    certain; they are returned as rows without a gram whose span is ``place - left`` to
    ``place + right``, neighbours merged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors(length, gram)
        for batch in batches:
            ids, ks = batch.column("doc_id"), batch.column("k")
            for a in find(x.as_py() for x in batch.column("bytes")):
                order = np.lexsort((a.segment, a.gram, a.text))
                t, g, s = a.text[order], a.gram[order], a.segment[order]
                new = np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                one = order[first]
                rows = (a.text[one], a.gram[one].view(np.int64), a.segment[one].view(np.int64), times, a.place[one], a.left[one], a.right[one])
                yield _emit(ids, ks, *rows)
                again = np.sort(order[np.repeat(times, times) > 1])
                if len(again):
                    t, begin, stop = a.text[again], a.place[again] - a.left[again], a.place[again] + a.right[again]
                    cut = np.concatenate([[True], (t[1:] != t[:-1]) | (begin[1:] > stop[:-1])])
                    first = np.flatnonzero(cut)
                    size = stop[np.append(first[1:], len(t)) - 1] - begin[first]
                    none, zero = np.zeros(len(first), np.int64), np.zeros(len(first), np.int32)
                    yield _emit(ids, ks, t[first], None, none, none, begin[first], zero, size)

    def _emit(ids, ks, text, grams, *rest) -> pa.RecordBatch:
        at = pa.array(text)
        grams = pa.nulls(len(text), pa.int64()) if grams is None else grams
        return _arrow(ANCHORS, [ids.take(at), ks.take(at), grams, *rest])

    return texts(docs).mapInArrow(run, ANCHORS)


def candidates(rows: DataFrame) -> DataFrame:
    """The anchors whose gram occurs again; ``mixed``: in different segments."""
    found = rows.where("gram IS NOT NULL")
    grams = found.groupBy("gram").agg(F.sum("times").alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi"))
    grams = written(grams.where("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("mixed")), "grams")
    near = marked(found, "gram", written(masks(grams, "gram"), "masks"), "again").where("again").drop("again")
    return near.join(grams, "gram")


def segment_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The columns of ``SEGMENTS`` for rows with doc_id, k, gram, segment, place, left, right."""
    place = F.struct("gram", "segment", "place", "left", "right")
    by_text = written(wanted.groupBy(*TEXT).agg(F.collect_list(place).alias("places")), "places")
    some = marked(docs.select("doc_id", "text"), "doc_id", written(masks(by_text, "doc_id"), "masks"), "needed")
    held, at = texts(some.where("needed")).alias("held"), by_text.alias("at")
    same = F.col("held.doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("held.k") == F.col("at.k"))
    joined = held.join(at, same).select("bytes", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, places in zip(batch.column("bytes"), batch.column("places")):
                text, places = text.as_py(), places.as_py()
                cut = [text[p["place"] - p["left"] : p["place"] + p["right"]] for p in places]
                yield _arrow(SEGMENTS, [*([p[c] for p in places] for c in ("gram", "segment", "left", "right")), cut])

    return joined.mapInArrow(run, SEGMENTS).dropDuplicates(["gram", "segment"])  # rows repeated with id and text


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (value, first, last) of a sorted list, by a stack scan.

    ``common[i]`` is what entries i and i + 1 have in common; intervals of value 0 are left out.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*common, 0]):
        first = i
        while stack and stack[-1][0] > value:
            held, first = stack.pop()
            yield held, first, i
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def _sorted(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and the common prefixes of neighbours in it."""
    order = np.array(sorted(range(len(strings)), key=strings.__getitem__))
    sizes = np.array([len(strings[i]) for i in order])
    width = max(1, int(sizes.max()))
    grid = np.zeros((len(strings), width), np.uint8)
    for row, i in enumerate(order):
        grid[row, : sizes[row]] = np.frombuffer(strings[i], np.uint8)
    differ = grid[1:] != grid[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))


def repeat_groups(before: list[bytes], after: list[bytes], length: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Maximal repeats around one anchor: (members, bytes before it, bytes from it on).

    ``before`` and ``after`` are the different segments' bytes on either side. All members
    of a group agree on the two stretches, and no group can be extended on either side.
    """
    order, common = _sorted(after)
    left_order, left_common = _sorted([b[::-1] for b in before])
    left_rank = np.empty(len(order), np.int64)
    left_rank[left_order] = np.arange(len(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    for right, lo, hi in intervals(common.tolist()):
        ranks = np.sort(left_rank[order[lo : hi + 1]])
        # what left neighbours within the interval share
        shared = np.minimum.reduceat(left_common[: ranks[-1]], ranks[:-1])
        if shared.max() + right < length and right < length:
            continue
        found = list(intervals(shared.tolist()))
        if shared.min() == 0:  # those that agree on nothing before the anchor
            found.append((0, 0, hi - lo))
        for left, first, last in found:
            if left + right < length:
                continue
            members = left_order[ranks[first : last + 1]]
            at = rank[members]
            if common[at.min() : at.max()].min() == right:  # else a deeper interval has the same members
                yield members, left, right


def _reach(before: list[bytes], after: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per segment, how far repeats reach before the anchor and behind it; 0, 0: none."""
    left, right = np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
    for members, a, b in repeat_groups(before, after, length):
        left[members] = np.maximum(left[members], a)
        right[members] = np.maximum(right[members], b)
    return left, right


def reach(segments: DataFrame, length: int) -> DataFrame:
    """(gram, segment, left, right): how far repeats reach around the anchor of each segment that has any."""
    schema = "gram long, segment long, left int, right int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield from solve(held)
                    held = []
                held.append(row)
        if held:
            yield from solve(held)

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        left, right = _reach([r[4][: r[2]] for r in rows], [r[4][r[2] :] for r in rows], length)
        hit = np.flatnonzero(right)
        if len(hit):
            yield _arrow(schema, [[rows[i][0] for i in hit], [rows[i][1] for i in hit], left[hit], right[hit]])

    return segments.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, schema)


def reach_by_windows(segments: DataFrame, length: int) -> DataFrame:
    """As :func:`reach`, by counting the hashes of all windows: for grams in too many segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, segment, left, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                ends = range(length, len(text) + 1)
                both = [hashlib.blake2b(text[e - length : e], digest_size=16).digest() for e in ends]
                yield _arrow(
                    "gram long, segment long, offset int, window binary",
                    [[gram] * len(both), [segment] * len(both), [left - i for i in range(len(both))], both],
                )

    windows = segments.mapInArrow(run, "gram long, segment long, offset int, window binary")
    windows = written(windows, "windows")
    again = windows.groupBy("gram", "offset", "window").count().where("count > 1").drop("count")
    hit = windows.join(again, ["gram", "offset", "window"])
    return hit.groupBy("gram", "segment").agg(
        F.max("offset").alias("left"), (F.lit(length) - F.min("offset")).cast("int").alias("right")
    )


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc_id, k, start, stop): stretches of the texts that repeats cover; they may overlap."""
    rows = written(anchored(docs, length, gram), "anchors")
    found = written(candidates(rows), "repeated-anchors")
    place = F.struct("doc_id", "k", "place", "left", "right")
    kinds = found.groupBy("gram", "segment").agg(
        F.sum("times").alias("n"), F.first("mixed").alias("mixed"), F.first(place).alias("of")
    )
    kinds = written(kinds, "segments")
    span = [(F.col("place") - F.col("left")).alias("start"), (F.col("place") + F.col("right")).alias("stop")]
    within = rows.where("gram IS NULL").select(*TEXT, *span)
    copies = found.join(kinds.where("n > 1").select("gram", "segment"), ["gram", "segment"], "left_semi").select(*TEXT, *span)
    mixed = kinds.where("mixed")
    size = mixed.groupBy("gram").agg(F.count(F.lit(1)).alias("segments"))
    texts_ = written(segment_texts(docs, mixed.select("gram", "segment", "of.*")), "segment-texts")
    large = size.where(F.col("segments") > group).select("gram")
    reached = reach(texts_.join(large, "gram", "left_anti"), length)
    reached = reached.unionByName(reach_by_windows(texts_.join(large, "gram", "left_semi"), length))
    once = mixed.where("n = 1").select("gram", "segment", F.col("of.doc_id"), F.col("of.k"), F.col("of.place"))
    partly = once.join(reached, ["gram", "segment"]).select(*TEXT, *span)
    return within.unionByName(copies).unionByName(partly)


def merged(pairs: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping and touching stretches as one, in order."""
    out: list[list[int]] = []
    for start, stop in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def word_codes(docs: DataFrame) -> DataFrame:
    """doc_id, own (the ``k`` of its text) and text: the codes of its words, in order."""

    def each():
        def work(doc_id, own, text):
            words = text.split()  # ASCII white space
            codes = np.fromiter(map(zlib.crc32, words), "<u4", len(words))
            yield doc_id, own, codes.view(np.uint8).reshape(-1, 4)[:, :WORD_BYTES].tobytes()

        return work

    return map_rows(texts(docs), "doc_id long, own long, text binary", each)


def repeat_words(docs: DataFrame, words: int = WORDS, group: int = GROUP) -> DataFrame:
    """doc_id, k, words: how many words of a text passages cover that repeat; texts with any."""
    coded = written(word_codes(docs), "word-codes")
    size = words * WORD_BYTES
    found = spans(coded, size, size // 2, group).groupBy(*TEXT).agg(F.collect_set(F.struct("start", "stop")).alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, k, cut in zip(*(c.to_pylist() for c in batch.columns)):
                runs = merged([(p["start"], p["stop"]) for p in cut])
                rows.append((doc_id, k, sum(stop // WORD_BYTES - -(-start // WORD_BYTES) for start, stop in runs)))
            if rows:
                yield _arrow("doc_id long, k long, words long", list(zip(*rows)))

    counted = written(found.mapInArrow(run, "doc_id long, k long, words long"), "repeat-words")
    keyed = coded.select("doc_id", "own", F.xxhash64("text").alias("code"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.code") == F.col("b.k"))
    joined = keyed.alias("a").join(counted.alias("b"), same)
    return joined.select("a.doc_id", F.col("own").alias("k"), "words").distinct()


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, words: int | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Every byte that a repeat covers goes, wherever it occurs. With ``words``, two columns
    stand before ``kept``: n_repeat_words, how many words repeated passages of at least so
    many words cover, and has_repeat, whether there are any.
    """
    cut = spans(docs, length, gram, group).groupBy(*TEXT).agg(F.collect_set(F.struct("start", "stop")).alias("cut"))
    cut = cut.withColumn("words", F.lit(0).cast("long"))
    if words is not None:
        passages = repeat_words(docs, words, group).withColumn("cut", F.lit(None).cast(cut.schema["cut"].dataType))
        both = cut.unionByName(passages).groupBy(*TEXT)
        cut = both.agg(F.first("cut", ignorenulls=True).alias("cut"), F.max("words").alias("words"))
    cut = written(cut, "cuts")
    known = marked(docs.select("doc_id", "text"), "doc_id", written(masks(cut, "doc_id"), "masks"), "needed")
    held, at = texts(known.where("needed")).alias("held"), cut.alias("at")
    same = F.col("held.doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("held.k") == F.col("at.k"))
    joined = held.join(at, same, "left").select("held.doc_id", "bytes", "cut", F.coalesce("words", F.lit(0).cast("long")).alias("words"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, n_repeat_words long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, pairs, covered in zip(*(batch.column(c) for c in ("doc_id", "bytes", "cut", "words"))):
                text = text.as_py()
                gone = merged([(p["start"], p["stop"]) for p in pairs.as_py() or ()])
                ends = [0, *(x for g in gone for x in g), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                rows.append((doc_id.as_py(), len(text), len(text) - len(kept), len(gone), covered.as_py(), kept))
            if rows:
                yield _arrow(schema, list(zip(*rows)))

    untouched = texts(known.where("NOT needed")).select(
        "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"),
        *(F.lit(0).cast("long").alias(c) for c in ("n_removed", "n_spans", "n_repeat_words")), F.col("bytes").alias("kept"),
    )
    both = joined.mapInArrow(run, schema).unionByName(untouched)
    verdict = [] if words is None else ["n_repeat_words", (F.col("n_repeat_words") > 0).alias("has_repeat")]
    return both.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), *verdict, "kept")


def kept_text(column: Column) -> Column:
    """Remaining bytes as text; a character cut in half becomes a replacement sign."""
    return F.decode(column, "UTF-8")
