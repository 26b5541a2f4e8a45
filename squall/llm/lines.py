"""Line dedup: drop every line that equals, or is within one word edit of, an earlier line.

A line is its words joined by one space; lines without a word are never dropped.
"Earlier" orders lines by (doc_id, line number) over the whole table, nulls first.
A line goes if an earlier line has the same words, or differs by one inserted,
deleted or replaced word where the longer line has at least ``MIN_WORDS`` words
(so that the two agree on four fifths or more). The earliest always stays.

Method, a deletion-neighbourhood join:

1. Equal lines meet by a 128-bit hash; each distinct line keeps its first place.
2. Two lines within one edit agree on the first or on the last half of the shorter
   one's words. Only lines that share such an end with a different line go on; this
   loses no pair.
3. They emit, as hashed keys, themselves and every variant with one word deleted. A
   variant's key is a sum of hashes of (word, place), so that all variants of a line
   come from two running sums, in time linear in its length.
4. Equal keys mark the neighbours: equal variants with the same deleted place (a
   replacement), or a variant equal to a whole line (an insertion). Within a class
   every line is within one edit of the class's earliest one, so each class needs a
   minimum, not its pairs; Spark pre-aggregates it before the shuffle.
5. Each hit is verified on the words: common prefix and common suffix must cover the
   longer line but for one word.

Everything is DataFrame functions. A line that a third of all documents share is one
row after the first partial aggregation.

Defined results: a null text counts as empty and comes back as empty text; rows with
the same id and text are the same lines at the same place, so none of them removes
the other's; a null ``doc_id`` sorts first; a document may lose all its lines and
then keeps its row with empty text, or blank lines only; an empty table gives an empty
result; other columns are carried by :func:`dedup_lines` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.text import free_name, squeeze, whole
from squall.llm.work import marked, masks, written

MIN_WORDS = 5
#: a line is common if more than one in so many occurrences is its own
COMMON = 1000
LINE = ["h1", "h2"]

def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with words: doc_id, k (hash of the text), line_no, line, h1, h2."""
    text = F.col("whole")
    uneven = text.startswith(" ") | text.endswith(" ")
    for blanks in ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c"):
        uneven = uneven | text.contains(blanks)
    # one row per text first: what stands beside a generator is worked out for each row that it makes
    whole_ = docs.select("doc_id", whole("text").alias("whole"))
    known = whole_.select("doc_id", F.xxhash64("whole").alias("k"), uneven.alias("uneven"), F.split(text, "\n").alias("raws"))
    split = known.select("doc_id", "k", "uneven", F.posexplode("raws").alias("line_no", "raw"))
    line = F.when(F.col("uneven"), squeeze(F.col("raw"))).otherwise(F.col("raw"))
    lines = split.select("doc_id", "k", "line_no", line.alias("line")).where(F.col("line") != "")
    return lines.select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of a line's first and last words, about half of them.

    Their number depends on the length in steps of four words, from two on, and is at
    most half the shorter line of a pair; a length at the start of a step also emits the
    keys of the step before, for its pairs with lines one word shorter.
    """

    def ends(size: Column) -> list[Column]:
        part = lambda sign: F.call_function("substring_index", line, F.lit(" "), size * sign)
        return [F.xxhash64(F.lit(side), size, part(sign)) for side, sign in ((0, 1), (1, -1))]

    step = (F.floor(n / 4) * 2).cast("int")
    none = F.array().cast("array<bigint>")
    before = (n >= 2 * (MIN_WORDS - 1)) & (n % 4 == 0)
    return F.when(n < MIN_WORDS - 1, none).when(before, F.array(*ends(step), *ends(step - 2))).otherwise(F.array(*ends(step)))


def _occurrences(docs: DataFrame) -> DataFrame:
    n = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    lines = _lines(docs).withColumn("n", n)
    return lines.select(*LINE, "doc_id", "k", "line_no", _half_keys(F.col("line"), F.col("n")).alias("halves"))


def _sharing(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that share a half with a different line."""
    keys = lines.select(*LINE, F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("half")
    shared = written(shared, "halves")
    near = marked(keys, "half", written(masks(shared, "half"), "masks"), "met").where("met").drop("met")
    return near.join(shared, "half", "left_semi").select(*LINE).distinct()


def _distinct(occurrences: DataFrame) -> DataFrame:
    """Distinct lines that occur again or share a half: first place, places, sharing.

    Occurrences become one row per line first, so that a line of a third of all
    documents weighs nothing when halves meet.
    """
    place = F.struct("doc_id", "line_no")
    lines = occurrences.groupBy(*LINE).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("places"), F.first("halves").alias("halves")
    )
    lines = written(lines, "all-lines")
    sharing = _sharing(lines).withColumn("sharing", F.lit(True))
    return lines.drop("halves").join(sharing, LINE, "left").where("sharing OR places > 1")


def _near_lines(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """The distinct lines that share a half with another one: h1, h2, first, line."""
    first = distinct.where("sharing").select(
        *LINE, F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no")
    )
    texts = docs.select("doc_id", "text")
    some = marked(texts, "doc_id", written(masks(first, "doc_id"), "masks"), "needed").where("needed").drop("needed")
    lines = marked(_lines(some), "h1", written(masks(first, "h1"), "masks"), "needed").where("needed")
    at, of = lines.alias("at"), first.alias("of")
    same = (F.col("at.h1") == F.col("of.h1")) & (F.col("at.h2") == F.col("of.h2"))
    same &= F.col("at.doc_id").eqNullSafe(F.col("of.doc_id")) & (F.col("at.line_no") == F.col("of.line_no"))
    found = at.join(of, same, "left_semi").select(*LINE, F.struct("doc_id", "line_no").alias("first"), "line")
    return found.dropDuplicates(LINE)  # rows repeated with id and text


def _variants(near: DataFrame) -> DataFrame:
    """A row per whole line (gone = -1) and per variant without the word at ``gone``.

    ``key`` hashes two sums over the n remaining words, of 40 and 24 bits of a hash of
    (word, place). Lines are dealt out before they are taken apart, so that the running
    sums need no further shuffle.
    """
    words = near.select(*LINE, "line").repartition(*LINE).select(*LINE, F.posexplode(F.split("line", " ")).alias("i", "w"))
    here, moved = F.xxhash64("w", "i"), F.xxhash64("w", F.col("i") - 1)
    parts = words.select(
        *LINE, "i",
        F.shiftrightunsigned(here, 24).alias("a0"), F.shiftrightunsigned(moved, 24).alias("a1"),
        here.bitwiseAND(0xFFFFFF).alias("b0"), moved.bitwiseAND(0xFFFFFF).alias("b1"),
    )
    line = Window.partitionBy(*LINE)
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.select(
        *LINE, "i", *(F.sum(c).over(upto).alias(f"{c}_to") for c in ("a0", "a1", "b0", "b1")),
        *(F.sum(c).over(line).alias(f"{c}_all") for c in ("a0", "a1", "b0", "b1")), "a0", "b0",
        F.count(F.lit(1)).over(line).cast("int").alias("size"),
    )

    def without(c: str) -> Column:
        return F.col(f"{c}0_to") - F.col(f"{c}0") + F.col(f"{c}1_all") - F.col(f"{c}1_to")

    def variant(gone: Column, a: Column, b: Column, n: Column) -> Column:
        return F.struct(gone.alias("gone"), n.alias("n"), F.xxhash64(a, b, n).alias("key"))

    one = variant(F.col("i"), without("a"), without("b"), F.col("size") - 1)
    all_ = variant(F.lit(-1), F.col("a0_all"), F.col("b0_all"), F.col("size"))
    emitted = F.when(F.col("i") == 0, F.array(one, all_)).otherwise(F.array(one))
    return sums.select(*LINE, emitted.alias("emitted")).select(*LINE, F.inline("emitted"))


def _hits(near: DataFrame) -> DataFrame:
    """(h1, h2, first, witness): an earlier line that shares a key."""
    variants = written(_variants(near), "variants")
    again = variants.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key")
    again = written(again, "keys")
    met = marked(variants, "key", written(masks(again, "key"), "masks"), "met").where("met").drop("met")
    met = written(met.join(again, "key").join(near.select(*LINE, "first"), LINE), "met")
    classes = met.groupBy("key", "n", "gone").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("lines"))
    classes = classes.where(f"n >= {MIN_WORDS - 1}")
    replaced = classes.where("lines > 1 AND gone >= 0").select("key", "n", "gone", "least")
    whole_, cut = F.when(F.col("gone") < 0, F.col("least")), F.when(F.col("gone") >= 0, F.col("least"))
    added = classes.groupBy("key", "n").agg(F.min(whole_).alias("whole"), F.min(cut).alias("cut"))
    by_word = met.join(replaced, ["key", "n", "gone"]).select(*LINE, "first", F.col("least").alias("witness"))
    other = F.when(F.col("gone") < 0, F.col("cut")).otherwise(F.col("whole"))
    by_length = met.join(added, ["key", "n"]).select(*LINE, "first", other.alias("witness"))
    return by_word.unionByName(by_length).where("witness < first").distinct()


def _within_one_edit(x: Column, y: Column) -> Column:
    """Whether two different arrays of words are one edit apart."""

    def common(u: Column, v: Column) -> Column:
        return F.array_position(F.zip_with(u, v, lambda p, q: p.eqNullSafe(q)), False) - 1

    return common(x, y) + common(F.reverse(x), F.reverse(y)) >= F.greatest(F.size(x), F.size(y)) - 1


def near_duplicates(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one edit."""
    near = written(_near_lines(distinct, docs), "near-lines")
    hits = _hits(near)
    own = near.select(*LINE, F.split("line", " ").alias("own"))
    place = [F.col("first.doc_id").alias("d"), F.col("first.line_no").alias("p")]
    earlier = near.select(*place, F.split("line", " ").alias("earlier"))
    pairs = hits.select(*LINE, F.col("witness.doc_id").alias("wd"), F.col("witness.line_no").alias("wp")).join(own, LINE)
    pairs = pairs.join(earlier, F.col("wd").eqNullSafe(F.col("d")) & (F.col("wp") == F.col("p")))
    return pairs.where(_within_one_edit(F.col("own"), F.col("earlier"))).select(*LINE).distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, k, gone): per text that loses lines, the numbers of these lines.

    Fewer than ``COMMON`` lines can each make up more than one in ``COMMON`` of all
    occurrences; these are broadcast to their occurrences, which stay where they are.
    """
    occurrences = written(_occurrences(docs), "lines")
    distinct = written(_distinct(occurrences), "distinct-lines")
    near = near_duplicates(distinct, docs).withColumn("near", F.lit(True))
    judged = distinct.select(*LINE, "first", "places").join(near, LINE, "left").where("near OR places > 1")
    common = F.col("places") * COMMON > occurrences.count()
    judged = written(judged.select(*LINE, "first", F.coalesce("near", F.lit(False)).alias("near"), common.alias("common")), "judged")
    goes = F.col("near") | ~F.struct("doc_id", "line_no").eqNullSafe(F.col("first"))
    places = occurrences.select("doc_id", "k", "line_no", *LINE)
    everywhere = F.broadcast(judged.where("common").drop("common"))  # fewer than COMMON rows
    rest = places.join(everywhere.select(*LINE), LINE, "left_anti").join(judged.where("NOT common").drop("common"), LINE)
    gone = places.join(everywhere, LINE).unionByName(rest).where(goes)
    return gone.groupBy("doc_id", "k").agg(F.collect_set("line_no").alias("gone"))


def dedup_lines(docs: DataFrame, lines: str = "n_lines", removed: str = "n_removed") -> DataFrame:
    """``docs`` with the remaining text, and the numbers of lines and of removed lines.

    The two counts are added under the given names; a column of ``docs`` with such a
    name is replaced. Only texts whose id may lose lines are shuffled to meet them.
    """
    cuts = written(removed_lines(docs), "cuts")
    d, k, gone, own, mark = free_name(docs, "_d", "_k", "_gone", "_own", "_mark")
    named = cuts.select(F.col("doc_id").alias(d), F.col("k").alias(k), F.col("gone").alias(gone))
    known = marked(docs, "doc_id", written(masks(cuts, "doc_id"), "masks"), mark)
    text = whole("text")
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(k))
    joined = known.where(F.col(mark)).withColumn(own, F.xxhash64(text)).join(named, same, "left")
    parts = F.split(text, "\n")
    size = (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = F.transform(F.array(parts), lambda p: F.array_join(F.transform(left, lambda i: F.get(p, i)), "\n"))[0]
    same_columns = [c for c in docs.columns if c not in ("text", lines, removed)]

    def result(rows: DataFrame, kept: Column, gone: Column) -> DataFrame:
        return rows.select(*same_columns, kept.alias("text"), size.alias(lines), gone.cast("long").alias(removed))

    untouched = result(known.where(~F.col(mark)), text, F.lit(0))
    changed = F.when(F.col(gone).isNull(), text).otherwise(kept)
    return result(joined, changed, F.coalesce(F.size(gone), F.lit(0))).unionByName(untouched)


#: Plain twin: lists of words instead of hashes, every pair within a variant compared.
ORACLE_SQL = """
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), raw AS (
    SELECT doc_id, text, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM split
), words AS (
    SELECT doc_id, text, line, line_no,
           list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM raw
), firsts AS (
    SELECT w, min((doc_id, line_no)) AS first FROM words WHERE len(w) > 0 GROUP BY w
), long AS (
    SELECT w, first, len(w) AS n FROM firsts WHERE len(w) >= 4
), cut AS (
    SELECT w, first, n, i, w[1:i - 1] || w[i + 1:] AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM long)
), near AS (
    SELECT a.w FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND b.first < a.first WHERE a.n >= 5
    UNION
    SELECT a.w FROM cut a JOIN long b ON a.v = b.w AND b.first < a.first WHERE a.n >= 5
    UNION
    SELECT b.w FROM cut a JOIN long b ON a.v = b.w AND a.first < b.first WHERE a.n >= 5
), judged AS (
    SELECT words.*, len(words.w) > 0 AND (near.w IS NOT NULL OR (doc_id, line_no) <> first) AS gone
    FROM words LEFT JOIN firsts ON words.w = firsts.w LEFT JOIN near ON words.w = near.w
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed
FROM judged GROUP BY doc_id, judged.text
"""
