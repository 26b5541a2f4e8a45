"""Quality rules: counted rules per document, then a hashed n-gram log-likelihood
ratio between the trusted documents and the whole corpus.

Words are hashed (1-grams and 2-grams) into ``buckets`` features. Two multinomials
over the buckets are counted in one pass: the raw corpus (every document) and the
trusted target (documents whose label says quality 1 and toxic 0, however many there
are). A document's score is the mean over its features of
``ln p_target - ln p_raw`` (add-one smoothing), summed in whole millionths, so that
the sum does not depend on the order of rows. Every trusted document is used once:
those in one half by hashed id make the target; those in the other half, unseen by
it, set the threshold: their ``tail`` quantile, exact, lowered by ``slack`` times the
distance from their median. Every document at or above the threshold is kept: nothing
is drawn at random.

Everything is DataFrame functions. These shuffles carry data that grows: the texts
that may be in the target, to meet its ids; one row per (task, bucket) for the counts;
and of the scores, which are written once, the ids and means of the other half. The
ratios (an array of ``buckets`` numbers) are written once and broadcast.

Defined results: a null text counts as empty; an empty text fails the rules; rows
are judged one by one, so repeated rows each get a result; a null ``doc_id`` is
carried; without a trusted label in each half the rules alone decide; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.text import SPACE, free_name, whole, words
from squall.llm.work import marked, masks, written

BUCKETS = 1 << 14
#: the held-out half's quantile that sets the threshold, and how far below it, as a part of its distance from the median
TAIL = 0.002
SLACK = 0.25
MICRO = 1_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RULE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at the given ascending starts."""
    step = lambda acc, p: F.struct(
        p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")
    )
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(starts, start, step, lambda acc: acc["n"])


def with_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counted rules of each row, ``_k``, its text's hash, and ``_hw``, those of its words.

    ``n_repeat_words`` counts the words inside 3-word windows that occur twice or
    more in the document: the windows' hashes are sorted with their positions, and
    a window equal to a neighbour in that order is a repeated one.
    """
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{SPACE}]"))
    split = docs.select("doc_id", whole("text").alias("_text")).select(
        "doc_id", F.xxhash64("_text").alias("_k"), "_text", words(text).alias("_words"), lines.alias("_lines")
    )
    hashed = split.select(
        "doc_id",
        "_k",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hw"),
    )
    hw = F.col("_hw")
    window = F.transform(
        F.slice(hw, 1, F.greatest(F.size(hw) - 2, F.lit(0))),
        lambda h, i: F.struct(F.xxhash64(h, F.get(hw, i + 1), F.get(hw, i + 2)).alias("h"), i.alias("p")),
    )
    ordered = hashed.withColumn("_win", F.sort_array(window))
    win = F.col("_win")
    again = F.filter(
        win,
        lambda x, i: F.coalesce(F.get(win, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(win, i + 1)["h"] == x["h"], F.lit(False)),
    )
    starts = ordered.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["p"])))
    counted = starts.withColumn("n_repeat_words", _covered(F.col("_starts")).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    return counted.withColumn("base_failed", failed).select("doc_id", "_k", *RULE_COLUMNS, "_hw")


def _features(hw: Column, buckets: int) -> Column:
    """Buckets of the 1-grams and 2-grams of a document."""
    one = F.transform(hw, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(
        F.slice(hw, 1, F.greatest(F.size(hw) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(hw, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, held): all trusted ids, once each, in two halves that are always the same."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 1)


def _with_target(texts: DataFrame, target: DataFrame) -> DataFrame:
    """``_good`` (1 if the row's id is in ``target``, else null) and the text of every row."""
    # only rows whose id may be in the target are shuffled; the ids make the hashed side, so texts are not sorted
    known = marked(texts, "doc_id", written(masks(target, "doc_id"), "masks"), "_may")
    may = F.col("_may") & F.col("doc_id").isNotNull()
    ids = target.select("doc_id", F.lit(1).alias("_good")).hint("shuffle_hash")
    met = known.where(may).join(ids, "doc_id", "left").select("_good", "text")
    return met.unionByName(known.where(~may).select(F.lit(None).cast("int").alias("_good"), "text"))


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, micros): the log ratio of each bucket in millionths; at most ``buckets`` rows."""
    hw = F.transform(words(whole("text")), lambda w: F.xxhash64(w))
    hashed = _with_target(docs.select("doc_id", "text"), trusted.where(~F.col("held"))).select("_good", hw.alias("_hw"))
    counts = (
        hashed.select("_good", F.explode(_features(F.col("_hw"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_good").alias("good"))
    )
    # at most `buckets` rows from here on
    everything = Window.partitionBy()
    ratio = F.log((F.col("good") + 1) / (F.sum("good").over(everything) + buckets)) - F.log(
        (F.col("raw") + 1) / (F.sum("raw").over(everything) + buckets)
    )
    return counts.select("bucket", F.round(ratio * MICRO).cast("long").alias("micros"))


def _weights(ratios: DataFrame, buckets: int) -> DataFrame:
    """One row, ``_micros``: the ratios by bucket as an array, 0 for buckets that no document has."""
    every = ratios.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    pairs = F.struct("bucket", F.coalesce("micros", F.lit(0)).alias("micros"))
    ordered = F.sort_array(F.collect_list(pairs))  # `buckets` numbers
    return every.join(F.broadcast(ratios), "bucket", "left").agg(F.transform(ordered, lambda p: p["micros"]).alias("_micros"))


def _scored(docs: DataFrame, weights: DataFrame, buckets: int) -> DataFrame:
    """doc_id, ``_k``, the counted rules, ``score_micros`` and ``n_features`` of each row."""
    rules = with_rules(docs).withColumn("_features", _features(F.col("_hw"), buckets))
    score = F.aggregate("_features", F.lit(0).cast("long"), lambda acc, b: acc + F.get(F.col("_micros"), b))
    return rules.crossJoin(F.broadcast(weights)).select(  # one row
        "doc_id",
        "_k",
        *RULE_COLUMNS,
        score.alias("score_micros"),
        F.size("_features").cast("long").alias("n_features"),
    )


def quantiles(rows: DataFrame, column: str, parts: Sequence[float]) -> DataFrame:
    """One row with ``q0``, ``q1`` ...: the exact quantiles of a column, interpolated as ``percentile`` does it.

    Equal values are counted first. The different ones are dealt out by ranges, and only
    the ranges that hold a wanted place are put in order, so no task holds them all.
    Nulls are left out; without values the quantiles are null.
    """
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    dealt = written(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "values")
    # one row per range
    sizes = dealt.groupBy("part").agg(F.sum("n").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.select(
        "part",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"),
        "size",
        F.sum("size").over(Window.partitionBy()).alias("total"),
    )
    places = [(F.col("total") - 1) * F.lit(float(p)) for p in parts]

    def holds(start: Column, size: Column, place: Column) -> Column:
        return (start <= place) & (place < start + size)

    wanted = F.lit(False)
    for place in (f(p) for p in places for f in (F.floor, F.ceil)):
        wanted = wanted | holds(F.col("start"), F.col("size"), place)
    own = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(F.broadcast(ranges.where(wanted)), "part").select(
        "v", "n", "total", (F.col("start") + F.coalesce(F.sum("n").over(own), F.lit(0))).alias("first")
    )
    found = []
    for i, place in enumerate(places):
        low, high = (F.max(F.when(holds(F.col("first"), F.col("n"), f(place)), F.col("v"))) for f in (F.floor, F.ceil))
        up, down = F.max(place - F.floor(place)), F.max(F.ceil(place) - place)
        found.append(F.when(low == high, low).otherwise(down * low + up * high).alias(f"q{i}"))
    return placed.agg(*found)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    tail: float = TAIL,
    slack: float = SLACK,
) -> DataFrame:
    """Per row of ``docs``: doc_id, the counted rules, ``kept``, ``score_micros``, ``n_features``.

    ``score_micros`` is the sum of the log ratios of the document's features in
    millionths and ``n_features`` their number.
    """
    return _judged(docs, labels, buckets, tail, slack).drop("_k")


def _judged(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    tail: float = TAIL,
    slack: float = SLACK,
) -> DataFrame:
    """:func:`quality`, with ``_k``, the hash of the text."""
    trusted = written(trusted_ids(labels), "trusted")
    weights = written(_weights(log_ratios(docs, trusted, buckets), buckets), "ratios")
    scored = written(_scored(docs, weights, buckets), "scores")  # one short row per document
    mean = F.col("score_micros") / F.col("n_features")
    sound = scored.where(~F.col("base_failed")).select("doc_id", mean.alias("mean"))
    held = sound.join(trusted.where("held"), "doc_id", "left_semi")
    low, mid = F.col("q0"), F.col("q1")
    threshold = quantiles(held, "mean", (tail, 0.5)).select((low - slack * (mid - low)).alias("threshold")).scalar()
    kept = ~F.col("base_failed") & (threshold.isNull() | (mean >= threshold))
    return scored.select("doc_id", "_k", *RULE_COLUMNS, kept.alias("kept"), "score_micros", "n_features")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with all their columns.

    Decisions are tied to rows by id, null or not, and text.
    """
    i, k, own, mark = free_name(docs, "_i", "_k", "_own", "_mark")
    rejected = _judged(docs, labels, **options).where(~F.col("kept")).select(F.col("doc_id").alias(i), F.col("_k").alias(k))
    rejected = written(rejected.distinct(), "rejected")
    # only rows whose id is among the rejected are shuffled
    known = marked(docs, "doc_id", written(masks(rejected, i), "masks"), mark)
    some = known.where(F.col(mark)).withColumn(own, F.xxhash64(whole("text")))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(own) == F.col(k))
    kept = some.join(rejected, same, "left_anti")
    return known.where(~F.col(mark)).select(*docs.columns).unionByName(kept.select(*docs.columns))
