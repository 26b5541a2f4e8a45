"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens.

Base spans are the leftmost non-overlapping matches of three patterns (``assign``,
``access``, ``hex``). The method adds spans of kind ``random``: runs of 20 or more
characters of the base64 alphabets that look like draws from their alphabet.

Each such token's encoding is inferred (hexadecimal, base32, else base64). What is
base64 by this may come from a smaller alphabet and then looks far from uniform over 64
symbols; so it is also judged in the narrowest that holds it: hexadecimal in groups
(the separators left out), lower-case base32, base36 of either case, base58 or base62.
In one case, letters alone are not taken for these: they are words far more often. The
characters become values of the alphabet, and three tests give p-values under "the
characters are independent and uniform":

* chi-squared of the symbol counts (upper tail, by its mean and variance),
* Wald-Wolfowitz runs above and below the middle of the alphabet (both tails),
* serial correlation of neighbouring values (both tails).

A token of 20 to 30 characters is too short for 62 counts to say much, so alphabets with
more than hexadecimal letters are tested by groups of symbols as well (digits, signs, and
in either case the letters that words are mostly made of, and the others):

* chi-squared of the group counts (upper tail, by Wilson and Hilferty),
* serial coincidence: how often neighbours are of one group (upper tail).

Fisher's method combines them. Discoveries are controlled per class of encoding and
length (powers of two), over all tokens of the corpus: short tokens, where the tests say
little, are not judged by the many or few long ones.

1. Random tokens must not be lost: Benjamini-Hochberg decides which p-values are too
   small for them.
2. Others must not be reported: of random tokens half have a p-value above a half, where
   words hardly come, so twice their number estimates the random ones. Where more tokens
   are left than these explain (by more than ``SHARE`` of them and twice the counting
   error), the cut rises until that is no longer so; in a class without random tokens it
   ends near a half, and next to nothing is reported.

Both steps need only how many tokens lie beyond each p-value, so they work on counts in
bins of a 20th of a decade: at most ``BINS`` rows a class, every token counted, each
p-value rounded up. Tokens above the cut, in one of their encodings at least, are
reported.

Everything is DataFrame functions. Spans get their places from the lengths of the text
between matches, summed up per document in a window; texts are never shuffled, only
spans are.

Defined results: a null text counts as empty; a row without spans has zero counts, the
SHA-256 of the empty string and empty ``spans``; repeated rows each get a result and
count each in the step-up; a null ``doc_id`` is carried; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.text import whole
from squall.llm.work import written

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
# a run that is too short holds no other match, so the least length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: share of false rejections allowed in each class
RATE = 0.01
#: share of the reported tokens of a class that may be unexplained, beyond the counting error
SHARE = 0.05
BINS = 400
PER_DECADE = 20
#: the first bin whose p-values are at most a half, and the share of random tokens before it
HALF = 6
UPPER = 1 - 10 ** (-HALF / PER_DECADE)


def _matches(text: Column, pattern: str, kind: int, value: int = 0) -> Column:
    """Array of (kind, i, gap, length, token, value length): the text between matches and the matches."""
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    # the text is split only where there are matches
    between = F.split(text, pattern, -1)
    token = lambda m: m if kind == 3 else F.lit("")
    zipped = F.transform(
        F.arrays_zip(
            found.alias("m"),
            F.slice(F.transform(between, lambda g: F.length(g)), 1, F.size(found)).alias("g"),
            F.transform(F.regexp_extract_all(text, regex, F.lit(value)), lambda v: F.length(v)).alias("v"),
        ),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            z["g"].alias("gap"),
            F.length(z["m"]).alias("size"),
            token(z["m"]).alias("token"),
            z["v"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,token:string,value:int>>")
    return F.when(F.size(found) == 0, none).otherwise(zipped)


def _spans(docs: DataFrame) -> DataFrame:
    """A row per candidate span: _row, doc_id, kind, start, stop, token; null kind where a row has none."""
    text = F.col("text")
    found = docs.select("doc_id", whole("text").alias("text")).select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        _matches(text, ASSIGN, 0, 2).alias("a"), _matches(text, ACCESS, 1).alias("b"),
        _matches(text, HEX, 2).alias("c"), _matches(text, TOKEN, 3).alias("d"),
    )
    rows = found.select("_row", "doc_id", F.inline_outer(F.concat("a", "b", "c", "d")))
    upto = Window.partitionBy("_row", "kind").orderBy("i")
    stop = F.sum(F.col("gap") + F.col("size")).over(upto)
    placed = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))
    short = (F.col("kind") == 0) & (F.col("value") < ASSIGN_VALUE)
    return placed.select(
        "_row", "doc_id", F.when(F.coalesce(~short, F.lit(False)), F.col("kind")).alias("kind"), "start", "stop", "token"
    )


#: alphabets in order of their values
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "grouped hex": "0123456789abcdef",
    "lower base32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base58": "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
}


#: the letters that words of European languages are mostly made of
COMMON = "etaoinsrlcdu"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: group of each character: digits 0, signs 1, lower-case letters 2 and 3, upper-case ones 4 and 5
GROUPS = {c: "0" for c in "0123456789"} | {c: "1" for c in "+/"}
GROUPS |= {c: "3" if c in COMMON else "2" for c in _LETTERS} | {c.upper(): "5" if c in COMMON else "4" for c in _LETTERS}


def group_shares(encoding: str) -> list[float]:
    """The share of each group in an alphabet; of hexadecimal ones, which are not grouped, none."""
    order = ALPHABETS[encoding]
    return [0.0 if "hex" in encoding else sum(GROUPS[c] == g for c in order) / len(order) for g in "012345"]


def _encoded(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``encoding``, ``k`` (alphabet size), ``v`` and ``g`` (values and groups of the characters).

    A row per token and encoding: one, or two for what is base64 and has a smaller alphabet.
    """
    body, encoding = F.col("_body"), F.col("encoding")
    one_case = F.when(body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(body.rlike("^[A-Z2-7]+$"), "base32")
    bare = F.regexp_replace(body, "[-_]", "")
    long = F.length(bare) >= 16
    # in one case, letters alone are words
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    narrow = F.when(long & mixed & (bare != body) & bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "grouped hex")
    narrow = narrow.when(mixed & body.rlike("^[a-z2-7]+$"), "lower base32")
    narrow = narrow.when(mixed & body.rlike("^([a-z0-9]+|[A-Z0-9]+)$"), "base36")
    cased = body.rlike("[a-z]") & body.rlike("[A-Z]")
    narrow = narrow.when(cased & body.rlike("^[1-9A-HJ-NP-Za-km-z]+$"), "base58").when(cased & body.rlike("^[A-Za-z0-9]+$"), "base62")
    both = F.when(one_case.isNotNull(), F.array(one_case)).otherwise(F.array_compact(F.array(F.lit("base64"), narrow)))
    known = tokens.withColumn("_body", F.regexp_replace("token", "=+$", ""))
    known = known.select("*", F.explode(both).alias("encoding"))
    letters = F.when(encoding.isin("hex", "base36"), F.lower(body)).when(encoding == "grouped hex", F.lower(bare))
    letters = letters.when(encoding == "base64", F.translate(body, "-_", "+/")).otherwise(body)
    order = F.element_at(F.create_map(*(F.lit(x) for pair in ALPHABETS.items() for x in pair)), encoding)
    split = known.withColumn("_letters", F.split(letters, "")).withColumn("_order", order)
    return split.select(
        *tokens.columns,
        "encoding",
        F.length("_order").cast("double").alias("k"),
        F.transform("_letters", lambda c: F.position(c, F.col("_order")) - 1).alias("v"),
        F.split(F.translate(letters, "".join(GROUPS), "".join(GROUPS.values())), "").alias("g"),
    )


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))


def _tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a logistic approximation, for |z| up to 12."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return F.lit(1.0) / (1.0 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _by_encoding(values: dict[str, Column]) -> Column:
    return F.element_at(F.create_map(*(x for name, v in values.items() for x in (F.lit(name), v))), F.col("encoding"))


def _grouped(n: Column) -> tuple[Column, Column]:
    """The deviates of the two tests on groups; null for encodings that are not grouped."""
    shares = {name: group_shares(name) for name in ALPHABETS}
    share = _by_encoding({name: F.array(*map(F.lit, s)) for name, s in shares.items()})
    free = _by_encoding({name: F.lit(float(sum(x > 0 for x in s) - 1)) for name, s in shares.items()})
    square, cube = (_by_encoding({name: F.lit(sum(x**e for x in s)) for name, s in shares.items()}) for e in (2, 3))
    g = F.col("g")
    terms = F.transform(
        share,
        lambda s, i: F.when(s > 0, F.pow(F.size(F.filter(g, lambda x: x == i.cast("string"))) - n * s, F.lit(2.0)) / (n * s)).otherwise(0.0),
    )
    spread = 2 / (9 * free)
    counts = (F.pow(_sum(terms, lambda x: x) / free, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    neighbours = F.zip_with(F.slice(g, 2, F.size(g)), F.slice(g, 1, F.size(g) - 1), lambda x, y: x == y)
    equal = _sum(neighbours, lambda same: F.when(same, 1.0).otherwise(0.0))
    variance = (n - 1) * square * (1 - square) + 2 * (n - 2) * (cube - square * square)
    grouped = free > 0
    return F.when(grouped, counts), F.when(grouped, (equal - (n - 1) * square) / F.sqrt(variance))


def with_battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``encoding``, ``size`` and ``p``, the combined p-value of ``token`` in that encoding.

    A token without two different values, or all on one side of the alphabet's middle,
    fails the tests that cannot be computed for it.
    """
    v, k, n = F.col("v"), F.col("k"), F.col("n")
    sized = _encoded(tokens).withColumn("n", F.size("v").cast("double"))
    pairs = F.zip_with(F.slice(v, 2, F.size(v)), F.slice(v, 1, F.size(v) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    half = k / 2
    counted = sized.select(
        "*",
        _sum(F.array_distinct(v), lambda d: F.pow(F.size(F.filter(v, lambda x: x == d)), F.lit(2.0))).alias("squares"),
        _sum(v, lambda x: F.when(x >= half, 1.0).otherwise(0.0)).alias("above"),
        (_sum(pairs, lambda q: F.when((q["x"] >= half) != (q["y"] >= half), 1.0).otherwise(0.0)) + 1).alias("runs"),
        (_sum(v, lambda x: x) / n).alias("mean"),
    )
    mean = F.col("mean")
    moments = counted.select(
        "*",
        _sum(v, lambda x: (x - mean) * (x - mean)).alias("spread"),
        _sum(pairs, lambda q: (q["x"] - mean) * (q["y"] - mean)).alias("lagged"),
    )
    never = F.lit(12.0)
    uniform = (F.col("squares") * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    both = F.col("above") * (n - F.col("above")) * 2
    variance = both * (both - n) / (n * n * (n - 1))
    runs = F.when(variance > 0, F.abs(F.col("runs") - both / n - 1) / F.sqrt(variance)).otherwise(never)
    serial = F.when(F.col("spread") > 0, F.abs(F.col("lagged") / F.col("spread") + 1 / n) * F.sqrt(n)).otherwise(never)
    moments = moments.select("*", *(z.alias(c) for z, c in zip(_grouped(n), ("_counts", "_equal"))))
    logs = F.log(_tail(uniform)) + F.log(2 * _tail(runs)) + F.log(2 * _tail(serial))
    grouped = F.log(_tail(F.col("_counts"))) + F.log(_tail(F.col("_equal")))
    logs = logs + F.when(F.col("_counts").isNull(), F.lit(0.0)).otherwise(grouped)
    # Fisher: -2 * logs is chi-squared with two degrees of freedom per test, six or ten
    x = -F.col("_logs")
    six = 1 + x + x * x / 2
    p = F.exp(-x) * F.when(F.col("_counts").isNull(), six).otherwise(six + x * x * x / 6 + x * x * x * x / 24)
    found = moments.withColumn("_logs", F.least(logs, F.lit(0.0))).withColumn("p", p)
    return found.select(*tokens.columns, "encoding", F.col("n").cast("int").alias("size"), "p")


def judged(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """``tokens``, once per encoding, with ``random``: not rejected by the step-up of their class."""
    binned = with_battery(tokens).withColumn(
        "bin", F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-300))) * PER_DECADE), F.lit(BINS)).cast("int")
    )
    binned = written(binned.withColumn("width", F.floor(F.log2("size")).cast("int")), "tokens")
    kind = ["encoding", "width"]
    counts = binned.groupBy(*kind, "bin").count()  # at most BINS + 1 rows a class from here on
    all_ = F.sum("count").over(Window.partitionBy(*kind))
    beyond = F.sum("count").over(Window.partitionBy(*kind).orderBy(F.desc("bin")))
    random = F.sum(F.when(F.col("bin") < HALF, F.col("count")).otherwise(0)).over(Window.partitionBy(*kind)) / UPPER
    judged_ = counts.select(*kind, "bin", (beyond / all_).alias("share"), (all_ - beyond).alias("left"), random.alias("random"), all_.alias("all"))
    least = F.pow(F.lit(10.0), -F.col("bin") / PER_DECADE)
    lost = F.min(F.when(least <= rate * F.col("share"), F.col("bin")))
    # cuts to choose from: each bin that holds tokens, and the one behind all; what is left above them
    enough = lambda left, explained: left - explained <= F.greatest(SHARE * left, 2 * F.sqrt(left))
    classes = judged_.groupBy(*kind).agg(
        F.coalesce(lost, F.lit(BINS + 1)).alias("top"),
        F.first("all").alias("all"), F.first("random").alias("random"),
        F.collect_list(F.when(F.col("bin") >= HALF, F.struct("bin", "left"))).alias("cuts"),
    )
    end = F.array(F.struct(F.lit(BINS + 1).alias("bin"), F.col("all").alias("left")))
    fit = F.filter(
        F.concat("cuts", end),
        lambda c: enough(c["left"], F.col("random") * (1 - F.pow(F.lit(10.0), -c["bin"] / PER_DECADE))),
    )
    allowed = F.array_max(F.transform(F.filter(fit, lambda c: c["bin"] <= F.col("top")), lambda c: c["bin"]))
    cut = classes.select(*kind, F.coalesce(allowed, F.least("top", F.lit(HALF))).alias("cut"))
    decided = binned.join(F.broadcast(cut), kind)  # a row per class: tens
    return decided.select(*tokens.columns, *kind, "size", "p", (F.col("bin") < F.col("cut")).alias("random"))


def secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    spans = written(_spans(docs), "spans")
    tokens = judged(spans.where("kind = 3"), rate).where("random").select("_row", "doc_id", "kind", "start", "stop").distinct()
    kept = spans.where("kind IS NULL OR kind < 3").select("_row", "doc_id", "kind", "start", "stop")
    # every row stays, be it without a span
    kept = kept.unionByName(tokens).unionByName(
        spans.where("kind = 3").select("_row", "doc_id", *(F.lit(None).cast("int").alias(c) for c in ("kind", "start", "stop")))
    )
    place = F.struct("start", "kind", "stop")
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    rows = kept.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), place))).alias("_all"),
    )
    names = F.array(*map(F.lit, KINDS))
    shown = lambda all_: F.array_join(
        F.transform(all_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )
    base = F.filter("_all", lambda s: s["kind"] < 3)
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("_all")).alias("spans"), "n_random",
    )
