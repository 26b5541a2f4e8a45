"""Quality rules against a plain Python count, and the ratio against a direct one."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from squall.llm import quality as q
from squall.llm.text import table

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(tri)
    covered = {i + k for i, t in enumerate(tri) if seen[t] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def chained(*hashes):
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return signed(seed)


def features(text, buckets):
    hw = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in WORD.findall(text or "")]
    return [h % buckets for h in hw] + [chained(a, b) % buckets for a, b in zip(hw, hw[1:])]


def test_whole_table_against_brute_force(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    trusted = q.trusted_ids(labels).collect()
    assert {r.doc_id for r in trusted} == {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    good, held = ({r.doc_id for r in trusted if r.held == h} for h in (False, True))
    buckets = 1 << 12
    raw, target = Counter(), Counter()
    for i, t in texts.items():
        f = Counter(features(t, buckets))
        raw += f
        if i in good:
            target += f
    n_raw, n_target = sum(raw.values()), sum(target.values())
    micros = {
        b: round((math.log((target[b] + 1) / (n_target + buckets)) - math.log((raw[b] + 1) / (n_raw + buckets))) * 1e6)
        for b in raw
    }
    got = q.quality(docs, labels, buckets=buckets).collect()
    means = [r.score_micros / r.n_features for r in got if r.doc_id in held and not r.base_failed]
    low, mid = np.quantile(means, [q.TAIL, 0.5])
    for r in got:
        t = texts.pop(r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules(t)
        f = features(t, buckets)
        assert r.n_features == len(f)
        assert abs(r.score_micros - sum(micros[b] for b in f)) <= len(f)  # last digit of the logarithms
        if not r.base_failed:
            mean, threshold = r.score_micros / len(f), low - q.SLACK * (mid - low)
            assert abs(mean - threshold) < 1e-6 or r.kept == (mean >= threshold)
        else:
            assert not r.kept
    assert not texts


def test_held_out_labels(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    verdict = {r.doc_id: r for r in q.quality(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = [r for r in labels.where("doc_id % 2 = 1 AND toxic = 0").collect() if not verdict[r.doc_id].base_failed]
    for label in (0, 1):
        rows = [r for r in held if r.quality == label]
        assert sum(verdict[r.doc_id].kept == bool(label) for r in rows) >= 0.98 * len(rows)


def test_nulls_empty_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "a b c " * 40), (5, " \n\t "), (6, "x " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    got = q.quality(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules(t)
    assert by[1].kept and not by[2].kept and not by[4].kept
    kept = q.keep_good(docs, labels)
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["1", "1", "None"]


@pytest.mark.parametrize("with_labels", [True, False])
def test_empty_tables_and_clashing_columns(spark, with_labels):
    docs = spark.createDataFrame([], "doc_id long, text string, n_words int, _row int, bucket int")
    labels = spark.createDataFrame([(1, 1, 0)] if with_labels else [], "doc_id long, quality int, toxic int")
    assert q.quality(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a " * 10, 1, 2, 3)], docs.schema)
    assert q.quality(one, labels).count() == 1
    assert q.keep_good(one, labels).columns == one.columns


def test_every_trusted_id_is_used(spark):
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    trusted = q.trusted_ids(labels.unionByName(labels)).collect()
    assert sorted(r.doc_id for r in trusted) == list(range(30_000))
    # the target counts the word of every id of its half, repeated and unlabelled rows of `docs` included
    docs = spark.range(30_500).selectExpr("nullif(id, 7) AS doc_id", "'same' AS text")
    docs = docs.unionByName(docs.where("doc_id = 11"))
    target = q._with_target(docs, spark.createDataFrame(trusted).where("NOT held"))
    good = [r.doc_id for r in trusted if not r.held]
    assert target.count() == 30_501
    assert target.where("_good = 1").count() == len(good) - (7 in good) + (11 in good)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_quantiles_are_exact(spark, n):
    values = [((i * 7919) % 613) / 7 - 20 for i in range(n)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(5)
    parts = (0.0, 0.002, 0.25, 0.5, 0.97, 1.0)
    got = q.quantiles(rows, "x", parts).collect()
    want = rows.selectExpr(*[f"percentile(x, {p}D)" for p in parts]).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
