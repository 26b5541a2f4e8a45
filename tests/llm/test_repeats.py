"""Repeated byte strings against a table of all windows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from squall.llm import queries, repeats
from squall.llm.anchors import Anchors

from ..conftest import SF_SMALL


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        n_spans = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        out.append((doc_id, len(t), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.without_repeats(docs, **options).drop("kept").collect()
    return sorted(map(tuple, got), key=repr)


def edited(seed, n, letters):
    """Texts made of shared passages, cut and changed at random."""
    r = random.Random(seed)
    stock = ["".join(r.choice(letters) for _ in range(r.randint(5, 80))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            s = r.choice(stock)
            a, b = sorted(r.choices(range(len(s) + 1), k=2))
            parts += [r.choice([s, s[a:], s[:b], s[a:b]]), r.choice(["", "x", "é", "yz"])]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("group", [20_000, 2])
@pytest.mark.parametrize("seed, letters", [(1, "abcdefghijklmnop"), (2, "ab"), (3, "abc é")])
def test_edited_passages(spark, seed, letters, group):
    rows = edited(seed, 60, letters)
    assert run(spark, rows, length=12, gram=5, group=group) == brute(rows, 12)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = queries.op1_suffix_array_dedup(spark, SF_SMALL)
    keep = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got.columns[:5] == keep
    want = brute([(r.doc_id, r.text) for r in docs], 400)
    assert sum(w[2] for w in want) > 0
    assert sorted(map(tuple, got.select(*keep).collect()), key=repr) == want


@pytest.mark.parametrize("seed", range(30))
def test_groups_are_the_maximal_repeats_with_all_occurrences(seed):
    r = random.Random(seed)
    rows = {("".join(r.choice("ab") for _ in range(r.randint(0, 6))), "g" + "".join(r.choice("ab") for _ in range(r.randint(0, 6)))) for _ in range(9)}
    before, after = ([x.encode() for x in side] for side in zip(*sorted(rows)))
    length = 5

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    n, want = len(before), set()
    for i in range(n):
        for j in range(i + 1, n):
            left, right = common(before[i][::-1], before[j][::-1]), common(after[i], after[j])
            if left + right >= length:
                tail, head = before[i][len(before[i]) - left :], after[i][:right]
                want.add((frozenset(k for k in range(n) if before[k].endswith(tail) and after[k].startswith(head)), left, right))
    got = [(frozenset(m.tolist()), left, right) for m, left, right in repeats.repeat_groups(before, after, length)]
    assert len(got) == len(set(got)) and set(got) == want


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr("squall.llm.anchors.CHUNK", 64)
    r = random.Random(9)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(0, 300))).encode() for _ in range(20)] + [b"a" * 500]
    places, windows = {}, Counter()
    for a in Anchors(16, 6)(texts):
        for t, p, left, right, gram, segment in zip(a.text, a.place, a.left, a.right, a.gram, a.segment):
            for begin in range(p - left, p + right - 15):
                windows[t, begin] += 1
                assert begin <= p <= begin + 10
                assert places.setdefault(texts[t][begin : begin + 16], (p - begin, gram)) == (p - begin, gram)
    assert windows == Counter((t, i) for t, x in enumerate(texts) for i in range(len(x) - 15))


def words_brute(rows, n):
    """(doc_id, words that windows of ``n`` words cover which start elsewhere too)."""
    split = [re.findall(r"[^ \t-\r]+", text or "") for _, text in rows]
    starts = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        hit = {j for i in range(len(w) - n + 1) if starts[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out.append((doc_id, len(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeated_passages_of_words(spark, group):
    r = random.Random(11)
    stock = [[f"{r.choice(['the', 'ö', 'w'])}{r.randrange(400)}" for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(80):
        text = [f"own{i}x{j}" for j in range(r.randint(0, 12))]
        for _ in range(r.randint(0, 2)):
            a, b = sorted(r.sample(range(31), 2))
            text += r.choice(stock)[a:b] + [f"more{i}"]
        rows.append((i if i % 9 else None, r.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200, None), (201, ""), (202, "again " * 40), (203, rows[5][1]), (203, rows[5][1])]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), group=group, words=8)
    assert sorted(map(tuple, got.select("doc_id", "n_repeat_words").collect()), key=repr) == words_brute(rows, 8)
    assert got.where("has_repeat <> (n_repeat_words > 0)").count() == 0


def test_whole_table_states_passages_of_fifty_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = queries.op1_suffix_array_dedup(spark, SF_SMALL).select("doc_id", "n_repeat_words").collect()
    want = words_brute([(r.doc_id, r.text) for r in docs], 50)
    assert sum(n > 0 for _, n in want) > 0
    assert sorted(map(tuple, got), key=repr) == want


def test_nulls_repeated_rows_and_long_texts(spark):
    r = random.Random(4)
    long = "".join(r.choice("abcdefgh ") for _ in range(60_000))
    rows = [(1, None), (2, ""), (3, "a" * 399), (4, "b" * 400), (5, "c" * 401), (6, long), (None, long[30_000:31_000]), (7, "é" * 300)]
    rows += [(8, "same " * 30 + str(long[:700])), (8, "same " * 30 + str(long[:700])), (9, "z" * 5000)]
    assert run(spark, rows) == brute(rows, 400)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, k int, gram string, needed boolean, bytes int"
    assert repeats.without_repeats(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "ab" * 300, 1, "g", False, 2)], schema)
    assert [tuple(x)[:4] for x in repeats.without_repeats(docs).collect()] == [(1, 600, 600, 1)]
