"""Line dedup against a quadratic comparison of all lines."""

import random
import re

import pytest

from squall.llm import lines, queries
from squall.llm.text import table
from tools.oracle_check import compare, duck

from ..conftest import SF_SMALL

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def within_one(x, y):
    if abs(len(x) - len(y)) > 1 or max(len(x), len(y)) < 5:
        return False
    p = 0
    while p < min(len(x), len(y)) and x[p] == y[p]:
        p += 1
    s = 0
    while s < min(len(x), len(y)) and x[-1 - s] == y[-1 - s]:
        s += 1
    return p + s >= max(len(x), len(y)) - 1


def brute(rows):
    key = lambda i: (i is not None, i or 0)
    places = {}
    for doc_id, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            w = tuple(x for x in SPACE.split(line) if x)
            if w:
                places.setdefault(w, []).append((key(doc_id), no))
    first = {w: min(p) for w, p in places.items()}
    near = {w for w in first for v in first if first[v] < first[w] and within_one(w, v)}
    out = []
    for doc_id, text in rows:
        kept, parts = [], (text or "").split("\n")
        for no, line in enumerate(parts):
            w = tuple(x for x in SPACE.split(line) if x)
            if not w or (w not in near and (key(doc_id), no) == first[w]):
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, lines.dedup_lines(docs).collect()), key=repr)


def test_small_table_against_sql(spark):
    got = compare(
        spark, duck(SF_SMALL), "op10", queries.op10_line_dedup, queries.ORACLE_SQL["op10_line_dedup"], SF_SMALL
    )
    assert "MATCH" in got, got


@pytest.mark.parametrize("seed", range(3))
def test_edited_lines_against_brute_force(spark, seed):
    r = random.Random(seed)
    base = [[r.choice("abcd") for _ in range(r.randint(1, 9))] for _ in range(12)]
    rows = []
    for doc_id in range(40):
        text = []
        for _ in range(r.randint(0, 4)):
            w = list(r.choice(base))
            for _ in range(r.randint(0, 2)):
                i = r.randrange(len(w) + 1)
                edit = r.choice(["add", "cut", "put"])
                if edit == "add":
                    w.insert(i, r.choice("abcdxyz"))
                elif w and i < len(w):
                    w[i : i + 1] = [] if edit == "cut" else [r.choice("abcdxyz")]
            text.append(r.choice([" ", "  ", "\t"]).join(w) + r.choice(["", " ", "\r"]))
        rows.append((doc_id, "\n".join(text)))
    assert run(spark, rows) == brute(rows)


def test_nulls_repeats_and_long_lines(spark):
    long = " ".join(f"w{i % 977}" for i in range(30000))
    rows = [
        (3, "one two three four five\n\n  \nsame"),
        (1, "one two three four FIVE\nsame"),
        (1, "one two three four FIVE\nsame"),
        (2, None),
        (4, ""),
        (None, "same\nnull comes first in the order"),
        (None, "null comes first in that order"),
        (5, long),
        (6, long + " end"),
        (7, "a b c d\na b c x"),
    ]
    got = run(spark, rows)
    assert got == brute(rows)
    assert (6, "", 1, 1) in got
    assert (7, "a b c d\na b c x", 2, 0) in got


@pytest.mark.parametrize("common", [1, 20, 10**9])
def test_common_lines_go_their_own_way(spark, common, monkeypatch):
    monkeypatch.setattr(lines, "COMMON", common)
    rows = [(i, f"shared by all of them\nline {i % 7}\nown {i} a b c") for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_template_line_with_many_names(spark):
    rows = [(i, f"hello dear {i} welcome to the list") for i in range(500)]
    got = run(spark, rows)
    assert [r[0] for r in got if r[1]] == [0]


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, _k string, _gone int, line_no int, h1 int"
    assert lines.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "a\na", "k", 1, 2, 3), (2, "a", None, None, None, None)], schema)
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert (got[1].text, got[1]._k, got[1]._gone, got[1].line_no, got[1].h1) == ("a", "k", 1, 2, 3)
    assert (got[2].text, got[2].n_removed) == ("", 1)
