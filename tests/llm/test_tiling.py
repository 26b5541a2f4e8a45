"""Greedy string tiling against its textbook form, and planted passages."""

import random
import time
import tracemalloc

import numpy as np

from squall.llm import queries, tiling
from squall.llm.text import table

from ..conftest import SF_SMALL


def textbook(item, doc, width):
    """Tiled tokens of ``item``: longest unmarked matches first, then by place."""
    a, b, tiled = [False] * len(item), [False] * len(doc), 0
    while True:
        best, found = width - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not a[i + n] and not b[d + n]
                ):
                    n += 1
                if n > best:
                    best, found = n, [(i, d)]
                elif n == best and n >= width:
                    found.append((i, d))
        if best < width:
            return tiled
        for i, d in found:
            if not any(a[i : i + best]) and not any(b[d : d + best]):
                a[i : i + best] = b[d : d + best] = [True] * best
                tiled += best


def brute(docs, items, coverage=0.8):
    out = []
    for doc_id, text in docs:
        doc = tiling.tokens(text)
        for item_id, item_text in items:
            item = tiling.tokens(item_text)
            if not item:
                continue
            n = textbook(item, doc, min(tiling.MIN_MATCH, len(item)))
            if n >= coverage * len(item) - 1e-9:
                out.append((doc_id, item_id, len(item), n))
    return sorted(out, key=repr)


def grams(text):
    w = tiling.tokens(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = tiling.contaminated(d, b, **options).collect()
    return sorted(((r.doc_id, r.item_id, r.item_tokens, r.tiled) for r in rows), key=repr)


def test_random_passages_against_the_textbook(spark):
    r = random.Random(3)
    items = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 30)))) for i in range(30)]
    docs = []
    for doc_id in range(60):
        parts = []
        for _ in range(r.randint(1, 6)):
            w = r.choice(items)[1].split()
            i, j = sorted(r.choices(range(len(w) + 1), k=2))
            parts += w[i:j] + [r.choice("abcxyz")]
        docs.append((doc_id, " ".join(parts)))
    want = brute(docs, items)
    assert len(want) > 50
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_bytes=200) == want  # several blocks


def test_rows_find_the_tiles_of_listed_places():
    r = random.Random(8)
    for _ in range(150):
        letters, width = r.choice([1, 2, 3, 6]), r.randint(1, 5)
        item = [r.randint(1, letters) for _ in range(r.randint(width, 25))]
        doc = np.array([r.randint(0, letters) for _ in range(r.randint(width, 60))], np.uint32)
        pairs = [
            (i, d) for i in range(len(item) - width + 1) for d in range(len(doc) - width + 1) if item[i : i + width] == doc[d : d + width].tolist()
        ]
        want = tiling.tile(tiling.runs(item, doc, pairs, width), width) if pairs else []
        assert tiling.tile_rows(item, doc, width) == want
        near = tiling._covered(doc, np.unique([d for _, d in pairs]).astype(np.int64), width)
        assert [(i, n) for i, _, n in tiling.tile_rows(item, near, width)] == [(i, n) for i, _, n in want]
        assert sum(n for *_, n in want) == textbook(item, doc.tolist(), width)


def test_a_million_repeated_tokens():
    items = [(1, "again " * 100), (2, "other words " * 50), (3, "again and " * 60)]
    block = tiling.Block(items, 5, 0.8)
    text = "again " * 1_000_000
    tracemalloc.start()
    began = time.monotonic()
    got = list(block.matches(9, text))
    took, (_, peak) = time.monotonic() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert got == [(9, 1, 100, 100, 1, 1.0)]
    assert peak < 500e6 and took < 30


def test_the_driver_holds_one_block_of_many(spark, monkeypatch):
    held, inner = [], spark.sparkContext.broadcast

    def spy(value):
        held.append(value)
        return inner(value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: spy(value))
    items = [(i, f"item {i} has words of its own number {i} and {i + 1000}") for i in range(60)]
    docs = [(i, f"before {text} behind") for i, text in items[::7]]
    got = run(spark, docs, items, block_bytes=200)
    assert {(d, i) for d, i, *_ in got} == {(i, i) for i, _ in items[::7]}
    assert len(held) >= 15 and max(map(len, held)) < 20


def test_whole_table_against_the_textbook(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    got = queries.op7_decontamination(spark, SF_SMALL).collect()
    pairs = sorted((r.doc_id, r.item_id, r.item_tokens, r.tiled) for r in got)
    # the textbook form takes too long on all pairs: hold it against those that share any five tokens
    seeds = {i: grams(t) for i, t in items}
    near = [(d, i) for d in docs for i in items if grams(d[1]) & seeds[i[0]]]
    assert sorted(x for d, i in near for x in brute([d], [i])) == pairs


def test_reordered_passage_is_caught(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black grey")
    items = [(1, f"{a}. {b}! {c}?")]
    docs = [(1, f"x {c} y {a}, z {b.upper()}"), (2, f"{a} only"), (3, f"{a} {b}")]
    assert run(spark, docs, items) == [(1, 1, 18, 18)]


def test_nulls_short_items_and_repeats(spark):
    items = [(1, None), (2, ""), (3, "two words"), (3, "two words"), (None, "a b c d e f"), (4, "... !")]
    docs = [(1, None), (2, ""), (3, "Two, words"), (3, "Two, words"), (None, "a-b-c d e f"), (5, "de " * 50000)]
    got = run(spark, docs, items)
    assert got == sorted([(3, 3, 2, 2)] * 4 + [(None, None, 6, 6)], key=repr)
    clean = tiling.keep_clean(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == [1, 2, 5, None]


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 5, "x")], "doc_id long, text string, item_id long, tiles string")
    items = spark.createDataFrame([(7, "a b c d e f", 5)], "item_id long, text string, doc_id long")
    assert [tuple(r)[:2] for r in tiling.contaminated(docs, items).collect()] == [(1, 7)]
    assert tiling.contaminated(docs.limit(0), items).count() == 0
    assert tiling.contaminated(docs, items.limit(0)).count() == 0
    assert tiling.keep_clean(docs, items.limit(0)).collect() == docs.collect()
