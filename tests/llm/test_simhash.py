"""SimHash against a direct fingerprint and a comparison of all fingerprints."""

import random
import re

import numpy as np
import xxhash

from squall.llm import queries, simhash
from squall.llm.components import connected_components

from ..conftest import SF_SMALL


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Smallest id per row of (id, fingerprint)."""
    fps = sorted({f for _, f in prints})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    array = np.array(fps, dtype=np.uint64)
    for f in fps:
        for g in array[np.bitwise_count(array ^ np.uint64(f)) <= 2]:
            x, y = find(f), find(int(g))
            root[max(x, y)] = min(x, y)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for _, f in prints]


def check(got, texts):
    prints = [(i, plain_fingerprint(t)) for i, t in texts]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(prints, plain_components(prints))), key=repr)
    assert sorted(map(tuple, got), key=repr) == want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(queries.op6_simhash(spark, SF_SMALL).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_chains_of_near_fingerprints(spark):
    r = random.Random(5)
    fps = set()
    for _ in range(20):
        f = r.getrandbits(64)
        for _ in range(r.choice([1, 5, 60])):
            fps.add(f)
            for _ in range(r.choice([1, 2, 2, 3])):
                f ^= 1 << r.randrange(64)
    low = r.getrandbits(64) & ~0xFFFF
    fps |= {low | r.getrandbits(16) for _ in range(3000)}  # one list beyond the pairwise size
    rows = list(enumerate(sorted(fps)))
    distinct = spark.createDataFrame([(simhash._signed(f),) for _, f in rows], "fp long")
    parts = connected_components(simhash.links(distinct)).collect()
    by = {p.node: p.component for p in parts}
    got = {}
    for i, f in rows:
        got.setdefault(by.get(simhash._signed(f), simhash._signed(f)), []).append(i)
    want = {}
    for (i, _), c in zip(rows, plain_components(rows)):
        want.setdefault(c, []).append(i)
    assert sorted(got.values()) == sorted(want.values())


def test_nulls_short_long_and_repeated(spark):
    long = " ".join(f"w{i * i % 7919}" for i in range(50000))
    texts = [
        (5, None), (4, ""), (9, " \n"), (1, "One two"), (2, "one  two"), (3, "ONE"), (3, "one"), (None, "one"),
        (None, "alone here with four"), (7, "ÄB c d e"), (8, "äB c d e"), (10, long), (11, long + " x"), (12, "a\x0bb\x1cc d"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = simhash.simhash(docs).collect()
    check(got, texts)
    assert {r.component_id for r in got if r.doc_id in (4, 5, 9)} == {4}
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert set(kept) >= {None, 1, 3, 4} and not {2, 5, 9} & set(kept)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, component long, a int"
    assert simhash.simhash(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(2, "a b c", "f", 1, 1), (1, "a b c", "g", 2, 2)], schema)
    assert [r.component_id for r in simhash.simhash(docs).collect()] == [1, 1]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_components_of_a_long_path(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (5, None), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
