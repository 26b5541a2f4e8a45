"""Ranked lexical search: the shared DAG, whole tables against SQL, blocks and odd rows against brute force."""

import math
import random
import re
from collections import Counter

from squall.llm import lexical, queries
from tools.oracle_check import compare, duck

from ..conftest import SF_ORACLE, SF_SMALL

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    """Every item against every document, term by term."""
    held = [(i, Counter(found(t))) for i, t in docs if found(t)]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in held:
            m = 100 - 90 + (90 * sum(counts.values()) * len(held)) // total
            score = 0
            for t in set(found(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if n else d, -s) for r, (s, n, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms_are_the_contracts():
    r = random.Random(1)
    odd = [chr(c) for c in range(0x100)] + ["é", "ß", "İ", "中", " ", "\U0001f600", "A", "z", "0"]
    for _ in range(300):
        text = "".join(r.choices(odd, k=r.randint(0, 40)))
        assert [t.decode() for t in lexical.terms(text.encode())] == found(text)


def test_shared_sets_are_evaluated_once():
    r = random.Random(2)
    common = list(range(12))
    asked = [sorted({*r.sample(common, r.randint(2, 12)), *r.sample(range(12, 60), r.randint(0, 5))}) for _ in range(40)]
    asked += [[3], asked[0], [59, 3]]
    parts, nodes, rounds = lexical.share(asked, 60)
    assert sum(rounds) == len(nodes) > 0

    def leaves(node):
        return [node] if node < 60 else leaves(nodes[node - 60][0]) + leaves(nodes[node - 60][1])

    assert [sorted(t for p in q for t in leaves(p)) for q in parts] == [sorted(q) for q in asked]
    begin = 60
    for n in rounds:  # a round's nodes read earlier rounds alone
        assert all(max(nodes[i - 60]) < begin for i in range(begin, begin + n))
        begin += n
    pairs = Counter(p for q in parts for p in zip(q, q[1:]))
    assert max(pairs.values(), default=0) < 2
    additions = len(nodes) + sum(len(q) - 1 for q in parts)
    assert additions < 0.7 * sum(len(q) - 1 for q in asked)


def test_query_against_sql(spark):
    for sf_dir in (SF_SMALL, SF_ORACLE):
        assert "MATCH" in compare(spark, duck(sf_dir), "op12", queries.op12_lexical_search, lexical.ORACLE_SQL, sf_dir)


def test_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "BATCH", 5)
    r = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Émile", "x", "THE"]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 30)))) for i in range(90)]
    docs += [(1000 + i, "the common text x") for i in range(60)]  # copies tie
    items = [(i, " ".join(r.choices(words, k=r.randint(0, 8)))) for i in range(25)]
    got = rows(lexical.search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)))
    assert got == brute(docs, items)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    docs = [
        (None, "alpha beta"), (1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, "--- ..."), (5, "ALPHA, alpha; Äpfel"),
        (6, "gamma " * 5000), (-7, "alpha beta"), (8, "delta epsilon"), (9, "zeta"), (10, "eta theta"),
    ]
    items = [(0, "Alpha alpha BETA"), (0, "beta"), (None, "gamma Äpfel"), (3, None), (4, "?!"), (5, "nowhere"), (6, "äpfel")]
    left = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS n", "2 AS TF", "3 AS ids", "'q' AS slot")
    right = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS block")
    assert rows(lexical.search(left, right)) == brute(docs, items)
    assert rows(lexical.search(left, right, k=2)) == brute(docs, items, 2)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert rows(lexical.search(docs.limit(0), items)) == []
    assert rows(lexical.search(docs, items.limit(0))) == []
    assert rows(lexical.search(spark.createDataFrame([(1, None)], DOCS), items)) == []
