"""Ranked lexical search: many queries over all documents, with shared term sets evaluated once.

Terms are runs of letters and digits (and of any characters beyond ASCII), with only
A-Z lower-cased. A document's score for a query is the sum, over the query's distinct
terms, of ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``: w falls with the number of
documents that hold the term, m grows with the document's length (see ``weights`` and
``lengths``); all in whole numbers.

Common subexpressions: a query is a sum over its terms, and queries share terms. The
terms of each query are put in order of the number of queries that hold them, so that
terms of many queries stand side by side. Neighbours that two or more queries share
become one node (their sum), again and again, over nodes too, until no two neighbours
are shared. This gives a DAG: leaves are terms, an inner node adds two nodes, a query
adds the nodes that are left of it. For a batch of documents each node's partial
accumulator (its sum per document) is then worked out once, level by level, whatever
number of queries reads it.

On Spark: queries are dealt into blocks of bounded size, each mined in a task. Per
block, documents stream past its terms once; what they hold of them (term, tf) is
written and gives document counts by a pre-aggregated group-by. The accumulators are
worked out over these lists, batch by batch. A task keeps k documents a query, and
Spark ranks these. Only a block's plan and its document counts reach the driver, one
block at a time.

Defined results: a null or empty text has no terms, and documents without terms do not
count; a query without terms finds nothing; each repeated document or query row counts
and ranks on its own; a null ``doc_id`` ranks behind others of its score, a null
``item_id`` is carried; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.text import whole
from squall.llm.work import written

TOP = 10
#: bounds of a block of queries
BLOCK_ITEMS, BLOCK_BYTES = 1024, 1 << 23
#: documents whose accumulators are held at once
BATCH = 256

#: letters and digits stay, A-Z in lower case; other ASCII characters part terms
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
PLAN_SCHEMA = (
    "block long, terms array<binary>, item_ids array<long>, parts array<array<int>>, "
    "left array<int>, right array<int>, rounds array<int>"
)
RESULT_SCHEMA = "slot int, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return text.translate(_FOLD).split()


def share(queries: list[list[int]], n_terms: int) -> tuple[list[list[int]], list[tuple[int, int]], list[int]]:
    """(what is left of each query, the inner nodes' two parts, how many nodes each round made).

    Nodes are numbered behind the ``n_terms`` leaves, so a node's parts stand before it.
    """
    held = Counter(t for q in queries for t in q)
    parts = [sorted(q, key=lambda t: (-held[t], t)) for q in queries]
    nodes: list[tuple[int, int]] = []
    rounds = []
    while True:
        pairs = Counter(p for q in parts for p in zip(q, q[1:]))
        taken: set[int] = set()
        made: dict[tuple[int, int], int] = {}
        for pair, n in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            if not taken.intersection(pair):
                made[pair] = n_terms + len(nodes)
                nodes.append(pair)
                taken.update(pair)
        if not made:
            return parts, nodes, rounds
        rounds.append(len(made))
        for at, q in enumerate(parts):
            out, i = [], 0
            while i < len(q):
                node = made.get((q[i], q[i + 1])) if i + 1 < len(q) else None
                out.append(q[i] if node is None else node)
                i += 1 if node is None else 2
            parts[at] = out


def plans(items: DataFrame) -> DataFrame:
    """One row per block of ``items`` (item_id, text): its terms, queries and DAG (``PLAN_SCHEMA``)."""
    rows = items.select("item_id", whole("text").cast("binary").alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(size / BLOCK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        ids, asked = [], []
        for batch in batches:
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                found = dict.fromkeys(terms(text.as_py()))
                if found:
                    ids.append(item_id)
                    asked.append([known.setdefault(t, len(known)) for t in found])
        if not ids:
            return
        parts, nodes, rounds = share(asked, len(known))
        left, right = [a for a, _ in nodes], [b for _, b in nodes]
        ints = pa.list_(pa.int32())
        types = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(ints), ints, ints, ints]
        row = [TaskContext.get().partitionId(), list(known), ids, parts, left, right, rounds]
        names = ["block", "terms", "item_ids", "parts", "left", "right", "rounds"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return rows.repartition(blocks).mapInArrow(run, PLAN_SCHEMA)


def term_lists(docs: DataFrame, held) -> DataFrame:
    """doc_id, n (terms with repeats) and the (ids, tf) of the broadcast terms ``held``; documents with a term."""
    schema = "doc_id long, n long, ids array<int>, tf array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(held.value)}
        for batch in batches:
            doc_ids, ns, ids, tfs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms(text.as_py())
                if not found:
                    continue
                counts = Counter(found)
                here = counts.keys() & known.keys()
                doc_ids.append(doc_id)
                ns.append(len(found))
                ids.append([known[t] for t in here])
                tfs.append([counts[t] for t in here])
            types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip((doc_ids, ns, ids, tfs), types)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "tf"])

    return docs.select("doc_id", whole("text").cast("binary").alias("text")).mapInArrow(run, schema)


def weights(n_docs: int, holding: list[int]) -> np.ndarray:
    """The weight of terms that so many of ``n_docs`` documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding], np.int64)


def lengths(n: list[int], n_docs: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms, of ``n_docs`` documents with ``total`` terms."""
    return np.array([100 - 90 + 90 * x * n_docs // total for x in n], np.int64)


class Dag:
    """A block's plan, with the weights of its terms."""

    def __init__(self, plan, weight: np.ndarray):
        self.weight, self.item_ids = weight, plan["item_ids"]
        self.left, self.right = np.array(plan["left"], np.int64), np.array(plan["right"], np.int64)
        self.rounds = plan["rounds"]
        self.flat = np.array([s for q in plan["parts"] for s in q], np.int64)
        self.starts = np.cumsum([0, *(len(q) for q in plan["parts"])])[:-1]

    def scores(self, at: np.ndarray, ids: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """[queries, documents]; term ``ids[i]`` stands ``tf[i]`` times in document ``at[i]``."""
        leaves = len(self.weight)
        sums = np.zeros((leaves + len(self.left), len(m)), np.int64)
        sums[ids, at] = self.weight[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
        begin = 0
        for n in self.rounds:
            parts = slice(begin, begin + n)
            sums[leaves + begin : leaves + begin + n] = sums[self.left[parts]] + sums[self.right[parts]]
            begin += n
        return np.add.reduceat(sums[self.flat], self.starts, axis=0)


def ranked(lists: DataFrame, held, n_docs: int, total: int, k: int) -> DataFrame:
    """Each task's best k documents of every query of the broadcast (plan, weights) ``held``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag = Dag(*held.value)
        best: list[list[tuple[int, bool, int]]] = [[] for _ in dag.item_ids]
        least = np.ones(len(best), np.int64)
        for batch in batches:
            for begin in range(0, len(batch), BATCH):
                part = batch.slice(begin, BATCH)
                doc_ids = part.column("doc_id").to_pylist()
                found = part.column("ids")
                at = np.repeat(np.arange(len(part)), found.value_lengths().to_numpy(zero_copy_only=False))
                ids = found.flatten().to_numpy(zero_copy_only=False)
                tf = part.column("tf").flatten().to_numpy(zero_copy_only=False)
                score = dag.scores(at, ids, tf, lengths(part.column("n").to_pylist(), n_docs, total))
                enough = score >= least[:, None]
                for q in np.flatnonzero(enough.any(axis=1)).tolist():
                    new = [(-int(score[q, d]), doc_ids[d] is None, doc_ids[d] or 0) for d in np.flatnonzero(enough[q])]
                    best[q] = heapq.nsmallest(k, best[q] + new)
                    if len(best[q]) == k:
                        least[q] = -best[q][-1][0]
        rows = [(q, dag.item_ids[q], None if null else d, -s) for q, top in enumerate(best) for s, null, d in top]
        types = [("slot", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])

    return lists.mapInArrow(run, RESULT_SCHEMA)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item, best first."""
    spark = docs.sparkSession
    blocks = written(plans(items), "query-plans")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = []
    for (block,) in blocks.select("block").orderBy("block").collect():
        plan = blocks.where(F.col("block") == block).first().asDict()
        words = spark.sparkContext.broadcast([bytes(t) for t in plan.pop("terms")])
        lists = written(term_lists(docs, words), "term-lists")
        n_docs, total = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        counts = lists.select(F.explode("ids").alias("id")).groupBy("id").count()
        holding = dict(map(tuple, counts.collect()))  # at most one row per term of the block
        weight = weights(n_docs, [holding.get(t, 0) for t in range(len(words.value))])
        held = spark.sparkContext.broadcast((plan, weight))
        top = ranked(lists, held, n_docs, total, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.append(written(top.select("item_id", "rank", "doc_id", "score"), "ranked"))
        words.unpersist()
        held.unpersist()
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


#: DuckDB twin of the registered query
ORACLE_SQL = r"""
WITH t AS (
  SELECT d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), tf AS (
  SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), n AS (
  SELECT d, sum(tf)::BIGINT AS n FROM tf GROUP BY d
), c AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n
), m AS (
  SELECT d, 100 - 90 + (90 * n * docs) // total AS m FROM n, c
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, docs
), q AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), s AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (d) GROUP BY ALL
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
