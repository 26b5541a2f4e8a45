"""Packing: the cached encoder against the library, patterns against one-by-one filling, whole results."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from squall.llm import packing, queries
from squall.llm.encoding import Encoder

from ..conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n x  y\t\n", "a  b", "don't  I'LL 12 345a !!", "x\x1cy z", "é ́a İ ΑΣ ΑΣ. <|endoftext|> a<|startoftext|>", "a" * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    path = public_tokenizers.path(name)
    library, mine = Tokenizer.from_file(path), Encoder(path)
    assert mine.kind
    r = random.Random(1)
    texts = list(ODD)
    for chars in (" \n\t\r\x0b\x0c\x1c\x85\xa0 　'sdltveIΣσİ́é中1٣²!.,_-<|>", " '''sdltvreIm1!.,_-\n", " aéÉİßÿĀ²ª\n,'s"):
        texts += ["".join(r.choice(chars) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for text, ids in zip(texts, mine(pa.array(texts))):
        assert library.encode(text or "", add_special_tokens=False).ids == ids.tolist(), text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_strings_of_added_tokens_get_their_ids(name):
    path = public_tokenizers.path(name)
    library, mine = Tokenizer.from_file(path), Encoder(path)
    added = [t.content for t in library.get_added_tokens_decoder().values()]
    assert added
    r = random.Random(2)
    texts = [t for a in added for t in (a, f"hello {a} world", f"glued{a}on", a * 3, f"{a} {a}", a[:-1], a.upper(), f"x\n{a}\n\ny", f"é{a}\x85")]
    texts += ["".join(r.choices([*added, " ", "\n", "word", "Ünder", "<|", "|>", "\u3000", a[1:]], k=r.randint(1, 9))) for a in added for _ in range(300)]
    for text, ids in zip(texts, mine(pa.array(texts))):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist(), text
    assert any(i in library.get_added_tokens_decoder() for ids in mine(pa.array(texts)) for i in ids.tolist())


def one_by_one(counts, capacity, max_docs, max_attention):
    """Sequences filled one after the other, each time with the longest piece that fits."""
    left, out = Counter(counts), []
    while +left:
        tokens = docs = cost = 0
        held = []
        for n in sorted(left, reverse=True):
            while left[n] and tokens + n <= capacity and docs < max_docs and cost + n * n <= max_attention:
                tokens, docs, cost = tokens + n, docs + 1, cost + n * n
                held.append(n)
                left[n] -= 1
        out.append(tuple(held))
    return Counter(out)


@pytest.mark.parametrize("max_docs, max_attention", [(64, 64 * 64), (3, 64 * 64), (64, 900)])
def test_patterns_are_filling_one_by_one(max_docs, max_attention):
    r = random.Random(max_docs)
    counts = Counter(r.choice([r.randint(1, 30), r.randint(1, 5), 30]) for _ in range(500))
    found = packing.patterns(counts, 64, max_docs, max_attention, weights=(1.0, 0.0, 0.0))
    assert sum((Counter({n: t * p.copies for n, t in p.items}) for p in found), Counter()) == counts
    got = Counter()
    for p in found:
        got[tuple(n for n, t in p.items for _ in range(t))] += p.copies
    assert got == one_by_one(counts, 64, max_docs, max_attention)
    by_dot = packing.patterns(counts, 64, max_docs, max_attention, rule="dot")
    for p in by_dot:
        assert sum(n * t for n, t in p.items) <= 64 and sum(t for _, t in p.items) <= max_docs
        assert sum(n * n * t for n, t in p.items) <= max_attention


def check(rows, texts):
    """Gapless sequences, whole documents, right checksums; the number of sequences."""
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        n, first = len(ids), len(ids) % 2048 or min(len(ids), 2048)
        bounds = [0, *range(first, n + 1, 2048)]
        want += [(doc_id, k, s, e - s, zlib.crc32(ids[s:e])) for k, (s, e) in enumerate(zip(bounds, bounds[1:]))]
    assert Counter(want) == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = queries.op5_best_fit_packing(spark, SF_SMALL).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_nulls_repeats_ties_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 7)
    texts = [(1, None), (2, ""), (2, ""), (None, "a b"), (None, "a b"), (3, "word " * 9000), (4, "x " * 2047), (5, "x " * 2046)]
    texts += [(i, "same text") for i in range(10, 60)] + list(enumerate(ODD, 100))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check(packing.pack(docs, PATH).collect(), texts)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, piece int, _row long, length string, sequence_id int"
    assert packing.pack(spark.createDataFrame([], schema), PATH).count() == 0
    docs = spark.createDataFrame([(1, "a", 9, 9, "9", 9)], schema)
    assert [tuple(r)[:4] for r in packing.pack(docs, PATH).collect()] == [(1, 0, 0, 2)]
