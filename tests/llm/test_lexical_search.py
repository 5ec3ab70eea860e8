import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import lexical_search as S

from .conftest import DOCS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """(item_id, rank, doc_id, score), every document scored by the formula."""
    read = [(key, Counter(t), len(t)) for key, text in docs for t in [terms(text)] if t]
    n_docs, n_terms = len(read), sum(n for _, _, n in read)
    df = Counter(t for _, c, _ in read for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c, n in read:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, r, key, -s) for r, (s, _, _, key) in enumerate(sorted(scored)[:top], 1)]
    return out


def by_item(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None, r[2] or 0))


def random_texts(seed, number, words=300, longest=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    shares = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocabulary, shares, k=rng.randint(0, longest))) for _ in range(number)]


def test_terms_are_the_matches_of_the_pattern(monkeypatch):
    texts = ["It's a_b-c 9·8 é日本 \U0001f600x\x00y\x7fz ÀÉ İ", "", " \n", "x" * 50, "a " * 40, "(),"]
    for piece in (1 << 20, 7):
        monkeypatch.setattr(S, "PIECE_BYTES", piece)
        for text in texts:
            assert [t.decode() for t in S.terms_of(text)] == terms(text)
        n, ids, counts = S.count_terms(" ".join(["ab", "cd", "zz", "ab"] * 9).encode(), {b"ab": 3, b"cd": 1})
        assert (n, ids.tolist(), counts.tolist()) == (36, [1, 3], [9, 18])


def block_of(docs, vocabulary):
    counted = [(key, S.count_terms(text.encode(), vocabulary)) for key, text in docs]
    counted = [(key, c) for key, c in counted if c[0]]
    lengths = np.array([c[0] for _, c in counted])
    return S.make_block(
        np.array([key for key, _ in counted]), np.zeros(len(counted), bool), lengths,
        np.array([len(c[1]) for _, c in counted]), np.concatenate([c[1] for _, c in counted]),
        np.concatenate([c[2] for _, c in counted]), len(counted), int(lengths.sum()))


@pytest.mark.parametrize("share", [0.0, 0.25, 100.0])
@pytest.mark.parametrize("top", [1, 3, 20, 5000])
def test_any_split_of_short_and_long_lists_gives_the_best(monkeypatch, share, top):
    monkeypatch.setattr(S, "RANGE_DOCS", 16)
    monkeypatch.setattr(S, "ACCUMULATED", share)
    texts = random_texts(1, 900)
    random.Random(2).shuffle(texts)
    docs = list(enumerate(texts + texts[:50]))  # repeated texts: equal scores
    items = list(enumerate(random_texts(3, 25, longest=20)))
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in items for t in S.terms_of(text)}))}
    n_docs = sum(1 for _, t in docs if terms(t))
    df = Counter(t for _, text in docs for t in set(S.terms_of(text)))
    weighted = [[(vocabulary[t], k * S.weight_of(n_docs, df[t])) for t, k in sorted(Counter(S.terms_of(text)).items()) if t in df]
                for _, text in items]
    whole, opened, ranges = block_of(docs, vocabulary), 0, 0
    got = []
    for (item, _), pairs in zip(items, weighted, strict=True):
        best = S.nothing()
        opened += S.search_block(whole, pairs, best, top)
        ranges += len(whole.bounds) - 1
        got += [(item, r, int(d), int(s)) for r, (d, s) in enumerate(zip(best.ids, best.scores, strict=True), 1)]
    assert got == brute(docs, items, top)
    if top == 1:
        assert opened < 0.75 * ranges  # many ranges stay shut


def test_ranges_that_cannot_win_are_skipped(monkeypatch):
    """Rare terms' accumulators set the threshold; the common term's list is read next to them only."""
    monkeypatch.setattr(S, "RANGE_DOCS", 8)
    docs = [(i, "common " * (1 + i % 3) + "filler " * 5 + ("rare rare " if i % 100 == 3 else "")) for i in range(2000)]
    vocabulary = {b"common": 0, b"rare": 1}
    block = block_of(docs, vocabulary)
    best = S.nothing()
    opened = S.search_block(block, [(0, 2), (1, 5000)], best, 10)
    assert opened <= 20 and set(best.ids.tolist()) <= {i for i, _ in docs if i % 100 == 3} and len(best.ids) == 10


def test_search_against_brute_force(spark):
    docs = list(enumerate(random_texts(5, 700))) + [(3, "w1 w2 w2"), (None, "w5 w6"), (9, None), (10, ""), (11, " .,")]
    items = list(enumerate(random_texts(6, 30, longest=15))) + [(77, None), (78, ""), (79, "unknownterm"), (None, "w3 w4 W3")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = S.search(df, bench)
    assert by_item(tuple(r) for r in got.collect()) == by_item(brute(docs, items))
    few = S.search(df, bench, top=2)
    assert by_item(tuple(r) for r in few.collect()) == by_item(brute(docs, items, 2))


def test_shards_of_items_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(random_texts(7, 200))), "doc_id bigint, text string")
    items = spark.createDataFrame(list(enumerate(random_texts(8, 12))), "item_id bigint, text string")
    one = by_item(tuple(r) for r in S.search(docs, items).collect())
    monkeypatch.setattr(S, "SHARD_CHARS", 400)
    many = S.search(docs, items)
    assert by_item(tuple(r) for r in many.collect()) == one


def test_blocks_hold_all_rows_and_no_more_than_they_may(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_DOCS", 40)
    monkeypatch.setattr(S, "BLOCK_POSTINGS", 300)
    docs = spark.createDataFrame(list(enumerate(random_texts(9, 150))), "doc_id bigint, text string").coalesce(1)
    vocabulary = {f"w{i}".encode(): i for i in range(300)}
    rows = S.index(docs, vocabulary).toArrow()
    blocks = list(S.blocks_of(iter(rows.to_batches()), 150, 4000))
    assert sum(len(b.ids) for b in blocks) == rows.num_rows and max(len(b.ids) for b in blocks) <= 40
    assert max(len(b.docs) for b in blocks) <= 300 + 60
    assert sum(len(b.docs) for b in blocks) == rows.column("terms").combine_chunks().flatten().__len__()


def test_one_very_long_document(spark):
    long = " ".join(random_texts(10, 1, longest=10)) + " needle " + "hay " * 600_000
    docs = [(1, long), (2, "needle in hay"), (3, "hay")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = [(0, "needle"), (1, "hay")]
    got = S.search(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert by_item(tuple(r) for r in got.collect()) == by_item(brute(docs, items))


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "one 日本語 é a"), (1, "one 日本語 é a"), (2, "zzzz")], "item_id bigint, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("length", "rank", "score")])
    got = S.search(edge_docs, items)
    read = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert by_item(tuple(r) for r in got.collect()) == by_item(brute(read, [(r[0], r[1]) for r in items.collect()]))
    assert S.search(no_docs, items).collect() == [] and S.search(edge_docs, items.limit(0)).collect() == []
    assert S.search(no_docs, items).columns == ["item_id", "rank", "doc_id", "score"]
