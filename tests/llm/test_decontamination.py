import math
from collections import Counter

import numpy as np

from lakeops.llm import decontamination as D

from .conftest import DOCS, prose

ITEMS = [(i, f"What is {prose(100 + i, 14)}?\nIt is {prose(200 + i, 8)}.") for i in range(50)]


def scores(items, passage):
    """BM25 by its formula, item by item."""
    words = {i: D.words_of(t) for i, t in items}
    n, mean = len(items), sum(map(len, words.values())) / len(items)
    df = Counter(t for w in words.values() for t in set(w))
    out = {}
    for i, w in words.items():
        own = {}
        for t, tf in Counter(w).items():
            own[t] = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (D.K1 + 1) / (tf + D.K1 * (1 - D.B + D.B * len(w) / mean))
        out[i] = sum(v for t, v in own.items() if t in passage) / sum(own.values())
    return out


def one_index(items):
    words = {i: Counter(D.words_of(t)) for i, t in items}
    df = Counter(t for w in words.values() for t in w)
    lengths = [sum(w.values()) for w in words.values()]
    totals = D.Totals(len(items), sum(lengths) / len(items), max(lengths))
    return D.build_index([(i, t, [(w, n, df[w]) for w, n in words[i].items()]) for i, t in items], totals)


def test_search_finds_all_above_the_threshold():
    index = one_index(ITEMS)
    step = index.longest
    for seed in range(30):
        text = " ".join([prose(seed, 40), ITEMS[seed][1][: 60 + seed * 3], prose(seed + 500, 200), "is it what", ITEMS[-seed - 1][1][30:]])
        words = D.words_of(text)
        ids = np.array([index.terms.get(w, len(index.postings)) for w in words], np.int32)
        best = {}
        for s in range(0, max(1, len(words) - step), step):
            for i, v in scores(ITEMS, set(words[s:s + 2 * step])).items():
                if v >= 0.25:
                    best[i] = max(v, best.get(i, 0))
        found = {index.items[i]: v for i, v in D.search_document(index, ids, 0.25).items()}
        assert found.keys() == best.keys() and all(abs(found[i] - best[i]) < 1e-9 for i in best)


def planted(spark):
    changed = ITEMS[3][1].split()
    changed[5] = "other"
    rows = [
        (1, prose(1, 300) + " " + ITEMS[7][1] + " " + prose(2, 300)), (2, ITEMS[8][1].upper().replace(" ", " *** ")),
        (3, prose(3, 900)), (4, prose(4, 50) + " " + " ".join(changed)), (5, ITEMS[9][1].split("\n")[0] + prose(5, 80)),
        (6, ITEMS[9][1].split("\n")[1] + prose(6, 80)), (7, ITEMS[10][1] + " " + ITEMS[11][1]), (7, ITEMS[10][1] + " " + ITEMS[11][1])]
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)


def test_leaks_need_question_and_answer(spark):
    items = spark.createDataFrame([*ITEMS, (900, None), (901, ""), (None, "x y")], "item_id bigint, text string")
    docs = planted(spark)
    expected = [(1, 7), (2, 8), (4, 3), (7, 10), (7, 10), (7, 11), (7, 11)]
    rows = sorted(D.leaks(docs, items).collect())
    assert [(r["doc_id"], r["item_id"]) for r in rows] == expected
    for chars in (3_000, 500, 1):
        assert sorted(D.leaks(docs, items, piece_chars=chars).collect()) == rows
    again = items.unionByName(items).repartition(7)
    assert sorted(D.leaks(docs, again).collect()) == rows
    assert sorted(r["doc_id"] for r in D.without_leaks(docs, items).collect()) == [3, 5, 6]


def test_one_index_of_all_items(spark):
    items = spark.createDataFrame([*ITEMS, (901, "?"), (None, "x y")], "item_id bigint, text string").repartition(5)
    whole = one_index(ITEMS)
    pieces = list(D.index_pieces(items, 1_500))
    assert len(pieces) > 2 and sorted(i for p in pieces for i in p.items) == [i for i, _ in ITEMS]
    assert {p.longest for p in pieces} == {whole.longest}

    def impacts(index):
        return {(index.items[n], t): v for t, k in index.terms.items() for n, v in zip(*index.postings[k], strict=True)}

    found = {}
    for piece in pieces:
        found |= impacts(piece)
    assert found == impacts(whole)
    docs = planted(spark)
    plan = D.leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert D.leaks(edge_docs, items).count() == 0 and D.leaks(no_docs, items).count() == 0
    assert D.leaks(edge_docs, items.limit(0)).count() == 0
    kept = D.without_leaks(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
