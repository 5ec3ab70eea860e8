import random

import numpy as np
import xxhash

from lakeops.llm import simhash as S
from lakeops.llm.components import components

from .conftest import DOCS, prose


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(fps, radius):
    """Smallest member reachable over links of at most ``radius`` bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for text in ["", " ", "One", "one TWO", "É İ A\tb\nc d", prose(3, 400), "a b c " * 30]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def test_bit_slices_give_all_distances():
    rng = random.Random(4)
    for radius in (1, 3, 5, 9):
        base = rng.getrandbits(64)
        fps = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12))) for _ in range(150)]
        group = [i % 2 for i in range(150)]
        near = S.near_bits(np.array(fps, np.uint64).view(np.int64), np.array(group), radius)
        lanes = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :150]
        for i in range(150):
            assert [j for j in range(150) if lanes[i, j]] == [
                j for j in range(150) if group[i] == group[j] and (fps[i] ^ fps[j]).bit_count() <= radius]


def chains(seed):
    """Fingerprints in chains and dense clusters, and many alone."""
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for start in range(20):
        now = fps[start]
        for _ in range(rng.randint(1, 9)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                now ^= 1 << b
            fps.append(now)
    centre = rng.getrandbits(64)
    fps += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(200)]
    rng.shuffle(fps)
    return sorted(set(fps))


def test_links_join_what_is_near_also_in_large_buckets(spark):
    fps = chains(9)
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp bigint").repartition(3)
    expected = closed(fps, 3)
    for rows in (1024, 8):
        found = {r["node"]: r["root"] for r in components(S.links(df, 3, rows)).collect()}
        label = [found.get(f - (f >> 63 << 64), f - (f >> 63 << 64)) for f in fps]
        assert len(set(zip(label, expected))) == len(set(label)) == len(set(expected))


def test_components_of_long_paths(spark):
    order = list(range(400))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1001), (1001, 1000), (1002, 1002)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 400)}, 1001: 1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents_against_brute_force(spark):
    rows = []
    for i in range(60):
        text = prose(i // 3, 200)
        rows.append((100 - i, text if i % 3 else text.upper() + " z", "en", "a", 1))
    docs = spark.createDataFrame(rows, DOCS)
    ids = sorted(r[0] for r in rows)
    text = {r[0]: r[1] for r in rows}
    fps = [plain_fingerprint(text[i]) for i in ids]
    expected = {i: (f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, closed(fps, 3))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.near_duplicates(docs).collect()} == expected
    assert sorted(r["doc_id"] for r in S.one_of_each(docs).collect()) == sorted({c for _, c in expected.values()})


def test_edges(edge_docs, no_docs):
    found = S.near_duplicates(edge_docs).collect()
    assert len(found) == edge_docs.count()
    of = {r["doc_id"]: r for r in found}
    assert of[2]["component_id"] == 1 and of[7]["component_id"] == 6
    assert {of[i]["component_id"] for i in (3, 4, 5)} == {3} and of[4]["fingerprint"] == "0" * 16
    kept = S.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "10", "3", "6", "8", "9", "None"]
    assert S.near_duplicates(no_docs).count() == 0 and S.one_of_each(no_docs).count() == 0


def test_block_of_far_fingerprints_is_left_early(monkeypatch):
    rng = random.Random(4)
    fps = np.array([rng.getrandbits(64) for _ in range(100)], np.uint64).view(np.int64)
    calls, add = [], S._add
    monkeypatch.setattr(S, "_add", lambda *bits: calls.append(1) or add(*bits))
    assert S.star_links(fps, np.zeros(100, int), 3) == [] and len(calls) < 3 * 16
    calls.clear()
    near = np.append(fps, fps[0] ^ 3)
    assert S.star_links(near, np.zeros(101, int), 3) == [(int(fps[0]), int(near[-1]))] and len(calls) == 3 * 16
