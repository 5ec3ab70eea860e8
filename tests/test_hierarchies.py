"""Hierarchies of any depth against a walk from parent to parent."""

import random

import pytest
from conftest import rows

from lakeops.operators import hierarchies as h


def walk(links):
    """unit -> (path, top, cyclic) and the units on cycles, step by step."""
    parent = {}
    for u, p in links:
        if u is not None and p is not None:
            parent[u] = min(parent.get(u, p), p)
    cycle = set()
    for u in parent:
        seen, at = [], u
        while at in parent and at not in seen:
            seen.append(at)
            at = parent[at]
        if at in seen:
            cycle |= set(seen[seen.index(at):])
    out = {}
    for u in parent:
        path, at = [], u
        while at in parent and at not in cycle:
            at = parent[at]
            path.append(at)
        cyclic = at in cycle
        before = path[:-1] if cyclic and path else path
        out[u] = (before, None if cyclic else at, cyclic)
    return out, cycle


def check(spark, links, tmp_path):
    df = spark.createDataFrame(links, "unit string, parent string")
    want, cycle = walk(links)
    got = {r["unit"]: (list(r["path"]), r["top"], r["cyclic"]) for r in h.paths(df, checkpoints=str(tmp_path)).collect()}
    assert got == want
    assert {r["unit"] for r in h.on_cycles(df, checkpoints=str(tmp_path)).collect()} == cycle
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_with_cycles(spark, tmp_path, seed):
    rng = random.Random(seed)
    links = [(f"u{i}", f"u{rng.randint(max(0, i - 6), i - 1)}") for i in range(1, 60)]
    links += [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c"), ("e", "d"), ("s", "s"), ("t", "s"), ("u7", "u1"), ("u9", None), (None, "u1")]
    got = check(spark, links, tmp_path)
    assert got["e"] == (["d"], None, True) and got["s"] == ([], None, True)


def test_a_chain_needs_as_many_rounds_as_its_depth_has_bits(spark, tmp_path, monkeypatch):
    calls = []
    real = h.materialize
    monkeypatch.setattr(h, "materialize", lambda df, **kw: calls.append(1) or real(df, **kw))
    got = check(spark, [(f"{i:03}", f"{i + 1:03}") for i in range(100)], tmp_path)
    assert len(got["000"][0]) == 100 and len(calls) <= 2 * 2 * 9


def test_empty_and_repeated(spark, tmp_path):
    none = spark.createDataFrame([], "unit string, parent string")
    assert h.paths(none, checkpoints=str(tmp_path)).collect() == [] and h.on_cycles(none, checkpoints=str(tmp_path)).collect() == []
    two = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")], "unit string, parent string")
    assert rows(h.repeated_parents(two, "unit", "parent")) == [("a", 2)]
    assert rows(h.paths(two, checkpoints=str(tmp_path)).select("unit", "top")) == [("a", "x"), ("b", "x")]
