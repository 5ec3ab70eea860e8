import math
import re
from collections import Counter

import numpy as np

from lakeops.llm import quality_rules as Q

from .conftest import DOCS, prose

WORD = re.compile(Q.WORD)


def base_of(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    repeated = len(lines) - len(set(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(map((text or "").count, Q.SYMBOLS)), repeated, len(covered), failed), len(lines)


def judged(docs):
    """The same estimates row by row with numpy."""
    stats, groups = [], []
    for r in docs:
        (n, chars, symbols, repeated, covered, _), lines = base_of(r["text"])
        n, lines = max(1, n), max(1, lines)
        v = [math.log(max(1, chars) / n), math.log(0.02 + symbols / n), math.log(0.02 + covered / n), math.log(0.02 + repeated / lines)]
        stats.append([math.floor(x * Q.UNIT + 0.5) for x in v])
        groups.append((r["lang"], r["source"]))
    x, floor = np.array(stats, float) / Q.UNIT, np.array(Q.LEAST_SPREAD)

    def estimate(key):
        own = x[[g[:len(key)] == key for g in groups]]
        low, middle, high = (np.array([sorted(c)[math.ceil(len(c) * q / 4) - 1] for c in own.T]) for q in (1, 2, 3))
        centre, root = middle, np.diag(np.maximum((high - low) / 1.349, floor))
        for _ in range(Q.STEPS):
            d2 = (np.linalg.solve(root, (own - centre).T) ** 2).sum(axis=0)
            far = np.floor(Q.CLASSES * np.log2(1 + d2))
            limit = sorted(far)[math.ceil(len(far) * Q.CORE) - 1]
            core = own[far <= limit]
            centre = core.mean(axis=0)
            shared = ((core[:, :, None] * core[:, None, :]).mean(axis=0) - np.outer(centre, centre)) * Q.core_factor(Q.CORE, 4)
            root = np.linalg.cholesky(shared + np.diag(floor ** 2))
        return len(own), centre, shared

    def mixed(key):
        n, centre, shared = estimate(key)
        if not key:
            return centre, shared
        (wide_centre, wide_shared), share = mixed(key[:-1]), n / (n + Q.WIDER_ROWS)
        return share * centre + (1 - share) * wide_centre, share * shared + (1 - share) * wide_shared

    out, known = [], {}
    for v, g in zip(x, groups, strict=True):
        if g not in known:
            centre, shared = mixed(g)
            known[g] = centre, np.linalg.cholesky(shared + np.diag(floor ** 2))
        out.append(float((np.linalg.solve(known[g][1], v - known[g][0]) ** 2).sum()))
    return out


def test_quantiles():
    assert abs(Q.chi2_quantile(0.95, 4) - 9.4877) < 1e-3 and abs(Q.chi2_cdf(5.3853, 4) - 0.75) < 1e-4


def test_verdicts_against_row_by_row(spark):
    rows = []
    for i in range(700):
        text = prose(i, 55 + i % 90)
        if i % 23 == 0:
            text = " ".join(w + "***" for w in text.split())
        if i % 37 == 0:
            text += "\n" + "\n".join([prose(i, 6)] * 5)
        rows.append((i, text, ["en", "de", None][i % 3 if i % 2 else 0], "abcd"[i % 4 if i % 3 else 0], len(text)))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = {r["doc_id"]: r for r in Q.verdicts(docs).collect()}
    limit = Q.chi2_quantile(1 - Q.TAIL, 4)
    collected = docs.collect()
    for r, distance in zip(collected, judged(collected)):
        got = found[r["doc_id"]]
        base, _ = base_of(r["text"])
        assert tuple(got[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base
        assert abs(got["distance"] - distance) < 1e-6 * max(1, distance)
        assert got["kept"] == (not base[5] and distance <= limit)
    rejected = {i for i, r in found.items() if not r["kept"]}
    assert {i for i in range(0, 700, 23)} | {i for i in range(0, 700, 37)} <= rejected
    assert len(rejected) <= len({i for i in range(700) if i % 23 == 0 or i % 37 == 0}) + 2


def group(number, junk):
    """One source of clean texts, and junk of one kind each: symbols, repeated lines, repeated words."""
    rows = [(i, prose(i, 60 + i % 70), "en", "a", 0) for i in range(number)]
    return rows + [(1000 + i, t, "en", "a", 0) for i, t in enumerate(junk)]


def lines_only(seed):
    """80 different words in lines of two, then the same 40 lines again in another order: three words in a row repeat rarely."""
    words = prose(seed, 80).split()
    lines = [" ".join(words[i:i + 2]) for i in range(0, 80, 2)]
    return "\n".join(lines + sorted(lines))


def words_only(seed):
    """Two fifths of the words stand in runs that come twice; no line does."""
    run = prose(seed, 24)
    return f"{run} {prose(seed + 1, 40)} {run} {prose(seed + 2, 36)}"


def test_each_statistic_rejects_alone(spark):
    limit = Q.chi2_quantile(1 - Q.TAIL, 4)
    most = [None, None, math.log(0.52 / 0.02), math.log(1.02 / 0.02)]
    assert all((m / least) ** 2 > 1.5 * limit for m, least in zip(most[2:], Q.LEAST_SPREAD[2:]))
    junk = [lines_only(1), lines_only(2), words_only(5), words_only(9), " ".join(w + "***" for w in prose(3, 90).split())]
    found = {r["doc_id"]: r for r in Q.verdicts(spark.createDataFrame(group(150, junk), DOCS)).collect()}
    assert [found[1000 + i]["base_failed"] for i in range(5)] == [False] * 5
    assert [found[1000 + i]["kept"] for i in range(5)] == [False] * 5
    assert all(found[i]["kept"] for i in range(150))


def test_no_size_switches_the_method_on(spark):
    """The distance of the same text changes little from one group size to the next, and small groups reject too."""
    junk = [" ".join(w + "***" for w in prose(3, 90).split()), prose(4, 90)]
    distances = []
    for number in (25, 26, 150, 199, 200, 201):
        found = {r["doc_id"]: r for r in Q.verdicts(spark.createDataFrame(group(number, junk), DOCS)).collect()}
        assert not found[1000]["kept"] and found[1001]["kept"]
        distances.append(found[1000]["distance"])
    assert all(abs(a - b) < 0.1 * a for a, b in ((distances[0], distances[1]), *zip(distances[3:], distances[4:])))


def test_edges(edge_docs, no_docs):
    found = Q.verdicts(edge_docs).collect()
    assert len(found) == edge_docs.count() and all(r["kept"] != r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if r["base_failed"]} == {3, None, 4, 5, 8, 9, 10}
    kept = Q.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "2", "6", "7", "None"]
    assert Q.verdicts(no_docs).count() == 0 and Q.keep_good(no_docs).count() == 0


def test_no_cross_join(spark, monkeypatch):
    """Not even of a language's estimate with that of all, whatever may be broadcast."""
    plans, real = [], Q.settled
    monkeypatch.setattr(Q, "settled", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    docs = spark.createDataFrame(group(30, []), DOCS)
    for threshold in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plans.append(Q.verdicts(docs)._jdf.queryExecution().executedPlan().toString())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) > 10 and not [p for p in plans if "CartesianProduct" in p or "NestedLoopJoin" in p]


def test_no_python_in_the_plan(edge_docs):
    plan = Q.verdicts(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
