import zlib

import pytest
from pyspark.sql import functions as F

from lakeops.llm import sharding as S

from .conftest import DOCS, prose


def test_curve_steps_go_to_neighbours(spark):
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = spark.range(1 << dims * bits).withColumn("cell", F.col("id").cast("int"))
        rows = sorted((r["curve"], r["cell"]) for r in S.with_curve_index(cells, "cell", dims, bits).collect())
        assert [c for c, _ in rows] == list(range(1 << dims * bits))
        low = (1 << bits) - 1
        axes = [[cell >> bits * k & low for k in range(dims)] for _, cell in rows]
        assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(axes, axes[1:]))


def laws(rows, n):
    sizes = [0] * S.SHARDS
    slots = {}
    for r in rows:
        sizes[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_documents(spark, tmp_path):
    rows = [(i, "hot text" if i % 3 == 0 else prose(i, 5 + i % 40), "en", "src0" if i % 3 == 0 else f"s{i % 7}", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    placed = S.shard_documents(docs)
    found = placed.collect()
    laws(found, 900)
    text = {r[0]: r[1].encode() for r in rows}
    for r in found:
        data = text[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in S.shard_documents(docs.repartition(2)).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in found}
    spread = {}
    for r in found:
        spread.setdefault(r["shard"], set()).add(r["doc_id"] * 16 // 900)
    assert sum(map(len, spread.values())) / len(spread) < 16
    S.write_shards(docs, placed, "doc_id", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 900


def test_ids_in_steps_spread_over_the_parts(spark):
    for step in (1, S.PARTS, 1 << 20, 1 << 31, -S.PARTS, 12_000_000_007):
        ids = spark.range(20_000).select((F.col("id") * step).alias("id"))
        sizes = [r["count"] for r in ids.groupBy(S.spread(F.col("id")).alias("part")).count().collect()]
        assert len(sizes) > 1_000 and max(sizes) <= 200, step
    parts = {r["p"] for r in spark.range(-5_000, 5_000).select(S.spread(F.col("id")).alias("p")).collect()}
    assert min(parts) >= 0 and max(parts) < S.PARTS


def test_write_shards_refuses_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1), (1, "b", "en", "s", 1)], DOCS)
    with pytest.raises(ValueError, match="1 rows repeat"):
        S.write_shards(docs, S.shard_documents(docs), "doc_id", str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_edges(edge_docs, no_docs):
    found = S.shard_documents(edge_docs).collect()
    laws(found, edge_docs.count())
    assert {(r["size"], r["text_crc32"]) for r in found if r["doc_id"] in (3, 4)} == {(1, 0)}
    assert S.shard_documents(no_docs).count() == 0
    plan = S.shard_documents(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
