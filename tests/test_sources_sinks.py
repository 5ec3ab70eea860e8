from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import upsert
from lakeops.session import use_checkpoints
from lakeops.sources import readers, sinks


def test_delimited_files_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id|name|amount\n1|x|12.0\n2||abc\n")
    df = readers.read_delimited(spark, str(tmp_path / "a.csv"), "|")
    assert dict(df.dtypes) == {"id": "string", "name": "string", "amount": "string"}
    assert rows(df) == [("1", "x", "12.0"), ("2", None, "abc")]
    assert dict(readers.read_inferred_csv(spark, str(tmp_path / "a.csv")).dtypes)["id|name|amount"] == "string"


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n1,2.5\n")
    assert dict(readers.read_inferred_csv(spark, str(tmp_path / "a.csv")).dtypes) == {"id": "int", "amount": "double"}


@pytest.fixture
def landed(tmp_path):
    for name in ("SALES_20240101.csv", "SALES_20240102103000.csv", "SALES_20240103.csv"):
        (tmp_path / name).write_text("id\n1\n")
    return str(tmp_path)


def test_file_provenance(spark, landed):
    df = readers.with_file_provenance(readers.read_delimited(spark, landed))
    got = rows(df.select("FILE_NAME", F.date_format("FILE_DATE", "yyyy-MM-dd HH:mm:ss")))
    assert got == [("SALES_20240101.csv", "2024-01-01 00:00:00"), ("SALES_20240102103000.csv", "2024-01-02 10:30:00"),
                   ("SALES_20240103.csv", "2024-01-03 00:00:00")]


def test_file_window_is_open_at_its_start(spark, landed):
    df = readers.read_delimited(spark, landed)
    # The names carry a clock 5 h 30 min ahead: local midnight of the 1st is 18:30 UTC the day before.
    kept = readers.files_in_window(df, datetime(2023, 12, 31, 18, 30), datetime(2024, 1, 2, 18, 30))
    assert rows(kept.select("_metadata.file_name")) == [("SALES_20240102103000.csv",), ("SALES_20240103.csv",)]


def test_tables_and_lake_paths(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.write_lake(df, str(tmp_path / "t"), partition_by=["v"])
    sinks.write_lake(df, str(tmp_path / "t"), mode="append")
    assert readers.read_lake_table(spark, str(tmp_path / "t")).count() >= 2
    sinks.write_snapshot(df, str(tmp_path / "s"))
    sinks.write_snapshot(df.where("id = 1"), str(tmp_path / "s"))
    assert rows(readers.read_parquet_set(spark, [str(tmp_path / "s")])) == [(1, "a")]
    df.createOrReplaceTempView("two_rows")
    assert rows(readers.read_table(spark, "two_rows", ["v"], "id = 2")) == [("b",)]


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string"), path, ["day"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b"), (3, "c")], "x int, day string"), path, ["day"])
    assert rows(spark.read.parquet(path).select("x", "day")) == [(1, "a"), (3, "c"), (9, "b")]


def test_insert_replaces_touched_partitions_of_a_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS parted")
    spark.sql(f"CREATE TABLE parted (x INT, day STRING) USING parquet PARTITIONED BY (day) LOCATION '{tmp_path}/parted'")
    sinks.insert_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "day string, x int"), "parted")
    sinks.insert_partitions(spark.createDataFrame([("b", 5)], "day string, x int"), "parted")
    assert rows(spark.table("parted").select("x", "day")) == [(1, "a"), (5, "b")]
    spark.sql("DROP TABLE parted")


def test_quarantine_and_materialize(spark, tmp_path):
    fact = spark.createDataFrame([(1, 5, -1), (2, -2, 3), (3, 4, 4)], "id int, a_key long, b_key long")
    sinks.quarantine_unmapped(fact, ["a_key", "b_key"], str(tmp_path / "q"))
    assert rows(spark.read.parquet(str(tmp_path / "q"))) == [(1, 5, -1)]
    assert rows(sinks.materialize(fact, str(tmp_path / "m"))) == rows(fact)


def test_jdbc_writer_keeps_the_table(spark):
    class Seen:
        def __init__(self):
            self.options = {}

        def mode(self, m):
            self.options["mode"] = m
            return self

        def option(self, k, v):
            self.options[k] = v
            return self

    class Frame:
        write = Seen()

    writer = sinks.jdbc_writer(Frame(), properties={"batchsize": "5000"})
    assert writer.options == {"mode": "overwrite", "truncate": "true", "batchsize": "5000"}


def make(spark, data, columns="k int, v string"):
    return spark.createDataFrame(data, columns)


def files_of(path):
    return {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in path.rglob("*=*/*.parquet")}


def test_a_table_is_created_and_merged(spark, tmp_path):
    path = str(tmp_path / "merged")
    load = lambda data, **kw: upsert.create_or_upsert(spark, path, make(spark, data), ["k"], checkpoints=str(tmp_path / "c"), **kw)
    assert upsert.read_merged(spark, path) is None
    load([(1, "a"), (2, "b")])
    load([(2, "B"), (3, "c")])
    assert rows(upsert.read_merged(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    load([(2, "B"), (3, "c")])  # the same batch again changes nothing
    assert rows(upsert.read_merged(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    load([])
    assert upsert.read_merged(spark, path).columns == ["k", "v"] and upsert.read_merged(spark, path).count() == 3


def test_a_load_writes_only_the_partitions_of_its_keys(spark, tmp_path):
    path, folder = tmp_path / "bucketed", str(tmp_path / "c")
    upsert.create_or_upsert(spark, str(path), make(spark, [(i, "a") for i in range(100)]), ["k"], buckets=16, checkpoints=folder)
    first = files_of(path)
    upsert.create_or_upsert(spark, str(path), make(spark, [(5, "b"), (500, "c")]), ["k"], buckets=16, checkpoints=folder)
    second = files_of(path)
    changed = {f.parent.name for f in first.keys() ^ second.keys()}
    assert 1 <= len(changed) <= 2 and all(second[f] == first[f] for f in first.keys() & second.keys())
    assert rows(upsert.read_merged(spark, str(path)).where("v != 'a'")) == [(5, "b"), (500, "c")]
    assert upsert.read_merged(spark, str(path)).count() == 101


def test_repeated_keys_are_refused_or_resolved(spark, tmp_path):
    path, folder = str(tmp_path / "repeated"), str(tmp_path / "c")
    upsert.create_or_upsert(spark, path, make(spark, [(1, "a")]), ["k"], checkpoints=folder)
    batch = make(spark, [(1, "b"), (1, "c")])
    with pytest.raises(Exception, match="more than once"):
        upsert.create_or_upsert(spark, path, batch, ["k"], checkpoints=folder)
    assert rows(upsert.read_merged(spark, path)) == [(1, "a")]
    with pytest.raises(Exception, match="more than once"):
        upsert.upsert(make(spark, [(1, "a")]), batch, ["k"]).collect()
    upsert.create_or_upsert(spark, path, batch, ["k"], order=[F.col("v")], checkpoints=folder)
    assert rows(upsert.read_merged(spark, path)) == [(1, "c")]


def test_null_keys_match_only_when_asked(spark, tmp_path):
    for nullable, expected in ((True, [(None, "b"), (1, "a")]), (False, [(None, "a"), (None, "b"), (1, "a")])):
        path, folder = str(tmp_path / f"nulls_{nullable}"), str(tmp_path / "c")
        upsert.create_or_upsert(spark, path, make(spark, [(None, "a"), (1, "a")]), ["k"], nullable, checkpoints=folder)
        upsert.create_or_upsert(spark, path, make(spark, [(None, "b")]), ["k"], nullable, checkpoints=folder)
        assert rows(upsert.read_merged(spark, path)) == expected


def test_new_columns_come_with_later_loads(spark, tmp_path):
    path, folder = str(tmp_path / "columns"), str(tmp_path / "c")
    upsert.create_or_upsert(spark, path, make(spark, [(1, "a")]), ["k"], checkpoints=folder)
    upsert.create_or_upsert(spark, path, make(spark, [(2, "b", 7)], "k int, v string, w int"), ["k"], checkpoints=folder)
    assert rows(upsert.read_merged(spark, path).select("k", "v", "w")) == [(1, "a", None), (2, "b", 7)]


# --- partitioned and bucketed tables ------------------------------------------------------


def scans(df):
    """(number of files read, plan text) of the executed scans."""
    df.collect()
    files, todo, text = [], [df._jdf.queryExecution().executedPlan()], df._jdf.queryExecution().executedPlan().toString()
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if "Scan parquet" in node.nodeName():
            files.append(int(node.metrics().get("numFiles").get().value()))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return files, text


@pytest.fixture
def by_snapshot(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 20).cast("int").alias("snapshot"), F.col("id").alias("v"),
                                 F.when(F.col("id").isin(7, 27), 100).otherwise(F.col("id") % 50).cast("int").alias("changed"))
    path = str(tmp_path / "snapshots")
    df.repartition(1).write.partitionBy("snapshot").parquet(path)
    return spark.read.parquet(path)


def test_touched_snapshots_alone_are_read_whole(by_snapshot):
    got = sinks.export_touched_snapshots(by_snapshot, 99, "snapshot", "changed")
    files, text = scans(got)
    assert "dynamicpruning" in text and sorted(files) == [1, 20]  # all dates for the stamp, one for its rows
    assert rows(got.select("v")) == sorted([(v,) for v in range(7, 400, 20)], key=str)


def test_latest_snapshots_alone_are_read(by_snapshot):
    got = sinks.export_latest_snapshots(by_snapshot, "snapshot", 3)
    files, text = scans(got)
    assert files == [3] and "PartitionFilters: [snapshot" in text and got.count() == 60
    assert sinks.export_latest_snapshots(by_snapshot.limit(0), "snapshot", 3).count() == 0


def test_bucketed_tables_are_joined_and_aggregated_where_they_lie(spark, tmp_path):
    import uuid
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    df = spark.range(2000).select((F.col("id") % 300).alias("doc"), (F.col("id") % 7).alias("line"), "id")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        a, b = (sinks.write_bucketed(df, n, ["doc"], 6, str(tmp_path / n)) for n in names)
        out = a.groupBy("doc", "line").agg(F.sum("id").alias("s")).join(
            b.groupBy("doc").agg(F.count(F.lit(1)).alias("n")), "doc").join(b.select("doc", "line").distinct(), ["doc", "line"])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.agg(F.sum("s")).first()[0] == 2000 * 1999 // 2
        assert len(list((tmp_path / names[0]).glob("*.parquet"))) == 6
    finally:
        for key in settings:
            spark.conf.unset(key)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


class Session:
    """Just the settings use_checkpoints reads."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = self
        self.master = master
        self.used = None

    def setCheckpointDir(self, folder):
        self.used = folder


def test_checkpoint_folder_comes_from_the_session():
    cluster = Session("spark://host:7077", "/shared/checkpoints")
    assert use_checkpoints(cluster) == cluster.used == "/shared/checkpoints"
    assert use_checkpoints(cluster, "/other") == "/shared/checkpoints"
    laptop = Session("local[2]", None)
    assert use_checkpoints(laptop, "/tests") == laptop.used == "/tests"
    for master in ("yarn", "local[2]"):
        with pytest.raises(ValueError):
            use_checkpoints(Session(master, None))


def test_checkpointed_result(spark, tmp_path):
    df = sinks.materialize(spark.range(3).withColumn("v", F.col("id") * 2), checkpoints=str(tmp_path))
    assert rows(df) == [(0, 0), (1, 2), (2, 4)]
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
