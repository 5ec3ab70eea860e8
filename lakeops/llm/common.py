"""What the operators of this package share: tables, shipping the code, shared checkpoints."""

from __future__ import annotations

import random
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Send this library to the executors once per session, as ``--py-files`` would."""
    context = spark.sparkContext
    if not getattr(context, "_lakeops_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="lakeops-code-")) / "lakeops_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._lakeops_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's own; only one that names none (a test) gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_SETTING, None) or tempfile.mkdtemp(prefix="lakeops-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, with the lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sample_texts(docs: DataFrame, doc_id: str, text: str, most: int, chars: int) -> list[str]:
    """At most ``most`` texts, not blank: those whose id and text hash lowest.

    Of a text longer than ``chars`` it is that many characters from a place that a hash chooses.
    Only rows with hashes so low that a few times ``most`` are expected are sorted, so that the
    driver gets as much from many partitions as from few.
    """
    rows = docs.select(docs[text].alias("text"), F.xxhash64(docs[doc_id], docs[text]).alias("h")).where(
        F.col("text").isNotNull() & (F.trim("text") != ""))
    share = min(1.0, 8 * most / max(1, rows.count()))
    lowest = F.lit(int(-2 ** 63 + share * (2 ** 64 - 2048)))
    more = F.greatest(F.length("text") - chars, F.lit(0))
    start = F.pmod(F.xxhash64("h", F.lit("place")), more + 1).cast("int") + 1
    part = F.when(more > 0, F.substring("text", start, F.lit(chars))).otherwise(F.col("text")).alias("text")
    return [r["text"] for r in rows.where(F.col("h") <= lowest).select("h", part).orderBy("h", "text").limit(most).collect()]


def made_up_texts(number: int, seed: int) -> list[str]:
    """Sentences of made-up words: what training puts its items into where a table has too few texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("eeeaaiioonnttsrrhldcumfpgwyb") for _ in range(rng.randint(1, 11)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(5, 14))).capitalize() + "."
    return [" ".join(sentence() for _ in range(8)) for _ in range(number)]


def spare(df: DataFrame, name: str) -> str:
    """A column name the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, marked: DataFrame, bad: DataFrame, doc_id: str, key: str) -> DataFrame:
    """``docs`` without the rows whose id and text key are in ``bad``; ``marked`` is ``docs`` with the key."""
    gone = bad.select(F.col("doc_id").alias("gone_id"), F.col(key).alias("gone_key")).distinct()
    same = marked[doc_id].cast("bigint").eqNullSafe(gone["gone_id"]) & (marked[key] == gone["gone_key"])
    return marked.join(gone, same, "left_anti").select(*[marked[c] for c in docs.columns])


def keyed_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, under fixed names."""
    return df.select(df[key].cast("bigint").alias("doc_id"), df[text].alias("text"))


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    """(id, text) of each row, one text at a time; a null text becomes an empty one."""
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        yield key, text.as_py() or ""


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
