"""Shards along a Hilbert curve, in DataFrame operations only.

Several metadata dimensions are quantised to a few bits each; the cell they name has a place on
the Hilbert curve through all cells. Rows sorted by that place are cut into runs of equal length,
so a shard covers a compact region in every dimension and a filter on any of them skips files.

Ranks come from counts, without a global sort: rows per cell are summed along the curve (at most
``2 ** (dimensions * bits)`` cells), rows per part of a cell are summed within the cell, and only
rows of one part are ordered together. The part is a hash of the leading order column, so a cell
that holds a third of all rows is spread over its ``PARTS`` parts whatever the steps between ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settled

BITS = 4
PARTS = 4096
#: An odd factor near 2**32 over the golden ratio: the high bits of its products are spread evenly.
MIX = 2_654_435_761
SHARDS = 16
MOST_CELLS = 65_536


def equal_widths(value: Column, low: Column, high: Column, bits: int = BITS) -> Column:
    """The slice of [low, high] a number falls in; null counts as the lowest."""
    share = (value.cast("double") - low) / (high.cast("double") - low + 1)
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(share * (1 << bits)))), F.lit(0)).cast("int")


def log_sizes(size: Column, skip: int = 4, bits: int = BITS) -> Column:
    """Doubling classes: sizes below ``2 ** (skip + 1)`` share the first."""
    return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(F.log2(size.cast("double"))) - skip)).cast("int")


def hashed(value: Column, bits: int = BITS) -> Column:
    """A slot for a name; null counts as empty."""
    return F.crc32(F.coalesce(value, F.lit("")).cast("binary")).bitwiseAND((1 << bits) - 1).cast("int")


def spread(value: Column, parts: int = PARTS) -> Column:
    """A part for a number: multiplicative hashing of its folded 31 bits, in whole numbers; null counts as zero."""
    low = 0x7FFFFFFF
    value = F.coalesce(value.cast("bigint"), F.lit(0))
    folded = value.bitwiseXOR(F.shiftright(value, 31)).bitwiseXOR(F.shiftright(value, 62)).bitwiseAND(low).cast("bigint")
    mixed = F.shiftright((folded * F.lit(MIX)).bitwiseAND(0xFFFFFFFF), 8)
    return F.shiftright(mixed * F.lit(parts), 24).cast("int")


def _bit(value: Column, at: int) -> Column:
    return F.shiftright(value, at).bitwiseAND(1)


def with_curve_index(cells: DataFrame, cell: str, dims: int, bits: int = BITS, name: str = "curve") -> DataFrame:
    """The place of a cell on the curve; ``cell`` holds the dimensions' numbers, the first one highest."""
    axes = [f"_x{i}" for i in range(dims)]
    low = (1 << bits) - 1
    df = cells.withColumns({
        a: F.shiftright(F.col(cell), bits * (dims - 1 - i)).bitwiseAND(low) for i, a in enumerate(axes)})
    first = F.col(axes[0])
    for at in range(bits - 1, 0, -1):
        rest = (1 << at) - 1
        for i, a in enumerate(axes):
            swap = first.bitwiseXOR(F.col(a)).bitwiseAND(rest)
            flip = _bit(F.col(a), at) == 1
            new = {axes[0]: F.when(flip, first.bitwiseXOR(rest)).otherwise(first.bitwiseXOR(swap))}
            if i:
                new[a] = F.when(flip, F.col(a)).otherwise(F.col(a).bitwiseXOR(swap))
            df = df.withColumns(new)
    for before, a in zip(axes, axes[1:], strict=False):
        df = df.withColumn(a, F.col(a).bitwiseXOR(F.col(before)))
    gray = F.lit(0)
    for at in range(bits - 1, 0, -1):
        gray = gray.bitwiseXOR(F.when(_bit(F.col(axes[-1]), at) == 1, (1 << at) - 1).otherwise(0))
    df = df.withColumn("_gray", gray).withColumns({a: F.col(a).bitwiseXOR(F.col("_gray")) for a in axes})
    index = F.lit(0)
    for at in range(bits - 1, -1, -1):
        for a in axes:
            index = F.shiftleft(index, 1).bitwiseOR(_bit(F.col(a), at))
    return df.withColumn(name, index).drop("_gray", *axes)


def hilbert_shards(rows: DataFrame, dims: list[str], order: list[str], shards: int = SHARDS,
                   bits: int = BITS, parts: int = PARTS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shards differ by one row at most, slots have no gaps.

    ``dims`` are integer columns of ``bits`` bits; ``order`` (an integer first) settles the order
    inside a cell, after a hash of its first column. Repeated rows take neighbouring slots; an empty table stays empty.
    """
    if bits * len(dims) > 16:
        raise ValueError(f"more than {MOST_CELLS} cells")
    cell = F.lit(0)
    for d in dims:
        cell = F.shiftleft(cell, bits).bitwiseOR(F.col(d))
    slim = settled(rows.withColumns({"_cell": cell, "_part": spread(F.col(order[0]), parts)}))
    sizes = slim.groupBy("_cell", "_part").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy("_cell").orderBy("_part")
    part_starts = sizes.select("_cell", "_part", (F.sum("_n").over(inside) - F.col("_n")).alias("_part_start"))
    cells = with_curve_index(sizes.groupBy("_cell").agg(F.sum("_n").alias("_n")), "_cell", len(dims), bits)
    along = Window.orderBy("curve")
    cell_starts = cells.select(
        "_cell", (F.sum("_n").over(along) - F.col("_n")).alias("_cell_start"),
        F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_rows"))
    within = Window.partitionBy("_cell", "_part").orderBy(*order)
    ranked = slim.withColumn("_at", F.row_number().over(within) - 1).join(part_starts, ["_cell", "_part"])
    # At most MOST_CELLS rows of three numbers.
    ranked = ranked.join(F.broadcast(cell_starts), "_cell").withColumn(
        "_rank", F.col("_cell_start") + F.col("_part_start") + F.col("_at"))
    shard = F.expr(f"_rank * {shards} div _rows")
    return ranked.withColumn("shard", shard.cast("int")).withColumn(
        "slot", F.col("_rank") - F.expr(f"(shard * _rows + {shards - 1}) div {shards}")).select(
        *rows.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
                    lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    The curve runs through language, source, size and id. Size is the text's UTF-8 bytes plus one;
    a null text counts as empty, a null id lies in the lowest slice. The law is ``rows``.
    """
    body = F.coalesce(docs[text], F.lit("")).cast("binary")
    slim = docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"), hashed(docs[lang]).alias("_lang"), hashed(docs[source]).alias("_source"))
    ends = docs.agg(F.min(doc_id).alias("low"), F.max(doc_id).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    slim = slim.withColumns({
        "_size": log_sizes(F.col("size")), "_range": equal_widths(F.col("doc_id"), low, high),
        "_order": F.coalesce("doc_id", "text_crc32")})
    placed = hilbert_shards(slim, ["_lang", "_source", "_size", "_range"], ["_order", "text_crc32", "size"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def write_shards(rows: DataFrame, placed: DataFrame, key: str, path: str) -> None:
    """The rows as files by shard, each file a run of slots; a ``key`` repeated or null in either frame fails."""
    counts = [F.count("*").alias("n"), F.countDistinct(key).alias("keys")]
    for frame in (rows, placed):
        seen = frame.agg(*counts).first()
        if seen["n"] != seen["keys"]:
            raise ValueError(f"{seen['n'] - seen['keys']} rows repeat or lack their {key}")
    joined = rows.join(placed.select(key, "shard", "slot"), key)
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
