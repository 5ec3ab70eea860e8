"""SimHash near-duplicates: fingerprints compared bit-sliced within buckets of shared bits.

Two fingerprints that differ in at most ``radius`` bits agree on all of one of ``radius + 1``
bands, and among the other bits again on one of ``radius + 1`` parts. A bucket holds the distinct
fingerprints that agree on such a band and part. Within it the fingerprints stand as 64 vertical
bit planes; a query adds the planes' differing bits into carry-save counters, for all fingerprints
of the block at once, and leaves the block as soon as every one is beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import as_batch, settled, ship, spare, texts_of, without
from .components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BUCKET_ROWS = 1024
LANES = 256
SLICE = 65_536
ALL = (1 << 64) - 1


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is 1 if it is 1 in more than half of the shingles' hashes; without a word, zero.

    Words are split at ASCII white space after A-Z are lower-cased: what bytes do by themselves.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    shifted = [words[i:] for i in range(shingle_words)]
    shingles = [b" ".join(s) for s in zip(*shifted, strict=False)] or [b" ".join(words)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), SLICE):
        part = shingles[at:at + SLICE]
        hashes = np.fromiter((xxh64_intdigest(s, seed) for s in part), "<u8", len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, doc_id: str = "doc_id",
                 text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the fingerprint as a signed 64-bit number and the carried columns, one row per row."""
    ship(docs.sparkSession)
    read = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(value, shingle_words) for _, value in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, "<u8").view("<i8"), pa.int64()), *batch.columns[2:]],
                names=["doc_id", "fp", *carry])

    return read.mapInArrow(run, T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())] + read.schema.fields[2:]))


def parts_of(mask: int, parts: int) -> list[int]:
    """The mask with one of ``parts`` near equal parts of the bits outside it added."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (mask >> 63 << 64)


def _masks(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)) for m in masks])


def _sized(keyed: DataFrame) -> DataFrame:
    """Rows of buckets with more than one fingerprint, and the bucket's size."""
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("size")).where("size > 1")
    return keyed.join(sizes, ["mask", "key"])


def buckets(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(mask, key, cell_a, cell_b, fp): any two fingerprints within the radius share a bucket.

    A bucket beyond ``bucket_rows`` is parted again by further bits; what is still beyond it is
    dealt into blocks, and each pair of blocks becomes a bucket of its own. No pair is lost, and no
    bucket is much larger than two blocks.
    """
    bands = radius + 1
    first = [m for band in parts_of(0, bands) for m in parts_of(band, bands)]
    keyed = distinct.select("fp", F.explode(_masks(first)).alias("mask"))
    shared = settled(_sized(keyed.withColumn("key", F.expr("fp & mask"))))
    small = shared.where(F.col("size") <= bucket_rows)
    large = shared.where(F.col("size") > bucket_rows)
    out = small.withColumns({"cell_a": F.lit(0), "cell_b": F.lit(0)})
    if not large.isEmpty():
        finer = F.create_map(*[x for m in first for x in (F.lit(_signed(m)), _masks(parts_of(m, bands)))])
        keyed = large.select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
        shared = settled(_sized(keyed.withColumn("key", F.expr("fp & mask"))))
        blocks = F.ceil(F.col("size") / bucket_rows).cast("int")
        block = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        dealt = shared.withColumns({"block": block, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
        out = out.unionByName(dealt.withColumns({
            "cell_a": F.least("block", "other"), "cell_b": F.greatest("block", "other")}).drop("block", "other"))
    return out.select("mask", "key", "cell_a", "cell_b", "fp")


def _add(a, b, c):
    """Sum and carry of three bits a lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def near_bits(fps: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Row i: which fingerprints of i's group are within the radius, as packed 64-bit lanes.

    Planes hold one bit of all fingerprints; counters hold one bit of all distances. Four planes
    at a time go through carry-save adders, and the block is left once all distances to others are
    too large; a fingerprint is always near itself.
    """
    rows = len(fps)
    words = -(-rows // 64)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((64, words * 64), np.uint8)
    planes[:, :rows] = bits.T
    planes = np.packbits(planes, axis=1, bitorder="little").view("<u8")
    asked = (0 - bits.T.astype(np.uint64))[:, :, None]
    same = np.zeros((rows, words * 64), bool)
    same[:, :rows] = group[:, None] == group[None, :]
    own = np.zeros_like(same)
    own[np.arange(rows), np.arange(rows)] = True
    own = np.packbits(own, axis=1, bitorder="little").view("<u8")
    valid = np.packbits(same, axis=1, bitorder="little").view("<u8") & ~own
    depth = max(2, radius.bit_length())
    counters = [np.zeros((rows, words), np.uint64) for _ in range(depth)]
    over = ~valid
    for p in range(0, 64, 4):
        d = [planes[p + i] ^ asked[p + i] for i in range(4)]
        counters[0], first = _add(counters[0], d[0], d[1])
        counters[0], second = _add(counters[0], d[2], d[3])
        counters[1], carry = _add(counters[1], first, second)
        for level in range(2, depth):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        over = over | carry
        if p % 8 == 4 and (over == ALL).all():
            return own
    beyond = np.zeros((rows, words), np.uint64)
    equal = np.full((rows, words), ALL, np.uint64)
    for level in reversed(range(depth)):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            beyond |= equal & counters[level]
            equal &= ~counters[level]
    return ~(over | beyond) | own


def star_links(fps: np.ndarray, group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius, at most one per fingerprint."""
    near = near_bits(fps, group, radius)
    lanes = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :len(fps)]
    alone = lanes.sum(axis=1) <= 1
    done, links = alone.copy(), []
    for i in np.flatnonzero(~alone):
        if done[i]:
            continue
        found = lanes[i].astype(bool)
        fresh = found.copy()
        fresh[i] = False
        while fresh.any():
            wider = lanes[fresh].any(axis=0)
            fresh = wider & ~found
            found |= wider
        done |= found
        links += [(int(fps[i]), int(fps[j])) for j in np.flatnonzero(found) if j != i]
    return links


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all pairs within the radius."""
    lists = buckets(distinct, radius, bucket_rows).groupBy("mask", "key", "cell_a", "cell_b").agg(
        F.collect_list("fp").alias("fps")).select("fps")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            fps = np.concatenate(held)
            group = np.repeat(np.arange(len(held)), [len(h) for h in held])
            return as_batch(star_links(fps, group, radius), LINKS)

        for batch in batches:
            for value in batch.column(0):
                fps = value.values.to_numpy(zero_copy_only=False)
                if held and size + len(fps) > LANES:
                    yield out()
                    held, size = [], 0
                held.append(fps)
                size += len(fps)
        if held:
            yield out()

    return lists.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and carried columns, one row per row of ``docs``.

    ``component_id`` is the smallest id that chains of fingerprints within ``radius`` bits reach. A
    null or empty text has the fingerprint zero and is linked like any other; a row with a null id
    gets its component's smallest id (null if there is none); repeated rows stay; other columns are
    not read; an empty table gives no rows. Exact copies share a fingerprint and are compared once.
    """
    prints = settled(fingerprints(docs, shingle_words, doc_id, text, carry))
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct.select("fp"), radius))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(firsts, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *carry)


def one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Rows that share an id count as one document, of which one text stays. A row without an id is
    named by a hash of its text that comes after all ids, so it stays only where no id is in its
    component.
    """
    nameless = F.xxhash64(F.coalesce(docs[text], F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    own, key = spare(docs, "own_id"), spare(docs, "text_key")
    marked = docs.withColumns({own: F.coalesce(docs[doc_id].cast("bigint"), nameless), key: F.xxhash64(docs[text])})
    found = settled(near_duplicates(marked, shingle_words, radius, own, text, (key,)))
    left = without(marked, marked, found.where("component_id != doc_id"), own, key)
    repeated = settled(found.where("component_id = doc_id").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.min(key).alias("first_key")).where("rows > 1"))
    if repeated.isEmpty():
        return left.select(*docs.columns)
    shared = left[own] == repeated["doc_id"]
    single = left.join(repeated, shared, "left_anti").select(*[left[c] for c in docs.columns])
    again = left.join(repeated, shared & (left[key] == repeated["first_key"]), "left_semi")
    return single.unionByName(again.dropDuplicates([own]).select(*[again[c] for c in docs.columns]))
