"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones.

The documents are read once into an index of the items' terms, a row per document, which is written
to the shared folder and gives the statistics that all weights need. Each task then takes its rows
of the index in blocks, turns a block into posting lists, and answers every item on it:

* Term at a time: the item's shortest lists, as many as hold together a quarter as many postings as
  the block has documents, are summed into accumulators. The k-th best accumulator is already a
  threshold, as a document's other terms can only add to it.
* Document at a time: the accumulators are from then on one more list, with its largest sum in each
  range of documents as a bound. Ranges in order of documents: one whose bounds, of accumulators
  and long lists together, stay under the threshold is skipped unread; in others the lists are
  added from the greatest bound down, until no document can reach the threshold with what is left.

The best k of an item pass from block to block, so the threshold of a task only rises. Scores are
whole numbers, so bounds and ties are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, spare, written

TOP = 20
#: Documents and postings of a block, documents of a range, and the share of a block's documents the accumulators take.
BLOCK_DOCS = 65_536
BLOCK_POSTINGS = 8_000_000
RANGE_DOCS = 256
ACCUMULATED = 0.25
#: Characters of items that are searched for at a time, and bytes of a text that are split at a time.
SHARD_CHARS = 16_000_000
PIECE_BYTES = 1 << 20
#: Results of so many tasks meet first, so that no item's results of all tasks meet in one.
SALTS = 64
#: ASCII digits and letters and every other character make terms; only A-Z are lower-cased.
LETTERS = bytes(32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, about ``PIECE_BYTES`` of it at a time."""
    start = 0
    while start < len(text):
        piece = text[start:start + PIECE_BYTES].translate(LETTERS)
        if start + PIECE_BYTES < len(text):
            cut = piece.rfind(b" ")
            if cut < 0:  # one term is longer than a piece: go on to its end
                end = next((i for i in range(start + PIECE_BYTES, len(text)) if LETTERS[text[i]] == 32), len(text))
                piece = text[start:end].translate(LETTERS)
            else:
                piece = piece[:cut + 1]
        start += len(piece)
        yield piece.split()


def terms_of(text: str) -> list[bytes]:
    return [t for piece in pieces_of(text.encode()) for t in piece]


def count_terms(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of all terms, the numbers of those in the vocabulary, how often each occurs)."""
    n, found = 0, []
    for words in pieces_of(text):
        n += len(words)
        ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))
        found.append(np.unique(ids[ids >= 0], return_counts=True))
    if not found:
        return 0, np.zeros(0, np.int32), np.zeros(0, np.int64)
    if len(found) == 1:
        return n, *found[0]
    ids, at = np.unique(np.concatenate([i for i, _ in found]), return_inverse=True)
    return n, ids, np.bincount(at, np.concatenate([c for _, c in found]), len(ids)).astype(np.int64)


@dataclass
class Block:
    """Posting lists of some documents, which stand in order of their ids (unknown ones last)."""

    ids: np.ndarray
    unknown: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    factors: np.ndarray
    ranges: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @cached_property
    def bounds(self) -> np.ndarray:
        return np.arange(0, len(self.ids) + RANGE_DOCS, RANGE_DOCS)

    def ranges_of(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each range of documents begins in a list, and the list's greatest factor in it."""
        if at not in self.ranges:
            docs, factors = self.list_of(at)
            cuts = np.searchsorted(docs, self.bounds)
            filled = np.flatnonzero(np.diff(cuts))
            greatest = np.zeros(len(cuts) - 1, np.int64)
            greatest[filled] = np.maximum.reduceat(factors, cuts[filled])
            self.ranges[at] = cuts, greatest
        return self.ranges[at]

    def list_of(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[at], self.starts[at + 1])
        return self.docs[part], self.factors[part]


def make_block(ids: np.ndarray, unknown: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray,
               counts: np.ndarray, n_docs: int, n_terms: int) -> Block:
    """Lists of the rows of the index: ``sizes`` postings a document, ``lengths`` terms in all."""
    order = np.lexsort((ids, unknown))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    docs = np.repeat(place, sizes)
    m = 75 + (25 * lengths.astype(np.int64) * n_docs) // n_terms
    counts = counts.astype(np.int64)
    factors = (1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(m, sizes))
    by = np.argsort(terms.astype(np.int64) * len(ids) + docs)
    there, starts = np.unique(terms[by], return_index=True)
    return Block(ids[order], unknown[order], there, np.append(starts, len(by)), docs[by], factors[by])


@dataclass
class Best:
    """The best documents of an item so far: scores falling, ids rising among equals, unknown ids last."""

    scores: np.ndarray
    unknown: np.ndarray
    ids: np.ndarray

    def add(self, top: int, scores: np.ndarray, unknown: np.ndarray, ids: np.ndarray) -> None:
        scores, unknown, ids = (np.concatenate(p) for p in (
            (self.scores, scores), (self.unknown, unknown), (self.ids, ids)))
        order = np.lexsort((ids, unknown, -scores))[:top]
        self.scores, self.unknown, self.ids = scores[order], unknown[order], ids[order]

    def threshold(self, top: int) -> int:
        return int(self.scores[top - 1]) if len(self.scores) >= top else 1


def nothing() -> Best:
    return Best(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))


def search_block(block: Block, item: list[tuple[int, int]], best: Best, top: int) -> int:
    """Bring the best documents of an item, (term, weight) pairs, up to date; the number of ranges opened."""
    lists = []
    for term, weight in item:
        at = int(np.searchsorted(block.terms, term))
        if weight > 0 and at < len(block.terms) and block.terms[at] == term:
            lists.append((int(block.starts[at + 1] - block.starts[at]), at, weight))
    lists.sort()
    n, room, short = len(block.ids), ACCUMULATED * len(block.ids), 0
    while short < len(lists) and lists[short][0] <= room:
        room -= lists[short][0]
        short += 1

    sums = np.zeros(-(-n // RANGE_DOCS) * RANGE_DOCS, np.int64)
    for _, at, weight in lists[:short]:
        docs, factors = block.list_of(at)
        sums[docs] += weight * factors
    threshold = best.threshold(top)
    if short and n >= top:
        threshold = max(threshold, int(np.partition(sums, len(sums) - top)[len(sums) - top]))

    bounds = sums.reshape(-1, RANGE_DOCS).max(axis=1)
    long = [(weight, *block.list_of(at), *block.ranges_of(at)) for _, at, weight in lists[short:]]
    for weight, _, _, _, greatest in long:
        bounds = bounds + weight * greatest
    opened = 0
    for r in np.flatnonzero(bounds >= threshold).tolist():
        if bounds[r] < threshold:
            continue
        opened += 1
        low = r * RANGE_DOCS
        scores = sums[low:low + RANGE_DOCS]  # the accumulators of the range go on as its scores
        here = sorted((-weight * int(greatest[r]), i) for i, (weight, _, _, _, greatest) in enumerate(long) if greatest[r])
        left, reached = -sum(b for b, _ in here), int(scores.max())
        for bound, i in here:
            if reached + left < threshold:
                break
            weight, docs, factors, cuts, _ = long[i]
            part = slice(cuts[r], cuts[r + 1])
            scores[docs[part] - low] += weight * factors[part]
            left += bound
            reached = int(scores.max())
        else:
            good = np.flatnonzero(scores >= threshold)
            if len(good):
                best.add(top, scores[good], block.unknown[low + good], block.ids[low + good])
                threshold = max(threshold, best.threshold(top))
    return opened


def blocks_of(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int) -> Iterator[Block]:
    """Blocks of index rows (doc_id, n, terms, counts), a batch cut where it holds too many postings."""
    held: list[tuple[np.ndarray, ...]] = []
    docs = postings = 0
    for batch in batches:
        start = 0
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        while start < batch.num_rows:
            room = max(1, int(np.searchsorted(np.cumsum(sizes[start:]), BLOCK_POSTINGS - postings, "right")))
            stop = min(batch.num_rows, start + min(room, BLOCK_DOCS - docs))
            part = batch.slice(start, stop - start)
            key = part.column(0)
            held.append((key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), part.column(1).to_numpy(),
                         sizes[start:stop], part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()))
            docs, postings, start = docs + stop - start, postings + int(sizes[start:stop].sum()), stop
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield make_block(*(np.concatenate(p) for p in zip(*held, strict=True)), n_docs, n_terms)
                held, docs, postings = [], 0, 0
    if held:
        yield make_block(*(np.concatenate(p) for p in zip(*held, strict=True)), n_docs, n_terms)


def index(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term: its known terms and how often each occurs."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, lengths, terms, counts = [], [], [], []
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                n, ids, often = count_terms(value.as_py() or b"", shared.value)
                if n:
                    at.append(i)
                    lengths.append(n)
                    terms.append(ids)
                    counts.append(often)
            starts = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            joined = [np.concatenate([np.zeros(0, kind), *part]) for part, kind in ((terms, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at, pa.int32())), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(starts, pa.array(joined[0], pa.int32())),
                pa.ListArray.from_arrays(starts, pa.array(joined[1], pa.int64()))], schema=schema)

    read = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    return read.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def weight_of(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def _shards(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    held, chars = [], 0
    for item_id, text in items.toLocalIterator():
        if held and chars + len(text) > SHARD_CHARS:
            yield held
            held, chars = [], 0
        held.append((item_id, text))
        chars += len(text)
    if held:
        yield held


RESULT = "item int, item_id bigint, doc_id bigint, score bigint"


def _searched(docs: DataFrame, items: list[tuple[int | None, str]], top: int, doc_id: str, text: str) -> DataFrame:
    """The ``top`` best documents of each item of one shard, each known by its number in the shard."""
    spark = docs.sparkSession
    counted = [Counter(terms_of(t)) for _, t in items]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counted)))}
    rows = written(index(docs, vocabulary, doc_id, text), "term_index")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One number for each term of the shard's items.
    frequency = dict(rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weighted = [[(t, often * weight_of(n_docs, frequency[t])) for term, often in sorted(c.items())
                 if (t := vocabulary[term]) in frequency] for c in counted]
    shared = spark.sparkContext.broadcast(([i for i, _ in items], weighted))
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists = shared.value
        best = [nothing() for _ in lists]
        for block in blocks_of(batches, n_docs, n_terms):
            for item, found in zip(lists, best, strict=True):
                search_block(block, item, found, top)
        for number, (item_id, found) in enumerate(zip(ids, best, strict=True)):
            size = len(found.ids)
            if size:
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * size, pa.int32()), pa.array([item_id] * size, pa.int64()),
                    pa.array(found.ids, pa.int64(), mask=found.unknown), pa.array(found.scores, pa.int64())], schema=schema)

    found = rows.mapInArrow(run, RESULT)
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = F.row_number().over(Window.partitionBy("item", "part").orderBy(*by))
    some = found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS))).select("*", first.alias("rank"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*by))
    return some.where(F.col("rank") <= top).withColumn("rank", rank).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents with a score above 0 for each item.

    Equal scores go by rising doc_id, those without one last. Null, empty and termless texts, of
    documents or items, match nothing and do not count as documents. Each row is a document and an
    item of its own: repeated documents take a rank each, repeated items are answered each. Items of
    more than ``SHARD_CHARS`` characters together are searched for in several passes, one after
    the other, each of which reads the documents once. Empty tables give no rows.
    """
    own = items.select(items[item_id].cast("bigint").alias("item_id"), items[item_text].alias("text"))
    key = spare(own, "length")
    own = own.where(F.length("text") > 0).withColumn(key, F.length("text")).orderBy("item_id", key, "text").drop(key)
    out, earlier = docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint"), None
    for shard in _shards(own):
        if earlier is not None:
            out = out.unionByName(written(earlier, "ranked"))
        earlier = _searched(docs, shard, top, doc_id, text)
    return out if earlier is None else out.unionByName(earlier)
