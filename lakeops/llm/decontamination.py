"""Benchmark decontamination by a BM25 inverted index of the test items, searched block by block.

The index holds the items' words with their BM25 impact, each item's impacts scaled so that the
whole item scores 1. Items stand in blocks, and every word knows its largest impact in each block.
Every passage of every document is a query, with a fixed threshold: retrieve all items above it.

* A passage's bound for each block is the sum of its words' block maxima, summed for all passages
  of a document at once; a block whose bound is below the threshold is never opened.
* An opened block is searched as block-max WAND: posting cursors sorted by item, the pivot is where
  the summed maxima reach the threshold, items before it are skipped.
* A retrieved item counts as leaked if both its question and its answer are found in the document:
  the shares of their word runs that stand in the document's words reach ``overlap``.
"""

from __future__ import annotations

import math
import pickle
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_batch, keyed_texts, settled, ship, spare, texts_of, without

K1 = 1.2
B = 0.75
BLOCKS = 32
#: Characters of items in one piece of the index, the most that a task holds or a broadcast carries.
PIECE_CHARS = 8_000_000
THRESHOLD = 0.5
OVERLAP = 0.6
RUN_WORDS = 3
ANSWER_WORDS = 5
WINDOWS = 4096
#: Every byte that is no ASCII letter or digit and no part of a longer character separates words.
SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case words of letters and digits; punctuation, symbols and layout do not count."""
    return text.lower().encode().translate(SEPARATORS).split()


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer: the answer is the last line or, in one line, the last sentence, of
    ``ANSWER_WORDS`` words or more; an item that has no such end is all question."""
    for cut in (r"\n+", r"(?<=[.?!])\s+"):
        parts = [p for p in re.split(cut, text.strip()) if words_of(p)]
        for at in range(len(parts) - 1, 0, -1):
            answer = words_of(" ".join(parts[at:]))
            question = words_of(" ".join(parts[:at]))
            if len(answer) >= ANSWER_WORDS and len(question) >= ANSWER_WORDS:
                return question, answer
    return words_of(text), []


def word_runs(words: list[bytes], length: int = RUN_WORDS) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i:i + length]) for i in range(max(1, len(words) - length + 1))]


@dataclass(frozen=True)
class Totals:
    """What scores need to know of all items, whichever piece of the index they are in."""

    items: int
    mean: float
    longest: int


@dataclass
class Index:
    """Postings of one piece of the items, with impact maxima per word and block."""

    items: list[int]
    texts: list[str]
    terms: dict[bytes, int]
    postings: list[tuple[array, array]]
    maxima: np.ndarray
    block_items: int
    longest: int


Counted = tuple[int, str, list[tuple[bytes, int, int]]]


def build_index(items: list[Counted], totals: Totals) -> Index:
    """BM25 impacts with the usual idf; a query word counts once.

    An item is its id, its text and (word, times in it, items that hold the word); frequencies and
    ``totals`` are those of all items, so an item's impacts do not depend on the piece it is in.
    """
    lists: dict[bytes, list[tuple[int, float]]] = {}
    items = sorted(items)
    for n, (_, _, words) in enumerate(items):
        length = sum(tf for _, tf, _ in words)
        impact = {}
        for term, tf, frequency in words:
            idf = math.log(1 + (totals.items - frequency + 0.5) / (frequency + 0.5))
            impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / totals.mean))
        total = math.fsum(impact.values())
        for term, value in impact.items():
            lists.setdefault(term, []).append((n, value / total))
    terms = {term: t for t, term in enumerate(sorted(lists))}
    block_items = max(1, -(-len(items) // BLOCKS))
    maxima = np.zeros((len(terms) + 1, max(1, -(-len(items) // block_items))), np.float32)
    postings = []
    for term, t in terms.items():
        at = array("i", [n for n, _ in lists[term]])
        impacts = array("d", [v for _, v in lists.pop(term)])
        postings.append((at, impacts))
        # Rounded up, so that sums in single precision stay bounds.
        np.maximum.at(maxima[t], np.array(at) // block_items, (np.array(impacts) * 1.0001 + 1e-7).astype(np.float32))
    return Index([i for i, _, _ in items], [t for _, t, _ in items], terms, postings, maxima, block_items, totals.longest)


def search_block(index: Index, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
    """Items of one block that score at least ``threshold`` for a passage's distinct words."""
    low, high = block * index.block_items, (block + 1) * index.block_items
    cursors = []
    for t in terms:
        bound = float(index.maxima[t, block])
        if bound > 0:
            at, impacts = index.postings[t]
            i = bisect_left(at, low)
            cursors.append([at[i], bound, i, at, impacts])
    found = []
    while cursors:
        cursors.sort(key=itemgetter(0))
        bound, pivot = 0.0, None
        for c in cursors:
            bound += c[1]
            if bound >= threshold:
                pivot = c[0]
                break
        if pivot is None:
            break
        # All cursors at the pivot: score it and pass it. Else those before it skip to it.
        whole = cursors[0][0] == pivot
        goal, parts = pivot + whole, []
        for c in cursors:
            if c[0] >= goal:
                break
            if whole:
                parts.append(c[4][c[2]])
            c[2] = bisect_left(c[3], goal, c[2])
            c[0] = c[3][c[2]] if c[2] < len(c[3]) else high
        # Rounded once, so that the order of the cursors does not show.
        score = math.fsum(parts)
        if whole and score >= threshold:
            found.append((pivot, score))
        cursors = [c for c in cursors if c[0] < high]
    return found


def search_document(index: Index, ids: np.ndarray, threshold: float) -> dict[int, float]:
    """The best score of each item that any passage of the document retrieves.

    A passage is ``2 * longest`` words, the next one starts ``longest`` words on, so each stretch
    as long as an item lies whole in one of them. ``ids`` has the number of index words for others.
    """
    known, step = len(index.postings), max(1, index.longest)
    passages = max(1, -(-len(ids) // step) - 1)
    best: dict[int, float] = {}
    for first in range(0, passages, WINDOWS):
        last = min(passages, first + WINDOWS)
        places = np.flatnonzero(ids[first * step:(last + 1) * step] < known) + first * step
        terms, step_no = ids[places].astype(np.int64), places // step
        own, before = step_no < last, step_no > first
        # Each word of a passage once, sorted by passage.
        pairs = np.unique(np.concatenate([
            step_no[own] * known + terms[own], (step_no[before] - 1) * known + terms[before]]))
        if not len(pairs):
            continue
        passage, terms = pairs // known, pairs % known
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        stops = np.append(starts[1:], len(pairs))
        bounds = np.add.reduceat(index.maxima[terms], starts, axis=0)
        for w, block in zip(*np.nonzero(bounds >= threshold), strict=True):
            for item, score in search_block(index, terms[starts[w]:stops[w]].tolist(), int(block), threshold):
                best[item] = max(score, best.get(item, 0.0))
    return best


def found_share(parts: list[bytes], there: set[bytes]) -> float:
    return sum(p in there for p in parts) / len(parts)


def leaks_in(index: Index, text: str, threshold: float, overlap: float) -> list[tuple[int, float, float, float | None]]:
    """(item, score, question share, answer share) of each leaked item."""
    words = words_of(text)
    get, none = index.terms.get, len(index.postings)
    ids = np.fromiter(map(get, words, repeat(none)), np.int32, len(words))
    best = search_document(index, ids, threshold)
    if not best:
        return []
    there: dict[int, set[bytes]] = {}

    def share(part: list[bytes]) -> float:
        length = min(RUN_WORDS, len(part))
        if length not in there:
            there[length] = set(word_runs(words, length)) if len(words) >= length else set()
        return found_share(word_runs(part, length), there[length])

    leaked = []
    for item, score in sorted(best.items()):
        asked, answered = split_item(index.texts[item])
        question = share(asked)
        answer = share(answered) if answered else None
        if question >= overlap and (answer is None or answer >= overlap):
            leaked.append((index.items[item], score, question, answer))
    return leaked


LEAKS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
    ("question_share", pa.float64()), ("answer_share", pa.float64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items that have a word, with their words and how often each stands there."""
    kept = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()),
                      ("counts", pa.list_(pa.struct([("term", pa.binary()), ("tf", pa.int64())])))])
    for batch in batches:
        rows = []
        for key, value in texts_of(batch):
            counts = Counter(words_of(value))
            if counts:
                rows.append((key, value, sum(counts.values()), [{"term": t, "tf": n} for t, n in sorted(counts.items())]))
        yield as_batch(rows, kept)


def index_pieces(benchmark: DataFrame, piece_chars: int = PIECE_CHARS) -> Iterator[Index]:
    """The index of all items in pieces of about ``piece_chars`` characters, one after the other.

    Words are counted, frequencies summed and pieces built by tasks; the driver holds one piece at
    a time. Rows of equal id and text are one item; null ids and texts and texts without a word
    are none.
    """
    items = benchmark.select(benchmark["item_id"].cast("bigint").alias("item_id"), benchmark["text"].alias("text")).where(
        "text is not null and item_id is not null").distinct()
    counted = settled(items.mapInArrow(
        _counted, "item_id bigint, text string, n_words bigint, counts array<struct<term binary, tf bigint>>").withColumn(
        "row", F.monotonically_increasing_id()))
    seen = counted.agg(F.count("*").alias("items"), F.avg("n_words").alias("mean"), F.max("n_words").alias("longest"),
                       F.sum(F.length("text")).alias("chars")).first()
    if not seen["items"]:
        return
    totals = Totals(seen["items"], seen["mean"], seen["longest"])
    words = counted.select("row", F.inline("counts"))
    frequencies = words.groupBy("term").agg(F.count("*").alias("frequency"))
    known = words.join(frequencies, "term").groupBy("row").agg(
        F.collect_list(F.struct("term", "tf", "frequency")).alias("words"))
    pieces = -(-seen["chars"] // piece_chars)
    rows = counted.select("row", "item_id", "text").join(known, "row").select(
        F.pmod(F.xxhash64("item_id", "text"), F.lit(pieces)).cast("int").alias("piece"), "item_id", "text",
        "words.term", "words.tf", "words.frequency")

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        found = [(i, t, list(zip(map(bytes, terms), tf.tolist(), frequency.tolist(), strict=True)))
                 for i, t, terms, tf, frequency in frame[["item_id", "text", "term", "tf", "frequency"]].itertuples(index=False)]
        return pd.DataFrame({"piece": [pickle.dumps(build_index(found, totals))]})

    for row in rows.groupBy("piece").applyInPandas(build, "piece binary").toLocalIterator():
        yield pickle.loads(row["piece"])


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
          piece_chars: int = PIECE_CHARS, doc_id: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share): test items found in documents.

    ``score`` is the share of the item's own BM25 score that the best passage reaches,
    ``answer_share`` is null for an item without an answer. Word frequencies, the mean length and
    the length of passages are those of the whole benchmark, so the rows are the same for any
    ``piece_chars``. Documents are read once for each piece of so many characters of items. Null
    and empty texts on either side match nothing; documents with a null id are reported with it;
    repeated documents once per row, repeated items once; empty tables give no rows.
    """
    ship(docs.sparkSession)
    read = keyed_texts(docs, doc_id, text) if not carry else docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), *carry)
    found = [_searched(read, index, threshold, overlap, carry) for index in index_pieces(benchmark, piece_chars)]
    return reduce(DataFrame.unionByName, found) if found else read.sparkSession.createDataFrame([], _schema(read, carry))


def _schema(read: DataFrame, carry: tuple[str, ...]) -> str:
    kinds = dict(read.dtypes)
    return ", ".join(["doc_id bigint, item_id bigint, score double, question_share double, answer_share double",
                      *[f"`{c}` {kinds[c]}" for c in carry]])


def _searched(read: DataFrame, index: Index, threshold: float, overlap: float, carry: tuple[str, ...]) -> DataFrame:
    shared = read.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows, at = [], []
            for n, (key, value) in enumerate(texts_of(batch)):
                for leak in leaks_in(index, value, threshold, overlap):
                    rows.append((key, *leak))
                    at.append(n)
            found = as_batch(rows, LEAKS)
            kept = [c.take(pa.array(at, pa.int32())) for c in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*found.columns, *kept], names=[*LEAKS.names, *carry])

    return read.mapInArrow(run, _schema(read, carry))


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no test item is found, told apart by id and text."""
    key = spare(docs, "text_key")
    marked = docs.withColumn(key, F.xxhash64(docs[text]))
    found = leaks(marked, benchmark, doc_id=doc_id, text=text, carry=(key,), **options)
    return without(docs, marked, found, doc_id, key)
