"""Packing of token ids into rows of a fixed length, best fit decreasing.

Each document becomes its token ids and an end id. A document longer than a row is cut into
pieces, without loss: full pieces fill rows by themselves, the rest is packed. Pieces are packed
in blocks of a bounded number of ids that follow each other in one partition: longest piece
first, each into the fullest open row it fits, found in a segment tree over the free space of rows.
Nothing is shuffled, a task holds one block, and the rows of a block depend on that block alone.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keyed_texts, ship, texts_of

ROW_IDS = 2048
BLOCK_IDS = 4_000_000

SCHEMA = ("part int, row_no int, n_ids int, ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<bigint>, doc_starts array<bigint>")


class FreeSpaceTree:
    """Segment tree over the free places of open rows: inner nodes count the rows below."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, free: int, n: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """An open row with the least free space that is enough, and that space."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not count[2 * node])
        free = node - self.leaves
        self._add(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(lengths: list[int], row_ids: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every length is between 1 and ``row_ids``."""
    rows: list[list[int]] = []
    tree = FreeSpaceTree(row_ids)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[piece]
        found = tree.take(need)
        if found is None:
            found = len(rows), row_ids
            rows.append([])
        row, free = found
        rows[row].append(piece)
        if free > need:
            tree.put(free - need, row)
    return rows


def pieces_of(length: int, row_ids: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces."""
    return [(s, min(row_ids, length - s)) for s in range(0, length, row_ids)]


@cache
def load_encoding(ranks_path: str, pattern: str):
    """The tokenizer of a file of ranks; kept by each worker."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _block(part: int, first_row: int, docs: list[tuple[int | None, np.ndarray]], row_ids: int) -> pa.RecordBatch:
    pieces = [(d, s, n) for d, (_, ids) in enumerate(docs) for s, n in pieces_of(len(ids), row_ids)]
    rows = best_fit_decreasing([n for _, _, n in pieces], row_ids)
    ids = np.zeros((len(rows), row_ids), dtype="<u2")
    positions = np.zeros((len(rows), row_ids), dtype="<u2")
    counting = np.arange(row_ids, dtype="<u2")
    ends, owners, starts, used = [], [], [], []
    for r, row in enumerate(rows):
        at, cuts = 0, [0]
        for p in row:
            d, s, n = pieces[p]
            ids[r, at:at + n] = docs[d][1][s:s + n]
            positions[r, at:at + n] = counting[:n]
            at += n
            cuts.append(at)
        ends.append(cuts)
        used.append(at)
        owners.append([docs[pieces[p][0]][0] for p in row])
        starts.append([pieces[p][1] for p in row])
    return pa.RecordBatch.from_arrays([
        pa.array([part] * len(rows), pa.int32()),
        pa.array(range(first_row, first_row + len(rows)), pa.int32()),
        pa.array(used, pa.int32()),
        pa.array([row.tobytes() for row in ids], pa.binary()),
        pa.array([row.tobytes() for row in positions], pa.binary()),
        pa.array(ends, pa.list_(pa.int32())),
        pa.array(owners, pa.list_(pa.int64())),
        pa.array(starts, pa.list_(pa.int64()))],
        names=["part", "row_no", "n_ids", "ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts"])


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, row_ids: int = ROW_IDS,
                   block_ids: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``row_ids`` little-endian 16-bit ids with what is needed to mask and to undo them.

    ``ids`` and ``position_ids`` are the rows of two matrices, zero after ``n_ids``; positions
    start again at 0 with each piece. ``cu_seqlens`` holds the cumulative piece lengths,
    ``doc_ids`` and ``doc_starts`` the document of each piece and the piece's place in it.
    ``part`` and ``row_no`` name a row.

    A null or empty text gives the end id alone, a null id stays null, repeated documents are
    packed once per row, other columns are not read, an empty table gives no rows.
    """
    if row_ids > 65_535:
        raise ValueError("positions are written in 16 bits")
    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = load_encoding(ranks_path, pattern).encode_ordinary
        part, row, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for key, value in texts_of(batch):
                ids = np.array([*encode(value), end_id], dtype="<u2")
                held.append((key, ids))
                size += len(ids)
                if size >= block_ids:
                    out = _block(part, row, held, row_ids)
                    row, held, size = row + out.num_rows, [], 0
                    yield out
        if held:
            yield _block(part, row, held, row_ids)

    return keyed_texts(docs, doc_id, text).mapInArrow(pack, SCHEMA)


def unpack(rows: Iterator[tuple], end_id: int) -> dict[int, list[int]]:
    """The ids of each document, put together again from packed rows (for checks on small data)."""
    pieces: dict[int, list[tuple[int, list[int]]]] = {}
    for ids, cuts, owners, starts in rows:
        ids = np.frombuffer(ids, dtype="<u2")
        for k, owner in enumerate(owners):
            pieces.setdefault(owner, []).append((starts[k], ids[cuts[k]:cuts[k + 1]].tolist()))
    joined = {d: [i for _, piece in sorted(p) for i in piece] for d, p in pieces.items()}
    assert all(ids[-1] == end_id for ids in joined.values())
    return {d: ids[:-1] for d, ids in joined.items()}
