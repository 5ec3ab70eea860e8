"""Chat formatting by columnar byte assembly.

A block of turns is formatted as a whole: lengths of headers, contents and ends give cumulative
offsets, offsets give scatter indices, and numpy copies all bytes into one buffer that becomes the
Arrow column. A turn reads ``<s>[INST] role [/INST] text</s>``; these control strings inside a role
or text get a backslash after their first character, one more than they had, so nothing in a text
can be taken for a control string and the text can be read back as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import as_batch, ship

OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST] ", b"</s>"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
TURN = re.compile(re.escape(OPEN) + b"(.*?)" + re.escape(MIDDLE) + b"(.*?)" + re.escape(CLOSE), re.DOTALL)
LEARNED = "assistant"
PART_BYTES = 4_000_000

FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()),
    ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32()))])
DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(column: pa.Array) -> pa.Array:
    column = pc.fill_null(column, "")
    if pc.any(pc.match_substring_regex(column, CONTROL)).as_py():
        column = pc.replace_substring_regex(column, CONTROL, r"\1\\\2\3")
    return column


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of a string column without nulls."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _copy(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies many stretches at once: stretch i of ``source`` goes to ``to[i]``."""
    counting = np.arange(length.sum())
    before = np.cumsum(length) - length
    out[np.repeat(to - before, length) + counting] = source[np.repeat(start - before, length) + counting]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns one after the other, where each begins (and the end), where its text begins and ends."""
    names = pc.fill_null(roles, "").dictionary_encode()
    headers = [OPEN + name.encode() + MIDDLE for name in escape(names.dictionary).to_pylist()]
    header_bytes = np.frombuffer(b"".join(headers), np.uint8)
    header_sizes = np.array([len(h) for h in headers], np.int64)
    header_starts = np.cumsum(header_sizes) - header_sizes
    role = names.indices.to_numpy(zero_copy_only=False)
    offsets, data = _bytes_of(escape(texts))
    heads, contents = header_sizes[role], np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(heads + contents + len(CLOSE))])
    out = np.empty(starts[-1], np.uint8)
    text_starts = starts[:-1] + heads
    _copy(out, starts[:-1], header_bytes, header_starts[role], heads)
    _copy(out, text_starts, data, offsets[:-1], contents)
    text_ends = text_starts + contents
    out[text_ends[:, None] + np.arange(len(CLOSE))] = np.frombuffer(CLOSE, np.uint8)
    return out, starts, text_starts, text_ends


def _formatted(rows: pa.Table, first_part: int) -> pa.RecordBatch:
    """One row per conversation of a sorted block; the first one starts with ``first_part``."""
    rows = rows.combine_chunks()
    column = lambda name: rows[name].chunk(0)
    keys = column("conv_id")
    out, starts, text_starts, text_ends = assemble(column("role"), column("text"))
    first = np.flatnonzero(_opens(keys))
    begins = starts[first]
    offsets = np.append(begins, starts[-1]).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    learned = np.flatnonzero(pc.equal(pc.fill_null(column("role"), ""), LEARNED).to_numpy(zero_copy_only=False))
    owner = np.searchsorted(first, learned, side="right") - 1
    cuts = pa.array(np.searchsorted(learned, np.append(first, rows.num_rows)), pa.int32())
    lists = [pa.ListArray.from_arrays(cuts, pa.array((at[learned] - begins[owner]).astype(np.int32)))
             for at in (text_starts, text_ends)]
    parts = np.zeros(len(first), np.int32)
    parts[0] = first_part
    return pa.RecordBatch.from_arrays([keys.take(pa.array(first)), pa.array(parts), texts, *lists], schema=FORMATTED)


def _opens(keys: pa.Array) -> np.ndarray:
    """Where a key differs from the one before; nulls are alike."""
    values = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
    nulls = keys.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[True], (values[1:] != values[:-1]) | (nulls[1:] != nulls[:-1])])


def format_conversations(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """conv_id, part, formatted, loss_starts, loss_ends: bytes of ``formatted`` that are learned from.

    A conversation is one row with part 0; beyond ``part_bytes`` it goes on in rows that follow each
    other, so that one of any length streams through its task. Turns are ordered by turn, then role
    and text, nulls first. A null role or text counts as empty, null ids are one conversation,
    repeated turns stay, other columns are not read, an empty table gives no rows.
    """
    ship(turns.sparkSession)
    read = turns.select(turns["conv_id"].cast("bigint").alias("conv_id"), turns["turn"], turns["role"], turns["text"])
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, part = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            keys = rows["conv_id"].chunk(0)
            last = int(np.flatnonzero(_opens(keys))[-1])
            first_part = part if keys[0].as_py() == key else 0
            if last:
                yield _formatted(rows.slice(0, last), first_part)
                rows, first_part = rows.slice(last), 0
            held, key, part = rows, keys[last].as_py(), first_part
            if rows.nbytes > part_bytes:
                yield _formatted(rows, first_part)
                held, part = None, first_part + 1
        if held is not None:
            yield _formatted(held, part)

    return ordered.mapInArrow(run, "conv_id bigint, part int, formatted string, loss_starts array<int>, loss_ends array<int>")


def read_back(formatted: bytes) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    return [(unescape(r.decode()), unescape(t.decode())) for r, t in TURN.findall(formatted)]


def read_back_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations, whose parts follow each other.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars and
    loss_sha256 (the texts under the loss mask, unescaped), formatted_chars.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None

        def close() -> None:
            if now is not None:
                key, n, turns, loss_chars, loss, chars = now
                done.append((key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for batch in batches:
            for key, part, text, starts, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part == 0:
                    close()
                    now = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = text.encode()
                for role, said in read_back(data):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends, strict=True):
                    said = unescape(data[a:b].decode())
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
            yield as_batch(done, DIGESTS)
            done = []
        close()
        yield as_batch(done, DIGESTS)

    return formatted.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                     "loss_sha256 string, formatted_chars bigint")
