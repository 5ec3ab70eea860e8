"""SentencePiece encoding that keeps each piece's place in the original text, and decoding.

The text is normalised here: at each place the longest prefix that the model's compiled character
map knows is replaced, and for each byte of the result the place it came from is written down.
The library encodes the normalised text as it is, and its pieces are projected to byte spans of the
original text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_batch, keyed_texts, ship, texts_of

SPACE = "▁"
SPACE_BYTES = SPACE.encode()


class CharacterMap:
    """The model's compiled map: a double-array trie of byte strings and their replacements.

    The layout of a trie unit is fixed by the file format.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of ``data[at:]``."""
        units, found = self.units, None
        if not units:
            return None
        node = self._step(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, length = found
        return self.texts[start:self.texts.index(b"\0", start)], length

    @staticmethod
    def _step(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normalizer:
    """Normalised text, and the original byte position of each of its bytes (and of its end)."""

    def __init__(self, spec, suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.collapse, self.escape = (
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self.suffix = suffix
        self.only_spaces = not self.map.units and self.dummy and self.escape and not self.collapse and not suffix

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        found = self.map.longest(data, at)
        if found is not None:
            return found
        first = data[at]
        length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at:at + length], length

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        data = text.encode()
        if self.only_spaces and data:
            values = np.frombuffer(data, np.uint8)
            places = np.repeat(np.arange(len(data)), np.where(values == 0x20, 3, 1))
            return SPACE + text.replace(" ", SPACE), np.concatenate([[0, 0, 0], places, [len(data)]])
        return self._by_map(data)

    def _by_map(self, data: bytes) -> tuple[str, np.ndarray]:
        at, out, places = 0, bytearray(), []
        space = SPACE_BYTES if self.escape else b" "
        if self.collapse:
            while at < len(data) and (prefix := self._prefix(data, at))[0] == b" ":
                at += prefix[1]
        if at == len(data):
            return "", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            out += space
            places += [at] * len(space)
        after_space = self.collapse
        while at < len(data):
            piece, length = self._prefix(data, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                after_space = piece.endswith(b" ")
                piece = piece.replace(b" ", space)
                out += piece
                places += [at] * len(piece)
            at += length
            after_space = after_space and self.collapse
        if self.collapse:
            while out.endswith(space):
                at = places[len(out) - len(space)]
                del out[-len(space):], places[-len(space):]
        if self.dummy and self.suffix:
            out += space
            places += [at] * len(space)
        return out.decode(), np.array([*places, at], np.int64)


class Encoder:
    """Ids, byte spans and decoding for one model file; kept by each worker."""

    loaded: dict[str, "Encoder"] = {}

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        self.normalizer = Normalizer(proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix)
        proto.normalizer_spec.precompiled_charsmap = b""
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.end, self.unknown = self.model.eos_id(), self.model.unk_id()
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        is_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        self.lengths = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, is_byte, strict=True)], np.int32)
        width = len(str(len(pieces))) + 1
        self.shown = np.array([f"{i} " for i in range(len(pieces))], f"S{width}").view(np.uint8).reshape(-1, width)

    @classmethod
    def of(cls, model_path: str) -> "Encoder":
        if model_path not in cls.loaded:
            cls.loaded[model_path] = cls(model_path)
        return cls.loaded[model_path]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids without the end id, and the start and end byte of each in the original text."""
        normal, places = self.normalizer.normalize(text)
        ids = np.array(self.plain.encode(normal), np.int32)
        lengths = self.lengths[ids]
        if self.unknown >= 0 and (ids == self.unknown).any():
            shown = self.plain.encode(normal, out_type=str)
            lengths = np.array([len(s.encode()) if i == self.unknown else n
                                for i, s, n in zip(ids, shown, lengths, strict=True)], np.int32)
        ends = np.cumsum(lengths)
        if len(ids) and ends[-1] != len(places) - 1:
            raise ValueError("pieces do not cover the normalised text")
        return ids, places[ends - lengths], places[ends]

    def show(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by a space."""
        shown = self.shown[ids].ravel()
        return shown[shown != 0].tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


ENCODED = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int64())), ("decoded", pa.string())])
DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ("spans_crc32", pa.int64()), ("n_bytes", pa.int64())])
BATCH_IDS = 1_000_000


def encode_documents(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (end id last), starts, ends (bytes of the original text, end id at its end), decoded.

    A null text is taken as empty: the end id alone. Null ids stay null, repeated rows stay, other
    columns are not read.
    """
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(model_path)
        for batch in batches:
            rows, size = [], 0
            for key, value in texts_of(batch):
                ids, starts, ends = encoder.encode(value)
                close, ids = len(value.encode()), np.append(ids, encoder.end)
                rows.append((key, ids.tolist(), [*starts.tolist(), close], [*ends.tolist(), close], encoder.decode(ids)))
                size += len(ids)
                if size >= BATCH_IDS:
                    yield as_batch(rows, ENCODED)
                    rows, size = [], 0
            yield as_batch(rows, ENCODED)

    return keyed_texts(docs, doc_id, text).mapInArrow(
        encode, "doc_id bigint, ids array<int>, starts array<bigint>, ends array<bigint>, decoded string")


def encoded_digests(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``encode_documents`` gives, as counts and digests.

    ``spans_crc32`` is over the starts and ends as little-endian 64-bit numbers, ``n_bytes`` the
    end of the last span. Null texts count as empty.
    """
    ship(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(model_path)
        for batch in batches:
            rows = []
            for key, value in texts_of(batch):
                ids, starts, ends = encoder.encode(value)
                all_ids = np.append(ids, encoder.end)
                crc = zlib.crc32(np.asarray(ends, "<i8").tobytes(), zlib.crc32(np.asarray(starts, "<i8").tobytes()))
                rows.append((key, len(all_ids), hashlib.sha256(encoder.show(all_ids)).hexdigest(),
                             hashlib.sha256(encoder.decode(all_ids).encode()).hexdigest(), crc,
                             int(ends[-1]) if len(ends) else 0))
            yield as_batch(rows, DIGESTS)

    return keyed_texts(docs, doc_id, text).mapInArrow(
        digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                 "spans_crc32 bigint, n_bytes bigint")
