import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2

from lakeops.llm import sentencepieces as P

from .conftest import prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "\n", "a\n\nb", " a", "a ", "a  b", "▁x y", "\ta b", "é亜　 x\0y", "</s> <s>", "😀 " * 5, "a\r\nb", "ﬁ ㍿ ｶﾞ  Ａ "]


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.sampled_from(ODD))
@settings(deadline=None, max_examples=300)
def test_same_ids_and_spans_cover_the_text(text):
    encoder = P.Encoder.of(MODEL)
    ids, starts, ends = encoder.encode(text)
    assert ids.tolist() == LIBRARY.encode(text) and encoder.decode(ids) == LIBRARY.decode(LIBRARY.encode(text))
    data = text.encode()
    if data:
        assert starts[0] == 0 and ends[-1] == len(data) and (starts[1:] == ends[:-1]).all()
    for i, a, b in zip(ids.tolist(), starts, ends):
        piece = LIBRARY.id_to_piece(i)
        if not LIBRARY.is_byte(i):
            assert data[a:b].decode().replace(" ", "▁") in (piece, piece[1:])


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.sampled_from(ODD))
@settings(deadline=None, max_examples=300)
def test_compiled_map_against_the_library(text):
    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(library.serialized_model_proto())
        normal, places = P.Normalizer(proto.normalizer_spec).normalize(text)
        expected, offsets = library.Normalize(text, with_offsets=True)
        assert normal == expected
        if text:
            data, at = text.encode(), [len(normal[:i].encode()) for i in range(len(normal) + 1)]
            assert [len(data[:places[i]].decode()) for i in at] == list(offsets)


def test_documents(edge_docs, no_docs):
    full = {(r["doc_id"], tuple(r["ids"])): r for r in P.encode_documents(edge_docs, MODEL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in edge_docs.collect() if r["doc_id"] is not None}
    for (doc, ids), r in full.items():
        if doc is not None:
            assert list(ids) == [*LIBRARY.encode(texts[doc]), LIBRARY.eos_id()] and r["decoded"] == LIBRARY.decode(list(ids))
            assert r["ends"][-1] == len(texts[doc].encode())
    rows = P.encoded_digests(edge_docs, MODEL).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            ids = [*LIBRARY.encode(texts[r["doc_id"]]), LIBRARY.eos_id()]
            shown = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), shown)
            assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert P.encoded_digests(no_docs, MODEL).count() == 0 and P.encode_documents(no_docs, MODEL).count() == 0


def test_long_text():
    text = prose(4, 30_000)
    ids, starts, ends = P.Encoder.of(MODEL).encode(text)
    assert ids.tolist() == LIBRARY.encode(text) and ends[-1] == len(text)
