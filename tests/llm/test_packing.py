import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st

from lakeops.llm import packing

END = 50_256
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(deadline=None)
def test_each_piece_goes_to_the_fullest_row_it_fits(lengths):
    rows = packing.best_fit_decreasing(lengths, 30)
    assert sorted(p for row in rows for p in row) == list(range(len(lengths)))
    free = []
    for n in sorted(lengths, reverse=True):
        fits = sorted(f for f in free if f >= n)
        if fits:
            free.remove(fits[0])
            free.append(fits[0] - n)
        else:
            free.append(30 - n)
    assert sorted(30 - sum(lengths[p] for p in row) for row in rows) == sorted(free)


def packed(df, **options):
    return packing.pack_documents(df, RANKS, public_tokenizers.PATTERN, END, **options)


def test_round_trip(spark, edge_docs):
    encode = packing.load_encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary
    once = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(2)
    rows = packed(once, row_ids=256, block_ids=5_000).collect()
    assert len({(r["part"], r["row_no"]) for r in rows}) == len(rows)
    found = packing.unpack([(r["ids"], r["cu_seqlens"], r["doc_ids"], r["doc_starts"]) for r in rows], END)
    assert found == {r["doc_id"]: encode(r["text"] or "") for r in once.collect()}
    for r in rows:
        positions, cuts = np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(r["ids"]) == 512 and cuts[0] == 0 and cuts[-1] == r["n_ids"] <= 256
        for a, b in zip(cuts, cuts[1:]):
            assert positions[a:b].tolist() == list(range(b - a))


def test_null_ids_repeated_rows_and_no_rows(edge_docs, no_docs):
    owners = [d for r in packed(edge_docs).collect() for d, s in zip(r["doc_ids"], r["doc_starts"]) if s == 0]
    assert sorted(owners, key=str) == sorted((r["doc_id"] for r in edge_docs.collect()), key=str)
    assert packed(no_docs).count() == 0
