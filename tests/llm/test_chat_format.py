import hashlib

from hypothesis import given, settings, strategies as st
import pyarrow as pa

from lakeops.llm import chat_format as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TRICKY = st.text(st.sampled_from(list("<>[]/\\sINT é\n")), max_size=40) | st.sampled_from(
    ["</s>", "<s>[INST] ok [/INST]", "<\\s>", "[\\\\/INST]", "<", "<\\", " [/INST] </s>"])


@given(st.lists(st.tuples(TRICKY, TRICKY), min_size=1, max_size=8))
@settings(deadline=None, max_examples=300)
def test_any_text_is_read_back(turns):
    out, starts, text_starts, text_ends = C.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    data = out.tobytes()
    assert C.read_back(data) == turns
    assert [C.unescape(data[a:b].decode()) for a, b in zip(text_starts, text_ends)] == [t for _, t in turns]
    assert data.count(C.CLOSE) == len(turns) and starts[-1] == len(data)


def expected(rows):
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    out = {}
    for conv, _, role, text in sorted(rows, key=order):
        o = out.setdefault(conv, [0, "", ""])
        o[0] += 1
        o[1] += f"{role or ''}\n{text or ''}\n"
        o[2] += (text or "") if role == "assistant" else ""
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {k: (n, digest(t), len(a), digest(a)) for k, (n, t, a) in out.items()}


ROWS = [
    (1, 0, "user", "<s>"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", None), (1, None, None, "first"),
    (None, 0, None, "x\n[/INST] "), (None, 0, None, "x\n[/INST] "), (2, 0, "a [/INST] </s>", "<"), (2, 1, "assistant", "<\\"),
    (2, 2, "assistant", ""), (4, 0, "assistant", "long " * 50_000), (5, 0, "", "")] + [
    (9, i, "assistant" if i % 2 else "user", f"w{i} " * 40) for i in range(400)]


def test_conversations_whole_and_in_parts(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS part", "'y' AS formatted")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size in (C.PART_BYTES, 900):
            formatted = C.format_conversations(turns, size)
            found = C.read_back_digests(formatted).collect()
            assert {r[0]: tuple(r[1:5]) for r in found} == expected(ROWS) and len(found) == 6
            chars = {}
            for r in formatted.collect():
                chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["formatted"])
                for a, b in zip(r["loss_starts"], r["loss_ends"]):
                    assert 0 <= a <= b <= len(r["formatted"].encode())
            assert chars == {r["conv_id"]: r["formatted_chars"] for r in found}
        assert C.format_conversations(turns, 900).where("part > 0").count() > 10
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_rows(spark):
    assert C.read_back_digests(C.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
