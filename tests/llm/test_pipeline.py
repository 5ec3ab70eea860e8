import hashlib

import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from lakeops.llm import decontamination, quality_rules, secret_scan
from lakeops.llm.queries import PIECE_MODEL, QUERIES

from .test_quality_rules import base_of, judged
from .test_secret_scan import plain
from .test_simhash import closed, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "sentencepiece_encoding"]


def test_stages_against_plain_python(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs = sorted(read("documents").collect(), key=lambda r: r["doc_id"])
    columns = read("documents").columns
    limit = quality_rules.chi2_quantile(1 - quality_rules.TAIL, 4)
    good = [r for r, d in zip(docs, judged(docs)) if not base_of(r["text"])[0][5] and (d is None or d <= limit)]

    roots = closed([plain_fingerprint(r["text"]) for r in good], 3)
    single = [r for i, r in enumerate(good) if roots[i] == i]

    items = [b" ".join(decontamination.words_of(r["text"])) for r in read("benchmark").collect()]
    clean = [r for r in single if not any(i in b" ".join(decontamination.words_of(r["text"])) for i in items)]
    assert len(docs) > len(good) > len(single) > len(clean) > 50

    out = read("documents")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, (good, single, clean)):
        out = stage(spark, out, FOLDER)
        assert out.columns == columns, name
        assert sorted(r["doc_id"] for r in out.collect()) == [r["doc_id"] for r in expected], name
        out = spark.createDataFrame(expected, read("documents").schema)

    field = secret_scan.train(secret_scan.training_texts(out))
    redacted = {}
    for r in clean:
        words = secret_scan.TOKEN.findall(r["text"])
        tags = field.viterbi(field.scores(secret_scan.trait_array(words), secret_scan.file_class(r["text"])))
        base = plain(r["text"])
        assert [s for s in secret_scan.all_spans(field, r["text"]) if s[0] != "crf"] == base
        assert any(tags) or secret_scan.all_spans(field, r["text"]) == base
        redacted[r["doc_id"]] = secret_scan.cover(r["text"], secret_scan.all_spans(field, r["text"]), "[SECRET]")
    out = corpus_pipeline.STAGES[3][1](spark, out, FOLDER)
    assert out.columns == columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {i: (t, len(t)) for i, t in redacted.items()}

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    expected = {}
    for doc, text in redacted.items():
        ids = [*library.encode(text), library.eos_id()]
        expected[doc] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == expected


def test_stages_take_empty_and_odd_documents(spark, edge_docs, no_docs):
    for docs in (no_docs, edge_docs):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, FOLDER)
            kept = out.count()
            assert kept <= docs.count() and (kept == 0 or docs is edge_docs), name
