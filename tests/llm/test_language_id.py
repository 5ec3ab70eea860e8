import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from lakeops.llm import language_id as L
from lakeops.llm.queries import op11_languages

from .conftest import DOCS

WORDS = {"en": "the of and to in is that for it with as was on be at by have from this are".split(),
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
         "ru": "и в не на что с по как это из у за от так о для же но его к".split()}


def text_in(lang, seed, words):
    rng = random.Random(f"{lang} {seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ".", ","]) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, text_in(lang, i, 5 + i % 60), lang, "s", 0) for i in range(300) for lang in [("en", "de", "ru")[i % 3]]]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def model(labelled):
    return L.learn(labelled)


def test_sizes_are_those_of_each_window_compressed_anew(model):
    text = text_in("en", "long", 9000) + "!!" + text_in("de", "long", 900)
    data = L.letters_of(text)
    want = []
    for content in model.dictionaries:
        made = zstandard.ZstdCompressor(
            level=L.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False)
        want.append(sum(len(made.compress(data[i:i + L.WINDOW_BYTES])) for i in range(0, len(data), L.WINDOW_BYTES)))
    got = L.sizes_of(model, text).tolist()
    # A dictionary prepared beforehand may choose other matches; it never changes what is compressed.
    assert all(abs(a - b) <= 0.15 * b for a, b in zip(got, want, strict=True))
    assert got.index(min(got)) == want.index(min(want))


def test_every_window_counts(model):
    """A text whose second half is German and longer is German, wherever the windows lie."""
    text = text_in("en", 1, 3000) + " " + text_in("de", 1, 9000)
    assert L.classify(model, text)[0] == "de"
    assert L.classify(model, text_in("ru", 5, 20_000))[0] == "ru"


def test_held_out_languages_are_told_apart(labelled, model):
    got = L.predict(labelled, model).join(labelled.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 50 and {r["held_out"] for r in got} == {True}
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.98
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_accuracy_on_the_held_out_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null").select("doc_id", "lang")
    got = op11_languages(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.97
    sure = got.where("not rejected")
    assert sure.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.99


def test_nothing_is_learned_from_held_out_rows_or_without_an_id(labelled, model):
    held = L.held_out(F.col("doc_id"))
    swapped = labelled.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn(
        "text", F.when(held, F.lit("qqqq zzzz")).otherwise(F.col("text")))
    extra = swapped.unionByName(labelled.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.lit("yy").alias("lang"), "source", "n_chars"))
    assert L.learn(extra) == model


def test_order_and_partitions_do_not_change_the_model(labelled, model):
    assert L.learn(labelled.repartition(7)) == model
    # Copies of a text count once.
    assert L.learn(labelled.unionByName(labelled.where("doc_id % 4 = 0"))) == model


def test_narrow_margins_are_rejected_and_still_named(model):
    lang, score, margin, rejected = L.classify(model, "zz")
    assert lang == model.languages[0] and margin == 0 and rejected and score < 0.5
    _, score, margin, rejected = L.classify(model, text_in("de", "x", 80))
    assert margin > 0.05 and not rejected and score > 0.99


def test_temperature_spreads_scores(model):
    import numpy as np
    clear, mixed = np.array([[10, 60], [70, 10]] * 20), np.array([[10, 12], [12, 10]] * 20)
    truth = np.array([0, 1] * 20)
    wrong = np.array([0, 1] * 14 + [1, 0] * 6)
    assert L.fit_temperature(clear, truth) == 1.0
    assert L.fit_temperature(mixed, wrong) > 1.5


def test_edge_rows(edge_docs, model):
    got = L.predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for key in (3, 4, 5):
        assert (by_id[key]["lang_pred"], by_id[key]["score"], by_id[key]["rejected"]) == ("und", 0.0, True)
    assert by_id[9]["lang_pred"] in model.languages and by_id[None]["held_out"] is False
    assert by_id[6]["lang_pred"] == by_id[7]["lang_pred"]
    learned = L.learn(edge_docs)
    assert "fr" in learned.languages or "de" in learned.languages or "en" in learned.languages


def test_empty_and_unlabelled_tables(no_docs, labelled):
    assert L.identify(no_docs).collect() == []
    none = labelled.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in L.identify(none).collect()} == {"und"}
    one = labelled.where("lang = 'de'")
    assert {r["lang_pred"] for r in L.identify(one).collect()} == {"de"}
