"""Language by compression: the language whose dictionary makes the text smallest.

Every language has a raw-content zstandard dictionary, made of excerpts of a bounded sample of its
labelled texts. A text is lower-cased, what stands between its letters becomes one space, and it is
cut into windows; each window is compressed once with every dictionary, and the sizes are summed
over all windows of the text, so evidence grows with its length. The smallest sum wins. The margin is what the second best needs more, as a share of
the best; a narrow margin is a rejection. A temperature that fits other labelled texts turns the
differences of the sums into a probability.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import as_batch, ship, texts_of

#: What a model learns from: languages, texts a language for its dictionary and for the temperature, characters a text.
MOST_LANGUAGES = 256
DICTIONARY_TEXTS = 160
CALIBRATION_TEXTS = 40
EXCERPT_CHARS = 800
#: The temperature is fitted to whole excerpts and to their beginnings of so many characters, as long texts alone are all clear.
SHORT_CHARS = 40
LEVEL = 6
#: Windows are short enough for a dictionary's tables to be used in place and not copied.
WINDOW_BYTES = 8192
NARROW = 0.01
UNKNOWN = "und"
HELD_OUT = 2
FOLDS = 4
NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, most frequent language first, and the temperature in bytes."""

    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    temperature: float = 1.0


@lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    made = []
    for content in dictionaries:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def letters_of(text: str) -> bytes:
    """Lower-case letters of the whole text with single spaces between: digits, marks and layout tell no language."""
    return NO_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def sizes_of(model: Model, text: str) -> np.ndarray:
    """Bytes of the whole text under each dictionary, window by window."""
    data = memoryview(letters_of(text))
    compressors = _compressors(model.dictionaries)
    sizes = np.zeros(len(compressors), np.int64)
    for start in range(0, len(data), WINDOW_BYTES):
        window = data[start:start + WINDOW_BYTES]
        sizes += [len(c.compress(window)) for c in compressors]
    return sizes


def classify(model: Model, text: str) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected); equal sizes go to the language with more training texts."""
    if not model.languages or not has_letter(text):
        return UNKNOWN, 0.0, 0.0, True
    sizes = sizes_of(model, text)
    best = int(sizes.argmin())
    score = 1 / float(np.exp(-(sizes - sizes[best]) / model.temperature).sum())
    if len(sizes) == 1:
        return model.languages[0], score, 1.0, False
    margin = (int(np.delete(sizes, best).min()) - int(sizes[best])) / int(sizes[best])
    return model.languages[best], score, margin, margin < NARROW


def fit_temperature(sizes: np.ndarray, truth: np.ndarray) -> float:
    """The temperature under which the true languages' probabilities multiply to the most."""
    if not len(sizes) or sizes.shape[1] < 2:
        return 1.0
    best, least = 1.0, math.inf
    for temperature in np.geomspace(1, 64, 25):
        logits = -(sizes - sizes.min(axis=1, keepdims=True)) / temperature
        loss = float((np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(truth)), truth]).mean())
        if loss < least - 1e-12:
            best, least = float(temperature), loss
    return best


def train(samples: dict[str, list[str]]) -> Model:
    """A model of sampled texts by language, largest language first; of each, the first make the dictionary."""
    samples = {lang: texts for lang, texts in samples.items() if any(map(has_letter, texts))}
    learned = {lang: texts[:max(1, min(DICTIONARY_TEXTS, len(texts) * 4 // 5))] for lang, texts in samples.items()}
    # A match is cheaper the nearer it lies to the dictionary's end, for all languages alike.
    model = Model(tuple(learned), tuple(letters_of("\n".join(texts)) for texts in learned.values()))
    rest = [(n, part) for n, (lang, texts) in enumerate(samples.items()) for t in texts[len(learned[lang]):]
            for part in (t, t[:SHORT_CHARS]) if has_letter(part)]
    sizes = np.array([sizes_of(model, t) for _, t in rest])
    return Model(model.languages, model.dictionaries, fit_temperature(sizes, np.array([n for n, _ in rest], np.int64)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is one the model never sees; false for a null id, from which nothing is learned either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model of the labelled texts with a letter that are not held out.

    Of each language it is the ``DICTIONARY_TEXTS + CALIBRATION_TEXTS`` different texts that hash
    lowest, of each at most ``EXCERPT_CHARS`` characters from a place that a hash chooses; of more
    than ``MOST_LANGUAGES`` languages the most frequent. Only rows with hashes so low that a few
    times as many are expected are grouped, and copies of a text count once.
    """
    wanted = DICTIONARY_TEXTS + CALIBRATION_TEXTS
    rows = docs.where(docs[doc_id].isNotNull() & ~held_out(docs[doc_id]) & docs[lang].isNotNull()
                      & docs[text].rlike(r"\p{L}")).select(
        docs[lang].cast("string").alias("lang"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("h"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(
        F.col("n").desc(), "lang").limit(MOST_LANGUAGES).collect()
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], int(-2 ** 63 + min(1.0, 4 * wanted / max(1, r["n"])) * (2 ** 64 - 2048))) for r in counted],
        "lang string, highest bigint")
    more = F.greatest(F.length("text") - EXCERPT_CHARS, F.lit(0))
    start = (F.pmod(F.xxhash64("h", F.lit("place")), more + 1) + 1).cast("int")
    low = rows.join(F.broadcast(limits), "lang").where("h <= highest").select(
        "lang", "h", F.substring("text", start, F.lit(EXCERPT_CHARS)).alias("text"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = low.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "h", "text", number.alias("n"))
    samples: dict[str, list[str]] = {r["lang"]: [] for r in counted}
    for r in chosen.where(F.col("n") <= wanted).orderBy("lang", "n").collect():
        samples[r["lang"]].append(r["text"])
    return train(samples)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, rejected): a row per document, of its text alone.

    ``rejected`` marks a margin under ``NARROW``, a text that is null or has no letter, and a model
    that learned nothing; of these only the first has a language, the others have ``und`` and score
    0. Texts of any length are read whole. Repeated rows are answered each; empty tables give none.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.dictionaries, model.temperature))
    out = "doc_id bigint, held_out boolean, lang_pred string, score double, margin double, rejected boolean"
    fields = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            found = as_batch([classify(own, value) for _, value in texts_of(batch)], fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *found.columns], names=["doc_id", "held_out", *fields.names])

    read = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"),
                       held_out(docs[doc_id]).alias("held_out"))
    return read.mapInArrow(run, out)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out and answer all of them."""
    return predict(docs, learn(docs, doc_id, text, lang), doc_id, text)
