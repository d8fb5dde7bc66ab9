"""Language identification by inferring each document's mixture of languages.

Every letter of a lower-cased word gives one trigram (its neighbours and itself, with a mark beyond the
word's borders), hashed to ``BUCKETS``. A language is a smoothed multinomial over these buckets. A text
is cut into units of a few words; each unit was written in one language, and expectation-maximisation
finds the proportions of the languages that make the whole text most likely. Starting from all
languages, the rarest one is taken out as long as the penalised likelihood rises, so the language set is
selected as well. The prediction is the largest proportion of the selected set.

The models are learnt from at most ``DOCS_PER_LANGUAGE`` labelled documents of a language (those with
the smallest hash of id and text, repeated rows once), whole texts; everything else covers all documents.

Defined results: null texts and texts without letters are ``und`` with score 0, as is every text when
nothing was learnt. Equal proportions go to the language first in code point order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm import blocks as bl

DOCS_PER_LANGUAGE = 500
BUCKETS = 1 << 16
UNIT_WORDS = 4
SMOOTHING = 0.2
ROUNDS = 12
# nats that a further language must gain, besides half the logarithm of the number of units
SET_PENALTY = 4.0
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]
    log_p: np.ndarray  # (languages, BUCKETS), float32


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each letter's trigram; start of each word among the letters; words and letters before
    each text (one entry more than texts)."""
    codes, offsets = bl.code_points([text.lower() for text in texts])
    is_letter = bl.letters()[codes]
    starts, ends = bl.runs(is_letter, offsets)
    at = np.flatnonzero(is_letter)
    letter = codes[at].astype(np.uint64)
    sizes = ends - starts
    begins = np.cumsum(sizes) - sizes
    before, after = np.zeros_like(letter), np.zeros_like(letter)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    before[begins], after[begins + sizes - 1] = 0, 0
    bucket = bl.mix((before << np.uint64(42)) | (letter << np.uint64(21)) | after) & np.uint64(BUCKETS - 1)
    return bucket.astype(np.int64), begins, np.searchsorted(starts, offsets), np.searchsorted(at, offsets)


def train(docs: DataFrame, label: str = "lang", per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Learn one model per value of ``label`` from rows of (doc_id, text, label)."""
    spark = docs.sparkSession
    known = docs.filter(F.col(label).isNotNull()).select("doc_id", "text", F.col(label).alias("name"))
    known = known.withColumn("place", F.xxhash64("doc_id", "text"))
    # about twice as many as are wanted pass by their hash, so that a language's window sees few rows
    sizes = known.groupBy("name").agg(F.approx_count_distinct("place").alias("docs"))
    # one row per language
    early = known.select("name", "place").join(F.broadcast(sizes), "name")
    early = early.filter(F.pmod("place", F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("docs") <= 2 * per_language).drop("docs")
    order = Window.partitionBy("name").orderBy(F.pmod("place", F.lit(1 << 30)), "place")
    first = early.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    # at most per_language rows per language
    chosen = known.join(F.broadcast(first.select("name", "place")), ["name", "place"])
    chosen = chosen.groupBy("name", "place").agg(F.first("text").alias("text")).select("name", "text")

    @bl.give_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, texts in bl.text_blocks(batch.column(1)):
                bucket, _, _, letters = trigrams(texts)
                of = np.repeat(np.array(names[start : start + len(texts)], object), np.diff(letters))
                for name in sorted(set(names[start : start + len(texts)])):
                    n = np.bincount(bucket[of == name], minlength=BUCKETS)
                    seen = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(n[seen])], ["name", "bucket", "n"]
                    )

    counted = chosen.mapInArrow(count, "name string, bucket bigint, n bigint").groupBy("name", "bucket").agg(F.sum("n").alias("n"))
    # at most languages x BUCKETS rows
    rows = counted.toArrow()
    names, buckets, n = rows.column("name").to_pylist(), np.asarray(rows.column("bucket")), np.asarray(rows.column("n"))
    order = tuple(sorted(set(names)))
    place = {name: i for i, name in enumerate(order)}
    counts = np.zeros((len(order), BUCKETS))
    counts[[place[x] for x in names], buckets] = n
    smooth = counts + SMOOTHING
    log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32) if order else np.zeros((0, BUCKETS), np.float32)
    return LanguageModel(order, log_p)


def proportions(unit_log: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Selected proportions of the languages (texts, languages); ``unit_log`` holds the log-likelihood of
    each unit under each language, ``first`` and ``size`` the units of each text (none empty)."""
    peak = unit_log.max(axis=1, keepdims=True)
    like = np.exp(unit_log - peak)
    text = np.repeat(np.arange(len(first)), size)
    penalty = SET_PENALTY + 0.5 * np.log(size)

    def fit(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for the texts ``rows`` with the languages of ``mask``; proportions and log-likelihood."""
        units = np.flatnonzero(np.isin(text, rows)) if len(rows) < len(first) else slice(None)
        part, n = like[units], size[rows]
        begin = np.cumsum(n) - n
        of = np.repeat(np.arange(len(rows)), n)
        theta = mask / mask.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            joint = part * theta[of]
            joint /= joint.sum(axis=1, keepdims=True) + 1e-300
            theta = np.add.reduceat(joint, begin, axis=0) / n[:, None]
        total = np.add.reduceat(np.log((part * theta[of]).sum(axis=1) + 1e-300), begin)
        return theta, total

    everything = np.arange(len(first))
    mask = np.ones((len(first), unit_log.shape[1]))
    theta, total = fit(mask, everything)
    rows = everything
    while len(rows) and unit_log.shape[1] > 1:
        rows = rows[mask[rows].sum(axis=1) > 1]
        if not len(rows):
            break
        rarest = np.where(mask[rows] > 0, theta[rows], np.inf).argmin(axis=1)
        less = mask[rows]
        less[np.arange(len(rows)), rarest] = 0
        new_theta, new_total = fit(less, rows)
        better = new_total + penalty[rows] > total[rows]
        rows = rows[better]
        mask[rows], theta[rows], total[rows] = less[better], new_theta[better], new_total[better]
    return theta


def predict_texts(texts: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    names, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    bucket, begins, words, _ = trigrams(texts)
    n_words = np.diff(words)
    filled = np.flatnonzero(n_words)
    if not len(filled) or not model.names:
        return names, score
    in_text = np.arange(len(begins)) - np.repeat(words[:-1], n_words)
    unit_start = begins[in_text % UNIT_WORDS == 0]
    units = np.stack([np.add.reduceat(row[bucket], unit_start, dtype=np.float64) for row in model.log_p], axis=1)
    size = -(-n_words[filled] // UNIT_WORDS)
    theta = proportions(units, np.cumsum(size) - size, size)
    best = theta.argmax(axis=1)
    for i, k in zip(filled, best):
        names[i] = model.names[k]
    score[filled] = np.clip(theta.max(axis=1), 0.0, 1.0)
    return names, score


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) from rows of (doc_id, text); nothing but the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in bl.text_blocks(batch.column(1)):
                names, score = predict_texts(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(names), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learnt from the labelled documents that are not held out."""
    model = train(docs.select("doc_id", "text", "lang").filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    """Rows whose text is mainly in one language (share at least ``least``), ``lang`` set to it; texts
    without a language go. Columns stay those of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str] = []
            scores: list[np.ndarray] = [np.zeros(0)]
            for _, texts in bl.text_blocks(batch.column(text_at)):
                found, score = predict_texts(texts, shared.value)
                names += found
                scores.append(score)
            columns = [pa.array(names, pa.string()) if i == lang_at else c for i, c in enumerate(batch.columns)]
            keep = (np.concatenate(scores) >= least) & (np.array(names, object) != UNDETERMINED)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
