"""The whole way from raw documents to token shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.config import CorpusConfig
from textloom.functions import text as tx
from textloom.operators import dedup
from textloom.operators.bpe_codec import Tokenizer, encode
from textloom.operators.packing import assembled, placed_slices, sequence_count, token_offsets
from textloom.operators.sampling import first_rows
from textloom.session import materialize
from textloom.sources.text import text_rows
from textloom.sources.tokenshard import write_token_shards


def source_rows(
    docs: DataFrame, cfg: CorpusConfig = CorpusConfig(), order: str = "doc_id", max_docs: int | None = None
) -> DataFrame:
    """(order, text) after the language and blank filters and the document limit."""
    rows = text_rows(docs, cfg.text_field, cfg.language, cfg.language_score)
    return first_rows(rows.select(order, "text"), order, max_docs)


def quality_rows(rows: DataFrame, cfg: CorpusConfig = CorpusConfig()) -> DataFrame:
    """Add ``words`` and keep rows of plausible length and word size."""
    checked = tx.quality_ok(F.col("words"), cfg.min_words, cfg.min_mean_word, cfg.max_mean_word)
    return tx.with_words(rows).filter(checked)


def unique_ids(
    docs: DataFrame, cfg: CorpusConfig = CorpusConfig(), order: str = "doc_id", max_docs: int | None = None
) -> DataFrame:
    """Ids of the documents that pass all filters and are not near-duplicates of earlier ones."""
    rows = quality_rows(source_rows(docs, cfg, order, max_docs), cfg)
    signed = materialize(dedup.signatures(rows.select(order, "words"), cfg.dedup), "signed")
    return dedup.first_kept_wins(signed, cfg.dedup, order)


@dataclass
class PreparedCorpus:
    """Placed slices of the sequences and the counts of the run."""

    slices: DataFrame
    kept_docs: int
    n_sequences: int

    @property
    def sequences(self) -> DataFrame:
        """Whole sequences with their places; the shard writer takes the slices instead."""
        return assembled(self.slices)


def prepare(
    docs: DataFrame,
    tokenizer: Tokenizer,
    cfg: CorpusConfig = CorpusConfig(),
    order: str = "doc_id",
    max_docs: int | None = None,
    max_sequences: int | None = None,
) -> PreparedCorpus:
    """Filter, deduplicate, tokenize, pack, split and place the documents.

    Text is read once: signatures and token ids are written by the same pass. Deduplication then
    reads the signatures only, and packing reads the token counts before it touches the ids.
    """
    rows = quality_rows(source_rows(docs, cfg, order, max_docs), cfg)
    # signatures first: rows wait for Python's results, and words take several times the space of the text
    signed = dedup.signatures(rows, cfg.dedup)
    with_ids = signed.withColumn("tokens", F.array_append(encode(F.col("text"), tokenizer), F.lit(tokenizer.eos_id)))
    table = with_ids.drop("text").withColumn("n_tokens", F.size("tokens").cast("bigint"))
    encoded = materialize(table, "encoded")
    kept = dedup.first_kept_wins(encoded.select(order, "sig"), cfg.dedup, order)
    lengths = materialize(encoded.select(order, "n_tokens").join(kept, order, "left_semi"), "lengths")
    offsets = materialize(token_offsets(lengths, order), "offsets")
    count = sequence_count(offsets, cfg.seq_len, max_sequences)
    parts = placed_slices(
        encoded, offsets, cfg.seq_len, count, cfg.shard_sequences, cfg.val_fraction, cfg.seed, order
    )
    return PreparedCorpus(parts, lengths.count(), count)


def write_corpus(prepared: PreparedCorpus, path: str, cfg: CorpusConfig = CorpusConfig()) -> None:
    write_token_shards(prepared.slices, path, cfg.seq_len)
