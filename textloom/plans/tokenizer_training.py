"""Learning a tokenizer from the head of a filtered corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textloom.config import CorpusConfig, TokenizerConfig
from textloom.operators import bpe_train
from textloom.operators.bpe_codec import Tokenizer
from textloom.operators.sampling import byte_budget
from textloom.plans.corpus_prep import source_rows


def train_tokenizer(
    docs: DataFrame,
    cfg: TokenizerConfig = TokenizerConfig(),
    corpus: CorpusConfig = CorpusConfig(),
    order: str = "doc_id",
    save_to: str | None = None,
) -> Tokenizer:
    """Filter, cut to the byte budget, learn, and save when a path is given."""
    rows = source_rows(docs, corpus, order)
    model = bpe_train.train(byte_budget(rows, order, cfg.sample_bytes), cfg)
    if save_to is not None:
        model.save(docs.sparkSession, save_to)
    return model
