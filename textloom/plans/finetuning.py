"""Whole jobs that prepare fine-tuning data: from chat and preference rows to shuffled, padded batches, and from model
scores to the preference loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.config import PreferenceConfig, SftConfig
from textloom.functions import chatml
from textloom.operators import chat, preference, scores
from textloom.operators.bpe_codec import Tokenizer
from textloom.session import materialize


def sft_batches(
    examples: DataFrame, tokenizer: Tokenizer, cfg: SftConfig = SftConfig(), order: str = "conv_id", seed: int = 1337, epoch: int = 0
) -> DataFrame:
    """(order, batch_id, input_ids, labels, attention_mask) from raw chat examples, for one epoch.

    Messages are normalised, rendered, encoded with masked labels and truncated; the examples are shuffled by
    seed and epoch, batched, and padded to the longest of a batch. The last batch may be short. Encoding is written
    once, so that further epochs can start from it.
    """
    model = tokenizer.with_special_tokens()
    rows = chatml.normalize_messages(examples).select(order, "messages")
    encoded = materialize(chat.encode_chat(rows, model, cfg.max_seq_len), "chat")
    return chat.pad_chat_batches(encoded, order, cfg.batch_size, model.pad_id, shuffle=f"{seed}:{epoch}")


def preference_batches(
    pairs: DataFrame, tokenizer: Tokenizer, cfg: PreferenceConfig = PreferenceConfig(), order: str = "conv_id", seed: int = 1337, epoch: int = 0
) -> DataFrame:
    """Batches of encoded preference pairs from rows with prompt, chosen and rejected in any of the accepted shapes."""
    model = tokenizer.with_special_tokens()
    rows = chatml.normalize_pairs(pairs).select(order, "prompt", "chosen", "rejected")
    encoded = materialize(preference.encode_pairs(rows, model, cfg.max_seq_len), "pairs")
    return preference.pad_pair_batches(encoded, order, cfg.batch_size, model.pad_id, shuffle=f"{seed}:{epoch}")


def preference_objective(policy: DataFrame, reference: DataFrame, labels: DataFrame, cfg: PreferenceConfig = PreferenceConfig()) -> DataFrame:
    """One row ``loss`` from the scores of two models.

    ``policy`` and ``reference`` hold (pair, side, pos, token, logit), ``labels`` (pair, side, pos, label), with side ``chosen`` or
    ``rejected``. Pairs without one of the sides do not count.
    """
    seq = F.struct("pair", "side").alias("seq")
    marked = labels.select(seq, "pos", "label")

    def sides(logits: DataFrame, prefix: str) -> DataFrame:
        scored = scores.sequence_scores(logits.select(seq, "pos", "token", "logit"), marked)
        found = [F.max(F.when(F.col("seq.side") == s, F.col("logp"))).alias(prefix + s) for s in preference.SIDES]
        return scored.groupBy(F.col("seq.pair").alias("pair")).agg(*found)

    both = sides(policy, "").join(sides(reference, "ref_"), "pair")
    return scores.preference_loss(both, cfg.beta)
