"""Default settings of a corpus-preparation run.

Fixed values: numbers and token strings that must equal those of existing corpora and models.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DedupConfig:
    permutations: int = 64
    bands: int = 16
    threshold: float = 0.85
    shingle_size: int = 5


@dataclass(frozen=True)
class SpecialTokens:
    pad: str = "<|pad|>"
    bos: str = "<|bos|>"
    eos: str = "<|eos|>"
    unk: str = "<|unk|>"

    def ordered(self) -> list[str]:
        return [self.pad, self.bos, self.eos, self.unk]


CHAT_TOKENS = ("<|im_start|>", "<|im_end|>")
SYSTEM_PROMPT = "You are a helpful assistant."
IGNORE_LABEL = -100


@dataclass(frozen=True)
class TokenizerConfig:
    vocab_size: int = 32_000
    min_frequency: int = 2
    sample_bytes: int = 1_000_000_000
    special_tokens: SpecialTokens = field(default_factory=SpecialTokens)


@dataclass(frozen=True)
class CorpusConfig:
    text_field: str = "text"
    language: str = "en"
    language_score: float = 0.9
    min_words: int = 20
    min_mean_word: float = 2.0
    max_mean_word: float = 10.0
    seq_len: int = 2048
    val_fraction: float = 0.05
    shard_sequences: int = 8192
    seed: int = 1337
    dedup: DedupConfig = field(default_factory=DedupConfig)


@dataclass(frozen=True)
class SftConfig:
    batch_size: int = 32
    max_seq_len: int = 2048


@dataclass(frozen=True)
class PreferenceConfig:
    beta: float = 0.1
    batch_size: int = 4
    max_seq_len: int = 2048


@dataclass(frozen=True)
class SamplingConfig:
    temperature: float = 0.7
    top_p: float = 0.9
    top_k: int = 50


@dataclass(frozen=True)
class EvalConfig:
    tasks: tuple[str, ...] = ("hellaswag", "arc_easy", "arc_challenge", "piqa", "winogrande")
    token_budget: int = 1_000_000
