"""Encoding text with a byte-level BPE vocabulary, and decoding it again.

Both are row-local. The JVM cuts text at special tokens and into pieces; a small Arrow function
turns pieces into ids and remembers pieces it has seen, so a frequent piece costs one look-up per
batch. Nothing is shuffled, which is why a piece that makes up a third of all text does no harm.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import CHAT_TOKENS, SpecialTokens

# Fixed value: the published GPT-2 piece pattern, here with Unicode classes switched on.
PIECE_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# pieces that a task remembers, and the longest of them
MEMO_PIECES, MEMO_CHARS = 200_000, 256
# bytes of text, or ids, that are worked on at a time, whatever the size of an Arrow batch; one row may hold more
SLICE = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on.
    """
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    own = set(printable)
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@dataclass
class Tokenizer:
    """Vocabulary, merges in rank order and special tokens. Bounded by the vocabulary size."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    roles: SpecialTokens = field(default_factory=SpecialTokens)

    def __len__(self) -> int:
        return max(self.vocab.values()) + 1 if self.vocab else 0

    def id_of(self, token: str) -> int | None:
        return self.vocab.get(token)

    @property
    def eos_id(self) -> int | None:
        return self.id_of(self.roles.eos)

    @property
    def bos_id(self) -> int | None:
        return self.id_of(self.roles.bos)

    @property
    def pad_id(self) -> int:
        return self.id_of(self.roles.pad) or 0

    def with_special_tokens(self, tokens: tuple[str, ...] = CHAT_TOKENS) -> Tokenizer:
        """Append the tokens that are not there yet at the end of the vocabulary."""
        vocab, special = dict(self.vocab), dict(self.special)
        for token in tokens:
            vocab.setdefault(token, max(vocab.values(), default=-1) + 1)
            special[token] = vocab[token]
        return Tokenizer(vocab, self.merges, special, self.roles)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(token, i, token in self.special) for token, i in sorted(self.vocab.items(), key=lambda kv: kv[1])]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, a, b, a + b) for rank, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, merged string")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the vocabulary and merges as Parquet tables below ``path``."""
        self.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")

    @staticmethod
    def load(spark: SparkSession, path: str, roles: SpecialTokens = SpecialTokens()) -> Tokenizer:
        # both tables are bounded by the vocabulary size
        vocab = spark.read.parquet(f"{path}/vocab").collect()
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        return Tokenizer(
            {r.token: r.id for r in vocab},
            [(r.left, r.right) for r in merges],
            {r.token: r.id for r in vocab if r.special},
            roles,
        )


def saved_vocab_size(spark: SparkSession, path: str) -> int | None:
    """Entries of a saved vocabulary, or None when there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{path}/vocab").count()
    except AnalysisException:
        return None


def pieces(text: Column, special: list[str] | tuple[str, ...] = ()) -> Column:
    """Cut text into pieces; special tokens come out whole."""
    plain = F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))
    if not special:
        return plain
    names = sorted(special, key=len, reverse=True)
    any_special = "|".join(re.escape(name) for name in names)
    segments = F.split(text, f"(?={any_special})|(?<={any_special})")
    cut = F.flatten(
        F.transform(
            segments,
            lambda s: F.when(s.isin(*names), F.array(s)).otherwise(
                F.regexp_extract_all(s, F.lit(PIECE_PATTERN), F.lit(0))
            ),
        )
    )
    return F.when(text.rlike(any_special), cut).otherwise(plain)


def merge_piece(symbols: list, ranks: dict) -> list:
    """Apply merges to one piece: lowest rank first, leftmost first."""
    size = len(symbols)
    after = [*range(1, size), -1]
    before = list(range(-1, size - 1))
    queue = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0:
            found = ranks.get((symbols[i], symbols[after[i]]))
            if found:
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[after[i]], found[1]))

    for i in range(size - 1):
        offer(i)
    while queue:
        _, i, left, right, merged = heapq.heappop(queue)
        j = after[i]
        if j < 0 or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], symbols[j] = merged, None
        after[i] = after[j]
        after[j] = -1
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s in symbols if s is not None]


def piece_encoder(vocab: dict, merges: list, special: dict, unknown: int | None):
    """A function from piece to ids that remembers up to ``MEMO_PIECES`` pieces."""
    byte_ids = [vocab.get(s, unknown) for s in byte_symbols()]
    ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
    fixed = {token: [i] for token, i in special.items()}
    memo: dict[str, list[int]] = dict(fixed)

    def encode(piece: str) -> list[int]:
        ids = memo.get(piece)
        if ids is None:
            start = [byte_ids[b] for b in piece.encode("utf-8")]
            ids = merge_piece([i for i in start if i is not None], ranks)
            if len(memo) >= MEMO_PIECES:
                memo.clear()
                memo.update(fixed)
            if len(piece) <= MEMO_CHARS:
                memo[piece] = ids
        return ids

    return encode


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[s:s+n]`` over all (s, n)."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + shift]


def _ids_of_pieces(column: pa.Array, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets over pieces, number of ids of every piece, and all ids in order."""
    offsets = np.asarray(column.offsets).astype(np.int64)
    offsets -= offsets[0]
    coded = column.flatten().dictionary_encode()
    encoded = [encode(piece) for piece in coded.dictionary.to_pylist()]
    counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
    table = np.fromiter((i for ids in encoded for i in ids), np.int32, int(counts.sum()))
    starts = np.cumsum(counts) - counts
    which = np.asarray(coded.indices)
    lengths = counts[which] if len(which) else np.zeros(0, np.int64)
    return offsets, lengths, _gather(table, starts[which] if len(which) else lengths, lengths)


def _row_slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last row of slices with about ``SLICE`` units in all; ``ends``: running total with a leading 0."""
    first, rows = 0, len(ends) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, "right")) - 1)
        yield first, last
        first = last


def _offsets(column: pa.Array) -> np.ndarray:
    """Running total of the lengths of lists or strings; null has none."""
    count = pc.binary_length if pa.types.is_string(column.type) else pc.list_value_length
    return np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(count(column), 0), np.int64))])


def _broadcast(tokenizer: Tokenizer):
    """One copy of the tables per executor; their size is bounded by the vocabulary."""
    tables = (tokenizer.vocab, tokenizer.merges, tokenizer.special, tokenizer.id_of(tokenizer.roles.unk))
    return SparkSession.active().sparkContext.broadcast(tables)


def _by_slices(rows: pa.Array, encode) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of pieces, array<string>, a bounded part at a time, with what ``_ids_of_pieces`` gives."""
    texts = _offsets(rows.flatten())
    for first, last in _row_slices(texts[_offsets(rows)]):
        part = rows.slice(first, last - first)
        yield part, *_ids_of_pieces(part, encode)


def encode_pieces(piece_array: Column, tokenizer: Tokenizer) -> Column:
    """array<string> of pieces to array<int> of token ids."""
    shared = _broadcast(tokenizer)

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = piece_encoder(*shared.value)
        for column in columns:
            for _, offsets, lengths, values in _by_slices(column, encode):
                ends = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.ListArray.from_arrays(pa.array(ends[offsets].astype(np.int32)), pa.array(values))

    return ids(piece_array)


def encode_pieces_nested(piece_array: Column, tokenizer: Tokenizer) -> Column:
    """array<string> of pieces to array<array<int>>, one inner array per piece."""
    shared = _broadcast(tokenizer)

    @F.arrow_udf("array<array<int>>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = piece_encoder(*shared.value)
        for column in columns:
            for _, offsets, lengths, values in _by_slices(column, encode):
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), inner)

    return ids(piece_array)


def encode_several(texts: list[Column], tokenizer: Tokenizer) -> Column:
    """Ids of each of the texts, array<array<int>>, by one function: a task needs one Python worker for all of them."""
    shared = _broadcast(tokenizer)

    @F.arrow_udf("array<array<int>>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = piece_encoder(*shared.value)
        for column in columns:
            each = column.flatten()
            pieces_of = _offsets(each)[_offsets(column)]
            for first, last in _row_slices(_offsets(each.flatten())[pieces_of]):
                part = column.slice(first, last - first)
                offsets, lengths, values = _ids_of_pieces(part.flatten(), encode)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                inner = pa.ListArray.from_arrays(pa.array(ends[offsets].astype(np.int32)), pa.array(values))
                yield pa.ListArray.from_arrays(pa.array(_offsets(part).astype(np.int32)), inner)

    special = list(tokenizer.special)
    return ids(F.array(*[pieces(F.coalesce(text, F.lit("")), special) for text in texts]))


def encode(text: Column, tokenizer: Tokenizer) -> Column:
    """Token ids of a text column, without automatic special tokens."""
    return encode_pieces(pieces(F.coalesce(text, F.lit("")), list(tokenizer.special)), tokenizer)


def decode(ids: Column, tokenizer: Tokenizer, skip_special: bool = True) -> Column:
    """Text of an array of token ids; byte sequences that are not UTF-8 become U+FFFD."""
    table = decoding_table(tokenizer, skip_special)

    def text_of(column: pa.Array) -> pa.Array:
        flat = np.asarray(column.flatten().fill_null(-1), np.int64)
        # ids outside the vocabulary decode to nothing
        known = np.where((flat >= 0) & (flat < len(table) - 1), flat, len(table) - 1)
        sizes = pc.fill_null(pc.list_value_length(column), 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.asarray(sizes))]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(table, pa.binary()).take(pa.array(known)))
        whole = pc.if_else(column.is_null(), None, pc.binary_join(lists, b""))
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if v is None else v.decode("utf-8", "replace") for v in whole.to_pylist()], pa.string())

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        parts = [text_of(column.slice(first, last - first)) for first, last in _row_slices(_offsets(column))]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return text(ids)


def decoding_table(tokenizer: Tokenizer, skip_special: bool) -> list[bytes]:
    """Bytes of each id, and an empty entry at the end. Special tokens are literal text."""
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    out = [b""] * (max(tokenizer.vocab.values(), default=-1) + 2)
    for token, i in tokenizer.vocab.items():
        if token in tokenizer.special:
            out[i] = b"" if skip_special else token.encode()
        else:
            out[i] = bytes(byte_of[c] for c in token)
    return out


def tokenize_documents(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", out: str = "tokens") -> DataFrame:
    """Replace the text by its ids with one end-of-text id appended."""
    ids = F.array_append(encode(F.col(text), tokenizer), F.lit(tokenizer.eos_id))
    return docs.withColumn(out, ids).drop(text)
