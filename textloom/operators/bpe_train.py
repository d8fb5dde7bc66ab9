"""Learning a byte-level BPE vocabulary with DataFrame jobs.

A distinct piece is one row: its text as a string in which every symbol is a single code point
(``BASE`` plus the symbol's id), and its count. A round is one pass over these rows: an Arrow function applies
the merges that the table lacks and adds up the pairs of its task on arrays of code points, and Spark sums over
the tasks. Once merges have become rare, counts are kept by differences of the pieces that a pair index names.

Several merges are taken per round: the head of the pair ranking up to the first pair that can touch
an earlier one. Merging ``(a, b)`` only changes pairs that end in ``a`` or start with ``b``, and all
of these rank behind the pairs taken. A pair created by the merge stands in for one of them, so it
is no more frequent; where counts tie, ids decide, and new symbols have the largest ids. So no new
pair can come before one that was taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import SpecialTokens, TokenizerConfig
from textloom.operators.bpe_codec import Tokenizer, byte_symbols, pieces
from textloom.session import materialize

BASE = 0x10000
# pairs looked at per round; fetched to the driver, hence bounded
RANKED_PAIRS = 512
# a table is written after this many merges, which bounds the length of the plan
MERGES_PER_TABLE = 32
# pieces are indexed by pair once a table's merges took this share of all pairs or less; a recount is a short pass,
# building the index takes as long as about ten of them
RECOUNT_SHARE = 0.01
# stands between pieces in arrays of code points
BREAK = 0x110000
# distinct pairs that a task keeps before it hands them on
KEPT_PAIRS = 1 << 20
# a list of constants of this length or more compiles to the same code whatever it holds
LEAST_KEYS = 12
ROWS_PER_TASK = 5_000
# longer pieces are cut into an array first, so that taking all pairs stays linear
SHORT_PIECE = 48


class PieceTable:
    """Pieces that still have pairs, as symbol strings with counts, spread over ``parts`` tasks."""

    def __init__(self, words: DataFrame, parts: int, spread: bool = True) -> None:
        rows = words.filter(F.char_length("symbols") > 1)
        self.words, self.parts = materialize(rows.repartition(parts) if spread else rows, "symbols"), parts

    @cached_property
    def counts(self) -> DataFrame:
        """Counts of all pairs."""
        return materialize(summed_pairs(self.words), "pairs")

    def after(self, merges: list[tuple[str, str]]) -> PieceTable:
        """The table with ``merges`` applied. Rows stay in the tasks that they are in."""
        return PieceTable(self.words.mapInArrow(_merged_rows(merges), "symbols string, n bigint"), self.parts, spread=False)

    @cached_property
    def index(self) -> DataFrame:
        """(pair, symbols, n), sorted by pair."""
        rows = self.words.selectExpr(f"explode(array_distinct({pairs_of('symbols')})) as pair", "symbols", "n")
        return materialize(rows.repartitionByRange(self.parts, "pair").sortWithinPartitions("pair"), "pair_index")


def piece_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(piece, n): how often every piece occurs. Counts combine on the map side."""
    return (
        docs.select(F.explode(pieces(F.col(text))).alias("piece"))
        .groupBy("piece")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def byte_string(piece: Column) -> Column:
    """A string with one Latin-1 character per UTF-8 byte."""
    return F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1")


def code_points(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))


def byte_alphabet(counts: DataFrame) -> list[int]:
    """Byte values that occur, in the order of the characters that stand for them."""
    found = counts.select(F.explode(F.array_distinct(code_points(byte_string(F.col("piece"))))).alias("b"))
    values = [ord(row["b"]) for row in found.distinct().collect()]  # at most 256
    symbols = byte_symbols()
    return sorted(values, key=lambda b: symbols[b])


def initial_vocab(alphabet: list[int], special: SpecialTokens = SpecialTokens()) -> dict[str, int]:
    """Special tokens first, then the bytes seen."""
    symbols = byte_symbols()
    tokens = [*dict.fromkeys(special.ordered()), *[symbols[b] for b in alphabet]]
    return {token: i for i, token in enumerate(tokens)}


def pairs_of(symbols: str) -> str:
    """SQL text of the array of adjacent pairs in a string of at least two symbols. It is rebuilt in every
    round, and building it call by call would take longer."""
    return f"""case when char_length({symbols}) < 2 then cast(array() as array<string>)
        when char_length({symbols}) <= {SHORT_PIECE} then
            transform(sequence(1, char_length({symbols}) - 1), i -> substring({symbols}, i, 2))
        else transform(array(regexp_extract_all({symbols}, '(?s).', 0)),
            c -> transform(sequence(0, size(c) - 2), i -> concat(get(c, i), get(c, i + 1))))[0]
        end"""


def pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n): total count of every two adjacent symbols."""
    split = words.selectExpr("n", f"explode({pairs_of('symbols')}) as pair")
    return split.groupBy("pair").agg(F.sum("n").alias("n"))


def codes_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the symbols of a batch (symbols, n), a ``BREAK`` behind each piece, and the counts."""
    texts = batch.column(0).cast(pa.binary())
    data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), b"")[0].as_py()
    codes = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.asarray(pc.utf8_length(batch.column(0)), np.int64))
    return np.insert(codes, ends, BREAK), np.asarray(batch.column(1), np.int64)


def merge_codes(codes: np.ndarray, merges: list[tuple[str, str]]) -> np.ndarray:
    """Apply each ``(pair, symbol)`` in turn, leftmost first, as ``apply_merges`` does."""
    for pair, new in merges:
        left, right = map(ord, pair)
        hit = np.flatnonzero((codes[:-1] == left) & (codes[1:] == right))
        if not len(hit):
            continue
        if left == right:
            # every other place of a run of equal symbols
            number = np.arange(len(hit))
            first = np.maximum.accumulate(np.where(np.diff(hit, prepend=-2) != 1, number, 0))
            hit = hit[(number - first) % 2 == 0]
        codes[hit] = ord(new)
        codes = np.delete(codes, hit + 1)
    return codes


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of ``n`` of each."""
    by = np.argsort(keys, kind="stable")
    keys, n = keys[by], n[by]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def pair_sums(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of neighbours within a piece, as one number, and its total count."""
    ends = np.flatnonzero(codes == BREAK)
    weight = np.repeat(n, np.diff(ends, prepend=-1))
    weight, low = weight[:-1], int(codes.min())
    # the break comes behind the largest symbol
    wide = int(codes[codes != BREAK].max(initial=low)) - low + 2
    if wide**2 > 8 * len(codes):
        left, right = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
        inside = (left != BREAK) & (right != BREAK)
        return summed(left[inside] << 21 | right[inside], weight[inside])
    # few symbols: a table of all pairs. Each half of a count is summed exactly in doubles
    place = np.minimum(codes - low, wide - 1).astype(np.int64)
    cell = place[:-1] * wide + place[1:]
    total = np.bincount(cell, weight & 0xFFFFFFFF, wide * wide).astype(np.int64)
    if (weight >> 32).any():
        total += np.bincount(cell, weight >> 32, wide * wide).astype(np.int64) << 32
    found = np.flatnonzero(total)
    a, b = found // wide, found % wide
    inside = (a < wide - 1) & (b < wide - 1)
    return (((a + low) << 21) | (b + low))[inside], total[found][inside]


def _pair_rows(merges: list[tuple[str, str]]):
    """(pair, n) of the rows of a task after ``merges``."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        both = np.stack([keys >> 21, keys & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
        return pa.RecordBatch.from_arrays([pa.array([both[i : i + 2] for i in range(0, len(both), 2)], pa.string()), pa.array(n)], ["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, n = codes_of(batch)
            parts.append(pair_sums(merge_codes(codes, merges), n))
            size += len(parts[-1][0])
            if size > KEPT_PAIRS:
                parts = [summed(*map(np.concatenate, zip(*parts)))]
                size = len(parts[0][0])
                if size > KEPT_PAIRS // 2:
                    yield rows(*parts[0])
                    parts, size = [], 0
        if parts:
            yield rows(*summed(*map(np.concatenate, zip(*parts))))

    return run


def _merged_rows(merges: list[tuple[str, str]]):
    """(symbols, n) after ``merges``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = codes_of(batch)
            codes = merge_codes(codes, merges)
            ends = np.flatnonzero(codes == BREAK) - np.arange(batch.num_rows)
            text, ends = codes[codes != BREAK].astype("<u4").tobytes().decode("utf-32-le"), [0, *ends.tolist()]
            symbols = pa.array([text[a:b] for a, b in zip(ends, ends[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([symbols, batch.column(1)], ["symbols", "n"])

    return run


def summed_pairs(words: DataFrame, merges: list[tuple[str, str]] = ()) -> DataFrame:
    """What ``pair_counts`` gives after ``merges``, in one pass over (symbols, n)."""
    return words.select("symbols", "n").mapInArrow(_pair_rows(merges), "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def current_counts(table: PieceTable, merges: list[tuple[str, str]], touched_by: list[str]) -> DataFrame:
    """Pair counts after ``merges`` of (pair, symbol). ``touched_by`` names a pair of the table's own symbols that
    is part of every occurrence of each merge; pieces without any of these stay as they are."""
    if not merges:
        return table.counts
    found = list(dict.fromkeys(touched_by))
    # strings of one symbol stand for no pair
    keys = ", ".join(f"'{pair}'" for pair in found + [chr(BASE + i) for i in range(LEAST_KEYS - len(found))])
    # a piece under several of the pairs counts under the first one it has
    first = f"pair = filter(array({keys}), p -> instr(symbols, p) > 0)[0]"
    touched = table.index.filter(f"pair in ({keys})").filter(first).select("n", "symbols")
    moved = touched.withColumn("after", apply_merges("symbols", merges)).filter("after <> symbols")
    gone = f"transform({pairs_of('symbols')}, p -> named_struct('pair', p, 'n', -n))"
    new = f"transform({pairs_of('after')}, p -> named_struct('pair', p, 'n', n))"
    change = moved.selectExpr(f"inline(concat({gone}, {new}))")
    return table.counts.unionByName(change).groupBy("pair").agg(F.sum("n").alias("n"))


def accept_merges(
    ranked: list[tuple[int, int]], vocab: dict[str, int], names: list[str], room: int
) -> list[tuple[int, int]]:
    """Pairs to merge in this round, from ``(left, right)`` in ranking order."""
    heads: set[int] = set()
    tails: set[int] = set()
    made: set[str] = set()
    out: list[tuple[int, int]] = []
    for left, right in ranked[:RANKED_PAIRS]:
        if len(made) >= room or right in heads or left in tails:
            break
        out.append((left, right))
        token = names[left] + names[right]
        # doubled symbols and symbols that exist already can make pairs more frequent: rank again
        if left == right or token in vocab or token in made:
            break
        heads.add(left)
        tails.add(right)
        made.add(token)
    return out


def apply_merges(symbols: str, merges: list[tuple[str, str]]) -> Column:
    """Replace each ``(pair, symbol)`` in turn.

    Written as a fold over a constant so that every round compiles to the same code.
    """
    table = ", ".join(f"('{pair}', '{new}')" for pair, new in merges)
    rule = "(text, m) -> replace(text, m.col1, m.col2)"
    return F.expr(f"aggregate(array({table}), {symbols}, {rule})")


def train(
    docs: DataFrame,
    cfg: TokenizerConfig = TokenizerConfig(),
    text: str = "text",
) -> Tokenizer:
    """Learn merges until the vocabulary is full or no pair occurs ``min_frequency`` times."""
    special = cfg.special_tokens
    counts = materialize(piece_counts(docs, text), "pieces")
    alphabet = byte_alphabet(counts)
    vocab = initial_vocab(alphabet, special)
    names = list(vocab)
    symbols = byte_symbols()
    source = "".join(chr(b) for b in alphabet)
    target = "".join(chr(BASE + vocab[symbols[b]]) for b in alphabet)
    start = F.translate(byte_string(F.col("piece")), source, target) if alphabet else F.col("piece")
    parts = min(counts.count() // ROWS_PER_TASK + 1, docs.sparkSession.sparkContext.defaultParallelism)
    table = PieceTable(counts.select(start.alias("symbols"), "n"), parts)
    merges: list[tuple[str, str]] = []
    pending: list[tuple[str, str]] = []
    touched_by: list[str] = []
    # pairs in all pieces, and those that the merges since the table took
    total, taken = table.words.agg(F.sum(F.col("n") * (F.char_length("symbols") - 1))).first()[0] or 0, 0
    indexed = RECOUNT_SHARE >= 1
    # first and last symbol of the table inside each newer symbol
    edges: dict[int, tuple[int, int]] = {}
    while len(vocab) < cfg.vocab_size:
        top = (
            (current_counts(table, pending, touched_by) if indexed else summed_pairs(table.words, pending))
            .filter(F.col("n") >= cfg.min_frequency)
            .orderBy(F.desc("n"), "pair")
            .limit(RANKED_PAIRS)
            .collect()
        )
        if not top:
            break
        ranked = [(ord(r.pair[0]) - BASE, ord(r.pair[1]) - BASE) for r in top]
        accepted = accept_merges(ranked, vocab, names, cfg.vocab_size - len(vocab))
        taken += sum(r.n for r in top[: len(accepted)])
        for left, right in accepted:
            token = names[left] + names[right]
            merges.append((names[left], names[right]))
            known = token in vocab
            if not known:
                vocab[token] = len(names)
                names.append(token)
            begin, end = edges.get(left, (left, left)), edges.get(right, (right, right))
            touched_by.append(chr(BASE + begin[1]) + chr(BASE + end[0]))
            # a symbol that exists already stands in the table, too, where it begins and ends with itself
            if not known:
                edges[vocab[token]] = (begin[0], end[1])
            pending.append((chr(BASE + left) + chr(BASE + right), chr(BASE + vocab[token])))
            if known:
                break
        if len(pending) >= MERGES_PER_TABLE or known:
            table = table.after(pending)
            indexed = taken <= RECOUNT_SHARE * total
            pending, touched_by, edges, total, taken = [], [], {}, total - taken, 0
    return Tokenizer(vocab, merges, {t: vocab[t] for t in special.ordered()}, special)
