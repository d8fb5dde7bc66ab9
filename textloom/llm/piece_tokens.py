"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protobuf; its wire format is read here. From it come the pieces with their scores
and types, the normaliser (a character map, white space rules) and the model type. Rebuilt parts: the
normaliser, the metaspace marker with its dummy prefix, a unigram model from the scores or, for files of
the other type, pair merging in the order of the scores, and byte fallback for characters without a
piece. Where no piece holds a marker behind another character, no merge crosses the start of a run of
markers, so texts are cut there and each distinct word is encoded once; this does not change the ids.

Batches of new words are encoded by several threads. Parity with the sentencepiece library is checked
for every distinct word when it is learnt; a difference raises an error. This covers every text:

1. Words are cut where a run of markers begins, and no piece holds a marker behind another character. A
   merge joins two neighbouring symbols to a piece, so none ever reaches across a cut, in either library.
   The merges inside a word depend on its own symbols only, so the ids of a text are those of its words.
2. Words are given to the library many at a time, as raw text that normalises to their concatenation.
   Equal ids of the group mean equal ids of each word, as all ids break at the cuts. Thereby the
   normaliser is checked as well: without a character map and without white space rules it copies
   character by character and turns blanks into markers, and each character and run of blanks of each
   text is part of a checked word.

Where one of these does not hold (a character map, white space rules, pieces across markers), the whole
text is one word, and whole texts are checked. Words are decoded when they are learnt, too; the decoded words of a
text are joined and compared with the text.

Defined results: null texts have null ids; an empty text has none. Repeated rows and null ids give one row
each; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from textloom.llm import blocks as bl

MARK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
WORDS_AT_ONCE = 500
# new words that are encoded at a time: the library's results take many times the room of the ids kept
LEARNT_AT_ONCE = 8_000
CACHED_WORDS, CACHED_CHARS = 150_000, 4_000_000
CHARS_AT_ONCE = 1 << 19
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(field, wire type, value) of each field of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        number, kind = key >> 3, key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} is not part of a model file")
        yield number, kind, value


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def read_model(source: str | bytes) -> PieceModel:
    """Fields by number: pieces 1 (piece 1, score 2, type 3), trainer 2 (model type 3, byte fallback 35),
    normaliser 3 (character map 2, dummy prefix 3, extra white space 4, escaping 5)."""
    model = PieceModel()
    data = source if isinstance(source, bytes) else Path(source).read_bytes()
    for number, _, value in wire(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, _, v in wire(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((text, score, kind))
        elif number == 2:
            for n, _, v in wire(value):
                if n == 3:
                    model.model_type = v
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, _, v in wire(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.add_dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    model.escape_whitespaces = bool(v)
    return model


def merges_by_score(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best score first."""
    score = {text: s for text, s, kind in pieces if kind in (NORMAL, USER)}
    found = []
    for text, s in score.items():
        for cut in range(1, len(text)):
            if text[:cut] in score and text[cut:] in score:
                found.append((-s, score_order(text[:cut], score), score_order(text[cut:], score), text[:cut], text[cut:]))
    return [(left, right) for *_, left, right in sorted(found)]


def score_order(text: str, score: dict[str, float]) -> float:
    return -score[text]


def build(model: PieceModel):
    """A tokenizers.Tokenizer that gives the model's ids."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.model_type == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in model.pieces], unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.model_type == BPE:
        vocab = {t: i for i, (t, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocab, merges_by_score(model.pieces), unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        raise ValueError(f"model type {model.model_type} is not supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_whitespaces else " "))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    crossing = any(b == MARK and a != MARK for t, _, kind in model.pieces if kind in (NORMAL, USER) for a, b in zip(t, t[1:]))
    if not crossing and model.escape_whitespaces:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    decode = [decoders.Replace(MARK, " ")]
    if model.byte_fallback:
        decode.append(decoders.ByteFallback())
    decode.append(decoders.Fuse())
    if model.add_dummy_prefix:
        decode.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(decode)
    return tokenizer


@lru_cache(4)
def tokenizer_of(source: str | bytes):
    """``source`` is the path or the content of a model file, here and below."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    return build(read_model(source))


def characters(piece: str, kind: int) -> int:
    """Characters that a piece stands for. A character's first byte counts for it, the others for none; control and
    unknown pieces have a length that no text reaches."""
    if kind == BYTE:
        return int(int(piece[3:5], 16) & 0xC0 != 0x80)
    return len(piece) if kind in (NORMAL, USER) else 1 << 40


def misspellings(words: list[str], spelt: list[str], blank: str) -> dict[str, str]:
    """Words that are not what their ids decode to, markers read as ``blank``."""
    return {w: t for w, t in zip(words, spelt) if t != w.replace(MARK, blank)}


class WordCache:
    """Ids and spelling of the words that texts are cut into; each distinct word is encoded, checked and
    decoded once.

    A model whose texts must not be cut has the whole text as its only word. Words are kept up to
    ``CACHED_WORDS`` and ``CACHED_CHARS``; then the cache starts anew.
    """

    def __init__(self, source: str | bytes):
        from tokenizers import Tokenizer, decoders

        model = read_model(source)
        self.source = source
        self.whole = tokenizer_of(source)
        # a prefix and a replacement are all there is to normalise
        simple = not model.charsmap and not model.remove_extra_whitespaces and model.escape_whitespaces
        self.cuts = self.whole.pre_tokenizer is not None and simple and model.add_dummy_prefix
        self.bare, self.core = Tokenizer(self.whole.model), Tokenizer(self.whole.model)
        spelling = [decoders.Replace(MARK, " "), *([decoders.ByteFallback()] if model.byte_fallback else []), decoders.Fuse()]
        self.bare.decoder = decoders.Sequence(spelling)
        if self.cuts:
            self.core.pre_tokenizer = self.whole.pre_tokenizer
        self.chars_of = np.array([characters(text, kind) for text, _, kind in model.pieces], np.int64)
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall if self.cuts else (lambda text: [text])
        self.normal = (lambda text: MARK + text.replace(" ", MARK)) if self.cuts else (lambda text: text)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.misspelt: dict[str, str] = {}  # words whose ids do not spell them
        self.chars = 0
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if not new:
            return
        parts = [self._new_ids(new[start : start + LEARNT_AT_ONCE]) for start in range(0, len(new), LEARNT_AT_ONCE)]
        sizes = np.concatenate([p[1] for p in parts])
        for *_, misspelt in parts:
            self.misspelt.update(misspelt)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.chars += sum(map(len, new))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids = np.concatenate([self.ids, *(p[0] for p in parts)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _new_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, dict[str, str]]:
        """All ids of new words, the number of ids of each, and what the ids of misspelt ones decode to."""
        if self.cuts:
            return self.pieces_of(new)
        found = encode_texts(new, self.source)
        check_parity(new, found, self.source)
        spelt = decode_ids(found, self.source)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes, misspellings(new, spelt, MARK)

    def pieces_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, dict[str, str]]:
        """Ids of words, held against the library, as ``_new_ids`` gives them. Words are encoded many at a time:
        the cutting rule parts them again. A word of markers only ends its group, because the next word's marker
        would belong to the same run.

        Groups are decoded whole. Where a group decodes to its text and its pieces have as many characters as its
        words, word by word, the lengths say which ids belong to which word, and each word is spelt by its ids. In
        other groups a fuller encoding says it, and words are decoded one by one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = [i + 1 for i, word in enumerate(words) if word.endswith(MARK)]
        groups: list[tuple[int, int]] = []
        for start, end in zip([0, *ends], [*ends, len(words)]):
            groups += [(s, min(s + WORDS_AT_ONCE, end)) for s in range(start, end, WORDS_AT_ONCE)]
        joined = ["".join(words[s:e]) for s, e in groups]
        found = [encoding.ids for encoding in self.core.encode_batch_fast(joined, add_special_tokens=False)]
        # the first marker is the one that the normaliser puts before a text; one blank alone is an empty text to it
        raw = [text[1:].replace(MARK, " ") if len(text) > 1 else None for text in joined]
        checked = [i for i, text in enumerate(raw) if text is not None]
        check_parity([raw[i] for i in checked], [found[i] for i in checked], self.source)
        if len(checked) < len(raw):
            # the marker alone follows a word; two of them are one run
            check_parity(["a "], [self.core.encode(f"{MARK}a{MARK}", add_special_tokens=False).ids], self.source)
        spelt = self.bare.decode_batch(found, skip_special_tokens=False)
        flat, sizes, misspelt = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64), {}
        for (s, e), text, numbers, decoded in zip(groups, joined, found, spelt):
            ids = np.array(numbers, np.int32)
            flat.append(ids)
            reach, word_ends = np.cumsum(self.chars_of[ids]), np.cumsum(lengths[s:e])
            bounds = np.searchsorted(reach, word_ends, side="right")
            if decoded == text.replace(MARK, " ") and (reach[bounds - 1] == word_ends).all():
                sizes[s:e] = np.diff(bounds, prepend=0)
                continue
            of = self.core.encode(text, add_special_tokens=False).word_ids
            bounds = np.searchsorted(np.array(of, np.int64), np.arange(e - s + 1))
            sizes[s:e] = np.diff(bounds)
            each = [numbers[x:y] for x, y in pairwise(bounds.tolist())]
            misspelt |= misspellings(words[s:e], self.bare.decode_batch(each, skip_special_tokens=False), " ")
        return np.concatenate(flat), sizes, misspelt

    def spelling(self, words: list[str]) -> str:
        """The text that the ids of words decode to. Decoding takes away the blank of the first marker."""
        if self.misspelt:
            words = [self.misspelt.get(w, w) for w in words]
        joined = "".join(words)
        return joined.replace(MARK, " ")[1:] if self.cuts else joined

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, the number of ids of each text, and whether its ids decode to the text."""
        if len(self.index) > CACHED_WORDS or self.chars > CACHED_CHARS:
            self.clear()
        cut = [self.cut(self.normal(text)) if text else [] for text in texts]
        words = [w for row in cut for w in row]
        self.learn(words)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        n_words = np.fromiter(map(len, cut), np.int64, len(cut))
        bounds = np.concatenate([[0], np.cumsum(n_words)])
        total = np.concatenate([[0], ends])[bounds]
        exact = [not text or self.spelling(row) == text for text, row in zip(texts, cut)]
        return ids, np.diff(total), np.array(exact, bool)


@lru_cache(4)
def cache_of(source: str | bytes) -> WordCache:
    return WordCache(source)


@lru_cache(4)
def library(source: str | bytes):
    import sentencepiece

    data = source if isinstance(source, bytes) else Path(source).read_bytes()
    return sentencepiece.SentencePieceProcessor(model_proto=data)


def encode_texts(texts: list[str], source: str | bytes) -> list[list[int]]:
    """Ids of each text, by the rebuilt tokenizer as a whole."""
    return [e.ids for e in tokenizer_of(source).encode_batch_fast(texts, add_special_tokens=False)]


def decode_ids(ids: list[list[int]], source: str | bytes) -> list[str]:
    return tokenizer_of(source).decode_batch(ids, skip_special_tokens=False)


def check_parity(texts: list[str], ids: list[list[int]], source: str | bytes) -> None:
    for text, mine, theirs in zip(texts, ids, library(source).encode(texts, num_threads=1)):
        if mine != theirs:
            raise ValueError(f"ids differ from the sentencepiece library's for a text of {len(text)} characters")


def encode(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """(doc_id, ids, round_trip) per row of ``docs`` (doc_id, text); ``round_trip``: decoding the ids gives
    the text itself back. The model file is read by the driver and sent to the executors."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())  # a model file

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = cache_of(shared.value)
        for batch in batches:
            doc_ids, column = batch.column(0), batch.column(1)
            for start, texts in bl.text_blocks(column, CHARS_AT_ONCE):
                missing = column.slice(start, len(texts)).is_null()
                flat, sizes, exact = words.encode(texts)
                ids, same = bl.list_array(flat, sizes, pa.int32()), pa.array(exact)
                if missing.true_count:
                    ids, same = pc.if_else(missing, None, ids), pc.if_else(missing, None, same)
                yield pa.RecordBatch.from_arrays([doc_ids.slice(start, len(texts)), ids, same], ["doc_id", "ids", "round_trip"])
        # most words of a task are its own, and the worker may go on to other work
        words.clear()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(Path(path).read_bytes())  # a model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            texts = decode_ids([x or [] for x in ids], shared.value)
            out = pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
