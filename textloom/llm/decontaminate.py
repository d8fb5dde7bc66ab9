"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts of both sides are normalised alike: A-Z become lower case and everything in ASCII but letters and
digits separates words, so that words keep their order and number. Every run of ``WINDOW`` words of an
item (all its words, if it has fewer) is a pattern, written with a blank on both sides. All patterns go
into one automaton, every document is scanned once, and the place of a match leads back to word numbers
and from there to the characters of the original text. All matches are found, overlapping ones too.

The automaton is broadcast, so its size is bounded: patterns beyond ``PATTERN_CHARS`` characters are
dealt over several automata, and the documents pass one after the other. Nothing else is shuffled or
collected: a document is scanned where it is read.

Defined results: null texts have no words, and items without words have no patterns. Patterns of items
without an id count as hits but name no item; several rows with one id are one item. Every row of the
documents gives one row, repeated and null ids included; other columns of either table are ignored.
Without items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize

WINDOW = 10
# about 40 bytes of automaton each, in every Python worker
PATTERN_CHARS = 1 << 22
# lower-cases A-Z; ASCII other than letters and digits becomes a blank, bytes of longer characters stay
NORMAL = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
ORIGINAL_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
FOUND = "n_words bigint, hits array<int>, items array<string>, spans array<int>"


@dataclass(frozen=True)
class Patterns:
    automaton: ahocorasick.Automaton
    n_words: list[int]  # of each pattern
    items: list[list[str]]  # of each pattern


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(items: DataFrame, item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Distinct (pattern, n_words, item) of a table of (item_id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(text or b"")
                size = min(window, len(words))
                found = [b" %b " % b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
                columns = [pa.array([p.decode() for p in found], pa.string()), pa.array([size] * len(found), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([item] * len(found), pa.string())], ["pattern", "n_words", "item"])

    rows = items.select(F.col(item_id).cast("string").alias("item"), "text")
    return rows.mapInArrow(cut, "pattern string, n_words int, item string").distinct()


def build(rows: pa.Table) -> Patterns | None:
    """The automaton of some (pattern, n_words, item) rows."""
    number: dict[str, int] = {}
    n_words: list[int] = []
    items: list[list[str]] = []
    for pattern, n, item in zip(*(rows.column(c).to_pylist() for c in ("pattern", "n_words", "item"))):
        at = number.setdefault(pattern, len(number))
        if at == len(items):
            n_words.append(n)
            items.append([])
        if item is not None:
            items[at].append(item)
    if not number:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, at in number.items():
        automaton.add_word(pattern, at)
    automaton.make_automaton()
    return Patterns(automaton, n_words, items)


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (start, end) joined, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan(words: list[bytes], patterns: Patterns) -> tuple[list[tuple[int, int]], set[str]]:
    """Stretches of words (start, end) covered by patterns, and the items these belong to."""
    text = (b" %b " % b" ".join(words)).decode()
    found = list(patterns.automaton.iter(text))
    if not found:
        return [], set()
    # the blank after word j is at blanks[j]
    blanks = np.cumsum([len(word) + 1 for word in text[1:-1].split(" ")])
    ends = np.searchsorted(blanks, [at for at, _ in found]) + 1
    stretches = {(int(end) - patterns.n_words[k], int(end)) for end, (_, k) in zip(ends, found)}
    return merged(list(stretches)), {item for k in {k for _, k in found} for item in patterns.items[k]}


def char_spans(text: str, stretches: list[tuple[int, int]]) -> list[int]:
    """Start and end characters of stretches of words in the original text, one after the other."""
    if not stretches:
        return []
    places = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [edge for start, end in stretches for edge in (places[start][0], places[end - 1][1])]


def _scanned(rows: DataFrame, patterns: Patterns | None, last: bool) -> DataFrame:
    """Add the matches of ``patterns`` to ``hits`` (word numbers) and ``items``; the last pass leaves out
    the text and gives the places in it."""
    shared = rows.sparkSession.sparkContext.broadcast(patterns)  # at most about PATTERN_CHARS characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits, items, spans = [], [], [], []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for text, hit, item in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text or b"")
                stretches, names = scan(words, shared.value) if words and shared.value else ([], set())
                both = merged(stretches + list(zip(hit[0::2], hit[1::2])))
                n_words.append(len(words))
                hits.append([edge for stretch in both for edge in stretch])
                items.append(sorted(names | set(item)))
                spans.append(char_spans(text.decode(), both) if last and both else [])
            ints, strings = pa.list_(pa.int32()), pa.list_(pa.string())
            found = [pa.array(hits, ints), pa.array(items, strings)]
            if last:
                columns = [batch.column(0), pa.array(n_words, pa.int64()), *found, pa.array(spans, ints)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "hits", "items", "spans"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["doc_id", "text", "hits", "items"])

    doc_id = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    return rows.mapInArrow(run, f"{doc_id}, {FOUND}" if last else f"{doc_id}, text string, hits array<int>, items array<string>")


def find(docs: DataFrame, items: DataFrame, item_id: str = "item_id", window: int = WINDOW, pattern_chars: int = PATTERN_CHARS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of each row of (doc_id, text).

    ``items`` are the ids, as sorted strings, of the items with patterns in the text; ``spans`` are the
    (start, end) code points, end exclusive, of the stretches of hit words in the original text.
    """
    patterns = materialize(item_windows(items, item_id, window), "patterns")
    size = patterns.agg(F.sum(F.length("pattern") + F.coalesce(F.length("item"), F.lit(0)))).first()[0] or 0
    parts = max(1, -(-size // pattern_chars))
    none = F.array()
    rows = docs.select("doc_id", "text", none.cast("array<int>").alias("hits"), none.cast("array<string>").alias("items"))
    place = F.pmod(F.xxhash64("pattern", "item"), F.lit(parts))
    for part in range(parts):
        rows = _scanned(rows, build(patterns.filter(place == part).toArrow()), part == parts - 1)
        if part < parts - 1:
            rows = materialize(rows, "scanned")
    pairs = lambda c: F.transform(F.sequence(F.lit(1), F.size(c), F.lit(2)), lambda i: F.struct(F.get(c, i - 1).alias("start"), F.get(c, i).alias("end")))
    n_hit = F.aggregate("hits", F.lit(0), lambda n, edge: edge - n)
    spans = F.when(F.size("spans") > 0, pairs("spans")).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    return rows.select("doc_id", "n_words", n_hit.cast("bigint").alias("n_hit"), "items", spans.alias("spans"))
