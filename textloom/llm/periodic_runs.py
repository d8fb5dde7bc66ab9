"""Runs of words that repeat with a period, by a dictionary of basic factors.

Every stretch of L = 1, 2, 4, ... words gets a name, equal stretches the same one: the name of a
stretch is that of the pair of its halves. Sorted by name and place, the next occurrence of each stretch
is its neighbour. Occurrences within a window of 2 L words, that is at most L apart, form arithmetic
progressions whose difference is a period. A run with smallest period p is taken at the least L that is
not below p: there the next occurrence of each of its stretches is exactly p away, so places with one
and the same difference follow each other without a gap, and from the first to the last of them, longer
by p + L, the run extends to its very ends. Each run is met at one level only.

A run counts from an exponent of ``EXPONENT`` and a length of ``LEAST`` words. So a stretch matters only
while another one within a quarter of the text equals it, and in prose few places are left after two levels.

Work is per document, without any shuffle; documents of a batch are handled in blocks of a bounded
number of words (or the longest document). Defined results: null and empty texts have no words and no
runs; repeated rows and null ids give one row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

EXPONENT = 4
LEAST = 6
BLOCK_WORDS = 1 << 19


def name_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word of several texts, equal words alike, and where each text begins. One empty
    place lies behind each text, so that the end of a text is never next to another one."""
    number: dict[bytes, int] = {}
    names = np.fromiter((number.setdefault(word, len(number)) for words in texts for word in (*words, None)), np.int64)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(words) + 1 for words in texts], out=begins[1:])
    return names, begins


def find_runs(names: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run, ordered by text, start and period; starts count
    from the beginning of the text."""
    sizes = np.diff(begins) - 1
    text_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    reach = (sizes // EXPONENT)[text_of]  # the longest period of the text
    ends = (begins[1:] - 1)[text_of]  # the empty place behind it
    # name of the stretch of L words from each place, -1 where it matters no more
    name = names.copy()
    name[begins[1:] - 1] = -1
    name[reach < 1] = -1
    found, length = [], 1
    while True:
        at = np.flatnonzero(name >= 0)
        if not len(at):
            break
        order = np.argsort(name[at], kind="stable")
        place, same = at[order], name[at][order]
        step = np.diff(place)
        step[(np.diff(same) != 0) | (text_of[place[1:]] != text_of[place[:-1]])] = np.iinfo(np.int64).max
        # distance to the next equal stretch, where that is a period of this level
        period = np.zeros(len(names) + 1, np.int64)
        taken = (step > length // 2) & (step <= length)
        period[place[:-1][taken]] = step[taken]
        change = np.flatnonzero(np.diff(period, prepend=0))
        first = change[period[change] > 0]
        after = change[np.searchsorted(change, first, side="right")]
        p = period[first]
        total = after - first - 1 + p + length
        long = total >= np.maximum(LEAST, EXPONENT * p)
        found.append(np.stack([text_of[first], first - begins[text_of[first]], total, p], axis=1)[long])
        # stretches that recur near enough may be halves of longer ones
        near = np.zeros(len(place), bool)
        close = step <= reach[place[:-1]]
        near[:-1] |= close
        near[1:] |= close
        alive = np.full(len(names) + 1, -1, np.int64)
        alive[place[near]] = np.cumsum(np.diff(same, prepend=-1) != 0)[near]
        # both halves, inside the text, and in texts that have room for a period above ``length``
        at = np.sort(place[near])
        at = at[(at + 2 * length <= ends[at]) & (reach[at] > length)]
        at = at[alive[at + length] >= 0]
        pair = alive[at] * (len(names) + 1) + alive[at + length]
        name = np.full(len(names), -1, np.int64)
        name[at] = np.unique(pair, return_inverse=True)[1]
        length *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when each run is cut down to its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(edge[:-1]) == 0


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of (doc_id, text): all runs by start and period, and
    the words that stay, joined by blanks. Words are what ASCII white space separates."""

    def block(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(*name_words(texts))
        bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
        collapsed = []
        for words, low, high in zip(texts, bounds, bounds[1:]):
            if high > low:
                keep = kept_words(len(words), runs[low:high])
                words = [word for word, stays in zip(words, keep) if stays]
            collapsed.append(b" ".join(words).decode())
        struct = pa.StructArray.from_arrays([pa.array(runs[:, i], pa.int64()) for i in (1, 2, 3)], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct)
        sizes = pa.array([len(words) for words in texts], pa.int64())
        return pa.RecordBatch.from_arrays([ids, sizes, lists, pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, texts = 0, 0, []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                words = (text or b"").split()
                if texts and size + len(words) > BLOCK_WORDS:
                    yield block(batch.column(0).slice(start, len(texts)), texts)
                    start, size, texts = i, 0, []
                size += len(words)
                texts.append(words)
            if texts:
                yield block(batch.column(0).slice(start, len(texts)), texts)

    doc_id = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    fields = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, f"{doc_id}, n_words bigint, {fields}")
