import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import periodic_runs as pr
from textloom.llm.queries import with_planted_periods

DOCS = "doc_id bigint, text string, runs string, collapsed int"


def brute(words):
    """Maximal stretches with every period, then those with a smaller one left out."""
    n, found = len(words), {}
    for q in range(n // 4, 0, -1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q) and i > start:
                found[start, i - start + q] = q
            i = max(i, start + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words):
    gone = {i for start, length, q in brute(words) for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(texts):
    rows = pr.find_runs(*pr.name_words([[w.encode() for w in words] for words in texts])).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == i] for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=80), max_size=4))
def test_short_alphabets(texts):
    assert runs_of(texts) == [brute(words) for words in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_powers(parts):
    words = list("".join(word * n for word, n in parts))
    assert runs_of([words, words]) == [brute(words)] * 2


def test_long_periods():
    rng = random.Random(1)
    for period in (1, 2, 3, 31, 32, 33, 64, 65, 100):
        root = [str(rng.random()) for _ in range(period)]
        for total in (4 * period - 1, 4 * period, 4 * period + 1, 9 * period + 3):
            words = [str(rng.random()) for _ in range(7)] + [root[i % period] for i in range(total)] + ["end"]
            assert runs_of([words]) == [brute(words)]


def collected(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], DOCS)
    found = pr.collapse_runs(docs).collect()
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found), key=str)


def expected(rows):
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    cut = [(i, [w.decode() for w in words]) for i, words in cut]
    return sorted(((i, len(words), brute(words), collapsed(words)) for i, words in cut), key=str)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "  \t\x0b\n"), (None, "x " * 6), (None, "x " * 5), (4, "é b é b " * 5),
        (4, "a b a b a b a b a"), (4, "a b a b a b a b a"), (5, "a a a a a a a b " * 6), (6, "p q\x1fr " * 4),
    ]
    assert collected(spark, rows) == expected(rows)
    assert collected(spark, []) == []


def test_blocks_and_long_texts(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randrange(40)))) for i in range(200)]
    rows.append((900, " ".join(str(i % 50_000) for i in range(300_000))))
    got = collected(spark, rows)
    assert (900, 300_000, [(0, 300_000, 50_000)], " ".join(str(i) for i in range(50_000))) in got
    assert [r for r in got if r[0] != 900] == expected(rows[:-1])


def test_several_blocks_of_one_batch(monkeypatch):
    names, begins = pr.name_words([[b"a"] * 6, [], [b"a"] * 7])
    assert pr.find_runs(names, begins).tolist() == [[0, 0, 6, 1], [2, 0, 7, 1]]
    assert pr.kept_words(7, np.array([[0, 0, 6, 1]])).tolist() == [True] + [False] * 5 + [True]


def test_planted_periods(spark):
    docs = spark.createDataFrame([(i, "a b c d e f g h i j k l m n o p") for i in range(300)] + [(None, "a b"), (1, None)], "doc_id bigint, text string")
    rows = with_planted_periods(docs).collect()
    changed = {r["doc_id"] for r in rows if r["text"] not in (None, "a b", "a b c d e f g h i j k l m n o p")}
    assert len(rows) == 302 and 10 < len(changed) < 60 and None not in changed
