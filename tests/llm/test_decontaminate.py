import random
import re

from textloom.llm import decontaminate as dc

DOCS = "doc_id bigint, text string, items string, n_words int"
ITEMS = "item_id bigint, text string, doc_id string"
WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def table(spark, rows, schema, *clash):
    return spark.createDataFrame([(*row, *clash) for row in rows], schema)


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        places = [m.span() for m in WORD.finditer(text or "")]
        words = [lower((text or "")[a:b]) for a, b in places]
        hit, named = set(), set()
        for item, passage in items:
            other = [lower(m[0]) for m in WORD.finditer(passage or "")]
            n = min(window, len(other))
            for j in range(len(other) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == other[j : j + n]:
                        hit |= set(range(i, i + n))
                        named |= {str(item)} - {"None"}
        # a stretch of hit words from its first to its last character
        starts = [i for i in sorted(hit) if i - 1 not in hit]
        ends = [i for i in sorted(hit) if i + 1 not in hit]
        spans = [(places[a][0], places[b][1]) for a, b in zip(starts, ends)]
        out.append((doc_id, len(words), len(hit), sorted(named), spans))
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    rows = dc.find(table(spark, docs, DOCS, "clash", 3), table(spark, items, ITEMS, "clash"), **options).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]]) for r in rows), key=str)


def random_tables(seed):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "ÀÉ", "x1", "日本", "the"]
    gaps = [" ", ", ", "\n", "--", "_", "' "]
    text = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    items = [(i, text(rng.randrange(0, 14))) for i in range(12)]
    docs = [(i, text(rng.randrange(0, 30)) + rng.choice(items)[1].upper().replace(" ", " / ") + text(5)) for i in range(60)]
    return docs, items


def test_against_brute_force(spark):
    for seed in range(3):
        docs, items = random_tables(seed)
        assert found(spark, docs, items, window=4) == brute(docs, items, 4)
    docs, items = random_tables(9)
    assert found(spark, docs, items) == brute(docs, items)


def test_several_automata_give_the_same(spark):
    docs, items = random_tables(4)
    assert found(spark, docs, items, window=3, pattern_chars=60) == brute(docs, items, 3)


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (None, f"-- {passage.upper()}!"), (4, passage), (4, passage), (5, "one two"), (6, "\U0001f600 Short Item.")]
    items = [(7, passage), (7, "short item"), (None, "one two"), (8, None), (9, ""), (10, passage), (10, passage)]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert (5, 2, 2, [], [(0, 7)]) in got and (6, 3, 2, ["7"], [(2, 12)]) in got
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == brute(docs, [])


def test_very_long_text(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    text = "filler words here " * 100_000 + passage
    assert found(spark, [(1, text)], [(3, passage)]) == [(1, 300_040, 40, ["3"], [(len(text) - len(passage), len(text))])]


def test_stretches_touch_and_overlap():
    assert dc.merged([(5, 8), (0, 2), (2, 4), (6, 7)]) == [(0, 4), (5, 8)]
