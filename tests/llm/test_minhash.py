import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import minhash as mh

CFG = mh.NearDupConfig()


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def runs(text):
    w = text.lower().split()
    if not w:
        return {}
    if len(w) < 5:
        return {tuple(w): 1}
    out = {}
    for i in range(len(w) - 4):
        out[tuple(w[i : i + 5])] = out.get(tuple(w[i : i + 5]), 0) + 1
    return out


def jaccard(x, y):
    keys = set(x) | set(y)
    total = 0.0
    for i in set(x) & set(y):
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys)
    return total


def brute_classes(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, runs(t or "")) for i, t in rows]
    for (i, x), (j, y) in itertools.combinations(sets, 2):
        if x and y and jaccard(x, y) >= CFG.threshold:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i, _ in rows}


def corpus():
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = words(rng, rng.choice([3, 12, 60, 200]))
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            rows.append(" ".join(copy))
    rows += ["same short", "Same  SHORT", "", None, "a b c d e " * 40, "a b c d e " * 80, "one"]
    return list(enumerate(rows))


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("clash")).withColumn("sig", F.lit(1))
    got = {r["doc_id"]: r["class_id"] for r in mh.near_duplicate_classes(docs).collect()}
    assert got == brute_classes(rows)


def test_chain_joins_one_class(spark):
    rng = random.Random(1)
    base = words(rng, 400)
    rows = []
    for i in range(6):
        # each differs from the one before in a stretch of its own; the ends are below the threshold
        copy = list(base)
        for j in range(i):
            copy[j * 40 : j * 40 + 30] = [f"y{j}.{k}" for k in range(30)]
        rows.append((i, " ".join(c.replace(".", "z") for c in copy)))
    got = mh.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == want


def test_estimate_is_the_probability_jaccard():
    text = " ".join(f"t{i % 90}" for i in range(400))
    other = " ".join(f"t{i % 90}" for i in range(330)) + " " + " ".join(f"q{i}" for i in range(40))
    h, c, n, _ = mh.weighted_runs([text, other], 5)
    sig = mh.signatures(h, c, n, 4000)
    want = mh.probability_jaccard(h[: n[0]], c[: n[0]], h[n[0] :], c[n[0] :])
    assert abs(want - jaccard(runs(text), runs(other))) < 1e-9
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_signature_does_not_depend_on_the_batch():
    texts = [" ".join(words(random.Random(i), 5 + 7 * i)) for i in range(20)]
    h, c, n, _ = mh.weighted_runs(texts, 5)
    together = mh.signatures(h, c, n, CFG.registers)
    for i, text in enumerate(texts):
        alone = mh.signatures(*mh.weighted_runs([text], 5)[:3], CFG.registers)
        assert np.array_equal(alone[0], together[i])


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert mh.near_duplicate_classes(empty).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (4, "A b, c d e f!"), (9, None), (None, "zz")]
    got = mh.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["class_id"]) for r in got if r["doc_id"] is not None) == [
        (False, 1, 1), (False, 1, 1), (False, 4, 1), (False, 9, 9)]
    assert len(got) == 5


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in mh.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_bounds_hold_and_variants_are_classed_like_brute_force(spark):
    rng = random.Random(8)
    base = words(rng, 120)
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice([f"z{rng.randrange(9999)}", copy[0]])
        rows.append((i, " ".join(copy + (copy[:30] if i % 9 == 0 else []))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in mh.near_duplicate_classes(docs).collect()}
    assert got == brute_classes(rows)
    sets = mh.run_sets(docs, docs.select(F.col("doc_id").alias("node")), CFG)
    found, rare = mh.shared_runs(sets, sets.select("node", F.col("node").alias("root")), mh.NearDupConfig(threshold=0.0))
    stats = {r["node"]: r["stats"] for r in found.collect()}
    met = {(r["a"], r["b"]) for r in rare.collect()}
    kind = "struct<total bigint, own bigint, most int, many int, shared bigint>"
    rows_of = [(stats[a], stats[b], a, b) for a, b in itertools.combinations(range(70), 2) if (a, b) not in met]
    pairs = spark.createDataFrame(rows_of, f"x {kind}, y {kind}, a int, b int")
    bounds = pairs.select("a", "b", F.least(mh.most_similar(F.col("x"), F.col("y")), mh.most_similar(F.col("y"), F.col("x"))).alias("most"))
    texts = {i: runs(t) for i, t in rows}
    for r in bounds.collect():
        assert jaccard(texts[r["a"]], texts[r["b"]]) <= r["most"] + 1e-9
    # pairs left to the bounds have no rare run in common
    count = {}
    for t in texts.values():
        for run in t:
            count[run] = count.get(run, 0) + 1
    assert met == {(a, b) for a, b in itertools.combinations(range(70), 2) if any(count[r] <= mh.RARE for r in set(texts[a]) & set(texts[b]))}


def test_missing_and_repeated_ids_are_judged_by_their_texts(spark):
    base = words(random.Random(1), 80)
    near = [*base[:-1], "other"]
    rows = [
        (None, " ".join(base), "a"), (None, " ".join(base), "b"), (7, " ".join(near), "c"), (5, " ".join(base).upper(), "d"),
        (None, "alone without id", "e"), (None, "alone  without id", "f"), (3, "one text of this id", "g"),
        (3, "a second and quite different text of it", "h"), (3, "one text of this id", "i"), (None, None, "j"), (8, "", "k"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, node string")
    got = sorted((r["doc_id"] or -1, r["class_id"] or -1) for r in mh.near_duplicate_classes(docs).collect())
    assert got == sorted([(-1, 5), (-1, 5), (7, 5), (5, 5), (-1, -1), (-1, -1), (3, 3), (3, 3), (3, 3), (-1, -1), (8, 8)])
    kept = mh.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    kept = [(r["doc_id"], (r["text"] or "").split()[:1]) for r in kept.collect()]
    assert sorted(kept, key=str) == sorted([(5, [base[0].upper()]), (None, ["alone"]), (3, ["one"]), (3, ["a"]), (None, []), (8, [])], key=str)
    assert mh.without_near_duplicates(docs.limit(0)).collect() == []
