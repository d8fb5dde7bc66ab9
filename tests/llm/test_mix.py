import random

import numpy as np

from textloom.llm import pivotal_mix as pm

SCHEMA = "doc_id bigint, text string, source string, size string, copies int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 7) for i, t, s in rows], SCHEMA)


def targets(sizes):
    """Share out by weight, cap, and share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, out = sum(sizes.values()), {s: 0.0 for s in order}
    open_ones, left = [s for s in order if sizes[s]], float(total)
    while open_ones:
        share = {s: left * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        over = [s for s in open_ones if share[s] > 3 * sizes[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ones = [s for s in open_ones if s not in over]
    return out


def corpus(n=3000):
    rng = random.Random(6)
    names = ["a", "b", "c", "d", "é", None]
    return [(i, " ".join("w" * rng.randrange(1, 40)), "a" if i % 3 == 0 else rng.choice(names)) for i in range(n)]


def check(rows, got):
    size_of = lambda t: len((t or "").split())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    want, taken = targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    largest = max(r["size"] for r in got)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest + 1e-6


def test_targets_are_met(spark):
    rows = corpus()
    check(rows, pm.mix(table(spark, rows)).collect())


def test_the_tree_has_several_levels(spark, monkeypatch):
    monkeypatch.setattr(pm, "GROUP_ROWS", 20)
    monkeypatch.setattr(pm, "FAN_IN", 4)
    rows = corpus(1500)
    check(rows, pm.mix(table(spark, rows)).collect())


def test_small_sources_stop_at_three_times(spark):
    rows = [(i, "w " * 10, "b") for i in range(100)] + [(500, "w w", "a"), (501, "w", None)]
    got = pm.mix(table(spark, rows)).collect()
    check(rows, got)
    assert {r["copies"] for r in got if r["source"] in ("a", None)} == {3}


def test_reruns_agree(spark):
    rows = corpus(800)
    key = lambda r: r["doc_id"]
    assert sorted(pm.mix(table(spark, rows)).collect(), key=key) == sorted(pm.mix(table(spark, rows[::-1])).collect(), key=key)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (2, "x y", "a"), (2, "x y", "a"), (None, "p q", "b"), (3, "\t\x0b \n", None)]
    got = pm.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert pm.mix(table(spark, [])).collect() == []
    assert {r["target"] for r in pm.mix(table(spark, [(1, "", "a"), (2, None, "b")])).collect()} == {0.0}


def test_mixed_documents_repeat_rows(spark):
    rows = corpus(600) + [(None, "p q r", "a")]
    docs = table(spark, rows)
    copies = {r["doc_id"]: r["copies"] for r in pm.mix(docs).collect()}
    mixed = pm.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}
    assert {r["size"] for r in mixed.select("size").distinct().collect()} == {"clash"}


def test_rounding_keeps_sums_and_expectations():
    rng = np.random.default_rng(0)
    weight, share = rng.integers(1, 50, 40).astype(float), rng.random(40)
    total = np.zeros(40)
    for i in range(4000):
        out, at, rest = pm.round_pairs(weight, share, rng.random(40))
        value = out.astype(float)
        if at >= 0:
            value[at] = rest
        assert abs((weight * value).sum() - (weight * share).sum()) < 1e-6
        total += value
    assert np.abs(total / 4000 - share).max() < 0.04
