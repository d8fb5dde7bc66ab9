import json
import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.config import EvalConfig, SamplingConfig
from textloom.operators import batches, scores
from textloom.sources.reports import write_report


@pytest.mark.parametrize("rows,world,size,shuffle", [(23, 1, 4, False), (50, 3, 4, True), (5, 2, 4, True), (48, 4, 4, True)])
def test_epoch_plan(spark, rows, world, size, shuffle):
    seqs = spark.range(rows).withColumnRenamed("id", "seq_id")
    plan = batches.epoch_plan(seqs, size, world, shuffle, seed=5, epoch=2).collect()
    places = {(r.rank, r.batch_idx, r.slot) for r in plan}
    per_rank = [len(range(r, rows, world)) // size for r in range(world)]
    assert places == {(r, b, s) for r in range(world) for b in range(per_rank[r]) for s in range(size)}
    assert len({r.seq_id for r in plan}) == len(plan) == len(places)
    if not shuffle:
        assert all(r.seq_id == r.batch_idx * size + r.slot for r in plan)
    else:
        other = batches.epoch_plan(seqs, size, world, True, seed=5, epoch=3).collect()
        assert {tuple(r) for r in other} != {tuple(r) for r in plan} or not plan


def test_next_token_pairs(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([4],)], "t array<int>")
    pairs = batches.next_token_pairs(F.col("t"))
    assert [tuple(r) for r in df.select(*pairs).collect()] == [([1, 2], [2, 3]), ([], [])]


def test_batch_cap():
    assert [batches.batch_cap(b, 4, 8) for b in (0, 1, 32, 33)] == [1, 1, 1, 2]
    assert batches.batch_cap(10, 0, 8) == 10


def report(value):
    return json.dumps(value)


def test_macro_average(spark):
    rows = [
        (1, report({"results": {"a": {"acc": 0.2, "acc_norm,none": 0.4, "alias": "x"}, "b": {"acc,none": 0.6, "acc_norm": 1}}})),
        (2, report({"results": {"a": {"f1": 0.2}}})),
        (3, report({"skipped": True})),
        (4, report({"results": {"c": {"acc": 0.1}, "b": {"acc": 0.3}}})),
        (5, None),
    ]
    df = spark.createDataFrame(rows, "id int, report string")
    got = {r.id: r.macro_average for r in scores.macro_average(df, ("a", "b")).collect()}
    assert got[1] == pytest.approx(0.5) and got[4] == pytest.approx(0.3)
    assert got[2] is None and got[3] is None and got[5] is None


def test_perplexity(spark):
    losses = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 9.0)], "batch_idx int, loss double")
    assert scores.perplexity(losses, 60, 4, 8).first()[0] == pytest.approx(math.exp(1.5))
    assert scores.perplexity(losses, 0, 4, 8).first()[0] == pytest.approx(math.e)
    assert scores.perplexity(losses.limit(0), 60, 4, 8).first()[0] == 1.0
    assert scores.perplexity(None, 60, 4, 8).first()[0] is None


def test_sequence_scores_and_loss(spark):
    rng = random.Random(0)
    logit = {(s, p): [rng.uniform(-900, 900) for _ in range(5)] for s in range(3) for p in range(4)}
    label = {(s, p): -100 if (s == 2 or rng.random() < 0.3) else rng.randrange(5) for s in range(3) for p in range(4)}
    logits = spark.createDataFrame([(s, p, t, x) for (s, p), xs in logit.items() for t, x in enumerate(xs)], "seq int, pos int, token int, logit double")
    labels = spark.createDataFrame([(s, p, v) for (s, p), v in label.items()], "seq int, pos int, label int")
    expected, every = {}, []
    for s in range(3):
        expected[s] = 0.0
        for p in range(3):
            y, xs = label[s, p + 1], logit[s, p]
            if y != -100:
                peak = max(xs)
                lp = xs[y] - peak - math.log(sum(math.exp(x - peak) for x in xs))
                expected[s] += lp
                every.append(lp)
    got = {r.seq: r.logp for r in scores.sequence_scores(logits, labels).collect()}
    assert got == pytest.approx(expected)
    assert scores.cross_entropy(logits, labels).first()[0] == pytest.approx(-sum(every) / len(every))


def test_preference_loss_is_stable(spark):
    rows = [(1.0, 0.5, 0.2, 0.1), (-9000.0, 9000.0, 0.0, 0.0), (9000.0, -9000.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "chosen double, rejected double, ref_chosen double, ref_rejected double")
    margins = [0.1 * ((a - b) - (c - d)) for a, b, c, d in rows]
    expected = [max(-m, 0) + math.log1p(math.exp(-abs(m))) for m in margins]
    assert scores.preference_loss(df).first()[0] == pytest.approx(sum(expected) / 3)


def filtered(xs, cfg):
    """Temperature, top-k with ties, and top-p by hand."""
    xs = {t: x / cfg.temperature for t, x in xs.items()}
    if cfg.top_k:
        kth = sorted(xs.values(), reverse=True)[: cfg.top_k][-1]
        xs = {t: x for t, x in xs.items() if x >= kth}
    order = sorted(xs, key=lambda t: (-xs[t], t))
    total = sum(math.exp(xs[t]) for t in order)
    if cfg.top_p and cfg.top_p < 1:
        seen, kept = 0.0, []
        for t in order:
            if seen > cfg.top_p:
                break
            kept.append(t)
            seen += math.exp(xs[t]) / total
        order = kept
    total = sum(math.exp(xs[t]) for t in order)
    return {t: math.exp(xs[t]) / total for t in order}


@pytest.mark.parametrize(
    "cfg",
    [SamplingConfig(0.7, 0.9, 3), SamplingConfig(1.0, 0.5, 0), SamplingConfig(2.0, 1.0, 2), SamplingConfig(1.0, 0.0, 50), SamplingConfig(0.1, 0.1, 5)],
)
def test_candidates(spark, cfg):
    table = {1: [1.0, 2.0, 2.0, 2.0, 0.5], 2: [9.0, 0.0, 0.0, 1.0, 0.3], 3: [0.1, 0.2, 0.3, 0.4, 0.5]}
    df = spark.createDataFrame([(r, t, x) for r, xs in table.items() for t, x in enumerate(xs)], "row_id int, token int, logit double")
    got = {}
    for r in scores.candidates(df, cfg).collect():
        got.setdefault(r.row_id, {})[r.token] = r.prob
    assert got.keys() == table.keys()
    for row, xs in table.items():
        assert got[row] == pytest.approx(filtered(dict(enumerate(xs)), cfg))
    drawn = scores.draw(scores.candidates(df, cfg)).collect()
    assert sorted(r.row_id for r in drawn) == [1, 2, 3] and all(r.token in got[r.row_id] for r in drawn)


def test_greedy_and_draw_frequencies(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (1, 2, 3.0)], "row_id int, token int, logit double")
    assert [tuple(r) for r in scores.candidates(df, SamplingConfig(0.0)).collect()] == [(1, 1, 1.0)]
    many = spark.range(2000).select(F.col("id").alias("row_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("token"))
    many = many.withColumn("prob", F.when(F.col("token") == 0, 0.25).otherwise(0.75))
    share = scores.draw(many).filter("token = 0").count() / 2000
    assert 0.2 < share < 0.3


def test_evaluation_report_file(spark, tmp_path):
    cfg = EvalConfig(tasks=("a",))
    result = {"results": {"a": {"acc": 0.25, "n": 3}}, "config": {"limit": None, "seeds": [1, 2]}, "versions": {"a": 1}}
    df = spark.createDataFrame([(report(result),)], "report string")
    path = str(tmp_path / "deep" / "report")
    write_report(scores.evaluation_report("m", df, scores.perplexity(None, 1, 1, 1), cfg), path)
    record = json.loads(spark.read.text(path, wholetext=True).first()[0])
    assert record["model"] == "m" and record["tasks"] == ["a"] and record["macro_average"] == 0.25
    assert record["val_perplexity"] is None and record["lm_eval"] == result
    skipped = spark.createDataFrame([(report({"skipped": True}),)], "report string")
    text = scores.evaluation_report("m", skipped, scores.perplexity(None, 1, 1, 1), cfg).first()[0]
    assert json.loads(text)["lm_eval"] == {"skipped": True} and json.loads(text)["macro_average"] is None


def test_scores_that_are_no_numbers_or_missing_fail(spark):
    df = spark.createDataFrame([(report({"results": {"a": {"acc_norm": "high", "acc": 0.2}}}),)], "report string")
    with pytest.raises(Exception, match="not a number"):
        scores.macro_average(df, ("a",)).collect()
    logits = spark.createDataFrame([(1, 0, 0, 0.5), (1, 0, 1, 0.1)], "seq int, pos int, token int, logit double")
    labels = spark.createDataFrame([(1, 0, 5), (1, 1, 7)], "seq int, pos int, label int")
    with pytest.raises(Exception, match="no score for the label"):
        scores.cross_entropy(logits, labels).collect()


def exchanges(df):
    """What the shuffles of a plan carry, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line], plan


def test_the_epoch_permutation_is_one_and_needs_no_shuffle(spark):
    for n in (1, 2, 3, 7, 16, 17, 100, 999):
        ids = spark.range(n).withColumnRenamed("id", "seq_id")
        places = [r[0] for r in ids.select(batches.permutation(F.col("seq_id"), n, "1:0")).collect()]
        assert sorted(places) == list(range(n))
    ids = spark.range(999).withColumnRenamed("id", "seq_id")
    plan = batches.epoch_plan(ids, 8, 3, True, seed=5, epoch=2, total=999)
    assert not exchanges(plan)[0] and "Sort" not in exchanges(plan)[1]
    numbered = batches.epoch_plan(ids, 8, 3, True, seed=5, epoch=2)
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, numbered.collect()))
    other = [r[0] for r in ids.select(batches.permutation(F.col("seq_id"), 999, "1:1")).collect()]
    assert sum(a == b for a, b in zip(places, other)) < 20


def test_scores_stay_where_they_are(spark):
    rng = random.Random(1)
    rows = [(s, p, t, rng.choice([rng.uniform(-50, 50), -math.inf]) if t else 1.0) for s in range(20) for p in range(4) for t in range(30)]
    logits = spark.createDataFrame(rows, "seq int, pos int, token int, logit double")
    labels = spark.createDataFrame([(s, p, 0) for s in range(20) for p in range(4)], "seq int, pos int, label int")
    sent = scores.label_log_probs(logits, labels)
    assert all("logit" not in line and "token" not in line for line in exchanges(sent)[0])
    dealt = scores.label_log_probs(logits, labels, broadcast_rows=0)
    key = lambda r: (r.seq, r.pos)
    for a, b in zip(sorted(sent.collect(), key=key), sorted(dealt.collect(), key=key)):
        xs = [x for s, p, _, x in rows if (s, p) == (a.seq, a.pos)]
        assert a.logp == pytest.approx(b.logp) == pytest.approx(1.0 - math.log(sum(math.exp(x) for x in xs)))


@pytest.mark.parametrize("top_p", [0.05, 0.5, 0.9, 0.999])
def test_nucleus_equals_the_sorted_way(spark, top_p):
    rng = random.Random(2)
    rows = [(r, t, rng.choice([round(rng.gauss(0, 3), 1), 2.0])) for r in range(20) for t in range(200)]
    df = spark.createDataFrame(rows + [(99, 0, -math.inf), (99, 1, 0.0)], "row_id int, token int, logit double")
    cfg = SamplingConfig(0.8, top_p, 0)
    for limit in (10**6, 0):
        got = {}
        for r in scores.nucleus(df, cfg, broadcast_rows=limit).collect():
            got.setdefault(r.row_id, {})[r.token] = r.prob
        assert got.pop(99) == {1: 1.0}
        for row in range(20):
            assert got[row] == pytest.approx(filtered({t: x for r, t, x in rows if r == row}, cfg))
