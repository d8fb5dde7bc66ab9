import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import language_mix as lm

SCHEMA = "doc_id bigint, text string, lang string, score string"


def texts(spark, n=400):
    rng = random.Random(3)
    kinds = {"xx": ["kala", "moro", "tinu", "pelo"], "yy": ["strk", "vlt", "zbrn", "grmt"], "zz": ["ouea", "iaou", "eeao", "uoia"]}
    rows = []
    for i in range(n):
        name = rng.choice(list(kinds))
        rows.append((i, " ".join("".join(rng.sample(kinds[name], 2)) for _ in range(60)), name, "clash"))
    return spark.createDataFrame(rows, SCHEMA), kinds


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").filter("held_out")
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.95
    assert got.filter("score < 0 or score > 1").count() == 0


def test_held_out_rule(spark):
    import zlib

    rows = lm.identify(texts(spark)[0]).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_mixtures_are_inferred(spark):
    docs, kinds = texts(spark)
    model = lm.train(docs)
    assert model.names == ("xx", "yy", "zz")
    rng = random.Random(9)
    part = lambda k, n: " ".join("".join(rng.sample(kinds[k], 2)) for _ in range(n))
    names, score = lm.predict_texts([part("xx", 120) + " " + part("yy", 40), part("zz", 80)], model)
    assert names == ["xx", "zz"]
    assert abs(score[0] - 0.75) < 0.05 and score[1] > 0.99


def test_prediction_reads_the_text_only(spark):
    docs, _ = texts(spark)
    model = lm.train(docs)
    other = docs.withColumn("lang", F.lit("qq")).withColumn("doc_id", F.col("doc_id") + 1000)
    want = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in lm.predict(docs, model).collect())
    got = sorted((r["doc_id"] - 1000, r["lang_pred"], r["score"]) for r in lm.predict(other, model).collect())
    assert got == want


def test_odd_rows(spark):
    docs, _ = texts(spark, 60)
    odd = spark.createDataFrame([(1001, None, "xx", "c"), (1002, "", None, "c"), (1002, "12 34 --", "xx", "c"), (None, "kala " * 50_000, None, "c")], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in lm.identify(docs.unionByName(odd)).collect())
    assert [x[1:] for x in got if x[0] > 1000] == [("und", 0.0)] * 3
    assert got[0][1] in ("xx", "yy", "zz")
    assert lm.identify(odd.limit(0)).collect() == []
    unlabelled = lm.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


def test_keep_identified(spark):
    docs, _ = texts(spark, 90)
    odd = spark.createDataFrame([(None, "kala moro tinu " * 30, "yy", "c"), (7777, "", "xx", "c")], SCHEMA)
    kept = lm.keep_identified(docs.unionByName(odd), lm.train(docs), 0.5).collect()
    assert len(kept) == 91
    assert [r["lang"] for r in kept if r["doc_id"] is None] == ["xx"]


def plain_fit(units, names):
    """Proportions and log-likelihood of one text by loops; ``units`` holds a dict of likelihoods per unit."""
    theta = {k: 1 / len(names) for k in names}
    for _ in range(lm.ROUNDS):
        parts = dict.fromkeys(names, 0.0)
        for unit in units:
            total = sum(theta[k] * unit[k] for k in names)
            for k in names:
                parts[k] += theta[k] * unit[k] / total
        theta = {k: parts[k] / len(units) for k in names}
    return theta, sum(math.log(sum(theta[k] * unit[k] for k in names)) for unit in units)


def plain_best(units, n):
    """The best penalised likelihood over every set of languages, its proportions and that of each set."""
    penalty = lm.SET_PENALTY + 0.5 * math.log(len(units))
    found = {}
    for size in range(1, n + 1):
        for names in itertools.combinations(range(n), size):
            theta, total = plain_fit(units, names)
            found[names] = (total - penalty * size, theta)
    best = max(found, key=lambda k: found[k][0])
    return found[best][1], found


def test_selected_sets_are_the_best_of_all():
    rng = np.random.default_rng(6)
    texts = []
    for n_units, shares in [(1, [1, 0, 0, 0]), (30, [1, 0, 0, 0]), (40, [0.6, 0.4, 0, 0]), (60, [0.5, 0, 0.3, 0.2]),
                            (25, [0, 0, 0.2, 0.8]), (80, [0.25, 0.25, 0.25, 0.25]), (3, [0, 1, 0, 0])]:
        written = rng.choice(4, n_units, p=shares)
        log = rng.normal(-60, 2, (n_units, 4))
        log[np.arange(n_units), written] += rng.uniform(3, 14, n_units)
        texts.append(log)
    size = np.array([len(x) for x in texts])
    theta = lm.proportions(np.concatenate(texts), np.cumsum(size) - size, size)
    for got, log in zip(theta, texts):
        units = [dict(enumerate(np.exp(row - row.max()))) for row in log]
        want, _ = plain_best(units, 4)
        assert {k for k in range(4) if got[k] > 0} == {k for k in want if want[k] > 0}
        assert all(abs(got[k] - want.get(k, 0.0)) < 1e-9 for k in range(4))


def test_predictions_equal_trigram_sums_by_loops(spark):
    docs, kinds = texts(spark, 120)
    model = lm.train(docs)
    rng = random.Random(8)
    part = lambda k, n: " ".join("".join(rng.sample(kinds[k], 2)) for _ in range(n))
    asked = [part("xx", 30), part("yy", 17) + ", 12 " + part("zz", 30), "kala", part("zz", 40) + " " + part("xx", 9)]
    got, score = lm.predict_texts(asked, model)
    for text, name, s in zip(asked, got, score):
        words = "".join(c if c.isalpha() else " " for c in text).split()
        units = []
        for i in range(0, len(words), lm.UNIT_WORDS):
            bucket = lm.trigrams([" ".join(words[i : i + lm.UNIT_WORDS])])[0]
            log = [sum(float(row[b]) for b in bucket) for row in model.log_p]
            units.append({k: math.exp(x - max(log)) for k, x in enumerate(log)})
        theta, _ = plain_best(units, len(model.names))
        best = max(theta, key=lambda k: theta[k])
        assert name == model.names[best] and abs(s - theta[best]) < 1e-6


def test_samples_are_bounded_despite_missing_ids(spark):
    rows = [(None, f"kala moro {i}", "xx", "c") for i in range(300)] + [(None, "same", "xx", "c")] * 300
    docs = spark.createDataFrame(rows + [(i, f"vlt {i}", "yy", "c") for i in range(5)], SCHEMA)
    model = lm.train(docs, per_language=20)
    assert model.names == ("xx", "yy")
    # of "xx" 20 different documents were counted, each with the letters of "kala moro" (or "same")
    lines = lm.train(docs.filter("text <> 'same'"), per_language=20).log_p
    counted = (lm.SMOOTHING / np.exp(lines[0].min()) - lm.SMOOTHING * lm.BUCKETS) / 8
    assert abs(counted - 20) < 0.6
