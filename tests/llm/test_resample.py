import hashlib
import math
import random
import re
import zlib
from collections import Counter

from textloom.llm import ngram_resample as nr

DOCS = "doc_id bigint, text string, rank string, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], DOCS)


def features(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def brute(docs, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s += features(text)[1]
    for text in target:
        t += features(text)[1]
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log(((t[b] + 1.0) * all_s) / ((s[b] + 1.0) * all_t))) for b in range(10000)}
    rows = []
    for doc_id, text in docs:
        n, f = features(text)
        weight = sum(gain[b] * c for b, c in f.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, sum(f.values()), weight, score, n >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    k = len(able) * percent // 100
    place = {id(r): i + 1 for i, r in enumerate(able[:k])}
    return sorted(((*r[:4], place.get(id(r))) for r in rows), key=str)


def drawn(spark, docs, target, **options):
    texts = spark.createDataFrame([(t, 0) for t in target], "text string, doc_id int")
    return sorted((tuple(r) for r in nr.resample(table(spark, docs), texts, **options).collect()), key=str)


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = ["the", "The", "été", "x-y", "data", "Spark,", "日本", "42", "o'clock"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(n)]


def test_against_brute_force(spark):
    docs, target = corpus(400), [t for _, t in corpus(20, 5)]
    assert drawn(spark, docs, target) == brute(docs, target)
    assert drawn(spark, docs, target, percent=60, least_words=5) == brute(docs, target, 60, 5)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 50}" for i in range(60))
    docs = [(1, None), (2, ""), (None, long), (None, long), (5, long), (5, long), (5, long), (6, "\x00 - ,"), (7, long + " é")] * 4
    assert drawn(spark, docs, ["w1 w2 w3", None, ""], percent=50) == brute(docs, ["w1 w2 w3", None, ""], 50)
    assert drawn(spark, docs, []) == brute(docs, [])
    assert drawn(spark, [], ["a"]) == []
    assert drawn(spark, [(1, "a b")], ["a"]) == brute([(1, "a b")], ["a"])


def test_long_texts_go_in_pieces(spark, monkeypatch):
    docs, target = corpus(30, 3), ["the data the data"]
    want = brute(docs, target)
    monkeypatch.setattr(nr, "PIECE_WORDS", 7)
    words = nr.words_of(docs[4][1].encode())
    assert Counter(x for part in nr.buckets_of(words) for x in part.tolist()) == features(docs[4][1])[1]
    monkeypatch.undo()
    assert drawn(spark, docs, target) == want
    text = "one two three " * 300_000
    assert drawn(spark, [(1, text)], target) == brute([(1, text)], target)


def test_kth_highest_narrows_down(spark):
    rng = random.Random(2)
    values = [rng.choice([-(10**12), 0, 5, 5, 6, 10**9, rng.randrange(-1000, 1000)]) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").cache()
    for k in (1, 2, 77, 150, 300):
        assert nr.kth_highest(rows, "v", k, bins=16) == sorted(values, reverse=True)[k - 1]
