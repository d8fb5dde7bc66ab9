import numpy as np
import pytest

from textloom.llm import pivot_index, posting_lists, vectors

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)


def sample(n=700, seed=3):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, 16))
    points[200:400] = points[7]  # one vector many times
    return [(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)]


def brute(rows, value, k=20, usable=lambda v: True):
    good = [(i, [value(x) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and usable(v)]
    out = {}
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def collect(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_exact_search_equals_brute_force(spark):
    rows = sample() + [(1000, None), (1020, [float("nan")] * 16), (1040, []), (1060, [None] + [0.1] * 15), (1080, [0.0] * 16)]
    got = collect(pivot_index.search(table(spark, rows)))
    assert got == brute(rows, lambda x: int(np.floor(64 * x)))


def test_posting_lists_recall(spark):
    rows = sample(1500) + [(2000, None), (2020, [0.0] * 16), (2040, [float("inf")] * 16)]
    got = collect(posting_lists.search(table(spark, rows)))
    want = brute(rows, float, usable=lambda v: any(v))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    for q in got:
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        for i, s in got[q]:
            assert abs(exact.get((q, i), s) - s) < 1e-12
    # query 0's list holds the smallest ids among equal vectors
    assert got[0][0][1] >= got[0][-1][1]


@pytest.mark.parametrize("search", [pivot_index.search, posting_lists.search])
def test_few_rows_and_empty_tables(spark, search):
    assert search(table(spark, [])).collect() == []
    got = collect(search(table(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [0.5, 0.5]), (7, [0.5, 0.5])])))
    assert [i for i, _ in got[0]] == [5, 7]


def test_large_lists_are_dealt_over_groups(spark, monkeypatch):
    rows = sample(900)
    want = collect(pivot_index.search(table(spark, rows)))
    monkeypatch.setattr(vectors, "GROUP_VECTORS", 50)
    monkeypatch.setattr(vectors, "GROUP_QUERIES", 3)
    assert collect(pivot_index.search(table(spark, rows))) == want


def test_walk_finds_the_nearest_centroid():
    rng = np.random.default_rng(0)
    data = rng.normal(size=(4000, 24))
    index = posting_lists.build(data, 128, float((data**2).sum(axis=1).max()))
    points = posting_lists.lifted(data[:300], index.length)
    apart = posting_lists.squared(points, index.points)
    assert (posting_lists.walk(index, points).argmin(axis=1) == apart.argmin(axis=1)).mean() > 0.97


def test_queries_read_every_list_in_reach_of_hundreds(spark, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    data = rng.normal(size=(60, 48))[rng.integers(0, 60, 6000)] + 0.6 * rng.normal(size=(6000, 48))
    data = data.astype(np.float32).astype(np.float64)
    index = posting_lists.build(data, 375, float((data**2).sum(axis=1).max()) * (1 + 1e-9))
    asking = pa.record_batch([pa.array(range(0, 6000, 20)), pa.array(data[::20].tolist())], ["query_id", "q"])
    shared = type("Shared", (), {"value": index})
    reach = posting_lists.fitted_reach(index, data, 20)
    apart = np.sqrt(posting_lists.squared(np.pad(data[::20], ((0, 0), (0, 1))), index.points))
    for ratio in (0.02, reach):
        lists = pa.Table.from_batches(posting_lists._lists_of(shared, ratio)(iter([asking])))
        row, which = np.nonzero(apart <= apart.min(axis=1, keepdims=True) * (1 + ratio))
        assert set(zip(lists["query_id"].to_pylist(), lists["list"].to_pylist())) == set(zip((row * 20).tolist(), which.tolist()))

    build = posting_lists.build
    monkeypatch.setattr(posting_lists, "build", lambda sample, lists, length: build(sample, 375, length))
    got = collect(posting_lists.search(table(spark, [(i, x.tolist()) for i, x in enumerate(data)])))
    scores = data[::20] @ data.T
    scores[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    recall = sum(len({i for i, _ in got[q * 20]} & set(best[q].tolist())) for q in range(300)) / best.size
    print("recall", recall, "lists read", len(row) / 300)
    assert recall >= 0.9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors_with_many_lists(spark, monkeypatch, sf):
    given = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    seen = []
    build = posting_lists.build
    monkeypatch.setattr(posting_lists, "build", lambda sample, lists, length: seen.append(lists) or build(sample, lists, length))
    got = collect(posting_lists.search(given))
    want = brute([(r["vec_id"], r["embedding"]) for r in given.collect()], float, usable=lambda v: any(v))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    share = hits / sum(map(len, want.values()))
    print(sf, "lists", seen, "recall", share)
    assert seen[0] >= 16 and share >= 0.9


def test_recall_on_fifty_thousand_vectors():
    rng = np.random.default_rng(4)
    data = rng.normal(size=(200, 48))[rng.integers(0, 200, 50_000)] + 0.5 * rng.normal(size=(50_000, 48))
    sample = data[rng.permutation(50_000)[: posting_lists.SAMPLE]]
    index = posting_lists.build(sample, int(50_000**0.5), float((data**2).sum(axis=1).max()) * (1 + 1e-9))
    reach = posting_lists.fitted_reach(index, sample, 20)
    homes = np.concatenate([posting_lists.written(index, data[i : i + 512])[1] for i in range(0, 50_000, 512)])
    asked = data[:50_000:500]
    apart = posting_lists.within(index, np.pad(asked, ((0, 0), (0, 1))), reach)
    reads = apart <= apart.min(axis=1, keepdims=True) * (1 + reach)
    found = reads.astype(int) @ homes.T.astype(int) > 0
    scores = asked @ data.T
    scores[np.arange(100), np.arange(0, 50_000, 500)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    recall = np.take_along_axis(found, best, axis=1).mean()
    print("recall", recall, "share of vectors read", found.mean())
    assert recall >= 0.9 and found.mean() < 1


@pytest.mark.parametrize("kind", ["apart", "shorter"])
def test_recall_of_queries_unlike_the_other_vectors(spark, kind):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(3000, 64))
    if kind == "apart":
        data[::20] = 0.2 * rng.normal(size=(150, 64)) + 3 * rng.normal(size=64)
    else:
        data[::20] *= 0.1
    data = data.astype(np.float32).astype(np.float64)
    got = collect(posting_lists.search(table(spark, [(i, x.tolist()) for i, x in enumerate(data)])))
    scores = data[::20] @ data.T
    scores[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    recall = sum(len({i for i, _ in got[q * 20]} & set(best[q].tolist())) for q in range(150)) / best.size
    print(kind, "recall", recall)
    assert recall >= 0.9
