import numpy as np

from marketlens.llm import learned_ann as ann

SCHEMA = "vec_id long, embedding array<float>, label int, part string"


def brute(rows, every, top=20):
    """{query: [(vec_id, score)]}, nearest first, ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        s = (x * x[k]).sum(axis=1)
        others = np.flatnonzero(ids != ids[k])
        best = others[np.lexsort((ids[others], -s[others]))[:top]]
        out[int(ids[k])] = [(int(ids[j]), float(s[j])) for j in best]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def _df(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "p")
                                  for i, v in rows], SCHEMA)


def test_one_part_is_exact_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(1, 120)]
    good += [(200 + i, good[0][1]) for i in range(40)]                 # one vector forty times more
    bad = [(300, None), (320, [0.0] * 8), (340, [None] + [1.0] * 7), (360, [float("nan")] * 8),
           (380, [float("inf")] * 8), (400, [1.0] * 3), (None, [1.0] * 8)]
    got = _found(ann.search(_df(spark, good + bad + [good[19]]), every=20))    # and one row twice
    want = brute(good, 20)
    assert {q: [v for v, _ in r] for q, r in got.items()} == {q: [v for v, _ in r] for q, r in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_fewer_rows_than_wanted_and_empty_table(spark):
    got = _found(ann.search(_df(spark, [(0, [1, 0]), (1, [0, 1]), (2, [1, 1])]), every=20))
    assert got == {0: [(2, 1.0), (1, 0.0)]}
    assert ann.search(_df(spark, []), every=20).count() == 0


def test_recall_of_routed_search(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 500)
    monkeypatch.setattr(ann, "LEAST_PARTS", 8)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 300)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.25 * rng.normal(size=(4000, 16))
    x[:1300] = x[0]                                                    # a third are copies
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    df = _df(spark, rows)
    v = ann.usable(df)
    router = ann.fit(v, v.count())
    assert len(router.b2) == 8 and router.visits < 8                  # parts are skipped
    got, want = _found(ann.search(df, every=20)), brute(rows, 20)
    assert set(got) == set(want)
    recall = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9


def test_parts_are_balanced(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1000, 8))
    label = ann.balanced_parts(ann.neighbour_graph(x, 10), 8)
    assert sorted(np.bincount(label).tolist()) == [125] * 8


def test_recall_and_skipped_parts_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    v = ann.usable(df)
    router = ann.fit(v, v.count())
    assert len(router.b2) == ann.LEAST_PARTS and router.visits < ann.LEAST_PARTS      # parts are skipped
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got, want = _found(ann.search(df, every=20)), brute(rows, 20)
    recall = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / len(want[q]) for q in want])
    assert set(got) == set(want) and recall >= 0.9
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    queries = np.flatnonzero(ids % 20 == 0)
    place = {int(i): k for k, i in enumerate(ids)}
    near = np.array([[place[i] for i, _ in want[int(ids[q])]] for q in queries])
    curve = ann.held_out_shares(router, x, x[queries], near)
    print("visits", router.visits, "recall", recall, "by parts visited", curve.round(3).tolist())
    assert abs(curve[router.visits - 1] - recall) < 0.005 and np.all(np.diff(curve) >= 0)


def test_copies_do_not_thin_the_sample_and_doubles_stay_doubles(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 6))
    x = np.concatenate([x, np.repeat(x[:1], 3000, axis=0)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    v = ann.usable(df)
    assert len(ann.fit(v, v.count()).b2) == ann.LEAST_PARTS
    row = ann.search(df, every=3400 // 2).filter("query_id = 0 and rank = 1").first()
    assert row.vec_id == 400 or row.score > float((x[0] * x[0]).sum()) - 1e-9


def test_a_graph_in_tasks_is_the_graph(spark, monkeypatch):
    monkeypatch.setattr(ann, "TASK_PRODUCTS", 20_000)
    x = np.random.default_rng(4).normal(size=(500, 8))
    s = x @ x[:400].T
    s[np.arange(400), np.arange(400)] = -np.inf
    want = np.argsort(-s, axis=1)[:, :7]
    assert (ann.sample_graph(spark, x, 7, 400) == want).all()
