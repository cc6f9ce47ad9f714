import numpy as np

from fareflow.llm.neighbours import nearest, quantised


def run(spark, rows, **kw):
    table = spark.createDataFrame([(k, v, "clash") for k, v in rows], "vec_id long, embedding array<float>, rank string")
    found = nearest(table, lambda vec_id: vec_id % 5 == 0, k=4, **kw).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


def plain(rows):
    good = {(k, tuple(v)) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in sorted(good):
        if q % 5 == 0:
            scored = sorted((-float(np.sum(np.float64(v) * np.float64(w))), k) for k, w in good if k != q and len(w) == len(v))
            out += [(q, n, k, -s) for n, (s, k) in enumerate(scored[:4], 1)]
    return sorted(out)


def test_exact_over_many_tiles_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 8)).astype(np.float32)
    rows = [(k, base[k % 30 if k < 90 else 0].tolist()) for k in range(120)]
    rows += [(200, None), (205, []), (210, [0.0] * 8), (215, [float("nan")] * 8), (220, [None] + [1.0] * 7), (225, [1.0, 2.0]), (226, [2.0, 1.0]), (None, [1.0] * 8)]
    rows += rows[:3]
    for sizes in ({}, {"tile": 16, "query_tile": 4}):
        got, want = run(spark, rows, **sizes), plain(rows)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    assert run(spark, []) == []


def test_the_bound_holds():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 32)) * rng.lognormal(size=(200, 1))
    codes, (scale, near, rest) = quantised(x)
    about = (codes.astype(float) @ codes.T) * scale[:, None] * scale
    error = rest[:, None] * (near + rest) + near[:, None] * rest
    assert (np.abs(about - x @ x.T) <= error * (1 + 1e-9)).all()
