import numpy as np

from bronzegate.llm import embedding_dedup
from tests.llm.brute import Union


def brute(rows):
    good = {i: np.array(v, np.float32).astype(float) for i, v, l in rows
            if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: l for i, _, l in rows}
    u, links = Union(), dict.fromkeys(label, 0)
    for i in good:
        for j in good:
            if i < j and label[i] == label[j] and len(good[i]) == len(good[j]):
                a, b = good[i], good[j]
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    u.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return {i: (links[i], u.find(i)) for i in label}


def test_links_and_components(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(24)
    rows = [(i, (centre + rng.standard_normal(24) * 0.13).tolist(), 1) for i in range(700)]  # a large mixed bucket
    rows += [(1000 + i, rng.standard_normal(24).tolist(), i % 3) for i in range(200)]
    rows += [(2000 + i, rows[5][1], 1) for i in range(40)] + [(2100 + i, rows[5][1], 2) for i in range(3)]
    rows += [(3000, None, 1), (3001, [0.0] * 24, 1), (3002, [float("nan")] * 24, 1), (3003, [None] + [1.0] * 23, 1),
             (3004, rows[5][1], None), (3005, [1.0, 2.0], 1), (3006, [2.0, 4.0], 1), (3007, [], 1), (3008, [float("inf"), 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as n", "'x' as cls")
    embedding_dedup.BLOCK, before = 64, embedding_dedup.BLOCK
    try:
        got = {r[0]: (r["n_links"], r["component_id"]) for r in embedding_dedup.digest(frame).collect()}
    finally:
        embedding_dedup.BLOCK = before
    assert got == brute(rows)
    assert embedding_dedup.digest(frame.limit(0)).count() == 0
