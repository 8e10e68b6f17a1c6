"""The nearest keys of far queries against brute force."""

import random

from massquarry.operators import retrieval


def test_nearest_keys_are_found_at_any_distance(spark):
    r = random.Random(8)
    lib = [(f"k{i % 40}", r.choice([r.uniform(300, 310), r.uniform(500, 900)])) for i in range(60)] + [("n", None), ("z", 0.0)]
    qs = [(1, 305.0), (2, 300.0), (3, 420.0), (4, 950.0), (5, 2000.0), (6, 20.0), (7, None), (8, float("nan"))]
    L, Q = spark.createDataFrame(lib, "key string, mass double"), spark.createDataFrame(qs, "q long, m double")
    ok = lambda x: x is not None and x == x and x > 0
    for n in (3, 50):  # the library holds fewer than 50 keys
        want = set()
        for q, m in qs:
            if not ok(m):
                continue
            e = {}
            for k, x in lib:
                if ok(x):
                    e[k] = min(e.get(k, 1e99), abs((x - m) / m * 1e6))
            near = {k for k, x in e.items() if x <= 3.0} or {k for k, _ in sorted(e.items(), key=lambda x: (x[1], x[0]))[:n]}
            want |= {(q, k) for k in near}
        rows = retrieval.fallback_search(Q, L, "q", "m", "key", "mass", [3.0], nearest=n).collect()
        assert {(x.q, x.key) for x in rows} == want and len(rows) == len(want)
