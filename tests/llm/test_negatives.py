import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskloom.llm.negatives import mine_negatives, packed

SCHEMA = "vec_id long, embedding array<float>, label int, score long, cell int"


def brute(rows, every=10, positives=5, negatives=3, low=50, high=95):
    good, length = {}, {}
    for i, v, y in rows:
        if i is None or y is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
        length[len(x)] = length.get(len(x), 0) + 1
        good.setdefault(i, []).append((y, x))
    if not length:
        return []
    d = max(length, key=lambda n: (length[n], n))
    one = {i: min(r for r in rs if len(r[1]) == d) for i, rs in good.items() if any(len(r[1]) == d for r in rs)}
    out = []
    for a, (y, v) in one.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), b, z) for b, (z, w) in one.items() if b != a)
        for score, p, _ in [s for s in scored if s[2] == y][:positives]:
            fit = [(b, -s) for s, b, z in scored if z != y and low * -score <= 100 * -s <= high * -score]
            out += [(a, p, k + 1, b, -score, s) for k, (b, s) in enumerate(fit[:negatives])]
    return sorted(out)


def compare(spark, rows, parts=3, every=10, **options):
    df = spark.createDataFrame([(i, v, y, 1, 2) for i, v, y in rows], SCHEMA).repartition(parts)
    got = sorted(map(tuple, mine_negatives(df, anchor=F.col("vec_id") % every == 0, **options).collect()))
    assert got == brute(rows, every, **{k: v for k, v in options.items() if k in ("positives", "negatives", "low", "high")})
    return got


def clustered(n, d, seed, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((labels, d))
    y = rng.integers(0, labels, n)
    v = centre[y] * 0.6 + rng.standard_normal((n, d)) * spread
    return [(i, a.astype(np.float32).tolist(), int(b)) for i, (a, b) in enumerate(zip(v, y))]


@pytest.mark.parametrize("options", [
    {}, {"block_rows": 40, "slice_rows": 7}, {"clusters": 1}, {"clusters": 60, "block_rows": 25, "slice_rows": 3},
    {"positives": 2, "negatives": 9, "low": 10, "high": 60}])
def test_against_all_scores(spark, options):
    rows = clustered(400, 6, 1) + [(1000 + i, v, y) for i, v, y in clustered(100, 6, 2, spread=1.0)]
    assert compare(spark, rows, **options)


def test_bounds_end_walks_and_leave_out_blocks(spark, monkeypatch):
    from maskloom.llm import negatives

    seen = []
    plain = negatives.exact_product
    monkeypatch.setattr(negatives, "STEP", 32)
    monkeypatch.setattr(negatives, "exact_product", lambda a, b: seen.append(b.shape[1]) or plain(a, b))
    rng = np.random.default_rng(5)
    candidates = rng.standard_normal((4000, 5)) * np.exp(rng.standard_normal((4000, 1)))
    v = np.floor(256 * candidates).astype(np.int64)
    length, unit = negatives.units(v)
    anchor = v[:20]
    norm, own = negatives.units(anchor)
    for i in range(20):
        bound = length * np.maximum(unit @ own[i], 0)
        order = np.argsort(-bound, kind="stable")
        members = {"v": anchor[i : i + 1], "label": np.zeros(1, int), "id": np.array([i]), "norm": norm[i : i + 1],
                   "same": True, "low": np.full((1, 1), negatives.NONE), "high": np.full((1, 1), -negatives.NONE),
                   "floor": np.full((1, 1), negatives.NONE)}
        found = negatives.walk(members, {"v": v, "label": np.zeros(4000, int), "id": np.arange(4000)}, order,
                               bound[order], 5, negatives.nothing())
        scores = anchor[i] @ v.T
        scores[i] = negatives.NONE
        assert found[2].tolist() == np.sort(scores)[::-1][:5].tolist()
    assert sum(seen) < 20 * 4000 / 10  # the bound is exact here, so walks are short


def test_ties_copies_and_repeated_ids(spark):
    rows = clustered(150, 4, 3)
    rows += [(2000 + i, rows[7][1], i % 3) for i in range(60)]  # copies over labels
    rows += [rows[10], rows[10], (20, rows[3][1], 2), (20, None, 1)]
    random.Random(1).shuffle(rows)
    compare(spark, rows)
    compare(spark, rows, block_rows=20, slice_rows=4)


def test_odd_rows_take_no_part(spark):
    rows = clustered(80, 3, 4)
    rows += [(None, [1.0, 1.0, 1.0], 1), (500, None, 1), (510, [1.0, None, 1.0], 1), (520, [float("nan"), 1.0, 1.0], 2),
             (530, [float("-inf"), 1.0, 1.0], 2), (540, [], 1), (550, [1.0, 2.0], 1), (560, [1.0, 1.0, 1.0], None),
             (570, [0.0, 0.0, 0.0], 1), (571, [0.0, 0.0, 0.0], 2), (580, [-1.0, -1.0, -1.0], -3)]
    compare(spark, rows)


def test_one_label_holds_most_rows(spark):
    rows = [(i, v, 0 if i % 10 else y) for i, v, y in clustered(300, 5, 6)]
    compare(spark, rows, block_rows=50)


def test_wide_entries(spark):
    rows = [(i, [c * 2.0**18 for c in v], y) for i, v, y in clustered(120, 3, 8)]
    compare(spark, rows)
    rows = [(i, [c * 2.0**40 for c in v], y) for i, v, y in clustered(60, 3, 9, labels=2)]
    got = brute(rows)
    assert all(abs(s) < 1 << 200 for *_, s in got)


def test_small_tables(spark):
    assert compare(spark, []) == []
    assert compare(spark, [(1, [1.0], 1)]) == []
    assert compare(spark, [(10, [1.0, 2.0], 1)]) == []
    assert compare(spark, [(10, [1.0, 1.0], 1), (11, [1.0, 1.0], 1), (12, [0.7, 0.7], 2)]) != []
    assert compare(spark, [(10, None, 1)]) == []


def test_cells_are_packed_into_slices():
    made = packed([(0, 3), (1, 4), (2, 25), (3, 0), (4, 9), (5, 2)], 10)
    assert made == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 4: (4, 1), 5: (5, 1)}
