import collections
import math
import random

import numpy as np

from maskloom.llm.ngrams import Arrays, codes_of, losses


def kneser_ney(texts, order, asked):
    """Modified Kneser-Ney by definition, on tuples."""
    grams = {order: collections.Counter()}
    for t in texts:
        padded = [0] * (order - 1) + t
        grams[order].update(tuple(padded[i : i + order]) for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    rates = {}
    for k in grams:
        n = [sum(1 for c in grams[k].values() if c == i) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else None
        rates[k] = []
        for i in (1, 2, 3):
            value = i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[1] else 0
            rates[k].append(value if n[i + 1] and 0 < value < i else (0.5, 1.0, 1.5)[i - 1])

    def p(gram):
        k = len(gram)
        lower = p(gram[1:]) if k > 1 else 1 / (len(grams[1]) + 1)
        rows = {g: c for g, c in grams[k].items() if g[:-1] == gram[:-1]}
        if not rows:
            return lower
        total = sum(rows.values())
        d = lambda c: rates[k][min(c, 3) - 1]
        c = rows.get(gram, 0)
        return (c - d(c) if c else 0) / total + sum(map(d, rows.values())) / total * lower

    return {g: -math.log(p(g)) for g in asked}


def test_losses_match_the_definition(spark):
    random.seed(6)
    order, bits = 3, 9
    texts = [[random.choice([1, 1, 1, 2, 2, 3, 4, 5]) for _ in range(random.randint(1, 40))] for _ in range(30)]
    train = texts[:20]

    def counted(part):
        out = collections.Counter()
        for t in part:
            out.update(codes_of(np.array(t), np.array([0]), order, bits).tolist())
        return out

    every, good = counted(texts), counted(train)
    df = spark.createDataFrame([("x", c, n, good[c]) for c, n in every.items()] + [("y", 5, 1, 0)],
                               "g string, code bigint, n bigint, m bigint")
    got = {(r.g, r.code): r.loss for r in losses(df, order, bits, "m").collect()}
    parts = lambda c: tuple(c >> bits * k & 511 for k in range(order - 1, -1, -1))
    want = kneser_ney(train, order, [parts(c) for c in every])
    assert len(got) == len(every) + 1 and ("y", 5) in got
    for c in every:
        assert abs(got["x", c] - want[parts(c)]) < 1e-9


def test_codes_stop_at_texts():
    got = codes_of(np.array([1, 2, 3, 4, 5]), np.array([0, 2, 3]), 3, 9)
    assert got.tolist() == [1, 1 << 9 | 2, 3, 4, 4 << 9 | 5]


def test_arrays_find_values_and_give_zero_elsewhere():
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 1 << 40, 4000, dtype=np.uint64))
    values = np.arange(1, len(codes) + 1, dtype=np.float32)
    arrays = Arrays().fill(np.array(["a", "b"] * (len(codes) // 2) + ["a"] * (len(codes) % 2)), codes, values)
    a = np.arange(len(codes)) % 2 == 0
    assert (arrays.get("a", codes) == np.where(a, values, 0)).all()
    assert (arrays.get("c", codes) == 0).all()
