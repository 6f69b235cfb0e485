import collections
import hashlib
import random

import pytest

from maskloom.llm import repeats
from maskloom.llm.repeats import remove_repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(t, mark) if not y)
        spans = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((doc, len(t), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(length):
    random.seed(5)
    base = "".join(random.choices("abcdé \n", k=length * 6))
    common = "".join(random.choices("abcd", k=length * 3 // 4))
    rows = []
    for i in range(50):
        text = ""
        for _ in range(random.randint(0, 6)):
            kind = random.random()
            if kind < 0.4:
                at = random.randrange(len(base))
                text += base[at : at + random.randint(1, 3 * length)]
            elif kind < 0.6:
                text += common
            elif kind < 0.7:
                text += "z" * random.randint(1, 3 * length)
            else:
                text += "".join(random.choices("abcdefgh\x00", k=random.randint(1, 2 * length)))
        rows.append((i, text))
    return rows + [(3, rows[3][1]), (None, base), (None, None), (70, None), (71, ""), (72, rows[5][1])]


@pytest.mark.parametrize("length, gram, kinds, shard", [(20, 8, 1000, 1 << 20), (20, 8, 1, 300), (200, 100, 1000, 5000)])
def test_matches_brute_force(spark, monkeypatch, length, gram, kinds, shard):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    rows = rows_of(length)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, h bigint, d string")
    got = remove_repeats(df.repartition(3), length=length, gram=gram, kinds=kinds, shard_bytes=shard,
                         outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, length)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
