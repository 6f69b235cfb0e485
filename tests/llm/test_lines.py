import collections
import hashlib
import random

import numpy as np

from maskloom.llm import lines
from maskloom.llm.lines import build_hash, line_dedup, probe_hash, without_repeated_lines

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows):
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= 10:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not (doc is not None and len(holders[key_of(x)]) >= 2 and min(holders[key_of(x)]) != doc)]
        out.append((doc, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(n=120):
    random.seed(4)
    pool = ["A line that Many hold", "  a line that many HOLD\t", "ünïcode ÄÖ lines", "short", "", "éééééééééé",
            "ééééééééé", "x" * 300, "once upon a time"] + [f"line number {i}" for i in range(30)]
    rows = [(i, "\n".join(random.choices(pool, k=random.randint(1, 8)))) for i in range(n)]
    return rows + [(3, rows[3][1]), (None, pool[0]), (500, None), (501, ""), (-5, pool[0] + "\n" + pool[0]), (7, pool[0])]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 5)
    monkeypatch.setattr(lines, "PACK_LINES", 7)
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, keys bigint, pack string")
    got = line_dedup(df.repartition(3), outputs=("n_lines", "n_dropped", "kept_sha256"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_rows_keep_their_columns_and_empty_tables_work(spark):
    df = spark.createDataFrame([(1, "a common line here\nmine", 9, "p"), (2, "A common line here", 9, "q")],
                               "doc_id bigint, text string, n_chars bigint, kept string")
    assert [tuple(r) for r in without_repeated_lines(df).collect()] == [(1, "a common line here\nmine", 23, "p")]
    assert without_repeated_lines(df.limit(0)).collect() == []


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    bits, place = build_hash(keys)
    assert sorted(place) == list(range(len(keys)))
    assert (probe_hash(bits, keys) == place).all()
    assert probe_hash(*[build_hash(keys[:0])[0]], keys[:3]).tolist() == [-1] * 3
