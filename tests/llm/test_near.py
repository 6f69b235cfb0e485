import random

import pyarrow as pa
import pytest
import zstandard

from maskloom.llm import near
from maskloom.llm.near import near_groups, one_of_each_group


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(5)]))


def brute(rows, percent=85):
    sets = [sets_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(root(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in least[root(i)] if d is not None]
        component = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), component, component is None or doc == component))
    return sorted(out, key=str)


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        words[random.randrange(len(words))] = f"w{random.randrange(10**6)}"
    return " ".join(words)


def rows_of():
    random.seed(9)
    bases = [[f"b{b}x{random.randrange(500)}" for _ in range(random.choice([8, 60, 200]))] for b in range(12)]
    rows = []
    for i in range(200):
        base = bases[random.randrange(len(bases)) if i % 3 else 0]
        rows.append((i, edited(base, random.choice([0, 0, 1, 2, 4]))))
    rows += [(300 + i, f"only {i} few") for i in range(4)] + [(310, "only 1 FEW"), (None, "only 2 few"), (None, "lone"),
             (400, None), (401, ""), (402, " \n\t"), (5, rows[5][1]), (403, "one word")]
    return rows


@pytest.mark.parametrize("leaf", [3000, 20])
def test_matches_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(near, "LEAF", leaf)
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, fp bigint, label string")
    got = near_groups(df.repartition(3)).drop("th")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_one_row_of_each_group_stays(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(4, text, "a"), (2, text, "b"), (2, text, "b"), (9, None, "c")],
                               "doc_id bigint, text string, node string")
    assert sorted(map(tuple, one_of_each_group(df).collect())) == [(2, text, "b"), (9, None, "c")]
    assert one_of_each_group(df.limit(0)).collect() == []


def piece(texts, labels=None):
    """The rows of one piece as ``compare`` gets them, and the fingerprints of the texts."""
    texts, prints, rows = [t.encode() for t in texts], [], []
    batch = {"d": pa.array(range(len(texts))), "th": pa.array([0] * len(texts)), "t": pa.array(texts)}
    (found,) = work_of(batch)
    for k, t in enumerate(texts):
        prints.append(found["fp"][k])
        rows.append({"fp": found["fp"][k], "n": int(found["n"][k]), "tokens": [int(x) for x in found["tokens"][k]],
                     "marks": found["marks"][k], "z": zstandard.ZstdCompressor().compress(t),
                     "label": (labels or prints)[k], "pivot": False})
    schema = pa.schema([("fp", pa.binary()), ("n", pa.int64()), ("tokens", pa.list_(pa.int32())),
                        ("marks", pa.binary()), ("z", pa.binary()), ("label", pa.binary()), ("pivot", pa.bool_())])
    return pa.Table.from_pylist(rows, schema), prints


def work_of(batch):
    held = []
    near.arrow_map, kept = (lambda df, work, schema: held.append(work)), near.arrow_map
    try:
        near.sketches(None, 5)
    finally:
        near.arrow_map = kept
    return list(held[0](iter([batch])))


def test_links_of_a_piece_start_at_the_least_label(monkeypatch):
    random.seed(3)
    base = [f"x{i}" for i in range(400)]
    table, prints = piece([edited(base, 1) for _ in range(12)] + ["quite another text of seven words"])
    got = list(zip(*near.compare(table, 5, 85).to_pydict().values()))
    least = min(prints[:12])
    assert sorted(got) == sorted((least, x) for x in prints[:12] if x != least)


def test_sets_below_the_threshold_are_seldom_compared_one_by_one(monkeypatch):
    random.seed(4)
    base = [f"x{i}" for i in range(400)]
    # of 400 words each text has its own 3 to 9 edited: pairs lie on both sides of the threshold
    texts = [edited(base, random.choice([3, 6, 7, 8, 9])) for _ in range(60)]
    exact, searched = [], near.np.searchsorted
    monkeypatch.setattr(near.np, "searchsorted", lambda *a: exact.append(1) or searched(*a))
    table, prints = piece(texts)
    exact.clear()
    links = near.compare(table, 5, 85)
    up = {x: x for x in prints}
    for a, b in zip(*links.to_pydict().values()):
        up[b] = a
    want = {r[0]: r[2] for r in brute(list(enumerate(texts)))}
    for i in range(60):
        for j in range(i):
            assert (up[prints[i]] == up[prints[j]]) == (want[i] == want[j])
    assert len(exact) < 2 * 60


def test_groups_of_stars_end_after_few_rounds(spark, monkeypatch):
    written, kept = [], near.materialize
    monkeypatch.setattr(near, "materialize", lambda df: written.append(1) or kept(df))
    links = [(bytes([2, t]), bytes([9, i])) for t in range(6) for i in range(50) if (i + t) % 3 or t == 0]
    found = near.groups_of(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {bytes(r["label"]) for r in found} == {bytes([2, 0])} and len(found) == 56
    assert len(written) <= 3
