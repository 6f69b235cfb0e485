import collections
import random
import re

import pytest

from maskloom.llm import ngrams, rules
from maskloom.llm.rules import STATS, good_documents, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeated), n < 10 or 100 * len(repeated) > 20 * n)


def sentence(rng, n):
    syllables = ["the", "an", "re", "on", "ti", "en", "er"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def rows_of():
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randint(12, 120)), "en") for i in range(150)]
    junk = [(1000 + i, " ".join(w + rng.choice(["%%%", "&&&"]) for w in sentence(rng, 60).upper().split()), "en")
            for i in range(6)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "a b\nc\nc\n \n \nc d", "en"), (2003, "x y z " * 40, "en"),
           (2004, "é\x85ü  " * 12, "fr"), (None, sentence(rng, 40), "en"), (5, *rows[5][1:]),
           (2005, sentence(rng, 30), None), (2006, "#*$%&|<> a", "en")]
    return rows, junk, odd


def test_counts_match_brute_force_and_bands_reject_unlike_text(spark):
    good, junk, odd = rows_of()
    rows = good + junk + odd
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows],
                               "doc_id bigint, text string, lang string, n_words bigint, loss double")
    reference = spark.createDataFrame([(i,) for i in range(0, 150, 2)] + [(None,)], "doc_id bigint")
    got = quality_rules(df, reference=reference).select("doc_id", *STATS, "base_failed", "kept").collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted(((d, *brute(t)) for d, t, _ in rows), key=str)
    kept = {r.doc_id for r in got if r.kept}
    assert {d for d, *_ in good} <= kept
    assert not kept & {d for d, *_ in junk}
    assert not any(r.kept for r in got if r.base_failed)
    assert good_documents(df, reference).columns == df.columns


def test_without_reference_and_without_rows(spark):
    good, _, _ = rows_of()
    df = spark.createDataFrame(good[:30], "doc_id bigint, text string, lang string")
    none = spark.createDataFrame([], "doc_id bigint")
    assert quality_rules(df, reference=none).where("kept").count() == 30
    assert quality_rules(df.limit(0)).collect() == []


def test_losses_in_blocks_are_the_same(spark, monkeypatch):
    good, junk, odd = rows_of()
    df = spark.createDataFrame(good[:20] + junk + odd, "doc_id bigint, text string, lang string")
    rows = lambda: sorted(((r.doc_id, round(r.loss or 0, 4), r.kept) for r in quality_rules(df).collect()), key=str)
    one = rows()
    monkeypatch.setattr(ngrams, "BLOCK_ENTRIES", 700)
    assert rows() == one


def test_a_majority_of_labelled_copies_does_not_move_the_band(spark):
    good, _, _ = rows_of()
    clean = good[:60]
    copies = [(5000 + i, sentence(random.Random(8), 90), "en") for i in range(200)]
    df = spark.createDataFrame(clean + copies + copies[:5], "doc_id bigint, text string, lang string")
    reference = spark.createDataFrame([(i,) for i in [*range(0, 60, 2), *range(5000, 5080)]], "doc_id bigint")
    got = quality_rules(df, reference=reference).select("doc_id", "kept").collect()
    assert len(got) == 265 and all(r.kept for r in got)


def test_a_language_without_labels_has_a_model_of_all_its_texts(spark):
    good, junk, _ = rows_of()
    rng = random.Random(4)
    french = [(3000 + i, sentence(rng, rng.randint(12, 120)), "fr") for i in range(100)]
    null = [(4000 + i, sentence(rng, rng.randint(12, 120)), None) for i in range(100)]
    bad = [(6000, junk[0][1], "fr"), (6001, junk[1][1], None)]
    df = spark.createDataFrame(good + french + null + bad, "doc_id bigint, text string, lang string")
    reference = spark.createDataFrame([(i,) for i in range(0, 150, 2)], "doc_id bigint")
    got = {r.doc_id: r for r in quality_rules(df, reference=reference).collect()}
    assert {d for d, r in got.items() if not r.kept} == {6000, 6001}
    assert len({round(got[d].loss, 6) for d, *_ in french}) > 50


def test_too_predictable_text_goes(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    common = [word(10) for _ in range(30)]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else word(rng.randint(3, 9)) for _ in range(n))
    good = [(i, text(rng.randint(60, 120)), "en") for i in range(200)]
    dull = (900, " ".join(rng.choices(common, k=300)), "en")
    df = spark.createDataFrame([*good, dull], "doc_id bigint, text string, lang string")
    reference = spark.createDataFrame([(i,) for i in range(200)], "doc_id bigint")
    for labels in (reference, None):
        got = {r.doc_id: r for r in quality_rules(df, reference=labels).collect()}
        assert not got[900].base_failed
        assert {d for d, r in got.items() if not r.kept} == {900}
