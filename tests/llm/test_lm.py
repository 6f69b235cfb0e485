import math
import random

import public_tokenizers

from maskloom.llm import lm
from maskloom.llm.lm import cross_entropy_difference
from maskloom.llm.ngrams import write_arrays

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows_of():
    rng = random.Random(5)
    law = "court judge appeal law the of a under section".split()
    sea = "boat wave wind sail the of a salt harbour".split()
    text = lambda words: " ".join(rng.choices(words, k=rng.randint(5, 60)))
    return [(i, text(law if i % 2 else sea)) for i in range(120)] + [(500, None), (501, ""), (None, text(law)), (3, "the law")]


def test_scores_separate_held_out_texts(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, ids bigint")
    target = spark.createDataFrame([(i,) for i in range(1, 60, 2)] + [(None,)], "doc_id bigint")
    got = cross_entropy_difference(df, target, tokenizer=PATH).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.doc_id is not None and 60 <= r.doc_id < 120]
    assert max(r.score for r in held if r.doc_id % 2) < min(r.score for r in held if not r.doc_id % 2)
    assert all(abs(r.score - (r.target_loss - r.background_loss)) < 1e-9 for r in held)
    assert {r.doc_id: r.score for r in got if not r.n_tokens} == {500: None, 501: None}


def test_no_target_and_no_rows(spark):
    df = spark.createDataFrame(rows_of()[:5], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint")
    assert all(r.score is None and r.background_loss > 0 for r in cross_entropy_difference(df, none, tokenizer=PATH).collect())
    assert cross_entropy_difference(df.limit(0), none, tokenizer=PATH).collect() == []


def test_unigrams_of_both_models_sum_to_one_over_all_tokens(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(lm, "write_arrays", lambda table, *columns: tables.append(table) or write_arrays(table, *columns))
    text = lambda i: "the law of the sea" if not i else f"word{i} and some other thing {i * 37}"
    df = spark.createDataFrame([(i, text(i)) for i in range(40)], "doc_id bigint, text string")
    target = spark.createDataFrame([(0,)], "doc_id bigint")
    cross_entropy_difference(df, target, tokenizer=PATH, order=1).collect()
    rows = tables[0].collect()
    assert len(rows) > 40
    assert all(abs(sum(math.exp(-r[c]) for r in rows) - 1) < 1e-6 for c in ("a", "b"))
