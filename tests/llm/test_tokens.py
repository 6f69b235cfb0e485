import collections
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from maskloom.llm.tokens import attribute_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["then the end\nof it\n\n\nall, and more", "", None, "日本語 🙂 tests\nünïcode <|endoftext|> x", "\n", "a" * 300 + "\n b"]


def credit(text, sections, rule):
    spans = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).offsets
    out, none = [0.0] * len(sections), 0.0
    for a, b in spans:
        inside = [min(b, e) - max(a, s) for s, e in sections]
        hit = [k for k, x in enumerate(inside) if x > 0 and sections[k][1] > sections[k][0]]
        if rule == "start":
            own = [k for k in hit if a >= sections[k][0]]
            for k in own:
                out[k] += 1
            none += not own
        elif rule == "most":
            best = min(hit, key=lambda k: (-inside[k], sections[k][0], k), default=None)
            if best is None:
                none += 1
            else:
                out[best] += 1
        else:
            for k in hit:
                out[k] += inside[k] / (b - a)
            none += 1 - min(1.0, sum(inside[k] for k in hit) / (b - a))
    return out, none


@pytest.mark.parametrize("rule", ["start", "most", "share"])
def test_sections_match_brute_force(spark, rule):
    random.seed(8)
    rows = []
    for i, text in enumerate(TEXTS * 3):
        n = len(text or "")
        cuts = [sorted(random.choices(range(n + 3), k=2)) for _ in range(random.randint(0, 5))]
        rows.append((i, text, [(k, *c) for k, c in enumerate(cuts)], "x"))
    rows.append((99, "then", None, "x"))
    df = spark.createDataFrame(
        rows, "doc_id bigint, text string, own array<struct<section:bigint,start:bigint,end:bigint>>, start string")
    got = collections.defaultdict(dict)
    for r in attribute_tokens(df, tokenizer=PATH, rule=rule, sections="own").collect():
        got[r.doc_id][r.section] = r.n_tokens
    for doc, text, own, _ in rows:
        want, none = credit(text or "", [(s, e) for _, s, e in own or []], rule)
        assert [got[doc][k] for k in range(len(want))] == pytest.approx(want), text
        assert got[doc][None] == pytest.approx(none), text


def test_lines_are_the_sections_of_a_text(spark):
    df = spark.createDataFrame([(1, "ab cd\n\nx"), (None, None)], "doc_id bigint, text string")
    got = sorted(map(tuple, attribute_tokens(df, tokenizer=PATH).collect()), key=str)
    spans = [r[:4] for r in got]
    assert spans == sorted([(1, 0, 0, 5), (1, 1, 6, 6), (1, 2, 7, 8), (1, None, None, None), (None, 0, 0, 0),
                            (None, None, None, None)], key=str)
    assert sum(r[4] for r in got) == len(Tokenizer.from_file(PATH).encode("ab cd\n\nx", add_special_tokens=False).ids)
    assert attribute_tokens(df.limit(0), tokenizer=PATH).collect() == []
