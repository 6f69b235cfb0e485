import random
import re

from maskloom.llm.common import blocks
from maskloom.llm.secrets import RULES, Scanner, characters, find_secrets, scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"gh[pousr]_[A-Za-z0-9]+", text) if m.end() - m.start() >= 40]
    out += [(m.start(), 4, m.end()) for m in re.finditer(r"-----BEGIN [A-Z ]*PRIVATE KEY-----", text)]
    return sorted(out)


def texts_of():
    random.seed(2)
    pieces = ["password", "Token", "api_key", "APIKEY", "secret", "passwd", " = ", ":", "=", '"', "'", "abcdef",
              "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "\n", "/+x", "a", "ff00", "  ", "日本", "ghp_",
              "x" * 30, "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN "]
    return ["".join(random.choices(pieces, k=random.randint(0, 40))) for _ in range(1500)] + ["deadbeef" * 1000, ""]


def test_spans_match_regular_expressions():
    texts = texts_of()
    raw = [t.encode() for t in texts]
    scanner, found = Scanner(RULES), []
    for a, b in blocks([len(x) for x in raw], 5000):
        found += scanner.spans(raw[a:b])
    for text, data, spans in zip(texts, raw, found):
        at = characters(data, [x for s, _, e in spans for x in (s, e)])
        assert sorted((at[2 * k], r, at[2 * k + 1]) for k, (_, r, _) in enumerate(spans)) == brute(text)


def test_lanes_that_start_in_a_wrong_state_are_mended():
    import numpy as np

    scanner = Scanner(RULES)
    data = np.frombuffer(("x" * 1020 + "password=" + "a" * 3000).encode(), np.uint8)
    at, _ = scan(scanner.forward, data)
    assert at[0] == 1029 and len(at) == 3000


def test_operator_on_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "é token = abcdef1", 5), (1, "é token = abcdef1", 5), (None, "token=abc", 1), (2, None, 1), (3, "", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans bigint")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in find_secrets(df).collect()), key=str)
    assert got == sorted([(1, [("assign", 2, 17)]), (1, [("assign", 2, 17)]), (None, []), (2, []), (3, [])], key=str)
    assert find_secrets(df.limit(0)).collect() == []
