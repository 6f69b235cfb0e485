import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from maskloom.llm.elias_fano import SAMPLE, EliasFano
from maskloom.llm.token_files import TokenFile, Tokens, read_tokens, token_file_round_trip, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    """Rows in file order: null ids first; of equal ids, in any order, so only their union is compared."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("n, bound", [(0, 0), (1, 0), (1, 10**15), (5, 3), (700, 90), (3000, 10**6), (2000, 1 << 62)])
def test_elias_fano_selects_what_it_was_built_from(n, bound):
    rng = random.Random(n)
    values = sorted(rng.randint(0, bound) for _ in range(n))
    made = EliasFano.from_bytes(EliasFano.build(np.array(values, np.uint64), bound).to_bytes())
    assert made.n == n and [made[i] for i in range(n)] == values
    assert made.slice(0, n).tolist() == values
    for a, b in [(0, 1), (1, 2), (SAMPLE - 1, SAMPLE + 1), (SAMPLE, 2 * SAMPLE), (n // 2, n), (n, n + 3)]:
        assert made.slice(a, b).tolist() == values[a:b]
    for x in [0, bound, *(rng.randint(0, bound) for _ in range(20))]:
        assert made.search(x) == sum(v < x for v in values)
    with pytest.raises(IndexError):
        made[n]


def test_elias_fano_is_near_the_least_space():
    made = EliasFano.build(np.cumsum(np.random.default_rng(1).integers(1, 800, 100_000)), 80_000_000)
    assert 8 * len(made.to_bytes()) / 100_000 < 2 + np.log2(800) + 0.3


def test_words_give_the_ids_of_whole_texts():
    with open(PATH, encoding="utf-8") as file:
        tokens = Tokens(file.read())
    assert tokens.by_words
    rng = random.Random(5)
    parts = ["a", "The", " ", "  ", "\n", "\t", "\r\n", "é", "é", "́", "日本", "İ", "ΣΑΣ", "'s", "'", "12", "!?",
             "<|endoftext|>", "<|endof", "\x1c", "\x85", " ", " ", "ᄀ", "ᅡ", "🙂", "x" * 50]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert tokens.check(text), repr(text)


def test_round_trip_equals_the_library(spark, library):
    rng = random.Random(7)
    words = ["house", "river,", "Tree.", "it's", "", "\n", "zebra\tcrossing", "<|endoftext|>"]
    rows = [(i * 3 - 50, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "long text " * 20_000), (None, "same"), (None, "same")]
    rows += [(7777, "copy")] * 40
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, start int").repartition(5)
    assert got(token_file_round_trip(docs, PATH)) == expected(library, rows)
    files = write_tokens(docs, PATH, file_tokens=100, task_bytes=3000)
    assert files.count() > 20 and got(read_tokens(files)) == expected(library, rows)


def test_files_answer_for_single_documents(spark, library):
    rows = [(5, "five"), (2, "two words"), (None, "none"), (9, "nine"), (5, "five again"), (-4, None)]
    files = write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH, task_bytes=1 << 30)
    found = {}
    for f in files.collect():
        file = TokenFile(f["path"])
        for key in (-4, -3, 2, 5, 9, 10, -100):
            found.setdefault(key, []).extend(tuple(x.tolist()) for x in file.find(key))
    want = {key: sorted((*library.encode(t or "", add_special_tokens=False).ids, 1) for k, t in rows if k == key)
            for key in found}
    assert {k: sorted(v) for k, v in found.items()} == want


def test_empty_table_and_foreign_files(spark, tmp_path):
    assert token_file_round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    (tmp_path / "x").write_bytes(b"no token file at all" * 20)
    with pytest.raises(ValueError):
        TokenFile(str(tmp_path / "x"))


def test_other_kinds_of_file_use_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        assert not Tokens(file.read()).by_words
    rows = [(1, "Two words"), (2, " spaced  out\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(token_file_round_trip(docs, path)) == expected(Tokenizer.from_file(path), rows)
