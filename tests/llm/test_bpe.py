import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from maskloom.llm.bpe import Encoder, bpe_round_trip, encode_words, load_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "  a  b ", "\n\n\nx", "a\n\t\nb", "<|endoftext|>x <|endoftext|> y", "it's we'll 'S 12 345abc",
    "  é　日本語 テスト🙂🙂", "a" * 3000, "ab" * 1500 + " " * 77, " \x1c\x1d a\x1f\x1fb", "\x85\x85x  y",
    "!!!\r\n\r\nq", "then, The, then. THEN! x", "﻿a ​b",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoder_matches_the_library(library):
    random.seed(1)
    alphabet = ["a", "b", " ", "'", "\n", "\t", " ", "é", "日", "1", "!", "s", "\x1c", "🙂", "<|endoftext|>", "then", ", "]
    texts = ODD + ["".join(random.choices(alphabet, k=random.randint(1, 50))) for _ in range(1500)]
    encoder = Encoder(load_vocabulary(PATH))
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert encoder.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_segment_tree_merges_leftmost_lowest_rank_first():
    v = load_vocabulary(PATH)
    rank = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(r) for p, r in zip(v.pairs, v.ranks)}

    def plain(word):
        ids = [int(v.byte_ids[b]) for b in word]
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank), default=None)
            if best is None:
                return ids
            ids[best[1] : best[1] + 2] = [int(v.merged[best[0]])]

    random.seed(2)
    words = [bytes(random.choices(b" thenaio\xc3\xa9", k=random.randint(1, 40))) for _ in range(400)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode_words(v, words)] == [plain(w) for w in words]


def test_operator_on_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "then <|endoftext|>", 5), (1, "then <|endoftext|>", 5), (None, "x", 6), (2, None, 7), (3, "", 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, k bigint").withColumnRenamed("k", "t")
    got = bpe_round_trip(df, tokenizer=PATH, outputs=("n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]

    def want(doc, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return doc, len(ids), sha(np.array(ids, "<u4").tobytes()), text or "", sha((text or "").encode())

    assert sorted(map(tuple, got.collect()), key=str) == sorted((want(d, t) for d, t, _ in rows), key=str)
    assert bpe_round_trip(df.limit(0), tokenizer=PATH).collect() == []
