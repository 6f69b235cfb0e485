import random

import numpy as np
import pytest

from maskloom.llm import sais


@pytest.mark.parametrize("way", ["by_bucket", "one_by_one"])
def test_suffix_arrays(monkeypatch, way):
    monkeypatch.setattr(sais, {"by_bucket": "one_by_one", "one_by_one": "by_bucket"}[way], getattr(sais, way))
    random.seed(3)
    for _ in range(800):
        width = random.choice([1, 2, 3, 5, 20])
        text = [random.randint(1, width) for _ in range(random.randint(0, 60))] + [0]
        got = sais.suffix_array(np.array(text), width + 1).tolist()
        assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_permuted_prefixes():
    random.seed(4)
    text = [random.randint(1, 2) for _ in range(400)]
    text[200:300] = text[50:150]
    text = np.array([*text, 0])
    array = sais.suffix_array(text, 3)
    room = np.array([50 - i % 50 for i in range(401)])
    got = sais.permuted_prefixes(text, array, room)
    for i in range(1, 401):
        a, b = array[i], array[i - 1]
        most, k = min(room[a], room[b]), 0
        while k < most and text[a + k] == text[b + k]:
            k += 1
        assert got[a] == k
