import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import induced


def check(body):
    text = np.array([*body, 0], np.int32)
    n = len(text)
    got = []
    for bucket, (places, lcps) in reversed(list(induced.suffixes(text))):
        assert (text[places] == bucket).all()
        for k in range(1, len(places)):
            a, b = places[k - 1], places[k]
            same = 0
            while max(a, b) + same < n and text[a + same] == text[b + same]:
                same += 1
            assert lcps[k] == min(same, induced.CAP)
        got += places.tolist()
    assert sorted(got) == list(range(n))
    keys = [tuple(text[p:p + induced.CAP]) for p in got]
    assert keys == sorted(keys)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_small_alphabet(body):
    check(body)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_larger_alphabet(body):
    check(body)


@pytest.mark.parametrize("spool", [1 << 40, 64])
@pytest.mark.parametrize("dense", [0, 1, 64])
def test_structured_texts(monkeypatch, spool, dense):
    monkeypatch.setattr(induced, "MEMORY", spool)
    monkeypatch.setattr(induced, "DENSE", dense)
    rng = random.Random(3)
    word = [rng.randint(1, 5) for _ in range(90)]
    for body in ([1] * 300, [1, 2] * 150, [2, 1] * 100 + [3] * 100, word * 5, word + [9] + word[10:] + [8] + word[::-1],
                 [rng.randint(1, 2) for _ in range(1500)], list(range(200, 1, -1)), list(range(1, 200))):
        check(body)
