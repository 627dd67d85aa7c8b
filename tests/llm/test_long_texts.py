"""Scans of one long text: the same spans as by meeting every range, in time that grows with the text."""

from __future__ import annotations

import time

import numpy as np

from dealerlake.llm import personal_data, secrets
from dealerlake.llm.common import Ranges


def test_ranges_against_meeting_each():
    draw = np.random.default_rng(1)
    for _ in range(300):
        held = [(int(a), int(a + n)) for a, n in zip(draw.integers(0, 40, 6), draw.integers(1, 12, 6), strict=True)][: draw.integers(0, 7)]
        ranges = Ranges(held)
        for a, n in zip(draw.integers(0, 50, 8).tolist(), draw.integers(1, 15, 8).tolist(), strict=True):
            b = a + n
            assert ranges.touch(a, b) == any(x < b and a < y for x, y in held)
            assert ranges.hold(a, b) == any(x <= a and b <= y for x, y in held)
            free = {i for i in range(a, b) if not any(x <= i < y for x, y in held)}
            parts = ranges.outside(a, b)
            assert {i for x, y in parts for i in range(x, y)} == free
            assert sorted(parts) == parts


LINE = "Please ask Mr. Peter Brown or é call 030-7654321, mail a.b@c.de, password=abcdef12 and Zk3vQ9xLw7Tb2Rn8Yc5Jd1Hf.\n"


def test_a_long_text_has_the_spans_of_its_lines():
    crf = personal_data.train()
    times = 300
    (base, every), (one_base, one) = personal_data.find_spans([(LINE * times).encode(), LINE.encode()], crf)
    assert one and one_base
    shifted = {(k, a + i * len(LINE), b + i * len(LINE)) for k, a, b in one for i in range(times)}
    assert set(every) == shifted and len(base) == times * len(one_base)
    base, every = secrets.find_spans(LINE * times)
    one_base, one = secrets.find_spans(LINE)
    assert {s[0] for s in one} >= {"assign", "entropy"}
    assert set(every) == {(k, a + i * len(LINE), b + i * len(LINE)) for k, a, b in one for i in range(times)}


def test_time_grows_with_the_text():
    """Ten times the text took a hundred times as long when every span met every other."""
    crf = personal_data.train()
    for find in (lambda t: personal_data.find_spans([t.encode()], crf), secrets.find_spans):
        taken = []
        for times in (1000, 10000):
            start = time.process_time()
            find(LINE * times)
            taken.append(time.process_time() - start)
        assert taken[1] < 35 * taken[0] + 1
