import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feira.llm.words import span_hashes, word_slices

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.one_of(st.none(), st.text(st.sampled_from("ab \t\n\x0b\x0c\r\x1c\x85\xa0é日"), max_size=12))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 30), st.integers(0, 3))
def test_words_are_those_of_the_pattern(texts, max_bytes, skip):
    column = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
    wanted = [PATTERN.findall(t or "") for t in texts[skip:]]
    found = []
    for words in word_slices(column, max_bytes):
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            spans = zip(words.starts[a:b], words.ends[a:b], strict=True)
            found.append([words.data[s:e].tobytes().decode() for s, e in spans])
    assert found == wanted


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40))
def test_equal_spans_have_equal_hashes(values):
    spans = [(a, b) for a in range(len(values)) for b in range(a + 1, len(values) + 1)]
    starts, ends = np.array(spans).T
    hashes = span_hashes(np.array(values, np.uint64) + np.uint64(1), starts, ends)
    by_content = {}
    for (a, b), h in zip(spans, hashes.tolist(), strict=True):
        assert by_content.setdefault(tuple(values[a:b]), h) == h
    assert len(set(by_content.values())) == len(by_content)


def test_only_ascii_capitals_are_lowered():
    (words,) = word_slices(pa.array(["AbC abc É é Z[ z["]))
    h = words.hashes(lower=True).tolist()
    assert h[0] == h[1] and h[2] != h[3] and h[4] == h[5]
