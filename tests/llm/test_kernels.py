"""Properties of the kernels on which the guarantees of the substring and near-duplicate operators rest."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlens.llm import kernels as K
from stationlens.llm import neardup, recompression, substrings

letters = st.lists(st.integers(0, 2), max_size=120)


def coded(xs):
    return K.mix(np.array(xs, dtype=np.uint64))


@given(letters, st.integers(1, 12))
def test_sliding_min(xs, width):
    a = coded(xs)
    if len(a) >= width:
        assert K.sliding_min(a, width).tolist() == [a[i : i + width].min() for i in range(len(a) - width + 1)]


@given(letters, st.integers(1, 9))
def test_winnow_takes_the_rightmost_least(xs, width):
    a = coded(xs)
    chosen = {}
    for place, first, count in zip(*(x.tolist() for x in K.winnow(a, width))):
        for w in range(first, first + count):
            chosen[w] = place
    high = (a >> K.U(32)).tolist()
    assert chosen == {w: max(p for p in range(w, w + width) if high[p] == min(high[w : w + width])) for w in range(len(xs) - width + 1)}


@given(st.binary(max_size=200))
def test_words(body):
    (_, buffer, starts, _), = list(K.blocks([body]))
    begin, end, first = K.words(buffer, starts)
    assert [bytes(buffer[a:b]) for a, b in zip(begin, end)] == re.findall(rb"[^\x20\x09-\x0D]+", body) and first.tolist() == [0, len(begin)]


@given(st.lists(st.binary(max_size=40), max_size=12), st.integers(1, 64))
def test_blocks_hold_all_texts(texts, limit):
    found = []
    for at, buffer, starts, ends in K.blocks(texts, limit):
        assert at == len(found)
        found += [bytes(buffer[a:b]) for a, b in zip(starts, ends)]
    assert found == texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=35, max_size=35), letters, letters, letters, letters)
def test_equal_windows_have_equal_anchors(window, a, b, c, d):
    """Whatever stands around a window, its anchor has the same name and offset."""
    found = []
    for before, after in ((a, b), (c, d)):
        text = " ".join(f"w{x}" for x in before + window + after).encode()
        anchors = recompression.finder()([text])
        at = len(before)
        k = np.flatnonzero((anchors.first <= at) & (at < anchors.first + anchors.count))
        assert len(k) == 1
        found.append((int(anchors.name[k[0]]), int(anchors.offset[k[0]] + at - anchors.first[k[0]])))
    assert found[0] == found[1]


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=50, max_size=50), st.binary(max_size=60), st.binary(max_size=60))
def test_equal_byte_windows_have_equal_anchors(window, before, after):
    found = []
    for text, at in ((window, 0), (before + window + after, len(before))):
        anchors = substrings.finder()([text])
        k = np.flatnonzero((anchors.first <= at) & (at < anchors.first + anchors.count))
        found.append((int(anchors.name[k[0]]), int(anchors.offset[k[0]] + at - anchors.first[k[0]])))
    assert found[0] == found[1]


@given(letters)
def test_symbols_cover_the_words(xs):
    name, start = recompression.symbols(coded(xs))
    size = np.diff(np.append(start, len(xs)))
    assert len(name) == len(start) and (size >= 1).all() and (size <= recompression.CAPS[-1]).all()


@given(st.lists(st.booleans(), min_size=20, max_size=20))
def test_signatures_under_the_distance_share_a_key(differs):
    scheme = neardup.Scheme()
    shared = [i for i in scheme.indexes if not any(differs[s] for s in i)]
    assert shared or sum(differs) > scheme.distance
