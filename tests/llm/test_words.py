"""Words, hashes, n-grams and sliding minima against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from cauce.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBé漢 \t\n\x0b\x0c\r\x1c ", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_runs_of_non_blanks(texts):
    w = W.Words(pa.array(texts, pa.string()))
    expected = [re.findall("[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [w.text(d).decode() for d in range(w.n_docs)] == [" ".join(x) for x in expected]
    assert w.counts().tolist() == [len(x) for x in expected]


@given(st.lists(st.binary(max_size=90), min_size=1, max_size=20))
@settings(max_examples=80, deadline=None)
def test_xxh64_is_the_library_one(values):
    data = np.frombuffer(b"".join(values), np.uint8)
    size = np.array([len(v) for v in values])
    start = np.cumsum(size) - size
    assert W.xxh64(data, start, size, 42).tolist() == [xxhash.xxh64_intdigest(v, 42) for v in values]


@pytest.mark.parametrize("width", [1, 2, 3, 6, 45, 50])
def test_sliding_and_grams(width):
    values = np.random.default_rng(1).integers(0, 9, 120).astype(np.uint64)
    assert W.sliding(values, width).tolist() == [min(values[i:i + width]) for i in range(len(values) - width + 1)]
    grams = W.gram_hashes(values, width)
    same = {}
    for i, g in enumerate(grams.tolist()):
        same.setdefault(tuple(values[i:i + width]), set()).add(g)
    assert all(len(s) == 1 for s in same.values()) and len({g for s in same.values() for g in s}) == len(same)


def test_short_inputs_have_no_windows():
    few = np.zeros(3, np.uint64)
    assert len(W.sliding(few, 4)) == 0 and len(W.gram_hashes(few, 4)) == 0
    assert W.Words(pa.array([], pa.string())).n == 0


def test_slices_hold_every_row_once_and_stay_small():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 900, 3, 40, 40)])], ["t"])
    parts = list(W.slices([batch, batch.slice(6)], "t", 64))
    assert [v for p in parts for v in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column("t").to_pylist())) <= 64 for p in parts)


def test_words_of_a_slice_start_at_its_own_bytes():
    column = pa.array(["a b", None, "c  d e", "f"])
    w = W.Words(column.slice(1, 2))
    assert [w.text(d) for d in range(2)] == [b"", b"c d e"]
