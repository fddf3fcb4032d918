"""The index of a packing shard sheds used-up rests without a change of what is ranked."""

import random

import numpy as np

from cauce.llm import packing
from cauce.llm.words import distinct


def brute_key(ids, frequency):
    places = {t: i for i, t in enumerate(sorted(range(len(frequency)), key=lambda t: frequency[t]))}
    return sorted({places[t] for t in ids if frequency[t] > 1})[:packing.KEY_TERMS]


def test_used_rests_leave_the_index_and_ranks_stay():
    r = np.random.default_rng(3)
    rows = [(i, 40, r.integers(0, 90, 40), 0) for i in range(64)]
    rows += [(64, 40, rows[5][2], 0), (65, 2, np.array([95, 96]), 0)]  # a copy, and a rest that shares nothing
    idf = r.random(100).astype(np.float32)
    shed, full = packing._Shard(rows, idf, 40.0), packing._Shard(rows, idf, 40.0)
    entries = [len(shed.member)]
    for n, seed in enumerate(random.Random(4).sample(range(66), 66)):
        full.indexed = 0  # sheds nothing
        (order, score), (whole, exact) = shed.ranked(seed), full.ranked(seed)
        assert order.tolist() == whole.tolist() and score[order].tolist() == exact[whole].tolist()
        entries.append(len(shed.member))
        for shard in (shed, full):
            shard.left[seed] = 7 if n % 9 == 0 else 0  # some are cut, not used up
    assert len(full.member) == entries[0]
    assert entries[-1] <= entries[0] // 3 and entries == sorted(entries, reverse=True)


def test_sort_key_is_the_rarest_shared_terms():
    r = random.Random(7)
    frequency = np.array([r.choice([0, 1, 1, 2, 3, 9]) for _ in range(60)], float)
    texts = [[r.randrange(60) for _ in range(r.choice([0, 1, 5, 60]))] for _ in range(80)] + [None]
    batch = packing.pa.RecordBatch.from_pydict(
        {"rest": packing.pa.array([None if t is None else np.array(t, "<u2").tobytes() for t in texts], packing.pa.binary())})
    [keyed] = packing._by_content(frequency)([batch])
    got = [np.frombuffer(k, ">u4").tolist() for k in keyed.column("lex").to_pylist()]
    assert got == [brute_key(t or [], frequency) for t in texts]


def test_distinct_values():
    for values in ([], [3], [2, 2, 2], [5, 1, 5, 0, 1]):
        assert distinct(np.array(values, np.int64)).tolist() == sorted(set(values))
