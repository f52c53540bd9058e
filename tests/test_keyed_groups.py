"""Keyed-state detectors share one state for many keys: pairs of a group against all pairs, and how many calls a stream makes."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimsight.streaming.keyed_state import RECENT, DuplicateClaims, _part


@pytest.mark.parametrize("held", [0, 150, 299])
def test_pairs_of_a_group_equal_all_pairs(held):
    rng, detector = random.Random(held), DuplicateClaims(48, 0.2)
    rows = [(rng.randrange(10**9), f"c{rng.randrange(280)}", rng.choice([0.0, -3.0, 80.0, 95.0, 100.0, 101.5]),
             rng.choice(["m", None]), rng.choice("pq"), "d") for _ in range(300)]
    got = detector.pairs(pd.DataFrame(rows, columns=RECENT), held)
    plain = []
    for j in range(300):
        for i in range(j):
            a, b = sorted((rows[i], rows[j]), key=lambda c: c[1])
            if j >= held and a[3:] == b[3:] and a[1] != b[1] and abs(a[0] - b[0]) <= detector.band and a[2] and abs(a[2] - b[2]) / a[2] < 0.2:
                plain.append((a[1], b[1]))
    assert sorted(got.itertuples(index=False, name=None)) == sorted(plain) and plain


def test_calls_grow_with_groups_not_with_keys(rel):
    keys = ["member_id", "provider_id", "diagnosis_code"]
    claims = rel.claims.select(_part(keys, 7), *keys)
    assert claims.select("part").distinct().count() == 7 < claims.distinct().count() / 100
    assert claims.groupBy(*keys).agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0


def test_state_is_packed(monkeypatch):
    """A group's rows cross to the state in a few elements, and come back as they were, nulls too."""
    from claimsight.streaming import keyed_state as ks

    class State:
        def __init__(self):
            self.rows = []

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):
            self.rows += rows

        def get(self):
            return iter(self.rows)

        def clear(self):
            self.rows = []
    monkeypatch.setattr(ks, "AT_ONCE", 100)
    rows = pd.DataFrame([(i, f"c{i}", i / 7, None if i % 3 else "m", "p", None) for i in range(250)], columns=ks.RECENT)
    state = State()
    ks._put(state, rows, ks.RECENT_ROWS)
    state.appendList(ks._packed(rows, ks.RECENT_ROWS))
    assert len(state.rows) == 6
    pd.testing.assert_frame_equal(ks._held(state, ks.RECENT_ROWS), pd.concat([rows, rows], ignore_index=True), check_dtype=False)
    ks._put(state, rows.head(0), ks.RECENT_ROWS)
    held = ks._held(state, ks.RECENT_ROWS)
    assert not state.rows and list(held.columns) == ks.RECENT and not len(held)
