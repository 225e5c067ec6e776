"""Requests without enough scores get the first items that they have neither scored nor barred by name."""

import pytest

from recspark.operators import recommend as rec

ITEMS = [(i, "a" if i < 90 else f"n{i % 7}", 1) for i in range(120)]  # the first 90 items have one name
N = 1


def _brute(scored, names):
    free = [(i, name) for i, name, _ in ITEMS if name not in names and i not in scored]
    return [i for i, _ in free[:N]]


@pytest.fixture(scope="module")
def tables(spark):
    cases = {1: ({5}, {"n1"}), 2: (set(range(0, 10)), {"n1"}), 3: ({95}, {"a"}), 4: ({95}, {"a", "n6"}), 5: ({3}, {f"n{x}" for x in range(7)})}
    scores = spark.createDataFrame([(r, i, 0.0) for r, (own, _) in cases.items() for i in own], "request_id long, iid long, score double")
    names = spark.createDataFrame([(r, x) for r, (_, barred) in cases.items() for x in barred], "request_id long, name string")
    return cases, scores, spark.createDataFrame(ITEMS, "iid long, name string, is_open int"), names


def test_first_free_items_whatever_is_barred(tables):
    """Request 1 finds one among the first 4 items, 2 among 64, 3 and 4 have all of them barred."""
    cases, scores, items, names = tables
    named = scores.join(items, "iid").select("request_id", "iid", "name", "is_open", "score")
    got = {}
    for r in rec._zero_candidates(named, named, items, N, names).collect():
        got.setdefault(r.request_id, []).append(r.iid)
    assert got == {r: _brute(*case) for r, case in cases.items()}


def test_items_of_a_name_are_not_listed_per_request(tables, monkeypatch):
    """A picked name bars a share of all items: with some thousand items a name, listing them per request filled the disk."""
    cases, scores, items, names = tables
    monkeypatch.setattr(rec, "_free_by_gaps", None)  # not needed when the first items are enough
    named = scores.join(items, "iid").select("request_id", "iid", "name", "is_open", "score").where("request_id in (1, 2)")
    assert sorted((r.request_id, r.iid) for r in rec._zero_candidates(named, named, items, N, names.where("request_id in (1, 2)")).collect()) \
        == [(1, 0), (2, 10)]
