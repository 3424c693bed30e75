"""The multi-index and the fixity audit against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.llm import fixity, multi_index


def vectors() -> list[tuple]:
    rng = np.random.default_rng(9)
    data, base = [], rng.normal(size=(60, 16))
    for i in range(240):
        v = base[i % 60] + rng.normal(0, 0.05 if i % 3 else 0.2, 16)
        data.append((i, [float(np.float32(x)) for x in v], i % 60 % 2))
    data += [(1000 + i, data[4][1], 0) for i in range(5)]  # copies
    data += [(1010, data[5][1], 1)] * 2  # repeated rows
    data += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, data[4][1], None), (2003, [float("nan")] * 16, 0)]
    data += [(2004, [None, *data[4][1][1:]], 0), (2005, [], 0), (2006, [float("inf"), *data[4][1][1:]], 0)]
    data += [(None, data[7][1], 1), (2007, [1.0], 0), (2008, [-2.0], 0), (2009, [3.0], 0)]
    return data


def expected(data) -> Counter:
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(data)
    links = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = data[i], data[j]
            if usable(a, x) and usable(b, y) and x == y and len(a) == len(b):
                if np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                    links[i].add(j)
                    links[j].add(i)
    out = Counter()
    for i in range(n):
        reached, stack = {i}, [i]
        while stack:
            for k in links[stack.pop()] - reached:
                reached.add(k)
                stack.append(k)
        ids = [data[k][0] for k in reached if data[k][0] is not None]
        component = min(ids) if ids else None
        out[(data[i][0], len(links[i]), component, data[i][0] is not None and data[i][0] == component)] += 1
    return out


@pytest.mark.parametrize("element", ["float", "double"])
def test_near_vectors(spark, element):
    schema = f"vec_id bigint, embedding array<{element}>, label int, cls int, links string"
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors()], schema)
    assert Counter(map(tuple, multi_index.near_vectors(df).collect())) == expected(vectors())
    assert multi_index.near_vectors(df.limit(0)).count() == 0


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 7)
    df = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>, label int")
    assert Counter(map(tuple, multi_index.near_vectors(df).collect())) == expected(vectors())


def test_traversal_visits_nearest_cells_first():
    rng = np.random.default_rng(0)
    left, right = rng.random(9), rng.random(7)
    cells = multi_index.visit_order(left, right, 30)
    sums = [left[i] + right[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == 30
    assert sums[-1] <= sorted((left[:, None] + right).ravel())[29] + 1e-12


def test_recall_where_pairs_are_rare():
    """Without true pairs in the sample the number of visits comes from made ones, and reaches them."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(3000, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = multi_index.fit(points, np.arange(3000), 0.93, 8)
    first, second = multi_index._made_pairs(points, 0.93)
    visited = multi_index.searched_cells(index, first)
    found = (visited == multi_index.home_cells(index, second)[:, None]).any(axis=1)
    assert found.mean() >= 0.97


RECORDS = [(k, f"http://h/{k}", "body " * (k % 50)) for k in range(0, 9000, 3)]


def test_audit_finds_exactly_the_planted_faults(spark):
    pages = spark.createDataFrame([*RECORDS, (None, "u", "h"), (1, None, None)], "key bigint, url string, html string")
    whole = pages.select("key", fixity.record(F.col("url"), F.col("html")).alias("record"))
    assert fixity.audit(whole, whole).count() == 0
    found = {r.key: r.fault for r in fixity.audit(whole, fixity.damaged(whole)).collect()}
    want = {}
    for k in [r[0] for r in RECORDS] + [1]:
        if k % 103 == 13:
            want[-k - 1] = "extra"
        if k % 101 == 11:
            want[k] = "missing"
        elif k % 97 == 5:
            want[k] = "changed"
        elif k % 89 == 7:
            want[k] = "resized"
    assert found == want


def test_audit_offsets_repeats_and_empty_sides(spark):
    schema = "key bigint, record binary"
    one = spark.createDataFrame([(5, b"abc"), (7, b"defgh"), (9, b"x"), (9, b"x"), (11, None)], schema)
    other = spark.createDataFrame([(5, b"abc"), (7, b"deFgh"), (9, b"x"), (11, b"")], schema)
    got = {r.key: (r.fault, r.byte_offset, r.length, r.replica_length) for r in fixity.audit(one, other).collect()}
    assert got == {7: ("changed", 3, 5, 5), 9: ("resized", 8, 2, 1)}
    none = spark.createDataFrame([], schema)
    assert {(r.key, r.fault) for r in fixity.audit(one, none).collect()} == {(k, "missing") for k in (5, 7, 9, 11)}
    assert {r.fault for r in fixity.audit(none, one).collect()} == {"extra"} and fixity.audit(none, none).count() == 0
