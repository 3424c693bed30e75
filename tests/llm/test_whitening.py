"""Whitening against numpy and Python integers over all rows."""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest

from curbside.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, component int, n bigint"


def usable(v):
    return v is not None and len(v) and all(e is not None and math.isfinite(e) for e in v)


def expected(vectors):
    x = [[math.floor(1024 * float(np.float32(e))) + 100_000 for e in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    at = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(at.T @ at / n)
    return x, deviation, at, values[::-1], axes[:, ::-1]


def test_against_all_rows(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12))
    vectors = [v.tolist() for v in (rng.normal(size=(700, 12)) @ mix / 8).astype(np.float32)]
    data = [(i, v, 1, 0, 0) for i, v in enumerate(vectors)]
    data += [(900, None, 1, 0, 0), (901, [], 1, 0, 0), (902, [1.0] * 11 + [None], 1, 0, 0)]
    data += [(903, [float("nan")] * 12, 1, 0, 0), (904, [float("inf")] * 12, None, 0, 0), (905, [1.0] * 5, 1, 0, 0)]
    data += [(None, vectors[0], 1, 0, 0), (7, vectors[7], 1, 0, 0)]  # a null id and a repeated row
    whole = [r[1] for r in data if usable(r[1]) and len(r[1]) == 12]
    _, deviation, at, values, axes = expected(whole)
    rows = whitening.whiten(spark.createDataFrame(data, SCHEMA).repartition(7)).collect()
    assert {r.vec_id for r in rows if r.component is None} == {905}
    rows = [r for r in rows if r.component is not None]
    assert len(rows) == 8 * len(whole) and {r.n for r in rows} == {len(whole)}
    want = {}
    for row, dev, p in zip([r for r in data if usable(r[1]) and len(r[1]) == 12], deviation, at):
        for c in range(8):
            want.setdefault((row[0], c + 1), (dev, p @ axes[:, c] / math.sqrt(values[c])))
    sign = {}
    for r in rows:
        dev, white = want[(r.vec_id, r.component)]
        assert r.deviation == dev == int(r.deviation_exact)
        sign.setdefault(r.component, 1 if abs(white) < 1e-6 or white * r.whitened > 0 else -1)
        assert r.whitened == pytest.approx(sign[r.component] * white, abs=1e-9)
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_wide_and_flat_dimensions(spark):
    """Ranges past 21 bits, sums of squares past 64 bits, a constant dimension, fewer dimensions than components."""
    rng = np.random.default_rng(4)
    vectors = [[float(a), float(b) * 1e7, 2.5] for a, b in rng.normal(size=(300, 2))]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>").repartition(3)
    x = [[math.floor(1024 * e) + 100_000 for e in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    rows = whitening.whiten(df).collect()
    assert len(rows) == 900
    for r in rows:
        exact = sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation_exact == Decimal(exact) and r.deviation == (exact if exact < 2**63 else None)
        assert (r.whitened is None) == (r.component == 3)
        assert r.identity_error < 1e-6


def test_cross_products_are_exact():
    rng = np.random.default_rng(5)
    for high in (1, 2000, 1 << 30):
        x = rng.integers(-high, high, (333, 5)) * np.array([1, 1, 0, 1, 1])
        low = x.min(axis=0)
        bits = [int(b).bit_length() for b in (x.max(axis=0) - low)]
        got = whitening.cross_products(whitening.bit_planes(x, low, bits), bits)
        y = (x - low).astype(object)
        assert (np.triu(got.astype(object)) == np.triu(y.T @ y)).all()


def test_tables_without_spread(spark):
    empty = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 1, 0, 0)] * 2, SCHEMA)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in one)
