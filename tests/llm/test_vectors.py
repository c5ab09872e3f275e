"""Vector codes against SQL and a plain re-computation."""

import math

import numpy as np
import pytest

from tests.compare import connection, same
from ticketloom.llm import queries, vector_codes


def plainly(rows, parts=16, entries=64, rounds=2):
    """rows of (vec_id, vector, label) -> codes, errors and codebooks, part by part and entry by entry."""
    dim = None
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in r[1])]
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in good if len(v) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if good:
        dim = len(good[0][1])
    good = [r for r in good if len(r[1]) == dim]
    if not good:
        return [], []
    w = dim // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, v, _ in good]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for c in cut:
                met.setdefault(assign(p, c[p])[1], []).append(c[p])
            for k, xs in met.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    out = []
    for (i, _, label), c in zip(good, cut, strict=True):
        found = [assign(p, c[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def coded(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string, n int")
    found, books = vector_codes.compress_vectors(df, **options)
    return sorted(map(tuple, found.collect()), key=repr), books, found


def test_contract(spark, sf):
    same(queries.QUERIES["op12_vector_codes"](spark, sf), connection(sf), vector_codes.OP12_SQL)


def test_plain_recomputation_with_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 32)], int(i) % 3 if i % 4 else None) for i in rng.permutation(300)]
    rows += [(k, rows[0][1], 7) for k in range(1000, 1400)]  # a third of all rows has one vector
    rows += [rows[5], rows[5], (5, rows[9][1], 1), (None, rows[3][1], None), (-1, None, 1), (-2, [], 1), (-3, [1.0] * 31 + [None], 1), (-4, [math.nan] * 32, 1), (-5, [math.inf] + [0.0] * 31, 1)]
    rows += [(-6, [1e30] * 32, 1), (2000, [0.5] * 48, 1), (2001, [0.5] * 33, 1), (2002, [200000.0, -200000.0] * 16, 2)]
    want, books = plainly(rows)
    for options in ({}, {"chunk": 64, "block": 8}, {"chunk": 50, "block": 64}):
        got, found, df = coded(spark, rows, **options)
        assert got == sorted(want, key=repr) and found == books
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert {r["label"]: r["label_error"] for r in vector_codes.with_label_error(df).collect()} == sums


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)], [(1, [1.0] * 15, None)]])
def test_nothing_to_code(spark, rows):
    got, books, df = coded(spark, rows)
    assert got == [] and books == [] and vector_codes.with_label_error(df).count() == 0


def test_few_rows_and_ties(spark):
    rows = [(1, [0.0] * 16, 1), (2, [0.0] * 16, 1), (3, [1 / 256] * 16, None)]
    got, books, _ = coded(spark, rows)
    want, same_books = plainly(rows)
    assert got == sorted(want, key=repr) and books == same_books and got[0][2] == "00" * 16


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = vector_codes.hilbert_index(grid, bits)
        assert sorted(index) == list(range(len(grid)))
        walk = grid[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry_and_are_short():
    rng = np.random.default_rng(2)
    points, entries = rng.integers(-90, 90, (1 << 15, 4)), rng.integers(-90, 90, (64, 4))
    points = points[vector_codes.hilbert_order(points)]
    blocks = points.reshape(-1, 64, 4)
    listed = vector_codes.shortlists(blocks.min(axis=1), blocks.max(axis=1), entries)
    best = ((points[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1).reshape(-1, 64)
    assert all(listed[k][best[k]].all() for k in range(len(blocks)))
    assert listed.mean() < 0.6
