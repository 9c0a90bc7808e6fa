"""Vector codes against plain loops over all entries, and against their SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tallysieve.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector int, part int"


def plain(rows):
    """{row index: (code, error)}, label errors and digest by the definition; rows are (vec_id, integers, label)."""
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    width = len(first[0][1]) // 8
    books = [[list(r[1][p * width : (p + 1) * width]) for r in first] for p in range(8)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for turn in range(7):
        found = [[nearest(v[p * width : (p + 1) * width], p) for p in range(8)] for _, v, _ in rows]
        if turn == 6:
            break
        for p in range(8):
            for k in range(len(books[p])):
                own = [r[1][p * width : (p + 1) * width] for r, f in zip(rows, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    of = {}
    for (_, _, label), e in zip(rows, errors):
        of[label] = of.get(label, 0) + e
    return sorted(((r[0], bytes(k for _, k in f).hex(), e, of[r[2]], digest) for r, f, e in zip(rows, found, errors)), key=repr)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in frame.collect()), key=repr)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    centres = [[rng.randint(-9, 9) for _ in range(16)] for _ in range(40)]
    out = [(k, [c / 4096 + rng.choice([0, 0, 1, -1]) / 8192 for c in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for k in range(300)]
    out += [(5, out[5][1], 9)] * 3 + [(5, out[6][1], 9), (None, out[7][1], None), (None, out[8][1], 2)]
    out += [(k, out[0][1], 7) for k in range(1000, 1150)]  # one vector, many rows
    return out


@pytest.fixture(scope="module")
def expected(rows):
    return plain([(i, [int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v], label) for i, v, label in rows])


def test_codes_are_those_of_plain_loops(spark, rows, expected):
    bad = [(-1, None, 1), (-2, [0.5] * 15 + [None], 1), (-3, [float("nan")] * 16, 1), (-4, [float("inf")] + [0.0] * 15, 1), (-5, [-float("inf")] * 16, None)]
    assert rows_of(vectors.compress(make(spark, bad + rows).repartition(5))) == expected


def test_sql_says_the_same(spark, rows, expected):
    embeddings = make(spark, rows).toArrow()  # noqa: F841
    found = duckdb.sql(vectors.oracle())
    at = [found.columns.index(c) for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")]
    assert sorted((tuple(r[k] for k in at) for r in found.fetchall()), key=repr) == expected


def test_slices_find_the_nearest_with_ties_to_the_lower_index():
    rng = np.random.default_rng(1)
    for entries, width, spread in ((16, 8, 5), (64, 3, 4), (1, 2, 9), (16, 4, 10**7), (7, 1, 2)):
        book, points = rng.integers(-spread, spread + 1, (entries, width)), rng.integers(-spread, spread + 1, (500, width))
        distances = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        index, least = vectors.Slices(book).nearest(points)
        assert (index == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()


def test_candidates_are_exactly_the_box():
    rng = np.random.default_rng(2)
    book, points, radius = rng.integers(-20, 20, (40, 3)), rng.integers(-20, 20, (300, 3)), rng.integers(0, 15, 300)
    inside = (abs(points[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
    masks = vectors.Slices(book).candidates(points, radius)
    assert all({e for e in range(40) if int(m) >> e & 1} == set(np.flatnonzero(row)) for m, row in zip(masks, inside))


def test_few_vectors_other_lengths_and_empty_tables(spark):
    few = [(k, [float(k)] * 8, None) for k in range(3)]
    got = {r["vec_id"]: r for r in vectors.compress(make(spark, [*few, (9, [1.0] * 16, 4), (10, [], 4)])).collect()}
    assert [got[k]["code"] for k in range(3)] == [f"0{k}" * 8 for k in range(3)] and {got[k]["error"] for k in range(3)} == {0}
    assert got[9]["code"] is None and got[10]["error"] is None and got[9]["label_error"] is None
    assert {r["code"] for r in vectors.compress(make(spark, [(1, [0.5] * 9, 1), (2, [0.5] * 8, 1)])).collect()} == {None}
    assert vectors.compress(make(spark, [])).collect() == [] and vectors.compress(make(spark, [(1, None, 1)])).collect() == []


def test_codes_stand_for_their_entries():
    books = vectors.Codebooks(np.arange(2 * 3 * 4).reshape(2, 3, 4))
    assert books.vector("0201").tolist() == [8, 9, 10, 11, 16, 17, 18, 19]


def test_components_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="components must stay below"):
        vectors.compress(make(spark, [(1, [1e30] * 8, 1)])).collect()
