"""Vector codes against a plain search over all entries."""

from __future__ import annotations

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from winnower.llm.vector_codes import Book, Coding, compress

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int, vector string"


def plain(rows: list[tuple], parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[list[tuple], str]:
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(good[0][1])
    good = [r for r in good if len(r[1]) == length]
    cuts = [k * length // parts for k in range(parts + 1)]
    books = [[v[a:b] for _, v, _ in good[:entries]] for a, b in zip(cuts, cuts[1:])]

    def nearest(book, x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            own: dict[int, list] = {}
            for _, v, _ in good:
                own.setdefault(nearest(books[n], v[a:b])[1], []).append(v[a:b])
            books[n] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[n])]
    out, by_label = [], {}
    for i, v, lab in good:
        found = [nearest(books[n], v[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    digest = sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, code, error, by_label[lab]) for i, code, error, lab in out], digest


def awkward(dimension: int, count: int) -> list[tuple]:
    rng = random.Random(dimension)
    rows = [(k * 3, [rng.choice([rng.uniform(-1, 1), 0.0, -0.5]) for _ in range(dimension)], rng.choice([None, 1, 2])) for k in range(count)]
    rows += [(9, rows[3][1], 1), rows[5], rows[5], (None, rows[2][1], None), (None, [0.25] * dimension, 7)]
    rows += [(10_001, None, 1), (10_002, [None] + [0.0] * (dimension - 1), 1), (10_003, [float("nan")] * dimension, 1), (10_004, [float("-inf")] * dimension, 2), (10_005, [], 1), (10_006, [0.5] * (dimension + 1), 1), (10_007, [9.0] * dimension, 3)]
    return rows


@pytest.mark.parametrize(("dimension", "count"), [(8, 320), (10, 90), (3, 40), (1, 8)])
def test_codes_equal_a_plain_search(spark, dimension, count):
    rows = awkward(dimension, count)
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    got = compress(frame).collect()
    want, digest = plain(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    assert {r["codebooks_sha256"] for r in got} == {digest}


def test_equal_average_search_is_exact():
    rng = np.random.default_rng(3)
    for entries in (rng.integers(-4, 4, (60, 5)), rng.integers(-1 << 20, 1 << 20, (200, 16)), np.repeat(rng.integers(-3, 3, (9, 4)), 3, axis=0)):
        x = np.concatenate((rng.integers(entries.min(), entries.max() + 1, (500, entries.shape[1])), entries))
        code, error = Book(entries).nearest(x)
        apart = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert np.array_equal(code, apart.argmin(axis=1))
        assert np.array_equal(error, apart.min(axis=1))


def test_huge_components_and_no_vectors(spark):
    rows = spark.createDataFrame([(k, [1e38 * (-1) ** k, float(k), 0.0, -1e30]) for k in range(300)], "vec_id long, embedding array<float>").selectExpr("*", "'a' AS label")
    got = compress(rows, Coding(entries=16)).collect()
    assert len(got) == 300 and all(r["error"] >= 0 and len(r["code"]) == 8 for r in got)
    assert compress(rows.where("vec_id < 0")).collect() == []
