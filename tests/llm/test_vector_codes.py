import hashlib
import math
import random

import numpy as np
import pytest

from titleprep.llm.vector_codes import LIMIT, VectorCodes, nearest, reassigned, squared

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row: (codes, distances)} and the codebooks, all in Python's whole numbers."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max([len(r[1]) for _, r in kept], default=0)
    size = max(1, -(-width // parts))
    whole = {}
    for i, r in kept:
        v = [max(-LIMIT, min(LIMIT, math.floor(256 * float(np.float32(x))))) for x in r[1]]
        whole[i] = [(v + [0] * (parts * size))[p * size : (p + 1) * size] for p in range(parts)]
    first = {}
    for i, r in kept:
        first[r[0]] = min(first.get(r[0], whole[i]), whole[i])
    ids = sorted(first, key=lambda k: (k is None, k or 0))[:entries]
    books = [[first[k][p] for k in ids] for p in range(parts)]

    def assign():
        out = {}
        for i, v in whole.items():
            best = [min((sum((a - b) ** 2 for a, b in zip(v[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)]
            out[i] = ([j for _, j in best], [d for d, _ in best])
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [whole[i][p] for i in whole if codes[i][0][p] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    return assign(), books


def vectors(seed, n, width=32):
    """Few different directions, so that entries tie, stay unused and stay where they were."""
    rng = random.Random(seed)
    few = [[rng.choice([-0.3, -0.01, 0.0, 0.004, 0.2]) for _ in range(width)] for _ in range(9)]
    return [(rng.randrange(n), [x + rng.choice([0, 0, 0.05]) for x in rng.choice(few)], rng.choice([None, 1, 2])) for _ in range(n)]


HARD = [
    (5, None, 1), (6, [0.1, None], 1), (7, [float("nan")] * 32, 1), (8, [float("inf")] * 32, 1), (None, [0.25] * 32, 1),
    (9, [], 2), (10, [1.0] * 7, 2), (11, [3e38] * 32, 2), (12, [-3e38] * 32, 2), (3, [0.5] * 32, None),
]


@pytest.mark.parametrize("rows", [vectors(1, 150), vectors(2, 60) + HARD, vectors(3, 20, width=16), HARD])
def test_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", row int").repartition(3)
    found, books = VectorCodes().fit(df)
    codes, expected = brute(rows)
    assert {r["row"]: (r["codes"], r["distances"]) for r in found.collect()} == codes
    assert books.entries.tolist() == expected


def test_query_columns(spark, sf_dir):
    from titleprep.llm.queries import vector_codes

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    codes, books = brute(rows)
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    by_label = {}
    for i, (_, distances) in codes.items():
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + sum(distances)
    expected = {
        rows[i][0]: ("".join(f"{c:02x}" for c in c_), sum(d), by_label[rows[i][2]], hashlib.sha256(text.encode()).hexdigest())
        for i, (c_, d) in codes.items()
    }
    assert {r[0]: tuple(r)[1:] for r in vector_codes(spark, sf_dir).collect()} == expected


def test_empty_table_and_clashing_columns(spark):
    found, books = VectorCodes().fit(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and books.entries.size == 0
    df = spark.createDataFrame([(1, [0.1] * 16, 1, 2, 3, 4, 5)], SCHEMA + ", Codes int, _vector int, _source int, part int")
    row = VectorCodes().fit(df)[0].first()
    assert (row["codes"], row["_vector"], row["part"]) == ([0] * 16, 3, 5)


@pytest.mark.parametrize("top", [3, 200, LIMIT])
def test_active_entries_give_the_nearest(top):
    rng = np.random.default_rng(top)
    for _ in range(50):
        parts, old = rng.integers(-top, top, (40, 4)), rng.integers(-top, top, (8, 4))
        code, distance = nearest(parts, old)
        moved = rng.random(8) < 0.4
        new = np.where(moved[:, None], rng.integers(-top, top, (8, 4)), old)
        expected = nearest(parts, new)
        for a, b in zip(reassigned(parts, new, moved, code, distance), expected):
            assert a.tolist() == b.tolist()
        assert squared(parts, new).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in new] for x in parts]
