"""Vector codes against a plain version that scans every entry, and their bounds."""

import hashlib

import numpy as np

from tidemark.llm import codes


def plain(rows, entries=256, rounds=4, parts=4):
    """Codes, errors and codebooks by full scans, in Python's whole numbers."""
    good = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    length = max({len(v) for _, v in good}, key=lambda n: (sum(len(v) == n for _, v in good), n))
    good = sorted((i, v + [0] * (-len(v) % parts)) for i, v in good if len(v) == length)
    width = len(good[0][1]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, v in good[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, book: min(range(len(book)), key=lambda e: (gap(part, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for _, v in good:
                met.setdefault(nearest(cut(v)[p], books[p]), []).append(cut(v)[p])
            for e, members in met.items():
                books[p][e] = tuple(sum(m[i] for m in members) // len(members) for i in range(width))
    out = []
    for i, v in good:
        at = [nearest(cut(v)[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{a:02x}" for a in at), sum(gap(cut(v)[p], books[p][a]) for p, a in enumerate(at))))
    return sorted(out), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_codes_equal_full_scans(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 6))
    rows = [(i * 3, (centres[i % 12] + 0.2 * rng.standard_normal(6)).tolist()) for i in range(400)]
    rows += [(5000 + i, rows[7][1]) for i in range(60)] + [rows[9]] * 3  # copies and repeated rows
    rows += [(1, None), (2, []), (4, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (7, [float("nan")] * 6), (8, [float("inf")] * 6), (10, [0.5, 0.5]), (11, [0.0] * 6), (13, [-3.0, 2.5, 0.25, -0.001, 9.0, 1e-9])]
    df = spark.createDataFrame([(i, v, i % 2, "x", 1.5) for i, v in rows], "vec_id long, embedding array<double>, c0 int, __ints string, code double").repartition(5)
    done = codes.compress(df, entries=16)
    want, digest = plain(rows, 16)
    got = done.rows.collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == want and done.sha256() == digest
    assert sum(r.scans for r in got) < 0.6 * 4 * 5 * len(got)  # the bounds spare scans
    near = done.vectors([r.code for r in got])
    assert near.shape == (len(got), 8) and np.allclose(near[:, 6:], 0)
    again = codes.compress(df, carry=["vec_id", "c0", "__ints"], entries=16).rows
    assert again.columns == ["vec_id", "c0", "__ints", "code", "error", "scans"] and again.count() == len(got)


def test_ties_go_to_the_lower_index(spark):
    """Equal entries, and parts half way between two entries, on a grid where bounds are tight."""
    rows = [(i, [float(x) / 1024 for x in ((i * 7) % 5 * 2, (i * 3) % 4 * 2, i % 3, (i % 2) * 2)]) for i in range(120)]
    done = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), entries=8)
    want, digest = plain(rows, 8)
    assert sorted((r.vec_id, r.code, r.error) for r in done.rows.collect()) == want and done.sha256() == digest


def test_large_components_few_rows_and_none(spark):
    kinds = "vec_id long, embedding array<double>"
    rows = [(None, [1e300, -1e300, 5.0, 7.0]), (3, [1e5, 2.0, 3.0, 4.0]), (3, [0.5, 2.0, 3.0, 4.0])]
    done = codes.compress(spark.createDataFrame(rows, kinds))
    assert sorted(r.code for r in done.rows.collect()) == ["00000000", "01000000", "02020202"] and done.books.shape == (4, 3, 1)
    assert done.books[0, 2, 0] == 1 << 29 and all(r.error == 0 for r in done.rows.collect())
    assert codes.distances(np.array([[1 << 29, -(1 << 29)]]), np.array([[-(1 << 29), 1 << 29]])).tolist() == [[1 << 61]]
    none = codes.compress(spark.createDataFrame([], kinds))
    assert none.rows.count() == 0 and none.rows.columns == ["vec_id", "code", "error", "scans"]
    odd = codes.compress(spark.createDataFrame([(1, None)], kinds), carry=["vec_id"])
    assert odd.rows.count() == 0
