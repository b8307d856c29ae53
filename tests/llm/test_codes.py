import random

import numpy as np
import pytest

from crewspark.llm import codes as C

SCHEMA = "vec_id long, label int, embedding array<float>, code string, x int"


def test_search_is_exact_with_ties():
    rng = np.random.default_rng(3)
    for k, d, high in ((1, 3, 9), (16, 2, 4), (16, 8, 1000), (200, 4, 30), (256, 1, 5)):
        entries = rng.integers(-high, high, (k, d))
        x = rng.integers(-high, high, (3000, d))
        far = ((x[:, None, :] - entries[None]) ** 2).sum(2)
        best, near = C.Codebook(entries).search(x)
        assert (best == far.argmin(1)).all() and (near == far.min(1)).all()


def test_search_measures_few():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4096, 4096, (256, 2))
    book, measured = C.Codebook(centres), []
    plain = book.measure
    book.measure = lambda x, which: measured.append(len(which)) or plain(x, which)
    book.search(centres[rng.integers(0, 256, 5000)] + rng.integers(-20, 20, (5000, 2)))
    assert sum(measured) < 0.2 * 5000 * 256


def brute_force(rows, parts=8, entries=16, rounds=6):
    kept = [(v, lab, [int(np.floor(float(np.float32(c)) * 4096)) for c in e]) for v, lab, e in rows if e and not any(c is None or not np.isfinite(c) for c in e)]
    width = len(kept[0][2]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes()))[:entries]
    books = [[r[2][j * width:(j + 1) * width] for r in first] for j in range(parts)]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))

    def nearest(j, part):
        return min((far(part, e), i) for i, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            held = {}
            for _, _, x in kept:
                part = x[j * width:(j + 1) * width]
                held.setdefault(nearest(j, part)[1], []).append(part)
            for i, ps in held.items():
                books[j][i] = [sum(c) // len(ps) for c in zip(*ps)]
    out = []
    for v, lab, x in kept:
        found = [nearest(j, x[j * width:(j + 1) * width]) for j in range(parts)]
        out.append((v, lab, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    return sorted(out, key=str), books


@pytest.mark.parametrize("n", [5, 300])
def test_codes_equal_brute_force(frame, n):
    rnd = random.Random(n)
    rows = [(i * 2 + 1, rnd.choice([None, 1, 2]), [rnd.choice([rnd.gauss(0, 1), 0.5]) for _ in range(16)]) for i in range(n)]
    rows += [(-4, 1, None), (-3, 1, []), (-2, None, [None] + [0.0] * 15), (-1, 1, [float("nan")] * 16), (0, 1, [float("inf")] * 16), (9, 3, rows[2][2]), (None, 4, rows[1][2])]
    got, books = C.compress(frame([(*r, "c", 1) for r in rows], SCHEMA, 4))
    want, want_books = brute_force(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert [b.tolist() for b in books] == want_books
    back = {(r[0]): r[1] for r in C.decoded(got, books).collect()}
    assert len(back[1]) == 16 and abs(np.array(back[1]) - np.array(rows[0][2])).max() < 6


def test_other_lengths_large_values_and_no_rows(frame):
    rows = [(1, 1, [0.0] * 8), (2, 1, [1e30] * 8), (3, 1, [1.0] * 16), (4, 1, [1.0] * 7)]
    got, _ = C.compress(frame([(*r, "c", 1) for r in rows], SCHEMA))
    assert {r["vec_id"]: r["error"] for r in got.collect()} == {1: 0, 2: 0}
    got, books = C.compress(frame([], SCHEMA))
    assert got.count() == 0 and books == []
    with pytest.raises(ValueError):
        C.compress(frame([], SCHEMA), entries=257)


def test_query_sums_null_labels_together(spark, frame, tmp_path):
    rows = [(i, None if i % 2 else 7, [i / 10 + j for j in range(8)]) for i in range(40)]
    frame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = C.op12_orchard_vector_codes(spark, str(tmp_path)).collect()
    assert len(got) == 40
    for odd in (0, 1):
        part = [r for r in got if r["vec_id"] % 2 == odd]
        assert {r["label_error"] for r in part} == {sum(r["error"] for r in part)}
