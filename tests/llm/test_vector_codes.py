"""Vector codes against plain integer k-means."""

import numpy as np
import pytest

from millrace.llm import vector_codes as V
from tests.llm.data import ordered


def brute(rows, entries, rounds):
    good = [(i, l, v) for i, l, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    if not good:
        return [], None
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) for c in v] for _, _, v in good], object)
    wide = x.shape[1] // 4
    books, codes = [], []
    for p in range(4):
        part = x[:, p * wide:(p + 1) * wide]
        book = [list(r) for r in part[:entries]]

        def nearest():
            return [min(range(len(book)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(r, book[j])), j)) for r in part]

        for _ in range(rounds):
            own = nearest()
            for j in range(len(book)):
                mine = [r for r, o in zip(part, own) if o == j]
                if mine:
                    book[j] = [sum(c) // len(mine) for c in zip(*mine)]
        own = nearest()
        books.append(book)
        codes.append([(o, sum((a - b) ** 2 for a, b in zip(r, book[o]))) for r, o in zip(part, own)])
    out, per_label = [], {}
    for k, (i, label, _) in enumerate(good):
        error = sum(c[k][1] for c in codes)
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, label, "".join(f"{c[k][0]:02x}" for c in codes), error))
    return [(*r, per_label[r[1]]) for r in out], books


def frame(spark, rows):
    return spark.createDataFrame([(i, l, v, "c", 1) for i, l, v in rows], "vec_id long, label int, embedding array<float>, id string, state int").repartition(3)


def awkward(seed, n, width=8, spread=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(0, spread, (5, width))
    rows = [(int(i), [None, 0, 1, 2][i % 4], [float(np.float32(c)) for c in centres[i % 5] + pick.normal(0, 0.1, width)]) for i in pick.permutation(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(n + 1, 1, None), (n + 2, 1, [nan] * width), (n + 3, None, [inf] + [0.0] * (width - 1)), (n + 4, 0, [None] + [1.0] * (width - 1))]
    rows += [(None, 3, [0.25] * width), (None, 3, [-0.25] * width), rows[0], rows[0], (n + 9, 2, [0.0] * width), (-5, 2, [0.0] * width)]
    return rows


@pytest.mark.parametrize("entries,n,spread", [(16, 150, 1.0), (16, 150, 0.0), (256, 60, 1.0), (1, 30, 1.0)])
def test_codes_against_integer_k_means(spark, monkeypatch, entries, n, spread):
    monkeypatch.setattr(V, "BLOCK_ROWS", 17)
    rows = awkward(n + entries, n, spread=spread)
    got, books = V.vector_codes(frame(spark, rows), entries=entries)
    expected, reference = brute(rows, entries, V.ROUNDS)
    assert books.tolist() == reference
    assert ordered(got.collect()) == ordered(expected)


def test_no_vector_at_all(spark):
    for rows in ([], [(1, 2, None)], [(1, 2, [float("nan")] * 8)]):
        got, books = V.vector_codes(frame(spark, rows))
        assert got.collect() == [] and got.columns == ["vec_id", "label", "code", "error", "label_error"] and books.size == 0


def test_lengths_and_ranges_are_checked(spark):
    for vectors in ([[1.0] * 6], [[1.0] * 8, [1.0] * 4], [[1e9] * 8]):
        with pytest.raises(Exception, match="vectors need one length|components must be below"):
            V.vector_codes(frame(spark, [(i, 0, v) for i, v in enumerate(vectors)]))[0].collect()


def test_bounds_stay_right_while_entries_move_and_b_shrinks():
    pick = np.random.default_rng(5)
    for size in (2, 30, 4000):
        x = pick.integers(-size, size, (400, 4))
        entries = x[:40].copy()
        state, b = V.Bounds.fresh(x, entries, 12), 12
        for r in range(6):
            moved = entries + pick.integers(-2 - r, 3 + r, entries.shape)
            shift = np.sqrt(((moved - entries) ** 2).sum(1).astype(float)) * V._ABOVE
            entries = moved
            state, need = V.Bounds.unpack(state.pack()).moved(shift).assign(x, entries, b)
            far = V.distances(x, entries)
            assert (state.own == far.argmin(1)).all()
            roots = np.sqrt(far.astype(float))
            assert (state.low <= np.take_along_axis(roots, state.listed.astype(int), 1)).all()
            rest = roots.copy()
            np.put_along_axis(rest, np.column_stack([state.own, state.listed]).astype(int), np.inf, 1)
            assert (state.outer <= rest.min(1)).all()
            assert need.max() <= state.listed.shape[1] + 1
            b = max(3, b - 2)


def test_bounds_save_comparisons():
    pick = np.random.default_rng(6)
    x = pick.normal(0, 300, (2000, 8)).astype(np.int64)
    entries = x[:64].copy()
    state = V.Bounds.fresh(x, entries, 12)
    moved = entries + pick.integers(-2, 3, entries.shape)
    _, need = state.moved(np.sqrt(((moved - entries) ** 2).sum(1).astype(float)) * V._ABOVE).assign(x, moved, 12)
    assert (need == 0).mean() > 0.5 and (need > 12).mean() < 0.05
    histogram = np.bincount(need, minlength=V.LISTED + 2).tolist()
    assert V.FEWEST <= V.adapted(histogram, 12) <= 12
