"""Operators on embeddings against plain versions, on odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmill.llm import feast, hardneg, neardup, whitening

# Extra columns have the names that the operators use inside.
COLUMNS = (
    "vec_id long, embedding array<float>, label int, node int, h string, vector int, links string, window int,"
    " part int, y array<int>, id string, component string"
)
REST = (0, "h", 1, "l", 2, 3, [1], "i", "c")
D = 6


def odd_vectors(seed=3, n=160):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, D))
    rows = []
    for i in range(n):
        v = centers[i % 6] + rng.standard_normal(D) * (0.02 if i % 3 else 0.6)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4))))
    same = rows[5][1]
    rows += [(200 + i, list(same), 1) for i in range(40)]
    rows += [(300, None, 1), (301, [1.0, None] + [0.0] * (D - 2), 1), (302, [math.nan] * D, 1), (303, [math.inf] * D, 2)]
    rows += [(304, [0.0] * D, 2), (305, [-0.0] * D, 2), (306, [], 2), (307, same[:3], 1), (308, same[:3] + [0.0] * (D - 3), 1)]
    rows += [(309, list(same), None), (None, list(same), 1), (310, [1e6] * D, 3), (311, [-1e6] * D, 3)]
    rows += [rows[7], rows[7], (400, [0.5] * D, 0), (400, [0.25] * D, 0)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, *REST) for r in odd_vectors()], COLUMNS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def by_value(rows):
    """Rows in order, nulls first."""
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def wide(v):
    return np.array(list(v) + [0.0] * (D - len(v)))


def plain_links(rows, limit):
    """``[(id, links, component)]`` over all pairs of positions."""
    good = [i for i, (d, v, l) in enumerate(rows) if d is not None and l is not None and usable(v) and any(v)]
    unit = {i: wide(rows[i][1]) / np.linalg.norm(wide(rows[i][1])) for i in good}
    links = {i: [j for j in good if j != i and rows[j][2] == rows[i][2] and unit[i] @ unit[j] >= limit] for i in good}
    component = {i: rows[i][0] for i in good}
    while True:
        new = {i: min([component[i], *(component[j] for j in links[i])]) for i in good}
        if new == component:
            break
        component = new
    return by_value((d, len(links.get(i, ())), component.get(i, d)) for i, (d, _, _) in enumerate(rows))


@pytest.mark.parametrize("shard", [8_192, 30])
def test_near_duplicates_equal_all_pairs(monkeypatch, vectors, none, shard):
    monkeypatch.setattr(neardup, "SHARD_ROWS", shard)
    for limit in (0.93, 0.999):
        got = neardup.near_duplicates(vectors, limit).collect()
        want = plain_links(odd_vectors(), limit)
        assert by_value((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert neardup.near_duplicates(none).count() == 0


def test_searches_get_wider_until_the_audit_passes(monkeypatch):
    rng = np.random.default_rng(1)
    unit = neardup.unit_vectors(np.concatenate([rng.standard_normal((300, 8)), rng.standard_normal((1, 8)) + 0.05 * rng.standard_normal((400, 8))]))
    shard = neardup.Shard(np.arange(700), np.ones(700, int), unit, neardup.build(unit))
    truth = unit @ unit.T >= 0.9
    monkeypatch.setattr(neardup, "WIDTH", 1)
    monkeypatch.setattr(neardup, "MARGIN", 0.0)
    monkeypatch.setattr(neardup, "RECALL", 1.0)
    monkeypatch.setattr(neardup, "AUDITED", 700)
    assert (neardup._search(shard, shard, 0.9) == truth).all()
    # A graph whose parts do not know each other.
    shard.graph.layers[:] = [np.full_like(l, -1) for l in shard.graph.layers]
    assert (neardup._search(shard, shard, 0.9) == truth).all()


def test_a_failed_audit_costs_no_wider_search(monkeypatch):
    rng = np.random.default_rng(6)
    unit = neardup.unit_vectors(rng.standard_normal((1, 8)) + 0.05 * rng.standard_normal((300, 8)))
    shard = neardup.Shard(np.arange(300), np.ones(300, int), unit, neardup.build(unit))
    shard.graph.layers[:] = [np.full_like(l, -1) for l in shard.graph.layers]
    widths, around = [], neardup._around
    monkeypatch.setattr(neardup, "_around", lambda *a: widths.append(a[3]) or around(*a))
    assert (neardup._search(shard, shard, 0.9) == (unit @ unit.T >= 0.9)).all()
    assert set(widths) == {neardup.WIDTH}


def test_a_forest_connects_what_links_connect():
    linked = np.random.default_rng(2).random((40, 30)) < 0.03
    row, col = neardup._forest(linked)
    assert linked[row, col].all()

    def parts(pairs):
        root = list(range(70))
        for r, c in pairs:
            a, b = root[r], root[40 + c]
            root = [min(a, b) if x in (a, b) else x for x in root]
        return root

    assert parts(zip(row, col, strict=True)) == parts(zip(*np.nonzero(linked), strict=True))
    assert len(row) < 70


@pytest.mark.parametrize("kind", ["plain", "low rank", "repeated", "clustered", "wide range", "one"])
def test_contour_integration_finds_the_largest(kind):
    rng = np.random.default_rng(5)
    d = 1 if kind == "one" else 48
    a = np.cov(rng.standard_normal((12 if kind == "low rank" else 200, d)).T, bias=True).reshape(d, d)
    if kind == "repeated":
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        a = (q * np.repeat([4.0, 3.0, 2.0, 1.0], d // 4)) @ q.T
    if kind == "clustered":
        a = np.eye(d) + 1e-9 * a
    if kind == "wide range":
        scale = 10.0 ** np.linspace(0, -7, d)
        a = a * scale * scale[:, None]
    a = (a + a.T) / 2
    e, x = feast.largest(a, 16)
    want = np.linalg.eigvalsh(a)[::-1]
    assert len(e) == {"one": 1, "low rank": 11}.get(kind, 16)
    assert np.abs(e - want[: len(e)]).max() < 1e-13 * want[0]
    assert np.abs(a @ x - x * e).max() < 2e-12 * want[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a[:, 3] = 0
    a = a + a.T
    e = np.linalg.eigvalsh(a)
    for shift in (-5.0, -0.1, 0.0, 0.3, 7.0):
        assert feast.below(a, shift) == (e < shift).sum()
    assert feast.below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert feast.below(np.zeros((3, 3)), 0.0) == 0


def test_exact_products():
    rng = np.random.default_rng(7)
    for most in (100, 1 << 30, 1 << 45):
        y = rng.integers(-most, most, (50, 4))
        exact = y.astype(object)
        assert (whitening.gram(y) == exact.T @ exact).all()
        assert (hardneg.scores(y, y) == np.clip(exact @ exact.T, -hardneg.LARGEST, hardneg.LARGEST).astype(np.int64)).all()


def test_whitening_equals_the_definition(vectors, none, spark):
    rows = [(d, v) for d, v, _ in odd_vectors() if usable(v) and max(map(abs, v), default=0) < 100]
    tame = vectors.where("vec_id is null or vec_id not in (310, 311)")
    got = whitening.whiten(tame, 4).collect()
    x = np.array([np.floor(64 * wide(v)) for _, v in rows]).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1], w[:, ::-1]
    z = (x - s / n) @ w / np.sqrt(e)
    dev = ((n * x - s) ** 2).sum(axis=1)
    have = sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.deviation, round(abs(r.whitened), 6)) for r in got)
    want = sorted((-1 if d is None else d, k + 1, int(dev[i]), round(abs(z[i, k]), 6)) for i, (d, _) in enumerate(rows) for k in range(4))
    assert [h[:3] for h in have] == [w_[:3] for w_ in want]
    assert max(abs(h[3] - w_[3]) for h, w_ in zip(have, want, strict=True)) < 1e-5
    assert {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    for k in range(4):
        assert {round(r.explained, 9) for r in got if r.component == k + 1} == {round(e[k] / e.sum(), 9)}
    # Large entries are exact too; one distinct vector has no variance; neither has nothing.
    assert {r.component for r in whitening.whiten(vectors, 9).collect()} == set(range(1, D + 1))
    assert whitening.whiten(vectors.where("vec_id between 200 and 239"), 4).count() == 0
    assert whitening.whiten(none, 4).count() == 0
    far = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(far, 2).collect()} == {None, (3 * 128 - 192) ** 2}


def plain_negatives(rows, anchors, n_pos, n_neg, least, most):
    """By the definition, over all pairs."""
    good = {}
    for d, v, l in rows:
        if d is not None and l is not None and usable(v):
            row = (str(l), [int(math.floor(256 * x)) for x in wide(v)])
            good[d] = min(good.get(d, row), row)
    out = []
    for a in (d for d in good if anchors(d)):
        label, vector = good[a]
        by = sorted((-sum(x * y for x, y in zip(vector, v, strict=True)), d, l) for d, (l, v) in good.items() if d != a)
        for p, pos, _ in [b for b in by if b[2] == label][:n_pos]:
            hard = [b for b in by if b[2] != label and least * -p <= 100 * -b[0] <= most * -p][:n_neg]
            out += [(a, pos, k + 1, d, -p, -s) for k, (s, d, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("sample", [2_048, 20])
def test_hard_negatives_equal_all_pairs(monkeypatch, vectors, none, sample):
    monkeypatch.setattr(hardneg, "SAMPLE", sample)
    monkeypatch.setattr(hardneg, "WINDOW_ROWS", 12)
    monkeypatch.setattr(hardneg, "PART_ROWS", 7)
    for n_pos, n_neg in ((5, 10), (2, 1)):
        got = hardneg.mine(vectors, F.col("vec_id") % 5 == 0, n_pos, n_neg).collect()
        assert sorted(map(tuple, got)) == plain_negatives(odd_vectors(), lambda d: d % 5 == 0, n_pos, n_neg, 30, 90)
    assert hardneg.mine(none, F.col("vec_id") % 5 == 0).count() == 0
    assert hardneg.mine(vectors, F.lit(False)).count() == 0


def test_angles_bound_every_score():
    rng = np.random.default_rng(9)
    members = rng.integers(-300, 300, (200, 5))
    members[0] = 0
    rows = rng.integers(-300, 300, (50, 5))
    references = hardneg.directions(members, 6)
    norms, angles = hardneg.polar(members, references)
    for part in np.array_split(np.argsort(angles[:, 0]), 12):
        down, up = hardneg.score_bounds(
            *hardneg.polar(rows, references), angles[part].min(axis=0)[None], angles[part].max(axis=0)[None],
            norms[part].min()[None], norms[part].max()[None],
        )
        exact = hardneg.scores(rows, members[part])
        assert (down[:, :1] <= exact).all() and (exact <= up[:, :1]).all()


def test_only_overlapping_windows_are_asked():
    """Rows in two opposite directions: an anchor that looks for near scores is not sent to the far ones."""
    references = np.eye(3)[:2]
    ends = [hardneg.polar(np.array([x]), references)[1] for x in ([100, 1, 0], [-100, 1, 0])]
    windows = hardneg._Windows(
        references, (np.vstack(ends), np.vstack(ends), np.array([100.0, 100.0]), np.array([101.0, 101.0])),
        np.array([1, 1]), np.zeros(0, object), np.zeros(0, np.int64), np.zeros((0, 3), np.int64),
    )
    asked = windows.overlapping(np.array([[90, 0, 0]]), np.array([[5_000]]), np.array([[10_000]]))
    assert asked.tolist() == [[True, False]]
