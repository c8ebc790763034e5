import numpy as np
import pytest

from adlake.llm import multi_index

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, part int, rep int"


def brute(rows, threshold):
    """(links, component) of each vector by all pairs."""
    ids = [r[0] for r in rows]
    good = [
        r[1] is not None and r[2] is not None and len(r[1]) > 0
        and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
        for r in rows
    ]
    linked = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[n][1], dtype=np.float32).astype(float) for n in (a, b))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    linked[a].append(b)
                    linked[b].append(a)
    component = list(ids)
    for _ in rows:
        component = [min([component[n], *(component[m] for m in linked[n])]) for n in range(len(rows))]
    return {ids[n]: (len(linked[n]), component[n]) for n in range(len(rows))}


def test_one_id_on_several_vectors(spark):
    """Every row has the links of its own vector."""
    near = [1.0, 0.01]
    rows = [(4, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (1, near, 1), (2, [1.0, -0.01], 1), (3, [0.01, 1.0], 1)]
    rows += [(None, [-1.0, 0.0], 1), (9, [-1.0, 0.01], 1), (None, [0.0, -1.0], 1)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in multi_index.link(df).collect()), key=str)
    want = [(4, 2, 1, False), (4, 1, 3, False), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True)]
    want += [(None, 1, 9, False), (9, 1, 9, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(60):
            base = rng.standard_normal(16)
            for _ in range(rng.integers(1, 6)):
                near = base + rng.standard_normal(16) * 0.04
                rows.append((500 - n, [float(v) for v in near * rng.uniform(0.5, 2)], label))
                n += 1
    rows += [(900 + k, rows[3][1], rows[3][2]) for k in range(5)]  # exact copies
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    rows += [(1100, rows[0][1], None), (1101, rows[0][1], 1), (1102, rows[0][1][:8], 0), (1103, rows[0][1][:8], 0)]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_links_and_components_equal_all_pairs(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in vectors], SCHEMA)
    want = brute(vectors, 0.98)
    got = multi_index.link(df).collect()
    assert len(got) == len(vectors)
    found = sum(r.n_links for r in got)
    assert 0.97 * sum(v[0] for v in want.values()) <= found <= sum(v[0] for v in want.values())
    assert all(r.n_links <= want[r.vec_id][0] for r in got)
    assert np.mean([r.component_id == want[r.vec_id][1] for r in got]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert {r.n_links for r in got if 1000 <= r.vec_id <= 1101} == {0}


def test_grid_follows_the_largest_label(spark):
    vectors = spark.range(2000).selectExpr(
        "id AS vec_id", "array(float(cos(id)), float(sin(id))) AS embedding",
        "int(if(id < 1000, 0, id)) AS label",
    )
    grid = multi_index.make_grids(multi_index.members_of(vectors), 0.98, 0.995, 8192)[2]
    assert len(grid.first) == len(grid.second) == round((1000 / multi_index.CELL_MEMBERS) ** 0.5)


def test_recall_on_a_grid_of_many_cells(spark, monkeypatch):
    """The table has no pair of one label at the threshold, so each vector gets a partner at
    0.98 to 1 in a random direction."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rng = np.random.default_rng(6)
    x = multi_index.unit(np.array([r.embedding for r in table], dtype=float))
    noise = rng.standard_normal(x.shape)
    noise = multi_index.unit(noise - (noise * x).sum(1)[:, None] * x)
    cosine = rng.uniform(0.98, 1, len(x))[:, None]
    x = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * noise]).astype(np.float32)
    labels = np.array([r.label for r in table] * 2)
    rows = [(n, v, int(label)) for n, (v, label) in enumerate(zip(x.tolist(), labels))]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")

    monkeypatch.setattr(multi_index, "CELL_MEMBERS", np.bincount(labels).max() / 20**2)
    grid = multi_index.make_grids(multi_index.members_of(vectors), 0.98, 0.995, 8192)[x.shape[1]]
    assert len(grid.first) >= 16 and len(grid.second) >= 16
    x = multi_index.unit(x.astype(float))
    want = ((x @ x.T >= 0.98) & (labels[:, None] == labels)).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in multi_index.link(vectors).collect()}
    found, wanted = sum(got.values()), int(want.sum())
    visited = multi_index.visits(multi_index.members_of(vectors), {x.shape[1]: grid}).count()
    print(f"{found} of {wanted} links; {grid.cells} cells, {visited / len(x):.1f} visited")
    assert wanted > 3000 and found >= 0.995 * wanted
    assert all(got[n] <= want[n] for n in got)


def test_traversal_visits_cells_in_order_of_cost():
    rng = np.random.default_rng(1)
    a, b = rng.random(7), rng.random(5)
    costs = (a[:, None] + b).ravel()
    want = [int(n) for n in np.argsort(costs, kind="stable") if costs[n] <= costs.min() + 0.6]
    assert multi_index.traverse(a, b, 0.6) == want


def test_slack_reaches_the_wanted_recall():
    rng = np.random.default_rng(2)
    x = multi_index.unit(rng.standard_normal((4000, 64)))
    grid = multi_index.build(x, 12, 0.98, 0.95)
    noise = rng.standard_normal(x.shape)
    noise = multi_index.unit(noise - (noise * x).sum(1)[:, None] * x)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * noise
    parts = [multi_index.squared(p, c) for p, c in zip(multi_index.halves(x), (grid.first, grid.second))]
    homes = [multi_index.squared(p, c).argmin(1) for p, c in zip(multi_index.halves(y), (grid.first, grid.second))]
    hit = [int(i) * 12 + int(j) in multi_index.traverse(p, q, grid.slack) for p, q, i, j in zip(*parts, *homes)]
    assert np.mean(hit) > 0.93


def test_empty_null_ids_and_repeats(spark):
    assert multi_index.link(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (5, [2.0, 0.01], 1)]
    got = multi_index.link(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got if r.n_links) == [
        ("4", 3, 4), ("4", 3, 4), ("5", 3, 4), ("None", 3, 4)
    ]
    assert [r.component_id for r in got if not r.n_links] == [None]
