import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidora.errors import ConfigError
from evidora.operators import insight, vectors
from evidora.shared import written


def frame(spark, rows):
    return spark.createDataFrame([(i, v.tolist(), int(b)) for i, (v, b) in enumerate(rows)], "id long, vector array<double>, block int")


def test_parts_give_the_exact_nearest_and_clusters(spark):
    rng = np.random.default_rng(2)
    data = [(rng.normal(size=6), rng.integers(3)) for _ in range(240)]
    v = frame(spark, data)
    got: dict = {}
    for r in vectors.nearest(v.filter("id % 5 = 0"), v, 4, "block", part=17).collect():
        got.setdefault(r.query, []).append((r["rank"], r.id))
    cos = lambda i, j: round(float(data[i][0] @ data[j][0] / np.linalg.norm(data[i][0]) / np.linalg.norm(data[j][0])), 6)
    for q in range(0, 240, 5):
        others = sorted((-cos(q, j), j) for j in range(240) if j != q and data[j][1] == data[q][1])[:4]
        assert [i for _, i in sorted(got[q])] == [j for _, j in others]
    root = list(range(240))
    for _ in range(240):
        for i in range(240):
            for j in range(i):
                if data[i][1] == data[j][1] and root[i] != root[j] and cos(i, j) >= 0.9:
                    root[i] = root[j] = min(root[i], root[j])
    edges = vectors.near_edges(v, 0.9, "block", part=17)
    labels = {r.node: r.label for r in insight.smallest_reachable(edges, written).collect()}
    assert {i: labels.get(i, i) for i in range(240)} == dict(enumerate(root)) and 3 < len(set(root)) < 240
    few = insight.clusters(v, 0.9, "block", written, count=20)
    assert few.select("cluster").distinct().count() == 20


ODD = [(900, None, 1), (901, [], 1), (902, [0.0] * 6, 1), (903, [None] * 6, 1), (904, [float("nan")] + [1.0] * 5, 1), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, [1.0] * 6, None)]


def test_vectors_without_direction_and_of_other_length(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), i % 2) for i in range(40)] + ODD
    v = spark.createDataFrame(rows, "id long, vector array<double>, block int").repartition(3)
    got = vectors.nearest(v, v, 3, "block", part=7).collect()
    assert {r.query for r in got} == {*range(40), 905, 906} and {(r.query, r.id) for r in got if r.query > 40} == {(905, 906), (906, 905)}
    assert all([set(r) for r in edges(v, 0.99, "block").collect()] == [{905, 906}] for edges in (vectors.near_edges, vectors.banded_edges))
    assert {r.cluster for r in insight.clusters(v, 0.99, "block", written).collect()} == {i for i, *_ in rows} - {906}
    like = {r.id: r.similarity for r in insight.seed_similarity(v, v.filter("id = 3 OR id = 902")).collect()}
    assert len(like) == len(rows) and abs(like[3] - 1) < 1e-9 and all(like[i] is None for i in range(900, 907)) and like[907] is not None


def test_many_seeds_are_compared_in_parts(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(1300, 6))
    v = spark.createDataFrame([(i // 2, x.tolist()) for i, x in enumerate(data)] + [(9000, [0.0] * 6), (9001, None)], "id long, vector array<float>").repartition(3)
    unit = data.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = sorted((i // 2, round(float(x), 6)) for i, x in enumerate((unit @ unit[200:].T).max(1)))
    got = insight.seed_similarity(v, v.filter("id >= 100"), part=300).collect()  # 1100 seeds, ids that repeat
    assert sorted((r.id, round(r.similarity, 6)) for r in got if r.similarity is not None) == want
    assert sorted(r.id for r in got if r.similarity is None) == [9000, 9001]
    assert all(r.similarity is None for r in insight.seed_similarity(v, v.filter("id >= 9000")).collect())
    with pytest.raises(ConfigError):
        insight.seed_similarity(v, v.filter("id > 640").union(spark.createDataFrame([(1, [1.0])], "id long, vector array<float>")))


def kruskal(data, count):
    """Cluster labels when the greatest similarities of each block are joined, ties by ids, until ``count`` clusters are left."""
    unit = [x / np.linalg.norm(x) for x, _ in data]
    pairs = sorted((-round(float(unit[i] @ unit[j]), 6), i, j) for i in range(len(data)) for j in range(i + 1, len(data)) if data[i][1] == data[j][1])
    root, left = list(range(len(data))), len(data)
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for _, i, j in pairs:
        if left == count:
            break
        a, b = sorted((find(i), find(j)))
        if a != b:
            root[b] = a
            left -= 1
    return {i: find(i) for i in range(len(data))}


@pytest.mark.parametrize("ties", [False, True])
def test_exact_numbers_of_clusters(spark, ties):
    rng = np.random.default_rng(6)
    data = [(rng.integers(-1, 2, size=4) + np.array([0.0, 0, 0, 3]) if ties else rng.normal(size=5), int(rng.integers(3))) for _ in range(90)]
    v = frame(spark, data)
    assert vectors.spanning_forest(v, "block", part=9).count() == 87
    for count in (4, 60) if ties else (3, 17, 90):
        got = {r.id: r.cluster for r in insight.clusters(v, 0.9, "block", written, count=count).collect()}
        assert len(set(got.values())) == count and got == kruskal(data, count)
    for count in (2, 91):
        with pytest.raises(ConfigError):
            insight.clusters(v, 0.9, "block", written, count=count)


def test_places_without_one_task(spark):
    rows = spark.range(500).select("id", (F.col("id") * 7919 % 101).alias("x")).repartition(7)
    got = [(r.x, r.id) for r in sorted(vectors.placed(rows, [F.desc("x"), F.asc("id")]).collect(), key=lambda r: r.place)]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) == 500
    assert vectors.placed(rows.filter("id < 0"), [F.asc("id")]).collect() == []


@pytest.mark.parametrize("dims", [3, 32])
def test_bands_find_the_pairs(spark, dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(700, dims)) @ rng.normal(size=(dims, 32))
    near = base[:300] + 0.12 * np.linalg.norm(base[:300], axis=1, keepdims=True) * rng.normal(size=(300, 32)) / np.sqrt(32) * 2
    data = [(x, 0) for x in np.concatenate([base, near, np.repeat(base[:1], 40, axis=0)])]
    v = frame(spark, data)
    exact = {r.node: r.label for r in insight.smallest_reachable(vectors.near_edges(v, 0.9, "block"), written).collect()}
    edges = vectors.banded_edges(v, 0.9, "block", part=50)
    assert all(exact.get(e.a, e.a) == exact.get(e.b, e.b) for e in edges.collect())  # none between groups
    got = {r.node: r.label for r in insight.smallest_reachable(edges, written).collect()}
    same = sum(exact.get(i, i) == got.get(i, i) for i in range(len(data)))
    assert same >= 0.99 * len(data) and len(exact) > 100


def test_a_worker_makes_few_copies_for_bands_at_once(spark, monkeypatch):
    monkeypatch.setattr(vectors, "written", lambda rows: rows)
    made = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, schema, _was=kind.mapInArrow: (made.append(run), _was(self, run, schema))[1])
    rng = np.random.default_rng(4)
    v = frame(spark, [(x, 0) for x in rng.normal(size=(3000, 8))])
    vectors.banded_edges(v, 0.6, "block").collect()
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": list(range(3000)), "vector": rng.normal(size=(3000, 8)).tolist(), "_group": ["8:0"] * 3000})
    bands = vectors.bands_for(0.6, 3000)[1]
    for run in made:
        sizes = [b.num_rows for b in run(iter([batch]))]
        assert sum(sizes) == 3000 * bands and max(sizes) <= vectors.COPIES < 3000 * bands


def test_clusters_pass_no_table_through_the_driver(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    v = frame(spark, [(x, 0) for x in np.random.default_rng(5).normal(size=(40, 4))])
    assert insight.clusters(v, 0.9, "block", written, count=7).select("cluster").distinct().count() == 7
    plans = store.executionsList()
    new = [plans.apply(k).physicalPlanDescription() for k in range(plans.size())][-(store.executionsCount() - before) :]
    assert len(new) > 10 and not any("BroadcastExchange" in x for x in new if "FlatMapGroupsInArrow" not in x)  # those with a row a block may


def test_work_of_bands_grows_slower_than_pairs():
    def work(n, threshold=0.9):
        bits, bands = vectors.bands_for(threshold, n)
        return bands * n * n / 2**bits  # pairs compared where directions are random
    assert math.log(work(5_000_000) / work(1_000_000), 5) < 1.3 and work(10**7) < 1e-2 * 10**14
    bits, bands = vectors.bands_for(0.9, 10**6)
    assert 0.5 * vectors.MISSED < (1 - (1 - math.acos(0.9) / math.pi) ** bits) ** bands <= vectors.MISSED


@pytest.mark.parametrize("dims", [2, 24])
def test_the_stored_index(spark, tmp_path, dims):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, dims)) @ rng.normal(size=(dims, 24))
    v = frame(spark, [(centres[rng.integers(60)] + 0.4 * rng.normal(size=24), 0) for _ in range(3000)])
    index = vectors.Index.make(v.filter("id < 2500"), f"{tmp_path}/index", lists=50, neighbours=5)
    index.add(v.filter("id >= 2000"))  # those from 2500 on are new
    again = vectors.Index(spark, f"{tmp_path}/index")  # another session finds it
    assert again._stored().count() == 3000 and 1 <= again.probes < 50 and again.lists == 50
    asked = v.filter("id % 20 = 0")
    want = {(r.query, r.id, r["rank"]) for r in vectors.nearest(asked, v, 5, "block").collect()}
    found = {(r.query, r.id, r["rank"]) for r in again.search(asked, 5).collect()}
    assert len(want) == 750 and len({x[:2] for x in found} & {x[:2] for x in want}) >= 0.9 * len(want)
    assert {(r.query, r.id, r["rank"]) for r in again.search(asked, 5, probes=1, exact=True).collect()} == want
    plan = again.pruned([3, 4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan and again.pruned([3, 4]).select(F.input_file_name()).distinct().count() <= 4
    with pytest.raises(FileExistsError):
        vectors.Index.make(v, f"{tmp_path}/index")


def test_an_index_of_odd_vectors(spark, tmp_path):
    rows = [(i, [float(i), 1.0, 2.0, 0.0, 0.0, 1.0], 1) for i in range(30)] + ODD
    v = spark.createDataFrame(rows, "id long, vector array<double>, block int")
    index = vectors.Index.make(v, f"{tmp_path}/a", lists=4)
    assert index._stored().count() == 31 and index.search(v, 2).filter("query = 0").count() == 2
    none = vectors.Index.make(v.filter("id = 900"), f"{tmp_path}/b")
    assert none.search(v, 2).collect() == [] and none.search(v, 2, exact=True).collect() == []
