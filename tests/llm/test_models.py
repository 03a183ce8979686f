"""Operators 6, 7, 9 and 10: held-out accuracy, recall against brute force, and the cases their docstrings define."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import language, neighbours, quality, toxicity
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.workers import find_package

SF = "/root/testdata/sf0.01"
ODD = [(10_001, None), (10_002, ""), (10_003, "12 !"), (10_004, "word " * 40_000), (10_004, "word " * 40_000), (None, "some text")]


def labelled(column):
    return {r["doc_id"]: r[column] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r[column] is not None}


@pytest.fixture
def odd(spark, table):
    find_package(spark)
    return table([(*r, 0.0, "x") for r in ODD], "doc_id long, text string, score double, lang string")


def test_quality(spark):
    known = labelled("quality")
    rows = [r for r in QUERIES["op6_quality"](spark, SF).collect() if r.doc_id in known and r.held_out]
    assert len(rows) > 40 and np.mean([known[r.doc_id] == r.predicted for r in rows]) > 0.97


def test_quality_of_odd_rows(spark, table, odd):
    labels = table([(10_003, 1), (10_004, 0), (None, 1), (10_002, 7)], "doc_id long, quality int")
    rows = quality.quality_scores(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.5 for r in quality.quality_scores(odd, labels.limit(0)).collect())
    assert quality.quality_scores(odd.limit(0), labels).count() == 0


def test_discriminant_is_the_difference_of_log_densities():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    by_class = {c: (50.0, rng.normal(size=d), np.cov(rng.normal(size=(d, 80)))) for c in (0, 1)}
    densities, x = quality.fit(by_class), rng.normal(size=(5, d))
    for density, (n, mean, _) in zip(densities.values(), by_class.values(), strict=True):
        cov = np.linalg.inv(density.inverse_factor) @ np.linalg.inv(density.inverse_factor).T
        wanted = np.log(n / 100) - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean))
        assert np.allclose(density.log_density(x), wanted)


def test_language(spark):
    known = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = [r for r in QUERIES["op9_language"](spark, SF).collect() if r.held_out]
    assert len(rows) > 200 and np.mean([known[r.doc_id] == r.lang_pred for r in rows]) > 0.97


def test_language_of_odd_rows(odd):
    rows = {(r.doc_id, r.lang_pred, r.score) for r in language.predict_languages(odd, None).collect()}
    assert rows == {(i, "und", 0.0) for i, _ in ODD}
    net = language.ByteConvNet(["a", "b"])
    got = [(r.doc_id, r.lang_pred) for r in language.predict_languages(odd, net).collect()]
    assert len(got) == len(ODD) and {i for i, p in got if p == "und"} == {10_001, 10_002, 10_003}
    assert language.predict_languages(odd.limit(0), net).count() == 0
    assert language.train_network(odd.limit(0)) is None


def test_gradients_are_those_of_the_loss():
    net = language.ByteConvNet(["a", "b", "c"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(1)
    windows, target = rng.integers(0, 256, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    loss = lambda: -np.mean(np.log(net._softmax(net.pooled(windows)[0])[np.arange(6), target]))
    gradients = net.gradients(windows, target, np.ones(6))
    for name, at in (("out", (3, 1)), ("filters", (2, 5)), ("bias", (4,)), ("embedding", (int(windows[0, 3]), 2))):
        value = net.weights[name][at]
        net.weights[name][at] = value + 1e-6
        up = loss()
        net.weights[name][at] = value - 1e-6
        slope = (up - loss()) / 2e-6
        net.weights[name][at] = value
        assert abs(slope - gradients[name][at]) < 1e-5


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.CharacterModel(toxicity.trigram_counts(spark.read.parquet(f"{SF}/documents.parquet")))


@pytest.mark.parametrize(
    "disguised, plain",
    [("tr@$h", "trash"), ("m0r0n", "moron"), ("s t u p i d", "stupid"), ("l.o.s.e.r", "loser"), ("stuuupid", "stupid"), ("$tupid", "stupid"), ("1d10t", "idiot")],
)
def test_disguise_is_undone(model, disguised, plain):
    assert model.restore(f"and {disguised} the") == f"and {plain} the"


@pytest.mark.parametrize(
    "disguised, plain",
    [
        ("idio7", "idiot"), ("m 0 r 0 n", "moron"), ("l.0.s.e.r", "loser"), ("s t u p 1 d", "stupid"), ("$ t u p i d", "stupid"), ("s  c  u  m", "scum"),
        ("stuupid", "stupid"), ("STUUPID", "STUPID"), ("st up id", "stupid"), ("st.up.id", "stupid"), ("you...m0ron", "you...moron"), ("-m0ron", "-moron"),
    ],
)
def test_mixed_disguise_is_undone(model, disguised, plain):
    """Signs behind letters and among letters set apart, wider gaps, doubled letters, syllables, starts behind punctuation."""
    assert model.restore(f"and {disguised} the") == f"and {plain} the"


def test_restoring_does_not_cross_texts_and_only_adds(model):
    column = pa.array(["and st", "up id", None, "", "st up id", "x stuupid " * 3])
    assert toxicity.restored_texts(column, model).to_pylist() == ["and st", "up id".replace(" ", ""), None, "", "stupid", "x stupid " * 3]
    assert toxicity.both_texts(column, model).to_pylist()[4] == "st up id\nstupid"


@pytest.mark.parametrize("text", ["call +1 (459) 555-7415 now", "a.b40@mail6.example.com", "1. first", "the th 3 and", "22.249.23.55", "x"])
def test_plain_text_stays(model, text):
    assert model.restore(text) == text


def test_toxicity(spark):
    known = labelled("toxic")
    rows = [r for r in QUERIES["op10_toxicity"](spark, SF).collect() if r.doc_id in known]
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert not [r for r in held if r.predicted and not known[r.doc_id]]
    assert sum(r.predicted for r in held) >= 0.4 * sum(known[r.doc_id] for r in held)


def test_toxicity_learns_the_word_and_not_its_neighbours(spark, table):
    find_package(spark)
    rows = [(k, f"some common words w{k} " + ("family text here badword" if k % 3 == 0 else "of others")) for k in range(90)]
    rows += [(200, "b a d w o r d"), (201, "family text here"), (202, "badwordish"), (203, "clean"), (204, None)]
    docs = table(rows, "doc_id long, text string")
    labels = table([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert got[0] == 1 and got[1] == 0 and got[203] == 0 and got[204] == 0


def test_toxicity_of_odd_rows(table, odd):
    labels = table([(10_004, 1), (None, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(odd, labels).count() == len(ODD)
    assert {r.score for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_scores(odd.limit(0), labels).count() == 0


def nearest(vectors, query, own, k=10):
    scored = sorted((float(np.sqrt(((np.array(v) - np.array(query)) ** 2).sum())), i) for i, v in vectors if i != own and len(v) == len(query))
    return scored[:k]


def test_recall(spark):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    vectors = [(r["vec_id"], r["embedding"]) for r in rows]
    got = {}
    for r in QUERIES["op7_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    hits = total = 0
    for i, v in vectors:
        if i % 100 == 0:
            mine = sorted(got[i])
            assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
            wanted = {j for _, j in nearest(vectors, v, i)}
            hits += len(wanted & {m[2] for m in mine})
            total += 10
    assert hits / total >= 0.95


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_merged_shards(spark, table, monkeypatch, clustered):
    find_package(spark)
    monkeypatch.setattr(neighbours, "SHARD_NODES", 500)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 24)) * (4 if clustered else 0)
    points = centres[rng.integers(0, 12, 2000)] + rng.normal(size=(2000, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points.astype(np.float32))]
    frame = table(rows, "vec_id long, embedding array<float>")
    index = neighbours.build_index(frame)
    assert index.select("shard").distinct().count() == 4 and index.agg({"n": "sum"}).first()[0] == 2000
    got = {}
    for r in neighbours.search(index, frame.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r["rank"]
    assert sorted(got) == list(range(0, 2000, 100)) and all(sorted(m.values()) == list(range(1, 11)) for m in got.values())
    hits = sum(len({j for _, j in nearest(rows, rows[q][1], q)} & set(m)) for q, m in got.items())
    assert hits / 200 >= 0.95


def test_query_blocks_are_sent_to_groups_of_shards_and_never_broadcast(spark, table, monkeypatch):
    """A block copied for every shard grew past what the driver may collect for a broadcast join."""
    find_package(spark)
    monkeypatch.setattr(neighbours, "SHARD_NODES", 60)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 4)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1200, 8)).astype(np.float32))]
    frame = table(rows, "vec_id long, embedding array<float>")
    index, queries = neighbours.build_index(frame), frame.where("vec_id % 100 = 0")
    results = []
    for together, per_core in ((32, 0), (7, 0), (32, 1), (32, 20)):  # one group of all 20 shards, 3 groups, one per core, slices too
        monkeypatch.setattr(neighbours, "SHARDS_TOGETHER", together)
        monkeypatch.setattr(neighbours, "TASKS_PER_CORE", per_core)
        found = neighbours.search(index, queries)
        plan = found._jdf.queryExecution().toString()
        assert "Join" not in plan and "Broadcast" not in plan
        results.append(sorted(map(tuple, found.collect())))
    assert len(results[0]) == 120 and all(r == results[0] for r in results)
    exact = {(q, j) for q in range(0, 1200, 100) for _, j in nearest(rows, rows[q][1], q)}
    assert len(exact & {(r[0], r[2]) for r in results[0]}) >= 0.95 * len(exact)


def test_queries_of_one_vector_are_several_blocks(spark, table, monkeypatch):
    find_package(spark)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 4)
    rows = [(100 * k, [1.0, 2.0]) for k in range(40)] + [(k, [1.0, 2.0 + k]) for k in range(1, 20)]
    frame = table(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest_neighbours(frame).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    copies = [100 * k for k in range(11)]
    for q in (100 * k for k in range(40)):
        assert [(i, s) for _, i, s in sorted(got[q])] == [(i, 0.0) for i in [c for c in copies if c != q][:10]]


def test_neighbours_of_odd_rows(spark, table):
    find_package(spark)
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [nan, 1.0]), (4, None), (5, [0.0, 0.0]), (6, []), (7, [None, 1.0])]
    rows += [(8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (100, [1.0, 0.0, 1.0]), (200, [1.0, float("inf")])]
    rows += [(k, [1.0, 0.0]) for k in range(10, 40)]
    frame = table([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest_neighbours(frame).collect())
    assert got == [(0, k + 1, i, 0.0) for k, i in enumerate([1, *range(10, 19)])] + [(100, 1, 8, 1.0)]
    assert neighbours.nearest_neighbours(frame.limit(0)).count() == 0
