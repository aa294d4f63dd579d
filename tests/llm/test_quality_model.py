import numpy as np

from tallyboard.llm import quality_model as q

SMALL = q.Settings(features=48, bins=200)


def table(spark, docs):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "en", "o", "ing", "er")]
    good = lambda: " ".join(rng.choice(words, rng.integers(20, 120))).capitalize() + "."
    bad = lambda: (rng.choice(words) + " ") * int(rng.integers(20, 120)) if rng.random() < 0.5 else " ".join(f"{w}$$$" for w in rng.choice(words, 40))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(600)]
    return docs(*rows), spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)], "doc_id long, label int")


def test_held_out_accuracy(spark, docs):
    data, labels = table(spark, docs)
    got = [r for r in q.score(data, labels, settings=SMALL).collect() if r["doc_id"] >= 400]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in got) >= 0.95 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_partition_sums_are_the_whole(spark, docs):
    data, labels = table(spark, docs)
    one, two = (q.fit(q.measured(data.repartition(n)), labels, SMALL) for n in (1, 7))
    assert np.allclose(one.weights, two.weights, atol=1e-6) and np.allclose(one.rates, two.rates, atol=1e-3)


def test_ridge_is_the_direct_solution(spark, docs):
    """The weights of every fold and of all, against least squares over the stacked rows with the penalty as rows of their own."""
    data, labels = table(spark, docs)
    stats = q.measured(data.repartition(40))
    model = q.fit(stats, labels, SMALL)
    known = stats.join(labels, "doc_id").selectExpr("stats", "label", f"cast(pmod(xxhash64(doc_id), {q.FOLDS}) as int) as fold").toPandas()
    everything = np.stack(stats.toPandas()["stats"].to_numpy()).astype(float)
    assert np.allclose(model.mean, everything.mean(0)) and np.allclose(model.scale**2, np.maximum(everything.var(0), 1e-8), atol=1e-6)
    z, y = model.features(np.stack(known["stats"].to_numpy()).astype(float)), known["label"].to_numpy(float)
    for k in range(q.FOLDS + 1):
        use = known["fold"].to_numpy() != k
        penalty = np.sqrt(SMALL.ridge) * np.eye(z.shape[1])
        direct = np.linalg.lstsq(np.concatenate([z[use], penalty]), np.concatenate([y[use], np.zeros(len(penalty))]), rcond=None)[0]
        assert np.allclose(model.weights[:, k], direct, atol=1e-6), k


def test_sums_are_added_in_a_tree(spark):
    """Partials of hundreds of partitions, some empty: each row once, no task or driver adds up more than eight."""
    rng = spark.range(0, 5000, 1, 600).filter("id % 50 < 30")
    total = q._summed(rng, lambda b: np.array([len(b), b["id"].sum()], float), (2,))
    assert total.tolist() == [3000, sum(i for i in range(5000) if i % 50 < 30)]
    assert q._summed(rng.filter("id < 0"), lambda b: np.ones(2), (2,)).tolist() == [0, 0]


def test_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(1)
    d, m, gamma = len(q.STATS), 20000, 0.05
    model = q.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, m)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, m), np.zeros((m + 1, 1)), 0, 1, np.ones(1))
    x = rng.normal(size=(5, d))
    z = model.features(x)[:, :-1]
    assert np.allclose(z @ z.T, np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=0.03)


def test_isotonic():
    assert np.allclose(q.isotonic(np.array([1, 0, 3, 2]), np.array([2, 2, 4, 2])), [0.25, 0.25, 0.75, 1.0])
    assert np.allclose(q.isotonic(np.array([4, 0, 0]), np.array([4, 4, 4])), [1 / 3] * 3)


def test_odd_texts_and_no_labels(spark, docs):
    data = docs((1, None), (2, ""), (3, "x" * 10000), (4, " \n "), (4, " \n "), (None, "a b"))
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [r["score"] for r in q.score(data, none, settings=SMALL).collect()] == [0.5] * 6
    one = spark.createDataFrame([(2, 1), (2, None), (77, 0)], "doc_id long, label int")
    assert all(r["predicted"] == 1 for r in q.score(data, one, settings=SMALL).collect())
    assert q.score(docs(), none, settings=SMALL).count() == 0


def test_statistics_do_not_depend_on_batches():
    a = "Some words, some words.\nSome lines\nSome lines\n1 % x"
    assert np.allclose(q.statistics(a), q.statistics(a)) and not q.statistics(" ").any() and not q.statistics(None).any()
