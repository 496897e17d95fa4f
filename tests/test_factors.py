import numpy as np

from shelfwise.operators import factors, ranking, signals

PARAMS = factors.FactorParams(rank=6, iterations=8, regularisation=0.05, alpha=40.0, blocks=2)


def test_customers_get_products_of_their_own_kind(spark):
    """Two groups of customers that never share a product end up with vectors that tell them apart."""
    rng = np.random.default_rng(2)
    pairs = [(c, int(p) + 20 * (c % 2), 3.0) for c in range(60) for p in rng.choice(20, 8, replace=False)]
    ratings = spark.createDataFrame(pairs, "customerId int, productId int, rating double")
    model = factors.train(ratings, PARAMS)
    items, users = factors.item_factors(model), factors.user_factors(model)
    assert items.columns == users.columns == ["id", "factors"] and items.count() == 40
    top = ranking.top_items(users, items, 5).collect()
    assert all((r.similarId >= 20) == (r.id % 2 == 1) for r in top)
    same = [(r.id < 20) == (r.similarId < 20) for r in ranking.similar_items(items, items, 8).collect()]
    assert np.mean(same) > 0.95


def test_training_is_repeatable(spark):
    ratings = spark.createDataFrame([(i % 9, i % 7, 1.0 + i % 3) for i in range(63)], "customerId int, productId int, rating double")
    ratings = signals.signal_ratings(ratings.coalesce(1))
    one, two = (sorted((r.id, tuple(np.round(r.factors, 4))) for r in factors.item_factors(factors.train(ratings, PARAMS)).collect())
                for _ in range(2))
    assert one == two


def test_loss_falls_and_equals_the_sum_over_all_pairs(spark):
    rng = np.random.default_rng(4)
    r = np.where(rng.random((30, 17)) < 0.2, rng.integers(1, 4, (30, 17)), 0).astype(float)
    r[:, 16] = r[29] = 0  # neither a customer nor a product of the training
    rows = [(int(u), int(i), float(r[u, i])) for u, i in zip(*np.nonzero(r))]
    ratings = spark.createDataFrame(rows, "customerId int, productId int, rating double")
    losses = []
    for n in (1, 2, 3, 6):
        model = factors.train(ratings, factors.FactorParams(rank=4, iterations=n, regularisation=0.1, alpha=10.0, blocks=2))
        users, items = factors.user_factors(model), factors.item_factors(model)
        losses.append(factors.implicit_loss(ratings, users, items, 0.1, 10.0).first().loss)
        x, y = (np.zeros((size, 4)) for size in r.shape)
        for matrix, side in ((x, users), (y, items)):
            for row in side.collect():
                matrix[row.id] = row.factors
        # Vectors of unknown ids are zero, so their pairs add nothing to the sum over all pairs.
        seen = r > 0
        whole = ((1 + 10 * r) * (seen - x @ y.T) ** 2).sum() + 0.1 * (
            (seen.sum(1) * (x ** 2).sum(1)).sum() + (seen.sum(0) * (y ** 2).sum(1)).sum())
        assert np.isclose(losses[-1], whole, rtol=1e-6)
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.95 * losses[0]


def test_loss_without_ratings(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "id int, factors array<float>")
    none = spark.createDataFrame([], "customerId int, productId int, rating double")
    assert factors.implicit_loss(none, vectors, vectors, 0.1, 1.0).first().loss == 25.0
    assert factors.implicit_loss(none, vectors.limit(0), vectors, 0.1, 1.0).first().loss == 0.0


def test_wide_vectors_and_cohorts(spark, as_rows):
    df = spark.createDataFrame([(1, [0.5, 1.5]), (2, [2.5, 3.5])], "id int, factors array<float>")
    assert as_rows(factors.vectors_wide(df, 2)) == [(1, 0.5, 1.5), (2, 2.5, 3.5)]
    both = factors.union_cohorts({"male": df, "female": df.filter("id = 1")})
    assert as_rows(both, "id", "gender") == [(1, "F"), (1, "M"), (2, "M")]
    people = spark.createDataFrame([(1, "g1"), (3, "g3")], "customerId int, guid string")
    assert as_rows(factors.with_customer_guid(df, people), "guid") == [("g1",)]
