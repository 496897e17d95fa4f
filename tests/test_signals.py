import random

from shelfwise.operators import products, signals
from shelfwise.sources import tolerant

GUID = "customerId int, guid string, productId int, sourceId int, signalDate bigint"


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_weights(spark, as_rows):
    df = spark.createDataFrame([(i,) for i in range(0, 9)], "s int")
    assert [r[0] for r in df.select(signals.rating_of("s")).collect()] == [0, 3, 2, 2, 2, 2, 2, 1, 0]


def test_parse_signals_drops_bad_lines(spark, as_rows):
    good = "12|345|678|9|2|1|2019-03-04T05:06:07.030000000|900|3.25|x|1|2019-03-04T11:21:00"
    df = tolerant.parse_signals(lines(
        spark, good, "", "x|1|0|7|2|1|2019-03-04", "1|x|0|7|2|1|2019-03-04", "1|1|0|7|10|1|2019-03-04",
        "1|1|0|7|2|1|2019-99-04", "1|1|0", "-1|1|0|7|2|1|2019-03-04"))
    assert as_rows(df, "customerId", "productId", "sourceId", "rating", "useForRecs") == [(12, 345, 2, 2.0, 1)]


def test_parse_customers(spark, as_rows):
    df = tolerant.parse_customers(lines(
        spark, "1\tA\tF\tChad, Republic of\t\t\t1979\t0", "2\tA\tF\tUK\t1\t2\t1979", "x\tA\tF\tUK\t1\t2\t1979\t0",
        "3\tA\tF\tUK\t1\t2\t1979\t0\t9", "4\tA\tF\tUK\t1\t2\t1979\t"))
    assert as_rows(df) == [(1,)]


def test_parse_flags(spark, as_rows):
    assert as_rows(tolerant.parse_flags(lines(spark, "1\t1", "2\t0", "1\t1", "x\t1", "3"))) == [(1,)]


def test_priority_is_lowest_source_then_latest_date(spark, as_rows):
    df = spark.createDataFrame([(1, "1", 1, 1, 2), (1, "1", 1, 1, 1), (1, "1", 1, 2, 3), (1, "1", 1, 3, 4)], GUID)
    assert as_rows(signals.prioritise(df)) == [(1, "1", 1, 1, 2)]


def test_priority_groups_by_guid(spark, as_rows):
    df = spark.createDataFrame([(1, "1", 1, 1, 3), (2, "1", 1, 2, 3), (3, "2", 1, 3, 4), (0, "2", 1, 3, 4)], GUID)
    assert as_rows(signals.prioritise(df)) == [(0, "2", 1, 3, 4), (1, "1", 1, 1, 3)]


def test_priority_signals_equal_the_direct_rule(spark, as_rows):
    facts = spark.range(4000).selectExpr(
        "cast(id % 7 as int) as customerId", "cast(id * 31 % 5 as int) as productId",
        "cast(id * 17 % 8 as int) as sourceId", "id * 7919 % 1000 * 1000 as signalDate")
    people = spark.createDataFrame([(i, f"g{i % 4}") for i in range(6)], "customerId int, guid string")
    direct = signals.signal_output(signals.prioritise(signals.with_guid(facts, people)))
    assert as_rows(signals.priority_signals(facts, people)) == as_rows(direct)


def test_one_customer_with_a_third_of_all_signals(spark, as_rows):
    facts = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 1, id % 40) as customerId", "id % 100 as productId", "cast(id % 8 as int) as sourceId", "id as signalDate")
    people = spark.range(30).selectExpr("id as customerId", "concat('g', id) as guid")
    best = {}
    for i in range(3000):
        customer, product, source = (1 if i % 3 == 0 else i % 40), i % 100, i % 8
        if customer < 30:
            best[customer, product] = min(best.get((customer, product), (99, 0)), (source, -i))
    got = signals.prioritise(signals.with_guid(signals.latest_per_source(facts), people))
    assert {(r.customerId, r.productId): (r.sourceId, -r.signalDate) for r in got.collect()} == best


def test_dated_and_known_signals_come_first(spark, as_rows):
    facts = spark.createDataFrame([(1, 10, 1, None), (1, 10, 1, 5), (1, 11, None, 9), (1, 11, 7, None), (1, 12, None, None), (2, 10, 1, 5)],
                                  "customerId bigint, productId int, sourceId int, signalDate bigint")
    people = spark.createDataFrame([(1, "g"), (2, "g")], "customerId bigint, guid string")
    got = signals.prioritise(signals.with_guid(facts, people))
    assert as_rows(got, "customerId", "productId", "sourceId", "signalDate") == [(1, 10, 1, 5), (1, 11, 7, None), (1, 12, None, None)]


def test_any_source_is_a_source(spark, as_rows):
    df = spark.createDataFrame([(1, "a", 1, 40000, 5), (2, "a", 1, 50000, 9), (3, "b", 1, -5, 1), (4, "b", 1, 0, 9), (5, "c", 1, None, 9),
                                (6, "c", 1, 2147483647, None), (9, "d", 1, 3, 2**60), (8, "d", 1, 3, 2**60), (7, "d", 1, 3, -2**60)], GUID)
    assert as_rows(signals.prioritise(df)) == [(1, "a", 1, 40000, 5), (3, "b", 1, -5, 1), (6, "c", 1, 2147483647, None), (8, "d", 1, 3, 2**60)]


def test_priority_against_sorting(spark, as_rows):
    rng = random.Random(5)
    some = lambda *v: rng.choice([None, *v])
    rows = [(some(1, 2, 3), some("g", "h"), some(1, 2), some(-2**31, 0, 7, 2**31 - 1), some(-3, 5, 2**62)) for _ in range(400)]
    got = as_rows(signals.prioritise(spark.createDataFrame(rows, GUID)))
    best = {}
    for c, g, p, s, d in rows:
        key = (s is None, s or 0, d is None, -(d or 0), c is None, c or 0)
        if (g, p) not in best or key < best[g, p][0]:
            best[g, p] = key, (c, g, p, s, d)
    assert got == sorted((row for _, row in best.values()), key=repr)


def test_signal_aggregates_are_hash_aggregates(spark, capsys):
    facts = spark.range(10).selectExpr("id as customerId", "id as productId", "1 as sourceId", "id as signalDate")
    people = spark.range(10).selectExpr("id as customerId", "cast(id as string) as guid")
    signals.priority_signals(facts, people).explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_training_ratings(spark, as_rows):
    facts = spark.createDataFrame(
        [(1, 10, 7, "d", 0), (1, 10, 1, "d", 1), (1, 11, 2, "d", 1), (2, 10, 2, "d", 1), (1, 99, 1, "d", 1), (1, 10, 10, "d", 1)],
        "customerId int, productId int, sourceId int, signalDate string, useForRecs int")
    valid = signals.valid_signals(facts)
    people = spark.createDataFrame([(1,)], "customerId int")
    items = spark.createDataFrame([(10,), (11,)], "productId int")
    assert as_rows(signals.training_ratings(valid, people, items)) == [(1, 10, 3.0), (1, 11, 2.0)]
    assert as_rows(signals.training_ratings(valid.filter("sourceId <> 1"), people, items, True)) == [(1, 11, 2.0)]


def test_latest_rows(spark, as_rows, capsys):
    rng = random.Random(3)
    some = lambda *v: rng.choice([None, *v])
    rows = [(some("k", "l", "m"), some(1, 2), some("a", "b"), some(0.5, -1.0)) for _ in range(80)] + [("hot", i % 5, "z", float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "sku string, changed int, name string, price double")
    best = {}
    for row in rows:
        key = [(v is not None, v if v is not None else 0) for v in (row[1], row[2] or "", row[3])]
        key[1] = (row[2] is not None, row[2] or "")
        if row[0] not in best or key > best[row[0]][0]:
            best[row[0]] = key, row
    latest = products.latest_rows(df, "sku", "changed")
    latest.explain()
    plan = capsys.readouterr().out
    assert latest.columns == df.columns and as_rows(latest) == sorted((r for _, r in best.values()), key=repr)
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2  # before the shuffle and after it


def test_latest_products_and_eligibility(spark, as_rows):
    df = spark.createDataFrame(
        [(1, 5, 0, 10, 3), (1, 9, 1, 10, 3), (2, 1, 0, 10, 3), (3, 1, 0, 546, 3), (4, 1, 0, 10, 0), (5, 1, 0, None, 3)],
        "productId int, dateModified bigint, isExcluded int, daysOnSite int, stockLevel int")
    latest = products.latest_products(df)
    assert latest.columns == df.columns and latest.filter("productId = 1").first().isExcluded == 1
    flagged = spark.createDataFrame([(i,) for i in range(9)], "productId int")
    assert as_rows(products.eligible_items(latest, flagged, 545)) == [(2,)]
