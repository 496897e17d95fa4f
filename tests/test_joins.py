from shelfwise.operators import joins, segments
from pyspark.sql import functions as F


def test_a_group_with_nine_rows_in_ten_stays_even(spark):
    """At 200 tasks no task gets much more than its share, whatever the group."""
    rows = spark.range(200_000).selectExpr("if(id % 10 = 0, id % 97, -1) as segment", "id as sku")
    tasks = 200
    salts = joins.group_salts(rows, ["segment"], tasks)
    assert [s[0] for s in salts] == [-1] and salts[0][1] == round(0.9 * tasks * joins.SALTS_PER_SHARE)
    salt = F.when(F.col("segment") == -1, F.pmod(F.xxhash64("sku"), F.lit(salts[0][1]))).otherwise(0)
    dealt = rows.withColumn("salt", salt).repartition(tasks, "segment", "salt").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 3 * 200_000 / tasks


def test_salted_join_is_a_join(spark, as_rows):
    rows = spark.range(3000).selectExpr("cast(if(id % 3 = 0, null, if(id % 3 = 1, 0, id % 50)) as int) as g", "if(id % 7 = 0, null, id) as x")
    groups = spark.range(60).selectExpr("cast(if(id = 59, null, id) as int) as g", "id * 2 as y").filter("y <> 10")
    for how in ("inner", "left", "left_semi", "left_anti"):
        for tasks in (1, 4, 200):
            got = joins.salted_join(rows, groups, ["g"], "x", how, tasks=tasks)
            want = rows.join(groups, ["g"], how)
            assert got.columns == want.columns and as_rows(got) == as_rows(want)


def test_measured_groups(spark):
    rows = spark.createDataFrame([("a", 1)] * 50 + [("b", 1)] * 30 + [("c", i) for i in range(20)], "g string, h int")
    assert dict(joins.group_salts(rows, ["g"], 4)) == {"a": 16, "b": 10}
    assert {r[:2]: r[2] for r in joins.group_salts(rows, ["g", "h"], 4)} == {("a", 1): 16, ("b", 1): 10}
    assert joins.group_salts(rows, ["g"], 1) == joins.group_salts(rows.limit(0), ["g"], 4) == []


def test_changes_of_a_hot_segment(spark, as_rows):
    """One segment with nine tenths of all products, at many tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        new = spark.range(2000).selectExpr("if(id % 10 = 0, concat('s', id % 30), 'hot') as segment", "cast(id as string) as sku")
        old = spark.range(1000, 2500).selectExpr("if(id % 10 = 0, concat('s', id % 60), 'hot') as segment", "cast(id as string) as sku")
        got = as_rows(segments.segment_changes(new, old))
        left, right = ({(r.segment, r.sku) for r in df.collect()} for df in (new, old))
        known = {s for s, _ in right}
        want = [(s, k, "add" if s in known else "create") for s, k in left - right]
        want += [(s, k, "remove") for s, k in right - left if s in {x for x, _ in left}]
        assert got == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
