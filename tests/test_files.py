import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.errors import DataParseError
from shelfwise.functions import codec
from shelfwise.operators import partitioning
from shelfwise.plans import pointer, runner
from shelfwise.sinks import files
from shelfwise.sources import csv_schema, feeds, promotions_xml, ranges, schemas, tolerant

MS = 1551675967000  # 2019-03-04T05:06:07Z


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_feed_widths():
    assert {f.name: len(f.schema) for f in feeds.FEEDS.values()} == {
        "customer": 8, "product": 25, "variant": 13, "receipt": 31, "return": 27, "signals": 12}


def test_customers_from_text_and_parquet(spark, tmp_path):
    path = write(tmp_path / "c.csv",
                 "1\tG1\tF\tChad, Republic of\t2019-03-04T05:06:07.250Z\t\\N\t1979\t0\n2\tG2\tM\tUK\tbroken\t5\t\\N\t1\n")
    df = feeds.load_text(spark, "customer", path, "\t")
    first, second = sorted(df.collect())
    assert (first.dateEntered, first.dateModified, first.shippingCountry) == (MS + 250, None, "Chad, Republic of")
    assert (second.dateEntered, second.dateModified, second.yearOfBirth) == (None, 5, None)
    files.save(df, str(tmp_path / "pq"), 1)
    again = feeds.load_parquet(spark, "customer", str(tmp_path / "pq"))
    assert sorted(again.collect()) == [first, second]
    raw = feeds.load_text(spark, "customer", path, "\t", raw=True, num_partitions=3)
    assert raw.rdd.getNumPartitions() == 3 and raw.schema["dateEntered"].dataType.typeName() == "string"


def test_signals_are_strict(spark, tmp_path):
    line = "12|345|678|9|2|1|{}|900|3.25||1|2019-03-04T11:21:00\n"
    good = write(tmp_path / "good", "\n" + line.format("2019-03-04T05:06:07.030000000"))
    row = feeds.load_text(spark, "signals", good, "|").first()
    assert (row.signalDate, row.price, row.customerId) == (MS, 3.25, 12)
    bad = write(tmp_path / "bad", line.format("yesterday"))
    with pytest.raises(Exception, match="no known form of a date: yesterday"):
        feeds.load_text(spark, "signals", bad, "|").collect()


@pytest.mark.parametrize("name, dates", [
    ("product", {"dateOnSite": "2019-03-04T05:06:07.25", "dateModified": ""}),
    ("variant", {"dateModified": "2019-03-04 05:06:07.250"}),
    ("receipt", {"dateEntered": "2019-03-04 05:06:07.9", "dateModified": "2019-03-04 05:06:07"}),
    ("return", {"returnsDateKey": "2019-03-04 05:06:07", "receiptDateKey": "2019-03-04 05:06:07", "dateEntered": "",
                "dateModified": "2019-03-04T05:06:07"}),
])
def test_other_feeds(spark, tmp_path, name, dates):
    feed = feeds.FEEDS[name]
    cells = [dates.get(f.name, "1" if f.dataType.typeName() != "boolean" else "true") for f in feed.schema]
    df = feeds.load_text(spark, name, write(tmp_path / "f", "|".join(cells) + "\n"), "|")
    files.save(df, str(tmp_path / "pq"), 1)
    expected = {c: MS if v else None for c, v in dates.items()}
    for row in (df.first(), feeds.load_parquet(spark, name, str(tmp_path / "pq")).first()):
        assert {c: row[c] for c in dates} == expected


def test_product_views_with_cr_lines_and_bom(spark, tmp_path):
    line = "55|66|0|7|{}|1|2019-03-04T21:42:05|5|21||1|2019-03-05T11:58:21|2|1|0|0|0|0|us|x|0|0|0"
    path = write(tmp_path / "v", b"\xef\xbb\xbf" + (line.format(7) + "\r" + line.format(10) + "\r").encode())
    lines = tolerant.signal_lines(spark, [path], line_sep="\r")
    assert [tuple(r)[:3] for r in tolerant.parse_signals(lines).collect()] == [(55, 66, 7)]


SCHEMA = {
    "name": "s", "mode": "PERMISSIVE", "delimiter": ",", "header": True, "nullValue": "NA", "dateFormat": "dd/MM/yyyy",
    "piiFields": "email", "partitionByDateCol": "day", "partitionByDateOn": "yy,mm", "unknownSetting": 1,
    "fields": [{"name": "id", "dataType": "IntegerType", "nullable": False}, {"name": "email", "dataType": "StringType"},
               {"name": "day", "dataType": "StringType"}, {"name": "n", "dataType": "DoubleType"}]}


def schema(**changes):
    return csv_schema.CsvSchema.from_json(json.dumps({"schemaDefinition": {**SCHEMA, **changes}}))


def test_csv_conversion(spark, tmp_path):
    path = write(tmp_path / "in.csv", "id,email,day,n\n1,a@b,04/03/2019,2.5\n2,c@d,NA,NA\n")
    spec = schema(changeDateFormats=True, sourceDateFormat="dd/MM/yyyy", targetDateFormat="yyyyMMdd", dateFormatChangeCols="day")
    csv_schema.convert_to_parquet(spark, path, str(tmp_path / "out"), spec, 1)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id")
    assert got.columns == ["id", "day", "n", "yy", "mm"]
    assert [tuple(r) for r in got.collect()] == [(1, "20190304", 2.5, 2019, 3), (2, None, None, None, None)]
    assert spec.partition_columns() == ["yy", "mm"]
    assert schema(partitionByDateCol="", partitionByDateOn="", partitionByCol="id").partition_columns() == ["id"]


@pytest.mark.parametrize("changes", [
    {"partitionByCol": "id"}, {"partitionByDateCol": "", "partitionByDateOn": "", "partitionByCol": "email"},
    {"partitionByDateOn": ""}, {"partitionByDateCol": "email"}, {"partitionByDateOn": "yy,ww"}, {"mode": ""},
    {"mode": "LENIENT"}, {"changeDateFormats": True}, {"changeDateFormats": True, "sourceDateFormat": "y"},
    {"changeDateFormats": True, "sourceDateFormat": "y", "targetDateFormat": "y"},
    {"fields": [{"name": "id", "dataType": "MapType"}]}, {"fields": None},
])
def test_csv_schema_rules(changes):
    with pytest.raises(ValueError):
        schema(**changes)


LINES = "id,email,day,n\n1,a@b,04/03/2019,2.5\nx,c@d,05/03/2019,1\n3,e@f,06/03/2019,1,more\n4,g@h\n5,i@j,07/03/2019,oops\n"


def test_csv_modes(spark, tmp_path, as_rows):
    path = write(tmp_path / "in.csv", LINES)
    plain = {"partitionByDateCol": "", "partitionByDateOn": ""}
    loose = csv_schema.load_with_schema(spark, path, schema(piiFields="", **plain), corrupt_record="line")
    assert as_rows(loose, "id", "email", "day", "n", "line") == sorted([
        (1, "a@b", "04/03/2019", 2.5, None), (None, "c@d", "05/03/2019", 1.0, "x,c@d,05/03/2019,1"),
        (3, "e@f", "06/03/2019", 1.0, "3,e@f,06/03/2019,1,more"), (4, "g@h", None, None, "4,g@h"),
        (5, "i@j", "07/03/2019", None, "5,i@j,07/03/2019,oops")], key=repr)
    assert as_rows(csv_schema.load_with_schema(spark, path, schema(mode="DROPMALFORMED", **plain))) == [(1, "04/03/2019", 2.5)]
    # A personal column is not read, so what it holds spoils no line.
    typed = schema(mode="DROPMALFORMED", piiFields="n", **plain)
    assert as_rows(csv_schema.load_with_schema(spark, path, typed), "id") == [(1,), (5,)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv_schema.load_with_schema(spark, path, schema(mode="FAILFAST", **plain)).collect()


def test_lines_are_judged_by_their_number_of_columns_whatever_is_read(spark, tmp_path):
    path = write(tmp_path / "in.csv", LINES)
    got = csv_schema.load_with_schema(spark, path, schema(mode="DROPMALFORMED", partitionByDateCol="", partitionByDateOn=""))
    assert [r.id for r in got.select("id").collect()] == [1, 5]


def test_lines_that_do_not_fit_show_no_personal_data(spark, tmp_path):
    path = write(tmp_path / "in.csv", LINES)
    got = csv_schema.load_with_schema(spark, path, schema(), corrupt_record="line")
    assert got.columns == ["id", "day", "n", "line", "yy", "mm"]
    shown = [r.line for r in got.collect() if r.line]
    assert len(shown) == 4 and all(len(x) == 64 and "@" not in x for x in shown)
    for changes in ({"mode": "FAILFAST"}, {"mode": "DROPMALFORMED"}):
        with pytest.raises(DataParseError):
            csv_schema.load_with_schema(spark, path, schema(**changes), corrupt_record="line")
    with pytest.raises(DataParseError):
        csv_schema.load_with_schema(spark, path, schema(), corrupt_record="n")


def test_an_append_can_be_repeated(spark, tmp_path, as_rows):
    day = 24 * 3600 * 1000
    df = spark.createDataFrame([(i, MS + (i % 4) * day) for i in range(40)], "id int, at bigint")
    base = str(tmp_path / "days")
    by_day = lambda d: partitioning.partition_by_millis(d, "at")
    for _ in range(2):
        files.save_partitioned(df.filter("id < 20"), base, 2, by_day, run_id="first")
    files.save_partitioned(df.filter("id >= 20"), base, 2, by_day, run_id="second")
    files.save_partitioned(df.filter("id < 20"), base, 2, by_day, run_id="first")
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == list(range(40))
    assert as_rows(spark.read.parquet(base).groupBy("run").count()) == [("first", 20), ("second", 20)]
    assert sorted(r.id for r in ranges.load_range(spark, base, MS, MS).collect()) == list(range(0, 40, 4))
    files.save_partitioned(df.filter("id < 20"), base, 2, by_day, fmt="csv", run_id="other")
    assert (tmp_path / "days" / "yy=2019" / "mm=03" / "dd=04" / "run=other").exists()


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 0.5), (2, "a b", 1.0)], "id int, s string, v double")
    files.save_both(df, str(tmp_path / "pq"), str(tmp_path / "txt"), 1)
    assert spark.read.text(str(tmp_path / "txt")).collect()[0].value == r"1|\N|0.5"
    files.save_both(df, str(tmp_path / "pq2"), "", 1)
    vectors = spark.createDataFrame([(7, [0.5, -1.0])], "id int, factors array<float>")
    assert files.item_factor_lines(vectors).first().value == "7,0.5,-1.0"
    assert tuple(files.user_factor_table(vectors).first()) == (7, "0.5,-1.0")
    assert files.item_b64_lines(vectors.selectExpr("*", "'M' as gender")).first().value == "7\tM\tPwAAAL+AAAA="
    assert files.user_b64_lines(vectors.selectExpr("'g' as guid", "factors")).first().value == "g\tPwAAAL+AAAA="
    scores = spark.createDataFrame([(1, 2, 0.5)], "id int, similarId int, score double")
    encoded = files.similarity_b64_lines(scores).selectExpr("cast(split(value, '\t')[0] as int) as id", "split(value, '\t')[1] as data")
    assert [tuple(r) for r in codec.decode_pairs(encoded).collect()] == [(1, 2, 0.5)]


def test_partitioned_append_and_range_reads(spark, tmp_path):
    day = 24 * 3600 * 1000
    df = spark.createDataFrame([(i, MS + (i - 5) * day) for i in range(40)], "id int, at bigint")
    base = str(tmp_path / "days")
    by_day = lambda d: partitioning.partition_by_millis(d, "at")
    files.save_partitioned(df.filter("id < 20"), base, 2, by_day)
    files.save_partitioned(df.filter("id >= 20"), base, 2, by_day)
    ids = lambda d: sorted(r.id for r in d.select("id").collect())
    ranged = ranges.load_range(spark, base, MS + 30 * day, MS - 2 * day)
    assert ranges.load_range(spark, base, 0, day).count() == 0
    with pytest.raises(ranges.NoDataError):
        ranges.load_range(spark, base, 0, day, required=True)
    assert ids(ranged) == list(range(3, 36))
    assert "PartitionFilters: [" in ranged._jdf.queryExecution().toString()
    assert ids(ranges.load_range_paths(spark, base, MS - 2 * day, MS + 30 * day)) == list(range(3, 36))
    assert ids(ranges.load_last_days(spark, base, dt.date(2019, 3, 4), 3)) == [3, 4, 5]
    assert ids(spark.read.parquet(base).filter(ranges.in_months(dt.date(2019, 3, 4), 0))) == list(range(2, 33))
    with pytest.raises(ranges.NoDataError):
        ranges.load_range_paths(spark, base, 0, day)
    files.save_partitioned(df, str(tmp_path / "csv"), 1, by_day, fmt="csv")
    assert spark.read.csv(str(tmp_path / "csv"), sep="|").count() == 40


def test_a_hot_day_is_split_over_tasks(spark, tmp_path):
    """Half of all rows are of one day; with small advisory sizes several tasks write it."""
    df = spark.range(200_000).selectExpr("id", "if(id % 2 = 0, 0, id % 20) * 86400000 as at", "sha2(cast(id as string), 256) as s")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        files.save_partitioned(df, str(tmp_path / "d"), 8, lambda d: partitioning.partition_by_millis(d, "at"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    count = lambda day: len(list((tmp_path / f"d/yy=1970/mm=01/dd={day:02d}").glob("*.parquet")))
    assert count(1) > 3 and min(count(d) for d in range(2, 21, 2)) <= 2
    assert spark.read.parquet(str(tmp_path / "d")).count() == 200_000


def test_text_range_in_plain_folders(spark, tmp_path):
    line = "{}|176|0|7|2|1|2019-03-04T05:06:07|900|3.25||1|2019-03-04T11:21:00\n"
    for d in (3, 4, 6):
        write(tmp_path / f"2019/03/0{d}/f", line.format(d))
    df = ranges.load_range_text(spark, "signals", str(tmp_path), MS, MS + 2 * 24 * 3600 * 1000, "|")
    assert sorted(r.customerId for r in df.collect()) == [4, 6]


def test_date_columns(spark):
    df = spark.createDataFrame([("2019-03-04T05:06:07",)], "iso string")
    names, parts = partitioning.partition_by_date(df, "iso")
    assert names == ["yy", "mm", "dd"] and tuple(parts.first())[1:] == ("2019", "03", "04")
    parts = partitioning.add_date_parts(df, "iso", ["mn", "hh", "yy"], "yyyy-MM-dd'T'HH:mm:ss")
    assert parts.columns == ["iso", "mn", "hh", "yy"] and tuple(parts.first())[1:] == ("06", "05", "2019")


def test_time_slices(spark, as_rows):
    slices = partitioning.time_slices(MS, "day:0:1,week:long:1:7")
    day = partitioning.DAY_MS
    assert slices == [("day", "", MS - day, MS), ("week", "long", MS - 7 * day, MS - day)]
    df = spark.createDataFrame([(MS,), (MS - 1,), (MS - day,), (MS - 8 * day,)], "at bigint")
    assert as_rows(partitioning.assign_slices(df, "at", slices), "at", "sliceName") == sorted(
        [(MS - 1, "day"), (MS - day, "day")], key=repr)
    for wrong in ("day:1", "a:b:c:1:2", ""):
        with pytest.raises(ValueError):
            partitioning.time_slices(MS, wrong)


XML = """<?xml version="1.0" encoding="utf-8"?>
<Export Batch="1"><Header><Format>X</Format></Header>
 <Promotion Seq="1" TransactionType="Add">
  <PromotionOverview><PromotionID>P1</PromotionID><StartDate>03/02/2021</StartDate><EndDate>04/05/2021</EndDate>
   <PromotionLongDescription>Less &amp;more on
   lamps </PromotionLongDescription><BadgeRef></BadgeRef></PromotionOverview>
  <ProductSets>
   <ProductSet Seq="1"><ProductSetID>1</ProductSetID><LowerBuyQuantity>1</LowerBuyQuantity><UpperBuyQuantity></UpperBuyQuantity>
    <GetQuantity>1</GetQuantity><RewardOption>No Discount</RewardOption><RewardValue></RewardValue>
    <Products><ProductCode Seq="1">
        100
      </ProductCode><ProductCode Seq="2">101</ProductCode></Products></ProductSet>
   <ProductSet Seq="2"><LowerBuyQuantity>1</LowerBuyQuantity><GetQuantity></GetQuantity>
    <RewardOption>Percentage Off</RewardOption><RewardValue CountryCode="UK" CurrencyCode="GBP">50.00</RewardValue>
    <Products><ProductCode Seq="1">200</ProductCode></Products></ProductSet>
  </ProductSets>
  <BasketRewardRules><RewardType></RewardType><RewardOption></RewardOption><RewardValue></RewardValue></BasketRewardRules>
 </Promotion>
</Export>"""


def test_promotion_xml(spark, tmp_path):
    docs = promotions_xml.load_promotions_xml(spark, write(tmp_path / "p.xml", XML))
    row = docs.first()
    assert docs.count() == 1 and row.promoId == "P1" and row.description.startswith("Less &more on")
    assert (row.startDate, row.endDate) == (dt.datetime(2021, 2, 3), dt.datetime(2021, 5, 4))
    assert [tuple(s) for s in row.productSets] == [
        (1, 1, "No Discount", None, ["100", "101"]), (1, None, "Percentage Off", 50.0, ["200"])]
    assert tuple(row.basket) == (None, None)
    empty = write(tmp_path / "e.xml", '<?xml version="1.0"?><Export Batch="1"><Header/></Export>')
    assert promotions_xml.load_promotions_xml(spark, empty).count() == 0


def test_existing_promotions(spark, tmp_path):
    path = write(tmp_path / "e.json", json.dumps([{
        "lastUpdated": 1, "stackingRules": {"stackingRule": {"type": "Combines"}, "promotionPriority": 0},
        "descriptor": {"id": "u", "name": "n", "description": "d", "expression": "e"},
        "dateRange": {"from": "2018-11-02T03:04:05.003Z", "to": "2019-11-02T03:04:05.002Z"},
        "promotionExpression": {"type": "OrderLevelPromotion", "x": {"y": 1}}, "created": 2}]))
    row = promotions_xml.load_existing_promotions(spark, path).first()
    assert (row.name, row.stackingRule, row.priority, row.created) == ("n", "Combines", 0, 2)
    assert json.loads(row.promotionExpression)["type"] == "OrderLevelPromotion"
    assert row.startDate == dt.datetime(2018, 11, 2, 3, 4, 5, 3000)


def test_pointer_file(spark, tmp_path):
    base = {"modelName": "factors", "modelType": "nightly", "sliceStart": "2019-03-04T15:16:17"}
    assert pointer.pointer_file(base) == (
        "/factors/pointer_20190304_151617.tsv", "factors\tnightly\tall\tall\tall\t5")
    full = {**base, "store": "UK", "origin": "app", "mvt": "v2", "retentionDays": "10"}
    assert pointer.pointer_file(full).content == "factors\tnightly\tUK\tapp\tv2\t10"
    assert (pointer.path_name("*"), pointer.path_name("uk")) == ("all", "uk")
    pointer.run(spark, {**base, "basePath": str(tmp_path)})
    assert spark.read.text(str(tmp_path / "factors" / "*")).first().value == "factors\tnightly\tall\tall\tall\t5"


def test_job_arguments(spark):
    assert runner.named_args(["a=1", "path=x/yy=2019", "flag"]) == {"a": "1", "path": "x/yy=2019"}
    seen = []
    runner.run_job(lambda s, a: seen.append(a), ["a=1"], stop=False)
    assert seen == [{"a": "1"}]
    with pytest.raises(runner.JobArgumentError, match="b, c"):
        runner.need({"a": "1"}, "a", "b", "c")

    def broken(spark, args):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        runner.run_job(broken, [], stop=False)


def test_number_of_files_does_not_narrow_the_stage_before(spark, tmp_path):
    rows = spark.range(0, 8000, 1, 8).select("id", F.spark_partition_id().alias("task"))
    files.save(rows, f"{tmp_path}/p", 2)
    files.save_text(rows, f"{tmp_path}/t", "|", 3)
    files.save_lines(rows.select(F.col("task").cast("string").alias("value")), f"{tmp_path}/l", 2)
    assert [len(list((tmp_path / d).glob("part-*"))) for d in "ptl"] == [2, 3, 2]
    assert spark.read.parquet(f"{tmp_path}/p").select("task").distinct().count() == 8
    assert spark.read.text(f"{tmp_path}/l").distinct().count() == 8


def test_timestamp_column_and_broken_document(spark, tmp_path):
    document = {"s": {"name": "n", "mode": "PERMISSIVE", "dateFormat": "dd/MM/yyyy HH:mm", "partitionByDateCol": "at", "partitionByDateOn": "yy,mm,hh",
                      "fields": [{"name": "id", "dataType": "IntegerType"}, {"name": "at", "dataType": "TimestampType"}]}}
    path = write(tmp_path / "t.csv", "1,04/03/2019 05:06\n")
    row = csv_schema.load_with_schema(spark, path, csv_schema.CsvSchema.from_json(json.dumps(document))).first()
    assert (row["at"], row.yy, row.mm, row.hh) == (dt.datetime(2019, 3, 4, 5, 6), "2019", "03", "05")
    with pytest.raises(DataParseError):
        csv_schema.CsvSchema.from_json("{broken")
