import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import paths, times

BASE = 1551675967000  # 2019-03-04T05:06:07Z


def one(spark, column, text=None):
    return spark.createDataFrame([(text,)], "s string").select(column.alias("v")).first().v


@pytest.mark.parametrize("text, expected", [
    ("2019-03-04T05:06:07", BASE), ("2019-03-04 05:06:07", BASE), ("2019-03-04T05:06:07.030000000", BASE),
    (" 2019-03-04 05:06:07 ", BASE), ("2019-03-04", None), ("2017-02-30T00:00:00", None), ("", None), (None, None),
])
def test_iso_to_millis(spark, text, expected):
    assert one(spark, times.iso_to_millis("s"), text) == expected


@pytest.mark.parametrize("text, expected", [
    ("2011-02-03T04:05:06.250Z", 1296705906250), ("2011-02-03T04:05:06.250+0200", 1296705906250),
    ("1296705906250", 1296705906250), ("nonsense", None), ("", None), (None, None),
])
def test_single_pattern_keeps_millis_and_never_fails(spark, text, expected):
    assert one(spark, times.utc_millis("s", "yyyy-MM-dd'T'HH:mm:ss.SSSX"), text) == expected


def test_single_pattern_strict_fails(spark):
    with pytest.raises(Exception, match="not a date: nonsense"):
        one(spark, times.utc_millis("s", "yyyy-MM-dd'T'HH:mm:ss.SSSX", strict=True), "nonsense")


@pytest.mark.parametrize("text, expected", [
    ("2019-03-04T05:06:07.99", BASE), ("04/03/2019 05:06:07", BASE), (str(BASE), BASE), ("", None), (None, None),
])
def test_pattern_list(spark, text, expected):
    assert one(spark, times.utc_millis("s", ["dd/MM/yyyy HH:mm:ss"]), text) == expected


@pytest.mark.parametrize("text, strict", [("rubbish", False), ("rubbish", True), ("", True), (None, True)])
def test_pattern_list_fails(spark, text, strict):
    with pytest.raises(Exception, match="no known form of a date: "):
        one(spark, times.utc_millis("s", ["dd/MM/yyyy"], strict), text)


def test_millis_round_trip(spark):
    text = times.millis_to_text(F.lit(BASE).cast("bigint"))
    assert one(spark, text) == "2019-03-04T05:06:07"
    assert one(spark, times.iso_to_millis(text)) == BASE


@pytest.mark.parametrize("text, valid", [
    ("2019-03-04T05:06:07.030000000", True), ("2019-03-04", True), ("2019-03-04 05:06:07", False),
    ("2019-13-04", False), ("", False), (None, False),
])
def test_is_valid_date(spark, text, valid):
    assert one(spark, times.is_valid_date("s"), text) is valid


def test_small_conversions(spark):
    assert one(spark, times.date_path("s"), "2019-03-04T05:06:07") == "2019/03/04"
    assert one(spark, times.reformat_date("s", "dd/MM/yyyy", "yyyy-MM"), "04/03/2019") == "2019-03"
    assert one(spark, times.safe_int("s"), "x") == -1
    assert one(spark, times.safe_int("s"), "12") == 12
    with pytest.raises(ValueError):
        times.date_part("s", "ww")


def millis(*ymd):
    return int(dt.datetime(*ymd, tzinfo=dt.timezone.utc).timestamp() * 1000)


def listed(spark, fn, start, end, *args):
    bounds = [F.lit(millis(*d)).cast("bigint") for d in (start, end)]
    return one(spark, fn("/b", *bounds, *args))


def test_day_paths(spark):
    assert listed(spark, paths.day_paths, (2017, 1, 30), (2017, 1, 31)) == [
        "/b/yy=2017/mm=01/dd=30", "/b/yy=2017/mm=01/dd=31"]
    # Swapped bounds; whole months only strictly between the first and the last.
    got = listed(spark, paths.day_paths, (2017, 4, 2, 10), (2016, 12, 30, 23), paths.PLAIN_FORMATS)
    assert got == ["/b/2016/12/30", "/b/2016/12/31", "/b/2017/01/*", "/b/2017/02/*", "/b/2017/03/*",
                   "/b/2017/04/01", "/b/2017/04/02"]
    assert listed(spark, paths.day_paths, (2017, 1, 31), (2017, 2, 1)) == [
        "/b/yy=2017/mm=01/dd=31", "/b/yy=2017/mm=02/dd=01"]


def test_month_paths(spark):
    assert listed(spark, paths.month_paths, (2016, 11, 30), (2017, 1, 1)) == [
        "/b/yy=2016/mm=11/*", "/b/yy=2016/mm=12/*", "/b/yy=2017/mm=01/*"]


def test_path_helpers(spark):
    assert paths.make_path("a", "b", "/c") == paths.make_path("a/", "/b", "c") == "a/b/c"
    assert paths.format_path("f-%d-%02d-%02d", dt.date(2017, 3, 4)) == "f-2017-03-04"
    assert paths.format_path("plain", dt.date(2017, 3, 4)) == "plain"
    assert paths.month_globs("p/", dt.date(2017, 1, 6), 1) == ["p/yy=2017/mm=01/dd=*/", "p/yy=2016/mm=12/dd=*/"]
    assert paths.days_back(dt.date(2017, 3, 1), 2) == [dt.date(2017, 3, 1), dt.date(2017, 2, 28)]
    df = spark.createDataFrame([("wasbs://my-box@acct.blob.core.windows.net/a/b",), ("wasb://$root@acct.blob.core.windows.net/",), ("s3://x/y",), (None,)], "p string")
    assert [tuple(r) for r in df.select(*paths.cloud_path_parts("p")).collect()] == [
        ("my-box", "acct", "a/b"), ("$root", "acct", ""), (None, None, None), (None, None, None)]
