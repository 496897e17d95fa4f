"""The jobs end to end on small feeds of our own."""

import base64
import datetime as dt
import json

import numpy as np
import pytest

from shelfwise.plans import (
    compute_factors, convert_csv, export_base64, export_text, filterable_signals, ingest_promotions)
from shelfwise.sinks import files
from shelfwise.sources import exports, feeds
from test_files import SCHEMA, XML, write

TODAY = dt.date(2019, 3, 4)
RANK, ITEMS, PEOPLE = 16, 40, 60
UNFLAGGED, OLD, NO_STOCK, EXCLUDED = {3, 7}, {11, 12}, {20}, {21}


def signal(customer, product, source, date="2019-03-04T05:06:07.030000000"):
    return f"{customer}|{product}|0|7|{source}|1|{date}|900|3.25||1|2019-03-04T11:21:00"


def product(i):
    on_site = TODAY - dt.timedelta(days=546 if i in OLD else 545)
    cells = {"productId": i, "dateOnSite": f"{on_site}T00:00:00", "dateModified": "2019-03-01T00:00:00",
             "stockLevel": 0 if i in NO_STOCK else 5, "isExcluded": int(i in EXCLUDED)}
    return "|".join(str(cells.get(f.name, "1")) for f in feeds.FEEDS["product"].schema)


@pytest.fixture(scope="module")
def retail(tmp_path_factory):
    base = tmp_path_factory.mktemp("retail")
    people = [f"{i}\t{i:032X}\t{'FM'[i % 2]}\tUK\t2011-02-03T04:05:06.000Z\t2012-02-03T04:05:06.000Z\t1979\t0"
              for i in range(PEOPLE)]
    rng = np.random.default_rng(1)
    lines = [signal(c, p, 1 + c % 2) for c in range(PEOPLE) for p in rng.choice(ITEMS, 12, replace=False)]
    lines += [signal(999, 1, 1), signal(1, 999, 1), "broken"]
    write(base / "customers/c.csv", "\n".join(people + ["bad line"]) + "\n")
    write(base / "products/p.csv", "\n".join([product(i) for i in range(ITEMS)] + ["x|y"]) + "\n")
    write(base / "flags/f.tsv", "".join(f"{i}\t{int(i not in UNFLAGGED)}\n" for i in range(ITEMS)))
    write(base / "signals/receipts/yy=2019/mm=02/dd=04/a.csv", "\n".join(lines[:300]) + "\n")
    write(base / "signals/receipts/yy=2019/mm=03/dd=04/a.csv", "\n".join(lines[300:]) + "\n")
    write(base / "signals/receipts/yy=2018/mm=12/dd=04/a.csv", signal(1, 39, 1) + "\n")
    return base


def train_args(base, out, **changes):
    return {
        "todaysDate": "2019-03-04", "signalMonths": "1", "maxDaysOnSite": "545", "rank": str(RANK), "numIterations": "2",
        "alpha": "400", "lambda": "0.1", "numRecs": "10", "useExistingModel": "false", "blocks": "2",
        "customerPath": f"{base}/customers", "productPath": f"{base}/products", "isRecommendedPath": f"{base}/flags",
        "signalsPath": f"{base}/signals/*/", "prodSimPath": f"{out}/prodSim", "prodFactorsPath": f"{out}/prodFactors",
        "userFactorsPath": f"{out}/userFactors", "modelPath": f"{out}/model", **changes}


@pytest.fixture(scope="module")
def trained(spark, retail):
    out = retail / "out"
    compute_factors.run(spark, train_args(retail, out, cohorts="true"))
    return out


def test_recommendations_respect_eligibility(spark, trained):
    similar = spark.read.parquet(*(f"{trained}/prodSim/{c}" for c in compute_factors.COHORTS))
    barred = UNFLAGGED | OLD | NO_STOCK | EXCLUDED
    assert {r.id for r in similar.select("id").distinct().collect()} >= barred
    assert not {r.similarId for r in similar.select("similarId").distinct().collect()} & barred
    assert similar.filter("id = similarId or score <= 0").count() == 0
    assert similar.groupBy("id", similar.score * 0 + 1).count().count() == ITEMS
    factors = spark.read.parquet(f"{trained}/prodFactors/male")
    assert {r.id for r in factors.select("id").collect()} == set(range(ITEMS)) - barred
    assert spark.read.parquet(f"{trained}/userFactors/male").count() == PEOPLE // 2


def test_similar_lists_are_the_best_dot_products(spark, trained):
    model = compute_factors.factors.ALSModel.load(f"{trained}/model/female")
    vectors = {r.id: np.array(r.features, dtype=float) for r in model.itemFactors.collect()}
    allowed = {r.id for r in spark.read.parquet(f"{trained}/prodFactors/female").collect()}
    got = {}
    for r in spark.read.parquet(f"{trained}/prodSim/female").collect():
        got.setdefault(r.id, []).append((-r.score, r.similarId))
    for i, v in vectors.items():
        ranked = sorted((-float(v @ vectors[j]), j) for j in allowed)[:10]
        assert [j for s, j in ranked if j != i and s < 0] == [j for _, j in sorted(got[i])]


def test_existing_model_is_reused(spark, retail, trained, tmp_path):
    args = train_args(retail, tmp_path, useExistingModel="true", modelPath=f"{trained}/model", cohorts="true")
    compute_factors.run(spark, args)
    key = ["id", "similarId"]
    a, b = (spark.read.parquet(f"{d}/prodSim/male").select(*key) for d in (trained, tmp_path))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_base64_exports_hold_the_stored_values(spark, retail, trained, tmp_path):
    export_base64.run(spark, {
        "cohorts": "true", "userPartitions": "3", "customersInput": f"{retail}/customers", "userFactorsInput": f"{trained}/userFactors",
        "productFactorsInput": f"{trained}/prodFactors", "productSimilarityInput": f"{trained}/prodSim",
        "userFactorsOutput": f"{tmp_path}/u", "productFactorsOutput": f"{tmp_path}/p", "productSimilarityOutput": f"{tmp_path}/s"})
    lines = lambda name: [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/{name}").collect()]
    stored = {f"{r.id:032X}": r.factors for c in compute_factors.COHORTS
              for r in spark.read.parquet(f"{trained}/userFactors/{c}").collect()}
    users = {guid: np.frombuffer(base64.b64decode(data), ">f4").tolist() for guid, data in lines("u")}
    assert users == stored and all(len(g) == 32 for g in users)
    items = lines("p")
    assert {tag for _, tag, _ in items} == {"M", "F"} and all(len(base64.b64decode(d)) == 4 * RANK for *_, d in items)
    scores = {}
    for c in compute_factors.COHORTS:
        for r in spark.read.parquet(f"{trained}/prodSim/{c}").collect():
            scores.setdefault(str(r.id), set()).add((r.similarId, float(np.float32(r.score))))
    for i, data in lines("s"):
        pairs = np.frombuffer(base64.b64decode(data), np.dtype([("id", ">i4"), ("score", ">f4")]))
        assert {(int(a), float(b)) for a, b in pairs} == scores[i]
        assert all(np.diff(pairs["score"].astype(float)) <= 0)
    assert exports.load_similarities(spark, f"{tmp_path}/s").count() == sum(len(v) for v in scores.values())
    assert {r.guid: r.factors for r in exports.load_user_vectors(spark, f"{tmp_path}/u").collect()} == stored
    read = exports.load_item_vectors(spark, f"{tmp_path}/p").filter("gender = 'F'").select("id", "factors")
    assert sorted(map(tuple, read.collect())) == sorted(
        map(tuple, spark.read.parquet(f"{trained}/prodFactors/female").collect()))


def test_text_exports_are_optional(spark, trained, tmp_path):
    export_text.run(spark, {"cohorts": "true", "productFactorsInput": f"{trained}/prodFactors", "productFactorsOutput": f"{tmp_path}/p",
                            "userFactorsInput": f"{trained}/userFactors", "userFactorsOutput": f"{tmp_path}/u"})
    assert not (tmp_path / "s").exists()
    assert len(spark.read.text(f"{tmp_path}/p").first().value.split(",")) == RANK + 1
    assert len(spark.read.csv(f"{tmp_path}/u", sep="\t").columns) == 2
    export_text.run(spark, {"cohorts": "true", "productSimilarityInput": f"{trained}/prodSim", "productSimilarityOutput": f"{tmp_path}/s"})
    assert len(spark.read.csv(f"{tmp_path}/s", sep="\t").columns) == 3


def test_exports_of_a_run_without_cohorts(spark, retail, trained, tmp_path):
    """Such a run writes the folder that a cohort has here, and nothing below it."""
    sources = {"userFactorsInput": f"{trained}/userFactors/male", "productFactorsInput": f"{trained}/prodFactors/male",
               "productSimilarityInput": f"{trained}/prodSim/male", "customersInput": f"{retail}/customers"}
    targets = lambda kind: {n: f"{tmp_path}/{kind}/{n}" for n in ("userFactorsOutput", "productFactorsOutput", "productSimilarityOutput")}
    export_base64.run(spark, {**sources, **targets("b")})
    export_text.run(spark, {**sources, **targets("t")})
    n = spark.read.parquet(f"{trained}/prodFactors/male").count()
    lines = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/b/productFactorsOutput").collect()]
    assert len(lines) == n and {len(cells) for cells in lines} == {2}
    assert spark.read.text(f"{tmp_path}/t/productFactorsOutput").count() == n


def test_filterable_signals(spark, retail, tmp_path):
    rows = [signal(1, 10, 5, "2016-05-06T07:08:09"), signal(1, 10, 5, "2016-05-07T07:08:09"), "",
            signal(1, 10, 6, "2018-05-06T07:08:09"), signal(1, 11, 1, "2016-07-08T09:10:11"), signal(2, 10, 6, "2018-09-10T11:12:13"),
            signal(777, 10, 1, "2018-09-10T11:12:13")]
    files.save(feeds.load_text(spark, "signals", write(tmp_path / "s", "\n".join(rows) + "\n"), "|"), f"{tmp_path}/sp", 1)
    files.save(feeds.load_text(spark, "customer", f"{retail}/customers/c.csv", "\t", {"mode": "DROPMALFORMED"}), f"{tmp_path}/cp", 1)
    filterable_signals.run(spark, {"signalsPath": f"{tmp_path}/sp", "customersPath": f"{tmp_path}/cp",
                                   "csvOutputPath": f"{tmp_path}/out"})
    got = sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())
    one, two = f"{1:032X}", f"{2:032X}"
    assert got == [f"{one}\t10\t5\t2016-05-07T07:08:09", f"{one}\t11\t1\t2016-07-08T09:10:11",
                   f"{two}\t10\t6\t2018-09-10T11:12:13"]


def test_csv_conversion_job(spark, tmp_path):
    write(tmp_path / "schema.json", json.dumps({"schemaDefinition": SCHEMA}))
    write(tmp_path / "in.csv", "id,email,day,n\n1,a@b,04/03/2019,2.5\n")
    args = {"csvPath": f"{tmp_path}/in.csv", "parquetPath": f"{tmp_path}/out", "schemaPath": f"{tmp_path}/schema.json"}
    convert_csv.run(spark, args)
    convert_csv.run(spark, {**args, "mode": "append"})
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    assert (tmp_path / "out/yy=2019/mm=03").exists()


def test_promotion_ingest(spark, tmp_path):
    long_list = "".join(f"<ProductCode>{i:03d}</ProductCode>" for i in range(12))
    first = XML.replace("<GetQuantity></GetQuantity>", "<GetQuantity>1</GetQuantity>")
    second = (first.replace("P1", "P2").replace("<ProductCode Seq=\"1\">200</ProductCode>", long_list)
              .replace("04/05/2021", "04/02/2021"))
    third = first.replace("P1", "P3").replace("Less &amp;more on", "Known")
    for i, text in enumerate((first, second, third)):
        write(tmp_path / f"xml/{i}.xml", text)
    known = {"descriptor": {"name": "other", "description": "x", "expression":
                            "GET * 50.0% OFF 1 IN Product(200) IF 1 IN Product(100 101)"},
             "stackingRules": {"stackingRule": {"type": "Combines"}, "promotionPriority": 0},
             "dateRange": {"from": "2021-02-03T00:00:00Z", "to": "2022-05-04T00:00:00Z"}}
    write(tmp_path / "existing.json", json.dumps([known]))
    write(tmp_path / "segments.json", json.dumps({"descriptor": {"name": "P2_one"}, "items": [{"sku": "000"}, {"sku": "old"}]}))
    args = {"promotionsPath": f"{tmp_path}/xml", "existingPromotionsPath": f"{tmp_path}/existing.json",
            "existingSegmentsPath": f"{tmp_path}/segments.json", "outputPath": f"{tmp_path}/out", "asOf": "2021-02-04"}
    ingest_promotions.run(spark, args)
    read = lambda name: spark.read.parquet(f"{tmp_path}/out/{name}")
    assert {r.name: r.expression for r in read("promotions").collect()} == {
        "P1": "GET * 50.0% OFF 1 IN Product(200) IF 1 IN Product(100 101)",
        "P2": "GET * 50.0% OFF 1 IN P2_one IF 1 IN Product(100 101)",
        "P3": "GET * 50.0% OFF 1 IN Product(200) IF 1 IN Product(100 101)"}
    assert {(r.segment, r.sku, r.action) for r in read("changes").collect()} == {
        ("P2_one", f"{i:03d}", "add") for i in range(1, 12)} | {("P2_one", "old", "remove")}
    assert read("summary").first().asDict() == {"successes": 3, "failures": 0}
    known["dateRange"]["to"] = "2021-05-04T00:00:00Z"
    write(tmp_path / "existing.json", json.dumps([known]))
    ingest_promotions.run(spark, {**args, "asOf": "2021-02-05", "outputPath": f"{tmp_path}/out2"})
    assert spark.read.parquet(f"{tmp_path}/out2/promotions").count() == 0
    # What a run has emitted, stored, is not emitted again.
    stored = [{"descriptor": {"name": r.name, "description": r.description, "expression": r.expression},
               "stackingRules": {"stackingRule": {"type": r.stackingRule}, "promotionPriority": r.priority},
               "dateRange": {"from": r.startDate.isoformat() + "Z", "to": r.endDate.isoformat() + "Z"}} for r in read("promotions").collect()]
    write(tmp_path / "existing.json", json.dumps(stored))
    ingest_promotions.run(spark, {**args, "outputPath": f"{tmp_path}/out3"})
    assert spark.read.parquet(f"{tmp_path}/out3/promotions").count() == 0
    ingest_promotions.run(spark, {**args, "outputPath": f"{tmp_path}/out4", "stackingRule": "Exclusive", "priority": ""})
    assert {(r.stackingRule, r.priority) for r in spark.read.parquet(f"{tmp_path}/out4/promotions").collect()} == {("Exclusive", None)}


def test_unreadable_promotion_values_are_errors(spark, tmp_path):
    good = XML.replace("<GetQuantity></GetQuantity>", "<GetQuantity>1</GetQuantity>")
    write(tmp_path / "xml/1.xml", good.replace("04/05/2021", "31/02/2021"))
    write(tmp_path / "xml/2.xml", good.replace("P1", "P2").replace("<GetQuantity>1</GetQuantity>", "<GetQuantity>two</GetQuantity>", 1))
    write(tmp_path / "xml/3.xml", good.replace("P1", ""))
    write(tmp_path / "existing.json", "[]")
    write(tmp_path / "segments.json", "")
    ingest_promotions.run(spark, {"promotionsPath": f"{tmp_path}/xml", "existingPromotionsPath": f"{tmp_path}/existing.json",
                                  "existingSegmentsPath": f"{tmp_path}/segments.json", "outputPath": f"{tmp_path}/out", "asOf": "2021-02-04"})
    errors = {(r.promoId, r.message) for r in spark.read.parquet(f"{tmp_path}/out/errors").collect()}
    assert {("P1", "unreadable EndDate 31/02/2021"), ("P2", "unreadable GetQuantity two"), (None, "promotion without id")} <= errors
    assert spark.read.parquet(f"{tmp_path}/out/promotions").count() == 0
    assert spark.read.parquet(f"{tmp_path}/out/summary").first().failures == 3
