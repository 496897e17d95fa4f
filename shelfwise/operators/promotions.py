"""Promotions: filters, de-duplication and normalisation to promotion expressions.

A promotion is held flat, in three tables:

* promotions: docId, promoId, description, startDate, endDate, basketOption, basketValue, problems
* product sets: docId, promoId, position (from 0), lowerBuy, getQty, reward, value
* products: docId, position, sku

so that a product set can list any number of products. docId tells documents apart; several may have one
promoId. problems lists what could not be read; it may be missing.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .joins import salted_join

# Reward options and the position words of named segments.
NO_DISCOUNT = "No Discount"
SET_PRICE = "Set Price"
MONEY_OFF = "Money Off"
PERCENTAGE_OFF = "Percentage Off"
NO_VALUE = "reward without a value"
POSITION_WORDS = ("zero", "one", "two", "three")

MAX_INLINE_PRODUCTS = 10

#: Up to so many named segments are broadcast, with four short columns each; more are joined by a shuffle.
BROADCAST_SEGMENTS = 1_000_000

# Reward text of a set whose reward is given elsewhere. Our own wording.
OFFSITE_REWARD = "OFFSITE"


class Flat(NamedTuple):
    promotions: DataFrame
    sets: DataFrame
    products: DataFrame


class Normalised:
    """Promotions with expressions, rows of their named segments, and (promoId, message) errors.

    Each is made when it is asked for: segments measure how long the product lists are, which the others do not need.
    """

    def __init__(self, flat: Flat, translated: DataFrame):
        self._flat, self._translated = flat, translated

    @property
    def promotions(self) -> DataFrame:
        return valid_promotions(self._translated).drop("docId")

    @property
    def segments(self) -> DataFrame:
        return named_segments(self._flat, valid_promotions(self._translated))

    @property
    def errors(self) -> DataFrame:
        return translation_errors(self._translated)


def keyed(documents: DataFrame) -> DataFrame:
    """Documents with docId, a hash of the whole document, so that documents that share a promoId stay apart, and a number."""
    return documents.withColumns({"docId": F.sha2(F.to_json(F.struct(*documents.columns)), 256),
                                  "row": F.monotonically_increasing_id()})


def flatten_promotions(documents: DataFrame) -> Flat:
    """Nested promotion documents to the three flat tables; of documents that are alike in everything one is kept.

    The documents are stored first: all three tables, and what finds the copies, read them from there.
    """
    return flatten_stored(stored(keyed(documents), "promotion-documents"))


def flatten_stored(documents: DataFrame) -> Flat:
    """As flatten_promotions, for the rows of :func:`keyed` read from a table."""
    ids = documents.select("docId", "row")
    first = ids.groupBy("docId").agg(F.min("row").alias("first"))
    copies = ids.join(first, "docId").filter("row > first").select("row")
    single = documents.join(copies, "row", "left_anti")
    problems = F.col("problems") if "problems" in documents.columns else F.array().cast("array<string>")
    promotions = single.select(
        "docId", "promoId", "description", "startDate", "endDate",
        F.col("basket.rewardOption").alias("basketOption"), F.col("basket.rewardValue").alias("basketValue"),
        problems.alias("problems"))
    sets = single.select("docId", "promoId", F.posexplode("productSets").alias("position", "s"))
    products = sets.select("docId", "position", F.explode("s.products").alias("sku"))
    return Flat(promotions, sets.select("docId", "promoId", "position", "s.lowerBuy", "s.getQty", "s.reward", "s.value"), products)


def repeated_ids(promotions: DataFrame) -> DataFrame:
    """(promoId, message) rows of ids that more than one document has. Their promotions are kept; of segments that
    get the same name, that of the latest document is."""
    counts = promotions.groupBy("promoId").agg(F.count("*").alias("n")).filter("n > 1")
    return counts.select("promoId", F.concat(F.lit("id of "), F.col("n").cast("string"), F.lit(" documents")).alias("message"))


def supported(promotions: DataFrame, sets: DataFrame) -> DataFrame:
    """Promotions with at least one product set that has a reward of its own."""
    rewarding = sets.filter(~F.col("reward").eqNullSafe(NO_DISCOUNT)).select("docId")
    return promotions.join(rewarding, "docId", "left_semi")


def active(promotions: DataFrame, as_of: Column) -> DataFrame:
    """Promotions that have not ended before ``as_of``."""
    return promotions.filter(F.col("endDate") >= as_of)


def new_promotions(promotions: DataFrame, existing: DataFrame) -> DataFrame:
    """Promotions without an equivalent among the existing ones.

    Equivalent means equal dates, stacking rules and value order, and an equal
    name, description or expression. Each of the three is an equality join of
    its own: one join with an OR would compare all promotions that share dates.
    """
    shared = ["startDate", "endDate", "stackingRule", "priority", "valueOrder"]
    for text in ("name", "description", "expression"):
        columns = [*shared, text]
        known = existing.select(*(F.col(c).alias(f"existing_{c}") for c in columns)).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"existing_{c}")) for c in columns]
        promotions = promotions.join(known, same, "left_anti")
    return promotions


def set_lists(products: DataFrame) -> DataFrame:
    """For each set the number of products that it lists, repeats included, and the distinct SKUs, in order, of short lists.

    docId, position, listed, skus; skus is null if more products are listed than an inline segment takes. The numbers are added up
    before they are shuffled. Of a list only the first MAX_INLINE_PRODUCTS rows by SKU get together, and are cut down to these before
    they are shuffled, however long it is: a list that is short enough has no more.
    """
    keys = ["docId", "position"]
    window = Window.partitionBy(*keys).orderBy("sku")
    first = products.filter("sku IS NOT NULL").withColumn("n", F.row_number().over(window)).filter(F.col("n") <= MAX_INLINE_PRODUCTS)
    # The rows are in order already, so their SKUs are collected over the same window, without grouping them once more.
    together = F.collect_list("sku").over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    skus = first.select(*keys, "n", together.alias("skus")).filter("n = 1").select(*keys, F.array_distinct("skus").alias("skus"))
    return list_sizes(products).join(skus, keys, "left").select(
        *keys, "listed", F.when(F.col("listed") <= MAX_INLINE_PRODUCTS, F.coalesce("skus", F.array().cast("array<string>"))).alias("skus"))


def list_sizes(products: DataFrame) -> DataFrame:
    """docId, position and the number of products that a set lists, repeats included."""
    return products.filter("docId IS NOT NULL AND position IS NOT NULL").groupBy("docId", "position").agg(F.count("*").alias("listed"))


def with_segments(sets: DataFrame, products: DataFrame) -> DataFrame:
    """Sets with their segment: up to ten listed products are inline, longer lists get a name."""
    sized = sets.join(set_lists(products), ["docId", "position"], "left")
    listed = F.coalesce("listed", F.lit(0))
    named = listed > MAX_INLINE_PRODUCTS
    words = F.array(*(F.lit(w) for w in POSITION_WORDS))
    name = F.concat_ws("_", "promoId", F.get(words, F.col("position")))
    inline = F.concat(F.lit("Product("), F.array_join(F.coalesce("skus", F.array()), " "), F.lit(")"))
    return sized.withColumns({
        "listed": listed,
        "segmentKind": F.when(named, "named").otherwise("inline"),
        "segmentName": F.when(named & (F.col("position") < len(POSITION_WORDS)), name),
    }).withColumn(
        "segment", F.when(F.col("segmentKind") == "inline", inline).otherwise(F.col("segmentName"))).drop("skus")


def with_operators(sets: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sets with their operator, reward and error.

    ``main`` is what the reward applies to and ``qualifier`` what must be bought
    for it; a set is one or the other. Needs the columns of :func:`with_segments`.
    """
    basket = promotions.select("docId", "basketOption", "basketValue")
    sets = sets.join(basket, "docId")
    buy, get = (F.coalesce(c, F.lit(0)) for c in ("lowerBuy", "getQty"))
    has_basket = F.col("basketOption").isNotNull()
    undiscounted = F.col("reward").eqNullSafe(NO_DISCOUNT)
    match = lambda q: F.when(
        q > 0, F.concat(q.cast("string"), F.lit(" IN "), F.col("segment"))
    ).otherwise(F.concat(F.lit("IN "), F.col("segment")))

    extra = ~undiscounted & (get != 0) & (buy > get)
    qualifies = ~extra & (undiscounted | ((get == 0) & ~has_basket)) & (buy > 0)
    main = F.when(extra, F.concat(match(get), F.lit(" WITH "), match(buy - get))).when(~qualifies, match(buy))
    from_basket = F.col("getQty").eqNullSafe(0) & has_basket
    option = F.when(from_basket, F.col("basketOption")).otherwise(F.col("reward"))
    value = F.when(from_basket, F.col("basketValue")).otherwise(F.col("value"))
    misplaced = (F.col("segmentKind") == "named") & F.col("segmentName").isNull()
    error = (
        F.when(misplaced, F.concat(F.lit("no segment name for product set "), F.col("position").cast("string")))
        .when(~_known_option(option), F.concat(F.lit("unknown reward option "), F.coalesce(option, F.lit("null"))))
        .when(reward_text(option, value).isNull(), F.lit(NO_VALUE)))
    return sets.withColumns({
        "main": main,
        "qualifier": F.when(qualifies, match(buy)),
        "rewardText": reward_text(option, value),
        "offsite": option.eqNullSafe(NO_DISCOUNT),
        "error": error,
    })


def _known_option(option: Column) -> Column:
    return F.coalesce(option.isin(NO_DISCOUNT, SET_PRICE, MONEY_OFF, PERCENTAGE_OFF), F.lit(False))


def reward_text(option: Column, value: Column) -> Column:
    """Reward as it appears in an expression; null when the value it needs is missing."""
    amount = value.cast("double").cast("string")
    return (F.when(option == NO_DISCOUNT, F.lit(OFFSITE_REWARD))
            .when(option == SET_PRICE, F.concat(F.lit("£"), amount))
            .when(option == MONEY_OFF, F.concat(F.lit("£"), amount, F.lit(" OFF")))
            .when(option == PERCENTAGE_OFF, F.concat(amount, F.lit("% OFF"))))


ITEM = T.StructType([
    T.StructField("reward", T.StringType()), T.StructField("offsite", T.BooleanType()),
    T.StructField("main", T.StringType()), T.StructField("quals", T.ArrayType(T.StringType()))])


def _item(reward: Column, offsite: Column, main: Column, quals: Column) -> Column:
    return F.struct(reward.alias("reward"), offsite.alias("offsite"), main.alias("main"), quals.alias("quals"))


def _operator_text(item: Column) -> Column:
    """Operator of a line item: what it applies to, then its conditions."""
    conditions = F.when(F.size(item["quals"]) > 0,
                        F.concat(F.lit("IF "), F.array_join(item["quals"], " AND ")))
    return F.concat_ws(" ", item["main"], conditions)


def _combine(a: Column, b: Column) -> Column:
    """Line item ``a`` with the operator of ``b`` added to its own.

    Conditions are collected as long as they can be told apart; two operators
    that both have a main part become one main part, and the conditions inside
    it are closed from then on.
    """
    none = F.array().cast("array<string>")
    a_open, b_open = a["main"].isNull(), b["main"].isNull()
    b_condition = F.when(b_open, b["quals"]).otherwise(F.array(_operator_text(b)))
    closed = ~a_open & ~b_open
    main = F.when(closed, F.concat_ws(" AND ", _operator_text(a), _operator_text(b))).otherwise(a["main"])
    quals = F.when(closed, none).otherwise(F.concat(a["quals"], b_condition))
    return _item(a["reward"], a["offsite"], main, quals)


def _add_set(items: Column, new: Column) -> Column:
    """Line items of a promotion after one more product set.

    A set without its own reward joins an existing line item: the only one, the
    first of exactly two (which then moves to the end), or the last of more. A
    set with a reward takes over a line item that has none yet, else it becomes
    a line item itself.
    """
    n = F.size(items)
    takes_over = (n == 1) & F.get(items, F.lit(0))["offsite"] & ~new["offsite"]
    host = F.when(n <= 2, F.get(items, F.lit(0))).otherwise(F.get(items, n - 1))
    pair = F.struct(F.when(takes_over, new).otherwise(host).alias("a"),
                    F.when(takes_over, host).otherwise(new).alias("b"))
    joined = F.transform(F.array(pair), lambda p: _combine(p["a"], p["b"]))
    others = (F.when(n == 1, F.slice(items, 1, 0)).when(n == 2, F.slice(items, 2, 1))
              .otherwise(F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(0)))))
    joins = (n > 0) & (new["offsite"] | takes_over)
    return F.when(joins, F.concat(others, joined)).otherwise(F.concat(items, F.array(new)))


def fold_sets(operators: DataFrame) -> DataFrame:
    """Product sets of each promotion, in order, to its line items: (docId, items, errors).

    The number of sets of one promotion is that of one source document.
    """
    quals = F.when(F.col("qualifier").isNotNull(), F.array("qualifier")).otherwise(F.array().cast("array<string>"))
    item = _item(F.col("rewardText"), F.col("offsite"), F.col("main"), quals)
    ordered = F.sort_array(F.collect_list(F.struct("position", item.alias("item"), "error")))
    sets = operators.groupBy("docId").agg(ordered.alias("sets"))
    empty = F.array().cast(T.ArrayType(ITEM))
    return sets.select(
        "docId",
        F.aggregate("sets", empty, lambda acc, s: _add_set(acc, s["item"])).alias("items"),
        F.filter(F.transform("sets", lambda s: s["error"]), lambda e: e.isNotNull()).alias("errors"))


def with_basket_reward(items: Column, option: Column, value: Column) -> Column:
    """A single line item without a reward takes the basket reward, if that is complete."""
    basket = reward_text(option, value)
    alone = (F.size(items) == 1) & F.get(items, F.lit(0))["offsite"] & basket.isNotNull()
    replaced = F.transform(items, lambda i: _item(
        basket, option.eqNullSafe(NO_DISCOUNT), i["main"], i["quals"]))
    return F.when(alone, replaced).otherwise(items)


def expression_text(items: Column) -> Column:
    """Line items as one promotion expression."""
    line = lambda i: F.concat_ws(" ", F.lit("GET *"), i["reward"], _operator_text(i))
    return F.array_join(F.transform(items, line), " AND ")


def translate(flat: Flat) -> DataFrame:
    """One row per promotion with its expression, or with what is wrong with it in ``errors``."""
    operators = with_operators(with_segments(flat.sets, flat.products), flat.promotions)
    folded = flat.promotions.join(fold_sets(operators), "docId", "left")
    items = with_basket_reward(F.col("items"), F.col("basketOption"), F.col("basketValue"))
    errors = F.coalesce("errors", F.array(F.lit("no product sets")))
    if "problems" in flat.promotions.columns:
        errors = F.concat("problems", errors)
    return folded.select(
        "docId", "promoId", F.col("promoId").alias("name"), "description", expression_text(items).alias("expression"),
        "startDate", "endDate", F.size(items).alias("lineItems"), errors.alias("errors"))


def valid_promotions(translated: DataFrame) -> DataFrame:
    """Translated promotions without errors."""
    return translated.filter(F.size("errors") == 0).drop("errors")


def translation_errors(translated: DataFrame) -> DataFrame:
    """(promoId, message) rows of promotions that could not be translated."""
    return translated.select("promoId", F.explode("errors").alias("message"))


def normalise_promotions(flat: Flat) -> Normalised:
    """Promotion expressions, named segments and errors of flat promotions.

    A promotion with any error gives error rows only, and no segments. A job that needs more than
    one of the three should store the result of :func:`translate` in between.
    """
    return Normalised(flat, translate(flat))


def named_segments(flat: Flat, valid: DataFrame) -> DataFrame:
    """(promoId, segment, sku) rows of the product lists of valid promotions that are too long to be inline.

    valid has docId, promoId, startDate and endDate. Where two documents have segments of one name, the one that ends,
    then starts last wins.
    """
    words = F.array(*(F.lit(w) for w in POSITION_WORDS))
    # One condition on both columns stays above the count, which is then the one that set_lists makes.
    named = F.when(F.col("listed") > MAX_INLINE_PRODUCTS, F.col("position") < len(POSITION_WORDS))
    long_lists = list_sizes(flat.products).filter(named)
    known = long_lists.join(valid.select("docId", "promoId", "startDate", "endDate"), "docId") \
        .withColumn("segment", F.concat_ws("_", "promoId", F.get(words, F.col("position"))))
    order = [F.col(c).desc_nulls_last() for c in ("endDate", "startDate", "docId", "position", "promoId")]
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    latest = known.withColumn("place", place).filter("place = 1").select("segment", "docId", "position", "promoId")
    # Stored, to be counted: as long as they are few enough to be sent to all tasks, the products need not be shuffled to meet them.
    latest = stored(latest, "named-segments")
    keys = ["docId", "position"]
    few = latest.count() <= BROADCAST_SEGMENTS
    listed = flat.products.join(F.broadcast(latest), keys) if few else salted_join(flat.products, latest, keys, "sku")
    return listed.select("promoId", "segment", "sku").distinct()


# Names of stacking priorities. The numbers are a setting.
PRIORITY_NAMES = ("low", "medium", "high")


def promotion_request(promotions: DataFrame, priority_values: tuple[int, int, int] = (0, 1, 2)) -> DataFrame:
    """Request shape of a promotion: the priority as a word, or null when it has none."""
    priority = F.lit(None).cast("string")
    for number, name in zip(priority_values, PRIORITY_NAMES):
        priority = F.when(F.col("priority") == number, name).otherwise(priority)
    return promotions.select(
        "name", "description", "expression", "startDate", "endDate", "stackingRule",
        priority.alias("priority"), "created")


def promotion_kind(expression_type: Column | str) -> Column:
    """Request kind of a promotion by the type of its leftmost expression."""
    c = F.col(expression_type) if isinstance(expression_type, str) else expression_type
    return (F.when(c == "LineItemPromotion", "line").when(c == "OrderLevelPromotion", "order")
            .when(c == "PriceDropPromotion", "price"))


#: Levels that are followed in one step down a tree.
LEVELS_PER_STEP = 16


def leftmost_type(expression: Column | str) -> Column:
    """Type of the leftmost leaf of an expression tree in JSON, however deep; null for a text that is not JSON.

    The text is parsed once, to a variant; every step down takes a part of that, many levels at a time as far as the
    tree may reach and then one by one. The text has at least as many "left" keys as the left edge has levels.
    """
    c = F.col(expression) if isinstance(expression, str) else expression

    def down(path: str) -> Callable[[Column, Column], Column]:
        def step(tree: Column, _: Column) -> Column:
            below = F.filter(F.array(F.variant_get(tree, path, "variant")), lambda t: ~F.is_variant_null(t))
            return F.coalesce(F.get(below, F.lit(0)), tree)
        return step

    levels = F.coalesce(F.regexp_count(c, F.lit('"left"')), F.lit(0))
    steps = lambda n: F.array_repeat(F.lit(0), n.cast("int"))
    tree = F.aggregate(steps(F.floor(levels / LEVELS_PER_STEP)), F.try_parse_json(c), down("$" + ".left" * LEVELS_PER_STEP))
    leaf = F.aggregate(steps(F.least(levels, F.lit(LEVELS_PER_STEP - 1))), tree, down("$.left"))
    return F.try_variant_get(leaf, "$.type", "string")


def ingest_status(translated: DataFrame, as_of: Column) -> DataFrame:
    """Translated promotions as ``accepted``, ``rejected`` (with errors) or ``expired``."""
    status = (F.when(F.size("errors") > 0, "rejected").when(F.col("endDate") >= as_of, "accepted")
              .otherwise("expired"))
    return translated.select("docId", "promoId", status.alias("status"))


def ingest_summary(statuses: DataFrame) -> DataFrame:
    """Number of promotions accepted and rejected, in one row."""
    return statuses.agg(F.count_if(F.col("status") == "accepted").alias("successes"),
                        F.count_if(F.col("status") == "rejected").alias("failures"))
