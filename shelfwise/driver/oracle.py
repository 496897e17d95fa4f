"""DuckDB SQL for the registered queries, written without looking at their plans."""

from __future__ import annotations

# The domain views of ``views.py`` as common table expressions.
ORDER_SIGNALS = """order_signals AS (
  SELECT o_custkey AS customerId, l_partkey AS productId,
         CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 WHEN 'R' THEN 7 ELSE 99 END AS sourceId,
         epoch_ms(l_shipdate) AS signalDate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENT_SIGNALS = """event_signals AS (
  SELECT user_id AS customerId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS productId,
         CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 5 WHEN 'view' THEN 7
              ELSE 99 END AS sourceId,
         epoch_us(ts) // 1000 AS signalDate
  FROM events)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customerId, md5(c_name) AS guid,
         CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, c_acctbal AS balance
  FROM customer)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS productId, p_brand AS brand, p_size - 5 AS stockLevel,
         CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS isExcluded,
         date_diff('day', DATE '2000-01-01' + CAST(p_partkey % 2500 AS INTEGER), DATE '2005-06-01') AS daysOnSite,
         CASE WHEN p_partkey % 5 <> 0 THEN 1 ELSE 0 END AS isRecommended
  FROM part)"""

ELIGIBLE = PRODUCTS + """, eligible AS (
  SELECT productId FROM products
  WHERE isExcluded <> 1 AND daysOnSite <= 1900 AND stockLevel > 0 AND isRecommended = 1)"""

USER_VECTORS = ORDER_SIGNALS + """, bought AS (SELECT DISTINCT customerId, productId FROM order_signals),
items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS factors FROM embeddings),
user_parts AS (
  SELECT customerId, pos, CAST(round(sum(factors[pos]), 4) + 0.0 AS FLOAT) AS v
  FROM bought JOIN items ON items.id = bought.productId, range(1, 65) AS r(pos)
  GROUP BY customerId, pos),
user_vectors AS (
  SELECT customerId AS id, CAST(list(v ORDER BY pos) AS DOUBLE[]) AS factors FROM user_parts GROUP BY customerId)"""

USER_TOP = USER_VECTORS + """, user_scored AS (
  SELECT u.id, i.id AS similarId, list_dot_product(u.factors, i.factors) AS score FROM user_vectors u, items i),
user_top AS (
  SELECT * FROM user_scored QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, similarId) <= 20)"""

SIMILAR = ELIGIBLE + """, items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS factors FROM embeddings),
scored AS (
  SELECT q.id, c.id AS similarId, list_dot_product(q.factors, c.factors) AS score
  FROM items q, items c WHERE c.id IN (SELECT productId FROM eligible)),
similar_items AS (
  SELECT * FROM (SELECT * FROM scored
                 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, similarId) <= 100)
  WHERE id <> similarId AND score > 0)"""

RATED = """rated AS (
  SELECT *, CASE WHEN sourceId = 1 THEN 3.0 WHEN sourceId BETWEEN 2 AND 6 THEN 2.0 WHEN sourceId = 7 THEN 1.0
                 ELSE 0.0 END AS rating FROM {source})"""

RATINGS = RATED + """, ratings AS (
  SELECT customerId, productId, CAST(max(rating) AS DOUBLE) AS rating FROM rated WHERE rating >= 1
  GROUP BY customerId, productId)"""

PRIORITY = """SELECT guid, productId, sourceId,
       strftime(make_timestamp(signalDate * 1000), '%Y-%m-%dT%H:%M:%S') AS signalDate
FROM (SELECT c.guid, s.* FROM {source} s JOIN customers c ON c.customerId = s.customerId
      QUALIFY row_number() OVER (PARTITION BY c.guid, s.productId
                                 ORDER BY s.sourceId, s.signalDate DESC, s.customerId) = 1)"""

DATE_TEXTS = """date_texts AS (
  SELECT o_orderkey, o_orderkey % 6 AS kind, o_orderdate,
         CASE o_orderkey % 6
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123'
           WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.250Z'
           WHEN 3 THEN CAST(epoch_ms(o_orderdate) AS VARCHAR)
           WHEN 4 THEN '' END AS text
  FROM orders)"""

SPANS = """spans AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
  FROM orders GROUP BY o_custkey)"""

DAYS = EVENT_SIGNALS + """, days AS (
  SELECT customerId, productId, CAST(strftime(make_timestamp(signalDate * 1000), '%Y%m%d') AS INTEGER) AS day FROM event_signals)"""

ORDER_LINES = """order_lines AS (
  SELECT *, concat_ws(';', o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'c' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END, price, o_orderstatus,
                      CASE WHEN o_orderkey % 11 = 0 THEN 'more' END) AS line
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 AS bad FROM orders))"""

PROMO_ROWS = """promo_rows AS (
  SELECT unnest(['O' || l_orderkey, 'S' || l_suppkey]) AS promoId, l_linenumber % 3 AS position,
         l_partkey, l_linenumber, l_quantity, l_discount, l_shipdate FROM lineitem),
promos AS (
  SELECT promoId, 'offer ' || max(l_linenumber) AS description, min(l_shipdate) AS startDate,
         max(l_shipdate) AS endDate,
         CASE min(l_partkey) % 6 WHEN 0 THEN 'Set Price' WHEN 1 THEN 'Percentage Off' END AS basketOption,
         CASE WHEN min(l_partkey) % 6 = 0 THEN 50.0::DOUBLE END AS basketValue
  FROM promo_rows GROUP BY promoId),
sets AS (
  SELECT promoId, position, CAST(max(l_quantity) AS INTEGER) % 4 AS buy, max(l_linenumber) % 2 AS get,
         CASE WHEN max(l_partkey) % 97 = 0 THEN 'Free Gift'
              WHEN (max(l_partkey) + position) % 5 < 2 THEN 'No Discount'
              WHEN (max(l_partkey) + position) % 5 = 2 THEN 'Set Price'
              WHEN (max(l_partkey) + position) % 5 = 3 THEN 'Money Off' ELSE 'Percentage Off' END AS reward,
         CASE WHEN max(l_partkey) % 11 <> 0 THEN round(max(l_discount) * 100, 0) END AS value
  FROM promo_rows GROUP BY promoId, position)"""

SET_SEGMENTS = PROMO_ROWS + """, listings AS (
  SELECT promoId, position, count(*) AS listed, list_sort(list_distinct(list(CAST(l_partkey AS VARCHAR)))) AS skus
  FROM promo_rows GROUP BY promoId, position),
segmented AS (
  SELECT s.*, l.listed, CASE WHEN l.listed <= 10 THEN 'inline' ELSE 'named' END AS segmentKind,
         CASE WHEN l.listed <= 10 THEN 'Product(' || array_to_string(l.skus, ' ') || ')'
              ELSE s.promoId || '_' || ['zero', 'one', 'two', 'three'][s.position + 1] END AS segment,
         p.basketOption, p.basketValue
  FROM sets s JOIN listings l USING (promoId, position) JOIN promos p USING (promoId)),
resolved AS (
  SELECT *,
         CASE WHEN reward <> 'No Discount' AND get <> 0 AND buy > get THEN 'extra'
              WHEN (reward = 'No Discount' OR (get = 0 AND basketOption IS NULL)) AND buy > 0 THEN 'qualifier'
              ELSE 'plain' END AS form,
         CASE WHEN get = 0 AND basketOption IS NOT NULL THEN basketOption ELSE reward END AS rewardOption,
         CASE WHEN get = 0 AND basketOption IS NOT NULL THEN basketValue ELSE value END AS rewardValue
  FROM segmented),
ops AS (
  SELECT *,
         CASE form WHEN 'extra' THEN get || ' IN ' || segment || ' WITH ' || (buy - get) || ' IN ' || segment
                   WHEN 'plain' THEN CASE WHEN buy > 0 THEN buy || ' ' ELSE '' END || 'IN ' || segment END AS main,
         CASE WHEN form = 'qualifier' THEN buy || ' IN ' || segment END AS qualifier,
         CASE rewardOption WHEN 'No Discount' THEN 'OFFSITE' WHEN 'Set Price' THEN '£' || rewardValue
              WHEN 'Money Off' THEN '£' || rewardValue || ' OFF'
              WHEN 'Percentage Off' THEN rewardValue || '% OFF' END AS rewardText,
         rewardOption = 'No Discount' AS offsite,
         CASE WHEN rewardOption = 'Free Gift' THEN 'unknown reward option Free Gift'
              WHEN rewardOption <> 'No Discount' AND rewardValue IS NULL
              THEN 'reward without a value' END AS error
  FROM resolved)"""


def _item(reward: str, offsite: str, main: str, quals: str) -> str:
    return f"{{'r': {reward}, 'o': {offsite}, 'm': {main}, 'q': {quals}}}"


def _operator(x: str) -> str:
    return (f"concat_ws(' ', {x}.m, CASE WHEN len({x}.q) > 0 THEN 'IF ' || array_to_string({x}.q, ' AND ') END)")


def _join(a: str, b: str) -> str:
    both = f"({a}.m IS NOT NULL AND {b}.m IS NOT NULL)"
    main = f"CASE WHEN {both} THEN {_operator(a)} || ' AND ' || {_operator(b)} ELSE {a}.m END"
    extra = f"CASE WHEN {b}.m IS NULL THEN {b}.q ELSE [{_operator(b)}] END"
    quals = f"CASE WHEN {both} THEN CAST([] AS VARCHAR[]) ELSE list_concat({a}.q, {extra}) END"
    return _item(f"{a}.r", f"{a}.o", main, quals)


def _line(x: str) -> str:
    return f"concat_ws(' ', 'GET *', {x}.r, {_operator(x)})"


# Up to three sets per promotion, joined one after the other.
EXPRESSIONS = SET_SEGMENTS + f""", failed AS (SELECT DISTINCT promoId FROM ops WHERE error IS NOT NULL),
numbered AS (
  SELECT promoId, {_item('rewardText', 'offsite', 'main',
                         "CASE WHEN qualifier IS NULL THEN CAST([] AS VARCHAR[]) ELSE [qualifier] END")} AS item,
         row_number() OVER (PARTITION BY promoId ORDER BY position) AS rn
  FROM ops WHERE promoId NOT IN (SELECT promoId FROM failed)),
wide AS (
  SELECT promoId, any_value(item) FILTER (rn = 1) AS a, any_value(item) FILTER (rn = 2) AS b,
         any_value(item) FILTER (rn = 3) AS c FROM numbered GROUP BY promoId),
two AS (
  SELECT promoId, c,
         CASE WHEN b IS NULL THEN a WHEN a.o AND NOT b.o THEN {_join('b', 'a')}
              WHEN b.o THEN {_join('a', 'b')} ELSE a END AS x,
         CASE WHEN b IS NOT NULL AND NOT a.o AND NOT b.o THEN b END AS y
  FROM wide),
three AS (
  SELECT promoId,
         CASE WHEN c IS NULL THEN x WHEN y IS NOT NULL AND c.o THEN y WHEN y IS NOT NULL THEN x
              WHEN x.o AND NOT c.o THEN {_join('c', 'x')} WHEN c.o THEN {_join('x', 'c')} ELSE x END AS x,
         CASE WHEN c IS NULL THEN y WHEN y IS NOT NULL AND c.o THEN {_join('x', 'c')} WHEN y IS NOT NULL THEN y
              WHEN NOT x.o AND NOT c.o THEN c END AS y,
         CASE WHEN c IS NOT NULL AND y IS NOT NULL AND NOT c.o THEN c END AS z
  FROM two),
basketed AS (
  SELECT t.promoId, y, z, p.description, p.startDate, p.endDate,
         CASE WHEN y IS NULL AND x.o AND basketOption = 'Set Price' AND basketValue IS NOT NULL
              THEN {_item("'£' || basketValue", 'false', 'x.m', 'x.q')} ELSE x END AS x
  FROM three t JOIN promos p USING (promoId)),
promotions AS (
  SELECT promoId, promoId AS name, description,
         concat_ws(' AND ', {_line('x')}, CASE WHEN y IS NOT NULL THEN {_line('y')} END,
                   CASE WHEN z IS NOT NULL THEN {_line('z')} END) AS expression,
         startDate, endDate,
         1 + CASE WHEN y IS NULL THEN 0 ELSE 1 END + CASE WHEN z IS NULL THEN 0 ELSE 1 END AS lineItems
  FROM basketed)"""

STORED = """stored AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'E' ELSE 'N' END || o_orderkey AS name,
         'spend ' || (o_custkey % 100) AS description,
         'GET * £' || CAST(floor(o_totalprice) AS BIGINT) || ' 1 IN Basket' AS expression,
         o_orderdate AS startDate, o_orderdate + INTERVAL 30 DAY AS endDate,
         CASE WHEN o_orderkey % 2 = 0 THEN 'Combines' END AS stackingRule,
         CAST(o_orderpriority[1] AS INTEGER) AS priority, o_orderstatus
  FROM orders)"""

SEGMENT_ROWS = """rows AS (
  SELECT 'S' || l_suppkey AS segment, CAST(l_partkey AS VARCHAR) AS sku, year(l_shipdate) AS y,
         l_suppkey % 4 AS kind FROM lineitem),
fresh AS (SELECT DISTINCT segment, sku FROM rows WHERE y >= 1998),
present AS (SELECT DISTINCT segment, sku FROM rows WHERE y < 1998 AND kind <> 0)"""

REGISTERED = """registered AS (
  SELECT 'S' || l_suppkey || ':group' AS segmentKey, year(l_shipdate) AS version,
         CAST(l_partkey AS VARCHAR) AS sku FROM lineitem)"""


def _with(views: str, body: str) -> str:
    return f"WITH {views}\n{body}"


def _ratings(source_view: str, source: str, *more: str) -> str:
    return ",\n".join([source_view, *more, RATINGS.format(source=source)])


def oracle_sql() -> dict[str, str]:
    wide = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))
    values = "SELECT {key}, CAST(pos - 1 AS INTEGER) AS pos, CAST({vector}[pos] AS DOUBLE) AS value FROM {table}, range(1, 65) AS r(pos)"
    embedded = values.format(key="vec_id AS id", vector="embedding", table="embeddings")
    return {
        "signal_ratings": _with(_ratings(ORDER_SIGNALS, "order_signals"), "SELECT * FROM ratings"),
        "event_ratings": _with(_ratings(EVENT_SIGNALS, "event_signals"), "SELECT * FROM ratings"),
        "signal_priority": _with(f"{ORDER_SIGNALS}, {CUSTOMERS}", PRIORITY.format(source="order_signals")),
        "event_priority": _with(f"{EVENT_SIGNALS}, {CUSTOMERS}", PRIORITY.format(source="event_signals")),
        "wide_source_priority": _with(
            f"{EVENT_SIGNALS}, {CUSTOMERS}" + """, wide AS (
              SELECT customerId, md5(CAST(customerId % 40 AS VARCHAR)) AS guid, productId, customerId % 3 + signalDate % 7 AS w,
                     CASE WHEN productId % 5 = 0 THEN 40000 + 5000 * (customerId % 3 + signalDate % 7)
                          WHEN productId % 5 = 1 THEN -(customerId % 3 + signalDate % 7)
                          WHEN productId % 5 = 2 AND (customerId % 3 + signalDate % 7) % 2 = 0 THEN NULL ELSE sourceId END AS sourceId,
                     CASE WHEN signalDate % 11 <> 0 THEN signalDate END AS signalDate
              FROM event_signals JOIN customers USING (customerId))""",
            """SELECT customerId, guid, productId, sourceId, signalDate FROM wide
               QUALIFY row_number() OVER (PARTITION BY guid, productId
                 ORDER BY sourceId NULLS LAST, signalDate DESC NULLS LAST, customerId) = 1"""),
        "training_ratings": _with(
            _ratings(ORDER_SIGNALS, "order_signals", CUSTOMERS, PRODUCTS),
            """SELECT * FROM ratings WHERE customerId IN (SELECT customerId FROM customers WHERE balance > 0)
               AND productId IN (SELECT productId FROM products)"""),
        "signal_line_parse": _with(
            ORDER_SIGNALS,
            """SELECT customerId, sourceId, count(*) AS signals, min(productId) AS firstProduct,
                      strftime(make_timestamp(max(signalDate) * 1000), '%Y-%m-%dT%H:%M:%S') || '.030000000' AS lastDate
               FROM order_signals WHERE productId % 7 <> 0 AND productId % 5 <> 0 AND sourceId BETWEEN 1 AND 7
               GROUP BY customerId, sourceId"""),
        "customer_line_parse": """SELECT c_custkey AS customerId FROM customer WHERE c_nationkey NOT IN (3, 5)""",
        "flag_line_parse": _with(PRODUCTS, "SELECT productId FROM products WHERE isRecommended = 1"),
        "eligible_items": _with(ELIGIBLE, "SELECT productId FROM eligible"),
        "eligible_item_factors": _with(
            ELIGIBLE,
            """SELECT vec_id AS id, len(embedding) AS rank, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings
               WHERE vec_id IN (SELECT productId FROM eligible)"""),
        "product_latest": """
            SELECT l_partkey AS productId, l_shipdate AS dateModified, l_extendedprice AS price,
                   l_quantity AS quantity, l_orderkey AS orderId
            FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_extendedprice DESC,
                                       l_quantity DESC, l_orderkey DESC) = 1""",
        "utc_millis_optional": _with(
            DATE_TEXTS,
            """SELECT o_orderkey,
                      CASE kind WHEN 2 THEN epoch_ms(o_orderdate) + 250 WHEN 3 THEN epoch_ms(o_orderdate) ELSE -1 END AS keepsMillis,
                      CASE WHEN kind <= 3 THEN epoch_ms(o_orderdate) ELSE -1 END AS wholeSeconds
               FROM date_texts"""),
        "utc_millis_strict": _with(
            DATE_TEXTS, "SELECT o_orderkey, epoch_ms(o_orderdate) AS millis FROM date_texts"),
        "iso_dates": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y/%m/%d') AS folder
                        FROM events""",
        "date_reformat": """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ordered,
                                   CAST(NULL AS VARCHAR) AS broken FROM orders""",
        "partition_by_date": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
                                       strftime(o_orderdate, '%Y') AS yy, strftime(o_orderdate, '%m') AS mm,
                                       strftime(o_orderdate, '%d') AS dd FROM orders""",
        "partition_by_millis": _with(
            EVENT_SIGNALS,
            """SELECT customerId, productId, signalDate, strftime(make_timestamp(signalDate * 1000), '%Y') AS yy,
                      strftime(make_timestamp(signalDate * 1000), '%m') AS mm,
                      strftime(make_timestamp(signalDate * 1000), '%d') AS dd FROM event_signals"""),
        "date_parts": """SELECT event_id, strftime(ts, '%Y') AS yy, strftime(ts, '%m') AS mm, strftime(ts, '%d') AS dd,
                                strftime(ts, '%H') AS hh, strftime(ts, '%M') AS mn FROM events""",
        "date_paths": _with(
            SPANS,
            """SELECT DISTINCT o_custkey,
                      CASE WHEN date_trunc('month', d) > date_trunc('month', lo)
                            AND date_trunc('month', d) < date_trunc('month', hi)
                           THEN strftime(d, '/signals/yy=%Y/mm=%m/*')
                           ELSE strftime(d, '/signals/yy=%Y/mm=%m/dd=%d') END AS path
               FROM (SELECT *, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM spans)"""),
        "month_paths": _with(
            SPANS,
            """SELECT o_custkey, strftime(m, '/signals/%Y/%m/*') AS path
               FROM (SELECT *, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS m FROM spans)"""),
        "time_slices": _with(
            EVENT_SIGNALS,
            """SELECT customerId, sliceName, sliceLabels, count(*) AS signals
               FROM event_signals JOIN (VALUES ('day', '', 0, 1), ('week', 'short', 0, 7), ('month', 'long', 0, 30),
                                               ('old', '', 7, 30)) AS v(sliceName, sliceLabels, a, b)
                 ON signalDate >= epoch_ms(TIMESTAMP '2024-01-31') - b * 86400000::BIGINT
                AND signalDate < epoch_ms(TIMESTAMP '2024-01-31') - a * 86400000::BIGINT
               GROUP BY ALL"""),
        "last_n_days": """SELECT strftime(ts, '%Y') AS yy, strftime(ts, '%m') AS mm, strftime(ts, '%d') AS dd,
                                 count(*) AS signals FROM events
                          WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-20' GROUP BY ALL""",
        "training_window": """SELECT strftime(l_shipdate, '%Y') AS yy, strftime(l_shipdate, '%m') AS mm,
                                     count(*) AS signals, count(DISTINCT o_custkey) AS customers
                              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                              WHERE l_shipdate >= DATE '1999-11-01' AND l_shipdate < DATE '2000-02-01' GROUP BY ALL""",
        "non_pii_projection": """SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS ordered, o_orderstatus,
                                        strftime(o_orderdate, '%Y') AS yy, strftime(o_orderdate, '%m') AS mm,
                                        strftime(o_orderdate, '%d') AS dd FROM orders""",
        "cloud_paths": """SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN source || '-box' END AS container,
                                 CASE WHEN doc_id % 7 <> 0 THEN 'store' || (doc_id % 10) END AS account,
                                 CASE WHEN doc_id % 7 <> 0 THEN 'docs/' || lang || '/' || doc_id END AS prefix
                          FROM documents""",
        "dated_folder_reads": _with(
            DAYS,
            """SELECT reader, day, count(*) AS signals, sum(productId)::BIGINT AS products FROM days JOIN (VALUES
                 ('range', 20240105, 20240109), ('two days', 20240103, 20240104), ('months', 20240101, 20240229), ('last days', 20240118, 20240120)
               ) AS v(reader, a, b) ON day BETWEEN a AND b GROUP BY ALL"""),
        "plain_folder_reads": _with(
            DAYS,
            """SELECT reader, day, count(*) AS signals, sum(productId)::BIGINT AS products
               FROM days JOIN (VALUES ('parquet', 20240106, 20240107), ('text', 20240105, 20240106)) AS v(reader, a, b) ON day BETWEEN a AND b
               WHERE productId IS NOT NULL GROUP BY ALL"""),
        "partitioned_append": _with(
            DAYS,
            """SELECT CASE WHEN customerId % 2 = 0 THEN 'even' ELSE 'odd' END AS run, day // 10000 AS yy, day // 100 % 100 AS mm, day % 100 AS dd,
                      count(*) AS signals, sum(productId)::BIGINT AS products FROM days GROUP BY ALL"""),
        "csv_permissive": _with(
            ORDER_LINES,
            """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey, price, o_orderstatus AS status,
                      CASE WHEN bad THEN line END AS line FROM order_lines"""),
        "csv_drop_malformed": _with(ORDER_LINES, "SELECT o_orderkey, o_custkey, price, o_orderstatus AS status FROM order_lines WHERE NOT bad"),
        "csv_failfast": _with(ORDER_LINES, "SELECT o_orderkey, o_custkey, price, o_orderstatus AS status FROM order_lines WHERE NOT bad"),
        "feed_files": """SELECT kind, o_custkey AS customerId, o_orderkey AS receiptId,
                                CASE kind WHEN 'raw' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE CAST(epoch_ms(o_orderdate) AS VARCHAR) END AS entered
                         FROM orders, (VALUES ('parquet'), ('text'), ('raw')) AS k(kind)""",
        "als_objective": _with(
            _ratings(EVENT_SIGNALS, "event_signals"),
            """SELECT CAST(n AS INTEGER) AS iterations, true AS falls, customers, products
               FROM range(1, 4) AS r(n), (SELECT count(DISTINCT customerId) AS customers, count(DISTINCT productId) AS products FROM ratings)"""),
        "feed_customer": _with(
            CUSTOMERS,
            """SELECT customerId, guid, gender, epoch_ms(TIMESTAMP '2001-01-01 01:02:03.25' + CAST(customerId % 900 AS INTEGER) * INTERVAL 1 DAY) AS dateEntered,
                      CAST(NULL AS BIGINT) AS dateModified, customerId % 2 AS premier FROM customers"""),
        "feed_product": """SELECT p_partkey AS productId, p_brand AS brandName,
                                  epoch_ms(TIMESTAMP '2001-01-01 04:05:06' + CAST(p_partkey % 900 AS INTEGER) * INTERVAL 1 DAY) AS dateOnSite,
                                  p_retailprice AS currentPrice, p_size AS stockLevel FROM part""",
        "feed_variant": """SELECT p_partkey AS productId, p_partkey * 10 AS variantId, p_type AS sizeName, p_retailprice AS rrp,
                                  epoch_ms(TIMESTAMP '2001-01-01 04:05:06' + CAST(p_partkey % 900 AS INTEGER) * INTERVAL 1 DAY) AS dateModified FROM part""",
        "feed_receipt": """SELECT o_custkey AS customerId, o_orderkey AS receiptId, o_totalprice AS priceAtPurchase, o_orderkey % 2 = 0 AS isPremier,
                                  epoch_ms(o_orderdate) AS dateEntered FROM orders""",
        "feed_return": """SELECT l_orderkey AS receiptId, CAST(l_linenumber AS VARCHAR) AS returnItemId, CAST(l_partkey AS VARCHAR) AS itemQty,
                                 epoch_ms(l_shipdate) AS returnsDateKey, CASE WHEN l_linenumber = 1 THEN epoch_ms(l_shipdate) END AS dateEntered FROM lineitem""",
        "feed_signals": _with(ORDER_SIGNALS, "SELECT customerId, productId, sourceId, signalDate, sourceId % 2 AS useForRecs FROM order_signals"),
        "promotion_documents": """
            SELECT 'X' || o_orderkey AS promoId, position, CASE WHEN position = 0 AND o_orderkey % 11 <> 0 THEN 2 END AS lowerBuy,
                   CASE position WHEN 1 THEN 1 END AS getQty, CASE position WHEN 0 THEN 'Money Off' ELSE 'No Discount' END AS reward,
                   CASE position WHEN 0 THEN 1.5 END AS value, 'a & b ' || o_orderkey AS description,
                   date_trunc('day', o_orderdate) AS startDate, CASE WHEN o_orderkey % 11 <> 0 THEN date_trunc('day', o_orderdate) END AS endDate,
                   CASE WHEN o_orderkey % 11 = 0 THEN 'unreadable EndDate 31/02/2021; unreadable LowerBuyQuantity two' ELSE '' END AS problems,
                   CASE position WHEN 0 THEN list_aggregate(list_sort([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR)]), 'string_agg', ' ') END AS skus
            FROM orders, (VALUES (0), (1)) AS p(position)""",
        "als_item_factors": _with(
            _ratings(ORDER_SIGNALS, "order_signals", CUSTOMERS, ELIGIBLE),
            """SELECT DISTINCT productId AS id, 10 AS rank FROM ratings
               WHERE customerId IN (SELECT customerId FROM customers WHERE balance > 0) AND productId IN (SELECT productId FROM eligible)"""),
        "als_cohort_user_factors": _with(
            _ratings(ORDER_SIGNALS, "order_signals", CUSTOMERS, PRODUCTS),
            """SELECT DISTINCT customerId AS id, upper(gender[1]) AS gender, 10 AS rank FROM ratings JOIN customers USING (customerId)
               WHERE balance > 0 AND productId IN (SELECT productId FROM products)"""),
        "similar_items": _with(SIMILAR, "SELECT id, similarId, round(score, 6) AS score FROM similar_items"),
        "approx_similar_items": """
            SELECT a.vec_id AS id, b.vec_id AS similarId, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
            FROM embeddings a, embeddings b
            QUALIFY row_number() OVER (PARTITION BY a.vec_id
              ORDER BY list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) <= 20""",
        "approx_recall": """SELECT count(*) FILTER (vec_id % 100 = 0) AS queries, 20 * count(*) FILTER (vec_id % 100 = 0) AS wanted, true AS enough
                            FROM embeddings""",
        "user_top_items": _with(USER_TOP, "SELECT id, similarId, round(score, 6) AS score FROM user_top"),
        "user_top_brands": _with(
            f"{USER_TOP}, {PRODUCTS}",
            """SELECT id, brand, count(*) AS products FROM user_top JOIN products ON productId = similarId
               GROUP BY id, brand
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, brand) <= 20"""),
        "user_vector_lookup": _with(
            f"{USER_VECTORS}, {CUSTOMERS}",
            """SELECT id, len(factors) AS vectorSize, factors[1] AS first FROM user_vectors
               WHERE id IN (SELECT customerId FROM customers WHERE gender = 'male')"""),
        "vectors_wide": f"SELECT vec_id AS id, {wide} FROM embeddings",
        "cohort_union": """SELECT vec_id AS id, 'M' AS gender, len(embedding) AS rank FROM embeddings WHERE label < 6
                           UNION ALL
                           SELECT vec_id, 'F', len(embedding) FROM embeddings WHERE label >= 4""",
        "customer_factor_guids": _with(
            f"{USER_VECTORS}, {CUSTOMERS}",
            values.format(key="guid", vector="factors", table="user_vectors JOIN customers ON customerId = id")),
        "factors_text": embedded,
        "factors_b64_roundtrip": embedded,
        "similarity_b64_roundtrip": _with(SIMILAR, "SELECT id, similarId, round(score, 3) AS score FROM similar_items"),
        "segment_changes": _with(
            SEGMENT_ROWS,
            """SELECT segment, coalesce(f.sku, p.sku) AS sku,
                      CASE WHEN segment NOT IN (SELECT segment FROM present) THEN 'create'
                           WHEN p.sku IS NULL THEN 'add' ELSE 'remove' END AS action
               FROM fresh f FULL JOIN present p USING (segment, sku)
               WHERE (f.sku IS NULL OR p.sku IS NULL) AND segment IN (SELECT segment FROM fresh)"""),
        "sku_set_difference": """SELECT p_partkey, sku FROM (
                                   SELECT p_partkey, p_size, unnest(range(1, p_size + 1)) AS sku FROM part)
                                 WHERE sku < floor(p_size / 3) OR sku > p_size - 1""",
        "segments_latest": _with(
            REGISTERED,
            """SELECT DISTINCT * FROM registered
               WHERE (segmentKey, version) IN (SELECT (segmentKey, max(version)) FROM registered GROUP BY segmentKey)"""),
        "segments_overwritten": _with(
            REGISTERED,
            """SELECT segmentKey, count(DISTINCT version) - 1 AS replaced FROM registered GROUP BY segmentKey
               HAVING count(DISTINCT version) > 1"""),
        "segments_lookup": _with(
            REGISTERED,
            """SELECT DISTINCT * FROM registered
               WHERE segmentKey IN (SELECT 'S' || s_suppkey || ':group' FROM supplier WHERE s_acctbal > 5000)"""),
        "segment_request": _with(
            SEGMENT_ROWS,
            """SELECT segment AS name, CASE WHEN s_acctbal > 0 THEN s_name ELSE segment END AS description, sku
               FROM fresh JOIN supplier ON segment = 'S' || s_suppkey"""),
        "segment_rows": """SELECT 'O' || l_orderkey AS segment, l_returnflag AS description,
                                  unnest([CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)]) AS sku FROM lineitem""",
        "promotion_supported": _with(
            PROMO_ROWS,
            "SELECT promoId, description FROM promos WHERE promoId IN (SELECT promoId FROM sets WHERE reward <> 'No Discount')"),
        "promotion_active": _with(
            PROMO_ROWS, "SELECT promoId, startDate, endDate FROM promos WHERE endDate >= TIMESTAMP '2000-01-01'"),
        "promotion_new": _with(
            STORED,
            """SELECT name, description, expression, startDate FROM stored n
               WHERE o_orderstatus <> 'F' AND NOT EXISTS (
                 SELECT 1 FROM stored e
                 WHERE e.o_orderstatus = 'F' AND e.startDate = n.startDate AND e.endDate = n.endDate
                   AND e.stackingRule IS NOT DISTINCT FROM n.stackingRule AND e.priority = n.priority
                   AND (e.name = n.name OR e.description = n.description OR e.expression = n.expression))"""),
        "promotion_set_operators": _with(
            SET_SEGMENTS,
            """SELECT promoId, position, listed, segmentKind, segment, main, qualifier, rewardText, offsite, error
               FROM ops"""),
        "promotion_expressions": _with(EXPRESSIONS, "SELECT * FROM promotions"),
        "promotion_errors": _with(SET_SEGMENTS, "SELECT promoId, error AS message FROM ops WHERE error IS NOT NULL"),
        "promotion_segments": _with(
            EXPRESSIONS,
            """SELECT DISTINCT promoId, segment, CAST(l_partkey AS VARCHAR) AS sku
               FROM promo_rows JOIN segmented USING (promoId, position)
               WHERE segmentKind = 'named' AND promoId IN (SELECT promoId FROM promotions)"""),
        "promotion_repeated_ids": _with(
            EXPRESSIONS + """, shared AS (SELECT *, 'P' || (CAST(substr(promoId, 2) AS BIGINT) % 100) AS id FROM promos)""",
            """SELECT id AS promoId, p.description, replace(p.expression, promoId || '_', id || '_') AS expression,
                      p.startDate, p.endDate, lineItems FROM promotions p JOIN shared USING (promoId)
               UNION ALL
               SELECT id, 'id of ' || count(*) || ' documents', NULL, NULL, NULL, NULL FROM shared GROUP BY id HAVING count(*) > 1"""),
        "promotion_ingest": _with(
            EXPRESSIONS + """, backed AS (SELECT DISTINCT promoId FROM sets WHERE reward <> 'No Discount'),
            valid AS (SELECT * FROM promotions WHERE promoId IN (SELECT promoId FROM backed)),
            kept AS (SELECT * FROM valid WHERE CAST(substr(promoId, 2) AS BIGINT) % 5 = 0),
            accepted AS (
              SELECT * FROM valid n WHERE endDate >= TIMESTAMP '2000-01-01' AND NOT EXISTS (
                SELECT 1 FROM kept e WHERE e.startDate = n.startDate AND e.endDate = n.endDate
                   AND (e.name = n.name OR e.expression = n.expression))),
            fresh AS (
              SELECT DISTINCT segment, CAST(l_partkey AS VARCHAR) AS sku FROM promo_rows JOIN segmented USING (promoId, position)
              WHERE segmentKind = 'named' AND promoId IN (SELECT promoId FROM accepted)),
            present AS (
              SELECT DISTINCT 'S' || l_suppkey || '_one' AS segment, CAST(l_partkey AS VARCHAR) AS sku FROM lineitem
              WHERE year(l_shipdate) < 1998 AND l_suppkey % 4 <> 0)""",
            """SELECT promoId, expression AS detail, 'promotion' AS kind FROM accepted
               UNION ALL
               SELECT segment, coalesce(f.sku, p.sku), CASE WHEN segment NOT IN (SELECT segment FROM present) THEN 'create'
                      WHEN p.sku IS NULL THEN 'add' ELSE 'remove' END
               FROM fresh f FULL JOIN present p USING (segment, sku)
               WHERE (f.sku IS NULL OR p.sku IS NULL) AND segment IN (SELECT segment FROM fresh)"""),
        "promotion_requests": _with(
            STORED,
            """SELECT name, description, expression, startDate, endDate, stackingRule,
                      CASE priority WHEN 1 THEN 'low' WHEN 3 THEN 'medium' WHEN 5 THEN 'high' END AS priority,
                      startDate AS created FROM stored WHERE o_orderstatus <> 'F'"""),
        "promotion_kind": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'line' WHEN 1 THEN 'order'
                                                ELSE 'price' END AS kind FROM orders""",
        "ingest_summary": _with(
            EXPRESSIONS + """, backed AS (SELECT DISTINCT promoId FROM sets WHERE reward <> 'No Discount')""",
            """SELECT (SELECT count(*) FROM promotions WHERE endDate >= TIMESTAMP '2000-01-01'
                         AND promoId IN (SELECT promoId FROM backed)) AS successes,
                      (SELECT count(*) FROM failed WHERE promoId IN (SELECT promoId FROM backed)) AS failures"""),
    }
