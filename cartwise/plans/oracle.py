"""The same queries as plain SQL over the supplied tables.

They are written for clarity, not scale: windows over whole groups, joins of
every pair, sequential draws spelled out step by step.
"""

from __future__ import annotations

from math import log2

from cartwise.functions.hashing import MASK_32, MIX_MULTIPLIER, MODULUS, powers
from cartwise.operators import business, features, metrics
from cartwise.plans.catalog import SPLIT
from cartwise.sources import retail

SEED = "42"


def u(*keys: str) -> str:
    """Uniform number of a row, as in cartwise.functions.hashing."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (
        f"(('0x' || substr(md5(concat_ws('|', {text}, '{SEED}')), 1, 13))::BIGINT"
        " / CAST(4503599627370496 AS DOUBLE))"
    )


def r(expr: str, digits: int = 6) -> str:
    """Rounded double without negative zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def _case(column: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {arms} ELSE {default} END"


TS = "timestamp, position_in_cart, item_id, line_key"
TS_DESC = "timestamp DESC, position_in_cart DESC, item_id DESC, line_key DESC"
TEST_START = f"TIMESTAMP '{SPLIT['split_date']} 00:00:00'"
VAL_START = f"({TEST_START} - INTERVAL {SPLIT['test_days']} DAY)"
DIM = retail.VECTOR_DIM

# Shared tables by name; each may use the ones it lists.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "users": ((), f"""
        SELECT c_custkey AS user_id,
               {_case('c_mktsegment', retail.SEGMENTS, "'regular'")} AS user_segment,
               list_extract(['veg', 'non-veg', 'both'], CAST(c_custkey % 3 AS INTEGER) + 1)
                 AS veg_preference,
               CASE WHEN c_acctbal < 2500 THEN 'low' WHEN c_acctbal < 6200 THEN 'medium'
                    ELSE 'high' END AS order_frequency,
               CAST(c_nationkey AS VARCHAR) AS preferred_cuisine
        FROM customer"""),
    "items": ((), f"""
        SELECT p_partkey AS item_id, p_partkey // {retail.MENU_SIZE} AS restaurant_id,
               {_case('p_type', retail.CATEGORIES, 'NULL')} AS category,
               CAST(p_size % 2 AS INTEGER) AS veg_flag,
               CAST(p_size * 8 AS DOUBLE) AS price,
               p_retailprice / 1000 AS popularity_score
        FROM part"""),
    "headers": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS price,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS opened_at
        FROM orders"""),
    "order_items": ((), f"""
        SELECT l_orderkey AS order_id, l_partkey AS item_id,
               l_partkey // {retail.MENU_SIZE} AS restaurant_id,
               l_linenumber AS position_in_cart,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d')) AS line_key,
               CAST(l_returnflag = 'R' AS INTEGER) AS is_recommended,
               CAST(l_linestatus = 'O' AS INTEGER) AS added_after_recommendation
        FROM lineitem"""),
    "inter": (("order_items", "headers"), """
        SELECT i.order_id, 'sess_' || i.order_id AS session_id, i.line_key, h.user_id,
               i.item_id, i.restaurant_id,
               h.opened_at + to_minutes(i.position_in_cart) AS timestamp,
               i.position_in_cart, 1 AS added_to_cart, i.is_recommended AS recommended_flag,
               i.added_after_recommendation AS clicked, 1 AS ordered
        FROM order_items i LEFT JOIN headers h USING (order_id)
        WHERE h.user_id IS NOT NULL AND i.item_id IS NOT NULL"""),
    "train": (("inter",), f"SELECT * FROM inter WHERE timestamp < {VAL_START}"),
    "test": (("inter",), f"SELECT * FROM inter WHERE timestamp >= {TEST_START}"),
    "cart": (("inter",), "SELECT * FROM inter"),
    "vectors": ((), """
        SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings"""),
    "ustats": (("train",), """
        SELECT user_id, count(item_id) AS order_count, min(timestamp) AS first_order,
               max(timestamp) AS last_order FROM train GROUP BY user_id"""),
    "istats": (("train",), """
        SELECT item_id, count(DISTINCT user_id) AS unique_users, count(session_id) AS order_count,
               count(session_id) / CAST((SELECT count(*) FROM train) AS DOUBLE) AS popularity
        FROM train GROUP BY item_id"""),
    "midx": (("items",), """
        SELECT restaurant_id, item_id,
               row_number() OVER (PARTITION BY restaurant_id ORDER BY item_id % 64, item_id) - 1
                 AS idx,
               count(*) OVER (PARTITION BY restaurant_id) AS menu_size
        FROM items"""),
    "pos": (("inter", "midx"), """
        SELECT i.*, m.menu_size, o.idx AS own,
               m.menu_size - CASE WHEN o.idx IS NULL THEN 0 ELSE 1 END AS others,
               least(4, m.menu_size - 1) AS n4
        FROM inter i
        LEFT JOIN (SELECT restaurant_id, max(menu_size) AS menu_size FROM midx GROUP BY 1) m
          USING (restaurant_id)
        LEFT JOIN midx o ON o.restaurant_id = i.restaurant_id AND o.item_id = i.item_id"""),
    "cooc": (("train",), """
        SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cooc
        FROM train a JOIN train b ON a.session_id = b.session_id AND a.line_key <> b.line_key
        GROUP BY 1, 2"""),
    "steps": (("train", "items"), f"""
        SELECT category AS category_from, nxt AS category_to, count(*) AS n
        FROM (SELECT category, lead(category) OVER w AS nxt, lead(line_key) OVER w AS more
              FROM train JOIN items USING (item_id)
              WINDOW w AS (PARTITION BY session_id ORDER BY {TS}))
        WHERE more IS NOT NULL GROUP BY 1, 2"""),
    "uvec": (("train", "vectors"), f"""
        SELECT user_id, pos, sum(w * x) / sum(w) AS x
        FROM (SELECT user_id, exp(CAST(-0.1 AS DOUBLE) * age) AS w, unnest(range(0, {DIM})) AS pos,
                     unnest(vec) AS x
              FROM (SELECT user_id, item_id,
                      row_number() OVER (PARTITION BY user_id ORDER BY {TS_DESC}) - 1 AS age
                    FROM train) JOIN vectors USING (item_id))
        GROUP BY 1, 2"""),
    "cstats": (("cart", "items"), """
        SELECT session_id, sum(n) AS cart_size, coalesce(sum(price), 0) AS cart_total_price,
               avg(price) AS cart_avg_price,
               max(coalesce(CAST(category = 'main' AS INTEGER), 0)) AS cart_has_main,
               max(coalesce(CAST(category = 'drink' AS INTEGER), 0)) AS cart_has_drink,
               max(coalesce(CAST(category = 'dessert' AS INTEGER), 0)) AS cart_has_dessert,
               avg(veg_flag) AS cart_veg_ratio
        FROM (SELECT session_id, item_id, count(*) AS n FROM cart GROUP BY 1, 2)
        LEFT JOIN items USING (item_id) GROUP BY session_id"""),
    "lcart": (("inter", "cstats"), f"""
        SELECT i.*, CAST(coalesce(cart_size, 0) AS BIGINT) AS cart_size,
               CASE WHEN cart_size IS NULL THEN 0 ELSE cart_total_price END AS cart_total_price,
               CASE WHEN cart_size IS NULL THEN 0 ELSE cart_avg_price END AS cart_avg_price,
               coalesce(cart_has_main, 0) AS cart_has_main,
               coalesce(cart_has_drink, 0) AS cart_has_drink,
               coalesce(cart_has_dessert, 0) AS cart_has_dessert,
               CASE WHEN cart_size IS NULL THEN {features.EMPTY_CART_VEG_RATIO}
                    ELSE cart_veg_ratio END AS cart_veg_ratio
        FROM inter i LEFT JOIN cstats USING (session_id)"""),
    "scored": (("test", "train", "midx"), """
        SELECT s.order_id, s.line_key, s.user_id, s.item_id, s.added_to_cart AS label,
               coalesce(p.n / CAST((SELECT count(*) FROM train) AS DOUBLE), 0) AS score
        FROM (SELECT order_id, line_key, user_id, item_id, 1 AS added_to_cart FROM test
              UNION ALL
              SELECT t.order_id, t.line_key, t.user_id, m.item_id, 0
              FROM test t JOIN midx m USING (restaurant_id) WHERE m.item_id <> t.item_id) s
        LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) p USING (item_id)"""),
    "ranked": (("scored",), """
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY score DESC, item_id, line_key)
                 AS rank
        FROM scored"""),
    "ideal": ((), f"""
        SELECT unnest(range(0, {max(metrics.K_VALUES) + 1})) AS n,
               unnest([{', '.join(
                   f'CAST({sum(1 / log2(i + 1) for i in range(1, n + 1))!r} AS DOUBLE)'
                   for n in range(max(metrics.K_VALUES) + 1))}]) AS dcg"""),
    "curve": (("scored",), """
        SELECT pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn
        FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)
        WINDOW w AS (ORDER BY score DESC)"""),
    "overall": (("curve",), """
        SELECT 1 - sum(pos * (CAST(cn AS DOUBLE) - neg / CAST(2 AS DOUBLE)))
                   / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc,
               sum(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / sum(pos) AS average_precision
        FROM curve"""),
    "recs": (("ranked", "users", "items"), """
        SELECT k.order_id, k.line_key, k.user_id, k.item_id, k.score, us.user_segment, it.price
        FROM ranked k LEFT JOIN users us USING (user_id) LEFT JOIN items it USING (item_id)
        WHERE rank <= 10"""),
    "probs": (("recs",), f"""
        SELECT *, least(greatest({business.BASE_RATE} * CASE user_segment WHEN 'budget' THEN 0.7
                 WHEN 'premium' THEN 1.3 ELSE 1.0 END::DOUBLE
                 * exp(CAST(-{business.PRICE_SENSITIVITY} AS DOUBLE) * price) * (1 + scaled), 0), 1)
                 AS prob
        FROM (SELECT *, CASE WHEN hi > lo THEN (score - lo) / (hi - lo) ELSE 0.5 END AS scaled
              FROM recs, (SELECT min(score) AS lo, max(score) AS hi FROM recs))"""),
    "drawn": (("probs",), f"""
        SELECT *, CASE WHEN {u('line_key', 'item_id', "'accept'")} < prob THEN 1 ELSE 0 END
                 AS accepted
        FROM probs"""),
}
for _k in metrics.K_VALUES:
    TABLES[f"g{_k}"] = (("ranked", "ideal"), f"""
        SELECT order_id, g.n, rel, hits / CAST(least({_k}, g.n) AS DOUBLE) AS p,
               CASE WHEN rel > 0 THEN hits / CAST(rel AS DOUBLE) ELSE 0 END AS rc,
               CASE WHEN hits > 0 THEN g.dcg / a.dcg ELSE 0 END AS ndcg,
               CASE WHEN rel > 0 THEN g.dcg / b.dcg ELSE 0 END AS ndcg_full
        FROM (SELECT order_id, count(*) AS n, sum(label) AS rel,
                     sum(CASE WHEN rank <= {_k} THEN label ELSE 0 END) AS hits,
                     sum(CASE WHEN rank <= {_k} THEN label / log2(rank + 1) ELSE 0 END) AS dcg
              FROM ranked GROUP BY 1) g
        LEFT JOIN ideal a ON a.n = g.hits
        LEFT JOIN ideal b ON b.n = least({_k}, g.rel)""")


def sql(needs: str, body: str) -> str:
    """``body`` preceded by the tables it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in TABLES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return body
    parts = ", ".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return f"WITH {parts} {body}"


def draw(size: str, count: str, limit: int, salt: str) -> str:
    """List of ``count`` distinct numbers below ``size``, one step per draw."""
    digest = f"md5(concat_ws('|', line_key, '{salt}', '{SEED}'))"
    starts = [
        f"(('0x' || substr({digest}, {at}, 8))::BIGINT % {modulus - 1} + 1)"
        for at, modulus in zip((1, 9), MODULUS)
    ]
    left, right = (
        f"({start} * list_extract({values}, i) % {modulus})"
        for start, values, modulus in zip(starts, powers(limit), MODULUS)
    )
    d = MODULUS[0] - 1
    unit = f"(((({left} - {right}) % {d} + {d}) % {d} + CAST(0.5 AS DOUBLE)) / CAST({d} AS DOUBLE))"
    tries = (
        f"list_transform(range({size} - {count}, {size}), lambda j, i: "
        f"{{'j': j, 't': CAST(floor({unit} * (j + 1)) AS BIGINT)}})"
    )
    return (
        f"CASE WHEN {count} = {size} THEN range(0, {size}) ELSE "
        f"list_reduce({tries}, lambda acc, x: CASE WHEN list_contains(acc, x.t) "
        f"THEN list_append(acc, x.j) ELSE list_append(acc, x.t) END, []::BIGINT[]) END"
    )


def sampled(draws: str, shift: str = "d") -> str:
    """Positives and the items of drawn menu numbers."""
    return f"""
        SELECT order_id, session_id, line_key, user_id, item_id, restaurant_id, timestamp,
               1 AS added_to_cart FROM pos
        UNION ALL
        SELECT p.order_id, p.session_id, p.line_key, p.user_id, m.item_id, p.restaurant_id,
               p.timestamp, 0
        FROM (SELECT *, {shift} AS idx FROM (SELECT *, unnest({draws}) AS d FROM pos)) p
        JOIN midx m ON m.restaurant_id = p.restaurant_id AND m.idx = p.idx"""


RANDOM = sampled(draw("menu_size", "n4", 4, "r"))
MIXED = sampled(
    f"list_concat({draw('menu_size', '(n4 // 2)', 4, 'a')}, "
    f"{draw('menu_size', '(n4 - n4 // 2)', 4, 'b')})"
)
UNIFORM_5 = sampled(
    draw("others", "least(5, others)", 5, "u"),
    "CASE WHEN own IS NOT NULL AND d >= own THEN d + 1 ELSE d END",
)
# Numbers below the rest of the menu step over the sorted numbers of what the session bought.
COMPLEMENT_5 = sampled(
    draw("(menu_size - len(bought))", "least(5, menu_size - len(bought))", 5, "u"),
    "list_reduce(bought, lambda x, e: CASE WHEN x >= e THEN x + 1 ELSE x END, d)",
).replace("FROM pos))", "FROM kept))")
KEYS = "SELECT line_key, item_id, added_to_cart FROM"


def popular(wanted: int = 4) -> str:
    """The first items of an exponential race: times -ln(u) / weight, one for each menu item."""
    digest = f"md5(concat_ws('|', line_key, 'p', place // 256, '{SEED}'))"
    first, second = (
        f"((('0x' || substr({digest}, {at}, 8))::BIGINT % {modulus - 1} + 1)"
        f" * list_extract({values}, CAST(place % 256 AS INTEGER) + 1) % {modulus})"
        for at, modulus, values in zip((1, 9), MODULUS, powers(256))
    )
    d = MODULUS[0] - 1
    unit = f"(((({first} - {second}) % {d} + {d}) % {d} + CAST(0.5 AS DOUBLE)) / CAST({d} AS DOUBLE))"
    head = sql("items inter pos", "").rstrip()
    return f"""{head}, wm AS (
        SELECT m.restaurant_id, m.item_id, w.weight,
               row_number() OVER (PARTITION BY m.restaurant_id ORDER BY m.item_id % 64, m.item_id)
                 - 1 AS place
        FROM items m JOIN (SELECT item_id, count(*) AS weight FROM inter GROUP BY 1) w
          USING (item_id)),
    race AS (SELECT line_key, wm.item_id, n4,
                    row_number() OVER (PARTITION BY line_key ORDER BY -ln({unit}) / weight, wm.item_id)
                      AS rank
             FROM pos JOIN wm USING (restaurant_id))
        SELECT line_key, item_id, 1 AS added_to_cart FROM pos
        UNION ALL SELECT line_key, item_id, 0 FROM race WHERE rank <= least(n4, {wanted})"""


def _flags(alias: str = "us") -> str:
    return ", ".join(
        f"coalesce(CAST({alias}.{column} = '{value}' AS INTEGER), 0) AS {name}"
        for name, (column, value) in features.USER_FLAGS.items()
    )


def _categories(alias: str = "it") -> str:
    return ", ".join(
        f"coalesce(CAST({alias}.category = '{c}' AS INTEGER), 0) AS category_{c}"
        for c in features.CATEGORIES
    )


CONTEXT = """
    CAST(hour(i.timestamp) AS INTEGER) AS hour,
    CAST(isodow(i.timestamp) - 1 AS INTEGER) AS day_of_week,
    CAST(isodow(i.timestamp) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(i.timestamp) BETWEEN 6 AND 9 AS INTEGER) AS is_breakfast,
    CAST(hour(i.timestamp) BETWEEN 11 AND 14 AS INTEGER) AS is_lunch,
    CAST(hour(i.timestamp) BETWEEN 18 AND 21 AS INTEGER) AS is_dinner,
    CAST(hour(i.timestamp) >= 22 OR hour(i.timestamp) < 6 AS INTEGER) AS is_late_night"""
MATCH = """
    CAST(us.veg_preference = 'veg' AND it.veg_flag = 1 AS INTEGER) AS user_item_veg_match,
    CAST((us.user_segment = 'budget' AND it.price < 150)
      OR (us.user_segment = 'premium' AND it.price > 200) AS INTEGER) AS user_item_price_match"""
ITEM_COLUMNS = f"""
    it.price, {r('it.popularity_score')} AS popularity_score, it.veg_flag,
    {r('ln(1 + it.price)')} AS log_price, it.price * it.price AS price_squared,
    {_categories()}, coalesce(it.veg_flag, 0) AS is_veg,
    coalesce(st.unique_users, 0) AS item_unique_users,
    coalesce(st.order_count, 0) AS item_order_count,
    {r('coalesce(st.popularity, 0)')} AS item_popularity"""
CART_COLUMNS = f"""
    i.cart_size, CAST(i.cart_total_price AS DOUBLE) AS cart_total_price,
    {r('i.cart_avg_price')} AS cart_avg_price,
    i.cart_has_main, i.cart_has_drink, i.cart_has_dessert,
    {r('i.cart_veg_ratio')} AS cart_veg_ratio"""
PRICE_STEPS = f"""
    {r('it.price - i.cart_avg_price')} AS price_vs_cart_avg,
    {r('it.price / (i.cart_avg_price + 1)')} AS price_ratio_to_cart"""
ALL_FEATURES = f"""
    {_flags()}, coalesce(su.order_count, 0) AS user_order_count, {ITEM_COLUMNS}, {CART_COLUMNS},
    {MATCH}, {CONTEXT}, {PRICE_STEPS}"""
ALL_JOINS = """
    lcart i LEFT JOIN users us USING (user_id) LEFT JOIN items it USING (item_id)
    LEFT JOIN ustats su USING (user_id) LEFT JOIN istats st USING (item_id)"""


def _metric_columns(kind: str, alias: str) -> str:
    return sql(
        " ".join(f"g{k}" for k in metrics.K_VALUES),
        "SELECT "
        + ", ".join(
            f"(SELECT {r(f'avg({alias})')} FROM g{k}) AS {kind}_{k}" for k in metrics.K_VALUES
        ),
    )


def _report_rows() -> str:
    parts = [
        f"SELECT 'ranking' AS section, '{m}' AS metric, {r(m)} AS value FROM overall"
        for m in ("auc", "average_precision")
    ]
    for k in metrics.K_VALUES:
        for name, column in (
            ("precision", "p"), ("recall", "rc"), ("ndcg", "ndcg"), ("ndcg_full", "ndcg_full")
        ):
            parts.append(f"SELECT 'ranking', '{name}_{k}', {r(f'avg({column})')} FROM g{k}")
    return " UNION ALL ".join(parts)


REPORT_NEEDS = "overall " + " ".join(f"g{k}" for k in metrics.K_VALUES)
BUSINESS = {
    "attach_rate": "acc_orders / n_orders",
    "aov_lift": "revenue / n_orders / (SELECT avg(price) FROM headers)",
    "coverage": "n_items / CAST((SELECT count(DISTINCT item_id) FROM items) AS DOUBLE)",
    "csao_order_share": "acc_orders / n_orders",
    "avg_recommendations_per_order": "n_rows / n_orders",
    "avg_accepted_per_order": "n_accepted / n_orders",
}
BUSINESS_SUMS = """(
    SELECT CAST(count(DISTINCT order_id) AS DOUBLE) AS n_orders, count(*) AS n_rows,
           count(DISTINCT CASE WHEN accepted = 1 THEN order_id END) AS acc_orders,
           count(DISTINCT item_id) AS n_items, sum(accepted) AS n_accepted,
           sum(CASE WHEN accepted = 1 THEN price ELSE 0 END) AS revenue
    FROM drawn)"""


def _similar(length: str) -> str:
    """The ten best partners of every vector among all others."""
    return sql("vectors", f"""
        , v AS (SELECT item_id, vec, {length} AS len FROM vectors)
        SELECT item_id, other_id, similarity, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, other_id)
                       AS rank
              FROM (SELECT a.item_id, b.item_id AS other_id,
                           {r('list_dot_product(a.vec, b.vec) / (a.len * b.len)', 9)} AS similarity
                    FROM v a JOIN v b ON a.item_id <> b.item_id))
        WHERE rank <= 10""")


def _bootstrap() -> str:
    return sql("g10", f"""
        , vals AS (SELECT p AS v, row_number() OVER (ORDER BY p, order_id) - 1 AS idx,
                          count(*) OVER () AS n FROM g10),
        ids AS (SELECT unnest(range(0, 1000 * (SELECT max(n) FROM vals))) AS id),
        h0 AS (SELECT id, xor(id, {SEED}) AS x FROM ids),
        h1 AS (SELECT id, xor(x, x >> 15) * {MIX_MULTIPLIER[0]} & {MASK_32} AS x FROM h0),
        h2 AS (SELECT id, xor(x, x >> 12) * {MIX_MULTIPLIER[1]} & {MASK_32} AS x FROM h1),
        draws AS (SELECT id % 1000 AS replicate,
                         xor(x, x >> 15) * (SELECT max(n) FROM vals) // {2**32} AS idx FROM h2),
        means AS (SELECT replicate, avg(v) AS m FROM draws JOIN vals USING (idx) GROUP BY 1)
        SELECT {r('quantile_cont(m, 0.025)')} AS lower, {r('quantile_cont(m, 0.975)')} AS upper
        FROM means""")


ORACLES: dict[str, str] = {
    # sources and sinks
    "src_users": sql("users", "SELECT * FROM users"),
    "src_restaurants": sql("items", """
        SELECT restaurant_id, 'cuisine ' || restaurant_id % 5 AS cuisine_type,
               'city ' || restaurant_id % 5 AS city,
               CAST(restaurant_id % 4 + 1 AS INTEGER) AS price_range,
               CAST(2.0 AS DOUBLE) + restaurant_id % 31 / CAST(10 AS DOUBLE) AS rating,
               CAST(2.0 AS DOUBLE) + restaurant_id % 29 / CAST(10 AS DOUBLE) AS delivery_rating,
               CAST(15 + restaurant_id % 46 AS DOUBLE) AS avg_prep_time,
               CAST(400 + restaurant_id % 200 AS INTEGER) AS order_volume_30d,
               CASE WHEN restaurant_id % 10 < 3 THEN 1 ELSE 0 END AS chain_flag
        FROM (SELECT DISTINCT restaurant_id FROM items)"""),
    "src_items": sql("items", """
        SELECT item_id, restaurant_id, category, veg_flag, price, popularity_score FROM items"""),
    "src_carts": sql("cart", """
        SELECT session_id, item_id, count(*) AS n_lines FROM cart GROUP BY 1, 2"""),
    "src_interactions": sql("inter", "SELECT * FROM inter"),
    "src_interactions_csv": sql("inter", """
        SELECT order_id, line_key, user_id, item_id, timestamp, clicked FROM inter"""),
    "null_profile": sql("order_items headers", """
        SELECT count(*) FILTER (user_id IS NULL) AS null_user_id,
               count(*) FILTER (restaurant_id IS NULL) AS null_restaurant_id,
               count(*) FILTER (item_id IS NULL) AS null_item_id
        FROM order_items LEFT JOIN headers USING (order_id)"""),
    "sink_embeddings": sql("vectors", f"""
        SELECT item_id, CAST(len(vec) AS INTEGER) AS dim, {r('list_sum(vec)')} AS total
        FROM vectors"""),
    "sink_report": sql(REPORT_NEEDS, _report_rows()),
    # filters and splits
    "filter_positives": sql("inter", "SELECT line_key, item_id, added_to_cart FROM inter"),
    "temporal_split": sql("inter", f"""
        SELECT line_key, timestamp, CASE WHEN timestamp >= {TEST_START} THEN 'test'
               WHEN timestamp >= {VAL_START} THEN 'val' ELSE 'train' END AS split FROM inter"""),
    "feature_select": sql("lcart users items ustats istats", f"""
        SELECT i.line_key, {ALL_FEATURES} FROM {ALL_JOINS}"""),
    "accepted_filter": sql("drawn", """
        SELECT order_id, line_key, item_id FROM drawn WHERE accepted = 1"""),
    "item_in_cart": sql("pos midx cart", f"""
        SELECT line_key, session_id, item_id, added_to_cart FROM ({UNIFORM_5})
        WHERE (session_id, item_id) IN (SELECT (session_id, item_id) FROM cart)"""),
    "exclude_self": sql("pos", """
        SELECT line_key, others, least(40, others) AS n_negatives FROM pos WHERE menu_size > 1"""),
    # joins
    "join_order_header": sql("order_items headers", """
        SELECT line_key, order_id, item_id, user_id, opened_at
        FROM order_items LEFT JOIN headers USING (order_id)"""),
    "join_user_attrs": sql("inter users", """
        SELECT line_key, user_id, user_segment, veg_preference, order_frequency, preferred_cuisine
        FROM inter LEFT JOIN users USING (user_id)"""),
    "join_item_attrs": sql("inter items", f"""
        SELECT i.line_key, i.item_id, price, category, veg_flag,
               {r('popularity_score')} AS popularity_score
        FROM inter i LEFT JOIN items t ON i.item_id = t.item_id"""),
    "join_user_stats": sql("inter ustats", """
        SELECT line_key, user_id, coalesce(order_count, 0) AS user_order_count
        FROM inter LEFT JOIN ustats USING (user_id)"""),
    "join_item_stats": sql("inter istats", f"""
        SELECT line_key, coalesce(unique_users, 0) AS item_unique_users,
               coalesce(order_count, 0) AS item_order_count,
               {r('coalesce(popularity, 0)', 9)} AS item_popularity
        FROM inter LEFT JOIN istats USING (item_id)"""),
    "join_cart": sql("lcart", "SELECT line_key, session_id, cart_size FROM lcart"),
    "join_segment_price": sql("inter users items", """
        SELECT line_key, user_segment, price
        FROM inter LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id)"""),
    "join_session_order": sql("pos midx", f"""
        SELECT session_id, order_id, count(*) AS n_rows,
               count(*) FILTER (added_to_cart = 0) AS n_negatives
        FROM ({RANDOM}) GROUP BY 1, 2"""),
    "join_menu": sql("pos", """
        SELECT line_key, restaurant_id, item_id, menu_size FROM pos WHERE menu_size > 1"""),
    "pair_self_join": sql("inter", """
        SELECT least(a.item_id, b.item_id) AS item_a, greatest(a.item_id, b.item_id) AS item_b,
               count(*) AS pairs
        FROM inter a JOIN inter b ON a.session_id = b.session_id AND a.line_key < b.line_key
        GROUP BY 1, 2"""),
    # statistics
    "user_stats": sql("ustats users", """
        SELECT user_id, order_count, first_order, last_order, user_segment, veg_preference,
               preferred_cuisine
        FROM ustats LEFT JOIN users USING (user_id)"""),
    "item_stats": sql("istats items", f"""
        SELECT item_id, unique_users, order_count, {r('popularity', 9)} AS popularity_score,
               price, category, veg_flag
        FROM istats LEFT JOIN items USING (item_id)"""),
    "item_popularity": sql("inter", f"""
        SELECT item_id, count(*) AS count,
               {r('count(*) / CAST((SELECT count(*) FROM inter) AS DOUBLE)', 9)} AS prob
        FROM inter GROUP BY 1"""),
    "menu": sql("midx", """
        SELECT restaurant_id, idx // 256 AS page, menu_size,
               CAST(idx % 256 AS INTEGER) AS slot, item_id FROM midx"""),
    "item_cooccurrence": sql("inter", """
        SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cooc
        FROM inter a JOIN inter b ON a.session_id = b.session_id AND a.line_key <> b.line_key
        GROUP BY 1, 2"""),
    "category_transitions": sql("inter items", f"""
        , t AS (SELECT category AS category_from, nxt AS category_to, count(*) AS n
                FROM (SELECT category, lead(category) OVER w AS nxt, lead(line_key) OVER w AS more
                      FROM inter LEFT JOIN items USING (item_id)
                      WINDOW w AS (PARTITION BY session_id ORDER BY {TS}))
                WHERE more IS NOT NULL GROUP BY 1, 2)
        SELECT category_from, category_to, n,
               {r('n / CAST((SELECT sum(n) FROM t) AS DOUBLE)')} AS prob FROM t"""),
    "session_sequences": sql("inter", f"""
        SELECT order_id, CAST(0 AS BIGINT) AS part,
               string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY {TS}) AS items
        FROM inter GROUP BY 1"""),
    "group_sizes": sql("scored", """
        SELECT order_id, count(*) AS group_size FROM scored GROUP BY 1"""),
    "candidate_set_check": sql("pos midx", f"""
        SELECT count(*) AS sessions, count(*) FILTER (n_pos = 0) AS without_positives,
               count(*) FILTER (n_neg = 0) AS without_negatives,
               count(*) FILTER (n_neg < 5) AS few_negatives,
               {r('avg(n_pos)')} AS avg_positives, {r('avg(n_neg)')} AS avg_negatives,
               min(n_neg) AS min_negatives, max(n_neg) AS max_negatives
        FROM (SELECT session_id, count(*) FILTER (added_to_cart = 1) AS n_pos,
                     count(*) FILTER (added_to_cart = 0) AS n_neg
              FROM ({RANDOM}) GROUP BY 1)"""),
    "nunique_orders": sql("drawn", """
        SELECT count(DISTINCT order_id) AS n_orders,
               count(DISTINCT CASE WHEN accepted = 1 THEN order_id END) AS n_accepted_orders,
               count(DISTINCT item_id) AS n_items FROM drawn"""),
    # negative sampling
    "neg_uniform": sql("inter midx", """
        SELECT line_key, item_id, 1 AS added_to_cart FROM inter
        UNION ALL
        SELECT i.line_key, m.item_id, 0 FROM inter i JOIN midx m USING (restaurant_id)
        WHERE m.item_id <> i.item_id AND m.menu_size <= 41"""),
    "neg_random": sql("pos midx", f"{KEYS} ({RANDOM})"),
    "neg_popular": popular(),
    "neg_mixed": sql("pos midx", f"{KEYS} ({MIXED})"),
    "neg_excluding_session": sql("pos midx", f"""
        , kept AS (SELECT p.*, b.bought FROM pos p JOIN (
              SELECT session_id, restaurant_id, list_sort(list(DISTINCT own)) AS bought
              FROM pos WHERE own IS NOT NULL GROUP BY 1, 2) b USING (session_id, restaurant_id))
        {KEYS} ({COMPLEMENT_5})"""),
    "neg_union": sql("pos midx", f"""
        SELECT order_id, session_id, user_id, item_id, restaurant_id, added_to_cart, timestamp
        FROM ({UNIFORM_5})"""),
    # features
    "feat_user": sql("inter users ustats", f"""
        SELECT i.line_key, {_flags()}, coalesce(su.order_count, 0) AS user_order_count
        FROM inter i LEFT JOIN users us USING (user_id) LEFT JOIN ustats su USING (user_id)"""),
    "feat_item": sql("inter items istats", f"""
        SELECT i.line_key, {ITEM_COLUMNS}
        FROM inter i LEFT JOIN items it USING (item_id) LEFT JOIN istats st USING (item_id)"""),
    "feat_cart": sql("lcart", f"SELECT line_key, {CART_COLUMNS} FROM lcart i"),
    "feat_cart_cooccurrence": sql("inter cart cooc", f"""
        SELECT i.line_key, {r('coalesce(s.score / s.n, 0)')} AS cart_cooccurrence
        FROM inter i LEFT JOIN (
          SELECT l.line_key, CAST(sum(coalesce(cooc, 0)) AS DOUBLE) AS score, count(*) AS n
          FROM inter l JOIN cart c ON c.session_id = l.session_id
          LEFT JOIN cooc ON item_a = l.item_id AND item_b = c.item_id GROUP BY 1) s
        USING (line_key)"""),
    "feat_interaction": sql("inter users items", f"""
        SELECT i.line_key, {MATCH}
        FROM inter i LEFT JOIN users us USING (user_id) LEFT JOIN items it USING (item_id)"""),
    "feat_context": sql("inter", f"SELECT i.line_key, {CONTEXT} FROM inter i"),
    "feat_price_progression": sql("lcart items", f"""
        SELECT i.line_key, {PRICE_STEPS} FROM lcart i LEFT JOIN items it USING (item_id)"""),
    "feat_category_transition": sql("inter cart items steps", f"""
        , last AS (SELECT session_id, arg_max(category, row(timestamp, position_in_cart, item_id,
                          line_key)) AS category_from
                   FROM cart JOIN items USING (item_id) GROUP BY 1)
        SELECT i.line_key, it.category,
               {r('coalesce(s.n / CAST((SELECT sum(n) FROM steps) AS DOUBLE), 0)')}
                 AS category_transition_prob
        FROM inter i LEFT JOIN items it USING (item_id) LEFT JOIN last USING (session_id)
        LEFT JOIN steps s ON s.category_from = last.category_from AND s.category_to = it.category"""),
    "engineer_features": sql("lcart users items ustats istats", f"""
        SELECT i.line_key, us.user_segment, it.category, {ALL_FEATURES} FROM {ALL_JOINS}"""),
    "cyclical_time": sql("inter", f"""
        SELECT line_key, {r('sin(2 * pi() * hour(timestamp) / 24)')} AS hour_sin,
               {r('cos(2 * pi() * hour(timestamp) / 24)')} AS hour_cos FROM inter"""),
    "safe_divide_cart": sql("inter headers", f"""
        SELECT order_id, CASE WHEN n > 0 THEN {r('c / CAST(n AS DOUBLE)')} ELSE 0 END AS share
        FROM headers LEFT JOIN (
          SELECT order_id, count(*) AS n, count(DISTINCT item_id) AS c
          FROM inter GROUP BY 1) USING (order_id)"""),
    "clip_outliers": sql("headers", f"""
        SELECT order_id, {r('least(greatest(price, lo), hi)')} AS price
        FROM headers, (SELECT quantile_cont(price, 0.01) AS lo, quantile_cont(price, 0.99) AS hi
                       FROM headers)"""),
    # vectors
    "item_vector_lookup": sql("items vectors", f"""
        SELECT item_id, CAST(pos AS INTEGER) AS pos,
               {r('coalesce(vec[pos + 1], 0)')} AS x
        FROM (SELECT item_id, unnest(range(0, {DIM})) AS pos FROM items)
        LEFT JOIN vectors USING (item_id)"""),
    "user_embedding": sql("inter vectors", f"""
        , w AS (SELECT user_id, item_id, exp(CAST(-0.1 AS DOUBLE) * (row_number() OVER (
                  PARTITION BY user_id ORDER BY {TS_DESC}) - 1)) AS w FROM inter)
        SELECT user_id, CAST(pos AS INTEGER) AS pos, {r('sum(w * x) / sum(w)')} AS x
        FROM (SELECT user_id, w, unnest(range(0, {DIM})) AS pos, unnest(vec) AS x
              FROM w JOIN vectors USING (item_id)) GROUP BY 1, 2"""),
    "user_item_similarity": sql("inter uvec vectors", f"""
        , uv AS (SELECT user_id, list(x ORDER BY pos) AS uvec FROM uvec GROUP BY 1)
        SELECT line_key, {r('coalesce(list_dot_product(uvec, vec), 0)')} AS user_item_similarity
        FROM inter LEFT JOIN uv USING (user_id) LEFT JOIN vectors USING (item_id)"""),
    "embedding_norms": sql("inter uvec vectors", f"""
        , un AS (SELECT user_id, sqrt(sum(x * x)) AS un FROM uvec GROUP BY 1)
        SELECT line_key, {r('coalesce(sqrt(list_dot_product(vec, vec)), 0)')} AS item_embedding_norm,
               {r('coalesce(un, 0)')} AS user_embedding_norm
        FROM inter LEFT JOIN un USING (user_id) LEFT JOIN vectors USING (item_id)"""),
    "cart_item_similarity": sql("inter cart vectors", f"""
        , sizes AS (SELECT session_id, count(*) AS n FROM cart GROUP BY 1),
        sums AS (SELECT session_id, pos, sum(x) AS x
                 FROM (SELECT session_id, unnest(range(0, {DIM})) AS pos, unnest(vec) AS x
                       FROM cart JOIN vectors USING (item_id)) GROUP BY 1, 2),
        cv AS (SELECT session_id, list(x / n ORDER BY pos) AS cvec
               FROM sums JOIN sizes USING (session_id) GROUP BY 1)
        SELECT line_key, {r('coalesce(list_dot_product(cvec, vec), 0)')} AS cart_item_similarity
        FROM inter LEFT JOIN cv USING (session_id) LEFT JOIN vectors USING (item_id)"""),
    "similar_items": _similar("sqrt(list_dot_product(vec, vec))"),
    "embedding_neighbors": _similar("CAST(1 AS DOUBLE)"),
    # ranking
    "topk_per_group": sql("ranked", """
        SELECT order_id, item_id, line_key, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE rank <= 10"""),
    "predict_top_n": sql("inter items", """
        SELECT order_id, item_id, line_key, CAST(rank AS INTEGER) AS rank
        FROM (SELECT i.order_id, i.item_id, i.line_key, row_number() OVER (
                PARTITION BY i.order_id ORDER BY it.popularity_score * it.price DESC, i.item_id,
                i.line_key) AS rank
              FROM inter i LEFT JOIN items it ON i.item_id = it.item_id)
        WHERE rank <= 3"""),
    "consecutive_pairs": sql("inter items", f"""
        SELECT session_id, category AS category_from, nxt AS category_to, count(*) AS n
        FROM (SELECT session_id, category, lead(category) OVER w AS nxt,
                     lead(line_key) OVER w AS more
              FROM inter LEFT JOIN items USING (item_id)
              WINDOW w AS (PARTITION BY session_id ORDER BY {TS}))
        WHERE more IS NOT NULL GROUP BY 1, 2, 3"""),
    "recency_rank": sql("inter", f"""
        SELECT user_id, line_key,
               row_number() OVER (PARTITION BY user_id ORDER BY {TS_DESC}) - 1 AS age
        FROM inter"""),
    "minmax_scale": sql("headers", f"""
        SELECT order_id, {r('price')} AS price, {r('(price - lo) / (hi - lo)')} AS scaled
        FROM headers, (SELECT min(price) AS lo, max(price) AS hi FROM headers)"""),
    "auc": sql("overall", f"SELECT {r('auc')} AS auc FROM overall"),
    "average_precision": sql("overall", f"""
        SELECT {r('average_precision')} AS average_precision FROM overall"""),
    "precision_at_k": _metric_columns("precision", "p"),
    "recall_at_k": _metric_columns("recall", "rc"),
    "ndcg_at_k": _metric_columns("ndcg", "ndcg"),
    "ndcg_at_k_full": _metric_columns("ndcg_full", "ndcg_full"),
    "precision_at_k_util": sql("g10", f"""
        SELECT order_id, n AS group_size, {r('p')} AS precision_10 FROM g10"""),
    "recall_at_k_util": sql("g10", f"""
        SELECT order_id, CAST(rel AS BIGINT) AS n_relevant, {r('rc')} AS recall_10 FROM g10"""),
    "ranking_report": sql(REPORT_NEEDS, _report_rows()),
    "compare_to_baseline": sql("overall", f"""
        SELECT {r('auc')} AS auc, CAST(0.725 AS DOUBLE) AS baseline_auc,
               {r('(auc - 0.725::DOUBLE) / 0.725::DOUBLE * 100')} AS improvement_pct FROM overall"""),
    "bootstrap_ci": _bootstrap(),
    # business
    "acceptance_prob": sql("probs", f"""
        SELECT line_key, item_id, user_segment, price, {r('scaled')} AS score_normalized,
               {r('prob')} AS acceptance_prob FROM probs"""),
    "acceptance_draw": sql("drawn", "SELECT line_key, item_id, accepted FROM drawn"),
    "business_metrics": sql("drawn headers items", "SELECT " + ", ".join(
        f"{r(e)} AS {n}" for n, e in BUSINESS.items()) + f" FROM {BUSINESS_SUMS}"),
    "aov_lift_util": sql("order_items headers", f"""
        SELECT {r('(t - b) / b')} AS aov_lift
        FROM (SELECT avg(price) FILTER (coalesce(treated, 0) = 0) AS b,
                     avg(price) FILTER (treated = 1) AS t
              FROM headers LEFT JOIN (SELECT order_id, max(is_recommended) AS treated
                                      FROM order_items GROUP BY 1) USING (order_id))"""),
    "attach_rate_util": sql("drawn", f"""
        SELECT user_segment, {r('sum(accepted) / CAST(count(*) AS DOUBLE)')} AS attach_rate
        FROM drawn GROUP BY 1"""),
    "c2o_ratio": sql("headers cart", f"""
        SELECT {r('''(SELECT count(DISTINCT order_id) FROM headers)
          / CAST(count(DISTINCT session_id) AS DOUBLE)''')} AS c2o_ratio FROM cart"""),
    "evaluate": sql(REPORT_NEEDS + " drawn headers items", _report_rows() + " UNION ALL " + " UNION ALL ".join(
        f"SELECT 'business', '{n}', {r(e)} FROM {BUSINESS_SUMS}" for n, e in BUSINESS.items())),
    # learning to rank
    "group_kfold": sql("inter", """
        SELECT order_id, group_size, CAST(CASE WHEN (place // 3) % 2 = 0 THEN place % 3
               ELSE 2 - place % 3 END AS INTEGER) AS fold
        FROM (SELECT order_id, group_size,
                     row_number() OVER (ORDER BY group_size DESC, order_id) - 1 AS place
              FROM (SELECT order_id, count(*) AS group_size FROM inter GROUP BY 1))"""),
}


# Features of the frames without carts, in the order of their columns.
FEATURE_NAMES = """
    user_order_count segment_budget segment_regular segment_premium veg_preference_veg
    veg_preference_nonveg veg_preference_both order_freq_low order_freq_medium
    order_freq_high hour day_of_week is_weekend is_breakfast is_lunch is_dinner
    is_late_night user_embedding_norm price veg_flag popularity_score item_unique_users
    item_order_count item_popularity log_price price_squared category_main category_drink
    category_dessert category_snack category_starter category_beverage is_veg
    item_embedding_norm user_item_veg_match user_item_price_match user_item_similarity
""".split()


def _candidates(where: str) -> str:
    """Positives of a period, and all other items of their menus (menus hold at most 41)."""
    return sql("inter midx", f"""
        , own AS (SELECT * FROM inter WHERE {where}),
        pairs AS (SELECT line_key, item_id, 1 AS added_to_cart FROM own
                  UNION ALL
                  SELECT i.line_key, m.item_id, 0 FROM own i JOIN midx m USING (restaurant_id)
                  WHERE m.item_id <> i.item_id AND m.menu_size <= 41)""")


def _feature_rows(columns: str) -> str:
    names = ", ".join(f"('{name}')" for name in FEATURE_NAMES)
    return f"SELECT feature, {columns} FROM (VALUES {names}) f(feature)"


TRAIN_ITEMS = f"SELECT item_id FROM inter WHERE timestamp < {VAL_START} GROUP BY 1 HAVING count(*) >= 2"

# Learned numbers have no twin: keys, counts, bounds and agreements do.
ORACLES |= {
    "item2vec_fit": sql("inter", f"SELECT item_id, {DIM} AS dim FROM ({TRAIN_ITEMS})"),
    "embedding_tables": sql("inter", f"""
        SELECT 'item' AS kind, count(*) AS n, {DIM} AS dim FROM ({TRAIN_ITEMS})
        UNION ALL
        SELECT 'user', count(DISTINCT user_id), {DIM} FROM inter
        WHERE timestamp < {VAL_START} AND item_id IN ({TRAIN_ITEMS})"""),
    "sink_model": _candidates(f"timestamp >= {VAL_START} AND timestamp < {TEST_START}")
    + " SELECT line_key, item_id, true AS same FROM pairs",
    "ranker_predict": _candidates(f"timestamp >= {TEST_START}")
    + " SELECT line_key, item_id, added_to_cart, true AS scored FROM pairs",
    "ranker_fit": _feature_rows("true AS finite"),
    "feature_importance": _feature_rows("true AS in_bounds, CAST(1 AS DOUBLE) AS total"),
    "top_features": "SELECT CAST(i AS INTEGER) AS place, true AS holds FROM range(1, 11) t(i)",
    "ranker_cv": "SELECT CAST(i AS INTEGER) AS fold, true AS in_bounds FROM range(0, 3) t(i)",
    "training_history": """
        SELECT data, 1 AS first, true AS no_gaps, true AS waited, true AS in_bounds
        FROM (VALUES ('train'), ('valid')) t(data)""",
    "model_info": f"""
        SELECT 'trained' AS status, {len(FEATURE_NAMES)} AS n_features, true AS cut_at_best,
               true AS in_bounds, 10 AS n_top_features""",
    "train_production": f"SELECT section, metric, true AS finite FROM ({ORACLES['evaluate']})",
}
