"""SQL for each registered query, over the plain Parquet tables.

Written join first, aggregate second, without the rewrites the Spark plans use.
"""

from __future__ import annotations

# Sentiment word lists of the check: frequent words of the documents, which are invented prose.
POSITIVE = ("the", "and", "to", "in", "is", "la", "der", "que")
NEGATIVE = ("of", "de", "en", "le", "die", "on", "un", "el")

_TABLES = {
    "cust": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_mktsegment = 'BUILDING' THEN n_name
                    WHEN c_mktsegment = 'MACHINERY' THEN NULL
                    ELSE CAST(c_custkey AS VARCHAR) || ' Main St, ' || n_name END AS address
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "placed": """
        SELECT customer_id,
               CASE WHEN contains(address, ',') THEN trim(split_part(address, ',', 2)) ELSE address END AS state
        FROM cust""",
    "ord": """
        SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id,
               o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               o_orderstatus AS status, o_orderpriority AS payment_method
        FROM orders""",
    "item": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_tax >= 0.08 THEN -1 - l_partkey ELSE l_partkey END AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
        FROM lineitem""",
    "prod": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price
        FROM part""",
    "inv": """
        SELECT CASE WHEN l_returnflag = 'R' THEN -1 - l_partkey ELSE l_partkey END AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, l_suppkey AS warehouse_id
        FROM lineitem""",
    "pref": """
        SELECT conv_id AS customer_id, role AS preference_type, CAST(turn AS VARCHAR) AS preference_value
        FROM conversations""",
    "spec": """
        SELECT p_partkey AS product_id, 'Battery Life' AS spec_name, CAST(p_size AS VARCHAR) || ' hours' AS spec_value FROM part
        UNION ALL SELECT p_partkey, 'storage', CAST(p_size * 8 AS VARCHAR) || ' GB' FROM part
        UNION ALL SELECT p_partkey, 'Brand', p_brand FROM part""",
    "words": """
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w IN ({all_words})) AS hits
        FROM documents""",
    "scored": """
        SELECT doc_id, CAST(2 * len(list_filter(hits, lambda w: w IN ({positive}))) - len(hits) AS DOUBLE)
               / nullif(len(hits), 0) AS score
        FROM words""",
    "rev": """
        SELECT event_id AS review_id, user_id AS product_id, user_id AS customer_id,
               round(CAST(value AS DECIMAL(12,2)), 0) AS rating, event_type AS title, text AS content,
               CAST(ts AS DATE) AS review_date,
               CASE WHEN event_type = 'purchase' THEN 'true' ELSE 'false' END AS verified_purchase,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS helpful_votes,
               CASE WHEN score > 0.6 THEN 'Positive' WHEN score < 0.4 THEN 'Negative' ELSE 'Neutral' END AS sentiment_score
        FROM events LEFT JOIN documents ON event_id = documents.doc_id
                    LEFT JOIN scored ON event_id = scored.doc_id""",
    "aspect": """
        SELECT review_id, 'Quality' AS name, CAST(helpful_votes AS DOUBLE) AS rating FROM rev WHERE title IN ('click', 'purchase', 'signup')
        UNION ALL SELECT review_id, 'Quality', helpful_votes / 2.0 FROM rev WHERE title = 'signup'
        UNION ALL SELECT review_id, 'Battery Life', helpful_votes / 2.0 FROM rev WHERE title = 'purchase'
        UNION ALL SELECT review_id, 'Value for Money', helpful_votes FROM rev WHERE title = 'signup'
        UNION ALL SELECT review_id, 'Packaging', helpful_votes FROM rev WHERE title = 'error'""",
    "pivoted": """
        SELECT product_id, rev.review_id, customer_id, rev.rating, title, content, review_date, verified_purchase, sentiment_score,
               max(CASE WHEN name = 'Battery Life' THEN aspect.rating END) AS "Battery Life",
               max(CASE WHEN name = 'Quality' THEN aspect.rating END) AS "Quality",
               max(CASE WHEN name = 'Value for Money' THEN aspect.rating END) AS "Value for Money"
        FROM rev JOIN aspect ON rev.review_id = aspect.review_id
        GROUP BY product_id, rev.review_id, customer_id, rev.rating, title, content, review_date, verified_purchase, sentiment_score""",
    "review_figures": """
        SELECT CAST(product_id AS VARCHAR) AS product_id,
               CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating,
               count(review_id) AS total_reviews,
               CAST(sum(CASE WHEN verified_purchase = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS verified_reviews,
               CAST(sum(CAST("Battery Life" AS DECIMAL(18,6))) AS DOUBLE) / count("Battery Life") AS avg_battery_rating,
               CAST(sum(CAST("Quality" AS DECIMAL(18,6))) AS DOUBLE) / count("Quality") AS avg_quality_rating,
               CAST(sum(CAST("Value for Money" AS DECIMAL(18,6))) AS DOUBLE) / count("Value for Money") AS avg_value_rating,
               count(CASE WHEN sentiment_score = 'Positive' THEN 1 END) AS positive_reviews,
               count(CASE WHEN sentiment_score = 'Negative' THEN 1 END) AS negative_reviews
        FROM pivoted GROUP BY product_id""",
    "detail": """
        SELECT ord.order_id, ord.customer_id, order_date, total_amount, status, payment_method, item.product_id, quantity,
               unit_price, product_name, category, state, quantity * unit_price AS line_total,
               item.order_id AS order_id_order_items, prod.product_id AS product_id_products,
               placed.customer_id AS customer_id_customer
        FROM ord LEFT JOIN item ON ord.order_id = item.order_id
                 LEFT JOIN prod ON item.product_id = prod.product_id
                 LEFT JOIN placed ON ord.customer_id = placed.customer_id""",
    "perf": """
        SELECT item.product_id, product_name, category, count(DISTINCT order_id) AS total_orders,
               CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
               CAST(sum(unit_price * quantity) AS DOUBLE) AS total_revenue,
               sum(unit_price * quantity) AS exact_revenue
        FROM item LEFT JOIN prod ON item.product_id = prod.product_id
        GROUP BY item.product_id, product_name, category""",
    "cat": """
        SELECT category, CAST(sum(total_orders) AS BIGINT) AS total_orders,
               CAST(sum(total_quantity_sold) AS BIGINT) AS total_quantity_sold,
               CAST(sum(exact_revenue) AS DOUBLE) AS total_revenue,
               CAST(sum(exact_revenue) AS DOUBLE) / sum(total_orders) AS avg_order_value
        FROM perf GROUP BY category""",
    "top_perf": """
        SELECT * FROM (SELECT * EXCLUDE (exact_revenue), 'quantity_sold' AS metric FROM perf
                       ORDER BY total_quantity_sold DESC NULLS LAST, product_id LIMIT 10)
        UNION
        SELECT * FROM (SELECT * EXCLUDE (exact_revenue), 'revenue' AS metric FROM perf
                       ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10)""",
    "top_cat": """
        SELECT * FROM (SELECT *, 'quantity_sold' AS metric FROM cat
                       ORDER BY total_quantity_sold DESC NULLS LAST, category NULLS LAST LIMIT 5)
        UNION
        SELECT * FROM (SELECT *, 'revenue' AS metric FROM cat
                       ORDER BY total_revenue DESC NULLS LAST, category NULLS LAST LIMIT 5)""",
    "by_state": """
        SELECT state, category, count(DISTINCT order_id) AS order_count,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(line_total) AS DOUBLE) AS total_revenue,
               CAST(sum(line_total) AS DOUBLE) / nullif(count(DISTINCT order_id), 0) AS avg_order_value
        FROM detail GROUP BY state, category""",
    "top_state": """
        SELECT * EXCLUDE (rnk) FROM (
            SELECT *, rank() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST) AS rnk FROM by_state)
        WHERE rnk <= 3""",
    "spec_text": """
        SELECT product_id, string_agg(spec_name || '=' || spec_value, '|' ORDER BY spec_name, spec_value) AS specifications
        FROM spec GROUP BY product_id""",
    "monthly": """
        SELECT product_id, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month,
               count(item.order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               CAST(sum(unit_price * quantity) AS DOUBLE) AS total_sales,
               CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_price
        FROM item LEFT JOIN ord ON item.order_id = ord.order_id GROUP BY ALL""",
    "gold_perf": """
        SELECT prod.product_id, product_name, category, order_month, total_sales, total_orders, avg_price, specifications
        FROM prod LEFT JOIN spec_text ON prod.product_id = spec_text.product_id
                  LEFT JOIN monthly ON prod.product_id = monthly.product_id""",
    "stats": """
        SELECT customer_id, first_name, last_name, CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_spend,
               count(order_id) AS order_count, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value
        FROM ord JOIN cust USING (customer_id) GROUP BY customer_id, first_name, last_name""",
    "status_months": """
        SELECT strftime(order_date, '%Y-%m') AS order_month, status, count(*) AS count FROM ord GROUP BY ALL""",
    "payment_months": """
        SELECT strftime(order_date, '%Y-%m') AS order_month, payment_method, count(*) AS count FROM ord GROUP BY ALL""",
    "months": """
        SELECT strftime(order_date, '%Y-%m') AS order_month, CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue
        FROM ord GROUP BY ALL""",
    "stock": """
        SELECT prod.product_id, product_name, category, total_stock
        FROM prod LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_stock FROM inv GROUP BY product_id) s
             ON prod.product_id = s.product_id""",
    "spec_wide": """
        SELECT prod.product_id, product_name,
               max(CASE WHEN spec_name ILIKE 'battery life' THEN spec_value END) AS battery_life,
               max(CASE WHEN spec_name ILIKE 'storage' THEN spec_value END) AS storage
        FROM prod LEFT JOIN spec ON prod.product_id = spec.product_id GROUP BY prod.product_id, product_name""",
    "pref_counts": """
        SELECT preference_type || ' - ' || preference_value AS preference, count(*) AS count FROM pref GROUP BY preference""",
    "checks": """
        SELECT count(*) AS n, count(verified_purchase) AS verified_n,
               count(*) FILTER (verified_purchase NOT IN ('FALSE')) AS not_false,
               count(*) FILTER (verified_purchase NOT IN ('true', 'false')) AS not_bool,
               count(*) FILTER (title NOT IN ('click', 'purchase', 'signup')) AS odd_title,
               min(helpful_votes) AS least
        FROM rev""",
    "sampled": """
        SELECT * FROM rev ORDER BY sha256(CAST(review_id AS VARCHAR)), CAST(review_id AS VARCHAR) LIMIT 2000""",
}


def _quoted(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def _with(body: str) -> str:
    """``body`` behind the CTEs it needs, directly or through other CTEs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        tokens = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
        for name in tokens & _TABLES.keys() - needed:
            needed.add(name)
            visit(_TABLES[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in _TABLES.items() if name in needed)
    sql = f"WITH {ctes}\n{body}" if ctes else body
    return (
        sql.replace("{all_words}", _quoted(POSITIVE + NEGATIVE))
        .replace("{positive}", _quoted(POSITIVE))
        .replace("{negative}", _quoted(NEGATIVE))
    )


def _check_row(number: int, name: str, column: str, success: str, counts: str) -> str:
    return f"SELECT CAST({number} AS INTEGER) AS check_no, '{name}' AS expectation, '{column}' AS \"column\", {success} AS success, {counts} FROM checks"


def _in_set(number: int, column: str, unexpected: str) -> str:
    return _check_row(
        number, "expect_column_values_to_be_in_set", column, f"{unexpected} = 0",
        f"n AS element_count, CAST(0 AS BIGINT) AS missing_count, {unexpected} AS unexpected_count, "
        f"{unexpected} * 100.0::DOUBLE / n AS unexpected_percent, CAST(NULL AS VARCHAR) AS observed_value",
    )


def _min_between(number: int, column: str, low: int, high: int) -> str:
    return _check_row(
        number, "expect_column_min_to_be_between", column, f"least BETWEEN {low} AND {high}",
        "CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count, CAST(NULL AS BIGINT) AS unexpected_count, "
        "CAST(NULL AS DOUBLE) AS unexpected_percent, CAST(least AS VARCHAR) AS observed_value",
    )


_DETAIL_OUT = """SELECT {keys} order_id, customer_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount, status, payment_method,
    product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, product_name, category, state,
    CAST(line_total AS DOUBLE) AS line_total FROM detail"""

_NIGHTLY_TABLES = {
    "BRONZE_CUSTOMERS": ("length(address)", "cust"),
    "BRONZE_PRODUCTS": ("100 * price", "prod"),
    "BRONZE_INVENTORY": ("quantity", "inv"),
    "BRONZE_ORDERS": ("100 * total_amount", "ord"),
    "BRONZE_ORDER_ITEMS": ("100 * unit_price * quantity", "item"),
    "BRONZE_PRODUCT_REVIEWS": ("helpful_votes", "rev"),
    "BRONZE_CUSTOMER_PREFERENCES": ("length(preference_value)", "pref"),
    "BRONZE_PRODUCT_SPECIFICATIONS": ("length(spec_value)", "spec"),
    "SILVER_CUSTOMERS": (
        "n", "(SELECT cust.customer_id, nullif(count(preference_type), 0) AS n FROM cust LEFT JOIN pref "
        "ON cust.customer_id = pref.customer_id GROUP BY cust.customer_id)"
    ),
    "SILVER_PRODUCTS": (
        "n", "(SELECT prod.product_id, count(spec_name) AS n FROM prod LEFT JOIN spec "
        "ON prod.product_id = spec.product_id GROUP BY prod.product_id)"
    ),
    "SILVER_PRODUCT_REVIEWS": ("CASE WHEN sentiment_score = 'Positive' THEN 1 ELSE 0 END", "rev"),
    "SILVER_ORDERS": (
        "CASE WHEN state IS NULL THEN 0 ELSE 1 END", "ord LEFT JOIN placed ON ord.customer_id = placed.customer_id"
    ),
    "GOLD_CUSTOMER_INSIGHTS": (
        "n", "(SELECT cust.customer_id, state, count(order_id) AS n FROM cust JOIN placed ON cust.customer_id = placed.customer_id "
        "LEFT JOIN ord ON cust.customer_id = ord.customer_id "
        "GROUP BY cust.customer_id, state)"
    ),
    "GOLD_PRODUCT_REVIEWS_ANALYTICS": ("positive_reviews", "review_figures"),
    "GOLD_PRODUCT_PERFORMANCE": ("total_orders", "gold_perf"),
    "analytics_top_selling_products_by_quantity": ("total_quantity_sold", "top_perf WHERE metric = 'quantity_sold'"),
    "analytics_top_selling_products_by_revenue": ("total_quantity_sold", "top_perf WHERE metric = 'revenue'"),
    "analytics_top_selling_categories_by_quantity": ("total_quantity_sold", "top_cat WHERE metric = 'quantity_sold'"),
    "analytics_top_selling_categories_by_revenue": ("total_quantity_sold", "top_cat WHERE metric = 'revenue'"),
    "analytics_state_category_analysis": ("order_count", "top_state"),
    "analytics_customer_stats": ("order_count", "stats"),
    "analytics_monthly_revenue": (
        "s", "(SELECT 100 * sum(total_amount) AS s FROM ord GROUP BY strftime(order_date, '%Y-%m'))"
    ),
    "analytics_order_status_counts": ("count", "status_months"),
    "analytics_payment_method_counts": ("count", "payment_months"),
    "analytics_inventory_per_product": ("total_stock", "stock"),
    "analytics_inventory_per_category": (
        "s", "(SELECT category, sum(total_stock) AS s FROM stock WHERE category IS NOT NULL GROUP BY category)"
    ),
    "analytics_inventory_per_warehouse": (
        "s", "(SELECT warehouse_id, sum(quantity) AS s FROM inv GROUP BY warehouse_id)"
    ),
    "analytics_product_price_stats": (
        "s", "(SELECT 100 * (min(price) + max(price)) AS s FROM prod GROUP BY category)"
    ),
}

_NIGHTLY = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n, count(*) AS n_written, CAST(sum({figure}) AS BIGINT) AS figure FROM {source}"
    for name, (figure, source) in _NIGHTLY_TABLES.items()
) + """
UNION ALL SELECT 'audit of driver-tables' || CASE WHEN not_false = 0 AND least BETWEEN 12 AND 20 THEN ' passed' ELSE ' failed' END, 1, 1, not_false
FROM checks"""

_BODIES = {
    "clean_names": 'SELECT c_custkey, c_name, c_mktsegment AS "Market Segment" FROM customer',
    "order_details": _DETAIL_OUT.replace("{keys}", "order_id_order_items, product_id_products, customer_id_customer,"),
    "product_performance": "SELECT * EXCLUDE (exact_revenue) FROM perf",
    "category_performance": "SELECT * FROM cat",
    "customer_order_history": _DETAIL_OUT.replace("{keys}", "") + " WHERE customer_id = 7",
    "top_products": "SELECT * FROM top_perf",
    "top_products_by_quantity": "SELECT * FROM top_perf WHERE metric = 'quantity_sold'",
    "top_products_by_revenue": "SELECT * FROM top_perf WHERE metric = 'revenue'",
    "top_categories": "SELECT * FROM top_cat",
    "top_categories_by_quantity": "SELECT * FROM top_cat WHERE metric = 'quantity_sold'",
    "top_categories_by_revenue": "SELECT * FROM top_cat WHERE metric = 'revenue'",
    "state_category": "SELECT * FROM by_state",
    "state_category_top3": "SELECT * FROM top_state",
    "silver_customers": """
        SELECT cust.*, p.customer_id AS customer_id_right, preferences
        FROM cust LEFT JOIN (
            SELECT customer_id, string_agg(preference_type || '=' || preference_value, '|' ORDER BY preference_type, preference_value) AS preferences
            FROM pref GROUP BY customer_id) p ON cust.customer_id = p.customer_id""",
    "silver_preferences_hot_key": """
        SELECT cust.customer_id, n, preferences_sha256
        FROM cust JOIN (
            SELECT customer_id % 5 + 1 AS customer_id, count(*) AS n,
                   sha256(string_agg(preference_type || '=' || preference_value, '|' ORDER BY preference_type, preference_value)) AS preferences_sha256
            FROM pref GROUP BY ALL) p ON cust.customer_id = p.customer_id""",
    "silver_products": """
        SELECT prod.product_id, product_name, category, CAST(price AS DOUBLE) AS price,
               spec_text.product_id AS product_id_right, specifications
        FROM prod LEFT JOIN spec_text ON prod.product_id = spec_text.product_id""",
    "silver_reviews_sentiment": """
        SELECT doc_id AS review_id,
               CASE WHEN score > 0.6 THEN 'Positive' WHEN score < 0.4 THEN 'Negative' ELSE 'Neutral' END AS sentiment_score
        FROM scored""",
    "silver_orders_state": """
        SELECT order_id, ord.customer_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount, status, payment_method, state
        FROM ord LEFT JOIN placed ON ord.customer_id = placed.customer_id""",
    "gold_customer_insights": """
        SELECT CAST(cust.customer_id AS VARCHAR) AS customer_id, placed_orders.state, count(order_id) AS total_orders,
               CAST(sum(total_amount) AS DOUBLE) AS total_spent,
               CAST(sum(total_amount) AS DOUBLE) / nullif(count(total_amount), 0) AS avg_order_value,
               max(order_date) AS last_order_date
        FROM cust LEFT JOIN (SELECT ord.*, state FROM ord LEFT JOIN placed ON ord.customer_id = placed.customer_id) placed_orders
             ON cust.customer_id = placed_orders.customer_id
        GROUP BY cust.customer_id, placed_orders.state""",
    "gold_review_aspects_pivot": "SELECT * REPLACE (CAST(rating AS DOUBLE) AS rating) FROM pivoted",
    "gold_review_analytics": "SELECT * FROM review_figures",
    "gold_monthly_metrics": "SELECT * FROM monthly",
    "gold_product_performance": "SELECT * FROM gold_perf",
    "customer_stats": "SELECT * FROM stats",
    "monthly_revenue": "SELECT * FROM months",
    "order_status_counts": "SELECT * FROM status_months",
    "payment_method_counts": "SELECT * FROM payment_months",
    "inventory_per_product": "SELECT * FROM stock",
    "inventory_per_category": """
        SELECT category, CAST(coalesce(sum(total_stock), 0) AS BIGINT) AS category_stock FROM stock
        WHERE category IS NOT NULL GROUP BY category""",
    "inventory_per_warehouse": """
        SELECT warehouse_id, CAST(sum(quantity) AS BIGINT) AS warehouse_stock FROM inv GROUP BY warehouse_id""",
    "product_price_stats": """
        SELECT category, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price, CAST(min(price) AS DOUBLE) AS min_price,
               CAST(max(price) AS DOUBLE) AS max_price FROM prod GROUP BY category""",
    "kpi_summary": """
        SELECT 'total_revenue' AS kpi, CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS value
        FROM top_cat WHERE metric = 'revenue'
        UNION ALL SELECT 'total_orders', CAST(sum(total_orders) AS DOUBLE) FROM top_cat WHERE metric = 'revenue'
        UNION ALL SELECT 'avg_order_value', CAST(sum(CAST(avg_order_value AS DECIMAL(28,6))) AS DOUBLE) / count(avg_order_value)
                  FROM top_cat WHERE metric = 'revenue'
        UNION ALL SELECT 'total_products', CAST(count(DISTINCT product_id) AS DOUBLE) FROM gold_perf""",
    "category_chart": """
        SELECT category, total_revenue FROM top_cat WHERE metric = 'revenue'
        ORDER BY total_revenue DESC NULLS LAST, category LIMIT 10""",
    "status_distribution": "SELECT status, CAST(sum(count) AS BIGINT) AS total_count FROM status_months GROUP BY status",
    "top_customers_by_spend": """
        SELECT total_spend, CAST(order_count AS DOUBLE) AS order_count, avg_order_value FROM stats
        ORDER BY total_spend DESC NULLS LAST, customer_id LIMIT 100""",
    "state_revenue_treemap": """
        SELECT state, category, total_revenue FROM top_state
        WHERE state IS NOT NULL AND category IS NOT NULL AND total_revenue > 0
        ORDER BY total_revenue DESC NULLS LAST, state, category LIMIT 20""",
    "top_products_table": """
        SELECT product_name, category, total_orders, total_quantity_sold, total_revenue FROM top_perf
        WHERE metric = 'revenue' ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10""",
    "top_reviewed_products": """
        SELECT f.product_id, product_name, specifications, avg_rating, total_reviews, positive_reviews, negative_reviews
        FROM review_figures f
        LEFT JOIN prod ON f.product_id = CAST(prod.product_id AS VARCHAR)
        LEFT JOIN spec_text ON prod.product_id = spec_text.product_id
        ORDER BY total_reviews DESC NULLS LAST, f.product_id LIMIT 10""",
    "spec_pivot": "SELECT * FROM spec_wide",
    "spec_numbers": """
        SELECT *, try_cast(regexp_extract(battery_life, '(\\d+)', 1) AS DOUBLE) AS battery_life_hours,
               try_cast(regexp_extract(storage, '(\\d+)', 1) AS DOUBLE) AS storage_gb
        FROM spec_wide WHERE try_cast(regexp_extract(battery_life, '(\\d+)', 1) AS DOUBLE) IS NOT NULL""",
    "spec_numbers_storage": """
        SELECT *, try_cast(regexp_extract(battery_life, '(\\d+)', 1) AS DOUBLE) AS battery_life_hours,
               try_cast(regexp_extract(storage, '(\\d+)', 1) AS DOUBLE) AS storage_gb
        FROM spec_wide WHERE try_cast(regexp_extract(storage, '(\\d+)', 1) AS DOUBLE) IS NOT NULL""",
    "silver_orders_state_by_extractor": """
        SELECT order_id, state FROM ord LEFT JOIN placed ON ord.customer_id = placed.customer_id""",
    "validation_sample": """
        SELECT CAST(check_no AS INTEGER) AS check_no, success, element_count, missing_count, unexpected_count, observed_value FROM (
            SELECT 0 AS check_no, count(*) FILTER (verified_purchase NOT IN ('FALSE')) = 0 AS success, count(*) AS element_count,
                   count(*) - count(verified_purchase) AS missing_count,
                   count(*) FILTER (verified_purchase NOT IN ('FALSE')) AS unexpected_count, NULL AS observed_value FROM sampled
            UNION ALL SELECT 1, coalesce(min(helpful_votes) BETWEEN 12 AND 20, false), NULL, NULL, NULL, CAST(min(helpful_votes) AS VARCHAR) FROM sampled
            UNION ALL SELECT 2, count(*) FILTER (verified_purchase NOT IN ('true', 'false')) = 0, count(*), count(*) - count(verified_purchase),
                   count(*) FILTER (verified_purchase NOT IN ('true', 'false')), NULL FROM sampled
            UNION ALL SELECT 3, coalesce(min(helpful_votes) BETWEEN 0 AND 20, false), NULL, NULL, NULL, CAST(min(helpful_votes) AS VARCHAR) FROM sampled
            UNION ALL SELECT 4, count(*) FILTER (title NOT IN ('click', 'purchase', 'signup')) = 0, count(*), count(*) - count(title),
                   count(*) FILTER (title NOT IN ('click', 'purchase', 'signup')), NULL FROM sampled)""",
    "nightly_tables": _NIGHTLY,
    "spec_json_rows": "SELECT product_id, spec_name AS name, spec_value AS value FROM spec",
    "preference_counts": "SELECT * FROM pref_counts",
    "top_preferences": "SELECT * FROM pref_counts ORDER BY count DESC NULLS LAST, preference LIMIT 10",
    "json_path_projection": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS votes,
               json_extract_string(props, '$.k') AS votes_text FROM events""",
    "reviews_json_roundtrip": """
        SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(product_id AS VARCHAR) AS product_id,
               CAST(customer_id AS VARCHAR) AS customer_id, CAST(rating AS DOUBLE) AS rating, title, content, review_date,
               verified_purchase, helpful_votes,
               CASE title WHEN 'click' THEN 'Quality=' || whole WHEN 'purchase' THEN 'Quality=' || whole || '|Battery Life=' || half
                          WHEN 'signup' THEN 'Value for Money=' || whole || '|Quality=' || half || '|Quality=' || whole
                          WHEN 'error' THEN 'Packaging=' || whole ELSE '' END AS aspects
        FROM (SELECT *, CAST(CAST(helpful_votes AS DOUBLE) AS VARCHAR) AS whole,
                     CAST(helpful_votes / 2.0::DOUBLE AS VARCHAR) AS half FROM rev)""",
    "preferences_xml_roundtrip": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, preference_type, preference_value FROM pref""",
    "specs_xml_roundtrip": "SELECT CAST(product_id AS VARCHAR) AS product_id, spec_name, spec_value FROM spec",
    "csv_export_roundtrip": "SELECT * FROM pref_counts ORDER BY count DESC NULLS LAST, preference LIMIT 10",
    "table_write_modes": """
        SELECT 'overwrite' AS mode, status AS item, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS amount FROM ord GROUP BY status
        UNION ALL SELECT 'replace', lower(status), count(*), CAST(sum(total_amount) AS DOUBLE) FROM ord GROUP BY status
        UNION ALL SELECT 'append', status, 2 * count(*), NULL FROM ord GROUP BY status
        UNION ALL SELECT 'many', order_month, 1, monthly_revenue FROM months
        UNION ALL SELECT 'many', payment_method, CAST(sum(count) AS BIGINT), NULL FROM payment_months GROUP BY payment_method
        UNION ALL SELECT 'written', 'overwrite', count(*), NULL FROM ord
        UNION ALL SELECT 'written', 'replace', count(*), NULL FROM ord
        UNION ALL SELECT 'written', 'append', 2 * count(*), NULL FROM ord
        UNION ALL SELECT 'written', 'many', (SELECT count(*) FROM months) + (SELECT count(*) FROM payment_months), NULL""",
    "clustered_orders": """
        SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month, count(i.order_id) AS total_orders,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(unit_price * quantity) AS DOUBLE) AS total_sales
        FROM (SELECT CASE WHEN product_id % 3 = 0 THEN 1 ELSE order_id END AS order_id, product_id, quantity, unit_price FROM item) i
        LEFT JOIN ord ON i.order_id = ord.order_id GROUP BY 1""",
    "changed_partitions": """
        SELECT status, status = 'F' AS written, count(*) AS n,
               CAST(sum(total_amount + CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS amount FROM ord GROUP BY status""",
    "expectation_results": "\nUNION ALL ".join(
        [
            _in_set(0, "verified_purchase", "not_false"),
            _min_between(1, "helpful_votes", 12, 20),
            _in_set(2, "verified_purchase", "not_bool"),
            _min_between(3, "helpful_votes", 0, 20),
            _in_set(4, "title", "odd_title"),
        ]
    ),
    "validation_record": """
        SELECT not_false = 0 AND least BETWEEN 12 AND 20 AND not_bool = 0 AND least BETWEEN 0 AND 20 AND odd_title = 0 AS run_status,
               'whole-table' AS run_name, not_false = 0 AS first_success, not_false AS first_unexpected FROM checks""",
    "lineage_columns": "SELECT customer_id, 'customers.xml' AS source_file, TRUE AS loaded FROM cust",
}

# Other ways to the same rows.
_BODIES["reviews_json_split"] = _BODIES["reviews_json_roundtrip"]
_BODIES["preferences_xml_split"] = _BODIES["preferences_xml_roundtrip"]

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
