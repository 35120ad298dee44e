"""SQL text of the sales view and of the injected sales, for the checks."""

from rulemill.functions.rules import CROSS_COLUMN, Rule

EMAIL_RULE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def sales_sql(ordered_dates: bool = False) -> str:
    ship = ("CAST(CAST(o_orderdate AS DATE) + CAST(l_partkey % 15 AS INTEGER) AS DATE)"
            if ordered_dates else "CAST(l_shipdate AS DATE)")
    return f"""
    SELECT 'TXN-' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '-' || CAST(l_linenumber AS VARCHAR)
             AS transaction_id,
           'customer_' || CAST(o_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.example'
             AS customer_email,
           floor(l_extendedprice * l_quantity * 100.0 + 0.5) / 100.0 AS amount,
           l_extendedprice AS original_price,
           floor(l_extendedprice * (1.0 - l_discount) * 100.0 + 0.5) / 100.0 AS discount_price,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(o_orderdate AS DATE) AS order_date,
           {ship} AS ship_date,
           CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending'
                WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'refunded' END AS status,
           CASE WHEN o_orderpriority LIKE '1%' THEN 'credit_card'
                WHEN o_orderpriority LIKE '2%' THEN 'debit_card'
                WHEN o_orderpriority LIKE '3%' THEN 'wire_transfer' ELSE 'paypal' END AS payment_method,
           l_orderkey AS order_key, l_partkey AS part_key, l_linenumber AS line_number
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""


def injected_sql() -> str:
    key = "(order_key * 31 + part_key * 17 + line_number * 7)"
    return f"""
    SELECT transaction_id,
           CASE WHEN {key} % 25 = 2 THEN replace(customer_email, '@', '#') ELSE customer_email END
             AS customer_email,
           amount, original_price,
           CASE WHEN {key} % 33 = 5 THEN original_price + 25.0 ELSE discount_price END AS discount_price,
           CASE WHEN {key} % 50 = 11 THEN -quantity ELSE quantity END AS quantity,
           order_date,
           CASE WHEN {key} % 20 = 7 THEN CAST(order_date - 3 AS DATE) ELSE ship_date END AS ship_date,
           CASE WHEN {key} % 40 = 3 THEN NULL ELSE status END AS status,
           payment_method, order_key, part_key, line_number,
           concat_ws(',', CASE WHEN {key} % 20 = 7 THEN 'ship_before_order' END,
                          CASE WHEN {key} % 33 = 5 THEN 'discount_above_price' END,
                          CASE WHEN {key} % 50 = 11 THEN 'negative_quantity' END,
                          CASE WHEN {key} % 40 = 3 THEN 'null_status' END,
                          CASE WHEN {key} % 25 = 2 THEN 'malformed_email' END) AS defects
    FROM ({sales_sql(True)}) s"""


SALES_RULES = [
    Rule("amount_positive", "amount", "amount > 0", "llm"),
    Rule("amount_product", CROSS_COLUMN, "abs(amount - original_price * quantity) <= 0.01", "llm"),
    Rule("discount_le_price", CROSS_COLUMN, "discount_price <= original_price", "llm"),
    Rule("email_format", "customer_email", f"customer_email RLIKE '{EMAIL_RULE}'", "llm"),
    Rule("quantity_range", "quantity", "quantity >= 0 AND quantity < 1000000", "llm"),
    Rule("ship_after_order", CROSS_COLUMN, "ship_date >= order_date", "llm"),
    Rule("status_known", "status", "status IN ('completed', 'pending', 'cancelled', 'refunded')", "llm"),
    Rule("status_present", "status", "status IS NOT NULL", "schema"),
]

# The same predicates in the checking dialect, by rule id.
SALES_RULES_SQL = {
    "amount_positive": "amount > 0",
    "amount_product": "abs(amount - original_price * quantity) <= 0.01",
    "discount_le_price": "discount_price <= original_price",
    "email_format": f"regexp_matches(customer_email, '{EMAIL_RULE}')",
    "quantity_range": "quantity >= 0 AND quantity < 1000000",
    "ship_after_order": "ship_date >= order_date",
    "status_known": "status IN ('completed', 'pending', 'cancelled', 'refunded')",
    "status_present": "status IS NOT NULL",
}


def counts_sql(relation: str, predicates: dict[str, str], extra: str = "") -> str:
    """One row of counts per rule, each by its own scan."""
    return " UNION ALL ".join(
        f"SELECT '{rid}' AS rule_id{extra}, count(*) AS n_rows, count(*) FILTER (WHERE {p}) AS passed, "
        f"count(*) FILTER (WHERE NOT ({p})) AS failed, count(*) FILTER (WHERE ({p}) IS NULL) AS unknown, "
        f"round(CAST(count(*) FILTER (WHERE {p}) AS DOUBLE) / count(*), 6) AS pass_rate FROM {relation}"
        for rid, p in predicates.items())


def failed_text_sql(predicates: dict[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(
        f"CASE WHEN NOT ({p}) THEN '{rid}' END" for rid, p in predicates.items()) + ")"
