"""Queries for rule-set processing. Model answers are derived from the events,
one per event, in the shapes a model is known to answer in."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import mining as mi
from rulemill.operators import rulesets as rs
from rulemill.operators.coverage import coverage
from rulemill.plans.catalog import query
from rulemill.sources.tables import load


def responses(spark, sf_dir):
    """Nine answer shapes, by event: plain list, fenced list, fence without a
    newline, one object, prose, a number in the list, a rule missing, an empty
    list, and a list of two."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    n = F.col("event_id").cast("string")
    rule = F.concat(F.lit('{"column":"value","rule":"value <> '), n, F.lit('"'))
    shapes = [
        F.concat(F.lit("["), rule, F.lit(',"source":"schema"}]')),
        F.concat(F.lit("```json\n["), rule, F.lit("}]\n```")),
        F.concat(F.lit("```["), rule, F.lit("}]```")),
        F.concat(F.lit("  "), rule, F.lit("}\n")),
        F.concat(F.lit("no rules for "), "event_type"),
        F.concat(F.lit("[3, "), rule, F.lit("}]")),
        F.lit('[{"column":"value"}]'),
        F.lit("[]"),
        F.concat(F.lit("["), rule, F.lit(',"note":"n"},{"column":"_cross_column","rule":"ts >= ts"}]')),
    ]
    raw = F.element_at(F.array(*shapes), (F.col("event_id") % 9 + 1).cast("int"))
    return e.withColumn("raw", raw)


_PARSED_SQL = """
    SELECT event_id, user_id, 0 AS pos, 'value' AS "column", 'value <> ' || event_id AS rule,
           CASE WHEN event_id % 9 = 0 THEN 'schema' ELSE 'llm' END AS source,
           CASE WHEN event_id % 9 = 8 THEN 'n' END AS note, true AS is_object
    FROM events WHERE event_id % 9 IN (0, 1, 2, 3, 8)
    UNION ALL SELECT event_id, user_id, 1, '_cross_column', 'ts >= ts', 'llm', NULL, true
    FROM events WHERE event_id % 9 = 8
    UNION ALL SELECT event_id, user_id, 0, '_parse_error', 'no rules for ' || event_type, 'llm', NULL, true
    FROM events WHERE event_id % 9 = 4
    UNION ALL SELECT event_id, user_id, 0, NULL, NULL, NULL, NULL, false FROM events WHERE event_id % 9 = 5
    UNION ALL SELECT event_id, user_id, 1, 'value', 'value <> ' || event_id, 'llm', NULL, true
    FROM events WHERE event_id % 9 = 5
    UNION ALL SELECT event_id, user_id, 0, 'value', NULL, 'llm', NULL, true FROM events WHERE event_id % 9 = 6"""
_VALID_SQL = f"""SELECT * FROM ({_PARSED_SQL}) p WHERE is_object AND "column" IS NOT NULL AND rule IS NOT NULL"""


def parsed(spark, sf_dir):
    return rs.parse_responses(responses(spark, sf_dir), "raw").drop("raw", "event_type")


@query(_PARSED_SQL)
def parse_rules(spark, sf_dir):
    return parsed(spark, sf_dir)


@query(f"""SELECT event_id, pos, "column", rule, source, CASE WHEN NOT is_object THEN 'not an object'
                  WHEN "column" IS NULL THEN 'missing column' WHEN rule IS NULL THEN 'missing rule' ELSE 'valid' END
                  AS verdict FROM ({_PARSED_SQL}) p""")
def validate_rules(spark, sf_dir):
    good, bad = rs.validate_rules(parsed(spark, sf_dir))
    return (good.withColumn("reason", F.lit("valid")).unionByName(bad)
            .select("event_id", "pos", "column", "rule", "source", F.col("reason").alias("verdict")))


@query(f"""SELECT 'schema' AS origin, count(*) AS n_rules, count(note) AS n_notes FROM (
             SELECT NULL AS note FROM (SELECT DISTINCT event_type FROM events) t) s
           UNION ALL SELECT 'model', count(*), count(note) FROM ({_VALID_SQL}) v""")
def combine_rules(spark, sf_dir):
    schema_rules = load(spark, sf_dir, "events").select("event_type").distinct().select(
        F.lit("event_type").alias("column"), F.concat(F.lit("event_type <> '"), "event_type", F.lit("'")).alias("rule"),
        F.lit("schema").alias("source"), F.lit("schema").alias("origin"))
    model_rules = rs.validate_rules(parsed(spark, sf_dir))[0].select(
        "column", "rule", "source", "note", F.lit("model").alias("origin"))
    return (rs.combine(schema_rules, model_rules).groupBy("origin")
            .agg(F.count(F.lit(1)).alias("n_rules"), F.count("note").alias("n_notes")))


@query("""SELECT 'o_totalprice' AS column_key, 'o_totalprice <= ' || k AS rule_key,
                 'O_TotalPrice  <=   ' || k AS rule, count(*) AS n_proposals
          FROM (SELECT CAST(floor(o_totalprice / 1000) AS BIGINT) AS k FROM orders) n
          WHERE k NOT IN (SELECT CAST(floor(l_extendedprice / 1000) AS BIGINT) FROM lineitem) GROUP BY k""")
def novel_rules(spark, sf_dir):
    def proposed(df, price, text):
        step = F.floor(F.col(price) / 1000).cast("string")
        return df.select(F.lit("o_totalprice").alias("column"), F.concat(F.lit(text), step).alias("rule"))
    new = proposed(load(spark, sf_dir, "orders"), "o_totalprice", "O_TotalPrice  <=   ")
    known = proposed(load(spark, sf_dir, "lineitem"), "l_extendedprice", " o_totalprice <= ")
    return rs.novel_rules(new, known)


# Rules over a price: proposed from orders in four forms, known from parts as intervals that break them.
_PROPOSED_SQL = """SELECT CASE o_orderkey % 4 WHEN 0 THEN 'price NOT BETWEEN ' || a || ' AND ' || (a + 5) WHEN 1 THEN 'price <> ' || a
                               WHEN 2 THEN 'NOT (price >= ' || a || ' AND ' || (a + 3) || ' > price)'
                               ELSE 'price <= ' || a || ' OR price > ' || (a + 9) END AS rule,
                          a AS lo, a + CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 9 END AS hi
                   FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 10) AS BIGINT) AS a FROM orders) o"""


@query(f"""WITH known AS (SELECT DISTINCT lo, lo + p_size AS hi FROM (
               SELECT CAST(floor(p_retailprice) AS BIGINT) * 13 - p_partkey % 97 AS lo, p_size FROM part) p),
             marked AS (SELECT *, CASE WHEN lo <= max(hi) OVER (ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                                  THEN 0 ELSE 1 END AS fresh FROM known),
             islands AS (SELECT min(lo) AS lo, max(hi) AS hi FROM (
               SELECT lo, hi, sum(fresh) OVER (ORDER BY lo, hi) AS island FROM marked) m GROUP BY island)
           SELECT rule, count(*) AS n_proposals,
                  CASE WHEN max(i_hi) >= max(hi) THEN 'covered' ELSE 'novel' END AS verdict
           FROM (SELECT n.rule, n.lo, n.hi, i.hi AS i_hi FROM ({_PROPOSED_SQL}) n ASOF LEFT JOIN islands i ON n.lo >= i.lo) j
           GROUP BY rule""")
def rule_coverage(spark, sf_dir):
    a = F.floor(F.col("o_totalprice") / 10)
    text = lambda c: c.cast("string")
    form = F.col("o_orderkey") % 4
    rule = (F.when(form == 0, F.concat(F.lit("price NOT BETWEEN "), text(a), F.lit(" AND "), text(a + 5)))
            .when(form == 1, F.concat(F.lit("price <> "), text(a)))
            .when(form == 2, F.concat(F.lit("NOT (price >= "), text(a), F.lit(" AND "), text(a + 3), F.lit(" > price)")))
            .otherwise(F.concat(F.lit("price <= "), text(a), F.lit(" OR price > "), text(a + 9))))
    low = F.floor("p_retailprice") * 13 - F.col("p_partkey") % 97
    known = load(spark, sf_dir, "part").select(F.concat(F.lit("PRICE < "), text(low), F.lit(" or price > "), text(low + F.col("p_size"))).alias("rule"))
    return coverage(load(spark, sf_dir, "orders").select(rule.alias("rule")), known)


_ENUMS = {"orders": ["o_orderstatus", "o_orderpriority"], "customer": ["c_mktsegment", "c_nationkey"],
          "part": ["p_brand", "p_type"], "lineitem": ["l_returnflag", "l_linestatus"]}


def mined_enums(spark, sf_dir):
    parts = [mi.mine_enums(load(spark, sf_dir, t), cols, 40).select(
        F.lit(t).alias("table_name"), F.col("column_name").alias("column"), "rule", F.lit("mined").alias("source"))
        for t, cols in _ENUMS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, CAST({len(cols)} AS BIGINT) AS n_rules, CAST({len(cols)} AS BIGINT) AS n_listed,
               '{min(cols)} IN (' || string_agg('''' || v || '''', ', ' ORDER BY v) || ')' AS first_rule
        FROM (SELECT DISTINCT CAST({min(cols)} AS VARCHAR) AS v FROM {t}) d""" for t, cols in _ENUMS.items()))
def rules_json_by_table(spark, sf_dir):
    return rs.rules_json(mined_enums(spark, sf_dir)).select(
        "table_name", "n_rules", F.json_array_length("rules_json").cast("bigint").alias("n_listed"),
        F.get_json_object("rules_json", "$[0].rule").alias("first_rule"))


@query("""SELECT p_partkey, 0 AS group_pos, 'p_size' AS "column", 0 AS rule_pos, 'is not null' AS rule
          FROM part WHERE p_partkey % 10 <> 0
          UNION ALL SELECT p_partkey, 0, 'p_size', 1, 'must be <= ' || p_size FROM part WHERE p_partkey % 10 <> 0
          UNION ALL SELECT p_partkey, 1, 'p_brand', 0, 'starts with ' || p_brand FROM part WHERE p_partkey % 10 <> 0
          UNION ALL SELECT p_partkey, -1, NULL, -1, 'TypeError' FROM part WHERE p_partkey % 10 = 0""")
def flatten_rule_documents(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 10 == 0, F.col("p_name")).otherwise(F.concat(
        F.lit("rules:\n  - column: p_size\n    rules:\n      - 'is not null'\n      - 'must be <= "),
        F.col("p_size").cast("string"), F.lit("'\n  - column: p_brand\n    rules:\n      - 'starts with "),
        "p_brand", F.lit("'\n")))
    return rs.flatten_all(part.withColumn("doc", text), "p_partkey", "doc")


@query(f"""SELECT user_id, count(*) AS rules_generated, count(*) FILTER (WHERE source = 'schema') AS schema_rules,
                  count(*) FILTER (WHERE source = 'llm') AS llm_rules,
                  count(*) FILTER (WHERE "column" = '_cross_column') AS cross_column_rules,
                  count(DISTINCT "column") AS column_groups FROM ({_VALID_SQL}) v GROUP BY 1""")
def rule_metrics(spark, sf_dir):
    return rs.rule_metrics(rs.validate_rules(parsed(spark, sf_dir))[0], "user_id")


@query(f"""SELECT user_id, count(*) FILTER (WHERE "column" <> '_parse_error') AS n_rules,
                  count(*) FILTER (WHERE "column" = '_parse_error') AS n_errors,
                  count(*) FILTER (WHERE "column" <> '_parse_error') >= 40
                  AND count(*) FILTER (WHERE "column" = '_parse_error') < 1 AS passed
           FROM ({_VALID_SQL}) v WHERE user_id IS NOT NULL GROUP BY 1""")
def rule_gate(spark, sf_dir):
    return rs.gate(rs.validate_rules(parsed(spark, sf_dir))[0], "user_id", 40)


@query(f"""SELECT event_id, pos, rpad('[' || source || ']', 10, ' ') || rpad("column", 20, ' ') || ' -> ' || rule AS line,
                  'SELECT COUNT(*) FROM events WHERE NOT (' || rule || ')' AS check_sql
           FROM ({_VALID_SQL}) v""")
def render_rules(spark, sf_dir):
    return rs.render_rules(rs.validate_rules(parsed(spark, sf_dir))[0], "events", ["event_id", "pos"])


@query(f"""SELECT event_id, pos, rpad('[' || source || ']', 10, ' ') || rpad("column", 20, ' ') || ' -> ' || rule AS line,
                  'SELECT COUNT(*) FROM events WHERE NOT (' || rule || ')' AS check_sql
           FROM ({_VALID_SQL}) v ORDER BY event_id, pos LIMIT 5""")
def render_first_rules(spark, sf_dir):
    return rs.render_rules(rs.validate_rules(parsed(spark, sf_dir))[0], "events", ["event_id", "pos"], n=5)
