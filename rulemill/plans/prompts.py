"""Queries for prompt templates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import profile as pf
from rulemill.operators import prompts as pr
from rulemill.operators.vectors import Retriever
from rulemill.plans.catalog import query
from rulemill.plans.rulesets import _ENUMS, mined_enums
from rulemill.sources.tables import load

# Variables the agent's prompt must have.
REQUIRED = ["table_name", "catalog", "schema"]

_TEMPLATES = [
    "Analyze the {{table_name}} table in {{catalog}}.{{schema}} and propose rules.",
    "Analyze {{table_name}} in {{schema}}.",
    "Check {{ table_name }} of {{catalog}}.{{schema}} for {{focus}}.",
    "Propose rules.",
]
_MISSING = ["", "catalog", "", "catalog,schema,table_name"]
_EXTRA = ["", "", "focus", ""]


def _templates(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    pick = F.element_at(F.array(*[F.lit(t) for t in _TEMPLATES]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return part.withColumn("template", F.concat(pick, F.lit(" For "), "p_brand"))


def _case(values):
    return "CASE p_partkey % 4 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


@query(f"""SELECT p_partkey, {_case(_MISSING)} AS missing, {_case(_EXTRA)} AS extra,
                  p_partkey % 4 IN (0, 2) AS valid FROM part""")
def validate_templates(spark, sf_dir):
    return pr.validate_templates(_templates(spark, sf_dir), "template", REQUIRED).select(
        "p_partkey", "missing", "extra", "valid")


_FILLED = [
    "'Analyze the ' || p_type || ' table in main.{{schema}} and propose rules.'",
    "'Analyze ' || p_type || ' in {{schema}}.'",
    "'Check ' || p_type || ' of main.{{schema}} for {{focus}}.'",
    "'Propose rules.'",
]


@query(f"""SELECT p_partkey, CASE p_partkey % 4 {' '.join(f'WHEN {i} THEN {e}' for i, e in enumerate(_FILLED))} END
                  || ' For ' || p_brand AS rendered,
                  {_case(['schema', 'schema', 'focus,schema', ''])} AS unresolved FROM part""")
def render_prompts(spark, sf_dir):
    values = {"table_name": F.col("p_type"), "catalog": F.lit("main")}
    return pr.render(_templates(spark, sf_dir), "template", values).select("p_partkey", "rendered", "unresolved")


@query("""SELECT n_nationkey, r_name, 'Focus on ' || n_name || ' in ' || r_name || '.' AS rendered, '' AS unresolved,
                 n_customers
          FROM nation JOIN region ON n_regionkey = r_regionkey
          JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey""")
def render_prompts_single_brace(spark, sf_dir):
    people = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    nation = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(people, "n_nationkey")
    df = nation.withColumn("template", F.lit("Focus on {nation} in {region}."))
    return pr.render(df, "template", {"nation": F.col("n_name"), "region": F.col("r_name")}, "single").select(
        "n_nationkey", "r_name", "rendered", "unresolved", "n_customers")


@query("""SELECT doc_id, substr(sha256(text), 1, 12) AS prompt_hash, length(text) AS prompt_length FROM documents""")
def fingerprint_docs(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pr.with_fingerprint(docs, "text").drop("text")


@query("""SELECT substr(whole, 1, 12) AS prompt_hash, count(*) AS n_docs, min(doc_id) AS first_doc FROM (
            SELECT doc_id, sha256(text) AS whole FROM documents) f GROUP BY whole""")
def fingerprint_groups(spark, sf_dir):
    """Grouped by the whole hash; its first digits are only shown."""
    docs = load(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("whole"))
    return docs.agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).select(
        F.substring("whole", 1, 12).alias("prompt_hash"), "n_docs", "first_doc")


_COLUMN_TYPES = {
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
}
_EXAMPLE = "amount > 0"


def _shown(table, column):
    """Numbers stand bare in mined lists, all else in quotes."""
    return "v" if dict(_COLUMN_TYPES[table])[column] in ("int", "bigint", "double") else "'''' || v || ''''"


def _prompt_sql(table):
    columns = "\n".join(f"- {c} ({t}, nullable=true)" for c, t in _COLUMN_TYPES[table])
    rules = " || chr(10) || ".join(
        f"""(SELECT '- {c} IN (' || string_agg({_shown(table, c)}, ', ' ORDER BY v) || ')'
             FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {table}) d)""" for c in sorted(_ENUMS[table]))
    return f"""SELECT '{table}' AS table_name, 'Table: {table}

Columns:
{columns}

Known rules:
' || {rules} || '

Examples:
{_EXAMPLE}

Propose further rules as a JSON array: outliers, business logic, cross-column consistency, text formats, allowed values.' AS prompt"""


def _prompts(spark, sf_dir):
    columns = None
    for t in _COLUMN_TYPES:
        part = pf.describe_schema(load(spark, sf_dir, t), t)
        columns = part if columns is None else columns.unionByName(part)
    rules = mined_enums(spark, sf_dir).where(F.col("table_name").isin(*_COLUMN_TYPES))
    return pr.build_prompts(columns, rules, _EXAMPLE)


@query(" UNION ALL ".join(_prompt_sql(t) for t in _COLUMN_TYPES))
def build_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir)


# Statistics of three tables, and rules of the history, by text id, whose columns sound alike.
_HISTORY = {"lineitem.l_orderkey": "l_orderkey references orders", "lineitem.l_quantity": "l_quantity between 1 and 50", "supplier.s_acctbal": "s_acctbal above -1000",
            "supplier.s_name": "s_name is unique", "nation.n_nationkey": "n_nationkey is not null", "events.value": "value at least 0"}
_HISTORY_SQL = " UNION ALL ".join(f"SELECT '{k}' AS id, '{v}' AS text" for k, v in _HISTORY.items())
_ASKED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS id, '{' '.join(c for c, _ in cols)}' AS text" for t, cols in _COLUMN_TYPES.items())


def _vector_sql(relation):
    return f"""SELECT id, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY id)), 6) AS weight FROM (
                 SELECT id, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 64 AS bucket, count(*) AS n
                 FROM (SELECT id, unnest(regexp_extract_all(lower(text), '([\\p{{L}}\\p{{N}}]+)', 1)) AS word FROM ({relation}) w) x GROUP BY 1, 2) c"""


def _statistics_sql(table):
    shown = {"int": "CAST({f} AS VARCHAR)", "bigint": "CAST({f} AS VARCHAR)", "string": "{f}", "double": "CAST(CAST(round({f}, 6) AS DECIMAL(30,6)) AS VARCHAR)",
             "timestamp_ntz": "strftime({f}, '%Y-%m-%d %H:%M:%S')"}
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '- {c}: ' || count(*) || ' rows, ' || (count(*) - count({c})) || ' null, ' || count(DISTINCT {c}) || ' distinct, from '
                   || {shown[t].format(f=f'min({c})')} || ' to ' || {shown[t].format(f=f'max({c})')} AS line FROM {table}""" for c, t in _COLUMN_TYPES[table])


@query(f"""WITH r AS ({_vector_sql(_HISTORY_SQL)}), a AS ({_vector_sql(_ASKED_SQL)}),
                rn AS (SELECT id, sqrt(sum(weight * weight)) AS n FROM r GROUP BY 1), an AS (SELECT id, sqrt(sum(weight * weight)) AS n FROM a GROUP BY 1),
                s AS (SELECT a.id AS table_name, r.id AS rule_id, round(sum(a.weight * r.weight) / (any_value(an.n) * any_value(rn.n)), 6) AS score
                      FROM a JOIN r USING (bucket) JOIN an ON an.id = a.id JOIN rn ON rn.id = r.id GROUP BY 1, 2),
                top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY score DESC, rule_id) AS rank FROM s) k WHERE rank <= 2 AND score > 0),
                found AS (SELECT table_name, string_agg('- ' || text, chr(10) ORDER BY '- ' || text) AS rules FROM top JOIN ({_HISTORY_SQL}) h ON h.id = rule_id GROUP BY 1),
                stats AS (SELECT table_name, string_agg(line, chr(10) ORDER BY line) AS lines FROM ({" UNION ALL ".join(_statistics_sql(t) for t in _COLUMN_TYPES)}) l GROUP BY 1),
                plain AS ({" UNION ALL ".join(_prompt_sql(t) for t in _COLUMN_TYPES)})
           SELECT table_name, replace(replace(prompt, chr(10) || chr(10) || 'Known rules:', chr(10) || chr(10) || 'Statistics:' || chr(10) || lines || chr(10) || chr(10) || 'Known rules:'),
                    chr(10) || chr(10) || 'Propose', coalesce(chr(10) || chr(10) || 'Rules of similar tables:' || chr(10) || rules, '') || chr(10) || chr(10) || 'Propose') AS prompt
           FROM plain JOIN stats USING (table_name) LEFT JOIN found USING (table_name)""")
def build_prompts_full(spark, sf_dir):
    columns = profiles = None
    for t in _COLUMN_TYPES:
        df = load(spark, sf_dir, t).select(*[c for c, _ in _COLUMN_TYPES[t]])
        described, profile = pf.describe_schema(df, t), pf.profile(df, t, approx=False)
        columns, profiles = (described, profile) if columns is None else (columns.unionByName(described), profiles.unionByName(profile))
    history = spark.createDataFrame(list(_HISTORY.items()), "rule_id string, rule string")
    asked = columns.groupBy("table_name").agg(F.array_join(F.collect_list("name"), " ").alias("text"))
    hits = Retriever.from_texts(history).search_historical_rules(asked, "table_name", "text", 2).where("score > 0")
    rules = mined_enums(spark, sf_dir).where(F.col("table_name").isin(*_COLUMN_TYPES))
    return pr.build_prompts(columns, rules, _EXAMPLE, hits.select("table_name", "rule"), pr.statistics_lines(profiles))
