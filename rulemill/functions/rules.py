"""Rule record and the compile step from rule rows to Column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marker columns of the rule format.
CROSS_COLUMN = "_cross_column"
PARSE_ERROR = "_parse_error"

RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("column", T.StringType(), True),
    T.StructField("rule", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("note", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
])


@dataclass(frozen=True)
class Rule:
    """A rule is a SQL predicate that is true for valid rows."""

    rule_id: str
    column: str
    rule: str
    source: str = "schema"
    note: str = ""
    severity: str = "error"

    def row(self) -> tuple:
        return (self.rule_id, self.column, self.rule, self.source, self.note, self.severity)


def raw_literals(predicate: str) -> str:
    """Mark quoted text holding a backslash as a raw literal, so that a regex
    keeps its backslashes instead of losing them to literal unescaping."""
    return re.sub(r"(?<![rR'\w])'((?:[^']|'')*\\(?:[^']|'')*)'", r"r'\1'", predicate)


def predicate(rule: Rule) -> Column:
    return F.expr(raw_literals(rule.rule))


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([r.row() for r in rules], RULE_SCHEMA)


def rules_from(df: DataFrame) -> list[Rule]:
    """Rule rows to the driver: rule metadata only, never table rows."""
    fields = [f.name for f in RULE_SCHEMA.fields if f.name in df.columns]
    return [Rule(**{k: v for k, v in r.asDict().items() if v is not None})
            for r in df.select(*fields).orderBy("rule_id").collect()]
