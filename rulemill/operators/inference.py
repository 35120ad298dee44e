"""Batch model calls behind a client protocol. No network code here."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from rulemill.functions.rules import CROSS_COLUMN
from rulemill.session import checkpointed


class RuleClient(Protocol):
    def generate_rules(self, prompt: str) -> str: ...


# The canned answer of the offline manifest client.
CANNED_YAML = """rules:
  - column: product_id
    rules:
      - 'is not null'
      - 'starts with CW-'
  - column: quantity
    rules:
      - 'is not null'
      - 'must be > 0'
  - column: estimated_arrival_date
    rules:
      - 'is not null'
      - 'is a valid ISO 8601 timestamp'
      - 'is not in the past'
"""


class CannedClient:
    """Gives the same rule document for every prompt."""

    def generate_rules(self, prompt: str) -> str:
        return CANNED_YAML


class SchemaEchoClient:
    """Deterministic offline stand-in for a model: a presence rule for every
    column the prompt lists, and an order rule for two date columns."""

    def generate_rules(self, prompt: str) -> str:
        found = re.findall(r"^- (\w+) \((\w+)", prompt, re.M)
        if not found:
            raise ValueError("prompt lists no columns")
        rules = [{"column": c, "rule": f"{c} IS NOT NULL"} for c, _ in found]
        dates = [c for c, t in found if t in ("date", "timestamp", "timestamp_ntz")]
        if len(dates) > 1:
            rules.append({"column": CROSS_COLUMN, "rule": f"{dates[0]} <= {dates[1]}"})
        return "```json\n" + json.dumps(rules) + "\n```"


def ask(client: RuleClient, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each prompt."""
    if hasattr(client, "generate_batch"):
        try:
            answers = list(client.generate_batch(prompts))
            if len(answers) == len(prompts):
                return [(a, None) for a in answers]
        except Exception:  # the prompts are asked one by one below
            pass
    out: list[tuple[str | None, str | None]] = []
    for prompt in prompts:
        try:
            out.append((client.generate_rules(prompt), None))
        except Exception as e:
            out.append((None, f"{type(e).__name__}: {e}"))
    return out


def infer_once(df: DataFrame, prompt_col: str, client_factory: Callable[[], RuleClient], **options) -> DataFrame:
    """``infer``, written to the shared folder: each prompt is asked once however often
    the answers are read."""
    return checkpointed(infer(df, prompt_col, client_factory, **options), "answers")


def infer(df: DataFrame, prompt_col: str, client_factory: Callable[[], RuleClient], batch_size: int = 16,
          partitions: int | None = None) -> DataFrame:
    """Add ``response`` and ``error`` for each prompt.

    The client is built once per task, on the executor; ``partitions`` spreads the
    prompts over so many tasks, and so clients. A client with a method
    ``generate_batch`` (prompts to answers) gets up to ``batch_size`` prompts at a time; if that
    fails, they are asked one by one. A failing prompt fills ``error`` and leaves
    the other rows alone. The plan calls the model again wherever it is read
    again: write the answers once before branching, as ``infer_once`` does.
    """
    if partitions:
        df = df.repartition(partitions)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def call(batches):
        client = client_factory()
        for pdf in batches:
            answers, errors, prompts = [], [], pdf[prompt_col].tolist()
            for k in range(0, len(prompts), batch_size):
                for answer, error in ask(client, prompts[k:k + batch_size]):
                    answers.append(answer)
                    errors.append(error)
            yield pdf.assign(response=pd.Series(answers, index=pdf.index, dtype=object),
                             error=pd.Series(errors, index=pdf.index, dtype=object))

    return df.mapInPandas(call, f"{fields}, response string, error string")
