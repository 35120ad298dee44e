"""Conversations put in order by the lightest derivation.

A repair reads a conversation's rows in turn and keeps, re-roles or deletes each, and may insert
rows, so that the initials of the roles that are left form ``(s?(ua)+)?``. An item (span, p, q) says
that the span's rows lead from state p to state q, and its value is the lightest (cost, audit)
of doing so, audit being the initials of the edits. Single edits are axioms, and two items that meet
derive the item of both spans with their costs added and their audits joined. Knuth's agenda pops items in
the order of their values; joining never makes a value smaller, so what is popped is final, and
the first goal popped is the answer. Two values of one item with equal costs have as many
insertions, so neither audit is the other's beginning, and joining keeps their order.

Rows are dealt by ranges of (conversation, turn, role, text) and sorted, so a task reads whole
conversations in order. What is at a task's edge may go on in the next task: such a piece gives the items of
all states, which are joined for the conversation afterwards, without its texts. So a very long
conversation is spread over many tasks like any other rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import partitions, stored

RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping is free
SPAN = 32  # rows of a leaf of the derivation
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or the last role left
_INTO = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NEXT = {p: q for moves in (_INTO["u"], _INTO["a"]) for p, q in moves.items()}  # by a user or assistant row
_CLOSING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}  # insertions that end a conversation
_GOAL = -1
_LEGAL = {"su", "ua", "au"}
_SOLID = "[^\\x20\\x09-\\x0D]"

Value = tuple[int, str]
Items = dict[tuple[int, int], Value]


@lru_cache(1 << 16)
def span_items(shape: str) -> Items:
    """Lightest values of (p, q) over the rows of one span. ``shape`` has a letter for each row: its role's
    initial (o: any other), in capitals if the row is truncated, x if it must be deleted."""
    heap: list[tuple] = [(0, "", p, 0, p) for p in range(4)]
    final: dict[tuple[int, int, int], Value] = {}
    while heap:
        cost, audit, p, at, q = heapq.heappop(heap)
        if (p, at, q) in final:
            continue
        final[p, at, q] = cost, audit
        if at == len(shape):
            continue
        heapq.heappush(heap, (cost + DELETE, audit + "D", p, at + 1, q))
        row = shape[at]
        if q in _NEXT:
            heapq.heappush(heap, (cost + INSERT, audit + "I", p, at, _NEXT[q]))
        if row != "x":
            extra = TRUNCATED if row.isupper() else 0
            if q in (to := _INTO.get(row.lower(), {})):
                heapq.heappush(heap, (cost + extra, audit + "K", p, at + 1, to[q]))
            if q in _NEXT:
                heapq.heappush(heap, (cost + extra + RENAME, audit + "R", p, at + 1, _NEXT[q]))
    return {(p, q): v for (p, at, q), v in final.items() if at == len(shape)}


def derive(leaves: list[Items], goal: bool) -> Items | Value:
    """The agenda over neighbouring spans, joined two by two: all items of the whole, or its lightest
    goal, an item from the start that a closing ends."""
    level, root = list(range(len(leaves))), len(leaves) - 1
    above: dict[int, int] = {}
    pair: dict[int, tuple[int, int]] = {}
    while len(level) > 1:
        joined = []
        for left, right in zip(level[::2], level[1::2], strict=False):
            root += 1
            above[left] = above[right] = root
            pair[root] = left, right
            joined.append(root)
        level = joined + level[len(joined) * 2:]
    heap: list[tuple] = [(*v, k, p, q) for k, items in enumerate(leaves) for (p, q), v in items.items()]
    heapq.heapify(heap)
    final: dict[int, Items] = {}
    while heap:
        cost, audit, node, p, q = heapq.heappop(heap)
        if node == _GOAL:
            return cost, audit
        items = final.setdefault(node, {})
        if (p, q) in items:
            continue
        items[p, q] = cost, audit
        if node == root:
            if goal and p == START:
                heapq.heappush(heap, (cost + INSERT * len(_CLOSING[q]), audit + _CLOSING[q], _GOAL, p, q))
            continue
        left, right = pair[above[node]]
        if node == left:
            for (r, t), (c, a) in final.get(right, {}).items():
                if r == q:
                    heapq.heappush(heap, (cost + c, audit + a, above[node], p, t))
        else:
            for (r, t), (c, a) in final.get(left, {}).items():
                if t == p:
                    heapq.heappush(heap, (cost + c, a + audit, above[node], r, q))
    return final.get(root, {})


def spans(shape: str) -> list[Items]:
    return [span_items(shape[k:k + SPAN]) for k in range(0, len(shape), SPAN)] or [span_items("")]


@lru_cache(1 << 16)
def lightest(shape: str) -> Value:
    """(cost, audit) of a whole conversation's repair."""
    return derive(spans(shape), goal=True)


def apply_edits(audit: str, roles: list[str], texts: list[str], state: int = START) -> tuple[list[dict], int]:
    """The rows that a stretch of edits leaves, and the state behind them."""
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else (roles[at], texts[at])
        at += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = _INTO[role[:1]][state]
        else:
            state = _NEXT[state]
            role = "user" if state == USER else "assistant"
        out.append({"role": role, "text": text})
    return out, state


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) with faults planted by the crc32 of ``conv:turn``: of each twenty,
    one row goes (it stays here, marked), one loses its text, one its marks of a sentence's end, one is doubled, one becomes the user's.
    Null roles and texts, and nulls in the checksum, are one space."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    out = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.when(fault == 4, "user").otherwise(plain(role)).alias("role"),
                      F.when(fault == 1, "").when(fault == 2, F.translate(plain(text), ".!?", "")).otherwise(plain(text)).alias("text"),
                      (fault == 0).alias("gone"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """Adds ``blank``, ``again`` (role and text were seen in an earlier turn), ``cut`` (truncated) and ``mark``, a
    digest of role and text."""
    rows = rows.withColumn("mark", F.sha2(F.concat("role", F.lit("\0"), "text"), 256)).withColumn("blank", ~F.col("text").rlike(_SOLID))
    rows = rows.withColumn("cut", ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z"))
    first = rows.where("NOT blank AND NOT gone").groupBy("conv", "mark").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    first = stored(first.where("NOT first <=> last").select(F.col("conv").alias("c"), F.col("mark").alias("m"), F.col("first.turn").alias("first")), "repair-again")
    met = rows.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    again = F.col("m").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    return met.select("conv", "turn", "role", "text", "gone", "mark", "blank", again.alias("again"), "cut")


_PIECE = {"low": "bigint", "high": "bigint", "turns": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint",
          "head": "string", "tail": "string", "shape": "string", "cost": "bigint", "audit": "string", "roles": "array<string>", "texts": "array<string>",
          "items": "array<struct<p:int,q:int,cost:bigint,audit:string>>", "lines": "array<struct<role:string,text:string>>"}
_NAMES = ["conv", "piece", "open", *_PIECE]


class _Run:
    """What is read of one conversation so far."""

    def __init__(self, conv):
        self.conv, self.roles, self.texts, self.shape = conv, [], [], []
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn, role, text, mark, blank, again, cut) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        fault = "blank" if blank else "duplicate" if again or (turn, mark) == self.last else "truncated" if cut else None
        self.last = turn, mark
        if fault:
            self.counts[fault] += 1
        initial = role[:1] if role[:1] in _INTO else "o"
        self.shape.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        self.roles.append(role)
        self.texts.append(text)

    def row(self, piece: int, is_open: bool) -> dict:
        shape = "".join(self.shape)
        out = {"conv": self.conv, "piece": piece, "open": is_open, "low": self.low, "high": self.high, "turns": self.turns, **self.counts,
               "head": self.roles[0][:1] if self.roles else None, "tail": self.roles[-1][:1] if self.roles else None, "shape": shape}
        if is_open:
            items = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in derive(spans(shape), goal=False).items()]
            return out | {"roles": self.roles, "texts": self.texts, "items": items}
        cost, audit = lightest(shape)
        return out | {"cost": cost, "audit": audit, "lines": apply_edits(audit, self.roles, self.texts)[0]}


def _frame(rows: list[dict]) -> pd.DataFrame:
    """Objects throughout, so that null numbers stay null."""
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in _NAMES})


def read_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows to one row for each conversation of the task; the first and the last stay open."""
    piece, run, first = TaskContext.get().partitionId(), None, True
    for pdf in batches:
        out = []
        for conv, turn, role, text, gone, mark, blank, again, cut in zip(*(pdf[c].astype(object).where(pdf[c].notna(), None) for c in pdf.columns), strict=True):
            if run is None or conv != run.conv:
                if run is not None:
                    out.append(run.row(piece, first))
                    first = False
                run = _Run(conv)
            if not gone:
                run.add(turn, role, text, mark, blank, again, cut)
        if out:
            yield _frame(out)
    if run is not None:
        yield _frame([run.row(piece, True)])


def join_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation, without texts: its report on the first, and each piece's share of the audit."""
    rows = sorted(pdf.to_dict("records"), key=lambda r: r["piece"])
    cost, audit = derive([{(i["p"], i["q"]): (i["cost"], i["audit"]) for i in r["items"]} for r in rows], goal=True)
    whole, at, state, out = {c: 0 for c in ("turns", "blank", "duplicate", "truncated", "illegal")}, 0, START, []
    low = high = tail = None
    for k, r in enumerate(rows):
        end = at
        for _ in r["shape"]:  # a piece ends behind the edit of its last row
            while audit[end] == "I":
                end += 1
            end += 1
        end = len(audit) if k == len(rows) - 1 else end
        out.append({"conv": r["conv"], "piece": r["piece"], "share": audit[at:end], "state": state, "first": k == 0})
        _, state = apply_edits(audit[at:end], [x.lower() for x in r["shape"]], list(r["shape"]), state)
        at = end
        for c in whole:
            whole[c] += int(r[c])
        if not pd.isna(r["low"]):
            whole["turns"] -= high == r["low"]
            low, high = (r["low"] if low is None else low), r["high"]
        if r["head"] is not None:
            whole["illegal"] += tail is not None and tail + r["head"] not in _LEGAL
            tail = r["tail"]
    frame = pd.DataFrame(out).astype({"conv": object})
    for c, v in (whole | {"low": low, "high": high, "cost": cost, "audit": audit}).items():
        frame[c] = pd.Series([v] * len(frame), dtype=object)
    return frame


def repair(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv, piece, first, gaps, blank, duplicate, truncated, illegal, cost, audit, lines): every conversation of
    the damaged rows in one or more pieces, in order; its report stands on all of them, ``lines`` holds the repaired rows (role, text) of the piece.

    A row's first fault counts: blank, duplicate (role and text were seen before), truncated. Blank and
    duplicate rows are deleted. Rows go by turn, null turns first; rows alike in turn go by role, then by a digest of
    their text, so repeated rows stand together and all but the first are duplicates. Null ids are one
    conversation. A conversation without rows has zeros, an empty audit and no lines; an empty table gives no rows. Other columns are not read.
    """
    kind = dict(rows.dtypes)["conv"]
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "mark"]
    cols = ["conv", "turn", "role", "text", "gone", "mark", "blank", "again", "cut"]
    dealt = judged(rows).select(*cols).repartitionByRange(parts or partitions(rows), *order).sortWithinPartitions(*order)
    done = stored(dealt.mapInPandas(read_pieces, f"conv {kind}, piece int, open boolean, " + ", ".join(f"{n} {t}" for n, t in _PIECE.items())), "repair-pieces")
    numbers = "turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, cost bigint, audit string"
    narrow = done.where("open").select("conv", "piece", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "head", "tail", "shape", "items")
    joined = stored(narrow.groupBy("conv").applyInPandas(join_pieces, f"conv {kind}, piece int, share string, state int, first boolean, {numbers}"), "repair-joined")
    own = done.where("open").select(F.col("conv").alias("c"), F.col("piece").alias("p"), "roles", "texts")
    met = joined.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))).drop("c", "p")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["lines"] = [apply_edits(a, list(r), list(t), s)[0] for a, r, t, s in zip(pdf["share"], pdf["roles"], pdf["texts"], pdf["state"], strict=True)]
            pdf["conv"], pdf["low"], pdf["high"] = (pdf[c].astype(object).where(pdf[c].notna(), None) for c in ("conv", "low", "high"))
            yield pdf.drop(columns=["roles", "texts", "share", "state"])

    lines = "lines array<struct<role:string,text:string>>"
    edges = met.mapInPandas(write, f"conv {kind}, piece int, first boolean, {numbers}, {lines}")
    inner = done.where("NOT open").withColumn("first", F.lit(True)).select(*edges.columns)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return inner.unionByName(edges).select("conv", "piece", "first", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "lines")


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation, with the sha256 of its repaired lines ``role:text`` joined by newlines. Pieces are
    read in order and fed to the digest one by one, so none is held with another."""
    import hashlib

    said = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    rows = repaired.withColumn("body", F.concat_ws("\n", said)).withColumn("size", F.size("lines")).drop("lines")
    kind = dict(rows.dtypes)["conv"]
    report = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    names = ["conv", *(c.split(" ")[0] for c in report.split(", ")), "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = digest = None
        started = False

        def settled() -> dict:
            return {n: held[n] for n in names[:-1]} | {"repaired_sha256": digest.hexdigest()}

        for pdf in batches:
            out = []
            pdf["conv"] = pdf["conv"].astype(object).where(pdf["conv"].notna(), None)
            for row in pdf.to_dict("records"):
                if row["first"]:
                    if held is not None:
                        out.append(settled())
                    held, digest, started = row, hashlib.sha256(), False
                if row["size"]:
                    digest.update((b"\n" if started else b"") + row["body"].encode("utf-8", "surrogatepass"))
                    started = True
            if out:
                yield pd.DataFrame(out, columns=names).astype({"conv": object})
        if held is not None:
            yield pd.DataFrame([settled()], columns=names).astype({"conv": object})

    dealt = rows.repartition("conv").sortWithinPartitions("conv", "piece")
    return dealt.mapInPandas(run, f"conv {kind}, {report}, repaired_sha256 string")
