"""Line deduplication by a suffix array over line numbers.

Each document is the sequence of its non-blank lines. Lines that occur once in the
corpus can be in no repeated run, so they cut documents into chains of repeated
lines, and chains alike are one. The suffixes of the chains are sorted by distributed prefix
doubling: from ranks by the first 1, 2, 4, ... lines the ranks by twice as many
follow by sorting pairs of ranks.

Suffixes with the first n lines in common are an interval of the suffix array. From
the interval of all suffixes, intervals are narrowed by falling powers of two: those
that share the next power of lines, by their ranks there, form an inner interval, and
the earliest of them stays behind for the others. A suffix that is not the earliest
of an interval of n common lines begins a run of n lines that stands earlier in the corpus. The
longest such run of each suffix is maximal; its lines are deleted, however short it
is, so that the first copy of every line stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulemill.llm.common import discard, partitions, stored

MIN_WORDS = 1  # of a run; every line has one at least, so no run is too short


def text_hash(body: Column) -> Column:
    return F.xxhash64(F.coalesce(body, F.lit("")))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, hash, s, i, a, b, w) of (doc, hash, body): each non-blank line's place
    among these and among all lines, two hashes of it without the white space
    round it, and its words."""
    every = F.transform(F.split("body", "\n"), lambda x, i: F.struct(i.alias("i"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("x")))
    lines = docs.select("doc", "hash", F.posexplode(F.filter(every, lambda e: e["x"] != "")).alias("s", "e"))
    return lines.select("doc", "hash", "s", "e.i", F.xxhash64("e.x").alias("a"), F.xxhash64(F.lit(1), "e.x").alias("b"),
                        F.size(F.split("e.x", r"\s+")).alias("w"))


def ranked(groups: DataFrame, *by: str) -> DataFrame:
    """Groups with ``rank``: the sum of ``n`` over all groups before, in the order of
    ``by``. Even ranges are summed apart; only one number for each range is brought together."""
    cut = stored(groups.repartitionByRange(partitions(groups), *by).withColumn("part", F.spark_partition_id()), "rank-parts")
    own = Window.partitionBy("part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("part").agg(F.sum("n").alias("total"))
    before = totals.withColumn("start", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = cut.withColumn("inner", F.coalesce(F.sum("n").over(own), F.lit(0)))
    return inner.join(F.broadcast(before.select("part", "start")), "part").withColumn("rank", F.col("inner") + F.col("start")).drop("part", "inner", "start")


def chains_of(docs: DataFrame) -> DataFrame:
    """Chains of repeated lines of (doc, hash, body), with ``chain`` numbered in the order of the
    corpus: null ids last, then by id, hash of the text and place. Each has ``mark``, a hash of
    its sequence, the lines' ranks, words and places."""
    lines = stored(lines_of(docs), "line-keys")
    often = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    numbered = stored(ranked(often, "a", "b").select("a", "b", "rank"), "line-ranks")
    met = lines.join(numbered, ["a", "b"]).groupBy("doc", "hash").agg(F.sort_array(F.collect_set(F.struct("s", "i", "rank", "w"))).alias("e"))
    arrays = met.select("doc", "hash", *(F.col(f"e.{c}").alias(c) for c in ("s", "i", "rank", "w")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            doc, out = [], []
            for k, (h, s, i, r, w) in enumerate(zip(pdf["hash"], pdf["s"], pdf["i"], pdf["rank"], pdf["w"], strict=True)):
                bounds = [0, *(np.flatnonzero(np.diff(s) != 1) + 1).tolist(), len(s)]
                for a, b in zip(bounds, bounds[1:]):
                    mark = hashlib.blake2b(np.ascontiguousarray(r[a:b]).tobytes(), digest_size=16).digest()
                    doc.append(k)
                    out.append((h, int(s[a]), mark, r[a:b], w[a:b], i[a:b]))
            made = pd.DataFrame(out, columns=["hash", "s", "mark", "ranks", "words", "lines"])
            made.insert(0, "doc", pdf["doc"].iloc[doc].reset_index(drop=True))
            yield made

    kind = dict(docs.dtypes)["doc"]
    chains = arrays.mapInPandas(cut, f"doc {kind}, hash bigint, s int, mark binary, ranks array<bigint>, words array<int>, lines array<int>")
    chains = stored(chains, "line-chains")
    ordered = chains.withColumn("none", F.col("doc").isNull()).orderBy("none", "doc", "hash", "s")
    return ordered.drop("none", "s").withColumn("chain", F.monotonically_increasing_id())


def suffix_ranks(suffixes: DataFrame) -> list[DataFrame]:
    """Ranks of suffixes (sid, left, r), the first by one line, each next one by twice
    as many, until no two suffixes alike so far go on. ``left`` is the number of lines
    to the chain's end; the suffix one line on has the next ``sid``."""
    levels, span = [suffixes], 1
    while True:
        last = levels[-1]
        alike = last.groupBy("r").agg(F.count("*").alias("n"), F.max("left").alias("left")).where((F.col("n") > 1) & (F.col("left") > span))
        if alike.isEmpty():
            return levels
        ahead = last.select((F.col("sid") - span).alias("sid"), F.col("r").alias("ahead"))
        pairs = last.join(ahead, "sid", "left").withColumn("r2", F.when(F.col("left") > span, F.col("ahead")).otherwise(F.lit(-1)))
        pairs = stored(pairs.select("sid", "left", "r", "r2"), "suffix-pairs")
        groups = ranked(pairs.groupBy("r", "r2").agg(F.count("*").alias("n")), "r", "r2")
        levels.append(stored(pairs.join(groups, ["r", "r2"]).select("sid", "left", F.col("rank").alias("r")), "suffix-ranks"))
        discard(pairs)
        span *= 2


def earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """(sid, run): the most lines of each suffix that stand earlier as well."""
    members = levels[0].select(F.lit(-1).cast("bigint").alias("g"), F.lit(0).cast("bigint").alias("off"), "sid", "left")
    for level in range(len(levels) - 1, -1, -1):
        need = 1 << level
        ranks = levels[level].select(F.col("sid").alias("at"), "r")
        going = members.where(F.col("left") - F.col("off") >= need).join(ranks, F.col("sid") + F.col("off") == F.col("at")).drop("at")
        going = stored(going, "line-members")
        inner = going.groupBy("g", "off", "r").agg(F.min("sid").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        inside = stored(going.join(inner, ["g", "off", "r"]), "line-inside")
        stay = members.join(inside.where("sid != first").select("g", "off", "sid"), ["g", "off", "sid"], "left_anti")
        narrow = inside.select(F.col("first").alias("g"), (F.col("off") + need).alias("off"), "sid", "left")
        last, members = members, stored(stay.select("g", "off", "sid", "left").unionByName(narrow), "line-intervals")
        discard(going, inside, *([last] if level < len(levels) - 1 else []))
    return members.where("g >= 0 AND sid != g").groupBy("sid").agg(F.max("off").alias("run"))


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, hash, lines) of (doc, hash, body): the places of the lines to delete, for
    documents that have any. Chains alike but for the first of them are deleted whole, as
    that first one stands earlier."""
    chains = stored(chains_of(docs), "line-chains")
    firsts = chains.groupBy("mark").agg(F.min("chain").alias("chain"))
    firsts = stored(firsts.select("chain"), "line-firsts")
    own = chains.join(firsts, "chain", "left_semi")
    suffixes = own.orderBy("chain").select("chain", F.size("ranks").alias("size"), F.posexplode("ranks").alias("o", "r"))
    suffixes = stored(suffixes.withColumn("sid", F.monotonically_increasing_id()), "suffixes")
    levels = suffix_ranks(suffixes.select("sid", (F.col("size") - F.col("o")).cast("bigint").alias("left"), "r"))
    runs = suffixes.join(earlier_runs(levels), "sid").groupBy("chain").agg(F.collect_list("o").alias("o"), F.collect_list("run").alias("run"))
    found = own.join(runs, "chain").select("doc", "hash", "words", "lines", "o", "run")
    whole = chains.join(firsts, "chain", "left_anti").select(
        "doc", "hash", "words", "lines", F.array(F.lit(0)).alias("o"), F.array(F.size("lines").cast("bigint")).alias("run"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for words, lines, o, run in zip(pdf["words"], pdf["lines"], pdf["o"], pdf["run"], strict=True):
                total = np.concatenate([[0], np.cumsum(words)])
                o, run = np.asarray(o), np.asarray(run)
                enough = total[o + run] - total[o] >= min_words
                steps = np.zeros(len(lines) + 1, np.int64)
                np.add.at(steps, o[enough], 1)
                np.add.at(steps, (o + run)[enough], -1)
                out.append(np.asarray(lines)[np.cumsum(steps[:-1]) > 0])
            yield pdf[["doc", "hash"]].assign(lines=out)

    kind = dict(docs.dtypes)["doc"]
    places = found.unionByName(whole).mapInPandas(mark, f"doc {kind}, hash bigint, lines array<int>").where("size(lines) > 0")
    return places.groupBy("doc", "hash").agg(F.flatten(F.collect_list("lines")).alias("lines"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs``, the text without its deleted lines, and two columns
    ``_lines`` and ``_deleted`` with the number of non-blank lines there were and of those deleted.

    Of every run of lines the copy in the smallest id stays (null ids last; of one id
    with several texts by a hash of the text). A caller's larger ``min_words`` leaves the later
    copies of runs of fewer words as well.
    Lines are compared without white space at their ends; blank lines are no lines
    and stay where they are. Null and empty texts are returned as they are. Rows
    alike in id and text stand for one document and are treated alike. Very long texts are sequences like any
    other; extra columns may have any name but the two above.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc, body = names[docs.columns.index(key)], names[docs.columns.index(text)]
    plain = docs.toDF(*names)
    marked = plain.withColumn("doc", F.col(doc)).withColumn("hash", text_hash(F.col(body).cast("string")))
    places = stored(deletions(marked.select("doc", "hash", F.col(body).cast("string").alias("body")), min_words), "line-deletions")
    other = places.select(F.col("doc").alias("d"), F.col("hash").alias("h"), "lines")
    both = marked.join(other, F.col("hash").eqNullSafe(F.col("h")) & F.col("doc").eqNullSafe(F.col("d")), "left").select(*names, "lines")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, total, gone = [], [], []
            for t, lines in zip(pdf[body], pdf["lines"], strict=True):
                own = t.split("\n") if t else []
                total.append(sum(1 for x in own if x.strip()))
                drop = set() if lines is None else set(np.asarray(lines).tolist())
                gone.append(len(drop))
                texts.append("\n".join(x for i, x in enumerate(own) if i not in drop) if drop else t)
            pdf[body] = texts
            yield pdf[names].assign(_lines=total, _deleted=gone)

    schema = ", ".join([*(f"{n} {t}" if n != body else f"{n} string" for n, t in plain.dtypes), "_lines int", "_deleted int"])
    return both.mapInPandas(cut, schema).toDF(*docs.columns, "_lines", "_deleted")
