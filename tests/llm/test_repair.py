import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from rulemill.llm import queries, repair

sys.setrecursionlimit(20_000)
SPACE = " \t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, shape string, conv string, cost long"


def brute(shape):
    """Lightest (cost, audit) from the back: what is left of the rows, after what role."""

    @lru_cache(None)
    def rest(at, last, inserted):
        found = []
        if at == len(shape) and last in ("", "a"):
            found.append((0, ""))
        follow = "a" if last == "u" else "u"
        if inserted < 3:
            c, a = rest(at, follow, inserted + 1)
            found.append((c + 5, "I" + a))
        if at < len(shape):
            row = shape[at]
            c, a = rest(at + 1, last, 0)
            found.append((c + 2, "D" + a))
            if row != "x":
                extra = 5 * row.isupper()
                if row.lower() == follow or row.lower() == "s" and not last:
                    c, a = rest(at + 1, row.lower(), 0)
                    found.append((c + extra, "K" + a))
                c, a = rest(at + 1, follow, 0)
                found.append((c + extra + 1, "R" + a))
        return min(found, default=(10 ** 9, ""))

    return rest(0, "", 0)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        role, text = "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def expected(rows):
    after, found = damaged(rows), []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{r[2]}\0{r[3]}".encode()).hexdigest()))
        counts, seen, shape = {"b": 0, "d": 0, "t": 0}, set(), ""
        for _, _, role, text in own:
            solid = text.strip(SPACE)
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            shape += "x" if fault in ("b", "d") else initial.upper() if fault else initial
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = brute(shape)
        lines, last, at = [], "", 0
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            role = own[at][2] if edit == "K" else "assistant" if last == "u" else "user"
            lines.append(f"{role}:{'' if edit == 'I' else own[at][3]}")
            last, at = role[:1], at + (edit != "I")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        found.append((conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(found, key=repr)


def told(df):
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def conversations(n, seed):
    rng, rows = random.Random(seed), []
    says = ["Yes.", "No!", "Why?", "well", " ", "", "Good. ", "Go on.\t", "été.", "(maybe.)", None]
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "umpire"])
            rows.append((conv, None if rng.random() < 0.1 else rng.choice([turn, turn, turn + 2]), role, rng.choice(says)))
    return rows + [(None, 1, "user", "Null id."), (None, None, "assistant", "Null turn."), (-1, None, None, None)]


def test_agenda_against_brute_force():
    rng = random.Random(3)
    shapes = ["".join(s) for n in range(4) for s in itertools.product("suaoSUAOx", repeat=n)]
    shapes += ["".join(rng.choice("suauauoSUAx") for _ in range(rng.randint(4, 90))) for _ in range(300)]
    for shape in shapes:
        assert repair.lightest(shape) == brute(shape), shape


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_against_brute_force(spark, tmp_path, parts):
    rows = conversations(60, 7)
    df = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)
    got = repair.digests(repair.repair(repair.damage(df), parts)).withColumnRenamed("conv", "conv_id")
    assert told(got) == expected(rows)


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no", f"line {t}.", f"line {t // 3}", ""])) for t in range(400)]
    rows += [(1, 17, "user", "Same row.")] * 300 + [(0, 1, "user", "Hm."), (2, 1, "assistant", "Hm.")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    out = repair.repair(repair.damage(df), 16)
    assert out.where("conv = 1").count() > 3
    assert told(repair.digests(out).withColumnRenamed("conv", "conv_id")) == expected(rows)


def test_query_on_given_table_and_empty_table(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.QUERIES["op12_repair"](spark, sf)) == expected(rows)
    spark.read.parquet(f"{sf}/conversations.parquet").limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    assert told(queries.QUERIES["op12_repair"](spark, str(tmp_path))) == []


def test_real_outputs_hold_the_repaired_rows(spark):
    plain = spark.createDataFrame([(3, 1, "assistant", "Hello.", False), (3, 2, "user", "Yes.", False), (3, 3, "assistant", "Fine.", False)],
                                  "conv long, turn long, role string, text string, gone boolean")
    row = repair.repair(plain, 1).collect()[0]
    assert [(x["role"], x["text"]) for x in row["lines"]] == [("user", "Yes."), ("assistant", "Fine.")] and (row["cost"], row["audit"]) == (2, "DKK")
