"""Near copies of items against plain edit distances."""

import random

from rulemill.llm import decontaminate, queries
from rulemill.llm.words import split_words, word_spans
from tests.llm.helpers import docs_of, odd_rows, prose


def nearest(item, words):
    """Least edit distance of an item to any stretch of words."""
    line = [0] * (len(words) + 1)
    for x in item:
        new = [line[0] + 1]
        for k, w in enumerate(words):
            new.append(min(line[k] + (w != x), line[k + 1] + 1, new[-1] + 1))
        line = new
    return min(line)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k:k + 1] = rng.choice([[], ["zapped"], [words[k], "added"]])
    return " ".join(words)


def test_finds_edited_passages_and_nothing_else(spark):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randint(14, 60))) for k in range(30)]
    rows, want = [], set()
    for i in range(300):
        text = prose(rng, rng.randint(0, 300))
        if i % 3 == 0:
            k = rng.randrange(30)
            copy = edited(rng, items[k][1], rng.randint(0, int(0.2 * len(items[k][1].split()))))
            text = f"{text[:len(text) // 2]} {copy.upper()}! {text[len(text) // 2:]}"
            want.add((i, k))
        rows.append((i, text))
    found = decontaminate.scan(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(want & got) >= 0.99 * len(want)
    texts, item_texts = dict(rows), dict(items)
    for r in found:
        words, item = split_words(texts[r["doc_id"]]), split_words(item_texts[r["item_id"]])
        stretch = words[r["first_word"]:r["first_word"] + r["words"]]
        assert nearest(item, stretch) == r["distance"] <= 0.2 * len(item)
        assert r["item_words"] == len(item)
    assert got - want <= {(i, k) for i, k in got if nearest(split_words(item_texts[k]), split_words(texts[i])) <= 0.2 * len(split_words(item_texts[k]))}


def test_copies_at_the_bound_are_found_at_every_length():
    rng = random.Random(12)
    word = lambda of: f"{of}{rng.randrange(3000)}"
    for n in [*range(1, 21), 25, 30, 39, 40, 60]:
        items, copies = [[word("w") for _ in range(n)] for _ in range(80)], []
        for k, words in enumerate(items):
            words, e = list(words), int(0.2 * n)
            for at in [int((x + 0.5) * n / e) for x in range(e)] if k % 2 else rng.sample(range(n), e):
                words[at] = word("z")
            copies.append(" ".join([*(word("u") for _ in range(20)), *words, *(word("u") for _ in range(20))]))
        found = decontaminate.Items(list(range(80)), [" ".join(x) for x in items]).find(copies)
        got = len({f[0] for f in found if f[0] == f[1]})
        assert got == 80 if n < decontaminate.EXACT_WORDS else got >= 79, n


def test_short_items_must_occur_exactly(spark):
    items = spark.createDataFrame([(1, "red fox"), (2, "blue"), (3, None), (4, ""), (5, "...")], "item_id long, text string")
    docs = docs_of(spark, [(1, "the Red, fox runs"), (2, "the red dog, a fox"), (3, "BLUE")])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.scan(docs, items).collect()) == [(1, 1), (3, 2)]


def test_clean_and_odd_rows(spark):
    rng = random.Random(8)
    item = prose(rng, 40)
    items = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    rows = [*odd_rows(), (50, prose(rng, 20) + "\n" + item), (None, item), (51, prose(rng, 20_000) + " " + item)]
    docs = docs_of(spark, rows)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(odd_rows(), key=repr)
    assert len(decontaminate.scan(docs, items).collect()) == 6
    none = items.limit(0)
    assert decontaminate.scan(docs, none).collect() == [] and decontaminate.clean(docs, none).count() == len(rows)
    assert decontaminate.scan(docs_of(spark, []), items).collect() == []


def test_words_and_their_places():
    text = "Été: naïve-x \U0001f642 A1,b"
    assert [w.decode() for w in split_words(text)] == ["Été", "naïve", "x", "\U0001f642", "a1", "b"]
    assert [text[a:b] for a, b in word_spans(text)] == ["Été", "naïve", "x", "\U0001f642", "A1", "b"]


def test_query_finds_all_exact_passages(spark, sf):
    join = lambda t: b" " + b" ".join(split_words(t or "")) + b" "
    docs = [(r["doc_id"], join(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], join(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in queries.QUERIES["op8_decontaminate"](spark, sf).collect()}
    assert want and {k for k, d in got.items() if d == 0} == want
