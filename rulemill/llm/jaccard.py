"""Near duplicates: an exact Jaccard join of word shingles.

Texts with equal shingle sets are one class first. Two sets that are similar enough
share a token in their prefixes - the first few tokens - whatever total order the
tokens are put in. So candidates come from a shared prefix token under one order,
must share one under each other order as well, and only what passes all of them is
verified by its exact overlap.

All orders put frequent tokens last, which keeps prefixes to rare ones; within
equal frequency each order is another random permutation. Frequencies are lower bounds
for the most frequent tokens only: they steer which tokens come first, never which
links are found.

Before that, a pair is held against parity bitmaps: each token flips one bit of its set's, so two bitmaps
differ in no more bits than the sets differ in tokens, and a pair with too many of them cannot link. A component
is held against others by the bits that all of its members have and those that none has.

Result rows name classes, not pairs, so within a connected group not every pair is
needed. Each prefix bucket is compared with a pivot a few times, more often while buckets are crowded and
pivots find links; then only members of different components that still share a bucket are compared, all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import discard, stored
from rulemill.llm.graph import components

WORDS = 5
SHARE = (80, 100)  # intersection to union
PIVOT_ROUNDS = 2  # at least
MOST_PIVOT_ROUNDS = 8  # while pairs are many and pivots still find links
MANY = 4  # pairs of components for each row of a bucket
WORTH = 16  # pairs that a pivot round may compare for each link it finds, to be followed by another
OFTEN = 2  # occurrences in one stretch of documents from which a token is counted as frequent
STRETCH = 1 << 22  # shingles of a stretch
MOST_FREQUENT = 1 << 18  # tokens whose frequency the orders know: 4 MB
FINE = 4096  # counts up to which the histogram of counts is exact
BROADCAST_ROWS = 1 << 18  # of ids of texts to read again: some 30 MB as a hash table; more are joined by a shuffle
WORDS_OF_BITS = 16  # longs of a bitmap; sets of up to some 2,000 shingles fill it well, of larger ones it tells less and loses none
BITS = [f"b{k}" for k in range(WORDS_OF_BITS)]
ALL, ANY = [f"all{k}" for k in range(WORDS_OF_BITS)], [f"any{k}" for k in range(WORDS_OF_BITS)]  # set in all members, in any
_M = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ x >> np.uint64(32) ^ np.uint64(salt * 0x5851F42D4C957F2D & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def shingles(text: str | None, hashes: dict[bytes, int], size: int = WORDS, distinct: bool = True) -> np.ndarray:
    """64-bit keys of a text's shingles, the distinct ones sorted or all in turn. Words end at ASCII white
    space and A-Z is lower-cased; fewer words than ``size`` are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    total = np.full(len(own) - span + 1, span, np.uint64)
    for k in range(span):
        total *= _M
        total += own[k:len(own) - span + 1 + k]
    total = mix(total)
    return np.unique(total) if distinct else total


def text_hash(body: Column) -> Column:
    return F.xxhash64(F.coalesce(body, F.lit("")))


def prefix_size(n: int) -> int:
    """Tokens of a set of ``n`` among which one must be shared."""
    return n - -(-n * SHARE[0] // SHARE[1]) + 1 if n else 0


class Orders:
    """Total orders of tokens: by known frequency, then by a permutation."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.marks = np.zeros(1 << 22, bool)  # slots of known tokens, so that few others are looked up
        self.marks[(tokens >> np.uint64(42)).astype(np.int64)] = True

    def prefix(self, tokens: np.ndarray, salt: int) -> np.ndarray:
        """The first tokens of a set under one order, in it."""
        n = prefix_size(len(tokens))
        known = np.flatnonzero(self.marks[(tokens >> np.uint64(42)).astype(np.int64)])
        often = np.zeros(len(tokens), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(self.tokens, tokens[known]), len(self.tokens) - 1)
            often[known] = np.where(self.tokens[at] == tokens[known], self.counts[at], 0)
        rank = mix(tokens, salt)
        rare = np.flatnonzero(often == 0)
        if len(rare) > n:  # all of the prefix is among the tokens of no known frequency
            rare = rare[np.argpartition(rank[rare], n - 1)[:n]] if n else rare[:0]
        first = rare[np.argsort(rank[rare], kind="stable")][:n]
        if len(first) < n:
            rest = np.flatnonzero(often)
            first = np.concatenate([first, rest[np.lexsort((rank[rest], often[rest]))[:n - len(first)]]])
        return tokens[first]


def frequent_tokens(docs: DataFrame) -> Orders:
    """Lower bounds of the counts of the most frequent tokens, of (doc, body)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, held, size = _WordHashes(), [], 0

        def settle() -> pd.DataFrame:
            tokens = np.concatenate(held)
            slot = (tokens >> np.uint64(42)).astype(np.int64)  # tokens of a slot with few entries are not frequent
            tokens, counts = np.unique(tokens[np.bincount(slot, minlength=1 << 22)[slot] >= OFTEN], return_counts=True)
            often = counts >= OFTEN
            return pd.DataFrame({"token": tokens[often].view(np.int64), "n": counts[often]})

        for pdf in batches:
            for body in pdf["body"]:
                held.append(shingles(body, hashes, distinct=False))
                size += len(held[-1])
                if size >= STRETCH:
                    yield settle()
                    held, size = [], 0
        if size:
            yield settle()

    counts = stored(docs.select("body").mapInPandas(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")), "jaccard-counts")
    least = threshold(counts)
    top = counts.where(F.col("n") >= least).toPandas()
    discard(counts)
    return Orders(top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64))


def threshold(counts: DataFrame) -> int:
    """The smallest count that at most ``MOST_FREQUENT`` tokens reach, from a histogram: exact up to
    ``FINE``, above by sixty-fourths of a power of two. So what is sent to the driver has that bound."""
    slot = F.when(F.col("n") < FINE, F.col("n")).otherwise(F.lit(FINE) + F.floor(F.log2(F.col("n") / FINE) * 64)).cast("bigint")
    slots = counts.groupBy(slot.alias("slot")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("tokens")).collect()
    least, held = None, 0
    for r in sorted(slots, key=lambda r: -r["slot"]):
        held += r["tokens"]
        if held > MOST_FREQUENT:
            return least if least is not None else r["high"] + 1
        least = r["low"]
    return least if least is not None else 1


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parities of the numbers of tokens in each of the slots, as longs."""
    slots = 64 * WORDS_OF_BITS
    odd = np.bincount(((tokens & np.uint64(0xFFFFFFFF)) % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefixes(docs: DataFrame, orders: Orders) -> DataFrame:
    """(doc, hash, n, mark, prefix, bits) of (doc, hash, body): the set's size, a 128-bit mark of the
    set, null if it is empty, its prefix under the first order, and its bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(orders)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for pdf in batches:
            n, mark, prefix, bits = [], [], [], []
            for body in pdf["body"]:
                tokens = shingles(body, hashes)
                n.append(len(tokens))
                mark.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                prefix.append(shared.value.prefix(tokens, 1).view(np.int64))
                bits.append(bitmap(tokens))
            yield pd.DataFrame({"doc": pdf["doc"], "hash": pdf["hash"], "n": n, "mark": mark, "prefix": prefix, "bits": bits})

    return docs.mapInPandas(run, f"doc {dict(docs.dtypes)['doc']}, hash bigint, n bigint, mark binary, prefix array<bigint>, bits array<bigint>")


def sets_of(docs: DataFrame, classes: DataFrame, orders: Orders) -> DataFrame:
    """(node, n, tokens, other) of the classes (node, doc, mark): all tokens, those of
    the prefix under the second order first, and the prefix under the third. A class
    of repeated rows may come once from each task."""
    shared = docs.sparkSession.sparkContext.broadcast(orders)
    few = classes.count() <= BROADCAST_ROWS
    wanted = classes.select("node", F.col("doc").alias("own"), F.col("mark").alias("wanted"))
    rows = docs.join(F.broadcast(wanted) if few else wanted, F.col("doc").eqNullSafe(F.col("own"))).select("node", "wanted", "body")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, done = _WordHashes(), set()
        for pdf in batches:
            out = []
            for node, wanted, body in zip(pdf["node"], pdf["wanted"], pdf["body"], strict=True):
                if node in done:
                    continue
                tokens = shingles(body, hashes)
                if hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() == wanted:
                    done.add(node)
                    first = shared.value.prefix(tokens, 2)
                    rest = np.setdiff1d(tokens, first, assume_unique=True)
                    out.append((node, len(tokens), np.concatenate([first, rest]).view(np.int64), shared.value.prefix(tokens, 3).view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "n", "tokens", "other"])

    return rows.mapInPandas(run, "node bigint, n bigint, tokens array<bigint>, other array<bigint>")


def may_link(na: Column, pa: Column, nb: Column, pb: Column) -> Column:
    """Can two sets be similar enough whose first shared token stands at these places
    of theirs? A pair's first one passes, so testing every shared token loses none."""
    most = 1 + F.least(na - pa, nb - pb) - 1
    return (SHARE[1] * F.least(na, nb) >= SHARE[0] * F.greatest(na, nb)) & ((SHARE[0] + SHARE[1]) * most >= SHARE[0] * (na + nb))


def few_bits(differing: list[Column], na: Column, nb: Column) -> Column:
    """Can sets of at most these sizes link that differ in the slots set in these longs, at least?"""
    return (SHARE[0] + SHARE[1]) * sum((F.bit_count(x) for x in differing[1:]), F.bit_count(differing[0])) <= (SHARE[1] - SHARE[0]) * (na + nb)


def _apart(a: tuple[list[Column], list[Column]], b: tuple[list[Column], list[Column]]) -> list[Column]:
    """Bits that all members of one side have and none of the other; a side is given by its bits set in all and in any member."""
    return [p.bitwiseAND(F.bitwise_not(y)).bitwiseOR(q.bitwiseAND(F.bitwise_not(x))) for p, x, q, y in zip(*a, *b, strict=True)]


def _cols(names: list[str], prefix: str = "") -> list[Column]:
    return [F.col(prefix + n) for n in names]


def alike(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (u, v) that may link by their bitmaps, of (node, n, *BITS)."""
    both = pairs.join(bits.toDF("u", "nu", *(f"u{b}" for b in BITS)), "u").join(bits.toDF("v", "nv", *(f"v{b}" for b in BITS)), "v")
    return both.where(few_bits([F.col(f"u{b}").bitwiseXOR(F.col(f"v{b}")) for b in BITS], F.col("nu"), F.col("nv"))).select("u", "v")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that share a prefix token under the second and third order too and whose overlap is large enough."""
    p = (F.col("n") - F.ceil(F.col("n") * SHARE[0] / SHARE[1]) + 1).cast("int")
    own = sets.select("node", "n", "tokens", F.slice("tokens", F.lit(1), p).alias("second"), "other")
    both = pairs.join(own.toDF("u", "nu", "tu", "su", "ou"), "u").join(own.toDF("v", "nv", "tv", "sv", "ov"), "v")
    shared = F.size(F.array_intersect("tu", "tv"))
    enough = SHARE[1] * shared >= SHARE[0] * (F.col("nu") + F.col("nv") - shared)
    return both.where(F.arrays_overlap("su", "sv") & F.arrays_overlap("ou", "ov") & enough).select("u", "v").distinct()


def _verified(pairs: DataFrame, source: DataFrame, classes: DataFrame, orders: Orders) -> DataFrame:
    """The pairs that link; sets are read for the texts in them only."""
    near = stored(alike(pairs, classes.select("node", "n", *(F.col("bits")[k].alias(b) for k, b in enumerate(BITS)))), "jaccard-near")
    nodes = near.select("u").unionAll(near.select(F.col("v").alias("u"))).distinct().toDF("node")
    wanted = stored(classes.select("node", "doc", "mark").join(nodes, "node", "left_semi"), "jaccard-wanted")
    sets = stored(sets_of(source, wanted, orders), "jaccard-sets")
    links = stored(verify(near, sets), "jaccard-links")
    discard(pairs, wanted, sets, near)
    return links


def _labels(links: DataFrame, rows: DataFrame) -> DataFrame:
    """Prefix rows with the component each node is in so far."""
    roots = components(links)
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def buckets_of(classes: DataFrame) -> DataFrame:
    """(token, node, n, pos): the classes (node, n, prefix) that share a prefix token with another one.

    A passage that many texts share gives as many tokens with the very same members; of such tokens, told by
    two checksums over their members, one stands for all, with the first place that any of them has in a member's prefix.
    So a pair meets once, and as earlier places only let more pairs through, none is lost.
    """
    tokens = classes.select(F.posexplode("prefix").alias("pos", "token"), "node", "n")
    members = tokens.groupBy("token").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    members = stored(members.where("c > 1"), "jaccard-tokens")
    named = members.groupBy("c", "x", "y").agg(F.min("token").alias("bucket"))
    named = stored(members.join(named, ["c", "x", "y"]).select("token", "bucket"), "jaccard-named")
    out = tokens.join(named, "token").groupBy(F.col("bucket").alias("token"), "node").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
    out = stored(out, "jaccard-buckets")
    discard(members, named)
    return out


def crossings(rows: DataFrame) -> int:
    """Pairs of components that share a bucket, counted once for each bucket."""
    per_bucket = rows.select("token", "root").distinct().groupBy("token").agg(F.count("*").cast("double").alias("c"))
    return int(per_bucket.agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).first()[0] or 0)


def pivot_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with one pivot of it, if they are in different
    components; of (token, node, n, pos, root)."""
    rank = F.xxhash64("node", F.lit(turn))
    pivot = rows.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), "node", "n", "pos", "root")).alias("p"))
    met = rows.join(pivot, "token").where((F.col("root") != F.col("p.root")) & may_link(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos")))
    return met.select(*_pair(F.col("node"), F.col("p.node"))).distinct()


def remaining_pairs(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """All pairs of members of a bucket that are in different components and may link, also by their bitmaps (node, *BITS)."""
    mixed = rows.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("token")
    rows = stored(rows.join(mixed, "token", "left_semi").join(bits, "node"), "jaccard-mixed")
    groups = rows.groupBy("token", "root").agg(F.min("n").alias("low"), F.max("n").alias("high"), *(F.bit_and(b).alias(x) for b, x in zip(BITS, ALL, strict=True)),
                                               *(F.bit_or(b).alias(x) for b, x in zip(BITS, ANY, strict=True)))

    def named(df: DataFrame, side: str) -> DataFrame:
        return df.select("token", *(F.col(c).alias(side + c) for c in df.columns if c != "token"))

    a, b = (_cols(ALL, "a"), _cols(ANY, "a")), (_cols(ALL, "b"), _cols(ANY, "b"))
    own, other = (_cols(BITS, "x"), _cols(BITS, "x")), (_cols(BITS, "y"), _cols(BITS, "y"))
    sizes = (SHARE[1] * F.col("ahigh") >= SHARE[0] * F.col("blow")) & (SHARE[1] * F.col("bhigh") >= SHARE[0] * F.col("alow"))
    crossing = named(groups, "a").join(named(groups, "b"), "token").where((F.col("aroot") < F.col("broot")) & sizes & few_bits(_apart(a, b), F.col("ahigh"), F.col("bhigh")))
    crossing = crossing.select("token", F.col("aroot").alias("xroot"), F.col("broot").alias("yroot"), "bhigh", *b[0], *b[1])
    left = crossing.join(named(rows, "x"), ["token", "xroot"]).where(few_bits(_apart(own, b), F.col("xn"), F.col("bhigh")))
    left = left.select("token", "yroot", "xnode", "xn", "xpos", *own[0])
    met = left.join(named(rows, "y"), ["token", "yroot"])
    link = may_link(F.col("xn"), F.col("xpos"), F.col("yn"), F.col("ypos")) & few_bits(_apart(own, other), F.col("xn"), F.col("yn"))
    return met.where(link).select(*_pair(F.col("xnode"), F.col("ynode"))).distinct()


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, hash, n, rid, root) of every row: a hash of the text, the set's size, the
    row's number and its class's component, null where the set is empty.

    Null and empty texts and those of white space alone have an empty set and are
    linked with nothing. Repeated rows, and rows of one id with different texts, are
    rows of their own. Very long texts are taken whole. An empty table gives no
    rows. Other columns are dropped, so none can clash.
    """
    source = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("body"))
    source = source.withColumn("hash", text_hash(F.col("body")))
    orders = frequent_tokens(source)
    rows = stored(prefixes(source, orders).withColumn("rid", F.monotonically_increasing_id()), "jaccard-rows")
    classes = rows.where("n > 0").groupBy("mark").agg(F.min_by(F.struct("rid", "doc", "n", "prefix", "bits"), "rid").alias("first"))
    # a class is compared through its first row alone
    classes = stored(classes.select("mark", F.col("first.rid").alias("node"), "first.doc", "first.n", "first.prefix", "first.bits"), "jaccard-classes")
    bits = classes.select("node", *(F.col("bits")[k].alias(b) for k, b in enumerate(BITS)))
    buckets = buckets_of(classes)
    size, links, labelled, turn, more = buckets.count(), None, buckets.withColumn("root", F.col("node")), 0, True
    while more:
        more = turn < PIVOT_ROUNDS or turn < MOST_PIVOT_ROUNDS and found.count() * WORTH > met and crossings(labelled) > MANY * size
        pairs = stored(pivot_pairs(labelled, turn) if more else remaining_pairs(labelled, bits), "jaccard-pairs")
        met, found = pairs.count(), _verified(pairs, source, classes, orders)
        links = found if links is None else links.unionByName(found)
        if more:
            labelled = stored(_labels(links, buckets), "jaccard-labels")
        turn += 1
    roots = stored(components(links), "jaccard-roots")
    named = classes.join(roots, "node", "left").select("mark", F.coalesce("root", "node").alias("root"))
    whole = rows.select("doc", "hash", "n", "mark", "rid").where("n > 0").join(named, "mark").select("doc", "hash", "n", "rid", "root")
    return whole.unionByName(rows.where("n = 0").select("doc", "hash", "n", "rid", F.lit(None).cast("bigint").alias("root")))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest id reachable by links; a
    document without links, and one without words, has its own. Null ids count only
    where a component has no other."""
    linked = stored(join(docs, key, text), "jaccard-linked")
    low = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("low"))
    out = linked.join(low, "root", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("low")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, one of each component: the one with the smallest
    id, null ids last; of rows alike in that, the first read. Documents without words all stay."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc, body = F.col(names[docs.columns.index(key)]), F.col(names[docs.columns.index(text)]).cast("string")
    plain = plain.withColumn("doc", doc).withColumn("hash", text_hash(body))
    linked = stored(join(docs, key, text).where("root IS NOT NULL"), "jaccard-linked")
    first = linked.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "rid")).alias("first"))
    judged = linked.join(first, "root").select("doc", "hash", (F.col("rid") == F.col("first.rid")).cast("int").alias("kept"))
    texts = judged.groupBy("doc", "hash").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    changed = stored(texts.where("kept = 0 OR rows > 1"), "jaccard-changed")
    few = changed.count() <= BROADCAST_ROWS
    other = changed.select(F.col("doc").alias("d"), F.col("hash").alias("h"), "kept")
    other = F.broadcast(other) if few else other
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    whole = plain.join(other, same, "left_anti")
    repeated = plain.join(other.where("kept = 1"), same, "left_semi").dropDuplicates(["doc", "hash"])
    return whole.unionByName(repeated).select(*names).toDF(*docs.columns)
