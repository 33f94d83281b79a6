"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets and star-shaped candidate edges.

A document's set are the 64-bit hashes of its distinct word shingles. Documents with equal sets are one node; only nodes go
on. A node's sketch has one minimum per bin of the hash range; an empty bin takes the minimum of the first non-empty bin in
an order of its own, the same for all documents (optimal densification). Bands of the sketch are bucket keys.

Inside a bucket no pairs are formed: its most popular member (the one that shares its buckets with the most others, so the
one nearest to what the group has in common) is the centre of a star. Each edge is confirmed on the full sets. Members that
are in another component than the centre's meet the next centre in the next round, as long as rounds are worth their cost.
What stars can't see, links between two members that are both unlike every centre, is then looked for exactly: a prefix
filter on differences to a reference set leads to every pair of two components that can be a link (``_late_links``).
Components are found by large-star and small-star contraction, in tables, with a checkpoint each time.

Defined results: null and empty texts have an empty set and are linked with nothing; a text with fewer words than a shingle
has its whole word sequence as its one shingle; rows with equal sets are one component even if ids repeat or are null; the
smallest id counts, null ids only where a component has no other; an empty table gives an empty table; ``keep_one`` returns
the columns of ``docs`` under any names, keeps every row without words, and of other rows one for each group of linked sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.llm.common import WHITE, packed, row_key
from siteweave.recovery import cut, handed_back

#: Words of a shingle, and the least share of common shingles in percent.
WORDS, PERCENT = 5, 80
#: Bins of a sketch and bins of a band: a pair at 80 % shares no bucket with a chance of 5e-8, one at 85 % of 6e-11.
BINS, BAND = 128, 4
#: Star rounds end when fewer than one of so many tested pairs was a link; the exact search does the rest.
WORTH = 50
#: A small table is kept in so many rows a task.
TASK_ROWS = 4000
#: In the exact search, values that more than one of so many nodes have are looked at last; bits of a node's bitmap.
OFTEN, BITS = 16, 512
#: A worker remembers the hashes of so many words.
REMEMBERED = 300_000

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9]
_known: dict[bytes, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted, as uint64. A-Z is lower case; white space is space and 9 to 13."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(_known) > REMEMBERED:
        _known.clear()
    for word in set(found).difference(_known):
        _known[word] = xxhash.xxh64_intdigest(word)
    each = np.fromiter(map(_known.__getitem__, found), np.uint64, len(found))
    size = min(words, len(each))
    n = len(each) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mixed(out + each[k : k + n] * np.uint64(_MULTIPLIERS[k % 8]))
    return np.unique(out)


@lru_cache(4)
def detours(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a non-empty one."""
    return np.random.default_rng(20240).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)


def sketch(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One minimum for each bin, densified. ``hashes`` are sorted and not empty; ``bins`` is a power of two."""
    own = (hashes >> np.uint64(65 - bins.bit_length())).astype(np.int64)
    full, first = np.unique(own, return_index=True)
    out = np.zeros(bins, np.uint64)
    held = np.zeros(bins, bool)
    out[full], held[full] = hashes[first], True
    empty, order = np.flatnonzero(~held), detours(bins)
    for step in range(bins):
        if not len(empty):
            break
        source = order[empty, step]
        found = held[source]
        out[empty[found]] = out[source[found]]
        empty = empty[~found]
    return out


def bands(hashes: np.ndarray, bins: int = BINS, band: int = BAND) -> np.ndarray:
    """A bucket key (int64) for each band of the sketch; the band's number is part of the key."""
    rows = sketch(hashes, bins).reshape(-1, band)
    out = np.arange(len(rows), dtype=np.uint64) + np.uint64(1)
    for k in range(band):
        out = _mixed(out + rows[:, k] * np.uint64(_MULTIPLIERS[k % 8]))
    return out.view(np.int64)


def sketch_column(text: Column, words: int = WORDS, bins: int = BINS, band: int = BAND) -> Column:
    """struct(n_shingles, node, bands) of each text; node (128 bits of the set) and bands null for an empty set."""

    @F.pandas_udf("n_shingles long, node binary, bands array<long>")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                own = shingles(text, words)
                node = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                rows.append((len(own), node, bands(own, bins, band)) if len(own) else (0, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "node", "bands"], index=texts.index)
        _known.clear()  # the worker lives on, for other tasks
        handed_back()

    return sketched(text)


def shingle_column(text: Column, words: int = WORDS) -> Column:
    """The distinct shingle hashes of each text as array<long>."""

    @F.pandas_udf("array<long>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t, words).view(np.int64) for t in texts], index=texts.index, dtype=object)
        _known.clear()
        handed_back()

    return sets(text)


def _sized(df: DataFrame) -> DataFrame:
    """``df`` behind a checkpoint, in no more partitions than its rows fill: each shuffle of a small table writes a file for each of them."""
    held = cut(df)
    return held.coalesce(1 + held.count() // TASK_ROWS)


def _are_stars(edges: DataFrame) -> bool:
    """Does every u have one v, and is no v a u?"""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    held = edges.select(F.explode(ends).alias("e")).groupBy("e.x").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return held.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links`` (a, b): root is the smallest node reachable."""
    edges = _sized(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _are_stars(edges):
        few = lambda df, n=edges.count(): df.coalesce(1 + n // TASK_ROWS)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = few(few(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")).distinct())
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u")
        edges = _sized(few(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _pairs(members: DataFrame, tested: DataFrame | None) -> DataFrame:
    """New pairs (a < b) of each bucket's centre with its members in other components. members: (bucket, rank, node, root)."""
    center = members.groupBy("bucket").agg(F.max("rank").alias("c"), F.max_by("root", "rank").alias("c_root"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    center = center.where("r0 <> r1").select("bucket", F.col("c.node").alias("c_node"), "c_root")
    star = members.join(center, "bucket").where("root <> c_root")
    pairs = star.select(F.least("node", "c_node").alias("a"), F.greatest("node", "c_node").alias("b")).distinct()
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets agree to ``percent``.

    Sets cut to 16 bits a shingle go first: their common values, and what each set lost by being cut, bound the common
    shingles from above, so that only pairs that may be links move full sets.
    """
    small = F.array_distinct(F.transform("set", lambda x: (x.bitwiseAND(F.lit(65535)) - 32768).cast("short")))
    short = sets.select("node", F.size("set").alias("n"), small.alias("short"))
    near = lambda both, n: 100 * both >= percent * (n - both)
    side = lambda df, s: df.select(*[F.col(c).alias(c if c == s else f"{c}_{s}") for c in df.columns if c != "node"], F.col("node").alias(s))
    held = pairs.join(side(short, "a"), "a").join(side(short, "b"), "b")
    most = F.size(F.array_intersect("short_a", "short_b")) + F.least(F.col("n_a") - F.size("short_a"), F.col("n_b") - F.size("short_b"))
    close = _sized(held.where(near(F.least(most, "n_a", "n_b"), F.col("n_a") + F.col("n_b"))).select("a", "b"))
    ends = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = sets.join(ends, "node", "left_semi")
    full = close.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return full.where(near(both, F.size("set_a") + F.size("set_b"))).select("a", "b")


def _near(a: str, b: str, percent: int) -> str:
    """SQL: can nodes with the bitmaps and sizes ``bits`` and ``n`` under these names be linked?

    Each bit in which two bitmaps differ is at least one shingle that only one of both sets has.
    """
    apart = f"aggregate(zip_with({a}bits, {b}bits, (x, y) -> bit_count(x ^ y)), 0, (s, c) -> s + c)"
    return f"{100 + percent} * {apart} <= {100 - percent} * ({a}n + {b}n)"


def _keys(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, rank, root, n, bits, d, early): keys, two of which meet for every pair of a bucket of ``rest`` that can be a link.

    Buckets that hang together have one reference set; d is the size of a node's symmetric difference D to it, and bits a
    bitmap of D. For a link of sets of n_a and n_b shingles, |D_a & D_b| >= (d_a + d_b) / 2 - h, with
    h = n_a * (100 - percent) / (2 * percent). With the values of D in one order, the first common one is thus among the
    first h + 1 of the node with the smaller d (``early``) and among the first 2h + 1 of the other one; where D may have
    nothing in common, a key of its own stands for that. Any order would do; values that more than one of ``OFTEN`` nodes
    around the reference have stand last, the rarest of them first. There are at most ``OFTEN`` times the mean d of them.
    """
    top = rest.groupBy("bucket").agg(F.max("rank").alias("top"))
    held = _sized(rest.join(top, "bucket").select("node", "rank", "root", F.col("top.node").alias("to")).distinct())
    labels = components(held.select(F.col("node").alias("a"), F.col("to").alias("b"))).withColumnRenamed("root", "label")
    nodes = _sized(held.groupBy("node").agg(F.first("rank").alias("rank"), F.first("root").alias("root")).join(labels, "node"))
    lead = nodes.groupBy("label").agg(F.max("rank").alias("r"), F.count(F.lit(1)).alias("size")).select("label", "size", F.col("r.node").alias("node"))
    lead = lead.join(sets, "node").select("label", "size", F.col("set").alias("lead"))
    own = nodes.join(sets, "node").join(lead, "label")
    own = own.withColumn("diff", F.concat(F.array_except("set", "lead"), F.array_except("lead", "set")))
    own = _sized(own.select("label", "node", "rank", "root", F.size("set").alias("n"), "size", "diff"))
    often = own.select("label", "size", F.explode("diff").alias("x")).groupBy("label", "size", "x").agg(F.count(F.lit(1)).alias("df"))
    often = often.where(F.col("df") * OFTEN > F.col("size")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("often"))
    own = own.join(often.select("label", F.transform("often", lambda y: y["x"]).alias("often")), "label", "left")
    often_or_none = F.coalesce("often", F.array().cast("array<bigint>"))
    line = F.concat(F.array_sort(F.array_except("diff", often_or_none)), F.array_intersect(often_or_none, "diff"))
    # the bounds are whole numbers: floor(h) and floor(2h)
    most = lambda k: F.floor(F.col("n") * (100 - percent) * k / F.lit(2 * percent) + 1e-9).cast("int")
    bits = f"transform(sequence(0, {BITS // 64 - 1}), w -> aggregate(diff, 0L, (acc, x) -> IF((shiftright(x, 6) & {BITS // 64 - 1}) = w, acc | shiftleft(1L, CAST(x & 63 AS INT)), acc)))"
    own = own.select("label", "node", "rank", "root", "n", F.size("diff").alias("d"), most(1).alias("h"), most(2).alias("h2"), line.alias("line"), F.expr(bits).alias("bits"))
    first = F.transform(F.slice("line", 1, F.col("h2") + 1), lambda x, i: F.struct(F.xxhash64("label", x).alias("bucket"), (i <= F.col("h")).alias("early")))
    none = F.array(F.struct(F.xxhash64("label", F.lit("none")).alias("bucket"), (F.col("d") <= F.col("h")).alias("early")))
    keyed = own.select("node", "rank", "root", "n", "bits", "d", F.explode(F.when(F.col("d") <= F.col("h2"), F.concat(first, none)).otherwise(first)).alias("k"))
    return keyed.select("k.bucket", "node", "rank", "root", "n", "bits", "d", "k.early")


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links).withColumnRenamed("root", "to")
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("to", "node")).select(*members.columns)


def _late_links(rest: DataFrame, sets: DataFrame, links: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """``links`` and those that stars have not found: one more star for each key, then all pairs of two components that can be links."""
    keys = _sized(_keys(rest, sets, percent))
    own = F.struct("root", "n", "bits")
    center = keys.groupBy("bucket").agg(F.max("rank").alias("c"), F.max_by(own, "rank").alias("k"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    center = center.where("r0 <> r1").select("bucket", F.col("c.node").alias("c_node"), "k")
    star = keys.join(center, "bucket").where("root <> k.root").where(_near("", "k.", percent))
    pair = lambda df, a, b: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    stars = _sized(pair(star, "node", "c_node").join(tested, ["a", "b"], "left_anti"))
    links = _sized(links.unionByName(_confirmed(stars, sets, percent)))
    keys = _sized(_rooted(keys, links))
    side = lambda s: keys.select("bucket", F.struct("node", "root", "d", "n", "bits").alias(s), F.col("early").alias(f"early_{s}"))
    met = side("a").where("early_a").join(side("b"), "bucket").where("a.root <> b.root AND (a.d < b.d OR a.d = b.d AND a.node < b.node)").where(_near("a.", "b.", percent))
    pairs = _sized(pair(met, "a.node", "b.node").join(tested.unionByName(stars), ["a", "b"], "left_anti"))
    return _sized(links.unionByName(_confirmed(pairs, sets, percent)))


def find_links(docs: DataFrame, sketched: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b): confirmed links between nodes. sketched: (row, node, n_shingles, bands) for the rows of ``docs``."""
    nodes = sketched.where("node IS NOT NULL").groupBy("node").agg(F.any_value("bands").alias("bands"))
    keyed = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    crowd = cut(keyed.join(shared, "bucket"))
    popular = crowd.groupBy("node").agg(F.sum("size").alias("pop"))
    members = cut(crowd.join(popular, "node").select("bucket", "node", F.struct("pop", "node").alias("rank")))

    # one row of each node first: equal copies, however many, never meet in the join
    first = sketched.where("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row")).join(popular.select("node"), "node")
    own = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "text").join(first, "row")
    sets = cut(own.select("node", shingle_column(F.col("text"), words).alias("set")).groupBy("node").agg(F.any_value("set").alias("set")))

    links: DataFrame | None = None
    tested: DataFrame | None = None
    rest = members.withColumn("root", F.col("node"))
    while True:
        pairs = _sized(_pairs(rest, tested))
        new = _sized(_confirmed(pairs, sets, percent))
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        # the centres of this round step back; what stays are buckets that still join several components
        top = rest.groupBy("bucket").agg(F.max("rank").alias("top"))
        rest = rest.join(top, "bucket").where("rank < top").drop("top")
        found = new.count()
        if found:
            rest = _rooted(rest, links)
        span = rest.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
        rest = _sized(rest.join(span.select("bucket"), "bucket", "left_semi").select("bucket", "node", "rank", "root"))
        if rest.isEmpty():
            return links
        if found * WORTH < pairs.count():
            return _late_links(rest, sets, links, tested, percent)


def assign(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, group) for every row of ``docs`` (doc_id, text).

    ``row`` is ``row_key(doc_id, text)``; ``group`` stands for the linked sets of the row, null for an empty set.
    """
    docs = docs.select("doc_id", "text")
    sketched = cut(docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), sketch_column(F.col("text"), words).alias("s")).select("doc_id", "row", "s.*"))
    roots = components(find_links(docs, sketched, words, percent))
    nodes = sketched.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows"))
    placed = nodes.join(roots, "node", "left").where("rows > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "node"))
    placed = cut(placed)
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("node", "component_id", "root")
    out = sketched.drop("bands").join(named, "node", "left")
    return out.select("doc_id", "row", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("root", "node").alias("group"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked sets: that with the smallest id, a null id last; and all rows without words."""
    found = assign(docs, words, percent).where(F.col("group").isNotNull())
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
    wordless = F.btrim(F.coalesce(F.col("doc.text"), F.lit("")), F.lit(WHITE)) == ""
    held = packed(docs)
    full = held.where(~wordless).withColumn("row", row_key(F.col("doc.doc_id"), F.col("doc.text")))
    one = full.join(first.select("m.row"), "row", "left_semi").dropDuplicates(["row"])
    return one.select("doc").unionByName(held.where(wordless)).select("doc.*")
