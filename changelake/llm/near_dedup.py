"""Near-duplicate documents by bottom-k sketches, with exact links.

A document is the set of its word shingles, each a 64-bit hash; its sketch is the
``K`` smallest.  Documents with equal sets form a class, and classes are linked when
their sets' Jaccard similarity reaches the threshold.

1. *Inverted lists of sketch values.*  Linked sets share most of their sketches, so
   with values ordered from rare to common each link shows among the first few of
   both (the prefix).  ``SHARED`` values of full sketches are asked for; a pair at the
   threshold shares fewer with a probability below 1e-8.  Documents that are alone
   in all their lists leave here.
2. *Inverted lists of whole sets* for those that stay, again rare to common, with the
   exact prefix of the threshold and each value's rank.
3. *Pivots.*  Each list names its most typical member, and all others of the list
   meet it: linear work where all pairs would be quadratic.
4. *The rest.*  Only pairs of different components that share a list and whose sizes
   and ranks still allow a link are left; they are met one by one, by list and bands of
   both sizes, so that what sizes and ranks rule out is hardly ever paired.

Pairs of 3 and 4 pass an estimate on the union's sketch before the exact Jaccard of
the whole sets decides.  Components come from minimum labels passed along links.
Lists never leave the cluster, and no group of documents is gathered in one task.

Defined results: null or blank texts have empty sets and no links; null ids come last
and make a null component id unless a linked document has an id; rows equal in id and
words are one class.  Labels name a class besides its least id, so ``representatives``
keeps one row of each component also where ids are null or repeated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from changelake.llm.common import join_counted, scratch, stored
from changelake.llm.shipping import ship
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 64
SHARED = 28  # least overlap of two full sketches at a similarity of 0.8
SHARED_PART_FULL = 48  # the same where one of the sets is smaller than a sketch
LAST = (1 << 63) - 1  # stands for a null id
BROADCAST_ROWS = 400_000  # of 24 bytes: what tasks may hold of the documents to look at again
BAND = math.log(1.03)  # sizes in a band are within 3 per cent
_M = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers (as signed)."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if len(h) < words:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))], dtype=np.uint64).view(np.int64)
    n = len(h) - words + 1
    out = np.full(n, words, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(words):
            out = (out ^ (out >> np.uint64(29))) * _M + h[j : j + n]
        out = (out ^ (out >> np.uint64(32))) * _M
    out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def sketches(df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per row ``__key, __th, n_shingles, __class, __k, __sketch``; ``__class`` digests the whole set."""
    ship(df.sparkSession)
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("__key"), F.xxhash64(text).alias("__th"), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketch = [], [], []
            for t in batch.column(2).to_pylist():
                found = shingles(t or "", words)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sketch.append(found[:K])
            short = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(short, pa.int64()), pa.array(sketch, pa.list_(pa.int64()))],
                ["__key", "__th", "n_shingles", "__class", "__k", "__sketch"],
            )

    return rows.mapInArrow(run, "__key long, __th long, n_shingles long, __class binary, __k long, __sketch array<long>")


def whole_sets(df: DataFrame, text: str, words: int) -> DataFrame:
    """``__k, __class, __set`` for rows with ``__k, __class, __text``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t or "", words) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))], ["__k", "__class", "__set"])

    return df.select("__k", "__class", F.col(text).alias("__text")).mapInArrow(run, "__k long, __class binary, __set array<long>")


def _ranked(values: DataFrame, name: str) -> DataFrame:
    """Per ``__k``: its size ``__n`` and, rare first, ``__list`` of (times, value) that others have as well."""
    times = stored(values.groupBy("__value").agg(F.count("*").alias("__times")).filter("__times > 1"), name)
    shared = join_counted(values, times, ["__value"], "__times", ["__k"], "inner")
    return shared.groupBy("__k").agg(
        F.max("__n").alias("__n"), F.max("__size").alias("__size"), F.array_sort(F.collect_set(F.struct("__times", "__value"))).alias("__list")
    )


def _met_twice(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose ``__value`` is in several documents' prefixes, stored."""
    rows = stored(rows, name)
    lists = rows.groupBy("__value").agg(F.count("*").alias("__members")).filter("__members > 1")
    return join_counted(rows, stored(lists, f"{name}-sizes"), ["__value"], "__members", ["__k"], "inner")


def _possible(a: str, b: str, percent: int) -> Column:
    """Sizes and ranks that still allow a link where a value is the first that both share."""
    n, m = F.col(f"{a}__size"), F.col(f"{b}__size")
    overlap = F.least(n - F.col(f"{a}__rank"), m - F.col(f"{b}__rank"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * overlap >= percent * (n + m))


def _roles(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` as the smaller and as the larger of two, once per band of the other's size that size and rank allow.

    ``__low`` and ``__high`` are the bands of the smaller and the larger size.
    """
    n = F.col("__size").cast("long")
    most = F.floor(((100 + percent) * (n - F.col("__rank")) - percent * n) / percent)
    band = lambda size: F.floor(F.log(size.cast("double")) / BAND).cast("int")
    bands = lambda a, b: F.explode(F.sequence(band(a), band(b)))
    larger = F.least(F.floor(100 * n / percent), most)
    smaller = F.ceil(percent * n / 100)
    return (
        rows.filter(larger >= n).withColumn("__low", band(n)).withColumn("__high", bands(n, larger)),
        rows.filter(F.least(n, most) >= smaller).withColumn("__low", bands(smaller, F.least(n, most))).withColumn("__high", band(n)),
    )


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``__a < __b``: documents of different labels that share a value and whose sizes and ranks allow a link."""
    keys = ["__value", "__low", "__high"]
    one, two = (role.select(*keys, *[F.col(c).alias(f"{x}{c}") for c in ("__k", "__size", "__rank", "__label")]) for x, role in zip("ab", _roles(rows, percent)))
    ordered = (F.col("a__size") < F.col("b__size")) | ((F.col("a__size") == F.col("b__size")) & (F.col("a__k") < F.col("b__k")))
    met = one.join(two, keys).filter(ordered & (F.col("a__label") != F.col("b__label")) & _possible("a", "b", percent))
    return met.select(F.least("a__k", "b__k").alias("__a"), F.greatest("a__k", "b__k").alias("__b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``__a, __b``) of documents whose whole sets are similar enough, as classes."""
    left = sets.select(F.col("__k").alias("__a"), F.col("__class").alias("__class_a"), F.col("__set").alias("__set_a"))
    right = sets.select(F.col("__k").alias("__b"), F.col("__class").alias("__class_b"), F.col("__set").alias("__set_b"))
    met = pairs.join(left, "__a").join(right, "__b")
    a, b = F.slice("__set_a", 1, K), F.slice("__set_b", 1, K)
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, K)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    likely = common * K >= F.size(union) * SHARED
    both = F.size(F.array_intersect("__set_a", "__set_b"))
    similar = 100 * both >= percent * (F.size("__set_a") + F.size("__set_b") - both)
    return met.filter(F.when(likely, similar).otherwise(False)).select("__class_a", "__class_b")


def components(nodes: DataFrame, links: DataFrame, name: str = "labels") -> DataFrame:
    """``__class, __id, __label`` for stored nodes ``__class, __id`` (unique): the least id that links reach."""
    ways = stored(links.select("__class_a", "__class_b").union(links.select("__class_b", "__class_a")).distinct(), f"{name}-links")
    labels = nodes.withColumn("__label", F.col("__id"))
    step = 0
    while True:
        offered = ways.join(labels.select(F.col("__class").alias("__class_b"), "__label"), "__class_b")
        offered = offered.groupBy(F.col("__class_a").alias("__class")).agg(F.min("__label").alias("__offered"))
        lower = labels.join(offered, "__class", "left").withColumn("__new", F.least("__label", F.coalesce("__offered", "__label")))
        lower = stored(lower.select("__class", "__id", "__label", "__new"), f"{name}-{step}")
        # A label names a document; follow that document's own label.
        onward = lower.filter("__new < __id").groupBy(F.col("__id").alias("__new")).agg(F.min("__new").alias("__onward"))
        moved = lower.join(onward, "__new", "left")
        moved = moved.select("__class", "__id", F.least("__new", F.coalesce("__onward", "__new")).alias("__label"), (F.col("__new") < F.col("__label")).alias("__changed"))
        moved = stored(moved, f"{name}-{step}-onward")
        labels = moved.drop("__changed")
        if moved.filter("__changed").isEmpty():
            return labels
        step += 1


def link(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row ``__key, __th, n_shingles, __label, __k, __group``.

    ``__label`` is the least id of its component (``LAST`` for none), ``__k`` its class and ``__group`` the class that has this id and names the component.
    """
    if percent < 80:
        raise ValueError("the sketches are sized for a similarity of 0.8 or more")
    rows = stored(sketches(df, key, text, words), "sketches")
    classes = rows.filter("n_shingles > 0").groupBy("__class").agg(F.min(F.struct("__key", "__th")).alias("__first"), F.count("*").alias("__rows"))
    classes = stored(classes, "classes")

    # 1. Sketch values.
    firsts = rows.select("__key", "__th", "n_shingles", "__class", "__k", "__sketch").join(
        classes.select("__class", F.col("__first.__key").alias("__key"), F.col("__first.__th").alias("__th")), ["__class", "__key", "__th"]
    )
    values = firsts.select("__k", F.col("n_shingles").cast("int").alias("__size"), F.size("__sketch").alias("__n"), F.explode("__sketch").alias("__value"))
    ranked = _ranked(values, "sketch-values")
    part = F.least(F.ceil(F.col("__size") * percent / 100), F.lit(SHARED_PART_FULL))
    needed = F.when(F.col("__size") <= K, part).otherwise(SHARED)
    first = F.greatest(F.lit(0), F.col("__n") - needed + 1 - (F.col("__n") - F.size("__list")))
    heads = ranked.select("__k", F.explode(F.slice("__list", F.lit(1), first.cast("int"))).alias("__entry")).select("__k", F.col("__entry.__value").alias("__value"))
    again = stored(_met_twice(heads, "sketch-heads").select("__k").distinct(), "candidates")

    # 2. Whole sets of what is left, read from the texts again.
    look = stored(rows.select("__key", "__th", "__class", "__k").join(again, "__k").join(
        classes.select("__class", F.col("__first.__key").alias("__key"), F.col("__first.__th").alias("__th")), ["__class", "__key", "__th"]
    ).distinct(), "look")
    look = F.broadcast(look) if look.count() <= BROADCAST_ROWS else look
    texts = df.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("__key"), F.xxhash64(text).alias("__th"), F.col(text).alias("__text"))
    sets = stored(whole_sets(texts.join(look, ["__key", "__th"]), "__text", words), "sets")
    size = F.size("__set")
    ranked = _ranked(sets.select("__k", size.alias("__n"), size.alias("__size"), F.explode("__set").alias("__value")), "set-values")
    alone = F.col("__n") - F.size("__list")
    prefix = F.col("__n") - F.ceil(F.col("__n") * percent / 100) + 1
    heads = ranked.withColumns({"__alone": alone, "__typical": F.size("__list") / F.col("__n")}).select(
        "__k", "__size", "__alone", "__typical", F.posexplode(F.slice("__list", F.lit(1), F.greatest(F.lit(0), prefix - alone).cast("int"))).alias("__at", "__entry")
    )
    heads = heads.select("__k", "__size", "__typical", (F.col("__alone") + F.col("__at")).alias("__rank"), F.col("__entry.__value").alias("__value"))
    lists = stored(_met_twice(heads, "set-heads"), "lists")

    # 3. Everyone meets the most typical member of each list.
    typical = F.struct("__typical", F.col("__k").alias("p__k"), F.col("__size").alias("p__size"), F.col("__rank").alias("p__rank"))
    pivots = stored(lists.groupBy("__value").agg(F.max(typical).alias("__pivot"), F.count("*").alias("__count")), "pivots")
    met = join_counted(lists.select("__value", "__k", "__size", "__rank"), pivots, ["__value"], "__count", ["__k"], "inner")
    met = met.select(*[F.col(c).alias(f"l{c}") for c in ("__k", "__size", "__rank")], "__pivot.p__k", "__pivot.p__size", "__pivot.p__rank")
    met = met.filter((F.col("l__k") != F.col("p__k")) & _possible("l", "p", percent))
    tried = stored(met.select(F.least("l__k", "p__k").alias("__a"), F.greatest("l__k", "p__k").alias("__b")).distinct(), "tried")
    links = stored(_linked(tried, sets, percent), "links")
    nodes = sets.select("__class", "__k").distinct().join(classes.select("__class", F.col("__first.__key").alias("__key")), "__class")
    nodes = nodes.select("__class", F.struct("__key", "__k").alias("__id"))
    nodes = stored(nodes, "nodes")
    labels = components(nodes, links, "first-labels")

    # 4. Pairs of different components that could still be linked.
    names = stored(sets.select("__k", "__class").distinct().join(labels, "__class").select("__k", F.col("__label.__k").alias("__label")), "names")
    named = lists.select("__value", "__k", "__size", "__rank").join(names, "__k")
    mixed = stored(named, "named")
    several = mixed.groupBy("__value").agg(F.min("__label").alias("__low"), F.max("__label").alias("__high"), F.count("*").alias("__count")).filter("__low < __high")
    mixed = stored(join_counted(mixed, stored(several.drop("__low", "__high"), "several"), ["__value"], "__count", ["__k"], "inner"), "mixed")
    rest = _pairs(mixed, percent).join(tried, ["__a", "__b"], "left_anti")
    more = stored(_linked(stored(rest, "rest"), sets, percent), "more-links")
    if not more.isEmpty():
        labels = components(nodes, links.union(more), "labels")

    known = classes.select("__class", "__rows", F.col("__first.__key").alias("__id")).join(labels.select("__class", "__label"), "__class", "left")
    known = stored(known.select("__class", "__rows", F.coalesce("__label.__key", "__id").alias("__label"), F.col("__label.__k").alias("__group")), "known")
    found = join_counted(rows.select("__key", "__th", "n_shingles", "__class", "__k"), known, ["__class"], "__rows", ["__key", "__th"])
    return found.select("__key", "__th", "n_shingles", F.coalesce("__label", "__key").alias("__label"), "__k", F.coalesce("__group", "__k").alias("__group"))


def mark(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row ``key, n_shingles, component_id, kept``."""
    found = link(df, key, text, words, percent)
    none = F.lit(LAST)
    return found.select(
        F.nullif("__key", none).alias(key), "n_shingles", F.nullif("__label", none).alias("component_id"), (F.col("__key") == F.col("__label")).alias("kept")
    )


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` whose id is the least of their component, one for each; blank texts all stay."""
    with scratch(df.sparkSession):
        found = link(df, key, text, words, percent).filter((F.col("__key") == F.col("__label")) & (F.col("__k") == F.col("__group")))
        kept = found.filter("n_shingles > 0").groupBy("__group").agg(F.min(F.struct("__key", "__th")).alias("__one"))
        kept = stored(kept.select("__one.*"), "kept", keep=True)
    marked = df.withColumns({"__key": F.coalesce(F.col(key).cast("long"), F.lit(LAST)), "__th": F.xxhash64(text), "__blank": ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")})
    chosen = marked.filter(~F.col("__blank")).join(kept, ["__key", "__th"])
    turn = F.row_number().over(Window.partitionBy("__key", "__th").orderBy(F.lit(0)))
    chosen = chosen.withColumn("__turn", turn).filter("__turn = 1").select(*df.columns)
    return chosen.unionByName(marked.filter("__blank").select(*df.columns))
