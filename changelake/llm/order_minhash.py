"""Document fingerprints by Order MinHash.

A text's k-mers (``K`` code points) get occurrence numbers, so that repeats are
members of their own.  For each of ``SIZE`` orders the ``PICKS`` smallest members are
selected, put back into text order, and their tuple is hashed: the component is equal
in two texts only if they share these k-mers in the same order, which tracks edit
distance where plain MinHash sees a bag.  The likeness of two fingerprints is the
share of equal components.

Defined results: a null text counts as empty; an empty text has a fingerprint of its
own, equal to that of other empty texts; a text shorter than a k-mer is one k-mer.
Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from changelake.llm.common import whole
from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 8
SIZE = 32
PICKS = 2
AT_ONCE = 1 << 21  # hashes of a long text that are held together
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RNG = np.random.default_rng(20190901)
_XOR = _RNG.integers(0, 1 << 32, SIZE, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 32, SIZE, dtype=np.uint32) | np.uint32(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    return x ^ (x >> np.uint64(29))


def _members(text: str) -> np.ndarray:
    """A 32-bit hash of each (k-mer, occurrence number), in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    k = min(K, len(points))
    n = len(points) - k + 1
    grams = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        grams = grams * _M2 + points[j : j + n]
    grams = _mixed(grams)
    # Positions grouped by k-mer: hash in the high bits, position in the low ones.
    low = np.uint64(max(1, int(n).bit_length()))
    packed = np.sort((grams >> low << low) | np.arange(n, dtype=np.uint64))
    heads = packed >> low
    where = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    new = np.empty(n, dtype=bool)
    new[0], new[1:] = True, heads[1:] != heads[:-1]
    index = np.arange(n)
    number = np.empty(n, dtype=np.uint64)
    number[where] = index - np.maximum.accumulate(np.where(new, index, 0))
    return (_mixed(grams + number * _M1) >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str) -> np.ndarray:
    """``SIZE`` components of 32 bits."""
    if not text:
        return np.zeros(SIZE, dtype=np.uint32)
    with np.errstate(over="ignore"):
        members = _members(text)
        n = len(members)
        out = np.empty(SIZE, dtype=np.uint32)
        step = max(1, AT_ONCE // n)
        for at in range(0, SIZE, step):
            ranks = (members[None, :] ^ _XOR[at : at + step, None]) * _MUL[at : at + step, None]
            row = np.arange(len(ranks))
            picked = np.empty((len(ranks), min(PICKS, n)), dtype=np.int64)
            for j in range(picked.shape[1]):
                picked[:, j] = ranks.argmin(axis=1)
                ranks[row, picked[:, j]] = 0xFFFFFFFF
            picked.sort(axis=1)
            tuples = np.full(len(ranks), picked.shape[1], dtype=np.uint64)
            for j in range(picked.shape[1]):
                tuples = _mixed(tuples * _M2 + members[picked[:, j]])
            out[at : at + step] = (tuples >> np.uint64(32)).astype(np.uint32)
    return out


def shown(components: np.ndarray) -> str:
    return components.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with a fingerprint column, eight hex digits per component."""
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shown(fingerprint(t or "")))

    return df.withColumn(name, of(F.col(text)))


def beside_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its edited text and how its fingerprint compares with its neighbour's.

    Rows follow each other by descending key (nulls last; equal keys by text), the
    last one by the first.  Keys are cut into ranges of about equal row counts; a range
    also gets the first row of the next one, so each is a stream in one task.

    Returns ``key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("order"), F.col(key).alias("key"), whole(text).alias("text"))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.stat.approxQuantile("order", [i / wanted for i in range(1, wanted)], 0.2 / wanted) if wanted > 1 else []
    cuts = np.unique(np.array(cuts, dtype=float)) if cuts else np.empty(0)

    @F.pandas_udf("int")
    def range_of(order: pd.Series) -> pd.Series:
        return pd.Series((len(cuts) - np.searchsorted(cuts, order.to_numpy(dtype=float), side="right")).astype(np.int32))

    # One id per range at most: the first of each.
    firsts = rows.select("order", range_of("order").alias("range")).groupBy("range").agg(F.max("order").alias("first")).orderBy("range").collect()
    guest = {r["first"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}
    visit = F.lit(None).cast("int")
    if guest:
        pairs = F.create_map(*[F.lit(x).cast("int" if i % 2 else "long") for i, x in enumerate(v for kv in guest.items() for v in kv)])
        visit = F.when(F.col("order").isin(list(guest)), F.element_at(pairs, F.col("order")))
    places = F.array(F.struct(F.col("range"), F.lit(0).alias("guest")), F.struct(F.col("visit").alias("range"), F.lit(1).alias("guest")))
    own = rows.withColumns({"range": range_of("order"), "visit": visit})
    own = own.select("order", "key", "text", F.explode(F.filter(places, lambda p: p["range"].isNotNull())).alias("place"))
    own = own.select("order", "key", "text", "place.*")
    dealt = own.repartitionById(max(1, len(cuts) + 1), "range").sortWithinPartitions("range", "guest", F.desc("order"), "text")
    schema = "key long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, key, text, fingerprint) that waits for its next row
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for part, visits, key, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if visits and (held is None or held[0] != part):
                    continue  # a further row with the guest's key
                print_ = fingerprint(body)
                if held is not None and held[0] == part:
                    _, old_key, old, old_print = held
                    changed = edited(old, body)
                    changed_print = fingerprint(changed)
                    out.append((old_key, len(old), changed, shown(old_print), shown(changed_print), likeness(old_print, changed_print), likeness(old_print, print_)))
                    size += len(changed)
                held = None if visits else (part, key, body, print_)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [], 0
        yield _batch(out)

    return dealt.select("range", "guest", "key", "text").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["key", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
