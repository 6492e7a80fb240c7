"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes with symbol counts, learnt
from the training texts and then fixed.  A symbol is coded in the longest context that
is known; if it was never seen there, an escape is coded (method C: it weighs as much
as the context has distinct symbols) and the next shorter context follows, without the
symbols that the longer one already offered.  Below the empty context all remaining
symbols are equally likely.  A text ends in an end symbol, so its probability is that
of one text among all texts.

The trie is gathered from all training bytes by a distributed count of symbols with
their contexts, and no branch is left out of it.  The branches that share the nearest
``NEAR`` bytes of their context make a part of the trie; with the shorter orders, which
the bytes' number bounds and all tasks hold, a part tells the code length of any symbol
in its contexts.  Code lengths of (context, symbol) numbers that make up more than one
``KEY_SHARE``-th of the training symbols (fewer than ``KEY_SHARE``) go to all tasks; all
others are computed once each, where their part lies, and meet the texts in a join.

The word baseline counts all training tokens.  Tokens above one ``TOKEN_SHARE``-th of
them (fewer than ``TOKEN_SHARE``) go to all tasks; all others meet their counts in a
join, so no token is left out.

Defined results: a null text counts as empty and is the end symbol alone; with no
training text every symbol has probability 1/256; every row is scored on its own,
however often its id recurs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from changelake.llm.common import join_counted, stored
from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 5
NEAR = 3
KEY_SHARE = 4_000_000  # decides only which code lengths travel by broadcast
TOKEN_SHARE = 500_000
START, END = 0xFE, 0xFF  # bytes that UTF-8 never holds
SYMBOLS = 256
BLOCK_BYTES = 2 << 20
BLOCK_TEXTS = 50_000  # below 2^16
SORTED_AT_ONCE = 1 << 16
PART_ROWS = 500_000  # parts of the trie are taken together up to so many rows
_PAD = bytes([START]) * 8


def blocks(texts: list[str]) -> Iterator[tuple[int, int, bytes]]:
    """Runs of texts of about ``BLOCK_BYTES``, ``BLOCK_TEXTS`` at most: first, last + 1, and their padded bytes."""
    parts, size, first = [], 0, 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "replace")
        parts += [_PAD, data, bytes([END])]
        size += len(data)
        if size >= BLOCK_BYTES or i + 1 - first == BLOCK_TEXTS or i == len(texts) - 1:
            yield first, i + 1, b"".join(parts)
            parts, size, first = [], 0, i + 1


def symbols(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with its context, as a number: symbol, nearest byte, ..., farthest.

    Also tells which symbols end a text.  Both run from the last symbol to the first.
    """
    back = np.frombuffer(data, dtype=np.uint8)[::-1]
    back = np.ascontiguousarray(np.concatenate([back, np.full(8, START, np.uint8)]))
    n = len(data)
    keys = np.ndarray((n,), dtype=">u8", buffer=back.data, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - ORDER))
    real = back[:n] != START
    return keys[real], back[:n][real] == END


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers start."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)


class Trie:
    """Branches per order, as sorted arrays; code lengths of (context, symbol) numbers."""

    def __init__(self, branches: list[tuple[np.ndarray, np.ndarray]]):
        """``branches[k]``: sorted numbers of order ``k`` and their counts."""
        self.keys = [k for k, _ in branches]
        self.counts = [c.astype(np.float64) for _, c in branches]
        self.nodes, self.totals, self.kinds, self.covered = [], [], [], []
        for k, (keys, counts) in enumerate(branches):
            context = keys & np.uint64((1 << 8 * k) - 1)
            order = np.argsort(context, kind="stable")
            starts = _runs(context[order])
            add = lambda x: np.add.reduceat(x[order], starts) if len(starts) else np.empty(0)  # noqa: B023, E731
            self.nodes.append(context[order][starts])
            self.totals.append(add(counts.astype(np.float64)))
            self.kinds.append(add(np.ones(len(keys))))
            # What a context's symbols count in the next shorter one.
            if k and len(keys):
                shorter = self.counts[k - 1][np.searchsorted(self.keys[k - 1], keys >> np.uint64(8))]
                self.covered.append(add(shorter))
            else:
                self.covered.append(np.zeros(len(starts)))

    def log_probabilities(self, wanted: np.ndarray) -> np.ndarray:
        """Natural logarithms for sorted numbers of order ``ORDER``."""
        out = np.zeros(len(wanted))
        open_ = np.arange(len(wanted))
        mass, kinds = np.zeros(len(wanted)), np.zeros(len(wanted))  # excluded so far
        context = wanted & np.uint64((1 << 8 * ORDER) - 1)
        for k in range(ORDER, -1, -1):
            if not len(self.nodes[k]) or not len(open_):
                continue
            cut = np.uint64(8 * (ORDER - k))
            node, known = _find(self.nodes[k], context[open_] >> cut)
            at, node = open_[known], node[known]
            total, left = self.totals[k][node] - mass[at], self.kinds[k][node] - kinds[at]
            branch, hit = _find(self.keys[k], wanted[at] >> cut)
            scale = np.log(np.maximum(total + left, 1e-300))
            gain = np.zeros(len(at))
            gain[hit] = np.log(self.counts[k][branch[hit]]) - scale[hit]
            escape = ~hit & (left > 0)
            gain[escape] = np.log(left[escape]) - scale[escape]
            out[at] += gain
            mass[at], kinds[at] = self.covered[k][node], self.kinds[k][node]
            done = np.zeros(len(wanted), dtype=bool)
            done[at[hit]] = True
            open_ = open_[~done[open_]]
        out[open_] -= np.log(np.maximum(SYMBOLS - kinds[open_], 1))
        return out


def _find(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return at, ordered[at] == wanted


def _orders(keys: np.ndarray, times: np.ndarray, high: int, low: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Branches of the orders ``low`` to ``high`` from those of order ``high``, whose farthest bytes are forgotten."""
    order = np.argsort(keys)
    out = [(keys[order], times[order])]
    for _ in range(high - low):
        keys, times = out[-1][0] >> np.uint64(8), out[-1][1]
        first = _runs(keys)
        out.append((keys[first], np.add.reduceat(times, first) if len(first) else times))
    return out[::-1]


def _numbers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows["key"].to_numpy().astype(np.uint64), rows["times"].to_numpy()


def count_contexts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``key long, times long``: every symbol with its context in all texts; stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data in blocks([t or "" for t in batch.column(0).to_pylist()]):
                keys, times = np.unique(symbols(data)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(times)], ["key", "times"])

    ship(texts.sparkSession)
    counted = texts.select(text).mapInArrow(count, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))
    return stored(counted, "contexts")


def fit(texts: DataFrame, text: str = "text") -> Trie:
    """The whole trie in this process, for few texts; ``score`` leaves it in its parts."""
    return Trie(_orders(*_numbers(count_contexts(texts, text).toArrow()), ORDER, 0))


def code_lengths(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, times, gain`` for ``wanted`` (``key, times``): base-10 log probabilities by the trie of ``counted``."""
    spark = counted.sparkSession
    near = counted.groupBy(F.shiftrightunsigned("key", 8 * (ORDER - NEAR + 1)).alias("key")).agg(F.sum("times").alias("times"))
    low = spark.sparkContext.broadcast(_orders(*_numbers(near.toArrow()), NEAR - 1, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: pa.Table) -> pa.RecordBatch:
            keys, times = _numbers(rows)
            asked = rows["asked"].to_numpy(zero_copy_only=False)
            trie = Trie([*low.value, *_orders(keys[~asked], times[~asked], ORDER, NEAR)])
            order = np.argsort(keys[asked])
            keys, times = keys[asked][order], times[asked][order]
            gains = trie.log_probabilities(keys) / math.log(10)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(times), pa.array(gains)], ["key", "times", "gain"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < PART_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            part = rows["part"].to_numpy()
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1  # the last part may go on in the next batch
            if len(cuts):
                yield out(rows.slice(0, int(cuts[-1])))
                held = rows.slice(int(cuts[-1])).to_batches()
        if held:
            yield out(pa.Table.from_batches(held))

    both = counted.select("key", "times", F.lit(False).alias("asked")).union(wanted.select("key", "times", F.lit(True)))
    part = F.shiftrightunsigned("key", 8 * (ORDER - NEAR)).bitwiseAND((1 << 8 * NEAR) - 1)
    dealt = both.withColumn("part", part).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "key long, times long, gain double")


def _lengths_of(data: bytes, texts: int, keys: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Per text of a block the sum over known ``keys`` (sorted), and the others with their times."""
    wanted, ends = symbols(data)
    owner = texts - np.cumsum(ends)  # from the last text to the first
    gain = np.zeros(len(wanted))
    unknown = [np.empty(0, np.int64)]
    for at in range(0, len(wanted), SORTED_AT_ONCE):
        some = wanted[at : at + SORTED_AT_ONCE]
        # A number has 48 bits and its place 16, so both are sorted as one.
        both = np.sort(some << np.uint64(16) | np.arange(len(some), dtype=np.uint64))
        key, place = both >> np.uint64(16), at + (both & np.uint64(0xFFFF)).astype(np.int64)
        first = _runs(key)
        times = np.diff(np.append(first, len(key)))
        where, known = _find(keys, key[first]) if len(keys) else (None, np.zeros(len(first), bool))
        if known.any():
            gain[place] = np.repeat(np.where(known, gains[where], 0.0), times)
        unknown.append(place[np.repeat(~known, times)])
    sums = np.bincount(owner, weights=gain, minlength=texts)
    open_ = np.concatenate(unknown)
    pairs, times = np.unique(owner[open_].astype(np.uint64) << np.uint64(48) | wanted[open_], return_counts=True)
    offsets = np.searchsorted(pairs, np.arange(texts + 1).astype(np.uint64) << np.uint64(48)).astype(np.int32)
    key = pairs & np.uint64((1 << 48) - 1)
    others = pa.StructArray.from_arrays([pa.array(key.astype(np.int64)), pa.array(times.astype(np.int64))], ["key", "n"])
    return sums, pa.ListArray.from_arrays(pa.array(offsets), others)


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A to Z only)."""
    return text.encode("utf-8", "replace").lower().split()


def count_tokens(texts: DataFrame, text: str = "text") -> DataFrame:
    """``token binary, times long`` over all texts; the empty token is the end of a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            for t in batch.column(0).to_pylist():
                found.update(tokens(t or ""))
                found[b""] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["token", "times"])

    ship(texts.sparkSession)
    return texts.select(text).mapInArrow(count, "token binary, times long").groupBy("token").agg(F.sum("times").alias("times"))


def score(docs: DataFrame, training: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    contexts = count_contexts(training, text)
    seen_symbols = contexts.agg(F.sum("times")).first()[0] or 0
    frequent = code_lengths(contexts, contexts.filter(F.col("times") * KEY_SHARE > seen_symbols)).select("key", "gain").toArrow()
    frequent_keys = frequent["key"].to_numpy().astype(np.uint64)
    order = np.argsort(frequent_keys)
    frequent_keys, frequent_gains = frequent_keys[order], frequent["gain"].to_numpy()[order]
    counts = stored(count_tokens(training, text), "tokens")
    size = counts.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count("*")).first()
    all_tokens, kinds = int(size[0]), int(size[1])
    scale = all_tokens + 0.1 * (kinds + 1)
    common = counts.filter(F.col("times") * TOKEN_SHARE > all_tokens).toArrow()
    known = {t: math.log10((c + 0.1) / scale) for t, c in zip(common["token"].to_pylist(), common["times"].to_pylist())}
    shared = spark.sparkContext.broadcast((frequent_keys, frequent_gains, known))
    kept = [c for c in docs.columns if c not in (text, "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    made = "__row long, n_tokens long, n_known long, base_score double, score double, __rare array<struct<token:binary,n:long>>, __open array<struct<key:long,n:long>>"
    rare_type = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        frequent_keys, frequent_gains, known = shared.value
        row = TaskContext.get().partitionId() << 40  # fixed once the result is stored
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            for first, last, data in blocks(texts):
                part = texts[first:last]
                sizes, seen, base, rare = [], [], [], []
                for t in part:
                    found = tokens(t)
                    found.append(b"")
                    logs = list(map(known.get, found))
                    others = Counter(w for w, x in zip(found, logs) if x is None) if None in logs else {}
                    sizes.append(len(found))
                    seen.append(len(found) - sum(others.values()))
                    base.append(math.fsum(x for x in logs if x is not None))
                    rare.append([{"token": w, "n": n} for w, n in others.items()])
                sums, others = _lengths_of(data, len(part), frequent_keys, frequent_gains)
                rows = pa.array(np.arange(row, row + len(part)))
                row += len(part)
                columns = [batch.column(c).slice(first, last - first) for c in kept]
                columns += [rows, pa.array(sizes, pa.int64()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(sums), pa.array(rare, rare_type), others]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "__row", "n_tokens", "n_known", "base_score", "score", "__rare", "__open"])

    fields = docs.select(*kept).schema
    for field in spark.createDataFrame([], made).schema.fields:
        fields = fields.add(field)
    scored = stored(docs.mapInArrow(run, fields), "scored")
    rare = scored.select("__row", F.explode("__rare").alias("__r")).select("__row", F.col("__r.token").alias("token"), F.col("__r.n").alias("n"))
    met = rare.join(counts, "token", "left")
    times = F.coalesce(F.col("times"), F.lit(0))
    words = met.select(
        "__row",
        F.when(times > 0, F.col("n")).otherwise(0).alias("__seen"),
        (F.col("n") * F.log10((times + 0.1) / F.lit(scale))).alias("__base"),
        F.lit(0.0).alias("__score"),
    )
    asked = scored.select("__row", F.explode("__open").alias("__o")).select("__row", F.col("__o.key").alias("key"), F.col("__o.n").alias("n"))
    wanted = stored(asked.groupBy("key").agg(F.count("*").alias("times")), "wanted")
    lengths = stored(code_lengths(contexts, wanted), "code-lengths")
    met = join_counted(asked, lengths, ["key"], "times", ["__row"], "inner")
    met = met.select("__row", F.lit(0).cast("long"), F.lit(0.0), F.col("n") * F.col("gain"))
    more = words.union(met).groupBy("__row").agg(*[F.sum(c).alias(c) for c in ("__seen", "__base", "__score")])
    found = scored.drop("__rare", "__open").join(more, "__row", "left")
    return found.select(
        *kept,
        "n_tokens",
        (F.col("n_known") + F.coalesce("__seen", F.lit(0))).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("__base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("__score", F.lit(0.0))).alias("score"),
    )
