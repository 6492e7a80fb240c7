"""Collocations: phrases whose parts meet more often than their counts explain.

Counts are kept as sorted streams, in the way external-memory language-model estimation
keeps them: one stream of all frequent phrases in prefix order, one in suffix order.

1. *Counting.*  A phrase counts only if it occurs ``least`` times, and then so do all its
   parts.  So words are counted first, then pairs of frequent words, then longer phrases
   whose pairs are all frequent.  Pairs and longer phrases are nearly all rare, so they are first counted
   by a hash of ``KEY_BITS`` bits: a task sends each key of ``HELD_KEYS`` occurrences once, as the step from the key
   before, in few bytes, to ranges of keys; no phrase's rows meet in one task.  What is frequent is told to the next
   pass by a bit table of a fixed size.  The last pass counts the phrases by their words, only where the tables say so:
   two phrases on one key or bit only mean that more is counted than needed, never less.
2. *Prefix order.*  Sorted by their words, a phrase comes behind all its beginnings: a stack
   of at most ``LONGEST`` entries has the counts of all left parts, and a phrase that is as
   frequent as its beginning covers it.
3. *Suffix order.*  Sorted by their words from the last to the first, the same gives the
   counts of all right parts, and covered endings.
4. *Lockstep.*  Both streams have each candidate once and are merge-joined; covered ones go.

A stream is cut into ranges of about ``STREAM_ROWS`` phrases by sampled keys.  Only beginnings
of a range's first key lie in earlier ranges: at most ``LONGEST - 1`` counts per range, which
all tasks get.  Ranges split whatever many phrases begin with the same word.

Scores are integers of exact decimal arithmetic.

Defined results: a null text has no words; a null language is ``und``; the same row twice
counts twice; ids are not looked at; ties are broken by count and phrase; an empty table gives
an empty result; only the two named columns are read, so other columns cannot clash.  A long
text is taken in chunks whose last words lead the next, so memory does not grow with it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from changelake.llm.common import chunks, salt_of, stored
from changelake.llm.shipping import ship
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
BLOCK_TOKENS = 2_000_000
FLUSH_WORDS = 400_000  # distinct words that a task holds before it sends their counts on
HELD_KEYS = 4_000_000  # occurrences that a task holds before it sends their counts on
RANGE_KEYS = 2_000_000  # occurrences per range of keys
KEY_BITS = 40
WORD_BITS = 25  # the tables have 2^25 bits = 4 MB and, for pairs and for longer phrases, 2^26 bits = 8 MB
PHRASE_BITS = 26
STREAM_ROWS = 20_000
MOST_RANGES = 2_000
SALTS = 32

# Only A-Z are lower-cased; piece ends become full stops and tabs become spaces.
_BREAK = b"."
_MAPPED = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_LEFT, _RIGHT, _MIX = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))  # multipliers of a phrase's key


def _tokens(text: str) -> Iterator[list[bytes]]:
    """Words and breaks of a text, a chunk at a time."""
    for chunk in chunks(text.encode("utf-8", "replace").translate(_MAPPED)):
        yield chunk.replace(_BREAK, b" . ").split()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """``language, tokens, lead`` of about ``BLOCK_TOKENS``; texts are parted by breaks.

    ``lead`` marks words that only lead in: they were the last ones of a text's chunk before.
    """
    held: dict[str, list[bytes]] = {}
    leads: dict[str, list[int]] = {}
    size = 0

    def out() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, tokens in held.items():
            lead = np.zeros(len(tokens), bool)
            lead[leads[lang]] = True
            yield lang, tokens, lead
        held.clear()
        leads.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            last: list[bytes] = []
            for found in _tokens(text or ""):
                tokens, lead = held.setdefault(lang, []), leads.setdefault(lang, [])
                tokens.append(_BREAK)
                lead += range(len(tokens), len(tokens) + len(last))
                tokens += last
                tokens += found
                size += len(found)
                last = (last + found)[1 - LONGEST :]
                if size >= BLOCK_TOKENS:
                    yield from out()
                    size = 0
    yield from out()


def _counts(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, list[bytes], object]]], least: int) -> DataFrame:
    """``lang, phrase, f`` of what ``count`` yields per block, from ``least`` on; a null phrase holds all words and always stays."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, phrases, times in count(batches):
            if len(phrases):
                columns = [pa.array([lang]).take(pa.array(np.zeros(len(phrases), np.int32))), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "c"])

    counted = df.mapInArrow(run, "lang string, phrase string, c long").groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
    return counted.filter((F.col("f") >= least) | F.col("phrase").isNull())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list, list]]:
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for found in _tokens(text or ""):
                held.setdefault(lang, Counter()).update(found)
        if sum(map(len, held.values())) > FLUSH_WORDS:
            yield from _flushed(held)
    yield from _flushed(held)


def _flushed(held: dict[str, Counter]) -> Iterator[tuple[str, list, list]]:
    for lang, counter in held.items():
        counter.pop(_BREAK, None)
        yield lang, [None, *counter], [counter.total(), *counter.values()]
    held.clear()


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    start = zlib.crc32(f"{lang}\n".encode())
    return np.fromiter((zlib.crc32(w, start) for w in words), np.int64, len(words))


def _has(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _numbered(lang: str, tokens: list[bytes], table: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block, each token's number among them, whether it is frequent, and the words' hashes."""
    words = list(set(tokens))
    number = {w: i for i, w in enumerate(words)}
    at = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    hashes = _word_hashes(lang, words)
    frequent = _has(table, hashes & ((1 << WORD_BITS) - 1))
    if _BREAK in number:
        frequent[number[_BREAK]] = False
    return words, at, frequent[at], hashes


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number per key, and count of each distinct key."""
    _, first, number, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, number, times


def _joined(begun: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their beginnings and last words."""
    return begun * _LEFT + last * _RIGHT


def _keys(hashes: np.ndarray) -> np.ndarray:
    """``KEY_BITS`` well mixed bits of phrases' hashes."""
    return (((hashes ^ hashes >> np.uint64(32)) * _MIX) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def _bit(keys: np.ndarray) -> np.ndarray:
    return keys & ((1 << PHRASE_BITS) - 1)


def _pairs(frequent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair of frequent words ends, and its hash."""
    ends = np.flatnonzero(frequent[1:] & frequent[:-1]) + 1
    return ends, _joined(word[ends - 1], word[ends])


def _pair_keys(word_table) -> Callable:
    """Keys of the pairs of frequent words, an array per block."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for lang, tokens, lead in _blocks(batches):
            _, at, frequent, hashes = _numbered(lang, tokens, word_table.value)
            ends, pair = _pairs(frequent, hashes.astype(np.uint64)[at])
            yield _keys(pair[~lead[ends]])

    return keys


def _longer_keys(word_table, pair_table) -> Callable:
    """Keys of the phrases of three words and more whose pairs are all frequent, an array per block and length."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for lang, tokens, lead in _blocks(batches):
            _, at, frequent, hashes = _numbered(lang, tokens, word_table.value)
            word = hashes.astype(np.uint64)[at]
            ends, found = _pairs(frequent, word)
            kept = _has(pair_table.value, _bit(_keys(found)))
            ends, found = ends[kept], found[kept]
            for _ in range(3, LONGEST + 1):
                # A shorter phrase ends at the word before this end, too.
                next_ = np.flatnonzero(np.diff(ends) == 1) + 1
                ends, found = ends[next_], _joined(found[next_ - 1], word[ends[next_]])
                yield _keys(found[~lead[ends]])

    return keys


def _phrase_counter(word_table, pair_table, longer_table) -> Callable:
    """Phrases of two words and more that the tables have, by their words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, tokens, lead in _blocks(batches):
            words, at, frequent, hashes = _numbered(lang, tokens, word_table.value)
            word = hashes.astype(np.uint64)[at]
            ends, found = _pairs(frequent, word)
            begun = at[ends - 1]  # number of the phrase's beginning
            for n in range(2, LONGEST + 1):
                kept = _has((pair_table if n == 2 else longer_table).value, _bit(_keys(found)))
                ends, found = ends[kept], found[kept]
                _, number, _ = _distinct(begun[kept] << 32 | at[ends])
                new = np.flatnonzero(~lead[ends])
                first, _, times = _distinct(number[new])
                rows = at[ends[new[first]][:, None] + np.arange(1 - n, 1)].tolist()
                yield lang, [b" ".join([words[i] for i in row]) for row in rows], times
                next_ = np.flatnonzero(np.diff(ends) == 1) + 1
                begun = number[next_ - 1]
                ends, found = ends[next_], _joined(found[next_ - 1], word[ends[next_]])

    return count


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers, each in as many bytes as the largest needs."""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widened(data: bytes, number: int) -> np.ndarray:
    values = np.zeros((number, 8), np.uint8)
    values[:, : len(data) // number] = np.frombuffer(data, np.uint8).reshape(number, -1)
    return values.view("<u8").ravel().astype(np.int64)


def _range_starts(ranges: int) -> np.ndarray:
    return np.array([(i << KEY_BITS) // ranges for i in range(ranges)], np.int64)


def _sent(keys: np.ndarray, ranges: int, least: int) -> pa.RecordBatch:
    """``range, number, steps, times``: the distinct keys and how often each occurs, at most ``least``, one row per range."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.minimum(np.diff(first, append=len(keys)), least)
    keys, starts = keys[first], _range_starts(ranges)
    cuts = np.append(np.searchsorted(keys, starts), len(keys)).tolist()
    rows = [
        (i, to - at, _narrow(np.diff(keys[at:to], prepend=starts[i])), _narrow(times[at:to])) for i, (at, to) in enumerate(zip(cuts, cuts[1:])) if to > at
    ]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], ["range", "number", "steps", "times"])


def _frequent(sent: pa.Table, ranges: int, least: int) -> pa.Table:
    """``__h``: the keys of one range that occur ``least`` times in all."""
    start = _range_starts(ranges)[sent.column("range")[0].as_py()]
    numbers, steps, times = (sent.column(c).to_pylist() for c in ("number", "steps", "times"))
    keys = np.concatenate([np.cumsum(_widened(s, m)) for s, m in zip(steps, numbers)]) + start
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    total = np.add.reduceat(np.concatenate([_widened(t, m) for t, m in zip(times, numbers)])[order], first)
    return pa.table({"__h": pa.array(keys[first[total >= least]], pa.int64())})


def _frequent_keys(df: DataFrame, keys: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], occurrences: int, least: int) -> DataFrame:
    """``__h``: keys that occur ``least`` times, counted by ranges of about ``RANGE_KEYS`` of at most ``occurrences``."""
    ship(df.sparkSession)
    ranges, most = max(1, -(-occurrences // RANGE_KEYS)), HELD_KEYS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for found in keys(batches):
            held.append(found)
            if sum(map(len, held)) >= most:
                yield _sent(np.concatenate(held), ranges, least)
                held.clear()
        if any(map(len, held)):
            yield _sent(np.concatenate(held), ranges, least)

    sent = df.mapInArrow(run, "range int, number int, steps binary, times binary")
    return sent.groupBy("range").applyInArrow(lambda table: _frequent(table, ranges, least), "__h long")


def _table(hashes: DataFrame, bits: int):
    """Broadcast bit table of ``2^bits`` bits with the bits ``__h`` set; at most ``2^(bits - 6)`` rows reach the driver."""
    at = F.col("__h").bitwiseAND(F.lit((1 << bits) - 1))
    cells = hashes.select(F.shiftright(at, 6).cast("int").alias("cell"), F.expr("shiftleft(1L, cast(__h & 63 as int))").alias("bit"))
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def _hash_of(word: Column) -> Column:
    return F.crc32(F.concat(F.col("lang"), F.lit("\n"), word).cast("binary"))


def phrase_counts(df: DataFrame, text: str = "text", lang: str | None = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, words, f`` of all phrases up to ``LONGEST`` words that occur ``least`` times, and ``lang, n``: all words; both stored."""
    name = F.lit(UNKNOWN) if lang is None else F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))
    docs = df.select(name.alias("lang"), F.col(text).cast("string").alias("text"))
    words = stored(_counts(docs, _count_words, least), "phrase-words")
    totals = stored(words.filter("phrase is null").select("lang", F.col("f").alias("n")), "phrase-totals")
    words = words.filter("phrase is not null")
    word_table = _table(words.select(_hash_of(F.col("phrase")).alias("__h")), WORD_BITS)
    number = totals.agg(F.sum("n")).first()[0] or 0
    pair_table = _table(_frequent_keys(docs, _pair_keys(word_table), number, least), PHRASE_BITS)
    longer = _longer_keys(word_table, pair_table)
    longer_table = _table(_frequent_keys(docs, longer, (LONGEST - 2) * number, least), PHRASE_BITS)
    phrases = _counts(docs, _phrase_counter(word_table, pair_table, longer_table), least)
    found = words.unionByName(phrases).select("lang", F.split("phrase", " ").alias("words"), "f")
    return stored(found, "phrases"), totals


def _stream(phrases: DataFrame, backwards: bool) -> DataFrame:
    """``lang, phrase, f, parts, covers`` for phrases of two words and more, from one sorted stream; stored.

    ``parts`` are the counts of its beginnings (endings, if ``backwards``), short to long;
    ``covers`` is the longest of them if it occurs only inside this phrase.
    """
    spark = phrases.sparkSession
    turned = F.reverse("words") if backwards else F.col("words")
    rows = phrases.select("lang", turned.alias("words"), "f")
    count = rows.count()
    ranges = max(1, min(MOST_RANGES, -(-count // STREAM_ROWS)))
    bounds: list[tuple[str, ...]] = []
    carried: dict[tuple[str, ...], int] = {}
    if ranges > 1:
        sample = rows.sample(fraction=min(1.0, 40 * ranges / count), seed=1).select("lang", "words").collect()
        keys = sorted(_key(r["lang"], r["words"]) for r in sample)
        bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})
        begun = sorted({b[:k] for b in bounds for k in range(2, len(b))})
        if begun:
            wanted = spark.createDataFrame([(b[0].decode(), [w.decode() for w in b[1:]]) for b in begun], "lang string, words array<string>")
            carried = {_key(r["lang"], r["words"]): r["f"] for r in rows.join(F.broadcast(wanted), ["lang", "words"]).collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = [bisect_right(bounds, _key(a, b)) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], ["lang", "words", "f", "range"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[tuple[bytes, ...], int]] = []
        for batch in batches:
            out: list[tuple] = []
            for lang, words, f in zip(*(batch.column(i).to_pylist() for i in range(3))):
                key = _key(lang, words)
                while stack and key[: len(stack[-1][0])] != stack[-1][0]:
                    stack.pop()
                known = dict(stack)
                parts = [known[b] if (b := key[:k]) in known else carried[b] for k in range(2, len(key))]
                stack.append((key, f))
                if parts:
                    said = words[::-1] if backwards else words
                    covered = (said[1:] if backwards else said[:-1]) if len(words) > 2 and parts[-1] == f else None
                    out.append((lang, " ".join(said), f, parts, " ".join(covered) if covered else None))
            types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.string()]
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["lang", "phrase", "f", "parts", "covers"])

    dealt = rows.mapInArrow(deal, "lang string, words array<string>, f long, range int")
    dealt = dealt.repartition(ranges, "range").sortWithinPartitions("range", "lang", "words")
    found = dealt.mapInArrow(run, "lang string, phrase string, f long, parts array<long>, covers string")
    return stored(found, "suffix-stream" if backwards else "prefix-stream")


def _key(lang: str, words: list[str]) -> tuple[bytes, ...]:
    """Sorts like Spark sorts language and words."""
    return (lang.encode(), *[w.encode() for w in words])


def candidates(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of phrases of two words and more that no longer one covers."""
    left, right = _stream(phrases, False), _stream(phrases, True)
    covered = left.select("lang", F.col("covers").alias("phrase")).union(right.select("lang", F.col("covers").alias("phrase"))).filter("phrase is not null")
    met = left.select("lang", "phrase", F.col("f").alias("a"), F.col("parts").alias("lefts")).join(
        right.select("lang", "phrase", F.col("parts").alias("rights")).hint("merge"), ["lang", "phrase"]
    )
    open_ = met.join(covered.hint("merge"), ["lang", "phrase"], "left_anti").join(totals, "lang")
    whole = lambda c: c.cast("decimal(19,0)")
    cuts = F.transform(
        F.arrays_zip(F.col("lefts").alias("l"), F.reverse("rights").alias("r")), lambda cut, k: F.struct(cut["l"].alias("l"), cut["r"].alias("r"), k.alias("k"))
    )
    cut = open_.withColumn("__cut", F.explode(cuts)).select("lang", "phrase", "a", "n", "__cut.*")
    product = whole(F.col("l")) * whole(F.col("r"))
    score = F.call_function("div", whole(F.col("a")) * whole(F.col("n")) * F.lit(1000).cast("decimal(4,0)"), product)
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("__least")
    return cut.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "__least.l", "__least.r", "n", "__least.score")


def top(found: DataFrame, limit: int = TOP) -> DataFrame:
    """The first ``limit`` of each language with their ``rank``: first per salt, then of what these left."""
    from pyspark.sql import Window

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("__salt", salt_of(SALTS, "phrase"))
    few = salted.withColumn("__at", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("__at") <= limit)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= limit)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(df: DataFrame, text: str = "text", lang: str | None = "lang", least: int = LEAST, limit: int = TOP) -> DataFrame:
    """Each language's best collocations: ``lang, rank, phrase, a, l, r, n, score``."""
    return top(candidates(*phrase_counts(df, text, lang, least)), limit)
