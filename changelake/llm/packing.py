"""Best-fit packing of token pieces into sequences, certified by lower bounds.

Pieces are dealt to partitions; each packs its own by best-fit decreasing and
compares its bin count with a lower bound from dual feasible functions: a function
``f`` on sizes such that sizes that fit into one bin keep a sum of at most 1, so
that no packing has fewer bins than the sum of ``f``.  A partition that meets its
bound is done.  The others keep their full bins, and their bins with a gap meet
those of other partitions in a new deal, where best-fit decreasing runs again; the
old bins stay if the new ones are not fewer.  Each deal halves what is left over,
so the last one is small.

A partition holds at most ``PIECES`` pieces on average, whatever the input's size.

Defined results: a null or empty text is the single end id; the same id twice gives
pieces twice, each packed on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from changelake.llm.common import stored
from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECES = 40_000  # mean of a partition
ROUNDS = 4
CACHED_WORDS = 800_000  # per worker
WORDS_AT_ONCE = 20_000
MARKS = b".,;:!?#$%&*"
ROWS_AT_ONCE = 2_000  # new words are learnt together
END = 0

# How CLIP's word tokenizer makes words of a text; ASCII letters in lower case come to its model as they are.
_NORMALIZED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PARTED = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _only_letters(word: bytes) -> bool:
    """Whether a word is letters, and still is after the tokenizer's normalization."""
    if word.isascii():
        return word.isalpha()
    return unicodedata.normalize("NFC", word.decode()).lower().isalpha()


class WordIds:
    """Ids of a tokenizer that never joins text across a space; words recur, so they are kept.

    The tokenizer lower-cases, so words are kept in ASCII lower case.  Words of letters
    only go to the library many at a time: each ends in one word-end id, where the
    answer is cut.  Those of ASCII letters skip the normalization and the splitting of a tokenizer
    known to leave them alone.  Marks after letters are a word of their own.  The words are kept in two
    parts: a full one takes the place of the older, and what is used moves to the newer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = self.plain = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        if made["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZED} and made["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": _PARTED}:
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer, self.plain.pre_tokenizer = None, WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _one_by_one(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, ids in zip(words, found):
            self.words[word] = np.array(ids.ids, dtype="<u4").tobytes()

    def _letters(self, words: list[bytes], tokenizer) -> None:
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            ids = tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids
            ids = np.array(ids, dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                self._one_by_one(some)  # letters that the library does not take for such
                continue
            packed, first = ids.tobytes(), 0
            for word, cut in zip(some, cuts):
                self.words[word] = packed[4 * first : 4 * cut]
                first = cut

    def _learn(self, missing: list[bytes]) -> None:
        letters, tails, marked, others = set(), set(), [], []
        for word in missing:
            stem = word.rstrip(MARKS)
            if not (stem.isalpha() or _only_letters(stem)):
                others.append(word)
            elif len(stem) == len(word):
                letters.add(word)
            else:
                tail = word[len(stem) :]
                marked.append((word, stem, tail))
                if stem not in self.words:
                    letters.add(stem)
                if tail not in self.words:
                    tails.add(tail)
        self._letters([w for w in letters if w.isascii()], self.plain)
        self._letters([w for w in letters if not w.isascii()], self.tokenizer)
        self._one_by_one([*tails.union(others)])
        for word, stem, tail in marked:
            self.words[word] = self.words[stem] + self.words[tail]

    def _recall(self, need: list[bytes]) -> None:
        missing = [w for w in need if w not in self.words]
        if len(self.words) + len(missing) > CACHED_WORDS // 2:
            self.older, self.words, missing = self.words, {}, need
        unknown = []
        for word in missing:
            ids = self.older.get(word)
            if ids is None:
                unknown.append(word)
            else:
                self.words[word] = ids
        self._learn(unknown)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each text has; a null text has none."""
        lowered = pc.replace_substring(pc.ascii_lower(pc.fill_null(texts, "")), pattern="\n", replacement=" ")
        lists = pc.split_pattern(lowered, " ")
        found = lists.flatten().dictionary_encode()
        need = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self._recall(need)
        packed = list(map(self.words.__getitem__, need))
        # Each word's ids are copied from where its first ones lie.
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        at = found.indices.to_numpy()
        size = sizes[at]
        ends = np.cumsum(size)
        place = np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - size), size)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(packed), "<u4")[place]
        return ids, np.diff(np.append(0, ends)[lists.offsets.to_numpy()])


_TOKENIZERS: dict[str, WordIds] = {}


def pieces(df: DataFrame, tokenizer: str, capacity: int, text: str = "text") -> DataFrame:
    """One row per piece of at most ``capacity`` ids: ``piece, start, length, ids``.

    ``ids`` are packed little-endian unsigned 32-bit numbers; every document ends in
    id 0.  Other columns are repeated; columns with these names are replaced.  The
    tokenizer must drop white space and split there, as word-end vocabularies do.
    """
    made = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType())]
    names = [n for n, _ in made]
    kept = [f for f in df.schema.fields if f.name not in (*names, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, WordIds(tokenizer))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found, counts = words.encode(batch.column(batch.schema.get_field_index(text)))
                found = np.insert(found, np.cumsum(counts), END)
                sizes = counts + 1
                number = -(-sizes // capacity)
                rows = np.repeat(np.arange(len(sizes)), number)
                piece = np.arange(len(rows)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(sizes[rows] - start, capacity)
                # The pieces of all texts lie one behind the other.
                ends = np.append(0, np.cumsum(4 * length)).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(found)])
                rest = [batch.column(f.name).take(pa.array(rows)) for f in kept]
                new = [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), ids]
                yield pa.RecordBatch.from_arrays(rest + new, [f.name for f in kept] + names)

    ship(df.sparkSession)
    return df.mapInArrow(run, T.StructType(kept + [T.StructField(n, t) for n, t in made]))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: longest first, each into the fullest bin it fits."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, where, made = capacity, made, made + 1
        bins[i], offsets[i] = where, capacity - room
        left = room - size
        if left:
            by_room[left].append(where)
            rooms |= 1 << left
    return bins, offsets


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the bin count: the best of two families of dual feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * size)
    best = 0
    # Sizes over capacity - a count as 1, those under a as 0, others as they are.
    a = np.arange(0, capacity // 2 + 1)
    large = number[capacity] - number[capacity - a]
    middle = total[capacity - a] - np.where(a > 0, total[a - 1], 0)
    best = max(best, int((large - (-middle // capacity)).max()))
    for k in range(1, 41):  # steps of 1 / k
        grown = (k + 1) * size
        exact = grown % capacity == 0
        # f = size / capacity where exact, floor(grown / capacity) / k elsewhere; in units of 1 / (k * capacity)
        units = np.where(exact, k * size, grown // capacity * capacity)
        best = max(best, -int(-(units * count).sum() // (k * capacity)))
    return best


def _repacked(group: pd.DataFrame, capacity: int, round_no: int) -> pd.DataFrame:
    lengths = group["length"].to_numpy(dtype=np.int64)
    bins, offsets = best_fit_decreasing(lengths, capacity)
    number = int(bins.max()) + 1
    old = group["sequence_id"].to_numpy()
    if round_no and number >= len(np.unique(old)):
        group["certified"] = len(np.unique(old)) == least_bins(lengths, capacity)
    else:
        part = int(group["__part"].iloc[0])
        group["sequence_id"] = (np.int64(round_no) << 58) + (np.int64(part) << 28) + bins
        group["offset"] = offsets
        group["certified"] = number == least_bins(lengths, capacity)
    filled = group.groupby("sequence_id")["length"].transform("sum")
    group["open"] = ~group["certified"] & (filled < capacity)
    return group


def _packer(capacity: int, round_no: int):
    return lambda group: _repacked(group, capacity, round_no).drop(columns="__part")


def pack(df: DataFrame, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """``df`` (with a column ``length`` in ``1 .. capacity``) with ``sequence_id`` and gapless ``offset``.

    Stored between the rounds, so a lost executor repeats one round's share only.
    """
    base = df.drop("sequence_id", "offset", "certified", "open", "__part")
    columns = base.columns
    left = stored(base.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}), "pieces")
    schema = T.StructType([*left.schema.fields, T.StructField("certified", T.BooleanType()), T.StructField("open", T.BooleanType())])
    ship(df.sparkSession)
    done = None
    for k in range(rounds):
        number = left.count()
        if not number and done is not None:
            break
        parts = -(-number // PIECES)
        # Pieces of one bin move together, so that the old bins can be kept.
        key = F.xxhash64(F.lit(k), *([F.col("sequence_id")] if k else [F.col(c) for c in columns]))
        dealt = left.withColumn("__part", F.pmod(key, F.lit(max(1, parts))))
        packed = stored(dealt.groupBy("__part").applyInPandas(_packer(capacity, k), schema), f"packed-{k}")
        final = packed if k == rounds - 1 or parts <= 1 else packed.filter(~F.col("open"))
        done = final if done is None else done.unionByName(final)
        if parts <= 1:
            break
        left = packed.filter(F.col("open")).drop("certified", "open")
    return done.drop("certified", "open")
