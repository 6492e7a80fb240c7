"""Merge-type subword encoding by backtracking, and its decoding.

A merge encoder joins the neighbours whose joint piece scores best until none is
left.  The same result is found without a merge queue: walk the text with the
longest piece that matches at each position, and accept a piece only if it could
stand beside its predecessor, i.e. if merging the two pieces' characters afresh
gives these two pieces again.  Where no piece fits, step back, take the next
shorter piece, and mark the position as failed in a bit field so that it is not
tried twice.

No piece of such a model holds a space sign behind another character, and line
ends are never part of one, so a text falls into chunks (a run of space signs
with the word behind it) that encode independently; chunks recur, and each worker
remembers a bounded number of them, those that recur for longer.

Defined results: a null or empty text has no ids and decodes to the empty text;
control ids decode to nothing; rows are handled one by one, so repeated rows and ids stay
as they are; an empty table gives an empty result; a column of ``df`` named like the new
one is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from changelake.llm.shipping import ship
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
CACHED_CHUNKS = 300_000  # per worker, and as many that were there before the newest
ROWS_AT_ONCE = 500
_BYTES_TEXT = "�".encode()


class PieceModel:
    """The pieces of a model file, with encoder and decoder."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.unknown = lib.unk_id()
        self.bytes: dict[int, int] = {}  # byte value -> id
        self.surface: list[bytes] = []  # what an id decodes to
        self.raw_byte = np.zeros(size, dtype=bool)
        self.controls: set[int] = set()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        for i in range(size):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.raw_byte[i] = True
                self.surface.append(bytes([value]))
            elif lib.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            elif lib.is_control(i):
                self.controls.add(i)
                self.surface.append(b"")
            else:
                self.surface.append(piece.replace(SPACE, " ").encode())
                self.ids[piece] = i
                self.scores[piece] = lib.get_score(i)
        #: Surfaces, then surfaces without the space in front of a text.
        behind = (x[1:] if x[:1] == b" " and not raw else x for x, raw in zip(self.surface, self.raw_byte))
        self.surfaces = pa.array([*self.surface, *behind], pa.large_binary())
        self.apart = self.raw_byte & np.array([x[:1] >= b"\x80" for x in self.surface])
        self.apart[[*self.controls, self.unknown]] = True
        # A piece that merging cannot rebuild never appears in a result.
        self.ids = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merged(p) == [p]}
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.single = frozenset(p for p in self.ids if len(p) == 1)
        self.reach = max(map(len, self.ids), default=0)
        self.trie = ahocorasick.Automaton()
        #: What a trie's path of a text's characters begins with: the longest piece.
        self.within: dict[str, str] = {}
        for piece in sorted(self.ids, key=len):  # longer ones take over their own ends only
            self.trie.add_word(piece, 0)
            for end in range(1, len(piece)):
                self.within.setdefault(piece[:end], self.within.get(piece[: end - 1], piece[:1]))
            self.within[piece] = piece
        self.shorter = {p: self.next_shorter(p) for p in self.ids}
        self.fits: dict[tuple[str, str], bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        for value, i in self.bytes.items():
            assert value != 10 or "\n" not in self.scores, "line ends must stand alone"
        assert not any(SPACE in p[1:] and p.strip(SPACE) for p in self.ids), "a space sign inside a piece"

    def merged(self, text: str) -> list[str]:
        """Plain merging: best score first, leftmost on ties."""
        parts = list(text)
        score, low = self.scores.get, -math.inf
        joint = [score(a + b, low) for a, b in zip(parts, parts[1:])]
        while joint and (best := max(joint)) > low:
            at = joint.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = score(parts[at - 1] + parts[at], low)
            if at < len(joint):
                joint[at] = score(parts[at] + parts[at + 1], low)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 2 * CACHED_CHUNKS:
                self.fits.clear()
            known = self.fits[left, right] = self.merged(left + right) == [left, right]
        return known

    def next_shorter(self, piece: str) -> str | None:
        for end in range(len(piece) - 1, 0, -1):
            if piece[:end] in self.ids:
                return piece[:end]
        return None

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all pieces themselves."""
        size, reach = len(text), self.reach
        prefix, within = self.trie.longest_prefix, self.within
        alive = bytearray(b"\1") * (size + 1)  # 0: known to fail
        fits, shorter = self.fits, self.shorter
        out: list[str] = []
        at, last = 0, None
        ahead = text[:reach]
        piece = within[ahead[: prefix(ahead)]]
        while True:
            end = at + len(piece)
            if alive[end]:
                good = last is None or fits.get((last, piece))
                if good is None:
                    good = self.compatible(last, piece)
                if good:
                    out.append(piece)
                    if end == size:
                        return out
                    at, last = end, piece
                    ahead = text[end : end + reach]
                    piece = within[ahead[: prefix(ahead)]]
                    continue
            piece = shorter[piece]
            if piece is None:
                alive[at] = 0
                if last is None:
                    raise ValueError(f"no encoding of {text!r}")
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a chunk as packed 32-bit numbers."""
        packed = self.packed.__getitem__
        if self.single.issuperset(chunk):
            return b"".join(map(packed, self.pieces(chunk)))
        out: list[bytes] = []
        start = 0
        for i, c in enumerate(chunk):
            if c not in self.single:
                if i > start:
                    out += map(packed, self.pieces(chunk[start:i]))
                start = i + 1
                ids = [self.bytes.get(b, self.unknown) for b in c.encode()] if self.bytes else [self.unknown]
                out += [i.to_bytes(4, "little") for i in ids]
        if start < len(chunk):
            out += map(packed, self.pieces(chunk[start:]))
        return b"".join(out)

    def split(self, text: str) -> list[str]:
        """The chunks of a text, in order."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return _CHUNK.findall(marked)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed 32-bit numbers."""
        lists = [self.split(t) for t in texts]
        need = set().union(*lists) if lists else set()
        missing = need.difference(self.chunks)
        if len(self.chunks) + len(missing) > CACHED_CHUNKS:  # what recurs comes back from the older ones
            self.older, self.chunks, missing = self.chunks, {}, need
        known = self.older.get
        for chunk in missing:
            self.chunks[chunk] = known(chunk) or self.chunk_ids(chunk)
        get = self.chunks.__getitem__
        return [b"".join(map(get, chunks)) for chunks in lists]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], dtype="<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that form no character become U+FFFD, one each."""
        surface = self.surface
        try:
            if not self.controls.isdisjoint(ids):  # they part the bytes beside them
                raise ValueError
            text = b"".join([surface[i] for i in ids]).decode()
        except ValueError:
            text = self._decode_broken(ids)
        first = next((i for i in ids if surface[i]), None)
        if first is not None and not self.raw_byte[first] and first != self.unknown and text.startswith(" "):
            return text[1:]
        return text

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The texts of many lists of ids: surfaces are taken from one dictionary and lie one behind the other.

        Lists with controls, unknown ids or raw bytes of a longer character are decoded one by one.
        """
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        odd = np.zeros(len(lists), bool)
        at = np.flatnonzero(self.apart[flat])
        odd[np.searchsorted(ends, at, side="right") - 1] = True
        filled = np.flatnonzero(np.diff(ends))
        flat = flat.copy()
        flat[ends[filled]] += len(self.surface)  # the first surface of a text loses its space
        taken = self.surfaces.take(pa.array(flat))
        offsets = np.frombuffer(taken.buffers()[1], np.int64, len(flat) + 1, taken.offset * 8)[ends]
        texts = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(offsets), taken.buffers()[2]])
        if odd.any():
            number = np.arange(len(lists))
            number[odd] = len(lists) + np.arange(odd.sum())
            one_by_one = [self.decode(lists[i].as_py() or []) for i in np.flatnonzero(odd).tolist()]
            texts = pa.concat_arrays([texts, pa.array(one_by_one, pa.large_string())]).take(pa.array(number))
        return texts.cast(pa.string())

    def _decode_broken(self, ids: list[int]) -> str:
        out: list[bytes] = []
        run = bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + width]).decode().encode() if at + width <= len(run) else 1 / 0)
                        at += width
                        break
                    except (UnicodeDecodeError, ZeroDivisionError):
                        continue
                else:
                    out.append(_BYTES_TEXT)
                    at += 1
            run.clear()

        for i in ids:
            if self.raw_byte[i]:
                run += self.surface[i]
            else:
                flush()
                out.append(self.surface[i])
        flush()
        return b"".join(out).decode()


_CHUNK = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, read once per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _replaced(batch: pa.RecordBatch, drop: str, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in (drop, name)]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values], [*names, name])


def _schema(df: DataFrame, drop: str, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in (drop, name)] + [T.StructField(name, kind)])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with column ``ids`` (array of int) in place of ``text``; other columns pass through.

    ``decoded`` names a further column for what these ids decode to, as ``decode`` adds it;
    the ids then go through one Python worker instead of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                column = batch.column(batch.schema.get_field_index(text))
                packed = pieces.encode_batch([t or "" for t in column.to_pylist()])
                offsets = np.zeros(len(packed) + 1, dtype=np.int32)
                np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                out = _replaced(batch, text, ids, lists)
                yield _replaced(out, "", decoded, pieces.decode_lists(lists)) if decoded else out

    ship(df.sparkSession)
    schema = _schema(df, text, ids, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = T.StructType([*(f for f in schema.fields if f.name != decoded), T.StructField(decoded, T.StringType())])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids as a further column; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                column = batch.column(batch.schema.get_field_index(ids))
                yield _replaced(batch, "", text, pieces.decode_lists(column))

    ship(df.sparkSession)
    return df.mapInArrow(run, _schema(df, "", text, T.StringType()))
