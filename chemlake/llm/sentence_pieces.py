"""Offset-preserving SentencePiece BPE encoding, and decoding (operator 9).

The text is normalised by longest-prefix look-up in the model's compiled character map, which records the
source byte of every normalised character; symbols are merged by score; each piece is projected back to its
span of original bytes.
"""

from __future__ import annotations

import functools
import heapq
import re
import struct
from array import array
from dataclasses import dataclass
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chemlake.llm.arrays import unused_name
from chemlake.llm.workspace import small_batches

SPACE = "▁"
#: Segments kept with their pieces in each Python worker; beyond that the cache starts anew.
CACHE_SEGMENTS = 300_000
CACHE_CHARS = 48
#: Up to so many characters the lowest pair is found by looking at all of them, beyond that by a heap.
SHORT, NEVER = 24, 1 << 62

# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message: ints, 4-byte and 8-byte strings, byte strings."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


class CharacterMap:
    """The compiled character map: a double-array trie over byte sequences, and the strings they become."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size :] if compiled else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes consumed at `at` by the longest key, and its replacement."""
        if not self.units:
            return None
        found, units, place = None, self.units, 0
        unit = units[0]
        place = _child(unit, place)
        for i in range(at, len(data)):
            place ^= data[i]
            if place >= len(units):
                break
            unit = units[place]
            if unit & 0x800000FF != data[i]:
                break
            place = _child(unit, place)
            if unit >> 8 & 1:  # a key ends here
                start = units[place] & 0x7FFFFFFF
                found = i + 1 - at, self.strings[start : self.strings.index(b"\0", start)]
        return found


def _child(unit: int, place: int) -> int:
    """Where a trie unit's children are."""
    return place ^ (unit >> 10 << ((unit & 1 << 9) >> 6))


@dataclass
class Options:
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


class Normaliser:
    def __init__(self, compiled: bytes, options: Options):
        self.map, self.options = CharacterMap(compiled), options

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the original byte at which each of its characters starts, closed by the end."""
        space = SPACE if self.options.escape_whitespaces else " "
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.options.remove_extra_whitespaces:
            points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
            widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            prefix = int(self.options.add_dummy_prefix)
            align = np.zeros(len(text) + 1 + prefix, np.int64)
            np.cumsum(widths, out=align[1 + prefix :])
            return space * prefix + (text.replace(" ", space) if space != " " else text), align
        return self._walk(text, space)

    def _walk(self, text: str, space: str) -> tuple[str, np.ndarray]:
        data, out, align, at = text.encode("utf-8", "replace"), [], [], 0
        trim = self.options.remove_extra_whitespaces
        pieces: list[tuple[str, int, int]] = []
        while at < len(data):
            if found := self.map.longest(data, at):
                n, made = found
            else:
                n = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                made = data[at : at + n]
            pieces.append((made.decode("utf-8", "replace"), at, at + n))
            at += n
        first, last = 0, len(pieces)
        if trim:
            while first < last and pieces[first][0] in (" ", ""):
                first += 1
        if first == last:
            return "", np.array([len(data)], np.int64)
        if self.options.add_dummy_prefix:
            out.append(space)
            align.append(pieces[first][1])
        after_space = trim
        end = pieces[first][1]
        for made, begin, stop in pieces[first:]:
            if after_space and trim:
                made = made.lstrip(" ")
            for c in made:
                out.append(space if c == " " else c)
                align.append(begin)
            if made:
                after_space = made[-1] == " "
            if made or not trim:
                end = stop
        if trim:
            while out and out[-1] == space:
                out.pop()
                end = align.pop()
        return "".join(out), np.array([*align, end], np.int64)


def _segments(pieces) -> re.Pattern:
    """Parts of a normalised text that no merge crosses: a cut needs two neighbouring characters that no piece holds.

    Texts are cut before runs of spaces, before punctuation that follows a letter or digit in no piece, and around white space
    that is in no piece.
    """
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
    if any(a != SPACE and b == SPACE for a, b in pairs):
        return re.compile(r"(?s).+")
    inside = {c for pair in pairs for c in pair}
    before = {c: {a for a, b in pairs if b == c and a.isalnum()} for c in map(chr, range(33, 127)) if not c.isalnum()}
    marks = "".join(re.escape(c) for c, found in before.items() if len(found) < 4)
    joined = "".join(sorted({re.escape(a) for found in before.values() if len(found) < 4 for a in found}))
    alone = "".join(re.escape(c) for c in "\n\r\t" if c not in inside)
    more = f"[^{SPACE}{marks}{alone}]+" + (rf"|(?<![^\W_{joined}])[{marks}]" if marks else "")
    return re.compile(f"{SPACE}*[^{SPACE}{alone}](?:{more})*|{SPACE}+" + (f"|[{alone}]" if alone else ""))


class PieceModel(dict):
    """Segment of normalised text -> its ids as packed 4-byte integers."""

    def __init__(self, model: bytes):
        super().__init__()
        self.pieces: list[tuple[str, float, int]] = []
        options, compiled, kind, fallback = Options(), b"", 1, False
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
                kind, fallback = trainer.get(3, 1), bool(trainer.get(35, 0))
                self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode()
                if trainer.get(24, 0):
                    raise ValueError("white space as a suffix is not supported")
            elif field == 3:
                spec = dict(_fields(value))
                compiled = spec.get(2, b"")
                options = Options(*(bool(spec.get(k, 1)) for k in (3, 4, 5)))
        kinds = {k for _, _, k in self.pieces}
        if kind != 2 or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("a BPE model without user-defined or unused pieces is needed")
        self.normalise = Normaliser(compiled, options)
        self.options, self.fallback = options, fallback
        self.id = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == NORMAL}
        order = {s: r for r, s in enumerate(sorted({s for _, s, k in self.pieces if k == NORMAL}, reverse=True))}
        self.rank = {p: order[s] for p, s, k in self.pieces if k == NORMAL}  # equal scores have equal ranks
        self.unknown = next((i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN), 0)
        self.byte = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(self.pieces) if k == BYTE}
        self.segments = _segments(self.id)
        self.raw = [self._raw(i) for i in range(len(self.pieces))]
        decoded = [self.pieces[i][0].replace(SPACE, " ").encode() if r is None else r for i, r in enumerate(self.raw)]
        self.flat, self.size = np.frombuffer(b"".join(decoded), np.uint8), np.array([*map(len, decoded)], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.width = np.array([len(p) if k == NORMAL else 1 for p, _, k in self.pieces], np.int32)
        self.byte_value = np.array([r[0] if k == BYTE else 0 for r, (_, _, k) in zip(self.raw, self.pieces, strict=True)], np.uint8)

    def _raw(self, i: int) -> bytes | None:
        piece, _, kind = self.pieces[i]
        return {CONTROL: b"", UNKNOWN: self.unknown_surface.encode()}.get(kind, bytes([int(piece[1:-1], 16)]) if kind == BYTE else None)

    def merge(self, segment: str) -> list[str]:
        """Symbols after merging the adjacent pair of the highest score, leftmost first, until none is a piece."""
        symbols, rank = list(segment), self.rank.get
        if len(symbols) <= SHORT:
            ranks = [*map(rank, map(add, symbols, symbols[1:]), repeat(NEVER))]
            while ranks and (r := min(ranks)) < NEVER:
                i = ranks.index(r)
                symbols[i] += symbols.pop(i + 1)
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = rank(symbols[i] + symbols[i + 1], NEVER)
                if i:
                    ranks[i - 1] = rank(symbols[i - 1] + symbols[i], NEVER)
            return symbols
        heap = [r << 32 | i for i, r in enumerate(map(rank, map(add, symbols, symbols[1:]))) if r is not None]
        if not heap:
            return symbols
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(heap)
        while heap:
            key = heapq.heappop(heap)
            i = key & 0xFFFFFFFF
            j = after[i]
            if j >= n or not symbols[i] or rank(made := symbols[i] + symbols[j]) != key >> 32:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = made, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(made + symbols[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank(symbols[h] + made)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return [s for s in symbols if s]

    def __missing__(self, segment: str) -> bytes:
        symbols = self.merge(segment)
        ids = [*map(self.id.get, symbols)]
        if None in ids:
            ids = self._spelt(symbols)
        entry = array("i", ids).tobytes()
        if len(segment) <= CACHE_CHARS:
            if len(self) >= CACHE_SEGMENTS:
                self.clear()
            self[segment] = entry
        return entry

    def _spelt(self, symbols: list[str]) -> list[int]:
        """Ids where some symbols are no pieces: their bytes, or the unknown piece."""
        ids: list[int] = []
        for symbol in symbols:
            if (i := self.id.get(symbol)) is not None:
                ids.append(i)
            else:
                ids += [self.byte[b] for b in symbol.encode("utf-8", "replace")] if self.fallback else [self.unknown]
        return ids

    def _widths(self, ids: np.ndarray) -> np.ndarray:
        """Characters of each piece; the last byte of a spelt character counts one, those before it none."""
        widths = self.width[ids]
        value = self.byte_value[ids]
        inner = (value & 0xC0) == 0x80
        widths[value >= 0xC0] = 0
        widths[:-1][(value[:-1] >= 0x80) & inner[1:]] = 0
        return widths

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and end byte of each piece in the original text's UTF-8."""
        normal, align = self.normalise(text or "")
        ids = np.frombuffer(b"".join(map(self.__getitem__, self.segments.findall(normal))), "<i4")
        ends = np.cumsum(self._widths(ids), dtype=np.int64)
        begins = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ids) else ends
        return ids, align[begins], align[ends]

    def decode(self, ids) -> str:
        """The text of a list of ids; bytes that make no character become U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        whole = self.flat[np.repeat(self.start[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()
        seen = next((i for i in ids.tolist() if self.raw[i] != b""), None)  # control pieces are nothing
        if seen is not None and self.raw[seen] is None and self.pieces[seen][0].startswith(SPACE) and (self.options.add_dummy_prefix or self.options.remove_extra_whitespaces):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return "".join(_valid(whole))


def _valid(data: bytes):
    """Characters of data; each byte that belongs to none gives U+FFFD."""
    at = 0
    while at < len(data):
        n = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        try:
            yield data[at : at + n].decode()
            at += n
        except UnicodeDecodeError:
            yield "�"
            at += 1


@functools.lru_cache(maxsize=2)
def _model(model: bytes) -> PieceModel:
    return PieceModel(model)


#: What the encoder gives for a text.
ENCODED_FIELDS = "ids array<int>, begins array<int>, ends array<int>, decoded string"
#: Characters of text whose pieces leave a task at once; a longer text leaves alone.
PART_CHARS = 1 << 18


def _parts(texts: pa.Array):
    """(first row, end row) of runs of about PART_CHARS."""
    first = held = 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        if held and held + n > PART_CHARS:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts)


def _encoded(own: PieceModel, texts: pa.Array) -> pa.StructArray:
    found = [own.encode(t.as_py()) for t in texts]
    offsets = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[k] for f in found]).astype(np.int32), pa.int32())) for k in range(3)]
    return pa.StructArray.from_arrays([*lists, pa.array([own.decode(f[0]) for f in found], pa.string())], ["ids", "begins", "ends", "decoded"])


def piece_decoder(model_path: str):
    """An Arrow UDF from an array of ids to the text."""
    with open(model_path, "rb") as file:
        model = file.read()

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        own = _model(model)
        return pa.array([own.decode(i.as_py() or []) for i in ids], pa.string())

    return decode


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """docs with the struct column `out`: ids, first and end byte of each piece in the text, decoded text.

    A null text is empty: no ids, decoded to ''.  Every row is encoded whole and by itself, so repeated
    rows, ties, very long texts and empty tables need no rule.  A column of docs called `out` is replaced;
    others are kept.
    """
    small_batches(docs.sparkSession)
    with open(model_path, "rb") as file:
        model = file.read()  # about 0.5 MB; it travels with the task
    rest, whole = [c for c in docs.columns if c != out], unused_name(docs, "whole_text")

    def run(batches):
        own = _model(model)
        for batch in batches:
            texts = batch.column(whole)
            for first, end in _parts(texts):
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), _encoded(own, part.column(whole))], names=[*rest, out])
            pa.default_memory_pool().release_unused()

    kept = docs.select(*rest, F.coalesce(F.col(text), F.lit("")).alias(whole))
    schema = StructType([*[f for f in docs.schema if f.name != out], StructField(out, StructType.fromDDL(ENCODED_FIELDS))])
    return kept.mapInArrow(run, schema)


def decode_pieces(rows: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the text of their ids in `out`; null ids decode to ''. A column called `out` is replaced."""
    return rows.withColumn(out, piece_decoder(model_path)(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
