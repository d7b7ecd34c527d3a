"""Token ids in binary files of patched frame-of-reference blocks (operator 11).

    encode_to_files(docs, vocabulary, path)    files in ascending order of doc_id, and an index of them
    read_token_files(spark, path)              doc_id, start, n_tokens, ids (binary: unsigned 32-bit integers, little-endian)
    encode_ids(docs, vocabulary)               doc_id, ids; write_token_files(encoded, path) writes such rows

A file holds three streams of integers: token ids, lengths of documents, differences of their ids.  A stream is cut into
blocks of BLOCK values.  A block subtracts its least value and packs the rest at the width that PERCENT of them need;
the others are exceptions, whose places and higher bits follow.  The index of a stream says where each block starts, so a
range of values is read from the blocks that it touches.

    file    := magic, blocks of the ids, blocks of the lengths, blocks of the differences, trailer (JSON), its size (8 bytes), magic
    block   := count (4 bytes), least (8), width (1), width of places (1), width of higher bits (1), exceptions (4),
               packed low bits, packed places, packed higher bits; each packed array starts at a byte
    trailer := of each stream its values and the starts of its blocks; documents, those without id, first doc_id
"""

from __future__ import annotations

import functools
import json
import re
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from chemlake.llm.token_counts import byte_alphabet
from chemlake.llm.workspace import small_batches

#: Values in a block, and the share of them that its width holds without exceptions.
BLOCK, PERCENT = 4096, 95
#: Blocks that are packed at once, and values that are too few for that.
CHUNK_BLOCKS, FEW = 64, 4096
#: Tokens after which a task goes on in another file.
FILE_TOKENS = 1 << 26
#: Pieces kept with their ids in each Python worker; beyond that the cache starts anew. Longer ones are encoded each time.
CACHE_PIECES, CACHE_CHARS = 1_000_000, 48
#: Tokens that are handed on at once when files are read.
READ_TOKENS = 1 << 18

MAGIC = b"PFORTOK1"
INDEX = "_index.json"
STREAMS = ("ids", "lengths", "differences")
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
_HEADER = np.dtype([("count", "<u4"), ("least", "<u8"), ("width", "u1"), ("places", "u1"), ("higher", "u1"), ("exceptions", "<u4")])


# --- bits -----------------------------------------------------------------------------------------------------------


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned 64-bit integer, read from the exponents of its halves as floating-point numbers."""
    exponents = lambda x: (x.astype(np.float64).view(np.int64) >> 52).clip(1022) - 1022
    if not len(values) or values.max() < 1 << 53:
        return exponents(values).astype(np.uint8)
    high = exponents(values >> np.uint64(32))
    return np.where(high > 0, high + 32, exponents(values & np.uint64(0xFFFFFFFF))).astype(np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values as rows of bytes, `width` bits a value, lowest bit first.

    64 values make `width` words of 64 bits; each of the 64 places is packed for all rows at once.  Few values are
    packed bit by bit, which takes fewer calls.
    """
    rows, n = values.shape
    if not width or not n:
        return np.zeros((rows, 0), np.uint8)
    if rows * n < FEW:
        bits = np.unpackbits(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(rows, n, 8), axis=2, bitorder="little")[:, :, :width]
        return np.packbits(bits.reshape(rows, n * width), axis=1, bitorder="little")
    lanes = np.zeros((64, rows, -(-n // 64)), np.uint64)
    padded = np.zeros((rows, lanes.shape[2] * 64), np.uint64)
    padded[:, :n] = values
    lanes[:] = padded.reshape(rows, -1, 64).transpose(2, 0, 1)
    words = np.zeros((width, rows, lanes.shape[2]), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[word] |= lanes[k] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.transpose(1, 2, 0), "<u8").view(np.uint8).reshape(rows, -1)[:, : packed_size(n, width)]


def unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    """The reverse of pack: rows of bytes to rows of n values."""
    rows = len(data)
    if not width or not n:
        return np.zeros((rows, n), np.uint64)
    if rows * n < FEW:
        bits = np.unpackbits(data, axis=1, count=n * width, bitorder="little").reshape(rows, n, width)
        raw = np.zeros((rows, n, 8), np.uint8)
        raw[:, :, : (width + 7) // 8] = np.packbits(bits, axis=2, bitorder="little")
        return raw.view("<u8").reshape(rows, n).astype(np.uint64)
    groups = -(-n // 64)
    padded = np.zeros((rows, groups * width * 8), np.uint8)
    padded[:, : data.shape[1]] = data
    words = np.ascontiguousarray(padded.view("<u8").reshape(rows, groups, width).transpose(2, 0, 1))
    out, mask = np.empty((rows, groups, 64), np.uint64), np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        lane = words[word] >> np.uint64(shift)
        if shift + width > 64:
            lane |= words[word + 1] << np.uint64(64 - shift)
        out[:, :, k] = lane & mask
    return out.reshape(rows, -1)[:, :n]


def packed_size(n: int, width: int) -> int:
    return (n * width + 7) // 8


# --- blocks ---------------------------------------------------------------------------------------------------------


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """Blocks of up to BLOCK values each; blocks of one width are packed together."""
    values = values.astype(np.uint64, copy=False)
    whole = len(values) // BLOCK
    blocks: list[bytes] = []
    if whole:
        blocks += _encode_rows(values[: whole * BLOCK].reshape(whole, BLOCK))
    if len(values) > whole * BLOCK:
        blocks += _encode_rows(values[whole * BLOCK :].reshape(1, -1))
    return blocks


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    n = rows.shape[1]
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    sizes = bit_lengths(rest)
    place = -(-n * PERCENT // 100) - 1
    widths = np.partition(sizes, place, axis=1)[:, place]
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        mine = np.flatnonzero(widths == width)
        low = rest[mine] & np.uint64((1 << int(width)) - 1)
        for k, packed in zip(mine, pack(low, int(width)), strict=True):
            at = np.flatnonzero(sizes[k] > width)
            higher = rest[k, at] >> np.uint64(width)
            place_bits = int(at[-1]).bit_length() if len(at) else 0
            higher_bits = int(sizes[k].max() - width) if len(at) else 0
            head = np.array([(n, least[k], width, place_bits, higher_bits, len(at))], _HEADER)
            out[k] = b"".join((head.tobytes(), packed.tobytes(), pack(at[None].astype(np.uint64), place_bits).tobytes(), pack(higher[None], higher_bits).tobytes()))
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The values of each block; blocks of one size and width are unpacked together."""
    heads = [np.frombuffer(data, _HEADER, 1)[0] for data in blocks]
    alike: dict[tuple[int, int], list[int]] = {}
    for k, head in enumerate(heads):
        alike.setdefault((int(head["count"]), int(head["width"])), []).append(k)
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(blocks)
    for (n, width), mine in [(k, all_[at : at + CHUNK_BLOCKS]) for k, all_ in alike.items() for at in range(0, len(all_), CHUNK_BLOCKS)]:
        size = packed_size(n, width)
        packed = np.frombuffer(b"".join(blocks[k][_HEADER.itemsize : _HEADER.itemsize + size] for k in mine), np.uint8).reshape(len(mine), size)
        for k, values in zip(mine, unpack(packed, n, width), strict=True):
            if n_odd := int(heads[k]["exceptions"]):
                at = _HEADER.itemsize + size
                place_size, higher_size = (packed_size(n_odd, int(heads[k][c])) for c in ("places", "higher"))
                places = unpack(np.frombuffer(blocks[k], np.uint8, place_size, at)[None], n_odd, int(heads[k]["places"]))[0]
                higher = unpack(np.frombuffer(blocks[k], np.uint8, higher_size, at + place_size)[None], n_odd, int(heads[k]["higher"]))[0]
                values[places.astype(np.int64)] |= higher << np.uint64(width)
            out[k] = values + heads[k]["least"]
    return out


# --- files ----------------------------------------------------------------------------------------------------------


class _Stream:
    """Values on their way to blocks; `put` writes what is full."""

    def __init__(self):
        self.waiting, self.n_waiting, self.values, self.starts = [], 0, 0, []

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.n_waiting += len(values)
        self.values += len(values)

    def put(self, out, all_of_it: bool) -> None:
        if not (self.n_waiting if all_of_it else self.n_waiting >= CHUNK_BLOCKS * BLOCK):
            return
        values = np.concatenate(self.waiting)
        most = len(values) if all_of_it else len(values) // BLOCK * BLOCK
        for at in range(0, most, CHUNK_BLOCKS * BLOCK):
            for block in encode_blocks(values[at : min(most, at + CHUNK_BLOCKS * BLOCK)]):
                self.starts.append(out.tell())
                out.write(block)
        self.waiting, self.n_waiting = [values[most:]], len(values) - most


class FileWriter:
    """One file; documents are added in order."""

    def __init__(self, out):
        self.out, self.streams, self.docs, self.n_null, self.first, self.last = out, {k: _Stream() for k in STREAMS}, 0, 0, None, None
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        known = [i for i in doc_ids if i is not None]
        if self.last is not None and None in doc_ids or any(i is None for i in doc_ids[len(doc_ids) - len(known) :]):
            raise ValueError("documents without id come first")
        if known:
            self.first = known[0] if self.first is None else self.first
            ordered = np.array([known[0] if self.last is None else self.last, *known], np.int64)
            if (ordered[1:] < ordered[:-1]).any():
                raise ValueError("documents are not in order")
            self.streams["differences"].add(ordered.view(np.uint64)[1:] - ordered.view(np.uint64)[:-1])
            self.last = known[-1]
        self.docs += len(doc_ids)
        self.n_null += len(doc_ids) - len(known)
        self.streams["lengths"].add(np.array([len(x) // 4 for x in ids], np.uint64))
        self.streams["ids"].add(np.frombuffer(b"".join(ids), "<u4"))
        self.streams["ids"].put(self.out, False)

    def close(self) -> dict:
        """Ends the file; what the index says of it."""
        for stream in self.streams.values():
            stream.put(self.out, True)
        trailer = {k: {"values": s.values, "starts": [*s.starts]} for k, s in self.streams.items()}
        at = self.out.tell()
        trailer |= {"end": at, "docs": self.docs, "n_null": self.n_null, "first": self.first}
        data = json.dumps(trailer).encode()
        self.out.write(data + len(data).to_bytes(8, "little") + MAGIC)
        return {"docs": self.docs, "tokens": self.streams["ids"].values, "bytes": at + len(data) + 8 + len(MAGIC)}


class FileReader:
    """One file, opened at any place."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = self._bytes(size - 8 - len(MAGIC), 8 + len(MAGIC))
        if tail[8:] != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("no token file, or not all of one")
        n = int.from_bytes(tail[:8], "little")
        self.trailer = json.loads(self._bytes(size - 8 - len(MAGIC) - n, n))
        # a block ends where the next one starts, whichever stream that is of
        starts = [s for k in STREAMS for s in self.trailer[k]["starts"]] + [self.trailer["end"]]
        self.ends = dict(zip(starts, starts[1:], strict=False))

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def values(self, stream: str, begin: int, end: int) -> np.ndarray:
        """Values begin to end (exclusive) of a stream, from the blocks that hold them."""
        end = min(end, self.trailer[stream]["values"])
        if begin >= end:
            return np.zeros(0, np.uint64)
        starts = self.trailer[stream]["starts"][begin // BLOCK : (end - 1) // BLOCK + 1]
        data = self._bytes(starts[0], self.ends[starts[-1]] - starts[0])
        parts = decode_blocks([data[s - starts[0] : self.ends[s] - starts[0]] for s in starts])
        return np.concatenate(parts)[begin % BLOCK : begin % BLOCK + end - begin]

    def documents(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(doc_ids, lengths, token ids) of runs of documents; the ids of documents without id are missing at the front."""
        docs, n_null = self.trailer["docs"], self.trailer["n_null"]
        lengths = self.values("lengths", 0, docs).astype(np.int64)
        differences = self.values("differences", 0, docs - n_null)
        if len(differences):
            differences[0] = np.array(self.trailer["first"], np.int64).view(np.uint64)
        doc_ids = np.cumsum(differences, dtype=np.uint64).view(np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < docs:
            begin = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, begin + READ_TOKENS, side="right")))
            ids = self.values("ids", begin, int(ends[to - 1]))
            yield doc_ids[max(0, at - n_null) : max(0, to - n_null)], lengths[at:to], ids
            at = to


# --- Spark's side ---------------------------------------------------------------------------------------------------


def _files_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that driver and executors share, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    files: list


class TokenFileWriter(DataSourceArrowWriter):
    """Writes (doc_id, ids), or with the option vocabulary (doc_id, text), whose ids are made on the way."""

    def __init__(self, options: dict):
        self.path, self.vocabulary, self.tail = options["path"], None, _tail(options.get("end_id"))
        if options.get("vocabulary"):
            with open(options["vocabulary"], "rb") as file:  # it travels with the tasks
                self.vocabulary = file.read()

    def write(self, iterator):
        files, path = _files_of(self.path)
        files.create_dir(path, recursive=True)
        made, writer, out = [], None, None
        part = TaskContext.get().partitionId()
        known = _piece_ids(self.vocabulary) if self.vocabulary else None

        def ended():
            made.append({"part": part, "seq": len(made), "file": name} | writer.close())
            out.close()

        for batch in iterator:
            at = 0
            while at < batch.num_rows:
                if writer is None:
                    # the name is this attempt's alone; files of attempts that failed are in no index
                    name = f"tokens-{part:06d}-{len(made):04d}-{uuid.uuid4().hex}.pfor"
                    out = files.open_output_stream(f"{path}/{name}")
                    writer = FileWriter(out)
                some = batch.slice(at, 64)
                values = some.column(1).to_pylist()
                writer.add(some.column(0).to_pylist(), [known.ids(t or "") + self.tail for t in values] if known is not None else values)
                at += some.num_rows
                if writer.streams["ids"].values >= FILE_TOKENS:
                    ended()
                    writer = None
        if writer is not None:
            ended()
        return _Written(made)

    def commit(self, messages):
        """The index names the files of the attempts that count, in order, with the tokens before each; it is written last."""
        files, path = _files_of(self.path)
        files.create_dir(path, recursive=True)
        listed, start = sorted((f for m in messages if m for f in m.files), key=lambda f: (f["part"], f["seq"])), 0
        for f in listed:
            f["start"] = start
            start += f["tokens"]
        draft = f"{path}/{INDEX}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps({"files": listed, "tokens": start}).encode())
        files.move(draft, f"{path}/{INDEX}")

    def abort(self, messages):
        files, path = _files_of(self.path)
        for f in (f for m in messages if m for f in m.files):
            files.delete_file(f"{path}/{f['file']}")


@dataclass
class _Part(InputPartition):
    file: str
    start: int


class TokenFileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self):
        files, path = _files_of(self.path)
        with files.open_input_stream(f"{path}/{INDEX}") as source:
            return [_Part(f["file"], f["start"]) for f in json.loads(source.read())["files"]]

    def read(self, partition):
        if partition is None:  # no files
            return
        files, path = _files_of(self.path)
        with files.open_input_file(f"{path}/{partition.file}") as source:
            at = partition.start
            for doc_ids, lengths, ids in FileReader(source).documents():
                ends = np.cumsum(lengths)
                n_null = len(lengths) - len(doc_ids)
                offsets = pa.py_buffer(np.concatenate(([0], ends * 4)).astype("<i4").tobytes())
                data = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())])
                known = pa.array([*[None] * n_null, *doc_ids.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([known, pa.array(at + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), data], ["doc_id", "start", "n_tokens", "ids"])
                at += int(ends[-1])


class TokenFiles(DataSource):
    """spark.read.format("token_files"), df.write.format("token_files"): a folder of token files with its index."""

    @classmethod
    def name(cls):
        return "token_files"

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType):
        return TokenFileReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool):
        return TokenFileWriter(dict(self.options))


# --- encoding -------------------------------------------------------------------------------------------------------


# The normaliser and the split of the vocabularies that are read piece by piece: lower case, letters together, numbers one by one.
NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Characters of which composing, lower case and kind are plain: printable ones of ASCII and Latin, and white space of ASCII.
PLAIN = [*range(9, 14), *range(32, 127), *(c for c in range(0xA1, 0x180) if c != 0x130)]
#: The bytes of these in UTF-8, and what else such bytes can make: controls and the no-break space (U+0130 is looked for by itself).
_LATIN, _CONTROLS = bytes([*range(9, 14), *range(32, 127), *range(0x80, 0xC0), *range(0xC2, 0xC6)]), re.compile(rb"\xc2[\x80-\xa0]").search


class PieceIds(dict):
    """Pre-token -> its ids as bytes, by the library's merges; texts of plain characters are split here, other words by the library.

    White space parts pre-tokens, and neither the normaliser nor the split looks across it, so a text's ids are those of its words.
    """

    def __init__(self, vocabulary: bytes):
        super().__init__()
        self.library = Tokenizer.from_str(vocabulary.decode())
        self.alphabet = byte_alphabet()
        spec = json.loads(vocabulary)
        rules, pre = (spec.get("normalizer") or {}).get("normalizers"), (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = pre[0] == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True} and [(p.get("type"), p.get("use_regex"), p.get("add_prefix_space")) for p in pre[1:]] == [("ByteLevel", False, False)]
        self.piecewise = rules == NORMALISER and split and spec["model"]["type"] == "BPE" and not spec.get("post_processor")
        kinds = {k: "".join(chr(c) for c in PLAIN if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        self.pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^\s{kinds['L']}{kinds['N']}]+").findall
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]

    def plain(self, data: bytes) -> bool:
        """Whether a text in UTF-8 holds PLAIN characters alone, and no string of an added token."""
        return not (data.translate(None, _LATIN) or b"\xc4\xb0" in data or b"\xc2" in data and _CONTROLS(data) or any(a in data for a in self.added))

    def _kept(self, key: str, ids: list[int]) -> bytes:
        data = struct.pack(f"<{len(ids)}I", *ids)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[key] = data
        return data

    def __missing__(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() else "".join(map(self.alphabet.__getitem__, piece.encode()))
        return self._kept(piece, [t.id for t in self.library.model.tokenize(symbols)])

    def _word(self, word: str) -> bytes:
        """The ids of a word that holds other characters or an added token; kept under a name that no piece has."""
        key = " " + word
        return self[key] if key in self else self._kept(key, self.library.encode(word, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if not self.piecewise:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        data = text.encode("utf-8", "surrogatepass")
        if self.plain(data):
            found = self.pieces(text.lower())
            return b"".join(itemgetter(*found)(self)) if len(found) > 1 else b"".join(map(self.__getitem__, found))
        # split at white space of ASCII alone: what else counts as such is for the library to say
        words = [(w, w.decode("utf-8", "surrogatepass")) for w in data.split()]
        return b"".join(b"".join(map(self.__getitem__, self.pieces(word.lower()))) if self.plain(w) else self._word(word) for w, word in words)


@functools.lru_cache(maxsize=2)
def _piece_ids(vocabulary: bytes) -> PieceIds:
    return PieceIds(vocabulary)


def _tail(end_id: str | int | None) -> bytes:
    return b"" if end_id is None else struct.pack("<I", int(end_id))


def encode_ids(docs: DataFrame, vocabulary_path: str, *, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): token ids of each whole text under the library and vocabulary, then end_id, as unsigned 32-bit integers.

    Null and empty texts have the end id only.  Texts of any length are encoded whole.  Each row is encoded by itself;
    an empty table stays empty, and other columns end here.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()
    tail = _tail(end_id)

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        known = _piece_ids(vocabulary)
        return pa.array([known.ids(t.as_py() or "") + tail for t in texts], pa.binary())

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), encode(F.coalesce(F.col(text), F.lit(""))).alias("ids"))


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs dealt and sorted by doc_id; rows that share one are in order of a hash of the text, so that they may part."""
    h = F.xxhash64(F.col(text))
    return docs.repartitionByRange(F.col(doc_id).asc(), h.asc()).sortWithinPartitions(F.col(doc_id).asc(), h.asc())


def write_token_files(encoded: DataFrame, path: str) -> None:
    """encoded (doc_id, ids), which in_order() has put in order, as token files under a new folder.

    Documents without id come first.  The index appears when all files are whole, so readers see all or nothing; a task
    that is run again writes files of its own, and only those of one attempt are in the index.
    """
    encoded.sparkSession.dataSource.register(TokenFiles)
    encoded.select("doc_id", "ids").write.format("token_files").mode("append").save(path)


def encode_to_files(docs: DataFrame, vocabulary_path: str, path: str, *, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """encode_ids() of docs, in order of doc_id, as token files under a new folder: each task encodes what it writes."""
    small_batches(docs.sparkSession)
    docs.sparkSession.dataSource.register(TokenFiles)
    rows = in_order(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    options = {"vocabulary": vocabulary_path} | ({} if end_id is None else {"end_id": str(end_id)})
    rows.write.format("token_files").options(**options).mode("append").save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before it. A folder of no documents gives no rows."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)
