"""Token files: round trips, the library, and lost attempts."""

import io
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chemlake.llm import queries, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")


def texts(n):
    r = random.Random(n)
    bits = ["a", "the", " the", "B", " ", "  ", "\n", "\t", "é", "é", " ́", "▁", "日本", "😀", "<|endoftext|>", "<|startoftext|>x", "12", "'s", "Don't", "ΣΑΣ", "İ", "\x1c", "\xa0", " ", "\x00", "　", "!!", "ingtion", "ẞ", "ﬁ", "각", "\x85"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(n)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", ["small", "one", "wide", "outliers", "same", "none", "full"])
def test_blocks_round_trip(kind):
    r = np.random.default_rng(3)
    for n in (0, 1, 7, token_files.BLOCK, 3 * token_files.BLOCK + 5):
        values = {
            "small": r.integers(0, 49_000, n), "one": r.integers(0, 2, n), "wide": r.integers(0, 2**63, n), "outliers": np.where(r.random(n) < 0.01, 2**40 + 3, r.integers(5, 9, n)),
            "same": np.full(n, 77), "none": np.zeros(n, np.int64), "full": np.where(r.random(n) < 0.5, np.uint64(2**64 - 1), np.uint64(0)),
        }[kind].astype(np.uint64)
        blocks = token_files.encode_blocks(values)
        assert len(blocks) == -(-n // token_files.BLOCK)
        assert np.array_equal(np.concatenate(token_files.decode_blocks(blocks) or [values]), values)
        for width in (1, 7, 8, 31, 33, 63, 64):
            low = values & np.uint64((1 << width) - 1)
            packed = token_files.pack(low.reshape(1, -1), width)
            bits = "".join(f"{int(v):0{width}b}"[::-1] for v in low[:200])
            assert "".join(f"{b:08b}"[::-1] for b in packed[0, : len(bits) // 8]) == bits[: len(bits) // 8 * 8]
            assert np.array_equal(token_files.unpack(packed, n, width)[0], low) and packed.shape[1] == token_files.packed_size(n, width)
        assert token_files.bit_lengths(values).tolist() == [int(v).bit_length() for v in values]
    if kind == "outliers":  # two bits a value, and some bytes for each of the one in a hundred
        assert sum(map(len, blocks)) < n * 2 / 8 + n * 0.02 * 8 + 100


def test_a_file_round_trips_and_opens_at_any_place():
    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    out, r = io.BytesIO(), random.Random(3)
    writer = token_files.FileWriter(out)
    docs = [(None, [1]), (None, [])] + [(i, [r.randrange(50_000) for _ in range(r.randint(0, 300))]) for i in sorted(r.randrange(-(2**63), 2**63) for _ in range(500))]
    docs.insert(50, docs[50])
    for at in range(0, len(docs), 60):
        some = docs[at : at + 60]
        writer.add([d for d, _ in some], [np.array(x, "<u4").tobytes() for _, x in some])
    told = writer.close()
    reader = token_files.FileReader(Source(out.getvalue()))
    everything = [t for _, x in docs for t in x]
    assert told["docs"] == len(docs) and told["tokens"] == len(everything) and told["bytes"] == len(out.getvalue())
    got = list(reader.documents())
    assert [None] * 2 + [i for part in got for i in part[0]] == [d for d, _ in docs] and [n for part in got for n in part[1]] == [len(x) for _, x in docs]
    for begin, end in [(0, 0), (0, 1), (5, 9_000), (4_095, 4_097), (len(everything) - 3, len(everything) + 9)]:
        assert reader.values("ids", begin, end).tolist() == everything[begin:end]
    with pytest.raises(ValueError):
        writer.add([1], [b""])
    with pytest.raises(ValueError):
        token_files.FileReader(Source(out.getvalue()[:-5]))


def test_the_query_equals_the_library(spark, tmp_path):
    rows = [(i * 3 - 500, t) for i, t in enumerate(texts(700))] + [(9_001, "x" * 30_000), (9_002, "ab, " * 60_000), (9_003, None), (9_004, ""), (None, "no id")]
    shuffled = random.Random(1).sample(rows, len(rows))
    spark.createDataFrame([(*x, 5) for x in shuffled], "doc_id long, text string, start int").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = {x.doc_id: x for x in queries.op11_token_files(spark, str(tmp_path)).collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    assert len(found) == len(rows)
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(found[i]) == (i, start, len(ids), crc(ids)), text[:50]
        start += len(ids)


def test_every_character_and_pairs_of_them():
    """Characters among letters, alone, doubled, and after marks, in either case."""
    known, library = token_files.PieceIds(open(WORDS, "rb").read()), Tokenizer.from_file(WORDS)
    assert known.piecewise
    points = [*range(0x530), *range(0x1E00, 0x2100), *range(0x2C60, 0x2C80), *range(0xA000, 0xD7FF, 37), *range(0xE000, 0x20000, 41)]
    for point in points:
        c = chr(point)
        for text in (f"a{c}1{c}{c} {c}b ", f"X{c}\u0301y'{c}S", f"It's{c}WE'LL,{c}<|startoftext|>{c}"):
            assert known.ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(point)


def test_rows_that_share_an_id_and_many_files(spark, tmp_path):
    """Small partitions stay apart here, so that rows of one id lie in several files."""
    together = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(together, "false")
    rows = [(7, f"word {i % 50}") for i in range(2_000)] + [(1, "a"), (9, "b"), (9, "b")]
    encoded = token_files.encode_ids(token_files.in_order(spark.createDataFrame(rows, "doc_id long, text string")), WORDS, end_id=1)
    token_files.write_token_files(encoded, f"{tmp_path}/out")
    back = token_files.read_token_files(spark, f"{tmp_path}/out").orderBy("start").collect()
    assert [x.doc_id for x in back] == sorted(i for i, _ in rows)
    assert [x.start for x in back] == [sum(y.n_tokens for y in back[:k]) for k in range(len(back))]
    assert sum(x.endswith(".pfor") for x in os.listdir(f"{tmp_path}/out")) > 1
    spark.conf.unset(together)


def test_files_of_other_attempts_are_not_read(spark, tmp_path):
    encoded = spark.createDataFrame([(1, b"\x01\0\0\0"), (2, b"\x02\0\0\0\x03\0\0\0")], "doc_id long, ids binary").coalesce(1)
    token_files.write_token_files(encoded, f"{tmp_path}/out")
    with open(f"{tmp_path}/out/tokens-000000-0000-left.pfor", "wb") as lost:
        lost.write(b"half a file")
    back = token_files.read_token_files(spark, f"{tmp_path}/out").select("doc_id", "start", "n_tokens", F.hex("ids").alias("ids")).collect()
    assert sorted(map(tuple, back)) == [(1, 0, 1, "01000000"), (2, 1, 2, "0200000003000000")]


def test_an_empty_table(spark, tmp_path):
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, ids binary"), f"{tmp_path}/out")
    assert token_files.read_token_files(spark, f"{tmp_path}/out").collect() == []
