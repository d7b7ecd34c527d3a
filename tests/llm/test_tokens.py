"""Token counts and pieces against the libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chemlake.llm import sentence_pieces, token_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts(n):
    r = random.Random(n)
    bits = ["a", "the", " the", "b", " ", "  ", "\n", "\t", "é", "▁", "日本", "😀", "<|endoftext|>", "12", "'s", "<s>", "<0x0A>", "\x00", "　", " ", "!!", "ingtion", "ẞ", "é"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_token_counts_equal_the_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(800))] + [(9_001, "x" * 50_000), (9_002, "ab " * 30_000)]
    library = Tokenizer.from_file(BYTES)
    found = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows}
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)


def test_every_character_is_split_as_by_the_library():
    counter, library = token_counts.MergeCounter(open(BYTES, "rb").read()), Tokenizer.from_file(BYTES)
    for point in [*range(0x3100), *range(0xA000, 0xD7FF, 37), *range(0xE000, 0x20000, 41), 0x107BB, 0x11DE0, 0x16EA0, 0x16EBB, 0x3D000, 0x3D001]:
        text = f"a{chr(point)}1{chr(point)}{chr(point)} {chr(point)}b "
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), hex(point)


def test_counts_of_edge_cases(spark):
    rows = spark.createDataFrame([(1, None, 7), (2, "", 7), (2, "", 7)], "doc_id long, text string, n_tokens int")
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(rows, BYTES).collect()] == [(0, 0, False)] * 3
    assert token_counts.count_tokens(rows.limit(0), BYTES).collect() == []


def test_pieces_equal_the_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(600))] + [(9_001, "x" * 3_000), (9_002, "ab " * 400_000)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {r.doc_id: r.pieces for r in sentence_pieces.encode_pieces(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect()}
    for i, t in rows:
        ids, got = library.encode(t), found[i]
        assert list(got.ids) == ids and got.decoded == library.decode(ids)
        if len(t) < 5_000:
            assert [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces] == list(zip(got.begins, got.ends, strict=True))
        data = t.encode()
        assert b"".join(data[b:e] for b, e in zip(got.begins, got.ends, strict=True)) == data


def test_decoding_any_ids(spark):
    r, library = random.Random(3), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, [r.randrange(0, 420) for _ in range(r.randint(0, 9))]) for i in range(400)] + [(999, None)]
    out = sentence_pieces.decode_pieces(spark.createDataFrame(rows, "i long, ids array<int>"), PIECES).collect()
    assert all(x.decoded == library.decode(list(x.ids or [])) for x in out)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_normalisation_through_a_compiled_map(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    fields = dict(sentence_pieces._fields(dict(sentence_pieces._fields(library.serialized_model_proto()))[3]))
    own = sentence_pieces.Normaliser(fields[2], sentence_pieces.Options(*(bool(fields.get(k, 1)) for k in (3, 4, 5))))
    for t in ["Ａｂｃ  ﬁ ½ ㍿ é  x ", "´a", "  ", "", " a​b\x00", *texts(300)]:
        normal, align = own(t)
        assert normal == library.normalize(t)
        assert len(align) == len(normal) + 1 and (np.diff(align) >= 0).all() and align[-1] <= len(t.encode())


def test_edge_cases_of_pieces(spark):
    rows = spark.createDataFrame([(1, None, 7), (2, "", 7), (2, "", 7)], "doc_id long, text string, pieces int")
    out = sentence_pieces.encode_pieces(rows, PIECES)
    assert [(r.pieces.ids, r.pieces.decoded) for r in out.collect()] == [([], "")] * 3
    assert sentence_pieces.encode_pieces(rows.limit(0), PIECES).select(F.col("pieces.ids")).collect() == []
