"""Byte-level BPE against the tiktoken library, and the decoded bytes against the text."""

import base64

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe
from tidemark.llm.shipping import ship

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", None, "a", "   ", "it's we'll 'tis ''s", "x" * 900, " " * 700 + "end", "tab\t\t  two\n\n\nlines  ",
    "mixed 123 déjà vu — 東京 🎉🎉 \U00010940\u0870 ok", "can't " * 300, "a\u00a0b\u2003\u2003c " * 80,
    "word " * 400, "1234567890" * 60, "\U00010940 tail " * 50, "no breaks" + "z" * 500 + " then 'll some 'r e",
]


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 12), (64, 16), (20, 30)])
def test_ids_equal_the_library_and_decode_to_the_text(spark, library, chunk, overlap):
    rows = [(i, t, "extra") for i, t in enumerate([*TEXTS, TEXTS[5], TEXTS[8]])]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, Decoded_bytes string")
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    found = {r.doc_id: r for r in bpe.decode(coded, PATH).collect()}
    assert sorted(found) == [r[0] for r in rows]
    for i, text, extra in rows:
        assert found[i].ids == library.encode_ordinary(text or ""), text
        assert bytes(found[i].decoded) == (text or "").encode()
        assert found[i].Decoded_bytes == extra


def test_empty_table_and_null_keys(spark, library):
    empty = ship(spark).createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0
    keyless = spark.createDataFrame([(None, "same text " * 9), (None, "same text " * 9)], "doc_id long, text string")
    found = bpe.encode(keyless, PATH, public_tokenizers.PATTERN, chunk=32, overlap=8).collect()
    assert [r.ids for r in found] == [library.encode_ordinary("same text " * 9)] * 2


def test_a_clashing_column_is_refused(spark):
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([("a", 1)], "text string, IDS int"), PATH, public_tokenizers.PATTERN)


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (20, 30), (9, 7), (bpe.CHUNK, bpe.OVERLAP)])
def test_stitched_pre_tokens_equal_those_of_the_whole_text(chunk, overlap):
    code = bpe.encoder(PATH, public_tokenizers.PATTERN)
    for text in [t for t in TEXTS if t] + ["ab cd " * 900 + " " * 3000 + "x" * 5000 + " end of it"]:
        assert code.stitched(text, chunk, overlap) == code.pieces(text)


def test_a_clash_with_the_decoded_column_is_refused(spark):
    with pytest.raises(ValueError):
        bpe.decode(spark.createDataFrame([([1], 1)], "ids array<int>, Decoded int"), PATH)
