from __future__ import annotations

import base64
import hashlib
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from llm.fixtures import documents, folder

from assayline.llm import bpe, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "Hello  world\n\n  it's 12345!?", "naïve Grüße 漢字 　 x", "a" * 9000, " " * 9000, "x" + "\t" * 9000 + "y", " " * 5000 + "end " * 40000,
    "wörd, " * 30000, "<|endoftext|>", "same", "same",
]


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pattern = regex.compile(public_tokenizers.PATTERN)
    return lambda text: [i for m in pattern.finditer(text) for i in enc._encode_single_piece(m.group())]


def test_every_match_is_encoded_on_its_own(spark, plain, tmp_path):
    sf = folder(spark, tmp_path, documents=documents(spark, TEXTS))
    got = {r.doc_id: r for r in queries.byte_bpe(spark, sf).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = plain(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_long_white_space_needs_no_backtracking(spark):
    enc = bpe.encoding(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    text = "a" + " " * 2_000_000 + "b"
    assert enc.decode_bytes(bpe.encode_text(enc, text)) == text.encode()


def test_bad_ids_decode_to_null_and_names_may_clash(spark):
    df = spark.createDataFrame([(1, b"\xff\xff\xff\x7f"), (2, b"\x01"), (3, None), (4, b"")], "decoded int, token_ids binary")
    assert [r.decoded for r in bpe.decode(df, RANKS, public_tokenizers.PATTERN).collect()] == [None, None, None, b""]
    clash = spark.createDataFrame([("hi", "old", 5)], "text string, N_TOKENS string, kept int")
    row = bpe.encode(clash, RANKS, public_tokenizers.PATTERN).first()
    assert (row.n_tokens, row.kept) == (1, 5)


def test_empty_table(spark):
    assert bpe.encode(documents(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_round_trip_in_one_task_equals_encode_and_decode(spark):
    import public_tokenizers
    from llm.fixtures import documents

    from assayline.llm import bpe

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    df = documents(spark, [None, "", "one two", "é漢𝄞 \n\n  x", "a b " * 30_000, " " * 10_000, "one two"])
    got = {r.doc_id: (bytes(r.token_ids), r.n_tokens, r.decodes) for r in bpe.round_trip(df, ranks, pattern).collect()}
    both = bpe.decode(bpe.encode(df, ranks, pattern), ranks, pattern).collect()
    assert got == {r.doc_id: (bytes(r.token_ids), r.n_tokens, bytes(r.decoded) == (r.text or "").encode()) for r in both}
    assert all(x[2] for x in got.values())
