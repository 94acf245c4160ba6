from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import documents, folder
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayline.llm import bitplanes, queries, tokens

DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  two  spaces ", "one two\nthree \n four\t five", "naïve 漢字 \xa0 x \xa0y", " lead", "trail ", "<|endoftext|> a", "same", "same", "a b " * 20_000, "q" * 50_000, " " * 3000,
]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(DEFINITION)
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 9, 1000])
def test_planes_round_trip(unit, count):
    ids = np.random.default_rng(count).integers(0, 2**32, count, dtype=np.uint32)
    planes = bitplanes.planes_of(ids, unit)
    assert len(planes) == bitplanes.UNITS[unit]
    assert bitplanes.ids_of(planes, count).tolist() == ids.tolist()
    if unit == "bit" and count:
        assert np.unpackbits(np.frombuffer(planes[5], np.uint8), count=count).tolist() == ((ids >> 5) & 1).tolist()
    if unit == "byte":
        assert planes[1] == bytes(((ids >> 8) & 255).astype(np.uint8))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-(2**63), 2**63 - 1), st.lists(st.integers(0, 2**32 - 1), max_size=40)), max_size=6), st.sampled_from(["byte", "bit"]))
def test_file_round_trip(rows, unit):
    keys, sequences = [k for k, _ in rows], [struct.pack(f"<{len(s)}I", *s) for _, s in rows]
    old, bitplanes.BLOCK_IDS = bitplanes.BLOCK_IDS, 16
    try:
        content = bitplanes.file_bytes(3, 4, keys, sequences, unit)
    finally:
        bitplanes.BLOCK_IDS = old
    for body in (content, content + b"\n"):
        assert bitplanes.read_file(body) == (3, 4, keys, sequences)


def test_a_damaged_file_is_refused():
    content = bytearray(bitplanes.file_bytes(0, 0, [1], [b"\1\0\0\0"]))
    content[-25] ^= 1
    with pytest.raises(ValueError):
        bitplanes.read_file(bytes(content))
    with pytest.raises(ValueError):
        bitplanes.read_file(b"")


def test_query(spark, tmp_path, plain):
    sf = folder(spark, tmp_path, documents=documents(spark, TEXTS))
    got = queries.bit_planes(spark, sf).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(len(TEXTS)))
    start = 0
    for r, text in zip(got, TEXTS):
        ids = plain(text or "")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_many_files_keep_order_ties_and_nulls(spark, tmp_path, unit):
    rows = [(None if i < 2 else i // 3, f"text {i}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(7)
    ids = tokens.encode(bitplanes.ordered(df, tie=F.col("text")), DEFINITION, None)
    path = str(tmp_path / unit)
    bitplanes.write(ids, path, unit=unit, file_ids=5)
    back = bitplanes.read(spark, path).orderBy("shard", "place", "position").collect()
    assert [r.doc_id for r in back] == sorted((k for k, _, _ in rows), key=lambda k: (k is not None, k))
    summary = bitplanes.summary(spark, path).collect()
    at = sorted((r.start, r.n_tokens) for r in summary)
    assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:]))


def test_empty_table(spark, tmp_path):
    bitplanes.write(tokens.encode(documents(spark, []), DEFINITION, 2), str(tmp_path / "none"))
    assert bitplanes.summary(spark, str(tmp_path / "none")).count() == 0


def test_remembering_fewer_words_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    known = tokens.Words(tokens.tokenizer(open(DEFINITION, encoding="utf-8").read()))
    texts = ["a b c d e", "f g a b", "", "h  i j", "a b c d e f g"]
    for t in texts:
        packed = tokens.pack(known, [t], b"")[0]
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == plain(t)[:-1]


def test_texts_of_any_kind_encode_as_the_library_does(plain):
    known = tokens.Words(tokens.tokenizer(open(DEFINITION, encoding="utf-8").read()))
    assert known.words is not None
    texts = [
        *(t or "" for t in TEXTS[:-3]), "Größe\nÑandú, naïve. x", "a\0 b\0\0c , d", "\0", "end.\n\nNew ###, 'tis don't I'LL 12.5 x1 _a.", " 　 a  b\x85\nc", ", .", "\n", "é.è,ù\nß × ÷", "Ⅳ.² 漢. x", "ª º µ\nª",
    ]
    got = tokens.pack(known, texts, b"\2\0\0\0")
    assert got == [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert tokens.pack(known, texts[3:5], b"") == [g[:-4] for g in got[3:5]] and tokens.pack(known, [], b"") == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t,.'!_\0\x1c\x85\xa0 aZéßª²×sll1漢Ⅳ́")), max_size=4))
def test_any_cut_is_safe(plain, texts):
    known = tokens.memory(open(DEFINITION, encoding="utf-8").read())
    assert tokens.pack(known, texts, b"\2\0\0\0") == [np.array(plain(t), "<u4").tobytes() for t in texts]


def test_words_in_use_stay_known_when_many_have_come(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    known = tokens.Words(tokens.tokenizer(open(DEFINITION, encoding="utf-8").read()))
    learnt = []
    row = known._row
    monkeypatch.setattr(known, "_row", lambda pieces, *rest: (learnt.extend(pieces), row(pieces, *rest)))
    for i in range(40):
        tokens.pack(known, [f"x the same words come again word{i}a word{i}b word{i}c"], b"")
    assert learnt.count(" same") == 1 and len(known.ids) <= 100
