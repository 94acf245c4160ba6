"""Byte-level byte-pair encoding by a local rank file, and decoding to raw bytes."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, text_or_empty

# The characters with Unicode's White_Space property, which is what \s means to
# the splitting pattern.
SPACES = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Texts above this many characters are cut where no match of the pattern can reach across.
PART_CHARS = 1 << 16
#: The pattern's look-ahead backs up over white space; longer runs are taken out of its hands.
LONG_RUN = 1 << 12

_cut = re.compile(f"(?<=[^{SPACES}])(?=[{SPACES}])")
_long_run = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")


@functools.lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    merged = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, ranks.split(b"\n")))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merged, special_tokens={})


def parts(text: str) -> Iterator[tuple[bool, str]]:
    """Cut a text into parts that encode on their own; true marks a part that is one match.

    A match never runs from a non-space into white space, so every such place is safe.  Of a run
    of white space the pattern takes all but the last character, or all at the end of the text.
    """
    begin = 0
    for run in _long_run.finditer(text) if len(text) > LONG_RUN else ():
        yield from ((False, p) for p in _plain(text[begin : run.start()]))
        begin = run.end() if run.end() == len(text) else run.end() - 1
        yield True, text[run.start() : begin]
    yield from ((False, p) for p in _plain(text[begin:]))


def _plain(text: str) -> Iterator[str]:
    begin = 0
    while len(text) - begin > PART_CHARS:
        cut = _cut.search(text, begin + PART_CHARS)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    if begin < len(text):
        yield text[begin:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    ids: list[int] = []
    for single, part in parts(text):
        ids += enc._encode_single_piece(part) if single else enc.encode_ordinary(part)
    return ids


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids", count: str = "n_tokens") -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit ids) and ``count`` (long).

    The rank file is read once on the driver and sent to the tasks; it has the size of a
    vocabulary.  A null or empty text has no ids.  Texts of any length are encoded whole, without
    special tokens.  Rows stay where they are, repeated ones included.
    """
    with open(ranks_path, "rb") as file:
        ranks = df.sparkSession.sparkContext.broadcast(file.read())

    def task(columns):
        enc = encoding(ranks.value, pattern)
        for (texts,) in columns:
            each = [np.array(encode_text(enc, t), "<u4") for t in texts.to_pylist()]
            yield [pa.array([x.tobytes() for x in each], pa.binary()), pa.array([len(x) for x in each], pa.int64())]

    return add_columns(df, [text_or_empty(text)], task, f"`{ids}` binary, `{count}` bigint")


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded`` (binary), the bytes of all ids joined; they need not be valid UTF-8.

    Null ids decode to null, and so do ids outside the vocabulary or a broken length.
    """
    with open(ranks_path, "rb") as file:
        ranks = df.sparkSession.sparkContext.broadcast(file.read())

    def task(columns):
        enc = encoding(ranks.value, pattern)

        def bytes_of(packed):
            if packed is None or len(packed) % 4:
                return None
            try:
                return enc.decode_bytes(np.frombuffer(packed, "<u4").tolist())
            except KeyError:
                return None

        for (packed,) in columns:
            yield [pa.array(map(bytes_of, packed.to_pylist()), pa.binary())]

    return add_columns(df, [F.col(f"`{ids}`")], task, f"`{decoded}` binary")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids", count: str = "n_tokens", decodes: str = "decodes") -> DataFrame:
    """``encode``, and whether ``decode`` gives the bytes of the text again (``decodes``), in one task.

    Encoding and decoding one after the other would hold two workers with a vocabulary each per task.
    """
    with open(ranks_path, "rb") as file:
        ranks = df.sparkSession.sparkContext.broadcast(file.read())

    def task(columns):
        enc = encoding(ranks.value, pattern)
        for (texts,) in columns:
            packed, counts, same = [], [], []
            for t in texts.to_pylist():
                own = encode_text(enc, t)
                packed.append(np.array(own, "<u4").tobytes())
                counts.append(len(own))
                same.append(enc.decode_bytes(np.frombuffer(packed[-1], "<u4").tolist()) == t.encode())
            yield [pa.array(packed, pa.binary()), pa.array(counts, pa.int64()), pa.array(same, pa.bool_())]

    return add_columns(df, [text_or_empty(text)], task, f"`{ids}` binary, `{count}` bigint, `{decodes}` boolean")


def digest(column: Column) -> Column:
    return F.sha2(column, 256)
