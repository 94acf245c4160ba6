"""Ids of whole texts by a byte-level tokenizer file, with each distinct piece of text encoded once per task."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from .frames import add_columns, text_or_empty

#: Words whose ids a worker remembers, half of them for having come again.  This bounds memory, not the result.
REMEMBERED = 500_000

# Where cutting before a blank, line feed, comma or stop could part what the split keeps together.
_SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNSAFE = rf"[{_SPACE}][ \n]|[^\pL\pN][.,]"
_WORD_START = rf"([^{_SPACE}]) "
_word_start = re.compile(r"(?<=\S)(?= )")
#: Words that are encoded as one text, in a row.
ROW = 2000

#: The split that the plain words rely on.
_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_OPTIONS = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
# One match of that split, or a line feed and one.
_plain = re.compile(r"[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+")
_printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Characters that stand for bytes in a byte-level vocabulary; a zero byte marks an end here.
_LETTERS = dict(zip(_printed, _printed)) | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _printed)} | {0: 0}


@functools.lru_cache(maxsize=2)
def tokenizer(definition: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_str(definition)
    # Special tokens' names in a text are ordinary text.
    made.encode_special_tokens = True
    return made


def plain_words(tok: Tokenizer) -> Tokenizer | None:
    """The same merges for words in the vocabulary's own letters, parted by zero bytes; None where another split holds.

    It has no cache, since no word comes twice.
    """
    made = json.loads(tok.to_str())
    model, split = made["model"], made["pre_tokenizer"] or {}
    if made["normalizer"] or model["type"] != "BPE" or any(model.get(k) for k in _OPTIONS) or any(split.get(k) != v for k, v in _SPLIT.items()):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    words = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0))
    words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
    return words


class Words:
    """Packed ids by piece of text.

    Pieces are cut where no match of the byte-level split can reach across: before white space
    that follows something else, and between a letter or digit and the punctuation after it.  So
    they encode on their own, and as well in a row, as long as each begins with white space and
    the one before does not end with it.  Words of letters alone need no split.
    """

    def __init__(self, tok: Tokenizer):
        self.tok, self.words = tok, plain_words(tok)
        # Pieces that came again, and those that came once; the latter go where too many are.
        self.ids: dict[str, bytes] = {"": b""}
        self.once: dict[str, bytes] = {}
        vocabulary = tok.get_vocab()
        # A token of a byte-level vocabulary has one character for each byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)

    def of(self, pieces: list[str]) -> list[bytes]:
        """The ids of these pieces, which differ."""
        found = list(map(self.ids.get, pieces))
        fresh = [i for i, x in enumerate(found) if x is None]
        if len(self.ids) > REMEMBERED // 2:
            self.ids, self.once = {"": b""}, self.ids
        unknown = []
        for i in fresh:
            p = pieces[i]
            x = self.once.pop(p, None)
            if x is None:
                unknown.append(i)
            else:
                found[i] = self.ids[p] = x
        if len(self.once) > REMEMBERED // 2:
            self.once = {}
        self._learn([pieces[i] for i in unknown])
        for i in unknown:
            found[i] = self.once[pieces[i]]
        return found

    def _learn(self, pieces: list[str]) -> None:
        plain, rest = [], []
        for p in pieces:
            if self.words is not None and _plain.fullmatch(p):
                plain.append(p)
            elif p[0] not in " \n" or p[-1].isspace():
                self.once[p] = np.array(self.tok.encode(p, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                rest.append(p)
        for begin in range(0, len(plain), ROW):
            row = plain[begin : begin + ROW]
            self._row(row, self.words, "\0".join(row).replace("\n", "\n\0").encode().decode("latin-1").translate(_LETTERS))
        for begin in range(0, len(rest), ROW):
            row = rest[begin : begin + ROW]
            self._row(row, self.tok, "".join(row))

    def _row(self, row: list[str], tok: Tokenizer, text: str) -> None:
        ids = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in row])
        cuts = (np.searchsorted(np.cumsum(self.sizes[ids]), stops) + 1) * 4
        packed, at = ids.tobytes(), 0
        for p, stop in zip(row, cuts.tolist()):
            self.once[p] = packed[at:stop]
            at = stop


@functools.lru_cache(maxsize=2)
def memory(definition: str) -> Words:
    return Words(tokenizer(definition))


def pieces_of(texts: pa.Array) -> pa.ListArray:
    """The pieces of each text, none of them null."""
    if pc.any(pc.match_substring(texts, "\0")).as_py():
        return pa.array([_word_start.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    marked = texts
    for c in " \n,.":
        marked = pc.replace_substring(marked, c, f"\0{c}")
    unsafe = pc.match_substring_regex(texts, _UNSAFE)
    if pc.any(unsafe).as_py():
        marked = pc.replace_with_mask(marked, unsafe, pc.replace_substring_regex(texts.filter(unsafe), _WORD_START, "\\1\0 "))
    return pc.split_pattern(marked, "\0")


def packed(known: Words, texts: pa.Array, end: bytes) -> pa.Array:
    """Little-endian 32-bit ids of each text, none of them null, with ``end`` behind them."""
    split = pieces_of(texts)
    offsets = split.offsets.to_numpy()
    coded = split.flatten().dictionary_encode()
    pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    values = pa.array([*known.of(pieces), end], pa.binary())
    # Each text's pieces stand together, so their bytes do; behind the last one comes the end.
    codes = np.insert(coded.indices.to_numpy(), offsets[1:] - offsets[0], len(pieces))
    found = values.take(pa.array(codes))
    stops = np.frombuffer(found.buffers()[1], np.int32)[: len(codes) + 1][offsets - offsets[0] + np.arange(len(offsets))]
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(stops.astype(np.int32)), found.buffers()[2]])


def pack(known: Words, texts: list[str], end: bytes) -> list[bytes]:
    """``packed`` of a list."""
    return packed(known, pa.array(texts, pa.string()), end).to_pylist()


def encode(df: DataFrame, definition_path: str, end_id: int | None, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit ids of the whole text, then ``end_id``).

    Null is the empty text, which has only the end id.  The tokenizer file is read on the driver
    and sent to the tasks; it has the size of a vocabulary.  Repeated rows are encoded alike.
    """
    with open(definition_path, encoding="utf-8") as file:
        definition = df.sparkSession.sparkContext.broadcast(file.read())
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def task(columns):
        known = memory(definition.value)
        for (texts,) in columns:
            yield [packed(known, texts.cast(pa.string()), end)]

    return add_columns(df, [text_or_empty(text)], task, f"`{ids}` binary")
