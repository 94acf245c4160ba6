"""Spelling variants: words of a corpus that differ by one letter, found with Bloom filters.

Words are counted over all texts.  The vocabulary is hashed into blocked Bloom filters, sharded by
word length; each task generates the words that one deletion or replacement makes of its own words and
probes them.  Only what a filter knows is spelled out and shuffled, to a join with the vocabulary that
drops false positives.  An insertion is the deletion of the other word, and a replacement is tried in
the direction of the later letter only, so each near pair is found once and then read both ways.

Hashes of words combine one random number per place and letter by exclusive or, so that the hash of an
edit follows from that of the word.  A filter has blocks of 256 bits; a word sets eight of one block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, bounded_batches, slices, stage, text_or_empty

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: One occurrence in so many, chosen by its hash, loses a letter.
DROP_EVERY = 97
#: Bits of a filter per word, blocks in one stored piece, bytes of pieces that are broadcast at a time,
#: distinct words that a task counts before it passes them on, and edits that a task probes.
BITS_PER_WORD, PIECE_BLOCKS, PASS_BYTES, HELD, EDITS = 16, 1 << 16, 32 << 20, 100_000, 10_000_000

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
_SALT = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)  # odd multipliers, one per bit


def spelled(key: str, text: bytes) -> Counter:
    """Occurrences of the words of one text, after the letters that are left out by rule."""
    found: Counter = Counter()
    start = zlib.crc32(f"{key}:".encode())
    for run, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        found[run] += n
    return found


def _count_task(batches):
    held: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for part in slices(batch, 1):
            for key, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                for word, n in spelled(key, text).items():
                    held[word] += n
                if len(held) > HELD:
                    yield out()
    yield out()


def vocabulary(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n`` and ``length`` (code points) of all words with at least ``least`` occurrences."""
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), text_or_empty(text).alias("text"))
    counted = rows.mapInArrow(_count_task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stage(counted.select("word", "n", F.length("word").alias("length")), "vocabulary")


def _place(at, letter):
    """The random number of a letter at a place."""
    z = (np.asarray(at, np.uint64) << np.uint64(8)) + np.asarray(letter, np.uint64) + np.uint64(1)
    z *= np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def letters(words: list[str]) -> np.ndarray:
    """One row per word, all of one length; no letter is above U+00FF."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def hashes(matrix: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(_place(np.arange(matrix.shape[1]), matrix), axis=1)


def _blocks(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n blocks a hash belongs to."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _bits(h: np.ndarray, i: int) -> np.ndarray:
    """The bit that a hash sets in word i of its block."""
    return (h.astype(np.uint32) * _SALT[i]) >> np.uint32(27)


class Shard:
    """A run of blocks of the filter of one length: blocks ``first`` and on, of ``n`` in all."""

    def __init__(self, n: int, first: int, bits: bytes):
        self.n, self.first, self.words = n, first, np.frombuffer(bits, np.uint32).reshape(-1, 8)

    def known(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be in the vocabulary."""
        block = _blocks(h, self.n).astype(np.int64) - self.first
        at = np.flatnonzero((block >= 0) & (block < len(self.words)))
        h, block = h[at], block[at]
        for i in range(8):
            hit = (self.words[block, i] >> _bits(h, i)) & np.uint32(1) == 1
            at, h, block = at[hit], h[hit], block[hit]
        return at


def blocks_of(n: int) -> int:
    """Blocks of the filter for n words."""
    return max(1, -(-n * BITS_PER_WORD // 256))


def filters(words: DataFrame, sizes: dict[int, int], piece: int = PIECE_BLOCKS) -> DataFrame:
    """The filters as rows ``length``, ``piece`` and ``bits``; a row holds ``piece`` blocks at most, made in one task."""

    def hash_task(parts):
        for words, lengths in parts:
            h = np.zeros(len(words), np.uint64)
            of = lengths.to_numpy(zero_copy_only=False)
            text = np.array(words.to_pylist(), object)
            block = np.zeros(len(words), np.int64)
            for length in np.unique(of).tolist():
                at = np.flatnonzero(of == length)
                h[at] = hashes(letters(text[at].tolist()))
                block[at] = _blocks(h[at], blocks_of(sizes[length]))
            yield [pa.array(h.view(np.int64)), pa.array((block // piece).astype(np.int32))]

    def build(key, rows):
        length, at = (k.as_py() for k in key)
        h = rows.column("hash").to_numpy().view(np.uint64)
        n = blocks_of(sizes[length])
        held = np.zeros((min(piece, n - at * piece), 8), np.uint32)
        block = _blocks(h, n).astype(np.int64) - at * piece
        for i in range(8):
            np.bitwise_or.at(held, (block, i), np.uint32(1) << _bits(h, i))
        return pa.table({"length": pa.array([length], pa.int32()), "piece": pa.array([at], pa.int32()), "bits": pa.array([held.tobytes()], pa.binary())})

    hashed = add_columns(words, [F.col("word"), F.col("length")], hash_task, "hash bigint, piece int", ["length"])
    return stage(hashed.groupBy("length", "piece").applyInArrow(build, "length int, piece int, bits binary"), "filters")


def passes(sizes: dict[int, int], piece: int = PIECE_BLOCKS, limit: int = PASS_BYTES) -> list[list[tuple[int, int]]]:
    """Pieces (length, piece) in the groups that are broadcast together."""
    groups: list[list[tuple[int, int]]] = [[]]
    held = 0
    for length in sorted(sizes):
        n = blocks_of(sizes[length])
        for at in range(-(-n // piece)):
            size = 32 * min(piece, n - at * piece)
            if groups[-1] and held + size > limit:
                groups.append([])
                held = 0
            groups[-1].append((length, at))
            held += size
    return groups if groups[0] else []


def edits(matrix: np.ndarray, alphabet: np.ndarray):
    """Hashes of what one deletion or replacement makes: (letters fewer, place, new letters or None, which are edits, hashes)."""
    k, length = matrix.shape
    own = _place(np.arange(length), matrix)
    whole = np.bitwise_xor.reduce(own, axis=1)
    none = np.zeros((k, 1), np.uint64)
    before = np.bitwise_xor.accumulate(np.concatenate([none, own[:, :-1]], axis=1), axis=1)
    moved = np.concatenate([_place(np.arange(length - 1), matrix[:, 1:]), none], axis=1)
    after = np.bitwise_xor.accumulate(moved[:, ::-1], axis=1)[:, ::-1]
    for i in range(length):
        # Deleting either of two equal neighbours gives the same word.
        fresh = np.ones(k, bool) if not i else matrix[:, i] != matrix[:, i - 1]
        yield 1, i, None, fresh, before[:, i] ^ after[:, i]
        new = _place(i, alphabet)[None, :] ^ (whole ^ own[:, i])[:, None]
        yield 0, i, alphabet, alphabet[None, :] > matrix[:, i][:, None], new


def _probe_task(shards: dict[int, list[Shard]], alphabet: np.ndarray):
    """Words -> those of their edits that the shards of a pass may know."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])

    def run(batches):
        for batch in batches:
            of = batch.column(2).to_numpy(zero_copy_only=False)
            text, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy(zero_copy_only=False)
            for length in np.unique(of).tolist():
                words, counts = text[of == length], n[of == length]
                matrix, found = letters(words.tolist()), []
                for fewer, i, new, wanted, h in edits(matrix, alphabet):
                    for shard in shards.get(length - fewer, ()):
                        at = np.nonzero(wanted)
                        for p in shard.known(h[at]).tolist():
                            row = int(at[0][p])
                            word = words[row]
                            found.append((row, word[:i] + ("" if fewer else chr(new[at[1][p]])) + word[i + 1 :]))
                if found:
                    rows, others = zip(*found)
                    rows = np.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(words[rows].tolist(), pa.string()), pa.array(counts[rows], pa.int64()), pa.array(others, pa.string())], schema=schema)

    return run


def near_words(words: DataFrame, piece: int = PIECE_BLOCKS, limit: int = PASS_BYTES) -> DataFrame:
    """``word``, ``n``, ``other`` and ``other_n`` of all pairs that one letter tells apart, in both directions.

    The driver holds the number of words of each length, at most ninety letters, and one group of
    filter pieces of at most ``limit`` bytes, which is what is broadcast.  A vocabulary of any size is
    probed group by group; each group is a written table.
    """
    spark = words.sparkSession
    sizes = {r.length: r.n for r in words.groupBy("length").agg(F.count("*").alias("n")).collect()}
    used = sorted(r.letter for r in words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").distinct().collect())
    alphabet = np.array([ord(c) for c in used], np.uint8)
    pieces = filters(words, sizes, piece) if sizes else None
    # Few bytes of words make many edits, so tasks are counted by these.
    dealt = words.repartition(1 + sum(n * length * (1 + len(used) // 2) for length, n in sizes.items()) // EDITS, "word")
    found = []
    for group in passes(sizes, piece, limit):
        wanted = reduce(lambda a, b: a | b, [F.col("length").isin([n for n, at in group if at == k]) & (F.col("piece") == k) for k in sorted({at for _, at in group})])
        shards: dict[int, list[Shard]] = {}
        for r in pieces.where(wanted).orderBy("length", "piece").collect():
            shards.setdefault(r.length, []).append(Shard(blocks_of(sizes[r.length]), r.piece * piece, bytes(r.bits)))
        sent = spark.sparkContext.broadcast(shards)
        lengths = sorted({n + d for n in shards for d in (0, 1) if n + d in sizes})
        task = lambda batches, sent=sent: _probe_task(sent.value, alphabet)(batches)
        found.append(stage(dealt.where(F.col("length").isin(lengths)).select("word", "n", "length").mapInArrow(task, "word string, n bigint, other string"), "probed"))
        sent.unpersist()
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).where("false")
    probed = reduce(DataFrame.unionByName, found)
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = stage(probed.join(known, "other").select("word", "n", "other", "other_n"), "near")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form reached from it, for words with a form.

    A form has twice the occurrences of its word, so chains are short and end; each round doubles
    the steps that a word has gone.
    """
    state = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("root").alias("next"))
        state = stage(state.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_COUNT, piece: int = PIECE_BLOCKS, limit: int = PASS_BYTES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each word of the corpus.

    A word is a lower-cased run of Latin letters of at least five code points (A-Z are lowered, other
    letters stay), seen at least ``least`` times.  Its form is the near word with most occurrences, the
    least in code-point order of equal ones, if these are twice its own; its root is where following
    forms ends, itself without one.  Null and empty texts have no words; a null key counts as the empty
    text in the rule that leaves letters out; repeated rows count again.  Texts and words of any
    length are read whole.  Other columns are not read; an empty table gives an empty result.
    """
    words = vocabulary(documents, key, text, least)
    near = near_words(words, piece, limit)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = words.select("word", "n").join(best, "word", "left")
    fits = -F.col("best.less") >= RATIO * F.col("n")
    judged = stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    ), "forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
