"""Bigram language model by deleted interpolation, and the score of every text under it.

P(w | v) = l2 c(vw)/c(v) + l1 c(w)/N + l0 / (V + 1), with weights that depend on how often the
context v was seen.  Training texts are counted in two parts; the weights are learned by
expectation-maximisation on the smaller part, with the counts of the larger one, and the scores then
use the counts of both.  Tokens are lower-cased words and one end per text, which is also the context
of a text's first token.

Counting works on chunks of a few million tokens.  A chunk sends each distinct word and bigram once,
as a sorted list of hashes cut by range; a task that has one range from all chunks adds them up and
sends the sums back in the same order.  So no context is hot, and nothing is held whole anywhere.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bounded_batches, stage, text_or_empty

#: Tokens after which a chunk ends, with its text.
CHUNK_TOKENS = 1_000_000
#: The fifth of the texts that is not learned from, and the one that the weights are learned on.
HELD_OUT, TUNED_ON = 1, 2
#: Context frequencies are grouped by powers of two, up to this one.
GROUPS = 24
#: Steps an octave at which the driver sees the ratios of the estimates to the uniform one.
STEPS, OCTAVES = 4, 48
ROUNDS = 40

_END = xxhash.xxh64_intdigest(b"\n")


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return struct.pack("<q", len(numbers)) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", packed)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[8:]), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def _blob(*parts: bytes) -> bytes:
    return struct.pack(f"<{len(parts) + 1}q", len(parts), *map(len, parts)) + b"".join(parts)


def _parts(blob: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<q", blob)
    sizes, at, out = struct.unpack_from(f"<{n}q", blob, 8), 8 + 8 * n, []
    for s in sizes:
        out.append(blob[at : at + s])
        at += s
    return out


class Chunk:
    """Some texts: the hashes of their words in order, the tokens as places in that list, and the texts' folds."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, folds: np.ndarray):
        self.words, self.tokens, self.lengths, self.folds = words, tokens, lengths, folds

    @classmethod
    def of(cls, texts: list[list[bytes]], folds: list[int]) -> Chunk:
        seen: dict[bytes, int] = {}
        flat: list[int] = []
        for words in texts:
            flat += [seen.setdefault(w, len(seen) + 1) for w in words]
            flat.append(0)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([_END, *map(digest, seen)], np.uint64)
        words, place = np.unique(hashes, return_inverse=True)
        return cls(words, place[np.array(flat, np.int64)].astype(np.int64), np.array([len(t) + 1 for t in texts], np.int64), np.array(folds, np.int64))

    def packed(self) -> bytes:
        return _blob(pack_sorted(self.words), pack(self.tokens), pack(self.lengths), pack(self.folds))

    @classmethod
    def unpacked(cls, blob: bytes) -> Chunk:
        words, tokens, lengths, folds = _parts(blob)
        return cls(unpack_sorted(words), unpack(tokens).astype(np.int64), unpack(lengths).astype(np.int64), unpack(folds).astype(np.int64))

    def fold_of_token(self) -> np.ndarray:
        return np.repeat(self.folds, self.lengths)

    def contexts(self) -> np.ndarray:
        """The token before each token; a text's first one follows an end."""
        end = int(np.searchsorted(self.words, np.uint64(_END)))
        before = np.append(end, self.tokens[:-1])[: len(self.tokens)]
        return before

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the distinct bigrams, and for each token the place of its bigram."""
        size = len(self.words)
        codes, which = np.unique(self.contexts() * size + self.tokens, return_inverse=True)
        with np.errstate(over="ignore"):
            a, b = self.words[codes // size], self.words[codes % size]
            mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b << np.uint64(31)) | (b >> np.uint64(33)))
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        keys, place = np.unique(mixed, return_inverse=True)
        return keys, place[which]

    def counts(self, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """How often each place occurs in texts that are counted, and in those tuned on."""
        fold = self.fold_of_token()
        tuned = fold == TUNED_ON
        counted = ~tuned & (fold != HELD_OUT)
        return np.bincount(place[counted], minlength=size), np.bincount(place[tuned], minlength=size)


def _chunk_task(chunk_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, keys, texts, folds, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close():
            chunk = Chunk.of(texts, folds)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + place], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([chunk.packed()], pa.binary())], names=["chunk", "keys", "data"]
            )

        for batch in batches:
            for key, text, fold in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                words = text.lower().split()
                keys.append(key)
                texts.append(words)
                folds.append(fold)
                held += len(words) + 1
                if held >= chunk_tokens:
                    yield close()
                    place, keys, texts, folds, held = place + 1, [], [], [], 0
        if keys:
            yield close()

    return run


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in sorted keys; the last element is their number."""
    edges = np.array([-(-(i << 64) // ranges) for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def _send_task(ranges: int):
    """Chunks -> one row per chunk and range: words and bigrams with both counts."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunk = Chunk.unpacked(data)
                keys, place = chunk.bigrams()
                kinds = [(chunk.words, *chunk.counts(chunk.tokens, len(chunk.words))), (keys, *chunk.counts(place, len(keys)))]
                cuts = [_ranges(k, ranges) for k, _, _ in kinds]
                rows = []
                for r in range(ranges):
                    spans = [slice(c[r], c[r + 1]) for c in cuts]
                    if any(s.start < s.stop for s in spans):
                        rows.append((r, _blob(*[f(x[s]) for (k, a, b), s in zip(kinds, spans) for f, x in ((pack_sorted, k), (pack, a), (pack, b))])))
                for begin in range(0, len(rows), 64):
                    some = rows[begin : begin + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in some], pa.int64()), pa.array([name] * len(some), pa.int64()), pa.array([x for _, x in some], pa.binary())], names=["part", "chunk", "data"])

    return run


def _sum_task(batches):
    """Rows of one range after another -> the same rows with the sums of all chunks; the first row of a range also has its numbers of distinct words."""
    current, names, rows = None, [], []

    def added():
        if not rows:
            return
        out = [[] for _ in rows]
        distinct = []
        for kind in (0, 3):
            keys = [unpack_sorted(r[kind]) for r in rows]
            every, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = []
            for k in (1, 2):
                own = np.concatenate([unpack(r[kind + k]) for r in rows]).astype(np.float64)
                sums.append(np.bincount(place, own, minlength=len(every)).astype(np.int64))
            if kind == 0:
                distinct = [int((sums[0] > 0).sum()), int((sums[0] + sums[1] > 0).sum())]
            stops = np.cumsum([len(k) for k in keys])
            for i, (stop, k) in enumerate(zip(stops, keys)):
                at = place[stop - len(k) : stop]
                out[i] += [pack(sums[0][at]), pack(sums[1][at])]
        for i, name in enumerate(names):
            yield pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([name], pa.int64()), pa.array([_blob(*out[i])], pa.binary()), *(pa.array([d if i == 0 else 0], pa.int64()) for d in distinct)],
                names=["part", "chunk", "data", "n_counted", "n_learned"],
            )

    for batch in batches:
        for part, name, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if part != current:
                yield from added()
                current, names, rows = part, [], []
            names.append(name)
            rows.append(_parts(data))
    yield from added()


def _merge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, part, keys, data), each chunk before its sums -> one row per chunk with both."""
    name, chunk, keys, sums = None, None, None, []

    def merged():
        if chunk is not None:
            data = _blob(chunk, *[pack(np.concatenate(x)) for x in zip(*sums)])
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([data], pa.binary())], names=["chunk", "keys", "data"])

    for batch in batches:
        for own, part, listed, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if part < 0:
                yield from merged()
                name, chunk, keys, sums = own, data, listed, []
            else:
                sums.append([unpack(x) for x in _parts(data)])
    yield from merged()


def _together(batches: Iterator[pa.RecordBatch]):
    """Chunks with their keys and the sums for their words (counted, tuned on) and bigrams (the same)."""
    for batch in batches:
        for keys, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            chunk, *sums = _parts(data)
            yield Chunk.unpacked(chunk), keys, [unpack(x).astype(np.int64) for x in sums]


def _estimates(pair, context, word, total, distinct):
    """Ratios of both maximum-likelihood estimates to the uniform one, and the group of the context's frequency."""
    uniform = 1.0 / (distinct + 1)
    two = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0) / uniform
    one = word / max(total, 1) / uniform
    group = np.minimum(np.log2(np.maximum(context, 0.5)).astype(np.int64) + 1, GROUPS - 1)
    return two, one, np.where(context > 0, group, 0), uniform


def _tune_task(total: int, distinct: int):
    def run(batches):
        for chunk, _, (word_a, _, pair_a, _) in _together(batches):
            chosen = np.flatnonzero(chunk.fold_of_token() == TUNED_ON)
            if not len(chosen):
                continue
            _, place = chunk.bigrams()
            two, one, group, _ = _estimates(pair_a[place][chosen], word_a[chunk.contexts()][chosen], word_a[chunk.tokens][chosen], total, distinct)

            def step(x):
                return np.where(x > 0, np.clip(np.round(np.log2(np.maximum(x, 1e-12)) * STEPS) + STEPS * OCTAVES // 4, 0, STEPS * OCTAVES - 1) + 1, 0).astype(np.int64)

            code, n = np.unique((group * (STEPS * OCTAVES + 1) + step(two)) * (STEPS * OCTAVES + 1) + step(one), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    return run


def learn(cells: list[tuple[int, int]]) -> np.ndarray:
    """Weights by group of context frequency, by expectation-maximisation on counted cells."""
    weights = np.tile([0.5, 0.4, 0.1], (GROUPS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if not cells:
        return weights
    code, n = (np.array(x, np.int64) for x in zip(*cells))
    size = STEPS * OCTAVES + 1

    def value(step):
        return np.where(step > 0, 2.0 ** ((step - 1 - STEPS * OCTAVES // 4) / STEPS), 0.0)

    group = code // (size * size)
    ratios = np.stack([value(code // size % size), value(code % size), np.ones(len(code))], 1)
    for _ in range(ROUNDS):
        share = weights[group] * ratios
        share *= (n / share.sum(1))[:, None]
        for g in range(GROUPS):
            own = share[group == g].sum(0)
            if own.sum() > 0:
                # One more event of the starting mixture keeps every weight above zero.
                weights[g] = (own + np.array([0.1 if g else 0.0, 0.1, 0.1])) / (own.sum() + (0.3 if g else 0.2))
    return weights


def _score_task(total: int, distinct: int, weights: np.ndarray):
    def run(batches):
        for chunk, keys, (word_a, word_b, pair_a, pair_b) in _together(batches):
            _, place = chunk.bigrams()
            word = (word_a + word_b).astype(np.float64)
            c = word[chunk.tokens]
            two, one, group, uniform = _estimates((pair_a + pair_b)[place].astype(np.float64), word[chunk.contexts()], c, total, distinct)
            w = weights[group]
            logs = np.log10((w[:, 0] * two + w[:, 1] * one + w[:, 2]) * uniform)
            base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            begins = np.cumsum(chunk.lengths) - chunk.lengths
            known = np.add.reduceat((c > 0).astype(np.int64), begins)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(chunk.folds == HELD_OUT), pa.array(chunk.lengths), pa.array(known), pa.array(np.full(len(keys), total), pa.int64()), pa.array(np.add.reduceat(base, begins)), pa.array(np.add.reduceat(logs, begins))],
                names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def _tokens_task(batches):
    for batch in batches:
        for data in batch.column(0).to_pylist():
            chunk = Chunk.unpacked(data)
            counted = int(chunk.lengths[(chunk.folds != HELD_OUT) & (chunk.folds != TUNED_ON)].sum())
            learned = int(chunk.lengths[chunk.folds != HELD_OUT].sum())
            yield pa.RecordBatch.from_arrays([pa.array([counted], pa.int64()), pa.array([learned], pa.int64())], names=["counted", "learned"])


def score(documents: DataFrame, key: str = "doc_id", text: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per document: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities).

    A document's fold is crc32 of its key, as text, modulo five; a null key counts as the empty text.
    A null text has only its end.  Repeated rows are counted and scored each.  Without any training
    text all estimates but the uniform one are zero.
    """
    fold = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 5
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").cast("long"), text_or_empty(text), fold.cast("int"))
    chunks = stage(rows.mapInArrow(_chunk_task(chunk_tokens), "chunk long, keys array<long>, data binary"), "chunks")
    ranges = max(chunks.count(), 1)
    sizes = chunks.select("data").mapInArrow(_tokens_task, "counted long, learned long").agg(F.sum("counted"), F.sum("learned")).first()
    counted, learned = (x or 0 for x in sizes)

    sent = chunks.select("chunk", "data").mapInArrow(_send_task(ranges), "part long, chunk long, data binary")
    by_range = sent.repartition("part").sortWithinPartitions("part", "chunk")
    sums = stage(by_range.mapInArrow(_sum_task, "part long, chunk long, data binary, n_counted long, n_learned long"), "sums")
    n_counted, n_learned = (x or 0 for x in sums.agg(F.sum("n_counted"), F.sum("n_learned")).first())

    own = chunks.select("chunk", F.lit(-1).cast("long").alias("part"), "keys", "data")
    back = sums.select("chunk", "part", F.lit(None).cast("array<long>").alias("keys"), "data")
    whole = stage(own.unionByName(back).repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(_merge_task, "chunk long, keys array<long>, data binary"), "counted")

    # At most GROUPS times (STEPS * OCTAVES + 1) squared cells, whatever the input.
    cells = whole.mapInArrow(_tune_task(counted, n_counted), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    weights = learn(sorted((r.code, r.n) for r in cells))
    result = whole.mapInArrow(_score_task(learned, n_learned, weights), "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return result.withColumnRenamed("key", key)
