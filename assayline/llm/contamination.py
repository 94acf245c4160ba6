"""Benchmark passages in training documents, found by searching suffix arrays of the documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, bounded_batches, slices, stage, text_or_empty, tidy
from .suffixes import suffix_levels

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: Bytes of benchmark text that are sent to the tasks at a time.  More is searched in further
#: passes, so that what a task holds has a bound while every item meets every document.
BLOCK_BYTES = 4 << 20

_letters = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(_letters).split()


@dataclass
class Items:
    """A block of benchmark items, numbered, with its distinct windows."""

    vocabulary: dict[bytes, int]  # from 1; 0 is any other word
    words: np.ndarray
    starts: np.ndarray  # of each distinct window in ``words``
    widths: np.ndarray
    first: np.ndarray  # window k occurs in items[first[k] : first[k + 1]]
    items: np.ndarray
    ids: list[int | None]
    item_starts: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes]], window: int = WINDOW) -> Items:
        vocabulary: dict[bytes, int] = {}
        flat: list[int] = []
        lengths = []
        for _, text in rows:
            found = words_of(text)
            lengths.append(len(found))
            flat += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in found]
        words, sizes = np.array(flat, np.int32), np.array(lengths, np.int64)
        begins = np.cumsum(sizes) - sizes
        starts, widths, first, items = [], [], [0], []
        for width in [*sorted({int(s) for s in sizes if 0 < s < window}), window]:
            picked = np.flatnonzero(sizes >= window if width == window else sizes == width)
            count = sizes[picked] - width + 1
            owner = np.repeat(picked, count)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begins[owner]
            if not len(at):
                continue
            _, one, group = np.unique(words[at[:, None] + np.arange(width)], axis=0, return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([group.ravel(), owner], 1), axis=0)
            starts.append(at[one])
            widths.append(np.full(len(one), width))
            first += (np.searchsorted(pairs[:, 0], np.arange(1, len(one) + 1)) + len(items)).tolist()
            items += pairs[:, 1].tolist()
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return cls(vocabulary, words, join(starts), join(widths), np.array(first), np.array(items, np.int64), [k for k, _ in rows], begins)


@dataclass
class Shard:
    """The suffix array of those runs of a few documents that could hold a window.

    A word outside the benchmark's vocabulary ends every match, so runs are cut there, and runs
    shorter than the shortest window are left out.
    """

    text: np.ndarray  # the runs, each with a zero behind it
    order: np.ndarray  # their suffixes in order
    place: np.ndarray  # where a position of ``text`` lies among the words of all documents

    @classmethod
    def of(cls, numbers: np.ndarray, owner: np.ndarray, least: int) -> Shard:
        n = len(numbers)
        known = numbers > 0
        fresh = known & ~np.append([False], known[:-1] & (owner[1:] == owner[:-1]))[:n]
        begins = np.flatnonzero(fresh)
        stops = np.flatnonzero(known & ~np.append(known[1:] & (owner[1:] == owner[:-1]), [False])[:n]) + 1
        size = stops - begins
        begins, size = begins[size >= least], size[size >= least]
        total, run = int(size.sum()), np.repeat(np.arange(len(size)), size)
        inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        source = np.repeat(begins, size) + inside
        words = numbers[source]
        text, place = np.zeros(total + len(size) + 1, np.int64), np.zeros(total + len(size) + 1, np.int64)
        at = np.arange(total) + run
        text[at], place[at] = words, source
        order = suffix_levels(words, np.repeat(np.cumsum(size), size))[0] if total else np.zeros(0, np.int64)
        return cls(text, at[order] if total else order, place)

    def _bound(self, low, high, target, depth, above):
        low, high = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            value = self.text[np.minimum(self.order[middle] + depth, len(self.text) - 1)]
            right = value <= target[open_] if above else value < target[open_]
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def search(self, words: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Binary-search many test suffixes at once, a word deeper each round.

        Returns how many of each suffix's first ``widths`` words match somewhere, and the range of
        suffixes in ``order`` that share so many.
        """
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order), np.int64)
        depth, alive = np.zeros(len(starts), np.int64), np.arange(len(starts))
        if not len(self.order):
            return depth, low, low
        for d in range(int(widths.max(initial=0))):
            alive = alive[widths[alive] > d]
            if not len(alive):
                break
            target = words[starts[alive] + d].astype(np.int64)
            a = self._bound(low[alive], high[alive], target, d, False)
            b = self._bound(a, high[alive], target, d, True)
            met = a < b
            alive = alive[met]
            low[alive], high[alive], depth[alive] = a[met], b[met], d + 1
        return depth, low, high


def _numbers(items: Items, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    split = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    get = items.vocabulary.get
    numbers = np.concatenate([np.fromiter(map(get, w, repeat(0)), np.int64, len(w)) for w in split]) if split else np.zeros(0, np.int64)
    return numbers, counts


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and each value of the ranges [low, high)."""
    size = high - low
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


def hits(items: Items, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words per text, and over all texts one after another: flags of hit words; items per text."""
    numbers, counts = _numbers(items, texts)
    owner = np.repeat(np.arange(len(counts)), counts)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(counts)
    cover = np.zeros(len(numbers) + 1, np.int64)
    if len(items.starts) and len(numbers):
        shard = Shard.of(numbers, owner, int(items.widths.min()))
        depth, low, high = shard.search(items.words, items.starts, items.widths)
        full = np.flatnonzero(depth == items.widths)
        row, at = _expand(low[full], high[full])
        begin, window = shard.place[shard.order[at]], full[row]
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + items.widths[window], -1)
        pairs = np.unique(np.stack([owner[begin], window], 1), axis=0)
        row, at = _expand(items.first[pairs[:, 1]], items.first[pairs[:, 1] + 1])
        pairs = np.unique(np.stack([pairs[row, 0], items.items[at]], 1), axis=0)
        for text, part in zip(*_groups(pairs)):
            found[text] = part
    return counts, np.cumsum(cover)[:-1] > 0, owner, found


def _groups(pairs: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(pairs):
        return [], []
    cut = np.flatnonzero(np.append([True], pairs[1:, 0] != pairs[:-1, 0]))
    return pairs[cut, 0].tolist(), np.split(pairs[:, 1], cut[1:])


def blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """Benchmark items in blocks of at most BLOCK_BYTES (or one item); the driver holds one or two."""
    held, size = [], 0
    for row in benchmark.select(F.col(f"`{key}`").cast("long"), text_or_empty(text)).toLocalIterator():
        body = row[1].encode()
        if held and size + len(body) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row[0], body))
        size += len(body)
    yield held


def find(documents: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``hit_words`` (binary: a bit per word, first word highest) and ``items`` (array<bigint>).

    A word is hit if it lies in any occurrence of a window of ``window`` consecutive words of an
    item, or of a whole item with fewer, but not no, words.  ``items`` are the ids, each once, of
    items with an occurring window; an item without id hits words but is not listed.  Null texts have
    no words.  Each task builds suffix arrays of a few megabytes of its documents at a time.
    """
    result = documents
    for i, rows in enumerate(blocks(benchmark, key, item_text)):
        block = documents.sparkSession.sparkContext.broadcast(Items.of(rows, window))
        if i:
            result = stage(result, "benchmark-pass")

        def task(columns, block=block):
            items = block.value
            for texts, before, known in columns:
                counts, flags, _, found = hits(items, texts.cast(pa.binary()).to_pylist())
                bits, ids, sums, at = [], [], [], 0
                for n, own, old, listed in zip(counts.tolist(), found, before.to_pylist(), known.to_pylist()):
                    flag = flags[at : at + n]
                    at += n
                    if old is not None:
                        flag = flag | np.unpackbits(np.frombuffer(old, np.uint8), count=n).astype(bool)
                    bits.append(np.packbits(flag).tobytes())
                    sums.append(int(flag.sum()))
                    ids.append(sorted({items.ids[k] for k in own.tolist()} - {None} | set(listed or ())))
                yield [pa.array(counts), pa.array(sums, pa.int64()), pa.array(bits, pa.binary()), pa.array(ids, pa.list_(pa.int64()))]

        old = [F.col("hit_words"), F.col("items")] if i else [F.lit(None).cast("binary"), F.lit(None).cast("array<bigint>")]
        result = add_columns(result, [text_or_empty(text), *old], task, "n_words bigint, n_hit bigint, hit_words binary, items array<bigint>")
    return result


def longest(documents: DataFrame, benchmark: DataFrame, document: str = "doc_id", text: str = "text", key: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The longest verbatim match of each occurring item: one row per item id.

    Every suffix of every item is searched in every suffix array, as deep as it matches.  Columns:
    item id, ``item_begin`` (word), ``n_matched`` (words), document, ``doc_begin`` (word).  Of
    equally long matches the one with the smallest document, item and document word stays.
    """
    parts = []
    bounded_batches(documents.sparkSession)
    for rows in blocks(benchmark, key, item_text):
        block = documents.sparkSession.sparkContext.broadcast(Items.of([r for r in rows if r[0] is not None], window))

        def task(batches, block=block):
            items = block.value
            stops = np.append(items.item_starts, len(items.words))[1:]
            starts = np.arange(len(items.words))
            item = np.repeat(np.arange(len(stops)), stops - items.item_starts)
            rest = stops[item] - starts if len(item) else starts
            for batch in batches:
                for part in slices(batch, 1):
                    numbers, counts = _numbers(items, part.column(1).cast(pa.binary()).to_pylist())
                    owner = np.repeat(np.arange(len(counts)), counts)
                    least = int(items.widths.min(initial=window))
                    shard = Shard.of(numbers, owner, least)
                    depth, low, high = shard.search(items.words, starts, rest)
                    # A match counts if it is as long as a window, or is the whole of a short item.
                    long = np.flatnonzero((depth >= np.minimum(window, (stops - items.item_starts)[item])) & (depth > 0)) if len(item) else starts
                    best: dict[int, tuple] = {}
                    documents_ = part.column(0).to_pylist()
                    begins = np.cumsum(counts) - counts
                    for k in long.tolist():
                        mine = best.get(int(item[k]))
                        if mine is None or depth[k] > mine[0]:
                            at = int(shard.place[shard.order[low[k] : high[k]]].min())
                            best[int(item[k])] = (int(depth[k]), int(starts[k] - items.item_starts[item[k]]), documents_[owner[at]], int(at - begins[owner[at]]))
                    yield pa.RecordBatch.from_pylist([{"item": items.ids[k], "begin": b, "n": n, "doc": d, "doc_begin": w} for k, (n, b, d, w) in best.items()], schema=pa.schema([("item", pa.int64()), ("begin", pa.int64()), ("n", pa.int64()), ("doc", pa.int64()), ("doc_begin", pa.int64())]))

        rows_ = documents.select(F.col(f"`{document}`").cast("long"), text_or_empty(text))
        parts.append(rows_.mapInArrow(tidy(task), "item long, begin long, n long, doc long, doc_begin long"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    best = every.groupBy("item").agg(F.max(F.struct("n", (-F.col("doc")).alias("doc"), (-F.col("begin")).alias("begin"), (-F.col("doc_begin")).alias("word"))).alias("best"))
    return best.select(
        F.col("item").alias(key), (-F.col("best.begin")).alias("item_begin"), F.col("best.n").alias("n_matched"), (-F.col("best.doc")).alias(document), (-F.col("best.word")).alias("doc_begin"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """Documents without any benchmark passage, with their own columns."""
    kept = documents.columns
    marked = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text_or_empty(names.get("text", "text")).alias("text"))
    return find(marked, benchmark, **{**names, "text": "text"}).where("n_hit = 0").select("row.*")
