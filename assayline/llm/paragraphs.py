"""Repeated paragraphs and passages across documents: MinHash bands, exact Jaccard, components.

A paragraph is a line of at least MIN_WORDS words; its set is that of its shingles of five
lower-cased words.  Bands of two hashes each, eight of them, let a pair of similarity s meet with
probability 1 - (1 - s^2)^8: 0.9997 at 0.8, more above.  All that meet are compared exactly.

A passage may also lie inside lines, or run over short ones.  So the words of the whole text are cut
into windows of WINDOW words, too, which begin where the hash of a shingle is the least of SPREAD
shingles on either side: wherever a copy stands, its windows begin at the same words.  Windows
overlap, and are compared like paragraphs, with WINDOW_BANDS bands.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline import session

from . import bloom
from .components import components
from .frames import bounded_batches, slices, stage, text_or_empty, tidy

WORDS, SIMILARITY, MIN_WORDS = 5, 0.8, 20
BANDS, ROWS = 8, 2
#: Members of one bucket that are compared at a time; see ``dealt``.
CROWD = 20_000

#: Words of a window, shingles on either side among which its first is the least, and its bands.
WINDOW, SPREAD, WINDOW_BANDS = 20, 6, 2

_seeds = np.random.default_rng(20).integers(1, 2**63, (BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Laid:
    """The lower-cased words of some texts in a row, one blank behind each, and where they stand.

    ``text`` and ``line`` are those of each word, lines counted from zero in each text; ``first`` is
    the first word of each text.
    """

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        blank = _BLANK[data]
        outside = np.ones(len(data) + 2, bool)
        outside[1:-1] = blank
        edges = np.flatnonzero(outside[1:] != outside[:-1])
        begins, ends = edges[0::2], edges[1::2]
        kept = ~blank
        kept[ends[ends < len(data)]] = True
        joined = data[kept]
        self.ends = np.cumsum(ends - begins + 1) - 1
        self.begins = self.ends - (ends - begins)
        joined[self.ends[self.ends < len(joined)]] = 32
        self.joined = joined.tobytes()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        stands, breaks = np.cumsum(sizes) - sizes, np.flatnonzero(data == 10)
        self.text = np.searchsorted(stands, begins, "right") - 1
        self.line = np.searchsorted(breaks, begins) - np.searchsorted(breaks, stands)[self.text]
        self.first = np.searchsorted(begins, stands)

    def hashes(self) -> np.ndarray:
        """Of the shingle at each word but the last four, whatever text it ends in."""
        n = max(0, len(self.begins) - WORDS + 1)
        return rolled(self.joined, self.begins[:n], self.ends[len(self.ends) - n :])

    def digests(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Of the words from each first one to its last one."""
        return [xxhash.xxh3_128_digest(self.joined[a:b]) for a, b in zip(self.begins[first].tolist(), self.ends[last].tolist())]


def paragraphs_of(laid: Laid) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each paragraph."""
    new = np.ones(len(laid.text), bool)
    new[1:] = (laid.text[1:] != laid.text[:-1]) | (laid.line[1:] != laid.line[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(first, append=len(new))
    return first[counts >= MIN_WORDS], counts[counts >= MIN_WORDS]


def sets_of(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of shingles of runs of words, ascending, one behind the other, and where each begins and the last ends."""
    sizes = counts - WORDS + 1
    run = np.repeat(np.arange(len(first)), sizes)
    at = np.arange(len(run)) + (first - np.cumsum(sizes) + sizes)[run]
    ranked = np.sort(run.astype(np.uint64) << np.uint64(32) | hashes[at])
    ranked = ranked[np.diff(ranked, prepend=~ranked[:1]) != 0]
    return ranked.astype(np.uint32), np.searchsorted(ranked, np.arange(len(first) + 1, dtype=np.uint64) << np.uint64(32))


def shingles(words: list[bytes]) -> np.ndarray:
    """The set of shingles, as ascending 32-bit hashes."""
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    digest = xxhash.xxh32_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip((ends - sizes)[: 1 - WORDS].tolist(), ends[WORDS - 1 :].tolist())], np.uint32))


def bands_of(sets: list[np.ndarray], bands: int = BANDS) -> np.ndarray:
    """One key per band for each set."""
    if not sets:
        return np.zeros((0, bands), np.int64)
    return flat_bands(np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])]), bands)


def flat_bands(flat: np.ndarray, begins: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """``bands_of`` sets that stand one behind the other, none empty."""
    if not len(begins):
        return np.zeros((0, bands), np.int64)
    flat = flat.astype(np.uint64)
    least = np.empty((len(begins), bands * ROWS), np.uint64)
    for k, (a, b) in enumerate(_seeds[: bands * ROWS]):
        mixed = flat * a + b
        mixed ^= mixed >> np.uint64(29)
        mixed *= a
        least[:, k] = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), begins)
    keys = least[:, 0::ROWS].copy()
    for r in range(1, ROWS):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + least[:, r::ROWS]
    return keys.view(np.int64)


def _find_task(batches):
    schema = pa.schema([("key", pa.int64()), ("paragraph", pa.int32()), ("n_words", pa.int32()), ("same", pa.binary()), ("bands", pa.list_(pa.int64())), ("shingles", pa.binary())])
    for batch in batches:
        for part in slices(batch, 1):
            laid = Laid(part.column(1).cast(pa.binary()).to_pylist())
            first, counts = paragraphs_of(laid)
            flat, stops = sets_of(laid.hashes(), first, counts)
            bands = pa.FixedSizeListArray.from_arrays(pa.array(flat_bands(flat, stops[:-1]).ravel()), BANDS).cast(pa.list_(pa.int64()))
            sets = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((stops * 4).astype(np.int32)), pa.py_buffer(flat)])
            same = pa.array(laid.digests(first, first + counts - 1), pa.binary())
            keys, lines = part.column(0).take(pa.array(laid.text[first])), pa.array(laid.line[first].astype(np.int32))
            yield pa.RecordBatch.from_arrays([keys, lines, pa.array(counts.astype(np.int32)), same, bands, sets], schema=schema)


#: Bytes over which sums run at a time in ``rolled``.
ROLL = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(21).integers(1, 2**63, 256, dtype=np.uint64)


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base, and of its inverse, modulo 2^64."""
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.concatenate([one, np.full(ROLL, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def rolled(joined: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32-bit hashes of ascending ranges of bytes: differences of running sums of a polynomial, moved to the same power.

    A range hashes alike wherever it stands.  Ranges longer than ROLL are hashed by themselves.
    """
    up, down = _powers()
    data = np.frombuffer(joined, np.uint8)
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        low = int(begins[i])
        j = int(np.searchsorted(ends, low + ROLL, "right"))
        if j <= i:
            out[i] = xxhash.xxh64_intdigest(joined[low : int(ends[i])])
            i += 1
            continue
        sums = np.zeros(int(ends[j - 1]) - low + 1, np.uint64)
        np.cumsum(_CODES[data[low : int(ends[j - 1])]] * up[: len(sums) - 1], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[begins[i:j] - low]) * down[begins[i:j] - low]
        i = j
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return (out >> np.uint64(32)).astype(np.uint32)


def starts(laid: Laid, hashes: np.ndarray) -> np.ndarray:
    """Words at which windows begin: their shingles are less than all before them, and not more than those behind, within SPREAD.

    Texts are laid out with so much room between them that shingles of one do not see those of another.
    """
    own = np.flatnonzero(laid.text[: len(hashes)] == laid.text[len(laid.text) - len(hashes) :])
    place = own + SPREAD * (laid.text[own] + 1)
    padded = np.full(len(laid.text) + SPREAD * (len(laid.first) + 2), 0xFFFFFFFF, np.uint32)
    padded[place] = hashes[own] * np.uint32(0x9E3779B1)
    n = len(padded) - 2 * SPREAD
    mixed = padded[SPREAD : SPREAD + n]
    least = np.full(n, True)
    for d in range(1, SPREAD + 1):
        least &= mixed < padded[SPREAD - d : SPREAD - d + n]
        least &= mixed <= padded[SPREAD + d : SPREAD + d + n]
    at = own[least[place - SPREAD]]
    at = at[at + WINDOW <= len(laid.text)]
    return at[laid.text[at + WINDOW - 1] == laid.text[at]]


def windows_of(laid: Laid) -> tuple[np.ndarray, np.ndarray]:
    """The first words of all windows, and their shingle hashes, a row each."""
    hashes = laid.hashes()
    at = starts(laid, hashes)
    return at, hashes[at[:, None] + np.arange(WINDOW - WORDS + 1)]


def windows(text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Lower-cased words of a text, where its windows begin, and their shingle hashes, a row each."""
    laid = Laid([text])
    return laid.joined.split(), *windows_of(laid)


def window_bands(rows: np.ndarray) -> np.ndarray:
    """``bands_of`` windows, whose sets may hold a shingle twice."""
    keys = np.zeros((len(rows), WINDOW_BANDS), np.uint64)
    flat = rows.astype(np.uint64)
    for k, (a, b) in enumerate(_seeds[: WINDOW_BANDS * ROWS]):
        mixed = flat * a + b
        mixed ^= mixed >> np.uint64(29)
        mixed *= a
        least = (mixed ^ (mixed >> np.uint64(32))).min(axis=1, initial=np.uint64(2**64 - 1))
        keys[:, k // ROWS] = keys[:, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + least
    return keys.view(np.int64)


def _value_task(batches):
    """Texts -> the band keys of all windows."""
    for batch in batches:
        for part in slices(batch, 0):
            found = window_bands(windows_of(Laid(part.column(0).cast(pa.binary()).to_pylist()))[1])
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel())], names=["value"])


def _window_task(repeated):
    """Texts -> windows one of whose band keys the filter knows, like ``_find_task``, with their first word.

    ``paragraph`` is the line of that word.  Without a filter all windows are put out.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                laid = Laid(part.column(1).cast(pa.binary()).to_pylist())
                at, rows = windows_of(laid)
                bands = window_bands(rows)
                if repeated is not None:
                    keep = bloom.known(repeated.value, bands.ravel()).reshape(bands.shape).any(axis=1)
                    at, rows, bands = at[keep], rows[keep], bands[keep]
                rows = np.sort(rows, axis=1)
                packed, width = rows.tobytes(), rows.shape[1] * 4
                twice = (rows[:, 1:] == rows[:, :-1]).any(axis=1).tolist()
                sets = [np.unique(rows[i]).tobytes() if t else packed[i * width : (i + 1) * width] for i, t in enumerate(twice)]
                text = laid.text[at]
                keyed = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), WINDOW_BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(text)), pa.array(laid.line[at].astype(np.int32)), pa.array((at - laid.first[text]).astype(np.int32)),
                        pa.array(laid.digests(at, at + WINDOW - 1), pa.binary()), keyed, pa.array(sets, pa.binary()),
                    ],
                    names=["key", "paragraph", "begin", "same", "bands", "shingles"])

    return run


def forest(names: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links sets of at least SIMILARITY."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint32)
    left, edges = np.arange(len(sets)), []
    while len(left) > 1:
        waiting, left = [int(left[0])], left[1:]
        owner = None
        while waiting and len(left):
            x = waiting.pop()
            if owner is None:
                keep = np.zeros(len(sets), bool)
                keep[left] = True
                values = flat[np.repeat(keep, sizes)]
                begins = np.cumsum(sizes[left]) - sizes[left]
                owner = True
            at = np.minimum(np.searchsorted(sets[x], values), len(sets[x]) - 1)
            common = np.add.reduceat((sets[x][at] == values).astype(np.int64), begins)
            near = common >= SIMILARITY * (sizes[left] + len(sets[x]) - common) - 1e-9
            if near.any():
                edges += [(names[x], names[y]) for y in left[near].tolist()]
                waiting += left[near].tolist()
                left, owner = left[~near], None
    return edges


def _compare_task(batches):
    """Rows (bucket, name, shingles), bucket by bucket -> verified edges."""
    bucket, names, sets, edges = None, [], [], []

    def ended():
        if edges:
            a, b = zip(*edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            edges.clear()

    for batch in batches:
        for b, name, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if b != bucket:
                edges += forest(names, sets)
                bucket, names, sets = b, [], []
            names.append(name)
            sets.append(np.frombuffer(packed, np.uint32))
        yield from ended()
    edges += forest(names, sets)
    yield from ended()


def dealt(members: DataFrame, crowd: int) -> DataFrame:
    """``bucket`` and ``number`` of rows band, value, n and number, no bucket of much more than ``crowd`` members.

    A bucket of more is dealt by a hash into blocks of half a crowd, and every block meets every
    other in a bucket of their own, so that each two members are compared in at least one of them.
    Blocks depend on the members only, not on the order in which they arrive.
    """
    blocks = F.when(F.col("n") <= crowd, 1).otherwise(F.ceil(2 * F.col("n") / crowd)).cast("int")
    own = members.select("band", "value", "number", blocks.alias("blocks"), F.pmod(F.xxhash64(F.col("number"), F.lit(1)), blocks).cast("int").alias("block"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))
    pairs = own.withColumn("other", F.explode(others))
    return pairs.select(F.xxhash64("band", "value", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"), "number")


def similar(found: DataFrame, nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Verified edges (a, b) between nodes that meet in a band; ``nodes`` holds node and bands, ``found`` number and shingles."""
    meets = nodes.select("node", F.posexplode("bands").alias("band", "value")).withColumn("n", F.count("*").over(Window.partitionBy("band", "value")))
    meets = stage(meets.where("n > 1"), "meets")
    # A bucket counts once however many bands bring the same members together.
    filled = meets.groupBy("band", "value").agg(F.max("n").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("mix"))
    buckets = filled.groupBy("n", "low", "high", "mix").agg(F.min(F.struct("band", "value")).alias("at")).select("at.band", "at.value")
    members = dealt(meets.join(buckets, ["band", "value"]).withColumnRenamed("node", "number"), crowd)
    # Merged at every size: the sets are the one large side, whatever the number of members.
    sets = members.join(found.select("number", "shingles").hint("merge"), "number").select("bucket", "number", "shingles")
    return stage(sets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_compare_task), "a bigint, b bigint"), "similar")


def _whole_task(batches):
    schema = pa.schema([("key", pa.int64()), ("same", pa.int64()), ("bands", pa.list_(pa.int64())), ("shingles", pa.binary())])
    for batch in batches:
        for part in slices(batch, 1):
            split = [(key, text.lower().split()) for key, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())]
            keys, texts = [k for k, words in split if words], [words for _, words in split if words]
            same = [xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) for words in texts]
            sets = [shingles(words) if len(words) >= WORDS else np.array([xxhash.xxh32_intdigest(b" ".join(words))], np.uint32) for words in texts]
            bands = pa.FixedSizeListArray.from_arrays(pa.array(bands_of(sets).ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(same, pa.int64()), bands, pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)


def alike(documents: DataFrame, key: str, text: str, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) of the keys (long) of whole texts that are similar, found and verified like paragraphs.

    Texts that are equal word for word must have equal keys.  Texts without words have no edge.
    """
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), text_or_empty(text).alias("text"))
    found = stage(rows.mapInArrow(tidy(_whole_task), "key long, same long, bands array<bigint>, shingles binary").withColumn("number", F.monotonically_increasing_id()), "texts")
    nodes = stage(found.groupBy("same").agg(F.min("bands").alias("bands"), F.min("number").alias("node")), "nodes")
    named = [found.select(F.col("number").alias(end), F.col("key").alias(f"key_{end}")) for end in ("a", "b")]
    edges = similar(found, nodes, crowd).join(named[0], "a").join(named[1], "b")
    return edges.where("key_a <> key_b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def _classes_of(found: DataFrame, crowd: int, columns: list[str]) -> DataFrame:
    """Units (key, paragraph, same, bands, shingles, number and ``columns``) with another one like them: their class."""
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "paragraph", "number")).alias("first")
    nodes = stage(found.groupBy("same").agg(F.min("bands").alias("bands"), F.min("number").alias("node"), F.count("*").alias("n"), first), "nodes")

    edges = similar(found, nodes, crowd)
    labels = components(edges).withColumnRenamed("node", "linked")
    named = nodes.select("same", "node", "n", "first").join(labels, F.col("node") == F.col("linked"), "left").withColumn("label", F.coalesce("component", "node"))
    named = stage(named.select("same", "n", "first", "label"), "labels")
    groups = named.groupBy("label").agg(F.sum("n").alias("class_size"), F.min("first").alias("first")).where("class_size > 1")
    repeated = stage(named.select("same", "label").join(groups, "label").select("same", "class_size", F.col("first.key").alias("class_id"), F.col("first.number").alias("kept")), "classes")
    return found.select("key", "paragraph", *columns, "same", "number").join(repeated, "same").select(
        "key", "paragraph", *columns, "class_id", "class_size", (F.col("number") != F.col("kept")).alias("removed"),
    )


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """All paragraphs with another one like them, in whatever document.

    Columns: ``key``, ``paragraph`` (its line, from zero), ``n_words``, ``class_id`` (the smallest key
    in the class), ``class_size`` (paragraphs) and ``removed``: all of a class but its first, by key,
    then line, go.  Null texts have no paragraphs; a null key comes last.  Repeated rows are copies
    of each other like any others.  Paragraphs that are equal word for word (by a hash of 128 bits)
    are one node from the start, found with a combined aggregate; of the rest only those that meet in a
    band are compared.
    """
    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), text_or_empty(text).alias("text"))
    found = rows.mapInArrow(tidy(_find_task), "key long, paragraph int, n_words int, same binary, bands array<bigint>, shingles binary")
    found = stage(found.withColumn("number", F.monotonically_increasing_id()), "paragraphs")
    return _classes_of(found, crowd, ["n_words"]).withColumnRenamed("key", key)


def passages(documents: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD, limit: int = bloom.LIMIT) -> DataFrame:
    """All windows with another one like them, wherever in a document they stand.

    Columns as of ``classes``, with ``begin``, the number of the window's first word in the text (from
    zero), and ``paragraph`` the line of that word; the first of a class stays.  A text of fewer than
    WINDOW words has no windows; null counts as empty, null keys come last, repeated rows are copies.

    Texts are read twice.  First only band keys are counted, and those that come twice put into a Bloom
    filter of bounded size; then windows with a key that it knows, a small part, are written with their
    shingles and compared.  Where there are more such keys than it could tell apart, a join picks them.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), text_or_empty(text).alias("text"))
    values = rows.select("text").mapInArrow(tidy(_value_task), "value bigint")
    again = stage(values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value"), "values")
    n = again.count()
    sent = spark.sparkContext.broadcast(bloom.built(again, n, limit)) if bloom.fits(n, limit) else None
    every = rows.mapInArrow(tidy(_window_task(sent)), "key long, paragraph int, begin int, same binary, bands array<bigint>, shingles binary")
    every = every.withColumn("number", F.monotonically_increasing_id())
    if sent is None:
        met = stage(every.withColumn("value", F.explode("bands")).join(again, "value"), "windows")
        every = met.drop("value").dropDuplicates(["number"])
    found = stage(every, "windows")
    if sent is not None:
        sent.unpersist()
    return _classes_of(found, crowd, ["begin"]).withColumnRenamed("key", key)


def repeated(documents: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """Paragraphs and passages together: ``classes`` (``begin`` is null) and ``passages`` (``n_words`` is WINDOW)."""
    spark = documents.sparkSession
    columns = [key, "paragraph", "begin", "n_words", "class_id", "class_size", "removed"]
    path = session.scratch(spark, "lines")
    # What the lines needed is removed before windows are looked for.
    with session.scratch_run(spark):
        lines = classes(documents, key, text, crowd).withColumn("begin", F.lit(None).cast("int")).select(*columns)
        schema = lines.schema
        lines.write.parquet(path)
    return spark.read.schema(schema).parquet(path).unionByName(passages(documents, key, text, crowd).withColumn("n_words", F.lit(WINDOW)).select(*columns))


def _without(text: Column, lines: Column) -> Column:
    kept = F.filter(F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(line.alias("line"), F.array_contains(lines, i).alias("gone"))), lambda x: ~x.gone)
    return F.array_join(F.transform(kept, lambda x: x.line), "\n")


def remove(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the removed paragraphs, all columns and rows kept; keys must be unique and not null."""
    gone = classes(documents, key, text).where("removed").groupBy(F.col(key).alias("gone_from")).agg(F.collect_set("paragraph").alias("lines"))
    kept = documents.columns
    joined = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")).join(gone, F.col("row")[key] == F.col("gone_from"), "left")
    body = F.col("row")[text]
    changed = F.when(F.col("lines").isNull(), body).otherwise(_without(body, F.col("lines")))
    return joined.select(*[(changed if c == text else F.col("row")[c]).alias(c) for c in kept])
