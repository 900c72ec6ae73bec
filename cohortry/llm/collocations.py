"""Phrase collocations by dynamic itemset counting: lengths are counted interleaved while shards are scanned in a cycle.

The documents are dealt into shards. A step scans one shard; steps go round the shards. All words are counted from the
first step. A longer phrase is counted from the step after both its subphrases (without its last, without its first word)
have reached the threshold, for one full cycle: once around the shards from where it began, or until it has reached the
threshold too. A length of k words is therefore through after at most k cycles; most phrases begin long before that.

A phrase is counted under a key of 64 bits, its hash and its length: a step shuffles keys and counts, never texts. A task
adds up its own counts and sends them packed, one value for each range of keys: the distances of the sorted keys, byte by
byte, of which the compression of the shuffle leaves five or six bytes a phrase. A range is added up by one task. Which
phrases have reached the threshold is told to the tasks by a table of a byte for each cell of the key, the step from which
the cell's phrases count. It has at most ``CELLS`` bytes. Phrases that share a cell can make another one be counted too
soon or once more; that costs work and loses none. A last scan counts the texts of the phrases that reached the threshold,
so the counts that are returned are those of texts, at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.scan import _BASE, BYTE_VALUES, bound_batches, give_back, mix, slices, span_hashes, spans
from cohortry.session import scratch_path, settle

#: More shards let longer phrases begin sooner, but the counts of open phrases are shuffled and written once for each.
SHARDS = 2
#: Most bytes of the table of cells; it has a cell for four words of the corpus up to there.
CELLS = 1 << 25
LEAST_CELLS = 1 << 16
SLICE = 1 << 20

PACKED = "bucket int, packed binary"
STEP = "bucket int, packed binary, reached array<bigint>"
PHRASES = "lang string, size int, phrase string, n bigint"
#: Phrases of a range of keys, about; and the most ranges.
RANGE = 1 << 20
RANGES = 1 << 20
#: A task hands its counts on when it holds so many phrases.
HELD = 6_000_000
#: The lowest bits of a key hold the length less one.
LENGTH_BITS = 4
UNKNOWN = "und"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Kinds of bytes: 0 parts words (space, tab), 1 parts pieces (. , ; : ! ? and line ends), 2 belongs to a word.
KINDS = np.full(256, 2, np.uint8)
KINDS[[32, 9]] = 0
KINDS[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = 1


def phrase_hashes(words: np.ndarray, languages: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hash of the phrase of 1, 2, ... words that begins at each word; ``languages`` has the hash of each word's language."""
    out = [mix(words + mix(languages))]
    for size in range(2, longest + 1):
        out.append(mix(out[-1][: len(words) - size + 1] * np.uint64(_BASE) + words[size - 1 :]))
    low = np.uint64((1 << LENGTH_BITS) - 1)
    return [(h & ~low) | np.uint64(k) for k, h in enumerate(out)]


def texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, size: int) -> pa.Array:
    """The phrases of ``size`` words that begin at the words ``first``, joined by spaces."""
    each = (first[:, None] + np.arange(size)).ravel()
    length = (ends - starts)[each]
    gap = np.tile(np.append(np.ones(size - 1, np.int64), 0), len(first))
    places = np.cumsum(length + gap) - (length + gap)
    out = np.full(int((length + gap).sum()), 32, np.uint8)
    at, before = np.arange(int(length.sum())), np.cumsum(length) - length
    out[at + np.repeat(places - before, length)] = data[at + np.repeat(starts[each] - before, length)]
    offsets = np.append(places[::size], len(out)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _cell(keys: np.ndarray, cells: int) -> np.ndarray:
    return (keys >> np.uint64(LENGTH_BITS) & np.uint64(cells - 1)).astype(np.int64)


class _Words:
    """The words of a slice of texts: bytes, spans, text number, piece, and the keys of all phrases."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, language: np.ndarray, longest: int) -> None:
        self.data = LOWER[data]
        kind = KINDS[self.data]
        self.starts, self.ends, self.owner = spans(kind == 2, offsets)
        # Words of one piece: no mark between them, and one text.
        self.piece = np.cumsum(kind == 1)[self.starts] + self.owner if len(data) else self.starts
        words = span_hashes(BYTE_VALUES[self.data], self.starts, self.ends)
        self.longest = min(longest, len(words))
        self.keys = phrase_hashes(words, language[self.owner], self.longest) if len(words) else []

    def joined(self, size: int) -> np.ndarray:
        """Whether a phrase of ``size`` words begins at each word, up to the last that has so many after it."""
        return self.piece[: len(self.piece) - size + 1] == self.piece[size - 1 :]


def _words(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[pa.Array, int, _Words]]:
    """Language column, first row and words of each slice."""
    for batch in batches:
        names = batch.column("lang")
        raw = names.cast(pa.large_string())
        edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        language = span_hashes(BYTE_VALUES[np.frombuffer(raw.buffers()[2] or b"", np.uint8)], edges[:-1], edges[1:])
        for first, data, offsets in slices(batch, "text", limit=SLICE):
            yield names, first, _Words(data, offsets, language[first:], longest)


def pack(keys: np.ndarray, counts: np.ndarray, ages: np.ndarray) -> bytes:
    """Sorted keys with their counts and ages: bytes of equal weight stand together, as most of them are the same."""
    distances = np.diff(keys, prepend=np.uint64(0))
    planes = [x.view(np.uint8).reshape(len(keys), x.itemsize).T.tobytes() for x in (distances, counts.astype("<u8"), ages.astype(np.uint8))]
    return b"".join(planes)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(17, len(data) // 17)
    distances, counts = (np.ascontiguousarray(planes[a : a + 8].T).view("<u8").ravel() for a in (0, 8))
    return np.cumsum(distances, dtype=np.uint64), counts.astype(np.int64), planes[16].astype(np.int64)


def _added(keys: list[np.ndarray], counts: list[np.ndarray], ages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry a key: counts added, the greatest age."""
    key, count, age = np.concatenate(keys), np.concatenate(counts), np.concatenate(ages)
    order = np.argsort(key, kind="stable")
    key, count, age = key[order], count[order], age[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return (key[first], np.add.reduceat(count, first), np.maximum.reduceat(age, first)) if len(first) else (key, count, age)


def _counted_keys(words: _Words, step: int, shards: int, table: np.ndarray | None) -> Iterator[np.ndarray]:
    """Keys of the phrases that are counted in this step, wherever they stand in a slice."""
    for size in range(1, words.longest + 1):
        # The phrases of k words are through after k cycles.
        if step >= size * shards:
            continue
        keys = words.keys[size - 1]
        if size > 1:
            if table is None:
                return
            cell = table[_cell(words.keys[size - 2], len(table))]
            left, right = cell[:-1], cell[1:]
            keys = keys[(left > 0) & (right > 0) & (np.maximum(left, right).astype(np.int64) + shards > step) & words.joined(size)]
        yield keys


def _count(step: int, shards: int, longest: int, bits: int, cells):
    """The counts of a task, packed by the highest ``bits`` of the key."""

    def run(batches: Iterator[pa.RecordBatch]):
        table = cells.value if cells is not None else None
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def held() -> pa.RecordBatch:
            key, count, age = _added(keys, counts, [np.zeros(len(k), np.int64) for k in keys])
            bucket = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            edges = np.append(first, len(key))
            packed = [pack(key[a:b], count[a:b], age[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            keys.clear()
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "packed"])

        more = 0
        for _, _, words in _words(batches, longest):
            found = list(_counted_keys(words, step, shards, table))
            if not found:
                continue
            key, count = np.unique(np.concatenate(found), return_counts=True)
            keys.append(key)
            counts.append(count)
            more += len(key)
            if more > HELD // 2:
                # Slices repeat each other's phrases: add up before anything is sent.
                key, count, _ = _added(keys, counts, [np.zeros(len(k), np.int64) for k in keys])
                keys[:], counts[:], more = [key], [count], 0
                if len(key) > HELD // 2:
                    yield held()
        if keys:
            yield held()
        give_back()

    return run


def _add(least: int, shards: int):
    """A range of keys: those that reached the threshold, and those whose cycle goes on."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts, ages = _added(*zip(*(unpack(x.as_py()) for x in table.column("packed")), strict=True))
        reached, on = counts >= least, (counts < least) & (ages + 1 < shards)
        row = {"bucket": key[0].as_py(), "packed": pack(keys[on], counts[on], ages[on] + 1), "reached": keys[reached].view(np.int64)}
        schema = pa.schema([("bucket", pa.int32()), ("packed", pa.binary()), ("reached", pa.list_(pa.int64()))])
        return pa.Table.from_pylist([row], schema)

    return run


def _texts(longest: int, cells):
    """Texts of the phrases whose cell and whose subphrases' cells are set, with their number in a slice, and all words."""

    def run(batches: Iterator[pa.RecordBatch]):
        table = cells.value
        for names, first, words in _words(batches, longest):
            before = None
            for size in range(1, words.longest + 1):
                inside = table[_cell(words.keys[size - 1], len(table))] > 0
                if size > 1:
                    inside &= before[:-1] & before[1:] & words.joined(size)
                before = inside
                at = np.flatnonzero(inside)
                _, where, count = np.unique(words.keys[size - 1][at], return_index=True, return_counts=True)
                where = at[where]
                texts = texts_of(words.data, words.starts, words.ends, where, size)
                columns = [names.take(pa.array(first + words.owner[where])), pa.array(np.full(len(where), size, np.int32)), texts, pa.array(count)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])
            # The empty phrase stands before every word.
            rows, count = np.unique(words.owner, return_counts=True)
            columns = [names.take(pa.array(first + rows)), pa.array(np.zeros(len(rows), np.int32)), pa.array([""] * len(rows), pa.string()), pa.array(count)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    return run


def _cells_of(keys: DataFrame, cells: int) -> Iterator[np.ndarray]:
    """Cells of these keys. Built as bitmaps on the executors; at most a bit for each cell comes to the driver."""
    cell = F.expr(f"(shiftright(key, {LENGTH_BITS}) & {cells - 1}L) + 1")  # bits are numbered from 1
    bits = keys.groupBy(F.bitmap_bucket_number(cell).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
    for row in bits.collect():
        inside = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(row.bits), np.uint8), bitorder="little"))
        yield (row.bucket - 1) * 32768 + inside


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, shards: int = SHARDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang size phrase n`` of every phrase of 1 to ``longest`` words (at most 16) that occurs ``least`` times or more in its language.

    A capital ASCII letter counts as the small one; marks ``. , ; : ! ?`` and line ends part a text into pieces, spaces and
    tabs part a piece into words; a phrase lies within a piece. Size 0 has the number of all words of a language, whatever
    ``least`` is. A null language is ``und``; null and empty texts have no words; repeated rows count each; an empty table
    gives no row; other columns are ignored whatever their names. Rows are dealt to shards by a hash of their text.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "phrases")
    rows = bound_batches(docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")))
    shard = F.pmod(F.xxhash64("text", "lang"), F.lit(shards))
    # About six bytes a word.
    words = int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // 6
    table = np.zeros(min(max(1 << (words // 4).bit_length(), LEAST_CELLS), CELLS), np.uint8)
    bits = min(max(2 * words // RANGE, 7).bit_length(), RANGES.bit_length() - 1)
    cells, last, step = None, shards - 1, 0
    while step <= min(last, longest * shards - 1):
        counted = rows.where(shard == step % shards).mapInArrow(_count(step, shards, longest, bits, cells), PACKED)
        if step:
            # Phrases whose cycle is still open and that have not reached the threshold yet.
            counted = counted.unionByName(spark.read.schema(STEP).parquet(f"{path}/step-{step - 1}").select("bucket", "packed"))
        counted.groupBy("bucket").applyInArrow(_add(least, shards), STEP).write.parquet(f"{path}/step-{step}")
        now = spark.read.schema(STEP).parquet(f"{path}/step-{step}").select(F.explode("reached").alias("key"))
        some = False
        shorter = F.expr(f"key & {(1 << LENGTH_BITS) - 1}L") < longest - 1
        for inside in _cells_of(now.where(shorter), len(table)):
            table[inside], some = step + 1, True
        if some:
            last = max(last, step + shards)
            if cells is not None:
                cells.unpersist()
            cells = spark.sparkContext.broadcast(table)
        step += 1
    table = np.zeros(len(table), np.uint8)
    reached = spark.read.schema(STEP).parquet(*[f"{path}/step-{i}" for i in range(step)]).select(F.explode("reached").alias("key"))
    for inside in _cells_of(reached, len(table)):
        table[inside] = 1
    texts = rows.mapInArrow(_texts(longest, spark.sparkContext.broadcast(table)), PHRASES)
    return texts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("size") == 0))


def _part(words: Column, first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def collocations(phrases: DataFrame, top: int = 2000, cover: int = 80, longest: int = 4) -> DataFrame:
    """The ``top`` phrases of two and more words of each language: ``lang rank phrase a l r n score``.

    ``phrases`` is what ``frequent_phrases`` gives, of at most ``longest`` words. Each cut of a phrase has the score floor(2000000 a / (l + r)), where a
    is the count of the phrase, l and r those of its two parts; the lowest counts, ties to the shorter first part. A
    phrase goes if a longer one that holds it has ``cover`` percent of its count. Best score first, then larger count, then
    phrase by UTF-8 bytes. Arithmetic is exact. An empty table gives no row.
    """
    phrases = settle(phrases, "frequent-phrases")
    candidates = phrases.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(_part(F.col("w"), 1, F.col("k")).alias("part"), F.lit(True).alias("first")),
            F.struct(_part(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("part"), F.lit(False).alias("first")),
        )).alias("p"),
    ).select("lang", "phrase", "a", "k", "p.part", "p.first")
    counts = phrases.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("c"))
    held = parts.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(
        *(F.max(F.when((F.col("k") == k) & (F.col("first") == side), F.col("c"))).alias(f"{'l' if side else 'r'}{k}") for k in range(1, longest) for side in (True, False))
    )
    score = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"(cast(a as decimal(20,0)) * 2000000) div (cast(l{k} as decimal(20,0)) + r{k})").alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        ))
        for k in range(1, longest)
    ]
    scored = held.withColumn("best", F.array_min(F.array_compact(F.array(*score)))).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # All shorter phrases within each longer one, with the largest count of those that hold them.
    spread = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: _part(F.col("w"), i, s))))
    inner = candidates.where("size > 2").select("lang", F.explode(F.array_distinct(spread)).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"longer is null or cast(longer as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {cover}")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = phrases.where("size = 0").select("lang", F.col("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
