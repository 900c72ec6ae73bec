"""Periodic runs of words: longest common extensions over a difference cover, asked on harmonic grids of places.

The words of a slice of texts are one sequence with a word of its own between texts, so no match crosses a text. Of its
suffixes only those are sorted that start, modulo 31, in a difference cover: for any two places at most 30 words on, both
reach such suffixes at once. A common extension compares these few words; if they agree, the least common prefix between
the two sorted suffixes, from a sparse table, is the rest.

A run of period q and at least four periods holds four neighbouring places of the grid 0, q, 2q, ... All grids of a text
have n/1 + n/2 + ... places. Where the word at such a place and the words after it agree with those a period on, the common
extensions to the right and to the left give the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.scan import BYTE_VALUES, bound_batches, kept_columns, kept_types, slices, span_hashes, spans, with_kept

#: Every difference modulo 31 is that of exactly one pair of these residues.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)

#: Places of grids looked at together.
GRID = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _shifts() -> np.ndarray:
    """For each pair of residues the fewest places on at which both are in the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    on = np.arange(MODULUS)
    both = inside[(on[:, None, None] + on) % MODULUS] & inside[(on[None, :, None] + on) % MODULUS]
    return both.argmax(2)


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right of two places of a sequence that ends in a symbol found nowhere else."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.symbols = symbols
        n = len(symbols)
        sampled = np.zeros(MODULUS, bool)
        sampled[list(COVER)] = True
        self.places = np.flatnonzero(sampled[np.arange(n) % MODULUS])
        self.slot = np.full(n, -1, np.int32)
        self.slot[self.places] = np.arange(len(self.places))
        names = self._sort()
        self.rank = names[-1]
        self._sparse_table(names)

    def _refine(self, rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Orders suffixes of equal rank by ``key``; a rank is the place of its first member. Returns those still tied."""
        order = np.lexsort((key, rank[tied]))
        tied, key = tied[order], key[order]
        old = rank[tied]
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        part = group.copy()
        part[1:] |= key[1:] != key[:-1]
        at = np.arange(len(tied))
        first, begin = at[group][np.cumsum(group) - 1], at[part][np.cumsum(part) - 1]
        rank[tied] = old + (begin - first)
        single = part.copy()
        single[:-1] &= part[1:]
        return tied[~single]

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 31, 62, 124, ... symbols, until all differ."""
        n, m = len(self.symbols), len(self.places)
        _, symbol = np.unique(self.symbols, return_inverse=True)
        width = max(1, int(len(symbol)).bit_length())
        rank, tied = np.zeros(m, np.int32), np.arange(m)
        padded = np.concatenate([symbol.astype(np.int64) + 1, np.zeros(MODULUS, np.int64)])
        step = max(1, 62 // (width + 1))
        for first in range(0, MODULUS, step):
            key = np.zeros(len(tied), np.int64)
            for k in range(first, min(first + step, MODULUS)):
                key = (key << (width + 1)) | padded[self.places[tied] + k]
            tied = self._refine(rank, tied, key)
            if not len(tied):
                break
        names, reach = [rank.copy()], MODULUS
        while len(tied):
            on = self.places[tied] + reach
            key = np.where(on < n, names[-1][self.slot[np.minimum(on, n - 1)]].astype(np.int64), -1)
            tied = self._refine(rank, tied, key)
            names.append(rank.copy())
            reach *= 2
        return names

    def _sparse_table(self, names: list[np.ndarray]) -> None:
        """Common prefixes of neighbours in the order, by descending lengths of equal names, and their range minima."""
        order = np.argsort(self.rank)
        a, b = self.places[order[:-1]], self.places[order[1:]]
        common, n = np.zeros(len(a), np.int64), len(self.symbols)
        for level in range(len(names) - 1, -1, -1):
            x, y = a + common, b + common
            inside = np.maximum(x, y) < n
            same = np.zeros(len(a), bool)
            same[inside] = names[level][self.slot[x[inside]]] == names[level][self.slot[y[inside]]]
            common[same] += MODULUS << level
        common += self._compare(a + common, b + common, np.full(len(a), MODULUS))
        table = [common.astype(np.int32)]
        while 2 << (len(table) - 1) <= len(common):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols agree, one by one, up to ``most``."""
        out, alive, n = np.zeros(len(a), np.int64), np.arange(len(a)), len(self.symbols)
        for k in range(int(most.max()) if len(most) else 0):
            alive = alive[most[alive] > k]
            alive = alive[np.maximum(a[alive], b[alive]) + k < n]
            alive = alive[self.symbols[a[alive] + k] == self.symbols[b[alive] + k]]
            out[alive] += 1
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of the places ``a`` and ``b``, which differ."""
        shift = SHIFTS[a % MODULUS, b % MODULUS]
        out = self._compare(a, b, shift)
        far = np.flatnonzero(out == shift)
        x, y = self.rank[self.slot[a[far] + shift[far]]], self.rank[self.slot[b[far] + shift[far]]]
        low, high = np.minimum(x, y).astype(np.int64), np.maximum(x, y).astype(np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            row = self.table[k]
            out[far[here]] += np.minimum(row[low[here]], row[high[here] - (1 << k)])
        return out


def grid_hits(values: np.ndarray, firsts: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in it and period of each place of a grid where a run of ``least`` (4 or more) periods may be.

    The word is the same at ``least`` neighbouring places of the grid, and the next two words are those a period on.
    """
    periods = np.maximum(counts // least, 0)
    owner = np.repeat(np.arange(len(counts)), periods)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (counts[owner] - 1) // period - (least - 2) if len(owner) else np.zeros(0, np.int64)
    edges = np.concatenate([[0], np.cumsum(points)])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3]
    a = 0
    while a < len(owner):
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + GRID, "right")) - 1)
        own = np.repeat(np.arange(a, b), points[a:b])
        q = period[own]
        x = firsts[owner[own]] + (np.arange(edges[a], edges[b]) - edges[own]) * q
        hit = np.flatnonzero(values[x] == values[x + q])
        for k in range(1, least - 1):
            hit = hit[values[x[hit] + k * q[hit]] == values[x[hit] + (k + 1) * q[hit]]]
        for k in (1, 2):
            hit = hit[values[x[hit] + k] == values[x[hit] + k + q[hit]]]
        text = owner[own[hit]]
        found.append((text, x[hit] - firsts[text], q[hit]))
        a = b
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def find_runs(values: np.ndarray, counts: np.ndarray, least_periods: int = 4, least_words: int = 6) -> tuple[np.ndarray, ...]:
    """Text, start, length and smallest period of every run of the texts whose words are ``values``, ``counts`` of them each.

    By text, start and period. A run has ``least_periods`` periods and ``least_words`` words at least.
    """
    firsts = np.cumsum(counts) - counts
    text, place, period = grid_hits(values, firsts, counts, least_periods)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    # Only texts with a hit are sorted, with a symbol of its own before, between and after them.
    chosen, own = np.unique(text, return_inverse=True)
    sizes = counts[chosen]
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    symbols = np.zeros(edges[-1] + 1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[edges] = False
    source = np.arange(int(sizes.sum())) + np.repeat(firsts[chosen] - (np.cumsum(sizes) - sizes), sizes)
    symbols[inside] = np.unique(values[source], return_inverse=True)[1]
    symbols[edges] = len(source) + np.arange(len(edges))
    right, left = Extensions(symbols), Extensions(symbols[::-1].copy())
    a = edges[own] + 1 + place
    last = len(symbols) - 1
    after, before = right.common(a, a + period), left.common(last - (a - 1), last - (a - 1 + period))
    start, length = place - before, before + after + period
    kept = np.flatnonzero(length >= np.maximum(least_words, least_periods * period))
    own, start, length, period = own[kept], start[kept], length[kept], period[kept]
    # A stretch met with a multiple of its period is the same run.
    order = np.lexsort((period, length, start, own))
    own, start, length, period = own[order], start[order], length[order], period[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    own, start, length, period = own[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, own))
    return chosen[own[order]], start[order], length[order], period[order]


def _collapse(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all texts, a space between words of a text, and the edges of the texts."""
    owner = np.repeat(np.arange(len(counts)), counts)[kept]
    begin, size = starts[kept], (ends - starts)[kept]
    gap = np.ones(len(owner), np.int64)
    if len(owner):
        gap[-1] = 0
        gap[:-1] = owner[1:] == owner[:-1]
    places = np.cumsum(size + gap) - (size + gap)
    out = np.full(int((size + gap).sum()), 32, np.uint8)
    at = np.arange(int(size.sum()))
    before = np.cumsum(size) - size
    out[at + np.repeat(places - before, size)] = data[at + np.repeat(begin - before, size)]
    total = np.bincount(owner, weights=size + gap, minlength=len(counts)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(total)])


def _find(least_periods: int, least_words: int, extra: int):
    space = np.ones(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = False

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, data, offsets in slices(batch, "_text"):
                starts, ends, owner = spans(space[data], offsets)
                counts = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
                text, start, length, period = find_runs(span_hashes(BYTE_VALUES[data], starts, ends), counts, least_periods, least_words)
                firsts = np.cumsum(counts) - counts
                change = np.zeros(len(starts) + 1, np.int64)
                np.add.at(change, firsts[text] + start + period, 1)
                np.add.at(change, firsts[text] + start + length, -1)
                made, edges = _collapse(data, starts, ends, np.cumsum(change[:-1]) == 0, counts)
                n = len(counts)
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                per = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
                texts = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(made)])
                columns = [
                    batch.column("doc_id").slice(first, n), pa.array(counts), pa.ListArray.from_arrays(pa.array(per), runs), texts.cast(pa.string()),
                    *(batch.column(f"_kept{i}").slice(first, n) for i in range(extra)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed", *(f"_kept{i}" for i in range(extra))])

    return run


def periodic_runs(
    docs: DataFrame, least_periods: int = 4, least_words: int = 6, id_column: str = "doc_id", text: str | Column = "text", keep: list[str] | None = None
) -> DataFrame:
    """A row for each document: ``doc_id n_words runs collapsed``.

    Words are what lies between ASCII white space, numbered from 0. ``runs`` holds every stretch ``(start, length,
    period)`` of words of which those a period apart are the same, for its smallest period, that no neighbouring word
    extends, of at least ``least_periods`` periods (4 or more) and ``least_words`` words, by start and then period.
    ``collapsed`` is the words, joined by one space, without those that a run holds after its first period.

    Null and empty texts have no words, no run and an empty collapsed text; repeated rows have a row each; a null id stays
    null; an empty table gives no row; ``keep`` names columns to hand on, other columns are ignored whatever their names.
    Every text is looked at whole, in one task, without a shuffle; slices hold about a megabyte of texts or one longer text.
    """
    if least_periods < 4:
        raise ValueError("the grids hold runs of at least four periods")
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("_text"), *kept_columns(docs, keep))
    found = bound_batches(rows).mapInArrow(_find(least_periods, least_words, len(keep or [])), FOUND + kept_types(rows))
    return with_kept(found, keep)


def with_planted_tail(doc_id: Column, text: Column) -> Column:
    """``text`` for nine documents in ten; the tenth repeats a short stretch from some word to its end.

    With h = crc32 of the decimal id and g = floor(h / 10), a document with h % 10 = 0 and n > 0 words has as word i >= a its
    word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id plants nothing.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("bigint")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        bound = F.array(F.struct(a.alias("a"), p.alias("p")))
        changed = F.transform(bound, lambda b: F.transform(w, lambda x, i: F.when(i < b["a"], x).otherwise(F.get(w, (b["a"] + (i - b["a"]) % b["p"]).cast("int")))))
        return F.when(n > 0, F.array_join(changed[0], " ")).otherwise("")

    return F.when((h % 10 == 0) & text.isNotNull(), F.transform(F.array(words), planted)[0]).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the run of most periods (ties: smallest start, then period) and hashes of runs and collapsed text."""
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda m, r: F.when(r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m),
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
