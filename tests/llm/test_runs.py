"""Periodic runs against a word-by-word search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortry.llm import periodic_runs
from cohortry.llm.periodic_runs import Extensions, find_runs


def slow_runs(words, least_periods=4, least_words=6):
    n, found = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        if h % 10 == 0:
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    runs, dropped = slow_runs(words), set()
    for s, n, q in runs:
        dropped.update(range(s + q, s + n))
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(kept))


def test_cover():
    pairs = {((a - b) % 31) for a in periodic_runs.COVER for b in periodic_runs.COVER if a != b}
    assert pairs == set(range(1, 31)) and periodic_runs.SHIFTS.max() <= 30


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_extensions(alphabet):
    rng = np.random.default_rng(alphabet)
    for n in (1, 2, 40, 700):
        symbols = np.append(rng.integers(0, alphabet, n), -1)
        if n == 700:
            symbols[300:500] = symbols[100:300]
        a, b = rng.integers(0, n + 1, 500), rng.integers(0, n + 1, 500)
        a, b = a[a != b], b[a != b]
        got = Extensions(symbols).common(a, b)
        for x, y, k in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
            want = 0
            while max(x, y) + want <= n and symbols[x + want] == symbols[y + want]:
                want += 1
            assert k == want


def test_runs_of_many_texts():
    rng = random.Random(1)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 25)):
            t = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(0, 90))]
            if rng.random() < 0.5 and t:
                t += t[-rng.randrange(1, len(t) + 1) :] * rng.randrange(1, 9) + [rng.randrange(3)] * rng.randrange(9)
            texts.append(t)
        values, counts = np.array([w for t in texts for w in t], np.uint64), np.array([len(t) for t in texts])
        got = list(zip(*(x.tolist() for x in find_runs(values, counts)), strict=True))
        assert got == [(i, *r) for i, t in enumerate(texts) for r in slow_runs(t)]
    values = np.array([w for t in texts for w in t], np.uint64)
    got = list(zip(*(x.tolist() for x in find_runs(values, counts, 5, 2)), strict=True))
    assert got == [(i, *r) for i, t in enumerate(texts) for r in slow_runs(t, 5, 2)]


def test_grids_larger_than_a_block(monkeypatch):
    monkeypatch.setattr(periodic_runs, "GRID", 50)
    rng = np.random.default_rng(4)
    counts = np.array([0, 300, 1, 0, 77])
    values = rng.integers(0, 2, counts.sum()).astype(np.uint64)
    got = list(zip(*(x.tolist() for x in find_runs(values, counts)), strict=True))
    assert got == [(i, *r) for i, (a, n) in enumerate(zip(np.cumsum(counts) - counts, counts, strict=True)) for r in slow_runs(values[a : a + n].tolist())]


def rows_of(docs):
    changed = periodic_runs.with_planted_tail(docs["doc_id"], docs["text"])
    got = periodic_runs.digest(periodic_runs.periodic_runs(docs, text=changed)).collect()
    return sorted((tuple(r) for r in got), key=repr)


def test_query_rows(spark, awkward):
    rng = random.Random(7)
    texts = [(i, rng.choice(["\n", " ", " \t"]).join(rng.choice("ab ca dé fgh".split() + [" x"]) for _ in range(rng.randrange(60)))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").unionByName(awkward.select("doc_id", "text").where("length(text) < 1000 or text is null"))
    want = sorted((slow_row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert rows_of(docs.repartition(3)) == want
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts) > 20


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000")
    assert rows_of(docs) == sorted((slow_row(r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_long_texts_and_other_columns(spark, awkward, empty):
    one = spark.createDataFrame([(1, "a " * 200_000, "x"), (2, "b c " * 50_000 + "d", "y")], "doc_id bigint, text string, runs string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(one, keep=["runs", "text"]).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 200_000, 1)] and got[1].collapsed == "a" and got[1].kept_runs == "x"
    assert [tuple(r) for r in got[2].runs] == [(0, 100_000, 2)] and got[2].collapsed == "b c d" and got[2].n_words == 100_001
    found = periodic_runs.periodic_runs(awkward).collect()
    assert len(found) == awkward.count() and sum(r.doc_id is None for r in found) == 1
    assert [[tuple(x) for x in r.runs] for r in found if r.doc_id == 7] == [[(0, 120_000, 1994)]]
    assert periodic_runs.digest(periodic_runs.periodic_runs(empty)).count() == 0
