"""Dynamic itemset counting and collocations against plain counting."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from cohortry.llm import collocations, queries
from cohortry.session import settle


def slow_counts(rows, longest=4):
    counts = Counter()
    for lang, text in rows:
        lang, lower = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang, 0, ""] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, k, " ".join(words[i : i + k])] += 1
    return counts


def slow_rows(rows, least, top):
    counts = slow_counts(rows)
    f = {(lang, p): n for (lang, k, p), n in counts.items() if k and n >= least}
    out = []
    for lang in {k[0] for k in counts}:
        made = []
        for (own, phrase), a in f.items():
            w = phrase.split(" ")
            if own != lang or len(w) < 2:
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
                cuts.append((int(Fraction(2_000_000 * a, left + right)), k, left, right))
            score, _, left, right = min(cuts)
            longer = [n for (o, p), n in f.items() if o == lang and len(p.split(" ")) > len(w) and f" {phrase} " in f" {p} "]
            if not any(100 * n >= 80 * a for n in longer):
                made.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(made)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, counts[lang, 0, ""], -score))
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["New", "york", "é", "中", "a\x00b", "x-y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["new york city hall", "ab cd ef gh ij"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choices(vocabulary, weights)[0] for _ in range(rng.randrange(40))]
        joints = rng.choices([" ", "  ", "\t", ". ", ",", "\n", " ? "], [60, 3, 3, 4, 2, 2, 2], k=len(parts))
        out.append((rng.choice(["en", "en", "en", "fr", None]), "".join(p + j for p, j in zip(parts, joints, strict=True))))
    return out + [("en", None), (None, ""), ("fr", " .. ,\t")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 7) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string, phrase string, n int")


@pytest.mark.parametrize("shards", [1, 4])
def test_counts_of_all_shards(spark, shards):
    rows = texts(1)
    got = {(r.lang, r["size"], r.phrase): r.n for r in collocations.frequent_phrases(frame(spark, rows).repartition(3), least=5, shards=shards).collect()}
    assert got == {k: n for k, n in slow_counts(rows).items() if n >= 5 or not k[1]}


def test_shared_cells_cost_work_and_nothing_else(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_CELLS", 16)
    monkeypatch.setattr(collocations, "CELLS", 16)
    rows = texts(2, 150)
    got = {(r.lang, r["size"], r.phrase): r.n for r in collocations.frequent_phrases(frame(spark, rows), least=6).collect()}
    assert got == {k: n for k, n in slow_counts(rows).items() if n >= 6 or not k[1]}


def test_phrases_that_reach_the_threshold_late(spark):
    # A phrase of words that are rare in most shards begins late and still completes its cycle.
    rows = [("en", "only here now then")] * 31 + [("en", f"filler{i}") for i in range(200)]
    got = {r.phrase: r.n for r in collocations.frequent_phrases(frame(spark, rows), least=30, shards=3).where("size = 4").collect()}
    assert got == {"only here now then": 31}


def test_collocations(spark):
    rows = texts(3)
    phrases = settle(collocations.frequent_phrases(frame(spark, rows), least=5), "t-phrases")
    for top in (3, 2000):
        found = collocations.collocations(phrases, top=top)
        assert sorted(tuple(r) for r in found.collect()) == slow_rows(rows, 5, top)


def test_scores_beyond_64_bits(spark):
    rows = [("en", 0, "", 1 << 62), ("en", 1, "a", 1 << 61), ("en", 1, "b", (1 << 61) + 3), ("en", 2, "a b", (1 << 61) - 5)]
    phrases = spark.createDataFrame([(a, b, c, d) for a, b, c, d in rows], "lang string, size int, phrase string, n bigint")
    (row,) = collocations.collocations(phrases).collect()
    assert row.score == 2_000_000 * ((1 << 61) - 5) // ((1 << 62) + 3) and row.n == 1 << 62


def test_awkward_rows(spark, awkward, empty):
    got = {(r.lang, r["size"], r.phrase): r.n for r in collocations.frequent_phrases(awkward, least=1).collect()}
    assert got == {k: n for k, n in slow_counts([(r.lang, r.text) for r in awkward.collect()]).items() if k[1] or n}
    assert collocations.collocations(collocations.frequent_phrases(empty)).count() == 0


def test_packed_counts():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64))
    counts, ages = rng.integers(1, 1 << 40, len(keys)), rng.integers(0, 5, len(keys))
    for n in (0, 1, len(keys)):
        got = collocations.unpack(collocations.pack(keys[:n], counts[:n], ages[:n]))
        assert all(np.array_equal(a, b[:n]) for a, b in zip(got, (keys, counts, ages), strict=True))
    added = collocations._added([keys, keys[::3]], [counts, counts[::3]], [ages, ages[::3] + 1])
    assert np.array_equal(added[0], keys) and added[1].sum() == counts.sum() + counts[::3].sum() and added[2][0] == ages[0] + 1


def test_small_ranges_and_full_tasks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE", 50)
    monkeypatch.setattr(collocations, "HELD", 40)
    rows = texts(4, 120)
    got = {(r.lang, r["size"], r.phrase): r.n for r in collocations.frequent_phrases(frame(spark, rows), least=5).collect()}
    assert got == {k: n for k, n in slow_counts(rows).items() if n >= 5 or not k[1]}


def test_phrase_text_and_hash():
    data = np.frombuffer(b"ab  c\td ab  c", np.uint8)
    starts, ends = np.array([0, 4, 6, 8, 12]), np.array([2, 5, 7, 10, 13])
    assert collocations.texts_of(data, starts, ends, np.array([0, 1, 3]), 2).to_pylist() == ["ab c", "c d", "ab c"]
    words = collocations.span_hashes(collocations.BYTE_VALUES[data], starts, ends)
    hashes = collocations.phrase_hashes(words, np.zeros(5, np.uint64), 2)
    assert hashes[1][0] == hashes[1][3] != hashes[1][1]
    assert "op11_collocations" in queries.ORACLE
