"""Pre-tokens, token counts and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortry.llm import packing, pretokens, token_counts
from cohortry.llm.packing import OpenWindows, best_fit_decreasing


def ids_of(tokenizer, text):
    return Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids


def test_split_is_that_of_the_library(tokenizer):
    rng = random.Random(3)
    alphabet = [*"aBz'' strelvmd019 \n\t\r  .,!|éñß  　中٣½Ⅷ​́\U0001f600", "<|endoftext|>", "'ll", "'re ", " 's", "  "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(5_000)]
    enc, whole = pretokens.Encoder(tokenizer), "".join(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, ends, hashes, owner = enc.split(whole, offsets)
    first, count = enc.lookup(hashes[np.unique(hashes, return_index=True)[1]], whole, *(x[np.unique(hashes, return_index=True)[1]] for x in (starts, ends)))
    at = np.unique(hashes, return_inverse=True)[1]
    got = [[] for _ in texts]
    for k, o in enumerate(owner.tolist()):
        got[o] += enc.ids[first[at[k]] : first[at[k]] + count[at[k]]].tolist()
    library = Tokenizer.from_file(tokenizer)
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_classes_of_all_code_points(tokenizer):
    split = Tokenizer.from_file(tokenizer).pre_tokenizer.pre_tokenize_str
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 1 << 16):
        text = "a".join(points[a : a + (1 << 16)])
        starts, _ = pretokens.pretokens(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.array([0, len(text)]))
        assert starts.tolist() == [x[1][0] for x in split(text)]


def test_encoder_forgets_within_its_limit(tokenizer):
    enc = pretokens.Encoder(tokenizer, limit=50)
    for i in range(40):
        text = f" word{i} again{i} more{i}"
        starts, ends, hashes, _ = enc.split(text, np.array([0, len(text)]))
        distinct, at = np.unique(hashes, return_index=True)
        first, count = enc.lookup(distinct, text, starts[at], ends[at])
        pieces = {text[a:b]: enc.ids[f : f + c].tolist() for a, b, f, c in zip(starts[at], ends[at], first, count, strict=True)}
        assert pieces == {p: ids_of(tokenizer, p) for p in pieces}
        assert len(enc.known[0]) + len(enc.recent[0]) <= 50


def test_counts(spark, awkward, tokenizer):
    rows = awkward.collect()
    got = token_counts.token_counts(awkward, tokenizer, limit=1024).collect()
    want = sorted((repr(r.doc_id), len((r.text or "").encode()), n := len(ids_of(tokenizer, r.text)), n > 1024) for r in rows)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_counts_of_frequent_pretokens(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    monkeypatch.setattr(token_counts, "PENDING", 10)
    docs = spark.range(300).selectExpr("id as doc_id", "concat(repeat('the of ', cast(id * 7 as int)), id) as text").repartition(5)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, tokenizer).collect()}
    assert got == {r.doc_id: len(ids_of(tokenizer, r.text)) for r in docs.collect()}


def test_counts_of_nothing(empty, tokenizer):
    assert token_counts.token_counts(empty, tokenizer).count() == 0
    assert packing.pack(empty, tokenizer).count() == 0


@pytest.mark.parametrize("window", [1, 7, 64, 2048])
def test_best_fit(window):
    rng = random.Random(window)
    lengths = [rng.randint(1, window) for _ in range(400)]
    number, offset = best_fit_decreasing(lengths, window)
    # Brute force: the tightest window by a scan.
    filled: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = [(window - f, k) for k, f in enumerate(filled) if window - f >= lengths[i]]
        assert (number[i] < len(filled)) == bool(room)
        if room:
            assert filled[number[i]] == window - min(room)[0] and offset[i] == filled[number[i]]
        else:
            filled.append(0)
            assert number[i] == len(filled) - 1 and offset[i] == 0
        filled[number[i]] += lengths[i]


def test_tightest_window_of_the_tree():
    windows = OpenWindows(2048)
    for remaining in (5, 100, 100, 2047):
        windows.put(remaining, remaining)
    assert [windows.take(n) for n in (6, 100, 101, 6, 1, 1)] == [(100, 100), (100, 100), (2047, 2047), None, (5, 5), None]


def test_packing(awkward, tokenizer):
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, tokenizer).collect()
    sequences, pieces = {}, {}
    for r in rows:
        ids = np.array([*ids_of(tokenizer, texts[r.doc_id]), 1], "<u4")
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for parts in (*sequences.values(), *pieces.values()):
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end = start + length
    assert max(sum(n for _, n in s) for s in sequences.values()) <= 2048
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {i: len(ids_of(tokenizer, t)) + 1 for i, t in texts.items()}
    # Repeated rows are packed each.
    assert packing.pack(awkward.where("doc_id = 10"), tokenizer).count() == 2
