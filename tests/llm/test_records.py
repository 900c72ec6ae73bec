"""Token records against the tokenizer, a bitwise checksum and a reader that walks the frames."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortry.llm import pretokens, queries, token_records
from cohortry.session import scratch_path


@pytest.fixture(scope="module")
def words():
    return queries.public_tokenizers.path(queries.WORD_TOKENIZER)


def slow_crc(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (token_records.POLYNOMIAL if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def slow_mask(data):
    crc = slow_crc(data)
    return (((crc >> 15) | (crc << 17)) + token_records.MASK) & 0xFFFFFFFF


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_checksums_of_many_strings():
    assert slow_crc(b"123456789") == 0xE3069283  # the check value of CRC-32C
    rng, lengths = np.random.default_rng(1), [0, 1, 3, 63, 64, 65, 127, 128, 129, 453, 9, 0, 5000]
    data = rng.integers(0, 256, sum(lengths), dtype=np.uint8)
    ends = np.cumsum(lengths)
    got = token_records.crc32c(data, ends - lengths, ends)
    assert got.tolist() == [slow_crc(data[e - n : e].tolist()) for e, n in zip(ends, lengths, strict=True)]


def test_frames_round_trip():
    rng = np.random.default_rng(2)
    ids = (rng.integers(0, 1 << 32, 3000, dtype=np.uint64) >> rng.integers(0, 32, 3000).astype(np.uint64)).astype(np.uint32)
    names, edges = [None, -5, 0, 1 << 62], np.array([0, 0, 1, 700, 3000])
    data, sizes = token_records.frames(names, ids, edges)
    raw = np.frombuffer(data, np.uint8)
    got = token_records.unframe(raw, np.cumsum(sizes) - sizes, sizes)
    assert got[0] == names and np.array_equal(got[1], ids) and np.array_equal(got[2], edges)
    for flipped in (0, 9, 40, len(raw) - 1):
        broken = raw.copy()
        broken[flipped] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(broken, np.cumsum(sizes) - sizes, sizes)


def test_parts_are_encoded_independently(words):
    rng = random.Random(5)
    alphabet = [*"aBz'' streΣσςvelmd019 \n\t\r  .,!|éñßİ  　́中٣½Ⅷ​\U0001f600\x85\x1c\x1f‍<>|"]
    alphabet += ["<|endoftext|>", "<|startoftext|>", "'ll", "'re ", "5's"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(8_000)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ids, edges = token_records.token_ids(pretokens.encoder(words), np.frombuffer(b"".join(raw), np.uint8), offsets, 1)
    library = Tokenizer.from_file(words)
    want = [[*x.ids, 1] for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == want


def test_files_and_both_ways_to_read(spark, awkward, words):
    path, library = scratch_path(spark, "records"), Tokenizer.from_file(words)
    # Files of a few bytes, so that there are many.
    token_records.write(awkward.repartition(4), words, path, end_id=1, file_bytes=200)
    rows = sorted(awkward.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, start = [], 0
    for r in rows:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, packed(ids)))
        start += len(ids)
    got = token_records.read(spark, path).collect()
    assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in got), key=lambda x: x[1]) == want
    shuffled = [(r.doc_id, bytes(r.ids)) for r in token_records.read_shuffled(spark, path, seed=3).collect()]
    assert sorted(shuffled, key=repr) == sorted(((d, i) for d, _, i in want), key=repr) and shuffled != [(d, i) for d, _, i in want]
    assert [(r.doc_id, bytes(r.ids)) for r in token_records.read_shuffled(spark, path, seed=3).collect()] == shuffled
    # A reader that knows only the framing: lengths, then checksums, then records; files in the order of the manifest.
    at = iter(want)
    for f in token_records.files(spark, path).orderBy("start").collect():
        system, folder = token_records.fs.FileSystem.from_uri(f"{path}/records")
        data = system.open_input_stream(f"{folder}/{f.file}.records").read()
        place, n = 0, 0
        while place < len(data):
            (size,) = struct.unpack_from("<Q", data, place)
            assert struct.unpack_from("<I", data, place + 8)[0] == slow_mask(data[place : place + 8])
            record = data[place + 12 : place + 12 + size]
            if size < 5_000:
                assert struct.unpack_from("<I", data, place + 12 + size)[0] == slow_mask(record)
            doc_id, (a, b) = token_records.parse_record(memoryview(record), 0, size)
            wanted = next(at)
            assert doc_id == wanted[0] and packed(token_records.unpack_varints(np.frombuffer(record[a:b], np.uint8))[0]) == wanted[2]
            place, n = place + 16 + size, n + 1
        assert (n, len(data)) == (f.records, f.bytes)


def test_digest_and_nothing(spark, awkward, empty, words):
    path = scratch_path(spark, "records")
    token_records.write(awkward, words, path)
    got = {r.doc_id: r for r in token_records.digest(token_records.read(spark, path)).collect()}
    assert got[2].n_tokens == 1 and got[2].ids_crc32 == zlib.crc32(packed([1])) and got[None].start == 0
    path = scratch_path(spark, "records")
    token_records.write(empty, words, path)
    assert token_records.read(spark, path).count() == 0 and token_records.read_shuffled(spark, path).count() == 0


def test_one_id_on_most_rows(spark, words):
    docs = spark.range(20_000, numPartitions=8).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("one two").alias("text"))
    path = scratch_path(spark, "records")
    token_records.write(docs, words, path, file_bytes=4_000)
    got = token_records.read(spark, path).orderBy("start").collect()
    assert [r.start for r in got] == list(range(0, 60_000, 3)) and [r.doc_id for r in got] == [7] * 15_000 + list(range(15_000, 20_000))
    assert token_records.files(spark, path).count() > 3


def test_words_of_letters_go_to_the_model_and_give_the_ids_of_the_tokenizer(words, monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    whole, enc = Tokenizer.from_file(words), pretokens.Encoder(words)
    # A task has one core; threads of the library's own took others' time.
    assert pretokens.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    calls = []

    class Counted:
        def encode_batch_fast(self, pieces, **how):
            calls.extend(pieces)
            return whole.encode_batch_fast(pieces, **how)

    enc.tokenizer = Counted()
    pieces = ["Word", "UNDENPFERST", "a", "x" * 3000, "don't", "été", "H̱", "7", "...", "<|endoftext|>", "<|EndOfText|>", "ΑΣ", "Kelvin", "İ", "ab1"]
    first, count, ids = enc.encode_flat(pieces)
    assert [ids[a : a + n].tolist() for a, n in zip(first, count, strict=True)] == [whole.encode(p, add_special_tokens=False).ids for p in pieces]
    assert not [p for p in calls if p.isascii() and p.isalpha()] and len(calls) == 10


def test_other_tokenizers_get_every_piece(words):
    whole = Tokenizer.from_file(queries.public_tokenizers.path("byte_bpe_50k.json"))
    assert pretokens._model_of_words(whole, {}) is None
    assert pretokens._model_of_words(Tokenizer.from_file(words), {"EOT": 1}) is None


def test_values_of_all_lengths():
    values = np.array([0, 127, 128, 16383, 16384, 2097151, 2097152, (1 << 28) - 1, 1 << 28, (1 << 32) - 1], np.uint32)
    for some in (values, values[:0], values[:2], values[::-1]):
        data, edges = token_records.varints(some)
        assert [data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)] == [token_records._varint(int(v)) for v in some]
        back, ends = token_records.unpack_varints(data)
        assert back.tolist() == some.tolist() and ends.tolist() == edges[1:].tolist()
