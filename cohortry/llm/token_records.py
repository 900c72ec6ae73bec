"""Token ids as files of length-delimited binary records, with an offset index beside each file.

A frame is the record's length (8 bytes), the masked checksum of those 8 bytes (4), the record, and the record's masked
checksum (4), all little-endian. Checksums are CRC-32C, rotated right by 15 bits plus a constant, so that a checksum of
data that holds checksums stays useful. A record is a protocol buffer of two named integer lists, ``doc_id`` and ``ids``
(an Example message); ids are packed variable-length integers. Readers of this common framing can read the files.

The index of a file has an entry of 16 bytes for each frame, its offset and its size, and ends with the masked checksum
of the entries. It makes shuffled reads possible without a scan.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.pretokens import code_point_offsets, encoder
from cohortry.llm.scan import BYTE_VALUES, bound_batches, give_back, slices, span_hashes, spans

#: Fixed values of the format: the reflected CRC-32C polynomial and the constant of the mask.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8

#: A file is closed once it holds so many bytes; no file depends on how a key is distributed.
FILE_BYTES = 64 << 20
#: Distinct parts of texts whose ids a worker keeps, about 60 bytes each.
PARTS = 1_200_000
#: Bytes of ids in an Arrow batch on the way back.
BATCH_BYTES = 4 << 20

MANIFEST = "file string, records bigint, tokens bigint, bytes bigint, first_id bigint, first_row bigint"
RECORD = "doc_id bigint, start bigint, ids binary"
ENTRY = "file string, offset bigint, size bigint, start bigint"


# Checksums of many byte strings at once. A CRC is linear over bits, so that of a long string is put together from those
# of pieces of 64 bytes: advance the left one over the right one's length, then add. Zeros in front of a string change
# nothing as long as the register starts at zero; the usual start value is added at the end, advanced over the length.


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _tables(images: np.ndarray) -> np.ndarray:
    """Four tables of 256, one for each byte of a register, of the linear map with these images of the 32 bits."""
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            out[byte] ^= np.where(np.arange(256) >> bit & 1, images[8 * byte + bit], np.uint32(0)).astype(np.uint32)
    return out


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = tables[0][x & 0xFF] ^ tables[1][(x >> 8) & 0xFF]
    return out ^ tables[2][(x >> 16) & 0xFF] ^ tables[3][x >> 24]


class _Advance:
    """Maps that carry a register over 2**k zero bytes."""

    def __init__(self) -> None:
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        table = _byte_table()
        self.maps = [_tables(table[bits & 0xFF] ^ (bits >> 8))]

    def over(self, k: int) -> np.ndarray:
        while len(self.maps) <= k:
            bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
            self.maps.append(_tables(_apply(self.maps[-1], _apply(self.maps[-1], bits))))
        return self.maps[k]


ADVANCE = _Advance()


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32C of ``data[start:end]`` for each span."""
    lengths = (ends - starts).astype(np.int64)
    lanes = -(-lengths // 64)
    first = np.cumsum(lanes) - lanes
    padded = np.zeros(int(lanes.sum()) * 64, np.uint8)
    # Each string ends where its last lane ends.
    target = (first + lanes) * 64 - lengths
    edges = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()))
    padded[place + np.repeat(target - edges, lengths)] = data[place + np.repeat(starts - edges, lengths)]
    words = padded.view("<u4").reshape(-1, 16)
    step = ADVANCE.over(2)
    register = np.zeros(len(words), np.uint32)
    for i in range(16):
        register = _apply(step, register ^ words[:, i])
    # Neighbours within a string are joined from its right end until one lane is left.
    count, level = lanes, 6
    while len(count) and count.max() > 1:
        own = np.repeat(np.arange(len(count)), count)
        start = np.cumsum(count) - count
        rank = np.arange(len(register)) - start[own]
        odd = (count[own] & 1).astype(bool)
        right = (rank + odd) % 2 == 1
        right &= ~(odd & (rank == 0))
        joined = register.copy()
        at = np.flatnonzero(right)
        joined[at] ^= _apply(ADVANCE.over(level), register[at - 1])
        register = joined[right | (odd & (rank == 0))]
        count, level = -(-count // 2), level + 1
    out = np.zeros(len(lengths), np.uint32)
    out[lanes > 0] = register
    begin = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    for bit in range(int(lengths.max()).bit_length() if len(lengths) else 0):
        chosen = lengths >> bit & 1 == 1
        begin[chosen] = _apply(ADVANCE.over(bit), begin[chosen])
    return ~(out ^ begin)


def masked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    crc = crc32c(data, starts, ends)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def masked_one(data: bytes) -> int:
    return int(masked(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes of unsigned 32-bit values, one after the other, and the offset of each."""
    size = np.ones(len(values), np.int8)
    most = 1
    while most < 5 and (longer := values >= 1 << 7 * most).any():
        size += longer
        most += 1
    edges = np.zeros(len(values) + 1, np.int64)
    np.cumsum(size, out=edges[1:])
    out = np.zeros(edges[-1], np.uint8)
    # The last byte of a value has no mark; all before it have one.
    place, rest, left = edges[:-1], values, size
    for _ in range(most):
        out[place] = rest & np.uint32(127) | np.left_shift(left > 1, 7, dtype=np.uint32)
        here = left > 1
        place, rest, left = place[here] + 1, rest[here] >> np.uint32(7), left[here] - 1
    return out, edges


def unpack_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of variable-length bytes, and the offset at which each one ends."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    byte, here, k = data[starts], None, 0
    out = (byte & 127).astype(np.uint64)
    while len(more := np.flatnonzero(byte > 127)):
        here, k = more if here is None else here[more], k + 1
        byte = data[starts[here] + k]
        out[here] |= (byte & 127).astype(np.uint64) << np.uint64(7 * k)
    return out, ends


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes((*out, value))


@lru_cache(1 << 14)
def _field(number: int, size: int) -> bytes:
    """Tag and length of a length-delimited field."""
    return bytes([number << 3 | 2]) + _varint(size)


@lru_cache(1 << 14)
def _list_head(name: bytes, size: int) -> bytes:
    """All bytes of a named integer list up to its ``size`` packed bytes."""
    packed = _field(1, size)
    integers = _field(3, len(packed) + size)
    inside = len(integers) + len(packed) + size
    entry = _field(1, len(name)) + name + _field(2, inside)
    return _field(1, len(entry) + inside) + entry + integers + packed


def record_head(doc_id: int | None, size: int) -> bytes:
    """All bytes of a record before its ``size`` bytes of ids."""
    ids = _list_head(b"ids", size)
    own = b"" if doc_id is None else _list_head(b"doc_id", len(_varint(doc_id))) + _varint(doc_id)
    return _field(1, len(own) + len(ids) + size) + own + ids


def _read_varint(data: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: memoryview, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Number, start and end of each length-delimited field."""
    while at < end:
        tag, at = _read_varint(data, at)
        if tag & 7 != 2:
            raise ValueError(f"field type {tag & 7} in a record of integer lists")
        size, at = _read_varint(data, at)
        yield tag >> 3, at, at + size
        at += size


def parse_record(data: memoryview, at: int, end: int) -> tuple[int | None, tuple[int, int]]:
    """The document's id and the span of the packed ids of a record."""
    found: dict[bytes, tuple[int, int]] = {}
    for _, a, b in _fields(data, at, end):
        for _, c, d in _fields(data, a, b):
            (_, e, f), (_, g, h) = _fields(data, c, d)
            _, i, j = next(_fields(data, g, h))
            found[bytes(data[e:f])] = next(_fields(data, i, j))[1:]
    doc_id = None
    if b"doc_id" in found:
        doc_id = _read_varint(data, found[b"doc_id"][0])[0]
        doc_id -= (doc_id >> 63) << 64
    return doc_id, found[b"ids"]


def frames(names: list[int | None], ids: np.ndarray, edges: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The frames of records with these ids, and the size of each frame."""
    packed, places = varints(ids)
    body, at = memoryview(packed), places[edges].tolist()
    records = [b"".join((record_head(n, b - a), body[a:b])) for n, a, b in zip(names, at[:-1], at[1:], strict=True)]
    sizes = np.array([len(r) for r in records], "<u8")
    ends = np.cumsum(sizes.astype(np.int64))
    sums = masked(np.frombuffer(b"".join(records), np.uint8), ends - sizes.astype(np.int64), ends).astype("<u4").tobytes()
    eight = np.arange(len(records)) * 8
    heads, lengths = masked(sizes.view(np.uint8), eight, eight + 8).astype("<u4").tobytes(), sizes.tobytes()
    parts = []
    for i, record in enumerate(records):
        parts += (lengths[8 * i : 8 * i + 8], heads[4 * i : 4 * i + 4], record, sums[4 * i : 4 * i + 4])
    return b"".join(parts), sizes.astype(np.int64) + 16


def unframe(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, token ids and the edges of each document's, of the frames at ``offsets``. Checks every checksum."""
    span = np.arange(8)
    lengths = data[offsets[:, None] + span].view("<u8").ravel().astype(np.int64) if len(offsets) else np.zeros(0, np.int64)
    if not np.array_equal(lengths + 16, sizes):
        raise ValueError("a record's length is not that of the index")
    for starts, ends in ((offsets, offsets + 8), (offsets + 12, offsets + 12 + lengths)):
        stored = data[ends[:, None] + span[:4]].view("<u4").ravel() if len(ends) else np.zeros(0, np.uint32)
        if not np.array_equal(masked(data, starts, ends), stored):
            raise ValueError("a record does not match its checksum")
    view, names, lists = memoryview(data), [], []
    for a, n in zip((offsets + 12).tolist(), lengths.tolist(), strict=True):
        name, place = parse_record(view, a, a + n)
        names.append(name)
        lists.append(data[place[0] : place[1]])
    ids, ends = unpack_varints(np.concatenate(lists) if lists else np.zeros(0, np.uint8))
    edges = np.searchsorted(ends, np.cumsum([len(x) for x in lists]), "right") if lists else np.zeros(0, np.int64)
    return names, ids.astype("<u4"), np.concatenate([[0], edges]).astype(np.int64)


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the parts of texts that the tokenizer encodes independently of each other.

    Texts are cut at ASCII white space, which is dropped, and between two other ASCII characters of unlike kinds (letter,
    digit, mark) or two digits, but not after an apostrophe before a letter (contractions), nor between a bar and a letter
    (special strings). No normaliser looks across such a cut and no pre-token spans one.
    """
    kind = np.full(256, 4, np.uint8)
    kind[:128] = 3
    kind[48:58], kind[65:91], kind[97:123], kind[[9, 10, 11, 12, 13, 32]] = 2, 1, 1, 0
    of = kind[data]
    starts, ends, _ = spans(of > 0, offsets)
    left, right = of[:-1], of[1:]
    cut = (left > 0) & (right > 0) & (left < 4) & (right < 4) & ((left != right) | (left == 2))
    cut &= ~((right == 1) & ((data[:-1] == 39) | (data[:-1] == 124))) & ~((left == 1) & (data[1:] == 124))
    inner = np.flatnonzero(cut) + 1
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    inner = inner[~begins[inner]]
    starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def token_ids(enc, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each text of a slice with ``end_id`` after them, and the edges of each text's. Distinct parts are encoded once."""
    starts, ends, owner = chunks(data, offsets)
    distinct, at, inverse = np.unique(span_hashes(BYTE_VALUES[data], starts, ends), return_index=True, return_inverse=True)
    points = code_point_offsets(data, np.concatenate([starts[at], ends[at]]))
    first, count = enc.lookup(distinct, data.tobytes().decode(), points[: len(at)], points[len(at) :])
    first, count = first[inverse], count[inverse]
    own = np.bincount(owner, weights=count, minlength=len(offsets) - 1).astype(np.int64) + 1
    edges = np.concatenate([[0], np.cumsum(own)])
    ids = np.full(edges[-1], end_id, np.uint32)
    before = np.cumsum(count) - count
    source = np.repeat((first - before).astype(np.int32), count)
    source += np.arange(len(source), dtype=np.int32)
    # All places but the last of each text take the parts' ids in their order.
    inside = np.ones(len(ids), bool)
    inside[edges[1:] - 1] = False
    ids[inside] = enc.ids[source]
    return ids, edges


class _Part:
    """A file of records and its index, written frame by frame."""

    def __init__(self, folder: str, first_id: int | None, first_row: int) -> None:
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}"
        self.out = self.system.open_output_stream(f"{self.folder}/{self.name}.records")
        self.first, self.bytes, self.tokens, self.sizes = (first_id, first_row), 0, 0, []

    def write(self, data: bytes, sizes: np.ndarray, tokens: int) -> None:
        self.out.write(data)
        self.bytes, self.tokens = self.bytes + len(data), self.tokens + tokens
        self.sizes.append(sizes)

    def close(self) -> tuple:
        self.out.close()
        sizes = np.concatenate(self.sizes)
        entries = np.stack([np.cumsum(sizes) - sizes, sizes], 1).astype("<u8").tobytes()
        with self.system.open_output_stream(f"{self.folder}/{self.name}.index") as out:
            out.write(entries + struct.pack("<I", masked_one(entries)))
        return (self.name, len(sizes), self.tokens, self.bytes, *self.first)


def _write(folder: str, tokenizer: str, end_id: int, file_bytes: int):
    def run(batches):
        enc, part = encoder(tokenizer, PARTS), None
        schema = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("records", "tokens", "bytes", "first_id", "first_row"))])
        for batch in batches:
            names, rows = batch.column("_id").to_pylist(), batch.column("_row")
            for first, data, offsets in slices(batch, "_text"):
                ids, edges = token_ids(enc, data, offsets, end_id)
                n = len(offsets) - 1
                made, sizes = frames(names[first : first + n], ids, edges)
                if part is None:
                    part = _Part(folder, names[first], rows[first].as_py())
                part.write(made, sizes, len(ids))
                if part.bytes >= file_bytes:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, part.close(), strict=True))], schema)
                    part = None
        if part is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, part.close(), strict=True))], schema)

    return run


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, id_column: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of all documents to record files under ``path``, a folder URI that every executor reaches.

    A document's ids are those of its whole text, without added special tokens, then ``end_id``. Documents lie in ascending
    order of their integer id, null ids first; rows of one id follow each other in the order of the table. They are sorted
    by id and row number, so that one id on many rows is spread over many tasks and files.

    Each task writes files under names of its own, and ``path/manifest`` lists the files of the tasks that counted: a
    repeated task leaves files that nothing reads. Null and empty texts are the end id alone; repeated rows are written each;
    an empty table gives an empty manifest; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text"))
    ordered = bound_batches(rows).orderBy(F.col("_id").asc_nulls_first(), "_row")
    ordered.mapInArrow(_write(f"{path}/records", tokenizer, end_id, file_bytes), MANIFEST).write.mode("error").parquet(f"{path}/manifest")


def _index(system: fs.FileSystem, path: str) -> tuple[np.ndarray, np.ndarray]:
    with system.open_input_stream(path) as source:
        data = source.read()
    if struct.unpack("<I", data[-4:])[0] != masked_one(data[:-4]):
        raise ValueError(f"{path} does not match its checksum")
    entries = np.frombuffer(data[:-4], "<u8").reshape(-1, 2).astype(np.int64)
    return entries[:, 0], entries[:, 1]


def _records(names: list[int | None], starts: np.ndarray, ids: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    offsets = pa.py_buffer((edges * 4).astype(np.int64))
    binary = pa.Array.from_buffers(pa.large_binary(), len(names), [None, offsets, pa.py_buffer(ids)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(starts, pa.int64()), binary], ["doc_id", "start", "ids"])


def _groups(sizes: np.ndarray, limit: int = BATCH_BYTES // 2) -> Iterator[tuple[int, int]]:
    """Neighbouring frames of about ``limit`` bytes together; a longer frame is alone."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def _scan(folder: str):
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                offsets, sizes = _index(system, f"{root}/{row['file']}.index")
                start = row["start"]
                with system.open_input_stream(f"{root}/{row['file']}.records") as source:
                    for a, b in _groups(sizes):
                        data = np.frombuffer(source.read(int(sizes[a:b].sum())), np.uint8)
                        names, ids, edges = unframe(data, offsets[a:b] - offsets[a], sizes[a:b])
                        yield _records(names, start + edges[:-1], ids, edges)
                        start += len(ids)
                give_back()

    return run


def _entries(folder: str):
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                offsets, sizes = _index(system, f"{root}/{row['file']}.index")
                arrays = [pa.array([row["file"]] * len(offsets)), pa.array(offsets), pa.array(sizes), pa.array(np.full(len(offsets), row["start"]))]
                yield pa.RecordBatch.from_arrays(arrays, ["file", "offset", "size", "start"])

    return run


def _seek(folder: str, open_files: int = 64):
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        files: dict[str, object] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] not in files:
                    if len(files) >= open_files:
                        files.pop(next(iter(files))).close()
                    files[row["file"]] = system.open_input_file(f"{root}/{row['file']}.records")
                source = files[row["file"]]
                source.seek(row["offset"])
                data = np.frombuffer(source.read(row["size"]), np.uint8)
                names, ids, edges = unframe(data, np.array([0]), np.array([row["size"]]))
                yield _records(names, edges[:-1], ids, edges).select(["doc_id", "ids"])

    return run


def files(spark: SparkSession, path: str) -> DataFrame:
    """The manifest in the order of the files, with the number of ids in all files before each one (``start``).

    One row for each file of 64 MB, put in order by a window over these rows alone.
    """
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_row")
    before = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("start", F.coalesce(before, F.lit(0).cast("bigint")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id start ids`` of every record: ``start`` ids lie before it, ``ids`` are little-endian unsigned 32-bit numbers.

    One file is read by one task, a few megabytes at a time. A frame that does not match its checksums or the index is an
    error. No files give no rows.
    """
    listed = files(spark, path).select("file", "start")
    spread = listed.repartition(max(1, listed.count()), "file")
    return spread.mapInArrow(_scan(f"{path}/records"), RECORD)


def read_shuffled(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """``doc_id ids`` of every record in an order that ``seed`` decides: entries of the indexes are ordered by a hash of
    their place and each record is fetched by its offset."""
    listed = files(spark, path).select("file", "start")
    entries = listed.repartition(max(1, listed.count()), "file").mapInArrow(_entries(f"{path}/records"), ENTRY)
    return entries.orderBy(F.xxhash64("file", "offset", F.lit(seed)), "file", "offset").mapInArrow(_seek(f"{path}/records"), "doc_id bigint, ids binary")


def digest(records: DataFrame) -> DataFrame:
    """``doc_id start n_tokens ids_crc32`` of records that ``read`` returned."""
    n_tokens = F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens")
    return records.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
