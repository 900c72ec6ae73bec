"""Token counts without token ids: pieces per distinct pre-token, times its frequency in each document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.pretokens import code_point_offsets, encoder
from cohortry.llm.scan import bound_batches, slices

#: A pre-token that stands in more documents of a block than this is dealt by block too, so that no task gets all of them.
FREQUENT = 256
PARTS = 64
#: Documents with counts under way in a task; beyond them partial counts are handed on.
PENDING = 4_000_000

#: Documents in a block at most, so that a place in it takes two bytes, and bytes from which on it is full.
BLOCK = 50_000
BLOCK_BYTES = 24 << 20
HEADER = 255

ENTRY = "hash bigint, block bigint, data binary"
PARTIAL = "block bigint, data binary"
ENTRIES = pa.schema([("hash", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
PARTIALS = pa.schema([("block", pa.int64()), ("data", pa.binary())])
COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, as many as its length."""
    edges = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - edges, lengths)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def _packed(parts: np.ndarray, text: np.ndarray, lengths: np.ndarray, docs: np.ndarray, times: np.ndarray, postings: np.ndarray) -> pa.Array:
    """One binary value an entry: its part, the length and bytes of the pre-token, and three bytes for each posting."""
    sizes = 5 + lengths + 3 * postings
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    out[starts] = parts
    for i in range(4):
        out[starts + 1 + i] = lengths >> (8 * i) & 255
    out[spread(starts + 5, lengths)] = text
    at = np.repeat(starts + 5 + lengths, postings) + 3 * spread(np.zeros(len(postings), np.int64), postings)
    out[at], out[at + 1], out[at + 2] = docs & 255, docs >> 8, times
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(starts, len(out)).astype(np.int32)), pa.py_buffer(out)])


def _unpacked(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens, and document, times and entry of each posting."""
    data, offsets = _buffers(column)
    starts = offsets[:-1]
    lengths = sum(data[starts + 1 + i].astype(np.int64) << (8 * i) for i in range(4))
    postings = (np.diff(offsets) - 5 - lengths) // 3
    edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data[spread(starts + 5, lengths)])])
    at = np.repeat(starts + 5 + lengths, postings) + 3 * spread(np.zeros(len(postings), np.int64), postings)
    return pieces, data[at].astype(np.int64) + (data[at + 1].astype(np.int64) << 8), data[at + 2].astype(np.int64), np.repeat(np.arange(len(starts)), postings)


def _grouped(batches):
    """Batches put together until they fill a block; the larger a block, the fewer entries repeat a pre-token."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= BLOCK_BYTES or sum(x.num_rows for x in held) >= BLOCK:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _entries(path: str):
    """For each block of documents: an entry for each distinct pre-token, and one with the ids and sizes."""

    def block_entries(enc, batch: pa.RecordBatch, block: int):
        hashes, docs, counts, kept = [], [], [], []
        sizes = np.zeros(batch.num_rows, np.int64)
        for first, data, offsets in slices(batch):
            sizes[first : first + len(offsets) - 1] = np.diff(offsets)
            string = data.tobytes().decode()
            starts, ends, found, owner = enc.split(string, code_point_offsets(data, offsets))
            distinct, at, inverse = np.unique(found, return_index=True, return_inverse=True)
            pairs, times = np.unique(inverse * np.int64(len(offsets)) + owner, return_counts=True)
            # What does not fit into a byte is spread over several postings.
            more = -(-times // 255)
            pairs, times = np.repeat(pairs, more), np.minimum(255, np.repeat(times, more) - 255 * spread(np.zeros(len(more), np.int64), more))
            hashes.append(distinct[pairs // len(offsets)])
            docs.append(first + pairs % len(offsets))
            counts.append(times)
            # Bytes of one occurrence of each: from code points back to bytes.
            heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            lengths = heads[ends[at]] - heads[starts[at]]
            kept.append((distinct, lengths, data[spread(heads[starts[at]], lengths)]))
        ids = batch.column("doc_id").cast(pa.int64())
        known = np.array(ids.is_valid().to_pylist(), np.uint8)
        header = bytes([HEADER]) + known.tobytes() + ids.fill_null(0).to_numpy().tobytes() + sizes.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block * 2654435761 % (1 << 61)]), pa.array([block]), pa.array([header], pa.binary())], schema=ENTRIES)
        hashes, docs, counts = (np.concatenate(x) for x in (hashes, docs, counts))
        order = np.argsort(hashes, kind="stable")
        hashes, docs, counts = hashes[order], docs[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        postings = np.diff(np.append(first, len(hashes)))
        # One occurrence of each pre-token, out of the slices.
        _, at = np.unique(np.concatenate([x[0] for x in kept]), return_index=True)
        lengths = np.concatenate([x[1] for x in kept])
        begins = (np.cumsum(lengths) - lengths)[at]
        text, lengths = np.concatenate([x[2] for x in kept]), lengths[at]
        for a in range(0, len(first), 10_000):
            own = slice(a, a + 10_000)
            values = slice(first[a], first[a] + int(postings[own].sum()))
            part = np.where(postings[own] > FREQUENT, 1 + block % PARTS, 0)
            packed = _packed(part, text[spread(begins[own], lengths[own])], lengths[own], docs[values], counts[values], postings[own])
            yield pa.RecordBatch.from_arrays([pa.array(hashes[first[own]].view(np.int64)), pa.array(np.full(len(part), block)), packed], schema=ENTRIES)

    def run(batches):
        enc = encoder(path)
        block = TaskContext.get().partitionId() << 32
        for whole in _grouped(batches):
            for a in range(0, whole.num_rows, BLOCK):
                yield from block_entries(enc, whole.slice(a, BLOCK), block)
                block += 1

    return run


def _sums(path: str):
    """Rows sorted by hash: each distinct pre-token is encoded once, and its pieces added up by document."""

    def flush(pending: dict):
        for block, totals in pending.items():
            docs = np.flatnonzero(totals)
            data = bytes([0]) + docs.astype(np.uint16).tobytes() + totals[docs].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([data], pa.binary())], schema=PARTIALS)

    def run(batches):
        enc = encoder(path)
        pending: dict[int, np.ndarray] = {}
        held, last, pieces = 0, None, 0
        for batch in batches:
            data, offsets = _buffers(batch.column("data"))
            headers = data[offsets[:-1]] == HEADER
            if headers.any():
                yield batch.filter(pa.array(headers)).select(["block", "data"]).cast(PARTIALS)
                batch = batch.filter(pa.array(~headers))
            if not batch.num_rows:
                continue
            hashes = batch.column("hash").to_numpy()
            new = np.concatenate([[hashes[0] != last], hashes[1:] != hashes[:-1]])
            texts, docs, times, entry = _unpacked(batch.column("data"))
            made = np.fromiter(map(len, enc.encode_pieces(texts.filter(pa.array(new)).to_pylist())), np.int64, int(new.sum()))
            per_entry = np.concatenate([[pieces], made])[np.cumsum(new)]
            last, pieces = hashes[-1], int(per_entry[-1])
            amounts = times * per_entry[entry]
            names, which = np.unique(batch.column("block").to_numpy(), return_inverse=True)
            which = which[entry]
            order = np.argsort(which, kind="stable")
            edges = np.searchsorted(which[order], np.arange(len(names) + 1))
            for i, block in enumerate(names.tolist()):
                own = order[edges[i] : edges[i + 1]]
                added = np.bincount(docs[own], weights=amounts[own]).astype(np.int64)
                totals = pending.get(block, added[:0])
                if len(totals) < len(added):
                    held += len(added) - len(totals)
                    totals = np.concatenate([totals, np.zeros(len(added) - len(totals), np.int64)])
                totals[: len(added)] += added
                pending[block] = totals
            if held > PENDING:
                yield from flush(pending)
                pending, held = {}, 0
        yield from flush(pending)

    return run


def _totals(limit: int):
    """Rows sorted by block: the ids and sizes of one block's documents, and their partial counts."""

    def done(header: bytes, totals: np.ndarray) -> pa.RecordBatch:
        n = (len(header) - 1) // 17
        known = np.frombuffer(header, np.uint8, n, 1).astype(bool)
        ids, sizes = (np.frombuffer(header, np.int64, n, 1 + n + i * 8 * n) for i in range(2))
        counts = totals[:n]
        return pa.RecordBatch.from_arrays([pa.array(ids, mask=~known), pa.array(sizes), pa.array(counts), pa.array(counts > limit)], schema=COUNTS)

    def run(batches):
        block, header, totals = None, b"", np.zeros(BLOCK, np.int64)
        for batch in batches:
            for own, value in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                if own != block:
                    if block is not None:
                        yield done(header, totals)
                    block, totals = own, np.zeros(BLOCK, np.int64)
                data = value.as_buffer().to_pybytes()
                if data[0] == HEADER:
                    header = data
                else:
                    n = (len(data) - 1) // 10
                    totals[np.frombuffer(data, np.uint16, n, 1)] += np.frombuffer(data, np.int64, n, 1 + 2 * n)
        if block is not None:
            yield done(header, totals)

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``) of each row.

    ``tokenizer``: path of a byte-level BPE file, the same on every executor. Each block of documents (an Arrow batch)
    hands on its distinct pre-tokens with their frequencies by document; one shuffle brings equal pre-tokens together,
    where the tokenizer encodes each once (a very frequent one once in each of ``PARTS`` parts) and the pieces are
    multiplied and added up by document; a second, narrow shuffle brings the sums of a block together. No token ids are
    made into rows, and no task holds more than one block of documents and a bounded number of sums.

    Null and empty texts have 0 bytes and tokens; a null id stays null; repeated rows and ids give a row each; an empty
    table gives no row. Other columns are ignored. Integer ids.
    """
    rows = bound_batches(docs).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    entries = rows.mapInArrow(_entries(tokenizer), ENTRY)
    dealt = entries.repartition("hash", F.substring("data", 1, 1)).sortWithinPartitions("hash")
    partial = dealt.mapInArrow(_sums(tokenizer), PARTIAL).repartition("block").sortWithinPartitions("block")
    return partial.mapInArrow(_totals(limit), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
