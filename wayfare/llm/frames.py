"""Patched frame-of-reference coding of token ids.

Ids are cut into blocks. From a block its minimum is subtracted; what remains is
packed at a width that a chosen percentile of the block fits, and values beyond
it are kept in the block's exception list. An index of block starts lets a
reader decode any range alone.

File (little-endian): header; blocks; document table (id, null flag, tokens);
block index. A block: minimum u32, width u8, unused u8, exceptions u16, packed
values, exception places u16, exception values u32. The last block is padded
with its own last value; the header knows the true number of ids.
"""

from __future__ import annotations

import struct

import numpy as np

#: A multiple of eight.
BLOCK = 1024
PERCENTILE = 90
MAGIC = b"TPF1"
HEADER = struct.Struct("<4sIQQIIQQ")  # magic, block size, ids, documents, blocks, unused, document table, index
BLOCK_HEAD = struct.Struct("<IBBH")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width as rows of bytes: each eight values fill ``width`` bytes, lowest bits first."""
    rows, block = values.shape
    eights = values.astype(np.uint64).reshape(rows, block // 8, 8)
    out = np.zeros((rows, block // 8, width + 8), np.uint8)
    for lane in range(8):
        at, shift = divmod(lane * width, 8)
        moved = eights[:, :, lane] << np.uint64(shift)
        for k in range((shift + width + 7) // 8):
            out[:, :, at + k] |= ((moved >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out[:, :, :width].reshape(rows, -1)


def _unpack(data: np.ndarray, width: int, block: int) -> np.ndarray:
    """The values again: eight bytes are read from where each value begins, then shifted and masked."""
    padded = np.zeros((len(data), data.shape[1] + 8), np.uint8)
    padded[:, :data.shape[1]] = data
    words = np.ndarray((len(data), data.shape[1] + 1), "<u8", padded, strides=(padded.shape[1], 1))
    first = np.arange(block) * width
    values = (words[:, first >> 3] >> (first & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)
    return values.astype(np.uint32)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> list[bytes]:
    if not len(ids):
        return []
    full = -(-len(ids) // block) * block
    rows = np.concatenate([ids, np.full(full - len(ids), ids[-1])]).astype(np.int64).reshape(-1, block)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    at = min(block - 1, block * percentile // 100)
    widths = np.frompyfunc(int.bit_length, 1, 1)(np.partition(rest, at, axis=1)[:, at].astype(object)).astype(np.int64)
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        beyond = rest[chosen] >= (1 << int(width))
        packed = _pack(np.where(beyond, 0, rest[chosen]), int(width)) if width else np.zeros((len(chosen), 0), np.uint8)
        for i, b in enumerate(chosen):
            places = np.flatnonzero(beyond[i])
            out[b] = b"".join((
                BLOCK_HEAD.pack(low[b], width, 0, len(places)), packed[i].tobytes(), places.astype("<u2").tobytes(),
                rest[b][places].astype("<u4").tobytes()))
    return out


def write_file(doc_ids: list[int | None], each: list[np.ndarray], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """One file of whole documents."""
    ids = np.concatenate(each) if each else np.zeros(0, np.int64)
    blocks = [b for at in range(0, len(ids), 64 * block) for b in encode_blocks(ids[at:at + 64 * block], block, percentile)]
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    starts = HEADER.size + np.cumsum(sizes) - sizes
    docs_at = HEADER.size + int(sizes.sum())
    docs = b"".join((
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([len(e) for e in each], "<u8").tobytes()))
    head = HEADER.pack(MAGIC, block, len(ids), len(each), len(blocks), 0, docs_at, docs_at + len(docs))
    return b"".join((head, *blocks, docs, starts.astype("<u8").tobytes()))


class TokenFile:
    """Reads a file's documents, or any range of its ids through the block index."""

    def __init__(self, data: bytes):
        self.data = data
        magic, self.block, self.n_ids, self.n_docs, self.n_blocks, _, docs_at, index_at = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        n = self.n_docs
        flags = np.frombuffer(data, np.uint8, n, docs_at + 8 * n)
        self.doc_ids = [None if f else int(d) for d, f in zip(np.frombuffer(data, "<i8", n, docs_at), flags)]
        self.lengths = np.frombuffer(data, "<u8", n, docs_at + 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.index = np.frombuffer(data, "<u8", self.n_blocks, index_at).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only the blocks between are decoded."""
        first, last = start // self.block, -(-stop // self.block)
        heads = [BLOCK_HEAD.unpack_from(self.data, at) for at in self.index[first:last]]
        out = np.zeros((len(heads), self.block), np.uint32)
        widths = np.array([h[1] for h in heads], np.int64)
        for width in np.unique(widths) if len(heads) else ():
            size = (self.block * int(width) + 7) // 8
            chosen = np.flatnonzero(widths == width)
            if width:
                rows = np.stack([np.frombuffer(self.data, np.uint8, size, self.index[first + i] + BLOCK_HEAD.size) for i in chosen])
                out[chosen] = _unpack(rows, int(width), self.block)
            for i in chosen:
                many = heads[i][3]
                if many:
                    at = int(self.index[first + i]) + BLOCK_HEAD.size + size
                    places = np.frombuffer(self.data, "<u2", many, at)
                    out[i, places] = np.frombuffer(self.data, "<u4", many, at + 2 * many)
        out += np.array([h[0] for h in heads], np.uint32)[:, None]
        return out.reshape(-1)[start - first * self.block:stop - first * self.block]

    def documents(self):
        """(id, first place, ids) of each document, a few blocks at a time."""
        step = 64 * self.block
        held, base = np.zeros(0, np.uint32), 0
        for doc_id, start, length in zip(self.doc_ids, self.starts.tolist(), self.lengths.tolist()):
            if start + length > base + len(held):
                stop = min(self.n_ids, max(start + length, start + step))
                held, base = self.ids(start, stop), start
            yield doc_id, start, held[start - base:start + length - base]
