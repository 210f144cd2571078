"""A shard of token ids as a wavelet matrix: bit planes with rank and select, in one compressed file.

The plane of the highest bit comes first; after each plane the ids are split stably into those with a 0
and those with a 1. Any id is found, counted and located through the planes, without decoding the rest.

File: magic, header length, JSON header, then zstandard frames of the lengths that the header names:
document ids with a null map, document lengths, and per plane its packed bits and the ones before each
block of ``RANK_BLOCK`` bits.
"""

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WVMX\x01"
RANK_BLOCK = 512


class Wavelet:
    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        """``planes`` are packed bits, ``ranks`` the ones before each block."""
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> "Wavelet":
        ids = np.asarray(ids, np.uint32)
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        left = ids.astype(np.uint16) if levels <= 16 else ids
        planes, ranks = [], []
        for level in range(levels - 1, -1, -1):
            bits = (left >> level) & 1 == 1
            planes.append(np.packbits(bits))
            ranks.append(_ranks(planes[-1]))
            left = np.concatenate((left[~bits], left[bits]))
        return cls(len(ids), planes, ranks)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n).view(bool)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // RANK_BLOCK
        start = block * RANK_BLOCK // 8
        ones = int(self.ranks[level][block]) + _ones(self.planes[level][start : i // 8])
        if i % 8:
            ones += int(self.planes[level][i // 8] >> (8 - i % 8)).bit_count()
        return ones

    def decode(self) -> np.ndarray:
        """All ids in order."""
        ids = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for depth in range(len(self.planes) - 1, -1, -1):
            bits = self._bits(depth)
            before = np.empty_like(ids)
            zeros = self.zeros[depth]
            before[~bits] = ids[:zeros]
            before[bits] = ids[zeros:] | (1 << (len(self.planes) - 1 - depth))
            ids = before
        return ids.astype(np.uint32)

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, plane in enumerate(self.planes):
            bit = int(plane[i // 8]) >> (7 - i % 8) & 1
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _descend(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """The range below the last plane of those among ``start:stop`` that equal ``token``."""
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = self._rank1(level, start), self._rank1(level, stop)
            if token >> (len(self.planes) - 1 - level) & 1:
                start, stop = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of ``token`` among the positions ``start:stop``."""
        stop = self.n if stop is None else min(stop, self.n)
        a, b = self._descend(token, min(start, stop), stop)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence of ``token``, from 0."""
        first, last = self._descend(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for level in range(len(self.planes) - 1, -1, -1):
            if token >> (len(self.planes) - 1 - level) & 1:
                i = self._select(level, i - self.zeros[level], True)
            else:
                i = self._select(level, i, False)
        return i

    def _select(self, level: int, k: int, one: bool) -> int:
        """Position of the ``k``-th one (or zero) of a plane, from 0."""
        ranks = self.ranks[level].astype(np.int64)
        if not one:
            ranks = np.minimum(np.arange(len(ranks)) * RANK_BLOCK, self.n) - ranks
        block = int(np.searchsorted(ranks, k, side="right")) - 1
        start = block * RANK_BLOCK // 8
        bits = np.unpackbits(self.planes[level][start : start + RANK_BLOCK // 8])
        inside = np.flatnonzero(bits == one)[k - int(ranks[block])]
        return block * RANK_BLOCK + int(inside)


def _ones(plane: np.ndarray) -> int:
    return int(np.bitwise_count(plane).sum(dtype=np.int64))


def _ranks(plane: np.ndarray) -> np.ndarray:
    width = RANK_BLOCK // 8
    counts = np.add.reduceat(np.bitwise_count(plane), range(0, len(plane), width), dtype=np.int64) if len(plane) else []
    return np.concatenate(([0], np.cumsum(counts))).astype(np.uint32)


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One shard file: documents in order, their lengths and all their ids."""
    wavelet = Wavelet.build(ids)
    known = np.array([i is not None for i in doc_ids], bool)
    named = np.array([i or 0 for i in doc_ids], "<i8")
    parts = [np.packbits(known), named, np.array(lengths, "<u4")]
    for plane, rank in zip(wavelet.planes, wavelet.ranks):
        parts += [plane, rank.astype("<u4")]
    packer = zstandard.ZstdCompressor(level=1)
    frames = [packer.compress(p.tobytes()) for p in parts]
    header = json.dumps(
        {"docs": len(doc_ids), "ids": len(ids), "levels": len(wavelet.planes), "frames": [len(f) for f in frames]}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *frames])


def load(data: bytes) -> tuple[list[int | None], np.ndarray, Wavelet]:
    """Document ids, lengths and the wavelet matrix of a shard file."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC) + 4
    (size,) = struct.unpack("<I", data[at - 4 : at])
    header = json.loads(data[at : at + size])
    at += size
    frames = []
    unpacker = zstandard.ZstdDecompressor()
    for length in header["frames"]:
        frames.append(unpacker.decompress(data[at : at + length]))
        at += length
    known = np.unpackbits(np.frombuffer(frames[0], np.uint8), count=header["docs"]).view(bool)
    doc_ids = np.frombuffer(frames[1], "<i8").tolist()
    doc_ids = [i if k else None for i, k in zip(doc_ids, known)]
    planes = [np.frombuffer(f, np.uint8) for f in frames[3::2]]
    ranks = [np.frombuffer(f, "<u4") for f in frames[4::2]]
    return doc_ids, np.frombuffer(frames[2], "<u4"), Wavelet(header["ids"], planes, ranks)
