"""The first file of a 7z archive, as lines. Streams that are copied, LZMA or LZMA2 are read, with the standard library's decoder."""

from __future__ import annotations

import io
import lzma
import struct
from collections.abc import Iterable, Iterator

#: Fixed values of the format: the signature, the ids of properties, and the ids of methods.
SIGNATURE = b"7z\xbc\xaf\x27\x1c"
END, HEADER, PACK_INFO, UNPACK_INFO, SUB_STREAMS, SIZE, CRC, FOLDER, UNPACK_SIZE, N_STREAMS, ENCODED = 0, 1, 6, 7, 8, 9, 10, 11, 12, 13, 23
COPY, LZMA, LZMA2 = b"\x00", b"\x03\x01\x01", b"\x21"
PIECE = 1 << 20


class _Fields(io.BytesIO):
    def byte(self) -> int:
        got = self.read(1)
        if not got:
            raise ValueError("the archive is cut off")
        return got[0]

    def number(self) -> int:
        """The leading ones of the first byte say how many bytes follow; its other bits are the highest."""
        first, value = self.byte(), 0
        for k in range(8):
            if not first & (0x80 >> k):
                return value | (first & ((0x80 >> k) - 1)) << (8 * k)
            value |= self.byte() << (8 * k)
        return value

    def flags(self, n: int) -> list[bool]:
        if self.byte():
            return [True] * n
        raw = self.read((n + 7) // 8)
        return [bool(raw[k // 8] & (0x80 >> k % 8)) for k in range(n)]

    def skip_digests(self, n: int) -> None:
        self.read(4 * sum(self.flags(n)))


def _streams(f: _Fields) -> tuple[int, list[int], list[list[tuple[bytes, bytes]]], list[list[int]], list[int] | None]:
    """Where packed streams begin and their sizes; of each folder its coders and the sizes of what they give; the files' sizes if told."""
    at, packed, folders, sizes, parts = 0, [], [], [], None
    while (kind := f.number()) != END:
        if kind == PACK_INFO:
            at, n = f.number(), f.number()
            while (own := f.number()) != END:
                if own == SIZE:
                    packed = [f.number() for _ in range(n)]
                elif own == CRC:
                    f.skip_digests(n)
        elif kind == UNPACK_INFO:
            if f.number() != FOLDER:
                raise ValueError("no folder in the archive")
            n, outside = f.number(), f.byte()
            if outside:
                raise ValueError("folders stored elsewhere aren't read")
            for _ in range(n):
                coders = []
                for _ in range(f.number()):
                    flags = f.byte()
                    if flags & 0x10:
                        raise ValueError("coders of several streams aren't read")
                    method = f.read(flags & 15)
                    coders.append((method, f.read(f.number()) if flags & 0x20 else b""))
                for _ in range(len(coders) - 1):  # which coder reads which: a chain, in order
                    f.number(), f.number()
                folders.append(coders)
            while (own := f.number()) != END:
                if own == UNPACK_SIZE:
                    sizes = [[f.number() for _ in coders] for coders in folders]
                elif own == CRC:
                    f.skip_digests(n)
        elif kind == SUB_STREAMS:
            parts, counts = [], [1] * len(folders)
            while (own := f.number()) != END:
                if own == N_STREAMS:
                    counts = [f.number() for _ in folders]
                elif own == SIZE:
                    parts = [f.number() for n in counts for _ in range(max(0, n - 1))]
                elif own == CRC:
                    f.skip_digests(sum(counts))
        else:
            raise ValueError(f"unknown property {kind}")
    return at, packed, folders, sizes, parts


def _decoded(pieces: Iterable[bytes], method: bytes, properties: bytes, size: int) -> Iterator[bytes]:
    if method == COPY:
        yield from pieces
        return
    if method == LZMA2:
        bits = properties[0]
        filters = [{"id": lzma.FILTER_LZMA2, "dict_size": 0xFFFFFFFF if bits == 40 else (2 | bits & 1) << (bits // 2 + 11)}]
    elif method == LZMA:
        first, dictionary = struct.unpack("<BI", properties)
        filters = [{"id": lzma.FILTER_LZMA1, "dict_size": dictionary, "lc": first % 9, "lp": first // 9 % 5, "pb": first // 45}]
    else:
        raise ValueError(f"method {method.hex()} isn't read")
    decoder, left = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=filters), size
    for piece in pieces:
        while left and not decoder.eof:
            got = decoder.decompress(piece, min(left, PIECE))
            piece, left = b"", left - len(got)
            if got:
                yield got
            elif decoder.needs_input:
                break


def _folder(data: bytes, at: int, packed: int, coders: list[tuple[bytes, bytes]], sizes: list[int]) -> Iterator[bytes]:
    pieces: Iterable[bytes] = (data[k : min(k + PIECE, at + packed)] for k in range(at, at + packed, PIECE))
    for (method, properties), size in reversed(list(zip(coders, sizes))):  # the last coder is the one that reads the archive
        pieces = _decoded(pieces, method, properties, size)
    return iter(pieces)


def first_file(data: bytes) -> Iterator[bytes]:
    """The first file's bytes, piece by piece. Raises ValueError for what isn't such an archive."""
    if data[:6] != SIGNATURE or len(data) < 32:
        raise ValueError("not a 7z archive")
    offset, size = struct.unpack_from("<QQ", data, 12)
    f = _Fields(data[32 + offset : 32 + offset + size])
    kind = f.number() if size else END
    while kind == ENCODED:
        at, packed, folders, sizes, _ = _streams(f)
        f = _Fields(b"".join(_folder(data, 32 + at, packed[0], folders[0], sizes[0])))
        kind = f.number()
    if kind != HEADER or f.number() != 4:  # the streams of the archive
        return
    at, packed, folders, sizes, parts = _streams(f)
    if not folders:
        return
    left = parts[0] if parts else sizes[0][0]
    for piece in _folder(data, 32 + at, packed[0], folders[0], sizes[0]):
        yield piece[:left]
        left -= len(piece)
        if left <= 0:
            return


class _Reader(io.RawIOBase):
    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.held:
            self.held = next(self.pieces, None)
            if self.held is None:
                self.held = b""
                return 0
        n = min(len(target), len(self.held))
        target[:n], self.held = self.held[:n], self.held[n:]
        return n


def grouped(lines: Iterable[str], n: int = 1000) -> Iterator[list[str]]:
    """Lines without their ends, n at a time."""
    group: list[str] = []
    for line in lines:
        group.append(line.rstrip("\n"))
        if len(group) == n:
            yield group
            group = []
    if group:
        yield group


def line_groups(data: bytes, n: int = 1000) -> Iterator[list[str]]:
    """The lines of the archive's first file, n at a time."""
    return grouped(io.TextIOWrapper(io.BufferedReader(_Reader(first_file(data)), PIECE), "utf-8", "replace", newline="\n"), n)
