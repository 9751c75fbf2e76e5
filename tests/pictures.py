"""PNG bytes for tests, written and read without an image library."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def png(rgb: tuple[int, int, int], height: int = 4, width: int = 6) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = b"".join(b"\0" + bytes(rgb) * width for _ in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """Reads what ``png`` writes; anything else raises."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    width, height = struct.unpack(">II", data[16:24])
    size = struct.unpack(">I", data[33:37])[0]
    lines = np.frombuffer(zlib.decompress(data[41:41 + size]), dtype=np.uint8).reshape(height, 1 + width * 3)
    return lines[:, 1:].reshape(height, width, 3)
