"""Length-delimited binary records, many at once in numpy.

A record is: its length (8 bytes, little endian), the masked CRC-32C of these 8 bytes, the data, the masked CRC-32C of the
data. Data is a serialised protocol-buffer message of named lists, so that common training readers take the files as they are:
"doc_id", a list of one integer (absent for a null id), and "ids_u16" or "ids_u32", one string of little-endian unsigned integers.
"""

from __future__ import annotations

import struct

import numpy as np

_POLY, _ALL = 0x82F63B78, np.uint32(0xFFFFFFFF)
_BLOCK = 256
HEAD, TAIL = 12, 4


def _table() -> np.ndarray:
    """CRC of each pair of bytes: what 16 bits at the low end of the register become after 16 steps."""
    value = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        value = (value >> np.uint32(1)) ^ (np.uint32(_POLY) * (value & np.uint32(1)))
    return value


_LOW = _table()
_HIGH = _LOW[_LOW & np.uint32(0xFFFF)] ^ (_LOW >> np.uint32(16))  # 16 bits that have 16 steps more to go


def _forward(value: np.ndarray, zeros: int) -> np.ndarray:
    """Registers after so many zero bytes (an even number)."""
    for _ in range(zeros // 2):
        value = _LOW[value & np.uint32(0xFFFF)] ^ (value >> np.uint32(16))
    return value


def _jump() -> np.ndarray:
    """Four tables: what each byte of a register becomes after a block of zeros."""
    each = np.arange(256, dtype=np.uint32)
    return np.stack([_forward(each << np.uint32(8 * k), _BLOCK) for k in range(4)])


_JUMP = _jump()


def _copy(data: np.ndarray, start: np.ndarray, out: np.ndarray, to: np.ndarray, size: np.ndarray) -> None:
    for a, b, n in zip(start.tolist(), to.tolist(), size.tolist(), strict=True):
        out[b : b + n] = data[a : a + n]


def crc32c(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32C of data[start : start + size] for all pieces at once. data: bytes.

    Each piece is laid out so that it ends at the end of a block. Zeros in front of it leave the register at zero, and four bytes
    right before the piece turn it to ones, as a checksum begins. Blocks are worked on side by side, then joined.
    """
    n = len(start)
    blocks = -(-(size + 4) // _BLOCK)
    last = np.cumsum(blocks)
    room = np.zeros(int(last[-1]) * _BLOCK if n else 0, np.uint8)
    if not n:
        return np.zeros(0, np.uint32)
    to = last * _BLOCK - size
    _copy(data, start, room, to, size)
    for k, byte in enumerate(_ONES):
        room[to - 4 + k] ^= byte
    lanes = np.ascontiguousarray(room.view("<u4").reshape(-1, _BLOCK // 4).T)
    value = np.zeros(lanes.shape[1], np.uint32)
    for lane in lanes:
        value ^= lane
        value = _HIGH[value & np.uint32(0xFFFF)] ^ _LOW[value >> np.uint32(16)]
    out = np.zeros(n, np.uint32)
    first = last - blocks
    order = np.argsort(-blocks, kind="stable")
    for k in range(int(blocks.max())):
        live = order[: np.searchsorted(-blocks[order], -k)]
        x = out[live]
        out[live] = _JUMP[0][x & 255] ^ _JUMP[1][(x >> 8) & 255] ^ _JUMP[2][(x >> 16) & 255] ^ _JUMP[3][x >> 24] ^ value[first[live] + k]
    return out ^ _ALL


def _before_ones() -> bytes:
    """Four bytes that turn a register of zeros into one of ones."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    after = _HIGH[bits & np.uint32(0xFFFF)] ^ _LOW[bits >> np.uint32(16)]
    rows = [(int(a), int(b)) for a, b in zip(after, bits, strict=True)]
    want, found = 0xFFFFFFFF, 0
    for bit in range(32):  # solve for the word, bit by bit
        place = next(k for k, (a, _) in enumerate(rows) if a >> bit & 1)
        a, b = rows.pop(place)
        rows = [(x ^ a, y ^ b) if x >> bit & 1 else (x, y) for x, y in rows]
        if want >> bit & 1:
            want, found = want ^ a, found ^ b
    return found.to_bytes(4, "little")


_ONES = _before_ones()


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frame(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the records of the pieces data[start : start + size], offset of each record and the end)."""
    offset = np.append(0, np.cumsum(size + HEAD + TAIL))
    out = np.zeros(int(offset[-1]), np.uint8)
    head = size.astype("<u8").view(np.uint8).reshape(-1, 8)
    lengths = masked(crc32c(head.ravel(), np.arange(len(size)) * 8, np.full(len(size), 8))).astype("<u4").view(np.uint8).reshape(-1, 4)
    sums = masked(crc32c(data, start, size)).astype("<u4").view(np.uint8).reshape(-1, 4)
    for k in range(8):
        out[offset[:-1] + k] = head[:, k]
    for k in range(4):
        out[offset[:-1] + 8 + k] = lengths[:, k]
        out[offset[1:] - 4 + k] = sums[:, k]
    _copy(data, start, out, offset[:-1] + HEAD, size)
    return out, offset


def unframe(data: np.ndarray, offset: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the data of the records at data[offset : offset + size]; ValueError if a length or a checksum is wrong."""
    take = lambda at, n: data[at[:, None] + np.arange(n)]
    length = np.ascontiguousarray(take(offset, 8)).view("<u8").ravel().astype(np.int64)
    if not np.array_equal(length + HEAD + TAIL, size):
        raise ValueError("a record's length isn't that of the index")
    said = np.ascontiguousarray(take(offset + 8, 4)).view("<u4").ravel()
    if not np.array_equal(said, masked(crc32c(data, offset, np.full(len(offset), 8)))):
        raise ValueError("the checksum of a record's length is wrong")
    said = np.ascontiguousarray(take(offset + HEAD + length, 4)).view("<u4").ravel()
    if not np.array_equal(said, masked(crc32c(data, offset + HEAD, length))):
        raise ValueError("the checksum of a record's data is wrong")
    return offset + HEAD, length


def varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, data: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(data)) + data


def messages(ids: list[int | None], tokens: list[memoryview], width: int) -> list[bytes]:
    """A message for each id (or None) and its tokens, integers of `width` bytes."""
    entry = lambda name, kind: _field(1, _field(1, name) + _field(2, kind))
    doc = lambda i: entry(b"doc_id", _field(3, _field(1, varint(i)))) if i is not None else b""
    name = f"ids_u{8 * width}".encode()
    return [_field(1, doc(i) + entry(name, _field(1, _field(1, bytes(t))))) for i, t in zip(ids, tokens, strict=True)]


def _parts(data: memoryview) -> list[tuple[int, memoryview]]:
    """(field, content) of a message whose fields are all length-delimited."""
    out, at = [], 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        key, size = number(), number()
        if key & 7 != 2 or at + size > len(data):
            raise ValueError("not a message of named lists")
        out.append((key >> 3, data[at : at + size]))
        at += size
    return out


def parse_message(data: memoryview) -> tuple[int | None, memoryview, int]:
    """(id or None, tokens, bytes of each token) of a message, its lists in any order."""
    doc, tokens, width = None, memoryview(b""), 4
    for _, features in _parts(data):
        for _, entry in _parts(features):
            named = dict(_parts(entry))
            content = next((c for _, kind in _parts(named[2]) for _, c in _parts(kind)), memoryview(b""))
            name = bytes(named[1])
            if name == b"doc_id":
                raw = sum((b & 127) << (7 * k) for k, b in enumerate(content)) & ((1 << 64) - 1)
                doc = struct.unpack("<q", raw.to_bytes(8, "little"))[0]
            elif name in (b"ids_u16", b"ids_u32"):
                tokens, width = content, 2 if name == b"ids_u16" else 4
    return doc, tokens, width
