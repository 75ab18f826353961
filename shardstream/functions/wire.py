"""The packed-record wire format: magic bytes, a protobuf message, the MD5 of the message.

Message fields: 1 partition-key table, 2 explicit-hash-key table, 3 records; a record has
1 partition-key index, 2 explicit-hash-key index (optional), 3 data, 4 tags (skipped).
"""

from __future__ import annotations

import hashlib

from .records import DIGEST_BYTES, FRAME_BYTES, MAGIC


def varint_len(value: int) -> int:
    return max(1, (value.bit_length() + 6) // 7)


def field_len(n: int) -> int:
    """Bytes of a length-delimited field with ``n`` bytes of content."""
    return 1 + varint_len(n) + n


def record_len(hash_index: int, n_data: int) -> int:
    """Bytes of a packed record entry; the partition-key index is always 0 (one key per pack)."""
    return field_len(3 + varint_len(hash_index) + field_len(n_data))


def decimal_hash(partition_key: str) -> str:
    """The partition key's MD5 as a decimal number, the hash key of records without an explicit one."""
    return str(int.from_bytes(hashlib.md5(partition_key.encode()).digest(), "big"))


def _varint(value: int) -> bytes:
    if value < 0x80:
        return bytes((value,))
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, content: bytes) -> bytes:
    return bytes([number << 3 | 2]) + _varint(len(content)) + content


def encode_pack(partition_key: str, records: list[tuple[str, bytes]]) -> bytes:
    """Frame (hash key, data) records that share a partition key; hash keys are listed as first met."""
    table, entries = {}, []
    for hash_key, data in records:
        index = _varint(table.setdefault(hash_key, len(table)))
        n_data = _varint(len(data))
        entries += (b"\x1a", _varint(4 + len(index) + len(n_data) + len(data)), b"\x08\x00\x10", index, b"\x1a", n_data, data)
    body = b"".join([_field(1, partition_key.encode()), *(_field(2, h.encode()) for h in table), *entries])
    return MAGIC + body + hashlib.md5(body).digest()


def _fields(view: memoryview):
    """(field number, int or bytes) pairs of a message; raises ValueError when it is cut short."""

    def varint(at):
        value = shift = 0
        while True:
            if at >= len(view) or shift > 63:
                raise ValueError("truncated or overlong varint")
            byte = view[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(view):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 2, 5):
            length, at = varint(at) if kind == 2 else (8 if kind == 1 else 4, at)
            value = view[at : at + length]
            if len(value) < length:
                raise ValueError("truncated field")
            at += length
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, kind, value


def decode_pack(data: bytes) -> list[tuple[str, str | None, bytes]]:
    """(partition key, explicit hash key, data) of each record in a packed record; raises if malformed.

    The digest is not looked at; callers who want it checked compare it in SQL.
    """
    keys, hashes, records = [], [], []
    for number, kind, value in _fields(memoryview(data)[len(MAGIC) : len(data) - DIGEST_BYTES]):
        if kind == 2 and number == 1:
            keys.append(bytes(value).decode())
        elif kind == 2 and number == 2:
            hashes.append(bytes(value).decode())
        elif kind == 2 and number == 3:
            key_index = hash_index = payload = None
            for inner, inner_kind, content in _fields(value):
                if inner == 1 and inner_kind == 0:
                    key_index = content
                elif inner == 2 and inner_kind == 0:
                    hash_index = content
                elif inner == 3 and inner_kind == 2:
                    payload = bytes(content)
            if key_index is None or payload is None:
                raise ValueError("record without partition key index or data")
            records.append((key_index, hash_index, payload))
    try:
        return [(keys[k], None if h is None else hashes[h], payload) for k, h, payload in records]
    except IndexError:
        raise ValueError("table index out of range") from None


__all__ = ["FRAME_BYTES", "decimal_hash", "decode_pack", "encode_pack", "field_len", "record_len", "varint_len"]
