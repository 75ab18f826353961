"""Secret scans: patterns find candidates; decoded structure confirms keys and signed tokens before they are reported."""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import map_batches, pass_over, small_batches

# Kinds in the order in which spans of one start are listed; the first three are the base patterns.
KINDS = ("assign", "access", "hex", "key_block", "key_base64", "key_hex", "signed_token")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Line breaks may be real or escaped, as in JSON and in source strings.
BLOCK_HEAD = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----")
BLOCK = re.compile(BLOCK_HEAD.pattern + r"((?:[A-Za-z0-9+/=\s]++|\\++[nrt/])++)-----END \1-----")
OUTSIDE = re.compile(r"[^A-Za-z0-9+/=\s\\]")
BLANK = re.compile(r"\\+[nrt]|\\+(?=/)|\s")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{40,}(?:[ \t]*+(?:\\++[nr]|[\r\n])++[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
BREAK = re.compile(r"[ \t]*+(?:\\++[nr]|[\r\n])++[ \t]*+")
# How the base64 of a sequence, of an OpenSSH key and of a key block begins.
KEY_START = re.compile(r"M[A-I]|b3BlbnNz|LS0t")
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{48,}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+")
LONG = re.compile(r"[!-~]{20,}")

INTEGER, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
OPENSSH, PEM = b"openssh-key-v1\0", b"-----BEGIN "
# No private key has as many elements side by side; and no OpenSSH file as many keys.
MOST_ELEMENTS, MOST_KEYS = 16, 16

# Gives n bytes from a place on, or what there is of them.
Reader = Callable[[int, int], bytes]


def elements(read: Reader, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The (tag, start, end) elements that fill a stretch exactly, or None if their lengths don't add up. Contents are not read."""
    out = []
    while at < end:
        head = read(at, 6)[: end - at]
        if len(head) < 2 or len(out) == MOST_ELEMENTS:
            return None
        tag, size, at = head[0], head[1], at + 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > end:
                return None
            size, at = int.from_bytes(head[2 : 2 + more], "big"), at + more
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def _openssh_keys(read: Reader) -> tuple[int, int]:
    """The number of keys in an OpenSSH file, and where they begin: behind cipher, key derivation and its options, each with its length."""
    at = len(OPENSSH)
    for _ in range(3):
        at += 4 + int.from_bytes(read(at, 4), "big")
    number = read(at, 4)
    return (int.from_bytes(number, "big") if len(number) == 4 else 0), at + 4


def is_private_key(read: Reader, size: int) -> bool:
    """Whether ``size`` bytes are one of the usual encodings of a private key, down to the nested lengths. Only lengths are read."""
    if read(0, len(OPENSSH)) == OPENSSH:
        return 1 <= _openssh_keys(read)[0] <= MOST_KEYS
    outer = elements(read, 0, size)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = elements(read, *outer[0][1:])
    if not parts or parts[0][0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    tags = [tag for tag, _, _ in parts]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # any algorithm, named by an object id
        named = elements(read, *parts[1][1:])
        return bool(named) and named[0][0] == OBJECT_ID
    if tags[:2] == [INTEGER, OCTETS]:  # elliptic curve
        return parts[1][2] - parts[1][1] >= 16
    return len(tags) >= 6 and set(tags) == {INTEGER}  # the numbers of an RSA or DSA key


def is_key(data: bytes) -> bool:
    return is_private_key(lambda at, n: data[at : at + n], len(data))


def decoded(text: str) -> bytes | None:
    """Base64 in either alphabet, padded or not."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def encoded_reader(run: str, start: int, end: int) -> Reader:
    """Bytes of the base64 in a stretch of a run, of which no more is decoded than is asked for."""

    def read(at: int, n: int) -> bytes:
        first = at // 3
        last = min(start + (at + n + 2) // 3 * 4, end)
        piece = run[start + 4 * first : last]
        data = decoded(piece[: len(piece) - (len(piece) % 4 == 1)]) or b""
        return data[at - 3 * first : at - 3 * first + n]

    return read


def is_encoded_key(run: str) -> bool:
    """Whether a whole run of base64 is a private key."""
    plain = len(run.rstrip("="))
    return plain % 4 != 1 and is_private_key(encoded_reader(run, 0, plain), plain * 3 // 4)


def is_key_block(match: re.Match) -> bool:
    return is_encoded_key(BLANK.sub("", match[2]))


def _block_bytes(read: Reader, size: int) -> int:
    """Bytes of the key block that encoded text begins with; 0 if there is none. Reads on while the text may be a block's body."""
    look = 1 << 12
    while True:
        data = read(0, look).decode("latin-1")
        head = BLOCK_HEAD.match(data)
        stop = head and OUTSIDE.search(data, head.end())
        if not head or stop and stop.start() + 256 <= len(data) or len(data) >= size or len(data) < look:
            block = BLOCK.match(data)
            return block.end() if block and is_key_block(block) else 0
        look *= 4


def _openssh_bytes(read: Reader, size: int) -> int:
    """Bytes of the OpenSSH file that encoded text begins with; 0 if there is none."""
    keys, at = _openssh_keys(read)
    if not 1 <= keys <= MOST_KEYS:
        return 0
    for _ in range(keys + 1):  # the public keys, then the private ones together
        at += 4 + int.from_bytes(read(at, 4), "big")
    return at if at <= size else 0


def key_length(run: str, start: int, end: int) -> int:
    """Characters of the base64 key that begins at ``start``, by the length that the key itself gives; 0 if none does.

    ``end`` is where the run ends, without padding. The work is bounded by the key's own lengths.
    """
    read, size = encoded_reader(run, start, end), (end - start) * 3 // 4
    head = read(0, 16)
    if len(head) < 12:
        return 0
    if head.startswith((PEM, OPENSSH)):
        return -(-(_block_bytes if head.startswith(PEM) else _openssh_bytes)(read, size) * 4 // 3)
    more = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[0] != SEQUENCE or more > 4 or head[2 + more : 4 + more] != bytes([INTEGER, 1]):
        return 0
    size = 2 + more + (int.from_bytes(head[2 : 2 + more], "big") if more else head[1])
    length = -(-size * 4 // 3)
    return length if start + length <= end and is_private_key(encoded_reader(run, start, start + length), size) else 0


def keys_inside(text: str) -> list[tuple[int, int]]:
    """Base64 keys that begin or end inside a run of such characters, or go on over line breaks: start, end, in order."""
    found = []
    for match in WRAPPED.finditer(text):
        whole = match[0]
        # where each line begins in the text, and in the run of all lines together
        begins, joins, lines, at = [], [], [], 0
        for gap in [*BREAK.finditer(whole), None]:
            line = whole[at : gap.start() if gap else len(whole)]
            begins.append(match.start() + at)
            joins.append(joins[-1] + len(lines[-1]) if lines else 0)
            lines.append(line)
            at = gap.end() if gap else at
        run, at = "".join(lines), 0
        end = len(run.rstrip("="))
        while start := KEY_START.search(run, at):
            length = key_length(run, start.start(), end)
            at = start.start() + (length or 1)
            if length:
                first, last = (begins[i] + p - joins[i] for p in (start.start(), at - 1) for i in [bisect_right(joins, p) - 1])
                last += 1
                while last < match.end() and text[last] == "=":
                    last += 1
                found.append((first, last))
    return found


def _meets(spans: list[tuple[int, int, int]], start: int, end: int) -> bool:
    """Whether a stretch overlaps one of the spans, which are in order and do not overlap."""
    at = bisect_left(spans, (end,)) - 1
    return at >= 0 and spans[at][2] > start


def _within(spans: list[tuple[int, int, int]], start: int, end: int) -> bool:
    at = bisect_right(spans, (start, 1 << 62)) - 1
    return at >= 0 and spans[at][2] >= end


def _json_object(segment: str) -> dict | None:
    try:
        value = json.loads(decoded(segment) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    """Three segments: a header that names an algorithm, a body of claims, and a signature unless the algorithm is none."""
    head, body, signature = text.split(".")
    header = _json_object(head)
    if header is None or not isinstance(header.get("alg"), str):
        return False
    claims = "enc" in header or _json_object(body) is not None
    return claims and (bool(signature) or header["alg"].lower() == "none")


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """Spans as (start, kind number, end) in code points, ordered by start, then kind."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if LONG.search(text):
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        blocks = [(m.start(), 3, m.end()) for m in BLOCK.finditer(text) if is_key_block(m)]
        runs = [(m.start(), 4, m.end()) for m in BASE64.finditer(text) if is_encoded_key(m[0])]
        inside = [(start, 4, end) for start, end in keys_inside(text) if not _meets(blocks, start, end)]
        runs = [r for r in runs if not _within(inside, r[0], r[2])]  # first lines of longer keys
        found += blocks + runs + [k for k in inside if not _meets(runs, k[0], k[2])]
        found += [(m.start(), 5, m.end()) for m in HEX_BLOB.finditer(text) if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0]))]
        found += [(m.start(), 6, m.end()) for m in SIGNED.finditer(text) if is_signed_token(m[0])]
    return sorted(found)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text: doc_id, spans (array of kind, start, end; code points, end exclusive).

    The base kinds are assignments to secret names, access ids and runs of hex digits. The other kinds
    are reported only when their decoded content holds: a private key in a block, in bare base64 or in hex (nested
    lengths must add up; breaks of lines may be escaped, base64 may be wrapped or have other characters before and after it), and a signed token (header, claims, signature). Null and empty texts have no spans; rows
    are judged one by one, also equal ones; a text of any length is searched whole, in one task, in time and memory in proportion to
    it; an empty table gives no rows. Other columns are not read, and nothing is shuffled.
    """

    def run(parts):
        for part in parts:
            spans = [
                [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in find_secrets(text)]
                for text in part["text"].to_pylist()
            ]
            yield {"doc_id": part["doc_id"], "spans": spans}

    columns = {"doc_id": F.col("doc_id"), "text": F.coalesce(F.col("text"), F.lit(""))}
    return pass_over(docs, columns, "doc_id void, spans array<struct<kind:string,start:long,end:long>>", run)


def masked(text: str, mask: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced."""
    out, at = [], 0
    for start, _, end in find_secrets(text):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """All rows and columns, with the secrets in ``text`` masked; n_chars, if there, follows the new text. Nulls stay null."""
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in small_batches(batches, at):
            texts = batch.column(at).to_pylist()
            new = [None if t is None else masked(t, mask) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if chars is not None:
                old = columns[chars].to_pylist()
                counts = [n if a == b else len(b) for n, a, b in zip(old, texts, new)]
                columns[chars] = pa.array(counts, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, run, docs.schema)
