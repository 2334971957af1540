"""Secret scans: pattern matches, and candidates that decode to a key's or token's structure.

Base kinds are patterns (``assign``, ``access``, ``hex``).  Structural kinds are reported only
after they have been taken apart:

``der``      base64 or hex whose bytes are a DER sequence with nested lengths that fit exactly and
             that begins as private keys do: version 0 or 1, then an integer of 32 bytes or more
             (RSA, DSA), an algorithm sequence with an object identifier and an octet string
             (PKCS#8) or an octet string of 20 to 66 bytes (EC); PKCS#8's encrypted form likewise
``openssh``  base64 or hex of ``openssh-key-v1`` with the length-prefixed cipher, key derivation and keys
``pem``      a ``BEGIN ... PRIVATE KEY`` block whose body, after any header lines, is one of the two, or
             that names a cipher (``DEK-Info``) with an initial vector and has a body that fits it
``jwt``      three base64url parts, of which the first is a JSON object with a string ``alg`` and
             the second a JSON object; the third may be empty only if ``alg`` is ``none``; a full stop
             may stand before or after, no fourth part

A candidate is a maximal run, decoded whole, whatever its length; or what follows a ``/``, ``+``, ``-`` or ``_`` in it (a key after a
path) if its length is the one that its first bytes state; or lines of base64 of one length and a last one up to it (a wrapped
key without ``BEGIN``).  Base64 whose bytes are a PEM block is taken apart once more.  Hex may have colons between bytes.  Spans are code points,
end exclusive.  Null text: empty, no spans.  Equal rows are all kept; a column named like the result is replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from turnstile.llm.rows import map_texts

#: Order of kinds that start at the same place.
KINDS = ("assign", "access", "hex", "der", "openssh", "pem", "jwt")
BASE = KINDS[:3]

# The patterns of the base kinds.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

#: Every assignment has one of these; searching for them first passes over other text quickly.
ASSIGN_MARK = re.compile(r"[:=]")
#: 40 digits: the shortest DER private key is longer.
RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
LONG_HEX = re.compile(r"[0-9a-f]{60,}|[0-9A-F]{60,}")
COLON_HEX = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::\s{0,40}[0-9A-Fa-f]{2}){29,}+(?![0-9A-Fa-f])")
LINE = re.compile(r"\r?\n[\x20\t]*([A-Za-z0-9+/]+)(={0,2})")
#: Where a key may begin inside a run: base64 of a DER sequence, or of OpenSSH's magic.
INNER = re.compile(r"(?<=[/+_-])(?:M[A-Z]|b3BlbnNzaC1rZXktdjE)")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,3}PRIVATE KEY)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
PEM_HEADER = re.compile(r"\s*([A-Za-z][A-Za-z0-9-]*):(.*)")
DEK_INFO = re.compile(r"([A-Za-z0-9-]+),\s*((?:[0-9A-Fa-f]{16}){1,2})")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+)(?!\.[A-Za-z0-9_-])")

SPANS = [T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]), False))]
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _decode64(run: str) -> bytes | None:
    """Standard or URL-safe base64, padded or not; None if it is neither."""
    run = run.rstrip("=").translate({45: "+", 95: "/"})
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill ``data`` exactly, by DER's rules for lengths; else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(data):
                return None
            n = int.from_bytes(data[at:at + k], "big")
            if n < 0x80 or data[at] == 0:  # not the shortest form
                return None
            at += k
        if at + n > len(data):
            return None
        out.append((tag, data[at:at + n]))
        at += n
    return out


def is_private_key(data: bytes) -> bool:
    """A DER private key: RSA, DSA, EC, PKCS#8 or encrypted PKCS#8."""
    top = der_fields(data) if data[:1] == b"\x30" else None
    inner = der_fields(top[0][1]) if top and len(top) == 1 else None
    if not inner or len(inner) < 2:
        return False
    (tag, first), (tag2, second) = inner[:2]
    if tag == 0x30 and tag2 == 0x04 and len(inner) == 2:
        return _algorithm(first) and len(second) >= 16
    if tag != 0x02 or first not in (b"\x00", b"\x01"):
        return False
    if tag2 == 0x02:
        return len(inner) >= 6 and len(second) >= 32 and all(t == 0x02 and v for t, v in inner[:6])
    if tag2 == 0x30:
        return len(inner) >= 3 and _algorithm(second) and inner[2][0] == 0x04 and len(inner[2][1]) >= 16
    return tag2 == 0x04 and 20 <= len(second) <= 66


def _algorithm(data: bytes) -> bool:
    fields = der_fields(data)
    return bool(fields) and fields[0][0] == 0x06 and len(fields[0][1]) >= 3


def is_openssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at, parts = len(magic), []
    for _ in range(3):  # cipher, key derivation, its options
        if at + 4 > len(data):
            return False
        n = int.from_bytes(data[at:at + 4], "big")
        parts.append(data[at + 4:at + 4 + n])
        at += 4 + n
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not parts[0] or not parts[1] or not 1 <= keys <= 64:
        return False
    for _ in range(keys + 1):  # public keys, then the private part
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at == len(data)


def pem_parts(body: str) -> tuple[dict[str, str], str]:
    """Header lines by name (lower case) and the base64 after them, without white space.

    A line that is indented more than its header, or that follows a backslash, continues it."""
    body = body.replace("\\n", "\n")
    if "DEK-Info:" in body:  # lines may have been joined
        body = re.sub(r"\s+(?=DEK-Info:)", "\n", body)
        body = re.sub(r"(DEK-Info:\s*[A-Za-z0-9-]+,\s*[0-9A-Fa-f]+)[^\S\n]+", r"\1\n", body)
    lines = body.strip("\r\n").splitlines()
    headers: dict[str, str] = {}
    name, indent, at = "", 0, 0
    for at, line in enumerate([*lines, ""]):  # noqa: B007
        depth = len(line) - len(line.lstrip())
        if m := PEM_HEADER.match(line):
            name, indent = m[1].lower(), depth
            headers[name] = m[2].strip()
        elif name and line.strip() and (depth > indent or headers[name].endswith("\\")):
            headers[name] = headers[name].removesuffix("\\") + line.strip()
        elif line.strip() or headers:
            break
    return headers, "".join("".join(lines[at:]).split())


def is_pem_key(body: str) -> bool:
    headers, run = pem_parts(body)
    data = _decode64(run)
    if not data:
        return False
    if is_private_key(data) or is_openssh_key(data):
        return True
    cipher = DEK_INFO.fullmatch(headers.get("dek-info", ""))
    if not cipher or "ENCRYPTED" not in headers.get("proc-type", "").upper():
        return False
    stream = cipher[1].upper().endswith(("CFB", "CFB1", "CFB8", "OFB", "CTR"))
    return len(data) >= 32 and (stream or len(data) % (len(cipher[2]) // 2) == 0)


def is_token_header(head: str, body: str, sign: str) -> bool:
    try:
        header, claims = (json.loads(_decode64(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    return (_decode64(sign) is not None) if sign else header["alg"].lower() == "none"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if ASSIGN_MARK.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _key_kind(data: bytes | None) -> str | None:
    """What private key the bytes are; a PEM block counts if its body is one."""
    if not data:
        return None
    if data[0] == 0x30:
        return "der" if is_private_key(data) else None
    if is_openssh_key(data):
        return "openssh"
    if data.startswith(b"-----BEGIN "):
        m = PEM.match(data.decode("latin-1"))
        return "pem" if m and is_pem_key(m[2]) else None
    return None


def _stated_length(start: str) -> int | None:
    """The bytes that a DER sequence says it has, from its first base64 characters."""
    head = _decode64(start[:8])
    if not head or head[0] != 0x30:
        return None
    n, k = head[1], 0
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or len(head) < 2 + k:
            return None
        n = int.from_bytes(head[2:2 + k], "big")
    return 2 + k + n


def _wrapped(text: str, first: re.Match) -> tuple[str, int]:
    """A run and the lines of its length that follow, up to a shorter one: their base64, and where they end."""
    run, at = first[0], first.end()
    while m := LINE.match(text, at):
        if len(m[1]) + len(m[2]) > len(first[0]):
            break
        run, at = run + m[1] + m[2], m.end()
        if len(m[1]) < len(first[0]) or m[2]:
            break
    return run, at


def structural_spans(text: str) -> list[tuple[str, int, int]]:
    blocks = [m.span() for m in PEM.finditer(text) if is_pem_key(m[2])] if "-----BEGIN " in text else []
    out = [("pem", *span) for span in blocks]
    done = 0
    for m in RUN.finditer(text):
        if m.start() < done:
            continue
        if kind := _key_kind(_decode64(m[0])):
            out.append((kind, *m.span()))
            continue
        if text[m.end():m.end() + 1] in ("\r", "\n") and not any(a < m.start() < b for a, b in blocks):
            run, end = _wrapped(text, m)
            if end > m.end() and (kind := _key_kind(_decode64(run))):
                out.append((kind, m.start(), end))
                done = end
                continue
        for inner in INNER.finditer(m[0]):
            rest = m[0][inner.start():].rstrip("=")
            if inner[0][0] == "M" and _stated_length(rest) != len(rest) * 3 // 4:
                continue
            if kind := _key_kind(_decode64(rest)):
                out.append((kind, m.start() + inner.start(), m.end()))
                break
    for m in LONG_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and m[0][:2] in ("30", "6f", "6F", "2d", "2D") and (kind := _key_kind(bytes.fromhex(m[0]))):
            out.append((kind, *m.span()))
    if ":" in text:
        for m in COLON_HEX.finditer(text):
            if kind := _key_kind(bytes.fromhex("".join(m[0].replace(":", " ").split()))):
                out.append((kind, *m.span()))
    if "." in text:
        at = 0
        while m := JWT.search(text, at):
            found = is_token_header(*m.groups())
            at = m.end() if found else m.end(1)  # a token may begin with the second part
            if found:
                out.append(("jwt", *m.span()))
    return out


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed, then end."""
    return sorted({*base_spans(text), *structural_spans(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(texts: pa.Array) -> list:
    rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t)] if t else [] for t in texts.to_pylist()]
    return [pa.array(rows, _SPANS_ARROW)]


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus spans: array of (kind, start, end), ordered.  A column named spans is replaced."""
    return map_texts(docs, SPANS, _scan, keep=docs.columns, text_col=text_col)


MASK = "[secret]"


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each maximal run of overlapping spans replaced."""
    out, at = [], 0
    end = -1
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= end:
            out += [text[at:a], MASK]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "masked") -> DataFrame:
    """``docs`` plus ``out_col``: the text without its secrets, null where nothing was found."""

    def run(texts: pa.Array) -> list:
        found = [(t, spans_of(t) if t else []) for t in texts.to_pylist()]
        return [pa.array([masked(t, s) if s else None for t, s in found], pa.string())]

    return map_texts(docs, [T.StructField(out_col, T.StringType())], run, keep=docs.columns, text_col=text_col)
