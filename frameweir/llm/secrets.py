"""Secrets in text: patterns, and candidates confirmed by the structure they decode to."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from frameweir.llm.common import id_and, pieces, texts_of

# Fixed patterns of the three base kinds, and the least lengths that count.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

# The kinds in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "pem", "token", "der", "openssh"]

# Candidates for decoding. 24 characters hold the shortest key encoding and the
# shortest token header that is looked for.
ENCODED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
# Code over several lines: a long line, and what the next lines begin with.
FOLDED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
# A header is an object, so it begins with a brace, and a quote or a blank: "ey" or "ew".
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=:,\-\s]*?)-----END \1-----")

WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]


# Where a key may begin inside a longer run, as behind "key-" or "certs/": in base64 a
# sequence begins with M, the OpenSSH container with its magic.
INNER = re.compile(r"(?<![^+/_-])(?:M|b3BlbnNzaC1rZXktdjEA)")


# ---- structures ---------------------------------------------------------------------


def _read(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, start and end of the element at `at`; ValueError unless its length fits."""
    if at + 2 > end:
        raise ValueError("too short")
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or at + count > end:
            raise ValueError("bad length")
        size, at = int.from_bytes(data[at : at + count], "big"), at + count
        if size < 0x80:
            raise ValueError("length not in its shortest form")
    if at + size > end:
        raise ValueError("longer than what holds it")
    return tag, at, at + size


def _items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    found = []
    while at < end:
        found.append(_read(data, at, end))
        at = found[-1][2]
    return found


def is_der_key(data: bytes) -> bool:
    """A private key as nested DER: the parts and all their lengths must fit.

    RSA (version and eight integers), DSA (version 0 and five integers), EC (version
    1, octets), PKCS#8 (version, algorithm, octets) and its encrypted form
    (algorithm, octets).
    """
    try:
        tag, at, end = _read(data, 0, len(data))
        if tag != 0x30 or end != len(data):
            return False
        parts = _items(data, at, end)
        tags = [x[0] for x in parts]
        if tags[:1] == [0x02] and parts[0][2] - parts[0][1] == 1:
            version = data[parts[0][1]]
            if version in (0, 1) and len(tags) >= 9 and tags[:9] == [0x02] * 9:
                return parts[1][2] - parts[1][1] >= 32
            if version == 0 and tags == [0x02] * 6:
                return parts[1][2] - parts[1][1] >= 32
            if version == 1 and tags[:2] == [0x02, 0x04] and set(tags[2:]) <= {0xA0, 0xA1}:
                return parts[1][2] - parts[1][1] >= 16
            if version in (0, 1) and tags[:3] == [0x02, 0x30, 0x04] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
                inner = _items(data, *parts[1][1:])
                return bool(inner) and inner[0][0] == 0x06
        if tags == [0x30, 0x04]:
            inner = _items(data, *parts[0][1:])
            return [x[0] for x in inner] == [0x06, 0x30] and parts[1][2] - parts[1][1] >= 16
    except ValueError:
        pass
    return False


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH container: magic, then length-prefixed parts up to the end."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def part() -> bytes:
        nonlocal at
        (size,) = struct.unpack_from(">I", data, at)
        if at + 4 + size > len(data):
            raise ValueError("longer than what holds it")
        at += 4 + size
        return data[at - size : at]

    try:
        part(), part(), part()  # cipher, derivation, its options
        (count,) = struct.unpack_from(">I", data, at)
        at += 4
        if not 1 <= count <= 64:
            return False
        for _ in range(count):
            part()
        return len(part()) >= 8 and at == len(data)
    except (ValueError, struct.error):
        return False


def _base64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _structure(data: bytes | None) -> str | None:
    if not data:
        return None
    if data.startswith(b"-----BEGIN "):  # a whole block, encoded once more
        block = PEM.search(data.decode("latin-1"))
        return "pem" if block and _is_pem_key(block[2]) else None
    return "der" if is_der_key(data) else "openssh" if is_openssh_key(data) else None


def _is_pem_key(body: str) -> bool:
    lines = body.split("\n")
    data = _base64("".join("".join(x for x in lines if ":" not in x).split()))
    heads = [x.strip() for x in lines if ":" in x]  # of the older, encrypted form
    sealed = "Proc-Type: 4,ENCRYPTED" in heads and any(x.startswith("DEK-Info: ") for x in heads)
    return bool(_structure(data) or sealed and data and len(data) % 8 == 0)


def _code_length(code: str) -> int:
    """Characters of base64 that the sequence beginning here takes; 0 if none begins."""
    head = _base64(code[:8]) or b""
    if len(head) < 6 or head[0] != 0x30:
        return 0
    size, count = head[1], head[1] & 0x7F
    if size & 0x80:
        if not 1 <= count <= 4:
            return 0
        size = count + int.from_bytes(head[2 : 2 + count], "big")
    return -(-(2 + size) * 4 // 3)


def coded_keys(run: str, joints: frozenset[int] = frozenset()) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the keys in a run of code: the whole run, or else what
    begins at its start or behind a sign and has, where its own lengths end, a sign,
    the end of a line (`joints`) or of the run."""
    if kind := _structure(_base64(run)):
        return [(0, len(run), kind)]
    found, size, done = [], len(run.rstrip("=")), 0
    for m in INNER.finditer(run):
        start = m.start()
        if start < done:
            continue
        end = start + _code_length(run[start : start + 8]) if m[0] == "M" else size
        stops = end in joints or end == size or end < size and run[end] in "+/_-"
        if start < end and stops and (kind := _structure(_base64(run[start:end]))):
            done = len(run) if end == size else end
            found.append((start, done, kind))
    return found


def is_token(text: str) -> bool:
    """A signed token: header and payload are JSON objects, the header names its
    algorithm, and there is a signature unless that algorithm is "none"."""
    head, body, sign = text.split(".")
    try:
        header = json.loads(_base64(head) or b"")
        payload = json.loads(_base64(body) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(payload, dict) or not isinstance(header.get("alg"), str):
        return False
    return header["alg"].lower() == "none" or len(_base64(sign) or b"") >= 16


# ---- spans --------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(*m.span(), "hex") for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    return found


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans whose decoded content is a key encoding or a signed token."""
    found = []
    for m in PEM.finditer(text):
        if _is_pem_key(m[2]):
            found.append((*m.span(), "pem"))
    found += [(*m.span(), "token") for m in TOKEN.finditer(text) if is_token(m[0])]
    for m in ENCODED.finditer(text):
        found += [(m.start() + start, m.start() + end, kind) for start, end, kind in coded_keys(m[0])]
    for m in FOLDED.finditer(text):
        if any(start < m.end() and m.start() < end and kind == "pem" for start, end, kind in found):
            continue  # the body of a block that is found
        places = [i for i, c in enumerate(m[0], m.start()) if not c.isspace()]
        run = "".join(m[0].split())
        joints = frozenset(i for i in range(1, len(places)) if places[i] > places[i - 1] + 1)
        found += [(places[start], places[end - 1] + 1, kind) for start, end, kind in coded_keys(run, joints)]
    for m in ANY_HEX.finditer(text):
        if kind := _structure(bytes.fromhex(m[0])):
            found.append((*m.span(), kind))
    return found


def _listed(spans: list[tuple[int, int, str]]) -> str:
    order = sorted(set(spans), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


_HEX_BYTE = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
_CODE_BYTE = np.isin(np.arange(256), list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"))


def _full_blocks(raw: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """For each aligned block of eight bytes, whether all of them are allowed."""
    whole = len(raw) // 8 * 8
    return allowed[raw[:whole]].reshape(-1, 8).all(axis=1)


def spans_of(text: str) -> tuple[list, list]:
    """Base spans and structural spans of a text.

    Cheap tests come first and only skip searches that cannot match: 16 hex
    digits in a row hold one aligned block of eight, 24 code characters two.
    """
    raw = text.encode()
    low = raw.lower()
    array = np.frombuffer(raw, np.uint8)
    has_hex = _full_blocks(array, _HEX_BYTE).any()
    code = _full_blocks(array, _CODE_BYTE)
    has_code = bool((code[1:] & code[:-1]).any())
    base = []
    if has_hex or b"AKIA" in raw or any(x in low for x in WORDS):
        base = base_spans(text)
    # The shortest header of a token has 19 characters, and so one aligned block.
    has_token = code.any() and (b"ey" in raw or b"ew" in raw)
    deeper = structural_spans(text) if has_hex or has_code or has_token or b"-----BEGIN" in raw else []
    return base, deeper


SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_confirmed long, confirmed array<struct<kind:string,start:long,end:long,text:string>>"
)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read).

    Three base kinds come from patterns. Candidates in base64 or hex, PEM blocks
    and dotted tokens are decoded, and reported when the decoded bytes parse as
    a key with fitting nested lengths or as a signed token (`n_confirmed`,
    `confirmed` with their texts). Code may be folded over lines, stand behind
    other words and a sign, or hold a PEM block. `spans` lists all, in code points, end
    exclusive. A null text is empty, a null id stays null, repeated rows give
    repeated results, an empty table an empty one. Texts are searched whole.
    One pass, no shuffle.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for text in texts_of(batch):
                base, deeper = spans_of(text)
                kinds = [x[2] for x in base]
                rows.append(
                    {
                        **{f"n_{k}": kinds.count(k) for k in KINDS[:3]},
                        "base_sha256": hashlib.sha256(_listed(base).encode()).hexdigest(),
                        "spans": _listed(base + deeper),
                        "n_confirmed": len(set(deeper)),
                        "confirmed": [
                            {"kind": k, "start": s, "end": e, "text": text[s:e]} for s, e, k in sorted(set(deeper))
                        ],
                    }
                )
            made = pa.Table.from_pylist(rows, schema=_arrow(batch.schema.field("doc_id").type))
            yield from made.set_column(0, "doc_id", batch["doc_id"]).to_batches()

    return docs.select("doc_id", "text").mapInArrow(scan, id_and(docs, SCHEMA))


def _arrow(id_type: pa.DataType) -> pa.Schema:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])
    longs = [(x, pa.int64()) for x in ("n_assign", "n_access", "n_hex")]
    texts = [(x, pa.string()) for x in ("base_sha256", "spans")]
    return pa.schema([("doc_id", id_type), *longs, *texts, ("n_confirmed", pa.int64()), ("confirmed", pa.list_(span))])
