"""Secrets: patterns against plain ones, structures against made-up keys."""

import base64
import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frameweir.llm import secrets


def der(tag, body):
    size = len(body)
    if size < 128:
        head = bytes([size])
    else:
        raw = size.to_bytes((size.bit_length() + 7) // 8, "big")
        head = bytes([0x80 | len(raw)]) + raw
    return bytes([tag]) + head + body


NUMBER = der(2, b"\x00" + b"\xab" * 128)
RSA = der(0x30, der(2, b"\x00") + NUMBER + der(2, b"\x01\x00\x01") + NUMBER * 6)
EC = der(0x30, der(2, b"\x01") + der(4, b"\x07" * 32) + der(0xA0, der(6, b"\x2a\x86\x48")))
PKCS8 = der(0x30, der(2, b"\x00") + der(0x30, der(6, b"\x2a\x86\x48\x01") + b"\x05\x00") + der(4, RSA))
SEALED = der(0x30, der(0x30, der(6, b"\x2a\x86") + der(0x30, b"\x05\x00")) + der(4, b"\x11" * 64))


def ssh(*parts):
    return b"".join(len(x).to_bytes(4, "big") + x for x in parts)


OPENSSH = b"openssh-key-v1\0" + ssh(b"none", b"none", b"") + b"\0\0\0\1" + ssh(b"p" * 51, b"s" * 136)


def token(header, payload=None, sign=b"s" * 32):
    return ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (json.dumps(header).encode(), json.dumps(payload or {"sub": 1}).encode(), sign))


def pem(data, name="PRIVATE KEY", head=""):
    body = base64.encodebytes(data).decode()
    return f"-----BEGIN {name}-----\n{head}{body}-----END {name}-----"


@pytest.mark.parametrize("data, kind", [(RSA, "der"), (EC, "der"), (PKCS8, "der"), (SEALED, "der"), (OPENSSH, "openssh")])
@pytest.mark.parametrize("code", ["base64", "url", "hex", "HEX"])
def test_keys_in_every_code(data, kind, code):
    text = {
        "base64": base64.b64encode(data).decode(),
        "url": base64.urlsafe_b64encode(data).decode().rstrip("="),
        "hex": data.hex(),
        "HEX": data.hex().upper(),
    }[code]
    found = secrets.structural_spans(f"ключ: {text} and on")
    assert found == [(6, 6 + len(text), kind)]
    assert secrets.spans_of(f"ключ: {text} and on")[1] == found


DSA = der(0x30, der(2, b"\x00") + NUMBER + der(2, b"\x00" + b"\xcd" * 20) + NUMBER * 2 + der(2, b"\x11" * 20))


@pytest.mark.parametrize("data, kind", [(RSA, "der"), (DSA, "der"), (EC, "der"), (PKCS8, "der"), (OPENSSH, "openssh")])
def test_keys_beside_other_words_and_folded(data, kind):
    code = base64.b64encode(data).decode()
    for before in ("key-", "certs/", "a/b_c-", ""):
        found = secrets.spans_of(f"é {before}{code} end")[1]
        assert found == [(2 + len(before), 2 + len(before) + len(code), kind)]
    if kind == "der":  # it knows its length
        bare = code.rstrip("=")
        assert secrets.spans_of(f"certs/{bare}/more")[1] == [(6, 6 + len(bare), kind)]
    for width, fold in ((64, "\n"), (76, "\r\n"), (50, "\n  ")):
        folded = fold.join(code[i : i + width] for i in range(0, len(code), width))
        for after in ("", " end", "\n\nnext line"):
            found = secrets.spans_of(f"é {folded}{after}")[1]
            assert found == ([(2, 2 + len(folded), kind)] if len(code) > width else found), (width, after)
    whole = base64.b64encode(pem(data).encode()).decode()
    assert secrets.spans_of(f"x={whole}")[1] == [(2, 2 + len(whole), "pem")]


def test_a_key_before_a_short_line():
    code = base64.b64encode(RSA).decode().rstrip("=")
    folded = "\n".join(code[i : i + 64] for i in range(0, len(code), 64))
    assert secrets.spans_of(f"{folded}\nnext")[1] == [(0, len(folded), "der")]


def test_headers_with_blanks():
    for head in (b'{ "alg": "HS256" }', b'{\n"alg":"HS256"}', b'{\r\n "alg":"HS256"}', b'{\t"alg":"HS256"}', b'{"alg":"HS256"}'):
        parts = [base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (head, b'{"a":1}', b"s" * 32)]
        text = ".".join(parts)
        assert secrets.spans_of(f"they said {text} ew")[1] == [(10, 10 + len(text), "token")]


def test_text_like_code_is_no_key():
    words = "/".join(["M" + "abcdefgh" * 9] * 40)
    assert secrets.spans_of(f"key-{words}\nnew words\nthey")[1] == []


@pytest.mark.parametrize(
    "data",
    [RSA[:-1], RSA + b"\0", b"\x30\x81" + RSA[2:], der(0x30, der(2, b"\x00") + NUMBER), der(0x31, RSA), OPENSSH[:-2], OPENSSH + b"\0", b"\x30\x84\xff\xff\xff\xff" + b"a" * 40, b"a" * 100],
)
def test_broken_keys_are_not_reported(data):
    for text in (base64.b64encode(data).decode(), data.hex()):
        assert secrets.structural_spans(text) == []


def test_tokens():
    good = token({"alg": "HS256", "typ": "JWT"})
    assert [x[2] for x in secrets.structural_spans(f"see {good}.")] == ["token"]
    for bad in (token({"typ": "JWT"}), token({"alg": "HS256"}, sign=b""), token(["alg"]), good[:-30], good.replace(".", "", 1)):
        assert [x[2] for x in secrets.structural_spans(bad)] == []


def test_pem():
    for data, name in ((RSA, "RSA PRIVATE KEY"), (PKCS8, "PRIVATE KEY"), (SEALED, "ENCRYPTED PRIVATE KEY"), (OPENSSH, "OPENSSH PRIVATE KEY")):
        text = pem(data, name)
        assert (2, 2 + len(text), "pem") in secrets.structural_spans(f"a {text} b")
    old = pem(b"\x55" * 64, "RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n")
    assert [x[2] for x in secrets.structural_spans(old)] == ["pem"]
    assert secrets.structural_spans(pem(b"just some text that is long enough to be one")) == []


def plain(text):
    found = [(m.start(), m.end(), "assign") for m in re.finditer(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
    found += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return found + [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


PARTS = ["password", "Token", "api_key", "APIKEY", "secret", "paſſwd", "toKen", "=", ": ", "\"", "'", "AKIA", "ABCDEFGH01234567", "0123456789abcdef", "deadbeef", "xyz", "é", " ", "\n", "token=abc"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans(text):
    base, deeper = secrets.spans_of(text)
    assert sorted(base) == sorted(plain(text))
    assert deeper == secrets.structural_spans(text)


def test_columns(spark):
    text = f"é token = \"{'a' * 20}\" AKIA{'B' * 16} {base64.b64encode(EC).decode()}"
    row = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    base = sorted(plain(text), key=lambda x: (x[0], ["assign", "access", "hex"].index(x[2])))
    assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
    assert (row.n_assign, row.n_access, row.n_hex, row.n_confirmed) == (1, 1, 1, 1)
    assert row.spans.count(",") == 3 and row.confirmed[0].text == base64.b64encode(EC).decode()
