"""Secret scan with structural confirmation.

Three lexical kinds are reported as they match: ``assign`` (a value assigned to a secret's name),
``access`` (an access-key id) and ``hex`` (a long lower-case hex run). Four more kinds are only
reported when decoding confirms their structure: ``pem`` (an armoured private key; of an encrypted one
the cipher's header, initial vector, block size and least length), ``der`` (a base64 or hex run that is
a private key's nested encoding, every length exact), ``ssh`` (a private key file of length-prefixed
fields) and ``jwt`` (a signed token whose header and body are JSON objects and whose header names an
algorithm). Runs may be wrapped in lines of equal length, hex bytes also parted by colons. A public key
or a random run confirms nothing.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _q, map_texts

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_NOT_HEX = re.compile("[^0-9A-Fa-f]+")
# The closing dashes of a line can be the opening dashes of the next one.
_ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*)(?=-----)")
# Line ends as they stand and as a string literal (JSON, once or more) writes them.
_LINE_END = re.compile(r"\\+r\\+n|\\+[nr]|\r\n?")
_EOL = r"(?:(?:\\+r\\+n|\\+[nr]|\r\n|[\n\r])[ \t]*)"
# The header of an encrypted armoured key: cipher and initial vector.
_CIPHER = re.compile(r"Proc-Type: *4,ENCRYPTED\s+DEK-Info: *([A-Z0-9-]+),([0-9A-Fa-f]+)\n\n")
_WIDE_BLOCKS = ("AES", "ARIA", "CAMELLIA", "SEED")  # of 16 bytes; other ciphers have 8
_LEAST = {"RSA PRIVATE KEY": 160, "DSA PRIVATE KEY": 160}  # bytes; other kinds 40
# A base64 run of a byte string that starts with a SEQUENCE tag (0x30) starts with M and one of A-P.
_DER64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-P][A-Za-z0-9+/_-]{30,}={0,2}")
_DER16 = re.compile(r"(?<![0-9A-Fa-f])30(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
# Bytes parted by colons, after each of which the line may end.
_DER_COLONS = re.compile(rf"(?<![0-9A-Fa-f:])30(?::{_EOL}?[0-9A-Fa-f]{{2}}){{24,}}(?![0-9A-Fa-f:])")
# The first lines of wrapped runs, and a further line.
_LINES64 = re.compile(rf"(?<![A-Za-z0-9+/_-])(?:M[A-P][A-Za-z0-9+/_-]{{14,}}|b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/_-]*)(?={_EOL}[A-Za-z0-9+/_-])")
_LINES16 = re.compile(rf"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{{14,}}(?={_EOL}[0-9A-Fa-f])")
_MORE64, _MORE16 = (re.compile(rf"{_EOL}({c}+)(=*)(?!{c})") for c in ("[A-Za-z0-9+/_-]", "[0-9A-Fa-f]"))
_SSH_MAGIC = b"openssh-key-v1\0"
_SSH64 = re.compile(r"b3BlbnNzaC1rZXktdjEA[A-Za-z0-9+/]+={0,2}")
_SSH16 = re.compile(r"6[fF]70656[eE]7373682[dD]6[bB]65792[dD]763100[0-9A-Fa-f]+")
# A base64 run of a text that starts with an opening brace starts with e and one of w-z.
_JWT = re.compile(r"(?<![A-Za-z0-9_.-])e[w-z][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")


def _from64(run: str) -> bytes | None:
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The tag-length-value elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(data):
                return None
            n = int.from_bytes(data[at:at + k], "big")
            if n < 0x80 or n >> (8 * (k - 1)) == 0:  # lengths are in their shortest form
                return None
            at += k
        if at + n > len(data):
            return None
        out.append((tag, data[at:at + n]))
        at += n
    return out


def is_private_key(data: bytes | None) -> bool:
    """Whether the bytes are one private key: PKCS#1, PKCS#8 (plain or encrypted) or SEC 1."""
    top = _elements(data) if data else None
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = _elements(top[0][1])
    if not parts or len(parts) < 2:
        return False
    tags = [t for t, _ in parts]
    if tags[:2] == [0x30, 0x04] and len(parts) == 2:  # algorithm and encrypted bytes
        inner = _elements(parts[0][1])
        return bool(inner) and inner[0][0] == 0x06 and len(parts[1][1]) >= 16
    if tags[0] != 0x02 or len(parts[0][1]) != 1:
        return False
    version = parts[0][1][0]
    if tags == [0x02] * len(tags) and version in (0, 1) and len(tags) in (6, 9, 10):  # numbers of a DSA or RSA key
        return all(v for _, v in parts)
    if tags[1:3] == [0x30, 0x04] and version in (0, 1):
        inner = _elements(parts[1][1])
        return bool(inner) and inner[0][0] == 0x06
    return tags[1] == 0x04 and version == 1 and len(parts[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])


def _der_size(head: bytes) -> int:
    """The whole length of the element that starts with ``head`` (0: not a length)."""
    if len(head) < 6:
        return 0
    k = head[1] & 0x7F if head[1] & 0x80 else 0
    return 2 + k + (int.from_bytes(head[2:2 + k], "big") if k else head[1]) if k <= 4 else 0


def is_encrypted_key(body: str, kind: str) -> bool:
    """Whether an armoured body of the given kind has a cipher header with an initial vector of the cipher's
    block size, and whole blocks that can hold such a key."""
    m = _CIPHER.search(body)
    if not m:
        return False
    block = 16 if m[1].startswith(_WIDE_BLOCKS) else 8
    data = _from64("".join(body[m.end():].split())) or b""
    return len(m[2]) == 2 * block and len(data) >= _LEAST.get(kind, 40) and len(data) % block == 0


def _wrapped(text: str, first: re.Pattern, more: re.Pattern) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of the runs that lines of equal length make up (the last may be shorter), in turn from
    each line on which one may begin, where its own length says it ends; a key file to the last line."""
    block: list[tuple[int, int, str]] = []  # of lines: start, end, content
    number: dict[int, int] = {}
    for m in first.finditer(text):
        if m.start() not in number:
            block = [(m.start(), m.end(), m[0])]
            while (line := more.match(text, block[-1][1])) and len(line[1]) <= len(m[0]):
                block.append((line.start(1), line.end(2), line[1]))
                if line[2] or len(line[1]) < len(m[0]):
                    break
            number = {a: i for i, (a, _, _) in enumerate(block)}
        at, wide = number[m.start()], len(m[0])
        if m[0].startswith("b3Bl"):
            count, need = len(block) - at, 0
        else:
            size = _der_size(bytes.fromhex(m[0][:12]) if more is _MORE16 else _from64(m[0][:8]) or b"")
            need = 2 * size if more is _MORE16 else -(-size * 4 // 3)
            count = -(-need // wide)
        if not 1 < count <= len(block) - at or need and len(block[at + count - 1][2]) != need - (count - 1) * wide:
            continue
        yield m.start(), block[at + count - 1][1], "".join(x for _, _, x in block[at:at + count])


def is_ssh_private_key(data: bytes | None) -> bool:
    """Whether the bytes are a private key file whose nested lengths all fit."""
    if not data or not data.startswith(_SSH_MAGIC):
        return False
    at, fields = len(_SSH_MAGIC), []

    def field():
        nonlocal at
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            raise ValueError
        at += 4 + n
        return data[at - n:at]
    try:
        fields = [field() for _ in range(3)]  # cipher, key derivation, its options
        count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
        if not 1 <= count <= 64:
            return False
        publics = [field() for _ in range(count)]
        private = field()
    except ValueError:
        return False
    return at == len(data) and bool(fields[0]) and bool(private) and all(
        0 < int.from_bytes(p[:4], "big") <= len(p) - 4 for p in publics)


def is_signed_token(run: str) -> bool:
    """Whether three dot-separated parts are a header with an algorithm, a body and a signature."""
    head, body, signature = run.split(".")[:3]
    made = []
    for part in (head, body):
        raw = _from64(part)
        try:
            made.append(json.loads(raw.decode()))
        except (AttributeError, UnicodeDecodeError, ValueError, RecursionError):
            return False
    if not all(isinstance(m, dict) for m in made) or not isinstance(made[0].get("alg"), str):
        return False
    return not signature if made[0]["alg"].lower() == "none" else len(_from64(signature) or b"") >= 16


def _armoured(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, body, start, end) from the last BEGIN line before an END line of the same private key type to that
    END line; line ends and slashes of the body are unescaped."""
    out, begin, done = [], None, 0
    for m in _ARMOUR.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin and m[2] == begin[2]:
            if m[2].endswith("PRIVATE KEY"):
                body = _LINE_END.sub("\n", text[begin.end() + 5:m.start()])
                out.append((m[2], re.sub(r"\\+/", "/", body), max(done, begin.start()), m.end() + 5))
                done = m.end() + 5
            begin = None
    return out


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text as (kind, start, end) in code points, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        for kind, body, a, b in _armoured(text):
            data = _from64("".join(body.split())) if ":" not in body else None
            if is_private_key(data) or is_ssh_private_key(data) or data is None and is_encrypted_key(body, kind):
                out.append(("pem", a, b))
    out += [("der", m.start(), m.end()) for m in _DER64.finditer(text) if is_private_key(_from64(m[0]))]
    out += [("der", m.start(), m.end()) for m in _DER16.finditer(text) if is_private_key(bytes.fromhex(m[0]))]
    out += [("ssh", m.start(), m.end()) for m in _SSH64.finditer(text) if is_ssh_private_key(_from64(m[0]))]
    out += [("ssh", m.start(), m.end()) for m in _SSH16.finditer(text)
            if len(m[0]) % 2 == 0 and is_ssh_private_key(bytes.fromhex(m[0]))]
    out += [("der", m.start(), m.end()) for m in _DER_COLONS.finditer(text) if is_private_key(bytes.fromhex(_NOT_HEX.sub("", m[0])))]
    armour = [(a, b) for kind, a, b in out if kind == "pem"]
    for first, more, decode in ((_LINES64, _MORE64, _from64), (_LINES16, _MORE16, bytes.fromhex)):
        done = 0
        for a, b, run in _wrapped(text, first, more):
            if a < done or any(x <= a and b <= y for x, y in armour) or len(run) % 2 and more is _MORE16:
                continue
            data = decode(run)
            kind = "der" if is_private_key(data) else "ssh" if is_ssh_private_key(data) else None
            if kind:
                out.append((kind, a, b))
                done = b
    out += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    if len(out) > 1:
        out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with each run of touching or overlapping spans replaced by the mark."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at, end = [], 0, -1
    for _, a, b in spans:
        if a > end:
            out += [text[at:a], mark]
        end = max(end, b)
        at = end
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``, an array of (kind, start, end) in code
    points, end exclusive, by start and kind (in the order of ``KINDS``).

    Within a kind, spans are leftmost and do not overlap; spans of different kinds may. Null and
    empty texts have no spans; null ids and repeated rows stay rows of their own; texts of any
    length are read whole; an empty table gives no rows; other columns are ignored.
    """
    def start():
        return lambda texts: {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] if t else []
                                        for t in texts]}
    return map_texts(docs, text_col, [id_col], T.StructType([T.StructField("spans", SPANS)]), start)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span of their texts replaced by ``mark``; all columns and their
    order stay, nulls stay null."""
    def start():
        return lambda texts: {text_col: [redacted(t, mark) if t else t for t in texts]}
    out = map_texts(docs, text_col, docs.columns, T.StructType([T.StructField(text_col, T.StringType())]), start)
    return out.select(*[_q(c) for c in docs.columns])


def span_digest(kinds: tuple[str, ...]):
    """``kind:start:end`` of the spans of the given kinds, comma-joined, from a ``spans`` column."""
    among = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(f"array_join(transform(filter(spans, s -> s.kind in ({among})), "
                  "s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
