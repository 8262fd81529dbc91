"""Secret scan with structural confirmation.

Patterns find candidates; what the patterns alone cannot tell is decided by decoding. A run of base64 or hex is reported
as key material only if its bytes parse, also if it is wrapped over lines, with line breaks escaped, or in the URL alphabet: DER whose nested lengths tile their parents exactly and whose fields are those
of a private key, or the length-prefixed fields of an OpenSSH private key. A dotted token is reported only if its first
part decodes to a JSON header that names an algorithm and its second part to a JSON object. Documents are scanned
independently of each other, so nothing is shuffled and no group can be hot.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import functools
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import spare, text_of

KINDS = ("assign", "access", "hex", "pem_key", "der_key", "ssh_key", "signed_token")
BASE_KINDS = KINDS[:3]

_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})PRIVATE KEY-----((?:[^-]|-(?!----))*+)-----END \1PRIVATE KEY-----")
_ESCAPED_BREAK = re.compile(r"\\+[nrt]")
_PEM_HEADER = re.compile(r"^[ \t]*([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*)$", re.MULTILINE)
_DEK = re.compile(r"([A-Z0-9-]+),([0-9A-Fa-f]{16,})")
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]{80,}")
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{3,})\.([A-Za-z0-9_-]*)")

# keys in several lines, which real or escaped breaks part; a first line starts as a sequence or the OpenSSH magic does
_AFTER_BREAK = r"(?:(?<![A-Za-z0-9+/_=-])|(?<=\\[nrt]))"
_BREAK = r"(?:[ \t]*(?:\r?\n|\r|(?:\\+r)?\\+n)[ \t]*)"
_BASE64_START = re.compile(_AFTER_BREAK + r"(?:M[A-P]|b3BlbnNzaC1r)(?=[A-Za-z0-9+/_-]{14})")
_BASE64_LINE = re.compile(rf"([A-Za-z0-9+/_-]+)(={{0,2}})({_BREAK}?)")
_HEX_START = re.compile(_AFTER_BREAK + r"(?:30|6[Ff])(?=[0-9A-Fa-f]{14})")
_HEX_LINE = re.compile(rf"([0-9A-Fa-f]+)()({_BREAK}?)")
_URL_TO_PLAIN = str.maketrans("-_", "+/")

_SEQUENCE, _INTEGER, _OCTETS, _OID = 0x30, 0x02, 0x04, 0x06
_SSH_MAGIC = b"openssh-key-v1\x00"


def der_fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Fields (tag, content start, content end) that fill ``data[start:end]`` exactly; None if they do not."""
    fields = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or end - at < width or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
            if size < 128:
                return None
        if at + size > end:
            return None
        fields.append((tag, at, at + size))
        start = at + size
    return fields


def _tiles(data: bytes, start: int, end: int) -> bool:
    """All constructed fields, at any depth, hold fields that fill them."""
    open_fields = [(start, end)]
    while open_fields:
        fields = der_fields(data, *open_fields.pop())
        if fields is None:
            return False
        open_fields += [(a, b) for tag, a, b in fields if tag & 0x20]
    return True


def is_der_key(data: bytes) -> bool:
    """A private key as PKCS 1 (version and eight integers), SEC 1 (version and octets) or PKCS 8 (algorithm, octets)."""
    outer = der_fields(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE or not _tiles(data, 0, len(data)):
        return False
    fields = der_fields(data, outer[0][1], outer[0][2]) or []
    tags = [f[0] for f in fields]
    if len(fields) < 2:
        return False
    version = data[fields[0][1] : fields[0][2]]
    if tags[0] == _SEQUENCE and tags[1] == _OCTETS:  # encrypted PKCS 8
        inner = der_fields(data, fields[0][1], fields[0][2])
        return len(fields) == 2 and bool(inner) and inner[0][0] == _OID
    if tags[0] != _INTEGER or version not in (b"\x00", b"\x01"):
        return False
    if len(tags) >= 9 and all(t == _INTEGER for t in tags[:9]):
        return True
    if tags[1] == _OCTETS and version == b"\x01":
        return fields[1][2] - fields[1][1] >= 16
    if tags[1] == _SEQUENCE and len(tags) >= 3 and tags[2] == _OCTETS:
        inner = der_fields(data, fields[1][1], fields[1][2])
        return bool(inner) and inner[0][0] == _OID
    return False


def ssh_key_end(peek: Callable[[int, int], bytes], size: int) -> int | None:
    """Where the OpenSSH private key container ends that ``size`` bytes start with; ``peek(at, n)`` gives n of them.

    It has: magic, cipher, KDF, options, number of keys, public parts, private part. Only lengths are looked at.
    """
    if peek(0, len(_SSH_MAGIC)) != _SSH_MAGIC:
        return None

    def field(at: int | None) -> int | None:
        if at is None or at + 4 > size:
            return None
        end = at + 4 + int.from_bytes(peek(at, 4), "big")
        return end if end <= size else None

    at = field(field(field(len(_SSH_MAGIC))))
    if at is None or at + 4 > size:
        return None
    keys = int.from_bytes(peek(at, 4), "big")
    at += 4
    for _ in range(keys):
        at = field(at)
        if at is None:
            return None
    return field(at) if keys else None


def is_ssh_key(data: bytes) -> bool:
    return ssh_key_end(lambda at, n: data[at : at + n], len(data)) == len(data)


def from_base64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        padded = text + "=" * (-len(text) % 4)
        return base64.urlsafe_b64decode(padded) if url else base64.b64decode(padded, validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = from_base64(part, url=True)
    if not data or data[:1] != b"{":
        return None
    try:
        found = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str) -> bool:
    head = _json_object(header)
    return head is not None and isinstance(head.get("alg"), str) and _json_object(payload) is not None


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh_key" if is_ssh_key(data) else "der_key" if is_der_key(data) else None


def _is_pem_key(body: str) -> bool:
    """The body, without escapes and headers, is a key; or its headers name a cipher and start value, and it is cipher text."""
    body = _ESCAPED_BREAK.sub("\n", body)
    headers = {m[1].lower(): m[2].strip() for m in _PEM_HEADER.finditer(body)}
    data = from_base64("".join(_PEM_HEADER.sub("", body).split()))
    if "ENCRYPTED" in headers.get("proc-type", "") and (dek := _DEK.fullmatch(headers.get("dek-info", ""))):
        return bool(data) and len(data) >= 16 and (not dek[1].endswith("CBC") or len(data) % 8 == 0)
    return key_kind(data) is not None


def _der_size(data: bytes) -> int | None:
    """The size of the sequence that ``data`` starts with, by its length field."""
    if data[1] < 0x80:
        return 2 + data[1]
    width = data[1] & 0x7F
    return 2 + width + int.from_bytes(data[2 : 2 + width], "big") if 1 <= width <= 4 else None


def _plain_base64(text: str) -> bytes | None:
    return from_base64(text.translate(_URL_TO_PLAIN))


def _plain_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def _peek_hex(text: str, first: int, at: int, n: int) -> bytes:
    return _plain_hex(text[first + 2 * at : first + 2 * (at + n)]) or b""


def _peek_base64(text: str, first: int, at: int, n: int) -> bytes:
    part = text[first + at // 3 * 4 : first + (at + n + 2) // 3 * 4]
    return (_plain_base64(part if len(part) % 4 != 1 else part[:-1]) or b"")[at % 3 : at % 3 + n]


@dataclass(frozen=True)
class _Alphabet:
    """How keys in lines are written: where one may start, what a line is, and the bytes of the joined lines."""

    start: re.Pattern
    line: re.Pattern
    decode: Callable[[str], bytes | None]
    peek: Callable[[str, int, int, int], bytes]
    chars_of: Callable[[int], int]
    bytes_of: Callable[[int], int]


_ALPHABETS = (
    _Alphabet(_BASE64_START, _BASE64_LINE, _plain_base64, _peek_base64, lambda n: (8 * n + 5) // 6, lambda n: n * 6 // 8),
    _Alphabet(_HEX_START, _HEX_LINE, _plain_hex, _peek_hex, lambda n: 2 * n, lambda n: n // 2),
)


class _Run:
    """Neighbouring lines of one alphabet, joined once for all the keys that may start in them."""

    def __init__(self, text: str, line: re.Pattern, place: int) -> None:
        lines: list[str] = []
        self.starts: dict[int, int] = {}  # place of a line in the text -> its place in the joined lines
        self.ends: dict[int, int] = {}  # end of a line in the joined lines -> its end in the text
        total = 0
        while part := line.match(text, place):
            lines.append(part[1])
            self.starts[part.start()] = total
            total += len(part[1])
            self.ends[total] = part.end(2)
            place = part.end()
            if part[2] or not part[3]:
                break
        self.joined = "".join(lines)


def _line_keys(text: str, alphabet: _Alphabet) -> Iterator[tuple[str, int, int]]:
    """Keys that start with a line and end with a line, their lines joined. The key's own lengths say where it ends, and
    only a key whose lines end there is decoded."""
    at, run = 0, None
    while m := alphabet.start.search(text, at):
        at = m.end()
        head = alphabet.decode(text[m.start() : m.start() + 16])
        sequence = bool(head) and head[0] == _SEQUENCE
        size = _der_size(head) if sequence else None
        if sequence and size is None:
            continue
        if run is None or m.start() not in run.starts:
            run = _Run(text, alphabet.line, m.start())
        first = run.starts[m.start()]
        if size is None:
            peek = functools.partial(alphabet.peek, run.joined, first)
            size = ssh_key_end(peek, alphabet.bytes_of(len(run.joined) - first))
        if size is None:
            continue
        end = run.ends.get(first + alphabet.chars_of(size))
        if end is None or alphabet.chars_of(size) < alphabet.chars_of(30):
            continue
        if kind := key_kind(alphabet.decode(run.joined[first : first + alphabet.chars_of(size)])):
            yield kind, m.start(), end
            at = end


def _signed_tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Dotted candidates; where one is none, the next starts at its second part."""
    at = 0
    while m := _DOTTED.search(text, at):
        at = m.start(2)
        if m[1][0] == "e" and is_signed_token(m[1], m[2]):
            yield "signed_token", m.start(), m.end()
            at = m.end()


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start, then kind in the order of ``KINDS``."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if _is_pem_key(m[2]):
                found.append(("pem_key", m.start(), m.end()))
    pem = [(s, e) for k, s, e in found if k == "pem_key"]  # in order, none overlaps another

    def covered(place: int) -> bool:
        before = bisect.bisect_right(pem, (place, len(text)))
        return before > 0 and place < pem[before - 1][1]

    for m in _BASE64_RUN.finditer(text):
        # a key's first byte is that of a sequence, or the o of the OpenSSH magic
        if m[0][0] in "Mb" and not covered(m.start()) and (kind := key_kind(from_base64(m[0]))):
            found.append((kind, m.start(), m.end()))
    for m in _HEX_RUN.finditer(text):
        if m[0][:2] in ("30", "6f", "6F") and len(m[0]) % 2 == 0 and (kind := key_kind(bytes.fromhex(m[0]))):
            found.append((kind, m.start(), m.end()))
    for alphabet in _ALPHABETS:
        found += [f for f in _line_keys(text, alphabet) if not covered(f[1])]
    found += _signed_tokens(text)
    return sorted(set(found), key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"


def with_secrets(docs: DataFrame, column: str) -> DataFrame:
    """All rows and columns of ``docs`` and, as ``column``, the secrets found in the whole of ``text``.

    NULL and empty texts have no secrets. Repeated rows and rows with a NULL in other columns are kept as they are. An
    empty table stays empty. Further columns pass through, whatever their names.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            spans = [find_secrets(t.as_py()) for t in texts]
            yield pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in found] for found in spans], kind)

    # nondeterministic: a filter on the result must not be moved below it and run the scan twice
    return docs.withColumn(column, scan.asNondeterministic()(text_of(docs)))


def redact(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The same rows and columns; every span found in ``text`` is replaced by ``mark``, overlapping spans by one.

    Rows without secrets, NULL texts included, are unchanged.
    """
    found = spare(docs, "secrets")
    marked = with_secrets(docs, found)
    spans = F.transform(F.col(found), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        kept = F.when(fresh, F.concat(state["done"], F.substring(docs["text"], (state["at"] + 1).cast("int"),
                      (span["start"] - state["at"]).cast("int")), F.lit(mark))).otherwise(state["done"])
        return F.struct(kept.alias("done"), F.greatest(state["at"], span["end"]).alias("at"))

    replaced = F.aggregate(F.array_sort(spans), start, step,
                           lambda s: F.concat(s["done"], F.substring(docs["text"], (s["at"] + 1).cast("int"), F.length(docs["text"]))))
    text = F.when(F.size(found) > 0, replaced).otherwise(docs["text"])
    return marked.withColumn("text", text).drop(found)
