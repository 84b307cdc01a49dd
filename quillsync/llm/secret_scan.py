"""Secret spans: fixed patterns, plus candidates confirmed by their structure.

Base kinds, by pattern alone (leftmost, non-overlapping within a kind):
``assign``, ``access``, ``hex``.  The method adds spans that are only reported
when the candidate, decoded, has the structure of a key or signed token:

* ``token``  three base64url segments whose first decodes to a JSON object with
  an ``alg`` string and whose second decodes to a JSON object;
* ``pem``    a PEM block of a private key whose body is base64 of DER (or of the
  OpenSSH container) with consistent nested lengths; its line ends may be escaped
  (``\\n``) and its lines quoted, commented or indented; also a base64 run that
  decodes to a text with such a block;
* ``der``    a base64 or hex run that decodes to a private key in DER (PKCS#1, PKCS#8
  plain or encrypted, SEC 1, PKCS#12), well formed down to its leaves; what a
  PKCS#8 key holds must fit its algorithm;
* ``ssh``    a base64 run that decodes to an OpenSSH key container or to the
  length-prefixed fields of a private SSH key.

Public keys, certificates, signatures and digests are no secrets and not reported.

A key may be wrapped: the lines that follow its first one are taken in up to the length that its
own length fields state.  It may also begin inside a base64 run (where a key's first
characters stand) and end before the run does.

Spans are [start, end) in code points of the text.  Null text: no spans.
Texts are scanned whole; candidates of any length are decoded.  Following lines
are matched once for all candidates of a text, and a candidate's first bytes are
read before the rest is decoded.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsync.llm.text import local, slices

# fixed patterns and minimum lengths of the base kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")       # 18 characters or more
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "token", "pem", "der", "ssh")

_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]+\.ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# a line end, real or escaped (also more than once), and what may stand before and after it
_END = r"""(?:(?<!\\)\\++(?:r(?:\\++n)?|n)|\r\n?|\n)"""
_MARK = r"""(?:[#*>;|]+|(?://+|--|[+-])(?=[ \t]))"""
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----).)*)-{5,6}END \1-----", re.DOTALL)
_LINES = re.compile(_END)
_LEAD = re.compile(r"""(?:\\++t?|[\s"'`])*(?:%s[\s"'`]*)?""" % _MARK)
_NEXT = re.compile(r"""[ \t"'`,;]*(?:[ \t]\+)?\\?%s[ \t"'`]*(?:%s[ \t"'`]*)?([A-Za-z0-9+/_-]+)(={0,2})""" % (_END, _MARK))
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{48,}")
# how the base64 of a DER key, an OpenSSH container and a PEM text begins
_BEGIN = re.compile(r"MI[GHI-L]|M[A-H][A-Za-z0-9+/_-]CAQ|b3BlbnNzaC1rZXk|LS0tLS1CRUdJTi")
_OPENSSH = b"openssh-key-v1\0"


def _unbase64(s: str) -> bytes | None:
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(segment: str) -> dict | None:
    raw = _unbase64(segment)
    try:
        value = json.loads(raw) if raw is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    head, body, _ = text.split(".", 2)
    header = _json_object(head)
    return header is not None and isinstance(header.get("alg"), str) and _json_object(body) is not None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER items that fill data[at:end] exactly, else None."""
    items = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size = int.from_bytes(data[at:at + n], "big")
            if size < 128 or (n > 1 and data[at] == 0):
                return None                       # not the shortest form
            at += n
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


# object identifiers, as encoded: algorithms of private keys, password encryption, PKCS#7 contents
_RSA = (bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a864886f70d01010a"))
_EC = bytes.fromhex("2a8648ce3d0201")
_ONE_NUMBER = (bytes.fromhex("2a8648ce380401"), bytes.fromhex("2a864886f70d010301"), bytes.fromhex("2a8648ce3e0201"))
_CURVE = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32,
          bytes.fromhex("2b6571"): 57}
_ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_PKCS7 = bytes.fromhex("2a864886f70d0107")

# SSH key types: how many fields a public key and a private key have
_SSH_FIELDS = {b"ssh-rsa": (3, 7), b"ssh-dss": (5, 6), b"ssh-ed25519": (2, 3), b"ssh-ed448": (2, 3),
               b"ecdsa-sha2-nistp256": (3, 4), b"ecdsa-sha2-nistp384": (3, 4), b"ecdsa-sha2-nistp521": (3, 4)}


def is_der(data: bytes, at: int, end: int) -> bool:
    """Whether DER items fill data[at:end] exactly, down to their leaves."""
    todo = [(at, end)]
    while todo:
        items = der_items(data, *todo.pop())
        if items is None:
            return False
        for tag, a, e in items:
            size = e - a
            if tag & 0x20:
                todo.append((a, e))
            elif (tag == 0x02 and not size or tag == 0x05 and size or tag == 0x01 and size != 1
                  or tag == 0x06 and (not size or data[e - 1] & 0x80) or tag == 0x03 and (not size or data[a] > 7)):
                return False
    return True


def _fits(oid: bytes, data: bytes) -> bool:
    """Whether the octets of a PKCS#8 key are a private key of the algorithm."""
    if oid in _RSA or oid == _EC:
        return is_der_key(data)
    items = der_items(data, 0, len(data))
    if not items or not is_der(data, 0, len(data)):
        return False
    tag, a, e = items[0]
    if oid in _ONE_NUMBER:
        return len(items) == 1 and tag == 0x02
    return oid not in _CURVE or (len(items) == 1 and tag == 0x04 and e - a == _CURVE[oid])


def is_der_key(data: bytes) -> bool:
    """A private key in DER: a SEQUENCE that fills the data and is well formed to its leaves, of a version and
    the key's numbers (PKCS#1, DSA), a version and octets (SEC 1), a version, an algorithm and octets that fit
    it (PKCS#8), a password encryption and octets (encrypted PKCS#8), or a PKCS#12 shell."""
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30 or not is_der(data, 0, len(data)):
        return False
    parts = der_items(data, outer[0][1], outer[0][2])
    if len(parts) < 2:
        return False
    (tag, a, e), tags = parts[0], [x[0] for x in parts]
    if tag == 0x30:
        how = der_items(data, a, e)
        return (tags == [0x30, 0x04] and parts[1][2] - parts[1][1] >= 8 and [x[0] for x in how] == [0x06, 0x30]
                and data[how[0][1]:how[0][2]].startswith(_ENCRYPTION))
    if tag != 0x02 or e - a != 1 or data[a] > 3:
        return False
    version, second = data[a], tags[1]
    if second == 0x02:
        return all(t == 0x02 for t in tags[:-1]) and tags[-1] in ((0x02, 0x30) if version == 1 else (0x02,))
    if second == 0x04:
        return version == 1 and parts[1][2] - parts[1][1] >= 14 and set(tags[2:]) <= {0xA0, 0xA1}
    inner = der_items(data, parts[1][1], parts[1][2]) if second == 0x30 else None
    if not inner or inner[0][0] != 0x06:
        return False
    oid = data[inner[0][1]:inner[0][2]]
    if version == 3:
        return oid.startswith(_PKCS7) and tags[2:] in ([], [0x30])
    return (version <= 1 and tags[2:3] == [0x04] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}
            and _fits(oid, data[parts[2][1]:parts[2][2]]))


def _ssh_end(data: bytes, whole: int) -> int | None:
    """Where the private SSH key ends that begins ``whole`` bytes of which ``data`` are the first; None
    if none does, -1 if ``data`` is too short to say."""
    at, left = (len(_OPENSSH), 3) if data.startswith(_OPENSSH) else (0, None)
    counted = left is None
    while left != 0:
        if at + 4 > whole:
            return None
        if at + 4 > len(data):
            return -1
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > whole:
            return None
        if left is None:
            if at + 4 + n > len(data):
                return -1
            if data[at + 4:at + 4 + n] not in _SSH_FIELDS:
                return None
            left = _SSH_FIELDS[data[at + 4:at + 4 + n]][1]
        elif counted and data[at + 4:at + 4 + n] in _SSH_FIELDS and not data.startswith(_OPENSSH):
            return None                            # a public key, and the next one
        at, left = at + 4 + n, left - 1
        if left == 0 and not counted:              # the number of keys: as many public ones, and the private part
            if at + 4 > whole:
                return None
            if at + 4 > len(data):
                return -1
            at, left, counted = at + 4, int.from_bytes(data[at:at + 4], "big") + 1, True
            if not 2 <= left <= whole:
                return None
    return at


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH key container, or the fields of a private SSH key and at most a comment."""
    end = _ssh_end(data, len(data))
    if end is None or end < 0:
        return False
    if data.startswith(_OPENSSH):
        return len(data) - end <= 16               # an authentication tag may follow
    more = data[end:]
    return not more or int.from_bytes(more[:4], "big") + 4 == len(more)


def _is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def is_pem_body(body: str) -> bool:
    """Whether the lines between a block's marks, without quotes and comment marks, are a key."""
    lines = [re.split("[\"'`]", x[_LEAD.match(x).end():], maxsplit=1)[0].rstrip(" \t,;\\") for x in _LINES.split(body)]
    lines = ["" if x in ("+", "-", "//") else x for x in lines]
    # a mark without a blank may be a part of the base64 or not
    bare = [x[2:] if x.startswith("//") else x[1:] if x[:1] in ("+", "-") else x for x in lines]
    return any(_is_key(_unbase64(re.sub(r"\s", "", "".join(x)))) for x in (lines, bare))


def _kind(data: bytes | None) -> int | None:
    """The kind of decoded data: a key, or a PEM text of one."""
    if not data or data[0] not in (0x30, 0x00, 0x6F, 0x2D, 0x0A, 0x0D):
        return None
    if data.lstrip().startswith(b"-----BEGIN"):
        return 4 if any(is_pem_body(m.group(2)) for m in _PEM.finditer(data.decode("latin-1"))) else None
    return 5 if is_der_key(data) else 6 if is_ssh_key(data) else None


def _key_size(data: bytes, whole: int) -> int | None:
    """How many bytes the key has that begins ``whole`` bytes of which ``data`` are the first, by its own
    lengths; None if none begins so, -1 if ``data`` is too short to say."""
    if data[:1] == b"\x30" and len(data) > 8:
        n = data[1] & 0x7F if data[1] & 0x80 else 0
        size = 2 + n + (int.from_bytes(data[2:2 + n], "big") if n else data[1])
        inner = data[2 + n:5 + n]
        begins = inner[:1] == b"\x30" or inner[:2] == b"\x02\x01" and inner[2:] <= b"\x03"
        return size if n <= 4 and size <= whole and begins else None
    text = data.lstrip()
    if text.startswith(b"-----BEGIN"):
        head = text.find(b"-----", 10, 80)
        if head < 0 or not text[:head].endswith(b"PRIVATE KEY"):
            return None if len(text) >= 80 or len(data) >= whole else -1
        last = text.find(b"-----", head + 5)       # the end mark is as long as the first one, less two
        end = len(data) - len(text) + last + head + 3
        return (None if len(data) >= whole else -1) if last < 0 else end if end <= whole else None
    return _ssh_end(data, whole)


class _Lines:
    """The base64 lines that follow one another in a text, matched once for all candidates."""

    def __init__(self, text: str):
        self.text, self.chain = text, {}

    def after(self, end: int) -> tuple[list[int], list[int], str, int]:
        """(ends, sizes, characters, number) of the lines around the one that ends there, and which it is;
        ``sizes`` are sums from the chain's second line on, whose ``characters`` are joined."""
        if end not in self.chain:
            ends, sizes, parts = [end], [0], []
            while m := _NEXT.match(self.text, ends[-1]):
                parts.append(m.group(1))
                ends.append(m.end())
                sizes.append(sizes[-1] + len(parts[-1]))
                if m.group(2):
                    break
            joined = "".join(parts)
            for i, e in enumerate(ends):
                self.chain[e] = (ends, sizes, joined, i)
        return self.chain[end]


def _key_at(lines: _Lines, start: int, end: int) -> tuple[int, int] | None:
    """(kind, end) of the key that begins at ``start`` of a base64 run that ends at ``end``: within the
    run, or going on in the next lines."""
    text = lines.text
    own = end - text.count("=", max(start, end - 2), end)
    ends, sizes, joined, i = lines.after(end) if own == end else ([end], [0], "", 0)
    chars = own - start + sizes[-1] - sizes[i]
    probe, size = 64, -1
    while size == -1:
        head = text[start:min(own, start + probe)] + joined[sizes[i]:sizes[i] + max(0, probe - (own - start))]
        size = _key_size(_unbase64(head[:len(head) // 4 * 4]) or b"", chars * 3 // 4)
        if size == -1 and probe >= chars:
            return None
        probe *= 4
    if size is None:
        return None
    wanted = -(-size * 4 // 3)
    if wanted <= own - start:
        kind = _kind(_unbase64(text[start:start + wanted]))
        at = start + wanted
        while kind and text[at:at + 1] == "=" and at < start + wanted + 2:
            at += 1
        return (kind, at) if kind else None
    first = text[start:own]
    last = min(bisect_left(sizes, wanted - len(first) + sizes[i], lo=i), len(sizes) - 1)
    for n in (last, last + 1):                     # what follows the stated lengths may stand in a line of its own
        kind = _kind(_unbase64(first + joined[sizes[i]:sizes[n]])) if n < len(ends) else None
        if kind:
            return kind, ends[n]
    kind = _kind(_unbase64(first + joined[sizes[i]:sizes[i] + wanted - len(first)]))
    return (kind, ends[last] - (sizes[last] - sizes[i] - wanted + len(first))) if kind else None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, by start and then kind."""
    # a failing assignment still uses up its characters, so its length is tested after the match
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded structure confirms them; PEM bodies are not reported twice."""
    found = [(m.start(), 3, m.end()) for m in _TOKEN.finditer(text) if is_signed_token(m.group())]
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            if is_pem_body(m.group(2)):
                found.append((m.start(), 4, m.end()))
    lines, wrapped = _Lines(text), []
    for m in _outside(_BASE64, text, found, wrapped):
        # the letter of an escape (\\n) before the run is no part of it; a key may also begin inside the run
        escaped = m.start() and text[m.start() - 1] == "\\" and text[m.start()] in "nrt"
        starts = [m.start()] + [m.start() + 1] * bool(escaped)
        done = m.start()
        for start in (*starts, *(x.start() for x in _BEGIN.finditer(text, m.start() + 1, m.end()))):
            if start < done:
                continue
            kind, end = _kind(_unbase64(text[start:m.end()])) if start in starts else None, m.end()
            if not kind:
                kind, end = _key_at(lines, start, m.end()) or (None, end)
            if kind:
                found.append((start, kind, end))
                wrapped.append((start, kind, end))
                done = end
    for m in _outside(_HEX_ANY, text, found, []):
        kind = _kind(_unhex(m.group()))
        if kind:
            found.append((m.start(), kind, m.end()))
    return found


def _outside(pattern: re.Pattern, text: str, found: list, later: list) -> Iterator[re.Match]:
    """Matches that do not lie within one of the spans of ``found``, nor within those that are
    added to ``later`` meanwhile."""
    spans_ = sorted((s, e) for s, _, e in found)
    at = known = reach = 0
    for m in pattern.finditer(text):
        while at < len(spans_) and spans_[at][0] <= m.start():
            reach, at = max(reach, spans_[at][1]), at + 1
        while known < len(later):
            reach, known = max(reach, later[known][2]), known + 1
        if m.end() > reach:
            yield m


def _unhex(s: str) -> bytes | None:
    return bytes.fromhex(s) if len(s) % 2 == 0 else None


def spans(text: str) -> list[tuple[int, int, int]]:
    return sorted(base_spans(text) + confirmed_spans(text))


def show(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row; no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), local(text_col))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            base = [base_spans(t) for t in b.column("text").to_pylist()]
            full = [sorted(x + confirmed_spans(t)) for x, t in zip(base, b.column("text").to_pylist())]
            counts = [pa.array([sum(k == n for _, k, _ in x) for x in base], pa.int64()) for n in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *counts,
                 pa.array([hashlib.sha256(show(x).encode()).hexdigest() for x in base], pa.string()),
                 pa.array([show(x) for x in full], pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, "
                                "base_sha256 string, spans string").withColumnRenamed("id", id_col)


def redacted(text: str) -> str:
    """The text with every reported span replaced by ``[REDACTED:kind]``.

    Overlapping spans are replaced together, under the kind of the first.
    """
    merged: list[list] = []
    for s, k, e in spans(text):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    out, at = [], 0
    for s, k, e in merged:
        out += [text[at:s], f"[REDACTED:{KINDS[k]}]"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with redacted texts; null texts stay null; ``size_col``, where there is
    one, becomes the new length in code points of the texts that changed."""
    @F.pandas_udf("string")
    def clean(s):
        return s.map(lambda t: t if t is None else redacted(t))

    out = docs.withColumn("__new", clean(F.col(f"`{text_col}`").cast("string")))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.when(F.col("__new").eqNullSafe(F.col(text_col)), F.col(size_col))
                             .otherwise(F.length("__new").cast(kind)))
    return out.withColumn(text_col, F.col("__new")).select(*docs.columns)
