"""Secrets in texts: patterns propose candidates, and decoded structure confirms further ones."""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, string_bytes

BASE = ("assign", "access", "hex")
#: After the base kinds: a PEM block, a DER structure, an SSH key file, a signed token.
KINDS = (*BASE, "pem", "der", "ssh", "jwt")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*: ")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)++")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
FOLLOWING = re.compile(r"\r?\n([A-Za-z0-9+/_-]+={0,2})(?![A-Za-z0-9+/_=-])")
_IN_RUN = re.compile(r"[A-Za-z0-9+/_=-]")
ANY_HEX = re.compile(r"[0-9A-Fa-f]{48,}")
#: Fixed value: how an SSH private key file begins.
CONTAINER = b"openssh-key-v1\x00"
#: Least length of the lines of a base64 text that is broken into lines.
LINE = 40
LONG_RUN = 24
WORDS = ("passw", "secret", "token", "api")
_RUN = np.zeros(256, bool)
_RUN[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-", np.uint8)] = True
SPANS = "array<struct<kind:string,start:int,end:int>>"


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at a place, if its length fits before end."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        width = n & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        n, at = int.from_bytes(data[at : at + width], "big"), at + width
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


#: Ids of schemes that encrypt a key by a password, and of what a container of keys is around (data, or signed data).
SCHEMES = {*(bytes.fromhex("2a864886f70d0105") + bytes([k]) for k in (1, 3, 4, 6, 10, 11, 13)), *(bytes.fromhex("2a864886f70d010c01") + bytes([k]) for k in range(1, 7))}
CONTENTS = {bytes.fromhex("2a864886f70d0107") + bytes([k]) for k in (1, 2)}


def elements(data: bytes, at: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """The elements that fill a stretch of data exactly, or None."""
    end, out = len(data) if end is None else end, []
    while at < end:
        found = element(data, at, end)
        if not found or found[0] & 0x1F == 0x1F or found[0] == 0:
            return None
        out.append(found)
        at = found[2]
    return out


def nested(data: bytes) -> bool:
    """Whether data is one DER SEQUENCE whose lengths, and those of all that it holds, fill their parents exactly."""
    top = elements(data)
    if not top or len(top) > 1 or top[0][0] != 0x30:
        return False
    todo = [top[0][1:]]
    while todo:
        at, end = todo.pop()
        inner = elements(data, at, end)
        if inner is None:
            return False
        todo += [(a, b) for tag, a, b in inner if tag & 0x20]
    return True


def private_der(data: bytes) -> bool:
    """Whether DER bytes are a private key: the whole numbers of an RSA or DSA key, an elliptic curve's version and secret, a version with an
    algorithm and the key in an octet string (which must be a key's DER where the algorithm is RSA), a scheme of encryption by password with its parameters and an encrypted key, or
    a container of keys (version 3 around data). Public keys and certificates hold bit strings or other fields and aren't, and neither is a digest behind the name of its algorithm."""
    if len(data) < 24 or not nested(data):
        return False
    fields = elements(data, *elements(data)[0][1:])
    tags = [t for t, _, _ in fields]
    inside = lambda k: [t for t, _, _ in elements(data, *fields[k][1:]) or ()]
    version = int.from_bytes(data[fields[0][1] : fields[0][2]], "big") if tags[:1] == [2] else None
    if version is not None and set(tags) == {2}:
        return (len(tags) == 9 and version in (0, 1)) or (len(tags) == 6 and version == 0)
    if tags[:2] == [2, 4] and version == 1:
        return all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags[:3] == [2, 0x30, 4] and version in (0, 1):
        return inside(1)[:1] == [6] and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:])
    named = lambda k: next((data[a:b] for t, a, b in elements(data, *fields[k][1:]) or () if t == 6), b"")
    if tags[:2] == [2, 0x30] and version == 3:
        return inside(1) == [6, 0xA0] and named(1) in CONTENTS and tags[2:] in ([], [0x30])
    return tags == [0x30, 4] and inside(0) == [6, 0x30] and named(0) in SCHEMES and fields[1][2] - fields[1][1] >= 8


def ssh_container(data: bytes) -> bool:
    """Whether bytes are an OpenSSH private key file: names of cipher and derivation, the derivation's options, as many public keys as are
    announced, each of named fields, and the private part, with lengths that fill it exactly."""
    if not data.startswith(CONTAINER):
        return False

    def fields(at: int, end: int, n: int | None) -> tuple[list[bytes], int] | None:
        out: list[bytes] = []
        while at < end if n is None else len(out) < n:
            size = int.from_bytes(data[at : at + 4], "big")
            if at + 4 + size > end or at + 4 > end:
                return None
            out.append(data[at + 4 : at + 4 + size])
            at += 4 + size
        return out, at

    head = fields(len(CONTAINER), len(data), 3)
    if not head or head[1] + 4 > len(data) or not re.fullmatch(rb"[a-z0-9@.-]+", head[0][0]) or not re.fullmatch(rb"[a-z0-9-]+", head[0][1]):
        return False
    n, at = int.from_bytes(data[head[1] : head[1] + 4], "big"), head[1] + 4
    rest = fields(at, len(data), n + 1) if 1 <= n <= 16 else None
    if not rest or rest[1] != len(data) or len(rest[0][-1]) < 16 or len(rest[0][-1]) % 8:
        return False
    public = [x for x in rest[0][:-1] if len(x) < 8 or not re.match(rb"(ssh|ecdsa|sk)-", x[4:])]
    return not public


def key_kind(data: bytes | None) -> int:
    """The place in KINDS of what decoded bytes are, or 0."""
    return 0 if not data else 4 if private_der(data) else 5 if ssh_container(data) else 0


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it isn't."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def signed_token(head: str, body: str) -> bool:
    """Header and payload decode to JSON objects, and the header names an algorithm."""
    try:
        one, two = (json.loads(decoded(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    return isinstance(one, dict) and isinstance(two, dict) and isinstance(one.get("alg"), str)


def tokens(text: str):
    """Signed tokens: three parts with dots between, of which the first two decode. Each part is decoded twice at most, however long a run of parts is."""
    for m in DOTTED.finditer(text):
        parts, at, free = m[0].split("."), m.start(), m.start()
        for k, part in enumerate(parts):
            begin = part.find("eyJ")
            if k + 2 < len(parts) and begin >= 0 and at >= free and len(part) - begin >= 11 and len(parts[k + 1]) >= 4 and len(parts[k + 2]) >= 8 and signed_token(part[begin:], parts[k + 1]):
                free = at + len(part) + len(parts[k + 1]) + len(parts[k + 2]) + 2
                yield at + begin, free
            at += len(part) + 1


def pem_blocks(text: str):
    """(start, end, body) of the blocks between markers of one label; a block ends before the next one begins."""
    found = [*BEGIN.finditer(text)]
    for m, after in zip(found, [*found[1:], None], strict=False):
        stop = after.start() if after else len(text)
        end = text.find(f"-----END {m[1]}-----", m.end(), stop)
        if end >= 0:
            yield m.start(), end + len(m[1]) + 14, text[m.end() : end]


def pem_key(body: str) -> bool:
    """Whether a block's body decodes to a key. Header lines may come first; those of an encrypted body make it bytes in whole cipher blocks. Lines may end in an
    escape of a line's end, as in quoted strings."""
    lines = body.replace("\\r", "\n").replace("\\n", "\n").split("\n")
    headers = [x for x in lines if HEADER.match(x.strip())]
    data = decoded("".join("".join(x for x in lines if not HEADER.match(x.strip())).split()))
    if data and any(x.strip().startswith("DEK-Info:") for x in headers):
        return len(data) >= 16 and len(data) % 8 == 0
    return bool(key_kind(data))


def wrapped(text: str, m: re.Match) -> tuple[int, str] | None:
    """Where a DER structure that begins in a base64 line ends, and its base64 put together: lines of one length and a last one
    that is no longer. How many lines there are follows from the length that the structure itself states, so no others are read."""
    top = decoded(m[0][:12])
    if not top or len(top) < 8 or top[0] != 0x30:
        return None
    width = top[1] & 0x7F if top[1] >= 0x80 else 0
    size = 2 + width + (int.from_bytes(top[2 : 2 + width], "big") if width else top[1])
    line, gap = len(m[0]), 2 if text.startswith("\r\n", m.end()) else 1
    if line < LINE or width > 4 or not text.startswith(("\n", "\r\n"), m.end()):
        return None
    for chars in {-(-size // 3) * 4, -(-size * 4 // 3)}:  # with padding and without
        full = (chars - 1) // line
        end = m.start() + chars + full * gap
        if full and end <= len(text) and text[end - (chars - full * line) - 1] == "\n" and not _IN_RUN.match(text, end):
            lines = text[m.start() : end].split("\n" if gap == 1 else "\r\n")
            if len(lines) == full + 1 and all(len(x) == line for x in lines[:-1]):
                return end, "".join(lines)
    return None


def file_lines(text: str, m: re.Match) -> list[tuple[int, str]]:
    """What an SSH key file that begins in a base64 line may be: with the lines after it of the same length and perhaps a last one that is shorter, longest first."""
    out, joined, end = [(m.end(), m[0])], [m[0]], m.end()
    while len(m[0]) >= LINE and len(joined[-1]) == len(m[0]):
        line = FOLLOWING.match(text, end)
        if not line or len(line[1]) > len(m[0]):
            break
        joined.append(line[1])
        out.append((line.end(), ""))
        end = line.end()
    return [(e, "".join(joined[: k + 1])) for k, (e, _) in [*enumerate(out)][:-3:-1]]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the base kinds. The quantified patterns of access and hex find what the
    plain runs with a length test find, because a run that is too short holds no match either."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded bytes have the structure of a private key or a signed token. Every step is linear in the text."""
    found = [(a, 3, b) for a, b, body in pem_blocks(text) if pem_key(body)] + [(a, 6, b) for a, b in tokens(text)]
    taken = sorted((a, b) for a, _, b in found)
    starts, until = [a for a, _ in taken], 0

    def held(start: int, end: int) -> bool:
        """PEM blocks and tokens don't cross, so the last one that begins before the end is enough."""
        k = bisect.bisect_left(starts, end) - 1
        return k >= 0 and taken[k][1] > start

    for m in BASE64.finditer(text):
        if m.start() < until or held(m.start(), m.end()):
            continue
        if m[0].startswith("b3BlbnNz"):  # how an SSH key file begins
            tried = file_lines(text, m)
        elif m[0][0] == "M":  # how a SEQUENCE begins
            tried = [x for x in ((m.end(), m[0]), wrapped(text, m)) if x]
        else:
            continue
        for end, whole in tried:
            kind = key_kind(decoded(whole))
            if kind:
                found.append((m.start(), kind, end))
                until = end
                break
    for m in ANY_HEX.finditer(text):
        kind = 0 if len(m[0]) % 2 else key_kind(bytes.fromhex(m[0]))
        if kind:
            found.append((m.start(), kind, m.end()))
    return found


def spans(text: str) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(set(base_spans(text) + confirmed_spans(text)))]


def _long_runs(texts: pa.Array) -> np.ndarray:
    """Per text, whether it has a run of LONG_RUN characters or more that a key could be written in."""
    flat, offsets = string_bytes(texts)
    member = np.insert(_RUN[flat], offsets[1:-1], False)  # a gap between texts, so that no run crosses a border
    member = np.concatenate([[False], member, [False]])
    edge = np.flatnonzero(member[1:] != member[:-1])
    starts, ends = edge[::2], edge[1::2]
    out = np.zeros(len(texts), bool)
    out[np.searchsorted(offsets[:-1] + np.arange(len(texts)), starts[ends - starts >= LONG_RUN], side="right") - 1] = True
    return out


def _scan(batches):
    for batch in batches:
        for rows in slices([batch]):
            texts = rows.column(rows.schema.get_field_index("text")).fill_null("")
            lower = pc.ascii_lower(texts)
            hit = _long_runs(texts)
            for word in WORDS:
                hit |= pc.match_substring(lower, word).to_numpy(zero_copy_only=False)
            hit |= pc.match_substring(texts, "AKIA").to_numpy(zero_copy_only=False)
            hit |= pc.match_substring(texts, "PRIVATE KEY").to_numpy(zero_copy_only=False)
            found = [spans(str(t)) if h else [] for t, h in zip(texts, hit, strict=True)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, kind)], ["doc_id", "found"])


def find_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> (doc_id, found array<struct<kind, start, end>>) for every row, spans by start and then kind.

    A cheap vectorised pass over whole batches sets aside texts that have neither a keyword nor a long unbroken run; the
    patterns then read the rest whole. Base kinds are reported as matched; the added kinds only when their bytes decode
    and parse: PEM blocks, base64 (in one run or in lines of one length) and hex in either case as the DER of a private key with nested lengths that fill exactly, or as an
    SSH key file by its fields; signed tokens by the JSON of header and payload. Public keys and certificates aren't reported. Null or empty texts have no spans; repeated rows each give a row.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, found {SPANS}")


def joined(found):
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(documents: DataFrame) -> DataFrame:
    found = find_secrets(documents)
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    more = F.size(F.filter("found", lambda s: ~s["kind"].isin(*BASE))).cast("long").alias("n_confirmed")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), more)
