"""Secret scans: candidates are decoded and their structure is confirmed before reporting."""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch_of, map_batches, rows_of

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX = re.compile(r"[0-9a-f]{32,}")

# The base kinds in the order that breaks ties, then those that decoding confirms.
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt", "pem")
BASE_KINDS = KINDS[:3]

# Encoded runs shorter than this hold no key.
# An escaped line end before a run is no part of it.
ENCODED = re.compile(r"(?:\\+[nr])*([A-Za-z0-9+/_-]{40,}={0,2})")
HEX_ANY = re.compile(r"(?:\\+[nr])*([0-9A-Fa-f]{64,})")
ESCAPED_END = re.compile(r"(?:\\+r)?\\+n|\\+r")
_END = r"(?:(?:\\+r)?\\+n|[ \t]*\r?\n)[ \t]*"
NEXT_ENCODED = re.compile(_END + r"([A-Za-z0-9+/_-]+={0,2})(?![A-Za-z0-9+/_=-])")
NEXT_HEX = re.compile(_END + r"([0-9A-Fa-f]+)(?![0-9A-Za-z])")

# How keys open: sequences of 128 bytes or more and the usual smaller keys, SSH names and magic.
OPENING = re.compile(
    r"MI[E-P]|MHcCAQEE|MC4CAQAw|MCowBQYDK2|MFkwEwYHKo|MFYwEAYHKo|MHYwEAYHKo"
    r"|AAAA(?:[BC]3NzaC1|E2VjZHNh|GnNrLXNz)|b3BlbnNzaC1rZXktdjE"
)
HEX_OPENING = re.compile(
    r"308[123]|30770201|302e0201|302a3005|30593013|30563010|30763010|000000..(?:7373682d|65636473|736b2d73)"
    r"|6f70656e7373682d6b65792d7631",
    re.IGNORECASE,
)
TOKEN_OPENING = re.compile("eyJ")
SIGNED = re.compile(r"[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]{16,}")
# The dashes of a line may belong to the next one too.
BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]+)(?=-----)")
FINISH = re.compile(r"-----END ([A-Z0-9 ]+)(?=-----)")
# What cannot stand between them.
NO_BODY = re.compile(r"\\+(?![nr\\])|[^A-Za-z0-9+/=\s:,\\-]", re.ASCII)

# Names that open a key blob.
KEY_NAMES = (
    b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384",
    b"ecdsa-sha2-nistp521", b"sk-ssh-ed25519@openssh.com",
)
KEY_MAGIC = b"openssh-key-v1\0"
# Fields of a public key blob by its name.
KEY_FIELDS = dict(zip(KEY_NAMES, (3, 5, 2, 3, 3, 3, 3), strict=True))


def unpack(text: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padded or not."""
    body = text.rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[start:end]`` exactly."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or end - at < width:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
        if size > end - at:
            return None
        items.append((tag, at, at + size))
        start = at + size
    return items


def is_der_key(data: bytes) -> bool:
    """One sequence that fills the data, nested lengths that agree, and an integer, bit or
    octet string inside as keys and certificates have."""
    outer = _der_items(data, 0, len(data))
    if len(data) < 24 or not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    todo, leaves = [outer[0]], 0
    while todo:
        tag, start, end = todo.pop()
        if tag & 0x20:
            items = _der_items(data, start, end)
            if items is None:
                return False
            todo += items
        elif tag in (0x02, 0x03, 0x04) and end > start:
            leaves += 1
    return leaves > 0


def _field(data: bytes, at: int) -> int | None:
    """End of the length-prefixed field at ``at``, or None if it does not fit."""
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return end if at + 4 <= len(data) and end <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the data: a public key, opened by its name, or the
    private format, whose magic is followed by three fields, a count and the keys."""
    private = data.startswith(KEY_MAGIC)
    at, fields = (len(KEY_MAGIC), 0) if private else (0, 0)
    first = b""
    while at < len(data):
        if private and fields == 3:
            keys = int.from_bytes(data[at : at + 4], "big")
            if at + 4 > len(data) or not 1 <= keys <= 64:
                return False
            at += 4
        end = _field(data, at)
        if end is None:
            return False
        if not fields:
            first = data[at + 4 : end]
        at, fields = end, fields + 1
    return fields >= 5 if private else fields >= 2 and first in KEY_NAMES


def is_signed_token(text: str) -> bool:
    """Three parts, the first a JSON object with an algorithm, the second JSON too."""
    header, payload, _ = text.split(".")
    try:
        opened = json.loads(unpack(header) or b"")
        body = json.loads(unpack(payload) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(opened, dict) and isinstance(opened.get("alg"), str) and isinstance(body, dict)


def _confirmed(data: bytes | None) -> str | None:
    if data is None:
        return None
    if data[:1] == b"\x30" and is_der_key(data):
        return "der"
    if (data[:3] == b"\0\0\0" or data.startswith(KEY_MAGIC)) and is_ssh_key(data):
        return "ssh"
    return None


class Run:
    """The bytes of an encoded run from one of its characters on, decoded where they are read.

    So looking at the lengths of a key costs the same however long the run is.
    """

    def __init__(self, text: str, at: int, hexadecimal: bool, size: int | None = None):
        self.text, self.at, self.hexadecimal = text, at, hexadecimal
        rest = len(text) - at
        whole = rest // 2 if hexadecimal else rest * 3 // 4
        self.size = whole if size is None else min(size, whole)

    def __len__(self) -> int:
        return self.size

    def first(self, size: int) -> bytes | Run:
        """The beginning; a short one is decoded at once."""
        if size <= 4096:
            return self[:size]
        return Run(self.text, self.at, self.hexadecimal, size)

    def startswith(self, prefix: bytes) -> bool:
        return self[: len(prefix)] == prefix

    def __getitem__(self, place):
        if not isinstance(place, slice):
            if place >= self.size:
                raise IndexError(place)
            return self[place : place + 1][0]
        start, stop, _ = place.indices(self.size)
        if start >= stop:
            return b""
        if self.hexadecimal:
            return bytes.fromhex(self.text[self.at + 2 * start : self.at + 2 * stop])
        # Four characters are three bytes.
        skipped = start // 3
        piece = self.text[self.at + 4 * skipped : self.at - (-stop // 3) * 4]
        data = unpack(piece[: len(piece) - (len(piece) % 4 == 1)])
        return data[start - 3 * skipped : stop - 3 * skipped]


def _key_size(data: bytes | Run) -> int | None:
    """Bytes of the key that opens the data, as its own lengths tell."""
    if data[:1] == b"\x30":
        width = data[1] & 0x7F if len(data) > 1 and data[1] >= 0x80 else 0
        if len(data) < 2 + width:
            return None
        return 2 + width + (int.from_bytes(data[2 : 2 + width], "big") if width else data[1])
    if data.startswith(KEY_MAGIC):
        at, fields = len(KEY_MAGIC), 3
    else:
        at, fields = 0, KEY_FIELDS.get(data[4 : _field(data, 0) or 4], 0)
    private = at > 0
    while fields:
        end = _field(data, at)
        if end is None:
            return None
        at, fields = end, fields - 1
        if private and not fields:
            fields, private = int.from_bytes(data[at : at + 4], "big") + 1, False
            at += 4
    return at or None


def _blocks(text: str, run: re.Pattern, following: re.Pattern) -> Iterator[list[tuple[int, int]]]:
    """Places of the lines of each wrapped run: a shorter line is the last."""
    at = 0
    while m := run.search(text, at):
        lines = [m.span(1)]
        while text[lines[-1][1] - 1] != "=" and (m := following.match(text, lines[-1][1])):
            size, before = m.end(1) - m.start(1), lines[-1][1] - lines[-1][0]
            # The first line may be glued to a word or cut by its own start.
            if size > before and len(lines) > 1:
                break
            lines.append(m.span(1))
            if size < before and len(lines) > 2 or size < 40:
                break
        yield lines
        at = lines[-1][1]


def _opened(text: str, lines: list[tuple[int, int]], hexadecimal: bool) -> list[tuple[int, int, str]]:
    """Keys that start at a known opening inside a wrapped or glued run, by their own length."""
    joined = "".join(text[start:end] for start, end in lines)
    offsets = [0]
    for start, end in lines:
        offsets.append(offsets[-1] + end - start)

    def place(at: int) -> int:
        line = bisect.bisect_right(offsets, at) - 1
        return lines[line][0] + at - offsets[line]

    body = joined.rstrip("=")
    spans, at = [], 0
    while m := (HEX_OPENING if hexadecimal else OPENING).search(joined, at):
        at = m.start() + 1
        data = Run(body, m.start(), hexadecimal)
        size = _key_size(data)
        if size is None or size > len(data) or not (kind := _confirmed(data.first(size))):
            continue
        at = m.start() + (size * 2 if hexadecimal else -(-size * 4 // 3))
        end = place(at - 1) + 1
        while not hexadecimal and text[end : end + 1] == "=":
            end += 1
        spans.append((place(m.start()), end, kind))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The plain candidates: leftmost and non-overlapping per kind, failing ones dropped."""
    spans = [
        (m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text)
        if len(m[2]) >= ASSIGN_VALUE
    ]
    if "AKIA" in text:
        spans += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return _ordered(spans)


def _armoured(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, body, end) from each BEGIN to the next END of its label, if all between can be a
    body. Ends and foreign characters are listed once, so many openings cost no more."""
    ends: dict[str, list[int]] = {}
    for m in FINISH.finditer(text):
        ends.setdefault(m[1], []).append(m.start())
    if not ends:
        return
    foreign = [m.start() for m in NO_BODY.finditer(text)]
    done = 0
    for m in BEGIN.finditer(text):
        body, places = m.end() + 5, ends.get(m[1], [])
        at = bisect.bisect_left(places, body)
        if m.start() < done or at == len(places):
            continue
        end = places[at]
        strange = bisect.bisect_left(foreign, body)
        if strange == len(foreign) or foreign[strange] >= end:
            done = end + len("-----END ") + len(m[1]) + 5
            yield m.start(), text[body:end], done


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """Runs that decode to a key or a signed token.

    A run that is no key by itself is joined with the lines that go on with it, whose ends may
    be escaped, and searched for the openings of keys.
    """
    armours = []
    if "-----BEGIN " in text:
        for start, body, end in _armoured(text):
            # Header lines of an encrypted block stand before a blank line.
            lines = ESCAPED_END.sub("\n", body)
            body = re.split(r"\n\s*\n", lines.strip())[-1]
            data = unpack(re.sub(r"\s", "", body))
            if data and (_confirmed(data) or "ENCRYPTED" in lines and len(data) >= 24):
                armours.append((start, end, "pem"))
    spans, opened = [], [start for start, _, _ in armours]
    for run, following, hexadecimal in (
        (ENCODED, NEXT_ENCODED, False),
        (HEX_ANY, NEXT_HEX, True),
    ):
        for lines in _blocks(text, run, following):
            alone = []
            for start, end in lines:
                if not run.fullmatch(text, start, end) or hexadecimal and (end - start) % 2:
                    continue
                part = text[start:end]
                if kind := _confirmed(bytes.fromhex(part) if hexadecimal else unpack(part)):
                    alone.append((start, end, kind))
            spans += alone
            # Armours are in order and apart, so few can touch these lines.
            first = max(bisect.bisect_right(opened, lines[0][0]) - 1, 0)
            held = armours[first : bisect.bisect_right(opened, lines[-1][1])] + alone
            if not any(a <= lines[0][0] and lines[-1][1] <= b for a, b, _ in held):
                spans += [
                    x
                    for x in _opened(text, lines, hexadecimal)
                    if not any(x[0] < b and a < x[1] for a, b, _ in held)
                ]
    if "." in text:
        tokens = [
            (m.start(), m.end(), "jwt") for m in SIGNED.finditer(text) if is_signed_token(m[0])
        ]
        done = 0
        for m in TOKEN_OPENING.finditer(text):
            token = SIGNED.match(text, m.start()) if m.start() >= done else None
            if token and is_signed_token(token[0]):
                done = token.end()
                if not any(a <= m.start() < b for a, b, _ in tokens):
                    tokens.append((*token.span(), "jwt"))
        spans += tokens
    return _ordered(set(spans + armours))


def _ordered(spans) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("n_confirmed", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts and spans of every text, one row per document; null counts as empty.

    Offsets are code points of the whole text, ends exclusive. Ties are listed in the order
    of ``KINDS``; repeated rows each get the same answer. Only ``doc_id`` and ``text`` are
    read, so other columns never clash. No shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in rows_of(batch):
                plain = base_spans(text or "")
                added = structural_spans(text or "")
                count = {kind: 0 for kind in KINDS}
                for _, _, kind in plain:
                    count[kind] += 1
                digest = hashlib.sha256(listed(plain).encode()).hexdigest()
                out.append(
                    (doc, *(count[kind] for kind in BASE_KINDS), len(added), digest,
                     listed(_ordered(plain + added)))
                )
            yield batch_of(out, _FOUND)

    return map_batches(
        docs.select("doc_id", "text"),
        scan,
        "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long,"
        " base_sha256 string, spans string",
    )


def redacted(text: str) -> str:
    """The text with every run of overlapping spans replaced by a mark of its first kind."""
    out, at = [], 0
    runs: list[list] = []
    for start, end, kind in _ordered(base_spans(text) + structural_spans(text)):
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, kind])
    for start, end, kind in runs:
        out += [text[at:start], f"[{kind} removed]"]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns; secrets in ``text`` are replaced and ``n_chars``, if there
    is one, follows. Null and clean texts stay as they are."""
    columns = docs.columns
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text_at).to_pylist()
            new = [None if text is None else redacted(text) for text in old]
            arrays = list(batch.columns)
            arrays[text_at] = pa.array(new, type=batch.schema.field(text_at).type)
            if chars_at is not None:
                counts = [
                    count if before == after else len(after)
                    for count, before, after in zip(
                        arrays[chars_at].to_pylist(), old, new, strict=True
                    )
                ]
                arrays[chars_at] = pa.array(counts, type=batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return map_batches(docs, clean, docs.schema)
