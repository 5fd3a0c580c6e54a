"""Operator 1: secret scan with multipart credential linking.

Three kinds stand on their own and are always reported: `assign` (a key word, then : or =, then
a value of 8 characters or more), `access` (an AKIA identifier of 16 or more) and `hex` (32 or
more lower-case hex digits). The parts of a credential that are weak alone are reported only where
complementary parts co-occur: identifiers (`ident`: user, login, account, client or access
key id, with a value), free-standing high-entropy strings (`weak`) and endpoints (`endpoint`: a
url, an IPv4 address or a host= setting). Each span is widened by REACH characters to its scope, and
scopes are joined as intervals, by a sweep over both sorted sides: a weak secret counts with an
identifier or access key in scope; an identifier or endpoint counts with a secret in scope. Spans are code points, end exclusive.

Every whole text is scanned by one task, in time linear in its length but for sorting its spans; no row needs another, so
nothing is shuffled and no source or group can be hot. A null text is empty; empty tables give an
empty result; a null doc_id, repeated rows and ties are rows like any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure, lean, slices_of

REACH = 160
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "ident", "weak", "endpoint")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
IDENT = re.compile(r"""(?<![A-Za-z0-9])(user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?[ \t]*[:=][ \t]*["']?([A-Za-z0-9_.@+-]{3,})""", re.I | re.A)
WEAK = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{1,5})?(?![\d.])|(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint)["']?[ \t]*[:=][ \t]*["']?[A-Za-z0-9.-]{3,}""", re.I | re.A)

_IS_HEX = bytes(104 if chr(i) in "0123456789abcdef" else 46 for i in range(256))
_IS_WEAK = bytes(104 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/_-") else 46 for i in range(256))
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the kinds that stand alone, by start and kind."""
    out = []
    lower = text.lower()
    if any(word in lower for word in _WORDS):  # every match holds one of them; most texts hold none
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if b"h" * 32 in text.encode("utf-8", "replace").translate(_IS_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def strong_looking(token: str) -> bool:
    """Digits and letters, mixed in case or of one case throughout, and many different characters for its length."""
    if not re.search("[0-9]", token) or not re.search("[A-Za-z]", token):
        return False
    mixed = re.search("[a-z]", token) and re.search("[A-Z]", token)
    return len(set(token)) >= min(12 if mixed else 9, len(token) // 2)


def in_scope(spans: list, others: list, reach: int) -> list[bool]:
    """Which spans have one of the others within reach: interval join by a sweep, both by start."""
    from bisect import bisect_left

    ends, most = [], -1
    for _, _, end in others:
        most = max(most, end)
        ends.append(most)
    starts = [start for start, _, _ in others]
    out = []
    for start, _, end in spans:
        # Others that begin before this scope ends; the furthest end among them must reach back.
        k = bisect_left(starts, end + reach + 1)
        out.append(k > 0 and ends[k - 1] >= start - reach)
    return out


def all_spans(text: str, reach: int = REACH) -> tuple[list, list]:
    """Base spans, and these with the weak parts that complement one another.

    A weak secret (a free-standing token, or an assigned value too short for the base) counts with an identifier or access key
    in scope; an endpoint alone does not make it one. An identifier counts with a secret in scope, and so does an endpoint.
    """
    base = base_spans(text)
    weak = []
    if b"h" * 20 in text.encode("utf-8", "replace").translate(_IS_WEAK):
        weak = [(m.start(), 4, m.end()) for m in WEAK.finditer(text) if strong_looking(m.group())]
    lower = text.lower()
    if any(word in lower for word in _WORDS):
        weak += [(m.start(), 4, m.end()) for m in ASSIGN.finditer(text) if 3 <= m.end(2) - m.start(2) < 8]
    # What overlaps a base span is told by it already.
    weak = [w for w, ok in zip(sorted(weak), in_scope(sorted(weak), base, -1), strict=True) if not ok]
    if not base and not weak:
        return base, base
    idents = [(m.start(), 3, m.end()) for m in IDENT.finditer(text)]
    access = [b for b in base if b[1] == 1]
    weak = [w for w, ok in zip(weak, in_scope(weak, sorted(idents + access), reach), strict=True) if ok]
    if not base and not weak:
        return base, base
    endpoints = [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    secrets = sorted([b for b in base if b[1] != 1] + weak)
    parts = sorted(idents + endpoints)
    linked = [p for p, ok in zip(parts, in_scope(parts, secrets, reach), strict=True) if ok]
    return base, sorted(base + weak + linked)


def credentials(spans: list, reach: int = REACH) -> list[list]:
    """Spans that belong together: runs with at most reach between neighbours that hold a secret and a part that complements it."""
    runs, end = [], None
    for span in spans:
        if end is None or span[0] - end > reach:
            runs.append([])
            end = span[2]
        runs[-1].append(span)
        end = max(end, span[2])
    return [run for run in runs if any(k in (0, 2, 4) for _, k, _ in run) and any(k in (1, 3, 5) for _, k, _ in run)]


def told(spans: list) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans, credentials (spans that belong together, groups parted by ;) for every row of docs."""
    rows = ensure(docs, doc_id="long", text="string")

    def run(batches):
        import pyarrow as pa

        for batch in slices_of(batches):
            out = [[], [], [], [], [], [], []]
            for text in batch.column("text").to_pylist():
                base, spans = all_spans(text or "", reach)
                kinds = [k for _, k, _ in base]
                for column, x in zip(out, (kinds.count(0), kinds.count(1), kinds.count(2), len(spans) - len(base), hashlib.sha256(told(base).encode()).hexdigest(), told(spans), ";".join(map(told, credentials(spans, reach)))), strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, t) for x, t in zip(out, kinds, strict=True)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_linked", "base_sha256", "spans", "credentials"],
            )

    return rows.mapInArrow(lean(run), "doc_id long, n_assign long, n_access long, n_hex long, n_linked long, base_sha256 string, spans string, credentials string")
