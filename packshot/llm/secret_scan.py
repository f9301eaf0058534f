"""Secrets in texts, with weak candidates only where complementary parts of a credential meet.

Base kinds stand by themselves: ``assign`` (a key word, ``:`` or ``=``, a value), ``access`` (access key
ids) and ``hex`` (long lowercase hex runs). Weak kinds are too common alone: ``id`` (an account or client
assigned), ``key`` (a random-looking run of letters and digits) and ``endpoint`` (a URL or cloud host).

Every part has a role: identifier (access, id), secret (assign, hex, key), endpoint. A scope is a
paragraph (blank lines part them); parts meet when they begin in one scope, however far apart. The scopes that
hold parts of a role are found by an interval join of the sorted parts with the scopes of the document. Reported are: an ``id`` that meets a
secret, a ``key`` that meets an identifier or an endpoint, an ``endpoint`` that meets both an identifier and a
secret. A weak candidate that overlaps a base span is that span and not reported again.

Null or empty texts have no spans. Rows that repeat a document give a row each. Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packshot.llm import arrow_text

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
MASK = "[secret]"
COLUMNS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

# fixed values: the base patterns and least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

_LEADS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ID = re.compile(
    r"""(?<![A-Za-z0-9])(?:client_?id|account(?:_?id)?|user(?:_?(?:name|id))?|login|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    re.I | re.A,
)
_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
_ENDPOINT = re.compile(r"""https?://[^\s"'<>]+|(?<![\w.-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:amazonaws|azure|googleapis|cloudflare)\.com\b""")
_BREAK = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of base kinds, sorted."""
    found = []
    low = text.lower()
    if any(x in low for x in _LEADS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class _Parts:
    """Intervals of one role, for the question whether any of them overlaps a given one."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        spans = sorted(spans)
        self.starts, self.ends, most = [s for s, _ in spans], [], -1
        for _, e in spans:
            most = max(most, e)
            self.ends.append(most)  # the furthest end so far

    def meet(self, low: int, high: int) -> bool:
        at = bisect_right(self.starts, high)
        return at > 0 and self.ends[at - 1] >= low


def _scopes_of(starts: list[int], breaks: list[int]) -> set[int]:
    """The numbers of the scopes in which a part begins: a merge of two sorted lists."""
    found, scope = set(), 0
    for s in sorted(starts):
        while scope < len(breaks) and breaks[scope] <= s:
            scope += 1
        found.add(scope)
    return found


def linked_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates that meet complementary parts, as ``(start, kind, end)``."""
    low = text.lower()
    weak = [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)] if "://" in text or ".com" in text else []
    if base or weak or ("=" in text or ":" in text) and any(x in low for x in ("client", "account", "user", "login", "access")):
        weak += [(m.start(), 3, m.end()) for m in _ID.finditer(text)]
    if not base and not weak:
        return []  # a key alone meets nothing
    weak += [(m.start(), 4, m.end()) for m in _KEY.finditer(text)]
    taken = _Parts([(s, e) for s, _, e in base])
    weak = [w for w in weak if not taken.meet(w[0] + 1, w[2] - 1)]
    roles: list[list] = [[], [], []]
    for s, k, _ in [*base, *weak]:
        roles[(1, 0, 1, 0, 1, 2)[k]].append(s)
    breaks = [m.end() for m in _BREAK.finditer(text)]
    identifiers, secrets, endpoints = (_scopes_of(r, breaks) for r in roles)
    out = []
    for s, k, e in weak:
        scope = bisect_right(breaks, s)
        has_id, has_secret, has_end = (scope in p for p in (identifiers, secrets, endpoints))
        if (k == 3 and has_secret) or (k == 4 and (has_id or has_end)) or (k == 5 and has_id and has_secret):
            out.append((s, k, e))
    return out


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every run of touching spans replaced by :data:`MASK`."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at or not out:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of base kinds, their digest and all spans; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_text.chunks(batches):
            rows = []
            for text in part.column("text").to_pylist():
                base = base_spans(text or "")
                spans = base + linked_spans(text or "", base)
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                rows.append((*(sum(k == n for _, k, _ in base) for n in range(3)), digest, spelled(spans)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.record_batch([part.column("doc_id"), *columns], [c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COLUMNS)


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans masked in ``text`` and, if there is one, ``n_chars`` counted anew."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for part in arrow_text.chunks(batches):
            texts = []
            for text in part.column(at).to_pylist():
                base = base_spans(text or "")
                spans = base + linked_spans(text or "", base)
                texts.append(masked(text, spans) if spans else text)
            columns = list(part.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.record_batch(columns, names=part.schema.names)

    out = docs.mapInArrow(run, schema)
    if "n_chars" in names:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out
