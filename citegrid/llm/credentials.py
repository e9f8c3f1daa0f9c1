"""Secret scans with multipart credential linking.

Base findings are strong on their own.  Other parts are weak: a long mixed
token, an endpoint, a short account identifier mean little by themselves.
Weak parts are reported only where complementary parts meet in one scope.
Parts are intervals; they meet when no more than REACH characters lie between
them and no blank line does.  What complements what:

* a token: an access id, a named identifier or an endpoint;
* a named identifier: an assignment, a token or a hex run;
* an endpoint: an access id, an assignment or a token; a hex run (a commit, a
  checksum) only together with a named identifier.

So a plain link beside a commit, a word after ``account:`` beside a link and
links among themselves are no credentials.  What lies inside an endpoint is
part of it, unless it is its user-info or the value of a key parameter; a
token there meets the endpoint that holds it.

Intervals are joined inside the document that holds them, so no row leaves
its task.  Of the parts on one side of a part the nearest one decides, which
is found by bisection: the join takes n log n steps for n parts, whatever
their lengths.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citegrid.llm.textbatch import slices
from citegrid.session import ship_package

#: Characters that may lie between two parts of one credential.
REACH = 200
#: Kinds of base findings, in the order that breaks ties of start.
BASE = ("assign", "access", "hex")

# Fixed patterns of the base findings.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
# Weak parts: tokens of mixed classes, endpoints, identifiers named as such.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ENDPOINT = re.compile(r"(?:https?|wss?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)://[^\s\"'<>]+")
NAMED_ID = re.compile(r"""(?ai:\b(?:user(?:name)?|account|client_?id|access_?key_?id|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""")

# Places inside an endpoint that hold a secret: user-info, values of key parameters.
USER_INFO = re.compile(r"://([^/?#@]+)@")
KEY_VALUE = re.compile(r"[?&;#](?ai:[a-z_-]*(?:key|token|secret|passw(?:or)?d|signature|sig|auth|credential))=([^&;#]+)")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base findings, by start, then kind as listed."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], BASE.index(s[2])))


def _mixed(token: str) -> bool:
    return (any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)
            and len(set(token)) >= 10)


def _endpoints(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []


def _key_places(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Where an endpoint holds secrets."""
    return [m.span(1) for p in (USER_INFO, KEY_VALUE) for m in p.finditer(text, start, end)]


def _tokens(text: str, start: int, end: int) -> list[Span]:
    return [(m.start(), m.end(), "token") for m in TOKEN.finditer(text, start, end) if _mixed(m.group())]


class _Side:
    """Intervals of some kinds, asked for the nearest one on either side."""

    def __init__(self, parts: list[Span], kinds: set[str]):
        self.starts = sorted(s for s, _, k in parts if k in kinds)
        self.ends = sorted(e for _, e, k in parts if k in kinds)

    def meets(self, text: str, start: int, end: int, reach: int) -> bool:
        i = bisect_left(self.starts, end)
        if i < len(self.starts) and self.starts[i] - end <= reach and "\n\n" not in text[end:self.starts[i]]:
            return True
        i = bisect_right(self.ends, start) - 1
        return i >= 0 and start - self.ends[i] <= reach and "\n\n" not in text[self.ends[i]:start]


def linked_spans(text: str, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak parts that meet a complementary part (see the module's rule).

    Base spans that cover a weak part whole leave nothing of it; one that they
    touch stays whole, but a token has to be mixed by what is neither an
    access id nor an assignment.
    """
    endpoints = _endpoints(text)
    inside: list[Span] = []                       # tokens in key places of endpoints
    holders: dict[Span, tuple[int, int]] = {}
    places: list[tuple[int, int]] = []
    weak: list[Span] = []
    at = 0
    for start, end in endpoints:
        weak += _tokens(text, at, start)
        at = end
        for place in _key_places(text, start, end):
            places.append(place)
            found = _tokens(text, *place)
            inside += found
            holders.update((t, (start, end)) for t in found)
    weak += _tokens(text, at, len(text)) + inside
    weak += [(s, e, "endpoint") for s, e in endpoints]
    weak += [(m.start(1), m.end(1), "identifier") for m in NAMED_ID.finditer(text)]
    if not weak:
        return []
    covered, own = _merged(base), _merged([b for b in base if b[2] != "hex"])
    weak = [w for w in dict.fromkeys(weak) if not _covers(covered, w) and (w[2] != "token" or _mixed(_rest(text, own, w)))]
    places.sort()
    whole = [b for b in base if b[2] != "hex" or not _covers(endpoints, b) or _covers(places, b)]
    parts = whole + weak
    side = {k: _Side(parts, {k}) for k in ("access", "assign", "hex", "token", "identifier", "endpoint")}
    keyed = {holders[w] for w in weak if w in holders}
    out = []
    for w in weak:
        s, e, kind = w
        near = lambda *kinds: any(side[k].meets(text, s, e, reach) for k in kinds)  # noqa: B023, E731
        if kind == "token":
            linked = w in holders or near("access", "identifier", "endpoint")
        elif kind == "identifier":
            linked = near("assign", "token", "hex")
        else:
            linked = (s, e) in keyed or near("access", "assign", "token") or (near("hex") and near("identifier"))
        if linked:
            out.append((s, e, f"linked_{kind}"))
    return sorted(out)


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The union of spans sorted by start, as disjoint intervals."""
    out: list[tuple[int, int]] = []
    for s, e, _ in spans:
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _covers(disjoint: list[tuple[int, int]], w: Span) -> bool:
    i = bisect_left(disjoint, (w[0] + 1, 0)) - 1
    return i >= 0 and disjoint[i][1] >= w[1]


def _rest(text: str, disjoint: list[tuple[int, int]], w: Span) -> str:
    """What the intervals leave of a part's text."""
    at, end = w[0], w[1]
    out = []
    for s, e in disjoint[max(0, bisect_left(disjoint, (at, 0)) - 1):]:
        if s >= end:
            break
        out.append(text[at:max(at, s)])
        at = max(at, e)
    return "".join(out) + text[at:end]


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base and linked findings of a whole text."""
    base = base_spans(text)
    return base, linked_spans(text, base)


def _join(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _order(span: Span) -> tuple:
    return span[0], BASE.index(span[2]) if span[2] in BASE else len(BASE), span[2]


def _scan() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                counts, digests, joined = [], [], []
                for text in pc.fill_null(rows.column("text"), "").to_pylist():
                    base, linked = find(text)
                    kinds = [k for _, _, k in base]
                    counts.append([kinds.count(k) for k in BASE])
                    digests.append(hashlib.sha256(_join(base).encode()).hexdigest())
                    joined.append(_join(sorted(base + linked, key=_order)))
                columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE))]
                yield pa.record_batch([rows.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                                      ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null text is empty (no spans, digest of the empty string); ids may be null
    or repeat, every row is scanned; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_text(text: str | None) -> str | None:
    """Every finding replaced by its kind in brackets; overlapping findings
    by the kind of the first."""
    if not text:
        return text
    base, linked = find(text)
    out, at = [], 0
    for s, e, kind in sorted(base + linked, key=_order):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join(out + [text[at:]]) if out else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all findings taken out of the text; every row stays.
    n_chars, where the table has it as a number, follows the text."""
    from pyspark.sql.types import IntegerType, LongType

    ship_package(docs.sparkSession)
    schema = docs.schema
    counted = [f.name for f in schema.fields if f.name == "n_chars" and isinstance(f.dataType, (IntegerType, LongType))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                i = rows.schema.get_field_index("text")
                old = rows.column(i).to_pylist()
                new = [redact_text(t) for t in old]
                columns = list(rows.columns)
                columns[i] = pa.array(new, rows.schema.field(i).type)
                for name in counted:
                    j = rows.schema.get_field_index(name)
                    known = rows.column(j).to_pylist()
                    columns[j] = pa.array([k if a is b or a == b else len(b) for k, a, b in zip(known, old, new)], rows.schema.field(j).type)
                yield pa.record_batch(columns, schema=rows.schema)
    return docs.mapInArrow(run, schema)
