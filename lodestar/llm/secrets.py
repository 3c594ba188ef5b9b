"""Secret scans: base patterns, and automata that recognise credential formats.

Base patterns find labelled credentials. From a bounded sample of them one probabilistic
automaton per kind is inferred, and one of ordinary tokens. Every candidate of the
corpus outside the base spans is then scored: it is a secret when some kind's automaton
finds it as likely as its own credentials, and likelier than the ordinary one by a margin.

Candidates have the least length of a labelled credential, six symbols. They are whole tokens,
what ``=`` separates in them, and what ``=``, ``/`` and ``.`` separate; the widest that is a
secret is the span. A credential whose own ``/`` or ``.`` is glued to a prefix by the same sign is
judged in its parts only.

Defined cases: a null text is an empty one, without spans. Spans are in code points, end
exclusive. Equal texts have equal spans. A kind without labelled credentials has no automaton and
adds nothing. Columns besides the text are kept as they are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from lodestar.llm.automata import Automaton, learn
from lodestar.llm.common import bound_arrow_batches, frugal, small_batches
from lodestar.llm.words import runs, text_bytes

KINDS = ("assign", "access", "hex")
#: Kind of the spans that the automata add.
ADDED = "format"
#: Distinct values of each class that the automata are learnt from at most; a longer value counts as its stretches of so many symbols.
LEARN_VALUES, LEARN_CHARS = 600, 200
#: Natural-log margin over the automaton of ordinary tokens: for each symbol, and in all.
MARGIN, EVIDENCE = 1.0, 16.0
#: Least length of a candidate, that of a labelled credential.
LEAST_CHARS = 6
#: Verdicts on tokens that a task remembers, and the longest token it remembers one of.
REMEMBERED, REMEMBERED_CHARS = 1 << 16, 64

_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
# greedy runs of a class are maximal, so the least lengths can stand in the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
#: What separates the candidates within a token, level by level.
_PARTS = (re.compile(r"[^=]+"), re.compile(r"[^=/.]+"))
_NAMES = ("passw", "secret", "token", "apikey", "api_key")

_TOKEN_BYTE = np.zeros(256, dtype=bool)
_TOKEN_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.=-"]] = True
#: Least length of a base span without a name.
UNNAMED_CHARS = 20

Span = tuple[str, int, int]


def texts_with_base(texts: pa.Array) -> list[bool]:
    """Whether a long token or a name of a secret stands in a text, without which it has no base span."""
    data, offsets = text_bytes(texts)
    start, end, rows = runs(data, offsets, _TOKEN_BYTE)
    long = np.concatenate([[0], np.cumsum(end - start >= UNNAMED_CHARS)])
    out = (long[rows[1:]] > long[rows[:-1]]).tolist()
    for i, text in enumerate(texts.to_pylist()):
        if text and not out[i]:
            low = text.lower()
            out[i] = any(name in low for name in _NAMES)
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start and kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _trimmed(token: str, a: int, b: int) -> tuple[int, int]:
    """``a:b`` without signs that close a sentence or stand around a value."""
    part = token[a:b]
    return b - len(part.lstrip("+/_.=-")), a + len(part.rstrip("+/_.-"))


def token_spans(token: str, is_secret: Callable[[str], bool], free: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Widest candidates of a token that are secrets; only those that are ``free`` are judged."""
    todo, judged, found = [(0, len(token), 0)], set(), []
    while todo:
        low, high, level = todo.pop()
        a, b = _trimmed(token, low, high)
        if b - a < LEAST_CHARS:
            continue
        if (a, b) not in judged and (free is None or free(a, b)):
            judged.add((a, b))
            if is_secret(token[a:b]):
                found.append((a, b))
                continue
        if level < len(_PARTS):
            todo += [(*m.span(), level + 1) for m in _PARTS[level].finditer(token, low, high)]
    return sorted(found)


class _Taken:
    """Stretches of a text that base spans cover."""

    def __init__(self, base: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((a, b) for _, a, b in base):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        at = bisect_right(self.ends, a)
        return at < len(self.starts) and self.starts[at] < b


@dataclass
class FormatModel:
    """Automata of the kinds, their least likelihoods, and the one of ordinary tokens."""

    kinds: dict[str, tuple[Automaton, float]] = field(default_factory=dict)
    ordinary: Automaton | None = None

    def is_secret(self, value: str) -> bool:
        plain = self.ordinary.likelihood(value) if self.ordinary else -20.0
        least = max(MARGIN, EVIDENCE / (len(value) + 1))
        for automaton, own_least in self.kinds.values():
            own = automaton.likelihood(value)
            if own >= own_least and own - plain >= least:
                return True
        return False


class Scanner:
    """Spans of texts by a model; verdicts on short tokens are remembered, as words repeat."""

    def __init__(self, model: FormatModel) -> None:
        self.model = model
        self._remembered = lru_cache(REMEMBERED)(self._judge)

    def _judge(self, token: str) -> list[tuple[int, int]]:
        return token_spans(token, self.model.is_secret)

    def _of(self, token: str) -> list[tuple[int, int]]:
        return self._remembered(token) if len(token) <= REMEMBERED_CHARS else self._judge(token)

    def spans(self, text: str, may_have_base: bool = True) -> list[Span]:
        """Base spans of ``text`` and those the automata add, by start and kind."""
        base = base_spans(text) if may_have_base else []
        if not self.model.kinds:
            return base
        hits = {t: found for t in set(_TOKEN.findall(text)) if (found := self._of(t))}
        if not base and not hits:
            return base
        taken, added = _Taken(base), []
        for m in _TOKEN.finditer(text):
            at = m.start()
            if taken.touches(at, m.end()):
                found = token_spans(m[0], self.model.is_secret, lambda a, b, at=at: not taken.touches(at + a, at + b))
            else:
                found = hits.get(m[0], ())
            added += [(ADDED, at + a, at + b) for a, b in found]
        order = (*KINDS, ADDED)
        return sorted(base + added, key=lambda s: (s[1], order.index(s[0])))


def all_spans(text: str, model: FormatModel) -> list[Span]:
    return Scanner(model).spans(text)


def _values(text: str, may_have_base: bool) -> Iterator[tuple[str, str]]:
    base = base_spans(text) if may_have_base else []
    for kind, a, b in base:
        yield kind, _ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b]
    taken = _Taken(base)
    tokens = (m[0] for m in _TOKEN.finditer(text) if not taken.touches(*m.span())) if base else set(_TOKEN.findall(text))
    for token in tokens:
        a, b = _trimmed(token, 0, len(token))
        if b - a >= LEAST_CHARS:
            yield "ordinary", token[a:b]


def _least(found: Iterable[str], values: int) -> list[tuple[int, str]]:
    return nsmallest(values, ((xxhash.xxh64_intdigest(v) >> 1, v) for v in found))


def _labelled(values: int):
    # the least hashes of all rows are among the least ones of their tasks
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list[tuple[int, str]]] = {}
        for batch in small_batches(batches, "text"):
            found: dict[str, set[str]] = {}
            for text, may in zip(batch.column("text").to_pylist(), texts_with_base(batch.column("text"))):
                for kind, value in _values(text, may) if text else ():
                    found.setdefault(kind, set()).update(value[i : i + LEARN_CHARS] for i in range(0, len(value), LEARN_CHARS))
            for kind, new in found.items():
                best[kind] = _least(new.union(v for _, v in best.get(kind, ())), values)
        rows = [(kind, value, h) for kind, kept in best.items() for h, value in kept]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "value", "h"])

    return run


def learn_formats(docs: DataFrame, values: int = LEARN_VALUES) -> FormatModel:
    """Automata from at most ``values`` distinct values of each class, chosen by hash from all documents."""
    bound_arrow_batches(docs.sparkSession)
    found = docs.select("text").mapInArrow(_labelled(values), "kind string, value string, h long").distinct()
    found = found.withColumn("part", F.pmod(F.col("h"), F.lit(64)))
    # first within parts of a kind, so that a common kind is not ranked by one task
    for group in (("kind", "part"), ("kind",)):
        order = Window.partitionBy(*group).orderBy("h", "value")
        found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= values)
    rows = found.select("kind", "value").collect()
    by: dict[str, list[str]] = {}
    for r in rows:
        by.setdefault(r["kind"], []).append(r["value"])
    model = FormatModel(ordinary=learn(by["ordinary"]) if "ordinary" in by else None)
    for kind in KINDS:
        if kind in by:
            automaton = learn(by[kind])
            scores = sorted(automaton.likelihood(v) for v in by[kind])
            model.kinds[kind] = (automaton, scores[len(scores) // 100])
    return model


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in small_batches(batches, "text"):
            texts = batch.column("text")
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t, may)] if t else []
                for t, may in zip(texts.to_pylist(), texts_with_base(texts))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    return run


def secret_spans(docs: DataFrame, model: FormatModel) -> DataFrame:
    """``doc_id, spans`` of every document; base spans and those the automata add."""
    bound_arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(shared), schema)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch of spans replaced by the kind of its first one."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redacting(shared: Broadcast, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in small_batches(batches, column):
            texts = batch.column(column).to_pylist()
            for i, may in enumerate(texts_with_base(batch.column(column))):
                if texts[i]:
                    texts[i] = redact(texts[i], scanner.spans(texts[i], may))
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return run


def redact_secrets(docs: DataFrame, model: FormatModel) -> DataFrame:
    """All rows and columns of ``docs`` with the secrets in ``text`` replaced by their kinds."""
    bound_arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(frugal(_redacting(shared, "text")), docs.schema)
