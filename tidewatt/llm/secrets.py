"""Secrets: all rules in one deterministic automaton, one pass over the bytes of a text.

A rule is a head, a body and a sign, all regular expressions, and the least length of the
body; the sign is how a body of that length begins.  Heads and signs of all rules are compiled together
(see ``automaton``) into one array of transitions, which the driver makes once and sends to
the tasks.  A task takes one step a byte for all rules at once.  A text in which that pass
meets a sign is gone over by the same automaton with its places kept, which tells the
stretches that hold signs, and of which rules.  There a match is read off by the rule's own automaton: leftmost first, each as long as possible, none overlapping the one
before; a match with too short a body is dropped, and its text is not tried again.
Whole bodies are left out of the common automaton, since they go on side by side in
any combination and would multiply its states (some 120,000 instead of a few hundred).

The first three rules are the base ones.  The others are formats that issuers of keys
publish, and that the base rules do not find by themselves.

Defined results: null and empty texts have no secrets.  Equal rows give equal results.
Offsets count code points, ends are exclusive; rules match ASCII only, other characters
end a match.  Spans are ordered by start, then by rule; spans of different rules may overlap.
Time is linear in the length of a text without matches.  Further columns are kept by
``redacted`` and not read by ``found_secrets``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.automaton import Automaton, chained, compiled, longest, matches_somewhere, stretches
from tidewatt.llm.common import slices


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    sign: str
    body: str
    least: int = 1


# The base rules, keywords spelled in either case, and public key formats.
ASSIGNED = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])" r"""["']? *[:=] *["']?"""
)
BASE = (
    Rule("assign", ASSIGNED, "[A-Za-z0-9+/_.=-]", "[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", "AKIA", "[A-Z0-9]", "[A-Z0-9]+", 12),
    Rule("hex", "", "[0-9a-f]{32}", "[0-9a-f]+", 32),
)
RULES = (
    *BASE,
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", "[A-Za-z0-9]+", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", "[A-Za-z0-9-]+", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", "[A-Za-z0-9_-]+", 35),
    Rule("stripe", "[rs]k_live_", "[A-Za-z0-9]", "[A-Za-z0-9]+", 24),
    Rule("jwt", "eyJ", "[A-Za-z0-9_-]", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("bearer", "[Bb]earer +", "[A-Za-z0-9._~+/=-]", "[A-Za-z0-9._~+/=-]+", 20),
    Rule("login", r"://[A-Za-z0-9._~%-]*:", "[A-Za-z0-9._~%!$&*+,;=-]", "[A-Za-z0-9._~%!$&*+,;=-]+@[A-Za-z0-9.-]+", 3),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", "", "([A-Za-z0-9+/=\r\n]*-----END ([A-Z]+ )*PRIVATE KEY-----)?", 0),
)


@dataclass(frozen=True)
class Scanner:
    """The automaton of all rules' heads and signs, and for each rule its own and that of its head."""

    kinds: tuple[str, ...]
    least: tuple[int, ...]
    every: Automaton
    start: list
    whole: tuple[Automaton, ...]
    heads: tuple[Automaton | None, ...]


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    every = compiled([r.head + r.sign for r in rules], anywhere=True)
    return Scanner(
        tuple(r.kind for r in rules), tuple(r.least for r in rules), every, chained(every),
        tuple(compiled([r.head + r.body], anywhere=False) for r in rules),
        tuple(compiled([r.head], anywhere=False) if r.head else None for r in rules),
    )


def byte_spans(scan: Scanner, data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, rule) of the matches in bytes, sorted."""
    if not matches_somewhere(scan.start, data.translate(scan.every.classes)):
        return []
    found = []
    read: dict[int, tuple[bytes, int]] = {}
    for begin, end, rules in stretches(scan.every, data):
        for rule in rules:
            whole, head = scan.whole[rule], scan.heads[rule]
            kinds, done = read.get(rule) or (data.translate(whole.classes), 0)
            at = max(begin, done)
            while at < end:
                stop = longest(whole, kinds, at)
                if stop < 0:
                    at += 1
                    continue
                body = longest(head, data[at:stop].translate(head.classes), 0) if head else 0
                if stop - at - body >= scan.least[rule]:
                    found.append((at, stop, rule))
                at = stop
            read[rule] = kinds, at
    return sorted(found, key=lambda span: (span[0], span[2]))


def spans(scan: Scanner, data: bytes | None) -> list[tuple[int, int, int]]:
    """(start, end, rule) in code points of a text given as UTF-8."""
    found = byte_spans(scan, data) if data else []
    if not found or data.isascii():
        return found
    return [(len(data[:start].decode()), len(data[:end].decode()), rule) for start, end, rule in found]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def found_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``found``, the spans of kind, start and end, for every document."""
    model = documents.sparkSession.sparkContext.broadcast(_plain(scanner(rules)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(model.value)
        for batch in slices(batches):
            listed = [
                [{"kind": scan.kinds[rule], "start": start, "end": end} for start, end, rule in spans(scan, data)]
                for data in utf8(batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, SPANS)], names=["doc_id", "found"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found {SPANS_SQL}")


def redacted_text(scan: Scanner, data: bytes) -> bytes:
    """The text with every match replaced by its kind; overlapping ones by that of the first."""
    pieces, at = [], 0
    for start, end, rule in byte_spans(scan, data):
        if start >= at:
            pieces += [data[at:start], b"<%s>" % scan.kinds[rule].encode()]
        at = max(at, end)
    return b"".join([*pieces, data[at:]])


def redacted(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents without their secrets; ``n_chars``, if there, follows the new text where it changes."""
    model = documents.sparkSession.sparkContext.broadcast(_plain(scanner(rules)))
    names = documents.columns
    at_text, at_length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(model.value)
        for batch in slices(batches):
            columns = list(batch.columns)
            before = utf8(columns[at_text])
            after = [redacted_text(scan, data) if data else data for data in before]
            columns[at_text] = pa.array(after, pa.large_binary()).cast(pa.large_string()).cast(columns[at_text].type)
            if at_length is not None:
                lengths = columns[at_length].to_pylist()
                lengths = [n if a == b else len(a.decode()) for n, a, b in zip(lengths, after, before, strict=True)]
                columns[at_length] = pa.array(lengths, columns[at_length].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.mapInArrow(run, documents.schema)


def _plain(scan: Scanner) -> dict:
    """The scanner as plain lists: broadcasts are pickled by reference, and workers may lack the package."""
    pack = lambda a: None if a is None else (a.classes, a.width, a.table, a.accepts, a.first_accept, a.dead)
    return {
        "kinds": scan.kinds, "least": scan.least, "every": pack(scan.every),
        "whole": [pack(a) for a in scan.whole], "heads": [pack(a) for a in scan.heads],
    }


def _scanner(plain: dict) -> Scanner:
    made = lambda a: None if a is None else Automaton(*a)
    every = made(plain["every"])
    return Scanner(
        plain["kinds"], plain["least"], every, chained(every),
        tuple(map(made, plain["whole"])), tuple(map(made, plain["heads"])),
    )


def joined(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(documents: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans, and n_added for every document."""
    found = F.col("found")

    def of(*kinds: str) -> Column:
        return F.filter(found, lambda s: s["kind"].isin(*kinds))

    base = of(*[rule.kind for rule in BASE])
    counts = [F.size(of(rule.kind)).cast("bigint").alias(f"n_{rule.kind}") for rule in BASE]
    return found_secrets(documents).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"),
        (F.size(found) - F.size(base)).cast("bigint").alias("n_added"),
    )
