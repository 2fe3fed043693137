"""Personal data: fixed patterns, and a skip-chain conditional random field that adds spans.

Base spans are the leftmost non-overlapping matches of four patterns (email, ip,
card, phone) that pass their checks.  The field labels the units of a text: its
base spans, whose labels are given, and other pieces that could be personal data
(numbers of seven digits or more, addresses with a written-out at sign, local
parts of the text's own addresses).  Neighbouring units are linked in a chain;
units with the same key (last seven digits, or the same local part) are linked
from one occurrence to the next, however far apart.  Loopy belief propagation gives each unit's
marginals, and a unit outside base spans whose most likely label is a kind of
personal data becomes a span of that kind.

The factors are count tables, each learned as a piece of its own (label given
shape, label given the word before, labels of a chain link, labels of a skip
link), from the units of all documents, in aggregates of bounded size: feature
values are hashed into ``BUCKETS``.  In learning, base spans bear their kind, and pieces
that a pattern matches whole but whose check fails (a number that fails Luhn, say) bear
other and have shapes of their own.  All further units are unobserved: a first pass counts
them as other and leaves their links out, a second one counts them by the marginals that the
first one's factors give them, at both ends of links.  Shapes and words before never say more than ``NOISE`` and ``TILT``
allow, however often they occur, and the skip table starts as ``SAME`` links of equal labels
and ``DIFFERENT`` ones of each other pair.  So a link with a given span outweighs a
shape that is mostly something else, at every size of the corpus, until linked ends that bear
other tell against it.

Two features have a reach: chain links join units at most ``NEAR`` code points apart
(skip links any two), and of an address with a written-out at sign the local part has
at most 64 code points, as mail allows.  Base spans have neither.

Defined results: a null text is empty; an empty text has no spans.  Equal rows
give equal results.  Of equally likely labels the first in the order of ``KINDS`` is
taken, other last.  Offsets count code points, ends are exclusive.  Only doc_id and
text are read; ``masked`` carries other columns along.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
BUCKETS = 1024
ROUNDS = 12
NEAR = 40
SMOOTH = 0.5
NOISE = 0.02  # the share of any shape's units whose labels are taken at random
TILT = 0.2  # how far the word before may lower a label's odds
SAME, DIFFERENT = 100.0, 0.05
WHOLE = 1000  # counts are in thousandths, so that sums do not depend on their order
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"\+?\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)*")
WRITTEN_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CLUE = re.compile(r"[0-9@]|[\[(]at[\])]")
DIGITS = re.compile(r"[0-9]")
Span = tuple[int, int, int]


def emails(text: str) -> Iterator[Span]:
    """Matches around each at sign, so that long runs without one cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def small_parts(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind and start."""
    found = list(emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        if small_parts(m[0]):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGITS.findall(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def refused(piece: str) -> bool:
    """Whether a pattern matches the whole piece, but its check fails."""
    digits = "".join(DIGITS.findall(piece))
    return bool(
        IP.fullmatch(piece) and not small_parts(piece)
        or 16 <= len(digits) <= 19 and CARD.fullmatch(piece) and not luhn(digits)
        or not 8 <= len(digits) <= 15 and PHONE.fullmatch(piece))


def units(text: str, base: list[Span]) -> list[tuple[int, int, int, str]]:
    """(start, end, label, key) by start; label -1 where it is not given."""
    taken = np.zeros(len(text) + 1, bool)
    for _, start, end in base:
        taken[start:end] = True
    found = []
    for kind, start, end in base:
        piece = text[start:end]
        key = piece.split("@")[0] if kind == 0 else "".join(DIGITS.findall(piece))[-7:]
        found.append((start, end, kind, f"{kind == 0}{key}"))
    patterns = [NUMBER] + ([WRITTEN_AT] if "at" in text else [])
    local = sorted({text[s:e].split("@")[0] for k, s, e in base if k == 0 and text.find("@", s) - s >= 5})
    if local:
        patterns.append(re.compile(r"(?<![A-Za-z0-9._%+-])(?:" + "|".join(map(re.escape, local)) + r")(?![A-Za-z0-9_%+@-])"))
    for pattern in patterns:
        for m in pattern.finditer(text):
            start, end = m.span()
            if taken[start:end].any():
                continue
            digits = "".join(DIGITS.findall(m[0]))
            if pattern is NUMBER and len(digits) < 7:
                continue
            taken[start:end] = True
            key = f"False{digits[-7:]}" if pattern is NUMBER else f"True{re.split(r' ?[\[(]at', m[0])[0]}"
            found.append((start, end, -1, key))
    return sorted(found)


def shape(text: str) -> str:
    """Digits as 0, letters as a, runs shortened; the plus of a phone number is left out.  Refused pieces are marked."""
    plain = re.sub(r"[A-Za-z]+", "a", DIGITS.sub("0", text.lstrip("+")))
    return re.sub(r"@|\s?[\[(]at[\])]\s?", "@", plain) + "!" * refused(text)


def bucket(value: str) -> int:
    return zlib.crc32(value.encode()) % BUCKETS


def features(text: str, unit: tuple[int, int, int, str]) -> tuple[int, int]:
    before = text[max(0, unit[0] - 30) : unit[0]].split()
    return bucket(shape(text[unit[0] : unit[1]])), bucket("".join(c for c in before[-1].lower() if c.isalpha()) if before else "")


def links(found: list[tuple[int, int, int, str]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain links of close neighbours, and skip links of units with the same key."""
    chain = [(k, k + 1) for k in range(len(found) - 1) if found[k + 1][0] - found[k][1] <= NEAR]
    last: dict[str, int] = {}
    skip = []
    for k, (_, _, _, key) in enumerate(found):
        if key in last:
            skip.append((last[key], k))
        last[key] = k
    return chain, skip


def counts_of(text: str, model: list[np.ndarray] | None) -> Counter:
    """(factor, feature, label) counts of one text, in thousandths; without a model, units without a label count as other,
    and their links not at all."""
    found = units(text, base_spans(text))
    label = np.zeros((len(found), OTHER + 1))
    for k, unit in enumerate(found):
        label[k, unit[2] if unit[2] >= 0 else OTHER] = 1
    unseen = [k for k, unit in enumerate(found) if unit[2] < 0 and not refused(text[unit[0] : unit[1]])]
    if model and unseen:
        label[unseen] = labels(text, found, model)[unseen]
    out: Counter = Counter()

    def add(factor: int, feature: int, amounts: np.ndarray) -> None:
        for y in np.flatnonzero(amounts > 0.5 / WHOLE).tolist():
            out[factor, feature, y] += round(float(amounts[y]) * WHOLE)

    for unit, y in zip(found, label, strict=True):
        one, two = features(text, unit)
        add(0, one, y)
        add(1, two, y)
    if not model:
        label[unseen] = 0
    for factor, pairs in enumerate(links(found), 2):
        for a, b in pairs:
            for y in range(OTHER + 1):
                add(factor, y, label[a, y] * label[b])
    return out


def texts_of(batch: pa.RecordBatch, at: int) -> list[str]:
    return [x or "" for x in batch.column(at).to_pylist()]


def factor_counts(documents: DataFrame, model: list[np.ndarray] | None) -> DataFrame:
    """factor, feature, label, n over all documents: at most 2 * BUCKETS + 10 features of 5 labels."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for text in texts_of(batch, 0):
                if CLUE.search(text):
                    total += counts_of(text, shared.value)
        rows = [(*key, n) for key, n in total.items()]
        names = ["factor", "feature", "label", "n"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=names)

    part = documents.select("text").mapInArrow(run, "factor bigint, feature bigint, label bigint, n bigint")
    return part.groupBy("factor", "feature", "label").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame) -> list[np.ndarray]:
    """Log factors: shape, word before, chain, skip."""
    return factors(documents, factors(documents, None))


def factors(documents: DataFrame, model: list[np.ndarray] | None) -> list[np.ndarray]:
    tables = [np.zeros((BUCKETS, OTHER + 1)), np.zeros((BUCKETS, OTHER + 1)),
              np.zeros((OTHER + 1, OTHER + 1)), np.zeros((OTHER + 1, OTHER + 1))]
    for row in factor_counts(documents, model).collect():
        tables[row.factor][row.feature, row.label] += row.n / WHOLE
    shape_, word, chain, skip = tables
    prior = shape_.sum(0) + SMOOTH
    prior /= prior.sum()
    shape_ = (shape_ + SMOOTH * prior) / (shape_ + SMOOTH * prior).sum(1, keepdims=True)
    shape_ = np.log((1 - NOISE) * shape_ + NOISE / len(prior))
    pull = len(prior) * 4.0  # the word before only tilts what the shape says
    word = (word + pull * prior) / (word + pull * prior).sum(1, keepdims=True) / prior
    word = np.log((1 - TILT) * word + TILT)

    def ratio(table: np.ndarray, start: np.ndarray) -> np.ndarray:
        table = (table + table.T) / 2 + start
        table /= table.sum()
        return np.log(table / np.outer(table.sum(0), table.sum(0)))

    own = np.eye(OTHER + 1)
    return [shape_, word, 0.5 * ratio(chain, np.ones_like(own)), ratio(skip, np.where(own, SAME, DIFFERENT))]


def marginals(nodes: np.ndarray, edges: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Loopy sum-product, damped; ``factors`` has a log table for each of ``edges``."""
    labels = nodes.shape[1]
    messages = np.zeros((2, len(edges), labels))  # [0]: to the first end, [1]: to the second end
    for _ in range(ROUNDS):
        belief = nodes.copy()
        for side in (0, 1):
            np.add.at(belief, edges[:, side], messages[side])
        sent = np.empty_like(messages)
        for side in (0, 1):
            cavity = belief[edges[:, 1 - side]] - messages[1 - side]
            table = factors if side else factors.transpose(0, 2, 1)  # [edge, from, to]
            joint = cavity[:, :, None] + table
            sent[side] = np.logaddexp.reduce(joint, axis=1)
            sent[side] -= sent[side].max(1, keepdims=True)
        messages = 0.5 * messages + 0.5 * sent
    belief = nodes.copy()
    for side in (0, 1):
        np.add.at(belief, edges[:, side], messages[side])
    belief = np.exp(belief - belief.max(1, keepdims=True))
    return belief / belief.sum(1, keepdims=True)


def labels(text: str, found: list[tuple[int, int, int, str]], model: list[np.ndarray]) -> np.ndarray:
    """The marginals of every unit; those of base spans are certain."""
    nodes = np.full((len(found), OTHER + 1), -50.0)
    for k, unit in enumerate(found):
        if unit[2] >= 0:
            nodes[k, unit[2]] = 0
        else:
            one, two = features(text, unit)
            nodes[k] = model[0][one] + model[1][two]
    chain, skip = links(found)
    edges = np.array(chain + skip, np.int64).reshape(-1, 2)
    tables = np.concatenate([np.broadcast_to(model[2], (len(chain), *model[2].shape)), np.broadcast_to(model[3], (len(skip), *model[3].shape))])
    return marginals(nodes, edges, tables)


def added_spans(text: str, base: list[Span], model: list[np.ndarray]) -> list[Span]:
    """Spans that the field adds to the base spans."""
    found = units(text, base)
    if all(unit[2] >= 0 for unit in found):
        return []
    best = labels(text, found, model).argmax(1)
    return [(int(y), u[0], u[1]) for u, y in zip(found, best, strict=True) if u[2] < 0 and y != OTHER]


def all_spans(text: str, model: list[np.ndarray]) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, each by kind and start."""
    if not CLUE.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, model))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def private_spans(documents: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans, and n_added for every document."""
    model = documents.sparkSession.sparkContext.broadcast(learn(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, digests, listed, added = [], [], [], []
            for text in texts_of(batch, 1):
                base, every = all_spans(text, model.value)
                counts.append([sum(s[0] == k for s in base) for k in range(len(KINDS))])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                listed.append(joined(every))
                added.append(len(every) - len(base))
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(columns[:, k]) for k in range(len(KINDS))],
                 pa.array(digests, pa.string()), pa.array(listed, pa.string()), pa.array(added, pa.int64())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
            )

    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    if not spans:
        return text
    pieces, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            pieces += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def masked(documents: DataFrame) -> DataFrame:
    """The documents with masked texts; ``n_chars``, if there, follows the new text where it changes."""
    model = documents.sparkSession.sparkContext.broadcast(learn(documents))
    names = documents.columns
    at_text, at_length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = list(batch.columns)
            before = columns[at_text].to_pylist()
            after = [x if not x else masked_text(x, all_spans(x, model.value)[1]) for x in before]
            columns[at_text] = pa.array(after, columns[at_text].type)
            if at_length is not None:
                lengths = columns[at_length].to_pylist()
                lengths = [n if a == b else len(a) for n, a, b in zip(lengths, after, before, strict=True)]
                columns[at_length] = pa.array(lengths, columns[at_length].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.mapInArrow(run, documents.schema)
