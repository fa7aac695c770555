"""Secret scans through a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived that every match must satisfy. Documents come in
segments; a segment's index has a posting list for each trigram some query asks for. Queries intersect and unite
posting lists, and the pattern runs on the documents that are left. A rule from which no trigram follows scans every
document of the segment. Segments are independent: nothing is shuffled, and a lost one is indexed again.

Trigrams are of bytes with A-Z lowered, for patterns that ignore case as for those that don't. Letters beyond ASCII, and those
that match one where case is ignored (i, k, s), give no trigram. Null text counts as
empty. Offsets are code points, ends exclusive. Repeated rows are scanned each for itself; spans that start together are
in the order of the rules. A null doc_id stays null, other columns are ignored (redact() keeps them). No rule looks at a
run of characters from more than one start, so that time is in proportion to the text, however long and hostile.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import text_of

_STRINGS, _SEGMENT_BYTES = 64, 1_000_000
#: ASCII letters that match others where case is ignored (dotless and dotted i, the Kelvin sign, the long s).
_WIDE = "iks"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. group: the part whose length must be `least` at least; base: a rule of the contract."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: A key after its first line: all up to its END line, or, where that is missing, what goes on as header and base64 lines
#: (line ends may be escaped ones) or as long runs of base64.
_LINE_END = r"(?:\r?\n|(?:\\r)?\\n)"
_KEY_BODY = (
    r"(?:(?:[^-]|-(?!----))*-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?:(?:[\x20\t]*{_LINE_END}[\x20\t>]*)+(?:[A-Z][A-Za-z-]{{0,40}}:\x20[^\r\n\\]*|[A-Za-z0-9+/]+={{0,2}})(?=[\x20\t]*(?:{_LINE_END}|\Z))|[\x20\t>\r\n]*[A-Za-z0-9+/=]{{32,}})*)"
)

#: The base rules of the contract in its order, then what this operator looks for besides.
RULES = (
    Rule("assign", r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]+", 0, 32, True),
    Rule("private_key", rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----{_KEY_BODY}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# ---------------------------------------------------------------- pattern -> query
# A query is ("all",), ("tri", code), ("and", [queries]) or ("or", [queries]).


def _trigrams(s: str) -> tuple:
    b = "".join(s).encode().lower()
    codes = sorted({b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)})
    return ("and", [("tri", c) for c in codes]) if codes else ("all",)


def _and(*queries: tuple) -> tuple:
    parts = [q for q in queries if q[0] != "all"]
    return ("all",) if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _or(queries: list[tuple]) -> tuple:
    return ("all",) if any(q[0] == "all" for q in queries) or not queries else queries[0] if len(queries) == 1 else ("or", queries)


def _flush(strings: set[str]) -> tuple:
    return _or([_trigrams(s) for s in sorted(strings)])


def _flags(flags: int, arg: tuple) -> int:
    """The flags inside a group that adds and takes some."""
    _, added, taken, _ = arg
    if added & re.ASCII:
        flags &= ~re.UNICODE
    if added & re.UNICODE:
        flags &= ~re.ASCII
    return (flags | added) & ~taken


def _letter(code: int, flags: int) -> str | None:
    """A character as the index has it; None if the index can't know what it matches."""
    c = chr(code).lower()
    wide = flags & re.IGNORECASE and not flags & re.ASCII and c in _WIDE
    return None if code > 127 or wide else c


def _strings(op, arg, flags: int) -> set[str] | None:
    """The strings that a node matches, if they are few."""
    if op is sre.LITERAL:
        c = _letter(arg, flags)
        return None if c is None else {c}
    if op is sre.IN:
        if all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 8:
            letters = {_letter(v, flags) for _, v in arg}
            return None if None in letters else letters
        return None
    if op is sre.AT:
        return {""}
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[-1], _flags(flags, arg))
    if op is sre.BRANCH:
        parts = [_sequence_strings(b, flags) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 4:
        inner = _sequence_strings(arg[2], flags)
        if inner is None:
            return None
        out = {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(sorted(inner), repeat=n)}
        return out if len(out) <= _STRINGS else None
    return None


def _sequence_strings(nodes, flags: int) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        part = _strings(op, arg, flags)
        if part is None or len(out) * len(part) > _STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _query(nodes, flags: int) -> tuple:
    """What every match of a sequence must hold: runs of known strings give trigrams, other nodes what is inside them."""
    found, run = [], {""}
    for op, arg in nodes:
        part = _strings(op, arg, flags)
        if part is not None and len(run) * len(part) <= _STRINGS:
            run = {a + b for a in run for b in part}
            continue
        found.append(_flush(run))
        run = part if part is not None else {""}
        if part is None:
            if op is sre.SUBPATTERN:
                found.append(_query(arg[-1], _flags(flags, arg)))
            elif op is sre.BRANCH:
                found.append(_or([_query(b, flags) for b in arg[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                found.append(_query(arg[2], flags))
    return _and(*found, _flush(run))


def trigram_query(pattern: str) -> tuple:
    nodes = sre_parse.parse(pattern)
    return _query(nodes, nodes.state.flags)


def asked(query: tuple) -> set[int]:
    return {query[1]} if query[0] == "tri" else set().union(*map(asked, query[1])) if len(query) > 1 else set()


def candidates(query: tuple, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Rows of a segment of n that satisfy the query, in order."""
    if query[0] == "all":
        return np.arange(n)
    if query[0] == "tri":
        return postings.get(query[1], np.zeros(0, np.int64))
    parts = [candidates(q, postings, n) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
    return out


def segment_postings(texts: list[bytes], trigrams: set[int]) -> dict[int, np.ndarray]:
    """Posting lists of one segment: trigram -> rows that contain it, in order."""
    wanted = np.array(sorted(trigrams), np.int32)
    joined = np.frombuffer(b"\n\n".join(texts).lower(), np.uint8)
    if len(joined) < 3 or not len(wanted):
        return {}
    first = np.zeros((256, 256), bool)
    first[wanted >> 16, wanted >> 8 & 255] = True
    at = np.flatnonzero(first.ravel()[joined[:-2].astype(np.int32) << 8 | joined[1:-1]])
    code = joined[at].astype(np.int32) << 16 | joined[at + 1].astype(np.int32) << 8 | joined[at + 2]
    hit = np.isin(code, wanted)
    starts = np.cumsum([0, *(len(t) + 2 for t in texts)])
    pairs = np.unique(np.stack([code[hit].astype(np.int64), np.searchsorted(starts, at[hit], side="right") - 1]), axis=1)
    cut = np.searchsorted(pairs[0], wanted)
    return {int(c): pairs[1][a:b] for c, a, b in zip(wanted, cut, [*cut[1:], pairs.shape[1]], strict=True)}


def scan_segment(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, rule number, end) by start, then by the order of the rules."""
    queries = [trigram_query(r.pattern) for r in rules]
    postings = segment_postings([t.encode() for t in texts], set().union(*map(asked, queries)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        # a run shorter than `least` can't pass; a pattern that is one repeated class may ask for it from the start
        pattern = re.compile(rule.pattern[:-1] + f"{{{rule.least},}}" if rule.group == 0 and rule.least and re.fullmatch(r"\[[^]]+\]\+", rule.pattern) else rule.pattern)
        for i in candidates(query, postings, len(texts)).tolist():
            for m in pattern.finditer(texts[i]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out[i].append((m.start(), k, m.end()))
    return [sorted(spans) for spans in out]


def _segments(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch cut into segments, whose texts alone become Python's: a task holds one segment beside its Arrow batch."""
    texts = batch.column(column)
    sizes, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)), 0
    while at < len(texts):
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _SEGMENT_BYTES)) + 1
        part = batch.slice(at, min(end, len(texts)) - at)
        yield part, [x or "" for x in part.column(column).to_pylist()]
        at = end


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, one count n_<kind> for each base rule, base_sha256 and spans as kind:start:end lists."""
    base = [r.kind for r in rules if r.base]
    named = lambda spans: ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _segments(batch, "text"):
                found = scan_segment(texts, rules)
                counts = [pa.array([sum(rules[k].kind == b for _, k, _ in s) for s in found], pa.int64()) for b in base]
                digests = [hashlib.sha256(named(x for x in s if rules[x[1]].base).encode()).hexdigest() for s in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([named(s) for s in found], pa.string())],
                    ["doc_id", *(f"n_{b}" for b in base), "base_sha256", "spans"],
                )

    schema = "doc_id long, " + ", ".join(f"n_{b} long" for b in base) + ", base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span replaced by [kind] in text; overlapping spans become the first of them. Null stays null."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _segments(batch, "text"):
                out = []
                for text, spans in zip(texts, scan_segment(texts, rules), strict=True):
                    parts, at = [], 0
                    for a, k, b in spans:
                        if a >= at:
                            parts += [text[at:a], f"[{rules[k].kind}]"]
                        at = max(at, b)
                    out.append("".join([*parts, text[at:]]) if spans else text)
                clean = pa.array([None if null else t for t, null in zip(out, part.column("text").is_null().to_pylist(), strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([clean if c == "text" else part.column(c) for c in columns], columns)

    return docs.mapInArrow(run, docs.schema)
