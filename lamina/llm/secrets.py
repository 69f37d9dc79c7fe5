"""Secret scans by a trigram index.

Each rule is a regular expression. From its parsed form follows a Boolean query over trigrams that every text with
a match satisfies: the trigrams of a literal run must all occur (and), those of one of the
alternatives must (or). The query is derived for lower-cased text, so it also serves rules that ignore case.

The index is partitioned by document, as large text indexes are: for every block of documents, the
posting list of each trigram that any rule asks for is built in one pass over the block's bytes, the
queries are evaluated by intersecting and uniting posting lists, and only the documents that remain are
verified with the rule's regular expression. A rule without mandatory trigrams verifies all documents. The
index never outlives its block, so nothing is shuffled or stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import runs_of, small_batches

# Bytes that are indexed at a time.
BLOCK_BYTES = 4 << 20

# Queries: everything, or ("and" | "or", parts), or a trigram of lower-case bytes.
ALL = ("all",)

# A set of literal strings that grows beyond this is no longer followed.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` is ``least`` characters long or longer.

    Matches are the leftmost ones that do not overlap; one that is too short is dropped, but still covers its
    characters. ``any_case`` ignores the case of ASCII letters; ``base`` marks the rules that are counted.
    ``linear`` is an expression whose group ``span`` finds the same matches in time linear in the text.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    base: bool = False
    linear: str = ""

    def compiled(self):
        import re

        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The patterns and least lengths of the three base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case=True,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]+", least=24, base=True),
)

# A private key runs from its BEGIN line to the next END line. Where another BEGIN or the end of the text comes first, it
# is the header fields and base64 lines that follow; lines may be joined by blanks, quoted, or have escaped breaks. On a
# joined line a short last part is taken unless it looks like a word.
_LABEL = r"(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
_GAP = r"(?:[\s>#*|\"',;]|\\+[nrt])"
_BASE64 = r"(?:[A-Za-z0-9+/=]|\\+/)"
_NO_WORD = rf"(?![A-Z]?[a-z]*+(?!{_BASE64}))"
_KEY_LINE = rf"{_GAP}*+(?:{_BASE64}{{24,}}+|{_NO_WORD}{_BASE64}++(?=[ \t\"',;]*+(?:[\r\n]|\\+[nr]|\Z)))"
_PRIVATE_KEY = (
    rf"-----BEGIN {_LABEL}"
    rf"(?:(?:[^-]++|-(?!----(?:BEGIN|END) {_LABEL}))*+-----END {_LABEL}"
    rf"|(?:{_GAP}*+[A-Z][A-Za-z0-9-]*+:\x20[^\n\\]*+)*+(?:(?:{_KEY_LINE})++(?:{_GAP}++{_NO_WORD}{_BASE64}++)?)?)"
)

# Published forms of other credentials.
RULES = BASE_RULES + (
    Rule("private_key", _PRIVATE_KEY),
    Rule("forge_token", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # A dot ends each run of letters, so only the first eyJ of a run can begin a match, and each run is read from its
    # beginning once.
    Rule(
        "web_token",
        r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
        linear=r"(?<![A-Za-z0-9_-])(?:[A-Za-df-z0-9_-]++|e(?!yJ))*+"
        r"(?P<span>eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)",
    ),
)

KINDS = tuple(rule.kind for rule in RULES)


def _both(op: str, parts: Sequence[tuple]) -> tuple:
    """Conjunction or disjunction, simplified."""
    flat = [p for p in dict.fromkeys(parts) if not (op == "and" and p == ALL)]
    if op == "or" and ALL in flat or not flat:
        return ALL
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_string(text: bytes) -> tuple:
    return _both("and", [("has", text[i : i + 3]) for i in range(len(text) - 2)])


def _of_strings(strings: set[bytes]) -> tuple:
    return _both("or", [_of_string(s) for s in sorted(strings)])


def trigram_query(pattern: str, any_case: bool = False) -> tuple:
    """Boolean query over trigrams of lower-cased UTF-8 that holds for every text with a match.

    The parsed expression is read from left to right, keeping the set of strings that the part just
    read must spell, until that set has no bound; its trigrams are then required and a new run begins.
    """
    import re
    from re import _constants as op, _parser as parser

    def low(code: int) -> bytes:
        return chr(code).encode().lower()

    def members(items) -> set[bytes] | None:
        found: set[bytes] = set()
        for kind, value in items:
            if kind is op.LITERAL:
                found.add(low(value))
            elif kind is op.RANGE and value[1] - value[0] < 8:
                found |= {low(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None

    def strings(item) -> set[bytes] | None:
        """All strings that an item can spell, lower-cased, or None where there is no such small set."""
        kind, value = item
        if kind is op.LITERAL:
            return {low(value)}
        if kind is op.IN:
            return members(value)
        if kind is op.AT:
            return {b""}
        if kind is op.SUBPATTERN:
            return spelled(value[3])
        if kind is op.BRANCH:
            found: set[bytes] = set()
            for branch in value[1]:
                one = spelled(branch)
                if one is None:
                    return None
                found |= one
            return found if len(found) <= MOST_STRINGS else None
        if kind is op.MAX_REPEAT and value[1] <= 5:
            one = spelled(value[2])
            if one is None:
                return None
            found, power = set(), {b""}
            for times in range(value[1] + 1):
                if times >= value[0]:
                    found |= power
                power = {a + b for a in power for b in one}
                if len(power | found) > MOST_STRINGS:
                    return None
            return found
        return None

    def spelled(items) -> set[bytes] | None:
        run = {b""}
        for item in items:
            one = strings(item)
            if one is None:
                return None
            run = {a + b for a in run for b in one}
            if len(run) > MOST_STRINGS:
                return None
        return run

    def required(items) -> tuple:
        parts, run = [], {b""}
        for item in items:
            one = strings(item)
            grown = None if one is None else {a + b for a in run for b in one}
            if grown is not None and len(grown) <= MOST_STRINGS:
                run = grown
                continue
            parts.append(_of_strings(run))
            run = {b""} if one is None else one
            if one is None:
                parts.append(inside(item))
        return _both("and", [*parts, _of_strings(run)])

    def inside(item) -> tuple:
        kind, value = item
        if kind is op.SUBPATTERN:
            return required(value[3])
        if kind is op.BRANCH:
            return _both("or", [required(branch) for branch in value[1]])
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            return required(value[2])
        return ALL

    flags = re.ASCII | (re.IGNORECASE if any_case else 0)
    return required(parser.parse(pattern, flags))


def _asked(query: tuple) -> set[bytes]:
    if query[0] == "has":
        return {query[1]}
    return set().union(*(_asked(part) for part in query[1])) if query != ALL else set()


def _code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


class TrigramIndex:
    """Posting lists of the asked trigrams over a block of texts (lower-cased bytes)."""

    def __init__(self, texts: Sequence[bytes], slots, asked: int):
        """``slots`` numbers the asked trigrams by their code from 1; others are 0."""
        import numpy as np

        self.size = len(texts)
        whole = np.frombuffer(b"\x00\x00".join([*texts, b""]), np.uint8)
        ends = np.cumsum([len(t) + 2 for t in texts])
        found = [np.zeros(0, np.int64)]
        # A long text is coded slice by slice, each with the two bytes that follow it.
        for begin in range(0, len(whole) - 2, BLOCK_BYTES):
            line = whole[begin : begin + BLOCK_BYTES + 2].astype(np.int32)
            slot = slots[(line[:-2] << 16) | (line[1:-1] << 8) | line[2:]]
            at = np.flatnonzero(slot)
            text = np.searchsorted(ends, begin + at, side="right")
            found.append(np.unique(slot[at].astype(np.int64) * self.size + text))
        pairs = np.unique(np.concatenate(found))
        borders = np.searchsorted(pairs, np.arange(1, asked + 2, dtype=np.int64) * self.size)
        self.postings = [pairs[a:b] % self.size for a, b in zip(borders, borders[1:])]

    def matches(self, query: tuple, number: dict[bytes, int]):
        """Positions of the texts that satisfy the query, in order."""
        import numpy as np
        from functools import reduce

        if query == ALL:
            return np.arange(self.size)
        if query[0] == "has":
            return self.postings[number[query[1]] - 1]
        parts = [self.matches(part, number) for part in query[1]]
        if query[0] == "or":
            return reduce(np.union1d, parts)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


def scanner(rules: Sequence[Rule] = RULES):
    """A function that gives for each text of a list its spans (start, place of the rule, end), in order."""
    import re

    import numpy as np

    queries = [trigram_query(rule.pattern, rule.any_case) for rule in rules]
    number = {t: n for n, t in enumerate(sorted(set().union(*map(_asked, queries))), 1)}
    slots = np.zeros(1 << 24, np.uint16)
    for trigram, n in number.items():
        slots[_code(trigram)] = n
    # A run of one character class that must have a least length is searched as such a run: the same
    # maximal runs are found, without a match for each short one.
    forms = []
    for rule in rules:
        run = re.fullmatch(r"(\[[^\]\\^]+\])\+", rule.pattern)
        forms.append(
            re.compile(f"{run[1]}{{{rule.least},}}", re.ASCII | (re.IGNORECASE if rule.any_case else 0))
            if run and rule.least
            else re.compile(rule.linear, re.ASCII)
            if rule.linear
            else rule.compiled()
        )

    def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        octets = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        for begin, end in runs_of([len(o) for o in octets], BLOCK_BYTES):
            index = TrigramIndex(octets[begin:end], slots, len(number))
            for place, (rule, form) in enumerate(zip(rules, forms)):
                for n in index.matches(queries[place], number).tolist():
                    span = "span" if rule.linear else 0
                    for m in form.finditer(texts[begin + n]):
                        if len(m[rule.group]) >= rule.least:
                            found[begin + n].append((m.start(span), place, m.end(span)))
        return [sorted(spans) for spans in found]

    return scan


_SPANS = "spans array<struct<start:int,place:int,kind:string,stop:int>>"


def secret_spans(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All columns of ``docs`` but ``spans``, and ``spans``: what the rules find, by start, then by the rules' order.

    Positions are code points, the end exclusive. NULL and empty texts have no spans. Spans of
    different rules may overlap. Rows are scanned one by one: repeated rows have the same spans.
    """
    small_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c.lower() != "spans"]
    place = columns.index(text)
    kinds = [rule.kind for rule in rules]

    def each(batches):
        import pyarrow as pa

        scan = scanner(rules)
        for batch in batches:
            spans = scan([t or "" for t in batch.column(place).to_pylist()])
            rows = [[{"start": a, "place": p, "kind": kinds[p], "stop": b} for a, p, b in s] for s in spans]
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("stop", pa.int32())])
            )
            yield pa.record_batch([*batch.columns, pa.array(rows, kind)], names=[*columns, "spans"])

    chosen = docs.select(*columns)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields)
    return chosen.mapInArrow(each, schema + _SPANS)


def redact_secrets(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans become one mark.

    No row goes. ``n_chars`` is set to the new length of a changed text where that column exists. NULL stays NULL.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns
    place = columns.index(text)

    def each(batches):
        import pyarrow as pa

        scan = scanner(rules)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for n, spans in enumerate(scan([t or "" for t in texts])):
                if not spans:
                    continue
                parts, done = [], 0
                for start, _, stop in spans:
                    if start >= done:
                        parts += [texts[n][done:start], mark]
                    done = max(done, stop)
                texts[n] = "".join([*parts, texts[n][done:]])
            yield batch.set_column(place, columns[place], pa.array(texts, pa.string()))

    cleaned = docs.mapInArrow(each, docs.schema)
    if "n_chars" not in columns:
        return cleaned
    length = F.when(F.col(text).isNull(), F.col("n_chars")).otherwise(F.length(text))
    return cleaned.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
