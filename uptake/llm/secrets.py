"""Secret scans by one combined deterministic automaton.

The rules' regular expressions become one nondeterministic automaton over bytes (Thompson),
subset construction makes it deterministic, and partition refinement makes it
minimal. Its transition array is read once over every text: an accepting state tells that some rule's match ends
here. Only for rules that were seen does the rule's own automaton, made in the same way, find where matches begin and end.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from uptake.llm.common import chunks

# ---- regular expressions as small trees ------------------------------------------------


@dataclass(frozen=True)
class Node:
    """kind: bytes (a set), then, either, many (least, most or None)."""

    kind: str
    parts: tuple = ()
    bytes: frozenset = frozenset()
    least: int = 0
    most: int | None = None


def one_of(chars: str) -> Node:
    """A set of ASCII characters; ``a-z`` is a range."""
    out, k = set(), 0
    while k < len(chars):
        if k + 2 < len(chars) and chars[k + 1] == "-":
            out.update(range(ord(chars[k]), ord(chars[k + 2]) + 1))
            k += 3
        else:
            out.add(ord(chars[k]))
            k += 1
    return Node("bytes", bytes=frozenset(out))


def then(*parts: Node) -> Node:
    return Node("then", parts)


def either(*parts: Node) -> Node:
    return Node("either", parts)


def many(part: Node, least: int = 0, most: int | None = None) -> Node:
    return Node("many", (part,), least=least, most=most)


def maybe(part: Node) -> Node:
    return many(part, 0, 1)


def text(word: str, any_case: bool = False) -> Node:
    return then(*[one_of(c.lower() + c.upper() if any_case and c.isalpha() else c) for c in word])


@dataclass(frozen=True)
class Rule:
    """A match is ``head`` and then ``value``. Once found, it is dropped if its value or all of it is too short.

    ``sieve`` is for the combined automaton: what every match to keep contains. It leaves out counts that would multiply its states.
    """

    kind: str
    head: Node
    value: Node
    sieve: Node | None = None
    least_value: int = 0
    least_total: int = 0

    @property
    def whole(self) -> Node:
        return then(self.head, self.value)

    @property
    def sought(self) -> Node:
        return self.sieve or self.whole


_quote = maybe(one_of("\"'"))
_spaces = many(one_of(" "))
_word = "A-Za-z0-9_"
# The base rules, in the order in which spans that start together are listed.
_setting = then(
    either(
        text("password", True), text("passwd", True), text("secret", True), text("token", True),
        then(text("api", True), maybe(text("_")), text("key", True)),
    ),
    _quote, _spaces, one_of(":="), _spaces, _quote,
)
_value = one_of("A-Za-z0-9+/_.=-")
BASE = (
    Rule("assign", _setting, many(_value, 1), then(_setting, _value), least_value=6),
    Rule("access", text("AKIA"), many(one_of("A-Z0-9"), 1), text("AKIA"), least_total=20),
    Rule("hex", then(), many(one_of("0-9a-f"), 1), many(one_of("0-9a-f"), 24), least_total=24),
)
# A private key's body: after a line break (also a written "\\n") lines of any length, maybe after header lines of an encrypted key; on
# the same line only a long run. If an END line comes, all up to it, also between quotes and marks of quoted lines; else the runs alone.
_base64, _blank = one_of("A-Za-z0-9+/"), one_of(" \t")
_break = then(many(one_of(" \t\"',")), either(one_of("\r\n"), text("\\n"), text("\\r")), many(either(one_of(" \t\r\n>#\"',"), text("\\n"), text("\\r"))))
_run = then(many(_base64, 1), many(one_of("=")))
_headers = many(then(_break, many(one_of("A-Za-z0-9-"), 1), text(":"), many(one_of(" -[]-~"))))
_lines = then(_headers, many(then(_break, _run)))
_inline = then(many(then(many(_blank, 1), many(_base64, 16), many(one_of("="))), 1), maybe(then(many(_blank, 1), _run)))
_framed = then(_headers, many(one_of("A-Za-z0-9+/= \t\r\n\\\"',>#")), text("-----END "), many(one_of("A-Z ")), text("PRIVATE KEY-----"))
_body = either(_framed, _lines, _inline)
# Rules beside the base ones.
MORE = (
    Rule("hosting", then(text("gh"), one_of("pousr"), text("_")), many(one_of("A-Za-z0-9"), 36), then(text("gh"), one_of("pousr"), text("_"))),
    Rule("chat", then(text("xox"), one_of("abprs"), text("-")), many(one_of("A-Za-z0-9-"), 20), then(text("xox"), one_of("abprs"), text("-"))),
    Rule(
        "signed",
        then(text("eyJ"), many(one_of(_word + "-"), 8), text(".eyJ"), many(one_of(_word + "-"), 8), text(".")),
        many(one_of(_word + "-"), 8),
        text(".eyJ"),
    ),
    Rule("private", then(text("-----BEGIN "), many(one_of("A-Z ")), text("PRIVATE KEY-----")), _body, text("PRIVATE KEY-----")),
)
RULES = BASE + MORE

# ---- automata ---------------------------------------------------------------------------


@dataclass
class Nfa:
    steps: list[list[tuple[frozenset, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node: Node, at: int) -> int:
        """Adds ``node`` from state ``at`` on; its last state."""
        if node.kind == "bytes":
            end = self.state()
            self.steps[at].append((node.bytes, end))
            return end
        if node.kind == "then":
            for part in node.parts:
                at = self.add(part, at)
            return at
        if node.kind == "either":
            ends, end = [self.add(p, at) for p in node.parts], self.state()
            for e in ends:
                self.free[e].append(end)
            return end
        for _ in range(node.least):
            at = self.add(node.parts[0], at)
        if node.most is None:
            loop = self.state()
            self.free[at].append(loop)
            self.free[self.add(node.parts[0], loop)].append(loop)
            return loop
        end = self.state()
        self.free[at].append(end)
        for _ in range(node.most - node.least):
            at = self.add(node.parts[0], at)
            self.free[at].append(end)
        return end

    def closure(self, states: frozenset) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


@dataclass
class Dfa:
    """``next[state][byte]``; ``marks[state]`` has a bit for each rule accepted there. State 0 is the start; ``dead`` leads nowhere."""

    next: np.ndarray
    marks: np.ndarray
    dead: int


def subsets(nfa: Nfa, start: int, accepts: dict[int, int], anywhere: bool) -> Dfa:
    """Subset construction. ``anywhere``: a match may begin at every byte."""
    first = nfa.closure(frozenset([start]))
    number, rows, marks, todo = {first: 0}, [], [], deque([first])
    while todo:
        states = todo.popleft()
        marks.append(sum({1 << accepts[s] for s in states if s in accepts}))
        targets: list[set] = [set() for _ in range(256)]
        for s in states:
            for chars, other in nfa.steps[s]:
                for b in chars:
                    targets[b].add(other)
        row, known = [], {}
        for found in map(frozenset, targets):
            if found not in known:
                known[found] = nfa.closure(found | {start} if anywhere else found)
                if known[found] not in number:
                    number[known[found]] = len(number)
                    todo.append(known[found])
            row.append(number[known[found]])
        rows.append(row)
    return Dfa(np.array(rows), np.array(marks), number.get(frozenset(), -1))


def minimal(dfa: Dfa) -> Dfa:
    """States that no input tells apart become one, by refining the partition of the accept marks."""
    _, group = np.unique(dfa.marks, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[dfa.next]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    # The start's group becomes state 0.
    names = np.append(group[0], np.setdiff1d(np.arange(group.max() + 1), group[0]))
    rank = np.argsort(names)
    group = rank[group]
    _, one = np.unique(group, return_index=True)
    return Dfa(group[dfa.next[one]], dfa.marks[one], int(group[dfa.dead]) if dfa.dead >= 0 else -1)


@cache
def combined(rules: tuple[Rule, ...] = RULES) -> Dfa:
    """One automaton for all rules, for matches that begin anywhere."""
    nfa = Nfa()
    start = nfa.state()
    accepts = {nfa.add(rule.sought, start_of(nfa, start)): k for k, rule in enumerate(rules)}
    return minimal(subsets(nfa, start, accepts, True))


def start_of(nfa: Nfa, start: int) -> int:
    own = nfa.state()
    nfa.free[start].append(own)
    return own


@cache
def single(rule: Rule) -> tuple[Dfa, Dfa]:
    """The rule's own automaton for a match from a given byte on, and that of its head."""
    out = []
    for node in (rule.whole, rule.head):
        nfa = Nfa()
        start = nfa.state()
        out.append(minimal(subsets(nfa, start, {nfa.add(node, start): 0}, False)))
    return out[0], out[1]


def backwards(node: Node) -> Node:
    """The expression of the same byte strings, each read from its end."""
    return replace(node, parts=tuple(backwards(p) for p in reversed(node.parts)))


@cache
def starts_of(rule: Rule) -> tuple[list[list[int]], list[bool]]:
    """An automaton that reads a text from its end and accepts wherever a match of the rule begins."""
    nfa = Nfa()
    start = nfa.state()
    dfa = minimal(subsets(nfa, start, {nfa.add(backwards(rule.whole), start): 0}, True))
    return _table(dfa), (dfa.marks > 0).tolist()


def _table(dfa: Dfa) -> list[list[int]]:
    return dfa.next.tolist()


#: Bytes that a start may be followed in vain before the rule's starts are found by reading backwards.
PATIENCE = 64


class Scanner:
    """Scans texts for the spans of ``rules``. One is made in each task."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, patience: int = PATIENCE):
        self.rules, self.patience = rules, patience
        whole = combined(rules)
        # Bytes that every state treats alike share a class; the array is states x classes, a state is its row's offset.
        columns, self.classes = np.unique(whole.next, axis=1, return_inverse=True)
        width = 1 << max(1, int(columns.shape[1] - 1).bit_length())
        array = np.zeros((len(columns), width), np.int64)
        array[:, : columns.shape[1]] = columns * width
        # Accepting states come last, so that one comparison finds them.
        order = np.argsort(whole.marks > 0, kind="stable")
        rank = np.argsort(order)
        array = rank[array // width][order] * width
        self.start = int(rank[0]) * width
        self.hot = int((whole.marks == 0).sum()) * width
        self.next = array.ravel().tolist()
        self.marks = {int(rank[s]) * width: int(m) for s, m in enumerate(whole.marks) if m}
        self.translate = bytes(self.classes.ravel().astype(np.uint8).tolist())
        self.own = [tuple((_table(d), set(np.flatnonzero(d.marks).tolist()), d.dead) for d in single(r)) for r in rules]
        self.opens = [np.flatnonzero(single(r)[0].next[0] != single(r)[0].dead).tolist() for r in rules]

    def seen(self, data: bytes) -> int:
        """A bit for each rule of which some match ends in ``data``: one pass, one transition a byte."""
        state, step, hot, found = self.start, self.next, self.hot, 0
        for c in data.translate(self.translate):
            state = step[state + c]
            if state >= hot:
                found |= self.marks[state]
        return found

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        """kind, start, end in bytes: leftmost longest matches of each rule that don't overlap, too short ones dropped."""
        found = self.seen(data)
        out = []
        for k, rule in enumerate(self.rules):
            if found >> k & 1:
                out += [(rule.kind, s, e) for s, e, head in self._matches(k, data) if e - s >= rule.least_total and e - head >= rule.least_value]
        rank = {rule.kind: k for k, rule in enumerate(self.rules)}
        return sorted(out, key=lambda x: (x[1], rank[x[0]]))

    def _matches(self, k: int, data: bytes) -> Iterator[tuple[int, int, int]]:
        """Start, end and head's end of the rule's matches. Flagged bytes may begin a match.

        After a start that led nowhere after many bytes, the automaton that reads backwards leaves flags only where a match does
        begin, so that no text takes quadratic time.
        """
        opens = bytes(self.opens[k])
        flags, sieved = data.translate(bytes(255 * (b in opens) for b in range(256))), False
        at = flags.find(b"\xff")
        while at >= 0:
            end, read = self._longest(*self.own[k][0], data, at, len(data))
            if end > at:
                yield at, end, self._longest(*self.own[k][1], data, at, end - 1)[0] if self.rules[k].least_value else at
            elif read - at > self.patience and not sieved:
                flags, sieved = self._starts(k, data, at), True
            at = flags.find(b"\xff", max(end, at + 1))

    def _starts(self, k: int, data: bytes, first: int) -> bytes:
        """A flag at each byte from ``first`` on at which a match of the rule begins."""
        table, accepts = starts_of(self.rules[k])
        state, flags = 0, bytearray(len(data))
        for at in range(len(data) - 1, first - 1, -1):
            state = table[state][data[at]]
            if accepts[state]:
                flags[at] = 255
        return bytes(flags)

    @staticmethod
    def _longest(table: list[list[int]], accepts: set[int], dead: int, data: bytes, at: int, stop: int) -> tuple[int, int]:
        """The end of the longest match that begins at ``at``, at most ``stop``, or -1 if none; and how far was read."""
        state, end, k = 0, at if 0 in accepts else -1, at
        for k in range(at, stop):
            state = table[state][data[k]]
            if state == dead:
                break
            if state in accepts:
                end = k + 1
        return end, k


@cache
def scanner() -> Scanner:
    return Scanner()


def code_point_spans(value: str) -> list[tuple[str, int, int]]:
    data = value.encode()
    spans = scanner().spans(data)
    if len(data) == len(value) or not spans:
        return spans
    place = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    before = np.append(0, place)
    return [(kind, int(before[s]), int(before[e])) for kind, s, e in spans]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = {r.kind for r in BASE}
    for batch in chunks(batches, "text"):
        found = [code_point_spans(t or "") for t in batch.column("text").to_pylist()]
        counts = [pa.array([sum(x[0] == r.kind for x in spans) for spans in found], pa.int64()) for r in BASE]
        own = [joined([x for x in spans if x[0] in base]) for spans in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), *counts,
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in own], pa.string()),
                pa.array([joined(spans) for spans in found], pa.string()),
            ],
            ["row", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """Every row's secrets: counts of the base kinds, a digest of their spans, and all spans as ``kind:start:end``.

    Positions are code points, ends exclusive. Defined cases: a null text is empty; a null ``doc_id`` stays null; equal
    rows get equal results; spans of different kinds may overlap; other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = f"row {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    texts = docs.selectExpr("doc_id as row", "text")
    return texts.mapInArrow(_scan_rows, kind).withColumnRenamed("row", "doc_id")


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, each secret span of ``text`` replaced by ``[kind]``; spans that overlap become the first one's."""
    place = docs.schema.names.index("text")

    def cleaned(value: str | None) -> str | None:
        out, at = [], 0
        for kind, s, e in code_point_spans(value) if value else []:
            if s >= at:
                out += [value[at:s], f"[{kind}]"]
            at = max(at, e)
        return "".join([*out, value[at:]]) if out else value

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            columns = list(batch.columns)
            columns[place] = pa.array([cleaned(t) for t in columns[place].to_pylist()], columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(rows, StructType(docs.schema.fields))
