"""Secret scanning with one deterministic automaton for all rules.

Rules are regexes over bytes without anchors, look-around or back-references. They are parsed by the standard
library's regex parser, turned into an NFA, joined into one unanchored DFA by subset construction (a state
accepts a set of rules) and minimised. A scan is one pass over the bytes with one table look-up each.
When a state accepts a rule, a second small automaton, the reversed rule, is read backwards from there to the
leftmost start, but not before the end of that rule's last match; the rule's own DFA is then read forwards
from that start to the longest end. This gives leftmost non-overlapping matches for rules whose first accept
lies in their leftmost match, as is so for a head followed by a run of characters.

The tables are made once on the driver (a few hundred states) and travel in the function. Map-only over whole
texts; null text is empty.
"""

from __future__ import annotations

import hashlib
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches, byte_texts


@dataclass(frozen=True)
class Rule:
    """``keep(match bytes)`` is an exact check on a match; a failing match is consumed but not reported."""

    kind: str
    pattern: str
    keep: Callable[[bytes], bool] = lambda _: True


class _Nfa:
    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, node, start: int, fold: bool, back: bool) -> int:
        """Append one parsed item after ``start``; returns its end."""
        op, arg = node
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY):
            end = self.state()
            self.edges[start].append((_bytes_of(op, arg, fold), end))
            return end
        if op is sre.SUBPATTERN:
            return self.chain(arg[3], start, fold or bool(arg[1] & 2), back)
        if op is sre.BRANCH:
            end = self.state()
            for option in arg[1]:
                self.free[self.chain(option, start, fold, back)].append(end)
            return end
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, item = arg
            for _ in range(low):
                start = self.chain(item, start, fold, back)
            if high is sre.MAXREPEAT:
                hub = self.state()
                self.free[start].append(hub)
                self.free[self.chain(item, hub, fold, back)].append(hub)
                out = self.state()
                self.free[hub].append(out)
                return out
            out = self.state()
            self.free[start].append(out)
            for _ in range(high - low):
                start = self.chain(item, start, fold, back)
                self.free[start].append(out)
            return out
        raise ValueError(f"rules can't use {op}")

    def chain(self, items: Iterable, start: int, fold: bool, back: bool) -> int:
        inner = self.state()  # own entry, so that loops and options don't leak into what stands before
        self.free[start].append(inner)
        for item in reversed(list(items)) if back else items:
            inner = self.add(item, inner, fold, back)
        return inner

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _bytes_of(op, arg, fold: bool) -> frozenset[int]:
    if op is sre.LITERAL:
        own = {arg}
    elif op is sre.NOT_LITERAL:
        own = set(range(256)) - {arg}
    elif op is sre.ANY:
        own = set(range(256)) - {10}
    else:
        own = set()
        negate = arg[0][0] is sre.NEGATE
        for kind, value in arg[1:] if negate else arg:
            if kind is sre.LITERAL:
                own.add(value)
            elif kind is sre.RANGE:
                own.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"rules can't use {kind}")
        if negate:
            own = set(range(256)) - own
    if fold:
        own |= {b ^ 32 for b in own if 65 <= b & 0xDF <= 90 and b < 128}
    if max(own) > 255:
        raise ValueError("rules are over bytes")
    return frozenset(own)


@dataclass(frozen=True)
class Dfa:
    """``rows[state][byte]`` is the next state; state 0 is dead, 1 the start; ``accepts[state]`` are rule numbers."""

    rows: list[list[int]]
    accepts: list[tuple[int, ...]]


def build(rules: list[Rule], anchored: bool, back: bool = False) -> Dfa:
    """Subset construction and minimisation of one automaton for all ``rules``.

    The unanchored one tells first accepts: what a match may go on with after one isn't followed, which
    keeps the sets, and with them the number of states, small.
    """
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for number, rule in enumerate(rules):
        parsed = sre_parser.parse(rule.pattern.encode())
        ends[nfa.chain(parsed, root, False, back)] = number
    first = nfa.closure([root])
    reach = [nfa.closure([s]) for s in range(len(nfa.edges))]
    if not anchored:
        reach = [frozenset(r & ends.keys()) or r for r in reach]
    # bytes that no edge tells apart move alike: one of each class is enough
    labels = list(dict.fromkeys(own for edges in nfa.edges for own, _ in edges))
    classes: dict[tuple[bool, ...], list[int]] = {}
    for b in range(256):
        classes.setdefault(tuple(b in own for own in labels), []).append(b)
    members = list(classes.values())
    of = {own: [i for i, m in enumerate(members) if m[0] in own] for own in labels}
    sets, rows, todo = {frozenset(): 0, first: 1}, [[0] * len(members), []], [first]
    while todo:
        now = todo.pop()
        moves: list[set[int]] = [set() for _ in members]
        for s in now:
            for own, t in nfa.edges[s]:
                for i in of[own]:
                    moves[i].add(t)
        row = []
        for reached in moves:
            target = frozenset().union(*(reach[s] for s in reached), () if anchored else first)
            if target not in sets:
                sets[target] = len(sets)
                rows.append([])
                todo.append(target)
            row.append(sets[target])
        rows[sets[now]] = row
    accepts = [()] * len(sets)
    for group, number in sets.items():
        accepts[number] = tuple(sorted(ends[s] for s in group if s in ends))
    small = _minimal(rows, accepts)
    by_byte = [0] * 256
    for i, m in enumerate(members):
        for b in m:
            by_byte[b] = i
    return Dfa([[row[i] for i in by_byte] for row in small.rows], small.accepts)


def _minimal(rows: list[list[int]], accepts: list[tuple[int, ...]]) -> Dfa:
    """Merge states that no input tells apart (partition refinement by signatures)."""
    names = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    block = [names[a] for a in accepts]
    while True:
        names, new = {}, []
        for s, row in enumerate(rows):
            new.append(names.setdefault((block[s], *(block[t] for t in row)), len(names)))
        if len(names) == len(set(block)):
            break
        block = new
    order = {block[0]: 0}
    for s in range(1, len(rows)):
        order.setdefault(block[s], len(order))
    out, marks = [[]] * len(order), [()] * len(order)
    for s, row in enumerate(rows):
        if not out[order[block[s]]]:
            out[order[block[s]]], marks[order[block[s]]] = [order[block[t]] for t in row], accepts[s]
    start = order[block[1]]
    if start != 1:  # keep the start at 1
        swap = {start: 1, 1: start}
        out[start], out[1], marks[start], marks[1] = out[1], out[start], marks[1], marks[start]
        out = [[swap.get(t, t) for t in row] for row in out]
    return Dfa(out, marks)


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.rules = rules
        combined = build(rules, anchored=False)
        # one flat transition array: bytes become classes of bytes that move alike, states are multiples of
        # the number of classes, accepting ones last
        columns: dict[tuple[int, ...], int] = {}
        self.classes = bytes(columns.setdefault(tuple(row[b] for row in combined.rows), len(columns)) for b in range(256))
        order = sorted(range(len(combined.rows)), key=lambda s: bool(combined.accepts[s]))
        self.width, place = len(columns), {s: i for i, s in enumerate(order)}
        self.flat = [place[combined.rows[s][self.classes.index(c)]] * self.width for s in order for c in range(self.width)]
        self.accepts = [combined.accepts[s] for s in order]
        self.start = place[1] * self.width
        self.hot = sum(not a for a in self.accepts) * self.width
        self.ahead = [build([r], anchored=True) for r in rules]
        self.behind = [build([r], anchored=True, back=True) for r in rules]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule number, start, end) in bytes, kept matches only, by rule and start."""
        flat, hot = self.flat, self.hot
        free_from = [0] * len(self.rules)
        out, state = [], self.start
        for at, byte in enumerate(data.translate(self.classes)):  # the one pass
            state = flat[state + byte]
            if state >= hot:
                for number in self.accepts[state // self.width]:
                    if at >= free_from[number]:
                        span = self._match(number, data, at + 1, free_from[number])
                        if span:
                            free_from[number] = span[1]
                            if self.rules[number].keep(data[span[0] : span[1]]):
                                out.append((number, *span))
        return sorted(out)

    def _match(self, number: int, data: bytes, end: int, floor: int) -> tuple[int, int] | None:
        dfa, state, start = self.behind[number], 1, -1
        for i in range(end - 1, floor - 1, -1):
            state = dfa.rows[state][data[i]]
            if not state:
                break
            if dfa.accepts[state]:
                start = i
        if start < 0:
            return None
        dfa, state, stop = self.ahead[number], 1, -1
        for i in range(start, len(data)):
            state = dfa.rows[state][data[i]]
            if not state:
                break
            if dfa.accepts[state]:
                stop = i + 1
        return start, stop


def _long_value(match: bytes) -> bool:
    """The run of value characters at the end of an assignment has 12 or more; a leading separator isn't one."""
    import re

    found = re.fullmatch(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", match, re.IGNORECASE)
    return found is not None and len(found[1]) >= 12


BASE = ("assign", "access", "hex")
RULES = [
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _long_value),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m) >= 18),
    Rule("hex", r"[0-9a-f]{16}[0-9a-f]*"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", lambda m: len(m) >= 34),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", lambda m: len(m) >= 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", lambda m: len(m) >= 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("basic_url", r"://[A-Za-z0-9._-]+:[^\x00-\x20@/:\x7f-\xff]+@"),
]


def _joined(spans: list[tuple[int, int, int]], rules: list[Rule]) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in spans))


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_<kind> of every rule, base_sha256, spans); offsets are code points, ends exclusive.

    ``base_sha256`` digests the spans of the kinds assign, access and hex alone.
    """
    rules = RULES if rules is None else rules
    scanner = Scanner(rules)
    counts = [f"n_{r.kind}" for r in rules]
    base = {i for i, r in enumerate(rules) if r.kind in BASE}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: dict[str, list] = {c: [] for c in (*counts, "base_sha256", "spans")}
        for data in byte_texts(batch.column(1)):
            spans = scanner.spans(data)
            if spans and not data.isascii():
                cuts = sorted({x for _, a, b in spans for x in (a, b)})
                sizes = [len(data[a:b].decode("utf-8", "surrogatepass")) for a, b in zip([0, *cuts], cuts, strict=False)]
                place = dict(zip(cuts, accumulate(sizes), strict=True))
                spans = [(k, place[a], place[b]) for k, a, b in spans]
            for i, c in enumerate(counts):
                columns[c].append(sum(s[0] == i for s in spans))
            columns["base_sha256"].append(hashlib.sha256(_joined([s for s in spans if s[0] in base], rules).encode()).hexdigest())
            columns["spans"].append(_joined(spans, rules))
        kinds = {c: pa.int64() if c in counts else pa.string() for c in columns}
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kinds[c]) for c, v in columns.items())], names=["doc_id", *columns])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches(run), schema)
