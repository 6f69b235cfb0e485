"""Secret scans with one deterministic automaton for all rules.

Rule expressions become one nondeterministic automaton over bytes; subset construction and
minimisation turn it into an array of transitions, with bytes grouped into classes. A block of texts is
scanned in one pass, cut into lanes that advance together: each lane starts in the first state, and
lanes whose predecessor ended elsewhere are run again until they fall in with what was recorded, which
takes a few bytes. Texts in which a rule ends somewhere are scanned backwards by the automaton of the
reversed rules, which marks where matches start; from each start the rule's own automaton finds the
longest match.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import arrow_map, blocks

#: A byte that UTF-8 never holds; it stands between texts and takes every state to the first.
BREAK = 255
LANE = 1024


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches (leftmost, longest, not overlapping). A match counts if what follows its
    longest ``head`` has ``least`` bytes or more. ``any_case`` lets ASCII letters match in either case."""

    kind: str
    pattern: str
    least: int = 0
    head: str = ""
    any_case: bool = False


ASSIGN_HEAD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: The base kinds, then further published formats. A short match still uses up its text and is then
#: dropped; every open-ended run can be under way beside every other, so states double with each such rule;
#: runs below 8 can be left out of the pattern of ``hex``, as nothing else can use up a run.
RULES = (
    Rule("assign", ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+", 6, ASSIGN_HEAD, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{8,}", 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


# -- rules to automata ------------------------------------------------------------------------------

class Nfa:
    """States with edges on sets of bytes (256-bit masks) and empty edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int, any_case: bool, backwards: bool) -> int:
        """Append a parsed expression after ``start``; gives its last state."""
        for kind, value in (reversed(list(tree)) if backwards else tree):
            if kind is op.SUBPATTERN:
                start = self.add(value[-1], start, any_case, backwards)
            elif kind is op.BRANCH:
                end = self.state()
                for branch in value[1]:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(branch, first, any_case, backwards)].append(end)
                start = end
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, body = value
                for _ in range(least):
                    start = self.add(body, start, any_case, backwards)
                if most is op.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(body, loop, any_case, backwards)].append(loop)
                    self.empty[loop].append(end)
                    start = end
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.empty[start].append(end)
                        start = self.add(body, start, any_case, backwards)
                    self.empty[start].append(end)
                    start = end
            else:
                end = self.state()
                self.edges[start].append((bytes_of(kind, value, any_case), end))
                start = end
        return start

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def bytes_of(kind, value, any_case: bool) -> int:
    """Mask of the bytes that one item of an expression matches."""
    every = (1 << BREAK) - 1
    if kind is op.LITERAL:
        mask = 1 << value
    elif kind is op.NOT_LITERAL:
        mask = every & ~(1 << value)
    elif kind is op.ANY:
        mask = every & ~(1 << 10)
    elif kind is op.IN:
        mask, negated = 0, False
        for k, v in value:
            if k is op.NEGATE:
                negated = True
            elif k is op.LITERAL:
                mask |= 1 << v
            elif k is op.RANGE:
                mask |= sum(1 << b for b in range(v[0], v[1] + 1))
            else:
                raise ValueError(f"not supported in a rule: {k}")
        mask = every & ~mask if negated else mask
    else:
        raise ValueError(f"not supported in a rule: {kind}")
    if mask >> 128 and kind is not op.NOT_LITERAL and not (kind is op.IN and mask & (1 << 254)):
        raise ValueError("rules name ASCII characters only")
    if any_case:
        for a in range(65, 91):
            if mask & ((1 << a) | (1 << (a + 32))):
                mask |= (1 << a) | (1 << (a + 32))
    return mask


@dataclass
class Dfa:
    """``table[state * width + classes[byte]]`` is the next state times ``width``; state 0 is first.

    ``accepts[state]`` has a bit for each rule; states from ``first_accept`` on accept.
    """

    table: np.ndarray
    classes: np.ndarray
    width: int
    accepts: np.ndarray
    first_accept: int
    dead: int


def build(patterns: list[tuple[str, bool]], *, backwards: bool = False, search: bool = True) -> Dfa:
    """Minimal automaton of all patterns; with ``search`` a match may start anywhere."""
    nfa = Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    if search:
        nfa.edges[start].append(((1 << BREAK) - 1, start))
    for bit, (pattern, any_case) in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        ends[nfa.add(parser.parse(pattern), first, any_case, backwards)] = 1 << bit
    masks = sorted({mask for edges in nfa.edges for mask, _ in edges})
    names: dict[tuple, int] = {}
    classes = np.array([names.setdefault(tuple(mask >> b & 1 for mask in masks), len(names)) for b in range(255)]
                       + [len(names)], np.int64)
    width, sample = len(names) + 1, {}
    for b in range(255):
        sample.setdefault(int(classes[b]), b)
    begin = nfa.closure([start])
    order, table = {begin: 0}, []
    todo = [begin]
    for states in todo:  # grows while it is read
        row = []
        for c in range(width - 1):
            bit = 1 << sample[c]
            to = nfa.closure({t for s in states for mask, t in nfa.edges[s] if mask & bit})
            if to not in order:
                order[to] = len(order)
                todo.append(to)
            row.append(order[to])
        table.append([*row, 0])
    accepts = np.array([sum({ends[s] for s in states if s in ends}) for states in todo], np.int64)
    return minimal(np.array(table), accepts, classes, width)


def minimal(table: np.ndarray, accepts: np.ndarray, classes: np.ndarray, width: int) -> Dfa:
    """Merge states that no text tells apart, by refining the partition by what they accept."""
    part, count = np.unique(accepts, return_inverse=True)[1], 0
    while True:
        _, new = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() + 1 == count:
            break
        part, count = new, int(new.max()) + 1
    _, one = np.unique(part, return_index=True)
    accept = accepts[one]
    rank = np.lexsort((np.arange(count) != part[0], accept != 0))  # the first state first, accepting last
    place = np.empty(count, np.int64)
    place[rank] = np.arange(count)
    if accept[part[0]]:
        raise ValueError("a rule matches the empty text")
    small = place[part[table[one]]][rank]
    stuck = [s for s in range(count) if (small[s, : width - 1] == s).all() and not accept[rank][s]]
    return Dfa((small * width).astype(np.int32).reshape(-1), classes.astype(np.uint8), width, accept[rank],
               int((accept == 0).sum()), stuck[0] if stuck else -1)


def scan(dfa: Dfa, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after whose byte a rule accepts, ascending, and the states there."""
    n = len(data)
    lanes = -(-n // LANE)
    padded = np.full(lanes * LANE, BREAK, np.uint8)
    padded[:n] = data
    steps = np.ascontiguousarray(dfa.classes[padded].reshape(lanes, LANE).T)
    states = np.empty((LANE, lanes), np.int32)
    state = np.zeros(lanes, np.int32)
    for i in range(LANE):
        state = dfa.table[state + steps[i]]
        states[i] = state
    began = np.zeros(lanes, np.int32)
    while True:
        should = np.concatenate([[0], states[-1, :-1]]).astype(np.int32)
        active = np.flatnonzero(should != began)
        if not len(active):
            break
        began = should
        state = should[active]
        for i in range(LANE):
            state = dfa.table[state + steps[i, active]]
            differs = state != states[i, active]
            if not differs.all():
                active, state = active[differs], state[differs]
                if not len(active):
                    break
            states[i, active] = state
    step, lane = np.nonzero(states >= dfa.first_accept * dfa.width)
    at = lane * LANE + step
    order = np.argsort(at)
    return at[order], states[step[order], lane[order]] // dfa.width


def longest(dfa: Dfa, text: bytes, start: int) -> int:
    """End of the longest match from ``start``; ``start`` itself where there is none."""
    state, end = 0, start
    table, classes, width, dead = dfa.table, dfa.classes, dfa.width, dfa.dead * dfa.width
    first = dfa.first_accept * width
    for i in range(start, len(text)):
        state = table[state + classes[text[i]]]
        if state >= first:
            end = i + 1
        elif state == dead:
            break
    return end


class Scanner:
    """The automata of a set of rules; ``parts`` are plain arrays that travel to tasks."""

    def __init__(self, rules: tuple[Rule, ...], parts: dict | None = None) -> None:
        every = [(r.pattern, r.any_case) for r in rules]
        self.rules = rules
        self.parts = parts or {
            "forward": vars(build(every)), "backward": vars(build(every, backwards=True)),
            "own": [vars(build([p], search=False)) for p in every],
            "heads": [vars(build([(r.head, r.any_case)], search=False)) if r.head else None for r in rules]}
        self.forward, self.backward = Dfa(**self.parts["forward"]), Dfa(**self.parts["backward"])
        self.own = [Dfa(**x) for x in self.parts["own"]]
        self.heads = [Dfa(**x) if x else None for x in self.parts["heads"]]

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule number, end) of its matches in bytes, in order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        if not len(ends) or ends[-1] == len(texts):
            return out
        data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
        at, _ = scan(self.forward, data)
        hits = np.unique(np.searchsorted(ends, at, side="right"))
        if not len(hits):
            return out
        chosen = [texts[i] for i in hits]
        back = np.frombuffer(b"\xff".join(chosen), np.uint8)[::-1]
        at, state = scan(self.backward, back)
        starts = len(back) - 1 - at[::-1]
        marks = self.backward.accepts[state[::-1]]
        begins = np.cumsum([0] + [len(t) + 1 for t in chosen])
        for k, i in enumerate(hits):
            a, b = np.searchsorted(starts, begins[k : k + 2])
            for r in range(len(self.rules)):
                own = starts[a:b][(marks[a:b] >> r & 1).astype(bool)] - begins[k]
                out[i] += self._matches(r, chosen[k], own)
            out[i].sort()
        return out

    def _matches(self, r: int, text: bytes, starts: np.ndarray) -> list[tuple[int, int, int]]:
        found, k = [], 0
        while k < len(starts):
            s = int(starts[k])
            e = longest(self.own[r], text, s)
            head = longest(self.heads[r], text, s) if self.heads[r] else s
            if e - head >= self.rules[r].least:
                found.append((s, r, e))
            k = int(np.searchsorted(starts, max(e, s + 1)))
        return found


def characters(text: bytes, offsets: list[int]) -> list[int]:
    """Code points before each byte offset."""
    if text.isascii():
        return offsets
    lead = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return [int(lead[o - 1]) if o else 0 for o in offsets]


def find_secrets(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of all rules in every whole text.

    ``docs`` needs ``doc_id`` and ``text``. One row per input row: doc_id, spans (array of kind, start,
    end in code points, end exclusive, by start and then in the order of ``rules``). Per kind, matches
    are leftmost, longest and do not overlap; kinds are independent of each other. Null and empty texts
    have no spans, a null doc_id stays null, repeated rows each give a row, other columns are left out.
    No shuffle; memory is bounded by a block of texts or the longest one.
    """
    plain = [vars(r) for r in rules]
    kinds = [r.kind for r in rules]
    shipped = docs.sparkSession.sparkContext.broadcast(Scanner(tuple(rules)).parts)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        scanner = Scanner(tuple(Rule(**r) for r in plain), shipped.value)
        for batch in batches:
            every = [x or b"" for x in batch["t"].cast(pa.binary()).to_pylist()]
            for a, b in blocks([len(t) for t in every]):
                texts = every[a:b]
                spans = []
                for text, found in zip(texts, scanner.spans(texts)):
                    places = characters(text, [x for s, _, e in found for x in (s, e)])
                    spans.append([
                        {"kind": kinds[r], "start": places[2 * k], "end": places[2 * k + 1]}
                        for k, (_, r, _) in enumerate(found)])
                yield {"doc_id": batch["d"].slice(a, b - a), "spans": spans}

    pairs = docs.select(F.col("doc_id").cast("long").alias("d"), F.col("text").alias("t"))
    return arrow_map(pairs, work, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
