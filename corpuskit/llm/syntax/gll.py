"""A generalised LL recogniser with a graph-structured stack, for several dialects of a language at once.

A grammar is written as lines ``name: alternatives`` in EBNF (quotes-free terminals, ``( | )``, ``?``, ``*``, ``+``);
an alternative may be limited to dialects by a leading ``@mask``. Descriptors (slot, stack node, position) carry the
set of dialects that reach them; a descriptor is worked on again only for dialects that are new to it, so all dialects
share one parse. Stack nodes are (nonterminal, position) and shared between all callers; what a node has popped so far
is replayed to callers that come later, which is what makes left recursion and ambiguity harmless.
"""

from __future__ import annotations

import re

_ITEM = re.compile(r"\s*(@\d+|[()|?*+]|[^\s()|?*+]+)")


class Grammar:
    """terminals: symbol -> the one-character kind it stands for. Other names must be rules."""

    def __init__(self, text: str, terminals: dict[str, str], dialects: int):
        self.all = (1 << dialects) - 1
        self.rules: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
        self.terminals = terminals
        self._fresh = 0
        for line in text.strip().splitlines():
            line = line.strip()
            if not line or line.startswith("//"):
                continue
            name, _, body = line.partition(" : ")
            tokens = _ITEM.findall(body)
            alternatives, rest = self._alternatives(tokens, 0)
            assert rest == len(tokens), line
            self.rules[name.strip()] = alternatives
        self._number()
        self._first()

    def _alternatives(self, tokens, at):
        out = []
        while True:
            mask, seq = self.all, []
            if at < len(tokens) and tokens[at][0] == "@" and len(tokens[at]) > 1:
                mask = int(tokens[at][1:])
                at += 1
            while at < len(tokens) and tokens[at] not in ("|", ")"):
                if tokens[at] == "(":
                    inner, at = self._alternatives(tokens, at + 1)
                    at += 1  # the closing parenthesis
                    symbol = self._add(inner)
                else:
                    symbol = tokens[at]
                    at += 1
                while at < len(tokens) and tokens[at] in ("?", "*", "+"):
                    op = tokens[at]
                    at += 1
                    new = f"_{self._fresh}"
                    self._fresh += 1
                    one = [(self.all, ()), (self.all, (symbol,))]
                    # Repetition recurs on the left: one stack node for all of it, so long lists take linear time.
                    self.rules[new] = one if op == "?" else [one[op == "+"], (self.all, (new, symbol))]
                    symbol = new
                seq.append(symbol)
            out.append((mask, tuple(seq)))
            if at < len(tokens) and tokens[at] == "|":
                at += 1
                continue
            return out, at

    def _add(self, alternatives):
        new = f"_{self._fresh}"
        self._fresh += 1
        self.rules[new] = alternatives
        return new

    def _number(self):
        """Slots: every position in every alternative is a number; slot -> what stands there."""
        self.ids = {name: i for i, name in enumerate(self.rules)}
        self.starts: list[list[tuple[int, int]]] = []  # nonterminal -> (mask, first slot)
        self.slots: list = []  # slot -> kind character, or nonterminal number, or None at the end
        for alternatives in self.rules.values():
            own = []
            for mask, seq in alternatives:
                own.append((mask, len(self.slots)))
                for s in seq:
                    if s in self.ids:
                        self.slots.append(self.ids[s])
                    else:
                        self.slots.append(self.terminals[s])
                self.slots.append(None)
            self.starts.append(own)

    def _first(self):
        """Characters with which each alternative can begin; None where it can be empty."""
        first = [set() for _ in self.starts]
        empty = [False] * len(self.starts)

        def of(slot):
            out = set()
            while True:
                s = self.slots[slot]
                if s is None:
                    return out, True
                if isinstance(s, str):
                    out.add(s)
                    return out, False
                out |= first[s]
                if not empty[s]:
                    return out, False
                slot += 1

        changed = True
        while changed:
            changed = False
            for n, own in enumerate(self.starts):
                for _, slot in own:
                    f, e = of(slot)
                    if not f <= first[n] or (e and not empty[n]):
                        first[n] |= f
                        empty[n] |= e
                        changed = True
        # nonterminal -> next character -> alternatives worth trying; those that can be empty are tried always
        self.predict: list[dict[str, list[tuple[int, int]]]] = []
        self.otherwise: list[list[tuple[int, int]]] = []
        for own in self.starts:
            by: dict[str, list[tuple[int, int]]] = {}
            sets = [of(slot) for _, slot in own]
            for c in set().union(*(f for f, _ in sets)):
                by[c] = [alt for alt, (f, e) in zip(own, sets) if e or c in f]
            self.predict.append(by)
            self.otherwise.append([alt for alt, (_, e) in zip(own, sets) if e])

    def recognise(self, text: str, start: str) -> int:
        """The dialects (a bit mask) in which ``start`` derives the whole text of kinds."""
        slots, predict, otherwise = self.slots, self.predict, self.otherwise
        n, result = len(text), 0
        # node (nonterminal, position) -> [callers: (return slot, caller) -> mask, popped: position -> mask, entered mask]
        nodes: dict[tuple[int, int], list] = {}
        seen: dict[tuple[int, tuple, int], int] = {}
        todo: list[tuple[int, tuple, int, int]] = []
        root = (self.ids[start], 0)
        nodes[root] = [{}, {}, self.all]

        def enter(node, mask):
            at = node[1]
            by = predict[node[0]]
            for m, slot in by.get(text[at], otherwise[node[0]]) if at < n else otherwise[node[0]]:
                if m & mask:
                    todo.append((slot, node, at, m & mask))

        enter(root, self.all)
        while todo:
            slot, node, at, mask = todo.pop()
            key = (slot, node, at)
            old = seen.get(key, 0)
            mask &= ~old
            if not mask:
                continue
            seen[key] = old | mask
            while True:
                s = slots[slot]
                if s is None:
                    info = nodes[node]
                    had = info[1].get(at, 0)
                    new = mask & ~had
                    if new:
                        info[1][at] = had | new
                        if node is root or node == root:
                            if at == n:
                                result |= new
                        for (back, caller), m in info[0].items():
                            if m & new:
                                todo.append((back, caller, at, m & new))
                    break
                if isinstance(s, str):
                    if at < n and text[at] == s:
                        slot += 1
                        at += 1
                        continue
                    break
                callee = (s, at)
                info = nodes.get(callee)
                if info is None:
                    info = nodes[callee] = [{}, {}, 0]
                back = (slot + 1, node)
                had = info[0].get(back, 0)
                if mask & ~had:
                    info[0][back] = had | mask
                    for end, m in info[1].items():
                        if m & mask:
                            todo.append((slot + 1, node, end, m & mask))
                fresh = mask & ~info[2]
                if fresh:
                    info[2] |= fresh
                    enter(callee, fresh)
                break
        return result
