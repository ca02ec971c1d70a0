"""Byte-pair merges compiled into a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merges produce. It starts with one
state that has a loop for every byte. Each merge ``(u, v) -> w``, in order, adds one gadget: the
state ``q`` that every u-arc leads to is copied without its v-arc, the u-arcs are led to the copy,
and every state with a u-arc gets a w-arc to where u and then v used to lead. If u and v are the
same the copy loses the u-arc before w-arcs are added, so runs pair up from the left.

All arcs of one label lead to one state, so a state is written down as the label that enters it,
and its outgoing arcs as what was cut off: merge ``(u, v)`` at step k cuts v off the state after u,
and states that later split from that one inherit the cut. An arc that was never added is seen in
the same way: w is added where its left part is, so it is missing where that part was cut before.
:meth:`Automaton.arc` reads an arc off these tables.

The automaton is deterministic and all its states accept, so each prefix of a word has exactly one
path that spells it. :meth:`Automaton.encode` follows the arcs of the longest matching labels first
and goes back where none leads on. No prefix is reached twice, and what spells the whole word is its
path; :meth:`Automaton.decode` emits arc labels.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

NEVER = 1 << 62

#: Arcs remembered after they were read off the tables once.
ARC_MEMORY = 1 << 17


class Automaton:
    """``labels[t]`` are the bytes of token t; merges are pairs of tokens with their product, in order."""

    def __init__(self, labels: dict[int, bytes], merges: Iterable[tuple[int, int, int]]):
        self.labels = labels
        #: For state << 32 | label, the step that cut the label off the state.
        self.cut: dict[int, int] = {}
        letters = [t for t, label in labels.items() if len(label) == 1]
        self.made = dict.fromkeys(letters, -1)
        #: The label's leftmost parts, each with the step that built the next larger one on it: a
        #: part that was cut later did not take that one along.
        self.begins = {t: ((t, NEVER),) for t in letters}
        #: The state (<< 32) and those it split from, each with the step of the split: cuts made
        #: there later were not inherited.
        self.ends = {t: ((t << 32, NEVER),) for t in letters}
        self._arcs: dict[int, bool] = {}
        stated = set(letters)
        for step, (u, v, w) in enumerate(merges):
            if u not in stated or v not in stated or w in stated:
                raise ValueError(f"merge {step} does not join two earlier tokens into a new one")
            stated.add(w)
            if u in self.made and v in self.made:  # a token that no text reaches makes none
                self._add_gadget(step, u, v, w)
        self._compile_labels()

    def _add_gadget(self, step: int, u: int, v: int, w: int) -> None:
        if self._read_arc(u, v):  # otherwise an earlier merge keeps u and v from ever meeting
            self.made[w] = step
            self.begins[w] = ((w, NEVER), (u, step), *self.begins[u][1:])
            self.ends[w] = ((w << 32, NEVER), (v << 32, step), *self.ends[v][1:])
        self.cut[u << 32 | v] = step

    def _compile_labels(self) -> None:
        """The bytes of all reachable labels as one transition table: node and byte to node."""
        self.step: dict[int, int] = {}
        self.emits = [-1]
        for token in self.made:
            node = 0
            for byte in self.labels[token]:
                key = node << 8 | byte
                if key not in self.step:
                    self.step[key] = len(self.emits)
                    self.emits.append(-1)
                node = self.step[key]
            self.emits[node] = token

    def _read_arc(self, entered: int, label: int) -> bool:
        """Whether the state that ``entered`` leads to has an arc of this label."""
        cut = self.cut
        for state, split in self.ends[entered]:
            for part, added in self.begins[label]:
                step = cut.get(state | part)
                if step is not None and step < split and step <= added:
                    return False
        return True

    def arc(self, entered: int, label: int) -> bool:
        key = entered << 32 | label
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) >= ARC_MEMORY:
                self._arcs.clear()
            known = self._arcs[key] = self._read_arc(entered, label)
        return known

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one path that spells the word."""
        size = len(word)
        step, emits, arcs = self.step, self.emits, self._arcs
        path: list[int] = []
        begins: list[int] = []
        untried: list[list[int]] = []  # for each arc of the path, the ends of shorter labels, as node and end in turn
        at, state = 0, -1
        while at < size:
            node, fits = 0, []
            for end in range(at, size):
                node = step.get(node << 8 | word[end])
                if node is None:
                    break
                if emits[node] >= 0:
                    fits += node, end + 1
            while True:
                while not fits:  # no label leads on from here
                    at, fits = begins.pop(), untried.pop()
                    path.pop()
                    state = path[-1] if path else -1
                end = fits.pop()
                label = emits[fits.pop()]
                if state < 0:
                    break
                known = arcs.get(state << 32 | label)
                if known or known is None and self.arc(state, label):
                    break
            path.append(label)
            begins.append(at)
            untried.append(fits)
            at, state = end, label
        return path

    def decode(self, tokens: Sequence[int]) -> bytes:
        return b"".join([self.labels[t] for t in tokens])
