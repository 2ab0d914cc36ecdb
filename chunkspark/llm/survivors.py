"""Cheapest edits of a stream of messages, by a Viterbi whose survivors coalesce.

What is left of a conversation shall have the role initials ``(s?(ua)+)?``. Its states are what has been put out so far:

* ``EMPTY`` nothing, ``SYSTEM`` the ``s``, ``USER`` a ``u`` last, ``DONE`` an ``a`` last

Every state's survivor, the cheapest way to it, is a path in one tree of backpointers. A node counts the paths that go on from it.
When a survivor dies, nodes that count nothing go with it; while the root has one path on, all survivors share that
edit, so it is final: it is handed out, and the root moves. So a tree holds the edits in dispute, not the conversation.

Of two ways of equal cost to a state the one whose edits read ASCII-least survives. They are compared from the node
they part at, that is by all of their unresolved edits. That is enough: edits tell the state they lead to, and every row's last letter is
its own, so two ways to one state differ in a letter before either ends, and no later edit changes their order.

A survivor that some other one beats whatever follows is dropped. ``_ahead[y][x]`` bounds what going on from ``y`` may cost
more than going on from ``x``; when even that leaves ``y`` cheaper, nothing cheapest goes through ``x``. This ends the way that has deleted
everything so far, which else would keep all edits in dispute.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

EMPTY, SYSTEM, USER, DONE = range(4)
#: Where an output initial leads.
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): DONE, (DONE, "u"): USER}
ACCEPTING = (EMPTY, DONE)
#: The role, and its state, that may be inserted or taken up in each state.
TURN = {state: (("user", "assistant")[state == USER], NEXT[state, "a" if state == USER else "u"]) for state in range(4)}


@dataclass(frozen=True)
class Costs:
    """What edits cost; keeping costs nothing. ``truncated`` is added to a truncated row that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if self.insert < 1 or min(self.rerole, self.delete, self.truncated) < 0:
            raise ValueError("costs may not be negative, and an insert not free")


@dataclass(frozen=True)
class Row:
    role: str
    text: str
    #: Blank or a duplicate, so it has to go.
    faulty: bool
    truncated: bool


class Node:
    __slots__ = ("parent", "letter", "role", "row", "paths", "kids", "depth")

    def __init__(self, parent: Node | None, letter: str, role: str | None, row: Row | None):
        self.parent, self.letter, self.role, self.row = parent, letter, role, row
        #: Children and survivors that end here.
        self.paths, self.kids, self.depth = 0, set(), 0
        if parent is not None:
            parent.kids.add(self)
            parent.paths += 1
            self.depth = parent.depth + 1

    def release(self) -> None:
        """One path less; a node without any goes, and with it what led to it alone."""
        node = self
        node.paths -= 1
        while not node.paths and node.parent is not None:
            node.parent.kids.discard(node)
            node.parent.paths -= 1
            node = node.parent


def before(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` read less than those up to ``b``, from where they part."""
    one, two = [], []
    while a is not b:
        if a.depth >= b.depth:
            one.append(a.letter)
            a = a.parent
        else:
            two.append(b.letter)
            b = b.parent
    return one[::-1] < two[::-1]


class Repair:
    """Edits of one conversation: ``push`` rows in order, then ``finish``; both hand out what is final."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.root = Node(None, "", None, None)
        self.root.paths = 1
        #: state -> (cost, node); each holds a path of its node.
        self.survivors: dict[int, tuple[int, Node]] = {EMPTY: (0, self.root)}
        c = costs
        self._ahead = {
            DONE: {EMPTY: c.delete, SYSTEM: 0, USER: c.insert},
            USER: {EMPTY: c.insert + c.delete, SYSTEM: c.insert, DONE: c.insert},
            EMPTY: {SYSTEM: 0, USER: c.insert, DONE: 0},
            SYSTEM: {EMPTY: max(2 * c.insert, c.delete), USER: c.insert, DONE: 2 * c.insert},
        }

    def push(self, row: Row) -> Iterator[tuple[str, str | None, Row | None]]:
        """Take a row; yields final edits (letter, role, row): a deleted row has no role, an inserted one no row."""
        self._insert()
        came, self.survivors = self.survivors, {}
        initial, stays = row.role[:1], self.costs.truncated * row.truncated
        for state, (cost, node) in came.items():
            self._offer(state, cost + self.costs.delete, node, "D", None, row)
            if row.faulty:
                continue
            if (state, initial) in NEXT:
                self._offer(NEXT[state, initial], cost + stays, node, "K", row.role, row)
            role, to = TURN[state]
            self._offer(to, cost + self.costs.rerole + stays, node, "R", role, row)
        for _, node in came.values():
            node.release()
        self._drop_beaten()
        yield from self._shared()

    def finish(self) -> Iterator[tuple[str, str | None, Row | None]]:
        """The rest of the cheapest edits; ``cost`` is theirs afterwards."""
        self._insert()
        for state in [s for s in self.survivors if s not in ACCEPTING]:
            self.survivors.pop(state)[1].release()
        (self.cost, best), *others = self.survivors.values()
        for cost, node in others:
            if (cost, before(best, node)) < (self.cost, True):
                best, self.cost, node = node, cost, best
            node.release()
        self.survivors = {DONE: (self.cost, best)}
        yield from self._shared()

    def _offer(self, state: int, cost: int, parent: Node, letter: str, role: str | None, row: Row | None) -> bool:
        """Let a way to ``state`` survive if it is the best so far."""
        known = self.survivors.get(state)
        if known is not None and known[0] < cost:
            return False
        node = Node(parent, letter, role, row)
        node.paths = 1
        if known is not None:
            if known[0] == cost and before(known[1], node):
                node.release()
                return False
            known[1].release()
        self.survivors[state] = (cost, node)
        return True

    def _insert(self) -> None:
        """Rows put in before the next one, as long as that makes a state cheaper."""
        fresh = set(self.survivors)
        while fresh:
            state = min(fresh, key=lambda s: self.survivors[s][0])
            fresh.discard(state)
            cost, node = self.survivors[state]
            role, to = TURN[state]
            if self._offer(to, cost + self.costs.insert, node, "I", role, None):
                fresh.add(to)

    def _drop_beaten(self) -> None:
        for state in list(self.survivors):
            cost = self.survivors[state][0]
            if any(other + self._ahead[by][state] < cost for by, (other, _) in self.survivors.items() if by != state):
                self.survivors.pop(state)[1].release()

    def _shared(self) -> Iterator[tuple[str, str | None, Row | None]]:
        """Move the root along what all survivors share."""
        while self.root.paths == 1 and self.root.kids:
            self.root, = self.root.kids
            self.root.parent = None
            yield self.root.letter, self.root.role, self.root.row
            self.root.row = None

    def held(self) -> int:
        """Edits in dispute."""
        seen, todo = 0, list(self.root.kids)
        while todo:
            node = todo.pop()
            todo += node.kids
            seen += 1
        return seen
