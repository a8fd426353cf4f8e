"""Four-Russians tables of the cheapest conversation repair: normalised cost vectors through blocks of symbols.

Edits go through four states, by what the repaired conversation ends with: nothing, the system turn, a user turn, an assistant turn. The cost
vector at a place holds, for each state, the cheapest way to repair all that follows. Less its minimum there are few such vectors, so that
each gets a number, and one lookup takes a vector through ``BLOCK`` symbols at once. Vectors run from the end to the start. Tracing starts at the front:
blocks are expanded backward into the vectors between their symbols, and of the edits that keep the least cost the ASCII-least letter is taken.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
# A symbol is a role's class, plus 4 for a truncated row; one more stands for rows that have to go.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
MUST_GO = 8
SYMBOLS = 9
STATES = 4
START = 0
DONE = (0, 3)
BLOCK = 4
# The state after a turn of a user, or of an assistant where a user spoke last.
AFTER = (2, 2, 3, 2)
NAME = ("user", "user", "assistant", "user")


def kept(symbol: int, state: int) -> int | None:
    """State after the row is kept, if it may be."""
    role = symbol % 4
    if role == SYSTEM:
        return 1 if state == START else None
    if role == OTHER:
        return None
    return AFTER[state] if (NAME[state] == "assistant") == (role == ASSISTANT) else None


def row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that take a row."""
    edits = [(DELETE, COST[DELETE], state)]
    if symbol != MUST_GO:
        extra = TRUNCATED_COST if symbol >= 4 else 0
        if (to := kept(symbol, state)) is not None:
            edits.append((KEEP, COST[KEEP] + extra, to))
        edits.append((REROLE, COST[REROLE] + extra, AFTER[state]))
    return edits


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs where turns may also be inserted first."""
    costs = list(costs)
    for _ in range(STATES):
        costs = [min(c, COST[INSERT] + costs[AFTER[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs in front of a row from the costs behind it."""
    return _inserted([min(cost + costs[to] for _, cost, to in row_edits(symbol, q)) for q in range(STATES)])


class Tables:
    """All normalised vectors that symbols lead to, numbered from the one at the end (0), and their transitions."""

    def __init__(self, block: int = BLOCK):
        far = 1 << 20
        end = _inserted([0 if q in DONE else far for q in range(STATES)])
        self.vectors, number, step, raised = [end], {end: 0}, [], []
        for vector in self.vectors:
            row, more = [], []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                low = min(costs)
                costs = tuple(c - low for c in costs)
                if costs not in number:
                    number[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append(number[costs])
                more.append(low)
            step.append(row)
            raised.append(more)
        self.block = block
        self.step, self.raised = np.array(step, np.int16), np.array(raised, np.int64)
        # Code of a block: its first symbol counts least. Vectors enter at its last symbol.
        self.block_step = np.arange(len(self.vectors), dtype=np.int16)[:, None]
        self.block_raised = np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(block):
            self.block_raised = (self.raised[:, :, None] + self.block_raised[self.step]).reshape(len(self.vectors), -1)
            self.block_step = self.block_step[self.step].reshape(len(self.vectors), -1)
        # (letters up to the row's own, next state) for the vector behind a row, its symbol and the state in front.
        self.choice = [[[self._choose(v, s, q) for q in range(STATES)] for s in range(SYMBOLS)] for v in self.vectors]
        self.trace_block = lru_cache(maxsize=1 << 17)(self._trace_block)

    def _choose(self, behind: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
        front, letters = _before(behind, symbol), ""
        while True:
            ways = [(letter, to) for letter, cost, to in row_edits(symbol, state) if cost + behind[to] == front[state]]
            if COST[INSERT] + front[AFTER[state]] == front[state]:
                ways.append((INSERT, AFTER[state]))
            letter, state = min(ways)
            letters += letter
            if letter != INSERT:
                return letters, state

    def codes(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """Codes of the whole blocks, and the symbols behind them."""
        whole = len(symbols) // self.block * self.block
        powers = SYMBOLS ** np.arange(self.block)
        return (symbols[:whole].reshape(-1, self.block) @ powers).tolist(), symbols[whole:].tolist()

    def backward(self, symbols: np.ndarray) -> np.ndarray:
        """Number of the vector in front of ``symbols`` for each one that may stand behind."""
        blocks, rest = self.codes(symbols)
        at = np.arange(len(self.vectors))
        for symbol in reversed(rest):
            at = self.step[at, symbol]
        for code in reversed(blocks):
            at = self.block_step[at, code]
        return at

    def _inner(self, behind: int, code: int) -> tuple[list[int], list[int]]:
        """A block's symbols, and the vector behind each of them."""
        symbols = [code // SYMBOLS**k % SYMBOLS for k in range(self.block)]
        after = [behind]
        for symbol in reversed(symbols[1:]):
            after.append(int(self.step[after[-1], symbol]))
        return symbols, after[::-1]

    def _trace_block(self, behind: int, code: int, state: int) -> tuple[str, int]:
        letters = []
        for symbol, after in zip(*self._inner(behind, code)):
            edits, state = self.choice[after][symbol][state]
            letters.append(edits)
        return "".join(letters), state

    def boundaries(self, symbols: np.ndarray, behind: int) -> tuple[list, int, int]:
        """(code or symbol, is a block, vector behind it) in order, the vector in front of all, and what the costs rose by."""
        blocks, rest = self.codes(symbols)
        places, cost = [], 0
        for symbol in reversed(rest):
            places.append((symbol, False, behind))
            behind, cost = int(self.step[behind, symbol]), cost + int(self.raised[behind, symbol])
        for code in reversed(blocks):
            places.append((code, True, behind))
            behind, cost = int(self.block_step[behind, code]), cost + int(self.block_raised[behind, code])
        return places[::-1], behind, cost

    def trace(self, places: list, state: int) -> tuple[str, int]:
        """The edits' letters from ``state`` on, and the state they end in."""
        letters = []
        for code, is_block, behind in places:
            edits, state = self.trace_block(behind, code, state) if is_block else self.choice[behind][code][state]
            letters.append(edits)
        return "".join(letters), state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()
