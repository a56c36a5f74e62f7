"""Pairs of words one edit apart, by composing a minimised acceptor with a one-edit transducer and itself.

The acceptor reads what differs: words that share a *key* (all but a stretch of their letters) are
read from an initial state of that key. Its states are right languages, so equal remainders of
different words and keys share them. The composition A o E o A is walked from the initial states of
each key, a level of all keys at a time: first both copies read the same letters, then the
transducer makes its edit, then both read the same letters again to the end. After the edit a pair
of states is entered only if their languages have a word in common; that is found once per pair of
states, however many keys and words lead to it. Every state knows how many words it accepts, so a
path gives the number of its word.

Letters are single bytes here (Latin-1), remainders any bytes of one length per initial state.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from linepareto.llm.common import mix

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEAF = np.uint64(0x243F6A8885A308D3)
_LETTERS = 256


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every item of every row: its row, and its number in that row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


class Acceptor(NamedTuple):
    """States with sorted transitions; state 0 is final and has none."""

    start: np.ndarray  # first transition of each state, one more at the end
    letter: np.ndarray
    target: np.ndarray
    before: np.ndarray  # accepted words that a state has before those of this transition
    code: np.ndarray  # state * 256 + letter, ascending
    roots: np.ndarray  # initial state of each root

    def out(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, transition) of all transitions of `states`."""
        row, at = _ragged(self.start[states + 1] - self.start[states])
        return row, self.start[states][row] + at

    def read(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transition of each state by its letter, and whether there is one."""
        if not len(self.code):
            return np.zeros(len(states), np.int64), np.zeros(len(states), bool)
        wanted = states * _LETTERS + letters
        at = np.minimum(np.searchsorted(self.code, wanted), len(self.code) - 1)
        return at, self.code[at] == wanted


def _tree(root: np.ndarray, rest: list[bytes]):
    """The tree of sorted remainders, level by level: letters, parents (in the level above), and leaves."""
    length = np.fromiter(map(len, rest), np.int64, len(rest))
    begin = np.cumsum(length) - length
    text = np.frombuffer(b"".join(rest) or b"\0", np.uint8)
    active = np.arange(len(rest))
    same = np.r_[False, root[1:] == root[:-1]]  # a row has the node of the row before
    node = np.cumsum(~same) - 1
    levels = []
    n_nodes = int(node[-1]) + 1 if len(rest) else 0
    leaves = [node[length == 0]]
    depth = 0
    while True:
        on = length[active] > depth
        if not on.any():
            return n_nodes, levels, leaves
        # rows of one root have one length, so a row that is still read follows one of its root
        active, same, node = active[on], same[on], node[on]
        letters = text[begin[active] + depth]
        same = same & np.r_[False, letters[1:] == letters[:-1]]
        first = ~same
        parent, node = node[first], np.cumsum(first) - 1
        levels.append((letters[first].astype(np.int64), parent))
        leaves.append(node[length[active] == depth + 1])
        depth += 1


def minimised(root: np.ndarray, rest: list[bytes]) -> Acceptor:
    """The minimal acceptor of `rest`, which is sorted within `root` (0, 1, 2, ...), all of a root equally long.

    States are told apart by a hash of their right language and each is then compared with the one
    that stands for its hash; a collision, should one occur, is settled by another seed.
    """
    n_roots, levels, leaves = _tree(root, rest)
    sizes = [n_roots] + [len(letters) for letters, _ in levels]
    seed = 0
    while True:
        with np.errstate(over="ignore"):
            salt = mix(np.array([seed + 1], np.uint64) * _ODD)[0]
            names = [np.zeros(n, np.uint64) for n in sizes]
            accepted = [np.zeros(n, np.int64) for n in sizes]
            for depth in range(len(levels), -1, -1):
                names[depth][leaves[depth]] = _LEAF
                accepted[depth][leaves[depth]] = 1
                if depth < len(levels):
                    letters, parent = levels[depth]
                    step = mix(names[depth + 1] * _ODD + letters.astype(np.uint64) + salt)
                    np.add.at(names[depth], parent, step)
                    np.add.at(accepted[depth], parent, accepted[depth + 1])
        found = _merge(sizes, levels, leaves, names, accepted)
        if found is not None:
            return found
        seed += 1


def _merge(sizes, levels, leaves, names, accepted) -> Acceptor | None:
    """One state per name; None if two different ones have the same name."""
    base = np.cumsum([0, *sizes])
    name, words = np.concatenate(names), np.concatenate(accepted)
    unique, stands, state = np.unique(np.r_[_LEAF, name], return_index=True, return_inverse=True)
    leaf = state[0]
    state, stands = state[1:], stands - 1  # the leaf's own first entry is no node
    swap = np.arange(len(unique))
    swap[leaf], swap[0] = 0, leaf  # number 0 is the final state
    state, by_state = swap[state], np.empty(len(unique), np.int64)
    by_state[swap] = stands
    letter = np.concatenate([x for x, _ in levels]) if levels else np.zeros(0, np.int64)
    parent = np.concatenate([p + base[d] for d, (_, p) in enumerate(levels)]) if levels else np.zeros(0, np.int64)
    child = np.arange(sizes[0], base[-1])
    n_out = np.bincount(parent, minlength=base[-1])
    order = np.lexsort((letter, parent))
    letter, parent, child = letter[order], parent[order], child[order]
    begin = np.cumsum(n_out) - n_out
    # every node against the node that stands for its state: same letters to the same states, same end
    end = np.zeros(base[-1], bool)
    for depth, nodes in enumerate(leaves):
        end[base[depth] + nodes] = True
    inner = np.flatnonzero(state != 0)
    typical = by_state[state]
    if (n_out[inner] != n_out[typical[inner]]).any() or n_out[state == 0].any() or (end != (state == 0)).any():
        return None
    row, at = _ragged(n_out)
    other = begin[typical[row]] + at
    if (letter != letter[other]).any() or (state[child] != state[child[other]]).any():
        return None
    keep = np.where(np.arange(len(unique)) > 0, by_state, -1)
    own = np.where(keep >= 0, n_out[np.maximum(keep, 0)], 0)
    row, at = _ragged(own)
    taken = begin[keep[row]] + at
    target = state[child[taken]]
    count = words[child[taken]]
    start = np.r_[0, np.cumsum(own)]
    running = np.cumsum(count) - count
    before = running - running[start[row]] if len(row) else running
    return Acceptor(start, letter[taken], target, before, row * _LETTERS + letter[taken], state[:sizes[0]])


class _Paths(NamedTuple):
    """Paths of the composition: states of both copies and the numbers of words before theirs."""

    p: np.ndarray
    q: np.ndarray
    x: np.ndarray
    y: np.ndarray

    def take(self, rows: np.ndarray) -> "_Paths":
        return _Paths(*(column[rows] for column in self))

    def pairs(self) -> np.ndarray:
        return self.p.astype(np.uint64) << np.uint64(32) | self.q.astype(np.uint64)


def _joined(parts: list[_Paths]) -> _Paths:
    return _Paths(*(np.concatenate(columns) for columns in zip(*parts)))


def _same_letter(a: Acceptor, f: _Paths, but: np.ndarray | None = None) -> tuple[np.ndarray, _Paths]:
    """Both copies read one letter, another one than `but`: the row each path comes from, and the paths."""
    p, q, x, y = f
    row, left = a.out(p)
    if but is not None:
        other = a.letter[left] != but[row]
        row, left = row[other], left[other]
    right, there = a.read(q[row], a.letter[left])
    row, left, right = row[there], left[there], right[there]
    return row, _Paths(a.target[left], a.target[right], x[row] + a.before[left], y[row] + a.before[right])


def _replaced(a: Acceptor, f: _Paths) -> _Paths:
    """The copies read two letters, the second one's later in order."""
    p, _, x, y = f
    row, left = a.out(p)
    again, step = _ragged(a.start[p[row] + 1] - left - 1)
    right = left[again] + 1 + step
    row, left = row[again], left[again]
    return _Paths(a.target[left], a.target[right], x[row] + a.before[left], y[row] + a.before[right])


def _inserted(a: Acceptor, f: _Paths) -> tuple[_Paths, np.ndarray]:
    """The second copy alone reads a letter: the paths and that letter."""
    p, q, x, y = f
    row, right = a.out(q)
    return _Paths(p[row], a.target[right], x[row], y[row] + a.before[right]), a.letter[right]


class _Common:
    """Which pairs of states accept a common word; each pair of two states is walked once."""

    def __init__(self, a: Acceptor, wanted: list[np.ndarray]):
        self.pairs, links = np.zeros(0, np.uint64), []
        shared = [np.zeros(0, np.uint64)]  # pairs that lead to one state twice, which shares all with itself
        new = _different(np.unique(np.concatenate(wanted))) if wanted else self.pairs
        while len(new):
            self.pairs = np.union1d(self.pairs, new)
            p, q = (new >> np.uint64(32)).astype(np.int64), (new & np.uint64(0xFFFFFFFF)).astype(np.int64)
            row, read = _same_letter(a, _Paths(p, q, p, q))
            shared.append(new[row[read.p == read.q]])
            row, after = row[read.p != read.q], read.pairs()[read.p != read.q]
            links.append((new[row], after))
            new = np.setdiff1d(after, self.pairs)
        self.common = np.isin(self.pairs, np.concatenate(shared))
        links = [(np.searchsorted(self.pairs, x), np.searchsorted(self.pairs, y)) for x, y in links]
        # pairs found in one turn may lead to pairs of any turn: repeat until nothing changes
        changed = True
        while changed:
            changed = False
            for x, y in reversed(links):
                gain = x[self.common[y] & ~self.common[x]]
                if len(gain):
                    self.common[gain] = changed = True

    def __call__(self, f: _Paths) -> np.ndarray:
        same = f.p == f.q
        if not len(self.pairs):
            return same
        pairs = f.pairs()
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return same | ((self.pairs[at] == pairs) & self.common[at])


def _different(pairs: np.ndarray) -> np.ndarray:
    return pairs[(pairs >> np.uint64(32)) != (pairs & np.uint64(0xFFFFFFFF))]


def one_edit_pairs(root: np.ndarray, rest: list[bytes], shorter: np.ndarray, longer: np.ndarray,
                   to_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (rows) of remainders one edit apart: each pair once.

    `root` numbers the initial states, ascending, and `rest` is sorted within each. Key k has the roots
    `shorter[k]` and `longer[k]` (-1: none), whose remainders are one letter longer. Pairs are two of
    `shorter` with one letter replaced, and one of each with a letter inserted; an inserted letter
    counts at its last possible place, and behind the whole remainder only where `to_end[k]`.
    """
    a = minimised(root, rest)
    n_rows = np.bincount(root, minlength=len(a.roots))
    first = np.cumsum(n_rows) - n_rows
    alone = shorter[n_rows[shorter] > 1]
    both = np.flatnonzero(longer >= 0)
    same = _Paths(a.roots[alone], a.roots[alone], first[alone], first[alone])
    apart = _Paths(a.roots[shorter[both]], a.roots[longer[both]], first[shorter[both]], first[longer[both]])
    end = to_end[both]
    edited, found = [], []
    while len(same.p) or len(apart.p):
        edited.append((_replaced(a, same), None))
        p, q, x, y = apart
        skipped, letter = _inserted(a, apart.take(p != 0))
        edited.append((skipped, letter))
        done = np.flatnonzero((p == 0) & end)  # all read, one letter left
        if len(done):
            row, right = a.out(q[done])
            found.append((x[done][row], y[done][row] + a.before[right]))
        row, same = _same_letter(a, same)
        row, apart = _same_letter(a, apart)
        end = end[row]
    # the letter behind an inserted one is read at once, since it must differ from it
    steps = [f if letter is None else _same_letter(a, f, letter)[1] for f, letter in edited]
    common = _Common(a, [f.pairs() for f in steps])
    paths = _joined([f.take(common(f)) for f in steps]) if steps else same
    while len(paths.p):
        p, q, x, y = paths
        over = p == 0  # equally long from here on: the second copy ends as well
        found.append((x[over], y[over]))
        paths = _same_letter(a, paths.take(~over))[1]
        paths = paths.take(common(paths))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
