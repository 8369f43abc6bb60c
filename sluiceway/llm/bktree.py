"""A BK-tree over strings under the Levenshtein distance, which is a metric; a check that also knows transpositions narrows what it finds."""

from __future__ import annotations


def masks(a: str) -> dict[str, int]:
    """For each character of ``a`` the bits of its places."""
    out: dict[str, int] = {}
    for i, c in enumerate(a):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distance(a: str, b: str, places: dict[str, int] | None = None) -> int:
    """Insertions, deletions and substitutions between ``a`` and ``b``: a column of the table at a time, as bits of whole numbers. ``places``: ``masks(a)``, if known."""
    if a == b:
        return 0
    n = len(a)
    if not n or not b:
        return max(n, len(b))
    places = masks(a) if places is None else places
    every, last, score = (1 << n) - 1, 1 << (n - 1), n
    up, down = every, 0
    for c in b:
        same = places.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        more, less = down | ~(diagonal | up) & every, up & diagonal
        score += bool(more & last) - bool(less & last)
        more = more << 1 | 1
        up = (less << 1 | ~(diagonal | more)) & every
        down = diagonal & more & every
    return score


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or swap of neighbours, or none, turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(b) - len(a) > 1:
        return False
    if len(b) > len(a):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


class BKTree:
    """Entries by distance from their parent; a search goes only where the triangle inequality lets a match be."""

    def __init__(self, entries: dict[str, list[int]]):
        self.ids = entries
        self.root: tuple[str, dict] | None = None
        for text in sorted(entries):
            self._add(text)

    def _add(self, text: str) -> None:
        if self.root is None:
            self.root = (text, {})
            return
        node = self.root
        while True:
            k = distance(text, node[0])
            if k == 0:
                return
            if k not in node[1]:
                node[1][k] = (text, {})
                return
            node = node[1][k]

    def within(self, text: str, most: int) -> list[tuple[int, str]]:
        """All entries at most ``most`` edits from ``text``, nearest first."""
        own = masks(text)
        found, todo = [], [self.root] if self.root else []
        while todo:
            entry, children = todo.pop()
            k = distance(text, entry, own)
            if k <= most:
                found.append((k, entry))
            todo += [child for at, child in children.items() if k - most <= at <= k + most]
        return sorted(found)
