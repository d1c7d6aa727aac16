"""The piece vocabulary of a byte-fallback BPE model, and which pieces may stand next to each other."""

from __future__ import annotations

import heapq
import re

SPACE = "▁"
#: Characters by which a text's end is matched with the ends of pieces.
TAIL = 3


def model_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with their ids and merge ranks; read from the model file, never trained.

    Rules of the model that the operators rest on, checked when the file is loaded: pairs merge by the
    rank of the joined piece, lowest first, leftmost of equals; no piece has a space mark after
    another character, and none holds two space marks and a letter; a character that is no piece is spelled in bytes."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path(path))
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.text = {i: sp.id_to_piece(i) for i in ids}
        self.ids = {p: i for i, p in self.text.items()}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte)}
        self.size = sp.get_piece_size()
        self.rank = {i: -sp.get_score(i) for i in ids}
        self.longest = max(map(len, self.ids))
        #: Pairs of characters that stand next to each other in some piece: no merge crosses any other pair.
        self.inner = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        assert not any(x[0] != SPACE and x[1] == SPACE for x in self.inner)
        assert not any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids)
        self._all = {c for p in self.ids for c in p}
        self._ends: dict[str, set[int]] = {}
        for p in self.ids:
            self._ends.setdefault(p[-TAIL:], set()).add(len(p))
        self._lengths: dict[str, tuple[int, ...]] = {}
        self.apart: dict[int, bool] = {}
        self._made: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, int], list[tuple[str, float]]] = {}
        self._blank: dict[int, list[int]] = {}

    def _merge(self, tokens: list[int], steps: list | None = None) -> list[int]:
        """Byte-pair merges of ``tokens``, best rank first, leftmost of equals; ``steps`` gets them in turn."""
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a] if a >= 0 else n
            if b < n:
                new = self.ids.get(self.text[tokens[a]] + self.text[tokens[b]])
                if new is not None:
                    heapq.heappush(queue, (self.rank[new], a, tokens[a], tokens[b], new))

        for k in range(n - 1):
            offer(k)
        while queue:
            _, a, x, y, new = heapq.heappop(queue)
            b = after[a] if tokens[a] == x else n
            if b < n and tokens[b] == y:
                tokens[a], tokens[b] = new, -1
                if steps is not None:
                    steps.append((x, y, new))
                after[a] = after[b]
                if after[b] < n:
                    before[after[b]] = a
                offer(before[a])
                offer(a)
        return [t for t in tokens if t >= 0]

    def _halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces of which ``piece`` is merged last; None for a character.

        A piece that merging its characters doesn't give, or that ranks before a half of it, has no
        halves to go by: (-1, -1)."""
        known = self._made.get(piece, 0)
        if known == 0:
            tokens = [self.ids[c] for c in self.text[piece]]
            known = None
            if len(tokens) > 1:
                steps: list[tuple[int, int, int]] = []
                known = (-1, -1)
                if self._merge(tokens, steps) == [piece]:
                    halves = steps[-1][:2]
                    under = [(z, self._halves(z)) for z in halves]
                    if all(h is None or h[0] >= 0 and self.rank[z] < self.rank[piece] for z, h in under):
                        known = halves
            self._made[piece] = known
        return known

    def _edge(self, piece: int, side: int) -> list[tuple[str, float]]:
        """The pieces that in turn stood at one edge of ``piece`` (0 left, 1 right), last first, and when they were made."""
        known = self._edges.get((piece, side))
        if known is None:
            half = self._halves(piece)
            known = [(self.text[piece], -1.0 if half is None else self.rank[piece])]
            if half is not None:
                known = known + self._edge(half[side], side) if half[0] >= 0 else []
            self._edges[piece, side] = known
        return known

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether encoding the two pieces' joined text gives these two pieces; kept in ``apart``.

        Ranks grow from the halves of a piece to the piece, so rank is time. Back in time, whatever
        pair stood at the border must not have merged before one of the two was used up."""
        key = left * self.size + right
        known = self.apart.get(key)
        if known is None:
            one, two = self._edge(left, 1), self._edge(right, 0)
            if one and two:
                known = self._border(one, two)
            else:
                known = self._merge([self.ids[c] for c in self.text[left] + self.text[right]]) == [left, right]
            self.apart[key] = known
        return known

    def _border(self, one: list[tuple[str, float]], two: list[tuple[str, float]]) -> bool:
        i = j = 0
        until_one = until_two = float("inf")
        while True:
            (x, made_x), (y, made_y) = one[i], two[j]
            new = self.ids.get(x + y)
            if new is not None and self.rank[new] < until_one and self.rank[new] <= until_two:
                return False
            if made_x < 0 and made_y < 0:
                return True
            if made_x > made_y:
                i, until_one = i + 1, made_x
            else:
                j, until_two = j + 1, made_y

    def lengths(self, tail: str) -> tuple[int, ...]:
        """Lengths, longest first, that pieces may have that end where ``tail`` (up to ``TAIL`` characters) ends."""
        known = self._lengths.get(tail)
        if known is None:
            found = set().union(*(self._ends.get(tail[k:], ()) for k in range(len(tail))))
            known = self._lengths[tail] = tuple(sorted(found, reverse=True))
        return known

    def blanks(self, n: int) -> list[int]:
        """Pieces of ``n`` space marks with no letter to merge with (these merges come after all others)."""
        if n not in self._blank:
            self._blank[n] = self._merge([self.ids[SPACE]] * n)
        return self._blank[n]

    def segments(self, unit: str) -> list[str]:
        """``unit`` cut only where no piece spans two neighbours: encodings join without change.

        Any such cut will do. A plain word needs none, or one before its last mark; other units are cut wherever they can be."""
        if len(unit) < 64 and self._all.issuperset(unit):
            if unit[-1].isalnum():
                return [unit]
            if len(unit) > 1 and unit[-2].isalnum() and unit[-2:] not in self.inner:
                return [unit[:-1], unit[-1]]
        cuts = [0, *(k for k in range(1, len(unit)) if unit[k - 1:k + 1] not in self.inner), len(unit)]
        return [unit[a:b] for a, b in zip(cuts, cuts[1:])]


#: A unit: a run of space marks with what follows up to the next run. Encodings of units join without change.
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def units(text: str) -> list[str]:
    """Units of a text as the model sees it: one space mark is put in front, spaces become marks."""
    if not text:
        return []
    if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
        return [SPACE + u for u in text.split(" ")]
    return UNIT.findall(SPACE + text.replace(" ", SPACE))
