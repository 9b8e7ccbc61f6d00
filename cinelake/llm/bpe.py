"""Byte-pair pieces of a SentencePiece model: which pieces may follow each other.

Encoding merges the best-scored neighbouring symbols first, the leftmost among equals. Parts of a
text that no merge crosses evolve independently, so a sequence of pieces is *the* encoding of its
text exactly if every piece encodes to itself and no merge ever crosses the seam of two
neighbours. Whether a merge crosses a seam depends on those two pieces alone.
"""

from __future__ import annotations

import re
from functools import cache

BLANK = "▁"
NORMAL = 1
BYTE = 6
#: A marked text is cut before runs of blanks and before line feeds: no piece reaches over either.
UNIT = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n[^{BLANK}\n]*")
#: Longer units are computed each time, so that a cache of units has a known size.
CACHED_LENGTH = 64
#: Known pairs of pieces a worker holds.
CACHED_PAIRS = 1_000_000


class _Followers(dict):
    def __init__(self, left: str, vocabulary: Pieces):
        super().__init__()
        self.left, self.vocabulary = left, vocabulary

    def __missing__(self, right: str) -> bool:
        value = self[right] = self.vocabulary.fits(self.left, right)
        return value


class Pieces:
    """The vocabulary of a model, and the test of neighbouring pieces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError("byte-pair models with identity normalisation and a leading blank are supported")
        self.id, self.score, self.byte, self.piece = {}, {}, {}, []
        for number, p in enumerate(proto.pieces):
            self.piece.append(p.piece)
            if p.type == NORMAL:
                if re.search(f"[^{BLANK}]{BLANK}|.\n|\n.", p.piece):
                    raise ValueError("a piece reaches over a blank or a line feed")
                self.id[p.piece] = number
                self.score[p.piece] = p.score
            elif p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = number
            elif p.type == 4:
                raise ValueError("user-defined pieces are not supported")
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        self.longest = max(map(len, self.id))
        self._events: dict[str, tuple | None] = {}
        self._followers: dict[str, dict[str, bool]] = {"": _Followers("", self)}
        lengths: dict[str, set[int]] = {}
        for p in self.id:
            lengths.setdefault(p[-3:], {1, 2}).add(len(p))
        #: Lengths a piece can have that ends in these three characters, longest first.
        self.lengths = {tail: tuple(sorted(s, reverse=True)) for tail, s in lengths.items()}

    def events(self, piece: str) -> tuple | None:
        """Merges that build the piece, as (score, last symbol, first symbol); None if it never results."""
        if piece in self._events:
            return self._events[piece]
        symbols, score, out = list(piece), self.score, []
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            out.append((best, symbols[-1], symbols[0]))
        found = tuple(out) if len(symbols) == 1 else None
        self._events[piece] = found
        return found

    def followers(self, left: str) -> dict[str, bool]:
        """What is known of pieces behind ``left``; a missing one is judged when asked for."""
        row = self._followers.get(left)
        if row is None:
            if sum(map(len, self._followers.values())) >= CACHED_PAIRS:
                self._followers.clear()
            row = self._followers[left] = _Followers(left, self)
        return row

    def fits(self, left: str, right: str) -> bool:
        """Whether the text of both encodes to exactly these two pieces; behind nothing, any piece does."""
        a, b = self.events(left) if left else (), self.events(right)
        if a is None or b is None:
            return False
        if not left:
            return True
        i = j = 0
        end, start = left[-1], right[0]
        while True:
            next_a = a[i][0] if i < len(a) else None
            next_b = b[j][0] if j < len(b) else None
            across = self.score.get(end + start)
            if across is not None and (next_a is None or across > next_a) and (next_b is None or across >= next_b):
                return False
            if next_a is None and next_b is None:
                return True
            if next_b is None or (next_a is not None and next_a >= next_b):
                end = a[i][1]
                i += 1
            else:
                start = b[j][2]
                j += 1


def units(text: str | None) -> list[str]:
    """The text cut where no piece reaches over; ``marked`` gives the form the model sees.

    A unit stands for one blank and its characters, or begins with a line feed and stands for
    itself. The text gets one blank in front.
    """
    if not text:
        return []
    if text[0] == " " or "  " in text or BLANK in text:
        return [u[1:] if u[0] == BLANK else u for u in UNIT.findall(BLANK + text.replace(" ", BLANK))]
    return text.replace("\n", " \n").split(" ") if text[0] != "\n" else ["", *text.replace("\n", " \n").split(" ")[1:]]


def marked(unit: str) -> str:
    return unit if unit[:1] == "\n" else BLANK + unit


@cache
def pieces(path: str) -> Pieces:
    """One vocabulary per process and file."""
    return Pieces(path)
