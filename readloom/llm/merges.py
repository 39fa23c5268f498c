"""A byte-level BPE vocabulary as facts about single tokens and neighbouring tokens.

Text is handled as *byte letters*: the letter with the number of each byte.
``Vocabulary`` is small (its
size is the file's), is built once on the driver and broadcast; ``Matcher``
grows in a task and is bounded by ``max_states``.
"""

from __future__ import annotations

import bisect
import json
import unicodedata
import weakref

import regex

FAR = float("inf")
MOST_COMPARED = 96


def byte_letters(text: str) -> str:
    return text.encode().decode("latin-1")


def file_letters() -> dict[int, str]:
    """Vocabulary files write a byte as itself where printable, else as the next free letter from U+0100 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return {b if b in shown else next(free): chr(b) for b in range(256)}


class Vocabulary:
    """Tokens, the merge that makes each, and which tokens may stand side by side.

    ``ids``: spelling -> id, only for tokens that encode to themselves.
    ``specials``: strings that are one token wherever they occur.
    """

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], specials: dict[str, int]):
        self.specials = specials
        self.rank = {pair: n for n, pair in enumerate(merges)}
        made: dict[str, tuple[str, str]] = {}
        for pair in merges:
            made.setdefault(pair[0] + pair[1], pair)
        self.made = made
        self.spines: dict[str, tuple[list, list]] = {}
        self.ids = {}
        for token in sorted(ids, key=len):
            if len(token) == 1 or (token in made and self._stable(token)):
                self.ids[token] = ids[token]
        self.sorted = sorted(self.ids)
        self.longer: dict[str, list[str]] = {}
        self.alike = self._alike()
        self.spines.clear()  # filled again in tasks, for the tokens met there
        self.built: dict = {}
        self.bytes_of = {i: t.encode("latin-1") for t, i in ids.items()}
        self.bytes_of.update({i: s.encode() for s, i in specials.items()})

    def once(self, make):
        """What ``make`` builds from this vocabulary, built once per process: a worker's later tasks go on with it.

        It refers to the vocabulary weakly, so that both go as soon as a worker lets the vocabulary go (a
        cycle of that size would wait for the garbage collector, beside what the worker's next tasks need).
        """
        found = self.built.get(make.__name__)
        if found is None:
            found = self.built[make.__name__] = make(weakref.proxy(self))
        return found

    @classmethod
    def of_file(cls, path: str) -> Vocabulary:
        """Read a tokenizer file with a byte-level BPE model."""
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        if whole["model"]["type"] != "BPE" or (whole.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path}: not a byte-level BPE vocabulary")
        letters = file_letters()
        merges = [tuple(t.translate(letters) for t in (m if isinstance(m, list) else m.split(" ")))
                  for m in whole["model"]["merges"]]
        specials = {t["content"]: t["id"] for t in whole["added_tokens"]}
        ids = {t.translate(letters): i for t, i in whole["model"]["vocab"].items() if t not in specials}
        return cls(ids, merges, specials)

    def _edges(self, token: str) -> tuple[list, list]:
        """The pieces that ever stand at the token's right and left end, each with the rank that uses it up."""
        found = self.spines.get(token)
        if found is None:
            sides = []
            for side in (1, 0):
                piece, until, edge = token, FAR, []
                while piece is not None:
                    edge.append((piece, until))
                    pair = self.made.get(piece)
                    until, piece = (self.rank[pair], pair[side]) if pair else (FAR, None)
                sides.append(edge)
            found = self.spines[token] = (sides[0], sides[1])
        return found

    def extending(self, text: str) -> list[str]:
        """The tokens longer than the text that begin with it."""
        found = self.longer.get(text)
        if found is None:
            at, found = bisect.bisect_right(self.sorted, text), []
            while at < len(self.sorted) and self.sorted[at].startswith(text):
                found.append(self.sorted[at])
                at += 1
            self.longer[text] = found
        return found

    def compatible(self, left: str, right: str, but: tuple | None = None) -> bool:
        """Whether the two tokens stay apart when their joined spelling is encoded (or meet by the merge ``but``).

        Until a merge crosses the border, both sides change as if alone; a pair
        meets if its merge comes before either piece is used up. Of two equal
        merges the left one goes first, so the right piece may be used up by
        the same rank, the left one may not.
        """
        rank = self.rank
        ends = self._edges(right)[1]
        for a, a_until in self._edges(left)[0]:
            for b, b_until in ends:
                at = rank.get((a, b))
                if at is not None and at < a_until and at <= b_until and (a, b) != but:
                    return False
        return True

    def _stable(self, token: str) -> bool:
        """Whether the token's spelling encodes to the token: its parts do, and meet by the last merge only."""
        left, right = self.made[token]
        return left in self.ids and right in self.ids and self.compatible(left, right, (left, right))

    def _alike(self) -> dict[str, str]:
        """Token -> the first token that accepts and refuses the same right neighbours."""
        opens = {left for left, _ in self.rank}
        first: dict = {}
        return {t: first.setdefault(tuple(e for e in self._edges(t)[0] if e[0] in opens), t) for t in self.ids}


class State(dict):
    """What the next bytes depend on; maps a byte letter to ``(next state, last token, change of the count)``.

    ``reach``: the longest end of the text that may begin a token yet to come.
    ``lasts`` and ``counts``: for the cuts from before ``reach`` to the end,
    the last token of the text up to the cut and its number of tokens, less
    that of the whole text. Of last tokens with the same effect one stands for
    all; None: whatever begins there and reaches beyond the end fits, "":
    nothing does.
    """

    __slots__ = ("matcher", "reach", "lasts", "counts")

    def __init__(self, matcher, reach, lasts, counts):
        self.matcher, self.reach, self.lasts, self.counts = matcher, reach, lasts, counts

    __hash__ = object.__hash__

    def __missing__(self, letter):
        found = self[letter] = self.matcher.step(self, letter)
        return found


class Matcher:
    """The last token of every prefix, one byte at a time.

    The encoding of a prefix ends in exactly one token: the one that ends the
    prefix and is compatible with the last token of what lies before it. Which
    one depends on a bounded stretch of text, so steps are kept by state; after
    ``max_states`` the table is begun anew (slower, same results).
    """

    def __init__(self, vocabulary: Vocabulary, max_states: int = 100_000):
        self.v, self.max_states = vocabulary, max_states
        self.pairs: dict[tuple[str, str], bool] = {}
        self.roles: dict = {}
        self.lowest: dict = {}
        self.states: dict = {}
        self.root = State(self, "", (None,), (0,))

    def step(self, state: State, letter: str):
        text, lasts = state.reach + letter, state.lasts
        size = len(lasts)
        for start in range(len(text)):
            token = text[start:]
            if token in self.v.ids:
                before = lasts[start]
                if before is None or before and self._fits(before, token):
                    break
        else:
            raise ValueError(f"no token for {letter!r}: the vocabulary lacks a byte")
        change = state.counts[start] + 1
        lasts = [b if b == "" else self._role(b, text[n:]) for n, b in enumerate(lasts)]
        first = next((n for n, b in enumerate(lasts) if b != ""), size)
        lasts = (*lasts[first:], self.v.alike[token])
        counts = (*(c - change if b != "" else 0 for c, b in zip(state.counts[first:], lasts)), 0)
        return self._state(text[first:], lasts, counts), token, change

    def _state(self, reach, lasts, counts) -> State:
        key = (reach, lasts, counts)
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= self.max_states:
                self.clear()
            found = self.states[key] = State(self, reach, lasts, counts)
        return found

    def clear(self) -> None:
        for s in self.states.values():
            s.clear()
        for table in (self.states, self.pairs, self.roles, self.lowest, self.root):
            table.clear()

    def _fits(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.pairs[left, right] = self.v.compatible(left, right)
        return found

    def _role(self, left: str | None, text: str) -> str | None:
        """The token that stands for ``left`` before the tokens that begin with ``text`` and go on."""
        found = self.roles.get((left, text), self)
        if found is self:
            tokens = self.v.extending(text)
            if left is None or not tokens or len(tokens) > MOST_COMPARED:
                found = left if tokens else ""
            else:
                fits = tuple(self._apart(left, t) for t in tokens)
                rest = None if all(fits) else left if any(fits) else ""
                found = self.roles.setdefault((text, fits), rest)
            self.roles[left, text] = found
        return found

    def _apart(self, left: str, right: str) -> bool:
        """``compatible``, from the lowest rank by which ``left`` would take in each piece that opens ``right``."""
        for piece, until in self.v._edges(right)[1]:
            key = (left, piece)
            rank = self.lowest.get(key)
            if rank is None:
                ranks = [(self.v.rank.get((a, piece), FAR), a_until) for a, a_until in self.v._edges(left)[0]]
                rank = self.lowest[key] = min((r for r, a_until in ranks if r < a_until), default=FAR)
            if rank <= until and rank < FAR:
                return False
        return True


# Letters and numbers that the tokenizers library (0.23, Unicode 16) knows beyond those of Unicode 15.1.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEWER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA)]


def kind(ch: str) -> str:
    """L letter, N number, S white space, O other, as the library has them."""
    if SPACE.match(ch):
        return "S"
    found = unicodedata.category(ch)
    if found == "Cn":
        c = ord(ch)
        return next((k for k, runs in (("L", NEWER_LETTERS), ("N", NEWER_NUMBERS)) if any(a <= c <= b for a, b in runs)), "O")
    return found[0] if found[0] in "LN" else "O"


SPACE = regex.compile(r"\s")
