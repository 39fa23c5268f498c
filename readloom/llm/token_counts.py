"""Token counts by a finite-state transducer.

The tokenizer (word rule, then BPE) is compiled into a deterministic transducer
over characters, state by state as texts need them. A transition carries the
number of tokens that the character adds: the count of the text with it less
the count without (an added character may join tokens, so it can be below
zero). The sum over a text is then its count, wherever the text ends.

A text is taken in chunks. Where a visible character meets a blank, the rest of
the text no longer depends on the state before. So the map of a chunk from the
state before it to count and state after it is held as ``(lead, count, rest)``:
the text up to the first such place (its effect depends on the state before),
the tokens from there to the last such place, and the text after it, which
names the state at the end. Two maps compose into one by running one's rest and
the other's lead together, which is associative, so the maps of a text are
joined pairwise, as in a parallel prefix scan.

Rows are independent: no shuffle, a lost task is simply run again. A null text
counts as an empty one (0 tokens).
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.shipping import ship
from readloom.llm import merges
from readloom.llm.merges import Matcher, Vocabulary, byte_letters, kind

CHUNK = 1 << 16
LIMIT = 1024
MAX_STATES = 60_000
ROWS_AT_ONCE = 256

RESET = re.compile(r"[!-~](?=[ \n])")
NO_RESET = -1

# The word rule's endings after an apostrophe, by their first letter ("" where one letter is all).
ENDINGS = {"s": "", "t": "", "m": "", "d": "", "r": "e", "v": "e", "l": "l"}


class Node(dict):
    """A state of the transducer; maps a character to ``(next state, tokens added)``.

    ``mode``: L, N, O inside a word of letters, numbers, others; S in a run of
    blanks (``word``: the run without its last character ``held``); "'" after an
    apostrophe that may open an ending, "'r" and so on after its first letter.
    ``word``: the BPE state of the word so far.
    """

    __slots__ = ("of", "mode", "word", "held")

    def __init__(self, of, mode, word, held):
        self.of, self.mode, self.word, self.held = of, mode, word, held

    __hash__ = object.__hash__

    def __missing__(self, ch):
        found = self[ch] = self.of.transition(self, ch)
        return found


class Transducer:
    """Counts tokens; states are compiled when first met, at most ``max_states`` are kept."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = MAX_STATES):
        self.matcher = Matcher(vocabulary, max_states)
        self.max_states = max_states
        self.nodes: dict = {}
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials))) if vocabulary.specials else None
        self.start = Node(self, "", None, "")

    def node(self, mode, word, held="") -> Node:
        key = (mode, id(word), held)
        found = self.nodes.get(key)
        if found is None:
            if len(self.nodes) >= self.max_states:
                for n in self.nodes.values():
                    n.clear()
                self.nodes.clear()
                self.start.clear()
            found = self.nodes[key] = Node(self, mode, word, held)
        return found

    def feed(self, word, text: str):
        """The BPE state after the text, and the tokens it adds."""
        added = 0
        for letter in byte_letters(text):
            word, _, change = word[letter]
            added += change
        return word, added

    def count_word(self, word: str) -> int:
        return self.feed(self.matcher.root, word)[1]

    def fresh(self, ch: str, before: str = ""):
        """State and tokens when a word begins with the character, after a blank that belongs to it or not."""
        cls, root = kind(ch), self.matcher.root
        if cls == "S":
            return self.node("S", root, ch), self.count_word(ch)
        word, added = self.feed(root, before + ch)
        return self.node("'" if ch == "'" and not before else cls, word), added

    def transition(self, at: Node, ch: str):
        mode, cls = at.mode, kind(ch)
        if mode == "S":
            whole, added = self.feed(at.word, at.held)
            if cls == "S":
                return self.node("S", whole, ch), self.feed(whole, ch)[1]
            # the last blank of the run leaves it: it belongs to the next word, or stands alone
            if at.held == " ":
                to, more = self.fresh(ch, " ")
            else:
                to, more = self.fresh(ch)
                more += self.count_word(at.held)
            return to, more - added
        if mode == "'" and ch in ENDINGS:
            if ENDINGS[ch] == "":
                return self.start, self.count_word("'" + ch) - 1
            word, added = self.feed(self.matcher.root, ch)
            return self.node("'" + ch, word), added
        if len(mode) == 2 and ENDINGS[mode[1]] == ch:
            return self.start, self.count_word(mode + ch) - 1 - self.count_word(mode[1])
        if cls == {"'": "O"}.get(mode, "L" if len(mode) == 2 else mode):
            word, added = self.feed(at.word, ch)
            return self.node(cls, word), added
        return self.fresh(ch)

    def run(self, text: str) -> int:
        """The number of tokens of a text, without looking for special strings."""
        state, total = self.start, 0
        for ch in text:
            state, added = state[ch]
            total += added
        return total

    def count(self, text: str) -> int:
        if self.specials is None or not self.specials.search(text):
            return self.run(text)
        return sum(map(self.run, self.specials.split(text))) + len(self.specials.findall(text))

    def chunk_map(self, chunk: str) -> tuple[str, int, str]:
        """``(lead, tokens between, rest)``; tokens ``NO_RESET`` and all text in ``lead`` where no place cuts the chunk."""
        first = RESET.search(chunk)
        if not first:
            return chunk, NO_RESET, ""
        last = first.end()
        size = 256
        while True:  # the last place, looked for from the end
            found = None
            for found in RESET.finditer(chunk, max(first.end(), len(chunk) - size)):
                last = found.end()
            if found or size >= len(chunk):
                break
            size *= 8
        return chunk[:first.end()], self.count(chunk[first.end():last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple[str, int, str]:
        if a[1] == NO_RESET:
            return self._led(a[0], b)
        if b[1] == NO_RESET:
            return self._rest(a, b[0])
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def _led(self, text: str, b: tuple) -> tuple[str, int, str]:
        lead, between, rest = self.chunk_map(text + b[0]) if RESET.search(text[-1:] + b[0][:1]) else (text + b[0], NO_RESET, "")
        if between == NO_RESET:
            return lead, b[1], b[2]
        return (lead, between, rest) if b[1] == NO_RESET else (lead, between + self.count(rest) + b[1], b[2])

    def _rest(self, a: tuple, text: str) -> tuple[str, int, str]:
        if not RESET.search(a[2][-1:] + text[:1]):
            return a[0], a[1], a[2] + text
        return a[0], a[1] + self.count(a[2]), text

    def scan(self, maps: list[tuple]) -> int:
        """Join the maps pairwise, round by round; the whole text's map is then run from the start."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        lead, between, rest = maps[0]
        return self.count(lead) if between == NO_RESET else self.count(lead) + between + self.count(rest)

    def of_text(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk:
            return self.count(text)
        return self.scan([self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)])


def count_tokens(df: DataFrame, vocabulary_path: str, text: str = "text", n_tokens: str = "n_tokens",
                 chunk: int = CHUNK) -> DataFrame:
    """All columns but the text, and ``n_tokens``: the number of tokens of each whole text (null: 0).

    ``vocabulary_path`` (a byte-level BPE file) is read on the driver; ``chunk``
    is the length of a chunk in characters. A column already named like
    ``n_tokens`` is replaced.
    """
    table = df.sparkSession.sparkContext.broadcast(Vocabulary.of_file(vocabulary_path))
    kept = [f for f in df.schema.fields if f.name not in (text, n_tokens)]
    schema = T.StructType([*kept, T.StructField(n_tokens, T.LongType(), False)])
    names = [f.name for f in kept]

    def count(batches):
        transducer = table.value.once(Transducer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                found = pa.array([transducer.of_text(t or "", chunk) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(n)) for n in names), found], [*names, n_tokens])

    return df.mapInArrow(count, schema)


def judged(df: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, bytes of the text, tokens, and whether they exceed ``limit``."""
    sized = df.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(sized, vocabulary_path).withColumn("over_limit", F.col("n_tokens") > limit)


ship(__name__)
ship(merges.__name__)
