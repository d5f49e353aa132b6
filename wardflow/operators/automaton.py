"""Many terms at once: an Aho-Corasick automaton whose letters are words.

A table of terms becomes one automaton if it is small enough to be sent to every worker; its
size is measured first. A text is then read once, whatever the number of terms: a word that is
in no term costs one look into a dictionary. Larger tables go through joins
(``wardflow.operators.phrases``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BYTES = 32 << 20  # of all terms' text that are sent to the workers as an automaton

LETTERS = regex.compile(r"(\p{L}+)")


class WordAutomaton:
    """Terms as sequences of words; finds every place where one ends."""

    def __init__(self, terms: Sequence[Sequence[str]]) -> None:
        self.words: dict[str, int] = {}
        self.sizes = [len(t) for t in terms]
        self.next: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for number, term in enumerate(terms):
            state = 0
            for word in term:
                letter = self.words.setdefault(word, len(self.words))
                if letter not in self.next[state]:
                    self.next[state][letter] = len(self.next)
                    self.next.append({})
                    ends.append([])
                state = self.next[state][letter]
            if term:
                ends[state].append(number)
        # By depth: a state falls back to the longest suffix that is a state, and ends its terms too.
        self.back, row = [0] * len(self.next), list(self.next[0].values())
        self.ends: list[tuple[int, ...]] = [tuple(e) for e in ends]
        while row:
            deeper = []
            for state in row:
                for letter, to in self.next[state].items():
                    back = self.back[state]
                    while back and letter not in self.next[back]:
                        back = self.back[back]
                    self.back[to] = self.next[back].get(letter, 0)
                    self.ends[to] += self.ends[self.back[to]]
                    deeper.append(to)
            row = deeper

    def find(self, words: Sequence[str]) -> Iterator[tuple[int, int]]:
        """(place behind the term's last word, number of the term), by place; overlapping ones too."""
        state, last = 0, -1
        letters = list(map(self.words.get, words))
        for at in [i for i, letter in enumerate(letters) if letter is not None]:
            letter = letters[at]
            if at != last + 1:
                state = 0
            last = at
            while state and letter not in self.next[state]:
                state = self.back[state]
            state = self.next[state].get(letter, 0)
            for term in self.ends[state]:
                yield at + 1, term


def small_enough(terms: DataFrame, term: str, most: int | None = None) -> bool:
    """Is the text of all terms within what may be sent to every worker? One aggregation."""
    size = terms.agg(F.sum(F.octet_length(term) + 16)).first()[0] or 0
    return size <= (MAX_BYTES if most is None else most)


def map_texts(docs: DataFrame, text: Column, fn: Callable[[object, str], object], shared: object, out: str,
              kept: Sequence[str], make: Callable[[object], object]) -> DataFrame:
    """The columns ``kept`` and ``out``: ``fn(made, text)`` of every text that is not null, where ``made``
    is ``make(shared)``, built once in each task."""
    sent = docs.sparkSession.sparkContext.broadcast(shared)
    names = [f"_{i}" for i in range(len(kept))]
    schema = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, kept, strict=True)),
                           T.StructField("_out", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make(sent.value)
        for batch in batches:
            found = [None if t is None else fn(made, t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.string())],
                                             names=[*names, "_out"])

    rows = docs.select(*(docs[c].alias(n) for n, c in zip(names, kept, strict=True)), text.alias("_text"))
    return rows.mapInArrow(run, schema).toDF(*kept, out)


# ---- names ----

class NameMask:
    """Masks names in a text: whole words, leftmost first, of those that begin at one place the
    longest; names with one blank between them share a mark."""

    def __init__(self, names: Sequence[str], mark: str) -> None:
        # A name begins and ends with a letter; what is around it does not count. Gaps and words in
        # turn: the automaton takes the words, and where they are found the gaps must be the name's.
        parts = [p[1:-1] for n in names if len(p := LETTERS.split(n)) > 1]
        self.found, self.gaps, self.mark = WordAutomaton([p[::2] for p in parts]), [p[1::2] for p in parts], mark

    def __call__(self, text: str) -> str:
        parts = LETTERS.split(text)  # word i is part 2 i + 1
        longest: dict[int, int] = {}
        for end, term in self.found.find(parts[1::2]):
            begin, gaps = end - self.found.sizes[term], self.gaps[term]
            if not gaps or parts[2 * begin + 2:2 * end - 1:2] == gaps:
                longest[begin] = max(end, longest.get(begin, 0))
        if not longest:
            return text
        out, at, joined = [], 0, False
        for begin in sorted(longest):
            if 2 * begin + 1 < at:
                continue
            gap = parts[at:2 * begin + 1]
            if not joined or gap != [" "]:
                out += [*gap, self.mark]
            at, joined = 2 * longest[begin], True
        return "".join(out + parts[at:])


def mask_with(docs: DataFrame, text: str, names: Sequence[str], mark: str) -> DataFrame:
    """All columns, ``text`` with the names masked; see :class:`NameMask`."""
    if not names:
        return docs
    hidden = [c for c in docs.columns if c != text]
    done = map_texts(docs, docs[text], lambda mask, t: mask(t), (list(names), mark), text, hidden,
                     lambda both: NameMask(*both))
    return done.select(*docs.columns)


# ---- lexicons ----

class TermScores:
    """Label of a folded text: the highest sum of weight times occurrences, overlapping ones
    counted each; ties go to the label with the least place."""

    def __init__(self, terms: Sequence[tuple[str, int, str, int]], default: str) -> None:
        """``terms``: label, place, folded term, weight in units."""
        self.found = WordAutomaton([t[2].split() for t in terms])
        self.terms, self.default = terms, default

    def __call__(self, folded: str) -> str:
        scores: dict[str, int] = {}
        places: dict[str, int] = {}
        for _, term in self.found.find(folded.split(" ")):
            label, place, _, weight = self.terms[term]
            scores[label] = scores.get(label, 0) + weight
            places[label] = min(place, places.get(label, place))
        if not scores:
            return self.default
        best = max(scores, key=lambda label: (scores[label], -places[label]))
        return best if scores[best] > 0 else self.default
