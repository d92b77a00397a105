"""The words of scanned pages: a vocabulary walked as a trie of readings, and one decoder of a page's stream of tokens.

The stream runs over the line ends. The cheapest path through it is made of steps: one token alone, as it is or misread; several tokens
written anew by known words, with spaces lost, spaces too many and confusions; a word broken at a line's end joined to the part it goes on with, as one
word or as a compound that keeps its hyphen. What the path says of each token gives both the marks of a page and its text.
"""

from __future__ import annotations

import atexit
import math
import mmap
import re
import shutil
import tempfile
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, zip_longest
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.storage import cut

# What a scan may show, and the characters it may stand for.
CONFUSIONS = {
    "0": "o O", "1": "l i I t", "5": "s S", "@": "a", "!": "i l I", "|": "l I i", "8": "B", "6": "b G", "9": "g q", "3": "e B", "4": "A", "7": "T",
    "2": "z Z", "$": "s S", "€": "e", "¢": "c", "I": "l i", "l": "I i t", "i": "l", "c": "e", "e": "c", "F": "E", "E": "F", "f": "t", "t": "f", "q": "g", "g": "q",
    "b": "h", "h": "b", "fT": "ff", "ri": "n", "n": "ri", "rn": "m", "m": "rn", "cl": "d", "d": "cl", "ii": "u ü", "li": "h", "vv": "w", "VV": "W",
    "a": "o", "o": "a", "u": "ii", "C": "G E", "G": "C", "O": "Q D", "D": "O", "B": "8 R", "R": "B",
}
PRINTED = {seen: printed.split() for seen, printed in CONFUSIONS.items()}
#: Confusions of characters that words don't have are certain; these, of letters for letters, need a rarer spelling than the word meant.
BREAKS = "-‐‑–­¬"
NEPERS_CONFUSED, NEPERS_SPACE, NEPERS_UNKNOWN = 4.0, 6.0, 14.0
_WORD = re.compile(r"[^\W\d_]+(?:[-‐‑’'][^\W\d_]+)*")
_ENDS = re.compile(rf"[{BREAKS}][ \t]*(?=\n)")
_ID = re.compile(r"[A-Za-z]\d|\d[a-z]|[A-Z]-\d+")


def words_of(text: str) -> list[str]:
    """Whole words for the vocabulary; what is broken over lines is left out."""
    if _ENDS.search(text):
        kept, goes_on = [], False
        for line in text.split("\n"):
            if goes_on and line.strip():
                line = line.split(None, 1)[1] if len(line.split(None, 1)) > 1 else ""
                goes_on = False
            own = line.rstrip(" \t")
            if len(own) > 1 and own[-1] in BREAKS and not own[-2].isspace():
                line, goes_on = own.rsplit(None, 1)[0] if len(own.split(None, 1)) > 1 else "", True
            kept.append(line)
        text = "\n".join(kept)
    text = text.lower()
    return _WORD.findall(text if text.isascii() else text.replace("‐", "-").replace("‑", "-"))


def regular(word: str) -> bool:
    """Lower case, upper case or a capital first: the case patterns print has; parts of a compound count one by one."""
    return all(p.islower() or p.isupper() or (p[:1].isupper() and p[1:].islower()) for p in re.split("[-’']", word) if p)


def _sign(c: str) -> bool:
    """Whether a character is a sign that words don't have."""
    return c in "@!|$€¢" or c.isdigit()


def _most(word: str) -> int:
    """Confusions a word may have and still be taken for a known one: one in four characters, two at least, and every sign that words don't have."""
    return max(2, len(word) // 4) + sum(map(_sign, word))


def _folded(word: str) -> str:
    return word.lower().replace("‐", "-").replace("‑", "-")


#: Words up to which a task reads the files into memory (some 100 MB); beyond, it looks each word up in the mapped files. The answers are the same.
IN_MEMORY = 1_000_000


class MappedWords:
    """The words of files that every task maps into memory, sorted by code point, with their counts: no task holds the vocabulary, however large."""

    def __init__(self, name: str, size: int):
        self.name, self.size, self._open, self._known = name, size, None, None

    def __getstate__(self):
        return {"name": self.name, "size": self.size, "_open": None, "_known": None}

    def _files(self):
        if self._open is None:
            mapped = []
            for x in ("text", "ends", "counts"):
                with open(SparkFiles.get(f"{self.name}.{x}"), "rb") as f:
                    mapped.append(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
            self._open = (mapped[0], memoryview(mapped[1]).cast("q"), memoryview(mapped[2]).cast("q"))
        return self._open

    def sequence(self):
        """The words as a sequence for bisection: a list where they are few, else these files."""
        if self.size > IN_MEMORY:
            return self
        if self._known is None:
            text, ends, counts = self._files()
            words, at = [], 0
            for end in ends:
                words.append(text[at:end].decode())
                at = end
            self._known = (words, dict(zip(words, counts)))
        return self._known[0]

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> str:
        text, ends, _ = self._files()
        return text[(ends[i - 1] if i else 0) : ends[i]].decode()

    def get(self, word: str, default: int = 0) -> int:
        if self.size <= IN_MEMORY:
            self.sequence()
            return self._known[1].get(word, default)
        i = bisect_left(self, word)
        return int(self._files()[2][i]) if i < self.size and self[i] == word else default


@dataclass
class Vocabulary:
    counts: dict[str, int] | MappedWords
    total: int = 0
    longest: int = 0
    _cache: dict = field(default_factory=dict, repr=False)
    most: list[int] = field(default_factory=list)
    _begins: dict = field(default_factory=dict, repr=False)
    _counts: dict = field(default_factory=dict, repr=False)
    _ranges: dict = field(default_factory=dict, repr=False)
    _written: dict = field(default_factory=dict, repr=False)
    _alone: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        mapped = isinstance(self.counts, MappedWords)
        self.total = self.total or max(1, sum(self.counts.values()))
        self.longest = self.longest or max(map(len, self.counts), default=0)
        if not self.most and not mapped:
            self.most = [0] * (self.longest + 2)
            for w, n in self.counts.items():
                self.most[len(w)] = max(self.most[len(w)], n)
        self.most = list(accumulate(reversed(self.most), max))[::-1]
        self._words = None if mapped else sorted(self.counts)

    def __getstate__(self):
        return {k: ({} if k in ("_cache", "_begins", "_counts", "_ranges", "_written", "_alone") else v) for k, v in self.__dict__.items() if k != "_words" or v is None or isinstance(self.counts, dict)}

    @property
    def words(self):
        if self._words is None:
            self._words = self.counts.sequence()
        return self._words

    def count(self, word: str) -> int:
        n = self._counts.get(word)
        if n is None:
            if len(self._counts) > 200_000:
                self._counts.clear()
            n = self._counts[word] = self.counts.get(_folded(word), 0) if regular(word) else 0
        return n

    def nepers(self, word: str) -> float:
        n = self.count(word)
        return math.log(self.total / n) if n else math.inf

    def _range(self, start: str, low: int, high: int) -> tuple[int, int] | None:
        """The words that begin so, of those from low to high; None if there are none."""
        if start in self._ranges:
            return self._ranges[start]
        a = bisect_left(self.words, start, low, high)
        out = (a, bisect_left(self.words, start + "\U0010ffff", a, high)) if a < high and self.words[a].startswith(start) else None
        if len(self._ranges) > 300_000:
            self._ranges.clear()
        self._ranges[start] = out
        return out

    def readings(self, text: str, start: int = 0, beyond: bool = False) -> dict[int, dict[str, int]] | bool:
        """By end: the known words that the scan may show as text[start:end], with the fewest confusions each; or (beyond) only whether
        the text may begin a longer one.

        The sorted words are walked as a trie whose nodes are ranges of them, so only beginnings of known words go on, and none of those is cut.
        How many confusions a word may have grows with its length: see `_most`.
        """
        words, out = self.words, {}
        limits, signs = [], 0
        for i in range(start, len(text)):
            signs += _sign(text[i])
            limits.append(max(2, (i - start + 1) // 4) + signs)
        most = limits[-1] if limits else 0
        # By position: what is read so far, its confusions, its range of words, and it folded.
        states: list[dict[str, tuple[int, int, int, str]]] = [{} for _ in range(len(text) + 1)]
        states[start][""] = (0, 0, len(words), "")
        for i in range(start, len(text)):
            here = states[i]
            if here:
                c, two = text[i], text[i : i + 2]
                options = [(c, i + 1, 0, _folded(c)), *((p, i + 1, 1, _folded(p)) for p in PRINTED.get(c, ()))]
                if len(two) == 2:
                    options += [(p, i + 2, 1, _folded(p)) for p in PRINTED.get(two, ())]
                for done, (n, low, high, fold) in here.items():
                    for p, j, more, shape in options:
                        if n + more > most:
                            continue
                        longer, k = done + p, n + more
                        there = states[j].get(longer)
                        if there is not None:
                            if k < there[0]:
                                states[j][longer] = (k, *there[1:])
                            continue
                        shape = fold + shape
                        inside = self._range(shape, low, high)
                        if inside:
                            states[j][longer] = (k, *inside, shape)
            limit = limits[i - start]
            for done, (n, low, _, fold) in states[i + 1].items():
                if n <= limit and words[low] == fold and self.count(done):
                    out.setdefault(i + 1, {})[done] = n
        if beyond:
            return any(high - low > 1 or words[low] != fold for _, low, high, fold in states[-1].values())
        return out

    def printed(self, word: str) -> list[tuple[str, int]]:
        """Known words that the scan may show as `word`, with the number of confusions, the fewest first."""
        if len(word) > 2 * self.longest:
            return []  # two characters at most stand for one: no known word is that long
        known = self._cache.get(word)
        if known is None:
            found = self.readings(word).get(len(word), {})
            known = sorted(((w, n) for w, n in found.items() if n), key=lambda x: (x[1], -self.count(x[0]), x[0]))
            if len(self._cache) > 100_000:
                self._cache.clear()
            self._cache[word] = known
        return known

    def misread(self, word: str, doubt: float = 0.0) -> str | None:
        """The word printed where the scan shows `word`, or None if it is right or unclear. doubt: nepers by which the engine trusts the token less
        than most; a word that is known itself needs less of a lead of the other one then."""
        own = self.count(word)
        certain = any(c in "@!|$€¢" or c.isdigit() for c in word)
        for meant, n in self.printed(word):
            there = self.count(meant)
            if there >= 2 and (certain or there >= own * 10**n * math.exp(-doubt)):
                return meant
        return None

    def broken(self, left: str, right: str, sign: str) -> list[tuple[float, bool, str, bool]]:
        """The ways to write a word broken at a line's end by `sign`: cost, whether the typesetter broke it, the word, whether it is clear."""
        ways = []
        for word, typeset in ((left + right, True), (f"{left}-{right}", False)):
            if self.count(word):
                ways.append((self.nepers(word), typeset, word, True))
            elif meant := self.misread(word):
                n = min((k for w, k in self.printed(word) if w == meant), default=1)
                ways.append((self.nepers(meant) + NEPERS_CONFUSED * n, typeset, meant, True))
        if not ways and sign in "-‐‑" and self.count(left) and self.count(right):
            ways.append((self.nepers(left) + self.nepers(right) + NEPERS_SPACE, False, f"{left}-{right}", False))
        return ways or [(self.unknown(left + right), True, left + right, False)]

    def alternatives(self, chunk: str, several: bool) -> tuple[float, frozenset[int], tuple[str, ...]] | None:
        """The cheapest way to write a chunk without spaces by known words, spaces left out between them: the cost, the positions of characters that
        differ from the printed ones, the words. None if no words write it; `several`: two words or more."""
        if (chunk, several) in self._written:
            return self._written[chunk, several]
        best: list[tuple[float, tuple[int, ...], tuple[str, ...]]] = [(math.inf, (), ())] * (len(chunk) + 1)
        best[0] = (-NEPERS_SPACE, (), ())
        for i in range(len(chunk)):
            cost, wrong, said = best[i]
            if cost == math.inf:
                continue
            for j, words in self.readings(chunk, i).items():
                if j - i < 2 or (several and j - i == len(chunk)):
                    continue  # a single letter beside a lost space is no evidence
                for w, n in words.items():
                    if n and j - i < 3:
                        continue
                    total = cost + NEPERS_SPACE + self.nepers(w) + NEPERS_CONFUSED * n
                    if total < best[j][0]:
                        best[j] = (total, (*wrong, *self._differs(chunk, i, j, w)) if n else wrong, (*said, w))
        out = (best[-1][0], frozenset(best[-1][1]), best[-1][2]) if best[-1][0] < math.inf else None
        if len(self._written) > 100_000:
            self._written.clear()
        self._written[chunk, several] = out
        return out

    @staticmethod
    def _differs(chunk: str, start: int, end: int, word: str) -> list[int]:
        """Positions of chunk[start:end] whose characters aren't those of the word, by the longest common start and end."""
        shown = chunk[start:end]
        a = 0
        while a < min(len(shown), len(word)) and shown[a] == word[a]:
            a += 1
        b = 0
        while b < min(len(shown), len(word)) - a and shown[-1 - b] == word[-1 - b]:
            b += 1
        return list(range(start + a, max(start + a + 1, end - b)))

    def unknown(self, chunk: str) -> float:
        """The cost of a chunk that no word writes; longer ones cost more, as more confusions are possible in them."""
        return NEPERS_UNKNOWN + math.log(self.total) + NEPERS_CONFUSED * len(chunk) / 8

    def alone(self, word: str, doubt: float = 0.0) -> tuple[float, bool, str]:
        """The cost of a token as one word, whether it is misread, and the word printed."""
        if doubt and not self.count(word):
            doubt = 0.0  # what isn't known itself is misread whenever a known word shows so
        out = self._alone.get((word, doubt))
        if out is None:
            out = self._judged(word, doubt)
            if len(self._alone) > 200_000:
                self._alone.clear()
            self._alone[word, doubt] = out
        return out

    def _judged(self, word: str, doubt: float) -> tuple[float, bool, str]:
        if not _ID.fullmatch(word):
            if meant := self.misread(word, doubt):
                n = min((k for w, k in self.printed(word) if w == meant), default=1)
                return (self.nepers(meant) + NEPERS_CONFUSED * n, True, meant)
            if "-" in word.strip("-") and not self.count(word):
                parts = [(p, len(p) > 1 and any(c.isalpha() for c in p) and self.misread(p, doubt) or p) for p in word.split("-")]
                if any(p != m for p, m in parts):
                    return (math.log(self.total) + NEPERS_CONFUSED, True, "-".join(m for _, m in parts))
        return (min(self.nepers(word), self.unknown(word)), False, word)

    def begins(self, text: str) -> bool:
        """Whether a longer known word begins as the scan may show it here."""
        if text not in self._begins:
            if len(self._begins) > 200_000:
                self._begins.clear()
            self._begins[text] = self.readings(text, beyond=True)
        return self._begins[text]

    def cheapest(self, length: int) -> float:
        """The cost of the most frequent word of at least this length: a lower bound."""
        n = self.most[min(max(length, 0), len(self.most) - 1)] if self.most else 0
        return math.log(self.total / n) if n else math.inf


@dataclass(frozen=True)
class Step:
    """A step of the path: tokens first..last-1, what is printed there, those that show other characters, and the lines whose last word the typesetter broke."""

    first: int
    last: int
    text: str
    wrong: frozenset[int] = frozenset()
    broken: tuple[int, ...] = ()


def core(token: str) -> str:
    """A token without the punctuation around it; signs that stand for letters stay."""
    return token.strip(".,;:()“”‘’\"'?[]«»„…–—")


def _dressed(token: str, word: str) -> str:
    own = core(token)
    return token.replace(own, word, 1) if own else token


#: Nepers of doubt for a token of so much less confidence than an ordinary one.
DOUBT, ORDINARY = 4.0, 0.8


def decode(lines: list[list[str]], vocabulary: Vocabulary, confidence: list[list[float | None]] | None = None) -> list[Step]:
    """The cheapest path through the tokens of a page's lines. confidence: of each token, by line, where the engine gives it."""
    tokens = [t for x in lines for t in x]
    begin = list(accumulate((len(x) for x in lines), initial=0))
    doubts = [0.0] * len(tokens)
    if confidence:
        for k, values in enumerate(confidence):
            if len(values) == len(lines[k]):
                doubts[begin[k] : begin[k + 1]] = [0.0 if v is None else round(max(-1.0, min(1.0, DOUBT * (ORDINARY - v))), 1) for v in values]
    words = [core(t) for t in tokens]
    judged = [len(w) > 1 and any(c.isalpha() for c in w) for w in words]
    free = [w.isalpha() or any(c in "@!|$€¢" or c.isdigit() for c in w) and any(c.isalpha() for c in w) and not _ID.fullmatch(w) for w in words]
    free = [f and all(c.isalnum() or c in "@!|$€¢" for c in w) for f, w in zip(free, words)]
    alone = [vocabulary.alone(w, d) if j else (min(vocabulary.nepers(w), vocabulary.unknown(w)) if f else 0.0, False, w) for w, d, j, f in zip(words, doubts, judged, free)]
    doubtful = [f and (a[1] or not vocabulary.count(w)) for w, a, f in zip(words, alone, free)]
    floor = vocabulary.cheapest(0)
    goes_on = _goes_on(lines, begin)
    best: list[tuple[float, Step | None]] = [(0.0, None)] + [(math.inf, None)] * len(tokens)
    for i, word in enumerate(words):
        if best[i][0] == math.inf:
            continue
        if i in goes_on:
            for cost, step in _broken(i, tokens, lines, begin, goes_on, alone, vocabulary):
                if best[i][0] + cost < best[step.last][0]:
                    best[step.last] = (best[i][0] + cost, step)
            continue
        cost = best[i][0] + alone[i][0]
        if cost < best[i + 1][0]:
            best[i + 1] = (cost, Step(i, i + 1, _dressed(tokens[i], alone[i][2]) if alone[i][1] else tokens[i], frozenset([i]) if alone[i][1] else frozenset()))
        chunk, starts, apart = "", [], 0.0
        for j in range(i, len(words)):
            if not free[j] or j in goes_on or (j > i and (not tokens[j - 1].endswith(words[j - 1]) or not tokens[j].startswith(words[j]))):
                break
            starts.append(len(chunk))
            chunk += words[j]
            apart += alone[j][0]
            # What can't be cheaper than the tokens apart isn't looked at: a space in or out costs NEPERS_SPACE, a word what the most frequent one of
            # its length does; and where every token is a known word, only a confusion makes a difference.
            own = NEPERS_SPACE * (j - i) + (0.0 if any(doubtful[i : j + 1]) else NEPERS_CONFUSED)
            whole = j > i and apart > own + vocabulary.cheapest(len(chunk) - _most(chunk))
            if len(chunk) > 2 and (whole or apart > own + NEPERS_SPACE + 2 * floor):
                known = vocabulary.alternatives(chunk, j == i)
                if known and best[i][0] + known[0] + NEPERS_SPACE * (j - i) < best[j + 1][0]:
                    wrong = frozenset(i + max(k for k, a in enumerate(starts) if a <= at) for at in known[1])
                    lead, tail = tokens[i][: len(tokens[i]) - len(tokens[i].lstrip("(“‘\"'[«„"))], tokens[j][len(tokens[j].rstrip(".,;:)”’\"'?]»…")) :]
                    best[j + 1] = (best[i][0] + known[0] + NEPERS_SPACE * (j - i), Step(i, j + 1, lead + " ".join(known[2]) + tail, wrong))
            # A group goes on while a longer known word can begin with it.
            if j + 1 < len(words) and not (doubtful[j] and j == i) and not doubtful[j + 1] and not vocabulary.begins(chunk):
                break
    out, at = [], len(tokens)
    while at:
        out.append(best[at][1])
        at = out[-1].first
    return out[::-1]


def _goes_on(lines: list[list[str]], begin: list[int]) -> dict[int, list[int]]:
    """Tokens that end their line with a break, and the tokens that may go on with the word: the first of the next line, or of the one after it if
    a short note stands between."""
    out = {}
    for k, x in enumerate(lines[:-1]):
        end = x[-1]
        if len(end) > 1 and end[-1] in BREAKS and (end[-2].isalnum() or end[-2] in "@!|"):
            out[begin[k + 1] - 1] = [begin[k + 1]]
            if k + 2 < len(lines) and len(" ".join(lines[k + 1])) < 12:
                out[begin[k + 1] - 1].append(begin[k + 2])
    return out


def _broken(i: int, tokens: list[str], lines: list[list[str]], begin: list[int], goes_on: dict[int, list[int]], alone: list, vocabulary: Vocabulary) -> Iterator[tuple[float, Step]]:
    """The steps that join the broken token i to where it goes on."""
    line = bisect_left(begin, i + 1) - 1
    left, sign = core(tokens[i][:-1]), tokens[i][-1]
    for n, at in enumerate(goes_on[i]):
        right, more, last = core(tokens[at]), (), at + 1
        if at in goes_on and tokens[at][-1] in BREAKS:  # it is broken again
            onward = goes_on[at][0]
            right, more, last = core(tokens[at][:-1]) + core(tokens[onward]), (bisect_left(begin, at + 1) - 1,), onward + 1
        end = tokens[last - 1]
        between = range(i + 1, at)
        apart = sum(alone[b][0] for b in between)
        # What stands between the parts, and how the last one ends.
        rest = end[len(end.rstrip(".,;:)”’\"'?]»…")) :] + "".join(f" {tokens[b]}" for b in between)
        lead = tokens[i][: len(tokens[i]) - len(tokens[i].lstrip("(“‘\"'[«„"))]
        if not (right[:1].isalnum() or right[:1] in "@!|"):
            ways = [(vocabulary.unknown(left + right), True, left + right, False)]
        else:
            ways = vocabulary.broken(left, right, sign)
        for cost, typeset, word, clear in ways:
            if n and not clear:
                continue
            wrong = frozenset(b for b in between if alone[b][1])
            yield cost + apart, Step(i, last, lead + word + rest, wrong, ((line,) if typeset else ()) + more)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            if text:
                counts.update(words_of(text))
        if len(counts) > 200_000:
            yield out()
            counts.clear()
    yield out()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [w.encode() for w in batch.column("word").to_pylist()]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        counts = np.array(batch.column("n").to_pylist(), dtype=np.int64)
        most = np.zeros(max((len(w) for w in batch.column("word").to_pylist()), default=0) + 2, dtype=np.int64)
        np.maximum.at(most, [len(w) for w in batch.column("word").to_pylist()], counts)
        columns = [pa.array([x], t) for x, t in ((b"".join(raw), pa.binary()), (sizes.tobytes(), pa.binary()), (counts.tobytes(), pa.binary()), (most.tolist(), pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, ["text", "sizes", "counts", "most"])


def mapped(counted: DataFrame) -> tuple[MappedWords | None, int, list[int]]:
    """counted (word, n; distinct words) -> the words in files that the tasks map into memory, the sum of n, and the greatest n by length.

    The driver writes the files a partition at a time, so it holds no more of them than that either. No words: None.
    """
    context = counted.sparkSession.sparkContext
    rows = cut(counted, "words").orderBy("word").mapInArrow(_packed, "text binary, sizes binary, counts binary, most array<long>")
    name, folder = f"words-{uuid.uuid4().hex}", Path(tempfile.mkdtemp(prefix="quirewise-"))
    atexit.register(shutil.rmtree, folder, True)  # the driver serves the files from here as long as it runs
    size, end, total, most = 0, 0, 0, []
    with (folder / f"{name}.text").open("wb") as text, (folder / f"{name}.ends").open("wb") as ends, (folder / f"{name}.counts").open("wb") as counts:
        for r in rows.toLocalIterator():
            sizes = np.frombuffer(r.sizes, dtype=np.int64)
            text.write(r.text)
            ends.write((np.cumsum(sizes) + end).tobytes())
            counts.write(r.counts)
            size, end = size + len(sizes), end + len(r.text)
            total += int(np.frombuffer(r.counts, dtype=np.int64).sum())
            most = [max(a, b) for a, b in zip_longest(most, r.most, fillvalue=0)]
    if size:
        for x in ("text", "ends", "counts"):
            context.addFile(str(folder / f"{name}.{x}"))
    return (MappedWords(name, size) if size else None), total, most


def vocabulary(texts: DataFrame, least: int = 2) -> Vocabulary:
    """All words of at least `least` occurrences with their counts over all texts."""
    counted = texts.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words, total, most = mapped(counted.where(F.col("n") >= least))
    return Vocabulary(words, total, len(most) - 2, most=most) if words else Vocabulary({})
