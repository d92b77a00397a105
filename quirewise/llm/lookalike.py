"""Visually identical text in one form.

A text is split into words and the rest. A word that plain letters don't write is run through the vocabulary of the corpus, sorted and walked as a
trie, by a weighted edit automaton: look-alike letters, other code points of one symbol, split or joined accents and ignorable characters
cost nothing, letters of nearly the same shape cost one each. Of the words reached at the least cost the most frequent one is the canonical
spelling. Words at a cost are accepted only for a token that mixes scripts, so no spelling of any language has it, and if no other word is as
near. A word that reaches none, and all that isn't a word, is normalized by table.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirewise.llm.scanwords import MappedWords, mapped
from quirewise.storage import cut

# Letters of other scripts beside the Latin letters of the same shape.
CYRILLIC = "АВЕЅІЈКМНОРСТУХӀԌҮаеѕіјорсухһԁԛԝѵӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXIGYaesijopcyxhdqwvl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϳ"
GREEK_AS = "ABEZHIKMNOPTYXoj"
ARMENIAN, ARMENIAN_AS = "ՏՍԼօոսհցզ", "SULonuhgq"
CHEROKEE, CHEROKEE_AS = "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHYGZRWVSLCPKB"
# Letters of nearly the shape of a Latin one.
NEAR = dict(zip("αγεικνορτυχωηкмтпгвнзıɑɡ", "ayeikvoptuxwnkmtnrbhziag"))
NEAR_COST, LETTERS_A_COST = 1, 3
HYPHENS = "‐‑﹣"
IGNORABLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\ufeff"
#: Decompositions that change the look: they are left alone.
DIFFERENT = ("<super>", "<sub>", "<fraction>", "<font>", "<circle>", "<square>")

_LATIN = dict(zip(CYRILLIC + GREEK + ARMENIAN + CHEROKEE, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS + CHEROKEE_AS))
_CYRILLIC_FROM = {b: a for a, b in reversed(list(zip(CYRILLIC, CYRILLIC_AS)))}
_GREEK_FROM = {b: a for a, b in zip(GREEK, GREEK_AS)}
#: Letters by their look, and letters of nearly that look.
_SAME: dict[str, list[str]] = {}
for _letter, _look in _LATIN.items():
    _SAME.setdefault(_look, [_look]).append(_letter)
_NEARLY: dict[str, list[str]] = {}
for _letter, _look in NEAR.items():
    for _a, _b in ((_letter, _look), (_look, _letter)):
        _NEARLY.setdefault(_a, []).append(_b)


@lru_cache(maxsize=None)
def fold(c: str) -> str:
    """What one character looks like: empty for ignorable ones, a space for any kind of space."""
    if c < "\x80":
        return c
    if c in IGNORABLE or "︀" <= c <= "️":
        return ""
    if c in HYPHENS:
        return "-"
    if unicodedata.category(c) == "Zs":
        return " "
    d = unicodedata.decomposition(c)
    if d.startswith(DIFFERENT):
        return c
    if d.startswith("<"):
        return "".join(fold(x) for x in unicodedata.normalize("NFKC", c)) if unicodedata.normalize("NFKC", c) != c else c
    parts = unicodedata.normalize("NFD", c)
    return "".join(_LATIN.get(x, x) for x in parts)


class _Folds(dict):
    def __missing__(self, code: int) -> str:
        self[code] = out = fold(chr(code))
        return out


_FOLDS = _Folds()


def skeleton(text: str) -> str:
    """The look of a text, accents joined again: equal for texts that look the same."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", text.translate(_FOLDS))


def by_table(look: str) -> str:
    """The spelling of a skeleton without a vocabulary: if it has letters of only one other script, look-alikes join that script."""
    if look.isascii():
        return look
    names = {unicodedata.name(c, "").split(" ")[0] for c in look if c.isalpha() and not c.isascii()}
    if "CYRILLIC" in names:
        return "".join(_CYRILLIC_FROM.get(c, c) for c in look)
    if names == {"GREEK"} and len(look) > 1:
        return "".join(_GREEK_FROM.get(c, c) for c in look)
    return look


class Automaton:
    """The words of a vocabulary (decomposed, sorted by code point) reached from a token, with what its characters cost."""

    def __init__(self, words: Sequence[str]):
        self.words = words

    def _narrow(self, start: str, low: int, high: int) -> tuple[int, int] | None:
        a = bisect_left(self.words, start, low, high)
        return (a, bisect_left(self.words, start + "\U0010ffff", a, high)) if a < high and self.words[a].startswith(start) else None

    def reach(self, token: str, most: int = 0) -> dict[str, int]:
        """Words of the vocabulary with their least costs, up to `most`. States are nodes of the trie, ranges of the sorted words."""
        states = {"": (0, 0, len(self.words))}
        for c in unicodedata.normalize("NFD", token):
            for x in unicodedata.normalize("NFD", _FOLDS[ord(c)]):  # ignorable characters have none, ligatures several
                options = [(y, 0) for y in _SAME.get(x, (x,))]
                if most:
                    options += [(z, NEAR_COST) for y in _NEARLY.get(x, ()) for z in _SAME.get(y, (y,))]
                onward: dict[str, tuple[int, int, int]] = {}
                for done, (cost, low, high) in states.items():
                    for y, more in options:
                        if cost + more > most or (done + y in onward and onward[done + y][0] <= cost + more):
                            continue
                        inside = self._narrow(done + y, low, high)
                        if inside:
                            onward[done + y] = (cost + more, *inside)
                states = onward
                if not states:
                    return {}
        return {done: cost for done, (cost, low, _) in states.items() if low < len(self.words) and self.words[low] == done}


@lru_cache(maxsize=100_000)
def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0]


def mixed(token: str) -> bool:
    """Whether a token has letters of several scripts, as no spelling of a language has, also when look-alikes are taken for Latin letters."""
    return len({_script(x) for c in token for x in _FOLDS[ord(c)] if x.isalpha() and _script(x) != "COMBINING"}) > 1


#: Words with anything that isn't a plain letter: from the word's start on, so plain words are passed over at once.
_STRANGE = re.compile(f"(?<![A-Za-z])(?:[A-Za-z]*(?:[^\\W\\d_A-Za-z]|[\u0300-\u036f{IGNORABLE}])+)+[A-Za-z]*")
_WORD = re.compile(f"(?:[^\\W\\d_]|[\u0300-\u036f{IGNORABLE}])+")


class Canonizer:
    """Texts in one form, with a vocabulary of words and their counts."""

    def __init__(self, counts: dict[str, int] | MappedWords, remember: int = 200_000):
        if isinstance(counts, dict):
            counts = {unicodedata.normalize("NFD", w): n for w, n in counts.items()}
        self.counts, self.known, self.remember = counts, {}, remember
        self.automaton = Automaton(sorted(counts) if isinstance(counts, dict) else counts.sequence())

    def word(self, word: str) -> str:
        if word.isascii():
            return word
        known = self.known.get(word)
        if known is None:
            if len(self.known) > self.remember:
                self.known.clear()
            self.known[word] = known = self._spelling(word)
        return known

    def _spelling(self, word: str) -> str:
        look = skeleton(word)
        if look.isascii():
            return look  # what plain letters can write is written so
        reached = self.automaton.reach(word)
        if not reached and mixed(word):
            reached = self.automaton.reach(word, len(look) // LETTERS_A_COST * NEAR_COST)
            least = min(reached.values(), default=0)
            reached = {w: n for w, n in reached.items() if n == least}
            if len({skeleton(w) for w in reached}) > 1:
                reached = {}  # unclear
        return unicodedata.normalize("NFC", min((-self.counts.get(w, 0), w) for w in reached)[1]) if reached else by_table(look)

    def text(self, text: str) -> str:
        if text.isascii():
            return text
        out, at = [], 0
        for m in _STRANGE.finditer(text):
            if m.start() > at:
                out.append(skeleton(text[at : m.start()]))
            out.append(self.word(m.group()))
            at = m.end()
        out.append(skeleton(text[at:]))
        return "".join(out)


def _plain(word: str) -> bool:
    """Fit for a vocabulary: one form already, of one script."""
    return word.isascii() or (by_table(skeleton(word)) == word and len({_script(c) for c in word if c.isalpha()}) == 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        kept = {unicodedata.normalize("NFD", w): n for w, n in counts.items() if _plain(w)}
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            if text:
                counts.update(_WORD.findall(text))
        if len(counts) > 300_000:
            yield out()
            counts.clear()
    yield out()


def vocabulary(texts: DataFrame, least: int = 3) -> dict[str, int] | MappedWords:
    """The words of the corpus (column text) of at least `least` occurrences that are in one form and of one script, with their counts over all texts:
    all of them, in files that the tasks map into memory."""
    counted = texts.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return mapped(counted.where(F.col("n") >= least))[0] or {}


FORMS = "field string, record_key string, look1 long, look2 long, form long"


def forms(records: DataFrame, counts: dict[str, int] | MappedWords) -> DataFrame:
    """records (field, record_key, text) -> a 128-bit hash of the canonical text and a 64-bit hash of the text as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonizer = Canonizer(counts)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            texts = batch.column("text").to_pylist()
            looks = [xxhash.xxh3_128_intdigest(canonizer.text(t)) for t in texts]
            columns = [batch.column("field"), batch.column("record_key")]
            columns += [pa.array([signed(x & (1 << 64) - 1) for x in looks], pa.int64()), pa.array([signed(x >> 64) for x in looks], pa.int64())]
            columns.append(pa.array([signed(xxhash.xxh3_64_intdigest(t)) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["field", "record_key", "look1", "look2", "form"])

    return records.where("record_key is not null and text is not null").select("field", "record_key", "text").mapInArrow(run, FORMS)


def canonical(records: DataFrame, counts: dict[str, int] | MappedWords, column: str = "text") -> DataFrame:
    """records with canonical_text; null stays null, an empty text stays empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonizer = Canonizer(counts)
        for batch in batches:
            out = [None if t is None else canonizer.text(t) for t in batch.column(column).to_pylist()]
            yield batch.append_column("canonical_text", pa.array(out, pa.string()))

    kept = records.drop("canonical_text")
    schema = T.StructType([*kept.schema.fields, T.StructField("canonical_text", T.StringType())])
    return kept.mapInArrow(run, schema)


LOOK = ["field", "look1", "look2"]
#: Records of a class that one task joins with the rest of it.
SPLIT = 1_000


def lookalike_classes(records: DataFrame, least: int = 3) -> DataFrame:
    """One row a record (field, record_key) that looks the same as another one of other code points: the class's hash (look1, look2), the hash
    of the record's own form, the class's size and least key (`representative`), and with how many records of other forms it is linked.

    Repeated rows count once; null texts and keys are left out; classes of one form have no rows.
    """
    formed = cut(forms(records, vocabulary(records, least)).distinct(), "forms")
    several = formed.groupBy(*LOOK).agg(F.min("form").alias("a"), F.max("form").alias("b"), F.count("*").alias("size"), F.min("record_key").alias("representative")).where("a <> b")
    kept = cut(formed.join(several.drop("a", "b"), LOOK), "several")
    same = kept.groupBy(*LOOK, "form").agg(F.count("*").alias("same"))
    return kept.join(same, [*LOOK, "form"]).select("field", "record_key", "look1", "look2", "form", "size", "representative", (F.col("size") - F.col("same")).alias("links"))


def lookalike_pairs(records: DataFrame, least: int = 3) -> DataFrame:
    """(field, left_key, right_key): records of one field that look the same and differ in code points, from `lookalike_classes`.

    Copies of one form make no pairs. A class is split by its size: each part of the left records meets all right ones, so no task
    has more than SPLIT of a class's left records.
    """
    kept = cut(lookalike_classes(records, least), "classes")
    parts = F.ceil(F.col("size") / SPLIT).cast("int")
    left = kept.select(*LOOK, F.col("record_key").alias("left_key"), F.col("form").alias("left_form"), F.pmod(F.hash("record_key"), parts).alias("part"))
    right = kept.select(*LOOK, F.col("record_key").alias("right_key"), F.col("form").alias("right_form"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    pairs = left.join(right, [*LOOK, "part"]).where("left_form <> right_form and left_key < right_key")
    return pairs.select("field", "left_key", "right_key").distinct()
