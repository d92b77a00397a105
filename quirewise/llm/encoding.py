"""Garbled text from wrong character encoding: found, and restored where possible.

For each line with signs of misreading, every chain of misreadings that could have produced it is undone. Each candidate is
compressed with zstandard dictionaries trained per language; the chain of least description length, its own cost included,
is chosen, and the line stays as it is if none is shorter.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.storage import cut

#: Encodings by which UTF-8 is taken to have been misread.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r")
#: Of these, those whose letters make valid sequences by chance: there only two in a row are a sign.
CYRILLIC = ("cp1251", "koi8_r")
#: Misreadings between encodings of one byte a character: (read as, was).
ONE_BYTE = tuple((a, b) for a in ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp866", "koi8_r") for b in ("cp1251", "koi8_r", "cp866") if a != b)
#: Bits of a chain: for naming a step (misread UTF-8 must form valid sequences, which is rare by chance; any bytes are valid
#: in one-byte encodings), and for each stretch it is applied to. Bits of a character the training never saw, and
#: of one that is unseen and brought in by a chain.
UTF8_BITS, BYTE_BITS, STRETCH_BITS, UNSEEN_BITS, STRANGE_BITS = 3.0, 12.0, 1.0, 14.0, 60.0
DEPTH = 3
LOST = "�"
_SEQUENCE = "[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}"
_UTF8 = re.compile(f"(?:{_SEQUENCE})+")


@lru_cache(maxsize=None)
def byte_of(encoding: str) -> dict[int, int]:
    """Characters above ASCII and the byte each was read from. Bytes an encoding leaves open are read as control characters."""
    out = {}
    for b in range(128, 256):
        try:
            out[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            pass
    for b in range(128, 160):
        if b not in out.values():
            out[b] = b
    return out


class _ToBytes(dict):
    """A table for str.translate: what can't be a byte of the encoding becomes a character that is none."""

    def __init__(self, encoding: str):
        super().__init__(byte_of(encoding))

    def __missing__(self, code: int) -> int:
        self[code] = out = code if code < 128 else 0x100
        return out


_TABLES = {e: _ToBytes(e) for e in dict.fromkeys((*READ_AS, *(a for a, _ in ONE_BYTE)))}
#: Characters a misread UTF-8 sequence can begin with, over all encodings, followed by one that can continue it.
_LEADS = {e: [chr(c) for c, b in byte_of(e).items() if 0xC2 <= b <= 0xF4] for e in READ_AS}
_TAILS = {e: [chr(c) for c, b in byte_of(e).items() if 0x80 <= b <= 0xBF] for e in READ_AS}
_class = lambda cs: "[" + "".join(map(re.escape, cs)) + "]"
#: All signs begin above ASCII; that is asked first, as most characters don't.
SIGN = re.compile("(?=[^\x00-\x7f])(?:" + "|".join(dict.fromkeys([*(f"(?:{_class(_LEADS[e])}{_class(_TAILS[e])}){{{1 + (e in CYRILLIC)}}}" for e in READ_AS), "[\x80-\x9f─-▟⌐₧ƒ]", "[À-ÿ]{3}", "[Ѐ-Я]{3}", "[Ѐ-ӿ][¤¦§¨©«¬®°±µ¶·»\xad\xa0ҐЁЄЇҐЈЌЋЂЃЉЊ…†‡‰]", "[¤¦§¨©«¬®°±µ¶\xadҐЄЇЈЌЋЂЃЉЊ][Ѐ-ӿ]"])) + ")")


def undone_utf8(line: str, encoding: str) -> tuple[str, int]:
    """The line with each sequence that is misread UTF-8 decoded, and the number of stretches."""
    raw = line.translate(_TABLES[encoding])
    out, at, n = [], 0, 0
    for m in _UTF8.finditer(raw):
        try:
            good = m.group().encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        if encoding in CYRILLIC and len(good) < 2:
            continue
        out += [line[at : m.start()], good]
        at, n = m.end(), n + 1
    return ("".join(out) + line[at:], n) if n else (line, 0)


_HIGH = re.compile("[^Ā]*[\x80-\xff][^Ā]*")
#: A word of other letters than plain ones, as a text of another alphabet has it.
_WHOLE = re.compile(r"(?<![A-Za-z])[^\x00-\x7f]{3,}(?![A-Za-z])")


def undone_byte(line: str, read_as: str, was: str) -> tuple[str, int]:
    """The line with each stretch that read_as can write, and that has a word without plain letters, read by `was`."""
    raw = line.translate(_TABLES[read_as])
    out, at, n = [], 0, 0
    for m in _HIGH.finditer(raw):
        if not _WHOLE.search(line, m.start(), m.end()):
            continue
        try:
            good = m.group().encode("latin-1").decode(was)
        except (UnicodeDecodeError, UnicodeEncodeError):
            continue
        out += [line[at : m.start()], good]
        at, n = m.end(), n + 1
    return ("".join(out) + line[at:], n) if n else (line, 0)


@dataclass
class Model:
    """Dictionaries by language, the bits of characters above ASCII by their share of the training lines, and the bits of two characters
    of a right line standing side by side by chance: the logarithm of the places in a training line."""

    dictionaries: dict[str, bytes]
    bits: dict[str, float]
    chance: float = 6.0
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "bits": self.bits, "chance": self.chance, "_ready": {}}

    def length(self, line: str) -> float:
        """Description length in bits: the least over the languages, by compression of two bytes a character, and rare characters."""
        if not self._ready:
            self._ready.update({k: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for k, d in self.dictionaries.items()})
        data = line.encode("utf-16-le", "surrogatepass")
        least = min((len(c.compress(data)) for c in self._ready.values()), default=len(data))
        return 8.0 * least + sum(self.bits.get(c, UNSEEN_BITS) for c in line if c > "\x7f")

    def unchanged(self, stretches: dict[str, int]) -> float:
        """Bits of leaving a text as it is: the characters of its stretches of misread UTF-8, by encoding, would stand side by side by chance."""
        return max((n * self.chance * (3 if e in CYRILLIC else 1) for e, n in stretches.items()), default=0.0)


def clean_lines(text: str) -> list[str]:
    """Lines without signs of misreading, for the training."""
    return [x for x in text.split("\n") if x and (x.isascii() or (LOST not in x and not SIGN.search(x)))]


def train(samples: dict[str, list[str]], size: int = 24_000, characters: tuple[dict[str, int], int, int] | None = None) -> Model:
    """samples: texts by language. characters: in how many lines each one stands, the number of lines and their length (default: of the samples).
    Lines that show signs of misreading are left out of the training. A dictionary is a trained one, of an eighth of the samples at most; where the
    compressor finds too little to train on, the samples themselves are it."""
    dictionaries, seen, lines, length = {}, Counter(), 0, 0
    for language, texts in samples.items():
        clean = [x for t in texts for x in clean_lines(t)]
        lines, length = lines + len(clean), length + sum(map(len, clean))
        for x in clean:
            seen.update({c for c in x if c > "\x7f"})
        data = [x.encode("utf-16-le", "surrogatepass") for x in clean]
        try:
            dictionaries[language] = zstandard.train_dictionary(max(256, min(size, sum(map(len, data)) // 8)), data).as_bytes()
        except (zstandard.ZstdError, ValueError):
            dictionaries[language] = b"".join(data)[-size:] or b"\0" * 8
    counts, of, long = characters or (seen, lines, length)
    return Model(dictionaries, {c: min(UNSEEN_BITS, -math.log2(n / max(of, 1))) for c, n in counts.items() if n >= 2}, math.log2(max(2.0, long / max(of, 1))))


def restored(line: str, model: Model) -> tuple[str, tuple[str, ...]]:
    """The line of least description length, and the chain undone (empty: the line is best left as it is).

    A text's length is its compressed length and the bits of leaving the signs it still shows; a chain adds its own bits, so each step costs.
    """
    best, chain, least = line, (), math.inf
    seen, frontier = {line}, [(line, (), 0.0, None)]
    for _ in range(DEPTH + 1):
        following = []
        for text, steps, bits, length in frontier:
            options = [(e, *undone_utf8(text, e)) for e in READ_AS] if SIGN.search(text) else []
            if not steps:
                options += [(f"{a}>{b}", *undone_byte(text, a, b)) for a, b in ONE_BYTE]
            options = [x for x in options if x[2] and not any("\x00" <= c < "\x20" and c != "\t" for c in x[1])]
            if not steps and not options:
                return line, ()
            total = (model.length(text) if length is None else length) + model.unchanged({e: n for e, _, n in options if ">" not in e})
            if total < least:
                best, chain, least = text, steps, total
            for name, candidate, n in options:
                if candidate not in seen and len(steps) < DEPTH:
                    seen.add(candidate)
                    strange = sum(c not in model.bits for c in set(candidate) - set(line) if c > "\x7f")
                    cost = bits + (BYTE_BITS if ">" in name else UTF8_BITS) + STRETCH_BITS * n
                    following.append((candidate, (*steps, name), cost, model.length(candidate) + cost + STRANGE_BITS * strange))
        frontier = following
    return best, chain


def repair(text: str, model: Model) -> tuple[str, list[str], bool]:
    """The text with its lines restored, the chains undone, and whether characters were lost for good."""
    lines, chains = text.split("\n"), []
    for i, line in enumerate(lines):
        if not line.isascii() and SIGN.search(line):
            lines[i], chain = restored(line, model)
            if chain:
                chains.append("+".join(chain))
    return "\n".join(lines), sorted(set(chains)), LOST in text


#: Characters of text whose words a task counts at a time.
AT_ONCE = 16_000_000
_PIECES = pa.schema([("what", pa.string()), ("lang", pa.string()), ("piece", pa.string()), ("n", pa.int64())])


def _pairs(lang: str, texts: list[str]) -> pa.RecordBatch:
    """How often each word follows each; texts begin and end with a line's end, a word by itself, so where two texts meet is no pair."""
    words = pc.split_pattern(pa.array(texts, pa.large_string()), " ").flatten().dictionary_encode()
    codes, known = words.indices.to_numpy().astype(np.int64), words.dictionary
    both, n = np.unique(codes[:-1] * len(known) + codes[1:], return_counts=True)
    first, second = both // len(known), both % len(known)
    end = pc.index(known, "\n").as_py()
    kept = (first != end) | (second != end)
    pieces = pc.binary_join_element_wise(known.take(pa.array(first[kept])), known.take(pa.array(second[kept])), pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(["pair"] * len(pieces)), pa.array([lang] * len(pieces)), pieces, pa.array(n[kept], pa.int64())], schema=_PIECES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: dict[str, list[str]] = {}
    others: Counter = Counter()
    high: Counter = Counter()
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            lines = clean_lines(text)
            if not lines:
                continue
            length = sum(map(len, lines))
            others["records", lang, ""] += 1
            others["lines", lang, ""] += len(lines)
            others["length", lang, ""] += length
            if not text.isascii():
                for x in lines:
                    if not x.isascii():
                        high.update({c for c in x if c > "\x7f"})
            texts.setdefault(lang, []).append(" \n ".join(["", *lines, ""])[1:-1])
            held += length
            if held > AT_ONCE:
                yield from map(_pairs, texts, texts.values())
                texts, held = {}, 0
    yield from map(_pairs, texts, texts.values())
    if others:
        columns = zip(*[*((*k, n) for k, n in others.items()), *(("character", "", c, n) for c, n in high.items())])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)


def piece_counts(texts: DataFrame) -> DataFrame:
    """(what, lang, piece, n), over all lines without signs of misreading of texts (lang, text), counted before the shuffle: each pair of words (between
    spaces; a line's end is a word) of a language, in how many lines each character above ASCII stands, and the records, lines and their length by language."""
    counted = texts.select("lang", "text").mapInArrow(_counted, "what string, lang string, piece string, n long")
    return counted.groupBy("what", "lang", "piece").agg(F.sum("n").alias("n"))


def lines_of(pairs: dict[tuple[str, str], int]) -> list[str]:
    """Lines in which pairs of words stand as often as given (a line's end is a word): one walk over all of them. Where a word has no pair left, it
    takes the place of one that more pairs begin with than end with, so rare words stand in for each other, or else of any word left."""
    onward: dict[str, list[str]] = {}
    spare: Counter = Counter()
    for (a, b), n in sorted(pairs.items()):
        onward.setdefault(a, []).extend([b] * n)
        spare[a] += n
        spare[b] -= n
    mixed = random.Random(0)
    for following in onward.values():
        mixed.shuffle(following)
    heads = [w for w, n in sorted(spare.items()) for _ in range(n)]
    mixed.shuffle(heads)
    left, lines, line, at = sorted(onward), [], [], "\n"
    for _ in range(sum(pairs.values())):
        while not onward.get(at):
            at = heads.pop() if heads else left.pop()
            if not heads and onward.get(at):
                left.append(at)
        at = onward[at].pop()
        if at != "\n":
            line.append(at)
        elif line:
            lines.append(" ".join(line))
            line = []
    return [*lines, " ".join(line)] if line else lines


def trained_on(records: DataFrame, each: int = 800, longest: int = 20_000) -> Model:
    """A model whose characters and pairs of words are counted over all records (by column lang). The dictionaries are trained on lines made of the
    counted pairs, each as often as its share of all pairs of the language asks, in a text as long as `each` records of mean length (`longest` characters
    at most): the bound on what the driver gets. A language with no more text than that is trained on its very counts; of one with more, a pair that falls
    to less than one time there stands in it once or not at all."""
    usable = records.where("text is not null and record_key is not null").withColumn("lang", F.coalesce("lang", F.lit("")))
    counts = cut(piece_counts(usable), "pieces")
    characters: dict[str, int] = {}
    of: dict[str, dict[str, int]] = {"records": {}, "lines": {}, "length": {}}
    for r in counts.where("what <> 'pair'").collect():
        if r.what == "character":
            characters[r.piece] = r.n
        else:
            of[r.what][r.lang] = r.n
    samples: dict[str, list[str]] = {}
    if of["length"]:
        shares = {k: min(1.0, each * min(longest, n / of["records"][k]) / n) for k, n in of["length"].items()}
        share = F.element_at(F.create_map(*[F.lit(x) for k, v in sorted(shares.items()) for x in (k, v)]), F.col("lang"))
        # Parts of a time are rounded by a hash of the pair, so that sums hold.
        part = F.pmod(F.xxhash64("lang", "piece"), F.lit(1_000_000)) / 1_000_000
        times = counts.where("what = 'pair'").select("lang", "piece", F.floor(F.col("n") * share + part).alias("times")).where("times > 0")
        pairs: dict[str, dict[tuple[str, str], int]] = {k: {} for k in sorted(shares)}
        for r in times.collect():
            a, b = r.piece.split(" ")
            pairs[r.lang][a, b] = r.times
        samples = {k: lines_of(own) for k, own in pairs.items()}
    return train(samples, characters=(characters, sum(of["lines"].values()), sum(of["length"].values())))


REPAIRED = "field string, record_key string, restored string, chains array<string>, lost boolean"


def garbled(records: DataFrame, model: Model) -> DataFrame:
    """records (field, record_key, lang, text) with wrongly decoded stretches: restored text, chains undone, whether characters are lost.

    Null and empty texts are never garbled; a repeated row comes out as often as it stands there; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, k, text in zip(*(batch.column(c).to_pylist() for c in ("field", "record_key", "text"))):
                if not text or text.isascii():
                    continue
                fixed, chains, lost = repair(text, model)
                if chains or lost:
                    rows.append((f, k, fixed, chains, lost))
            if rows:
                columns = list(zip(*rows))
                types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["field", "record_key", "restored", "chains", "lost"])

    return records.where("record_key is not null and text is not null").select("field", "record_key", "text").mapInArrow(run, REPAIRED)
