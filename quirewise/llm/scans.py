"""Noise in text from scanned pages: broken and misread words, running headers, page numbers, lines instead of paragraphs.

A page's furniture is set aside first, by what recurs in its book and in the corpus. The tokens of its body are decoded as one stream over the
line ends (see `scanwords`), with the engine's confidence in each token where there is one. The path gives the marks of the page and, cut into
paragraphs by dynamic programming, its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.llm.scanwords import Step, Vocabulary, core, decode, vocabulary

_ROMAN = re.compile(r"[ivxlcdm]+")
_DRESSING = " \t\xa0-–—[]()|~.·•*»«>_=:"


def _shown(line: str) -> list[str]:
    """The tokens of a line without dressing signs, folded."""
    return [x for x in (t.strip(_DRESSING).lower() for t in line.split()) if x]


def _same_number(shown: str, label: str) -> bool:
    label = label.strip().lower()
    if shown == label:
        return True
    table = str.maketrans("lio|!sbgz", "110115892")
    return len(shown) == len(label) and shown.translate(table) == label.translate(table)


def _plausible(shown: str, index: int | None) -> bool:
    """Whether a page without a label may carry this number: not beyond its place, as front matter shifts numbers down only."""
    if _ROMAN.fullmatch(shown) or re.fullmatch(r"[a-z]-\d{1,4}", shown):
        return True
    digits = shown.translate(str.maketrans("lo", "10"))
    return digits.isdigit() and 0 < int(digits) <= (index if index is not None else 0) + 1


def roman(n: int) -> str:
    out = ""
    for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + sign * (n // value), n % value
    return out


def expected(label: str | None, index: int | None) -> list[str]:
    """Numbers a page may carry: its label, else what its place in the book gives."""
    if label and label.strip():
        return [label]
    if index is None or index < 0:
        return []
    n = index + 1
    return [str(n), roman(n), f"a-{n}"]


def is_title(line: str) -> bool:
    """Words of a running title: three or more, all in capitals or each with a capital first."""
    tokens = [t for t in (core(t) for t in line.split()) if any(c.isalpha() for c in t)]
    if len(tokens) < 3 or line.rstrip()[-1:] in ".,;:":
        return False
    return all(t[0].isupper() or not t[0].isalpha() for t in tokens)


def without_number(line: str, numbers: list[str]) -> str:
    """A head line without the page's number at either end; without a label, any number or roman numeral there that isn't part of the title."""
    tokens = line.split()
    for at in (0, -1):
        if len(tokens) > 1:
            shown = tokens[at].strip("-–—[]()|~.·•:").lower()
            beside = tokens[1 if at == 0 else -2].strip(_DRESSING).lower()
            own = any(_same_number(shown, n) for n in numbers)
            loose = len(tokens) > 2 and not tokens[at][:1].isupper() and (_ROMAN.fullmatch(shown) or re.fullmatch(r"[\dlo]*\d[\dlo]*", shown))
            # The numeral of a title ("Part iv") isn't the page's number if that stands on its other side or the title would be one word.
            if shown and (own or loose) and not (len(tokens) == 2 and _ROMAN.fullmatch(shown) and not beside.isdigit() and not own):
                tokens.pop(at)
    return " ".join(tokens)


#: Letters that a scan confuses, folded together: of each confusion of single characters the least in code point.
_ALIKE = str.maketrans({"1": "l", "0": "o", "5": "s", "@": "a", "!": "l", "|": "l", "i": "l", "q": "g", "c": "e", "f": "e", "t": "e", "h": "b"})


def title_key(line: str) -> str:
    """A title without numbers, numerals, punctuation and case, confusable letters folded together."""
    tokens = [t.strip(_DRESSING).lower() for t in line.split()]
    kept = [t for t in tokens if not re.fullmatch(r"[ivxlcdm1]+", t)] or tokens
    letters = re.sub(r"[\W_]+", "", "".join(kept).translate(_ALIKE))
    return re.sub(r"\d+", "", letters.replace("rn", "m").replace("ll", "u").replace("el", "d").replace("rl", "n"))


@dataclass(frozen=True)
class Known:
    """What recurs: keys of heads of the page's book, keys of heads of several books, words that stand beside page numbers."""

    book: frozenset[str] = frozenset()
    corpus: frozenset[str] = frozenset()
    dressings: frozenset[str] = frozenset()


def _number(line: str, dressings: frozenset[str]) -> str | None:
    """What a line consists of if that is one number with its dressing: signs, and a word of `dressings`."""
    shown = _shown(line)
    if len(shown) == 2 and shown[0] in dressings:
        shown = shown[1:]
    return shown[0] if len(shown) == 1 and len(shown[0]) <= 12 else None


def furniture(lines: list[str], label: str | None, index: int | None, known: Known = Known()) -> dict[int, str]:
    """Line numbers of page numbers (`page_number`) and running headers (`header`), at the head and foot of a page."""
    out: dict[int, str] = {}
    filled = [i for i, x in enumerate(lines) if x.strip()]
    if not filled:
        return out
    numbers = expected(label, index)
    for i in dict.fromkeys(filled[:2] + filled[-2:]):
        shown = _number(lines[i], known.dressings)
        if shown and (any(_same_number(shown, n) for n in numbers) or (not (label and label.strip()) and i in (filled[0], filled[-1]) and _plausible(shown, index))):
            out[i] = "page_number"
    width = max(len(lines[i].strip()) for i in filled)
    for i in filled[:2]:
        if i in out:
            continue
        head = without_number(lines[i], numbers)
        key = title_key(head)
        if key in known.book or is_title(head) or (key in known.corpus and _apart(head, width)):
            out[i] = "header"
        break
    return out


def _apart(head: str, width: int) -> bool:
    """Whether a line is short and doesn't end as a sentence, so it isn't the end of a paragraph."""
    return len(head) < 0.6 * width and head.rstrip()[-1:] not in ".,;:?!”"


def keys_of(lines: list[str], label: str | None, index: int | None, book: str) -> list[str]:
    """What a page says of recurring furniture: `book` and `corpus` keys of its head, words beside its `number`, beside one `near` it in shape
    or beside an `other` one."""
    filled = [x for x in lines if x.strip()]
    numbers, out = expected(label, index), []
    for x in dict.fromkeys(filled[:2] + filled[-2:]):
        shown = _shown(x)
        if len(shown) == 2 and shown[0].isalpha():
            exact, near = shown[1] in [n.strip().lower() for n in numbers], any(_same_number(shown[1], n) for n in numbers)
            if exact or near or _ROMAN.fullmatch(shown[1]) or any(c.isdigit() for c in shown[1]):
                out.append(f"{'number' if exact else 'near' if near else 'other'}\x1f{shown[0]}")
    for x in filled[:2]:
        shown = _shown(x)
        if shown and len(shown) <= 2 and (shown[-1] in [n.strip().lower() for n in numbers] or len(shown) == 1 and any(_same_number(shown[0], n) for n in numbers)):
            continue
        head = without_number(x, numbers)
        key = title_key(head)
        if len(key) >= 4:
            out.append(f"book\x1f{book}\x1f{key}")
            if _apart(head, max(map(len, filled))):
                out.append(f"corpus\x1f{key}")
        if not (len(shown) == 2 and any(_same_number(shown[1], n) for n in numbers)):
            break  # else it may turn out to be the page's number
    return out


def noise_of(lines: list[str], body: list[int]) -> set[int]:
    """Lines of the body that are a bare number between text lines: they don't go on with the text."""
    return {i for i in body if re.fullmatch(r"[\d.,]+", lines[i].strip())}


def read(text: str, label: str | None, index: int | None, known: Known, words: Vocabulary, confidence: dict[int, list] | None = None) -> tuple[dict[int, str], list[int], list[str], list[Step]]:
    """A scanned page: its furniture, the numbers and lines of its flowing text, and the decoded path through them."""
    lines = text.split("\n")
    found = furniture(lines, label, index, known)
    body = [i for i, x in enumerate(lines) if x.strip() and i not in found]
    aside = noise_of(lines, body)
    flow = [i for i in body if i not in aside]
    given = [(confidence or {}).get(i, []) for i in flow]
    return found, flow, lines, decode([lines[i].split() for i in flow], words, given)


def marks(text: str, label: str | None, index: int | None, known: Known, words: Vocabulary, confidence: dict[int, list] | None = None) -> list[tuple[int, str]]:
    """(line_no, kind) of a scanned page's noise."""
    found, flow, lines, path = read(text, label, index, known, words, confidence)
    at = [i for i in flow for _ in lines[i].split()]
    noise = {(flow[k], "hyphen") for s in path for k in s.broken} | {(at[t], "misread") for s in path for t in s.wrong}
    return sorted(found.items()) + sorted(noise)


#: Nepers: a boundary where a sentence ends in a line with room for the next word before a capital, and elsewhere; none where one fits, and where a
#: blank line stands; a paragraph of one line that doesn't end as a sentence, and of one that does.
FITTING, MISFIT, MISSED, ACROSS_BLANK, LONE_FRAGMENT, LONE_LINE = 0.2, 6.0, 2.0, 5.0, 4.0, 0.7


def boundaries(lines: list[str], blank_after: list[bool], joined: set[int]) -> list[int]:
    """After which lines paragraphs end, by the cheapest sequence of boundaries: two in a row make a paragraph of one line, which is rare.

    blank_after: whether a blank line follows. joined: lines whose last word goes on in the next one, so no paragraph ends there.
    """
    if not lines:
        return []
    width = max(len(x.rstrip()) for x in lines)
    # Costs and ways of the two states after each line: no boundary, boundary.
    cost, came = [(0.0, 0.0)], []
    cost[0] = (float("inf"), 0.0)
    for i, x in enumerate(lines):
        ends = x.rstrip()[-1:] in ".?!”"
        if i + 1 < len(lines):
            following = lines[i + 1].lstrip()
            room = len(x.rstrip()) + 1 + len(following.split()[0]) <= width
            fits = ends and room and following[:1].isupper()
            here = FITTING if fits or blank_after[i] else MISFIT
            none = ACROSS_BLANK if blank_after[i] else MISSED if ends and room else 0.0
            if i in joined:
                here, none = float("inf"), 0.0
        else:
            here, none = 0.0, float("inf")
        lone = LONE_LINE if ends else LONE_FRAGMENT
        inside, after = cost[-1]
        ways = ((min(inside, after) + none, inside <= after), (min(inside, after + lone) + here, inside <= after + lone))
        came.append((ways[0][1], ways[1][1]))
        cost.append((ways[0][0], ways[1][0]))
    out, state = [], 1
    for i in range(len(lines) - 1, -1, -1):
        if state:
            out.append(i)
        state = 0 if came[i][state] else 1
    return out[::-1]


def paragraphs(text: str, label: str | None, index: int | None, known: Known, words: Vocabulary, confidence: dict[int, list] | None = None) -> list[str]:
    """The page's text as continuous paragraphs in the printed words."""
    _, flow, lines, path = read(text, label, index, known, words, confidence)
    at = [k for k, i in enumerate(flow) for _ in lines[i].split()]
    joined = {k for s in path for k in range(at[s.first], at[s.last - 1])}
    blank = [any(not x.strip() for x in lines[a + 1 : b]) for a, b in zip(flow, flow[1:])] + [False]
    out, steps = [], iter(path)
    step = next(steps, None)
    for end in boundaries([lines[i] for i in flow], blank, joined):
        said = []
        while step is not None and at[step.first] <= end:
            said.append(step.text)
            step = next(steps, None)
        out.append(" ".join(said))
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("text", "label", "page_index", "book"))
        keys = [keys_of((text or "").split("\n"), label, index, book) for text, label, index, book in zip(*columns)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("book"), pa.array(keys, pa.list_(pa.string()))], ["page_id", "book", "keys"])


def with_known(pages: DataFrame, least: int = 3) -> DataFrame:
    """pages with `known`: those of the page's own keys that recur, on `least` pages of the book or in `least` books of the corpus; a word beside
    numbers counts if most of them are the page's."""
    each = pages.mapInArrow(_keyed, "page_id string, book string, keys array<string>").select("page_id", "book", F.explode("keys").alias("key"))
    other = F.col("key").startswith("other\x1f")
    named = F.regexp_replace("key", "^(other|near)\x1f", "number\x1f")
    for_it = ~F.col("key").rlike("^(other|near)\x1f")
    by_book = each.groupBy(named.alias("key"), "book").agg(F.sum(for_it.cast("bigint")).alias("n"), F.sum(other.cast("bigint")).alias("against"))
    several = by_book.groupBy("key").agg(F.sum("n").alias("n"), F.sum("against").alias("against"), F.count("*").alias("books"))
    often = several.where((F.col("n") >= least) & (F.col("n") > F.col("against")) & (F.col("key").startswith("book\x1f") | (F.col("books") >= least)))
    found = each.withColumn("key", named).join(often.select("key"), "key", "left_semi").groupBy("page_id").agg(F.collect_set("key").alias("known"))
    return pages.join(found, "page_id", "left")


def with_confidence(pages: DataFrame, results: DataFrame | None) -> DataFrame:
    """pages with `confidence`: line numbers and confidences of the tokens of the page's result (page_id, tokens) that has most of them."""
    empty = F.lit(None).cast("array<struct<order:int,line_order:int,confidence:double>>")
    if results is None:
        return pages.withColumn("token", empty)
    own = F.arrays_zip(F.col("tokens.order").alias("order"), F.col("tokens.line_order").alias("line_order"), F.col("tokens.confidence").alias("confidence"))
    given = results.where("page_id is not null and tokens is not null").select("page_id", F.array_sort(own).alias("token"))
    return pages.join(given.groupBy("page_id").agg(F.max_by("token", F.struct(F.size("token"), "token")).alias("token")), "page_id", "left")


def _prepared(pages: DataFrame, results: DataFrame | None) -> DataFrame:
    given = pages.where("page_id is not null and text is not null").select("page_id", F.coalesce("book", F.lit("")).alias("book"), "page_index", "label", "text").distinct()
    joined = with_confidence(with_known(given), results)
    return joined.select("page_id", "page_index", "label", "text", "known", F.col("token.line_order").alias("line_order"), F.col("token.confidence").alias("confidence"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """By batch: page_id and what `read` wants of each page but the vocabulary."""
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("page_id", "text", "label", "page_index", "known", "line_order", "confidence"))
        for page, text, label, index, known, order, confidence in zip(*columns):
            kinds: dict[str, set[str]] = {"book": set(), "corpus": set(), "number": set()}
            for k in known or ():
                kinds[k.split("\x1f", 1)[0]].add(k.rsplit("\x1f", 1)[1])
            by_line: dict[int, list] = {}
            for line, c in zip(order or (), confidence or ()):
                by_line.setdefault(line, []).append(c)
            rows.append((page, text, label, index, Known(*map(frozenset, kinds.values())), by_line))
        yield rows


def scan_noise(pages: DataFrame, texts: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """(page_id, line_no, kind) of scanned pages (page_id, book, page_index, label, text); texts gives the vocabulary, results
    (page_id, tokens) the confidence of the tokens.

    Kinds: `hyphen`, `misread`, `header`, `page_number`. Null and blank texts give no rows; a null book counts as one book; repeated
    rows count once; a page without label is judged by its place; without a result, or with one cut off, tokens count as ordinary ones.
    """
    words = vocabulary(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            rows = [(page, n, kind) for page, text, label, index, known, confidence in batch for n, kind in marks(text, label, index, known, words, confidence)]
            if rows:
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["page_id", "line_no", "kind"])

    return _prepared(pages, results).mapInArrow(run, "page_id string, line_no long, kind string")


def scan_paragraphs(pages: DataFrame, texts: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """(page_id, paragraph_no, paragraph): scanned pages as continuous paragraphs in the printed words; arguments as of `scan_noise`."""
    words = vocabulary(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            rows = [(page, n, p) for page, text, label, index, known, confidence in batch for n, p in enumerate(paragraphs(text, label, index, known, words, confidence))]
            if rows:
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.int32()), pa.array(c, pa.string())], ["page_id", "paragraph_no", "paragraph"])

    return _prepared(pages, results).mapInArrow(run, "page_id string, paragraph_no int, paragraph string")
