"""Evaluation texts leaking into training text, by an FM-index per shard of the corpus.

Words of the documents become numbers of the test items' vocabulary; what no item contains ends a run, so the index holds only
the runs long enough to contain a passage. All passages of the items are searched backward side by side, located by sampled
suffix positions, and merged to spans.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewise.llm.fmindex import FMIndex
from quirewise.llm.lookalike import IGNORABLE, skeleton

_WORD = re.compile(r"[^\W_]+")
#: A hyphen at a line's end, and the part of the word after it.
_BROKEN = re.compile(r"(\w)(?:[-‐‑–­¬][ \t]*\n\s*)(?=\w)")
_SOFT = re.compile("[" + "".join(c for c in IGNORABLE) + "]")
JOIN = "⁀"  # a mark no text keeps: it is a symbol, and symbols are dropped


def plain(text: str) -> str:
    """Folded text in which look-alikes are equal and a word broken at a line's end has a joining mark at the break."""
    broken = _BROKEN.sub(rf"\1{JOIN}", text.replace(JOIN, " ")) if "\n" in text else text
    look = skeleton(broken).casefold()
    return look if look.isascii() else unicodedata.normalize("NFC", look)


def readings(look: str, known: Container[str] | None, least: int = 12) -> Iterator[tuple[int, list[str]]]:
    """The readings of a plain text as runs of letters and digits, each with the number of its first word in the first reading.

    The first reading is whole: a broken word is joined if the joined word is known (known None: always), else split. Where both the joined word and
    its parts are known (known None: everywhere) the break is unclear: for each unclear break that is split, and all ways to read the unclear
    ones within `least` words behind it, there is a reading of the words around, so each passage of `least` words stands in one.
    """
    if JOIN not in look:
        yield 0, _WORD.findall(look)
        return
    parts, glued, end = [], [], -1
    for m in _WORD.finditer(look):
        glued.append(look[end : m.start()] == JOIN if parts else False)
        parts.append(m.group())
        end = m.end()
    # glued[i]: part i may join the part before it.
    joins = [g and (known is None or parts[i - 1] + parts[i] in known) for i, g in enumerate(glued)]
    unclear = [i for i, j in enumerate(joins) if j and (known is None or (parts[i - 1] in known and parts[i] in known))]

    def read(start: int, stop: int, split: set[int]) -> list[str]:
        out: list[str] = []
        for i in range(start, stop):
            if joins[i] and i not in split and i > start:
                out[-1] += parts[i]
            else:
                out.append(parts[i])
        return out

    yield 0, read(0, len(parts), set())
    for n, i in enumerate(unclear):
        near = [k for k in unclear[n + 1 :] if k - i < 2 * least]
        start, stop = max(0, i - 2 * least), min(len(parts), (near[-1] if near else i) + 2 * least)
        at = start - sum(joins[1 : start + 1])
        for m in range(1 << len(near)):
            yield at, read(start, stop, {i} | {k for b, k in enumerate(near) if m >> b & 1})


FOUND = "doc_id long, item_id long, first_word int, last_word int"


class Passages:
    """The passages of `least` words of the test items, as numbers of their vocabulary."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least, self.vocabulary = least, {}
        rows, owners = [], []
        for item, text in items:
            for _, reading in readings(plain(text or ""), None, least):
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in reading], dtype=np.int32)
                if len(ids) >= least:
                    rows.append(np.lib.stride_tricks.sliding_window_view(ids, least))
                    owners.append(np.full(len(ids) - least + 1, item, dtype=np.int64))
        phrases = np.concatenate(rows) if rows else np.zeros((0, least), dtype=np.int32)
        owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        once = np.unique(np.column_stack([owner, phrases]), axis=0)
        self.items, self.phrases = once[:, 0].astype(np.int64), once[:, 1:].astype(np.int64)

    def runs(self, look: str) -> Iterator[tuple[int, list[int]]]:
        """Runs of at least `least` known words of a plain text, with the number of their first word in its reading."""
        get = self.vocabulary.get
        for offset, reading in readings(look, self.vocabulary, self.least):
            ids = [get(w, 0) for w in reading]
            at = 0
            while at <= len(ids) - self.least:
                # A run must hold the word least - 1 further on: unknown there, the run can only begin behind it.
                if not ids[at + self.least - 1]:
                    at += self.least
                    continue
                start = at + self.least - 1
                while start > at and ids[start - 1]:
                    start -= 1
                end = at + self.least
                while end < len(ids) and ids[end]:
                    end += 1
                if end - start >= self.least:
                    yield offset + start, ids[start:end]
                at = end + 1

    def search(self, docs: list[int], looks: list[str]) -> list[tuple[int, int, int, int]]:
        """(doc, item, first word, last word) of the merged passages in a shard of plain texts."""
        parts, starts, owner, offset, size = [], [], [], [], 0
        stop = len(self.vocabulary) + 1
        for doc, look in zip(docs, looks):
            for first, run in self.runs(look) if look else ():
                parts += [run, [stop]]
                starts.append(size)
                owner.append(doc)
                offset.append(first)
                size += len(run) + 1
        if not parts or not len(self.phrases):
            return []
        index = FMIndex(np.fromiter((x for p in parts for x in p), dtype=np.int64, count=size), stop)
        low, high = index.search(self.phrases)
        counts = high - low
        which = np.repeat(np.arange(len(low)), counts)
        rows = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = index.locate(rows)
        run = np.searchsorted(np.array(starts), places, side="right") - 1
        hits = sorted({(owner[r], int(self.items[w]), int(p - starts[r] + offset[r])) for r, w, p in zip(run.tolist(), which.tolist(), places.tolist())})
        out: list[tuple[int, int, int, int]] = []
        for doc, item, first in hits:
            if out and out[-1][:2] == (doc, item) and first <= out[-1][3] + 1:
                out[-1] = (doc, item, out[-1][2], max(out[-1][3], first + self.least - 1))
            else:
                out.append((doc, item, first, first + self.least - 1))
        return out


def leaked(documents: DataFrame, items: DataFrame, least: int = 12, block_words: int = 2_000_000, shard_chars: int = 8_000_000) -> DataFrame:
    """(doc_id, item_id, first_word, last_word): spans of at least `least` consecutive words of an item's text in a document.

    Words are runs of letters and digits, folded; look-alikes, invisible characters, markup, and line breaks inside a word are
    disregarded. The items are read to the driver in blocks of block_words words, each of which is broadcast; the corpus is read and folded once, and
    each shard of it (what a task reads, up to shard_chars characters at a time) is searched for all blocks. Null texts and ids are
    left out; items of fewer words match nothing; a repeated row gives equal rows.
    """
    corpus = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    context = documents.sparkSession.sparkContext
    given = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    blocks, block, size = [], [], 0
    for row in given.toLocalIterator():
        block.append((row.item_id, row.text))
        size += row.text.count(" ") + 1
        if size >= block_words:
            blocks.append(context.broadcast(Passages(block, least)))
            block, size = [], 0
    if block or not blocks:
        blocks.append(context.broadcast(Passages(block, least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int] = []
        looks: list[str] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for b in blocks:
                columns = list(zip(*b.value.search(docs, looks))) or [(), (), (), ()]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "item_id", "first_word", "last_word"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                docs.append(doc)
                looks.append(plain(text))
                size += len(text)
                if size >= shard_chars:
                    yield from out()
                    docs, looks, size = [], [], 0
        if docs:
            yield from out()

    return corpus.mapInArrow(run, FOUND)
