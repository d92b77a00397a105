"""The look of a text in SQL, for the queries that DuckDB checks."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from quirewise.llm.lookalike import skeleton


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, str, list[tuple[str, str]]]:
    """Characters with one that looks the same, the latter, characters that don't show, and those that look like several others."""
    one_from, one_to, gone, several = [], [], [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or unicodedata.category(c) in ("Cn", "Mn", "Lo", "Co"):
            continue
        look = skeleton(c)
        if look == c:
            continue
        if not look:
            gone.append(c)
        elif len(look) == 1:
            one_from.append(c)
            one_to.append(look)
        elif code < 0x2E00 or 0xFB00 <= code < 0xFB10:
            several.append((c, look))
    return "".join(one_from), "".join(one_to), "".join(gone), several


def look_sql(text: str) -> str:
    """An expression for the look of the text `text` gives. Longer looks are put in first: they may hold characters that have another look."""
    one_from, one_to, gone, several = _folds()
    out = f"nfc_normalize({text})"
    for c, look in several:
        if look[0].isalpha() and c.isalpha() or c in "…‥″‴":
            out = f"replace({out}, '{c}', '{look}')"
    quoted = lambda x: x.replace("'", "''")
    return f"nfc_normalize(translate({out}, '{quoted(one_from + gone)}', '{quoted(one_to)}'))"
