"""Layout of pages from block boxes, reconciliation of native and scanned lines, groups of boxes, table grids."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from quirewise.functions import geometry as G
from quirewise.functions.contract import matched_form
from quirewise.storage import cut


@pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts (no built-in function gives it)."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")


def reconcile(native: DataFrame, ocr: DataFrame, overlap: float = 0.5, alike: float = 0.5, unclear: float = 0.02) -> DataFrame:
    """Native and scanned lines of a page (page_id, line_id, text, box) matched one to one: (page_id, native_id, ocr_id, kind, score).

    Candidates overlap by at least `overlap` of the smaller box and are alike by at least `alike`; a candidate whose line has another
    within `unclear` of its score, on either side, is ambiguous and takes no part. The rest are taken greedily by falling score. Lines
    left over are native_only or ocr_only; equal normalized texts are duplicates, others disagreements.
    """
    key = matched_form(F.col("text"))
    side = lambda df, n: df.select("page_id", F.col("line_id").alias(f"{n}_id"), key.alias(f"{n}_key"), F.col("box").alias(f"{n}_box"))
    a, b = side(native, "native"), side(ocr, "ocr")
    near = a.join(b, "page_id").where(G.overlap(F.col("native_box"), F.col("ocr_box")) >= overlap)
    scored = near.withColumn("score", F.when(F.col("native_key") == F.col("ocr_key"), 1.0).otherwise(similarity("native_key", "ocr_key"))).where(F.col("score") >= alike)

    def second(own: str):
        w = Window.partitionBy("page_id", own)
        best = F.max("score").over(w)
        return F.sum((F.col("score") >= best - unclear).cast("int")).over(w) > 1

    clear = scored.withColumn("u", second("native_id")).withColumn("v", second("ocr_id")).where("not u and not v")
    item = F.struct((-F.col("score")).alias("falling"), "native_id", "ocr_id", (F.col("native_key") == F.col("ocr_key")).alias("same"))
    listed = clear.groupBy("page_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    taken = F.aggregate(
        "items", F.slice("items", 1, 0), lambda kept, x: F.when(F.exists(kept, lambda k: (k["native_id"] == x["native_id"]) | (k["ocr_id"] == x["ocr_id"])), kept).otherwise(F.concat(kept, F.array(x)))
    )
    matches = listed.select("page_id", F.explode(taken).alias("x")).select("page_id", "x.native_id", "x.ocr_id", F.when(F.col("x.same"), "duplicate").otherwise("disagreement").alias("kind"), F.round(-F.col("x.falling"), 6).alias("score"))
    none = F.lit(None)
    alone_a = a.join(matches, ["page_id", "native_id"], "left_anti").select("page_id", "native_id", none.cast(matches.schema["ocr_id"].dataType).alias("ocr_id"), F.lit("native_only").alias("kind"), none.cast("double").alias("score"))
    alone_b = b.join(matches, ["page_id", "ocr_id"], "left_anti").select("page_id", none.cast(matches.schema["native_id"].dataType).alias("native_id"), "ocr_id", F.lit("ocr_only").alias("kind"), none.cast("double").alias("score"))
    return matches.unionByName(alone_a).unionByName(alone_b)


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(id, component): the least id reachable from each node. edges (a, b) in either direction; nodes without edges stand alone.

    Each round takes the least label of the neighbours and then follows labels of labels, so long chains take a logarithm of rounds; labels are
    written to the shared folder between rounds. Still changing after most_rounds raises an error.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = nodes.select("id", F.col("id").alias("label")).distinct()

    def step(labels: DataFrame) -> DataFrame:
        offered = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("offer"))
        lower = labels.join(offered, "id", "left").select("id", F.least("label", "offer").alias("label"))
        return lower.join(lower.select(F.col("id").alias("label"), F.col("label").alias("beyond")), "label").select("id", F.least("label", "beyond").alias("label"))

    for k in range(most_rounds):
        # Two steps a round: half the tables to write and half the rounds to wait for.
        moved = step(step(labels)).select("id", F.col("label").alias("next"))
        done = cut(labels.join(moved, "id"), f"labels{k}")
        labels = done.select("id", F.col("next").alias("label"))
        if not done.where("label <> next").limit(1).count():
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError("components did not settle")


def near_boxes(items: DataFrame, page: list[str], gap: float = 24.0, cell: float = 200.0) -> DataFrame:
    """Pairs (a, b) of items (id, box) of one page whose boxes lie within `gap` on both axes; boxes meet through the grid cells they touch."""
    grown = items.select(*page, "id", "box", F.explode(F.sequence(F.floor(F.col("box.x0") / cell), F.floor((F.col("box.x1") + gap) / cell))).alias("cx")).select("*", F.explode(F.sequence(F.floor(F.col("box.y0") / cell), F.floor((F.col("box.y1") + gap) / cell))).alias("cy"))
    a, b = grown.select(*page, "cx", "cy", F.col("id").alias("a"), F.col("box").alias("p")), grown.select(*page, "cx", "cy", F.col("id").alias("b"), F.col("box").alias("q"))
    p, q = F.col("p"), F.col("q")
    close = (p["x0"] <= q["x1"] + gap) & (q["x0"] <= p["x1"] + gap) & (p["y0"] <= q["y1"] + gap) & (q["y0"] <= p["y1"] + gap)
    return a.join(b, [*page, "cx", "cy"]).where((F.col("a") < F.col("b")) & close).select("a", "b").distinct()


#: About so many pairs are held at a time (at least those of one box).
PAIRS = 1_000_000


def _link(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the groups of a[k] and b[k] in place; label has the least member of each one's group."""
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := label[label], label):
            label[:] = further


def _least_linked(page: np.ndarray, box: list[np.ndarray], known: np.ndarray, repeats: np.ndarray, gap: float) -> np.ndarray:
    """The least place each box is linked to. Boxes of a page, sorted by y0, can only be near those that follow up to y1 + gap. NaN is above all, as in SQL."""
    x0, y0, x1, y1 = box
    label = np.arange(len(page))
    _link(label, np.flatnonzero(repeats), np.flatnonzero(repeats) - 1)
    at = np.flatnonzero(known)
    order = at[np.lexsort((y0[at], page[at]))]
    m = len(order)
    mixed = np.lexsort((np.repeat([0, 1], m), np.concatenate([y0[order], y1[order] + gap]), np.tile(page[order], 2)))
    reach = np.empty(m, np.int64)
    reach[mixed[mixed >= m] - m] = np.cumsum(mixed < m)[mixed >= m]
    count = np.maximum(reach - np.arange(1, m + 1), 0)
    done = np.cumsum(count)
    below = lambda a, b: (a <= b) | np.isnan(b)
    low = 0
    while low < m:
        high = max(low + 1, int(np.searchsorted(done, done[low] - count[low] + PAIRS, "right")))
        c = count[low:high]
        i = np.repeat(np.arange(low, high), c)
        a, b = order[i], order[i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)]
        near = below(x0[a], x1[b] + gap) & below(x0[b], x1[a] + gap) & below(y0[a], y1[b] + gap)
        _link(label, a[near], b[near])
        low = high
    return label


def _linked(pages: list[pa.RecordBatch], gap: float) -> pa.RecordBatch:
    """(id, component) of whole pages; an id that a page has twice is one item with both boxes."""
    t = pa.Table.from_batches(pages)
    t = t.append_column("page", pa.array(np.cumsum(t["place"].to_numpy() == 0)))
    t = t.take(pc.sort_indices(t, sort_keys=[("page", "ascending"), ("id", "ascending")]))
    column = lambda k: t[k].combine_chunks()
    ids, page, sides = column("id"), column("page").to_numpy(), [column(k) for k in ("x0", "y0", "x1", "y1")]
    known = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in (ids, *sides)])
    repeats = np.zeros(len(page), bool)
    repeats[1:] = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False) & (page[1:] == page[:-1])
    least = _least_linked(page, [x.to_numpy(zero_copy_only=False) for x in sides], known, repeats, gap)
    one = np.flatnonzero(~repeats)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(one)), ids.take(pa.array(least[one]))], ["id", "component"])


def box_groups(placed: DataFrame, gap: float = 24.0) -> DataFrame:
    """(id, component): the least id of a page's items whose boxes lie within `gap` on both axes, directly or through others.

    placed (place, id, box) comes straight from posexplode over one row a page: its rows follow each other, place 0 begins the next. No link
    leaves a page, so one pass gives what `components` of `near_boxes` finds in rounds, and a task holds one batch and the page it ends in.
    Boxes with a null side stand alone; null ids have a null component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            begins = np.flatnonzero(batch.column("place").to_numpy() == 0)
            if len(begins):
                whole = [*held, batch.slice(0, begins[-1])]
                if any(len(x) for x in whole):
                    yield _linked(whole, gap)
                held = []
            held.append(batch.slice(begins[-1]) if len(begins) else batch)
        if any(len(x) for x in held):
            yield _linked(held, gap)

    sides = [F.col(f"box.{k}").cast("double").alias(k) for k in ("x0", "y0", "x1", "y1")]
    return placed.select("place", "id", *sides).mapInArrow(run, "id string, component string")


def table_grid(tokens: DataFrame) -> DataFrame:
    """A dense grid of each result's tokens: rows are its lines, columns the connected intervals of x; empty cells have an empty text."""
    w = Window.partitionBy("selection_result_id").orderBy("box.x0", "box.x1")
    reach = F.max("box.x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    placed = tokens.withColumn("opens", (reach.isNull() | (F.col("box.x0") >= reach)).cast("int")).withColumn("column", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "text"))), lambda x: x["text"]), " ")
    cells = placed.groupBy("selection_result_id", F.col("line_order").alias("row"), F.col("column").cast("bigint").alias("column")).agg(text.alias("text"))
    rows, columns = cells.select("selection_result_id", "row").distinct(), cells.select("selection_result_id", "column").distinct()
    return rows.join(columns, "selection_result_id").join(cells, ["selection_result_id", "row", "column"], "left").fillna("", ["text"])
