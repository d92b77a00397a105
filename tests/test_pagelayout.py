import random

from quirewise.operators import pagelayout as P

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def vertical(a, b):
    return max(0.0, min(a[3], b[3]) - max(a[1], b[1])) / min(a[3] - a[1], b[3] - b[1])


def best_split(items, height):
    ordered = sorted(items, key=lambda i: (i[1][0], i[1][2], i[0]))
    best = None
    for k in range(1, len(ordered)):
        left, right = [b for _, b in ordered[:k]], [b for _, b in ordered[k:]]
        gap = min(b[0] for b in right) - max(b[2] for b in left)
        tall = all((max(b[3] for b in s) - min(b[1] for b in s)) / height > P.FLOW for s in (left, right))
        if gap >= 0 and tall:
            support = min([max(vertical(a, b) for b in right) for a in left] + [max(vertical(a, b) for a in left) for b in right])
            if support >= P.SUPPORT and (best is None or gap > best[1]):
                best = (k + 1, gap, support)
    return best


def test_column_splits_by_brute_force(spark):
    rng, rows, want = random.Random(4), [], {}
    for page in range(60):
        items = []
        for i in range(rng.randrange(0, 7)):
            x, y = rng.choice([0.0, 50.0, 300.0, 420.0]) + rng.randrange(20), float(rng.randrange(600))
            items.append((f"b{i}", (x, y, x + rng.choice([90.0, 180.0, 260.0]), y + rng.choice([60.0, 150.0, 300.0]))))
        rows += [(page, i, b, 792.0) for i, b in items]
        if found := best_split(items, 792.0):
            want[page] = found
    got = P.column_splits(spark.createDataFrame(rows, f"page long, id string, box {BOX}, height double"), ["page"]).collect()
    assert want and {r.page: (r.cut, r.gap, round(r.support, 9)) for r in got} == {p: (k, g, round(s, 9)) for p, (k, g, s) in want.items()}


def column(name, x, width, tops, height=100.0):
    return [(f"{name}{i}", (float(x), float(y), float(x + width), float(y + height))) for i, y in enumerate(tops)]


PAGES = {
    "empty": ([], 0, "empty", "empty", 1.0),
    "rotated": (column("a", 50, 500, [50]), 90, "ambiguous", "rotated", 0.25),
    "one": (column("a", 50, 500, [50, 200, 350]), 0, "one_column", "one_column", 0.9),
    "invalid": (column("a", 50, 500, [50, 200]) + [("bad", (5.0, 5.0, 5.0, 9.0)), ("none", None)], 0, "one_column", "one_column", 0.7),
    "two": (column("t", 40, 540, [20], 30) + column("l", 40, 250, [60, 170, 280]) + column("r", 320, 250, [60, 170, 280]), 0, "multi_column", "two_columns", 0.72 + 30 / 612),
    "bottom": (column("a", 50, 500, [50, 200]) + column("z", 50, 500, [700], 20), 0, "ambiguous", "one_column", 0.35),
    "overlap": (column("a", 50, 500, [50, 100]), 0, "ambiguous", "overlapping_text_boxes", 0.25),
    "weak": (column("l", 40, 250, [60, 170]) + column("r", 300, 250, [60, 170]), 0, "ambiguous", "weak_column_separation", 0.25),
    "three": (column("l", 20, 150, [60, 170]) + column("m", 220, 150, [60, 170]) + column("r", 420, 150, [60, 170]), 0, "ambiguous", "more_than_two_column_groups", 0.25),
    "sidebar": (column("l", 20, 60, [60, 170]) + column("r", 200, 300, [60, 170]), 0, "ambiguous", "sidebar", 0.35),
    "within": (column("l", 40, 250, [60, 300]) + column("r", 320, 250, [60, 300]) + column("w", 40, 540, [200], 50), 0, "ambiguous", "unsupported_spanning_position", 0.25),
    "separate": (column("l", 40, 200, [60]) + column("r", 320, 200, [400]), 0, "ambiguous", "discontinuous_side_groups", 0.25),
    "bridge": (column("t", 200, 200, [20], 30) + column("l", 40, 250, [60, 170]) + column("r", 330, 250, [60, 170]), 0, "ambiguous", "bridging_top_block", 0.25),
}


def test_page_kinds(spark):
    pages = spark.createDataFrame([(k, 612.0, 792.0, v[1], "x") for k, v in PAGES.items()], "page_id string, width double, height double, rotation int, id string")
    blocks = spark.createDataFrame([(k, i, b) for k, v in PAGES.items() for i, b in v[0]], f"page_id string, id string, box {BOX}")
    kinds, order = P.page_kinds(pages, blocks)
    assert {r.page_id: (r.kind, r.reason, r.confidence) for r in kinds.collect()} == {k: (v[2], v[3], round(v[4], 6)) for k, v in PAGES.items()}
    placed = {}
    for r in sorted(order.collect(), key=lambda r: r.position):
        placed.setdefault(r.page_id, []).append((r.id, r.part))
    assert [i for i, _ in placed["two"]] == ["t0", "l0", "l1", "l2", "r0", "r1", "r2"] and placed["bottom"][-1] == ("z0", "bottom")
    assert P.page_kinds(pages.limit(0), blocks)[0].count() == 0


def test_column_order(spark):
    rows = [("p", i, b) for i, b in column("l", 40, 200, [60, 170]) + column("r", 320, 200, [60, 170])]
    rows += [("q", i, b) for i, b in column("l", 40, 200, [60]) + column("r", 320, 200, [400])]
    rows += [("s", i, b) for i, b in column("l", 40, 200, [60]) + column("w", 100, 300, [200]) + column("r", 320, 200, [400])]
    df = spark.createDataFrame(rows, f"page string, id string, box {BOX}")
    for turned, want in ((False, ["l0", "l1", "r0", "r1"]), (True, ["r0", "r1", "l0", "l1"])):
        got = P.column_order(df, ["page"], turned).collect()
        assert [r.id for r in sorted((r for r in got if r.page == "p"), key=lambda r: r.position)] == want
        assert {r.reason for r in got if r.page == "q"} == {"column_order_ambiguous"} and {r.reason for r in got if r.page == "s"} == {"spanning_region_ambiguous"}


def test_reading_order(spark):
    """Header, leading titles, two columns, footer; a header below text, kinds without a place and a lane that spans columns escalate."""
    two = [("t0", "title", (40.0, 30.0, 560.0, 50.0)), ("t1", "title", (40.0, 52.0, 560.0, 58.0))] + [(i, "text", b) for i, b in column("l", 40, 200, [60, 170]) + column("r", 320, 240, [60, 170])]
    page = [("h", "header", (40.0, 0.0, 100.0, 20.0)), ("f", "footer", (40.0, 700.0, 100.0, 720.0)), *two]
    rows = [("p", *r) for r in page] + [("q", *r) for r in two] + [("q", "h", "header", (300.0, 400.0, 310.0, 420.0)), ("q", "s", "sidebar", (300.0, 500.0, 310.0, 520.0)), ("q", "c", "caption", (300.0, 600.0, 310.0, 620.0))]
    got = P.reading_order(spark.createDataFrame(rows, f"page string, id string, kind string, box {BOX}"), ["page"]).collect()
    assert [(r.id, r.part) for r in sorted((r for r in got if r.page == "p"), key=lambda r: r.position)] == [
        ("h", "header"), ("t0", "leading_title"), ("t1", "leading_title"), ("l0", "body"), ("l1", "body"), ("r0", "body"), ("r1", "body"), ("f", "footer")
    ]
    bad = [r for r in got if r.page == "q"]
    assert {r.position for r in bad} == {None} and set(bad[0].reasons) >= {"header_position_conflict", "unsupported_region_kind", "caption_association_required"}
