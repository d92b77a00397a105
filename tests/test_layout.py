import random

from pyspark.sql import functions as F

from quirewise.operators import layout as L
from quirewise.operators import pagelayout as P

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"

# Fixture pages: width, height, blocks.
FIXTURES = {
    "born-digital": (420.0, 300.0, [(54, 54, 269.798, 101.609)]),
    "two-column": (600.0, 420.0, [(330, 72, 449.779, 119.609), (54, 72, 181.732, 119.609)]),
    "footnote": (420.0, 420.0, [(54, 340, 268.632, 352.366), (54, 54, 147.533, 101.609)]),
    "sidebar": (600.0, 420.0, [(54, 72, 341.276, 119.609), (470, 92, 505.01, 135.281)]),
    "ambiguous-overlap": (420.0, 300.0, [(54, 80, 122.464, 127.609), (132, 82, 207.79, 129.609)]),
    "blank": (420.0, 300.0, []),
}


def test_layout_of_fixtures(spark):
    pages = spark.createDataFrame([(k, w, h, 0) for k, (w, h, _) in FIXTURES.items()] + [("turned", 1.0, 1.0, 90)], "page_id string, width double, height double, rotation int")
    rows = [(k, i, tuple(map(float, b))) for k, (_, _, bs) in FIXTURES.items() for i, b in enumerate(bs)]
    rows += [("turned", 0, (0.0, 0.0, 1.0, 1.0))]
    kinds, _ = P.page_kinds(pages, spark.createDataFrame(rows, f"page_id string, id long, box {BOX}"))
    got = {r.page_id: (r.kind, r.confidence) for r in kinds.collect()}
    assert {k: v[0] for k, v in got.items()} == {"born-digital": "one_column", "two-column": "multi_column", "footnote": "ambiguous", "sidebar": "ambiguous", "ambiguous-overlap": "ambiguous", "blank": "empty", "turned": "ambiguous"}
    assert got["footnote"][1] < 0.5 and got["sidebar"][1] < 0.5 and got["ambiguous-overlap"][1] == 0.25


def lines(spark, rows):
    return spark.createDataFrame([(p, i, t, tuple(map(float, b))) for p, i, t, b in rows], f"page_id string, line_id long, text string, box {BOX}")


def test_reconciliation_cases(spark):
    native = [("dup", 0, "Alpha beta", (5, 2, 80, 25)), ("geo", 0, "Repeated", (5, 2, 35, 15)), ("dis", 0, "Alpha beta", (5, 2, 80, 25)), ("amb", 0, "same", (0, 0, 10, 10)), ("amb", 1, "same", (0, 0, 10, 10))]
    ocr = [("dup", 0, "  alpha   BETA ", (5, 2, 80, 25)), ("geo", 0, "Repeated", (60, 30, 90, 45)), ("dis", 0, "Alpha zeta", (5, 2, 80, 25)), ("amb", 0, "same", (0, 0, 10, 10))]
    got = sorted((r.page_id, r.kind, r.native_id, r.ocr_id) for r in L.reconcile(lines(spark, native), lines(spark, ocr)).collect())
    assert sorted(got, key=str) == sorted(
        [("amb", "native_only", 0, None), ("amb", "native_only", 1, None), ("amb", "ocr_only", None, 0), ("dis", "disagreement", 0, 0), ("dup", "duplicate", 0, 0), ("geo", "native_only", 0, None), ("geo", "ocr_only", None, 0)], key=str
    )


def test_components_by_brute_force(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    parent = {i: i for i in range(161)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.id: r.component for r in L.components(spark.range(161), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in range(161)}


def test_near_boxes_and_grid(spark):
    rng = random.Random(4)
    boxes = [(0, i, tuple(float(v) for v in (x, y, x + 30, y + 10))) for i, (x, y) in enumerate((rng.randrange(900), rng.randrange(900)) for _ in range(60))]
    want = {(a[1], b[1]) for a in boxes for b in boxes if a[1] < b[1] and all(a[2][k] <= b[2][k + 2] + 24 and b[2][k] <= a[2][k + 2] + 24 for k in (0, 1))}
    assert {tuple(r) for r in L.near_boxes(spark.createDataFrame(boxes, f"page long, id long, box {BOX}"), ["page"]).collect()} == want
    tokens = [("r", 0, 0, "Header A", (60.0, 1.0, 116.0, 9.0)), ("r", 1, 0, "Header B", (310.0, 1.0, 365.0, 9.0)), ("r", 2, 1, "Cell A1", (60.0, 11.0, 99.0, 19.0))]
    grid = L.table_grid(spark.createDataFrame(tokens, f"selection_result_id string, order int, line_order int, text string, box {BOX}"))
    assert sorted((r.row, r.column, r.text) for r in grid.collect()) == [(0, 1, "Header A"), (0, 2, "Header B"), (1, 1, "Cell A1"), (1, 2, "")]
    assert grid.where(F.col("text") == "").count() == 1


def test_token_groups_in_one_pass_as_sql(spark, tmp_path):
    import duckdb

    from quirewise.plans import layout as Q

    rng, nan = random.Random(5), float("nan")
    pages = {f"r{k}": [(i, (x, y, x + rng.choice([30, 5, -20]), y + rng.choice([10, 40]))) for i, (x, y) in enumerate((rng.randrange(400), rng.randrange(400)) for _ in range(n))] for k, n in enumerate((0, 1, 30, 60))}
    # A staircase whose numbers jump, edges at exactly the gap and just beyond, sides and boxes that are null or NaN, an order twice, no order.
    pages["stairs"] = [(k * 37 % 120, (20 * k, 20 * k, 20 * k + 8, 20 * k + 8)) for k in range(120)]
    pages["edges"] = [(0, (0, 0, 10, 10)), (1, (22, 0, 30, 10)), (2, (42.000001, 0, 50, 10)), (3, (0, 22, 5, 30))]
    pages["odd"] = [(0, None), (1, (0, 0, None, 5)), (2, (0, 0, 5, 5)), (3, (nan, 0, nan, 5)), (4, (500, 0, 505, 5)), (5, (0, 600, 5, nan)), (6, (0, 900, 5, 905))]
    pages["twice"] = [(7, (0, 0, 5, 5)), (7, (900, 0, 905, 5)), (8, (10, 0, 15, 5)), (9, (890, 0, 895, 5)), (10, (450, 0, 455, 5))]
    pages["none"] = [(None, (0, 0, 5, 5)), (None, (1, 1, 5, 5)), (1, (2, 2, 5, 5))]
    rows = [(k, k, [(i, 0, "t", 1.0, b and tuple(v if v is None else float(v) for v in b)) for i, b in items]) for k, items in pages.items()]
    kind = f"selection_result_id string, page_id string, tokens array<struct<order:int,line_order:int,text:string,confidence:double,pixel_bounding_box:{BOX}>>"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/ocr_results.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW ocr_results AS SELECT * FROM '{tmp_path}/ocr_results.parquet/*.parquet'")
    want = sorted(db.sql(Q.SQL["token_groups"]).fetchall(), key=str)
    spark.sparkContext.setJobGroup("token_groups", "")
    try:
        groups = Q.token_groups(spark, str(tmp_path))
        got = [tuple(r) for r in groups.collect()]
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("token_groups"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8  # however long a chain is
    assert sorted(got, key=str) == want and (None, 1) in want
