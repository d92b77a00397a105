import random

import pytest
from pyspark.sql import functions as F

from quirewise import base
from quirewise.functions import contract as K
from quirewise.functions import text as X
from quirewise.operators import composition, detections, equations, records, transcript
from quirewise.operators.states import StateStore
from quirewise.sources import extractors, readers

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column(F.col("t")).alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.i)]


def test_strict_json(spark):
    texts = ['{"a":1,"b":[1,{"a":2}]}', '{"a":1,"a":1}', "[NaN]", "[1e999]", '{"a":}', "[" * 70 + "]" * 70, '"[[[{{{\\"["', None, "", "x" * 1_000_001]
    assert values(spark, texts, K.json_status()) == ["ok", "duplicate_key", "not_finite", "ok", "malformed", "too_deep", "ok", None, "malformed", "too_long"]


def test_language_tags(spark):
    tags = {"EN": "en", "zh-yue-HANT-hk": "zh-yue-Hant-HK", "de-419-1994": "de-419-1994", "sl-rozaj-ROZAJ": None, "en-u-co-x-AB": "en-u-co-x-ab", "en-u-co-u-nu": None, "X-abc": "x-abc", "en_US": None, "e": None, "": None, "en-": None, "en-u": None, None: None}
    assert values(spark, list(tags), K.language_tag) == list(tags.values())


def test_normal_forms(spark):
    texts = ["ＡＢ  c ß", "é", None, ""]
    assert values(spark, texts, K.matched_form) == ["ab c ss", "é", None, ""]
    assert values(spark, texts, K.collision_form) == ["ＡＢ c ß", "é", None, ""]
    assert values(spark, texts, K.label_form) == ["ａｂ c ss", "é", None, ""]


def test_headings_and_front(spark):
    lines = ["Appendix A: Data", "References", "2.1) Results of it", "3 samples", "Results and  Discussion", "no heading", "", None, "Appendix"]
    got = values(spark, lines, X.heading)
    assert [g and (g.kind, g.level, g.label, g.title) for g in got] == [
        ("appendix", 1, "A", "Data"), ("bibliography", 1, None, "References"), ("subsection", 2, "2.1", "Results of it"), ("section", 1, "3", "samples"), ("section", 1, None, "Results and Discussion"), None, None, None, ("appendix", 1, None, "Appendix")
    ]
    docs = {1: ["A title", "by One and Two", "Abstract", "first", "second", "Keywords: a, b", "1 Start", "text"], 2: ["Abstract: all in one", "Authors: X"], 3: ["intro", "Real Title", "x"], 4: ["", " "]}
    df = spark.createDataFrame([(d, i, x) for d, xs in docs.items() for i, x in enumerate(xs)], "doc_id int, ordinal int, line string")
    titles = spark.createDataFrame([(1, None), (3, "REAL  title")], "doc_id int, title string")
    rows = {(r.doc_id, r.kind): (r.ordinal, r.lines, r.title, r.confidence) for r in transcript.front_matter(df, titles).collect()}
    assert rows == {
        (1, "title"): (0, 1, "A title", 0.45), (1, "author"): (1, 1, "One and Two", 0.95), (1, "abstract"): (2, 3, "Abstract", 0.95), (1, "keywords"): (5, 1, "a, b", 0.98),
        (2, "abstract"): (0, 1, "Abstract", 0.95), (3, "title"): (1, 1, "Real Title", 0.98),
    }
    nodes = {(r.doc_id, r.ordinal): (r.kind, r.parent_ordinal) for r in transcript.article_nodes(df, titles).collect()}
    assert nodes[1, 6] == ("section", -1) and nodes[1, -2] == ("front_matter", -1) and (4, -1) not in nodes


def test_section_parents_by_brute_force(spark):
    rng = random.Random(1)
    rows = [(d, i, rng.randrange(1, 15)) for d in range(4) for i in range(30)]
    got = {(r.doc_id, r.ordinal): r.parent_ordinal for r in transcript.section_parents(spark.createDataFrame(rows, "doc_id int, ordinal long, level long")).collect()}
    for d, i, level in rows:
        above = [j for e, j, k in rows if e == d and j < i and min(k, transcript.LEVELS) < min(level, transcript.LEVELS)]
        assert got[d, i] == max(above, default=None)


def test_page_numbers(spark):
    """A run in one place, a figure in the text, a label, two labels, typed content, and numbers that don't go on."""
    margin, body = (680.0, 1900.0, 720.0, 1990.0), (680.0, 900.0, 720.0, 990.0)
    rows = [("d", f"p{i}", i, 9, None, str(i + 4), margin, False) for i in range(4)] + [("d", f"p{i}", i, 1, None, str(i + 40), body, False) for i in range(4)]
    rows += [("e", "q0", 0, 0, "XII", "xii", margin, False), ("e", "q1", 1, 0, "5", "5", margin, False), ("e", "q1", 1, 1, "5", " 5 ", margin, False), ("e", "q2", 2, 0, "7", "7", margin, True), ("e", "q9", 9, 0, None, "80", margin, False), ("e", "q3", 3, 0, None, "no", margin, False)]
    df = spark.createDataFrame(rows, f"document string, page_id string, page_index int, ordinal int, label string, text string, box {BOX}, protected boolean").withColumn("width", F.lit(1400.0)).withColumn("height", F.lit(2000.0))
    got = {(r.page_id, r.ordinal): r.method for r in transcript.page_number_classes(df).collect()}
    assert all(got[f"p{i}", 9] == "recurring_geometry_sequence" and got[f"p{i}", 1] == "outside_margin" for i in range(4))
    assert (got["q0", 0], got["q1", 0], got["q2", 0], got["q9", 0]) == ("printed_page_label", "insufficient_evidence", "typed_content", "insufficient_evidence") and ("q3", 0) not in got


def test_equation_cases(spark):
    texts = ["E = m c^2 (3.1)", "We took I = O here", "$x=1$ inline", "\\alpha", "a b", "plain words of a sentence = with x and more words", "", None]
    df = spark.createDataFrame([(i, t, (200.0, 0.0, 400.0, 10.0)) for i, t in enumerate(texts)], f"i int, t string, box {BOX}")
    got = {r.i: r.display for r in equations.display_evidence(df, "t", "box", 612.0).collect()}
    assert got[0].label == "(3.1)" and got[0].confidence == round(0.55 + 0.12 + 0.12 + 0.08, 6) and got[0].status == "proposed"
    assert got[3].commands == 1 and [got[i] for i in (2, 4, 5, 6, 7)] == [None] * 5
    made = {r.i: r for r in equations.assemblies(df.withColumn("fragments", F.array("t")), "fragments", "box", 612.0).collect()}
    assert made[1].rejected and made[1].prefilter == ["io_typographic_false_positive"] and made[2].kind == "inline"


def test_inline_equations(spark):
    text = "so $y = 2$; and x = 3 + z, but \\(a^2\\) and $plain$ ab = 4"
    got = values(spark, [text, None], composition.inline_equations)
    assert [(text[e.start : e.stop], e.method) for e in got[0]] == [("y = 2", "dollar_delimited"), ("x = 3 + z", "relational_inline"), ("a^2", "latex_parenthesis_delimited")] and got[1] is None


def test_edges_by_brute_force(spark):
    rng = random.Random(9)
    for _ in range(3):
        nodes = list("abcdefgh")
        edges = [(rng.choice(nodes), rng.choice([*nodes, "?"])) for _ in range(9)]
        got = {(r.a, r.b, r.finding) for r in records.edge_findings(spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "a string, b string")).collect()}
        plain = {(a, b) for a, b in edges if a != b and b != "?"}
        reach = set(plain)
        while more := {(a, d) for a, b in reach for c, d in plain if b == c} - reach:
            reach |= more
        cyclic = {a for a, b in reach if a == b}
        before, behind = {a for a, b in reach if b in cyclic} | cyclic, {b for a, b in reach if a in cyclic} | cyclic
        want = {(a, b, "unknown") for a, b in edges if b == "?"} | {(a, b, "self") for a, b in edges if a == b} | {(*e, "duplicate") for e in edges if edges.count(e) > 1}
        assert got == want | {(a, b, "cyclic") for a, b in plain if a in behind and b in before}


def test_clusters_and_columns(spark):
    df = spark.createDataFrame([("k", v) for v in (0.0, 10.0, 31.0, 60.0, 61.0)] + [("k", None)], "k string, value double")
    clusters = detections.value_clusters(df, "k", 24.0)
    assert [(r.cluster, r["mean"], r.n) for r in sorted(clusters.collect(), key=lambda r: r.cluster)] == [(0, 5.0, 2), (1, 31.0, 1), (2, 60.5, 2)]
    items = spark.createDataFrame([("k", i, (x, 0.0, x + 2, 1.0)) for i, x in enumerate((-50.0, 16.0, 18.0, 900.0))], f"k string, id int, box {BOX}")
    assert [r.column for r in sorted(detections.columns_of(items, clusters, "k").collect(), key=lambda r: r.id)] == [0, 0, 1, 2]


def test_projection_collisions(spark):
    blocks = spark.createDataFrame([("p", 1, "raw", "Figure  1. é"), ("p", 2, "table", "t"), ("p", 3, "heading", "h")], "page string, id int, kind string, text string")
    captions = spark.createDataFrame([("p", 9, "Figure 1. é")], "page string, id int, text string")
    kept, collisions = composition.projected_pages(blocks, captions, ["page"])
    assert sorted(r.kind for r in kept.collect()) == ["caption", "heading", "raw"] and [(r.id, r.caption) for r in collisions.collect()] == [(1, 9)]


def test_state_store(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/states", "book", ("source",))
    state = lambda *rows: spark.createDataFrame(rows, "book string, source string, stage string")
    events = lambda *rows: spark.createDataFrame(rows, "event_id string, what string")
    assert store.snapshot() == 0 and store.save(state(("a", "s", "new")), 0, events(("e1", "first"))) == 1
    assert store.save(state(("a", "s", "done"), ("b", "s", "new")), 1, events(("e1", "again"), ("e2", "second"))) == 2
    with pytest.raises(RuntimeError, match="since"):
        store.save(state(("a", "s", "lost")), 1)
    for wrong in (state(("a", "other", "x"), ("b", "s", "x")), state(("a", "s", "x")), state(("a", "s", "x"), ("a", "s", "y"), ("b", "s", "x"))):
        with pytest.raises(ValueError):
            store.save(wrong, 2)
    assert store.snapshot() == 2 and sorted(map(tuple, store.load().collect())) == [("a", "s", "done"), ("b", "s", "new")] and store.load(1).count() == 1
    assert sorted((r.event_id, r.what) for r in store.events().collect()) == [("e1", "first"), ("e2", "second")]


def test_steps_and_pipelines(spark):
    class Doubled(base.Projector):
        contract, needs, gives = "doubled", ("rows",), ("id", "twice")

        def act(self, *, rows):
            return rows.withColumn("twice", F.col("id") * 2)

    rows = spark.range(3)
    out = base.Pipeline(Doubled(), base.Inventory("id", lambda r: F.col("twice").cast("string")))(rows=rows)
    assert out.first()["rows"] == 3 and base.Pipeline(Doubled()).identity != base.Pipeline(Doubled(), Doubled()).identity
    with pytest.raises(ValueError, match="needs rows"):
        Doubled()()
    votes = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 0), ("c", None)], "k string, value int")
    got = {r.k: (r.status, r.value) for r in base.Consensus(("k",))(rows=votes).collect()}
    assert got == {"a": ("admitted", 1), "b": ("no_consensus", None), "c": ("too_few", None)}
    assert base.Consensus(("k",)).identity != base.Consensus(("k",), base.ConsensusPolicy(3)).identity


def test_extractors(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\n\ntwo\f\n\f" + "long " * 30)
    (tmp_path / "sub/b.txt").write_text("")
    spark.dataSource.register(extractors.PagedText)
    rows = spark.read.format("paged_text").option("path", str(tmp_path)).load().collect()
    assert sorted((r.page_index, r.ordinal, r.text.strip()) for r in rows) == [(0, 0, "one"), (0, 1, "two"), (2, 0, ("long " * 30).strip())]
    files = spark.createDataFrame([("a", bytearray((tmp_path / "a.txt").read_bytes())), ("n", None)], "source string, content binary")
    pages = extractors.page_evidence(extractors.extracted(files, extractors.PlainText())).collect()
    assert sorted((r.page_index, r.blocks, r.warning) for r in pages) == [(0, 2, "low_text_page"), (1, 0, "low_text_page"), (2, 1, None)]


def test_publish_once_leaves_nothing_half_done(spark, tmp_path):
    out = f"file://{tmp_path}/artifacts"
    (tmp_path / "artifacts/data-left").mkdir(parents=True)
    assert readers.publish_once(spark.range(3), out) == "created" and readers.publish_once(spark.range(3), out) == "unchanged"
    assert readers.published(spark, out).count() == 3
    with pytest.raises(ValueError):
        readers.publish_once(spark.range(4), out)
    assert readers.schema_problems(spark.range(1), {"id": "string", "x": "int"}) == ["missing x", "type of id: bigint"]
