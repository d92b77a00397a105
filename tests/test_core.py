import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quirewise.functions import geometry as G
from quirewise.functions import text as X
from quirewise.operators import corpus, equations, journal, scans, transcript
from quirewise.operators.incremental import IncrementalFolder, latest_covering_start, normal_state, pending_keys
from quirewise.sources import readers
from quirewise.streaming import events

T0 = datetime(2024, 1, 1)
ROWS = "sequence long, arrived_at timestamp, book string, chunk_number long, state string, extra string, row string"
RUNS = "first_sequence long, last_sequence long, started_at timestamp, outcome string"


def pending(spark, rows, runs):
    made = pending_keys(spark.createDataFrame(rows, ROWS), spark.createDataFrame(runs, RUNS), ["book", "chunk_number"], {"state": normal_state("state")})
    return sorted(map(tuple, made.collect()))


def test_pending_by_brute_force(spark):
    rng = random.Random(5)
    rows, runs = [], []
    for s in range(1, 120):
        if rng.random() < 0.9:
            row = (s, T0 + timedelta(hours=rng.randrange(100)), f"b{rng.randrange(4)}", rng.randrange(6), rng.choice([" Done", "done", "pending", None]), None, "x")
            rows += [row, (row[0], row[1] + timedelta(hours=3), *row[2:])] if rng.random() < 0.2 else [row]
    for _ in range(25):
        a = rng.randrange(0, 120)
        runs.append((a, a + rng.choice([0, 1, 7, 40, 200]), T0 + timedelta(hours=rng.randrange(110)), rng.choice(["Committed ", "failed", "COMMITTED"])))
    runs += [(None, 5, T0, "committed"), (9, 3, T0 + timedelta(days=9), "committed"), runs[0]]
    once = {}
    for r in rows:
        once[r[0]] = min(once.get(r[0], r), r, key=lambda x: x[1])
    keys = {}
    for s, r in once.items():
        taken = any(f is not None and f <= s <= la and r[1] <= st and o.strip().lower() == "committed" for f, la, st, o in runs)
        keys.setdefault((r[2], r[3]), []).append((s, r[4] and r[4].strip().lower(), taken))
    want = []
    for k, v in keys.items():
        done = [x for x in sorted(v, key=lambda x: x[0]) if x[2]]
        if not done or max(v, key=lambda x: x[0])[1] != done[-1][1]:
            want.append(k)
    assert pending(spark, rows, runs) == sorted(want)


def test_pending_edges(spark):
    row = (1, T0, "b", 1, None, "e", "r")
    assert pending(spark, [], []) == []
    assert pending(spark, [row, row], []) == [("b", 1)]
    assert pending(spark, [row, (2, T0, "b", 1, None, "other", None)], [(1, 1, T0, "committed")]) == []  # nothing changed
    assert pending(spark, [(None, T0, "b", 1, "x", "", ""), (3, None, "c", 2, "x", "", ""), (4, T0, None, 2, "x", "", "")], [(1, 9, T0, "committed")]) == [("c", 2)]


def test_covering_start_wide_ranges(spark):
    rows = spark.createDataFrame([(0,), (1,), (1000,), (2**40,)], "sequence long")
    runs = spark.createDataFrame([(0, 2**41, T0), (1, 1, T0 + timedelta(days=1))], "first_sequence long, last_sequence long, started_at timestamp")
    got = {r.sequence: r.covered_until for r in latest_covering_start(rows, runs).collect()}
    assert got == {0: T0, 1: T0 + timedelta(days=1), 1000: T0, 2**40: T0}


def test_incremental_folder_survives_failures(spark, tmp_path):
    folder = IncrementalFolder(spark, f"file://{tmp_path}/runs")
    source = spark.range(1, 11).withColumnRenamed("id", "sequence")
    assert folder.run(source.limit(0), lambda b: b) is None
    assert folder.run(source, lambda b: b)["watermark"] == 10

    def broken(batch):
        raise RuntimeError("lost")

    more = spark.range(1, 21).withColumnRenamed("id", "sequence")
    with pytest.raises(RuntimeError):
        folder.run(more, broken)
    (tmp_path / "runs/trial-of-another/data").mkdir(parents=True)
    assert folder.watermark() == 10
    assert folder.run(more, lambda b: b) == {"run": 2, "above": 10, "watermark": 20}
    assert folder.run(more, lambda b: b) is None
    assert sorted(r.sequence for r in folder.results().collect()) == list(range(1, 21))
    assert (tmp_path / "runs/trial-of-another").exists()  # a run in flight is left alone
    assert folder.vacuum() == 0 and folder.vacuum(0) == 1
    assert sorted(r.sequence for r in folder.results().collect()) == list(range(1, 21))


def test_incremental_folder_races(spark, tmp_path):
    folder = IncrementalFolder(spark, f"file://{tmp_path}/race")
    source = spark.range(1, 6).withColumnRenamed("id", "sequence")

    def overtaken(batch):
        folder.run(source, lambda b: b)
        return batch

    with pytest.raises(RuntimeError, match="another run"):
        folder.run(source, overtaken)
    assert folder.watermark() == 5 and sorted(r.sequence for r in folder.results().collect()) == [1, 2, 3, 4, 5]
    assert folder.run(source, lambda b: b) is None


@pytest.mark.parametrize("at", ["step", "_filled", "_commit"])
def test_incremental_folder_survives_failure_at(spark, tmp_path, monkeypatch, at):
    folder = IncrementalFolder(spark, f"file://{tmp_path}/fail")
    source = spark.createDataFrame([(1,), (2,), (5,)], "sequence long")

    def lost(*_):
        raise OSError("lost")

    if at != "step":
        monkeypatch.setattr(folder, at, lost)
    with pytest.raises(OSError):
        folder.run(source, lost if at == "step" else (lambda b: b))
    monkeypatch.undo()
    assert folder.watermark() is None
    assert folder.run(source, lambda b: b) == {"run": 1, "above": None, "watermark": 2}
    assert folder.run(spark.createDataFrame([(3,), (5,), (4,)], "sequence long"), lambda b: b)["watermark"] == 5
    assert sorted(r.sequence for r in folder.results().collect()) == [1, 2, 3, 4, 5]


def test_incremental_folder_takes_in_late_rows(spark, tmp_path):
    folder = IncrementalFolder(spark, f"file://{tmp_path}/late")
    run = lambda *s: folder.run(spark.createDataFrame([(x,) for x in s], "sequence long"), lambda b: b)
    assert run(5, 6, 9, 9) == {"run": 1, "above": None, "watermark": 6}
    assert run(5, 6, 9) is None
    assert run(5, 6, 7, 9, 12, None) == {"run": 2, "above": 6, "watermark": 7}  # 7 comes late
    assert run(2, 5, 6, 7, 8, 9, 12) == {"run": 3, "above": 7, "watermark": 9}  # 8 fills the gap, 2 lies below all
    assert run(2, 5, 6, 7, 8, 9, 12) is None
    assert sorted(r.sequence for r in folder.results().collect()) == [2, 5, 6, 7, 8, 9, 9, 12]


def test_suppression_by_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for image in range(6):
        for _ in range(12):
            x, y, w = rng.randrange(8), rng.randrange(8), rng.randrange(3, 9)
            rows.append((image, rng.choice([0.4, 0.6, 0.7, 0.9]), (float(x), float(y), float(x + w), float(y + w))))
    rows += [rows[0], (99, None, (0.0, 0.0, 1.0, 1.0)), (98, 0.9, None)]

    def iou(a, b):
        common = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        size = lambda c: (c[2] - c[0]) * (c[3] - c[1])
        return common / (size(a) + size(b) - common)

    want = set()
    for image in range(6):
        kept = []
        for _, s, b in sorted({(-r[1], r[1], r[2]) for r in rows if r[0] == image and r[1] >= 0.5}, key=lambda r: (r[0], r[2])):
            if all(iou(k, b) < 0.5 for k in kept):
                kept.append(b)
                want.add((image, s, b))
    boxes = spark.createDataFrame(rows, "image long, score double, box struct<x0:double,y0:double,x1:double,y1:double>")
    got = scans.admit_boxes(boxes, ["image"], "score", "box", iou=0.5).collect()
    assert {(r.image, r.score, tuple(r.box)) for r in got} == want and len(got) == len(want)


def test_running_mean_rows(spark):
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    lines = [("r", i, (0.0, y, 1.0, y + 10)) for i, y in enumerate((0.0, 10.0, 16.0, 60.0, 61.0))]
    got = scans.running_mean_rows(spark.createDataFrame(lines, f"selection_result_id string, order int, box {box}"), 18.0).first()
    assert got["rows"] == 2


def test_text_functions(spark):
    row = lambda c: spark.range(1).select(c.alias("x")).first().x
    for text, value in (("xiv", 14), (" 12 ", 12), ("MCMXC", 1990), ("x2", None), ("", None)):
        assert row(X.page_number_value(F.lit(text))) == value
    assert row(X.basic_clean(F.lit("a­\x07 b   c"))) == "a b c"
    assert row(equations.latex_wellformed(F.lit(r"\left( {a} \right)"))) and not row(equations.latex_wellformed(F.lit("}{"))) and not row(equations.latex_wellformed(F.lit(r"\begin{a}")))
    assert row(X.contains_phrase(F.lit("The Big, bad wolf"), F.lit("big bad"))) and not row(X.contains_phrase(F.lit("x"), F.lit("")))
    assert row(X.path_valid(F.lit("a/b.json"))) and not row(X.path_valid(F.lit("a/../b")))


def test_box_kinds(spark):
    schema = "b struct<x0:double,y0:double,x1:double,y1:double>"
    rows = [((0.0, 0.0, 1.0, 1.0),), ((0.0, 0.0, 0.0, 1.0),), ((2.0, 0.0, 1.0, 1.0),), ((-1.0, 0.0, 1.0, 1.0),), ((float("nan"), 0.0, 1.0, 1.0),), ((None, 0.0, 1.0, 1.0),), (None,)]
    got = [r.k for r in spark.createDataFrame(rows, schema).select(G.kind(F.col("b")).alias("k")).collect()]
    assert got == ["valid", "non_positive_area", "unordered", "negative_coordinate", "non_finite", "malformed", "malformed"]


def test_hyphen_decisions(spark):
    texts = [(1, "electronic-\nstructure"), (2, "tight-\nbinding and tight-binding"), (3, "inter-\nnational and international"), (4, None), (5, "")]
    got = {r.doc_id: r.decision for r in transcript.hyphen_decisions(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: "keep_break", 2: "keep_hyphen", 3: "join"}


def test_dense_order_is_whole(spark):
    df = spark.range(0, 1000, 3)
    got = {r.id: r.position for r in corpus.dense_order(df, F.shiftright("id", 6), F.col("id")).collect()}
    assert got == {x: i for i, x in enumerate(range(0, 1000, 3))}


def test_journal_publication_and_stream(spark, tmp_path):
    source, target = tmp_path / "in", f"file://{tmp_path}/journal"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps({"request_id": i, "payload_sha256": f"p{i}"}) for i in (1, 2, 2)))
    start = lambda: events.append_journal(spark, f"file://{source}", "request_id long, payload_sha256 string", target, f"file://{tmp_path}/state").awaitTermination()
    start()
    (source / "b.json").write_text("\n".join(json.dumps({"request_id": i, "payload_sha256": p}) for i, p in ((2, "other"), (3, "p3"), (1, "p1"))))
    start()
    start()
    rows = sorted((r.request_id, r.payload_sha256) for r in spark.read.parquet(target).collect())
    assert rows == [(1, "p1"), (2, "p2"), (3, "p3")]


def test_chain_breaks_across_blocks(spark):
    rows = [(i, f"s{i}", f"s{i - 1}" if i > 1 else None) for i in range(1, 40) if i != 20]
    rows[4] = (5, "s5", "wrong")
    got = journal.chain_breaks(spark.createDataFrame(rows, "sequence long, record_sha256 string, previous_record_sha256 string"), F.shiftright("sequence", 3)).collect()
    assert sorted((r.sequence, r.reason) for r in got) == [(5, "digest_mismatch"), (21, "sequence_gap")]


def test_sources(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.pdf").write_bytes(b"no")
    got = {r.path[-5:]: (r.byte_size, r.has_header) for r in readers.binary_files(spark, f"file://{tmp_path}").collect()}
    assert got == {"a.pdf": (10, True), "b.pdf": (2, False)}
    with pytest.raises(ValueError):
        readers.binary_files(spark, f"file://{tmp_path}", most_files=1)
    header = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "o.tsv").write_text(header + "5\t1\t1\t1\t1\t2\t20\t5\t9\t9\t80\tworld\n5\t1\t1\t1\t1\t1\t5\t5\t9\t8\t90\thello\n4\t1\t1\t1\t1\t0\t0\t0\t0\t0\t-1\t\n")
    line = readers.ocr_lines(readers.ocr_table(spark, f"file://{tmp_path}/o.tsv")).first()
    assert (line.text, line.x0, line.x1, line.y1, line.confidence) == ("hello world", 5, 29, 14, 85.0)
    item = {"source_id": "s", "pdf_path": "a.pdf", "output_directory": "o", "sha256": "0" * 64, "byte_size": 1}
    (tmp_path / "plan.json").write_text(json.dumps({"schema_version": 1, "items": [item]}))
    assert readers.batch_plan(spark, f"file://{tmp_path}/plan.json").count() == 1
    out = f"file://{tmp_path}/once"
    assert readers.publish_once(spark.range(3), out) == "created" and readers.publish_once(spark.range(3), out) == "unchanged"
    with pytest.raises(ValueError):
        readers.publish_once(spark.range(4), out)


def test_oversized_files_raise(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.pdf").write_bytes(b"no")
    with pytest.raises(ValueError, match="a.pdf"):
        readers.binary_files(spark, f"file://{tmp_path}", most_bytes=9)
    assert readers.binary_files(spark, f"file://{tmp_path}", most_bytes=10).count() == 2


def test_watermarked_windows_stream(spark, tmp_path):
    rows = [(i, T0 + timedelta(minutes=20 * i), "click", 1.0) for i in range(9)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double").write.parquet(f"file://{tmp_path}/ev")
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string, value double").parquet(f"file://{tmp_path}/ev")
    query = events.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.n for r in spark.table("w").collect()) == [3, 3, 3]


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert set(e.oracle_sql()) <= set(names)
    assert e.entry(spark).count() > 0
