import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("quirewise.llm")

from quirewise.llm import abuse, encoding, leakage, lookalike, mixing, repeated_lines, scans, scanwords, splitting  # noqa: E402
from quirewise.llm.fmindex import FMIndex, WaveletTree, suffix_array  # noqa: E402
from quirewise.llm.linekeys import bands, masked_lines, signatures  # noqa: E402

PAGES = "page_id string, source string, book string, label string, text string, key string, cluster int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], PAGES)


def test_repeated_lines_by_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        body = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta".split(), k=6)) for _ in range(3)]
        if i % 3:
            body.insert(rng.randrange(3), rng.choice(["All Rights 20%d reserved!", "ALL RIGHTS %d RESERVED"]) % i)
        if i % 5 == 0:
            body.append(f"Leaf A-{i}")
        rows.append((f"p{i}", "s" if i % 2 else "t", f"b{i % 7}", f"a-{i}", "\n".join(body)))
    rows += [rows[1], ("px", "s", "b1", None, None), ("py", None, None, "", ""), ("pz", "s", "b1", None, "\n\n1234\n--")]
    want, by, of = set(), {}, {}
    for p, s, b, label, text in dict.fromkeys(rows):
        of.setdefault(s or "", set()).add(p)
        for i, k in enumerate(masked_lines(text, label)):
            if k:
                by.setdefault((s or "", k), []).append((p, b, i))
    for (s, _), v in by.items():
        if len({x[0] for x in v}) >= max(6, 0.03 * len(of[s])) and len({x[1] for x in v}) >= 2:
            want |= {(x[0], x[2]) for x in v}
    got = [(r.page_id, r.line_no) for r in repeated_lines.repeated_lines(pages(spark, rows)).collect()]
    assert set(got) == want and len(got) == len(want) and want
    near = {(r.page_id, r.line_no) for r in repeated_lines.repeated_lines(pages(spark, rows), similarity=0.8).collect()}
    assert near >= want
    clean = repeated_lines.without_lines(pages(spark, rows).distinct(), spark.createDataFrame(got, "page_id string, line_no int"))
    texts = {r.page_id: r.clean_text for r in clean.collect()}
    assert "ights" not in texts["p1"].lower() and texts["px"] is None and texts["py"] == ""
    assert "key" in clean.columns
    assert repeated_lines.repeated_lines(pages(spark, [])).count() == 0


def test_near_lines_are_linked_by_similarity(spark):
    from quirewise.llm.linekeys import similar

    rng = random.Random(9)
    word = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    notice = word(120)
    family = [notice[:i] + "zz" + notice[i + 2 :] for i in range(0, 112, 4)]  # on one page each
    frame = word(34)
    body = [frame[:17] + word(9) + frame[17:] for _ in range(60)]  # built alike, but less than 0.8 similar
    assert not any(similar(a, b, 0.8) for i, a in enumerate(body) for b in body[:i])
    rows = [(f"p{i}", "s", f"b{i % 4}", None, f"{family[i] if i < len(family) else ''}\n{body[i]}") for i in range(60)]
    got = {(r.page_id, r.line_no): r.cluster for r in repeated_lines.repeated_lines(pages(spark, rows), similarity=0.8).collect()}
    assert set(got) == {(f"p{i}", 0) for i in range(len(family))} and len(set(got.values())) == 1


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    same = []
    for _ in range(300):
        a = "".join(rng.choices("abcdefghij", k=60))
        b = a[:54] + "".join(rng.choices("klmn", k=6))
        x = bands(signatures([a, b, a]), 4)
        assert (x[0] == x[2]).all()
        same.append((x[0] == x[1]).any())
    assert np.mean(same) > 0.9  # Jaccard similarity about 0.8
    assert signatures(["", "a"]).shape == (2, 8)


def test_label_is_masked_as_a_word():
    assert masked_lines("Leaf iv of ivory", "IV") == ["leafofivory"]
    assert masked_lines(None, "x") == []


@pytest.fixture(scope="module")
def model():
    rng = random.Random(4)
    words = {
        "de": "größere Auflösung für Prüfung über Wärme später ungefähr Störung Übertragung".split(), "fr": "énergie régulière déjà décrite été à légère précédente matière élevée".split(),
        "ru": "если температура постоянна модель решётка внешняя граница энергия которую описал".split(), "en": "the pressure of each sample “term” – don’t shows 5 µm ± 3 °C".split(),
    }
    return encoding.train({k: [" ".join(rng.choices(v, k=12)) for _ in range(400)] for k, v in words.items()})


def test_encoding_round_trips(model):
    good = {"de": "für größere Wärme über Störung", "fr": "déjà décrite à énergie été", "ru": "если температура постоянна внешняя граница", "en": "“term” – don’t 5 µm ± 3 °C"}
    for text in good.values():
        assert encoding.restored(text, model) == (text, ())
    for lang, wrong in (("de", "cp1252"), ("fr", "latin-1"), ("fr", "mac_roman"), ("de", "cp437"), ("ru", "latin-1"), ("fr", "cp850")):
        bad = good[lang].encode().decode(wrong)
        assert encoding.repair(bad, model)[0] == good[lang], wrong
    twice = good["fr"].encode().decode("latin-1").encode().decode("latin-1")
    assert encoding.repair(twice, model)[0] == good["fr"]
    assert encoding.repair(good["ru"].encode("cp1251").decode("latin-1"), model)[0] == good["ru"]
    for text in ("Operator Â acts before Ã", "São Âge", "NARÃO and QUEÂNCIA", "√2 times ½"):
        assert encoding.repair(text, model)[1] == []
    assert encoding.repair("lost � here", model)[2]


def test_garbled_edges(spark, model):
    rows = [("f", "1", "fr", "été".encode().decode("cp1252"), 1), ("f", "2", "fr", None, 1), ("f", "3", None, "", 1), ("f", "4", "en", "plain " * 50_000, 1), ("f", None, "en", "Ã©", 1)]
    schema = "field string, record_key string, lang string, text string, restored int"
    df = spark.createDataFrame([*rows, rows[0]], schema)
    got = encoding.garbled(df, model).distinct().collect()
    assert [(r.record_key, r.restored, r.lost) for r in got] == [("1", "été", False)]
    assert encoding.garbled(df.limit(0), encoding.trained_on(df.limit(0))).count() == 0
    assert encoding.trained_on(df).dictionaries


def test_rare_characters_are_counted_over_all_records(spark):
    plain = "la température reste stable et la mesure est déjà décrite ici"
    rows = [("f", str(i), "fr", plain) for i in range(3000)] + [("f", f"r{i}", "fr", f"{plain} çò") for i in range(3)]
    model = encoding.trained_on(spark.createDataFrame(rows, "field string, record_key string, lang string, text string"), each=50)
    assert "ò" in model.bits  # in 3 of 3003 records, and likely in none of the sample
    bad = f"{plain} ò".replace("ò", "ò".encode().decode("latin-1"))
    assert encoding.repair(bad, model)[0] == f"{plain} ò"


def test_dictionaries_are_trained_on_all_records(spark):
    """the keys of the records, by which a sample was chosen, don't matter, and records of any length count."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=12)) for _ in range(400)]
    of = lambda rows, each: encoding.trained_on(spark.createDataFrame(rows, "record_key string, lang string, text string"), each).dictionaries["en"]
    short = [(f"a{i}", "en", t) for i, t in enumerate(texts)]
    assert of(short, 20) == of([(f"b{k}", lang, t) for k, lang, t in short], 20)
    long = "\n".join(["the quernstone of the polder"] * 1000)
    assert "quernstone".encode("utf-16-le") in of([*short, ("long", "en", long)], 800)


def test_lines_of_pairs_hold_the_counts():
    from collections import Counter

    lines = ["the rate of flow", "the rate  of heat", "a", "flow of heat"] * 3
    counted = lambda xs: Counter(p for x in xs for w in [["\n", *x.split(" "), "\n"]] for p in zip(w, w[1:]))
    made = encoding.lines_of(counted(lines))
    assert Counter(" ".join(made).split(" ")) - Counter(" ".join(lines).split(" ")) == Counter()
    assert sum((counted(made) - counted(lines)).values()) <= 2 and len(made) == len(lines)
    # Numbers that stand once in a larger text stand in for each other.
    assert sorted(encoding.lines_of({("\n", "of"): 1, ("of", "1.5"): 1, ("7.2", "m"): 1, ("m", "\n"): 1})) == ["of 1.5 m"]


def test_lookalikes_same_and_different():
    c = lookalike.Canonizer({"решётка": 5, "größer": 9, "сор": 4})
    same = [("ｐｒｅｓｓｕｒｅ", "pressure"), ("рrеѕѕurе", "pressure"), ("ﬁeld", "field"), ("été", "été"), ("pres​sure", "pressure"), ("5 K", "5 K"), ("well‐defined", "well-defined"), ("µm", "μm"), ("peшёткa", "решётка"), ("сор", "cop"), ("Å", "Å")]
    for a, b in same:
        assert c.text(a) == c.text(b), (a, b)
    assert c.text("peшёткa") == "решётка"
    for a, b in (("x²", "x2"), ("Kelvin", "kelvin"), ("a−b", "a-b"), ("a–b", "a-b"), ("½", "1/2"), ("a\nb", "a b")):
        assert c.text(a) != c.text(b), (a, b)


def test_lookalike_vocabulary_decides_rows(spark):
    """Letters of nearly one shape are resolved by the vocabulary alone: without its word the records stay apart."""
    rows = [("f", "1", "the pαper"), ("f", "2", "the paper"), ("f", "3", "αβ of α"), ("f", "4", "ab of a")]
    df = spark.createDataFrame(rows, "field string, record_key string, text string")
    known = spark.createDataFrame([("g", f"k{i}", "paper") for i in range(3)], "field string, record_key string, text string")
    assert lookalike.lookalike_pairs(df).count() == 0
    assert [tuple(r) for r in lookalike.lookalike_pairs(df.union(known)).collect()] == [("f", "1", "2")]
    few = lookalike.Canonizer({"paper": 5, "piper": 5, "вода": 3})
    assert few.text("pαper pαpεr вoда pιper") == "paper pαpεr вода piper"
    assert lookalike.Canonizer({"paper": 5, "pyper": 5}).automaton.reach("pαper", 1) == {"paper": 1}


def test_lookalike_automaton_by_brute_force():
    rng = random.Random(11)
    words = sorted({unicodedata.normalize("NFD", "".join(rng.choices("aоeаp", k=rng.randrange(1, 5)))) for _ in range(120)})
    alphabet = "aαаpрoоeе"

    def cost(token, word):
        look = lambda x: lookalike.fold(x)
        if len(token) != len(word):
            return 99
        return sum(0 if look(a) == look(b) else 1 if look(b) in lookalike._NEARLY.get(look(a), ()) else 99 for a, b in zip(token, word))

    for _ in range(200):
        token = "".join(rng.choices(alphabet, k=rng.randrange(1, 5)))
        for most in (0, 1, 2):
            want = {w: cost(token, w) for w in words if cost(token, w) <= most}
            assert lookalike.Automaton(words).reach(token, most) == want, (token, most)


def test_lookalike_classes(spark):
    rows = [("f", str(i), "pressure" if i % 3 else "рressure") for i in range(9)] + [("f", "x", "alone"), ("f", "y", "alone"), ("f", "0", "рressure")]
    df = spark.createDataFrame(rows, "field string, record_key string, text string")
    got = {r.record_key: (r.representative, r["size"], r.links) for r in lookalike.lookalike_classes(df).collect()}
    assert got == {str(i): ("0", 9, 3 if i % 3 else 6) for i in range(9)}
    lookalike.SPLIT, before = 2, lookalike.SPLIT
    try:
        assert lookalike.lookalike_pairs(df).count() == 18
    finally:
        lookalike.SPLIT = before


def test_lookalike_pairs(spark):
    rows = [("f", "1", "pressure"), ("f", "2", "рressure"), ("f", "3", "pressure"), ("f", "4", "Pressure"), ("g", "5", "pressurе"), ("f", "6", None), ("f", None, "pressurе"), ("f", "7", ""), ("f", "2", "рressure")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "field string, record_key string, text string, form int")
    assert sorted(map(tuple, lookalike.lookalike_pairs(df).collect())) == [("f", "1", "2"), ("f", "2", "3")]
    assert lookalike.lookalike_pairs(df.limit(0)).count() == 0
    made = lookalike.canonical(df, {}).collect()
    assert len(made) == len(rows) and {r.canonical_text for r in made if r.record_key == "2"} == {"pressure"}


BOOK = """\
LINEAR MICROMATRIX OF THE VESSEL
If the signal is amorphous, the hemigranule contra-
dicts neither the tight-
binding rnodel nor the vesse1. The end.
Another signal is here for the model
- l2 -"""


def test_scan_marks_and_paragraphs():
    clean = "If the signal is amorphous, the hemigranule contradicts neither the tight-binding model nor the vessel. The end. Another signal is here for the"
    v = scanwords.Vocabulary({w: 50 for w in scanwords.words_of(clean)})
    none = scans.Known()
    assert sorted(scans.marks(BOOK, "12", 11, none, v)) == [(0, "header"), (1, "hyphen"), (3, "misread"), (5, "page_number")]
    assert " ".join(scans.paragraphs(BOOK, "12", 11, none, v)) == clean.replace("for the", "for the model")
    said = lambda *lines: " ".join(x.text for x in scanwords.decode([x.split() for x in lines], v))
    assert said("(ves sel,") == "(vessel," and said("thesignal") == "the signal" and said("the tight-", "binding mo", "del") == "the tight-binding model"
    assert said("the sig-", "nal the ves", "sel") == "the signal the vessel"  # the stream runs over the line ends
    assert v.printed("x" * 5000) == []
    assert scans.marks("", None, None, none, v) == [] and scans.paragraphs("\n\n", None, None, none, v) == []
    assert scans.marks("vesse1", None, None, none, scanwords.Vocabulary({})) == []


def test_scan_confidence_decides_between_known_words():
    v = scanwords.Vocabulary({"modern": 100, "modem": 12, "the": 500})
    wrong = lambda c: [sorted(x.wrong) for x in scanwords.decode([["the", "modem"]], v, [[0.8, c]]) if x.wrong]
    assert wrong(0.8) == wrong(None) == wrong(0.99) == [] and wrong(0.6) == [[1]]


def test_scan_paragraph_boundaries_by_brute_force():
    """The cheapest of all sequences of boundaries; a boundary's cost depends on the one before it."""
    rng = random.Random(7)
    coupled = 0
    for _ in range(150):
        lines = [rng.choice(["It ends here.", "The line goes on and on", "and it ends.", "Short.", "A line as long as they get"]) for _ in range(rng.randrange(1, 9))]
        blank = [rng.random() < 0.2 for _ in lines]
        joined = {i for i in range(len(lines) - 1) if rng.random() < 0.1}
        width = max(map(len, lines))

        def cost(cuts):
            total, before = 0.0, True
            for i, x in enumerate(lines):
                ends, last = x[-1] in ".", i == len(lines) - 1
                if (i in joined and i in cuts) or (last and i not in cuts):
                    return float("inf")
                room = not last and len(x) + 1 + len(lines[i + 1].split()[0]) <= width
                if i in cuts:
                    total += (scans.LONE_LINE if ends else scans.LONE_FRAGMENT) if before else 0.0
                    total += 0.0 if last else scans.FITTING if (ends and room and lines[i + 1][0].isupper()) or blank[i] else scans.MISFIT
                elif i not in joined:
                    total += scans.ACROSS_BLANK if blank[i] else scans.MISSED if ends and room else 0.0
                before = i in cuts
            return total

        every = [{i for i in range(len(lines)) if m >> i & 1} for m in range(1 << len(lines))]
        got = scans.boundaries(lines, blank, joined)
        assert abs(cost(set(got)) - min(map(cost, every))) < 1e-9
        coupled += any(a + 1 == b for a, b in zip(got, got[1:]))
    assert coupled and scans.boundaries([], [], set()) == []


def test_scan_furniture_recurs(spark):
    """A short head of several books and a word beside page numbers are learned; a head of one book by its pages."""
    rows = [(f"{b}{i}", b, i, str(i + 1), f"{'TOPIC' if i % 2 else 'SECTION IV'}\nsome text of the body that is longer {b} {i}\nBlatt {i + 1}") for b in "abc" for i in range(8)]
    rows += [(f"d{i}", "d", i, str(i + 1), f"only here\nsome text of the body that is longer\nCase {7 * i + 3}") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id string, book string, page_index int, label string, text string")
    got = {(r.page_id, r.line_no): r.kind for r in scans.scan_noise(df, df.select("text")).collect()}
    assert all(got[p, 0] == "header" for p, *_ in rows) and all(got[p, 2] == "page_number" for p, *_ in rows if p[0] != "d")
    assert not any(p[0] == "d" and n == 2 for p, n in got)


def test_scan_tables(spark):
    schema = "page_id string, book string, page_index int, label string, text string, key string"
    rows = [("p1", "b", 11, "12", BOOK, "k"), ("p2", None, None, None, None, "k"), ("p3", "b", 2, None, "", "k"), ("p1", "b", 11, "12", BOOK, "k")]
    df = spark.createDataFrame(rows, schema)
    texts = spark.createDataFrame([("the model signal is amorphous vessel contradicts tight-binding " * 3,), (None,)], "text string")
    got = sorted(tuple(r) for r in scans.scan_noise(df, texts).collect())
    assert got == [("p1", 0, "header"), ("p1", 1, "hyphen"), ("p1", 3, "misread"), ("p1", 5, "page_number")]
    assert scans.scan_noise(df.limit(0), texts.limit(0)).count() == 0
    assert {r.page_id for r in scans.scan_paragraphs(df, texts).collect()} == {"p1"}


def test_scan_long_words_keep_their_reading(spark):
    words = "instrumentenkalibrierung instrumentenkalender electroencephalographically the signal".split()
    v = scanwords.Vocabulary({w: 50 for w in words})
    assert v.misread("1nstrumentenkal1br1erung").lower() == "instrumentenkalibrierung"
    assert v.misread("eleetroeneephalograpbically") == "electroencephalographically"  # three letters for letters
    texts = spark.createDataFrame([(" ".join(words * 3),), (None,)], "text string")
    mapped = scanwords.vocabulary(texts)
    assert [mapped.words[i] for i in range(len(mapped.words))] == sorted(words) and mapped.total == 15 and mapped.longest == 27
    assert mapped.count("signal") == 3 and mapped.count("zebra") == 0 and mapped.misread("1nstrumentenkal1br1erung").lower() == "instrumentenkalibrierung"


def test_scan_words_are_decoded_together():
    clean = "the instrument describes another reliable vessel of this model"
    v = scanwords.Vocabulary({w: 50 for w in clean.split()})

    def wrong(line):
        path = scanwords.decode([line.split()], v)
        return [any(i in x.wrong for x in path) for i in range(len(line.split()))]

    assert wrong("the instru rnent describes") == [False, False, True, False]  # split and misread: it shows where the character stands
    assert wrong("anothervesse1 model") == [True, False] and wrong("relia bleve55el") == [False, True]
    assert not any(wrong("the instru ment describes anothervessel")) and not any(wrong("Havhavdko of the model, Ilykesosk"))
    assert scans.marks("the reliable instru rnent\nof this model", "7", 6, scans.Known(), v) == [(0, "misread")]


def cut_by_walk(length, natural):
    out, s = [], 1
    while True:
        if length - s < 24:
            return [*out, (s, length)]
        fits = [e for e in natural if s + 7 <= e <= s + 23]
        e = max(fits) if fits else s + 23
        out.append((s, e))
        s = e - 1


def test_splitting_by_brute_force(spark):
    rng = random.Random(8)
    lengths = [(f"b{i}", rng.randrange(1, 300)) for i in range(30)] + [("n", None), (None, 50), ("b0", 3)]
    ends = [(f"b{rng.randrange(30)}", rng.randrange(-3, 310)) for _ in range(400)] + [("b1", None), ("zz", 9)]
    got = splitting.split_items(spark.createDataFrame([(*r, 1) for r in lengths], "item string, length int, first int"), spark.createDataFrame(ends, "item string, at int")).collect()
    longest = {}
    for k, n in lengths:
        if k and n:
            longest[k] = max(n, longest.get(k, 0))
    want = {(k, a, b) for k, n in longest.items() if n > 24 for a, b in cut_by_walk(n, {e for i, e in ends if i == k and e and 0 < e < n})}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    empty = spark.createDataFrame([], "item string, length int")
    assert splitting.split_items(empty, spark.createDataFrame([], "item string, at int")).count() == 0
    with pytest.raises(ValueError):
        splitting.split_items(empty, empty, 24, 2, 2)


def test_fm_index_by_brute_force():
    rng = np.random.default_rng(0)
    for n, alphabet in ((0, 3), (1, 3), (400, 4), (900, 60)):
        text = rng.integers(1, alphabet + 1, n)
        full = np.append(text, 0)
        assert suffix_array(full).tolist() == sorted(range(n + 1), key=lambda i: full[i:].tolist())
        index = FMIndex(text, alphabet)
        phrases = rng.integers(1, alphabet + 1, (50, 3))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [i for i in range(n - 2) if (text[i : i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    values = rng.integers(0, 13, 200)
    tree = WaveletTree(values, 4)
    assert tree.at(np.arange(200)).tolist() == values.tolist()
    assert tree.rank(np.array([5]), np.array([120]))[0] == (values[:120] == 5).sum()


def test_leakage(spark):
    item = "Which elongated glacier explains why a first-principles supercoupling can outlast the parapolymer placed beside it during the K3 trial?"
    broken = item.replace("supercoupling", "super-\ncoupling").replace("first-principles", "first-\nprinciples").upper()
    docs = [(1, f"x y. {item} z"), (2, f"**{broken}**"), (3, " ".join(item.split()[:10])), (4, None), (5, ""), (None, item), (6, item.replace("a", "а")), (1, f"x y. {item} z"), (7, "w " * 100_000 + item), (8, item.replace(" why", " (see) why").replace("during", "in"))]
    items = [(10, item), (11, "too short"), (12, None), (10, item)]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, item_id int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaked(d, i, shard_chars=100).collect()}
    assert got == {(1, 10), (2, 10), (6, 10), (7, 10), (8, 10)}
    assert {(r.doc_id, r.item_id) for r in leakage.leaked(d, i, block_words=5).collect()} == got
    assert leakage.leaked(d, i.limit(0)).count() == 0 and leakage.leaked(d.limit(0), i).count() == 0
    span = leakage.leaked(d.where("doc_id = 1").distinct(), i).collect()
    assert [(r.first_word, r.last_word) for r in span] == [(2, 2 + len(next(leakage.readings(leakage.plain(item), {"k3": 1}))[1]) - 1)]


def test_leakage_decides_each_break(spark):
    """A compound broken at its own hyphen beside a word that the typesetter broke; item texts may be broken themselves."""
    item = "one two three well defined state of the material was seen by all of us and welldefined ones"
    docs = [(1, "x one two three well-\ndefined state of the mate-\nrial was seen by all"), (2, "one two three welldefined state of the material was seen by all"), (3, item.replace("material", "mat-\nerial"))]
    broken = [(7, item), (8, "so far the long-\nrange order of this metal is not known at any low field")]
    docs += [(4, "so far the long range order of this metal is not known"), (5, "so far the longrange order of this metal is not known"), (6, "so far the other range order of this metal is not known")]
    got = {(r.doc_id, r.item_id) for r in leakage.leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(broken, "item_id long, text string"), least=10).collect()}
    assert got == {(1, 7), (3, 7), (4, 8), (5, 8)}


def test_mixture_shares(spark):
    rng = random.Random(6)
    sizes = [(i, s, rng.randrange(1, 200)) for i, s in enumerate(rng.choices(["a", "b", "c", "x"], weights=[60, 30, 10, 5], k=4000))]
    sizes += [sizes[0], (9001, "a", 0), (9002, None, 5)]
    targets = [("A", 0.2, 1), ("b", 0.5, 3), ("c", 0.2, 4), ("none", 0.1, 1), (None, 0.1, 1), ("c", None, None)]
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    s = spark.createDataFrame([(*r, 1) for r in sizes], "doc_id long, source string, tokens long, uses int")
    used = mixing.mixture(s, t).collect()
    most = {"a": 1, "b": 3, "c": 4}
    total = {}
    for r in used:
        assert 1 <= r.uses <= most[r.source]
        total[r.source] = total.get(r.source, 0) + r.uses * r.tokens
    everything = sum(total.values())
    for name, share in (("a", 0.2 / 0.9), ("b", 0.5 / 0.9), ("c", 0.2 / 0.9)):
        assert abs(total[name] / everything - share) < 0.005
    report = {r.source: r for r in mixing.mixture_report(s, t).collect()}
    assert report["none"].tokens == 0 and abs(report["b"].reached_share - total["b"] / everything) < 1e-9
    assert mixing.mixture(s.limit(0), t).count() == 0
    # The ranges of hashes change nothing, and a given total is met as far as the sources reach.
    used = {(r.doc_id, r.source): r.uses for r in mixing.mixture(s, t).collect()}
    assert {(r.doc_id, r.source): r.uses for r in mixing.mixture(s, t, each=7).collect()} == used
    asked = sum(r.tokens * r.uses for r in mixing.mixture(s, t, total=everything // 2).collect())
    assert abs(asked - everything // 2) < everything * 0.02


def test_abuse_held_out():
    rng = random.Random(7)
    nouns = [f"noun{i}" for i in range(60)]
    plain = ["The {} confirms the {} of the record.", "We compare the {} with a {} here.", "Stupid errors in the {} were counted by the {}."]
    bad = ["You are a stupid fool and so is your {}.", "All {} people are vermin.", "Hot n@ked pictures of {}, adults only."]

    def doc(abusive):
        parts = [rng.choice(plain).format(*rng.choices(nouns, k=2)) for _ in range(6)]
        if abusive:
            parts[rng.randrange(6)] = rng.choice(bad).format(rng.choice(nouns))
        return parts

    bags = []
    for _ in range(400):
        y = rng.random() < 0.2
        bags.append((doc(y), float(y if rng.random() > 0.05 else not y), 1))
    model = abuse.fit(bags, [doc(rng.random() < 0.03) for _ in range(400)])
    hits = sum(abuse.noisy_or(model.scores(doc(True))) >= model.threshold for _ in range(100))
    false = sum(abuse.noisy_or(model.scores(doc(False))) >= model.threshold for _ in range(100))
    assert hits >= 95 and false <= 3
    worst = doc(True)
    assert any(b.split("{}")[0][:8] in worst[int(model.scores(worst).argmax())] for b in bad)


def test_abuse_logit_by_brute_force():
    """A sentence's score is the sum over its distinct words, pairs in a row and pairs one apart."""
    rng = random.Random(3)
    bags = [([" ".join(rng.choices("all you are such a fool the noun of here".split(), k=5)) for _ in range(3)], 0.0, 1) for _ in range(60)]
    bags = [(b, float(any("you are" in x or "fool" in x for x in b)), n) for b, _, n in bags]
    model = abuse.fit(bags, [], least=1, lift=0.5)
    number = model.words | {"^": abuse.START, "$": abuse.END}
    assert model.weights
    for said in [x.split() for b, _, _ in bags[:20] for x in b] + [[], ["unknown"], ["fool"], ["you", "unknown", "you"]]:
        ends = ["^", *said, "$"]
        keys = {number[w] for w in said if w in number}
        keys |= {abuse.ROW | number[a] * abuse.WIDE + number[b] for a, b in zip(ends, ends[1:]) if a in number and b in number}
        keys |= {abuse.APART | number[a] * abuse.WIDE + number[b] for a, b in zip(ends, ends[2:]) if a in number and b in number}
        assert abs(model.logit(said) - model.bias - sum(model.weights.get(k, 0.0) for k in keys)) < 1e-9


def test_abuse_threshold():
    scores, labels = np.array([0.9, 0.8, 0.3, 0.01, 0.02]), np.array([True, True, True, False, False])
    assert 0.02 < abuse.best_threshold(scores, labels) < 0.3
    assert abuse.best_threshold(scores, labels | True) == abuse.best_threshold(scores[:0], labels[:0]) == 0.2


def test_abuse_spellings_and_edges(spark):
    for s in ("you are st​upid", "YOU ARE S-T-U-P-I-D", "you are 5tup1d", "you are s t u p i d", "you are ѕtupіd", "you are stuuuupid"):
        assert abuse.tokens(s) == ["you", "are", "stupid"], s
    empty = abuse.fit([], [])
    docs = spark.createDataFrame([(1, None, "A_b", 1), (2, "", "a-B ", 1), (None, "x", None, 1), (3, "fine. " * 20_000, None, 1)], "doc_id long, text string, source string, score int")
    scored = abuse.scored(docs, empty).collect()
    assert {r.doc_id: r.worst for r in scored}[1] == -1 and all(r.score < 1 or r.doc_id == 3 for r in scored)
    labels = spark.createDataFrame([(1, "r", 1), (1, "r", 1), (3, "q", None), (None, "q", 1)], "doc_id long, rater string, abusive int")
    bags, others = abuse.training(labels, docs)
    assert bags == [] and len(others) == 2
    rates = abuse.source_rates(docs, abuse.scored(docs, empty)).collect()
    assert {r.source: r.documents for r in rates} == {"a-b": 2, "": 1}
    assert abuse.scored(docs.limit(0), empty).count() == 0
    assert F is not None
