"""Golden cases on tiny inline rows, worked out by hand from the rules, plus
brute-force checks of the operators that have no SQL oracle."""

from pyspark.sql import functions as F

from wikisift.functions import markup as M
from wikisift.functions import templates as TF
from wikisift.operators import enrich as EN
from wikisift.operators import lines as L
from wikisift.operators import templates as OT
from wikisift.operators.corpus import corpus, vocabulary


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn(F.col("t")).alias("r")).first()["r"]


def test_drop_nested_templates(spark):
    assert one(spark, "a {{x|{{y}}}} b", M.drop_templates) == "a  b"
    assert one(spark, "a {{x {{y}} c", M.drop_templates) == "a {{x  c"
    assert one(spark, "a }} b", M.drop_templates) == "a }} b"
    deep = "x" + "{{" * 12 + "z" + "}}" * 12 + "y"
    assert one(spark, deep, M.drop_templates) == "xy"


def test_internal_links(spark):
    f = M.internal_links
    assert one(spark, "[[Page 3|label]]s", f) == "labels"
    assert one(spark, "[[A|b|c]]", f) == "b|c"
    assert one(spark, "[[File:x.png|thumb|cap [[Page 4]]]]", f) == ""
    assert one(spark, "[[w:Foo|bar]]", f) == "bar"
    assert one(spark, "[[:Category:X|y]]", f) == ""
    assert one(spark, "[[Page|thumb|cap [[X]]]] [[P|a [[Q|b|c]] d]]", f) == "cap X a b|c d"
    assert one(spark, "[[Image:x|y]]", lambda c: f(c, namespaces=["Image"])) == "y"
    assert one(spark, "[[A b/é|t]]", lambda c: f(c, keep_links=True)) == '<a href="A%20b/%C3%A9">t</a>'


def test_external_links_and_emphasis(spark):
    assert one(spark, "[http://a.example/b the label] [http://a.example]", M.external_links) == "the label "
    assert one(spark, "[http://a.b http://c.d/e.png]", M.external_links) == ""
    assert one(spark, "[http://a.b/é x] y", lambda c: M.external_links(c, True)) == '<a href="http%3A//a.b/%C3%A9">x</a> y'
    assert one(spark, "'''Bold''' and ''it'' and '''''both'''''", M.emphasis) == 'Bold and "it" and both'


def test_unescape_and_placeholders(spark):
    assert one(spark, "&amp;nbsp; &#65;&#x42; &bogus; &lt;", M.unescape_entities) == "&nbsp; AB &bogus; <"
    got = one(spark, "<math>x</math> <code>y</code> <math>z</math> <math>x</math>", lambda c: M.placeholder_numbering_one(M.placeholder_numbering_one(c, "math", "formula"), "code", "codice"))
    assert got == "formula_1 codice_1 formula_2 formula_1"


LINE_CASES = [
    ("one\n\ntwo", "one\ntwo"),
    ("== H ==\nfirst\nsecond", "first\nsecond"),
    ("== H ==\n pre kept as the first of its section\n pre dropped\nrest", " pre kept as the first of its section\nrest"),
    (" pre at the top", ""),
    ("* item\n(after a list)\n(x)", "(after a list)"),
    ("# a\n: colon lines change nothing\n| cell", "| cell"),
    ("{| table\n|cell\nend}\n(note)\n---\n.-.\nkept", "kept"),
    ("++Title++\n++Really?++\n++++", "Title.\nReally?"),
    ("== A ==\n=== B ===\n* item\nx\n y\n z", "x\n y"),
    ("", ""),
]


def both_forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "page_num long, text string")
    folded = {r["page_num"]: r["t"] for r in df.select("page_num", L.compact_text("text").alias("t")).collect()}
    windowed = {r["page_num"]: r["text"] for r in L.reassemble(L.render_lines(L.to_lines(df))).collect()}
    return [folded[i] for i in range(len(texts))], [windowed.get(i, "") for i in range(len(texts))]


def test_compact_cases(spark):
    folded, windowed = both_forms(spark, [t for t, _ in LINE_CASES])
    assert folded == windowed == [w for _, w in LINE_CASES]


def test_compact_forms_agree_and_are_stable(spark):
    import random

    rnd = random.Random(7)
    pool = ["== H ==", "=== S ===", " pre", "text", "* item", "# n", ": ind", "(x)", "---", "{|", "|c", "end}", "++T++", "", "more"]
    pages = ["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    folded, windowed = both_forms(spark, pages)
    assert folded == windowed
    # every kept line comes from the page, in order; text without structure stays
    for page, out in zip(pages, folded):
        lines = iter(page.split("\n"))
        assert all(any(x == y or y == f"++{x[:-1]}++" for y in lines) for x in out.split("\n") if x)
    assert both_forms(spark, ["text\nmore\ntext"])[0] == ["text\nmore\ntext"]


FLAG_CASES = [
    ("== A ==\n=== B ===\nx\n y\n== C ==\n== D ==\n z", dict(sections=True), "A.\nB.\nx\nD.\n z"),
    ("== A ==\n=== B ===\n== C ==\nx", dict(sections=True), "C.\nx"),
    ("=== A ===\n== B ==\n=== C? ===\nx", dict(sections=True), "B.\nC?\nx"),
    ("== A ==\n* i\ntail\nx\n y", dict(lists=True), "A.\n- i\ntail"),
    ("* a\n#\n*** b\n## c\n; d", dict(lists=True), "- a\n-  b\n1. c\n- d"),
    ("== A ==\nx\n* i\ny\nz", dict(sections=True, lists=True), "A.\nx\n- i\ny\nz"),
    ("== A ==\nx\n* i\n** j\ny\nz", dict(html=True), "<h2>A</h2>\nx\n<ul>\n<li>i</li>\n<ul>\n<li>j</li>\ny\n</ul>\n</ul>\nz"),
    ("; t\n* u\n# v", dict(html=True), "<dl>\n<dt>t</dt>\n<li>u</li>\n</ul>\n<ol>\n<li>v</li>"),
]


def test_line_flags(spark):
    for text, flags, want in FLAG_CASES:
        df = spark.createDataFrame([(1, text)], "page_num long, text string")
        assert L.reassemble(L.render_lines(L.to_lines(df), **flags)).first()["text"] == want


def test_compact_is_linear(spark):
    import time

    page = "\n".join(f"line {k} of a long page" for k in range(40_000))
    df = spark.createDataFrame([(1, page)], "page_num long, text string").select(F.length(L.compact_text("text")).alias("n"))
    df.collect()
    t0 = time.time()
    assert df.collect()[0]["n"] == len(page)
    assert time.time() - t0 < 10


def test_parser_functions(spark):
    rows = [
        ("#if", [" x ", " yes ", " no "], "yes"),
        ("#if", ["  ", "yes", " no "], "no"),
        ("#ifeq", ["a", "a ", "t", "f"], "t"),
        ("#ifeq", ["a", "", "t", "f"], ""),
        ("#switch", ["b", "a=1", "b", "c=3", "#default=d"], "3"),
        ("#switch", ["z", "a=1", "#default=d"], "d"),
        ("#switch", ["b", "a|b=2"], "2"),
        ("int", [" 42 "], "42"),
        ("int", ["4x"], ""),
        ("#time", ["x"], ""),
        ("#invoke:convert", ["5", "km"], "5 km"),
        ("#invoke:If empty", ["", "", "v"], "v"),
        ("urlencode", ["a b/c"], "a%20b/c"),
    ]
    df = spark.createDataFrame(rows, "name string, args array<string>, want string")
    got = df.select("want", TF.pf_dispatch(F.col("name"), F.col("args")).alias("got")).collect()
    for r in got:
        assert r["got"] == r["want"]


def test_call_params_map(spark):
    df = spark.createDataFrame([(["a", "", "c", "2=B", " k = v "],)], "p array<string>")
    m = df.select(TF.call_params_map("p").alias("m")).first()["m"]
    assert m == {"1": "a", "2": "B", "3": "c", "k": "v"}


def test_expand_templates(spark):
    tpl = spark.createDataFrame(
        [(1, "Template:Hi", "Hi {{{1|x}}} {{{k|}}}"), (2, "Template:Q", "p<onlyinclude>Q</onlyinclude>r"),
         (3, "Template:Hi", "Hello {{{1|x}}}{{{k|}}}")],
        "page_num long, title string, body string",
    )
    cat = OT.template_catalog(tpl)
    pages = spark.createDataFrame(
        [(10, "P", "a {{Hi|{{Q}}|k=v}} b {{gone}} {{#if: x | y | z}} {{PAGENAME}}")], "page_num long, title string, text string"
    )
    out = OT.expand_templates(pages, cat).first()
    assert out["text"] == "a Hello Qv b  y P"
    nulls = spark.createDataFrame([(1, "P", None), (2, "P", "plain"), (3, "P", "{{Hi}}")], "page_num long, title string, text string")
    assert sorted((r["page_num"], r["text"]) for r in OT.expand_templates(nulls, cat).collect()) == [(1, None), (2, "plain"), (3, "Hello x")]


def test_lexicon_enrich_brute_force(spark):
    lex = spark.createDataFrame([("new", "c1"), ("new york", "c2"), ("york", "c3"), ("city", "c4")], "surface string, concept_id string")
    s = spark.createDataFrame([(1, 0, 0, ["New", "York", "city", "and", "york"])], "doc_id long, par_no int, sent_no int, tokens array<string>")
    r = EN.lexicon_enrich(s, lex).first()
    assert r["word_tokens"] == ["New_York", "city", "and", "york"]
    assert r["id_tokens"] == ["c2", "c4", "and", "c3"]
    longer = lex.unionByName(spark.createDataFrame([("york city and york", "c5")], "surface string, concept_id string"))
    assert EN.longest_surface(longer) == 4
    again = EN.lexicon_enrich(spark.createDataFrame([(1, 0, 0, ["york", "city", "and", "york", "x"]), (2, 0, 0, [])], s.schema), longer)
    got = {r["doc_id"]: r["id_tokens"] for r in again.collect()}
    assert got == {1: ["c5", "x"], 2: []}
    totals = {r["doc_id"]: (r["matches"], r["concepts"], r["is_total"]) for r in EN.enrichment_stats(EN.lexicon_enrich(s, lex)).collect()}
    assert totals == {1: (3, 3, False), None: (3, 3, True)}


def test_unicode_white_space_and_marks(spark):
    df = spark.createDataFrame([(1, "\u00a0\u2003\n\u3000a\u00a0b\u0301c \u2009\n\x1c\x85")], "doc_id long, text string")
    assert [tuple(r) for r in corpus(df).collect()] == [(1, 1, 0, ["a", "b\u0301c"])]


def test_sentences_by_language(spark):
    rows = [(1, "Dr. Smith met J. Doe. He left! No. 5 stays? Yes.", "en"), (2, "Das ist z.B. gut. Hr. Meier kam.", "de"), (3, "Hr. Meier kam.", "en"), (4, "La Sra. Paz vino. Fin.", "es"), (5, "Dr. X. left.", "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in sorted(corpus(df).collect(), key=lambda r: (r["doc_id"], r["sent_no"])):
        got.setdefault(r["doc_id"], []).append(" ".join(r["tokens"]))
    assert got == {1: ["Dr . Smith met J . Doe .", "He left !", "No . 5 stays ?", "Yes ."], 2: ["Das ist z . B . gut .", "Hr . Meier kam ."],
                   3: ["Hr .", "Meier kam ."], 4: ["La Sra . Paz vino .", "Fin ."], 5: ["Dr . X . left ."]}


def test_fixture_has_input_for_every_step(spark):
    """Each cleaning step changes some row of the fixture, so that its check bites."""
    from wikisift.plans.fixtures import wikipages

    steps = [M.drop_templates, M.drop_tables, M.external_images, M.external_links, M.internal_links, M.behaviour_switches, M.syntaxhighlight_keep, M.emphasis, M.drop_comments,
             M.drop_selfclosing, M.drop_elements, M.unescape_entities, M.guillemets, M.squeeze_space, M.squeeze_dots, M.punct_space, M.drop_punct_lines, M.fix_commas, M.escape_doc]
    pages = wikipages(spark, "/root/testdata/sf0.001")
    row = pages.select(*[F.sum((f(F.col("text")) != F.col("text")).cast("int")).alias(f.__name__) for f in steps]).first()
    assert {k: v for k, v in row.asDict().items() if not v} == {}


def test_control_characters_stay(spark):
    text = "a\x01b\x02c\x03 {{x}} [[p|q]] d\x05"
    assert one(spark, text, lambda c: M.internal_links(M.drop_templates(c))) == "a\x01b\x02c\x03  q d\x05"


def test_nested_paths_agree(spark):
    import random

    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["{{", "}}", "x", "{", "}", " "]) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", M.drop_templates("t").alias("a"), M.nested_fold(F.col("t"), r"\{\{", r"\}\}").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


def test_clean_articles_flags(spark):
    from wikisift.operators.articles import clean_articles

    text = "== H ==\n* {{#if:x|[[P|item]]|no}}\nafter {{PAGENAME}} & [http://a.b l]\n"
    df = spark.createDataFrame([(1, "T", text), (2, "U", None)], "page_num long, title string, text string")
    run = lambda **k: {r["page_num"]: r["text"] for r in clean_articles(df, **k).collect()}
    assert run()[1] == "after T & l"
    assert run(lists=True)[1] == "H.\n- item\nafter T & l"
    assert run(html=True)[1] == "<h2>H</h2>\n<ul>\n<li>item</li>\nafter T & l\n</ul>"
    assert run(escape=True)[1] == "after T &amp; l"
    assert run(links=True, sections=True)[1] == 'after T & <a href="http%3A//a.b">l</a>'
    assert run(expand=False)[1] == "after & l"


def test_case_and_int_rules(spark):
    assert one(spark, "straße ﬁx", lambda c: TF.pf_case("uc", F.array(c))) == "STRAßE ﬁX"
    assert one(spark, "ßa", lambda c: TF.pf_case("ucfirst", F.array(c))) == "ßa"
    for text, want in [(" -007 ", "-7"), ("-0", "0"), ("+12345678901234567890123", "12345678901234567890123"), ("1 2", ""), ("", "")]:
        assert one(spark, text, lambda c: TF.pf_int(F.array(c))) == want


def test_title_rules(spark):
    known = ["Template", "MediaWiki"]
    for title, want in [("MediaWiki:foo", "MediaWiki:foo"), ("mediaWiki:foo", "MediaWiki:foo"), ("mediawiki:foo", "Template:Mediawiki:foo"), (":foo", "Foo"), ("", "")]:
        assert one(spark, title, lambda c: TF.qualify_template_title(c, known)) == want
    assert one(spark, "#REDIRECT\n[[X]]", TF.redirect_target) == ""
    assert one(spark, "#redirect [[X y]] z", TF.redirect_target) == "X y"
    tpl = spark.createDataFrame([(1, "Template:A", "#REDIRECT [[Template:B]]"), (2, "Template:B", "b")], "page_num long, title string, body string")
    assert [r["title"] for r in OT.template_catalog(tpl).collect()] == ["Template:B"]


def test_vocabulary_counts(spark):
    df = spark.createDataFrame([(1, "A b. A c!\n\n  A b  ")], "doc_id long, text string")
    v = {r["word"]: r["count"] for r in vocabulary(corpus(df), min_count=2).collect()}
    assert v == {"A": 3, "b": 2}


def test_streaming_sentences_match_batch(spark, tmp_path):
    import shutil

    from wikisift.streaming.corpus_stream import run_sentences_once

    src = tmp_path / "src"
    src.mkdir()
    shutil.copy("/root/testdata/sf0.001/documents.parquet", src / "documents.parquet")
    out = str(tmp_path / "out")
    run_sentences_once(spark, str(src), out, name=f"t{abs(hash(out))}")
    got = spark.read.parquet(out).count()
    want = corpus(spark.read.parquet(str(src))).count()
    assert got == want


def test_lexicon_filter_only_passes_more_when_it_is_full(spark, monkeypatch):
    """Every n-gram by brute force; a filter of few slots gives the same matches."""
    import random

    rnd = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    surfaces = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 4))) for _ in range(150)})
    lex = spark.createDataFrame([(x, f"c{k}") for k, x in enumerate(surfaces)], "surface string, concept_id string")
    sents = [(k, 0, 0, [rnd.choice(words).upper() if rnd.random() < 0.2 else rnd.choice(words + ["x", "y"]) for _ in range(rnd.randrange(0, 15))]) for k in range(80)]
    df = spark.createDataFrame(sents, "doc_id long, par_no int, sent_no int, tokens array<string>")
    want = sorted((k, i, n, x) for k, _, _, t in sents for i in range(len(t)) for n in (1, 2, 3) if i + n <= len(t) and (x := " ".join(t[i : i + n]).lower()) in surfaces)
    for most, block in ((1 << 21, 1 << 15), (64, 64)):
        monkeypatch.setattr(EN, "MOST_SLOTS", most)
        monkeypatch.setattr(EN, "_BITMAP", block)
        got = sorted((r["doc_id"], r["start"], r["n"], r["surface"]) for r in EN.lexicon_matches(df, lex).collect())
        assert got == want
    assert EN.lexicon_from_items(spark.createDataFrame([("A b c",)], "text string")).count() == 6


def test_learned_abbreviations(spark):
    """Planted words that are in no list: learned where they carry their point, used when splitting."""
    import random

    from wikisift.operators import corpus as C

    rnd = random.Random(4)
    prose = lambda n: " ".join(rnd.choice(["house", "river", "walked", "green", "seven", "stones"]) for _ in range(n))
    rows = [(k, "\n".join(f"{prose(6).capitalize()} zvb. Qxr. {prose(5)}. The {prose(2)}. {prose(4)}" for _ in range(4)), "en") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = C.learn_abbreviations(df)
    assert {tuple(r) for r in learned.collect()} == {("english", "zvb"), ("english", "qxr")}
    split = lambda **kw: [" ".join(r["tokens"]) for r in C.corpus(df.limit(1), **kw).orderBy("par_no", "sent_no").collect()]
    with_, without = split(learned=learned), split()
    assert len(without) == 4 * 5 and len(with_) == 4 * 3 and all(" zvb . Qxr . " in x for x in with_[::3])
    assert [w for x in with_ for w in x.split()] == [w for x in without for w in x.split()]
    none = C.abbreviation_scores(spark.createDataFrame([], df.schema))
    assert none.count() == 0 and C.corpus(df.limit(1), learned=none.select("language", "type")).count() == len(without)


def test_metrics_are_observed_in_the_writing_pass(spark, tmp_path):
    from wikisift.operators import corpus as C
    from wikisift.operators import pages as P

    df = spark.createDataFrame([(1, "A b. C d.\n\nE.", "en"), (2, "", "en"), (3, "x", "de")], "doc_id long, text string, lang string")
    assert C.write_corpus(df, str(tmp_path / "s")) == {"files": 3, "paragraphs": 3, "sentences": 4}
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4
    stats = P.write_with_stats(df, str(tmp_path / "p"))
    assert stats["articles"] == 3 and stats["rate"] == 3 / stats["seconds"]


def test_stream_drops_copies_across_batches(spark, tmp_path):
    from wikisift.streaming.corpus_stream import read_pages_stream, run_dedup_once

    src = str(tmp_path / "src")
    rows = [(2 * k + c, k, f"t{c}") for k in range(40) for c in range(1 + k % 3)]
    df = spark.createDataFrame(rows, "page_num long, id long, title string")
    df.orderBy("page_num").coalesce(1).repartition(1).write.option("maxRecordsPerFile", 7).parquet(src)
    got = sorted((r["id"], r["page_num"]) for r in run_dedup_once(read_pages_stream(spark, src, df.schema, max_files=1)).collect())
    assert [i for i, _ in got] == list(range(40))
