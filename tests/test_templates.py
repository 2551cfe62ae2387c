"""Calls, closure and expansion against plain walks and hand-worked results."""

import random

import pytest
from pyspark.sql import functions as F

from wikisift.functions import templates as TF
from wikisift.operators import templates as OT

PAGE = "page_num long, title string, text string"


def walk(text):
    """(depth, parts) of every call by a character walk, for texts whose braces pair as they stand."""
    out, stack, at = [], [], 0
    while at < len(text):
        if text.startswith("{{", at):
            stack.append([len(out), [""]])
            out.append(None)
            at += 2
        elif text.startswith("}}", at) and stack:
            k, parts = stack.pop()
            out[k] = (len(stack), parts)
            if stack:
                stack[-1][1][-1] += "{{" + "|".join(parts) + "}}"
            at += 2
        else:
            if stack:
                if text[at] == "|":
                    stack[-1][1].append("")
                else:
                    stack[-1][1][-1] += text[at]
            at += 1
    return out


def test_calls_by_a_walk(spark):
    rnd = random.Random(3)

    def call(depth):
        parts = [rnd.choice(["T1", "If x", "é t"])] + ["".join(rnd.choice(["a", " b", "k=", "{", "call"]) if rnd.random() < 0.8 or depth > 3 else call(depth + 1) for _ in range(rnd.randrange(3))) for _ in range(rnd.randrange(3))]
        return "{{" + "|".join(p.replace("{", "(") if "{{" not in p else p for p in parts).replace("call", call(depth + 1) if depth < 3 else "") + "}}"

    texts = ["".join(rnd.choice(["x ", "\n", call(0)]) for _ in range(8)) for _ in range(40)]
    texts = [t for t in texts if "{{{" not in t and "}}}" not in t and t.replace("{{", "").count("{") == 0]
    df = spark.createDataFrame(list(enumerate(texts)), "page_num long, text string")
    got = {}
    for r in OT.template_calls(df).orderBy("page_num", "pos").collect():
        assert r["title"] == r["parts"][0].strip()
        got.setdefault(r["page_num"], []).append((r["depth"], r["parts"]))
    assert len(texts) > 10 and got == {k: w for k, t in enumerate(texts) if (w := walk(t))}


def test_calls_with_links_references_and_odd_runs(spark):
    text = "{{A|[[p|q|[[r|s]]]]|[x|y}}{{{{{1}}}|b}}{ {{B}} }{{ open {{C|{{{d|{{E}}}}}}}"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "{{"), (5, "}}{{x}}")], "page_num long, text string")
    got = [(r["page_num"], r["pos"], r["depth"], r["parts"]) for r in OT.template_calls(df).orderBy("page_num", "pos").collect()]
    assert got == [(1, 0, 0, ["A", "[[p|q|[[r|s]]]]", "[x", "y"]), (1, 1, 0, ["{{{1}}}", "b"]), (1, 2, 0, ["B"]), (1, 3, 0, ["C", "{{{d|{{E}}}}}"]), (1, 4, 1, ["E"]), (5, 0, 0, ["x"])]


def test_deep_nesting(spark):
    text = "{{d|" * 200 + "x" + "}}" * 200
    rows = OT.template_calls(spark.createDataFrame([(1, text)], "page_num long, text string")).collect()
    assert sorted((r["pos"], r["depth"]) for r in rows) == [(k, k) for k in range(200)]


@pytest.fixture(scope="module")
def library(spark):
    bodies = {"D": "X{{{1|{{PAGENAME}}}}}Y", "I": "i({{{1}}},{{{2|none}}})", "Dyn": "{{ {{{1}}}|{{{2}}} }}", "Loop": "{{#if:{{{1|}}}|{{Loop}}{{Loop}}|end}}", "A": "a{{B}}", "B": "b{{A2}}",
              "C": "c", "Deep": "[{{Dyn|D|{{Dyn|C}}}}]", "Brace": "{{{{{1}}}}}", "M": "{{#invoke:M|main|x}}", "Out": "{{M|1=in}}"}
    cat = spark.createDataFrame([(f"Template:{t}", b) for t, b in bodies.items()], "title string, body string")
    red = spark.createDataFrame([("Template:A2", "Template:C"), ("Template:Gone2", "Template:Nothing")], "title string, target string")
    return cat, red


def expand(spark, library, *texts):
    pages = spark.createDataFrame([(k, "P", t) for k, t in enumerate(texts)], PAGE)
    return [(r["text"], r["overruns"], r["title_errors"]) for r in OT.expand_templates(pages, *library, ["Template"]).orderBy("page_num").collect()]


def test_expansion(spark, library):
    got = expand(
        spark, library, "{{urlencode:~}}|{{int:1_000}}|{{int: -0 }}|{{lc:ABC}}", "{{Dyn|D|q}} {{Dyn|Gone2|q}} {{Deep}}", "{{Loop}} {{A}}", "{{Brace|C}} {{{{{x}}}|C}}",
        "{{#switch: a | b = {{D}} | a = {{I|{{D|1}}}} | #default = {{Loop|1}} }}", "{{#if: | {{Loop|1}} | {{#ifeq: x | x | {{I|[[l|k]]|2}} }} }}", "plain", None, "{{ unclosed {{C}}", "{{I|x=1|1={{!}}}}{{I||b}}", "{{Loop|1}}")
    assert got == [("%7E||0|abc", 0, 0), ("XqY  [XcY]", 0, 0), ("end abc", 0, 0), ("c ", 0, 1), ("i(X1Y,none)", 0, 0), ("i([[l|k]],2)", 0, 0), ("plain", 0, 0), (None, 0, 0), ("{{ unclosed c", 0, 0), ("i(|,none)i(,b)", 0, 0),
                   ("endend", 0, 0)]  # the looping template ends, though its untaken branch calls it twice


def test_registered_functions_work_in_dispatch_and_expansion(spark, library, monkeypatch):
    monkeypatch.setattr(TF, "FUNCTIONS", dict(TF.FUNCTIONS))
    monkeypatch.setattr(TF, "MODULES", dict(TF.MODULES))
    TF.register_function("#rev", lambda a: F.reverse(F.element_at(a, 1)))
    TF.register_module("M", "main", lambda a: F.concat(F.lit("<"), F.array_join(a, ","), F.lit(">")))
    df = spark.createDataFrame([("#rev", ["abc"]), ("#invoke:M", ["1", "2"])], "n string, a array<string>")
    assert [r[0] for r in df.select(TF.pf_dispatch("n", "a")).collect()] == ["cba", "<1,2>"]
    assert [t for t, _, _ in expand(spark, library, "{{#rev: {{C}}d|x}}", "{{M|a|b}} {{Out}}")] == ["dc", "<a,b> <in>"]


def test_closure_is_the_walk_over_edges(spark, library):
    cat, red = library
    got = {}
    for r in OT.template_closure(cat, ["Template"], red).collect():
        got.setdefault(r["asked"].removeprefix("Template:"), set()).add(r["reached"].removeprefix("Template:"))
    assert got["A"] == {"A", "B", "A2"} and got["Loop"] == {"Loop"} and got["A2"] == {"A2"} and got["Out"] == {"Out", "M"} and got["Deep"] == {"Deep", "Dyn"} and got["D"] == {"D", "PAGENAME"}


def test_a_row_that_needs_more_steps_than_one_pass(spark, library, monkeypatch):
    from wikisift.functions import expansion as X

    monkeypatch.setattr(X.steps, "__defaults__", (2,))
    assert [t for t, _, _ in expand(spark, library, "{{Deep}} {{A}}", "{{C}}")] == ["[XcY] abc", "c"]
