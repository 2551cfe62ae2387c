"""The registered HTML line pass against a sequential walk over whole pages."""

import re

from wikisift.operators.lines import LIST_CLOSE, LIST_ITEM, LIST_OPEN
from wikisift.plans import catalog
from wikisift.plans.fixtures import wikipages

SF_DIR = "/root/testdata/sf0.001"


def walk(text):
    """[(pos, sub, line)] of a page in HTML mode, line by line."""
    out, headers, empty, marks = [], False, False, ""

    def put(pos, *lines):
        out.extend((pos, sub, x) for sub, x in enumerate(lines))

    for pos, line in enumerate(text.split("\n")):
        if not line:
            continue
        if m := re.match(r"(==+)\s*(.*?)\s*\1", line):
            put(pos, f"<h{len(m[1])}>{m[2]}</h{len(m[1])}>")
            headers, empty, marks = True, True, ""
        elif line.startswith("++"):
            if title := line[2:-2]:
                put(pos, title if title[-1] in "!?" else title + ".")
        elif line[0] == ":":
            continue
        elif line[0] in "*#;":
            new, tags = re.match("[*#;:]+", line)[0], []
            for k in range(max(len(marks), len(new))):
                c, n = marks[k : k + 1], new[k : k + 1]
                if c != n and not (c and n and (c in ";:" or n in ";:")):
                    tags += ([LIST_CLOSE[c]] if c else []) + ([LIST_OPEN[n]] if n else [])
            body, marks = line[len(new) :].strip(), new
            put(pos, *tags, *([LIST_ITEM[new[-1]][0] + body + LIST_ITEM[new[-1]][1]] if body else []))
        elif marks:
            put(pos, line, *(LIST_CLOSE[c] for c in reversed(marks)))
            marks = ""
        elif line[0] in "{|" or line[-1] == "}" or line[0] == "(" and line[-1] == ")" or line.strip(".-") == "":
            continue
        elif headers or not empty and line[0] != " ":
            put(pos, line)
            headers, empty = False, False
    return out


def test_every_line_of_every_page(spark):
    catalog.load_all()
    want = {(r["page_num"], *x) for r in wikipages(spark, SF_DIR).select("page_num", "text").collect() for x in walk(r["text"])}
    rows = [tuple(r) for r in catalog.JOBS["clean_lines_html"](spark, SF_DIR).select("page_num", "pos", "sub", "line").collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert {p for p, *_ in rows} == {r["page_num"] for r in wikipages(spark, SF_DIR).collect()}
    assert {p // 2 % 8 for p, pos, *_ in rows if pos > 4} == set(range(8))
