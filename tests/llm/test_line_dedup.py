"""Operator 3 against a sequential model, for several batch sizes."""

import hashlib

from llm_helpers import rows_of, words

from wikisift.llm.line_dedup import MIN_CHARS, Runs, drop_repeated_lines, line_dedup, line_hash


def model(rows):
    """[(doc_id, text)] -> [(doc_id, n_lines, n_dropped, sha256, kept)]."""
    last = float("inf")
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= MIN_CHARS:
                holders.setdefault(key(x), set()).add(last if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if min(holders.get(key(x), {last if d is None else d})) == (last if d is None else d)]
        text = "\n".join(kept)
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out, key=repr)


COLS = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"]


def test_line_keys():
    assert line_hash(b"short") is None and line_hash("ééééééééé".encode()) is None
    assert line_hash("éééééééééé".encode()) is not None
    assert line_hash(b"\tA Line Here \r") == line_hash(b"a line here") != line_hash(b"a  line here")
    assert line_hash("É line here..".encode()) != line_hash("é line here..".encode())


def test_edge_rows(edge, empty, clash):
    want = model([(r["doc_id"], r["text"]) for r in edge.collect()])
    assert rows_of(line_dedup(edge), *COLS) == want
    assert rows_of(line_dedup(clash(edge)), *COLS) == want
    assert line_dedup(empty).count() == 0
    kept = drop_repeated_lines(clash(edge))
    assert kept.columns == clash(edge).columns
    assert rows_of(kept, "doc_id", "text") == sorted(((d, t) for d, _, _, _, t in want), key=repr)
    assert all(n == len(t) for n, t in rows_of(kept, "n_chars", "text"))


def test_batches_and_compaction(spark, rng):
    pool = [words(rng, 6).replace("\n", " ") for _ in range(60)]
    rows = [(k, "\n".join(rng.choice(pool) if rng.random() < 0.6 else words(rng, 5).replace("\n", "") for _ in range(rng.randrange(1, 8)))) for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = model(rows)
    for batches, fanout in ((1, 2), (7, 2)):
        assert rows_of(line_dedup(df, batches, fanout), *COLS) == want


def test_runs_stay_few(spark, tmp_path):
    runs = Runs(spark, str(tmp_path), 4, fanout=2)
    for k in range(6):
        runs.add(spark.createDataFrame([(bytes([k, i]),) for i in range(5)], "h binary"))
    assert [len(x) for x in runs.levels] == [0, 1, 1]
    probe = spark.createDataFrame([(bytes([k, 0]),) for k in range(8)], "h binary")
    assert rows_of(runs.without(probe), "h") == [(bytearray([6, 0]),), (bytearray([7, 0]),)]
    plan = runs.without(probe)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    runs.close()
    assert not runs.tables()
