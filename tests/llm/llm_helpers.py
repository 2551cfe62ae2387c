"""Inputs shared by the tests of this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like the operators' own.
CLASH = ["fingerprint", "fp", "doc", "h", "grp", "pair", "row", "part", "curve", "kept", "s", "own", "keep_id", "n_words", "x", "score", "root"]


def words(rng, n, common=40):
    """Prose from a small and a large vocabulary, with sentences and lines."""
    out = []
    for k in range(n):
        w = f"w{rng.randrange(common)}" if rng.random() < 0.5 else "".join(rng.choice("abcdeéß") for _ in range(rng.randrange(3, 9)))
        out.append((w.capitalize() if rng.random() < 0.1 else w) + rng.choice(["", "", "", ",", "."]) + ("\n" if rng.random() < 0.05 else ""))
    return " ".join(out)


def edge_rows(rng):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = words(rng, 120)
    long = words(rng, 30_000, 5000)
    return [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \t\n\x0b ", "en", None, 5), (None, base, "en", "a", 9),
        (4, base, "en", "a", 9), (4, base, "en", "a", 9), (5, base, "en", "b", 9), (6, base + " tail", "en", "a", 9), (4, words(rng, 80), "en", "a", 9),
        (7, long, "en", "a", 9), (8, "x" * 200_000, "en", "a", 9), (9, "One", "en", "a", 3), (-5, "one\nONE \n one", "de", "a", 9), (2**63 - 2, words(rng, 60), "de", "c", 1),
        (11, "\n".join(["A line that repeats"] * 5), "en", "a", 1), (12, "a line that REPEATS\t\nother words here", "en", "a", 1),
    ]


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
