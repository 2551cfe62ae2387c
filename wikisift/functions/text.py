"""Text and array rules (X1-X3, P6 helpers) as Column expressions.

Everything here is a pure Column -> Column function, so it runs inside whole
stage code generation and works the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode text strippers know it (both regex dialects): controls,
# blanks, next line, no-break space, the spaces of the General Punctuation block.
WHITE = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The characters of ``WHITE``, one by one.
WHITE_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Sentence boundary: a terminal mark followed by white space, unless the mark is
# the point of an abbreviation or of a single capital letter.
SENTENCE_BREAK_RE = f"([.!?])[{WHITE}]+"
# Noncharacters, which interchanged text does not hold.
SENT_SEP, POINT = "\ufdd0", "\ufdd1"

# Abbreviations whose point ends no sentence, by tokenizer language.
ABBREVIATIONS = {
    "english": "Mr Mrs Ms Dr Prof Rev Gen Col Capt Lt Sgt Jr Sr vs Inc Ltd Corp Dept Fig No Vol approx e.g i.e cf",
    "spanish": "Sr Sra Srta Dr Dra Prof Ud Uds Lic Ing núm pág vol cap p.ej",
    "french": "Mme Mlle Mlles MM Dr Prof Me St Ste cf env éd vol chap p.ex",
    "german": "Dr Prof Hr Fr Nr Bd Abs Abb bzw ca vgl sog evtl z.B d.h u.a",
    "italian": "Sig Dott Prof Ing Avv pag vol cap ecc p.es",
    "portuguese": "Sr Sra Srta Dr Dra Prof Eng núm pág vol cap p.ex",
}

# A word is a run of letters, marks, digits and underscores, optionally joined by
# inner hyphens or apostrophes; any other character that is not white is a token.
_IN_WORD = r"\p{L}\p{M}\p{N}_"
TOKEN_RE = f"[{_IN_WORD}]+(?:[-'][{_IN_WORD}]+)*|[^{_IN_WORD}{WHITE}]"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pystrip(c) -> Column:
    """Drop leading and trailing white space (Unicode), linear in the text: a pattern
    would try every inner run of white space again from each of its places."""
    return F.trim(col_of(c).cast("string"), F.lit(WHITE_CHARS))


def split_lines(c) -> Column:
    return F.split(col_of(c), "\n")


def abbreviation_re(language: str) -> str:
    words = "|".join(w.replace(".", r"\.") for w in ABBREVIATIONS[language].split())
    return rf"(^|[^{_IN_WORD}])({words}|\p{{Lu}})\."


def sentence_split(c, language=None) -> Column:
    """Paragraph -> array of sentences.

    ``language``: a column with the tokenizer language (P9); English when none.
    """
    c = col_of(c)
    guarded = F.regexp_replace(c, abbreviation_re("english"), "$1$2" + POINT)
    if language is not None:
        for name in ABBREVIATIONS:
            if name != "english":
                guarded = F.when(col_of(language) == name, F.regexp_replace(c, abbreviation_re(name), "$1$2" + POINT)).otherwise(guarded)
    parts = F.split(F.regexp_replace(guarded, SENTENCE_BREAK_RE, "$1" + SENT_SEP), SENT_SEP)
    return F.transform(parts, lambda s: F.replace(s, F.lit(POINT), F.lit(".")))


def guard_points(c, words: str, abbreviations: Column) -> Column:
    """The last point of every match of ``words`` that, in lower case and without it, is
    among ``abbreviations`` becomes ``POINT``, which ends no sentence."""
    c = col_of(c)
    guarded = F.transform(
        F.regexp_extract_all(c, F.lit(words), F.lit(0)),
        lambda w: F.when(F.endswith(w, F.lit(".")) & F.array_contains(abbreviations, F.regexp_replace(F.lower(w), r"\.$", "")), F.regexp_replace(w, r"\.$", POINT)).otherwise(w))
    pieces = F.zip_with(F.split(c, words, -1), guarded, lambda p, w: F.concat(p, F.coalesce(w, F.lit(""))))
    return F.when(F.size(abbreviations) > 0, F.array_join(pieces, "")).otherwise(c)


def word_tokenize(c) -> Column:
    """Sentence -> word and punctuation tokens."""
    return F.regexp_extract_all(col_of(c), F.lit(TOKEN_RE), F.lit(0))


def case_fold(tokens) -> Column:
    """Lower-case every token."""
    return F.transform(col_of(tokens), lambda t: F.lower(t))


def _one_char(c: Column, changed: Column) -> Column:
    """The changed form of a character, unless it is longer than one."""
    return F.when(F.length(changed) == 1, changed).otherwise(c)


def upper_each(c) -> Column:
    """Upper case character by character; one that would grow (sharp s) stays."""
    return F.array_join(F.transform(F.regexp_extract_all(col_of(c), F.lit("(?s)."), F.lit(0)), lambda x: _one_char(x, F.upper(x))), "")


def lower_each(c) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(col_of(c), F.lit("(?s)."), F.lit(0)), lambda x: _one_char(x, F.lower(x))), "")


def ucfirst(c) -> Column:
    """Upper-case the first character only."""
    c = col_of(c)
    first = F.substring(c, 1, 1)
    return F.concat(_one_char(first, F.upper(first)), F.substring(c, 2, 1 << 30))


def lcfirst(c) -> Column:
    c = col_of(c)
    first = F.substring(c, 1, 1)
    return F.concat(_one_char(first, F.lower(first)), F.substring(c, 2, 1 << 30))
