"""Text expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions._column import ColumnLike, as_column

# The feeds strip Unicode whitespace, which is wider than Spark's trim (spaces
# only) and than the regex class \s (ASCII only, unless the pattern says (?U)).
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
UNICODE = "(?U)"
SPACES = r"\s\x1c-\x1f"

# Letters whose plain form is not their Unicode base letter.
SINGLE_LETTERS = {
    "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h",
    "ı": "i", "Ł": "L", "ł": "l", "Ŧ": "T", "ŧ": "t", "ª": "a", "º": "o",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", " ": " ",
}
LETTER_GROUPS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "—": "--", "…": "...", "°": "deg",
}

# Texts that stand for a missing value, compared before upper-casing.
MISSING_WORDS = ("", "NA", "NaN", "None")

# What the cleaned names and places keep.  White space is written in ranges: a pattern tests each
# member of a class one by one, and ``WHITESPACE`` has 29.
LATIN_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
WHITE_RANGES = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _not_kept() -> str:
    """A class of all other characters.

    Single characters up to U+00FF are one look-up in a table, however many; every range is a test of its own, so
    those of the white space beyond are put where only characters beyond U+00FF come to them.
    """
    kept = re.compile(f"[{LATIN_LETTERS}{WHITE_RANGES}]")
    low = "".join(f"\\x{code:02x}" for code in range(0x100) if not kept.match(chr(code)))
    return rf"[{low}[\u0100-\x{{10FFFF}}&&[^{WHITE_RANGES}]]]"


NOT_KEPT = _not_kept()


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from the Unicode decomposition."""
    pairs = dict(SINGLE_LETTERS)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and base.isascii():
            pairs.setdefault(chr(code), base)
    loose_marks = "".join(map(chr, range(0x300, 0x370)))  # no counterpart: translate drops them
    return "".join(pairs) + loose_marks, "".join(pairs.values())


ACCENTED, PLAIN = _plain_letters()


def strip(c: ColumnLike) -> Column:
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def squash(c: ColumnLike) -> Column:
    """Strip, and turn each run of whitespace into one space."""
    # A lone plain space, by far the most frequent run, is not matched at all.
    runs = f"{UNICODE}[{SPACES}&&[^ ]][{SPACES}]*| [{SPACES}]+"
    return strip(F.regexp_replace(as_column(c), runs, " "))


def unaccent(c: ColumnLike) -> Column:
    """Latin text without accents; values that are already ASCII skip the work."""
    text = as_column(c)
    single = F.translate(text, ACCENTED, PLAIN)
    plain = single
    for group, replacement in LETTER_GROUPS.items():
        plain = F.replace(plain, F.lit(group), F.lit(replacement))
    return (
        F.when(~text.rlike(r"[^\x00-\x7F]"), text)
        .when(~text.rlike(f"[{''.join(LETTER_GROUPS)}]"), single)
        .otherwise(plain)
    )


def normalize_text(c: ColumnLike) -> Column:
    """Strip, upper-case and unaccent; a missing value becomes the empty text."""
    return F.coalesce(unaccent(F.upper(strip(c))), F.lit(""))


def null_tokens(c: ColumnLike, tokens: Sequence[str]) -> Column:
    """Null where the text is one of the tokens.

    Filtering a one-entry array works the argument out once.  ``when(test, value)`` and
    ``nullif`` repeat it, and in nested expressions the repetitions multiply.  Removing the
    tokens one by one in generated code was no faster.
    """
    return F.get(F.filter(F.array(as_column(c)), lambda text: ~text.isin(*tokens)), F.lit(0))


def is_bare(c: ColumnLike) -> Column:
    """True where the text begins and ends with a visible ASCII character, so that there is nothing to strip.

    Two comparisons of bytes at each end cost a small part of looking for white space there.
    """
    text = as_column(c)
    last = F.substring(text, -1, 1)
    return (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")


def strip_text(c: ColumnLike) -> Column:
    """``strip`` of anything as text; a column, named by its name, is only searched for white space if it is not bare.

    An expression is stripped as it is: every time it were named it would be worked out.
    """
    text = as_column(c).cast("string")
    return F.when(is_bare(text), text).otherwise(strip(text)) if isinstance(c, str) else strip(text)


def clean_text(c: ColumnLike, upper: bool = True, missing: Sequence[str] = MISSING_WORDS) -> Column:
    kept = null_tokens(strip(c), missing)
    if isinstance(c, str):
        text = F.col(c).cast("string")
        kept = F.when(is_bare(text), F.when(~text.isin(*missing), text)).otherwise(kept)
    return F.upper(kept) if upper else kept


def default_text(c: ColumnLike, value: str, blank: bool = True) -> Column:
    """``value`` where the text is null, and where it is empty unless ``blank`` is off."""
    text = as_column(c)
    return F.coalesce(null_tokens(text, [""]) if blank else text, F.lit(value))


def first_filled(*columns: ColumnLike) -> Column:
    """The first value that is neither null nor only whitespace, as it is."""
    choices = [as_column(c) for c in columns]
    return F.coalesce(*[F.when(strip(c) != "", c) for c in choices])


def full_name(*parts: ColumnLike) -> Column:
    return F.upper(strip(F.concat_ws(" ", *[F.coalesce(as_column(p), F.lit("")) for p in parts])))


def digits(c: ColumnLike) -> Column:
    return F.regexp_replace(as_column(c), "[^0-9]+", "")


def clean_document(c: ColumnLike, length: int = 11, default: str = "-1") -> Column:
    """Digits only, cut to ``length``.

    No digits gives ``default``.  So does a lone ``1``: the sentinel ``-1`` has lost
    its sign by then and cannot be told from it.
    """
    number = F.substring(digits(c), 1, length)
    return F.coalesce(null_tokens(number, ["", "1"]), F.lit(default))


def letters_only(c: ColumnLike) -> Column:
    return F.regexp_replace(as_column(c), f"{NOT_KEPT}+", "")


def truncate(c: ColumnLike, length: int) -> Column:
    return F.substring(as_column(c), 1, length)


def contains_norm(c: ColumnLike, token: str) -> Column:
    return F.contains(normalize_text(c), F.lit(token))


def classify(
    c: ColumnLike, rules: Sequence[tuple[str, Sequence[str]]], default: str, normal: bool = False
) -> Column:
    """The first class, in order, one of whose tokens occurs in the normalised text.

    ``normal`` says that the column already is normalised.
    """
    text = as_column(c) if normal else normalize_text(c)
    branches = [
        F.when(text.rlike("|".join(re.escape(token) for token in tokens)), F.lit(name))
        for name, tokens in rules
    ]
    return F.coalesce(*branches, F.lit(default))


def after_sep(c: ColumnLike, separator: str) -> Column:
    """What follows the first separator, up to the next; empty when there is none."""
    return F.split_part(as_column(c), F.lit(separator), F.lit(2))


def label_year(c: ColumnLike, day: ColumnLike) -> Column:
    return F.concat(as_column(c), F.lit(" "), F.year(as_column(day)).cast("string"))


def strip_prefix(c: ColumnLike, prefix: str) -> Column:
    return F.regexp_replace(as_column(c), f"^\\Q{prefix}\\E", "")


def json_text(c: ColumnLike) -> Column:
    """JSON text; null members are kept and so are characters outside ASCII."""
    return F.to_json(as_column(c), {"ignoreNullFields": "false"})


def name_parts(c: ColumnLike) -> dict[str, Column]:
    """First word, last word, and the number of characters that are not spaces."""
    text = strip(c)
    words = F.split(squash(c), " ")
    return {
        "first_word": F.element_at(words, 1),
        "last_word": F.element_at(words, -1),
        "letters": F.length(F.replace(text, F.lit(" "), F.lit(""))),
        "first_letters": F.length(F.element_at(words, 1)),
    }
