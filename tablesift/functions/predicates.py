"""Predicates on cells and headers, as Column expressions.

Patterns are for Java with Unicode classes.  Where DuckDB's engine needs another
form, the SQL twin stands beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesift.functions import words

# What counts as code.
CODE_DEFINITION = r"\b(def\s+\w+\s*\([^)]*\)\s*:|function\s+\w+\s*\(|\w+\s*\([^)]*\)\s*\{)"
CODE_COMMENT = r"/\*[\s\S]*?\*/|#.*"
CODE_OUTPUT = r"\b(System\.out\.println|console\.log|print|echo|printf|scanf|cin|cout)\b"
CODE_TYPED = r"\s(int|char|float|double|string|bool|boolean|void|public|private|protected|static|final|class)\s+[0-9_]="
CODE_OPERATOR = r"->|::|\.\.|=>"
CODE = "|".join(f"(?:{p})" for p in (CODE_DEFINITION, CODE_COMMENT, CODE_OUTPUT, CODE_TYPED, CODE_OPERATOR))

# What counts as personal data.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"(?:\(\d{1,4}\)\s?|\d{1,4}[-.\s])\d{1,4}[-.\s]\d{1,4}"
PII = rf"{EMAIL}|(?<!\d){PHONE}(?!\d)"

# Numbers, headers that are key and value, and unnamed headers.
NUMBER = r"^-?\d+(\.+\d+)?$"
KEY_VALUE = r"""".*".*:.*".*"|'.*'.*:.*'.*'"""
UNNAMED = "Unnamed:"
#: The number at which quality features are clipped.
CLIP = 1e15

SQL_CODE = CODE
SQL_PII = rf"(?i){EMAIL}|(?:^|[^0-9]){PHONE}(?:[^0-9]|$)"


def contains_code(text: Column) -> Column:
    """False for null.

    Fixed strings are looked for first, and each pattern only where the characters are
    that it can't do without, so most texts are never walked by a pattern.
    """
    has = lambda *parts: reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])
    found = (
        has("#", "->", "::", "..", "=>")
        | (has("/*") & text.rlike("(?U)" + CODE_COMMENT))
        | (has("System.out.println", "console.log", "print", "echo", "scanf", "cin", "cout") & text.rlike("(?U)" + CODE_OUTPUT))
        | (has("(") & has("{", ":", "function") & text.rlike("(?U)" + CODE_DEFINITION))
        | (has("=") & text.rlike("(?U)" + CODE_TYPED))
    )
    return F.coalesce(found, F.lit(False))


def contains_pii(text: Column) -> Column:
    """False for null."""
    return F.coalesce(text.rlike("(?iU)" + PII), F.lit(False))


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike("(?dU)" + NUMBER), F.lit(False))


def is_key_value(text: Column) -> Column:
    return F.coalesce(text.rlike("(?d)" + KEY_VALUE), F.lit(False))


def is_unnamed(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit(UNNAMED)), F.lit(False))


def null_like(text: Column) -> Column:
    """Null, empty or white."""
    return text.isNull() | F.coalesce(text.rlike(r"(?U)^\s*$"), F.lit(False))


def contains_any(text: Column, substrings: list[str] | tuple[str, ...]) -> Column:
    """Whether a substring occurs, by case and literally; False for null."""
    if isinstance(substrings, str):
        raise ValueError("substrings must be a list of strings, not one string")
    return F.coalesce(reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in substrings], F.lit(False)), F.lit(False))


def longer_than(text: Column, characters: int) -> Column:
    return F.coalesce(F.length(text) > characters, F.lit(False))


def decoded(data: Column) -> Column:
    """Bytes as UTF-8 where they are valid, else as ISO-8859-1, which any bytes are."""
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(F.decode(data, "ISO-8859-1"))


def is_english(result: Column, threshold: float = 0.5) -> Column:
    """By a detector's result, a struct of lang and score; False without one."""
    return F.coalesce((result["lang"] == "en") & (result["score"] >= threshold), F.lit(False))


def share(predicate: Column) -> Column:
    """Share of all rows, an aggregate; null if there are none."""
    return F.avg(predicate.cast("int"))


def header_chars(name: Column) -> Column:
    return F.length(name).cast("double")


def header_underscores(name: Column) -> Column:
    return F.regexp_count(name, F.lit("_")).cast("double")


def header_words(name: Column) -> Column:
    """Words by the Treebank's rules."""
    return words.word_count(name).cast("double")


def clipped(number: Column, bound: float = CLIP) -> Column:
    """Infinity upwards as null, the rest within the bound; null stays null."""
    clean = F.when(number == float("inf"), F.lit(None)).otherwise(number)
    return F.when(clean.isNotNull(), F.greatest(F.least(clean, F.lit(bound)), F.lit(-bound)))
