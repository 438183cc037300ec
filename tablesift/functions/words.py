"""Words of a name or sentence by the rules of the Penn Treebank, as a cascade of replacements.

Each rule sets blanks around what is a word of its own: quotes, marks, brackets, the period at the end, and the
parts of contractions. What stands between blanks then are the words. The rules use nothing that either of the engines'
patterns lacks, so the cascade is a Column expression and the same in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is replaced, and by what, in this order; $1 is the first group.
RULES = (
    # Quotes that open.
    (r"^[\"]", r" `` "),
    (r"(``)", r" $1 "),
    (r"([ (\[{<])([\"]|[']{2})", r"$1 `` "),
    # Marks; a colon or comma inside a number stays, as does a period that isn't the last thing.
    (r"([:,])([^0-9])", r" $1 $2"),
    (r"([:,])$", r" $1 "),
    (r"[.]{3}", r" ... "),
    (r"([;@#$%&])", r" $1 "),
    (r"([^.])([.])([\])}>\"']*)\s*$", r"$1 $2$3 "),
    (r"([?!])", r" $1 "),
    (r"([^'])' ", r"$1 ' "),
    # Brackets and dashes.
    (r"([\]\[(){}<>])", r" $1 "),
    (r"--", r" -- "),
    # The ends count as blanks from here on.
    (r"^|$", r" "),
    # Quotes that close, and what is short for a word.
    (r"''", r" '' "),
    (r"[\"]", r" '' "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", r"$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"$1 $2 "),
    (r"(?i)\b(can)(not)\b", r" $1 $2 "),
    (r"(?i)\b(d)('ye)\b", r" $1 $2 "),
    (r"(?i)\b(gim)(me)\b", r" $1 $2 "),
    (r"(?i)\b(gon)(na)\b", r" $1 $2 "),
    (r"(?i)\b(got)(ta)\b", r" $1 $2 "),
    (r"(?i)\b(lem)(me)\b", r" $1 $2 "),
    (r"(?i)\b(more)('n)\b", r" $1 $2 "),
    (r"(?i)\b(wan)(na)\s", r" $1 $2 "),
    (r"(?i) ('t)(is)\b", r" $1 $2 "),
    (r"(?i) ('t)(was)\b", r" $1 $2 "),
)


def spaced(text: Column) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), RULES, text)


def words(text: Column) -> Column:
    """The words of a text; null for null."""
    return F.filter(F.split(spaced(text), r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def spaced_sql(text: str) -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    # SQL names groups otherwise.
    return reduce(lambda s, rule: f"regexp_replace({s}, {quoted(rule[0])}, {quoted(rule[1].replace('$1', chr(92) + '1').replace('$2', chr(92) + '2').replace('$3', chr(92) + '3'))}, 'g')", RULES, text)


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({spaced_sql(text)}, '\\s+'), lambda w: w <> '')"
