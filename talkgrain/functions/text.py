"""Column expressions for words.

All are built-in functions that Spark compiles into the loop of the scan. That rules out
``transform`` and ``filter`` with a lambda, which would take the whole step out of that loop.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a maximal run of Unicode letters, digits and marks, with single apostrophes (straight or
# curly) inside it. The quantifiers are possessive: they find the same words, and a long run takes
# no stack.
WORD_PATTERN = r"[\p{L}\p{N}\p{M}]++(?:['’][\p{L}\p{N}\p{M}]++)*+"


def runs(text: Column) -> Column:
    """The words of a text as they are written, in order. NULL text gives NULL."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in their ``plain`` form, in order. NULL text gives NULL.

    Where the words are exploded anyway, exploding ``runs`` and making each ``plain`` after that is
    cheaper and gives the same words.
    """
    # The words are cut first: lower-casing can change where a word ends (a capital dotted I
    # becomes an i and a combining dot) and looks at neighbours (a capital sigma), but never
    # across the space put between the words here. Words hold no space and are not empty.
    return F.array_remove(F.split(plain(F.array_join(runs(text), " ")), " "), "")


def plain(word: Column) -> Column:
    """A word as it is counted: lower-cased, with straight apostrophes."""
    return F.lower(F.replace(word, F.lit("’"), F.lit("'")))


def word_count(text: Column) -> Column:
    """How many words a text has, as LONG. NULL text counts 0."""
    return array_length(runs(text))


def array_length(array: Column) -> Column:
    """Length of an array as LONG, 0 for NULL whatever the session says about size(NULL)."""
    return F.coalesce(F.array_size(array), F.lit(0)).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, for an empty group."""
    return F.try_divide(numerator, denominator)
