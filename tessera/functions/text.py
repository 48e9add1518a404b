"""Text expressions; all run in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}_]+"
CITATION = r"\[([^\[\]:]+):(\d+)\]"
NUMBER = r"\d+(?:\.\d+)?"
SENTENCE_END = r"[.!?]\s+"
#: Words that mark speculation.
SPECULATION = r"(?i)\b(probably|might|perhaps|possibly|maybe|presumably|likely|seems|appears)\b"


def folded(text: Column) -> Column:
    """Lower case, letter by letter: ``lower`` alone chooses a sigma by what
    stands around it, and makes two characters of a dotted capital I."""
    return F.lower(F.replace(F.replace(text, F.lit("Σ"), F.lit("σ")), F.lit("İ"), F.lit("i")))


def tokens(text: Column) -> Column:
    """Lower-case words in order; null text: none."""
    return F.filter(F.split(folded(F.coalesce(text, F.lit(""))), NOT_WORD), lambda t: t != "")


def normalised(text: Column) -> Column:
    """Words joined by single spaces, one at each end, for containment."""
    return F.concat(F.lit(" "), F.array_join(tokens(text), " "), F.lit(" "))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")
