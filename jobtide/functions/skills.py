"""Skill lists and skills in running text."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python strips off a text: Unicode white space and the ASCII separators.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
WORD_CHAR = r"[\p{L}\p{N}]"
NO_WORD = r"[^\p{L}\p{N}]+"


def skill_names(skills: Column, of_structs: bool = True) -> Column:
    """Names of a skill array in their order, duplicates kept, never null.

    A null element is skipped, a struct whose name is null stays as null. Pass
    ``of_structs=False`` for an array that holds the names themselves.
    """
    present = F.array_compact(skills)
    names = present.getField("name") if of_structs else present
    return F.coalesce(names, F.array().cast("array<string>"))


def format_skills(skills: Column) -> Column:
    """Trim, drop blanks and nulls, remove duplicates, sort by code point."""
    trimmed = F.transform(skills, lambda s: F.trim(s, F.lit(_BLANKS)))
    named = F.filter(trimmed, lambda s: s != "")
    return F.coalesce(F.array_sort(F.array_distinct(named)), F.array().cast("array<string>"))


def detect_skills(text: Column, vocabulary: Sequence[str]) -> Column:
    """Vocabulary terms that occur in the text as whole words, in vocabulary order.

    Letter case is ignored, and a word ends at anything but a letter or a digit,
    so terms such as C++ work. Each pattern is a literal compiled once per task,
    and the cheap substring test spares most texts the pattern. A vocabulary of
    thousands of terms belongs in a table: see ``skills_from_vocabulary``.
    """
    lowered = F.lower(text)

    def found(term: str) -> Column:
        quoted = "".join(rf"\x{{{ord(c):x}}}" if not c.isalnum() else c for c in term.lower())
        # The term comes first: what stands around it is looked at only where it occurs.
        pattern = rf"{quoted}(?<!{WORD_CHAR}{quoted})(?!{WORD_CHAR})"
        return F.when(lowered.contains(term.lower()) & lowered.rlike(pattern), F.lit(term))

    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[found(t) for t in vocabulary]))


def tokens(text: Column) -> Column:
    """Distinct lower-case words of a text, a word being letters and digits."""
    words = F.split(F.lower(text), NO_WORD)
    return F.array_remove(F.array_distinct(words), "")
