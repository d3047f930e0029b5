"""Text clauses (whole words, phrase) and phase-2 terms (substrings, regexes) as columns."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, SparkSession, functions as F

from .text import all_of, any_of

_WORD_EDGE = r"[\p{L}\p{N}_]"
# A stretch every case-insensitive hit must contain in lowercase. ``i`` and ``s`` are left
# out because dotless/dotted i and long s also count as them, yet lowercase differently.
_PLAIN_RUN = "[a-hj-rt-z0-9]+"


def word_pattern(word: str) -> str:
    """Whole-word pattern; a word may itself hold punctuation."""
    quoted = r"\Q" + word.replace(r"\E", r"\E\\E\Q") + r"\E"
    return f"(?iu)(?<!{_WORD_EDGE}){quoted}(?!{_WORD_EDGE})"


def word_pattern_of(word: Column) -> Column:
    """:func:`word_pattern` for words held in a column."""
    return F.concat(
        F.lit(rf"(?iu)(?<!{_WORD_EDGE})\Q"),
        F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")),
        F.lit(rf"\E(?!{_WORD_EDGE})"),
    )


def plain_run_of(word: Column) -> Column:
    """Longest stretch of the word that a hit is sure to contain in lowercase text."""
    runs = F.regexp_extract_all(F.lower(word), F.lit(f"({_PLAIN_RUN})"), F.lit(1))
    return F.aggregate(
        runs, F.lit(""), lambda best, r: F.when(F.length(r) > F.length(best), r).otherwise(best)
    )


_RUN = r"[\p{L}\p{N}_]+"


def _is_odd(letter: str) -> bool:
    def in_run(c: str) -> bool:
        return unicodedata.category(c)[0] in "LN" or c == "_"

    cases = letter.upper(), letter.lower()
    return any(len(c) > 1 or in_run(c[0]) != in_run(letter) for c in cases)


# Letters whose upper or lower case is more than one letter, or stands in a run where they do not. The
# regex engine compares letter by letter, so words with one of them are left to it.
_ODD_LETTERS = "".join(c for c in map(chr, range(0x80, 0x10000)) if _is_odd(c))
# A class of a hundred letters is slow in a pattern, so most letters are told by a range first.
_ODD = "[{}\\x{{130}}-\\x{{FFFF}}&&[{}]]".format(*["".join(rf"\x{{{ord(c):X}}}" for c in part) for part in (
    [c for c in _ODD_LETTERS if c < "\u0130"], _ODD_LETTERS)])


def has_odd_letters(text: Column) -> Column:
    # Plain ASCII needs no look at all.
    return (F.octet_length(text) > F.char_length(text)) & F.rlike(text, F.lit(_ODD))


def folded(words: Column) -> Column:
    """Words in a form that is equal exactly where the regex engine takes them for equal in any case."""
    # The empty text keeps the optimizer from taking two changes of case for one. A sigma's lower
    # case depends on what stands around it.
    return F.replace(F.lower(F.concat(F.upper(words), F.lit(""))), F.lit("ς"), F.lit("σ"))


def is_indexable(word: Column) -> Column:
    """The word is one run of word characters, so it stands alone exactly where such a run equals it."""
    return F.rlike(word, F.lit(f"^{_RUN}$")) & ~has_odd_letters(word)


def words_of(text: Column, among: list[str] | None = None) -> Column:
    """The distinct runs of word characters of a text without odd letters, folded; only those ``among`` some words.

    The text is folded as a whole: without odd letters it has the same runs before and after.
    """
    runs = F.regexp_extract_all(folded(text), F.lit(f"({_RUN})"), F.lit(1))
    if among is None:
        return F.array_distinct(runs)
    return F.array_intersect(runs, F.array(*[F.lit(w) for w in among]).cast("array<string>"))


def has_word(text: Column, word: str, low: Column | None = None) -> Column:
    """The word stands alone in the text, in any case. ``low`` is the lowercased text."""
    hit = F.rlike(text, F.lit(word_pattern(word)))
    run = max(re.findall(_PLAIN_RUN, word.lower()), key=len, default="")
    # The byte search is far cheaper than the regex and throws out most texts first.
    return F.contains(F.lower(text) if low is None else low, F.lit(run)) & hit if run else hit


def content_filter(
    text: Column,
    all_words: list[str] | None = None,
    any_words: list[str] | None = None,
    none_words: list[str] | None = None,
    exact_phrase: str | None = None,
    low: Column | None = None,
) -> Column | None:
    """Predicate for all/any/none words and a phrase; None when no clause is given.

    Empty text never matches, not even when only ``none_words`` is given. ``low`` is the
    lowercased text, if it is at hand.
    """
    if not (all_words or any_words or none_words or exact_phrase):
        return None
    low = F.lower(text) if low is None else low
    clauses: list[Column] = []
    if exact_phrase:
        clauses.append(F.contains(low, F.lit(exact_phrase.lower())))
    clauses += [has_word(text, w, low) for w in all_words or []]
    if any_words:
        clauses.append(any_of([has_word(text, w, low) for w in any_words]))
    clauses += [~has_word(text, w, low) for w in none_words or []]
    return F.coalesce((text != "") & all_of(clauses), F.lit(False))


def job_clauses(text: Column, low: Column, job: Column) -> Column:
    """The same predicate for clauses held in a job column (see ``jobs.clause_columns``)."""

    def stands_alone(term: Column) -> Column:
        return F.contains(low, term["run"]) & F.rlike(text, term["pattern"])

    nothing_asked = (
        (F.size(job["all_terms"]) == 0)
        & (F.size(job["any_terms"]) == 0)
        & (F.size(job["none_terms"]) == 0)
        & job["phrase"].isNull()
    )
    asked = (
        (text != "")
        & (job["phrase"].isNull() | F.contains(low, job["phrase"]))
        & F.forall(job["all_terms"], stands_alone)
        & ((F.size(job["any_terms"]) == 0) | F.exists(job["any_terms"], stands_alone))
        & ~F.exists(job["none_terms"], stands_alone)
    )
    return nothing_asked | F.coalesce(asked, F.lit(False))


def phase2_keywords(keywords: list[str] | None) -> list[str]:
    return [k.lower() for k in keywords or [] if k.strip()]


def phase2_regexes(regexes: list[str] | None) -> dict[str, str]:
    """User patterns, as written, with the form Spark's regex engine understands.

    A pattern that does not compile, on either side, fails here, before any job starts.
    """
    ready: dict[str, str] = {}
    for pattern in regexes or []:
        if not pattern.strip():
            continue
        named = list(re.compile(pattern).groupindex)
        java = _class_safe(pattern)
        for i, name in enumerate(named):
            java = java.replace(f"(?P<{name}>", f"(?<g{i}>").replace(f"(?P={name})", rf"\k<g{i}>")
        # Unicode case and classes, and the line feed as the only line end.
        ready[pattern] = f"(?iuUd){java}"
        _compile_on_jvm(pattern, ready[pattern])
    return ready


def _class_safe(pattern: str) -> str:
    """The pattern with the end-of-text escape of the JVM, and with the characters escaped that
    only mean themselves inside a class here: a bracket, an ampersand."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        c, pair = pattern[at], pattern[at : at + 2]
        if c == "\\":
            out.append(r"\z" if pair == r"\Z" and not inside else pair)
            at += 2
            continue
        if inside and c in "[&":
            c = "\\" + c
        elif inside and c == "]":
            inside = False
        elif not inside and c == "[":
            inside = True
            head = pattern[at : at + 3] if pair == "[^" else pair
            if head.endswith("]"):
                # A bracket that comes first in its class belongs to it.
                out.append(head[:-1] + r"\]")
                at += len(head)
                continue
        out.append(c)
        at += 1
    return "".join(out)


def _compile_on_jvm(written: str, java: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        # Of two literals, so the optimizer answers it and no job runs.
        spark.sql("SELECT '' RLIKE :p AS ok", args={"p": java}).collect()
    except Exception as error:
        raise ValueError(f"pattern {written!r} cannot be used: {str(error).splitlines()[0]}") from error


def matched_terms(text: Column, keywords: list[str], regexes: dict[str, str]) -> Column:
    """Sorted distinct keywords and patterns that occur in the text (empty array: none)."""
    found = []
    if keywords:
        words = F.array(*[F.lit(k) for k in dict.fromkeys(keywords)])
        # transform() binds the lowercased text once instead of once per keyword.
        found.append(
            F.transform(
                F.array(F.lower(text)),
                lambda low: F.filter(words, lambda word: F.contains(low, word)),
            )[0]
        )
    if regexes:
        found.append(
            F.array_compact(
                F.array(
                    *[
                        F.when(F.rlike(text, F.lit(java)), F.lit(written))
                        for written, java in regexes.items()
                    ]
                )
            )
        )
    terms = F.concat(*found) if len(found) > 1 else found[0]
    nothing = F.array().cast("array<string>")
    return F.coalesce(F.array_sort(F.array_distinct(terms)), nothing)
