"""Skill extraction from free text.

All extractors are native expressions over the text column: one regex pass
(T4), one token pass plus a guarded test per phrase (T5, T8), splits and
higher-order functions (T7, T9, T10).  No operator here shuffles text: callers
explode only ``(skill, salary, id)`` out of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.columns import EXTRACTED_SKILLS, SKILL, SKILLS_COUNT, SKILLS_LIST
from payscope.functions.text import WHITESPACE, WORD, bounded, keyword_alternation
from payscope.sources.taxonomy import TAXONOMY, TECH_SKILLS, flat_keywords, taxonomy_entries

# ---------------------------------------------------------------------------
# Contextual skills from the qualification text; the first
# rule whose needles occur wins.
# ---------------------------------------------------------------------------
CONTEXT_RULES = [
    (("engineering", "architecture"), ("engineering_design", "technical_drafting")),
    (("legal",), ("legal_research", "contract_review")),
    (("health", "medical"), ("patient_care", "clinical_assessment")),
    (("finance", "accounting"), ("financial_reporting", "audit_compliance")),
]

# ---------------------------------------------------------------------------
# Skill-phrase patterns (case-insensitive), group 1 is kept.
# ---------------------------------------------------------------------------
PHRASE_PATTERNS = [
    r"(?:proficiency?|experience|knowledge|skilled)[\s:]*in[\s]*([a-zA-Z0-9\s&/]+?)(?=\.|,|;)",
    r"(?:requires?|need|must have)[\s]*([a-zA-Z0-9\s&/]+?)(?=\.|,|;)",
    r"([a-zA-Z0-9\s&/]+?)(?:programming|development|analysis|expertise)",
    r"\b([a-z]{3,})[\s]+(?:skills?|experience?|proficiency?)\b",
]
PREFERRED_SPLIT = r"[;,|]"
CLAUSE_END = r"(?<=[.,;])"

# The third pattern has no anchor: a regex engine retries it at every
# position of a long run of letters and blanks that holds no suffix word,
# which is quadratic in the run length.  A match can only begin where such a
# run begins or right after a suffix word (if an attempt fails at one
# position of a run it fails at every later one), so this start guard gives
# the same matches in linear time.
_SUFFIXES = "programming|development|analysis|expertise"
_START_GUARD = rf"(?:(?<![a-zA-Z0-9\s&/])|(?<={_SUFFIXES}))"


@dataclass(frozen=True)
class Phrase:
    """How a phrase pattern is run: ``triggers`` are literal words at least one
    of which any match contains (a text without them is skipped), ``guard`` a
    look-behind put before the pattern."""

    pattern: str
    triggers: tuple[str, ...]
    guard: str = ""


PHRASES = [
    Phrase(PHRASE_PATTERNS[0], ("proficienc", "experience", "knowledge", "skilled")),
    Phrase(PHRASE_PATTERNS[1], ("require", "need", "must have")),
    Phrase(PHRASE_PATTERNS[2], ("programming", "development", "analysis", "expertise"), _START_GUARD),
    Phrase(PHRASE_PATTERNS[3], ("skill", "experienc", "proficienc")),
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _empty() -> Column:
    return F.array().cast("array<string>")


def _strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITESPACE))


# --------------------------------------------------------------------- T4/T13
def extract_mentions(df: DataFrame, text_col: str, keywords: Sequence[str] | None = None,
                     out: str = EXTRACTED_SKILLS) -> DataFrame:
    """T4: every non-overlapping whole-word keyword hit, left to right.

    Each mention counts (a keyword found twice appears twice).  Longest
    keywords are tried first, so "vendor management" is one hit.
    """
    pattern = keyword_alternation(keywords if keywords is not None else flat_keywords())
    return df.withColumn(out, F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(1)))


def explode_skills(df: DataFrame, array_col: str, keep: Sequence[str], out: str = SKILL) -> DataFrame:
    """One row per array element; rows with none disappear; empty skills dropped.

    ``explode_outer`` plus the null filter gives the same rows as
    ``explode``, but keeps the optimizer from inferring a
    ``size(array) > 0`` pre-filter: that filter would evaluate the (regex)
    array expression a second time and can be pushed below a repartition
    into the scan tasks.
    """
    return (df.select(F.explode_outer(F.col(array_col)).alias(out), *keep)
              .where(F.col(out).isNotNull() & (F.length(F.col(out)) > 0)))


# --------------------------------------------------------------------- T5-T7
def keyword_presence(text: Column, entries: Sequence[tuple[str, str]]) -> Column:
    """Array of labels whose keyword occurs at least once as a word.

    Keywords of word characters alone are looked up among the text's words,
    found in one pass (whole words cannot hide each other); the work follows the
    words found, not the vocabulary.  Each other keyword (phrases, ``c++``) is
    tested on its own, a cheap substring test guarding the regex, so overlapping
    keywords are all found.  Labels come in the order of ``entries``.
    """
    if not entries:
        return _empty()
    places: dict[str, list[int]] = {}
    for i, (_, kw) in enumerate(entries):
        places.setdefault(kw, []).append(i)
    single = sorted(kw for kw in places if re.fullmatch(r"\w+", kw))
    no_places = F.array().cast("array<int>")
    place_of = F.create_map(*[x for kw in single for x in (F.lit(kw), F.array(*map(F.lit, places[kw])))])
    names = F.array(*[F.lit(label) for label, _ in entries])

    def labels(text: Column) -> Column:
        hits = [F.array_compact(F.array(*[F.when(text.contains(kw) & text.rlike(bounded(kw)), F.lit(i))
                                          for kw, at in places.items() if kw not in single for i in at], F.lit(None).cast("int")))]
        if single:
            words = F.array_intersect(F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0)), F.array(*[F.lit(k) for k in single]))
            hits.append(F.flatten(F.transform(words, lambda w: F.coalesce(F.element_at(place_of, w), no_places))))
        return F.transform(F.sort_array(F.concat(*hits)), lambda i: F.get(names, i))

    return F.when(text.isNotNull(), _let(text, labels))


def namespaced_presence(text: Column, taxonomy=TAXONOMY) -> Column:
    """T5: ``domain_subdomain_keyword`` labels present in the text."""
    return keyword_presence(text, [(f"{d}_{s}_{k}", k) for d, s, k in taxonomy_entries(taxonomy)])


# A text's atoms: runs of word characters, and every other character.
_ATOM = rf"{WORD}+|[^{WORD[1:]}"


def phrase_candidates(text: Column, longest: int) -> Column:
    """Distinct runs of 1 to ``longest`` atoms of a text that are whole words or
    phrases: neither end is a blank, and none touches a word character from outside.

    Every atom is looked at once; the runs are then chosen by numbers alone."""
    def kind(x: Column) -> Column:
        """2 for a word, 0 for a blank, 1 for any other character."""
        return F.when(x.rlike(f"^{WORD}"), 2).when(F.lit(WHITESPACE).contains(x), 0).otherwise(1)

    def mark(kinds: Column) -> Callable[[Column, Column], Column]:
        """1 if a run may begin at an atom, 2 if it may end there, 3 for both: a word
        always, another character beside no word."""
        def free(i: Column) -> Column:
            return F.coalesce(F.get(kinds, i), F.lit(0)) != 2

        return lambda k, i: (F.when(k == 2, 3).when(k == 0, 0)
                             .otherwise(F.when(free(i - 1), 1).otherwise(0) + F.when(free(i + 1), 2).otherwise(0)))

    def of_marks(atoms: Column, marks: Column) -> Column:
        places = F.when(F.size(atoms) > 0, F.sequence(F.lit(0), F.size(atoms) - 1)).otherwise(F.array().cast("array<int>"))

        def of_starts(starts: Column) -> Column:
            def run(n: int) -> Column:
                whole = F.filter(starts, lambda i: F.get(marks, i + (n - 1)) >= 2)
                return F.transform(whole, lambda i: F.get(atoms, i) if n == 1 else F.array_join(F.slice(atoms, i + 1, n), ""))

            return F.array_distinct(F.concat(*[run(n) for n in range(1, longest + 1)]))

        return _let(F.filter(places, lambda i: F.get(marks, i).isin(1, 3)), of_starts)

    def runs(atoms: Column) -> Column:
        return _let(F.transform(atoms, kind), lambda kinds: _let(F.transform(kinds, mark(kinds)), lambda marks: of_marks(atoms, marks)))

    return _let(F.regexp_extract_all(text, F.lit(f"({_ATOM})"), F.lit(1)), runs)


def vocabulary_presence(df: DataFrame, key: str, text_col: str, vocabulary: DataFrame, out: str = "labels") -> DataFrame:
    """T5 for a vocabulary that is a table (keyword, label) of any size.

    Each text gives its distinct words and phrases, up to the longest phrase of the
    vocabulary, which are hash-joined with the keywords; the planner broadcasts
    the vocabulary only while it is small.  Returns (``key``, sorted array of
    labels) for the rows with a label.  Keywords match as in T5: as whole words, in
    lower case as the text is; blanks inside a phrase match as they are written.  A null
    text has no label, a null or blank keyword is never found; rows of one key
    share their labels, each once.
    """
    # a blank keyword becomes null; a filter on it would be inferred for every phrase too
    known = vocabulary.select(F.when(_strip(F.col("keyword")) != "", F.col("keyword")).alias("_keyword"), F.col("label").alias("_label"))
    atoms = F.size(F.regexp_extract_all(F.col("_keyword"), F.lit(f"({_ATOM})"), F.lit(1)))
    longest = known.agg(F.max(atoms)).first()[0] or 1
    phrases = df.select(key, F.explode(phrase_candidates(F.col(text_col), longest)).alias("_phrase"))
    found = phrases.join(known, F.col("_phrase") == F.col("_keyword"))
    return found.groupBy(key).agg(F.array_sort(F.collect_set("_label")).alias(out))


def contextual_skills(qual_text: Column) -> Column:
    """Two labels from the first matching rule on the qualification text."""
    return _let(F.lower(F.coalesce(qual_text, F.lit(""))), _context_labels)


def _context_labels(t: Column) -> Column:
    expr = None
    for needles, labels in CONTEXT_RULES:
        cond = None
        for n in needles:
            cond = t.contains(n) if cond is None else (cond | t.contains(n))
        val = F.array(*[F.lit(x) for x in labels])
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(_empty())


def trim_labels(labels: Column, cap: int | None = None) -> Column:
    """Drop the text before the first ``_``, distinct, sorted; with ``cap``
    only the first so many (labels late in the alphabet are then lost)."""
    cut = F.transform(labels, lambda x: F.substring(x, F.instr(x, "_") + 1, 1 << 30))
    return _capped(F.sort_array(F.array_distinct(cut)), cap)


def _capped(items: Column, cap: int | None) -> Column:
    return items if cap is None else F.slice(items, 1, cap)


def generalized_skills(df: DataFrame, text_col: str, qual_col: str, taxonomy=TAXONOMY,
                       cap: int | None = None, out: str = SKILLS_LIST) -> DataFrame:
    """T5+T6+T7: name-spaced presence plus contextual labels, trimmed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    labels = F.concat(namespaced_presence(text, taxonomy), contextual_skills(F.col(qual_col)))
    return df.withColumn(out, trim_labels(labels, cap))


# --------------------------------------------------------------------- T8-T12
def tech_skills(text: Column, vocab: dict[str, list[str]] = TECH_SKILLS) -> Column:
    """Distinct keywords of the second vocabulary found in the text (sorted).

    Null text gives an empty array.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    entries = [(k, k) for kws in vocab.values() for k in kws]
    return F.array_sort(F.array_distinct(keyword_presence(lowered, entries)))


def parse_preferred(pref: Column, desc: Column, vocab: dict[str, list[str]] = TECH_SKILLS) -> Column:
    """Split preferred skills on ``; , |``; keep trimmed pieces longer than 2
    whose raw piece does not start with ``http``; null -> T8 on the description."""
    pieces = F.split(F.lower(pref), PREFERRED_SPLIT)
    kept = F.filter(pieces, lambda x: (F.length(_strip(x)) > 2) & ~x.startswith("http"))
    return F.when(pref.isNull(), tech_skills(desc, vocab)).otherwise(F.transform(kept, _strip))


def skill_phrases(text: Column) -> Column:
    """Group 1 of every hit of the phrase patterns; trimmed, 3-20 chars, distinct, sorted.

    No pattern can match across ``.``, ``,`` or ``;``, and none looks further than
    the one that ends its clause.  So a text is cut into clauses once, each with the
    mark that ends it, and a pattern runs only on clauses with one of its trigger
    words, not on the whole text.
    """
    return _let(F.lower(text), _phrases_of)


def _has(text: Column, words: Sequence[str]) -> Column:
    present = text.contains(words[0])
    for word in words[1:]:
        present = present | text.contains(word)
    return present


def _phrases_of(t: Column) -> Column:
    def hits_of(clauses: Column, p: Phrase) -> Column:
        pattern = F.lit("(?i)" + p.guard + p.pattern)
        return F.flatten(F.transform(F.filter(clauses, lambda c: _has(c, p.triggers)), lambda c: F.regexp_extract_all(c, pattern, F.lit(1))))

    def found(clauses: Column) -> Column:
        hits = F.flatten(F.array(*[hits_of(clauses, p) for p in PHRASES]))
        kept = F.filter(F.transform(hits, _strip), lambda x: (F.length(x) > 2) & (F.length(x) <= 20))
        return F.array_sort(F.array_distinct(kept))

    triggers = sorted({w for p in PHRASES for w in p.triggers})
    clauses = F.filter(F.split(t, CLAUSE_END), lambda c: _has(c, triggers))
    return F.when(t.isNull(), _empty()).otherwise(_let(clauses, found))


def skills_cascade(df: DataFrame, pref_col: str, desc_col: str, qual_col: str, cap: int | None = None,
                   vocab: dict[str, list[str]] = TECH_SKILLS, out: str = SKILLS_LIST,
                   count_out: str | None = SKILLS_COUNT) -> DataFrame:
    """T11 (+T12): preferred-skill split if it yields any, else keywords over all
    text, else phrases over all text (the latter two cut to ``cap`` if given)."""
    pref = F.col(pref_col)
    all_text = F.concat_ws(" ", F.col(desc_col), F.col(qual_col), pref)
    split = F.when(pref.isNotNull(), _null_if_empty(parse_preferred(pref, F.col(desc_col), vocab)))
    kw = _null_if_empty(tech_skills(all_text, vocab))
    phr = skill_phrases(all_text)
    # coalesce evaluates left to right and stops at the first non-null, so
    # each (regex-heavy) level runs at most once and only when needed
    res = F.coalesce(split, _capped(kw, cap), _capped(phr, cap))
    df = df.withColumn(out, res)
    return df.withColumn(count_out, F.size(F.col(out))) if count_out else df


def _null_if_empty(arr: Column) -> Column:
    """The array itself, or null when it is empty (``arr`` is evaluated once)."""
    return F.try_element_at(F.filter(F.array(arr), lambda a: F.size(a) > 0), F.lit(1))


def with_skills_count(df: DataFrame, array_col: str = SKILLS_LIST, out: str = SKILLS_COUNT) -> DataFrame:
    """Number of skills per posting."""
    return df.withColumn(out, F.size(F.col(array_col)))

