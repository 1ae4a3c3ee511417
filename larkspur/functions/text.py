"""Text preparation as column expressions; a document never leaves its row."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.arrays import once

# The English stop words of Spark's StopWordsRemover.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've",
    "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
)

# Rules of the part-of-speech selector. They approximate a tagger; WordRules
# takes others.
NOUN_WORDS = ("food", "place", "service", "time", "staff", "menu", "table", "lunch", "dinner", "thing")
NOUN_SUFFIXES = ("tion", "ment", "ness", "ity", "eau", "ung", "ing")
ADJECTIVE_WORDS = ("good", "great", "nice", "best", "fresh", "friendly", "delicious", "slow", "cold")
ADJECTIVE_SUFFIXES = ("ble", "ous", "ful", "ive", "lich", "eux", "ish")

# Rules of the word scorer: 0 very negative, 2 neutral, 4 very positive.
POLARITY_WORDS = {
    0: ("worst", "horrible", "terrible", "awful", "disgusting"),
    1: ("slow", "cold", "rude", "dirty", "bland", "overpriced"),
    3: ("good", "nice", "fresh", "friendly", "tasty", "clean"),
    4: ("best", "great", "excellent", "amazing", "delicious", "perfect"),
}
POLARITY_PREFIXES = {1: ("un", "non", "dis")}
POLARITY_SUFFIXES = {3: ("ble", "ful", "ous")}

MARKER = "sentence_start"
ENTITY, OTHER = "B-OTH", "O"

WORD_CHARS = r"\p{L}\p{N}_"


def gap_tokens(text: Column, gap: str = r"\W", min_length: int = 4) -> Column:
    """Lower-case pieces between matches of ``gap`` that are long enough."""
    return F.filter(F.split(F.lower(text), gap), lambda w: F.length(w) >= min_length)


def remove_words(tokens: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """Drop listed words; other words keep their order and repeats."""
    return F.filter(tokens, lambda w: ~w.isin(list(words)))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{WORD_CHARS}]{{2,}})"), F.lit(1))


def split_trim(text: Column, separator: str = ",") -> Column:
    return F.transform(F.split(text, re.escape(separator)), lambda part: F.trim(part))


def keep_listed(parts: Column, allowed: Sequence[str], default: str | None = None, sep: str = ",") -> Column:
    """Parts found in ``allowed``, joined again; ``default`` when none is left."""
    kept = F.array_join(F.filter(parts, lambda p: p.isin(list(allowed))), sep)
    return kept if default is None else F.when(kept == "", default).otherwise(kept)


def phrase_count(text: Column, phrase: Column) -> Column:
    """How often ``phrase`` stands in ``text`` as whole words; it is taken literally."""
    literal = F.concat(F.lit(rf"(?<![{WORD_CHARS}])\Q"), phrase, F.lit(rf"\E(?![{WORD_CHARS}])"))
    return F.regexp_count(text, literal)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Punct}", "")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]", "")


def plain_words(text: Column) -> Column:
    """Whitespace tokens in lower case without punctuation and digits; no blanks."""
    cleaned = F.regexp_replace(F.lower(text), r"[\p{Punct}0-9]", "")
    return F.filter(F.split(cleaned, r"\s"), lambda w: w != "")


def _accent_pairs() -> tuple[str, str]:
    """Latin letters with accents and their base letters, by decomposition."""
    accented, plain = [], []
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


def strip_accents(text: Column) -> Column:
    accented, plain = _accent_pairs()
    return F.translate(text, accented, plain)


def sentences(text: Column) -> Column:
    """Parts between end marks that hold at least one character besides space."""
    return F.filter(F.split(text, r"[.!?]+(?:\s+|\z)"), lambda s: F.trim(s) != "")


def sentence_tokens(text: Column) -> Column:
    """Per sentence the start marker, its plain words, and a closing '.'."""
    marked = F.transform(
        sentences(text), lambda s: F.concat(F.array(F.lit(MARKER)), plain_words(s), F.array(F.lit(".")))
    )
    return F.flatten(marked)


def token_sentences(tokens: Column) -> Column:
    """Cut a token list at the start markers; the markers and empty parts go.

    Undoes the flattening of :func:`sentence_tokens` in one linear pass: tokens
    hold no white space, so joining and splitting is exact.
    """
    lines = F.concat(F.lit("\n"), F.array_join(tokens, "\n"), F.lit("\n"))
    parts = F.split(lines, rf"\n{MARKER}(?=\n)")
    cut = F.transform(parts, lambda p: F.filter(F.split(p, "\n"), lambda w: w != ""))
    return F.filter(cut, lambda words: F.size(words) > 0)


def pad(values: Column, width: int, filler) -> Column:
    """Cut or fill an array at its end to exactly ``width`` elements."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(filler), width)), 1, width)


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _ends_with(word: Column, suffixes: Sequence[str]) -> Column:
    return _any(word.endswith(suffix) for suffix in suffixes)


@dataclass(frozen=True)
class WordRules:
    """Word lists and endings that stand in for a tagger and a sentiment model; give your own to replace them.

    ``polarity_*`` map a score (0 very negative, 2 neutral, 4 very positive) to words, beginnings and endings.
    """

    noun_words: Sequence[str] = NOUN_WORDS
    noun_suffixes: Sequence[str] = NOUN_SUFFIXES
    adjective_words: Sequence[str] = ADJECTIVE_WORDS
    adjective_suffixes: Sequence[str] = ADJECTIVE_SUFFIXES
    polarity_words: Mapping[int, Sequence[str]] = field(default_factory=lambda: POLARITY_WORDS)
    polarity_prefixes: Mapping[int, Sequence[str]] = field(default_factory=lambda: POLARITY_PREFIXES)
    polarity_suffixes: Mapping[int, Sequence[str]] = field(default_factory=lambda: POLARITY_SUFFIXES)


RULES = WordRules()


def is_noun(word: Column, rules: WordRules = RULES) -> Column:
    listed = word.isin(list(rules.noun_words)) | _ends_with(word, rules.noun_suffixes)
    return listed & ~word.isin(list(rules.adjective_words))


def is_adjective(word: Column, rules: WordRules = RULES) -> Column:
    listed = word.isin(list(rules.adjective_words)) | _ends_with(word, rules.adjective_suffixes)
    return listed & ~word.isin(list(rules.noun_words))


SELECTORS = {
    "noun": is_noun,
    "adjective": is_adjective,
    "noun_adjective": lambda w, rules: is_noun(w, rules) | is_adjective(w, rules),
}


def select_words(tokens: Column, kind: str, if_empty: str | None = "na", rules: WordRules = RULES) -> Column:
    """Tokens of one word kind; an empty token list counts as ``[if_empty]``."""
    chosen = lambda w: SELECTORS[kind](w, rules)
    if if_empty is None:
        return F.filter(tokens, chosen)
    empty = F.array(F.lit(if_empty))
    return once(tokens, lambda t: F.when(F.size(t) == 0, empty).otherwise(F.filter(t, chosen)))


def word_polarity(word: Column, rules: WordRules = RULES) -> Column:
    score = F.when(F.lit(False), 0)
    for value, words in rules.polarity_words.items():
        score = score.when(word.isin(list(words)), value)
    for value, prefixes in rules.polarity_prefixes.items():
        score = score.when(_any(word.startswith(prefix) for prefix in prefixes), value)
    for value, suffixes in rules.polarity_suffixes.items():
        score = score.when(_ends_with(word, suffixes), value)
    return score.otherwise(2)


def _occurrences(values: Column, value: int) -> Column:
    return F.size(F.filter(values, lambda v: v == value))


def _mean(scores: Column) -> Column:
    """Mean of the scores, -1 when there are none."""
    total = F.aggregate(scores, F.lit(0), lambda a, s: a + s)
    return F.when(F.size(scores) == 0, -1.0).otherwise(total / F.size(scores))


def polarity_histogram(words: Column, rules: WordRules = RULES) -> Column:
    """Counts of the scores 0 to 4, then the mean score; mean -1 without words."""

    def histogram(scores: Column) -> Column:
        counts = [_occurrences(scores, value).cast("double") for value in range(5)]
        return F.array(*counts, _mean(scores))

    return once(F.transform(words, lambda w: word_polarity(w, rules)), histogram)


def document_polarity(words: Column, rules: WordRules = RULES) -> Column:
    """Mean word score rounded half up to 0..4; -1 without words."""
    rounded = lambda mean: F.when(mean < 0, -1).otherwise(F.floor(mean + 0.5).cast("int"))
    return once(once(F.transform(words, lambda w: word_polarity(w, rules)), _mean), rounded)


def has_entry(word: Column, lexicon: Sequence[str], mode: str = "substring") -> Column:
    """Does the word hold (or, with ``exact``, equal) an entry of a short lexicon?"""
    entries = [entry for entry in lexicon if entry.strip()]
    if not entries:
        return F.lit(False)
    if mode == "exact":
        return word.isin(entries)
    return _any(word.contains(entry) for entry in entries)
