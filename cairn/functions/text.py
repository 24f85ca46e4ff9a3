"""Text columns: normalization, ordered keywords, brand mentions and their context.

Word boundaries are written as look-arounds over ``WORD`` and never as ``\\b``:
what ``\\b`` means for accented letters changed between Java releases, while the
look-arounds mean the same on all of them.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Sequence
from functools import cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cairn.vocab import BRAND_STOP_WORDS

# The last letter is one of \p{L} already. Spelled out, it makes Java look behind by whole
# characters; a look-behind without any such literal sees half of a surrogate pair.
WORD = "[\\p{L}\\p{N}_\U00020000]"
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"
TOKEN = r"[A-Za-z0-9]++(?:[-'][A-Za-z0-9]++)*+"

# Typographic marks and what stands for them.
PLAIN_MARKS = {"’": "'", "–": "-", "—": "-"}

# Marks put around a mention inside a text; any already there are masked first.
OPEN, CLOSE, MASK = "\x02", "\x03", "\x01"

# Blocks in which a character that is its own NFKC form, and does not combine,
# stays as it is next to any other such character.
_STABLE_BLOCKS = [
    (0x00A0, 0x02AF), (0x0370, 0x052F), (0x2010, 0x2027), (0x2030, 0x205E),
    (0x20A0, 0x20CF), (0x3041, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
]


@cache
def nfkc_candidate_pattern() -> str:
    """A pattern that finds every text NFKC could change (and few others)."""
    stable = [
        c
        for low, high in _STABLE_BLOCKS
        for c in range(low, high + 1)
        if unicodedata.is_normalized("NFKC", chr(c)) and not unicodedata.combining(chr(c))
    ]
    runs = [list(g) for _, g in groupby(enumerate(stable), lambda ic: ic[1] - ic[0])]
    ranges = "".join(f"\\x{{{run[0][1]:X}}}-\\x{{{run[-1][1]:X}}}" for run in runs)
    # The cheap class goes first, so that the long one is only tried on non-ASCII characters.
    return rf"[^\x00-\x7F](?<![{ranges}])"


def nfkc(text: Column) -> Column:
    """NFKC form. Only texts it could change travel to Python; the others stay null there."""

    # A nested function travels to the executors by value: they need no copy of this package.
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    # Declared non-deterministic so that the optimizer never runs it a second time
    # by moving a filter on the result below it.
    udf = F.pandas_udf(compose, StringType()).asNondeterministic()
    return F.coalesce(udf(F.when(text.rlike(nfkc_candidate_pattern()), text)), text)


def normalize_text(text: Column) -> Column:
    """Null to empty, NFKC, plain quotes and dashes, single blanks, trimmed."""
    plain = nfkc(F.coalesce(text, F.lit("")))
    # Faster than one translate, which looks up every character.
    for mark, ascii_mark in PLAIN_MARKS.items():
        plain = F.replace(plain, F.lit(mark), F.lit(ascii_mark))
    return F.trim(F.regexp_replace(plain, BLANKS, " "))


# ---------------------------------------------------------------- keywords


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _left_edge(text: str) -> str:
    return f"(?<!{WORD})" if _is_word(text[0]) else f"(?<={WORD})"


def _right_edge(text: str) -> str:
    return f"(?!{WORD})" if _is_word(text[-1]) else f"(?={WORD})"


def whole_words(words: Sequence[str], blank: str = " ") -> str:
    """One pattern of whole words or phrases; at any position the earlier one of the list wins.

    Words are laid out as a tree by their characters, so what is tried at a position depends on the
    text there and not on how many words are listed. All words that match at a position lie on one
    branch; where one ends, those that are listed before it and go on are tried first.
    """
    words = list(dict.fromkeys(w for w in words if w))
    if not words:
        return r"(?!)"
    by_edge: dict[str, list[str]] = {}
    for w in words:
        by_edge.setdefault(_left_edge(w), []).append(w)
    return "(?:" + "|".join(
        edge + _branches([(w, w) for w in ws], blank) for edge, ws in by_edge.items()) + ")"


def _folded(c: str) -> str:
    """What two characters have in common that may match the same text, whatever the flags."""
    if c.isspace():
        return " "
    upper = c.upper() if len(c.upper()) == 1 else c
    return upper.lower() if len(upper.lower()) == 1 else upper


def _branches(rests: Sequence[tuple[str, str]], blank: str) -> str:
    """The pattern of what is left of words (with the words), earlier ones first."""
    ends = next((i for i, (rest, _) in enumerate(rests) if not rest), None)
    if ends is None:
        return _forked(rests, blank)
    options = [_branches(rests[:ends], blank)] if ends else []
    options.append(_right_edge(rests[ends][1]))
    if ends + 1 < len(rests):
        options.append(_branches(rests[ends + 1:], blank))
    return _either(options)


def _forked(rests: Sequence[tuple[str, str]], blank: str) -> str:
    by_first: dict[str, list[tuple[str, str]]] = {}
    for rest, word in rests:
        by_first.setdefault(_folded(rest[0]), []).append((rest, word))
    options = []
    for same in by_first.values():
        if len({rest[0] for rest, _ in same}) > 1:  # no tree: these could match the same text
            options += [_quote(rest, blank) + _right_edge(word) for rest, word in same]
            continue
        shared = os.path.commonprefix([rest for rest, _ in same])
        tails = [(rest[len(shared):], word) for rest, word in same]
        options.append(_quote(shared, blank) + _branches(tails, blank))
    return _either(options)


def _either(options: Sequence[str]) -> str:
    return options[0] if len(options) == 1 else f"(?:{'|'.join(options)})"


def _quote(text: str, blank: str) -> str:
    return blank.join(re.sub(r"([^\w\s])", r"\\\1", part) for part in text.split(" "))


def _keyword_pattern(words: Sequence[str]) -> str:
    """``whole_words`` behind two cheap tests that turn most positions away."""
    pattern = whole_words(words)
    if not all(w and _is_word(w[0]) for w in words):
        return pattern
    return f"(?=[{''.join(sorted({w[0] for w in words}))}])(?<![a-z0-9]){pattern}"


def has_keyword(text: Column, words: Sequence[str]) -> Column:
    """Whether any of the words occurs whole in the lower-cased text (null counts as no)."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.lower(text).rlike(_keyword_pattern(words)), F.lit(False))


def first_keyword(text: Column, words: Sequence[str]) -> Column:
    """The word that comes first *in the list* among those in the text, else null.

    One scan finds, at every position, the earliest listed word starting there;
    the list then decides among the hits.
    """
    words = list(words)
    if not words:
        return F.lit(None).cast("string")
    hits = F.regexp_extract_all(F.lower(text), F.lit(f"(?=({_keyword_pattern(words)}))"), F.lit(1))
    return F.get(F.array_intersect(F.array(*map(F.lit, words)), hits), F.lit(0))


# ------------------------------------------------------------------ brands


def brand_acronyms(brands: Sequence[str]) -> list[str]:
    """First letters of every brand of two words or more."""
    split = [b.split() for b in brands]
    return ["".join(w[0] for w in ws).lower() for ws in split if len(ws) > 1]


def brand_alternatives(
    brands: Sequence[str],
    extras: Sequence[str] = (),
    stop_words: Sequence[str] = BRAND_STOP_WORDS,
) -> list[str]:
    """Lower-cased brands, their spellings without punctuation, and extras; longest first."""
    names = {b.lower() for b in brands}
    bare = {re.sub(r"[^\w\s]", "", n) for n in names}
    found = (names | bare | {e.lower() for e in extras}) - set(stop_words) - {""}
    return sorted(found, key=lambda a: (-len(a), a))


def brand_pattern(brands: Sequence[str], stop_words: Sequence[str] = BRAND_STOP_WORDS) -> str:
    """The pattern of all brand spellings and acronyms, case-insensitive, whole words."""
    alternatives = brand_alternatives(brands, brand_acronyms(brands), stop_words)
    if any(mark in a for a in alternatives for mark in (OPEN, CLOSE)):
        raise ValueError("brands must not hold control characters")
    return "(?iu)" + whole_words(alternatives, blank=r"\s+")


def mark_mentions(text: Column, pattern: str) -> Column:
    """The text with every brand mention put between marks: the one costly scan."""
    masked = F.replace(F.replace(text, F.lit(OPEN), F.lit(MASK)), F.lit(CLOSE), F.lit(MASK))
    return F.regexp_replace(masked, pattern, f"{OPEN}$0{CLOSE}")


def _reach(window: int | None) -> str:
    """The stretch holding the next ``window`` tokens; marks inside a token are skipped."""
    link = f"[{OPEN}{CLOSE}]*+[-'][{OPEN}{CLOSE}]*+"
    token = f"[A-Za-z0-9]++(?:{link}[A-Za-z0-9]++)*+"
    count = "*+" if window is None else f"{{0,{window}}}+"
    return f"(?:[^A-Za-z0-9]*+{token}){count}"


def marked_mentions(marked: Column, window_words: int) -> Column:
    """Array of (mention, left, right) from a marked text, in text order.

    ``left`` and ``right`` are the raw stretches that hold the nearest
    ``window_words`` tokens. The left ones are read off the reversed text, so the
    work grows with the text and the contexts, not with mentions times text. A
    window of 0 keeps the whole left side and nothing on the right.
    """
    right_window, left_window = window_words, window_words or None
    mentions = F.regexp_extract_all(marked, F.lit(f"{OPEN}([^{CLOSE}]*+){CLOSE}"), F.lit(1))
    right = F.regexp_extract_all(
        marked, F.lit(f"{CLOSE}(?=({_reach(right_window)}))"), F.lit(1)
    )
    left = F.regexp_extract_all(
        F.reverse(marked), F.lit(f"{OPEN}(?=({_reach(left_window)}))"), F.lit(1)
    )
    return F.arrays_zip(
        mentions.alias("mention"), F.reverse(left).alias("left"), right.alias("right")
    )


def _tokens(stretch: Column) -> Column:
    plain = F.translate(stretch, OPEN + CLOSE, "")
    joined = F.array_join(F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0)), " ")
    return F.nullif(joined, F.lit(""))


def context_window(mention: Column, left: Column, right: Column) -> Column:
    """Tokens to the left, the mention as written, tokens to the right."""
    return F.concat_ws(" ", _tokens(F.reverse(left)), mention, _tokens(right))
