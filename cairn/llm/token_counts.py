"""Token counts at every prefix, by dynamic programming over byte-pair tokens.

A byte-pair encoding of a string is the one chain of tokens in which every two neighbours are
*stable*: encoding their joined bytes gives just these two. So the encoding of a prefix is the
encoding of a shorter prefix plus one token that is stable after that prefix's last token, and
one pass over a word yields the exact count at each of its prefixes. Words (pieces of the
tokenizer's pattern) are encoded apart, so a text's counts are the running sums of its words'.
Truncation and budget questions then read the stored counts and encode nothing again.

Defined results: null text counts as empty; an empty text has no prefix and 0 tokens; repeated
rows give repeated results; an empty table gives an empty table. Texts of any length are taken
whole. Only ``doc_id`` and ``text`` are read, so further columns can't clash.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame

from cairn.llm.common import Remembered, map_rows, texts

#: Words whose counts a worker remembers at most, and half the pairs.
REMEMBERED = 400_000
#: The tokenizer's pattern joined with white space before a word, and contractions.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
UNITS = r"'(?:s|t|re|ve|m|ll|d)|(?:\s* )?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+"
#: The same for texts of the characters below, in the syntax (and speed) of ``re``.
LATIN_UNITS = r"'(?:s|t|re|ve|m|ll|d)|(?:\s* )?(?:[^\W\d_]+|\d+|(?:[^\w\s]|_)+)|\s+"
NOT_LATIN = r"[^\t-\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]"


def byte_symbols() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 characters
    for themselves, and the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """Ranks of a byte-level byte-pair tokenizer file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(symbols[c] for c in token): number
            for token, number in spec["model"]["vocab"].items() if token not in self.special
        }
        import public_tokenizers

        self.encoding = tiktoken.Encoding(
            "pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.tokens = {number: token for token, number in ranks.items()}
        # Tokens by their bytes from the last to the first: (next bytes, token or -1).
        self.back: tuple[dict, int] = ({}, -1)
        for token, number in ranks.items():
            node = self.back
            for byte in reversed(token[1:]):
                node = node[0].setdefault(byte, ({}, -1))
            below = node[0].get(token[0], ({}, -1))[0]
            node[0][token[0]] = (below, number)
        self.pairs: dict[int, bool] = {}
        self.data, self.last, self.counts = b"", [-1], [0]

    def ids(self, text: str) -> np.ndarray:
        """The ids the library gives, special strings taken as special tokens (its default)."""
        if self.special_pattern.search(text):
            return np.array(self.encoding.encode(text, allowed_special="all"), dtype=np.uint32)
        try:
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        except UnicodeEncodeError:
            return np.array(self.encoding.encode_ordinary(text), dtype=np.uint32)

    def _stable(self, left: int, right: int, key: int) -> bool:
        if len(self.pairs) >= 4 * REMEMBERED:
            self.pairs.clear()
        joined = self.tokens[left] + self.tokens[right]
        known = self.pairs[key] = list(self.encoding._encode_single_piece(joined)) == [left, right]
        return known

    def word_prefixes(self, word: str) -> list[int]:
        """Counts of the word's prefixes, by characters, for a word of one class of letters.

        What the word shares with the one before is not worked out again, so sorted words are
        quick."""
        data = word.encode("utf-8", "surrogatepass")
        size, shared, before = len(data), 0, self.data
        most = min(size, len(before))
        while shared < most and data[shared] == before[shared]:
            shared += 1
        last, counts, root, pairs = self.last[:shared + 1], self.counts[:shared + 1], self.back, self.pairs
        for end in range(shared, size):
            node, start = root, end
            while True:  # a single byte is a token, so some chain always ends here
                node = node[0][data[start]]
                token = node[1]
                if token >= 0:
                    if start == 0:
                        break
                    left = last[start]
                    key = left << 20 | token
                    known = pairs.get(key)
                    if known or known is None and self._stable(left, token, key):
                        break
                start -= 1
            last.append(token)
            counts.append(counts[start] + 1)
        self.data, self.last, self.counts = data, last, counts
        if size == len(word):
            return counts[1:]
        return [counts[i + 1] for i in range(size) if i + 1 == size or data[i + 1] & 0xC0 != 0x80]


class PrefixCounter:
    """Counts at every prefix of whole texts; remembers a bounded number of words."""

    def __init__(self, path: str):
        self.pairs = BytePairs(path)
        self.not_latin = re.compile(NOT_LATIN)
        self.latin_words, self.words = re.compile(LATIN_UNITS).findall, regex.compile(UNITS).findall
        self.unit = Remembered(self._unit, REMEMBERED)

    def units(self, text: str) -> list[str]:
        return (self.words if self.not_latin.search(text) else self.latin_words)(text)

    def _unit(self, unit: str) -> tuple[bytes, int]:
        """The counts inside a unit (white space and the word after it), as int32 bytes, and what
        the unit adds for the text after it."""
        words = unit.lstrip() if unit[0].isspace() else unit
        count = self.pairs.word_prefixes
        if not words:  # white space before another word gives its last character away
            inside = count(unit)
            adds = inside[-2] + count(unit[-1])[-1] if len(unit) > 1 else inside[-1]
        elif unit in CONTRACTIONS and len(unit) == 3:
            inside = [1, 1 + count(unit[1])[0], count(unit)[-1]]
            adds = inside[-1]
        else:
            blank = len(unit) - len(words)
            lead = count(unit[:blank - 1]) if blank > 1 else []
            word = count(unit[max(0, blank - 1):])
            base = lead[-1] if lead else 0
            inside = lead + [base + n for n in word]
            if blank > 1:
                inside[blank - 1] = count(unit[:blank])[-1]
            adds = inside[-1]
        return np.array(inside, dtype="<i4").tobytes(), adds

    def learn(self, texts: list[list[str]]) -> None:
        """Works out the new units of some texts in order, where neighbours share prefixes."""
        for word in sorted(set().union(*texts).difference(self.unit.new)):
            self.unit(word)

    def _plain(self, units: list[str]) -> np.ndarray:
        unit, get = self.unit, self.unit.new.get
        inside, adds = zip(*[get(word) or unit(word) for word in units])
        sizes = np.fromiter(map(len, inside), dtype=np.int64, count=len(inside)) // 4
        adds = np.array(adds, dtype=np.int64)
        return np.frombuffer(b"".join(inside), dtype="<i4") + np.repeat(np.cumsum(adds) - adds, sizes)

    def all_counts(self, texts: list[str]) -> list[np.ndarray]:
        special = self.pairs.special_pattern.search
        units = [None if not t or special(t) else self.units(t) for t in texts]
        self.learn([u for u in units if u])
        return [self.counts(t) if u is None else self._plain(u) for t, u in zip(texts, units)]

    def counts(self, text: str) -> np.ndarray:
        """Element i is the token count of ``text[:i + 1]``."""
        if not text:
            return np.zeros(0, dtype=np.int64)
        if not self.pairs.special_pattern.search(text):
            return self._plain(self.units(text))
        parts, base, at = [], 0, 0
        for match in self.pairs.special_pattern.finditer(text):
            before = text[at:match.start()]
            if before:
                parts.append(base + self._plain(self.units(before)))
            ends = [self.pairs.encoding.encode_ordinary(before + match[0][:n]) for n in range(1, len(match[0]))]
            closed = int(parts[-1][-1]) if before else base
            parts.append(np.array([base + len(e) for e in ends] + [closed + 1]))
            base, at = closed + 1, match.end()
        if at < len(text):
            parts.append(base + self._plain(self.units(text[at:])))
        return np.concatenate(parts)


@functools.cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


@functools.cache
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


def fitting_chars(counts: np.ndarray, limit: int) -> int:
    """The most characters a prefix of at most ``limit`` tokens can have."""
    fits = np.flatnonzero(counts <= limit)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_steps(counts: np.ndarray) -> bytes:
    """Counts as one signed byte a character: the change from the prefix before. A token has at
    most 128 bytes, so a longer prefix never has more than 127 tokens fewer."""
    return np.diff(counts, prepend=0).astype(np.int8).tobytes()


def counts_of(steps: bytes) -> np.ndarray:
    """The counts at every prefix, from what ``prefix_counts`` stored."""
    return np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64)


def prefix_counts(documents: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """Per document: ``n_bytes``, ``n_tokens``, ``prefix_steps`` (see ``counts_of``) and
    ``fitting_chars``, the most characters that fit in ``limit`` tokens."""

    def run(rows: dict) -> dict:
        made = counter(tokenizer).all_counts(rows["text"])
        return {
            "doc_id": rows["doc_id"],
            "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in rows["text"]],
            "n_tokens": [int(c[-1]) if len(c) else 0 for c in made],
            "prefix_steps": [prefix_steps(c) for c in made],
            "fitting_chars": [fitting_chars(c, limit) for c in made],
        }

    return map_rows(
        texts(documents),
        "doc_id bigint, n_bytes bigint, n_tokens bigint, prefix_steps binary, fitting_chars bigint", run)


def truncate(documents: DataFrame, counted: DataFrame) -> DataFrame:
    """The documents with the longest prefix that fits the limit of ``prefix_counts``; nothing is
    encoded again."""
    from pyspark.sql import functions as F

    fits = counted.select("doc_id", F.col("fitting_chars").alias("_fits"))
    return (
        documents.join(fits, "doc_id")
        .withColumn("text", F.substring(F.col("text"), F.lit(1), F.col("_fits").cast("int")))
        .drop("_fits")
    )
