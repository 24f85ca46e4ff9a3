import random
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from cairn.functions.text import (
    brand_acronyms,
    brand_alternatives,
    brand_pattern,
    first_keyword,
    has_keyword,
    nfkc_candidate_pattern,
    normalize_text,
    whole_words,
)
from cairn.operators.mentions import brand_mentions
from cairn.vocab import GEAR_BRANDS, GEAR_CATEGORIES, WEATHER_SEASON_WORDS


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.v for r in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def mentions(spark, text, window, pattern=None):
    rows = spark.createDataFrame([(text,)], "t string")
    found = brand_mentions(rows, "t", pattern or brand_pattern(GEAR_BRANDS), window)
    return [(r.gear_brand, r.brand_context) for r in found.orderBy("mention_pos").collect()]


@pytest.mark.parametrize("text, words, expected", [
    ("Early spring hike", WEATHER_SEASON_WORDS, "spring"),
    ("mid-summer heat", WEATHER_SEASON_WORDS, "summer"),
    ("midwinter", WEATHER_SEASON_WORDS, "midwinter"),
    ("rainy then summer", WEATHER_SEASON_WORDS, "summer"),
    ("any recommendations?", WEATHER_SEASON_WORDS, "recommendations"),
    ("raincoat", WEATHER_SEASON_WORDS, None),
    ("my gps device", GEAR_CATEGORIES, "gps"),
    ("rain jacket", GEAR_CATEGORIES, "rain jacket"),
    ("rain\njacket", GEAR_CATEGORIES, "jacket"),
    ("base\nlayer", GEAR_CATEGORIES, None),
    ("base layers", GEAR_CATEGORIES, None),
    ("", GEAR_CATEGORIES, None),
    (None, GEAR_CATEGORIES, None),
    ("Été: HOT", WEATHER_SEASON_WORDS, "hot"),
    ("éhot hoté _hot", WEATHER_SEASON_WORDS, None),
])
def test_first_keyword(spark, text, words, expected):
    assert column(spark, [text], lambda c: first_keyword(c, words)) == [expected]
    assert column(spark, [text], lambda c: has_keyword(c, words)) == [expected is not None]


def test_keywords_are_literal_and_case_bound(spark):
    words = ["a.b", "c++", "Hot", "hot"]
    got = column(spark, ["axb", "A.B", "c++x", "c++", "hot"], lambda c: first_keyword(c, words))
    assert got == [None, "a.b", "c++", None, "hot"]
    assert column(spark, ["x"], lambda c: first_keyword(c, [])) == [None]
    assert column(spark, ["x"], lambda c: has_keyword(c, [])) == [False]


def test_first_keyword_matches_one_scan_per_word(spark):
    rng = random.Random(5)
    vocabulary = [*WEATHER_SEASON_WORDS, *GEAR_CATEGORIES, "é", "-", "x", ".", "\n", "ñhot", "²"]
    texts = [
        "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "", "  "]) for _ in range(rng.randint(0, 9)))
        for _ in range(400)
    ]
    for words in (WEATHER_SEASON_WORDS, GEAR_CATEGORIES):
        expected = [
            next((w for w in words if re.search(rf"\b{re.escape(w)}\b", t.lower())), None)
            for t in texts
        ]
        assert column(spark, texts, lambda c: first_keyword(c, words)) == expected


@pytest.mark.parametrize("raw, clean", [
    (None, ""),
    ("ﬁt", "fit"),
    ("MSR™", "MSRTM"),
    ("it’s 3–season — ok", "it's 3-season - ok"),
    ("a\t\r\n\u00a0\x1c\x85\u2028b", "a b"),
    ("  x  ", "x"),
    ("e\u0301te\u0301", "été"),
    ("Fjällräven ’n’ co", "Fjällräven 'n' co"),
])
def test_normalize(spark, raw, clean):
    assert column(spark, [raw], normalize_text) == [clean]


def test_no_text_that_nfkc_changes_escapes_the_gate():
    gate = nfkc_candidate_pattern()
    stable = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))),
                                     gate.split("(?<![")[1].split("])")[0]) + "]")
    kept = [chr(c) for c in range(0x80, 0x110000) if stable.fullmatch(chr(c))]
    assert len(kept) > 30_000
    assert all(unicodedata.normalize("NFKC", c) == c for c in kept)
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choices(kept[:1500] + list("aeiou ~^`"), k=12))
        assert unicodedata.normalize("NFKC", t) == t


def test_brand_alternatives():
    found = brand_alternatives(GEAR_BRANDS, brand_acronyms(GEAR_BRANDS))
    assert len(found) == 84
    assert {"arcteryx", "inov8", "thermarest", "mh", "nf"} <= set(found)
    assert not {"or", "so"} & set(found)
    assert found.index("arc'teryx") < found.index("arc")


@pytest.mark.parametrize("text, window, expected", [
    ("I love my Osprey pack", 2, [("osprey", "love my Osprey pack")]),
    ("Osprey", 12, [("osprey", "Osprey")]),
    ("Osprey, osprey!", 12, [("osprey", "Osprey osprey"), ("osprey", "Osprey osprey")]),
    ("an Arc'teryx shell", 12, [("arc'teryx", "an Arc'teryx shell")]),
    ("old NF and North Face", 12,
     [("nf", "old NF and North Face"), ("north face", "old NF and North Face")]),
    ("this or that", 12, []),
    ("ask Mr. Smith", 12, [("mr", "ask Mr Smith")]),
    ("my Fjällräven bag by Osprey", 3,
     [("fjällräven", "my Fjällräven bag by Osprey"), ("osprey", "ven bag by Osprey")]),
    ("a b Osprey c d", 0, [("osprey", "a b Osprey")]),
    ("MSRTM stove", 12, []),
    ("re-osprey-like pre-Osprey-x a", 3,
     [("osprey", "re osprey like pre-Osprey-x a"), ("osprey", "re-osprey-like pre Osprey x a")]),
    ("\x02osprey\x03 \x02 x", 12, [("osprey", "osprey x")]),
    (None, 12, []),
])
def test_mentions(spark, text, window, expected):
    assert mentions(spark, text, window) == expected


def brute_force(text, alternatives, window):
    token = re.compile(r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)*")
    edged = (rf"\b{re.escape(a)}\b" for a in alternatives)
    out = []
    for m in re.finditer("|".join(edged), text, re.I):
        before, after = token.findall(text[: m.start()]), token.findall(text[m.end():])
        words = before[max(len(before) - window, 0) if window else 0:] + [m[0]] + after[:window]
        out.append((m[0].lower(), " ".join(words)))
    return out


@pytest.mark.parametrize("window", [0, 1, 3, 12])
def test_mentions_against_brute_force(spark, window):
    brands = ["Arc'teryx", "Arc", "North Face", "Therm-a-Rest", "Fjällräven", "Ünder", "MSR", "日本"]
    alternatives = brand_alternatives(brands, brand_acronyms(brands))
    rng = random.Random(window)
    pieces = [*brands, "north", "face", "nf", "a", "b2", "x'y", "é", "-", "'", ".", "--", "\x02",
              "\x03", "²", "_", "𝔸", "msr-msr"]
    texts = [
        "".join(rng.choice(pieces) + rng.choice([" ", "", "-", "'", ", "]) for _ in range(rng.randint(0, 40)))
        for _ in range(300)
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = brand_mentions(rows, "t", brand_pattern(brands), window)
    got = {}
    for r in found.orderBy("i", "mention_pos").collect():
        got.setdefault(r.i, []).append((r.gear_brand, r.brand_context))
    for i, t in enumerate(texts):
        # The marks themselves are masked by another control character before the search.
        assert got.get(i, []) == brute_force(t, alternatives, window), repr(t)


def test_long_hyphen_chains_do_not_overflow(spark):
    chain = "-".join(["ab", "c", "def"] * 60_000)
    [(brand, context)] = mentions(spark, f"{chain} osprey {chain}", 2)
    assert brand == "osprey"
    assert context == f"{chain} osprey {chain}"


def test_many_mentions_in_one_text(spark):
    text = "osprey pack and rain " * 20_000
    rows = spark.createDataFrame([(text,)], "t string")
    found = brand_mentions(rows, "t", brand_pattern(GEAR_BRANDS), 12)
    assert found.count() == 20_000
    middle = found.where(F.col("mention_pos") == 10).first().brand_context
    assert middle == "osprey pack and rain " * 6 + "osprey"


def first_listed(text, words):
    """Of the words that stand whole at the first place where any does, the one listed first."""
    edge = lambda c: c is not None and (c == "_" or c.isalnum())
    for at in range(len(text)):
        for word in words:
            end = at + len(word)
            if word and text[at:end] == word:
                before, after = text[at - 1] if at else None, text[end] if end < len(text) else None
                if edge(before) != edge(word[0]) and edge(after) != edge(word[-1]):
                    return at, word
    return None


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_of_words_matches_what_the_list_does(spark, seed):
    rnd = random.Random(seed)
    letters = ["ab ", "abc", "a-b +", "aé "][seed]
    words = [w.strip() or "a" for w in ("".join(rnd.choices(letters, k=rnd.randrange(1, 6))) for _ in range(40))]
    texts = ["".join(rnd.choices(letters + " ", k=rnd.randrange(14))) for _ in range(300)]
    got = column(spark, texts, lambda c: F.regexp_extract(c, whole_words(words), 0))
    assert got == [(first_listed(t, words) or (0, ""))[1] for t in texts]


def test_ten_thousand_words(spark):
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choices("abcdefghij", k=rnd.randrange(3, 9))) for _ in range(13_000)})[:10_000]
    rnd.shuffle(words)
    pattern = whole_words(words)
    assert len(words) == 10_000 and len(pattern) < sum(len(w) + 30 for w in words)
    texts = [" ".join(rnd.choice(words) if rnd.random() < 0.3 else "".join(rnd.choices("abcdefghijk", k=5))
                      for _ in range(rnd.randrange(12))) for _ in range(2_000)]
    known = set(words)
    got = column(spark, texts, lambda c: F.array_join(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), " "))
    assert got == [" ".join(w for w in t.split() if w in known) for t in texts]


def test_words_with_characters_that_fold_alike_are_tried_in_turn(spark):
    words = ["straße", "\u017fo", "so"]  # a long s folds to an s
    got = column(spark, ["So", "\u017fo x", "STRASSE straße"], lambda c: F.regexp_extract(c, "(?iu)" + whole_words(words), 0))
    assert got == ["So", "\u017fo", "straße"]
