"""Rows of one id, and rows without one, are documents of their own."""

from __future__ import annotations

import collections
import random
import re

import pytest

from cairn.llm import near_duplicates, repeats
from cairn.llm.common import text_key

WORDS = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORDS.findall((text or "").lower())
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def components(rows, size, percent):
    """For each row the members of its component, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(i)
    return {i: members for members in groups.values() for i in members}


def documents(seed):
    rnd = random.Random(seed)
    words = lambda n: " ".join(f"w{rnd.randrange(10 ** 5)}" for _ in range(n))
    rows = []
    for i in range(40):
        text = words(rnd.choice([6, 30, 60]))
        for _ in range(rnd.randrange(1, 4)):
            changed = text if rnd.random() < 0.4 else text.replace(rnd.choice(text.split()), "changed", 1)
            rows.append((rnd.choice([None, 1, 2, 3, i]), changed))
    return rows + [(None, ""), (None, ""), (5, None), (5, "  "), (7, "short other text")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_of_rows_of_one_id_are_all_found(spark, seed):
    rows = documents(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = collections.Counter(tuple(r) for r in near_duplicates.near_duplicates(docs, 2, 80).select(
        "doc_id", "n_shingles", "component_id").collect())
    member, want = components(rows, 2, 80), collections.Counter()
    for i, (doc, text) in enumerate(rows):
        ids = [rows[j][0] for j in member[i] if rows[j][0] is not None]
        many = len(shingles(text, 2))
        want[doc, many, (min(ids) if ids else None) if many else doc] += 1
    assert got == want
    left = collections.Counter(tuple(r) for r in near_duplicates.distinct_documents(docs, 2, 80).collect())
    assert not left - collections.Counter(rows)
    worded = [i for i, (_, t) in enumerate(rows) if shingles(t, 2)]
    assert sum(left.values()) == len({min(member[i]) for i in worded}) + len(rows) - len(worded)
    stays = [i for i in worded if rows[i] in left]
    assert {min(member[i]) for i in stays} == {min(member[i]) for i in worded}
    kept = near_duplicates.near_duplicates(docs, 2, 80).where("kept AND component_id IS NULL").count()
    groups = {min(member[i]) for i in worded if all(rows[j][0] is None for j in member[i])}
    assert kept == len(groups) + sum(doc is None for doc, t in rows if not shingles(t, 2))


def test_spans_cut_only_the_text_they_are_of(spark):
    rnd = random.Random(4)
    line = " ".join(f"word{i}" for i in range(12))
    passage = " ".join(f"p{rnd.randrange(10 ** 6)}" for _ in range(60))
    other = " ".join(f"o{rnd.randrange(10 ** 6)}" for _ in range(70))
    rows = [
        (3, line), (7, "short other text that stays as it is"), (7, line), (None, f"{line}\nown"), (None, other),
        (9, f"x {passage}"), (9, f"y z {passage} end"), (None, f"{passage} tail"), (5, f"{line} more"), (5, f"{line} more"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = repeats.repeats(docs).unionByName(repeats.passages(docs))
    left = sorted((r.doc_id or 0, r.text) for r in repeats.remove(docs, found).collect())
    nines = sorted(t for d, t in left if d == 9)
    keys = {r.text: r.k for r in docs.select("text", text_key().alias("k")).collect()}
    first, later = sorted((f"x {passage}", f"y z {passage} end"), key=keys.get)
    assert nines == sorted([first, later.replace(passage, "").replace("  ", " ") if later.startswith("y") else "x "])
    assert [(d, t) for d, t in left if d != 9] == sorted([
        (0, "own"), (0, other), (0, "tail"), (3, line), (5, f"{line} more"), (5, f"{line} more"), (7, ""),
        (7, "short other text that stays as it is")])
    # Rows equal in id and text are one document.
    assert found.where("doc_id = 5").count() == 0
