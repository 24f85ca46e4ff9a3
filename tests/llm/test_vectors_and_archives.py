"""Archives, clusters and whitening beside brute force in plain Python."""

from __future__ import annotations

import collections
import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import centroids, warc, whitening

LONG = "<p>very long</p>" * 60_000
TWIN = "<html>" + "equal payload é " * 90 + "</html>"
#: page_id, url, html: null, empty, long, equal, repeated and short rows.
PAGES = [
    (1, "http://a.example/", TWIN), (7, "http://b.example/", TWIN), (7, "http://b.example/", TWIN), (3, None, TWIN),
    (2, "http://c.example/é\r\nX: y", "short"), (4, "http://d.example/", "short"), (4, "http://d.example/", "short"),
    (5, "", ""), (6, "http://e.example/", None), (8, "http://f.example/", LONG), (9, "http://g.example/", LONG),
    (None, None, TWIN), (None, "http://h.example/", "x" * 1000), (None, "http://i.example/", "x" * 1000),
    (-4, "http://j.example/", "y" * 1000), (10, "http://k.example/", "z" * 999), (11, "http://k.example/", "z" * 999),
]


def pages_of(spark, rows):
    made = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return made.withColumns({c: F.lit("taken") for c in ("key", "digest", "shard", "member", "part", "size", "copies", "lead")})


def expected(rows):
    """One row for each page, by the rules."""
    groups = collections.defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        digest = hashlib.sha1(data).hexdigest()
        known = [i for i in ids if i is not None]
        lead = max(known) if known else None
        if len(data) < 1000 or len(ids) == 1:
            out += [(i, len(data), digest, "response", None) for i in ids]
        else:
            out.append((lead, len(data), digest, "response", None))
            others = list(ids)
            others.remove(lead)
            out += [(i, len(data), digest, "revisit", lead) for i in others]
    return collections.Counter(out)


def test_archives_give_back_every_page(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    manifest = warc.write(pages_of(spark, PAGES), folder, file_bytes=2000, shard_bytes=4000)
    got = warc.read(spark, folder).collect()
    assert collections.Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(PAGES)
    html = {(r.page_id, bytes(r.html)) for r in got if r.record_type == "response"}
    assert (9, LONG.encode()) in html and (7, TWIN.encode()) in html and (6, b"") in html
    assert len({r.record_id for r in got}) == len(PAGES)
    assert "\r" not in "".join(r.url for r in got) and {r.url for r in got} >= {"urn:page:3", "http://d.example/"}
    # Files are rolled, and are what any gzip reader takes for WARC records.
    assert manifest.count() > 3 and not (tmp_path / "archive/_temporary").exists()
    for name in (tmp_path / "archive").glob("*.warc.gz"):
        data = gzip.decompress(name.read_bytes())
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")


def test_archives_do_not_depend_on_how_rows_are_dealt(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, f"http://x.example/{i}", "".join(rnd.choices("abcdef ", k=rnd.randrange(3000)))) for i in range(300)]
    rows += [(1000, "http://hot.example/", TWIN)] * 200
    found = []
    for way in range(2):
        rnd.shuffle(rows)
        pages = pages_of(spark, rows).repartition(1 + 6 * way)
        names = warc.write(pages, f"file://{tmp_path}/{way}", file_bytes=20_000, shard_bytes=50_000)
        found.append(sorted(tuple(r) for r in names.collect()))
    assert found[0] == found[1] and len(found[0]) > 10
    read = warc.read(spark, f"file://{tmp_path}/1")
    hot = read.where("page_id = 1000").groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in hot} == {"response": 1, "revisit": 199}


def test_only_files_of_the_manifest_count(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    pages = pages_of(spark, PAGES)
    (tmp_path / "archive/_temporary").mkdir(parents=True)
    (tmp_path / "archive/_temporary/part-0000000-0000.warc.gz.lost").write_bytes(b"of an executor that was lost")
    warc.write(pages, folder, shard_bytes=4000)
    assert warc.read(spark, folder).count() == len(PAGES)
    first = sorted((tmp_path / "archive").glob("*.warc.gz"))[0]
    data = first.read_bytes()
    first.write_bytes(data[:-1] + b"x")
    with pytest.raises(Exception, match="not what the manifest says"):
        warc.read(spark, folder).collect()
    first.rename(f"{first}.gone")
    with pytest.raises(ValueError, match="lacks files"):
        warc.read(spark, folder)


def test_no_pages(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    assert warc.write(pages_of(spark, []), folder).count() == 0
    assert warc.read(spark, folder).count() == 0


# --- clusters -------------------------------------------------------------------------------------

def embedded(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return made.withColumns({c: F.lit("taken") for c in ("cluster", "v", "n", "distance", "dim", "x", "component", "i", "total")})


def clusters(rows, k, rounds, dim):
    """The rounds with Python integers."""
    kept = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middles = [v for _, v in named[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(middles)), key=lambda j: (away(v, middles[j]), j))
    for _ in range(rounds):
        where = [nearest(v) for _, v in kept]
        for j in range(len(middles)):
            own = [v for (_, v), w in zip(kept, where) if w == j]
            if own:
                middles[j] = [sum(c) // len(own) for c in zip(*own)]
    out = [(i, nearest(v), away(v, middles[nearest(v)])) for i, v in kept]
    inertia = collections.Counter()
    for _, j, d in out:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return collections.Counter((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in out)


def some_vectors(seed, many, dim, size=1.0, step=None):
    rnd = random.Random(seed)
    value = lambda: rnd.gauss(0, size) if step is None else rnd.randrange(-3, 4) * step
    return [(i, [value() for _ in range(dim)]) for i in range(many)]


ODD = [
    (900, None), (901, []), (902, [1.0]), (903, [float("nan")] * 4), (904, [1.0, None, 2.0, 3.0]), (905, [float("inf")] * 4),
    (906, [0.5, 0.5, 0.5, 0.5]), (906, [0.5, 0.5, 0.5, 0.5]), (906, [0.25, 0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5, 0.5]),
]


@pytest.mark.parametrize("rows, k", [
    (some_vectors(1, 300, 4) + ODD, 9), (some_vectors(2, 200, 4, step=0.25) + ODD, 8),  # ties
    (some_vectors(3, 5, 4), 40), (some_vectors(4, 40, 4, size=1e12), 7), ([(1, [0.1] * 4)] * 60 + ODD, 3), (ODD, 1),
])
def test_clusters_are_those_of_plain_integers(spark, rows, k):
    found = centroids.cluster(embedded(spark, rows).repartition(3), k=k, rounds=3, dim=4)
    got = collections.Counter(tuple(r) for r in found.collect())
    big = lambda x: x if x < 1 << 63 else None
    want = collections.Counter({(i, j, big(d), big(a), big(b), s): n for (i, j, d, a, b, s), n in clusters(rows, k, 3, 4).items()})
    assert got == want


def test_no_vectors(spark):
    for rows in ([], ODD[:6]):
        found = centroids.cluster(embedded(spark, rows), dim=4)
        assert found.count() == 0 and found.columns[0] == "vec_id"
        assert whitening.whiten(embedded(spark, [r for r in rows if r[0] not in (902,)])).count() == 0


def test_a_tournament_takes_k_minus_one_tests_and_favours_small_numbers():
    same = np.array([[0, 0], [2, 0], [0, 2], [2, 2], [0, 0]], dtype=np.int64)
    tests = centroids.Tournament(same)
    assert tests.winners(np.array([[1, 1], [0, 0], [2, 1], [9, 9]], dtype=np.int64)).tolist() == [0, 0, 1, 3]
    assert centroids.Tournament(same[:1]).winners(same).tolist() == [0] * 5


# --- whitening ------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [3, 1000, 1 << 40, 1 << 61])
def test_bit_slices_give_the_exact_products(size):
    random_ = np.random.default_rng(5)
    x = random_.integers(-size, size, (150, 5)) + whitening.OFFSET
    sums, products = whitening.scatter(x)
    wide = x.astype(object) - whitening.OFFSET
    assert sums.tolist() == wide.sum(axis=0).tolist()
    assert np.triu(products).tolist() == np.triu(wide.T @ wide).tolist()


def test_whitening_is_what_plain_integers_give(spark):
    rnd = np.random.default_rng(6)
    mixed = rnd.normal(size=(400, 20)) @ rnd.normal(size=(20, 20)) + 3
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)] + [(1000, mixed[0].tolist())] * 300 + [(None, mixed[1].tolist())]
    rows += [r for r in ODD if r[1] is None or len(r[1]) == 0 or (r[0] in (903, 904, 905))]
    got = whitening.whiten(embedded(spark, rows).repartition(3)).collect()
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows[:701]]
    fit = [list(v) for v in {tuple(v) for v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[sum(a[i] * a[j] for a in fit) * n - sums[i] * sums[j] for j in range(20)] for i in range(20)], dtype=object)
    values, vectors = np.linalg.eigh((exact / (n * n)).astype(float))
    assert {r.n for r in got} == {400} and len(got) == 701 * 16
    by = collections.defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
    for (i, _), v in zip(rows[:701], x):
        off = [n * a - b for a, b in zip(v, sums)]
        assert {r.deviation for r in by[i].values()} == {sum(o * o for o in off)}
        want = np.array(off, dtype=float) / n @ vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
        mine = np.array([by[i][c].whitened for c in range(1, 17)])
        assert np.abs(np.abs(mine) - np.abs(want)).max() < 1e-8
    assert np.allclose([by[0][c].explained for c in range(1, 17)], values[::-1][:16] / values.sum(), rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_without_variance_and_of_several_lengths(spark):
    rows = [(1, [5.0, 1.0]), (2, [5.0, 2.0]), (3, [5.0, 2.0]), (4, [1.0, 2.0, 3.0]), (5, [1e15, 0.0, 1.0, 2.0]), (6, [-1e15, 0.0, 1.0, 2.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(embedded(spark, rows)).collect()}
    assert abs(got[1, 1].whitened) == pytest.approx(1) and got[1, 2].whitened is None and got[1, 1].explained == 1
    assert got[2, 1].whitened == got[3, 1].whitened and got[1, 1].n == 2 and got[1, 1].deviation == 64 ** 2
    assert [got[4, c].whitened for c in (1, 2, 3)] == [None] * 3 and got[4, 1].deviation == 0 and got[4, 1].identity_error is None
    assert abs(got[5, 1].whitened) == pytest.approx(1) and got[5, 1].deviation is None and got[5, 1].identity_error < 1e-9
