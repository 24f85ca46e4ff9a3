"""Payload files read by many tasks, beside Spark's own reader of whole files."""

import json
import random

import pytest

from cairn.sources.elements import read_elements
from cairn.sources.split import scan_elements


@pytest.fixture
def small_blocks(spark):
    """Blocks of about 2,000 bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


NASTY = ['"type"', 'a "type" b', '\\"type\\"', "}", "{[", '\\', '\\\\"', '"elements":[{', "é日本😀", "", 'type"', "\n\t"]


def element(rnd, i):
    tags = {rnd.choice(["name", "type", "note", "elements"]): rnd.choice(NASTY) for _ in range(rnd.randrange(4))}
    out = {"type": rnd.choice(["way", "node", "relation"]), "id": i, "tags": tags}
    kind = rnd.random()
    if kind < 0.5:
        out["geometry"] = [{"lat": j / 2, "lon": -j / 4} for j in range(rnd.choice([0, 1, 3, 90]))]
    elif kind < 0.6:  # deeper than the usual elements
        out["members"] = [{"type": "way", "geometry": [{"deep": {"er": [{"type": "x"}]}}]}]
    if rnd.random() < 0.3:
        out = dict(reversed(out.items()))
    return out


def payload(rnd, first, many):
    before = {"version": 0.6, "osm3s": {"copyright": "the \"type\" of {data}"}, "other": [{"type": "no", "id": -1, "x": {"type": "y"}}]}
    after = {"remark": "runtime } error [", "more": [{"type": "no", "id": -2}], "deep": {"elements": [{"type": "no", "id": -3}]}}
    return before | {"elements": [element(rnd, first + i) for i in range(many)]} | after


def rows_of(elements):
    return [(r.ord.payload, r.id, r.type, r.tags, r.geometry) for r in elements.orderBy("ord").collect()]


@pytest.mark.parametrize("indent", [None, 2])
def test_blocks_give_the_elements_of_whole_files(spark, tmp_path, small_blocks, indent):
    rnd = random.Random(7)
    for i, many in enumerate([0, 1, 20, 40]):
        text = json.dumps(payload(rnd, i * 1000, many), indent=indent, ensure_ascii=i % 2 == 0)
        (tmp_path / f"p{i}.json").write_text(text)
    (tmp_path / "p8.json").write_text('{"version": 1}')
    (tmp_path / "p9.json").write_text("")
    found = scan_elements(spark, str(tmp_path))
    want = rows_of(read_elements(spark, f"{tmp_path}/p[0-8].json"))
    assert rows_of(found) == want and len(want) == 61
    # Places are byte offsets: there the element's text begins.
    for r in found.orderBy("ord").limit(30).collect():
        data = (tmp_path / r.ord.payload.rsplit("/", 1)[1]).read_bytes()
        assert data[r.ord.pos:r.ord.pos + 1] == b"{" and json.JSONDecoder().raw_decode(data[r.ord.pos:].decode())[0]["id"] == r.id


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    from cairn.sources import split

    rnd = random.Random(8)
    (tmp_path / "one.json").write_text(json.dumps(payload(rnd, 0, 80)))
    records = split._records(spark, str(tmp_path), split.SEPARATOR)
    assert records.rdd.getNumPartitions() > 10
    ends = split._block_ends(records, split.SEPARATOR).collect()
    assert len(ends) > 10 and sum(r.n_bytes for r in ends) == (tmp_path / "one.json").stat().st_size
    assert split.scan_elements(spark, str(tmp_path)).count() == 80


def test_begins_meet_records_by_shuffle_when_there_are_many(spark, tmp_path, small_blocks, monkeypatch):
    from cairn.sources import split

    rnd = random.Random(9)
    (tmp_path / "one.json").write_text(json.dumps(payload(rnd, 0, 40)))
    broadcast = rows_of(split.scan_elements(spark, str(tmp_path)))
    monkeypatch.setattr(split, "BROADCAST_BLOCKS", 0)
    assert rows_of(split.scan_elements(spark, str(tmp_path))) == broadcast


def test_elements_longer_than_a_buffer(spark, tmp_path, small_blocks, monkeypatch):
    long = {"type": "way", "id": 1, "tags": {"type": "x" * 5000}, "geometry": [{"lat": i / 8, "lon": 0.5} for i in range(3_000)]}
    (tmp_path / "one.json").write_text(json.dumps({"elements": [long, {"type": "node", "id": 2}, long | {"id": 3}]}))
    found = scan_elements(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.id, len(r.geometry or [])) for r in found] == [(1, 3_000), (2, 0), (3, 3_000)]


def test_broken_payloads_fail(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"elements": [{"type": "node", "id": 1}')
    with pytest.raises(ValueError, match="no whole payload"):
        scan_elements(spark, str(tmp_path))
    with pytest.raises(ValueError, match="quoted word"):
        scan_elements(spark, str(tmp_path), separator="}")


def test_the_task_that_writes_the_payload_sorts_nothing(spark, small, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from contract.standins import payload_file

    plans, text = [], DataFrameWriter.text

    def noted(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return text(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "text", noted)
    folder = payload_file(spark, small)
    assert len(plans) == 1 and "Sort" not in plans[0]
    ids = [r.id for r in read_elements(spark, folder).orderBy("ord").collect()]
    assert len(ids) > 1 and ids == sorted(ids)
