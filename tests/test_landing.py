"""Landed files: bad lines set aside, every file once, killed loads taken back."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.sources import landing, tables

TS = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
GOOD = json.dumps({"data": [{"ID": 1}, {"ID": 2}], "error": False})


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines), encoding="utf-8")


def line(raw, **more):
    return json.dumps({"RAW_DATA": raw} | more, ensure_ascii=False)


def test_problems(spark, tmp_path):
    land(tmp_path / "in", "a.json", [
        line(GOOD, SYNC_TIME="2026-02-01T00:00:00Z"), line('{"data":[]}'), line(GOOD[:-9]), line("{}"), line("[1]"), line("text"),
        line(""), line(None), '{"RAW_DATA": "x', "{}", line('{"data":null}'), line('{"data":[1,"é",{"a":[2]}]}'),
    ])
    assert landing.load_new(spark, str(tmp_path / "in"), "approvals", str(tmp_path / "out"), TS) == 1
    kept = landing.read_raw(spark, str(tmp_path / "out"), "approvals")
    assert {(r[0], r[1]) for r in kept.select("RAW_DATA", F.col("SYNC_TIME") == F.lit(TS)).collect()} == {
        ('{"data":[1,"é",{"a":[2]}]}', True), (GOOD, False), ('{"data":[]}', True),
    }
    bad = landing.read_quarantine(spark, str(tmp_path / "out"), "approvals")
    found = sorted((r.problem, r.text) for r in bad.select("problem", F.coalesce("text", F.lit("-")).alias("text")).collect())
    assert found == [
        (landing.BAD_ENVELOPE, "[1]"), (landing.BAD_ENVELOPE, "text"), (landing.BAD_ENVELOPE, GOOD[:-9]),
        (landing.NO_ARRAY, '{"data":null}'), (landing.NO_ARRAY, "{}"),
        (landing.BAD_LINE, '{"RAW_DATA": "x'), (landing.NO_TEXT, ""), (landing.NO_TEXT, "-"), (landing.NO_TEXT, "-"),
    ]
    assert {r.file.rpartition("/")[2] for r in bad.collect()} == {"a.json"}
    entry = landing.ledger(spark, str(tmp_path / "out"), "approvals").collect()
    assert [(e.rows, e.bad_rows) for e in entry] == [(3, 9)]


def test_every_file_once(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    load = lambda: landing.load_new(spark, str(source), "approvals", root, TS)
    land(source, "a.json", [line(GOOD)])
    land(source, "empty.json", [])
    assert load() == 1 and load() == 0  # a file without a byte is not listed
    land(source, "b.json", [line(GOOD), line(GOOD)])
    assert load() == 1 and load() == 0
    assert landing.read_raw(spark, root, "approvals").count() == 3
    assert sorted(r.rows for r in landing.ledger(spark, root, "approvals").collect()) == [1, 2]


def test_a_killed_load_is_taken_back(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "in", str(tmp_path / "out")
    land(source, "a.json", [line(GOOD)])
    landing.load_new(spark, str(source), "approvals", root, TS)
    land(source, "b.json", [line(GOOD), line("cut {")])

    def killed(*_):
        raise RuntimeError("killed")

    # Dies after its rows were written, before the ledger has them.
    monkeypatch.setattr(type(spark), "createDataFrame", killed)
    with pytest.raises(RuntimeError):
        landing.load_new(spark, str(source), "approvals", root, TS)
    monkeypatch.undo()
    land(source, "c.json", [line(GOOD)])
    assert landing.load_new(spark, str(source), "approvals", root, TS) == 2
    kept = landing.read_raw(spark, root, "approvals")
    assert rows(kept.groupBy("file").count().select("count")) == [(1,), (1,), (1,)]
    assert landing.read_quarantine(spark, root, "approvals").count() == 1


def test_documents_and_nothing_landed(spark, tmp_path):
    root = str(tmp_path / "out")
    assert landing.read_raw(spark, root, "details").count() == 0
    land(tmp_path / "in", "d.json", [line('{"a":1}', APPROVAL_ID=5), line('{"a":', APPROVAL_ID=6)])
    landing.load_new(spark, str(tmp_path / "in"), "details", root, TS, envelopes=False)
    assert rows(landing.read_raw(spark, root, "details"), "APPROVAL_ID", "RAW_DATA") == [(5, '{"a":1}')]
    assert rows(landing.read_quarantine(spark, root, "details"), "problem") == [(landing.BAD_ENVELOPE,)]
    assert not tables.exists(spark, f"{root}/RAW/approvals")
