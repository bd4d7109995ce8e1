from __future__ import annotations

import hashlib

import pytest

from winnower.sources import landing


def digests(folder) -> dict[str, str]:
    return {str(p.relative_to(folder)): hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.rglob("*") if p.suffix in (".csv", ".parquet") and p.is_file()}


def stored(spark, target) -> dict[str, str]:
    return {r.path: r.stored_sha256 for r in landing.landed_bytes(spark, str(target)).collect()}


def test_landing_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert landing.land_raw(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect() == []
    assert landing.landings(spark, f"{tmp_path}/out") == []
    assert stored(spark, tmp_path / "out") == {}


def test_landing_keeps_every_byte(spark, tmp_path):
    source = tmp_path / "in"
    contents = {
        "x/a.csv": 'a,source_file\n1,"two, ""quoted"""\n'.encode(),
        "y/a.csv": "a,b\r\n1,\"line\nbreak\"\r\n".encode(),
        "latin.csv": "né,b\n1,é".encode("latin-1"),
        "odd.csv": b"\xff\xfe\x00a,b\n\x00\x01",
        "one.csv": b"\xe9",
        "no end.csv": "a\n1".encode(),
        "été/b,c=d%2F.csv": "a\n1\n\n".encode(),
    }
    for name, content in contents.items():
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        (source / name).write_bytes(content)
    (source / "note.txt").write_text("not landed")
    (source / "empty.txt").write_bytes(b"")
    spark.range(10).coalesce(2).write.parquet(f"{source}/rows")
    manifest = landing.land_raw(spark, str(source), f"{tmp_path}/out").collect()
    want = digests(source)
    assert {r.path: r.sha256 for r in manifest} == stored(spark, tmp_path / "out") == want
    assert len(want) == len(contents) + 2
    assert all(r.stored_size == r.size for r in landing.landed_bytes(spark, f"{tmp_path}/out").collect())
    assert landing.read_landed_parquet(spark, f"{tmp_path}/out").count() == 10


def test_a_second_landing_adds_and_replaces(spark, tmp_path):
    source, out = tmp_path / "in", f"{tmp_path}/out"
    source.mkdir()
    (source / "a.csv").write_text("id\n1\n")
    (source / "b.csv").write_text("id\n2\n")
    landing.land_raw(spark, str(source), out)
    assert len(landing.land_raw(spark, str(source), out).collect()) == 2
    assert landing.landings(spark, out) == [1]
    (source / "a.csv").write_text("other,id\nx,10\n")
    (source / "c.csv").write_text("id\n3\n")
    (source / "b.csv").unlink()
    manifest = {r.path: r.landing for r in landing.land_raw(spark, str(source), out).collect()}
    assert manifest == {"a.csv": 2, "b.csv": 1, "c.csv": 2}
    got = landing.read_landed_csv(spark, out, ["id", "other"]).collect()
    assert sorted(map(tuple, got)) == [("10", "x"), ("2", None), ("3", None)]
    assert landing.clean_landings(spark, out) == []
    (source / "b.csv").write_text("id\n20\n")
    landing.land_raw(spark, str(source), out)
    assert landing.clean_landings(spark, out) == [1]
    assert landing.landings(spark, out) == [2, 3]
    assert sorted(r.id for r in landing.read_landed_csv(spark, out, ["id"]).collect()) == ["10", "20", "3"]


def test_of_two_landings_at_a_time_one_fails(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id\n1\n")
    landing.land_raw(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    (tmp_path / "in" / "a.csv").write_text("id\n11\n")
    monkeypatch.setattr(landing, "landings", lambda *_: [])  # as one sees it that began before the first ended
    monkeypatch.setattr(landing, "landed", lambda s, t: s.createDataFrame([], landing.MANIFEST))
    with pytest.raises(FileExistsError):
        landing.land_raw(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    monkeypatch.undo()
    assert [r.sha256 for r in landing.landed(spark, f"{tmp_path}/out").collect()] == [hashlib.sha256(b"id\n1\n").hexdigest()]


def test_reading_goes_by_each_files_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text('id,code\n1,007\n2,"a\nb"\n')
    (tmp_path / "in" / "y.csv").write_text("code,id\n008,3\n")
    (tmp_path / "in" / "z.csv").write_text('id,"odd, name"\n4,x\n')
    (tmp_path / "in" / "w.csv").write_text("﻿id,code\r\n5,\"a \"\"b\"\"\"\r\n", encoding="utf-8", newline="")
    spark.sql("SELECT 1 AS p").coalesce(1).write.parquet(f"{tmp_path}/in/one")
    spark.sql("SELECT 2 AS p, 'q' AS q, 3.5D AS r").coalesce(1).write.parquet(f"{tmp_path}/in/two")
    landing.land_raw(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = landing.read_landed_csv(spark, f"{tmp_path}/out", ["id", "code", "odd, name", "absent"]).collect()
    assert sorted(map(tuple, got)) == [
        ("1", "007", None, None), ("2", "a\nb", None, None), ("3", "008", None, None), ("4", None, "x", None),
        ("5", 'a "b"', None, None),
    ]
    rows = landing.read_landed_parquet(spark, f"{tmp_path}/out").select("p", "q", "r").collect()
    assert sorted(map(tuple, rows)) == [(1, None, None), (2, "q", 3.5)]


def test_latin_files_are_read_in_their_encoding(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_bytes("né\né\n".encode("latin-1"))
    landing.land_raw(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert [r[0] for r in landing.read_landed_csv(spark, f"{tmp_path}/out", ["né"], "ISO-8859-1").collect()] == ["é"]
