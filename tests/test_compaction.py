from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest

from winnower.contracts import DEAD_LETTER_TABLE
from winnower.sources import tables
from winnower.streaming import compaction, jobs


@pytest.fixture
def lake(spark, tmp_path):
    folders = jobs.TableFolders(str(tmp_path))

    def letters(batch, *rows):
        made = [(k, f"m{k}", "trips", 0, k, datetime(2024, 1, day, 12) if day else None, "{}", None, 0, "PENDING", datetime(2024, 2, 1), datetime(2024, 2, 1)) for k, day in rows]
        frame = tables.with_day(spark.createDataFrame(made, DEAD_LETTER_TABLE.struct()), DEAD_LETTER_TABLE)
        frame.write.partitionBy("day", "status").parquet(f"{folders.letters}/batch={batch}")

    def moves(batch, *rows):
        made = [(f"m{k}", status, datetime(2024, 3, day)) for k, status, day in rows]
        spark.createDataFrame(made, compaction.TRANSITION).write.parquet(f"{folders.transitions}/batch={batch}")

    def compact():
        return compaction.compact(spark, folders.letters, folders.transitions, folders.current)

    def states():
        return {r.message_id: r.status for r in compaction.read(spark, folders.current).collect()}

    return folders, letters, moves, compact, states


def test_before_the_first_letter(spark, lake):
    folders, _, _, compact, _ = lake
    assert compact() is None
    assert jobs.current_letters(spark, folders).collect() == []
    assert jobs.current_letters(spark, folders).columns == DEAD_LETTER_TABLE.names


def test_letters_and_changes_over_several_runs(spark, lake):
    folders, letters, moves, compact, states = lake
    letters("a", (1, 1), (2, 1), (3, 2), (1, 1))
    assert compact() == [date(2024, 1, 1), date(2024, 1, 2)]
    assert states() == {"m1": "PENDING", "m2": "PENDING", "m3": "PENDING"}
    moves("a", (1, "PROCESSED", 5), (1, "FAILED", 4), (4, "FAILED", 6))
    assert compact() == [date(2024, 1, 1)]
    assert states() == {"m1": "PROCESSED", "m2": "PENDING", "m3": "PENDING"}
    # A letter that comes again on another day, one whose change was waiting, and a change older than the last one.
    letters("b", (1, 3), (4, 2), (5, None))
    moves("b", (1, "FAILED", 3), (3, "FAILED", 9))
    assert compact() == [date(1970, 1, 1), date(2024, 1, 1), date(2024, 1, 2)]
    assert states() == {"m1": "PROCESSED", "m2": "PENDING", "m3": "FAILED", "m4": "FAILED", "m5": "PENDING"}
    assert compact() is None
    moves("c", (5, "FAILED", 10))
    assert compact() == [date(1970, 1, 1)]
    assert states()["m5"] == "FAILED"
    assert compaction.clean(spark, folders.current) == [1, 2]
    assert states()["m1"] == "PROCESSED"
    letters("d", (2, 7))
    assert compact() == []
    assert len(states()) == 5


def test_days_without_a_change_are_not_read(spark, lake):
    folders, letters, moves, compact, states = lake
    letters("a", *[(k, 1) for k in range(20)], *[(k, 2) for k in range(20, 40)])
    compact()
    for path in Path(folders.current).glob("version=*/part=rows/filed=2024-01-01/*.parquet"):
        content = path.read_bytes()
        path.write_bytes(content[:4] + b"\xff" * 60 + content[64:])  # pages that cannot be read
        (path.parent / f".{path.name}.crc").unlink()
    with pytest.raises(Exception, match="(?i)parquet|read"):
        states()
    moves("a", (25, "FAILED", 3))
    letters("b", (41, 2))
    assert compact() == [date(2024, 1, 2)]
    manifest = spark.read.parquet(f"{folders.current}/version=00000002/_manifest").collect()
    assert {r.filed.day: r.version for r in manifest} == {1: 1, 2: 2}


def test_of_two_runs_at_a_time_one_changes_nothing(spark, lake, monkeypatch):
    folders, letters, _, compact, states = lake
    letters("a", (1, 1))
    compact()
    monkeypatch.setattr(compaction, "versions", lambda *_: [])  # as a run sees it that began before the other ended
    with pytest.raises(FileExistsError):
        compact()
    monkeypatch.undo()
    assert states() == {"m1": "PENDING"}
