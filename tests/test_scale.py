"""Queries compute their input once, and listing costs the driver no calls per file."""

import datetime as dt

import pytest

from medallion.catalogue import file_q
from medallion.plans import ingest
from medallion.sources import bronze
from medallion.sources import fixtures as fx

SCHEMA = ("match_id bigint, match_date date, status string, is_finished boolean, home_team_id bigint, home_team_name string, "
          "home_team_short string, away_team_id bigint, away_team_name string, away_team_short string, home_score_ft int, "
          "away_score_ft int, winner string, home_result string")


def counted(spark, df):
    """``df`` with an accumulator of the rows computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(count, df.schema), seen


def match_rows(n):
    return [(i, dt.date(2020 + i % 4, 3, 1), "FINISHED", True, 1, "A", "a", 2, "B", "b", 2, 1, "HOME_TEAM", "W") for i in range(1, n + 1)]


@pytest.mark.parametrize("query", ["silver_from_documents", "bronze_ingest_rerun", "ingest_repair", "gate_blocks_write"])
def test_input_is_computed_once(spark, monkeypatch, query):
    m, seen = counted(spark, spark.createDataFrame(match_rows(60), SCHEMA).coalesce(1))
    monkeypatch.setattr(fx, "matches", lambda *_: m)
    got = {r[0]: r for r in getattr(file_q, f"q_{query}")(spark, None).collect()}
    assert seen.value == 60
    if query == "ingest_repair":
        assert got == {y: (y, 15, 15, True) for y in range(2020, 2024)}
    if query == "bronze_ingest_rerun":
        assert got.pop("1900-01-01/1900") == ("1900-01-01/1900", 0, False, None)
        assert set(got.values()) == {(f"{y}-12-31/{y}", 15, True, 15) for y in range(2020, 2024)}
    if query == "gate_blocks_write":
        assert set(got.values()) == {("clean", False, 60), ("odd_status", False, 60), ("repeated", True, 0), ("undated", True, 0)}
    if query == "silver_from_documents":
        assert set(got) == set(range(1, 61))


def test_counted_ingest_computes_records_twice_at_most(spark, tmp_path):
    recs, seen = counted(spark, spark.range(50).coalesce(1))
    log = ingest.bronze_ingest(spark, recs, str(tmp_path / "s"), "2024-01-01", 2024, "x", entity="match").first()
    assert tuple(log) == ("2024-01-01/2024", 50, True) and seen.value == 100


def test_listing_makes_no_driver_call_per_file(spark, tmp_path, monkeypatch):
    client = spark.sparkContext._gateway._gateway_client
    send, calls, used = client.send_command, [0], []

    def counting(*args, **kw):
        calls[0] += 1
        return send(*args, **kw)
    for n in (3, 120):
        root = tmp_path / str(n)
        for i in range(n):
            (root / f"d {i}").mkdir(parents=True)
            (root / f"d {i}" / f"2024-01-01_x_season_{i}.json").write_text("" if i == 1 else "{}")
        monkeypatch.setattr(client, "send_command", counting)
        calls[0] = 0
        files = bronze.list_snapshots(spark, str(root))
        used.append(calls[0])
        monkeypatch.setattr(client, "send_command", send)
        rows = files.select("file_name", "bytes", "season").collect()
        assert sorted((r.season, r.bytes) for r in rows) == [(i, 0 if i == 1 else 2) for i in range(n)]
        assert all(r.file_name == f"2024-01-01_x_season_{r.season}.json" for r in rows)
    assert used[1] - used[0] < 60
