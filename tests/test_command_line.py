import samples
from citelight.__main__ import arguments, run
from citelight.plans.runs import Warehouse


def test_commands(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), Warehouse(str(tmp_path / "house"))
    samples.land_all(landing)

    def call(command, *more, at="2026-04-14T06:00:00+00:00"):
        return run(spark, arguments(["--run-time", at, command, "--warehouse", house.root, *more]))

    count = lambda table: house.read(spark, table).count()
    assert call("extract", "--landing", landing) == 0
    assert call("extract", "--landing", landing, "--backfill") == 0
    assert count("raw_brand_snapshots") == 6  # the same files count once
    samples.land_all(f"{landing}-2", run="2026-04-14")
    assert call("extract", "--landing", f"{landing}-2", "--backfill") == 0
    assert count("raw_brand_snapshots") == 12
    assert call("refresh") == 0 and count("l2_snapshots") == 6
    assert call("refresh", "--since", "2026-04-14T00:00:00") == 0 and count("l2_snapshots") == 6
    assert call("refresh", "--changed") == 0 and count("l2_snapshots") == 6

    # The daily report load covers a week, a backfill its range.
    assert call("report", "--landing", landing, at="2026-04-15T06:00:00+00:00") == 0
    assert {str(r.snapshot_date) for r in house.read(spark, "l1_report").collect()} == {"2026-04-14"}
    assert call("report", "--landing", landing, "--start", "2026-04-01") == 0
    assert count("l1_report") == 4

    samples.land(landing, "term_report", "{broken", brand_id="b9")
    assert call("extract", "--landing", landing) == 1
    assert call("reset") == 0 and count("l2_snapshots") == count("raw_brands") == 0
