from pathlib import Path

import pytest

from archives import write_zip
from newsmart import commits, plans
from newsmart.__main__ import main
from newsmart.operators import parse_events
from newsmart.plans.jobs import archive_records, lake_records, store_marts
from newsmart.plans.landing import lake_ledger, land_period, read_lake, read_rejects, vacuum_lake
from newsmart.schemas import EVENT_FIELDS, MARTS
from newsmart.sinks import write_period
from newsmart.sources import archive_glob, list_archives, read_archive_lines, read_manifest, read_mart, \
    select_period, union_manifests

FEED = "http://feed.example/v2/"


def _event_line(event_id, day, country="FR"):
    values = {name: "" for name, _ in EVENT_FIELDS} | {
        "GLOBALEVENTID": str(event_id), "SQLDATE": day, "Year": day[:4], "ActionGeo_CountryCode": country,
        "SOURCEURL": "u"}
    return "\t".join(values.values()) + "\n"


def _mention_line(event_id, confidence, info):
    return "\t".join([str(event_id), "1", "2", "1", "s", "u", "1", "", "", "", "1", str(confidence), "9", "1.5", info]) \
        + "\n"


def test_manifest(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text(
        f"101 aaaa {FEED}20190101000000.export.CSV.zip\n"
        f"102 bbbb {FEED}20190101000000.mentions.CSV.zip\n"
        f"103 cccc {FEED}20190201000000.gkg.csv.zip\n")
    manifest = read_manifest(spark, str(path))
    assert select_period(manifest, "201901").count() == 2
    assert select_period(manifest, "2019").count() == 3
    first = select_period(manifest, "2019").where("size = '101'").collect()[0]
    assert first.name == "20190101000000.export.CSV.zip"
    assert union_manifests(manifest, manifest).count() == 6


def test_reconcile_with_real_files(spark, tmp_path):
    for stamp in ("20190101000000", "20190101001500"):
        write_zip(tmp_path / f"{stamp}.export.CSV.zip", "x\n")
    size = (tmp_path / "20190101000000.export.CSV.zip").stat().st_size
    (tmp_path / "list.txt").write_text("".join(
        f"{n} m {FEED}{stamp}.export.CSV.zip\n"
        for stamp, n in (("20190101000000", size), ("20190101001500", size + 1), ("20190101003000", size))))
    wanted = select_period(read_manifest(spark, str(tmp_path / "list.txt")), "2019")
    arrived = list_archives(spark, archive_glob(str(tmp_path), "2019", "export"))
    status = {r.name[8:14]: r.status for r in plans.reconcile(wanted, arrived).collect()}
    assert status == {"000000": "ready", "001500": "corrupt", "003000": "missing"}


def test_landing_is_repeatable(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    for i, day in enumerate(("20190101", "20190102")):
        write_zip(base / f"{day}000000.export.CSV.zip", *(_event_line(10 * i + n, day) for n in range(3)), "bad\n")
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190101", "20190102"]
    assert land_period(spark, str(base), lake, "export", "2019").days == []
    assert read_lake(spark, lake, "export").count() == 6

    write_zip(base / "20190102001500.export.CSV.zip", _event_line(99, "20190102"))
    before = set(read_lake(spark, lake, "export", "20190101").inputFiles())
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190102"]
    assert set(read_lake(spark, lake, "export", "20190101").inputFiles()) == before
    assert read_lake(spark, lake, "export").count() == 7

    # a run lost after the data and before the ledger is made good by running again
    write_zip(base / "20190103000000.export.CSV.zip", _event_line(100, "20190103"))
    land_period(spark, str(base), lake, "export", "20190103")
    for part in Path(lake, "export", "_commits").glob("*0000000003*"):  # the file and its checksum
        part.unlink()
    assert read_lake(spark, lake, "export").count() == 7
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190103"]
    assert read_lake(spark, lake, "export").count() == 8

    from_lines = parse_events(read_archive_lines(spark, archive_glob(str(base), "2019", "export")))
    from_lake = read_lake(spark, lake, "export").select(*from_lines.columns)
    assert from_lake.exceptAll(from_lines).count() == from_lines.exceptAll(from_lake).count() == 0

    # a late archive after the landed ones were moved away adds its rows and takes none
    for path in base.glob("20190102*"):
        path.unlink()
    write_zip(base / "20190102003000.export.CSV.zip", _event_line(101, "20190102"))
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190102"]
    assert read_lake(spark, lake, "export", "20190102").count() == 5
    # an archive that comes again with another size replaces its own rows
    write_zip(base / "20190102003000.export.CSV.zip", _event_line(101, "20190102"), _event_line(102, "20190102"))
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190102"]
    assert read_lake(spark, lake, "export", "20190102").count() == 6
    assert land_period(spark, str(base), lake, "export", "2019").days == []


def test_unreadable_archives_are_reported_and_tried_again(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"))
    (base / "20190101001500.export.CSV.zip").write_bytes(b"<html>")
    write_zip(base / "20190101003000.export.CSV.zip", *(_event_line(n, "20190101") for n in range(500)))
    whole = (base / "20190101003000.export.CSV.zip").read_bytes()
    (base / "20190101003000.export.CSV.zip").write_bytes(whole[:-40])
    landed = land_period(spark, str(base), lake, "export", "2019")
    assert landed.days == ["20190101"] and [name[8:14] for name, _ in landed.rejected] == ["001500", "003000"]
    assert read_lake(spark, lake, "export").count() == 1
    (base / "20190101003000.export.CSV.zip").write_bytes(whole)
    landed = land_period(spark, str(base), lake, "export", "2019")
    assert landed.days == ["20190101"] and len(landed.rejected) == 1
    assert read_lake(spark, lake, "export").count() == 501
    assert not list(Path(lake, "export", "_staging").iterdir())


def test_an_archive_without_records_left_takes_its_rows_along(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"), _event_line(2, "20190101"))
    write_zip(base / "20190102000000.export.CSV.zip", _event_line(3, "20190102"))
    land_period(spark, str(base), lake, "export", "2019")
    write_zip(base / "20190101000000.export.CSV.zip", "no record\n", "nor this one\there\n", "\n")
    landed = land_period(spark, str(base), lake, "export", "2019")
    assert (landed.days, landed.lines, landed.records, landed.rejected_lines) == (["20190101"], 3, 0, 3)
    assert [r.GLOBALEVENTID for r in read_lake(spark, lake, "export").collect()] == [3]
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        read_lake(spark, lake, "export", "20190101")
    assert land_period(spark, str(base), lake, "export", "2019").days == []


def test_lines_in_are_records_and_rejects(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"), "short\tline\n",
              _event_line(2, "20190101").strip() + "\tone too many\n")
    write_zip(base / "20190101001500.export.CSV.zip", "alone\n")
    write_zip(base / "20190102000000.export.CSV.zip", _event_line(3, "20190102"))
    (base / "20190102001500.export.CSV.zip").write_bytes(b"no zip")
    landed = land_period(spark, str(base), lake, "export", "2019")
    assert (landed.lines, landed.records, landed.rejected_lines) == (5, 2, 3)
    ledger = {r["name"][:14]: r for r in lake_ledger(spark, lake, "export").collect()}
    assert {stamp: (r.lines, r.records, r.rejected, r.problem is None) for stamp, r in ledger.items()} == {
        "20190101000000": (3, 1, 2, True), "20190101001500": (1, 0, 1, True), "20190102000000": (1, 1, 0, True),
        "20190102001500": (0, 0, 0, False)}
    rejects = {(r.archive[:14], r.n_fields, r.reason, r.line[:11]) for r in read_rejects(spark, lake, "export").collect()}
    assert rejects == {("20190101000000", 2, "too few fields: 2 for 61", "short\tline"),
                       ("20190101000000", 62, "too many fields: 62 for 61", "2\t20190101\t"),
                       ("20190101001500", 1, "too few fields: 1 for 61", "alone")}
    assert read_rejects(spark, lake, "export", "20190102").count() == 0
    assert read_rejects(spark, lake, "export", "20190101001500").count() == 1
    # another archive of the day comes: its rejects join those that are there
    write_zip(base / "20190101003000.export.CSV.zip", "late\n", _event_line(4, "20190101"))
    land_period(spark, str(base), lake, "export", "2019")
    assert read_rejects(spark, lake, "export").count() == 4 and read_lake(spark, lake, "export").count() == 3


@pytest.mark.parametrize("step", ["commit_state", "move"])
def test_a_run_lost_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch, step):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"))
    land_period(spark, str(base), lake, "export", "2019")
    write_zip(base / "20190101001500.export.CSV.zip", _event_line(2, "20190101"))
    write_zip(base / "20190102000000.export.CSV.zip", _event_line(3, "20190102"))

    def lost(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(commits, step, lost)
        with pytest.raises(OSError):
            land_period(spark, str(base), lake, "export", "2019")
    assert [r.GLOBALEVENTID for r in read_lake(spark, lake, "export").collect()] == [1]
    assert lake_ledger(spark, lake, "export").count() == 1
    assert land_period(spark, str(base), lake, "export", "2019").days == ["20190101", "20190102"]
    assert sorted(r.GLOBALEVENTID for r in read_lake(spark, lake, "export").collect()) == [1, 2, 3]
    assert len(vacuum_lake(spark, lake, "export")) == 1  # what the lost run wrote
    assert read_lake(spark, lake, "export").count() == 3


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    for day in ("20190101", "20190102"):
        write_zip(base / f"{day}000000.export.CSV.zip", _event_line(1, day))
    land_period(spark, str(base), lake, "export", "2019")
    reader = read_lake(spark, lake, "export")
    for day in ("20190101", "20190102"):
        write_zip(base / f"{day}000000.export.CSV.zip", _event_line(1, day), _event_line(2, day))
    land_period(spark, str(base), lake, "export", "2019")
    assert reader.count() == 2 and read_lake(spark, lake, "export").count() == 4
    write_zip(base / "20190103000000.export.CSV.zip", _event_line(1, "20190103"))
    land_period(spark, str(base), lake, "export", "2019")
    assert len(vacuum_lake(spark, lake, "export")) == 1 and read_lake(spark, lake, "export").count() == 5


def test_of_two_runs_at_once_one_commits(spark, tmp_path, monkeypatch):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"))
    true = commits.commit_state

    def late(*told):
        with monkeypatch.context() as patch:
            patch.setattr(commits, "commit_state", true)
            land_period(spark, str(base), lake, "export", "2019")
        return true(*told)

    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit_state", late)
        with pytest.raises(RuntimeError, match="another run"):
            land_period(spark, str(base), lake, "export", "2019")
    assert read_lake(spark, lake, "export").count() == 1


def test_a_damaged_copy_leaves_what_its_name_brought(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    path = base / "20190101000000.export.CSV.zip"
    write_zip(path, _event_line(1, "20190101"))
    land_period(spark, str(base), lake, "export", "2019")
    path.write_bytes(b"<html>")
    assert land_period(spark, str(base), lake, "export", "2019").rejected == [(path.name, "not a zip archive")]
    assert read_lake(spark, lake, "export").count() == 1
    write_zip(path, _event_line(5, "20190101"), _event_line(6, "20190101"))
    land_period(spark, str(base), lake, "export", "2019")
    assert sorted(r.GLOBALEVENTID for r in read_lake(spark, lake, "export").collect()) == [5, 6]


def test_only_ready_archives_of_a_manifest_are_landed(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    sizes = []
    for minute in ("0000", "1500", "3000"):
        path = base / f"2019010100{minute}.export.CSV.zip"
        write_zip(path, _event_line(int(minute), "20190101"))
        sizes.append(path.stat().st_size)
    (tmp_path / "list.txt").write_text(
        f"{sizes[0]} m {FEED}20190101000000.export.CSV.zip\n{sizes[1] + 1} m {FEED}20190101001500.export.CSV.zip\n")
    manifest = select_period(read_manifest(spark, str(tmp_path / "list.txt")), "2019")
    assert land_period(spark, str(base), lake, "export", "2019", manifest).days == ["20190101"]
    assert [r.GLOBALEVENTID for r in read_lake(spark, lake, "export").collect()] == [0]


@pytest.mark.parametrize("period, rows", [("2019", 4), ("201901", 3), ("20190101", 2), ("2019010100", 1),
                                          ("20190101013000", 1)])
def test_periods_of_any_length(spark, tmp_path, period, rows):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    for stamp in ("20190101000000", "20190101013000", "20190102000000", "20190201000000"):
        write_zip(base / f"{stamp}.export.CSV.zip", _event_line(stamp[4:10], stamp[:8]))
    land_period(spark, str(base), lake, "export", "2019")
    from_lake = read_lake(spark, lake, "export", period).select("GLOBALEVENTID")
    from_zips = archive_records(spark, str(base), period)("export").select("GLOBALEVENTID")
    assert sorted(from_lake.collect()) == sorted(from_zips.collect()) and from_lake.count() == rows
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lake(spark, lake, "export", "2020")


def test_periods_are_stored_side_by_side(spark, tmp_path):
    def mart(*days):
        return spark.createDataFrame([(day, "FR", "", 1) for day in days],
                                     "sqldate string, country string, language string, count long")

    target = str(tmp_path / "querya")
    for _ in "12":
        write_period(mart("20190101"), "querya", target, "201901")
    write_period(mart("20190201", "20190202"), "querya", target, "201902")
    assert sorted(r.sqldate for r in read_mart(spark, target, "querya").collect()) == [20190101, 20190201, 20190202]
    with pytest.raises(ValueError, match="no rows"):
        write_period(mart("20190101").limit(0), "querya", target, "201901")
    with pytest.raises(ValueError, match="overlaps"):
        write_period(mart("20190101"), "querya", target, "2019")
    assert read_mart(spark, target, "querya").count() == 3
    write_period(mart("20190101").limit(0), "querya", target, "201901", allow_empty=True)
    assert read_mart(spark, target, "querya").count() == 2
    assert not list(Path(target).glob("_staging*"))


def test_lake_scan_is_pruned(spark, tmp_path):
    base, lake = tmp_path / "in", str(tmp_path / "lake")
    base.mkdir()
    for day in ("20190101", "20190201"):
        write_zip(base / f"{day}000000.export.CSV.zip", _event_line(1, day))
    land_period(spark, str(base), lake, "export", "2019")
    january = read_lake(spark, lake, "export", "201901").where("ActionGeo_CountryCode = 'FR'").select("SQLDATE")
    plan = january._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [IsNotNull(ActionGeo_CountryCode), EqualTo(ActionGeo_CountryCode,FR)]" in scan
    assert "ReadSchema: struct<SQLDATE:string,ActionGeo_CountryCode:string>" in scan
    assert "day=20190101" in scan and "day=20190201" not in scan
    assert [r.SQLDATE for r in january.collect()] == ["20190101"]


def test_archives_to_stored_marts(spark, tmp_path):
    base = tmp_path / "in"
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", *(_event_line(i, "20190101") for i in (1, 2, 3)))
    write_zip(base / "20190101000000.mentions.CSV.zip", _mention_line(1, 20, "srclc:deu;e:x"),
              _mention_line(1, 90, "srclc:fra;e:x"), _mention_line(2, 10, ""))
    article = ["id", "20190101000000", "1", "src", "u"] + [""] * 20
    article[7], article[10], article[11], article[15], article[24] = \
        "A;B;", "1#France#FR#x;1#Chad#CD#x", "p", "2.5,1", "z"
    write_zip(base / "20190101000000.gkg.csv.zip", "\t".join(article))
    lake = str(tmp_path / "lake")
    for kind in ("export", "mentions", "gkg"):
        assert land_period(spark, str(base), lake, kind, "2019").days == ["20190101"]

    expected = {
        "querya": {(20190101, "FR", "fra", 1), (20190101, "FR", "", 1), (20190101, "FR", None, 1)},
        "queryb2": {("FR", 2, "20190101", 2019, 1, 1, 1), ("FR", 1, "20190101", 2019, 1, 1, 2),
                    ("FR", 1, "20190101", 2019, 1, 1, 3)},
        "queryctheme": {(20190101, "2019", "0101", "01", "src", theme, 1, 2.5) for theme in ("A", "B", "")},
        "querycperson": {(20190101, "2019", "0101", "01", "src", "p", 1, 2.5)},
        "queryccountry": {(20190101, "2019", "0101", "01", "src", c, 1, 2.5) for c in ("France", "Chad")},
        "queryd2": {(1, 1, 2019, 1, 2.5, "Chad", "France")},
        "queryb2rollup": {("FR", 2019, 1, 1, "day", 3, 4), ("FR", 2019, 1, None, "month", 3, 4),
                          ("FR", 2019, None, None, "year", 3, 4)},
        "queryd2monthly": {("Chad", "France", 1, 2.5, 1)},
    }
    for label, records in (("lake", lake_records(spark, lake, "2019")),
                           ("zips", archive_records(spark, str(base), "2019"))):
        target = str(tmp_path / f"marts-{label}")
        store_marts(records, list(MARTS), target)
        for name, rows in expected.items():
            assert {tuple(r) for r in read_mart(spark, f"{target}/{name}", name).collect()} == rows, name


def test_command_line(spark, tmp_path, capsys):
    base, lake, out = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "out")
    base.mkdir()
    write_zip(base / "20190101000000.export.CSV.zip", _event_line(1, "20190101"), _event_line(2, "20190101", "US"))
    write_zip(base / "20190101000000.mentions.CSV.zip", _mention_line(1, 20, "srclc:deu;e:x"))
    main(["land", "--base", str(base), "--lake", lake, "--period", "2019", "--kind", "export", "mentions"])
    assert capsys.readouterr().out.splitlines() == ["export: 1 days written", "mentions: 1 days written"]

    want = {(20190101, "FR", "deu", 1), (20190101, "US", None, 1)}
    main(["mart", "--lake", lake, "--period", "201901", "--out", out, "querya"])
    assert {tuple(r) for r in read_mart(spark, f"{out}/querya", "querya").collect()} == want
    main(["mart", "--base", str(base), "--period", "201901", "--out", f"{out}-csv", "--format", "csv", "querya"])
    assert {tuple(r) for r in read_mart(spark, f"{out}-csv/querya", "querya", "csv").collect()} == want
    # a format that takes options and no path
    main(["mart", "--lake", lake, "--period", "201901", "--format", "noop", "--option", "table={mart}", "querya"])
    with pytest.raises(SystemExit):
        main(["mart", "--period", "2019", "--out", out])
