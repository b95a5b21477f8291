import pytest

from archives import write_zip
from newsmart.sources import archive_glob, list_archives, read_archive_lines, unreadable_archives


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed")
    for name in ("20190101000000.export.CSV", "20190101000000.translation.export.CSV", "20190101001500.export.CSV"):
        write_zip(folder / f"{name}.zip", "a\tb\nc\td\r\ne\n", "x\n")
    return str(folder)


@pytest.mark.parametrize("period, digit, archives", [
    ("2019", False, 3), ("20190101", True, 3), ("20190101000000", False, 2)])
def test_globs(spark, base, period, digit, archives):
    glob = archive_glob(base, period, "export", digit)
    assert list_archives(spark, glob).count() == archives
    lines = read_archive_lines(spark, glob)
    assert lines.count() == 4 * archives
    assert sorted({r.line for r in lines.collect()}) == ["a\tb", "c\td", "e", "x"]


def test_whole_stamp_with_digit_matches_nothing(spark, base):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_archive_lines(spark, archive_glob(base, "20190101000000", "export", True)).count()


def test_base_path_keeps_its_file_system():
    assert archive_glob("s3a://bucket/data/", "2019", "gkg") == "s3a://bucket/data/2019*.gkg.csv.zip"


def test_listing_reads_no_content(spark, base):
    df = list_archives(spark, archive_glob(base, "2019", "export"))
    assert {(r.kind, r.day) for r in df.collect()} == {("export", "20190101")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_line_ends_and_long_archives(spark, tmp_path):
    many = "".join(f"{i}\t{'é' * 20}\n" for i in range(150_000))  # several batches
    write_zip(tmp_path / "20190101000000.gkg.csv.zip", "1\r2\r\n3\n\n4", "", "five", many)
    lines = [r.line for r in read_archive_lines(spark, archive_glob(str(tmp_path), "2019", "gkg")).collect()]
    assert lines[:6] == ["1", "2", "3", "", "4", "five"]
    assert lines[6:] == many.splitlines()


def test_unreadable_archives(spark, tmp_path):
    write_zip(tmp_path / "20190101000000.export.CSV.zip", "good\n")
    (tmp_path / "20190101001500.export.CSV.zip").write_bytes(b"<html>not found</html>")
    glob = archive_glob(str(tmp_path), "2019", "export")
    assert [r.line for r in read_archive_lines(spark, glob, strict=False).collect()] == ["good"]
    with pytest.raises(Exception, match="not a zip archive"):
        read_archive_lines(spark, glob).count()

    whole = (tmp_path / "20190101000000.export.CSV.zip").read_bytes()
    (tmp_path / "20190101003000.export.CSV.zip").write_bytes(whole[:-30])
    assert [r.line for r in read_archive_lines(spark, glob, strict=False).collect()] == ["good"]
    problems = {r.path.rsplit("/")[-1][8:14]: r.problem for r in unreadable_archives(spark, glob).collect()}
    assert problems["001500"] == "not a zip archive" and problems["003000"].startswith("damaged")
    (tmp_path / "20190101001500.export.CSV.zip").unlink()
    with pytest.raises(Exception, match="damaged archive"):
        read_archive_lines(spark, glob).count()
