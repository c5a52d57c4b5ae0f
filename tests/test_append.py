"""X1 in order: resumed after death between write and commit, files out of order, units and calendars; S3 on mixed folders."""

import pytest
from pyspark.sql import functions as F

from terraflux.sources import scans
from terraflux.streaming.append import InOrder, append_in_order

SCHEMA = "site string, t double, v double, u string, tu string, cal string"
DAYS = "days since 2000-01-01"


class Run:
    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def arrive(self, name, times, site="a", u="degC", v=0.0, tu=DAYS, cal="standard"):
        rows = self.spark.createDataFrame([(site, float(t), float(v + t), u, tu, cal) for t in times], SCHEMA)
        rows.coalesce(1).write.parquet(f"{self.path}/in/{name}")

    def append(self, job=InOrder, **more):
        return sorted((r.site, r.t, r.v) for r in append_in_order(self.spark, f"{self.path}/in/*", f"{self.path}/out", f"{self.path}/checkpoint", SCHEMA, "site", "t", job=job, **more).collect())


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def test_death_between_write_and_commit(run):
    class Dies(InOrder):
        def written(self, number):
            raise RuntimeError("executors are gone")

    run.arrive("1", [0, 1, 2])
    assert run.append() == [("a", t, t) for t in (0, 1, 2)]
    run.arrive("2", [3, 4])
    with pytest.raises(Exception, match="executors are gone"):
        run.append(Dies)
    assert sorted(r.t for r in InOrder(f"{run.path}/out", "site", "t", {}, None, None).rows(run.spark).collect()) == [0, 1, 2]  # written, but not there yet
    run.arrive("3", [5])
    assert run.append() == [("a", t, t) for t in range(6)]
    assert run.append() == [("a", t, t) for t in range(6)]  # nothing new


def test_files_out_of_order_stop_the_stream(run):
    run.arrive("2", [5, 6])
    run.arrive("1", [0, 4])
    run.arrive("b", [2, 3], site="b")
    assert len(run.append()) == 6  # one batch, put in order; series by series
    run.arrive("late", [6, 7])
    with pytest.raises(Exception, match="not in order: .*late.* begins at 6.0 in series a, which is not after 6.0"):
        run.append()
    with pytest.raises(Exception, match="not in order"):  # and it stays so
        run.append()


def test_overlap_within_a_batch(run):
    run.arrive("1", [0, 9])
    run.arrive("2", [5])
    with pytest.raises(Exception, match="not in order"):
        run.append()


def test_units_and_calendars_of_the_first_file(run):
    more = {"units": {"v": "u"}, "time_units": "tu", "calendar": "cal"}
    run.arrive("1", [0, 1], cal="noleap")
    assert run.append(**more) == [("a", 0, 0), ("a", 1, 1)]
    run.arrive("2", [48, 72], u="K", v=273.15, tu="hours since 2000-01-01", cal="noleap")
    run.arrive("3", [60], tu="days since 2000-01-01", cal="standard")  # 1 March of a leap year: day 59 of a year without
    got = run.append(**more)
    assert [r[:2] for r in got] == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 59)]
    assert [r[2] for r in got] == pytest.approx([0, 1, 48, 72, 60])
    run.arrive("4", [59 + 366], tu="days since 2000-01-01", cal="standard")
    run.arrive("5", [1520], tu="days since 2000-01-01", cal="360_day")  # 21 March 2004
    assert len(run.append(**more)) == 7
    run.arrive("6", [59 + 366 * 4 + 365 * 4 - 4], tu=DAYS, cal="360_day", v=0)
    run.arrive("7", [8 * 365 + 61], tu=DAYS, cal="standard")  # 29 February 2008, which the first file's calendar lacks
    with pytest.raises(Exception, match="has no 2008-02-29"):
        run.append(**more)


def test_no_file_yet(run, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    with pytest.raises(ValueError, match="no file"):
        run.append()


def test_encodings_of_a_mixed_folder(spark, tmp_path):
    """Each file is read in UTF-8 if all of it is valid, else in the fallback."""
    (tmp_path / "mixed").mkdir()
    for name, text, encoding in (("a", "id,name\n1,Forêt\n2,plain\n", "utf-8"), ("b", "id,name\n3,Forêt\n4,Ã©\n5,na\n", "latin-1"), ("c", "id,name\n6,only ascii\n", "ascii"), ("d", "id,name\n", "utf-8")):
        (tmp_path / "mixed" / f"{name}.csv").write_bytes(text.encode(encoding))
    read = lambda **k: sorted(map(tuple, scans.scan_csv(spark, str(tmp_path / "mixed"), "id int, name string", **k).collect()))
    assert read(fallback="ISO-8859-1") == [(1, "Forêt"), (2, "plain"), (3, "Forêt"), (4, "Ã©"), (5, None), (6, "only ascii")]
    assert read()[2][1] != "Forêt"
    one = scans.scan_csv(spark, str(tmp_path / "mixed" / "b.csv"), "id int, name string", fallback="ISO-8859-1")
    assert one.count() == 3 and one.filter(F.col("name") == "Forêt").count() == 1
