"""Archives: files on disk by path and date, quarantined rows, reloads, and the events of corporate actions."""

import gzip
import io
import tarfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources import archives

HEAD = ",".join(archives.HEADER)
FIRST = [HEAD, "ABC,100,1.5,2.5,3,1,1062388800000000000,7", 'DEF,"200.0",2,3,4,1,0,', "AAp,1,1,1,1,1,0,1", "ABC,1,2,3", "", "ZERO,5,0,1,1,1,0,1", "NAN,5,nan,1,1,1,0,1", "NEW,5,1,1,1,1,0,1", "TWO,5,1,1,1,1,0,1", "LATE,5,1,1,1,1,0,1"]
SECOND = [HEAD, "ABC,50,1,1,1,1,0,2", "DEF,9,1,1,1,1,0,3"]
TENURES = [(1, "abc", date(2000, 1, 1), None), (2, "DEF", date(2000, 1, 1), date(2003, 9, 11)), (3, "zero", date(2000, 1, 1), None), (3, "nan", date(2000, 1, 1), None), (4, "two", date(2000, 1, 1), None), (5, "two", date(2003, 1, 1), None), (6, "late", date(2010, 1, 1), None)]


def day_file(lines):
    return gzip.compress(("\n".join(lines) + "\n").encode())


@pytest.fixture(scope="module")
def tenures(spark):
    return spark.createDataFrame(TENURES, "security_id bigint, symbol string, start date, end date")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("days")
    (root / "2003" / "09").mkdir(parents=True)
    (root / "2004").mkdir()
    (root / "2003/09/2003-09-10.csv.gz").write_bytes(day_file(FIRST))
    (root / "2003/09/2003-09-11.csv.gz").write_bytes(day_file(SECOND))
    (root / "2003/09/notes.csv.gz").write_bytes(day_file(["x"]))
    (root / "2004/2004-01-02.csv.gz").write_bytes(day_file(["ticker,open", "ABC,1"]))
    return root


@pytest.fixture(scope="module", params=["w", "w:gz"])
def packed(request, folder, tmp_path_factory):
    path = tmp_path_factory.mktemp("packed") / "days_2003.tgz"
    with tarfile.open(path, request.param) as tar:
        for name in ("2003/09/2003-09-10.csv.gz", "2003/09/2003-09-11.csv.gz", "2003/09/notes.csv.gz"):
            tar.add(folder / name, arcname=name)
        shadow = tarfile.TarInfo("2003/09/._2003-09-10.csv.gz")
        shadow.size = 3
        tar.addfile(shadow, io.BytesIO(b"mac"))
        plain = "\n".join([HEAD, "ABC,1,1,1,1,1,0,1"]).encode()
        bare = tarfile.TarInfo("2003/09/2003-09-12.csv.gz")
        bare.size = len(plain)
        tar.addfile(bare, io.BytesIO(plain))
    return str(path)


def test_files_are_read_by_path_and_date(spark, folder):
    days = lambda y: sorted(r.day for r in archives.day_files(spark, str(folder), y).select("day").collect())
    assert days(None) == [date(2003, 9, 10), date(2003, 9, 11), date(2004, 1, 2)]
    assert days((2004, 2004)) == [date(2004, 1, 2)] and days((1990, 1991)) == []


def test_packed_files_are_the_same_rows(spark, folder, packed):
    a = archives.day_rows(archives.day_files(spark, str(folder), (2003, 2003))).drop("archive", "member")
    b = archives.day_rows(archives.packed_day_files(spark, packed)).drop("archive", "member")
    extra = b.where("day = date'2003-09-12'").collect()
    assert [(r.ticker, r.reason) for r in extra] == [("ABC", None)]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.where("day < date'2003-09-12'").collect()))


def test_every_row_has_its_reason(spark, folder, tenures):
    rows = archives.day_bars(archives.day_files(spark, str(folder)), tenures).collect()
    of = {(r.day.isoformat(), r.n): (r.security_id, r.reason) for r in rows}
    assert len(of) == len(rows) and of == {
        ("2003-09-10", 1): (1, None), ("2003-09-10", 2): (2, None), ("2003-09-10", 3): (None, "class"), ("2003-09-10", 4): (None, "width"), ("2003-09-10", 6): (None, "price"),
        ("2003-09-10", 7): (None, "number"), ("2003-09-10", 8): (None, "symbol"), ("2003-09-10", 9): (None, "ambiguous"), ("2003-09-10", 10): (None, "tenure"),
        ("2003-09-11", 1): (1, None), ("2003-09-11", 2): (None, "tenure"), ("2004-01-02", 0): (None, "header"),
    }
    first = next(r for r in rows if r.day == date(2003, 9, 10) and r.n == 1)
    assert (first.open, first.high, first.low, first.close, first.volume, first.trade_count) == (Decimal("1.5"), 3, 1, Decimal("2.5"), 100, 7)
    assert next(r for r in rows if r.n == 2 and r.day == date(2003, 9, 10)).trade_count is None


def test_another_header_can_stop_the_job(spark, folder, tenures):
    with pytest.raises(PySparkException, match="unexpected header"):
        archives.day_rows(archives.day_files(spark, str(folder)), strict=True).collect()
    files = archives.day_files(spark, str(folder))
    rows = archives.day_bars(files, tenures, cutoff="2003-09-11").collect()
    assert {r.reason for r in rows if r.day >= date(2003, 9, 11)} == {"cutoff"}
    assert archives.day_bars(files, tenures, cutoff="2004-01-01", strict=True).count() == 11


def test_rows_of_the_later_source_stay_away(spark, folder, tenures):
    known = spark.createDataFrame([(1, date(2003, 9, 11)), (2, date(2003, 9, 1))], "security_id bigint, first date")
    got = lambda era: sorted((r.security_id, r.day.day) for r in archives.day_bars(archives.day_files(spark, str(folder)), tenures, known, era_start=era).where("reason = 'era'").collect())
    assert got("2003-01-01") == [(1, 11), (2, 10)] and got("2003-09-11") == [(1, 11)] and got("2024-01-01") == []


PRICES = "security_id bigint, date date, open decimal(18,6), high decimal(18,6), low decimal(18,6), close decimal(18,6), volume bigint, trade_count bigint, vwap double"


def test_reload_replaces_bars_and_drops_ghosts(spark, folder, tenures):
    d = Decimal(9)
    old = [
        (1, date(2003, 9, 10), d, d, d, d, 1, None, 8.5),  # bars replaced, vwap stays
        (2, date(2003, 9, 11), d, d, d, d, 1, None, None),  # a ghost: inside the dates, not in the load
        (2, date(2003, 9, 10), d, d, d, d, 1, None, None),  # in the load, without a number of trades there
        (1, date(2003, 9, 12), d, d, d, d, 1, None, None),  # after the load
        (7, date(2003, 9, 10), d, d, d, d, 1, None, None),  # not a security of the load
    ]
    prices = spark.createDataFrame(old, PRICES)
    load = archives.loaded(archives.day_bars(archives.day_files(spark, str(folder)), tenures))
    after = archives.reloaded(prices, load)
    got = {(r.security_id, r.date.day): (r.close, r.trade_count, r.vwap) for r in after.collect()}
    assert got == {(1, 10): (Decimal("2.5"), 7, 8.5), (1, 11): (1, 2, None), (2, 10): (3, None, None), (1, 12): (9, None, None), (7, 10): (9, None, None)}
    assert sorted(map(str, archives.reloaded(after, load).collect())) == sorted(map(str, after.collect()))
    assert archives.reloaded(prices, load, purge=False).count() == 6
    assert archives.reloaded(prices, load.where("false")).count() == 5 and archives.reloaded(prices.where("false"), load).count() == 3


def test_prices_by_volume_fill_what_fits(spark, tmp_path, tenures):
    main = [("ABC", "2003-09-10", 2.0, 2.5, 2003, 9), ("ABC", "2003-09-11", float("nan"), 1.0, 2003, 9), ("aB", "2003-09-11", 2.0, 1.0, 2003, 9), ("ABC", "2024-01-01", 2.0, 1.0, 2024, 1), ("DEF", "2003-09-10", 1.5, 7.0, 2003, 9), ("ABC", "2002-09-10", 2.0, 1.0, 2002, 9), (None, "2003-09-10", 1.0, 1.0, 2003, 9)]
    schema = "symbol string, date string, vw double, close double, year int, month int"
    spark.createDataFrame(main, schema).write.partitionBy("year", "month").parquet(f"{tmp_path}/main")
    spark.createDataFrame([("ABC", "2003-09-10", 4.0, 2.5, 2003), ("ABC", "2003-09-11", 3.0, 1.0, 2003)], schema.replace(", month int", "")).write.partitionBy("year").parquet(f"{tmp_path}/gap")
    tree = archives.vwap_tree(spark, f"{tmp_path}/main", f"{tmp_path}/gap", (2003, 2024))
    assert "PartitionFilters: [isnotnull(year" in tree._jdf.queryExecution().executedPlan().toString()
    rows = archives.vwap_rows(tree, tenures)
    assert sorted((r.symbol or "", r.place, r.vw, r.reason or "") for r in rows.where("reason is null or reason <> 'value'").collect()) == [
        ("", 0, 1.0, "class"), ("ABC", 0, 2.0, ""), ("ABC", 0, 2.0, "later"), ("ABC", 1, 3.0, ""), ("ABC", 1, 4.0, ""), ("DEF", 0, 1.5, ""), ("aB", 0, 2.0, "class"),
    ]
    assert rows.where("reason = 'value'").count() == 1
    d = Decimal
    prices = spark.createDataFrame([(1, date(2003, 9, 10), d(1), d(1), d(1), d("2.5"), 1, 3, None), (1, date(2003, 9, 11), d(1), d(1), d(1), d(1), 1, None, None), (2, date(2003, 9, 10), d(1), d(1), d(1), d(8), 1, 3, None)], PRICES)
    staged = rows.where("reason is null")
    assert sorted((r.security_id, r.vw, r.bucket) for r in archives.vwap_buckets(staged, prices).collect()) == [(1, 2.0, "update"), (1, 3.0, "bare"), (1, 4.0, "update"), (2, 1.5, "mismatch")]
    assert sorted((r.security_id, r.date.day, r.vwap) for r in archives.with_vwap(prices, staged).collect()) == [(1, 10, 2.0), (1, 11, None), (2, 10, None)]


def test_equal_dividends_are_one(spark):
    rows = [("b", "X", "2020-01-02", "2020-02-01", "0.50", None), ("a", "X", "2020-01-02", "2020-02-01", "0.5", "usd"), ("c", "X", "2020-01-02", "2020-02-01", "0.6", "USD"), ("d", "X", "2020-01-02", None, "0.5", ""), ("e", "X", "2020-01-02", None, "0.5", "USD"), ("e", "X", "2020-01-02", None, "0.5", "USD"), ("", "X", "2020-01-02", None, "1", "USD"), ("g", "X", "none", None, "1", "USD"), ("h", None, "2020-01-02", None, "0", "USD"), ("i", None, "2020-01-02", None, "nan", "USD"), ("j", None, "2020-01-02", None, "2", "CAD")]
    got = archives.dividends(spark.createDataFrame(rows, "id string, ticker string, ex_date string, pay_date string, cash string, currency string"), spark.createDataFrame([("b",)], "id string")).collect()
    assert sorted((r.id or "", r.reason or "", r.currency) for r in got) == [("", "row", "USD"), ("a", "duplicate", "USD"), ("b", "", "USD"), ("c", "", "USD"), ("d", "", "USD"), ("e", "duplicate", "USD"), ("e", "duplicate", "USD"), ("g", "row", "USD"), ("h", "row", "USD"), ("i", "row", "USD"), ("j", "", "CAD")]


SPLITS = "id string, ticker string, ex_date string, split_from double, split_to double, adjustment_type string"


def test_splits_in_conflict_are_quarantined(spark):
    rows = [("E1", "A", "2020-01-02", 1.0, 2.0, "f"), ("E2", "A", "2020-01-02", 1.0, 2.0, "f"), ("E2", "A", "2020-01-02", 1.0, 2.0, "f"), ("E3", "B", "2020-01-02", 1.0, 2.0, "f"), ("E4", "B", "2020-01-02", 1.0, 3.0, "f"), ("P1", "C", "2020-01-02", 1.0, 2.0, "f"), ("P2", "D", "2020-01-02", 1.0, 2.0, "f"), ("E5", "E", "2020-01-02", 2.0, 4.0, "f"), ("E6", "E", "2020-01-02", 1.0, 2.0, "f"), ("E7", "F", "2020-01-02", 1.0, 2000.0, None), ("E8", "G", "2020-01-02", 0.0, 2.0, "f"), (None, "G", "2020-01-02", 1.0, 2.0, "f"), ("E9", "H", "2020-01-02", 1.0, None, "f")]
    df, known = spark.createDataFrame(rows, SPLITS), spark.createDataFrame([("E2",)], "id string")
    allowed = spark.createDataFrame([("P2", "spinoff_pseudo_split"), ("E6", None)], "id string, override string")
    got = archives.splits(df, known, allowed).collect()
    assert sorted((r.id or "", r.reason or "") for r in got) == [("", "row"), ("E1", "duplicate"), ("E2", ""), ("E2", "duplicate"), ("E3", "conflict"), ("E4", "conflict"), ("E5", "conflict"), ("E6", ""), ("E7", ""), ("E8", "row"), ("E9", "row"), ("P1", "spinoff"), ("P2", "")]
    assert {r.id: r.adjustment_type for r in got if r.id in ("P2", "E6")} == {"P2": "spinoff_pseudo_split", "E6": "f"} and [r.id for r in got if r.extreme] == ["E7"]
    both = spark.createDataFrame([("E3", None), ("E4", None)], "id string, override string")
    with pytest.raises(PySparkException, match="contradict"):
        archives.splits(df, known, both).collect()
    assert archives.splits(df.where("false"), known, allowed).count() == 0


def test_changes_of_tickers(spark):
    rows = [("0000123", "bbg1", " FB ", "2022-06-09", "ticker_change", "META", None), ("0", None, "fb", "2022-06-09", "ticker_change", " ", '{"ticker_change": {"ticker": "Meta"}}'), (None, None, "X", "1969-12-31", "ticker_change", "X", None), (None, None, "X", "2000-01-01", "delisted", "X", None), (None, None, "X", "2000-01-01", "ticker_change", None, "{broken"), (None, None, "X", None, "ticker_change", "X", None)]
    df = spark.createDataFrame(rows, "cik string, composite_figi string, queried_ticker string, event_date string, event_type string, ticker_at_event string, event_payload string")
    got = [(r.queried, r.cik, r.figi, r.ticker, r.reason) for r in archives.ticker_changes(df).collect()]
    assert got == [("fb", "123", "BBG1", "meta", None), ("fb", None, None, "meta", None), ("x", None, None, "x", "epoch"), ("x", None, None, "x", "kind"), ("x", None, None, None, "row"), ("x", None, None, "x", "row")]


def test_lines_are_asked_without_the_text_of_their_file(spark):
    files = spark.createDataFrame([("x", "1/2024-01-02.csv.gz", "ticker")], "archive string, member string, text string").withColumn("day", F.lit("2024-01-02").cast("date"))
    tenures = spark.createDataFrame([(1, "A", None, None)], "security_id long, symbol string, start date, end date")
    rows = archives.day_bars(files, tenures)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    after = plan[: plan.index("Generate explode")]
    assert "split(text" not in after and plan.count("Generate explode(CASE") == 1


def test_holders_of_symbols_with_overlaps_and_days_without_any(spark):
    d = date
    tenures = spark.createDataFrame(
        [
            (2**62, "A", d(2000, 1, 1), d(2000, 2, 1)), (2**62, "a", d(2000, 1, 15), d(2000, 3, 1)), (2**62 + 1, "A", d(2000, 2, 15), None), (2**62 + 2, "A", d(2000, 4, 1), d(2000, 4, 1)), (7, "B", None, None),
        ], "security_id long, symbol string, start date, end date",
    )
    days = [("A", d(1999, 12, 31)), ("A", d(2000, 1, 20)), ("A", d(2000, 2, 14)), ("A", d(2000, 2, 20)), ("A", d(2000, 3, 1)), ("A", d(2090, 1, 1)), ("B", d(2000, 1, 1)), ("C", d(2000, 1, 1)), ("Ap", d(2000, 1, 20)), ("A", None)]
    rows = spark.createDataFrame([(i, *x, None) for i, x in enumerate(days)], "i int, ticker string, day date, reason string")
    got = [(r["security_id"], r["reason"]) for r in archives.attributed(rows, tenures, "ticker", "day").orderBy("i").collect()]
    one, two = 2**62, 2**62 + 1
    assert got == [(None, "tenure"), (one, None), (one, None), (None, "ambiguous"), (two, None), (two, None), (None, "tenure"), (None, "symbol"), (None, "class"), (None, "tenure")]


def test_a_reload_reads_its_load_twice_at_most(spark):
    load = spark.createDataFrame([], "security_id long, date date, open decimal(18,6), high decimal(18,6), low decimal(18,6), close decimal(18,6), volume long, trade_count long").where("close > 77")
    prices = load.withColumn("vwap", F.lit(1.0)).where("security_id > 0")
    plan = archives.reloaded(prices, load)._jdf.queryExecution().analyzed().toString()
    assert plan.count("77") <= 3  # its own, that of the prices, and that of the reach
