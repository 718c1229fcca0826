"""Repairs of identity, terminal forward returns and costs of each security, by known values."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import identity as idn
from tidemark.operators import records
from tidemark.plans import evaluate, formation

D = date(2025, 1, 6)
SECURITIES = "id long, figi string, cik string, symbol string, active boolean, newest date"
ROWS = [
    (1, "BBG1", "10", "a", False, D), (2, "BBG1", "10", "b", True, D - timedelta(9)), (3, "BBG1", "10", "c", True, None),
    (4, "BBG2", "11", "d", True, D), (5, "BBG2", "12", "d", True, D),  # two owners
    (6, "BBG3", "", "e", True, D), (7, "BBG3", "", "f", False, D),  # no owner
    (8, "UNKNOWN", "13", "g", True, D), (9, "UNKNOWN", "13", "h", True, D),  # a placeholder
    (10, None, "14", "d", True, D), (11, "BBG4", "15", "i", False, D), (12, "BBG4", "15", "j", False, D),  # a tie
]


def plan(spark, **more):
    return idn.merge_plan(spark.createDataFrame(ROWS, SECURITIES), "id", "figi", "cik", "active", "newest", **more)


def test_who_is_kept(spark):
    assert {(r.figi, r.keep_id, r.merge_id) for r in plan(spark).collect()} == {("BBG1", 2, 1), ("BBG1", 2, 3), ("BBG4", 11, 12)}
    assert {(r.keep_id, r.merge_id) for r in plan(spark, cleared=["BBG3", "UNKNOWN"]).where("figi = 'BBG3' or figi = 'UNKNOWN'").collect()} == {(6, 7)}
    assert plan(spark).where("false").count() == 0 and idn.merge_plan(spark.createDataFrame([], SECURITIES), "id", "figi", "cik", "active", "newest").count() == 0


def test_symbols_given_again(spark):
    s = idn.split_plan(spark.createDataFrame(ROWS + [(13, "BBG9", "20", "a", True, D)], SECURITIES), "id", "symbol", "figi")
    assert [(r.symbol, r.ids) for r in s.collect()] == [("a", [1, 13])]  # one group twice, or without one, is none


def test_rows_move_unless_their_key_is_there(spark):
    rows = [(1, D, "x"), (1, None, "y"), (2, D, "z"), (3, None, "u"), (3, D + timedelta(1), "v"), (4, D, "w"), (None, D, "n")]
    child = spark.createDataFrame(rows, "id long, d date, tag string")
    got = {r.tag: (r.id, r.moved) for r in idn.moved(child, plan(spark), "id", ["d"]).collect()}
    # x stays, since 2 has its day; of the null days that 1 and 3 bring the first comes through
    assert got == {"x": (1, False), "y": (2, True), "z": (2, False), "u": (3, False), "v": (2, True), "w": (4, False), "n": (None, False)}
    free = {r.tag: r.id for r in idn.moved(child, plan(spark), "id").collect()}
    assert free == {"x": 2, "y": 2, "z": 2, "u": 2, "v": 2, "w": 4, "n": None}
    again = idn.moved(idn.moved(child, plan(spark), "id", ["d"]).drop("moved"), plan(spark), "id", ["d"])
    assert again.where("moved").count() == 0


def test_what_is_left_to_each(spark):
    s = spark.createDataFrame(ROWS, SECURITIES)
    child = spark.createDataFrame([(1, D, "x"), (2, D, "z"), (2, D + timedelta(5), "q")], "id long, d date, tag string")
    after = {r.id: (r.active, r.newest) for r in idn.after_merge(s, plan(spark), idn.moved(child, plan(spark), "id", ["d"]), "id", "active", "newest", "d").collect()}
    assert after[1] == (False, D) and after[2] == (True, D + timedelta(5)) and after[3] == (False, None) and after[4] == (True, D)


def test_wrong_links(spark):
    links = spark.createDataFrame([(1, "ab"), (1, "cd"), (2, "ab")], "id long, code string")
    held = spark.createDataFrame([(1, "AB"), (1, "ab"), (1, "CD"), (2, "AB"), (None, "AB")], "id long, code string")
    bad = spark.createDataFrame([(1, "ab"), (7, "zz")], "id long, code string")
    p, kept, after = idn.link_repairs(bad, held, links, "id", "code")
    assert {tuple(r) for r in p.collect()} == {(1, "AB", 2), (7, "ZZ", 0)}
    assert {tuple(r) for r in kept.collect()} == {(1, "cd"), (2, "ab")}
    assert sorted((str(r.id), r.code) for r in after.collect()) == [("1", "CD"), ("2", "AB"), ("None", "AB"), ("None", "AB"), ("None", "ab")]


def forward(spark, columns, horizon, terminal, trimmed=False):
    """Forward returns by column; trimmed leaves out the dates after a column's last price."""
    rows = [(s, D + timedelta(7 * i), p, terminal.get(s)) for s, ps in columns.items() for i, p in enumerate(ps) if not (trimmed and all(x is None for x in ps[i:]))]
    g = spark.createDataFrame(rows, "security_id long, date date, close double, terminal double")
    got = evaluate.with_terminal_forward(g, horizon, "terminal", 7).orderBy("date").collect()
    return {s: [r.forward for r in got if r.security_id == s] for s in columns}


LEFT = {10: [100.0, 110.0, 120.0, 130.0, None, None], 20: [50.0, 51.0, 52.0, 53.0, 54.0, 55.0]}


@pytest.mark.parametrize("trimmed", [False, True])
def test_terminal_returns_in_windows(spark, trimmed):
    f = forward(spark, LEFT, 2, {10: -0.4}, trimmed)
    assert f[10][:4] == pytest.approx([120 / 100 - 1, 130 / 110 - 1, 130 / 120 * 0.6 - 1, -0.4]) and set(f[10][4:]) <= {None}
    assert f[20][:4] == pytest.approx([52 / 50 - 1, 53 / 51 - 1, 54 / 52 - 1, 55 / 53 - 1]) and f[20][4:] == [None, None]
    unknown = forward(spark, LEFT, 2, {20: -0.9}, trimmed)  # no return of 10: its last price is held; 20 is still there
    assert unknown[10][:4] == pytest.approx([0.2, 130 / 110 - 1, 130 / 120 - 1, 0.0]) and unknown[20] == f[20]


def test_terminal_returns_past_the_last_date(spark):
    f = forward(spark, {10: [100.0, 110.0, 120.0, 130.0, None], 20: [1.0] * 5}, 3, {10: -0.5})
    assert f[10][:4] == pytest.approx([0.3, 130 / 110 * 0.5 - 1, 130 / 120 * 0.5 - 1, -0.5]) and f[10][4] is None
    halted = forward(spark, {10: [100.0, None, 120.0, None, None], 20: [1.0] * 5}, 1, {10: -1.0})
    assert halted[10][0] == 0.0 and halted[10][1] is None and halted[10][2] == -1.0 and halted[10][3:] == [None, None]


def test_costs_by_security(spark):
    rows = [(s, D + timedelta(7 * i), 10.0, w, c) for s, c in ((1, 0.01), (2, 0.002), (3, None)) for i, w in enumerate([0.0, 0.5, 0.5, 0.0] if s < 3 else [0.0] * 4)]
    w = spark.createDataFrame(rows, "security_id long, date date, close double, w double, cost double")
    got = [r.net for r in evaluate.runs_of_weights(w, "cost").orderBy("date").collect()]
    assert got == pytest.approx([0, -0.006, 0, -0.006])
    one = [r.net for r in evaluate.runs_of_weights(w.drop("cost"), 0.006).orderBy("date").collect()]
    assert one == pytest.approx(got)
    with pytest.raises(Exception, match="no cost of traded security 2"):
        evaluate.runs_of_weights(w.withColumn("cost", F.when(F.col("security_id") != 2, F.col("cost"))), "cost").collect()


def test_formation_and_settlement(spark):
    days = [D + timedelta(7 * i) for i in range(5)]
    panel = spark.createDataFrame([(days[0], s, float(s % 4), float(s)) for s in range(1, 31)] + [(days[0], 99, None, 1.0), (days[0], 98, 9.0, None)], "date date, security_id long, value double, size double")
    f = formation.formed(panel, "value", "size")
    assert [(r.security_id, r.place) for r in f.orderBy("place").collect()] == [(3, 1), (7, 2)]  # of 1 to 10
    assert formation.formed(panel, "value", "size", least=11).count() == 0
    c = formation.continued(formation.formed(panel, "value", "size", groups=2), spark.createDataFrame([(10, 1), (50, 2), (3, 3)], "security_id long, place int"), 4)
    assert [r.security_id for r in c.orderBy("place").collect()] == [10, 3, 7, 2]
    s = formation.snapshot(f, 2)
    rows = s.collect()
    assert [r.w for r in rows] == [0.5, 0.5] and len({r.inputs for r in rows}) == 1
    assert formation.snapshot(f.orderBy(F.desc("place")).repartition(3), 2).first().inputs == rows[0].inputs
    assert formation.snapshot(f.withColumn("value", F.col("value") + 1), 2).first().inputs != rows[0].inputs
    ledger = s.select("date", "security_id", "inputs")
    assert records.new_rows(ledger, ledger, ["date", "security_id", "inputs"]).count() == 2  # a replay adds nothing
    prices = spark.createDataFrame([(3, days[1], 10.0), (3, days[4], 12.0), (7, days[0], 5.0), (7, days[2], 6.0), (7, days[4], None)], "security_id long, date date, close double")
    dates = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r.security_id: (r.entry, r.exit, r.ret, r.note) for r in formation.settled(s, prices, formation.executed(s, dates)).collect()}
    assert got == {3: (days[1], days[4], pytest.approx(0.2), ""), 7: (days[1], days[4], pytest.approx(0.2), "frozen")}
    gone = formation.settled(s, prices.where("false"), formation.executed(s, dates)).collect()
    assert [(r.ret, r.note) for r in gone] == [(0.0, "missing")] * 2
    assert formation.executed(s, dates.where(F.col("date") == days[0])).count() == 0
