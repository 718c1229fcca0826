"""Checks of whole histories: kinds of violations, the ratchet's states, symbols of other securities."""

from tidemark.operators import checks

BAR = "open double, high double, low double, close double, volume bigint, trade_count bigint, vwap double"


def test_violations_by_source_and_kind(spark):
    rows = [(1.0, 2.0, 1.0, 2.0, 1, 5, None), (3.0, 2.0, 1.0, 2.0, 1, 5, 1.0), (1.0, 1.0, 2.0, 1.0, -1, None, 1.0), (0.0, 1.0, 0.0, 1.0, None, None, None), (None, 1.0, 2.0, 1.0, -1, None, None)]
    got = {(r.source, r.kind): r.n for r in checks.bar_violations(spark.createDataFrame(rows, BAR), checks.source_of_bar()).collect()}
    live = {"high<low": 1, "low>open": 1, "low>close": 1, "negative volume": 1, "any": 1}
    want = {("files", "high<open"): 1, ("files", "any"): 1, ("old", "not positive"): 1, ("old", "any"): 1} | {("live", k): n for k, n in live.items()}
    want |= {("all", k): n for k, n in live.items() if k != "any"} | {("all", "high<open"): 1, ("all", "not positive"): 1, ("all", "any"): 3}
    assert got == want
    assert checks.bar_violations(spark.createDataFrame([], BAR), checks.source_of_bar()).count() == 0


def test_counts_may_only_fall(spark):
    df = lambda *rows: spark.createDataFrame(rows, "source string, kind string, n bigint")
    got = checks.ratchet(df(("a", "x", 3), ("a", "y", 2), (None, "x", 1), ("b", "x", 4)), df(("a", "x", 1), ("a", "y", 2), (None, "x", 5), ("c", "x", 2)), ["source", "kind"])
    assert {(r.source, r.kind): (r.n, r.allowed, r.beyond, r.state) for r in got.collect()} == {("a", "x"): (3, 1, 2, "new"), ("a", "y"): (2, 2, 0, "known"), (None, "x"): (1, 5, 0, "fewer"), ("b", "x"): (4, 0, 4, "new"), ("c", "x"): (0, 2, 0, "fewer")}


def test_symbols_that_others_have_now(spark):
    history = spark.createDataFrame([(1, "fb"), (1, "fb"), (2, "META"), (3, None), (4, "old")], "security_id bigint, symbol string")
    now = spark.createDataFrame([(1, "meta", True), (5, "FB", True), (6, "fb", False), (7, None, True), (4, "OLD", True), (8, "Old", None)], "security_id bigint, symbol string, is_active boolean")
    got = {(r.security_id, r.symbol, r.active_id, r.active_symbol) for r in checks.reconnectable(history, now).collect()}
    assert got == {(1, "fb", 5, "FB"), (2, "META", 1, "meta")}
