"""Metrics of filed facts as events: restatements, trailing years, pairs a year apart, and what was known on a date.

Facts are rows (security_id, concept, period_start, period_end, filed, accession, value); an instant has its day twice.
Events are rows (security_id, metric, period_end, visible, value, prior_end, prior); the last two are for pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.events import no_regressions
from tidemark.operators.windows import dealt

#: Days from start to end of a quarter, half a year, nine months and a year. Fixed values.
DURATIONS = {"Q": (80, 100), "H": (170, 192), "N": (258, 285), "Y": (350, 380)}
#: Days by which the year before may end off the start of a period, and the same period of the year before off its day.
YEAR_TOLERANCE, PERIOD_TOLERANCE = 7, 14
#: Days between the periods of a pair, and by how many they may be off.
PAIR_DAYS, PAIR_TOLERANCE = 365, 35

Metrics = Mapping[str, tuple[str, Sequence[str]]]


def histories(facts: DataFrame, metrics: Metrics) -> DataFrame:
    """(security_id, metric, concept, rank, kind, duration, period_start, period_end, history) for the concepts in metrics.

    metrics: name -> (flow or instant, concepts from the first choice on). history has (filed, value) of the reports that
    changed the value, of one day the last; a period has as many as it was restated. duration is null for instants and for
    spans of none of DURATIONS. Facts are dealt by security once, and all that follows stays with its security.
    """
    names = F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(m).alias("metric"), F.lit(i).alias("rank"), F.lit(kind).alias("kind")) for m, (kind, concepts) in metrics.items() for i, c in enumerate(concepts)])
    spec = facts.sparkSession.range(1).select(F.inline(names))  # as many rows as there are concepts
    keys = ["security_id", "concept", "period_start", "period_end"]
    wanted = dealt(facts.where(F.col("concept").isin(sorted({c for _, concepts in metrics.values() for c in concepts}))), "security_id")
    reports = wanted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("filed", "accession", "value"))).alias("_all"))
    changed = F.filter("_all", lambda x, i: (i == 0) | ~x["value"].eqNullSafe(F.get("_all", i - 1)["value"]))
    last = F.filter("_changed", lambda x, i: ~x["filed"].eqNullSafe(F.get("_changed", i + 1)["filed"]) | (i == F.size("_changed") - 1))
    told = reports.withColumn("_changed", changed).withColumn("history", F.transform(last, lambda x: F.struct(x["filed"].alias("filed"), x["value"].alias("value")))).join(F.broadcast(spec), "concept")
    days, duration = F.datediff("period_end", "period_start"), F.lit(None).cast("string")
    for name, (least, most) in DURATIONS.items():
        duration = F.when((F.col("kind") == "flow") & days.between(least, most), name).otherwise(duration)
    return told.select(*_IDENT, "kind", duration.alias("duration"), "period_start", "period_end", "history")


_IDENT = ("security_id", "metric", "concept", "rank")


def _day(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01"))


def _nearest(found: Column, target: Column, fit: Callable[[Column], Column] = lambda x: F.lit(True)) -> Column:
    """Of an array of structs that begin with their day, the one nearest to target that fits; ties to the earlier."""
    return F.array_min(F.transform(F.filter(found, fit), lambda x: F.struct(F.abs(x["day"] - target).alias("gap"), x.alias("x"))))["x"]


def merged(**legs: Column) -> Column:
    """The legs, arrays of (filed, value) in order, as one array of (filed, a value for each leg), from when all are known on."""
    moments = F.array_sort(F.array_distinct(F.concat(*[F.transform(h, lambda x: x["filed"]) for h in legs.values()])))

    def at(t: Column) -> Column:
        known = {n: F.filter(h, lambda x: x["filed"] <= t) for n, h in legs.items()}
        return F.struct(t.alias("filed"), *[F.get(k, F.size(k) - 1)["value"].alias(n) for n, k in known.items()])

    return F.filter(F.transform(moments, at), lambda x: reduce(and_, [x[n].isNotNull() for n in legs]))


def unrepeated(history: Column, *names: str) -> Column:
    """history without the entries that have the same values as the one before."""

    def new(x: Column, i: Column) -> Column:
        before = F.get(history, i - 1)
        return (i == 0) | reduce(or_, [x[n] != before[n] for n in names])

    return F.filter(history, new)


def all_histories(facts: DataFrame, metrics: Metrics) -> DataFrame:
    """(security_id, metric, concept, rank, period_end, source, history) of every concept, before one is chosen.

    Source 0 are reported years and instants, source 1 derived years: the year to date and the last whole year less the same
    period of that year, all of one concept, told anew whenever a restatement of one changes the sum. Of several periods
    that end on one day the longest is derived from.
    """
    reported, part = (F.col("kind") == "instant") | (F.col("duration") == "Y"), F.col("duration") != "Y"
    h = histories(facts, metrics).where(reported | part).withColumn("day", _day(F.col("period_end")))
    w = Window.partitionBy(*_IDENT).orderBy("day")
    offer = F.struct(F.col("day"), "period_start", "duration", "history")
    # the year before a part ends where the part starts, so it is looked for as far back as parts are long
    spans = [d for name, d in DURATIONS.items() if name != "Y"]
    back = w.rangeBetween(-max(most for _, most in spans) - 1 - YEAR_TOLERANCE, -min(least for least, _ in spans) - 1 + YEAR_TOLERANCE)
    years = F.collect_list(F.when(F.col("duration") == "Y", offer)).over(back)
    parts = F.collect_list(F.when(part, offer)).over(w.rangeBetween(-365 - PERIOD_TOLERANCE, -365 + PERIOD_TOLERANCE))
    met = h.withColumns({"_years": years, "_parts": parts})
    eve = _day(F.col("period_start")) - 1
    year = F.when(part, _nearest(F.col("_years"), eve, lambda x: F.abs(x["day"] - eve) <= YEAR_TOLERANCE))
    earlier = F.when(part, _nearest(F.col("_parts"), F.col("day") - 365, lambda x: x["duration"] == F.col("duration")))
    row = met.withColumns({"year": year, "earlier": earlier}).drop("_years", "_parts")
    legs = merged(to_date=F.col("history"), year=F.col("year")["history"], earlier=F.col("earlier")["history"])
    sums = F.transform(legs, lambda x: F.struct(x["filed"].alias("filed"), (x["to_date"] + x["year"] - x["earlier"]).alias("value")))
    derivable = part & F.col("year").isNotNull() & F.col("earlier").isNotNull()
    made = row.select(*_IDENT, "day", "period_start", "period_end", F.when(reported, 0).when(derivable, 1).alias("source"), F.when(reported, F.col("history")).when(derivable, sums).alias("history"))
    longest = F.min(F.when(F.col("source") == 1, F.col("period_start"))).over(w.rangeBetween(Window.currentRow, Window.currentRow))
    kept = made.withColumn("_longest", longest).where("source = 0 or source = 1 and period_start = _longest")
    return kept.select(*_IDENT, "period_end", "source", unrepeated(F.col("history"), "value").alias("history")).where("size(history) > 0")


def _chosen(rows: DataFrame, *columns: Column) -> DataFrame:
    """Rows of the first concept of each period, reported before derived, one for each entry of their history, without regressions of the period."""
    best = F.min(F.struct("source", "rank")).over(Window.partitionBy("security_id", "metric", "period_end"))
    chosen = rows.withColumn("_best", best).where(F.struct("source", "rank") == F.col("_best")).select("*", F.explode("history").alias("h"))
    told = chosen.select("security_id", "metric", "period_end", F.col("h.filed").alias("visible"), *columns)
    return no_regressions(told, ["security_id", "metric"], ["visible", "period_end"], "period_end")


def metric_events(facts: DataFrame, metrics: Metrics) -> DataFrame:
    """Events of metrics: for each period the reports of one concept, the reported before the derived and then the first choice, all its vintages.

    Events of a period before one that was already visible are left out.
    """
    every = all_histories(facts, metrics)
    value = F.col("h.value")
    return _chosen(every, value.alias("value"), F.lit(None).cast("date").alias("prior_end"), F.when(F.lit(False), value).alias("prior"))


def pair_events(facts: DataFrame, metrics: Metrics, suffix: str = "_pair") -> DataFrame:
    """Events of metrics with the value of the period nearest to a year before, of the same concept, as either was known.

    A restatement of either makes a new event. One concept is chosen for a period, as in metric_events.
    """
    every = all_histories(facts, metrics)
    w = Window.partitionBy("security_id", "metric", "concept").orderBy("day").rangeBetween(-PAIR_DAYS - PAIR_TOLERANCE, -PAIR_DAYS + PAIR_TOLERANCE)
    offer = F.struct(F.col("day"), "source", "period_end", "history")
    met = every.withColumn("day", _day(F.col("period_end"))).withColumn("_offers", F.collect_list(offer).over(w))
    pairs = met.withColumn("earlier", _nearest(F.col("_offers"), F.col("day") - PAIR_DAYS)).drop("_offers").where("earlier is not null")
    both = merged(value=F.col("history"), prior=F.col("earlier")["history"])
    rows = pairs.withColumn("metric", F.concat("metric", F.lit(suffix))).withColumn("both", both).withColumn("history", unrepeated(F.col("both"), "value", "prior")).where("size(history) > 0")
    return _chosen(rows, F.col("h.value").alias("value"), F.col("earlier.period_end").alias("prior_end"), F.col("h.prior").alias("prior"))


def known_on(dates: DataFrame, events: DataFrame, metrics: Sequence[str], delay: int = 1, max_age: int = 270) -> DataFrame:
    """dates(security_id, date) with, for each metric, the last event that is visible, delay days after it was.

    A column is a struct (period_end, value, prior_end, prior), null where nothing is known or its period ended more than
    max_age days before. All metrics come from one ordering of a security's dates and events.
    """
    told = F.struct("period_end", "value", "prior_end", "prior")
    e = events.where(F.col("metric").isin(*metrics)).select("security_id", F.date_add("visible", delay).alias("date"), F.lit(0).alias("_side"), "metric", told.alias("_e"))
    d = dates.select("security_id", "date").distinct().select("security_id", "date", F.lit(1).alias("_side"), F.lit(None).cast("string").alias("metric"), F.lit(None).cast(e.schema["_e"].dataType).alias("_e"))
    w = Window.partitionBy("security_id").orderBy("date", "_side", "_e").rowsBetween(Window.unboundedPreceding, 0)
    last = [F.last(F.when(F.col("metric") == m, F.col("_e")), ignorenulls=True).over(w).alias(m) for m in metrics]
    found = dealt(e.unionByName(d), "security_id").select("security_id", "date", "_side", *last).where("_side = 1")
    fresh = [F.when(F.datediff("date", F.col(m)["period_end"]) <= max_age, F.col(m)).alias(m) for m in metrics]
    return found.select("security_id", "date", *fresh)


def with_members(dates: DataFrame, companies: DataFrame) -> DataFrame:
    """dates(security_id, date) and those dates for all other members of their companies(security_id, company_id)."""
    wanted = dates.join(companies, "security_id").select("company_id", "date").distinct()
    return dates.select("security_id", "date").unionByName(wanted.join(companies, "company_id").select("security_id", "date")).distinct()


def company_values(panel: DataFrame, companies: DataFrame, universe: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of universe(security_id, date) with, in each column, what the first member of its company has that has any.

    Members come in the order of their ids, and each column by itself. A security without a company has its own values.
    """
    c = panel.join(companies, "security_id", "left")
    group = [F.when(F.col("company_id").isNull(), F.col("security_id")).alias("_own"), "company_id", "date"]
    first = c.groupBy(*group).agg(*[F.min_by(x, F.when(F.col(x).isNotNull(), F.col("security_id"))).alias(x) for x in columns])
    u = universe.select("security_id", "date").distinct().join(companies, "security_id", "left").withColumn("_own", F.when(F.col("company_id").isNull(), F.col("security_id")))
    f = first.select(F.coalesce(F.col("company_id"), F.lit(-1)).alias("_c"), F.coalesce("_own", F.lit(-1)).alias("_o"), "date", *columns)
    u = u.select("security_id", "date", F.coalesce(F.col("company_id"), F.lit(-1)).alias("_c"), F.coalesce("_own", F.lit(-1)).alias("_o"))
    return u.join(f, ["_c", "_o", "date"], "left").select("security_id", "date", *columns)


def mean_of_known(scores: Sequence[Column], least: int) -> Column:
    """The mean of those scores, true or false, that are known; null where they are fewer than least."""
    known = sum((s.isNotNull().cast("int") for s in scores), F.lit(0))
    right = sum((F.coalesce(s, F.lit(False)).cast("int") for s in scores), F.lit(0))
    return F.when(known >= least, right / known)
