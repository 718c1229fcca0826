"""Identity operators: overlapping spans, tenures, maps of symbols and resolution to one security."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(spans: DataFrame, by: str, ident: str, start: str, end: str, last: str, span_days: int = 64) -> DataFrame:
    """(a, b, first, until): pairs of spans of one by with different ids a < b that share days; null ends are open until last.

    Spans are put into every piece of span_days that they touch, and a pair is told in the piece where
    it begins, so only spans near each other are compared.
    """
    piece = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / span_days)
    s = spans.select(F.col(by), F.col(ident).alias("id"), F.col(start).alias("s"), F.coalesce(F.col(end), F.lit(last).cast("date")).alias("e")).where("s <= e")
    put = s.withColumn("piece", F.explode(F.sequence(piece(F.col("s")), piece(F.col("e")))))
    a, b = (put.select(by, "piece", F.col("id").alias(n), F.col("s").alias(f"s_{n}"), F.col("e").alias(f"e_{n}")) for n in "ab")
    first, until = F.greatest("s_a", "s_b"), F.least("e_a", "e_b")
    return a.join(b, [by, "piece"]).where((F.col("a") < F.col("b")) & (first <= until) & (piece(first) == F.col("piece"))).select("a", "b", first.alias("first"), until.alias("until"))


def alone(spans: DataFrame, by: str, ident: str, start: str, end: str) -> DataFrame:
    """(by, id, start, end): the days of half-open spans that no other span of the same by has.

    Every border of a by ends or begins a stretch; a running count of open spans tells those that one
    span has for itself, and stretches of one span that touch are put together.
    """
    edges = spans.select(by, F.inline(F.array(F.struct(F.col(start).alias("d"), F.lit(1).alias("n"), F.col(ident).alias("id")), F.struct(F.col(end).alias("d"), F.lit(-1).alias("n"), F.col(ident).alias("id")))))
    at = edges.groupBy(by, "d").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("id")).alias("x"))
    w = Window.partitionBy(by).orderBy("d")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    # the sum of the ids of open spans is the id itself where only one is open
    stretches = at.select(by, F.col("d").alias("start"), F.lead("d").over(w).alias("end"), F.sum("n").over(run).alias("open"), F.sum("x").over(run).alias("id")).where("open = 1")
    own = Window.partitionBy(by, "id").orderBy("start")
    fresh = F.coalesce((F.lag("end").over(own) != F.col("start")).cast("int"), F.lit(1))
    return stretches.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(own)).groupBy(by, "id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def shared(df: DataFrame, by: str, ident: str) -> DataFrame:
    """(by, ids): values that several ids have, with those ids in order."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.sort_array(F.collect_set(ident)).alias("ids")).where(F.size("ids") > 1)


def one_to_one(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b): pairs in which neither side has another partner."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()
    counted = pairs.select(a, b, F.count("*").over(Window.partitionBy(a)).alias("_a"), F.count("*").over(Window.partitionBy(b)).alias("_b"))
    return counted.where("_a = 1 and _b = 1").select(a, b)


def resolved(incoming: DataFrame, known: DataFrame, ident: str, anchors: Sequence[str], key: str) -> DataFrame:
    """incoming with resolution, the first of anchors by which exactly one known row is found, and that row's id.

    'conflict' if different anchors that are unambiguous name different rows; 'new' if none names any.
    known and incoming have the anchor columns; key tells incoming rows apart.
    """
    out = incoming
    for c in anchors:
        one = known.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(ident).alias(f"_{c}"), F.max(ident).alias("_most")).where(F.col(f"_{c}") == F.col("_most")).drop("_most")
        out = out.join(one, c, "left")
    found = [F.col(f"_{c}") for c in anchors]
    several = F.size(F.array_distinct(F.array_compact(F.array(*found)))) > 1
    name = F.when(several, "conflict")
    for c, f in zip(anchors, found):
        name = name.when(f.isNotNull(), c)
    return out.select(key, name.otherwise("new").alias("resolution"), F.when(~several, F.coalesce(*found)).alias(ident))


def tenures(df: DataFrame, by: str, start: str, ident: str, last: Column | None = None) -> DataFrame:
    """df with end, the next start of the same by, and open: the last tenure stays open unless last gives its end."""
    w = Window.partitionBy(by).orderBy(start, ident)
    end = F.lead(start).over(w)
    return df.withColumn("end", end if last is None else F.coalesce(end, last)).withColumn("open", F.col("end").isNull())


def merge_plan(securities: DataFrame, ident: str, group: str, owner: str, active: str, newest: str, valid: str = "^BBG", cleared: Sequence[str] = ()) -> DataFrame:
    """(group, keep_id, merge_id): which ids of one group are to become which; a row for each id that goes.

    A group is a value of a form that valid matches; placeholders that many securities share are none. Only groups whose
    rows all have the same owner, not null or blank, are planned, and those that were cleared by name. Active rows are kept
    before others, then those with the newest date, then the smallest id.
    """
    known = securities.where(F.col(group).rlike(valid)).select(group, F.col(ident).alias("_id"), F.nullif(F.trim(F.col(owner).cast("string")), F.lit("")).alias("_owner"), F.coalesce(active, F.lit(False)).alias("_active"), F.col(newest).alias("_newest"))
    kept = known.groupBy(group).agg(
        F.max_by("_id", F.struct("_active", "_newest", -F.col("_id"))).alias("keep_id"),
        ((F.count("_owner") == F.count("*")) & F.min("_owner").eqNullSafe(F.max("_owner"))).alias("_one"),
        F.count("*").alias("_n"),
    ).where((F.col("_n") > 1) & (F.col("_one") | F.col(group).isin(list(cleared))))
    return known.join(kept, group).where("_id <> keep_id").select(group, "keep_id", F.col("_id").alias("merge_id"))


def split_plan(securities: DataFrame, ident: str, symbol: str, group: str) -> DataFrame:
    """(symbol, ids): symbols that several groups have had, with their ids in order: names that were given again, not securities to be merged."""
    by = securities.where(F.col(symbol).isNotNull() & F.col(group).isNotNull()).groupBy(symbol)
    return by.agg(F.sort_array(F.collect_set(ident)).alias("ids"), (F.min(group) != F.max(group)).alias("_several")).where("_several").drop("_several")


def moved(child: DataFrame, plan: DataFrame, ident: str, keys: Sequence[str] = ()) -> DataFrame:
    """child with moved: rows of ids that go have the id that is kept, unless a row with the same keys is there already.

    Null keys are equal. Of several ids that bring the same keys the smallest comes through; rows that can't move keep their
    id. Without keys all rows move. Only rows of ids in the plan are exchanged by key, others pass through.
    """
    goes = plan.select(F.col("merge_id").alias(ident), F.col("keep_id").alias("_to"))
    stays = plan.select(F.col("keep_id").alias(ident), F.col("keep_id").alias("_to")).distinct()
    found = child.join(goes.unionByName(stays), ident, "left")
    rest = found.where("_to is null").withColumn("moved", F.lit(False))
    own = F.col(ident) == F.col("_to")
    touched = found.where("_to is not null")
    first = F.rank().over(Window.partitionBy("_to", *keys).orderBy(F.desc(own), ident)) == 1 if keys else F.lit(True)
    touched = touched.withColumn("_own", own).withColumn("moved", first & ~F.col("_own")).withColumn(ident, F.when(F.col("moved"), F.col("_to")).otherwise(F.col(ident)))
    return touched.select(*child.columns, "moved").unionByName(rest.select(*child.columns, "moved"))


def after_merge(securities: DataFrame, plan: DataFrame, rows: DataFrame, ident: str, active: str, newest: str, date: str) -> DataFrame:
    """securities once rows were moved: ids that went are inactive, and newest is the last date that is left to an id.

    An id that is kept and had no newest date still has none, which asks for all its history; others stay as they are.
    """
    went = plan.select(F.col("merge_id").alias(ident), F.lit(True).alias("_went"))
    kept = plan.select(F.col("keep_id").alias(ident), F.lit(False).alias("_went")).distinct()
    role = went.unionByName(kept)
    last = rows.join(role, ident, "left_semi").groupBy(ident).agg(F.max(date).alias("_last"))
    s = securities.join(role, ident, "left").join(last, ident, "left")
    left = F.when(F.col("_went") | F.col("_went").isNotNull() & F.col(newest).isNotNull(), F.col("_last")).otherwise(F.col(newest))
    values = {active: F.col(active) & ~F.coalesce("_went", F.lit(False)), newest: left}
    return s.select(*[values.get(c, F.col(c)).alias(c) for c in securities.columns])


def link_repairs(suspects: DataFrame, holdings: DataFrame, links: DataFrame, ident: str, code: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, links, holdings) of wrong links: how many holdings each touches, the links without them, and the holdings of just those pairs unlinked.

    Codes are compared in capitals; holdings that have the id by another code stay.
    """
    bad = suspects.select(ident, F.upper(code).alias("_code")).distinct()
    hits = holdings.select(ident, F.upper(code).alias("_code")).join(bad, [ident, "_code"], "left_semi").groupBy(ident, "_code").agg(F.count("*").alias("affected"))
    plan = bad.join(hits, [ident, "_code"], "left").select(ident, F.col("_code").alias(code), F.coalesce("affected", F.lit(0)).alias("affected"))
    kept = links.withColumn("_code", F.upper(code)).join(bad, [ident, "_code"], "left_anti").select(links.columns)
    marked = holdings.withColumn("_code", F.upper(code)).join(bad.withColumn("_bad", F.lit(True)), [ident, "_code"], "left")
    unlinked = marked.select(*[F.when(F.col("_bad").isNull(), F.col(c)).alias(c) if c == ident else F.col(c) for c in holdings.columns])
    return plan, kept, unlinked
