"""Archives of daily bars, prices by volume, corporate actions and changes of tickers.

A reader keeps every row and says in `reason` why it isn't loaded; null means that it is. Counts of a load are a
groupBy of that column, and quarantined rows keep all they had.
"""

from __future__ import annotations

import io
import posixpath
import tarfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.writes import last_per_key, upsert

#: Columns of a day's file, and tickers of common shares and funds (others have small letters for their class).
HEADER = ("ticker", "volume", "open", "close", "high", "low", "window_start", "transactions")
TICKER = "^[A-Z][A-Z0-9.]*$"
_SUFFIX = ".csv.gz"
_PRICE = "decimal(18,6)"
_BARS = ("open", "high", "low", "close", "volume", "trade_count")


def _same(keys: Sequence[str], a: str, b: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return condition


# Daily bars


def _with_day(files: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    """files whose names are a day, of the years asked for."""
    day = F.regexp_extract("member", r"(?:^|/)(\d{4}-\d{2}-\d{2})\.csv\.gz$", 1).try_cast("date")
    dated = files.withColumn("day", day).where("day is not null")
    return dated if years is None else dated.where(F.year("day").between(*years))


def day_files(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """(archive, member, day, text) of single compressed files below path, named by their day; one file is one row, so a task holds the largest."""
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"[!.]*{_SUFFIX}").text(path, wholetext=True)
    return _with_day(read.select(F.lit(None).cast("string").alias("archive"), F.col("_metadata.file_path").alias("member"), F.col("value").alias("text")), years)


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                for entry in tar:
                    base = posixpath.basename(entry.name)
                    # other systems leave a shadow of each file, with a dot before its name
                    if entry.isfile() and base.endswith(_SUFFIX) and not base.startswith("._"):
                        raw = tar.extractfile(entry).read()
                        text = zlib.decompress(raw, wbits=31) if raw.startswith(b"\x1f\x8b") else raw
                        yield pd.DataFrame({"archive": [path], "member": [entry.name], "text": [text.decode("utf-8", "replace")]})


def packed_day_files(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """(archive, member, day, text) of the files inside tar archives, compressed or not; an archive is read by one task, and its files are dealt to all.

    Spark hands an archive over whole, so it must be smaller than 2 GB; a year of days is some 50 MB.
    """
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    return _with_day(archives.mapInPandas(_unpacked, "archive string, member string, text string").repartition("archive", "member"), years)


def day_rows(files: DataFrame, header: Sequence[str] = HEADER, strict: bool = False) -> DataFrame:
    """(archive, member, day, n, ticker, open, high, low, close, volume, trade_count, line, reason): a row for each line after the header.

    Reasons: 'header' for the first line of a file with another header, whose rest isn't read (strict: the job stops
    instead), 'width' for a line with more or fewer fields, 'number' for one without numbers, 'price' for one with a price
    that isn't positive. Blank lines are no rows.
    """
    lines = F.split("text", r"\r?\n")
    fits = F.get(lines, F.lit(0)) == ",".join(header)
    if strict:
        fits = F.when(fits, True).otherwise(F.raise_error(F.concat(F.lit("unexpected header in "), "member")).cast("boolean"))
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("n"), x.alias("line")))
    wanted = F.when(fits, F.filter(numbered, lambda x: (x["n"] > 0) & (F.trim(x["line"]) != ""))).otherwise(F.slice(numbered, 1, 1))
    # only a file whose header doesn't fit gives a line 0; asked of the line, so that no line carries its file's text along
    rows = files.select("archive", "member", "day", F.explode(wanted).alias("_l")).select("archive", "member", "day", (F.col("_l.n") > 0).alias("_fits"), "_l.n", "_l.line")
    schema = ", ".join(f"`{c}` string" for c in (*header, "_broken"))
    c = rows.withColumn("_c", F.from_csv("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    prices = {x: F.col(f"_c.{x}").try_cast(_PRICE) for x in ("open", "high", "low", "close")}
    volume, trades = F.col("_c.volume").try_cast("double").try_cast("bigint"), F.nullif(F.col("_c.transactions"), F.lit(""))
    t = c.select("archive", "member", "day", "n", F.col("_c.ticker").alias("ticker"), *[v.alias(k) for k, v in prices.items()], volume.alias("volume"), trades.try_cast("double").try_cast("bigint").alias("trade_count"), "line", "_fits", F.col("_c._broken").isNotNull().alias("_broken"))
    missing = F.greatest(*[F.col(x).isNull() for x in (*prices, "volume")])
    reason = F.when(~F.col("_fits"), "header").when(F.col("_broken"), "width").when(missing, "number").when(F.least(*prices) <= 0, "price")
    return t.withColumn("reason", reason).drop("_fits", "_broken")


def holders(tenures: DataFrame) -> DataFrame:
    """(_k, _at, _n, _id) of tenures (security_id, symbol, start, end): how many securities have a symbol in small letters from a day on, and which if one.

    A row for each day on which that changes, and one without a day for every symbol. Tenures of one security that overlap are one.
    """
    held = tenures.select("security_id", F.lower("symbol").alias("_k"), "start", "end").where(F.col("_k").isNotNull())
    lasting = held.where(F.col("security_id").isNotNull() & F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("start") < F.col("end"))))
    ends = F.filter(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d"))), lambda e: e["at"].isNotNull())
    moves = lasting.select("_k", "security_id", F.explode(ends).alias("_e")).groupBy("_k", "security_id", F.col("_e.at").alias("_at")).agg(F.sum("_e.d").alias("_d"))
    own = Window.partitionBy("_k", "security_id").orderBy("_at")
    has = moves.select("_k", "security_id", "_at", (F.sum("_d").over(own) > 0).cast("int").alias("_has"))
    turns = has.withColumn("_d", F.col("_has") - F.lag("_has", 1, 0).over(own)).where("_d <> 0")
    ident = F.col("security_id").cast("decimal(20,0)")
    days = turns.groupBy("_k", "_at").agg(F.sum("_d").alias("_d"), F.sum(F.col("_d") * ident).alias("_s"))
    run = Window.partitionBy("_k").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum("_d").over(run)
    # the sum of the holders' ids is the id where there is one
    steps = days.select("_k", "_at", n.alias("_n"), F.when(n == 1, F.sum("_s").over(run)).cast(tenures.schema["security_id"].dataType).alias("_id"))
    return held.select("_k", F.lit(None).cast(steps.schema["_at"].dataType).alias("_at"), F.lit(0).cast("bigint").alias("_n"), F.lit(None).cast(steps.schema["_id"].dataType).alias("_id")).distinct().unionByName(steps)


def attributed(rows: DataFrame, tenures: DataFrame, ticker: str, on: str) -> DataFrame:
    """rows with security_id, that of the only security whose tenure of the ticker [start, end) holds the day, and more reasons.

    'class' for tickers of other classes, 'symbol' where nobody ever had it, 'tenure' where nobody had it on the day,
    'ambiguous' where several did. Rows that have a reason already aren't asked about. Tenures (security_id, symbol, start,
    end) compare without regard to capitals; a null end is open. Rows and changes of holders are united and ordered by
    ticker once, so rows are read once; rows that aren't asked about are dealt to all tasks.
    """
    fits = F.coalesce(F.col(ticker).rlike(TICKER), F.lit(False))
    key = F.when(F.col("reason").isNull() & fits, F.lower(ticker))
    day = rows.schema[on].dataType
    answer = F.struct(F.col("_n"), F.col("_id"))
    told = holders(tenures).select("_k", F.lit(0).cast("bigint").alias("_deal"), F.col("_at").cast(day).alias("_at"), F.lit(0).alias("_side"), answer.alias("_told"), F.lit(None).cast(rows.select(F.struct("*")).schema[0].dataType).alias("_row"))
    asking = rows.select(key.alias("_k"), F.struct("*").alias("_row"), F.xxhash64(ticker, on).alias("_hash")).select(
        "_k", F.when(F.col("_k").isNull(), F.col("_hash")).otherwise(0).alias("_deal"), F.col(f"_row.{on}").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(told.schema["_told"].dataType).alias("_told"), "_row",
    )
    w = Window.partitionBy("_k", "_deal").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = told.unionByName(asking).withColumn("_told", F.last("_told", ignorenulls=True).over(w)).where("_side = 1").select("_row.*", "_told")
    n, one = F.col("_told._n"), F.col("reason").isNull() & fits & (F.col("_told._n") == 1)
    why = F.when(F.col("reason").isNotNull(), F.col("reason")).when(~fits, "class").when(n.isNull(), "symbol").when(n == 0, "tenure").when(n > 1, "ambiguous")
    return found.select(*[c for c in rows.columns if c != "reason"], F.when(one, F.col("_told._id")).alias("security_id"), why.alias("reason"))


def day_bars(files: DataFrame, tenures: DataFrame, first_known: DataFrame | None = None, era_start: str = "2024-01-01", cutoff: str | None = None, strict: bool = False) -> DataFrame:
    """day_rows with security_id and two more reasons.

    'cutoff' for files of that day or later, before anything else of a row is looked at; 'era' for rows that another source
    is known for: on or after both era_start and the security's day in first_known (security_id, first).
    """
    rows = day_rows(files if cutoff is None or not strict else files.where(F.col("day") < F.lit(cutoff).cast("date")), strict=strict)
    if cutoff is not None:
        rows = rows.withColumn("reason", F.when(F.col("day") >= F.lit(cutoff).cast("date"), "cutoff").otherwise(F.col("reason")))
    found = attributed(rows, tenures, "ticker", "day")
    if first_known is None:
        return found
    later = F.col("day") >= F.greatest("first", F.lit(era_start).cast("date"))
    return found.join(first_known.select("security_id", "first"), "security_id", "left").withColumn("reason", F.when(F.col("reason").isNull() & later, "era").otherwise(F.col("reason"))).select(*found.columns)


def loaded(rows: DataFrame) -> DataFrame:
    """(security_id, date, bars): what day_bars lets through; of several rows of a security and day the last file and line."""
    kept = rows.where("reason is null").withColumn("_archive", F.coalesce("archive", F.lit("")))
    return last_per_key(kept, ["security_id", "day"], ["_archive", "member", "n"]).select("security_id", F.col("day").alias("date"), *_BARS)


def _without_ghosts(marked: DataFrame, load: DataFrame, fingerprint: Sequence[str]) -> DataFrame:
    """marked, whose _own tells rows that are in load, without the ghosts among the others."""
    reach = load.agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    p = marked.withColumn("_touched", F.max("_own").over(Window.partitionBy("security_id"))).join(F.broadcast(reach))  # a single row
    bare = F.greatest(*[F.col(c).isNotNull() for c in fingerprint]) == F.lit(False)
    ghost = F.col("security_id").isNotNull() & F.col("_touched").isNotNull() & F.col("_own").isNull() & F.coalesce(F.col("date").between(F.col("_lo"), F.col("_hi")), F.lit(False)) & bare
    return p.where(~ghost).drop("_own", "_touched", "_lo", "_hi")


def without_remnants(prices: DataFrame, load: DataFrame, fingerprint: Sequence[str] = ("vwap", "trade_count")) -> DataFrame:
    """prices without the rows a load shows to be ghosts: of a security in it, inside its dates, without a row in it, and without any value that a real source gives."""
    reach = load.agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    ids = load.groupBy("security_id").agg(F.lit(True).alias("_touched"))
    own = load.select("security_id", "date").distinct().withColumn("_own", F.lit(True))
    p = prices.join(F.broadcast(reach)).join(ids, "security_id", "left").join(own, ["security_id", "date"], "left")  # reach is a single row
    bare = F.greatest(*[F.col(c).isNotNull() for c in fingerprint]) == F.lit(False)
    ghost = F.col("_touched").isNotNull() & F.col("_own").isNull() & F.coalesce(F.col("date").between(F.col("_lo"), F.col("_hi")), F.lit(False)) & bare
    return p.where(~ghost).select(*prices.columns)


def reloaded(prices: DataFrame, load: DataFrame, purge: bool = True) -> DataFrame:
    """prices(security_id, date, bars, vwap) after a load: its bars replace those there, vwap stays, ghosts go. Doing it again changes nothing."""
    keys = ["security_id", "date"]
    if not purge:
        return upsert(prices, load, keys, overwrite=_BARS)
    marked = upsert(prices.withColumn("_own", F.lit(None).cast("boolean")), load.withColumn("_own", F.lit(True)), keys, overwrite=(*_BARS, "_own"))
    return _without_ghosts(marked, load, ("vwap", "trade_count")).select(*prices.columns)


# Prices by volume


def vwap_tree(spark: SparkSession, main: str, gap: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """(symbol, date, vw, close, place) of a tree of year=/month= folders, place 0, and of one with what it lacks, place 1; other years aren't read."""
    trees = [(main, 0)] + ([(gap, 1)] if gap else [])
    read = None
    for path, place in trees:
        t = spark.read.parquet(path)
        t = t if years is None else t.where(F.col("year").between(*years))
        t = t.select("symbol", F.substring(F.col("date").cast("string"), 1, 10).try_cast("date").alias("date"), F.col("vw").cast("double").alias("vw"), F.col("close").cast(_PRICE).alias("close"), F.lit(place).alias("place"))
        read = t if read is None else read.unionByName(t)
    return read


def vwap_rows(tree: DataFrame, tenures: DataFrame, before: str = "2024-01-01") -> DataFrame:
    """tree with security_id and reason: 'later' for days of the live source, 'class', 'value' for what is no positive number, and those of attributed."""
    good = F.coalesce((F.col("vw") > 0) & (F.col("vw") < float("inf")) & ~F.isnan("vw"), F.lit(False))
    reason = F.when(F.coalesce(F.col("date") >= F.lit(before).cast("date"), F.lit(False)), "later").when(~F.coalesce(F.col("symbol").rlike(TICKER), F.lit(False)), "class").when(~good, "value")
    return attributed(tree.withColumn("reason", reason), tenures, "symbol", "date")


def vwap_buckets(staged: DataFrame, prices: DataFrame) -> DataFrame:
    """staged(security_id, date, vw, close, …) with bucket: 'missing' has no row, 'known' a vwap, 'bare' no source to trust, 'mismatch' another close; 'update' is the rest."""
    p = prices.select("security_id", "date", F.col("vwap").alias("_vwap"), F.col("trade_count").alias("_trades"), F.col("close").alias("_close"), F.lit(True).alias("_there"))
    bucket = F.when(F.col("_there").isNull(), "missing").when(F.col("_vwap").isNotNull(), "known").when(F.col("_trades").isNull(), "bare").when(F.col("_close") == F.col("close"), "update").when(F.col("_close") != F.col("close"), "mismatch")
    return staged.join(p, ["security_id", "date"], "left").select(*staged.columns, bucket.alias("bucket"))


def with_vwap(prices: DataFrame, staged: DataFrame) -> DataFrame:
    """prices with vwap where it was unknown, the row has trades, and a staged row has the same close; of several the least place, then the least value."""
    s = staged.groupBy("security_id", "date", F.col("close").alias("close")).agg(F.min(F.struct("place", "vw"))["vw"].alias("_vw"))
    fill = F.when(F.col("vwap").isNull() & F.col("trade_count").isNotNull(), F.col("_vw")).otherwise(F.col("vwap"))
    return prices.join(s, ["security_id", "date", "close"], "left").withColumn("vwap", fill).select(*prices.columns)


# Corporate actions


def _first(rows: DataFrame, keys: Sequence[str], known: DataFrame, ident: str) -> DataFrame:
    """rows with _first, whether the row is the one to keep of its keys: one that is stored already, else the least ident; equal idents are numbered.

    Only rows without a reason count. The choice is an aggregate joined back, so that a hot key isn't sorted in a task.
    """
    k = known.select(F.col(ident)).distinct().withColumn("_known", F.lit(True))
    r = rows.join(k, ident, "left").withColumn("_order", F.struct(F.col("_known").isNull().alias("new"), F.col(ident).alias("ident")))
    best = r.where("reason is null").groupBy(*keys).agg(F.min("_order").alias("_best"))
    return r.alias("a").join(best.alias("b"), _same(keys, "a", "b"), "left").select("a.*", F.col("b._best")).withColumn("_first", F.coalesce((F.col("_order") == F.col("_best")) & (F.col("_copy") == 1), F.lit(False))).drop("_known", "_order", "_best")


def _numbered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))


def dividends(archive: DataFrame, known: DataFrame) -> DataFrame:
    """archive(id, ticker, ex_date, pay_date, cash, currency) with reason: 'row' without id, day or positive amount, 'duplicate'.

    Texts are read as days and amounts; without a currency it is USD. Equal dividends (ticker, ex_date, cash, currency,
    pay_date) are one: that in known(id), else that of the least id. Different amounts of a day all stay.
    """
    text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    day = lambda c: F.substring(F.col(c).cast("string"), 1, 10).try_cast("date")
    rest = [c for c in archive.columns if c not in ("id", "ticker", "ex_date", "pay_date", "cash", "currency")]
    rows = archive.select(
        text("id").alias("id"), F.coalesce(F.col("ticker").cast("string"), F.lit("")).alias("ticker"), day("ex_date").alias("ex_date"), day("pay_date").alias("pay_date"),
        F.col("cash").cast("string").try_cast("decimal(28,10)").alias("cash"), F.upper(F.coalesce(text("currency"), F.lit("USD"))).alias("currency"), *rest,
    )
    bad = F.col("id").isNull() | F.col("ex_date").isNull() | ~F.coalesce(F.col("cash") > 0, F.lit(False))
    same = ["ticker", "ex_date", "cash", "currency", "pay_date"]
    chosen = _first(_numbered(rows.withColumn("reason", F.when(bad, "row")), [*same, "id"]), same, known, "id")
    return chosen.withColumn("reason", F.when(F.col("reason").isNull() & ~F.col("_first"), "duplicate").otherwise(F.col("reason"))).select(*rows.columns, "reason")


def splits(archive: DataFrame, known: DataFrame, allowed: DataFrame, extreme: float = 1000.0) -> DataFrame:
    """archive(id, ticker, ex_date, split_from, split_to, adjustment_type) with extreme and reason: 'row', 'spinoff', 'conflict', 'duplicate'.

    'row' lacks an id, a day or two positive legs. Ids that don't begin with E are spin-offs in the dress of splits, unless
    allowed(id, override) names them; its override then is their type. A ticker's splits of a day with different legs are
    in conflict: all go, or all but the one allowed; two allowed ones with different legs stop the job. Equal ones are one:
    that in known(id), else that of the least id. extreme marks ratios beyond that factor; they stay.
    """
    leg = lambda c: F.col(c).cast("string").try_cast("decimal(28,10)")
    ids = F.nullif(F.col("id").cast("string"), F.lit(""))
    rest = [c for c in archive.columns if c not in ("id", "ticker", "ex_date", "split_from", "split_to", "adjustment_type")]
    a = allowed.groupBy("id").agg(F.max("override").alias("_override"), F.lit(True).alias("_allowed"))
    rows = archive.select(
        ids.alias("id"), F.coalesce(F.col("ticker").cast("string"), F.lit("")).alias("ticker"), F.substring(F.col("ex_date").cast("string"), 1, 10).try_cast("date").alias("ex_date"),
        leg("split_from").alias("split_from"), leg("split_to").alias("split_to"), F.nullif(F.col("adjustment_type").cast("string"), F.lit("")).alias("adjustment_type"), *rest,
    ).join(a, "id", "left").withColumn("_allowed", F.coalesce("_allowed", F.lit(False)))
    bad = F.col("id").isNull() | F.col("ex_date").isNull() | ~F.coalesce(F.least("split_from", "split_to") > 0, F.lit(False)) | F.col("split_from").isNull() | F.col("split_to").isNull()
    regular = F.col("id").startswith("E")
    rows = rows.withColumn("reason", F.when(bad, "row").when(~regular & ~F.col("_allowed"), "spinoff"))
    rows = rows.withColumn("adjustment_type", F.when(~regular & F.col("_allowed"), F.coalesce("_override", "adjustment_type")).otherwise(F.col("adjustment_type")))
    legs, day = F.struct("split_from", "split_to"), ["ticker", "ex_date"]
    mine = F.when(F.col("_allowed"), legs)
    told = rows.where("reason is null").groupBy(*day).agg(F.min(legs).alias("_lo"), F.max(legs).alias("_hi"), F.min(mine).alias("_mine"), F.max(mine).alias("_most"))
    torn = F.col("_lo") != F.col("_hi")
    both = rows.join(told, day, "left").withColumn("_torn", F.coalesce(torn, F.lit(False)))
    clash = F.col("reason").isNull() & F.col("_torn") & (F.col("_mine") != F.col("_most"))
    out = F.when(clash, F.raise_error(F.concat(F.lit("allowed splits contradict each other: "), "ticker"))).when(F.col("reason").isNull() & F.col("_torn") & ~F.col("_allowed"), "conflict").otherwise(F.col("reason"))
    left = _numbered(both.withColumn("reason", out), [*day, "id", "split_from", "split_to"])
    chosen = _first(left, day, known, "id")
    a, b = F.col("split_from").cast("double"), F.col("split_to").cast("double")
    lost = F.when(F.col("_torn"), "conflict").otherwise("duplicate")
    columns = [c for c in rows.columns if c not in ("_override", "_allowed", "reason")]
    reason = F.when(F.col("reason").isNull() & ~F.col("_first"), lost).otherwise(F.col("reason"))
    return chosen.select(*columns, F.coalesce(F.col("reason").isNull() & ((b > extreme * a) | (a > extreme * b)), F.lit(False)).alias("extreme"), reason.alias("reason"))


def ticker_changes(archive: DataFrame, epoch: str = "1969-12-31", keep: Sequence[str] = ()) -> DataFrame:
    """(keep, queried, cik, figi, date, ticker, reason) of events; reasons: 'kind' is no change of ticker, 'row' lacks a ticker or a day, 'epoch' has the day that stands for none.

    The ticker is the event's, or that in its payload. Tickers are in small letters, ciks without zeros before them.
    """
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    payload = F.try_parse_json(F.col("event_payload"))
    ticker = F.lower(F.coalesce(text(F.col("ticker_at_event")), text(F.try_variant_get(payload, "$.ticker_change.ticker", "string"))))
    rows = archive.select(
        *keep, F.lower(text(F.col("queried_ticker"))).alias("queried"), F.nullif(F.ltrim(text(F.col("cik")), F.lit("0")), F.lit("")).alias("cik"), F.upper(text(F.col("composite_figi"))).alias("figi"),
        F.substring(F.col("event_date").cast("string"), 1, 10).try_cast("date").alias("date"), ticker.alias("ticker"), text(F.col("event_type")).alias("_kind"),
    )
    reason = F.when(~F.col("_kind").eqNullSafe("ticker_change"), "kind").when(F.col("ticker").isNull() | F.col("date").isNull(), "row").when(F.col("date") == F.lit(epoch).cast("date"), "epoch")
    return rows.withColumn("reason", reason).drop("_kind")
