"""How listings ended: what deal texts of a security agree on, who the acquirer is, and rules that decide on the evidence."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import deals
from tidemark.functions.text import per_share_cash

# What a rule of removal stands for, forms whose terms are in a section of their own, borders of cash against
# the last price, borders of a return, and the price under which a bankruptcy is believed.
RULE_REASONS = {"a": "MERGER", "a1": "LIQUIDATION", "a2": "LIQUIDATION", "a3": "MERGER", "a4": "MERGER", "b": "EXCHANGE_DROP", "c": "VOLUNTARY"}
PROXIES = ("DEFM14A", "SC 14D9", "PREM14A", "DEFM14C", "DEF 14A")
CASH_LIMITS = (0.2, 5.0)
RETURN_LIMITS = (0.6, 1.5)
WORTHLESS = 0.1


def near(filings: DataFrame, cases: DataFrame, key: str, filed: str, until: str, **kinds: tuple[Column, int, int]) -> DataFrame:
    """cases with a flag for each kind: whether a filing of that condition was made from so many days before until to so many after.

    Filings meet the cases of their key; a key has few cases, so nothing is multiplied but by these.
    """
    gap = F.datediff(F.col(filed), F.col("_until"))
    c = cases.select(key, F.col(until).alias("_until")).distinct()
    hit = filings.join(c, key).groupBy(key, "_until").agg(*[F.bool_or(cond & gap.between(-before, after)).alias(name) for name, (cond, before, after) in kinds.items()])
    found = cases.join(hit, (cases[key] == hit[key]) & (cases[until] == hit["_until"]), "left").select(*[cases[c] for c in cases.columns], *kinds)
    return found.withColumns({name: F.coalesce(name, F.lit(False)) for name in kinds})


def consideration(docs: DataFrame, key: str, form: str, text: str) -> DataFrame:
    """(key, cash, ratio, acquirer, election, note): what the texts of a key agree on; nothing where they don't.

    cash is the amount per share found most often, if no other is found as often; ratio and acquirer are those that all
    texts have in common. A name in a ratio's sentence is asked for only where no other is found. Terms of proxies are
    read in the section that has them, if there is one. Holders elect where a text with terms says so.
    """
    section = F.when(F.upper(form).isin(*PROXIES), deals.consideration_section(F.col(text)))
    read = docs.select(key, F.col(text).alias("_text"), F.coalesce(section, F.col(text)).alias("_terms"), section.isNotNull().alias("_found"))
    read = read.select(key, "_found", per_share_cash(F.col("_terms")).alias("amounts"), deals.stock_ratios(F.col("_terms")).alias("ratios"), deals.acquirers(F.col("_text")).alias("names"), deals.elects(F.col("_terms")).alias("elects"))
    chosen = F.col("elects") & (F.col("_found") | (F.size("amounts") > 0) | (F.size("ratios") > 0))
    row = lambda kind, number=None, name=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None) if number is None else number).cast("double").alias("number"), (F.lit(None) if name is None else name).cast("string").alias("name"))
    found = F.concat(
        F.array(F.when(chosen, row("election")).otherwise(row("text"))),
        F.transform("amounts", lambda x: row("cash", x)),
        F.transform("ratios", lambda x: row("ratio", x["ratio"], x["company"])),
        F.transform("names", lambda x: row("name", None, x)),
    )
    times = read.select(key, F.explode(found).alias("t")).groupBy(key, "t").agg(F.count("*").alias("n")).select(key, "t.*", "n")
    of = lambda kind, x: F.when(F.col("kind") == kind, x)
    # the most frequent amount, ties broken up and down: both ways give one only if there is one
    most, least = (F.max(of("cash", F.struct("n", (sign * F.col("number")).alias("x"))))["x"] * sign for sign in (1, -1))
    same = F.regexp_replace(F.lower("name"), r"\.+$", "")
    one, two = F.min(of("ratio", F.col("number"))), F.max(of("ratio", F.col("number")))
    names = {to: (F.min(of(kind, F.col("name"))), F.min(of(kind, same)), F.max(of(kind, same))) for kind, to in (("name", "bought_by"), ("ratio", "priced_in"))}
    terms = times.groupBy(key).agg(
        F.when(most == least, most).alias("cash"), (most != least).alias("_cash"), F.when(one == two, one).alias("ratio"), (one != two).alias("_ratio"),
        *[F.when(a == b, name).alias(to) for to, (name, a, b) in names.items()], *[(a != b).alias(f"_{to}") for to, (_, a, b) in names.items()],
        F.bool_or(F.col("kind") == "election").alias("election"),
    )
    notes = [F.when(F.col(c), text) for c, text in (("_cash", "several amounts"), ("_ratio", "several ratios"), ("_bought_by", "several acquirers"), ("_priced_in", "several acquirers of ratios"), ("election", "election"))]
    return terms.select(key, "cash", "ratio", F.coalesce("priced_in", "bought_by").alias("priced_by"), F.coalesce("bought_by", "priced_in").alias("acquirer"), "election", F.concat_ws("; ", *notes).alias("note"))


def named_security(names: DataFrame, name: str, securities: DataFrame, ident: str, of: str) -> DataFrame:
    """names with acquirer_id, the only security whose name has the same key, and candidates, the number of those that have."""
    known = securities.select(deals.company_key(F.col(of)).alias("_key"), F.col(ident).alias("_id")).groupBy("_key").agg(F.min("_id").alias("_id"), F.countDistinct("_id").alias("candidates"))
    found = names.withColumn("_key", F.nullif(deals.company_key(F.col(name)), F.lit(""))).join(known, "_key", "left")
    return found.withColumn("acquirer_id", F.when(F.col("candidates") == 1, F.col("_id"))).withColumn("candidates", F.coalesce("candidates", F.lit(0))).drop("_key", "_id")


def decided(cases: DataFrame, digits: int | None = 8) -> DataFrame:
    """cases with reason, confidence, source and delisting_return, by the first rule whose evidence is there.

    cases has kind (ETF or other), the flags form25, item_201, item_103, item_301 and merged, rule, pattern (a reason told
    from prices, or null), cash, ratio, election, acquirer_close and final_price. A completed merger comes before a rule of
    removal, that before a merged identity, a closed fund, a notice by the exchange and the pattern of prices. A return is
    told for a bankruptcy with its three proofs, and for deals of high confidence from cash, or shares at the acquirer's
    price where holders don't elect; one beyond RETURN_LIMITS isn't, and out_of_limits says so. Flags that are null are false.
    Returns are rounded to digits; None is for callers that round themselves, since rounding twice can end elsewhere.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    fund = F.coalesce(F.upper("kind") == "ETF", F.lit(False))
    removed = yes("form25") & F.col("rule").isin(*RULE_REASONS)
    stated = F.coalesce(*[F.when(F.col("rule") == r, reason) for r, reason in RULE_REASONS.items()])
    bankrupt = removed & ~yes("item_201") & (F.col("rule") == "b") & ~fund & F.coalesce(F.col("final_price") < WORTHLESS, F.lit(False)) & yes("item_103")
    in_cash, in_stock = F.col("cash").isNotNull() & F.col("ratio").isNull(), F.col("ratio").isNotNull() & F.col("cash").isNull()
    deal = F.when(in_cash, "ACQUISITION_CASH").when(in_stock, "ACQUISITION_STOCK").otherwise("MERGER")
    by_form = F.when(yes("form25"), "FORM25")
    rules = [
        (yes("item_201"), deal, "HIGH", F.coalesce(by_form, F.lit("8K"))),
        (removed & fund & F.col("rule").isin("a1", "c"), F.lit("FUND_CLOSURE"), "HIGH", F.lit("FORM25")),
        (bankrupt, F.lit("BANKRUPTCY"), "HIGH", F.lit("FORM25")),
        (removed & (stated == "MERGER"), deal, "HIGH", F.lit("FORM25")),
        (removed, stated, "HIGH", F.lit("FORM25")),
        (yes("merged"), F.lit("MERGER"), "MEDIUM", F.lit("TICKER_EVENT")),
        (fund, F.lit("FUND_CLOSURE"), "MEDIUM", F.lit("TICKER_EVENT")),
        (yes("item_301"), F.lit("EXCHANGE_DROP"), "MEDIUM", F.lit("8K")),
        (F.col("pattern").isNotNull(), F.col("pattern"), "LOW", F.lit("PRICE_INFERRED")),
        (F.lit(True), F.lit("UNKNOWN"), None, by_form),
    ]
    verdict = F.coalesce(*[F.when(cond, F.struct(reason.alias("reason"), F.lit(confidence).cast("string").alias("confidence"), source.alias("source"))) for cond, reason, confidence, source in rules])
    out = cases.withColumn("_v", verdict)
    deals_only = out["_v.reason"].isin("MERGER", "ACQUISITION_CASH", "ACQUISITION_STOCK") & (out["_v.confidence"] == "HIGH") & (F.col("final_price") > 0)
    by_shares = F.when(F.col("ratio").isNotNull() & ~yes("election"), F.col("ratio") * F.col("acquirer_close") + F.coalesce("cash", F.lit(0.0)))
    worth = F.when(deals_only, F.when(in_cash, F.col("cash")).otherwise(by_shares))
    good = worth.between(*(_times(x, F.col("final_price")) for x in RETURN_LIMITS))
    exact = (worth - F.col("final_price")) / F.col("final_price")
    told = F.when(out["_v.reason"] == "BANKRUPTCY", -1.0).when(good, exact if digits is None else F.round(exact, digits))
    return out.select(*cases.columns, "_v.*", told.alias("delisting_return"), F.coalesce(~good, F.lit(False)).alias("out_of_limits"))


def believable_cash(cash: Column, ratio: Column, final_price: Column) -> Column:
    """cash, or null where it stands alone and is beyond CASH_LIMITS of the last price; without a positive price nothing is held against it."""
    low, high = (_times(x, final_price) for x in CASH_LIMITS)
    return F.when(ratio.isNotNull() | F.coalesce(final_price <= 0, F.lit(True)) | cash.between(low, high), cash)


def _times(share: float, price: Column) -> Column:
    """share of a price, multiplied as decimals: of 23, 0.6 is 13.8, where doubles give a number just below. A price of more than 12 decimals is multiplied as it is."""
    exact = price.cast("double").try_cast("decimal(30,12)")
    return F.when(exact.cast("double") == price, (exact * F.lit(Decimal(str(share)))).cast("double")).otherwise(share * price)
