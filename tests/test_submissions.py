"""Whole submissions of holdings: cover, table, header, and what is broken in them."""

from datetime import date
from decimal import Decimal

from tidemark.sources import feeds

COVER = """<XML>
<?xml version="1.0" encoding="UTF-8"?>
<edgarSubmission xmlns="http://www.sec.gov/edgar/thirteenffiler" xmlns:com="http://www.sec.gov/edgar/common">
  <headerData><submissionType>13F-HR</submissionType>
    <filerInfo><filer><credentials><cik>0001779506</cik><ccc>XXXX</ccc></credentials></filer><periodOfReport>12-31-2025</periodOfReport></filerInfo>
  </headerData>
  <formData><coverPage><reportCalendarOrQuarter>12-31-2025</reportCalendarOrQuarter><filingManager><name>Brandywine Financial Group</name></filingManager>
    <form13FFileNumber>028-27015</form13FFileNumber></coverPage></formData>
</edgarSubmission>
</XML>
"""
ENTRY = """<ns1:infoTable>
  <ns1:nameOfIssuer>%s</ns1:nameOfIssuer><ns1:titleOfClass>COM</ns1:titleOfClass><ns1:cusip>%s</ns1:cusip><ns1:value>%s</ns1:value>
  <ns1:shrsOrPrnAmt><ns1:sshPrnamt>10</ns1:sshPrnamt><ns1:sshPrnamtType>SH</ns1:sshPrnamtType></ns1:shrsOrPrnAmt>%s
  <ns1:investmentDiscretion>SOLE</ns1:investmentDiscretion><ns1:votingAuthority><ns1:Sole>0</ns1:Sole><ns1:Shared>0</ns1:Shared><ns1:None>10</ns1:None></ns1:votingAuthority>
</ns1:infoTable>
"""
APPLE, PUTS = ENTRY % ("APPLE INC", "037833100", "1864", ""), ENTRY % ("SPY &amp; PUTS", "78462F103", "n/a", "<ns1:putCall>Put</ns1:putCall>")
HEAD = "<SEC-HEADER>\nACCESSION NUMBER:\t\t0001779506-26-000002\nCONFORMED SUBMISSION TYPE:\t13F-HR\n%s</SEC-HEADER>\n"
MORE = "CONFORMED PERIOD OF REPORT:\t%s\nCENTRAL INDEX KEY:\t\t\t1779506\n"


def table(*entries):
    return '<XML>\n<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<ns1:informationTable xmlns:ns1="http://www.sec.gov/t">\n' + "".join(entries) + "</ns1:informationTable>\n</XML>\n"


BROKEN = COVER.replace("</edgarSubmission>", "</edgarSubmissionX>")
WHOLE = HEAD % "" + COVER + table(APPLE, PUTS)


def read(spark, text, filed=date(2026, 2, 1)):
    df = spark.createDataFrame([("acc", filed, text)], "accession string, filed date, text string")
    return feeds.holdings_reports(df, "accession", "filed").orderBy("n").collect()


def test_cover_and_holdings(spark):
    apple, puts = read(spark, WHOLE)
    assert (apple.filer_cik, apple.filer_name, apple.form_type, apple.period, apple.file_number) == ("0001779506", "Brandywine Financial Group", "13F-HR", date(2025, 12, 31), "028-27015")
    assert (apple.n, apple.issuer_name, apple.title_of_class, apple.cusip, apple.market_value, apple.amount, apple.amount_type, apple.put_call, apple.discretion, apple.voting_none) == (0, "APPLE INC", "COM", "037833100", Decimal("1864"), Decimal("10"), "SH", None, "SOLE", Decimal("10"))
    assert (puts.n, puts.issuer_name, puts.put_call, puts.market_value, puts.value_usd) == (1, "SPY & PUTS", "Put", None, None)
    assert apple.row_hash != puts.row_hash and [r.row_hash for r in read(spark, WHOLE)] == [apple.row_hash, puts.row_hash]


def test_equal_holdings_are_rows_of_their_own(spark):
    rows = read(spark, HEAD % "" + COVER + table(APPLE, APPLE))
    assert len(rows) == 2 and len({r.row_hash for r in rows}) == 2
    assert len(read(spark, HEAD % "" + COVER + table(APPLE))) == 1


def test_header_where_the_cover_is_broken(spark):
    told = [read(spark, HEAD % (MORE % "20251231") + cover + table(APPLE))[0] for cover in (BROKEN, "")]
    assert {(r.filer_cik, r.form_type, r.period, r.filer_name) for r in told} == {("0001779506", "13F-HR", date(2025, 12, 31), None)}
    bare = read(spark, HEAD % "" + BROKEN + table(APPLE))[0]
    assert (bare.period, bare.filer_cik, bare.form_type) == (None, None, "13F-HR")
    assert read(spark, HEAD % (MORE % "20240630") + COVER + table(APPLE))[0].period == date(2025, 12, 31)


def test_submissions_without_holdings(spark):
    for text in (HEAD % "" + COVER, HEAD % "" + COVER + table(), HEAD % "" + COVER + table(APPLE).replace("</ns1:informationTable>", ""), "", None):
        assert read(spark, text) == []


def test_scale_of_values_by_date(spark):
    assert [read(spark, WHOLE, d)[0].value_usd for d in (date(2023, 1, 2), date(2023, 1, 3))] == [Decimal("1864000"), Decimal("1864")]
    assert read(spark, WHOLE, None)[0].value_usd == Decimal("1864")


def test_codes_of_one_security(spark):
    held = spark.createDataFrame([(c,) for c in ("037833100", "78462F103", "594918104", "x", None)], "cusip string")
    codes = spark.createDataFrame([("037833100", 1), ("78462f103", 2), ("78462F103", 3), ("594918104", 7), ("594918104", 7), (None, 9)], "cusip string, security_id long")
    assert {r.cusip: r.security_id for r in feeds.linked(held, codes, "cusip", "security_id").collect()} == {"037833100": 1, "78462F103": None, "594918104": 7, "x": None, None: None}


def test_texts_are_read_once(spark):
    """Neither a second reading of a text for another document nor a filter on its table below, in a join's condition."""
    df = spark.createDataFrame([(1, date(2023, 5, 1), "<XML> a </XML>")], "accession long, filed date, text string").join(spark.range(3).withColumnRenamed("id", "accession"), "accession")
    plan = feeds.holdings_reports(df, "accession", "filed")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 2 and plan.count("</XML>") == 1
