"""Parsing of published reports."""

from datetime import date

import pytest

from quotewright.sources.reports import parse_reports, read_reports, refuse_unparsed
from tests.synthetic import report_text

SOURCES = (("yfinance", "yfinance"), ("tiingo", "Tiingo"))


def _parse(spark, *texts):
    df = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "report string, text string")
    return parse_reports(df, *SOURCES)


def test_headline_and_ticker_rows(spark):
    text = report_text(4210, 87, 990, 31, 3, 12, (("Q", 70), ("AB.C", 16), ("X-Y", 1)))
    parsed = _parse(spark, text)
    refuse_unparsed(parsed)
    h = parsed.headline.first()
    assert h.report_ingest_date == date(2022, 8, 3)
    assert (h.compared_pairs, h.flagged_pairs, h.only_yfinance, h.only_tiingo) == (4210, 87, 990, 31)
    assert (h.tickers_affected, h.tickers_compared) == (3, 12)
    rows = {r.ticker: r for r in parsed.entities.collect()}
    assert {t: r.flagged for t, r in rows.items()} == {"Q": 70, "AB.C": 16, "X-Y": 1}
    assert (rows["Q"].first_flagged, rows["Q"].last_flagged) == (date(2022, 5, 13), date(2022, 7, 27))


@pytest.mark.parametrize("brk", ["\r\n", "\r", "\u2028"])
def test_line_breaks(spark, brk):
    parsed = _parse(spark, report_text().replace("\n", brk))
    assert parsed.rejects.isEmpty() and parsed.entities.count() == 1


def test_rejects_name_the_reason_and_keep_the_others(spark):
    parsed = _parse(
        spark,
        "ingest_date=2022-08-03\nnothing else",
        report_text().replace("Affected tickers", "Affected names"),
        report_text(affected=2),
        report_text().replace("2022-08-03", "2022-13-03"),
        report_text(compared="99999999999999999999"),
        report_text(),
    )
    reasons = {r.report: r.reason for r in parsed.rejects.collect()}
    assert reasons == {
        "r0": "could not find 'compared_pairs'",
        "r1": "could not find 'tickers_affected'",
        "r2": "parsed 1 ticker rows but the header says 2 tickers affected",
        "r3": "could not find 'report_ingest_date'",
        "r4": "could not find 'compared_pairs'",
    }
    assert [r.report for r in parsed.headline.collect()] == ["r5"]
    with pytest.raises(ValueError, match="could not find"):
        refuse_unparsed(parsed)


def test_reading_a_folder(spark, tmp_path):
    for i, affected in enumerate((1, 1)):
        (tmp_path / f"report_{i}.txt").write_text(report_text(compared=100 + i), encoding="utf-8")
    parsed = parse_reports(read_reports(spark, str(tmp_path)), *SOURCES)
    assert sorted(r.compared_pairs for r in parsed.headline.collect()) == [100, 101]
    assert parsed.entities.count() == 2


def test_report_without_affected_tickers(spark):
    parsed = _parse(spark, report_text(flagged=0, affected=0, rows=()))
    assert parsed.rejects.isEmpty() and parsed.entities.isEmpty()
    assert parsed.headline.first().tickers_affected == 0
