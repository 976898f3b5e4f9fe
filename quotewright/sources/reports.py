"""Published reconciliation reports (plain text) as control figures."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The layout of the published text. Figure name to the pattern whose
# group holds it; {a} and {b} stand for the sources as the report spells them.
HEADLINE = {
    "report_ingest_date": r"ingest_date=(\d{4}-\d{2}-\d{2})",
    "compared_pairs": r"Compared:\s+(\d+)\s+\(ticker, date\) pairs",
    "flagged_pairs": r"Flagged \(> [\d.]+% adj_close discrepancy\):\s+(\d+)\s+\(",
    "only_a": r"Present only in {a} \([^)]*\):\s+(\d+)",
    "only_b": r"Present only in {b} \([^)]*\):\s+(\d+)",
    "tickers_affected": r"Affected tickers:\s+(\d+) of (\d+) compared",
    "tickers_compared": r"Affected tickers:\s+(\d+) of (\d+) compared",
}
_GROUP = {"tickers_compared": 2}  # the group that holds a figure, 1 for the others
# Fixed value: a row of the ticker table; groups are ticker, flagged, compared,
# first and last flagged date.
TICKER_ROW = (
    r"^\s+([A-Z0-9.\-]+)\s+(\d+)\s+(\d+)\s+[\d.]+%\s+[\d.]+%\s+[\d.]+%\s+"
    r"(\d{4}-\d{2}-\d{2}) to (\d{4}-\d{2}-\d{2})\s*$"
)
_ROW_TYPES = {
    "ticker": "string", "flagged": "bigint", "compared": "bigint", "first_flagged": "date", "last_flagged": "date",
}
_LINE_BREAK = r"\R|[\x1c-\x1e]"


@dataclass(frozen=True)
class ParsedReports:
    headline: DataFrame
    entities: DataFrame
    rejects: DataFrame


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(report, text): one row per file of a path, glob or folder."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("report"), F.col("value").alias("text")
    )


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def parse_reports(texts: DataFrame, a: tuple[str, str], b: tuple[str, str]) -> ParsedReports:
    """Headline and ticker rows of each (report, text).

    ``a`` and ``b`` are (source name, name printed in the report). A report that
    lacks a figure, or whose ticker rows do not add up to its header, goes to
    ``rejects`` with the reason and to nothing else.
    """
    names = {"only_a": f"only_{a[0]}", "only_b": f"only_{b[0]}"}
    text = F.col("text")
    figures = {}
    for figure, pattern in HEADLINE.items():
        raw = _found(text, pattern.replace("{a}", a[1]).replace("{b}", b[1]), _GROUP.get(figure, 1))
        typed = (
            F.try_to_date(raw, "yyyy-MM-dd")
            if figure == "report_ingest_date"
            else raw.try_cast("int" if figure.startswith("tickers") else "bigint")
        )
        figures[names.get(figure, figure)] = typed

    lines = F.filter(F.split(text, _LINE_BREAK), lambda line: line.rlike(TICKER_ROW))
    rows = F.transform(lines, _ticker_row)
    parsed = texts.select("report", *[c.alias(n) for n, c in figures.items()], rows.alias("rows"))
    parsed = parsed.withColumn("reason", _reason(list(figures)))
    good = parsed.where("reason is null")
    entities = good.select("report", "report_ingest_date", F.explode("rows").alias("row")).select(
        "report", "report_ingest_date", *[f"row.{c}" for c in _ROW_TYPES]
    )
    return ParsedReports(
        headline=good.select("report", *figures),
        entities=entities,
        rejects=parsed.where("reason is not null").select("report", "reason"),
    )


def _ticker_row(line: Column) -> Column:
    """The typed fields of a ticker row; NULL where a number or date is impossible."""
    fields = [
        _found(line, TICKER_ROW, i + 1).try_cast(kind).alias(name) for i, (name, kind) in enumerate(_ROW_TYPES.items())
    ]
    return F.struct(*fields)


def _reason(figures: list[str]) -> Column:
    reason = F.when(F.lit(False), "")
    for f in figures:
        reason = reason.when(F.col(f).isNull(), f"could not find '{f}'")
    miscounted = F.size("rows") != F.col("tickers_affected")
    message = F.format_string(
        "parsed %d ticker rows but the header says %d tickers affected",
        F.size("rows"),
        F.col("tickers_affected"),
    )
    broken = F.filter("rows", lambda r: reduce(or_, (r[c].isNull() for c in _ROW_TYPES)))
    impossible = F.format_string("impossible figure in the row of '%s'", F.get(broken["ticker"], F.lit(0)))
    return reason.when(miscounted, message).when(F.size(broken) > 0, impossible)


def refuse_unparsed(parsed: ParsedReports) -> None:
    """Raise when any report was rejected; names a few of them."""
    some = parsed.rejects.limit(5).collect()
    if some:
        raise ValueError("; ".join(f"{r['report']}: {r['reason']}" for r in some))


def only_date(parsed: ParsedReports) -> date:
    """The date of the one report; raises unless there is exactly one."""
    days = parsed.headline.select("report_ingest_date").limit(2).collect()
    if len(days) != 1:
        raise ValueError("a run takes exactly one report")
    return days[0][0]
