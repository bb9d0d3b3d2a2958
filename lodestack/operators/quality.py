"""Quality scores and flags of document records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, strip, text_of

#: Titles that say nothing, in lower case. Fixed values.
GENERIC_TITLES = (
    "văn bản pháp luật",
    "van ban phap luat",
    "văn bản pháp luật | cơ sở dữ liệu quốc gia về pháp luật",
    "van ban phap luat | co so du lieu quoc gia ve phap luat",
)
#: Least content lengths and their points, longest first. Fixed values.
LENGTH_POINTS = ((1500, 45), (800, 35), (300, 25), (120, 15))


def filled(c: Column) -> Column:
    return strip(text_of(c)) != ""


def meaningful_title(title: Column, generic: Sequence[str] = GENERIC_TITLES) -> Column:
    t = F.lower(collapse(text_of(title)))
    return (t != "") & ~t.isin(list(generic))


def quality_score(title: Column, kind: Column, number: Column, date: Column, agency: Column, url: Column, content: Column) -> Column:
    """0 to 100: a meaningful title 15, kind, number and date 10 each, agency and url 5 each, and points for length."""
    points = [(meaningful_title(title), 15), *((filled(c), 10) for c in (kind, number, date)), *((filled(c), 5) for c in (agency, url))]
    n = F.length(text_of(content))
    length = F.coalesce(*(F.when(n >= least, F.lit(p)) for least, p in LENGTH_POINTS), F.lit(0))
    return F.least(sum((F.when(test, p).otherwise(0) for test, p in points), length), F.lit(100))


def quality_flags(title: Column, kind: Column, number: Column, date: Column, content: Column, short: int = 200) -> Column:
    tests = {
        "generic_title": ~meaningful_title(title),
        "missing_document_type": ~filled(kind),
        "missing_document_number": ~filled(number),
        "missing_issued_date": ~filled(date),
        "short_content": F.length(text_of(content)) < short,
    }
    return F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))


def required_missing(columns: Sequence[str]) -> Column:
    """Some required column is blank."""
    return ~F.forall(F.array(*(filled(F.col(c)) for c in columns)), lambda x: x)


def summary(records: DataFrame, content: str, score: str, urls: dict[str, str], chunks: str | None = None) -> DataFrame:
    """One row: records, those with content, with each kind of url (arrays) and with chunks, chunks in all, the average
    score (0 without records) and those below 40. One pass, combined before the shuffle."""
    has = lambda c: F.count_if(F.size(c) > 0)
    n = F.coalesce(F.col(chunks), F.lit(0)) if chunks else F.lit(0)
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(filled(F.col(content))).alias("with_content"),
        *(has(c).alias(f"with_{k}") for k, c in urls.items()),
        F.count_if(n > 0).alias("with_chunks"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("chunks"),
        F.round(F.coalesce(F.avg(score), F.lit(0.0)), 2).alias("average_score"),
        F.count_if(F.col(score) < 40).alias("low_score"),
    )


def warnings(records: DataFrame, key: str, content: str, short: int = 200, line: str | None = None) -> DataFrame:
    """key, warning (empty_content or short_content) and length of records with little content, and, given the column that
    has it (see jsonl.scan), the number of the line that they come from."""
    n = F.length(strip(text_of(F.col(content))))
    where = [F.col(line).alias("line")] if line else []
    few = records.select(key, n.alias("length"), *where).where(F.col("length") < short)
    return few.select(key, F.when(F.col("length") == 0, "empty_content").otherwise("short_content").alias("warning"), "length", *(["line"] if line else []))
