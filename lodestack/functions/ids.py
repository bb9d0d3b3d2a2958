"""Identifiers and kinds of documents and files, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text_of

UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def stable_id(url: Column) -> Column:
    return F.substring(F.sha1(text_of(url)), 1, 16)


def safe_file_name(url: Column) -> Column:
    base = F.substring_index(F.regexp_extract(url, r"^[^?#]*", 0), "/", -1)
    return F.concat(F.substring(F.sha1(url), 1, 10), F.lit("_"), F.when(base == "", "file").otherwise(base))


def id_type(c: Column) -> Column:
    v = strip(text_of(c))
    return (
        F.when(v == "", "unknown")
        .when(v.rlike(f"^{UUID}$"), "uuid")
        .when(v.rlike(r"^\p{Nd}+$"), "numeric")
        .when(v.rlike("^[A-Za-z][A-Za-z0-9_-]*$"), "slug")
        .otherwise("unknown")
    )


def document_id(url: Column, path: str = "/van-ban/chi-tiet/", keys: tuple[str, ...] = ("ItemID", "itemid", "id")) -> Column:
    """From the path, else from the query, else the first UUID, else ""."""
    u = strip(text_of(url))
    filled = lambda c: F.when(c != "", c)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    found = [strip(F.try_url_decode(F.regexp_extract(query, rf"(?:^|&){k}=([^&]*)", 1))) for k in keys]
    return F.coalesce(filled(strip(F.regexp_extract(u, rf"(?i){path}([^/?#]+)", 1))), *map(filled, found), F.regexp_extract(u, UUID, 0))


def attachment_type(name: Column) -> Column:
    low = F.lower(text_of(name))
    found = F.regexp_extract(low, r"\.(pdf|doc|docx|rtf|html|json)$", 1)
    return F.when(found == "", "other").otherwise(found)


#: Kinds of file links in the order in which they are looked for anywhere in the url.
URL_KINDS = ("pdf", "docx", "doc", "html", "json")


def url_kind(url: Column) -> Column:
    low = F.lower(url)
    return F.coalesce(*(F.when(F.contains(low, F.lit(f".{k}")), F.lit(k)) for k in URL_KINDS))


def classified(urls: Column) -> dict[str, Column]:
    """An array for each kind; urls of no kind are in none."""

    def of(kind: str) -> Column:
        return F.filter(urls, lambda u: F.coalesce(url_kind(u) == kind, F.lit(False)))

    return {f"{'json_snapshot' if k == 'json' else k}_urls": of(k) for k in URL_KINDS}


def all_urls(attachments: Column, urls: Column) -> Column:
    """Urls of attachments, then others, stripped, non-blank, once each."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(F.transform(attachments, lambda a: a["url"]), empty), F.coalesce(urls, empty))
    return F.array_distinct(F.filter(F.transform(both, lambda u: strip(text_of(u))), lambda u: u != ""))


#: Relation codes of documents. Fixed values.
RELATIONS = {
    1: "abrogates",
    2: "translation",
    3: "basis",
    4: "referenced_by",
    5: "suspends_execution",
    6: "corrects",
    7: "consolidates",
    8: "guides_application",
    9: "detail_guiding_regulation",
    10: "amends_supplements",
    11: "temporarily_suspends_effect",
    12: "replaces",
    13: "supplements",
    14: "explains",
    15: "referenced_text",
}


def relation_type(c: Column) -> Column:
    names = F.create_map(*(F.lit(x) for kv in RELATIONS.items() for x in kv))
    raw = strip(text_of(c))
    number = F.when(raw.rlike(r"^[+-]?\d+$"), raw.try_cast("int"))
    named = F.coalesce(F.try_element_at(names, number), F.concat(F.lit("unknown_"), number.cast("string")))
    return F.coalesce(named, F.when(raw != "", raw), F.lit("unknown"))
