"""Topic matching against a taxonomy given as data; no shuffle, and one pass over a text for all keywords."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_for_match, strip, text_of
from .corpus import unused


@dataclass(frozen=True)
class Topic:
    slug: str
    name: str
    keywords: tuple[str, ...]


def normalized(text: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").replace("Đ", "D").replace("đ", "d")
    return " ".join(plain.lower().split())


def distinct_keywords(keywords: Iterable[str]) -> list[str]:
    """Non-blank keywords, the first spelling of each normalised form."""
    out: dict[str, str] = {}
    for k in map(str.strip, keywords):
        if k:
            out.setdefault(normalized(k), k)
    return list(out.values())


def resolve(values: Iterable[str], topics: Sequence[Topic]) -> list[str]:
    """Slugs of topics given by slug or name; unknown ones raise an error that lists the choices."""
    known = {normalized(t.name): t.slug for t in topics} | {t.slug: t.slug for t in topics}
    wanted = [v.strip() for v in values if v.strip()]
    missing = [v for v in wanted if v not in known and normalized(v) not in known]
    if missing:
        raise ValueError(f"unknown topics: {', '.join(missing)}; choices: {', '.join(t.slug for t in topics)}")
    return list(dict.fromkeys(known.get(v) or known[normalized(v)] for v in wanted))


def selected(topics: Sequence[Topic], slugs: Iterable[str] = (), extra: Iterable[str] = (), extra_name: str = "Custom") -> list[Topic]:
    """The topics with these slugs, all if there are none, and further keywords as topic "custom"."""
    slugs, extra = set(slugs), tuple(extra)
    return [t for t in topics if not slugs or t.slug in slugs] + ([Topic("custom", extra_name, extra)] if extra else [])


def is_code(keyword: str) -> bool:
    """A normalised keyword of up to four characters, which counts as a whole word only."""
    return len(keyword) <= 4 and " " not in keyword


def flattened(c: Column, kind: str | T.DataType) -> Column:
    """One text of a value: values of structs and maps and items of lists, at any depth, joined by blanks; null is ""."""
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    if isinstance(kind, T.StructType):
        return F.concat_ws(" ", *(F.nullif(flattened(c[f.name], f.dataType), F.lit("")) for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.array_join(F.filter(F.transform(c, lambda x: flattened(x, kind.elementType)), lambda x: x != ""), " "), F.lit(""))
    if isinstance(kind, T.MapType):
        return flattened(F.map_values(c), T.ArrayType(kind.valueType))
    return text_of(c.cast("string"))


def load_topics(text: str) -> list[Topic]:
    """Topics of a JSON text: a list of objects with slug, name and keywords, or an object of such by slug."""
    given = json.loads(text)
    rows = [{"slug": k, **v} for k, v in given.items()] if isinstance(given, dict) else given
    topics = [Topic(str(r["slug"]).strip(), str(r.get("name") or r["slug"]).strip(), tuple(distinct_keywords(map(str, r.get("keywords", ()))))) for r in rows]
    if len({t.slug for t in topics}) < len(topics):
        raise ValueError("a slug comes twice")
    return topics


def filtered(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of match_topics() that have a topic, and one row of how many were kept and filtered_out."""
    has = F.size("topic_labels") > 0
    return matched.where(has), matched.agg(F.count_if(has).alias("kept"), F.count_if(~has).alias("filtered_out"))


#: What \\w stands for: letters, marks, digits, connectors and joiners.
_WORD = r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\u200c\u200d]"


class Automaton:
    """All keywords at once: their places in a list, of those that a normalised text holds, in one pass over the text."""

    def __init__(self, keywords: Sequence[str]):
        import ahocorasick
        import regex

        self.word = regex.compile(_WORD)
        self.found = ahocorasick.Automaton()
        of: dict[str, list[int]] = {}
        for i, k in enumerate(keywords):
            of.setdefault(normalized(k), []).append(i)
        for k, numbers in of.items():
            if k:
                self.found.add_word(k, (len(k), is_code(k), numbers))
        if len(self.found):
            self.found.make_automaton()

    def __call__(self, text: str) -> list[int]:
        hit: set[int] = set()
        for end, (n, code, numbers) in self.found.iter(text) if len(self.found) else ():
            if numbers[0] not in hit and not (code and (self._joins(text, end - n) or self._joins(text, end + 1))):
                hit.update(numbers)
        return sorted(hit)

    def _joins(self, text: str, at: int) -> bool:
        return 0 <= at < len(text) and self.word.match(text[at]) is not None


def keyword_numbers(keywords: Sequence[str]):
    """A function of a column of normalised texts: array<int>, the places in `keywords` of those that the text holds."""
    given = list(keywords)

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        found = Automaton(given)
        return texts.map(found)

    return numbers


def _looked(docs: DataFrame, fields: Sequence[str], limit: int | None = None) -> dict[str, Column]:
    kinds = dict(docs.dtypes)
    return {f: normalize_for_match(F.substring(flattened(F.col(f), kinds[f]), 1, limit) if limit else flattened(F.col(f), kinds[f])) for f in fields}


def match_topics(docs: DataFrame, fields: Sequence[str], topics: Sequence[Topic], limit: int | None = None) -> DataFrame:
    """docs with topic_labels and topic_names in the topics' order, matched_keywords (first spellings, by topic, then
    keyword) and matched_fields (field -> keywords).

    limit: only so many characters of each field are looked at (a rule of matching for very long contents). Each field is
    normalised once and read once, however many keywords there are.
    """
    keywords = [(t, k) for t, topic in enumerate(topics) for k in distinct_keywords(topic.keywords)]
    held = unused(docs, "held")
    numbers = keyword_numbers([k for _, k in keywords])
    d = docs.withColumn(held, F.array(*(numbers(c) for c in _looked(docs, fields, limit).values())))
    spelled = F.array(*(F.lit(k) for _, k in keywords)).cast("array<string>")
    of = F.array(*(F.lit(t) for t, _ in keywords)).cast("array<int>")
    words = lambda n: F.array_distinct(F.transform(n, lambda i: F.get(spelled, i)))
    every = F.array_sort(F.array_distinct(F.flatten(held)))
    #: by topic, then field, then keyword
    in_topic = lambda t: F.array_distinct(F.flatten(F.transform(held, lambda n: F.filter(n, lambda i: F.get(of, i) == t))))
    of_topic = [in_topic(t) for t in range(len(topics))]
    labels = F.array_distinct(F.transform(every, lambda i: F.get(of, i)))
    named = lambda values: F.transform(labels, lambda t: F.get(F.array(*map(F.lit, values)).cast("array<string>"), t))
    by_field = F.map_from_arrays(F.array(*map(F.lit, fields)), F.transform(held, words))
    return d.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        named([t.slug for t in topics]).alias("topic_labels"),
        named([t.name for t in topics]).alias("topic_names"),
        words(F.concat(F.array().cast("array<int>"), *of_topic)).alias("matched_keywords"),
        F.map_filter(by_field, lambda _, v: F.size(v) > 0).alias("matched_fields"),
    )


def any_keyword(docs: DataFrame, fields: Sequence[str], keywords: Iterable[str]) -> DataFrame:
    """Rows of which a field has a keyword."""
    numbers = keyword_numbers(distinct_keywords(keywords))
    return docs.where(F.exists(F.array(*(numbers(c) for c in _looked(docs, fields).values())), lambda n: F.size(n) > 0))


def status_allowed(status: Column, allowed: Iterable[str]) -> Column:
    """Equal to an allowed status but for accents, case and spaces; a missing one never is."""
    return normalize_for_match(status).isin([normalized(a) for a in allowed if a.strip()]) & (strip(text_of(status)) != "")
