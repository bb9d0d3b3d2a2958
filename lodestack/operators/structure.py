"""Articles, clauses and points of a text from its lines, and the chunks they make.

The parse is a running sum of starts over the lines of one document. It stays within the row: lines are an array, starts
are numbered by one pass over it, so there is no shuffle and no sort, however long one document is, and the work grows
with its lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, lines, normalize_for_match, strip


@dataclass(frozen=True)
class Headings:
    """Patterns and words of a legal text. article matches the line without accents, in lower case; only lines that
    article_hint finds are looked at for it. Fixed values."""

    article_hint: str = "^[dDđĐ]"
    article: str = r"^dieu\s+(\d+)[\.:]?\s*(.*)$"
    article_raw: str = r"(?iuU)^\s*Điều\s+\d+[\.:]?\s*"
    clause: str = r"^(?U:\s*(\d+)\.\s+(.*))$"
    point: str = r"^(?U:\s*([a-zA-Z])\)\s+(.*))$"
    article_word: str = "Điều"
    clause_word: str = "Khoản"
    point_word: str = "Điểm"


#: Lines that one fold gathers; a fold copies what it has gathered for each, so long texts are folded block by block.
FOLD = 512
LINE = "struct<kind:string,i:int,a:int,c:int,p:int,k:int,key:string,text:string>"


def tagged_lines(text: Column, h: Headings = Headings()) -> Column:
    """array<struct<kind,i,a,c,p,k,key,text>>: each line (the i-th) with the running numbers of its article, clause and
    point, and k, that of its clause in the whole text.

    kind is article, clause or point for lines that start one, else text. A clause needs an article before it, a point a
    clause in the same article. Lines before the first article have a = 0.
    """
    seen = F.transform(
        lines(text),
        lambda x: F.struct(
            x.alias("x"),
            F.when(x.rlike(h.article_hint), F.regexp_extract(normalize_for_match(x), h.article, 1)).otherwise("").alias("article"),
            F.regexp_extract(x, h.clause, 1).alias("clause"),
            F.regexp_extract(x, h.point, 1).alias("point"),
        ),
    )

    counts, none = ("a", "c", "p", "k", "i"), F.array().cast(f"array<{LINE}>")

    def step(s: Column, x: Column) -> Column:
        is_a = x["article"] != ""
        is_c = ~is_a & (x["clause"] != "") & (s["a"] > 0)
        is_p = ~is_a & ~is_c & (x["point"] != "") & (s["c"] > 0)
        now = {
            "a": s["a"] + is_a.cast("int"),
            "c": F.when(is_a, 0).otherwise(s["c"] + is_c.cast("int")),
            "p": F.when(is_a | is_c, 0).otherwise(s["p"] + is_p.cast("int")),
            "k": s["k"] + is_c.cast("int"),
        }
        line = F.struct(
            F.when(is_a, "article").when(is_c, "clause").when(is_p, "point").otherwise("text").alias("kind"),
            s["i"].alias("i"),
            *(now[n].alias(n) for n in "acpk"),
            F.when(is_a, x["article"]).when(is_c, x["clause"]).when(is_p, F.lower(x["point"])).otherwise("").alias("key"),
            F.when(is_a, strip(F.regexp_replace(x["x"], h.article_raw, "")))
            .when(is_c, strip(F.regexp_extract(x["x"], h.clause, 2)))
            .when(is_p, strip(F.regexp_extract(x["x"], h.point, 2)))
            .otherwise(x["x"])
            .alias("text"),
        )
        return F.struct(*(now[n].alias(n) for n in "acpk"), (s["i"] + 1).alias("i"), F.array_append(s["out"], line).alias("out"))

    def block(s: Column, lines_: Column) -> Column:
        done = F.aggregate(lines_, F.struct(*(s[n].alias(n) for n in counts), none.alias("out")), step)
        return bound(done, lambda d: F.struct(*(d[n].alias(n) for n in counts), F.array_append(s["out"], d["out"]).alias("out")))

    def of(every: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(every) - 1, F.lit(FOLD)), lambda k: F.slice(every, k + 1, FOLD))
        start = F.struct(*(F.lit(0).alias(n) for n in counts), F.array().cast(f"array<array<{LINE}>>").alias("out"))
        return F.when(F.size(every) > 0, F.flatten(F.aggregate(blocks, start, block, lambda s: s["out"]))).otherwise(none)

    return bound(seen, of)


def parts(text: Column, h: Headings = Headings()) -> Column:
    """An array of the articles, clauses and points: level, a, c, p (running numbers, 0 where it isn't part of one),
    article_number, article_title, clause_number, point_key, content.

    An article's content are its lines before the first clause; a clause takes up all other lines up to the next clause
    or article, those after its points too.
    """

    def of_lines(l: Column) -> Column:
        of_kind = lambda *kinds: F.filter(l, lambda x: x["kind"].isin(*kinds))
        kinds = F.struct(of_kind("article").alias("article"), of_kind("clause").alias("clause"), F.transform(of_kind("article", "clause"), lambda x: x["i"]).alias("starts"))
        return bound(kinds, lambda of: of_kinds(l, of["article"], of["clause"], of["starts"]))

    def of_kinds(l: Column, articles: Column, clauses: Column, starts: Column) -> Column:

        def one(x: Column) -> Column:
            end = F.coalesce(F.get(starts, x["a"] + x["k"]), F.size(l))
            more = F.transform(F.filter(F.slice(l, x["i"] + 2, F.greatest(end - x["i"] - 1, F.lit(0))), lambda y: y["kind"] == "text"), lambda y: y["text"])
            content = (
                F.when(x["kind"] == "article", F.array_join(more, "\n"))
                .when(x["kind"] == "clause", strip(F.concat_ws(" ", x["text"], F.array_join(more, " "))))
                .otherwise(x["text"])
            )
            article, clause = F.get(articles, x["a"] - 1), F.get(clauses, x["k"] - 1)
            return F.struct(
                x["kind"].alias("level"),
                x["a"].alias("a"),
                x["c"].alias("c"),
                x["p"].alias("p"),
                article["key"].alias("article_number"),
                article["text"].alias("article_title"),
                F.when(x["c"] > 0, clause["key"]).otherwise("").alias("clause_number"),
                F.when(x["kind"] == "point", x["key"]).otherwise("").alias("point_key"),
                content.alias("content"),
            )

        return F.transform(F.filter(l, lambda x: x["kind"] != "text"), one)

    return bound(tagged_lines(text, h), of_lines)


def structured(docs: DataFrame, doc_id: str, text: str, h: Headings = Headings()) -> DataFrame:
    """doc_id and the columns of parts(), a row for each. Map-only."""
    return docs.select(doc_id, F.explode(parts(F.col(text), h)).alias("x")).select(doc_id, "x.*")


def chunk_structs(text: Column, least: int = 80, h: Headings = Headings()) -> Column:
    """array<struct<level,article_number,clause_number,point_key,chunk>>: articles, clauses and points with their headings."""

    def chunk(x: Column) -> Column:
        number, title = x["article_number"], x["article_title"]
        head = F.concat(F.lit(f"{h.article_word} "), number, F.when(title != "", F.concat(F.lit(". "), title)).otherwise(""))
        clause = F.concat(F.lit(f"{h.clause_word} "), x["clause_number"])
        whole = (
            F.when(x["level"] == "article", F.concat_ws("\n", head, x["content"]))
            .when(x["level"] == "clause", F.concat(head, F.lit("\n"), clause, F.lit(". "), x["content"]))
            .otherwise(F.concat(head, F.lit("\n"), clause, F.lit(f"\n{h.point_word} "), x["point_key"], F.lit(". "), x["content"]))
        )
        return F.struct(*(x[k].alias(k) for k in ("level", "article_number", "clause_number", "point_key")), F.regexp_replace(strip(whole), "\n{3,}", "\n\n").alias("chunk"))

    made = F.transform(F.filter(parts(text, h), lambda x: x["content"] != ""), chunk)
    return F.filter(made, lambda x: F.length(x["chunk"]) >= least)


def structured_chunks(docs: DataFrame, doc_id: str, text: str, least: int = 80, h: Headings = Headings()) -> DataFrame:
    """Chunks of articles, clauses and points with their headings: doc_id, chunk_no, level, numbers and keys, chunk,
    char_count. Empty parts and chunks shorter than `least` are left out and take no number. Map-only."""
    return docs.select(doc_id, F.posexplode(chunk_structs(F.col(text), least, h)).alias("n", "x")).select(doc_id, (F.col("n") + 1).alias("chunk_no"), "x.*", F.length("x.chunk").alias("char_count"))
