"""Source documents to records: projections of API answers and pages, and of records to later tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_iso, datetime_iso
from ..functions.ids import all_urls, attachment_type, classified, document_id, id_type, relation_type, stable_id
from ..functions.text import clean_document, clean_text, strip, text_of
from .quality import quality_flags, quality_score
from .structure import parts

_NAMED = "struct<name:string>"
_PERSON = "struct<personName:string,jobTitleName:string,agencyName:string>"
#: Schema of a detail answer, for from_json() or a JSON scan.
DETAIL = (
    f"title string, docType {_NAMED}, docNum string, agencyName string, issueDate string, effFrom string, effTo string, publicDate string, updatedDate string, "
    f"effStatus {_NAMED}, documentIssues array<{_PERSON}>, references string, documentFields array<{_NAMED}>, documentMajors array<{_NAMED}>, "
    "documentRelatedList array<struct<relatedDocumentId:string,targetDocumentId:string,sourceDocumentId:string,id:string,relatedType:string,title:string,relatedTitle:string>>, "
    "documentContent string"
)
#: Patterns of headers and numbers of documents. Fixed values.
NATIONAL_TITLE = "CỘNG HÒA XÃ HỘI CHỦ NGHĨA VIỆT NAM"
HEADER_CODE = r"(?iuU)Số\s*:\s*([0-9]+/\d{4}/[A-Za-zÀ-ỹĐđ0-9\-]+)"
ISSUING_BODY = "uy ban|hoi dong|chinh phu"
PLACE_DATE = r"(?iuU),\s*ngày\s+\d{1,2}\s+tháng\s+\d{1,2}\s+năm\s+\d{4}"
MOTTO = r"(?iuU)^.*Hạnh phúc\s+"
LEGAL_BASE = r"(?iu)(Căn cứ[^;\n]+;|Theo đề nghị[^;\n]+;)"
NUMBER = r"\b\d+/\d{4}/[A-Z0-9\-]+\b"
FILES = "array<struct<fileName:string,originalFileName:string,presignedUrl:string>>"


def _filled(*columns: Column) -> Column:
    """The first non-blank one, stripped, or ""."""
    return F.coalesce(*(F.when(strip(text_of(c)) != "", strip(text_of(c))) for c in columns), F.lit(""))


def names(items: Column) -> Column:
    return F.array_join(F.filter(F.transform(items, lambda x: strip(text_of(x["name"]))), lambda n: n != ""), ", ")


def field_of(fields: Column, majors: Column) -> Column:
    """Names of the fields, else of the majors."""
    return _filled(names(fields), names(majors))


def signer(issues: Column) -> Column:
    return strip(text_of(F.get(issues, F.lit(0))["personName"]))


def issue_summary(issues: Column, most: int = 3) -> Column:
    return F.transform(F.slice(issues, F.lit(1), F.lit(most)), lambda x: F.struct(*(strip(text_of(x[k])).alias(k) for k in ("personName", "jobTitleName", "agencyName"))))


def relations(related: Column, url_prefix: str) -> Column:
    """array<struct<id,url,relation_type,title>>; the id is the first of four that isn't blank, entries without go."""
    made = F.transform(
        related,
        lambda r: F.struct(
            _filled(r["relatedDocumentId"], r["targetDocumentId"], r["sourceDocumentId"], r["id"]).alias("id"),
            F.concat(F.lit(url_prefix), _filled(r["relatedDocumentId"], r["targetDocumentId"], r["sourceDocumentId"], r["id"])).alias("url"),
            relation_type(r["relatedType"]).alias("relation_type"),
            F.coalesce(F.nullif(r["title"], F.lit("")), r["relatedTitle"], F.lit("")).alias("title"),
        ),
    )
    return F.coalesce(F.filter(made, lambda r: r["id"] != ""), F.array().cast("array<struct<id:string,url:string,relation_type:string,title:string>>"))


def attachments(files: Column) -> Column:
    """array<struct<file_name,display_name,file_type,url>> of files with a link."""
    linked = F.filter(F.coalesce(files, F.from_json(F.lit("[]"), FILES)), lambda f: strip(text_of(f["presignedUrl"])) != "")
    return F.transform(
        linked,
        lambda f: F.struct(
            strip(text_of(f["fileName"])).alias("file_name"),
            F.coalesce(F.nullif(f["originalFileName"], F.lit("")), strip(text_of(f["fileName"]))).alias("display_name"),
            attachment_type(strip(text_of(f["fileName"]))).alias("file_type"),
            strip(f["presignedUrl"]).alias("url"),
        ),
    )


def preferred_files(attached: Column) -> Column:
    """Links of documents (pdf, doc, docx, rtf), else of all attachments."""
    documents = F.filter(attached, lambda a: a["file_type"].isin("pdf", "doc", "docx", "rtf"))
    return F.transform(F.when(F.size(documents) > 0, documents).otherwise(attached), lambda a: a["url"])


def from_detail(details: DataFrame, doc_id: str = "doc_id", detail: str = "detail", files: str = "files", url_prefix: str = "") -> DataFrame:
    """Records of detail answers (a struct of DETAIL, and files of FILES)."""
    d = lambda name: F.col(f"{detail}.{name}")
    url = F.concat(F.lit(url_prefix), F.col(doc_id))
    attached = attachments(F.col(files))
    issued = {"issued": "issueDate", "effective": "effFrom", "expired": "effTo", "gazette": "publicDate", "updated": "updatedDate"}
    return details.select(
        stable_id(url).alias("id"),
        F.col(doc_id).alias("canonical_doc_id"),
        id_type(F.col(doc_id)).alias("id_type"),
        strip(text_of(d("title"))).alias("title"),
        strip(text_of(d("docType.name"))).alias("document_type"),
        strip(text_of(d("docNum"))).alias("document_number"),
        strip(text_of(d("references"))).alias("summary"),
        strip(text_of(d("agencyName"))).alias("issuing_agency"),
        signer(d("documentIssues")).alias("signer"),
        issue_summary(d("documentIssues")).alias("issues"),
        F.coalesce(F.size(d("documentIssues")), F.lit(0)).alias("issue_count"),
        *(f(d(source)).alias(f"{name}_{kind}") for name, source in issued.items() for kind, f in (("date", date_iso), ("at", datetime_iso))),
        strip(text_of(d("effStatus.name"))).alias("status"),
        field_of(d("documentFields"), d("documentMajors")).alias("field"),
        url.alias("source_url"),
        preferred_files(attached).alias("file_urls"),
        relations(d("documentRelatedList"), url_prefix).alias("related_documents"),
        attached.alias("attachments"),
        clean_document(d("documentContent")).alias("content_text"),
    )


def rag_ready(records: DataFrame, chunks: DataFrame | None = None, key: str = "canonical_doc_id") -> DataFrame:
    """Records without page sources, with links by kind, clean content, score, flags and header fields, and, given
    chunks, chunk_count: those of the record's document, 0 without any."""
    kinds = classified(all_urls(F.col("attachments"), F.col("file_urls")))
    r = records.withColumns(kinds | {"content_clean": clean_text(F.col("content_text"))})
    c = {k: F.col(k) if k in r.columns else F.lit("") for k in ("title", "document_type", "document_number", "issued_date", "issued_at", "issuing_agency", "source_url", "content_clean")}
    date = F.concat(text_of(c["issued_date"]), text_of(c["issued_at"]))
    score = quality_score(c["title"], c["document_type"], c["document_number"], date, c["issuing_agency"], c["source_url"], c["content_clean"])
    flags = quality_flags(c["title"], c["document_type"], c["document_number"], c["issued_date"], c["content_clean"])
    r = r.withColumns({"quality_score": score, "quality_flags": flags} | header_fields(F.col("content_clean")))
    r = r.drop("attachments", "file_urls", "related_documents", "content_text", "full_html_content", "content_html", "articles", "candidate_fields")
    if chunks is None:
        return r
    counts = chunks.groupBy(key).agg(F.count("*").alias("chunk_count"))
    return r.join(counts, key, "left").withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0)))


def header_fields(content: Column, title: str = NATIONAL_TITLE, bases: int = 12) -> dict[str, Column]:
    """Code, national title, issuing body (of the first 20 lines), place and date (of the first 30), legal bases."""
    from ..functions.text import collapse, lines, normalize_for_match

    ls, text = lines(content), collapse(text_of(content))
    code = F.regexp_extract(text, HEADER_CODE, 1)
    body = F.filter(F.slice(ls, F.lit(1), F.lit(20)), lambda x: normalize_for_match(x).rlike(ISSUING_BODY))
    place = F.filter(F.slice(ls, F.lit(1), F.lit(30)), lambda x: x.rlike(PLACE_DATE))
    found = {
        "header_document_code": F.when(code != "", F.concat(F.lit("Số: "), code)).otherwise(""),
        "header_national_title": F.regexp_extract(text, f"(?iu){title}", 0),
        "header_issuing_body": F.coalesce(F.get(body, F.lit(0)), F.lit("")),
        "header_place_date": F.coalesce(strip(F.regexp_replace(F.get(place, F.lit(0)), MOTTO, "")), F.lit("")),
        "header_legal_bases": F.slice(F.regexp_extract_all(text_of(content), F.lit(LEGAL_BASE), F.lit(1)), F.lit(1), F.lit(bases)),
    }
    return {name: c.alias(name) for name, c in found.items()}


#: Labels of the fields of a page: parts of normalised labels. Fixed values.
LABELS = {
    "document_number": ("so ky hieu", "so hieu", "so van ban", "so"),
    "document_type": ("loai van ban", "hinh thuc", "ten loai"),
    "summary": ("trich yeu", "noi dung", "ten goi", "tom tat"),
    "issuing_agency": ("co quan ban hanh", "co quan"),
    "signer": ("nguoi ky", "chuc danh", "ky boi"),
    "issued_date": ("ngay ban hanh", "ngay ky"),
    "effective_date": ("ngay co hieu luc", "hieu luc tu ngay"),
    "expired_date": ("ngay het hieu luc",),
    "gazette_date": ("ngay cong bao",),
    "status": ("tinh trang hieu luc", "trang thai"),
    "field": ("linh vuc", "nganh", "pham vi"),
}


def from_page(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Records of plain pages, in the columns of an API record: title, content, links and labelled values come from the
    page, which is parsed once. A number that isn't labelled is looked for in the page's text; a type that isn't stays
    blank. Null pages give blank records."""
    from ..functions.html import by_label, html_page, labelled, values

    page = pages.select(F.col(url).alias("source_url"), F.col(html).alias("full_html_content"), html_page(F.col(html), F.col(url)).alias("page"))
    said = {name: strip(labelled(F.col("page.facts"), *synonyms)) for name, synonyms in LABELS.items()}
    p = page.select("*", F.struct(*(c.alias(k) for k, c in said.items())).alias("said"), clean_document(F.col("page.content")).alias("content_text"), values(F.col("page.facts"), "file").alias("file_urls"))
    said = {name: F.col(f"said.{name}") for name in LABELS}
    as_attachment = lambda u: F.struct(F.lit("").alias("file_name"), F.lit("").alias("display_name"), F.lit("url").alias("file_type"), u.alias("url"))
    return p.select(
        stable_id(F.col("source_url")).alias("id"),
        document_id(F.col("source_url")).alias("canonical_doc_id"),
        id_type(document_id(F.col("source_url"))).alias("id_type"),
        _filled(F.col("page.title"), said["summary"]).alias("title"),
        said["document_type"].alias("document_type"),
        _filled(said["document_number"], F.regexp_extract("page.text", NUMBER, 0)).alias("document_number"),
        *(said[k].alias(k) for k in ("summary", "issuing_agency", "signer")),
        *(date_iso(said[k]).alias(k) for k in ("issued_date", "effective_date", "expired_date", "gazette_date")),
        *(F.lit("").alias(k) for k in ("updated_date", "updated_at")),
        *(said[k].alias(k) for k in ("status", "field")),
        "source_url",
        "file_urls",
        values(F.col("page.facts"), "related").alias("related_documents"),
        F.transform("file_urls", as_attachment).alias("attachments"),
        "full_html_content",
        parts(F.col("content_text")).alias("articles"),
        "content_text",
        by_label(F.col("page.facts"), 2).alias("candidate_fields"),
    )


def detail_or_page(answers: DataFrame, pages: DataFrame, doc_id: str = "doc_id", detail: str = "detail", files: str = "files", url: str = "url", html: str = "html", url_prefix: str = "") -> DataFrame:
    """Records of documents, from the detail answer where there is one, else from the document's page; `origin` is api or
    page. Columns that only one of the two has are null for the other.

    answers: doc_id, detail (null if the request failed; without any field if the answer was empty) and files (null if
    that request failed, which costs the attachments only). pages: doc_id, url, html (null if it failed). Documents of
    neither are in no row, see unanswered(). Rows without doc_id
    are left out; a document with several rows has as many records; empty tables give none.
    """
    usable = answers.where(F.col(doc_id).isNotNull() & _answered(detail))
    rest = pages.where(F.col(doc_id).isNotNull() & F.col(html).isNotNull()).join(usable.select(doc_id).distinct(), doc_id, "left_anti")
    as_relation = lambda u: F.struct(F.lit("").alias("id"), u.alias("url"), F.lit("").alias("relation_type"), F.lit("").alias("title"))
    of_pages = from_page(rest, url, html).withColumn("related_documents", F.transform("related_documents", as_relation)).withColumn("origin", F.lit("page"))
    return from_detail(usable, doc_id, detail, files, url_prefix).withColumn("origin", F.lit("api")).unionByName(of_pages, allowMissingColumns=True)


def unanswered(answers: DataFrame, pages: DataFrame, doc_id: str = "doc_id", detail: str = "detail", html: str = "html") -> DataFrame:
    """doc_id of documents in either table that have neither an answer nor a page, once each."""
    known = answers.where(_answered(detail)).select(doc_id).union(pages.where(F.col(html).isNotNull()).select(doc_id)).distinct()
    return answers.select(doc_id).union(pages.select(doc_id)).where(F.col(doc_id).isNotNull()).distinct().join(known, doc_id, "left_anti")


def _answered(detail: str) -> Column:
    return F.col(detail).isNotNull() & (F.to_json(detail) != "{}")


def full(records: DataFrame, content: str = "full_html_content") -> DataFrame:
    """Records with the links of all attachments and files, and the content as it came."""
    return records.withColumns({"file_urls": all_urls(F.col("attachments"), F.col("file_urls")), "content_html": text_of(F.col(content))})
