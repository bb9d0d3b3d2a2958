from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestack.functions import dates, ids, text


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


def each(spark, values, f, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r[0] for r in spark.createDataFrame(rows, f"i int, v {kind}").orderBy("i").select(f(F.col("v"))).collect()]


def test_accents_of_both_forms(spark):
    words = ["Điều lệ", unicodedata.normalize("NFD", "Điều lệ"), "đăng ký", "ASCII", "", None, "naïve Ångström ÇA"]
    got = each(spark, words, text.normalize_for_match)
    assert got == ["dieu le", "dieu le", "dang ky", "ascii", "", "", "naive angstrom ca"]


def test_every_character_against_unicodedata(spark):
    """All code points but surrogates and those that Java doesn't know, some hundreds a text."""
    codes = [c for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000 and c != ord("|")]
    texts = ["|".join(map(chr, codes[i : i + 500])) for i in range(0, len(codes), 500)]
    got = "|".join(each(spark, texts, text.strip_accents)).split("|")
    unknown = {x for t in each(spark, texts, lambda c: F.regexp_replace(c, r"[^\p{Cn}]", "")) for x in t}
    want = ["".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) != "Mn").replace("Đ", "D").replace("đ", "d") for c in codes]
    assert [(hex(c), g, w) for c, g, w in zip(codes, got, want, strict=True) if g != w and chr(c) not in unknown] == []


def test_hangul_and_several_letters_within_text(spark):
    words = ["각 가 힣 Đức", "ொ é", unicodedata.normalize("NFD", "한글"), "글", "x" * 100_000 + "글"]
    want = ["".join(x for x in unicodedata.normalize("NFD", w) if unicodedata.category(x) != "Mn").replace("Đ", "D") for w in words]
    assert each(spark, words, text.strip_accents) == want


@pytest.mark.parametrize("space", [" ", " ", "\x1c", "\x85", "　", "᠎\t"])
def test_whitespace_is_pythons(spark, space):
    raw = f"{space}a{space}{space}b{space}"
    assert each(spark, [raw], text.collapse) == [" ".join(raw.split()) if space != "᠎\t" else "᠎ a᠎ ᠎ b᠎"]


def test_clean_document_drops_noise_blanks_and_repeats(spark):
    raw = "  Trang  chủ \r\nOne  two\rOne two\n\n LIÊN HỆ\nthree\t\tfour\nOne two"
    assert each(spark, [raw, None, "\n \n"], text.clean_document) == ["One two\nthree four", "", ""]


def test_clean_text(spark):
    assert each(spark, ["a\x00\t b\n\n\n\nc ", None], text.clean_text) == ["a b\n\nc", ""]


def test_repairs(spark):
    assert each(spark, ["số 12 / 201 9 / NĐ", "ngày 20 1 5", "a  b c , d", "năm 201 9 ."], text.repair_block) == ["số 12/2019/NĐ", "ngày 20 1 5", "ab c, d", "năm 2019."]


def test_blocks_are_drawn_together(spark):
    blocks = ["A heading of some length here,", "continues in this longer line of text", "short", "Điều 1. stands alone", "another long line that starts anew here", "1. a clause"]
    got = one(spark, text.merge_blocks(F.array(*map(F.lit, blocks))))
    assert got == [" ".join(blocks[:3]), "Điều 1. stands alone", blocks[4], blocks[5]]


def test_as_list(spark):
    assert each(spark, ['["a", " b ", ""]', "plain", " ", None, '["broken'], text.as_list) == [["a", "b"], ["plain"], [], [], ['["broken']]


def test_dates(spark):
    raw = ["31/12/2023", "2023-13-45", "2024-01-01T00:00:00+07:00", "2024-05-06T07:08:09Z", "", None, "32/01/2024", "on 2024-02-30.", "2024-03-04 trailing"]
    assert each(spark, raw, dates.date_iso) == ["2023-12-31", "2023-13-45", "2024-01-01", "2024-05-06", "", "", "", "2024-02-30", "2024-03-04"]
    assert each(spark, raw[:7], dates.datetime_iso) == ["2023-12-31T00:00:00", "2023-13-45T00:00:00", "2023-12-31T17:00:00", "2024-05-06T07:08:09", "", "", ""]
    assert each(spark, raw[:4], dates.date_only) == ["", "", "2024-01-01", "2024-05-06"]


def test_cutoff_steps_back_and_stays_in_the_past(spark):
    ts = lambda x: F.lit(x).cast("timestamp")
    assert str(one(spark, dates.cutoff(ts("2024-03-10 15:00:00"), 1, ts("2024-04-01")))) == "2024-03-09 00:00:00"
    assert str(one(spark, dates.cutoff(ts("2024-03-10 15:00:00"), 1, ts("2024-03-01")))) == "2024-03-01 00:00:00"


def test_ids(spark):
    assert each(spark, ["123", "3f2504e0-4f89-41d3-9a0c-0305e82c3301", "a-b_1", "", None, "1a"], ids.id_type) == ["numeric", "uuid", "slug", "unknown", "unknown", "unknown"]
    urls = ["https://x/van-ban/chi-tiet/abc?x=1", "https://x/y?q=1&ItemID=42", "https://x/3f2504e0-4f89-41d3-9a0c-0305e82c3301/z", "https://x/", None]
    assert each(spark, urls, ids.document_id) == ["abc", "42", "3f2504e0-4f89-41d3-9a0c-0305e82c3301", "", ""]
    assert each(spark, ["a.PDF", "b.docx", "c.doc", "d", None], ids.attachment_type) == ["pdf", "docx", "doc", "other", "other"]


def test_urls_by_kind_take_the_first_that_fits(spark):
    urls = F.array(*map(F.lit, ["u/a.pdf.docx", "u/b.docx", "u/c.doc", "u/d.htm", "u/e.html?x", "u/f.json"]))
    got = spark.range(1).select(*(c.alias(k) for k, c in ids.classified(urls).items())).first().asDict()
    assert got == {"pdf_urls": ["u/a.pdf.docx"], "docx_urls": ["u/b.docx"], "doc_urls": ["u/c.doc"], "html_urls": ["u/e.html?x"], "json_snapshot_urls": ["u/f.json"]}


def test_relations(spark):
    assert each(spark, ["1", "15", "99", "x", " ", None], ids.relation_type) == ["abrogates", "referenced_text", "unknown_99", "x", "unknown", "unknown"]
