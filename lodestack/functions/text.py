"""Text normalisation as DataFrame expressions; whitespace and case as Python has them, without Python."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Sequence
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip() and \s take as whitespace; Java's \s is ASCII only.
WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Those of them that aren't a plain space, and of these those that aren't a line end, for use in a class.
_OTHER_INLINE = r"\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_OTHER = _OTHER_INLINE + r"\n"
#: The same characters, as Python itself names them.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
#: Line ends of Python's str.splitlines().
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once. Projections are merged, so an expression that stands in a lambda would
    otherwise be computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Runs of whitespace as one space, none at the ends. Single spaces, the most common, are not replaced."""
    return strip(F.regexp_replace(c, _runs(_OTHER), " "))


def _runs(other: str) -> str:
    """A pattern of runs of spaces and `other` characters but for single spaces. Most characters are passed by one range,
    before the class of many is tried."""
    return f"(?![!-~])(?:[{other}][ {other}]*| [ {other}]+)"


@cache
def _accent_tables() -> tuple[str, str]:
    """Characters that decompose into one base character and marks, and their bases; derived, not listed."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3:
            continue
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            source.append(c)
            target.append(base)
    return "".join([*source, "Đ", "đ"]), "".join([*target, "D", "d"])


@cache
def _several() -> dict[str, str]:
    """Characters that decompose into several that are no marks, and these; derived, not listed, without Hangul."""
    found = {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) > 1 and not "\uac00" <= c <= "\ud7a3":
            found[c] = base
    return found


#: Parts of Hangul syllables: 19 leading ones, 21 vowels, and 27 trailing ones or none.
LEADING, VOWELS, TRAILING = ("".join(map(chr, range(first, first + n))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))


def _syllable(c: Column) -> Column:
    """A Hangul syllable taken apart, by the arithmetic of its code."""
    n = F.ascii(c) - 0xAC00
    at = lambda parts, k: F.substr(F.lit(parts), k.cast("int"), F.lit(1))
    last = F.when(n % 28 > 0, at(TRAILING, n % 28)).otherwise("")
    return F.concat(at(LEADING, F.floor(n / 588) + 1), at(VOWELS, F.floor(n % 588 / 28) + 1), last)


def _decomposed(c: Column) -> Column:
    """Character by character, those that become several; for the few texts that have any."""
    known = F.create_map(*(F.lit(x) for pair in sorted(_several().items()) for x in pair))
    one = lambda x: F.when(x.between("\uac00", "\ud7a3"), _syllable(x)).otherwise(F.coalesce(F.element_at(known, x), x))
    return F.array_join(F.transform(F.split(c, ""), one), "")


#: Marks; U+1734 is one to Unicode 13, which some Javas know, and none since.
MARKS = r"[\p{Mn}&&[^\u1734]]"


def strip_accents(c: Column) -> Column:
    """Letters without their marks, Đ as D; characters that decompose into several letters become these, Hangul too."""
    source, target = _accent_tables()
    plain = F.length(c) == F.octet_length(c)
    bare = lambda x: F.regexp_replace(F.translate(x, source, target), MARKS, "")
    several = "".join(sorted(_several()))
    # a range first: the class of many single characters is tried on few texts
    wide = c.rlike(rf"[{several[0]}-\x{{10FFFF}}]") & c.rlike(f"[\uac00-\ud7a3{several}]")
    return F.when(plain, c).when(wide, bare(_decomposed(c))).otherwise(bare(c))


def normalize_for_match(c: Column) -> Column:
    return collapse(F.lower(strip_accents(text_of(c))))


def normalize_key(c: Column) -> Column:
    """Like normalize_for_match(), with : / - _ , . ; as spaces too."""
    return collapse(F.regexp_replace(F.lower(strip_accents(text_of(c))), r"[\s:/\-_,.;]+", " "))


#: Navigation lines that carry no content: whole lower-cased lines. Fixed values.
NOISE_LINES = (
    "trang chủ",
    "liên hệ",
    "đăng nhập",
    "hướng dẫn khai thác",
    "sơ đồ cổng thông tin",
)
#: Distinct lines that are remembered; with one more all are forgotten.
REMEMBERED = 2000


def unrepeated(lines: Column, remembered: int = REMEMBERED) -> Column:
    """lines without those that were kept before and are still remembered: once more than `remembered` different ones have
    been kept, all are forgotten.

    A line is fresh if its previous occurrence lies before the present epoch, so the epochs' starts come out of one pass
    over the places of previous occurrences; within an epoch a line is kept once.
    """
    def previous(x: Column) -> Column:
        """Of each line its place and that of the previous equal one, or -1."""
        placed = F.array_sort(F.transform(x, lambda line, i: F.struct(line.alias("x"), i.alias("i"))))
        return bound(placed, lambda p: F.array_sort(F.transform(p, lambda y, j: F.struct(y["i"].alias("i"), F.when(F.coalesce(F.get(p, j - 1)["x"] == y["x"], F.lit(False)), F.get(p, j - 1)["i"]).otherwise(-1).alias("before")))))

    def step(a: Column, p: Column) -> Column:
        kept = a["kept"] + (p["before"] < a["start"]).cast("int")
        full, after = kept > remembered, p["i"] + 1
        starts = F.when(full, F.array_append(a["starts"], after)).otherwise(a["starts"])
        return F.struct(F.when(full, after).otherwise(a["start"]).alias("start"), F.when(full, 0).otherwise(kept).alias("kept"), starts.alias("starts"))

    def by_epochs(x: Column) -> Column:
        state = F.struct(F.lit(0).alias("start"), F.lit(0).alias("kept"), F.array(F.lit(0)).alias("starts"))
        starts = F.aggregate(previous(x), state, step, lambda a: a["starts"])
        part = lambda s: F.transform(s, lambda b, k: F.array_distinct(F.slice(x, b + 1, F.coalesce(F.get(s, k + 1), F.size(x)) - b)))
        return F.flatten(bound(starts, part))

    return bound(F.array_distinct(lines), lambda once: F.when(F.size(once) <= remembered, once).otherwise(bound(lines, by_epochs)))


def clean_document(c: Column, noise: Sequence[str] = NOISE_LINES, remembered: int = REMEMBERED) -> Column:
    """Lines stripped and collapsed, without blank ones, noise and repeats of an earlier line that is still remembered."""
    spaced = F.regexp_replace(F.regexp_replace(text_of(c), r"\r\n?", "\n"), _runs(_OTHER_INLINE), " ")  # of all lines at once
    lines = F.transform(F.split(spaced, "\n"), lambda x: F.trim(x))
    longest = max(map(len, noise), default=0)  # a text has no more characters than its lower case
    kept = F.filter(lines, lambda x: (x != "") & ((F.length(x) > longest) | ~F.lower(x).isin(list(noise))))
    return F.array_join(bound(kept, lambda x: unrepeated(x, remembered)), "\n")


def clean_text(c: Column) -> Column:
    """NUL and runs of blanks as one space, at most one blank line in a row, nothing around."""
    return strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(text_of(c), "\\x00", " "), _runs(r"\t"), " "), "\n{3,}", "\n\n"))


def lines(c: Column) -> Column:
    """Non-blank lines, stripped."""
    return F.filter(F.transform(F.split(text_of(c), LINE_END), strip), lambda x: x != "")


_LETTER = "A-Za-zÀ-ỹĐđ"


def repair_block(c: Column) -> Column:
    """Repairs of one extracted block: spaces about slashes, split numbers and years, spaces before punctuation, and
    one-letter words that belong together. The patterns are fixed values."""
    steps = [
        ("\u00a0", " "),
        ("[ \t]+", " "),
        (f"^{WS}+|{WS}+$", ""),
        (r"(?U)(\d)\s*/\s*", "$1/"),
        (r"(?U)/\s+", "/"),
        (r"(?U)(\d{3})\s+(\d)(?=/)", "$1$2"),
        (r"(?U)\b(20\d)\s+(\d)\b", "$1$2"),
        (r"(?U)\s+([,;:.])", "$1"),
        (rf"(?U)\b([{_LETTER}])\s+([{_LETTER}])\b", "$1$2"),
        (r"(?iuU)\bTheođềnghị\b", "Theo đề nghị"),
    ]
    return reduce(lambda x, s: F.regexp_replace(x, *s), steps, text_of(c))


def repair_text(c: Column) -> Column:
    """The same kind of repairs over joined blocks; punctuation and slashes may draw lines together. The
    patterns are fixed values."""
    steps = [
        (rf"(?U)(\d)\s+/\s*([{_LETTER}])", "$1/$2"),
        (r"(?U)\b(20\d)\s+(\d)\b", "$1$2"),
        (r"(?U)\s+([,;:.])", "$1"),
        (r"(?U)\s*/\s*", "/"),
        (r"(?U)(\d)/\s+(\d)", "$1/$2"),
        ("\n{3,}", "\n\n"),
    ]
    return strip(reduce(lambda x, s: F.regexp_replace(x, *s), steps, text_of(c)))


#: Lines that begin a block of their own: headings, articles, clauses, points. Fixed values.
STRUCTURAL = (
    r"(?iuU)^(QUYẾT ĐỊNH|NGHỊ ĐỊNH|THÔNG TƯ|LUẬT)\b",
    r"(?iuU)^Điều\s+\d+[\.:]?",
    r"(?U)^\d+\.\s+",
    r"(?U)^[a-zA-Z]\)\s+",
)


def merge_blocks(blocks: Column, short: int = 22) -> Column:
    """Blocks drawn to the one before where they are short or that one is left open; structural ones stand alone.

    Whether a block is drawn depends on it and its neighbour only, as a merged block ends like its last part.
    """
    own = lambda x: reduce(lambda a, b: a | b, (x.rlike(p) for p in STRUCTURAL))
    open_end = lambda x: x.rlike("[,;:/-]$")
    drawn = lambda x, prev: ~own(x) & ((F.length(x) <= short) | open_end(prev))

    def merged(b: Column) -> Column:
        starts = F.filter(F.transform(b, lambda x, i: F.when((i == 0) | ~drawn(x, F.get(b, i - 1)), i)), lambda i: i.isNotNull())
        whole = lambda part: F.when(F.size(part) == 1, F.get(part, F.lit(0))).otherwise(collapse(F.array_join(part, " ")))
        each = lambda of: F.transform(of, lambda s, j: whole(F.slice(b, s + 1, F.coalesce(F.get(of, j + 1), F.size(b)) - s)))
        return bound(starts, each)

    return bound(blocks, merged)


def split_csv(c: Column) -> Column:
    return F.filter(F.transform(F.split(text_of(c), ","), strip), lambda x: x != "")


def as_list(c: Column) -> Column:
    """A JSON list of strings, or any other non-blank text as the only element."""
    raw = strip(text_of(c))
    parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    listed = F.filter(F.transform(parsed, lambda x: strip(F.coalesce(x, F.lit("None")))), lambda x: x != "")
    return F.when(raw == "", F.array().cast("array<string>")).otherwise(F.coalesce(listed, F.array(raw)))


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))
