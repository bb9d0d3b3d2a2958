"""Secret scanning in DataFrame functions alone: three fixed patterns, and windows of high Shannon entropy.

Candidates are runs of base64 characters. A window slides over each; character counts, packed into six numbers, and the
sum of c * log2(c) are kept up to date as one character enters and one leaves, in whole millionths of a bit so that the
outcome doesn't depend on the order of additions. A window counts if its entropy reaches the threshold of its character
class (hexadecimal or wider) and it has a letter and a digit. Words on the allow-list break candidates; candidates of
allowed shapes are passed over. Work is in proportion to a text's length, but for the places of matches, which are summed
in rounds, one more for eight times as many.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, table


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: kind -> (pattern, group that must have the length, least length); written without flags, so that other engines agree.
BASE = {
    "assign": (
        "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
}
KINDS = [*BASE, "entropy"]
#: The same matches of enough length, found without the short ones: runs of these characters are never cut short.
FAST = {"access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}
WINDOW = 24
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
DIGITS, HEX, LETTERS = 10, 22, 62  # ends of the classes in ALPHABET
#: Counts up to WINDOW take BITS bits each, PACKED of them a number.
BITS, PACKED = 5, 12
#: Windows that one fold goes through.
CHUNK = 4096
#: Least entropy in bits of a window by its class.
HEX_BITS, WIDE_BITS = 3.0, 3.8
#: Least length of what is left of an entropy span outside base spans.
PART = 8
#: Candidates of these shapes are no secrets: identifiers, paths and file names of plain parts (see `plain_parts`), digests
#: named as such.
ALLOW = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^/?[A-Za-z]+[0-9]{0,4}([/_-][A-Za-z]+[0-9]{0,4}|[/_-][0-9]{1,4})+/?$",
    "^(sha1|sha256|sha384|sha512|md5)-",
)
#: Alphabets and samples: words of as many characters as stated. They break a candidate like a blank.
ALLOWED_WORDS = (("abcdefghijklm", 13), ("ABCDEFGHIJKLM", 13), ("0123456789", 10), ("[Ee][Xx][Aa][Mm][Pp][Ll][Ee]", 7))


def _plogp(c: int) -> int:
    """c * log2(c) in millionths of a bit."""
    return round(c * math.log2(c) * 1_000_000) if c else 0


def _longs(values) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def running(numbers: Column) -> Column:
    """Sums of `numbers` (an array) up to each place, of stretches that are eight times as long in each round; ten rounds
    are enough for the longest array there can be."""

    def wider(by: int):
        earlier = lambda a, i: [F.coalesce(F.get(a, i - by * k), F.lit(0)) for k in range(1, 8)]
        return lambda a: F.when(F.size(a) > by, F.transform(a, lambda x, i: reduce(lambda u, v: u + v, earlier(a, i), x))).otherwise(a)

    for k in range(10):
        numbers = let(numbers, wider(8**k))
    return numbers


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<s,e,v>> of the leftmost non-overlapping matches: code points, end exclusive, and the group's text."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.transform(F.split(text, pattern, -1), lambda p: F.length(p)).alias("gaps"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")] if group else []),
    )

    def placed(f: Column) -> Column:
        before = F.transform(f["whole"], lambda m, i: F.get(f["gaps"], i) + F.coalesce(F.length(F.get(f["whole"], i - 1)), F.lit(0)))
        value = f["value"] if group else f["whole"]
        return let(running(before), lambda at: F.transform(f["whole"], lambda m, i: F.struct(F.get(at, i).alias("s"), (F.get(at, i) + F.length(m)).alias("e"), F.get(value, i).alias("v"))))

    return let(found, placed)


NONE = "array<struct<s:int,k:int,e:int>>"


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), m["e"].alias("e")))


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE[kind]
    low = F.lower(text)
    may = {
        "assign": reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in ("passw", "secret", "token", "key"))),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": text.rlike("[0-9a-f]{32}"),
    }[kind]
    return F.when(may, _tagged(F.filter(located(text, FAST.get(kind, pattern), group), lambda m: F.length(m["v"]) >= least), kind)).otherwise(F.array().cast(NONE))


def _slid(code: Column) -> Column:
    """array<struct<s,e>> of the united windows of `code`, places of characters in ALPHABET, that count."""
    table_, least_hex, least_wide = _longs(_plogp(c) for c in range(WINDOW + 1)), *(round(b * WINDOW * 1_000_000) for b in (HEX_BITS, WIDE_BITS))
    f = lambda c: F.get(table_, c)
    bit = lambda c: BITS * F.pmod(c, F.lit(PACKED))
    word = lambda c: F.floor(c / PACKED).cast("int")
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), bit(c))
    count = lambda n, c: F.call_function("shiftright", F.get(n, word(c)), bit(c)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def step(a: Column, new: Column) -> Column:
        old = F.get(code, a["i"] + 1 - WINDOW)  # null as long as nothing leaves
        same = F.coalesce(old == new, F.lit(False))
        more, less = count(a["n"], new) + 1, count(a["n"], old)
        counts = F.transform(a["n"], lambda c, j: c + F.when(j == word(new), one(new)).otherwise(0) - F.when(j == word(old), one(old)).otherwise(0))
        total = F.when(same, a["t"]).otherwise(a["t"] + f(more) - f(more - 1) - F.coalesce(f(less) - f(less - 1), F.lit(0)))
        grown = lambda name, test: (a[name] + test(new).cast("int") - F.coalesce(test(old).cast("int"), F.lit(0))).alias(name)
        return F.struct(
            F.when(same, a["n"]).otherwise(counts).alias("n"),
            total.alias("t"),
            grown("digits", lambda c: c < DIGITS),
            grown("letters", lambda c: (c >= DIGITS) & (c < LETTERS)),
            grown("wide", lambda c: c >= HEX),
            a["s"].alias("s"),
            a["e"].alias("e"),
            a["out"].alias("out"),
            (a["i"] + 1).alias("i"),
        )

    def judged(a: Column) -> Column:
        bits = F.lit(_plogp(WINDOW)).cast("long") - a["t"]
        counts = (a["i"] >= WINDOW - 1) & (a["digits"] > 0) & (a["letters"] > 0) & (bits >= F.when(a["wide"] > 0, least_wide).otherwise(least_hex))
        s, e = a["i"] - WINDOW + 1, a["i"] + 1
        fresh = counts & (a["e"] < s)
        closed = F.when(fresh & (a["e"] >= 0), F.array_append(a["out"], F.struct(a["s"].alias("s"), a["e"].alias("e")))).otherwise(a["out"])
        return F.struct(
            *(a[x].alias(x) for x in ("n", "t", "digits", "letters", "wide")),
            F.when(fresh, s).otherwise(a["s"]).alias("s"),
            F.when(counts, e).otherwise(a["e"]).alias("e"),
            closed.alias("out"),
            a["i"].alias("i"),
        )

    none = F.array().cast("array<struct<s:int,e:int>>")
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // PACKED)).alias("n"),
        F.lit(0).cast("long").alias("t"),
        *(F.lit(0).alias(x) for x in ("digits", "letters", "wide")),
        *(F.lit(-1).alias(x) for x in ("s", "e")),
        none.alias("out"),
        F.lit(-1).alias("i"),
    )
    last = lambda a: F.when(a["e"] >= 0, F.array_append(a["out"], F.struct(a["s"].alias("s"), a["e"].alias("e")))).otherwise(a["out"])
    return F.aggregate(code, start, lambda a, new: let(step(a, new), judged), last)


def _windows(text: Column) -> Column:
    """array<struct<s,e>> of the united windows of `text`, a candidate, that count; by chunks, which then are united."""
    codes = F.transform(F.split(text, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1)

    def chunks(code: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(code) - WINDOW, F.lit(CHUNK))
        moved = lambda k: F.transform(let(F.slice(code, k + 1, F.lit(CHUNK + WINDOW - 1)), _slid), lambda x: F.struct((x["s"] + k).alias("s"), (x["e"] + k).alias("e")))
        return F.flatten(F.transform(starts, moved))

    def united(spans: Column) -> Column:
        first = F.filter(spans, lambda x, i: F.coalesce(F.get(spans, i - 1)["e"] < x["s"], F.lit(True)))
        last = F.filter(spans, lambda x, i: F.coalesce(F.get(spans, i + 1)["s"] > x["e"], F.lit(True)))
        return F.zip_with(first, last, lambda x, y: F.struct(x["s"].alias("s"), y["e"].alias("e")))

    return let(let(codes, chunks), united)


def plain_parts(value: Column) -> Column:
    """The second of ALLOW, part by part: a repeated group of a pattern takes a stack frame for each of its rounds, and a
    path may have a million."""
    parts = F.split(F.regexp_replace(value, "^/|/$", ""), "[/_-]")
    plain = lambda p: F.forall(p, lambda x: x.rlike("^([A-Za-z]+[0-9]{0,4}|[0-9]{1,4})$"))
    return let(parts, lambda p: (F.size(p) > 1) & F.get(p, F.lit(0)).rlike("^[A-Za-z]") & plain(p))


def entropy_spans(text: Column) -> Column:
    """array<struct<s,k,e>>, by start, apart from each other."""
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    allowed = lambda v: v.rlike(ALLOW[0]) | v.rlike(ALLOW[2]) | plain_parts(v)
    masked = reduce(lambda t, w: F.regexp_replace(t, w[0], " " * w[1]), ALLOWED_WORDS, text)
    tokens = F.filter(let(masked, lambda t: located(t, CANDIDATE)), lambda m: mixed(m["v"]) & ~allowed(m["v"]))
    found = F.flatten(
        F.transform(tokens, lambda m: F.transform(_windows(m["v"]), lambda x: F.struct((m["s"] + x["s"]).alias("s"), F.lit(KINDS.index("entropy")).alias("k"), (m["s"] + x["e"]).alias("e"))))
    )
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(NONE))


def outside(spans: Column, base: Column) -> Column:
    """The parts of `spans` (apart from each other) outside those of `base` that have at least PART characters."""

    def ends(of: Column, at: str, h: int, b: int) -> Column:
        return F.transform(of, lambda x: F.struct(x[at].alias("at"), F.lit(h).alias("h"), F.lit(b).alias("b")))

    events = F.array_sort(F.concat(ends(spans, "s", 1, 0), ends(spans, "e", -1, 0), ends(base, "s", 0, 1), ends(base, "e", 0, -1)))

    def free(ev: Column) -> Column:
        sums = F.struct(running(F.transform(ev, lambda x: x["h"])).alias("h"), running(F.transform(ev, lambda x: x["b"])).alias("b"))
        piece = lambda x, i: F.struct(x["at"].alias("s"), F.lit(KINDS.index("entropy")).alias("k"), F.get(ev, i + 1)["at"].alias("e"))
        parts = lambda n: F.filter(F.transform(ev, lambda x, i: F.when((F.get(n["h"], i) > 0) & (F.get(n["b"], i) == 0), piece(x, i))), lambda p: p["e"] - p["s"] >= PART)
        return let(sums, parts)

    return F.when((F.size(spans) == 0) | (F.size(base) == 0), spans).otherwise(let(events, free))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: its id and text, base and spans (arrays of struct<s,k,e>, k an index of KINDS; sorted
    by start, then kind). spans holds base and what entropy spans have outside of it, in parts of at least PART characters.

    Null texts count as empty, with no spans. Whole texts are scanned, in time that grows with their length; repeated
    rows give a row each; an empty table gives none; other columns are ignored, so their names can't clash. There is no
    shuffle and no Python.
    """
    d = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.withColumns({k: base_spans(F.col("t"), k) for k in BASE} | {"high": entropy_spans(F.col("t"))})
    d = d.withColumn("base", F.array_sort(F.concat(*BASE)))
    return d.select(F.col("id").alias(doc_id), F.col("t").alias(text), "base", F.array_sort(F.concat("base", outside(F.col("high"), F.col("base")))).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    r = scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(kind))).cast("long")
    return r.select("doc_id", *(n(k).alias(f"n_{k}") for k in BASE), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, pattern: str, group: int, least: int, source: str = "d") -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {KINDS.index(kind)} AS k, v,
    CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(ms[i]) AS n
  FROM (SELECT doc_id, ms, gaps, unnest(vs) AS v, generate_subscripts(vs, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {group}) AS vs, string_split_regex(t, '{p}') AS gaps FROM {source}))
  WHERE length(v) >= {least}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, kind, k, s, s + n AS e FROM ({' UNION ALL '.join(_sql_spans(k, *x) for k, x in BASE.items())})),
masked AS (SELECT doc_id, {reduce(lambda t, w: f"regexp_replace({t}, '{w[0]}', '{' ' * w[1]}', 'g')", ALLOWED_WORDS, 't')} AS t FROM d),
cand AS (SELECT doc_id, s, n, v FROM ({_sql_spans('entropy', CANDIDATE, 0, WINDOW, 'masked')})
  WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT ({' OR '.join(f"regexp_matches(v, '{p}')" for p in ALLOW)})),
win AS (SELECT doc_id, s AS c, s + i AS s, substr(v, CAST(i + 1 AS INT), {WINDOW}) AS w FROM (SELECT *, unnest(range(0, n - {WINDOW} + 1)) AS i FROM cand)),
bits AS (SELECT doc_id, c, s, w, {_plogp(WINDOW)} - CAST(sum(CAST(round(n * log2(n) * 1000000) AS BIGINT)) AS BIGINT) AS b
  FROM (SELECT doc_id, c, s, w, x, count(*) AS n FROM (SELECT doc_id, c, s, w, unnest(string_split(w, '')) AS x FROM win) GROUP BY ALL) GROUP BY doc_id, c, s, w),
good AS (SELECT doc_id, c, s FROM bits WHERE regexp_matches(w, '[0-9]') AND regexp_matches(w, '[A-Za-z]')
  AND b >= CASE WHEN regexp_full_match(w, '[0-9a-fA-F]+') THEN {round(HEX_BITS * WINDOW * 1_000_000)} ELSE {round(WIDE_BITS * WINDOW * 1_000_000)} END),
grp AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, c ORDER BY s) AS g
  FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id, c ORDER BY s) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM good)),
high AS (SELECT doc_id, min(s) AS s, max(s) + {WINDOW} AS e FROM grp GROUP BY doc_id, c, g),
spot AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id, s ORDER BY p) AS g, s AS of FROM (SELECT doc_id, s, unnest(range(s, e)) AS p FROM high) h
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = h.doc_id AND b.s <= h.p AND h.p < b.e)),
added AS (SELECT doc_id, min(p) AS s, max(p) + 1 AS e FROM spot GROUP BY doc_id, of, g HAVING count(*) >= {PART}),
every AS (SELECT doc_id, kind, k, s, e FROM base UNION ALL SELECT doc_id, 'entropy', {KINDS.index('entropy')}, s, e FROM added),
b1 AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS b FROM base GROUP BY doc_id),
e1 AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS a FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN b1 USING (doc_id) LEFT JOIN e1 USING (doc_id)
"""
