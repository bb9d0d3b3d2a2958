from __future__ import annotations

import random


from lodestack.llm import line_dedup as d

LONG = [f"line {k} " + " ".join(f"w{k}x{j}" for j in range(12)) for k in range(60)]


def got(spark, rows, **more):
    r = d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), **more)
    return sorted(((x.doc_id, x.text, x._dropped, x._emptied) for x in r.collect()), key=repr)


def test_patience_is_a_common_order():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(25))] for _ in range(2))
        pairs = d.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert d.patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert d.patience([5] * 6, [5] * 4) == [(i, i) for i in range(4)]
    assert d.patience([], [1]) == []


def test_blocks_of_a_later_document_go(spark):
    a = "\n".join(LONG[:6])
    b = "\n".join(["own first", *LONG[2:5], "own last"])
    c = "\n".join(["x", LONG[20], "y"])
    rows = [(1, a), (2, b), (3, c), (4, LONG[20]), (5, a)]
    assert got(spark, rows) == sorted([(1, a, 0, False), (2, "own first\nown last", 3, False), (3, c, 0, False), (4, LONG[20], 0, False), (5, "", 6, True)], key=repr)


def test_short_blocks_stay_and_order_matters(spark):
    rows = [(1, "\n".join(LONG[:3])), (2, f"{LONG[2]}\nz\n{LONG[0]}"), (3, "short\nlines\nonly"), (4, "short\nlines\nonly")]
    assert [x[2] for x in got(spark, rows)] == [0, 0, 0, 0]
    assert [x[2] for x in got(spark, rows, min_words=3)] == [0, 2, 0, 3]  # both crossed lines are blocks of enough words


def test_frequent_lines(spark):
    rows = [(k, "\n".join([f"own {k}", *LONG[:4], f"tail {k}"])) for k in range(30)]
    dropped = [x[2] for x in sorted(got(spark, rows))]
    assert dropped == [0, *[4] * 29]


def test_against_first_holders(spark):
    """Every dropped line stands in an earlier document, and every run of enough words shared with the first holder goes."""
    rng = random.Random(4)
    docs = {}
    for k in range(60):
        part = lambda: LONG[(s := rng.randrange(50)) : s + rng.randrange(6)]
        docs[k] = [*part(), f"own {k}", *part(), *([LONG[3]] * rng.randrange(3))]
    first = {}
    for k in sorted(docs):
        for line in docs[k]:
            first.setdefault(line, k)
    for k, text, dropped, _ in got(spark, [(k, "\n".join(v)) for k, v in docs.items()]):
        left = text.split("\n") if text else []
        assert len(left) + dropped == len(docs[k])
        gone = list(docs[k])
        for line in left:
            gone.remove(line)
        assert all(first[line] < k for line in gone)


def test_nulls_ids_spaces_and_extra_columns(spark):
    a = "\n".join(LONG[:5])
    rows = [(None, a, 1, "x"), (1, None, 2, "y"), (2, "", 3, None), (3, a, 4, "z"), (3, a, 4, "z"), (4, f"  {LONG[0]} \n\n{LONG[1]}\n \n{LONG[2]}\nend", 5, "q")]
    out = d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, o int, first string"))
    got_ = sorted(map(repr, out.select("doc_id", "text", "o", "first").collect()))
    want = [*rows[:5], (4, "\n \nend", 5, "q")]
    assert got_ == sorted(map(repr, spark.createDataFrame(want, "doc_id long, text string, o int, first string").collect()))
    assert d.dedup_lines(out.select("doc_id", "text").limit(0)).count() == 0


def test_deduplicated_keeps_the_columns(spark):
    a = "\n".join(LONG[:5])
    docs = spark.createDataFrame([(1, a, len(a)), (2, a, len(a)), (3, f"{a}\nown", len(a) + 4)], "doc_id long, text string, n_chars long")
    out = d.deduplicated(docs)
    assert out.dtypes == docs.dtypes
    assert sorted((r.doc_id, r.n_chars, r.text) for r in out.collect()) == [(1, len(a), a), (3, 3, "own")]


def test_long_documents(spark):
    lines = [f"{k} " + "w " * 10 for k in range(20_000)]
    out = got(spark, [(1, "\n".join(lines)), (2, "\n".join(lines[5000:15000]))])
    assert [(x[0], x[2], x[3]) for x in out] == [(1, 0, False), (2, 10_000, True)]


def test_frequent_blocks_with_repeated_and_foreign_lines(spark):
    """A block of frequent lines goes whole, though a line of it comes twice and another one stands in an earlier text."""
    block = [LONG[0], "thanks", LONG[1], "thanks", LONG[2], LONG[3]]
    rows = [(0, f"own\n{LONG[1]}\nlicence"), *((k, "\n".join([f"own {k}", *block, f"tail {k}"])) for k in range(1, 9))]
    assert [x[2] for x in got(spark, rows)] == [0, 0, *[6] * 7]


def brute(docs, min_words=d.MIN_WORDS):
    """Dropped lines of each document: those of runs of enough words that an earlier one has without lines between."""
    out = []
    for k, lines in enumerate(docs):
        gone = set()
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[s:e]) >= min_words and any(lines[s:e] == o[i : i + e - s] for o in docs[:k] for i in range(len(o))):
                    gone.update(range(s, e))
        out.append(len(gone))
    return out


def test_against_every_earlier_document(spark):
    """Parts stand in the same order in all documents, then in any order, with lines that recur."""
    rng = random.Random(7)
    docs = []
    for k in range(80):
        lines = [x for x in [w for j in range(24) for w in ([LONG[j]] if j % 3 else [f"few {j}", LONG[j]])] if rng.random() < 0.75]
        for _ in range(rng.randrange(3)):
            lines.insert(rng.randrange(len(lines) + 1), f"own {k} {rng.random()}")
        docs.append(lines)
    for k in range(60):
        piece = lambda: LONG[(s := rng.randrange(40)) : s + rng.randrange(1, 6)]
        docs.append([*piece(), f"own {k}", *piece(), "thanks", *piece(), *([LONG[3], LONG[4]] * rng.randrange(3))])
    out = got(spark, [(k, "\n".join(v)) for k, v in enumerate(docs)])
    assert [x[2] for x in sorted(out)] == brute(docs)


def test_block_whose_lines_have_other_first_holders(spark):
    """B < C share x, y, each of which stands first, alone, in another document."""
    x, y = LONG[0], LONG[1]
    rows = [(1, f"a\n{x}\nb"), (2, f"c\n{y}\nd"), (3, f"e\n{x}\n{y}\nf"), (4, f"g\n{x}\n{y}\nh")]
    assert [r[2] for r in got(spark, rows)] == [0, 0, 0, 2]


def test_white_space_around_lines(spark):
    a = "\n".join(LONG[:3])
    rows = [(1, a), (2, "own\r\n" + "\r\n".join(LONG[:3]) + "\r\n"), (3, "\n\t\r\n".join(f"\t{x}\t \x0b\f" for x in LONG[:3]) + "\nown")]
    assert got(spark, rows) == sorted([(1, a, 0, False), (2, "own\r\n", 3, False), (3, "\t\r\n\t\r\nown", 3, False)], key=repr)


def test_blocks_that_one_holder_of_a_line_does_not_have(spark):
    """A line that stands alone earlier, four lines that each stand alone earlier, and a line that recurs in the holder."""
    fourteen = [f"line {k} " + " ".join(f"v{k}x{j}" for j in range(12)) for k in range(4)]
    one = [(0, fourteen[1]), (1, "\n".join(fourteen[1:3])), *((k, "\n".join([f"o{k}", *fourteen[1:3], f"t{k}"])) for k in range(2, 8))]
    assert [x[2] for x in sorted(got(spark, one))] == [0, 0, *[2] * 6]
    two = [*((k, x) for k, x in enumerate(fourteen)), (10, "\n".join(fourteen)), (11, "\n".join(fourteen))]
    assert [x[2] for x in sorted(got(spark, two))] == [0, 0, 0, 0, 0, 4]
    long = " ".join(f"u{j}" for j in range(26))
    three = [(0, "\n".join([fourteen[0], long, "own", long, fourteen[2]])), (1, "\n".join(["o", long, fourteen[2], "t"]))]
    assert [x[2] for x in sorted(got(spark, three))] == [0, 2]
    assert d.patience([0, 1, 9, 1, 2], [8, 1, 2, 7]) == [(3, 1), (4, 2)]


def test_columns_of_clashing_names(spark):
    a = "\n".join(LONG[:5])
    rows = [(1, a, 1, 2, 3, 4, 5, 6), (2, a, 7, 8, 9, 10, 11, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, th int, `drop` int, done int, _lines int, ID_ int")
    out = d.dedup_lines(docs)
    assert out.columns == [*docs.columns, "__lines", "_dropped", "_emptied"]
    assert sorted(tuple(r)[2:8] for r in out.collect()) == sorted(r[2:] for r in rows)
    assert sorted(map(repr, d.deduplicated(docs).collect())) == sorted(map(repr, docs.where("doc_id = 1").collect()))


def exhaustive(docs, min_words):
    """Lines in a block of enough words that any earlier document has, over all pairs and blocks."""
    gone = {}
    for k, lines in docs.items():
        gone[k] = set()
        for e, other in docs.items():
            if e < k:
                have = {tuple(other[i:j]) for i in range(len(other)) for j in range(i + 1, len(other) + 1)}
                for i in range(len(lines)):
                    for j in range(i + 1, len(lines) + 1):
                        if sum(len(x.split()) for x in lines[i:j]) >= min_words and tuple(lines[i:j]) in have:
                            gone[k].update(range(i, j))
    return gone


def test_moved_and_repeated_blocks_against_all_pairs(spark):
    rng = random.Random(12)
    lines = [f"l{k} " + "w " * rng.randrange(4) for k in range(14)]
    lines = [x.strip() for x in lines]
    for _ in range(6):
        docs = {}
        for k in range(25):
            blocks = [lines[(s := rng.randrange(14)) : s + rng.randrange(1, 5)] for _ in range(rng.randrange(1, 5))]
            rng.shuffle(blocks)
            docs[k] = [x for b in blocks for x in b * rng.choice([1, 1, 2])]
        want = exhaustive(docs, 6)
        for k, text, dropped, _ in got(spark, [(k, "\n".join(v)) for k, v in docs.items()], min_words=6):
            assert dropped == len(want[k])
            assert (text.split("\n") if text else []) == [x for i, x in enumerate(docs[k]) if i not in want[k]]


def test_many_blocks_in_reverse_order():
    """More rounds of alignment than ROUNDS would be needed; the rest go one by one."""
    import struct

    runs = [(struct.pack("<qi", k, 30), [k * 2], [(99 - k) * 2]) for k in range(100)]
    assert d.repeated_lines(runs, 25) == [k * 2 for k in range(100)]


def test_nothing_goes_without_alignment(monkeypatch):
    import struct

    runs = [(struct.pack("<qiqi", 1, 13, 2, 13), [0], [4])]
    assert d.repeated_lines(runs, 25) == [4, 5]
    monkeypatch.setattr(d, "patience", lambda a, b: [])
    assert d.repeated_lines(runs, 25) == []
