from __future__ import annotations

import random
import re

import pytest

from sitefacts.llm import line_dedup as ld


def grams(line, size=10):
    return {line[i : i + size] for i in range(len(line) - size + 1)} if len(line) >= size else {line}


def brute(rows):
    """Kept text and dropped positions of each row, by comparing all pairs of distinct lines."""
    lines = sorted({x.strip(" \t\r") for _, t in rows if t is not None for x in t.split("\n") if re.search(r"[^\W_]", x)})
    sets, root = [grams(x) for x in lines], list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    group = {x: find(i) for i, x in enumerate(lines)}
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out.append((doc, None, []))
            continue
        kept, dropped = [], []
        for pos, line in enumerate(text.split("\n")):
            own = group.get(line.strip(" \t\r"))
            if own is not None and own in seen:
                dropped.append(pos)
            else:
                seen.add(own) if own is not None else None
                kept.append(line)
        out.append((doc, "\n".join(kept), dropped))
    return out


def corpus(seed, n):
    random.seed(seed)
    words = ["".join(random.choices("abcdefghijklmnop", k=random.randint(2, 7))) for _ in range(300)]
    bases = [random.choices(words, k=random.choice([1, 3, 12, 30, 60])) for _ in range(25)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(random.randint(1, 6)):
            line = list(random.choice(bases) if random.random() < 0.6 else random.choices(words, k=20))
            for _ in range(random.choice([0, 0, 1, 1, 3])):
                line[random.randrange(len(line))] = random.choice(words)
            lines.append(random.choice(["", "", " "]) + " ".join(line) + random.choice(["", "\r"]))
            lines += random.choice([[], [], ["---"], [""]])
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed, 120) + [(200, None), (201, ""), (202, "漢字 \U0001f600 and é"), (203, "x"), (204, "x"), (205, "--\n--"), (-1, "Y" * 40_000)]
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id bigint, text string, row int, k1 string").coalesce(3)
    found = ld.deduplicate(docs)
    assert found.columns == ["doc_id", "text", "row", "k1", "dropped"]
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in found.collect()) == sorted(brute(rows))


def test_large_bucket_of_unlike_lines_is_compared_in_full(spark, monkeypatch):
    """One row per band over tiny values: buckets hold many lines of no likeness, and no link may be lost."""
    rows = corpus(5, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = ld.deduplicate(docs, bands=4, band_rows=1)
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in found.collect()) == sorted(brute(rows))


def test_repeated_rows_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same line here\nother words"), (1, "same line here\nother words"), (None, "other words")], "doc_id bigint, text string").coalesce(1)
    found = sorted((str(r["doc_id"]), r["text"]) for r in ld.deduplicate(docs).collect())
    assert found == [("1", ""), ("1", "same line here"), ("None", "other words")]
    assert ld.deduplicate(docs.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = ld.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def linked(spark, lines):
    """The number of lines that stay of these, each in a document of its own."""
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").coalesce(1)
    return sum(r["text"] != "" for r in ld.deduplicate(docs).collect())


def test_lines_of_long_words_meet_their_copies_with_a_space(spark):
    """Lines on either side of any word length are signed alike."""
    for a, b in (("internationalization", "internationalization:"), ("Rechtsschutzversicherungsgesellschaft AG", "Rechtsschutzversicherungsgesellschaft AG!"),
                 ("Donaudampfschifffahrtsgesellschaft Hafen", "Donaudampfschifffahrtsgesellschaft Hafen."), ("x" * 21 + "abcdefghijklmnopqrs", "x" * 21 + "abcdefghijklmnopqrs t")):
        assert linked(spark, [a, b]) == 1, a


def test_character_edits_of_short_lines_against_all_pairs(spark):
    """Lines of 1 to 4 words with one character changed: all that are alike enough by brute force are linked."""
    random.seed(11)
    lines = ["Frequently Asked Questions", "Frequently Asked Questions:", "Telecommunications Infrastructure", "telecommunications Infrastructure",
             "Copyright Acme Corporation 2021", "Copyright Acme Corporation 2022", "Internationalization", "internationalization"]
    for _ in range(300):
        words = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(8, 18))) for _ in range(random.randint(1, 4))]
        line = " ".join(words)
        at = random.choice([0, len(line) - 1, len(line)])
        lines += [line, line[:at] + "#" + line[at + 1 :]]
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in ld.deduplicate(docs).collect()) == sorted(brute(rows))


def test_hashed_shingles_are_those_of_the_line(spark):
    from pyspark.sql import functions as F

    lines = ["", "x", "abcdefghi", "abcdefghij", "abcdefghijk", "aaaaaaaaaaaaaaaaaaaa", "漢字😀 and é, ñandú 日本語 text", "q" * 3000 + "r"]
    rows = spark.createDataFrame([(i, t, list(grams(t))) for i, t in enumerate(lines)], "i int, line string, grams array<string>")
    found = rows.select("i", F.sort_array(F.array_distinct(ld.shingles(F.encode("line", "UTF-32"), 10))).alias("found"), F.sort_array(F.transform("grams", lambda g: F.xxhash64(F.encode(g, "UTF-32")))).alias("wanted"))
    assert all(r["found"] == r["wanted"] for r in found.collect())


def pair_at(words, length, percent, draw):
    """Two lines whose similarity is the least one that reaches the limit, by changing characters of the first."""
    line = ""
    while len(line) < length:
        line += draw.choice(words) + " "
    line, other = line[:length].strip(), line[:length].strip()
    while True:
        at = draw.randrange(len(other))
        changed = other[:at] + draw.choice("0123456789") + other[at + 1 :]
        both = grams(line), grams(changed)
        if 100 * len(both[0] & both[1]) < percent * len(both[0] | both[1]):
            return line, other
        other = changed


@pytest.mark.parametrize("length", [60, 129, 350, 2000])
def test_recall_of_pairs_near_the_limit(spark, length):
    """Candidates among pairs just above 80 %, whatever the length of the lines; README has the figures."""
    draw = random.Random(length)
    words = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(3000)]
    pairs = [p for p in (pair_at(words, length, 80, draw) for _ in range(400)) if p[0] != p[1]]
    lines = [(x, 2 * i + j) for i, p in enumerate(pairs) for j, x in enumerate(p)]
    found = ld.bucket_members(spark.createDataFrame([(x, i, i) for x, i in lines], "line string, k1 bigint, k2 bigint"), 10, ld.BANDS, ld.BAND_ROWS)
    met = {(a["k1"], b["k1"]) for own in _groups(found) for a in own for b in own if a["k1"] // 2 == b["k1"] // 2 and a["k1"] < b["k1"]}
    assert len(met) / len(pairs) >= 0.97


def _groups(members):
    by_bucket = {}
    for r in members.collect():
        by_bucket.setdefault(r["bucket"], []).append(r)
    return by_bucket.values()


def test_one_line_of_most_rows_and_clashing_names(spark):
    rows = [(i, f"the same line in every document of the table\nown line {i} {'z' * (i % 7)}{i * 7919}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as line_row", "2 as line_gone", "3 as dropped", "4 as k1", "5 as pos").coalesce(2)
    found = ld.deduplicate(docs)
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in found.collect()) == sorted(brute(rows))
    assert found.columns == ["doc_id", "text", "line_row", "line_gone", "k1", "pos", "dropped"]


def test_variants_of_one_line_are_not_compared_in_pairs(spark, monkeypatch):
    """Lines that differ from one another in a word each are alike but below the limit: pairs must not grow with their square."""
    draw = random.Random(23)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(60)]
    lines = []
    for i in range(240):
        own = list(words)
        for at in draw.sample(range(60), 12):
            own[at] = "".join(draw.choices("qrstuvwxyz", k=6))
        lines.append(" ".join(own))
        if i % 40 == 0:  # and one that is linked to it
            lines.append(lines[-1][:-1] + "#")
    counted, verified = [], ld.verified

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(ld, "verified", counting)
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = ld.deduplicate(docs)
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in found.collect()) == sorted(brute(rows))
    assert sum(counted) < 12 * len(lines)


def test_lines_of_small_buckets_are_compared_without_rare_shingles(spark, monkeypatch):
    """A few lines that are alike but mostly below the limit: their shingles are not dealt out and counted over all lines."""
    draw = random.Random(31)
    lines = []
    for _ in range(25):
        words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(30)]
        for _ in range(5):
            own = list(words)
            for at in draw.sample(range(30), draw.choice([1, 4, 4])):
                own[at] = "".join(draw.choices("qrstuvwxyz", k=6))
            lines.append(" ".join(own))
    counted, verified = [], ld.verified

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return verified(pairs, *rest)

    def refused(*_):
        raise AssertionError("shingles of small buckets are dealt out")

    monkeypatch.setattr(ld, "verified", counting)
    monkeypatch.setattr(ld, "shared_shingles", refused)
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = ld.deduplicate(docs)
    assert sorted((r["doc_id"], r["text"], r["dropped"]) for r in found.collect()) == sorted(brute(rows))
    assert len(counted) == 2 and counted[1] > 0 and sum(counted) <= 25 * 10


def test_signatures_shuffle_no_text(spark):
    """Equal lines are merged by their values; a text among them would be sorted and shuffled as a whole."""
    docs = spark.createDataFrame([(i, f"line of document {i % 5}\nthe same line") for i in range(20)], "doc_id bigint, text string").repartition(4)
    signed = ld.signatures(ld.lines_of(ld.numbered(docs, "doc_id", "text")), ld.SHINGLE, 12)
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and not re.search(r"Exchange[^\n]*\bline\b", plan)
    assert sorted(r["weight"] for r in signed.collect()) == [4] * 5 + [20]
