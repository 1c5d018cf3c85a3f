"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

Equal lines are merged; the distinct ones are sets of character shingles. MinHash values are cut into bands; lines that
agree in most values of a band are candidates, whose Jaccard similarity is then computed exactly, unless it cannot reach
the limit by the rare shingles that two lines must share. Distributed union-find joins linked lines to components, and the first line of each component stays.
"""

from __future__ import annotations

import itertools
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitefacts.functions.common import bind
from sitefacts.llm.batches import unused
from sitefacts.llm.components import connected
from sitefacts.operators.rows import computed
from sitefacts.plans.scratch import staged

SHINGLE = 10  # characters
PERCENT = 80  # least similarity
# A band has one MinHash value more than a pair must share in it: with three bands of four values a pair at 80 % has three
# equal values in some band with probability 1 - (1 - 4 * 0.8**3 * 0.2 - 0.8**4)**3 = 99.4 %.
BANDS, BAND_ROWS = 3, 3
FIRST_CENTRES, MORE_CENTRES = 1, 16
FEW = 16  # lines of a bucket whose pairs are compared without asking for a rare shingle first
AT_ONCE = 4  # shingles of a line that one row holds on the way to its signature
BITMAP_BITS = 1 << 27  # most bits of the filter of wanted lines, 16 MB; 16 for each wanted line, if that is less


def shingle(units: Column, at: Column, size: int) -> Column:
    """A 64-bit hash of the shingle at a position of a line that is encoded in units of four bytes."""
    return F.xxhash64(F.substring(units, at * 4 + 1, F.lit(4 * size)))


def last_shingle(units: Column, size: int) -> Column:
    """The position of the last shingle. A line shorter than a shingle is its own only one."""
    return F.greatest(F.shiftright(F.length(units), 2) - size, F.lit(0))


def shingles(units: Column, size: int) -> Column:
    """All character shingles of an encoded line, as hashes."""
    starts = F.sequence(F.lit(1), last_shingle(units, size) * 4 + 1, F.lit(4))
    return F.transform(starts, lambda start: F.xxhash64(F.substring(units, start, F.lit(4 * size))))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))


def lines_of(rows: DataFrame) -> DataFrame:
    """``(id, row, pos, line, k1, k2)``: lines with a letter or digit, trimmed. Two hashes name equal lines."""
    every = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.col("line")
    blank = F.lit(False)
    for c in (" ", "\t", "\r"):
        blank = blank | line.startswith(c) | line.endswith(c)
    trimmed = every.where(line.rlike(r"[\p{L}\p{N}]")).withColumn("line", F.when(blank, F.btrim(line, F.lit(" \t\r"))).otherwise(line))
    return trimmed.select("id", "row", "pos", "line", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"))


def signatures(lines: DataFrame, size: int, hashes: int) -> DataFrame:
    """MinHash values ``m0, m1, ...`` of each distinct line, and ``weight``, how often it occurs.

    Equal lines have equal values, so lines are merged by their values, and no text is shuffled.
    Signatures are made of all the shingles that the exact comparison uses, in every line, some shingles to a row. One
    hash of each is computed; an exclusive-or and a product with random constants, modulo 2**32, give the permutations.
    """
    draw = random.Random(17)
    low = F.lit((1 << 32) - 1)
    draws = [(draw.randrange(1 << 32), draw.randrange(1, 1 << 31, 2)) for _ in range(hashes)]
    encoded = lines.select("k1", "k2", F.encode("line", "UTF-32").alias("units"))
    spread = encoded.withColumn("last", last_shingle(F.col("units"), size)).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(AT_ONCE))))
    some = [shingle(F.col("units"), F.least(F.col("at") + j, F.col("last")), size).bitwiseAND(low).alias(f"h{j}") for j in range(AT_ONCE)]
    hashed = spread.select("k1", "k2", (F.col("at") == 0).cast("bigint").alias("weight"), *some)

    def permuted(mask: int, odd: int) -> list[Column]:
        return [(F.col(f"h{j}").bitwiseXOR(F.lit(mask)) * F.lit(odd).cast("bigint")).bitwiseAND(low) for j in range(AT_ONCE)]

    return hashed.groupBy("k1", "k2").agg(F.sum("weight").alias("weight"), *[F.min(F.least(*permuted(*d))).alias(f"m{i}") for i, d in enumerate(draws)])


def bucket_members(lines: DataFrame, size: int, bands: int, band_rows: int) -> DataFrame:
    """``(bucket, k1, weight, rank, centre)`` of the buckets with several lines, numbered from 1 within each, the most frequent first.

    That is the ``centre`` of its bucket. A frequent line is what rarer ones are variants of, so it links most of them in the first round. A line is in one bucket for every choice of ``band_rows`` of the ``band_rows + 1`` values of a band.
    """
    values = band_rows + 1
    signed = signatures(lines, size, bands * values)
    chosen = [(b, c) for b in range(bands) for c in itertools.combinations(range(values), band_rows)]
    keys = [F.xxhash64(F.lit(k), *[F.col(f"m{b * values + i}") for i in c]) for k, (b, c) in enumerate(chosen)]
    placed = signed.select("k1", "weight", F.explode(F.array(*keys)).alias("bucket"))
    within = Window.partitionBy("bucket").orderBy(F.desc("weight"), F.asc("k1"))
    ranked = placed.withColumn("rank", F.row_number().over(within)).withColumn("next", F.lead("k1").over(within)).withColumn("centre", F.first("k1").over(within))
    return ranked.where("rank > 1 or next is not null").select("bucket", "k1", "weight", "rank", "centre")


def wanted_lines(lines: DataFrame, wanted: DataFrame, most_bits: int) -> DataFrame:
    """The distinct lines ``(k1, line)`` among ``wanted (k1)``.

    A bitmap of hashed names keeps most other lines out of the shuffle; the join decides. Beyond ``most_bits`` it only
    lets more lines through.
    """
    bits = 1 << 15
    needed = 16 * wanted.count()
    while bits < min(needed, most_bits):
        bits *= 2
    place = F.pmod("k1", F.lit(bits)).cast("bigint")
    maps = wanted.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("map")
    )
    marked = lines.select("k1", "k2", "line", place.alias("place")).withColumn("part", F.expr("bitmap_bucket_number(place)"))
    byte = F.conv(F.hex(F.expr("substring(map, cast(bitmap_bit_position(place) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.expr("cast(bitmap_bit_position(place) % 8 as int)")
    likely = marked.join(F.broadcast(maps), "part").where(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1)
    found = likely.groupBy("k1", "k2").agg(F.first("line").alias("line"))
    return found.join(wanted, "k1", "left_semi").select("k1", "line")


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose lines have at least ``percent`` per cent of their shingles in common.

    There are few lines ``a`` with many pairs each: their sets are made once, before the join that meets them. A line
    ``b`` that is too short for any such set goes at once, and one that holds too little of it before its own repeats
    are taken out; its shingles are made once for each other pair.
    """
    centres = texts.join(pairs.select(F.col("a").alias("k1")).distinct(), "k1", "left_semi")
    of_line = lambda line: bind(F.encode(line, "UTF-32"), lambda units: F.array_distinct(shingles(units, size)))
    sets = computed(centres, x=of_line("line")).select(F.col("k1").alias("a"), "x")
    met = pairs.join(texts.toDF("b", "line"), "b").join(sets, "a")

    def alike(y: Column) -> Column:
        """``y`` may hold repeats. All sets that reach the limit have that share of ``x`` in common at least."""
        reach = lambda both: (both * 100 >= F.size("x") * percent) & (both * (100 + percent) >= (F.size("x") + F.size(F.array_distinct(y))) * percent)
        return bind(F.size(F.array_intersect("x", y)), reach)

    long_enough = F.greatest(F.char_length("line") - (size - 1), F.lit(1)) * 100 >= F.size("x") * percent
    similar = F.when(long_enough, bind(bind(F.encode("line", "UTF-32"), lambda units: shingles(units, size)), alike)).otherwise(False)  # shared / (sizes - shared) >= percent / 100
    return met.where(similar).select("a", "b")


def shared_shingles(rest: DataFrame, size: int, percent: int) -> DataFrame:
    """``(bucket, k1, rank, n, after)``: the lines ``rest (k1, line, weight)`` by the shingles on which they may be alike.

    All shingles have one order, the rarest among these lines first. Lines of ``n`` and ``m`` shingles that reach
    ``percent`` have so many in common that their first ``n - ceil(n * percent / 100) + 1`` and as many by ``m`` share
    one. So no linked pair is lost, while variants of one line, whose own shingles are the rare ones, do not meet by
    what all of them hold. A shingle that occurs once has no other line; only its place in the order counts. ``after``
    counts the line's shingles of several occurrences that come later than the shared one.
    """
    encoded = rest.select("k1", F.encode("line", "UTF-32").alias("units")).withColumn("last", last_shingle(F.col("units"), size))
    hashed = encoded.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("last")))).select("k1", shingle(F.col("units"), F.col("at"), size).alias("bucket"))
    often = hashed.withColumn("often", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where("often > 1")
    of_line = Window.partitionBy("k1")
    placed = often.withColumn("place", F.dense_rank().over(of_line.orderBy("often", "bucket")))  # a repeat within a line has the place of the first
    counted = placed.withColumn("found", F.count(F.lit(1)).over(of_line)).withColumn("kinds", F.max("place").over(of_line))
    sizes = encoded.select("k1", (F.col("last") + 1).alias("total")).join(rest.select("k1", "weight"), "k1")
    single = F.col("total") - F.col("found")
    known = counted.join(sizes, "k1").withColumn("single", single).withColumn("n", F.col("single") + F.col("kinds"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("single")
    kept = known.where(F.col("place") <= first).select("bucket", "k1", "weight", F.col("n").cast("bigint").alias("n"), (F.col("kinds") - F.col("place")).alias("after")).distinct()
    within = Window.partitionBy("bucket").orderBy(F.desc("weight"), F.asc("k1"))
    ranked = kept.withColumn("rank", F.row_number().over(within)).withColumn("next", F.lead("k1").over(within))
    return ranked.where("rank > 1 or next is not null").select("bucket", "k1", "rank", "n", "after")


def may_reach(percent: int) -> str:
    """Whether lines ``x`` and ``y`` may have ``percent`` in common if the shingle at hand is the first that they share.

    Then they share it and no more than either has left after it. Linked lines fulfil this at the first of theirs.
    """
    return f"(1 + least(x.after, y.after)) * {100 + percent} >= (x.n + y.n) * {percent}"


def still_open(members: DataFrame, roots: DataFrame, least: int) -> DataFrame:
    """``members`` with the ``root`` of each, in the buckets of more than ``least`` lines that are not all of one component."""
    labelled = members.join(roots.withColumnRenamed("node", "k1"), "k1", "left").withColumn("root", F.coalesce("root", "k1"))
    span = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("rank").alias("most"))
    buckets = span.where((F.col("x") != F.col("y")) & (F.col("most") > least)).select("bucket")
    return staged(labelled.join(buckets, "bucket", "left_semi"), "line-open")


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots (node, root)`` after more ``links (a, b)``: only the components that these join are looked at."""
    if links.isEmpty():
        return roots
    of_a, of_b = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    moved = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    more = connected(moved, "line-components")
    known = roots.join(more.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return staged(known.unionByName(more.join(roots, "node", "left_anti")), "line-roots")


def line_links(lines: DataFrame, size: int, percent: int, bands: int, band_rows: int, bits: int) -> DataFrame:
    """``(k1, root)`` of the distinct lines that are linked to others.

    Linked are the lines that share a bucket and reach ``percent``. The most frequent line of each bucket is compared
    with the others. Then all pairs that are not in one component are compared in buckets of at most ``FEW`` lines. In
    larger ones they are compared if they share one of their rare shingles too, as all do that reach ``percent``: in
    rounds, the most frequent line of a shingle with the others, then the next 15 with those after them, and so on.
    Lines have the same order everywhere, and no pair is compared twice. Components only grow, so what is not open in a
    round is not looked at again.
    """
    members = staged(bucket_members(lines, size, bands, band_rows), "line-buckets")
    texts = staged(wanted_lines(lines, staged(members.select("k1").distinct(), "line-wanted"), bits), "line-texts")
    compared = staged(members.where("rank > 1").select(F.col("centre").alias("a"), F.col("k1").alias("b")).distinct(), "line-pairs")
    roots = connected(staged(verified(compared, texts, size, percent), "line-links"), "line-components")

    def linked(pairs: DataFrame) -> DataFrame:
        return with_links(roots, staged(verified(pairs, texts, size, percent), "line-links"))

    left = still_open(members.drop("centre"), roots, 2)
    if left.isEmpty():
        return roots.withColumnRenamed("node", "k1")
    few = left.join(left.groupBy("bucket").agg(F.max("rank").alias("most")).where(F.col("most") <= FEW), "bucket", "left_semi")
    pairs = few.alias("x").join(few.alias("y"), F.expr("x.bucket = y.bucket and x.rank > 1 and y.rank > x.rank and x.root != y.root"))
    pairs = staged(pairs.select(F.col("x.k1").alias("a"), F.col("y.k1").alias("b")).distinct().join(compared, ["a", "b"], "left_anti"), "line-pairs")
    compared = compared.unionByName(pairs)
    roots = linked(pairs)

    left = still_open(left.drop("root"), roots, FEW)
    if left.isEmpty():
        return roots.withColumnRenamed("node", "k1")
    own = staged(left.groupBy("k1").agg(F.first("weight").alias("weight"), F.collect_list("bucket").alias("buckets")), "line-rest")  # a few buckets each
    shared = staged(shared_shingles(texts.join(own, "k1").select("k1", "line", "weight"), size, percent), "line-shingles")
    low, high = 0, FIRST_CENTRES
    left = still_open(shared, roots, 1)
    while not left.isEmpty():
        centres = left.where((F.col("rank") > low) & (F.col("rank") <= high)).alias("x")
        others = left.where(F.col("rank") > low + 1).alias("y")
        pairs = others.join(centres, F.expr(f"x.bucket = y.bucket and y.rank > x.rank and x.root != y.root and {may_reach(percent)}"))
        pairs = pairs.select(F.col("x.k1").alias("a"), F.col("y.k1").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
        met = pairs.join(own.select(F.col("k1").alias("a"), F.col("buckets").alias("x")), "a").join(own.select(F.col("k1").alias("b"), F.col("buckets").alias("y")), "b")
        pairs = staged(met.where(F.arrays_overlap("x", "y")).select("a", "b"), "line-pairs")
        compared = compared.unionByName(pairs)
        roots = linked(pairs)
        low, high = high, high * MORE_CENTRES
        left = still_open(left.drop("root"), roots, low + 1)
    return roots.withColumnRenamed("node", "k1")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """All columns of ``docs`` with repeated lines taken out of ``text_col``, and ``dropped``, their positions.

    Lines are what newlines separate; white space at their ends does not count, and lines without a letter or digit
    stay. Equal lines, and lines whose shingle sets have at least ``percent`` per cent in common, are linked. Of a
    component the line of the smallest ``(id, row, position)`` stays; null ids come first. Repeated rows are documents
    of their own. A null text stays null, an empty one empty; a text may become empty. A line shorter than a shingle
    is its own only shingle. Pairs at ``percent`` meet by their signatures with the probability stated above for 80, pairs
    that are more alike more often; of all that meet, those are compared in full that an exact bound does not rule out. ``docs`` must give the same rows in the same partitions when it is read again, as a table
    in files does; ``dropped`` replaces a column of that name.
    """
    lines = lines_of(numbered(docs, id_col, text_col))
    roots = line_links(lines, size, percent, bands, band_rows, bits)
    places = staged(lines.select("id", "row", "pos", "k1", "k2"), "line-places")
    linked = places.join(roots, "k1", "left").select("id", "row", "pos", F.coalesce("root", "k1").alias("r1"), F.when(F.col("root").isNull(), F.col("k2")).otherwise(0).alias("r2"))
    here = F.struct("id", "row", "pos")
    firsts = linked.groupBy("r1", "r2").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = linked.join(firsts.select("r1", "r2", F.col("first.row").alias("fr"), F.col("first.pos").alias("fp")), ["r1", "r2"])
    gone = gone.where("row != fr or pos != fp").groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("gone"))

    row, positions = unused("line_row", docs.columns), unused("line_gone", docs.columns)
    whole = docs.drop("dropped").withColumn(row, F.monotonically_increasing_id())
    joined = whole.join(gone.toDF(row, positions).hint("shuffle_hash"), row, "left").drop(row)  # texts need no sort: a task holds the positions of its rows

    def remaining(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(positions))
        return F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")

    cut = bind(F.split(F.col(text_col).cast("string"), "\n"), remaining)  # split once, not once for each line
    text = F.when(F.col(positions).isNull(), F.col(text_col)).otherwise(cut)
    return joined.withColumn(text_col, text).withColumn("dropped", F.coalesce(positions, F.array().cast("array<int>"))).drop(positions)
