"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has cells in three equal parts. A paragraph's digest falls into one cell of each part, which counts
it and adds its digest and a check of it by exclusive or. The sketch of one text less that of another holds only the
paragraphs in which they differ, with signs. A cell with one of those left, as its
check tells, gives up its digest, which is then taken out of its two other cells, and so on. If cells are left over,
the sketches were too small: larger ones are made, first in blocks of digests by hash, then with more cells a block.
Everything is a column expression: no Python runs on rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakecat.llm.common import small, text_or_empty
from lakecat.operators.sequence import with_sequence
from lakecat.session import written

#: A paragraph is a line; of a longer line, this much and as much again at most: to the end of the line or sentence, else to
#: the next white space, else all of it. Classes are spelt out, so that Java and Python read the expression alike.
LONG_LINE = 100
ENDS, SPACES = r".!?…。！？｡．؟۔।॥։።။", r" \t\x0b\f\r\u3000"
PARAGRAPH = (
    r"([^\n]{%d}(?:[^\n%s]{0,%d}+(?:[%s]{1,8}|(?![^\n]))|[^\n%s]{0,%d}+[%s]|[^\n]{0,%d})|[^\n]+)"
    % (LONG_LINE, ENDS, LONG_LINE, ENDS, SPACES, LONG_LINE - 1, SPACES, LONG_LINE))
CELLS = 24  # of a text's own fingerprint
#: A retry has blocks of this many digests on average, and this many cells a block at first, doubled so often on failure.
BLOCK_DIGESTS, RETRY_CELLS, DOUBLINGS = 16, 48, 8
ROUNDS = 12  # of peeling; each takes out all digests that are alone in a cell
#: Document ids of one range bucket.
IDS_PER_BUCKET = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column, repeats: bool = False) -> Column:
    """The distinct paragraph digests of a text, sorted; none for an empty text.

    With `repeats`, the second and later ones of equal paragraphs have digests of their own, by their number.
    """
    found = F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH)), lambda p: F.xxhash64(p))
    return let(F.sort_array(found), numbered) if repeats else F.array_sort(F.array_distinct(found))


def numbered(found: Column) -> Column:
    """Sorted digests with repeats as a sorted set: each run keeps its first, the others are hashed with their number."""
    places_of = F.sequence(F.lit(0), F.size(found) - 1)
    firsts = F.filter(places_of, lambda i: (i == 0) | (F.get(found, i) != F.get(found, i - 1)))

    def runs(starts: Column) -> Column:
        return F.sort_array(F.flatten(F.transform(starts, lambda start, j: let(F.get(found, start), lambda d: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(starts, j + 1), F.size(found)) - start - 1),
            lambda k: F.when(k == 0, d).otherwise(F.xxhash64(d, k)))))))

    distinct = F.size(F.array_distinct(found)) == F.size(found)
    return F.when(distinct, found).otherwise(let(firsts, runs))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(0x5EED))


def places(digest: Column, cells: Column, salt: Column) -> list[Column]:
    """The digest's cells: one in each third."""
    third = F.floor(cells / 3).cast("int")
    mixed = F.xxhash64(digest, salt)
    return [F.pmod(F.shiftright(mixed, 20 * i), third).cast("int") + F.lit(i) * third for i in range(3)]


def cell(n: Column, key: Column, sum_: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.cast("long").alias("k"), sum_.cast("long").alias("c"))


def number(value: int | Column) -> Column:
    return F.lit(value) if isinstance(value, int) else value


def sketch(found: Column, cells: int | Column, salt: int | Column = 0) -> Column:
    """The cells of an array of digests."""
    cells, salt = number(cells), number(salt)
    placed = F.transform(found, lambda d: F.struct(
        d.alias("d"), check(d).alias("c"), *[p.alias(f"p{i}") for i, p in enumerate(places(d, cells, salt))]))

    def gathered(items: Column) -> Column:
        def one(at: Column) -> Column:
            here = F.filter(items, lambda x: (x["p0"] == at) | (x["p1"] == at) | (x["p2"] == at))
            return F.aggregate(here, cell(F.lit(0), F.lit(0), F.lit(0)), lambda acc, x: cell(
                acc["n"] + 1, acc["k"].bitwiseXOR(x["d"]), acc["c"].bitwiseXOR(x["c"])))

        return F.transform(F.sequence(F.lit(0), cells - 1), one)

    return let(placed, gathered)


def subtracted(one: Column, other: Column) -> Column:
    return F.zip_with(one, other, lambda a, b: cell(
        a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["c"].bitwiseXOR(b["c"])))


def peeled(difference: Column, cells: int | Column, salt: int | Column = 0) -> Column:
    """The digests (k) that a difference of sketches holds, each with its sign (n: 1 or -1, the text that has it).

    Null if peeling ends before the cells are empty.
    """
    cells, salt = number(cells), number(salt)

    def alone(state: Column) -> Column:
        ripe = F.filter(state, lambda x: (F.abs(x["n"]) == 1) & (x["c"] == check(x["k"])))
        return F.array_distinct(F.transform(ripe, lambda x: F.struct(
            x["n"].alias("n"), x["k"].alias("k"), x["c"].alias("c"),
            *[p.alias(f"p{i}") for i, p in enumerate(places(x["k"], cells, salt))])))

    def without(state: Column, out: Column) -> Column:
        def one(x: Column, at: Column) -> Column:
            here = F.filter(out, lambda o: (o["p0"] == at) | (o["p1"] == at) | (o["p2"] == at))
            return F.aggregate(here, x, lambda acc, o: cell(
                acc["n"] - o["n"], acc["k"].bitwiseXOR(o["k"]), acc["c"].bitwiseXOR(o["c"])))

        return F.transform(state, one)

    def step(acc: Column, _: Column) -> Column:
        return F.when(acc["done"], acc).otherwise(let(alone(acc["cells"]), lambda out: F.when(
            F.size(out) == 0, F.struct(acc["cells"].alias("cells"), acc["found"].alias("found"), F.lit(True).alias("done"))
        ).otherwise(F.struct(
            without(acc["cells"], out).alias("cells"),
            F.concat(acc["found"], F.transform(out, lambda o: F.struct(o["n"].alias("n"), o["k"].alias("k")))).alias("found"),
            F.lit(False).alias("done")))))

    none = F.array().cast("array<struct<n:int,k:bigint>>")
    start = F.struct(difference.alias("cells"), none.alias("found"), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return let(end, lambda e: F.when(
        ~F.exists(e["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["c"] != 0)), e["found"]))


def lower_bound(found: Column, bound: Column) -> Column:
    """How many of some sorted digests are below a bound, by halving."""
    def step(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        below = F.get(found, middle) < bound
        return F.when(at["low"] >= at["high"], at).otherwise(F.struct(
            F.when(below, middle + 1).otherwise(at["low"]).alias("low"), F.when(below, at["high"]).otherwise(middle).alias("high")))

    start = F.struct(F.lit(0).alias("low"), F.size(found).alias("high"))
    steps = F.ceil(F.log2(F.size(found) + 1)).cast("int") + 1
    return F.aggregate(F.sequence(F.lit(1), steps), start, step)["low"]


def differences(one: Column, other: Column, own: Column, others: Column) -> Column:
    """The digests (k) in one of two sorted sets only, with signs (n). `own` and `others` are their fingerprint cells.

    First by the fingerprints; on failure by sketches of blocks, which are ranges of digests, and in a block by ever more
    cells with new places. Should the largest fail, the block's digests are compared as they are.
    """
    def signed(digests_: Column, sign: int) -> Column:
        return F.transform(digests_, lambda d: F.struct(F.lit(sign).alias("n"), d.alias("k")))

    def block(a: Column, b: Column) -> Column:
        def retry(acc: Column, i: Column) -> Column:
            cells = (F.lit(RETRY_CELLS) * F.pow(F.lit(2), i)).cast("int")
            return F.coalesce(acc, peeled(subtracted(sketch(a, cells, i + 1), sketch(b, cells, i + 1)), cells, i + 1))

        unknown = F.lit(None).cast("array<struct<n:int,k:bigint>>")
        tried = F.aggregate(F.sequence(F.lit(0), F.lit(DOUBLINGS)), unknown, retry)
        return F.coalesce(tried, F.concat(signed(F.array_except(a, b), 1), signed(F.array_except(b, a), -1)))

    def in_blocks(x: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil((F.size(x["a"]) + F.size(x["b"])) / BLOCK_DIGESTS)).cast("long")

        def cut(blocks: Column) -> Column:
            def ends(found: Column) -> Column:
                def end(at: Column) -> Column:
                    bound = F.shiftleft(F.ceil(at.cast("long") * (1 << 32) / blocks).cast("long") - (1 << 31), 32)
                    return F.when(at >= blocks, F.size(found)).otherwise(lower_bound(found, bound))

                return F.transform(F.sequence(F.lit(0).cast("long"), blocks), end)

            return F.struct(ends(x["a"]).alias("a"), ends(x["b"]).alias("b"), blocks.alias("blocks"))

        def gathered(e: Column) -> Column:
            def one_block(at: Column) -> Column:
                def part(name: str) -> Column:
                    low, high = F.get(e[name], at), F.get(e[name], at + 1)
                    return F.slice(x[name], low + 1, high - low)

                held = F.struct(part("a").alias("a"), part("b").alias("b"))
                return let(held, lambda h: block(h["a"], h["b"]))

            return F.flatten(F.transform(F.sequence(F.lit(0), (e["blocks"] - 1).cast("int")), one_block))

        return let(let(count, cut), gathered)

    both = F.struct(one.alias("a"), other.alias("b"), subtracted(own, others).alias("cells"))
    return let(both, lambda x: F.coalesce(peeled(x["cells"], CELLS), in_blocks(x)))


def differing(one: Column, other: Column, own: Column, others: Column) -> Column:
    """How many digests are in one of two sorted sets only."""
    return F.size(differences(one, other, own, others))


def likeness(one: Column, other: Column, own: Column, others: Column) -> Column:
    """Paragraphs in common over paragraphs in all, from the differing ones; 1 for two texts without any."""
    total = F.size(one) + F.size(other)
    return F.when(total == 0, F.lit(1.0)).otherwise(let(
        differing(one, other, own, others), lambda d: (total - d) / (total + d)))


def written_out(cells: Column) -> Column:
    """A fingerprint as text: count, key and check of every cell in hexadecimal."""
    return F.array_join(F.transform(cells, lambda x: F.concat(
        F.lower(F.hex(x["n"])), F.lit("."), F.lower(F.hex(x["k"])), F.lit("."), F.lower(F.hex(x["c"])))), "/")


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text and next_text, the text of the next row by descending key; the first row follows the last.

    Rows of one key follow each other by the hash of their texts; rows without a key come last. Keys are
    dealt out in ranges of `IDS_PER_BUCKET`, so texts are shuffled once, and the last row of a range gets its next from
    a table of the ranges' first rows.
    """
    ranges = F.coalesce(F.floor(F.col(key) / IDS_PER_BUCKET).cast("long"), F.lit(-(1 << 62)))
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"), ranges.alias("bucket"))
    highest = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    numbered = written(with_sequence(highest, "bucket", out="pos"), "fingerprint-ranges")
    count = numbered.count()
    after = numbered.select("bucket", "top", F.pmod(F.col("pos") + 1, F.lit(max(1, count))).alias("pos")).join(
        numbered.select("pos", F.col("bucket").alias("target")), "pos")
    tops = small(after.select(F.col("bucket").alias("b"), "top", "target"))
    firsts = (
        rows.join(tops, (rows["bucket"] == F.col("b")) & rows["doc_id"].eqNullSafe(F.col("top")))
        .groupBy("target").agg(F.min_by("text", F.xxhash64("text")).alias("first_text"))
    )
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    led = rows.withColumn("led", F.lead("text").over(order))
    return led.join(firsts, (F.col("bucket") == F.col("target")) & F.col("led").isNull(), "left").select(
        "doc_id", "text", F.coalesce("led", "first_text").alias("next_text"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", repeats: bool = False) -> DataFrame:
    """Every text's fingerprint, and how like it is to its edited text and to the next document.

    The edited text has the last half (rounded down) of the code points replaced by as many of the first of the next
    document, or all it has. Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. Null
    texts are empty; an empty text's fingerprint has empty cells. Equal texts have equal fingerprints. With `repeats`,
    a paragraph counts as often as it occurs.
    """
    rows = with_next(docs, key, text)
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), size - half), F.left(F.col("next_text"), half))
    three = F.struct(
        digests(F.col("text"), repeats).alias("own"), digests(F.col("edited"), repeats).alias("edited"),
        digests(F.col("next_text"), repeats).alias("next"))

    def results(x: Column) -> Column:
        cells = F.struct(
            sketch(x["own"], CELLS).alias("own"), sketch(x["edited"], CELLS).alias("edited"),
            sketch(x["next"], CELLS).alias("next"))
        return let(cells, lambda c: F.struct(
            written_out(c["own"]).alias("fingerprint"), written_out(c["edited"]).alias("edited_fingerprint"),
            likeness(x["own"], x["edited"], c["own"], c["edited"]).alias("near_edited"),
            likeness(x["own"], x["next"], c["own"], c["next"]).alias("near_next")))

    return rows.withColumn("edited", edited).select(
        "doc_id", size.cast("long").alias("n_chars"), "edited", let(three, results).alias("made")).select(
        "doc_id", "n_chars", "edited", "made.*")
