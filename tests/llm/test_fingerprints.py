import hashlib
import re

from pyspark.sql import functions as F

from lakecat.llm.fingerprints import CELLS, PARAGRAPH, differences, digests, differing, fingerprints, peeled, sketch, subtracted


def paragraphs(text):
    return set(re.findall(PARAGRAPH, text))


def alike(one, other):
    one, other = paragraphs(one), paragraphs(other)
    return len(one & other) / len(one | other) if one | other else 1.0


def check_rows(df, rows):
    """`rows`: (doc_id, text) in the order in which documents follow each other."""
    got = {(r["doc_id"], r["n_chars"], r["edited"]): r for r in fingerprints(df).collect()}
    prints = {}
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[key, len(text), edited]
        assert abs(r["near_edited"] - alike(text, edited)) < 1e-9 and abs(r["near_next"] - alike(text, after)) < 1e-9
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]


def test_documents(documents):
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.collect()), reverse=True)
    check_rows(documents, rows)


def test_odd_rows(odd, empty):
    keyed = odd.filter("doc_id <> 2").unionByName(odd.filter("doc_id = 2").limit(1))
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is not None), reverse=True)
    rows = [x for i, x in enumerate(rows) if x[0] != rows[i - 1][0]] + [(None, "no id at all")]
    check_rows(keyed.unionByName(odd.filter("doc_id IS NULL")), rows)
    assert fingerprints(odd).count() == odd.count() and fingerprints(empty).count() == 0


def test_far_ids_follow_each_other(spark):
    rows = [(key, f"line {key}\nsame\n{key % 3}") for key in (10 ** 15, 10 ** 12 + 5, 10 ** 12, 600, 511, 0, -4, -10 ** 13)]
    check_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_larger_sketches_after_failure(spark):
    one = "\n".join(f"paragraph {i}" for i in range(400))
    other = "\n".join(f"paragraph {i}" for i in range(150, 900))
    df = spark.createDataFrame([(one, other), (one, one), (one, ""), ("a\nb", "a\nc")], "one string, other string").select(
        digests(F.col("one")).alias("a"), digests(F.col("other")).alias("b"))
    small = peeled(subtracted(sketch(F.col("a"), CELLS), sketch(F.col("b"), CELLS)), CELLS)
    whole = differing(F.col("a"), F.col("b"), sketch(F.col("a"), CELLS), sketch(F.col("b"), CELLS))
    got = [(r[0] and len(r[0]), r[1]) for r in df.select(small, whole).collect()]
    assert got == [(None, 650), ([], 0), (None, 400), (2, 2)]


def test_peeling_recovers_the_digests(spark):
    """Both sides' own digests with their signs, from the fingerprints or from sketches of blocks."""
    texts = [("\n".join(f"p{i}" for i in range(a, b)), "\n".join(f"p{i}" for i in range(c, d)))
             for a, b, c, d in ((0, 40, 3, 42), (0, 900, 450, 2000), (0, 0, 0, 70), (5, 6, 5, 6))]
    df = spark.createDataFrame(texts, "one string, other string").select(
        digests(F.col("one")).alias("a"), digests(F.col("other")).alias("b"))
    found = differences(F.col("a"), F.col("b"), sketch(F.col("a"), CELLS), sketch(F.col("b"), CELLS))
    for r in df.select("a", "b", found.alias("d")).collect():
        a, b = set(r["a"]), set(r["b"])
        assert sorted((x["n"], x["k"]) for x in r["d"]) == sorted([(1, k) for k in a - b] + [(-1, k) for k in b - a])


def test_long_texts_take_time_in_proportion(spark):
    """A text of six megabytes: blocks are slices of the sorted digests."""
    import time

    long = "".join(f"line {i} of a very long text, as long as it takes for a paragraph\n" for i in range(90_000))
    started = time.perf_counter()
    rows = fingerprints(spark.createDataFrame([(1, long), (2, long[::-1])], "doc_id long, text string")).select(
        "n_chars", "near_edited", "near_next").collect()
    assert time.perf_counter() - started < 60 and {r["n_chars"] for r in rows} == {len(long)}
    assert all(0.3 < r["near_edited"] < 0.4 and r["near_next"] < 0.01 for r in rows)


def test_blocks_that_fail_are_doubled(spark):
    """Sketches too small at first: the same digests come out."""
    one, other = (F.transform(F.sequence(F.lit(a), F.lit(b)), lambda i: F.xxhash64(i)) for a, b in ((0, 300), (100, 400)))
    df = spark.range(1).select(F.array_sort(one).alias("a"), F.array_sort(other).alias("b"))
    cells = F.lit(6)
    assert df.select(peeled(subtracted(sketch(F.col("a"), cells, 3), sketch(F.col("b"), cells, 3)), cells, 3)).first()[0] is None
    many = F.lit(1536)
    assert len(df.select(peeled(subtracted(sketch(F.col("a"), many, 3), sketch(F.col("b"), many, 3)), many, 3)).first()[0]) == 200


def test_digest_of_the_edited_text(documents):
    r = fingerprints(documents).select("edited", F.sha2("edited", 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(r["edited"].encode()).hexdigest()


def test_texts_without_sentence_ends_share_paragraphs(spark):
    words, junk = "none of these words ends a sentence " * 60, "abcdefghij" * 400
    cjk, steps = "".join(f"第{i}句话没有别的标点。" for i in range(400)), "same words again " * 300
    rows = [(i, text) for i, text in enumerate([words, junk, cjk, "x" * 3_000, "=." * 2_000, "... " * 900, steps])]
    assert all(len(p) <= 208 for _, text in rows for p in re.findall(PARAGRAPH, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r["doc_id"]: r["near_edited"] for r in fingerprints(df, repeats=True).collect()}
    assert min(made.values()) > 0.2


def test_repeats_are_numbered(spark):
    rows = [("a\nb\na\na", "a\na\nc"), ("a\nb", "b\na"), ("", "x"), ("\n".join("r" * 5_000), "r")]
    df = spark.createDataFrame(rows, "one string, other string").select(
        digests(F.col("one"), True).alias("a"), digests(F.col("other"), True).alias("b"))
    common = [len(set(r["a"]) & set(r["b"])) for r in df.collect()]
    sizes = [(len(set(r["a"])), len(set(r["b"]))) for r in df.collect()]
    assert common == [2, 2, 0, 1] and sizes == [(4, 3), (2, 2), (0, 1), (5_000, 1)]
