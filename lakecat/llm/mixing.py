"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakecat.llm.common import WORD, seeded_unit, small, word_count
from lakecat.operators.sequence import with_sequence
from lakecat.session import written


def fill_level(sources: DataFrame, wanted: float, max_epochs: float) -> float:
    """The level L for which the sum of min(max_epochs * size, L * weight) is `wanted`.

    Each round clamps the sources that the level puts above their cap and spreads
    what they cannot take over the others by weight; the level only rises, and
    a round that clamps no further source ends it. `sources` has one row per
    source (size, weight); the rounds are sums over it. 0 if nothing can be taken.
    """
    cap = F.col("size") * F.lit(max_epochs)
    level = 0.0
    while True:
        over = cap < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("clamped"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if not row["free"]:
            return level
        raised = (wanted - row["clamped"]) / row["free"]
        if raised <= level:
            return level
        level = raised


def source_targets(
    docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5, max_epochs: float = 2.0,
) -> DataFrame:
    """One row per source: source, source_size (words), weight, target.

    Sources in code point order, null last, take the weights in turn. Targets sum to
    `share` of all words, none above `max_epochs` times its source's size.
    An empty table gives an empty table; a source without words gets target 0.
    """
    sizes = docs.select(F.col(source).alias("source"), word_count(text).alias("size"))
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("size")), "mix-sources")
    ranked = with_sequence(totals.withColumn("absent", F.col("source").isNull()), "absent", "source", out="pos")
    turn = F.array(*[F.lit(w) for w in weights])
    weighed = written(
        ranked.withColumn("weight", F.get(turn, (F.col("pos") % len(weights)).cast("int"))), "mix-weights")
    everything = weighed.agg(F.sum("size")).first()[0] or 0
    level = fill_level(weighed, share * everything, max_epochs)
    target = F.least(F.col("size") * F.lit(max_epochs), F.col("weight") * F.lit(level))
    return weighed.select("source", F.col("size").alias("source_size"), "weight", target.cast("double").alias("target"))


def repetitions(size: Column, source_size: Column, target: Column, unit: Column) -> tuple[Column, Column]:
    """How often a document is taken whole, and how many words of it once more.

    The fractional repetition rounds up or down by the document's seeded number,
    so a source's rounding errors cancel instead of adding up.
    """
    epochs = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    whole = F.floor(epochs)
    part = F.floor(size * (epochs - whole) + unit)
    return whole.cast("long"), part.cast("long")


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 8,
) -> DataFrame:
    """`docs` with `mix_size`, `mix_source_size`, `mix_target`, `mix_whole`, `mix_part`.

    Two passes over the texts (totals, then this), no shuffle of texts. Null text has size 0,
    null source is a source of its own, a null key draws like any other value; repeated rows draw alike.
    Input columns with the names above are replaced.
    """
    targets = source_targets(docs, text, source, weights, share, max_epochs)
    targets = small(targets.select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_total"),
        F.col("target").alias("_mix_target")))
    made = ("mix_size", "mix_source_size", "mix_target", "mix_whole", "mix_part")
    sized = docs.drop(*made).withColumn("mix_size", word_count(text))
    joined = sized.join(targets, F.col(source).eqNullSafe(F.col("_mix_source")))
    whole, part = repetitions(
        F.col("mix_size"), F.col("_mix_total"), F.col("_mix_target"), seeded_unit(seed, key))
    return (
        joined.withColumn("mix_whole", whole).withColumn("mix_part", part)
        .withColumnsRenamed({"_mix_total": "mix_source_size", "_mix_target": "mix_target"}).drop("_mix_source")
    )


#: Bits of a draw that one look at the draws resolves.
DRAW_BITS, LOOK_BITS = 64, 16


def last_draws(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source the draw at which the documents before it, in order of draws, hold the wanted words: source, draw, left.

    `rows` is a written table (source, draw, size); `wanted` has (source, words). Sums over ranges of draws find the range in
    which the words are reached, and closer looks resolve it to one draw, so no source is sorted or gathered. `left` words are
    still wanted of the rows with that draw. A source whose words do not reach what is wanted has the highest draw.
    """
    places = wanted.select("source", F.lit(0).cast("bigint").alias("prefix"), F.col("words").alias("left"))
    for look in range(DRAW_BITS // LOOK_BITS):
        shift = DRAW_BITS - LOOK_BITS * (look + 1)
        part = F.shiftrightunsigned("draw", shift)
        above = F.shiftrightunsigned(part, LOOK_BITS) if look else F.lit(0).cast("bigint")
        known = small(places.select(F.col("source").alias("_source"), "prefix", "left"))
        sums = (
            rows.withColumn("part", part).join(known, F.col("source").eqNullSafe(F.col("_source")) & (above == F.col("prefix")))
            .groupBy("source", "part", "left").agg(F.sum("size").alias("size")))
        before = F.coalesce(F.sum("size").over(
            Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        reached = sums.withColumn("before", before).filter("before <= left")
        places = written(reached.groupBy("source").agg(F.max_by(
            F.struct(F.col("part").alias("prefix"), (F.col("left") - F.col("before")).alias("left")), "part").alias("p")).select(
            "source", "p.prefix", "p.left"), "mix-draws")
    return places.select("source", F.col("prefix").alias("draw"), "left")


def first_words(text: Column, count: Column) -> Column:
    """The first words of a text with all white space before and between them."""
    spaced = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*" + WORD + ")"))
    return F.array_join(F.slice(spaced, 1, count), "")


def repeated(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 8, **options,
) -> DataFrame:
    """The mixture itself: the columns of `docs`, one row per repetition; each source's words are its target, rounded down.

    Every document is there as often as its source has whole epochs. For the fraction that is left, a draw that depends on seed,
    key and text picks documents that are there once more, whole, until their words are reached; the last of them is
    cut there, one document a source, and keeps its white space. Rows that repeat key and text share a draw, and as many of
    them count as are needed. Documents without words are in no mixture. `n_chars` follows, where there is one.
    """
    mixed = mix(docs, text, source, key, seed=seed, **options).filter("mix_size > 0").withColumn(
        "mix_draw", F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text)))
    epochs = F.col("mix_target") / F.col("mix_source_size")
    drawn = written(mixed.select(F.col(source).alias("source"), F.col("mix_draw").alias("draw"), F.col("mix_size").alias("size"),
                                 "mix_source_size", "mix_target"), "mix-rows")
    words = F.floor(F.col("mix_target") - F.floor(epochs) * F.col("mix_source_size"))
    wanted = drawn.select("source", words.cast("bigint").alias("words")).distinct()
    last = last_draws(drawn.select("source", "draw", "size"), written(wanted, "mix-wanted"))
    known = small(last.select(F.col("source").alias("_mix_source"), F.col("draw").alias("_mix_last"), "left"))
    rows = mixed.join(known, F.col(source).eqNullSafe(F.col("_mix_source")))

    def unsigned(draw: str) -> Column:
        return F.col(draw).bitwiseXOR(F.lit(-(1 << 63)))

    again = (unsigned("mix_draw") < unsigned("_mix_last")).cast("int")
    whole = rows.withColumn("mix_times", (F.floor(epochs) + again).cast("int")).filter("mix_times > 0").withColumn(
        "mix_turn", F.explode(F.sequence(F.lit(1), F.col("mix_times"))))
    # Of the rows at the last draw, equal in key and text, one stands for all.
    edge = rows.filter(F.col("mix_draw") == F.col("_mix_last")).dropDuplicates([source, "mix_draw"])
    full = F.floor(F.col("left") / F.col("mix_size")).cast("int")
    rest = (F.col("left") - full * F.col("mix_size")).cast("int")
    edge = edge.withColumn("mix_rest", rest).withColumn("mix_turn", F.explode(F.sequence(F.lit(0), full))).filter(
        "mix_turn > 0 OR mix_rest > 0")
    edge = edge.withColumn(text, F.when(F.col("mix_turn") > 0, F.col(text)).otherwise(first_words(F.col(text), F.col("mix_rest"))))
    out = whole.select(*docs.columns).unionByName(edge.select(*docs.columns))
    return out.withColumn("n_chars", F.length(text).cast("long")) if "n_chars" in docs.columns else out
