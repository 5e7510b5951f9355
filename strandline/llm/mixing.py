"""Mixing sources to target weights: repetition rates from token sums, whole copies plus one Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import hot_keys, materialize, salted_join, shuffle_parts

WEIGHTS = (1, 2, 3)
MAX_RATE = 3


def token_count(text: str = "text"):
    """Number of words (runs without white space 0x20, 0x09-0x0D); 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds to each row the sums over all rows before it in the order, without one task that holds all rows.

    Rows are dealt out by ranges of the order; each range sums its own, and the ranges before it give its offset.
    One row per range comes to the driver.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    # the low 33 bits of monotonically_increasing_id count within the partition, the others are the partition
    held = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33)), "mix-order")
    kinds = dict(held.select(*[F.sum(x).alias(n) for n, x in sums.items()]).dtypes)
    before, rows = [0.0 if t == "double" else 0 for t in kinds.values()], []
    for r in sorted(held.groupBy("__part").agg(*[F.sum(x).alias(n) for n, x in sums.items()]).collect()):
        rows.append((r["__part"], *before))
        before = [a + b for a, b in zip(before, r[1:], strict=True)]
    offsets = spark.createDataFrame(rows, "__part long, " + ", ".join(f"`__{n}` {t}" for n, t in kinds.items()))
    w = Window.partitionBy("__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, -1)
    out = held.join(F.broadcast(offsets), "__part")
    return out.select(*df.columns, *[(F.col(f"__{n}") + F.coalesce(F.sum(x).over(w), F.lit(0))).alias(n) for n, x in sums.items()])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, weight, target, n) from rows (source, size); n is the number of rows.

    Sources in code point order (null last) weigh weights[0], weights[1], ..., repeating.  Shares add up to
    all tokens; a target stops at max_rate times its source's size, and the excess is shared again by
    weight among the others until none is above.

    That state is found at once: a source is full when the common level (tokens per weight) reaches max_rate * size / weight.
    In the order of these levels, with the sources before one full, the rest shares what they leave; the first source
    that this share does not fill sets the level for all after it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = _running(per, [F.col("source").isNull().cast("int"), F.col("source")], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = ranked.withColumn("weight", weight).withColumn("most", (F.col("source_size") * max_rate).cast("long")).withColumn("full_at", F.col("most") / F.col("weight"))
    filled = materialize(_running(s, [F.col("full_at"), F.col("rank")], {"used": F.col("most"), "taken_weight": F.col("weight")}), "mix-weights")
    total, all_weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    share = F.lit(float(total or 0)) - F.col("used")
    level = F.when(F.col("full_at") > share / (F.lit(all_weight or 1.0) - F.col("taken_weight")), share / (F.lit(all_weight or 1.0) - F.col("taken_weight")))
    # without tokens no source is open and the level is 0
    level = filled.agg(F.min_by(level, F.when(level.isNotNull(), F.struct("full_at", "rank")))).first()[0] or 0.0
    return filled.select("source", "source_size", "weight", "n", F.when(F.col("most") <= F.col("weight") * F.lit(level), F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: int = 8) -> DataFrame:
    """docs with size, source_size, target and copies: how often each document is taken.

    rate = target / source_size; a document is taken floor(rate) times, and once more if a number in
    [0, 1) hashed from seed and doc_id falls below the fraction.  Rows of one doc_id get equal draws and
    reruns agree.  Null text: size 0; null source: a source of its own, last in order;
    an empty table gives an empty result; a source without tokens has rate 0.
    Columns of docs with these names are replaced.
    """
    base = docs.drop("size", "source_size", "target", "copies").withColumn("size", token_count())
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("__source")
    targets = source_targets(base.select("source", "size"), weights, max_rate).select(name, "source_size", "target", "n")
    # a row per source: Spark itself chooses whether they are sent to all; if not, the rows of a large source go to several places
    out = salted_join(base.withColumn("__source", name), targets.drop("n"), ["__source"], "doc_id", hot_keys(targets, ["__source"]), "left").drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return out.withColumn("copies", (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("int"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of docs as often as its plan says, with the columns of docs."""
    held = docs.select("doc_id", "text", "source", F.struct(*[docs[c] for c in docs.columns]).alias("__row"))
    plan = mix_plan(held, **options).where("copies > 0")
    return plan.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).select("__row.*")
