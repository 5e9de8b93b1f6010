"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight schedule that moves linearly from `start` to `end` times its weight while
training goes from 0 to 1; the mean is the weight. The integral of the schedule is the source's
cumulative token demand. Documents of a source stand in a fixed shuffled order, once for each pass;
inverting the demand at the running token count of a document gives its training position. All
documents are then range-sorted by position.

Targets fill up by weight: a source stops at `most_passes` times its size, and what it can't take is
shared anew by weight among the rest until none is above. That fixed point is a water level, found
from sorted sums without a loop.

The tables of sources are joined without a hint: Spark broadcasts them while they are under its
threshold, else it sorts and splits skewed keys.

Skew: running counts are taken in two levels, over order buckets of each source first, so that no
task ever holds a whole source. Documents with equal doc_id, source and size are counted first and take one
place in the running count, so neither null ids nor an id that repeats fill a bucket; they are
multiplied again at the end, COPIES at a time.

Cases: a null text has size 0; null sources are one source, last in order; null doc_ids order as the
empty string. Rows that repeat are separate documents with equal order, so they are interchangeable.
Documents of size 0 take part with 0 words and get a position too if any pass reaches them. An empty
table gives an empty result. Other columns are kept by mix(); names with two leading underscores are
this module's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.shared import WORD, partitions, table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
#: Slopes of the schedules in the same order: the weight at the end over the weight at the start.
SLOPES = (0.5, 1.0, 2.0)
#: Rows in one order bucket, roughly, until a source has MOST_BUCKETS; then buckets grow.
BUCKET_ROWS = 200
MOST_BUCKETS = 1 << 16
#: Equal documents that one row stands for while they are multiplied.
COPIES = 10_000


def size_of(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: str | Column) -> Column:
    """A fixed shuffle of the documents."""
    return F.md5(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_passes: int = MOST_PASSES, slopes=SLOPES) -> DataFrame:
    """sizes has (source, source_size long); adds weight, slope and target. One row per source, so
    the windows below see a small table, whatever the corpus."""
    every = Window.partitionBy()
    first = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (F.pmod(F.col("__rank") - 1, F.lit(len(xs))) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(most_passes)
    level = Window.orderBy(F.col("__cap") / F.col("weight"), "__rank")
    return (
        sizes.withColumn("__rank", F.row_number().over(first))
        .withColumn("weight", cycle(weights))
        .withColumn("slope", cycle(slopes))
        .withColumn("__total", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("__cap", cap)
        # the sources that fill up first come first: what is left for the others, and their weights
        .withColumn("__left", F.col("__total") - (F.sum("__cap").over(level) - F.col("__cap")))
        .withColumn("__rest", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__level", F.when(F.col("__cap") * F.col("__rest") > F.col("__left") * F.col("weight"), F.struct((F.col("__left")).alias("l"), F.col("__rest").alias("w"))))
        .withColumn("__level", F.first("__level", ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("target", F.coalesce(F.col("__level.l") * F.col("weight") / F.col("__level.w"), F.col("__cap").cast("double")))
        .select("source", "source_size", "weight", "slope", "target")
    )


def _demand_inverse(fraction: Column, slope: Column) -> Column:
    """The time at which a schedule that runs linearly from 2/(1+slope) to 2*slope/(1+slope), so
    with integral 1, has asked for `fraction` of its tokens."""
    a = F.lit(2.0) / (F.lit(1.0) + slope)
    b = (slope * F.lit(2.0)) / (F.lit(1.0) + slope) - a  # density a + b t; demand a t + b t^2 / 2
    root = F.sqrt(F.greatest(F.lit(0.0), a * a + F.lit(2.0) * b * fraction))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * fraction / (a + root)))


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, n): how many documents are equal in these. The only scan of the texts, and written, as
    plan() reads it several times."""
    sized = docs.select("doc_id", "source", size_of("text").alias("size"))
    return table(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")


def plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most_passes: int = MOST_PASSES, slopes=SLOPES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """sized is sizes_of()'s; (doc_id, source, size, source_size, target, passes, taken, positions) for each document:
    passes are the copies that the mix takes, taken their words, and positions ascend, one for each copy.

    A source's target is some whole passes and a part of one more; in that part a document is taken
    if its middle word lies before the part's end, so a source misses its target by half a document
    at most."""
    per = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("__rows"))
    goal = targets(per.select("source", "source_size"), weights, share, most_passes, slopes)
    # order buckets: as many as the source's rows ask for, in the order of the key
    buckets = per.select("source", F.least(F.ceil(F.col("__rows") / F.lit(bucket_rows)), F.lit(MOST_BUCKETS)).alias("__n"))
    same = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))
    unit = F.conv(F.substring("__key", 1, 12), 16, 10).cast("long")
    rows = (
        sized.withColumn("__key", order_key("doc_id")).alias("d").join(buckets.alias("b"), same("d", "b")).select("d.*", "__n")
        .withColumn("__b", F.floor(unit / F.lit(float(1 << 48)) * F.col("__n")).cast("long"))
        .withColumn("__all", F.col("size") * F.col("n"))
    )
    by = Window.partitionBy("source").orderBy("__b")
    starts = (
        rows.groupBy("source", "__b").agg(F.sum("__all").alias("__sum"))
        .withColumn("__base", F.sum("__sum").over(by) - F.col("__sum"))
        .alias("s")
    )
    within = Window.partitionBy("source", "__b").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("__run", F.sum("__all").over(within) - F.col("__all")).alias("d")
    facts = starts.join(goal.alias("g"), same("s", "g")).select("s.source", "__b", "__base", "source_size", "target", "slope").alias("f")
    both = run.join(facts, same("d", "f") & (F.col("d.__b") == F.col("f.__b"))).select("d.doc_id", "d.source", "d.size", "d.n", "source_size", "target", "slope", (F.col("__run") + F.col("__base")).alias("__first"))
    # equal documents follow each other; where there are many, their rows are dealt out before they are multiplied
    one = F.lit(0).cast("long")
    several = both.filter("n > 1").withColumn("__c", F.explode(F.sequence(one, F.floor((F.col("n") - 1) / COPIES))))
    several = several.repartition("doc_id", "source", "size", "__c").withColumn("__k", F.explode(F.sequence(F.col("__c") * COPIES, F.least(F.col("__c") * COPIES + (COPIES - 1), F.col("n") - 1)))).drop("__c")
    both = both.filter("n = 1").withColumn("__k", one).unionByName(several).withColumn("__start", F.col("__first") + F.col("__k") * F.col("size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    part = F.col("target") - whole * F.col("source_size")
    passes = whole + F.when((whole < F.lit(most_passes)) & (F.col("__start") * 2 + F.col("size") < part * 2), F.lit(1)).otherwise(F.lit(0))
    return (
        both.withColumn("passes", passes.cast("long"))
        .withColumn("taken", F.col("passes") * F.col("size"))
        .withColumn(
            "positions",
            F.when(
                F.col("passes") > 0,
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("passes") - 1),
                    lambda k: _demand_inverse((F.col("__start") + k * F.col("source_size") + F.col("size") / 2.0) / F.col("target"), F.col("slope")),
                ),
            ).otherwise(F.array().cast("array<double>")),
        )
        .select("doc_id", "source", "size", "source_size", "target", "passes", "taken", "positions")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order, each as often as the mix takes it, with all their columns
    and __position. Positions are spread evenly over 0..1 by construction, so the range of a
    partition is known beforehand and no sampling pass is needed."""
    spark = docs.sparkSession
    planned = table(plan(sizes_of(docs), **options), "mix")
    # equal (doc_id, source, size) rows have the same order key; each gets the passes of the group's next row
    same = ["doc_id", "source", "size"]
    several = planned.groupBy(*same).agg(F.flatten(F.collect_list("positions")).alias("__all"), F.count("*").alias("__rows"))
    out = docs.withColumn("__size", size_of("text")).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.__size") == F.col("p.size"))
    one = several.filter("__rows = 1").filter(F.size("__all") > 0).alias("p")
    many = several.filter("__rows > 1").filter(F.size("__all") > 0).alias("p")
    single = out.join(one, on).select("d.*", F.explode("p.__all").alias("__position"))
    parts = Window.partitionBy("doc_id", "source", "__size").orderBy("text")
    # repeated rows: row k of r takes every r-th position
    repeated = (
        out.withColumn("__k", F.row_number().over(parts)).alias("d").join(many, on)
        .select("d.*", F.posexplode(F.array_sort("p.__all")).alias("__i", "__position"), F.col("p.__rows").alias("__r"))
        .filter(F.pmod(F.col("__i"), F.col("__r")) == F.col("__k") - 1).drop("__i", "__r", "__k")
        if many.limit(1).count() else None
    )
    mixed = single if repeated is None else single.unionByName(repeated)
    n = partitions(spark)
    at = F.least(F.floor(F.col("__position") * n), F.lit(n - 1)).cast("int")
    return mixed.drop("__size").repartitionById(n, at).sortWithinPartitions("__position", "doc_id")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planned = plan(sizes_of(docs))
    return planned.select("doc_id", "size", "source_size", "target", "taken", F.when(F.size("positions") > 0, F.col("positions")[0]).alias("first_position"))


_W = "list_value(3.0, 1.0, 2.0)[((rk - 1) % 3) + 1]"
_S = "list_value(0.5, 1.0, 2.0)[((rk - 1) % 3) + 1]"
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
w AS (SELECT *, CAST({_W} AS DOUBLE) AS weight, CAST({_S} AS DOUBLE) AS slope, source_size * 2 AS cap, CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE) AS total FROM s),
l AS (SELECT *, total - CAST(sum(cap) OVER (ORDER BY cap / weight, rk) - cap AS BIGINT) AS lft,
        sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
m AS (SELECT *, first_value(CASE WHEN cap * rest > lft * weight THEN {{'l': lft, 'w': rest}} END IGNORE NULLS)
        OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM l),
g AS (SELECT source, source_size, slope, coalesce(lv.l * weight / lv.w, CAST(cap AS DOUBLE)) AS target FROM m),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.slope,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start,
        CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS whole
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t AS (SELECT *, whole + CASE WHEN whole < 2 AND start * 2 + size < (target - whole * source_size) * 2 THEN 1 ELSE 0 END AS passes,
        2.0::DOUBLE / (1.0::DOUBLE + slope) AS a, (start + size / 2.0::DOUBLE) / target AS f FROM r),
u AS (SELECT *, (slope * 2.0::DOUBLE) / (1.0::DOUBLE + slope) - a AS b FROM t)
SELECT doc_id, size, source_size, target, CAST(passes * size AS BIGINT) AS taken,
  CASE WHEN passes > 0 THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, 2.0::DOUBLE * f / (a + sqrt(greatest(0.0::DOUBLE, a * a + 2.0::DOUBLE * b * f))))) END AS first_position
FROM u
"""
