"""Mix sources to target weights by capped water-filling.

The mix has ``share`` times the words of all sources. Each source's target is its weight times one water level,
but at most ``max_epochs`` times its size; what a clamped source leaves is shared by weight among the others until none
is above its cap. A source then takes its documents in whole repetitions, and the fractional one from its
documents in a seeded order until the target is reached; only the last document of that order is taken in part, so
each source meets its target to the word.

Sources rank by code point, null last, and weigh ``weights`` in turn. Null texts have no words. A source
without words has target 0. Rows are told apart by nothing but id and size, so repeated rows share the
order's place between them. Extra columns are ignored by ``mix_sources``; ``mixed_documents`` carries them along and gives
every row, without id or repeated, as many copies as it is taken itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.sources.workspace import persisted

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source whose running sum is taken in one group.
SLICE_ROWS = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """rank: place of each source by code point, null last, without gathering the sources in one task."""
    order = F.col("source").asc_nulls_last()
    parts = persisted(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix_sources", shuffle=False)
    before = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("place", place).join(before, "part").withColumn("rank", F.col("place") + F.col("before")).drop("part", "place", "before")


def water_fill(sources: DataFrame, total: float, max_epochs: int) -> DataFrame:
    """sources (source_size, weight, ...) with target. Each round is one aggregate over the sources; every round clamps at least one more or ends."""
    size, weight = F.col("source_size"), F.col("weight").cast("double")
    caps, weights, clamped = 0, sources.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0], -1
    while weights:
        above = (size * max_epochs).cast("double") * F.lit(float(weights)) < weight * F.lit(total - caps)
        n, sum_caps, sum_weights = sources.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, size * max_epochs)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        if n == clamped:
            break
        clamped, caps, weights = n, sum_caps, sum_weights
    if not weights:
        return sources.withColumn("target", (size * max_epochs).cast("double"))
    above = (size * max_epochs).cast("double") * F.lit(float(weights)) < weight * F.lit(total - caps)
    return sources.withColumn("target", F.when(above, (size * max_epochs).cast("double")).otherwise(F.lit(total - caps) * weight / F.lit(float(weights))))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of docs: id, source, size in words, source_size, target and taken."""
    mix = _mix(docs, (), weights, share, max_epochs, seed, id_col, text_col, source_col)
    return mix.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken")


def _mix(
    docs: DataFrame, carried: tuple[str, ...], weights: tuple[int, ...], share: float, max_epochs: int, seed: str, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """Per row of docs: id, source, size, source_size, target, taken, and the struct row of the carried columns, if there are any."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    row = [F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row")] if carried else []
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), key.alias("key"), *row)
    sized = persisted(sized, "mix_sizes", shuffle=False)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # Of the rows without an id, and of those that repeat one, a slice may hold more.
    sources = _ranked(sources).withColumn("slices", F.ceil(F.col("n_docs") / SLICE_ROWS))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    sources = persisted(sources, "mix_weights", shuffle=False)
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    targets = water_fill(sources, total, max_epochs).withColumnRenamed("source", "name")
    targets = persisted(targets, "mix_targets", shuffle=False)

    placed = sized.join(targets, sized["source"].eqNullSafe(targets["name"])).drop("name")
    unit = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("slice", F.shiftright(unit * F.col("slices"), 32))
    slices = placed.groupBy("rank", "slice").agg(F.sum("size").alias("words"))
    slices = slices.select("rank", "slice", (F.sum("words").over(Window.partitionBy("rank").orderBy("slice")) - F.col("words")).alias("before"))
    inner = Window.partitionBy("rank", "slice").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.join(slices, ["rank", "slice"]).withColumn("earlier", F.col("before") + F.sum("size").over(inner) - F.col("size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    part = F.floor(F.col("target") - whole * F.col("source_size") + 0.5).cast("long")
    extra = F.greatest(F.lit(0), F.least("size", part - F.col("earlier")))
    taken = (whole * F.col("size") + extra).cast("long").alias("taken")
    return summed.select("id", "source", "size", "source_size", "target", taken, *(["row"] if carried else []))


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row as often as it is taken, the last partial one of a source rounded to a whole."""
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = _mix(docs, tuple(docs.columns), weights, share, max_epochs, seed, id_col, text_col, source_col).where("taken > 0")
    repeated = taken.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select("row.*")


SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix-1:' || doc_id) as key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sized group by source),
ordered as (
  select *, 1.5::double * sum(source_size) over () as total,
         coalesce(sum(2 * source_size) over w, 0)::bigint as caps, sum(weight) over () - coalesce(sum(weight) over w, 0) as weights
  from sources window w as (order by 2.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
level as (
  select caps, weights, total from ordered
  where (2 * source_size)::double * weights::double >= weight * (total - caps) order by 2.0 * source_size / weight limit 1),
targets as (
  select s.source, s.source_size,
         case when (2 * s.source_size)::double * weights::double < s.weight * (total - caps) then (2 * s.source_size)::double
              else (total - caps) * s.weight / weights::double end as target
  from sources s cross join level),
placed as (
  select s.doc_id, s.source, s.size, t.source_size, t.target,
         sum(s.size) over (partition by s.source order by s.key, s.doc_id rows between unbounded preceding and current row) - s.size as earlier,
         case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end::bigint as whole
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, source, size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target - whole * source_size + 0.5)::bigint - earlier)))::bigint as taken
from placed
"""
