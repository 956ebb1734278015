"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Every row gets an exponential key ``-ln(u) / quality``; sorted within its source, the rows are taken
until the source's token budget is reached. A budget above the size of its source takes whole epochs
first, then the fraction. ``u`` is a hash of the row, so reruns agree.

No source is ever sorted or summed as a whole: the keys are cut into 256 ranges, the range in which
the budget ends is cut into 256 again, three times in all, and only the rows of that last cell
(1 in 16 million) are sorted. What comes out is one cut per source, and applying the cuts to rows is
a map with a join against the small table of sources.

Defined cases: a NULL text has size 0; NULL is a source of its own, the last one; a source without
words has target 0; NULL ids are hashed as the empty id. Rows equal in key, id and size are one line with a
count at the cut, and as many of them are taken as the budget holds; which ones is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.sharding import unit_hash
from kindred.llm.texts import words
from kindred.shared import stored

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
PARTS = 4096
RANK_BITS = 24
STEP_BITS = 8
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """Share of letters, from 0.1 to 1: the default quality weight of a text."""
    whole = F.coalesce(text, F.lit(""))
    letters = F.length(whole) - F.length(F.regexp_replace(whole, r"\p{L}+", ""))
    return F.greatest(F.lit(0.1), letters / F.greatest(F.length(whole), F.lit(1)))


def keyed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None,
    keep: bool = False,
) -> DataFrame:
    """Rows with ``_id, _source, _size, _key, _rank``; with ``keep`` all columns of ``docs`` in ``_row``."""
    weight = quality_weight(F.col(text)) if quality is None else quality
    size = F.size(words(F.col(text))).cast("long")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if keep else []
    sized = docs.select(
        F.col(key).alias("_id"), F.col(source).alias("_source"), size.alias("_size"), weight.alias("_weight"), *row
    )
    chance = unit_hash(F.concat_ws("/", F.lit(SEED), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_size")))
    with_key = sized.withColumn("_key", -F.log(chance) / F.col("_weight")).drop("_weight")
    rank = F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * F.lit(float(1 << RANK_BITS)))
    return with_key.withColumn("_rank", F.least(rank, F.lit((1 << RANK_BITS) - 1)).cast("int"))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: size, target, whole epochs and what is left for the fraction.

    A target is the smaller of 3 times the source's size and the source's weight times one common
    level; the level is read off running sums over the sources, sorted by the level at which they fill.
    The windows run over the table of sources, not over rows.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place + 1).cast("long"))
    weighed = weighed.withColumn("_cap", MAX_EPOCHS * F.col("source_size"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last())
    earlier = filled.rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))
    left_weights = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(earlier), F.lit(0))
    levels = weighed.withColumn("_level", left_words / left_weights)
    open_level = F.when(F.col("_cap") / F.col("_w") >= F.col("_level"), F.col("_level"))
    # The first source that does not fill up sets the level; the later ones only give higher or equal ones.
    first_open = F.first(open_level, ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("_cap").cast("double"), first_open * F.col("_w"))
    done = levels.select("_source", "source_size", target.alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return done.withColumn("_epochs", epochs).withColumn(
        "_left", F.col("target") - F.col("_epochs") * F.col("source_size")
    )


def plan(rows: DataFrame) -> DataFrame:
    """The cut of every source: ``source_size, target, _epochs``, the last rank, key, id and size of the fraction
    and how many of the rows equal in these it takes (``_fits``)."""
    state = stored(targets(rows).withColumn("_prefix", F.lit(0)), "mix-targets")
    for shift in range(RANK_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = _joined(rows, state).where(F.shiftright("_rank", shift + STEP_BITS) == F.col("_prefix"))
        cells = inside.groupBy("_source", F.shiftright("_rank", shift).alias("_cell")).agg(F.sum("_size").alias("_sum"))
        running = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        ended = cells.withColumn("_end", F.sum("_sum").over(running)).withColumnRenamed("_source", "_of")
        hit = state.join(ended, F.col("_source").eqNullSafe(F.col("_of")), "left").where(
            F.col("_of").eqNullSafe(F.col("_source")) & (F.col("_end") > F.col("_left"))
            & (F.col("_end") - F.col("_sum") <= F.col("_left"))
        )
        found = hit.select(F.col("_source").alias("_of"), "_cell", (F.col("_end") - F.col("_sum")).alias("_before"))
        state = state.join(found, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
            "_source", "source_size", "target", "_epochs",
            (F.col("_left") - F.coalesce("_before", F.lit(0))).alias("_left"), F.col("_cell").alias("_prefix"),
        )
        state = stored(state, "mix-state")
    last = _joined(rows, state).where(F.col("_rank") == F.col("_prefix"))
    lines = last.groupBy("_source", "_key", "_id", "_size", "_left").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_source").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("_left") - (F.sum(F.col("_n") * F.col("_size")).over(order) - F.col("_n") * F.col("_size"))
    # A row fits if the budget reaches its middle; rows without words as long as any budget is left.
    held = F.when(F.col("_size") > 0, F.floor(room / F.col("_size") + 0.5)).otherwise(F.when(room >= 0, F.col("_n")).otherwise(0))
    fits = F.least(F.col("_n"), held.cast("long"))
    cut = lines.withColumn("_fits", fits).where("_fits > 0").groupBy(F.col("_source").alias("_of")).agg(
        F.max(F.struct("_key", "_id", "_size", "_fits")).alias("_last")
    ).select("_of", F.struct("_last._key", "_last._id", "_last._size").alias("_cut"), F.col("_last._fits").alias("_fits"))
    whole = state.join(cut, F.col("_source").eqNullSafe(F.col("_of")), "left")
    return stored(whole.select("_source", "source_size", "target", "_epochs", "_prefix", "_cut", "_fits"), "mix-plan")


def _joined(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows with the state of their source; the small table's size decides whether it is broadcast."""
    named = state.withColumnRenamed("_source", "_of")
    return rows.join(named, rows["_source"].eqNullSafe(named["_of"])).drop("_of")


def take(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``source_size, target`` and ``copies``, how often the mix takes the row."""
    names = [*rows.columns, "source_size", "target"]
    joined = _joined(rows, cuts)
    place = F.struct("_key", "_id", "_size")
    at_cut = F.coalesce((F.col("_rank") == F.col("_prefix")) & (place == F.col("_cut")), F.lit(False))
    under = (F.col("_rank") < F.col("_prefix")) | ((F.col("_rank") == F.col("_prefix")) & (place < F.col("_cut")))

    def copies(extra: Column) -> Column:
        more = F.when(F.coalesce(extra, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
        return F.least(F.col("_epochs") + more, F.lit(MAX_EPOCHS)).alias("copies")

    # The equal rows at the cut are stored as dealt out and numbered in parts, so no task holds a hot group.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")
    edge = stored(joined.where(at_cut).withColumn("_part", dealt), "mix-edge")
    parts = edge.groupBy("_source", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_source").alias("_of"), F.col("_part").alias("_of_part"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    same = F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_of_part"))
    numbered = edge.withColumn(
        "_number", F.row_number().over(Window.partitionBy("_source", "_part").orderBy("_key"))
    ).join(offsets, same)
    taken = numbered.select(*names, copies(F.col("_offset") + F.col("_number") <= F.col("_fits")))
    return joined.where(~at_cut).select(*names, copies(under)).unionByName(taken)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key, size, source_size, target, taken`` per row of ``docs``."""
    rows = stored(keyed(docs, key, text, source), "mix-rows")
    return take(rows, plan(rows)).select(
        F.col("_id").alias(key), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def sampled(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed table itself: every row as often as the mix takes it, its columns as they were."""
    cuts = plan(stored(keyed(docs, key, text, source), "mix-rows"))
    taken = take(keyed(docs, key, text, source, keep=True), cuts)
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")
    return taken.where("copies > 0").select("_row", each).select("_row.*")
