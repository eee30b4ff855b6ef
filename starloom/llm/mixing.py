"""Mixing sources to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.staging import settle

#: Words are runs of other characters than these; bits of the hash and of a level.
WORD = r"[^\x20\x09-\x0D]+"
HASH_HEX, LEVEL_BITS = 15, 12


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, seed: str) -> Column:
    """60 bits from the document's id; a null id hashes like an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_HEX), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``sizes(source, source_size)`` with ``target`` added.

    Sources in code-point order, null last, get ``weights`` in turn, repeating. They divide
    ``share`` of all sizes by weight; none gets more than ``cap`` times its own size, and what
    it can't take goes to the others by weight until none is above. One row per source passes
    through the ordering here, never documents.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    sized = sizes.withColumn("weight", weight).withColumn(
        "ceiling", F.col("source_size") * F.lit(float(cap))
    )
    by_ratio = everything.orderBy(
        F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    filled = F.coalesce(
        F.sum("ceiling").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = sized.withColumn("level", (total - filled) / open_weight)
    stays = F.col("level") * F.col("weight") < F.col("ceiling")
    level = level.withColumn("rank", F.row_number().over(by_ratio))
    level = level.withColumn(
        "level", F.min_by(F.col("level"), F.when(stays, F.col("rank"))).over(everything)
    )
    target = F.coalesce(F.least("ceiling", F.col("level") * F.col("weight")), F.col("ceiling"))
    return level.select("source", "source_size", target.alias("target"))


def _key(df: DataFrame) -> DataFrame:
    """Source as two non-null columns, so that null sources join."""
    return df.withColumns(
        {"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit(""))}
    )


def thresholds(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """The hash threshold of each source: ``goal`` with ``epochs`` and ``threshold`` added.

    ``sized(source, size, hash)`` has a row per document. A source whose target is ``epochs``
    whole passes and a rest takes every document ``epochs`` times and those with a hash below
    ``threshold`` once more; their sizes come as near to the rest as documents allow.

    Level by level the next 12 bits of the hash make a histogram of sizes; only documents in the
    bucket where a source's budget runs out go to the next level. Thresholds are nested: a larger
    budget only adds documents.
    """
    keys = ["no_source", "source_key"]
    bits = HASH_HEX * 4
    sized, state = _key(sized), _key(goal)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    state = state.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long"))
    state = state.withColumns(
        {
            "rest": F.col("target") - F.col("epochs") * F.col("source_size"),
            "prefix": F.lit(0).cast("long"),
            "base": F.lit(0).cast("long"),
            "last": F.lit(0).cast("long"),
            "open": F.col("source_size") > 0,
        }
    )
    state = settle(state, "mix_state")
    for level in range(1, HASH_HEX * 4 // LEVEL_BITS + 1):
        up, down = bits - LEVEL_BITS * (level - 1), bits - LEVEL_BITS * level
        inside = sized.join(state.where("open").select(*keys, "prefix", "base", "rest"), keys)
        inside = inside.where(F.shiftright("hash", up) == F.col("prefix"))
        histogram = inside.groupBy(*keys, F.shiftright("hash", down).alias("bucket")).agg(
            F.sum("size").alias("amount"),
            F.count_distinct("hash").alias("n"),
            F.first("base").alias("base"),
            F.first("rest").alias("rest"),
        )
        run = Window.partitionBy(*keys).orderBy("bucket")
        run = F.sum("amount").over(run.rowsBetween(Window.unboundedPreceding, 0)) + F.col("base")
        edge = (
            histogram.withColumn("run", run)
            .where("run > rest")
            .groupBy(*keys)
            .agg(F.min(F.struct("bucket", "run", "amount", "n")).alias("edge"))
        )
        moved = state.join(edge, keys, "left").withColumns(
            {
                "prefix": F.when(~F.col("open"), F.col("prefix"))
                .when(F.col("edge").isNotNull(), F.col("edge.bucket"))
                .otherwise(F.shiftleft(F.col("prefix") + 1, up - down)),
                "base": F.when(
                    F.col("edge").isNotNull(), F.col("edge.run") - F.col("edge.amount")
                ).otherwise(F.col("base")),
                "last": F.coalesce("edge.amount", F.lit(0)),
                "open": F.col("edge").isNotNull() & (F.col("edge.n") > 1),
                "single": F.col("edge").isNotNull() & (F.col("edge.n") <= 1),
            }
        )
        # the threshold is kept at full width; a bucket of one hash value is taken if that is nearer
        width = F.lit(1 << down).cast("long")
        nearer = F.col("single") & (
            F.abs(F.col("base") + F.col("last") - F.col("rest"))
            < F.abs(F.col("rest") - F.col("base"))
        )
        here = F.col("prefix") * width + F.when(nearer, width).otherwise(F.lit(0).cast("long"))
        was_open = state.select(*keys, F.col("open").alias("was_open"))
        moved = moved.join(was_open, keys)
        if level == 1:
            moved = moved.withColumn("threshold", F.lit(0).cast("long"))
        moved = moved.withColumn(
            "threshold", F.when(F.col("was_open"), here).otherwise(F.col("threshold"))
        ).drop("edge", "single", "was_open")
        state = settle(moved, "mix_state")
        if state.where("open").isEmpty():
            break
    return state.select(
        *keys, "source", "source_size", "target", "epochs", "threshold"
    )


def plan(
    sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Targets and thresholds for ``sized(source, size, hash)``: one row per source."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, settle(targets(sizes, weights, share, cap), "mix_targets"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: how often the mix takes it.

    Columns: doc_id, size (words), source_size, target, copies, taken (size times copies).
    ``cap`` bounds the copies of a document. Null texts have size 0; a null source is a source;
    null ids count as one id. Equal ids share their fate. Empty tables give empty results. The
    result depends on the rows alone, not on partitions or runs.
    """
    sized = settle(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            document_hash(F.col("doc_id"), seed).alias("hash"),
        ),
        "mix_sized",
    )
    chosen = plan(sized, weights, share, cap).drop("source")
    copies = F.col("epochs") + (F.col("hash") < F.col("threshold")).cast("long")
    return (
        _key(sized)
        .join(chosen, ["no_source", "source_key"])
        .withColumn("copies", copies)
        .select(
            "doc_id", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as it is taken.

    Columns may have any name, those that are used inside as well.
    """
    sized = docs.select(
        "source", word_count(F.col("text")).alias("size"),
        document_hash(F.col("doc_id"), seed).alias("hash"),
    )
    chosen = plan(settle(sized, "mix_sized"), weights, share, cap)
    # names that no column of the documents has
    own = "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    chosen = chosen.select(
        F.col("no_source").alias(f"{own}none"), F.col("source_key").alias(f"{own}key"),
        F.col("epochs").alias(f"{own}epochs"), F.col("threshold").alias(f"{own}threshold"),
    )
    same = (F.col("source").isNull() == F.col(f"{own}none")) & (
        F.coalesce("source", F.lit("")) == F.col(f"{own}key")
    )
    copies = F.col(f"{own}epochs") + (
        document_hash(F.col("doc_id"), seed) < F.col(f"{own}threshold")
    ).cast("long")
    copies = F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return docs.join(chosen, same).withColumn(f"{own}copy", F.explode(copies)).select(*quoted)
