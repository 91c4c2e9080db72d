"""Mixing sources to target weights with Sainte-Lague apportionment, in DataFrame functions.

Every source gets a target number of words. The targets become integer numbers of
blocks of equal word counts by highest quotients: first over the sources, then over
the shards of each source. Inside a shard the documents stand in an order drawn by
the seed, are cut into equal blocks, and the seed picks the blocks to take. A quota
above the blocks of a shard takes all of them once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import running, stored

WORD = r"[^\x20\x09-\x0D]+"
# Larger than any number of blocks in a shard, and prime: j -> j * STEP + start is then
# a permutation of the block numbers of every shard.
STEP = 2_147_483_647


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(seed: int, *parts: Column) -> Column:
    """32 bits from the seed and the given strings."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Add ``rank``, ``weight`` and ``target`` to rows (key, words).

    Weights repeat along the order of ``key``. Targets share ``share`` times all words
    by weight; one that would exceed ``most`` times its words stops there and what it
    leaves over is shared again, which ends at target = min(most * words, level * weight).
    With the sources in order of the level at which each stops, every prefix taken as
    stopped gives a level at or below the final one, so the largest of these is it.
    """
    ranked = stored(running(sources, [F.col("key").asc()], {"rank": F.lit(1)}), "ranked")
    place = (F.col("rank") - 1) % len(weights) + 1
    weighted = ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place.cast("int"))
    ).withColumn("cap", F.col("words") * most)
    stops = F.col("cap") / F.col("weight")
    summed = running(
        weighted, [stops.asc(), F.col("key").asc()], {"caps": F.col("cap"), "upto": F.col("weight")}
    )
    totals = weighted.agg(F.sum("words").alias("words"), F.sum("weight").alias("weight")).first()
    pool, all_weights = share * (totals["words"] or 0), totals["weight"] or 0
    left = F.lit(all_weights) - F.col("upto") + F.col("weight")
    level = (
        summed.agg(F.max((F.lit(pool) - F.col("caps") + F.col("cap")) / left).alias("level"))
        .first()["level"]
    )
    return weighted.withColumn(
        "target", F.least(F.col("cap"), F.lit(level or 0.0) * F.col("weight"))
    ).drop("cap")


def sainte_lague(cells: DataFrame) -> DataFrame:
    """Rows (grp, cell, seats) from rows (grp, cell, share double, wanted long).

    The ``wanted`` seats of a group go to its cells by the highest quotients
    share / (2k + 1), ties to the smaller cell. With n cells, the divisor at which
    rounding gives all seats lies between those for wanted - n/2 and wanted + n/2 seats,
    so only about 3n quotients can be in doubt; all seats below are given outright.
    Cells without a share get no seats.
    """
    live = cells.filter(F.col("share") > 0)
    groups = live.groupBy("grp").agg(
        F.sum("share").alias("total"), F.count(F.lit(1)).alias("n")
    )
    quota = F.col("share") / F.col("total") * F.col("wanted")
    slack = F.col("share") / F.col("total") * F.col("n") / 2
    # Cells and quotients are stored, so that no plan holds all steps: one that does is long,
    # and the driver plans it again after each of its shuffles.
    bounded = stored(
        live.join(groups, "grp").select(
            "grp",
            "cell",
            "share",
            "wanted",
            F.greatest(F.lit(0), F.floor(quota - slack - 0.5)).cast("long").alias("sure"),
            F.ceil(quota + slack + 0.5).cast("long").alias("top"),
        ),
        "bounded",
    )
    doubtful = bounded.select(
        "grp", "cell", "share", F.explode(F.sequence("sure", F.col("top") - 1)).alias("k")
    ).withColumn("quotient", F.col("share") / (2 * F.col("k") + 1))
    order = [F.col("grp").asc(), F.col("quotient").desc(), F.col("cell").asc(), F.col("k").asc()]
    placed = stored(running(doubtful, order, {"place": F.lit(1)}), "placed")
    firsts = placed.groupBy("grp").agg((F.min("place") - 1).alias("before"))
    open_seats = bounded.groupBy("grp").agg(
        (F.max("wanted") - F.sum("sure")).alias("open")
    )
    won = (
        placed.join(firsts.join(open_seats, "grp"), "grp")
        .filter(F.col("place") - F.col("before") <= F.col("open"))
        .groupBy("grp", "cell")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    return bounded.join(won, ["grp", "cell"], "left").select(
        "grp", "cell", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("seats")
    )


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    block_words: int = 16,
    shard_words: int = 1 << 18,
    shard_docs: int = 1 << 11,
) -> DataFrame:
    """All rows of ``docs`` (doc_id, source, text, ...) with the words the mix takes.

    Adds ``size`` (words of the text; null text: 0), ``source_size``, ``target`` (of the
    row's source) and ``taken``; columns of these names are replaced, all others kept.
    Null is a source of its own, ordered last. Repeated rows take part one by one. A
    shard holds about ``shard_words`` words and ``shard_docs`` rows whatever the size of
    its source, so a source with a third of all rows is dealt over many tasks. An empty
    input gives an empty result.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in added]
    key = F.when(F.col("source").isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), "source"))
    # By the text too: rows of null or repeated ids spread as well.
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5("text")))
    # The columns travel as one, so that no name of theirs meets one of the mix.
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col("doc_id").alias("_id"),
        word_count(F.col("text")).alias("size"),
        key.alias("_key"),
        drawn.alias("_drawn"),
    )
    narrow = stored(sized.select("_key", "_drawn", "size"), "sizes")
    sources = narrow.groupBy(F.col("_key").alias("key")).agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
    )
    shards = F.greatest(
        F.lit(1), F.ceil(F.col("words") / shard_words), F.ceil(F.col("rows") / shard_docs)
    ).cast("long")
    targets = stored(
        source_targets(sources, weights, share, most).withColumn("shards", shards), "targets"
    )
    wanted = targets.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    blocks = sainte_lague(
        targets.select(
            F.lit("all").alias("grp"),
            F.col("key").alias("cell"),
            F.col("target").alias("share"),
            F.lit(round(wanted / block_words)).cast("long").alias("wanted"),
        )
    ).select(F.col("cell").alias("_key"), F.col("seats").alias("source_blocks"))
    per_source = stored(
        targets.withColumnRenamed("key", "_key")
        .join(blocks, "_key", "left")
        .select(
            "_key",
            F.col("words").alias("source_size"),
            "target",
            "shards",
            F.coalesce("source_blocks", F.lit(0)).alias("source_blocks"),
        ),
        "sources",
    )
    shard = F.pmod(F.conv(F.substring("_drawn", 1, 8), 16, 10).cast("long"), F.col("shards"))

    def sharded(df: DataFrame) -> DataFrame:
        return df.join(per_source, "_key").withColumn("_shard", shard)

    cells = stored(
        sharded(narrow)
        .groupBy("_key", "_shard")
        .agg(F.sum("size").alias("cell_words"), F.max("source_blocks").alias("source_blocks")),
        "cells",
    )
    seats = sainte_lague(
        cells.select(
            F.col("_key").alias("grp"),
            F.col("_shard").alias("cell"),
            F.col("cell_words").cast("double").alias("share"),
            F.col("source_blocks").alias("wanted"),
        )
    ).select(F.col("grp").alias("_key"), F.col("cell").alias("_shard"), "seats")
    n_blocks = F.greatest(F.lit(1), F.round(F.col("cell_words") / block_words)).cast("long")
    quotas = stored(
        cells.join(seats, ["_key", "_shard"], "left")
        .withColumn("blocks", n_blocks)
        .withColumn("quota", F.least(F.coalesce("seats", F.lit(0)), F.col("blocks") * int(most)))
        .select(
            "_key",
            "_shard",
            "cell_words",
            "blocks",
            F.floor(F.col("quota") / F.col("blocks")).cast("long").alias("passes"),
            (F.col("quota") % F.col("blocks")).alias("rest"),
            _draw(seed, F.col("_key"), F.col("_shard").cast("string")).alias("start"),
        ),
        "quotas",
    )
    in_shard = Window.partitionBy("_key", "_shard").orderBy("_drawn", "_id", "size")
    placed = (
        sharded(sized)
        .withColumn("_end", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)))
        .join(quotas, ["_key", "_shard"])
    )
    begin, end = F.col("_end") - F.col("size"), F.col("_end")
    words, n = F.col("cell_words"), F.col("blocks")
    first = F.greatest(F.lit(0), F.floor(begin * n / words).cast("long") - 1)
    last = F.least(n - 1, F.floor(end * n / words).cast("long") + 1)

    def edge(j: Column) -> Column:
        return F.floor(j * words / n).cast("long")

    def overlap(acc: Column, j: Column) -> Column:
        chosen = F.pmod(j * F.lit(STEP) + F.col("start"), n) < F.col("rest")
        shared = F.greatest(F.lit(0), F.least(end, edge(j + 1)) - F.greatest(begin, edge(j)))
        return acc + F.when(chosen, shared).otherwise(F.lit(0))

    partly = F.when(
        (F.col("size") > 0) & (F.col("rest") > 0),
        F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), overlap),
    ).otherwise(F.lit(0))
    return placed.select(
        "_row.*",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + partly).cast("long").alias("taken"),
    )
