"""Mixing sources to target shares of tokens.

Every source's documents are put in a random order and cut into blocks of equal tokens. A mix is a row of slots of one block
each, for every source as many as its share asks for. Slot i lies at the i-th point of a golden-ratio sequence, and the
interval of the cumulative numbers of slots that the point's place falls in names its source, so the sources are spread evenly
at every length. A slot's rank among its source's slots says which tokens it takes of the source's row of blocks; beyond their
end they go round again, at most max_repeats times in all. A source whose slots ask for more than that falls short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from landchange.operators.sequence import running_sum
from landchange.session import stage

GOLDEN = 0.6180339887498949
#: Tokens of a block.
BLOCK_TOKENS = 256


def clean_targets(targets: DataFrame) -> DataFrame:
    """Targets as used: rows without mix or source are dropped, equal rows count once, null numbers are 0 shares and 1 use."""
    return targets.where("mix_id IS NOT NULL AND source IS NOT NULL").select(
        "mix_id", "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"), F.coalesce("corpus_share", F.lit(0.0)).alias("corpus_share")
    ).distinct()


def _planned(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """`mix_report` with max_repeats and corpus_share."""
    held = sizes.where("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    joined = clean_targets(targets).join(held, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    mix = Window.partitionBy("mix_id")  # a mix has as many rows as it has sources
    wanted = F.col("target_share") * F.col("corpus_share") * F.sum("source_tokens").over(mix)
    limited = joined.withColumn("wanted", wanted).withColumn("limit", F.col("max_repeats") * F.col("source_tokens"))
    given = limited.withColumn("given", F.least(F.col("wanted"), F.col("limit").cast("double"))).withColumn("short", F.col("limit") < F.col("wanted"))
    return given.withColumn("share", F.try_divide("given", F.sum("given").over(mix)))


def mix_report(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, source_tokens, wanted, limit, given, share, short) per target.

    sizes: (source, tokens) per document or pre-aggregated. wanted = target_share x corpus_share x tokens of all sources of
    the mix; limit = max_repeats x tokens of the source; short where limit < wanted; given is the lesser of the two, share
    its part of all that is given. A source without documents has size 0.
    """
    return _planned(sizes, targets).select("mix_id", "source", "target_share", "source_tokens", "wanted", "limit", "given", "share", "short")


def _asks(sizes: DataFrame, targets: DataFrame, block_tokens: int) -> DataFrame:
    """A row per target, written once: its number in its mix, the tokens it asks for and its part (_low, _high] of the mix's
    slots, the last of which may be asked for in part."""
    order = Window.partitionBy("mix_id").orderBy("source", "target_share", "max_repeats", "corpus_share")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    asked = _planned(sizes, targets).withColumn("asked", F.greatest(F.ceil("wanted"), F.lit(0).cast("long")))
    slots = F.expr(f"CASE WHEN asked > 0 THEN (asked - 1) div {block_tokens} + 1 ELSE 0 END")
    bounds = asked.withColumn("target", F.row_number().over(order)).withColumn("_high", F.sum(slots).over(upto)).withColumn("_low", F.col("_high") - slots)
    return stage(bounds.select("mix_id", "target", "source", "max_repeats", "source_tokens", "wanted", "asked", "_low", "_high"), "asks")


def _slots(asks: DataFrame) -> DataFrame:
    """(mix_id, slot, _rank, and target, source, max_repeats, source_tokens, asked of the slot's target); _rank from 0."""
    # a mix's slots are made where they are needed, in runs of 10,000
    run = 10_000
    per_mix = asks.groupBy("mix_id").agg(F.max("_high").alias("_slots"))
    runs = per_mix.where("_slots > 0").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_slots") - 1) / run)))).repartition("mix_id", "_run")
    slots = runs.withColumn("slot", F.explode(F.sequence(F.col("_run") * run, F.least((F.col("_run") + 1) * run, F.col("_slots")) - 1)))
    points = slots.select("mix_id", "slot", F.pmod((F.col("slot") + 0.5) * F.lit(GOLDEN), F.lit(1.0)).alias("_point"))
    placed = running_sum(points, ["mix_id"], [F.col("_point"), F.col("slot")], None, "_place")
    # a row per target is broadcast
    chosen = placed.join(F.broadcast(asks), "mix_id").where("_place > _low AND _place <= _high")
    flat = chosen.select("mix_id", "slot", "target", "source", "max_repeats", "source_tokens", "asked")
    return running_sum(flat, ["mix_id", "target"], [F.col("slot")], None, "_rank").withColumn("_rank", F.col("_rank") - 1)


def _taken(asks: DataFrame, block_tokens: int) -> DataFrame:
    """(mix_id, slot, target, source, repeat, block, _from, _to): the tokens, counted from the source's first, that each slot
    takes, by round of the source and block. What lies beyond the last round is left out."""
    ends = _slots(asks).withColumn("_begin", F.col("_rank") * block_tokens).withColumn("_end", F.least(F.col("_begin") + block_tokens, F.col("asked")))
    size = "nullif(source_tokens, 0)"
    rounds = ends.where(f"_begin div {size} < max_repeats").withColumn("repeat", F.explode(F.expr(f"sequence(_begin div {size}, least((_end - 1) div {size}, max_repeats - 1))")))
    cut = rounds.withColumn("_from", F.expr("greatest(_begin - repeat * source_tokens, 0)")).withColumn("_to", F.expr("least(_end - repeat * source_tokens, source_tokens)"))
    return cut.select("mix_id", "slot", "target", "source", F.col("repeat").cast("int").alias("repeat"), F.explode(F.expr(f"sequence(_from div {block_tokens}, (_to - 1) div {block_tokens})")).alias("block"), "_from", "_to")


def _placed(documents: DataFrame, key: str, seed: int) -> DataFrame:
    """(key, source, tokens, _first, _through): where each document begins and ends in its source's random order."""
    named = documents.where("source IS NOT NULL").withColumn("_at", F.xxhash64(F.lit(seed), F.col(key)))
    placed = running_sum(named.select(key, "source", "tokens", "_at"), ["source"], [F.col("_at"), F.col(key)], F.col("tokens"), "_through")
    return placed.withColumn("_first", F.col("_through") - F.coalesce("tokens", F.lit(0)))


def mix(documents: DataFrame, key: str, targets: DataFrame, seed: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixes: (mix_id, slot, source, repeat, key, tokens), a row for each use of a document.

    documents: (key, source, tokens), key unique; rows without source are in no mix. A document is taken whole by the slot that
    takes its first token, so the slots of a long document's further tokens stay empty; a document of 0 tokens goes with the
    token before it. Sources that are used up leave their further slots out, as `fall_short` tells.
    """
    taken = _taken(_asks(documents, targets, block_tokens), block_tokens)
    held = _placed(documents, key, seed).withColumn("_first", F.expr("CASE WHEN _first = _through THEN greatest(_first - 1, 0) ELSE _first END"))
    blocks = held.select(key, "source", "tokens", "_first", F.expr(f"_first div {block_tokens}").alias("block"))
    return taken.join(blocks, ["source", "block"]).where("_first >= _from AND _first < _to").select("mix_id", "slot", "source", "repeat", key, "tokens")


def fall_short(documents: DataFrame, key: str, targets: DataFrame, seed: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(mix_id, source, wanted, found) of the targets whose slots find fewer tokens in the source's blocks, max_repeats rounds
    of them, than they want. Blocks are cut here at the token, through documents; they hold block_tokens each, the last the rest.
    """
    asks = _asks(documents, targets, block_tokens)
    cut = _placed(documents, key, seed).where("_first < _through").withColumn("block", F.explode(F.expr(f"sequence(_first div {block_tokens}, (_through - 1) div {block_tokens})")))
    start = F.col("block") * block_tokens
    blocks = cut.groupBy("source", "block").agg(F.sum(F.least("_through", start + block_tokens) - F.greatest("_first", start)).alias("_held"))
    met = _taken(asks, block_tokens).join(blocks, ["source", "block"]).withColumn("_tokens", F.least("_to", start + F.col("_held")) - F.greatest("_from", start))
    found = met.groupBy("mix_id", "target").agg(F.sum("_tokens").alias("found"))
    return asks.join(found, ["mix_id", "target"], "left").withColumn("found", F.coalesce("found", F.lit(0))).where("found < wanted").select("mix_id", "source", "wanted", "found")


def drawn_report(documents: DataFrame, key: str, targets: DataFrame) -> DataFrame:
    """`mix_report` with what the mix holds: drawn, the tokens of its rows, and drawn_share, their part of the mix's. given and
    share are planned; whole documents and slots of used-up sources make the two differ."""
    drawn = mix(documents, key, targets).groupBy("mix_id", "source").agg(F.sum("tokens").alias("drawn"))
    joined = mix_report(documents.select("source", "tokens"), targets).join(drawn, ["mix_id", "source"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    return joined.withColumn("drawn_share", F.try_divide("drawn", F.sum("drawn").over(Window.partitionBy("mix_id"))))
