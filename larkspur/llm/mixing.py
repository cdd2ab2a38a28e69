"""Mixing of sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.scan import WORD
from larkspur.operators.ordering import with_position
from larkspur.session import materialize

MAX_REPEATS = 3
# Rows that one task orders at a time, on average.
BUCKET_ROWS = 4_000
# Buckets that one task adds up.
GROUP = 4_096
_HASH_RANGE = 1 << 32


def targets(sizes: DataFrame, most: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources weigh 1, 2, 3, 1, ... in code point order, null last. All sizes together
    are shared by weight; a source stops at ``most`` times its size and the excess is
    shared again among the others, until none stops any more. Each round of sharing is one
    aggregate, and sources are numbered by position, so their number is not bounded.
    """
    placed = with_position(sizes, [F.asc_nulls_last("source")], "_turn")
    cap = F.lit(float(most)) * F.col("source_size")
    df = placed.select("source", "source_size", (F.col("_turn") % 3 + 1).alias("weight"))
    df = materialize(df, "sources")
    level, stopped = 0.0, -1
    while True:
        stops = (cap < F.lit(level) * F.col("weight")) if stopped >= 0 else F.lit(False)
        now = df.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"), F.count_if(stops).alias("stopped"),
            F.coalesce(F.sum(F.when(stops, F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if now["stopped"] == stopped or not now["weight"]:
            break
        level, stopped = (now["all"] - most * now["full"]) / now["weight"], now["stopped"]
    share = F.lit(level) * F.col("weight") if now["weight"] else cap
    return df.select("source", "source_size", F.least(cap, share).alias("target"))


def _bases(sums: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _bucket, _base): what the earlier buckets of the same keys add up to.

    Buckets are added up in groups of ``GROUP`` first, so no task orders all of them.
    """
    sums = sums.withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    groups = sums.groupBy(*keys, "_group").agg(F.sum("_sum").alias("_whole"))
    before = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_start", F.coalesce(F.sum("_whole").over(before), F.lit(0))).drop("_whole")
    inside = Window.partitionBy(*keys, "_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_earlier", F.coalesce(F.sum("_sum").over(inside), F.lit(0)))
    joined = _join_same(sums, groups, [*keys, "_group"])
    return joined.select(*keys, "_bucket", (F.col("_start") + F.col("_earlier")).alias("_base"))


def _join_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on equal keys, null among them."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    joined = left.join(right, condition)
    for k in keys:
        joined = joined.drop(right[k])
    return joined


def _running(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], value: str, name: str) -> DataFrame:
    """Running sum of ``value`` within ``keys``, in an order of which ``bucket`` is the start.

    Sums of whole buckets are added up first, so no task orders more than a bucket.
    """
    df = df.withColumn("_bucket", bucket)
    sums = df.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_sum"))
    here = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_local", F.sum(value).over(here))
    joined = _join_same(local, _bases(sums, keys), [*keys, "_bucket"])
    return joined.withColumn(name, F.col("_base") + F.col("_local")).drop("_bucket", "_base", "_local")


def mix_sources(docs: DataFrame, most: int = MAX_REPEATS, seed: str = "") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of (doc_id, source, text).

    Each source is shuffled by a hash of its ids, and each of its documents gets a
    virtual finish time: words of the source up to and with it, divided by the target.
    Sources that are taken more than once go round again. All finish times are sorted
    together and taken until the words reach the total budget. The same rows give the
    same mix in any layout.

    A source or a finish time that owns much of the data is cut into buckets by hash or
    by time; only sums of buckets are ordered as a whole. Rows are counted, never
    dropped. Null texts have size 0; null sources are a source, the last. Repeated rows
    count each. Sources of size 0 have target 0 and take nothing. Empty table: no rows.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"))
    rows = rows.withColumn("_key", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = materialize(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sizes, most), "targets")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    buckets = max(1, -(-total["n"] // BUCKET_ROWS))

    hashed = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    ordered = _running(
        rows, ["source"], F.floor(hashed * buckets / _HASH_RANGE),
        [F.col("_key"), F.col("doc_id"), F.col("size")], "size", "_upto",
    )
    keyed = ordered.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    keyed = keyed.drop("_source")
    # A round beyond the last that the target can reach is never taken: times over 1 only
    # matter for the rest of the budget that whole documents leave over, one round more.
    last = F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size")).cast("int"))
    copies = keyed.where("size > 0 and target > 0").withColumn("_round", F.explode(F.sequence(F.lit(0), last)))
    time = (F.col("_round") * F.col("source_size") + F.col("_upto")) / F.col("target")
    copies = copies.select("doc_id", "source", "_key", "_upto", "size", "_round", time.alias("_time"))
    queue = _running(
        copies, [], F.floor(F.col("_time") * buckets),
        [F.col("_time"), F.asc_nulls_last("source"), F.col("_key"), F.col("doc_id"), F.col("_upto"), F.col("_round")],
        "size", "_queued",
    )
    # Repeated rows differ in _upto, so (source, _key, _upto) names a row.
    taken = queue.where(F.col("_queued") <= total["size"]).groupBy("source", "_key", "_upto").agg(F.sum("size").alias("taken"))
    taken = taken.select(F.col("source").alias("_s"), F.col("_key").alias("_k"), F.col("_upto").alias("_u"), "taken")
    joined = keyed.join(
        taken, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_key") == F.col("_k")) & (F.col("_upto") == F.col("_u")) & (F.col("size") > 0), "left"
    )
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def take_mix(docs: DataFrame, most: int = MAX_REPEATS, seed: str = "") -> DataFrame:
    """The rows of ``docs``, all columns, as often as :func:`mix_sources` takes them.

    Rows that agree in doc_id, source and size share what is taken of them evenly, the
    first ones by a hash of the text once more.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")

    def key(size: Column) -> Column:
        return F.to_json(F.struct(F.col("doc_id"), F.col("source"), size.alias("size")))

    mixed = mix_sources(docs.select("doc_id", "source", "text"), most, seed).where("taken > 0")
    times = mixed.select(key(F.col("size")).alias("_key"), (F.col("taken") / F.col("size")).cast("int").alias("t"))
    times = times.groupBy("_key").agg(F.sum("t").alias("_times"))
    rows = docs.select(F.struct("*").alias("_row"), key(size).alias("_key"), F.xxhash64("text").alias("_hash"))
    alike = Window.partitionBy("_key")
    rows = rows.withColumns({"_rows": F.count("*").over(alike), "_at": F.row_number().over(alike.orderBy("_hash"))})
    rows = rows.join(times, "_key")
    often = F.expr("_times div _rows + if(_at <= _times % _rows, 1, 0)").cast("int")
    rows = rows.withColumn("_often", often).where("_often > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_often")))).select("_row.*")
