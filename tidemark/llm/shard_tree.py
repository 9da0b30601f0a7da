"""Sharding by a hierarchical weighted hash tree: region, then rack, then shard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored, with_row_ids

OVERHEAD_BYTES = 16


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree. A rack weighs what its shards weigh, a region what its racks weigh."""

    number: int
    region: int
    rack: int
    weight: float = 1.0


def fleet(regions: int = 4, racks: int = 2, shards: int = 5) -> list[Shard]:
    """A full tree: ``regions`` x ``racks`` x ``shards`` leaves of weight one, numbered from 0."""
    return [
        Shard(n, n // (racks * shards), n // shards % racks) for n in range(regions * racks * shards)
    ]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """``tree`` with one more shard, which is a region of its own.

    No old subtree changes its weight, so rows move into the new shard and nowhere else. (A shard that
    joins an existing rack changes the weights of that rack and region instead; rows then move into
    that region, and within it into that rack, but may land on any shard there.)
    """
    number, region = max(s.number for s in tree) + 1, max(s.region for s in tree) + 1
    return [*tree, Shard(number, region, 0, weight)]


def _children(tree: list[Shard]) -> tuple[list, dict, dict]:
    """Children with their weights: of the root, of each region, of each (region, rack)."""
    racks: dict[int, dict[int, float]] = {}
    shards: dict[str, list[tuple[int, float]]] = {}
    for s in tree:
        of = racks.setdefault(s.region, {})
        of[s.rack] = of.get(s.rack, 0.0) + s.weight
        shards.setdefault(f"{s.region}/{s.rack}", []).append((s.number, s.weight))
    regions = [(region, sum(of.values())) for region, of in racks.items()]
    return regions, {region: list(of.items()) for region, of in racks.items()}, shards


def _literal(children: list[tuple[int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("child"), F.lit(float(w)).alias("weight")) for n, w in children])


def _draw(key: Column, prefix: Column, children: Column) -> Column:
    """The child with the smallest exponential draw: each wins in proportion to its weight.

    The draw of a child depends on the key and the child's path alone, so another child's change of
    weight never moves a key between the rest.
    """

    def drawn(c: Column) -> Column:
        path = F.concat_ws("/", prefix, c["child"].cast("string"))
        digits = F.substring(F.md5(F.concat_ws(":", key, path)), 1, 12)
        uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**48))
        return F.struct((-F.ln(uniform) / c["weight"]).alias("draw"), c["child"].alias("child"))

    return F.array_min(F.transform(children, drawn))["child"]


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """Expression for the shard of ``key`` (text): three draws, each among the children of one node."""
    regions, racks, shards = _children(tree)
    pick_rack = F.create_map(*[x for r, c in racks.items() for x in (F.lit(r), _literal(c))])
    pick_shard = F.create_map(*[x for r, c in shards.items() for x in (F.lit(r), _literal(c))])
    region = _draw(key, F.lit("region"), _literal(regions))
    # let each choice be computed once: a lambda over a one-element array names it
    level = F.transform(
        F.array(region),
        lambda r: F.struct(
            r.alias("region"),
            _draw(key, F.concat_ws("/", F.lit("rack"), r.cast("string")), pick_rack[r]).alias("rack"),
        ),
    )
    found = F.transform(
        level,
        lambda x: _draw(
            key,
            F.concat_ws("/", F.lit("shard"), x["region"].cast("string"), x["rack"].cast("string")),
            pick_shard[F.concat_ws("/", x["region"].cast("string"), x["rack"].cast("string"))],
        ),
    )
    return found[0]


def assign_shards(
    docs: DataFrame,
    tree: list[Shard] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Shard of every row, its place there, and its shard after one more is added.

    Columns: ``doc_id``, ``size`` (bytes of the text and a fixed overhead), ``text_crc32``, ``law``
    (``key``: the id and the tree alone decide), ``shard``, ``slot`` (gapless from 0 in each shard, by
    id), ``grown_shard``. A null text counts as empty; rows with a null id share the shard of the
    empty key; rows with one id share a shard and have slots of their own. Other columns are ignored.

    The text is read once, for its size and checksum; the rest works on five numbers per row. Rows are
    sorted into ranges of ids, counted per shard and range, and numbered from the sums of those counts,
    so a shard that holds most rows is numbered by as many tasks as it has ranges.
    """
    tree = tree or fleet()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    sized = source.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grown(tree)).alias("grown_shard"),
    )
    rows = stored(with_row_ids(sized), "shards-rows")
    ranged = rows.repartitionByRange("doc_id", "rid").withColumn("chunk", F.spark_partition_id())
    rows = stored(ranged, "shards-ranges")

    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "rid")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "chunk"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("base") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )
