"""Resharding that moves the fewest bytes, on files.

A layout is a folder of Parquet files, one folder an old shard and in it one a block; blocks hold what some of
the writing tasks had of the shard, about BLOCK_BYTES each.  From the bytes
of each old shard and the capacity of each new one, a minimum-cost flow (a byte that stays
costs nothing, a byte that moves costs one) says how many bytes go from where to where.  Each
old shard's blocks are then given to its flows in order; only a block in which one flow
ends is split.  Blocks that stay whole are left in their files; blocks that move, and both parts of split
ones, are written anew.  The new layout is read back from both.

The driver holds one row per block, that is one for every BLOCK_BYTES of text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import parallelism, scratch_path
from .common import stage, table


def min_cost_flow(supply: list[int], demand: list[int], cost) -> dict[tuple[int, int], int]:
    """Cheapest integer flow {(i, j): amount} that sends every supply i within the demands j.

    Successive shortest paths (Bellman-Ford, negative residual arcs); ``cost(i, j)`` is
    an amount's price a unit.  The demands must sum to at least the supplies.
    """
    n, m = len(supply), len(demand)
    source, sink = n + m, n + m + 1
    arcs: list[list[int]] = []  # from, to, room, price; arc k ^ 1 is its reverse

    def add(u: int, v: int, room: int, price: int) -> None:
        arcs.extend(([u, v, room, price], [v, u, 0, -price]))

    for i, s in enumerate(supply):
        add(source, i, s, 0)
        for j in range(m):
            add(i, n + j, s, cost(i, j))
    for j, d in enumerate(demand):
        add(n + j, sink, d, 0)
    left = sum(supply)
    while left:
        far = {source: 0}
        via: dict[int, int] = {}
        changed = True
        while changed:
            changed = False
            for k, (u, v, room, price) in enumerate(arcs):
                if room and u in far and far[u] + price < far.get(v, 1 << 62):
                    far[v], via[v], changed = far[u] + price, k, True
        if sink not in far:
            raise ValueError("the capacities do not hold the data")
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = arcs[via[v]][0]
        amount = min(arcs[k][2] for k in path)
        for k in path:
            arcs[k][2] -= amount
            arcs[k ^ 1][2] += amount
        left -= amount
    return {(u, v - n): arcs[k ^ 1][2] for k, (u, v, _, _) in enumerate(arcs) if u < n <= v < n + m and k % 2 == 0 and arcs[k ^ 1][2]}


def cuts(blocks: list[tuple[int, int, int]], flow: dict[tuple[int, int], int], old: list[int], names: list[int]) -> list[tuple[int, int, int, int]]:
    """(old_shard, block, from_byte, shard): where in each block each new shard's part begins.

    ``blocks``: (old_shard, block, bytes).  A shard's own bytes come first, then the others in order.
    """
    out = []
    for i, shard in enumerate(old):
        parts = sorted(((names[j], amount) for (k, j), amount in flow.items() if k == i), key=lambda p: (p[0] != shard, p[0]))
        at, start = 0, 0  # the part we are in, and its first byte
        position = 0
        for _, block, size in sorted(b for b in blocks if b[0] == shard):
            out.append((shard, block, 0, parts[at][0]))
            while at + 1 < len(parts) and start + parts[at][1] < position + size:
                start += parts[at][1]
                at += 1
                if start > position:
                    out.append((shard, block, start - position, parts[at][0]))
                else:
                    out[-1] = (shard, block, 0, parts[at][0])
            position += size
    return out


BLOCK_BYTES = 64 << 20
#: Blocks of a small shard, so that a split rewrites a small part of it.
LEAST_BLOCKS = 16
LAYOUT = "doc_id long, text string, size long, old_shard int, block int"


def write_layout(docs: DataFrame, out: str) -> None:
    """Write ``docs`` (doc_id, text, old_shard) to the new folder ``out`` as a layout of old shards and blocks, without a shuffle.

    A writing task makes one file a shard; small inputs of many parts are written by a task for every BLOCK_BYTES
    (and core), so that there are few files.  A row's size is its text's UTF-8 bytes (null: none) plus 1.  A null old_shard (in no shard yet) is the folder -1.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("size"), F.coalesce(F.col("old_shard").cast("int"), F.lit(-1)).alias("old_shard"))
    spark = docs.sparkSession
    held = [(s, n, max(LEAST_BLOCKS, -(-n // BLOCK_BYTES))) for s, n in rows.groupBy("old_shard").agg(F.sum("size")).collect()]  # a row an old shard
    blocks = spark.createDataFrame(held, "old_shard int, bytes long, blocks long").drop("bytes")
    tasks = max(parallelism(spark), -(-sum(n for _, n, _ in held) // BLOCK_BYTES))
    dealt = rows.coalesce(tasks).join(F.broadcast(blocks), "old_shard").withColumn("block", F.pmod(F.spark_partition_id(), "blocks").cast("int"))
    dealt.select("doc_id", "text", "size", "old_shard", "block").write.partitionBy("old_shard", "block").parquet(out)


def reshard_layout(spark, layout: str, out: str, shards: int = 16, capacities: list[int] | None = None) -> DataFrame:
    """Rows (doc_id, text, size, shard, old_shard, block, moved) of the new layout, read from the files that stay in ``layout`` and those written below ``out``.

    ``capacities`` are the bytes of the new shards 0 .. shards - 1, by default equal; together they must hold
    the rows.  A row in a split block goes by the middle of its bytes, so a shard misses its capacity by at most
    half a row for each part it has.  An empty layout gives no rows.
    """
    old = spark.read.schema(LAYOUT).parquet(layout)
    sums = [tuple(r) for r in old.groupBy("old_shard", "block").agg(F.sum("size")).collect()]
    columns = ["doc_id", "text", "size", "shard", "old_shard", "block"]
    if not sums:
        return old.withColumn("shard", F.lit(0)).select(*columns, F.lit(True).alias("moved"))
    names = sorted({s for s, _, _ in sums})
    supply = [sum(n for s, _, n in sums if s == shard) for shard in names]
    total = sum(supply)
    capacities = capacities or [total // shards + (j < total % shards) for j in range(shards)]
    flow = min_cost_flow(supply, capacities, lambda i, j: int(names[i] != j))
    places = spark.createDataFrame(cuts(sums, flow, names, list(range(shards))), "old_shard int, block int, from_byte long, shard int")
    by_block = stage(places.groupBy("old_shard", "block").agg(F.sort_array(F.collect_list(F.struct("from_byte", "shard"))).alias("parts")), "reshard-plan")
    whole = by_block.where("size(parts) = 1").select("old_shard", "block", F.expr("parts[0].shard").alias("shard"))
    kept, gone, split = (F.broadcast(x) for x in (whole.where("shard = old_shard"), whole.where("shard <> old_shard"), by_block.where("size(parts) > 1")))
    on = ["old_shard", "block"]
    # whole blocks go from file to file, without a shuffle
    old.join(gone, on).select(*columns).write.partitionBy("shard").parquet(f"{out}/moved")
    before = Window.partitionBy(*on).orderBy("doc_id", "size", "text").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    parted = old.join(split, on).withColumn("middle", middle).withColumn("shard", F.expr("element_at(filter(parts, p -> p.from_byte <= middle), -1).shard"))
    parted.select(*columns).write.partitionBy("shard").parquet(f"{out}/split")
    anew = [spark.read.schema(f"{LAYOUT}, shard int").parquet(f"{out}/{kind}").select(*columns) for kind in ("moved", "split")]
    rows = old.join(kept, on).select(*columns).unionByName(anew[0]).unionByName(anew[1])
    return rows.withColumn("moved", F.col("shard") != F.col("old_shard"))


def reshard(docs: DataFrame, shards: int = 16, capacities: list[int] | None = None, out: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, old_shard, block, moved): the new place of every row of ``docs``.

    ``docs``: doc_id, text, old_shard (an int; null: in no shard yet, everything moves).  They are written as a
    layout of their old shards below ``out`` (a new folder in the shared checkpoint folder by default), that
    layout is resharded, and the rows are read back from its files (see ``write_layout`` and ``reshard_layout``).
    Slots are gapless from 0 in each shard.  Rows with the same or no id are rows like
    any others; extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, "reshard")
    write_layout(docs, f"{out}/old")
    rows = reshard_layout(spark, f"{out}/old", f"{out}/new", shards, capacities)
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32")
    found = stage(rows.select("doc_id", "size", crc, "shard", "old_shard", "block", "moved"), "reshard-rows")

    piece = ["shard", "old_shard", "block"]
    bases = found.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    bases = bases.select(*piece, F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    numbered = found.withColumn("n", F.row_number().over(Window.partitionBy(*piece).orderBy("doc_id", "size", "text_crc32")))
    return numbered.join(bases, piece).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("n") - 1).alias("slot"), "old_shard", "block", "moved")


def op8_min_move_resharding(spark, sf_dir):
    """Documents held by source in 12 shards (a stand-in for an old layout) go to 16 of equal bytes; edge cases as in ``reshard``."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(12)).cast("int")
    placed = reshard(table(spark, sf_dir, "documents").select("doc_id", "text", old.alias("old_shard")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


QUERIES = {"op8_min_move_resharding": op8_min_move_resharding}
ORACLES: dict[str, str] = {}
