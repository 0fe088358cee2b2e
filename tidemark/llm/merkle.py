"""A Merkle manifest of a dataset: leaf digests, subroots per tree, one root, and a proof for every row.

Rows are put in order by sampled range splitters and numbered by prefix sums over (range, tree). The
nodes above them are hashed in aligned cells of some hundred places, several levels at a time, so no
group grows with the input. Proofs come from pointer jumping: each node starts with the digests of its
siblings and a pointer to its parent; joining the nodes with themselves doubles the distance of every
pointer and appends the segment of the node pointed to, until all pointers have reached the root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored

#: Rows that one task puts in order.
RANGE_ROWS = 500_000
#: A cell has a power of the fan of places, so many at most.
CELL_PLACES = 1_000
#: Ancestors of one level are broadcast if there are so many at most: their segments are below 10 MB then.
FEW_NODES = 5_000

#: The number of the tree over the subroots; the others are counted from 0.
_TOP = -1
_NODE = "tree long, level int, place long, n long, digest binary, segment binary"


def digest_of(*columns: Column) -> Column:
    """SHA-256 in hex of the columns: ``-`` if null, else the UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def _hash(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join([d.hex().encode() for d in digests])).digest()


def _sizes(n: int, fan: int) -> list[int]:
    """Nodes per level, down to one."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // fan))
    return out


def _height(n: int, fan: int) -> int:
    return len(_sizes(n, fan)) - 1


def _cell_levels(fan: int) -> int:
    return max(1, int(math.log(CELL_PLACES, fan)))


def _grow(base: int, steps: int, fan: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes of one cell: its own, with their siblings, the levels above, and last the node that stands for it.

    That last node has no segment yet, as its siblings are in other cells.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("place")
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        first, digests = table["place"][0].as_py(), table["digest"].to_pylist()
        levels, places, sizes, hashes, segments = [], [], [], [], []
        level = base
        while n > 1 and level < base + steps:
            runs = [digests[i : i + fan] for i in range(0, len(digests), fan)]
            for run_of in runs:
                segments += [b"".join(run_of[:i] + run_of[i + 1 :]) for i in range(len(run_of))]
            levels += [level] * len(digests)
            places += range(first, first + len(digests))
            sizes += [n] * len(digests)
            hashes += digests
            digests = [_hash(r) for r in runs]
            first, n, level = first // fan, -(-n // fan), level + 1
        count = len(levels) + 1
        rows = table["row"].combine_chunks()
        if isinstance(rows, pa.ChunkedArray):
            rows = pa.concat_arrays(rows.chunks) if rows.num_chunks else pa.nulls(0, rows.type)
        return pa.table(
            {
                "tree": pa.array([tree] * count, pa.int64()),
                "level": pa.array([*levels, level], pa.int32()),
                "place": pa.array([*places, first], pa.int64()),
                "n": pa.array([*sizes, n], pa.int64()),
                "digest": pa.array([*hashes, digests[0]], pa.binary()),
                "segment": pa.array([*segments, None], pa.binary()),
                "row": pa.concat_arrays([rows, pa.nulls(count - len(rows), rows.type)]),
            }
        )

    return run


def _grown(rows: DataFrame, most: int, base: int, fan: int) -> DataFrame:
    """All nodes over ``rows`` (tree, place, n, digest, row) at level ``base``, of whose trees the largest has ``most``.

    A node without a segment and with ``n`` 1 is the only one of its level: the root of its tree.
    """
    kind = rows.schema["row"].dataType.simpleString()
    steps, out = _cell_levels(fan), None
    while True:
        celled = rows.select("tree", "place", "n", "digest", "row", F.expr(f"place div {fan**steps}L").alias("cell"))
        grown = celled.groupBy("tree", "cell").applyInArrow(_grow(base, steps, fan), f"{_NODE}, row {kind}")
        grown = stored(grown, "merkle-nodes")
        # What stands for a cell comes again in the next stage, with its siblings.
        done = grown.filter("segment IS NOT NULL OR n = 1")
        out = done if out is None else out.unionByName(done)
        most, base = -(-most // fan**steps), base + steps
        if most <= 1:
            return out
        rows = grown.filter("segment IS NULL AND n > 1").withColumn("row", F.lit(None).cast(kind))


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (tree, key, digest, row) with their place in their tree, and the cells (part, tree) they came from.

    Equal rows differ by a number of their own, so that a hot key is no single range.
    """
    order = ["tree", "key", "digest", "own"]
    parts = -(-rows.count() // RANGE_ROWS)
    ranged = rows.withColumn("own", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    numbered = ranged.sortWithinPartitions(*order).select(
        F.col("tree").alias("name"),
        "digest",
        "row",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
    )
    numbered = stored(numbered, "merkle-order")
    cells = stored(numbered.groupBy("part", "name").agg(F.min("at").alias("low"), F.count("*").alias("rows")), "merkle-cells")
    trees = cells.groupBy("name").agg(F.min("part").alias("part"), F.sum("rows").alias("n"))
    begun = trees.groupBy("part").agg(F.count("*").alias("trees"))
    # As many rows as ranges at most.
    ahead = begun.select("part", (F.sum("trees").over(Window.orderBy("part")) - F.col("trees")).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("name")) - 1
    ranked = trees.withColumn("inside", inside).join(ahead, "part")
    ranked = ranked.select(F.col("name").alias("its_name"), (F.col("ahead") + F.col("inside")).alias("tree"), "n")
    before = F.sum("rows").over(Window.partitionBy("name").orderBy("part")) - F.col("rows")
    cells = cells.withColumn("shift", before - F.col("low")).join(ranked, F.col("name").eqNullSafe(F.col("its_name")))
    cells = stored(cells.select("part", "name", "shift", "tree", "n"), "merkle-cells")
    of = cells.select(F.col("part").alias("its_part"), F.col("name").alias("its_name"), "shift", "tree", "n")
    met = numbered.join(of, (F.col("part") == F.col("its_part")) & F.col("name").eqNullSafe(F.col("its_name")))
    placed = met.select(
        "tree", (F.col("at") + F.col("shift")).alias("place"), "n", "digest", F.struct("part", "row").alias("row")
    )
    return placed, cells


def _doubled(nodes: DataFrame, ancestors: DataFrame, distance: int, few: bool) -> DataFrame:
    """Each node's pointer goes on to where its ancestor's points, and its segment is followed by the ancestor's."""
    there = ancestors.select(
        (F.col("level") - distance).alias("level"),
        F.col("tree").alias("up_tree"),
        F.col("place").alias("up_place"),
        F.col("segment").alias("more"),
        F.col("up_tree").alias("next_tree"),
        F.col("up_place").alias("next_place"),
    )
    joined = nodes.join(F.broadcast(there) if few else there.hint("merge"), ["level", "up_tree", "up_place"], "left")
    others = [c for c in nodes.columns if c not in ("segment", "up_tree", "up_place")]
    return joined.select(
        *others,
        F.concat("segment", F.coalesce("more", F.lit(b""))).alias("segment"),
        F.col("next_tree").alias("up_tree"),
        F.col("next_place").alias("up_place"),
    )


def _with_parents(nodes: DataFrame, most: int, trees: int, height: int, fan: int) -> DataFrame:
    """Nodes of trees (levels below ``most``), of the level at which they meet, and of the top tree, with pointers."""
    up = F.expr(f"place div {fan}L")
    meets = (F.col("level") == most) & (F.col("tree") != _TOP)
    return nodes.select(
        "*",
        F.when(F.col("level") == height, None)
        .when(meets, F.lit(_TOP).cast("long"))
        .otherwise(F.col("tree"))
        .alias("up_tree"),
        F.when(F.col("level") == height, None)
        .when(meets, F.expr(f"tree div {fan}L"))
        .otherwise(up)
        .alias("up_place"),
    )


def manifest(
    docs: DataFrame, leaf: str = "leaf", tree: str = "source", key: str = "doc_id", fan: int = 3
) -> DataFrame:
    """``row`` (the row of ``docs``), ``subroot``, ``root``, ``proof`` and ``position``, for each row.

    ``leaf`` holds the rows' digests in hex. Of each ``tree`` the leaves ascend by ``key``, a null key
    first, equal keys by digest; every ``fan`` consecutive nodes become the hash of their digests (the
    last run may have fewer) until one remains. Those, by tree, a null tree first, lead to the root
    in the same way. ``proof`` is the binary digests of the siblings, level by level up to the root,
    left to right, and ``position`` says where the leaf stands, as ``folded`` needs it. Equal rows are
    rows of their own at consecutive places. Columns of ``docs`` cannot clash with the results', as they
    are inside ``row``. No rows give no rows, and have no root.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    given = docs.select(
        F.col(f"`{tree}`").cast("string").alias("tree"),
        F.col(f"`{key}`").alias("key"),
        F.unhex(f"`{leaf}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    given = stored(given, "merkle-leaves")
    if given.isEmpty():
        return given.select(
            "row",
            F.lit("").alias("subroot"),
            F.lit("").alias("root"),
            F.lit(b"").alias("proof"),
            F.expr("struct(0L AS place, 0L AS n, 0L AS tree, 0L AS trees)").alias("position"),
        )
    placed, cells = _placed(given)
    largest, trees = cells.agg(F.max("n"), F.max("tree") + 1).first()
    most = _height(largest, fan)
    height = most + _height(trees, fan)
    nodes = _grown(placed, largest, 0, fan)
    # Trees meet at one level: a lower one goes up alone, without siblings.
    subroots = stored(nodes.filter("n = 1").select("tree", "level", "digest"), "merkle-subroots")
    tops = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(trees).cast("long").alias("n"),
        "digest",
        F.lit(None).cast("string").alias("row"),
    )
    top = _grown(tops, trees, most, fan)
    root = top.filter("n = 1").first()["digest"].hex()
    of_top = F.coalesce("segment", F.lit(b"")).alias("segment")
    meeting = top.filter(F.col("level") == most).select(F.col("place").alias("tree"), of_top)
    alone = subroots.select("tree", F.explode(F.sequence("level", F.lit(most))).alias("level"))
    alone = alone.join(meeting, "tree").select(
        "tree",
        "level",
        F.lit(0).cast("long").alias("place"),
        F.when(F.col("level") == most, F.col("segment")).otherwise(F.lit(b"")).alias("segment"),
    )
    lone = alone.filter("level = 0").select("tree", F.col("segment").alias("of_tree"))
    leaves = nodes.filter("level = 0").join(lone, "tree", "left")
    leaves = leaves.withColumn("segment", F.coalesce("segment", "of_tree")).drop("of_tree")
    columns = ["tree", "level", "place", "segment"]
    inner = nodes.filter("level > 0 AND n > 1").select(columns).unionByName(alone.filter("level > 0"))
    above = top.filter(F.col("level") > most).select("tree", "level", "place", of_top)
    inner = inner.unionByName(above)
    pointing = _with_parents(leaves, most, trees, height, fan)
    inner = stored(_with_parents(inner, most, trees, height, fan), "merkle-pointers")
    distance = 1
    while distance < height:
        odd, even = (inner.filter(f"level % {2 * distance} = {r}") for r in (distance, 0))
        few = odd.limit(FEW_NODES + 1).count() <= FEW_NODES
        pointing = _doubled(pointing, odd, distance, few)
        inner = stored(_doubled(even, odd, distance, few), "merkle-pointers")
        distance *= 2
    # By range as well: a tree can hold a third of all rows.
    of = cells.join(subroots.select("tree", F.hex("digest").alias("subroot")), "tree").select("tree", "part", "subroot")
    pointing = pointing.withColumn("part", F.col("row.part")).join(of, ["tree", "part"])
    return pointing.select(
        "row.row",
        F.lower("subroot").alias("subroot"),
        F.lit(root).alias("root"),
        F.col("segment").alias("proof"),
        F.struct("place", "n", "tree", F.lit(trees).cast("long").alias("trees")).alias("position"),
    )


def folded(spark: SparkSession, leaf: str, fan: int = 3) -> Column:
    """The root that the column ``leaf`` (hex) leads to with a row's ``proof`` and ``position``."""
    bounded_batches(spark)

    @F.arrow_udf("string")
    def fold(leaves: pa.Array, proofs: pa.Array, positions: pa.Array) -> pa.Array:
        out = []
        for leaf_of, proof, at in zip(leaves.to_pylist(), proofs.to_pylist(), positions.to_pylist(), strict=True):
            now, given = bytes.fromhex(leaf_of), 0
            for place, n in ((at["place"], at["n"]), (at["tree"], at["trees"])):
                while n > 1:
                    inside, first = place % fan, place - place % fan
                    others = min(fan, n - first) - 1
                    run = [proof[given + 32 * i : given + 32 * (i + 1)] for i in range(others)]
                    now = _hash(run[:inside] + [now] + run[inside:])
                    given, place, n = given + 32 * others, place // fan, -(-n // fan)
            out.append(now.hex())
        return pa.array(out, pa.string())

    return fold(F.col(leaf), F.col("proof"), F.col("position"))


def proof_digest() -> Column:
    """SHA-256 in hex of a row's ``proof``, its digests taken as hex text."""
    return F.sha2(F.lower(F.hex("proof")), 256)
