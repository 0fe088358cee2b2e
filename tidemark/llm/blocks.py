"""Exchanges in packed blocks: groups of documents ask, buckets of keys answer, groups apply.

A group is a few megabytes of whole documents, the unit that one task holds. It packs what it has to
ask into one compressed block per bucket. A bucket gets one block from each group that has something
in it, and sends each of them one answer. Documents cross one shuffle: both uses of the groups read
the same exchange. What a group finds twice it asks once, so a copy or passage that a third of all
rows hold reaches a bucket once per group, not once per row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import give_back

#: Bytes of text in a group, on average.
GROUP_BYTES = 8 * 2**20
#: A null doc_id comes after all others.
LAST_ID = 2**63 - 1

Blocks = Iterator[tuple[int, bytes]]


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0))).first()[0]


def grouped(docs: DataFrame, total: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(g, id, text, row): documents dealt into groups by a hash; ``row`` holds their other columns.

    A null id becomes the last one, a null text an empty one. The hash covers all columns but maps, so
    neither documents without an id nor copies under one id meet in one group. Rows that are equal in
    all columns and together larger than a group are dealt out by their partition and by how many of
    them it has had so far; as they are equal, it does not matter in which order a task reads them.
    """
    groups = max(1, -(-total // GROUP_BYTES))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    key = F.xxhash64(*hashed)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    columns = [
        F.pmod(key, F.lit(groups)).cast("int").alias("g"),
        F.coalesce(F.col(f"`{doc_id}`"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.struct(*rest).alias("row"),
    ]
    often = _repeated(docs, key, text) if groups > 1 else []
    if not often:
        return docs.select(*columns)
    alone = docs.filter(~key.isin(often)).select(*columns)
    copies = docs.filter(key.isin(often)).select(key.alias("key"), *columns)
    return alone.unionByName(copies.mapInArrow(_dealt(groups, GROUP_BYTES), alone.schema))


def _repeated(docs: DataFrame, key: Column, text: str) -> list[int]:
    """Hashes of the rows whose copies are larger than a group: fewer than there are groups."""
    size = F.sum(F.octet_length(F.col(f"`{text}`")))
    sizes = docs.groupBy(key.alias("key")).agg(size.alias("bytes"), F.count(F.lit(1)).alias("n"))
    return [r.key for r in sizes.filter((F.col("n") > 1) & (F.col("bytes") > GROUP_BYTES)).select("key").collect()]


def _dealt(groups: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives copies the group of a part: ``most`` bytes of the copies that one partition holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, had = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).to_pylist()
            dealt = []
            for key, size in zip(batch["key"].to_pylist(), sizes, strict=True):
                part = had[key] // most
                had[key] += size
                dealt.append(zlib.crc32(f"{key} {partition} {part}".encode()) % groups)
            names = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), *batch.columns[2:]], ["g", *names])

    return run


def in_order(group: pa.Table) -> pa.Table:
    """The documents of a group by id, then text: the same each time the group is computed."""
    order = [("id", "ascending"), ("text", "ascending")]
    return group.take(pc.sort_indices(group.select(["id", "text"]), order)).combine_chunks()


def columns_of(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    text = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string())
    return table["id"].to_numpy(), text


def asked(groups: DataFrame, ask: Callable[[pa.Table], Blocks]) -> DataFrame:
    """(bucket, g, block) of what each group asks."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = list(ask(in_order(group)))
        give_back()
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "g": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "block": pa.array([x for _, x in rows], pa.binary()),
            }
        )

    return groups.groupBy("g").applyInArrow(run, "bucket int, g int, block binary")


def answered(requests: DataFrame, answer: Callable[[list[bytes]], list[bytes | None]]) -> DataFrame:
    """(g, bucket, block) of a bucket's answers: one for each block, or none."""

    def run(key: tuple, bucket: pa.Table) -> pa.Table:
        answers = answer(bucket["block"].to_pylist())
        table = pa.table(
            {"g": bucket["g"], "bucket": bucket["bucket"], "block": pa.array(answers, pa.binary())}
        )
        give_back()
        return table.filter(pc.is_valid(table["block"]))

    return requests.groupBy("bucket").applyInArrow(run, "g int, bucket int, block binary")


def result_schema(groups: DataFrame, columns: str) -> T.StructType:
    """The schema of ``row``, as it is in the groups, and of the given columns."""
    return T.StructType([groups.schema["row"], *T.StructType.fromDDL(columns).fields])


def applied(
    groups: DataFrame,
    answers: DataFrame,
    apply: Callable[[pa.Table, dict[int, bytes]], pa.Table],
    schema: T.StructType,
) -> DataFrame:
    """What ``apply`` makes of each group, in the order of ``in_order``, and its answers by bucket."""

    def run(group: pa.Table, found: pa.Table) -> pa.Table:
        by_bucket = dict(zip(found["bucket"].to_pylist(), found["block"].to_pylist(), strict=True))
        out = apply(in_order(group), by_bucket)
        give_back()
        return out

    return groups.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(run, schema)


def sampled(total: int, most: int) -> Column:
    """A filter that keeps about ``most`` bytes of documents, drawn row by row; all of a small table."""
    return F.lit(True) if total <= most else F.rand(17) < most / total
