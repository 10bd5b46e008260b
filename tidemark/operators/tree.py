"""Digests of ordered rows as a tree.

Rows have numbers from 0 in each group. ``FAN`` consecutive rows make a node, whose digest is the SHA-256 of their
digests in order, as lower-case hexadecimal text one behind the other; ``FAN`` consecutive nodes make a node of
the next level, up to one node for each group. No task ever holds more than one node's list, however long
the group, and the result does not depend on how rows were dealt to tasks. Two trees are compared from the top:
only below nodes that differ is anything read, so a damaged row is found by its range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import number_in_order
from tidemark.scratch import Scratch

FAN = 1024
Keep = Callable[[DataFrame, str], DataFrame]


def grow(
    rows: DataFrame,
    keys: Sequence[str],
    number: str,
    digest: Column,
    keep: Keep,
    within: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    fan: int = FAN,
    alone: Column | None = None,
) -> DataFrame:
    """All levels: ``keys, level, node, digest, first, last`` and the measures.

    ``digest`` is a row's binary digest. ``within`` orders rows of the same number. ``measures`` are a row's whole
    numbers, summed over the rows of a node. ``first`` and ``last`` are the numbers of a node's rows.
    ``alone``, for rows that are read mostly in order, tells which have a number of their own: nodes of such rows are
    finished where they are read, and only nodes at the ends of what a task reads are shuffled.
    """
    measures = measures or {}
    listed = rows.select(
        *keys, *within, F.col(number).alias("_number"), digest.alias("_digest"), *[value.cast("bigint").alias(name) for name, value in measures.items()],
        *([] if alone is None else [alone.alias("_alone")]),
    )
    if alone is None:
        listed = listed.withColumn("_last", F.col("_number")).withColumn("_whole", F.lit(False))
    else:
        listed = _runs(listed, [*keys, *within], list(measures), fan)
    sums = {name: F.sum(name) for name in measures}
    level = _nodes(listed, keys, ["_number", *within], fan, F.min("_number"), F.max("_last"), sums, whole=True)
    levels = [keep(level, "level")]
    while not (wide := levels[-1].where(F.col("node") > 0).select(*keys).distinct()).isEmpty():
        # a group with one node is done, however high others grow
        below = levels[-1].join(wide, list(keys), "left_semi")
        below = below.withColumns({"_digest": F.col("digest"), "_number": F.col("node")})
        levels.append(keep(_nodes(below, keys, ["_number"], fan, F.min("first"), F.max("last"), sums), "level"))
    return reduce(DataFrame.unionByName, [df.withColumn("level", F.lit(n)) for n, df in enumerate(levels)])


def _nodes(rows, keys, order, fan, first, last, measures, whole=False):
    listed = F.array_sort(F.collect_list(F.struct(*order, "_digest")))
    text = F.array_join(F.transform(listed, lambda row: F.lower(F.hex(row["_digest"]))), "")
    digest = F.unhex(F.sha2(text, 256))
    if whole:
        digest = F.when((F.count("*") == 1) & F.max("_whole"), F.max("_digest")).otherwise(digest)
    node = F.expr(f"_number div {fan}").alias("node")
    return rows.groupBy(*keys, node).agg(
        digest.alias("digest"),
        first.alias("first"),
        last.alias("last"),
        *[measure.alias(name) for name, measure in measures.items()],
    )


def _runs(rows: DataFrame, same: list[str], sums: list[str], fan: int) -> DataFrame:
    """Rows that follow one another in one node as one row: ``_number`` and ``_last``, their digests one behind
    the other, or, of a node with all its rows, the node's digest, and the sums. Rows that are not alone stay."""

    def run(batches):
        # imported here, as the function is sent to workers that need not have this package
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def ints(column):
            return column.to_numpy(zero_copy_only=False)

        def ended(part):
            names, first, last, digests, totals, single = part
            text = b"".join(digests)
            whole = not single and last - first + 1 == fan
            if whole:
                text = hashlib.sha256(text.hex().encode()).digest()
            return (*names, first, last, None if digests == [None] else text, whole, *totals)

        def table(parts):
            columns = list(zip(*map(ended, parts)))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, made)], schema=made)

        made, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if made is None:
                kept = [batch.schema.field(name) for name in same]
                number = [pa.field("_number", pa.int64()), pa.field("_last", pa.int64())]
                made = pa.schema([*kept, *number, pa.field("_digest", pa.binary()), pa.field("_whole", pa.bool_()), *[pa.field(n, pa.int64()) for n in sums]])
            number, digest = ints(batch.column("_number")), batch.column("_digest")
            single = ~ints(pc.fill_null(batch.column("_alone"), False)).astype(bool) | ints(pc.is_null(digest)).astype(bool)
            starts = np.ones(len(number), bool)
            starts[1:] = (np.diff(number) != 1) | (number[1:] % fan == 0) | single[1:] | single[:-1]
            for name in same:
                column = batch.column(name)
                starts[1:] |= ~ints(pc.fill_null(pc.equal(column[1:], column[:-1]), False)).astype(bool)
            at = np.flatnonzero(starts)
            totals = [np.add.reduceat(ints(batch.column(name)), at).tolist() for name in sums]
            ends, parts = np.append(at[1:], len(number)), []
            offsets = np.frombuffer(digest.buffers()[1], np.int32, len(number) + 1, 4 * digest.offset)
            body = memoryview(digest.buffers()[2]) if digest.buffers()[2] is not None else b""
            for i, (a, b) in enumerate(zip(at.tolist(), ends.tolist())):
                names, text = [batch.column(name)[a].as_py() for name in same], bytes(body[offsets[a] : offsets[b]])
                first, last, summed = int(number[a]), int(number[b - 1]), [t[i] for t in totals]
                if held and names == held[0] and first == held[2] + 1 and first % fan and not held[5] and not single[a]:
                    held[2] = last
                    held[3].append(text)
                    held[4] = [x + y for x, y in zip(held[4], summed)]
                else:
                    if held:
                        parts.append(held)
                    held = [names, first, last, [text] if digest[a].is_valid else [None], summed, bool(single[a])]
            if parts:
                yield table(parts)
        if held:
            yield table([held])

    kept = [rows.schema[name] for name in same]
    plain = ["_number bigint", "_last bigint", "_digest binary", "_whole boolean", *[f"`{name}` bigint" for name in sums]]
    schema = T.StructType([*kept, *T.StructType.fromDDL(", ".join(plain)).fields])
    return rows.mapInArrow(run, schema)


def roots(tree: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The top node of each group, without its place in the tree."""
    top = F.max_by(F.struct(*[c for c in tree.columns if c not in (*keys, "level", "node")]), "level").alias("_top")
    return tree.where(F.col("node") == 0).groupBy(*keys).agg(top).select(*keys, "_top.*")


def damaged(recorded: DataFrame, found: DataFrame, keys: Sequence[str], fan: int = FAN) -> DataFrame:
    """``keys, first, last`` of the lowest nodes that differ or that one tree lacks, found from the top down."""
    depth = recorded.unionByName(found, allowMissingColumns=True).agg(F.max("level").alias("n")).first()["n"]
    suspects = None
    for level in range(depth or 0, -1, -1):
        sides = []
        for name, tree in (("one", recorded), ("other", found)):
            side = tree.where(F.col("level") == level).select(*keys, "node", F.struct("digest", "first", "last").alias(name))
            if suspects is not None:
                parent = F.expr(f"node div {fan}")
                side = side.withColumn("parent", parent).join(suspects, [*keys, "parent"], "left_semi").drop("parent")
            sides.append(side)
        both = sides[0].join(sides[1], [*keys, "node"], "full")
        unlike = both.where(~F.col("one.digest").eqNullSafe(F.col("other.digest")))
        # groups whose trees are lower begin further down, at their only node
        lower = reduce(
            DataFrame.unionByName,
            [tree.groupBy(*keys).agg(F.max("level").alias("top")).where(F.col("top") < level) for tree in (recorded, found)],
        ).select(*keys, F.lit(0).cast("bigint").alias("parent"))
        suspects = unlike.select(*keys, F.col("node").alias("parent")).unionByName(lower)
    return unlike.select(
        *keys,
        F.coalesce("one.first", "other.first").alias("first"),
        F.coalesce("one.last", "other.last").alias("last"),
    )


def ordered_tree_digest(df: DataFrame, text: Column, order: Sequence[Column], scratch: Scratch, fan: int = FAN) -> DataFrame:
    """One row with ``digest``: the root over all rows in order, of any number. ``text`` is a row's canonical
    text; rows that the order leaves equal follow the digest of theirs. An empty table has the digest of the empty text."""
    hashed = df.withColumn("_text", F.unhex(F.sha2(text, 256)))
    numbered = number_in_order(hashed, [*order, F.col("_text")], scratch, "_row")
    rows = numbered.select(F.lit(0).alias("_all"), (F.col("_row") - 1).alias("_row"), "_text")
    top = roots(grow(rows, ["_all"], "_row", F.col("_text"), scratch.keep, fan=fan), ["_all"])
    found = top.agg(F.max(F.lower(F.hex("digest"))).alias("digest"))
    return found.select(F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("digest"))
