"""Near-duplicate embeddings by an exact metric range join.

Method: unit vectors under the angle between them are a metric space. Pivots, vectors of the
table, cut it into cells: a vector lives in the cell of its nearest pivot. Within the reach of
a link, two bounds of the triangle inequality tell which other cells a vector can have links
in: its angle to their pivot is at most the cell's radius plus the reach, and at most its angle
to its own pivot plus twice the reach. It is replicated to those, to the lower one of two cells
alone, and cells join independently. Vectors within half the reach of a pivot are its core: all
of them are linked with each other, so a core is counted and not compared. Large cells are cut
into blocks that meet block by block; inside, vectors sorted by their angle to the pivot only
meet those whose angle differs by at most the reach.

Equal vectors are one class. A task returns, per vector, the number of links it found and one
chain of links per group, never the links themselves.

The bounds prune where vectors cluster; between independent random directions in many
dimensions all angles are alike and every cell meets most others, in any exact method.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.llm.common import stored
from municare.llm.components import components

COSINE = 0.95
CELL_ROWS = 4096  # vectors per cell that the number of pivots aims at
MOST_PIVOTS = 1024  # bound of the broadcast; larger cells are cut into blocks
BLOCK, GUEST_BLOCK = 8192, 32768
_CHUNK = 512
_FINISHED = 50_000  # pairs of a chunk that are finished one by one
_SLACK = 1e-6  # radians that bounds are widened by, against rounding


def _unit(values) -> np.ndarray | None:
    """The vector scaled to length one, or None for what links with nothing."""
    if values is None or any(v is None for v in values):
        return None
    v = np.asarray(values, float)
    top = np.abs(v).max(initial=0.0)
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def _units(column: pa.Array) -> list[np.ndarray | None]:
    """The scaled vectors of a list column: whole batches at once where all have the same length."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = rows.flatten()
    width = len(values) // len(rows) if len(rows) else 0
    lengths = rows.value_lengths()
    if not width or rows.null_count or values.null_count or pc.min_max(lengths).as_py() != {"min": width, "max": width}:
        return [_unit(v) for v in rows.to_pylist()]
    v = values.to_numpy(zero_copy_only=False).reshape(len(rows), width)
    top = np.abs(v).max(axis=1)
    fine = np.isfinite(top) & (top > 0)
    v = v[fine] / top[fine, None]
    units = iter(v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None])
    return [next(units) if ok else None for ok in fine]


def _pairs(x: np.ndarray, y: np.ndarray, x32: np.ndarray, y32: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y with at least this cosine in double precision. Products in single precision, wrong
    by less than ``margin``, tell which pairs can be; few such pairs are finished one by one, many as a whole."""
    margin = np.float32(1e-6 + 2.4e-7 * x.shape[1])
    i, j = np.nonzero(x32 @ y32.T >= np.float32(cosine) - margin)
    if len(i) > _FINISHED:
        return np.nonzero(x @ y.T >= cosine)
    close = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
    return i[close], j[close]


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    """One row per vector; shorter ones are filled up with zeros."""
    if all(len(r) == 8 * width for r in rows):
        return np.frombuffer(b"".join(rows)).reshape(len(rows), width)
    return np.stack([np.pad(np.frombuffer(r), (0, width - len(r) // 8)) for r in rows])


def _classes(vectors: DataFrame, id: str, column: str) -> tuple[DataFrame, DataFrame]:
    """All ids with the class key of their vector (null: links with nothing), and the classes."""
    kind = vectors.select(F.col(f"`{id}`").alias("__id")).schema[0].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column(1))
            # Trailing zeros and the sign of zero make no other direction.
            raw = [None if u is None else (np.trim_zeros(u, "b") + 0.0).tobytes() for u in units]
            keys = [None if r is None else xxhash.xxh3_128_digest(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["__id", "key", "unit"]
            )

    rows = vectors.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    rows = stored(rows.mapInArrow(keyed, f"__id {kind}, key binary, unit binary"), "vectors")
    classes = rows.filter("key is not null and __id is not null").groupBy("key", "unit")
    classes = classes.agg(F.min("__id").alias("id"), F.count(F.lit(1)).alias("copies"))
    # A class is a node by a number of its own, as an id may repeat with other vectors.
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    return rows.select("__id", "key"), stored(classes, "classes")


def near_duplicates(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors``: id, n_links, component_id, kept.

    Links are pairs of rows whose cosine in double precision is at least ``cosine``. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, as do
    rows without an id (component null, kept). A shorter vector is compared as if filled up
    with zeros. Rows that repeat an id and a vector are linked copies; rows that repeat an id with
    other vectors are vectors of their own, and a component has the name of its smallest id, whose rows
    are kept. Other columns are not read.
    """
    reach = math.acos(cosine)
    rows, classes = _classes(vectors, id, column)
    context = vectors.sparkSession.sparkContext
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("unit")).alias("bytes")).first()
    width = (size["bytes"] or 0) // 8
    wanted = min(MOST_PIVOTS, max(1, math.ceil(size["n"] / CELL_ROWS)))
    picked = classes.orderBy(F.xxhash64("key"), "key").limit(wanted).select("unit").collect()
    if not picked:
        return _unlinked(rows, id)
    pivots = context.broadcast(_matrix([bytes(r["unit"]) for r in picked], width))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell 2j holds the core of pivot j, cell 2j + 1 the rest of its vectors."""
        for batch in batches:
            angle = _angles(_matrix(batch.column("unit").to_pylist(), width), pivots.value)
            own = angle.argmin(1)
            angle = angle[np.arange(len(own)), own]
            cell = 2 * own + (angle > reach / 2 - _SLACK)
            columns = [*batch.columns, pa.array(cell, pa.int64()), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "angle"])

    base = "node bigint, copies bigint, unit binary, cell bigint, angle double"
    homes = stored(classes.select("node", "copies", "unit").mapInArrow(placed, base), "homes")
    cells = homes.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("angle").alias("radius"),
        F.sum("copies").alias("all_copies"),
        F.min("node").alias("low"),
    )
    cells = stored(cells, "cells")
    radius = np.full(2 * len(picked), -np.inf)  # cells without members are reached by nothing
    for c in cells.select("cell", "radius").collect():  # two rows per pivot at most
        radius[c["cell"]] = c["radius"]
    bound = context.broadcast(radius)

    def visits(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and angle to that cell's pivot of all visits that the vectors have to make."""
        cell = batch.column("cell").to_numpy()
        angle = _angles(_matrix(batch.column("unit").to_pylist(), width), pivots.value)
        target = np.repeat(angle, 2, axis=1)
        fits = target <= bound.value[None, :] + reach + _SLACK
        fits &= target <= batch.column("angle").to_numpy()[:, None] + 2 * reach + _SLACK
        place = np.arange(target.shape[1])[None, :]
        # A pair of cells meets in the lower one; a rest also meets itself, a core need not.
        fits = (fits & (place < cell[:, None])) | ((place == cell[:, None]) & (place % 2 == 1))
        row, to = np.nonzero(fits)
        return row, to, target[row, to]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, n = np.unique(visits(batch)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], names=["cell", "visits"])

    def travelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, to, angle = visits(batch)
            for at in range(0, len(row), 20_000):
                part = slice(at, at + 20_000)
                taken = batch.take(pa.array(row[part]))
                own = pa.array(taken.column("cell").to_numpy() == to[part])
                columns = [taken.column("node"), taken.column("copies"), taken.column("unit")]
                columns += [pa.array(to[part], pa.int64()), pa.array(angle[part]), own]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "copies", "unit", "cell", "angle", "own"])

    plan = homes.mapInArrow(counted, "cell bigint, visits bigint").groupBy("cell").agg(F.sum("visits").alias("visits"))
    plan = plan.join(cells.select("cell", "n"), "cell").select(
        F.col("cell").alias("__cell"),
        F.ceil(F.col("n") / BLOCK).alias("home_blocks"),
        F.ceil(F.col("visits") / GUEST_BLOCK).alias("guest_blocks"),
    )
    plan = F.broadcast(stored(plan, "blocks"))  # two rows per pivot at most
    dealt = lambda seed, blocks: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    guests = homes.mapInArrow(travelled, f"{base}, own boolean").join(plan, F.col("cell") == F.col("__cell"))
    guests = guests.withColumn("guest", dealt(1, "guest_blocks")).withColumn("home", every("home_blocks"))
    members = homes.join(plan, F.col("cell") == F.col("__cell")).withColumn("own", F.lit(None).cast("boolean"))
    members = members.withColumn("home", dealt(2, "home_blocks")).withColumn("guest", every("guest_blocks"))
    columns = ["cell", "home", "guest", "own", "node", "copies", "unit", "angle"]
    meetings = members.select(*columns).union(guests.select(*columns))

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["angle", "node"])
        is_member = group["own"].isna().to_numpy()
        guest, member = group[~is_member], group[is_member]
        own = guest["own"].to_numpy(bool)
        nodes = np.concatenate([guest["node"].to_numpy(), member["node"].to_numpy()])
        copies = np.concatenate([guest["copies"].to_numpy(), member["copies"].to_numpy()])
        x, y = _matrix(list(guest["unit"]), width), _matrix(list(member["unit"]), width)
        x32, y32 = x.astype(np.float32), y.astype(np.float32)
        gx, gy = guest["angle"].to_numpy(), member["angle"].to_numpy()
        links = np.zeros(len(nodes), np.int64)
        label = np.arange(len(nodes))
        for at in range(0, len(x), _CHUNK):
            end = min(at + _CHUNK, len(x))
            low = np.searchsorted(gy, gx[at] - reach - _SLACK)
            high = np.searchsorted(gy, gx[end - 1] + reach + _SLACK, "right")
            i, j = _pairs(x[at:end], y[low:high], x32[at:end], y32[low:high], cosine)
            i, j = i + at, j + low + len(x)
            once = ~own[i] | (nodes[i] > nodes[j])  # guests of their own cell meet from both sides
            i, j = i[once], j[once]
            if not len(i):
                continue
            links += np.bincount(i, copies[j], len(nodes)).astype(np.int64)
            links += np.bincount(j, copies[i], len(nodes)).astype(np.int64)
            for partners in np.split(np.stack([i, j]), np.flatnonzero(np.diff(i)) + 1, axis=1):
                met = label[np.append(partners[1], partners[0, 0])]
                if (met != met[0]).any():
                    met = np.unique(met)
                    label[np.isin(label, met)] = met[0]
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"node": nodes[some], "links": links[some], "other": nodes[label[some]]})

    found = meetings.groupBy("cell", "home", "guest").applyInPandas(joined, "node bigint, links bigint, other bigint")
    found = stored(found, "found")
    core = homes.filter("cell % 2 = 0").select("node", "cell").join(F.broadcast(cells.select("cell", "all_copies", "low")), "cell")
    chains = found.select(F.col("node").alias("a"), F.col("other").alias("b"))
    chains = chains.union(core.select(F.col("node").alias("a"), F.col("low").alias("b")))
    groups = components(chains.distinct())
    # Copies of the own vector, or all of the own core, without the vector itself.
    near = classes.select("node", (F.col("copies") - 1).alias("links"))
    near = near.join(core.select("node"), "node", "left_anti").union(core.select("node", F.col("all_copies") - 1))
    total = near.union(found.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    facts = classes.select("key", "node", "id").join(total, "node").join(groups, "node", "left")
    facts = stored(facts.withColumn("component", F.coalesce("component", "node")), "facts")
    least = facts.groupBy(F.col("component").alias("__component")).agg(F.min(F.struct("id", "key")).alias("least"))
    facts = facts.join(stored(least, "least"), F.col("component") == F.col("__component"))
    facts = facts.select(
        F.col("key").alias("__class"), "links", F.col("least.id").alias("component")
    )
    facts = stored(facts, "facts")
    linked = rows.join(facts, (F.col("key") == F.col("__class")) & F.col("__id").isNotNull(), "left")
    return _named(linked, id)


def _named(rows: DataFrame, id: str) -> DataFrame:
    component = F.coalesce("component", "__id")
    return rows.select(
        F.col("__id").alias(id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("__id").eqNullSafe(component).alias("kept"),
    )


def _unlinked(rows: DataFrame, id: str) -> DataFrame:
    none = F.lit(None).cast("long")
    return _named(rows.withColumn("links", none).withColumn("component", F.col("__id")), id)
