"""Near-duplicate vectors by sorted projection passes.

A pass orders all distinct vectors by 32 signs of random projections, read as one
number, and compares every vector with its next neighbours in that order.  The more
leading signs two vectors share the closer they lie; vectors at the threshold share
one with a chance of 0.9, so the number of passes follows from the number of vectors,
the window and the share of pairs that may be missed.  A pair that a partition
boundary cuts in one pass is met in others.  Verified links of all passes are united.

That holds for vectors that spread evenly.  So every pass also measures the number of
leading signs beyond which a vector was compared with all that share them, and with it
the chance that a link at the threshold was missed.  Vectors for which the chance is too
high, those of dense directions, go through further passes among themselves with wider
windows; once they are few enough, or no longer become fewer, they are compared with
each other block by block, but for blocks of one component.

A window holds few of the links of a dense group.  So links are counted afterwards,
exactly, within every component: vectors closer to its middle than half the
threshold's angle all link with each other and are counted, the others are
compared with all of the component, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.components import connected_components
from lethe.operators.sizing import durable, measured

_UNITS = "vec_id long, unit binary"


@dataclass(frozen=True)
class PassParameters:
    cosine: float = 0.95
    window: int = 64
    missed: float = 1e-4  # share of pairs at the threshold that no pass may find
    block: int = 1024  # vectors of a component compared at once
    direct: int = 32_768  # vectors of dense directions that are compared without passes
    direct_block: int = 4096
    wide: int = 512  # window of the first further passes
    widest: int = 8192
    further: int = 24  # passes until the rest is measured anew

    @property
    def same(self) -> float:
        """Chance that two vectors at the threshold share a sign."""
        return 1 - math.acos(self.cosine) / math.pi

    def shared(self, vectors: int) -> int:
        """Leading signs that leave a window of evenly spread vectors, with one to spare."""
        return max(0, math.ceil(math.log2(max(vectors, 1) / self.window))) + 1

    def passes(self, vectors: int) -> int:
        met = min(self.same ** self.shared(vectors), 0.9)
        return max(12, math.ceil(math.log(self.missed) / math.log(1 - met)))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = []
        for values in batch.column(1).to_pylist():
            x = np.array(values, dtype=np.float64) if values and None not in values else np.zeros(0)
            largest = np.abs(x).max() if len(x) else 0.0
            if not np.isfinite(largest) or largest == 0:
                units.append(None)
                continue
            x = x / largest
            units.append((x / math.sqrt(float(x @ x)) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(units, pa.binary())], ["vec_id", "unit"]
        )


@lru_cache(maxsize=4)
def _planes(size: int, passes: int, again: int) -> np.ndarray:
    return np.random.default_rng([size, again]).standard_normal((size, passes * 32))


def _keyed(batches: Iterator[pa.RecordBatch], passes: int, again: int) -> Iterator[pa.RecordBatch]:
    weights = (1 << np.arange(31, -1, -1)).astype(np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            keys = np.zeros((some.num_rows, passes), dtype=np.int64)
            units = [np.frombuffer(u, np.float64) for u in some.column(1).to_pylist()]
            for size in {len(u) for u in units}:
                rows = [i for i, u in enumerate(units) if len(u) == size]
                signs = np.stack([units[i] for i in rows]) @ _planes(size, passes, again) > 0
                keys[rows] = signs.reshape(len(rows), passes, 32) @ weights
            offsets = pa.array(np.arange(0, keys.size + 1, passes, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                ["rep", "unit", "keys"],
            )


def _open_prefixes(turns: np.ndarray, keys: np.ndarray, window: int) -> np.ndarray:
    """Fewest leading signs that no vector outside a row's window shares with it.

    Rows beyond the sorted partition are unknown, so its first and last row stand for them.
    """
    at = np.arange(len(keys))
    most = np.full(len(keys), -1)
    for other in (np.maximum(at - window - 1, 0), np.minimum(at + window + 1, len(keys) - 1)):
        common = 32 - np.frexp((keys ^ keys[other]).astype(np.float64))[1]
        most = np.maximum(most, np.where(turns == turns[other], common, -1))
    return most + 1


def _window_links(batches: Iterator[pa.RecordBatch], p: PassParameters, window: int,
                  planned: int) -> Iterator[pa.RecordBatch]:
    """Stars of what links connect among neighbours of a sorted partition, and (a, null,
    signs) of every row that needs more leading signs than planned."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def stars() -> pa.RecordBatch:
        ends = [(x, top) for x in parent if (top := root(x)) != x]
        a, b = zip(*ends, strict=True) if ends else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int32())], ["a", "b", "signs"]
        )

    step = min(4 * window, 1024)
    seen: list[tuple[np.ndarray, ...]] = []
    held: pa.Table | None = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        rows = fresh if held is None else pa.concat_tables([held, fresh])
        turns = rows.column("turn").to_numpy()
        reps = rows.column("rep").to_numpy()
        units = [np.frombuffer(u, np.float64) for u in rows.column("unit").to_pylist()]
        sizes = np.array([len(u) for u in units])
        old = 0 if held is None else held.num_rows
        seen.append((turns[old:], rows.column("key").to_numpy()[old:], reps[old:]))
        x = np.zeros((len(units), sizes.max(initial=0)))
        for i, u in enumerate(units):
            x[i, : len(u)] = u
        for at in range(0, len(x), step):
            end = min(at + step + window, len(x))
            i, j = np.nonzero(x[at : at + step] @ x[at:end].T >= p.cosine)
            i, j = i + at, j + at
            near = (j > i) & (j - i <= window) & (j >= old) & (turns[i] == turns[j]) & (sizes[i] == sizes[j])
            for a, b in zip(reps[i[near]].tolist(), reps[j[near]].tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        held = rows.slice(max(0, rows.num_rows - window))
        if len(parent) > 500_000:
            yield stars()
            parent.clear()
    yield stars()
    if seen:
        turns, keys, reps = map(np.concatenate, zip(*seen, strict=True))
        signs = _open_prefixes(turns, keys, window)
        dense = signs > planned
        yield pa.RecordBatch.from_arrays(
            [pa.array(reps[dense], pa.int64()), pa.nulls(int(dense.sum()), pa.int64()), pa.array(signs[dense], pa.int32())],
            ["a", "b", "signs"],
        )


def _passed(units: DataFrame, p: PassParameters, passes: int, window: int, planned: int,
            again: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) among ``units`` (rep, unit) that passes find, and (a, chance): the log of
    the chance that none of them met a link at the threshold, where that is not as planned."""
    keyed = durable(
        units.mapInArrow(
            partial(_keyed, passes=passes, again=again), "rep long, unit binary, keys array<long>"
        )
    )
    turns = keyed.select("rep", "unit", F.posexplode("keys").alias("turn", "key"))
    n = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartitionByRange(n, "turn", "key", "rep").sortWithinPartitions(
        "turn", "key", "rep"
    )
    found = durable(
        ordered.mapInArrow(
            partial(_window_links, p=p, window=window, planned=planned), "a long, b long, signs int"
        )
    )
    met = F.when(F.col("signs") > 32, 0.0).otherwise(F.least(F.pow(F.lit(p.same), "signs"), F.lit(0.9)))
    others = math.log(1 - min(p.same**planned, 0.9))
    chances = (
        found.where("b is null")
        .groupBy("a")
        .agg((F.sum(F.log1p(-met)) + (passes - F.count(F.lit(1))) * F.lit(others)).alias("chance"))
    )
    return found.where("b is not null").select("a", "b"), chances


def _dense_links(units: DataFrame, links: DataFrame, chances: DataFrame, p: PassParameters) -> DataFrame:
    """``links`` and those of vectors whose links the passes may have missed."""
    target = math.log(p.missed)

    def still_open(frame: DataFrame, chances: DataFrame):
        joined = frame.join(chances, F.col("rep") == F.col("a"))
        return measured(
            joined.select("rep", "unit", (F.col("before") + F.col("chance")).alias("before")).where(
                F.col("before") > target
            )
        )

    rest = still_open(units.withColumn("before", F.lit(0.0)), chances)
    again, window, fewer = 0, p.wide, True
    while rest.rows > p.direct and (fewer or window <= p.widest):
        again += 1
        more, chances = _passed(rest.frame.select("rep", "unit"), p, p.further, window, -1, again)
        links = links.unionByName(more)
        was, rest = rest.rows, still_open(rest.frame, chances)
        fewer = rest.rows <= 0.9 * was
        window *= 1 if fewer else 2
    if not rest.rows:
        return links
    return links.unionByName(_direct_links(rest.frame, connected_components(links), rest.rows, p))


def _direct_links(rest: DataFrame, component: DataFrame, rows: int, p: PassParameters) -> DataFrame:
    """Stars of all links between vectors of different components."""
    own = durable(
        rest.join(component, F.col("rep") == F.col("node"), "left").select(
            "rep", "unit", F.coalesce("component", "rep").alias("component")
        )
    )
    large = (
        own.groupBy("component")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > p.direct_block)
        .select(F.col("component").alias("of"), "n")
    )
    # large components have blocks of their own, the others share some
    numbered = own.join(large, F.col("component") == F.col("of"), "left").select(
        "rep", "unit", "component", "of",
        F.pmod(F.xxhash64("rep"), F.ceil(F.coalesce("n", F.lit(rows)) / p.direct_block)).alias("part"),
    )
    blocks = durable(
        numbered.groupBy("of", "part")
        .agg(F.collect_list(F.struct("rep", "component", "unit")).alias("rows"))
        .withColumn("block", F.concat_ws(".", F.coalesce("of", F.lit(-1)).cast("string"), "part"))
    )
    names = blocks.select("block", "of")
    pairs = (
        names.alias("x")
        .join(F.broadcast(names.alias("y")), F.expr("x.block <= y.block and (x.of is null or y.of is null or x.of <> y.of)"))
        .select(F.col("x.block").alias("left"), F.col("y.block").alias("right"))
    )
    sides = (
        pairs.join(blocks.select("block", F.col("rows").alias("one")), F.col("left") == F.col("block"))
        .drop("block")
        .join(blocks.select("block", F.col("rows").alias("two")), F.col("right") == F.col("block"))
    )
    return durable(sides.select("one", "two").mapInArrow(partial(_linked, p=p), "a long, b long"))


def _linked(batches: Iterator[pa.RecordBatch], p: PassParameters) -> Iterator[pa.RecordBatch]:
    """One link for every vector and component of the other block that it links with."""

    def side(rows: pa.ListArray, i: int):
        flat = rows[i].values
        units = [np.frombuffer(u, np.float64) for u in flat.field("unit").to_pylist()]
        return units, flat.field("rep").to_numpy(), flat.field("component").to_numpy()

    for batch in batches:
        for k in range(batch.num_rows):
            (ones, rep, part), (twos, of, other) = (side(batch.column(c), k) for c in (0, 1))
            sizes, widths = (np.array([len(u) for u in units]) for units in (ones, twos))
            for size in set(sizes.tolist()) & set(widths.tolist()):
                left, right = np.nonzero(sizes == size)[0], np.nonzero(widths == size)[0]
                y = np.stack([twos[j] for j in right])
                for at in range(0, len(left), 512):
                    some = left[at : at + 512]
                    near = np.stack([ones[i] for i in some]) @ y.T >= p.cosine
                    near &= part[some][:, None] != other[right][None, :]
                    i, j = np.nonzero(near)
                    ends = np.stack((rep[some][i], other[right][j]), axis=1)
                    first = np.unique(ends, axis=0, return_index=True)[1] if len(ends) else np.zeros(0, int)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[some][i][first], pa.int64()), pa.array(of[right][j][first], pa.int64())], ["a", "b"]
                    )


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 parameters: PassParameters = PassParameters()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Vectors link if their cosine is 0.95 or more.  Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of different
    lengths with each other.  Every row is a vector of its own, so exact copies link;
    ``n_links`` counts the other rows linked directly with one of the same component.
    ``component_id`` is the smallest id reachable by links.  Rows without id link with
    nothing and are kept, with a null component.  An empty table gives no rows; other
    columns are not read, whatever their names.  Known fault: different vectors under one
    id count as one node, so each gets the links of both.
    """
    p = parameters
    columns = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    units = durable(
        columns.mapInArrow(_units, _UNITS).withColumn("mark", F.sha2(F.col("unit"), 256))
    )
    usable = units.where("unit is not null and vec_id is not null")
    classes = usable.groupBy("mark").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    distinct = measured(
        usable.join(classes.select(F.col("mark").alias("m"), "rep", "copies"),
                    (F.col("mark") == F.col("m")) & (F.col("vec_id") == F.col("rep")))
        .select("rep", "copies", "unit", "mark")
        .dropDuplicates(["mark"])
    )
    some = distinct.frame.select("rep", "unit")
    links, chances = _passed(
        some, p, p.passes(distinct.rows), p.window, p.shared(distinct.rows), 0
    )
    links = _dense_links(some, links, chances, p)
    component = durable(connected_components(links))
    counts = _counted(distinct.frame, component, p)
    with_class = units.join(classes, "mark", "left").where("unit is not null and vec_id is not null")
    alone = units.where("unit is null or vec_id is null").select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    found = (
        with_class.select("vec_id", "rep", "copies")
        .join(component, F.col("rep") == F.col("node"), "left")
        .drop("node")
        .join(counts, "rep", "left")
    )
    own = F.coalesce("component", "rep")
    return found.select(
        "vec_id",
        (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"),
        own.alias("component_id"),
        (F.col("vec_id") == own).alias("kept"),
    ).unionByName(alone)


def _counted(distinct: DataFrame, component: DataFrame, p: PassParameters) -> DataFrame:
    """(rep, more): rows of other classes of its component that a class links with."""
    members = distinct.join(component, F.col("rep") == F.col("node")).select(
        "component", "rep", "copies", "unit"
    )
    members = durable(
        members.mapInArrow(
            _spelled, "component long, rep long, copies long, unit binary, size int, vector array<double>"
        )
    )
    middle = (
        members.select("component", "size", F.posexplode("vector").alias("at", "x"))
        .groupBy("component", "size", "at")
        .agg(F.sum("x").alias("x"))
        .groupBy(F.col("component").alias("of"), F.col("size").alias("of_size"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("middle"))
    )
    half = math.sqrt((1 + p.cosine) / 2) + 1e-9
    dot = F.aggregate(F.zip_with("vector", "middle.x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    length = F.sqrt(F.aggregate("middle.x", F.lit(0.0), lambda s, v: s + v * v))
    placed = durable(
        members.join(middle, (F.col("component") == F.col("of")) & (F.col("size") == F.col("of_size")))
        .select("component", "rep", "copies", "unit", (dot >= half * length).alias("core"))
    )
    sums = placed.groupBy(F.col("component").alias("of")).agg(
        F.count(F.lit(1)).alias("members"),
        F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies"),
        F.count_if(~F.col("core")).alias("outside"),
    )
    summed = placed.join(sums, F.col("component") == F.col("of"))
    core = summed.where("core").select("rep", (F.col("core_copies") - F.col("copies")).alias("more"))
    chunks = F.ceil(F.col("members") / p.block).cast("long")
    chunk = F.pmod(F.xxhash64("rep"), chunks)
    blocks = durable(
        summed.where("outside > 0")
        .withColumn("chunk", chunk)
        .groupBy("component", "chunk")
        .agg(F.collect_list(F.struct("rep", "copies", "core", "unit")).alias("rows"))
    )
    outside = blocks.select(
        F.col("component").alias("of"), F.filter("rows", lambda r: ~r["core"]).alias("outer_rows")
    ).where(F.size("outer_rows") > 0)
    compared = outside.join(blocks, F.col("of") == F.col("component")).select("outer_rows", "rows")
    rest = compared.mapInArrow(partial(_compared, p=p), "rep long, more long")
    return core.unionByName(rest).groupBy("rep").agg(F.sum("more").alias("more"))


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = [np.frombuffer(u, np.float64) for u in batch.column("unit").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([len(u) for u in units], pa.int32()),
             pa.array([u.tolist() for u in units], pa.list_(pa.float64()))],
            ["component", "rep", "copies", "unit", "size", "vector"],
        )


def _compared(batches: Iterator[pa.RecordBatch], p: PassParameters) -> Iterator[pa.RecordBatch]:
    def side(rows):
        x = np.stack([np.frombuffer(r["unit"], np.float64) for r in rows])
        return x, *(np.array([r[c] for r in rows]) for c in ("rep", "copies", "core"))

    for batch in batches:
        for i in range(batch.num_rows):
            outer, rep, copies, _ = side(batch.column(0)[i].as_py())
            inner, of, times, core = side(batch.column(1)[i].as_py())
            near = (outer @ inner.T >= p.cosine) & (rep[:, None] != of[None, :])
            ids = np.concatenate((rep, of[core]))
            more = np.concatenate((near @ times, copies @ near[:, core]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(more.astype(np.int64))], ["rep", "more"]
            )
