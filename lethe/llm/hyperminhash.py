"""Near-duplicate documents by HyperMinHash registers.

One hash per shingle chooses a bucket by its leading bits; the bucket keeps the
smallest remainder, compressed to its number of leading zeros and a few mantissa
bits behind the leading one.  Hashes of groups of registers are band keys.  A group is
four neighbours; for sets too small to fill the buckets it is a drawn share of all
buckets, so large that it still holds several shingles and so small that the few
shingles in which near duplicates of that size differ often miss it.  A document
has the bands of its class of sizes and of the next one.  Documents that share a key are compared by the collision-corrected estimate of their Jaccard
similarity and, where that does not rule the pair out, by their full sets.

Pairs within a band bucket are not spelled out: documents are contracted to
components.  First every bucket's first member, its pivot, is compared with the members
in other components, so a bucket of near copies becomes one component.  Of a bucket that
still holds several components, the members outside the largest one are compared with
each other and with the largest one, in blocks of bounded size: a task counts what all
of two blocks have in common at once and hands on only which components it joins.  So no
link between different texts is lost to a cap, no pair becomes a row, and members that
are one component already are not compared.

Members of a large bucket that link with nothing would meet all others there.  Most of
them hold many shingles that no other member of an unfinished bucket has.  These are
counted once, after the pivots; without them a set cannot have enough in common with
any other, which rules most such members out exactly.  What is left, sets just below the
threshold to many others, is work that grows with the square of such a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.components import connected_components
from lethe.llm.tables import written, written_values
from lethe.llm.words import mix, shingle_sets
from lethe.operators.sizing import durable, keyed_join, measured

SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"
PAYLOAD = "doc_id long, n_shingles long, registers binary, shingles binary"


@dataclass(frozen=True)
class NearParameters:
    """Bands miss a pair of similarity 0.75 about once in 30,000 to 200,000."""

    percent: int = 75  # 100 * intersection >= percent * union
    bucket_bits: int = 7
    zero_bits: int = 6
    mantissa_bits: int = 26
    band_rows: int = 4
    small_bands: int = 64  # per class of small sets
    small_match: float = 0.15  # chance of a small band at the threshold
    dense_from: int = 96  # sets from about this size have bands of neighbours
    first_share: int = 16  # one bucket in so many is worked on before all others
    sigmas: float = 5.0  # the estimate rules a pair out this far below the threshold
    block: int = 1 << 18  # shingles, with some for each document, of a block of a bucket
    each: int = 128  # what a document adds to those

    @property
    def buckets(self) -> int:
        return 1 << self.bucket_bits

    @property
    def smallest(self) -> int:
        """Sets below this size equal every set they are similar enough to."""
        return -(-self.percent // (100 - self.percent)) if self.percent < 100 else 1 << 62


@lru_cache(maxsize=4)
def _classes(p: NearParameters) -> tuple[tuple[float, float, np.ndarray, np.uint64], ...]:
    """(least size, end of sizes, weights of the registers in each band, seed) by class.

    Similar enough sets are in the same class or in neighbouring ones.
    """
    ratio = 100 / p.percent
    out, low = [], float(p.smallest)
    odd = mix(np.arange(1, p.buckets + 1, dtype=np.uint64)) | np.uint64(1)
    while low < p.dense_from and ratio > 1:
        high = low * ratio
        # of two sets of at most n shingles each, so many at most are in one of them only
        differ = max(1, int(2 * (np.ceil(high) - 1) * (100 - p.percent) / (100 + p.percent)))
        chosen = max(1, round(p.buckets * (1 - p.small_match ** (1 / differ))))
        weights = np.zeros((p.buckets, p.small_bands), dtype=np.uint64)
        for band in range(p.small_bands):
            seed = np.uint64((len(out) << 20) + (band << 8))
            drawn = np.argsort(mix(np.arange(1, p.buckets + 1, dtype=np.uint64) + seed))[:chosen]
            weights[drawn, band] = odd[drawn]
        out.append((low, high, weights, np.uint64(len(out) + 1)))
        low = high
    bands = p.buckets // p.band_rows
    weights = np.zeros((p.buckets, bands), dtype=np.uint64)
    weights[np.arange(p.buckets), np.arange(p.buckets) // p.band_rows] = odd
    return (*out, (low, np.inf, weights, np.uint64(0)))


def registers(shingles: np.ndarray, p: NearParameters) -> np.ndarray:
    """Compressed minima per bucket of sorted distinct hashes; 0 is an empty bucket."""
    out = np.zeros(p.buckets, dtype=np.uint32)
    if not len(shingles):
        return out
    bucket = (shingles >> np.uint64(64 - p.bucket_bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    rest = (shingles[first] << np.uint64(p.bucket_bits)) >> np.uint64(11)  # 53 bits are exact
    length = np.frexp(rest.astype(np.float64))[1]  # bits from the leading one on
    zeros = np.minimum(53 - length, (1 << p.zero_bits) - 2)
    behind = (rest << (zeros + 1).astype(np.uint64)) & np.uint64((1 << 53) - 1)
    mantissa = behind >> np.uint64(53 - p.mantissa_bits)
    out[bucket[first]] = ((zeros + 1).astype(np.uint64) << np.uint64(p.mantissa_bits)) | mantissa
    return out


def band_keys(sketches: np.ndarray, sizes: np.ndarray, p: NearParameters) -> list[np.ndarray]:
    """The keys of every document's bands that have a register that is not empty."""
    keys = [np.zeros(0, dtype=np.uint64)] * len(sizes)
    filled = sketches > 0
    place = np.arange(p.buckets, dtype=np.uint64) << np.uint64(32)
    spread = np.where(filled, mix(sketches.astype(np.uint64) + place), np.uint64(0))
    for low, high, weights, seed in _classes(p):
        rows = np.flatnonzero((sizes >= low * p.percent / 100) & (sizes < high))
        rows = rows[sizes[rows] >= p.smallest]
        number = mix(np.arange(1, weights.shape[1] + 1, dtype=np.uint64) + (seed << np.uint64(32)))
        used = (weights > 0).astype(np.float32)
        for at in range(0, len(rows), 1000):
            some = rows[at : at + 1000]
            own = mix(spread[some] @ weights + number)
            seen = filled[some].astype(np.float32) @ used > 0
            for k, row in enumerate(some):
                keys[row] = np.concatenate((keys[row], own[k][seen[k]]))
    return keys


def estimated_jaccard(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray,
                      p: NearParameters) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected estimates of pairs of sketches, and the registers they rest on.

    Two buckets agree by chance if their minima have the same number of leading
    zeros and the same mantissa; the sizes ``n`` and ``m`` say how often.
    """
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    octave = np.arange(1 << p.zero_bits)
    upper, lower = 2.0 ** -octave, 2.0 ** -(octave + 1.0)

    def share(size):
        load = np.asarray(size, dtype=float)[:, None] / p.buckets
        return np.exp(-load * lower) - np.exp(-load * upper)

    chance = (share(n) * share(m)).sum(axis=1) * 2.0**-p.mantissa_bits * used
    return np.clip((equal - chance) / np.maximum(used, 1), 0, 1), used


def _sketch(batches: Iterator[pa.RecordBatch], p: NearParameters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        sketches = np.zeros((rows, p.buckets), dtype=np.uint32)
        n, h1, h2 = (np.zeros(rows, dtype=t) for t in (np.int64, np.uint64, np.uint64))
        for row, shingles in shingle_sets(batch.column(1)):
            n[row] = len(shingles)
            h1[row] = mix(shingles + np.uint64(1)).sum(dtype=np.uint64)
            h2[row] = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
            if len(shingles) >= p.smallest:
                sketches[row] = registers(shingles, p)
        keys = band_keys(sketches, n, p)
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        bands = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64)))
        columns = [batch.column(0), *(pa.array(x.view(np.int64)) for x in (n, h1, h2)), bands]
        yield pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_shingles", "h1", "h2", "bands"]
        )


def _payload(batches: Iterator[pa.RecordBatch], p: NearParameters) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_shingles", "registers", "shingles"]
    for batch in batches:
        rows, size = [], 0
        for row, shingles in shingle_sets(batch.column(1)):
            rows.append((row, len(shingles), registers(shingles, p).tobytes(), shingles.tobytes()))
            size += shingles.nbytes
            if size > 16 << 20:
                yield _rows(batch, rows, names)
                rows, size = [], 0
        if rows:
            yield _rows(batch, rows, names)


def _rows(batch: pa.RecordBatch, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    at, n, sketches, sets = zip(*rows, strict=True)
    ids = batch.column(0).take(pa.array(at, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())],
        names,
    )


def _promising(batches: Iterator[pa.RecordBatch], p: NearParameters) -> Iterator[pa.RecordBatch]:
    """Pairs whose estimate does not rule them out."""
    share = p.percent / 100
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, p.buckets)
            for k in ("ra", "rb")
        )
        n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("na", "nb"))
        found, used = estimated_jaccard(a, b, n, m, p)
        slack = p.sigmas * np.sqrt(share * (1 - share) / np.maximum(used, 1))
        keep = pa.array(found >= share - slack)
        yield batch.select(["a", "b"]).filter(keep)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and shingle."""
    for batch in batches:
        sets = batch.column(batch.schema.get_field_index("shingles"))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        rows, hashes, size = [], [], 0
        for row, own in enumerate(sets):
            rows.append(row)
            hashes.append(np.frombuffer(own.as_buffer(), np.int64))
            size += len(hashes[-1])
            if size > 1 << 20 or row + 1 == batch.num_rows:
                owners = np.repeat(np.array(rows), [len(h) for h in hashes])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owners)), pa.array(np.concatenate(hashes))],
                    ["doc_id", "shingle"],
                )
                rows, hashes, size = [], [], 0


def _verified(batches: Iterator[pa.RecordBatch], p: NearParameters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = np.concatenate((x, y))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= p.percent * (len(both) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    parameters: NearParameters = NearParameters()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct five-word shingles; with fewer words the
    whole sequence is its one shingle.  Null and empty texts have an empty set
    and link with nothing.  Equal sets link; so do sets with 100 * intersection
    >= 75 * union.  ``component_id`` is the smallest id reachable by links and
    ``kept`` says whether it is the own one.  Every row is answered by its own
    text, so exact repetitions of a row are answered alike.  Rows without id link
    with nothing and are kept, with a null component.  An empty table gives no rows, texts
    are read whole however long, and other columns are not read, whatever their names.
    """
    p = parameters
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    sketch = durable(texts.mapInArrow(partial(_sketch, p=p), SKETCH))
    identity = ["n_shingles", "h1", "h2"]
    linkable = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy(*identity).agg(F.min("doc_id").alias("rep"))
    components = _components(texts, linkable, classes, p)

    # copies may be a large share of all rows, so their class is looked up by a join that spreads them
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.concat_ws(" ", *identity))
    reps = measured(classes.select(F.concat_ws(" ", *identity).alias("_value"), "rep"))
    narrow = sketch.select("doc_id", *identity)
    with_rep = keyed_join(narrow, key, reps, "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")
    )
    known = written_values(components.select(F.col("node").alias("_value"), "component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep"))
    return keyed_join(with_rep, F.col("rep"), known, "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _components(texts: DataFrame, linkable: DataFrame, classes: DataFrame,
                p: NearParameters) -> DataFrame:
    """(node, component) of class representatives that have links to other classes."""
    entries = linkable.select(F.explode("bands").alias("band"), "n_shingles", "h1", "h2")
    shared = (
        entries.groupBy(F.col("band").alias("_value"))
        .agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
        .where("low != high")
        .select("_value")
    )
    shared = keyed_join(entries, F.col("band"), written_values(shared), "left_semi").distinct()
    # the order in which members are pivots, from 0 to below 1
    order = F.shiftrightunsigned(F.xxhash64("rep"), 11) / F.lit(2.0**53)
    members = written(
        shared.join(classes, ["n_shingles", "h1", "h2"])
        .select("band", "rep", F.col("n_shingles").alias("n"), order.alias("u"))
        .distinct()
    )
    buckets = written(
        members.groupBy("band").agg(
            F.min(F.struct("u", "rep"))["rep"].alias("first"), F.count(F.lit(1)).alias("size")
        )
    )
    wanted = written_values(members.select(F.col("rep").alias("_value")).distinct())
    payload = durable(
        keyed_join(texts, F.col("doc_id"), wanted, "left_semi").mapInArrow(
            partial(_payload, p=p), PAYLOAD
        )
    )
    component = wanted.frame.select(
        F.col("_value").alias("node"), F.col("_value").alias("component")
    )
    several = classes.groupBy("rep").count().where("count > 1").select("rep")
    # a share of the buckets joins most near copies before the others look for pairs
    for some in (F.pmod(F.col("band"), F.lit(p.first_share)) == 0, F.lit(True)):
        active = (
            members.where(some)
            .join(component, F.col("rep") == F.col("node"))
            .drop("node")
            .join(buckets, "band")
        )
        pairs = written(_pivot_pairs(active, p))
        component = _contracted(component, _confirmed(pairs, payload, p), wanted.rows)
    rest = _linkable(members, component, buckets, payload, several, p)
    links = written(_block_pairs(rest, component, payload, p))
    return _contracted(component, links, wanted.rows)


def _unfinished(members: DataFrame, component: DataFrame) -> DataFrame:
    """(band) of the buckets whose members are in several components."""
    spread = members.join(component, F.col("rep") == F.col("node")).groupBy("band").agg(
        F.min("component").alias("x"), F.max("component").alias("y")
    )
    return spread.where("x != y").select("band")


def _linkable(members: DataFrame, component: DataFrame, buckets: DataFrame, payload: DataFrame,
              several: DataFrame, p: NearParameters) -> DataFrame:
    """Members of unfinished buckets of more than two that share enough shingles for a link.

    A shingle is shared if two of the documents here have it.  Ids of several different
    texts keep all shingles.
    """
    bands = _unfinished(members, component).join(buckets.where("size > 2").select("band"), "band")
    rest = written(members.join(bands, "band"))
    ids = written_values(rest.select(F.col("rep").alias("_value")).distinct())
    entries = keyed_join(payload, F.col("doc_id"), ids, "left_semi").mapInArrow(
        _entries, "doc_id long, shingle long"
    )
    own = (
        entries.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("_value"))
        .where("documents = 1")
        .groupBy("_value")
        .agg(F.count(F.lit(1)).alias("own"))
        .join(several, F.col("_value") == F.col("rep"), "left_anti")
    )
    known = keyed_join(rest, F.col("rep"), written_values(own), "left")
    shared = F.col("n") - F.coalesce("own", F.lit(0))
    return known.where(100 * shared >= p.percent * F.col("n")).drop("own")


def _block_pairs(rest: DataFrame, component: DataFrame, payload: DataFrame,
                 p: NearParameters) -> DataFrame:
    """(a, b) components that links within a bucket join.

    Blocks from 0 hold the members outside the largest component of a bucket, further ones
    the largest component; pairs of blocks with one of the former are compared.  A member's
    block follows from its id, so blocks come out about as large as meant.
    """
    weight = F.col("n") + F.lit(p.each)
    here = written(
        rest.join(component, F.col("rep") == F.col("node"))
        .groupBy("band", "rep", "component")
        .agg(F.sum(weight).alias("weight"), F.min("u").alias("u"))
    )
    per = here.groupBy("band", "component").agg(F.sum("weight").alias("weight"))
    largest = F.max(F.struct("weight", "component"))
    split = per.groupBy(F.col("band").alias("_value")).agg(
        largest["component"].alias("main"),
        F.ceil((F.sum("weight") - F.max("weight")) / F.lit(p.block)).cast("int").alias("outer"),
        F.ceil(F.max("weight") / F.lit(p.block)).cast("int").alias("inner"),
    )
    split = written_values(split.where("outer > 0"))
    is_main = F.col("component") == F.col("main")
    block = F.when(is_main, F.col("outer") + F.floor(F.col("u") * F.col("inner"))).otherwise(
        F.floor(F.col("u") * F.col("outer"))
    )
    last = F.when(is_main, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    placed = keyed_join(here, F.col("band"), split, "inner").select(
        "rep", "component", is_main.alias("main"), "band", block.alias("block"),
        F.explode(F.sequence(F.lit(0), last)).alias("other"),
    )
    ends = F.least("block", "other"), F.greatest("block", "other")
    tasks = placed.select("rep", "component", "main", F.xxhash64("band", *ends).alias("task"))
    sets = payload.select("doc_id", "shingles").join(tasks, F.col("doc_id") == F.col("rep"))
    dealt = sets.select("task", "component", "main", "shingles").repartition("task")
    return dealt.sortWithinPartitions("task").mapInArrow(
        partial(_joined_components, p=p), "a long, b long"
    )


def _joined_components(batches: Iterator[pa.RecordBatch], p: NearParameters) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of their task."""
    task, components, mains, sets = None, [], [], []
    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in range(4))
        for own, component, main, shingles in zip(*columns, strict=True):
            if own != task:
                if len(sets) > 1:
                    yield _joins(np.array(components), np.array(mains), sets, p)
                task, components, mains, sets = own, [], [], []
            components.append(component)
            mains.append(main)
            sets.append(np.frombuffer(shingles, np.uint64))
    if len(sets) > 1:
        yield _joins(np.array(components), np.array(mains), sets, p)


def _joins(components: np.ndarray, mains: np.ndarray, sets: list[np.ndarray], p: NearParameters) -> pa.RecordBatch:
    """Pairs of components, no more than there are components, that join all that links join."""
    outer = np.flatnonzero(~mains)
    sizes = np.array([len(s) for s in sets])
    common = common_shingles(sets, outer)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    found = []
    for at in range(0, len(outer), 256):
        some = outer[at : at + 256]
        both = common[at : at + 256].astype(np.int64)
        union = sizes[some][:, None] + sizes[None, :] - both
        link = (100 * both >= p.percent * union) & (components[some][:, None] != components[None, :])
        x, y = np.nonzero(link)
        ends = np.unique(np.stack((components[some[x]], components[y]), axis=1), axis=0)
        for a, b in ends.tolist():
            top, other = root(a), root(b)
            if top != other:
                parent[max(top, other)] = min(top, other)
                found.append((a, b))
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def common_shingles(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
    """How many elements each of ``some`` of the sets has in common with every set.

    Elements of one set alone are left out; the others are counted a few megabytes of
    incidences at a time.
    """
    sizes = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = np.repeat(np.arange(len(sets)), sizes)[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(some), len(sets)), dtype=np.float32)
    width = max(64, (4 << 20) // len(sets))
    for low in range(0, int(shared.sum()), width):
        first, end = np.searchsorted(column, (low, low + width))
        incidence = np.zeros((len(sets), width), dtype=np.float32)
        incidence[owner[first:end], column[first:end] - low] = 1
        common += incidence[some] @ incidence.T
    return common


def _contracted(component: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """Components after joining those that new links connect; ``rows`` nodes in all."""
    ends = links
    for side in "ab":
        own = component.select(
            F.col("node").alias(f"n_{side}"), F.col("component").alias(f"c_{side}")
        )
        ends = ends.join(own, F.col(side) == F.col(f"n_{side}"))
    joined = connected_components(ends.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
    joined = joined.select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = component.join(joined, F.col("component") == F.col("old"), "left")
    return written(moved.select("node", F.coalesce("new", "component").alias("component")), rows)


def _pivot_pairs(active: DataFrame, p: NearParameters) -> DataFrame:
    """The first member of every bucket against its members in other components."""
    pivots = active.where(F.col("rep") == F.col("first")).select(
        F.col("band").alias("key"),
        *(F.col(c).alias(f"p_{c}") for c in ("rep", "n", "component")),
    )
    small, large = F.least("n", "p_n"), F.greatest("n", "p_n")
    return (
        active.join(pivots, F.col("band") == F.col("key"))
        .where((100 * small >= p.percent * large) & (F.col("component") != F.col("p_component")))
        .select(F.col("p_rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )


def _confirmed(pairs: DataFrame, payload: DataFrame, p: NearParameters) -> DataFrame:
    def with_sides(frame, columns):
        ends = frame.select(F.explode(F.array("a", "b")).alias("_value")).distinct()
        needed = keyed_join(payload, F.col("doc_id"), written_values(ends), "left_semi")
        for side in "ab":
            own = needed.select(
                F.col("doc_id").alias(f"id_{side}"),
                *(F.col(c).alias(f"{short}{side}") for c, short in columns),
            )
            frame = frame.join(own, F.col(side) == F.col(f"id_{side}")).drop(f"id_{side}")
        return frame

    sketches = with_sides(pairs, [("registers", "r"), ("n_shingles", "n")])
    likely = written(sketches.mapInArrow(partial(_promising, p=p), "a long, b long").distinct())
    sets = with_sides(likely, [("shingles", "s")])
    return written(sets.mapInArrow(partial(_verified, p=p), "a long, b long"))
