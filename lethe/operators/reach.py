"""From business keys to the rows they reach.

One function feeds validation, estimates, rewrites and audit, so all of them
speak about the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property, partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import KeyPath, bind_as_of
from lethe.operators.parallel import in_parallel
from lethe.operators.probes import probe
from lethe.operators.sizing import (
    VALUE,
    Measured,
    durable,
    keyed_join,
    measured,
    present_values,
    sized,
    sized_groups,
    value_range,
)

_UUID = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"


def typed_key(path: KeyPath) -> Column:
    """The key in the type of the column it is compared with; NULL if malformed."""
    key = F.col("key_no")
    if path.cast == "uuid":
        lowered = F.lower(key)
        return F.when(lowered.rlike(_UUID), lowered)
    if path.cast:
        key = key.try_cast(path.cast)
    return F.upper(key) if path.ignore_case else key


def match_column(path: KeyPath) -> Column:
    """What a target row is compared by."""
    column = F.col(path.join_column)
    if path.hops:
        return column
    if path.cast == "uuid":
        return F.lower(column)
    return F.upper(column) if path.ignore_case else column


def eligible(target: DataFrame, path: KeyPath, as_of: str | None = None) -> DataFrame:
    """Target rows that satisfy the path's own condition."""
    return target.where(bind_as_of(path.where, as_of)) if path.where else target


def guarded_match(path: KeyPath, as_of: str | None = None) -> Column:
    """Like ``match_column``, but NULL (so: no match) where the condition fails."""
    match = match_column(path)
    return F.when(F.expr(bind_as_of(path.where, as_of)), match) if path.where else match


def _condensed(frame: DataFrame, carry: str | None) -> DataFrame:
    """Each non-NULL value once, with the lowest carried number."""
    frame = frame.where(F.col(VALUE).isNotNull())
    if carry is None:
        return frame.select(VALUE).distinct()
    return frame.groupBy(VALUE).agg(F.min(carry).alias(carry))


def _parent_links(
    path: KeyPath, depth: int, tables: dict[str, DataFrame], as_of: str | None = None
) -> DataFrame:
    """(_up, _down) of one hop: what the parent is found by, what it leads to."""
    hop = path.hops[depth]
    parent = tables[hop.parent_table]
    if hop.where:
        parent = parent.where(bind_as_of(hop.where, as_of))
    # the path as seen from this parent, so its match column is the next hop's
    above = replace(path, hops=path.hops[depth + 1 :])
    return parent.select(match_column(above).alias("_up"), F.col(hop.parent_col).alias("_down"))


def reach_levels(
    path: KeyPath, keys: Measured, tables: dict[str, DataFrame], carry: str | None = None,
    as_of: str | None = None,
) -> list[Measured]:
    """Values reached at each level: first the typed keys, last the target's."""
    columns = [typed_key(path).alias(VALUE)] + ([carry] if carry else [])
    # at most one value per key and none longer than its key: the keys' size is a bound
    raw = keys.frame.select(*columns)
    bounds = value_range(raw)
    low, high = raw.agg(*bounds).first() if bounds else (None, None)
    levels = [Measured(_condensed(raw, carry), keys.rows, keys.bytes, low, high)]
    for depth in range(len(path.hops) - 1, -1, -1):
        links = _parent_links(path, depth, tables, as_of)
        how = "inner" if carry else "left_semi"
        joined = keyed_join(links, F.col("_up"), levels[-1], how)
        levels.append(measured(_condensed(joined.withColumnRenamed("_down", VALUE), carry)))
    return levels


@dataclass
class Reacher:
    """Reached values of one batch and group, computed once per distinct path.

    ``keys`` (key_no, chunk_no) should be durable: it is read more than once.
    """

    keys: DataFrame
    tables: dict[str, DataFrame]
    as_of: str | None = None
    _known: dict = field(default_factory=dict)

    @classmethod
    def over(cls, keys: Measured, tables: dict[str, DataFrame], as_of: str | None = None):
        """For keys whose size is known already."""
        reacher = cls(keys.frame, tables, as_of)
        reacher.sized_keys = keys
        return reacher

    @cached_property
    def sized_keys(self) -> Measured:
        return sized(self.keys)

    def prepare(self, paths: list[KeyPath]) -> Reacher:
        """Compute the values of several paths, a hop they have in common once."""
        prepare_together([(self, p) for p in paths])
        return self

    def values(self, path: KeyPath) -> Measured:
        """Join values at the target's end of the path, each with its lowest chunk.

        The lowest ``chunk_no`` is the chunk that would get to the value first.
        """
        return self.prepare([path])._known[_identity(path)]


def _identity(path: KeyPath) -> KeyPath:
    """What the reached values depend on: not on the target, nor on its column."""
    if not path.hops:
        return replace(path, where=None, column="")
    hops = (replace(path.hops[0], child_col=""), *path.hops[1:])
    return replace(path, where=None, hops=hops)


def _above(path: KeyPath) -> KeyPath:
    """The path as seen from the parent of its first hop."""
    return replace(path, where=None, hops=path.hops[1:])


#: values to find: whose keys, along which path
Wanted = tuple[Reacher, KeyPath]


def prepare_together(wanted: list[Wanted]) -> None:
    """Compute the values of all paths of all groups; every hop reads its parent once.

    Paths form a tree from the keys down, so what they share is followed once.  Hops of
    different branches and groups that lead from one parent by the same column wait for
    each other and share a scan, each value tagged with the branches that reach it.
    """
    open_nodes: dict[tuple[int, KeyPath], Wanted] = {}
    for reacher, path in wanted:
        at = replace(path, where=None)
        while _identity(at) not in reacher._known:
            open_nodes[id(reacher), _identity(at)] = (reacher, at)
            if not at.hops:
                break
            at = _above(at)
    while open_nodes:
        scans: dict[tuple, list[Wanted]] = {}
        for reacher, path in open_nodes.values():
            scans.setdefault(_scan_of(reacher, path), []).append((reacher, path))
        ready = {k: [w for w in members if _follows_known(*w)] for k, members in scans.items()}
        # if hops wait for each other in a circle, those that can go do
        whole = {k: found for k, found in ready.items() if len(found) == len(scans[k])}
        due = [found for found in (whole or ready).values() if found]
        for members, found in zip(due, in_parallel(partial(_followed, m) for m in due), strict=True):
            for (reacher, path), values in zip(members, found, strict=True):
                reacher._known[_identity(path)] = values
                del open_nodes[id(reacher), _identity(path)]


def _scan_of(reacher: Reacher, path: KeyPath) -> tuple:
    """What hops must have in common to read their parent once."""
    if not path.hops:
        return id(reacher), _identity(path)
    hop = path.hops[0]
    where = bind_as_of(hop.where, reacher.as_of) if hop.where else None
    return id(reacher.tables[hop.parent_table]), where, hop.parent_col


def _follows_known(reacher: Reacher, path: KeyPath) -> bool:
    return not path.hops or _identity(_above(path)) in reacher._known


def _followed(members: list[Wanted]) -> list[Measured]:
    """The values of paths that differ in what leads to the parent only."""
    if not members[0][1].hops or len(members) == 1:
        return [_next_level(*w) for w in members]
    reacher, path = members[0]
    hop = path.hops[0]
    parent = reacher.tables[hop.parent_table]
    if hop.where:
        parent = parent.where(bind_as_of(hop.where, reacher.as_of))
    sets: dict[tuple, list[tuple[int, int, Measured]]] = {}
    matches: dict[tuple, Column] = {}
    for number, (reacher, path) in enumerate(members):
        above = _above(path)
        known = reacher._known[_identity(above)]
        # the first hop from the keys compares as its path says, later ones plainly
        plain = not above.hops
        lower = plain and above.cast == "uuid"
        upper = plain and above.ignore_case and not lower
        kind = known.frame.schema[VALUE].dataType.simpleString()
        key = (above.join_column, lower, upper, kind)
        sets.setdefault(key, []).append((number, 0, known))
        matches.setdefault(key, match_column(above))
    rows = parent.select(
        F.col(hop.parent_col).alias("_down"),
        *(m.alias(f"_match{i}") for i, m in enumerate(matches.values())),
    )
    probes = [probe(found) for found in sets.values()]
    near = [s.in_range(F.col(f"_match{i}"), rows) for i, s in enumerate(probes)]
    rows = rows.where(F.col("_down").isNotNull() & reduce(or_, near))
    how = "inner" if len(probes) == 1 else "left"
    for i, found in enumerate(probes):
        rows = keyed_join(rows, F.col(f"_match{i}"), found, how).withColumnRenamed("_by", f"_by{i}")
    none = F.array().cast(probes[0].frame.schema["_by"].dataType)
    by = F.concat(*(F.coalesce(f"_by{i}", none) for i in range(len(probes))))
    reached = (
        rows.select(F.col("_down").alias(VALUE), F.explode(by).alias("_by"))
        .groupBy(F.col("_by.no").alias("_no"), VALUE)
        .agg(F.min("_by.chunk_no").alias("chunk_no"))
    )
    found = sized_groups(durable(reached), "_no", list(range(len(members))))
    return [found[number] for number in range(len(members))]


def _next_level(reacher: Reacher, path: KeyPath) -> Measured:
    """The values of one path, from those of its parent."""
    if not path.hops:
        return reach_levels(path, reacher.sized_keys, reacher.tables, "chunk_no")[0]
    links = _parent_links(path, 0, reacher.tables, reacher.as_of)
    joined = keyed_join(links, F.col("_up"), reacher._known[_identity(_above(path))], "inner")
    return measured(_condensed(joined.withColumnRenamed("_down", VALUE), "chunk_no"))


def found_keys(
    path: KeyPath, target: DataFrame, keys: Measured, tables: dict[str, DataFrame],
    as_of: str | None = None,
) -> DataFrame:
    """Distinct ``key_no`` that reach at least one row of ``target``.

    Values are followed down to the target and their presence back up, so only
    sets of values travel, never (key, row) pairs.
    """
    levels = reach_levels(path, keys, tables, as_of=as_of)
    present = present_values(eligible(target, path, as_of), match_column(path), levels[-1])
    for depth in range(len(path.hops)):
        links = _parent_links(path, depth, tables, as_of)
        kept = keyed_join(links, F.col("_down"), measured(present), "left_semi")
        present = present_values(kept, F.col("_up"), levels[-2 - depth])
    return (
        keys.frame.select("key_no", typed_key(path).alias(VALUE))
        .join(present, VALUE, "left_semi")
        .select("key_no")
        .distinct()
    )
