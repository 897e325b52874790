"""Similar sets within regions, each a pivot with its members, joined in metric space.

Inside a region the join is recursive. Some members far from each other are pivots; each member's home is the cell of the nearest (Voronoi),
and it is a visitor in the cells of pivots that are no more than twice the threshold further away. If x and y link, y is at home or a
visitor where x is at home: d(y, p) <= t + d(x, p) <= t + d(x, q) <= 2t + d(y, q). Cells that do not become smaller are
compared, members of the smallest components first; only pairs that the windows |d(x, p) - d(y, p)| <= t leave and that are not connected
yet. Only a forest of links leaves a task.

Large regions are dealt to blocks, each with the pivot. After the blocks are joined, members outside the region's largest
component meet all other blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import stored
from rainledger.llm.components import components, forest

BLOCK = 1024  # members of a region that meet in a task at once
BLOCK_SHINGLES = 1 << 21  # of a block; a larger set stands alone
SMALL = 48  # members that are compared without pivots
PIVOTS = 6


class Cell:
    """Sets that meet in a task, their shared shingles as postings, and what is connected already."""

    def __init__(self, sets: list[np.ndarray], roots: np.ndarray, percent: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.percent, self.window = percent, 1 - percent / 100 + 1e-9
        self.roots = np.unique(roots, return_inverse=True)[1]
        self.found: list[tuple[int, int]] = []
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        shared = np.bincount(at, minlength=len(values))[at] > 1
        at, owner = np.unique(at[shared], return_inverse=True)[1], owner[shared]
        self._at, self._from = at, np.searchsorted(owner, np.arange(len(sets) + 1))
        self._owner = owner[np.argsort(at, kind="stable")]
        self._ends = np.cumsum(np.bincount(at)) if len(at) else np.zeros(0, np.int64)

    def shared(self, x: int) -> np.ndarray:
        """How many shingles ``x`` has in common with every set."""
        tokens = self._at[self._from[x] : self._from[x + 1]]
        ends = self._ends[tokens]
        starts = np.where(tokens > 0, self._ends[tokens - 1], 0)
        many = ends - starts
        places = np.repeat(starts - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(self._owner[places], minlength=len(self.sizes))

    def compare(self, x: int, others: np.ndarray) -> np.ndarray:
        """Link ``x`` to those of ``others`` it is similar to; its distance to each of them."""
        common = self.shared(x)[others]
        union = self.sizes[x] + self.sizes[others] - common
        for y in others[100 * common >= self.percent * union].tolist():
            if self.roots[x] != self.roots[y]:
                self.found.append((x, y))
                self.roots[self.roots == self.roots[y]] = self.roots[x]
        return 1 - common / np.maximum(union, 1)

    def join(self, home: np.ndarray, visitors: np.ndarray, known: np.ndarray | None = None) -> None:
        """Connect what the links of all pairs at home, and of those at home with visitors, connect.

        ``known`` has distances to pivots so far, a row per pivot and a column per set.
        """
        every = np.concatenate([home, visitors])
        if not len(home) or (self.roots[every] == self.roots[every[0]]).all():
            return
        if len(every) <= SMALL:
            return self.exhaust(home, visitors, known)
        rows, x = [], int(home[0])
        for _ in range(PIVOTS):  # the next pivot is far from those before
            d = np.full(len(self.sizes), np.inf)
            d[every] = self.compare(x, every)
            rows.append(d)
            least = np.min(rows, axis=0)
            x = int(home[np.argmax(least[home])])
            if least[x] <= self.window:
                break
        d = np.array(rows)
        known = d if known is None else np.vstack([known[-2 * PIVOTS :], d])
        nearest = d[:, home].argmin(axis=0)
        for cell in range(len(d)):
            own = home[nearest == cell]
            near = every[d[cell, every] <= least[every] + 2 * self.window]
            near = np.setdiff1d(near, own, assume_unique=False)
            if len(own) + len(near) > 0.8 * len(every):
                self.exhaust(own, near, known)
            else:
                self.join(own, near, known)

    def exhaust(self, home: np.ndarray, visitors: np.ndarray, known: np.ndarray | None) -> None:
        """Compare until all that is left is connected; members of small components first, as those are compared with all others."""
        at_home = np.zeros(len(self.sizes), bool)
        at_home[home] = True
        left = np.concatenate([home, visitors])
        while len(left) > 1 and at_home[left].any():
            _, component, many = np.unique(self.roots[left], return_inverse=True, return_counts=True)
            if len(many) == 1:
                return
            pick = int(np.argmin(many[component]))
            x, left = int(left[pick]), np.delete(left, pick)
            others = left if at_home[x] else left[at_home[left]]
            small, large = np.minimum(self.sizes[x], self.sizes[others]), np.maximum(self.sizes[x], self.sizes[others])
            others = others[(self.roots[others] != self.roots[x]) & (100 * small >= self.percent * large)]
            if known is not None and len(others):
                with np.errstate(invalid="ignore"):
                    apart = np.abs(known[:, others] - known[:, [x]])
                others = others[~(np.where(np.isfinite(apart), apart, 0) > self.window).any(axis=0)]
            if len(others):
                self.compare(x, others)


def cell_links(nodes: np.ndarray, sets: list[np.ndarray], roots: np.ndarray, home: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the similar pairs with one node at home connect, beyond ``roots``."""
    cell = Cell(sets, roots, percent)
    cell.join(np.flatnonzero(home), np.flatnonzero(~home))
    a, b = (np.array(x, np.int64) for x in zip(*cell.found, strict=True)) if cell.found else (np.zeros(0, np.int64),) * 2
    return nodes[a], nodes[b]


def _joined(cells: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``a, b`` out of ``*keys, node, root, home, shingles``, cell by cell."""
    dealt = cells.select(*keys, "node", "root", "home", "shingles").repartition(*keys).sortWithinPartitions(*keys)
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, bool, np.ndarray]] = {}
        cell = None

        def flush() -> Iterator[pa.RecordBatch]:
            nodes = np.array(list(held), np.int64)
            rows = list(held.values())
            a, b = cell_links(nodes, [r[2] for r in rows], np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), percent)
            if len(a):
                a, b = forest(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[: width + 3]]
            for i, values in enumerate(zip(*columns, strict=True)):
                if values[:width] != cell:
                    if len(held) > 1:
                        yield from flush()
                    held, cell = {}, values[:width]
                node, root, home = values[width:]
                if node in held:  # at home and a visitor: at home
                    held[node] = (root, home or held[node][1], held[node][2])
                else:
                    held[node] = (root, home, batch.column(width + 3)[i].values.to_numpy(zero_copy_only=False).copy())
        if len(held) > 1:
            yield from flush()

    return dealt.mapInArrow(run, "a bigint, b bigint")


def region_links(members: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``node, root`` of all nodes that link: components over the similar pairs that share a region.

    ``members`` has ``pivot, node, n`` (the size of the set), the pivot among its members; ``sets`` has ``node, shingles``.
    Regions of over ``block`` members, or of very many shingles, are dealt to blocks.
    """
    members = stored(members, "members")
    parts = F.ceil(F.greatest(F.col("members") / block, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    large = stored(sizes.select("pivot", parts.alias("blocks")).where("blocks > 1"), "large-regions")
    dealt = members.join(large, "pivot", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.lit(0)))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    pivots = large.select("pivot", each, F.col("pivot").alias("node"))
    rows = dealt.select("pivot", "block", "node").unionAll(pivots).withColumns({"root": F.col("node"), "home": F.lit(True)})
    links = stored(_joined(rows.join(sets, "node"), ["pivot", "block"], percent), "links")
    if large.isEmpty():
        return components(links)
    roots = stored(components(links), "roots")
    rooted = stored(dealt.where("blocks is not null").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    counts = rooted.groupBy("pivot", "root").agg(F.count(F.lit(1)).alias("many"))
    major = counts.groupBy("pivot").agg(F.max_by("root", F.struct("many", -F.col("root"))).alias("major"), F.sum("many").alias("members"), F.max("many").alias("most"))
    left = (F.col("members") - F.col("most")).alias("left")
    open_regions = stored(major.select("pivot", "major", left).where("left > 0").withColumn("rows", F.ceil(F.col("left") / block).cast("int")), "open-regions")
    if open_regions.isEmpty():
        return roots
    rooted = rooted.join(open_regions.drop("left"), "pivot")
    row = F.pmod(F.xxhash64("node", "pivot"), F.col("rows")).cast("int")
    outside = rooted.where("root <> major").withColumn("row", row).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    others = rooted.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    cells = [df.select("pivot", "row", "block", "node", "root", F.lit(home).alias("home")) for df, home in ((outside, True), (others, False))]
    more = _joined(cells[0].unionAll(cells[1]).join(sets, "node"), ["pivot", "row", "block"], percent)
    return components(links.unionAll(stored(more, "links")))
