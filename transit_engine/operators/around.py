"""What lies around positions, without making the pairs.

Positions and places meet in blocks, ``BLOCK_SIDE`` reaches high and wide: the positions in it, and the
places in it or within one reach of it, so that a place is in one block, at corners in up to four.
Pairs of a block grow with the square of its rows, so they are not made. A block has a grid of its own, with a few places per cell, and its places are put in the order
of the grid, with running sums. For positions of one grid cell, the grid's cells in a row are outside,
then may be cut by the circle, then inside, and so on back: those inside are two running sums apart,
only those that may be cut are measured one by one, about the square root of the places in the circle.
The nearest place of a kind is looked for in squares that double until nothing outside can be nearer.

``measured_pairs`` is for measures that need the distance of every pair. There the pairs are measured as
matrices of a few thousand rows and columns at most, squared straight lines first: one matrix product.

Sums, sets and distances are those of all pairs: a cell counts as inside or outside with a margin far
above rounding, and whatever is nearer to the edge is measured. Blocks of more than ``split_rows``
rows of a side are cut as in ``range_join``, and their parts are merged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from transit_engine.constants import EARTH_RADIUS_M
from transit_engine.functions.geo import finite
from transit_engine.operators.range_join import Reach, _parted

BLOCK_SIDE = 4  # reaches that a block is high and wide; at least 2
BLOCK_ROWS = 200_000  # rows of a side in a block, tens of megabytes with their running sums
_CHUNK = 1 << 20  # pairs measured at once
_MATRIX = 1 << 16  # the same, as a matrix that stays in a core's cache
_CELL_POSITIONS = 24  # of a grid's cell, that share their places in a matrix
_MOST_CELLS = 128  # of a grid's side
_BATCH = 4096  # positions whose nearest places are looked for at once
_MARGIN_DEG, _MARGIN_M = 1e-9, 1e-3
_TASKS_PER_CORE = 4


def _metres(lat1, lon1, cos1, lat2, lon2, cos2) -> np.ndarray:
    """As ``haversine_m``."""
    half_lat, half_lon = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + cos1 * cos2 * half_lon * half_lon
    with np.errstate(invalid="ignore"):
        return 2.0 * EARTH_RADIUS_M * np.arcsin(np.fmin(np.sqrt(chord), 1.0))


class _Points:
    def __init__(self, table: pa.Table, at: Sequence[str]):
        self.lat, self.lon = (table.column(name).to_numpy() for name in at)
        self.cos = np.cos(np.radians(self.lat))

    @cached_property
    def axes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places on a sphere of radius 1."""
        lon = np.radians(self.lon)
        return self.cos * np.cos(lon), self.cos * np.sin(lon), np.sin(np.radians(self.lat))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.lat[numbers], self.lon[numbers], self.cos[numbers]


class _Block:
    """Positions and places of a block, with bounds for distances within it."""

    def __init__(self, positions: _Points, places: _Points, radius_m: float, box: Sequence[float] | None):
        self.positions, self.places, self.radius_m, self.box = positions, places, radius_m, box
        lat, lon = (np.concatenate([getattr(positions, n), getattr(places, n)]) for n in ("lat", "lon"))
        self.low = lat.min(), lon.min()
        self.extent = lat.max() - lat.min(), lon.max() - lon.min()
        half = np.radians(self.extent[0]) / 2
        middle = abs(np.cos(np.radians(self.low[0] + self.extent[0] / 2)))
        self.cos = max(middle - half, 0.0), min(middle + half, 1.0)
        # Squares of straight lines through a sphere of radius 1 that are surely within reach, or may be.
        self.lines = [
            (2 * np.sin(max(radius_m + by, 0.0) / (2 * EARTH_RADIUS_M))) ** 2 for by in (-_MARGIN_M, _MARGIN_M)
        ]
        zero = np.zeros(())
        self.boxed = box is not None and min(
            self.bound(np.asarray(box[0]), zero, False), self.bound(zero, np.asarray(box[1]), False)
        ) <= radius_m + _MARGIN_M

    def bound(self, lat: np.ndarray, lon: np.ndarray, farthest: bool) -> np.ndarray:
        """Metres that a pair at most (or at least) so many degrees apart is at most (at least) apart."""
        if self.cos[0] == 0.0:  # at a pole
            return np.full(np.broadcast(lat, lon).shape, np.inf if farthest else 0.0)
        zero = np.zeros(())
        return _metres(zero, zero, self.cos[farthest], lat, lon, self.cos[farthest])

    def near(self, position: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which pairs are within reach: straight lines tell, those next to the edge are measured."""
        line = np.zeros(len(position))
        for one, two in zip(self.positions.axes, self.places.axes, strict=True):
            step = one[position] - two[place]
            line += step * step
        open_ = line <= self.lines[1]
        near = open_ if self.boxed else line <= self.lines[0]
        open_ = np.flatnonzero(open_ if self.boxed else open_ & ~near)
        near[open_], _ = self.reached(position[open_], place[open_])
        return near

    def reached(self, position: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are within reach, and their distances."""
        one, two = self.positions.of(position), self.places.of(place)
        distance = _metres(*one, *two)
        near = distance <= self.radius_m
        if self.box is not None:
            near &= (np.abs(one[0] - two[0]) < self.box[0]) & (np.abs(one[1] - two[1]) < self.box[1])
        return near, distance


class _Grid:
    """The block's places, or some of them, in the order of a grid's cells."""

    def __init__(self, block: _Block, numbers: np.ndarray, side: int):
        self.side = int(np.clip(side, 1, _MOST_CELLS))
        self.block = block
        self.size = tuple(max(extent / self.side, 1e-6) for extent in block.extent)
        row, column = self.cell(block.places.lat[numbers], block.places.lon[numbers])
        cell = row * self.side + column
        order = np.argsort(cell, kind="stable")
        self.numbers = numbers[order]
        self.first = np.searchsorted(cell[order], np.arange(self.side * self.side + 1))

    def cell(self, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [
            np.clip(((value - low) / size).astype(np.int64), 0, self.side - 1)
            for value, low, size in zip((lat, lon), self.block.low, self.size, strict=True)
        ]
        return found[0], found[1]

    def stretch(self, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the cells from ``begin`` up to, without, ``end`` of a row begin and end in the order."""
        known = (row >= 0) & (row < self.side)
        row = np.where(known, row, 0) * self.side
        begin, end = np.clip(begin, 0, self.side), np.clip(end, 0, self.side)
        first = self.first[row + begin]
        return first, np.where(known & (begin < end), self.first[row + end], first)

    def widths(self) -> tuple[np.ndarray, np.ndarray]:
        """Per distance in rows, how many columns to either side are inside and how many not outside."""
        steps = np.arange(self.side)
        most, least = (
            [np.maximum((steps + by) * size + by * _MARGIN_DEG, 0.0) for size in self.size] for by in (1, -1)
        )
        block = self.block
        inside = block.bound(most[0][:, None], most[1][None, :], True) <= block.radius_m - _MARGIN_M
        cut = block.bound(least[0][:, None], least[1][None, :], False) <= block.radius_m + _MARGIN_M
        if block.box is not None:
            inside &= (most[0] < block.box[0])[:, None] & (most[1] < block.box[1])[None, :]
            cut &= (least[0] < block.box[0])[:, None] & (least[1] < block.box[1])[None, :]
        return inside.sum(axis=1), cut.sum(axis=1)


def _pairs(begin: np.ndarray, end: np.ndarray, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (position, place in the order); position ``i`` has the stretches of row ``which[i]``."""
    length = end - begin
    upto = np.cumsum(length.sum(axis=1)[which])
    most, at = max(1, _CHUNK // begin.shape[1]), 0
    while at < len(which):
        done = upto[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(upto, done + _CHUNK, side="right"))), at + most)
        rows = which[at:to]
        n = length[rows]
        position = np.repeat(np.arange(at, to), n.sum(axis=1))
        flat = n.ravel()
        shift = begin[rows].ravel() - (np.cumsum(flat) - flat)
        yield position, np.arange(len(position)) + np.repeat(shift, flat)
        at = to


def _starts(sorted_numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(sorted_numbers, prepend=-1))


def _totals(block: _Block, sums: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and united bits of the places within reach of each position."""
    n = len(sums)
    grid = _Grid(block, np.arange(n), int(np.sqrt(n) / 2))
    sums, bits = sums[grid.numbers], bits[grid.numbers]
    used = [bit for bit in range(63) if np.bitwise_or.reduce(bits) >> bit & 1]
    counted = np.column_stack([sums, *[bits >> bit & 1 for bit in used]])
    running = np.concatenate([np.zeros((1, counted.shape[1]), np.int64), np.cumsum(counted, axis=0)])

    row, column = grid.cell(block.positions.lat, block.positions.lon)
    cells, which = np.unique(row * grid.side + column, return_inverse=True)
    row, column = np.divmod(cells, grid.side)
    inner = np.zeros((len(cells), counted.shape[1]), np.int64)
    edges = []
    inside, cut = grid.widths()
    reach = int((cut > 0).sum())
    for step in range(1 - reach, reach):
        a, b = inside[abs(step)], cut[abs(step)]
        if a == 0:
            edges.append(grid.stretch(row + step, column - b + 1, column + b))
            continue
        begin, end = grid.stretch(row + step, column - a + 1, column + a)
        inner += running[end] - running[begin]
        edges.append(grid.stretch(row + step, column - b + 1, column - a + 1))
        edges.append(grid.stretch(row + step, column + a, column + b))
    total = inner[which][:, : sums.shape[1]]
    united = ((inner[:, sums.shape[1]:] > 0) @ np.left_shift(np.int64(1), np.array(used, np.int64)))[which]
    begin, end = (np.column_stack(side) for side in zip(*edges, strict=True))
    for position, place in _pairs(begin, end, which):
        near = block.near(position, grid.numbers[place])
        position, place = position[near], place[near]
        if len(position):
            starts = _starts(position)
            total[position[starts]] += np.add.reduceat(sums[place], starts, axis=0)
            united[position[starts]] |= np.bitwise_or.reduceat(bits[place], starts)
    return total, united


def _nearest(block: _Block, numbers: np.ndarray) -> np.ndarray:
    """Distance to the nearest of the given places within reach; infinite without one."""
    best = np.full(len(block.positions.lat), np.inf)
    if not len(numbers):
        return best
    grid = _Grid(block, numbers, int(np.sqrt(len(numbers)) / 1.5))
    row, column = grid.cell(block.positions.lat, block.positions.lon)
    zero = np.zeros(())
    for batch in range(0, len(best), _BATCH):
        open_, step = np.arange(batch, min(batch + _BATCH, len(best))), 1
        while len(open_):
            rows = row[open_, None] + np.arange(-step, step + 1)[None, :]
            begin, end = grid.stretch(rows, column[open_, None] - step, column[open_, None] + step + 1)
            for position, place in _pairs(begin, end, np.arange(len(open_))):
                position = open_[position]
                near, distance = block.reached(position, grid.numbers[place])
                position, distance = position[near], distance[near]
                if len(position):
                    starts = _starts(position)
                    best[position[starts]] = np.minimum.reduceat(distance, starts)
            beyond = [np.asarray(max(step * size - _MARGIN_DEG, 0.0)) for size in grid.size]
            safe = min(block.bound(beyond[0], zero, False), block.bound(zero, beyond[1], False)) - _MARGIN_M
            if step >= grid.side or safe > block.radius_m:
                break
            open_, step = open_[best[open_] > safe], step * 2
    return best


class _Lines:
    """Straight lines between the positions and the places of a block in metres, as matrices.

    The squared length is a product of five numbers of either end, counted from the middle of the block.
    A line differs from the distance on the sphere, and by rounding, by less than ``margin``.
    """

    def __init__(self, block: _Block):
        ends = [np.stack(points.axes) * EARTH_RADIUS_M for points in (block.positions, block.places)]
        middle = np.mean([(end.min(axis=1) + end.max(axis=1)) / 2 for end in ends], axis=0)[:, None]
        ends = [end - middle for end in ends]
        squares = [(end * end).sum(axis=0) for end in ends]
        size = max(square.max() for square in squares)
        self.margin = 1e-6 + 1e-14 * size + block.radius_m**3 / (20 * EARTH_RADIUS_M**2)
        # What is added keeps rounding from giving a square below 0.
        least = 1e-14 * size + 1e-9
        self.near = np.column_stack([-2 * ends[0].T, squares[0] + least, np.ones(len(squares[0]))])
        self.far = np.stack([*ends[1], np.ones(len(squares[1])), squares[1]])
        self.close = np.sqrt(4 * least) + 2 * self.margin  # lines closer than this may be in either order


def _measured(block: _Block, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per position its pairs, smallest and largest distance, and distances in whole metres added up."""
    n = len(block.positions.lat)
    pairs, metres = np.zeros(n, np.int64), np.zeros(n, np.int64)
    nearest, farthest = np.full(n, np.inf), np.full(n, -np.inf)
    lines = _Lines(block)
    grid = _Grid(block, np.arange(len(number)), int(np.sqrt(n / _CELL_POSITIONS) * (BLOCK_SIDE + 2) / BLOCK_SIDE))
    far, number = np.ascontiguousarray(lines.far[:, grid.numbers]), number[grid.numbers].astype(np.float64)
    row, column = grid.cell(block.positions.lat, block.positions.lon)
    order = np.argsort(row * grid.side + column, kind="stable")
    cells, first = np.unique((row * grid.side + column)[order], return_index=True)
    last = [*first[1:], n]
    row, column = np.divmod(cells, grid.side)
    _, cut = grid.widths()
    reach = int((cut > 0).sum())
    stretches = [
        grid.stretch(row + step, column - cut[abs(step)] + 1, column + cut[abs(step)])
        for step in range(1 - reach, reach)
    ]
    begin, end = (np.column_stack(side) for side in zip(*stretches, strict=True))
    for i, (from_, to) in enumerate(zip(first, last, strict=True)):
        places = np.concatenate([np.arange(a, b) for a, b in zip(begin[i], end[i], strict=True)])
        if not len(places):
            continue
        there, weight = far[:, places], number[places]
        most = max(1, _MATRIX // len(places))
        for at in range(from_, to, most):
            own = order[at:min(at + most, to)]
            some = _matrix(block, lines, own, grid.numbers[places], there, weight)
            pairs[own], nearest[own], farthest[own], metres[own] = some
    return pairs, nearest, farthest, metres


def _places_of(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(true), true.shape[1])


def _matrix(
    block: _Block, lines: _Lines, own: np.ndarray, numbers: np.ndarray, there: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, ...]:
    """``_measured`` for some positions and all places that may be within their reach."""
    line = lines.near[own] @ there
    np.sqrt(line, out=line)
    whole = np.floor(line)
    rest = line - whole
    low, high = line <= block.radius_m - lines.margin, line <= block.radius_m + lines.margin
    near = high.astype(np.float64)
    # Lines next to a whole metre or to the edge don't tell; the distance does.
    next_to = rest.min() <= lines.margin or rest.max() >= 1 - lines.margin
    if next_to or block.boxed or np.count_nonzero(low) != np.count_nonzero(high):
        open_ = low != high
        if next_to:
            open_ |= high & ((rest <= lines.margin) | (rest >= 1 - lines.margin))
        if block.boxed:
            here, places = block.positions, block.places
            open_ |= high
            open_ &= np.abs(here.lat[own][:, None] - places.lat[numbers]) < block.box[0]
            open_ &= np.abs(here.lon[own][:, None] - places.lon[numbers]) < block.box[1]
            near[~open_] = 0.0
            open_ &= (low != high) | (rest <= lines.margin) | (rest >= 1 - lines.margin)
        i, j = _places_of(open_)
        reached, distance = block.reached(own[i], numbers[j])
        near[i, j], whole[i, j] = reached, np.floor(distance)
    pairs = near @ weight
    whole *= near
    found = pairs > 0

    # The smallest and the largest line, and those that may be it, are measured.
    ends = []
    for fold, held in (
        (np.minimum, np.where(near > 0, line, np.inf) if block.boxed else line), (np.maximum, line * near)
    ):
        edge = fold.reduce(held, axis=1)
        if fold is np.minimum:
            close = held <= np.where(found, edge + lines.close, -np.inf)[:, None]
        else:
            close = held >= np.where(found, edge - lines.close, np.inf)[:, None]
            close &= near > 0
        i, j = _places_of(close)
        _, distance = block.reached(own[i], numbers[j])
        starts = _starts(i)
        best = np.empty(len(own))
        best[found] = fold.reduceat(distance, starts) if len(i) else distance
        ends.append(best)
    return pairs.astype(np.int64), *ends, (whole @ weight).astype(np.int64)


def _own_block(df: DataFrame, at: Sequence[str], reach: Reach) -> DataFrame:
    lat, lon = (F.col(name) for name in at)
    height = reach.height * BLOCK_SIDE
    return df.withColumn("_band", F.floor(lat / height)).withColumn(
        "_column", F.floor(lon / (reach.width(F.col("_band"), height) * BLOCK_SIDE))
    )


def _blocks_near(df: DataFrame, at: Sequence[str], reach: Reach) -> DataFrame:
    """Rows once for every block that has them within reach, at most two of a direction."""
    def both(value: Column, by: Column) -> Column:
        size = by * BLOCK_SIDE
        return F.explode(F.array_distinct(F.array(F.floor((value - by) / size), F.floor((value + by) / size))))

    lat, lon = (F.col(name) for name in at)
    banded = df.select("*", both(lat, F.lit(reach.height)).alias("_band"))
    width = reach.width(F.col("_band"), reach.height * BLOCK_SIDE)
    return banded.select("*", both(lon, width).alias("_column"))


def _meet(
    positions: DataFrame,
    places: DataFrame,
    positions_at: Sequence[str],
    places_at: Sequence[str],
    reach: Reach,
    content: Sequence[str],
    by: Sequence[str],
    split_rows: int,
) -> tuple[PandasCogroupedOps, bool]:
    """Positions and places by block, and whether blocks are cut so that their parts are to be merged."""
    def placed(df: DataFrame, at: Sequence[str]) -> DataFrame:
        for name in at:
            df = df.where(finite(F.col(name)))
        return df.dropna(subset=list(by))

    spread, fixed, keys = _parted(
        _blocks_near(placed(places, places_at).select(*by, *places_at, *content), places_at, reach),
        _own_block(placed(positions, positions_at).select(*by, *positions_at), positions_at, reach),
        by, split_rows,
    )
    # The rows are few bytes for their work: the number of tasks follows the cores, not the bytes.
    spark = positions.sparkSession
    n = max(
        _TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    met = fixed.repartition(n, *keys).groupBy(*keys).cogroup(spread.repartition(n, *keys).groupBy(*keys))
    return met, "_spread_part" in keys


def around(
    positions: DataFrame,
    places: DataFrame,
    positions_at: Sequence[str],
    places_at: Sequence[str],
    reach: Reach,
    sums: Sequence[str],
    nearest: Sequence[str],
    bits: str,
    by: Sequence[str] = ("city",),
    split_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Positions with a place within reach, each once, with what lies there.

    ``positions`` are distinct. Of ``places``, ``sums`` are long columns that are added, the first of
    them above 0 in every row; ``nearest`` are boolean columns, each of which becomes the distance to
    the nearest place where it is true; ``bits`` is a long column of bits that are united. None of
    these is null.
    """
    met, split = _meet(
        positions, places, positions_at, places_at, reach, [*sums, *nearest, bits], by, split_rows
    )
    given = [*by, *positions_at]
    kinds = {f.name: f.dataType.simpleString() for f in positions.schema}
    schema = ", ".join([
        *[f"`{n}` {kinds[n]}" for n in given], *[f"`{n}` long" for n in sums], *[f"`{n}` double" for n in nearest],
        f"`{bits}` long",
    ])
    radius_m, box = reach.radius_m, None if reach.exact else tuple(reach.box)

    def run(here: pa.Table, there: pa.Table) -> pa.Table:
        empty = not (len(here) and len(there))
        here, there = here.combine_chunks(), there.combine_chunks()
        if empty:
            return pa.table(
                [here.column(n).slice(0, 0) for n in given] + [pa.array([], pa.int64()) for _ in sums]
                + [pa.array([], pa.float64()) for _ in nearest] + [pa.array([], pa.int64())],
                names=[*given, *sums, *nearest, bits],
            )
        block = _Block(_Points(here, positions_at), _Points(there, places_at), radius_m, box)
        added = np.column_stack([there.column(n).to_numpy() for n in sums])
        total, united = _totals(block, added, there.column(bits).to_numpy())
        found = total[:, 0] > 0
        columns = [here.column(n).filter(pa.array(found)) for n in given]
        columns += [pa.array(total[found, i]) for i in range(len(sums))]
        for name in nearest:
            best = _nearest(block, np.flatnonzero(there.column(name).to_numpy(zero_copy_only=False)))[found]
            columns.append(pa.array(best, mask=np.isinf(best)))
        return pa.table([*columns, pa.array(united[found])], names=[*given, *sums, *nearest, bits])

    found = met.applyInArrow(run, schema)
    if not split:
        return found
    return found.groupBy(*given).agg(
        *[F.sum(name).alias(name) for name in sums], *[F.min(name).alias(name) for name in nearest],
        F.bit_or(bits).alias(bits),
    )


MEASURES = ["pairs", "nearest_m", "farthest_m", "whole_metres"]


def measured_pairs(
    positions: DataFrame,
    places: DataFrame,
    positions_at: Sequence[str],
    places_at: Sequence[str],
    reach: Reach,
    number: str,
    by: Sequence[str] = ("city",),
    split_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Positions with a place within reach, each once, with the ``MEASURES`` of their pairs: how many, the
    smallest and the largest distance, and the sum of the distances in whole metres (each rounded down).

    ``positions`` are distinct; a place stands for as many as its long column ``number`` says, at least 1.
    """
    met, split = _meet(positions, places, positions_at, places_at, reach, [number], by, split_rows)
    given = [*by, *positions_at]
    kinds = {f.name: f.dataType.simpleString() for f in positions.schema}
    types = dict(zip(MEASURES, (pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True))
    schema = ", ".join([
        *[f"`{n}` {kinds[n]}" for n in given],
        *[f"`{n}` {'long' if kind == pa.int64() else 'double'}" for n, kind in types.items()],
    ])
    radius_m, box = reach.radius_m, None if reach.exact else tuple(reach.box)

    def run(here: pa.Table, there: pa.Table) -> pa.Table:
        if not (len(here) and len(there)):
            return pa.table(
                [here.column(n).slice(0, 0) for n in given] + [pa.array([], kind) for kind in types.values()],
                names=[*given, *MEASURES],
            )
        here, there = here.combine_chunks(), there.combine_chunks()
        block = _Block(_Points(here, positions_at), _Points(there, places_at), radius_m, box)
        measures = _measured(block, there.column(number).to_numpy())
        found = measures[0] > 0
        columns = [here.column(n).filter(pa.array(found)) for n in given]
        return pa.table([*columns, *[pa.array(m[found]) for m in measures]], names=[*given, *MEASURES])

    found = met.applyInArrow(run, schema)
    if not split:
        return found
    folds = dict(zip(MEASURES, (F.sum, F.min, F.max, F.sum), strict=True))
    return found.groupBy(*given).agg(*[fold(name).alias(name) for name, fold in folds.items()])
