"""Grid cells that turn a spatial join into an equi-join.

Cell sides are powers of two, so a coarser cell is an exact union of finer ones
and ``cell(v) = floor((v - origin) * 2**-e)`` is monotone in ``v``.  Monotone cells
make the plan exact without tolerances: if a point lies in a closed box, its
cell lies in the box's cell range.

Boxes of very different size get different *levels* (one exponent per axis).  A
box near its level's cell side covers only a few cells.  A pair of boxes meets
on the coarser of the two levels, per axis, and is emitted only by the cell that
holds the lower left corner of the common part, so nothing has to be
de-duplicated.

Expressions are SQL text: a plan of many small columns takes the driver longer to put
together column by column than Spark needs to run it on a small table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialize import checkpointed, size_estimate_bits

# Bits per cell index inside the packed join key: level | cx | cy.  Windows with more cells
# on an axis have a key of three columns; a double tells that many cells apart.
_PACKED_BITS = 26
_CELL_BITS = 52
_MAX_LEVELS = 12
_BROADCAST_ROWS = 500_000
_HOT_TARGETS = 1_000_000
_HOT_QUERIES = 10_000
_HOT_PAIRS = 1e9
# From this many query cells on, targets of a small table are dealt to all cores before they meet them.
_SPREAD_CELLS = 50_000
_SCAN_BYTES = 1 << 27
# Real boxes crowd together; pairs weigh more than an even spread suggests.
_CROWDING = 4.0


@dataclass
class Extents:
    """Boxes of a table counted by binary magnitude of their sides."""

    rows: int = 0
    xmin: float = math.inf
    ymin: float = math.inf
    xmax: float = -math.inf
    ymax: float = -math.inf
    area: float = 0.0
    sizes: list[tuple[int | None, int | None, int]] = field(default_factory=list)


def _num(value: float) -> str:
    return f"({float(value)!r}D)" if math.isfinite(value) else f"double('{float(value)}')"


def _magnitude(length: str) -> str:
    return f"CASE WHEN {length} > 0 THEN int(ceil(log2({length}))) END"


def _sides(window: tuple[float, float, float, float]) -> tuple[str, str]:
    """Width and height of the part of a box inside ``window``."""
    x0, y0, x1, y1 = map(_num, window)
    return f"(least(xmax, {x1}) - greatest(xmin, {x0}))", f"(least(ymax, {y1}) - greatest(ymin, {y0}))"


def measure(boxes: DataFrame, window: tuple[float, float, float, float] | None = None) -> Extents:
    """One aggregation; brings one row per pair of magnitudes to the driver.

    The number of rows is bounded by the exponent range of doubles, whatever
    the size of the table.  With ``window`` only boxes that meet it are read, and
    the magnitudes are those of their parts inside.
    """
    width, height = "(xmax - xmin)", "(ymax - ymin)"
    if window is not None:
        boxes, (width, height) = meeting(boxes, window), _sides(window)
    rows = (
        boxes.selectExpr("xmin", "ymin", "xmax", "ymax", f"{_magnitude(width)} AS ex", f"{_magnitude(height)} AS ey")
        .groupBy("ex", "ey")
        .agg(*map(F.expr, (
            "count(1) AS n", "min(xmin) AS xmin", "min(ymin) AS ymin", "max(xmax) AS xmax", "max(ymax) AS ymax",
            "sum((xmax - xmin) * (ymax - ymin)) AS area",
        )))
        .collect()
    )
    ext = Extents()
    for r in rows:
        ext.rows += r.n
        ext.xmin, ext.ymin = min(ext.xmin, r.xmin), min(ext.ymin, r.ymin)
        ext.xmax, ext.ymax = max(ext.xmax, r.xmax), max(ext.ymax, r.ymax)
        ext.area += r.area
        ext.sizes.append((r.ex, r.ey, r.n))
    return ext


def _base_exponent(sizes: list[tuple[int | None, int]], share: float, span: float, rows: int) -> int:
    """Exponent that at least ``share`` of the boxes do not exceed."""
    known = sorted((e, n) for e, n in sizes if e is not None)
    if known:
        need, seen = share * sum(n for _, n in known), 0
        for e, n in known:
            seen += n
            if seen >= need:
                break
    elif span > 0:
        e = math.ceil(math.log2(span / math.sqrt(rows)))
    else:
        e = 0
    return e


@dataclass
class Layout:
    """Origin, window, and the levels on which two tables meet."""

    window: tuple[float, float, float, float]
    base: tuple[int, int]
    step: int
    finer: int
    query_levels: list[tuple[int, int]]
    target_levels: list[tuple[int, int]] | None
    levels: list[tuple[int, int]]
    query_cells: int
    square: bool = False
    packed: bool = True

    def own_levels(self, width: str, height: str) -> tuple[str, str]:
        above = []
        for base, length in zip(self.base, (width, height), strict=True):
            steps = f"int(floor((({_magnitude(length)}) - {self.finer + base}) / {self.step}) * {self.step})"
            above.append(f"coalesce(greatest(0, {steps}), 0)")
        if self.square:
            above = [f"greatest({above[0]}, {above[1]})"] * 2
        return f"{self.base[0]} + {above[0]}", f"{self.base[1]} + {above[1]}"


def _level(
    ex: int | None, ey: int | None, base: tuple[int, int], step: int, finer: int, square: bool
) -> tuple[int, int]:
    """Level of boxes of one magnitude; ``square``: the larger side alone decides."""
    above = [0 if e is None else max(0, (e - finer - b) // step * step) for e, b in zip((ex, ey), base, strict=True)]
    if square:
        above = [max(above)] * 2
    return base[0] + above[0], base[1] + above[1]


def _work(
    queries: Extents, targets: Extents, base: tuple[int, int], step: int, finer: int, square: bool
) -> float:
    """Rows placed in cells and pairs compared, for boxes spread evenly.

    Only ranks layouts; the result of the join does not depend on it.
    """
    area = max(queries.xmax - queries.xmin, 2.0 ** base[0]) * max(queries.ymax - queries.ymin, 2.0 ** base[1])

    def sized(ext: Extents) -> list[tuple[float, float, int, tuple[int, int]]]:
        return [
            (0.0 if ex is None else 2.0**ex, 0.0 if ey is None else 2.0**ey, n,
             _level(ex, ey, base, step, finer, square))
            for ex, ey, n in ext.sizes
        ]

    def cells(w: float, h: float, level: tuple[int, int]) -> float:
        return (w / 2.0 ** level[0] + 1) * (h / 2.0 ** level[1] + 1)

    q_sized, t_sized = sized(queries), sized(targets)
    q_own, t_own = {s[3] for s in q_sized}, {s[3] for s in t_sized}
    work = 0.0
    for mine, others in ((q_sized, t_own), (t_sized, q_own)):
        for w, h, n, own in mine:
            met = {(max(own[0], o[0]), max(own[1], o[1])) for o in others}
            work += 3 * n * sum(cells(w, h, level) for level in met)
    for qw, qh, qn, q_level in q_sized:
        for tw, th, tn, t_level in t_sized:
            level = (max(q_level[0], t_level[0]), max(q_level[1], t_level[1]))
            share = min(1.0, 2.0 ** (level[0] + level[1]) / area)
            work += _CROWDING * qn * tn * cells(qw, qh, level) * cells(tw, th, level) * share
    return work


def any_size(queries: Extents) -> Extents | None:
    """Stands for boxes that nobody measured: every magnitude the window of the queries has room for.

    Most are taken to be like the queries.  None if doubles have no such magnitudes.
    """
    spans = queries.xmax - queries.xmin, queries.ymax - queries.ymin
    if max(spans) > 2.0**1000:
        return None
    rows = 1000 * queries.rows
    sizes: list[tuple[int | None, int | None, int]] = [(ex, ey, 1000 * n) for ex, ey, n in queries.sizes]
    for axis, span in enumerate(spans):
        if span > 0:
            # one more, as logarithms are rounded
            top = math.ceil(math.log2(span)) + 1
            many = range(top - _CELL_BITS - 1, top + 1)
            sizes += [(None, e, rows // len(many)) if axis else (e, None, rows // len(many)) for e in many]
    return Extents(rows, queries.xmin, queries.ymin, queries.xmax, queries.ymax, sizes=sizes)


def plan_layout(
    queries: Extents, targets: Extents | None, finer: int = 0, unmeasured: bool = False
) -> Layout:
    """Choose cell sides from the sizes that occur.

    ``finer`` makes cells ``2**finer`` times smaller than the queries.  Without
    ``targets`` (points, streams) the targets are placed on every query level.
    ``unmeasured``: width and height of the targets are magnitudes that may occur
    in any combination, so the larger side alone decides.
    """
    span_x, span_y = queries.xmax - queries.xmin, queries.ymax - queries.ymin

    def lowest(span: float) -> int:
        if math.isinf(span):
            raise ValueError("the coordinates of the queries are further apart than a double can tell")
        return math.ceil(math.log2(span)) - (_CELL_BITS - 1) if span > 0 else -1000

    def levels_of(ext: Extents, base: tuple[int, int], step: int, square: bool) -> set[tuple[int, int]]:
        return {_level(ex, ey, base, step, finer, square) for ex, ey, _ in ext.sizes}

    def met(base: tuple[int, int], step: int, square: bool) -> tuple[set, set | None, set]:
        own = levels_of(queries, base, step, square)
        other = levels_of(targets, base, step, square) if targets else None
        return own, other, {(max(qx, tx), max(qy, ty)) for qx, qy in own for tx, ty in (other or {base})}

    def base_for(share: float) -> tuple[int, int]:
        spans = (span_x, span_y)
        return tuple(
            max(
                _base_exponent([(s[axis], s[2]) for s in queries.sizes], share, spans[axis], queries.rows)
                - finer,
                lowest(spans[axis]),
            )
            for axis in (0, 1)
        )

    tries = ((0.05, 2), (0.05, 3), (0.25, 3), (0.5, 3), (0.5, 5), (0.9, 5), (1.0, 5))
    if unmeasured:  # few queries: more levels cost little, more cells are paid for by every target
        tries = ((0.05, 1), (0.05, 2), (0.25, 1), (0.5, 1), (0.5, 2), (0.9, 2), (1.0, 2))
    if finer:  # cells grow with the square of the step
        tries = ((0.05, 1), (0.05, 2), (0.25, 2), (0.5, 2), (0.9, 2), (1.0, 2))
    # points are not measured: assume many per query
    ranked = targets or Extents(sizes=[(None, None, 1000 * queries.rows)])
    best = None
    for share, step in tries:
        base, square = base_for(share), unmeasured
        q_levels, t_levels, both = met(base, step, square)
        if len(both) > _MAX_LEVELS and not square:
            # width and height vary on their own: one level for each magnitude of the larger side
            square = True
            q_levels, t_levels, both = met(base, step, square)
        work = _work(queries, ranked, base, step, finer, square)
        if best is None or work < best[0]:
            best = (work, base, step, square, q_levels, t_levels, both)
    _, base, step, square, q_levels, t_levels, both = best

    cells = 0
    for ex, ey, n in queries.sizes:
        own = _level(ex, ey, base, step, finer, square)
        for tx, ty in t_levels or {base}:
            lx, ly = max(own[0], tx), max(own[1], ty)
            per_x = 1 if ex is None else 2.0 ** min(60, max(0, ex - lx)) + 1
            per_y = 1 if ey is None else 2.0 ** min(60, max(0, ey - ly)) + 1
            cells += int(n * per_x * per_y)
    return Layout(
        window=(queries.xmin, queries.ymin, queries.xmax, queries.ymax),
        base=base,
        step=step,
        finer=finer,
        query_levels=sorted(q_levels),
        target_levels=sorted(t_levels) if t_levels else None,
        levels=sorted(both),
        query_cells=cells,
        square=square,
        packed=all(span < 2.0 ** (e + _PACKED_BITS - 1) for span, e in zip((span_x, span_y), base, strict=True)),
    )


def fine_layout(queries: Extents, finer: range, rows: int = _BROADCAST_ROWS) -> Layout:
    """Layout for point targets with the smallest cells that keep the query side small.

    Smaller cells mean fewer points compared in vain and more rows per query.
    """
    for f in reversed(finer):
        layout = plan_layout(queries, None, f)
        if layout.query_cells <= rows:
            break
    return layout


class _Lev(NamedTuple):
    """Level of a row: literals when there is only one level, else columns."""

    lid: str
    ex: str
    ey: str


def _literal_level(layout: Layout, level: tuple[int, int]) -> _Lev:
    return _Lev(f"{layout.levels.index(level)}L", f"({level[0]})", f"({level[1]})")


def _level_struct(layout: Layout, level: tuple[int, int]) -> str:
    lid, ex, ey = _literal_level(layout, level)
    return f"named_struct('lid', {lid}, 'ex', {ex}, 'ey', {ey})"


def _with_levels(
    df: DataFrame,
    layout: Layout,
    own: list[tuple[int, int]] | None,
    other: list[tuple[int, int]] | None,
) -> tuple[DataFrame, _Lev]:
    """One row per level on which the box has to appear.

    ``own`` and ``other`` are the levels that occur in the two tables; without ``own`` a
    row appears on every level.
    """
    if len(layout.levels) == 1:
        return df, _literal_level(layout, layout.levels[0])
    lev = _Lev("lev.lid", "lev.ex", "lev.ey")
    if own is None:
        levels = ", ".join(_level_struct(layout, lv) for lv in layout.levels)
        return df.selectExpr("*", f"explode(array({levels})) AS lev"), lev
    own_x, own_y = layout.own_levels(*_sides(layout.window))
    df = df.selectExpr("*", f"{own_x} AS own_x", f"{own_y} AS own_y")
    base_x, base_y = layout.base
    if layout.square:
        # one number tells a level: steps above the base, the same on both axes
        met = ", ".join(f"greatest(own_x - ({base_x}), {x - base_x})" for x, _ in other or [layout.base])
        df = df.selectExpr("*", f"explode(array_distinct(array({met}))) AS up")
        return df, _Lev("bigint(up)", f"({base_x} + up)", f"({base_y} + up)")
    entries = []
    for ox, oy in own:
        both = sorted({(max(ox, x), max(oy, y)) for x, y in other or [layout.base]})
        entries.append(f"named_struct('own_x', {ox}, 'own_y', {oy})")
        entries.append(f"array({', '.join(_level_struct(layout, lv) for lv in both)})")
    key = "named_struct('own_x', own_x, 'own_y', own_y)"
    return df.selectExpr("*", f"explode(element_at(map({', '.join(entries)}), {key})) AS lev"), lev


def _cell(value: str, origin: float, exponent: str) -> str:
    return f"floor(({value} - {_num(origin)}) * pow(2.0D, double(-{exponent})))"


def _pack(layout: Layout, lev: _Lev, cx: str, cy: str) -> str:
    if not layout.packed:
        return f"named_struct('lid', {lev.lid}, 'cx', {cx}, 'cy', {cy})"
    side = f"{1 << _PACKED_BITS}L"
    return f"({lev.lid} * {side} + {cx}) * {side} + {cy}"


def _ranged(df: DataFrame, layout: Layout, lev: _Lev, clip: bool) -> DataFrame:
    """Boxes with the range ``cx0 .. cy1`` of their cells; ``clip`` limits it to the window of the queries."""
    x0, y0, x1, y1 = layout.window
    lo_x, hi_x = _cell("xmin", x0, lev.ex), _cell("xmax", x0, lev.ex)
    lo_y, hi_y = _cell("ymin", y0, lev.ey), _cell("ymax", y0, lev.ey)
    if clip:
        lo_x, hi_x = f"greatest({lo_x}, 0L)", f"least({hi_x}, {_cell(_num(x1), x0, lev.ex)})"
        lo_y, hi_y = f"greatest({lo_y}, 0L)", f"least({hi_y}, {_cell(_num(y1), y0, lev.ey)})"
    return df.selectExpr("*", f"{lo_x} AS cx0", f"{hi_x} AS cx1", f"{lo_y} AS cy0", f"{hi_y} AS cy1")


def _cover(df: DataFrame, layout: Layout, lev: _Lev, clip: bool, border: bool = False) -> DataFrame:
    """One row per covered cell: ``cx, cy, key`` and the range ``cx0 .. cy1``.

    ``border`` leaves out the cells between the end cells of both axes.
    """
    rows = "sequence(cy0, cy1)"
    if border:
        rows = f"IF(cx = cx0 OR cx = cx1, {rows}, array_distinct(array(cy0, cy1)))"
    ranged = _ranged(df, layout, lev, clip).selectExpr("*", "explode(sequence(cx0, cx1)) AS cx")
    return ranged.selectExpr("*", f"explode({rows}) AS cy")


def query_cells(queries: DataFrame, layout: Layout, border: bool = False) -> tuple[DataFrame, _Lev]:
    """Query boxes on their levels, one row per covered cell."""
    df, lev = _with_levels(queries, layout, layout.query_levels, layout.target_levels)
    return _cover(df, layout, lev, clip=False, border=border), lev


def meeting(df: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """Boxes that meet ``window``; literals, so scans can skip."""
    x0, y0, x1, y1 = map(_num, window)
    return df.where(f"xmax >= {x0} AND xmin <= {x1} AND ymax >= {y0} AND ymin <= {y1}")


def in_window(df: DataFrame, layout: Layout) -> DataFrame:
    """Targets that can meet a query at all."""
    return meeting(df, layout.window)


def target_cells(targets: DataFrame, layout: Layout, points: bool) -> tuple[DataFrame, _Lev]:
    """Targets inside the window of the queries, one row per level and cell.

    A point has one cell per level, so its cell stays an expression of the caller.
    """
    df, lev = _with_levels(in_window(targets, layout), layout, layout.target_levels, layout.query_levels)
    return (df if points else _cover(df, layout, lev, clip=True)), lev


def _dealt(targets: DataFrame) -> DataFrame:
    """Targets in as many parts as there are cores.

    A table of few bytes is scanned by few tasks, however many pairs its rows make.  Tables
    large enough for a scan on every core stay where they are.
    """
    cores = targets.sparkSession.sparkContext.defaultParallelism
    if not targets.isStreaming and (_SCAN_BYTES * cores).bit_length() <= size_estimate_bits(targets):
        return targets
    return targets.repartition(2 * cores)


def _point_key(layout: Layout, lev: _Lev) -> str:
    x0, y0, _, _ = layout.window
    return _pack(layout, lev, _cell("xmin", x0, lev.ex), _cell("ymin", y0, lev.ey))


def cell_counts(points: DataFrame, layout: Layout) -> DataFrame:
    """(lid, cx, cy, n): points per cell on every level; coarse levels add up fine cells."""
    (x0, y0, _, _), (base_x, base_y) = layout.window, layout.base
    fine = (
        in_window(points, layout)
        .groupBy(
            F.expr(_cell("xmin", x0, f"({base_x})")).alias("fx"), F.expr(_cell("ymin", y0, f"({base_y})")).alias("fy")
        )
        .agg(F.sum("n").alias("n"))
    )
    df, lev = _with_levels(fine, layout, None, None)
    cells = df.selectExpr(
        f"{lev.lid} AS lid", f"floor(fx * pow(2.0D, double({base_x} - {lev.ex}))) AS cx",
        f"floor(fy * pow(2.0D, double({base_y} - {lev.ey}))) AS cy", "n",
    )
    return cells.groupBy("lid", "cx", "cy").agg(F.sum("n").alias("n"))


def inner_counts(counts: DataFrame, queries: DataFrame, layout: Layout) -> DataFrame:
    """(qid, n): points in the cells between the end cells of each query, as told by ``cell_counts``.

    Each row of cells has running sums, and a query takes the difference of two in each of
    its inner rows: it is listed by height, not by area.
    """
    df, lev = _with_levels(queries, layout, layout.query_levels, layout.target_levels)
    ends = (
        _ranged(df, layout, lev, clip=False).where("cx1 - cx0 > 1 AND cy1 - cy0 > 1")
        .selectExpr(f"{lev.lid} AS lid", "qid", "cx0", "cx1", "explode(sequence(cy0 + 1, cy1 - 1)) AS cy")
        .selectExpr("lid", "cy", "qid", "inline(array(struct(cx0 AS cx, -1L AS sign), struct(cx1 - 1 AS cx, 1L AS sign)))")
        .withColumn("n", F.lit(0).cast("long"))
    )
    nobody = F.lit(None).cast(queries.schema["qid"].dataType)
    marks = ends.unionByName(counts.withColumns({"qid": nobody, "sign": F.lit(0).cast("long")}))
    so_far = marks.selectExpr("qid", "sign", "sum(n) OVER (PARTITION BY lid, cy ORDER BY cx) AS n").where("sign != 0")
    return so_far.groupBy("qid").agg(F.expr("sum(sign * n) AS n")).where("n > 0")


def _salted(t: DataFrame, q: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Split hot cells into salt_t x salt_q parts; every pair meets in one part.

    Only cells above the limits are salted.  Their list holds at most
    ``target rows / _HOT_TARGETS + query rows / _HOT_QUERIES`` cells, and those
    whose comparisons exceed ``_HOT_PAIRS``; it is computed once and broadcast only when it is small.
    """
    hot = checkpointed(
        t.groupBy("key")
        .agg(F.count(F.lit(1)).alias("nt"))
        .join(q.groupBy("key").agg(F.count(F.lit(1)).alias("nq")).hint("merge"), "key")
        .where((F.col("nt") * F.col("nq").cast("double") > _HOT_PAIRS) | (F.col("nt") > _HOT_TARGETS) | (F.col("nq") > _HOT_QUERIES))
        .select(
            "key",
            F.greatest(
                F.ceil(F.col("nt") / _HOT_TARGETS),
                F.ceil(F.col("nt") * F.least("nq", F.lit(_HOT_QUERIES)).cast("double") / _HOT_PAIRS),
            ).alias("parts_t"),
            F.ceil(F.col("nq") / _HOT_QUERIES).alias("parts_q"),
        )
    )
    found = hot.count()
    if found == 0:
        return t, q, ["key"]
    hot = F.broadcast(hot) if found <= _BROADCAST_ROWS else hot.hint("merge")
    one = F.lit(1).cast("long")

    def split(df: DataFrame, own: str, other: str) -> DataFrame:
        # the salt follows from the row itself, so a retried task repeats it
        mine = F.pmod(F.xxhash64(*df.columns), F.coalesce(F.col("parts_" + own), one))
        copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts_" + other), one) - 1)
        return (
            df.join(hot, "key", "left")
            .withColumn("salt_" + own, mine)
            .withColumn("salt_" + other, F.explode(copies))
            .drop("parts_t", "parts_q")
        )

    return split(t, "t", "q"), split(q, "q", "t"), ["key", "salt_t", "salt_q"]


def meet(
    targets: DataFrame,
    queries: DataFrame,
    layout: Layout,
    points: bool,
    broadcast: str | None,
    border: bool = False,
) -> DataFrame:
    """Candidate pairs: columns of both sides prefixed ``t_`` and ``q_``.

    Each pair of rows that share a point appears exactly once.  ``broadcast``
    names the side that is small enough to send everywhere, ``None`` shuffles: cells are
    rows that size estimates know nothing of, so Spark is not left to send a side after all.
    ``border``: only in the cells on the border of a query.
    """
    if broadcast == "queries" and layout.query_cells >= _SPREAD_CELLS:
        targets = _dealt(in_window(targets, layout))
    several = len(layout.levels) > 1 and layout.target_levels is not None
    t, t_lev = target_cells(targets, layout, points)
    q, q_lev = query_cells(queries, layout, border)
    corner, level, cell = [], [], []
    if not points:
        corner, cell = ["cx0", "cy0"], ["cx", "cy"]
        level = ["own_x", "own_y"] if several else []
    q_key = _pack(layout, q_lev, "cx", "cy")
    t_key = _point_key(layout, t_lev) if points else _pack(layout, t_lev, "cx", "cy")
    t_more = [f"{t_lev.ex} AS t_ex", f"{t_lev.ey} AS t_ey"] if level else []

    def side(df: DataFrame, key: str, prefix: str, names: list[str], more: list[str]) -> DataFrame:
        return df.selectExpr(f"{key} AS key", *(f"`{c}` AS `{prefix}{c}`" for c in names), *more)

    t = side(t, t_key, "t_", targets.columns + corner + cell + level, t_more)
    q = side(q, q_key, "q_", queries.columns + corner + level, [])
    keys = ["key"]
    if broadcast is None and not targets.isStreaming:
        t, q, keys = _salted(t, q)
    if broadcast == "queries":
        q = F.broadcast(q)
    elif broadcast == "targets":
        t = F.broadcast(t)
    else:
        q = q.hint("merge")
    pairs = t.join(q, keys)
    if points:
        return pairs
    owner = "t_cx = greatest(t_cx0, q_cx0) AND t_cy = greatest(t_cy0, q_cy0)"
    if level:
        owner += " AND t_ex = greatest(t_own_x, q_own_x) AND t_ey = greatest(t_own_y, q_own_y)"
    return pairs.where(owner)
