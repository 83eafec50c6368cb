"""Balanced label propagation: linked documents move towards the shards of their neighbours.

A round is a join of links with the present shards.  Each linked document finds the shard
most of its neighbours are in and asks to move there; a shard admits movers only up to its
capacity, arrivals counted against the departures of the same round, so full shards still
exchange.  Movers are counted in cells of a hash for each pair of shards, so the quota is
decided on a table of fixed size and no shard's movers are sorted or gathered.

In the first rounds half of the documents move at a time.  Afterwards only documents that
come before all their asking neighbours, in the order of a hash, move; each such move
makes at least one cut link less, so the rounds come to an end by themselves: when nobody
asks, or when neither that order nor the reverse admits a move.  Then counts are made
exact by moving as few rows as that takes, unlinked ones first.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.frames import partitions
from quadrille.plans.materialize import checkpointed

SHARDS, SLACK = 16, 0.02
#: Rounds in which linked documents may move at the same time.
_TOGETHER = 12
_CELLS, _LATE_CELLS = 64, 512
_LOG = logging.getLogger(__name__)


def _start(shards: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")


def _admitted(
    wanted: dict[tuple[int, int, int], int], load: dict[int, int], capacity: float, shards: int, n_cells: int = _CELLS
) -> dict[tuple[int, int], int]:
    """First cell that may not move, for each pair (own, to) of ``wanted(own, to, cell)``.

    From all moves at once, the last cells that arrive at a shard beyond its limit are
    refused until every shard keeps it; what goes round in a circle stays.  The limit is
    the capacity, or the present load where that is more already.
    """
    most = {s: max(capacity, load.get(s, 0)) for s in range(shards)}
    then = {s: load.get(s, 0) for s in range(shards)}
    cells: dict[tuple[int, int], list[int]] = {}
    for own, to, cell in sorted(wanted):
        cells.setdefault((own, to), []).append(cell)
        then[own] -= wanted[own, to, cell]
        then[to] += wanted[own, to, cell]
    until = dict.fromkeys(cells, n_cells)
    over = [s for s in then if then[s] > most[s]]
    while over:
        to = over.pop()
        while then[to] > most[to]:
            # back to where most room is
            own = min((s for s in then if cells.get((s, to))), key=lambda s: then[s] - most[s])
            until[own, to] = cell = cells[own, to].pop()
            then[to] -= wanted[own, to, cell]
            then[own] += wanted[own, to, cell]
            if then[own] > most[own] and own not in over:
                over.append(own)
    return {pair: until[pair] for pair, left in cells.items() if left}


def propagate(ids: DataFrame, links: DataFrame, shards: int = SHARDS, slack: float = SLACK) -> tuple[DataFrame, int]:
    """``ids(id, ...)`` with ``shard`` and ``linked``, and the number of links still cut; ``links(a, b)`` are undirected.

    Unlinked rows can go anywhere, so only linked rows use capacity here: moves fill no
    shard beyond ``1 - slack`` of an even share of all rows, or beyond its load at the
    start.
    """
    both = links.select("a", "b").where("a != b")
    both = checkpointed(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    label = checkpointed(both.select(F.col("a").alias("id")).distinct().withColumn("shard", _start(shards)))
    load = {r[0]: r[1] for r in label.groupBy("shard").count().collect()}
    capacity = ids.count() / shards * (1 - slack)
    turn = idle = 0
    while idle < 2:
        late = turn >= _TOGETHER
        n_cells = _LATE_CELLS if late else _CELLS
        order = F.xxhash64("id", F.lit(-1))
        near = both.join(label.withColumnRenamed("id", "b"), "b").groupBy("a", "shard").agg(F.count(F.lit(1)).alias("n"))
        own = label.withColumnRenamed("shard", "own")
        ask = checkpointed(
            near.withColumnRenamed("a", "id").join(own, "id").groupBy("id", "own")
            .agg(
                F.max_by("shard", F.struct("n", F.xxhash64("id", "shard"))).alias("to"), F.max("n").alias("best"),
                F.max(F.when(F.col("shard") == F.col("own"), F.col("n")).otherwise(0)).alias("here"),
            )
            .where(F.col("best") > F.col("here"))
            .select(
                "id", "own", "to", (F.bitwise_not(order) if turn % 2 else order).alias("order"),
                F.pmod(F.xxhash64("id", F.lit(-2 - turn)), F.lit(n_cells)).alias("cell"),
            )
        )
        movers = _first_of_neighbours(ask, both) if late else ask.where(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0)
        asked = movers.groupBy("own", "to", "cell").agg(F.count(F.lit(1)).alias("n"))
        wanted = {(r["own"], r["to"], r["cell"]): r["n"] for r in asked.collect()}
        if not wanted and ask.isEmpty():
            break
        until = _admitted(wanted, load, capacity, shards, n_cells)
        turn += 1
        if not until:
            idle += late
            continue
        idle = 0
        limit = F.array(*(F.lit(until.get((s, t), 0)) for s in range(shards) for t in range(shards)))
        moved = movers.where(F.col("cell") < F.get(limit, F.col("own") * shards + F.col("to")))
        for (own_shard, to, cell), n in wanted.items():
            if cell < until.get((own_shard, to), 0):
                load[own_shard] -= n
                load[to] = load.get(to, 0) + n
        label = checkpointed(
            label.join(moved.select("id", "to"), "id", "left").select("id", F.coalesce("to", "shard").alias("shard"))
        )
    ends = both.where("a < b").join(label.select(F.col("id").alias("a"), F.col("shard").alias("of_a")), "a")
    ends = ends.join(label.select(F.col("id").alias("b"), F.col("shard").alias("of_b")), "b")
    cut = ends.where("of_a != of_b").count()
    return ids.join(label.withColumn("linked", F.lit(True)), "id", "left").select(
        *ids.columns, F.coalesce("shard", _start(shards)).alias("shard"), F.coalesce("linked", F.lit(False)).alias("linked")
    ), cut


def _first_of_neighbours(ask: DataFrame, both: DataFrame) -> DataFrame:
    """Those of ``ask(id, order, ...)`` that no asking neighbour comes before."""
    a = ask.select(F.col("id").alias("a"), F.struct("order", "id").alias("of_a"))
    b = ask.select(F.col("id").alias("b"), F.struct("order", "id").alias("of_b"))
    later = both.join(a, "a").join(b, "b").where("of_b < of_a").select(F.col("a").alias("id")).distinct()
    return checkpointed(ask.join(later, "id", "left_anti"))


def _numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``name``: gapless numbers from 0 in each ``group``, by ``order`` and then by cells of the id's hash."""
    cells = partitions(rows.sparkSession)
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(cells)))
    part = [*group, *order, "_cell"]
    before = Window.partitionBy(*group).orderBy(*order, "_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*part).orderBy("id"))
    return dealt.withColumn("_own", own).join(counts, part).withColumn(
        name, (F.col("_before") + F.col("_own") - 1).cast("long")
    ).drop("_cell", "_own", "_before")


def even(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``placed(id, shard, linked, ...)`` with counts at most one apart; unlinked rows move first."""
    load = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}
    total = sum(load.values())
    full = sorted(range(shards), key=lambda s: (-load.get(s, 0), s))[: total % shards]
    extra = {s: load.get(s, 0) - total // shards - (s in full) for s in range(shards)}
    if not any(extra.values()):
        return placed
    ranked = _numbered(placed, ["shard"], ["linked"], "_rank")
    give, at = {}, 0
    for s in range(shards):
        if extra[s] > 0:
            give[s], at = (extra[s], at), at + extra[s]
    surplus = F.create_map(*(F.lit(x) for s, (n, _) in give.items() for x in (s, n)))[F.col("shard")]
    first = F.create_map(*(F.lit(x) for s, (_, a) in give.items() for x in (s, a)))[F.col("shard")]
    moves, number, at = F.coalesce(F.col("_rank") < surplus, F.lit(False)), first + F.col("_rank"), 0
    choices = []
    for s in range(shards):
        if extra[s] < 0:
            at -= extra[s]
            choices.append((number < at, s))
    to = reduce(lambda rest, c: F.when(c[0], F.lit(c[1])).otherwise(rest), reversed(choices), F.lit(None).cast("int"))
    return ranked.withColumn("shard", F.when(moves, to).otherwise(F.col("shard")).cast("int")).drop("_rank")


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slack: float = SLACK
) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard``; equal texts are linked.

    The law is ``rows``: counts of any two shards differ by one at most.  A group of equal
    texts stays together as far as that allows; one too large for a shard is linked in
    parts, which stay together.  A null text counts as empty for links and the checksum,
    ``size`` is 1 then.  Rows with the same or a null id are separate rows; other columns
    are ignored.  Empty input: no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = checkpointed(
        docs.select(
            F.col(id_col).cast("long").alias("id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest"),
        )
    )
    total = base.count()
    groups = base.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    part = max(1, total // shards // 4)
    member = checkpointed(
        base.select("id", "digest").join(groups, "digest")
        .withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), F.ceil(F.col("n") / part)))
    )
    hubs = member.groupBy("digest", "part").agg(F.min("id").alias("hub"))
    heads = hubs.groupBy("digest").agg(F.min("hub").alias("head"))
    links = member.join(hubs, ["digest", "part"]).select(F.col("id").alias("a"), F.col("hub").alias("b")).unionByName(
        hubs.join(heads, "digest").select(F.col("hub").alias("a"), F.col("head").alias("b"))
    )
    rows = base.select("id", "size", "text_crc32")
    moved, cut = propagate(rows, links, shards, slack)
    _LOG.info("%d of the links between equal texts are cut", cut)
    placed = checkpointed(even(checkpointed(moved), shards))
    return _numbered(placed, ["shard"], [], "slot").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
