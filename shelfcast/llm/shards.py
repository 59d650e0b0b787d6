"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by the hash of their text, so equal texts are neighbours.  Exact bytes and rows below candidate key
boundaries are counted over all partitions; the cells around each wanted boundary are divided again until every
boundary is within the tolerance.  Then the rows are exchanged once, each to its known range, and numbered there.

Equal texts stay in one shard: groups larger than the tolerance are placed first (largest first, into the emptiest
shard) and the boundaries of the rest fill what is left.  Only a group that no shard can hold is cut, by row.  The
driver sees counts of cells and of large groups alone; their number depends on the tolerance and on rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.shared import materialise

_TOP = 1 << 63
_CELLS = 1024


def _unsigned(*columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def _histogram(frame: DataFrame, spans: list[tuple[int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """For each span (start, width of a cell): (end of cell, bytes, rows) of its filled cells, from one pass."""
    place = F.lit(None).cast("struct<span:int,cell:long>")
    for number, (start, width) in enumerate(spans):
        inside = (F.col("place") >= start) & (F.col("place") - start <= width * _CELLS - 1)
        cell = F.floor((F.col("place") - start) / F.lit(1)) if width == 1 else F.expr(f"(place - {start}L) div {width}L")
        place = F.when(inside, F.struct(F.lit(number).alias("span"), cell.cast("long").alias("cell"))).otherwise(place)
    counted = frame.select(place.alias("at"), "size").where("at is not null").groupBy("at").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    found: dict[int, list[tuple[int, int, int]]] = {number: [] for number in range(len(spans))}
    for row in counted.collect():
        start, width = spans[row["at"]["span"]]
        found[row["at"]["span"]].append((start + (row["at"]["cell"] + 1) * width, row["bytes"], row["rows"]))
    return {number: sorted(cells) for number, cells in found.items()}


def _splitters(frame: DataFrame, targets: list[float], slack: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """A boundary (place, rows below it) for each target of bytes below it, and (end, rows below) of the first cells."""
    cells = _histogram(frame, [(0, _TOP // _CELLS)])[0]
    edges, below_bytes, below_rows = [(0, 0, 0)], 0, 0
    for end, size, rows in cells:
        below_bytes, below_rows = below_bytes + size, below_rows + rows
        edges.append((end, below_bytes, below_rows))
    first = [(end, rows) for end, _, rows in edges[1:]]
    wanted: dict[int, tuple[int, int]] = {}
    brackets = {}
    width = _TOP // _CELLS
    for number, target in enumerate(targets):
        upper = next((k for k, edge in enumerate(edges) if edge[1] >= target), len(edges) - 1)
        brackets[number] = (edges[max(0, upper - 1)], edges[upper])
    while brackets:
        open_ = {}
        for number, (lower, upper) in brackets.items():
            near = min(lower, upper, key=lambda edge: abs(edge[1] - targets[number]))
            if abs(near[1] - targets[number]) <= slack or width == 1 or upper[0] - lower[0] <= 1:
                wanted[number] = (near[0], near[2])
            else:
                open_[number] = (lower, upper)
        if not open_:
            break
        starts = sorted({upper[0] - width for _, upper in open_.values()})
        width //= _CELLS
        width = max(width, 1)
        found = _histogram(frame, [(start, width) for start in starts])
        brackets = {}
        for number, (lower, upper) in open_.items():
            start = upper[0] - width * _CELLS if width * _CELLS <= upper[0] else 0
            span = min(range(len(starts)), key=lambda k: abs(starts[k] - start))
            edges, size, rows = [(starts[span], lower[1], lower[2])], lower[1], lower[2]
            for end, more, count in found[span]:
                size, rows = size + more, rows + count
                edges.append((end, size, rows))
            at = next((k for k, edge in enumerate(edges) if edge[1] >= targets[number]), len(edges) - 1)
            brackets[number] = (edges[max(0, at - 1)], edges[at])
    return [wanted[number] for number in range(len(targets))], first


def _place_groups(groups: list[tuple[int, int]], room: list[float]) -> dict[int, list[tuple[int, float]]]:
    """For each large group (hash, bytes): (shard, bytes) of its pieces, one unless no shard can hold it; takes the room."""
    placed = {}
    for value, size in sorted(groups, key=lambda group: (-group[1], group[0])):
        pieces, left = [], float(size)
        while left > 0:
            shard = max(range(len(room)), key=lambda k: (room[k], -k))
            part = left if left <= room[shard] + 0.5 or room[shard] <= 0 else room[shard]
            pieces.append((shard, part))
            room[shard] -= part
            left -= part
        placed[value] = pieces
    return placed


def shard_by_bytes(documents: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", tolerance: float = 0.002, rows_per_task: int = 250_000) -> DataFrame:
    """All rows and columns of ``documents`` with size (UTF-8 bytes plus 1), shard and slot (gapless from 0 in a shard).

    Shards hold nearly equal bytes: within about ``tolerance`` of their share, unless rows themselves are larger.
    A null text counts as an empty one.  Rows that agree in text and key cannot be told apart and keep together.
    An empty table gives an empty result; columns named size, shard or slot are replaced.
    """
    own_names = {name: f"{name}__given" for name in documents.columns if name.lower() in ("_hash", "_own", "_starts", "_numbers", "_range", "_first")}
    if own_names:  # columns of the names used below
        dealt = shard_by_bytes(documents.withColumnsRenamed(own_names), shards, own_names.get(key, key), own_names.get(text, text), tolerance, rows_per_task)
        return dealt.withColumnsRenamed({other: name for name, other in own_names.items()})
    spark = documents.sparkSession
    kept = [name for name in documents.columns if name not in ("size", "shard", "slot")]
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(*kept, (F.octet_length(plain) + 1).cast("long").alias("size"), F.xxhash64(plain).alias("_hash"), _unsigned(key).alias("_own"))
    slim = materialise(rows.select("_hash", "_own", "size"))
    total = slim.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    share = max(total / shards, 1.0)
    large = slim.groupBy("_hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).where(F.col("bytes") > tolerance * share).collect()
    room = [share] * shards
    pieces = _place_groups([(row["_hash"], row["bytes"]) for row in large], room)

    # the rest: boundaries in the order of the text's hash
    hashes = spark.createDataFrame([(row["_hash"],) for row in large], "_hash long")
    light = materialise(slim.join(F.broadcast(hashes), "_hash", "left_anti").select(F.shiftrightunsigned("_hash", 1).alias("place"), "size"))
    targets, below = [], 0.0
    for share_left in room[:-1]:
        below += max(0.0, share_left)
        targets.append(below)
    cuts, cells = _splitters(light, targets, tolerance * share / 4)
    count = cells[-1][1] if cells else 0
    every = max(1, -(-_CELLS * rows_per_task // max(count, 1)) if count > rows_per_task * 64 else _CELLS // 64)
    merged = [(0, 0)] + [cell for k, cell in enumerate(cells) if k % every == every - 1] + [(_TOP, count)]
    edges = sorted(set(merged) | set(cuts))
    shard_of = lambda place: sum(cut[0] <= place for cut in cuts)
    held = [0] * shards
    ranges: list[tuple[int, int, int]] = []  # shard, first slot, rows
    bounds: list[int] = []
    for (begin, less), (_, more) in zip(edges, edges[1:], strict=False):
        shard = shard_of(begin)
        bounds.append(begin)
        ranges.append((shard, held[shard], more - less))
        held[shard] += more - less

    # large groups: cells in the order of the row's own hash, cut where a group spans shards
    known = {row["_hash"]: row["rows"] for row in large}
    each = {row["_hash"]: row["bytes"] for row in large}
    group_rows: list[tuple[int, int, int]] = []  # hash, start of the range, number of the range
    for value, parts in pieces.items():
        if len(parts) == 1 and known[value] <= rows_per_task:
            starts = [(0, 0, parts[0][0])]
        else:
            own = slim.where(F.col("_hash") == value).select(F.col("_own").alias("place"), "size")
            ends, done = [], 0.0
            for _, part in parts[:-1]:
                done += part
                ends.append(done)
            own_cuts, own_cells = _splitters(own, ends, max(1.0, tolerance * share / 4))
            step = max(1, len(own_cells) * rows_per_task // max(known[value], 1))
            marks = sorted(set(own_cuts) | {(0, 0)} | {cell for k, cell in enumerate(own_cells[:-1]) if k % step == step - 1})
            starts = [(place, less, parts[sum(cut[0] <= place for cut in own_cuts)][0]) for place, less in marks]
        for (place, less, shard), (_, more, _) in zip(starts, [*starts[1:], (_TOP, known[value], 0)], strict=True):
            group_rows.append((value, place, len(ranges)))
            ranges.append((shard, held[shard], more - less))
            held[shard] += more - less
    del each

    listed = spark.createDataFrame(
        [(value, [place for v, place, _ in own], [number for v, _, number in own]) for value, own in _by_first(group_rows)], "_hash long, _starts array<long>, _numbers array<int>"
    )
    table = spark.createDataFrame([(number, shard, slot) for number, (shard, slot, _) in enumerate(ranges)], "_range int, shard int, _first long")
    bound = F.array(*[F.lit(value) for value in bounds])
    at_light = _last_not_above(bound, F.shiftrightunsigned("_hash", 1))
    at_large = F.element_at("_numbers", _last_not_above(F.col("_starts"), F.col("_own")))
    routed = rows.join(F.broadcast(listed), "_hash", "left").withColumn("_range", F.when(F.col("_numbers").isNull(), at_light - 1).otherwise(at_large).cast("int"))
    routed = routed.drop("_starts", "_numbers").join(F.broadcast(table), "_range")
    order = Window.partitionBy("_range").orderBy(F.when(F.col("_own").isNull(), 0).otherwise(F.shiftrightunsigned("_hash", 1)), "_own", key)
    numbered = routed.withColumn("slot", F.col("_first") + F.row_number().over(order) - 1)
    return numbered.select(*kept, "size", "shard", "slot")


def _by_first(rows: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    found: dict[int, list[tuple[int, int, int]]] = {}
    for row in rows:
        found.setdefault(row[0], []).append(row)
    return list(found.items())


def _last_not_above(bounds: Column, value: Column) -> Column:
    """Position (from 1) of the last of the ascending bounds that is not above the value, by binary search."""
    start = F.struct(F.lit(1).alias("low"), F.size(bounds).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = ((state["low"] + state["high"] + 1) / 2).cast("int")
        right = F.element_at(bounds, middle) <= value
        return F.struct(F.when(right, middle).otherwise(state["low"]).alias("low"), F.when(right, state["high"]).otherwise(middle - 1).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(16)), start, halve, lambda state: state["low"])
