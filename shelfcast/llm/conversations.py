"""Repair of chat turns: the cheapest edits that make every conversation ``(s?(ua)+)?`` by the initials of its roles.

Turns are range-sorted by conversation and turn, so a conversation of any length lies over as many partitions as it
needs.  One that fits a segment inside its partition is aligned where it lies.  Longer ones, and those at the edge of a
partition, are cut into segments; each is aligned from every state of the grammar, the segments' costs are chained, and
each segment's edits are then written out from the state it is entered in.  No conversation is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.grammar import INSERT, START, TAIL, Turn, best_edits, chain
from shelfcast.llm.shared import map_batches, materialise, ship_code

#: Turns of a segment; longer conversations are aligned in parts, with the same result.
SEGMENT = 64
_BLANKS = " \t\n\v\f\r"
_STEP = "segment long, step int, edit string, fault string, turn long, role_before string, role string, text string, cost int"
_COLUMNS = [field.split()[0] for field in _STEP.split(", ")]


def _fault(text: str, repeated: bool) -> str | None:
    core = text.rstrip(_BLANKS)
    if not core:
        return "blank"
    if repeated:
        return "duplicate"
    return None if core[-1] in ".!?" else "truncated"


def _turns(roles: list[str], faults: list[str | None]) -> list[Turn]:
    return [Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for role, fault in zip(roles, faults, strict=True)]


def _steps(segment: int, rows: list[tuple], faults: list[str | None], edits: str, state: int) -> Iterator[tuple]:
    """One row for each edit; rows are (turn, role, text), ``state`` is that before the first edit."""
    at, wanted = 0, "assistant" if state == 2 else "user"
    for step, edit in enumerate(edits):
        if edit == "I":
            yield segment, step, edit, None, None, None, wanted, "", INSERT
        else:
            turn, before, text = rows[at]
            fault, at = faults[at], at + 1
            if edit == "D":
                yield segment, step, edit, fault, turn, before, None, None, 3
                continue
            role = wanted if edit == "R" else before
            yield segment, step, edit, fault, turn, before, role, text, 2 * (edit == "R") + (fault == "truncated")
            if edit == "K":
                wanted = role
        wanted = {"s": "user", "u": "assistant", "a": "user"}[wanted[0]]


def _whole(segment: int, rows: list[tuple]) -> Iterator[tuple]:
    """The edits of a conversation that is one segment."""
    seen: set[tuple] = set()
    faults = []
    for row in rows:
        faults.append(_fault(row[2], row[1:] in seen))
        seen.add(row[1:])
    ways = best_edits(_turns([row[1] for row in rows], faults), START)
    _, edits = min((cost + INSERT * len(TAIL[to]), edits + TAIL[to]) for to, (cost, edits) in ways.items())
    return _steps(segment, rows, faults, edits, START)


def _align_sorted(schema: pa.Schema):
    """Sorted turns (key, turn, role, text) to the steps of whole conversations and the raw turns of all others.

    Raw turns have no edit; their ``step`` counts them within their segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        held: list[tuple] = []
        keys: list = []
        out: list[tuple] = []
        now, first, started, opened, size = None, number, False, True, 0

        def raw() -> None:
            nonlocal held, first, size
            for step, (turn, role, text) in enumerate(held):
                keys.append(now)
                out.append((first, step, None, None, turn, role, None, text, None))
            first, held = number, []

        def close(last: bool) -> None:
            nonlocal held, opened
            if opened or last:  # a neighbouring partition may hold more of it, or it is longer than a segment
                raw()
            else:
                for row in _whole(first, held):
                    keys.append(now)
                    out.append(row)
            held, opened = [], False

        def flush() -> pa.RecordBatch:
            nonlocal keys, out, size
            columns = list(zip(*out, strict=True)) if out else [[] for _ in _COLUMNS]
            arrays = [pa.array(keys, schema.field(0).type)] + [pa.array(column, field.type) for column, field in zip(columns, list(schema)[1:], strict=True)]
            keys, out, size = [], [], 0
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for key, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if started and key != now:
                    close(False)
                    first = number
                started, now = True, key
                if len(held) == SEGMENT:
                    opened = True
                    raw()
                held.append(tuple(row))
                number += 1
                size += 64 + len(row[2])
                if size > 4_000_000:
                    yield flush()
        if started:
            close(True)
        yield flush()

    return run


def _tables(table: pa.Table) -> pa.Table:
    """Of one segment: costs and ranks of its best edits from each state to each state (-1: none)."""
    rows = table.sort_by("step")
    turns = _turns(rows.column("role_before").to_pylist(), rows.column("fault").to_pylist())
    costs, ranks = [-1] * 16, [-1] * 16
    for state in range(4):
        ways = best_edits(turns, state)
        for rank, to in enumerate(sorted(ways, key=lambda to: ways[to][1])):
            costs[state * 4 + to], ranks[state * 4 + to] = ways[to][0], rank
    return rows.slice(0, 1).select(["key", "segment"]).append_column("costs", pa.array([costs], pa.list_(pa.int32()))).append_column("ranks", pa.array([ranks], pa.list_(pa.int32())))


def _chained(table: pa.Table) -> pa.Table:
    """Of one conversation: the state before and after each segment, and whether it is the last."""
    rows = table.sort_by("segment")
    tables = [
        {state: {to: (costs[state * 4 + to], ranks[state * 4 + to]) for to in range(4) if costs[state * 4 + to] >= 0} for state in range(4)}
        for costs, ranks in zip(rows.column("costs").to_pylist(), rows.column("ranks").to_pylist(), strict=True)
    ]
    ways = chain(tables)
    out = rows.select(["segment"])
    for name, values in (("state", [way[0] for way in ways]), ("after", [way[1] for way in ways]), ("last", [k == len(ways) - 1 for k in range(len(ways))])):
        out = out.append_column(name, pa.array(values, pa.bool_() if name == "last" else pa.int32()))
    return out


def _written(schema: pa.Schema):
    """The steps of one segment, entered and left in the chained states."""

    def run(table: pa.Table) -> pa.Table:
        sorted_rows = table.sort_by("step")
        data = {name: sorted_rows.column(name).to_pylist() for name in ("turn", "role_before", "text", "fault")}
        rows = list(zip(data["turn"], data["role_before"], data["text"], strict=True))
        one = {name: sorted_rows.column(name)[0].as_py() for name in ("segment", "state", "after", "last")}
        edits = best_edits(_turns(data["role_before"], data["fault"]), one["state"])[one["after"]][1] + (TAIL[one["after"]] if one["last"] else "")
        steps = list(_steps(one["segment"], rows, data["fault"], edits, one["state"]))
        arrays = [pa.array([sorted_rows.column("key")[0].as_py()] * len(steps), schema.field(0).type)]
        arrays += [pa.array(column, field.type) for column, field in zip(zip(*steps, strict=True), list(schema)[1:], strict=True)]
        return pa.Table.from_arrays(arrays, schema=schema)

    return run


def repair(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of all conversations, one row each: (key, segment, step, edit, fault, turn, role_before, role, text, cost).

    Turns are taken by turn (nulls first), then role, then text; (segment, step) order a conversation's edits.  A turn
    is at fault as blank, duplicate (same role and text as an earlier one) or truncated, the first that applies; blank
    and duplicate turns are deleted.  The total cost is least, and of equal costs the initials of the edits in order are
    ASCII-least.  Deleted turns have no new role and text, inserted ones no fault, turn and role_before.

    Null roles and texts are read as a single space (a blank text, a role that must change).  Turns of a null key form a
    conversation of their own.  Repeated rows are turns of their own, the later ones duplicates.  Other columns are not
    read; an empty table gives no rows.  Texts are compared and carried whole.
    """
    spark = turns.sparkSession
    ship_code(spark)
    kind = turns.schema[key].dataType
    rows = turns.select(
        F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"),
        *(F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(alias) for name, alias in ((role, "role"), (text, "text"))),
    )
    order = [F.col("key").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, F.col("text"))
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(_STEP).fields])
    arrow = pa.schema([("key", _arrow(kind)), ("segment", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("fault", pa.string()), ("turn", pa.int64()),
                       ("role_before", pa.string()), ("role", pa.string()), ("text", pa.string()), ("cost", pa.int32())])
    first = materialise(map_batches(dealt, _align_sorted(arrow), schema))

    raw = first.where("edit is null").select("key", "segment", "step", "turn", "role_before", "text")
    earliest = raw.groupBy("key", "role_before", "text").agg(F.min(F.struct("segment", "step")).alias("earliest"))
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"e.{name}")) for name in ("key", "role_before", "text")]
    core = F.regexp_replace("r.text", r"[\x20\x09-\x0D]+\z", "")
    fault = (
        F.when(core == "", "blank").when(F.struct("r.segment", "r.step") > F.col("earliest"), "duplicate")
        .when(~F.substring(core, -1, 1).isin(".", "!", "?"), "truncated")
    )
    judged = materialise(raw.alias("r").join(earliest.alias("e"), same[0] & same[1] & same[2]).select("r.*", fault.alias("fault")))
    tables = judged.select("key", "segment", "step", "role_before", "fault").groupBy("segment").applyInArrow(
        _tables, T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("segment long, costs array<int>, ranks array<int>").fields])
    )
    ways = tables.groupBy("key").applyInArrow(_chained, "segment long, state int, after int, last boolean")
    rest = judged.join(ways, "segment").groupBy("segment").applyInArrow(_written(arrow), schema)
    return first.where("edit is not null").unionByName(rest).withColumnRenamed("key", key)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summary(schema: pa.Schema):
    """Sorted steps to one row for each conversation; holds the initials of one conversation's edits and nothing else of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(name).to_pylist() for name in ("key", "edit", "fault", "turn", "role_before", "role", "text", "cost")), strict=True)

        out: list[tuple] = []
        for key, steps in groupby(rows(), key=lambda row: row[0]):
            faults = {"blank": 0, "duplicate": 0, "truncated": 0}
            illegal = cost = distinct = 0
            least = most = before = None
            audit, hashed, some = [], hashlib.sha256(), False
            for _, edit, fault, turn, old, role, text, price in steps:
                audit.append(edit)
                cost += price
                if edit != "I":
                    if fault:
                        faults[fault] += 1
                    if before is not None and before + old[:1] not in ("su", "ua", "au"):
                        illegal += 1
                    before = old[:1]
                    if turn is not None and turn != most:  # turns ascend
                        least, most, distinct = turn if least is None else least, turn, distinct + 1
                if edit != "D":
                    hashed.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
            gaps = most - least + 1 - distinct if distinct else 0
            out.append((key, gaps, *faults.values(), illegal, cost, "".join(audit), hashed.hexdigest()))
            if len(out) == 2000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema)


def summarise(steps: DataFrame, key: str = "conv_id") -> DataFrame:
    """Of each conversation's edits: gaps in its turns, counts of faults, illegal neighbours, cost, audit and a digest.

    The digest is of all repaired ``role:text`` in order; edits are streamed in order, so no conversation is held.
    """
    kind = steps.schema[key].dataType
    names = [field.split() for field in _SUMMARY.split(", ")]
    arrow = pa.schema([("key", _arrow(kind)), *((name, pa.int64() if of == "long" else pa.string()) for name, of in names)])
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(_SUMMARY).fields])
    dealt = steps.withColumnRenamed(key, "key").repartition("key").sortWithinPartitions(F.col("key").asc_nulls_first(), "segment", "step")
    columns = ("key", "edit", "fault", "turn", "role_before", "role", "text", "cost")
    return map_batches(dealt.select(*columns), _summary(arrow), schema).withColumnRenamed("key", key)


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults planted by the remainder of crc32(``conv_id:turn``) by 20, nulls read as one space."""

    def known(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")), F.lit(20))
    text = F.when(what == 1, "").when(what == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(what == 4, "user").otherwise(known("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(what == 0, 0).when(what == 3, 2).otherwise(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).select("conv_id", "turn", "role", "text")


def oracle_sql() -> str:
    """The registered query's rows in DuckDB: damage, and the cheapest edits by a walk over turns and last initials."""
    return r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), checked AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda crc, byte:
    list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS kind FROM given
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM checked, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, CASE WHEN core = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
), moves(st, ins, st2) AS (VALUES ('', '', ''), ('', 'I', 'u'), ('', 'II', 'a'), ('s', '', 's'), ('s', 'I', 'u'), ('s', 'II', 'a'), ('u', '', 'u'), ('u', 'I', 'a'), ('a', '', 'a'), ('a', 'I', 'u')
), walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS st, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS best FROM judged
  UNION ALL
  SELECT conv_id, i, st, min({'cost': cost, 'audit': audit}) AS best FROM (
    SELECT f.conv_id, f.i, e.st3 AS st, w.best.cost + 2 * len(m.ins) + e.price + CASE WHEN e.op <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost, w.best.audit || m.ins || e.op AS audit
    FROM walk AS w JOIN judged AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN moves AS m ON m.st = w.st,
      LATERAL (SELECT 'D' AS op, m.st2 AS st3, 3 AS price
        UNION ALL SELECT 'K', f.c, 0 WHERE f.fault NOT IN ('blank', 'duplicate') AND (f.c = CASE WHEN m.st2 = 'u' THEN 'a' ELSE 'u' END OR f.c = 's' AND m.st2 = '')
        UNION ALL SELECT 'R', CASE WHEN m.st2 = 'u' THEN 'a' ELSE 'u' END, 2 WHERE f.fault NOT IN ('blank', 'duplicate')) AS e
  ) GROUP BY conv_id, i, st
), ended AS (
  SELECT w.conv_id, min({'cost': w.best.cost + CASE st WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END, 'audit': w.best.audit || CASE st WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END}) AS best
  FROM walk AS w JOIN (SELECT conv_id, max(i) AS n FROM judged GROUP BY conv_id) AS l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.i GROUP BY w.conv_id
), edits AS (
  SELECT conv_id, p, substr(best.audit, p, 1) AS op, len(replace(left(best.audit, p), 'I', '')) AS i, len(replace(left(best.audit, p), 'D', '')) AS j FROM ended, LATERAL (SELECT unnest(range(1, len(best.audit) + 1)) AS p)
), given_out AS (
  SELECT e.conv_id, e.p, e.op, e.j, f.c, CASE WHEN e.op <> 'I' THEN f.role END AS role, CASE WHEN e.op = 'I' THEN '' ELSE f.text END AS text
  FROM edits AS e LEFT JOIN judged AS f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.op <> 'I' WHERE e.op <> 'D'
), opened AS (SELECT conv_id, max(CASE WHEN j = 1 AND op = 'K' AND c = 's' THEN 1 ELSE 0 END) AS off FROM given_out GROUP BY conv_id
), written AS (
  SELECT g.conv_id, sha256(string_agg(CASE WHEN op = 'K' THEN role WHEN (j - off) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS sha
  FROM given_out AS g JOIN opened AS o ON o.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY g.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit, coalesce(w.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ended AS e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN written AS w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""
