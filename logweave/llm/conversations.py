"""Conversation structure repair (operator 13): Wagner-Fischer target alignment.

A conversation's turns become one code each (the role's initial and the fault), and the codes are
aligned to targets: the strings of the grammar ``(s?(ua)+)?`` of each feasible length. A length is
feasible while the rows it forces to be deleted or inserted cost no more than the incumbent, the
best alignment so far; the alignment itself keeps to the Ukkonen band that the incumbent leaves,
so that later lengths cost less. Of equally cheap alignments the backtraced audits are
compared and the ASCII-least wins.

A conversation may hold any share of all rows. So the turns are numbered by range
partitioning and cut into blocks of ``BLOCK`` turns, and a block is aligned from each
state of the grammar (nothing yet, after ``s``, after ``u``, after ``a``) to the targets that lead to
each other state. The least costs form a 4 x 4 matrix; products of them, taken over a tree of
``FAN`` blocks a task, give every block the cost of all that follows, then the state it starts in. With those
each block finds its part of the audit by itself. A conversation of one block, the usual case, needs no tree.

No part of an audit but the last ends in an insertion (it opens the next block's instead), so no part is
the beginning of another one and comparing parts is comparing whole audits.

The fingerprint of a repaired conversation hashes its lines in order: one task streams
them, holding one row at a time. Only there are texts moved, once.

Defined cases: a null role, text, turn or id is one space in the damage's key and in the rows; a null id is an
id; turns are in ascending order, null first, rows of equal turn by role and text; every id of the table is
returned, also when no row is left; a role or an empty string that starts with none of
s, u, a cannot be kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.indexing import with_row_id
from ..session import cut_lineage
from .common import table

BLOCK = 48          # turns aligned together
FAN = 256           # blocks joined by one task
INF = 1 << 60
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
#: States of the grammar: nothing yet, after s, after u, after a; and the least cost to an accepted end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
TO_END = (0, 2 * INSERT, INSERT, 0)
ENDING = ("", "II", "I", "")
SPACE = " \t\n\x0b\x0c\r"
#: Codes of turns: initial (s, u, a, other) and whether the text is cut off; X must go.
_CODES = {"s": ("s", 0), "u": ("u", 0), "a": ("a", 0), "o": ("", 0), "S": ("s", 1), "U": ("u", 1), "A": ("a", 1), "O": ("", 1)}


# ------------------------------------------------------------------ alignment
def lower_bound(rows: int, must: int, length: int) -> int:
    """Of ``rows`` turns, ``must`` of which go, to a target of some length."""
    kept = rows - must
    return DELETE * (must + max(0, kept - length)) + INSERT * max(0, length - kept)


def align(codes: str, target: str, limit: int) -> tuple[int, list[dict[int, int]]]:
    """Wagner-Fischer from the end: (cost, table), table[i][j] the least cost of turning the rows from i on into
    the target's letters from j on, without insertions behind the last row. Cells outside the Ukkonen
    band, which cannot be on a path of cost ``limit``, are left out; the cost is INF when all paths are dearer."""
    n, m = len(codes), len(target)
    must = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        must[i] = must[i + 1] + (codes[i] == "X")
    table: list[dict[int, int]] = [{} for _ in range(n + 1)]
    table[n][m] = 0
    for i in range(n - 1, -1, -1):
        code, below, row = codes[i], table[i + 1], table[i]
        initial, cut_off = _CODES.get(code, ("", 0))
        lowest = min(below)
        for j in range(max(below), -1, -1):
            cost = below.get(j, INF) + DELETE
            if j < m:
                if code != "X" and j + 1 in below:
                    here = target[j]
                    if initial == here:
                        cost = min(cost, below[j + 1] + cut_off)
                    elif here != "s":
                        cost = min(cost, below[j + 1] + REROLE + cut_off)
                if target[j] != "s" and j + 1 in row:
                    cost = min(cost, row[j + 1] + INSERT)
            if cost < INF and cost + lower_bound(i, must[0] - must[i], j) <= limit:
                row[j] = cost
            elif j < lowest and cost >= INF:
                break
        if not row:
            return INF, table
    return table[0].get(0, INF), table


def backtrace(codes: str, target: str, table: list[dict[int, int]]) -> str:
    """The ASCII-least audit (D < I < K < R) among the cheapest paths of the table."""
    i = j = 0
    audit = []
    while i < len(codes):
        cost, below = table[i][j], table[i + 1]
        initial, cut_off = _CODES.get(codes[i], ("", 0))
        if below.get(j, INF) + DELETE == cost:
            audit.append("D")
            i += 1
        elif j < len(target) and target[j] != "s" and table[i].get(j + 1, INF) + INSERT == cost:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if initial == target[j] else "R")
            i, j = i + 1, j + 1
    return "".join(audit)


def targets(state: int, length: int) -> list[tuple[str, int]]:
    """(target, state it leads to) of this length from a state of the grammar."""
    if not length:
        return [("", state)]
    first = "a" if state == AFTER_U else "u"
    chain = (("ua" if first == "u" else "au") * length)[:length]
    out = [(chain, AFTER_U if chain[-1] == "u" else AFTER_A)]
    if state == START:
        led = "s" + ("ua" * length)[:length - 1]
        out.append((led, {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[led[-1]]))
    return out


def repair(codes: str, state: int, to_go: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost, audit, state reached) of a block from a state: the least cost with what is to go from the
    state reached, the ASCII-least audit of that cost. INF and no audit where nothing is reached."""
    n, must = len(codes), codes.count("X")
    kept = n - must
    best, found, reached = INF, "", state
    # lengths by distance from the number of rows that may stay: the likely best one sets the incumbent
    for distance in range(n + DELETE * n + 3):
        lengths = {kept + distance, kept - distance}
        live = False
        for length in sorted(lengths):
            if length < 0 or lower_bound(n, must, length) > best:
                continue
            live = True
            for target, end in targets(state, length):
                if to_go[end] >= INF or lower_bound(n, must, length) + to_go[end] > best:
                    continue
                limit = best - to_go[end] if best < INF else _first_limit(codes, target)
                cost, cells = align(codes, target, limit)
                if cost >= INF or cost + to_go[end] > best:
                    continue
                audit = backtrace(codes, target, cells)
                if cost + to_go[end] < best or audit < found:
                    best, found, reached = cost + to_go[end], audit, end
        if not live and (best < INF or distance > n + 1):
            break
    return best, found, reached


def _first_limit(codes: str, target: str) -> int:
    """A limit that keeps a path whenever there is one: doubled (Ukkonen) until the alignment stays within."""
    limit = 4 + DELETE * codes.count("X") + sum(c in "SUAO" for c in codes)
    most = DELETE * len(codes) + (INSERT + REROLE + CUT_OFF) * (len(target) + len(codes)) + 1
    while limit < most and align(codes, target, limit)[0] >= INF:
        limit *= 2
    return min(limit, most)


@cache
def _only(end: int) -> tuple[int, ...]:
    return tuple(0 if s == end else INF for s in range(4))


def cost_matrix(codes: str) -> list[int]:
    """16 numbers: the least cost of the block from each state to each other."""
    return [repair(codes, a, _only(b))[0] for a in range(4) for b in range(4)]


# ------------------------------------------------------------------ blocks of a conversation
def product(x: list[int], y: list[int]) -> list[int]:
    """Least costs through x, then y."""
    return [min(INF, min(x[4 * a + k] + y[4 * k + b] for k in range(4))) for a in range(4) for b in range(4)]


IDENTITY = [0 if a == b else INF for a in range(4) for b in range(4)]
_MATRICES = "conv_id {0}, block bigint, m array<bigint>"


def _by(parent: Column) -> list[Column]:
    return [F.col("conv_id"), parent.alias("_parent")]


def neighbours(matrices: DataFrame, later: bool) -> DataFrame:
    """(conv_id, block, m): of every block the product of all later (or all earlier) blocks of its conversation.

    ``FAN`` neighbours are multiplied in one task, and the products again, until a conversation is one product; on the
    way back each gets its parent's neighbours times its own siblings'."""
    schema = _MATRICES.format(dict(matrices.dtypes)["conv_id"])
    parent = F.floor(F.col("block") / FAN)
    if not matrices.agg(F.max("block")).first()[0]:
        return matrices.select("conv_id", "block", F.array(*[F.lit(x).cast("bigint") for x in IDENTITY]).alias("m"))

    def whole(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        m = IDENTITY
        for x in t.column("m").to_pylist():
            m = product(m, x)
        return pa.table([t.column("conv_id").slice(0, 1), pa.array([t.column("block")[0].as_py() // FAN], pa.int64()),
                         pa.array([m], pa.list_(pa.int64()))], names=["conv_id", "block", "m"])

    def beside(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "descending" if later else "ascending")])
        m, out = t.column("carried")[0].as_py(), []
        for x in t.column("m").to_pylist():
            out.append(m)
            m = product(x, m) if later else product(m, x)
        return pa.table([t.column("conv_id"), t.column("block"), pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "block", "m"])

    parents = cut_lineage(matrices.groupBy(*_by(parent)).applyInArrow(whole, schema))
    carried = neighbours(parents, later).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("m").alias("carried"))
    met = matrices.join(carried, F.col("conv_id").eqNullSafe(F.col("_c")) & (parent == F.col("_b")))
    return cut_lineage(met.select("conv_id", "block", "m", "carried").groupBy(*_by(parent)).applyInArrow(beside, schema))


def _map(df: DataFrame, rows: Callable[[list[dict]], list[dict]], schema: str, types: list[tuple[str, pa.DataType]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = rows(batch.to_pylist())
            yield pa.RecordBatch.from_pylist(out, pa.schema([(n, t if t is not None else batch.schema.field("conv_id").type) for n, t in types]))
    return df.mapInArrow(run, schema)


def block_audits(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, cost, audit) from (conv_id, block, n_blocks, codes): each block's part of the cheapest repair."""
    id_type = dict(blocks.dtypes)["conv_id"]
    types = [("conv_id", None), ("block", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
    schema = f"conv_id {id_type}, block bigint, cost bigint, audit string"

    def single(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            cost, audit, end = repair(r["codes"], START, TO_END)
            out.append({"conv_id": r["conv_id"], "block": r["block"], "cost": cost, "audit": audit + ENDING[end]})
        return out

    alone = _map(blocks.where("n_blocks = 1").select("conv_id", "block", "codes"), single, schema, types)
    cut = blocks.where("n_blocks > 1")

    def measure(rows: list[dict]) -> list[dict]:
        return [{"conv_id": r["conv_id"], "block": r["block"], "m": cost_matrix(r["codes"])} for r in rows]

    matrices = cut_lineage(_map(cut.select("conv_id", "block", "codes"), measure, _MATRICES.format(id_type),
                                [("conv_id", None), ("block", pa.int64()), ("m", pa.list_(pa.int64()))]))
    later = neighbours(matrices, True).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("m").alias("rest"))
    met = cut.join(later, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))).select(
        "conv_id", "block", "n_blocks", "codes", "rest")

    def from_each_state(rows: list[dict]) -> list[dict]:
        out = []
        for r in rows:
            to_go = tuple(min(INF, min(r["rest"][4 * a + b] + TO_END[b] for b in range(4))) for a in range(4))
            found = [repair(r["codes"], state, to_go) for state in range(4)]
            out.append({"conv_id": r["conv_id"], "block": r["block"], "last": r["block"] == r["n_blocks"] - 1,
                        "costs": [c - to_go[e] if c < INF else INF for c, _, e in found], "audits": [a for _, a, _ in found], "ends": [e for _, _, e in found],
                        "m": [0 if found[a][0] < INF and found[a][2] == b else INF for a in range(4) for b in range(4)]})
        return out

    parts = cut_lineage(_map(met, from_each_state, f"conv_id {id_type}, block bigint, last boolean, costs array<bigint>, audits array<string>, ends array<bigint>, m array<bigint>",
                             [("conv_id", None), ("block", pa.int64()), ("last", pa.bool_()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
                              ("ends", pa.list_(pa.int64())), ("m", pa.list_(pa.int64()))]))
    earlier = neighbours(parts.select("conv_id", "block", "m"), False).select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), F.col("m").alias("led"))
    placed = parts.join(earlier, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")))
    # of the four entries from the start exactly one is reached
    state = (F.array_position(F.slice("led", 1, 4), F.lit(0).cast("bigint")) - 1).cast("int")
    ending = lambda values: F.when(F.col("last"), F.get(F.array(*[F.lit(v) for v in values]), F.get("ends", state).cast("int")))
    chained = placed.select("conv_id", "block", (F.get("costs", state) + F.coalesce(ending([int(x) for x in TO_END]), F.lit(0))).cast("bigint").alias("cost"),
                            F.concat(F.get("audits", state), F.coalesce(ending(ENDING), F.lit(""))).alias("audit"))
    return alone.unionByName(chained)


# ------------------------------------------------------------------ rows
def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that a row's checksum names; nulls are one space."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("_kind"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return rows.where("_kind != 0").withColumn("_copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def coded_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, row_id, turn, initial, fault) of (conv_id, turn, role, text), in order and without texts.

    A row repeats another when its role and text came before: whether it is the first is found from the least turn of each
    (conversation, role, text), joined on the turn as well, so that no frequent text is a join's hot key."""
    stripped = F.rtrim(F.col("text"), F.lit(SPACE))
    flat = turns.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), (stripped == "").alias("blank"),
                        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut_off"), F.substring("text", 1, 64).alias("opening"))
    slim = with_row_id(flat, [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "opening", "digest"]).drop("opening")
    slim = cut_lineage(slim)
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min("row_id").alias("_first")).select(F.col("_first").alias("row_id"), F.lit(True).alias("first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut_off"), "truncated"))
    return slim.join(first, "row_id", "left").select("conv_id", "row_id", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def code_of(initial: Column, fault: Column) -> Column:
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), "X").when(fault == "truncated", F.upper(plain)).otherwise(plain)


def coded_blocks(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, block, n_blocks, codes, initials): up to ``block`` turns of one conversation each, blocks from 0."""
    first = coded.groupBy("conv_id").agg(F.min("row_id").alias("_first"), F.count("*").alias("_n"))
    first = first.select(F.col("conv_id").alias("_c"), "_first", F.ceil(F.col("_n") / block).cast("bigint").alias("n_blocks"))
    # every row meets one row of its conversation, so that a hot one's rows may be split among tasks
    placed = coded.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    row = F.struct("row_id", code_of(F.col("initial"), F.col("fault")).alias("code"), F.rpad("initial", 1, " ").alias("initial"))
    grouped = placed.groupBy("conv_id", "n_blocks", F.floor((F.col("row_id") - F.col("_first")) / block).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return grouped.select("conv_id", "block", "n_blocks", F.array_join("rows.code", "").alias("codes"), F.array_join("rows.initial", "").alias("initials"))


# ------------------------------------------------------------------ figures and fingerprints
def counts(coded: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated): aggregates that combine before they are shuffled."""
    number = lambda name: F.count_if(F.col("fault") == name).alias(name)
    per_turn = coded.groupBy("conv_id", "turn").agg(number("blank"), number("duplicate"), number("truncated"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return per_turn.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")])


_LEGAL = ("su", "ua", "au")


def illegal_pairs(blocks: DataFrame) -> DataFrame:
    """(conv_id, illegal): neighbours within blocks, and across each border through the blocks' first and last initials."""
    inside = F.size(F.filter(F.sequence(F.lit(1), F.length("initials")), lambda i: (i < F.length("initials")) & ~F.substring(F.col("initials"), i, F.lit(2)).isin(*_LEGAL)))
    # the border after block b is met by the last initial of b and the first of b + 1
    ends = blocks.select("conv_id", inside.cast("bigint").alias("inside"), F.explode(F.array(
        F.struct((F.col("block") - 1).alias("border"), F.lit(None).cast("string").alias("left"), F.substring("initials", 1, 1).alias("right"), F.lit(0).alias("counts")),
        F.struct(F.col("block").alias("border"), F.substring("initials", -1, 1).alias("left"), F.lit(None).cast("string").alias("right"), F.lit(1).alias("counts")))).alias("e"))
    borders = ends.groupBy("conv_id", "e.border").agg(F.max("e.left").alias("l"), F.max("e.right").alias("r"), F.sum(F.col("inside") * F.col("e.counts")).alias("inside"))
    broken = (F.col("l").isNotNull() & F.col("r").isNotNull() & ~F.concat("l", "r").isin(*_LEGAL)).cast("bigint")
    return borders.groupBy("conv_id").agg(F.sum(F.col("inside") + broken).alias("illegal"))


def fingerprints(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): rows and audits meet in one task per conversation, sorted, and are hashed as they stream by."""
    id_type = dict(turns.dtypes)["conv_id"]
    whole = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("digest"))
    rows = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.sha2("text", 256).alias("digest"))
    opening = F.substring("text", 1, 64)
    stream = whole.unionByName(rows).repartition("conv_id").withColumn("_o", F.when(F.col("kind") == 1, opening)).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "_o", "digest").select("conv_id", "kind", "role", "text")

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            done: list[tuple] = []
            ids = batch.column(0).to_pylist()
            kinds, roles, texts = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for conv, kind, role, text in zip(ids, kinds, roles, texts):
                if kind == 0:
                    if held:
                        done.append(held.close())
                    held = _Hash(conv, text)
                else:
                    held.add(role, text)
            yield _hash_batch(done, batch.schema.field(0).type)
        if held:
            yield _hash_batch([held.close()], batch.schema.field(0).type)

    return stream.mapInArrow(hash_lines, f"conv_id {id_type}, repaired_sha256 string")


def _hash_batch(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])


class _Hash:
    """The SHA-256 of a repaired conversation's lines, row by row along its audit."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.last = conv, audit, 0, ""
        self.sha, self.lines = hashlib.sha256(), 0

    def _line(self, initial: str, line: str) -> None:
        self.sha.update((line if not self.lines else "\n" + line).encode())
        self.lines, self.last = self.lines + 1, initial

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            expected = "a" if self.last == "u" else "u"
            self._line(expected, "user:" if expected == "u" else "assistant:")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role[0], f"{role}:{text}")
        elif edit == "R":
            expected = "a" if self.last == "u" else "u"
            self._line(expected, f"{'user' if expected == 'u' else 'assistant'}:{text}")

    def close(self) -> tuple:
        self._inserted()
        return self.conv, self.sha.hexdigest()


# ------------------------------------------------------------------ whole job
def repair_conversations(turns: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per id of ``ids``: figures, cheapest cost, audit and fingerprint of its (conv_id, turn, role, text) rows."""
    coded = cut_lineage(coded_turns(turns))
    blocks = cut_lineage(coded_blocks(coded, block))
    parts = block_audits(blocks)
    # an audit is one value of the result: its parts meet, sorted, in that row
    audits = cut_lineage(parts.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("_p")).select(
        "conv_id", "cost", F.array_join("_p.audit", "").alias("audit")))
    out = ids.select("conv_id").distinct()
    for figures in (counts(coded), illegal_pairs(blocks), audits, fingerprints(turns, audits)):
        out = _with(out, figures)
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    return out.select("conv_id", *[zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_conversations(damage(conversations), conversations)
