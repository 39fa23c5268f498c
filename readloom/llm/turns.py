"""Conversations repaired with the cheapest edits, and the least audit of those edits.

Rows of a conversation stand in the order of turn (null first), role, text. A row is
blank (no character but the six ASCII blanks), else a duplicate (role and text
stood before), else truncated (its last other character does not end a sentence).
Edits: Keep (0), Rerole to user or assistant (1), Delete (2; a must for blank and
duplicate rows), Insert an empty user or assistant row anywhere (5); a truncated
row that is not deleted costs 5 more. The initials of the roles that result match
``(s?(ua)+)?``. The audit is the initials of the edits in order; of the cheapest
ones the least in ASCII.

Graph. A node is a place between two rows and a state of that pattern: nothing
yet, after s, after u, after a. Arcs are edits; an Insert stays at its place. A
DP from the end gives each node its cost to go, and with it the optimal arcs. Each
letter leads from a node to one other node, so a node's least letter fixes where
it points. Then, by prefix doubling, nodes are ranked by their audits of length
1, 2, 4, ...: the rank for twice the length is that of the pair (own rank, rank of
the node pointed at), and pointers are doubled with them, until all have
reached an end. A start's audit is then read off through the doubled pointers: those of
the longest length give every so many-th node, each shorter one the nodes halfway.

Size. Conversations are cut into blocks of ``BLOCK_ROWS`` rows, one task row each, and
all nodes of many blocks are worked on at once. Blocks of a conversation with several are
joined by doubling too, as rows of Spark tables: min-plus products of what
a block costs from state to state give the cost to go at its end, and
compositions of the states its pointers lead to give the state in which it is entered. So a
conversation with a third of all rows is spread over tasks; only its audit and its
digest, one value each, are put together in one place (the digest as a stream).

Duplicates are found by counting digests (partial sums before the shuffle) and one join. Rows
are put in order by range and stored. Texts are moved three times: into ranges, to their edits, and
to the digest.

Nulls in role and text count as one blank; a null turn is a turn of its own, first; a
null id is a conversation of its own. Rows equal in every column stand side by side. An
empty role has an empty initial. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.shipping import ship
from readloom.session import broadcast_if_small, written

BLOCK_ROWS = 1024
PART_ROWS = 1 << 15
RANGE_CHARS = 64
BLANKS = " \t\n\v\f\r"
#: Costs of edits.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
NEVER = 1 << 60
#: Letters in ASCII order; 0 is the end.
END, D, I, K, R = range(5)
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
#: States 0 nothing yet, 1 after s, 2 after u, 3 after a. An added or changed row is user, or assistant after u.
ADDED = np.array([2, 2, 3, 2])
#: Where a kept row of kind other, s, u, a leads from each state; -1 nowhere.
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
#: Cost to go after the last row.
CLOSED = np.array([0, 2 * INSERT, INSERT, 0])


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with a known share of faults, chosen by the checksum of ``conv_id:turn``."""

    def said(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    part = F.pmod(F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")), F.lit(20))
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), part.alias("_part"))
    return rows.where("_part <> 0").select(
        "conv_id", "turn", F.when(F.col("_part") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_part") == 1, "").when(F.col("_part") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


# --- rows ---------------------------------------------------------------------


def ordered(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``range_no`` and ``row_no``, which rises in the order of conversation, turn, role and text."""
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        F.substring(F.coalesce("text", F.lit(" ")), 1, RANGE_CHARS).alias("_head"))
    dealt = plain.repartitionByRange(ranges, "conv_id", "turn", "role", "_head").sortWithinPartitions("conv_id", "turn", "role", "text")
    return written(dealt.drop("_head").withColumn("range_no", F.spark_partition_id()).withColumn("row_no", F.monotonically_increasing_id()), "turns")


def judged(lines: DataFrame) -> DataFrame:
    """``conv_id, turn, row_no, range_no, initial, fault``: the first fault of each row, or null."""
    tail = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    narrow = lines.select("conv_id", "turn", "row_no", "range_no", F.substring("role", 1, 1).alias("initial"), tail.alias("tail"),
                          F.md5(F.concat(F.md5(F.col("role").cast("binary")), F.md5(F.col("text").cast("binary")))).alias("said"))
    narrow = written(narrow, "turn-faults")
    again = narrow.where("tail <> ''").groupBy(F.col("conv_id").alias("_conv"), F.col("said").alias("_said")).agg(
        F.min("row_no").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    fault = (F.when(F.col("tail") == "", "blank").when(F.col("row_no") > F.col("first"), "duplicate")
             .when(~F.col("tail").isin(".", "!", "?"), "truncated"))
    return narrow.join(again, met, "left").select("conv_id", "turn", "row_no", "range_no", "initial", fault.alias("fault"))


def blocks_of(rows: DataFrame, block_rows: int) -> DataFrame:
    """One row per block of a conversation: its sums, the codes of its rows and their numbers, in order.

    A code is the kind of the role, 4 more where the row must go, 8 more where it is truncated.
    """
    last = F.max_by(F.struct("turn", "initial"), "row_no")
    totals = rows.groupBy("conv_id", "range_no").agg(F.count("*").alias("n"), last.alias("last"))
    earlier = Window.partitionBy("conv_id").orderBy("range_no")
    # a conversation that goes on in a range is the first of it: one row per range
    starts = totals.select(F.col("conv_id").alias("_conv"), F.col("range_no").alias("_range"), F.lag("last").over(earlier).alias("prior"),
                           F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("start")).where("start > 0")
    here = Window.partitionBy("conv_id", "range_no").orderBy("row_no")
    seen = rows.withColumn("place", F.row_number().over(here)).withColumn("before", F.lag(F.struct("turn", "initial")).over(here))
    met = (F.col("range_no") == F.col("_range")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    seen = seen.join(F.broadcast(starts), met, "left").withColumn("before", F.coalesce("before", "prior"))
    pair = F.concat("before.initial", "initial")
    kind = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(0)
    code = kind + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(F.col("fault") == "truncated", 8).otherwise(0)
    block = F.call_function("div", F.col("place") - 1 + F.coalesce("start", F.lit(0)), F.lit(block_rows))

    def count(name):
        return F.count_if(F.col("fault") == name).alias(name)

    listed = F.array_sort(F.collect_list(F.struct("row_no", code.cast("int").alias("code"))))
    grouped = seen.groupBy("conv_id", block.alias("block")).agg(
        count("blank"), count("duplicate"), count("truncated"), F.count_if(~pair.isin("su", "ua", "au")).alias("illegal"),
        F.min("turn").alias("least_turn"), F.max("turn").alias("greatest_turn"),
        F.count_if(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("before.turn"))).alias("turns"), listed.alias("listed"))
    return grouped.withColumn("codes", F.col("listed.code")).withColumn("rows", F.col("listed.row_no")).drop("listed")


# --- one block ----------------------------------------------------------------


class Graph:
    """The nodes of many blocks: row ``node_at[b] + i`` holds the four states before row ``i`` of block ``b``."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.codes, self.lengths = codes, lengths
        self.row_at = np.cumsum(lengths) - lengths
        self.node_at = self.row_at + np.arange(len(lengths))
        self.end_at = self.node_at + lengths

    def row_costs(self, codes: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs to go by deleting, keeping and changing the rows, from each state."""
        must, extra = (codes & 4 > 0)[:, None], np.where(codes & 8, CUT_OFF, 0)[:, None]
        to = KEPT[:, codes & 3].T
        keep = np.where(must | (to < 0), NEVER, extra + np.take_along_axis(following, np.maximum(to, 0), 1))
        change = np.where(must, NEVER, REROLE + extra + following[:, ADDED])
        return DELETE + following, np.minimum(keep, NEVER), np.minimum(change, NEVER)

    def costs(self, ends: np.ndarray) -> np.ndarray:
        """Cost to go of each node, from the costs after each block's last row."""
        out = np.full((len(self.codes) + len(self.lengths), 4), NEVER)
        out[self.end_at] = ends
        order = np.argsort(-self.lengths, kind="stable")
        longer = np.searchsorted(-self.lengths[order], -np.arange(1, self.lengths.max(initial=0) + 1), "right")
        for back, n in enumerate(longer.tolist()):
            b = order[:n]
            i = self.lengths[b] - 1 - back
            g = np.minimum.reduce(self.row_costs(self.codes[self.row_at[b] + i], out[self.node_at[b] + i + 1]))
            out[self.node_at[b] + i] = np.minimum.reduce([g, INSERT + g[:, ADDED], 2 * INSERT + g[:, ADDED[ADDED]], np.full(g.shape, NEVER)])
        return out

    def arcs(self, costs: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least letter of each node's optimal arcs, and the node it leads to (flat; ends lead to themselves)."""
        n = len(costs)
        letter, to = np.zeros((n, 4), np.int64), np.arange(4 * n).reshape(n, 4)
        rows = np.delete(np.arange(n), self.end_at)
        here, following = costs[rows], costs[rows + 1]
        delete, keep, _ = self.row_costs(self.codes, following)
        added, state, at = INSERT + here[:, ADDED], np.arange(4), rows[:, None] * 4
        chosen = [delete == here, added == here, keep == here]
        letter[rows] = np.select(chosen, [D, I, K], R)
        to[rows] = np.select(chosen, [at + 4 + state, at + ADDED, at + 4 + KEPT[:, self.codes & 3].T], at + 4 + ADDED)
        last = self.end_at[closed]
        for s in (1, 2):
            letter[last, s], to[last, s] = I, last * 4 + ADDED[s]
        return letter.ravel(), to.ravel()


def doubled(letter: np.ndarray, to: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Pointers over 1, 2, 4, ... edits, the last of which lead to ends; and the rank of each node's whole audit."""
    rank, levels = letter, [to]
    while True:
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[to], return_inverse=True)[1]
        further = to[to]
        if np.array_equal(further, to):
            return levels, rank
        levels.append(further)
        to = further


def path(levels: list[np.ndarray], letter: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that edits leave, from each start to its end, start after start; and how many each has."""
    n = np.zeros(len(letter), np.int64)
    n[letter != END] = 1
    for to in levels[:-1]:
        n = n + n[to]
    size = n[starts]
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.int64)
    out[at[size > 0]] = starts[size > 0]
    place = np.arange(len(out)) - np.repeat(at, size)
    left = np.repeat(size, size) - place  # edits from here on
    for k in reversed(range(len(levels))):
        some = np.flatnonzero((place % (2 << k) == 0) & (left > 1 << k))
        out[some + (1 << k)] = levels[k][out[some]]
    return out, size


def _parts(batch: pa.RecordBatch):
    """Slices of a batch of blocks with a bounded number of rows, and their graphs; a block is never cut."""
    lengths = np.diff(batch.column(batch.schema.get_field_index("codes")).offsets.to_numpy())
    low = 0
    while low < batch.num_rows:
        high = low + max(1, int(np.searchsorted(np.cumsum(lengths[low:]), PART_ROWS, "right")))
        part = batch.slice(low, high - low)
        codes = part.column(part.schema.get_field_index("codes")).flatten().to_numpy(zero_copy_only=False)
        yield part, Graph(codes, lengths[low:high].astype(np.int64))
        low = high


def _column(part: pa.RecordBatch, name: str) -> pa.Array:
    return part.column(part.schema.get_field_index(name))


def _ends(part: pa.RecordBatch) -> np.ndarray:
    return np.array([CLOSED if v is None else v for v in _column(part, "ends").to_pylist()], np.int64).reshape(-1, 4)


def _crossings(batches):
    """What each block costs from state to state, as 16 numbers; after the last block only state 0 counts."""
    for batch in batches:
        for part, graph in _parts(batch):
            last = _column(part, "is_last").to_numpy(zero_copy_only=False)
            out = np.empty((part.num_rows, 4, 4), np.int64)
            for s in range(4):
                ends = np.full((part.num_rows, 4), NEVER)
                ends[~last, s] = 0
                if s == 0:
                    ends[last] = CLOSED
                out[:, :, s] = graph.costs(ends)[graph.node_at]
            yield pa.RecordBatch.from_arrays(
                [_column(part, "conv_id"), _column(part, "block"), pa.array(list(out.reshape(-1, 16)), pa.list_(pa.int64()))],
                ["conv_id", "block", "m"])


def _passages(batches):
    """The state in which the least path leaves each block, for each state in which it may enter."""
    for batch in batches:
        for part, graph in _parts(batch):
            costs = graph.costs(_ends(part))
            letter, to = graph.arcs(costs, _column(part, "is_last").to_numpy(zero_copy_only=False))
            levels, _ = doubled(letter, to)
            out = levels[-1][graph.node_at[:, None] * 4 + np.arange(4)] % 4
            yield pa.RecordBatch.from_arrays(
                [_column(part, "conv_id"), _column(part, "block"), pa.array(list(out), pa.list_(pa.int64()))], ["conv_id", "block", "m"])


def _audits(batches):
    """Each block's cost to go, audit, and edits: place of the row (or null) and new role (0 stays, 2 user, 3 assistant, null gone)."""
    for batch in batches:
        for part, graph in _parts(batch):
            costs = graph.costs(_ends(part))
            letter, to = graph.arcs(costs, _column(part, "is_last").to_numpy(zero_copy_only=False))
            levels, _ = doubled(letter, to)
            starts = graph.node_at * 4 + _column(part, "entry").to_numpy(zero_copy_only=False)
            nodes, size = path(levels, letter, starts)
            edit, state = letter[nodes], nodes % 4
            role = np.where(edit == K, 0, ADDED[state])
            place = nodes // 4 - np.repeat(graph.node_at, size)
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            audit = pa.Array.from_buffers(pa.string(), part.num_rows, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(LETTERS[edit].tobytes())])
            at = pa.array(bounds)
            yield pa.RecordBatch.from_arrays(
                [_column(part, "conv_id"), _column(part, "block"), _column(part, "rows"), pa.array(costs.ravel()[starts]), audit,
                 pa.ListArray.from_arrays(at, pa.array(place, pa.int32(), mask=edit == I)),
                 pa.ListArray.from_arrays(at, pa.array(role, pa.int32(), mask=edit == D))],
                ["conv_id", "block", "rows", "to_go", "audit", "places", "roles"])


# --- blocks of one conversation -------------------------------------------------


def _joined(links: DataFrame, n_blocks: int, step: int, compose, label: str) -> DataFrame:
    """``conv_id, block, m`` with ``m`` composed over all blocks from the own one on (``step`` 1) or up to it (-1).

    Each round composes with what the block so many further on has gathered, and doubles that distance.
    """
    far = 1
    while far < n_blocks:
        other = links.select(F.col("conv_id").alias("_conv"), (F.col("block") - step * far).alias("_block"), F.col("m").alias("_m"))
        met = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
        m = F.when(F.col("_m").isNull(), F.col("m")).otherwise(compose(F.col("m"), F.col("_m")))
        links = written(links.join(other, met, "left").select("conv_id", "block", m.alias("m")), label)
        far *= 2
    return links


def _product(a: Column, b: Column) -> Column:
    """Min-plus product of two 4 x 4 tables."""

    def cell(i):
        row, column = F.call_function("div", i, F.lit(4)).cast("int") * 4, i % 4
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.least(F.get(a, row + k) + F.get(b, k * 4 + column), F.lit(NEVER))))

    return F.transform(F.sequence(F.lit(0), F.lit(15)), cell)


def _with_borders(blocks: DataFrame) -> DataFrame:
    """Adds ``is_last``, ``ends`` (costs to go after the block, null after the last) and ``entry`` (state before it)."""
    several = blocks.where("block > 0").groupBy(F.col("conv_id").alias("_conv")).agg(F.max("block").alias("top"))
    several = broadcast_if_small(several, "long-turns")
    most = (several.agg(F.max("top")).first()[0] or 0) + 1
    blocks = blocks.join(several, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("is_last", F.col("block") == F.coalesce("top", F.lit(0)))
    if most == 1:
        return blocks.withColumn("ends", F.lit(None).cast("array<long>")).withColumn("entry", F.lit(0)).drop("_conv", "top")
    of_id = blocks.schema["conv_id"].dataType.simpleString()
    parts = written(blocks.where("top is not null").select("conv_id", "block", "codes", "is_last"), "long-blocks")

    def shifted(links, by, value, name):
        return links.select(F.col("conv_id").alias("_c"), (F.col("block") + by).alias("_b"), value.alias(name))

    met = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
    schema = f"conv_id {of_id}, block long, m array<long>"
    crossings = _joined(written(parts.mapInArrow(_crossings, schema), "crossings"), most, 1, _product, "crossings")
    ends = shifted(crossings, -1, F.array(*[F.get("m", F.lit(4 * s)) for s in range(4)]), "ends")
    parts = written(parts.join(ends, met, "left").drop("_c", "_b"), "long-blocks")
    passages = _joined(written(parts.mapInArrow(_passages, schema), "passages"), most, -1,
                       lambda m, earlier: F.transform(earlier, lambda s: F.get(m, s.cast("int"))), "passages")
    entries = shifted(passages, 1, F.get("m", F.lit(0)).cast("int"), "entry")
    known = parts.join(entries, met, "left").select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "ends", F.coalesce("entry", F.lit(0)).alias("entry"))
    return blocks.join(known, met, "left").withColumn("entry", F.coalesce("entry", F.lit(0))).drop("_c", "_b", "_conv", "top")


# --- the operator ---------------------------------------------------------------


class Repair:
    """The tables of one repair, all stored under the shared folder.

    ``blocks``: sums per block. ``audits``: cost to go, audit and edits per block. ``lines``: the rows as numbered.
    """

    def __init__(self, rows: DataFrame, block_rows: int = BLOCK_ROWS, ranges: int | None = None):
        of_id = rows.schema["conv_id"].dataType.simpleString()
        self.lines = ordered(rows, ranges)
        self.blocks = written(blocks_of(judged(self.lines), block_rows), "turn-blocks")
        found = _with_borders(self.blocks.select("conv_id", "block", "codes", "rows")).mapInArrow(
            _audits, f"conv_id {of_id}, block long, rows array<long>, to_go long, audit string, places array<int>, roles array<int>")
        self.audits = written(found, "turn-audits")

    def edits(self) -> DataFrame:
        """``conv_id, block, step, letter, row_no, new_role``: one row per edit; rows kept as they are have no new role."""
        one = self.audits.select("conv_id", "block", "rows", "audit", F.posexplode(F.arrays_zip("places", "roles")).alias("step", "e"))
        role = F.when(F.col("e.roles") == 2, "user").when(F.col("e.roles") == 3, "assistant")
        return one.select("conv_id", "block", "step", F.substring("audit", F.col("step") + 1, F.lit(1)).alias("letter"),
                          F.get("rows", F.col("e.places")).alias("row_no"), role.alias("new_role"))

    def repaired(self) -> DataFrame:
        """``conv_id, block, step, role, text``: the repaired rows, in the order of ``block`` and ``step``."""
        kept = self.edits().where("letter <> 'D'")
        texts = self.lines.select(F.col("row_no").alias("_row"), F.col("role").alias("_role"), "text")
        return kept.join(texts, F.col("row_no") == F.col("_row"), "left").select(
            "conv_id", "block", "step", F.coalesce("new_role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha``: SHA-256 of a conversation's ``role:text`` lines, as they stream by; nothing is gathered."""
    of_id = repaired.schema["conv_id"].dataType.simpleString()

    def add(batches):
        import hashlib

        now, digest = None, None
        for batch in batches:
            ids, shas = [], []
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if digest is None or conv != now:
                    if digest is not None:
                        ids.append(now)
                        shas.append(digest.hexdigest())
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                for part in (role, ":", text):
                    digest.update(part.encode() if isinstance(part, str) else part.as_buffer())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(shas, pa.string())], ["conv_id", "sha"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([digest.hexdigest()], pa.string())], ["conv_id", "sha"])

    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "block", "step")
    return dealt.select("conv_id", "role", "text").mapInArrow(add, f"conv_id {of_id}, sha string")


def audit_table(rows: DataFrame, ids: DataFrame, block_rows: int = BLOCK_ROWS, ranges: int | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every id in ``ids``."""
    repair = Repair(rows, block_rows, ranges)
    sums = ["blank", "duplicate", "truncated", "illegal", "turns", "least_turn", "greatest_turn"]
    stats = repair.blocks.select("conv_id", *sums)
    edits = repair.audits.select("conv_id", F.when(F.col("block") == 0, F.col("to_go")).alias("cost"), F.struct("block", "audit").alias("part"))
    every = (stats.unionByName(edits, allowMissingColumns=True).unionByName(digests(repair.repaired()), allowMissingColumns=True)
             .unionByName(ids.select("conv_id"), allowMissingColumns=True))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).alias(c)

    found = every.groupBy("conv_id").agg(
        *map(total, ["blank", "duplicate", "truncated", "illegal", "cost"]), F.max("sha").alias("sha"), F.array_sort(F.collect_list("part")).alias("parts"),
        F.sum("turns").alias("turns"), F.min("least_turn").alias("low"), F.max("greatest_turn").alias("high"))
    # turns at both ends of 64 bits are further apart than 64 bits hold
    gaps = F.expr("try_cast(CAST(high AS DECIMAL(20,0)) - CAST(low AS DECIMAL(20,0)) + 1 - turns AS BIGINT)")
    return found.select("conv_id", F.when(F.col("low").isNull(), 0).otherwise(gaps).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                        F.array_join(F.col("parts.audit"), "").alias("audit"), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


ship(__name__)
