"""Conversation structure repair: cheapest edits by a cost programme, least audit by prefix-doubling ranks.

A conversation's rows are edited until their role initials read ``(s?(ua)+)?``.
Edits: Keep (0), Rerole to user or assistant (2), Delete (3; required for blank
and duplicate rows), Insert an empty user or assistant text (2); a truncated
row that stays adds 1. Of the cheapest edit lists the one whose initials (the
audit) are ASCII-least is taken.

1. Rows are put in order once (by range, so a conversation may lie in many
   tasks) and numbered; a row's fault and role initial make one code.
2. Codes are grouped in chunks of at most ``CHUNK_ROWS`` rows of a
   conversation. The state after a row is one of four (nothing yet, after s,
   after u, after a), so a chunk acts on costs as a 4 x 4 matrix of least
   sums. Only conversations of several chunks need the matrices: they are
   applied from the last chunk to the first, and give each chunk the least
   costs behind it.
3. With these costs, the cost programme of a chunk gives each node (row, state)
   its optimal arcs. Nodes are ranked by their least audits of 1, 2, 4, ...
   letters: a round ranks the pairs (rank, rank at the pointer) and doubles the
   pointers. Ranks choose the arc of each node; the doubled pointers give the
   state in which each chunk is left, and every place of the path at once.
4. Chunks of one conversation hand on their states in order, then each writes
   its edits.

So a conversation with a third of all rows is many chunks; what comes together
of it is one 128-byte summary for each ``CHUNK_ROWS`` rows. Only ``report``'s
digest goes through a conversation row by row in one task, as a hash over it
must, in a stream that holds one row batch.

Edge cases: null roles and texts are read as one space (so such a text is
blank); null conv_ids are one conversation; null turns come first. Rows of one
turn stand in order of a hash of role and text, so repeated rows are adjacent,
and rows equal in all are duplicates after the first. Texts of any length are
one value of a row. A conversation without rows repairs to nothing. An empty
table gives an empty table; extra columns are ignored. ``gaps`` is null where
the span of turns doesn't fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.packed import drop, stored

# The costs, the spaces, the ends of a whole text.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACES, ENDS = " \t\n\x0b\f\r", ".!?"

#: Rows of a chunk at most, and rows solved at once.
CHUNK_ROWS, STEP_ROWS = 4096, 1 << 17

LETTERS = np.array(list("DIKR"))
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Where an inserted or reroled row leads, and a kept
#: one by its initial (s, u, a, other); -1: not allowed. Costs behind a conversation's last row, by state.
NEXT = np.array([2, 2, 3, 2])
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
NEVER = np.int64(1 << 40)
BLANK, DUPLICATE, CUT = 1, 2, 3


# ------------------------------------------------------------------ the programme of many chunks at once

def _moves(code: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
    """Costs of Delete, Keep and Rerole of rows by state, given the costs ``after`` them, and Keep's targets."""
    fault = code >> 2
    stay = np.where((fault == BLANK) | (fault == DUPLICATE), NEVER, np.where(fault == CUT, TRUNCATED, 0))[:, None]
    to = KEPT[code & 3]
    keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1) + stay, NEVER)
    return after + DELETE, keep, after[:, NEXT] + stay + REROLE, to


def least_costs(code: np.ndarray, bounds: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least cost from every node: rows + 1 layers a chunk, four states each. ``end``: the costs behind each chunk."""
    n = np.diff(bounds)
    base = bounds[:-1] + np.arange(len(n))
    out = np.empty((len(code) + len(n), 4), np.int64)
    out[base + n] = end
    order = np.argsort(-n, kind="stable")
    for t in range(int(n.max(initial=0))):
        some = order[: np.searchsorted(-n[order], -t, "left")]  # chunks of more than t rows
        row = n[some] - 1 - t
        b = np.minimum.reduce(_moves(code[bounds[some] + row], out[base[some] + row + 1])[:3])
        user, reply = np.minimum(b[:, 2], b[:, 3] + INSERT), np.minimum(b[:, 3], b[:, 2] + INSERT)
        out[base[some] + row] = np.minimum(np.stack(
            [np.minimum(b[:, 0], user + INSERT), np.minimum(b[:, 1], user + INSERT), user, reply], 1), NEVER)
    return out


def optimal_arcs(code: np.ndarray, bounds: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The target node of each node's optimal arcs, by letter (D, I, K, R); -1 where there is none."""
    n = np.diff(bounds)
    layer = np.arange(len(code)) + np.repeat(np.arange(len(n)), n)  # of each row; a chunk's last layer has no row
    here = cost[layer]
    remove, keep, rerole, to = _moves(code, cost[layer + 1])
    state = np.arange(4)
    after = (layer + 1)[:, None] * 4
    arcs = np.full((len(cost) * 4, 4), -1, np.int64)
    at = (layer[:, None] * 4 + state).reshape(-1)
    arcs[at] = np.stack([
        np.where(remove == here, after + state, -1), np.where(here[:, NEXT] + INSERT == here, layer[:, None] * 4 + NEXT, -1),
        np.where((keep == here) & (to >= 0), after + to, -1), np.where(rerole == here, after + NEXT, -1)], axis=2).reshape(-1, 4)
    return arcs


class Paths:
    """Ranks of nodes by their least audits, and pointers doubled along them.

    ``hops[k]`` leads 2**k edits on, or to the end of the chunk. From one node
    no two optimal arcs bear the same letter, so each audit has one path.
    """

    def __init__(self, arcs: np.ndarray):
        letter = np.arange(arcs.shape[1])
        end = (arcs < 0).all(axis=1)
        node = np.arange(len(arcs))
        first = (arcs >= 0).argmax(axis=1)
        rank = np.where(end, 0, first + 1)  # by audits of one letter; the end comes before all letters
        hop, steps = np.where(end, node, arcs[node, first]), np.where(end, 0, 1)
        self.hops = [hop]
        while (steps[hop] > 0).any():
            _, rank = np.unique(rank * (rank.max() + 1) + rank[hop], return_inverse=True)
            steps, hop = steps + steps[hop], hop[hop]
            self.hops.append(hop)
        self.end, self.length = hop, steps
        key = np.where(arcs >= 0, letter * (rank.max(initial=0) + 1) + rank[arcs], np.iinfo(np.int64).max)
        self.letter = np.where(end, -1, key.argmin(axis=1))
        self.next = np.where(end, node, arcs[node, self.letter])

    def nodes(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the paths from ``start``, path by path, and each one's place on its path."""
        length = self.length[start]
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(start, length)
        for k, hop in enumerate(self.hops):
            on = (place >> k) & 1 == 1
            at[on] = hop[at[on]]
        return at, place


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a batch's chunks in a row, and their bounds."""
    bounds = np.asarray(batch.column("code").offsets).astype(np.int64)
    return batch.column("code").flatten().to_numpy().astype(np.int64), bounds - bounds[0]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same chunks in batches of ``STEP_ROWS`` rows and one chunk more at most."""
    for b in batches:
        bounds, at = _codes(b)[1], 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + STEP_ROWS, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's least costs from state to state, row by row."""
    for b in _few(batches):
        code, bounds = _codes(b)
        base = bounds[:-1] + np.arange(b.num_rows)
        sums = np.stack([least_costs(code, bounds, np.tile(np.where(np.arange(4) == s, 0, NEVER), (b.num_rows, 1)))[base]
                         for s in range(4)], axis=2).reshape(b.num_rows, 16)
        yield pa.RecordBatch.from_pydict({"conv_id": b.column("conv_id"), "seq": b.column("seq"),
                                          "sums": pa.array(list(sums), pa.list_(pa.int64()))})


def _costs_behind(group: pa.Table) -> pa.Table:
    """From the last chunk to the first: the least costs behind each."""
    group = group.sort_by("seq")
    end, out = END, []
    for sums in reversed(group.column("sums").to_pylist()):
        out.append(end)
        end = np.minimum((np.array(sums, np.int64).reshape(4, 4) + end).min(axis=1), NEVER)
    return group.select(["conv_id", "seq"]).append_column("end", pa.array(out[::-1], pa.list_(pa.int64())))


def _solved(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, Paths]:
    code, bounds = _codes(b)
    end = np.array([x or END for x in b.column("end").to_pylist()], np.int64).reshape(-1, 4)
    return code, bounds, end, Paths(optimal_arcs(code, bounds, least_costs(code, bounds, end)))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is left, by the state in which it is entered."""
    for b in _few(batches):
        _, bounds, _, paths = _solved(b)
        start = (bounds[:-1] + np.arange(b.num_rows))[:, None] * 4 + np.arange(4)
        yield pa.RecordBatch.from_pydict({"conv_id": b.column("conv_id"), "seq": b.column("seq"),
                                          "exits": pa.array(list(paths.end[start] % 4), pa.list_(pa.int64()))})


def _entries(group: pa.Table) -> pa.Table:
    group = group.sort_by("seq")
    state, out = 0, []
    for exits in group.column("exits").to_pylist():
        out.append(state)
        state = exits[state]
    return group.select(["conv_id", "seq"]).append_column("entry", pa.array(out, pa.int64()))


EDITS = "conv_id bigint, seq bigint, step bigint, edit string, pos bigint, new_role string, cost bigint"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each chunk, in order; a conversation's last chunk also ends it."""
    roles = np.array([None, None, "user", "assistant"], object)
    for b in _few(batches):
        code, bounds, _, paths = _solved(b)
        base = bounds[:-1] + np.arange(b.num_rows)
        start = base * 4 + b.column("entry").to_numpy()
        node, step = paths.nodes(start)
        chunk = np.repeat(np.arange(b.num_rows), paths.length[start])
        letter = LETTERS[paths.letter[node]]
        row = node // 4 - chunk  # chunks before have one layer more than rows
        inserted = letter == "I"
        cut = np.zeros(len(node), np.int64)
        cut[~inserted] = (code[row[~inserted]] >> 2 == CUT) & (letter[~inserted] != "D")
        cost = np.select([letter == "D", letter == "I", letter == "R"], [DELETE, INSERT, REROLE], 0) + cut * TRUNCATED
        pos = b.column("pos").flatten().to_numpy()
        place = np.where(inserted, 0, pos[np.where(inserted, 0, row)]) if len(pos) else np.zeros(len(node), np.int64)
        role = np.where(inserted | (letter == "R"), roles[paths.next[node] % 4], None)
        left = paths.end[start] % 4
        more = np.where(b.column("last").to_numpy(zero_copy_only=False), END[left] // INSERT, 0)
        tail = np.repeat(np.arange(b.num_rows), more)
        nth = np.arange(len(tail)) - np.repeat(np.cumsum(more) - more, more)
        which = np.concatenate([chunk, tail])
        yield pa.RecordBatch.from_pydict({
            "conv_id": b.column("conv_id").take(pa.array(which)), "seq": b.column("seq").take(pa.array(which)),
            "step": pa.array(np.concatenate([step, paths.length[start][tail] + nth]), pa.int64()),
            "edit": pa.array(np.concatenate([letter, np.full(len(tail), "I")]), pa.string()),
            "pos": pa.array(np.concatenate([place, np.zeros(len(tail), np.int64)]), pa.int64(),
                            mask=np.concatenate([inserted, np.ones(len(tail), bool)])),
            "new_role": pa.array(np.concatenate([role, np.where((left[tail] == 1) & (nth == 0), "user", "assistant")]), pa.string()),
            "cost": pa.array(np.concatenate([cost, np.full(len(tail), INSERT)]), pa.int64())})


# ------------------------------------------------------------------ the job

class Repair:
    """The repair of ``turns`` (conv_id, turn, role, text); ``drop()`` deletes its stored tables.

    ``rows``: the rows in order (``pos``) with null roles and texts as spaces.
    ``chunks``: their codes, ``CHUNK_ROWS`` or less of one conversation each.
    ``edits``: (``conv_id``, ``seq``, ``step``) in order, ``edit`` (D, I, K or R), the row's
    ``pos``, ``new_role`` of reroled and inserted rows, ``cost``.
    """

    def __init__(self, turns: DataFrame, chunk_rows: int = CHUNK_ROWS):
        space = F.lit(" ")
        self.rows = stored(
            turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
            .withColumn("tie", F.xxhash64("role", "text"))
            .repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie", "role", "text")
            .select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "turns")
        self.chunks = stored(_chunks(self.rows, chunk_rows), "chunks")
        self.edits = _all_edits(self.chunks)

    def repaired(self) -> DataFrame:
        """The repaired rows and the deleted ones: (``conv_id``, ``seq``, ``step``, ``edit``, ``role``, ``text``)."""
        place = ["conv_id", "seq", "step", "edit"]
        kept = self.edits.filter("edit <> 'I'").join(self.rows.select("pos", "role", "text"), "pos").select(
            *place, F.coalesce("new_role", "role").alias("role"), "text")
        added = self.edits.filter("edit = 'I'").select(*place, F.col("new_role").alias("role"), F.lit("").alias("text"))
        return kept.unionByName(added)

    def report(self) -> DataFrame:
        """One row for each conversation that has rows: faults, cost, audit and the digest of the repaired rows."""
        faults = self.chunks.select("conv_id", _count(BLANK).alias("blank"), _count(DUPLICATE).alias("duplicate"),
                                    _count(CUT).alias("truncated"), _illegal().alias("illegal"))
        turns = self.rows.filter("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.count("*")).groupBy("conv_id").agg(
            F.min("turn").alias("x"), F.max("turn").alias("y"), F.count("*").alias("n"))
        gaps = turns.select("conv_id", F.try_subtract(F.try_add(F.try_subtract("y", "x"), F.lit(1)), F.col("n")).alias("gaps"),
                            F.lit(True).alias("has_turns"))
        costs = self.edits.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
        facts = faults.unionByName(gaps, True).unionByName(costs, True).unionByName(self._digests(), True)
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        return facts.groupBy("conv_id").agg(
            F.when(F.max("has_turns"), F.sum("gaps")).otherwise(0).alias("gaps"),
            *map(total, ("blank", "duplicate", "truncated", "illegal", "cost")),
            F.max("audit").alias("audit"), F.max("repaired_sha256").alias("repaired_sha256"))

    def _digests(self) -> DataFrame:
        line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line")
        return (self.repaired().select("conv_id", "seq", "step", "edit", line)
                .repartition("conv_id").sortWithinPartitions("conv_id", "seq", "step")
                .mapInArrow(_digested, "conv_id bigint, audit string, repaired_sha256 string"))

    def drop(self) -> None:
        drop(self.rows, self.chunks, self.edits)


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Codes of rows (initial + 4 x fault) in chunks, with the conversation's initial before each, and whether it is the last."""
    whole = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    slim = rows.select(
        "conv_id", "pos", F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        F.when(whole == "", BLANK).when(F.instr(F.lit(ENDS), F.substring(whole, -1, 1)) == 0, CUT).otherwise(0).alias("fault"))
    firsts = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("x")).agg(F.min("pos").alias("pos")).select(
        "pos", F.lit(True).alias("new"))
    fault = F.when((F.col("fault") != BLANK) & F.col("new").isNull(), DUPLICATE).otherwise(F.col("fault"))
    code = F.struct("pos", (F.col("initial") + 4 * fault).cast("tinyint").alias("code"))
    chunks = slim.join(firsts, "pos", "left").groupBy("conv_id", F.expr(f"pos div {int(chunk_rows)}").alias("seq")).agg(
        F.array_sort(F.collect_list(code)).alias("x"))
    order = Window.partitionBy("conv_id").orderBy("seq")  # one short row a chunk
    ends = chunks.select("conv_id", "seq", F.col("x.pos").alias("pos"), F.col("x.code").alias("code"))
    return ends.withColumns({
        "before": F.lag(F.element_at("code", -1)).over(order).cast("int"), "first": F.lag("seq").over(order).isNull(),
        "last": F.lead("seq").over(order).isNull()})


def _count(fault: int):
    return F.size(F.filter("code", lambda x: F.shiftright(x, 2) == fault)).cast("long")


def _illegal():
    """Adjacent rows of a chunk, and of its first row and the one before, whose initials aren't su, ua or au."""
    initials = F.transform("code", lambda x: x.cast("int").bitwiseAND(3))
    known = F.when(F.col("before").isNull(), initials).otherwise(F.concat(F.array(F.col("before").bitwiseAND(3)), initials))
    n = F.size(known)
    pairs = F.zip_with(F.slice(known, 1, n - 1), F.slice(known, 2, n - 1), lambda x, y: x * 4 + y)
    return F.size(F.filter(pairs, lambda p: ~p.isin(0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))).cast("long")


def _all_edits(chunks: DataFrame) -> DataFrame:
    key = ["conv_id", "seq"]
    both = lambda x, y: F.expr(" AND ".join(f"{x}.{c} <=> {y}.{c}" for c in key))
    several = chunks.filter("NOT (first AND last)").select(*key, "code")
    behind = several.mapInArrow(_matrices, "conv_id bigint, seq bigint, sums array<bigint>").groupBy("conv_id").applyInArrow(
        _costs_behind, "conv_id bigint, seq bigint, end array<bigint>")
    behind = stored(behind, "ends")
    exits = several.alias("a").join(behind.alias("b"), both("a", "b")).select("a.*", "b.end").mapInArrow(
        _exits, "conv_id bigint, seq bigint, exits array<bigint>")
    entries = stored(exits.groupBy("conv_id").applyInArrow(_entries, "conv_id bigint, seq bigint, entry bigint"), "entries")
    whole = chunks.alias("a").join(behind.alias("b"), both("a", "b"), "left").join(entries.alias("c"), both("a", "c"), "left")
    out = stored(whole.select("a.conv_id", "a.seq", "a.pos", "a.code", "a.last", "b.end",
                              F.coalesce("c.entry", F.lit(0)).cast("long").alias("entry")).mapInArrow(_edits, EDITS), "edits")
    drop(behind, entries)
    return out


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation, from its rows in order; a row without a line is deleted."""
    now, audit, sha, written = None, None, None, False

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv_id": pa.array([now], pa.int64()), "audit": pa.array(["".join(audit)], pa.string()),
                                           "repaired_sha256": pa.array([sha.hexdigest()], pa.string())})

    for b in batches:
        for conv, edit, line in zip(*(b.column(c).to_pylist() for c in ("conv_id", "edit", "line"))):
            if audit is None or conv != now:
                if audit is not None:
                    yield made()
                now, audit, sha, written = conv, [], hashlib.sha256(), False
            audit.append(edit)
            if line is not None:
                sha.update(("\n" + line if written else line).encode())
                written = True
    if audit is not None:
        yield made()


def repair_report(turns: DataFrame, all_ids: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``Repair.report`` of ``turns`` for every conv_id of ``all_ids``, stored; those without rows have zeros and an empty audit."""
    work = Repair(turns, chunk_rows)
    ids = all_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("known", F.lit(True))
    facts = ids.unionByName(work.report(), True)
    zero = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    has_rows = F.max("repaired_sha256").isNotNull()
    out = stored(facts.groupBy("conv_id").agg(
        F.max("known").alias("known"), F.when(has_rows, F.max("gaps")).otherwise(0).alias("gaps"),
        *map(zero, ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    ).filter("known").drop("known"), "repairs")
    work.drop()
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults dealt by crc32(``conv_id:turn``) % 20: dropped, emptied, without ends, repeated, made a user's."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                        (F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                                             F.coalesce(F.col("turn").cast("string"), space))) % 20).alias("fate"))
    return rows.filter("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
        .alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
