"""Conversation structure repair: the cheapest edits that make turns alternate, told apart by path ranks.

A conversation's rows are read by turn (null turns first; ties by role, then text
hash). The role initials of a sound one read ``(s?(ua)+)?``. Edits are Keep (0),
Rerole to user or assistant (2), Delete (3; the only one for blank and repeated rows)
and Insert an empty user or assistant turn anywhere (2); truncated rows that stay cost
1 more. Of the cheapest edit lists the one with the least initials (ASCII) is taken.

The repair is a least path through nodes (place, state), for all conversations of a
slice at once, as numpy arrays:

1. *Cost DP*: the cost from each node to the end, from the last row back.
2. *Optimal arcs*: edits that lie on a cheapest path. Those of one node have different
   initials, as an initial and a state determine the state that follows.
3. *Prefix doubling*: nodes are ranked by the first 1, 2, 4, ... initials of their
   least audit; the rank of a doubled length is that of the pair of the node's rank
   and the rank of the node its doubled pointer leads to.
4. Of a node's arcs the one with the least (initial, rank behind it) is taken, and the
   nodes of the path are found by the doubled pointers, without walking.

Rows are sorted over range partitions, so nothing is grouped by conversation: a
conversation inside one partition is repaired there, within a slice. One that reaches
over an edge of its partition, or has more than ``PIECE`` rows, is cut into pieces
(at most ``PIECE`` rows); each gives the cheapest cost from every state to every
state. A stream over the pieces, which holds one piece's numbers at a time, carries
costs backward, then states forward, and the pieces are repaired by themselves. Only
the SHA-256 of a conversation has to see its pieces one after another.

Results for odd rows: null roles and texts are one space; rows of a null conversation
are one conversation; a role of another initial, or none, is never legal. Repeated
rows are duplicates. Texts of any length are read whole. A conversation without rows
(all dropped) has zeros, an empty audit and the hash of the empty text. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 20_000
SLICE_ROWS = 20_000
SLICE_BYTES = 8 << 20
FAR = 1 << 40
START, S, U, A = range(4)
STATES = 4
END, DELETE, INSERT, KEEP, REROLE = range(5)
LETTERS = np.frombuffer(b" DIKR", dtype=np.uint8)
ANSWER = np.array([U, U, A, U])  # the state a new or rerolled turn leads to
NOWHERE = -1
KEPT = np.full((4, STATES), NOWHERE)  # by initial (s, u, a, other) and state
KEPT[0, START] = S
KEPT[1, [START, S, A]] = U
KEPT[2, U] = A
SOUND = np.zeros((4, 4), dtype=bool)  # adjacent initials that are legal
SOUND[[0, 1, 2], [1, 2, 1]] = True
LAST = np.array([0, FAR, FAR, 0])  # what ending in a state costs
NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows damaged by ``crc32(conv_id:turn) % 20``.

    A dropped row stays with 0 ``copies``, so that its conversation is known.
    """
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    luck = F.crc32(F.concat(space["conv_id"], F.lit(":"), space["turn"])) % 20
    text = F.when(luck == 1, "").when(luck == 2, F.regexp_replace(space["text"], "[.!?]", "")).otherwise(space["text"])
    role = F.when(luck == 4, "user").otherwise(space["role"])
    copies = F.when(luck == 0, 0).when(luck == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


# ---- the repair of a slice


def relaxed(base: np.ndarray) -> np.ndarray:
    """Costs of nodes ``(..., state)`` once turns may be inserted before going on."""
    out = base.copy()
    out[..., U] = np.minimum(base[..., U], 2 + base[..., A])
    out[..., A] = np.minimum(base[..., A], 2 + base[..., U])
    for q in (START, S):
        out[..., q] = np.minimum(base[..., q], 2 + out[..., U])
    return out


def _arcs(after: np.ndarray, initial: np.ndarray, must: np.ndarray, cut: np.ndarray) -> dict[int, np.ndarray]:
    """Cost of each row edit from each state, given the costs after the row."""
    kept = KEPT[initial]
    keep = np.where(kept == NOWHERE, FAR, np.take_along_axis(after, np.maximum(kept, 0), 1) + cut[:, None])
    rerole = 2 + cut[:, None] + after[:, ANSWER]
    return {DELETE: 3 + after, KEEP: np.where(must[:, None], FAR, keep), REROLE: np.where(must[:, None], FAR, rerole)}


def costs(initial: np.ndarray, must: np.ndarray, cut: np.ndarray, bounds: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost to the end from every node: a line for each row and one for each end, conversation by conversation.

    ``after`` is what each conversation's end costs by state.
    """
    n = len(bounds) - 1
    out = np.empty((bounds[-1] + n, STATES), dtype=np.int64)
    out[bounds[1:] + np.arange(n)] = relaxed(after)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, size.max(initial=0) + 1), side="right")
    for back, many in enumerate(active, 1):
        conv = order[:many]
        row = bounds[conv + 1] - back
        line = row + conv
        best = np.minimum.reduce(list(_arcs(out[line + 1], initial[row], must[row], cut[row]).values()))
        out[line] = relaxed(np.minimum(best, FAR))
    return out


def least_paths(
    initial: np.ndarray, must: np.ndarray, cut: np.ndarray, bounds: np.ndarray, after: np.ndarray, entries: list[tuple[int, int]] | None = None
) -> tuple[np.ndarray, ...]:
    """The least audits from ``(conversation, state)`` entries, by default each conversation's start.

    ``(which entry, row, edit, state reached)`` in order, the cost of each entry, and
    the state each ends in.
    """
    n = len(bounds) - 1
    cost = costs(initial, must, cut, bounds, after)
    lines = len(cost)
    ends = bounds[1:] + np.arange(n)
    of_row = np.full(lines, NOWHERE)
    at = np.setdiff1d(np.arange(lines), ends, assume_unique=True)
    of_row[at] = np.arange(bounds[-1])
    # Optimal arcs in the order of their initials; an end that costs what is left goes first.
    goal = np.full((lines, STATES, 5), NOWHERE)
    state = np.arange(STATES)
    goal[ends, :, END] = np.where(cost[ends] == after, ends[:, None] * STATES + state, NOWHERE)
    inserted = 2 + cost[:, ANSWER] == cost
    goal[:, :, INSERT] = np.where(inserted, np.arange(lines)[:, None] * STATES + ANSWER, NOWHERE)
    edits = _arcs(cost[at + 1], initial, must, cut)
    to = {DELETE: np.broadcast_to(state, (len(at), STATES)), KEEP: np.maximum(KEPT[initial], 0), REROLE: np.broadcast_to(ANSWER, (len(at), STATES))}
    for edit, price in edits.items():
        goal[at, :, edit] = np.where((price == cost[at]) & (price < FAR), (at + 1)[:, None] * STATES + to[edit], NOWHERE)
    goal = goal.reshape(-1, 5)
    open_to = goal != NOWHERE
    nodes = np.arange(len(goal))
    first = np.argmax(open_to, axis=1)
    dead = ~open_to.any(axis=1)
    pointer = np.where(dead, nodes, goal[nodes, first])
    done = dead | (first == END)
    # Ranks by the first 1, 2, 4, ... initials of the least audit.
    rank = np.where(dead, 5, first)
    longest = 2 * int(np.diff(bounds).max(initial=0)) + 4
    jumps = [pointer]
    while 1 << len(jumps) <= longest:
        _, rank = np.unique(rank * (rank.max() + 1) + np.where(done, 0, rank[jumps[-1]]), return_inverse=True)
        jumps.append(jumps[-1][jumps[-1]])
    # The least arc by its initial and the rank of what follows it.
    weight = np.where(open_to, np.arange(5) * (rank.max() + 1) + rank[np.maximum(goal, 0)], np.iinfo(np.int64).max)
    taken = np.argmin(weight, axis=1)
    entries = [(i, START) for i in range(n)] if entries is None else entries
    convs = np.array([c for c, _ in entries], dtype=np.int64)
    begin = (bounds[convs] + convs) * STATES + np.array([q for _, q in entries], dtype=np.int64)
    which, on, dist = np.arange(len(begin)), begin, np.zeros(len(begin), dtype=np.int64)
    final = begin
    for jump in reversed(jumps):
        final = jump[final]
    live = ~done[on]
    which, on, dist = which[live], on[live], dist[live]
    for k in range(len(jumps) - 1, -1, -1):
        far = jumps[k][on]
        new = ~done[far]
        which, on, dist = np.append(which, which[new]), np.append(on, far[new]), np.append(dist, dist[new] + (1 << k))
    order = np.lexsort((dist, which))
    which, on = which[order], on[order]
    edit = taken[on]
    return which, of_row[on // STATES], edit, goal[on, edit] % STATES, cost.reshape(-1)[begin], final % STATES


# ---- what rows say


def initials(role: pa.Array) -> np.ndarray:
    head = pc.utf8_slice_codeunits(role, 0, 1)
    return np.asarray(pc.fill_null(pc.index_in(head, value_set=pa.array(["s", "u", "a"])), 3)).astype(np.int64)


def unsound(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Blank texts, and texts whose last other character is not one of ``.!?``."""
    solid = np.asarray(pc.match_substring_regex(text, r"[^\x20\x09-\x0D]"))
    ended = np.asarray(pc.match_substring_regex(text, r"[.!?][\x20\x09-\x0D]*\z"))
    return ~solid, solid & ~ended


def again(group: np.ndarray, role: pa.Array, text: pa.Array) -> np.ndarray:
    """Rows whose role and text stand earlier in the same group."""
    codes = [np.asarray(x.dictionary_encode().indices).astype(np.int64) for x in (role, text)]
    pair = np.unique(codes[0] * (len(role) + 1) + codes[1], return_inverse=True)[1]
    out = np.ones(len(role), dtype=bool)
    out[np.unique(group * (len(role) + 1) + pair, return_index=True)[1]] = False
    return out


def lines_of(role: pa.Array, text: pa.Array, row: np.ndarray, edit: np.ndarray, state: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The repaired lines, and which edits made them."""
    made = np.flatnonzero(edit != DELETE)
    row, edit, state = row[made], edit[made], state[made]
    own = pa.array(np.where(edit == INSERT, 0, row))
    names = pa.array(["user", "assistant"]).take(pa.array((state == A).astype(np.int64)))
    if not len(role):
        return pc.binary_join_element_wise(names, pa.array([""] * len(made), pa.string()), ":"), made
    role = pc.if_else(pa.array(edit == KEEP), role.take(own), names)
    text = pc.if_else(pa.array(edit == INSERT), "", text.take(own))
    return pc.binary_join_element_wise(role, text, ":"), made


def turns(turn: pa.Array, bounds: np.ndarray) -> list[tuple[int | None, int | None, int]]:
    """Least, greatest and number of distinct turns of each part; rows are in turn order, nulls first."""
    out = []
    known, value = np.asarray(turn.is_valid()), np.asarray(turn.fill_null(0)).astype(np.int64)
    fresh = np.concatenate([[0], np.cumsum(known[1:] & (~known[:-1] | (value[1:] != value[:-1])))]) if len(value) else np.zeros(1)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        a += b - a - int(known[a:b].sum())
        out.append((int(value[a]), int(value[b - 1]), int(fresh[b - 1] - fresh[a]) + 1) if b > a else (None, None, 0))
    return out


def plain(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def repaired(table: pa.Table) -> pa.RecordBatch:
    """Results of whole conversations, given their rows in order."""
    code = np.asarray(plain(table["conv"]).dictionary_encode(null_encoding="encode").indices)
    edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    copies = np.asarray(table["copies"]).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(copies)])
    bounds = before[np.append(edge, len(code))]
    rows = pa.array(np.repeat(np.arange(len(code)), copies))
    role, text, turn = (plain(table[c]).take(rows) for c in ("role", "text", "turn"))
    n = len(edge)
    group = np.repeat(np.arange(n), np.diff(bounds))
    initial = initials(role)
    blank, cut = unsound(text)
    double = again(group, role, text) & ~blank
    cut &= ~double
    pairs = ~SOUND[initial[:-1], initial[1:]] & (group[1:] == group[:-1])
    which, row, edit, state, cost, _ = least_paths(initial, blank | double, cut.astype(np.int64), bounds, np.broadcast_to(LAST, (n, STATES)))
    lines, made = lines_of(role, text, row, edit, state)
    letters, stop = LETTERS[edit].tobytes(), np.searchsorted(which, np.arange(n + 1))
    line_stop = np.searchsorted(which[made], np.arange(n + 1))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(line_stop, pa.int32()), lines.cast(pa.string())), "\n")
    spans = [hi - lo + 1 - d if d else 0 for lo, hi, d in turns(turn, bounds)]
    count = lambda x, of=group: np.bincount(of[x], minlength=n)
    numbers = [np.array(spans, np.int64), count(blank), count(double), count(cut), count(pairs, group[1:]), cost]
    return pa.RecordBatch.from_arrays(
        [
            plain(table["conv"]).take(pa.array(edge)),
            *(pa.array(x.astype(np.int64)) for x in numbers),
            pa.array([letters[a:b].decode() for a, b in zip(stop[:-1], stop[1:], strict=True)], pa.string()),
            pa.array([hashlib.sha256(x.as_buffer() if x.is_valid else b"").hexdigest() for x in joined], pa.string()),
        ],
        names=["conv", *NUMBERS, "audit", "repaired_sha256"],
    )


# ---- slices of sorted partitions

_OPEN = [("piece", pa.int64()), ("gid", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("again", pa.bool_())]
_DONE = [*((c, pa.int64()) for c in NUMBERS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_SCAN_SQL = "piece bigint, gid bigint, turn bigint, role string, text string, again boolean, " + "".join(f"{c} bigint, " for c in NUMBERS) + "audit string, repaired_sha256 string"


def _rows_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", kind), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int32())])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations inside the partition with their results, others as rows of pieces."""
    base, seen = TaskContext.get().partitionId() << 33, 0
    whole: list[pa.Table] = []  # conversations to repair in the next slice
    now: list[pa.Table] = []  # rows of the conversation that may go on
    known, conv, opened = False, None, False  # opened: it may have begun in another partition, or is long

    def shaped(batch: pa.RecordBatch, kind: pa.DataType) -> pa.RecordBatch:
        names = batch.schema.names
        fields = [("conv", kind), *_OPEN, *_DONE]
        return pa.RecordBatch.from_arrays(
            [batch.column(names.index(f)).cast(t) if f in names else pa.nulls(batch.num_rows, t) for f, t in fields], schema=pa.schema(fields)
        )

    def piece(parts: list[pa.Table]) -> pa.RecordBatch:
        nonlocal seen
        table = pa.concat_tables(parts).combine_chunks()
        copies = np.asarray(table["copies"]).astype(np.int64)
        gone = not copies.any()  # a piece without rows keeps one, of a null role
        rows = pa.array(np.repeat(np.arange(len(copies)), copies) if not gone else np.zeros(1, np.int64))
        table = table.take(rows).combine_chunks()
        role, text = (pa.nulls(1, pa.string()) if gone else plain(table[c]) for c in ("role", "text"))
        gid = base + seen + np.arange(len(rows))
        seen += len(rows)
        double = again(np.zeros(len(rows), np.int64), role, text)
        arrays = {"conv": plain(table["conv"]), "piece": pa.array(np.full(len(rows), gid[0])), "gid": pa.array(gid), "turn": plain(table["turn"])}
        arrays |= {"role": role, "text": text, "again": pa.array(double)}
        return shaped(pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays)), table.schema.field("conv").type)

    def closed() -> Iterator[pa.RecordBatch]:
        if whole:
            done = repaired(pa.concat_tables(whole))
            whole.clear()
            yield shaped(done, done.schema.field("conv").type)

    size = lambda parts: (sum(map(len, parts)), sum(x.nbytes for x in parts))
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).cast(_rows_schema(batch.schema.field("conv").type))
        code = np.asarray(plain(table["conv"]).dictionary_encode(null_encoding="encode").indices)
        edges = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
        runs = len(edges) - 1
        begin = 0
        if known and conv == table["conv"][0].as_py():
            now.append(table.slice(0, edges[1]))
            begin = 1
        if begin < runs:  # the conversation held has ended
            if known and opened:
                if now:
                    yield piece(now)
            else:
                whole += now
            opened = not known and runs == 1
            if not known and runs > 1:
                yield piece([table.slice(0, edges[1])])
                begin = 1
            between = table.slice(edges[begin], edges[-2] - edges[begin])
            if len(between):
                whole.append(between)
            now = [table.slice(edges[-2])]
            known, conv = True, now[0]["conv"][0].as_py()
        rows, held = size(now)
        if rows > PIECE // 2 or held > SLICE_BYTES:
            yield piece(now)
            now, opened = [], True
        rows, held = size(whole)
        if rows > SLICE_ROWS or held > SLICE_BYTES:
            yield from closed()
    yield from closed()
    if now:
        yield piece(now)


# ---- conversations in pieces


class Piece:
    """The rows of a piece in order, and what they are."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("gid").combine_chunks()
        self.conv, self.piece = table["conv"].slice(0, 1), table["piece"].slice(0, 1)
        self.all = table
        table = table.filter(pc.is_valid(table["role"])).combine_chunks()
        self.role, self.text, self.turn = (plain(table[c]) for c in ("role", "text", "turn"))
        self.initial = initials(self.role)
        self.blank, cut = unsound(self.text)
        self.double = np.asarray(plain(table["double"])).astype(bool) & ~self.blank
        self.cut = (cut & ~self.double).astype(np.int64)
        self.of = (self.initial, self.blank | self.double, self.cut, np.array([0, len(self.role)]))

    def row(self, **values: object) -> pa.Table:
        """One result row; the names say the types, lists are of long numbers."""
        kinds = {"audit": pa.string(), "lines": pa.string()}
        given = {k: pa.array([v], kinds.get(k, pa.list_(pa.int64()) if isinstance(v, list) else pa.int64())) for k, v in values.items()}
        return pa.table({"conv": self.conv, "piece": self.piece, **given})


_FACTS = ["low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "head", "tail"]


def _priced(table: pa.Table) -> pa.Table:
    """What a piece costs from every state to every state, and what it adds to the counts."""
    x = Piece(table)
    price = np.empty((STATES, STATES), dtype=np.int64)
    for q in range(STATES):
        after = np.full((1, STATES), FAR)
        after[0, q] = 0
        price[:, q] = costs(*x.of, after)[0]
    low, high, turns_ = turns(x.turn, x.of[3])[0]
    ends = (int(x.initial[0]), int(x.initial[-1])) if len(x.role) else (None, None)
    illegal = int((~SOUND[x.initial[:-1], x.initial[1:]]).sum())
    facts = [low, high, turns_, int(x.blank.sum()), int(x.double.sum()), int(x.cut.sum()), illegal, *ends]
    return x.row(price=price.reshape(-1).tolist(), **dict(zip(_FACTS, facts, strict=True)))


def _exits(table: pa.Table) -> pa.Table:
    """The state in which the least path leaves the piece, for each state it may come in with."""
    x = Piece(table)
    after = np.array([table["after"][0].as_py()], dtype=np.int64)
    *_, final = least_paths(*x.of, after, [(0, q) for q in range(STATES)])
    return x.row(exits=final.tolist())


def _replayed(table: pa.Table) -> pa.Table:
    """The audit and the repaired lines of a piece entered in a known state."""
    x = Piece(table)
    after = np.array([table["after"][0].as_py()], dtype=np.int64)
    _, row, edit, state, cost, _ = least_paths(*x.of, after, [(0, table["entry"][0].as_py())])
    lines, _ = lines_of(x.role, x.text, row, edit, state)
    return x.row(cost=int(cost[0]), audit=LETTERS[edit].tobytes().decode(), lines="\n".join(lines.to_pylist()) if len(lines) else None)


def _by_conversation(step: Callable, begin: Callable) -> Callable:
    """Runs ``state = step(row, state)`` over sorted rows, anew for each conversation, and yields what it yields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, conv, state = False, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if not known or row["conv"] != conv:
                    known, conv, state = True, row["conv"], begin()
                state, out = step(row, state)
                yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("piece", pa.int64()), *_CARRIED[step.__name__]]))

    return run


_CARRIED = {"_backward": [("after", pa.list_(pa.int64()))], "_forward": [("entry", pa.int64())]}


def _backward(row: dict, after: np.ndarray) -> tuple[np.ndarray, dict]:
    before = np.minimum((np.array(row["price"]).reshape(STATES, STATES) + after).min(axis=1), FAR)
    return before, {"piece": row["piece"], "after": after.tolist()}


def _forward(row: dict, entry: int) -> tuple[int, dict]:
    return row["exits"][entry], {"piece": row["piece"], "entry": entry}


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One result for the pieces of each conversation, which come in order."""

    def result(kind: pa.DataType) -> pa.RecordBatch:
        spans = high - low + 1 - many if many else 0
        out = {"conv": conv, "gaps": spans, **total, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
        return pa.RecordBatch.from_pylist([out], schema=pa.schema([("conv", kind), *_DONE]))

    known, conv, kind = False, None, None
    for batch in batches:
        kind = batch.schema.field("conv").type
        for row in batch.to_pylist():
            if not known or row["conv"] != conv:
                if known:
                    yield result(kind)
                known, conv = True, row["conv"]
                low, high, many, tail = None, None, 0, None
                total = dict.fromkeys(NUMBERS[1:], 0) | {"cost": row["cost"]}  # to the very end
                audit, digest, empty = [], hashlib.sha256(), True
            for c in ("blank", "duplicate", "truncated", "illegal"):
                total[c] += row[c]
            if row["head"] is not None:
                total["illegal"] += tail is not None and not SOUND[tail, row["head"]]
                tail = row["tail"]
            if row["turns"]:
                many += row["turns"] - (high == row["low"])
                low, high = row["low"] if low is None else low, row["high"]
            audit.append(row["audit"])
            if row["lines"] is not None:
                digest.update(("" if empty else "\n").encode() + row["lines"].encode())
                empty = False
    if known:
        yield result(kind)


def _joined(scan: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that are in pieces."""
    pieces = scan.where("piece IS NOT NULL").select("conv", "piece", "gid", "turn", "role", "text", "again")
    # Only rows that are the first of their kind in their piece are compared with other pieces.
    alike = pieces.where("NOT again AND role IS NOT NULL").groupBy("conv", "role", F.sha2("text", 256).alias("digest"))
    earliest = alike.agg(F.min("gid").alias("gid")).select("gid", F.lit(False).alias("double"))
    rows = pieces.join(earliest, "gid", "left").withColumn("double", F.coalesce("double", F.lit(True))).drop("again")
    rows = stored(rows, "pieces")
    facts = "".join(f", {c} bigint" for c in _FACTS)
    priced = stored(rows.groupBy("piece").applyInArrow(_priced, f"conv {kind}, piece bigint, price array<bigint>{facts}"), "prices")

    def carried(df: DataFrame, order: list, step: Callable, begin: Callable, schema: str) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(_by_conversation(step, begin), f"piece bigint, {schema}")

    after = carried(priced.select("conv", "piece", "price"), [F.desc("piece")], _backward, LAST.copy, "after array<bigint>")
    rows = rows.join(stored(after, "after"), "piece")
    exits = rows.groupBy("piece").applyInArrow(_exits, f"conv {kind}, piece bigint, exits array<bigint>")
    entry = carried(exits, ["piece"], _forward, lambda: START, "entry bigint")
    replayed = rows.join(stored(entry, "entry"), "piece").groupBy("piece")
    replayed = replayed.applyInArrow(_replayed, f"conv {kind}, piece bigint, cost bigint, audit string, lines string")
    told = replayed.join(priced.drop("conv", "price"), "piece").repartition("conv").sortWithinPartitions("conv", "piece")
    return told.mapInArrow(_gathered, f"conv {kind}, " + "".join(f"{c} bigint, " for c in NUMBERS) + "audit string, repaired_sha256 string")


def report(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of each conversation.

    ``rows`` has ``(conv_id, turn, role, text)`` and may have ``copies``, how often a row stands.
    """
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    kind = rows.schema["conv_id"].dataType.simpleString()
    space = {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")}
    read = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), space["role"].alias("role"), space["text"].alias("text"),
        copies.alias("copies"), F.xxhash64(space["text"]).alias("mark"), F.monotonically_increasing_id().alias("rid"),
    )
    order = ["conv", "turn", "role", "mark", "rid"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = read.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("mark", "rid")
    scan = stored(ranged.mapInArrow(_scanned, f"conv {kind}, {_SCAN_SQL}"), "scan")
    names = ["conv", *NUMBERS, "audit", "repaired_sha256"]
    found = scan.where("piece IS NULL").select(*names).unionByName(_joined(scan, kind))
    return found.withColumnRenamed("conv", "conv_id")
