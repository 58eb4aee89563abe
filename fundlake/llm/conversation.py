"""Conversation structure repair: the cheapest edits that make turns alternate, least audit first.

A conversation's rows, by turn, must have role initials ``(s?(ua)+)?``.  Edits
are Keep (0), Rerole to user or assistant (1), Delete (2; the only one for a
blank or repeated row) and Insert of an empty user or assistant turn (5); a
truncated row that stays adds 5.  The audit is the edits' initials in order;
of all cheapest ones the least in ASCII order is taken.

1. Cost DP: a node is a place between rows and a state (nothing yet, system,
   user, assistant last).  From the last place back, every node gets the cost
   to go; arcs that reach it are optimal.
2. Prefix-doubling path ranking: each node has the rank of its least audit of 1
   letter, and a pointer to where that leads; pairs of ranks (own, pointer's)
   rank audits of 2, 4, 8, ... letters, while pointers double.  Ranks choose
   between optimal arcs, and the doubled pointers list the least path's nodes.
   A node's arcs have different letters, so no two audits from one node tie.

All of it runs on arrays over many conversations at once.  A conversation of
more than ``BLOCK`` rows is cut: each block first gives its 4 x 4 matrix of costs
from state to state, a scan over a conversation's blocks (one small row each,
streamed) gives the costs to go at every block's end, and a block's least paths
from each of the four states are then found alone.  Only (conversation, place,
one byte) goes through these steps; texts are shuffled once, for the digest of
the repaired text, which is one sequential pass per conversation over sorted,
streamed rows.

Defined cases: null roles and texts are one space, null ids and turns too in the
damage key; null conv_ids are one conversation; null turns come first; rows of one
turn go by role, then by a digest of role and text; roles are known by their first
letter (s, u, a), others can only be reroled or deleted; a conversation without
rows left has zeros, an empty audit and the digest of the empty string; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_column, importable, staged
from .order import group_key, numbered, placed

#: Rows of a conversation that are repaired at once.
BLOCK = 1 << 16

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, system last, user last, assistant last.
STATES = 4
_NONE, _SYSTEM, _USER, _ASSISTANT = range(STATES)
_OPEN = 1 << 40
#: Row codes: 3 * (s, u, a, other) + (sound, must go, truncated).
SOUND, MUST_GO, CUT = range(3)
#: Costs to go where a conversation ends; inserts may still follow there.
_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
_AFTER_INSERT = np.array([_USER, _USER, _ASSISTANT, _USER])
_LETTERS = "DIKR"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(cost, next state) of every (code, state, letter); inserts stay at their place."""
    cost = np.full((12, STATES, 4), _OPEN, np.int64)
    after = np.zeros((12, STATES, 4), np.int64)
    reach = {_SYSTEM: (_NONE,), _USER: (_NONE, _SYSTEM, _ASSISTANT), _ASSISTANT: (_USER,)}
    for code in range(12):
        own, fault = code // 3 + 1, code % 3
        more = TRUNCATED if fault == CUT else 0
        for state in range(STATES):
            cost[code, state, 0], after[code, state, 0] = DELETE, state
            cost[code, state, 1], after[code, state, 1] = INSERT, _AFTER_INSERT[state]
            if fault == MUST_GO:
                continue
            if own <= 3 and state in reach[own]:
                cost[code, state, 2], after[code, state, 2] = KEEP + more, own
            for role in (_USER, _ASSISTANT):
                if state in reach[role]:
                    cost[code, state, 3], after[code, state, 3] = REROLE + more, role
    return cost, after


_COST, _AFTER = _tables()


def costs_to_go(codes: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cost to go at every place: conversation i has rows begin[i]:begin[i+1] and places from begin[i] + i on; ``ends`` are the last places' costs."""
    lengths = np.diff(begin)
    out = np.empty((len(codes) + len(lengths), STATES), np.int64)
    longest = np.argsort(-lengths, kind="stable")
    out[begin[1:] + np.arange(len(lengths))] = ends
    live = len(lengths)
    for back in range(1, int(lengths.max(initial=0)) + 1):
        while live and lengths[longest[live - 1]] < back:
            live -= 1
        at = longest[:live]
        row = begin[at + 1] - back
        ahead = out[row + at + 1]
        code = codes[row]
        best = DELETE + ahead
        for letter in (2, 3):
            best = np.minimum(best, _COST[code, :, letter] + np.take_along_axis(ahead, _AFTER[code, :, letter], 1))
        user, assistant = np.minimum(best[:, _USER], INSERT + best[:, _ASSISTANT]), np.minimum(best[:, _ASSISTANT], INSERT + best[:, _USER])
        out[row + at] = np.stack([np.minimum(best[:, _NONE], INSERT + user), np.minimum(best[:, _SYSTEM], INSERT + user), user, assistant], axis=1)
    return out


def _arcs(codes: np.ndarray, begin: np.ndarray, go: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letter, target) of each node's optimal arcs as (nodes, 4) arrays, -1 where there is none; ``closed`` conversations end at their last place."""
    lengths = np.diff(begin)
    places, last = len(go), begin[1:] + np.arange(len(lengths))
    is_last = np.zeros(places, bool)
    is_last[last] = True
    code = np.zeros(places, np.int64)
    code[~is_last] = codes
    target = np.empty((places, STATES, 4), np.int64)
    good = np.zeros((places, STATES, 4), bool)
    inner = ~is_last
    for letter in range(4):
        state = _AFTER[code, :, letter]
        place = np.arange(places)[:, None] + (letter != 1)
        target[:, :, letter] = np.minimum(place, places - 1) * STATES + state
        ahead = go.ravel()[target[:, :, letter]]
        good[:, :, letter] = (_COST[code, :, letter] + ahead == go) & (go < _OPEN) & (inner[:, None] if letter != 1 else True)
    # at a last place only inserts may follow, and only where the conversation itself ends
    good[last[~closed]] = False
    good[last[closed]] &= (_END > 0)[None, :, None]
    return good.reshape(-1, 4), target.reshape(-1, 4)


def rank_paths(good: np.ndarray, target: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Ranks nodes by their least audits of 1, 2, 4, ... letters.

    (pointers after 1, 2, 4, ... letters; letter of each node's least arc, -1
    where its path ends; rank).  Pointers end in nodes without arcs.
    """
    nodes = np.arange(len(good))
    ends = ~good.any(axis=1)
    rank = np.where(ends, 0, 1 + good.argmax(axis=1))
    # the least arc by (letter, rank of its head); a node's letters differ, so the letter decides
    keys = np.where(good, np.arange(4) * (int(rank.max(initial=0)) + 1) + rank[target], np.iinfo(np.int64).max)
    letter = np.where(ends, -1, keys.argmin(axis=1))
    pointers = [np.where(ends, nodes, target[nodes, np.maximum(letter, 0)])]
    while not ends[pointers[-1][starts]].all():
        step = pointers[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[step], return_inverse=True)[1]
        pointers.append(step[step])
    return pointers, letter, rank


def least_paths(codes: np.ndarray, begin: np.ndarray, ends: np.ndarray, closed: np.ndarray,
                entry: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(cost, least audit, state at the end) of each conversation's cheapest repair from state ``entry``."""
    go = costs_to_go(codes, begin, ends)
    good, target = _arcs(codes, begin, go, closed)
    first = begin[:-1] + np.arange(len(entry))
    starts = first * STATES + entry
    pointers, letter, _ = rank_paths(good, target, starts)
    # path lengths: as many letters as the pointers can go before the end, by their binary digits
    steps, node = np.zeros(len(starts), np.int64), starts.copy()
    done = letter < 0
    for k in range(len(pointers) - 1, -1, -1):
        ahead = pointers[k][node]
        far = ~done[ahead]
        steps[far] += 1 << k
        node[far] = ahead[far]
    steps += ~done[node]
    final = np.where(done[node], node, pointers[0][node])
    at = np.concatenate([[0], np.cumsum(steps)])
    distance = np.arange(at[-1]) - np.repeat(at[:-1], steps)
    visited = np.repeat(starts, steps)
    for k, pointer in enumerate(pointers):
        move = (distance >> k) & 1 == 1
        visited[move] = pointer[visited[move]]
    text = np.frombuffer(_LETTERS.encode(), np.uint8)[letter[visited]].tobytes().decode()
    return go[first, entry], [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], final % STATES


def cost_matrices(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(conversations, state, state): the least cost from a state before each block's rows to one after them."""
    first = begin[:-1] + np.arange(len(begin) - 1)
    out = []
    for state in range(STATES):
        ends = np.full((len(first), STATES), _OPEN, np.int64)
        ends[:, state] = 0
        out.append(costs_to_go(codes, begin, ends)[first])
    return np.minimum(np.stack(out, axis=2), _OPEN)


def damaged(rows: DataFrame) -> DataFrame:
    """(g, conv_id, turn, role, text, gone) of the rows after the contract's damage; dropped ones are ``gone``."""
    conv, turn = as_column("conv_id").cast("long"), as_column("turn").cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(as_column(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    own = rows.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    return own.select(
        group_key(F.col("conv_id")).alias("g"), "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 0, F.array(F.lit(True))).when(F.col("kind") == 3, F.array(F.lit(False), F.lit(False)))
                  .otherwise(F.array(F.lit(False)))).alias("gone"))


#: What is left of a text without the six kinds of white space at its end.
_TRIMMED = "trim(TRAILING char(32) || char(9) || char(10) || char(11) || char(12) || char(13) FROM text)"


def _signed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, a digest of role and text that also orders rows of one turn."""
    return rows.withColumn("key", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))


def _ordered_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows dealt by (g, block) and sorted, so that a block's rows follow each other in one task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.withColumn("block", F.expr(f"pos div {block}"))
    return cut.repartition(n, "g", "block").sortWithinPartitions("g", "block", "pos")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, begin of each run of equal keys): runs that span batches are put together."""
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])]).combine_chunks()
        begin = _begins(table, keys)
        if len(begin) > 1:
            yield table.slice(0, int(begin[-1])), begin
        kept = table.slice(int(begin[-1])) if len(table) else None
    if kept is not None and len(kept):
        yield kept, np.array([0, len(kept)])


def _begins(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.ones(len(table), bool)
    if len(table) > 1:
        new[1:] = False
        for k in keys:
            column = table[k].combine_chunks()
            values = column.dictionary_encode().indices.to_numpy(zero_copy_only=False) if pa.types.is_string(column.type) else column.to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _whole(begin: np.ndarray, rows: int) -> np.ndarray:
    return begin if begin[-1] == rows else np.append(begin, rows)


def _block_ends(codes: DataFrame, block: int) -> DataFrame | None:
    """(g, block, ends): the costs to go behind each block of the conversations that have several; None if none has."""
    long = codes.where(F.col("n") > block)
    if long.isEmpty():
        return None

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in _runs(batches, ["g", "block"]):
            begin = _whole(begin, len(rows))
            found = cost_matrices(rows["code"].to_numpy().astype(np.int64), begin)
            at = pa.array(begin[:-1])
            yield pa.RecordBatch.from_arrays([rows["g"].combine_chunks().take(at), rows["block"].combine_chunks().take(at), rows["n"].combine_chunks().take(at),
                                              pa.array(found.reshape(len(found), -1).tolist(), pa.list_(pa.int64()))], names=["g", "block", "n", "costs"])

    each = staged(_ordered_blocks(long, block).select("g", "block", "n", "code").mapInArrow(matrices, "g string, block long, n long, costs array<long>"), "turns-matrices")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, ends = None, _END
        for batch in batches:
            out = []
            for own, costs in zip(batch["g"].to_pylist(), batch["costs"].to_pylist(), strict=True):
                if own != g:
                    g, ends = own, _END
                out.append(ends.tolist())
                ends = (np.array(costs).reshape(STATES, STATES) + ends[None, :]).min(axis=1)
            yield pa.RecordBatch.from_arrays([batch["g"], batch["block"], pa.array(out, pa.list_(pa.int64()))], names=["g", "block", "ends"])

    n = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    back = each.repartition(n, "g").sortWithinPartitions("g", F.col("block").desc()).select("g", "block", "costs")
    return staged(back.mapInArrow(scan, "g string, block long, ends array<long>"), "turns-ends")


_PIECES = "g string, block long, cost long, duplicates long, truncated long, audits array<string>, exits array<int>"


def _pieces(codes: DataFrame, block: int) -> DataFrame:
    """Of each block the cost from its first state, its repeated and truncated rows, and from each state the least audit and the state behind it."""
    ends = _block_ends(codes, block)
    rows = _ordered_blocks(codes, block)
    if ends is None:
        rows = rows.withColumn("ends", F.lit(None).cast("array<long>"))
    else:
        rows = _ordered_blocks(codes.withColumn("block", F.expr(f"pos div {block}")).join(ends, ["g", "block"], "left").drop("block"), block)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in _runs(batches, ["g", "block"]):
            begin = _whole(begin, len(rows))
            at, n_runs = begin[:-1], len(begin) - 1
            code = rows["code"].to_numpy().astype(np.int64)
            number, size = rows["block"].to_numpy()[at], rows["n"].to_numpy()[at]
            closed = (number + 1) * block >= size
            given = rows["ends"].combine_chunks().take(pa.array(at)).to_pylist()
            ends = np.array([_END if e is None else e for e in given], np.int64)
            several = size > block
            results = [least_paths(code, begin, ends, closed, np.full(n_runs, state)) for state in (range(STATES) if several.any() else (_NONE,))]
            many = [range(STATES) if s else (_NONE,) for s in several.tolist()]
            duplicates = np.add.reduceat(rows["duplicate"].to_numpy().astype(np.int64), at)
            truncated = np.add.reduceat((code % 3 == CUT).astype(np.int64), at)
            yield pa.RecordBatch.from_arrays(
                [rows["g"].combine_chunks().take(pa.array(at)), pa.array(number), pa.array(results[0][0]), pa.array(duplicates), pa.array(truncated),
                 pa.array([[results[s][1][i] for s in states] for i, states in enumerate(many)], pa.list_(pa.string())),
                 pa.array([[int(results[s][2][i]) for s in states] for i, states in enumerate(many)], pa.list_(pa.int32()))],
                names=["g", "block", "cost", "duplicates", "truncated", "audits", "exits"])

    return rows.select("g", "block", "n", "code", "duplicate", "ends").mapInArrow(repair, _PIECES)


class _Conversation:
    """What the last pass keeps of the conversation it is in."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.state, self.cost, self.duplicates, self.pieces = conv_id, _NONE, None, 0, []
        self.audit, self.at = None, 0
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.truncated = self.illegal = 0
        self.before, self.role, self.digest, self.any = None, _NONE, sha256(), False

    def piece(self, cost: int, duplicates: int, truncated: int, audits: list[str], exits: list[int]) -> None:
        if self.cost is None:
            self.cost = cost
        self.pieces.append(audits[self.state if len(audits) > 1 else 0])
        self.state = exits[self.state if len(exits) > 1 else 0]
        self.duplicates += duplicates
        self.truncated += truncated

    def _say(self, role: str, text: str) -> None:
        if self.any:
            self.digest.update(b"\n")
        self.any = True
        self.digest.update(f"{role}:{text}".encode())
        self.role = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._say("assistant" if self.role == _USER else "user", "")

    def row(self, turn: int | None, role: str, text: str, blank: bool) -> None:
        if self.audit is None:
            self.audit = "".join(self.pieces)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.high = self.turn = turn
        self.blank += blank
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._say(role, text)
        elif edit == "R":
            self._say("assistant" if self.role == _USER else "user", text)

    def result(self) -> tuple:
        self.audit = "".join(self.pieces) if self.audit is None else self.audit
        self._inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicates, self.truncated, self.illegal, self.cost or 0, self.audit, self.digest.hexdigest())


_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose marker, pieces and rows follow each other."""
    names = [f.split()[0] for f in _RESULT.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in _RESULT.split(", ")]
    g, now = None, None
    for batch in batches:
        out = []
        for own, kind, conv_id, cost, duplicates, truncated, audits, exits, turn, role, text, blank in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own != g:
                if now is not None:
                    out.append(now.result())
                g, now = own, _Conversation(conv_id)
            if kind == 1:
                now.piece(cost, duplicates, truncated, audits, exits)
            elif kind == 2:
                now.row(turn, role, text, blank)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(now.result(), kinds, strict=True)], names=names)


def repaired(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The structure and cheapest repair of every conversation of ``rows`` (g, conv_id, turn, role, text, gone)."""
    importable(rows.sparkSession)
    trimmed = F.expr(_TRIMMED)
    own = _signed(rows.where("not gone")).withColumn("trimmed", trimmed).withColumn("blank", F.length("trimmed") == 0)
    own = own.withColumn("cut", ~F.col("blank") & ~F.substring("trimmed", -1, 1).isin(".", "!", "?")).drop("trimmed")
    initial = F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")
    narrow = staged(numbered(own.select("g", "turn", "role", "key", "blank", "cut", initial.alias("initial"))), "turns-narrow")
    in_order = staged(placed(narrow, "g", ["turn", "role", "key", "row"], "turns").drop("role", "turn", "row"), "turns-placed")
    first = in_order.where("not blank").groupBy("g", "key").agg(F.min("pos").alias("first"))
    duplicate = F.coalesce(~F.col("blank") & (F.col("pos") > F.col("first")), F.lit(False))
    codes = (in_order.join(first, ["g", "key"], "left").withColumn("duplicate", duplicate)
             .withColumn("code", (3 * F.col("initial") + F.when(F.col("blank") | F.col("duplicate"), MUST_GO).when(F.col("cut"), CUT).otherwise(SOUND)).cast("tinyint"))
             .select("g", "pos", "n", "duplicate", "code"))
    codes = staged(codes, "turns-codes")
    pieces = staged(_pieces(codes, block), "turns-pieces")

    nothing = {"conv_id": "long", "block": "long", "cost": "long", "duplicates": "long", "truncated": "long", "audits": "array<string>", "exits": "array<int>", "turn": "long",
               "role": "string", "text": "string", "key": "binary", "blank": "boolean"}

    def filled(part: DataFrame, kind: int) -> DataFrame:
        return part.select("g", F.lit(kind).alias("kind"), *[F.col(c) if c in part.columns else F.lit(None).cast(t).alias(c) for c, t in nothing.items()])

    every = filled(rows.select("g", "conv_id").distinct(), 0).unionByName(filled(pieces, 1)).unionByName(filled(own, 2))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = every.repartition(n, "g").sortWithinPartitions("g", "kind", "block", F.col("turn").asc_nulls_first(), "role", "key")
    columns = ["g", "kind", "conv_id", "cost", "duplicates", "truncated", "audits", "exits", "turn", "role", "text", "blank"]
    return dealt.select(*columns).mapInArrow(_finish, _RESULT)


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The contract's query: damage ``rows`` (conv_id, turn, role, text), then repair every conversation."""
    return repaired(damaged(rows), block)
