"""Cheapest repair of the turn structure of conversations.

A conversation is repaired if the first letters of its roles are none, or ``ua`` once or more,
perhaps after one ``s``. Rows may be kept (K), given the role user or assistant (R, 1), deleted
(D, 2) or inserted (I, 5); what is blank or a duplicate has to go, and a truncated row that
stays costs 5. Of the cheapest edit lists the one that sorts first is taken.

Cost DP: a node is a place between rows and what was said last (nothing, s, u, a); its cost is
that of the cheapest way from there to the end. Arcs on cheapest ways are the optimal ones.
Path ranking: the optimal arcs of a node are ranked by the next letter of the audit, then by
two, four, eight letters and so on. A level pairs what the level below left, keeps a node's
least pairs and numbers them densely; with them the pointers double. The bits of a place in
the audit then tell which pointers lead to its node.

Rows are sorted over the cluster and cut in chunks of 4096, so no conversation, however long,
has to fit in a task: chunks give small cost matrices, which are combined for conversations
that lie in several chunks, and each chunk ranks its own part for every state in which it may
be entered. The last pass reads a conversation's rows in order and holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import written

SPACE = r"\x20\x09-\x0D"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Rows of a chunk, as a power of two.
CHUNK_BITS = 12
#: Costs: deletion, other role, insertion, a truncated row that stays.
DELETE, REROLE, INSERT, STUMP = 2, 1, 5, 5
FAR = 1 << 40
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: What is said next when a role may be chosen.
NEXT = (USER, USER, ASSISTANT, USER)
#: What a kept row of each kind (other, s, u, a) makes of each state; -1: not allowed.
KEPT = ((-1, -1, -1, -1), (SYSTEM, -1, -1, -1), (USER, USER, -1, USER), (-1, -1, ASSISTANT, -1))
LETTERS = "-DIKR"
#: Costs from each state when no rows are left.
ENDED = (0, 2 * INSERT, INSERT, 0)


def costs_to_go(kinds: list[int], faults: list[int], after: tuple) -> np.ndarray:
    """Cheapest cost from each place and state, given the costs behind the last row."""
    out = [after]
    e, s, u, a = after
    for kind, fault in zip(reversed(kinds), reversed(faults)):
        if fault in (BLANK, DUPLICATE):
            e, s, u, a = e + DELETE, s + DELETE, u + DELETE, a + DELETE
        else:
            stay = STUMP if fault == TRUNCATED else 0
            to_u, to_a = u + stay + REROLE, a + stay + REROLE
            first = to_u
            if kind == USER:
                to_u = first = u + stay
            elif kind == ASSISTANT:
                to_a = a + stay
            elif kind == SYSTEM:
                first = min(first, s + stay)
            e, s, u, a = min(e + DELETE, first), min(s + DELETE, to_u), min(u + DELETE, to_a), min(a + DELETE, to_u)
        u, a = min(u, a + INSERT), min(a, u + INSERT)
        e, s = min(e, u + INSERT), min(s, u + INSERT)
        out.append((e, s, u, a))
    return np.array(out[::-1], np.int64)


def cost_matrix(kinds: list[int], faults: list[int]) -> np.ndarray:
    """Cheapest cost from each state in front of some rows to each behind them."""
    ways = [costs_to_go(kinds, faults, tuple(0 if t == u else FAR for t in range(4)))[0] for u in range(4)]
    return np.stack(ways, axis=1)


class Pieces:
    """Conversations' parts in a chunk, one behind the other, and the nodes of their graph."""

    def __init__(self, kinds: np.ndarray, faults: np.ndarray, starts: list[int], behind: tuple | None):
        """``starts``: where each part starts. ``behind``: costs behind the last, if it goes on."""
        n = len(kinds)
        stops = [*starts[1:], n]
        costs, row_of, self.first = [], [], []
        k, f = kinds.tolist(), faults.tolist()
        places = 0
        for i, (a, b) in enumerate(zip(starts, stops)):
            open_end = behind is not None and i == len(starts) - 1
            costs.append(costs_to_go(k[a:b], f[a:b], behind if open_end else ENDED))
            row_of.append(np.append(np.arange(a, b), -2 if open_end else -1))
            self.first.append(places)
            places += b - a + 1
        self.row = np.concatenate(row_of)
        self.stops = stops
        cost = np.concatenate(costs)
        self._arcs(cost, kinds, faults)

    def _arcs(self, cost: np.ndarray, kinds: np.ndarray, faults: np.ndarray) -> None:
        """All arcs on cheapest ways, as (node, letter, node); ends lead to themselves by letter 0."""
        places = len(cost)
        at = np.arange(places)
        ended, goes_on = self.row == -1, self.row == -2
        inner = at[self.row >= 0]
        kind, fault = kinds[self.row[inner]], faults[self.row[inner]]
        stays = inner[fault < BLANK], inner[fault == TRUNCATED]
        stays = np.sort(np.concatenate(stays))
        extra = np.zeros(places, np.int64)
        extra[inner[fault == TRUNCATED]] = STUMP
        kind_at = np.zeros(places, np.int64)
        kind_at[inner] = kind
        found: list[tuple[np.ndarray, int, np.ndarray]] = []

        def add(where: np.ndarray, state: int, letter: int, step: int, to: np.ndarray | int, price: np.ndarray | int) -> None:
            to = np.broadcast_to(to, where.shape)
            best = cost[where, state] == price + cost[where + step, to]
            found.append((where[best] * 4 + state, letter, (where[best] + step) * 4 + to[best]))

        kept = np.array(KEPT)
        for state in range(4):
            add(inner, state, 1, 1, state, DELETE)
            add(at[~goes_on], state, 2, 0, NEXT[state], INSERT)
            to = kept[kind_at[stays], state]
            can = to >= 0
            add(stays[can], state, 3, 1, to[can], extra[stays[can]])
            add(stays, state, 4, 1, NEXT[state], REROLE + extra[stays])
        ends = [at[goes_on] * 4 + s for s in range(4)] + [at[ended] * 4 + s for s in (NOTHING, ASSISTANT)]
        found += [(e, 0, e) for e in ends]
        self.source = np.concatenate([x[0] for x in found])
        self.letter = np.concatenate([np.full(len(x[0]), x[1]) for x in found])
        self.target = np.concatenate([x[2] for x in found])
        self.nodes = places * 4


def least(source: np.ndarray, key: np.ndarray, target: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each node's pointers of least key, and the nodes' ranks by that key."""
    best = np.full(nodes, np.iinfo(np.int64).max)
    np.minimum.at(best, source, key)
    keep = key == best[source]
    pairs = np.unique(np.stack([source[keep], target[keep]], axis=1), axis=0)
    rank = np.unique(best, return_inverse=True)[1]
    return pairs[:, 0], pairs[:, 1], rank


class PathRanking:
    """Least audits from every node: pointers over 1, 2, 4, ... letters."""

    def __init__(self, graph: Pieces):
        nodes = graph.nodes
        self.letters = np.zeros(nodes, np.int64)
        source, target, rank = least(graph.source, graph.letter, graph.target, nodes)
        np.minimum.at(first := np.full(nodes, len(LETTERS)), graph.source, graph.letter)
        self.letters = first
        self.jumps = [self._pointer(source, target, nodes)]
        while not np.array_equal(ends := self.jumps[-1][self.jumps[-1]], self.jumps[-1]):
            # Every pointer is followed by the pointers of the node it leads to.
            begin = np.searchsorted(source, np.arange(nodes + 1))
            many = np.diff(begin)[target]
            left = np.repeat(np.arange(len(source)), many)
            right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[target], many)
            key = rank[source[left]] * (int(rank.max()) + 1) + rank[target[left]]
            source, target, rank = least(source[left], key, target[right], nodes)
            self.jumps.append(self._pointer(source, target, nodes))
        self.ends = ends

    @staticmethod
    def _pointer(source: np.ndarray, target: np.ndarray, nodes: int) -> np.ndarray:
        """One of the least ways of a node; nodes that lie on no cheapest way stay where they are."""
        to = np.arange(nodes)
        to[source[::-1]] = target[::-1]
        return to

    def audits(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each letter of the least audits from some nodes: which entry, and its node."""
        at, length = entries.copy(), np.zeros(len(entries), np.int64)
        for k in range(len(self.jumps) - 1, -1, -1):
            on = self.letters[self.jumps[k][at]] > 0
            length += np.where(on, 1 << k, 0)
            at = np.where(on, self.jumps[k][at], at)
        length += self.letters[at] > 0
        which = np.repeat(np.arange(len(entries)), length)
        place = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
        node = entries[which]
        for k in range(len(self.jumps)):
            node = np.where(place >> k & 1 == 1, self.jumps[k][node], node)
        return which, node


ACTIONS = ["from_e", "from_s", "from_u", "from_a"]


def actions_of(kinds: np.ndarray, faults: np.ndarray, starts: list[int], behind: tuple | None) -> list[list]:
    """For each row its letters, per state in which the row's part is entered.

    The chunk's first part may be entered in any state; the others begin a conversation.
    Letters in front of a row's own are insertions before it, those behind it end a conversation.
    """
    graph = Pieces(kinds, faults, starts, behind)
    ranking = PathRanking(graph)
    entries = [graph.first[0] * 4 + s for s in range(4)] + [p * 4 for p in graph.first[1:]]
    which, node = ranking.audits(np.array(entries, np.int64))
    out = [[None] * len(kinds) for _ in range(4)]
    row = graph.row[node // 4]
    letters = ranking.letters[node]
    part = np.maximum(which - 3, 0)
    row = np.where(row == -1, np.array(graph.stops)[part] - 1, row)
    for entry, i, letter in zip(which.tolist(), row.tolist(), letters.tolist()):
        mine = out[entry if entry < 4 else 0]
        mine[i] = (mine[i] or "") + LETTERS[letter]
    return out


def _starts(conversations: list) -> list[int]:
    return [i for i, c in enumerate(conversations) if i == 0 or c != conversations[i - 1]]


def _columns(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, list[int]]:
    rows = rows.sort_by("pos")
    kinds, faults = (rows.column(c).to_numpy().astype(np.int64) for c in ("kind", "fault"))
    return rows, kinds, faults, _starts(rows.column("conv_id").to_pylist())


MATRIX = ", ".join(f"m{i} long" for i in range(16))


def _matrices(rows: pa.Table) -> pa.Table:
    """Costs through the first and the last part of a chunk, if these are two."""
    rows, kinds, faults, starts = _columns(rows)
    bounds = [*starts, len(kinds)]
    out = []
    for i in sorted({0, len(starts) - 1}):
        a, b = bounds[i], bounds[i + 1]
        out.append([rows.column("conv_id")[a].as_py(), rows.column("chunk")[0].as_py(), *cost_matrix(kinds[a:b].tolist(), faults[a:b].tolist()).ravel().tolist()])
    names = ["conv_id", "chunk", *[f"m{i}" for i in range(16)]]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def _behind(parts: pa.Table) -> pa.Table:
    """The costs behind each part of a conversation that another follows."""
    parts = parts.sort_by("chunk")
    chunks = parts.column("chunk").to_pylist()
    matrices = np.stack([parts.column(f"m{i}").to_numpy() for i in range(16)], axis=1).reshape(-1, 4, 4)
    costs, out = np.array(ENDED), []
    for i in range(len(chunks) - 1, 0, -1):
        costs = (matrices[i] + costs).min(axis=1)
        out.append([chunks[i - 1], *costs.tolist()])
    columns = list(zip(*out)) or [()] * 5
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["chunk", "e", "s", "u", "a"])


def _planned(rows: pa.Table, behind: pa.Table) -> pa.Table:
    if not len(rows):
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 4)], names=["conv_id", "pos", "fault", *ACTIONS])
    rows, kinds, faults, starts = _columns(rows)
    after = tuple(behind.column(c)[0].as_py() for c in "esua") if len(behind) else None
    actions = [pa.array(x, pa.string()) for x in actions_of(kinds, faults, starts, after)]
    columns = [rows.column("conv_id"), rows.column("pos"), pa.array(faults, pa.int32()), *actions]
    return pa.table(columns, names=["conv_id", "pos", "fault", *ACTIONS])


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


class _Conversation:
    """What is known of a conversation whose rows come one by one."""

    def __init__(self, conv_id: int | None, with_text: bool):
        self.conv_id = conv_id
        self.turns, self.lowest, self.turn = 0, None, None
        self.faults = [0, 0, 0, 0]
        self.illegal = self.cost = 0
        self.kind = None
        self.state = self.entry = NOTHING
        self.chunk = None
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), [] if with_text else None
        self.empty = True

    def _say(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.digest.update((line if self.empty else "\n" + line).encode())
        self.empty = False
        if self.lines is not None:
            self.lines.append(line)

    def add(self, turn: int | None, kind: int, role: str, text: str, chunk: int, fault: int, actions: list) -> None:
        if turn is not None:
            self.lowest = turn if self.lowest is None else self.lowest
            self.turns += turn != self.turn
            self.turn = turn
        self.faults[fault] += 1
        self.illegal += self.kind is not None and (self.kind, kind) not in _LEGAL
        self.kind = kind
        if chunk != self.chunk:
            self.chunk, self.entry = chunk, self.state
        letters = actions[self.entry]
        stump = STUMP if fault == TRUNCATED else 0
        for letter in letters:
            if letter == "D":
                self.cost += DELETE
                continue
            if letter == "K":
                self.state, said = KEPT[kind][self.state], (role, text)
                self.cost += stump
            else:
                self.state = NEXT[self.state]
                said = (_ROLE[self.state], "" if letter == "I" else text)
                self.cost += INSERT if letter == "I" else REROLE + stump
            self._say(*said)
        self.audit.append(letters)

    def result(self) -> tuple:
        gaps = 0 if self.lowest is None else self.turn - self.lowest + 1 - self.turns
        row = (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())
        return row if self.lines is None else (*row, "\n".join(self.lines))


def _told(with_text: bool, chunk_bits: int):
    kinds = [pa.int64()] * 7 + [pa.string()] * (3 if with_text else 2)
    names = [c.split()[0] for c in RESULT.split(", ")] + ["repaired"] * with_text

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row's plan comes in front of the row, a conversation's rows in order."""
        current, plan, done, size = None, None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "kind", "role", "text", "fault", *ACTIONS)]
            for conv_id, pos, turn, kind, role, text, fault, *actions in zip(*columns):
                if fault is not None:
                    plan = fault, actions
                    continue
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.result())
                        size += len(done[-1][7]) + (len(done[-1][9]) if with_text else 0)
                    current = _Conversation(conv_id, with_text)
                current.add(turn, kind, role, text, pos >> chunk_bits, *plan)
                if len(done) >= 4096 or size > 1 << 24:
                    yield batch_of(done)
                    done, size = [], 0
        if current is not None:
            done.append(current.result())
            yield batch_of(done)

    return run


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(0)


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows in the order of conversations and turns, numbered by ``pos``, with what their texts tell.

    The order goes on to role, text and the row itself, so that ranges cut a conversation, or
    very many equal rows, wherever they get too long.
    """
    text, role = F.coalesce(rows["text"].cast("string"), F.lit(" ")), F.coalesce(rows["role"].cast("string"), F.lit(" "))
    picked = rows.select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("uid"),
    )
    order = ["conv_id", "turn", "role", "text", "uid"]
    placed = picked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    said = F.concat_ws("\0", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "role", "text")
    return placed.select(
        "conv_id", "turn", "pos", "role", "text", _initial(F.col("role")).alias("kind"),
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK)
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED).otherwise(0).alias("fault"),
        F.unhex(F.sha2(said, 256)).alias("said"),
    )


def repair_conversations(
    rows: DataFrame, with_text: bool = False, known: DataFrame | None = None, chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation.

    ``rows`` has conv_id, turn, role and text; ``known`` may name more conversations (a column
    conv_id) that are to be in the result though they have no rows. ``with_text`` adds
    ``repaired``, the lines ``role:text`` whose SHA-256 the digest is.

    Rows go by turn, missing turns first, then by role and text in the order of their bytes. The
    first fault of a row counts: blank, duplicate (role and text came earlier), truncated (the
    last character that is no white space is none of ``.!?``). Null roles and texts are one
    space; a null conv_id is a conversation of its own. Gaps are the turns missing between the
    first and the last one. A conversation without rows has zeros, an empty audit and the digest
    of nothing. Repeated rows count as often as they stand there; other columns, whatever their
    names, are not looked at; an empty table gives no rows.

    No task holds more than a chunk of rows, without their texts, or a row with its text. The
    digest of one conversation is sequential by nature: its rows are read in order by one task.
    """
    table = written(ordered_rows(rows), "conversations")
    thin = table.select("conv_id", "pos", "kind", "fault", "said")
    first = thin.groupBy("said").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    fault = F.when((F.col("fault") != BLANK) & (F.col("pos") > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    judged = thin.join(first, "said", "left").select(
        "conv_id", "pos", "kind", fault.cast("int").alias("fault"), F.shiftright("pos", chunk_bits).alias("chunk")
    )
    judged = written(judged, "turns")
    parts = judged.groupBy("chunk").applyInArrow(_matrices, f"conv_id long, chunk long, {MATRIX}")
    behind = parts.groupBy("conv_id").applyInArrow(_behind, "chunk long, e long, s long, u long, a long")
    schema = "conv_id long, pos long, fault int, " + ", ".join(f"{a} string" for a in ACTIONS)
    plans = judged.groupBy("chunk").cogroup(behind.groupBy("chunk")).applyInArrow(_planned, schema)
    texts = table.select("conv_id", "pos", "turn", "kind", "role", "text")
    both = texts.unionByName(plans, allowMissingColumns=True)
    in_order = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("fault").asc_nulls_last())
    told = in_order.mapInArrow(_told(with_text, chunk_bits), RESULT + ", repaired string" * with_text)
    if known is None:
        return told
    ids = known.select(known["conv_id"].cast("long").alias("known_id")).distinct()
    found = ids.join(told, F.col("known_id").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    rest = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    rest |= {"audit": "", "repaired_sha256": nothing} | ({"repaired": ""} if with_text else {})
    return found.select(F.col("known_id").alias("conv_id"), *[F.coalesce(c, F.lit(v)).alias(c) for c, v in rest.items()])
