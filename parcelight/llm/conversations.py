"""Cheapest repairs of conversations, with an audit of the edits.

The turns of a repaired conversation are (system) (user assistant)+, or none: the first
letters of their roles match ``(s?(ua)+)?``. Edits, one letter each in the audit: Keep a
turn (0), Rerole it to user or assistant (1), Delete it (2), Insert an empty user or
assistant turn (5). Blank turns and turns whose role and text were there before must go;
a truncated turn (its last character ends no sentence) that stays costs 5 more. Among the
cheapest repairs the one whose audit comes first in ASCII is taken.

A dynamic program runs over the turns and the four states of the grammar
(:class:`Audits`, :func:`solve`). Audits share their beginnings as linked nodes. Two of
equal cost are compared by the longest common prefix, found with binary-lifting ancestors
and rolling hashes; where hashes agree, the letters are compared back to the node that
both share, so a collision decides nothing. A cost follows from the letters
and the turns, so equal costs are never those of an audit and its continuation, and the
smaller one stays smaller whatever follows.

Turns are numbered by one range sort and dealt into blocks of :data:`BLOCK`, so a
conversation that holds a third of all turns lies in many tasks. A block solves the
conversations inside it; of those that touch its edges it returns the best audit from each
state to each state, 16 at most. These pieces are put together in order, with the same
audits and the same comparison, a piece as the letter. Then every block knows its letters
and edits its turns. Only the pieces of one conversation meet in a task: letters, never
texts, at most 16 for each letter of the audit that is returned anyway.

Defined cases: a null id groups like a value; a null role or text is one space; turns with a
null number come first, equal numbers are ordered by role and text; repeated rows are turns
of their own (all but one are duplicates). Texts may have any length. A conversation
all of whose turns go has no repaired turns. Without rows the result has none. Other columns
are neither read nor returned, and names used inside may be taken by the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import store
from parcelight.operators import number_rows

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_STAYS = 5

# Turns of a block; modulus and base of a hash.
BLOCK = 512
_PRIME, _BASE = (1 << 61) - 1, 911_382_323

# Faults of a turn.
SOUND, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_STATES = range(4)
_ENDS = (0, 3)
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)  # state after a user or assistant turn is put in


class Audits:
    """Strings as linked nodes: each is its parent's string and one piece more (a letter,
    or a run of letters). Node 0 is the empty string."""

    def __init__(self, prime: int = _PRIME) -> None:
        self.prime = prime
        self.parent = [0]
        self.piece = [""]
        self.depth = [0]
        self.length = [0]
        self.hash = [0]
        self.ups: list[list[int]] = [[]]

    def add(self, node: int, piece: str) -> int:
        self.parent.append(node)
        self.piece.append(piece)
        self.depth.append(self.depth[node] + 1)
        self.length.append(self.length[node] + len(piece))
        h = self.hash[node]
        for letter in piece:
            h = (h * _BASE + ord(letter)) % self.prime
        self.hash.append(h)
        self.ups.append([])
        return len(self.parent) - 1

    def up(self, node: int, k: int) -> int:
        """The ancestor 2^k steps up, remembered once asked for."""
        ups = self.ups[node]
        while len(ups) <= k:
            ups.append(self.up(ups[-1], len(ups) - 1) if ups else self.parent[node])
        return ups[k]

    def _at_most(self, node: int, length: int) -> int:
        """The deepest ancestor (or the node) of at most ``length`` letters."""
        if self.length[node] <= length:
            return node
        for k in range(self.depth[node].bit_length() - 1, -1, -1):
            if self.depth[node] > 1 << k:
                above = self.up(node, k)
                if self.length[above] > length:
                    node = above
        return self.parent[node]

    def _same(self, a: int, b: int) -> bool:
        return self.length[a] == self.length[b] and self.hash[a] == self.hash[b]

    def common(self, a: int, b: int) -> tuple[int, int]:
        """Ancestors of ``a`` and ``b`` that spell the same letters by their hashes, the
        deepest of ``a`` for which there is such a one of ``b``."""
        low, high = 0, self.depth[a]
        lifted = a
        # Binary search over depths of a, by ancestors of the wanted depth.
        while low < high:
            middle = (low + high + 1) // 2
            above = self._ancestor(lifted, middle)
            other = self._at_most(b, self.length[above])
            if self._same(above, other):
                low = middle
            else:
                high, lifted = middle - 1, self._ancestor(above, middle - 1)
        mine = self._ancestor(lifted, low)
        return mine, self._at_most(b, self.length[mine])

    def _ancestor(self, node: int, depth: int) -> int:
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up(node, k)
            steps >>= 1
            k += 1
        return node

    def _really_same(self, a: int, b: int) -> bool:
        """Whether two nodes of equal length spell the same, letter by letter, back to
        the node that both share."""
        left, right = "", ""
        while a != b or left or right:
            if not left:
                left, a = self.piece[a], self.parent[a]
            if not right:
                right, b = self.piece[b], self.parent[b]
            n = min(len(left), len(right))
            if left[len(left) - n :] != right[len(right) - n :]:
                return False
            left, right = left[: len(left) - n], right[: len(right) - n]
        return True

    def text(self, node: int, above: int = 0) -> str:
        """The letters from below ``above`` down to ``node``."""
        pieces = []
        while node != above:
            pieces.append(self.piece[node])
            node = self.parent[node]
        return "".join(reversed(pieces))

    def less(self, a: int, b: int) -> bool:
        """Whether ``a`` spells a smaller string than ``b``."""
        if a == b:
            return False
        mine, other = self.common(a, b)
        if not self._really_same(mine, other):
            mine = other = 0  # a collision: compare all letters
        if a != mine and b != other:
            left = self.piece[self._ancestor(a, self.depth[mine] + 1)]
            right = self.piece[self._ancestor(b, self.depth[other] + 1)]
            if not left.startswith(right) and not right.startswith(left):
                return left < right
        return self.text(a, mine) < self.text(b, other)


Best = list  # per state: (cost, node), or None where no repair leads there


def _better(audits: Audits, best: Best, state: int, cost: int, node: int, piece: str) -> None:
    """Keeps the better of a state's repair and ``node`` with ``piece`` put behind."""
    held = best[state]
    if held is not None and held[0] < cost:
        return
    new = audits.add(node, piece)
    if held is None or cost < held[0] or audits.less(new, held[1]):
        best[state] = (cost, new)


def _inserted(audits: Audits, best: Best) -> None:
    """Lets turns be put in here: at most two, since a third leads back to a state
    that was reached for less."""
    for _ in range(2):
        before = list(best)
        for state in _STATES:
            if before[state] is not None:
                cost, node = before[state]
                _better(audits, best, _NEXT[state], cost + COST[INSERT], node, INSERT)


def step(audits: Audits, best: Best, initial: str, fault: int) -> Best:
    """Best repairs after one more turn."""
    _inserted(audits, best)
    after: Best = [None] * 4
    stays = TRUNCATED_STAYS if fault == TRUNCATED else 0
    for state in _STATES:
        if best[state] is None:
            continue
        cost, node = best[state]
        _better(audits, after, state, cost + COST[DELETE], node, DELETE)
        if fault in (BLANK, DUPLICATE):
            continue
        kept = _KEPT.get((state, initial))
        if kept is not None:
            _better(audits, after, kept, cost + stays, node, KEEP)
        _better(audits, after, _NEXT[state], cost + stays + COST[REROLE], node, REROLE)
    return after


def solve(turns: Sequence[tuple[str, int]], state: int = 0) -> tuple[Audits, Best]:
    """Best repairs from ``state`` over turns (initial, fault). Turns put in behind the
    last belong to the caller."""
    audits = Audits()
    best: Best = [None] * 4
    best[state] = (0, 0)
    for initial, fault in turns:
        best = step(audits, best, initial, fault)
    return audits, best


def finished(audits: Audits, best: Best) -> tuple[int, int, int]:
    """(cost, node, state) of the best complete repair that began with nothing."""
    _inserted(audits, best)
    chosen = (*best[0], 0)  # all turns deleted is a repair
    for state in _ENDS[1:]:
        if best[state] is None:
            continue
        cost, node = best[state]
        if cost < chosen[0] or (cost == chosen[0] and audits.less(node, chosen[1])):
            chosen = (cost, node, state)
    return chosen


def repaired(
    letters: str, turns: Sequence[tuple[str, str]], state: int = 0
) -> list[tuple[str, str]]:
    """The turns (role, text) that the piece ``letters`` of an audit leaves of ``turns``."""
    out, at = [], 0
    for letter in letters:
        role, text = ("", "") if letter == INSERT else turns[at]
        at += letter != INSERT
        if letter == DELETE:
            continue
        if letter == KEEP:
            state = _KEPT[state, role[:1]]
        else:
            state = _NEXT[state]
            role = "user" if state == 2 else "assistant"
        out.append((role, text))
    return out


_LEGAL = {"su", "ua", "au"}
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_PIECE = {
    "block": pa.int64(), "whole": pa.bool_(), **{c: pa.int64() for c in _COUNTS},
    "first_initial": pa.string(), "last_initial": pa.string(),
    "first_turn": pa.int64(), "last_turn": pa.int64(), "turns": pa.int64(),
    "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()),
}
_REPORT = {
    "gaps": pa.int64(), **{c: pa.int64() for c in _COUNTS}, "cost": pa.int64(), "audit": pa.string(),
}
_PART = {"block": pa.int64(), "letters": pa.string(), "state": pa.int64(), "whole": pa.bool_()}
_SQL_TYPE = {
    pa.int64(): "bigint", pa.bool_(): "boolean", pa.string(): "string",
    pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>",
}


def _schema(conv_type: str, columns: dict) -> str:
    return ", ".join([f"conv {conv_type}", *(f"{c} {_SQL_TYPE[t]}" for c, t in columns.items())])


def _table(rows: list[dict], conv: pa.DataType, columns: dict) -> pa.Table:
    kinds = {"conv": conv, **columns}
    return pa.table({c: pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()})


def _runs(table: pa.Table) -> Iterator[list[dict]]:
    """The rows of each conversation, in order, of a block's rows."""
    held: list[dict] = []
    for row in table.sort_by("_no").to_pylist():
        if held and row["conv"] != held[0]["conv"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _piece(rows: list[dict], firsts: set[int], edge: bool) -> dict:
    """What the turns of one conversation in one block come to. At an edge of the block
    the conversation may go on: the best audits from each state to each."""
    turns = []
    for r in rows:
        fault = r["fault"]
        if fault != BLANK and r["_no"] not in firsts:
            fault = DUPLICATE
        turns.append((r["initial"], fault))
    faults = [f for _, f in turns]
    numbers = [r["turn"] for r in rows if r["turn"] is not None]
    costs, audits = [], []
    if edge:
        for state in _STATES:
            tree, best = solve(turns, state)
            costs += [b and b[0] for b in best]
            audits += [b and tree.text(b[1]) for b in best]
    else:
        tree, best = solve(turns)
        cost, node, _ = finished(tree, best)
        costs, audits = [cost], [tree.text(node)]
    return {
        "conv": rows[0]["conv"], "block": rows[0]["_block"], "whole": not edge,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a[0] + b[0] not in _LEGAL for a, b in zip(turns, turns[1:])),
        "first_initial": turns[0][0], "last_initial": turns[-1][0],
        "first_turn": min(numbers, default=None), "last_turn": max(numbers, default=None),
        "turns": len(set(numbers)), "costs": costs, "audits": audits,
    }


def _joined(pieces: list[dict]) -> tuple[dict, list[dict]]:
    """Report of one conversation from its pieces, in order, and the part of the audit
    that each piece gets with the state it starts in."""
    audits, best = Audits(), [(0, 0), None, None, None]
    came: list[dict[int, int]] = []  # per piece: state before, of each node
    for piece in pieces:
        after: Best = [None] * 4
        before: dict[int, int] = {}
        for start in _STATES:
            if best[start] is None:
                continue
            before[best[start][1]] = start
            for end in _STATES:
                letters = piece["audits"][4 * start + end]
                if letters is not None:
                    cost = best[start][0] + piece["costs"][4 * start + end]
                    _better(audits, after, end, cost, best[start][1], letters)
        came.append(before)
        best = after
    cost, node, _ = finished(audits, best)
    chain = []
    while node:
        chain.append(node)
        node = audits.parent[node]
    chain.reverse()
    # One node a piece; what follows was put in at the end.
    letters = [audits.piece[n] for n in chain[: len(pieces)]]
    letters[-1] += "".join(audits.piece[n] for n in chain[len(pieces) :])
    parts = [
        {"block": p["block"], "letters": l, "state": states[audits.parent[n]], "whole": False}
        for p, l, n, states in zip(pieces, letters, chain, came)
    ]

    report = {c: sum(p[c] for p in pieces) for c in _COUNTS}
    report["illegal"] += sum(
        a["last_initial"] + b["first_initial"] not in _LEGAL for a, b in zip(pieces, pieces[1:])
    )
    numbered_ = [p for p in pieces if p["first_turn"] is not None]
    gaps = 0
    if numbered_:
        distinct = sum(p["turns"] for p in numbered_) - sum(
            a["last_turn"] == b["first_turn"] for a, b in zip(numbered_, numbered_[1:])
        )
        gaps = numbered_[-1]["last_turn"] - numbered_[0]["first_turn"] + 1 - distinct
    return {**report, "gaps": gaps, "cost": cost, "audit": "".join(letters)}, parts


def numbered(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, _no, _block): all turns in order, numbered throughout.
    Equal rows are told apart by where they were read, which spreads them too."""
    space = F.lit(" ")
    read = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        F.monotonically_increasing_id().alias("_read"),
    )
    order = [
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(),
        F.col("role"), F.col("text"), F.col("_read"),
    ]
    return number_rows(read, order, "_no", 0).drop("_read").withColumn(
        "_block", F.floor(F.col("_no") / BLOCK)
    )


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Two tables. Reports, one row per conversation: (conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit); ``gaps``: numbers missing between the
    smallest and the largest, ``illegal``: neighbouring roles that may not be. Repaired
    turns: (conv, block, whole, turns), ``turns`` an array of (role, text) in order, a
    conversation that is not ``whole`` going on in later blocks."""
    turns = numbered(rows, conversation, turn, role, text)
    conv_type = turns.schema["conv"].dataType.simpleString()

    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    sound = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    thin = turns.select(
        "conv", "turn", "_no", "_block", F.substring("role", 1, 1).alias("initial"),
        F.when(blank, BLANK).when(~sound, TRUNCATED).otherwise(SOUND).alias("fault"),
    )
    # The first turn of each role and text of a conversation, by 256 bits of the text.
    firsts = (
        turns.groupBy("conv", "role", F.sha2("text", 256).alias("_digest"))
        .agg(F.min("_no").alias("_no"))
        .select("_no", F.floor(F.col("_no") / BLOCK).alias("_block"))
    )

    def solve_block(left: pa.Table, right: pa.Table) -> pa.Table:
        conv = left.schema.field("conv").type
        known = set(right.column("_no").to_pylist())
        found = list(_runs(left))
        pieces = [_piece(run, known, i in (0, len(found) - 1)) for i, run in enumerate(found)]
        return _table(pieces, conv, _PIECE)

    pieces, _ = store(
        thin.groupBy("_block").cogroup(firsts.groupBy("_block")).applyInArrow(
            solve_block, _schema(conv_type, _PIECE)
        ),
        "conversation-pieces",
    )

    def join_pieces(table: pa.Table) -> pa.Table:
        report, parts = _joined(table.sort_by("block").to_pylist())
        conv = table.column("conv")[0].as_py()
        rows = [{**part, "conv": conv} for part in parts]
        rows[0].update(report)
        return _table(rows, table.schema.field("conv").type, {**_PART, **_REPORT})

    edges, _ = store(
        pieces.where(~F.col("whole")).groupBy("conv").applyInArrow(
            join_pieces, _schema(conv_type, {**_PART, **_REPORT})
        ),
        "conversation-parts",
    )
    whole = pieces.where("whole")
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    reports = whole.select(
        "conv", F.coalesce(gaps, F.lit(0).cast("long")).alias("gaps"), *_COUNTS,
        F.get("costs", F.lit(0)).alias("cost"), F.get("audits", F.lit(0)).alias("audit"),
    ).unionByName(edges.where("audit IS NOT NULL").select("conv", *_REPORT))
    parts = whole.select(
        "conv", "block", F.get("audits", F.lit(0)).alias("letters"),
        F.lit(0).cast("long").alias("state"), "whole",
    ).unionByName(edges.select("conv", *_PART))

    def edit_block(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {p["conv"]: p for p in right.to_pylist()}
        out = []
        for run in _runs(left):
            part = known[run[0]["conv"]]
            pairs = [(r["role"], r["text"]) for r in run]
            left_over = repaired(part["letters"], pairs, part["state"])
            out.append({
                "conv": part["conv"], "block": part["block"], "whole": part["whole"],
                "turns": [{"role": r, "text": t} for r, t in left_over],
            })
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return _table(
            out, left.schema.field("conv").type,
            {"block": pa.int64(), "whole": pa.bool_(), "turns": kind},
        )

    repaired_turns = (
        turns.select("conv", "role", "text", "_no", "_block").groupBy("_block")
        .cogroup(parts.withColumn("_block", F.col("block")).groupBy("_block"))
        .applyInArrow(
            edit_block,
            f"conv {conv_type}, block bigint, whole boolean, turns array<struct<role:string,text:string>>",
        )
    )
    return reports, repaired_turns


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the lines ``role:text`` of repaired turns as :func:`repair`
    returns them. Conversations over several blocks are read in order, a block at a time."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    joined = F.array_join(lines, "\n")
    known = turns.select(
        "conv", "block", F.when(F.col("whole"), F.sha2(joined, 256)).alias("sha256"),
        F.when(~F.col("whole") & (F.size("turns") > 0), joined).alias("lines"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "sha256"]
        open_conv, state, begun, kind = None, None, False, None
        for batch in batches:
            kind = batch.schema.field("conv").type
            convs, shas = [], []
            for conv, _, sha, text in zip(*(c.to_pylist() for c in batch.columns)):
                if state is not None and (sha is not None or conv != open_conv):
                    convs.append(open_conv)
                    shas.append(state.hexdigest())
                    state = None
                if sha is not None:
                    convs.append(conv)
                    shas.append(sha)
                    continue
                if state is None:
                    open_conv, state, begun = conv, hashlib.sha256(), False
                if text is not None:
                    state.update(("\n" if begun else "").encode() + text.encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(shas)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([open_conv], kind), pa.array([state.hexdigest()])], names=names
            )

    conv_type = turns.schema["conv"].dataType.simpleString()
    return (
        known.repartition("conv")
        .sortWithinPartitions(F.col("conv").asc_nulls_first(), "block")
        .mapInArrow(digest, f"conv {conv_type}, sha256 string")
    )
