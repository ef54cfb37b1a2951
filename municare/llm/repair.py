"""Repair of conversations: the cheapest edits that make the turns alternate as they should.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``: perhaps a system turn, then
user and assistant in turn, or nothing. Edits: Keep (0), Rerole to user or assistant (1), Delete (2),
Insert an empty user or assistant turn anywhere (5). Blank and repeated rows have to go; a truncated row
that stays adds 5. Of equally cheap repairs the one whose edits' initials come first in ASCII is taken.

A Viterbi search with one survivor per state of that pattern passes the rows once. The survivors share
a tree of back pointers whose nodes know how many live nodes lead on from them; what no survivor needs is
freed, and as soon as all survivors come from one node, the edits up to it are certain and leave the
tree. So a task holds the rows of the unresolved stretch, not the conversation.

Spark deals the conversations to tasks and sorts their rows (spilling to disk where needed). One
conversation passes one task, as a stream: the digest of its repaired text cannot be split.

Defined results: a null role or text counts as one space, so such texts are blank; turns that are null
come first; rows of one turn lie by role and text. A role that is an empty string has no initial: keeping
its row costs nothing and changes nothing in the pattern. Rows without a conversation id form one
conversation. Exact copies of a row are repeats like any others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"  # 0x20 and 0x09 to 0x0D
ENDS = ".!?"

# States by what has been said: nothing, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
SAYS = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
ROLES = {USER: "user", ASSISTANT: "assistant"}
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5


def _spoken(state: int) -> int | None:
    """The state after the next user or assistant turn; only one of them can come next."""
    return SAYS.get((state, "u"), SAYS.get((state, "a")))


def _inserted(state: int) -> list[tuple[int, int]]:
    """(state, inserted turns) within reach, each state by the fewest."""
    reached = [(state, 0)]
    while (after := _spoken(reached[-1][0])) not in [s for s, _ in reached]:
        reached.append((after, len(reached)))
    return reached


def _moves(initial: str, doomed: bool, truncated: bool) -> list[list[tuple[int, int, str]]]:
    """Per new state, the ways over one row: (state before, cost, edits). Of two ways between the same
    states the cheaper, then the first in ASCII; neither's edits can be the beginning of the other's."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stays = TRUNCATED if truncated else 0
    for start in range(4):
        for state, inserted in _inserted(start):
            edits = [(state, DELETE, "D")]
            if not doomed:
                kept = state if initial == "" else SAYS.get((state, initial))
                if kept is not None:
                    edits.append((kept, stays, "K"))
                edits.append((_spoken(state), REROLE + stays, "R"))
            for end, cost, edit in edits:
                way = (cost + INSERT * inserted, "I" * inserted + edit)
                if (start, end) not in best or way < best[start, end]:
                    best[start, end] = way
    return [[(s, *way) for (s, e), way in sorted(best.items()) if e == end] for end in range(4)]


# A survivor can do what another one will, for at most this much more: (state, other state, more). After an
# assistant turn a system turn that is kept later has to go (2), after a user turn a turn has to come in
# first (5). Whoever costs more than that above another cannot win or tie. Only the states that nothing
# leads back to need it; the others are reached again, and so compared, at each row.
_HOPELESS = [
    (NOTHING, ASSISTANT, DELETE), (NOTHING, USER, DELETE + INSERT), (SYSTEM, ASSISTANT, 0), (SYSTEM, USER, INSERT)
]
_LAST = [(NOTHING, 0), (ASSISTANT, 0), (USER, 1), (SYSTEM, 2)]  # turns to insert after the last row


@dataclass(slots=True)
class _Node:
    """The edits over one row on some survivor's way; ``on`` are the live nodes that lead on from it."""

    parent: _Node | None
    edits: str
    state: int  # before the edits
    row: tuple[str, str]
    on: list[_Node] = field(default_factory=list)


class Search:
    """One conversation: ``push`` its rows, then ``finish``. Both return the edits that became certain,
    as (edits' initials, state before them, (role, text))."""

    _known: dict[tuple[str, bool, bool], list[list[tuple[int, int, str]]]] = {}

    def __init__(self) -> None:
        self.root = _Node(None, "", NOTHING, ("", ""))
        # (cost, node, order) by state. Order compares the whole unresolved ways of the survivors: a way
        # is the way of a survivor before plus one step, so orders follow from orders and steps.
        self.alive: list[tuple[int, _Node, int] | None] = [(0, self.root, 0), None, None, None]
        self.held = 0  # nodes in the tree

    def push(self, role: str, text: str, doomed: bool, truncated: bool) -> list[tuple[str, int, tuple[str, str]]]:
        initial = role[:1]
        kind = (initial if initial in ("", "s", "u", "a") else " ", doomed, truncated)
        if kind not in self._known:
            self._known[kind] = _moves(*kind)
        alive, chosen = self.alive, []
        for end, ways in enumerate(self._known[kind]):
            found = None
            for start, cost, edits in ways:
                if (before := alive[start]) is not None:
                    way = (before[0] + cost, before[2], edits, start)
                    if found is None or way < found:
                        found = way
            if found is not None:
                chosen.append((found[1], found[2], found[0], found[3], end))
        costs = {c[4]: c[2] for c in chosen}
        lost = {s for s, other, more in _HOPELESS if s in costs and other in costs and costs[s] > costs[other] + more}
        chosen = sorted(c for c in chosen if c[4] not in lost)
        row = (role, text)
        after: list[tuple[int, _Node, int] | None] = [None] * 4
        for order, (_, edits, cost, start, end) in enumerate(chosen):
            parent = alive[start][1]
            node = _Node(parent, edits, start, row)
            parent.on.append(node)
            after[end] = (cost, node, order)
        self.held += len(chosen)
        for survivor in alive:
            if survivor is not None:
                self._free(survivor[1])
        self.alive = after
        return self._certain()

    def _free(self, node: _Node) -> None:
        """Drop a node from which nothing leads on, and those before it that only led there."""
        while not node.on and node.parent is not None:
            parent = node.parent
            parent.on.remove(node)
            node.parent = None
            self.held -= 1
            node = parent

    def _certain(self) -> list[tuple[str, int, tuple[str, str]]]:
        out = []
        while len(self.root.on) == 1:
            self.root = self.root.on[0]
            self.root.parent = None
            self.held -= 1
            out.append((self.root.edits, self.root.state, self.root.row))
        return out

    def finish(self) -> tuple[int, list[tuple[str, int, tuple[str, str]]], int]:
        """(cost, the edits left, turns to insert at the end)."""
        ends = [(s[0] + INSERT * n, s[2], n, state) for state, n in _LAST if (s := self.alive[state]) is not None]
        cost, _, inserted, state = min(ends)
        node, left = self.alive[state][1], []
        while node is not self.root:
            left.append((node.edits, node.state, node.row))
            node = node.parent
        return cost, left[::-1], inserted


def repaired(edits: str, state: int, row: tuple[str, str]) -> Iterator[tuple[str, str]]:
    """The turns (role, text) that edits over one row leave."""
    for edit in edits:
        if edit == "D":
            return
        role, text = row
        if edit in "IR":
            state = _spoken(state)
            role = ROLES[state]
            text = "" if edit == "I" else text
        yield role, text


def closing(state: int, inserted: int) -> Iterator[tuple[str, str]]:
    return repaired("I" * inserted, state, ("", ""))


def judged(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, keep: Column | None = None, *, copy: Column | None = None
) -> DataFrame:
    """(conv, turn, role, text, blank, repeat, truncated, present) with each conversation's rows in order
    within one partition. ``keep`` says which rows count; the others only name their conversation.

    One shuffle: the rows of a conversation come together, repeats are numbered there, then the rows are
    put in order.
    """
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.lit(True) if keep is None else keep).alias("present"), (F.lit(0) if copy is None else copy).alias("copy"),
    )
    dealt = slim.repartition("conv")
    order = ["turn", "role", "text", "copy"]  # nulls first
    same = Window.partitionBy("conv", "present", "role", "text").orderBy("turn", "copy")
    dealt = dealt.withColumn("repeat", F.row_number().over(same) > 1)
    faults = dealt.select(
        "*", (said == "").alias("blank"), (~F.substring(said, -1, 1).isin(*ENDS)).alias("truncated")
    )
    return faults.sortWithinPartitions("conv", *order)


SUMMARY = """conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
    audit string, repaired_sha256 string, most_held int"""
TURNS = "conv_id {conv}, place long, role string, text string"
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Conversation:
    """What is told of one conversation while its rows pass."""

    def __init__(self, conv: object):
        self.conv, self.search = conv, Search()
        self.low = self.high = self.last_turn = self.last_initial = None
        self.turns = self.blank = self.repeats = self.truncated = self.illegal = 0
        self.audit: list[str] = []
        self.sha, self.said, self.most_held = hashlib.sha256(), 0, 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, repeat: bool, truncated: bool) -> list[tuple[str, str]]:
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
            self.turns += 1
        repeat, truncated = repeat and not blank, truncated and not (blank or repeat)
        self.blank, self.repeats, self.truncated = self.blank + blank, self.repeats + repeat, self.truncated + truncated
        initial = role[:1]
        self.illegal += self.last_initial is not None and (self.last_initial, initial) not in _LEGAL
        self.last_initial = initial
        turns = self._take(self.search.push(role, text, blank or repeat, truncated))
        self.most_held = max(self.most_held, self.search.held)
        return turns

    def end(self) -> tuple[list[tuple[str, str]], int]:
        cost, left, inserted = self.search.finish()
        turns = self._take(left)
        if inserted:
            self.audit.append("I" * inserted)
            turns += self._said(closing(USER if inserted == 1 else SYSTEM, inserted))
        return turns, cost

    def _take(self, certain: list[tuple[str, int, tuple[str, str]]]) -> list[tuple[str, str]]:
        turns: list[tuple[str, str]] = []
        for edits, state, row in certain:
            self.audit.append(edits)
            turns += self._said(repaired(edits, state, row))
        return turns

    def _said(self, turns: Iterator[tuple[str, str]]) -> list[tuple[str, str]]:
        out = list(turns)
        for role, text in out:
            self.sha.update(f"{chr(10) if self.said else ''}{role}:{text}".encode())
            self.said += 1
        return out

    def summary(self, cost: int) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.repeats, self.truncated, self.illegal, cost,
                "".join(self.audit), self.sha.hexdigest(), self.most_held)


_ROWS_AT_ONCE = 512


def _run(rows: DataFrame, schema: str, whole: bool) -> DataFrame:
    """Pass ordered rows of whole conversations: their turns as they become certain, or a summary each."""
    schema = schema.format(conv=rows.schema["conv"].dataType.simpleString())
    empty = rows.sparkSession.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(empty.schema)
    read = rows.select("conv", "turn", "role", "text", "blank", "repeat", "truncated", "present")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        out: list[tuple] = []

        def tell(turns: list[tuple[str, str]]) -> None:
            first = now.said - len(turns)
            out.extend((now.conv, first + i, role, text) for i, (role, text) in enumerate(turns))

        def close() -> None:
            turns, cost = now.end()
            if whole:
                out.append(now.summary(cost))
            else:
                tell(turns)

        def batch() -> pa.RecordBatch:
            columns = zip(*out) if out else [[] for _ in shape]
            made = [pa.array(list(c), f.type) for c, f in zip(columns, shape)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, schema=shape)

        for large in batches:
            for at in range(0, large.num_rows, _ROWS_AT_ONCE):
                part = large.slice(at, _ROWS_AT_ONCE)
                for conv, turn, role, text, *faults, present in zip(*[c.to_pylist() for c in part.columns]):
                    if now is None or conv != now.conv:
                        if now is not None:
                            close()
                        now = _Conversation(conv)
                    if present:
                        turns = now.add(turn, role, text, *faults)
                        if not whole:
                            tell(turns)
                if out:
                    yield batch()
        if now is not None:
            close()
            yield batch()

    return read.mapInArrow(run, schema)


def summaries(rows: DataFrame) -> DataFrame:
    """Per conversation of ``judged`` rows: faults, cost, audit, digest of the repaired turns, and the
    most tree nodes that were held at once."""
    return _run(rows, SUMMARY, whole=True)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, place, role, text) of ``judged`` rows; none of a conversation whose
    cheapest repair is to delete everything."""
    return _run(rows, TURNS, whole=False)


def repair(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Repaired turns of a table of conversations as it is."""
    return repaired_turns(judged(conversations, conv, turn, role, text))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row
    (it stays, not ``present``, so that its conversation is known), 1 empties its text, 2 takes its sentence
    ends away, 3 repeats it, 4 makes it a user turn."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *told).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int"))).alias("copy"),
    )
