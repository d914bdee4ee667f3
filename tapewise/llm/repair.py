"""Repair of damaged conversations by least-cost edits, streamed over secondary-sorted turns.

Turns are dealt to partitions by conversation once.  Inside each partition Spark
sorts them by turn, backwards and then forwards, spilling to disk as it needs,
and a Python stream goes over each order, its state carried across Arrow batches:

1. *Backwards*, a dynamic program keeps the cheapest cost of finishing the
   conversation from each of four states (nothing yet; after system; after user;
   after assistant).  It leaves one byte per turn, the best next edit from each
   state: the compact back pointers, which travel on with the turns through
   Spark's sort instead of gathering in the worker.
2. *Forwards*, the stream follows these bytes from the first state, which gives
   the edits, the repaired turns and the running digest.

So neither stream holds more of a conversation than a batch of its turns (and the
edits' initials, which are part of the result), however long it is.  Whether a
turn's role and text came earlier is a window over equal rows of a conversation,
which keeps the partitioning.

Edits cost: Keep 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty
turn of user or assistant) 2; a truncated turn that stays adds 1.  Blank and
duplicate turns must go.  The roles that remain are nothing, or an optional system
turn and pairs of user and assistant.  From a state an edit's initial tells the
state that follows, so the ASCII-least of the cheapest edit sequences takes the
least initial that keeps the cost at each step.

Null conversation ids form one conversation; null turns come first and leave
gaps unaffected; null roles and texts become one space.  Turns with one number
are ordered by role and text; repeated rows are duplicates.  Very long texts are
digested as they pass.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewise.llm.common import by_value

#: Edits in ASCII order; a back pointer holds two bits for each state.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn whose role has this initial; states without an entry allow no such turn.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The only state that a new or reroled turn can lead to.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cost of ending in each state: the turns still to insert.
FINISH = (0, 4, 2, 0)
NOTHING = 1 << 60

_SEEN = r"[^\x20\x09-\x0D]"
_TRUNCATED = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"
_LEGAL = {"su", "ua", "au"}

#: Turns on their way: nulls stay nulls as text, sorting columns of their own keep the numeric order.
KEY = ["conv_id", "turn", "role", "text"]
REPORT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
TURNS = "conv_id string, place long, edit string, role string, text string"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32 of ``conv_id:turn`` deals; a dropped turn leaves a row with ``gone``."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in KEY}
    deal = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    out = rows.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), deal.alias("deal"))
    out = out.withColumn("text", F.when(F.col("deal").isin(0, 1), "").when(F.col("deal") == 2, F.regexp_replace("text", "[.!?]", ""))
                         .otherwise(F.col("text")))
    out = out.withColumn("role", F.when(F.col("deal") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv_id", "turn", "role", "text", (F.col("deal") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def with_faults(turns: DataFrame) -> DataFrame:
    """Dealt by conversation, with the first fault of each turn: B(lank), D(uplicate), T(runcated) or none."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartition(parts, "conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    fault = (F.when(~F.col("text").rlike(_SEEN), "B").when(F.row_number().over(same) > 1, "D")
             .when(F.col("text").rlike(_TRUNCATED), "T").otherwise(""))
    return dealt.withColumn("fault", fault)


def _order(up: bool) -> list[Column]:
    if up:
        return [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("gone")]
    return [F.col("conv_id"), F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("gone")]


def step(after: list[int], initial: str, fault: str) -> tuple[list[int], int]:
    """Costs from each state before a turn, given those after it, and the turn's back pointer."""
    late = TRUNCATED_COST if fault == "T" else 0
    direct, pointer = [], 0
    for state in range(4):
        costs = [COST[DELETE] + after[state], NOTHING, NOTHING, NOTHING]
        if fault not in ("B", "D"):
            kept = NEXT.get(initial, {}).get(state)
            if kept is not None:
                costs[KEEP] = late + after[kept]
            costs[REROLE] = COST[REROLE] + late + after[FOLLOWS[state]]
        direct.append(costs)
    before = [min(c) for c in direct]
    # after an inserted turn: user and assistant reach each other, the other two reach user
    before[USER], before[ASSISTANT] = (min(before[USER], COST[INSERT] + before[ASSISTANT]),
                                       min(before[ASSISTANT], COST[INSERT] + before[USER]))
    for state in range(4):
        costs = direct[state]
        costs[INSERT] = COST[INSERT] + before[FOLLOWS[state]]
        before[state] = min(costs)
        pointer |= costs.index(before[state]) << 2 * state
    return before, pointer


def _back(frames):
    """Add the back pointer to turns that come by conversation, last first."""
    own, after = object(), None
    for pdf in frames:
        pointers = []
        for conv, role, fault, gone in zip(pdf["conv_id"], pdf["role"], pdf["fault"], pdf["gone"]):
            if conv != own:
                own, after = conv, list(FINISH)
            pointer = 0
            if not gone:
                after, pointer = step(after, role[:1], fault)
            pointers.append(pointer)
        yield pdf.assign(pointer=pd.array(pointers, "int16"))


class Conversation:
    """What a conversation's forward stream carries."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost, self.audit, self.done = conv_id, START, 0, [], 0
        self.digest, self.faults, self.illegal, self.last = hashlib.sha256(), {"B": 0, "D": 0, "T": 0, "": 0}, 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def put(self, edit: str, role: str | None, text: str = "") -> tuple | None:
        """One edit: its initial and, unless the turn goes, the repaired turn."""
        self.audit.append(edit)
        if role is None:
            return None
        if self.done:
            self.digest.update(b"\n")
        self.digest.update(f"{role}:{text}".encode())
        self.done += 1
        return self.conv_id, self.done - 1, edit, role, text

    def inserted(self) -> tuple:
        self.state = FOLLOWS[self.state]
        self.cost += COST[INSERT]
        return self.put("I", ROLE[self.state])

    def turn(self, turn, role: str, text: str, fault: str, pointer: int) -> list[tuple]:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial, out = role[:1], []
        self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in _LEGAL
        self.last = initial
        while (edit := pointer >> 2 * self.state & 3) == INSERT:
            out.append(self.inserted())
        self.cost += COST[edit] + (TRUNCATED_COST if fault == "T" and edit != DELETE else 0)
        if edit == DELETE:
            self.put("D", None)
            return out
        if edit == KEEP:
            self.state = NEXT[initial][self.state]
        else:
            self.state = FOLLOWS[self.state]
            role = ROLE[self.state]
        return [*out, self.put(EDITS[edit], role, text)]

    def finish(self) -> list[tuple]:
        out = []
        while self.state in (SYSTEM, USER):
            out.append(self.inserted())
        return out

    def report(self) -> tuple:
        gaps = int(self.last_turn) - int(self.first_turn) + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.faults["B"], self.faults["D"], self.faults["T"], self.illegal, self.cost, "".join(self.audit),
                self.digest.hexdigest())


def _forward(frames, whole: bool):
    """Repaired turns (``whole``) or one report per conversation, of turns that come in order with their back pointers."""
    now, names = None, [x.split()[0] for x in (TURNS if whole else REPORT).split(",")]
    for pdf in frames:
        out = []
        columns = (pdf[c] for c in ("conv_id", "turn", "role", "text", "fault", "gone", "pointer"))
        for conv, turn, role, text, fault, gone, pointer in zip(*columns):
            if now is None or conv != now.conv_id:
                if now is not None:
                    rest = now.finish()
                    out += rest if whole else [now.report()]
                now = Conversation(conv)
            if not gone:
                made = now.turn(turn, role, text, fault, pointer)
                if whole:
                    out += made
        yield pd.DataFrame(out, columns=names)
    if now is not None:
        rest = now.finish()
        yield pd.DataFrame(rest if whole else [now.report()], columns=names)


def _streamed(turns: DataFrame, whole: bool) -> DataFrame:
    """``turns`` has conv_id, turn (a whole number), role, text and gone; none of the last three is null."""
    kind = turns.schema["conv_id"].dataType
    back = with_faults(turns).sortWithinPartitions(*_order(False))
    # whole numbers go through pandas as text, so that nulls stay apart
    text = {c: F.col(c).cast("string") for c in ("conv_id", "turn")}
    plan = "conv_id string, turn string, role string, text string, gone boolean, fault string, pointer short"
    pointed = back.withColumns(text).select("conv_id", "turn", "role", "text", "gone", "fault").mapInPandas(_back, plan)
    ahead = pointed.withColumns({"n": F.col("turn").cast("decimal(38,0)")})
    ahead = ahead.sortWithinPartitions("conv_id", F.asc_nulls_first("n"), "role", "text", "gone").drop("n")
    found = ahead.mapInPandas(lambda f: _forward(f, whole), TURNS if whole else REPORT)
    return found.withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of every repaired turn."""
    return _streamed(turns, True)


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, edits and the digest of the repaired turns."""
    return _streamed(turns, False)


by_value(__name__)
