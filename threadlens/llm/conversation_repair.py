"""Conversation structure repair by a survivor-coalescence Viterbi.

Rows are damaged first by crc32("conv_id:turn") mod 20 (null values read as one space): 0 drops the row, 1 empties its
text, 2 removes its `.`, `!` and `?`, 3 repeats it (same turn), 4 makes its role `user`. A conversation's rows are then
ordered by turn (nulls first; equal turns by role, text). Each row's first fault is blank (no visible character),
duplicate (role and text seen earlier) or truncated (its last visible character is not `.`, `!` or `?`); blank and
duplicate rows must go. These statistics are Spark expressions and windows.

Repair makes the role initials read `(s?(ua)+)?` at least cost: keep 0, re-role to user or assistant 2, delete 3,
insert an empty user or assistant turn 2, and 1 for every truncated row that stays. The automaton has four states
(nothing yet, after s, after u, after a). Rows of one conversation stream in order through one Python task
(`mapInPandas` over partitions by conversation, sorted within); each state keeps one survivor, a node of a backpointer
tree whose parent links are the only references to older nodes, so nodes no survivor reaches are freed. A survivor
dearer than another state's plus what that state pays to follow all its futures (at most 5) is dropped, so the paths
that remain stay close and meet (delete-all, for one, would otherwise live on beside every path). Ties of cost
are broken by the ASCII-least edit string (D delete, I insert, K keep, R re-role); two tied paths into one state are
compared on their complete unresolved suffixes. Once all survivors share an ancestor, the edits up to it are final:
they are emitted (audit letters, repaired lines into the hash) and cut from the tree, so memory holds only the
unresolved stretch, not the conversation.

Results: one row per conversation of the input (null conv_id is one conversation); with no rows left after damage:
zero counts and cost, empty audit and the hash of the empty string. Columns besides conv_id, turn, role and text are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the repair contract.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
VISIBLE = r"[^\x20\x09-\x0D]"
ENDS = ".!?"
LEGAL_PAIRS = ["su", "ua", "au"]

# Automaton over role initials for (s?(ua)+)?: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ACCEPT = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
# REACH[y][x]: what a survivor in state y pays at most to follow any future of state x (insert a, insert u, or delete
# the one system row that x could still keep). A survivor dearer than that can never win nor tie, and is dropped.
REACH = {3: {0: DELETE, 1: 0, 2: INSERT}, 2: {0: INSERT + DELETE, 1: INSERT, 3: INSERT}}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_none, conv, turn, role, text, copy after damage; the conversation key is (conv_none, conv)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key), F.lit(20))
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    rows = conversations.select(
        F.col("conv_id").isNull().alias("conv_none"),
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("kind"),
    )
    rows = rows.filter("kind != 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return rows.drop("kind")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]


def faults(rows: DataFrame) -> DataFrame:
    """Adds `fault` (b, d, t or empty) and `initial` (first character of the role)."""
    conv = ["conv_none", "conv"]
    seen = Window.partitionBy(*conv, "role", "text").orderBy(*_order())
    last = F.regexp_extract("text", f"({VISIBLE})[\\x20\\x09-\\x0D]*$", 1)
    fault = (
        F.when(~F.col("text").rlike(VISIBLE), F.lit("b"))
        .when(F.row_number().over(seen) > 1, F.lit("d"))
        .when(~last.isin(*ENDS), F.lit("t"))
        .otherwise(F.lit(""))
    )
    return rows.withColumns({"fault": fault, "initial": F.left("role", F.lit(1))})


def statistics(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal."""
    conv = ["conv_none", "conv"]
    before = F.lag("initial").over(Window.partitionBy(*conv).orderBy(*_order()))
    pairs = rows.withColumn("_pair", F.concat(before, F.col("initial")))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return pairs.groupBy(*conv).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        count(F.col("fault") == "b").alias("blank"),
        count(F.col("fault") == "d").alias("duplicate"),
        count(F.col("fault") == "t").alias("truncated"),
        count(F.col("_pair").isNotNull() & ~F.col("_pair").isin(*LEGAL_PAIRS)).alias("illegal"),
    )


class Node:
    """An edit on a survivor's path; `line` is the repaired row it yields, if any."""

    __slots__ = ("edit", "line", "parent")

    def __init__(self, edit: str, line: str | None, parent: Node | None):
        self.edit, self.line, self.parent = edit, line, parent


def _suffix(node: Node | None) -> str:
    out = []
    while node is not None and node.edit:
        out.append(node.edit)
        node = node.parent
    return "".join(reversed(out))


def _better(a: tuple[int, Node], b: tuple[int, Node] | None) -> bool:
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    return a[1] is not b[1] and _suffix(a[1]) < _suffix(b[1])


class Repair:
    """Viterbi over one conversation's rows, fed in order; `finish` gives (cost, audit, sha256)."""

    def __init__(self) -> None:
        self.root = Node("", None, None)
        self.states: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.lines = 0

    def _offer(self, states: list, state: int, cost: int, node: Node) -> None:
        if _better((cost, node), states[state]):
            states[state] = (cost, node)

    def _inserts(self) -> None:
        for _ in range(3):  # u then a reaches every state; a third pass finds nothing cheaper
            for state, held in enumerate(list(self.states)):
                if held is None:
                    continue
                for role in "ua":
                    nxt = STEP.get((role, state))
                    if nxt is not None:
                        self._offer(self.states, nxt, held[0] + INSERT, Node("I", f"{NAMES[role]}:", held[1]))

    def row(self, role: str, initial: str, text: str, fault: str) -> None:
        self._inserts()
        extra = TRUNCATED if fault == "t" else 0
        nxt_states: list = [None, None, None, None]
        for state, held in enumerate(self.states):
            if held is None:
                continue
            cost, node = held
            self._offer(nxt_states, state, cost + DELETE, Node("D", None, node))
            if fault in ("b", "d"):
                continue
            to = STEP.get((initial, state))
            if to is not None:
                self._offer(nxt_states, to, cost + KEEP + extra, Node("K", f"{role}:{text}", node))
            for new in "ua":
                to = STEP.get((new, state))
                if to is not None:
                    self._offer(nxt_states, to, cost + REROLE + extra, Node("R", f"{NAMES[new]}:{text}", node))
        self.states = nxt_states
        self._prune()
        self._coalesce()

    def _prune(self) -> None:
        for x, held in enumerate(self.states):
            for y, reach in REACH.items():
                other = self.states[y]
                if held is not None and x in reach and other is not None and held[0] > other[0] + reach[x]:
                    self.states[x] = held = None

    def _emit(self, upto: Node) -> None:
        chain = []
        node = upto
        while node is not None and node is not self.root:
            chain.append(node)
            node = node.parent
        for n in reversed(chain):
            self.audit.append(n.edit)
            if n.line is not None:
                self.hash.update((("\n" if self.lines else "") + n.line).encode("utf-8"))
                self.lines += 1
        upto.parent, upto.edit = None, ""  # the emitted prefix is cut off and freed
        self.root = upto

    def _coalesce(self) -> None:
        """Emits the edits that all survivors share."""
        nodes = [held[1] for held in self.states if held is not None]
        depth = {}
        for n in nodes:
            d, m = 0, n
            while m is not self.root and m is not None:
                d, m = d + 1, m.parent
            depth[id(n)] = d
        ptrs = [(depth[id(n)], n) for n in nodes]
        low = min(d for d, _ in ptrs)
        ptrs = [self._up(n, d - low) for d, n in ptrs]
        while any(p is not ptrs[0] for p in ptrs):
            ptrs = [p.parent for p in ptrs]
        if ptrs[0] is not None and ptrs[0] is not self.root:
            self._emit(ptrs[0])

    @staticmethod
    def _up(node: Node, steps: int) -> Node:
        for _ in range(steps):
            node = node.parent
        return node

    def finish(self) -> tuple[int, str, str]:
        self._inserts()
        best = None
        for state in ACCEPT:
            held = self.states[state]
            if held is not None and _better(held, best):
                best = held
        self._emit(best[1])
        return best[0], "".join(self.audit), self.hash.hexdigest()


def _repair_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations of a partition arrive in order; each is repaired as it streams by."""
    key, repair = None, None
    out: list[tuple] = []

    def close() -> None:
        cost, audit, sha = repair.finish()
        out.append((*key, cost, audit, sha))

    for batch in batches:
        for none, conv, role, initial, text, fault in zip(batch.conv_none, batch.conv, batch.role, batch.initial, batch.text, batch.fault):
            if (none, conv) != key:
                if repair is not None:
                    close()
                key, repair = (bool(none), int(conv)), Repair()
            repair.row(role, initial, text, fault)
        if out:
            yield pd.DataFrame(out, columns=["conv_none", "conv", "cost", "audit", "repaired_sha256"])
            out.clear()
    if repair is not None:
        close()
        yield pd.DataFrame(out, columns=["conv_none", "conv", "cost", "audit", "repaired_sha256"])


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per input conversation."""
    conv = ["conv_none", "conv"]
    rows = faults(damaged(conversations))
    stats = statistics(rows)
    streamed = rows.select(*conv, "turn", "role", "initial", "text", "fault", "copy").repartition(*conv).sortWithinPartitions(*conv, *_order())
    schema = "conv_none boolean, conv bigint, cost bigint, audit string, repaired_sha256 string"
    repaired = streamed.select(*conv, "role", "initial", "text", "fault").mapInPandas(_repair_partition, schema)
    every = conversations.select(F.col("conv_id").isNull().alias("conv_none"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv")).distinct()
    joined = every.join(stats, conv, "left").join(repaired, conv, "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        F.when(~F.col("conv_none"), F.col("conv")).alias("conv_id"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
