"""Repair of conversations whose turns were damaged: the cheapest edits that make the roles alternate.

A repaired conversation is empty, or a system turn that may be missing followed by pairs of user and assistant. Edits: keep (0), give another
role (1), delete (2; the only one for blank and duplicate turns), insert a turn without text (5); a truncated turn that stays costs 5
more. Of the cheapest edits those whose initials (K, R, D, I) come first in ASCII order count; the roles follow from the initials.

The dynamic program has four states: nothing yet, a system turn, a user turn or an assistant turn at the end. Edits so far are nodes that share
their prefixes (``Audits``). Turns are dealt by ranges of (conversation, turn), so a long conversation lies in several tasks: each
solves its run of turns for every state the run can begin in, and the runs of a conversation are then joined in order. Two audits
of one cost over the same turns are never a proper prefix of each other, as the longer one would have more insertions, so
the least audit to each state is all that the rest needs.

Memory of a task is bounded by the edits of its run, four states to a turn, and by the audit of a conversation, a byte or so a turn. Texts
stream through the checksum, which is sequential by its nature, so one task reads the repaired turns of one conversation.

Defined results: a null role or text is one space; an empty role has no initial and cannot be kept; turns with equal number go by
role, then text; a null number comes first; a null conversation is a conversation; equal rows count as often as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ponloom.llm.frames import null_safe_join
from ponloom.operators.lineage import stored

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What a turn that is inserted or given another role becomes after each state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Initials of neighbours that may follow each other.
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Audits:
    """Strings of edits that share prefixes: a node is one letter after a parent node; node 0 is the empty string.

    Nodes are found again by the rolling hash of their string. A hit is verified by parent and letter, so two nodes are the same
    exactly if their strings are. Each node knows its ancestors 1, 2, 4, ... letters back.
    """

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]
        self.known: dict[int, list[int]] = {}

    def add(self, node: int, letter: str) -> int:
        h = (self.hash[node] * _BASE + ord(letter)) % _PRIME
        same = self.known.setdefault(h, [])
        for other in same:
            if self.up[other][0] == node and self.letter[other] == letter:
                return other
        back = [node]
        while len(self.up[back[-1]]) >= len(back):
            back.append(self.up[back[-1]][len(back) - 1])
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(h)
        self.up.append(tuple(back))
        same.append(len(self.letter) - 1)
        return same[-1]

    def ancestor(self, node: int, depth: int) -> int:
        while (rest := self.depth[node] - depth) > 0:
            node = self.up[node][rest.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``, by the letters after their longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and self.up[x][k] != self.up[y][k]:
                x, y = self.up[x][k], self.up[y][k]
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


class Run:
    """Cheapest edits of a run of turns from one state to each state, as (cost, node)."""

    def __init__(self, entry: int):
        self.audits = Audits()
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.best[entry] = (0, 0)

    def _offer(self, states: list, state: int, cost: int, node: int, letter: str) -> None:
        old = states[state]
        if old is not None and old[0] < cost:
            return
        node = self.audits.add(node, letter)
        if old is None or cost < old[0] or self.audits.less(node, old[1]):
            states[state] = (cost, node)

    def insert(self) -> None:
        """Insertions before the next turn. Two that end where they began are never cheapest."""
        before = list(self.best)
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if before[state] is not None:
                self._offer(self.best, USER, before[state][0] + INSERT, before[state][1], "I")
        if self.best[USER] is not None:
            self._offer(self.best, ASSISTANT, self.best[USER][0] + INSERT, self.best[USER][1], "I")

    def turn(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.insert()
        after: list[tuple[int, int] | None] = [None] * 4
        stay = TRUNCATED if truncated else 0
        for state, found in enumerate(self.best):
            if found is None:
                continue
            cost, node = found
            self._offer(after, state, cost + DELETE, node, "D")
            if must_go:
                continue
            if initial == "s" and state == NOTHING:
                self._offer(after, SYSTEM, cost + stay, node, "K")
            # A turn that can stay is never given its own role.
            if initial == ROLE[NEXT[state]][0]:
                self._offer(after, NEXT[state], cost + stay, node, "K")
            else:
                self._offer(after, NEXT[state], cost + stay + REROLE, node, "R")
        self.best = after


#: Turns of a run, at most: a long conversation is several runs, which bounds the edits a task holds.
RUN = 4096
_TURN = "conv, turn, initial, copies, blank, first, truncated"
_EDIT = T.StructType([T.StructField(c, kind()) for c, kind in (("entry", T.IntegerType), ("end", T.IntegerType), ("cost", T.LongType), ("audit", T.StringType))])
_RUN = T.StructType([
    T.StructField("part", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in ("nth", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")],
    T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()), T.StructField("edits", T.ArrayType(_EDIT)),
])
_FOUND = [
    *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
]


class _Open:
    """A run of turns while its rows come."""

    def __init__(self, conv, entries: tuple[int, ...]):
        self.conv, self.size, self.runs = conv, 0, {e: Run(e) for e in entries}
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None

    def row(self, turn, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
        self.first_turn = turn if self.first_turn is None else self.first_turn
        self.last_turn = turn if turn is not None else self.last_turn
        for fault, is_so in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
            self.counts[fault] += is_so
        self.counts["illegal"] += self.size > 0 and self.last_initial + initial not in LEGAL
        self.first_initial = initial if self.size == 0 else self.first_initial
        self.last_initial = initial
        self.size += 1
        for run in self.runs.values():
            run.turn(initial, blank or duplicate, truncated)

    def record(self, part: int, nth: int) -> dict:
        edits = [{"entry": e, "end": s, "cost": found[0], "audit": run.audits.text(found[1])}
                 for e, run in self.runs.items() for s, found in enumerate(run.best) if found is not None]
        run = {c: getattr(self, c) for c in ("first_turn", "last_turn", "first_initial", "last_initial")}
        return {"conv": self.conv, "run": {"part": part, "nth": nth, **self.counts, "edits": edits, **run}}


def _solved(turns: DataFrame) -> DataFrame:
    """Runs of turns, one or more a conversation: their faults and cheapest edits."""
    schema = T.StructType([T.StructField("conv", turns.schema["conv"].dataType), T.StructField("run", _RUN)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, now, anywhere = TaskContext.get().partitionId(), 0, None, (NOTHING, SYSTEM, USER, ASSISTANT)
        for batch in batches:
            done = []
            for conv, turn, initial, copies, blank, first, truncated in zip(*(c.to_pylist() for c in batch.columns)):
                for n in range(copies):
                    same = now is not None and conv == now.conv
                    if not same or now.size == RUN:
                        if now is not None:
                            done.append(now.record(part, nth))
                            nth += 1
                        # Only the first run of a task, and one that was cut, can go on from another; the rest begin a conversation.
                        now = _Open(conv, anywhere if now is None or same else (NOTHING,))
                    duplicate = not blank and not (first and n == 0)
                    now.row(turn, initial, blank, duplicate, truncated and not blank and not duplicate)
            if done:
                yield pa.RecordBatch.from_pylist(done, arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.record(part, nth)], arrow)

    ordered = ["conv", "turn", "role", "text"]
    sorted_ = turns.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    return sorted_.select(*_TURN.split(", ")).mapInArrow(run, schema)


class _Digest:
    """Checksum of the repaired turns of a conversation, from its audit and its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sum, self.empty = audit, 0, NOTHING, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.sum.update(("" if self.empty else "\n").encode() + f"{role}:".encode() + text.encode("utf-8", "surrogatepass"))
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = NEXT[self.state]
            self._put(ROLE[self.state], "")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self._inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "D":
                continue
            self.state = SYSTEM if letter == "K" and role[:1] == "s" else NEXT[self.state]
            self._put(role if letter == "K" else ROLE[self.state], text)

    def end(self) -> str:
        self._inserted()
        return self.sum.hexdigest()


class _Fold:
    """Counts, cost and audit of a conversation, from its runs as they come in order."""

    def __init__(self):
        self.best: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.turns, self.low, self.high, self.last_initial = 0, None, None, None

    def add(self, run: dict) -> None:
        for c in self.counts:
            self.counts[c] += run[c]
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + run["first_initial"] not in LEGAL
        self.last_initial = run["last_initial"]
        self.turns += run["turns"]
        if run["first_turn"] is not None:
            self.turns -= run["first_turn"] == self.high
            self.low, self.high = run["first_turn"] if self.low is None else self.low, run["last_turn"]
        after: dict[int, tuple[int, str]] = {}
        for e in run["edits"]:
            if e["entry"] in self.best:
                cost, audit = self.best[e["entry"]]
                offer = (cost + e["cost"], audit + e["audit"])
                after[e["end"]] = min(after.get(e["end"], offer), offer)
        self.best = after

    def result(self) -> dict:
        last = [(NOTHING, 0), (ASSISTANT, 0), (SYSTEM, 2), (USER, 1)]
        cost, audit = min((self.best[s][0] + n * INSERT, self.best[s][1] + "I" * n) for s, n in last if s in self.best)
        return {"gaps": 0 if self.low is None else self.high - self.low + 1 - self.turns, **self.counts, "cost": cost, "audit": audit}


def _repaired(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """One row a conversation. Its runs come before its turns, so that only the audit is held while the turns pass."""
    schema = T.StructType([turns.schema["conv"], *_FOUND])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fold, digest, found = (), None, None, {}

        def closed() -> dict:
            return {"conv": now[0], **found, "repaired_sha256": digest.end()}

        for batch in batches:
            done = []
            for conv, part, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (conv,):
                    if now:
                        done.append(closed())
                    now, fold, digest = (conv,), _Fold(), None
                if part is not None:
                    fold.add(part)
                    continue
                if digest is None:
                    found = fold.result()
                    digest = _Digest(found["audit"])
                digest.row(role, text, copies)
            if done:
                yield pa.RecordBatch.from_pylist(done, arrow)
        if now:
            yield pa.RecordBatch.from_pylist([closed()], arrow)

    both = runs.selectExpr("conv", "run").unionByName(turns.select("conv", "turn", "role", "text", "copies"), allowMissingColumns=True)
    # The turns of a conversation come after its runs, these in the order of their tasks.
    ordered = both.repartition("conv").sortWithinPartitions("conv", F.col("run").isNull(), F.col("run.part"), F.col("run.nth"), "turn", "role", "text")
    return ordered.select("conv", "run", "role", "text", "copies").mapInArrow(run, schema)


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, copies) after a damage that a checksum of conversation and turn chooses, one of twenty each: the
    row goes (copies 0), loses its text, loses its ends of sentences, comes twice, or becomes the user's."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(name(conv_col), F.lit(":"), name(turn_col)).cast("binary")) % 20
    text = name(text_col)
    return conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(name(role_col)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair(turns: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation of (conv, turn, role, text, copies).

    One row a ``conv``: gaps in the turn numbers; turns that are blank, duplicate (role and text came before) or truncated, by their
    first fault; neighbours whose roles do not follow each other (illegal); cost, audit and the SHA-256 of the repaired turns, as
    ``role:text`` joined by line ends. A conversation of which every turn has no copies has zeros, an empty audit and the checksum of an
    empty text.
    """
    whole = turns.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # Equal role and text, by a digest that keeps keys short.
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    whole = stored(whole.withColumn("same", key), "turns")
    present = whole.where("copies > 0")
    seen = present.groupBy("conv", "same").agg(F.min("turn").alias("lowest"), F.max(F.col("turn").isNull()).alias("unnumbered"))
    first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("lowest"))
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = null_safe_join(present, seen, ["conv", "same"]).select(
        "conv", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"), F.col("copies").cast("long").alias("copies"),
        (end == "").alias("blank"), first.alias("first"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    marked = stored(marked, "marked-turns")
    done = _repaired(marked, stored(_solved(marked), "runs"))
    none = whole.groupBy("conv").agg(F.max("copies").alias("most")).where("most = 0").selectExpr(
        "conv", *[f"CAST(0 AS bigint) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], "'' AS audit",
        "sha2('', 256) AS repaired_sha256")
    return done.unionByName(none)
