"""Repair of damaged conversations by a shortest path over scalar integer weights.

A legal conversation has the roles ``(s?(ua)+)?``: maybe a system turn, then user and assistant
in turns. Each row may be kept, get another role or be deleted, and empty turns may be
inserted; the cheapest edits win and, of equally cheap ones, those whose initials
(``audit``) come first in ASCII order.

One integer holds both. Its high digits are the cost. Each row owns ``SLOT`` low octal digits at a
fixed place: the letters of the insertions before the row and then that of the row's own edit, left-aligned,
zeros at the end. No slot's letters begin another slot's, so comparing slots compares
the joined letters, and in the last slot (insertions after all rows) zero padding makes the shorter text come
first. Weights just add up, and an ordinary minimum over the states of the role pattern
decides cost, ties and audit; the letters are read from the digits of the least sum.

Digits cover a block of ``BLOCK_ROWS`` rows. Between blocks only the rank of a state's digits
matters, so it becomes the next block's leading digit. States that can't win any more are dropped; once all others
come from one state of an earlier block, everything up to there is decided, hashed and forgotten, so a task
holds a few blocks, however long a conversation is. Faults that need other rows (a text seen
in an earlier turn) are found by Spark before. The digest of a conversation's text is sequential by its
nature, hence a conversation is read by one task, sorted, in batches.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martlet.llm.tables import store, task

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Octal digits of the letters, in ASCII order; zero is padding.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {v: k for k, v in DIGITS.items()}
SLOT = 3                                              # two insertions at most and the row's edit
BLOCK_ROWS, BLOCK_CHARS = 256, 1 << 22
ROLE = {"u": "user", "a": "assistant"}
#: States of the role pattern: nothing yet, after s, after u, after a; and where each initial leads.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (EMPTY, ASSISTANT)
#: (row's fault) 0 none, 1 blank, 2 duplicate, 3 truncated
NONE, BLANK, DUPLICATE, CUT = range(4)
SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _code(letters: str) -> int:
    out = 0
    for i in range(SLOT):
        out = out * 8 + (DIGITS[letters[i]] if i < len(letters) else 0)
    return out


def _insertions() -> dict:
    """state -> [(state after, letters, cost)]: ways to insert without coming back to a state, which would only cost."""
    out = {}
    for s in range(4):
        ways, state, seen = [(s, "", 0)], s, {s}
        while True:
            state = STEP.get((state, "u"), STEP.get((state, "a")))
            if state in seen:
                break
            seen.add(state)
            ways.append((state, ways[-1][1] + "I", ways[-1][2] + INSERT))
        out[s] = ways
    return out


_INSERT = _insertions()


def _edges(initial: str, fault: int) -> list:
    """(state before, state after, cost, slot code) of one row."""
    best = {}
    for s, ways in _INSERT.items():
        for mid, letters, cost in ways:
            edits = [("D", mid, DELETE)]
            if fault in (NONE, CUT):
                more = TRUNCATED if fault == CUT else 0
                edits += [("K", STEP.get((mid, initial)), KEEP + more)]
                edits += [("R", STEP.get((mid, r)), REROLE + more) for r in ROLE]
            for letter, after, price in edits:
                if after is not None:
                    e = (cost + price, _code(letters + letter))
                    best[s, after] = min(best.get((s, after), e), e)
    return [(s, t, c, code) for (s, t), (c, code) in best.items()]


_EDGES = {(i, f): _edges(i, f) for i in ("s", "u", "a", "") for f in (NONE, BLANK, DUPLICATE, CUT)}
_LAST = [(s, t, cost, _code(letters)) for s, ways in _INSERT.items() for t, letters, cost in ways if t in FINAL]


def _letters(code: int) -> str:
    return "".join(LETTERS[d] for d in (code >> 6 & 7, code >> 3 & 7, code & 7) if d)


class Repair:
    """Shortest path through one conversation's rows, fed in order; ``letters(row, text of its slot)`` come out in order."""

    def __init__(self, emit):
        self.emit = emit
        self.start = {EMPTY: 0}                       # state -> cost at the block's start
        self.rank = {EMPTY: 0}                        # state -> rank of its digits there
        self.rows, self.chars = [], 0
        self.open = []                                # undecided blocks: (rows, {state: (state before, [slot letters])})

    def add(self, row, initial: str, fault: int, chars: int = 0) -> None:
        self.rows.append((row, initial if initial in ("s", "u", "a") else "", fault))
        self.chars += chars
        if len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS:
            self._block()

    def _weights(self, slots: int) -> tuple[dict, int]:
        width = 3 * SLOT * slots + 3                  # rank, then the slots
        by_rank = {s: (self.start[s] << width) + (r << width - 3) for s, r in self.rank.items()}
        return by_rank, width

    def _walk(self, slots: int) -> tuple[dict, int]:
        weight, width = self._weights(slots)
        place = width - 3
        for _, initial, fault in self.rows:
            place -= 3 * SLOT
            after = {}
            for s, t, cost, code in _EDGES[initial, fault]:
                if s in weight:
                    w = weight[s] + (cost << width) + (code << place)
                    if t not in after or w < after[t]:
                        after[t] = w
            weight = after
        return weight, width

    def _split(self, w: int, width: int, slots: int) -> tuple[int, int, list]:
        """(cost, state before the block, letters of each slot) of a weight."""
        rank = w >> width - 3 & 7
        before = next(s for s, r in self.rank.items() if r == rank)
        return w >> width, before, [_letters(w >> 3 * SLOT * (slots - 1 - i) & 511) for i in range(slots)]

    def _block(self) -> None:
        slots = len(self.rows)
        weight, width = self._walk(slots)
        cost = {s: w >> width for s, w in weight.items()}
        most = {EMPTY: 4, SYSTEM: 0, USER: 3}         # what reaching the assistant's state may still cost against this state
        if ASSISTANT in cost:
            weight = {s: w for s, w in weight.items() if s == ASSISTANT or cost[s] <= cost[ASSISTANT] + most[s]}
        if USER in weight and ASSISTANT in weight and cost[ASSISTANT] > cost[USER] + INSERT:
            del weight[ASSISTANT]
        self.open.append((self.rows, {s: self._split(w, width, slots)[1:] for s, w in weight.items()}))
        low = sorted((w & (1 << width) - 1, s) for s, w in weight.items())
        self.start = {s: cost[s] for s in weight}
        self.rank = {s: r for r, (_, s) in enumerate(low)}
        self.rows, self.chars = [], 0
        alive = set(weight)
        for i in range(len(self.open) - 1, -1, -1):
            if len(alive) == 1:
                self._decide(i, alive.pop())
                return
            alive = {self.open[i][1][s][0] for s in alive}

    def _decide(self, last: int, state: int) -> None:
        """Give out the blocks up to number ``last``, which ends in ``state``."""
        path = []
        for i in range(last, -1, -1):
            rows, ends = self.open[i]
            state, letters = ends[state]
            path.append((rows, letters))
        for rows, letters in reversed(path):
            for (row, _, _), text in zip(rows, letters):
                self.emit(row, text)
        del self.open[:last + 1]

    def end(self) -> int:
        """Decide the rest; the cost of all edits."""
        slots = len(self.rows) + 1
        weight, width = self._walk(slots)
        least = min(weight[s] + (cost << width) + code for s, _, cost, code in _LAST if s in weight)
        cost, state, letters = self._split(least, width, slots)
        if self.open:
            self._decide(len(self.open) - 1, state)
        for (row, _, _), text in zip(self.rows, letters):
            self.emit(row, text)
        self.emit(None, letters[-1])
        return cost


class _Conversation:
    """Counts, edits and digest of one conversation, whose rows come in order."""

    def __init__(self, conv_id):
        self.conv_id, self.sha, self.audit, self.roles = conv_id, hashlib.sha256(), [], 0
        self.faults = [0, 0, 0, 0]
        self.low = self.high = self.turn = None
        self.turns = self.illegal = 0
        self.last = self.before = None                # initial, and (turn, role, text), of the row before
        self.repair = Repair(self._edit)

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        row = (turn, role, text)
        if fault in (NONE, CUT) and row == self.before:
            fault = DUPLICATE
        self.before = row
        self.faults[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.repair.add(row, initial, fault, len(text))

    def _out(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.roles else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.roles += 1
        self.next = "a" if role[:1] == "u" else "u"

    next = "u"

    def _edit(self, row, letters: str) -> None:
        self.audit.append(letters)
        for letter in letters:
            if letter == "I":
                self._out(ROLE[self.next], "")
            elif letter == "R":
                self._out(ROLE[self.next], row[2])
            elif letter == "K":
                self._out(row[1], row[2])

    def end(self) -> tuple:
        cost = self.repair.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit), self.sha.hexdigest())


_OUT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _repaired(batches):
    """Rows in the order of conversations and turns -> one row a conversation."""
    now, done = None, []
    for batch in batches:
        for conv_id, turn, role, text, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")]):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.end())
                now = _Conversation(conv_id)
            if fault is not None:                     # a dropped row only tells that the conversation is there
                now.add(turn, role, text, fault)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _OUT)], schema=_OUT)
            done = []
    if now is not None:
        done.append(now.end())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _OUT)], schema=_OUT)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) after the damage that crc32 of ``conv_id:turn``, modulo 20, says.

    0 drops the row (its role and text are null), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's. Nulls
    count as one space.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = rows.withColumn("kind", kind).withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    dropped = F.col("kind") == 0
    new_text = F.when(dropped, None).when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    new_role = F.when(dropped, None).when(F.col("kind") == 4, ROLE["u"]).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", new_role.alias("role"), new_text.alias("text"), dropped.alias("dropped"))


def _fault(earlier: Column) -> Column:
    """Fault of a row; repetitions inside one turn are seen only once rows are sorted."""
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    return (F.when(solid == "", BLANK).when(earlier, DUPLICATE)
            .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), CUT).otherwise(NONE))


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a conversation.

    ``rows`` has conv_id, turn, role, text, and maybe ``dropped`` (rows that only keep their conversation in the result); other
    columns are ignored. A conversation's rows are taken by turn, nulls first, then by role and text; equal
    rows of a turn stand side by side. A null role or text counts as one space, rows without conv_id are
    one conversation. Only the first character of a role decides its place; a role with another initial than s, u or a, or
    none, can't be kept. A conversation without rows has zeros, an empty audit and the digest of the empty text; so has the text
    of one whose rows are all deleted. An empty table gives an empty result. Long texts and long
    conversations pass through a task in batches.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    gone = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), gone.alias("dropped"))
    rows = rows.withColumn("at", F.struct(F.col("turn").isNotNull().cast("int").alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("t")))
    told = F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    seen = rows.filter("not dropped").select("conv_id", "at", told.alias("told")).groupBy("conv_id", "told").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    seen = store(seen.filter("first < last").select(F.col("conv_id").alias("of"), "told", "first"), "repeated-turns")
    marked = rows.withColumn("digest", told).join(seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("told")), "left")
    faulty = marked.select("conv_id", "turn", "role", "text", F.when(~F.col("dropped"), _fault(F.coalesce(F.col("at") > F.col("first"), F.lit(False)))).alias("fault"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return faulty.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(task(_repaired), SCHEMA)
