"""Conversation repair: the cheapest edits after which roles alternate, by Knuth's lightest-derivation agenda.

Rows of a conversation stand in order of their turns. Each has at most one fault, the first of: blank (nothing but
ASCII white space), duplicate (its role and text stood earlier), truncated (it doesn't end with one of ``.!?``). Edits are Keep (0),
Rerole to user or assistant (2), Delete (3; a must for blank and duplicate rows) and Insert an empty turn of either
(2). A truncated row that stays costs 1 more. What remains is nothing, or user and assistant in turn, after a system turn or without.

Deduction. Items are At(i, q), the first i rows are edited and the roles so far lead to state q, and the edits of each row,
which are axioms. At(i, q) and an edit of row i prove At(i + 1, q'); At(i, q) and an insertion prove At(i, q').
An item weighs (cost, audit), the audit being the initials of the edits in order. A deduction adds costs and joins audits: never
less than what it joins, and monotone in both, as audits of the same rows and cost are never each other's
beginning (the longer one would have more insertions). So the lightest item on the agenda is final when popped, and
the agenda ends when the goal is. Of the cheapest repairs that leaves the one with the ASCII-least audit.

Long conversations. Conversations of up to ``limit`` rows are grouped by their id. Longer ones are split over tasks: equal rows are
counted, the rows range-partitioned by turn, and every piece of ``PIECE`` rows gets its lightest derivations from
each state to each; these are joined in order, by the same sums. Only the joining and the hash of the repaired text, which is
defined over all of it in sequence, run along the whole conversation, as a stream that holds one batch and the audit.

Edge cases: NULL roles and texts are one space, NULL turns come first, a NULL id is one conversation. Rows with equal turns
are ordered by role, then by md5 of their text. A role counts by its first character; one that is empty or begins otherwise than
s, u, a is never kept. Conversations of any length, empty tables and repeated rows are taken as they are; extra columns
are ignored. A conversation whose rows all go has an empty ``repaired``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import groupby, repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from martloom.llm.common import staged

# An item holds its audit, so a derivation takes memory by the square of its rows.
LIMIT = 2000
PIECE = 512

# White space, ends of whole texts, role initials that may follow each other.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after system, after user, after assistant. What leads from one to another, and the next turn that may be added.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ADDED = ("u", "u", "a", "u")
_STATES, _ENDS = 4, (0, 3)
_NAMES = {"u": "user", "a": "assistant"}
_ANY = "?"

# An edit: cost, letters, role initial of the turn it leaves (None: nothing; _ANY: the one that may be added).
Edit = tuple[int, str, str | None]
_INSERT: Edit = (2, "I", _ANY)
_DELETE: Edit = (3, "D", None)


def edits_of(initial: str, fault: str | None) -> list[Edit]:
    if fault in ("blank", "duplicate"):
        return [_DELETE]
    extra = int(fault == "truncated")
    return [(extra, "K", initial), _DELETE, (2 + extra, "R", _ANY)]


def _reached(state: int, emitted: str | None) -> int | None:
    if emitted is None:
        return state
    return _NEXT.get((state, _ADDED[state] if emitted == _ANY else emitted))


def derive(rows: list[list[Edit]], start: int = 0) -> Iterator[tuple[int, tuple[int, str]]]:
    """(state, weight) of the items over all rows, lightest first."""
    agenda: list = [(0, "", 0, 0, start)]  # weight, then the item: At(row, state), or (1, row, edit), or (2, -, -) the insertion
    for i, edits in enumerate(rows):
        for k, (cost, letters, _) in enumerate(edits):
            heappush(agenda, (cost, letters, 1, i, k))
    heappush(agenda, (_INSERT[0], _INSERT[1], 2, 0, 0))
    final: list[dict[int, tuple[int, str]]] = [{} for _ in range(len(rows) + 1)]
    known: list[list[Edit]] = [[] for _ in range(len(rows) + 1)]
    inserting = False

    def prove(i: int, state: int, weight: tuple[int, str], edit: Edit, to: int) -> None:
        reached = _reached(state, edit[2])
        if reached is not None and reached not in final[to]:
            heappush(agenda, (weight[0] + edit[0], weight[1] + edit[1], 0, to, reached))

    while agenda:
        cost, letters, kind, i, x = heappop(agenda)
        if kind == 1:
            edit = rows[i][x]
            known[i].append(edit)
            for state, weight in final[i].items():
                prove(i, state, weight, edit, i + 1)
        elif kind == 2:
            inserting = True
            for at, items in enumerate(final):
                for state, weight in list(items.items()):
                    prove(at, state, weight, _INSERT, at)
        elif x not in final[i]:
            weight = final[i][x] = (cost, letters)
            if i == len(rows):
                yield x, weight
            for edit in known[i]:
                prove(i, x, weight, edit, i + 1)
            if inserting:
                prove(i, x, weight, _INSERT, i)


def lightest(rows: list[list[Edit]]) -> tuple[int, str]:
    """(cost, audit) of the goal: all rows edited, and the turns that are left may end."""
    return next(weight for state, weight in derive(rows) if state in _ENDS)


def between(rows: list[list[Edit]]) -> list[list[tuple[int, str] | None]]:
    """The lightest weight from each state to each over a piece; None where there is no way."""
    ways = [dict(derive(rows, start)) for start in range(_STATES)]
    return [[way.get(end) for end in range(_STATES)] for way in ways]


def repaired(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The turns (role, text) that an audit's edits leave."""
    letters, state = iter(audit), 0

    def added(text: str) -> tuple[str, str]:
        nonlocal state
        initial = _ADDED[state]
        state = _NEXT[state, initial]
        return _NAMES[initial], text

    for role, text in rows:
        letter = next(letters)
        while letter == "I":
            yield added("")
            letter = next(letters)
        if letter == "K":
            state = _NEXT[state, role[:1]]
            yield role, text
        elif letter == "R":
            yield added(text)
    for _ in letters:
        yield added("")


def fault_of(text: str, again: bool) -> str | None:
    end = text.rstrip(BLANKS)[-1:]
    if not end:
        return "blank"
    return "duplicate" if again else "truncated" if end not in ENDS else None


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


class _Tally:
    """Counts over rows in order, which can be continued by those of the rows after them."""

    def __init__(self):
        self.faults = dict.fromkeys(_COUNTS, 0)
        self.turns, self.first, self.least, self.most = 0, None, None, None
        self.before, self.begins = None, None

    def add(self, initial: str, turn: int | None, fault: str | None, copies: int = 1) -> None:
        if fault:
            self.faults[fault] += copies if fault == "blank" else 1
        if fault != "blank":
            self.faults["duplicate"] += copies - 1
        if self.before is None:
            self.begins = initial
        else:
            self.faults["illegal"] += self.before + initial not in LEGAL
        self.faults["illegal"] += copies - 1
        self.before = initial
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn

    @property
    def gaps(self) -> int:
        return self.most - self.least + 1 - self.turns if self.turns else 0


_SHAPE = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_REPAIR = f"gaps bigint, {_SHAPE}, repaired array<struct<role: string, text: string>>, repaired_sha256 string"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _peeked(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of the first column, and all batches."""
    first = next(batches, None)
    if first is None:
        return None, iter(())

    def all_() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    return first.column(0).type, all_()


_RESULT_TYPES = [pa.int64()] * 6 + [pa.string(), _TURNS, pa.string()]
_RESULT_NAMES = ["gaps", *_COUNTS, "cost", "audit", "repaired", "repaired_sha256"]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations one after another, each at most LIMIT rows."""
    kind, batches = _peeked(batches)

    def one(conv, rows: Iterator[tuple]) -> tuple:
        tally, seen, turns, edits = _Tally(), set(), [], []
        for _, turn, role, text in rows:
            stamp = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            fault = fault_of(text, stamp in seen)
            seen.add(stamp)
            tally.add(role[:1], turn, fault)
            turns.append((role, text))
            edits.append(edits_of(role[:1], fault))
        cost, audit = lightest(edits)
        left = [{"role": r, "text": t} for r, t in repaired(audit, turns)]
        return conv, tally.gaps, *tally.faults.values(), cost, audit, left, None

    found = (one(conv, rows) for conv, rows in groupby(_streamed(batches), key=lambda r: r[0]))
    yield from _batches(found, ["conv_id", *_RESULT_NAMES], [kind, *_RESULT_TYPES], 200)


_WAYS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_PIECE_TYPES = [pa.int64()] * 8 + [pa.string(), pa.string(), _WAYS]
_PIECE_NAMES = ["place", *_COUNTS, "turns", "least", "most", "begins", "ends", "ways"]
_PIECE_DDL = (
    "place bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, least bigint, most bigint,"
    " begins string, ends string, ways array<struct<cost: bigint, audit: string>>"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts and derivations of each run of PIECE rows of a conversation."""
    kind, batches = _peeked(batches)

    def cut() -> Iterator[tuple]:
        for conv, rows in groupby(_streamed(batches), key=lambda r: r[0]):
            for _, piece in groupby(enumerate(rows), key=lambda r: r[0] // PIECE):
                yield one(conv, (r for _, r in piece))

    def one(conv, rows: Iterator[tuple]) -> tuple:
        tally, edits, first = _Tally(), [], None
        for _, place, turn, role, text, copies, again in rows:
            first = place if first is None else first
            fault = fault_of(text, again)
            tally.add(role[:1], turn, fault, copies)
            edits.append(edits_of(role[:1], fault))
            if copies > 1:
                edits.append([(3 * (copies - 1), "D" * (copies - 1), None)])
        ways = [None if w is None else {"cost": w[0], "audit": w[1]} for way in between(edits) for w in way]
        return conv, first, *tally.faults.values(), tally.turns, tally.least, tally.most, tally.begins, tally.before, ways

    yield from _batches(cut(), ["conv_id", *_PIECE_NAMES], [kind, *_PIECE_TYPES], 50)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's pieces in order, then its rows in order, to its result; the rows are only streamed."""
    kind, batches = _peeked(batches)

    def one(conv, rows: Iterator[tuple]) -> tuple:
        faults, turns, least, most, before = dict.fromkeys(_COUNTS, 0), 0, None, None, None
        best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
        kept: Iterator[tuple[str, str]] | None = None
        digest = hashlib.sha256()
        for is_row, part in groupby(rows, key=lambda r: r[1]):
            if not is_row:
                for _, _, _, *counts, n, low, high, begins, ends, ways, _, _, _ in part:
                    faults = {k: faults[k] + c for k, c in zip(_COUNTS, counts)}
                    faults["illegal"] += before is not None and before + begins not in LEGAL
                    before = ends
                    if n:
                        turns += n - (low == most)
                        least, most = low if least is None else least, high
                    ways = [w and (w["cost"], w["audit"]) for w in ways]
                    steps = [[(a, ways[q * _STATES + end]) for q, a in enumerate(best)] for end in range(_STATES)]
                    best = [min(((a[0] + w[0], a[1] + w[1]) for a, w in s if a and w), default=None) for s in steps]
                continue
            cost, audit = min(w for q in _ENDS if (w := best[q]))
            for i, (role, text) in enumerate(repaired(audit, (turn for r in part for turn in repeat(r[-3:-1], r[-1])))):
                digest.update((f"\n{role}:{text}" if i else f"{role}:{text}").encode())
        gaps = most - least + 1 - turns if turns else 0
        return conv, gaps, *faults.values(), cost, audit, kept, digest.hexdigest()

    found = (one(conv, rows) for conv, rows in groupby(_streamed(batches), key=lambda r: r[0]))
    yield from _batches(found, ["conv_id", *_RESULT_NAMES], [kind, *_RESULT_TYPES], 1)


def _in_pieces(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of any length, split over tasks."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("stamp", F.md5("text"))
    first = once.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("stamp").alias("_stamp"))
    first = first.agg(F.min("turn").alias("_least"), F.max(F.col("turn").isNull()).alias("_none"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("stamp") == F.col("_stamp"))
    again = F.when(F.col("_none"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_least"))
    flagged = once.join(first, same).withColumn("again", again)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("stamp").asc()]
    placed = flagged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = staged(placed.select("conv_id", "place", "turn", "role", "text", "copies", "again"))
    ordered = placed.repartitionByRange("place").sortWithinPartitions("place")
    pieces = staged(ordered.mapInArrow(_pieces, f"conv_id {kind}, {_PIECE_DDL}"))
    both = pieces.select("conv_id", F.lit(False).alias("is_row"), *_PIECE_NAMES).unionByName(
        placed.select("conv_id", F.lit(True).alias("is_row"), "place", "role", "text", "copies"), allowMissingColumns=True
    )
    together = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "place")
    return together.mapInArrow(_joined, f"conv_id {kind}, {_REPAIR}")


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per conversation: conv_id, gaps in its turns, its faults, cost and audit of the repair, and the outcome.

    ``repaired`` has the turns that are left, (role, text); for conversations of over ``limit`` rows, which are
    not held together, it is NULL and ``repaired_sha256`` has the hash of its ``role:text`` lines instead.
    """
    source = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )
    kind = source.schema["conv_id"].dataType.simpleString()
    long = source.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    long = staged(long.select(F.col("conv_id").alias("_long")))
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    none_long = long.isEmpty()
    short = source if none_long else source.join(long, is_long, "left_anti")
    dealt = short.repartition("conv_id").withColumn("stamp", F.md5("text"))
    dealt = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "stamp").drop("stamp")
    done = dealt.mapInArrow(_whole, f"conv_id {kind}, {_REPAIR}")
    if none_long:
        return done
    return done.union(_in_pieces(source.join(long, is_long, "left_semi"), kind))


def repaired_text(turns: Column) -> Column:
    """The ``role:text`` lines of an array of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
