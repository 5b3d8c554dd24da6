"""Conversation repair: the cheapest edits that give turns the form `(s?(ua)+)?`.

s, u and a are first letters of roles: an optional system turn, then pairs of a user's and an
assistant's turn. Edits of a row are Keep (0), Rerole to user or assistant (3) and Delete (4);
Insert (3) puts an empty turn of the user or the assistant anywhere. Blank rows and rows seen
before must be deleted; a truncated row that stays costs 3 more. Among the cheapest sequences
the one whose letters (D, I, K, R) come first in ASCII is taken.

The search is a Viterbi pass over four states: nothing kept so far, last kept a system turn,
a user's, an assistant's. Survivors are leaves of a tree of back pointers with reference
counts. Once all survivors descend from one child of the root, that child's edit is decided,
emitted and forgotten, so memory follows the undecided suffix and not the conversation. Equal
costs compare the complete undecided suffixes. A survivor goes when another one can do
whatever it can for less.

A conversation of up to `RUN_ROWS` rows is one run of one task. A longer one is cut by range
into runs of any size: every run gives the best edits from each state to each state, a pass
over these few rows per run chooses the states between runs, and the runs are walked again
with their ends known. No task holds a conversation; only its letters and digest are put
together run by run, in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import ASCII_SPACE, hot_join, kept, prepared

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# A conversation with more rows is cut into runs of about so many, in MAX_RUNS runs at most.
RUN_ROWS = 4096
MAX_RUNS = 100_000

# Ids of long conversations that are broadcast; beyond that they are joined by a shuffle.
BROADCAST_IDS = 50_000

# Decided turns go out once they hold so many bytes.
PIECE_BYTES = 1 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = (START, ASSISTANT)
INITIALS = {b"s": SYSTEM, b"u": USER, b"a": ASSISTANT}
ROLES = {USER: b"user", ASSISTANT: b"assistant"}

# What may follow a state, and what a reroled or inserted turn after it becomes.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {b"su", b"ua", b"au"}

# COVERS[q][p]: the most that state p pays beyond q for doing what q goes on to do. Inserts
# bring p into step; where q keeps a system turn, p deletes it.
COVERS = {
    START: {SYSTEM: 6, USER: 7, ASSISTANT: 4},
    SYSTEM: {START: 0, USER: 3, ASSISTANT: 0},
    USER: {START: 3, SYSTEM: 3, ASSISTANT: 3},
    ASSISTANT: {START: 0, SYSTEM: 6, USER: 3},
}


class Node:
    """Some edits after those of its parent: their letters, and the turn kept or made."""

    __slots__ = ("parent", "letters", "turn", "refs", "kids")

    def __init__(self, parent: Node | None, letters: str, turn):
        self.parent, self.letters, self.turn = parent, letters, turn
        self.refs, self.kids = 0, set()
        if parent is not None:
            parent.refs += 1
            parent.kids.add(self)


class Survivors:
    """The cheapest edits that end in each state, as leaves of one tree.

    `take()` returns the (letters, turn) pairs decided since the last call.
    """

    def __init__(self, entry: int = START, closed: bool = True):
        self.root = Node(None, "", None)
        self.best: dict[int, tuple[int, Node]] = {entry: (0, self.root)}
        self.root.refs += 1
        self.decided: list[tuple[str, object]] = []
        if closed:
            self._advance([])

    def delete(self, times: int) -> None:
        """Rows that must go."""
        letters = "D" * times
        self._advance([(q, q, DELETE * times, letters, None) for q in self.best])

    def row(self, role: bytes, text: bytes, truncated: bool) -> None:
        kind = INITIALS.get(role[:1])
        extra = TRUNCATED if truncated else 0
        steps = []
        for q in self.best:
            steps.append((q, q, DELETE, "D", None))
            if kind in FOLLOWS[q]:
                steps.append((q, kind, KEEP + extra, "K", (role, text)))
            to = NEXT[q]
            steps.append((q, to, REROLE + extra, "R", (ROLES[to], text)))
        self._advance(steps)

    def jump(self, cells: Iterable[tuple[int, int, int, str, object]]) -> None:
        """Whole runs as steps: (from, to, cost, letters, turn)."""
        self._advance([c for c in cells if c[0] in self.best], insert=False)

    def _suffix(self, node: Node) -> str:
        found = []
        while node is not None:
            found.append(node.letters)
            node = node.parent
        return "".join(reversed(found))

    def _better(self, new, old) -> bool:
        """Whether (cost, parent, letters) beats another candidate for the same state."""
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return self._suffix(new[1]) + new[2] < self._suffix(old[1]) + old[2]

    def _advance(self, steps, insert: bool = True) -> None:
        before = self.best
        if steps:
            found: dict[int, tuple] = {}
            for q, to, cost, letters, turn in steps:
                total, node = before[q]
                new = (total + cost, node, letters, turn)
                if self._better(new, found.get(to)):
                    found[to] = new
            after = {q: (c, Node(p, letters, turn)) for q, (c, p, letters, turn) in found.items()}
        else:
            after = dict(before)
        for _, node in after.values():
            node.refs += 1
        for _, node in before.values():
            self._release(node)
        if insert:
            for q, to in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
                self._insert(after, q, to)
        self.best = after
        for q in [q for q, (c, _) in after.items()
                  if any(p in after and c > after[p][0] + d for p, d in COVERS[q].items())]:
            self._release(after.pop(q)[1])
        self._decide()

    def _insert(self, best: dict, q: int, to: int) -> None:
        if q not in best:
            return
        cost, node = best[q]
        old = best.get(to)
        against = old and (old[0], old[1], "")
        if self._better((cost + INSERT, node, "I"), against):
            new = Node(node, "I", (ROLES[to], b""))
            new.refs += 1
            best[to] = (cost + INSERT, new)
            if old:
                self._release(old[1])

    def _release(self, node: Node) -> None:
        """Drop one reference; what nothing refers to any more goes, up to a branching."""
        node.refs -= 1
        while not node.refs and node.parent is not None:
            parent, node.parent = node.parent, None
            parent.kids.discard(node)
            parent.refs -= 1
            node = parent

    def _decide(self) -> None:
        """Emit what all survivors have in common."""
        while self.root.refs == 1 and self.root.kids:
            (only,) = self.root.kids
            self.root.kids.clear()
            self.root, only.parent = only, None
            self.decided.append((only.letters, only.turn))
            only.letters, only.turn = "", None

    def take(self) -> list[tuple[str, object]]:
        found, self.decided = self.decided, []
        return found

    def pending(self) -> dict[int, tuple[int, str]]:
        """(cost, undecided letters) of each survivor."""
        return {q: (c, self._suffix(n)) for q, (c, n) in self.best.items()}

    def finish(self, ends: Iterable[int] = ENDS) -> int:
        """Decide for the best of some end states; its cost."""
        found = None
        for q in ends:
            if q in self.best:
                cost, node = self.best[q]
                if self._better((cost, node, ""), found):
                    found = (cost, node, "")
        for _, node in self.best.values():
            if node is not found[1]:
                self._release(node)
        path, node = [], found[1]
        while node is not self.root:
            path.append((node.letters, node.turn))
            node = node.parent
        self.decided += reversed(path)
        self.best = {}
        return found[0]


class Facts:
    """What is counted over the rows of a run, in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.first_turn = self.last_turn = None
        self.first_role = self.last_role = None
        self.seen: set[bytes] = set()

    def row(self, turn, role: bytes, text: bytes, times: int, repeated) -> tuple[bool, bool]:
        """(whether the row must go, whether it is truncated); its copies must go anyway."""
        initial = role[:1]
        if self.last_role is None:
            self.first_role, self.first_turn = initial, turn
        else:
            self.illegal += self.last_role + initial not in LEGAL
        self.illegal += times - 1  # no role may follow itself
        if turn is not None and (self.last_role is None or turn != self.last_turn):
            self.distinct += 1
            self.low = turn if self.low is None else min(self.low, turn)
            self.high = turn if self.high is None else max(self.high, turn)
        self.last_role, self.last_turn = initial, turn
        words = text.rstrip(ASCII_SPACE)
        if not words:
            self.blank += times
            return True, False
        if repeated is None:  # runs that are whole conversations look for themselves
            key = hashlib.sha256(b"%d:%b%b" % (len(role), role, text)).digest()
            repeated = key in self.seen
            self.seen.add(key)
        if repeated:
            self.duplicate += times
            return True, False
        self.duplicate += times - 1
        truncated = words[-1:] not in (b".", b"!", b"?")
        self.truncated += truncated
        return False, truncated


# --- inside tasks ----------------------------------------------------------------------

ROW = "id string, none boolean, run int, turn long, role binary, text binary, times long, repeated boolean"
CELL = "id string, none boolean, run int, entry int, exit int, cost long, letters string"
CHOICE = "id string, none boolean, run int, entry int, exit int, letters string"
TURNS = "array<struct<role: binary, text: binary>>"
PIECE = (
    "id string, none boolean, run int, piece int, audit string, "
    f"turns {TURNS}, cost long, blank long, duplicate long, truncated long, illegal long, "
    "distinct long, low long, high long, first_turn long, last_turn long, first_role binary, last_role binary"
)
AUDIT = (
    "id string, none boolean, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
KINDS = {
    "string": pa.string(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "binary": pa.binary(),
    TURNS: pa.list_(pa.struct([("role", pa.binary()), ("text", pa.binary())])),
}


def _arrow_schema(ddl: str) -> pa.Schema:
    pairs = [c.split(" ", 1) for c in ddl.replace("role: binary, text", "role: binary; text").split(", ")]
    return pa.schema([(name, KINDS[kind.replace(";", ",")]) for name, kind in pairs])


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterable[tuple], ddl: str, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded rows and bytes; `weight` says how large a row is."""
    schema, held, size = _arrow_schema(ddl), [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        size += weight(row)
        if len(held) >= 4096 or size > PIECE_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _walk(rows: Iterable[tuple], facts: Facts, paths: list[Survivors]) -> Iterator[None]:
    """Lead survivors over the rows of a run; pauses after each row."""
    for _, _, _, turn, role, text, times, repeated in rows:
        if not times:
            continue
        gone, truncated = facts.row(turn, role, text, times, repeated)
        for path in paths:
            if gone:
                path.delete(times)
            else:
                path.row(role, text, truncated)
                if times > 1:
                    path.delete(times - 1)
        yield


def _pieces(key: tuple, rows: Iterable[tuple], path: Survivors, ends: Iterable[int]) -> Iterator[tuple]:
    """A run's decided edits in pieces; the last one has its cost and counts."""
    facts, number, letters, turns, size = Facts(), 0, [], [], 0

    def taken() -> None:
        nonlocal size
        for some, turn in path.take():
            letters.append(some)
            if turn is not None:
                turns.append({"role": turn[0], "text": turn[1]})
                size += len(turn[1]) + 16

    for _ in _walk(rows, facts, [path]):
        taken()
        if size > PIECE_BYTES:
            yield (*key, number, "".join(letters), turns, *[0] * 6, *[None] * 6)
            number, letters, turns, size = number + 1, [], [], 0
    cost = path.finish(ends)
    taken()
    yield (
        *key, number, "".join(letters), turns, cost, facts.blank, facts.duplicate, facts.truncated,
        facts.illegal, facts.distinct, facts.low, facts.high, facts.first_turn, facts.last_turn,
        facts.first_role, facts.last_role,
    )


def _piece_bytes(piece: tuple) -> int:
    return len(piece[4]) + sum(len(t["text"]) + 16 for t in piece[5])


KEY = itemgetter(0, 1, 2)
CONVERSATION = itemgetter(0, 1)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of whole conversations, whose rows come in order."""

    def pieces():
        for key, rows in groupby(_tuples(batches), KEY):
            yield from _pieces(key, rows, Survivors(), ENDS)

    return _batches(pieces(), PIECE, _piece_bytes)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best edits of every run from each state to each state."""

    def cells():
        for key, rows in groupby(_tuples(batches), KEY):
            paths = [Survivors(q, closed=False) for q in STATES]
            done: list[list[str]] = [[] for _ in STATES]
            for _ in _walk(rows, Facts(), paths):
                for own, path in zip(done, paths):
                    own.extend(letters for letters, _ in path.take())
            for q, own, path in zip(STATES, done, paths):
                head = "".join(own)
                for to, (cost, rest) in path.pending().items():
                    yield (*key, q, to, cost, head + rest)

    return _batches(cells(), CELL, lambda c: len(c[6]))


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of a conversation, whose cells come in order, the state before and after.

    What is inserted ahead of the first run comes as a run -1 with its letters.
    """

    def chosen():
        for key, cells in groupby(_tuples(batches), CONVERSATION):
            path = Survivors()
            for run, own in groupby(cells, itemgetter(2)):
                path.jump((q, to, cost, letters, (run, q, to)) for _, _, _, q, to, cost, letters in own)
                yield from told(key, path)
            path.finish()
            yield from told(key, path)

    def told(key: tuple, path: Survivors) -> Iterator[tuple]:
        for letters, turn in path.take():
            ahead = letters == "I" and isinstance(turn[0], bytes)
            yield (*key, -1, -1, -1, letters) if ahead else (*key, *turn, "")

    return _batches(chosen(), CHOICE, lambda c: 32)


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of runs; a run's rows come in order after a row with its states in `times`."""

    def pieces():
        for key, rows in groupby(_tuples(batches), KEY):
            head = next(rows)
            if key[2] < 0:  # only inserted turns, one a row
                roles = [b"user", b"assistant"][: 1 + sum(1 for _ in rows)]
                made = [{"role": r, "text": b""} for r in roles]
                yield (*key, 0, "I" * len(made), made, INSERT * len(made), *[0] * 5, *[None] * 6)
                continue
            entry, to = divmod(head[6], len(STATES))
            yield from _pieces(key, rows, Survivors(entry, closed=False), (to,))

    return _batches(pieces(), PIECE, _piece_bytes)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces, which come in order."""

    def audits():
        for key, pieces in groupby(_tuples(batches), CONVERSATION):
            digest, letters, turns = hashlib.sha256(), [], 0
            cost = blank = duplicate = truncated = illegal = distinct = 0
            low = high = last_turn = last_role = None
            for piece in pieces:
                (_, _, _, _, audit, kept_turns, c, b, d, t, i, n, lo, hi, first_turn, end_turn,
                 first_role, end_role) = piece
                letters.append(audit)
                for turn in kept_turns:
                    digest.update(b"\n" * (turns > 0) + turn["role"] + b":" + turn["text"])
                    turns += 1
                cost, blank, duplicate, truncated = cost + c, blank + b, duplicate + d, truncated + t
                illegal, distinct = illegal + i, distinct + n
                if first_role is not None:
                    if last_role is not None:
                        illegal += last_role + first_role not in LEGAL
                        distinct -= first_turn is not None and first_turn == last_turn
                    last_role, last_turn = end_role, end_turn
                if lo is not None:
                    low = lo if low is None else min(low, lo)
                    high = hi if high is None else max(high, hi)
            gaps = 0 if low is None else min(high - low + 1 - distinct, 2**63 - 1)
            yield (*key, gaps, blank, duplicate, truncated, illegal, cost, "".join(letters), digest.hexdigest())

    return _batches(audits(), AUDIT, lambda a: len(a[8]))


# --- tables ----------------------------------------------------------------------------


def _prepared_rows(rows: DataFrame, times: str | None) -> DataFrame:
    copies = F.greatest(F.coalesce(F.col(times), F.lit(0)), F.lit(0)) if times else F.lit(1)

    def content(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")).cast("binary").alias(c)

    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"),
        F.col("conv_id").isNull().alias("none"),
        F.lit(0).alias("run"),
        F.col("turn").cast("bigint").alias("turn"),
        content("role"),
        content("text"),
        copies.cast("bigint").alias("times"),
        F.lit(None).cast("boolean").alias("repeated"),
    )


CONVERSATION_KEY = ["id", "none"]


def _in_order() -> list:
    return ["id", "none", "run", F.asc_nulls_first("turn"), "role", "text"]


def _split(rows: DataFrame, run_rows: int) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of short conversations, those of long ones or None, how many rows the latter are)."""
    sizes = rows.groupBy(*CONVERSATION_KEY).agg(F.sum("times").alias("n")).where(F.col("n") > run_rows)
    long_ids = kept(sizes, "long-conversations")
    conversations, n = long_ids.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not conversations:
        return rows, None, 0
    ids = long_ids.select(*CONVERSATION_KEY, F.lit(True).alias("long"))
    if conversations <= BROADCAST_IDS:
        marked = rows.join(F.broadcast(ids), CONVERSATION_KEY, "left")
    else:
        marked = hot_join(rows, ids, CONVERSATION_KEY, "left")
    return marked.where("long IS NULL").drop("long"), marked.where("long").drop("long"), n


def _cut(rows: DataFrame, n: int, run_rows: int) -> DataFrame:
    """Rows of long conversations, equal ones merged and seen ones marked, cut into runs."""
    merged = (
        rows.where("times > 0")
        .groupBy(*CONVERSATION_KEY, "turn", "role", "text")
        .agg(F.sum("times").alias("times"))
        .withColumn("said", F.sha2(F.concat(F.sha2("role", 256).cast("binary"), F.col("text")), 256))
    )
    once = [*CONVERSATION_KEY, "said"]
    seen = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = merged.groupBy(*once).agg(F.min(seen).alias("first"))
    marked = hot_join(merged, firsts, once).select(
        *CONVERSATION_KEY,
        "turn",
        "role",
        "text",
        "times",
        (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("repeated"),
    )
    runs = max(1, min(-(-n // run_rows), MAX_RUNS))
    order = [*CONVERSATION_KEY, F.asc_nulls_first("turn"), "role", "text"]
    cut = marked.repartitionByRange(runs, *order).withColumn("run", F.spark_partition_id())
    return kept(cut.select(*_names(ROW)), "conversation-runs")


def _names(ddl: str) -> list[str]:
    return _arrow_schema(ddl).names


def _long_pieces(rows: DataFrame, n: int, run_rows: int) -> DataFrame:
    runs = _cut(rows, n, run_rows)
    of_run = ["id", "none", "run"]
    dealt = runs.repartition(*of_run).sortWithinPartitions(*_in_order())
    cells = dealt.mapInArrow(_cells, CELL)
    choices = (
        cells.repartition(*CONVERSATION_KEY)
        .sortWithinPartitions("id", "none", "run", "entry", "exit")
        .mapInArrow(_choices, CHOICE)
    )
    states = F.col("entry") * len(STATES) + F.col("exit")
    heads = choices.select(
        *of_run,
        F.lit(None).cast("bigint").alias("turn"),
        *[F.lit(b"").alias(c) for c in ("role", "text")],
        states.cast("bigint").alias("times"),
        F.lit(None).cast("boolean").alias("repeated"),
        F.lit(0).alias("_place"),
    )
    both = runs.withColumn("_place", F.lit(1)).unionByName(heads)
    place = ["id", "none", "run", "_place", F.asc_nulls_first("turn"), "role", "text"]
    pieces = both.repartition(*of_run).sortWithinPartitions(*place).select(*_names(ROW))
    return pieces.mapInArrow(_long, PIECE)


def _both(rows: DataFrame, times: str | None, run_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    prepared(rows.sparkSession)
    run_rows = run_rows or RUN_ROWS
    short, long, n = _split(_prepared_rows(rows, times), run_rows)
    dealt = short.select(*_names(ROW)).repartition(*CONVERSATION_KEY).sortWithinPartitions(*_in_order())
    return dealt.mapInArrow(_short, PIECE), None if long is None else _long_pieces(long, n, run_rows)


def _with_ids(found: DataFrame, rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    own = F.when(~F.col("none"), F.col("id").cast(kind)).alias("conv_id")
    return found.select(own, *[c for c in found.columns if c not in ("id", "none")])


def repaired(rows: DataFrame, times: str | None = None, run_rows: int | None = None) -> DataFrame:
    """Repaired conversations in pieces: conv_id, run, piece, audit, turns, cost and counts.

    `rows` has conv_id, turn, role and text; other columns are not looked at. In the order of
    run and piece a conversation's audits and turns, put together, are its letters and its
    repaired turns. `times`, a column, says how many adjacent copies of a row there are; a
    conversation whose rows are there 0 times is empty, and so is its one piece. Rows go by
    turn (nulls first), then role and text; null role and text are empty, a null conv_id is a
    conversation of its own. No rows give no pieces.
    """
    short, long = _both(rows, times, run_rows)
    found = short if long is None else short.unionByName(long)
    text = F.transform("turns", lambda t: F.struct(t["role"].cast("string").alias("role"), t["text"].cast("string").alias("text")))
    return _with_ids(found, rows).withColumn("turns", text).drop("first_role", "last_role")


def audited(rows: DataFrame, times: str | None = None, run_rows: int | None = None) -> DataFrame:
    """One row per conversation of `rows`, as `repaired` takes them.

    gaps (missing turns between the first and the last), blank, duplicate and truncated rows by
    their first fault, illegal neighbours, cost and letters of the edits, and the SHA-256 of the
    repaired `role:text` lines.
    """
    short, long = _both(rows, times, run_rows)
    found = short.mapInArrow(_audits, AUDIT)
    if long is not None:
        joined = long.repartition(*CONVERSATION_KEY).sortWithinPartitions("id", "none", "run", "piece")
        found = found.unionByName(joined.mapInArrow(_audits, AUDIT))
    return _with_ids(found, rows)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of id and turn; nulls are one space.

    (conv_id, turn, role, text, times): `times` is 0 for a dropped row and 2 for a repeated one.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
