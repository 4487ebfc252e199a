"""Conversation structure repair by survivor-coalescence Viterbi.

A conversation's rows, in the order of their turns, are edited at least cost so
that the initials of the roles read ``(s?(ua)+)?``: keep a row (0), give it the
role user or assistant (2), delete it (3; blank and repeated rows must go) or
insert an empty row of either role (2); a row that stays though it is cut short
adds 1. Of equally cheap edits those whose initials are least in ASCII order win.

The search keeps, for each state of the pattern, the best way there (the
survivors) in a tree of back pointers. Nodes count their children; a branch that
no survivor needs any more is given back, and what all survivors share is emitted
at once. So memory follows the edits still open, not the conversation. Ties are
decided by the complete open edits of both ways. (Two equally cheap ways over the
same rows are never prefixes of each other, so the lesser one stays the lesser
one whatever follows.)

Rows are sorted by ranges of (conversation, turn), which may cut a long
conversation into segments. A segment is searched from every state that it may
begin in; the segments' results then go through the same search as rows do. So
no task needs a whole conversation, but for its digest, which is sequential.

Edge cases: a null conversation, turn, role or text counts as one space (null
conversations are one conversation, null turns come first); rows of one turn go by
a hash of role and text; equal rows of one turn are repeats; a text of any length
is taken whole; a role of several letters counts by its first; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeframe.llm.common import in_order, prepare, stored

#: White space, as rows are judged.
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: nothing yet; after the system row; after a user row; after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
LAST = (1 << 63) - 1


def _inserts(state: int) -> list[tuple[int, bytes]]:
    """States that inserted rows lead to, with the inserts."""
    if state in (START, SYSTEM):
        return [(state, b""), (USER, b"I"), (ASSISTANT, b"II")]
    return [(state, b""), (USER if state == ASSISTANT else ASSISTANT, b"I")]


def _row_moves(initial: str, gone: bool, cut: bool) -> list[tuple[int, int, int, bytes]]:
    """(from, to, cost, edits) of a row and the inserts before it. An insert right before
    a deletion is left out: the other way round it costs the same and comes first."""
    best: dict[tuple[int, int], tuple[int, bytes]] = {}

    def offer(a: int, b: int, cost: int, edits: bytes) -> None:
        best[a, b] = min(best.get((a, b), (cost, edits)), (cost, edits))

    for a in range(4):
        offer(a, a, DELETE, b"D")
        if gone:
            continue
        for b, edits in _inserts(a):
            cost = INSERT * len(edits) + CUT * cut
            if initial == "s" and b == START:
                offer(a, SYSTEM, cost, edits + b"K")
            wanted, to = ("a", ASSISTANT) if b == USER else ("u", USER)
            if initial == wanted:
                offer(a, to, cost, edits + b"K")
            else:
                offer(a, to, cost + REROLE, edits + b"R")
    return [(a, b, cost, edits) for (a, b), (cost, edits) in sorted(best.items())]


MOVES = {(i, gone, cut): _row_moves(i, gone, cut) for i in ("s", "u", "a", "") for gone in (False, True) for cut in (False, True)}
#: To the end of the conversation: what is missing is inserted.
END = [(START, START, 0, b""), (SYSTEM, START, 2 * INSERT, b"II"), (USER, START, INSERT, b"I"), (ASSISTANT, START, 0, b"")]


class _Node:
    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: _Node | None, edits: bytes = b""):
        self.parent, self.edits, self.children = parent, bytearray(edits), []


class Survivors:
    """The best way to each state, and the edits that all of them share."""

    def __init__(self, state: int = START):
        self.root = _Node(None)
        self.best: dict[int, tuple[int, _Node]] = {state: (0, self.root)}
        self.emitted = bytearray()

    def _open(self, node: _Node) -> bytes:
        parts = []
        while node is not self.root:
            parts.append(node.edits)
            node = node.parent
        parts.append(self.root.edits)
        return b"".join(reversed(parts))

    def advance(self, moves: list[tuple[int, int, int, bytes]]) -> None:
        """One row, or one segment: each move leads from a state to a state."""
        best, pick = self.best, {}
        for a, b, cost, edits in moves:
            if a not in best:
                continue
            total = best[a][0] + cost
            have = pick.get(b)
            if have is None or total < have[0] or total == have[0] and self._open(best[a][1]) + edits < self._open(best[have[1]][1]) + have[2]:
                pick[b] = (total, a, edits)
        # without a row kept so far, or only the system row: no longer worth it once a way
        # that has rows is cheaper, even if that one deletes a system row still to come
        least = min((pick[b][0] + more for b, more in ((ASSISTANT, 0), (USER, INSERT)) if b in pick), default=None)
        if least is not None:
            for b, more in ((START, DELETE), (SYSTEM, 0)):
                if b in pick and pick[b][0] > least + more:
                    del pick[b]
        users: dict[int, list[int]] = {}
        for b, (_, a, _) in pick.items():
            users.setdefault(a, []).append(b)
        new: dict[int, tuple[int, _Node]] = {}
        for a, (_, node) in best.items():
            to = users.get(a, ())
            if len(to) == 1:  # the way goes on: no new node
                node.edits += pick[to[0]][2]
                new[to[0]] = (pick[to[0]][0], node)
            else:
                for b in to:
                    child = _Node(node, pick[b][2])
                    node.children.append(child)
                    new[b] = (pick[b][0], child)
        for a, (_, node) in best.items():
            if a not in users:
                self._release(node)
        self.best = new
        while len(self.root.children) == 1:
            self.emitted += self.root.edits
            self.root = self.root.children[0]
            self.root.parent = None
        if not self.root.children:
            self.emitted += self.root.edits
            self.root.edits = bytearray()

    def _release(self, node: _Node) -> None:
        parent = node.parent
        if parent is None:
            return
        parent.children.remove(node)
        if len(parent.children) == 1 and parent is not self.root:  # one child is left: both become one node
            child = parent.children[0]
            child.edits = parent.edits + child.edits
            child.parent = parent.parent
            parent.parent.children[parent.parent.children.index(parent)] = child

    def ways(self) -> list[tuple[int, int, bytes]]:
        """(state, cost, all its edits) of each survivor."""
        return [(state, cost, bytes(self.emitted) + self._open(node)) for state, (cost, node) in sorted(self.best.items())]

    def nodes(self) -> int:
        def count(node: _Node) -> int:
            return 1 + sum(map(count, node.children))

        return count(self.root)


class _Facts:
    """What is counted in a conversation, in the order of its rows."""

    def __init__(self) -> None:
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def row(self, initial: str, turn: int | None, blank: bool, repeat: bool, cut: bool) -> None:
        self.blank += blank
        self.duplicate += repeat
        self.truncated += cut
        self.follow(initial, initial, turn, turn, turn is not None)
        self.rows += 1

    def follow(self, first: str, last: str, low: int | None, high: int | None, turns: int) -> None:
        """What comes next begins and ends so."""
        if self.rows:
            self.illegal += self.last + first not in ("su", "ua", "au")
        else:
            self.first = first
        self.last = last
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low = low if self.low is None else self.low
            self.high = high

    def add(self, other: _Facts) -> None:
        self.follow(other.first, other.last, other.low, other.high, other.turns)
        for name in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))

    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LAST)


COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
_SEGMENT = ["first string", "last string", "low long", "high long", *(f"{n} long" for n in COUNTS)]
_PIECE = ["piece string", "before long", "odd boolean", "gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long"]


def _pieces(audit: bytes, cost: int, facts: _Facts, segments: list[tuple[int, int]]) -> Iterator[dict]:
    """The edits of a conversation cut at its segments (part, rows): a segment's edits end with its
    last row's, so only the last one has inserts after it."""
    odd = (len(audit) - audit.count(b"D")) % 2 == 1
    at = before = 0
    for i, (part, rows) in enumerate(segments):
        end = at
        if i + 1 == len(segments):
            end = len(audit)
        else:
            while rows:
                rows -= audit[end] != ord("I")
                end += 1
        own = {n: getattr(facts, n) for n in ("blank", "duplicate", "truncated", "illegal")} | {"gaps": facts.gaps(), "cost": cost} if not i else {}
        yield {"part": part, "piece": audit[at:end].decode(), "before": before, "odd": odd} | own
        before += end - at - audit.count(b"D", at, end)
        at = end


class _Rows:
    """Gathers rows for Arrow batches."""

    def __init__(self, names: list[str], types: dict[str, pa.DataType], most: int = 20_000, size: int = 8 << 20):
        self.names, self.types, self.most, self.size, self.held, self.bytes = names, types, most, size, [], 0

    def add(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.held.append(row)
        self.bytes += size
        if len(self.held) >= self.most or self.bytes >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in self.held], self.types[n]) for n in self.names], names=self.names)
        self.held, self.bytes = [], 0


def _types(kinds: list[str], first: pa.RecordBatch) -> dict[str, pa.DataType]:
    known = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return {k.split()[0]: known[k.split()[1]] for k in kinds} | {"conv": first.schema.field("conv").type}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


_FOUND = ["part int", "state int", "to int", "cost long", "piece string", *_SEGMENT]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, at, mark, conv, turn, initial, blank, cut, spans) of whole parts in order -> the ways
    of each segment; of a conversation that lies in one part, the finished one (state -1)."""
    first = next(batches, None)
    if first is None:
        return
    out = _Rows(["conv", *(k.split()[0] for k in _FOUND)], _types(_FOUND, first))

    def chained() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    for (part, conv), rows in groupby(_read(chained()), lambda r: (r[0], r[3])):
        runs: dict[int, Survivors] = {}
        facts, repeat = _Facts(), False
        for _, _, mark, _, turn, initial, blank, cut, spans in rows:
            if mark == 0:  # says that the row after it is a repeat
                repeat = True
                continue
            runs = runs or ({s: Survivors(s) for s in range(4)} if spans else {-1: Survivors()})
            cut = cut and not repeat
            facts.row(initial, turn, blank, repeat, cut)
            moves = MOVES[initial if initial in ("s", "u", "a") else "", blank or repeat, cut]
            for run in runs.values():
                run.advance(moves)
            repeat = False
        own = {n: getattr(facts, n) for n in (*COUNTS, "first", "last", "low", "high")}
        for state, run in runs.items():
            if state < 0:
                run.advance(END)
            for to, cost, edits in run.ways():
                yield from out.add({"conv": conv, "part": part, "state": state, "to": to, "cost": cost, "piece": edits.decode()} | own, len(edits))
    yield from out.flush()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ways of all segments, ordered by conversation and part -> the edits of each segment."""
    first = next(batches, None)
    if first is None:
        return
    kinds = ["part int", *_PIECE]
    out = _Rows(["conv", *(k.split()[0] for k in kinds)], _types(kinds, first))

    def chained() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    for conv, segments in groupby(_read(chained()), lambda r: r[0]):
        run, facts, cuts, done = Survivors(), _Facts(), [], None
        for part, ways in groupby(segments, lambda r: r[1]):
            own, moves = _Facts(), []
            for _, _, state, to, cost, edits, *values in ways:
                if state < 0:
                    done = (cost, edits.encode())
                moves.append((state, to, cost, edits.encode()))
            for name, value in zip((k.split()[0] for k in _SEGMENT), values):
                setattr(own, name, value)
            facts.add(own)
            cuts.append((part, own.rows))
            if done is None:
                run.advance(moves)
        if done is None:
            run.advance(END)
            ((_, cost, audit),) = run.ways()
            done = (cost, audit)
        for piece in _pieces(done[1], done[0], facts, cuts):
            yield from out.add(piece | {"conv": conv}, len(piece["piece"]))
    yield from out.flush()


def _edited(rows: Iterator[tuple], piece: str, before: int, odd: bool) -> Iterator[tuple[int, str, str, str]]:
    """(index, edit, role, text) of the rows that the edits ``piece`` leave. Rows are (role, text)."""
    at = before
    for edit in piece:
        if edit == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
        if edit != "K":
            role = "user" if at % 2 == odd else "assistant"
        yield at, edit, role, text
        at += 1


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of rows ordered by home, conversation, part, kind and place: (conv, piece row, edited rows)."""
    for (_, conv, _), rows in groupby(_read(batches), lambda r: (r[0], r[1], r[2])):
        head = next(rows)
        yield conv, dict(zip((k.split()[0] for k in _PIECE), head[7:])), _edited(((r[5], r[6]) for r in rows), head[7], head[8], head[9])


_DIGEST = ["gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string", "repaired_sha256 string"]
_REPAIRED = ["index long", "edit string", "role string", "text string"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    out = _Rows(["conv", *(k.split()[0] for k in _DIGEST)], _types(_DIGEST, first))

    def chained() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    for conv, segments in groupby(_walk(chained()), lambda s: s[0]):
        sha, audit, facts = hashlib.sha256(), [], {}
        for _, piece, rows in segments:
            facts = facts or piece
            audit.append(piece["piece"])
            for at, _, role, text in rows:
                sha.update((("\n" if at else "") + role + ":" + text).encode())
        row = {n: facts[n] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
        yield from out.add(row | {"conv": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}, sum(map(len, audit)))
    yield from out.flush()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    out = _Rows(["conv", *(k.split()[0] for k in _REPAIRED)], _types(_REPAIRED, first))

    def chained() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    for conv, _, rows in _walk(chained()):
        for at, edit, role, text in rows:
            yield from out.add({"conv": conv, "index": at, "edit": edit, "role": role, "text": text}, len(text))
    yield from out.flush()


def _ordered(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with their part (a range of the order) and place in it, written once."""
    name = lambda c: F.col(f"`{c}`")
    own = df.select(
        name(conv).alias("conv"),
        name(turn).cast("long").alias("turn"),
        F.coalesce(name(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(name(text).cast("string"), F.lit(" ")).alias("text"),
    )
    words = F.coalesce(F.col("conv").cast("string"), F.lit(""))
    who = F.concat(F.col("conv").isNull().cast("string"), F.length(words).cast("string"), F.lit(":"), words, F.length("role").cast("string"), F.lit(":"), "role", "text")
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    judged = own.select(
        "*",
        F.sha2(who, 256).alias("who"),
        (end == "").alias("blank"),
        ((end != "") & ~F.substring(end, -1, 1).isin(*ENDS)).alias("cut"),
        F.substring("role", 1, 1).alias("initial"),
    )
    return stored(in_order(judged, ["conv", "turn", "who"], "part", "at"), "conversations-ordered")


def _by_part(df: DataFrame, home: str, *order: str) -> DataFrame:
    """Whole parts in one task each, in order."""
    return df.repartition(home).sortWithinPartitions(home, *order)


class Repair:
    """The cheapest edits of each conversation of a table of turns."""

    def __init__(self, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        prepare(df.sparkSession)
        self.conv, self.rows = conv, _ordered(df, conv, turn, role, text)
        kind = f"`conv` {df.schema[conv].dataType.simpleString()}"
        # conversations that lie in several parts: fewer than there are parts, as each
        # border between two neighbouring parts is within one conversation at most
        spans = stored(
            self.rows.groupBy("conv").agg(F.min("part").alias("home"), F.max("part").alias("to")).filter("home < to").select(F.col("conv").alias("who_spans"), "home"),
            "conversations-spans",
        )
        spread = lambda t: t.join(F.broadcast(spans), F.col("conv").eqNullSafe(F.col("who_spans")), "left")
        # repeats: rows after the first of their conversation, role and text. Rows are combined before the shuffle
        place = F.struct("part", "at")
        first = self.rows.filter(~F.col("blank")).groupBy("who").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        again = self.rows.filter(~F.col("blank")).join(first, "who").filter(place > F.col("first"))
        thin = [F.col(c) for c in ("part", "at", "mark", "conv", "turn", "initial", "blank", "cut")]
        marked = self.rows.withColumn("mark", F.lit(1)).select(*thin).unionByName(again.withColumn("mark", F.lit(0)).select(*thin))
        marked = spread(marked).select(*thin, F.col("home").isNotNull().alias("spans"))
        # a part is one task: ``mark`` rows come before the row they mark
        found = stored(_by_part(marked, "part", "at", "mark").mapInArrow(_search, ", ".join([kind, *_FOUND])), "conversations-found")
        pieces = found.repartition("conv").sortWithinPartitions("conv", "part", "state", "to").mapInArrow(_chain, ", ".join([kind, "`part` int", *_PIECE]))
        self.pieces, self.kind, self._spread = stored(pieces, "conversations-pieces"), kind, spread

    def _both(self, whole: bool) -> DataFrame:
        """Rows and the edits of their segment before them; with ``whole`` a conversation in one task."""
        nothing = [F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in _PIECE]
        names = ["conv", "part", "kind", "at", "role", "text", *(k.split()[0] for k in _PIECE)]
        rows = self.rows.select("conv", "part", F.lit(1).alias("kind"), "at", "role", "text", *nothing)
        heads = self.pieces.select(
            "conv", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), *(F.lit(None).cast("string").alias(c) for c in ("role", "text")), *names[6:]
        )
        both = rows.unionByName(heads)
        if whole:
            both = self._spread(both).select(F.coalesce("home", "part").alias("home"), *names)
        else:
            both = both.select(F.col("part").alias("home"), *names)
        return _by_part(both, "home", "conv", "part", "kind", "at")

    def digests(self) -> DataFrame:
        """A row for each conversation: counts of faults, cost, the edits' initials, and the
        SHA-256 of the repaired conversation (role:text, a line each)."""
        return self._both(True).mapInArrow(_digests, ", ".join([self.kind, *_DIGEST])).withColumnRenamed("conv", self.conv)

    def repaired(self) -> DataFrame:
        """The rows of the repaired conversations (conversation, index, edit, role, text)."""
        return self._both(False).mapInArrow(_repaired, ", ".join([self.kind, *_REPAIRED])).withColumnRenamed("conv", self.conv)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes its sentence ends out, 3 repeats it, 4 makes it a user's."""
    words = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(words(conv), F.lit(":"), words(turn)).cast("binary")) % 20
    rows = df.select(F.col(f"`{conv}`").alias("__c"), F.col(f"`{turn}`").alias("__t"), words(role).alias("__r"), words(text).alias("__s"), fault.alias("__f"))
    said: Column = F.when(F.col("__f") == 1, "").when(F.col("__f") == 2, F.translate("__s", "".join(ENDS), "")).otherwise(F.col("__s"))
    return (
        rows.filter("__f <> 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.when(F.col("__f") == 3, 1).otherwise(0))))
        .select(F.col("__c").alias(conv), F.col("__t").alias(turn), F.when(F.col("__f") == 4, "user").otherwise(F.col("__r")).alias(role), said.alias(text))
    )


def repair_damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Each conversation of ``df``, damaged and then repaired (``Repair.digests``); one of which
    no row is left has zeros, no edits and the digest of an empty text."""
    found = Repair(damaged(df, conv, turn, role, text), conv, turn, role, text).digests()
    every = df.select(F.col(f"`{conv}`").alias("__every")).distinct()
    joined = every.join(found, F.col("__every").eqNullSafe(F.col(f"`{conv}`")), "left")
    nothing = {"string": F.lit(""), "long": F.lit(0).cast("long")}
    values = [F.coalesce(n, F.lit(hashlib.sha256().hexdigest()) if n == "repaired_sha256" else nothing[k]).alias(n) for n, k in (x.split() for x in _DIGEST)]
    return joined.select(F.col("__every").alias(conv), *values)
