"""Repair of conversation structure at least cost, with an audit of the edits.

Rows of a conversation are kept (K), given the role user or assistant (R, cost 1),
deleted (D, cost 2), and empty turns are inserted (I, cost 5), so that the initials
of the roles read ``(s?(ua)+)?``.  Blank rows and repeats of an earlier row must go;
a truncated row that stays costs 5 more.  Of all cheapest repairs the one with the
ASCII-least audit is taken.

A node is (rows done, role last said); an edit leads from node to node.  Cost DP
from the end gives each node's cost, and with it the optimal arcs.  Prefix doubling
then ranks the nodes by their least audits of length 1, 2, 4, ...: the rank of twice
the length comes from a node's own rank and that of the node its pointer leads to,
and pointers are doubled with it.  At each node the arc of least (initial, rank of
its target) is taken, and the doubled pointers list the path.

No conversation is held by one task.  Rows are range-partitioned over
(conversation, turn) and numbered; ``2 ** CHUNK_BITS`` of them at a time make
pieces.  A piece of a longer conversation is first reduced to its 4 x 4 table of
costs from state to state; pointer doubling over pieces (joins by number, as many
rounds as the longest conversation's pieces have binary digits) joins these tables
from the end, so that every piece knows what lies behind it, and then the states
that pieces lead to from the start.  Repeats are found by the least number of equal
(conversation, role, text digest), which collapses before the shuffle.

Defined results: rows of one turn are ordered by role, then by SHA-256 of the text;
a null turn comes first; null roles and texts are one blank, a null conversation is
one like others; a role of another initial can only be changed or deleted; other
columns are ignored; an empty table gives an empty result.  A conversation without
rows has cost 0 and an empty audit.  The digest of a conversation is one chain over
its text, so rows stream through it one after the other, in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored

#: Rows of a piece are 2 to the power of this.
CHUNK_BITS = 12
#: Rows whose paths are ranked together.
RANKED_ROWS = 1 << 15
EDITS = "DIKR"                                   # in ASCII order
START, SYSTEM, USER, ASSISTANT = range(4)        # the role last said
SPEAKS = (USER, USER, ASSISTANT, USER)           # who may speak next, besides a first system row
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
OK, BLANK, DUPLICATE, CUT = range(4)             # faults
FAR = 1 << 40
#: Cost and edits that end a conversation in each state.
FINAL, TAIL = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
_SPACE = r"\x20\x09-\x0D"


# -- one piece ------------------------------------------------------------------------

def _after(state: int, initial: str) -> int:
    """State after keeping a row; -1 if it may not follow."""
    if initial == "u":
        return USER if state != USER else -1
    if initial == "a":
        return ASSISTANT if state == USER else -1
    return SYSTEM if initial == "s" and state == START else -1


AFTER = {c: tuple(_after(s, c) for s in range(4)) for c in "suax"}


def _arcs(initial: str, fault: str) -> list[list[tuple[int, int, int]]]:
    """For each state: (edit, cost, next state) of the arcs that use up a row."""
    extra = TRUNCATED if fault == str(CUT) else 0
    out = []
    for s in range(4):
        arcs = [(0, DELETE, s)]
        if fault not in (str(BLANK), str(DUPLICATE)):
            if AFTER[initial][s] >= 0:
                arcs.append((2, KEEP + extra, AFTER[initial][s]))
            arcs.append((3, REROLE + extra, SPEAKS[s]))
        out.append(arcs)
    return out


ARCS = {i + f: _arcs(i, f) for i in "suax" for f in "0123"}


def costs_before(steps: str, behind: tuple | list) -> list[list[int]]:
    """Least cost to go at every node: a list of four for each number of rows done.  ``steps`` has two
    characters a row, its initial and its fault; ``behind`` is the cost after the last row."""
    out = [list(behind)]
    for k in range(len(steps) - 2, -2, -2):
        now = out[-1]
        w = [min(cost + now[to] for _, cost, to in arcs) for arcs in ARCS[steps[k:k + 2]]]
        user, assistant = w[USER], w[ASSISTANT]
        w[USER], w[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
        w[START], w[SYSTEM] = min(w[START], INSERT + w[USER]), min(w[SYSTEM], INSERT + w[USER])
        out.append(w)
    out.reverse()
    return out


def optimal_arcs(steps: str, cost: list[list[int]]) -> list[list[int]]:
    """For each node (four a number of rows done) the targets of its optimal arcs D, I, K, R within the piece; -1: none."""
    out = []
    for k in range(len(steps) // 2):
        arcs, now, ahead = ARCS[steps[2 * k:2 * k + 2]], cost[k], cost[k + 1]
        for s in range(4):
            row = [-1, -1, -1, -1]
            if now[s] == INSERT + now[SPEAKS[s]]:
                row[1] = 4 * k + SPEAKS[s]
            for edit, c, to in arcs[s]:
                if now[s] == c + ahead[to]:
                    row[edit] = 4 * (k + 1) + to
            out.append(row)
    return out + [[-1] * 4] * 4


def rank_paths(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(edit taken at each node, its rank by the whole least audit, doubled pointers).  A node without arcs ends
    its audit, which is less than any that goes on.  Different arcs of a node have different initials, so the
    first round already leaves one arc a node; its rank tells nodes apart."""
    some = targets >= 0
    edit = np.where(some.any(1), some.argmax(1) + 1, 0)
    nodes = np.arange(len(targets))
    pointer = np.where(edit > 0, targets[nodes, edit - 1], nodes)
    rank, hops = edit, [pointer]
    while edit[pointer].any():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        hops.append(pointer)
    order = np.where(some, np.arange(4) * (int(rank.max(initial=0)) + 1) + rank[np.where(some, targets, 0)], np.iinfo(np.int64).max)
    best = np.where(some.any(1), order.argmin(1) + 1, 0)
    return best, rank, hops


def _path(start: int, edit: np.ndarray, hops: list[np.ndarray]) -> tuple[str, int]:
    """(audit, last node) from ``start``: each doubled pointer doubles the known beginning."""
    nodes = np.array([start])
    for hop in hops:
        if edit[nodes[-1]] == 0:
            break
        nodes = np.concatenate([nodes, hop[nodes]])
    taken = edit[nodes]
    if taken[-1]:
        nodes = np.append(nodes, hops[0][nodes[-1]])
    end = int(np.argmin(edit[nodes] > 0))
    return "".join(EDITS[e - 1] for e in edit[nodes[:end]].tolist()), int(nodes[end])


def best_edits(pieces: list[tuple[str, list[int], int]]) -> list[tuple[list[int], list[int], list[str]]]:
    """For each (steps, cost behind, number of entry states): cost, exit state and audit from each of the entry states."""
    out, now, size = [], [], 0
    for piece in pieces:
        now.append(piece)
        size += len(piece[0]) // 2
        if size >= RANKED_ROWS:
            out += _ranked(now)
            now, size = [], 0
    return out + _ranked(now)


def _ranked(pieces: list) -> list:
    if not pieces:
        return []
    costs = [costs_before(steps, behind) for steps, behind, _ in pieces]
    tables = [np.array(optimal_arcs(steps, cost), np.int64) for (steps, _, _), cost in zip(pieces, costs)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
    targets = np.concatenate([np.where(t >= 0, t + at, -1) for t, at in zip(tables, first)])
    edit, _, hops = rank_paths(targets)
    out = []
    for (_, _, entries), cost, at, end in zip(pieces, costs, first.tolist(), first[1:].tolist()):
        paths = [_path(at + s, edit, hops) for s in range(entries)]
        out.append((cost[0][:entries], [node - (end - 4) for _, node in paths], [a for a, _ in paths]))
    return out


# -- rows and pieces ------------------------------------------------------------------

def faulty(df: DataFrame) -> DataFrame:
    """``df`` (conv, turn, role, text) in order and numbered, stored: conv, turn, role, text, seq, initial, blank, cut, digest."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = df.select("conv", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")) \
        .withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).withColumn("row", F.monotonically_increasing_id())
    # ``row`` lets equal rows be dealt over several partitions
    return stored(rows.repartitionByRange("conv", "turn", "role", "digest", "row")
                  .sortWithinPartitions("conv", "turn", "role", "digest", "row")
                  .select("conv", "turn", "role", "text", "digest", F.monotonically_increasing_id().alias("seq"),
                          F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x").alias("initial"),
                          (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
                          (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("cut")), "turn-rows")


def _pieces(rows: DataFrame, chunk_bits: int) -> DataFrame:
    """One row per (conversation, piece): what the piece says by itself, and its place in the conversation."""
    first = rows.filter("NOT blank").groupBy("conv", "role", "digest").agg(F.min("seq").alias("first")).select("first")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(OK)
    marked = rows.select("conv", "turn", "seq", "initial", "blank", "cut").join(first, F.col("seq") == F.col("first"), "left") \
        .select("conv", F.shiftright("seq", chunk_bits).alias("chunk"), F.struct("seq", "turn", "initial", fault.alias("fault")).alias("r"))
    r = F.col("r")
    whole = marked.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list("r")).alias("r"))     # 2 ** chunk_bits rows at most
    steps = F.array_join(F.transform(r, lambda x: F.concat(x["initial"], x["fault"].cast("string"))), "")
    initials = F.array_join(F.transform(r, lambda x: x["initial"]), "")
    turns = F.filter(F.transform(r, lambda x: x["turn"]), lambda t: t.isNotNull())
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda k: F.substr(F.col("initials"), k, F.lit(2)))

    def count(kind: int) -> Column:
        return F.size(F.filter(r, lambda x: x["fault"] == kind)).cast("long")
    counts = [count(kind).alias(n) for n, kind in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))]
    said = whole.select("conv", "chunk", r[0]["seq"].alias("seq"), steps.alias("steps"), initials.alias("initials"),
                        turns.alias("turns"), *counts)
    wrong = F.when(F.length("initials") < 2, 0).otherwise(F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))))
    said = said.select("conv", "chunk", "seq", "steps", "blank", "duplicate", "truncated", wrong.cast("long").alias("illegal"),
                       F.array_min("turns").alias("low"), F.array_max("turns").alias("high"),
                       F.size(F.array_distinct("turns")).cast("long").alias("turns"),
                       F.substring("initials", 1, 1).alias("head"), F.substring("initials", -1, 1).alias("last"))
    by = Window.partitionBy("conv").orderBy("chunk")                # a row for each 2 ** chunk_bits rows
    every = Window.partitionBy("conv")
    met = F.concat(F.lag("last").over(by), F.col("head"))
    return stored(said.select(
        "conv", "chunk", "seq", "steps", "blank", "duplicate", "truncated", "low", "high",
        (F.col("illegal") + F.when(met.isNotNull() & ~met.isin("su", "ua", "au"), 1).otherwise(0)).alias("illegal"),
        (F.col("turns") - F.when(F.lag("high").over(by) == F.col("low"), 1).otherwise(0)).alias("turns"),
        (F.row_number().over(by) - 1).cast("long").alias("at"), F.count(F.lit(1)).over(every).alias("of"),
        F.min("seq").over(every).alias("name")), "turn-pieces")


_SOLVED = "name long, at long, costs array<long>, exits array<int>, audits array<string>"


def _tables(pieces: DataFrame) -> DataFrame:
    """(name, at, a): least cost from each state before a piece to each state after it, 16 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for steps in batch.column(2).to_pylist():
                to = [costs_before(steps, [0 if s == e else FAR for s in range(4)])[0] for e in range(4)]
                out.append([min(to[e][s], FAR) for s in range(4) for e in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["name", "at", "a"])
    return pieces.select("name", "at", "steps").mapInArrow(run, "name long, at long, a array<long>")


def _doubled(table: DataFrame, longest: int, ahead: bool, join, name: str) -> DataFrame:
    """Pointer doubling over the pieces of each conversation: column ``a`` of a piece becomes that of all pieces from it
    to the last (``ahead``), or from the first to it.  ``join(earlier, later)`` puts two neighbours together."""
    step = 1
    while step < longest:
        other = table.select("name", (F.col("at") - step if ahead else F.col("at") + step).alias("at"), F.col("a").alias("b"))
        both = join(F.col("a"), F.col("b")) if ahead else join(F.col("b"), F.col("a"))
        table = stored(table.join(other, ["name", "at"], "left").select(
            "name", "at", F.when(F.col("b").isNull(), F.col("a")).otherwise(both).alias("a")), name)
        step *= 2
    return table


def _min_plus(a: Column, b: Column) -> Column:
    return F.array(*[F.least(*[a[4 * i + k] + b[4 * k + j] for k in range(4)]) for i in range(4) for j in range(4)])


def _then(a: Column, b: Column) -> Column:
    return F.transform(a, lambda state: b[state])


def _solved(pieces: DataFrame) -> DataFrame:
    """``pieces`` (steps, behind, entries) with costs, exits and audits from each entry state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = best_edits(list(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))))
            costs, exits, audits = zip(*got) if got else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64())), pa.array(exits, pa.list_(pa.int32())),
                 pa.array(audits, pa.list_(pa.string()))], ["name", "at", "costs", "exits", "audits"])
    return pieces.select("name", "at", "steps", "behind", "entries").mapInArrow(run, _SOLVED)


def _audits(pieces: DataFrame) -> DataFrame:
    """(name, at, entry, cost, audit) of every piece; the last one's audit has the inserts that end the conversation."""
    final, tail = F.array(*[F.lit(c).cast("long") for c in FINAL]), F.array(*[F.lit(t) for t in TAIL])
    short = _solved(pieces.filter("of = 1").select("name", "at", "steps", final.alias("behind"), F.lit(1).alias("entries")))
    short = short.select("name", "at", F.lit(0).alias("entry"), F.col("costs")[0].alias("cost"),
                         F.concat(F.col("audits")[0], tail[F.col("exits")[0]]).alias("audit"))
    long = pieces.filter("of > 1").select("name", "at", "of", "steps")
    longest = long.agg(F.max("of")).first()[0] or 0
    if not longest:
        return short
    rest = _doubled(stored(_tables(long), "turn-tables"), longest, True, _min_plus, "turn-tables")
    behind = F.array(*[F.least(*[F.col("a")[4 * s + e] + FINAL[e] for e in range(4)]) for s in range(4)])
    rest = rest.select("name", (F.col("at") - 1).alias("at"), behind.alias("behind"))
    known = long.join(rest, ["name", "at"], "left").withColumn("behind", F.coalesce("behind", final)).withColumn("entries", F.lit(4))
    solved = stored(_solved(known), "turn-solved")
    led = _doubled(solved.select("name", "at", F.col("exits").alias("a")), longest, False, _then, "turn-states")
    led = led.select("name", (F.col("at") + 1).alias("at"), F.col("a")[0].alias("entry"))
    entry = F.coalesce("entry", F.lit(0))
    ends = F.when(F.col("at") == F.col("of") - 1, tail[F.col("exits")[entry]]).otherwise("")
    return short.unionByName(solved.join(led, ["name", "at"], "left").join(long.select("name", "at", "of"), ["name", "at"]).select(
        "name", "at", entry.alias("entry"), F.col("costs")[entry].alias("cost"),
        F.concat(F.col("audits")[entry], ends).alias("audit")))


# -- repaired rows --------------------------------------------------------------------

class _Edits:
    """The edits of one piece, applied to its rows one after the other."""

    def __init__(self, audit: str, state: int):
        self.audit, self.state, self.at = audit, state, 0

    def _says(self, role: str) -> None:
        self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = ROLES[SPEAKS[self.state]]
            self.at += 1
            self._says(role)
            yield role, "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        role = role if edit == "K" else ROLES[SPEAKS[self.state]]
        self._says(role)
        yield role, text, edit


_SORTED = ("conv", "chunk", "seq")


def _edited(rows: DataFrame, audits: DataFrame, chunk_bits: int) -> DataFrame:
    """(conv, chunk, seq, role, text, audit, entry): a piece's audit (seq -1) comes before its rows."""
    return rows.select("conv", F.shiftright("seq", chunk_bits).alias("chunk"), "seq", "role", "text",
                       F.lit(None).cast("string").alias("audit"), F.lit(0).alias("entry")).unionByName(
        audits.select("conv", "chunk", F.lit(-1).cast("long").alias("seq"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", "entry"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, chunk, repaired rows that follow) for each item of a sorted partition."""
    edits = place = None
    for batch in batches:
        for conv, chunk, seq, role, text, audit, entry in zip(*(batch.column(k).to_pylist() for k in range(7))):
            if seq < 0:
                if edits is not None:
                    yield *place, list(edits.inserts())
                edits, place = _Edits(audit, entry), (conv, chunk)
                yield *place, []
            else:
                yield *place, list(edits.row(role, text))
    if edits is not None:
        yield *place, list(edits.inserts())


def _digests(items: DataFrame, conv_type: str) -> DataFrame:
    """(conv, digest) of each conversation's repaired ``role:text`` rows, joined by new lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, some, out = None, None, False, []
        kind = pa.int64() if conv_type == "bigint" else pa.string()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([d for _, d in out], pa.string())], ["conv", "digest"])
            out.clear()
            return made
        for conv, _, rows in _walk(batches):
            if sha is None or conv != now:
                if sha is not None:
                    out.append((now, sha.hexdigest()))
                    if len(out) >= 4096:
                        yield batch()
                now, sha, some = conv, hashlib.sha256(), False
            for role, text, _ in rows:
                sha.update((f"\n{role}:{text}" if some else f"{role}:{text}").encode())
                some = True
        if sha is not None:
            out.append((now, sha.hexdigest()))
            yield batch()
    return items.repartition("conv").sortWithinPartitions(*_SORTED).select(*items.columns) \
        .mapInArrow(run, f"conv {conv_type}, digest string")


def _named(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    conv = F.col(conv_col)
    conv = conv.cast("long") if dict(df.dtypes)[conv_col] in ("tinyint", "smallint", "int", "bigint") else conv.cast("string")
    return df.select(conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))


def repaired_rows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(conv, chunk, place, role, text, edit): the repaired conversations, in the order of (chunk, place); edit is K, R or I."""
    named = _named(df, conv_col, turn_col, role_col, text_col)
    rows, pieces, audits = _plan(named, chunk_bits)
    items, conv_type = _edited(rows, audits, chunk_bits), dict(named.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "chunk", "place", "role", "text", "edit"]
        types = [pa.int64() if conv_type == "bigint" else pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        out, place, before = [], 0, None
        for conv, chunk, rows in _walk(batches):
            if (conv, chunk) != before:
                before, place = (conv, chunk), 0
            for r in rows:
                out.append((conv, chunk, place, *r))
                place += 1
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    return items.repartition("conv", "chunk").sortWithinPartitions(*_SORTED).select(*items.columns) \
        .mapInArrow(run, f"conv {conv_type}, chunk long, place long, role string, text string, edit string")


def _plan(named: DataFrame, chunk_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numbered rows, pieces, audits of the pieces)."""
    rows = faulty(named)
    pieces = _pieces(rows, chunk_bits)
    audits = _audits(pieces).join(pieces.select("name", "at", "conv", "chunk"), ["name", "at"])
    return rows, pieces, stored(audits, "turn-audits")


def report(df: DataFrame, every: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.  ``every`` names
    conversations (column ``conv_col``) that are reported also without rows in ``df``."""
    named = _named(df, conv_col, turn_col, role_col, text_col)
    rows, pieces, audits = _plan(named, chunk_bits)
    digests = _digests(_edited(rows, audits, chunk_bits), dict(named.dtypes)["conv"])
    names = _named((df if every is None else every).withColumns({c: F.lit(None).cast("string") for c in (turn_col, role_col, text_col)}),
                   conv_col, turn_col, role_col, text_col).select("conv").distinct()
    facts = names.unionByName(pieces.select("conv", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns"), True) \
        .unionByName(audits.select("conv", "at", "cost", "audit"), True).unionByName(digests, True)
    said = facts.groupBy("conv").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        (F.max("high") - F.min("low") + 1 - F.sum("turns")).alias("gaps"), F.sum(F.when(F.col("at") == 0, F.col("cost"))).alias("cost"),
        F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "audit")))).alias("audits"), F.max("digest").alias("digest"))
    return said.select(
        F.col("conv").alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.coalesce("cost", F.lit(0)).cast("long").alias("cost"), F.array_join(F.col("audits.audit"), "").alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes
    sentence ends, 3 repeats it, 4 makes it the user's.  Nulls are one blank (a null turn stays null)."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)).cast("binary")) % 20
    rows = df.select(F.col(conv_col), F.col(turn_col), filled(role_col).alias(role_col), filled(text_col).alias(text_col), fate.alias("__fate")) \
        .filter("__fate <> 0")
    role = F.when(F.col("__fate") == 4, "user").otherwise(F.col(role_col))
    text = F.when(F.col("__fate") == 1, "").when(F.col("__fate") == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("__fate") == 3, 2).otherwise(1)))
    return rows.select(conv_col, turn_col, role.alias(role_col), text.alias(text_col), times.alias("__time")).drop("__time")
