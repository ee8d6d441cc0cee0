"""Repair of conversations: the cheapest edits that make the roles of every conversation alternate.

Rows go to their conversation's task once (a repartition by conversation) and are sorted there by turn. A worker reads
the sorted stream in Arrow batches and carries, from batch to batch, the conversation's dynamic program: for each state
of the pattern `(s?(ua)+)?` the least cost of the edits so far, and its order among the four by ASCII. A row leaves one
byte of backpointer a state; the backpointers, the rows and the edits of a conversation are kept in spools that go
to a file of the task beyond SPOOL bytes, so a conversation of any length takes bounded memory but for its audit, which
is one letter a row and part of the result. The digest of a conversation is one SHA-256, which must be read in order:
that, and not the program, ties a conversation to one task.

Two insertions in one place are never cheapest (deleting what made them necessary is), so one at most is tried.

Nulls: a null role or text is one space, a null turn sorts first, rows without a conv_id are one conversation.
Ties of turn go by role, then text. Repeated rows are duplicates. Empty texts are blank. A role's initial is its first
character as it stands; without one it is no role. Very long texts are read once. Empty tables give empty tables.
Further columns are left alone. conv_id and turn are integers.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import ship

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLED, DELETED, INSERTED, CUT = 1, 2, 5, 5
#: Bytes of a conversation's backpointers, rows and edits that stay in memory, each.
SPOOL = 1 << 20
#: Letters of one read of a spool backwards.
BACK = 1 << 16

#: States: nothing yet, after s, after u, after a. Of each: the state and the role that a user's or assistant's turn leads to.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
ENDS = (0, 3)


def _moves() -> dict[tuple[str, bool], list[list[tuple[int, int, str, int]]]]:
    """Of (initial, may stay): for each state the (state after, cost, letters, backpointer) of one row's edits, insertions before it included."""
    found = {}
    for initial in ("s", "u", "a", ""):
        for stays in (True, False):
            rows = []
            for q in range(4):
                row = []
                for ins in (0, 1):
                    at, cost, letters = (NEXT[q], INSERTED, INSERT) if ins else (q, 0, "")
                    edits = [(DELETE, at, DELETED)]
                    if stays:
                        edits.append((REROLE, NEXT[at], REROLED))
                        if initial == "s" and at == 0:
                            edits.append((KEEP, 1, 0))
                        if initial and initial == ROLE[at][0]:
                            edits.append((KEEP, NEXT[at], 0))
                    row += [(to, cost + c, letters + e, q | ins << 2 | "DKR".index(e) << 3) for e, to, c in edits]
                rows.append(row)
            found[initial, stays] = rows
    return found


MOVES = _moves()
LEGAL = {"su", "ua", "au"}


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: the rows as they are after the damage that crc32(conv_id:turn) % 20 names."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = df.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return damaged.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def _faults(df: DataFrame, dropped: Column) -> DataFrame:
    """The rows in their conversation's task with blank, truncated and seen; dropped rows stay as marks of their conversation."""
    role = F.when(~dropped, F.coalesce("role", F.lit(" ")))
    text = F.when(~dropped, F.coalesce("text", F.lit(" ")))
    rows = df.select("conv_id", F.when(~dropped, F.col("turn").cast("long")).alias("turn"), role.alias("role"), text.alias("text"), dropped.alias("dropped")).repartition("conv_id")
    said = F.rtrim(F.col("text"), F.lit(BLANKS))
    before = Window.partitionBy("conv_id").orderBy("dropped", "role", "text", F.col("turn").asc_nulls_first())
    seen = (F.lag("role").over(before) == F.col("role")) & (F.lag("text").over(before) == F.col("text"))
    marked = rows.withColumns({"seen": F.coalesce(seen, F.lit(False)), "blank": said == "", "cut": ~F.substr(said, F.lit(-1)).isin(".", "!", "?")})
    return marked.sortWithinPartitions("conv_id", "dropped", F.col("turn").asc_nulls_first(), "role", "text")


class Conversation:
    """The program of one conversation, row after row."""

    def __init__(self, key):
        self.key = key
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.rows = 0
        self.low = self.high = None
        self.before = None
        #: Of each state that can be reached: cost of the least edits, and their order by ASCII.
        self.best = {0: (0, 0)}
        self.pointers = tempfile.SpooledTemporaryFile(SPOOL)
        self.kept = tempfile.SpooledTemporaryFile(SPOOL)

    def add(self, turn: int | None, role: str, text: str, blank: bool, seen: bool, cut: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.rows and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.rows += 1
        gone = blank or seen
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut and not gone
        more = CUT if cut and not gone else 0
        pickle.dump((role, text), self.kept, 5)
        found: dict[int, tuple[int, int, str, int]] = {}
        moves = MOVES[initial if initial in ("s", "u", "a") else "", not gone]
        for q, (cost, order) in self.best.items():
            for to, price, letters, pointer in moves[q]:
                took = (cost + price + (more if letters[-1] != DELETE else 0), order, letters, pointer)
                if to not in found or took < found[to]:
                    found[to] = took
        # All of these end with this row's edit, so none is the beginning of another and their order stays.
        ranks = {q: i for i, (_, _, q) in enumerate(sorted((order, letters, q) for q, (_, order, letters, _) in found.items()))}
        self.best = {q: (found[q][0], ranks[q]) for q in found}
        self.pointers.write(bytes(found[q][3] if q in found else 255 for q in range(4)))

    def _ends(self) -> tuple[int, int, bool]:
        """Cost, last state, and whether an insertion follows the last row."""
        ends = [(cost, order, "", q, False) for q, (cost, order) in self.best.items() if q in ENDS]
        ends += [(cost + INSERTED, order, INSERT, q, True) for q, (cost, order) in self.best.items() if q == 2]
        cost, _, _, q, more = min(ends)
        return cost, q, more

    def repaired(self, q: int, more: bool) -> Iterator[tuple[str, str | None, str | None]]:
        """Edit, role and text, in order; deleted rows have none."""
        path, at = tempfile.SpooledTemporaryFile(SPOOL), 4 * self.rows
        path.truncate(0)
        blocks = []
        while at:
            lo = max(0, at - BACK)
            self.pointers.seek(lo)
            block = self.pointers.read(at - lo)
            out = bytearray()
            for i in range(len(block) - 4, -1, -4):
                p = block[i + q]
                q = p & 3
                out.append(p)
            path.seek(0, 2)
            blocks.append((path.tell(), len(out)))
            path.write(out[::-1])
            at = lo
        self.kept.seek(0)
        for start, size in reversed(blocks):
            path.seek(start)
            for p in path.read(size):
                at, edit = p & 3, "DKR"[p >> 3]
                if p & 4:
                    yield INSERT, ROLE[at], ""
                    at = NEXT[at]
                role, text = pickle.load(self.kept)
                yield (edit, None, None) if edit == DELETE else (edit, role if edit == KEEP else ROLE[at], text)
        if more:
            yield INSERT, ROLE[2], ""
        path.close()

    def finish(self) -> tuple[dict, Iterator[tuple[str, str | None, str | None]]]:
        cost, q, more = self._ends()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost}, self.repaired(q, more)

    def close(self) -> None:
        self.pointers.close()
        self.kept.close()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Every conversation of a sorted partition, when its last row has been read."""
    now = None
    names = ("conv_id", "turn", "role", "text", "dropped", "blank", "seen", "cut")
    for batch in batches:
        for key, turn, role, text, dropped, blank, seen, cut in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if now is None or key != now.key:
                if now:
                    yield now
                now = Conversation(key)
            if not dropped:
                now.add(turn, role, text, blank, seen, cut)
    if now:
        yield now


def _dropped(df: DataFrame, dropped: str | None) -> Column:
    return F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)


def _key(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv_id"].dataType)


def audit_conversations(df: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_repaired.

    dropped: a column of rows that count only as marks that their conversation exists.
    """
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", _key(df)), *((n, pa.int64()) for n in longs), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_repaired", pa.int64())])

    def run(batches):
        rows = []
        for talk in _conversations(batches):
            row, repaired = talk.finish()
            digest, letters, n = hashlib.sha256(), [], 0
            for edit, role, text in repaired:
                letters.append(edit)
                if role is not None:
                    digest.update(("\n" if n else "").encode() + f"{role}:{text}".encode())
                    n += 1
            talk.close()
            rows.append(row | {"conv_id": talk.key, "audit": "".join(letters), "repaired_sha256": digest.hexdigest(), "n_repaired": n})
            if len(rows) == 1024:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    ship(df.sparkSession)
    return _faults(df, _dropped(df, dropped)).mapInArrow(run, from_arrow_schema(schema))


def repair_conversations(df: DataFrame, dropped: str | None = None) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), role, text, edit (K, R or I)."""
    schema = pa.schema([("conv_id", _key(df)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def run(batches):
        rows = []
        for talk in _conversations(batches):
            place = 0
            for edit, role, text in talk.finish()[1]:
                if role is not None:
                    rows.append({"conv_id": talk.key, "place": place, "role": role, "text": text, "edit": edit})
                    place += 1
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            talk.close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    ship(df.sparkSession)
    return _faults(df, _dropped(df, dropped)).mapInArrow(run, from_arrow_schema(schema))
