"""Repair of the order of roles in conversations, with the cheapest list of edits as an audit.

Rows are kept, given another role, deleted or inserted until the roles read as an optional system
message and then pairs of user and assistant. A dynamic program walks over the rows of a conversation
and holds, for each of the four places in that pattern, the cheapest edits that lead there. The edits
are linked nodes, so that paths share what they have in common. Of equal costs the edits that come
first in the alphabet win: nodes know their 1st, 2nd, 4th, ... ancestors and a rolling hash of their
path, so two paths are compared by a binary search for the end of their common start, and what equal
hashes claim is verified letter by letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column

# What the edits cost, the white space of texts, and the ends of whole sentences.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}

# Places in the pattern: nothing yet, after the system message, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# By place: what a row with this initial leads to, and the role that comes next and where that leads.
_KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))

# Nodes that are gathered before the edits that all paths share are carried out.
NODES = 1 << 12
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Paths:
    """A tree of edits: each node is a letter after the path of its parent. Node 0 is the empty path."""

    def __init__(self) -> None:
        self.parent, self.letter, self.depth, self.hash = [0], [""], [0], [0]
        self.ups: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... letters back

    def add(self, parent: int, letter: str) -> int:
        node = len(self.parent)
        self.parent.append(parent)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _PRIME)
        ups, at = [parent], parent
        while len(self.ups[at]) >= len(ups):
            at = self.ups[at][len(ups) - 1]
            ups.append(at)
        self.ups.append(ups)
        return node

    def text(self, node: int, above: int = 0) -> str:
        """Letters from below ``above`` down to ``node``."""
        out = []
        while node != above:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))

    def at_depth(self, node: int, depth: int) -> int:
        back = self.depth[node] - depth
        while back:
            step = back.bit_length() - 1
            node = self.ups[node][step]
            back -= 1 << step
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth have equal paths: what their hashes claim, letter by letter."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the path of ``a`` comes before that of ``b``; a path comes before longer ones."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.at_depth(a, shorter), self.at_depth(b, shorter)
        if self.hash[x] == self.hash[y] and self._same(x, y):
            return self.depth[a] < self.depth[b]
        if self.hash[x] == self.hash[y]:
            return self.text(a) < self.text(b)
        for step in reversed(range(shorter.bit_length())):
            if step < len(self.ups[x]):
                p, q = self.ups[x][step], self.ups[y][step]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        if not self._same(self.parent[x], self.parent[y]):
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]

    def common(self, nodes: list[int]) -> int:
        """The deepest node that all ``nodes`` come from."""
        found = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[found], self.depth[node])
            x, y = self.at_depth(found, depth), self.at_depth(node, depth)
            for step in reversed(range(depth.bit_length())):
                if step < len(self.ups[x]) and self.ups[x][step] != self.ups[y][step]:
                    x, y = self.ups[x][step], self.ups[y][step]
            found = x if x == y else self.parent[x]
        return found


class Repair:
    """The edits of one conversation, row by row: per place in the pattern the cost and the path.

    What all paths share is taken from the tree and carried out on the rows that wait for it, so that a
    long conversation holds few rows and paths that still differ.
    """

    def __init__(self, nodes: int = NODES) -> None:
        self.paths, self.nodes, self.limit = Paths(), nodes, nodes
        self.best = self._inserted([(0, 0), None, None, None])
        self.waiting: list[tuple[str, str]] = []
        self.place = EMPTY

    def _offer(self, best: list, place: int, cost: int, parent: int, letter: str) -> bool:
        held = best[place]
        if held is not None and cost > held[0]:
            return False
        node = self.paths.add(parent, letter)
        if held is not None and cost == held[0] and not self.paths.less(node, held[1]):
            return False
        best[place] = (cost, node)
        return True

    def _inserted(self, best: list) -> list:
        """``best`` with rows inserted after it where that is cheaper."""
        changed = True
        while changed:
            changed = False
            for place in range(4):
                if best[place] is not None:
                    cost, node = best[place]
                    changed |= self._offer(best, _NEXT[place][1], cost + INSERT, node, "I")
        # What follows the empty place or a system message can follow an assistant as well, but for a
        # kept system message, which has to be deleted there. Dearer paths cannot win any more.
        for place, more in ((EMPTY, DELETE), (SYSTEM, 0)):
            if best[place] is not None and best[place][0] > best[ASSISTANT][0] + more:
                best[place] = None
        return best

    def row(self, role: str, text: str, deleted: bool, truncated: bool) -> list[tuple[str, str | None, str]]:
        """Take the next row, ``deleted`` if it has to go, and return the edits settled by now."""
        best: list = [None] * 4
        extra, initial = TRUNCATED if truncated else 0, role[:1]
        self.waiting.append((role, "" if deleted else text))
        for place, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            self._offer(best, place, cost + DELETE, node, "D")
            if deleted:
                continue
            kept, other = _KEEP[place].get(initial), _NEXT[place][1]
            if kept is not None:
                self._offer(best, kept, cost + extra, node, "K")
            if other != kept:
                self._offer(best, other, cost + extra + REROLE, node, "R")
        self.best = self._inserted(best)
        return self._settle() if len(self.paths.parent) > self.limit else []

    def _settle(self) -> list[tuple[str, str | None, str]]:
        """Take the edits that all paths share out of the tree, and forget dead paths."""
        shared = self.paths.common([held[1] for held in self.best if held is not None])
        out = self._edited(self.paths.text(shared))
        fresh, known = Paths(), {}
        for place, held in enumerate(self.best):
            if held is not None:
                node = 0
                for letter in self.paths.text(held[1], shared):
                    if (node, letter) not in known:
                        known[node, letter] = fresh.add(node, letter)
                    node = known[node, letter]
                self.best[place] = (held[0], node)
        self.paths, self.limit = fresh, max(self.nodes, 2 * len(fresh.parent))
        return out

    def _edited(self, letters: str) -> list[tuple[str, str | None, str]]:
        """(edit, role, text) of the edits ``letters``, carried out on the first rows that wait."""
        out, taken = [], 0
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.waiting[taken]
            taken += letter != "I"
            if letter == "D":
                out.append((letter, None, ""))
            elif letter == "K":
                out.append((letter, role, text))
                self.place = _KEEP[self.place][role[:1]]
            else:
                role, self.place = _NEXT[self.place]
                out.append((letter, role, text))
        del self.waiting[:taken]
        return out

    def end(self) -> tuple[int, list[tuple[str, str | None, str]]]:
        """Cost of all edits, and those not settled before."""
        ends = [held for held in (self.best[EMPTY], self.best[ASSISTANT]) if held is not None]
        first = ends[0]
        for held in ends[1:]:
            if held[0] < first[0] or (held[0] == first[0] and self.paths.less(held[1], first[1])):
                first = held
        return first[0], self._edited(self.paths.text(first[1]))


class Conversation:
    """The faults of one conversation, its repair, and the digest of what is settled."""

    def __init__(self, number) -> None:
        self.number, self.repair = number, Repair()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.least = self.most = self.before = None
        self.audit, self.digest, self.rows = [], hashlib.sha256(), 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> list[tuple]:
        """Take the next row and return the repaired rows settled by now: place, edit, role, text."""
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ENDS else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if turn is not None and turn != self.most:  # turns come in order
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        return self._settled(self.repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated"))

    def _settled(self, edits: list[tuple]) -> list[tuple]:
        out = []
        for letter, role, text in edits:
            self.audit.append(letter)
            if role is not None:
                self.digest.update(f"{role}:{text}".encode() if not self.rows else f"\n{role}:{text}".encode())
                out.append((self.rows, letter, role, text))
                self.rows += 1
        return out

    def end(self) -> tuple[tuple, list[tuple]]:
        """Report on the conversation, and the repaired rows not settled before."""
        cost, edits = self.repair.end()
        rows = self._settled(edits)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        counts = (gaps, *self.counts.values(), self.illegal, cost)
        return (self.number, *counts, "".join(self.audit), self.digest.hexdigest()), rows


def _ordered(
    messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
    absent_col: str | None, copy_col: str | None,
) -> DataFrame:
    """Rows by conversation and turn, with whether role and text were seen earlier."""
    role, text = (F.coalesce(column(messages, c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    absent = F.lit(False) if absent_col is None else F.coalesce(column(messages, absent_col), F.lit(False))
    copy = F.lit(0).cast("long") if copy_col is None else column(messages, copy_col).cast("long")
    rows = messages.select(
        column(messages, conv_col).alias("conv_id"),
        column(messages, turn_col).cast("long").alias("turn"),
        role.alias("role"),
        F.when(absent, F.lit("")).otherwise(text).alias("text"),
        absent.alias("absent"),
        copy.alias("copy"),
    )
    same = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    rows = rows.withColumn("same", same).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "absent", "same").orderBy(F.col("turn").asc_nulls_first(), "copy")
    rows = rows.withColumn("again", F.row_number().over(earlier) > 1)
    ordered = rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "same", "copy")
    return ordered.select("conv_id", "turn", "role", "text", "absent", "again")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, list[tuple], tuple | None]]:
    """Walk over ordered rows: the conversation, repaired rows as they settle, and at its end the report."""
    held = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "absent", "again")]
        for number, turn, role, text, absent, again in zip(*columns, strict=True):
            if held is None or held.number != number:
                if held is not None:
                    report, rows = held.end()
                    yield held, rows, report
                held = Conversation(number)
            if not absent:
                rows = held.add(turn, role, text, again)
                if rows:
                    yield held, rows, None
    if held is not None:
        report, rows = held.end()
        yield held, rows, report


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], limit: int = 8 << 20):
    """Batches of at most 4096 rows and about ``limit`` characters."""
    out, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=k) for c, k in zip(columns, kinds, strict=True)], names)

    for row in rows:
        out.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(out) >= 4096 or size >= limit:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    absent_col: str | None = None,
    copy_col: str | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and ``repaired_sha256``.

    Each row's first fault counts: a blank text, a role and text seen earlier, a text that does not end as a
    sentence. ``illegal`` counts neighbours whose roles cannot follow one another, ``gaps`` the whole
    numbers missing between the turns. ``audit`` has a letter per edit, K(eep), R(erole), D(elete) and
    I(nsert), and ``repaired_sha256`` is over the repaired ``role:text`` lines.

    Rows come by turn, nulls first, rows of one turn by a checksum of their role and text and then by
    ``copy_col`` (a number), if given. Rows where ``absent_col`` is true count for nothing, but their
    conversation has a row. A null role or text is one space; rows without a conversation are one
    conversation; repeated rows are duplicates; without rows the result is empty. Other columns are not
    looked at.

    One shuffle by conversation: repeated rows are numbered and rows sorted within it, both of which
    spill to disk, and a task then streams through its conversations. It holds one audit at a time and the
    rows whose edits are not settled. A digest of a whole conversation has to read its rows in order, so
    a conversation is not divided.
    """
    ordered = _ordered(messages, conv_col, turn_col, role_col, text_col, absent_col, copy_col)
    schema = ordered.schema["conv_id"].dataType.simpleString()
    kinds = [pa.int64()] * len(_COUNTS) + [pa.string(), pa.string()]
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            found = (report for _, _, report in _conversations(chain([first], batches)) if report is not None)
            yield from _batches(found, names, [first.schema.field("conv_id").type, *kinds])

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return ordered.mapInArrow(reports, f"conv_id {schema}, {counts}, audit string, repaired_sha256 string")


def repaired_messages(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    absent_col: str | None = None,
    copy_col: str | None = None,
) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id``, ``place`` from 0, ``edit``, ``role``, ``text``.

    ``edit`` is K, R or I; deleted rows are left out. Odd rows are taken as in :func:`repair_report`.
    """
    ordered = _ordered(messages, conv_col, turn_col, role_col, text_col, absent_col, copy_col)
    schema = ordered.schema["conv_id"].dataType.simpleString()
    names, kinds = ["conv_id", "place", "edit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            found = ((held.number, *row) for held, rows, _ in _conversations(chain([first], batches)) for row in rows)
            yield from _batches(found, names, [first.schema.field("conv_id").type, *kinds])

    return ordered.mapInArrow(repaired, f"conv_id {schema}, place long, edit string, role string, text string")
