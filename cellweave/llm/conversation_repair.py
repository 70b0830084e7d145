"""Cheapest repair of conversations whose turns are out of order, cut off, empty or repeated.

A row is one letter of its conversation's signature: its role's initial (system,
user, assistant or another) with its first fault. Signatures sorted from their ends
are an automaton that shares suffixes: a node is a letter before another node,
and every conversation that ends alike meets the same node. Per node and state of the
grammar ``(s?(ua)+)?`` the cost to go and the first edit of the best audit
are worked out once; an audit is read off along the nodes.

A conversation is never gathered row by row. Duplicates come from aggregates, and ranges of
rows become pieces of signature, one letter a row, so only a string as long as the
audit meets in one place. A task that plans holds some 40 bytes for each letter of the longest signature.

Only ``conv_id`` (of any orderable type), ``turn``, ``role`` and ``text`` are read;
other columns do not matter, whatever their names. NULL role or text counts as one
space, an empty role is another role; a NULL ``conv_id`` is a conversation of its own; a NULL turn comes first. Rows of one
turn are taken by role, then by the SHA-256 of their text. Repeated rows are
duplicates. A conversation of no rows is not there, and an empty table gives none.
"""

from __future__ import annotations

import hashlib
import itertools
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
RETELL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
ROLES, FAULTS = "sua", ("none", "truncated", "blank", "duplicate")
# Letters run over the roles (three and "another"), and within a role over FAULTS.
_FIRST = ord("A")

# Grammar states: nothing yet, after system, after user, after assistant; and the only turn to come next.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {(0, START): SYSTEM, (1, START): USER, (1, SYSTEM): USER, (1, ASSISTANT): USER, (2, USER): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_ORDER = ["turn", "role", "digest"]
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def turns_of(turns: DataFrame) -> DataFrame:
    """The columns this module works on: ``conv_id, turn, role, text, digest``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    digest = F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), digest.alias("digest"))


def _letter() -> Column:
    """The letter of a row that repeats no other."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    shown = F.rtrim("text", F.lit(SPACES))
    fault = F.when(shown == "", 2).when(F.substring(shown, -1, 1).isin(*ENDS), 0).otherwise(1)
    return F.chr((role * 4 + fault + _FIRST).cast("long"))


def signatures(turns: DataFrame) -> DataFrame:
    """``conv_id, signature, gaps``, a row for each conversation.

    ``gaps`` counts the turn numbers missing between the first and the last.
    """
    rows = turns_of(turns)
    # Equal rows combine in each task, so no text repeated at will meets in one group.
    alike = rows.select("conv_id", "turn", "role", "digest", _letter().alias("letter"))
    alike = alike.groupBy("conv_id", *_ORDER, "letter").agg(F.count("*").alias("copies"))
    at = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    said = alike.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first"), F.count("*").alias("times"))
    again = said.filter("times > 1").select(F.struct("conv_id", "role", "digest").alias("said"), "first")
    told = F.struct("conv_id", "role", "digest")
    marked = alike.join(again, told == F.col("said"), "left")
    late = F.coalesce(F.col("first") < at, F.lit(False))
    keys = ["conv_id", *_ORDER]
    ordered = marked.select(*keys, "letter", "copies", late.alias("late")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    kinds = {f.name: f for f in ordered.schema.fields}
    schema = StructType([kinds["conv_id"], *(kinds[k] for k in _ORDER)])
    for name in ("low", "high"):
        schema = schema.add(StructField(name, kinds["turn"].dataType))
    schema = schema.add("inner_turns", "long").add("piece", "string")
    pieces = ordered.mapInArrow(_pieces, schema)
    whole = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(*_ORDER, "piece"))).alias("pieces"),
        # The turns between a piece's lowest and highest are in no other piece.
        F.sum("inner_turns").alias("inner"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array("low", "high")))))).alias("outer"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    gaps = F.coalesce(F.col("high").cast("long") - F.col("low") + 1 - F.col("inner") - F.col("outer"), F.lit(0))
    return whole.select("conv_id", F.concat_ws("", "pieces.piece").alias("signature"), gaps.cast("long").alias("gaps"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch and conversation the letters in order, its first row's place, lowest and highest turn, and the turns between."""
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("conv_id", *_ORDER, "letter", "copies", "late")))
        out = []
        for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
            own = list(group)
            letters = []
            for *_, letter, copies, late in own:
                number = ord(letter) - _FIRST
                # Blank comes before duplicate as a row's first fault.
                copy = letter if number % 4 == 2 else chr(number - number % 4 + 3 + _FIRST)
                letters.append((copy if late else letter) + copy * (copies - 1))
            known = {r[1] for r in own} - {None}
            low, high = (min(known), max(known)) if known else (None, None)
            out.append((*own[0][:4], low, high, len(known - {low, high}), "".join(letters)))
        kinds = [batch.schema.field(n).type for n in ("conv_id", *_ORDER)]
        kinds += [kinds[1], kinds[1], pa.int64(), pa.string()]
        yield _batch(out, kinds, ["conv_id", *_ORDER, "low", "high", "inner_turns", "piece"])


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)


def plans(signed: DataFrame) -> DataFrame:
    """``signed`` (``conv_id``, ``signature``, ``gaps``) with ``blank, duplicate, truncated, illegal, cost, audit``.

    Signatures are dealt in ranges of their reversed text, conversations of equal ones by their
    id, so that a signature of any number of conversations is spread and yet planned once a task.
    """
    from_end = F.reverse("signature")
    kinds = {f.name: f for f in signed.schema.fields}
    schema = StructType([kinds["conv_id"], kinds["signature"], kinds["gaps"]])
    for name in _COUNTS:
        schema = schema.add(name, "long")
    dealt = signed.select("conv_id", "signature", "gaps").repartitionByRange(from_end, "conv_id").sortWithinPartitions(from_end, "conv_id")
    return dealt.mapInArrow(_plan, schema.add("audit", "string"))


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, before, found = Automaton(), None, ()
    for batch in batches:
        rows = []
        for signature in batch.column("signature").to_pylist():
            if signature != before:
                before, found = signature, automaton.best(signature)
            rows.append(found)
        made = _batch(rows, [pa.int64()] * len(_COUNTS) + [pa.string()], [*_COUNTS, "audit"])
        yield pa.RecordBatch.from_arrays([*batch.columns, *made.columns], names=[*batch.schema.names, *made.schema.names])


def _options(letter: int) -> list[list[tuple[int, int, int]]]:
    """For each grammar state: code of the edit, its cost and the state after it, least edit first."""
    role, fault = divmod(letter, 4)
    options = []
    for state in range(4):
        own = [(ord("D"), DELETE, state)]
        if fault < 2:
            more = CUT_OFF if fault == 1 else 0
            if (role, state) in _KEPT:
                own.append((ord("K"), more, _KEPT[role, state]))
            own.append((ord("R"), RETELL + more, _NEXT[state]))
        options.append(own)
    return options


_OPTIONS = [_options(letter) for letter in range(16)]
# After the last row only inserts are left; nothing, or an assistant's turn, may be the end.
_END = (0, 2 * INSERT, INSERT, 0)


class Automaton:
    """The live path of the suffix-shared automaton: node i stands for the last i + 1 rows.

    Given signatures in the order of their reversed text, every node is made once. Of a node
    are kept, by grammar state, the cost to go and the first edit, and the counts of its suffix.
    """

    def __init__(self) -> None:
        self.suffix = ""  # the path, last row first
        self.cost, self.edit, self.counts = array("q"), bytearray(), array("q")

    def best(self, signature: str) -> tuple[int, int, int, int, int, str]:
        """Blank, duplicate, truncated and illegal rows, the least cost, and the least of the audits that have it."""
        self._follow(signature[::-1])
        if not signature:
            return 0, 0, 0, 0, 0, ""
        top = len(signature) - 1
        return (*self.counts[4 * top : 4 * top + 4], self.cost[4 * top], self._audit(signature))

    def _follow(self, path: str) -> None:
        shared = _common(self.suffix, path)
        del self.cost[4 * shared :], self.edit[4 * shared :], self.counts[4 * shared :]
        ahead = tuple(self.cost[-4:]) if shared else _END
        counts = list(self.counts[-4:]) if shared else [0, 0, 0, 0]
        for i in range(shared, len(path)):
            number = ord(path[i]) - _FIRST
            role, fault = divmod(number, 4)
            if fault:
                counts[(2, 0, 1)[fault - 1]] += 1
            if i:
                after = (ord(path[i - 1]) - _FIRST) // 4
                counts[3] += role == 3 or after == 3 or ROLES[role] + ROLES[after] not in _LEGAL
            ahead = self._node(number, ahead)
            self.counts.extend(counts)
        self.suffix = path

    def _node(self, letter: int, ahead: tuple[int, ...]) -> tuple[int, ...]:
        least, edits = [], []
        for own in _OPTIONS[letter]:
            cost, edit = min((c + ahead[to], code) for code, c, to in own)
            least.append(cost)
            edits.append(edit)
        # A turn may be put in first, and then another; a third would lead back to where the first began.
        user, assistant = least[USER], least[ASSISTANT]
        after = {USER: min(user, INSERT + assistant), ASSISTANT: min(assistant, INSERT + user)}
        for state in range(4):
            inserted = INSERT + after[_NEXT[state]]
            if inserted <= least[state]:
                edits[state] = min(edits[state], ord("I")) if inserted == least[state] else ord("I")
                least[state] = inserted
        self.cost.extend(least)
        self.edit.extend(edits)
        return tuple(least)

    def _audit(self, signature: str) -> str:
        out, state = bytearray(), START
        for at in range(len(signature) - 1, -1, -1):
            role = (ord(signature[len(signature) - 1 - at]) - _FIRST) // 4
            while True:
                edit = self.edit[4 * at + state]
                out.append(edit)
                state = _after(state, edit, role)
                if edit != ord("I"):
                    break
        return out.decode() + "I" * (_END[state] // INSERT)


def _after(state: int, edit: int, role: int) -> int:
    if edit == ord("D"):
        return state
    return _KEPT[role, state] if edit == ord("K") else _NEXT[state]


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def repaired(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The turns that the plans leave, in order: ``conv_id, place, turn, edit, role, text``.

    ``edit`` is K, R or I; inserted turns have no ``turn``. The rows of a conversation stay together.
    """
    together = _together(turns, planned)
    kinds = {f.name: f for f in together.schema.fields}
    schema = StructType([kinds["conv_id"]]).add("place", "long").add("turn", kinds["turn"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place = None, 0
        for types, lines in _walk(batches):
            rows = []
            for opened, line in lines:
                if opened is not None:
                    conv, place = opened[0], 0
                if line is not None:
                    rows.append((conv, place, *line))
                    place += 1
            own = [types["conv_id"], pa.int64(), types["turn"], pa.string(), pa.string(), pa.string()]
            yield _batch(rows, own, ["conv_id", "place", "turn", "edit", "role", "text"])

    return together.mapInArrow(run, schema.add("edit", "string").add("role", "string").add("text", "string"))


def digests(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with ``repaired_sha256``, the digest of the ``role:text`` lines of ``repaired`` joined by newlines.

    A digest needs its conversation's rows in order, so one task reads a conversation to its end,
    a batch at a time; nothing but the audit (a letter a row) is held.
    """
    together = _together(turns, planned)
    names = ["conv_id", "gaps", *_COUNTS, "audit"]
    schema = StructType([f for n in names for f in together.schema.fields if f.name == n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report, hashed, begun, kinds = None, hashlib.sha256(), False, []
        for types, lines in _walk(batches):
            rows, kinds = [], [*(types[n] for n in names), pa.string()]
            for opened, line in lines:
                if opened is not None:
                    if report is not None:
                        rows.append((*report, hashed.hexdigest()))
                    report, hashed, begun = opened, hashlib.sha256(), False
                if line is not None:
                    hashed.update(("\n" * begun + f"{line[2]}:{line[3]}").encode())
                    begun = True
            yield _batch(rows, kinds, [*names, "repaired_sha256"])
        if report is not None:
            yield _batch([(*report, hashed.hexdigest())], kinds, [*names, "repaired_sha256"])

    return together.mapInArrow(run, schema.add("repaired_sha256", "string"))


def _together(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The plan of each conversation before its rows in order, all in one partition."""
    plan = planned.select("conv_id", "gaps", *_COUNTS, "audit", F.lit(0).alias("rank"))
    rows = turns_of(turns).withColumn("rank", F.lit(1))
    both = plan.unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "rank", *_ORDER)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator]]:
    """For each batch its types and its events: a plan that opens a conversation, or a line (turn, edit, role, text).

    Inserted lines follow at once on what they come after, so that no end need be awaited.
    """
    state: dict = {"audit": "", "at": 0, "grammar": START}

    def events(batch: pa.RecordBatch) -> Iterator[tuple]:
        names = ("rank", "turn", "role", "text", "conv_id", "gaps", *_COUNTS, "audit")
        for rank, turn, role, text, *report in zip(*(batch.column(n).to_pylist() for n in names)):
            if rank == 0:
                state.update(audit=report[-1], at=0, grammar=START)
                yield report, None
            else:
                edit = ord(state["audit"][state["at"]])
                state["at"] += 1
                if edit != ord("D"):
                    state["grammar"] = after = _after(state["grammar"], edit, ROLES.find(role[:1]))
                    yield None, (turn, chr(edit), role if edit == ord("K") else _NAMES[after], text)
            yield from inserts()

    def inserts() -> Iterator[tuple]:
        while state["audit"][state["at"] : state["at"] + 1] == "I":
            state["grammar"] = _NEXT[state["grammar"]]
            state["at"] += 1
            yield None, (None, "I", _NAMES[state["grammar"]], "")

    for batch in batches:
        yield {f.name: f.type for f in batch.schema}, events(batch)
