"""Repair of conversations by an automaton that they share.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Rows may be kept (cost 0), given the role user or
assistant (3), deleted (4), and rows with one of these roles and no text inserted anywhere (3). Blank rows and rows whose role
and text came earlier must be deleted; a row whose text does not end with a sentence mark costs 3 more unless it is deleted.

1. Faults. Rows are reduced to conversation, turn, digest and flags, and equal ones are counted before they are shuffled. A
   digest's first turn tells the later ones that they repeat it.
2. Signatures. Rows in their order give one letter each, so a conversation is a short string: nothing else of it matters for
   its cheapest repair.
3. Automaton. Signatures are minimised from the end: those that end alike share the nodes of their common suffix, a node being
   a suffix. Sorted by the reversed signature, conversations come so that every node of a range is built once, above the nodes
   it leads to. A node holds the cost to go and the best next edit for each of the four states of the grammar. Nodes whose costs
   differ by a constant are one class; transitions are looked up by class, so long signatures cost little more than their length.
4. Edits. The audit of a conversation meets its rows again, in order, in one stream: no conversation is held in memory, however
   long it is; only its signature and audit, one byte for each row, are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import landed

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
_TRUNCATED = 3
_SPACE = " \t\n\x0b\f\r"
_MARKS = (".", "!", "?")
#: Grammar states: nothing yet, after s, after u, after a. Legal ends are the first and the last.
_FINAL = (True, False, False, True)
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The state after the one role, user or assistant, that may come next.
_STEP = (2, 2, 3, 2)
_GIVEN = ("user", "user", "assistant", "user")

_SIGNED = "conv string, conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def _key(turns: DataFrame) -> Column:
    """A conversation's id as text, NULL apart from every other."""
    return F.coalesce(F.concat(F.lit("="), turns["conv_id"].cast("string")), F.lit(""))


def _rows(turns: DataFrame) -> DataFrame:
    role, text = (F.coalesce(turns[c].cast("string"), F.lit(" ")) for c in ("role", "text"))
    place = F.coalesce(turns["turn"].cast("decimal(20,0)"), F.lit("-" + "9" * 20).cast("decimal(20,0)"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return turns.select(_key(turns).alias("conv"), turns["conv_id"], turns["turn"].cast("long").alias("turn"), place.alias("place"), digest.alias("digest"), role.alias("role"), text.alias("text"))


def signatures(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv (its key), conv_id, gaps, blank, duplicate, truncated, illegal, signature.

    A row's letter is its role's initial, o for other roles, in upper case if truncated, or x if it must go.
    """
    rows = _rows(turns)
    initial = F.substr(F.col("role"), F.lit(1), F.lit(1))
    ending = F.substr(F.rtrim(F.col("text"), F.lit(_SPACE)), F.lit(-1), F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    flag = F.when(ending == "", "b").when(ending.isin(*_MARKS), letter).otherwise(F.upper(letter))
    counted = rows.groupBy("conv", "conv_id", "turn", "place", "digest", letter.alias("letter"), flag.alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest")).agg(F.min("place").alias("f_place"))
    known = counted.join(first, (F.col("conv") == F.col("f_conv")) & (F.col("digest") == F.col("f_digest")))
    lead = F.when(F.col("flag") == "b", "b").when(F.col("place") == F.col("f_place"), F.col("flag")).otherwise("d")
    rest = F.when(F.col("flag") == "b", "b").otherwise("d")
    ordered = (
        known.select("conv", "conv_id", "turn", "place", "digest", "letter", "n", lead.alias("lead"), rest.alias("rest"))
        .repartition("conv").sortWithinPartitions("conv", "place", "digest").select("conv", "conv_id", "turn", "letter", "n", "lead", "rest")
    )
    ddl = _SIGNED.format(id=turns.schema["conv_id"].dataType.simpleString())

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, done, id_type, names = None, [], pa.int64(), [c.split()[0] for c in ddl.split(", ")]
        kinds = [pa.string(), None, *[pa.int64()] * 5, pa.string()]

        def told() -> tuple:
            gaps = most - least + 1 - distinct if distinct else 0
            every = "".join(letters)
            truncated = sum(map(every.count, "SUAO"))
            return (conv, conv_id, gaps, every.count("b"), every.count("d"), truncated, illegal, every.replace("b", "x").replace("d", "x"))

        def batch_of_done() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k or id_type) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for key, number, turn, letter, n, lead, rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != conv:
                    if conv is not None:
                        done.append(told())
                    conv, conv_id, letters, last, illegal, distinct, least, most = key, number, [], "", 0, 0, None, None
                letters.append(lead + rest * (n - 1))
                illegal += (last + letter not in ("su", "ua", "au") if last else 0) + (n - 1)
                last = letter
                if turn is not None and turn != most:
                    least, most, distinct = (turn if least is None else least), turn, distinct + 1
            if len(done) >= 10_000:
                yield batch_of_done()
                done = []
        if conv is not None:
            done.append(told())
        yield batch_of_done()

    return ordered.mapInArrow(sign, ddl)


class SuffixAutomaton:
    """Cheapest repairs of signatures that come sorted by their reversal. ``path`` holds the nodes of the last one, end first."""

    def __init__(self) -> None:
        ends = [0 if final else None for final in _FINAL]
        lengths = {0: 0, 1: 2, 2: 1, 3: 0}
        costs = tuple(0 if ends[q] == 0 else _COST[INSERT] * lengths[q] for q in range(4))
        self.path = [(costs, tuple("" if final else INSERT for final in _FINAL))]
        self.read = ""
        self.built = 1
        self._classes: dict[tuple, tuple] = {}

    def _above(self, costs: tuple, letter: str) -> tuple:
        """Costs and best edits of the node that leads to one with ``costs`` by ``letter``."""
        role, extra = letter.lower(), _TRUNCATED if letter.isupper() else 0
        options: list[dict[str, int]] = []
        for q in range(4):
            found = {DELETE: _COST[DELETE] + costs[q]}
            if letter != "x":
                if (to := _NEXT[role][q] if role in _NEXT else None) is not None:
                    found[KEEP] = extra + costs[to]
                found[REROLE] = _COST[REROLE] + extra + costs[_STEP[q]]
            options.append(found)
        plain = [min(o.values()) for o in options]
        best = [min(plain[q], _COST[INSERT] + plain[_STEP[q]], 2 * _COST[INSERT] + plain[_STEP[_STEP[q]]]) for q in range(4)]
        for q in range(4):
            options[q][INSERT] = _COST[INSERT] + best[_STEP[q]]
        # all edits differ in their initial, so the least initial among the cheapest leads to the least audit
        return tuple(best), tuple(min(e for e, c in options[q].items() if c == best[q]) for q in range(4))

    def repair(self, reversed_signature: str) -> tuple[int, str]:
        """Cost and audit of the signature, from the start state."""
        shared = 0
        for a, b in zip(self.read, reversed_signature):
            if a != b:
                break
            shared += 1
        del self.path[shared + 1 :]
        for letter in reversed_signature[shared:]:
            costs = self.path[-1][0]
            base = min(costs)
            node = (tuple(c - base for c in costs), letter)
            if node not in self._classes:
                self._classes[node] = self._above(*node)
            above, edits = self._classes[node]
            self.path.append((tuple(c + base for c in above), edits))
            self.built += 1
        self.read = reversed_signature
        audit, q, depth = [], 0, len(reversed_signature)
        while edit := self.path[depth][1][q]:
            audit.append(edit)
            if edit == KEEP:
                q = _NEXT[reversed_signature[depth - 1].lower()][q]
            elif edit != DELETE:
                q = _STEP[q]
            depth -= edit != INSERT
        return self.path[-1][0][0], "".join(audit)


def repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: what ``signatures`` tells, and the cost and audit of its cheapest repair.

    turns: conv_id, turn, role, text. Rows are taken by turn, NULL first, and rows of one turn by the digest of role and text.
    NULL roles and texts count as one space; rows with a NULL conv_id are one conversation; a role that is empty or of another
    initial cannot be kept. The audit names the edits in order by their initials, the ASCII-least of the cheapest. Repeated
    rows are duplicates. An empty table gives no rows; further columns are ignored.
    """
    signed = landed(signatures(turns), "signatures")
    # equal signatures are split by conversation, so that a very common one fills several ranges
    ranged = signed.withColumn("backward", F.reverse("signature")).repartitionByRange("backward", F.xxhash64("conv")).sortWithinPartitions("backward")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, last = SuffixAutomaton(), None
        for batch in batches:
            found = []
            for backward in batch.column("backward").to_pylist():
                if backward != last:
                    last, result = backward, automaton.repair(backward)
                found.append(result)
            columns = [*batch.columns[:-2], pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-2], "cost", "audit"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in signed.schema if f.name != "signature")
    return landed(ranged.mapInArrow(solve, ddl + ", cost long, audit string"), "repairs")


_EDITED = "conv string, conv_id {id}, turn long, edit string, role string, text string"


def edited(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of ``turns`` and the inserted ones with their edits, in the repaired order within each partition.

    conv, conv_id, turn, edit (an initial), role and text after the edit; deleted rows stand there with edit D. All rows of a
    conversation follow each other in one partition. Inserted rows have no turn.
    """
    rows = _rows(turns).withColumn("audit", F.lit(None).cast("string"))
    heads = plans.select("conv", "conv_id", *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[2:7]), "audit")
    ordered = rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), "place", "digest").drop("place", "digest")
    ddl = _EDITED.format(id=turns.schema["conv_id"].dataType.simpleString())
    names = [c.split()[0] for c in ddl.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, conv_id, audit, at, q, out = None, None, "", 0, 0, []

        def inserts() -> None:
            nonlocal at, q
            while audit[at : at + 1] == INSERT:
                out.append((conv, conv_id, None, INSERT, _GIVEN[q], ""))
                at, q = at + 1, _STEP[q]

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal out
            kinds = [pa.string(), id_type, pa.int64(), *[pa.string()] * 3]
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for key, number, turn, role, text, plan in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if plan is not None:
                    inserts()
                    conv, conv_id, audit, at, q = key, number, plan, 0, 0
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == REROLE:
                    role, q = _GIVEN[q], _STEP[q]
                elif edit == KEEP:
                    q = _NEXT[role[0]][q]
                out.append((conv, conv_id, turn, edit, role, text))
            yield flush(id_type)
        inserts()
        if out:
            yield flush(id_type)

    return ordered.mapInArrow(apply, ddl)


def digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of what ``edited`` gives, read in its order: ``role:text`` of the rows that stay, newline-joined."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, first, done = None, None, True, []
        for batch in batches:
            for key, edit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text")), strict=True):
                if key != conv:
                    if conv is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state, first = key, hashlib.sha256(), True
                if edit != DELETE:
                    state.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], names=["conv", "repaired_sha256"])
                done = []
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])

    return rows.mapInArrow(digest, "conv string, repaired_sha256 string")
