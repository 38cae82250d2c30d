r"""Repair of a conversation's structure by the cheapest edits.

Each row of a conversation is kept, given the other role, or deleted, and rows without text may be inserted anywhere, so
that the initials of the roles read (s?(ua)+)? at the end. Blank rows and duplicates must go; a truncated row that stays
costs one more. Among the cheapest edits the audit, their initials in order, is the least in ASCII order.

The weight of a set of edits is one whole number. Its high digits carry the cost. Its low digits have a field of SLOT
letters for every row, filled from the left with the inserts before the row and then the row's own edit, and a last one for
inserts at the end; what a field doesn't use stays zero. A field ends with the first letter that is no insert, so two
different audits differ first at the same place of both numbers, and comparing the numbers compares cost, then audit. The
weights of edges simply add up, and the least sum over a path through the states (nothing yet, after system, after user,
after assistant) decides everything.

Rows are range-partitioned by conversation and turn, so a conversation with any share of all rows is dealt over many tasks.
A conversation that lies within one partition is finished there. The first and the last one of a partition, and runs of over
SEGMENT_ROWS rows or SEGMENT_CHARS characters, may go on elsewhere: such a segment is written with the least weights from
every state to every other, which a scan over the conversation's segments adds up (costs, and the places of the audits so
far in their order, since the audits themselves are long); then each segment repairs its rows between the states chosen for
it, and the pieces are hashed in order as they stream by. Duplicates across segments are known beforehand from each text's
first place in its conversation, counted by digest with map-side aggregation and joined back with frequent texts dealt.

Defined cases: rows of one turn come in order of role, then text (its first TIE_CHARS characters, then its digest); null
turns come first; a conversation without an id is one like others, and its id stays null; roles are read by their first
character as it is, so an unknown one must be given another role or be deleted; repeated rows are duplicates; an empty table gives no rows;
other columns are left out. Equal texts are told by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_found, written

SEGMENT_ROWS, SEGMENT_CHARS = 2048, 4 << 20
TIE_CHARS = 100

# --- weights ---------------------------------------------------------------------------------------------------------

#: States by the last role that stands: none, system, user, assistant; and the state after a role's initial.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
#: Letters in ASCII order; a zero digit means no letter.
LETTERS = " DIKR"
DIGIT = 3
SLOT = 3
FIELD = DIGIT * SLOT
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def _inserted(state: int, n: int) -> tuple[int, str]:
    """State after n inserts, and their roles; -1 if none can follow."""
    roles = ""
    for _ in range(n):
        c = next((x for x in NEXT[state] if x in ROLE), None)
        state, roles = NEXT[state][c], roles + c
    return state, roles


def _edges(initial: str, gone: bool, truncated: bool) -> dict[tuple[int, int], tuple[int, int, str]]:
    """The least (cost, field, letters) from state to state over one row; an empty initial means the end of the conversation."""
    best: dict[tuple[int, int], tuple[int, int, str]] = {}
    for state in range(4):
        for n in range(SLOT):
            at, _ = _inserted(state, n)
            options = [("", at)] if not initial else [("D", at)]
            if initial and not gone:
                options += [("K", NEXT[at][initial])] if initial in NEXT[at] else []
                options += [("R", NEXT[at][c]) for c in ROLE if c in NEXT[at]]
            for letter, to in options:
                letters = "I" * n + letter
                field = 0
                for c in letters:
                    field = field << DIGIT | LETTERS.index(c)
                field <<= DIGIT * (SLOT - len(letters))
                found = (sum(COST[c] for c in letters) + (truncated and letter in ("K", "R")), field, letters)
                best[state, to] = min(best.get((state, to), found), found)
    return best


#: Edges by kind of row: initial (any other one as "?"), must it go, is it truncated.
EDGES = {(i, g, t): _edges(i, g, t) for i in "sua?" for g in (False, True) for t in (False, True)}
LAST = _edges("", False, False)


def _kind(role: str, fault: str) -> tuple[str, bool, bool]:
    initial = role[:1]
    return (initial if initial and initial in "sua" else "?"), fault in ("blank", "duplicate"), fault == "truncated"


def least_weights(kinds: list[tuple[str, bool, bool]], start: int, end: bool) -> list[int | None]:
    """The least weight from state `start` to each state over these rows, and over the end's inserts if `end`."""
    steps = [EDGES[k] for k in kinds] + ([LAST] if end else [])
    high = FIELD * len(steps)
    weights: list[int | None] = [None] * 4
    weights[start] = 0
    for n, edges in enumerate(steps, 1):
        shift = high - FIELD * n
        new: list[int | None] = [None] * 4
        for (a, b), (cost, field, _) in edges.items():
            if weights[a] is not None:
                w = weights[a] + (cost << high) + (field << shift)
                if new[b] is None or w < new[b]:
                    new[b] = w
        weights = new
    return weights


def letters_of(weight: int, steps: int) -> list[str]:
    """Each field's letters."""
    mask, one = (1 << FIELD) - 1, (1 << DIGIT) - 1
    fields = ((weight >> FIELD * (steps - 1 - n)) & mask for n in range(steps))
    return ["".join(LETTERS[f >> DIGIT * k & one] for k in range(SLOT - 1, -1, -1)).strip() for f in fields]


def repaired(rows: list[tuple[str, str]], letters: list[str], state: int) -> list[str]:
    """The lines `role:text` that the edits leave, from this state on."""
    lines = []
    for n, some in enumerate(letters):
        for c in some:
            if c == "D":
                continue
            if c == "K":
                initial, role = rows[n][0][:1], rows[n][0]
            else:
                initial = next(x for x in NEXT[state] if x in ROLE)
                role = ROLE[initial]
            lines.append(f"{role}:{'' if c == 'I' else rows[n][1]}")
            state = NEXT[state][initial]
    return lines


# --- rows ------------------------------------------------------------------------------------------------------------

PAIRS = {"su", "ua", "au"}


def _fault(text: str, again: bool) -> str:
    end = text.rstrip(" \t\n\v\f\r")
    return "blank" if not end else "duplicate" if again else "truncated" if end[-1] not in ".!?" else ""


class Run:
    """Consecutive rows of one conversation, and what is counted of them."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.rows, self.kinds, self.size = conv, [], [], 0
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.key = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None:
            if self.high is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + role[:1] not in PAIRS
        fault = _fault(text, again)
        self.faults[fault] += 1
        self.kinds.append(_kind(role, fault))
        self.rows.append((role, text))
        self.size += len(text)

    def result(self) -> tuple:
        """The row of a whole conversation."""
        weights = least_weights(self.kinds, 0, True)
        best = min(w for k, w in enumerate(weights) if w is not None and k in ENDS)
        steps = len(self.kinds) + 1
        letters = letters_of(best, steps)
        text = "\n".join(repaired(self.rows, letters, 0))
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return (gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, best >> FIELD * steps, "".join(letters), hashlib.sha256(text.encode()).hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SEGMENT = "turn long, tie string, at long, n_rows long, low long, high long, turns long, head string, tail string, roles array<string>, texts array<string>, kinds array<string>, weights array<binary>"


def _finish(ordered: DataFrame, segment_rows: int, segment_chars: int) -> DataFrame:
    """Rows of whole conversations, and segments of those that may go on in another task."""
    schema = f"conv_id long, whole boolean, {RESULT}, {_SEGMENT}"
    names = [x.split()[0] for x in schema.split(", ")]

    def segment(run: Run) -> dict:
        weights = [least_weights(run.kinds, q, False) for q in range(4)]
        size = (FIELD * len(run.kinds) + 64) // 8
        return {
            "conv_id": run.conv, "whole": False, "blank": run.faults["blank"], "duplicate": run.faults["duplicate"], "truncated": run.faults["truncated"], "illegal": run.illegal,
            "turn": run.key[0], "tie": run.key[1], "at": run.key[2], "n_rows": len(run.rows), "low": run.low, "high": run.high, "turns": run.turns,
            "head": run.rows[0][0][:1] if run.rows else "", "tail": run.rows[-1][0][:1] if run.rows else "", "roles": [r for r, _ in run.rows], "texts": [t for _, t in run.rows],
            "kinds": ["".join(("1" if x is True else "0" if x is False else x) for x in k) for k in run.kinds], "weights": [None if w is None else w.to_bytes(size, "big") for row in weights for w in row],
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0
        run: Run | None = None
        open_start = True  # the partition's first conversation may have begun in another task

        def close(last: bool) -> None:
            nonlocal held
            if open_start or last:
                out.append(segment(run))
                held += run.size + 32 * len(run.rows)
            else:
                out.append(dict(zip(names, (run.conv, True, *run.result()), strict=False)))

        def flushed() -> pa.RecordBatch:
            nonlocal held
            rows, held = [{n: r.get(n) for n in names} for r in out], 0
            out.clear()
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        for batch in batches:
            for conv, turn, role, text, again, kept, tie, at in zip(*(batch.column(n).to_pylist() for n in ("conv", "turn", "role", "text", "again", "kept", "tie", "at")), strict=True):
                if run is None or conv != run.conv:
                    if run is not None:
                        close(False)
                        open_start = False
                    run = Run(conv)
                elif len(run.rows) >= segment_rows or run.size >= segment_chars:
                    close(True)
                    open_start = True  # what follows of this conversation goes on from here
                    run = Run(conv)
                if run.key is None:
                    run.key = (turn, tie, at)
                if kept:
                    run.add(turn, role, text, again)
                if len(out) >= 1000 or held >= segment_chars:
                    yield flushed()
        if run is not None:
            close(True)
        if out:
            yield flushed()

    arrow = _arrow(schema)
    return ordered.mapInArrow(work, schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split(" ") for x in schema.split(", "))])


def _stream(rows: DataFrame, work, schema: str) -> DataFrame:
    """work(conversation's rows as an iterator of dicts in order) for each conversation; yields dicts."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for b in batches for r in b.to_pylist())
        for _, own in groupby(found, key=lambda r: r["conv_id"]):
            out = []
            for r in work(own):
                out.append(r)
                if len(out) == 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie", "at")
    return ordered.mapInArrow(run, schema)


_CHOICE = f"conv_id long, at long, start long, end long, last boolean, {RESULT}"


def _choose(own: Iterator[dict]) -> Iterator[dict]:
    """The states between which each segment of a conversation is repaired; the last one's row carries the conversation's counts.

    Kept for each segment: four states' predecessors. Costs add up; equal costs are told apart by the order of the audits so far
    (`ranks`), then by the segment's own.
    """
    costs, ranks = [0, None, None, None], [0, 0, 0, 0]
    back: list[tuple[int, list[int]]] = []
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    low = high = None
    turns, tail, conv = 0, "", None
    for r in own:
        conv = r["conv_id"]
        bits = FIELD * r["n_rows"]
        mask = (1 << bits) - 1
        found: list[tuple[int, int, int, int] | None] = [None] * 4
        for a in range(4):
            if costs[a] is None:
                continue
            for b in range(4):
                if (blob := r["weights"][4 * a + b]) is not None:
                    w = int.from_bytes(blob, "big")
                    this = (costs[a] + (w >> bits), ranks[a], w & mask, a)
                    if found[b] is None or this < found[b]:
                        found[b] = this
        order = sorted({x[1:3] for x in found if x is not None})
        costs, ranks = [x and x[0] for x in found], [x and order.index(x[1:3]) or 0 for x in found]
        back.append((r["at"], [-1 if x is None else x[3] for x in found]))
        for n in counts:
            counts[n] += r[n]
        if r["n_rows"]:
            counts["illegal"] += bool(tail) and tail + r["head"] not in PAIRS
            tail = r["tail"] or "?"
        if r["high"] is not None:
            turns += r["turns"] - (high is not None and high == r["low"])
            low, high = r["low"] if low is None else low, r["high"]
    ends = [(costs[q] + cost, ranks[q], field, q) for (q, to), (cost, field, _) in LAST.items() if to in ENDS and costs[q] is not None]
    cost, _, field, state = min(ends)
    path = []
    for _, before in reversed(back):
        path.append((before[state], state))
        state = before[state]
    for k, ((at, _), (start, end)) in enumerate(zip(back, reversed(path), strict=True)):
        last = k == len(back) - 1
        row = {"conv_id": conv, "at": at, "start": start, "end": end, "last": last}
        yield row | counts | {"gaps": 0 if high is None else high - low + 1 - turns, "cost": cost, "audit": letters_of(field, 1)[0]} if last else row


_PIECE = f"conv_id long, turn long, tie string, at long, last boolean, lines string, n_lines long, {RESULT}"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment between its states: its part of the audit and its lines."""
    arrow = _arrow(_PIECE)
    for batch in batches:
        for r in batch.to_pylist():
            kinds = [(k[0], k[1] == "1", k[2] == "1") for k in r["kinds"]]
            weight = least_weights(kinds, r["start"], False)[r["end"]]
            letters = letters_of(weight, len(kinds))
            rows, state = list(zip(r["roles"], r["texts"], strict=True)), r["start"]
            if r["last"]:
                letters.append(r["audit"])
            lines = repaired(rows, letters, state)
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in arrow.names} | {"lines": "\n".join(lines), "n_lines": len(lines), "audit": "".join(letters)}], schema=arrow)


def _join(own: Iterator[dict]) -> Iterator[dict]:
    sha, audit, begun, row = hashlib.sha256(), [], False, {}
    for r in own:
        if r["n_lines"]:
            sha.update(("\n" if begun else "").encode() + r["lines"].encode())
            begun = True
        audit.append(r["audit"])
        row = r
    yield {n: row[n] for n in ("conv_id", *(x.split()[0] for x in RESULT.split(", ")))} | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", kept: Column | None = None, segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows for which `kept` doesn't hold only tell that their conversation exists.
    """
    whole = rows.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.coalesce(kept, F.lit(False)).alias("kept") if kept is not None else F.lit(True).alias("kept"),
    )
    same = F.md5(F.concat_ws("\n", F.coalesce(F.col("conv").cast("string"), F.lit("")), F.hex("role"), "text"))
    marked = whole.withColumn("same", F.when(F.col("kept"), same)).withColumn("at", F.monotonically_increasing_id())
    marked = written(marked.withColumn("tie", F.concat_ws("\n", "role", F.left("text", F.lit(TIE_CHARS)), F.md5("text"))), "turns", codec="zstd")
    firsts = written(marked.filter("kept").groupBy("same").agg(F.min(F.struct("turn", "at")).alias("first"), F.count("*").alias("count")).filter("count > 1"), "firsts")
    n = marked.count()
    met = join_found(marked, firsts.drop("count"), "same", firsts.select("same", "count"), n)
    again = F.coalesce(F.struct("turn", "at") != F.col("first"), F.lit(False))
    dealt = met.withColumn("again", again).drop("same", "first")
    order = [F.asc(c) for c in ("conv", "turn", "tie", "at")]
    ordered = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(_finish(ordered, segment_rows, segment_chars), "repaired", codec="zstd")
    columns = ["conv_id", *(x.split()[0] for x in RESULT.split(", "))]
    parts = found.filter(~F.col("whole")).drop("whole", "gaps", "cost", "audit", "repaired_sha256")
    chosen = _stream(parts.drop("roles", "texts", "kinds"), _choose, _CHOICE)
    pieces = parts.select("conv_id", "turn", "tie", "at", "roles", "texts", "kinds").join(chosen.drop("conv_id"), "at")
    return found.filter("whole").select(columns).unionByName(_stream(pieces.mapInArrow(_repair, _PIECE), _join, f"conv_id long, {RESULT}").select(columns))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The contract's damage by crc32(`conv_id:turn`) % 20, and which rows are kept."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    out = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate"))
    out = out.withColumn("text", F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    out = out.withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("fate") == 3, 1).otherwise(0)))), F.col("fate") != 0


def query(spark, sf_dir: str) -> DataFrame:
    rows, kept = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    return repair(rows, kept=kept)
