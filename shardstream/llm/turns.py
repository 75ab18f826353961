"""Repair of conversation structure: the cheapest edits that make the roles alternate, by dynamic programming over runs of equal rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialize, small_result

# Costs of the edits; a truncated row that is not deleted costs CUT more.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
# States: nothing yet, after a system row, after a user row, after an assistant row. Ends in START or ASSISTANT.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ACCEPTED = 4, (START, ASSISTANT)
NEVER = 1 << 60
# The only role that may be made up in each state leads to this state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"

# Symbols of rows: role (system, user, assistant, another) + 4 if truncated; one for rows that have to go.
OTHER, TRUNCATED, GONE = 3, 4, 8

# Rows of a conversation that a task holds at once, in bytes of their texts; a longer one is handled in pieces of about this size.
PIECE_BYTES = 8 << 20


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The min-plus product of two transitions, or of a transition and a vector."""
    if b.ndim == 1:
        return np.minimum((a + b[None, :]).min(axis=1), NEVER)
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def _kept(symbol: int, state: int) -> int | None:
    """The state after keeping a row as it is, if that can be."""
    role = symbol % TRUNCATED
    if symbol == GONE or role == OTHER:
        return None
    if role == 0:
        return SYSTEM if state == START else None
    to = (USER, ASSISTANT)[role - 1]
    return to if NEXT[state] == to else None


@lru_cache(maxsize=None)
def inserted() -> np.ndarray:
    """Transition of any number of insertions."""
    once = np.full((STATES, STATES), NEVER, np.int64)
    np.fill_diagonal(once, 0)
    for state in range(STATES):
        once[state, NEXT[state]] = INSERT
    return product(product(once, once), product(once, once))


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> np.ndarray:
    """Transition of 2 ** exponent rows of a symbol, insertions before each row included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    row = np.full((STATES, STATES), NEVER, np.int64)
    for state in range(STATES):
        row[state, state] = DELETE
        if symbol != GONE:
            cut = CUT if symbol >= TRUNCATED else 0
            row[state, NEXT[state]] = min(row[state, NEXT[state]], REROLE + cut)
            to = _kept(symbol, state)
            if to is not None:
                row[state, to] = min(row[state, to], KEEP + cut)
    return product(inserted(), row)


def run_transition(symbol: int, count: int) -> np.ndarray:
    """Transition of a run of rows, by its binary powers."""
    whole, exponent = None, 0
    while count:
        if count & 1:
            part = power(symbol, exponent)
            whole = part if whole is None else product(part, whole)
        count, exponent = count >> 1, exponent + 1
    return whole


def run_costs(symbol: int, count: int, after: np.ndarray) -> np.ndarray:
    """Cheapest costs to the end from each state before a run, from those after it."""
    exponent = 0
    while count:
        if count & 1:
            after = product(power(symbol, exponent), after)
        count, exponent = count >> 1, exponent + 1
    return after


@lru_cache(maxsize=None)
def end_costs() -> np.ndarray:
    """Cheapest costs from each state when no row is left."""
    accepted = np.array([0 if s in ACCEPTED else NEVER for s in range(STATES)], np.int64)
    return product(inserted(), accepted)


def unroll(runs: Iterable[tuple[int, int]], after: np.ndarray, state: int, last: bool) -> tuple[str, list[int], int, int]:
    """The ASCII-least audit of the cheapest edits of ``runs``, the states it goes through (-1 at deletions), their cost, and the last state.

    ``after`` are the costs behind the runs. Insertions behind the last row are made here if it is the ``last`` of its
    conversation, and by the following rows otherwise. In each state an edit leads to one state only, so the least initial
    that stays on a cheapest way decides.
    """
    runs = list(runs)
    behind = [after]
    for symbol, count in reversed(runs):
        behind.append(run_costs(symbol, count, behind[-1]))
    behind.reverse()
    audit, path, cost = [], [], 0
    for at, (symbol, count) in enumerate(runs):
        if symbol == GONE:  # D is the least initial, and an insertion before it can as well be made behind it
            audit.append("D" * count)
            path += [-1] * count
            cost += DELETE * count
            continue
        costs, cut = behind[at], CUT if symbol >= TRUNCATED else 0
        for following in _row_costs(symbol, count, behind[at + 1]):
            while DELETE + following[state] != costs[state] and INSERT + costs[NEXT[state]] == costs[state]:
                state = NEXT[state]
                audit.append("I")
                path.append(state)
                cost += INSERT
            to = _kept(symbol, state)
            if DELETE + following[state] == costs[state]:
                edit, step = "D", DELETE
            elif to is not None and KEEP + cut + following[to] == costs[state]:
                edit, step, state = "K", KEEP + cut, to
            else:
                edit, step, state = "R", REROLE + cut, NEXT[state]
            audit.append(edit)
            path.append(-1 if edit == "D" else state)
            cost += step
            costs = following
    while last and state not in ACCEPTED:
        state = NEXT[state]
        audit.append("I")
        path.append(state)
        cost += INSERT
    return "".join(audit), path, cost, state


@lru_cache(maxsize=1 << 15)
def _unroll_short(runs: tuple[tuple[int, int], ...]) -> tuple[str, list[int], int, int]:
    return unroll(runs, end_costs(), START, True)


def _row_costs(symbol: int, count: int, after: np.ndarray) -> Iterator[np.ndarray]:
    """Costs behind each row of a run, in order. A long run is stepped through in stretches, so that few vectors are held."""
    stretch = 1024
    while count:
        size = min(stretch, count)
        vectors = [run_costs(symbol, count - size, after)]
        for _ in range(size - 1):
            vectors.append(product(power(symbol, 0), vectors[-1]))
        yield from reversed(vectors)
        count -= size


class Piece:
    """Rows of one conversation in their order, as far as a task has them: what is needed to repair them and to join pieces."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.roles, self.texts, self.symbols, self.gone, self.held = [], [], [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.first = self.latest = None

    def add(self, turn, role: str, text: str, copies: int, fresh: bool) -> None:
        """Equal rows of one turn; the first of them is ``fresh`` if its role and text were not seen in an earlier turn."""
        if not copies:
            return
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        initial, words = role[:1], text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        self.illegal += copies - 1 + (self.latest is not None and self.latest + initial not in ("su", "ua", "au"))
        self.first, self.latest = initial if self.first is None else self.first, initial
        symbol = None
        if not words:
            self.blank += copies
        elif fresh:
            cut = words[-1] not in ".!?"
            self.truncated += cut
            self.duplicate += copies - 1
            place = INITIALS.find(initial) if initial else -1
            symbol = (OTHER if place < 0 else place) + cut * TRUNCATED
        else:
            self.duplicate += copies
        self.roles.append(role if symbol is not None else "")
        self.texts.append(text if symbol is not None else "")
        self.symbols.append(GONE if symbol is None else symbol)
        self.gone.append(copies - (symbol is not None))
        self.held += 64 + len(role) + len(self.texts[-1])

    def counts(self) -> dict:
        return {name: getattr(self, name) for name in COUNTS}


def runs_of(symbols: list[int], gone: list[int]) -> tuple[tuple[int, int], ...]:
    """Runs of equal consecutive symbols of rows, each followed by its copies that have to go."""
    runs: list[tuple[int, int]] = []
    for symbol, copies in zip(symbols, gone):
        for kind, count in ((symbol, int(symbol != GONE)), (GONE, copies)):
            if count and runs and runs[-1][0] == kind:
                runs[-1] = (kind, runs[-1][1] + count)
            elif count:
                runs.append((kind, count))
    return tuple(runs)


def rebuild(roles: list[str], texts: list[str], symbols: list[int], gone: list[int], audit: str, path: list[int]) -> Iterator[tuple[str, str, str]]:
    """The repaired rows that an audit leaves: edit, role, text."""
    rows = ((r, t) if i == 0 and s != GONE else None for r, t, s, g in zip(roles, texts, symbols, gone) for i in range(g + (s != GONE)))
    for edit, state in zip(audit, path):
        if edit == "I":
            yield edit, ROLE_OF[state], ""
            continue
        row = next(rows)
        if edit != "D":
            yield edit, row[0] if edit == "K" else ROLE_OF[state], row[1]


def _joined(rows: Iterable[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text in rows).encode()


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "first", "latest")
_COUNTED = "blank long, duplicate long, truncated long, illegal long, turns long, least long, most long, first string, latest string"
_ROWS = "array<struct<edit:string,role:string,text:string>>"
_PIECE = (
    f"conv_id void, part int, piece int, closed boolean, {_COUNTED}, cost long, audit string, repaired_sha256 string, repaired {_ROWS}, "
    "roles array<string>, texts array<string>, symbols array<int>, gone array<long>, transition array<long>"
)


def _schema(conv_id: T.DataType, text: str) -> T.StructType:
    made = T.StructType.fromDDL(text)
    return T.StructType([T.StructField(f.name, conv_id if f.dataType == T.NullType() else f.dataType) for f in made.fields])


def _mapped(df: DataFrame, schema: T.StructType, fn) -> DataFrame:
    """Run ``fn`` over the rows of Arrow batches as dicts; what it yields are rows, sent on in small batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in fn(row for b in batches for at in range(0, b.num_rows, 256) for row in b.slice(at, 256).to_pylist()):
            held.append(row)
            size += 200 + sum(len(v) for v in row.values() if isinstance(v, (str, bytes))) + sum(map(len, row.get("texts") or ()))
            size += sum(100 + len(r["text"]) for r in row.get("repaired") or ())
            if size > PIECE_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return df.mapInArrow(run, schema)


def _repaired(rows: Iterable[tuple[str, str, str]]) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in rows]


def _in_pieces(rows: Iterable[dict], piece_bytes: int, keep_rows: bool) -> Iterator[dict]:
    """Repair the conversations that lie wholly in this partition; give the others, and long ones, as pieces."""
    part = TaskContext.get().partitionId()

    def closed(p: Piece) -> dict:
        runs = runs_of(p.symbols, p.gone)
        audit, path, cost, _ = _unroll_short(runs) if len(runs) <= 64 else unroll(runs, end_costs(), START, True)
        kept = list(rebuild(p.roles, p.texts, p.symbols, p.gone, audit, path))
        said = hashlib.sha256(_joined(kept)).hexdigest()
        out = {"conv_id": p.conv_id, "part": part, "piece": 0, "closed": True, **p.counts(), "cost": cost, "audit": audit, "repaired_sha256": said}
        return {**out, "repaired": _repaired(kept) if keep_rows else None}

    def opened(p: Piece, number: int) -> dict:
        whole = inserted()
        for symbol, count in runs_of(p.symbols, p.gone):
            whole = product(whole, run_transition(symbol, count))
        out = {"conv_id": p.conv_id, "part": part, "piece": number, "closed": False, **p.counts(), "transition": whole.ravel().tolist()}
        return {**out, "roles": p.roles, "texts": p.texts, "symbols": p.symbols, "gone": p.gone}

    now, in_part, number = None, True, 0  # the first and the last conversation may go on in other partitions
    for row in rows:
        if now is None:
            now = Piece(row["conv_id"])
        elif now.conv_id != row["conv_id"]:
            yield opened(now, number) if in_part else closed(now)
            now, in_part, number = Piece(row["conv_id"]), False, number + in_part
        elif now.held > piece_bytes:
            yield opened(now, number)
            now, in_part, number = Piece(row["conv_id"]), True, number + 1
        now.add(row["turn"], row["role"], row["text"], row["copies"], row["fresh"])
    if now is not None:
        yield opened(now, number)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Equal rows of a turn as one row with their number and whether they are the first to say this, in the order of the conversations.

    Conversations are ranges of a sort, so a long one lies in many partitions.
    """
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), texts["role"].alias("role"), texts["text"].alias("text"), copies.cast("long").alias("copies"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("said", F.when(F.col("copies") > 0, said))
    again = rows.filter("said IS NOT NULL").groupBy("conv_id", "said").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("earliest")).filter("n > 1")
    again = small_result(again.select(F.col("conv_id").alias("__conv"), F.col("said").alias("__said"), "earliest"))
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("said") == F.col("__said")), "left")
    fresh = F.col("earliest").isNull() | F.col("turn").eqNullSafe(F.col("earliest.turn"))
    rows = rows.select("conv_id", "turn", "role", "text", "copies", fresh.alias("fresh"))
    short = F.length("role") <= 32
    # beginnings in the order of the whole, so that no long text becomes a bound of a range
    keys = [F.col("conv_id"), F.col("turn"), F.left("role", F.lit(32)), ~short, F.when(short, F.left("text", F.lit(32))).otherwise("")]
    return rows.repartitionByRange(*keys).sortWithinPartitions("conv_id", "turn", "role", "text")


def _pieces(conversations: DataFrame, piece_bytes: int, keep_rows: bool) -> DataFrame:
    schema = _schema(conversations.schema["conv_id"].dataType, _PIECE)
    return materialize(_mapped(_ordered(conversations), schema, lambda rows: _in_pieces(rows, piece_bytes, keep_rows)))


def _costs_behind(pieces: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each piece of one conversation, and what is counted where pieces meet."""
    pieces = pieces.sort_values(["part", "piece"])
    after, behind, met = end_costs(), [], []
    for moves in reversed(pieces["transition"].tolist()):
        behind.append(after.tolist())
        after = product(np.asarray(moves, np.int64).reshape(STATES, STATES), after)
    latest = most = None
    for row in pieces[["first", "latest", "least", "most"]].astype(object).itertuples(index=False, name=None):
        first, last, least, greatest = (None if pd.isna(v) else v for v in row)
        met.append((int(latest is not None and first is not None and latest + first not in ("su", "ua", "au")), int(most is not None and most == least)))
        latest, most = latest if last is None else last, most if greatest is None else greatest
    out = pieces[["part", "piece"]].copy()
    out["after"], out["final"] = behind[::-1], [False] * (len(out) - 1) + [True]
    out["met_illegal"], out["met_turns"] = [m[0] for m in met], [m[1] for m in met]
    return out


def _first_states(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of one conversation begins."""
    pieces, state, begins = pieces.sort_values(["part", "piece"]), START, []
    for ends in pieces["ends"]:
        begins.append(state)
        state = int(ends[state])
    out = pieces[["part", "piece"]].copy()
    out["begins"] = begins
    return out


def _last_states(rows: Iterable[dict]) -> Iterator[dict]:
    """For each piece the states in which it ends, by the state in which it begins."""
    for row in rows:
        runs, after = runs_of(row["symbols"], row["gone"]), np.asarray(row["after"], np.int64)
        ends = [unroll(runs, after, state, False)[3] for state in range(STATES)]
        yield {"conv_id": row["conv_id"], "part": row["part"], "piece": row["piece"], "ends": ends}


def _unrolled(rows: Iterable[dict], keep_rows: bool) -> Iterator[dict]:
    for row in rows:
        parts = row["roles"], row["texts"], row["symbols"], row["gone"]
        audit, path, cost, _ = unroll(runs_of(*parts[2:]), np.asarray(row["after"], np.int64), row["begins"], row["final"])
        kept = list(rebuild(*parts, audit, path))
        out = {"conv_id": row["conv_id"], "part": row["part"], "piece": row["piece"], "audit": audit, "cost": cost}
        yield {**out, "data": _joined(kept) if kept else None, "repaired": _repaired(kept) if keep_rows else None}


def _hashed(rows: Iterable[dict]) -> Iterator[dict]:
    """The digest of each conversation's repaired rows, which stream by piece after piece."""
    now = said = None
    for row in rows:
        if now is None or now["conv_id"] != row["conv_id"]:
            if now is not None:
                yield {"conv_id": now["conv_id"], "repaired_sha256": (said or hashlib.sha256()).hexdigest()}
            now, said = row, None
        if row["data"] is not None:
            if said is None:
                said = hashlib.sha256()
            else:
                said.update(b"\n")
            said.update(row["data"])
    if now is not None:
        yield {"conv_id": now["conv_id"], "repaired_sha256": (said or hashlib.sha256()).hexdigest()}


def _open_pieces(pieces: DataFrame, keep_rows: bool) -> DataFrame:
    """Pieces of conversations that lie in several, with their part of the audit: costs go backwards over the pieces, states forwards."""
    conv_id = pieces.schema["conv_id"].dataType
    held = pieces.filter("NOT closed")
    turns = [F.col(c).cast("string").alias(c) for c in ("least", "most")]  # pandas would turn numbers with nulls into floats
    slim = held.select("conv_id", "part", "piece", "transition", "first", "latest", *turns)
    behind = "part int, piece int, after array<long>, final boolean, met_illegal long, met_turns long"
    behind = materialize(slim.groupBy("conv_id").applyInPandas(_costs_behind, behind))
    place = ["part", "piece"]
    symbols = held.select("conv_id", *place, "symbols", "gone").join(behind.select(*place, "after"), place)
    ends = _mapped(symbols, _schema(conv_id, "conv_id void, part int, piece int, ends array<int>"), _last_states)
    begins = materialize(ends.groupBy("conv_id").applyInPandas(_first_states, "part int, piece int, begins int"))
    known = held.select("conv_id", *place, "roles", "texts", "symbols", "gone").join(behind.select(*place, "after", "final"), place).join(begins, place)
    schema = _schema(conv_id, f"conv_id void, part int, piece int, audit string, cost long, data binary, repaired {_ROWS}")
    unrolled = materialize(_mapped(known, schema, lambda rows: _unrolled(rows, keep_rows)))
    counted = held.select(*place, *COUNTS).join(behind.drop("after", "final"), place)
    return unrolled.join(counted, place)


def repair(conversations: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The cheapest repair of each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role, text, and may have ``copies``, how often a row occurs (0: only its
    conversation does). Rows go by turn, nulls first, rows of one turn by role and text. A null role or text is one space; rows
    without conv_id are one conversation; a row whose role begins with none of s, u and a, or is empty, can't be kept as it
    is. An empty table gives no rows. Other columns are not looked at.

    A row is blank if its text is white space, else a duplicate if its role and text were there before, else truncated
    if its text ends in none of ``.!?``. Edits: keep (0), give it the role user or assistant (1), delete (2; a must for blank
    rows and duplicates), insert an empty user or assistant row (5); a truncated row that stays costs 5 more. The roles that are
    left have to be nothing, or user and assistant in turns, after a system row at most. Of the cheapest edits the
    ASCII-least string of initials counts.

    Equal rows of a turn are counted before anything is sorted. Rows are then sorted by range, and a task holds at most ``piece_bytes`` of a
    conversation: the pieces of a longer one are transitions of a few numbers, which are composed backwards and forwards, before each
    piece is unrolled by itself. Only its digest needs one task, through which the repaired rows stream.
    """
    pieces = _pieces(conversations, piece_bytes, False)
    opened = _open_pieces(pieces, False)
    conv_id = pieces.schema["conv_id"].dataType
    streams = opened.select("conv_id", "part", "piece", "data").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    digests = _mapped(streams, _schema(conv_id, "conv_id void, repaired_sha256 string"), _hashed).withColumnRenamed("conv_id", "__conv")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece", "audit"))), lambda p: p["audit"]), "")
    whole = opened.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")], F.sum(F.col("illegal") + F.col("met_illegal")).alias("illegal"),
        F.sum(F.col("turns") - F.col("met_turns")).alias("turns"), F.min("least").alias("least"), F.max("most").alias("most"), audit.alias("audit"),
    )
    whole = whole.join(digests, F.col("conv_id").eqNullSafe(F.col("__conv")))
    columns = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "turns", "least", "most"]
    everything = pieces.filter("closed").select(*columns).unionByName(whole.select(*columns))
    span = (F.col("most").cast("decimal(20,0)") - F.col("least").cast("decimal(20,0)") + 1 - F.col("turns")).try_cast("long")
    gaps = F.when(F.col("most").isNull(), F.lit(0).cast("long")).otherwise(span)
    return everything.select("conv_id", gaps.alias("gaps"), *columns[1:8])


def repaired_rows(conversations: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The rows that :func:`repair` leaves: conv_id, part, piece, place (their order within the conversation), edit (K, R or I), role, text."""
    pieces = _pieces(conversations, piece_bytes, True)
    columns = ["conv_id", "part", "piece", "repaired"]
    both = pieces.filter("closed").select(*columns).unionByName(_open_pieces(pieces, True).select(*columns))
    rows = both.select("conv_id", "part", "piece", F.posexplode("repaired").alias("place", "row"))
    return rows.select("conv_id", "part", "piece", "place", "row.edit", "row.role", "row.text")


def damaged(conversations: DataFrame, folds: int = 20) -> DataFrame:
    """Conversations as a test of the repair wants them: by the crc32 of ``conv_id:turn`` rows are lost, emptied, left without sentence ends, doubled or given to the user.

    Nulls are one space. A lost row stays with ``copies`` 0 and nothing else but its conversation.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % folds
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), text.alias("text"), kind.alias("kind"))
    lost = F.col("kind") == 0
    return rows.select(
        "conv_id", F.when(~lost, F.col("turn")).alias("turn"), F.when(lost, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(lost, "").otherwise(F.col("text")).alias("text"), F.when(lost, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )
