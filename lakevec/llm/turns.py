"""Conversation structure repair: a run-length dynamic program over role and fault symbols.

A conversation's rows, in the order of turn, role and text, become symbols: what may be done with a row and at what
cost. The roles that are left must be an optional system turn and then alternating user and assistant turns (or nothing),
which is an automaton of four states. A symbol is a min-plus matrix over these states, insertions before the row
included; equal consecutive symbols are one run, which is passed through by the cached matrices of 2**k such symbols.
From the costs at the borders the choices are unrolled, again by halves of 2**k symbols, each half's choices being cached
by the state before it and the costs after it. Costs are kept relative to their least, so few different ones occur and
nearly all steps are found in the caches, whatever the conversations' lengths.

Equal rows of a turn are one row with a count before anything is shuffled. Repeats of a role and text are found by an
aggregate and a join on digests, texts aren't shuffled for it. A conversation's symbols and its audit, which are the only
things that one task holds whole, are a byte a row, as the audit is one cell of the result. Texts are then streamed in
order next to their audit, through a running hash.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Costs of the edits, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: A row's fault: the first that holds.
NONE, BLANK, DUPLICATE, CUT = range(4)
#: States: nothing yet, after a system, user or assistant turn. Nothing and an assistant turn may be the end.
START, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Where a role leads; what an inserted or changed role is in each state.
_STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLES = ("", "system", "user", "assistant")
_FAR = 1 << 40
_END = (0, _FAR, _FAR, 0)
#: Results that the caches hold at most; when full they are emptied, which costs time only.
CACHED = 1 << 20

# --- the dynamic program


def symbol(initial: str, fault: int) -> str:
    """"-" for rows that must go, the role's initial or "." for others, in upper case or "," for truncated ones."""
    if fault in (BLANK, DUPLICATE):
        return "-"
    role = initial if initial in _INITIALS else "."
    return (role.upper() if role != "." else ",") if fault == CUT else role


def edits(sym: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row, in the order of the edits' letters."""
    out = [("D", DELETE, state)]
    if sym == "-":
        return out
    more, role = (TRUNCATED, sym.lower()) if sym.isupper() or sym == "," else (0, sym)
    if (state, role) in _STEPS:
        out.append(("K", more, _STEPS[state, role]))
    return [*out, ("R", REROLE + more, _NEXT[state])]


def _product(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _insertions() -> tuple:
    """Costs from state to state by any number of insertions."""
    one = tuple(tuple(0 if i == j else INSERT if _NEXT[i] == j else _FAR for j in range(4)) for i in range(4))
    two = _product(one, one)
    return _product(two, two)


_FREE = _insertions()


def _applied(matrix: tuple, after: tuple) -> tuple:
    return tuple(min(matrix[i][j] + after[j] for j in range(4)) for i in range(4))


class Repairer:
    """Costs and audits of symbol sequences."""

    def __init__(self):
        self.powers: dict[tuple[str, int], tuple] = {}
        self.costs: dict[tuple, tuple] = {}
        self.paths: dict[tuple, tuple[str, int]] = {}
        self.whole: dict[bytes, tuple[int, str]] = {}

    def power(self, sym: str, k: int) -> tuple:
        """The min-plus matrix of 2**k rows ``sym``."""
        if (sym, k) not in self.powers:
            if k:
                half = self.power(sym, k - 1)
                m = _product(half, half)
            else:
                rows = [[_FAR] * 4 for _ in range(4)]
                for i in range(4):
                    for _, cost, to in edits(sym, i):
                        rows[i][to] = min(rows[i][to], cost)
                m = _product(_FREE, tuple(map(tuple, rows)))
            self.powers[sym, k] = tuple(tuple(min(x, _FAR) for x in row) for row in m)
        return self.powers[sym, k]

    def _before(self, sym: str, k: int, after: tuple) -> tuple[tuple, int]:
        """Costs to go before 2**k rows ``sym``, relative to the least of them, and that least."""
        key = (sym, k, after)
        if key not in self.costs:
            if len(self.costs) > CACHED:
                self.costs.clear()
            out = _applied(self.power(sym, k), after)
            least = min(out)
            self.costs[key] = tuple(min(x - least, _FAR) for x in out), least
        return self.costs[key]

    def _path(self, sym: str, k: int, state: int, after: tuple) -> tuple[str, int]:
        """The edits of 2**k rows ``sym`` from ``state`` on, cheapest and of these ASCII-least, and the state behind."""
        key = (sym, k, state, after)
        if key not in self.paths:
            if len(self.paths) > CACHED or k > 16:
                self.paths.clear()
            if k:
                first, at = self._path(sym, k - 1, state, self._before(sym, k - 1, after)[0])
                second, at = self._path(sym, k - 1, at, after)
                self.paths[key] = first + second, at
            else:
                text, at, go = "", state, _applied(self.power(sym, 0), after)
                while True:
                    for edit, cost, to in sorted([*edits(sym, at), ("I", INSERT, _NEXT[at])]):
                        if cost + (go if edit == "I" else after)[to] == go[at]:
                            break
                    text, at = text + edit, to
                    if edit != "I":
                        break
                self.paths[key] = text, at
        return self.paths[key]

    @staticmethod
    def _blocks(n: int) -> list[int]:
        return [k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]

    def repair(self, runs: list[tuple[str, int]]) -> tuple[int, str]:
        """(cost, audit) of runs (symbol, length)."""
        blocks = [(sym, k) for sym, n in runs for k in self._blocks(n)]
        after, least = _applied(_FREE, _END), 0
        afters = []
        for sym, k in reversed(blocks):
            afters.append(after)
            after, more = self._before(sym, k, after)
            least += more
        audit, state, cost = [], START, least + after[START]
        for (sym, k), after in zip(blocks, reversed(afters), strict=True):
            text, state = self._path(sym, k, state, after)
            audit.append(text)
        while _END[state]:
            audit.append("I")
            state = _NEXT[state]
        return cost, "".join(audit)

    def of_symbols(self, symbols: bytes) -> tuple[int, str]:
        """The same for one character a row; short conversations are often alike and found as a whole."""
        if symbols in self.whole:
            return self.whole[symbols]
        found = self.repair([(s, len(list(g))) for s, g in itertools.groupby(symbols.decode("latin-1"))])
        if len(symbols) <= 32:
            if len(self.whole) > CACHED:
                self.whole.clear()
            self.whole[symbols] = found
        return found


class Replay:
    """The turns that are left when an audit is followed; rows are given one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, _NEXT[self.state]
            yield _ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = _STEPS[self.state, role[:1]] if edit == "K" else _NEXT[self.state]
        yield (role if edit == "K" else _ROLES[self.state]), text


# --- rows


def damaged(table: DataFrame, rate: int = 20) -> DataFrame:
    """conv_id, turn, role, text and copies of every row after the stated damage: 0 copies of those that it drops."""
    rows = table.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(rate))
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _order() -> tuple[Column, ...]:
    return F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")


def symbols_of(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n and fault, later of every distinct row; ``fault`` is that of its first copy, all
    later copies are duplicates. Rows that the damage dropped have n 0."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    own = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(NONE).cast("int")
    narrow = rows.select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), own.alias("own"), "copies")
    # equal rows are one before the shuffle
    merged = narrow.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("n"), F.first("own").alias("own"))
    present = merged.where("n > 0")
    # role and text seen in several turns: the first of them; nearly all occur in one and aren't in this table
    seen = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = present.groupBy("conv_id", "role", "digest").agg(F.min(seen).alias("first"), F.count("*").alias("turns")).where("turns > 1").select("conv_id", "role", "digest", "first")
    same = (F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    both = merged.alias("a").join(repeated.alias("b"), same, "left")
    late = F.col("b.first").isNotNull() & (F.struct(F.col("a.turn").isNotNull().alias("known"), F.col("a.turn").alias("turn")) > F.col("b.first"))
    fault = F.when(F.col("own") == BLANK, BLANK).when(late, DUPLICATE).otherwise(F.col("own")).cast("int")
    return both.select("a.conv_id", "a.turn", "a.role", "a.digest", "n", fault.alias("fault"))


AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_ILLEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Conversation:
    """What is known of a conversation after some of its rows."""

    def __init__(self, conv_id):
        self.id, self.counts, self.illegal, self.last, self.symbols = conv_id, [0, 0, 0, 0], 0, None, bytearray()
        self.least = self.most = self.turn = None
        self.turns = 0

    def add(self, turn, role: str, n: int, fault: int) -> None:
        if not n:
            return
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        self.illegal += (self.last is not None and (self.last, initial) not in _ILLEGAL) + (n - 1)  # a role never follows itself
        self.last = initial
        self.counts[fault] += 1
        self.symbols += symbol(initial, fault).encode()
        if n > 1:
            again = BLANK if fault == BLANK else DUPLICATE
            self.counts[again] += n - 1
            self.symbols += b"-" * (n - 1)

    def row(self, repairer: Repairer) -> tuple:
        cost, audit = repairer.of_symbols(bytes(self.symbols))
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (self.id, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, cost, audit)


#: Conversations, and bytes of audits, that a task gives out at once.
_GIVEN, _GIVEN_BYTES = 4096, 16 << 20


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])
    repairer, now, out, size = Repairer(), None, [], 0
    give = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
    for batch in batches:
        for conv, turn, role, n, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "n", "fault")), strict=True):
            if now is None or conv != now.id:
                if now:
                    out.append(now.row(repairer))
                    size += len(out[-1][-1])
                    if len(out) >= _GIVEN or size > _GIVEN_BYTES:
                        yield give(out)
                        out, size = [], 0
                now = _Conversation(conv)
            now.add(turn, role, n, fault)
    if now:
        yield give([*out, now.row(repairer)])


def audit(rows: DataFrame) -> DataFrame:
    """AUDITS: faults, cost and edits of every conversation of ``damaged`` rows."""
    dealt = symbols_of(rows).repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return dealt.select("conv_id", "turn", "role", "n", "fault").mapInArrow(_audited, AUDITS)


_REPAIRED = "conv_id long, turn long, role string, text string"


def _streamed(begin, step, end, schema: pa.Schema):
    """A function over rows in order, each conversation's audit first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []
        for batch in batches:
            for conv, audit_, turn, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "turn", "role", "text", "copies")), strict=True):
                if audit_ is not None:
                    if state:
                        out += end(state)
                    state = begin(conv, audit_)
                else:
                    for _ in range(copies):
                        out += step(state, turn, role, text)
            if len(out) >= _GIVEN:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out = []
        out += end(state) if state else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of each conversation in order, behind a row with its audit, in one task's stream; texts come once."""
    heads = audits.select("conv_id", "audit", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies"))
    lines = rows.where("copies > 0").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies")
    both = heads.unionByName(lines).withColumn("digest", F.when(F.col("audit").isNull(), _digest(F.col("text"))))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_order())


def repair(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn, role, text; ``turn`` counts from 0. Rows are those of ``damaged``."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def begin(conv, audit_):
        return {"conv": conv, "replay": Replay(audit_), "n": 0}

    def give(s, turns):
        for role, text in turns:
            yield s["conv"], s["n"], role, text
            s["n"] += 1

    run = _streamed(begin, lambda s, turn, role, text: give(s, s["replay"].row(role, text)), lambda s: give(s, s["replay"].inserted()), schema)
    return _with_audits(rows, audits).mapInArrow(run, _REPAIRED)


def _hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the hash of the repaired ``role:text``, joined by newlines, kept up while rows pass."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def begin(conv, audit_):
        return {"conv": conv, "replay": Replay(audit_), "hash": hashlib.sha256(), "between": b""}

    def take(s, turns):
        for role, text in turns:
            s["hash"].update(s["between"] + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            s["between"] = b"\n"
        return ()

    def end(s):
        take(s, s["replay"].inserted())
        return [(s["conv"], s["hash"].hexdigest())]

    run = _streamed(begin, lambda s, turn, role, text: take(s, s["replay"].row(role, text)), end, schema)
    return _with_audits(rows, audits).mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_table(table: DataFrame) -> DataFrame:
    """A row for each conv_id of (conv_id, turn, role, text), after the stated damage: gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256.

    A null conv_id or turn is one space in the key that decides the damage, a null role or text is one space; rows without
    a conv_id are a conversation of their own. Rows come by turn, nulls first, then by role and the digest of the text, so
    that repeated rows are neighbours; a fault is the first that holds of blank, duplicate and truncated. Roles other than
    system, user and assistant count by their first character; an empty role has none and is never kept. Texts may have any
    length. Conversations that lose all rows have zeros, an empty audit and the hash of nothing; an empty table gives an
    empty result. Other columns are left out, whatever their names.
    """
    rows = damaged(table)
    audits = common.materialise(audit(rows), "audits")
    hashes = _hashes(rows, audits)
    return audits.join(hashes, audits.conv_id.eqNullSafe(hashes.conv_id)).select(*[audits[c] for c in audits.columns], "repaired_sha256")


def _more(cell: str, cost: int, edit: str) -> str:
    """SQL: a cell (cost in 8 digits, audit; "~" for none) after a further edit."""
    return f"CASE WHEN {cell} = '~' THEN '~' ELSE lpad(CAST(CAST({cell}[1:8] AS INTEGER) + {cost} AS VARCHAR), 8, '0') || {cell}[9:] || '{edit}' END"


def _closed(a: str) -> str:
    """SQL: the four cells with what insertions make of them."""
    user = f"least({a}[3], {_more(f'{a}[1]', INSERT, 'I')}, {_more(f'{a}[2]', INSERT, 'I')}, {_more(f'{a}[4]', INSERT, 'I')})"
    return f"list_transform([{user}], lambda u: [{a}[1], {a}[2], u, least({a}[4], {_more('u', INSERT, 'I')})])[1]"


def _stepped(b: str, x: str) -> str:
    """SQL: the four cells after a row x = [initial, fault, ...]."""
    stays, cut = f"{x}[2] NOT IN ('b', 'd')", f"CASE WHEN {x}[2] = 't' THEN {TRUNCATED} ELSE 0 END"
    kept = lambda at, role: f"CASE WHEN {stays} AND {x}[1] = '{role}' THEN {_more(f'{b}[{at}]', cut, 'K')} ELSE '~' END"
    turned = lambda at: f"CASE WHEN {stays} THEN {_more(f'{b}[{at}]', f'{REROLE} + {cut}', 'R')} ELSE '~' END"
    gone = lambda at: _more(f"{b}[{at}]", DELETE, "D")
    return f"[{gone(1)}, least({gone(2)}, {kept(1, 's')}), least({gone(3)}, {', '.join(kept(i, 'u') + ', ' + turned(i) for i in (1, 2, 4))}), least({gone(4)}, {kept(3, 'a')}, {turned(3)})]"


ORACLE_SQL = f"""WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS tab),
  c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
  k AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM c, t),
  d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
  r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM d),
  f AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM r),
  g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated,
    count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, list([left(role, 1), fault, role, text] ORDER BY pos) AS rows FROM f GROUP BY conv_id),
  p AS (SELECT *, list_transform([list_reduce(list_prepend(['00000000', '~', '~', '~'], rows), lambda a, x: list_transform([{_closed('a')}], lambda b: {_stepped('b', 'x')})[1])], lambda a: {_closed('a')})[1] AS cells FROM g),
  q AS (SELECT *, CAST(least(cells[1], cells[4])[1:8] AS BIGINT) AS cost, least(cells[1], cells[4])[9:] AS audit FROM p),
  s AS (SELECT *, list_reduce(list_prepend(['1', '', ''], list_transform(string_split(audit, ''), lambda x: [x, '', ''])), lambda a, x: list_transform([CASE WHEN a[2] = 'u' THEN 'assistant' ELSE 'user' END], lambda n:
      [CASE WHEN x[1] IN ('I', '') THEN a[1] ELSE CAST(CAST(a[1] AS INTEGER) + 1 AS VARCHAR) END,
       CASE x[1] WHEN 'K' THEN rows[CAST(a[1] AS INTEGER)][1] WHEN 'I' THEN left(n, 1) WHEN 'R' THEN left(n, 1) ELSE a[2] END,
       a[3] || CASE x[1] WHEN 'K' THEN chr(10) || rows[CAST(a[1] AS INTEGER)][3] || ':' || rows[CAST(a[1] AS INTEGER)][4] WHEN 'R' THEN chr(10) || n || ':' || rows[CAST(a[1] AS INTEGER)][4] WHEN 'I' THEN chr(10) || n || ':' ELSE '' END])[1]) AS o FROM q)
  SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(o[3][2:], '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN s ON i.conv_id IS NOT DISTINCT FROM s.conv_id"""
