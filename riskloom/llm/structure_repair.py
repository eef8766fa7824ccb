"""Conversation structure repair by scalar big-integer weights.

A conversation is well formed if the initials of its roles read (s?(ua)+)?.
Its cheapest repair is a path through an acyclic graph: a node is the number
of rows passed and what was emitted last (nothing, s, u or a); its edges are

    Keep    the row as it is                        0, and 1 if it is truncated
    Rerole  the row to user or assistant            2, and 1 if it is truncated
    Delete  the row                                 3; the only way for a blank or a duplicate
    Insert  an empty text of user or assistant      2

What remains of a path from a node is one integer: its high digits are the
cost, below them are WIDTH digits of the edges' letters in turn, from the left, with
zeros behind the last.  D, I, K, R are 1 to 4, so integers compare like costs
and, where these agree, like the letters in ASCII order, a beginning before
what goes on.  An edge before a path moves the letters right by a digit (which
drops a zero), puts its own in front and adds its cost.  The least integer of
the first node decides all: its digits are the audit.  One insertion between two rows
is enough, as two could be left out at less cost; so WIDTH is 2 * rows + 1.
What the letters emit gives the roles: of an odd number the first is a
system's, the others take turns.

Rows with a fault: blank (no character but white space), else duplicate (role
and text seen before in the conversation), else truncated (its last such
character ends no sentence).

``structure`` needs a few bits of each row: those of a conversation are held
together, the texts aren't.  ``repair`` streams the rows by their conversation's
audit into the repaired turns; digests are taken turn by turn.

Cases: a null is one space, in the key of the damage as in role and text (so a
null text is blank, a null role ill-formed); null turns come first, turns of one
number are ordered by role, then by the text's hash; a null conv_id is a conversation of
its own; a role without a character has no initial; repeated rows are duplicates;
a conversation without rows has no faults and nothing to repair; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import on_workers, shuffle_partitions, table
from riskloom.llm.merkle import crc32_sql

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Letters by their digit.
LETTERS = "\0DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
_BITS = 3
#: Faults.
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Adjacent initials that are well formed.
LEGAL = frozenset({"su", "ua", "au"})
#: Role emitted by user and assistant turns that are inserted or take a new role.
NAMES = {"u": "user", "a": "assistant"}
NULL = " "
_SPACE = r"\x20\x09-\x0D"


# --- the least integer -----------------------------------------------------------------------------------------------

def cheapest(rows: Sequence[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows (initial, fault)."""
    width = _BITS * (2 * len(rows) + 1)
    low = (1 << width) - 1

    def edge(cost: int, letter: int, rest: int) -> int:
        return (((rest >> width) + cost) << width) | letter << (width - _BITS) | (rest & low) >> _BITS

    # the best from each node on, after the last row: what was emitted is whole, or lacks the assistant
    never = 1 << (width + 64)
    nothing, system, user, assistant = 0, never, edge(INSERT, _I, 0), 0
    for initial, fault in reversed(rows):
        cut = TRUNCATED if fault == CUT else 0
        take = fault in (FINE, CUT)
        at = []
        for best in (nothing, system, user, assistant):
            at.append(edge(DELETE, _D, best))
        to_user, to_assistant = never, never             # by keeping the row, or giving it the role
        if take:
            to_user = min(edge(REROLE + cut, _R, user), edge(KEEP + cut, _K, user) if initial == "u" else never)
            to_assistant = min(edge(REROLE + cut, _R, assistant), edge(KEEP + cut, _K, assistant) if initial == "a" else never)
            if initial == "s":
                at[0] = min(at[0], edge(KEEP + cut, _K, system))
        for k, step in enumerate((to_user, to_user, to_assistant, to_user)):
            at[k] = min(at[k], step)
        # before the row, a turn may be inserted: user after nothing, system and assistant, assistant after user
        nothing, system, user, assistant = (min(at[k], edge(INSERT, _I, at[other])) for k, other in enumerate((2, 2, 3, 2)))
    cost, digits = nothing >> width, nothing & low
    audit = "".join(LETTERS[digits >> at & 7] for at in range(width - _BITS, -1, -_BITS)).rstrip(LETTERS[0])
    return cost, audit


def emitted_roles(audit: str) -> Iterator[str]:
    """The initials that the audit's letters emit, but for D."""
    n = len(audit) - audit.count("D")
    if n % 2:
        yield "s"
    for _ in range(n // 2):
        yield from "ua"


# --- conversations ---------------------------------------------------------------------------------------------------

_KEYS = ["conv_id", "turn", "role", "digest"]


def turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest (of the text), with nulls of role and text as one space."""
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(NULL)).alias("role"),
                     F.coalesce("text", F.lit(NULL)).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*_KEYS)


def _own_fault(text: Column) -> Column:
    """Blank, truncated or fine."""
    last = F.regexp_extract(text, rf"([^{_SPACE}])[{_SPACE}]*\z", 1)
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT)


class _Structure:
    """What a conversation's rows amount to, in turn."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.seen, self.illegal, self.before = conv_id, [], set(), 0, None
        self.low = self.high = self.turn = None
        self.turns, self.faults = 0, [0, 0, 0, 0]

    def add(self, turn, role: str, digest: bytes, fault: int) -> None:
        if turn is not None:                             # rows come by turn: a new number is another one
            self.turns += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        key = hashlib.blake2b(role.encode() + b"\0" + digest, digest_size=16).digest()
        if fault != BLANK and key in self.seen:
            fault = DUPLICATE
        self.seen.add(key)
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        self.rows.append((initial if initial in "sua" else "", fault))

    def row(self) -> tuple:
        cost, audit = cheapest(self.rows)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults[BLANK:], self.illegal, cost, audit)


_STRUCTURE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[f[0] for f in fields])


def structure(rows: DataFrame) -> DataFrame:
    """Rows of ``turns`` -> one row per conversation: gaps, faults, illegal pairs, cost and audit."""
    on_workers(rows.sparkSession)

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for conv_id, turn, role, digest, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Structure(conv_id)
                now.add(turn, role, digest, fault)
            yield _arrow(done, _STRUCTURE)
        if now is not None:
            yield _arrow([now.row()], _STRUCTURE)

    small = rows.select("conv_id", "turn", "role", "digest", _own_fault(F.col("text")).alias("fault"))
    return _ordered(small).select(*_KEYS, "fault").mapInArrow(run, _STRUCTURE)


class _Repair:
    """The repaired turns of a conversation: (role, text) one by one, as its rows come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.roles = audit, 0, emitted_roles(audit)

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield NAMES[next(self.roles)], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            initial = next(self.roles)
            yield (role if letter == "K" else NAMES[initial]), text


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in turn."""
    plan = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
                        F.lit(None).cast("binary").alias("digest"))
    both = plan.unionByName(rows.withColumn("kind", F.lit(1)).select(*plan.columns))
    dealt = both.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", *_KEYS[1:])
    return dealt.select("conv_id", "kind", "turn", "role", "text")


def repair(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    on_workers(rows.sparkSession)
    schema = "conv_id long, place long, role string, text string"

    def run(batches):
        now = conv = None
        place = 0
        for batch in batches:
            out = []

            def put(pairs):
                nonlocal place
                for role, text in pairs:
                    out.append((conv, place, role, text))
                    place += 1

            for conv_id, kind, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if now is not None:
                        put(now.inserted())
                    now, conv, place = _Repair(text), conv_id, 0
                else:
                    put(now.row(role, text))
            yield _arrow(out, schema)
        if now is not None:
            out = []
            for role, text in now.inserted():
                out.append((conv, place, role, text))
                place += 1
            yield _arrow(out, schema)

    return _streamed(rows, found).mapInArrow(run, schema)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, place, role, text), by conversation and in turn within a task -> conv_id, repaired_sha256."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches):
        now, digest = None, None
        for batch in batches:
            done = []
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _arrow(done, schema)
        if digest is not None:
            yield _arrow([(now, digest.hexdigest())], schema)

    return repaired.mapInArrow(run, schema)


def repaired_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id): structure and repair of its rows of ``rows`` (see ``turns``)."""
    found = structure(rows)
    digests = repaired_digests(repair(rows, found)).withColumnRenamed("conv_id", "of")
    every = conversations.select(F.col("conv_id").alias("every")).distinct()
    out = every.join(found, F.col("every").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("every").eqNullSafe(F.col("of")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("every").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_EMPTY)).alias("repaired_sha256"))


# --- the query -------------------------------------------------------------------------------------------------------

def damaged(df: DataFrame) -> DataFrame:
    """``turns`` of a table of conversations, damaged by the crc32 of ``conv_id:turn``: of 20 remainders, 0 drops the
    row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it a user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in ("conv_id", "turn")])
    kind = F.col("__kind")
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit(NULL)).alias("role"), F.coalesce("text", F.lit(NULL)).alias("text"),
                     (F.crc32(key.cast("binary")) % 20).alias("__kind")).where(kind != 0)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns(rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("__copy")))


def op13_structure_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return repaired_report(conversations, damaged(conversations))


def _edge_sql(cost: int | str, letter: str, rest: str) -> str:
    """An edge before a path; a path is its cost in nine digits, then its letters."""
    return f"(lpad((substr({rest}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({rest}, 10))"


def _step_sql() -> tuple[str, str]:
    """(nodes before the rows' edges, nodes before the insertions): columns of the backward recursion."""
    def take(letter, base, rest):
        return f"CASE WHEN r.fault IN (0, 3) THEN {_edge_sql(f'{base} + (r.fault = 3)::INT', letter, rest)} END"
    user = f"least({take('R', REROLE, 'b.u')}, CASE WHEN r.i = 'u' THEN {take('K', KEEP, 'b.u')} END)"
    assistant = f"least({take('R', REROLE, 'b.a')}, CASE WHEN r.i = 'a' THEN {take('K', KEEP, 'b.a')} END)"
    system = f"CASE WHEN r.i = 's' AND b.s IS NOT NULL THEN {take('K', KEEP, 'b.s')} END"
    gone = {x: f"CASE WHEN b.{x} IS NOT NULL THEN {_edge_sql(DELETE, 'D', f'b.{x}')} END" for x in "nsua"}
    row = (f"least({gone['n']}, {user}, {system}) AS n, least({gone['s']}, {user}) AS s, least({gone['u']}, {assistant}) AS u, "
           f"least({gone['a']}, {user}) AS a")
    put = ", ".join(f"least({x}, {_edge_sql(INSERT, 'I', y)}) AS {x}" for x, y in (("n", "u"), ("s", "u"), ("u", "a"), ("a", "u")))
    return row, put


_ROW, _PUT = _step_sql()
#: The same by a backward recursion over the rows, with paths as texts that sort as they should; conversations of up to 10^8 in cost.
OP13_SQL = f"""
WITH RECURSIVE marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
rows AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k,
  regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last FROM rows),
judged AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS b,
  CASE WHEN last = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
       WHEN last IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault FROM placed),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
  count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (k > 1 AND (b || i) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS size FROM judged GROUP BY conv_id),
back AS (SELECT conv_id, size AS k, '000000000' AS n, NULL::VARCHAR AS s, '000000002I' AS u, '000000000' AS a FROM counted
  UNION ALL SELECT conv_id, k - 1, {_PUT}
  FROM (SELECT b.conv_id, b.k, {_ROW} FROM back b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.k = b.k)),
least_ones AS MATERIALIZED (SELECT conv_id, substr(n, 1, 9)::BIGINT AS cost, substr(n, 10) AS audit FROM back WHERE k = 0),
letters AS (SELECT conv_id, pos, substr(audit, pos::INT, 1) AS letter, len(replace(audit, 'D', '')) % 2 AS rest
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS pos FROM least_ones)),
numbered AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS k, count(*) FILTER (letter <> 'D') OVER w - rest AS token FROM letters
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
spoken AS (SELECT l.conv_id, l.pos, CASE WHEN l.letter = 'K' THEN j.role WHEN l.token % 2 = 1 THEN 'user' ELSE 'assistant' END AS role,
  CASE WHEN l.letter = 'I' THEN '' ELSE j.text END AS text
  FROM numbered l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.k = l.k WHERE l.letter <> 'D'),
said AS (SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY pos)) AS digest FROM spoken GROUP BY conv_id)
SELECT e.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(l.cost, 0)::BIGINT AS cost,
  coalesce(l.audit, '') AS audit, coalesce(s.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN least_ones l ON l.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""
