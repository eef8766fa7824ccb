"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``; a conversation
is its turns in order, nothing between them.  The deterministic parser of this
grammar reads a backslash as "the next character is ordinary" and refuses any
control string inside a role or text.  Every rendered turn is parsed again and
compared with its source; what differs is rendered at the next escaping level
(control strings, then backslashes as well) until it is identical.  The loss
mask covers the texts of assistant turns.

``render_turns`` works row by row.  ``read_back`` streams each conversation's
rendered turns, in order, through the same parser; it keeps running digests
only, so a conversation of any length needs no more memory than a turn (its
digest is sequential, hence one task reads it).

Cases: null roles and texts are empty; turns of one number are ordered by role
and text, null numbers come first; a null conv_id is a conversation of its
own; repeated rows are separate turns; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.llm.common import on_workers, shuffle_partitions, table

OPEN, BREAK, CLOSE, ESCAPE = "<|im_start|>", "\n", "<|im_end|>\n", "\\"
#: Strings (fixed values) that must not appear unescaped in a role or text.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LOSS_ROLES = frozenset({"assistant"})
_control = re.compile("|".join(map(re.escape, CONTROL)))
_piece = re.compile(r"\\(.)|(%s)|(\n)|[^\\<\[\n]+|[<\[]" % "|".join(map(re.escape, CONTROL)), re.S)


class GrammarError(ValueError):
    pass


def _parse_turn(s: str, at: int) -> tuple[str, str, int] | None:
    """(role, text, end) of the turn at ``at``; None if it isn't complete."""
    if not s.startswith(OPEN, at):
        if len(s) - at < len(OPEN) and OPEN.startswith(s[at:]):
            return None
        raise GrammarError(f"no turn at {at}")
    at += len(OPEN)
    role, out = None, []
    while True:
        m = _piece.match(s, at)
        if m is None:
            return None
        at = m.end()
        if m[1] is not None:
            out.append(m[1])
        elif m[2] is not None:
            if role is None or m[2] + "\n" != CLOSE:
                raise GrammarError(f"{m[2]} at {at}")
            if at >= len(s):
                return None
            if s[at] != "\n":
                raise GrammarError(f"{m[2]} at {at}")
            return role, "".join(out), at + 1
        elif m[3] is not None and role is None:
            role, out = "".join(out), []
        else:
            out.append(m[0])


def read_turns(chunks: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Turns of a conversation that comes in pieces of any size."""
    rest = ""
    for chunk in chunks:
        rest += chunk
        at = 0
        while at < len(rest) and (turn := _parse_turn(rest, at)):
            yield turn[0], turn[1]
            at = turn[2]
        rest = rest[at:]
    if rest:
        raise GrammarError("unfinished turn")


def _escaped(s: str, level: int, role: bool) -> str:
    if level == 2:
        s = s.replace(ESCAPE, ESCAPE * 2)
    if level:
        s = _control.sub(lambda m: ESCAPE + m[0], s)
        if role:
            s = s.replace(BREAK, ESCAPE + BREAK)
    return s


def render_turn(role: str, text: str) -> tuple[str, int]:
    """(rendered turn, escaping level): the least level that reads back identically."""
    for level in range(3):
        out = OPEN + _escaped(role, level, True) + BREAK + _escaped(text, level, False) + CLOSE
        try:
            if list(read_turns([out])) == [(role, text)]:
                return out, level
        except GrammarError:
            pass
    raise GrammarError("a turn that no level renders")


def _source_digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{role}\0{text}".encode()).digest()[:8]


def render_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, turn, role, text, formatted, level, source."""
    on_workers(df.sparkSession)
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            pairs = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            done = [render_turn(role, text) for role, text in pairs]
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()),
                                 pa.array([_source_digest(*p) for p in pairs], pa.binary())],
                names=["conv_id", "turn", "role", "text", "formatted", "level", "source"])

    schema = T.StructType(list(rows.schema.fields)).add("formatted", "string").add("level", "integer").add("source", "binary")
    return rows.mapInArrow(run, schema)


class _Conversation:
    """Running digests of one conversation, from its rendered turns alone."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars, self.same = conv_id, 0, 0, 0, True
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, source: bytes) -> None:
        self.formatted_chars += len(formatted)
        found = list(read_turns([formatted]))
        self.same &= len(found) == 1 and _source_digest(*found[0]) == source
        for role, text in found:
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role in LOSS_ROLES:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars, self.same)


def read_back(rendered: DataFrame) -> DataFrame:
    """One row per conversation, read from its rendered turns: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, same (all turns equal their sources)."""
    on_workers(rendered.sparkSession)
    # the rendered turn sorts like role and text only if nothing is escaped: order by the source
    ordered = (rendered.repartition(shuffle_partitions(rendered.sparkSession), "conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "formatted", "source"))
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, same boolean")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches):
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                              names=[f.split()[0] for f in schema.split(", ")])
        now, done = None, []
        for batch in batches:
            for conv_id, formatted, source in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.add(formatted, source)
            if done:
                yield out(done)
                done = []
        if now is not None:
            yield out([now.row()])

    return ordered.mapInArrow(run, schema)


#: The conversation that is added to the table: a user and an assistant row of control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return read_back(render_turns(turns.unionByName(probe)))
