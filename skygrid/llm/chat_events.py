"""Chat formatting: messages folded from event logs, rendered with escapes and a loss mask, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import raw

START, END = "<|im_start|>", "<|im_end|>"
ROW_LIMIT = 4096


def chat_events(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", chunk: int = 200, most: int = 64) -> DataFrame:
    """An event log as a chat service would leave it, from a table of final messages.

    Every message opens and streams in deltas of ``chunk`` characters, or of a ``most``-th of its text if that is longer;
    an assistant's first try breaks off halfway and is generated again, other messages are typed and then edited.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    width = F.greatest(F.lit(chunk), F.ceil(F.length("text") / most)).cast("int")
    event = lambda step, kind, value: F.struct(F.lit(step).cast("long").alias("step"), F.lit(kind).alias("kind"), value.alias("value"))
    none = F.lit(None).cast("string")
    first_try = F.when(F.col("role").eqNullSafe("assistant"),
                       F.array(event(1, "delta", F.substring("text", F.lit(1), (F.length("text") / 2).cast("int"))), event(2, "regenerate", none)))
    typed = F.array(event(1, "delta", F.lit("...")), event(2, "edit", F.lit("")))
    deltas = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / F.col("width")).cast("int") - 1, F.lit(0))),
                         lambda k: F.struct((k + 3).cast("long").alias("step"), F.lit("delta").alias("kind"),
                                            F.substring("text", (k * F.col("width") + 1).cast("int"), F.col("width")).alias("value")))
    return (rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), text.alias("text"))
            .withColumn("message", F.monotonically_increasing_id()).withColumn("width", width)
            .select("conv_id", "turn", "message", "role",
                    F.explode(F.concat(F.array(event(0, "open", none)), F.coalesce(first_try, typed), deltas)).alias("e"))
            .select("conv_id", "turn", F.col("e.step").alias("step"), "message", F.col("e.kind").alias("kind"), "role", F.col("e.value").alias("text")))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of equal (conv_id, message); rows come sorted, a message may span batches."""
    key = turn = role = schema = None
    parts: list[bytes] = []
    out: list[tuple] = []

    def table():
        cols = list(zip(*out)) if out else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), schema.field(n).type) if n != "text" else pa.array(list(c), pa.binary()).cast(pa.string())
                                           for c, n in zip(cols, ("conv_id", "turn", "message", "role", "text"))], ["conv_id", "turn", "message", "role", "text"])

    for batch in batches:
        schema = batch.schema
        col = {n: batch.column(schema.names.index(n)).to_pylist() for n in ("conv_id", "turn", "message", "kind", "role")}
        for conv, t, message, kind, who, text in zip(*col.values(), raw(batch, "text")):
            if key != (conv, message):
                if key is not None:
                    out.append((key[0], turn, key[1], role, b"".join(parts)))
                key, turn, role, parts = (conv, message), t, None, []
                if len(out) >= ROW_LIMIT:
                    yield table()
                    out.clear()
            if kind == "open":
                role = who
            elif kind == "delta":
                parts.append(text)
            elif kind == "edit":
                parts = [text]
            elif kind == "regenerate":
                parts = []
    if key is not None:
        out.append((key[0], turn, key[1], role, b"".join(parts)))
        yield table()


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of a log: conv_id, turn, message, role, text.

    ``events`` has conv_id, turn and step (the sequence inside a conversation), message, kind, role, text. In sequence, ``open``
    sets the role, ``delta`` adds to the text, ``edit`` puts a text in its place, ``regenerate`` drops what was streamed;
    events of another or null kind do nothing. A log is dealt out by conversation and message, so a conversation of any
    share of the rows is spread, sorted, and folded as a stream that holds one message at a time.

    A null text adds nothing. A message that never opened has a null role. The turn is that of its first event. Null
    conversations and messages are values like others. Events of equal sequence go by kind and text; a repeated event
    counts again. Other columns are not read.
    """
    return (events.select("conv_id", "turn", "step", "message", "kind", "role", "text").repartition("conv_id", "message")
            .sortWithinPartitions("conv_id", "message", "turn", "step", F.col("kind").desc(), "text")
            .mapInArrow(_fold, ", ".join(f"{n} {events.schema[n].dataType.simpleString()}" for n in ("conv_id", "turn", "message", "role", "text"))))


def _escaped(column: str):
    """A control string inside a text gets one more backslash behind its ``<``; read back, one is taken away."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"<(\\*)\|", r"<$1\\|")


def render(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) as template pieces: conv_id, turn, piece, loss_start, loss_end.

    A conversation's formatted text is its pieces in order of (turn, piece); each is one marked turn. ``loss_start`` and ``loss_end``
    are character offsets in the piece of an assistant's text, null for other roles. Line ends in a role are written
    as ``%0A``, per cents as ``%25``; a null role is empty.
    """
    role = F.regexp_replace(F.regexp_replace(_escaped("role"), "%", "%25"), "\n", "%0A")
    head, body = F.concat(F.lit(START), role, F.lit("\n")), _escaped("text")
    learn = F.col("role").eqNullSafe("assistant")
    return messages.select("conv_id", "turn", F.concat(head, body, F.lit(END + "\n")).alias("piece"),
                           F.when(learn, F.length(head)).alias("loss_start"), F.when(learn, F.length(head) + F.length(body)).alias("loss_end"))


_PIECE = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + "\n", re.DOTALL)
_MORE = re.compile(r"<(\\*)\\\|")


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    found = _PIECE.fullmatch(piece)
    if not found:
        raise ValueError(f"not a rendered turn: {piece[:80]!r}")
    role, text = (_MORE.sub(r"<\1|", x) for x in found.groups())
    return role.replace("%0A", "\n").replace("%25", "%"), text


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    state: list | None = None
    out: list[list] = []
    kind = None

    def row():
        return [state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]]

    def table():
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        cols = [batch.column(batch.schema.names.index(n)).to_pylist() for n in ("conv_id", "loss_start", "loss_end")]
        for conv, begin, end, data in zip(*cols, raw(batch, "piece")):
            if state is None or state[0] != conv:
                if state is not None:
                    out.append(row())
                    if len(out) >= ROW_LIMIT:
                        yield table()
                        out = []
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            piece = data.decode("utf-8", "replace")
            role, text = read_piece(piece)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[5] += len(piece)
            if begin is not None:
                learned = _MORE.sub(r"<\1|", piece[begin:end])
                state[3] += len(learned)
                state[4].update(learned.encode())
    if state is not None:
        out.append(row())
    if out:
        yield table()


def digest_conversations(pieces: DataFrame) -> DataFrame:
    """What is read back from rendered pieces, one row a conversation: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    A digest runs over a conversation in order, so its pieces pass through one task; they stream, and only hash states are held.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")
            .mapInArrow(_digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
