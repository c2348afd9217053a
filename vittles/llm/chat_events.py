"""Chat formatting by event-sourced reconstruction.

A chat log holds events of messages: `delta` appends text, `edit` replaces the text,
`regenerate` empties the message and discards the later messages logged before it.
Events are range-partitioned by conversation and sequence and folded in order. A
conversation may be cut by partition bounds, so no conversation has to fit into a
task: each part folds to one state per message, and states of neighbouring parts
combine, as a state with a reset overrides what came before. A part's smallest
regenerated message discards later messages of the parts before; only conversations
that a bound cuts need that, at most one per bound.

Messages are then rendered, one piece per turn, control strings in texts escaped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
MESSAGE = ["turn", "copy"]
#: code points of a streamed delta in the log that `events_of` makes
DELTA_CHARS = 200
#: added to `copy` for a message that a later regeneration discards
DISCARDED = 1 << 30

PIECE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: Column) -> Column:
    """Put one backslash more between `<` and `|`, so no control string is left. `unescape` takes it away."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def events_of(conversations: DataFrame) -> DataFrame:
    """The event log behind finished turns (conv_id, turn, role, text), as a chat service would write it.

    An assistant's turn is streamed twice: a draft, a follow-up that is discarded,
    then the regenerated text. Another turn is sent with a slip and edited.
    Null role or text counts as empty. Rows with the same turn are turns of their
    own, in the order of role and text.
    """
    from pyspark.sql import Window

    ties = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("copy", F.row_number().over(ties).cast("long"))

    def event(step: Column | int, kind: str, text: Column, copy: Column | None = None, role: Column | None = None) -> Column:
        at = F.lit(step) if isinstance(step, int) else step
        return F.struct(at.cast("long").alias("step"), (F.col("copy") if copy is None else copy).alias("copy"), F.lit(kind).alias("kind"),
                        (F.col("role") if role is None else role).alias("role"), text.alias("text"))

    last = F.floor((F.greatest(F.length("text"), F.lit(1)) - 1) / DELTA_CHARS).cast("int")
    streamed = F.transform(F.sequence(F.lit(0), last), lambda i: event(i + 3, "delta", F.substring(F.col("text"), i * DELTA_CHARS + 1, F.lit(DELTA_CHARS))))
    draft = F.array(event(0, "delta", F.reverse("text")), event(1, "delta", F.lit("so?"), F.col("copy") + DISCARDED, F.lit("user")), event(2, "regenerate", F.lit("")))
    edited = F.array(event(0, "delta", F.concat("text", F.lit("?"))), event(1, "edit", F.col("text")))
    log = rows.select("conv_id", "turn", F.col("copy").alias("sent"), F.explode(F.when(F.col("role") == "assistant", F.concat(draft, streamed)).otherwise(edited)).alias("e"))
    return log.select("conv_id", "turn", "sent", "e.*")


def fold(events: DataFrame, order: list[str]) -> DataFrame:
    """Final messages (conv_id, turn, copy, role, text) of an event log.

    `events` has conv_id, the message's turn and copy, kind, role, text and the
    columns `order` that sort a conversation's events. Messages are ordered by turn and
    copy, null first. Events without text add none. Further columns are ignored.
    """
    kind = events.schema["conv_id"].dataType.simpleString()
    by = [F.col("conv_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    sorted_log = events.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", *MESSAGE, "kind", "role", "text")
    names = ["conv_id", *MESSAGE, "part", "cut", "reset", "role", "text"]

    def rank(key: tuple) -> tuple:
        return tuple((v is not None, v or 0) for v in key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, state, cut, out = TaskContext.get().partitionId(), object(), {}, None, []
        kinds = None

        def flush() -> None:
            out.extend((now, *k, part, False, reset, role, "".join(texts)) for k, (reset, role, texts) in state.items())
            if cut is not None:
                out.append((now, *cut, part, True, False, None, None))

        def rows() -> pa.RecordBatch:
            types = [kinds, pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
            cols = list(zip(*out)) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            kinds = batch.column(0).type
            for conv, turn, copy, what, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now:
                    if state:
                        flush()
                    now, state, cut = conv, {}, None
                key = (turn, copy)
                if what == "regenerate":
                    if cut is None or rank(key) < rank(cut):
                        cut = key
                    state = {k: v for k, v in state.items() if rank(k) <= rank(key)}
                if what in ("regenerate", "edit"):
                    state[key] = (True, role, [text or ""])
                else:
                    reset, _, texts = state.get(key, (False, role, []))
                    texts.append(text or "")
                    state[key] = (reset, role, texts)
            if len(out) >= 5000:
                yield rows()
                out.clear()
        if state:
            flush()
        if kinds is not None:
            yield rows()

    from vittles.llm.common import checkpointed

    schema = f"conv_id {kind}, turn long, copy long, part int, cut boolean, reset boolean, role string, text string"
    states = checkpointed(sorted_log.mapInArrow(work, schema))
    # conversations that lie in several parts: fewer than there are parts
    split = states.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(F.col("conv_id").alias("split_id"))
    cuts = states.where("cut").join(F.broadcast(split), F.col("conv_id").eqNullSafe(F.col("split_id"))).select(
        F.col("conv_id").alias("cut_id"), F.col("part").alias("cut_part"), F.struct(*MESSAGE).alias("cut_at"))
    gone = F.col("conv_id").eqNullSafe(F.col("cut_id")) & (F.col("cut_part") > F.col("part")) & (F.col("cut_at") < F.struct(*MESSAGE))
    left = states.where("not cut").join(F.broadcast(cuts), gone, "left_anti")
    parts = F.sort_array(F.collect_list(F.struct("part", "reset", "role", "text")))
    joined = left.groupBy("conv_id", *MESSAGE).agg(parts.alias("parts"))
    text = F.aggregate("parts", F.lit(""), lambda seen, p: F.when(p["reset"], p["text"]).otherwise(F.concat(seen, p["text"])))
    return joined.select("conv_id", *MESSAGE, F.element_at("parts", -1)["role"].alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Formatted pieces (conv_id, turn, copy, piece, loss_start, loss_end); a conversation is its pieces in order.

    The loss mask is the code points from loss_start to loss_end of an assistant's
    piece, its text as escaped; null for other roles.
    """
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    piece = F.concat(head, text, F.lit(f"{END}\n"))
    masked = F.col("role") == "assistant"
    return messages.select("conv_id", *MESSAGE, piece.alias("piece"), F.when(masked, F.length(head)).alias("loss_start"), F.when(masked, F.length(head) + F.length(text)).alias("loss_end"))


def read_back(pieces: DataFrame) -> DataFrame:
    """Parse formatted pieces again: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Pieces of a conversation are streamed through its task in order, one at a time in
    memory; a digest of a whole conversation allows no split.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, kinds, out = None, None, pa.int64(), []

        def flush() -> None:
            if seen:
                out.append((now, seen[0], seen[1].hexdigest(), seen[2], seen[3].hexdigest(), seen[4]))

        def rows() -> pa.RecordBatch:
            types = [kinds, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, types)], names=names)

        for batch in batches:
            kinds = batch.column(0).type
            for conv, piece, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if seen is None or conv != now:
                    flush()
                    now, seen = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = PIECE.fullmatch(piece).groups()
                seen[0] += 1
                seen[1].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                if a is not None:
                    learnt = unescape(piece[a:b])
                    seen[2] += len(learnt)
                    seen[3].update(learnt.encode())
                seen[4] += len(piece)
            if len(out) >= 5000:
                yield rows()
                out.clear()
        flush()
        yield rows()

    by = [F.col(c).asc_nulls_first() for c in ("conv_id", *MESSAGE)]
    dealt = pieces.repartition("conv_id").sortWithinPartitions(*by).select("conv_id", "piece", "loss_start", "loss_end")
    return dealt.mapInArrow(work, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
