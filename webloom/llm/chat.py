"""Chat formatting in budgeted windows.

Every turn is ``<s>[ROLE]role[/ROLE]text</s>`` with control strings inside
role and text escaped by a backslash after their first character (and the
backslash by itself), so no control string of a text survives and unescaping
is exact. Prefix sums of turn tokens choose turn-aligned windows of at most
``budget`` tokens: each window starts with the system turn, repeats up to
``history`` tokens of whole earlier turns, then takes new turns while they fit
(a single turn over the budget has a window of its own, whole). The loss mask
covers the texts of new assistant turns; repeated turns are masked out.

Long conversations. The prefix sums are computed in two levels (ranges of
turns, then their totals) and cut a conversation into segments of about
``segment`` windows' tokens. Segments are the unit of work; each carries copies
of the system turn and of the history before it. No task holds a conversation.

Rows: turns are ordered by (turn, role, text), null turns last; repeated rows
are turns of their own. Null role and text count as empty. A null conv_id is a
conversation like any other. The system turn is the first turn if its role is
``system``. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import per_group, require, stored

#: Control strings of the template and of common chat formats (fixed values).
CONTROL = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)
TURN_RANGE = 256
#: Tokens a turn costs besides its text: the markers and the role.
OVERHEAD = 6


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn and the span of its text."""
    head = f"<s>[ROLE]{escape(role)}[/ROLE]"
    body = escape(text)
    return f"{head}{body}</s>", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _placed(df: DataFrame) -> DataFrame:
    """Turns with tokens and the exclusive prefix sum ``start`` per
    conversation, in two levels so that no window spans a conversation's text."""
    text = F.coalesce("text", F.lit(""))
    tokens = (F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + OVERHEAD).cast("bigint")
    turns = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
                      tokens.alias("tokens"),
                      F.coalesce(F.floor(F.col("turn") / TURN_RANGE), F.lit(1 << 60)).alias("range"))
    inner = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    turns = (turns.withColumn("rank", F.row_number().over(inner))
             .withColumn("inside", F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")))
    outer = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (turns.groupBy("conv_id", "range").agg(F.sum("tokens").alias("sum"))
              .withColumn("ahead", F.coalesce(F.sum("sum").over(outer), F.lit(0)))
              .select(F.col("conv_id").alias("c"), F.col("range").alias("r"), "ahead"))
    return (turns.join(ranges, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
            .withColumn("start", F.col("inside") + F.col("ahead"))
            .select("conv_id", "range", "rank", "role", "text", "tokens", "start"))


def chat_windows(df: DataFrame, budget: int = 1024, history: int = 256, segment: int = 64) -> DataFrame:
    """(conv_id, segment, window, formatted, n_repeated, n_turns,
    loss array<struct<start, end>>): windows of every conversation in order."""
    require(df, "conv_id", "turn", "role", "text")
    if not 0 <= history < budget:
        raise ValueError("history must be at least 0 and below the budget")
    turns = _placed(df).withColumn("segment", F.floor(F.col("start") / (budget * segment)))
    turns = stored(turns, "chat-turns")
    system = (turns.where("start = 0 and role = 'system' and rank = 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("sys_role"), F.col("text").alias("sys_text"),
        F.col("tokens").alias("sys_tokens")))
    order = Window.partitionBy("conv_id").orderBy("segment")
    ends = (turns.groupBy("conv_id", "segment").agg(F.max(F.col("start") + F.col("tokens")).alias("end"))
            .withColumn("following", F.lead("segment").over(order))
            .select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), "end", "following"))
    # kind 0: the system turn, 1: history from the segment before, 2: own turns
    own = turns.withColumn("kind", F.lit(2))
    later = ends.where("following is not null")
    before = (turns.join(later, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")))
              .where((F.col("start") >= F.col("end") - history) & (F.col("start") > 0))
              .withColumn("segment", F.col("following")).withColumn("kind", F.lit(1)).drop("c", "s", "end", "following"))
    heads = (later.withColumnRenamed("c", "conv_id").join(system, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.lit(0).cast("bigint").alias("range"), F.lit(0).alias("rank"), F.col("sys_role").alias("role"),
        F.col("sys_text").alias("text"), F.col("sys_tokens").alias("tokens"), F.lit(0).cast("bigint").alias("start"),
        F.col("following").alias("segment"), F.lit(0).alias("kind")))
    rows = own.unionByName(before).unionByName(heads)
    kind = df.schema["conv_id"].dataType.simpleString()
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(segments):
        for group in segments:
            yield _windows(group, budget, history, loss_type)

    return per_group(rows, ["conv_id", "segment"], ["kind", "start", "range", "rank"], run,
                     f"conv_id {kind}, segment bigint, window int, formatted string, n_repeated int, n_turns int, "
                     "loss array<struct<start: bigint, end: bigint>>")


def _windows(group: pa.Table, budget: int, history: int, loss_type) -> pa.RecordBatch:
    rows = group.select(["kind", "role", "text", "tokens", "start"]).to_pylist()
    system = None
    own = [r for r in rows if r["kind"] == 2]
    past = [r for r in rows if r["kind"] == 1]
    if rows[0]["kind"] == 0:
        system = rows[0]
    elif own[0]["start"] == 0 and own[0]["role"] == "system":
        system = own[0]
    out, at = [], 0
    while at < len(own):
        fresh = own[at:at + 1]
        fixed = system["tokens"] if system is not None and fresh[0] is not system else 0
        used = fixed + fresh[0]["tokens"]
        repeated: list[dict] = []
        room = min(history, budget - used)
        for r in reversed(past):
            if r["tokens"] > room:
                break
            room -= r["tokens"]
            used += r["tokens"]
            repeated.insert(0, r)
        if fixed:
            repeated.insert(0, system)
        for r in own[at + 1:]:
            if used + r["tokens"] > budget:
                break
            used += r["tokens"]
            fresh.append(r)
        parts, size, loss = [], 0, []
        for i, r in enumerate(repeated + fresh):
            turn, a, b = format_turn(r["role"], r["text"])
            if i >= len(repeated) and r["role"] == "assistant":
                loss.append({"start": size + a, "end": size + b})
            parts.append(turn)
            size += len(turn)
        out.append(("".join(parts), len(repeated), len(fresh), loss))
        at += len(fresh)
        past = [r for r in past + fresh if r is not system]
        kept, room = len(past), history
        while kept and past[kept - 1]["tokens"] <= room:
            kept -= 1
            room -= past[kept]["tokens"]
        past = past[kept:]
    n = len(out)
    first = group.slice(0, 1).combine_chunks()
    text, repeated_n, turn_n, loss = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(first["conv_id"].to_pylist() * n, group.schema.field("conv_id").type),
         pa.array(first["segment"].to_pylist() * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(text),
         pa.array(repeated_n, pa.int32()), pa.array(turn_n, pa.int32()), pa.array(loss, loss_type)],
        names=["conv_id", "segment", "window", "formatted", "n_repeated", "n_turns", "loss"])


def chat_digests(windows: DataFrame) -> DataFrame:
    """Read the windows back: per conversation (conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows). A
    digest runs over the whole conversation, so its windows are streamed in
    order through one task, a batch at a time; nothing is gathered."""
    kind = windows.schema["conv_id"].dataType.simpleString()
    fields = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())]

    def run(batches):
        state, conv, done = None, None, []
        kind_ = None

        def close():
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        def flush():
            cols = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind_)] + [pa.array(c, t) for c, (_, t) in zip(cols[1:], fields, strict=True)],
                names=["conv_id"] + [n for n, _ in fields])

        for batch in batches:
            kind_ = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        done.append(close())
                    conv, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                turns = parse(row["formatted"])[row["n_repeated"]:]
                state[0] += len(turns)
                for role, text in turns:
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["formatted"][span["start"]:span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(row["formatted"])
                state[5] += 1
            if len(done) > 1000:
                yield flush()
                done = []
        if state is not None:
            done.append(close())
            yield flush()

    return (windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint, n_windows bigint"))
