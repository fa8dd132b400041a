"""Chat formatting by token-level assembly.

A turn is ``<|im_start|>`` role newline text ``<|im_end|>`` newline.  Role and
text are encoded as segments of their own, and the two control marks are spliced in as
reserved ids beyond the tokenizer's vocabulary, which no text can encode to.  In
rendered text the marks are strings, so ``<|`` in a role or text is escaped: one more backslash
goes between ``<`` and ``|`` (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``),
which is undone by taking one away.  A newline in a role is written ``\\n``.

The loss mask covers the text tokens of assistant turns.  It is kept as token
ranges [start, end) of the conversation, from prefix sums over segment lengths.

Turns are range-partitioned by (conv_id, turn, beginnings of role and text), so that a conversation with a third of all
rows is the work of many tasks; each encodes its turns in order and streams them into parts, so memory does not grow
with a conversation.  A part holds whole turns, up to about ``max_tokens`` tokens together.  The parts are
written to the shared folder with token positions within their task; the few conversations that cross from one task to the next
(at most two a task) then get their offsets by prefix sums over the tasks' token counts.  A usual conversation
is one part; the last one of a conversation has ``last`` set.
Whole conversations are read back row by row; parts are decoded where they lie, and only the digest of
a conversation of several parts, which must see their texts in order, is one task's work.

Defined results: null roles and texts are empty.  Turns are ordered by turn (nulls
first), role and text; repeated rows are all kept (those alike in turn, role and the first
``_HEAD`` characters of the text are one task's).  Rows with a null conv_id are one
conversation.  An empty table gives an empty output.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisleflow.llm.common import cut, ship
from aisleflow.llm.token_files import load_tokenizer, worker_encoder

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class ChatConfig:
    tokenizer_path: str
    #: Tokens after which an output row ends at the next turn.
    max_tokens: int = 1 << 20


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def reserved_ids(tokenizer) -> tuple[int, int]:
    n = tokenizer.get_vocab_size()
    return n, n + 1


#: Characters of role and text by which turns are dealt over tasks.
_HEAD = 32


def _encoded(batches, cfg: ChatConfig):
    """(conv_id, role, ids as unsigned 32-bit integers, text's first token, token after it) of each turn of Arrow
    batches (conv_id, role, text)."""
    encoder = worker_encoder(cfg.tokenizer_path, literal=True)
    start, end = (np.array([i], "<u4") for i in reserved_ids(encoder.tokenizer))
    wide = lambda raw: np.frombuffer(raw, encoder.dtype).astype("<u4")
    newline = wide(encoder.encode(["\n"])[0])
    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            convs, roles, texts = (c.to_pylist() for c in batch.slice(i, 1000).columns)
            heads = [wide(x) for x in encoder.encode([escape_role(r) + "\n" for r in roles])]
            bodies = [wide(x) for x in encoder.encode([escape(t) for t in texts])]
            for conv_id, role, h, b in zip(convs, roles, heads, bodies):
                yield conv_id, role, np.concatenate([start, h, b, end, newline]).tobytes(), 1 + len(h), 1 + len(h) + len(b)


def assemble(turns: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Parts of conversations as their tasks see them: conv_id, task, part, first (begins the task), final (ends the
    conversation in the task), edge (at the beginning or end of the task), turns, first_token, n_tokens, ids,
    loss_ranges; parts and tokens are numbered from 0 in each task."""
    ship(turns.sparkSession)
    conv = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types: dict = {}
        state: dict = {}

        def typed(batches):
            for batch in batches:
                types["conv"] = batch.column(0).type
                yield batch

        def flush(final, ends_task=False):
            row = pa.RecordBatch.from_arrays(
                [pa.array([state["conv"]], types["conv"]), pa.array([task], pa.int32()), pa.array([state["part"]], pa.int32()), pa.array([final]),
                 pa.array([state["begins"] or ends_task]), pa.array([state["turns"]], pa.int64()), pa.array([state["first"]], pa.int64()),
                 pa.array([state["at"] - state["first"]], pa.int64()), pa.array([b"".join(state["ids"])], pa.binary()), pa.array([state["loss"]], kind)],
                names=["conv_id", "task", "part", "final", "edge", "turns", "first_token", "n_tokens", "ids", "loss_ranges"])
            state.update(part=state["part"] + 1, first=state["at"], ids=[], loss=[], turns=0)
            return row

        for conv_id, role, ids, a, b in _encoded(typed(batches), cfg):
            if not state or conv_id != state["conv"]:
                begins = not state
                if state:
                    yield flush(True)
                state.update(conv=conv_id, part=0, first=0, at=0, ids=[], loss=[], turns=0, begins=begins)
            elif state["at"] - state["first"] >= cfg.max_tokens:
                yield flush(False)
            if role == LOSS_ROLE and b > a:
                state["loss"].append({"start": state["at"] + a, "end": state["at"] + b})
            state["ids"].append(ids)
            state["at"] += len(ids) // 4
            state["turns"] += 1
        if state:
            yield flush(True, ends_task=True)

    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # beginnings are in the order of the whole; the text counts only among equal roles
    role_head = F.substring("role", 1, _HEAD)
    text_head = F.when(F.char_length("role") < _HEAD, F.substring("text", 1, _HEAD))
    return rows.repartitionByRange(F.col("conv_id"), F.col("turn"), role_head, text_head) \
        .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text") \
        .mapInArrow(run, f"conv_id {conv}, task int, part int, final boolean, edge boolean, turns long, first_token long, n_tokens long, ids binary, "
                         "loss_ranges array<struct<start: long, end: long>>")


def _offsets(parts: DataFrame) -> DataFrame:
    """(__conv, __task, tokens and parts of the conversation in earlier tasks, whether later tasks have more of it) of the
    conversations at the beginning or end of a task: at most two rows a task."""
    edge = parts.where("edge and final").select("conv_id", "task", (F.col("first_token") + F.col("n_tokens")).alias("tokens"), (F.col("part") + 1).alias("parts"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return edge.select(
        F.col("conv_id").alias("__conv"), F.col("task").alias("__task"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("__tokens"),
        F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int").alias("__parts"),
        F.lead("task").over(Window.partitionBy("conv_id").orderBy("task")).isNotNull().alias("__more"))


def format_conversations(turns: DataFrame, cfg: ChatConfig) -> DataFrame:
    """One row for each conversation (several parts for a very long one, or one that crosses tasks): conv_id, part,
    last, first_token, ids (unsigned 32-bit little-endian), loss_ranges (token positions
    in the conversation).  The rows are read from a written table."""
    parts = cut(assemble(turns, cfg), "chat")
    own = (F.col("task") == F.col("__task")) & F.col("conv_id").eqNullSafe(F.col("__conv"))
    tokens = F.coalesce(F.col("__tokens"), F.lit(0))
    moved = F.transform("loss_ranges", lambda r: F.struct((r["start"] + tokens).alias("start"), (r["end"] + tokens).alias("end")))
    return parts.join(F.broadcast(_offsets(parts)), own, "left").select(
        "conv_id", (F.col("part") + F.coalesce("__parts", F.lit(0))).alias("part"),
        (F.col("final") & ~F.coalesce("__more", F.lit(False))).alias("last"),
        (F.col("first_token") + tokens).alias("first_token"), "ids", moved.alias("loss_ranges"))


def parse(ids: np.ndarray, tokenizer, start: int, end: int) -> list[tuple[str, str, int, int]]:
    """(role, text, first and last token of the text) of the turns in ``ids``."""
    return parse_counted(ids, tokenizer, start, end)[0]


def parse_counted(ids: np.ndarray, tokenizer, start: int, end: int) -> tuple[list[tuple[str, str, int, int]], int]:
    """(turns as of ``parse``, code points of the whole formatted text): every token is decoded once."""
    begins, ends = np.flatnonzero(ids == start), np.flatnonzero(ids == end)
    if len(begins) != len(ends) or np.any(begins >= ends) or np.any(ends[:-1] >= begins[1:]):
        raise ValueError("the marks of the turns do not alternate")
    decoded = tokenizer.decode_batch([ids[a + 1:b].tolist() for a, b in zip(begins, ends)], skip_special_tokens=False)
    # what lies outside of the turns: line ends after them
    outside = [ids[a:b].tolist() for a, b in zip(np.concatenate(([0], ends + 1)), np.append(begins, len(ids)))]
    chars = sum(map(len, decoded)) + sum(map(len, tokenizer.decode_batch([x for x in outside if x], skip_special_tokens=False)))
    out = []
    for text, a, b in zip(decoded, begins, ends):
        role, _, body = text.partition("\n")
        out.append((unescape_role(role), unescape(body), int(a), int(b)))
    return out, chars + len(begins) * (len(START) + len(END))


def render(ids: np.ndarray, tokenizer, start: int, end: int) -> str:
    """The formatted text of ``ids``, control marks as strings."""
    marks = np.flatnonzero((ids == start) | (ids == end))
    bounds = np.concatenate(([-1], marks, [len(ids)]))
    between = tokenizer.decode_batch([ids[a + 1:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])], skip_special_tokens=False)
    strings = [START if ids[m] == start else END for m in marks]
    return "".join(x for pair in zip(between, [*strings, ""]) for x in pair)


def digests(formatted: DataFrame, cfg: ChatConfig) -> DataFrame:
    """Read the output back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars.  ``formatted`` is read twice."""
    ship(formatted.sparkSession)
    conv = formatted.schema["conv_id"].dataType.simpleString()

    def decoded(batches):
        """(conv_id, turns, their roles and texts, text under the mask, its code points, code points in all) of each row."""
        tokenizer = load_tokenizer(cfg.tokenizer_path, literal=True)
        start, end = reserved_ids(tokenizer)
        for batch in batches:
            for conv_id, first, raw, loss in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids = np.frombuffer(raw, "<u4")
                turns, chars = parse_counted(ids, tokenizer, start, end)
                said = "".join(f"{role}\n{text}\n" for role, text, _, _ in turns).encode()
                spans = [ids[r["start"] - first:r["end"] - first].tolist() for r in loss]
                masked = "".join(map(unescape, tokenizer.decode_batch(spans, skip_special_tokens=False)))
                yield conv_id, len(turns), said, masked.encode(), len(masked), chars

    def in_blocks(rows, types, names, size):
        import pyarrow as pa

        held = []
        for row in rows:
            held.append(row)
            if len(held) >= size:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names=names)

    def peeked(batches):
        """(type of the first column, the batches)"""
        batches = iter(batches)
        first = next(batches, None)
        return (None, iter(())) if first is None else (first.column(0).type, chain([first], batches))

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def whole(batches):
        import pyarrow as pa

        kind, batches = peeked(batches)
        rows = ((conv_id, n, hashlib.sha256(said).hexdigest(), masked_chars, hashlib.sha256(masked).hexdigest(), chars)
                for conv_id, n, said, masked, masked_chars, chars in decoded(batches))
        yield from in_blocks(rows, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], names, 1000)

    def texts(batches):
        import pyarrow as pa

        part_of: deque = deque()

        def noted(batches):
            for batch in batches:
                part_of.extend(batch.column(4).to_pylist())
                yield batch

        kind, batches = peeked(batches)
        rows = ((conv_id, part_of.popleft(), *rest) for conv_id, *rest in decoded(noted(batches)))
        yield from in_blocks(rows, [kind, pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()],
                             ["conv_id", "part", "n", "said", "masked", "masked_chars", "chars"], 1)

    def joined(batches):
        import pyarrow as pa

        kind, batches = peeked(batches)

        def rows():
            now = None
            closed = lambda: (now["conv"], now["n"], now["said"].hexdigest(), now["masked_chars"], now["masked"].hexdigest(), now["chars"])
            for batch in batches:
                for i in range(batch.num_rows):
                    conv_id, n, said, masked, masked_chars, chars = (c[i].as_py() for c in batch.columns)
                    if now is None or conv_id != now["conv"]:
                        if now is not None:
                            yield closed()
                        now = {"conv": conv_id, "n": 0, "said": hashlib.sha256(), "masked": hashlib.sha256(), "masked_chars": 0, "chars": 0}
                    now["said"].update(said)
                    now["masked"].update(masked)
                    for key, more in (("n", n), ("masked_chars", masked_chars), ("chars", chars)):
                        now[key] += more
            if now is not None:
                yield closed()

        yield from in_blocks(rows(), [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], names, 1000)

    schema = f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "first_token", "ids", "loss_ranges"]
    is_whole = F.col("last") & (F.col("part") == 0)
    one = formatted.filter(is_whole).select(*columns).mapInArrow(whole, schema)
    several = formatted.filter(~is_whole).select(*columns, "part") \
        .mapInArrow(texts, f"conv_id {conv}, part int, n long, said binary, masked binary, masked_chars long, chars long")
    in_order = several.repartition("conv_id").sortWithinPartitions("conv_id", "part").drop("part")
    return one.unionByName(in_order.mapInArrow(joined, schema))
