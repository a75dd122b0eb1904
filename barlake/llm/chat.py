"""Chat formatting with a template that is only called, never read.

The operator renders successive prefixes of a conversation and compares
consecutive outputs: what the output gained is the span of the turn. If an
output does not begin with the one before it, the template rewrites history;
the conversation is then marked with the turn at which it did, and carries no
spans, since no mask over it would be right. Inside a span, two renderings with
different one-letter texts show where the text of the turn begins and ends, so
the loss mask covers exactly the assistant's text and none of the markup.

Turns go by ``turn`` (null first), then role and text. A null text or role is
empty. Rows without ``conv_id`` form one conversation of their own. Repeated
rows are repeated turns. Only the four named columns are read, so extra columns
cannot clash. An empty table gives no conversation. A conversation is one
training record: one task holds its text, rows stream in from a sorted shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The marks of the template below begin with < or [; the escape leaves neither in a text.
ESCAPES = {"\\": "\\b", "<": "\\l", "[": "\\s", "]": "\\e"}
_unescape = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    for mark, code in ESCAPES.items():  # the backslash is the first of them
        text = text.replace(mark, code)
    return text


def unescape(text: str) -> str:
    return text if "\\" not in text else re.sub(r"\\[blse]", lambda m: _unescape[m[0]], text)


def _marked(role: str, text: str) -> str:
    text = escape(text)
    if role == "user":
        return f"<s>[INST] {text} [/INST]"
    if role == "assistant":
        return f"{text}</s>"
    if role == "system":
        return f"<<SYS>>{text}<</SYS>>"
    return f"[ROLE {escape(role)}]{text}[/ROLE]"


SHORT = 2_000  # characters of turns that are remembered, since each is rendered again with every longer prefix
REMEMBERED = 8_192
_remembered: dict[Turn, str] = {}


def bracket_template(turns: list[Turn]) -> str:
    """Instruction marks around what is asked, an end mark after what is answered."""
    out = []
    for turn in turns:
        shown = _remembered.get(turn)
        if shown is None:
            shown = _marked(*turn)
            if len(shown) < SHORT:
                if len(_remembered) >= REMEMBERED:
                    _remembered.clear()
                _remembered[turn] = shown
        out.append(shown)
    return "".join(out)


_MARKS = re.compile(
    r"<s>\[INST\] (?P<user>[^<\[]*) \[/INST\]|<<SYS>>(?P<system>[^<\[]*)<</SYS>>"
    r"|\[ROLE (?P<role>[^<\[\]]*)\](?P<other>[^<\[]*)\[/ROLE\]|(?P<assistant>[^<\[]*)</s>"
)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that ``bracket_template`` made."""
    turns, at = [], 0
    while at < len(formatted):
        m = _MARKS.match(formatted, at)
        if not m:
            raise ValueError(f"no mark at {at}")
        kind = m.lastgroup
        turns.append((unescape(m["role"]), unescape(m["other"])) if kind == "other" else (kind, unescape(m[kind])))
        at = m.end()
    return turns


def _common(a: str, b: str, likely: int) -> int:
    """How many characters both begin with, found by halving what is open; ``likely`` of them are tried first."""
    high = min(len(a), len(b))
    low = min(likely, high)
    low = low if a[:low] == b[:low] else 0
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(turns: list[Turn], template: Template, learn: str = "assistant"):
    """(formatted, turn spans, loss spans, turn at which history was rewritten or None)."""
    before, spans, loss = template([]), [], []
    for k, (role, text) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            return template(turns), [], [], k
        if role == learn:
            one, two = (template([*turns[:k], (role, probe)]) for probe in "01")
            head = _common(one, two, len(before))
            tail = len(one) - head - 1
            if one[head + 1 :] != two[head + 1 :] or now[:head] != one[:head] or not now.endswith(one[head + 1 :]):
                return template(turns), [], [], k
            loss.append((head, len(now) - tail))
        spans.append((len(before), len(now)))
        before = now
    return before, spans, loss, None


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("turn_spans", SPANS), T.StructField("loss_spans", SPANS),
    T.StructField("rewritten_at", T.IntegerType()),
])


def _format(template: Template, learn: str, target: int = 8 << 20):
    schema = to_arrow_schema(SCHEMA)

    def record(conv, turns: list[Turn]) -> dict:
        formatted, spans, loss, broken = locate(turns, template, learn)
        pairs = lambda found: [{"start": a, "end": b} for a, b in found]
        return {"conv_id": conv, "formatted": formatted, "turn_spans": pairs(spans), "loss_spans": pairs(loss),
                "rewritten_at": broken}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns, rows, held = None, [], [], 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and conv != current:
                    rows.append(record(current, turns))
                    held += len(rows[-1]["formatted"])
                    turns = []
                    if held > target:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                current = conv
                turns.append((role, text))
        if turns:
            rows.append(record(current, turns))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def format_chats(conversations: DataFrame, template: Template = bracket_template, learn: str = "assistant") -> DataFrame:
    """One row per conversation: formatted text, span of each turn, spans under the loss mask, rewritten_at."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format(template, learn), SCHEMA))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = row["formatted"]
            turns = read_back(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in row["loss_spans"])
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append((row["conv_id"], len(turns), sha256(said.encode()).hexdigest(), len(loss),
                         sha256(loss.encode()).hexdigest(), len(text)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = zip(*rows) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                         names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from texts of ``bracket_template``: turns, and all text under the loss mask."""
    return formatted.mapInArrow(_digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                           "loss_sha256 string, formatted_chars long")
