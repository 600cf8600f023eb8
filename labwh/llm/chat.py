"""Chat formatting: a finite-state machine over roles, and a declarative template.

A template names the marks around a turn, the roles whose text is trained on, and the transitions
between roles. A conversation becomes a list of segments, each with a loss flag; their texts joined
are the formatted conversation. Control strings inside texts are escaped, so ``parse`` gives every
turn back. All of it is DataFrame code.

A conversation is one output row, so its turns meet in one task whatever their number; nothing else
is gathered there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.llm.common import pick

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """``opening`` role ``heading`` text ``closing`` is one turn. Marks start with a character that
    does not occur again in them and hold no backslash. ``transitions`` maps a state (a role, or
    ``start``) to the roles that may follow; states in ``final`` may end a conversation."""

    opening: str = "<turn>"
    heading: str = "\n"
    closing: str = "</turn>"
    separator: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for mark in (self.opening, self.closing):
            if not mark or ESCAPE in mark or mark[0] in mark[1:]:
                raise ValueError(f"not usable as a mark: {mark!r}")
        if not self.heading or ESCAPE in self.heading:
            raise ValueError(f"not usable as a heading: {self.heading!r}")

    @property
    def control(self) -> tuple[str, ...]:
        return self.opening, self.closing


def escape(text: Column, control: tuple[str, ...]) -> Column:
    """Backslashes doubled, the i-th control string replaced by a backslash and the i-th letter. No
    control string is left, and backslashes come in units of two characters."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for i, mark in enumerate(control):
        text = F.replace(text, F.lit(mark), F.lit(ESCAPE + chr(ord("a") + i)))
    return text


def unescape(text: Column, control: tuple[str, ...]) -> Column:
    """Undoes ``escape``: splitting at doubled backslashes keeps the units apart."""

    def restore(part: Column) -> Column:
        for i, mark in enumerate(control):
            part = F.replace(part, F.lit(ESCAPE + chr(ord("a") + i)), F.lit(mark))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), restore), ESCAPE)


def segments(turns: Column, template: ChatTemplate) -> Column:
    """Segments (text, loss) of sorted turns: three for each turn, the loss flag on the text of the
    trained roles only."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.flatten(F.transform(turns, lambda t: F.array(
        part(t["head"], F.lit(False)),
        part(t["body"], t["loss"]),
        part(F.lit(template.closing + template.separator), F.lit(False)),
    )))


def run_machine(roles: Column, template: ChatTemplate) -> Column:
    """Final state after all roles; ``reject`` from the first forbidden transition on."""
    allowed = [f"{a}\n{b}" for a, follows in template.transitions.items() for b in follows]
    return F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.when(F.concat_ws("\n", state, role).isin(*allowed), role).otherwise("reject"),
    )


def format_conversations(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, segments (text, loss), formatted, loss_spans, final_state and valid: one row per conversation.

    ``loss_spans`` is the loss mask of ``formatted``: start and length, in bytes of UTF-8, of each segment with
    the loss flag, in order. Rows are taken by turn; equal turns by role and text, NULL turns first. NULL role or
    text is empty. Rows with NULL conv_id are one conversation. Invalid turn orders are formatted as well
    and marked. Repeated rows are repeated turns. Texts of any length are taken whole; a conversation is
    one row, so it has to fit one. An empty table gives no rows. Extra columns are dropped.
    """
    names = template.control + (template.heading,)
    t = pick(rows, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.select(
        "*", F.concat(F.lit(template.opening), escape(F.col("role"), names), F.lit(template.heading)).alias("head"),
        escape(F.col("text"), template.control).alias("body"), F.col("role").isin(*template.loss_roles).alias("loss"))
    tail = len((template.closing + template.separator).encode())
    size = F.octet_length("head") + F.octet_length("body") + tail
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0).cast("long")))
    turns = F.sort_array(F.collect_list(F.struct("start", "role", "head", "body", "loss")))
    t = t.groupBy("conv_id").agg(turns.alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: F.struct(
        (x["start"] + F.octet_length(x["head"])).alias("start"), F.octet_length(x["body"]).cast("long").alias("length")))
    t = t.select("conv_id", segments(F.col("turns"), template).alias("segments"), spans.alias("loss_spans"),
                 run_machine(F.col("turns.role"), template).alias("final_state"))
    return t.select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"), "loss_spans", "final_state",
                    F.col("final_state").isin(*template.final).alias("valid"))


def under_mask(formatted: Column, spans: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped: ``formatted`` is cut at the spans, whatever roles its turns have."""
    raw = formatted.cast("binary")
    cut = F.transform(spans, lambda s: unescape(
        F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"), template.control))
    return F.array_join(cut, "")


def parse(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Reads ``formatted`` back: conv_id and turns (role, text, loss)."""
    names = template.control + (template.heading,)
    ending = template.closing + template.separator
    quoted = lambda s: "".join(rf"\x{{{ord(c):x}}}" for c in s)
    cut = F.split("formatted", quoted(template.opening))
    t = formatted.withColumn("pieces", F.slice(cut, 2, F.size(cut)))
    split = F.transform("pieces", lambda p: F.struct(
        unescape(F.substring_index(p, template.heading, 1), names).alias("role"),
        unescape(p.substr(
            F.locate(template.heading, p) + len(template.heading),
            F.length(p) - F.locate(template.heading, p) - len(template.heading) + 1 - len(ending),
        ), template.control).alias("text"),
    ))
    t = t.withColumn("split", split)
    return t.select(
        *[c for c in formatted.columns],
        F.transform("split", lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("text"),
            x["role"].isin(*template.loss_roles).alias("loss"))).alias("parsed"),
    )
