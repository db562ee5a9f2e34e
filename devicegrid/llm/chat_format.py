"""Chat formatting: a finite-state machine over roles and a declarative template.

Main path: DataFrame functions only.  One shuffle brings the turns of a
conversation together; the machine is folded over the sorted turns with the
higher-order function ``aggregate``.

Defined results
* turns of a conversation are ordered by (turn, role, text); repeated rows are
  all kept, a null turn sorts first;
* a null text or role counts as empty, a null ``conv_id`` is a conversation of
  its own;
* a role order that the machine does not accept is still formatted, with
  ``valid`` false and ``bad_turn`` the 0-based turn at which it stopped
  (the number of turns if the conversation ends in a non-accepting state);
* an empty table gives an empty result; further columns are ignored.

A conversation is one record, as its digest and its formatted text are: it has
to fit into a row (Spark's limit is 2 GB), however many rows carry it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, escaping, loss roles and role order, all as data.

    ``control`` lists further strings that a text may not contain unescaped.
    ``transitions`` maps state -> role -> next state.
    """

    bos: str = "<s>"
    eos: str = "</s>"
    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    control: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accepting: tuple[str, ...] = ("user", "assistant")

    def controls(self) -> list[str]:
        marks = {self.bos, self.eos, self.turn_open, self.turn_close.rstrip("\n"), *self.control}
        return sorted(m for m in marks if m)

    def check(self) -> None:
        if any(c[0] in "&#;0123456789" or c[0].isalnum() for c in self.controls()):
            raise ValueError("a control string starts with a sign that no text can miss")
        if not all([self.start, *self.accepting, *(s for by_role in self.transitions.values() for s in by_role.values())]):
            raise ValueError("a state has a name")
        if self.role_end != "\n" or not self.turn_open or not self.turn_close:
            raise ValueError("a turn needs an opening and a closing mark, and its role ends with a line end")


DEFAULT = ChatTemplate()


def _entity(sign: str) -> str:
    return f"&#{ord(sign)};"


def escape(text: Column, template: ChatTemplate = DEFAULT) -> Column:
    """Escape so that no control string is left: ``&`` becomes ``&amp;``, and the
    first sign of every control string its character reference."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    rest: dict[str, list[str]] = {}
    for c in template.controls():
        rest.setdefault(c[0], []).append(c[1:])
    for sign, tails in sorted(rest.items()):
        ahead = "|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in tails)
        out = F.regexp_replace(out, rf"\{sign}(?=(?:{ahead}))", _entity(sign))
    return out


def unescape(text: Column, template: ChatTemplate = DEFAULT) -> Column:
    """The inverse of :func:`escape`."""
    out = text
    for sign in sorted({c[0] for c in template.controls()} | {"\n"}):
        out = F.replace(out, F.lit(_entity(sign)), F.lit(sign))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column, template: ChatTemplate) -> Column:
    return F.replace(escape(role, template), F.lit("\n"), F.lit(_entity("\n")))


def format_chats(turns: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, bad_turn, segments,
    formatted``.  ``segments`` is an array of (text, loss) whose texts, put one
    after the other, are ``formatted``; ``loss`` is true for the texts of the
    loss roles alone, not for their marks."""
    template.check()
    rows = turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    convs = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "text"))).alias("t"))

    moves = F.create_map(*[F.lit(x) for s, by_role in sorted(template.transitions.items())
                           for r, nxt in sorted(by_role.items()) for x in (f"{s}\n{r}", nxt)])

    def step(acc: Column, turn: Column) -> Column:
        # The empty state has stopped; bad counts the turns accepted before that.
        nxt = F.coalesce(F.element_at(moves, F.concat(acc["state"], F.lit("\n"), turn["role"])), F.lit(""))
        return F.struct(nxt.alias("state"), (acc["bad"] + F.when(nxt != "", 1).otherwise(0)).alias("bad"))

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("bad"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def marked(turn: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(template.turn_open), _escape_role(turn["role"], template), F.lit(template.role_end)), no),
            segment(escape(turn["text"], template), turn["role"].isin(*template.loss_roles)),
            segment(F.lit(template.turn_close), no),
        )

    segments = F.concat(F.array(segment(F.lit(template.bos), no)),
                        F.flatten(F.transform("t", marked)),
                        F.array(segment(F.lit(template.eos), no)))
    return (
        convs.withColumn("end", F.aggregate("t", begin, step))
        .select(
            "conv_id",
            F.size("t").cast("long").alias("n_turns"),
            F.col("end.state").isin(*template.accepting).alias("valid"),
            F.when(~F.col("end.state").isin(*template.accepting), F.col("end.bad")).alias("bad_turn"),
            segments.alias("segments"),
        )
        .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
    )


def parse_chats(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """Read the turns back from a formatted text: array of (role, text)."""
    def quoted(x: str) -> str:
        return re.sub(r"([^\w\s])", r"\\\1", x)

    turn = F.lit(f"(?s){quoted(template.turn_open)}([^\n]*)\n(.*?){quoted(template.turn_close)}")
    roles = F.regexp_extract_all(formatted, turn, F.lit(1))
    texts = F.regexp_extract_all(formatted, turn, F.lit(2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(
        unescape(r, template).alias("role"), unescape(t, template).alias("text")))
