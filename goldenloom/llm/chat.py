"""Chat formatting (12): a declarative template, and a finite-state machine over roles.

Each turn becomes three segments: an opening with its role, the escaped text, and a closing; only the text of a trained role
bears the loss flag. Escaping doubles backslashes and puts one into each control string after its first character, so
that no control string stands in an escaped text and removing each backslash (keeping the second of two) restores it. The
machine reads the roles in turn order and names the first turn that the template has no transition for."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """names: roles and how they are written; any other role is written as itself after a `~`. transitions: by state the
    roles that may follow; a role is the state after it. A conversation may end in any of `final`."""

    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    opening: str = "### "
    after_name: str = ": "
    closing: str = "</turn>\n"
    trained: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: tuple[str, ...] = ("user", "assistant")

    def __post_init__(self):
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("a control string needs two characters and no backslash")
        if any(c.startswith(c[k:]) for c in (self.closing, self.after_name) for k in range(1, len(c))):
            raise ValueError("closing and after_name must not end as they begin")
        written = list(self.names.values())
        if len(set(written)) < len(written) or any(w.startswith("~") or self.after_name in w or self.closing in w for w in written):
            raise ValueError("role names must differ, hold no control string and not start with ~")

    @property
    def controls(self) -> list[str]:
        return [self.opening.strip(), self.closing.strip(), self.after_name]


def escape(text: Column, controls: list[str]) -> Column:
    """The text without any of the control strings (two characters or more, no backslash), see unescape()."""
    inside = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(inside), F.lit("$0\\\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def _lookup(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate(), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, n_turns, segments array<struct<text, loss>>, valid, bad_turn): a conversation's output is its segments' texts,
    one after another. bad_turn is the place, from 0, of the first turn whose role may not stand there, n_turns if the
    conversation may not end where it does, else null; valid if there is none. Invalid conversations are formatted too.

    Rows stand by turn (null first), then role and formatted text; repeated rows are turns of their own. A null text is
    empty, a null role is the empty role; a null id is a conversation as any other. Other columns are ignored; an empty
    table gives an empty one. Texts are escaped row by row before they meet; a conversation then is one value, as it is one
    document, and must fit Spark's limit for a value (2 GB)."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.try_element_at(_lookup(template.names), role), F.concat(F.lit("~"), escape(role, template.controls)))
    narrow = turns.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.col(turn_col).alias("turn"), role.alias("role"), escape(text, template.controls[:2]).alias("text"),
            F.concat(F.lit(template.opening), name, F.lit(template.after_name)).alias("opening"),
        ).alias("t"),
    )
    grouped = narrow.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    legal = _lookup({f"{state}\n{r}": r for state, roles in template.transitions.items() for r in roles})

    def step(at: Column, t: Column) -> Column:
        to = F.try_element_at(legal, F.concat(at["state"], F.lit("\n"), t["role"]))
        return F.struct(F.coalesce(to, t["role"]).alias("state"), (at["n"] + 1).alias("n"), F.when(at["bad"].isNull() & to.isNull(), at["n"]).otherwise(at["bad"]).alias("bad"))

    def end(at: Column) -> Column:
        return F.coalesce(at["bad"], F.when(~at["state"].isin(*template.final), at["n"]))

    start = F.struct(F.lit("").alias("state"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bad"))

    def three(t: Column) -> Column:
        parts = ((t["opening"], F.lit(False)), (t["text"], t["role"].isin(*template.trained)), (F.lit(template.closing), F.lit(False)))
        return F.array(*(F.struct(a.alias("text"), b.alias("loss")) for a, b in parts))

    out = grouped.select(F.col("id").alias(id_col), F.size("ts").cast("long").alias("n_turns"), F.flatten(F.transform("ts", three)).alias("segments"), F.aggregate("ts", start, step, end).alias("bad_turn"))
    return out.withColumn("valid", F.col("bad_turn").isNull())


def written(segments: Column) -> Column:
    """The formatted text."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def trained_text(segments: Column) -> Column:
    """All text under the loss flags, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of a formatted text, as array<struct<role, text>>; null for a text that the template did not make."""
    back = _lookup({v: k for k, v in template.names.items()})
    skip, mark = len(template.opening), len(template.after_name)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit(template.after_name))
        name = F.substring(piece, F.lit(skip + 1), at - (skip + 1))
        return F.struct(F.coalesce(F.try_element_at(back, name), unescape(F.substring(name, F.lit(2), F.length(name)))).alias("role"), unescape(F.substring(piece, at + mark, F.length(piece))).alias("text"))

    pieces = F.split(formatted, re.escape(template.closing).replace("\\\n", "\\n"))
    good = formatted.endswith(F.lit(template.closing)) | (formatted == "")
    return F.when(good, F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn))
