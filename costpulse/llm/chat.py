"""Chat formatting: a finite-state machine over roles and a declarative template.

All of it is DataFrame functions. Turns are gathered per conversation in the order (turn, role,
text); a null role or text counts as empty, a null turn sorts first, repeated rows are turns of
their own, and rows with a null conversation id are one conversation.

* ``Template.moves`` is the machine: state -> role -> next state. ``valid`` tells whether the
  roles lead from the start to an accepting state, ``error_turn`` the first turn (from 0)
  that has no move (null if none). Invalid conversations are formatted all the same.
* Every turn becomes three segments: its opening (never learned), its text (learned where the
  template says so for the role) and its closing (never learned).
* Control strings inside texts and roles are broken up by ``ESC`` + ``c`` after their first
  character, and ``ESC`` itself becomes ``ESC`` + ``s``; a line break in a role becomes ``ESC`` + ``n``.
  No text can therefore open or close a turn, and ``unescape`` restores it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESC = "\ue000"


@dataclass(frozen=True)
class Template:
    """How turns are written. ``controls``: every string with a meaning to a reader of the
    output, the template's own and those of common other formats."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    learn: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]",
                                 "<<SYS>>", "<</SYS>>", "<s>", "</s>")
    start: str = "start"
    accept: tuple[str, ...] = ("answered",)
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })


CHATML = Template()


def escape(text: Column, template: Template = CHATML) -> Column:
    out = F.replace(text, F.lit(ESC), F.lit(ESC + "s"))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESC + "c" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit(ESC + "n"), F.lit("\n"))
    return F.replace(F.replace(out, F.lit(ESC + "c"), F.lit("")), F.lit(ESC + "s"), F.lit(ESC))


def _machine(roles: Column, template: Template) -> Column:
    """struct(state, n, error): state empty once a role has no move."""
    moves = F.create_map(*[F.lit(x) for state, by_role in template.moves.items()
                           for role, to in by_role.items() for x in (state + "\n" + role, to)])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n"),
                     F.lit(None).cast("int").alias("error"))

    def move(at: Column, role: Column) -> Column:
        to = F.try_element_at(moves, F.concat(at["state"], F.lit("\n"), role))
        return F.struct(F.coalesce(to, F.lit("")).alias("state"), (at["n"] + 1).alias("n"),
                        F.when(at["error"].isNull() & to.isNull(), at["n"])
                        .otherwise(at["error"]).alias("error"))

    return F.aggregate(roles, begin, move)


def format_conversations(turns: DataFrame, template: Template = CHATML, key: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, valid, error_turn, segments array<struct<text, loss>>, formatted) per conversation;
    ``formatted`` is the segments' texts joined. Empty table: no rows."""
    rows = turns.select(
        F.col(key).alias("_key"), F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("_turn"))
    talks = rows.groupBy("_key").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    def written(t: Column) -> Column:
        name = F.replace(escape(t["role"], template), F.lit("\n"), F.lit(ESC + "n"))
        opening = F.concat(F.lit(template.open), name, F.lit(template.after_role))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"),
                     t["role"].isin(*template.learn).alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))

    ended = _machine(F.transform("_turns", lambda t: t["role"]), template)
    made = talks.select(F.col("_key").alias(key), ended.alias("_end"),
                        F.flatten(F.transform("_turns", written)).alias("segments"))
    return made.select(
        key, F.coalesce(F.col("_end.state").isin(*template.accept), F.lit(False)).alias("valid"),
        F.col("_end.error").alias("error_turn"), "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"))


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation."""
    pieces = F.split(formatted, "\\Q" + template.open + "\\E", -1)

    def turn(piece: Column) -> Column:
        name = F.substring_index(piece, template.after_role, 1)
        begin = F.length(name) + F.lit(len(template.after_role) + 1)
        body = F.substring(piece, begin, F.length(piece) - begin + F.lit(1 - len(template.close)))
        return F.struct(unescape(name).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """The learned texts of a conversation as they were written, joined without separator."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
