"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """headers open a turn, end closes it. Roles without a header get `other`, their bytes in hexadecimal and ": ".

    transitions[state] lists the roles that may follow and the state they lead to; a conversation is
    valid if it stops in an accepting state. Only texts of loss_roles carry loss.
    """

    headers: Mapping[str, str] = field(
        default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
    )
    other: str = "### Role "
    mark: str = "### "
    end: str = "</turn>"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    accepting: tuple[str, ...] = ("assistant",)

    def header(self, role: Column) -> Column:
        out = F.concat(F.lit(self.other), F.hex(role), F.lit(": "))
        for name, text in self.headers.items():
            out = F.when(role == name, F.lit(text)).otherwise(out)
        return out

    def escaped(self, text: Column) -> Column:
        """Without mark and end: a backslash becomes two, mark becomes \\m and end \\e."""
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(text, F.lit(self.mark), F.lit("\\m")), F.lit(self.end), F.lit("\\e"))

    def unescaped(self, text: Column) -> Column:
        plain = lambda p: F.replace(F.replace(p, F.lit("\\e"), F.lit(self.end)), F.lit("\\m"), F.lit(self.mark))
        return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")

    def next_state(self, state: Column, role: Column) -> Column:
        out = F.lit("error")
        for before, moves in self.transitions.items():
            for name, after in moves.items():
                out = F.when((state == before) & (role == name), F.lit(after)).otherwise(out)
        return out


def formatted(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, segments (text, loss), formatted.

    Turns are ordered by turn, then role, then text, nulls first; a null text or role counts as empty.
    A conversation that breaks the turn order is formatted all the same, with valid false. Columns
    other than conv_id, turn, role and text are ignored. A conversation is one training example and
    so one row; it must fit in a task.
    """
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    turns = F.sort_array(F.collect_list(F.struct("turn", role, text))).alias("turns")
    grouped = conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(turns)

    def parts(t: Column) -> Column:
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(template.header(t["role"]), F.lit(False)),
            piece(template.escaped(t["text"]), t["role"].isin(list(template.loss_roles))),
            piece(F.lit(template.end + "\n"), F.lit(False)),
        )

    state = F.aggregate("turns", F.lit("start"), lambda s, t: template.next_state(s, t["role"]))
    out = grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        state.isin(list(template.accepting)).alias("valid"),
        F.flatten(F.transform("turns", parts)).alias("segments"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parsed(text: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation."""
    names = {header: role for role, header in template.headers.items()}
    pattern = "^(?:" + "|".join([rf"\Q{h}\E" for h in names] + [rf"\Q{template.other}\E([0-9A-F]*): "]) + ")"

    def turn(piece: Column) -> Column:
        head = F.regexp_extract(piece, pattern, 0)
        role = F.unhex(F.regexp_extract(piece, pattern, 1)).cast("string")
        for header, name in names.items():
            role = F.when(head == header, F.lit(name)).otherwise(role)
        body = F.substring(piece, F.char_length(head) + 1, F.char_length(piece))
        return F.struct(role.alias("role"), template.unescaped(body).alias("text"))

    pieces = F.split(text, rf"\Q{template.end}\E\n", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescaped(s["text"])), "")


def digests(output: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from formatted(): turns and loss text as digests and lengths."""
    turns = F.transform(parsed(F.col("formatted"), template), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = output.withColumns({"_turns": turns, "_loss": loss_text(F.col("segments"), template)})
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_turns", ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
