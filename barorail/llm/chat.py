"""Chat formatting by a finite-state machine over roles, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"


@dataclass(frozen=True)
class ChatTemplate:
    """What a conversation looks like and which turn orders are in order.

    ``mark`` names the control strings: a turn is ``<mark role>\\n text \\n</mark>\\n``. ``moves`` maps
    (state, role) to the next state; every other role leads to a dead state. ``ends`` are the states a
    whole conversation may end in. The texts of ``loss_roles`` are what a model is trained to write.
    """

    mark: str = "turn"
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
    )
    ends: tuple[str, ...] = ("system", "user", "assistant")
    loss_roles: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        """Put one backslash behind the ``<`` of whatever looks like a control string, escaped or not."""
        return F.regexp_replace(text, rf"<(\\*)(/?{self.mark})", r"<\\$1$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"<\\(\\*)(/?{self.mark})", "<$1$2")

    def opening(self, role: Column) -> Column:
        return F.concat(F.lit(f"<{self.mark} "), _quote(role), F.lit(">\n"))

    @property
    def closing(self) -> str:
        return f"\n</{self.mark}>\n"

    def next_state(self, state: Column, role: Column) -> Column:
        step = F.lit(ERROR)
        for at, by, to in self.moves:
            step = F.when((state == at) & (role == by), F.lit(to)).otherwise(step)
        return step


def _quote(role: Column) -> Column:
    quoted = F.replace(role, F.lit("%"), F.lit("%25"))
    quoted = F.replace(quoted, F.lit(">"), F.lit("%3E"))
    return F.replace(quoted, F.lit("\n"), F.lit("%0A"))


def _unquote(role: Column) -> Column:
    plain = F.replace(role, F.lit("%0A"), F.lit("\n"))
    plain = F.replace(plain, F.lit("%3E"), F.lit(">"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, segments, formatted.

    Turns are ordered by (turn, role, text), NULL first; equal rows are turns of their own. A NULL role
    or text counts as empty, an empty role as out of order. A NULL conv_id is a conversation like any
    other; an empty table gives no rows. Other columns are ignored. ``segments`` is an array of (text,
    loss), whose texts joined are ``formatted``. ``valid`` says whether the machine accepts the roles;
    conversations out of order are formatted too, since dropping them is for the caller to decide.

    A conversation is one training example and so one row.
    """
    listed = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("_turns"))

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(template.opening(t["role"]).alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
        )

    state = F.aggregate("_turns", F.lit(template.start), lambda s, t: template.next_state(s, t["role"]))
    return chats.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        state.isin(*template.ends).alias("valid"),
        F.flatten(F.transform("_turns", segments)).alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns, an array of (role, text), found in a formatted text."""
    turn = rf"(?s)<{template.mark} ([^>]*)>\n(.*?){template.closing}"
    return F.zip_with(
        F.regexp_extract_all(formatted, F.lit(turn), F.lit(1)),
        F.regexp_extract_all(formatted, F.lit(turn), F.lit(2)),
        lambda role, text: F.struct(_unquote(role).alias("role"), template.unescape(text).alias("text")),
    )


def read_loss(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: template.unescape(s["text"])), "")


def chat_digests(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Format, read back, and digest what was read."""
    chats = format_chats(turns, template)
    read = chats.select(
        "conv_id",
        "valid",
        "formatted",
        read_turns(F.col("formatted"), template).alias("_read"),
        read_loss(F.col("segments"), template).alias("_loss"),
    )
    said = F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
