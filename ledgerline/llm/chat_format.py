"""Chat formatting: a finite-state machine checks the order of roles, a declarative template writes the text.

Only DataFrame expressions. A conversation is one output row, so all its turns meet in one row by nature;
there is no other grouping. Order of turns: ``turn``, then role, then text (ties and repeated rows all stay).
Null role or text counts as empty, a null ``turn`` sorts first, rows with a null conversation id form one
conversation. An empty table gives an empty result; columns other than the four named ones are ignored.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around turns, roles whose text counts for the loss, and the allowed order of roles."""

    begin: str = "<|begin_of_text|>"
    role_open: str = "<|start_header_id|>"
    role_close: str = "<|end_header_id|>\n\n"
    turn_close: str = "<|eot_id|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Strings that no role or text may hold as they are; those of other common templates are included.
    controls: tuple[str, ...] = (
        "<|begin_of_text|>",
        "<|start_header_id|>",
        "<|end_header_id|>",
        "<|eot_id|>",
        "<|im_start|>",
        "<|im_end|>",
        "<s>",
        "</s>",
        "[INST]",
        "[/INST]",
        "<<SYS>>",
        "<</SYS>>",
    )
    #: (state, role) -> next state; a pair that is not listed is an error.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("answered",)


def escaped(text: Column, template: ChatTemplate) -> Column:
    """Backslashes doubled; a single backslash then splits each control string after its first character."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in template.controls:
        out = F.replace(out, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return out


def unescaped(text: Column) -> Column:
    """Each backslash goes and the character after it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def role_state(roles: Column, template: ChatTemplate) -> Column:
    """The state after all roles; 'error' once a role comes out of turn."""
    moves = F.create_map(
        *[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}|{role}", to)]
    )
    return F.aggregate(
        roles,
        F.lit("start"),
        lambda state, role: F.coalesce(moves[F.concat(state, F.lit("|"), role)], F.lit("error")),
    )


def format_conversations(
    df: DataFrame,
    template: ChatTemplate | None = None,
    conv="conv_id",
    turn="turn",
    role="role",
    text="text",
) -> DataFrame:
    """conv_id, n_turns, state, valid, segments (text, loss) in order, and their concatenation ``formatted``.

    Every conversation is formatted; ``valid`` says whether its roles came in an allowed order and ended
    in an accepting state.
    """
    t = template or ChatTemplate()
    turns = df.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def plain(s):
        return F.struct(s.alias("text"), F.lit(False).alias("loss"))

    def segments_of(row):
        opening = F.concat(F.lit(t.role_open), escaped(row["role"], t), F.lit(t.role_close))
        body = F.struct(
            escaped(row["text"], t).alias("text"), row["role"].isin(*t.loss_roles).alias("loss")
        )
        return F.array(plain(opening), body, plain(F.lit(t.turn_close)))

    state = role_state(F.transform("rows", lambda r: r["role"]), t)
    out = ordered.select(
        "conv_id",
        F.size("rows").cast("long").alias("n_turns"),
        state.alias("state"),
        F.concat(F.array(plain(F.lit(t.begin))), F.flatten(F.transform("rows", segments_of))).alias(
            "segments"
        ),
    )
    return out.withColumns(
        {
            "valid": F.col("state").isin(*t.accepting),
            "formatted": F.array_join(F.transform("segments", lambda s: s["text"]), ""),
        }
    )


def read_back(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Array of (role, text) parsed from a formatted conversation."""
    t = template or ChatTemplate()
    body = F.substr(formatted, F.lit(len(t.begin) + 1))
    pieces = F.split(body, "\\Q" + t.turn_close + "\\E")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parsed(piece):
        head = F.instr(piece, t.role_close)
        start = len(t.role_open) + 1
        return F.struct(
            unescaped(F.substr(piece, F.lit(start), head - start)).alias("role"),
            unescaped(F.substr(piece, head + len(t.role_close))).alias("text"),
        )

    return F.transform(turns, parsed)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"])), "")


def conversation_digest(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Digests of what reads back from formatted conversations."""
    turns = read_back(F.col("formatted"), template)
    text = F.array_join(
        F.transform(turns, lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), ""
    )
    return formatted.withColumns(
        {"turns_text": text, "loss_text": loss_text(F.col("segments")), "back": F.size(turns)}
    ).select(
        "conv_id",
        F.col("back").cast("long").alias("n_turns"),
        F.sha2(F.col("turns_text"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
