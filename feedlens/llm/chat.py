"""Chat formatting: conversations of typed content parts as one marked-up string, with attachments and a loss mask.

A message is a list of parts: text, image, audio or document. A *visitor* has one
method per type, each of which gives a part's place in the string (the escaped
text, or one placeholder), and how many tokens it stands for once a model
expands it. The visitor works on columns: what its methods return is compiled
into one ``CASE`` per part, so formatting is a plan of Spark expressions only.

Turns are put between control strings of a template. Texts may hold the same
strings: a backslash goes behind the first character of each, and before each
backslash that was there, so no control string occurs inside a text and taking
every backslash off again gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One part of a message. ``ref`` names an attachment; ``width`` and ``height`` are pixels of an image,
#: ``seconds`` the length of a recording, ``pages`` those of a document.
PART = "struct<type: string, text: string, ref: string, width: bigint, height: bigint, seconds: double, pages: bigint>"
ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings: what opens and closes a turn of a role, and the placeholder of each kind of attachment.

    Other roles are named in the string itself, between ``role_open`` and
    ``role_close``. A control string must not hold the escape character, must not
    be empty, and no text followed by one that closes it may look like another
    control string; the constructor checks that.
    """

    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")})
    role_open: str = "[ROLE]"
    role_close: str = "[/ROLE]"
    turn_close: str = "[/TURN]"
    placeholders: dict[str, str] = field(default_factory=lambda: {
        "image": "<image>", "audio": "<audio>", "document": "<document>"})

    def __post_init__(self):
        for c in self.controls:
            if not c or ESCAPE in c:
                raise ValueError(f"a control string must not be empty or hold {ESCAPE!r}: {c!r}")
            for after in self.controls:
                for k in range(1, len(c)):
                    if after.startswith(c[k:]) or c[k:].startswith(after):
                        raise ValueError(f"{c[:k]!r} before {after!r} would read as {c!r}")

    @property
    def controls(self) -> list[str]:
        return sorted({*(c for pair in self.turns.values() for c in pair), self.role_open, self.role_close,
                       self.turn_close, *self.placeholders.values()}, key=lambda c: (-len(c), c))

    def escape(self, text: Column) -> Column:
        """The text with every control string broken up."""
        start = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
        return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), self.controls, start)

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def opening(self, role: Column) -> Column:
        other = F.concat(F.lit(self.role_open), self.escape(role), F.lit(self.role_close))
        return reduce(lambda c, r: F.when(role == r, F.lit(self.turns[r][0])).otherwise(c), self.turns, other)

    def closing(self, role: Column) -> Column:
        return reduce(lambda c, r: F.when(role == r, F.lit(self.turns[r][1])).otherwise(c), self.turns,
                      F.lit(self.turn_close))

    @property
    def turn_pattern(self) -> str:
        """A regular expression that finds the turns of a formatted string, one after the other."""
        pairs = [*self.turns.values(), (self.role_open, self.turn_close)]
        return "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in pairs)

    def role_of(self, turn: Column) -> Column:
        """The role of one turn's string."""
        named = F.regexp_extract(turn, f"(?s)^{re.escape(self.role_open)}(.*?){re.escape(self.role_close)}", 1)
        return reduce(lambda c, r: F.when(F.startswith(turn, F.lit(self.turns[r][0])), F.lit(r)).otherwise(c), self.turns,
                      self.unescape(named))

    def body_of(self, turn: Column) -> Column:
        """What stands between the control strings of one turn's string, still escaped."""
        heads = [re.escape(a) for a, _ in self.turns.values()]
        heads.append(f"{re.escape(self.role_open)}.*?{re.escape(self.role_close)}")
        tails = [re.escape(b) for _, b in self.turns.values()] + [re.escape(self.turn_close)]
        return F.regexp_extract(turn, f"(?s)^(?:{'|'.join(heads)})(.*)(?:{'|'.join(tails)})$", 1)


@dataclass(frozen=True)
class PartVisitor:
    """What each kind of part becomes: its piece of the string and its number of tokens after expansion.

    Images count their tiles of ``tile`` pixels a side, recordings ``per_second``
    tokens a second, documents ``per_page`` a page, attachments without a size one
    token. Texts count runs of letters, runs of digits and other visible characters.
    """

    template: Template = Template()
    tile: int = 28
    per_second: float = 25.0
    per_page: int = 576

    def text(self, part: Column) -> tuple[Column, Column]:
        whole = F.coalesce(part["text"], F.lit(""))
        return self.template.escape(whole), F.regexp_count(whole, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")).cast("long")

    def image(self, part: Column) -> tuple[Column, Column]:
        tiles = F.ceil(part["width"] / self.tile) * F.ceil(part["height"] / self.tile)
        return F.lit(self.template.placeholders["image"]), tiles

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.template.placeholders["audio"]), F.ceil(part["seconds"] * self.per_second)

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.template.placeholders["document"]), part["pages"] * self.per_page

    def visit(self, part: Column) -> Column:
        """A struct of the part's string, token count and attachment kind (null for text); other types are read as text."""
        piece, tokens = self.text(part)
        kind = F.lit(None).cast("string")
        for name in self.template.placeholders:
            held, size = getattr(self, name)(part)
            piece = F.when(part["type"] == name, held).otherwise(piece)
            tokens = F.when(part["type"] == name, F.greatest(F.coalesce(size, F.lit(1)), F.lit(1))).otherwise(tokens)
            kind = F.when(part["type"] == name, F.lit(name)).otherwise(kind)
        return F.struct(piece.alias("piece"), tokens.cast("long").alias("tokens"), kind.alias("kind"),
                        part["ref"].alias("ref"))


def text_parts(text: Column) -> Column:
    """The parts of a message that is a text and nothing else."""
    null = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("type"), text.cast("string").alias("text"), null.cast("string").alias("ref"),
        null.cast("bigint").alias("width"), null.cast("bigint").alias("height"), null.cast("double").alias("seconds"),
        null.cast("bigint").alias("pages")))


def format_messages(messages: DataFrame, visitor: PartVisitor = PartVisitor(), id_col: str = "conv_id",
                    turn_col: str = "turn", role_col: str = "role", parts: Column | None = None,
                    text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, markup, body_at, body_chars, n_tokens, attachments), one row for each message.

    ``markup`` is the turn's string, its body the ``body_chars`` code points from
    ``body_at`` (from 0) on. ``attachments`` are (part, kind, ref, n_tokens) in the
    order of their placeholders.
    """
    t = visitor.template
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    given = F.coalesce(parts if parts is not None else text_parts(F.col(text_col)), F.array().cast(f"array<{PART}>"))
    rows = messages.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           role.alias("role"), F.transform(given, visitor.visit).alias("visited"))
    rows = rows.select("conv_id", "turn", "role", F.array_join("visited.piece", "").alias("body"),
                       t.opening(F.col("role")).alias("head"), t.closing(F.col("role")).alias("tail"),
                       F.aggregate("visited.tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens"),
                       F.filter(F.transform("visited", lambda v, i: F.struct(
                           i.alias("part"), v["kind"].alias("kind"), v["ref"].alias("ref"), v["tokens"].alias("n_tokens"))),
                           lambda a: a["kind"].isNotNull()).alias("attachments"))
    return rows.select("conv_id", "turn", "role", F.concat("head", "body", "tail").alias("markup"),
                       F.char_length("head").alias("body_at"), F.char_length("body").alias("body_chars"), "n_tokens",
                       "attachments")


def format_conversations(messages: DataFrame, visitor: PartVisitor = PartVisitor(),
                         learned: tuple[str, ...] = ("assistant",), **columns) -> DataFrame:
    """(conv_id, formatted, spans, n_tokens, attachments), one row for each conversation.

    ``formatted`` is the conversation's string. ``spans`` has one entry per turn:
    (start, length) of the turn's markup and (loss_start, loss_length) of what the
    model learns to say there, in code points of the string from 0; turns of other
    roles than ``learned`` have nulls there. ``attachments`` are (turn, part, kind,
    ref, n_tokens), turns numbered from 0 by their place.

    Turns are ordered by turn, role and markup, so equal or null turn numbers give
    one result; repeated rows are repeated turns. Rows with a null conv_id are one
    conversation. A null role is an empty one, a null text or list of parts is
    empty; long texts stay whole. An empty table gives an empty result, other
    columns are left out. Markup is made before the shuffle, row by row; only a
    conversation's own turns meet, since they are one value of the result (of 2 GB at most).
    """
    rows = format_messages(messages, visitor, **columns)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "markup")
    end = F.sum(F.char_length("markup").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumns({"no": F.row_number().over(order) - 1, "at": end - F.char_length("markup")})
    body = F.when(F.col("role").isin(*learned), F.col("at") + F.col("body_at"))
    turn = F.struct("no", F.col("at").alias("start"), F.char_length("markup").cast("long").alias("length"),
                    body.alias("loss_start"), F.when(body.isNotNull(), F.col("body_chars").cast("long")).alias("loss_length"),
                    "markup", "n_tokens", F.transform("attachments", lambda a: F.struct(
                        F.col("no").alias("turn"), a["part"], a["kind"], a["ref"], a["n_tokens"])).alias("attachments"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id", F.array_join("turns.markup", "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"], t["length"], t["loss_start"], t["loss_length"])).alias("spans"),
        F.aggregate("turns.n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n_tokens"),
        F.flatten("turns.attachments").alias("attachments"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turns, learned) of ``format_conversations``: role and text of each turn, and the text under the loss mask.

    The string alone gives the turns; the mask is cut out of each turn's string,
    so reading takes time in proportion to the string. Attachments are read as
    their placeholders.
    """
    found = formatted.select("conv_id", "formatted", "spans", F.regexp_extract_all(
        "formatted", F.lit(template.turn_pattern), F.lit(0)).alias("strings"))
    says: Callable[[Column], Column] = lambda s: F.struct(
        template.role_of(s).alias("role"), template.unescape(template.body_of(s)).alias("text"))
    mask = F.filter(F.arrays_zip("strings", "spans"), lambda z: z["spans"]["loss_start"].isNotNull())
    masked = F.transform(mask, lambda z: template.unescape(F.substring(
        z["strings"], (z["spans"]["loss_start"] - z["spans"]["start"] + 1).cast("int"),
        z["spans"]["loss_length"].cast("int"))))
    return found.select("conv_id", "formatted", F.transform("strings", says).alias("turns"),
                        F.array_join(masked, "").alias("learned"))


def chat_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation the number of turns, and digests of its turns and of the text under the loss mask, as read back."""
    back = read_back(formatted, template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("learned").cast("long").alias("loss_chars"),
                       F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


#: What the control conversation says: strings that mark turns.
CONTROL_ID, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def with_control_conversation(messages: DataFrame) -> DataFrame:
    """The messages and one conversation more, whose two turns hold control strings."""
    columns = {f.name: F.lit(None).cast(f.dataType) for f in messages.schema.fields}
    columns |= {"conv_id": F.lit(CONTROL_ID), "turn": F.col("id"), "text": F.lit(CONTROL_TEXT),
                "role": F.when(F.col("id") == 0, "user").otherwise("assistant")}
    control = messages.sparkSession.range(0, 2, 1, 1).select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in messages.schema.fields))
    return messages.unionByName(control)
