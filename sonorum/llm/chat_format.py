"""Chat formatting as a finite-state machine over roles.

A declarative template names the pieces of a turn, the control strings, the roles that carry loss
and the machine: its states, the moves that a role makes between them, and the states where a
conversation may end. Control strings inside texts are replaced by escape codes that the template
gives, so none is left in a text, and the formatted text reads back to exactly the turns that went in.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import read_table

#: Begins every escape code, and the code of itself.
ESCAPE, ESCAPED = "\\", "\\e"


@dataclass(frozen=True)
class Template:
    """A turn is opening, the role's name, colon, the escaped text, footer.

    names: role -> name; a role without one is written escaped after `=`. controls: strings that no
    text may hold; where none are given, the opening and the footer without white space around. The
    footer must hold one. moves: (state, role, next state); a state is any string. At most 20
    controls. A template whose turns could not be told apart is an error.
    """

    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    opening: str = "### "
    colon: str = ": "
    footer: str = " </turn>\n"
    controls: tuple[str, ...] = ()
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"), ("start", "user", "asked"), ("ready", "user", "asked"),
        ("asked", "assistant", "answered"), ("answered", "user", "asked"),
    )
    ends: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        if not self.controls:
            object.__setattr__(self, "controls", tuple(dict.fromkeys(x.strip() for x in (self.opening, self.footer) if x.strip())))
        if any(ESCAPE in x for x in (self.opening, self.colon, self.footer, *self.names.values(), *self.controls)):
            raise ValueError("no piece can hold the escape character")
        if not self.colon or not all(self.controls) or not 0 < len(self.controls) <= 20 or not any(c in self.footer for c in self.controls):
            raise ValueError("the colon can't be empty, and the footer must hold one of up to 20 control strings")
        if len(set(self.names.values())) < len(self.names) or any(n.startswith("=") or self.colon in n + self.colon[:-1] for n in self.names.values()):
            raise ValueError("names must differ, not begin with = and not hold the colon")
        for c in (*self.controls, self.colon):
            after = (self.colon,) if c == self.colon else (self.colon, self.footer)
            if any(piece.startswith(c[k:]) for piece in after for k in range(1, len(c))):
                raise ValueError(f"a text could end in the begin of {c!r} and what follows be the rest")
        for c in self.controls:
            if any(piece.endswith(c[:k]) for piece in (f"{self.opening}=", self.colon) for k in range(1, len(c))):
                raise ValueError(f"a text could begin with the end of {c!r} and what comes before be the rest")
        for name in ("=", *self.names.values()):
            if (self.opening + name + self.colon + self.footer).find(self.footer) < len(self.opening + name + self.colon):
                raise ValueError("the footer can't be in the header")

    def codes(self) -> list[tuple[str, str]]:
        """(control string, escape code), in the order of escaping."""
        return [(ESCAPE, ESCAPED), *((c, f"{ESCAPE}{chr(ord('f') + k)}") for k, c in enumerate(self.controls))]


CHAT = Template()


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, template: Template = CHAT) -> Column:
    """Reversible: afterwards the text holds no control string of the template."""
    return _replaced(text, template.codes())


def unescape(text: Column, template: Template = CHAT) -> Column:
    return _replaced(text, [(code, control) for control, code in reversed(template.codes())])


def _role_codes(template: Template) -> list[tuple[str, str]]:
    """Roles must not hold the colon either."""
    return [*template.codes(), (template.colon, f"{ESCAPE}d")]


def _header(role: Column, template: Template) -> Column:
    name = F.concat(F.lit("="), _replaced(role, _role_codes(template)))
    for known, shown in template.names.items():
        name = F.when(role == known, F.lit(shown)).otherwise(name)
    return F.concat(F.lit(template.opening), name, F.lit(template.colon))


def _role(name: Column, template: Template) -> Column:
    role = _replaced(F.substring(name, 2, 1 << 30), [(code, plain) for plain, code in reversed(_role_codes(template))])
    for known, shown in template.names.items():
        role = F.when(name == shown, F.lit(known)).otherwise(role)
    return role


def format_chats(rows: DataFrame, template: Template = CHAT, conv_col: str = "conv_id") -> DataFrame:
    """One row for each conversation: conv_id, n_turns, segments array<struct<text, loss>>, valid, bad_turn.

    rows: conv_id, turn, role, text (other columns are not read). Turns are in order of turn, null
    first, then of role and text, so ties and repeated rows have one order; repeated rows are
    repeated turns. A null role or text counts as empty; all rows with a null conv_id are one
    conversation; an empty table gives no conversation. valid: the machine has a move for every turn
    and stands in an end after the last; bad_turn is the first place (from 0) without a move, or
    null. Invalid conversations are formatted all the same. Roles and texts may have any length; a
    conversation is one row, so its length is bounded by what a row holds.
    """
    turns = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def moved(state: Column, role: Column) -> Column:
        """The next state, or null."""
        found = F.lit(None).cast("string")
        for before, by, after in reversed(template.moves):
            found = F.when((state == before) & (role == by), F.lit(after)).otherwise(found)
        return found

    def step(at: Column, turn: Column) -> Column:
        after = moved(at["state"], turn["role"])
        stopped = at["bad"].isNotNull()
        return F.struct(
            F.when(stopped, at["state"]).otherwise(F.coalesce(after, at["state"])).alias("state"), (at["k"] + 1).alias("k"),
            F.when(stopped, at["bad"]).when(after.isNull(), at["k"]).alias("bad"),
        )

    began = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("k"), F.lit(None).cast("int").alias("bad"))

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(_header(t["role"], template).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.footer).alias("text"), F.lit(False).alias("loss")),
        )

    ran = turns.withColumn("ran", F.aggregate("turns", began, step))
    return ran.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        (F.col("ran.bad").isNull() & F.col("ran.state").isin(*template.ends)).alias("valid"),
        F.col("ran.bad").alias("bad_turn"),
    )


def joined(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_mask(segments: Column) -> Column:
    """The loss flags over the formatted text, as array<struct<skip, take>>: for each turn, so many characters without loss and then so many with it."""
    n = F.floor(F.size(segments) / 3).cast("int")
    turns = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def span(k: Column) -> Column:
        text = F.get(segments, 3 * k + 1)
        return F.struct(F.length(F.get(segments, 3 * k)["text"]).alias("skip"), F.when(text["loss"], F.length(text["text"])).otherwise(0).alias("take"))

    return F.transform(turns, span)


def _pieces(formatted: Column, template: Template) -> Column:
    pieces = F.split(formatted, f"\\Q{template.footer}\\E")
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def parse_chats(formatted: Column, template: Template = CHAT) -> Column:
    """The turns of a formatted text as array<struct<role, text>>; the inverse of formatting."""

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(template.opening) + 1, 1 << 30)
        name = F.substring_index(rest, template.colon, 1)
        text = rest.substr(F.length(name) + (len(template.colon) + 1), F.lit(1 << 30))
        return F.struct(_role(name, template).alias("role"), unescape(text, template).alias("text"))

    return F.transform(_pieces(formatted, template), turn)


def masked_text(formatted: Column, mask: Column, template: Template = CHAT) -> Column:
    """What the mask marks in the formatted text, unescaped, nothing between."""
    taken = F.zip_with(_pieces(formatted, template), mask, lambda piece, m: unescape(piece.substr(m["skip"] + 1, m["take"]), template))
    return F.array_join(taken, "")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(rows).select("conv_id", "valid", joined(F.col("segments")).alias("formatted"), loss_mask(F.col("segments")).alias("mask"))
    chats = chats.withColumn("turns", parse_chats(F.col("formatted"))).withColumn("loss", masked_text(F.col("formatted"), F.col("mask")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was,
    length(replace(replace(replace(text, '\', '\e'), '###', '\f'), '</turn>', '\g')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + length(role) + 15) AS BIGINT) AS formatted_chars,
  bool_and((was || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
    AND last(role ORDER BY turn, role, text) = 'assistant' AS valid
FROM o GROUP BY conv_id
"""
