"""Chat formatting: turns become one marked text per conversation, with Spark expressions only.

The marks of the template are control strings. Where a text holds something that looks like one, a
backslash is put behind its first character; where it already has backslashes there, one more. So no text
can imitate a mark, and taking one backslash off again gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import query, table

#: Turn numbers in one part of a conversation. A part is what one task puts together.
PART_TURNS = 256
CONV_ID = -7

# The rows of the extra conversation that the query formats.
EXTRA = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]


@dataclass(frozen=True)
class Template:
    """Marks before and behind the messages of each role, of any other role, and between merged texts.

    Every mark has exactly one ``[`` or ``<``, as its first character that is not a blank; ``stems`` are
    what may follow it in a mark, as regular expressions, and must cover every mark.
    """

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("[ROLE ", "] ", " [/ROLE]")
    more: str = " [MORE] "
    learned: tuple[str, ...] = ("assistant",)
    stems: tuple[str, ...] = ("/?INST", "/?SYS", "/?ROLE", "MORE", "/?s>")

    @property
    def stem(self) -> str:
        return "|".join(self.stems)

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([\[<]\\*)({self.stem})", r"$1\\$2")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([\[<]\\*)\\({self.stem})", "$1$2")

    def mark(self, role: Column, side: int) -> Column:
        """What stands before (0) or behind (1) a message of ``role``; other roles are named, safely written."""
        chosen = F.when(F.lit(False), "")
        for name, marks in self.roles.items():
            chosen = chosen.when(role == name, marks[side])
        return chosen.otherwise(F.concat(F.lit(self.other[0]), F.url_encode(role), F.lit(self.other[1])) if side == 0 else F.lit(self.other[2]))

    def message_pattern(self) -> str:
        """One message: its opening mark, everything up to the closing mark of the same role, that mark."""
        def quoted(mark: str) -> str:
            return "".join("\\" + c if c in "[]/<>." else c for c in mark)

        known = [f"{quoted(a)}.*?{quoted(b)}" for a, b in self.roles.values()]
        other = f"{quoted(self.other[0])}[^\\]]*{quoted(self.other[1])}.*?{quoted(self.other[2])}"
        return "(?s)" + "|".join([*known, other])


DEFAULT = Template()
PIECE = "array<struct<role:string,text:string>>"


def _role(role: Column) -> Column:
    return F.coalesce(role, F.lit(""))


def _merged(template: Template, turns: Column, before: Column, after: Column) -> Column:
    """Sorted turn structs as messages: adjacent turns of one role in one struct with its marks and joined text.

    ``before`` and ``after`` are the roles beside this part of the conversation (null: none); a message that
    goes on there keeps open on that side.
    """
    last = F.size(turns) - 1
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    def message(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), F.size(turns))
        role = F.get(turns, start)["role"]
        texts = F.transform(F.slice(turns, start + 1, stop - start), lambda t: template.escape(t["text"]))
        opening = F.when((start == 0) & F.coalesce(role == before, F.lit(False)), template.more).otherwise(template.mark(role, 0))
        closing = F.when((stop == F.size(turns)) & F.coalesce(role == after, F.lit(False)), "").otherwise(template.mark(role, 1))
        return F.struct(role.alias("role"), opening.alias("opening"), texts.alias("texts"), closing.alias("closing"))

    return F.transform(starts, message)


def _spans(template: Template, messages: Column) -> Column:
    """``(start, length)`` in code points of the part for every text of a learned role."""
    between = len(template.more)

    def within(state: Column, message: Column) -> Column:
        learned = message["role"].isin(*template.learned)
        first = state["at"] + F.length(message["opening"])
        texts = F.aggregate(
            message["texts"], F.struct(first.alias("at"), state["spans"].alias("spans")),
            lambda s, text: F.struct(
                (s["at"] + F.length(text) + between).alias("at"),
                F.when(learned, F.concat(s["spans"], F.array(F.struct(s["at"].alias("start"), F.length(text).alias("length")))))
                .otherwise(s["spans"]).alias("spans")))
        return F.struct((texts["at"] - between + F.length(message["closing"])).alias("at"), texts["spans"].alias("spans"))

    empty = F.array().cast("array<struct<start:int,length:int>>")
    return F.aggregate(messages, F.struct(F.lit(0).alias("at"), empty.alias("spans")), within, lambda s: s["spans"])


def format_conversations(turns: DataFrame, template: Template = DEFAULT, part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv_id, part, formatted, loss_spans)`` from ``conv_id, turn, role, text``; other columns are not read.

    The parts of a conversation, put one behind the other in order of ``part``, are its text. A part holds the
    turn numbers of one span of ``part_turns``, so a conversation of any length is spread over many tasks;
    rows that repeat a turn number stay in its part. Turns are sorted by number (a missing one first), then
    role, then text; repeated rows are turns of their own. Adjacent turns of one role make one message, also
    across parts. A null text is empty, a null role is the role without a name. Rows without conv_id belong
    to no conversation: each is formatted alone, as part 0. No rows give no rows.

    ``loss_spans`` are the places in ``formatted`` (code points from 0) of the learned role's texts, without marks.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        _role(F.col("role")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = F.struct("turn", "role", "text")
    part = F.coalesce(F.floor(F.col("turn") / part_turns).cast("long"), F.lit(-(1 << 62)))
    alone = rows.where("conv_id is null").select("conv_id", F.lit(0).cast("long").alias("part"), F.array(one).alias("turns"),
                                                 F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after"))
    grouped = rows.where("conv_id is not null").groupBy("conv_id", part.alias("part")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    # Which roles lie beside a part is known from its neighbours' first and last rows; no text takes part in that.
    edge = F.struct(F.col("turn"), F.col("role"))
    ends = rows.where("conv_id is not null").groupBy("conv_id", part.alias("part")).agg(
        F.min(edge)["role"].alias("first"), F.max(edge)["role"].alias("last"))
    along = Window.partitionBy("conv_id").orderBy("part")
    beside = ends.select("conv_id", "part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    several = beside.where("before is not null or after is not null")
    placed = grouped.join(several, ["conv_id", "part"], "left").select("conv_id", "part", "turns", "before", "after")
    made = placed.unionByName(alone).withColumn("messages", _merged(template, F.col("turns"), F.col("before"), F.col("after")))
    written = F.transform("messages", lambda m: F.concat(m["opening"], F.array_join(m["texts"], template.more), m["closing"]))
    return made.select("conv_id", "part", F.array_join(written, "").alias("formatted"), _spans(template, F.col("messages")).alias("loss_spans"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns of a whole formatted conversation, as an array of ``(role, text)``; inverse of the formatting."""
    messages = F.regexp_extract_all(formatted, F.lit(template.message_pattern()), F.lit(0))

    def turns(message: Column) -> Column:
        role = F.url_decode(F.regexp_extract(message, r"^\[ROLE ([^\]]*)\]", 1))
        opening = F.length(F.concat(F.lit(template.other[0]), F.url_encode(role), F.lit(template.other[1])))
        closing = F.lit(len(template.other[2]))
        for name, (before, behind) in template.roles.items():
            here = F.startswith(message, F.lit(before))
            role = F.when(here, name).otherwise(role)
            opening, closing = F.when(here, len(before)).otherwise(opening), F.when(here, len(behind)).otherwise(closing)
        body = message.substr(opening + 1, F.length(message) - opening - closing)
        more = template.more.replace("[", r"\[").replace("]", r"\]")
        return F.transform(F.split(body, more, -1), lambda text: F.struct(role.alias("role"), template.unescape(text).alias("text")))

    return F.flatten(F.transform(messages, turns))


def loss_text(formatted: Column, spans: Column, template: Template = DEFAULT) -> Column:
    """The text under the loss mask, unescaped, nothing between its pieces."""
    return F.array_join(F.transform(spans, lambda s: template.unescape(formatted.substr(s["start"] + 1, s["length"]))), "")


def whole_conversations(parts: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``(conv_id, formatted, loss)`` with the parts of a conversation put together; one row must hold the whole text.

    Rows without conv_id stay apart.
    """
    with_loss = parts.select("conv_id", "part", "formatted", loss_text(F.col("formatted"), F.col("loss_spans"), template).alias("loss"))
    grouped = with_loss.where("conv_id is not null").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "formatted", "loss"))).alias("parts"))
    joined = grouped.select("conv_id", F.array_join("parts.formatted", "").alias("formatted"), F.array_join("parts.loss", "").alias("loss"))
    return joined.unionByName(with_loss.where("conv_id is null").drop("part"))


def digests(whole: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What a reader of the formatted text finds there: turns, their digest, and the learned text's digest."""
    read = whole.withColumn("turns", read_turns(F.col("formatted"), template))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The digests straight from the rows; only the formatted length needs the template.
_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, lag(role) OVER w AS before,
    length(regexp_replace(text, '([\[<]\\*)(/?INST|/?SYS|/?ROLE|MORE|/?s>)', '\1\\\2', 'g')) AS n
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN role = before THEN 8 WHEN role = 'user' THEN 15 WHEN role = 'system' THEN 13 WHEN role = 'assistant' THEN 7 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""


@query("op12_chat_format", _SQL)
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = [F.struct(F.lit(CONV_ID).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(text).alias("text"))
            for turn, (role, text) in enumerate(EXTRA)]
    extra = spark.range(1).select(F.inline(F.array(*said)))
    return digests(whole_conversations(format_conversations(rows.unionByName(extra))))
