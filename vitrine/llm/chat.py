"""Chat formatting by event sourcing: a log of message events becomes final messages, then training text.

``events`` has one row per event: ``conv_id``, ``message`` (key of a message within its conversation), ``seq`` (any
type with an order), ``kind``, ``role`` and ``text``. Kinds:

* ``open`` begins a message, ``delta`` adds a streamed part;
* ``edit`` puts a new text in place of all there was;
* ``regenerate`` throws away what was streamed so far, a new answer follows in deltas;
* ``delete`` withdraws a message, until it is opened, edited or regenerated again.

1. Events are grouped by conversation and message, sorted by ``seq`` and folded: the text is what stands from the last
   ``open``, ``edit`` or ``regenerate`` on. A long stream of deltas is spread over tasks by its messages.
2. Messages are sorted within their conversation by their first ``seq`` and rendered by a ``Template``. Running lengths
   give the loss mask: code point ranges that hold the texts of the trained role and nothing else.
3. ``read_turns`` and ``loss_text`` read turns and trained texts back out of the formatted text.

Only DataFrame functions are used. Texts keep every code point: inside texts and roles a backslash is doubled, and one
is put behind the first character of every control string, so that no control string is left there.

Nulls: a null text is empty and a null role is the empty role; a null ``conv_id`` or ``message`` is a key like any
other; a null ``seq`` comes first; events of a null or unknown kind have no effect. Ties: equal ``seq`` in a message go
by kind, then text; messages with the same first ``seq`` by role, then text. Repeated messages under different keys
are all kept. Other columns are ignored. An empty table gives no rows. A formatted conversation is one value, so it
must fit Spark's 2 GB; all steps before that spill.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENTS = ["conv_id", "message", "seq", "kind", "role", "text"]
RESETS = ["open", "edit", "regenerate", "delete"]


@dataclass(frozen=True)
class Template:
    """Marks of turns. ``<s>answer</s>`` is a turn of the trained role, ``[INST]role[SAYS]text[/INST]`` any other.

    ``guarded`` are control strings of other templates that must not stay whole inside texts either.
    """

    trained: str = "assistant"
    answer_open: str = "<s>"
    answer_close: str = "</s>"
    turn_open: str = "[INST]"
    turn_role: str = "[SAYS]"
    turn_close: str = "[/INST]"
    guarded: tuple[str, ...] = ("<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

    def __post_init__(self):
        for mark in self.controls():
            borders = any(mark[:n] == mark[-n:] for n in range(1, len(mark)))
            if len(mark) < 2 or "\\" in mark or borders:
                raise ValueError(f"{mark!r} can't be found again behind a text")

    def controls(self) -> list[str]:
        return [self.answer_open, self.answer_close, self.turn_open, self.turn_role, self.turn_close, *self.guarded]

    def escape(self, text: Column) -> Column:
        any_control = "|".join(f"\\Q{mark}\\E" for mark in self.controls())
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?s)(?={any_control})(.)", "$1\\\\")

    def segment(self, role: Column, text: Column) -> Column:
        """A turn as it stands in the output, from escaped text."""
        return (F.when(role == self.trained, F.concat(F.lit(self.answer_open), text, F.lit(self.answer_close)))
                .otherwise(F.concat(F.lit(self.turn_open), self.escape(role), F.lit(self.turn_role), text,
                                    F.lit(self.turn_close))))

    def turn_pattern(self) -> str:
        """Groups: text of an answer; role and text of another turn."""
        q = {name: f"\\Q{getattr(self, name)}\\E" for name in
             ("answer_open", "answer_close", "turn_open", "turn_role", "turn_close")}
        return ("(?s){answer_open}(.*?){answer_close}|{turn_open}(.*?){turn_role}(.*?){turn_close}").format(**q)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_messages(events: DataFrame) -> DataFrame:
    """``conv_id, message, place, role, text`` of every message that stands at the end of its log."""
    entry = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    logs = (events.where(F.col("kind").isin(*RESETS, "delta"))
            .groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(entry)).alias("log")))
    from_behind = F.array_position(F.reverse(F.transform("log", lambda e: e["kind"].isin(*RESETS))), True)
    # Deltas without any beginning count from the first of them.
    since = F.when(from_behind == 0, F.lit(1)).otherwise(F.size("log") - from_behind + 1).cast("int")
    live = F.slice("log", since, F.size("log"))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return (logs.withColumn("live", live).where(F.col("live")[0]["kind"] != "delete")
            .select("conv_id", "message", F.col("log")[0]["seq"].alias("place"),
                    F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                    F.array_join(F.transform("live", lambda e: e["text"]), "").alias("text")))


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, formatted, loss`` from ``conv_id, place, role, text``; ``loss`` are ranges of code points."""
    trained = F.col("role") == template.trained
    # Texts travel once, as they are; what is made of them here is made where the window and the grouping want it.
    marked = (messages.repartition("conv_id").withColumn("_inner", template.escape(F.col("text")))
              .select("conv_id", "place", "role", "text", template.segment(F.col("role"), F.col("_inner")).alias("segment"),
                      F.when(trained, F.length("_inner")).alias("size")))
    along = Window.partitionBy("conv_id").orderBy("place", "role", "text")
    stop = F.sum(F.length("segment")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begin = F.col("stop") - F.length("segment") + len(template.answer_open)
    span = F.struct(begin.cast("int").alias("start"), (begin + F.col("size")).cast("int").alias("stop"))
    # The grouping finds the rows where the window has put them: no second exchange.
    parts = (marked.withColumn("stop", stop).groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("stop", "segment", F.when(F.col("size").isNotNull(), span).alias(
                 "span")))).alias("parts")))
    return parts.select(
        "conv_id", F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"))


def format_conversations(events: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, formatted, loss`` of every conversation in the log that has a message left."""
    return render(fold_messages(events.select(*EVENTS)), template)


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns of a formatted text as ``array<struct<role, text>>``."""
    pattern = F.lit(template.turn_pattern())
    whole, answer, role, text = (F.regexp_extract_all(formatted, pattern, F.lit(i)) for i in range(4))
    return F.transform(F.arrays_zip(whole.alias("whole"), answer.alias("answer"), role.alias("role"), text.alias("text")),
                       lambda t: F.when(F.startswith(t["whole"], F.lit(template.answer_open)), F.struct(
                           F.lit(template.trained).alias("role"), unescape(t["answer"]).alias("text")))
                       .otherwise(F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["stop"] - s["start"]))), "")


def chat_log(conversations: DataFrame, trained: str = "assistant", part_chars: int = 400) -> DataFrame:
    """The event log of a chat service that wrote ``conversations`` (conv_id, turn, role, text).

    Every row is a message of its own. Answers were streamed in parts, broken off half way and regenerated; other
    texts were sent half and then edited.
    """
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{part_chars}}}"), F.lit(0))

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    def deltas(texts: Column) -> Column:
        return F.transform(texts, lambda t: event("delta", t))

    half = F.ceil(F.size("parts") / 2).cast("int")
    begun = F.concat(F.array(event("open", F.lit(""))), deltas(F.slice("parts", F.lit(1), half)))
    happened = (F.when(F.col("role").eqNullSafe(trained),
                       F.concat(begun, F.array(event("regenerate", F.lit(""))), deltas(F.col("parts"))))
                .otherwise(F.concat(begun, F.array(event("edit", F.col("text"))))))
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                                F.monotonically_increasing_id().alias("message"))
    return (rows.withColumn("parts", parts)
            .select("conv_id", "message", "turn", "role", F.posexplode(happened).alias("step", "event"))
            .select("conv_id", "message", F.struct("turn", "step").alias("seq"), "event.kind", "role", "event.text"))
