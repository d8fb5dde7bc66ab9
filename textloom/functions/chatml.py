"""Chat and preference examples as column expressions: normalising and rendering to ChatML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import SYSTEM_PROMPT
from textloom.functions.text import strip

# The ChatML marks and the roles that keep their name.
START, END = "<|im_start|>", "<|im_end|>"
ROLES = ("system", "user", "assistant")
SYSTEM_TURN = f"{START}system\n{SYSTEM_PROMPT}{END}\n"
OPEN_ASSISTANT = f"{START}assistant\n"

MESSAGES = "array<struct<role:string,content:string>>"
SEGMENTS = "array<struct<text:string,trainable:boolean>>"


def _first_truthy(schema: T.StructType, names: tuple[str, ...]) -> Column:
    values = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in schema.names]
    return F.coalesce(*values, F.lit(""))


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def normalize_messages(df: DataFrame, out: str = "messages") -> DataFrame:
    """Bring message lists, prompt/completion and instruction/output rows to one message array.

    A message list wins over the other shapes even when it is empty; messages without content go.
    """
    names = df.schema.names
    instruction = _first_truthy(df.schema, ("instruction", "input", "question"))
    answer = _first_truthy(df.schema, ("output", "response", "answer"))
    value = F.array(_message(F.lit("user"), instruction), _message(F.lit("assistant"), answer))
    if "prompt" in names and "completion" in names:
        prompt, completion = F.col("prompt").cast("string"), F.col("completion").cast("string")
        both = F.array(_message(F.lit("user"), prompt), _message(F.lit("assistant"), completion))
        value = F.when(prompt.isNotNull() & completion.isNotNull(), both).otherwise(value)
    if "messages" in names and isinstance(df.schema["messages"].dataType, T.ArrayType):
        listed = F.transform(
            F.filter("messages", lambda m: m["content"].isNotNull() & (m["content"] != "")),
            lambda m: _message(F.coalesce(m["role"], F.lit("user")), m["content"].cast("string")),
        )
        value = F.when(F.col("messages").isNotNull(), listed).otherwise(value)
    return df.withColumn(out, value.cast(MESSAGES))


def _has_system(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.coalesce(m["role"] == "system", F.lit(False)))


def _known_role(role: Column) -> Column:
    return F.when(role.isin(*ROLES), role).otherwise(F.lit("user"))


def _turn(role: Column, content: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(END + "\n"))


def segments(messages: Column) -> Column:
    """ChatML text segments; only the bodies of assistant turns are trainable."""

    def segment(text: Column, trainable: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(trainable).alias("trainable"))

    def of_message(m: Column) -> Column:
        role, content = _known_role(m["role"]), strip(m["content"])
        answer = F.array(
            segment(F.lit(OPEN_ASSISTANT), False), segment(F.concat(content, F.lit(END + "\n")), True)
        )
        return F.when(role == "assistant", answer).otherwise(F.array(segment(_turn(role, content), False)))

    lead = F.when(_has_system(messages), F.array().cast(SEGMENTS)).otherwise(
        F.array(segment(F.lit(SYSTEM_TURN), False))
    )
    return F.concat(lead, F.flatten(F.transform(messages, of_message)))


def _with_system_lead(messages: Column, turns: Column) -> Column:
    lead = F.when(_has_system(messages), F.lit("")).otherwise(F.lit(SYSTEM_TURN))
    return F.concat(lead, F.array_join(turns, ""), F.lit(OPEN_ASSISTANT))


def generation_prompt(messages: Column) -> Column:
    """All turns as they are, followed by an open assistant turn."""
    turns = F.transform(messages, lambda m: _turn(_known_role(m["role"]), m["content"]))
    return _with_system_lead(messages, turns)


def preference_prompt(prompt: Column, listed: bool) -> Column:
    """The prompt of a preference pair: a message list without its assistant turns, or plain text."""
    if not listed:
        user = F.concat(F.lit(f"{START}user\n"), prompt.cast("string"), F.lit(f"{END}\n"))
        return F.concat(F.lit(SYSTEM_TURN), user, F.lit(OPEN_ASSISTANT))
    role = lambda m: F.coalesce(m["role"], F.lit("user"))
    asked = F.filter(prompt, lambda m: m.isNotNull() & (role(m) != "assistant"))
    turns = F.transform(asked, lambda m: _turn(role(m), F.coalesce(m["content"], F.lit(""))))
    return _with_system_lead(prompt, turns)


def response_text(value: Column, listed: bool) -> Column:
    """A response as text; the non-empty contents of a message list, whatever their role."""
    if not listed:
        return value.cast("string")
    said = F.filter(value, lambda m: m["content"].isNotNull() & (m["content"] != ""))
    return F.array_join(F.transform(said, lambda m: m["content"]), "\n")


def normalize_pairs(df: DataFrame) -> DataFrame:
    """Replace the alias columns of a preference table by prompt, chosen and rejected text."""
    fields = {f.name: isinstance(f.dataType, T.ArrayType) for f in df.schema}

    def first(names: tuple[str, ...], render, empty: Column) -> Column:
        options = []
        for name in names:
            if name in fields:
                value, listed = F.col(name), fields[name]
                truthy = (F.size(value) > 0) if listed else (value.cast("string") != "")
                options.append(F.when(truthy, render(value, listed)))
        return F.coalesce(*options, empty)

    end = F.lit(END)
    out = {
        "prompt": first(("prompt", "messages", "input"), preference_prompt, preference_prompt(F.lit(""), False)),
        "chosen": F.concat(first(("chosen", "chosen_response", "accept"), response_text, F.lit("")), end),
        "rejected": F.concat(first(("rejected", "rejected_response", "reject"), response_text, F.lit("")), end),
    }
    aliases = {"messages", "input", "chosen_response", "accept", "rejected_response", "reject"}
    rest = [F.col(n) for n in df.columns if n not in aliases and n not in out]
    return df.select(*rest, *[column.alias(name) for name, column in out.items()])
