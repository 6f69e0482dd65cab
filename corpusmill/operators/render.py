"""Stage C: chat rendering of message lists into one ``text`` value (PRJ41/42,
FLT8, SRC15).

The chat template lives with the tokenizer in the source system, so it is a
parameter here. The default is a role-tagged template of the ChatML family;
swap in the template of the target model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as TX


@dataclass(frozen=True)
class ChatTemplate:
    """``{role}`` / ``{content}`` placeholders for one message, plus the text
    that opens the assistant turn when a generation prompt is asked for."""

    message: str = "<|im_start|>{role}\n{content}<|im_end|>\n"
    generation_prompt: str = "<|im_start|>assistant\n"

    def pieces(self):
        head, rest = self.message.split("{role}", 1)
        mid, tail = rest.split("{content}", 1)
        return head, mid, tail


DEFAULT_TEMPLATE = ChatTemplate()


def render_messages(messages, template: ChatTemplate = DEFAULT_TEMPLATE, add_generation_prompt: bool = False) -> Column:
    """One string from ``ARRAY<STRUCT<role, content>>``, in order."""
    head, mid, tail = template.pieces()
    body = F.array_join(F.transform(TX.col(messages), lambda m: F.concat(
        F.lit(head), m["role"], F.lit(mid), m["content"], F.lit(tail))), "")
    return F.concat(body, F.lit(template.generation_prompt)) if add_generation_prompt else body


def record_error(messages) -> Column:
    """Training-record check: a non-empty list whose messages all carry a
    role and a content."""
    m = TX.col(messages)
    return (
        F.when(m.isNull() | (F.size(m) <= 0), F.lit("missing_messages"))
        .when(~F.forall(m, lambda x: x.isNotNull() & x["role"].isNotNull() & x["content"].isNotNull()),
              F.lit("malformed_message"))
    )


def render_split(samples: DataFrame, messages_col: str = "messages", template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Training split -> (text, error_reason); all source columns are dropped
    after rendering, as the trainer expects a single text column."""
    err = record_error(F.col(messages_col))
    return samples.select(F.when(err.isNull(), render_messages(F.col(messages_col), template)).alias("text"),
                          err.alias("error_reason"))


def render_prompt(messages, prompt, default_system_prompt: str | None, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """Eval prompt: the case's messages when present (with generation
    prompt); else [default system,] user prompt rendered the same way; with no
    default system prompt the raw prompt is used as is."""
    m = TX.col(messages)
    has_msgs = m.isNotNull() & (F.size(m) > 0)
    p = TX.col(prompt)
    if default_system_prompt:
        built = F.array(F.struct(F.lit("system").alias("role"), F.lit(default_system_prompt).alias("content")),
                        F.struct(F.lit("user").alias("role"), p.cast("string").alias("content")))
        fallback = F.when(p.isNotNull(), render_messages(built, template, True))
    else:
        fallback = p.cast("string")
    return F.when(has_msgs, render_messages(m, template, True)).otherwise(fallback)
