"""Conversation columns: building, testing and rendering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatmill.schemas import PART


@dataclass(frozen=True)
class ChatTemplate:
    """Delimiters around a turn. The defaults are the public ChatML layout."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    image: str = "<image>"
    prompt_role: str = "assistant"


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"), F.lit(None).cast(f"array<{PART.simpleString()}>").alias("parts"))


def exchange(system: Column, user: Column, assistant: Column) -> Column:
    """A system, a user and an assistant turn as one conversation."""
    return F.array(turn("system", system), turn("user", user), turn("assistant", assistant))


def is_multimodal(conversation: Column) -> Column:
    """True if any turn holds a list of parts; false for a null conversation."""
    return F.coalesce(F.exists(conversation, lambda t: t["parts"].isNotNull()), F.lit(False))


def render(conversation: Column, template: ChatTemplate = ChatTemplate(), add_generation_prompt: bool = False) -> Column:
    """One string per conversation, turns in order; parts are written one after another."""

    def content(t: Column) -> Column:
        parts = F.transform(t["parts"], lambda p: F.when(p["type"] == "image", template.image).otherwise(F.coalesce(p["text"], F.lit(""))))
        return F.coalesce(t["content"], F.array_join(parts, ""), F.lit(""))

    turns = F.transform(
        conversation, lambda t: F.concat(F.lit(template.start), t["role"], F.lit(template.after_role), content(t), F.lit(template.end))
    )
    tail = template.start + template.prompt_role + template.after_role if add_generation_prompt else ""
    return F.concat(F.array_join(turns, ""), F.lit(tail))


def render_batch(conversations: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Strings of an array of conversations, each as `render` gives it."""
    return F.transform(conversations, lambda c: render(c, template))
