"""Chat templates as column expressions over ``array<struct<role, content>>``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnspool.functions.pieces import SPECIALS, UNK, WHITESPACE, PieceRule, split_pieces


@dataclass(frozen=True)
class ChatTemplate:
    """``before role between content after`` per message, ``header`` opens a reply; ``marks`` are
    the special pieces of a vocabulary for it, in id order."""

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    header: str = "<|im_start|>assistant\n"
    marks: tuple[str, ...] = SPECIALS

    @property
    def rule(self) -> PieceRule:
        return PieceRule(self.marks)

    def _splits_between(self, left: str, right: str) -> bool:
        """Whether a piece can't reach over a border: a whitespace character there is enough, as it
        is a piece of its own unless a mark holds one."""
        white = left[-1:] in tuple(WHITESPACE) or right[:1] in tuple(WHITESPACE)
        return white and self.rule.splits_whitespace

    @property
    def splits_at_messages(self) -> bool:
        """True when no piece can reach over a message border."""
        return self._splits_between(self.after, self.before)

    @property
    def splits_at_header(self) -> bool:
        """The same for the border between the last message and the header."""
        return self._splits_between(self.after, self.header)


CHATML = ChatTemplate()
# The same template without the last newline, so that a rendered text ends in the eos piece.
CHATML_TIGHT = ChatTemplate(after="<|im_end|>")
# Marks that name the role, and an end piece of its own.
ROLE_MARKS = ChatTemplate(
    before="<|",
    between="|>\n",
    after="</s>\n",
    header="<|assistant|>\n",
    marks=(UNK, "</s>", "<|system|>", "<|user|>", "<|assistant|>"),
)


def render_message(role: Column, content: Column, template: ChatTemplate = CHATML) -> Column:
    return F.concat(
        F.lit(template.before), role, F.lit(template.between), content, F.lit(template.after)
    )


def render_chat(
    messages: Column, template: ChatTemplate = CHATML, add_generation_prompt: bool = False
) -> Column:
    """The whole message list as one string."""
    text = F.array_join(
        F.transform(messages, lambda m: render_message(m["role"], m["content"], template)), ""
    )
    return F.concat(text, F.lit(template.header)) if add_generation_prompt else text


def all_but_last(messages: Column) -> Column:
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def render_prompt(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """All messages but the last, followed by the header that opens the reply."""
    return render_chat(all_but_last(messages), template, add_generation_prompt=True)


def split_messages(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """``array<array<string>>``: the pieces of every rendered message."""
    return F.transform(
        messages,
        lambda m: split_pieces(render_message(m["role"], m["content"], template), template.rule),
    )


def is_usable(messages: Column) -> Column:
    """True for a non-empty message list without null roles or contents."""
    complete = F.forall(
        messages, lambda m: m.isNotNull() & m["role"].isNotNull() & m["content"].isNotNull()
    )
    return F.coalesce((F.size(messages) > 0) & complete, F.lit(False))


def chat_prompt(system: str | Column, user: Column) -> Column:
    """A system and a user message, as the inference entry point builds them."""
    system = F.lit(system) if isinstance(system, str) else system
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )
