"""Splitting text into pieces: a lossless cut of every character into exactly one piece."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNK = "<|unk|>"
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
TEXT_END = "<|endoftext|>"

# The special pieces of the ChatML form in id order (ids 0 to 3).
SPECIALS = (UNK, TURN_START, TURN_END, TEXT_END)

WHITESPACE = " \t\r\n"


def escaped(mark: str) -> str:
    """A mark as a Java pattern that matches just it."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", mark)


@dataclass(frozen=True)
class PieceRule:
    """How a vocabulary cuts text: its marks are pieces, longest first; what is between them is cut
    to runs of letters, runs of digits, and single characters. A vocabulary table holds its rule as
    its special pieces, ``marks`` in id order; the first stands for unknown pieces and is no mark of
    a text.
    """

    marks: tuple[str, ...] = SPECIALS

    @property
    def pattern(self) -> str:
        marks = [escaped(m) for m in sorted(self.marks[1:], key=len, reverse=True)]
        # A mark that starts with a letter or digit can start inside a run, which must end there.
        ahead = [escaped(m) for m in self.marks[1:] if m[:1].isalnum()]
        stop = f"(?!{'|'.join(ahead)})" if ahead else ""
        runs = [f"(?:{stop}{kind})+" if ahead else f"{kind}+" for kind in (r"\p{L}", r"\p{N}")]
        letters, digits = runs
        # Of the alternatives that do not overlap, the frequent ones come first.
        plain = [letters, r"[ \t\r\n]", digits]
        mixed = ahead or not self.splits_whitespace
        order = [*marks, *plain] if mixed else [*plain, *marks]
        return "|".join([*order, r"[^ \t\r\n\p{L}\p{N}]"])

    @property
    def splits_whitespace(self) -> bool:
        """True when a whitespace character is always a piece of its own."""
        return not any(c in m for m in self.marks for c in WHITESPACE)


CHATML_RULE = PieceRule()


def split_pieces(text: Column, rule: PieceRule = CHATML_RULE) -> Column:
    """``array<string>`` of the pieces of ``text``; concatenated they give ``text`` back."""
    return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
