"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a string. It is rendered on
successive prefixes of a conversation; the text by which a rendering extends
the one before is that turn's span. A template whose next rendering does not
start with the one before rewrites history, which is reported, and such a
conversation gets no spans.

``TaggedTemplate`` marks turns with control strings and escapes these inside
texts reversibly: the escape character itself is doubled, then each control
string gets one after its first character.

Null text is empty, a null role ``null``, a null conversation id one
conversation. Turns are ordered by number, equal numbers by role and text,
repeated rows are turns of their own. A conversation is one string, rendered in
one task; ``TaggedTemplate`` keeps its last rendering, so that a prefix that
extends it costs the new turn, a comparison and a copy. Extra columns are
ignored. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, by_runs, light

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]


@dataclass(frozen=True)
class Rendered:
    text: str
    spans: list[tuple[int, int]] = field(default_factory=list)
    rewrites: bool = False


def render_incrementally(template: Template, turns: list[Turn]) -> Rendered:
    """Renders every prefix and compares it with the one before."""
    before, spans = template([]), []
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        if not now.startswith(before):
            return Rendered(template(turns), [], True)
        spans.append((len(before), len(now)))
        before = now
    return Rendered(before, spans)


class TaggedTemplate:
    """[INST] user [/INST] assistant </s>, other roles between <<role>> marks."""

    ESCAPE = "\\"
    OPEN, CLOSE, END = "[INST] ", " [/INST]", "</s>"
    MARKS = ("[INST]", "[/INST]", "</s>", "<<", ">>")

    #: The escape character, and each mark's first character where the mark stands.
    SPECIAL = re.compile(r"\\|\[(?=/?INST\])|<(?=<|/s>)|>(?=>)")

    def __init__(self) -> None:
        self.last: tuple[list[Turn], str] = ([], "")

    def escape(self, text: str) -> str:
        return self.SPECIAL.sub(lambda m: m[0] + self.ESCAPE, text)

    def unescape(self, text: str) -> str:
        if self.ESCAPE not in text:
            return text
        out, k = [], 0
        while k < len(text):
            at = text.find(self.ESCAPE, k)
            if at < 0:
                out.append(text[k:])
                break
            out.append(text[k:at])
            if text.startswith(self.ESCAPE, at + 1):
                out.append(self.ESCAPE)
                k = at + 2
            else:
                k = at + 1
        return "".join(out)

    def wrap(self, role: str) -> tuple[str, str]:
        if role == "user":
            return self.OPEN, self.CLOSE
        if role == "assistant":
            return " ", self.END
        return f"<<{self.escape(role)}>> ", self.END

    def turn(self, role: str, text: str) -> str:
        head, tail = self.wrap(role)
        return head + self.escape(text) + tail

    def __call__(self, turns: list[Turn]) -> str:
        known, text = self.last
        if not known or turns[: len(known)] != known:
            known, text = [], ""
        text += "".join(self.turn(r, t) for r, t in turns[len(known) :])
        self.last = (turns, text)
        return text

    def read_turn(self, span: str) -> tuple[Turn, tuple[int, int]]:
        """(role, text) of a turn's span, and where its escaped text lies in it."""
        if span.startswith(self.OPEN):
            role, head, tail = "user", self.OPEN, self.CLOSE
        elif span.startswith("<<"):
            close = span.index(">> ")
            role, head, tail = self.unescape(span[2:close]), span[: close + 3], self.END
        else:
            role, head, tail = "assistant", " ", self.END
        body = (len(head), len(span) - len(tail))
        return (role, self.unescape(span[body[0] : body[1]])), body


def format_conversations(conversations: DataFrame, template: TaggedTemplate | None = None) -> DataFrame:
    """(conv_id, formatted, spans, loss_spans, rewrites) per conversation.

    Spans are code points of ``formatted``; the loss mask covers the assistant
    texts alone.
    """
    template = template or TaggedTemplate()
    bounded_batches(conversations.sparkSession)
    text = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other)).alias(c)
    turns = conversations.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", text("role", "null"), text("text", ""))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        convs, roles, texts = (pdf[c].tolist() for c in ("conv_id", "role", "text"))
        rows, a = [], 0
        while a < len(convs):
            b = a + 1
            while b < len(convs) and convs[b] == convs[a]:
                b += 1
            done, loss = render_incrementally(template, list(zip(roles[a:b], texts[a:b]))), []
            for x, y in done.spans:
                (role, _), (p, q) = template.read_turn(done.text[x:y])
                if role == "assistant":
                    loss.append([x + p, x + q])
            rows.append((convs[a], done.text, [list(s) for s in done.spans], loss, done.rewrites))
            a = b
        return pd.DataFrame(rows, columns=["conv_id", "formatted", "spans", "loss_spans", "rewrites"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    schema = "conv_id string, formatted string, spans array<array<long>>, loss_spans array<array<long>>, rewrites boolean"
    formatted = ordered.mapInPandas(by_runs("conv_id", whole, 4000, "text", 4 << 20), schema)
    return formatted.withColumn("conv_id", F.col("conv_id").cast(conversations.schema["conv_id"].dataType))


def read_back(formatted: DataFrame, template: TaggedTemplate | None = None) -> DataFrame:
    """Digests of what the formatted text itself says about its turns, and
    whether the template rewrote history (then there are no turns to read)."""
    template = template or TaggedTemplate()

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for conv, text, spans, loss, rewrites in zip(pdf["conv_id"], pdf["formatted"], pdf["spans"], pdf["loss_spans"], pdf["rewrites"]):
                whole, under, n = hashlib.sha256(), hashlib.sha256(), 0
                for a, b in spans:
                    (role, said), _ = template.read_turn(text[a:b])
                    whole.update(f"{role}\n{said}\n".encode())
                for a, b in loss:
                    said = template.unescape(text[a:b])
                    n += len(said)
                    under.update(said.encode())
                rows.append((conv, len(spans), whole.hexdigest(), n, under.hexdigest(), len(text), rewrites))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])

    kind = formatted.schema["conv_id"].dataType
    slim = formatted.withColumn("conv_id", F.col("conv_id").cast("string"))
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"
    return slim.mapInPandas(light(digest), schema).withColumn("conv_id", F.col("conv_id").cast(kind))
