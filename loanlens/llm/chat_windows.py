"""Conversations formatted as training windows of a token budget.

A window begins with the conversation's system turn, repeats some of the last turns, and
then holds new turns; it ends where the prefix sum of their tokens would pass the budget.
Windows are aligned with turns: none is cut, and one that is larger than the budget is a
window of its own.  The loss mask covers assistant turns where they are new, and never the
repeated ones, so every target counts once.

Tokens are counted and turns rendered where they are read.  Then a conversation's turns are
brought together sorted and pass as a stream: what stays in one task, however long the
conversation, is joining rendered turns to windows, and in reading back one pass over them
with two running digests.  Held are the system turn, the history and the window in the
making; a window takes no more new turns, and repeats no more, than it may have tokens, so
that empty turns do not pile up.

A token count is the tokenizer's own, but for runs of more than ``RUN`` characters with no
blank among them, or nothing else: those are counted in pieces of ``RUN`` characters, because
byte-pair tokenizers fail on a million of them.  The text itself is never cut.

Template: a turn is ``### Role: text</turn>`` and a line break.  In texts and roles a
backslash stands before each backslash and before each string that could be taken for
one of the template's own, and whatever follows a backslash is meant literally.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET = 2_048
HISTORY = 256
TARGET = "assistant"
SYSTEM = "system"

# Characters of a run that are counted at a time.
RUN = 10_000

# The template's marks.
BEGIN, COLON, END = "### ", ": ", "</turn>\n"
# Fixed value: how byte-level vocabularies cut a text before they merge.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(.)", re.S)
_MARK = re.compile(r"\\.|</turn>\n", re.S)
_ROLE_END = re.compile(r"\\.|: ", re.S)
_RUN = re.compile(rf"\S{{1,{RUN}}}|\s{{1,{RUN}}}")

RENDERED = "conv string, turn string, role string, shown string, start long, end long, tokens long, plain string"
WINDOWS = "conv string, window long, text string, n_tokens long, repeated long, mask array<struct<start:long,end:long>>"
TURNS = "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where in it the text lies.

    A role that begins with a small ASCII letter gets a capital; any other is escaped at its
    first letter, so that reading back can tell.
    """
    name = escape(role, _ROLE_CONTROL)
    if role[:1].isascii() and role[:1].islower():
        name = name[:1].upper() + name[1:]
    elif name and not name.startswith("\\"):
        name = "\\" + name
    head = f"{BEGIN}{name}{COLON}"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns in a formatted window; start and end of the escaped text."""
    at = 0
    while at < len(text):
        if not text.startswith(BEGIN, at):
            raise ValueError(f"no turn at {at}")
        colon = next(m for m in _ROLE_END.finditer(text, at + len(BEGIN)) if m[0] == COLON)
        end = next(m for m in _MARK.finditer(text, colon.end()) if m[0] == END)
        name = text[at + len(BEGIN) : colon.start()]
        role = unescape(name)
        if name and name[0] != "\\":
            role = role[:1].lower() + role[1:]
        yield role, unescape(text[colon.end() : end.start()]), colon.end(), end.start()
        at = end.end()


@cache
def _tokenizer(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> list[str]:
    """The text, cut where a run of one kind has reached ``RUN`` characters."""
    if len(text) <= RUN:
        return [text]
    cuts = [m.end() for m in _RUN.finditer(text) if m.end() - m.start() == RUN]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


def counter(path: str | None) -> Callable[[list[str]], list[int]]:
    """Token counts of texts by a file of byte-pair ranks that every machine has; by words if there is none."""
    if path is None:
        return lambda texts: [len(t.split()) for t in texts]
    return lambda texts: [sum(len(_tokenizer(path).encode_ordinary(x)) for x in pieces(t)) for t in texts]


class _Conversation:
    """The window in the making of one conversation."""

    def __init__(self, key: str, budget: int, history: int):
        self.key, self.budget, self.history = key, budget, history
        self.system: tuple[str, int] | None = None
        self.fresh: list[tuple[str, int, int, int, bool]] = []
        self.recent: deque[tuple[str, int]] = deque()
        self.used = self.window = 0
        self.first = True

    def add(self, role: str, shown: str, start: int, end: int, tokens: int) -> Iterator[tuple]:
        if self.fresh and (self.used + tokens > self.budget or len(self.fresh) >= self.budget):
            yield self.close()
        if not self.fresh and self.used + tokens > self.budget:
            # A turn that leaves no room for history goes without.
            self.used -= sum(t for _, t in self.recent)
            self.recent.clear()
        self.fresh.append((shown, start, end, tokens, role == TARGET))
        self.used += tokens
        if self.first and role == SYSTEM:
            self.system = (shown, tokens)
        self.first = False

    def close(self) -> tuple:
        """The window; its turns become history for the next."""
        begin = [self.system] if self.system and self.window else []
        repeated = [*begin, *self.recent]
        parts, mask, at = [shown for shown, _ in repeated], [], sum(len(shown) for shown, _ in repeated)
        for shown, start, end, _, target in self.fresh:
            if target:
                mask.append((at + start, at + end))
            parts.append(shown)
            at += len(shown)
        out = (self.key, self.window, "".join(parts), sum(t for _, t in repeated) + sum(f[3] for f in self.fresh), len(repeated), mask)
        for i, (shown, _, _, tokens, _) in enumerate(self.fresh):
            if self.window or i or not self.system:
                self.recent.append((shown, tokens))
        held = sum(t for _, t in self.recent)
        while self.recent and (held > self.history or len(self.recent) > self.history):
            held -= self.recent.popleft()[1]
        self.fresh, self.window = [], self.window + 1
        self.used = (self.system[1] if self.system else 0) + sum(t for _, t in self.recent)
        return out


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer: str | None = None) -> DataFrame:
    """Windows of all conversations: conv, window, text, n_tokens, repeated, mask.

    ``turns`` has conv_id, turn, role and text; conv comes as text.  A conversation's rows
    come in order of turn, role and text, nulls first; null roles and texts count as empty,
    rows without conv_id are one conversation.  ``repeated`` is the number of turns at the
    beginning that were in an earlier window; ``mask`` has the places of the targets in code
    points.  Repeated rows are turns of their own; other columns are ignored.  An empty
    table has no windows.
    """
    if history >= budget:
        raise ValueError("the history must leave room for new turns")
    # Turn numbers pass through Python as text, so that none is rounded beside a null.
    rows = turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string"), "role", "text")

    def rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(tokenizer)
        for batch in batches:
            roles, texts = batch["role"].fillna("").tolist(), batch["text"].fillna("").tolist()
            shown = [render(role, text) for role, text in zip(roles, texts)]
            # Ties go by the text, which is in what is shown unless it was escaped.
            plain = [None if end - start == len(text) else text for text, (_, start, end) in zip(texts, shown)]
            out = pd.DataFrame(shown, columns=["shown", "start", "end"])
            yield pd.concat([batch[["conv", "turn"]], out.assign(role=roles, tokens=count(texts), plain=plain)], axis=1)

    ordered = rows.mapInPandas(rendered, RENDERED).withColumn("turn", F.col("turn").cast(turns.schema["turn"].dataType))
    said = F.coalesce("plain", F.substr("shown", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int")))
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "turn", "role", said).drop("plain")

    def form(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in WINDOWS.split(", ", 5)]
        now: _Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv, *turn in zip(*(batch[c] for c in ("conv", "role", "shown", "start", "end", "tokens"))):
                conv = None if pd.isna(conv) else conv
                if now is None or now.key != conv:
                    if now is not None:
                        out.append(now.close())
                    now = _Conversation(conv, budget, history)
                out.extend(now.add(*turn))
            if out:
                yield pd.DataFrame(out, columns=names)
        if now is not None:
            yield pd.DataFrame([now.close()], columns=names)

    return ordered.mapInPandas(form, WINDOWS)


def read_back(formed: DataFrame) -> DataFrame:
    """What a reader of the windows sees of each conversation: turns, targets and sizes.

    The windows of a conversation must follow each other in order inside a partition, as
    ``windows`` returns them.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in TURNS.split(", ")]
        key, state = None, None

        def done() -> tuple:
            return key, state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"], state["windows"]

        for batch in batches:
            out = []
            for conv, text, repeated, mask in zip(batch["conv"], batch["text"], batch["repeated"], batch["mask"]):
                conv = None if pd.isna(conv) else conv
                if state is None or conv != key:
                    if state is not None:
                        out.append(done())
                    key, state = conv, {"turns": 0, "chars": 0, "size": 0, "windows": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                state["windows"] += 1
                state["size"] += len(text)
                for role, said, _, _ in list(parse(text))[int(repeated):]:
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{said}\n".encode())
                for span in mask:
                    said = unescape(text[span["start"] : span["end"]])
                    state["chars"] += len(said)
                    state["loss"].update(said.encode())
            if out:
                yield pd.DataFrame(out, columns=names)
        if state is not None:
            yield pd.DataFrame([done()], columns=names)

    return formed.mapInPandas(read, TURNS)
