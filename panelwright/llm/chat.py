"""Chat formatting in budgeted windows of whole turns, with a loss mask, and the way back."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import arrow_map, written

#: The marks of the template (fixed values): opening and closing mark of each role; other roles are named in theirs.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
START, OTHER, OTHER_END = "<s>", "<<ROLE ", "\n<</ROLE>>\n"
#: What a control string looks like inside a text, with the backslashes that escaping has put in.
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|</?ROLE[ >])")
ESCAPED = re.compile(r"([<\[])(\\*)\\(/?s>|/?INST\]|</?SYS>>|</?ROLE[ >])")
#: Tokens of a window, of the history repeated in it, and of a turn's marks.
BUDGET, HISTORY, PER_TURN = 1024, 192, 4


def escape(text: str) -> str:
    """One backslash more after the first letter of each control string."""
    return CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def write(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted window, and (start, length) of each turn's text in it, in code points."""
    out, at, spans = [START], len(START), []
    for role, text in turns:
        opening, closing = MARKS.get(role) or (f"{OTHER}{quote(role, safe='')}>>\n", OTHER_END)
        text = escape(text)
        out += (opening, text, closing)
        spans.append((at + len(opening), len(text)))
        at += len(opening) + len(text) + len(closing)
    return "".join(out), spans


def read(window: str) -> list[tuple[str, str]]:
    """The turns of a formatted window; texts hold no control string, so the next closing mark ends a turn."""
    at, turns = len(START), []
    while at < len(window):
        if window.startswith(OTHER, at):
            name = window.index(">>\n", at)
            role, at, closing = unquote(window[at + len(OTHER) : name]), name + 3, OTHER_END
        else:
            role = next(r for r in ("system", "user", "assistant") if window.startswith(MARKS[r][0], at))
            at, closing = at + len(MARKS[role][0]), MARKS[role][1]
        end = window.index(closing, at)
        turns.append((role, unescape(window[at:end])))
        at = end + len(closing)
    return turns


def turn_tokens(text: str = "_text") -> Column:
    """Words and marks of a turn, and its own marks."""
    return F.regexp_count(F.col(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + PER_TURN


def _spans(budget: int, history: int):
    """Window numbers of a conversation's turns, from one pass over (conversation, place, role, tokens)."""

    def make():
        from collections import deque

        none = object()
        conv, window, start, total, system, past = none, 0, 0, 0, None, deque()

        def step(convs, seqs, roles, tokens):
            nonlocal conv, window, start, total, system, past
            out = [[], [], [], []]

            def emit(seq, fresh):
                for column, value in zip(out, (conv, window, seq, fresh)):
                    column.append(value)

            for c, seq, role, n in zip(*(x.to_pylist() for x in (convs, seqs, roles, tokens))):
                if conv is none or c != conv:
                    # total: tokens of all turns up to here; start: that sum where the window would have begun.
                    conv, window, start, total, past = c, 0, 0, 0, deque()
                    system = (seq, n) if role == "system" else None
                if total > start and total + n - start > budget:
                    window += 1
                    fixed = system[1] if system else 0
                    while past and (total - past[0][1] > history or total - past[0][1] + fixed + n > budget):
                        past.popleft()
                    if system:
                        emit(system[0], False)
                    for seen, _ in past:
                        emit(seen, False)
                    start = (past[0][1] if past else total) - fixed
                emit(seq, True)
                if not system or seq != system[0]:
                    past.append((seq, total))
                total += n
                while past and total - past[0][1] > history:
                    past.popleft()
            return out

        return step

    return make


def windows(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = BUDGET, history: int = HISTORY,
) -> DataFrame:
    """(conversation, window, text, loss array<struct<start, length>>, repeated): formatted windows of whole turns.

    Turns go by ``turn``; equal ones by role and a digest of the text. Sums of tokens so far
    choose the spans: a window takes turns until the budget is full, and a turn above the
    budget has a window of its own. Later windows repeat the system turn (a first turn of
    that role) and up to ``history`` tokens of the turns before. ``repeated`` counts those
    turns; the loss covers the assistant texts of the others, so each is a target once.
    Every turn is kept: nulls in role or text count as empty, rows with a null
    conversation form one, an empty table gives no window. Other columns are left out.

    Places are numbered by a sort over all turns, which splits a long conversation; only two
    whole numbers and the role of each turn then pass through its task, and texts are joined
    on the place and gathered by window.
    """
    text, role = F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.coalesce(F.col(role_col), F.lit("")).alias("_role")
    turns = conversations.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), role, text).withColumn("_digest", F.sha2("_text", 256))
    keys = ["_conv", "_turn", "_role", "_digest"]
    placed = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_seq", F.monotonically_increasing_id())
    placed = written(placed.select("_conv", "_seq", "_role", "_text", turn_tokens().alias("_n")))
    kind = dict(conversations.dtypes)[conv_col]
    narrow = placed.select("_conv", "_seq", "_role", "_n").repartition("_conv").sortWithinPartitions("_conv", "_seq")
    spans = arrow_map(narrow, narrow.columns, f"_conv {kind}, _window int, _seq long, _fresh boolean", _spans(budget, history), rows=4096)
    joined = spans.join(placed.select("_seq", "_role", "_text"), "_seq")
    grouped = joined.groupBy("_conv", "_window").agg(F.sort_array(F.collect_list(F.struct("_seq", "_fresh", "_role", "_text"))).alias("_turns"))

    def make():
        def step(convs, numbers, turns):
            texts, losses, repeated = [], [], []
            for row in turns.to_pylist():
                text, places = write([(t["_role"], t["_text"]) for t in row])
                texts.append(text)
                losses.append([{"start": a, "length": n} for t, (a, n) in zip(row, places) if t["_fresh"] and t["_role"] == "assistant"])
                repeated.append(sum(not t["_fresh"] for t in row))
            return [convs, numbers, texts, losses, repeated]

        return step

    schema = f"`{conv_col}` {kind}, window int, text string, loss array<struct<start:int,length:int>>, repeated int"
    return arrow_map(grouped, ["_conv", "_window", "_turns"], schema, make)


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the windows.

    A digest runs over a conversation's windows in order, one window at a time; nothing of
    a conversation is held but the state of its digests.
    """

    def make():
        from hashlib import sha256

        none = object()
        conv, state = none, None

        def flush(out):
            if conv is not none:
                n, turns, chars, loss, size = state
                for column, value in zip(out, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)):
                    column.append(value)

        def step(convs, texts, losses, repeated):
            nonlocal conv, state
            out = [[] for _ in range(6)]
            for c, text, spans, skip in zip(*(x.to_pylist() for x in (convs, texts, losses, repeated))):
                if conv is none or c != conv:
                    flush(out)
                    conv, state = c, [0, sha256(), 0, sha256(), 0]
                for role, turn in read(text)[skip:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{turn}\n".encode())
                for span in spans:
                    target = unescape(text[span["start"] : span["start"] + span["length"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
            return out

        def end():
            flush(out := [[] for _ in range(6)])
            return out

        step.end = end
        return step

    kind = dict(formatted.dtypes)[conv_col]
    ordered = formatted.repartition(conv_col).sortWithinPartitions(conv_col, "window")
    schema = f"`{conv_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return arrow_map(ordered, [conv_col, "text", "loss", "repeated"], schema, make)


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text"),
    )
    return digests(windows(given.unionByName(own)))
