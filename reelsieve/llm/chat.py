"""Chat formatting in budgeted windows.

A turn becomes `[TURN]role\\ntext</s>`, a window `<s>` and its turns. Control strings inside roles and texts are broken by a
backslash after their first character, and backslashes are doubled, so the template's marks are unambiguous and every
text can be read back to the letter. Prefix sums of the turns' tokens choose spans of whole turns: a window holds the
conversation's leading system turns again, then repeated history of at most `history` tokens, then new turns as long
as all fit the budget (a turn over the budget gets a window of its own). Only new assistant texts are under the loss mask;
repeated ones are masked out, so each is a target exactly once.

Where a window ends follows from where it begins, so a conversation of any length is cut into the same windows by many
tasks: turns are numbered by two-step counts over range partitions; for each part of a conversation, from token counts
alone, every place where a window may enter it is followed to the place where one leaves it; one pass over the parts picks
the true entries; then the parts are formatted independently.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as Window_
from pyspark.sql import functions as F

from .common import materialize

BUDGET, HISTORY = 1024, 256
TARGET, SYSTEM = "assistant", "system"
BEGIN, TURN, END = "<s>", "[TURN]", "</s>"
#: Strings that chat templates and tokenizers treat as control, besides this template's own.
CONTROLS = (BEGIN, TURN, END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>", "<unk>", "<pad>")
#: Turns of a part of a conversation (at least a budget's tokens); the windows don't depend on it.
SEGMENT = 4096
#: Leading system turns are repeated in every window as long as they take at most this share of the budget together.
SYSTEM_SHARE = 0.75
#: Fixed value: the pre-tokenisation pattern of byte-level BPE vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_ROLE = re.compile(r"((?:\\.|[^\\\n])*)\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int]:
    """The turn's string and the place in it where the escaped text begins."""
    head = TURN + escape(role).replace("\n", "\\\n") + "\n"
    return head + escape(text) + END, len(head)


def parse(window: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    if not window.startswith(BEGIN):
        raise ValueError("a window begins with " + BEGIN)
    out, at = [], len(BEGIN)
    while at < len(window):
        if not window.startswith(TURN, at):
            raise ValueError(f"no turn at {at}")
        head = _ROLE.match(window, at + len(TURN))
        end = window.index(END, head.end())
        out.append((unescape(head[1]), unescape(window[head.end() : end])))
        at = end + len(END)
    return out


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})


def counter(ranks: bytes | None) -> Callable[[list[str]], list[int]]:
    """Tokens of each string: by the vocabulary (a tiktoken rank file's bytes), or without one the pieces of PATTERN."""
    if ranks is None:
        pattern = regex.compile(PATTERN)
        return lambda some: [sum(1 for _ in pattern.finditer(x)) for x in some]
    encoding = _encoding(ranks)
    return lambda some: [len(encoding.encode_ordinary(x)) for x in some]


class Window:
    """One window: text, mask (ranges of targets in it), repeated (its first turns that were in an earlier window), tokens."""

    def __init__(self, repeated: Iterable[tuple[str, int]]):
        kept = list(repeated)
        self.parts, self.size, self.mask, self.new = [BEGIN, *(x for x, _ in kept)], len(BEGIN) + sum(len(x) for x, _ in kept), [], 0
        self.repeated, self.tokens = len(kept), sum(n for _, n in kept)

    def add(self, shown: str, at: int, tokens: int, target: bool) -> None:
        if target:
            self.mask.append((self.size + at, self.size + len(shown) - len(END)))
        self.parts.append(shown)
        self.size += len(shown)
        self.tokens += tokens
        self.new += 1


def next_begins(tokens: np.ndarray, first: int, system: int, system_tokens: int, budget: int, history: int) -> np.ndarray:
    """For each turn the turn at which the window after it begins, if a window begins there; tokens: of turns first, first + 1, ...

    system: number of repeated system turns; no history goes back before them. Right for turns that have `history` tokens
    of turns before them in the array (or all there are), and `budget` tokens after them.
    """
    ends = np.concatenate(([0], np.cumsum(tokens)))
    at = np.arange(len(tokens))
    spare = np.clip(budget - tokens - system_tokens, 0, history)
    past = np.maximum(np.searchsorted(ends, ends[at] - spare, side="left"), min(max(0, system - first), len(tokens)))
    held = np.where(at + first >= system, system_tokens + ends[at] - ends[np.minimum(past, at)], 0)
    return np.maximum(np.searchsorted(ends, ends[at] + budget - held, side="right") - 1, at + 1) + first


def leaves(tokens: np.ndarray, first: int, begin: int, end: int, system: int, system_tokens: int, budget: int, history: int) -> tuple[list[int], list[int], list[int]]:
    """Turns of the part [begin, end) at which a window may enter it, where the first window after the part then begins, and how many begin in it."""
    after = next_begins(tokens, first, system, system_tokens, budget, history).tolist()
    out, count = [0] * (end - begin), [0] * (end - begin)
    for i in range(end - 1, begin - 1, -1):
        to = after[i - first]
        out[i - begin], count[i - begin] = (to, 1) if to >= end else (out[to - begin], count[to - begin] + 1)
    # A window holds a budget's tokens or one turn, so the first one to begin here does so within a budget's tokens.
    reach = max(1, int(np.searchsorted(np.cumsum(tokens[begin - first : end - first]), budget, side="right")) + 1) if begin else 1
    return list(range(begin, min(end, begin + reach))), out[:reach], count[:reach]


def windows(turns: Iterable[tuple[int, str, int, str, int]], entry: int, stop: int, system: list[tuple[str, int]], budget: int = BUDGET, history: int = HISTORY) -> Iterator[Window]:
    """Windows that begin at turns entry <= i < stop; turns: (number, role, tokens, shown, place of the text in shown) in order, from those that the first window repeats on.

    system: (shown, tokens) of the repeated system turns, which are the conversation's first. Memory: one window and the history.
    """
    again, kept = sum(n for _, n in system), len(system)
    past: deque[tuple[str, int]] = deque()
    past_tokens, now = 0, None
    for number, role, tokens, shown, at in turns:
        if number >= entry:
            if now is None or (now.tokens + tokens > budget and now.new):
                if now is not None:
                    yield now
                    now = None
                if number >= stop:
                    return
                repeats, spare = number >= kept, max(0, min(history, budget - tokens - again))
                repeated: list[tuple[str, int]] = []
                for turn in reversed(past) if repeats else ():
                    spare -= turn[1]
                    if spare < 0:
                        break
                    repeated.append(turn)
                now = Window([*(system if repeats else []), *reversed(repeated)])
            now.add(shown, at, tokens, role == TARGET)
        if number >= kept:
            past.append((shown, tokens))
            past_tokens += tokens
            while past_tokens > history and len(past) > 1:
                past_tokens -= past.popleft()[1]
    if now is not None:
        yield now


def _numbered(rows: DataFrame, ranks: bytes | None) -> DataFrame:
    """conv_id, number (of the turn in its conversation), role, shown, place, tokens."""
    held = rows.sparkSession.sparkContext.broadcast(ranks)

    def each(batches):
        count = counter(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                shown = [render(role, text) for role, text in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)]
                # A turn counts at least one token, so a budget's tokens bound a window's turns too.
                tokens = [max(1, n) for n in count([x for x, _ in shown])]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([x for x, _ in shown], pa.string()), pa.array([n for _, n in shown], pa.int64()), pa.array(tokens, pa.int64())], names=["conv_id", "role", "shown", "place", "tokens"])

    # Spark's range partitions cut a long conversation by turn, and turns that tie by role and text.
    parts = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    parts = parts.select("conv_id", "role", "text").mapInArrow(each, "conv_id long, role string, shown string, place long, tokens long")
    parts = materialize(parts.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "turns")
    runs = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("row").alias("low"))
    before = Window_.partitionBy("conv_id").orderBy("part").rowsBetween(Window_.unboundedPreceding, -1)
    runs = materialize(runs.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "runs")
    # A conversation's rows lie together within a partition, so the row's own number counts them.
    rows = parts.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return materialize(rows.select("conv_id", (F.col("row") - F.col("low") + F.col("before")).alias("number"), "role", "shown", "place", "tokens"), "numbered")


def _entries(turns: DataFrame, system: DataFrame, segment: int, budget: int, history: int) -> DataFrame:
    """conv_id, segment, entry (turn at which its first window begins), window (that window's number), kept (system turns): the parts in which a window begins."""
    here = F.floor(F.col("number") / segment).cast("long")
    inside = F.col("number") - here * segment
    near = F.array_compact(F.array(here, F.when(inside < budget, here - 1), F.when(inside >= segment - history, here + 1)))
    slim = turns.select("conv_id", "number", "tokens", F.explode(near).alias("segment")).where("segment >= 0")
    # A part and its surroundings: bounded lists of numbers.
    parts = slim.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("number", "tokens"))).alias("turns"))
    parts = parts.join(system.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), "kept", "kept_tokens"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left").select("conv_id", "segment", "turns", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("kept_tokens", F.lit(0)).alias("kept_tokens"))
    places = pa.list_(pa.int64())

    def follow(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                part, kept, kept_tokens = (batch.column(k)[i].as_py() for k in (1, 3, 4))
                some = batch.column(2)[i].values.flatten()
                numbers, tokens = some[0].to_numpy(), some[1].to_numpy()
                begin, end = part * segment, min((part + 1) * segment, int(numbers[-1]) + 1)
                out.append(leaves(tokens, int(numbers[0]), begin, end, kept, kept_tokens, budget, history) if begin < end else ([], [], []))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *(pa.array([x[k] for x in out], places) for k in range(3))], names=["conv_id", "segment", "kept", "entries", "exits", "counts"])

    parts = materialize(parts.mapInArrow(follow, "conv_id long, segment long, kept long, entries array<long>, exits array<long>, counts array<long>"), "parts")

    def walk(batches):
        conv, at, number = None, 0, 0
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                own, part, kept, entries, exits, counts = (batch.column(k)[i].as_py() for k in range(6))
                if part == 0:
                    conv, at, number = own, 0, 0
                assert own == conv
                if entries and entries[0] <= at <= entries[-1]:
                    out.append((own, part, at, number, kept))
                    k = at - entries[0]
                    at, number = exits[k], number + counts[k]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(5)], names=["conv_id", "segment", "entry", "window", "kept"])

    # One short row for each `segment` turns: a pass that grows with the conversation, but not with its texts.
    walked = parts.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(walk, "conv_id long, segment long, entry long, window long, kept long")
    return materialize(walked, "entries")


def _system(turns: DataFrame, segment: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """The repeated system turns (conv_id, number, shown, tokens), and for each part of their conversations their number and tokens."""
    most = int(budget * SYSTEM_SHARE)
    # The repeated ones lie among the first `most` turns, so these lists are bounded.
    lead = turns.where((F.col("number") <= most)).groupBy("conv_id").agg(F.min(F.when(F.col("role") != SYSTEM, F.col("number"))).alias("end"), F.array_sort(F.collect_list(F.when(F.col("role") == SYSTEM, F.struct("number", "tokens", "shown")))).alias("all"))
    lead = lead.select("conv_id", F.filter("all", lambda x: F.col("end").isNull() | (x["number"] < F.col("end"))).alias("all"))
    sums = F.transform("all", lambda x, i: F.aggregate(F.slice("all", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, y: a + y["tokens"]))
    lead = materialize(lead.select("conv_id", F.filter("all", lambda x, i: sums[i] <= most).alias("all")).where("size(all) > 0"), "system")
    ends = turns.groupBy("conv_id").agg(F.max("number").alias("n"))
    parts = lead.select(F.col("conv_id").alias("c"), F.size("all").cast("long").alias("kept"), F.aggregate("all", F.lit(0).cast("long"), lambda a, y: a + y["tokens"]).alias("kept_tokens")).join(ends, F.col("c").eqNullSafe(F.col("conv_id")))
    parts = parts.select("conv_id", "kept", "kept_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / segment))).alias("segment"))
    return lead.select("conv_id", F.explode("all").alias("x")).select("conv_id", "x.number", "x.shown", "x.tokens"), parts


def format_windows(df: DataFrame, ranks: bytes | None = None, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """conv_id, window (number in the conversation), text, mask (array of a, b), repeated, tokens.

    df: conv_id, turn, role, text; turns are ordered by turn, role, text, whatever the turns' values are; repeated rows are
    turns of their own. Null texts and roles count as empty, a null turn comes first, a null conv_id is a conversation; an
    empty table gives an empty result; other columns are not read. All leading system turns that together take at most
    SYSTEM_SHARE of the budget are repeated; those beyond are turns like others. Tokens are counted by the vocabulary
    `ranks` (a tiktoken rank file's bytes), or without one in pieces of PATTERN.
    """
    segment = max(segment, budget + history)
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = _numbered(rows, ranks)
    system, parts = _system(turns, segment, budget)
    entries = _entries(turns, parts, segment, budget, history)
    here = F.floor(F.col("number") / segment).cast("long")
    inside = F.col("number") - here * segment
    near = F.array_compact(F.array(here, F.when(inside < budget, here - 1), F.when(inside >= segment - history, here + 1)))
    # kind 0: where to enter the part, 1: a system turn, 2: a turn.
    dealt = turns.select("conv_id", F.explode(near).alias("segment"), F.lit(2).alias("kind"), "number", "role", "shown", "place", "tokens").where("segment >= 0")
    heads = entries.select("conv_id", "segment", F.lit(0).alias("kind"), F.col("entry").alias("number"), F.lit("").alias("role"), F.lit("").alias("shown"), F.col("window").alias("place"), F.lit(0).cast("long").alias("tokens"))
    again = entries.where("kept > 0").select(F.col("conv_id").alias("c"), "segment").join(system, F.col("c").eqNullSafe(F.col("conv_id"))).select("conv_id", "segment", F.lit(1).alias("kind"), "number", F.lit(SYSTEM).alias("role"), "shown", F.lit(0).cast("long").alias("place"), "tokens")
    every = heads.unionByName(again).unionByName(dealt).repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "kind", "number")
    names = ["conv_id", "window", "text", "mask", "repeated", "tokens"]

    def each(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    for conv, part, *x in zip(*(batch.column(k).slice(at, 256).to_pylist() for k in range(8)), strict=True):
                        yield (conv, part), x

        def packed(out):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

        out: list[tuple] = []
        for (conv, part), own in grouped(rows()):
            first = next(own)
            if first[0] != 0:
                continue  # no window begins in this part
            entry, number, shown = first[1], first[4], []
            left = iter(own)
            head = next(left)
            while head[0] == 1:
                shown.append((head[3], head[5]))
                head = next(left)
            said = ((x[1], x[2], x[5], x[3], x[4]) for x in chain((head,), left))
            for k, w in enumerate(windows(said, entry, (part + 1) * segment, shown, budget, history)):
                out.append((conv, number + k, "".join(w.parts), [{"a": a, "b": b} for a, b in w.mask], w.repeated, w.tokens))
                if len(out) == 512:
                    yield packed(out)
                    out = []
        if out:
            yield packed(out)

    return every.mapInArrow(each, "conv_id long, window long, text string, mask array<struct<a:long,b:long>>, repeated long, tokens long")


def grouped(pairs: Iterable[tuple]) -> Iterator[tuple]:
    """(key, values) of runs of equal keys, one value at a time."""
    for key, run in groupby(pairs, key=lambda x: x[0]):
        yield key, (v for _, v in run)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read from format_windows()' output.

    A digest of all turns in order can only be made in order: a conversation's windows are hashed one at a time in one task,
    so its length costs time but no memory.
    """
    rows = formatted.select("conv_id", "window", "text", "mask", "repeated").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def each(batches):
        def shown():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield batch.column(0)[i].as_py(), tuple(batch.column(k)[i].as_py() for k in (2, 3, 4))

        def packed(out):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

        out: list[tuple] = []
        for conv, own in grouped(shown()):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for text, mask, repeated in own:
                size += len(text)
                for role, said in parse(text)[repeated:]:
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for at in mask:
                    target = unescape(text[at["a"] : at["b"]])
                    chars += len(target)
                    loss.update(target.encode("utf-8", "surrogatepass"))
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
            if len(out) == 4096:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    return rows.mapInArrow(each, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
