"""Spelling variant grouping: words that differ by one letter, found by forward and backward minimal automata.

Words are letter runs (A-Z, a-z, U+00C0 to U+00FF) of whole texts; every 199th run, by its checksum, loses a letter first, so
that variants occur. A word of at least min_length code points and min_count occurrences is looked up for words at distance
one. Of two such words, the shorter of which has L code points, either the first L div 2 code points are the same in both or
the last L - L div 2 are. So words meet in groups of (direction, L, that half). Each task takes groups of about BLOCK words
together into one minimal acyclic automaton (backward groups hold reversed words), matches a word's half exactly, completes
it with one error, and reads the words it reaches by their perfect-hash number. What both directions reach counts in the
forward one only. A group of more than BLOCK words is dealt out in blocks, and its words are looked up in each of them.

Cases: a null or empty text has no words; a null doc_id reads as an empty one in the checksum; repeated rows are counted as
often as they occur; rows without words give an empty result; columns other than doc_id and text are not looked at. Texts are
read whole; a word may be as long as its text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, texts

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form has at least so many times a word's occurrences.
TIMES = 5
#: Fixed value of the contract: runs whose checksum it divides lose a letter.
EVERY = 199
#: Words of one automaton, and of a group that is kept in one task.
BLOCK = 50_000
#: Distinct words that a counting task holds before it hands them on.
HELD = 500_000

#: In Latin-1 each code point is a byte: A-Z become a-z, other bytes than letters white space.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
_COUNTS = "word string, n long"
_GROUP = ("side", "size", "half", "slot")
_FOUND = "word string, near long, form_n long, form string"


def runs(doc_id: object, text: str) -> Counter:
    """Occurrences of each letter run of a text (Latin-1 bytes), after the deletions; what is left of a one-letter run may be empty."""
    out: Counter = Counter()
    # Letters beyond Latin-1 turn into question marks, which end runs as they do in the text.
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def _batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Columns word, n: words of at least min_length code points and min_count occurrences over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for piece in texts(batch.column("text")):
                for text in piece:
                    for word, n in runs(next(ids), text).items():
                        if len(word) >= min_length:
                            held[word] += n
                    if len(held) > HELD:
                        yield _batch(held)
                        held.clear()
        yield _batch(held)

    return docs.select("doc_id", "text").mapInArrow(count, _COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Automaton:
    """The minimal acyclic automaton of sorted distinct byte strings; each is numbered by its place in that order.

    A state's steps are {byte: (next state, strings passed over)}: the sum of the second entries along a string is its number.
    """

    def __init__(self, strings: list[bytes]):
        self.steps: list[dict[int, tuple[int, int]]] = []
        self.final: list[bool] = []
        self._size: list[int] = []
        self._known: dict[tuple, int] = {}
        open_: list[tuple[dict[int, int], bool]] = [({}, False)]
        last = b""
        for s in strings:
            same = 0
            for x, y in zip(last, s, strict=False):
                if x != y:
                    break
                same += 1
            self._close(open_, last, same)
            open_ += [({}, False) for _ in range(len(s) - same)]
            open_[-1] = (open_[-1][0], True)
            last = s
        self._close(open_, last, 0)
        self.root = self._state(*open_[0])
        self._known.clear()

    def _close(self, open_: list[tuple[dict[int, int], bool]], s: bytes, down_to: int) -> None:
        """States of s below depth down_to get no more steps: equal ones become one."""
        for depth in range(len(open_) - 1, down_to, -1):
            state = self._state(*open_.pop())
            open_[-1][0][s[depth - 1]] = state

    def _state(self, to: dict[int, int], final: bool) -> int:
        key = (final, *to.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.steps)
            steps, passed = {}, int(final)
            for c, t in to.items():
                steps[c] = (t, passed)
                passed += self._size[t]
            self.steps.append(steps)
            self.final.append(final)
            self._size.append(passed)
        return state

    def walk(self, s: bytes, state: int | None = None, number: int = 0) -> tuple[int, int]:
        """State and number after s, or (-1, 0)."""
        state = self.root if state is None else state
        for c in s:
            step = self.steps[state].get(c)
            if step is None:
                return -1, 0
            state, number = step[0], number + step[1]
        return state, number

    def _ends(self, s: bytes, at: int, state: int, number: int) -> int:
        """The number of what s[at:] completes, or -1."""
        steps = self.steps
        for c in s[at:]:
            step = steps[state].get(c)
            if step is None:
                return -1
            state, number = step[0], number + step[1]
        return number if self.final[state] else -1

    def longer_or_equal(self, s: bytes, at: int, state: int, number: int) -> Iterator[tuple[int, int, int]]:
        """(number, place, byte) of each string that s becomes by one byte replaced (byte -1) or put in at a place from `at` on; s[:at] led here.

        A byte is not put in before an equal one, which the next place finds, so nothing comes twice.
        """
        for i in range(at, len(s) + 1):
            steps = self.steps[state]
            own = s[i] if i < len(s) else -1
            for c, (to, passed) in steps.items():
                if c != own:
                    if own >= 0 and (found := self._ends(s, i + 1, to, number + passed)) >= 0:
                        yield found, i, -1
                    if (found := self._ends(s, i, to, number + passed)) >= 0:
                        yield found, i, c
            if own not in steps:
                return
            state, number = steps[own][0], number + steps[own][1]

    def shorter(self, s: bytes, at: int, state: int, number: int) -> Iterator[tuple[int, int]]:
        """(number, place) of each string that s becomes without one byte from `at` on; of equal bytes in a row the last one goes."""
        for i in range(at, len(s)):
            own = s[i]
            if (i + 1 == len(s) or s[i + 1] != own) and (found := self._ends(s, i + 1, state, number)) >= 0:
                yield found, i
            step = self.steps[state].get(own)
            if step is None:
                return
            state, number = step[0], number + step[1]


class _Words:
    """Words of some groups in one automaton, under a tag for direction and L."""

    def __init__(self, entries: list[tuple[bool, int, bytes, int]]):
        rows = sorted((self.tag(back, size) + (w[::-1] if back else w), n) for back, size, w, n in entries)
        self.automaton = Automaton([s for s, _ in rows])
        self.n = [n for _, n in rows]
        self.words = [s[s.index(b":") + 1 :] for s, _ in rows]
        self.starts: dict[tuple[bool, int], tuple[int, int]] = {}

    @staticmethod
    def tag(back: bool, size: int) -> bytes:
        return b"%d,%d:" % (back, size)

    def near(self, back: bool, size: int, word: bytes) -> list[int]:
        """Numbers of the words at distance one from word that its direction answers for."""
        start = self.starts.get((back, size)) or self.starts.setdefault((back, size), self.automaton.walk(self.tag(back, size)))
        if start[0] < 0:
            return []
        half = size // 2
        s, at = (word[::-1], size - half) if back else (word, half)
        state, number = self.automaton.walk(s[:at], *start)
        if state < 0:
            return []
        if len(word) > size:
            found = self.automaton.shorter(s, at, state, number)
            return [k for k, i in found if not back or self._first(word, size - i, word[size - i]) - 1 < half]
        found = self.automaton.longer_or_equal(s, at, state, number)
        return [k for k, i, c in found if not back or c < 0 or self._first(word, size - i, c) < half]

    @staticmethod
    def _first(word: bytes, at: int, c: int) -> int:
        """The first place from `at` on whose byte isn't c: up to there both words are the same, so a forward group finds them from half on."""
        while at < len(word) and word[at] == c:
            at += 1
        return at

    def best(self, back: bool, numbers: list[int]) -> tuple[int, str]:
        n, word = min((-self.n[k], self.words[k][::-1] if back else self.words[k]) for k in numbers)
        return -n, word.decode("latin-1")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by group, the words that the group's automaton holds before those that are only looked up."""
    out: list[tuple] = []

    def look(words: _Words, back: bool, size: int, word: bytes) -> None:
        if found := words.near(back, size, word):
            out.append((word.decode("latin-1"), len(found), *words.best(back, found)))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        out.clear()
        kinds = (("word", pa.string()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[k for k, _ in kinds])

    def answered(entries: list[tuple[bool, int, bytes, int]]) -> _Words:
        words = _Words(entries)
        for back, size, word, _ in entries:
            look(words, back, size, word)
        entries.clear()
        return words

    held: list[tuple[bool, int, bytes, int]] = []
    letters, group, words = 0, None, None
    for b in batches:
        for at in range(0, len(b), 10_000):
            for r in b.slice(at, 10_000).to_pylist():
                if (now := tuple(r[k] for k in _GROUP)) != group:
                    group, words = now, None
                    if len(held) >= BLOCK or letters >= 20 * BLOCK:
                        answered(held)
                        letters = 0
                word = r["word"].encode("latin-1")
                if r["listed"]:
                    held.append((r["side"], r["size"], word, r["n"]))
                    letters += len(word)
                else:
                    if words is None:
                        words, letters = answered(held), 0
                    look(words, r["side"], r["size"], word)
            yield batch()
    answered(held)
    yield batch()


def _grouped(words: DataFrame, min_length: int) -> DataFrame:
    """Each word's rows in its groups: direction (true: backward), L, half, and the block of a group of more than BLOCK words."""
    length = F.length("word")
    half = F.floor(F.col("size") / 2).cast("int")
    rows = (
        words.withColumn("size", F.explode(F.when(length > min_length, F.array(length - 1, length)).otherwise(F.array(length))))
        .withColumn("side", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("half", F.when(F.col("side"), F.substring(F.col("word"), half - F.col("size"), F.col("size") - half)).otherwise(F.substring(F.col("word"), F.lit(1), half)))
    )
    big = rows.groupBy("side", "size", "half").count().where(F.col("count") > BLOCK).select("side", "size", "half", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    return rows.join(big, ["side", "size", "half"], "left").select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("slot")).withColumn("listed", F.pmod(F.xxhash64("word"), blocks) == F.col("slot"))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Columns word, n_near, form, form_n for each word of words (word, n: distinct, of min_length or more code points of Latin-1) that has a near one.

    form is the near word of largest n, the smallest of them in code-point order.
    """
    parts = max(words.sparkSession.sparkContext.defaultParallelism, -(-4 * words.count() // BLOCK))
    dealt = _grouped(words.select("word", "n"), min_length).repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP, F.desc("listed"))
    found = dealt.select(*_GROUP, "word", "n", "listed").mapInArrow(_search, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """Columns word, root for each row of forms (word, form: acyclic, one form a word): the last word on the way along forms.

    Each round doubles the way gone; n grows fivefold with each step, so the ways are short.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        last, now = now, materialize(now.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        discard(last)
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Columns word, form, root (string), n, n_near, form_n (long) for each word of docs (doc_id, text).

    form is the most frequent near word if it has at least TIMES the word's occurrences, else null, and form_n its n; root is
    reached along forms, the word itself if it has none.
    """
    words = materialize(word_counts(docs, min_length, min_count), "words")
    near = words.join(near_words(words, min_length), "word", "left")
    kept = F.col("form_n") >= TIMES * F.col("n")
    step = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(kept, F.col("form")).alias("form"), F.when(kept, F.col("form_n")).alias("form_n")), "near")
    ends = roots(step.where("form IS NOT NULL"))
    return step.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def sql() -> str:
    """DuckDB SQL for variants(documents): near words by their deletions, checksums byte by byte."""
    return f"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step
  FROM (SELECT unnest(range(256)) AS i)
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS raw FROM documents
), run AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM found GROUP BY ALL
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))),
    lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]))) AS h
  FROM run, steps
), edited AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM summed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), less AS MATERIALIZED (
  SELECT DISTINCT word, n, left(word, i::INT) || substr(word, i::INT + 2) AS cut FROM words, unnest(range(length(word))) AS u(i)
), gaps AS MATERIALIZED (
  SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS cut FROM words, unnest(range(length(word))) AS u(i)
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.cut = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), step AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= {TIMES} * w.n THEN b.form END AS form, CASE WHEN b.form_n >= {TIMES} * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), way AS (
  SELECT word, word AS root FROM step
  UNION ALL SELECT way.word, step.form FROM way JOIN step ON way.root = step.word WHERE step.form IS NOT NULL
)
SELECT s.word, s.form, w.root, s.n, s.n_near, s.form_n
FROM step s JOIN (SELECT way.word, way.root FROM way JOIN step e ON way.root = e.word WHERE e.form IS NULL) w ON s.word = w.word
"""
