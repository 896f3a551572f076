"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs (lines, long ones at sentence ends); each distinct paragraph gets a key: 40 bits of
digest and 24 bits that check them. A sketch of size s has three tables of s cells; a key is added to one cell of each
(count + 1, key XOR), and to a total. Subtracting two versions' sketches cancels the paragraphs they share; peeling then
reads a key from every cell that holds a single one, removes it from its other cells, and goes on. A subtraction that does
not peel to nothing is repeated with a larger sketch. With n keys in both sketches together and D recovered ones, the
likeness of two versions is (n - D) / (n + D), the Jaccard index of their paragraphs.

A text's fingerprint is the sketch of the size that fits its number of paragraphs: it peels by itself with few exceptions,
so two fingerprints alone tell what two versions differ in, and the first sketch of a pair has the larger one's size.

Cells are rows: filling, subtracting and peeling are explodes and sums by (row, cell), whatever a text's length.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

TABLES, CHECK_BITS, LEAST_SIZE = 3, 24, 8
#: Tables peeled one after the other before a larger sketch is tried.
ROUNDS = 9
#: A paragraph is a line; from this many characters on it ends at the next end of a sentence.
PIECE_CHARS = 160
_PIECES = rf"[^\n]{{{PIECE_CHARS},}}?[.!?](?=\s)|[^\n]+"
#: Rows that aren't cells: how many keys were recovered, how many were added.
FOUND, ADDED = -1, -2
_PREFIX = 8
#: Keys that one task deals to cells.
PART_KEYS = 1 << 16


def paragraph_keys(text: Column) -> Column:
    """Distinct keys of a text's paragraphs (array of long): the digest's upper 40 bits, then 24 bits of a hash of them."""
    digests = F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), lambda p: F.shiftright(F.xxhash64(F.trim(p)), CHECK_BITS))
    return F.array_distinct(F.transform(digests, _with_check))


def _with_check(digest: Column) -> Column:
    return F.shiftleft(digest, CHECK_BITS).bitwiseOR(F.xxhash64(digest).bitwiseAND((1 << CHECK_BITS) - 1))


def own_size(keys: str) -> Column:
    """Cells of each table for a column of keys: the power of two that is not under their number."""
    bits = F.length(F.bin(F.greatest(F.size(keys), F.lit(1)) - 1))
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(bits, F.lit(LEAST_SIZE.bit_length() - 1)))


def _cell(key: Column, table: Column, size: Column) -> Column:
    return F.xxhash64(key, table).bitwiseAND(size - 1) + table * size


def sketch(entries: DataFrame, *by: str) -> DataFrame:
    """by, size, at, c, k: the cells that aren't empty, and the total at ADDED; entries: by, size, c (1 or, to subtract, -1), k (key)."""
    each = entries.select(*by, "size", "c", "k", F.explode(F.array(*map(F.lit, range(TABLES + 1)))).alias("t"))
    total = F.col("t") == TABLES
    at = F.when(total, F.lit(ADDED)).otherwise(_cell(F.col("k"), F.col("t"), F.col("size")))
    rows = each.select(*by, "size", at.cast("long").alias("at"), F.when(total, 1).otherwise(F.col("c")).cast("long").alias("c"), F.when(total, 0).otherwise(F.col("k")).cast("long").alias("k"))
    return _merged(rows, *by)


def _merged(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "size", "at").agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k")).where("c != 0 OR k != 0")


def _peel_table(cells: DataFrame, table: int, *by: str) -> DataFrame:
    """cells with every key that is alone in a cell of this table taken out of all tables and counted at FOUND (and kept in `digest`, if it is in by).

    A key lies in one cell of a table, so it is read once.
    """
    begin = F.lit(table) * F.col("size")
    alone = (F.col("at") >= begin) & (F.col("at") < begin + F.col("size")) & (F.abs(F.col("c")) == 1) & (_with_check(F.shiftright("k", CHECK_BITS)) == F.col("k"))
    keep = [F.col("digest")] if "digest" in by else []

    def row(at, c, k, *digest):
        return F.struct(at.cast("long").alias("at"), c.cast("long").alias("c"), k.cast("long").alias("k"), *(d.cast("long").alias("digest") for d in digest))

    others = [row(_cell(F.col("k"), F.lit(t), F.col("size")), -F.col("c"), F.col("k"), *(F.lit(0) for _ in keep)) for t in range(TABLES) if t != table]
    found = row(F.lit(FOUND), F.lit(1), F.lit(0), *(F.col("k") for _ in keep))
    moved = F.when(alone, F.array(found, *others)).otherwise(F.array(row(F.col("at"), F.col("c"), F.col("k"), *keep)))
    rows = cells.select(*[b for b in by if b != "digest"], "size", F.explode(moved).alias("x")).select(*[b for b in by if b != "digest"], "size", "x.*")
    return _merged(rows, *by)


def peel(cells: DataFrame, *by: str, rounds: int = ROUNDS) -> DataFrame:
    for r in range(rounds):
        cells = _peel_table(cells, r % TABLES, *by)
    return cells


def _parts(keys: int) -> int:
    """Partitions for so many keys: a key is a few bytes until it is dealt to cells, so Spark's own sizes would be far too large."""
    return max(1, -(-keys // PART_KEYS))


def differences(pairs: DataFrame, first: int = 1, digests: bool = False) -> DataFrame:
    """rid, kind, n (keys of both sides), d (keys recovered from the difference); digests: and one row for each recovered key, in `digest`.

    pairs: rid (long), kind (int), a, b (arrays of keys), one row for each rid and kind. Pairs without a key on either side
    are absent. first multiplies the first sketch's size; pairs that do not peel go on with four times as many cells.
    """
    out, left, factor = None, pairs, first
    keys = pairs.agg(F.sum(F.size("a") + F.size("b"))).first()[0] or 0
    by = ("rid", "kind", *(["digest"] if digests else []))
    while True:
        side = lambda keys, c: F.transform(keys, lambda x: F.struct(F.lit(c).alias("c"), x.alias("k")))
        size = F.greatest(own_size("a"), own_size("b")) * factor
        # Dealt by rid before the explode: no later step of the sketch shuffles.
        entries = left.repartition(_parts(keys), "rid").select("rid", "kind", size.alias("size"), F.explode(F.concat(side("a", 1), side("b", -1))).alias("e")).select("rid", "kind", "size", "e.c", "e.k", *([F.lit(0).cast("long").alias("digest")] if digests else []))
        cells = peel(sketch(entries, *by), *by)
        counts = [F.sum(F.when(F.col("at") == ADDED, F.col("c"))).alias("n"), F.coalesce(F.sum(F.when(F.col("at") == FOUND, F.col("c"))), F.lit(0)).alias("d"), F.count(F.when(F.col("at") >= 0, 1)).alias("open")]
        kept = [F.collect_list(F.when(F.col("at") == FOUND, F.col("digest"))).alias("digests")] if digests else []
        got = materialize(cells.groupBy("rid", "kind").agg(*counts, *kept), "peeled")
        done = got.where("open = 0").drop("open")
        out = done if out is None else out.unionByName(done)
        keys = got.where("open > 0").agg(F.sum("n")).first()[0]
        if not keys:
            return out
        failed = got.where("open > 0").select("rid", "kind")
        left = pairs.join(failed, ["rid", "kind"], "left_semi")
        factor *= 4


def fingerprints(texts: DataFrame) -> DataFrame:
    """rid, own, new: the sketches of the key arrays own and new as text; texts: rid, own, new.

    Written in hex: the size, then for each cell that isn't empty its place, count and key, by place.
    """
    keys = texts.agg(F.sum(F.size("own") + F.size("new"))).first()[0] or 0
    both = texts.repartition(_parts(keys), "rid").select("rid", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("own").alias("keys")), F.struct(F.lit(1).alias("kind"), F.col("new").alias("keys")))).alias("x")).select("rid", "x.kind", own_size("x.keys").alias("size"), F.explode("x.keys").alias("k"))
    cells = sketch(both.withColumn("c", F.lit(1)), "rid", "kind").where(F.col("at") >= 0)
    shown = F.concat_ws(".", F.hex("at"), F.hex("c"), F.hex("k"))
    text = F.array_join(F.sort_array(F.collect_list(F.struct("at", shown.alias("s"))))["s"], ",")
    named = cells.groupBy("rid", "kind", "size").agg(text.alias("s")).select("rid", "kind", F.lower(F.concat(F.hex("size"), F.lit(","), "s")).alias("s"))
    return named.groupBy("rid").agg(F.max(F.when(F.col("kind") == 0, F.col("s"))).alias("own"), F.max(F.when(F.col("kind") == 1, F.col("s"))).alias("new"))


def _range_of(key: Column, edges: list[str]) -> Column:
    """Number of the range (the last edge that is not above key): one look over every so-manieth edge, one over those between."""
    step = max(1, math.isqrt(len(edges)))
    parts = [edges[i : i + step] for i in range(0, len(edges), step)]
    known = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    part = F.greatest(F.size(F.filter(known([p[0] for p in parts], "array<string>"), lambda e: e <= key)) - 1, F.lit(0))
    inside = F.greatest(F.size(F.filter(F.element_at(known(parts, "array<array<string>>"), part + 1), lambda e: e <= key)) - 1, F.lit(0))
    return part * step + inside


def with_next(df: DataFrame, rows_per_range: int = 1024, max_ranges: int = 20_000) -> DataFrame:
    """doc_id, text, keys and next_text, next_keys: those of the next row in the order of doc_id, then text; the first row's after the last.

    Rows are dealt to ranges of about as many rows each, whatever their ids: the edges are the first keys of Spark's own
    range partitions of the ids (and, for rows that share one, of their texts' beginnings). The first rows of each range
    are also dealt, as closing rows, to the range before, so every lead is found inside one range. The edges, at most
    max_ranges short strings, and Spark's sample for them (100 for each) are all that passes through the driver.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # As text in the order of the ids: null first, then with the sign bit turned; then the text's first code points.
    order = F.concat(F.when(F.col("doc_id").isNull(), "-").otherwise(F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")), F.lit("/"), F.hex(F.encode(F.substring("text", 1, _PREFIX), "UTF-8")))
    ranges = min(max_ranges, max(1, docs.count() // rows_per_range))
    firsts = docs.select(order.alias("o")).repartitionByRange(ranges, "o").groupBy(F.spark_partition_id()).agg(F.min("o").alias("o"))
    edges = sorted({r["o"] for r in firsts.collect()}) or [""]
    docs = docs.withColumn("keys", paragraph_keys(F.col("text"))).withColumn("o", order)
    docs = docs.withColumn("range", _range_of(F.col("o"), edges))
    # An edge is the first key of its range, so only that row (or its equals) meets it.
    closes = F.element_at(F.from_json(F.lit(json.dumps(edges)), "array<string>"), F.col("range") + 1) == F.col("o")
    here = F.struct(F.col("range").alias("range"), F.lit(0).alias("closing"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(edges))).alias("range"), F.lit(1).alias("closing"))
    dealt = docs.select("doc_id", "text", "keys", F.explode(F.when(closes, F.array(here, before)).otherwise(F.array(here))).alias("at")).select("doc_id", "text", "keys", "at.range", "at.closing")
    # One window for both: two in turn would shuffle the texts twice.
    near = Window.partitionBy("range").orderBy("closing", "doc_id", "text")
    return dealt.select("doc_id", "text", "keys", F.lead("text").over(near).alias("next_text"), F.lead("keys").over(near).alias("next_keys"), "closing").where("closing = 0").drop("closing")


def edited_likeness(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document in the order of doc_id (ties: text; after the last the first). Null texts are empty; a null doc_id comes
    first; doc_ids may be of any 64-bit value, and texts of any length are whole; repeated rows are rows of their own; an
    empty table gives an empty result; other columns are not read.
    """
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    rows = with_next(df).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("keys").alias("own"), F.col("next_keys").alias("following"))
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", paragraph_keys(F.col("edited")).alias("new"), "following")
    rows = materialize(rows, "paragraphs")
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("new").alias("b")), F.struct(F.lit(1).alias("kind"), F.col("following").alias("b")))
    found = differences(rows.select("rid", F.col("own").alias("a"), F.explode(kinds).alias("x")).select("rid", "x.kind", "a", "x.b"))

    def near(kind: int) -> Column:
        return F.max(F.when(F.col("kind") == kind, (F.col("n") - F.col("d")) / (F.col("n") + F.col("d"))))

    found = found.groupBy("rid").agg(near(0).alias("near_edited"), near(1).alias("near_next"))
    prints = fingerprints(rows.select("rid", "own", "new"))
    empty = F.lit(f"{LEAST_SIZE:x},")
    rows = rows.select("rid", "doc_id", "n_chars", "edited_sha256").join(prints, "rid", "left").join(found, "rid", "left")
    # Texts without paragraphs have empty sketches, and two of them are alike.
    return rows.select("doc_id", "n_chars", "edited_sha256", F.coalesce("own", empty).alias("fingerprint"), F.coalesce("new", empty).alias("edited_fingerprint"), F.coalesce("near_edited", F.lit(1.0)).alias("near_edited"), F.coalesce("near_next", F.lit(1.0)).alias("near_next"))
