"""SimHash near-dedup over multi-index Hamming tables, and the stage that keeps one document of each group.

Fingerprints: 64 bits over word shingles; a bit is set if it is set in over half of the shingles' XXH64.

Search within distance 2: the fingerprint is cut into two 32-bit segments. Within each segment the ball of radius 1 is
enumerated (32 flips, and the unflipped value), and the table key is the flipped segment together with the other,
unflipped one. Two fingerprints within distance 2 share such a key: flips in one segment meet at the point between
them, one flip in each segment meets where one has flipped the first and the other the second. A key is within
distance 1 of all its members, so a table entry holds at most 65 different fingerprints: no bucket is ever hot, however
many near copies share a segment. Matches of a key are chained in order and their complete distance is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vectors
from .common import apart, discard, hex64, materialize, texts
from .graph import components

SEGMENTS, SEGMENT_BITS = 2, 32
_STEP = 1 << 16


def shingle_hashes(text: str, width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the text's word shingles, in arrays of bounded length; A-Z lower-cased, fewer words than width: one shingle of all."""
    words = text.encode().lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - width + 1, _STEP):
        pairs = zip(starts[at : at + _STEP], ends[at + width - 1 : at + width - 1 + _STEP], strict=False)
        yield np.array([digest(line[a:b], seed) for a, b in pairs], dtype="<u8")


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash of one text; 0 without words."""
    n, ones = 0, np.zeros(64, dtype=np.int64)
    for h in shingle_hashes(text, width, seed):
        n += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (long) for every row. Null and empty texts have fingerprint 0; repeated rows stay repeated."""

    def each(batches):
        for batch in batches:
            got = [fingerprint(t, width, seed) for some in texts(batch.column(1)) for t in some]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64())], names=["doc_id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, "doc_id long, fp long")


def hamming_links(points: DataFrame, radius: int = 2) -> DataFrame:
    """u, v: verified links between the names rep of the different fingerprints of points (fp, rep), enough to connect all within the radius (0 to 2).

    Each link joins two fingerprints at most radius apart; fingerprints at most radius apart are joined by a path of
    links. No two points may share a name: a name stands for its fingerprint.
    """
    if radius not in (0, 1, 2):
        raise ValueError("the tables hold balls of radius 1: they find distances up to 2")
    if radius == 0:
        return points.select(F.col("rep").alias("u"), F.col("rep").alias("v")).limit(0)
    flips = [0, *(1 << (SEGMENT_BITS * s + b) for s in range(SEGMENTS) for b in range(SEGMENT_BITS))]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips])
    entries = points.select("fp", "rep", F.explode(masks).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("key"), "fp", "rep")
    near = Window.partitionBy("key").orderBy("rep")
    chained = entries.select("fp", "rep", F.lag("fp").over(near).alias("fp0"), F.lag("rep").over(near).alias("rep0"))
    if radius == 1:
        # A pair at distance 1 meets at either of its own two points: all of a key's members against the member that is the key.
        own = Window.partitionBy("key")
        chained = entries.select("fp", "rep", F.max(F.when(F.col("key") == F.col("fp"), F.col("fp"))).over(own).alias("fp0"), F.max(F.when(F.col("key") == F.col("fp"), F.col("rep"))).over(own).alias("rep0"))
    return chained.where(F.col("rep0").isNotNull() & (F.col("rep") != F.col("rep0")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp0"))) <= radius)).select(F.col("rep0").alias("u"), F.col("rep").alias("v"))


def near_duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable through links of at most radius bits).

    One row per input row. Equal fingerprints are grouped before the search, so thousands of copies are one point of it, and
    the fingerprint is the point's name: rows that share a doc_id but not a text are points of their own. Null texts count
    as empty ones (fingerprint zero, linked like any other). Rows with a null doc_id are searched and link like all others,
    a null is only never the smallest id; a component of which all doc_ids are null has a null component_id. An empty
    table gives an empty result; other columns are not read.
    """
    docs = materialize(fingerprints(df, id_col, text_col, width), "simhash")
    points = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    found = components(hamming_links(points.select("fp", F.col("fp").alias("rep")), radius))
    placed = materialize(points.join(found, points.fp == found.node, "left").select("fp", "first_id", F.coalesce("component", "fp").alias("c")), "placed")
    least = materialize(placed.groupBy("c").agg(F.min("first_id").alias("component_id")), "components")
    named = materialize(placed.join(least, "c").select("fp", "component_id"), "named")
    return docs.join(named, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


# --- Groups by similarity of shingle sets -------------------------------------------------------------------------------
#
# The fingerprints' Hamming tables give the closest candidates. Texts whose 5-word shingles have a Jaccard index of 0.8
# differ in 9 bits of 64 on average and in up to 18, where no table of Hamming balls finds them all: candidates farther
# apart come from min-wise samples of the shingles (bands of rows that agree wholly). Both kinds are verified by the exact
# index. Only pairs whose sets' sizes rule the similarity out aren't verified; a SimHash distance rules nothing out.

BANDS, ROWS = 16, 3
#: Up to so many members of a bucket are compared each with each; in a larger one each is compared with three of them first.
SMALL_BUCKET = 8
#: Columns of one 0/1 matrix over a block's shingles.
_COLUMNS = 4096
_ODD = np.random.default_rng(5).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(some: list[str], width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(hash of the word sequence, number of different shingles, band keys) of each text; texts without words have keys of their own."""
    for _, offsets, hashes in vectors.words(some):
        every = vectors.shingles(hashes, width)
        parts = [every[a : b - width + 1] if b - a >= width else vectors.text_shingles(hashes[a:b], width) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        parts = [p if len(p) else np.zeros(1, dtype=np.uint64) for p in parts]
        starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
        h = np.concatenate(parts)
        least = np.stack([np.minimum.reduceat(vectors.mix(h * odd) if k == 0 else h * odd + (h >> np.uint64(k % 29 + 3)), starts) for k, odd in enumerate(_ODD)])
        keys = np.zeros((BANDS, len(parts)), dtype=np.uint64)
        for band in range(BANDS):
            for k in range(ROWS):
                keys[band] = vectors.mix(keys[band] * np.uint64(31) + least[band * ROWS + k] + np.uint64(band + 1))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            yield xxhash.xxh64_intdigest(hashes[a:b].tobytes()) - (1 << 63), len(np.unique(parts[i])), keys[:, i].view("<i8")


def hamming_pairs(points: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs a, b of w that the Hamming tables find, enough to connect all w with fingerprints at most radius apart; points: w, fp.

    Each w is paired with the smallest of its own fingerprint, and these stand for the fingerprints in the tables.
    """
    prints = materialize(points.groupBy("fp").agg(F.min("w").alias("rep"), F.count("*").alias("n")), "prints")
    many = prints.where("n > 1").select("fp", "rep")
    own = points.select("w", "fp").join(many, "fp").where("w != rep").select(F.col("rep").alias("a"), F.col("w").alias("b"))
    found = materialize(hamming_links(prints.select("fp", "rep"), radius).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).unionByName(own).distinct(), "near")
    discard(prints)
    return found


def band_pairs(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs a, b of w that share a band, and the members key, w of the crowded bands; points: w (hash of the word sequence), bands.

    In a bucket of more than SMALL_BUCKET members each is paired with the two members that share most with others (the
    originals of a large group are in nearly all of its buckets) and with the smallest one: links grow with a group's
    size and not with its square, and no bucket is gathered. What these pairs leave apart, crowd_links() compares.
    """
    entries = points.select("w", F.explode("bands").alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(entries.join(sizes, "key"), "buckets")
    mass = shared.groupBy("w").agg(F.sum("n").alias("mass"))
    small = shared.where(F.col("n") <= SMALL_BUCKET).groupBy("key").agg(F.array_sort(F.collect_list("w")).alias("all"))
    small = small.select(F.explode(F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, SMALL_BUCKET), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
    large = materialize(shared.where(F.col("n") > SMALL_BUCKET).join(mass, "w").select("key", "w", "mass"), "crowds")
    first = materialize(large.groupBy("key").agg(F.max(F.struct("mass", F.bitwise_not("w").alias("r"))).alias("top"), F.min("w").alias("low")).select("key", F.bitwise_not("top.r").alias("hub"), "low"), "hubs")
    # Aggregate and join are written before the next step by the same key: only so can AQE split a join where one bucket is hot.
    stars = materialize(large.join(first, "key"), "stars")
    second = materialize(stars.where("w != hub").groupBy("key").agg(F.max(F.struct("mass", F.bitwise_not("w").alias("r"))).alias("top")).select("key", F.bitwise_not("top.r").alias("hub2")), "hubs")
    hung = stars.join(second, "key").select("w", F.explode(F.array_distinct(F.array("hub", "hub2", "low"))).alias("hub")).where("w != hub")
    return small.unionByName(hung.select(F.least("w", "hub").alias("a"), F.greatest("w", "hub").alias("b"))), large.select("key", "w")


def allowed(pairs: DataFrame, points: DataFrame, min_similarity: float) -> DataFrame:
    """The different pairs a, b whose sets' sizes allow the similarity; points: w, size (of the shingle set)."""
    sizes = points.select("w", "size")
    pairs = pairs.distinct().join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    return pairs.where(F.least("na", "nb") >= F.lit(min_similarity) * F.greatest("na", "nb") - 1e-9).select("a", "b")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other, by products of 0/1 matrices over a few thousand elements at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = held > 1
    number = np.cumsum(many) - 1
    used = many[place]
    rows, place = rows[used], number[place[used]]
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for at in range(0, int(many.sum()), _COLUMNS):
        a, b = np.searchsorted(place, [at, at + _COLUMNS])
        ones = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        ones[rows[a:b], place[a:b] - at] = 1
        out += ones @ ones.T
    return out


def crowd_links(members: DataFrame, min_similarity: float, block_texts: int = 128, block_bytes: int = 16 << 20) -> DataFrame:
    """u, v: pairs of classes c that hold two similar members of one bucket; members: key, c, shingles (sorted 64-bit hashes).

    The exact way for crowded buckets: all members of different classes are compared. A bucket's largest class is set
    against the others only, never against itself. Members are salted into blocks of bounded number and bytes, and each
    pair of blocks is one group; it gives at most one link for each pair of classes, not the similar pairs.
    """
    size = F.octet_length("shingles")
    classes = members.groupBy("key", "c").agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    buckets = classes.groupBy("key").agg(F.count("*").alias("classes"), F.max(F.struct("n", "c")).alias("top"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "size")).alias("main"))

    def blocks(n, total):
        return F.greatest(F.ceil(n / block_texts), F.ceil(total / block_bytes), F.lit(1)).cast("int")

    buckets = buckets.where("classes > 1").select("key", F.col("top.c").alias("top"), blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("rest"), blocks(F.col("main.n"), F.col("main.size")).alias("mains"))
    # Written, as an aggregate by key has no shuffle of its own that AQE could split.
    buckets = materialize(buckets, "blocks")
    placed = members.join(buckets, "key").withColumn("other", F.col("c") != F.col("top"))
    # The members' order among equals is theirs alone: a lost task gives the same blocks again.
    block = F.pmod(F.xxhash64("shingles", "c"), F.when(F.col("other"), F.col("rest")).otherwise(F.col("mains"))).cast("int")
    placed = placed.withColumn("block", block)
    against_rest = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda j: F.struct(F.lit(True).alias("inner"), F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    against_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: F.struct(F.lit(False).alias("inner"), F.col("block").alias("i"), j.alias("j")))
    as_main = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda i: F.struct(F.lit(False).alias("inner"), i.alias("i"), F.col("block").alias("j")))
    spread = placed.select("key", "c", "shingles", F.explode(F.when(F.col("other"), F.concat(against_rest, against_main)).otherwise(as_main)).alias("at")).select("key", "at.inner", "at.i", "at.j", "c", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        classes = group.column("c").to_numpy()
        if len(np.unique(classes)) < 2:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        sets = [np.frombuffer(x.as_py(), dtype="<u8") for x in group.column("shingles")]
        sizes = np.array([len(x) for x in sets], dtype=np.float64)
        common = _overlaps(sets)
        good = common >= min_similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        a, b = np.nonzero(good & (classes[:, None] < classes[None, :]))
        found = np.unique(np.stack([classes[a], classes[b]], axis=1), axis=0)
        return pa.table({"u": pa.array(found[:, 0], pa.int64()), "v": pa.array(found[:, 1], pa.int64())})

    # Dealt by the whole group: partitioning by key alone would do for Spark, and would leave a bucket's blocks in one task.
    return spread.repartition("key", "inner", "i", "j").groupBy("key", "inner", "i", "j").applyInArrow(compare, "u long, v long")


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, min_similarity: float = 0.8) -> DataFrame:
    """doc_id, t (hash of the text), group (smallest doc_id of the group) and group_t (that document's t) for each row.

    A link is a Jaccard index of at least min_similarity between two texts' sets of word shingles (A-Z lower-cased; fewer
    words than width: one shingle of all). Candidates come from the Hamming tables of the texts' SimHash fingerprints
    (three-word shingles, two bits), and, as these reach only the closest, from the bands and the crowded buckets. Null texts count as empty; texts without words are copies of each other; a
    null doc_id is the smallest; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))

    def sign(batches):
        for batch in batches:
            got, prints = [], []
            for some in texts(batch.column(2)):
                got += signatures(some, width)
                prints += [fingerprint(x) for x in some]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in got], pa.int64()), pa.array([x[1] for x in got], pa.int64()), pa.array([x[2] for x in got], pa.list_(pa.int64())), pa.array(prints, pa.int64())], names=["d", "t", "w", "size", "bands", "fp"])

    slim = materialize(docs.mapInArrow(sign, "d long, t long, w long, size long, bands array<long>, fp long"), "signatures")
    points = materialize(slim.select("w", "size", "bands", "fp").dropDuplicates(["w"]), "points")
    near = hamming_pairs(points)
    banded, crowds = band_pairs(points)
    pairs = materialize(allowed(near.unionByName(banded), points, min_similarity), "pairs")
    discard(near)
    first = slim.groupBy("w").agg(F.min(F.struct("d", "t")).alias("at"))

    def sets(batches):
        for batch in batches:
            out = []
            for some in texts(batch.column(1)):
                for _, offsets, hashes in vectors.words(some):
                    out += [np.unique(vectors.text_shingles(hashes[a:b], width)).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["w", "shingles"])

    def shingle_sets(wanted: DataFrame) -> DataFrame:
        """w, shingles of every wanted w."""
        rows = docs.join(wanted.join(first, "w").select("w", "at.d", "at.t"), ["d", "t"])
        return materialize(rows.select("w", "text").mapInArrow(sets, "w long, shingles binary").dropDuplicates(["w"]), "sets")

    held = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct())

    def verify(batches):
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(k)[i].as_py(), dtype="<u8") for k in (2, 3))
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(common >= min_similarity * (len(a) + len(b) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(good, pa.bool_()))

    links = pairs.join(held.toDF("a", "sa"), "a").join(held.toDF("b", "sb"), "b").select("a", "b", "sa", "sb").mapInArrow(verify, "u long, v long")
    found = components(links)
    crowds = materialize(crowds.join(found, crowds.w == found.node, "left").select("key", "w", F.coalesce("component", "w").alias("c")), "classes")
    split = materialize(crowds.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key"), "split")
    open_ones = materialize(crowds.join(split, "key", "left_semi"), "open")
    members = open_ones.join(shingle_sets(open_ones.select("w").distinct()), "w").select("key", "c", "shingles")
    joined = components(crowd_links(materialize(members, "members"), min_similarity)).toDF("class", "joined")
    named = slim.select("d", "t", "w").join(found, F.col("w") == F.col("node"), "left").select("d", "t", F.coalesce("component", "w").alias("c"))
    named = named.join(joined, F.col("c") == F.col("class"), "left").select("d", "t", F.coalesce("joined", "c").alias("g"))
    named = materialize(named, "named")
    least = named.groupBy("g").agg(F.min(F.struct("d", "t")).alias("first"))
    return named.join(least, "g").select(F.col("d").alias("doc_id"), "t", F.col("first.d").alias("group"), F.col("first.t").alias("group_t"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, min_similarity: float = 0.8) -> DataFrame:
    """df's rows without near duplicates: of each group the row with the smallest doc_id (then hash of the text) stays, of repeated rows one.

    Null and empty texts are equal texts without words, and a null doc_id is equal to the smallest number: rows that agree in
    both are repeated rows. Very long texts are read whole; an empty table gives an empty result; df's columns may have any names.
    """
    groups = similar_groups(df, id_col, text_col, width, min_similarity)
    kept = materialize(groups.where((F.col("doc_id") == F.col("group")) & (F.col("t") == F.col("group_t"))).groupBy("doc_id", "t").agg(F.count("*").alias("n")), "kept")
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    hashed = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    d, t = apart(df, "kept_id", "kept_hash")
    rows = df.join(kept.select(F.col("doc_id").alias(d), F.col("t").alias(t)), (key == F.col(d)) & (hashed == F.col(t)), "left_semi")
    return rows if kept.where("n > 1").isEmpty() else rows.withColumns({d: key, t: hashed}).dropDuplicates([d, t]).drop(d, t)
