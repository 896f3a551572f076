"""Quality classifier with hierarchical empirical Bayes.

Two logistic models (quality, toxicity) over hashed words, word beginnings and a few shares of character kinds give each
document's own evidence. Their probabilities are averaged over hosts and over paths within hosts by grouped aggregates;
a host's mean is shrunk toward the global prior, a path's toward its host's posterior, with the strength that the
spread between sites calls for (method of moments). A document's log-odds are then moved by the difference between its
path's posterior and the global prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import apart, materialize, texts

BUCKETS = 1 << 18
#: The models are fitted on at most this many labelled rows, those with the smallest hashes of their doc_id.
MAX_LABELLED = 10_000
HEAD_BYTES = 6
MIN_DOCS, LEAST_RATIO, STEPS, RIDGE = 5, 20.0, 300, 1.0
#: Rows of the fit that are worked on at once.
_BLOCK = 256
#: Character kinds whose shares are features: fixed values.
_KINDS = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "bar": "|", "symbol": "%$#&*@^~_=+<>{}[]\\", "bang": "!?", "stop": ".,;:", "line": "\n"}
DENSE = len(_KINDS) + 3


def _kind_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for k, signs in enumerate(_KINDS.values(), 1):
        table[[ord(x) for x in signs]] = k
    return table


_KIND = _kind_table()


def dense(text: str, words: np.ndarray) -> list[float]:
    """Shares of the character kinds, log of the word count, characters per word, share of different words."""
    kinds = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)], minlength=len(_KINDS) + 1)
    n = max(1, len(words))
    shares = kinds[1:] / n
    return [*np.minimum(shares, 5.0).tolist(), float(np.log1p(len(words))) / 5, min(len(text) / n, 30.0) / 10, len(np.unique(words)) / n]


def features(some: list[str]):
    """(buckets of the words that occur and of the word heads that occur once, twice, three times; dense features; words) of each text."""
    for at, offsets, hashes, heads in vectors.words_and_heads(some, HEAD_BYTES):
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            head, times = np.unique(heads[a:b], return_counts=True)
            every = [np.unique(hashes[a:b]), *(vectors.mix(head[times >= n] + np.uint64(n)) for n in (1, 2, 3))]
            yield np.unique((np.concatenate(every) % np.uint64(BUCKETS)).astype(np.int32)), dense(some[at + k], hashes[a:b]), int(b - a)


def _blocks(rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, their rows' numbers) of a few hundred rows at a time: all rows' words at once would be the most that the driver holds."""
    for at in range(0, len(rows), _BLOCK):
        some = rows[at : at + _BLOCK]
        yield np.concatenate(some), np.repeat(np.arange(at, at + len(some)), [len(x) for x in some])


def telling(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets whose presence depends on the label: likelihood ratio of at least LEAST_RATIO, so that chance words stay out."""
    n, ones = len(y), float(y.sum())
    held, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for words, row in _blocks(rows):
        held += np.bincount(words, minlength=BUCKETS)
        good += np.bincount(words, weights=y[row], minlength=BUCKETS)

    def part(seen: np.ndarray, total: np.ndarray, all_seen: float) -> np.ndarray:
        expected = np.maximum(total * all_seen / max(n, 1), 1e-12)
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / expected), 0.0)

    ratio = 2 * (part(good, held, ones) + part(held - good, held, n - ones) + part(ones - good, n - held, ones) + part(n - ones - held + good, n - held, n - ones))
    return np.flatnonzero((held >= MIN_DOCS) & (ratio >= LEAST_RATIO))


def fit(rows: list[np.ndarray], extra: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Logistic models, one for each column of labels, over its telling words and the standardised dense features."""
    n = len(rows)
    mean, spread = (extra.mean(0), extra.std(0) + 1e-6) if n else (np.zeros(DENSE), np.ones(DENSE))
    z = (extra - mean) / spread
    out = {"mean": mean, "spread": spread, "dense": np.zeros((labels.shape[1], DENSE)), "bias": np.zeros(labels.shape[1])}
    for k in range(labels.shape[1]):
        y = labels[:, k]
        seen = telling(rows, y) if n else np.zeros(0, dtype=np.int64)
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[seen] = np.arange(len(seen))
        kept = [(place[words[k]], row[k]) for words, row in _blocks(rows) for k in (place[words] >= 0,)]
        column, at = (np.concatenate(x) for x in zip(*kept, strict=True)) if n else (np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
        del kept
        rate = (y.sum() + 1) / (n + 2)
        w, d, bias = np.zeros(len(seen)), np.zeros(DENSE), float(np.log(rate / (1 - rate)))
        g_w, g_d, g_b = np.zeros(len(seen)), np.zeros(DENSE), 0.0  # running squares of the gradients
        for _ in range(STEPS if n else 0):
            score = np.bincount(at, weights=w[column], minlength=n) + z @ d + bias
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - y
            step = np.bincount(column, weights=error[at], minlength=len(seen)) + RIDGE * w
            step_d, step_b = z.T @ error + RIDGE * d, error.sum()
            g_w, g_d, g_b = 0.9 * g_w + 0.1 * step**2, 0.9 * g_d + 0.1 * step_d**2, 0.9 * g_b + 0.1 * step_b**2
            w, d, bias = w - 0.05 * step / np.sqrt(g_w + 1e-9), d - 0.05 * step_d / np.sqrt(g_d + 1e-9), bias - 0.05 * step_b / np.sqrt(g_b + 1e-9)
        out |= {f"seen{k}": seen.astype(np.int32), f"words{k}": w}
        out["dense"][k], out["bias"][k] = d, bias
    return out


def _views(chunk: pa.Array) -> Iterator[np.ndarray]:
    """The 32-bit integers of each binary value, without a copy."""
    ends = np.frombuffer(chunk.buffers()[1], dtype="<i4")[chunk.offset : chunk.offset + len(chunk) + 1] // 4
    data = np.frombuffer(chunk.buffers()[2] or b"", dtype="<i4", count=int(ends[-1]))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield data[a:b]


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[str, np.ndarray]:
    """Models from the labelled rows of docs (doc_id, text), at most max_labelled of them; only their features come to the driver.

    Rows that agree in doc_id, text and labels count once.
    """
    picked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(max_labelled)
    names = ["words", "dense", "doc_id", "t", "quality", "toxic"]

    def each(batches):
        for batch in batches:
            got = [x for some in texts(batch.column(0)) for x in features(some)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0].astype("<i4").tobytes() for x in got], pa.binary()), pa.array([x[1] for x in got], pa.list_(pa.float64())), *batch.columns[1:]], names=names)

    # At most max_labelled ids: a broadcast of fixed size. A doc_id may have many rows, so the bound is kept after the join too.
    joined = docs.withColumn("t", F.xxhash64("text")).join(F.broadcast(picked), "doc_id").select("text", "doc_id", "t", "quality", "toxic")
    rows = joined.mapInArrow(each, "words binary, dense array<double>, doc_id long, t long, quality int, toxic int").dropDuplicates(["doc_id", "t", "quality", "toxic"])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "t", "quality", "toxic").limit(max_labelled).toArrow()
    words = [x for chunk in rows.column("words").chunks for x in _views(chunk)]
    extra = np.array(rows.column("dense").to_pylist(), dtype=float).reshape(len(words), DENSE)
    marks = np.stack([rows.column(c).to_numpy().astype(float) for c in ("quality", "toxic")], axis=1) if len(words) else np.zeros((0, 2))
    return fit(words, extra, marks)


def score(docs: DataFrame, model: dict[str, np.ndarray], *others: str) -> DataFrame:
    """docs' columns without text, n_words, and the log-odds z_quality and z_toxic of each document alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != "text"]

    def each(batches):
        m = held.value
        table = np.zeros((2, BUCKETS))
        for k in range(2):
            table[k, m[f"seen{k}"]] = m[f"words{k}"]
        for batch in batches:
            z, n = [], []
            for some in texts(batch.column("text")):
                for words, extra, count in features(some):
                    z.append(table[:, words].sum(axis=1) + m["dense"] @ ((np.array(extra) - m["mean"]) / m["spread"]) + m["bias"])
                    n.append(count)
            got = np.array(z).reshape(len(n), 2)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(n, pa.int64()), pa.array(got[:, 0]), pa.array(got[:, 1])], names=[*columns, "n_words", "z_quality", "z_toxic"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(each, f"{fields}, n_words long, z_quality double, z_toxic double")


def _logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def _log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(means: DataFrame, kind: str, prior: str) -> float:
    """Prior observations that a group's mean is worth, from the spread of the groups' means around their priors."""
    n, m = F.col("n"), F.col(prior)
    r = means.agg(F.sum(n), F.sum(n * (F.col(f"m_{kind}") - m) ** 2), F.sum(F.col(f"v_{kind}")), F.avg(m), F.count("*")).first()
    if not r[0] or r[4] < 2:
        return 100.0
    within = r[2] / r[0]  # variance of a document around its group
    between = max((r[1] - within * r[4]) / r[0], 1e-6)
    return float(min(max(within / between, 1.0), 1e6))


def posteriors(scored: DataFrame) -> DataFrame:
    """host, path, shift_quality, shift_toxic: how far each site moves its documents' log-odds.

    scored: host, path, z_quality, z_toxic. Sums are pre-aggregated per task, so a hot host is a row of each.
    """
    kinds = ("quality", "toxic")
    sums = [F.count("*").alias("n")] + [f(_logistic(F.col(f"z_{k}")) ** e).alias(f"{a}_{k}") for k in kinds for f, e, a in ((F.sum, 1, "s"), (F.sum, 2, "q"))]
    paths = materialize(scored.groupBy("host", "path").agg(*sums), "sites")
    total = paths.agg(F.sum("n"), *[F.sum(f"s_{k}") for k in kinds]).first()
    prior = {k: (total[i + 1] or 0.0) / max(1, total[0] or 0) for i, k in enumerate(kinds)}

    def described(rows: DataFrame) -> DataFrame:
        return rows.withColumns({f"m_{k}": F.col(f"s_{k}") / F.col("n") for k in kinds} | {f"v_{k}": F.col(f"q_{k}") - F.col(f"s_{k}") ** 2 / F.col("n") for k in kinds})

    hosts = described(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"{a}_{k}").alias(f"{a}_{k}") for k in kinds for a in "sq"])).withColumns({f"g_{k}": F.lit(prior[k]) for k in kinds})
    for k in kinds:
        a = _strength(hosts, k, f"g_{k}")
        hosts = hosts.withColumn(f"h_{k}", (F.col(f"s_{k}") + a * F.lit(prior[k])) / (F.col("n") + a))
    sites = described(paths).join(hosts.select("host", *[f"h_{k}" for k in kinds]).withColumnRenamed("host", "host_"), F.col("host").eqNullSafe(F.col("host_"))).drop("host_")
    for k in kinds:
        b = _strength(sites, k, f"h_{k}")
        post = (F.col(f"s_{k}") + b * F.col(f"h_{k}")) / (F.col("n") + b)
        sites = sites.withColumn(f"shift_{k}", _log_odds(post) - _log_odds(F.lit(prior[k])))
    return sites.select("host", "path", *[f"shift_{k}" for k in kinds])


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, p_quality, p_toxic, site_quality, site_toxic (the site's share in the log-odds), keep; one row per input row.

    keep: has words, p_quality at least 0.5 and p_toxic at most 0.5. Null texts count as empty, which are never kept. Null
    hosts and paths are sites of their own. Without labelled rows every document with words is kept at 0.5. A doc_id with
    several different labels counts once for each; repeated rows stay; texts of any length are read whole; an empty table
    gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    model = train(docs.select("doc_id", "text"), labels, max_labelled)
    scored = materialize(score(docs, model), "scored")
    return decide(scored, posteriors(scored)).select("doc_id", "p_quality", "p_toxic", "site_quality", "site_toxic", "keep")


def decide(scored: DataFrame, sites: DataFrame) -> DataFrame:
    """scored with p_quality, p_toxic, the sites' shifts and keep. Sites are few against documents; Spark sizes the join."""
    sites = sites.select(F.col("host").alias("host_"), F.col("path").alias("path_"), F.col("shift_quality").alias("site_quality"), F.col("shift_toxic").alias("site_toxic"))
    rows = scored.join(sites, F.col("host").eqNullSafe(F.col("host_")) & F.col("path").eqNullSafe(F.col("path_"))).drop("host_", "path_")
    rows = rows.withColumn("p_quality", F.when(F.col("n_words") == 0, 0.0).otherwise(_logistic(F.col("z_quality") + F.col("site_quality")))).withColumn("p_toxic", F.when(F.col("n_words") == 0, 0.0).otherwise(_logistic(F.col("z_toxic") + F.col("site_toxic"))))
    return rows.withColumn("keep", (F.col("n_words") > 0) & (F.col("p_quality") >= 0.5) & (F.col("p_toxic") <= 0.5))


def keep(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """df's rows that classify() keeps, with all of df's columns; rows are matched by doc_id and a hash of the text.

    Null and empty texts have no words and go; a null doc_id, host or path is a value like others; repeated rows stay or go
    together; very long texts are read whole; an empty table gives an empty result; df's columns may have any names.
    """
    hashed = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path")).withColumn("t", F.xxhash64("text"))
    model = train(docs.select("doc_id", "text"), labels, max_labelled)
    scored = materialize(score(docs, model), "scored")
    d, t, h, p = apart(df, "kept_id", "kept_hash", "kept_host", "kept_path")
    # The site decides too: of rows that agree in doc_id and text, each host's and path's is judged on its own.
    kept = decide(scored, posteriors(scored)).where("keep").select(F.col("doc_id").alias(d), F.col("t").alias(t), F.col("host").alias(h), F.col("path").alias(p)).distinct()
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(d)) & (hashed == F.col(t)) & F.col(f"`{host_col}`").cast("string").eqNullSafe(F.col(h)) & F.col(f"`{path_col}`").cast("string").eqNullSafe(F.col(p))
    return df.join(materialize(kept, "kept"), same, "left_semi")
