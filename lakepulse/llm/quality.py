"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees on bounded labelled rows give conjunctive rules (each path from the root); a lasso logistic regression keeps few of
them; those become Spark column expressions over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .common import ship, table

LETTER, DIGIT, UPPER, MARK, SYMBOL = range(5)
KINDS = np.zeros((5, 256), bool)
KINDS[LETTER, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True
KINDS[DIGIT, 48:58] = True
KINDS[UPPER, 65:91] = True
KINDS[MARK, [ord(c) for c in ".,;:!?'\"()-"]] = True
KINDS[SYMBOL, [ord(c) for c in "#$%&*|@^~<>[]{}\\/=+_`"]] = True

STATISTICS = ("n_chars", "n_words", "word_length", "letters", "digits", "uppercase", "marks", "symbols", "stops", "line_words", "distinct_words", "repeated_next", "common_word", "distinct_lines", "long_words", "capital_words")
#: At most so many labelled rows are learned from: those of least hash.
TRAIN_ROWS = 20_000


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; shares of an empty text are 0."""
    data, offsets = tx.utf8(texts)
    words = tx.split(texts)
    size, count = np.diff(offsets).astype(float), words.counts.astype(float)
    per = lambda a, b: np.divide(a, b, out=np.zeros(len(size)), where=b > 0)

    def of(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(words.row, mask, len(size))

    kinds = [of(k[data]) for k in KINDS]
    chars = of((data & 0xC0) != 0x80)
    ends = words.data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    h = tx.hashes(words) >> np.uint64(16)
    key = np.sort((words.row.astype(np.uint64) << np.uint64(48)) | h)
    new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    at = np.flatnonzero(new)
    times, owner = np.diff(np.append(at, len(key))), (key[at] >> np.uint64(48)).astype(int)
    most = np.zeros(len(size))
    np.maximum.at(most, owner, times)
    inside = np.zeros(len(h), bool)
    inside[1:] = (words.row[1:] == words.row[:-1]) & (h[1:] == h[:-1])
    lines = [np.unique(np.fromiter(map(hash, (t.as_py() or "").encode().split(b"\n")), np.int64), return_counts=True)[1] for t in texts]
    n_lines = np.array([c.sum() for c in lines], float)
    length = (words.ends - words.starts).astype(float)
    first = words.data[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    columns = [
        chars, count, per(chars, count), *[per(k, size) for k in kinds], per(of_words(np.isin(ends, [46, 33, 63])), count), per(count, n_lines), per(np.bincount(owner, minlength=len(size)).astype(float), count),
        per(of_words(inside), count), per(most, count), per(np.array([len(c) for c in lines], float), n_lines), per(of_words(length > 9), count), per(of_words(KINDS[UPPER][first]), count),
    ]
    return np.stack(columns, axis=1) if len(size) else np.zeros((0, len(STATISTICS)))


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(row, stats): the kept columns and the statistics of text, as structs."""
    ship(docs.sparkSession)
    inner = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType([T.StructField("row", inner), T.StructField("stats", T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))])

    def measure(batches):
        out = to_arrow_schema(schema)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                stats = statistics(part.column("text"))
                row = part.select(keep).to_struct_array().cast(out.field("row").type)
                yield pa.RecordBatch.from_arrays([row, pa.StructArray.from_arrays([pa.array(c) for c in stats.T], fields=list(out.field("stats").type))], schema=out)

    return docs.select("text", *[c for c in keep if c != "text"]).mapInArrow(measure, schema)


@dataclass(frozen=True)
class Rule:
    terms: tuple[tuple[int, bool, float], ...]  # statistic, above or not, threshold
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(x[:, j] > t) == above for j, above, t in self.terms])

    def column(self) -> Column:
        terms = [F.col(f"stats.{STATISTICS[j]}") > t if above else F.col(f"stats.{STATISTICS[j]}") <= t for j, above, t in self.terms]
        return reduce(lambda a, b: a & b, terms)


def paths(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, terms: tuple = ()) -> list[Rule]:
    """Rules of all paths of a tree that splits at the best Gini gain among random statistics and quantiles."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return []
    best = (0.0, None)
    for j in rng.choice(x.shape[1], 6, replace=False):
        for t in np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 33))):
            above = x[:, j] > t
            n = above.sum()
            if 5 <= n <= len(y) - 5:
                p, q = y[above].mean(), y[~above].mean()
                gain = n * (len(y) - n) / len(y) ** 2 * (p - q) ** 2
                if gain > best[0] + 1e-12:
                    best = (gain, (int(j), float(t)))
    if best[1] is None:
        return []
    j, t = best[1]
    out = []
    for above in (True, False):
        more = (*terms, (j, above, t))
        at = (x[:, j] > t) == above
        out += [Rule(more), *paths(x[at], y[at], depth - 1, rng, more)]
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights with an L1 penalty and an intercept without, by accelerated proximal gradient."""
    n, m = z.shape
    w = v = np.zeros(m + 1)
    a = np.hstack([z, np.ones((n, 1))])
    rate = 4 * n / max(1e-9, np.linalg.norm(a.T @ a, 2))
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - rate * (a.T @ (p - y)) / n
        new[:m] = np.sign(new[:m]) * np.maximum(0, np.abs(new[:m]) - rate * penalty)
        w, v = new, new + (k - 1) / (k + 2) * (new - w)
    return w[:m], float(w[m])


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 0.001, seed: int = 5) -> tuple[list[Rule], float]:
    """Rules with weights, and the intercept. Without labels of both kinds there are no rules."""
    rate = (y.sum() + 1) / (len(y) + 2)
    if not len(y) or y.min() == y.max():
        return [], float(np.log(rate / (1 - rate)))
    rng = np.random.default_rng(seed)
    found: dict[bytes, Rule] = {}
    for _ in range(trees):
        at = rng.integers(0, len(y), min(len(y), 4000))
        for rule in paths(x[at], y[at], depth, rng):
            holds = rule.holds(x)
            if 0 < holds.sum() < len(y):
                found.setdefault(np.packbits(holds).tobytes(), rule)
    rules = list(found.values())
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    weights, intercept = lasso_logistic(z, y, penalty)
    return [Rule(r.terms, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6], intercept


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[list[Rule], float]:
    """Learns from labelled documents outside the held-out quarter: all of them, or the `most` of least hash if there are more."""
    rows = labels.where("doc_id is not null and quality is not null").where(~held_out()).select("doc_id", F.col("quality").cast("double").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    seen = with_statistics(texts, ["doc_id", "quality"]).select("row.doc_id", "row.quality", "stats.*").toPandas().sort_values(["doc_id", "quality", *STATISTICS])
    return fit(seen[list(STATISTICS)].to_numpy(float), seen["quality"].to_numpy(float))


def score(rules: list[Rule], intercept: float) -> Column:
    total = reduce(lambda a, b: a + b, [F.when(r.column(), r.weight).otherwise(0.0) for r in rules], F.lit(intercept))
    return 1 / (1 + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """(row, score) for every whole text of docs: row has the columns `keep`, score is from 0 to 1, higher where label 1 is likelier.

    Null and empty texts have statistics of 0 and a score like any other. Rows without a doc_id count as outside the held-out part and
    are never learned from. Without labels every score is 0.5. Repeated rows have equal scores. An empty table gives an empty result.
    """
    rules, intercept = train(docs, labels)
    return with_statistics(docs, keep).select("row", score(rules, intercept).alias("score"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score_quality(docs, labels, ["doc_id"]).select("row.doc_id", "score")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
