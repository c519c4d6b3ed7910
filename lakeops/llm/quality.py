"""Ordinal cumulative-link regression on graded texts: one weighted score, ordered thresholds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType
from xxhash import xxh32_intdigest

from lakeops.llm.common import ID, TEXT, WordCache, batches, id_and_text, per_worker

WORD_BITS, SHAPES, LEVELS = 18, 24, 16
SIZE = (1 << WORD_BITS) + SHAPES + 4 * LEVELS
#: The model is fitted on at most so many labelled documents of each grade, those with the lowest hash of their id.
PER_GRADE = 4_000
#: Chance of the top grade from which a text is kept.
KEEP_AT = 0.6
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def _token(token: str) -> int:
    """Hash bucket of a token's lower-cased core, with its shape (ending, case) above the bucket's bits."""
    core = _EDGE.sub("", token)
    end = token[-1]
    if not core:
        ending = 0
    elif end in ".,;:?)\"'":
        ending = 1
    elif end == "!":
        ending = 2
    elif end.isalnum():
        ending = 3 if core.isalpha() else 4
    else:
        ending = 5
    case = 0 if not core else 1 if core.islower() else 2 if len(core) > 1 and core.isupper() else 3
    return (ending * 4 + case) << WORD_BITS | xxh32_intdigest(core.lower().encode("utf-8", "surrogatepass")) & ((1 << WORD_BITS) - 1)


def _level(share: float) -> int:
    return min(LEVELS - 1, int(share * LEVELS))


def text_features(text: str, tokens: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text: words it holds, shares of token shapes, levels of length and repetition."""
    found = text.split()
    if not found:
        return np.array([SIZE - 1], np.int32), np.ones(1, np.float32)  # a feature of its own
    codes = np.fromiter(map(tokens.__getitem__, found), np.int64, len(found))
    words = np.unique(codes & ((1 << WORD_BITS) - 1))
    shapes = np.bincount(codes >> WORD_BITS, minlength=SHAPES) / len(found)
    held = np.flatnonzero(shapes)
    lines = [line for line in text.split("\n") if line]
    base = (1 << WORD_BITS) + SHAPES
    levels = [
        base + min(LEVELS - 1, len(found).bit_length()),
        base + LEVELS + _level(len(words) / len(found)),
        base + 2 * LEVELS + _level(1 - len(set(lines)) / max(1, len(lines))),
        base + 3 * LEVELS + min(LEVELS - 2, _level(float((codes[1:] == codes[:-1]).sum()) / len(found))),
    ]
    number = np.concatenate([words, (1 << WORD_BITS) + held, levels]).astype(np.int32)
    value = np.concatenate([np.ones(len(words)), 8 * shapes[held], np.ones(4)]).astype(np.float32)
    return number, value


@dataclass
class CumulativeLink:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]), thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) of each score, a column for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score, float)[:, None], -60, 60)))


def fit(number: np.ndarray, value: np.ndarray, starts: np.ndarray, grade: np.ndarray, grades: int, rounds: int = 300, lasso: float = 0.002, seen: int = 10, prior: np.ndarray | None = None) -> CumulativeLink:
    """Weights and thresholds of most likelihood by full-batch adaptive gradient steps; ``prior`` gives the share of each grade (default: as in the rows).

    Row r holds the features number[starts[r] : starts[r + 1]]. The penalty ``lasso`` on absolute weights keeps the many
    words that say nothing at zero, so that a long text does not add up their noise. Features of fewer than ``seen`` rows are left at zero.
    A grade without rows gets no threshold of its own (it equals its neighbour); with fewer than two grades all rows
    count as that grade.
    """
    rows = len(grade)
    counts = np.bincount(grade, minlength=grades)
    if (counts > 0).sum() < 2:
        top = int(grade[0]) if rows else grades - 1
        return CumulativeLink(np.zeros(SIZE, np.float32), np.where(np.arange(grades - 1) < top, -60.0, 60.0))
    often = np.bincount(number, minlength=SIZE) >= seen
    row = np.repeat(np.arange(rows), np.diff(starts))
    held = often[number]
    number, value, row = number[held], value[held].astype(np.float64), row[held]
    prior = counts if prior is None else np.where(counts > 0, prior, 0)
    share = (prior / prior.sum() * rows / np.maximum(counts, 1))[grade]
    w, w2 = np.zeros(SIZE), np.full(SIZE, lasso * lasso + 1e-8)
    below = np.cumsum(prior)[:-1] / prior.sum()
    t = np.log(np.clip(below, 1e-3, 1 - 1e-3) / (1 - np.clip(below, 1e-3, 1 - 1e-3)))
    t2 = np.full(grades - 1, 1e-8)
    for _ in range(rounds):
        score = np.bincount(row, weights=value * w[number], minlength=rows)
        edges = np.concatenate([[-60.0], t, [60.0]])
        high = 1 / (1 + np.exp(-np.clip(edges[grade + 1] - score, -60, 60)))
        low = 1 / (1 + np.exp(-np.clip(edges[grade] - score, -60, 60)))
        mass = np.maximum(high - low, 1e-9)
        up, down = high * (1 - high) / mass * share, low * (1 - low) / mass * share
        by_score = up - down  # of the negative log likelihood
        g = np.bincount(number, weights=value * by_score[row], minlength=SIZE) / rows
        gt = (np.bincount(grade, weights=down, minlength=grades)[1:] - np.bincount(grade, weights=up, minlength=grades)[:-1]) / rows
        w2 += g * g
        t2 += gt * gt
        step = 0.2 / np.sqrt(w2)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * lasso, 0)
        t = np.maximum.accumulate(t - 0.2 * gt / np.sqrt(t2))
    return CumulativeLink(w.astype(np.float32), t)


def _vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokens = per_worker(lambda: WordCache(_token), "quality tokens")
    for frame in batches(frames, 1_000):
        pairs = [text_features(t, tokens) for t in frame[TEXT]]
        yield pd.DataFrame({"grade": frame["grade"], "number": [n.tobytes() for n, _ in pairs], "value": [v.tobytes() for _, v in pairs]})


def train(docs: DataFrame, graded: DataFrame, grades: int, per_grade: int = PER_GRADE) -> CumulativeLink:
    """A model of ``graded`` (doc_id, grade from 0 to grades - 1) over the texts of ``docs``.

    The sample is bounded: ``per_grade`` rows of each grade, in the order of a hash of doc_id, so it does not depend on
    how the tables are stored. The shares of the grades are those of all labels. Null ids and grades outside the range are left out; an id with several labels or several texts counts with
    each. Only the sample's features, not its texts, reach the driver.
    """
    kept = graded.where(F.col("grade").between(0, grades - 1)).groupBy(F.col("grade").cast("int").alias("grade")).count().collect()
    prior = np.zeros(grades)
    for row in kept:
        prior[row["grade"]] = row["count"]
    labels = graded.select(F.col(ID).cast("long").alias(ID), F.col("grade").cast("int").alias("grade")).where(F.col(ID).isNotNull())
    picks = [labels.where(F.col("grade") == k).orderBy(F.xxhash64(ID), ID).limit(per_grade) for k in range(grades)]
    sample = picks[0]
    for more in picks[1:]:
        sample = sample.union(more)
    found = id_and_text(docs).join(F.broadcast(sample), ID)  # grades * per_grade rows at most
    # repeated rows of one id are one example; a bound on rows as well as on ids
    found = found.groupBy(ID, "grade").agg(F.min(TEXT).alias(TEXT))
    data = found.select("grade", TEXT).mapInPandas(_vectors, "grade int, number binary, value binary").toPandas()
    number = [np.frombuffer(b, np.int32) for b in data["number"]]
    value = [np.frombuffer(b, np.float32) for b in data["value"]]
    starts = np.cumsum([0, *map(len, number)])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return fit(join(number, np.int32), join(value, np.float32), starts, data["grade"].to_numpy(np.int64), grades, prior=prior)


def score_column(spark: SparkSession, model: CumulativeLink, text: Column) -> Column:
    """Struct (expected_grade, top_tail) of a text, top_tail = P(top grade). Only the text goes to Python; null counts as empty."""
    sent = spark.sparkContext.broadcast((model.weights, model.thresholds))

    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, thresholds = sent.value
        link = CumulativeLink(weights, thresholds)
        tokens = per_worker(lambda: WordCache(_token), "quality tokens")
        for texts in parts:
            score = np.empty(len(texts))
            for k, one in enumerate(texts):
                number, value = text_features(one, tokens)
                score[k] = float(weights[number] @ value)
            tails = link.tails(score)
            yield pd.DataFrame({"expected_grade": tails.sum(1), "top_tail": tails[:, -1]})

    udf = F.pandas_udf(scored, "expected_grade double, top_tail double", PandasUDFType.SCALAR_ITER)
    return udf(F.coalesce(text, F.lit("")))


def graded_scores(docs: DataFrame, model: CumulativeLink) -> DataFrame:
    """Per row of ``docs``: doc_id, expected_grade, top_tail.

    Null and empty texts have the one feature of a text without words. Rows are scored each on its own: repeated rows
    and copies get the same figures, null ids stay. A map without a shuffle; the broadcast model has a fixed size.
    """
    rows = id_and_text(docs).withColumn("s", score_column(docs.sparkSession, model, F.col(TEXT)))
    return rows.select(ID, "s.expected_grade", "s.top_tail")


def three_grades(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 toxic, 1 of low quality, 2 neither. Rows with a null label are left out.

    What makes a text toxic are a few words that can come up any number of times, so that grade lies at the open end.
    """
    grade: Column = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(F.col("doc_id"), grade.alias("grade")).where("grade is not null")
