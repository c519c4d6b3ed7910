"""Product codes of vectors, with the nearest codebook entry found in a geometric near-neighbour access tree (GNAT)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Shape of the tree: split points of a node, and entries up to which a node is searched one by one.
SPLITS, LEAF = 16, 24
#: Relative width by which distances and ranges are rounded away from each other; sixteen times what a root and a subtraction can lose.
_WIDE = 2.0**-48
#: Rows of a batch; a sum of a part's components is kept as two numbers of this base.
_ROWS, _BASE = 8_192, 1 << 60


def integers(vectors: list, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component, exactly.

    As 64-bit floats where all squared distances are whole numbers that these can hold, as 64-bit integers up to twice
    the digits, else as Python integers.
    """
    if not vectors:
        return np.empty((0, 0))
    whole = np.floor(np.array(vectors, np.float64) * scale)
    most = float(np.abs(whole).max(initial=0))
    room = 4 * max(whole.shape[1], 1) * (most + 1) ** 2
    if room < 2.0**52:
        return whole
    if room < 2.0**61:
        return whole.astype(np.int64)
    return np.array([[int(x) for x in row] for row in whole.tolist()], object).reshape(whole.shape)


def _same_kind(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a kind of number that holds the squared distances between them."""
    if not x.size or not y.size:
        return x, y
    largest = max(abs(int(z)) for part in (x, y) for z in (part.min(), part.max()))
    room = 4 * x.shape[1] * (largest + 1) ** 2
    if room < 1 << 52:
        return x.astype(np.float64), y.astype(np.float64)
    if room < 1 << 61:
        return x.astype(np.int64), y.astype(np.int64)
    exact = lambda z: z if z.dtype == object else np.vectorize(int, otypes=[object])(z)
    return exact(x), exact(y)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of y."""
    if not x.shape[1]:
        return np.zeros((len(x), len(y)))
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)


def _roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


@dataclass
class _Node:
    """Entries at a node: all of them at a leaf, else the split points, a child for each and ``low[i, j]`` to ``high[i, j]``,
    between which the distances of split point i to the entries below child j lie."""

    entries: np.ndarray
    children: list = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    """A tree over a codebook's entries that gives each query its nearest entry, of several the one with the lowest index.

    Split points are chosen far from each other; every other entry goes to the child of the nearest one. A query knows
    its distance to a split point and the distance of the best entry so far. By the triangle inequality no entry of a
    child can be as near as the best when the child's range of distances to a split point lies wholly outside distance plus and minus best. The
    ranges are rounded outwards and the child goes only when it is strictly outside, so an entry that ties stays
    in; which of two entries is nearer is decided on exact squared distances.
    """

    def __init__(self, entries: np.ndarray):
        self.points = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, at: np.ndarray) -> _Node:
        if len(at) <= max(LEAF, SPLITS):
            return _Node(at)
        points, _ = _same_kind(self.points[at], self.points[at])
        chosen = [0]
        nearest = squares(points, points[:1])[:, 0]
        while len(chosen) < SPLITS:
            far = int(np.argmax(nearest))
            if nearest[far] <= 0:
                break  # all the others equal a split point
            chosen.append(far)
            nearest = np.minimum(nearest, squares(points, points[far : far + 1])[:, 0])
        if len(chosen) == 1:
            return _Node(at)
        between = squares(points, points[chosen])
        home = np.argmin(between, axis=1)
        home[chosen] = -1
        roots = _roots(between)
        node = _Node(at[chosen], low=np.full((len(chosen),) * 2, np.inf), high=np.full((len(chosen),) * 2, -np.inf))
        for j in range(len(chosen)):
            below = np.flatnonzero(home == j)
            node.children.append(self._node(at[below]) if len(below) else None)
            if len(below):
                node.low[:, j] = roots[below].min(0) * (1 - _WIDE)
                node.high[:, j] = roots[below].max(0) * (1 + _WIDE)
        return node

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each query, and the exact squared distance."""
        queries, points = _same_kind(queries, self.points)
        state = _Search(queries, points)
        if len(queries) and len(points):
            state.visit(self.root, np.arange(len(queries)))
        return state.index, state.best


class _Search:
    def __init__(self, queries: np.ndarray, points: np.ndarray):
        self.queries, self.points = queries, points
        self.index = np.full(len(queries), len(points), np.int64)
        self.best = np.zeros(len(queries), queries.dtype)
        self.radius = np.full(len(queries), np.inf)

    def visit(self, node: _Node, who: np.ndarray) -> None:
        squared = squares(self.queries[who], self.points[node.entries])
        lowest = squared.min(1)
        # of equal distances the lowest index
        first = np.where(squared == lowest[:, None], node.entries[None, :], len(self.points)).min(1)
        better = np.array(np.isinf(self.radius[who]) | (lowest < self.best[who]) | ((lowest == self.best[who]) & (first < self.index[who])), bool)
        won = who[better]
        self.best[won], self.index[won] = lowest[better], first[better]
        self.radius[won] = _roots(lowest[better])
        if not node.children:
            return
        distance = _roots(squared)
        # the child of the nearest split point first: it makes the radius small before the others are tried
        home = np.argmin(distance, axis=1)
        for first_child in (True, False):
            for j, child in enumerate(node.children):
                mine = np.flatnonzero((home == j) == first_child) if child is not None else ()
                if not len(mine):
                    continue
                near, reach = distance[mine], self.radius[who[mine]][:, None]
                slack = _WIDE * (near + reach)
                outside = (near - reach - slack > node.high[:, j]) | (near + reach + slack < node.low[:, j])
                left = who[mine[~outside.any(1)]]
                if len(left):
                    self.visit(child, left)


def _part(rows: np.ndarray, part: int, parts: int) -> np.ndarray:
    width = rows.shape[1] // parts
    return rows[:, part * width : (part + 1) * width]


def _columns(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, label and vector of the rows whose vector is whole: no null or non-finite component, and not null itself."""
    v = F.col(vector).cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    kept = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v"), F.col(label).alias("label"))
    return kept.where(F.col("v").isNotNull() & ~F.exists("v", odd))


def _batches(frames: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of vectors of the codebooks' length with these as integers."""
    for frame in frames:
        fits = frame[[len(v) == width for v in frame["v"]]] if len(frame) else frame
        for at in range(0, len(fits), _ROWS):
            part = fits.iloc[at : at + _ROWS]
            yield part, integers(part["v"].tolist()).reshape(len(part), width)


def _partial_sums(frames: Iterator[pd.DataFrame], books, parts: int, width: int) -> Iterator[pd.DataFrame]:
    """Per part and entry that a task's vectors use: count and sums of the components, each sum as high * _BASE + low."""
    trees = [Gnat(b) for b in books.value]
    sums = [np.zeros((len(b), width // parts), object) for b in books.value]
    counts = [np.zeros(len(b), np.int64) for b in books.value]
    for _, rows in _batches(frames, width):
        for p in range(parts):
            own = _part(rows, p, parts)
            index, _ = trees[p].nearest(own)
            by = np.argsort(index, kind="stable")
            used, first, n = np.unique(index[by], return_index=True, return_counts=True)
            if own.shape[1]:
                # a batch's sums fit where its squared distances do
                added = np.add.reduceat(own[by], first, axis=0)
                sums[p][used] += added if added.dtype == object else added.astype(np.int64).astype(object)
            counts[p][used] += n
    out = []
    for p in range(parts):
        for e in np.flatnonzero(counts[p]).tolist():
            out.append((p, e, int(counts[p][e]), [str(int(s) // _BASE) for s in sums[p][e]], [str(int(s) % _BASE) for s in sums[p][e]]))
    if out:
        yield pd.DataFrame(out, columns=["part", "entry", "n", "high", "low"])


def _next_books(rows: DataFrame, books: list[np.ndarray], parts: int, width: int) -> list[np.ndarray]:
    """The entries after one round: the floor of the mean of the parts next to each; entries without any stay."""
    sent = rows.sparkSession.sparkContext.broadcast(books)  # entries x vector length numbers
    found = rows.select("v").mapInPandas(lambda f: _partial_sums(f, sent, parts, width), "part int, entry int, n long, high array<string>, low array<string>")
    exact = "decimal(38,0)"
    total = lambda c, i: F.sum(F.get(c, F.lit(i)).cast(exact)).cast("string")
    each = width // parts
    aggregates = [F.sum("n").alias("n"), *(total(c, i).alias(f"{c}{i}") for c in ("high", "low") for i in range(each))]
    made = found.groupBy("part", "entry").agg(*aggregates).collect()  # a row per entry in use
    out = [np.vectorize(int, otypes=[object])(b) if b.size else b.astype(object) for b in books]
    for r in made:
        out[r["part"]][r["entry"]] = [(int(r[f"high{i}"]) * _BASE + int(r[f"low{i}"])) // r["n"] for i in range(each)]
    sent.destroy()
    return [_same_kind(b, b)[0] for b in out]


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """The codebook of each part position, and the length of the vectors that they are for.

    ``kept`` has vec_id and v. They start as the vectors of the lowest vec_id (null last; of one vec_id in the vectors' own order), as
    long as the first of these; each round is one pass over all vectors, summed in the tasks and then over tasks.
    """
    seeds = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    width = len(seeds[0]["v"]) if seeds else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    same = kept.where(F.size("v") == width)
    seeds = same.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    first = integers([r["v"] for r in seeds]).reshape(len(seeds), width)
    books = [np.ascontiguousarray(_part(first, p, parts)) for p in range(parts)]
    for _ in range(rounds if seeds else 0):
        books = _next_books(same, books, parts, width)
    return books, width


def books_digest(books: list[np.ndarray]) -> str:
    """Lowercase hex sha256 of all components as decimal numbers, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def _long(n) -> int | None:
    return int(n) if -(2**63) <= int(n) < 2**63 else None


def assigned(kept: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part, and the squared distances to the entries added up over the parts."""
    sent = kept.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [Gnat(b) for b in sent.value]
        digits = np.array([f"{i:02x}" for i in range(max(256, *(len(b) for b in sent.value)))])
        for frame in frames:
            odd = frame[[len(v) != width for v in frame["v"]]] if len(frame) else frame
            if len(odd):
                yield odd[["vec_id", "label"]].assign(vec_id=odd["vec_id"].astype("Int64"), code=None, error=pd.array([None] * len(odd), "Int64"))
            for part, rows in _batches([frame], width):
                code, error = np.zeros(len(rows), "U1"), np.zeros(len(rows), object)
                for p, tree in enumerate(trees):
                    index, squared = tree.nearest(_part(rows, p, parts))
                    code = np.char.add(code, digits[index])
                    error = error + (squared if squared.dtype == object else squared.astype(np.int64).astype(object))
                errors = pd.array([_long(e) for e in error], "Int64")
                yield part[["vec_id", "label"]].assign(vec_id=part["vec_id"].astype("Int64"), code=code.astype(object), error=errors)

    label = kept.schema["label"].dataType.simpleString()
    return kept.mapInPandas(coded, f"vec_id long, label {label}, code string, error long")


def vector_codes(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Per row with a whole vector: vec_id, label, code, error, label_error, codebooks_sha256.

    Components become floor(1024 * x); all arithmetic after that is exact. Rows whose vector is null or has a null or
    non-finite component are left out. Each position of ``parts`` equal parts has a codebook of up to ``entries``
    entries, made by ``rounds`` of exact means; ``label_error`` adds up the errors of a label (null ones together).

    Repeated rows and rows of one id count each; null ids come last among the seeds. A vector of another length than the first seed's
    has no code: null code and error, and no part in the means. An error beyond 64 bits is null, and a label_error with it. An empty
    table gives no rows. Other columns are left out, so their names cannot clash.
    """
    if entries > 256:
        raise ValueError("a code of two hex digits names 256 entries at most")
    kept = _columns(vectors, key, vector, label)
    books, width = codebooks(kept, parts, entries, rounds)
    rows = assigned(kept, books, width)
    too_large = F.count_if(F.col("error").isNull() & F.col("code").isNotNull()) > 0
    total: Column = F.when(~too_large, F.expr("try_sum(error)"))
    by_label = rows.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    out = rows.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return out.select("vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
