"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from seqprep.llm.components import connected_components
from seqprep.llm.vectors import is_finite, matrix
from seqprep.operators.skew import join_skewed
from seqprep.sources.spool import spool, spool_counted

COSINE = 0.95
FIT_NUMBERS = 2_000_000  # components of the sample that the principal dimensions are fitted on, about
GRID = 3  # leading principal dimensions whose cells order the vectors
BOXES = 8  # leading principal dimensions in which intervals are bounded
BLOCK = 2048  # vectors of a sequence interval that tasks exchange
STRIP = 8  # blocks that a task joins with one block
LEAF = 128  # vectors of an interval that is not divided further
SLACK = 1e-9


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(1, keepdims=True)
    rows = rows / largest
    return rows / np.sqrt((rows**2).sum(1, keepdims=True))


def _principal(vectors: DataFrame, width: int, count: int) -> np.ndarray:
    """Leading principal dimensions (columns) of a bounded sample; they order the work, not the results."""
    share = min(1.0, FIT_NUMBERS / max(1, count * width))
    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 20)) / float(1 << 20)
    sample = vectors.filter(place < share).select("vector").toArrow().column("vector")
    kept = min(BOXES, width)
    if len(sample) < 2:
        return np.eye(width)[:, :kept]
    rows = _unit(matrix(sample, width))
    _, basis = np.linalg.eigh(np.cov(rows, rowvar=False).reshape(width, width))
    return basis[:, ::-1][:, :kept]


class IntervalJoin:
    """Joins sequence intervals of two matrices of unit vectors, in halves, skipping distant ones.

    A side is (vectors, their lengths, their copies); links count the copies of the other vector.
    """

    def __init__(self, left: tuple, right: tuple | None, basis: np.ndarray, cosine: float) -> None:
        self.own = right is None
        self.rows = [left, left if right is None else right]
        self.units = [_unit(rows) for rows, _, _ in self.rows]
        self.spots = [unit @ basis for unit in self.units]
        self.cosine = cosine
        self.reach = 2 - 2 * cosine + SLACK  # squared distance of unit vectors that may be linked
        self.boxes: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.links = [np.zeros(len(units), np.int64) for units in self.units]
        if self.own:
            self.links[1] = self.links[0]
        shift = 0 if self.own else len(self.units[0])
        self.shift = shift
        self.labels = np.arange(len(self.units[0]) + (0 if self.own else len(self.units[1])))

    def _box(self, side: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        key = (0 if self.own else side, begin, end)
        if key not in self.boxes:
            part = self.spots[side][begin:end]
            self.boxes[key] = part.min(0), part.max(0)
        return self.boxes[key]

    def join(self, a: int, b: int, c: int, d: int) -> None:
        """Intervals [a, b) of the left and [c, d) of the right sequence."""
        if a >= b or c >= d or self.own and d <= a:
            return
        low, high = self._box(0, a, b)
        other_low, other_high = self._box(1, c, d)
        gap = np.maximum(np.maximum(low - other_high, other_low - high), 0)
        if gap @ gap > self.reach:
            return
        if max(b - a, d - c) <= LEAF:
            self._compare(a, b, c, d)
        elif b - a >= d - c:
            middle = (a + b) // 2
            self.join(a, middle, c, d)
            self.join(middle, b, c, d)
        else:
            middle = (c + d) // 2
            self.join(a, b, c, middle)
            self.join(a, b, middle, d)

    def _compare(self, a: int, b: int, c: int, d: int) -> None:
        cosines = self.units[0][a:b] @ self.units[1][c:d].T
        linked = cosines >= self.cosine
        for i, j in np.argwhere(np.abs(cosines - self.cosine) < SLACK):  # settled by the definition itself
            x, y = self.rows[0][0][a + i], self.rows[1][0][c + j]
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            linked[i, j] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= self.cosine
        linked &= self.rows[0][1][a:b, None] == self.rows[1][1][None, c:d]
        if self.own:
            linked &= np.arange(a, b)[:, None] < np.arange(c, d)[None, :]
        i, j = np.nonzero(linked)
        if not len(i):
            return
        self.links[0][a:b] += linked @ self.rows[1][2][c:d]
        self.links[1][c:d] += self.rows[0][2][a:b] @ linked
        i, j = i + a, j + c + self.shift
        first = np.concatenate(([True], i[1:] != i[:-1]))  # one link per row settles most of a dense part
        self._connect(i[first], j[first])
        self._connect(i, j)

    def _connect(self, i: np.ndarray, j: np.ndarray) -> None:
        left, right = self.labels[i], self.labels[j]
        apart = left != right
        if not apart.any():
            return
        pairs = np.unique(np.stack((left[apart], right[apart]), axis=1), axis=0)
        leader = {label: label for label in np.unique(pairs).tolist()}

        def find(label: int) -> int:
            while leader[label] != label:
                leader[label] = leader[leader[label]]
                label = leader[label]
            return label

        for one, two in pairs.tolist():
            one, two = find(one), find(two)
            leader[max(one, two)] = min(one, two)
        moved = np.arange(len(self.labels))
        for label in leader:
            moved[label] = find(label)
        self.labels = moved[self.labels]

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Links and leader of every row, of the left and then of the right side."""
        links = self.links[0] if self.own else np.concatenate(self.links)
        return links, self.labels


def _sequence(vectors: DataFrame, basis: np.ndarray, epsilon: float) -> DataFrame:
    """Different vectors in grid order with their position, block and principal coordinates, stored."""
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(basis)
    names = [f"p{i}" for i in range(basis.shape[1])]
    cells = [f"c{i}" for i in range(min(GRID, basis.shape[1]))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = _unit(matrix(batch.column("vector"), len(sent.value))) @ sent.value
            grid = np.floor(spots[:, : len(cells)] / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c) for c in spots.T.copy()], *[pa.array(c) for c in grid.T.copy()]],
                names=["digest", "vec_id", "vector", "copies", *names, *cells],
            )

    schema = ", ".join(
        ["digest string, vec_id long, vector array<double>, copies long", *[f"{n} double" for n in names], *[f"{c} int" for c in cells]]
    )
    placed = vectors.select("digest", "vec_id", "vector", "copies").mapInArrow(place, schema)
    order = [*cells, "p0", "digest"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = spool(ordered.withColumn("mark", F.monotonically_increasing_id()), "grid-order")
    part = F.shiftright("mark", 33)
    counts = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    # One row per partition of the stored table.
    numbered = stored.withColumn("part", part).join(F.broadcast(starts), "part")
    position = F.col("start") + F.col("mark").bitwiseAND((1 << 33) - 1)
    return numbered.withColumn("pos", position).withColumn("block", F.floor(F.col("pos") / BLOCK)).drop(
        "part", "start", "mark"
    )


def _block_pairs(sequence: DataFrame, width: int, epsilon: float) -> DataFrame:
    """Pairs of blocks (a <= b) whose boxes are within epsilon, met through shared or touching grid cells."""
    names = [f"p{i}" for i in range(min(BOXES, width))]
    boxes = sequence.groupBy("block").agg(
        *[F.min(n).alias(f"{n}_low") for n in names], *[F.max(n).alias(f"{n}_high") for n in names]
    )
    boxes = spool(boxes, "block-boxes")

    def cells(side: str, wider: int) -> DataFrame:
        found = boxes.select(*[F.col(name).alias(f"{side}_{name}") for name in boxes.columns])
        for i, name in enumerate(names[:GRID]):
            ends = [F.floor(F.col(f"{side}_{name}_{end}") / epsilon) for end in ("low", "high")]
            found = found.withColumn(f"g{i}", F.explode(F.sequence(ends[0] - wider, ends[1] + wider)))
        return found

    keys = [f"g{i}" for i in range(min(GRID, len(names)))]
    gaps = [
        F.greatest(F.col(f"a_{n}_low") - F.col(f"b_{n}_high"), F.col(f"b_{n}_low") - F.col(f"a_{n}_high"), F.lit(0.0))
        for n in names
    ]
    distance = reduce(lambda x, y: x + y, [gap * gap for gap in gaps])
    met = cells("a", 0).join(cells("b", 1), keys).filter("a_block <= b_block")
    met = met.filter(distance <= epsilon * epsilon + SLACK)
    return met.select(F.col("a_block").alias("a"), F.col("b_block").alias("b")).distinct()


def embedding_links(
    table: DataFrame, identity: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    Vectors lie in epsilon grid order of their leading principal coordinates; the order is cut into blocks,
    blocks whose boxes are further apart than linked vectors can be are never brought together, and the others
    are joined interval by interval inside a task. Tasks return link counts and the leaders of what they
    connected, never pairs, so dense groups of near copies cost no rows. Cosines are computed in double
    precision from the vectors themselves, all pairs that can be linked are looked at. Equal vectors (by the
    digest of their components) are joined as one with its number of copies: copies of a vector cost no pairs.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; nor do
    vectors of different lengths with each other. Repeated rows are vectors of their own that link with each
    other. Rows without id take part and are not kept; ids of their component come from the others. An empty
    table gives an empty result; other columns are not looked at.
    """
    rows = table.select(
        F.col(identity).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    usable = is_finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    vectors = rows.filter(usable)
    others = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    size = vectors.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("rows")).first()
    if not size["rows"]:
        return _kept(others)
    width, epsilon = size["width"], float(np.sqrt(2 - 2 * cosine))
    digest = F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)
    keyed = vectors.withColumn("digest", digest)
    different, count = spool_counted(
        keyed.groupBy("digest").agg(
            F.first("vector").alias("vector"), F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")
        ),
        "different-vectors",
    )
    basis = _principal(different, width, count)
    sequence = _sequence(different, basis, epsilon)
    pairs = spool(_block_pairs(sequence, basis.shape[1], epsilon).withColumn("strip", F.floor(F.col("b") / STRIP)), "block-pairs")
    data = sequence.select("pos", "block", "vector", "copies")
    left = data.join(pairs.select("a", "strip").distinct(), F.col("block") == F.col("a")).drop("block")
    right = data.join(pairs, F.col("block") == F.col("b"))
    # Renamed, so that both sides of the grouped join have columns of their own.
    right = right.select(
        F.col("a").alias("at"),
        F.col("strip").alias("along"),
        F.col("pos").alias("place"),
        F.col("vector").alias("other"),
        F.col("copies").alias("repeats"),
    )
    sent, block = table.sparkSession.sparkContext.broadcast(basis), BLOCK

    def join(one: pa.Table, two: pa.Table) -> pa.Table:
        kept = {"pos": [], "links": [], "leader": []}
        own = _sorted(one.column("pos"), one.column("vector"), one.column("copies"), width, block)
        partners = _sorted(two.column("place"), two.column("other"), two.column("repeats"), width, block)
        number = one.column("a")[0].as_py()
        blocks = partners[3]
        parts = [(own, None)] if (blocks == number).any() else []
        far = blocks != number
        if far.any():
            parts.append((own, tuple(column[far] for column in partners)))
        for mine, theirs in parts:
            task = IntervalJoin(mine[:3], None if theirs is None else theirs[:3], sent.value, cosine)
            task.join(0, len(mine[0]), 0, len(mine[0] if theirs is None else theirs[0]))
            places = mine[4] if theirs is None else np.concatenate((mine[4], theirs[4]))
            links, labels = task.result()
            found = links > 0
            kept["pos"].append(places[found])
            kept["links"].append(links[found])
            kept["leader"].append(places[labels[found]])
        return pa.table({name: np.concatenate(parts).astype(np.int64) for name, parts in kept.items()})

    met = left.groupBy("a", "strip").cogroup(right.groupBy("at", "along"))
    found = spool(met.applyInArrow(join, "pos long, links long, leader long"), "grid-links")
    links = found.groupBy("pos").agg(F.sum("links").alias("n_links"))
    groups = connected_components(found.select(F.col("pos").alias("u"), F.col("leader").alias("v")))
    named = spool(
        sequence.select("pos", "digest", "vec_id", "copies")
        .join(links, "pos", "left")
        .join(groups.withColumnRenamed("node", "pos"), "pos", "left")
        .select(
            "digest",
            "vec_id",
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "pos").alias("group"),
        ),
        "grid-groups",
    )
    smallest = spool(named.groupBy("group").agg(F.min("vec_id").alias("component_id")), "grid-components")
    answers = spool(named.join(smallest, "group").select("digest", "n_links", "component_id"), "grid-answers")
    # One answer per different vector; one of them may have most of the rows.
    result = join_skewed(keyed.select("vec_id", "digest"), answers, ["digest"], side_rows=count)
    return _kept(result.select("vec_id", "n_links", "component_id").unionByName(others))


def _sorted(
    places: pa.ChunkedArray, vectors: pa.ChunkedArray, copies: pa.ChunkedArray, width: int, block: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, their lengths, copies, blocks and positions, by position."""
    pos = places.to_numpy()
    order = np.argsort(pos)
    vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    repeats = copies.to_numpy()
    return matrix(vectors, width)[order], lengths[order], repeats[order], pos[order] // block, pos[order]


def _kept(rows: DataFrame) -> DataFrame:
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return rows.withColumn("kept", kept)
