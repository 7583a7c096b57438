"""Nearest neighbours by largest inner product: stable projections, kd-trees, a chi-square stop.

Vectors get one more component so that the largest inner product is the
smallest distance, and are projected on DIMS Gaussian directions. For points at
distance d, the squared projected distance over d^2 is chi-square with DIMS
degrees. A search goes through leaves of a kd-tree in order of projected
distance, verifies their vectors by the true product, and stops once the next
leaf's squared distance is past the RECALL quantile times the 20th best squared
distance: a better vector would have come by then with that probability.

The upper tree has MOST_CELLS cells at most. It is fitted on SAMPLE vectors, and
every vector is put in its cell. A cell of more than LARGE rows gets a tree of its
own, fitted on PART_SAMPLE of its vectors, that parts it again, in MOST_PARTS parts
at most; so cells stay at some CELL_ROWS rows up to MOST_CELLS * MOST_PARTS of
them. Parts are cut into blocks of about BLOCK rows, each with a tree for the
search, and queries into chunks, so no task holds a whole part. A query first
searches its home part; its 20th best there and the true boxes of cells and, in
them, parts tell, by the same stop, where else it must look.

Of many equal vectors a query can only get the NEAREST smallest vec_ids besides
its own, so no more than these are candidates: exactly the same result, and no
part grows with the copies of one vector.

Defined cases: vectors that are null, empty, zero, of another length than most,
or hold null or non-finite components take no part; equal scores go to the
smaller vec_id; of rows with the same vec_id each is a candidate, one is a
query, and none is a candidate for itself; with fewer than 20 candidates all
are returned; an empty table gives no rows; other columns play no part; a very
long vector costs a row of the matrices that a task holds, BLOCK vectors at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from gridlode.llm.common import written

DIMS = 8
RECALL = 0.98
NEAREST = 20
SAMPLE = 20_000
CELL_ROWS = 2_048
MOST_CELLS = 4_096
LARGE = 8_192
PART_SAMPLE = 8_192
MOST_PARTS = 1_024
PARTED_AT_ONCE = 1 << 16  # rows of a large cell that one task parts
BLOCK = 4_096
CHUNK = 1_024
LEAF = 64


def chi_square_quantile(p: float, dims: int = DIMS) -> float:
    """Of an even number of degrees, by bisection."""
    low, high = 0.0, 200.0
    for _ in range(100):
        x = (low + high) / 2
        term = total = 1.0
        for k in range(1, dims // 2):
            term *= x / 2 / k
            total += term
        low, high = (x, high) if 1 - exp(-x / 2) * total < p else (low, x)
    return high


def projection(length: int) -> np.ndarray:
    return np.random.default_rng(20).standard_normal((length + 1, DIMS))


def project(x: np.ndarray, norm: float) -> np.ndarray:
    """norm is the largest of all; queries have no part in the added component (norm = 0)."""
    extra = np.sqrt(np.maximum(0.0, norm * norm - (x * x).sum(axis=1))) if norm else np.zeros(len(x))
    return np.column_stack([x, extra]) @ projection(x.shape[1])


class Tree:
    """Median splits on the widest side, down to `leaf` points or `leaves` leaves."""

    def __init__(self, points: np.ndarray, leaf: int, leaves: int | None = None) -> None:
        self.side, self.cut, self.child = [], [], []  # child < 0: leaf number ~child
        self.leaves: list[np.ndarray] = []
        self.root = self._grow(points, np.arange(len(points)), leaf, leaves)

    def _grow(self, points, rows, leaf, leaves) -> int:
        part = points[rows]
        wide = part.max(axis=0) - part.min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= leaf or (leaves is not None and leaves < 2) or not wide.max() > 0:
            self.leaves.append(rows)
            return ~(len(self.leaves) - 1)
        side = int(wide.argmax())
        cut = float(np.median(part[:, side]))
        left = part[:, side] <= cut
        if left.all():
            cut = float(part[:, side][part[:, side] < cut].max())
            left = part[:, side] <= cut
        me = len(self.side)
        self.side.append(side)
        self.cut.append(cut)
        self.child.append([0, 0])
        half = None if leaves is None else leaves // 2
        self.child[me] = [self._grow(points, rows[left], leaf, half), self._grow(points, rows[~left], leaf, None if leaves is None else leaves - half)]
        return me

    def find(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        at = np.full(len(points), self.root)
        side, cut, child = np.array(self.side, int), np.array(self.cut), np.array(self.child, int).reshape(-1, 2)
        while (inner := np.flatnonzero(at >= 0)).size:
            n = at[inner]
            at[inner] = child[n, (points[inner, side[n]] > cut[n]).astype(int)]
        return ~at


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from each point to each box."""
    gap = np.maximum(0, np.maximum(low[None] - points[:, None], points[:, None] - high[None]))
    return (gap * gap).sum(axis=2)


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed the same way for the same vector, wherever it stands."""
    return (x * q).sum(axis=-1)


def search(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, bounds: np.ndarray, norm: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the best in this block; bounds: scores that 20 others elsewhere reach."""
    px, pq, stop = project(x, norm), project(q, 0), chi_square_quantile(RECALL)
    tree = Tree(px, LEAF)
    low, high = (np.stack([f(px[r], axis=0) for r in tree.leaves]) for f in (np.min, np.max))
    near = box_distance(pq, low, high)
    order = np.argsort(near, axis=1, kind="stable")
    top = np.full((len(q), NEAREST), -np.inf)
    top[:, 0] = -np.inf
    square = (q * q).sum(axis=1) + norm * norm
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in q]
    active = np.arange(len(q))
    for step in range(len(tree.leaves)):
        worst = np.maximum(top[active].min(axis=1), bounds[active])
        reach = stop * np.maximum(0, square[active] - 2 * worst) + 1e-9 * square[active]
        leaf = order[active, step]
        going = near[active, leaf] <= reach
        active, leaf = active[going], leaf[going]
        if not len(active):
            break
        by_leaf = np.argsort(leaf, kind="stable")
        for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            who, rows = active[part], tree.leaves[leaf[part[0]]]
            score = q[who] @ x[rows].T
            score[qids[who][:, None] == ids[rows][None]] = -np.inf
            keep = score >= np.maximum(top[who].min(axis=1), bounds[who])[:, None] - 1e-9 * np.sqrt(square[who])[:, None] - 1e-300
            keep &= score > -np.inf
            both = np.concatenate([top[who], score], axis=1)
            top[who] = -np.partition(-both, NEAREST - 1, axis=1)[:, :NEAREST]
            for n, w in enumerate(who):
                if keep[n].any():
                    found[w].append((rows[keep[n]], score[n][keep[n]]))
    for w, parts in enumerate(found):
        if not parts:
            continue
        rows, score = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        rows = rows[score >= top[w].min() - 1e-9 * np.sqrt(square[w])]
        exact = dots(x[rows], q[w])
        best = np.lexsort((ids[rows], -exact))[:NEAREST]
        yield int(qids[w]), ids[rows][best], exact[best]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in column])


def _valid(df: DataFrame) -> DataFrame:
    e = "transform(embedding, x -> cast(x as double))"
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(e).alias("v")).where("vec_id is not null and v is not null")
    # comparisons with null are null, with NaN (the largest) false
    return rows.where("forall(v, x -> x is not null and abs(x) < double('Infinity')) and exists(v, x -> x != 0)")


_SIDES = tuple(f"p{k}" for k in range(DIMS))


def _box() -> list[Column]:
    return [f(p).alias(f"{name}{k}") for name, f in (("low", F.min), ("high", F.max)) for k, p in enumerate(_SIDES)]


def _boxes(rows: list) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([[r[f"{name}{k}"] for k in range(DIMS)] for r in rows]) for name in ("low", "high"))


def _salted(rows: DataFrame, counts: DataFrame, most: int, key: str) -> DataFrame:
    """rows with a salt, so that `most` rows or so of a part share one; counts: cell, part, n."""
    salts = counts.select("cell", "part", F.ceil(F.col("n") / most).alias("salts"))
    return rows.join(salts, ["cell", "part"]).withColumn("salt", F.pmod(F.xxhash64(key, F.lit(5)), "salts")).drop("salts")


class Index:
    """The vectors in cells, parts and blocks."""

    def __init__(self, df: DataFrame) -> None:
        self.spark, rows = df.sparkSession, _valid(df)
        sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, double(0), (s, x) -> s + x * x)")).alias("square"))
        most = sizes.orderBy(F.desc("n"), "size").first()
        self.empty = most is None
        if self.empty:
            return
        self.length, n, self.norm = most["size"], most["n"], float(np.sqrt(most["square"])) * (1 + 1e-12)
        rows = rows.where(F.size("v") == self.length)
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
        norm, tree = self.norm, Tree(project(np.array([r["v"] for r in sample]), self.norm), 1, max(1, min(MOST_CELLS, n // CELL_ROWS)))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                p = project(x, norm)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(tree.find(p).astype(np.int32)), *(pa.array(c) for c in p.T.copy())],
                    ["vec_id", "v", "cell", *_SIDES],
                )

        rows = rows.mapInArrow(assign, "vec_id long, v binary, cell int, " + ", ".join(f"{p} double" for p in _SIDES))
        rows = written(rows.withColumn("nr", F.monotonically_increasing_id()))
        cells = rows.groupBy("cell").agg(F.count("*").alias("n"), *_box()).orderBy("cell").collect()  # MOST_CELLS rows at most
        self.cells, (self.low, self.high) = np.array([s["cell"] for s in cells]), _boxes(cells)
        large = {s["cell"]: s["n"] for s in cells if s["n"] > LARGE}
        self.rows = self._parted(rows, large) if large else rows.withColumn("part", F.lit(0))
        candidates = self._candidates()
        found = written(candidates.groupBy("cell", "part").agg(F.count("*").alias("n"), *_box()))
        self.large = set(large)
        sides = F.struct("part", *(c for c in found.columns if c not in ("cell", "part", "n")))
        self.parts = written(found.where(F.col("cell").isin(*large)).groupBy("cell").agg(F.collect_list(sides).alias("parts"))) if large else None  # MOST_PARTS a row
        blocks = _salted(candidates.select("vec_id", "v", "cell", "part", "nr"), found, BLOCK, "nr")
        self.blocks = written(blocks.groupBy("cell", "part", "salt").agg(F.collect_list(F.struct("vec_id", "v")).alias("x")).drop("salt"))

    def _parted(self, rows: DataFrame, large: dict[int, int]) -> DataFrame:
        """rows with their part of their cell."""
        spark = self.spark
        inside = rows.where(F.col("cell").isin(*large))
        salts = F.broadcast(spark.createDataFrame([(c, -(-n // PARTED_AT_ONCE), max(1, min(MOST_PARTS, n // CELL_ROWS))) for c, n in large.items()], "cell int, salts long, parts long"))
        order = Window.partitionBy("cell").orderBy(F.xxhash64("nr"), "nr")
        sample = inside.select("cell", "nr", *_SIDES).withColumn("k", F.row_number().over(order)).where(F.col("k") <= PART_SAMPLE).join(salts, "cell")

        def fit(table: pa.Table) -> pa.Table:
            points = np.column_stack([table.column(p).to_numpy() for p in _SIDES])
            tree = Tree(points, 1, table.column("parts")[0].as_py())
            return pa.table({"cell": table.column("cell").slice(0, 1), "tree": pa.array([cloudpickle.dumps(tree)], pa.binary())})

        trees = written(sample.groupBy("cell").applyInArrow(fit, "cell int, tree binary"))
        each = trees.join(salts, "cell").select("cell", "tree", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        dealt = inside.join(salts, "cell").withColumn("salt", F.pmod(F.xxhash64("nr"), "salts")).drop("salts", "parts")

        def put(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return left.drop(["salt"]).append_column("part", pa.array([], pa.int32()))
            tree = cloudpickle.loads(right.column("tree")[0].as_py())
            points = np.column_stack([left.column(p).to_numpy() for p in _SIDES])
            return left.drop(["salt"]).append_column("part", pa.array(tree.find(points).astype(np.int32)))

        schema = StructType([*rows.schema.fields, StructField("part", IntegerType())])
        parted = dealt.groupBy("cell", "salt").cogroup(each.groupBy("cell", "salt")).applyInArrow(put, schema)
        return written(parted.unionByName(rows.where(~F.col("cell").isin(*large)).withColumn("part", F.lit(0))))

    def _candidates(self) -> DataFrame:
        """rows without those that no query can get: NEAREST of any one vec_id and NEAREST others come before them."""
        rows = self.rows.withColumn("same", F.md5("v"))
        often = written(rows.groupBy("same").agg(F.count("*").alias("n")).where(F.col("n") > 2 * NEAREST).select("same"))
        if often.isEmpty():
            return self.rows
        many = rows.join(often, "same", "left_semi")
        one = F.row_number().over(Window.partitionBy("same", "v", "vec_id").orderBy("nr"))
        all_ = F.row_number().over(Window.partitionBy("same", "v").orderBy("vec_id", "nr"))
        many = many.withColumn("k", one).where(F.col("k") <= NEAREST).withColumn("k", all_).where(F.col("k") <= 2 * NEAREST).drop("k")
        return written(rows.join(often, "same", "left_anti").unionByName(many).drop("same"))

    def _search(self, asked: DataFrame) -> DataFrame:
        """asked: query_id, q, bound, cell, part."""
        asked = written(asked)
        counts = written(asked.groupBy("cell", "part").agg(F.count("*").alias("n")))
        chunks = _salted(asked, counts, CHUNK, "query_id").groupBy("cell", "part", "salt").agg(F.collect_list(F.struct("query_id", "q", "bound")).alias("asked"))
        chunks, norm = written(chunks.drop("salt")), self.norm

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(len(batch)):
                    x, a = batch.column(0)[n].values, batch.column(1)[n].values
                    out = list(search(x.field(0).to_numpy(), _matrix(x.field(1)), a.field(0).to_numpy(), _matrix(a.field(1)), a.field(2).to_numpy(), norm))
                    if out:
                        ids = np.repeat([w for w, _, _ in out], [len(i) for _, i, _ in out])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, pa.int64()), pa.array(np.concatenate([i for _, i, _ in out]), pa.int64()), pa.array(np.concatenate([s for _, _, s in out]))],
                            ["query_id", "vec_id", "score"],
                        )

        return self.blocks.join(chunks, ["cell", "part"]).select("x", "asked").mapInArrow(run, "query_id long, vec_id long, score double")

    def nearest(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score for queries among the rows."""
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        top = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEAREST)
        own = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("v", "cell", "part")).alias("m"))
        own = written(own.select("query_id", F.col("m.v").alias("q"), F.col("m.cell").alias("cell"), F.col("m.part").alias("part")))
        home = written(top(self._search(own.withColumn("bound", F.lit(float("-inf"))))).drop("rank"))
        bound = home.groupBy("query_id").agg(F.count("*").alias("k"), F.min("score").alias("worst"))
        bound = own.join(bound, "query_id", "left").select("query_id", "q", "cell", "part", F.when(F.col("k") >= NEAREST, F.col("worst")).otherwise(float("-inf")).alias("bound"))
        found = home.unionByName(self._search(self._elsewhere(written(bound))))
        return top(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def _elsewhere(self, bound: DataFrame) -> DataFrame:
        """The parts, besides its own, that each query must search."""
        cells, low, high, norm, large = self.cells, self.low, self.high, self.norm, self.large

        def reach(q: np.ndarray, scores: np.ndarray) -> np.ndarray:
            square = (q * q).sum(axis=1) + norm * norm
            return (chi_square_quantile(RECALL) * np.maximum(0, square - 2 * scores) + 1e-9 * square)[:, None]

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    part = batch.slice(at, 1024)
                    q = _matrix(part.column(1))
                    go = box_distance(project(q, 0), low, high) <= reach(q, part.column(4).to_numpy())
                    # the home cell is done, unless it has other parts
                    go &= (part.column(2).to_numpy()[:, None] != cells[None]) | np.isin(cells, list(large))[None]
                    who, cell = np.nonzero(go)
                    picked = part.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns[:2], picked.column(4), pa.array(cells[cell].astype(np.int32)), picked.column(2), picked.column(3)], ["query_id", "q", "bound", "cell", "own_cell", "own_part"]
                    )

        asked = bound.mapInArrow(spread, "query_id long, q binary, bound double, cell int, own_cell int, own_part int")
        if self.parts is None:
            return asked.select("query_id", "q", "bound", "cell", F.lit(0).alias("part"))
        asked = written(asked)

        def inside(left: pa.Table, right: pa.Table) -> pa.Table:
            """Of one cell, the parts within reach of some of its queries."""
            names = ["query_id", "q", "bound", "cell"]
            if not len(left):
                return left.select(names).append_column("part", pa.array([], pa.int32()))
            parts = right.column("parts").combine_chunks()[0].values
            number = parts.field("part").to_numpy()
            low_, high_ = (np.column_stack([parts.field(f"{side}{k}").to_numpy() for k in range(DIMS)]) for side in ("low", "high"))
            q = _matrix(left.column("q").combine_chunks())
            go = box_distance(project(q, 0), low_, high_) <= reach(q, left.column("bound").to_numpy())
            home = left.column("own_cell").to_numpy() == left.column("cell").to_numpy()
            go &= ~(home[:, None] & (left.column("own_part").to_numpy()[:, None] == number[None]))
            who, part = np.nonzero(go)
            return left.select(names).take(pa.array(who)).append_column("part", pa.array(number[part].astype(np.int32)))

        split = F.col("cell").isin(*self.large)
        counts = asked.where(split).groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).alias("salts"))
        each = written(self.parts.join(counts, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))))
        dealt = asked.where(split).join(counts, "cell").withColumn("salt", F.pmod(F.xxhash64("query_id"), "salts")).drop("salts")
        within = dealt.groupBy("cell", "salt").cogroup(each.select("cell", "salt", "parts").groupBy("cell", "salt")).applyInArrow(inside, "query_id long, q binary, bound double, cell int, part int")
        return within.unionByName(asked.where(~split).select("query_id", "q", "bound", "cell", F.lit(0).alias("part")))


def nearest(df: DataFrame, every: int = 20) -> DataFrame:
    """Neighbours of the rows whose vec_id is divisible by `every`, among all rows."""
    index = Index(df)
    if index.empty:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return index.nearest(index.rows.where(F.col("vec_id") % every == 0))


def query(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
