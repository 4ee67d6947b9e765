"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors are one class with a count. A rotation onto the principal axes of
the unit vectors (one small aggregate) puts most of each product into the leading
dimensions. Classes are ordered by the cell of their leading coordinates, each
above or below its mean, and written once in that order as files of a bounded
number of rows: the tiles. Each tile has a box of its leading coordinates and its
largest suffix norm, and a pair of tiles is compared only if the product that its
boxes allow can reach the threshold. The work table holds numbers alone: a task
reads the files of a tile and, one after the other, those of its partners, so no
vector is shuffled for a pair and a task holds two tiles, however many vectors
point one way.

A pair of tiles accumulates products over blocks of dimensions, bounds what is
missing by the product of the suffix norms, and stops once no pair can reach the
threshold, or goes on with the few pairs that still can. It returns a link count
per class and one link per class at most for the components, never the pairs of a
group. Every link is decided on cosines in double precision. Where the boxes rule
nothing out (vectors spread evenly over many dimensions), the comparisons grow
with the square of the classes, as the method has it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import filesystem, qualified, shared_folder, smallest_reachable, stage
from snapwise.llm.components import connected_components

#: Classes of a tile at most, and numbers in its vectors; classes of a block inside a
#: pair, dimensions of a step, and what single precision may lose in a bound.
TILE, NUMBERS, BLOCK, STEP, ROUNDING = 4096, 1 << 22, 1024, 24, 5e-5
#: Leading dimensions of a cell and of a box; units of work at least, and partners
#: of a tile in one unit at most.
CELL, BOX, UNITS, PARTNERS = 12, 16, 64, 64


def _valid():
    """Vectors that can link: no null or non-finite component, not all zero."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(column):
    """Unit vectors of an Arrow column of lists of one length, scaled first so
    that no square overflows."""
    import numpy as np
    import pyarrow as pa
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(classes: DataFrame, dim: int):
    """The eigenvectors (columns, largest first) of the unit vectors' second
    moments, and the mean of the coordinates along them: ``dim`` x (``dim`` + 1) sums
    come to the driver."""
    import numpy as np

    def partial(batches):
        import pandas as pd
        import pyarrow as pa
        total = np.zeros((dim + 1, dim))
        for batch in batches:
            if batch.num_rows:
                u = _unit(batch.column(0))
                total[:dim] += u.T @ u
                total[dim] += u.sum(axis=0)
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()}),
                                         preserve_index=False)

    sums = classes.filter(F.size("embedding") == dim).select("embedding") \
        .mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((dim + 1) * dim)
    for r in sums:
        total[r["at"]] = r["value"]
    moment, first = total[:-dim].reshape(dim, dim), total[-dim:]
    axes = np.linalg.eigh((moment + moment.T) / 2)[1][:, ::-1].copy()
    return axes, first @ axes / max(1.0, np.trace(moment))  # unit vectors: the trace is their number


def _rotated(u, axes):
    """Coordinates along the axes; vectors of another length keep theirs."""
    return u @ axes if axes is not None and axes.shape[0] == u.shape[1] else u


class Side:
    """Vectors of one side of a unit: the unit vectors, and the factors whose
    products over the steps add up to the bound: the leading products in single
    precision and, as a last factor, the suffix norms in place of the rest."""

    def __init__(self, u, axes, sign: int):
        import numpy as np
        self.u = u
        rotated = _rotated(u, axes)
        self.steps, before = [], None
        for lo in range(0, u.shape[1], STEP):
            rest = np.sqrt(np.maximum(0, np.einsum("ij,ij->i", rotated[:, lo + STEP:], rotated[:, lo + STEP:])))
            factors = [rotated[:, lo:lo + STEP], rest[:, None]]
            if before is not None:
                factors.append(sign * before[:, None])  # takes the bound before out
            self.steps.append(np.concatenate(factors, axis=1).astype("f4"))
            before = rest


def near_pairs(a: Side, rows: slice, b: Side, others: slice, threshold: float):
    """Pairs with a cosine of at least ``threshold``, as places in the slices:
    leading dimensions first, until no pair can reach it any more or so few that
    they are decided one by one."""
    import numpy as np
    bound = None
    for x, y in zip(a.steps, b.steps):
        part = x[rows] @ y[others].T
        bound = part if bound is None else bound + part
        able = bound >= threshold - ROUNDING
        count = np.count_nonzero(able)
        if not count:
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        if count < able.size // 512:
            break
    i, j = np.nonzero(able)
    near = np.empty(len(i), bool)
    for at in range(0, len(i), 1 << 15):
        k = slice(at, at + (1 << 15))
        near[k] = np.einsum("ij,ij->i", a.u[rows][i[k]], b.u[others][j[k]]) >= threshold
    return i[near], j[near]


class Tile:
    """The classes of a tile (cid, n, embedding of one length) as either side."""

    def __init__(self, table, axes):
        self.cid, self.weight = (table.column(k).to_numpy() for k in ("cid", "n"))
        self.u, self.axes = _unit(table.column("embedding")), axes

    @cached_property
    def left(self) -> Side:
        return Side(self.u, self.axes, 1)

    @cached_property
    def right(self) -> Side:
        return Side(self.u, self.axes, -1)


def pair_links(a: Tile, b: Tile, threshold: float):
    """Link counts and component links between two tiles, or inside one
    (``a is b``): (cid, links, to) arrays of the classes that have a link."""
    import numpy as np
    same = a is b
    cid = a.cid if same else np.concatenate([a.cid, b.cid])
    weight = a.weight if same else np.concatenate([a.weight, b.weight])
    links = np.zeros(len(cid), "int64")
    from_, to = [], []
    for lo in range(0, len(a.cid), BLOCK):
        for at in range(lo if same else 0, len(b.cid), BLOCK):
            i, j = near_pairs(a.left, slice(lo, lo + BLOCK), b.right, slice(at, at + BLOCK), threshold)
            i, j = i + lo, j + at
            if same:
                i, j = i[i < j], j[i < j]
            else:
                j = j + len(a.cid)
            if len(i):
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                low = smallest_reachable(i, j, len(cid))
                node = np.flatnonzero(low != np.arange(len(cid)))
                from_.append(node)
                to.append(low[node])
    if not from_:
        return cid[:0], links[:0], cid[:0]
    found = np.flatnonzero(links)
    low = smallest_reachable(np.concatenate(from_), np.concatenate(to), len(cid))
    return cid[found], links[found], cid[low[found]]


def box_bound(low, high, rest, k: int, others):
    """The most that a product of a vector of tile ``k`` with one of ``others`` can
    be: by dimension the greatest product of the boxes' ends, and the suffix norms."""
    import numpy as np
    ends = [x[k] * y[others] for x in (low, high) for y in (low, high)]
    return np.max(ends, axis=0).sum(axis=1) + rest[k] * rest[others]


def write_tiles(classes: DataFrame, axes, mean, count: int) -> list[tuple]:
    """Write ``classes`` (cid, n, embedding) once as files of at most ``TILE`` rows,
    ordered by cell, and return a tile per row: (dimensions, files, box's low and
    high ends, largest suffix norm). Small neighbouring files are one tile."""
    import math

    import numpy as np
    size = max(1, min(TILE, NUMBERS // axes.shape[0]))

    def place(batches):
        import pyarrow as pa
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("embedding"))
            cell, lead, dims = np.zeros(len(column), "int64"), np.zeros(len(column)), column.value_lengths().to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = _rotated(_unit(column.take(pa.array(at))), axes)
                middle = mean if dim == axes.shape[0] else np.zeros(dim)
                for k in range(min(CELL, dim)):
                    cell[at] += (x[:, k] > middle[k]).astype("int64") << (CELL - 1 - k)
                lead[at] = x[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims, pa.int32()), pa.array(cell), pa.array(lead)],
                                             names=[*batch.schema.names, "d", "cell", "lead"])

    placed = classes.select("cid", "n", "embedding").mapInArrow(
        place, f"cid long, n long, embedding {classes.schema['embedding'].dataType.simpleString()}, d int, cell long, lead double")
    order, spark = ["d", "cell", "lead", "cid"], classes.sparkSession
    folder = qualified(spark, shared_folder(spark, "tiles"))
    # cid parts vectors that point one way, so no range is large.
    placed.repartitionByRange(math.ceil(count / size), *order).sortWithinPartitions(*order) \
        .select("cid", "n", "embedding").write.option("maxRecordsPerFile", size).parquet(folder)

    def boxes(batches):
        import pandas as pd
        import pyarrow as pa
        for batch in batches:
            names, column = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            dims = column.value_lengths().to_numpy()
            for name, dim in sorted(set(zip(names, dims.tolist()))):
                at = np.flatnonzero((names == name) & (dims == dim))
                x = _rotated(_unit(column.take(pa.array(at))), axes)
                row = (name, dim, len(at), [x[:, :BOX].min(axis=0).tolist()], [x[:, :BOX].max(axis=0).tolist()],
                       float(np.sqrt((x[:, BOX:] ** 2).sum(axis=1)).max(initial=0)))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(dict(zip(
                    ("file", "d", "n", "low", "high", "rest"), row))), preserve_index=False)

    # A row or two per file come to the driver.
    rows = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("file"), "embedding") \
        .mapInArrow(boxes, "file string, d long, n long, low array<double>, high array<double>, rest double").collect()
    tiles: list[list] = []
    for r in sorted(rows, key=lambda r: (r["d"], r["file"])):
        old = tiles[-1] if tiles else None
        if old and old[0] == r["d"] and (r["file"] == old[1][-1] or old[5] + r["n"] <= size):
            files = old[1] if r["file"] == old[1][-1] else [*old[1], r["file"]]
            tiles[-1] = [old[0], files, np.minimum(old[2], r["low"]), np.maximum(old[3], r["high"]),
                         max(old[4], r["rest"]), old[5] + r["n"]]
        else:
            tiles.append([r["d"], [r["file"]], np.array(r["low"]), np.array(r["high"]), r["rest"], r["n"]])
    return [tuple(t[:5]) for t in tiles]


def tile_links(spark, tiles: list[tuple], axes, threshold: float) -> DataFrame:
    """(cid, links, to) of all pairs of ``tiles`` within reach. A unit of work is a
    tile and a share of the tiles that follow it on the circle of those of its
    length, half of them, so every tile has as many partners."""
    import numpy as np
    length = np.array([t[0] for t in tiles])
    first = np.searchsorted(length, length)
    circle = np.searchsorted(length, length, "right") - first
    width = max(len(t[2]) for t in tiles)
    low, high = (np.array([np.pad(t[k], (0, width - len(t[k]))) for t in tiles]) for k in (2, 3))
    rest, files = np.array([t[4] for t in tiles]), [t[1] for t in tiles]
    parts = max(-(-UNITS // len(tiles)), -(-int(circle.max()) // (2 * PARTNERS)))
    known = spark.sparkContext.broadcast((length, first, circle, low, high, rest, files))

    def load(k, length, files):
        import pyarrow as pa
        import pyarrow.parquet as pq
        tables = []
        for uri in files[k]:
            fs, path = filesystem(uri)
            with fs.open_input_file(path) as f:
                tables.append(pq.read_table(f, columns=["cid", "n", "embedding"]))
        table = pa.concat_tables(tables)
        dims = table.column("embedding").combine_chunks().value_lengths().to_numpy()
        return Tile(table if (dims == length[k]).all() else table.take(pa.array(np.flatnonzero(dims == length[k]))), axes)

    def compare(batches):
        import pyarrow as pa
        length, first, circle, low, high, rest, files = known.value
        for unit in (u for batch in batches for u in batch.column(0).to_pylist()):
            k, part = divmod(unit, parts)
            n = int(circle[k])
            steps = np.arange(part, n // 2 + 1, parts)
            if n % 2 == 0 and k - first[k] >= n // 2:  # the tile opposite has this pair
                steps = steps[steps < n // 2]
            others = first[k] + (k - first[k] + steps) % n
            others = others[box_bound(low, high, rest, k, others) >= threshold - ROUNDING]
            if not len(others):
                continue
            mine = load(k, length, files)
            for o in others.tolist():
                found = pair_links(mine, mine if o == k else load(o, length, files), threshold)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["cid", "links", "to"])

    units = len(tiles) * parts
    return spark.range(0, units, 1, min(units, 100_000)).mapInArrow(compare, "cid long, links long, to long")


def embedding_groups(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``
    (vec_id long, embedding array; other columns are ignored).

    Vectors link if they are of one length and their cosine is at least
    ``threshold`` (over 0). Null, empty and zero vectors, and those with null or
    non-finite components, link with nothing and are their own component.
    Repeated rows link with each other like other equal vectors. component_id
    is the smallest id of a component that is not null."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", _valid().alias("ok"))
    classes = stage(rows.filter("ok").groupBy("embedding").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    # The rotation is for the commonest length; others are compared unrotated.
    common = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    axes, mean = principal_axes(classes, common["d"])
    tiles = write_tiles(classes, axes, mean, classes.count())
    found = stage(tile_links(classes.sparkSession, tiles, axes, threshold), "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    nodes = connected_components(found.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    member = classes.join(links, "cid", "left").join(nodes.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("component", F.coalesce("component", "cid")) \
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = member.join(smallest, "component").select(
        F.col("embedding").alias("e"), F.col("n_links").alias("links"), F.col("component_id").alias("of"))
    joined = rows.join(of_class, F.col("ok") & (F.col("embedding") == F.col("e")), "left")
    component = F.when(F.col("e").isNull(), F.col("vec_id")).otherwise(F.col("of"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
