"""Near-duplicate vectors by sorted projection passes.

In each pass a vector's key is the signs of its products with 48 random directions, concatenated.
Vectors are ordered by key, and each is compared with the next WINDOW ones. Near vectors share
long key prefixes in some pass. Equal vectors are one class from the start, so a vector that a third
of the rows repeat is compared once. Vectors of one pass with one key are ordered by their product
with a further direction, so that near ones stand side by side there too.

The passes only say what hangs together. Links are then counted exactly among all vectors of a
component: these are ordered by their angle to one of them and cut into tiles, and two tiles are
compared unless their angles alone say that all of their pairs are links, or that none is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, order_id, written
from .graph import components, thinned

PASSES, BITS, WINDOW, BLOCK, SEED = 24, 48, 64, 2048, 9
#: Members of a component in a tile; what angles and products may be wrong by through rounding.
TILE, ANGLE_SLACK, PRODUCT_SLACK = 2048, 1e-6, 1e-9


def _unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which of the rows are usable: finite, not null, not zero."""
    good = [v is not None and len(v) > 0 and None not in v for v in vectors]
    rows = [np.asarray(v, "f8") for v, ok in zip(vectors, good) if ok]
    good = np.array(good, bool)
    if not rows:
        return np.zeros((0, 0)), good
    matrix = np.stack(rows)
    with np.errstate(all="ignore"):
        largest = np.abs(matrix).max(1)
        usable = np.isfinite(matrix).all(1) & (largest > 0)
        scaled = matrix[usable] / largest[usable, None]
        unit = scaled / np.sqrt((scaled * scaled).sum(1))[:, None]
    good[np.flatnonzero(good)[~usable]] = False
    return unit, good


def _directions(size: int, passes: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED)).standard_normal((passes, size, BITS))


def _tie_directions(size: int, passes: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED + 1)).standard_normal((passes, size))


def _unit_rows(batches):
    """(cls, unit): each class's unit vector."""
    for batch in batches:
        for _, part in _by_length(batch):
            unit, good = _unit(part["embedding"].to_pylist())
            yield pa.RecordBatch.from_arrays([part["cls"].filter(pa.array(good)), pa.array([v.tobytes() for v in unit], pa.binary())], names=["cls", "unit"])


def _pass_rows(passes: int):
    """Keys and places for ties of each class in each pass; vectors don't take part in the sort."""

    def rows(batches):
        for batch in batches:
            for size, part in _by_length(batch):
                unit, good = _unit(part["embedding"].to_pylist())
                if not len(unit):
                    continue
                own = part["cls"].to_numpy()[good]
                planes, ties = _directions(size, passes), _tie_directions(size, passes)
                weights = 1 << np.arange(BITS - 1, -1, -1, dtype="i8")
                for k in range(passes):
                    keys = ((unit @ planes[k] > 0) @ weights).astype("i8")
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), k, "i4")), pa.array(np.full(len(own), size, "i4")), pa.array(keys), pa.array(unit @ ties[k]), pa.array(own)], names=["pass", "size", "key", "tie", "cls"])

    return rows


def _by_length(batch):
    lengths = np.array([len(v) if v.is_valid else 0 for v in batch["embedding"]])
    for size in np.unique(lengths[lengths > 0]).tolist():
        yield size, batch.filter(pa.array(lengths == size))


def _compare(least: float, window: int):
    def pairs(batches):
        """Rows come block by block; a block's own rows are compared with the next `window` ones."""
        block, held = None, []

        def found():
            held.sort(key=lambda r: r[0])
            place = np.array([r[0] for r in held])
            run = np.array([r[1] for r in held])
            cls = np.array([r[2] for r in held], "i8")
            units = [np.frombuffer(r[3], "f8") for r in held]
            a_out, b_out = [], []
            for lane in np.unique(run).tolist():
                here = np.flatnonzero(run == lane)
                unit, own = np.stack([units[i] for i in here]), cls[here]
                first = place[here] < (block + 1) * BLOCK
                for step in range(1, min(window, len(here) - 1) + 1):
                    near = np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= least
                    near &= first[:-step]
                    a_out.append(np.minimum(own[:-step][near], own[step:][near]))
                    b_out.append(np.maximum(own[:-step][near], own[step:][near]))
            if a_out:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a_out, b_out)], names=["a", "b"])

        for batch in batches:
            for r in zip(*[batch[c].to_pylist() for c in ("block", "place", "lane", "cls", "unit")]):
                if r[0] != block:
                    if held and (out := found()) is not None:
                        yield out
                    block, held = r[0], []
                held.append(r[1:])
        if held and (out := found()) is not None:
            yield out

    return pairs


def _angles(batches):
    """Members of components with their angles to the component's pivot."""
    for batch in batches:
        for _, part in _by_length(batch):
            unit, pivot = _unit(part["embedding"].to_pylist())[0], _unit(part["pivot"].to_pylist())[0]
            angle = 2 * np.arcsin(np.minimum(np.sqrt(((unit - pivot) ** 2).sum(1)) / 2, 1))
            columns = [part["label"], part["cls"], part["copies"], pa.array(angle), pa.array([v.tobytes() for v in unit], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "cls", "copies", "angle", "unit"])


def _near(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of a and b are linked; products close to the limit are taken again as the passes take them."""
    product = a @ b.T
    near = product >= least
    x, y = np.nonzero(np.abs(product - least) < PRODUCT_SLACK)
    near[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= least
    return near


def _count(least: float):
    def counts(batches):
        """(cls, others) for each pair of tiles i and j; rows come pair by pair, and by component within."""
        pair, held = None, []

        def found():
            label, tile, cls, copies = (np.array([r[k] for r in held], "i8") for k in range(4))
            others = np.zeros(len(held), "i8")
            heads = np.flatnonzero(np.append(True, label[1:] != label[:-1]))
            for a, b in zip(heads, np.append(heads[1:], len(label))):
                unit = np.frombuffer(b"".join([r[4] for r in held[a:b]]), "f8").reshape(b - a, -1)
                left, right = np.flatnonzero(tile[a:b] == pair[0]), np.flatnonzero(tile[a:b] == pair[1])
                near = _near(unit[left], unit[right], least)
                if pair[0] == pair[1]:
                    np.fill_diagonal(near, False)
                    others[a:b] = near @ copies[a:b]
                else:
                    others[a + left], others[a + right] = near @ copies[a + right], near.T @ copies[a + left]
            return pa.RecordBatch.from_arrays([pa.array(cls), pa.array(others)], names=["cls", "others"])

        for batch in batches:
            for r in zip(*[batch[c].to_pylist() for c in ("i", "j", "label", "tile", "cls", "copies", "unit")]):
                if r[:2] != pair:
                    if held:
                        yield found()
                    pair, held = r[:2], []
                held.append(r[2:])
        if held:
            yield found()

    return counts


def _placed(ordered: DataFrame) -> DataFrame:
    """Rows of a written table with column `at`, an increasing id, numbered through from 0 as `place`."""
    part = F.shiftright("at", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one number a partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    starts = ordered.sparkSession.createDataFrame(starts, "part long, first long")
    return ordered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("place", F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))


def _others(classes: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """(cls, others): how many vectors of other classes each class of a component is linked with, all pairs looked at."""
    members = classes.join(labels.select(F.col("node").alias("cls"), "label"), "cls")
    pivots = classes.select(F.col("cls").alias("label"), F.col("embedding").alias("pivot"))
    members = members.join(pivots, "label").select("label", "cls", "copies", "embedding", "pivot").mapInArrow(_angles, "label long, cls long, copies long, angle double, unit binary")
    ordered = members.repartitionByRange("label", "angle", "cls").sortWithinPartitions("label", "angle", "cls")
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "members")
    members = _placed(ordered).withColumn("tile", F.floor(F.col("place") / TILE).cast("long")).select("label", "tile", "cls", "copies", "angle", "unit")

    tiles = written(members.groupBy("label", "tile").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("n")), "tiles")
    i, j = (tiles.select("label", *[F.col(c).alias(f"{side}_{c}") for c in ("tile", "low", "high", "n")]) for side in "ij")
    reach = float(np.arccos(np.clip(least, -1, 1)))
    pairs = i.join(j, "label").where((F.col("i_tile") <= F.col("j_tile")) & (F.greatest(F.col("j_low") - F.col("i_high"), F.col("i_low") - F.col("j_high")) <= reach + ANGLE_SLACK))
    pairs = written(pairs.withColumn("sure", F.col("i_high") + F.col("j_high") <= reach - ANGLE_SLACK), "pairs")

    sides = F.when(F.col("i_tile") == F.col("j_tile"), F.array("i_tile")).otherwise(F.array("i_tile", "j_tile"))
    dealt = pairs.where("not sure").select("label", F.col("i_tile").alias("i"), F.col("j_tile").alias("j"), F.explode(sides).alias("tile")).join(members.drop("angle"), ["label", "tile"])
    dealt = dealt.select("i", "j", "label", "tile", "cls", "copies", "unit").repartition("i", "j").sortWithinPartitions("i", "j", "label")
    compared = dealt.mapInArrow(_count(least), "cls long, others long")

    both = F.array(F.struct(F.col("i_tile").alias("tile"), F.col("j_n").alias("n")), F.struct(F.col("j_tile").alias("tile"), F.col("i_n").alias("n")))
    known = pairs.where("sure").select("label", F.explode(F.when(F.col("i_tile") == F.col("j_tile"), F.slice(both, 1, 1)).otherwise(both)).alias("s"), (F.col("i_tile") == F.col("j_tile")).alias("own"))
    known = known.groupBy("label", F.col("s.tile").alias("tile")).agg(F.sum("s.n").alias("n"), F.max("own").alias("own"))
    known = members.join(known, ["label", "tile"]).select("cls", (F.col("n") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("others"))
    return compared.unionByName(known).groupBy("cls").agg(F.sum("others").alias("others"))


def near_vectors(rows: DataFrame, least: float = 0.95, passes: int = PASSES, window: int = WINDOW, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Links are pairs whose cosine in double precision is at least `least`; equal vectors are linked. The
    passes find the components; within each, every link counts. Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Rows with one id count as vectors of their own. A
    null id counts as the least and has component null if that is its component's least id.
    """
    vectors = rows.select(order_id(F.col(f"`{id_col}`").cast("long")).alias("k"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    # -0.0 and 0.0 are one value here
    plain = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    vectors = written(vectors.select("k", F.when(usable, plain).alias("embedding")).withColumn("digest", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))), "vectors")
    classes = vectors.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("k").alias("least_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = written(classes.withColumnRenamed("digest", "cls"), "classes")

    spread = classes.select("cls", "embedding").mapInArrow(_pass_rows(passes), "pass int, size int, key long, tie double, cls long")
    ordered = spread.repartitionByRange("pass", "size", "key", "tie", "cls").sortWithinPartitions("pass", "size", "key", "tie", "cls")
    placed = _placed(written(ordered.withColumn("at", F.monotonically_increasing_id()), "passes"))
    placed = placed.withColumn("lane", F.col("pass").cast("long") * (1 << 32) + F.col("size"))
    block = F.floor(F.col("place") / BLOCK).cast("long")
    in_blocks = F.when((F.col("place") % BLOCK < window) & (block > 0), F.array(block - 1, block)).otherwise(F.array(block))
    # each block fetches the vectors of its places
    units = classes.select("cls", "embedding").mapInArrow(_unit_rows, "cls long, unit binary")
    dealt = placed.select(F.explode(in_blocks).alias("block"), "place", "lane", "cls").join(units, "cls")
    dealt = dealt.select("block", "place", "lane", "cls", "unit").repartition("block").sortWithinPartitions("block")
    compare = _compare(least, window)
    labels = components(dealt.mapInArrow(lambda batches: thinned(compare(batches)), "a long, b long"))
    others = _others(classes, labels, least)
    known = classes.select("cls", "least_id", "copies").join(others, "cls", "left").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    known = written(known.select("cls", "least_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "cls").alias("label")), "known")
    least_ids = known.groupBy("label").agg(F.min("least_id").alias("component"))
    known = written(known.join(least_ids, "label").select("cls", "n_links", "component"), "found")
    out = vectors.join(known, F.col("digest") == F.col("cls"), "left")
    component = F.coalesce("component", "k")
    plain_id = lambda c: F.when(c != NULL_ID, c)
    return out.select(plain_id(F.col("k")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), plain_id(component).alias("component_id"), (component == F.col("k")).alias("kept"))
