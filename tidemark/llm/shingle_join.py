"""Documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

A set is a point: shingles are hashed to groups, and the point has the count of each group. Linked
sets differ in at most a ninth of their summed sizes, and so do their points. The points of a band of
sizes are indexed by R-trees. Their coordinates are dealt into slices, more than linked points can
differ in, so such points agree in all counts of some slice: each slice has a tree of its own, whose
top nodes are the boxes without extent in the slice's coordinates. These are found by one shuffle.
Below, a node's box is bulk-loaded in order of size and leading counts, and two trees' nodes are
descended in pairs while the summed minima of their upper bounds, which bound the overlap, allow a link.
For the boxes below the top, counts are folded to about as many groups as half the set's size, so that
long sets part as well as short ones. Pairs of points that survive are verified on whole texts.

Equal sets are one class. In each top node, classes are first verified against the one that most top nodes
share, so large groups of near copies hang together after one step; thereafter only pairs of classes
that aren't connected yet are looked at. No pair is given up: what is skipped is connected already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import NULL_ID, dropped, order_id, written
from .graph import Forest, components

WORDS, LEAF, TILE = 5, 16, 2048
#: Least and most groups of a stored point.
FEW, MANY = 16, 4096
#: Ways of dealing coordinates to slices; a further one serves sets that leave too many slices empty.
DEALS = 8
_M = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _bands() -> np.ndarray:
    """The least sizes of bands, each about half as much again as the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out)


BANDS = _bands()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes: A-Z lower-cased, words parted by ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    if len(h) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), 1)], "u8")
    n = len(h) - WORDS + 1
    s = np.zeros(n, "u8")
    for k in range(WORDS):
        s = (s ^ h[k : k + n]) * _M[k]
        s ^= s >> np.uint64(29)
    return np.unique(s)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two non-empty sets at least 0.8, in whole numbers."""
    if not len(a) or not len(b) or 10 * min(len(a), len(b)) < 8 * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common)


def _mixed(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[k % len(_M)]
    x ^= x >> np.uint64(29)
    return x * _M[(k + 1) % len(_M)]


def slices(own: np.ndarray) -> np.ndarray:
    """Digests of the point's slices: of its band, and of the next one if that has sets it may be linked with.

    In a band sets differ by at most `most` shingles, so of `k` slices k - most or more are equal. Slices
    that are empty in both are no meeting place, so where a set leaves that many empty, it is
    dealt in another way as well; a set that no way suits has one slice more, which all such sets share.
    """
    n = len(own)
    out = []
    band = int(np.searchsorted(BANDS, n, "right")) - 1
    for b in (band, band + 1):
        if b > band and 10 * n < 8 * BANDS[b]:
            continue
        top = int(BANDS[b + 1]) - 1
        far = (n + min(top, 10 * n // 8)) // 9  # shingles in one of the two sets only
        if not far:
            continue
        most = 2 * top // 9
        k = most + 1 + max(2, most // 8)
        for deal in range(DEALS):
            at = _mixed(own, deal)
            slot = ((at >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            order = np.argsort(slot, kind="stable")
            slot, group = slot[order], at[order]
            heads = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            # the sum does not depend on the order of the groups
            sums = np.add.reduceat(_mixed(group, deal + 2), heads)
            out.append(_mixed(sums ^ _mixed(slot[heads] + np.uint64((b * DEALS + deal) << 40), 1), 3))
            if k - len(heads) < k - far:
                break
        else:
            out.append(_mixed(np.array([b], "u8"), 4))
    return np.concatenate(out) if out else np.zeros(0, "u8")


def point(own: np.ndarray) -> np.ndarray:
    """Counts of the set's groups, at most 255 each; what they lack of the set's size is the rest."""
    groups = min(MANY, max(FEW, 1 << (max(1, len(own) // 2) - 1).bit_length()))
    return np.minimum(np.bincount((own % np.uint64(groups)).astype("i8"), minlength=groups), 255).astype("u1")


def _points(raw: list[bytes], size: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Points in `groups` groups, and the rest of each."""
    width = np.fromiter(map(len, raw), "i8", len(raw))
    out = np.empty((len(raw), groups), "u1")
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        counts = np.frombuffer(b"".join([raw[k] for k in own]), "u1").reshape(len(own), -1, groups)
        out[own] = counts[:, 0] if w == groups else np.minimum(counts.sum(1, dtype="u4"), 255)
    return out, size - out.sum(1, dtype="i8")


def _may_link(a: np.ndarray, b: np.ndarray, rests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the summed minima of upper bounds of counts allow a similarity of 0.8 for sets of these summed sizes."""
    out = np.empty(len(a), bool)
    step = max(1, (1 << 22) // max(1, a.shape[1]))
    for k in range(0, len(a), step):
        part = slice(k, k + step)
        out[part] = 9 * (np.minimum(a[part], b[part]).sum(1, dtype="i8") + rests[part]) >= 4 * sizes[part]
    return out


class CountTrees:
    """R-trees over points, one for each segment of the rows, all of one height.

    A node's box is known by the greatest counts and rest, and the least and greatest size, of its points.
    """

    def __init__(self, segment: np.ndarray, size: np.ndarray, comp: np.ndarray, points: np.ndarray, rest: np.ndarray):
        self.order = np.lexsort((*points.T[3::-1], size, segment))
        level = [segment[self.order], points[self.order], rest[self.order], size[self.order], size[self.order], comp[self.order], comp[self.order]]
        self.levels, self.children = [level], []
        #: How many pairs of nodes or points were looked at.
        self.visited = 0
        while True:
            seg = level[0]
            heads = np.flatnonzero(np.append(True, seg[1:] != seg[:-1])) if len(seg) else np.zeros(0, int)
            within = np.arange(len(seg)) - np.repeat(heads, np.diff(np.append(heads, len(seg))))
            starts = np.flatnonzero(within % LEAF == 0)
            _, tops, rests, least, most, low, high = level
            up = [np.maximum.reduceat(tops, starts), np.maximum.reduceat(rests, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)] if len(starts) else level[1:]
            level = [seg[starts], *up]
            self.levels.append(level)
            self.children.append((starts, np.append(starts[1:], len(seg))))
            if len(starts) == len(heads):
                break

    def root(self, segments: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.levels[-1][0], segments)

    def _open(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        _, tops, rests, least, most, low, high = self.levels[level]
        self.visited += len(x)
        ok = (10 * most[x] >= 8 * least[y]) & (10 * most[y] >= 8 * least[x])
        ok &= (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])
        at = np.flatnonzero(ok)
        step = max(1, (1 << 22) // max(1, tops.shape[1]))
        for k in range(0, len(at), step):
            part = at[k : k + step]
            a, b = x[part], y[part]
            ok[part] = _may_link(tops[a], tops[b], np.minimum(rests[a], rests[b]), least[a] + least[b])
        return ok

    def pairs(self, x: np.ndarray, y: np.ndarray, most: int = 1 << 11):
        """Places of rows (a, b) of different components below the pairs of roots (x, y) whose bound allows a link."""
        todo = [(len(self.children), x, y)]
        while todo:
            level, x, y = todo.pop()
            if len(x) > most and level:
                todo += [(level, x[k : k + most], y[k : k + most]) for k in range(0, len(x), most)]
                continue
            ok = self._open(level, x, y)
            x, y = x[ok], y[ok]
            if not len(x):
                continue
            if not level:
                yield self.order[x], self.order[y]
                continue
            starts, ends = self.children[level - 1]
            wide, high = ends[x] - starts[x], ends[y] - starts[y]
            n = wide * high
            owner = np.repeat(np.arange(len(x)), n)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            below_x, below_y = starts[x][owner] + nth // high[owner], starts[y][owner] + nth % high[owner]
            # a node with itself: each pair of its children once; a point not with itself
            once = (x != y)[owner] | ((below_x < below_y) if level == 1 else (below_x <= below_y))
            todo.append((level - 1, below_x[once], below_y[once]))


def _node_pairs(batches):
    """Pairs (a, b) of classes of different components that the trees let pass; rows come top node by top node."""
    names = ("sig", "i", "j", "tile", "node", "comp", "n")
    held, held_raw = None, []

    def pairs(rows, raw):
        sig, i, j, tile, node, comp, n = rows
        heads = np.flatnonzero(np.append(True, (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(sig))))
        width = np.minimum.reduceat(np.fromiter(map(len, raw), "i8", len(raw)), heads)
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width[group] == w)
            points, rest = _points([raw[k] for k in own], n[own], w)
            trees = CountTrees(2 * group[own] + (tile[own] != i[own]), n[own], comp[own], points, rest)
            here = np.unique(group[own])
            left = trees.root(2 * here)
            right = np.where(i[heads[here]] == j[heads[here]], left, trees.root(2 * here + 1))
            for x, y in trees.pairs(left, right):
                a, b = node[own[x]], node[own[y]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows, raw = [batch[c].to_numpy().astype("i8") for c in names], batch["counts"].to_pylist()
        if held is not None:
            rows, raw = [np.concatenate(x) for x in zip(held, rows)], held_raw + raw
        # the last top node may go on in the next batch
        last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
        n = int(np.argmax(last))
        if n:
            yield from pairs([r[:n] for r in rows], raw[:n])
        held, held_raw = [r[n:] for r in rows], raw[n:]
    if held is not None:
        yield from pairs(held, held_raw)


def _allowed(batches):
    """Pairs of points whose bound allows a link."""
    for batch in batches:
        a_n, b_n = batch["a_n"].to_numpy().astype("i8"), batch["b_n"].to_numpy().astype("i8")
        raw = [batch[c].to_pylist() for c in ("a_counts", "b_counts")]
        width = np.minimum(*(np.fromiter(map(len, r), "i8", len(r)) for r in raw))
        kept = np.zeros(len(a_n), bool)
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            (a, a_rest), (b, b_rest) = (_points([r[k] for k in own], n[own], w) for r, n in zip(raw, (a_n, b_n)))
            kept[own] = _may_link(a, b, np.minimum(a_rest, b_rest), a_n[own] + b_n[own])
        yield batch.select(["a", "b"]).filter(pa.array(kept))


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that may be linked, by size and by the bound."""
    a, b = (classes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("counts").alias(f"{c}_counts")) for c in "ab")
    sized = pairs.join(a, "a").join(b, "b").where(10 * F.least("a_n", "b_n") >= 8 * F.greatest("a_n", "b_n"))
    return sized.mapInArrow(_allowed, "a long, b long")


def _verified(batches):
    """Keeps linked pairs; a task skips pairs that its own links have connected."""
    forest, last = Forest(), (None, None)
    for batch in batches:
        out = []
        for a, b, a_text, b_text in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["a_text"], batch["b_text"]):
            if len(forest.up) > 1 << 20:
                forest = Forest()
            if forest.root(a) == forest.root(b):
                continue
            if last[0] != a:
                last = a, shingles(a_text.as_py())
            if linked(last[1], shingles(b_text.as_py())):
                forest.join(a, b)
                out.append((a, b))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _links(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that whole texts show to be linked, a text of each class being fetched."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.join(nodes, "node", "left_semi").select("key", "node")
    found = rows.withColumn("key", F.struct("doc", "tie")).join(wanted, "key").dropDuplicates(["node"])
    texts = written(found.select("node", "text"), "texts", compression="zstd")
    a, b = (texts.select(F.col("node").alias(c), F.col("text").alias(f"{c}_text")) for c in "ab")
    links = written(pairs.join(b, "b").join(a, "a").sortWithinPartitions("a", "b").mapInArrow(_verified, "a long, b long"), "links")
    dropped(texts)
    return links


def _once(members: DataFrame) -> DataFrame:
    """Top nodes (sig, node) without those that have the same members as another, told by a 64-bit digest and their number."""
    same = members.groupBy("sig").agg(F.bit_xor(F.xxhash64("node")).alias("digest"), F.count("*").alias("size"), F.min("node").alias("least"))
    kept = same.groupBy("digest", "size", "least").agg(F.min("sig").alias("sig")).select("sig")
    return members.join(kept, "sig", "left_semi")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, n_shingles, component, label) of every row; doc is NULL_ID for a null id, tie tells texts with one id apart.

    component is the smallest doc reachable by links, its own included; label tells apart what isn't
    reachable, also where ids are null or equal, and is null for an empty set. A null text, or one without
    words, has an empty set and links with nothing; one with fewer than five words has one shingle. Rows
    that repeat, or share an id, are documents of their own.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(order_id(F.col(f"`{id_col}`").cast("long")).alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))

    def described(batches):
        """A task gives the point of a set that it sees again only once, as far as its memory goes."""
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, sigs, counts = [], [], [], []
            for text in batch["text"]:
                own = shingles(text.as_py())
                node = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
                sizes.append(len(own))
                nodes.append(node if len(own) else None)
                if len(seen) > 1 << 19:
                    seen.clear()
                new = len(own) > 0 and node not in seen
                seen.add(node)
                sigs.append(slices(own).view("i8") if new else None)
                counts.append(point(own).tobytes() if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], batch["tie"], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.list_(pa.int64())), pa.array(counts, pa.binary())],
                names=["doc", "tie", "node", "n", "sigs", "counts"],
            )

    described_rows = rows.mapInArrow(described, "doc long, tie long, node long, n long, sigs array<long>, counts binary")
    table = written(described_rows, "sets", compression="zstd")
    firsts = table.where(F.col("sigs").isNotNull())
    classes = firsts.groupBy("node").agg(F.min(F.struct("doc", "tie")).alias("key"), F.first("n").alias("n"), F.first("counts").alias("counts"))
    classes = written(classes, "classes", compression="zstd")

    # Top nodes of at least two classes. One shuffle: by slice.
    meet = firsts.select(F.explode("sigs").alias("sig"), "node").repartition("sig").groupBy("sig", "node").agg(F.lit(0).alias("one"))
    of_sig = Window.partitionBy("sig")
    shared = meet.select("sig", "node", F.min("node").over(of_sig).alias("least"), F.max("node").over(of_sig).alias("most")).where("least < most")
    shared = written(shared.select("sig", "node"), "shared", compression="zstd")
    ids = written(table.select("doc", "tie", "node", "n"), "ids")
    dropped(table)
    tops = written(_once(shared), "tops", compression="zstd")
    dropped(shared)

    # Each class with the one that most top nodes share.
    weights = tops.groupBy("node").agg(F.count("*").alias("weight"))
    centred = tops.join(weights, "node").withColumn("centre", F.max(F.struct("weight", "node")).over(of_sig)["node"])
    stars = centred.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    stars = written(_bounded(stars.distinct(), classes), "stars")
    links = _links(stars, rows, classes)
    labels = components(links)

    # What is still apart within a top node.
    apart = tops.join(labels, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("comp"))
    apart = apart.select("*", F.min("comp").over(of_sig).alias("c0"), F.max("comp").over(of_sig).alias("c1")).where("c0 < c1").select("sig", "node", "comp")
    apart = written(apart, "apart", compression="zstd")
    dropped(tops)
    ranked = apart.select("*", F.floor((F.row_number().over(of_sig.orderBy("node")) - 1) / TILE).cast("int").alias("tile"), F.floor((F.count("*").over(of_sig) - 1) / TILE).cast("int").alias("last"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("last")), lambda t: F.struct(F.least(t, F.col("tile")).alias("i"), F.greatest(t, F.col("tile")).alias("j")))
    dealt = ranked.withColumn("at", F.explode(tiles)).select("sig", "at.i", "at.j", "node", "comp", "tile")
    dealt = dealt.join(classes.select("node", "n", "counts"), "node").repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    pairs = written(dealt.mapInArrow(_node_pairs, "a long, b long").distinct(), "pairs")
    dropped(apart, stars)
    if not pairs.isEmpty():
        links = links.unionByName(_links(pairs, rows, classes))
        labels = components(links)

    with_label = ids.join(labels, "node", "left").select("doc", "tie", "n", F.coalesce("label", "node").alias("label"))
    with_label = written(with_label, "labelled")
    dropped(ids, classes, pairs)
    # a table of its own, so that the join may split a hot label
    least = written(with_label.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc").alias("component")), "least")
    out = with_label.join(least, "label", "left")
    return out.select("doc", "tie", F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component"), "label")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group, the one with the smallest id (of equal ids the least by text hash).

    All columns stay. Documents without words all stay, but such rows that repeat as a whole come once.
    """
    found = similar(docs, id_col, text_col)
    firsts = found.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct("doc", "tie")).alias("__tm_key")).select("__tm_key", F.lit(False).alias("__tm_empty"))
    empty = found.where("n_shingles = 0").select(F.struct("doc", "tie").alias("__tm_key"), F.lit(True).alias("__tm_empty")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.withColumn("__tm_key", F.struct(order_id(F.col(f"`{id_col}`").cast("long")).alias("doc"), F.xxhash64(text).alias("tie")))
    whole = F.when(F.col("__tm_empty"), F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256))
    joined = keyed.join(firsts.unionByName(empty), "__tm_key").withColumn("__tm_whole", whole)
    return joined.dropDuplicates(["__tm_key", "__tm_whole"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def public_ids(found: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), null again where the id was."""
    plain = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return found.select(plain("doc").alias("doc_id"), "n_shingles", plain("component").alias("component_id"))
