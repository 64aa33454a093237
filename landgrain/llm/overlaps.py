"""Near-duplicate documents by the exact Jaccard similarity of their word shingles.

Two sets with a similarity of 0.8 or more share one of the first fifth of their shingles in
any common order, so documents meet in blocks of one such shingle.  The order puts
shingles that are frequent in a sample last; it decides what meets where, not what is
found.  Sets of equal content are one node.  Nodes that SimHash fingerprints link, and every
node with the smallest one of its blocks that it meets most often, are compared first, then
nodes with the smallest ones of other components, and at last members of different components
with each other.  A link of fingerprints counts only if the sets are similar.  Parity
sketches, whose distance never exceeds the number of differing shingles, discard pairs
inside the blocks: one folded to 512 bits and then one with two bits for every shingle.  A run
first names the pairs of a forest over its components; those that hold join components, and
if some do not hold, all pairs of the components they are between come after.  The shared
shingles of the rest are counted, and the sets of these nodes alone are sent.

Sets are compared by 64-bit hashes of their shingles, and a node is a 64-bit hash of a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrain.llm import pairs as simhash
from landgrain.llm.components import components
from landgrain.llm.pairs import SLICE, _then_none
from landgrain.llm.spaces import cut, new_path
from landgrain.llm.words import grams, mix, parts, split

SHINGLE = 5
SHORT = 512
"""Bits of the folded sketch that is compared first."""
COMPARED = 1 << 26
"""Bits of sketches that are compared at once."""
KEYS_SENT = 1 << 20
"""Keys up to this number are broadcast; more are joined."""
SAMPLE = 5000
"""Documents whose shingles are counted to find frequent ones."""
FREQUENT = 8
"""Documents of the sample that make a shingle frequent."""
FREQUENT_KEPT = 100_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of every run of n words, A-Z lower-cased; of the whole sequence if it is shorter."""
    found = split(texts)
    found.data = _LOWER[found.data]
    hashes = found.hashes()
    runs = grams(hashes, n)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        else:
            out.append(grams(hashes[a:b], b - a, b - a) if b > a else np.zeros(0, np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """A hash of the whole set."""
    with np.errstate(over="ignore"):
        return int(mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def prefix(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The shingles of which a set with a similarity of 0.8 or more has one among its own."""
    count = len(shingles) - (4 * len(shingles) + 4) // 5 + 1 if len(shingles) else 0
    late = np.zeros(len(shingles), bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles
    return np.concatenate([shingles[~late], shingles[late]])[:count]


def sketch(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles at each place; two places for every shingle, SHORT at least, a power of two."""
    places = max(SHORT, 1 << (2 * len(shingles)).bit_length())
    counts = np.bincount((mix(shingles) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A sketch with at most `size` bits: places that are equal modulo `size` add up."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 64), axis=0)


def differing(a: bytes, b: bytes) -> int:
    """The distance of two sketches, at the size of the smaller one."""
    size = 8 * min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


def _per_set(docs: DataFrame, schema: str, rows) -> DataFrame:
    """The columns that `rows` makes of (key, shingle sets) of a run of documents; `docs` has key and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in parts(batch.column(1)):
                rest = batch.slice(a, b - a)
                names, columns = rows(rest.column(0), shingle_sets(rest.column(1)))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def _summary(key: pa.Array, sets: list[np.ndarray]):
    sketches = [sketch(s) for s in sets]
    prints = np.array([simhash.fingerprint(s) for s in sets], np.uint64).view(np.int64)
    columns = [key, pa.array([node_of(s) for s in sets], pa.int64()), pa.array(prints), pa.array([len(s) for s in sets], pa.int32()), pa.array(sketches, pa.binary())]
    return ["key", "node", "fp", "size", "sketch"], columns


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets or [np.zeros(0, np.uint64)]).view(np.int64)))


def _sets(key: pa.Array, sets: list[np.ndarray]):
    return ["node", "shingles"], [pa.array([node_of(s) for s in sets], pa.int64()), _lists(sets)]


def _alone(key: pa.Array, sets: list[np.ndarray]):
    return ["shingle"], [pa.array(np.concatenate(sets or [np.zeros(0, np.uint64)]).view(np.int64))]


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Shingles of many documents of a sample, sorted."""
    sample = docs.where(F.pmod(F.xxhash64("key"), F.lit(max(1, n // SAMPLE))) == 0)
    many = _per_set(sample, "shingle long", _alone).groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    rows = many.orderBy(F.desc("n"), "shingle").limit(FREQUENT_KEPT).select("shingle").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _verified(pairs: DataFrame, docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets have 4/5 of their union in common; `pairs` is cut."""
    if pairs.isEmpty():
        return pairs
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    # Written as Parquet, whose size is known when the join with the texts is planned.
    path = new_path(docs.sparkSession, "named")
    keys.join(wanted, "node").groupBy("node").agg(F.min("key").alias("key")).write.parquet(path)
    named = docs.sparkSession.read.parquet(path).select("key").distinct()
    if named.count() <= KEYS_SENT:
        named = F.broadcast(named)
    sets = cut(_per_set(docs.join(named, "key", "left_semi").select("key", "text"), "node long, shingles array<long>", _sets).join(wanted, "node", "left_semi").dropDuplicates(["node"]))
    u = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    v = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return cut(pairs.join(u, "u").join(v, "v").where(9 * shared >= 4 * (F.size("a") + F.size("b"))).select("u", "v"))


def _shared(spread: DataFrame) -> DataFrame:
    """(block, lead, node) of the blocks with two nodes or more, each node once; the lead is the smallest."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # block, lead and node of the row before
        for batch in batches:
            block, node = (batch.column(k).to_numpy() for k in (0, 1))
            n = len(block)
            if not n:
                continue
            if last is not None:
                block, node = np.append(last[0], block), np.append(last[2], node)
            first = np.append(True, block[1:] != block[:-1])
            new = np.append(True, (node[1:] != node[:-1]) | first[1:])
            lead = node[first][np.cumsum(first) - 1]
            if last is not None:
                lead[np.cumsum(first) == 1] = last[1]
                new[0] = False
            rows = np.flatnonzero(new & (node != lead))
            # The lead's own row comes with the second node of its block.
            second = rows[(node[rows - 1] == lead[rows - 1]) & (block[rows - 1] == block[rows])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(block[rows], block[second])), pa.array(np.append(lead[rows], lead[second])), pa.array(np.append(node[rows], lead[second]))],
                ["block", "lead", "node"],
            )
            last = block[-1], lead[-1], node[-1]

    return spread.repartition("block").sortWithinPartitions("block", "node").mapInArrow(keep, "block long, lead long, node long")


def _allowed(pairs: DataFrame, infos: DataFrame) -> DataFrame:
    """The rows of pairs (u, v, met) that sizes and sketches allow to be near; `infos` has node, size, sketch."""
    u, v = (infos.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("sketch").alias(f"{c}_sketch")) for c in "uv")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = (batch.column(3).to_numpy().astype(np.int64) + batch.column(5).to_numpy()) // 9
            near = [differing(a, b) <= m for a, b, m in zip(batch.column(4).to_pylist(), batch.column(6).to_pylist(), most.tolist())]
            yield batch.select([0, 1, 2]).filter(pa.array(near, pa.bool_()))

    su, sv = infos.select(F.col("node").alias("u"), F.col("size").alias("su")), infos.select(F.col("node").alias("v"), F.col("size").alias("sv"))
    sized = pairs.join(su, "u").join(sv, "v").where("5 * least(su, sv) >= 4 * greatest(su, sv)").select("u", "v", "met")
    return cut(sized.join(u, "u").join(v, "v").select("u", "v", "met", "u_size", "u_sketch", "v_size", "v_sketch").mapInArrow(keep, "u long, v long, met long"))


def _rooted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs with u_root and v_root: the smallest nodes of their components."""
    u, v = (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_at")) for c in "uv")
    at = [F.coalesce(f"{c}_at", c).alias(f"{c}_root") for c in "uv"]
    return pairs.join(u, "u", "left").join(v, "v", "left").select(*pairs.columns, *at)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of two components, with u_root and v_root."""
    return cut(_rooted(pairs, roots).where("u_root <> v_root"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) with further links: only the roots that they join are linked again."""
    if links.isEmpty():
        return roots
    further = components(_rooted(links, roots).select(F.col("u_root").alias("u"), F.col("v_root").alias("v")))
    moved = roots.join(further.select(F.col("node").alias("root"), F.col("root").alias("found")), "root", "left")
    return cut(moved.select("node", F.coalesce("found", "root").alias("root")).unionByName(further))


def _close(sketches: list[bytes], a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) of sketches have a distance of at most `most`, at the size of the smaller one."""
    places = 8 * np.fromiter(map(len, sketches), np.int64, len(sketches))
    size = np.minimum(places[a], places[b])
    out = np.zeros(len(a), bool)
    for bits in np.unique(size).tolist():
        some = np.flatnonzero(size == bits)
        who, at = np.unique(np.concatenate([a[some], b[some]]), return_inverse=True)
        table = np.stack([folded(sketches[k], bits) for k in who.tolist()])
        i, j = at[: len(some)], at[len(some) :]
        step = max(1, COMPARED // bits)
        for k in range(0, len(some), step):
            part = slice(k, k + step)
            out[some[part]] = np.bitwise_count(table[i[part]] ^ table[j[part]]).sum(axis=1) <= most[some[part]]
    return out


def may_be_near(run: np.ndarray, group: np.ndarray, size: np.ndarray, sketches: list[bytes], short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of the pairs of one run, in different groups, that sizes, short sketches and sketches allow to be near."""
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    alive = np.arange(len(run))
    d = 1
    while True:
        alive = alive[alive + d < len(run)]
        alive = alive[run[alive] == run[alive + d]]
        if not len(alive):
            break
        a = alive[group[alive] != group[alive + d]]
        x, y = size[a], size[a + d]
        fits = 5 * np.minimum(x, y) >= 4 * np.maximum(x, y)
        a, most = a[fits], ((x + y) // 9)[fits]
        near = np.bitwise_count(short[a] ^ short[a + d]).sum(axis=1) <= most
        first.append(a[near])
        second.append(a[near] + d)
        d += 1
    a, b = np.concatenate(first), np.concatenate(second)
    near = _close(sketches, a, b, (size[a] + size[b]) // 9)
    return a[near], b[near]


def one_per_groups(run: np.ndarray, group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, b), a forest of those that join the groups of each run; equal runs are adjacent.

    Every group keeps its first pair, so a run reports fewer pairs than it has members.
    """
    _, at = np.unique(np.stack([run, group]), axis=1, return_inverse=True)
    at = at.ravel()
    kept = np.zeros(len(a), bool)
    root = np.arange(len(at))
    while True:
        apart = np.flatnonzero(root[at[a]] != root[at[b]])
        if not len(apart):
            return a[kept], b[kept]
        u, v = root[at[a[apart]]], root[at[b[apart]]]
        first = np.full(len(root), len(a))
        np.minimum.at(first, u, apart)
        np.minimum.at(first, v, apart)
        kept[first[first < len(a)]] = True
        root = simhash.forest(len(root), at[a[kept]], at[b[kept]])


def _candidates(spread: DataFrame, nodes: DataFrame, forest: bool = False) -> DataFrame:
    """Pairs (u, v) of one block and two components that may be near; `nodes` has node, group, size, sketch.

    With `forest` a run reports the pairs of a forest over its components, fewer than its members.
    """
    member = spread.join(nodes.select("node", "group"), "node")
    marks = [F.expr(f"bit_xor(xxhash64({k}, node))").alias(f"x{k}") for k in range(2)]
    crowds = member.groupBy("block").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count("*").alias("n"), *marks).where("lo < hi")
    crowds = crowds.groupBy("n", "x0", "x1").agg(F.min("block").alias("block"))  # blocks of the same members meet once
    crowds = crowds.select("block", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    here = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    met = (
        spread.join(crowds, "block")
        .join(nodes, "node")
        .select("node", "group", "size", "sketch", "block", here.alias("here"), other.alias("other"))
        .select("node", "group", "size", "sketch", F.xxhash64("block", F.least("here", "other"), F.greatest("here", "other")).alias("run"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _then_none(batches):
            now = None if batch is None else pa.Table.from_batches([batch])
            held = now if rest is None else rest if now is None else pa.concat_tables([rest, now])
            if held is None or not held.num_rows:
                continue
            run = held["run"].to_numpy()
            stop = len(run) if batch is None else int(np.searchsorted(run, run[-1], "left"))
            rest = held.slice(stop)
            if not stop:
                continue
            held, run = held.slice(0, stop), run[:stop]
            node, group, size = (held[c].to_numpy() for c in ("node", "group", "size"))
            sketches = held["sketch"].to_pylist()
            a, b = may_be_near(run, group, size.astype(np.int64), sketches, np.stack([folded(x, SHORT) for x in sketches]))
            if forest:
                a, b = one_per_groups(run, group, a, b)
            pairs = np.unique(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    return met.repartition("run").sortWithinPartitions("run").mapInArrow(compare, "u long, v long").where("u <> v").distinct()


def _fingerprint_links(infos: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose SimHash fingerprints are equal or linked; `infos` has node and fp."""
    prints = cut(infos.groupBy("fp").agg(F.min("node").alias("node")))
    equal = infos.select("fp", F.col("node").alias("v")).join(prints.withColumnRenamed("node", "u"), "fp").where("u <> v").select("u", "v")
    return equal.unionAll(simhash.links(prints)).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _grouped(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, group, size, sketch) of the nodes; the group is the smallest node of the component."""
    found = roots.withColumnRenamed("root", "found")
    return nodes.join(found, "node", "left").select("node", F.coalesce("found", "node").alias("group"), "size", "sketch")


def _open(nodes: DataFrame, found: DataFrame, roots: DataFrame) -> DataFrame | None:
    """The nodes, grouped by `roots`, of the groups that some pair of `found` is still between; None if there is none.

    If a run that named a forest holds another pair of two groups, the forest leads from one to
    the other, and its links that do not hold touch both groups.
    """
    apart = _apart(found, roots)
    if apart.isEmpty():
        return None
    groups = apart.select(F.explode(F.array("u_root", "v_root")).alias("group")).distinct()
    return cut(_grouped(nodes, roots).join(groups, "group", "left_semi").select("node", "group", "size", "sketch"))


def near_sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) for every row with a key: the smallest key that similarities of 0.8 or more reach.

    Texts without words are equal to each other and to nothing else.
    """
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    rows = cut(_per_set(docs, f"key {kind}, node long, fp long, size int, sketch binary", _summary))
    keys = rows.select("key", "node")
    prints = rows.select("node", "fp").distinct()
    infos = rows.select("node", "size", "sketch").dropDuplicates(["node"])
    frequent = _frequent(docs, rows.count())

    def blocks(key: pa.Array, sets: list[np.ndarray]):
        heads = [prefix(s, frequent) for s in sets]
        node = np.repeat(np.array([node_of(s) for s in sets], np.int64), [len(h) for h in heads])
        return ["block", "node"], [pa.array(np.concatenate(heads or [np.zeros(0, np.uint64)]).view(np.int64)), pa.array(node)]

    spread = cut(_shared(_per_set(docs, "block long, node long", blocks)))
    stars = spread.where("lead <> node").groupBy(F.col("lead").alias("u"), F.col("node").alias("v")).agg(F.count("*").alias("met"))
    stars = _allowed(stars, infos)
    best = stars.groupBy("v").agg(F.max_by("u", F.struct("met", "u")).alias("u")).select("u", "v")
    first = _verified(cut(best.unionAll(_fingerprint_links(prints)).distinct()), docs, keys)
    roots = components(first)
    roots = _joined(roots, _verified(_apart(stars, roots).select("u", "v"), docs, keys))
    spread = spread.select("block", "node")
    nodes = cut(_grouped(spread.select("node").distinct().join(infos, "node"), roots))
    found = cut(_candidates(spread, nodes, True))  # pairs that join components
    roots = _joined(roots, _verified(found, docs, keys))
    apart = _open(nodes, found, roots)
    if apart is not None:  # all pairs of those that the found ones did not join
        roots = _joined(roots, _verified(cut(_candidates(spread, apart)), docs, keys))
    named = cut(keys.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root")))
    return named.join(named.groupBy("root").agg(F.min("key").alias("component_id")), "root").select(F.col("key").alias(key), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose doc_id is the smallest of their component; rows without a doc_id stay."""
    found = near_sets(docs).groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("least"))
    gone = cut(found.where("NOT least").select("doc_id"))  # fewer than those that stay, and the texts are not shuffled if they are sent
    if gone.count() <= KEYS_SENT:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti")
