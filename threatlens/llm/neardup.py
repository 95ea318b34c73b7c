"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct shingles of ``k`` words.  Documents with equal sets
form a class, and the class with the smallest doc_id of its documents as representative
is one node, so copies are never compared with each other.

Sketch: each shingle draws an ascending series of exponentially distributed points, one
for each of the ``REGISTERS`` registers in a pseudo-random order; a register keeps the
smallest point that it meets, as the whole number ``floor(1 - log_b(point))``.  Points
are only drawn while they can still lower a register's minimum (the truncation), so a
large set costs little more than its size.  Registers of a union are the maxima.

Candidates: ``BAND`` registers in a row are a band, and nodes that share a band value share
a bucket.  A register of two sets with similarity J is equal with a probability of at
least J, so at J = 0.8 all 75 bands miss with probability (1 - 0.8**8)**75 = 1e-6; at
J = 0.07, usual for two unrelated documents of a language, a band agrees with 6e-10.

Links: every node is first compared with the two nodes that are smallest in most of its
buckets; nodes so linked form components, and pairs inside a component are never compared.
Of the buckets that still hold nodes of different components, those with the same largest
component are a family.  A node with too many shingles of its own (that no other open node
has) can't reach the limit with anyone and is left out.

Families: the pivot P of a family holds the shingles of more than half of its sets, and D(x)
is the symmetric difference of x and P.  As |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|, with
weights w(x) = (100 + percent) |D(x)| - (100 - percent) |x| two sets reach the limit if and only
if 2 (100 + percent) |D(x) & D(y)| >= w(x) + w(y).  So

* sets whose weights add up to 0 or less are linked; all of these are linked with the set of
  least weight, which gives one link for each of them;
* any other two sets of different components must share differences.  D(x) is ordered from the
  rarest in the family on; if the first that x and y share is the i-th of x (from 0), they
  share at most |D(x)| - i, which must be enough for both weights.  Only the differences that
  can be such a first one for some set of another component are kept and joined.

These bounds are exact for any pivot, and texts of one family that lie just below the limit
share few of their own edits, so a large group of them is not compared in full.

For each pair the similarity is estimated by maximum likelihood from both sketches
together and the set sizes; pairs clearly below the limit go, the others are confirmed on
the full sets, the last ones in blocks of nodes, so that a set is sent to blocks and not to
pairs.

Components: the smallest label spreads along the links, with pointer jumping; each round
is checkpointed in the shared folder.

Defined results: an empty set (no words, null or empty text) is linked with nothing and is
its own component.  Rows that share a doc_id are one node, each with its own set.  A null
doc_id is in no component: component_id is null and kept is false.  An empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.llm.common import id_text, text_slices, texts
from threatlens.session import ensure_checkpoint_dir

REGISTERS = 601  # a prime: any step through the registers meets each once
BAND = 8
BANDS = REGISTERS // BAND
BASE = 1.02
RATE = 20.0
MARGIN = 0.085  # five standard errors of the estimate at 0.8
#: Registers and sets of the nodes that a task compares with each other, twice; pairs at a time.
BLOCK_BYTES, PAIRS = 4 << 20, 4096
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(rows: list[str], k: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in rows]  # bytes: A-Z only, ASCII white space
    flat = [w for ws in words for w in ws]
    if not flat:
        return [np.zeros(0, dtype=np.uint64)] * len(rows)
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    out, start = [], 0
    for ws in words:
        h = hashes[start : start + len(ws)]
        start += len(ws)
        n = len(ws) - k + 1
        if not len(ws):
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        width, count = (k, n) if n > 0 else (len(ws), 1)
        x = np.full(count, width, dtype=np.uint64)
        for i in range(width):
            x = _mix(x * _GOLD + h[i : i + count])
        out.append(np.unique(x))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set, one row each; zeros for an empty set."""
    m = REGISTERS
    low = np.zeros((len(sets), m), dtype=np.int32)
    flat_low = low.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    seed = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    point = np.zeros(len(seed))
    step = (_mix(seed + np.uint64(1)) % np.uint64(m - 1)).astype(np.int64) + 1
    place = (_mix(seed + np.uint64(2)) % np.uint64(m)).astype(np.int64)
    log_base = np.log(BASE)
    for j in range(m):
        if not len(seed):
            break
        u = ((_mix(seed + np.uint64((j + 3) * int(_GOLD) & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        point = point - np.log(u) / (RATE * (m - j))
        value = np.clip(np.floor(1.0 - np.log(point) / log_base), 0, 65535).astype(np.int32)
        np.maximum.at(flat_low, doc * m + place, value)
        # a later point of a shingle is larger: no use once it is below all registers
        alive = value > low.min(axis=1)[doc]
        doc, seed, point, step, place = doc[alive], seed[alive], point[alive], step[alive], place[alive]
        place = (place + step) % m
    return low


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The bucket of each band, as one number with the band's own number in it."""
    used = registers[:, : BANDS * BAND].reshape(len(registers), BANDS, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), used.shape[:2])
    for i in range(BAND):
        key = _mix(key * _GOLD + used[:, :, i])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of the sets of each pair of sketches, by maximum likelihood given the
    set sizes: of registers that are larger in a, larger in b and equal."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1.0 - up - down, tiny))

    left, right = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one top
        x, y = left + (right - left) / 3, right - (right - left) / 3
        up = likelihood(x) < likelihood(y)
        left, right = np.where(up, x, left), np.where(up, right, y)
    return (left + right) / 2


def _sketch_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            sets = shingle_sets(texts(batch), k)
            keys = band_keys(sketches(sets))
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([x if f else [] for x, f in zip(keys, full, strict=True)], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "bands"],
            )

    return run


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            sets = shingle_sets(texts(batch), k)
            registers = sketches(sets).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["doc_id", "registers", "shingles"],
            )

    return run


def _similar(ra: np.ndarray, rb: np.ndarray, sa: list[np.ndarray], sb: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether the sets of each pair are similar enough: sizes and estimate first, then in full."""
    na, nb = (np.array([len(x) for x in s], dtype=np.float64) for s in (sa, sb))
    linked = np.zeros(len(sa), dtype=bool)
    likely = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (na > 0) & (nb > 0)
    at = np.flatnonzero(likely)
    if len(at):
        at = at[estimate(ra[at], rb[at], na[at], nb[at]) >= percent / 100 - MARGIN]
    for i in at.tolist():
        both = len(np.intersect1d(sa[i], sb[i], assume_unique=True))
        linked[i] = 100 * both >= percent * (len(sa[i]) + len(sb[i]) - both)
    return linked


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(c).to_pylist() for c in ("ra", "rb", "sa", "sb")}
            ra, rb = (np.array([np.frombuffer(x, dtype=np.uint16) for x in col[c]]) for c in ("ra", "rb"))
            sa, sb = ([np.frombuffer(x, dtype=np.uint64) for x in col[c]] for c in ("sa", "sb"))
            linked = _similar(ra, rb, sa, sb, percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked))

    return run


def _verify_blocks(percent: int):
    def run(pairs: pa.Table, members: pa.Table) -> pa.Table:
        node = members.column("node").to_numpy()
        order = np.argsort(node, kind="stable")
        registers = [np.frombuffer(members.column("registers")[i].as_py(), dtype=np.uint16) for i in order.tolist()]
        sets = [np.frombuffer(members.column("shingles")[i].as_py(), dtype=np.uint64) for i in order.tolist()]
        node = node[order]
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        linked = np.zeros(len(a), dtype=bool)
        # a node may have several sets: each of a's against each of b's
        first = [np.searchsorted(node, x) for x in (a, b)]
        rows = [np.searchsorted(node, x, side="right") - f for x, f in zip((a, b), first, strict=True)]
        times = rows[0] * rows[1]
        for k in range(0, len(a), PAIRS):
            part = slice(k, k + PAIRS)
            pair = np.repeat(np.arange(len(a))[part], times[part])
            step = np.arange(len(pair)) - np.repeat(np.cumsum(times[part]) - times[part], times[part])
            i, j = first[0][pair] + step // rows[1][pair], first[1][pair] + step % rows[1][pair]
            if len(pair):
                ra, rb = (np.array([registers[x] for x in at.tolist()]) for at in (i, j))
                similar = _similar(ra, rb, [sets[x] for x in i.tolist()], [sets[x] for x in j.tolist()], percent)
                linked[pair[similar]] = True
        return pa.table({"a": pa.array(a[linked]), "b": pa.array(b[linked])})

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, checkpointed."""
    side = lambda n: sets.select(F.col("doc_id").alias(n), F.col("registers").alias(f"r{n}"), F.col("shingles").alias(f"s{n}"))
    full = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return full.mapInArrow(_verify(percent), "a long, b long").distinct().checkpoint()


def verified_in_blocks(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """As ``verified``, for many pairs of few nodes: a node's set goes once to each block of
    its partners, not once to each partner.  Nodes with the same smallest partner share a
    block, or several of about ``BLOCK_BYTES``; a task holds two blocks and their pairs."""
    home = pairs.select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("home")).groupBy("node").agg(F.min("home").alias("home"))
    sizes = sets.groupBy(F.col("doc_id").alias("node")).agg(F.sum(F.octet_length("registers") + F.octet_length("shingles")).alias("bytes"))
    placed = home.join(sizes, "node")
    parts = placed.groupBy("home").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("parts"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = placed.join(parts, "home").select("node", block.alias("block")).checkpoint()
    of = lambda n: placed.select(F.col("node").alias(n), F.col("block").alias(f"block_{n}"))
    keyed = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    keyed = keyed.select("a", "b", F.least("block_a", "block_b").alias("x"), F.greatest("block_a", "block_b").alias("y")).checkpoint()
    members = keyed.select(F.col("x").alias("of_x"), F.col("y").alias("of_y"), F.explode(F.array("a", "b")).alias("node")).distinct()
    members = members.join(sets.select(F.col("doc_id").alias("node"), "registers", "shingles"), "node")
    linked = keyed.groupBy("x", "y").cogroup(members.groupBy("of_x", "of_y")).applyInArrow(_verify_blocks(percent), "a long, b long")
    return linked.distinct().checkpoint()


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, doc_id) for each shingle of the packed sets."""
    for batch in batches:
        sets = [np.frombuffer(x, dtype=np.int64) for x in batch.column("shingles").to_pylist()]
        for k in range(0, len(sets), 200):
            part = sets[k : k + 200]
            if part:
                ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False)[k : k + 200], [len(x) for x in part])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)), pa.array(ids)], names=["shingle", "node"])


def shared_sizes(sets: DataFrame) -> DataFrame:
    """node, n, shared: the size of its set, and how many of a node's shingles another of these nodes has too."""
    rows = sets.mapInArrow(_shingle_rows, "shingle long, node long")
    alone = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).filter("node = last")
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    sizes = sets.groupBy(F.col("doc_id").alias("node")).agg(
        F.max(F.octet_length("shingles") / 8).cast("long").alias("n"), F.count(F.lit(1)).alias("rows")
    )
    # a node of several rows has several sets: no bound for it
    n = F.when(F.col("rows") == 1, F.col("n"))
    return sizes.join(alone, "node", "left").select("node", n.alias("n"), (n - F.coalesce("alone", F.lit(0))).alias("shared"))


def _most_shared(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b), one row for each bucket they share, the two of each node (``node``,
    or b) that share the most; each pair once."""
    node = "node" if "node" in pairs.columns else "b"
    most = Window.partitionBy(node).orderBy(F.desc("times"), "a", "b")
    counted = pairs.groupBy(*dict.fromkeys(["a", "b", node])).agg(F.count(F.lit(1)).alias("times"))
    return counted.withColumn("rank", F.row_number().over(most)).filter("rank <= 2").select("a", "b").distinct().checkpoint()


def _open_rows(buckets: DataFrame, label: DataFrame, bounds: DataFrame | None) -> DataFrame:
    """band, node, label of the buckets with nodes of several components."""
    rows = buckets.join(label, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    if bounds is not None:
        rows = rows.join(bounds.select("node"), "node", "left_semi")
    split = rows.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("band")
    return rows.join(split, "band").checkpoint()


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over the links (a, b)."""
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")).checkpoint()
    while True:
        of = lambda n: label.select(F.col("node").alias(n), F.col("label").alias(f"label_{n}"))
        near = ends.join(of("b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label_b").alias("near"))
        low = label.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        # pointer jumping: the label's own label
        new = low.join(of("to"), F.col("low") == F.col("to"), "left").select(
            "node", "label", F.least("low", F.coalesce("label_to", "low")).alias("new")
        ).checkpoint()
        changed = new.filter("new <> label").limit(1).count()
        label = new.select("node", F.col("new").alias("label"))
        if not changed:
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, label) after new links (a, b): components so far are one node
    each, so only links between different ones are followed."""
    of = lambda n: label.select(F.col("node").alias(n), F.col("label").alias(f"label_{n}"))
    ends = [F.coalesce(f"label_{n}", n).alias(n) for n in ("a", "b")]
    across = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(*ends).filter("a <> b").distinct().checkpoint()
    if not across.limit(1).count():
        return label
    top = components(across)
    known = label.join(top.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    known = known.select("node", F.coalesce("top", "label").alias("label"))
    return known.unionByName(top.join(label, "node", "left_anti")).checkpoint()


def _same_id(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the nodes of classes that rows of one doc_id belong to."""
    known = found.filter("doc_id is not null and class is not null").select("doc_id", "class")
    several = known.groupBy("doc_id").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x <> y").select("doc_id")
    nodes = known.join(several, "doc_id").join(classes, "class").select("doc_id", F.col("rep").alias("b")).distinct()
    first = nodes.groupBy("doc_id").agg(F.min("b").alias("a"))
    return nodes.join(first, "doc_id").filter("a <> b").select("a", "b").distinct()


def families(open_rows: DataFrame) -> DataFrame:
    """family, node: a bucket belongs to the largest component that it holds."""
    sizes = open_rows.select("node", "label").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    of = open_rows.join(sizes, "label").groupBy("band").agg(F.max(F.struct("size", "label")).alias("top"))
    return open_rows.join(of, "band").select(F.col("top.label").alias("family"), "node").distinct()


def _family_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(family, shingle) for each shingle of the packed sets."""
    for batch in batches:
        family = batch.column("family").to_numpy(zero_copy_only=False)
        for k in range(0, batch.num_rows, 200):
            sets = [np.frombuffer(x, dtype=np.int64) for x in batch.column("shingles").slice(k, 200).to_pylist()]
            ids = np.repeat(family[k : k + 200], [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets))], names=["family", "shingle"])


def _difference_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's size and its symmetric difference with the pivot of its family."""
    none = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            sets = [np.frombuffer(x, dtype=np.int64) for x in part.column("shingles").to_pylist()]
            pivots = [none if x is None else np.array(x, dtype=np.int64) for x in part.column("pivot").to_pylist()]
            lists = [np.setxor1d(x, y, assume_unique=True) for x, y in zip(sets, pivots, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("family", "unit", "node")),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["family", "unit", "node", "n", "differences"],
            )


def weighed(of: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """family, unit, node, differences, d, w: a row for each set of each node of a family."""
    placed = of.join(sets.select(F.col("doc_id").alias("node"), "unit", "shingles"), "node")
    counts = placed.select("family", "shingles").mapInArrow(_family_shingles, "family long, shingle long").groupBy("family", "shingle").count()
    half = placed.groupBy("family").agg((F.count(F.lit(1)) / 2).alias("half"))
    pivots = counts.join(half, "family").filter("count > half").groupBy("family").agg(F.collect_list("shingle").alias("pivot"))
    rows = placed.select("family", "unit", "node", "shingles").join(pivots, "family", "left")
    rows = rows.mapInArrow(_difference_rows, "family long, unit long, node long, n long, differences array<long>")
    d = F.size("differences").cast("long")
    return rows.select("family", "unit", "node", "differences", d.alias("d"), ((100 + percent) * d - (100 - percent) * F.col("n")).alias("w")).checkpoint()


def central_links(units: DataFrame) -> DataFrame:
    """Links (a, b) between the set of least weight of a family and those that it must reach."""
    hubs = units.groupBy("family").agg(F.min(F.struct("w", "node")).alias("hub"))
    found = units.join(hubs, "family").filter("w + hub.w <= 0 and node <> hub.node")
    return found.select(F.col("hub.node").alias("a"), F.col("node").alias("b"))


def _with_others(rows: DataFrame, keys: list[str], low: str, name: str) -> DataFrame:
    """The least ``low`` among the rows of the same keys with another label; rows without one go."""
    by_label = rows.groupBy(*keys, "label").agg(F.min(low).alias("low"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("low", "label"))
    two = by_label.withColumn("place", place).filter("place <= 2").groupBy(*keys).agg(
        F.min(F.struct("low", "label")).alias("first"), F.max("low").alias("second"), F.count(F.lit(1)).alias("labels")
    )
    other = F.when(F.col("label") == F.col("first.label"), F.col("second")).otherwise(F.col("first.low"))
    return rows.join(two.filter("labels = 2"), keys).withColumn(name, other).drop("first", "second", "labels")


def sharing_pairs(units: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes of different components whose sets can reach the limit, by the
    differences they share; the sets that ``central_links`` joins have one label."""
    once = 2 * (100 + percent)  # what a shared difference adds
    units = units.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # the partner of least weight decides how many differences must be shared
    units = _with_others(units, ["family"], "w", "other").filter(F.lit(once) * F.col("d") >= F.col("w") + F.col("other")).checkpoint()
    rows = units.select("family", "unit", "node", "label", "d", "w", "other", F.explode("differences").alias("difference"))
    times = rows.groupBy("family", "difference").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    rows = rows.join(times, ["family", "difference"])
    one = Window.partitionBy("family", "unit")
    # those that no other set has come first, and each counts as a place
    place = F.col("d") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("times", "difference")) - 1
    rows = rows.withColumn("reach", once * (F.col("d") - place) - F.col("w")).filter("reach >= other")
    # shared first here, x and y need the reach of x for the weight of y, and the other way round
    rows = rows.select("family", "difference", "node", "label", "w", "reach", (-F.col("reach")).alias("short")).checkpoint()
    keys = ["family", "difference"]
    # each step is stored: rows are read several times by the next one, and a stage of all steps
    # would hold a sorter for each of these readings
    rows = _with_others(rows, keys, "w", "lightest").filter("reach >= lightest").checkpoint()
    rows = _with_others(rows, keys, "short", "shortest").filter("w + shortest <= 0").checkpoint()
    left, right = (rows.select(*keys, *[F.col(c).alias(f"{c}_{n}") for c in ("node", "label", "w", "reach")]) for n in ("a", "b"))
    found = left.join(right, keys).filter("node_a < node_b and label_a <> label_b and reach_a >= w_b and reach_b >= w_a")
    return found.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def link_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = id_text(docs)
    found = rows.mapInArrow(_sketch_rows(k), "doc_id long, n_shingles long, class binary, bands array<long>").checkpoint()
    classes = found.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"))
    members = found.select("doc_id", "n_shingles", "class").join(classes, "class", "left")
    # one bands array for each class; only bands that two nodes share make a bucket
    nodes = found.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bands = nodes.filter("node is not null").select("node", F.explode("bands").alias("band")).repartition(parts, "band")
    shared = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last").select("band", "hub")
    buckets = bands.join(shared, "band").checkpoint()  # the rows of shared buckets alone
    sets = rows.join(buckets.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = sets.mapInArrow(_set_rows(k), "doc_id long, registers binary, shingles binary").checkpoint()
    # a first round against each bucket's smallest node, then what is left of the buckets by families
    tested = _most_shared(buckets.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")))
    label = components(verified(tested, sets, percent).union(_same_id(found, classes)))
    open_rows = _open_rows(buckets, label, None)
    open_sets = sets.join(open_rows.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # a node with too many shingles of its own reaches the limit with nobody
    bounds = shared_sizes(open_sets).filter(F.coalesce(100 * F.col("shared") >= percent * F.col("n"), F.lit(True))).select("node").checkpoint()
    of = families(_open_rows(buckets, label, bounds)).checkpoint()
    sets = open_sets.join(of.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = sets.withColumn("unit", F.monotonically_increasing_id()).checkpoint()
    units = weighed(of, sets, percent)
    label = merged(label, central_links(units))
    across = sharing_pairs(units, label, percent).join(tested, ["a", "b"], "left_anti").checkpoint()
    if across.limit(1).count():
        label = merged(label, verified_in_blocks(across, sets, percent))
    out = members.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("label", "rep", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, component).otherwise(F.col("doc_id")))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op5: two-word shingles, similarity of 0.8 or more."""
    return link_documents(docs, k=2, percent=80)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    gone = link_documents(docs, k=5, percent=80).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # each row is one struct, so its columns may have any names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = rows.join(gone, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
