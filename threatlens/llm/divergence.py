"""Divergence of the sources of a language, by hash-consed segment trees over term ids.

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased.  Each language
keeps the terms of at least ``min_docs`` of its documents.  Kept terms get ids, in blocks of
about ``block_terms`` (the frequent ones first in a block, so that the counts of a small
source end in zeros).  A group, which is a source of a language, has a segment tree over the
ids of a block: a leaf is a count, an inner node the pair of its children.  Equal nodes
of all groups are one node, made level by level by sorting the children's numbers, so equal
count subtrees are shared wherever they stand.

The distance of two groups is priced by walking down both trees at once.  The walk keeps
each pair of nodes of a level once, with the number of places where it stands (the memo),
and leaves out equal nodes when the groups have equal totals.  Only pairs of leaves are
priced, in whole numbers.  The blocks' prices of a pair of groups are summed by Spark, so a
tree's upper levels are that sum.

A task holds one block of at most two chunks of ``chunk`` sources; large groups are spread
over the blocks.  A language's pairs of sources are the result itself (each source lists all
others), so they grow with the square of its sources.

Defined results: null text, lang and source count as empty texts, and the empty language
and source are groups as any other.  A group without terms has N = 0; in a language without
kept terms all distances are 0 and there are no term rows.  Ties rank by the item's UTF-8
order.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.llm.common import text_slices, texts
from threatlens.session import ensure_checkpoint_dir

#: Words of a text that a task splits at a time, in bytes, and counts that it holds.
PIECE, COUNTED = 1 << 20, 200_000
SCALE, PRIOR = 1_000_000_000, 5
#: Places over which a language's terms are spread.
SALTS = 256
#: Bytes of terms: A-Z to a-z, a-z and all bytes of non-ASCII characters as they are, the rest to blanks.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def text_terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in pieces, so that a very long one is never split whole."""
    flat = text.encode().translate(_TERM_BYTES)
    start = 0
    while start < len(flat):
        end = flat.find(b" ", start + PIECE)
        end = len(flat) if end < 0 else end
        yield flat[start:end].split()
        start = end


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: lang, source, term (null: the group occurs), n, docs."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = [None, *[t.decode() for t in n]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *[docs[t] for t in n]], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    held = 0
    for batch in text_slices(batches, "text"):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, texts(batch), strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            seen: set[bytes] = set()
            for terms in text_terms(text):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(n)
            if held >= COUNTED:
                yield from rows()
                held = 0
    yield from rows()


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of each count in a group, exactly."""
    divisor = total + PRIOR * terms
    if not divisor:
        return np.zeros(len(counts), dtype=np.int64)
    most = int(counts.max()) if len(counts) else 0
    if (most + PRIOR) * SCALE < 1 << 63:
        return 1 + (counts + PRIOR) * SCALE // divisor
    return np.array([1 + (int(c) + PRIOR) * SCALE // divisor for c in counts], dtype=np.int64)


def consed_trees(leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Root of each row of leaf counts, the children of the nodes of each level from the
    top, and the leaves' counts."""
    values, ids = np.unique(leaves, return_inverse=True)
    ids = ids.reshape(leaves.shape)
    levels = []
    while ids.shape[1] > 1:
        base = int(ids.max()) + 1
        nodes, up = np.unique(ids[:, 0::2].astype(np.int64) * base + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // base, nodes % base))
        ids = up.reshape(len(leaves), -1)
    return ids[:, 0], levels[::-1], values


def pair_prices(leaves: np.ndarray, totals: list[int], terms: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of groups a[i] and b[i], the sum of the differences of p over the leaves; a leaf of -1 is no term."""
    roots, levels, values = consed_trees(leaves)
    total = np.array(totals, dtype=object)
    same = np.array(total[a] == total[b], dtype=bool)
    pair, x, y = np.arange(len(a)), roots[a], roots[b]
    times = np.ones(len(a), dtype=np.int64)

    def differing(pair, x, y, times):
        keep = ~(same[pair] & (x == y))
        return pair[keep], x[keep], y[keep], times[keep]

    pair, x, y, times = differing(pair, x, y, times)
    for left, right in levels:
        pair, x, y, times = (
            np.concatenate([pair, pair]),
            np.concatenate([left[x], right[x]]),
            np.concatenate([left[y], right[y]]),
            np.concatenate([times, times]),
        )
        base = max(int(x.max()), int(y.max())) + 1 if len(x) else 1
        key, place = np.unique((pair * base + x) * base + y, return_inverse=True)
        times = np.bincount(place.ravel(), weights=times, minlength=len(key)).astype(np.int64)
        pair, x, y, times = differing(key // base // base, key // base % base, key % base, times)
    out = np.zeros(len(a), dtype=np.int64)
    keep = values[x] >= 0  # both or neither are terms
    pair, x, y, times = pair[keep], x[keep], y[keep], times[keep]
    price = np.zeros((len(totals), len(values)), dtype=np.int64)
    real = values >= 0
    for g, n in enumerate(totals):
        price[g, real] = shares(values[real], n, terms)
    np.add.at(out, pair, np.abs(price[a[pair], x] - price[b[pair], y]) * times)
    return out


def _price_block(table: pa.Table) -> pa.Table:
    """Prices of the pairs of sources of two chunks in one block."""
    rows = sorted(zip(*[table.column(c).to_pylist() for c in ("rank", "source", "total", "chunk", "counts")], strict=True), key=lambda r: r[0])
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    size, terms = table.column("size")[0].as_py(), table.column("terms")[0].as_py()
    width = 1 << max(0, (size - 1).bit_length())
    leaves = np.zeros((len(rows), width), dtype=np.int64)
    leaves[:, size:] = -1
    for g, row in enumerate(rows):
        if row[4]:
            leaves[g, [x["id"] for x in row[4]]] = [x["n"] for x in row[4]]
    chunk = np.array([r[3] for r in rows])
    a, b = np.triu_indices(len(rows), 1)
    across = (chunk[a] == first) & (chunk[b] == second)
    a, b = a[across], b[across]
    prices = pair_prices(leaves, [r[2] for r in rows], terms, a, b) if len(a) else np.zeros(0, dtype=np.int64)
    lang, source = table.column("lang")[0].as_py(), [r[1] for r in rows]
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": pa.array([source[i] for i in a.tolist()], pa.string()),
            "b": pa.array([source[i] for i in b.tolist()], pa.string()),
            "price": pa.array(prices, pa.int64()),
        }
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs; a row with a null term for each group."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(plain("text"), plain("lang"), plain("source"))
    counted = rows.mapInArrow(_count_rows, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """p as a Column, in decimals of 38 digits."""
    top = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, total + PRIOR * terms).cast("long") + 1


def group_pairs(kept: DataFrame, groups: DataFrame, sizes: DataFrame, block_terms: int, chunk: int) -> DataFrame:
    """lang, a, b, price: the distance of each two sources of a language, once.

    kept: lang, source, block, id, n; groups: lang, source, total, rank, chunk, chunks,
    terms; sizes: lang, block, size."""
    blocks = groups.select("lang", "terms").distinct().select("lang", F.explode(_block_numbers(block_terms)).alias("block"))
    blocks = blocks.join(sizes, ["lang", "block"], "left").select("lang", "block", F.coalesce("size", F.lit(0)).alias("size"))
    packed = kept.groupBy("lang", "block", "source").agg(F.collect_list(F.struct("id", "n")).alias("counts"))  # a block's ids at most
    rows = groups.join(blocks, "lang").join(packed, ["lang", "block", "source"], "left")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.withColumn("other", other).withColumns({"first": F.least("chunk", "other"), "second": F.greatest("chunk", "other")})
    priced = rows.drop("other", "chunks").groupBy("lang", "block", "first", "second").applyInArrow(
        _price_block, "lang string, a string, b string, price long"
    )
    return priced.groupBy("lang", "a", "b").agg(F.sum("price").alias("price"))


def _block_numbers(block_terms: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.ceil(F.col("terms") / block_terms).cast("int"), F.lit(1)) - 1)


def divergence_audit(docs: DataFrame, min_docs: int = 30, top: int = 50, block_terms: int = 2048, chunk: int = 16) -> DataFrame:
    """lang, source, part, item, value, rank: each source's distances to the others of its
    language, and its terms that stand out most from the language."""
    ensure_checkpoint_dir(docs.sparkSession)
    counts = term_counts(docs).checkpoint()
    by_lang = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    by_lang = by_lang.filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n")
    terms = by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    block = F.pmod(F.xxhash64("term"), F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1))).cast("int")
    # a language may hold most terms: its row meets them in several places
    salt = F.pmod(F.hash("term"), F.lit(SALTS)).alias("salt")
    spread = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = by_lang.select("*", salt).join(spread, ["lang", "salt"]).drop("salt").withColumn("block", block)
    order = Window.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "term")
    placed = placed.withColumn("id", F.row_number().over(order) - 1).checkpoint()
    sizes = placed.groupBy("lang", "block").agg(F.count(F.lit(1)).cast("int").alias("size"))
    kept = counts.join(placed.select("lang", "term", "lang_n", "block", "id"), ["lang", "term"])
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (
        counts.filter("term is null")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(placed.groupBy("lang").agg(F.first("terms").alias("terms"), F.first("lang_total").alias("lang_total")), "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")], rank.alias("rank"))
        .withColumn("chunk", F.floor(F.col("rank") / chunk).cast("int"))
        .withColumn("chunks", (F.max("chunk").over(Window.partitionBy("lang")) + 1).cast("int"))
        .checkpoint()
    )
    pairs = group_pairs(kept, groups.drop("lang_total"), sizes, block_terms, chunk)
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", F.explode(sides).alias("s"), F.col("price").alias("value")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    stands = kept.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    value = _share(F.col("n"), F.col("total"), F.col("terms")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    stands = stands.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).filter("value > 0")
    ranked = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs, stands = pairs.withColumn("rank", ranked), stands.withColumn("rank", ranked).filter(F.col("rank") <= top)
    return pairs.unionByName(stands)


def source_divergence(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op13: terms of 30 documents, all distances, 50 terms of each source."""
    return divergence_audit(docs)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with d as (
  select row_number() over () as u, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents
), w as (
  select u, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), c as (
  select lang, source, term, count(*) as n, count(distinct u) as docs from w group by all
), kept as (
  select lang, term, sum(n)::hugeint as q_n from c group by all having sum(docs) >= 30
), v as (
  select lang, count(*) as v, sum(q_n)::hugeint as q_total from kept group by all
), g as (
  select distinct lang, source from d
), t as (
  select g.lang, g.source, kept.term, coalesce(c.n, 0)::hugeint as n, q_n from g join kept using (lang) left join c using (lang, source, term)
), p as (
  select lang, source, term, n, 1 + 1000000000::hugeint * (n + 5) // (sum(n) over (partition by lang, source) + 5 * v)::hugeint as p,
    1 + 1000000000::hugeint * (q_n + 5) // (q_total + 5 * v) as q
  from t join v using (lang)
), pair as (
  select x.lang, x.source, y.source as item, coalesce((select sum(abs(a.p - b.p)) from p a join p b using (lang, term)
    where a.lang = x.lang and a.source = x.source and b.source = y.source), 0)::bigint as value
  from g x join g y on x.lang = y.lang and x.source <> y.source
), part as (
  select lang, source, 'pair' as part, item, value from pair
  union all
  select lang, source, 'term', term, (p - q)::bigint from p where n > 0 and p > q
), ranked as (
  select *, (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank from part
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""
