"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A document is the multiset of its paragraphs (lines).  Each paragraph becomes a wide
vector, and a fingerprint is the sum of the vectors, component by component, modulo
2**32.  So the order of paragraphs doesn't matter, and a paragraph is inserted or deleted
by adding or subtracting its vector (``insert``, ``delete``).

The vector has two parts.  ``WIDE`` components are uniform 32-bit hashes of the whole
paragraph: they decide equality.  The rest describe its content: the number of its
pieces (runs of up to ``PIECE_WORDS`` words) and, for each of ``SIGNS`` sign hashes, how
many pieces have sign +1.  Sums of signs keep lengths and angles of the piece counts, so
the cosine of two fingerprints' sign sums estimates how much of their content is shared
(``likeness``).

All of it is Column expressions.  Two components share one 64-bit sum while a text is
read: 32 bits each, so none runs over before 2**31 pieces.

Defined results: null is the empty text, which is one empty paragraph; equal fingerprints
have likeness 1, and a fingerprint without pieces has likeness 0 to one with some.  The
next document is the next row by doc_id (null first), rows of one id by text; the next of
the last row is the first, so a table of one row follows itself.  An empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.llm.common import id_text

WIDE = 16
SIGNS = 64
PIECE_WORDS = 8
_LOW = 0xFFFFFFFF
#: Buckets of neighbouring ids per shuffle partition.
BUCKETS_PER_PARTITION = 6
MAX_BUCKETS = 4096


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, h: acc + term(h))


def with_lanes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the components of the fingerprint of column ``text`` as array<bigint>."""
    paragraphs = F.split(F.col(text), "\n", -1)
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"(?:\S++[^\S\n]*+){{1,{PIECE_WORDS}}}+"), F.lit(0))
    df = df.withColumns(
        {
            "_paragraphs": F.transform(paragraphs, lambda p: F.struct(F.xxhash64(p).alias("a"), F.xxhash64(p, F.lit(1)).alias("b"))),
            "_pieces": F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p))),
        }
    )
    lanes = []
    for k in range(WIDE):
        lanes.append(_sum(F.col("_paragraphs"), lambda h, k=k: F.xxhash64(h["a"], h["b"], F.lit(k)).bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW)))
    lanes.append(F.size("_pieces").cast("long"))
    packed = [
        _sum(F.col("_pieces"), lambda h, k=k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit((1 << 32) | 1))) for k in range(SIGNS // 2)
    ]
    df = df.withColumns({"_wide": F.array(*lanes), "_packed": F.array(*packed)})
    signs = F.concat(
        F.transform("_packed", lambda x: x.bitwiseAND(F.lit(_LOW))), F.transform("_packed", lambda x: F.shiftrightunsigned(x, 32))
    )
    return df.withColumn(out, F.concat("_wide", signs)).drop("_paragraphs", "_pieces", "_wide", "_packed")


def to_text(lanes: Column) -> Column:
    """The fingerprint as text: 8 hexadecimal digits a component."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def insert(lanes: Column, added: Column) -> Column:
    """The fingerprint with the paragraphs of another one added."""
    return F.zip_with(lanes, added, lambda x, y: (x + y).bitwiseAND(F.lit(_LOW)))


def delete(lanes: Column, removed: Column) -> Column:
    """The fingerprint with the paragraphs of another one taken away."""
    return F.zip_with(lanes, removed, lambda x, y: (x - y).bitwiseAND(F.lit(_LOW)))


def _sign_sums(lanes: Column) -> Column:
    """Sums of signs: twice the pieces with sign +1, less all pieces."""
    n = F.element_at(lanes, WIDE + 1)
    return F.transform(F.slice(lanes, WIDE + 2, SIGNS), lambda x: (2 * x - n).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two fingerprints' sign sums, 1 for equal fingerprints."""
    zero = F.lit(0.0)
    x, y = _sign_sums(a), _sign_sums(b)
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), zero, lambda s, p: s + p)
    norm = lambda v: F.aggregate(v, zero, lambda s, p: s + p * p)
    length = F.sqrt(norm(x) * norm(y))
    cosine = F.when(length > 0, F.least(F.lit(1.0), F.greatest(zero, dot / length))).otherwise(zero)
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def with_next(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with ``_bucket`` and ``_order``, dealt so that the next row by
    doc_id is in the same bucket.

    Quantiles of the ids, a bounded number of them, cut the ids into buckets.  The first
    row of each bucket is also dealt to the bucket before it, as its guest, so one
    shuffle of the texts by bucket brings all neighbours together; the very first row is
    the guest at the end of the last bucket.
    """
    spark = rows.sparkSession
    n = min(MAX_BUCKETS, BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    quantiles = rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)], F.lit(20 * n)).alias("q")).first()["q"]
    bounds = sorted(set(quantiles or []))
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= key)) if bounds else F.lit(0)
    firsts = rows.select(key.alias("_key"), bucket.alias("_bucket")).groupBy("_bucket").agg(F.min("_key").alias("first")).orderBy("_bucket").collect()
    if not firsts:
        return rows.withColumns({"_bucket": F.lit(0), "_order": F.struct(F.lit(False).alias("last"), F.lit(0).cast("long").alias("key")), "_own": F.lit(True)})
    at = [r["_bucket"] for r in firsts]
    before = [at[-1], *at[:-1]]
    host = F.map_from_arrays(F.array(*[F.lit(r["first"]) for r in firsts]), F.array(*[F.lit(b) for b in before]))
    own = F.struct(bucket.alias("bucket"), F.lit(True).alias("own"), F.lit(False).alias("last"))
    guest = F.struct(host[key].alias("bucket"), F.lit(False).alias("own"), (key == firsts[0]["first"]).alias("last"))
    places = F.when(host[key].isNotNull(), F.array(own, guest)).otherwise(F.array(own))
    dealt = rows.withColumn("_place", F.explode(places))
    return dealt.select(
        "doc_id",
        "text",
        F.col("_place.bucket").alias("_bucket"),
        F.struct(F.col("_place.last").alias("last"), key.alias("key")).alias("_order"),
        F.col("_place.own").alias("_own"),
    )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """op1: the fingerprint of each text and of its edited text, and their likeness."""
    rows = with_next(id_text(docs).withColumn("text", F.coalesce("text", F.lit(""))))
    near = Window.partitionBy("_bucket").orderBy("_order", "text", F.desc("_own"))
    rows = rows.withColumn("_next", F.coalesce(F.lead("text").over(near), F.lit("")))
    n = F.length("text")
    rows = rows.withColumns({"n_chars": n.cast("long"), "_half": F.floor(n / 2).cast("int")})
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - F.col("_half")), F.substring(F.col("_next"), F.lit(1), F.col("_half")))
    rows = rows.withColumn("_edited", F.when(F.col("_own"), edited).otherwise(F.lit(""))).drop("_next", "_half")
    rows = with_lanes(with_lanes(rows, "text", "_lanes"), "_edited", "_edited_lanes")
    rows = rows.withColumn("_next_lanes", F.lead("_lanes").over(near)).filter("_own")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        to_text(F.col("_lanes")).alias("fingerprint"),
        to_text(F.col("_edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("_lanes"), F.col("_edited_lanes")).alias("near_edited"),
        likeness(F.col("_lanes"), F.col("_next_lanes")).alias("near_next"),
    )


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return document_fingerprints(docs)
