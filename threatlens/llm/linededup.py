"""Line dedup by a log-template tree.

Words are cut at white space (tabs, carriage returns, no-break and wide blanks too); each
character of a script without blanks between words is a word.  Each line goes down a tree
of fixed depth: the number of its words, then its first ``lead_words`` words, then its
template.  Variable fields are generalised twice.  Words
with a digit (numbers, hashes, addresses, codes) become ``<*>`` before the tree.  And a
line of ``block_words`` or more words has, beside its full template, four templates in
each of which one quarter of the words after the leading ones is a wildcard, so lines
that differ inside one quarter meet in one template.

A template recurs if lines in two or more documents of different texts have it.  The full
template of a long line (of ``block_words`` words or ``long_chars`` characters) needs no
more than that; a wildcard template and a shorter line's need ``min_lines`` lines.  A line
goes if one of its templates recurs and the template's first document (smallest doc_id,
null last) is another one; so one example of each template stays.  Exact copies of a text
count as one document, lose the same lines and so stay exact copies: they are left to the
near-duplicate stage.  What else stands around a line does not matter, so a block of lines
goes as a whole.

Only keys, not lines, are shuffled, and once: the counts and the join back read the same
exchange.  A sample of the documents tells the keys of very many lines, at most one for
each partition; their lines are dealt over all partitions by document, and their counts are
added up.  The sample has no influence on the result.

Defined results: a null text stays null and has no lines; an empty line, or a short one,
always stays (fewer than ``min_words`` words, characters of scripts without blanks not
counted, and fewer than ``min_chars`` characters); rows equal in id and text are treated
alike; the first document keeps its repeats of a line; an empty table gives an empty one.
All Column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TemplateRules:
    #: lines that a wildcard template or a shorter line needs
    min_lines: int = 3
    #: characters from which a line of fewer than ``block_words`` words is long
    long_chars: int = 40
    min_words: int = 3
    #: characters, blanks not counted, from which a line of fewer words is not short
    min_chars: int = 12
    lead_words: int = 2
    #: shortest line with wildcard templates, in words
    block_words: int = 10


WILDCARD = "<*>"
BLOCKS = 4
#: A character of a script without blanks between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
#: Only a text with one of these has such characters or white space that is not ASCII.
NOT_PLAIN = r"[\x{85}\x{a0}\x{e00}-\x{1fff}\x{2028}\x{2029}\x{2e80}-\x{10ffff}]"
#: White space other than the blank and the line feed.
SPACES, WIDE_SPACES = "\t\r\x0b\x0c", r"[\x85\u00a0\u2028\u2029\u3000]"
#: One in so many documents is sampled; a key with so many lines in the sample is dealt by document.
SAMPLE, HOT_LINES = 32, 64


def _leaf(words: Column, rules: TemplateRules) -> Column:
    """The line's word count, its leading words, the hashes of its four quarters or, of a
    line that is not long enough for them, the line, and whether the line is short."""
    n = F.size(words)
    lead = F.array_join(F.slice(words, 1, rules.lead_words), " ")
    rest = n - rules.lead_words
    blocks = []
    for k in range(BLOCKS):
        begin = rules.lead_words + 1 + F.floor(rest * k / BLOCKS).cast("int")
        end = rules.lead_words + 1 + F.floor(rest * (k + 1) / BLOCKS).cast("int")
        blocks.append(F.xxhash64(F.array_join(F.slice(words, begin, F.greatest(end - begin, F.lit(0))), " ")))
    spaced = F.size(F.filter(words, lambda w: ~w.rlike(UNSPACED)))
    kept = (n >= rules.min_chars) | (F.length(F.array_join(words, "")) >= rules.min_chars) | (spaced >= rules.min_words)
    return F.struct(
        n.alias("n"),
        F.when(n >= rules.block_words, lead).otherwise(F.array_join(words, " ")).alias("lead"),
        F.when(n >= rules.block_words, F.array(*blocks)).alias("blocks"),
        (~kept).alias("short"),
    )


def _keys(leaf: Column, rules: TemplateRules) -> Column:
    """The template keys of one line: its leaf (count and leading words) hashed together
    with the words that the template fixes.  The lowest bit is 1 if the template needs
    ``min_lines`` lines."""
    n, lead = leaf["n"], leaf["lead"]
    blocks = [leaf["blocks"][k] for k in range(BLOCKS)]
    even = lambda h: h.bitwiseAND(F.lit(-2))
    full = even(F.xxhash64(F.lit(-1), n, lead, *blocks))
    wild = [F.xxhash64(F.lit(k), n, lead, *[b for j, b in enumerate(blocks) if j != k]).bitwiseOR(F.lit(1)) for k in range(BLOCKS)]
    line = even(F.xxhash64(F.lit(-1), n, lead)) + F.when(F.length(lead) < rules.long_chars, F.lit(1)).otherwise(F.lit(0))
    return F.when(leaf["short"], F.array().cast("array<bigint>")).when(n < rules.block_words, F.array(line)).otherwise(F.array(full, *wild))


def line_keys(rows: DataFrame, rules: TemplateRules) -> DataFrame:
    """doc_id, _hash (of the text), _line, _key for each line and template."""
    text = F.col("text")
    wide = F.regexp_replace(F.regexp_replace(text, WIDE_SPACES, " "), f"({UNSPACED})", " $1 ")
    spaced = F.when((F.octet_length(text) > F.length(text)) & text.rlike(NOT_PLAIN), wide).otherwise(text)
    for c in SPACES:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    # what stands before the first digit goes word by word
    masked = F.regexp_replace(spaced, r"\d\S*+", WILDCARD)
    word = lambda w: F.when(w.endswith(WILDCARD), WILDCARD).otherwise(w)
    lines = rows.filter(text.isNotNull()).select(
        "doc_id",
        F.xxhash64("text").alias("_hash"),
        F.transform(
            F.split(masked, "\n", -1), lambda x: F.transform(F.filter(F.split(x, " "), lambda w: w != ""), word)
        ).alias("_words"),
    )
    leaves = F.transform("_words", lambda w: _leaf(w, rules))
    keyed = lines.select("doc_id", "_hash", F.posexplode(F.transform(leaves, lambda x: _keys(x, rules))).alias("_line", "_keys"))
    return keyed.select("doc_id", "_hash", "_line", F.explode("_keys").alias("_key")).filter("_key is not null")


def hot_keys(rows: DataFrame, rules: TemplateRules, most: int) -> list[int]:
    """At most ``most`` keys of very many lines, from a sample of the documents."""
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0)
    counts = line_keys(sample, rules).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return [r["_key"] for r in counts.filter(F.col("n") >= HOT_LINES).orderBy(F.desc("n"), "_key").limit(most).collect()]


def _counts(keys: DataFrame, *by: str) -> DataFrame:
    """Lines, smallest and largest text hash and first document of partial counts."""
    return keys.groupBy(*by).agg(
        F.sum("_n").alias("_n"),
        F.min("_a").alias("_a"),
        F.max("_b").alias("_b"),
        F.min("_first").alias("_first"),
        F.min_by("_text", F.coalesce("_first", F.lit((1 << 63) - 1))).alias("_text"),
        F.min("_spread").alias("_spread"),
        F.max("_last").alias("_last"),
    )


def dropped_lines(rows: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """doc_id, _hash, _drop: the line numbers that go from each text that loses some."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col("_key").isin(hot_keys(rows, rules, parts))
    # 0: all lines of the key are together
    part = F.coalesce(F.when(hot, F.pmod(F.xxhash64("doc_id", "_hash"), F.lit(parts)) + 1).cast("int"), F.lit(0))
    # one exchange by key serves the counts and the join back; it is reused as all of them
    # read the same columns and filter after the aggregation only
    keys = line_keys(rows, rules).withColumn("_part", part).repartition(parts, "_key", "_part")
    one = keys.withColumns({"_n": F.lit(1).cast("long"), "_spread": F.col("_part"), "_last": F.col("_line"), "_first": F.col("doc_id")})
    counts = _counts(one.withColumns({c: F.col("_hash") for c in ("_a", "_b", "_text")}), "_key", "_part").filter("_last >= 0")
    enough = (F.col("_n") >= F.when(F.col("_key").bitwiseAND(F.lit(1)) == 1, rules.min_lines).otherwise(2)) & (F.col("_a") != F.col("_b"))
    whole = counts.filter((F.col("_spread") == 0) & enough)
    dealt = _counts(counts.filter("_spread > 0"), "_key").filter(enough).withColumn("_part", F.explode(F.sequence(F.lit(1), F.lit(parts))))
    recurring = whole.unionByName(dealt).select("_key", "_part", "_first", "_text")
    again = keys.join(recurring, ["_key", "_part"])
    gone = again.filter(~F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("_hash") != F.col("_text")))
    return gone.groupBy("doc_id", "_hash").agg(F.collect_set("_line").alias("_drop"))


def drop_recurring(docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """``row`` (the row as it was), ``text`` without the recurring lines, ``lines`` and
    ``dropped`` counts.  The row is one struct, so its columns may have any names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    drop = dropped_lines(docs.select("doc_id", "text"), rules).withColumnsRenamed({"doc_id": "drop_id", "_hash": "drop_hash"})
    text = F.col("row.text")
    joined = rows.join(drop, F.col("row.doc_id").eqNullSafe(F.col("drop_id")) & (F.xxhash64(text) == F.col("drop_hash")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("_drop"), i)), "\n")
    return joined.select(
        "row",
        F.when(F.col("_drop").isNull(), text).otherwise(kept).alias("text"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("dropped"),
    )


def line_dedup(spark: SparkSession, docs: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """op8: doc_id, n_lines, n_dropped, text without the recurring lines."""
    out = drop_recurring(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), rules)
    return out.select(F.col("row.doc_id").alias("doc_id"), F.col("lines").alias("n_lines"), F.col("dropped").alias("n_dropped"), "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without recurring lines; one that has lost all its lines goes."""
    out = drop_recurring(docs).filter((F.col("dropped") == 0) | (F.col("dropped") < F.col("lines")))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("dropped") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
