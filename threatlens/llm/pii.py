"""Personal data by weak supervision.

Candidates: the base pattern of each kind (email, ip, card, phone), and a wider pattern for
the ways in which the same data is written otherwise (``name [at] host dot org``, defanged
and version 6 addresses, card numbers with unusual separators, phone numbers without a
plus sign).  The patterns are possessive and start only where a run of their characters
starts, so that a text of any length is scanned in linear time; that changes no match.

Labelers vote on each candidate for (1), against (-1) or not at all (0): the strict
pattern with its check, the check alone, gazetteers, words before the span that speak for
and against it, and what the span touches.  Votes are counted by pattern over all documents, at most
``3 ** 6`` patterns a kind; on these counts expectation-maximisation estimates each
labeler's reliability and the posterior of each pattern.  The posteriors are the soft
labels of the final span classifier, a logistic model for each kind over yes-or-no
features of a span, whose counts are again taken over all candidates.  It is compiled into a Column.

Spans: every base match that passes its check (``base``), and each other candidate with
a score of ``threshold`` or more that overlaps no base span and no added span that starts
before it.

Defined results: a null text is an empty one, without spans; rows that share a doc_id are
separate texts, a null doc_id stays null.  Without candidates there is no model and nothing
to add; an empty table gives an empty result.  Other columns are ignored.  A document's
spans are together in one task, as its text is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threatlens.llm.common import id_text
from threatlens.session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "check", "gazetteer", "context", "against", "edges")
#: Yes-or-no features of a span.
FEATURES = 12
#: Characters before and after a span that the labelers see.
BEFORE, AFTER = 40, 20

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: A run starts here, or the last match ended here.
_START = rf"(?:(?<!{_LOCAL})|\G)"
BASE = {
    "email": rf"{_START}{_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20(?=[A-Za-z0-9-]++\x20(?i:dot)\x20))"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\x20(?i:dot)\x20)"
_DEFANGED = r"(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))"
WIDE = {
    "email": rf"{_START}{_LOCAL}++{_AT}{_HOST}++(?:{_DOT}{_HOST}++)++",
    "ip": rf"(?<![0-9A-Za-z:.])(?:[0-9]{{1,3}}(?:{_DEFANGED}[0-9]{{1,3}}){{3}}|(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,3}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?![0-9]{1,3}(?:\.[0-9]{1,3}){3})(?:00[1-9][0-9]{0,2}[\x20.-]|\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?:[\x20.-][0-9]{2,4})?(?![0-9A-Za-z])",
}
#: Without a match of this a text has no candidate of the wider pattern.
WIDE_NEEDS = {"email": r"(?i)[\[({]\x20?at|\x20dot\x20", "ip": r"[0-9A-Fa-f](?::|[\[(](?:\.|dot))", "card": r"[0-9]{4}[\x20._/-]", "phone": r"[0-9)][\x20.-][0-9]{3}"}

# Gazetteers and context words.
TOP_DOMAINS = (
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "ai", "app", "dev", "co", "me", "tv", "eu",
    "us", "uk", "ca", "au", "nz", "ie", "de", "at", "ch", "fr", "be", "nl", "lu", "es", "pt", "it", "gr", "pl", "cz", "sk", "hu",
    "ro", "bg", "dk", "se", "no", "fi", "ee", "lv", "lt", "ru", "ua", "tr", "il", "in", "cn", "jp", "kr", "tw", "hk", "sg", "th",
    "vn", "id", "my", "ph", "br", "ar", "cl", "mx", "pe", "za", "ng", "ke", "eg", "ma", "sa", "ae",
)
COUNTRY_CODES = r"(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[0-3]|50[0-9]|59[0-9]|6[789][0-9]|85[0-6]|88[0-68]|9[679][0-9])"
CARD_ISSUERS = r"(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[68])|35(?:2[89]|[3-8])|6(?:011|4[4-9]|5)|62)"
FOR = {
    "email": ("mail", "contact", "write to", "correo", "courriel", "kontakt", "send"),
    "ip": ("ip", "address", "host", "server", "client", "from", "adresse", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "pay", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "cell", "fax", "whatsapp", "sms", "contact", "telefon", "llama"),
}
AGAINST = ("version", "isbn", "issn", "order", "invoice", "sku", "serial", "build", "section", "figure", "table", "page", "doi", "commit")


@dataclass(frozen=True)
class Fit:
    """Parameters of the label model and the classifier."""

    rounds: int = 100
    #: counts that each cell of a labeler starts with, and more where it votes rightly
    prior: float = 1.0
    belief: float = 2.0
    ridge: float = 1.0
    threshold: float = 0.5


def _matches(text: Column, kind: int, pattern: str, wide: bool) -> Column:
    """One struct for each match: its value, the length of the gap before it, and what stands around it.
    ``chain`` tells the matches of one pattern from those of the others."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if wide:
        needs = text.rlike(WIDE_NEEDS[KINDS[kind]])
    elif KINDS[kind] == "email":
        needs = F.contains(text, F.lit("@"))
    else:
        needs = text.rlike("[0-9]")
    none = F.array().cast("array<string>")

    def one(value: Column, i: Column) -> Column:
        gap = F.get(gaps_col, i)
        before = F.concat(F.coalesce(F.right(F.get(gaps_col, i - 1), F.lit(BEFORE)), F.lit("")), F.coalesce(F.get(found_col, i - 1), F.lit("")), F.right(gap, F.lit(BEFORE)))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(wide).alias("wide"),
            i.alias("i"),
            F.length(gap).cast("long").alias("gap"),
            value.alias("value"),
            F.lower(F.right(before, F.lit(BEFORE))).alias("before"),
            F.left(F.get(gaps_col, i + 1), F.lit(AFTER)).alias("after"),
        )

    name = f"{'wide' if wide else 'base'}_{KINDS[kind]}"
    found_col, gaps_col = F.col(f"_{name}"), F.col(f"_{name}_gaps")
    return F.when(needs, found).otherwise(none), F.when(F.size(found_col) > 0, gaps), F.transform(found_col, one), name


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    each = F.transform(F.split(F.reverse(digits), "(?!^|$)"), lambda x, i: F.when(i % 2 == 1, doubled(x.cast("int"))).otherwise(x.cast("int")))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def _small(value: Column, separators: str) -> Column:
    """Whether four numbers are at most 255 each."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:{separators}{part}){{3}}$")


def candidates(docs: DataFrame) -> DataFrame:
    """uid, doc_id, kind, wide, value, start, end, base, the votes and the features; a document
    without candidates has one row with a null kind."""
    rows = id_text(docs).select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = [_matches(F.col("text"), k, p[kind], p is WIDE) for k, kind in enumerate(KINDS) for p in (BASE, WIDE)]
    rows = rows.select("*", *[found.alias(f"_{name}") for found, _, _, name in parts])
    rows = rows.select("*", *[gaps.alias(f"_{name}_gaps") for _, gaps, _, name in parts])
    rows = rows.select("uid", "doc_id", F.explode_outer(F.concat(*[found for _, _, found, _ in parts])).alias("m")).select("uid", "doc_id", "m.*")
    before = Window.partitionBy("uid", "kind", "wide").orderBy("i")
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    return _voted(rows)


def _by_kind(*values: Column) -> Column:
    """The value of the row's kind, in the order of KINDS."""
    out = F.when(F.col("kind") == 0, values[0])
    for k, v in enumerate(values[1:], 1):
        out = out.when(F.col("kind") == k, v)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(~yes if no is None else no, -1).otherwise(0)


def _voted(rows: DataFrame) -> DataFrame:
    """The candidates with their votes and features, in steps that compute each part once."""
    value, before, after, wide, digits = (F.col(c) for c in ("value", "before", "after", "wide", "digits"))
    word = lambda words: before.rlike(rf"\b(?:{'|'.join(words)})")
    rows = rows.withColumn("digits", F.regexp_replace("value", "[^0-9]", ""))
    n = F.length(digits)
    rows = rows.withColumns(
        {
            "luhn": F.when(F.col("kind") == KINDS.index("card"), F.when(n <= 20, _luhn(digits)).otherwise(False)),
            "domain": F.when(F.col("kind") == KINDS.index("email"), F.lower(F.regexp_extract("value", "([A-Za-z0-9-]+)$", 1))),
            "plain": ~F.contains(value, F.lit(":")),
            "context": F.coalesce(_by_kind(*[word(FOR[k]) for k in KINDS]), F.lit(False)),
            "against": F.coalesce(word(AGAINST), F.lit(False)),
            "glued": F.coalesce(before.rlike(r"[\p{L}\p{N}_@=/\\-]$") | after.rlike(r"^[\p{L}\p{N}_@/\\]"), F.lit(False)),
        }
    )
    passes = _by_kind(F.lit(True), _small(value, r"\."), n.between(14, 19) & F.col("luhn"), n.between(10, 15))
    rows = rows.withColumns(
        {
            "passes": passes,
            "check": _by_kind(
                F.col("domain").rlike("^[a-z]{2,}$"),
                ~F.col("plain") | _small(value, rf"(?:\.|{_DEFANGED})"),
                F.col("luhn") & n.between(14, 19),
                n.between(7, 15) & ~digits.rlike(r"^([0-9])\1*+$"),
            ),
            "gazetteer": _by_kind(
                _vote(F.col("domain").isin(*TOP_DOMAINS)),
                _vote(F.lit(False), F.col("plain") & value.rlike(r"^0*(?:0|127|255|22[4-9]|2[34][0-9])(?![0-9])")),
                _vote(digits.rlike(f"^{CARD_ISSUERS}")),
                F.when(wide, 0).otherwise(_vote(digits.rlike(f"^{COUNTRY_CODES}"))),
            ),
        }
    )
    votes = {
        "strict": F.when(wide, 0).otherwise(_vote(F.col("passes"))),
        "check": _vote(F.col("check")),
        "gazetteer": F.col("gazetteer"),
        "context": F.when(F.col("context"), 1).otherwise(0),
        "against": F.when(F.col("against"), -1).otherwise(0),
        "edges": _vote(~F.col("glued")),
    }
    features = (
        F.col("check"),
        F.col("gazetteer") > 0,
        F.col("gazetteer") < 0,
        F.col("context"),
        F.col("against"),
        F.col("glued"),
        wide,
        value.rlike(r"[\x20().-]"),
        n >= 12,
        value.rlike(r"([0-9])\1{4}"),
        before.rlike(r"[:=#]\s*+$"),
        before.rlike(r"(?:^|\n|\.\s)\s*+$"),
    )
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(features)), F.lit(0))
    has = F.col("kind").isNotNull()
    return rows.select(
        "uid",
        "doc_id",
        "kind",
        "wide",
        "value",
        "start",
        "end",
        F.when(has, ~wide & F.col("passes")).alias("base"),
        F.when(has, F.array(*[votes[v].cast("tinyint") for v in LABELERS])).alias("votes"),
        F.when(has, bits).alias("features"),
    )


def estimate(counts: dict[tuple[int, ...], int], fit: Fit) -> tuple[dict[tuple[int, ...], float], np.ndarray, float]:
    """Of one kind's vote patterns and their counts: the posterior of each, the labelers'
    vote probabilities [labeler, class, vote + 1] and the share of the class."""
    patterns = list(counts)
    votes = np.array(patterns) + 1
    weight = np.array([counts[p] for p in patterns], dtype=float)
    posterior = 1.0 / (1.0 + np.exp(-np.array(patterns).sum(axis=1, dtype=float)))
    start = np.full((votes.shape[1], 2, 3), fit.prior)
    start[:, 1, 2] += fit.belief
    start[:, 0, 0] += fit.belief
    for _ in range(fit.rounds):
        table = start.copy()
        for labeler in range(votes.shape[1]):
            np.add.at(table[labeler, 1], votes[:, labeler], weight * posterior)
            np.add.at(table[labeler, 0], votes[:, labeler], weight * (1 - posterior))
        table /= table.sum(axis=2, keepdims=True)
        share = (fit.prior + (weight * posterior).sum()) / (2 * fit.prior + weight.sum())
        log = np.log(table)[np.arange(votes.shape[1]), :, votes].sum(axis=1)
        odds = log[:, 1] - log[:, 0] + np.log(share) - np.log(1 - share)
        posterior = 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))
    return dict(zip(patterns, posterior.tolist(), strict=True)), table, float(share)


def logistic(rows: list[tuple[int, int, float]], fit: Fit) -> list[float]:
    """Weights (the constant last) of the features; rows: feature bits, count, sum of soft labels."""
    x = np.array([[*[(bits >> k) & 1 for k in range(FEATURES)], 1] for bits, _, _ in rows], dtype=float)
    n, y = (np.array([r[k] for r in rows], dtype=float) for k in (1, 2))
    w = np.zeros(FEATURES + 1)
    for _ in range(50):  # Newton steps; the ridge keeps them small
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + fit.ridge * np.eye(len(w)), x.T @ (y - n * p) - fit.ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def train(found: DataFrame, fit: Fit) -> dict[int, list[float]]:
    """Weights of the span classifier for each kind that has candidates."""
    found = found.filter("kind is not null")
    counts: dict[int, dict[tuple[int, ...], int]] = {}
    for r in found.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect():  # at most 4 * 3 ** 6
        counts.setdefault(r["kind"], {})[tuple(r["votes"])] = r["n"]
    if not counts:
        return {}
    labels = [(k, list(p), round(q * 1e6)) for k, c in counts.items() for p, q in sorted(estimate(c, fit)[0].items())]
    soft = found.sparkSession.createDataFrame(labels, "kind int, votes array<tinyint>, soft long")
    rows: dict[int, list[tuple[int, int, float]]] = {}
    grouped = found.join(F.broadcast(soft), ["kind", "votes"]).groupBy("kind", "features")  # soft: at most 4 * 3 ** 6 rows
    for r in grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("soft").alias("soft")).collect():  # at most 4 * 2 ** 12
        rows.setdefault(r["kind"], []).append((r["features"], r["n"], r["soft"] / 1e6))
    return {k: logistic(sorted(r), fit) for k, r in rows.items()}


def score_column(weights: dict[int, list[float]]) -> Column:
    """The classifier as a Column over kind and features."""
    out = F.lit(None).cast("double")
    for kind, w in weights.items():
        z = F.lit(w[-1])
        for k in range(FEATURES):
            z = z + F.when(F.col("features").bitwiseAND(F.lit(1 << k)) > 0, F.lit(w[k])).otherwise(0.0)
        out = F.when(F.col("kind") == kind, 1.0 / (1.0 + F.exp(-z))).otherwise(out)
    return out


def find_spans(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """uid, doc_id, kind, start, end, value, base, score of all spans; a document without
    spans has one row with a null kind.  uid tells the rows of the table apart."""
    ensure_checkpoint_dir(docs.sparkSession)
    found = candidates(docs).checkpoint()
    scored = found.withColumn("score", score_column(train(found, fit)))
    added = ~F.col("base") & F.coalesce(F.col("score") >= fit.threshold, F.lit(False))
    scored = scored.withColumn("added", F.coalesce(added, F.lit(False)))
    order = ["start", "kind", "end", "wide"]
    forward = Window.partitionBy("uid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("uid").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    free = ~(
        F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(forward) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(backward) < F.col("end"), F.lit(False))
    )
    scored = scored.withColumn("added", F.col("added") & free)
    first = ~F.coalesce(F.max(F.when(F.col("added"), F.col("end"))).over(forward) > F.col("start"), F.lit(False))
    scored = scored.withColumn("added", F.col("added") & first)
    span = F.coalesce(F.col("base"), F.lit(False)) | F.col("added")
    # one row of a document without spans stays
    scored = scored.withColumn("span", span).withColumn("any", F.max("span").over(Window.partitionBy("uid")))
    scored = scored.withColumn("row", F.row_number().over(Window.partitionBy("uid").orderBy(*order)))
    scored = scored.filter("span or (not any and row = 1)")
    kept = lambda c: F.when(F.col("span"), F.col(c)).alias(c)
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return scored.select("uid", "doc_id", F.when(F.col("span"), kind).alias("kind"), *[kept(c) for c in ("start", "end", "value", "base", "score")])


def _joined(spans: Column) -> Column:
    """kind:start:end of sorted (start, kind number, end) structs."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """op12: one row for each document, with the counts and the digest of its base spans."""
    spans = find_spans(docs)
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    span = F.struct("start", number.alias("no"), "end")
    base = F.coalesce(F.col("base"), F.lit(False))
    out = spans.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when(base & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(base, span)).alias("base_spans"),
        F.collect_list(F.when(F.col("kind").isNotNull(), span)).alias("all_spans"),
    )
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"), _joined(F.col("all_spans")).alias("spans"))
