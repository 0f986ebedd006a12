"""Secret scan with DataFrame functions only: fixed patterns, and a randomness test battery.

Tokens that no pattern covers are tested against the uniform distribution over the alphabet of
their inferred encoding: chi-squared of the symbol counts, runs above and below the middle of the
alphabet, and lag-one serial correlation.  The three p-values are combined (Bonferroni).  For random
tokens the combined value spreads over (0, 1) in a known way; for words, paths and numbers it piles up at 0.
So within each stratum of encoding and length the number of random tokens can be estimated from the higher
values, and the cut is the lowest one above which the share of ordinary tokens, the false discovery rate, stays
under a target; a token that fails the tests by itself is out in any case.  A stratum of few tokens is estimated together
with its neighbours, its encoding or all tokens, so that a rare encoding or length is not lost.  Each encoding has a least length: below it the
chi-squared test could not tell its text from noise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelanes.llm.common import text_key
from tradelanes.session import stored

# The patterns that have to be found, in the order kinds are listed, and the least
# length of (for assign) the value or (else) the match.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": ("AKIA[A-Z0-9]+", 16),
    "hex": ("[0-9a-f]+", 32),
}
RANDOM = "random"  # the kind of spans that the battery adds; listed last
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from narrow to wide: name, pattern of a whole token, alphabet in its order.
ENCODINGS = [
    ("hex", "[0-9a-f]+", DIGITS + LOWER[:6]),
    ("hexup", "[0-9A-F]+", DIGITS + UPPER[:6]),
    ("lower", "[a-z]+", LOWER),
    ("upper", "[A-Z]+", UPPER),
    ("base32", "[A-Z2-7]+", UPPER + DIGITS[2:8]),
    ("base36", "[0-9a-z]+", DIGITS + LOWER),
    ("base36up", "[0-9A-Z]+", DIGITS + UPPER),
    ("base62", "[0-9A-Za-z]+", DIGITS + UPPER + LOWER),
    ("base64", "[0-9A-Za-z+/]+", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "[0-9A-Za-z_-]+", UPPER + LOWER + DIGITS + "-_"),
]
TEXT_COINCIDENCE = 0.065  # chance that two letters of ordinary text are the same (published for English)
POWER = 4.0  # standard deviations by which ordinary text has to miss the chi-squared mean
BINS = 20  # of the combined p-value
FAILED = 0.01  # p-value under which a token is not random, however few such tokens its stratum has
SURE = 5  # bin from which tokens are taken for random ones when these are counted
THIN = 100  # tokens under which a stratum is estimated together with others
ERRORS = 2.0  # standard errors that the estimate is given where all tokens together are so few


def least_length(size: int) -> int:
    """Length from which text over an alphabet of this size misses the uniform chi-squared by POWER."""
    return max(20, 1 + math.ceil(POWER * math.sqrt(2 * (size - 1)) / (size * TEXT_COINCIDENCE - 1))) if size > 16 else 20


def _matches(rows: DataFrame, kind: str, pattern: str) -> DataFrame:
    """One row for each leftmost non-overlapping match: doc_id, key, kind, start, end, match.

    The pieces between the matches give the places: a running sum of lengths, linear in the matches."""
    parts = rows.where(F.col("text").rlike(pattern)).select(
        "doc_id", "key", F.posexplode(F.arrays_zip(
            F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("match"))).alias("pos", "part"))
    before = Window.partitionBy("doc_id", "key").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = F.length("part.gap") + F.coalesce(F.length("part.match"), F.lit(0))
    placed = parts.select("doc_id", "key", F.col("part.match").alias("match"), F.sum(both).over(before).alias("end"))
    return (placed.where("match is not null")
            .select("doc_id", "key", F.lit(kind).alias("kind"), (F.col("end") - F.length("match")).alias("start"), "end", "match"))


def base_spans(rows: DataFrame) -> DataFrame:
    """Spans of the fixed patterns in rows (doc_id, key, text) that are distinct by doc_id and key."""
    out = None
    for kind, (pattern, least) in PATTERNS.items():
        # A run of one class of characters matches whole, so the least length can be part of the pattern.
        strict = {"access": rf"AKIA[A-Z0-9]{{{least - 4},}}", "hex": rf"[0-9a-f]{{{least},}}"}.get(kind)
        found = _matches(rows, kind, strict or pattern)
        if strict is None:
            found = found.where(F.length(F.regexp_extract("match", pattern, 2)) >= least)
        out = found if out is None else out.unionByName(found)
    return out


def _normal_tail(z: Column) -> Column:
    """Two-sided p-value of a normal score (logistic form of the distribution, error under 0.0002)."""
    a = F.least(F.abs(z), F.lit(30.0))
    return 2.0 / (1.0 + F.exp(1.5976 * a + 0.07056 * a * a * a))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds encoding, band (of lengths) and p to rows with ``match``; tokens too short for their
    encoding go."""
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    least = F.lit(None).cast("int")
    for label, pattern, symbols in reversed(ENCODINGS):
        fits = F.col("match").rlike(f"^{pattern}$")
        name, alphabet = F.when(fits, label).otherwise(name), F.when(fits, symbols).otherwise(alphabet)
        least = F.when(fits, least_length(len(symbols))).otherwise(least)
    rows = tokens.select("*", name.alias("encoding"), alphabet.alias("alphabet"), least.alias("least"),
                         F.length("match").cast("double").alias("n"))
    rows = rows.where("encoding is not null and n >= least").withColumn("k", F.length("alphabet").cast("double"))
    rows = rows.withColumn("x", F.expr("transform(split(match, ''), c -> cast(instr(alphabet, c) - 1 as double))"))
    # Chi-squared of the symbol counts, as a normal score (Wilson and Hilferty)
    squares = F.expr("aggregate(transform(sequence(1, cast(k as int)), i -> cast(n - length(replace(match, substr(alphabet, i, 1), '')) as double)),"
                     " 0D, (s, c) -> s + c * c)")
    df, chi = F.col("k") - 1, F.col("k") / F.col("n") * squares - F.col("n")
    rows = rows.withColumn("z_chi", (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    # Runs above and below the middle: changes are n - 1 fair coin tosses
    changes = F.expr("aggregate(zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1),"
                     " (a, b) -> if((a < k / 2) <> (b < k / 2), 1D, 0D)), 0D, (s, c) -> s + c)")
    rows = rows.withColumn("z_runs", (changes - (F.col("n") - 1) / 2) / (F.sqrt(F.col("n") - 1) / 2))
    # Serial correlation of neighbours
    rows = rows.withColumn("mean", F.expr("aggregate(x, 0D, (s, c) -> s + c) / n"))
    cross = F.expr("aggregate(zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1), (a, b) -> (a - mean) * (b - mean)), 0D, (s, c) -> s + c)")
    spread = F.expr("aggregate(x, 0D, (s, c) -> s + (c - mean) * (c - mean))")
    z_serial = F.when(spread > 0, (cross / spread + 1 / F.col("n")) * F.sqrt("n")).otherwise(30.0)
    worst = F.least(_normal_tail(F.col("z_chi")), _normal_tail(F.col("z_runs")), _normal_tail(z_serial))
    return rows.select(*tokens.columns, "encoding", F.floor(F.log2("n")).cast("int").alias("band"), F.least(F.lit(1.0), 3 * worst).alias("p"))


def cuts(tested: DataFrame, rate: float) -> DataFrame:
    """For each encoding and band (log2 of a length) the least bin of p, at most SURE, from which the estimated share of
    ordinary tokens is at most ``rate``.

    Tokens under FAILED are out by themselves and not counted.  The estimate is taken at every bin, whether a token is in it or
    not; at SURE it is 0 by construction.  A stratum of under THIN tokens is estimated together with the neighbouring
    bands, where these are as few with its whole encoding, and else with all tokens.  If all tokens are under THIN, ordinary ones
    have to exceed the rate by more than ERRORS standard errors of the estimate."""
    bins = range(SURE + 1)
    distinct = tested.where(F.col("p") >= FAILED).select("encoding", "band", "match", F.floor(F.col("p") * BINS).alias("bin")).distinct()
    counts = distinct.groupBy("encoding", "band").agg(*(F.sum(F.when(F.col("bin") >= b, 1.0).otherwise(0.0)).alias(f"above{b}") for b in bins))
    # At most a few hundred rows, whatever the input
    whole = Window.partitionBy("encoding")
    pools = [whole.orderBy("band").rangeBetween(0, 0), whole.orderBy("band").rangeBetween(-1, 1), whole, Window.partitionBy(F.lit(0))]
    pools = [F.array(*(F.sum(f"above{b}").over(w) for b in bins)) for w in pools]
    pool = F.coalesce(*(F.when(p[0] >= THIN, p) for p in pools), pools[-1])
    # The least of three p-values, times three, is above b in (1 - b / 3) ** 3 of the random tokens
    chance = [(1 - max(b / BINS, FAILED) / 3) ** 3 for b in bins]
    pooled = counts.select("encoding", "band", pool.alias("above"))

    def few(b: int) -> Column:
        above, share = F.col("above")[b], chance[SURE] / chance[b]  # share of the random tokens from b on that are SURE
        error = F.when(F.col("above")[0] < THIN, ERRORS * F.sqrt((1 - share) / share / above)).otherwise(0.0)
        return 1 - F.col("above")[SURE] / share / above <= rate + error

    return pooled.select("encoding", "band", F.coalesce(*(F.when((F.col("above")[b] > 0) & few(b), b) for b in bins[:-1]), F.lit(SURE)).alias("cut"))


def scan(docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans of every text: doc_id, key (text_key), spans (array of struct start, kind, end, sorted by
    start and kind as listed), with one row for each distinct id and text that has spans.

    Null and empty texts have none; positions count code points, the end is exclusive.  Null ids are kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    any_kind = "|".join([p for p, _ in PATTERNS.values() if p[0] != "["] + [CANDIDATE])
    rows = stored(rows.where(F.col("text").rlike(any_kind)).dropDuplicates(["doc_id", "key"]), "with_candidates")
    base = stored(base_spans(rows).drop("match"), "base_spans")
    places = _matches(rows, RANDOM, CANDIDATE)
    # Tokens that touch a base span are known already: a running maximum of ends from the left
    # and a running minimum of starts from the right, over the spans of one text.
    mixed = places.unionByName(base.withColumn("match", F.lit(None).cast("string")))
    at = Window.partitionBy("doc_id", "key").orderBy("start", F.col("match").isNotNull())
    base_end, base_start = (F.when(F.col("match").isNull(), F.col(c)) for c in ("end", "start"))
    left = F.max(base_end).over(at.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    right = F.min(base_start).over(at.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = (mixed.select("*", left.alias("left"), right.alias("right"))
            .where("match is not null and (left is null or left <= start) and (right is null or right >= end)").drop("left", "right"))
    tested = stored(battery(free), "tested_tokens")
    # The cuts are at most a few hundred rows, whatever the input
    added = (tested.join(F.broadcast(cuts(tested, rate)), ["encoding", "band"]).where((F.col("p") * BINS >= F.col("cut")) & (F.col("p") >= FAILED))
             .select("doc_id", "key", "kind", "start", "end"))
    rank = F.array_position(F.array(*[F.lit(k) for k in (*PATTERNS, RANDOM)]), F.col("kind"))
    return (base.unionByName(added)
            .groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans")))


def span_list(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_report(docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row, repeats included: counts by kind, base_sha256 and the span list."""
    found = scan(docs, rate, id_col, text_col).withColumnRenamed("doc_id", "found_id").withColumnRenamed("key", "found_key")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"))
    out = rows.join(found, F.col("key").eqNullSafe(F.col("found_key")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    out = out.select("doc_id", spans.alias("spans"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != RANDOM)
    return out.select("doc_id", *(count(k).alias(f"n_{k}") for k in PATTERNS),
                      F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
