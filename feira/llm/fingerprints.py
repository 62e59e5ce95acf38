"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text's terms are its words, weighted by their number. For sample s every term has
gamma-distributed r and c and a uniform b, all drawn by hashing (term, s). With weight w,

    t = floor(ln(w) / r + b),   a = c / exp(r * (t - b + 1)),

and the sample is the (term, t) of the smallest a. Two texts have equal samples with a
probability equal to the generalised Jaccard similarity of their weighted terms, the sum
of the smaller weights over the sum of the larger. A fingerprint is SAMPLES samples of 32
bits in hexadecimal; likeness is the share of equal samples.

The smallest a is found as the minimum of one bigint per sample, ln(a) in fixed point
above and the sample below, so the aggregation stays in whole-stage code.

Texts are shuffled once, by ranges of doc_id with the last text of the range below put
in front, so that a window finds every document's next one, and the words of a text are
counted where the text is.

Defined cases: a null text counts as empty. A text without words has the fingerprint of
the empty text; two such texts are alike (1), one and a text with words are not (0).
Documents are ordered by descending doc_id, then text hash; a null doc_id counts as the
smallest. Rows equal in doc_id and text are one document in this order and get equal
results. A single document is its own next one. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.shared import written

SAMPLES = 32
# A task takes RANGES_PER_TASK ranges on average: so few documents that the counts of
# their words fit its memory.
RANGE_ROWS, MAX_RANGES, RANGES_PER_TASK = 512, 65_536, 2
_LOWEST = -(1 << 63)
_KEY = ["k", "h"]


def _unit(bits: Column, shift: int) -> Column:
    """21 bits of a hash as a number between 0 and 1."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(0x1FFFFF))
    return (part + 0.5) * F.lit(2.0**-21)


def _sample(s: int) -> Column:
    """ln(a) in fixed point above 32 bits of (term, t); the smallest is the sample."""
    x, y = (F.xxhash64("term", F.lit(2 * s + k)) for k in range(2))
    r = -F.ln(_unit(x, 0) * _unit(x, 21))
    c = -F.ln(_unit(y, 0) * _unit(y, 21))
    b = _unit(x, 42)
    t = F.floor(F.col("log_weight") / r + b)
    log_a = F.ln(c) - r * (t - b + 1.0)
    fixed = F.greatest(((log_a + 100.0) * F.lit(2.0**23)).cast("long"), F.lit(0))
    name = (x.bitwiseXOR(y) + t * 0x9E3779B1).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(fixed, 32).bitwiseOR(name)


def _signatures(words: DataFrame, keys: list[str]) -> DataFrame:
    """keys and `signature` of (keys, term), one row per word."""
    weights = words.groupBy(*keys, "term").agg(F.count("*").alias("n"))
    weights = weights.select(*keys, "term", F.ln(F.col("n").cast("double")).alias("log_weight"))
    lows = [F.min(_sample(s)).alias(f"s{s}") for s in range(SAMPLES)]
    found = weights.groupBy(*keys).agg(*lows)
    parts = [F.col(f"s{s}").bitwiseAND(F.lit(0xFFFFFFFF)) for s in range(SAMPLES)]
    return found.select(*keys, F.array(*parts).alias("signature"))


def _terms(text: str) -> Column:
    """Hashes of the words; empty strings at the ends of a split are no words."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("k"),
        F.xxhash64(text).alias("h"),
        F.col("doc_id").alias("id"),
        text.alias("text"),
    )


def _range_of(bounds: list[int]) -> Column:
    """Number of bounds not above k, by binary search."""
    array = F.array(*[F.lit(b) for b in bounds]) if len(bounds) < 100 else F.lit(bounds)
    step, steps = 1 << max(len(bounds).bit_length() - 1, 0), []
    while step:
        steps.append(step)
        step //= 2

    def search(at: Column, step: Column) -> Column:
        low = F.get(array, at + step - 1)  # null beyond the end
        return F.when(low <= F.col("k"), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), search)


def _ranges(keys: DataFrame) -> list[int]:
    """Bounds that split k into ranges of about RANGE_ROWS documents."""
    rows = keys.count()
    wanted = min(MAX_RANGES, rows // RANGE_ROWS)
    if wanted < 1:
        return []
    shares = [(i + 1) / (wanted + 1) for i in range(wanted)]
    accuracy = max(10_000, 10 * wanted)
    found = keys.agg(F.percentile_approx("k", shares, accuracy).alias("b")).first()["b"]
    return sorted(set(found))


def with_next(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """range, k, h, text, next_k, next_h, next_text of every different document.

    keys: k and h of the documents, written, each once.
    """
    bounds = _ranges(keys)
    place = _range_of(bounds) if bounds else F.lit(0)
    # at most MAX_RANGES + 1 rows: the last document of each range, for the range above
    last = keys.groupBy(place.alias("range")).agg(F.max(F.struct("k", "h")).alias("last"))
    order = Window.orderBy("range")
    above = F.coalesce(
        F.lead("range").over(order),
        F.min("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    last = last.select(F.col("last.k").alias("lk"), F.col("last.h").alias("lh"), above.alias("above"))
    rows = _keyed(docs).select("k", "h", "text")
    fronts = rows.join(F.broadcast(last), (F.col("k") == F.col("lk")) & (F.col("h") == F.col("lh")))
    fronts = fronts.select(F.col("above").alias("range"), F.lit(0).alias("own"), "k", "h", "text")
    rows = rows.select(place.alias("range"), F.lit(1).alias("own"), "k", "h", "text")
    tasks = len(bounds) // RANGES_PER_TASK + 1
    both = rows.unionByName(fronts).repartition(tasks, "range")
    order = Window.partitionBy("range").orderBy("own", "k", "h")
    before = {c: F.lag(c).over(order) for c in ("own", "k", "h", "text")}
    both = both.select("*", *[column.alias(f"next_{c}") for c, column in before.items()])
    again = (F.col("next_own") == 1) & (F.col("next_k") == F.col("k")) & (F.col("next_h") == F.col("h"))
    return both.where((F.col("own") == 1) & ~again).drop("own", "next_own")


def _edited() -> Column:
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    return F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half))


def _likeness(a: str, b: str) -> Column:
    """Share of equal samples; a null signature is that of a text without words."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    both = F.col(a).isNull() & F.col(b).isNull()
    return F.when(both, 1.0).otherwise(F.coalesce(same / F.lit(float(SAMPLES)), F.lit(0.0)))


def _printed(signature: str) -> Column:
    empty = F.lit("0" * 8 * SAMPLES)
    digits = F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return F.coalesce(F.array_join(digits, ""), empty)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The edited text has the last half of its characters replaced by the first
    as many of the next document.
    """
    ids = written(_keyed(docs).drop("text"), "fingerprint-ids")
    keys = written(ids.select(*_KEY).distinct(), "fingerprint-keys")
    rows = with_next(docs, keys).withColumn("edited", _edited())
    words = rows.select(
        "range",
        *_KEY,
        F.explode(
            F.concat(
                F.transform(_terms("text"), lambda x: F.struct(F.lit(0).alias("form"), x.alias("term"))),
                F.transform(_terms("edited"), lambda x: F.struct(F.lit(1).alias("form"), x.alias("term"))),
            )
        ).alias("word"),
    )
    words = words.select("range", *_KEY, "word.form", "word.term")
    # the texts' partitioning by range serves these groupings without another shuffle
    found = written(_signatures(words, ["range", *_KEY, "form"]), "signatures")
    facts = rows.select(
        *_KEY,
        "next_k",
        "next_h",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    facts = written(facts, "fingerprint-facts")
    own = found.where("form = 0").select(*_KEY, F.col("signature").alias("own"))
    edited = found.where("form = 1").select(*_KEY, F.col("signature").alias("edited"))
    after = own.toDF("next_k", "next_h", "after")
    joined = facts.join(own, _KEY, "left").join(edited, _KEY, "left")
    joined = joined.join(after, ["next_k", "next_h"], "left")
    return ids.join(joined, _KEY).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        _printed("own").alias("fingerprint"),
        _printed("edited").alias("edited_fingerprint"),
        _likeness("own", "edited").alias("near_edited"),
        _likeness("own", "after").alias("near_next"),
    )
