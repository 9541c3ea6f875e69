"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a weighted set of terms: its lower-case words, each weighing as often as it occurs (a text
without words is one term, itself; an empty text has none). For every term and each of SAMPLES samples,
hashes give two gamma(2, 1) numbers r and c and a uniform number b. A term of weight w has the step
t = floor(ln(w) / r + b) and the key ln(c) - r * (t - b) - r; the sample is the (term, t) of the
smallest key. ln(w) doesn't depend on the sample and is taken once per term. exp(key) is exponential with a mean of 1 by
the weight of the whole text, and at least (1 - e^-c) * e^-r / w, which takes no logarithm: terms for which that is beyond
REACH such means are left out, and so are keys beyond it. Where a sample is left without a key (once in exp(REACH) samples)
its text is sampled again over all terms, so the result doesn't depend on it. Two texts agree in a sample with a chance equal to the generalised Jaccard similarity of
their weights, so the share of equal samples estimates it.

The order of documents that tells each one its next is built from ids alone: ranges of ids, their
neighbours inside each range, and the first of every range. Only the part of a text that its
predecessor asks for travels. Everything that belongs to a document is partitioned once, by document.

Results in special cases: a null text is an empty one; equal texts have equal fingerprints; two empty
texts have likeness 1, an empty and another one 0; null doc_ids come first in the order; rows with equal doc_id
are ordered by the hash of their text, and rows equal in both are one document that is returned as
often as it occurs; the only document of a table is its own next; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import texts, written

# The likeness of a pair has a standard error of sqrt(s * (1 - s) / SAMPLES), 0.0625 at most.
SAMPLES = 64
# Means of the smallest key up to which keys are looked at first, and room for rounding.
REACH, ROUNDING = 24.0, 1e-3
# Steps times this odd number differ in their lower 32 bits.
STEP = 2_654_435_761
# Not a sample of any term.
EMPTY = (1 << 63) - 1


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["doc_id"] == b["doc_id"]) & (a["h"] == b["h"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and h, the key of a document, are never null, so that joins on them keep the
    partitioning by document. missing: the id was null (h tells such rows from those with id 0)."""
    missing = F.col("doc_id").isNull()
    return texts(docs).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text", missing).alias("h"), missing.alias("missing"), "text"
    )


def words(text: Column) -> Column:
    found = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.when(F.size(found) > 0, found).when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))


def _uniform(h: Column, shift: int) -> Column:
    """21 bits of a hash as a number above 0 and below 1."""
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 21) - 1)) + 0.5) / float(1 << 21)


def _products(term: Column, j: Column) -> tuple[Column, Column, Column]:
    """Of the j-th sample of a term: e^-r and e^-c, products of two uniform numbers, and b."""
    one, two = F.xxhash64(term, j), F.xxhash64(term, j + SAMPLES)
    return _uniform(one, 0) * _uniform(one, 21), _uniform(two, 0) * _uniform(two, 21), _uniform(one, 42)


def sample_key(term: Column, ln_w: Column, r: Column, ln_c: Column, b: Column, limit: Column) -> Column:
    """The sample of a term for a weight: its key in the upper bits, so that the least number is the sample, and a mix
    of (term, t) in the lower 32. Null where the logarithm is, of a weight of 0, and for keys beyond the limit."""
    t = F.floor(ln_w / r + b)
    key = ln_c - r * (t - b) - r
    place = F.shiftleft(((key + 512.0) * float(1 << 20)).cast("long"), 32)
    low = term.bitwiseXOR(t * STEP).bitwiseAND(F.lit((1 << 32) - 1))
    return F.when(key < limit, place.bitwiseOR(low))


def successors(keys: DataFrame) -> DataFrame:
    """The keys with next (doc_id, h) in ascending doc_id order; after the last comes the first.

    keys: one row per (doc_id, h). Ranges have about equal numbers of rows whatever the ids are.
    """
    parts = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = (F.col("missing").desc(), F.col("doc_id"), F.col("h"))
    ranged = written(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*order)
    me = F.struct("doc_id", "h")
    near = ranged.select("*", F.lead(me).over(inside).alias("after"), F.row_number().over(inside).alias("place"))
    # One row per range: at most as many as there are partitions.
    firsts = near.where("place = 1").select("range", me.alias("first"))
    over = Window.orderBy("range")
    everything = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(
        "range", F.coalesce(F.lead("first").over(over), F.first("first").over(everything)).alias("follows")
    )
    return near.join(firsts, "range").select(
        "doc_id", "h", "missing", "n_chars", "n", F.coalesce("after", "follows").alias("next")
    )


def _sampled(terms: DataFrame, weights: list[str], reach: float | None = None) -> DataFrame:
    """Per document the least key of each sample, one column per weight and sample. With `reach`, terms also has
    all_{weight}, that of the whole text, and a sample whose keys are all beyond that many means has none."""
    far = F.lit(float("inf"))
    whole_of = lambda w: F.greatest(f"all_{w}", F.lit(1))
    limits = [(F.log(reach / whole_of(w)) - ROUNDING if reach else far).alias(f"limit_{w}") for w in weights]
    most = F.greatest(*[F.col(w) / whole_of(w) for w in weights]) * reach if reach else far
    logs = [F.log(F.col(w).cast("double")).alias(f"ln_{w}") for w in weights]
    each = terms.select("doc_id", "h", "term", *logs, *limits, most.alias("most"))
    each = each.select("*", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))).alias("sample"))
    exp_r, exp_c, b = _products(F.col("term"), F.col("sample"))
    each = each.where((1 - exp_c) * exp_r < F.col("most"))
    each = each.select("*", (-F.log(exp_r)).alias("r"), F.log(-F.log(exp_c)).alias("ln_c"), b.alias("b"))
    key = lambda w: sample_key(*map(F.col, ("term", f"ln_{w}", "r", "ln_c", "b", f"limit_{w}")))
    least = each.groupBy("doc_id", "h", "sample").agg(*[F.min(key(w)).alias(w) for w in weights])
    whole = least.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("sample", *weights))).alias("samples"))
    return whole.select(
        "doc_id", "h", *[F.get("samples", F.lit(j))[w].alias(f"{w}_{j}") for w in weights for j in range(SAMPLES)]
    )


def _samples(prefix: str, frame: DataFrame | None = None) -> list[Column]:
    """The samples of a row as 32-bit numbers; -1 for none."""
    c = (lambda n: frame[n]) if frame is not None else F.col
    return [
        F.when(F.coalesce(c(f"{prefix}_{j}"), F.lit(EMPTY)) == EMPTY, F.lit(-1).cast("long")).otherwise(
            c(f"{prefix}_{j}").bitwiseAND(F.lit((1 << 32) - 1))
        )
        for j in range(SAMPLES)
    ]


def fingerprint_text(samples: list[Column]) -> Column:
    """Samples as hexadecimal text, eight digits each; no sample: eight dashes."""
    return F.concat(*[F.when(s < 0, F.lit("--------")).otherwise(F.lpad(F.lower(F.hex(s)), 8, "0")) for s in samples])


def likeness(one: list[Column], two: list[Column]) -> Column:
    """Share of equal samples, 0 to 1."""
    return reduce(add, [F.when(a == b, 1).otherwise(0) for a, b in zip(one, two, strict=True)]) / float(len(one))


def _told(both: DataFrame, reach: float | None) -> DataFrame:
    """doc_id, h, edited_sha256, the samples of the own and the changed text, and whether one of them is missing.

    both: doc_id, h, text, edited.
    """
    listed = both.select("doc_id", "h", words(F.col("text")).alias("a"), words(F.col("edited")).alias("b"))
    sizes = [F.size("a").alias("all_own"), F.size("b").alias("all_changed")]
    placed = listed.select("doc_id", "h", *sizes, F.posexplode(F.concat("a", "b")).alias("at", "word"))
    terms = placed.groupBy("doc_id", "h", "all_own", "all_changed", F.xxhash64("word").alias("term")).agg(
        F.sum(F.when(F.col("at") < F.col("all_own"), 1).otherwise(0)).alias("own"),
        F.sum(F.when(F.col("at") >= F.col("all_own"), 1).otherwise(0)).alias("changed"),
    )
    sampled = _sampled(terms, ["own", "changed"], reach)
    edits = both.select("doc_id", "h", F.sha2("edited", 256).alias("edited_sha256"), *[(F.col(c) != "").alias(f"in_{c}") for c in ("text", "edited")])
    found = edits.join(sampled, _same(edits, sampled), "left").select(
        edits["doc_id"], edits["h"], "edited_sha256", "in_text", "in_edited",
        F.array(*_samples("own")).alias("own"), F.array(*_samples("changed")).alias("changed"),
    )
    lacks = lambda w: F.array_contains(w, F.lit(-1).cast("long"))
    again = (F.col("in_text") & lacks("own")) | (F.col("in_edited") & lacks("changed"))
    return found.select("doc_id", "h", "edited_sha256", "own", "changed", again.alias("again"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text of a document: its last floor(n_chars / 2) characters replaced by the first as many
    (or all) of the next document.
    """
    rows = _keyed(docs)
    keys = rows.groupBy("doc_id", "h").agg(
        F.max("missing").alias("missing"), F.max(F.length("text")).alias("n_chars"), F.count("*").alias("n")
    )
    order = written(successors(keys))
    once = rows.groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    asked = order.select(
        F.col("next.doc_id").alias("doc_id"), F.col("next.h").alias("h"), F.col("doc_id").alias("to_id"),
        F.col("h").alias("to_h"), F.floor(F.col("n_chars") / 2).cast("int").alias("many"),
    )
    given = once.join(asked, _same(once, asked)).select(
        F.col("to_id").alias("doc_id"), F.col("to_h").alias("h"), F.expr("left(text, many)").alias("piece")
    )
    kept = F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))")
    both = once.join(given, _same(once, given)).select(once["doc_id"], once["h"], "text", F.concat(kept, "piece").alias("edited"))
    told = written(_told(both, REACH))
    again = told.where("again").select("doc_id", "h")
    if not again.isEmpty():
        rest = both.join(again, ["doc_id", "h"], "left_semi")
        told = written(told.where("not again").unionByName(_told(rest, None)))
    nexts = told.select(F.struct("doc_id", "h").alias("k"), F.col("own").alias("follows"))
    found = told.join(order, _same(told, order)).select(
        told["doc_id"], "missing", "edited_sha256", "own", "changed", "n_chars", "n", "next"
    )
    same_next = (found["next.doc_id"] == nexts["k.doc_id"]) & (found["next.h"] == nexts["k.h"])
    at = lambda c: [F.col(c)[j] for j in range(SAMPLES)]
    out = found.join(nexts, same_next).select(
        F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint_text(at("own")).alias("fingerprint"),
        fingerprint_text(at("changed")).alias("edited_fingerprint"),
        likeness(at("own"), at("changed")).alias("near_edited"),
        likeness(at("own"), at("follows")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"),
    )
    return out.drop("copy")
