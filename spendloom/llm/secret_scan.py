"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression together with its trigram query: a choice of words of which one must
stand in every match, each word standing for the trigrams it consists of, all of which must then occur
in the text. The index lists, for every trigram that some query needs and every block of BLOCK texts,
the texts that have it, ascending. A query intersects the lists of a word's trigrams and unites those
of its words; what remains is verified with the regular expression over the whole text. A rule without a
mandatory trigram has no query and reads every text.

Trigrams are compared in lower case, so that rules with letters in either case need no other ones; a
query may then admit more texts, never fewer.

Spans are kind:start:end in code points, end exclusive, of the whole match. Results in special cases: a
null text is an empty one and has no spans; equal texts have equal spans; rows with the same doc_id and
text have a row each; a null doc_id stays null; an empty table gives no rows. Very long texts are read
whole. Matches of one rule don't overlap; those of different rules may.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import fresh, texts, with_text, with_text_hash

BLOCK = 1 << 12
# What stands for a secret in a cleaned text.
MASK = "[secret]"


@dataclass(frozen=True)
class Rule:
    """group: what least_length counts (0: the whole match). words: one of them is in every match;
    none: the rule reads every text."""

    kind: str
    regex: str
    words: tuple[str, ...] = ()
    group: int = 0
    least_length: int = 1


# The rules whose results are fixed: patterns and least lengths as given.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), 0, 16),
    Rule("hex", r"[0-9a-f]+", (), 0, 32),
)
# Further kinds of secrets by the public forms of their tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key-----",)),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", ("eyj",)),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}", ("aiza",)),
    Rule("payment_key", r"[sr]k_live_[A-Za-z0-9]{16,}", ("k_live_",)),
    Rule("basic_login", r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@", ("://",)),
)


def trigrams(word: str) -> tuple[str, ...]:
    return tuple(sorted({word[i : i + 3] for i in range(len(word) - 2)}))


def postings(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """trigram, block, ids: the texts of the block that have the trigram. rows: id, block, text.

    A list has at most as many ids as a block has texts; blocks are hashed, so that they are even.
    """
    needed = sorted({t for r in rules for w in r.words for t in trigrams(w)})
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in needed]))
    pairs = rows.select("id", "block", low.alias("low")).select("id", "block", F.explode(found).alias("trigram"))
    return pairs.groupBy("block", "trigram").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id, kinds: the rules whose trigram query the text passes. index: trigram, block, ids."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("of"))
    none = F.array().cast("array<long>")

    def passed(rule: Rule) -> Column:
        words = [
            reduce(F.array_intersect, [F.coalesce(F.col("of")[t], none) for t in trigrams(w)]) for w in rule.words
        ]
        return F.transform(
            reduce(F.array_union, words), lambda i: F.struct(i.alias("id"), F.lit(rule.kind).alias("kind"))
        )

    hits = lists.select(F.explode(F.flatten(F.array(*[passed(r) for r in rules if r.words]))).alias("hit"))
    return hits.groupBy("hit.id").agg(F.collect_set("hit.kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """kind, start, end of a rule's matches, leftmost first, those too short dropped.

    What lies between matches and the matches themselves alternate; their lengths add up to positions.
    """
    pattern = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    steps = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), matches.alias("match"), counted.alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("found"))

    def step(so_far: Column, x: Column) -> Column:
        begin = so_far["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end"))
        long_enough = F.coalesce(F.length(x["part"]) >= rule.least_length, F.lit(False))
        return F.struct(
            end.alias("at"),
            F.when(long_enough, F.concat(so_far["found"], F.array(span))).otherwise(so_far["found"]).alias("found"),
        )

    return F.when(F.size(matches) > 0, F.aggregate(steps, start, step, lambda s: s["found"])).otherwise(start["found"])


def _joined(found: Column, kinds: list[str]) -> Column:
    """Spans as kind:start:end by start, then by the order of kinds, joined with commas."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        found, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.array_join(
        F.transform(
            F.sort_array(keyed),
            lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def _found(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id, kinds of the texts (rows: id, text) that pass the trigram query of a rule."""
    total = rows.select(F.ceil(F.count("*") / BLOCK).alias("n")).first()["n"] or 1
    index = postings(rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(total))), rules)
    return candidates(index, rules)


def _verified(text: Column, kinds: Column, rule: Rule) -> Column:
    """Spans of a rule; a text that doesn't pass its query has none and isn't read."""
    found = spans(text, rule)
    if not rule.words:
        return found
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return F.when(F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)), found).otherwise(none)


def secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    rules = (*BASE_RULES, *more)
    rows = texts(docs).withColumn("id", F.xxhash64("text"))
    both = rows.join(_found(rows.select("id", "text"), rules), "id", "left")
    found = both.select("doc_id", *[_verified(F.col("text"), F.col("kinds"), r).alias(r.kind) for r in rules])
    base = [r.kind for r in BASE_RULES]
    kinds = [r.kind for r in rules]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_joined(F.concat(*base), kinds), 256).alias("base_sha256"),
        _joined(F.concat(*kinds), kinds).alias("spans"),
    )


def _masked(text: Column, found: Column) -> Column:
    """text with every stretch that spans cover, also overlapping ones, replaced by MASK."""
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(so_far: Column, s: Column) -> Column:
        gap = F.substring(text, so_far["at"] + 1, F.greatest(s["start"] - so_far["at"], F.lit(0)))
        piece = F.when(s["start"] >= so_far["at"], F.concat(so_far["done"], gap, F.lit(MASK))).otherwise(so_far["done"])
        return F.struct(piece.alias("done"), F.greatest(so_far["at"], s["end"]).alias("at"))

    ordered = F.sort_array(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    rest = lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(found) > 0, F.aggregate(ordered, begin, step, rest)).otherwise(text)


def without_secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """docs with the secrets in their texts replaced by MASK (n_chars follows); all rows and columns stay."""
    rules = (*BASE_RULES, *more)
    marked, h = with_text_hash(docs)
    found = _found(marked.select(F.col(h).alias("id"), "text"), rules)
    of, kinds, every = (fresh(marked, n) for n in ("_id", "_kinds", "_spans"))
    joined = marked.join(found.select(F.col("id").alias(of), F.col("kinds").alias(kinds)), F.col(h) == F.col(of), "left")
    joined = joined.withColumn(every, F.concat(*[_verified(F.col("text"), F.col(kinds), r) for r in rules]))
    return with_text(joined, _masked(F.col("text"), F.col(every))).select(*docs.columns)
