"""Operator 10: personal data, with bootstrapped contextual extraction. DataFrame functions only.

Four kinds are found by their form: email, ip, card and phone. They are the seeds. The two words
before an entity are its lexical pattern. Other identifier-like tokens (five or more
characters with three or more digits) are candidates and have such a pattern too. Patterns and the values
they introduce form a bipartite graph, whose edges carry the number of occurrences:

* a pattern's score is the occurrence-weighted mean of its values' scores, with one
  imaginary occurrence of score 0 against rare patterns; it counts only with at least
  ``SUPPORT`` different seed values;
* a value's score is 1 for a seed, else ``1 - prod(1 - score)`` over those of its patterns
  that reach ``CONFIDENCE``.

``ROUNDS`` rounds let accepted values support further patterns. A candidate whose value
reaches ``CONFIDENCE`` is reported as ``context``. Tokens that are plainly secrets
(access keys, long hexadecimal strings, values assigned with ``=``) stay in the graph as
counterexamples of score 0 and are never reported.

Only aggregated edges move between rounds; each round's scores are a written table.

Defined cases: a null text is an empty one. Repeated rows of the same id and text get the
same result and count as often as they occur; rows of one id with different texts are kept
apart, also for a null id. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.spans import as_text, count_of, in_order, matches, no_spans, row_key, with_free
from runscope.session import written_table

ROUNDS = 2
SUPPORT = 3
CONFIDENCE = 0.8

# Each starts where a run of its characters starts, or where the match before ended, so that
# no run is searched again from each of its characters.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Only whole chains of digits with 12 to 19 of them.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "context"]

# A token with at least three digits, and its separators inside.
TOKEN = (
    r"(?<![^\s(\[\"',;:])(?=(?:[^\s()\[\]\"',;0-9]*+[0-9]){3})[A-Za-z0-9][^\s()\[\]\"',;]{4,}+"
)
SECRET = r"^AKIA[A-Z0-9]{16,}|^[0-9a-f]{24,}$|="


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Doubling every second digit from the right, digit sums add up to a multiple of ten."""
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(F.filter(doubled, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def _small_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(value, r"\."), small)


_MENTION = "array<struct<start:int,rank:int,kind:string,end:int,value:string,pattern:string,seed:boolean>>"


def _mentions(found: Column, kind: str) -> Column:
    """Matches as mentions of a kind: their span, value and pattern, the last two words before them in lower case."""

    def mention(m: Column) -> Column:
        words = F.regexp_extract(F.lower(m["before"]), r"(\S+\s+)?\S+\s*$", 0)
        return F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
            m["end"].alias("end"), m["value"].alias("value"), F.regexp_replace(words, r"\s+", " ").alias("pattern"),
            F.lit(kind != "context").alias("seed"),
        )

    return F.transform(found, mention).cast(_MENTION)


def base_mentions(text: Column) -> Column:
    """The four base kinds in order."""

    def only(mark: str, kind: str, found: Column) -> Column:
        nothing = F.array().cast(_MENTION)
        return F.when(F.contains(text, F.lit(mark)), _mentions(found, kind)).otherwise(nothing)

    phones = F.filter(matches(text, PHONE), lambda m: F.length(_digits(m["value"])).between(9, 15))
    return in_order(
        only("@", "email", matches(text, EMAIL)),
        only(".", "ip", F.filter(matches(text, IP), lambda m: _small_parts(m["value"]))),
        _mentions(F.filter(matches(text, CARD), lambda m: _luhn(m["value"])), "card"),
        only("+", "phone", phones),
    )


def _candidates(free: Column) -> Column:
    """Tokens without closing punctuation, as mentions."""
    trimmed = F.transform(free, lambda m: m.withField("value", F.rtrim(m["value"], F.lit(".:!?"))))
    ended = F.transform(trimmed, lambda m: m.withField("end", m["start"] + F.length(m["value"])))
    return _mentions(ended, "context")


def accepted_values(
    edges: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """Values that patterns of high confidence introduce.

    ``edges`` has one row per pattern and value: pattern, value, seed, n.
    """
    edges = written_table(edges.withColumn("secret", ~F.col("seed") & F.rlike("value", F.lit(SECRET))), "pii-edges")
    known = edges.select("pattern", "value", "seed", "secret", "n", F.col("seed").cast("double").alias("score"))
    # Without a round nothing is accepted.
    values = edges.where(F.lit(False)).select("value")
    for _ in range(rounds):
        patterns = (
            known.groupBy("pattern")
            .agg(
                (F.sum(F.col("score") * F.col("n")) / (F.sum("n") + 1)).alias("trust"),
                F.sum(F.col("seed").cast("int")).alias("seeds"),
            )
            .where((F.col("seeds") >= support) & (F.col("trust") >= confidence))
            .select("pattern", "trust")
        )
        values = (
            edges.where(~F.col("seed") & ~F.col("secret"))
            .join(patterns, "pattern")
            .groupBy("value")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("found"))
        )
        values = written_table(values.where(F.col("found") >= confidence), "pii-values")
        known = edges.join(values, "value", "left").select(
            "pattern", "value", "seed", "secret", "n",
            F.when(F.col("seed"), 1.0)
            .when(F.col("secret"), 0.0)
            .otherwise(F.coalesce("found", F.lit(0.0)))
            .alias("score"),
        )
    return values.select("value")


def find_personal_data(
    docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """Base spans and discovered identifiers of every document.

    The texts are read once; entities and candidates with their patterns are written and
    serve the graph and the result.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    raw = docs.select(
        docs["doc_id"], row_key(text).alias("key"), base_mentions(text).alias("base"), matches(text, TOKEN).alias("tokens")
    )
    free = with_free(written_table(raw, "pii-tokens"), ["doc_id", "key"], "tokens", "base")
    found = written_table(free.select("doc_id", "key", "base", _candidates(F.col("tokens")).alias("others")), "pii-mentions")
    mentions = found.select("doc_id", "key", F.explode(F.concat("base", "others")).alias("m"))
    edges = mentions.groupBy("m.pattern", "m.value", "m.seed").agg(F.count(F.lit(1)).alias("n"))
    accepted = accepted_values(edges, rounds, support, confidence)
    span = lambda m: F.struct(*[m[c].alias(c) for c in ("start", "rank", "kind", "end")])
    extra = (
        mentions.where(~F.col("m.seed"))
        .join(accepted.withColumnRenamed("value", "_value"), F.col("m.value") == F.col("_value"), "left_semi")
        .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        .agg(F.collect_set(span(F.col("m"))).alias("extra"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    more = F.coalesce("extra", no_spans())
    joined = found.withColumn("base", F.transform("base", span)).join(extra, same, "left")
    return joined.select(
        "doc_id",
        *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(in_order(F.col("base"), more)).alias("spans"),
        F.size(more).cast("long").alias("n_context"),
    )
