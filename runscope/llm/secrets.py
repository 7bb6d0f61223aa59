"""Operator 8: secret scan that links the parts of a credential. DataFrame functions only.

Three strong kinds are reported wherever they occur: assigned secrets, access keys and
long hexadecimal strings. Weaker candidates have a role: an *identifier* (client or
account ids), a *secret* (long mixed strings, short passwords under loose names) or an
*endpoint* (addresses of services). Alone they mean little. Every part, weak or strong,
has a scope, ``REACH`` code points to either side; an interval join finds the parts that
lie in each other's scope. A weak secret is reported if an identifier or an endpoint lies
in its scope, a weak identifier or endpoint if a secret does.

The join is an equi-join on document and position bucket with the exact overlap as a
further condition, so a part meets only the parts of neighbouring buckets and a document with
very many parts spreads over many keys.

Defined cases: a null text is an empty one. Repeated rows of the same id and text get the
same result; rows of one id with different texts are kept apart, also for a null id. Weak
candidates that overlap a strong span are parts of it and not reported again. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.spans import SPAN, as_spans, as_text, count_of, in_order, matches, no_spans, row_key, with_free
from runscope.session import written_table

REACH = 200

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# The two below equal "take every run, then drop the short ones".
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
STRONG = {"assign": "secret", "access": "identifier", "hex": "secret"}

WEAK = {
    "identifier": (
        "identifier",
        r"""(?<![A-Za-z0-9])(?i:(?:client|account|access|app|tenant|user|key)[_-]?(?:id|name)|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    ),
    "loose_secret": (
        "secret",
        r"""(?<![A-Za-z0-9])(?i:pass|pwd|passphrase|credential|auth|signature|private_?key|client_?key)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}""",
    ),
    "mixed_string": (
        "secret",
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Z0-9+/_=-]*[a-z])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])[A-Za-z0-9+/_=-]{20,}+",
    ),
    "endpoint": (
        "endpoint",
        r"""(?<![A-Za-z0-9])(?:https?|ftps?|wss?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|amqps?|ldaps?|s3)://[^\s"'<>]+""",
    ),
}
KINDS = [*STRONG, *WEAK]


def _spans(text: Column, kind: str, pattern: str) -> Column:
    return as_spans(matches(text, pattern), kind, KINDS.index(kind))


def strong_spans(text: Column) -> Column:
    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 6)
    access = F.when(F.contains(text, F.lit("AKIA")), _spans(text, "access", ACCESS)).otherwise(no_spans())
    return in_order(as_spans(assigned, "assign", 0), access, _spans(text, "hex", HEX))


def weak_spans(text: Column) -> Column:
    lists = {kind: _spans(text, kind, pattern) for kind, (_, pattern) in WEAK.items()}
    lists["endpoint"] = F.when(F.contains(text, F.lit("://")), lists["endpoint"]).otherwise(no_spans())
    return in_order(*lists.values())


def _role() -> Column:
    roles = STRONG | {kind: role for kind, (role, _) in WEAK.items()}
    pairs = [x for kind, role in roles.items() for x in (F.lit(kind), F.lit(role))]
    return F.create_map(*pairs)[F.col("span.kind")]


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts with a complementary part in their scope.

    ``parts`` has one row per part: doc_id, key, span, weak.
    """
    width = 2 * reach
    parts = parts.withColumn("role", _role()).withColumn("wants_secret", F.col("role") != "secret")

    def in_buckets(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        return rows.withColumn("bucket", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))

    scopes = in_buckets(parts.where("weak"), F.col("span.start") - reach, F.col("span.end") + reach).alias("p")
    others = in_buckets(parts, F.col("span.start"), F.col("span.end")).alias("q")
    meets = (
        F.col("p.doc_id").eqNullSafe(F.col("q.doc_id"))
        & (F.col("p.key") == F.col("q.key"))
        & (F.col("p.bucket") == F.col("q.bucket"))
        & (F.col("p.wants_secret") != F.col("q.wants_secret"))
        & (F.col("q.span.start") <= F.col("p.span.end") + reach)
        & (F.col("p.span.start") - reach <= F.col("q.span.end"))
    )
    return scopes.join(others, meets, "left_semi").select("doc_id", "key", "span").distinct()


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Strong spans and linked weak spans of every document.

    The texts are read once; the spans found are written and serve the join and the result.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    raw = docs.select(
        docs["doc_id"], row_key(text).alias("key"), strong_spans(text).alias("strong"), weak_spans(text).alias("weak")
    )
    found = written_table(raw, "secret-spans")
    parts = (
        with_free(found.where(F.size("weak") > 0), ["doc_id", "key"], "weak", "strong")
        .select(
            "doc_id",
            "key",
            F.explode(
                F.concat(
                    F.transform("strong", lambda s: F.struct(s.alias("span"), F.lit(False).alias("weak"))),
                    F.transform("weak", lambda s: F.struct(s.alias("span"), F.lit(True).alias("weak"))),
                )
            ).alias("part"),
        )
        .select("doc_id", "key", "part.span", "part.weak")
        .distinct()
    )
    weak = (
        linked(parts, reach)
        .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        .agg(F.collect_list("span").cast(f"array<{SPAN}>").alias("linked"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    every = in_order(F.col("strong"), F.coalesce("linked", no_spans()))
    return found.join(weak, same, "left").select(
        "doc_id",
        *[count_of(F.col("strong"), k).alias(f"n_{k}") for k in STRONG],
        F.sha2(as_text(F.col("strong")), 256).alias("base_sha256"),
        as_text(every).alias("spans"),
        F.size(F.coalesce("linked", no_spans())).cast("long").alias("n_linked"),
    )
