"""Secret scans: strong patterns, and weak parts that count only next to complementary ones.

Strong parts (assignments, access identifiers, long hex runs) are reported as they are. Weak parts
(logins, 40-character keys, endpoints) are reported only if a part of another role stands within
``SCOPE`` code points. That is an interval join: positions are cut into buckets of that width, so the
join is on (row, bucket), and what meets in a bucket is bounded by its width. A part of any length takes
all buckets from its start to its end. DataFrame functions only;
texts are read once and never shuffled.

Defined cases: a null or empty text has no parts; matches are leftmost and don't overlap within a kind;
equal starts are listed in the order of ``KINDS``; repeated rows each get their own result; a weak part
that overlaps a strong one is left out; an empty table gives an empty result.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise, private

# The strong patterns. Of an assignment, group 2 must have 8 characters or more.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Weak patterns.
LOGIN = r"""(?i:access_?key_?id|client_?id|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{4,}"""
KEY = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?:https?|wss?|s3|jdbc:[a-z]{1,20})://[A-Za-z0-9.-]{1,253}(?::[0-9]{1,5})?"

KINDS = ("assign", "access", "hex", "login", "key", "endpoint")
STRONG = KINDS[:3]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "login": "identifier", "key": "secret", "endpoint": "endpoint"}
#: How far apart, in code points, parts of one credential may stand.
SCOPE = 300

_SPANS = "array<struct<start: bigint, end: bigint>>"


def _pattern(kind: str) -> str:
    return {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "login": LOGIN, "key": KEY, "endpoint": ENDPOINT}[kind]


def spans(text: Column, kind: str) -> Column:
    """Spans of all matches. Starts are the lengths of the texts between matches, summed up."""
    pattern = F.lit(_pattern(kind))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else found
    least = 8 if kind == "assign" else 1
    steps = F.zip_with(
        F.arrays_zip(F.split(text, _pattern(kind)).alias("gap"), found.alias("whole")),
        values,
        lambda a, value: F.struct(F.length(a["gap"]).cast("long").alias("gap"), F.length(a["whole"]).cast("long").alias("size"), F.length(value).alias("value")),
    )
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + step["gap"]
        own = F.array(F.struct(begin.alias("start"), (begin + step["size"]).alias("end")))
        keep = F.coalesce(step["value"] >= least, F.lit(False))
        return F.struct((begin + F.coalesce(step["size"], F.lit(0).cast("long"))).alias("at"), F.when(keep, F.concat(state["spans"], own)).otherwise(state["spans"]).alias("spans"))

    return F.when(text.rlike(_pattern(kind)), F.aggregate(steps, start, add, lambda state: state["spans"])).otherwise(none)


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(F.array_sort(found), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def linked(parts: DataFrame) -> DataFrame:
    """Weak parts with a part of another role within ``SCOPE``. parts: rid, start, kind, end."""
    roles = F.array(*[F.lit(ROLES[k]) for k in KINDS])
    rows = parts.withColumn("role", roles[F.col("kind")])
    held = F.sequence(F.floor(F.col("start") / SCOPE), F.floor(F.col("end") / SCOPE))
    weak = rows.filter(F.col("kind") >= len(STRONG)).withColumn("bucket", F.explode(held))
    # Buckets that a weak part within SCOPE of this one has a place in.
    near = F.sequence(F.floor(F.greatest(F.col("start") - SCOPE, F.lit(0)) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE))
    every = rows.select(*[F.col(c).alias(f"o_{c}") for c in rows.columns], F.explode(near).alias("o_bucket"))
    meet = (F.col("rid") == F.col("o_rid")) & (F.col("bucket") == F.col("o_bucket"))
    close = (F.col("role") != F.col("o_role")) & (F.col("o_start") - F.col("end") <= SCOPE) & (F.col("start") - F.col("o_end") <= SCOPE)
    strong = every.filter(F.col("o_kind") < len(STRONG))
    over = (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    part = ["rid", "start", "kind", "end"]
    covered = weak.join(strong, meet & over, "left_semi").select(*part).distinct()
    return weak.join(every, meet & close, "left_semi").select(*part).distinct().join(covered, part, "left_anti")


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of strong parts, a digest of them, and all reported spans."""
    rows = private(docs, doc_id="doc_id", text=F.coalesce(docs["text"], F.lit("")))
    found = rows.select("doc_id", F.monotonically_increasing_id().alias("rid"), *[_tagged(spans(F.col("text"), k), k).alias(k) for k in KINDS])
    found = materialise(found, "secret-parts")
    every = found.select("rid", F.explode(F.concat(*KINDS)).alias("s")).select("rid", "s.start", "s.kind", "s.end")
    weak = linked(every).groupBy("rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    strong = F.concat(*STRONG)
    return found.join(weak, "rid", "left").select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in STRONG],
        F.sha2(_listed(strong), 256).alias("base_sha256"),
        _listed(F.when(F.col("linked").isNull(), strong).otherwise(F.concat(strong, "linked"))).alias("spans"),
        F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"),
    )
