"""Secret scans: credential spans, and weak candidates linked to complementary parts.

Three kinds of span stand on their own: ``assign`` (a secret's name, a separator and a value
of 6 or more characters), ``access`` (an access identifier) and ``hex`` (24 or more hex
digits).  Three more are weak and reported only beside a complementary part within SCOPE code
points: ``login`` (a mail address or ``user=`` value) and ``endpoint`` (a URL or ``host=`` value)
beside a secret (assign, hex or opaque), and ``opaque`` (32 or more mixed letters and digits)
beside an identifier (access, login) or endpoint.  Links are found by an interval join: parts
are cut into cells of SCOPE code points, each cell keeps the first start and last end of each
role, and a candidate is joined with all cells that lie within SCOPE of it; nothing is paired.

Spans are leftmost and non-overlapping per kind, in code points, end exclusive.  They are read
off natively: a separator that cannot occur is put around each match and the lengths of the
pieces are added up.  Everything is DataFrame functions.

Defined results: null or empty texts have no spans; spans depend on the text alone, so repeated
rows and null ids get their own equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import new_name, small_side, stored, table

SCOPE = 200
MAX_BROADCAST = 100_000       # texts with spans; more are joined by shuffle
MARK, STAND_IN = "", ""     # texts' own marks become the stand-in; no pattern knows either

#: fixed values: the patterns of the contract, letters in either case spelled out by (?i)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 6), "access": ("AKIA[A-Z0-9]+", 20), "hex": ("[0-9a-f]{24,}", 24)}
WEAK = {
    "login": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}|(?i)(?:user(?:name)?|login|client_id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._-]+",
    "endpoint": r"https?://[^\x20\x09-\x0D\"'<>]+|(?i)(?:host|server|endpoint)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._:/-]+",
    "opaque": r"[A-Za-z0-9+/=_-]{32,}",              # and a digit and a letter in it
}
KINDS = [*BASE, *WEAK]                  # the order of kinds at equal starts
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret",
        "access": "identifier", "login": "identifier", "endpoint": "endpoint"}
NEEDS = {"login": ("secret",), "endpoint": ("secret",), "opaque": ("identifier", "endpoint")}


def match_spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end>> of the leftmost non-overlapping matches, without a Python pass."""
    pieces = F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK)
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, piece):
        end = acc["at"] + F.length(piece)
        span = F.struct(acc["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"),
                        F.when(acc["inside"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])


def long_enough(text: Column, spans: Column, kind: str) -> Column:
    """Drops matches that fail what the kind asks for beside its pattern: a length (of the value, or the whole match), or
    a digit and a letter."""
    if kind == "opaque":
        def piece(s):
            return F.substr(text, s["start"] + 1, s["end"] - s["start"])
        return F.filter(spans, lambda s: piece(s).rlike("[0-9]") & piece(s).rlike("[A-Za-z]"))
    pattern, least = BASE[kind]
    if kind == "hex":
        return spans                    # a run of 24 or more is what the pattern itself asks for
    if kind == "access":
        return F.filter(spans, lambda s: s["end"] - s["start"] >= least)
    return F.filter(spans, lambda s: F.length(F.regexp_extract(
        F.substr(text, s["start"] + 1, s["end"] - s["start"]), pattern, 2)) >= least)


def part_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, <kind>...): span arrays of every row; rows without a match skip the cutting."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    t = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(STAND_IN))
    rows = docs.select(F.col(id_col).alias("id"), t.alias("text"), F.col(text_col).alias("source_text"))
    text = F.col("text")
    # plain substrings that a match must contain: most texts are told apart without a pattern
    pair = text.contains("=") | text.contains(":")
    some_id = text.contains("AKIA") | text.contains("@") | pair
    must = {"assign": pair, "access": text.contains("AKIA"), "hex": F.lit(True), "login": text.contains("@") | pair,
            "endpoint": text.contains("://") | pair, "opaque": some_id & text.rlike("[0-9]")}
    cols = []
    for kind in KINDS:
        pattern = BASE[kind][0] if kind in BASE else WEAK[kind]
        spans = match_spans(text, pattern)
        if kind in BASE or kind == "opaque":
            spans = long_enough(text, spans, kind)
        cols.append(F.when(must[kind] & text.rlike(pattern), spans).otherwise(none).alias(kind))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", F.md5("source_text").alias("text_key"), *cols)


def labelled(kind: str) -> Column:
    """The spans of a kind's column, each with its kind."""
    return F.transform(F.col(kind), lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def overlaps_none(spans: Column, others: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def linked_weak(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, weak): weak spans with a complementary part at most ``scope`` code points away."""
    some_weak = parts.filter(" or ".join(f"size({k}) > 0" for k in WEAK))
    spans = F.concat(*map(labelled, KINDS))
    part = (some_weak.select("row", F.explode(spans).alias("s")).select("row", "s.*")
            .withColumn("role", F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])[F.col("kind")]))
    # a part lies in every cell it touches
    cells = part.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))))
    # what each cell holds of each role, its own kind apart from the others of the role
    held = cells.groupBy("row", "cell", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"),
                                                    F.max("end").alias("until"))
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    want = (part.filter(F.col("kind").isin(*WEAK))
            .withColumn("role", F.explode(needs[F.col("kind")]))
            .withColumn("cell", F.explode(F.sequence(F.floor((F.col("start") - scope - 1) / scope),
                                                     F.floor((F.col("end") + scope) / scope)))))
    near = want.join(held, ["row", "cell", "role"]).filter(
        # after the candidate: the cell's first start; before it: its last end; else one inside
        ((F.col("first") <= F.col("end") + scope) & (F.col("until") >= F.col("start") - scope)))
    return near.groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("weak"))


def scan(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", scope=SCOPE) -> DataFrame:
    """(id, text_key, spans): array<struct<kind,start,end>> by start, then kind as listed, one row per input row."""
    raw = part_spans(docs, id_col, text_col)
    taken = F.concat("assign", "hex", "access")
    clear = raw.withColumn("opaque", overlaps_none(F.col("opaque"), taken))
    parts = stored(spark, clear, "parts")
    weak = linked_weak(parts, scope)
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    base = F.concat(*map(labelled, BASE))
    every = F.concat(base, F.coalesce("weak", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    ordered = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"]))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return parts.join(weak, "row", "left").select("id", "text_key", ordered.alias("spans"))


def redact(spark: SparkSession, docs: DataFrame, id_col="doc_id", text_col="text", with_what="[secret]",
           length_col="n_chars", **options) -> DataFrame:
    """``docs`` with every span replaced, all other columns as they are; ``length_col``, where there
    is one, follows the new text.  Texts without a span are not touched."""
    found = scan(spark, docs, id_col, text_col, **options)
    # equal texts have equal spans: one row for each text that has any
    spans = stored(spark, found.filter(F.size("spans") > 0).groupBy("text_key").agg(F.first("spans").alias("found_spans")), "found")
    key, found_name = new_name(docs, "text_key"), new_name(docs, "found_spans")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        upto = F.substr(F.col(text_col), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        piece = F.when(s["start"] >= acc["at"], F.concat(upto, F.lit(with_what))).otherwise("")
        return F.struct(F.concat(acc["out"], piece).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    text = F.aggregate(found_name, start, step,
                       lambda acc: F.concat(acc["out"], F.substr(F.col(text_col), acc["at"] + 1, F.length(text_col))))
    names = spans.select(F.col("text_key").alias(key), F.col("found_spans").alias(found_name))
    joined_docs = docs.join(small_side(names, MAX_BROADCAST), F.md5(text_col) == F.col(key), "left")
    out = {text_col: F.when(F.col(found_name).isNull(), F.col(text_col)).otherwise(text)}
    if length_col in docs.columns:
        out[length_col] = F.when(F.col(found_name).isNull(), F.col(length_col)).otherwise(
            F.length(text).cast(docs.schema[length_col].dataType))
    return joined_docs.select(*[out.get(c, F.col(c)).alias(c) for c in docs.columns])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark, table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
