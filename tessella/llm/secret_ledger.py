"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a path is stored by its content: a blob is the digest of a text. The ledger keeps, for each blob and
rule version, the spans found (one row per pair that has been scanned, with no spans if it is clean). A scan looks up
which pairs of blob and rule version the ledger lacks, scans one copy of those blobs, appends the results, and joins the
findings back to all paths and versions that hold the blob.

Spans are found with the text cut at the matches of a rule: the lengths of what lies between and of the matches, summed
up, are their places. Matches are the leftmost ones that do not overlap; those that are too short are dropped afterwards.

Defined cases: a null text counts as empty and is clean; an empty table gives no rows; repeated rows, null ids and equal
versions each get the blob's findings; text positions are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.tables import whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose text, or whose ``tail`` (matches of a pattern at its end), is
    shorter than ``least`` code points are dropped. A change of a rule needs a new ``version``."""

    kind: str
    pattern: str
    least: int
    tail: str | None = None
    version: str = "1"

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


_ASSIGNED = "[A-Za-z0-9+/_.=-]+"

# The base rules. A run of hex digits or of a key's letters that is too short holds no longer match,
# so their least lengths stand in the pattern; an assignment's cannot.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""" + _ASSIGNED, 6, _ASSIGNED),
    Rule("access", "AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)

SPAN = "struct<kind:string,from:long,to:long>"
LEDGER = f"blob string, rule string, spans array<{SPAN}>"


def blob_id(text: Column | str = "text") -> Column:
    return F.sha2(whole_text(text).cast("binary"), 256)


def spans(text: Column, rule: Rule) -> Column:
    """The spans of a rule in a text, in order: array of (kind, from, to), ``to`` being exclusive."""
    length = lambda x: F.length(x).cast("long")
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    # from: all that lies between up to the match, and all matches before it
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("all"))

    def add(state: Column, pair: Column) -> Column:
        begin = state["at"] + length(pair["between"])
        end = begin + length(pair["found"])
        span = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("from"), end.alias("to"))
        kept = length(pair["found"]) >= rule.least
        if rule.tail:
            kept = length(F.regexp_extract(pair["found"], f"[:=]\\x20*[\"']?({rule.tail})$", 1)) >= rule.least
        return F.struct(end.alias("at"), F.when(kept, F.concat(state["all"], F.array(span))).otherwise(state["all"]).alias("all"))

    pairs = F.arrays_zip(between.alias("between"), found.alias("found"))
    pairs = F.slice(pairs, F.lit(1), F.greatest(F.size(found), F.lit(0)))
    return F.aggregate(pairs, start, add, lambda s: s["all"])


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, spans) for rows (blob, text, wanted), ``wanted`` being the keys of the rules to apply."""
    asked = [
        F.when(
            F.array_contains("wanted", rule.key),
            F.struct(F.lit(rule.key).alias("rule"), F.when(F.col("text").rlike(rule.pattern), spans(F.col("text"), rule)).otherwise(F.array().cast(f"array<{SPAN}>")).alias("spans")),
        )
        for rule in rules
    ]
    each = blobs.select("blob", F.explode(F.array(*asked)).alias("one")).filter("one IS NOT NULL")
    return each.select("blob", "one.rule", "one.spans")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, or an empty one where none has been written yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def update(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks of rows (key, blob, text) and append it. ``key`` tells rows of a blob apart."""
    spark = versions.sparkSession
    done = read_ledger(spark, ledger).filter(F.col("rule").isin([r.key for r in rules])).select("blob", "rule").distinct()
    have = done.groupBy("blob").agg(F.collect_set("rule").alias("have"))  # as many as there are rules at most
    every = F.array(*[F.lit(r.key) for r in rules])
    one = versions.groupBy("blob").agg(F.min("key").alias("key"))
    unseen = one.join(have, "blob", "left").select(
        F.col("blob").alias("of"), F.col("key").alias("at"), F.array_except(every, F.coalesce("have", F.array().cast("array<string>"))).alias("wanted")
    )
    unseen = unseen.filter(F.size("wanted") > 0)
    # the text of one copy only, fetched by its key: a blob of many copies is no hot key here
    texts = versions.join(unseen, versions["key"].eqNullSafe(unseen["at"]) & (F.col("blob") == F.col("of")))
    scan(texts.select("blob", "text", "wanted"), rules).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): the spans of all rules, sorted by start and the order of the rules; blobs without any are
    left out."""
    order = F.array(*[F.lit(r.kind) for r in rules])
    found = read_ledger(spark, ledger).filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    # a lost race or a retried run may have added a pair twice
    each = found.select("blob", F.explode("spans").alias("span")).distinct()
    ranked = each.select("blob", F.struct(F.col("span.from").alias("from"), F.array_position(order, F.col("span.kind")).alias("rank"), F.col("span.to").alias("to"), F.col("span.kind").alias("kind")).alias("s"))
    grouped = ranked.groupBy("blob").agg(F.sort_array(F.collect_list("s")).alias("s"))  # the findings of one text
    return grouped.select("blob", F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["from"].alias("from"), x["to"].alias("to"))).alias("spans"))


def scan_versions(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob and spans of every row."""
    text = whole_text(docs[text_col])
    rows = docs.select(docs[id_col].alias("key"), blob_id(docs[text_col]).alias("blob"), text.alias("text"))
    update(rows, ledger, rules)
    found = findings(docs.sparkSession, ledger, rules)
    empty = F.array().cast(f"array<{SPAN}>")
    joined = rows.select(F.col("key").alias("doc_id"), "blob").join(found, "blob", "left")
    return joined.select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with each span, or each group of spans that overlap, put as ``mask``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(state: Column, span: Column) -> Column:
        before = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(span["from"] - state["at"], F.lit(0)).cast("int"))
        inside = span["from"] < state["at"]
        return F.struct(
            F.greatest(state["at"], span["to"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], before, F.lit(mask))).alias("out"),
        )

    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(spans, start, add, rest)
