"""Dataset statistics.

One row-level pass parses every output once (``parse_outputs``). Everything else reads one of two
small aggregates of it: ``profile`` (rows per category, list length and reasoning length) and
``identifier_counts`` (uses per identifier). Both are combined map-side before their shuffle, so a
dataset holding most rows costs no more than its distinct combinations. ``summarize`` makes both in
one pass with one shuffle and stores them, for results that need the two or read one several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tessella.functions import labels
from tessella.functions.text import computed_once, let, strip
from tessella.session import materialize
from tessella.sources.entries import number_entries

# Reasoning length ranges in characters, bounds included.
LENGTH_BUCKETS = (
    (0, 100, "Very Short"),
    (101, 200, "Short"),
    (201, 400, "Medium"),
    (401, 600, "Long"),
    (601, None, "Very Long"),
)

TOP_IDENTIFIERS = 15
TOP_BUCKETS = 1024
PLACES = 1 << 31  # more than there are items in a list


def _pct(part, whole):
    return F.try_divide(part * F.lit(100.0), whole)


def parse_outputs(entries: DataFrame) -> DataFrame:
    """(dataset, entry_id, valid, category, n_items, reasoning_len, items).

    ``items`` keeps the positions of the identifier list; items that are not strings are null.
    Only these narrow columns leave the scan, never the texts.
    """

    def typed(items, v):
        valid = F.coalesce(labels.has_label_keys(v), F.lit(False))
        return F.struct(
            valid.alias("valid"),
            F.when(valid, categorize(items)).alias("category"),
            F.when(valid & items.isNotNull(), F.size(items).cast("bigint")).alias("n_items"),
            F.when(valid, F.length(labels.reasoning_text(v)).cast("bigint")).alias("reasoning_len"),
            F.when(valid, labels.string_items(items)).alias("items"),
        )

    parts = let(
        labels.strict_variant(strip("output")), lambda v: let(labels.label_items(v), lambda items: typed(items, v))
    )
    return entries.select("dataset", "entry_id", computed_once(parts))


def categorize(items):
    """``invalid`` when not a list, ``secure`` when empty, else ``vulnerable``."""
    return F.when(items.isNull(), "invalid").when(F.size(items) == 0, "secure").otherwise("vulnerable")


def profile(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("dataset", "valid", "category", "n_items", "reasoning_len").agg(
        F.count("*").alias("n")
    )


def _numbered(parsed: DataFrame) -> DataFrame:
    """Entries read from files have a struct as id; their narrow rows are numbered first."""
    struct = isinstance(parsed.schema["entry_id"].dataType, StructType)
    return number_entries(parsed, by="dataset") if struct else parsed


def _place(entry, pos):
    """Entry and position as one number of fixed width, which a hash aggregate can keep the least of."""
    return entry.cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + pos.cast("decimal(10,0)")


def _seen(place: str):
    """The entry and position that ``_place`` put together."""
    entry = F.expr(f"{place} div {PLACES}").cast("bigint")
    return F.struct(entry.alias("entry_id"), F.expr(f"{place} % {PLACES}").cast("int").alias("pos"))


def identifier_counts(parsed: DataFrame) -> DataFrame:
    """(dataset, identifier, n, first_seen): uses of each identifier and its first position."""
    return (
        _numbered(parsed)
        .select("dataset", "entry_id", F.posexplode_outer("items").alias("pos", "identifier"))
        .where(F.col("identifier").isNotNull())
        .groupBy("dataset", "identifier")
        .agg(F.count("*").alias("n"), F.min(_place(F.col("entry_id"), F.col("pos"))).alias("place"))
        .select("dataset", "identifier", "n", _seen("place").alias("first_seen"))
    )


def summarize(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile, identifier_counts) of one pass: every entry yields its profile row and one row per
    identifier, and all are counted in one shuffle. The counts, one row for each distinct combination, are written
    to the shared folder, so whatever reads the two tables, however often, parses nothing again."""
    fields = ("valid", "category", "n_items", "reasoning_len")
    parsed = _numbered(parsed)
    types = dict(parsed.dtypes)

    def row(identifier, place, *values):
        named = [v.cast(types[f]).alias(f) for f, v in zip(fields, values)]
        return F.struct(*named, identifier.cast("string").alias("identifier"), place.cast("decimal(32,0)").alias("place"))

    none = F.lit(None)
    uses = F.filter(
        F.transform("items", lambda x, i: row(x, _place(F.col("entry_id"), i), none, none, none, none)),
        lambda r: r["identifier"].isNotNull(),
    )
    own = F.array(row(none, none, *[F.col(f) for f in fields]))
    counted = (
        parsed.select("dataset", F.inline(F.concat(own, F.coalesce(uses, F.slice(own, 1, 0)))))
        .groupBy("dataset", *fields, "identifier")
        .agg(F.count("*").alias("n"), F.min("place").alias("place"))
    )
    counted = materialize(counted, "dataset-counts")
    return (
        counted.where("identifier is null").select("dataset", *fields, "n"),
        counted.where("identifier is not null").select("dataset", "identifier", "n", _seen("place").alias("first_seen")),
    )


def _count(condition):
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")


def basic_stats(prof: DataFrame) -> DataFrame:
    return (
        prof.groupBy("dataset")
        .agg(F.sum("n").alias("total"), _count(F.col("valid")).alias("valid"))
        .select(
            "dataset",
            "total",
            "valid",
            (F.col("total") - F.col("valid")).alias("invalid"),
            _pct(F.col("valid"), F.col("total")).alias("success_pct"),
        )
    )


def class_split(prof: DataFrame) -> DataFrame:
    """Shares are of all valid outputs, so they add up to less than 100 when some are not lists."""
    return (
        prof.groupBy("dataset")
        .agg(
            _count(F.col("valid")).alias("valid"),
            _count(F.col("category") == "secure").alias("secure"),
            _count(F.col("category") == "vulnerable").alias("vulnerable"),
        )
        .select(
            "dataset",
            "secure",
            "vulnerable",
            _pct(F.col("secure"), F.col("valid")).alias("secure_pct"),
            _pct(F.col("vulnerable"), F.col("valid")).alias("vulnerable_pct"),
        )
    )


def _with_share(counted: DataFrame) -> DataFrame:
    """Adds each row's share of its dataset; ``counted`` has one row per distinct length or bucket."""
    return counted.withColumn("pct", _pct(F.col("n"), F.sum("n").over(Window.partitionBy("dataset"))))


def count_distribution(prof: DataFrame) -> DataFrame:
    """Vulnerable samples per identifier-list length, all items counted."""
    return _with_share(
        prof.where(F.col("category") == "vulnerable").groupBy("dataset", "n_items").agg(F.sum("n").alias("n"))
    )


def _length_stats(prof: DataFrame, column: str) -> DataFrame:
    return (
        prof.groupBy("dataset", column)
        .agg(F.sum("n").alias("n"))
        .groupBy("dataset")
        .agg(
            F.min(column).alias("min_len"),
            F.max(column).alias("max_len"),
            F.try_divide(F.sum(F.col(column) * F.col("n")), F.sum("n")).alias("mean_len"),
            F.percentile(column, 0.5, F.col("n")).alias("median_len"),
        )
    )


def count_stats(prof: DataFrame) -> DataFrame:
    """Exact min, max, mean and median of the list length over vulnerable samples."""
    return _length_stats(prof.where(F.col("category") == "vulnerable"), "n_items")


def reasoning_stats(prof: DataFrame) -> DataFrame:
    """The same over the lengths of reasonings that are strings."""
    return _length_stats(prof.where(F.col("reasoning_len").isNotNull()), "reasoning_len")


def length_histogram(prof: DataFrame, buckets=LENGTH_BUCKETS) -> DataFrame:
    """Reasonings per length bucket; empty buckets are left out."""
    number, label = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, (low, high, name) in enumerate(buckets):
        inside = F.col("reasoning_len") >= low
        if high is not None:
            inside &= F.col("reasoning_len") <= high
        number = F.when(inside, i).otherwise(number)
        label = F.when(inside, name).otherwise(label)
    return _with_share(
        prof.where(F.col("reasoning_len").isNotNull())
        .select("dataset", number.alias("bucket"), label.alias("label"), "n")
        .where(F.col("bucket").isNotNull())
        .groupBy("dataset", "bucket", "label")
        .agg(F.sum("n").alias("n"))
    )


def identifier_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dataset").agg(
        F.count("*").alias("unique_ids"), F.sum("n").cast("bigint").alias("instances")
    )


def top_identifiers(counts: DataFrame, k: int = TOP_IDENTIFIERS) -> DataFrame:
    """The k most frequent identifiers per dataset, ties in order of first appearance.

    The vocabulary is cut to the k best of each hash bucket first, whatever k is, so no task receives
    the whole vocabulary of a dataset.
    """
    best = (F.desc("n"), F.col("first_seen"))
    bucket = F.pmod(F.xxhash64("identifier"), F.lit(TOP_BUCKETS))
    first_cut = counts.withColumn("place", F.row_number().over(Window.partitionBy("dataset", bucket).orderBy(*best)))
    return (
        first_cut.where(F.col("place") <= k)
        .drop("place")
        .withColumn("rank", F.row_number().over(Window.partitionBy("dataset").orderBy(*best)))
        .where(F.col("rank") <= k)
        .join(identifier_totals(counts), "dataset")
        .select("dataset", "rank", "identifier", "n", _pct(F.col("n"), F.col("instances")).alias("pct"))
    )


def diversity(counts: DataFrame) -> DataFrame:
    return identifier_totals(counts).select(
        "dataset",
        "unique_ids",
        "instances",
        F.try_divide(F.col("instances"), F.col("unique_ids")).alias("avg_frequency"),
    )


def compare(prof: DataFrame, counts: DataFrame) -> DataFrame:
    return (
        basic_stats(prof)
        .join(class_split(prof), "dataset")
        .join(identifier_totals(counts), "dataset", "left")
        .select(
            "dataset",
            "total",
            "valid",
            "secure",
            "vulnerable",
            F.coalesce("unique_ids", F.lit(0)).cast("bigint").alias("unique_ids"),
        )
    )


def compare_pct(prof: DataFrame) -> DataFrame:
    def guarded(name):
        return F.coalesce(F.col(name), F.lit(0.0)).alias(name)

    return (
        basic_stats(prof)
        .join(class_split(prof), "dataset")
        .select(
            "dataset",
            guarded("success_pct"),
            guarded("secure_pct"),
            guarded("vulnerable_pct"),
        )
    )


def category_members(parsed: DataFrame) -> DataFrame:
    """Which entries fall in which category, as rows."""
    return parsed.where(F.col("valid")).select("dataset", "category", "entry_id")


def totals(entries: DataFrame) -> DataFrame:
    return entries.groupBy("dataset").agg(F.count("*").alias("total"))


def report(prof: DataFrame, counts: DataFrame, k: int = TOP_IDENTIFIERS) -> DataFrame:
    """One row per dataset with all scalar statistics, the k top identifiers and the length buckets,
    from the two tables of ``summarize``.

    Sections without data are null. Lists that grow with the data stay tables of their own:
    ``count_distribution``, ``identifier_counts`` and ``category_members``.
    """

    def ranked(df, order, *columns):
        items = F.array_sort(F.collect_list(F.struct(order, *columns)))
        return df.groupBy("dataset").agg(items.alias("items"))

    def prefixed(df, prefix):
        return df.select("dataset", *[F.col(c).alias(prefix + c) for c in df.columns if c != "dataset"])

    return (
        basic_stats(prof)
        .join(class_split(prof), "dataset", "left")
        .join(prefixed(count_stats(prof), "items_"), "dataset", "left")
        .join(prefixed(reasoning_stats(prof), "reasoning_"), "dataset", "left")
        .join(diversity(counts), "dataset", "left")
        .join(ranked(top_identifiers(counts, k), "rank", "identifier", "n", "pct").withColumnRenamed("items", "top_identifiers"), "dataset", "left")
        .join(ranked(length_histogram(prof), "bucket", "label", "n", "pct").withColumnRenamed("items", "length_buckets"), "dataset", "left")
    )
