"""From a pattern catalog to the manifest of tasks and the samples wanted from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from tessella.functions.text import GENERATOR_ENDING, fill
from tessella.session import materialize

# Category prefix of the second class, task types and polarities.
NON_SENSITIVE = "NonSensitive_"
SINGLE, PAIR, MIXED = "Pure_nC1", "Pure_nC2", "Mixed"
POLARITIES = ("positive", "negative")

PAIR_BLOCK = 512

_TASK = "array<struct<pattern_id:string,category:string,text:string>>"


def index_patterns(catalog: DataFrame) -> DataFrame:
    """Adds ``pattern_id`` (category and position), ``domain`` and the class flag ``sensitive``."""
    return catalog.select(
        "*",
        F.concat_ws("_", "category", F.col("idx").cast("string")).alias("pattern_id"),
        F.substring_index("category", "_", 1).alias("domain"),
        (~F.startswith("category", F.lit(NON_SENSITIVE))).alias("sensitive"),
    )


def split_catalog(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    return catalog.where("sensitive"), catalog.where("not sensitive")


def _pattern(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in ("pattern_id", "category", "text")])


def _tasks(df: DataFrame, kind: str, rank: int, filename: Column, patterns: Column, *order: str) -> DataFrame:
    """``ord`` is the place at which the task is first listed."""
    keys = [F.col(c) for c in order] + [F.lit(0)] * (4 - len(order))
    named = [k.alias(n) for k, n in zip(keys, ("cat_pos", "category", "i", "j"))]
    return df.select(
        filename.alias("filename"),
        F.lit(kind).alias("task_type"),
        patterns.cast(_TASK).alias("patterns"),
        F.struct(F.lit(rank).alias("branch"), *named).alias("ord"),
    )


def singles(catalog: DataFrame) -> DataFrame:
    """One task per sensitive pattern."""
    return _tasks(
        catalog.where("sensitive"), SINGLE, 0, F.col("pattern_id"), F.array(_pattern()), "cat_pos", "category", "idx"
    )


def pairs(catalog: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """One task per pair of patterns of a category, lower position first.

    All pairs are the result asked for, n(n-1)/2 per category, so the work is spread instead: a
    category is cut into blocks of positions, and every pair of blocks is its own join key. No
    key matches more than block x block pairs, however large a category is.
    """
    p = catalog.where("sensitive").select("category", "cat_pos", "idx", "pattern_id", "text")
    p = p.withColumn("own", F.floor((F.col("idx") - 1) / block).cast("int"))
    last = p.groupBy("category").agg(F.max("own").alias("last"))

    def side(name, keys):
        return keys.select(
            *[F.col(c).alias(f"{name}_{c}") for c in ("cat_pos", "idx", "pattern_id", "category", "text")],
            "category",
            "lo",
            "hi",
        )

    left = side(
        "a",
        p.join(last, "category")
        .withColumn("lo", F.col("own"))
        .withColumn("hi", F.explode(F.sequence("own", "last"))),
    )
    right = side(
        "b", p.withColumn("hi", F.col("own")).withColumn("lo", F.explode(F.sequence(F.lit(0), "own")))
    ).drop("b_cat_pos")
    joined = left.join(right, ["category", "lo", "hi"]).where(F.col("a_idx") < F.col("b_idx"))
    return _tasks(
        joined,
        PAIR,
        1,
        F.concat_ws("_", "a_pattern_id", "b_pattern_id"),
        F.array(_pattern("a_"), _pattern("b_")),
        "a_cat_pos",
        "category",
        "a_idx",
        "b_idx",
    )


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Adds ``n`` (0-based, in order of the key's digest), without a global sort.

    Rows are ranked within one of 4096 digest buckets; the only single-task step is the running
    count over those at most 4096 bucket sizes, which is also all that is broadcast.
    """
    digest = df.withColumn("digest", F.md5(F.col(key).cast("binary"))).withColumn("bucket", F.left("digest", F.lit(3)))
    sizes = digest.groupBy("bucket").agg(F.count("*").alias("size"))
    offsets = sizes.select(
        "bucket",
        (F.sum("size").over(Window.orderBy("bucket")) - F.col("size")).alias("before"),
    )
    return (
        digest.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy("digest", key)) - 1)
        .join(F.broadcast(offsets), "bucket")
        .withColumn("n", (F.col("before") + F.col("rank")).cast("bigint"))
        .drop("digest", "bucket", "before", "rank")
    )


def seeded_choice(key: Column, seed: int, total: Column) -> Column:
    """A uniform, reproducible pick from 0 .. total-1 for each key."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))
    return F.pmod(F.conv(F.left(digest, F.lit(12)), 16, 10).cast("bigint"), total)


def mixed(catalog: DataFrame, seed: int) -> DataFrame:
    """One task per sensitive pattern with a pseudo-random non-sensitive one (with replacement);
    none when there are no non-sensitive patterns. The pick depends on pattern and seed only."""
    sensitive, other = split_catalog(catalog)
    numbered = number_rows(other.select("pattern_id", "text"), "pattern_id").select(
        "n", F.col("text").alias("other_text")
    )
    total = other.agg(F.nullif(F.count("*"), F.lit(0)).alias("total")).scalar()
    picked = sensitive.withColumn("n", seeded_choice(F.col("pattern_id"), seed, total))
    second = F.struct(
        F.lit(None).cast("string").alias("pattern_id"),
        F.lit(None).cast("string").alias("category"),
        F.col("other_text").alias("text"),
    )
    return _tasks(
        picked.join(numbered, "n"),
        MIXED,
        2,
        F.concat(F.lit(MIXED + "_"), "pattern_id"),
        F.array(_pattern(), second),
        "cat_pos",
        "category",
        "idx",
    )


def dedupe_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the values of its last row, and in ``order`` the place of its first."""
    rest = [c for c in df.columns if c not in (key, order)]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), order).alias("last"), F.min(order).alias(order))
        .select(key, *[F.col(f"last.{c}").alias(c) for c in rest], order)
    )


# --- the manifest by names and numbers ---------------------------------------------------------

_BRANCHES = (SINGLE, PAIR, MIXED)

#: Bits of the places: there are fewer positions of categories, of patterns in one, and of second patterns.
_CAT_BITS, _POSITION_BITS = 60, 31
_LOW = 1 << (2 * _POSITION_BITS)
_TOP = _LOW << _CAT_BITS


def _whole(c) -> Column:
    return (F.lit(str(c)) if isinstance(c, int) else c).cast("decimal(38,0)")


def order_number(branch: Column, cat_pos: Column, i: Column, j: Column) -> Column:
    """The place at which a task is listed as one number of fixed width, which a hash aggregate can keep the least
    and the largest of: the branch on top, then the category, then both positions."""
    number = lambda c: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    low = F.shiftleft(number(i), _POSITION_BITS) + number(j)
    high = (_whole(number(branch)) * _whole(_TOP)).cast("decimal(38,0)") + (_whole(number(cat_pos)) * _whole(_LOW)).cast("decimal(38,0)")
    return (high.cast("decimal(38,0)") + _whole(low)).cast("decimal(38,0)")


def order_pieces(order: Column) -> tuple[Column, Column, Column]:
    """An ``order_number`` as (branch, category, both positions), bigint each."""
    div = lambda a, b: F.call_function("div", a, _whole(b))
    return div(order, _TOP), div(order % _whole(_TOP), _LOW), (order % _whole(_LOW)).cast("bigint")


def order_parts(branch: Column, cat_pos: Column, low: Column) -> list[Column]:
    """branch, cat_pos, i and j of the pieces of an ``order_number``."""
    j = low.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1).cast("bigint"))
    return [branch.cast("int"), cat_pos, F.shiftright(low, _POSITION_BITS).cast("int"), j.cast("int")]


def numbered_positions(catalog: DataFrame) -> DataFrame:
    """The catalog with numbers in ``cat_pos``, in the order of what stands there (a file and a place in it). It is written
    to the shared folder, as listing and texts ask for it many times, and is small beside its pairs."""
    if not isinstance(catalog.schema["cat_pos"].dataType, IntegralType):
        order = catalog.select("cat_pos").distinct().orderBy("cat_pos").select("cat_pos", F.monotonically_increasing_id().alias("number"))
        order = materialize(order, "category-order")  # the numbers rise from range to range, and stay as they are written
        catalog = catalog.join(order, "cat_pos").withColumn("cat_pos", F.col("number")).drop("number")
    return materialize(catalog, "catalog")


def listed(catalog: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """(filename, order) of every task, without any text of a pattern."""
    p = catalog.where("sensitive").select("category", "cat_pos", "idx", "pattern_id")
    zero, branch = F.lit(0), {kind: F.lit(k) for k, kind in enumerate(_BRANCHES)}
    single = p.select(F.col("pattern_id").alias("filename"), order_number(branch[SINGLE], F.col("cat_pos"), F.col("idx"), zero).alias("order"))
    two = pairs(catalog.select("category", "cat_pos", "idx", "pattern_id", "sensitive", F.lit("").alias("text")), block)
    pair = two.select("filename", order_number(branch[PAIR], F.col("ord.cat_pos"), F.col("ord.i"), F.col("ord.j")).alias("order"))
    other = catalog.where("not sensitive").agg(F.count("*").alias("n")).scalar()
    name = F.concat(F.lit(MIXED + "_"), "pattern_id").alias("filename")
    both = p.where(other > 0).select(name, order_number(branch[MIXED], F.col("cat_pos"), F.col("idx"), zero).alias("order"))
    return single.unionByName(pair).unionByName(both)


def dedupe_listed(tasks: DataFrame) -> DataFrame:
    """(filename, first, last) for rows (filename, order): the places at which each name is listed first and last."""
    return tasks.groupBy("filename").agg(F.min("order").alias("first"), F.max("order").alias("last"))


def _placed(order: str) -> Column:
    """The place of a task as a struct with its category, which its name spells out with its positions."""
    branch, cat_pos, i, j = order_parts(*[F.col(f"{order}_{k}") for k in range(3)])
    digits = lambda c: F.length(c.cast("string"))
    size = F.length("filename")
    of_pair = F.left("filename", ((size - digits(i) - digits(j) - 3) / 2).cast("int"))
    of_mixed = F.substr("filename", F.lit(len(MIXED) + 2), size - digits(i) - len(MIXED) - 2)
    category = F.when(branch == 0, F.left("filename", size - digits(i) - 1)).when(branch == 1, of_pair).otherwise(of_mixed)
    values = (branch, cat_pos, category, i, j)
    return F.struct(*[c.alias(n) for c, n in zip(values, ("branch", "cat_pos", "category", "i", "j"), strict=True)])


def with_patterns(tasks: DataFrame, catalog: DataFrame, seed: int) -> DataFrame:
    """filename, task_type, patterns and ord of tasks (filename, first, last). The texts are joined here, each once for
    every pattern of a task, and for the first time."""
    pieces = [c.alias(f"{order}_{k}") for order in ("last", "first") for k, c in enumerate(order_pieces(F.col(order)))]
    placed = tasks.select("filename", *pieces).select("filename", _placed("last").alias("own"), _placed("first").alias("ord"))
    sensitive, other = split_catalog(catalog)
    total = other.agg(F.nullif(F.count("*"), F.lit(0)).alias("total")).scalar()
    first_id = F.concat_ws("_", "own.category", "own.i")
    # the second pattern of a pair by its id, of a mixed task by its number; of a single one it is not used
    second_id = F.when(F.col("own.branch") == 1, F.concat_ws("_", "own.category", "own.j"))
    second_id = second_id.when(F.col("own.branch") == 2, F.concat(F.lit("#"), seeded_choice(first_id, seed, total).cast("string"))).otherwise(first_id)
    # where a pattern is listed again, its last listing counts
    again = sensitive.groupBy("pattern_id").agg(F.max("cat_pos").alias("cat_pos"))
    texts = sensitive.join(again, ["pattern_id", "cat_pos"], "left_semi")
    by_id = texts.select("pattern_id", "category", "text")
    numbered = number_rows(other.select("pattern_id", "text"), "pattern_id")
    either = by_id.unionByName(numbered.select(F.concat(F.lit("#"), F.col("n").cast("string")).alias("pattern_id"), F.lit(None).cast("string").alias("category"), "text"))
    one = by_id.select(F.col("pattern_id").alias("a"), F.col("text").alias("a_text"))
    two = either.select(F.col("pattern_id").alias("b"), F.col("text").alias("b_text"))
    joined = placed.withColumn("a", first_id).withColumn("b", second_id).join(one, "a").join(two, "b")
    pattern = lambda i, c, t: F.struct(i.alias("pattern_id"), c.alias("category"), t.alias("text"))
    none = F.lit(None).cast("string")
    is_pair = F.col("own.branch") == 1
    first = pattern(F.col("a"), F.col("own.category"), F.col("a_text"))
    second = pattern(F.when(is_pair, F.col("b")).otherwise(none), F.when(is_pair, F.col("own.category")).otherwise(none), F.col("b_text"))
    patterns = F.when(F.col("own.branch") == 0, F.array(first)).otherwise(F.array(first, second))
    return joined.select("filename", task_type("own.branch").alias("task_type"), patterns.cast(_TASK).alias("patterns"), "ord")


def task_type(branch: str) -> Column:
    return F.get(F.array(*[F.lit(kind) for kind in _BRANCHES]), F.col(branch))


def manifest(catalog: DataFrame, seed: int) -> DataFrame:
    """All tasks, one per filename; sort by ``ord`` for the order in which they are listed.

    Names and numbers decide which listing of a name counts, in a hash aggregate; texts are joined to what is left."""
    catalog = numbered_positions(catalog)
    return with_patterns(dedupe_listed(listed(catalog)), catalog, seed)


def manifest_counts(tasks: DataFrame) -> DataFrame:
    """Tasks per type, and in the row without a type all of them."""
    return tasks.rollup("task_type").agg(F.count("*").alias("n"))


def catalog_counts(catalog: DataFrame) -> DataFrame:
    """``manifest_counts`` of a catalog's manifest, from names and numbers alone."""
    last = dedupe_listed(listed(numbered_positions(catalog))).select(order_pieces(F.col("last"))[0].cast("int").alias("branch"))
    return manifest_counts(last.select(task_type("branch").alias("task_type")))


def expand_samples(tasks: DataFrame, generators: list[str]) -> DataFrame:
    """Every task for each generator and polarity: a row-local explode, no join."""
    variants = F.array(
        *[
            F.struct(F.lit(g).alias("generator"), F.lit(p).alias("polarity"))
            for g in generators
            for p in POLARITIES
        ]
    )
    return tasks.select("*", F.inline(variants)).withColumn(
        "base_filename", F.concat_ws("_", "filename", "polarity")
    )


def render_prompts(samples: DataFrame, templates: dict[tuple[str, str], str]) -> DataFrame:
    """Adds ``prompt`` from the template of (task type, polarity).

    Slots by task type: ``{pattern}``; ``{pattern1}`` and ``{pattern2}``; ``{sensitive_pattern}``
    and ``{nonsensitive_pattern}``. ``{{`` and ``}}`` stand for braces.
    """
    first, second = F.col("patterns")[0]["text"], F.get("patterns", 1)["text"]
    slots = {
        "pattern": first,
        "pattern1": first,
        "pattern2": second,
        "sensitive_pattern": first,
        "nonsensitive_pattern": second,
    }
    prompt = F.lit(None).cast("string")
    for (task_type, polarity), template in templates.items():
        match = F.startswith("task_type", F.lit(task_type)) & (F.col("polarity") == polarity)
        prompt = F.when(match, fill(template, slots)).otherwise(prompt)
    return samples.withColumn("prompt", prompt)


# Artefact kind -> (folder, extension).
ARTIFACT_LAYOUT = {"code": ("generated_code", "swift"), "label": ("outputs", "json"), "prompt": ("inputs", "txt")}


def artifact_paths(samples: DataFrame, root: str = "output", layout: dict = ARTIFACT_LAYOUT) -> DataFrame:
    """Adds ``<kind>_path``: root / folder / <generator>_generated / <base filename>.<extension>."""
    out = samples
    for kind, (folder, ext) in layout.items():
        name = F.concat(F.col("base_filename"), F.lit("." + ext))
        where = F.concat(F.col("generator"), F.lit(GENERATOR_ENDING))
        out = out.withColumn(f"{kind}_path", F.concat_ws("/", F.lit(root), F.lit(folder), where, name))
    return out
