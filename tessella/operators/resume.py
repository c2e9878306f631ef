"""What is done, what is pending, and assembling what is done.

Artefacts are long rows (key columns, kind, content). Their texts are judged before the shuffle
(blank, size, strict JSON), so state questions move a few flags per artefact and no text.

Symbol lists are a table of their own, or artefacts of the kind ``symbols`` where none is given. Over tables in buckets
by key (``sources.bucketed``) the latter way needs no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessella.functions.labels import is_strict_json
from tessella.functions.text import as_col, blank, let, strip
from tessella.operators.responses import recover_symbols, to_entry

KEYS = ("generator", "base_filename")

# The label stored for a failed sample, and the size a label must exceed.
FAILURE_SENTINEL = '{"error": "generation_failed"}'
MIN_LABEL_BYTES = 10


def _if_kind(kind: str, value: Column) -> Column:
    return F.when(F.col("kind") == kind, value)


def _any(flag: Column) -> Column:
    return F.coalesce(F.bool_or(flag), F.lit(False))


def artifact_state(artifacts: DataFrame, symbols: DataFrame | None = None, keys=KEYS) -> DataFrame:
    """(keys, has_code, complete) per key, from one shuffle of flags.

    Complete needs code and label that are not blank, a label that is JSON (its keys do not
    matter) and a symbol list.
    """
    flags = artifacts.select(
        *keys,
        _if_kind("code", ~blank("content")).alias("code_ok"),
        _if_kind("label", ~blank("content") & is_strict_json("content")).alias("label_ok"),
        _if_kind("symbols", ~blank("content")).alias("symbols_ok"),
    )
    if symbols is not None:
        none = F.lit(None).cast("boolean")
        found = symbols.select(
            *keys, none.alias("code_ok"), none.alias("label_ok"), ~blank("symbols_json")
        ).toDF(*flags.columns)
        flags = flags.withColumn("symbols_ok", none).unionByName(found)
    return (
        flags.groupBy(*keys)
        .agg(*[_any(F.col(c)).alias(c) for c in ("code_ok", "label_ok", "symbols_ok")])
        .select(
            *keys,
            F.col("code_ok").alias("has_code"),
            (F.col("code_ok") & F.col("label_ok") & F.col("symbols_ok")).alias("complete"),
        )
    )


def work_state(samples: DataFrame, artifacts: DataFrame, symbols: DataFrame | None = None, keys=KEYS) -> DataFrame:
    """Adds ``state``: ``complete``, ``reuse_code`` (only the label is needed) or ``generate``."""
    state = F.when(F.col("complete"), "complete").when(F.col("has_code"), "reuse_code").otherwise("generate")
    return (
        samples.join(artifact_state(artifacts, symbols, keys), list(keys), "left")
        .withColumn("state", state)
        .drop("complete", "has_code")
    )


def is_labelled(label: Column | str) -> Column:
    """Whether a stored label counts as done: large enough, not blank and strict JSON."""
    c = as_col(label)
    return F.coalesce((F.octet_length(c) > MIN_LABEL_BYTES) & ~blank(c) & is_strict_json(strip(c)), F.lit(False))


def completed(artifacts: DataFrame, symbols: DataFrame | None = None, keys=KEYS) -> DataFrame:
    return artifact_state(artifacts, symbols, keys).where("complete").select(*keys)


def labelled(artifacts: DataFrame, keys=KEYS) -> DataFrame:
    return artifacts.where(F.col("kind") == "label").where(is_labelled("content")).select(*keys)


def pending(samples: DataFrame, done: DataFrame, keys=KEYS) -> DataFrame:
    """Wanted samples minus finished ones."""
    return samples.join(done, list(keys), "left_anti")


def mark_failed(results: DataFrame) -> DataFrame:
    """Give failed requests the sentinel label. It counts as labelled from then on and shows up as
    an invalid output in the statistics; ``status`` tells it apart."""
    return results.withColumn("label", F.coalesce("label", F.lit(FAILURE_SENTINEL)))


# Reject reasons in the order in which they are tested.
REJECT_ORDER = (
    "label_too_small",
    "label_blank",
    "label_not_json",
    "artifact_missing",
    "code_blank",
    "no_symbols",
    "bad_json",
)


def judge(artifacts: DataFrame, symbols: DataFrame | None = None, keys=("project", "base_filename")) -> DataFrame:
    """(keys, reject) for every key that has a label.

    All texts, symbols included, are judged where they are read; one shuffle of flags brings the verdicts of a
    key together. Symbols come from the stored request, else from the computed table.
    """
    content = F.col("content")
    none = F.lit(None).cast("boolean")
    stored_symbols = let(recover_symbols(content), lambda s: F.when(s.isNotNull(), is_strict_json(s)))
    flags = artifacts.select(
        *keys,
        _if_kind("label", F.octet_length(content) <= MIN_LABEL_BYTES).alias("label_small"),
        _if_kind("label", blank(content)).alias("label_blank"),
        _if_kind("label", is_strict_json(strip(content))).alias("label_json"),
        _if_kind("label", is_strict_json(content)).alias("label_raw_json"),
        _if_kind("code", blank(content)).alias("code_blank"),
        _if_kind("prompt", F.lit(True)).alias("has_prompt"),
        _if_kind("prompt", stored_symbols).alias("stored_ok"),
        _if_kind("symbols", F.when(content != "", is_strict_json(content))).alias("computed_ok"),
    )
    if symbols is not None:
        text = F.col("symbols_json")
        computed = symbols.where(text != "").select(*keys, *[none.alias(c) for c in flags.columns[len(keys) : -1]], is_strict_json(text).alias("computed_ok"))
        flags = flags.withColumn("computed_ok", none).unionByName(computed)
    together = flags.groupBy(*keys).agg(*[F.max(c).alias(c) for c in flags.columns if c not in keys])
    symbols_ok = F.coalesce("stored_ok", "computed_ok")
    failed = dict(
        zip(
            REJECT_ORDER,
            (
                F.col("label_small"),
                F.col("label_blank"),
                ~F.col("label_json"),
                F.col("code_blank").isNull() | F.col("has_prompt").isNull(),
                F.col("code_blank"),
                symbols_ok.isNull(),
                ~symbols_ok | ~F.col("label_raw_json"),
            ),
        )
    )
    reject = F.coalesce(*[F.when(test, reason) for reason, test in failed.items()])
    return together.where(F.col("label_small").isNotNull()).select(*keys, reject.alias("reject"))


def assemble(artifacts: DataFrame, symbols: DataFrame | None = None, keys=("project", "base_filename")) -> tuple[DataFrame, DataFrame]:
    """(entries, rejects); sort entries by the keys for the order of the stored names.

    Texts are joined for accepted keys only. A key has one artefact of each kind, as ``upsert`` keeps it.
    """
    keys = list(keys)
    judged = judge(artifacts, symbols, keys)

    def texts(kind, name, value=F.col("content")):
        return artifacts.where(F.col("kind") == kind).select(*keys, value.alias(name))

    computed = texts("symbols", "computed") if symbols is None else symbols.select(*keys, F.col("symbols_json").alias("computed"))
    accepted = (
        judged.where(F.col("reject").isNull())
        .join(texts("code", "code"), keys)
        .join(texts("label", "label"), keys)
        .join(texts("prompt", "stored", recover_symbols(F.col("content"))), keys)
        .join(computed, keys, "left")
        .withColumn("symbols_json", F.coalesce("stored", "computed"))
    )
    return to_entry(accepted, keys), judged.where(F.col("reject").isNotNull()).select(*keys, "reject")


def assembly_counts(judged: DataFrame, projects: DataFrame) -> DataFrame:
    """(project, success, errors) with zeros for projects without labels; the row without a
    project is the total."""
    per_project = judged.groupBy("project").agg(
        F.count_if(F.col("reject").isNull()).alias("success"),
        F.count_if(F.col("reject").isNotNull()).alias("errors"),
    )
    return (
        projects.select("project")
        .join(per_project, "project", "left")
        .rollup("project")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("success", "errors")])
    )
