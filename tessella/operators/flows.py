"""Whole runs put together from the single steps: from sources and model responses to training entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessella.operators import responses, resume, symbols
from tessella.session import materialize

KEYS = ("project", "base_filename")


def source_symbols(sources: DataFrame) -> DataFrame:
    """(project, base_filename, symbols_json) of sources (project, base_filename, code); null for blank ones."""
    keyed = sources.select(F.struct(*KEYS).alias("file"), "code")
    return symbols.symbol_lists(keyed, "file", "code").select("file.*", "symbols_json")


def requests(sources: DataFrame, lists: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(project, base_filename, content): the request for the label of each source that has symbols and is not among
    the labelled ones of ``known`` (project, base_filename, content)."""
    wanted = sources if known is None else sources.join(known.select(*KEYS), list(KEYS), "left_anti")
    rows = wanted.join(lists.where("symbols_json is not null"), list(KEYS))
    return rows.select(*KEYS, responses.render_label_prompt("code", "symbols_json").alias("content"))


def run(sources: DataFrame, attempts: DataFrame, known: DataFrame | None = None, max_attempts: int = responses.MAX_ATTEMPTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(artefacts, entries, rejects) of a run over sources (project, base_filename, request_id, code).

    Symbols of the sources go into the requests; attempts (request_id, attempt, raw_response, error_class) give labels
    or marks of failure; what has a label from an earlier run (``known``) keeps it and is not asked for again. The
    artefacts are then assembled to entries, whose symbols are read back from the requests that were sent; sources that were
    not asked for have no request, and get one from the symbols as they are now."""
    lists = materialize(source_symbols(sources), "source-symbols")
    asked = requests(sources, lists, known)
    older = requests(sources, lists) if known is not None else asked
    found = resume.mark_failed(responses.first_success(responses.resolve_attempts(attempts), max_attempts))
    new = sources.select(*KEYS, "request_id").join(asked.select(*KEYS), list(KEYS)).join(found, "request_id")
    labels = new.select(*KEYS, F.col("label").alias("content"))
    if known is not None:
        labels = labels.unionByName(known.select(*KEYS, "content"))

    def of(kind: str, rows: DataFrame) -> DataFrame:
        return rows.select(*KEYS, F.lit(kind).alias("kind"), "content")

    artifacts = of("code", sources.withColumnRenamed("code", "content")).unionByName(of("prompt", older)).unionByName(of("label", labels))
    entries, rejects = resume.assemble(artifacts, lists, KEYS)
    return artifacts, entries, rejects
