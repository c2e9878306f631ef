"""Registered queries: each operator over the shipped tables, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions import labels, text
from tessella.operators import analytics, audit, flows, manifest, responses, resume, sketches, symbols
from tessella.plans import fixtures as fx
from tessella.session import materialize, prepare, scratch_path
from tessella.sources import artifacts as arts, bucketed, entries as ents
from tessella.sources.catalog import read_catalog
from tessella.sources.listing import partition_text, write_files
from tessella.streaming.ingest import ingest_responses, read_rejected, read_resolved, read_winners, update_winners

SEED = 7
GENERATORS = ["gen_a", "gen_b"]
PRIORITY = ["src7", "src3", "src11"]
TEMPLATES = {
    ("Pure_nC1", "positive"): "Write code for: {pattern}.",
    ("Pure_nC1", "negative"): "Write safe code for: {pattern}.",
    ("Pure_nC2", "positive"): "Write code for: {pattern1} and {pattern2}.",
    ("Pure_nC2", "negative"): "Write safe code for: {pattern1} and {pattern2}.",
    ("Mixed", "positive"): "Write code for: {sensitive_pattern}, beside {nonsensitive_pattern}.",
    ("Mixed", "negative"): "Write safe code for: {sensitive_pattern}, beside {nonsensitive_pattern}.",
}

REGISTRY: dict = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _r(name: str):
    return F.round(name, 6).alias(name)


def _md5(c, name: str):
    return F.md5(text.as_col(c).cast("binary")).alias(name)


def _parsed(spark, sf_dir):
    return analytics.parse_outputs(fx.entries(spark, sf_dir))


def _profile(spark, sf_dir):
    return analytics.profile(_parsed(spark, sf_dir))


def _counts(spark, sf_dir):
    return analytics.identifier_counts(_parsed(spark, sf_dir))


# --- datasets -----------------------------------------------------------------------------------


@query
def entry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = ents.split_lines(ents.parse_lines(fx.lines(spark, sf_dir)))
    return good.select("line_no", "instruction", _md5("input", "input_md5"), _md5("output", "output_md5"))


@query
def entry_line_rejects(spark, sf_dir):
    _, bad = ents.split_lines(ents.parse_lines(fx.lines(spark, sf_dir)))
    return bad.select("line_no", "reject", _md5("line", "line_md5"))


@query
def dataset_selection(spark, sf_dir):
    picked = ents.select_datasets(fx.entries(spark, sf_dir), names=["gen_b", "absent"])
    return picked.select("dataset", "entry_id")


@query
def combined_entries(spark, sf_dir):
    all_rows = fx.entries(spark, sf_dir)
    parts = {g: all_rows.where(F.col("dataset") == g) for g in GENERATORS}
    return ents.combine(parts).select("dataset", "part", "entry_id", _md5("output", "output_md5"))


@query
def parsed_outputs(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "dataset", "entry_id", "valid", "category", "n_items", "reasoning_len", F.array_join("items", "|").alias("items")
    )


@query
def category_counts(spark, sf_dir):
    return _profile(spark, sf_dir).groupBy("dataset", "category").agg(F.sum("n").alias("n"))


@query
def basic_stats(spark, sf_dir):
    return analytics.basic_stats(_profile(spark, sf_dir)).withColumn("success_pct", _r("success_pct"))


@query
def class_split(spark, sf_dir):
    return analytics.class_split(_profile(spark, sf_dir)).select(
        "dataset", "secure", "vulnerable", _r("secure_pct"), _r("vulnerable_pct")
    )


@query
def count_distribution(spark, sf_dir):
    return analytics.count_distribution(_profile(spark, sf_dir)).withColumn("pct", _r("pct"))


@query
def count_stats(spark, sf_dir):
    return analytics.count_stats(_profile(spark, sf_dir)).select(
        "dataset", "min_len", "max_len", _r("mean_len"), _r("median_len")
    )


@query
def reasoning_stats(spark, sf_dir):
    return analytics.reasoning_stats(_profile(spark, sf_dir)).select(
        "dataset", "min_len", "max_len", _r("mean_len"), _r("median_len")
    )


@query
def length_histogram(spark, sf_dir):
    return analytics.length_histogram(_profile(spark, sf_dir)).withColumn("pct", _r("pct"))


@query
def top_identifiers(spark, sf_dir):
    _, counts = analytics.summarize(_parsed(spark, sf_dir))
    return analytics.top_identifiers(counts).withColumn("pct", _r("pct"))


@query
def identifier_frequency(spark, sf_dir):
    return _counts(spark, sf_dir).select("dataset", "identifier", "n", F.col("first_seen.entry_id").alias("first_entry"))


@query
def diversity(spark, sf_dir):
    return analytics.diversity(_counts(spark, sf_dir)).withColumn("avg_frequency", _r("avg_frequency"))


@query
def dataset_comparison(spark, sf_dir):
    return analytics.compare(*analytics.summarize(_parsed(spark, sf_dir)))


@query
def percent_comparison(spark, sf_dir):
    return analytics.compare_pct(_profile(spark, sf_dir)).select(
        "dataset", _r("success_pct"), _r("secure_pct"), _r("vulnerable_pct")
    )


@query
def category_members(spark, sf_dir):
    return analytics.category_members(_parsed(spark, sf_dir))


@query
def dataset_totals(spark, sf_dir):
    return analytics.totals(fx.entries(spark, sf_dir))


@query
def full_report(spark, sf_dir):
    rep = analytics.report(*analytics.summarize(_parsed(spark, sf_dir)))
    joined = F.transform("top_identifiers", lambda t: F.concat_ws(":", t["identifier"], t["n"].cast("string")))
    buckets = F.transform("length_buckets", lambda t: F.concat_ws(":", t["label"], t["n"].cast("string")))
    return rep.select(
        "dataset", "total", "valid", "invalid", "secure", "vulnerable", "unique_ids", "instances",
        F.col("items_max_len").alias("items_max"), F.col("reasoning_max_len").alias("reasoning_max"),
        F.array_join(joined, "|").alias("top"), F.array_join(buckets, "|").alias("buckets"),
    )


@query
def report_file(spark, sf_dir):
    """The report written as one JSON object per dataset and read back."""
    path = scratch_path(prepare(spark), "report")
    parsed = materialize(_parsed(spark, sf_dir), "parsed")
    prof, counts = analytics.summarize(parsed)
    tables = {"category_members": analytics.category_members(parsed), "identifier_frequency": counts}
    ents.write_report(analytics.report(prof, counts), path, tables)
    members = spark.read.schema("dataset string, category string, entry_id bigint").json(f"{path}/category_members")
    per = members.groupBy("dataset").agg(F.count("*").alias("members"))
    rep = spark.read.text(f"{path}/datasets").select(
        F.get_json_object("value", "$.dataset").alias("dataset"),
        F.get_json_object("value", "$.total").cast("bigint").alias("total"),
        F.get_json_object("value", "$.unique_ids").cast("bigint").alias("unique_ids"),
        F.get_json_object("value", "$.top_identifiers[0].identifier").alias("top_identifier"),
    )
    return rep.join(per, "dataset")


def _stored_entries(spark, sf_dir):
    good, _ = ents.split_lines(ents.parse_lines(fx.lines(spark, sf_dir)))
    dataset = F.when(F.col("line_no") % 2 == 0, "gen_a").otherwise("gen_b")
    return good.withColumn("dataset", dataset).withColumn("project", dataset)


@query
def entry_file_round_trip(spark, sf_dir):
    """Entries written as JSONL by dataset, then read and parsed as files."""
    path = scratch_path(prepare(spark), "entries")
    ents.write_entries(_stored_entries(spark, sf_dir), path)
    good, _ = ents.read_entries(spark, path)
    return good.groupBy("dataset", _md5("input", "input_md5"), _md5("output", "output_md5")).agg(
        F.count("*").alias("n")
    )


@query
def stored_dataset_stats(spark, sf_dir):
    """Entries written as JSONL by dataset, then read as files and counted under the names they were read with."""
    path = scratch_path(prepare(spark), "entries")
    ents.write_entries(fx.entries(spark, sf_dir).withColumn("instruction", F.lit("find")), path)
    good, _ = ents.read_entries(spark, path)
    return analytics.basic_stats(analytics.profile(analytics.parse_outputs(good))).withColumn("success_pct", _r("success_pct"))


@query
def project_file_round_trip(spark, sf_dir):
    """Entries written per project and all together, compared by the content of the files."""
    path, all_path = scratch_path(prepare(spark), "by_project"), scratch_path(spark, "all")
    ents.write_project_entries(_stored_entries(spark, sf_dir), path, all_path)
    schema = "instruction string, input string, output string"
    by = spark.read.schema(schema + ", project string").json(path)
    everything = spark.read.schema(schema).json(all_path).withColumn("project", F.lit("all"))
    both = by.unionByName(everything)
    return both.groupBy("project", _md5("input", "input_md5"), _md5("output", "output_md5")).agg(F.count("*").alias("n"))


def _arrivals(spark, sf_dir):
    """Where responses are taken in that arrive in two lots of lines, some of them cut short or with an id that is
    text, each lot once by the same stream."""
    path, target, state = (scratch_path(prepare(spark), n) for n in ("arrived", "resolved", "progress"))
    arrived = fx.responses(spark, sf_dir).drop("variant")
    line = F.to_json(F.struct(*arrived.columns))
    cut = F.expr("left(value, length(value) - 1)")
    text_id = F.regexp_replace("value", r'"request_id":(\d+)', '"request_id":"$1"')
    for lot, broken in ((F.col("attempt") == 1, cut), (F.col("attempt") > 1, text_id)):
        good = arrived.where(lot).select(line.alias("value"), F.col("error_class").isNotNull().alias("twice"))
        good.select(F.explode(F.array_compact(F.array("value", F.when(F.col("twice"), broken)))).alias("value")).write.mode("append").text(path)
        ingest_responses(spark, path, target, state)
    return target


@query
def incremental_labels(spark, sf_dir):
    found = responses.first_success(read_resolved(spark, _arrivals(spark, sf_dir)), max_attempts=3)
    return found.select("request_id", "status", "attempt", "method", _md5("label", "label_md5"))


@query
def incremental_rejects(spark, sf_dir):
    """Arrived lines that are no attempts, with the reason."""
    return read_rejected(spark, _arrivals(spark, sf_dir)).groupBy("reject").agg(F.count("*").alias("n"))


@query
def streamed_winners(spark, sf_dir):
    """Winners kept in the state of a stream while attempts arrive in three lots, out of order; the second lot
    comes twice, and each time some attempts have come before."""
    path, target, winners, state = (scratch_path(prepare(spark), n) for n in ("arrived", "resolved", "winners", "progress"))
    arrived = fx.responses(spark, sf_dir).drop("variant")
    lot = F.pmod(F.col("request_id") + 2 * F.col("attempt"), F.lit(3))
    lines = arrived.select(F.to_json(F.struct(*arrived.columns)).alias("value"), lot.alias("lot"))
    for now in (0, 1, 1, 2):
        lines.where(F.col("lot") == now).select("value").write.mode("append").text(path)
        ingest_responses(spark, path, target, state)
        update_winners(spark, target, winners, state, max_attempts=3)
    return read_winners(spark, winners, target).select("request_id", "status", "attempt", "method", _md5("label", "label_md5"))


# --- manifest -----------------------------------------------------------------------------------


def _catalog(spark, sf_dir):
    return manifest.index_patterns(fx.catalog_rows(spark, sf_dir).withColumn("cat_pos", F.lit(0)))


def _task_columns(df, *more):
    texts = F.transform("patterns", lambda p: p["text"])
    return df.select("filename", "task_type", F.array_join(texts, "|").alias("texts"), *more)


@query
def catalog_file_scan(spark, sf_dir):
    """The catalog written as JSON map files, one per category, and read back as a folder."""
    path = scratch_path(prepare(spark), "catalog")
    ordered = F.array_sort(F.collect_list(F.struct("idx", "text")))
    one = fx.catalog_rows(spark, sf_dir).groupBy("category").agg(ordered.alias("p"))
    line = F.to_json(F.map_from_arrays(F.array("category"), F.array(F.col("p.text"))))
    one.select("category", line.alias("value")).write.partitionBy("category").text(path)
    return read_catalog(spark, f"{path}/*").select("category", "domain", "idx", "pattern_id", "text", "sensitive")


@query
def pattern_index(spark, sf_dir):
    return _catalog(spark, sf_dir).select("category", "domain", "idx", "pattern_id", "text", "sensitive")


@query
def class_sizes(spark, sf_dir):
    sensitive, other = manifest.split_catalog(_catalog(spark, sf_dir))
    both = sensitive.withColumn("class", F.lit("sensitive")).unionByName(other.withColumn("class", F.lit("other")))
    return both.groupBy("class").agg(F.count("*").alias("n"), F.countDistinct("category").alias("categories"))


@query
def single_tasks(spark, sf_dir):
    return _task_columns(manifest.singles(_catalog(spark, sf_dir)))


@query
def pair_tasks(spark, sf_dir):
    return _task_columns(manifest.pairs(_catalog(spark, sf_dir)))


@query
def mixed_tasks(spark, sf_dir):
    return _task_columns(manifest.mixed(_catalog(spark, sf_dir), SEED))


@query
def manifest_tasks(spark, sf_dir):
    """Each task listed twice: the second listing, marked, must win and keep the first place."""
    catalog = manifest.numbered_positions(_catalog(spark, sf_dir))
    once, later = manifest.listed(catalog), 10 << 122
    again = once.withColumn("order", F.col("order") + F.lit(str(later)).cast("decimal(38,0)"))
    twice = manifest.dedupe_listed(once.unionByName(again))
    marked = (F.col("last") - F.lit(str(later)).cast("decimal(38,0)")).cast("decimal(38,0)")
    last = manifest.with_patterns(twice.withColumn("last", marked), catalog, SEED)
    last = last.withColumn("task_type", F.concat("task_type", F.lit("*")))
    return _task_columns(last, F.col("ord.branch").alias("branch"))


@query
def manifest_summary(spark, sf_dir):
    return manifest.catalog_counts(_catalog(spark, sf_dir))


def _samples(spark, sf_dir):
    return manifest.expand_samples(manifest.manifest(_catalog(spark, sf_dir), SEED), GENERATORS)


@query
def sample_expansion(spark, sf_dir):
    return _samples(spark, sf_dir).select("generator", "filename", "polarity", "base_filename")


@query
def generation_prompts(spark, sf_dir):
    return manifest.render_prompts(_samples(spark, sf_dir), TEMPLATES).select("generator", "base_filename", "prompt")


@query
def artifact_layout(spark, sf_dir):
    return manifest.artifact_paths(_samples(spark, sf_dir)).select(
        "generator", "base_filename", "code_path", "label_path", "prompt_path"
    )


# --- requests and responses ---------------------------------------------------------------------


@query
def system_prompts(spark, sf_dir):
    return responses.system_prompts(fx.table(spark, sf_dir, "conversations"))


@query
def user_messages(spark, sf_dir):
    return responses.user_messages(fx.table(spark, sf_dir, "conversations"))


@query
def empty_requests(spark, sf_dir):
    wanted = fx.documents(spark, sf_dir).select(F.col("doc_id").alias("conv_id"))
    return responses.empty_requests(wanted, fx.table(spark, sf_dir, "conversations"))


@query
def label_prompts(spark, sf_dir):
    d = fx.documents(spark, sf_dir)
    prompt = responses.render_label_prompt("text", F.lit("[]"), "Code:\n{code}\nSymbols:\n{symbols}\nAnswer {{}}")
    return d.select("doc_id", _md5(prompt, "prompt_md5"))


@query
def fence_strip(spark, sf_dir):
    """Every text in a fence, and every third fence a second time without anything in it."""
    d = fx.documents(spark, sf_dir).withColumn("is_empty", F.explode(F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    inner = F.when(F.col("is_empty"), "").otherwise(F.col("text"))
    raw = F.concat(F.lit(" ```swift\n"), inner, F.when(F.col("doc_id") % 2 == 0, "\n```\n").otherwise(""))
    return d.select("doc_id", "is_empty", _md5(text.strip_fence(raw), "code_md5"))


def _on_responses(spark, sf_dir, column, name):
    r = fx.responses(spark, sf_dir)
    return r.select("request_id", "attempt", _md5(column("raw_response"), name))


@query
def fenced_json(spark, sf_dir):
    return _on_responses(spark, sf_dir, labels.extract_fenced_json, "block_md5")


@query
def balanced_json(spark, sf_dir):
    return _on_responses(spark, sf_dir, labels.extract_balanced_json, "object_md5")


@query
def label_validation(spark, sf_dir):
    return _on_responses(spark, sf_dir, labels.validate_label, "label_md5")


@query
def json_repair(spark, sf_dir):
    return _on_responses(spark, sf_dir, labels.repair_json, "repaired_md5")


@query
def brace_slice(spark, sf_dir):
    return _on_responses(spark, sf_dir, text.brace_slice, "slice_md5")


@query
def event_json_check(spark, sf_dir):
    """Strict JSON over the event properties, whole and with trailing text."""
    e = fx.table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        labels.is_strict_json("props").alias("strict"),
        labels.is_strict_json(F.concat("props", F.lit(" x"))).alias("strict_with_tail"),
        labels.is_label("props").alias("is_label"),
    )


def _resolved(spark, sf_dir):
    return responses.resolve_attempts(fx.responses(spark, sf_dir))


@query
def label_resolution(spark, sf_dir):
    return _resolved(spark, sf_dir).select("request_id", "attempt", "method", _md5("label", "label_md5"))


@query
def first_success(spark, sf_dir):
    return responses.first_success(_resolved(spark, sf_dir), max_attempts=3).select(
        "request_id", "status", "attempt", "method", _md5("label", "label_md5")
    )


@query
def stored_labels(spark, sf_dir):
    """Winning labels as they are stored, by their size and the parts read back from them."""
    done = responses.render_labels(responses.first_success(_resolved(spark, sf_dir), max_attempts=3))
    v = labels.strict_variant("label")
    return done.where(F.col("status") == "ok").select(
        "request_id",
        F.length("label").cast("bigint").alias("n_chars"),
        _md5(labels.reasoning_text(v), "reasoning_md5"),
        F.size(labels.label_items(v)).cast("bigint").alias("n_items"),
    )


@query
def outcome_counts(spark, sf_dir):
    return responses.outcome_counts(fx.responses(spark, sf_dir))


@query
def retry_waits(spark, sf_dir):
    return responses.retry_wait(fx.responses(spark, sf_dir))


SYMBOLS = '[{"symbolName":"t","symbolKind":"variable"}]'


@query
def training_inputs(spark, sf_dir):
    d = fx.documents(spark, sf_dir)
    symbols = F.when(F.col("doc_id") % 2 == 0, SYMBOLS).otherwise("not json")
    return d.select("doc_id", _md5(responses.render_input("text", symbols), "input_md5"))


@query
def symbol_recovery(spark, sf_dir):
    prompts = fx.artifacts(spark, sf_dir).where(F.col("kind") == "prompt")
    return prompts.select(
        "base_filename",
        responses.recover_symbols("content").alias("symbols"),
        responses.recover_symbols("content", compat=True).alias("compat_symbols"),
    )


@query
def artifact_names(spark, sf_dir):
    url = F.regexp_replace("url", "^http://", "")
    return fx.table(spark, sf_dir, "pages").select(
        "page_id",
        text.safe_name(url).alias("repo"),
        text.module_name(url).alias("module"),
        text.artifact_name(url, F.col("url"), "labels.json").alias("file"),
        text.snippet_name(F.lit("CoreLib"), F.concat(F.lit("Page "), "url")).alias("snippet"),
        text.mime_type(F.concat("url", F.when(F.col("page_id") % 2 == 0, ".JSON").otherwise(".swift"))).alias("mime"),
    )


@query
def entry_rows(spark, sf_dir):
    d = fx.documents(spark, sf_dir)
    rows = responses.to_entry(
        d.select("doc_id", "text", F.lit(SYMBOLS).alias("symbols_json"), F.lit("{}").alias("label")), ["doc_id"], "text"
    )
    return rows.select("doc_id", "instruction", _md5("input", "input_md5"), "output")


# --- resuming -----------------------------------------------------------------------------------


@query
def work_states(spark, sf_dir):
    return resume.work_state(
        fx.samples(spark, sf_dir), fx.artifacts(spark, sf_dir), fx.symbol_texts(spark, sf_dir)
    ).select("generator", "base_filename", "state")


@query
def labelled_flags(spark, sf_dir):
    stored = fx.artifacts(spark, sf_dir).where(F.col("kind") == "label")
    return stored.select("base_filename", resume.is_labelled("content").alias("labelled"))


@query
def pending_samples(spark, sf_dir):
    done = resume.completed(fx.artifacts(spark, sf_dir), fx.symbol_texts(spark, sf_dir))
    return resume.pending(fx.samples(spark, sf_dir), done).select("generator", "base_filename")


@query
def pending_labels(spark, sf_dir):
    done = resume.labelled(fx.artifacts(spark, sf_dir))
    return resume.pending(fx.samples(spark, sf_dir), done).select("generator", "base_filename")


@query
def failure_marks(spark, sf_dir):
    # each document has a second request, none of whose attempts gives a label
    broken = fx.responses(spark, sf_dir).select(
        (-F.col("request_id") - 1).alias("request_id"), "attempt", "variant",
        F.expr("case when variant = 6 then '{' else left(raw_response, 5) end").alias("raw_response"), "error_class",
    )
    attempts = fx.responses(spark, sf_dir).unionByName(broken)
    marked = resume.mark_failed(responses.first_success(responses.resolve_attempts(attempts)))
    return marked.select("request_id", "status", _md5("label", "label_md5"))


def _judged(spark, sf_dir):
    symbols = fx.symbol_texts(spark, sf_dir)
    return resume.judge(_unrecoverable(fx.artifacts(spark, sf_dir)), symbols)


def _unrecoverable(artifacts):
    """Requests of one generator lose their symbol block, so those samples need computed symbols."""
    cut = (F.col("kind") == "prompt") & (F.col("generator") == "gen_b")
    return artifacts.withColumn("content", F.when(cut, "no symbols here").otherwise(F.col("content")))


@query
def assembled_entries(spark, sf_dir):
    entries, _ = resume.assemble(_unrecoverable(fx.artifacts(spark, sf_dir)), fx.symbol_texts(spark, sf_dir))
    return entries.select("project", "base_filename", _md5("input", "input_md5"), _md5("output", "output_md5"))


@query
def assembly_rejects(spark, sf_dir):
    _, rejects = resume.assemble(_unrecoverable(fx.artifacts(spark, sf_dir)), fx.symbol_texts(spark, sf_dir))
    return rejects


@query
def assembly_counts(spark, sf_dir):
    named = arts.projects(fx.artifacts(spark, sf_dir))
    customers = fx.table(spark, sf_dir, "nation").select(F.col("n_name").alias("project"))
    return resume.assembly_counts(_judged(spark, sf_dir), named.unionByName(customers))


# --- artefacts ----------------------------------------------------------------------------------


@query
def artifact_keys(spark, sf_dir):
    stored = fx.artifacts(spark, sf_dir)
    ext = F.lit(None).cast("string")
    for suffix, kind in arts.KINDS.items():
        ext = F.when(F.col("kind") == kind, suffix).otherwise(ext)
    path = F.concat(F.lit("/data/v1.2/"), "generator", F.lit("/"), "base_filename", ext)
    return stored.select(F.inline(F.array(arts.parse_artifact_path(path)))).drop("generator")


def _as_files(rows, path):
    """Every row of (folder, name, content) as one file with a line end behind the content, in folders named as partitions."""
    where = F.concat(F.lit("folder="), partition_text("folder"), F.lit("/name="), partition_text("name"), F.lit("/part-0.txt"))
    line = F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).cast("binary")
    write_files(rows.select(where.alias("path"), line.alias("content")), path)


@query
def artifact_file_scan(spark, sf_dir):
    """All artefacts written as files, found by name pattern in nested folders, with their content."""
    path = scratch_path(prepare(spark), "files")
    name = F.concat_ws(".", "base_filename", "kind")
    _as_files(fx.artifacts(spark, sf_dir).select(F.concat_ws("@", "generator", "project").alias("folder"), name.alias("name"), F.col("content").alias("value")), path)
    found = arts.read_artifacts(spark, path, "part-*.txt")
    return found.select(
        F.regexp_extract("path", "folder=([^/]*)@", 1).alias("generator"),
        F.regexp_extract("path", "folder=[^/]*@([^/]*)/", 1).alias("project"),
        F.regexp_extract("path", "name=([^/]*)[.]", 1).alias("base_filename"),
        F.regexp_extract("path", "name=[^/]*[.]([^/]*)/", 1).alias("stored_kind"),
        "n_bytes",
        _md5("content", "content_md5"),
    )


@query
def stored_work_states(spark, sf_dir):
    """The keys of artefacts laid out at the paths of their samples, found again from these paths alone."""
    stored = fx.artifacts(spark, sf_dir)
    paths = manifest.artifact_paths(stored.drop("content"), "/out")
    by_kind = F.lit(None).cast("string")
    for kind in manifest.ARTIFACT_LAYOUT:
        by_kind = F.when(F.col("kind") == kind, F.col(f"{kind}_path")).otherwise(by_kind)
    laid = paths.select("generator", "base_filename", "kind", by_kind.alias("path"))
    texts = stored.select("generator", "base_filename", "kind", "content")
    files = laid.join(texts, ["generator", "base_filename", "kind"]).select(F.inline(F.array(arts.parse_artifact_path("path"))), "content")
    state = resume.work_state(fx.samples(spark, sf_dir), files, fx.symbol_texts(spark, sf_dir))
    return state.select("generator", "base_filename", "state")


@query
def artifact_snapshot(spark, sf_dir):
    """A snapshot, updated labels put over it, and what a reader then finds."""
    base, path = fx.artifacts(spark, sf_dir), scratch_path(prepare(spark), "snapshot")
    arts.write_snapshot(base, path)
    stored = spark.read.schema(base.schema).parquet(path)
    updates = stored.where((F.col("kind") == "label") & (F.col("generator") == "gen_a")).withColumn(
        "content", F.concat(F.lit("new "), "content")
    )
    merged = scratch_path(spark, "merged")
    arts.write_snapshot(arts.upsert(stored, updates), merged)
    back = spark.read.schema(base.schema).parquet(merged)
    return back.select("generator", "kind", "base_filename", _md5("content", "content_md5"))


@query
def project_order(spark, sf_dir):
    return arts.order_projects(arts.projects(fx.artifacts(spark, sf_dir)), PRIORITY)


@query
def source_discovery(spark, sf_dir):
    _, counts = arts.discover_sources(fx.artifacts(spark, sf_dir))
    return counts


# --- audit --------------------------------------------------------------------------------------


@query
def contradiction_audit(spark, sf_dir):
    return audit.audit_positive(fx.artifacts(spark, sf_dir))


@query
def pruned_snapshot(spark, sf_dir):
    stored = fx.artifacts(spark, sf_dir)
    return audit.prune(stored, audit.flagged(stored)).select("generator", "base_filename", "kind")


@query
def audit_summary(spark, sf_dir):
    return audit.audit_summary(fx.artifacts(spark, sf_dir))


@query
def negative_artifacts(spark, sf_dir):
    return audit.select_negative(fx.artifacts(spark, sf_dir), "gen_a")


@query
def negative_removal(spark, sf_dir):
    stored = fx.artifacts(spark, sf_dir)
    kept = audit.remove(stored, audit.select_negative(stored), dry_run=False)
    return kept.groupBy("generator", "kind").agg(F.count("*").alias("n"))


@query
def removal_counts(spark, sf_dir):
    """Half of the selected keys are not there: those of a generator without artefacts."""
    stored = fx.artifacts(spark, sf_dir)
    chosen = audit.select_negative(stored)
    return audit.removal_counts(stored, chosen.unionByName(chosen.withColumn("generator", F.lit("gen_x"))))


# --- symbols ------------------------------------------------------------------------------------


def _symbols(spark, sf_dir, mode="compat"):
    return symbols.symbols(fx.sources(spark, sf_dir), mode=mode)


def _joined(*names):
    return [F.array_join(n, "|").alias(n) for n in names]


@query
def source_tokens(spark, sf_dir):
    t = symbols.tokens(fx.sources(spark, sf_dir), fields=("pos", "tok", "nl", "depth")).where("pos >= 0")
    return t.groupBy("tok", "depth").agg(
        F.count("*").alias("n"), F.sum("pos").cast("bigint").alias("pos_sum"), F.count_if("nl").alias("line_starts")
    )


@query
def type_declarations(spark, sf_dir):
    rows = symbols.type_symbols(_symbols(spark, sf_dir))
    return rows.select("file_id", "pos", "symbolName", "symbolKind", *_joined("conforms", "attributes"))


@query
def function_declarations(spark, sf_dir):
    rows = symbols.func_symbols(_symbols(spark, sf_dir))
    return rows.select("file_id", "pos", "symbolName", "symbolKind", "typeSignature")


@query
def variable_declarations(spark, sf_dir):
    rows = symbols.var_symbols(_symbols(spark, sf_dir))
    return rows.select("file_id", "pos", "symbolName", "symbolKind", "typeSignature")


@query
def qualified_symbols(spark, sf_dir):
    rows = _symbols(spark, sf_dir, "qualified").where("symbolName is not null")
    return rows.select("file_id", "pos", "symbolName", "symbolKind")


@query
def body_calls(spark, sf_dir):
    rows = symbols.func_symbols(_symbols(spark, sf_dir))
    return rows.select("file_id", "pos", *_joined("calls_out"))


@query
def body_references(spark, sf_dir):
    rows = symbols.func_symbols(_symbols(spark, sf_dir))
    return rows.select("file_id", "pos", *_joined("references"))


@query
def symbol_lists(spark, sf_dir):
    return symbols.symbol_lists(fx.sources(spark, sf_dir)).select("file_id", _md5("symbols_json", "symbols_md5"))


@query
def symbol_failures(spark, sf_dir):
    """All sources, and for each of them a blank one and one that declares nothing."""
    src = fx.sources(spark, sf_dir)
    blank = src.select((-3 * F.col("file_id") - 1).alias("file_id"), F.lit(" \n\t").alias("code"))
    bare = src.select((-3 * F.col("file_id") - 2).alias("file_id"), F.regexp_extract("code", "^[^@]*", 0).alias("code"))
    found = symbols.symbols_or_null(src.unionByName(blank).unionByName(bare))
    return found.select("file_id", "reject", _md5("symbols_json", "symbols_md5"))


@query
def merged_sketch_stats(spark, sf_dir):
    """Statistics from the stored sketches of three lots, merged, and whether they are within their bounds of the
    exact ones."""
    parsed = _parsed(spark, sf_dir)
    lots = [materialize(sketches.lot_sketches(parsed.where(F.pmod("entry_id", F.lit(3)) == k)), "lot-sketches") for k in range(3)]
    found = materialize(sketches.estimates(sketches.merged(lots)), "merged-sketches")
    prof, counts = analytics.summarize(parsed)

    def within(name, condition):
        around = prof.where(condition).groupBy("dataset").agg(F.percentile(name, [0.47, 0.53], F.col("n")).alias(f"{name}_around"))
        return around, F.floor(F.col(f"{name}_around")[0]), F.ceil(F.col(f"{name}_around")[1])

    items, items_low, items_high = within("n_items", F.col("category") == "vulnerable")
    lengths, low, high = within("reasoning_len", F.col("reasoning_len").isNotNull())
    exact = analytics.identifier_totals(counts).withColumnRenamed("instances", "exact_instances").withColumnRenamed("unique_ids", "exact_ids")
    named = found.select("dataset", F.explode("top").alias("t")).select("dataset", "t.*").withColumnRenamed("n", "estimate")
    tops = named.join(counts, ["dataset", "identifier"]).join(exact, "dataset")
    tops = tops.groupBy("dataset").agg(F.min(F.abs(F.col("estimate") - F.col("n")) <= 3 * F.col("exact_instances") / sketches.TRACKED).alias("top_ok"))
    both = found.join(exact, "dataset").join(items, "dataset").join(lengths, "dataset").join(tops, "dataset")
    return both.select(
        "dataset",
        "total",
        "valid",
        "instances",
        (F.abs(F.col("unique_ids") - F.col("exact_ids")) <= 0.08 * F.col("exact_ids")).alias("ids_ok"),
        F.col("median_items").between(items_low, items_high).alias("items_ok"),
        F.col("median_reasoning").between(low, high).alias("lengths_ok"),
        "top_ok",
    )


# --- snapshots in buckets -----------------------------------------------------------------------


def _number_of_buckets(spark, rows):
    """As many as the cluster has cores, and more where one would hold too much for a task."""
    return max(8, spark.sparkContext.defaultParallelism, bucketed.buckets_for(bucketed.text_bytes(rows)))


def _in_buckets(spark, rows, keys, name="snapshot", number=None):
    """Rows in a new bucketed table: (name of the table, its rows)."""
    path = scratch_path(prepare(spark), name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    return table, bucketed.write(rows, table, path, keys, number or _number_of_buckets(spark, rows))


def _with_symbols(spark, sf_dir):
    """The artefacts, and the symbol lists as artefacts of their own kind."""
    lists = fx.symbol_texts(spark, sf_dir).withColumn("kind", F.lit("symbols")).withColumnRenamed("symbols_json", "content")
    return fx.artifacts(spark, sf_dir).unionByName(lists)


@query
def bucketed_work_states(spark, sf_dir):
    """The state of samples from snapshots in buckets: nothing is shuffled after they are written."""
    rows = _with_symbols(spark, sf_dir)
    number = _number_of_buckets(spark, rows)
    _, stored = _in_buckets(spark, rows, bucketed.KEYS, number=number)
    _, wanted = _in_buckets(spark, fx.samples(spark, sf_dir), bucketed.KEYS, "samples", number)
    return resume.work_state(wanted, stored).select("generator", "base_filename", "state")


@query
def bucketed_snapshot(spark, sf_dir):
    """A snapshot in buckets after an update of the labels of one generator."""
    table, stored = _in_buckets(spark, fx.artifacts(spark, sf_dir), bucketed.KEYS)
    new = stored.where((F.col("kind") == "label") & (F.col("generator") == "gen_a"))
    bucketed.update(new.withColumn("content", F.concat(F.lit("new "), "content")), table, ["kind"])
    return bucketed.read(spark, table).select("generator", "kind", "base_filename", _md5("content", "content_md5"))


@query
def bucketed_prune(spark, sf_dir):
    """A snapshot in buckets from which the labels that contradict their sample were taken out."""
    table, stored = _in_buckets(spark, fx.artifacts(spark, sf_dir), bucketed.KEYS)
    bucketed.remove(audit.flagged(stored), table, ["kind"])
    return bucketed.read(spark, table).select("generator", "base_filename", "kind")


@query
def bucketed_assembly(spark, sf_dir):
    """Entries from a snapshot in buckets by project and name: the texts are joined where they lie."""
    _, stored = _in_buckets(spark, _unrecoverable(_with_symbols(spark, sf_dir)), ("project", "base_filename"))
    entries, _ = resume.assemble(stored)
    return _entry_digests(entries)


# --- whole runs ---------------------------------------------------------------------------------


def _project_sources(spark, sf_dir):
    named = fx.sources(spark, sf_dir).withColumn("request_id", F.col("file_id"))
    project = F.concat(F.lit("p_"), (F.col("file_id") % 20).cast("string")).alias("project")
    return named.select(project, F.concat(F.lit("f_"), F.col("file_id").cast("string")).alias("base_filename"), "request_id", "code")


def _entry_digests(entries):
    return entries.select("project", "base_filename", _md5("input", "input_md5"), _md5("output", "output_md5"))


@query
def built_entries(spark, sf_dir):
    """From sources and responses to entries: symbols, requests, winners, artefacts, assembly."""
    _, entries, _ = flows.run(_project_sources(spark, sf_dir), fx.responses(spark, sf_dir).drop("variant"))
    return _entry_digests(entries)


@query
def project_entries(spark, sf_dir):
    """The same over projects of which every third source has a label from an earlier run, which stays."""
    sources = _project_sources(spark, sf_dir)
    known = sources.where("request_id % 3 = 0").select("project", "base_filename", F.lit('{"reasoning":"kept","identifiers":[]}').alias("content"))
    _, entries, _ = flows.run(sources, fx.responses(spark, sf_dir).drop("variant"), known)
    return _entry_digests(entries)
