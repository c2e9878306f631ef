"""Tables of requests and responses: rendering requests, resolving attempts to labels, rendering
training entries. No model is called here; requests are emitted as rows and responses read as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessella.functions import labels
from tessella.functions.text import as_col, blank, computed_once, fill, non_empty, strip
from tessella.session import materialize

MAX_ATTEMPTS = 3

# Instruction of every dataset entry, headings and frame of its input.
INSTRUCTION = (
    "In the following Swift code, find all identifiers related to sensitive logic. "
    "Provide the names and reasoning as a JSON object."
)
CODE_HEADING = "**Swift Source Code:**"
SYMBOLS_HEADING = "**AST Symbol Information (JSON):**"
INPUT_FRAME = f"{CODE_HEADING}\n```swift\n{{code}}\n```\n\n{SYMBOLS_HEADING}\n```\n{{symbols}}\n```"

# The request text is content, not behaviour: pass your own with the slots {code} and {symbols}.
LABEL_TEMPLATE = (
    "Name the sensitive identifiers of this code.\n\n"
    f"{CODE_HEADING}\n```swift\n{{code}}\n```\n\n{SYMBOLS_HEADING}\n```json\n{{symbols}}\n```\n\n"
    'Answer with one JSON object with the keys "reasoning" and "identifiers" only.'
)

# Error class of an attempt -> outcome.
OUTCOMES = {
    "blocked": "blocked_no_candidates",
    "no_content": "no_content",
    "quota": "quota",
    "timeout": "timeout",
}

# Seconds to wait.
QUOTA_WAIT = 300
BASE_WAIT = 5


def system_prompts(conversations: DataFrame) -> DataFrame:
    """(conv_id, system_prompt): the system texts of a conversation joined by newlines in turn
    order, null where it has none. Only system rows are gathered, into the one value they form."""
    system = F.when(F.col("role") == "system", F.struct("turn", "text"))
    return (
        conversations.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(system)).alias("parts"))
        .select(
            "conv_id",
            F.when(F.size("parts") > 0, F.array_join(F.col("parts.text"), "\n")).alias("system_prompt"),
        )
    )


def user_messages(conversations: DataFrame) -> DataFrame:
    """All other messages, one row each, in ``turn`` order; no conversation is gathered."""
    return conversations.where(F.col("role") != "system").select("conv_id", "turn", "role", "text")


def split_messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(system_prompts, user_messages)."""
    return system_prompts(conversations), user_messages(conversations)


def empty_requests(requests: DataFrame, conversations: DataFrame) -> DataFrame:
    """Requests without any message, which are errors."""
    return requests.join(conversations, "conv_id", "left_anti")


def render_label_prompt(code: Column | str, symbols: Column | str, template: str = LABEL_TEMPLATE) -> Column:
    return fill(template, {"code": as_col(code), "symbols": as_col(symbols)})


def render_input(code: Column | str, symbols: Column | str) -> Column:
    """Source and symbols of a training entry; symbols are laid out with two spaces, or kept as
    they are when they are not JSON."""
    return fill(INPUT_FRAME, {"code": as_col(code), "symbols": labels.pretty_json(as_col(symbols))})


def recover_symbols(prompt: Column | str, compat: bool = False) -> Column:
    """The symbol block of a stored request, null when there is none.

    The stored heading ends in ``:**`` and its fence is marked ``json``. ``compat`` accepts neither
    and so finds nothing in such a request; callers then compute the symbols anew.
    """
    gap = r"\s*```\s*" if compat else r"\*{0,2}\s*```(?:json)?\s*"
    # up to the next fence without trying at every character whether it ends there; blanks before it are stripped
    pattern = rf"(?sU)AST Symbol Information \(JSON\):{gap}([^`]*+(?:`(?!``)[^`]*+)*+)```"
    return non_empty(strip(F.regexp_extract(as_col(prompt), pattern, 1)))


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """Adds ``label`` and ``method`` to every attempt, null where no label was found."""
    keep = [c for c in attempts.columns if c != "raw_response"]
    return attempts.select(*keep, computed_once(labels.resolve_label("raw_response")))


def _order(max_attempts: int | None) -> Column:
    """Attempt, a digest of the label and the row as one number of fixed width, which a hash aggregate can keep the
    least of; null for attempts without a label, or beyond the allowed ones."""
    whole = lambda c: c.cast("decimal(38,0)")
    digest = F.shiftrightunsigned(F.xxhash64("method", "label"), 32)
    order = (whole(F.col("attempt")) * whole(F.lit(1 << 32)) + whole(digest)) * whole(F.lit(2**63 - 1)) + whole(F.col("_row"))
    allowed = F.col("label").isNotNull()
    return F.when(allowed if max_attempts is None else allowed & (F.col("attempt") <= max_attempts), order.cast("decimal(38,0)"))


def first_success(resolved: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """(request_id, status, attempt, label, method): the first attempt that gave a label, among the
    first ``max_attempts`` where that is given. Of rows with equal request and attempt one wins, by a digest of
    its label.

    The attempts are judged once and written to the shared folder. From there the winners are found by numbers alone;
    then the texts of labels go to them, each moved once and none sorted."""
    rows = resolved.select("request_id", "attempt", "label", "method", F.monotonically_increasing_id().alias("_row"))
    judged = rows.select("request_id", "attempt", "label", "method", "_row", _order(max_attempts).alias("_order"))
    judged = materialize(judged, "judged-attempts")
    winners = judged.groupBy("request_id").agg(F.min("_order").alias("_order"))
    texts = judged.where(F.col("_order").isNotNull()).select("_order", "attempt", "label", "method")
    # requests without a label would all meet under one null; numbers below those of any attempt spread them
    spread = (-1 - F.pmod(F.xxhash64("request_id"), F.lit(1 << 31))).cast("decimal(38,0)")
    winners = winners.withColumn("_order", F.coalesce("_order", spread))
    won = winners.hint("shuffle_hash").join(texts, "_order", "left")
    return won.select(
        "request_id",
        F.when(F.col("attempt").isNull(), "failed").otherwise("ok").alias("status"),
        "attempt",
        "label",
        "method",
    )


def render_labels(results: DataFrame) -> DataFrame:
    """Lay the winning labels out as they are stored."""
    return results.withColumn("label", labels.pretty_json("label"))


def outcome() -> Column:
    out = F.when(F.col("error_class").isNotNull(), "other").when(blank("raw_response"), "empty_text").otherwise("ok")
    for error, name in OUTCOMES.items():
        out = F.when(F.col("error_class") == error, name).otherwise(out)
    return out


def classify_outcome(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn("outcome", outcome())


def outcome_counts(attempts: DataFrame) -> DataFrame:
    return classify_outcome(attempts).groupBy("outcome").agg(F.count("*").alias("n"))


def retry_wait(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(request_id, client_wait, caller_wait) in seconds.

    The client waits after every failed attempt: a fixed time on quota, else doubling from the
    base. The caller around it doubles from one second and does not wait after its last attempt.
    """
    step = F.pow(F.lit(2.0), F.col("attempt") - 1)
    failed = F.col("outcome") != "ok"
    client = F.when(~failed, 0.0).when(F.col("outcome") == "quota", float(QUOTA_WAIT)).otherwise(step * BASE_WAIT)
    caller = F.when(failed & (F.col("attempt") < max_attempts), step).otherwise(0.0)
    return (
        classify_outcome(attempts)
        .groupBy("request_id")
        .agg(F.sum(client).cast("bigint").alias("client_wait"), F.sum(caller).cast("bigint").alias("caller_wait"))
    )


def to_entry(df: DataFrame, keys: list[str], code: str = "code", symbols: str = "symbols_json", label: str = "label") -> DataFrame:
    return df.select(
        *keys,
        F.lit(INSTRUCTION).alias("instruction"),
        render_input(code, symbols).alias("input"),
        F.col(label).alias("output"),
    )
