"""Inputs derived from the shipped tables, built with DataFrame operations.

``FIXTURE_SQL`` states the same derivations as common table expressions for the SQL check. Every
derivation covers all rows and whole texts; remainders of ``doc_id`` only choose which of several
shapes a row takes, never whether its document takes part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessella.functions.text import let
from tessella.session import prepare

BAD_ENTRY_SHAPES = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _label_parts(docs: DataFrame) -> DataFrame:
    """Adds ``words``, ``rs`` (reasoning text), ``ids`` (JSON list) and ``good`` (a full label)."""
    k = (F.col("doc_id") % 5).cast("int")
    return (
        docs.withColumn("words", F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)))
        .withColumn("rs", F.regexp_replace("text", r"[^\p{L} ]", " "))
        .withColumn("idl", F.filter("words", lambda w: (k > 0) & (F.length(w) >= k + 4)))
        .withColumn(
            "ids",
            F.when(F.size("idl") == 0, "[]").otherwise(
                F.concat(F.lit('["'), F.array_join("idl", '","'), F.lit('"]'))
            ),
        )
        .withColumn(
            "good",
            F.concat(F.lit('{"reasoning":"'), "rs", F.lit('","identifiers":'), "ids", F.lit("}")),
        )
    )


def _shape(key: Column, shapes: dict[int, Column], default: Column) -> Column:
    out = default
    for value, shape in shapes.items():
        out = F.when(key == value, shape).otherwise(out)
    return out


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset entry per document: (entry_id, dataset, input, output)."""
    d = _label_parts(documents(spark, sf_dir))
    output = _shape(
        F.col("doc_id") % BAD_ENTRY_SHAPES,
        {
            0: F.concat(F.lit('{"reasoning":"'), "rs", F.lit('"')),
            1: F.concat(F.lit('{"reasoning":"'), "rs", F.lit('"}')),
            2: F.concat(F.lit('{"reasoning":"'), "rs", F.lit('","identifiers":"x"}')),
            3: F.concat(F.lit('{"reasoning":null,"identifiers":'), "ids", F.lit("}")),
            4: F.lit("  "),
            5: F.col("ids"),
            6: F.concat(F.lit('{"reasoning":"'), "rs", F.lit('","identifiers":null}')),
        },
        F.col("good"),
    )
    return d.select(
        F.col("doc_id").alias("entry_id"),
        F.when(F.col("doc_id") % 2 == 0, "gen_a").otherwise("gen_b").alias("dataset"),
        F.col("text").alias("input"),
        output.alias("output"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSONL line per document, good or broken, and blank lines between them: (line_no, line)."""
    d = _label_parts(documents(spark, sf_dir))
    quoted = F.replace(F.col("good"), F.lit('"'), F.lit('\\"'))
    entry = F.concat(
        F.lit('{"instruction":"find","input":"'), "rs", F.lit('","output":"'), quoted, F.lit('"}')
    )
    line = _shape(
        F.col("doc_id") % 9,
        {
            2: F.concat(entry, F.lit(" xx")),
            3: F.concat(F.lit('["'), "rs", F.lit('"]')),
            4: F.concat(F.lit('{"instruction":"find","input":"'), "rs"),
            5: F.concat(F.lit('{"instruction":"find","input":"'), "rs", F.lit('","output":7}')),
            6: F.concat(F.lit('  {"instruction":"find","input":"'), "rs", F.lit('"} ')),
        },
        entry,
    )
    blank = F.when(F.col("doc_id") % 9 == 0, "").when(F.col("doc_id") % 9 == 1, "   ")
    numbered = F.struct(F.col("doc_id").alias("line_no"), line.alias("line"))
    between = F.struct((-F.col("doc_id") - 1).alias("line_no"), blank.alias("line"))
    return d.select(F.inline(F.array(numbered, between))).where("line is not null or line_no >= 0")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three attempts per document: (request_id, attempt, variant, raw_response, error_class)."""
    d = _label_parts(documents(spark, sf_dir))
    d = d.withColumn(
        "bare",
        F.concat(F.lit('{reasoning:"'), "rs", F.lit('",identifiers:'), "ids", F.lit("}")),
    ).withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    v = ((F.col("doc_id") * 7 + F.col("attempt") * 3) % 10).cast("int")
    raw = _shape(
        v,
        {
            0: F.concat(F.lit("```json\n"), "good", F.lit("\n```")),
            1: F.concat(F.lit("Here is the result.\n```\n"), "good", F.lit("\n```\nDone.")),
            2: F.concat(F.lit("Some notes first\n"), "good", F.lit("\nEnd of notes")),
            3: F.concat(F.lit("Answer: "), "good"),
            4: F.col("bare"),
            5: F.concat(F.lit("```json\n"), "bare", F.lit("\n```")),
            6: F.expr("left(good, length(good) - 1)"),
            7: F.lit('```json\n{"reasoning":"x"}\n```'),
        },
        F.lit(None).cast("string"),
    )
    error = F.when(v == 8, "blocked").when(v == 9, "quota")
    return d.select(
        F.col("doc_id").alias("request_id"),
        "attempt",
        v.alias("variant"),
        raw.alias("raw_response"),
        error.alias("error_class"),
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a partly finished run left behind: (generator, project, base_filename, kind, content).

    Some kinds are not there yet, which is what the resume operators look for.
    """
    d = _label_parts(documents(spark, sf_dir))
    label = _shape(
        F.col("doc_id") % 11,
        {
            0: F.lit(""),
            1: F.lit('{"error": "generation_failed"}'),
            2: F.lit("{}"),
            3: F.concat(F.lit('{"reasoning":"'), "rs", F.lit('"')),
        },
        F.col("good"),
    )
    code = F.when(F.col("doc_id") % 23 == 0, " \n").otherwise(F.concat(F.lit("let t = "), "rs"))
    prompt = F.concat(
        F.lit("Explain.\n\n**AST Symbol Information (JSON):**\n```json\n[]\n```\n\nCode:\n"), "rs"
    )
    kinds = F.array(
        F.struct(F.lit("code").alias("kind"), code.alias("content"), (F.col("doc_id") % 13 == 0).alias("gone")),
        F.struct(F.lit("label").alias("kind"), label.alias("content"), (F.col("doc_id") % 7 == 0).alias("gone")),
        F.struct(F.lit("prompt").alias("kind"), prompt.alias("content"), (F.col("doc_id") % 17 == 0).alias("gone")),
    )
    return (
        _keyed(d)
        .select("generator", "project", "base_filename", F.inline(kinds))
        .where(~F.col("gone"))
        .drop("gone")
    )


def _keyed(d: DataFrame) -> DataFrame:
    polarity = F.when(F.col("doc_id") % 2 == 0, "positive").otherwise("negative")
    return d.select(
        "*",
        F.when(F.col("doc_id") % 4 < 2, "gen_a").otherwise("gen_b").alias("generator"),
        F.col("source").alias("project"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("_"), polarity).alias("base_filename"),
        polarity.alias("polarity"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wanted samples: one per document."""
    return _keyed(documents(spark, sf_dir)).select("generator", "base_filename", "polarity")


def symbol_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol lists computed from code: absent where the analysis failed."""
    return (
        _keyed(documents(spark, sf_dir))
        .withColumn("symbols_json", F.when(F.col("doc_id") % 19 != 0, '[{"symbolName":"t","symbolKind":"variable"}]'))
        .select("generator", "project", "base_filename", "symbols_json")
        .where("symbols_json is not null")
    )


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category, idx, text) from the parts: 1-based position within the category."""
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))
    category = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("NonSensitive_"), brand)).otherwise(
        F.concat_ws("_", "p_type", brand)
    )
    return (
        table(spark, sf_dir, "part")
        .select(category.alias("category"), F.col("p_name").alias("text"))
        .distinct()
        .withColumn("idx", F.expr("cast(row_number() over (partition by category order by text) as int)"))
    )


CHUNK = 7


#: What a run of seven words becomes, by turns: {0} to {6} stand for the words.
SOURCE_SHAPES = (
    "@objc class T_{0}: P_{1}, P_{2} {{\n  var v_{3}: Int\n  func f_{4}(x: Int) -> Bool {{ c_{5}(v_{3}.m_{6}()) }}\n}}\n",
    "/* {{ /* T_{0} */ }} */\npublic struct S_{0}<A, B: P_{1}>: Q_{2}<A, B> {{\n"
    "  struct N_{3} {{\n    let p_{4}: D<Int, [K_{5}]> = e_{5}(/}}{6}{{2}}/)\n  }}\n"
    "  func g_{4}<C>(_ y: [C], by z: D<C, Int>) -> [C] where C: P_{1} {{\n"
    "    y.filter {{ k in h_{5}(k, R<Int, C>(x: i_{6})) }}\n  }}\n}}\n",
)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source file per document (file_id, code): every run of seven words of the text becomes, by turns, a class with
    a property and a method, or nested types with comments, generics, a regex literal and a closure; so the file
    grows with the text."""

    def shaped(shape: str, words, c):
        pieces = []
        for text, field, _, _ in string.Formatter().parse(shape):
            pieces.append(F.lit(text))
            if field is not None:
                pieces.append(F.coalesce(F.get(words, c * CHUNK + int(field)), F.lit("pad")))
        return F.concat(*pieces)

    def build(words):
        n = F.ceil(F.size(words) / CHUNK).cast("int")
        runs = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        by_turns = F.transform(runs, lambda c: F.when(c % 2 == 0, shaped(SOURCE_SHAPES[0], words, c)).otherwise(shaped(SOURCE_SHAPES[1], words, c)))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(by_turns, ""))

    words = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("import Foundation\n"), let(words, build)).alias("code"),
    )


FIXTURE_SQL = {
    "parts": r"""
        w AS (SELECT *, regexp_extract_all(text, '\p{L}+') AS words,
                     regexp_replace(text, '[^\p{L} ]', ' ', 'g') AS rs, doc_id % 5 AS k FROM documents),
        i AS (SELECT *, [x FOR x IN words IF k > 0 AND length(x) >= k + 4] AS idl FROM w),
        j AS (SELECT *, CASE WHEN len(idl) = 0 THEN '[]'
                             ELSE '["' || array_to_string(idl, '","') || '"]' END AS ids FROM i),
        parts AS (SELECT *, '{"reasoning":"' || rs || '","identifiers":' || ids || '}' AS good FROM j)""",
    "entries": r"""
        entries AS (SELECT doc_id AS entry_id, CASE WHEN doc_id % 2 = 0 THEN 'gen_a' ELSE 'gen_b' END AS dataset,
            text AS input,
            CASE doc_id % 11
              WHEN 0 THEN '{"reasoning":"' || rs || '"'
              WHEN 1 THEN '{"reasoning":"' || rs || '"}'
              WHEN 2 THEN '{"reasoning":"' || rs || '","identifiers":"x"}'
              WHEN 3 THEN '{"reasoning":null,"identifiers":' || ids || '}'
              WHEN 4 THEN '  '
              WHEN 5 THEN ids
              WHEN 6 THEN '{"reasoning":"' || rs || '","identifiers":null}'
              ELSE good END AS output FROM parts)""",
    "parsed": r"""
        ok AS (SELECT *, CASE WHEN json_valid(output) THEN output END AS j FROM entries),
        typed AS (SELECT *, coalesce(json_type(j) = 'OBJECT' AND json_type(j, '$.reasoning') IS NOT NULL
                                     AND json_type(j, '$.identifiers') IS NOT NULL, false) AS valid FROM ok),
        parsed AS (SELECT dataset, entry_id, valid,
            CASE WHEN NOT valid THEN NULL
                 WHEN json_type(j, '$.identifiers') <> 'ARRAY' THEN 'invalid'
                 WHEN json_array_length(j, '$.identifiers') = 0 THEN 'secure' ELSE 'vulnerable' END AS category,
            CASE WHEN valid AND json_type(j, '$.identifiers') = 'ARRAY'
                 THEN CAST(json_array_length(j, '$.identifiers') AS BIGINT) END AS n_items,
            CASE WHEN valid AND json_type(j, '$.reasoning') = 'VARCHAR'
                 THEN CAST(length(j ->> '$.reasoning') AS BIGINT) END AS reasoning_len,
            CASE WHEN valid AND json_type(j, '$.identifiers') = 'ARRAY'
                 THEN CAST(j -> '$.identifiers' AS VARCHAR[]) END AS items
            FROM typed)""",
    "lines": r"""
        lines AS (SELECT doc_id AS line_no, rs, good,
            '{"instruction":"find","input":"' || rs || '","output":"' || replace(good, '"', '\"') || '"}' AS entry
            FROM parts)""",
    "responses": r"""
        responses AS (SELECT doc_id AS request_id, a.attempt, CAST((doc_id * 7 + a.attempt * 3) % 10 AS INTEGER) AS variant,
            rs, ids, good, '{reasoning:"' || rs || '",identifiers:' || ids || '}' AS bare
            FROM parts, (VALUES (1), (2), (3)) AS a(attempt)),
        attempts AS (SELECT *, CASE variant
              WHEN 0 THEN '```json' || chr(10) || good || chr(10) || '```'
              WHEN 1 THEN 'Here is the result.' || chr(10) || '```' || chr(10) || good || chr(10) || '```' || chr(10) || 'Done.'
              WHEN 2 THEN 'Some notes first' || chr(10) || good || chr(10) || 'End of notes'
              WHEN 3 THEN 'Answer: ' || good
              WHEN 4 THEN bare
              WHEN 5 THEN '```json' || chr(10) || bare || chr(10) || '```'
              WHEN 6 THEN substr(good, 1, length(good) - 1)
              WHEN 7 THEN '```json' || chr(10) || '{"reasoning":"x"}' || chr(10) || '```' END AS raw_response,
            CASE variant WHEN 8 THEN 'blocked' WHEN 9 THEN 'quota' END AS error_class FROM responses)""",
    "keyed": r"""
        keyed AS (SELECT *, CASE WHEN doc_id % 4 < 2 THEN 'gen_a' ELSE 'gen_b' END AS generator, source AS project,
            CASE WHEN doc_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS polarity,
            'doc_' || doc_id || '_' || CASE WHEN doc_id % 2 = 0 THEN 'positive' ELSE 'negative' END AS base_filename,
            doc_id % 7 <> 0 AS has_label, doc_id % 13 <> 0 AS has_code, doc_id % 17 <> 0 AS has_prompt,
            doc_id % 19 <> 0 AS has_symbols,
            CASE doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN '{"error": "generation_failed"}' WHEN 2 THEN '{}'
                 WHEN 3 THEN '{"reasoning":"' || rs || '"' ELSE good END AS label,
            CASE WHEN doc_id % 23 = 0 THEN ' ' || chr(10) ELSE 'let t = ' || rs END AS code,
            'Explain.' || chr(10) || chr(10) || '**AST Symbol Information (JSON):**' || chr(10) || '```json' || chr(10) || '[]'
              || chr(10) || '```' || chr(10) || chr(10) || 'Code:' || chr(10) || rs AS prompt
            FROM parts)""",
    "artifacts": r"""
        artifacts AS (
            SELECT generator, project, base_filename, polarity, 'label' AS kind, label AS content FROM keyed WHERE has_label
            UNION ALL SELECT generator, project, base_filename, polarity, 'code', code FROM keyed WHERE has_code
            UNION ALL SELECT generator, project, base_filename, polarity, 'prompt', prompt FROM keyed WHERE has_prompt)""",
    "catalog": r"""
        raw_catalog AS (SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN 'NonSensitive_' || replace(p_brand, '#', '')
                               ELSE p_type || '_' || replace(p_brand, '#', '') END AS category, p_name AS text FROM part),
        catalog AS (SELECT category, text, CAST(row_number() OVER (PARTITION BY category ORDER BY text) AS INTEGER) AS idx,
            NOT starts_with(category, 'NonSensitive_') AS sensitive, split_part(category, '_', 1) AS domain
            FROM raw_catalog),
        patterns AS (SELECT *, category || '_' || idx AS pattern_id FROM catalog),
        sens AS (SELECT * FROM patterns WHERE sensitive),
        single_tasks AS (SELECT pattern_id AS filename, 'Pure_nC1' AS task_type, pattern_id AS id1, text AS text1,
            CAST(NULL AS VARCHAR) AS text2, category FROM sens),
        pair_tasks AS (SELECT a.pattern_id || '_' || b.pattern_id AS filename, 'Pure_nC2' AS task_type,
            a.pattern_id AS id1, a.text AS text1, b.text AS text2, a.category, b.pattern_id AS id2
            FROM sens a JOIN sens b ON a.category = b.category AND a.idx < b.idx),
        numbered AS (SELECT text, row_number() OVER (ORDER BY md5(pattern_id), pattern_id) - 1 AS n,
            count(*) OVER () AS total FROM patterns WHERE NOT sensitive),
        mixed_tasks AS (SELECT 'Mixed_' || s.pattern_id AS filename, 'Mixed' AS task_type, s.pattern_id AS id1,
            s.text AS text1, m.text AS text2, s.category FROM sens s JOIN numbered m
            ON m.n = CAST('0x' || substr(md5('7|' || s.pattern_id), 1, 12) AS BIGINT) % m.total),
        manifest AS (SELECT filename, task_type, id1, text1, text2 FROM single_tasks
            UNION ALL SELECT filename, task_type, id1, text1, text2 FROM pair_tasks
            UNION ALL SELECT filename, task_type, id1, text1, text2 FROM mixed_tasks)""",
    "source_words": r"""
        fw AS (SELECT doc_id AS file_id, regexp_extract_all(text, '\p{L}+') AS words FROM documents),
        chunks AS (SELECT file_id, words, unnest(range(0, CAST(ceil(len(words) / 7.0) AS BIGINT))) AS c FROM fw),
        cw AS (SELECT file_id, c,
            coalesce(words[c * 7 + 1], 'pad') AS w1, coalesce(words[c * 7 + 2], 'pad') AS w2,
            coalesce(words[c * 7 + 3], 'pad') AS w3, coalesce(words[c * 7 + 4], 'pad') AS w4,
            coalesce(words[c * 7 + 5], 'pad') AS w5, coalesce(words[c * 7 + 6], 'pad') AS w6,
            coalesce(words[c * 7 + 7], 'pad') AS w7 FROM chunks)""",
}

_NEEDS = {
    "entries": ["parts"],
    "parsed": ["parts", "entries"],
    "lines": ["parts"],
    "responses": ["parts"],
    "keyed": ["parts"],
    "artifacts": ["parts", "keyed"],
}


def with_fixtures(body: str, *names: str) -> str:
    """``body`` preceded by the common table expressions it needs."""
    order: list[str] = []
    for name in names:
        for need in [*_NEEDS.get(name, []), name]:
            if need not in order:
                order.append(need)
    return "WITH " + ",".join(FIXTURE_SQL[n] for n in order) + "\n" + body
