"""Registered queries over the test tables, with SQL where DuckDB can express the operator."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.conversation_repair import DELETE, INSERT, REROLE, TRUNCATED, repair_report
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.html_extraction import LONG, extract_text
from tidemark.llm.language_id import identify_languages
from tidemark.llm.license_scan import CONTAINMENT, SHINGLE, TEMPLATES, scan_licenses
from tidemark.llm.quality_rules import MAX_COVERAGE, MAX_LINE_COVERAGE, quality_report
from tidemark.llm.secret_scan import find_secrets
from tidemark.llm.sentencepiece_codec import encode_pieces
from tidemark.llm.shard_tree import OVERHEAD_BYTES, assign_shards, fleet, grown
from tidemark.llm.simhash_dedup import near_duplicates
from tidemark.llm.spelling_variants import MIN_COUNT, MIN_LETTERS, TIMES, count_words, group_spellings
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_output import round_trip


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pieces(_documents(spark, folder))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents; a source is an owner, a document a repository."""
    return find_secrets(_documents(spark, folder)).drop("text_key", "found")


def op3_shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of 4 regions with 2 racks each."""
    return assign_shards(_documents(spark, folder))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(_documents(spark, folder)).drop("matches")
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op5_simhash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_documents(spark, folder))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Items of the benchmark in all documents."""
    return find_leaks(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(_documents(spark, folder)).drop("kept")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(_documents(spark, folder))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(_documents(spark, folder)).drop("coverage", "line_coverage")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token ids, written to files and read back."""
    return round_trip(_documents(spark, folder))


def _damaged(messages: DataFrame) -> DataFrame:
    """The rows with the faults that their checksums call for; ``copy`` numbers a repeated row."""
    number, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    kind = F.crc32(F.concat(number, F.lit(":"), turn)) % 20
    return messages.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = _damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    return repair_report(rows, absent_col="dropped", copy_col="copy")


# One in so many runs of letters is misspelt on purpose.
DAMAGE_EVERY = 199


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents and the forms that they are misspellings of."""
    return group_spellings(count_words(_documents(spark, folder), damage_every=DAMAGE_EVERY))


def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(spark.read.parquet(f"{folder}/pages.parquet"))


def _crc_sql(bytes_: str) -> str:
    """The CRC-32 of a blob in SQL."""
    crc = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
        crc.append(byte)
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length({bytes_})),
        lambda i: ('0x' || substr(hex({bytes_}), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(({crc})[(xor(c, b) & 255) + 1], c >> 8)))"""


def _op11_sql() -> str:
    """The same dynamic program row by row: per place the cost, the audit and the repaired text so far."""

    def edit(place: str, cost: str, letter: str, line: str | None = None) -> str:
        text = f"{place}.r" if line is None else f"{place}.r || CASE {place}.r WHEN '' THEN '' ELSE chr(10) END || {line}"
        return f"{{'c': {place}.c + {cost}, 'a': {place}.a || '{letter}', 'r': {text}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    keep = f"CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END"
    rerole = f"{REROLE} + {keep}"
    own, out = "role || ':' || text", "CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END + "

    def kept(place: str, initial: str) -> str:
        return edit(place, f"{out}CASE initial WHEN '{initial}' THEN 0 ELSE 1000000000 END + {keep}", "K", own)

    def given(place: str, role: str) -> str:
        return edit(place, f"{out}{rerole}", "R", f"'{role}:' || text")

    user = [x for p in ("s0", "s1", "s3") for x in (kept(p, "u"), given(p, "user"))]
    never = "{'c': 1000000000::BIGINT, 'a': '', 'r': ''}"
    inserted = f"""n0 AS s0, n1 AS s1, {least("n2", *[edit(p, str(INSERT), "I", "'user:'") for p in ("n0", "n1", "n3")])} AS s2,
        {least("n3", edit(least("n2", *[edit(p, str(INSERT), "I", "'user:'") for p in ("n0", "n1", "n3")]), str(INSERT), "I", "'assistant:'"))} AS s3"""
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH RECURSIVE source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS key
    FROM conversations
), hashed AS (SELECT *, {_crc_sql("key")} % 20 AS kind FROM source),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE kind <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM damaged
), faults AS (
    SELECT *, left(role, 1) AS initial,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
           CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'blank' WHEN again THEN 'duplicate'
                WHEN regexp_extract(text, '({blank})[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
                ELSE '' END AS fault
    FROM numbered
), walk AS (
    SELECT conv_id, 0::BIGINT AS i, {inserted}
    FROM (SELECT DISTINCT conv_id, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS n0, {never} AS n1, {never} AS n2, {never} AS n3
          FROM conversations)
    UNION ALL
    SELECT conv_id, i, {inserted}
    FROM (
        SELECT f.conv_id, f.i, {edit("s0", str(DELETE), "D")} AS n0,
               {least(edit("s1", str(DELETE), "D"), kept("s0", "s"))} AS n1,
               {least(edit("s2", str(DELETE), "D"), *user)} AS n2,
               {least(edit("s3", str(DELETE), "D"), kept("s2", "a"), given("s2", "assistant"))} AS n3
        FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    )
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM faults GROUP BY ALL
)
SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, {least("s0", "s3")}.c AS cost,
       {least("s0", "s3")}.a AS audit, sha256({least("s0", "s3")}.r) AS repaired_sha256
FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
WHERE w.i = coalesce(n, 0)
"""


_OP12_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT run, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS key, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (SELECT run, n, {_crc_sql("key")} AS h FROM counted),
spelt AS (
    SELECT CASE WHEN h % {DAMAGE_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n AS times
    FROM hashed
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= {MIN_LETTERS}
    GROUP BY word HAVING sum(times) >= {MIN_COUNT}
), cut AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
    UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)
), best AS (
    SELECT near.word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n
    FROM near JOIN words ON words.word = other GROUP BY ALL
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form,
           CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), walk AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = root AND form IS NOT NULL
), roots AS (SELECT word, arg_max(root, n) AS root FROM walk JOIN (SELECT word AS root, n FROM words) USING (root) GROUP BY ALL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


# Markup and character references as they occur in the given pages.
_OP13_SQL = f"""
WITH raw AS (
    SELECT row_number() OVER () AS row, page_id, url, coalesce(html, '') AS html,
           lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host
    FROM pages
), cut AS (
    SELECT *, regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'),
                  '<br>', ' ', 'g'), '</?(h1|p)>', chr(1), 'g') AS inner_,
           regexp_replace(regexp_replace(html, '^.*</head>|<!--.*?-->', '', 'gs'),
                  '<article>.*</article>|</?(nav|ul|li|div|footer|body|html)[^>]*>', chr(1), 'gs') AS outer_
    FROM raw
), plain AS (
    SELECT row, page_id, url, host, list_transform([inner_, outer_], lambda part: list_filter(list_transform(
               string_split(regexp_replace(part, '</?(a|b)( [^>]*)?>', '', 'g'), chr(1)),
               lambda t: trim(regexp_replace(regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&copy;', '\u00a9'),
                   '&middot;', '\u00b7'), '&amp;?', '&', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g'))),
               lambda t: t <> '')) AS parts
    FROM cut
), tokens AS (
    SELECT row, host, md5(array_to_string(parts[1], chr(2)) || chr(1) || array_to_string(parts[2], chr(2))) AS holder,
           flatten(list_transform(parts[2], lambda b: list_prepend(chr(10), string_split(b, ' ')))) AS tokens
    FROM plain
), runs AS (
    SELECT row, host, holder, i, array_to_string(tokens[i:i + {LONG - 1}], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(tokens) - {LONG - 2})) AS i FROM tokens)
), repeated AS (SELECT host, run FROM runs GROUP BY ALL HAVING count(DISTINCT holder) > 1),
counts AS (
    SELECT row, count(DISTINCT place) AS n
    FROM (SELECT row, unnest(range(i, i + {LONG})) AS place FROM runs SEMI JOIN repeated USING (host, run)) GROUP BY ALL
)
SELECT page_id, url, array_to_string(parts[1], chr(10) || chr(10)) AS text,
       length(array_to_string(parts[1], chr(10) || chr(10))) AS n_chars, coalesce(n, 0) AS n_repeated
FROM plain LEFT JOIN counts USING (row)
"""


_OP9_SQL = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts
), grams AS (
    SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
          FROM texts, (SELECT unnest([5, 6, 7, 8, 9, 10]) AS n))
), marked AS (
    SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, gram) > 1 AS repeated,
           row_number() OVER (PARTITION BY doc_id, n, gram ORDER BY i) > 1 AS later
    FROM grams
), covered AS (
    SELECT doc_id, n, i, bool_or(repeated) AS repeated, bool_or(later) AS later
    FROM (SELECT doc_id, n, unnest(range(i, i + n)) AS i, repeated, later FROM marked WHERE repeated)
    GROUP BY ALL
), shares AS (
    SELECT doc_id, n, count(*) FILTER (repeated) AS n_repeat,
           sum(length(word)) FILTER (later) AS chars
    FROM covered JOIN words USING (doc_id, i) GROUP BY ALL
), lines AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) > 1 AS again
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), line_shares AS (
    SELECT doc_id, count(*) FILTER (again) AS n_dup, sum(length(line)) FILTER (again) AS again_chars,
           sum(length(line)) AS chars
    FROM lines GROUP BY ALL
), sizes AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY ALL
), base AS (
    SELECT t.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
           coalesce((SELECT n_repeat FROM shares s WHERE s.doc_id = t.doc_id AND n = 5), 0)::BIGINT
               AS n_repeat_words,
           coalesce(again_chars / l.chars, 0) AS line_coverage
    FROM texts t LEFT JOIN sizes USING (doc_id) LEFT JOIN line_shares l USING (doc_id)
), broken AS (
    SELECT DISTINCT doc_id FROM shares JOIN sizes USING (doc_id)
    WHERE chars::DOUBLE / word_chars > CASE n {" ".join(f"WHEN {n} THEN {m}::DOUBLE" for n, m in MAX_COVERAGE.items())} END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
           AND line_coverage <= {MAX_LINE_COVERAGE}::DOUBLE AND doc_id NOT IN (FROM broken) AS kept
FROM base
"""


def _op3_sql() -> str:
    """The same three draws, each as a minimum over the children of one node."""
    trees = []
    for name, tree in (("old", fleet()), ("new", grown(fleet()))):
        rows = ", ".join(f"({s.number}, {s.region}, {s.rack}, {s.weight})" for s in tree)
        trees.append(f"{name} AS (SELECT * FROM (VALUES {rows}) AS t(number, region, rack, weight))")
        trees.append(
            f"""{name}_region AS (SELECT doc_id, arg_min(region, -ln((('0x' || substr(md5(key || ':region/' || region), 1, 12))
            ::BIGINT + 0.5) / 281474976710656.0) / weight) AS region
            FROM keys, (SELECT region, sum(weight) AS weight FROM {name} GROUP BY ALL) GROUP BY ALL),
            {name}_rack AS (SELECT doc_id, region, arg_min(rack, -ln((('0x' || substr(md5(key || ':rack/' || region
            || '/' || rack), 1, 12))::BIGINT + 0.5) / 281474976710656.0) / weight) AS rack
            FROM keys JOIN {name}_region USING (doc_id)
            JOIN (SELECT region, rack, sum(weight) AS weight FROM {name} GROUP BY ALL) USING (region) GROUP BY ALL),
            {name}_shard AS (SELECT doc_id, arg_min(number, -ln((('0x' || substr(md5(key || ':shard/' || region
            || '/' || rack || '/' || number), 1, 12))::BIGINT + 0.5) / 281474976710656.0) / weight) AS number
            FROM keys JOIN {name}_rack USING (doc_id) JOIN {name} USING (region, rack) GROUP BY ALL)"""
        )
    return f"""
WITH keys AS (SELECT doc_id, doc_id::VARCHAR AS key FROM documents), {", ".join(trees)},
codes AS (SELECT doc_id, text, encode(coalesce(text, '')) AS bytes FROM documents)
SELECT doc_id, (octet_length(bytes) + {OVERHEAD_BYTES})::BIGINT AS size,
       {_crc_sql("bytes")} AS text_crc32,
       'key' AS law, old_shard.number AS shard,
       row_number() OVER (PARTITION BY old_shard.number ORDER BY doc_id) - 1 AS slot,
       new_shard.number AS grown_shard
FROM codes JOIN old_shard USING (doc_id) JOIN new_shard USING (doc_id)
"""


_OP4_SQL = f"""
WITH templates AS (
    SELECT row_number() OVER () AS number, name, text
    FROM (VALUES {", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in t) + ")" for t in TEMPLATES)}) AS t(name, text)
), words AS (
    SELECT 't' AS kind, number AS id, text FROM templates
    UNION ALL SELECT 'd', doc_id, coalesce(text, '') FROM documents
), split AS (
    SELECT kind, id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w
    FROM words
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS shingle
    FROM (SELECT kind, id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM split)
), found AS (
    SELECT d.id AS doc_id, t.id AS number,
           count(*) / (SELECT count(*) FROM shingles s WHERE s.kind = 't' AND s.id = t.id) AS containment
    FROM shingles d JOIN shingles t ON d.shingle = t.shingle AND d.kind = 'd' AND t.kind = 't'
    GROUP BY d.id, t.id HAVING containment >= {CONTAINMENT}::DOUBLE
)
SELECT d.doc_id, coalesce(array_to_string(list_sort(list_distinct(list(name) FILTER (name IS NOT NULL))), ','), '') AS licenses,
       count(number) AS n_templates, coalesce(max(containment), 0)::DOUBLE AS best
FROM documents d LEFT JOIN found USING (doc_id) LEFT JOIN templates USING (number)
GROUP BY d.doc_id
"""

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secret_scan": op2_secret_scan,
    "op3_shard_tree": op3_shard_tree,
    "op4_license_scan": op4_license_scan,
    "op5_simhash_tree": op5_simhash_tree,
    "op6_decontaminate": op6_decontaminate,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_files": op10_token_files,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_html_extraction": op13_html_extraction,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op3_shard_tree": _op3_sql(),
    "op4_license_scan": _OP4_SQL,
    "op9_quality_rules": _OP9_SQL,
    "op11_conversation_repair": _op11_sql(),
    "op12_spelling_variants": _OP12_SQL,
    "op13_html_extraction": _OP13_SQL,
}
