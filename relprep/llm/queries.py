"""One query for each operator, with its production parameters over its whole table.

The vocabulary files' folder is a parameter of the operators; the queries
take the one of the installed ``public_tokenizers`` package.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from relprep.llm import conversation_trie, decontaminate, line_dedup, packing, pii_crf, quality_rules, secret_forest, simhash_dedup, suffix_dedup, token_counts, token_store, url_model, word_variants
from relprep.llm.common import read
from relprep.llm.registry import query


@query("op1_simhash_near_dedup")
def op1(spark, sf_dir):
    found = simhash_dedup.components(read(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_best_fit_packing")
def op4(spark, sf_dir):
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cut="word", capacity=2048, end_id=0)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 2048)


@query("op5_token_id_output")
def op5(spark, sf_dir):
    images = token_store.write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cut="space", end_id=0)
    return token_store.read_tokens(images)


@query(
    "op8_quality_rules",
    r"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY doc_id),
    raw AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS x FROM d),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM raw WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    norm AS (SELECT doc_id, source, trim(regexp_replace(lower(x), '[ \t\x0B\f\r]+', ' ', 'g'), ' ') AS x FROM raw),
    held AS (SELECT doc_id, source, x, sum(len(string_split(x, ' '))) AS words FROM norm WHERE x <> '' GROUP BY ALL),
    base AS (SELECT d.doc_id, len(w) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(w) AS failed FROM d LEFT JOIN covered USING (doc_id)),
    common AS (SELECT source, x, min(doc_id) FILTER (NOT failed) AS carrier FROM held JOIN base USING (doc_id) GROUP BY source, x HAVING count(*) > 20),
    lost AS (SELECT doc_id, sum(words) AS n FROM held JOIN common USING (source, x) WHERE doc_id IS DISTINCT FROM carrier GROUP BY doc_id),
    m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
          FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * (n_words - n_removed_words) >= 3 * n_words AS kept
    FROM m""",
)
def op8(spark, sf_dir):
    found = quality_rules.judge(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


@query(
    "op9_benchmark_decontamination",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
    b AS (SELECT item, item_id, w, CASE WHEN len(w) < 3 THEN 5 ELSE least(5, len(w)) END AS k
          FROM (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
    ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
           FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 2))) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) > 0)),
    bs AS (SELECT DISTINCT item, item_id, k, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item, item_id, k, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b)),
    n AS (SELECT item, count(*) AS n_item FROM bs GROUP BY item),
    hit AS (SELECT doc_id, item, any_value(item_id) AS item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, s) GROUP BY doc_id, item)
    SELECT doc_id, item_id, n_item, n_shared FROM hit JOIN n USING (item) WHERE n_shared * 10 >= n_item * 8
    """,
)
def op9(spark, sf_dir):
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), threshold=0.8)
    return found.select("doc_id", "item_id", "n_item", "n_shared")


@query("op2_line_dedup")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = line_dedup.deduplicate(docs, max_bits=2, similarity=0.8)
    removed = F.coalesce("_removed", F.array().cast("array<int>"))
    return found.select("doc_id", F.size(removed).alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op10_suffix_array_dedup")
def op10(spark, sf_dir):
    found = suffix_dedup.deduplicate(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_url_filter")
def op6(spark, sf_dir):
    return url_model.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", F.round("score", 6).alias("score"), "verdict")


@query("op7_secret_scan")
def op7(spark, sf_dir):
    found = secret_forest.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "stop", F.sha2("run", 256).alias("run_sha256"), "score")


@query("op3_pii_spans")
def op3(spark, sf_dir):
    found = pii_crf.scan(read(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in pii_crf.KINDS])

    def listed(spans):  # by start, then kind as listed
        placed = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("k"), s["stop"].alias("stop"))))
        return F.array_join(F.transform(placed, lambda s: F.concat_ws(":", F.get(kinds, (s["k"] - 1).cast("int")), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii_crf.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "added")).alias("spans"))


@query("op11_token_counts")
def op11(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


#: CRC-32 in SQL: the table of the polynomial's remainders, and a string's number as an expression.
_CRC = "crc AS (SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t FROM range(256) AS r(i))"


def _crc32(s):
    octets = f"list_transform(range(1, 2 * octet_length(encode({s})), 2), lambda k: CAST('0x' || substr(hex(encode({s})), k, 2) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295)"


@query(
    "op12_conversation_trie",
    f"""
    WITH {_CRC},
    own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
            FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own), crc),
    turns AS (SELECT c.conv_id, 0 AS part, i, role, text FROM convs AS c JOIN own ON own.conv_id = base WHERE i < h
              UNION ALL SELECT c.conv_id, 1, i, role, text FROM convs AS c JOIN own USING (conv_id) WHERE i >= h),
    placed AS (SELECT conv_id, row_number() OVER w AS depth, len(text) AS chars,
                      string_agg(len(role) || ':' || role || len(text) || ':' || text, '') OVER (w ROWS UNBOUNDED PRECEDING) AS path
               FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
    members AS (SELECT conv_id, 0 AS depth, 0 AS chars, '' AS path FROM convs UNION ALL SELECT conv_id, depth, chars, path FROM placed),
    above AS (SELECT conv_id, depth + 1 AS depth, path AS up FROM members),
    tops AS (SELECT conv_id, max(depth) AS last FROM members GROUP BY conv_id),
    nodes AS (SELECT path, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                     string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last) AS ends
              FROM members LEFT JOIN above USING (conv_id, depth) JOIN tops USING (conv_id) GROUP BY path, depth),
    kids AS (SELECT up AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    own_sums AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes LEFT JOIN kids USING (path, depth)),
    below AS (SELECT m.path, m.depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
              FROM own_sums AS s JOIN members AS m ON m.conv_id = s.conv_id AND m.depth <= s.depth GROUP BY ALL)
    SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, s.n_convs, CAST(s.n_children AS BIGINT) AS n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(s.ends, '')) AS ends_sha256
    FROM own_sums AS s JOIN below USING (path, depth) LEFT JOIN nodes AS p ON p.path = s.up AND p.depth = s.depth - 1
    """,
)
def op12(spark, sf_dir):
    return conversation_trie.trie(read(spark, sf_dir, "conversations"))


@query(
    "op13_spelling_variants",
    f"""
    WITH RECURSIVE {_CRC},
    runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
    numbered AS (SELECT run, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 7),
    cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM numbered),
    words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    holes AS (SELECT word, n, i, substr(word, 1, i - 1) AS front, substr(word, i + 1) AS back FROM places),
    shorter AS (SELECT DISTINCT word, n, front || back AS near FROM holes),
    pairs AS (SELECT a.word, b.word AS near, b.n AS n_near FROM holes AS a JOIN holes AS b USING (i, front, back) WHERE a.word <> b.word
              UNION ALL SELECT s.word, near, words.n FROM shorter AS s JOIN words ON near = words.word
              UNION ALL SELECT near, s.word, s.n FROM shorter AS s JOIN words ON near = words.word),
    best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n_near DESC, near) AS near, max(n_near) AS near_n FROM pairs GROUP BY word),
    formed AS (SELECT word, n, coalesce(best.n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
               FROM words LEFT JOIN best USING (word)),
    ways AS (SELECT word, word AS root FROM formed WHERE form IS NULL UNION ALL SELECT f.word, root FROM formed AS f JOIN ways ON f.form = ways.word)
    SELECT word, n, CAST(n_near AS BIGINT) AS n_near, form, form_n, root FROM formed JOIN ways USING (word)
    """,
)
def op13(spark, sf_dir):
    words = word_variants.document_words(read(spark, sf_dir, "documents"))
    return word_variants.group_variants(words).select("word", "n", "n_near", "form", "form_n", "root")
