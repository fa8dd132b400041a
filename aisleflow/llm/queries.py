"""Registered queries of the training-data operators: name -> f(spark, sf_dir),
and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.llm import (chat, decontaminate, exact_dedup, html_extract, langid, line_rules, mixing, phrases, quality,
                           resharding, simhash, token_files, whitening)
from aisleflow.llm.common import held_out, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, F.col("lang"), ~held_out(F.col("doc_id")))
    return langid.predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: The layout before resharding, for op2: shards by crc32 of the id.
OLD_SHARDS = 32


def old_shard() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % OLD_SHARDS).cast("int")


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = resharding.ReshardConfig(n_shards=40)
    rows, _ = resharding.reshard(table(spark, sf_dir, "documents").select("doc_id", "text"), old_shard(), cfg)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select(
        "doc_id", resharding.row_size(F.col("text"), cfg.overhead).alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), old_shard().alias("old_shard"))


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    data = token_files.write(docs, tokenizer_path(), end_id=0)
    return token_files.read(spark, data, docs.schema["doc_id"].dataType.simpleString())


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label) of the rows that quality may be learned from."""
    return table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality_labels(spark, sf_dir))
    return quality.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


#: The conversation added to those of the table: its texts are control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    cfg = chat.ChatConfig(tokenizer_path())
    return chat.digests(chat.format_conversations(turns.unionByName(added), cfg), cfg)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.select_epochs(table(spark, sf_dir, "documents"), mixing.source_domain(F.col("source")),
                                   mixing.word_tokens(F.col("text")))
    return rows.where("__copies > 0").select(
        "doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"),
        F.col("__tokens").alias("n_tokens"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies").cast("long"))).alias("epoch"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), exact_dedup.ExactDedupConfig(keep="largest"))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", *line_rules.STATISTICS, "base_failed", "kept", "n_lines_removed", "n_words_left")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    share = F.lit([float(e / model.trace) for e in model.eigenvalues] or None).cast("array<double>")
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"),
        "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_resharding": op2_resharding,
    "op3_token_files": op3_token_files,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_html_extract": op7_html_extract,
    "op8_chat_format": op8_chat_format,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_line_rules": op11_line_rules,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _share_out_sql(nodes: str, parent: str, name: str, weights: dict) -> str:
    """The rule of ``mixing.share_out`` over the relation ``nodes``."""
    by = f"PARTITION BY {parent}" if parent else ""
    weight = " ".join(f"WHEN {name} = '{k}' THEN {w}" for k, w in weights.items())
    weight = f"CASE {weight} ELSE 1 END" if weights else "1"
    return f"""SELECT * EXCLUDE (part, spare, nth), CASE WHEN f THEN part ELSE part + CAST(nth <= spare AS INT) END AS budget FROM (
      SELECT *, lft - sum(CASE WHEN NOT f THEN part ELSE 0 END) OVER ({by}) AS spare,
             row_number() OVER ({by} ORDER BY f, {name}) AS nth FROM (
        SELECT *, CASE WHEN f THEN capacity ELSE (CAST(lft AS HUGEINT) * w) // open_w END AS part FROM (
          SELECT *, parent_budget - coalesce(sum(CASE WHEN f THEN capacity END) OVER ({by}), 0) AS lft,
                 sum(CASE WHEN NOT f THEN w END) OVER ({by}) AS open_w FROM (
            SELECT *, CAST(capacity AS HUGEINT) * rest_w <= CAST(parent_budget - bef AS HUGEINT) * w AS f FROM (
              SELECT *, coalesce(sum(capacity) OVER ({by} ORDER BY capacity / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
                     sum(w) OVER ({by} ORDER BY capacity / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM (
                SELECT *, {weight} AS w FROM {nodes}))))))"""


def _mixing_sql(cfg: mixing.MixConfig) -> str:
    number = "regexp_extract(source, '([0-9]+)$', 1)"
    none = mixing.NONE
    return f"""WITH d AS (
      SELECT doc_id, coalesce(CASE WHEN {number} = '' THEN NULL ELSE ['web', 'books', 'forums', 'reference'][CAST({number} AS BIGINT) % 4 + 1] END, '{none}') AS domain,
             coalesce(lang, '{none}') AS lang, coalesce(source, '{none}') AS source,
             coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')), 0) AS n_tokens,
             coalesce(CAST(doc_id AS VARCHAR), '') AS id, md5(coalesce(text, '')) AS tx FROM documents),
    leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {cfg.max_epochs} AS capacity FROM d GROUP BY ALL),
    d_in AS (SELECT domain, CAST(sum(capacity) AS BIGINT) AS capacity, (SELECT CAST(sum(tokens) * {cfg.budget_permille} // 1000 AS BIGINT) FROM leaves) AS parent_budget FROM leaves GROUP BY domain),
    d_out AS ({_share_out_sql("d_in", "", "domain", cfg.domain_weights)}),
    l_in AS (SELECT domain, lang, CAST(sum(l.capacity) AS BIGINT) AS capacity, any_value(o.budget) AS parent_budget FROM leaves l JOIN d_out o USING (domain) GROUP BY domain, lang),
    l_out AS ({_share_out_sql("l_in", "domain", "lang", cfg.lang_weights)}),
    s_in AS (SELECT l.*, o.budget AS parent_budget FROM leaves l JOIN l_out o USING (domain, lang)),
    s_out AS ({_share_out_sql("s_in", "domain, lang", "source", cfg.source_weights)}),
    own AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
                   CASE WHEN tokens > 0 THEN budget % tokens ELSE budget END AS rest FROM s_out),
    k AS (SELECT d.*, epochs, rest, md5('{cfg.seed}:' || CAST(epochs AS BIGINT) || ':' || id) AS h FROM d JOIN own USING (domain, lang, source)),
    r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, id, tx RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM k),
    c AS (SELECT *, CAST(epochs AS BIGINT) + CASE WHEN rest > 0 AND e <= rest THEN 1 ELSE 0 END AS copies FROM r)
    SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, unnest(range(1, copies + 1)) AS epoch FROM c WHERE copies > 0"""


def _line_rules_sql(cfg: line_rules.LineRulesConfig) -> str:
    """The rules of ``line_rules`` with whole lines in place of their hashes."""
    spaces = r"[\x20\x09-\x0D]+"
    gone = " ' || chr(9) || chr(11) || chr(12) || chr(13) || '"
    norm = f"translate(line, '{_UPPER}123456789{gone}', '{_LOWER}{'0' * 9}')"
    words = lambda t: f"[x FOR x IN string_split_regex({t}, '{spaces}') IF x <> '']"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {cfg.host} AS host, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, {words("text")} AS ws FROM d),
    ln AS (SELECT row, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
    lw AS (SELECT *, {norm} AS norm, len({words("line")}) AS n FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    often AS (SELECT host, norm FROM lw GROUP BY ALL HAVING count(DISTINCT text) > {cfg.max_docs}),
    lines AS (SELECT row, count(*) - count(DISTINCT line) AS dup,
                     sum(CASE WHEN o.norm IS NOT NULL THEN 1 ELSE 0 END) AS n_gone, sum(CASE WHEN o.norm IS NOT NULL THEN n ELSE 0 END) AS w_gone
              FROM lw LEFT JOIN often o ON lw.norm = o.norm AND lw.host IS NOT DISTINCT FROM o.host GROUP BY row),
    grams AS (SELECT row, unnest(range(1, len(ws) - 1)) AS i, unnest([ws[k:k + 2] FOR k IN range(1, len(ws) - 1)]) AS g FROM w WHERE len(ws) >= 3),
    twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS c FROM grams) WHERE c > 1),
    covered AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY row),
    s AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(text, '{line_rules.SYMBOL_CLASS}')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_gone, 0) AS BIGINT) AS n_lines_removed,
                 CAST(len(ws) - coalesce(w_gone, 0) AS BIGINT) AS n_words_left
          FROM w LEFT JOIN lines USING (row) LEFT JOIN covered c USING (row)),
    b AS (SELECT *, n_words < {cfg.min_words} OR 100 * n_repeat_words > {cfg.max_repeat_percent} * n_words AS base_failed FROM s)
    SELECT *, NOT base_failed AND n_words_left >= {cfg.min_words} AND 100 * n_words_left >= {cfg.min_left_percent} * n_words AS kept FROM b"""


def _phrases_sql(cfg: phrases.PhraseConfig) -> str:
    return f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[ \\t]+') IF x <> ''] AS ws FROM p),
    totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
    grams AS (SELECT lang, m, unnest([array_to_string(ws[k:k + m - 1], ' ') FOR k IN range(1, len(ws) - m + 2)]) AS phrase FROM w, range(1, {cfg.max_words + 1}) t(m) WHERE len(ws) >= m),
    f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {cfg.min_count}),
    c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2),
    inside AS (SELECT lang, a AS longer, unnest(list_concat(
                   {", ".join(f"CASE WHEN m > {k} THEN [array_to_string(ws[i:i + {k - 1}], ' ') FOR i IN range(1, m - {k} + 2)] ELSE [] END" for k in range(2, cfg.max_words))})) AS phrase FROM c),
    kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= {cfg.drop_percent} * c.a)),
    cuts AS (SELECT lang, phrase, a, m, ws, unnest(range(1, m)) AS k FROM kept),
    scored AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score
               FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
               JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:c.m], ' ') JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored) WHERE nth = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {cfg.top}"""


ORACLE_SQL: dict[str, str] = {
    "op13_phrases": _phrases_sql(phrases.PhraseConfig()),
    "op11_line_rules": _line_rules_sql(line_rules.LineRulesConfig()),
    "op8_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
        e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS esc,
                     regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS r FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
               CAST(sum(length(esc) + length(r) + {len(chat.START) + len(chat.END) + 2}) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op9_mixing": _mixing_sql(mixing.MixConfig()),
    "op10_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm FROM documents),
        g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)""",
    "op5_decontamination": r"""
        WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws FROM documents),
        i AS (SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws FROM benchmark),
        win AS (SELECT item_id, least(len(ws), 10) AS n, unnest([array_to_string(ws[k:k + least(len(ws), 10) - 1], ' ') FOR k IN range(1, greatest(1, len(ws) - 9) + 1)]) AS g
                FROM i WHERE len(ws) > 0),
        sizes AS (SELECT DISTINCT n FROM win),
        grams AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS p0, unnest([array_to_string(ws[k:k + n - 1], ' ') FOR k IN range(1, len(ws) - n + 2)]) AS g
                  FROM w, sizes WHERE len(ws) >= n),
        hits AS (SELECT doc_id, item_id, p0, grams.n FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
        pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + n)) AS p FROM hits) GROUP BY doc_id),
        ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)""",
}
