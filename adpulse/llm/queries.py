"""The registered query of each operator, with production parameters over the
whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm import (bpe, conversations, exact_dedup, line_dedup, mixing, piece_bpe, quality_model, quality_rules, sharding, simhash, spelling, substring,
                         toxicity)
from adpulse.llm.common import documents, stored

SHARDS = 24


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffle_into_shards(documents(spark, sf_dir), SHARDS)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return toxicity.toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def vocabulary() -> tuple[bytes, str]:
    """Content of the public vocabulary file and the pattern of its pieces."""
    import public_tokenizers
    return bpe.read_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    content, pattern = vocabulary()
    encoded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), content, pattern)
    decoded = bpe.decode(stored(encoded.select("doc_id", "ids", "n_tokens"), "tokens"), content, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return simhash.near_duplicates(docs, carry=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model, _ = quality_model.fit(docs)
    return quality_model.quality(docs, model).select("doc_id", "score", "kept")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring.remove_repeats(docs, carry=["doc_id"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), carry=["doc_id"])
    return judged.select("doc_id", "n_lines", "n_exact", "n_near", F.array_join("removed_lines", ",").alias("removed_lines"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.damaged_words(documents(spark, sf_dir).select("doc_id", "text")))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = piece_bpe.read_file(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = piece_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), model)
    decoded = piece_bpe.decode(stored(encoded.select("doc_id", "ids", "n_tokens"), "pieces"), model)
    return decoded.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return conversations.repair(conversations.damaged(table), ids=table).conversations


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_quality_model": op7_quality_model,
    "op8_substring": op8_substring,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling": op11_spelling,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL = {
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op6_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(concat_ws('|', '23', coalesce(CAST(doc_id AS VARCHAR), '-'), md5(coalesce(text, '')))) AS key
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place,
                     sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total, (source_size * 2)::DOUBLE AS lim FROM s),
        w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][place % 3 + 1] AS weight FROM p),
        r AS (SELECT *, lim / weight AS ratio FROM w),
        l AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
                     / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
        t AS (SELECT source, source_size, least(lim, max(CASE WHEN lev <= ratio THEN lev END) OVER () * weight) AS target FROM l),
        b AS (SELECT source, source_size, target, round(target)::BIGINT AS budget,
                     CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
        x AS (SELECT d.*, b.* EXCLUDE (source),
                     coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
              FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
        FROM x""",
    "op8_substring": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS seq
              FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM d)),
        f AS (SELECT seq, min(doc_id) AS first FROM w GROUP BY seq),
        gone AS (SELECT DISTINCT w.doc_id, pos + k AS pos FROM w JOIN f USING (seq), range(13) r(k) WHERE w.doc_id > f.first),
        p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
        k AS (SELECT p.doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY p.pos) FILTER (gone.pos IS NULL) AS kept
              FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.pos = p.pos GROUP BY p.doc_id)
        SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op10_line_dedup": r"""
        WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS no FROM t),
        l AS (SELECT doc_id, no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
                     row_number() OVER (ORDER BY doc_id, no) AS place FROM u),
        s AS (SELECT *, array_to_string(words, ' ') AS seq FROM l WHERE len(words) > 0),
        d AS (SELECT seq, min(place) AS place, any_value(words) AS words FROM s GROUP BY seq),
        v AS (SELECT seq, place, i, array_to_string(list_concat(words[:i], words[i + 2:]), ' ') AS rest
              FROM (SELECT *, unnest(range(len(words))) AS i FROM d WHERE len(words) >= 8)
              UNION ALL SELECT seq, place, -1, seq FROM d WHERE len(words) >= 8),
        m AS (SELECT rest, i, min(place) AS least FROM v GROUP BY rest, i),
        near AS (SELECT DISTINCT v.seq FROM v JOIN m ON v.rest = m.rest AND (v.i = m.i OR v.i = -1 OR m.i = -1) WHERE m.least < v.place),
        j AS (SELECT s.doc_id, s.no, s.place > d.place AS again, near.seq IS NOT NULL AS near
              FROM s JOIN d USING (seq) LEFT JOIN near USING (seq))
        SELECT t.doc_id, count(j.no) AS n_lines, count(*) FILTER (again) AS n_exact, count(*) FILTER (near AND NOT again) AS n_near,
               coalesce(string_agg(CAST(j.no AS VARCHAR), ',' ORDER BY j.no) FILTER (again OR near), '') AS removed_lines
        FROM t LEFT JOIN j USING (doc_id) GROUP BY t.doc_id""",
    "op11_spelling": r"""
        WITH RECURSIVE polynomial AS (
          SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
        u AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                     unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{6,}')) AS run FROM documents),
        r AS (SELECT id, run, count(*) AS times FROM u GROUP BY ALL),
        b AS (SELECT run, times, list_transform(regexp_extract_all(hex(concat(id, ':', run)), '..'), lambda x: CAST(concat('0x', x) AS BIGINT)) AS bytes FROM r),
        h AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, c: xor(a >> 8, tab[(xor(a, c) & 255) + 1])), 4294967295) AS h
              FROM b, polynomial),
        w AS (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS BIGINT)), substr(run, CAST(h % length(run) AS BIGINT) + 2)) ELSE run END AS word, times FROM h),
        v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
        s AS (SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
        p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM s a JOIN s b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
              UNION SELECT s.word, v.word, v.n FROM s JOIN v ON s.rest = v.word
              UNION SELECT v.word, s.word, s.n FROM s JOIN v ON s.rest = v.word),
        q AS (SELECT word, count(DISTINCT other) AS n_near, min({'m': -other_n, 'w': other}) AS best FROM p GROUP BY word),
        f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * v.n THEN best.w END AS form,
                     CASE WHEN -best.m >= 5 * v.n THEN -best.m END AS form_n FROM v LEFT JOIN q ON v.word = q.word),
        t(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, t.root FROM t JOIN f ON f.form = t.word)
        SELECT f.word, f.form, t.root, f.n, n_near, form_n FROM f JOIN t ON f.word = t.word""",
    "op13_conversations": r"""
        WITH RECURSIVE polynomial AS (
          SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
        c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''),
                                    lambda x: CAST(ascii(x) AS BIGINT)) AS bytes FROM conversations),
        k AS (SELECT conv_id, turn, role, text,
                     xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
              FROM c, polynomial),
        d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                     CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
              FROM k WHERE kind <> 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM d),
        o AS (SELECT *, row_number() OVER w AS place, lag(role) OVER w AS role_before
              FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)),
        f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                             WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault FROM o),
        s AS (SELECT *, left(role, 1) AS initial, fault IS NOT NULL AND fault <> 'truncated' AS gone,
                     CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM f),
        best(conv_id, place, q, l) AS (
          SELECT conv_id, 0::BIGINT, q, {'c': c, 'a': a, 'k': k}
          FROM (SELECT DISTINCT conv_id FROM s), (VALUES ('', 0, '', ''), ('u', 5, 'I', 'u'), ('a', 10, 'II', 'ua')) v(q, c, a, k)
          UNION ALL
          SELECT conv_id, place, q, min(l) FROM (
            SELECT conv_id, place, CASE ins WHEN 0 THEN q WHEN 1 THEN nxt ELSE CASE WHEN nxt = 'u' THEN 'a' ELSE 'u' END END AS q,
                   {'c': c + 5 * ins, 'a': concat(a, repeat('I', ins)),
                    'k': concat(k, CASE ins WHEN 0 THEN '' WHEN 1 THEN nxt ELSE concat(nxt, CASE WHEN nxt = 'u' THEN 'a' ELSE 'u' END) END)} AS l
            FROM (
              SELECT *, CASE WHEN q = 'u' THEN 'a' ELSE 'u' END AS nxt FROM (
                SELECT b.conv_id, s.place, e.letter, CASE e.letter WHEN 'D' THEN b.q WHEN 'K' THEN s.initial ELSE CASE WHEN b.q = 'u' THEN 'a' ELSE 'u' END END AS q,
                       b.l.c + CASE e.letter WHEN 'D' THEN 2 WHEN 'K' THEN s.extra ELSE 1 + s.extra END AS c, concat(b.l.a, e.letter) AS a,
                       concat(b.l.k, CASE e.letter WHEN 'R' THEN CASE WHEN b.q = 'u' THEN 'A' ELSE 'U' END ELSE e.letter END) AS k
                FROM best b JOIN s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.place = b.place + 1, (VALUES ('D'), ('K'), ('R')) e(letter)
                WHERE e.letter = 'D' OR NOT s.gone AND (e.letter = 'R' OR s.initial = CASE WHEN b.q = 'u' THEN 'a' ELSE 'u' END OR b.q = '' AND s.initial = 's'))
              ), range(3) r(ins))
          GROUP BY conv_id, place, q),
        ends AS (SELECT conv_id, max(place) AS place FROM s GROUP BY conv_id),
        won AS (SELECT b.conv_id, min(b.l) AS l FROM best b JOIN ends e ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND b.place = e.place
                WHERE b.q IN ('', 'a') GROUP BY b.conv_id),
        acts AS (SELECT conv_id, unnest(x) AS act, generate_subscripts(x, 1) AS place
                 FROM (SELECT conv_id, regexp_extract_all(l.k, '[ua]*[KUAD]|[ua]+$') AS x FROM won)),
        lines AS (SELECT a.conv_id, a.place, generate_subscripts(string_split(act, ''), 1) AS part, unnest(string_split(act, '')) AS m, s.role, s.text
                  FROM acts a LEFT JOIN s ON a.conv_id IS NOT DISTINCT FROM s.conv_id AND a.place = s.place),
        said AS (SELECT conv_id, string_agg(CASE m WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' WHEN 'U' THEN concat('user:', text)
                                                  WHEN 'A' THEN concat('assistant:', text) ELSE concat(role, ':', text) END, chr(10) ORDER BY place, part) AS said
                 FROM lines WHERE m <> 'D' GROUP BY conv_id),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                          count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                          count(*) FILTER (role_before IS NOT NULL AND concat(left(role_before, 1), initial) NOT IN ('su', 'ua', 'au')) AS illegal
                   FROM s GROUP BY conv_id)
        SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(w.l.c, 0)::BIGINT AS cost, coalesce(w.l.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) i
        LEFT JOIN counts t ON i.conv_id IS NOT DISTINCT FROM t.conv_id
        LEFT JOIN won w ON i.conv_id IS NOT DISTINCT FROM w.conv_id
        LEFT JOIN said z ON i.conv_id IS NOT DISTINCT FROM z.conv_id""",
}
