"""The operators as registered queries over whole tables, beside their DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    conversation_repair,
    decontamination,
    embedding_dedup,
    exact_dedup,
    language_id,
    line_dedup,
    lm_scoring,
    minhash_dedup,
    mixing,
    packing,
    substring_dedup,
    vector_codes,
    warc,
)
from panelspark.llm.common import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, threshold=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), span=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document by hash counts as history, the others are looked up in its index."""
    docs = table(spark, sf_dir, "documents")
    history = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    found = exact_dedup.exact_dedup(docs, history)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = language_id.train(docs.filter(~held_out))
    return language_id.predict(docs, model, "text", "doc_id", held_out.alias("held_out"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.round_trip(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(rows, conversation_repair.damaged(rows))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_mix": op8_mix,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_warc": op10_warc,
    "op11_decontamination": op11_decontamination,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
}


def _codes_sql(rounds: int = 4) -> str:
    """The rounds written out: books b0, b1, ... and the nearest entries n0, n1, ... under each."""
    steps = [
        r"""WITH v AS MATERIALIZED (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS k,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (
            SELECT k, part, e[part * (len(e) // 4) + 1 : (part + 1) * (len(e) // 4)] AS x
            FROM v, range(4) AS r(part)),
        b0 AS MATERIALIZED (SELECT part, k - 1 AS entry, x AS c FROM p WHERE k <= 256)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
        n{r} AS MATERIALIZED (
            SELECT k, part, any_value(x) AS x,
                   min({{'d': (list_dot_product(x, x) + list_dot_product(c, c) - 2 * list_dot_product(x, c))::BIGINT,
                         'entry': entry}}) AS m
            FROM p JOIN b{r} USING (part) GROUP BY k, part)""")
        if r < rounds:
            steps.append(f"""
        b{r + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(moved, c) AS c FROM b{r} LEFT JOIN (
                SELECT part, entry, list(mean ORDER BY i) AS moved FROM (
                    SELECT part, m.entry AS entry, i, sum(x[i]::HUGEINT) AS s, count(*)::HUGEINT AS n,
                           ((s - (s % n + n) % n) // n)::DOUBLE AS mean
                    FROM n{r}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY part, m.entry, i)
                GROUP BY part, entry) USING (part, entry))""")
    steps.append(f"""
        e AS (SELECT k, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error
              FROM n{rounds} GROUP BY k),
        h AS (SELECT sha256(string_agg(array_to_string(c::BIGINT[], ','), ',' ORDER BY part, entry)) AS codebooks_sha256
              FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM v JOIN e USING (k), h""")
    return ",".join(steps[:-1]) + "," + steps[-1]


SQL = {
    "op1_minhash_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN
                   list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                   WHEN len(w) = 1 THEN [w[1]] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach(node, to_id) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.to_id = links.a),
        comp AS (SELECT node, min(to_id) AS component_id FROM reach GROUP BY node)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN comp ON comp.node = d.doc_id LEFT JOIN n USING (doc_id)""",
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
        h AS (SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS passage FROM s),
        r AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY passage) > 1),
        gone AS (SELECT doc_id, list(DISTINCT j) AS gone
                 FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM r) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                      ELSE array_to_string(list_filter(w, lambda x, j: NOT list_contains(gone, j)), ' ') END) AS kept_sha256
        FROM d LEFT JOIN gone USING (doc_id)""",
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_mix": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, md5('mix:' || doc_id) AS rkey,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ([3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
            FROM d GROUP BY source),
        fill AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap,
                   (1.5::DOUBLE * sum(source_size) OVER ()
                    - coalesce(sum(2.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST)),
        t AS (
            SELECT source, source_size, CASE WHEN cap <= w * level THEN cap
                   ELSE w * max(CASE WHEN cap > w * level THEN level END) OVER () END AS target
            FROM fill),
        r AS (
            SELECT d.doc_id, d.size, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS passes,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY d.rkey, d.doc_id
                                     ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (passes * size + least(size, greatest(0, floor(target - passes * source_size)::BIGINT - before)))::BIGINT
                   AS taken
        FROM r""",
    "op9_line_dedup": r"""
        WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS tag, text IS NULL AS is_null,
                          string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        p AS (SELECT doc_id, tag, lines, list_filter(range(1, len(lines) + 1),
                     lambda i: regexp_matches(lines[i], '[^\x20\x09-\x0D]')) AS p FROM d),
        h AS (SELECT *, list_transform(p, lambda i: ('0x' || substr(md5(lines[i]), 1, 8))::BIGINT) AS h FROM p),
        b AS (SELECT doc_id, tag, lines, list_transform(list_filter(range(1, len(p) + 1), lambda j:
                     j = 1 OR j = len(p) OR (h[j] * 31 + h[j + 1]) % 3 < 2), lambda j: p[j]) AS b FROM h),
        c AS (SELECT doc_id, tag, lines, unnest(list_transform(range(1, len(b)), lambda k: {'start': b[k], 'stop': b[k + 1],
                     'low': coalesce(b[k - 1], b[k]), 'high': coalesce(b[k + 2], b[k + 1])})) AS c FROM b),
        t AS (SELECT doc_id, tag, c.start AS start, c.stop AS stop, array_to_string(lines[c.start : c.stop], chr(10)) AS chunk,
                     lines[c.low : c.start - 1] AS l, lines[c.stop + 1 : c.high] AS r FROM c),
        o AS (SELECT *, rank() OVER (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, tag, start) AS nth FROM t),
        g AS (SELECT o.*, f.l AS fl, f.r AS fr, least(len(o.l), len(f.l)) AS nl, least(len(o.r), len(f.r)) AS nr
              FROM o JOIN (SELECT DISTINCT chunk, l, r FROM o WHERE nth = 1) f USING (chunk) WHERE nth > 1),
        e AS (SELECT doc_id, tag,
                     start - coalesce(list_min(list_filter(range(1, nl + 1), lambda k: l[len(l) + 1 - k] <> fl[len(fl) + 1 - k])) - 1, nl)
                         AS start,
                     stop + coalesce(list_min(list_filter(range(1, nr + 1), lambda k: r[k] <> fr[k])) - 1, nr) AS stop
              FROM g),
        gone AS (SELECT DISTINCT doc_id, tag, unnest(range(start, stop + 1)) AS i FROM e),
        line AS (SELECT doc_id, tag, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
        kept AS (SELECT line.doc_id, line.tag, count(*) AS n_lines, count(gone.i) AS n_removed,
                        coalesce(string_agg(line, chr(10) ORDER BY line.i) FILTER (gone.i IS NULL), '') AS kept
                 FROM line LEFT JOIN gone ON line.doc_id IS NOT DISTINCT FROM gone.doc_id AND line.tag = gone.tag AND line.i = gone.i
                 GROUP BY line.doc_id, line.tag)
        SELECT d.doc_id, n_lines, n_removed, CASE WHEN is_null THEN NULL ELSE sha256(kept) END AS kept_sha256
        FROM d JOIN kept ON d.doc_id IS NOT DISTINCT FROM kept.doc_id AND d.tag = kept.tag""",
    "op6_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e,
                   sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm
            FROM embeddings),
        ok AS (SELECT * FROM v WHERE label IS NOT NULL AND norm > 0 AND isfinite(norm)
                                     AND len(list_filter(e, lambda x: x IS NULL)) = 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
        reach(node, to_id) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.to_id = links.a),
        comp AS (SELECT node, min(to_id) AS component_id FROM reach GROUP BY node),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN comp ON comp.node = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id""",
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest FROM pages),
        h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS head FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < head THEN head END AS refers_to
        FROM h""",
    "op11_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS passage
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        widths AS (SELECT DISTINCT k FROM win),
        runs AS (
            SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS passage
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, widths WHERE len(w) >= k)),
        hits AS (SELECT doc_id, k, i, item_id FROM runs JOIN win USING (k, passage)),
        words AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n_hit
                  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op12_conversation_repair": r"""
        WITH RECURSIVE raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        way AS (
            SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT),
                   lambda crc, byte: list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte)),
                   4294967295), 4294967295) % 20 AS way FROM raw),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
                   CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM way),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i
            FROM hurt),
        facts AS (
            SELECT *, left(role, 1) AS ini,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed),
        lists AS (SELECT conv_id, list({'ini': ini, 'fault': fault} ORDER BY i) AS f FROM facts GROUP BY conv_id),
        dp AS (
            SELECT conv_id, f, 0 AS i, [{'c': 0::BIGINT, 'a': ''}, NULL, NULL, NULL] AS s FROM lists
            UNION ALL
            SELECT conv_id, f, i + 1, [
                list_min([{'c': z[1].c + 4, 'a': z[1].a || 'D'}]),
                list_min([CASE WHEN z[2] IS NOT NULL THEN {'c': z[2].c + 4, 'a': z[2].a || 'D'} END,
                          CASE WHEN ok AND ini = 's' AND z[1] IS NOT NULL THEN {'c': z[1].c + t, 'a': z[1].a || 'K'} END]),
                list_min(list_concat([CASE WHEN z[3] IS NOT NULL THEN {'c': z[3].c + 4, 'a': z[3].a || 'D'} END],
                    CASE WHEN ok THEN list_transform(list_filter([z[1], z[2], z[4]], lambda x: x IS NOT NULL),
                         lambda x: CASE WHEN ini = 'u' THEN {'c': x.c + t, 'a': x.a || 'K'}
                                        ELSE {'c': x.c + t + 3, 'a': x.a || 'R'} END) ELSE [] END)),
                list_min([CASE WHEN z[4] IS NOT NULL THEN {'c': z[4].c + 4, 'a': z[4].a || 'D'} END,
                          CASE WHEN ok AND z[3] IS NOT NULL THEN CASE WHEN ini = 'a'
                               THEN {'c': z[3].c + t, 'a': z[3].a || 'K'} ELSE {'c': z[3].c + t + 3, 'a': z[3].a || 'R'} END END])]
            FROM (SELECT conv_id, f, i, f[i + 1].ini AS ini, f[i + 1].fault IN (0, 3) AS ok,
                         CASE WHEN f[i + 1].fault = 3 THEN 3 ELSE 0 END AS t, [s[1], s[2],
                    list_min(list_concat([s[3]], list_transform(list_filter([s[1], s[2], s[4]], lambda x: x IS NOT NULL),
                        lambda x: {'c': x.c + 3, 'a': x.a || 'I'}))),
                    list_min(list_concat([s[4]], [CASE WHEN s[3] IS NOT NULL THEN {'c': s[3].c + 3, 'a': s[3].a || 'I'} END],
                        list_transform(list_filter([s[1], s[2]], lambda x: x IS NOT NULL),
                        lambda x: {'c': x.c + 6, 'a': x.a || 'II'})))] AS z
                  FROM dp WHERE i < len(f))),
        best AS (
            SELECT conv_id, list_min([s[1], s[4], CASE WHEN s[3] IS NOT NULL THEN {'c': s[3].c + 3, 'a': s[3].a || 'I'} END,
                       CASE WHEN s[2] IS NOT NULL THEN {'c': s[2].c + 6, 'a': s[2].a || 'II'} END]) AS m
            FROM dp WHERE i = len(f)),
        edits AS (
            SELECT conv_id, unnest(string_split(m.a, '')) AS e, unnest(range(1, len(m.a) + 1)) AS pos,
                   (len(m.a) - len(replace(m.a, 'D', ''))) AS deleted, len(m.a) AS n FROM best WHERE m.a <> ''),
        steps AS (
            SELECT *, sum((e <> 'I')::INT) OVER o AS i, sum((e <> 'D')::INT) OVER o AS j, (n - deleted) % 2 AS has_s
            FROM edits WINDOW o AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
        fixed AS (
            SELECT s.conv_id, string_agg(CASE WHEN e = 'K' THEN f.role
                       ELSE CASE WHEN (j - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                       || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY pos) AS repaired
            FROM steps s LEFT JOIN facts f ON e <> 'I' AND f.i = s.i AND f.conv_id IS NOT DISTINCT FROM s.conv_id
            WHERE e <> 'D' GROUP BY s.conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (i > 1 AND left(before, 1) || '|' || ini NOT IN ('s|u', 'u|a', 'a|u')) AS illegal
            FROM facts GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(m.c, 0)::BIGINT AS cost, coalesce(m.a, '') AS audit,
               sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN fixed x ON x.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_vector_codes": _codes_sql(),
}
