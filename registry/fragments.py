"""How the given tables stand in for the pipeline's inputs: SQL that Spark and DuckDB both run.

Every fragment reads whole tables. The modulo terms only vary the shape of values (leading zeros, missing cells, kinds
of reply); they filter nothing.
"""

# part as the target file: codes in many spellings, cells that stand for missing values, stray white space.
RAW_TARGETS = """
SELECT CASE p_size % 6 WHEN 0 THEN concat('00', p_partkey) WHEN 1 THEN concat(p_partkey, '.0')
            WHEN 2 THEN concat(p_partkey, '.', p_size % 10) WHEN 3 THEN concat(p_partkey, '.50')
            WHEN 4 THEN concat('x', p_partkey) ELSE concat('  ', p_partkey, chr(9)) END AS target_code,
       concat(chr(9), ' ', p_name, ' ', chr(10)) AS target_name,
       CASE WHEN p_size % 7 = 0 THEN 'NA' ELSE p_type END AS target_category,
       p_partkey AS target_id
FROM part
"""

# documents as the candidate file.
RAW_CANDIDATES = """
SELECT concat('acc', doc_id) AS accession,
       concat('Item ', lang, CASE doc_id % 4 WHEN 0 THEN '_Visit_2' WHEN 1 THEN 'v3' WHEN 2 THEN '_yr_1'
              ELSE '' END) AS name,
       text AS description,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat(' text', chr(10)) END AS type,
       concat('ds-', source) AS dataset_accession,
       CASE WHEN doc_id % 7 = 0 THEN 'None' ELSE lang END AS dataset_name,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS study,
       CASE WHEN doc_id % 11 = 0 THEN 'n/a' ELSE lang END AS "database",
       doc_id AS cand_id
FROM documents
"""

# documents as stage-one rows: one target per source, scores and ranks as text, some of them missing.
RAW_PAIRS = """
SELECT CASE WHEN doc_id % 97 = 0 THEN NULL
            ELSE concat(substr(source, 4), CASE WHEN doc_id % 2 = 0 THEN '.0' ELSE '' END) END AS target_code,
       concat('topic ', source) AS target_name,
       lang AS target_category,
       concat('acc', doc_id) AS accession,
       concat('Item ', lang, CASE doc_id % 4 WHEN 0 THEN '_Visit_2' WHEN 1 THEN 'v3' WHEN 2 THEN '_yr_1'
              ELSE '' END) AS name,
       text AS description,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'text' END AS type,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS study,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS dataset_name,
       CASE WHEN doc_id % 13 = 0 THEN 'none'
            ELSE CAST(((doc_id * 7919) % 10007) / 10007e0 AS STRING) END AS score,
       CAST(doc_id % 1000 + 1 AS STRING) AS target_rank,
       CASE WHEN doc_id % 17 = 0 THEN '0' ELSE '1' END AS passed,
       'kept' AS pass_label
FROM documents
"""

# What the stand-in classifier says about a row, from the given labels. Spellings vary on purpose.
ANSWER_RELATION = """
CASE WHEN quality IS NULL THEN 'who knows' WHEN toxic = 1 THEN 'unrelated' WHEN quality = 0 THEN 'clinically_relevant'
     WHEN doc_id % 3 = 0 THEN 'exact_same' ELSE ' Directly_Related ' END
"""
ANSWER_CATEGORY = """
CASE doc_id % 15 WHEN 0 THEN 'diagnosis' WHEN 1 THEN 'lab' WHEN 2 THEN 'medication' WHEN 3 THEN 'procedure'
     WHEN 4 THEN 'vital' WHEN 5 THEN 'imaging' WHEN 6 THEN 'symptom' WHEN 7 THEN 'lifestyle' WHEN 8 THEN 'survey'
     WHEN 9 THEN 'demographic' WHEN 10 THEN 'administrative' WHEN 11 THEN 'other' WHEN 12 THEN 'unrelated'
     WHEN 13 THEN ' LAB' ELSE 'nonsense' END
"""
# Eight kinds of reply, by batch: plain, fenced, with chatter, cut off, empty list, bare array, null, one row missing.
REPLY_KIND = "(CAST(floor(CAST(target_code AS DOUBLE)) AS BIGINT) * 3 + batch_no) % 8"
