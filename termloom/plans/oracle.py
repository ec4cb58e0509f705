"""The registered queries in SQL, written independently of the Spark expressions.

The token pattern here covers the scripts of the given tables; it has no possessive
repetition, which the SQL engine's matcher neither knows nor needs.
"""

from __future__ import annotations

_RUN = r"[\p{L}\p{M}]+(?:[:.''’·][\p{L}\p{M}]+)*|\p{Nd}+(?:[.,;''’]\p{Nd}+)*"
_PATTERN = rf"_*(?:{_RUN})(?:_+|{_RUN})*"
_NL = "chr(10)"


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_PATTERN}')"


def _unix(text: str) -> str:
    return rf"regexp_replace({text}, '\r\n?', {_NL}, 'g')"


def _lines(text: str) -> str:
    parts = f"string_split({_unix(text)}, {_NL})"
    return f"CASE WHEN ({parts})[-1] = '' THEN ({parts})[:-2] ELSE {parts} END"


def _joined(rows: str) -> str:
    return f"coalesce(array_to_string(list_transform({rows}, lambda z: z || {_NL}), ''), '')"


_PATH = (
    "'/corpus/' || lang || '/' || source || '/' || doc_id || "
    "CASE lang WHEN 'en' THEN '.txt' WHEN 'de' THEN '.c' WHEN 'fr' THEN '.tar.gz' ELSE '' END"
)
_TALK_PATH = "'/talk/' || conv_id || '/' || turn || '.txt'"
_WHOLE = _joined(_lines("text"))
_EXT = (
    "CASE WHEN contains({0}, '.') THEN substr({0}, instr({0}, '.')) END"
)
_NAME = "regexp_extract(path, '([^/]*)/*$', 1)"

_TV = f"""
tok AS (SELECT doc_id, unnest(k) AS term, generate_subscripts(k, 1) - 1 AS pos
        FROM (SELECT doc_id, {_tokens('text')} AS k FROM documents)),
tv AS (SELECT doc_id, term, count(*) AS freq,
              string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
       FROM tok GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tv GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
richest AS (SELECT doc_id FROM tv GROUP BY doc_id ORDER BY count(*) DESC, doc_id LIMIT 1),
raw AS (SELECT doc_id, term, df,
               CAST(CAST(sqrt(CAST(freq AS DOUBLE)) AS FLOAT) AS DOUBLE) AS tf,
               CAST(CAST(ln(CAST(df + 1 AS DOUBLE) / CAST(n + 1 AS DOUBLE)) + CAST(1 AS DOUBLE) AS FLOAT) AS DOUBLE) AS idf
        FROM tv JOIN dfs USING (term), n),
weights AS (SELECT doc_id, term, tf, df, idf, tf * idf AS tfxidf FROM raw)
"""

_VOC = f"""
voc AS (SELECT DISTINCT unnest({_tokens('text')}) AS term FROM documents),
chars AS (SELECT term, ch, count(*) AS c
          FROM (SELECT term, unnest(string_split(term, '')) AS ch FROM voc) GROUP BY term, ch),
norms AS (SELECT term, sqrt(CAST(sum(c * c) AS DOUBLE)) AS norm FROM chars GROUP BY term)
"""


def _similar(queries: str) -> str:
    """CTEs ending in ``sims`` (q, term, sim) for a subquery of query words (q)."""
    return f"""{_VOC},
qs AS ({queries}),
qchars AS (SELECT q, ch, count(*) AS c
           FROM (SELECT q, unnest(string_split(q, '')) AS ch FROM qs) GROUP BY q, ch),
qnorms AS (SELECT q, sqrt(CAST(sum(c * c) AS DOUBLE)) AS norm FROM qchars GROUP BY q),
dots AS (SELECT q, term, sum(a.c * b.c) AS dot
         FROM chars a JOIN qchars b USING (ch) GROUP BY q, term),
sims AS (SELECT b.q, a.term,
                coalesce(CAST(dot AS DOUBLE) / (b.norm * a.norm), CAST(0 AS DOUBLE)) AS sim
         FROM norms a CROSS JOIN qnorms b LEFT JOIN dots d ON d.q = b.q AND d.term = a.term)
"""


_ONE = _similar("SELECT 'weather' AS q")
_MANY = _similar(f"""SELECT event_type AS q FROM events UNION
SELECT * FROM (SELECT term FROM (SELECT DISTINCT doc_id, unnest({_tokens('text')}) AS term FROM documents)
               GROUP BY term ORDER BY count(*) DESC, term LIMIT 300)""")
_SIMILAR_TOP = f"WITH {_ONE} SELECT term, sim FROM sims ORDER BY sim DESC, term LIMIT 20"

_EXISTING = f"SELECT {_PATH} AS path, {_WHOLE} AS contents, lang, source FROM documents"


def _again(version: int, labels: str) -> str:
    text = f"(text || ' v{version}')"
    return f"""
SELECT {_PATH} AS path, {_joined(_lines(text))} AS contents, lang, source, {version} AS version
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels {labels})"""


_NEW = f"""
{_again(2, '')} UNION ALL {_again(3, 'WHERE toxic = 1')}
UNION ALL SELECT {_TALK_PATH} AS path, {_WHOLE} AS contents, NULL AS lang, NULL AS source, 2 AS version
FROM conversations
"""


def _indexed(path: str, text: str, table: str, more: str = "", keywords: str = "NULL AS lang, NULL AS source") -> str:
    return f"""
SELECT path, size AS "sizeKb", CAST(len(k) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct(k)) AS BIGINT) AS n_terms, lang, source{more}
FROM (SELECT {path} AS path, CAST(strlen({text}) AS DOUBLE) AS size, {text} AS text, {keywords},
             {_tokens(text)} AS k FROM {table})
"""


_FIELDS = f""", {_WHOLE} AS contents,
       array_to_string(list_transform(list_sort(list_distinct(k)),
         lambda t: t || ':' || len(list_filter(k, lambda x: x = t))), ' ') AS vector"""


def _parts(more: str) -> tuple[str, str, str]:
    return (
        _indexed(_PATH, "text", "documents", more, "lang, source"),
        _indexed(_TALK_PATH, "text", "conversations", more),
        _indexed("url", "html", "pages", more),
    )


_OF_DOCUMENTS, _OF_TALK, _OF_WEB = _parts("")
_ALL_OF_DOCUMENTS, _ALL_OF_TALK, _ = _parts(_FIELDS)


def _stats(field: str) -> str:
    return (
        f"SELECT '{field}' AS field, count(*) AS \"maxDoc\", count(v) AS \"docCount\", "
        f'count(v) AS "sumTotalTermFreq", count(v) AS "sumDocFreq" '
        f"FROM (SELECT {_PATH if field == 'path' else field} AS v FROM documents)"
    )


_STATS_CONTENTS = f"""
SELECT 'contents' AS field, (SELECT n FROM n) AS "maxDoc", count(DISTINCT doc_id) AS "docCount",
       CAST(sum(freq) AS BIGINT) AS "sumTotalTermFreq", count(*) AS "sumDocFreq" FROM tv
"""


def _best(order: str) -> str:
    return f"""WITH {_TV}
SELECT term, tf, df, idf, tfxidf FROM weights WHERE doc_id = (SELECT doc_id FROM richest)
ORDER BY {order} LIMIT 25"""


def _best_of_all(order: str) -> str:
    return f"""
WITH {_TV}
SELECT doc_id, rank, term, tf, df, idf, tfxidf FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {order}) AS rank FROM weights)
WHERE rank <= 5"""


_WEIGHT = {"bin": "CAST(1 AS DOUBLE)", "tf": "tf", "tfxidf": "tfxidf"}


def _by_documents(rep: str) -> str:
    return f"""
WITH {_TV},
asked AS (SELECT term FROM dfs ORDER BY df DESC, term LIMIT 300),
w AS (SELECT term, doc_id, {_WEIGHT[rep]} AS weight FROM weights),
norms AS (SELECT term, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY term),
dots AS (SELECT a.term AS q, b.term, sum(a.weight * b.weight) AS dot
         FROM w a JOIN asked USING (term) JOIN w b ON a.doc_id = b.doc_id GROUP BY a.term, b.term),
sims AS (SELECT q, d.term, CASE WHEN n.norm * m.norm = 0 THEN 0 ELSE round(dot / (n.norm * m.norm), 9) END AS sim
         FROM dots d JOIN norms n ON n.term = d.term JOIN norms m ON m.term = d.q)
SELECT q, rank, term, sim FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, term) AS rank FROM sims)
WHERE rank <= 20"""


ORACLE: dict[str, str] = {
    "corpus_scan": f"""
SELECT {_PATH} AS path, {_WHOLE} AS contents,
       CAST(strlen(text) AS DOUBLE) AS "sizeKb" FROM documents""",
    "file_extension": f"""
WITH paths AS (SELECT {_PATH} AS path FROM documents UNION ALL SELECT url FROM pages)
SELECT path, {_EXT.format('name')} AS ext FROM (SELECT path, {_NAME} AS name FROM paths)""",
    "extension_filter": f"""
WITH paths AS (SELECT {_PATH} AS path, CAST(strlen(text) AS DOUBLE) AS "sizeKb" FROM documents)
SELECT path, "sizeKb" FROM (SELECT path, "sizeKb", {_NAME} AS name FROM paths)
WHERE {_EXT.format('name')} IN ('.txt', '.c')""",
    "whole_content": f"SELECT doc_id, {_WHOLE} AS contents FROM documents",
    "top_lines": f"SELECT doc_id, {_joined('l[1:3]')} AS contents FROM (SELECT doc_id, {_lines('text')} AS l FROM documents)",
    "bottom_lines": f"""
SELECT doc_id, {_joined('list_reverse(l)[1:2]')} AS contents
FROM (SELECT doc_id, {_lines('text')} AS l FROM documents)""",
    "top_bottom_lines": f"""
SELECT doc_id, {_joined('list_concat(l[1:3], list_reverse(l[4:])[1:2])')} AS contents
FROM (SELECT doc_id, {_lines('text')} AS l FROM documents)""",
    "scan_lines": f"""
SELECT {_PATH} AS path, {_joined('list_concat(l[1:3], list_reverse(l[4:])[1:2])')} AS contents
FROM (SELECT doc_id, lang, source, {_lines('text')} AS l FROM documents)""",
    "file_size": """
SELECT doc_id, CAST(strlen(text) AS DOUBLE) AS "sizeKb" FROM documents""",
    "minute_stamp": "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS stamp FROM events",
    "iso_stamp": r"""
SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z' AS stamp
FROM events""",
    "tokenize": f"""
SELECT doc_id, CAST(generate_subscripts(k, 1) - 1 AS BIGINT) AS pos, unnest(k) AS term
FROM (SELECT doc_id, {_tokens('text')} AS k FROM documents)""",
    "term_vectors": f"WITH {_TV} SELECT 'contents' AS field, doc_id, term, freq, positions FROM tv",
    "keyword_terms": f"""
SELECT 'path' AS field, doc_id, {_PATH} AS term, CAST(1 AS BIGINT) AS freq FROM documents
UNION ALL SELECT 'lang', doc_id, lang, 1 FROM documents WHERE lang IS NOT NULL
UNION ALL SELECT 'source', doc_id, source, 1 FROM documents WHERE source IS NOT NULL""",
    "vocabulary": f"SELECT DISTINCT unnest({_tokens('text')}) AS term FROM documents",
    "doc_freq": f"""
WITH {_TV}
SELECT 'contents' AS field, term, df FROM dfs
UNION ALL SELECT 'path', {_PATH} AS term, count(*) FROM documents GROUP BY term
UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""",
    "add_documents": f"{_EXISTING} UNION ALL SELECT path, contents, lang, source FROM ({_NEW})",
    "upsert_documents": f"""
WITH existing AS ({_EXISTING}), new AS ({_NEW})
SELECT path, contents, lang, source FROM existing ANTI JOIN new USING (path)
UNION ALL SELECT path, contents, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY version DESC) AS place FROM new) WHERE place = 1""",
    "write_mode_create": _ALL_OF_DOCUMENTS,
    "write_mode_append": f"{_ALL_OF_DOCUMENTS} UNION ALL {_ALL_OF_TALK}",
    "merge_partials": f"{_OF_DOCUMENTS} UNION ALL {_OF_TALK} UNION ALL {_OF_WEB}",
    "merge_indexes": f"{_OF_DOCUMENTS} UNION ALL {_OF_TALK} UNION ALL {_OF_WEB}",
    "list_fields": f"""
WITH met AS (
  SELECT doc_id, 0 AS place, 'path' AS field FROM documents WHERE {_PATH} IS NOT NULL
  UNION ALL SELECT doc_id, 1, 'contents' FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 2, 'lang' FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT doc_id, 3, 'source' FROM documents WHERE source IS NOT NULL)
SELECT row_number() OVER (ORDER BY doc, place) AS ord, field
FROM (SELECT field, place, min(doc_id) AS doc FROM met GROUP BY field, place)""",
    "field_stats": f"WITH {_TV} {_STATS_CONTENTS}",
    "field_stats_all": f"""
WITH {_TV} {_STATS_CONTENTS}
UNION ALL {_stats('path')} UNION ALL {_stats('lang')} UNION ALL {_stats('source')}""",
    "corpus_size": "SELECT count(*) AS n_docs FROM documents",
    "doc_terms": f"""
WITH {_TV} SELECT doc_id, term, freq, positions FROM tv WHERE doc_id = (SELECT doc_id FROM richest)""",
    "term_weights": f"WITH {_TV} SELECT doc_id, term, tf, df, idf, tfxidf FROM weights",
    "best_terms_tf": _best("tf DESC, term"),
    "best_terms_df": _best("df DESC, tf DESC, term"),
    "best_terms_tfidf": _best("tfxidf DESC, df DESC, tf DESC, term"),
    "best_terms_all_docs": _best_of_all("tfxidf DESC, df DESC, tf DESC, term"),
    "best_terms_all_docs_tf": _best_of_all("tf DESC, term"),
    "best_terms_all_docs_df": _best_of_all("df DESC, tf DESC, term"),
    "char_vectors": f"WITH {_VOC} SELECT term, ch, c FROM chars",
    "char_norms": f"WITH {_VOC} SELECT term, norm FROM norms",
    "char_cosine": f"WITH {_ONE} SELECT term, sim FROM sims",
    "similar_terms": _SIMILAR_TOP,
    "term_clusters_as_is": _SIMILAR_TOP,
    "similar_terms_batch": f"""
WITH {_MANY}
SELECT q, rank, term, sim FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, term) AS rank FROM sims)
WHERE rank <= 20""",
    **{
        f"term_doc_vectors_{rep}": f"WITH {_TV} SELECT term, doc_id, {weight} AS weight FROM weights"
        for rep, weight in _WEIGHT.items()
    },
    "similar_by_documents": _by_documents("tfxidf"),
    "similar_by_documents_bin": _by_documents("bin"),
    "similar_by_documents_tf": _by_documents("tf"),
}
