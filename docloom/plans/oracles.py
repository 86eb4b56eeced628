"""SQL twins of the workload's queries, for an independent engine on the same tables.

Shared steps are named relations; ``sql`` puts the ones a query needs in front
of it. Rules and lexicons come from the stand-in module as values only.
"""

from __future__ import annotations

import re

from docloom.functions import vocab as V
from docloom.functions.markup import BLOCKS
from docloom.operators.context import CONTEXT_PREDICATES, HEADINGS, PROMPT
from docloom.plans import standin as D


TABLE_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strings(values) -> str:
    return ", ".join(lit(v) for v in values)


def tokens(text: str) -> str:
    return rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def field(label: str, text: str) -> str:
    rules = D.FIELD_RULES[label]
    return "coalesce(" + ", ".join(f"nullif(trim(regexp_extract({text}, {lit(p)}, {g})), '')" for p, g in rules) + ", NULL)"


def spelled(name: str) -> str:
    return f"array_to_string(list_filter({tokens(name)}, lambda w: w NOT IN ({strings(V.COMPANY_SUFFIXES)})), ' ') || ' '"


def canonical(name: str, aliases: str = "aliases") -> str:
    return f"(SELECT arg_max(a.canonical, length(a.alias)) FROM {aliases} a WHERE starts_with({spelled(name)}, a.alias || ' '))"


def alias_rows(aliases: dict[str, str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({lit(a)}, {lit(c)})" for a, c in aliases.items()) + ") v(alias, canonical)"


def label_of(words: str, labels: list[str], lexicon: dict[str, dict[str, float]], default: str) -> str:
    def score(label: str) -> str:
        cases = " ".join(f"WHEN {lit(w)} THEN {n}" for w, n in lexicon.get(label, {}).items())
        return f"coalesce(list_sum(list_transform({words}, lambda w: CASE w {cases} ELSE 0 END)), 0)" if cases else "0"

    scores = {label: score(label) for label in labels}
    best = "greatest(" + ", ".join(scores.values()) + ")"
    cases = " ".join(f"WHEN {s} = {best} THEN {lit(label)}" for label, s in scores.items())
    return f"CASE WHEN {best} = 0 THEN {lit(default)} {cases} END"


def path(folder: str, name: str) -> str:
    return f"'/corpus/{V.RAW_ROOT}/' || {folder} || '/' || {name} || '.txt'"


DOC_PATH = path("lang", "source || '_' || doc_id")
LINES = "list_filter(string_split({}, chr(10)), lambda l: trim(l) <> '')"
PAD = "CASE WHEN length({0}::VARCHAR) < 3 THEN lpad({0}::VARCHAR, 3, '0') ELSE {0}::VARCHAR END"
WIDE = "rpad({0}, greatest({1}, length({0}))::INTEGER, ' ')"
PRODUCT = "p_name || ' #' || p_partkey"

BLOCK = rf"(?is)<(/?(?:{'|'.join(sorted(BLOCKS, key=lambda n: (-len(n), n)))}))(?:\s[^>]*)?/?>"
READ = r"regexp_replace(regexp_replace(content, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g')"
for _written, _sign in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
    READ = f"replace({READ}, '{_written}', '{_sign}')"

# name -> (needed relations, body)
RELATIONS: dict[str, tuple[str, str]] = {
    "aliases": ("", alias_rows(D.ALIASES)),
    "subject_names": ("", alias_rows(D.SUBJECT_ALIASES)),
    "bronze": ("", f"""
        SELECT {DOC_PATH} AS source_path, text FROM documents
        UNION ALL
        SELECT {path("'Earnings Call'", "role || '_' || conv_id || '-' || turn")}, text FROM conversations"""),
    "parsed": ("bronze", f"""
        SELECT source_path, strlen(text)::BIGINT AS file_size_bytes,
               array_to_string({LINES.format('text')}, chr(10) || chr(10)) AS plain_text
        FROM bronze"""),
    "silver_rows": ("parsed aliases", f"""
        SELECT source_path, file_size_bytes, plain_text,
               {canonical("coalesce(" + field('company', 'plain_text') + ", regexp_extract(source_path, '/([^/_.]+)[^/]*$', 1))")} AS company,
               {field('fiscal_period', 'plain_text')} AS fiscal_period,
               coalesce({field('document_type', 'plain_text')}, nullif(regexp_extract(source_path, '{V.RAW_ROOT}/([^/]+)', 1), '')) AS document_type,
               {field('revenue', 'plain_text')} AS revenue_reported,
               {field('net_income', 'plain_text')} AS net_income_reported
        FROM parsed"""),
    "silver": ("silver_rows", f"SELECT * FROM silver_rows WHERE length(plain_text) > {V.MIN_CONTENT_CHARS}"),
    "gold": ("silver", f"""
        SELECT * EXCLUDE (plain_text, w),
               {label_of('w', V.AI_CATEGORIES, D.CATEGORY_LEXICON, V.NOT_AI)} AS ai_investment_category,
               {label_of('w', V.MANAGEMENT_TONES, D.TONE_LEXICON, V.NEUTRAL_TONE)} AS management_sentiment
        FROM (SELECT *, {tokens('plain_text')} AS w FROM silver)"""),
    "summary": ("gold", """
        SELECT company, fiscal_period, document_type, ai_investment_category, management_sentiment, count(*) AS document_count
        FROM gold GROUP BY ALL"""),
    "lines": ("silver", """
        SELECT source_path, i, l[i] AS content
        FROM (SELECT source_path, string_split(plain_text, chr(10) || chr(10)) AS l FROM silver), unnest(generate_series(1, len(l))) g(i)"""),
    "parts": ("lines", """
        SELECT source_path, part, string_agg(content, chr(10) || chr(10) ORDER BY i) AS chunk_text
        FROM (SELECT *, coalesce(sum(length(content)) OVER (PARTITION BY source_path ORDER BY i
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1200 AS part FROM lines)
        GROUP BY source_path, part"""),
    "chunks": ("parts silver", """
        SELECT source_path || '_chunk' || (row_number() OVER (PARTITION BY source_path ORDER BY part) - 1) AS chunk_id,
               'Page 0' || chr(10) || chunk_text AS chunk_to_embed, chunk_text, source_path, company, fiscal_period, document_type
        FROM parts JOIN silver USING (source_path)"""),
    "elements": ("", r"""
        WITH bare AS (SELECT page_id, regexp_replace(html,
                 '(?is)<script(?:\s[^>]*)?>.*?</script>|<style(?:\s[^>]*)?>.*?</style>|<!--.*?-->', '', 'g') AS html FROM pages),
        found AS (
          SELECT page_id, i AS ord, lower(split_part(p[i], chr(2), 1)) AS tag, split_part(p[i], chr(2), 2) AS content
          FROM (SELECT page_id, string_split(chr(2) || regexp_replace(html, '""" + BLOCK + r"""', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS p FROM bare),
               unnest(generate_series(1, len(p))) g(i))
        SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1)::INTEGER AS element_id,
               CASE WHEN regexp_full_match(tag, 'h[1-6]') THEN 'section_header' WHEN tag = 'title' THEN 'title' WHEN tag = 'li' THEN 'list_item'
                    WHEN tag IN ('td', 'th') THEN 'table_cell' WHEN tag = 'pre' THEN 'preformatted' ELSE 'text' END AS element_type,
               content
        FROM (SELECT page_id, ord, tag, trim(""" + READ + r""", chr(9) || chr(10) || chr(12) || chr(13) || ' ') AS content FROM found) WHERE regexp_matches(content, '\S')"""),
    "sectioned": ("elements", """
        SELECT *, sum((element_type = 'section_header')::INT) OVER (PARTITION BY page_id ORDER BY element_id) AS section FROM elements"""),
    "page_parts": ("sectioned", """
        SELECT page_id, section, part, string_agg(content, chr(10) || chr(10) ORDER BY element_id) AS chunk_text
        FROM (SELECT *, coalesce(sum(length(content)) OVER (PARTITION BY page_id, section ORDER BY element_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 600 AS part FROM sectioned)
        GROUP BY ALL"""),
    "hits": ("silver", " UNION ALL ".join(f"""
        SELECT source_path, company, fiscal_period, {n} AS pat, i, s[i] AS subject, {lit(p)} AS predicate, o[i] AS object,
               {lit(st)} AS subject_type, {lit(ot)} AS object_type, trim(h[i]) AS description
        FROM (SELECT *, regexp_extract_all(plain_text, {lit(rx)}) AS h, regexp_extract_all(plain_text, {lit(rx)}, 1) AS s,
                     regexp_extract_all(plain_text, {lit(rx)}, 2) AS o FROM silver),
             unnest(generate_series(1, len(h))) g(i)""" for n, (p, rx, st, ot) in enumerate(D.TRIPLET_PATTERNS))),
    "ends": ("hits", """
        SELECT source_path, company, fiscal_period, name, entity_type, description, min(ord) AS ord FROM (
          SELECT *, subject AS name, subject_type AS entity_type, pat * 1000000 + i * 2 AS ord FROM hits
          UNION ALL SELECT *, object, object_type, pat * 1000000 + i * 2 + 1 FROM hits)
        GROUP BY ALL"""),
    "text_entities": ("ends", """
        SELECT company, fiscal_period, name AS entity_name, entity_type, description FROM (
          SELECT *, row_number() OVER (PARTITION BY name, entity_type
            ORDER BY company NULLS FIRST, fiscal_period NULLS FIRST, description) AS rn FROM ends) WHERE rn = 1"""),
    "text_relationships": ("hits", """
        SELECT company, fiscal_period, subject, predicate, object, mention_count FROM (
          SELECT *, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY company NULLS FIRST, fiscal_period NULLS FIRST) AS rn,
                 count(*) OVER (PARTITION BY subject, predicate, object) AS mention_count FROM hits) WHERE rn = 1"""),
    "star": ("", f"""
        SELECT n_name AS company, 'FY' || year(l_shipdate) AS fiscal_period, s_name AS subject, 'supplies_to' AS predicate, {PRODUCT} AS object
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
        UNION ALL SELECT c_mktsegment, 'FY' || year(o_orderdate), c_name, 'acquires', {PRODUCT}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
        UNION ALL SELECT 'catalog', 'FY', {PRODUCT}, 'uses_technology', p_brand FROM part
        UNION ALL SELECT 'catalog', 'FY', c_name, 'invests_in', c_mktsegment FROM customer
        UNION ALL SELECT 'catalog', 'FY', s_name, 'partners_with', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT 'catalog', 'FY', n_name, 'partners_with', r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'catalog', 'FY', regexp_extract(url, '^https?://([^/]+)', 1), 'mentions', unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) FROM pages"""),
    "relationships": ("star", """
        SELECT company, fiscal_period, subject, predicate, object, mention_count FROM (
          SELECT *, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY company, fiscal_period) AS rn,
                 count(*) OVER (PARTITION BY subject, predicate, object) AS mention_count FROM star) WHERE rn = 1"""),
    "known": ("", f"""
        SELECT 'catalog' AS company, 'FY' AS fiscal_period, entity_name, entity_type, min(description) AS description FROM (
          SELECT s_name AS entity_name, 'Company' AS entity_type, 'Supplier' AS description FROM supplier
          UNION ALL SELECT c_name, 'Person', CASE WHEN c_acctbal > 5000 THEN 'Chief buyer, ' ELSE 'Buyer, ' END || c_mktsegment FROM customer
          UNION ALL SELECT {PRODUCT}, 'Product', p_type FROM part
          UNION ALL SELECT p_brand, 'Technology', 'Brand, size ' || p_size FROM part
          UNION ALL SELECT p_brand, 'Product', 'Brand range' FROM part
          UNION ALL SELECT c_mktsegment, 'Market', 'Segment' FROM customer
          UNION ALL SELECT n_name, 'Market', 'Nation' FROM nation
          UNION ALL SELECT r_name, 'Market', 'Region' FROM region)
        GROUP BY entity_name, entity_type"""),
    "entities": ("known", f"""
        SELECT company, fiscal_period, entity_name, entity_type, description, entity_type || '_' || {PAD.format('rn')} AS UID
        FROM (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY entity_name) AS rn FROM known)"""),
    "missing": ("relationships entities", """
        SELECT DISTINCT entity_name FROM (SELECT subject AS entity_name FROM relationships UNION ALL SELECT object FROM relationships)
        WHERE entity_name NOT IN (SELECT entity_name FROM entities)"""),
    "backfilled": ("missing", f"""
        SELECT 'Unknown' AS company, 'Unknown' AS fiscal_period, entity_name, 'Unknown' AS entity_type,
               {lit(V.BACKFILL_DESCRIPTION)} AS description, 'Unknown_' || {PAD.format('rn')} AS UID
        FROM (SELECT *, row_number() OVER (ORDER BY entity_name) AS rn FROM missing)"""),
    "all_entities": ("entities backfilled", "SELECT * FROM entities UNION ALL SELECT * FROM backfilled"),
    "nodes": ("all_entities", """
        SELECT entity_name, entity_type, UID FROM (SELECT *, row_number() OVER (PARTITION BY entity_name
          ORDER BY entity_type = 'Unknown', entity_type, UID) AS rn FROM all_entities) WHERE rn = 1"""),
    "edges": ("relationships nodes", """
        SELECT a.UID AS node_start_id, coalesce(a.entity_type, 'entity') AS node_start_key, subject, predicate AS relationship, object,
               b.UID AS node_end_id, coalesce(b.entity_type, 'entity') AS node_end_key,
               to_json({'_label': subject})::VARCHAR AS node_start_properties, to_json({'_label': object})::VARCHAR AS node_end_properties,
               '{}' AS edge_properties
        FROM relationships LEFT JOIN nodes a ON subject = a.entity_name LEFT JOIN nodes b ON object = b.entity_name"""),
    "questions": ("", """
        SELECT item_id AS query_id, text AS question,
               CASE WHEN length(text) > 250 THEN ['NVIDIA Corporation']
                    WHEN length(text) > 200 THEN ['Apple Inc.', 'Meta Platforms, Inc.'] END AS companies
        FROM benchmark"""),
    "qvec": ("questions", "{vectors:questions:query_id:question}"),
    "cvec": ("chunks", "{vectors:chunks:chunk_id:chunk_to_embed}"),
    "all_scores": ("qvec cvec", """
        SELECT q.id AS query_id, c.id AS item_id, round(round(list_cosine_similarity(q.vec, c.vec), 12), 6) AS score FROM qvec q, cvec c"""),
    "by_meaning": ("all_scores", """
        SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM all_scores"""),
    "by_words": ("questions chunks", "{bm25:chunks:chunk_id:chunk_text}"),
    "by_words_documents": ("questions", "{bm25:documents:doc_id:text}"),
    "fused": ("by_meaning by_words", "{fuse:by_meaning:by_words:10}"),
    "calls": ("chunks", "SELECT * FROM chunks WHERE contains(document_type, 'Earnings')"),
    "e_meaning": ("all_scores calls", """
        SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
          SELECT query_id, item_id, score FROM all_scores WHERE item_id IN (SELECT chunk_id FROM calls))"""),
    "e_words": ("questions calls", "{bm25:calls:chunk_id:chunk_text}"),
    "e_fused": ("e_meaning e_words", "{fuse:e_meaning:e_words:5}"),
    "holding": ("questions", f"""
        SELECT query_id, doc_id AS item_id
        FROM (SELECT query_id, ' ' || array_to_string({tokens('question')}, ' ') || ' ' AS passage FROM questions) q,
             (SELECT doc_id, ' ' || array_to_string({tokens('text')}, ' ') || ' ' AS words FROM documents) d
        WHERE contains(words, passage)"""),
    "targets": ("by_words questions chunks", "{targets:SELECT query_id, company FROM by_words JOIN chunks ON item_id = chunk_id WHERE rank <= 5}"),
    # the context's own ranking obeys a single asked-for company
    "asked": ("questions", "SELECT query_id, CASE WHEN len(companies) = 1 THEN companies[1] END AS company FROM questions"),
    "c_meaning": ("all_scores chunks asked", """
        SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
        FROM all_scores JOIN asked o USING (query_id) JOIN chunks k ON chunk_id = item_id
        WHERE o.company IS NULL OR o.company = k.company"""),
    "c_words": ("questions chunks asked", "{bm25:chunks:chunk_id:chunk_text:o.company IS NULL OR o.company = k.company}"),
    "c_fused": ("c_meaning c_words", "{fuse:c_meaning:c_words:10}"),
    "c_excerpts": ("c_fused chunks", """
        SELECT query_id, rank, company, fiscal_period, document_type, chunk_text FROM c_fused JOIN chunks ON item_id = chunk_id"""),
    "c_targets": ("c_excerpts questions", "{targets:SELECT query_id, company FROM c_excerpts}"),
    "c_relations": ("c_targets text_relationships subject_names", "{relations:c_targets}"),
    "c_signals": ("c_targets summary", "{signals:c_targets}"),
    "c_parts": ("c_excerpts c_relations c_signals questions", f"""
        SELECT query_id, s::INTEGER AS section, 0 AS ord, h AS text
        FROM questions, (VALUES (0, {lit(HEADINGS[0])}), (1, {lit(HEADINGS[1])}), (2, {lit(HEADINGS[2])})) v(s, h)
        UNION ALL
        SELECT query_id, 0, ((rank - 1) * 3 + p)::INTEGER,
               CASE p WHEN 1 THEN '⬇️ [' || coalesce(company, 'None') || ' | ' || coalesce(fiscal_period, 'None') || ' | ' || coalesce(document_type, 'None') || '] ⬇️'
                      WHEN 2 THEN chunk_text ELSE '⬆️  ⬆️' || chr(10) END
        FROM c_excerpts, (VALUES (1), (2), (3)) v(p)
        UNION ALL
        SELECT query_id, 1, (row_number() OVER (PARTITION BY query_id ORDER BY subject, mentions DESC, predicate, object))::INTEGER,
               {WIDE.format('subject', 30)} || ' → ' || {WIDE.format('predicate', 20)} || ' → ' || {WIDE.format('object', 30)} || ' (' || mentions || ' mentions)'
        FROM c_relations
        UNION ALL
        SELECT query_id, 2, (row_number() OVER (PARTITION BY query_id ORDER BY company, total_docs DESC, ai_investment_category))::INTEGER,
               {WIDE.format('company', 30)} || ': ' || {WIDE.format('ai_investment_category', 30)} || ' — ' || total_docs || ' documents'
        FROM c_signals"""),
    "contexts": ("c_parts", """
        SELECT query_id, string_agg(text[:1000], '' ORDER BY section, ord, text[:1000]) AS context FROM c_parts GROUP BY query_id"""),
    "versions": ("chunks", f"""
        SELECT c.*, quality, toxic, coalesce(document_type = 'Earnings Call', false) AS is_call
        FROM chunks c LEFT JOIN (SELECT {DOC_PATH} AS source_path, quality, toxic FROM labels JOIN documents USING (doc_id)) m USING (source_path)"""),
    "changes": ("versions", """
        SELECT chunk_id, CASE WHEN is_call AND NOT gone THEN 'insert' WHEN NOT is_call AND gone THEN 'delete'
                              WHEN quality = 0 THEN 'update' ELSE 'same' END AS change
        FROM (SELECT *, coalesce(toxic = 1, false) AS gone FROM versions)
        WHERE NOT (is_call AND gone)"""),
    "synced": ("changes versions", """
        SELECT chunk_id, chunk_to_embed || CASE change WHEN 'update' THEN ' (revised)' ELSE '' END AS chunk_to_embed, chunk_text
        FROM versions JOIN changes USING (chunk_id) WHERE change <> 'delete'"""),
    "synced_vectors": ("synced", "{vectors:synced:chunk_id:chunk_to_embed}"),
}


def _vectors(table: str, key: str, text: str) -> str:
    return f"""
        SELECT id, list(coalesce(v, 0)::DOUBLE ORDER BY slot) AS vec
        FROM (SELECT {key} AS id, unnest(range(64)) AS slot FROM {table})
        LEFT JOIN (SELECT id, ('0x' || substr(md5(w), 1, 8))::UBIGINT::BIGINT % 64 AS slot,
                          sum(CASE WHEN substr(md5(w), 9, 1) IN ('0','1','2','3','4','5','6','7') THEN 1 ELSE -1 END) AS v
                   FROM (SELECT {key} AS id, unnest({tokens(text)}) AS w FROM {table}) GROUP BY ALL) USING (id, slot)
        GROUP BY id"""


def _bm25(table: str, key: str, text: str, where: str = "") -> str:
    limit = f"JOIN asked o ON o.query_id = t.query_id JOIN {table} k ON k.{key} = f.id WHERE {where}" if where else ""
    return f"""
        WITH q AS (SELECT DISTINCT query_id, unnest({tokens('question')}) AS w FROM questions),
        sized AS (SELECT {key} AS id, {tokens(text)} AS ws FROM {table}),
        stats AS (SELECT count(*) AS total, avg(len(ws)) AS mean FROM sized),
        f AS (SELECT id, size, w, count(*) AS tf FROM (SELECT id, len(ws) AS size, unnest(ws) AS w FROM sized)
              WHERE w IN (SELECT w FROM q) GROUP BY ALL),
        idf AS (SELECT w, ln(1 + ((SELECT total FROM stats) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM f GROUP BY w),
        scored AS (SELECT t.query_id, f.id AS item_id,
                          round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / (SELECT mean FROM stats)))), 6) AS score
                   FROM f JOIN q t USING (w) JOIN idf USING (w) {limit} GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM scored"""


def _fuse(first: str, second: str, k: str) -> str:
    return f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
            SELECT query_id, item_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score
            FROM (SELECT query_id, item_id, rank FROM {first} WHERE rank <= 50 UNION ALL SELECT query_id, item_id, rank FROM {second} WHERE rank <= 50)
            GROUP BY ALL)) WHERE rank <= {k}"""


def _targets(retrieved: str) -> str:
    every = "[" + strings(V.COMPANIES) + "]"
    return f"""
        SELECT DISTINCT query_id, unnest(coalesce(companies, seen, {every})) AS company
        FROM questions LEFT JOIN (SELECT query_id, list(DISTINCT company) AS seen FROM ({retrieved})
                                  WHERE company IS NOT NULL GROUP BY query_id) USING (query_id)"""


def _relations(targets: str) -> str:
    return f"""
        SELECT query_id, subject, predicate, object, mentions FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY subject, mentions DESC, predicate, object) AS rn
          FROM {targets} JOIN (SELECT subject, predicate, object, sum(mention_count)::BIGINT AS mentions,
                                      coalesce({canonical('subject', 'subject_names')}, subject) AS company
                               FROM text_relationships WHERE predicate IN ({strings(CONTEXT_PREDICATES)})
                               GROUP BY subject, predicate, object) USING (company))
        WHERE rn <= 20"""


def _signals(targets: str) -> str:
    return f"""
        SELECT query_id, company, ai_investment_category, sum(document_count)::BIGINT AS total_docs
        FROM {targets} JOIN summary USING (company) WHERE ai_investment_category <> {lit(V.NOT_AI)} GROUP BY ALL"""


_FORMS = {"vectors": _vectors, "bm25": _bm25, "fuse": _fuse, "targets": _targets, "relations": _relations, "signals": _signals}


def _body(name: str) -> str:
    body = RELATIONS[name][1]
    form = re.fullmatch(r"\{(\w+):(.*)\}", body, re.S)
    if not form:
        return body
    return _FORMS[form[1]](*(form[2].split(":") if form[1] in ("vectors", "bm25", "fuse") else [form[2]]))


def sql(needs: str, body: str) -> str:
    """``body`` behind the relations it needs, in order of dependence."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in RELATIONS[name][0].split():
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_body(n)})" for n in order) + "\n" + body


def _top(k: int, ranking: str) -> str:
    return f"SELECT query_id, item_id, score, rank::INTEGER AS rank FROM {ranking} WHERE rank <= {k}"


def _cosine(condition: str) -> str:
    return f"""
        SELECT query_id, item_id, score, rank::INTEGER AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
            SELECT q.vec_id AS query_id, c.vec_id AS item_id,
                   round(round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12), 6) AS score
            FROM embeddings q, embeddings c LEFT JOIN documents d ON d.doc_id = c.vec_id WHERE {condition}))
        WHERE rank <= 5"""


SHARE = "round((100.0 * {0} / sum({0}) OVER (PARTITION BY {1}))::DOUBLE, 1)"
MEMBERS = f"SELECT DISTINCT object, subject FROM relationships WHERE predicate IN ({strings(CONTEXT_PREDICATES)})"
SHARED = f"""SELECT object AS ai_entity, count(*) AS mentioned_by_n_companies FROM ({MEMBERS}) GROUP BY object
             HAVING count(*) >= 3 ORDER BY 2 DESC, 1 LIMIT 20"""
ENTITY_ENDS = "SELECT DISTINCT query_id, unnest({}) AS name FROM by_words JOIN chunks ON item_id = chunk_id WHERE rank <= 5".format(tokens("chunk_text"))

TEXT_FILES = "SELECT (strlen(t) + 1)::BIGINT AS file_size_bytes, sha256(t || chr(10)) AS content_sha256 FROM (SELECT coalesce(text, '') AS t FROM documents)"

ORACLES: dict[str, str] = {
    # sources and sinks
    "with_provenance": "SELECT doc_id, 'documents.parquet' AS file, true AS stamped FROM documents",
    "corpus_inventory": sql("bronze", """
        SELECT coalesce(folder, 'TOTAL') AS folder, count(*) AS files, round(sum(strlen(text)) / 1e6, 6) AS megabytes,
               grouping(folder) = 1 AND count(*) < 50 AS below_minimum
        FROM (SELECT text, regexp_extract(source_path, '([^/]+)/[^/]+$', 1) AS folder FROM bronze) GROUP BY ROLLUP (folder)"""),
    "read_table": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "overwrite_table": "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY ALL",
    "materialized_view": "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
    "summary_view": sql("gold", f"""
        SELECT company, fiscal_period, document_type, ai_investment_category, management_sentiment, count(*) AS document_count FROM gold
        WHERE source_path NOT IN (SELECT {DOC_PATH} FROM labels JOIN documents USING (doc_id) WHERE toxic = 1) GROUP BY ALL"""),
    "read_stream_table": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "ingest_batch": TEXT_FILES,
    "ingest_stream": TEXT_FILES,
    "extract_with_model": "SELECT doc_id, '{\"characters\": ' || (length('Read: ') + length(text)) || '}' AS result FROM documents",
    "append_positional": """SELECT 'supplier' AS kind, s_name AS name, s_acctbal AS balance FROM supplier
        UNION ALL SELECT 'customer', c_name, c_acctbal FROM customer""",
    "ctas_grouped": sql("summary", "SELECT company, fiscal_period, ai_investment_category, count(*) AS doc_count FROM summary GROUP BY ALL"),
    "materialize": "SELECT l_partkey, count(*) AS lines, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey",
    "chunk_changes": sql("changes", "SELECT * FROM changes"),
    "apply_changes": sql("changes versions", """
        SELECT chunk_id, chunk_to_embed || CASE change WHEN 'update' THEN ' (revised)' ELSE '' END AS chunk_to_embed, company, document_type
        FROM versions JOIN changes USING (chunk_id) WHERE change <> 'delete'"""),
    "sync_index": sql("synced_vectors", f"""
        SELECT chunk_id, chunk_to_embed, array_to_string({tokens('chunk_text')}, ' ') AS words,
               array_to_string(list_transform(vec, lambda x: x::INTEGER::VARCHAR), ' ') AS vector, len(list_distinct({tokens('chunk_text')}))::BIGINT AS n_lists
        FROM synced JOIN synced_vectors ON id = chunk_id"""),
    "silver_stream": sql("silver", "SELECT * FROM silver"),
    # projections and predicates
    "silver": sql("silver", "SELECT * FROM silver"),
    "gold": sql("gold", "SELECT * FROM gold"),
    "project_rename": "SELECT o_orderkey AS chunk_id, o_orderstatus AS document_type, o_orderpriority AS company FROM orders",
    "drop_columns": "SELECT p_partkey, p_name, p_brand, p_type FROM part",
    "struct_project": "SELECT p_partkey, p_brand AS brand, p_size AS size FROM part",
    "not_null_filter": sql("silver", "SELECT source_path, fiscal_period FROM silver WHERE fiscal_period IS NOT NULL"),
    "ilike_filter": sql("silver", "SELECT source_path, company FROM silver WHERE document_type ILIKE '%earnings%'"),
    "like_filter": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'",
    "in_filter": sql("relationships", "SELECT subject, predicate, object FROM relationships WHERE predicate IN ('partners_with', 'invests_in')"),
    "not_ilike_filter": sql("relationships", "SELECT subject, predicate, object FROM relationships WHERE object NOT ILIKE 'brand%'"),
    "not_equal_filter": sql("summary", f"SELECT * FROM summary WHERE company <> 'NVIDIA Corporation' AND ai_investment_category <> {lit(V.NOT_AI)}"),
    "either_direction_filter": sql("relationships", """SELECT subject, predicate, object FROM relationships
        WHERE (subject ILIKE 'nation%' AND object = 'ASIA') OR (subject = 'ASIA' AND object ILIKE 'nation%')"""),
    "optional_predicate": sql("relationships", """SELECT object, sum(mention_count)::BIGINT AS mentions FROM relationships
        WHERE object IS NOT NULL GROUP BY object ORDER BY mentions DESC, object LIMIT 50"""),
    "fallback_columns": f"""
        SELECT doc_id,
               coalesce({field('document_type', 'text')}, CASE WHEN source = 'src7' THEN '' ELSE lang END) AS document_type,
               coalesce({field('company', 'text')}, source) AS company
        FROM documents""",
    "distinct_rows": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "literal_columns": f"SELECT 'Unknown' AS company, n_name AS entity_name, {lit(V.BACKFILL_DESCRIPTION)} AS description FROM nation",
    # quality
    "expect_or_drop": "SELECT doc_id, length(text)::INTEGER AS chars FROM documents WHERE text IS NOT NULL AND length(text) > 200",
    "expect_warn": sql("silver", """SELECT source_path, company IS NOT NULL AS has_company, document_type IS NOT NULL AS has_doc_type,
        fiscal_period IS NOT NULL AS has_fiscal_period FROM silver"""),
    "expectation_report": sql("silver_rows silver", " UNION ALL ".join([
        """SELECT 'has_content' AS expectation, 'drop' AS action, count(*) FILTER (length(plain_text) > 200) AS passed,
           count(*) FILTER (length(plain_text) <= 200) AS failed, count(*) FILTER (length(plain_text) <= 200) AS dropped, 0::BIGINT AS warned FROM silver_rows""",
        *[f"SELECT '{n}', 'warn', count({c}), count(*) - count({c}), 0, count(*) - count({c}) FROM silver"
          for n, c in [("has_company", "company"), ("has_doc_type", "document_type"), ("has_fiscal_period", "fiscal_period")]],
    ])),
    "completeness": sql("silver", " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total, count({c}) AS present, count(*) - count({c}) AS missing,
            round(count({c})::DOUBLE / count(*), 6) AS ratio FROM silver""" for c in ("company", "fiscal_period", "revenue_reported"))),
    "quality_gate": sql("silver gold", """
        SELECT 'silver row count >= 50' AS check_name, count(*) >= 50 AS passed, count(*)::DOUBLE AS value FROM silver
        UNION ALL SELECT 'silver company completeness >= 80%', count(company) / count(*) >= 0.8, round(count(company)::DOUBLE / count(*), 6) FROM silver
        UNION ALL SELECT 'gold row count == silver row count', count(*) = (SELECT count(*) FROM silver), count(*)::DOUBLE FROM gold"""),
    "pk_duplicates": "SELECT l_orderkey, l_partkey, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "chunk_id_duplicates": sql("chunks", "SELECT chunk_id, count(*) AS copies FROM chunks GROUP BY ALL HAVING count(*) > 1"),
    "flow_progress": """SELECT ts AS timestamp, (props->>'$.k')::BIGINT AS dropped, user_id AS warned, event_type AS expectations
        FROM events WHERE event_type NOT IN ('signup', 'error') ORDER BY ts DESC, dropped, warned, expectations LIMIT 50""",
    # documents to fields
    "parse_document": sql("elements", "SELECT * FROM elements"),
    "parse_text": f"""SELECT doc_id, (i - 1)::INTEGER AS element_id, CASE WHEN i = 1 THEN 'title' ELSE 'text' END AS element_type, l[i] AS content
        FROM (SELECT doc_id, {LINES.format('text')} AS l FROM documents), unnest(generate_series(1, len(l))) g(i)""",
    "plain_text": sql("elements", "SELECT page_id, string_agg(content, chr(10) || chr(10) ORDER BY element_id) AS plain_text FROM elements GROUP BY page_id"),
    "extract_fields": "SELECT doc_id, " + ", ".join(f"{field(n, 'text')} AS {n}" for n in V.FIELD_LABELS) + " FROM documents",
    "canonicalize": sql("aliases", f"""SELECT doc_id, {canonical("(upper(source) || ' ' || lang || ', Inc.')")} AS company FROM documents"""),
    "canonicalize_by_table": """
        WITH a AS (SELECT alias, min(canonical) AS canonical FROM (
            SELECT p_name AS alias, p_type AS canonical FROM part UNION ALL SELECT split_part(p_name, ' ', 1), p_brand FROM part) GROUP BY alias)
        SELECT p_partkey, (SELECT arg_max(a.canonical, length(a.alias)) FROM a WHERE starts_with(p_name || ' ', a.alias || ' ')) AS canonical FROM part""",
    "classify": f"""SELECT doc_id, {label_of('w', V.AI_CATEGORIES, D.CATEGORY_LEXICON, V.NOT_AI)} AS category,
        {label_of('w', V.MANAGEMENT_TONES, D.TONE_LEXICON, V.NEUTRAL_TONE)} AS tone FROM (SELECT doc_id, {tokens('text')} AS w FROM documents)""",
    "sentiment": f"""SELECT doc_id, CASE WHEN p + n = 0 THEN 'neutral' WHEN 2 * least(p, n) >= greatest(p, n) THEN 'mixed'
               WHEN p > n THEN 'positive' ELSE 'negative' END AS sentiment
        FROM (SELECT doc_id, len(list_filter({tokens('text')}, lambda x: x IN ({strings(D.POSITIVE)}))) AS p,
                     len(list_filter({tokens('text')}, lambda x: x IN ({strings(D.NEGATIVE)}))) AS n FROM documents)""",
    "classify_model_report": """SELECT count(*) AS documents, count(text) AS answered,
        count(*) FILTER (substr(md5(doc_id::VARCHAR), 1, 1) <= '2' AND quality IS NOT NULL) AS unseen, true AS accurate
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "chunk_documents": sql("chunks", "SELECT * FROM chunks"),
    "chunk_pages": sql("page_parts sectioned", """
        SELECT p.page_id || '_chunk' || (row_number() OVER (PARTITION BY p.page_id ORDER BY p.section, part) - 1) AS chunk_id,
               concat_ws(chr(10), t.content, h.content, 'Page 0', chunk_text) AS chunk_to_embed, chunk_text
        FROM page_parts p LEFT JOIN sectioned t ON t.page_id = p.page_id AND t.element_type = 'title'
        LEFT JOIN sectioned h ON h.page_id = p.page_id AND h.section = p.section AND h.element_type = 'section_header'"""),
    "extract_triplets": sql("silver hits ends", """
        SELECT source_path, to_json({'data': {'entities': coalesce(e, []), 'relationships': coalesce(r, [])}})::VARCHAR AS result
        FROM silver
        LEFT JOIN (SELECT source_path, list({'name': name, 'entity_type': entity_type, 'description': description} ORDER BY ord) AS e FROM ends GROUP BY source_path) USING (source_path)
        LEFT JOIN (SELECT source_path, list({'subject': subject, 'predicate': predicate, 'object': object} ORDER BY pat, i) AS r FROM hits GROUP BY source_path) USING (source_path)"""),
    "parse_structured": sql("silver hits ends", """
        SELECT source_path, coalesce(document_type = 'fr', false) AS malformed,
               CASE WHEN document_type = 'fr' THEN 0 ELSE coalesce(e, 0) END::INTEGER AS entities,
               CASE WHEN document_type = 'fr' THEN 0 ELSE coalesce(r, 0) END::INTEGER AS relationships
        FROM silver LEFT JOIN (SELECT source_path, count(*) AS e FROM ends GROUP BY source_path) USING (source_path)
        LEFT JOIN (SELECT source_path, count(*) AS r FROM hits GROUP BY source_path) USING (source_path)"""),
    "embed_text": f"""SELECT doc_id, slot::INTEGER AS slot, v::DOUBLE AS value FROM (
        SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::UBIGINT::BIGINT % 64 AS slot,
               sum(CASE WHEN substr(md5(w), 9, 1) < '8' THEN 1 ELSE -1 END) AS v
        FROM (SELECT doc_id, unnest({tokens('text')}) AS w FROM documents) GROUP BY ALL) WHERE v <> 0""",
    # aggregates
    "investment_summary": sql("summary", "SELECT * FROM summary"),
    "summary_listing": sql("summary", """SELECT company, fiscal_period, ai_investment_category, management_sentiment, document_count
        FROM summary WHERE company IS NOT NULL"""),
    "category_mix": sql("gold", f"""SELECT company, ai_investment_category, document_count, {SHARE.format('document_count', 'company')} AS pct_of_company
        FROM (SELECT company, ai_investment_category, count(*) AS document_count FROM gold WHERE company IS NOT NULL GROUP BY ALL)"""),
    "category_leaders": sql("summary", "SELECT company, sum(document_count)::BIGINT AS docs FROM summary WHERE ai_investment_category = 'AI Infrastructure' GROUP BY company"),
    "category_by_company": sql("summary", "SELECT company, ai_investment_category, sum(document_count)::BIGINT AS total_docs FROM summary GROUP BY ALL"),
    "signals_for_companies": sql("summary", f"""SELECT company, ai_investment_category, sum(document_count)::BIGINT AS total_docs FROM summary
        WHERE company IN ('NVIDIA Corporation', 'Apple Inc.') AND ai_investment_category <> {lit(V.NOT_AI)} GROUP BY ALL"""),
    "analysis_rows": sql("summary", "SELECT company, fiscal_period, ai_investment_category, count(*) AS doc_count FROM summary GROUP BY ALL"),
    "entity_type_counts": sql("all_entities", "SELECT entity_type, count(*) AS entities FROM all_entities GROUP BY entity_type"),
    "predicate_counts": sql("relationships", "SELECT predicate, count(*) AS relationships FROM relationships GROUP BY predicate"),
    "shared_targets": sql("relationships", SHARED),
    "shared_target_members": sql("relationships", f"""SELECT ai_entity, mentioned_by_n_companies, subject AS mentioned_by
        FROM ({SHARED}) JOIN ({MEMBERS}) ON ai_entity = object"""),
    "object_frequency": sql("relationships", """SELECT object, sum(mention_count)::BIGINT AS supply_count FROM relationships
        WHERE subject LIKE '%Supplier%' AND predicate = 'supplies_to' GROUP BY object"""),
    "partnership_mentions": sql("text_relationships", f"""
        SELECT subject AS company, predicate, object AS partner, sum(mention_count)::BIGINT AS mention_count FROM text_relationships
        WHERE subject IN ({strings(sorted(D.SUBJECT_ALIASES))}) AND predicate IN ('partners_with', 'invests_in') GROUP BY ALL
        ORDER BY company, mention_count DESC, predicate, partner LIMIT 20"""),
    "top_objects_by_predicate": sql("relationships", """SELECT object, sum(mention_count)::BIGINT AS mentions FROM relationships
        WHERE predicate = 'acquires' AND subject ILIKE 'customer%' GROUP BY object ORDER BY mentions DESC, object LIMIT 20"""),
    "table_counts": sql("bronze silver gold summary", " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ("bronze", "silver", "gold", "summary"))),
    "company_breakdown": sql("gold", "SELECT company, count(*) AS docs FROM gold WHERE company IS NOT NULL GROUP BY company"),
    "chunk_stats": sql("chunks", "SELECT count(*) AS chunk_count, count(DISTINCT source_path) AS document_count FROM chunks"),
    # windows, order, set forms
    "assign_uid": sql("entities", "SELECT * FROM entities"),
    "side_row_number": sql("edges", "SELECT DISTINCT node_start_id, relationship, node_end_id FROM edges"),
    "share_of_total": f"""SELECT l_returnflag, l_linestatus, lines, {SHARE.format('lines', 'l_returnflag')} AS pct
        FROM (SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY ALL)""",
    "ordered_output": sql("summary", "SELECT * FROM summary"),
    "top_n": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "top_k_per_query": """SELECT o_custkey AS query_id, o_orderkey AS item_id, o_totalprice AS score, rank::INTEGER AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5""",
    "dedupe_entities": sql("text_entities", "SELECT * FROM text_entities"),
    "dedupe_relationships": sql("text_relationships", "SELECT * FROM text_relationships"),
    "entities_with_backfill": sql("all_entities", "SELECT * FROM all_entities"),
    "sanitize_identifier": """SELECT c_custkey, trim(regexp_replace(lower('.' || c_name || '+' || c_mktsegment || '-'), '[^a-z0-9]', '_', 'g'), '_') AS schema_name
        FROM customer""",
    "run_history": """SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M') AS started,
               CASE WHEN ms IS NULL OR ms = 0 THEN '—' ELSE (ms // 60000) || 'm ' || (ms // 1000 % 60) || 's' END AS duration,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' ELSE 'IN PROGRESS' END AS result
        FROM (SELECT event_id AS run_id, ts, event_type, CASE WHEN event_type <> 'view' THEN floor(value * 1000)::BIGINT END AS ms FROM events)""",
    # graph
    "build_entities": sql("text_entities", f"""SELECT company, fiscal_period, entity_name, entity_type, description, entity_type || '_' || {PAD.format('rn')} AS UID
        FROM (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY entity_name) AS rn FROM text_entities)"""),
    "build_relationships": sql("relationships", "SELECT * FROM relationships"),
    "missing_entities": sql("missing", "SELECT * FROM missing"),
    "backfill_entities": sql("backfilled", "SELECT * FROM backfilled"),
    "node_table": sql("nodes", "SELECT * FROM nodes"),
    "edge_table": sql("edges", "SELECT * FROM edges"),
    "relations_of_subject": sql("relationships", "SELECT subject, predicate, object, fiscal_period FROM relationships WHERE subject ILIKE 'customer%' AND predicate ILIKE 'acquires'"),
    "two_hop": sql("relationships", """
        SELECT a.subject AS company, a.predicate AS hop1_rel, a.object AS partner, b.predicate AS hop2_rel, b.object AS partners_partner
        FROM relationships a JOIN relationships b ON a.object = b.subject
        WHERE a.subject ILIKE 'supplier%' AND a.predicate = 'partners_with' AND b.predicate IN ('partners_with', 'invests_in') AND b.object NOT ILIKE 'supplier%'
        ORDER BY partner, partners_partner, hop2_rel, company, hop1_rel LIMIT 20"""),
    "two_hop_all": sql("relationships", """
        SELECT a.subject AS company, a.predicate AS hop1_rel, a.object AS partner, b.predicate AS hop2_rel, b.object AS partners_partner
        FROM relationships a JOIN relationships b ON a.object = b.subject
        WHERE a.subject ILIKE 'supplier%' AND a.predicate = 'supplies_to' AND b.predicate = 'uses_technology' AND b.object NOT ILIKE 'supplier%'"""),
    "entity_lookup_stored": sql("relationships", """
        SELECT entity_name, subject, predicate, object FROM (
          SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY predicate, subject, object) AS rn FROM (
            SELECT subject AS entity_name, subject, predicate, object FROM relationships
            UNION SELECT object, subject, predicate, object FROM relationships)
          WHERE entity_name IN ('NATION_3', 'ASIA', 'Brand#11', 'BUILDING')) WHERE rn <= 20"""),
    "pair_relations": sql("relationships", """SELECT DISTINCT subject, predicate, object, company AS mentioned_in, fiscal_period FROM relationships
        WHERE (subject ILIKE 'customer%' AND object = 'BUILDING') OR (subject = 'BUILDING' AND object ILIKE 'customer%')"""),
    "title_join": sql("entities relationships", """SELECT entity_name AS chief_person, description AS title, predicate, object AS mentioned_entity
        FROM entities e JOIN relationships r ON e.entity_name = r.subject WHERE entity_type = 'Person' AND description ILIKE '%chief%'"""),
    "entity_lookup": sql("relationships", """SELECT subject, predicate, object FROM relationships WHERE subject = 'NATION_3' OR object = 'NATION_3'
        ORDER BY predicate, subject, object LIMIT 20"""),
    "entity_lookup_batch": sql("relationships all_entities", """
        SELECT entity_name, subject, predicate, object FROM (
          SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY predicate, subject, object) AS rn FROM (
            SELECT subject AS entity_name, subject, predicate, object FROM relationships
            UNION SELECT object, subject, predicate, object FROM relationships)
          WHERE entity_name IN (SELECT entity_name FROM all_entities)) WHERE rn <= 20"""),
    "pattern_match": sql("edges", """SELECT DISTINCT node_start_id AS start_id, subject, node_end_id AS end_id, object FROM edges
        WHERE node_start_key = 'Product' AND relationship = 'uses_technology' AND node_end_key = 'Product'"""),
    # retrieval
    "vector_topk": _cosine("q.vec_id <> c.vec_id"),
    "vector_topk_filtered": _cosine("d.lang = 'de'"),
    "vector_topk_like": _cosine("contains(d.source, 'src1')"),
    "vector_topk_by_label": _cosine("q.vec_id <> c.vec_id AND q.label = c.label"),
    "query_doc_join": sql("by_meaning chunks", """SELECT query_id, rank::INTEGER AS rank, item_id, company, fiscal_period, document_type, chunk_text, score
        FROM by_meaning JOIN chunks ON item_id = chunk_id WHERE rank <= 5"""),
    "ann_all_lists": _cosine("q.vec_id <> c.vec_id"),
    "search": sql("e_fused chunks", """SELECT query_id, rank::INTEGER AS rank, item_id, company, fiscal_period, document_type, score
        FROM e_fused JOIN chunks ON item_id = chunk_id"""),
    "bm25_topk": sql("by_words", _top(10, "by_words")),
    "bm25_documents": sql("by_words_documents", _top(10, "by_words_documents")),
    "hybrid_topk": sql("fused", _top(10, "fused")),
    "compare_rankings": sql("by_meaning by_words", """SELECT query_id, item_id, coalesce(a.rank, 0)::INTEGER AS left_rank, coalesce(b.rank, 0)::INTEGER AS right_rank
        FROM (SELECT * FROM by_meaning WHERE rank <= 10) a FULL JOIN (SELECT * FROM by_words WHERE rank <= 10) b USING (query_id, item_id)"""),
    "citations": sql("by_words chunks", """SELECT query_id, source_path, min(rank)::INTEGER AS best_rank FROM by_words JOIN chunks ON item_id = chunk_id
        WHERE rank <= 10 GROUP BY ALL"""),
    "verbatim_hits": sql("holding", "SELECT * FROM holding"),
    "retrieval_eval": sql("holding by_words_documents", """
        SELECT count(*) AS queries, count(r) AS hits, round(avg((r IS NOT NULL)::INT), 6) AS hit_rate, round(avg(coalesce(1.0::DOUBLE / r, 0)), 6) AS mrr
        FROM (SELECT query_id, min(rank) AS r FROM holding LEFT JOIN (SELECT * FROM by_words_documents WHERE rank <= 10) USING (query_id, item_id) GROUP BY query_id)"""),
    "entity_link": sql("by_words chunks text_relationships", f"""
        SELECT query_id, subject, predicate, object, mentions FROM ({ENTITY_ENDS}) JOIN (
          SELECT subject, predicate, object, mention_count AS mentions, lower(subject) AS name FROM text_relationships) USING (name)"""),
    # context
    "context_targets": sql("targets", "SELECT * FROM targets"),
    "single_company_filter": sql("asked", "SELECT * FROM asked"),
    "company_relations": sql("targets text_relationships subject_names", _relations("targets")),
    "company_signals": sql("targets summary", _signals("targets")),
    "format_lines": sql("relationships summary", f"""
        SELECT 'graph' AS layer, {WIDE.format('subject', 30)} || ' → ' || {WIDE.format('predicate', 20)} || ' → ' || {WIDE.format('object', 30)}
               || ' (' || mention_count || ' mentions)' AS line FROM relationships
        UNION ALL SELECT 'signals', {WIDE.format('company', 30)} || ': ' || {WIDE.format('ai_investment_category', 30)} || ' — ' || total_docs || ' documents'
        FROM (SELECT company, ai_investment_category, sum(document_count)::BIGINT AS total_docs FROM summary WHERE company IS NOT NULL GROUP BY ALL)"""),
    "hybrid_context": sql("c_parts", "SELECT * FROM c_parts"),
    "assemble_context": sql("contexts", "SELECT * FROM contexts"),
    "build_prompt": sql("contexts questions", "SELECT query_id, replace(replace("
                        + lit(PROMPT.replace("%s", "\1", 1).replace("%s", "\2")) + ", chr(1), context), chr(2), question) AS prompt FROM contexts JOIN questions USING (query_id)"),
}
ORACLES["two_hop_stored"] = ORACLES["two_hop_all"]
