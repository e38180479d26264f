"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

WS = r"[\s\x0b\p{Z}\x{1c}-\x{1f}\x{85}]"
NL = "chr(10)"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def _clean(x: str) -> str:
    x = f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\r\\n?', {NL}, 'g')"
    return _strip(f"regexp_replace({x}, '\\n{{3,}}', {NL} || {NL}, 'g')")


def _chunk_ctes(source: str) -> str:
    """CTEs cleaned, seg and chunks over `source(doc_id, t, ord)`; the chunker as a recursion over segments."""
    tail = (
        "CASE WHEN length(b) <= 64 THEN b WHEN contains(right(b, 64), ' ')"
        " THEN substring(right(b, 64), instr(right(b, 64), ' ') + 1) ELSE right(b, 64) END"
    )
    return f"""
src AS ({source}),
cleaned AS MATERIALIZED (SELECT doc_id, ord, {_clean('t')} AS t FROM src),
chosen AS (
  SELECT doc_id, ord, t,
    CASE WHEN contains(t, {NL} || {NL}) THEN {NL} || {NL} WHEN contains(t, {NL}) THEN {NL}
         WHEN contains(t, '. ') THEN '. ' WHEN contains(t, '! ') THEN '! '
         WHEN contains(t, '? ') THEN '? ' WHEN contains(t, '; ') THEN '; ' END AS sep
  FROM cleaned),
parts AS (
  SELECT doc_id, ord, sep, CASE WHEN sep IS NULL THEN [t] ELSE string_split(t, sep) END AS p FROM chosen),
whole AS (
  SELECT doc_id, ord, i, p[i] || CASE WHEN i < len(p) THEN sep ELSE '' END AS s
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM parts)),
piece AS (
  SELECT doc_id, ord, i, j, substring(s, CAST(j * 512 + 1 AS BIGINT), 512) AS s
  FROM (SELECT *, unnest(range(0, (length(s) + 511) // 512)) AS j FROM whole)),
seg AS MATERIALIZED (
  SELECT doc_id, ord, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS k, s AS x
  FROM piece WHERE s <> ''),
rec AS (
  SELECT doc_id, ord, k, x AS b, CAST(0 AS BIGINT) AS st, length(x) AS o,
         CAST(NULL AS VARCHAR) AS e, CAST(NULL AS BIGINT) AS es, CAST(NULL AS BIGINT) AS ee
  FROM seg WHERE k = 1
  UNION ALL
  SELECT doc_id, ord, k,
    CASE WHEN over THEN tail || x ELSE b || x END,
    CASE WHEN over THEN st + length(b) - length(tail) ELSE st END,
    o + length(x),
    CASE WHEN over THEN b END, CASE WHEN over THEN st END, CASE WHEN over THEN st + length(b) END
  FROM (SELECT seg.doc_id, seg.ord, seg.k, seg.x, rec.b, rec.st, rec.o,
               length(rec.b) + length(seg.x) > 512 AS over, {tail} AS tail
        FROM rec JOIN seg ON seg.doc_id = rec.doc_id AND seg.k = rec.k + 1)),
ends AS (SELECT doc_id, max(k) AS k FROM seg GROUP BY doc_id),
emitted AS (
  SELECT doc_id, ord, k, 0 AS fin, e AS b, es AS st, ee AS en FROM rec WHERE e IS NOT NULL
  UNION ALL
  SELECT rec.doc_id, rec.ord, rec.k, 1, b, st, st + length(b) FROM rec JOIN ends USING (doc_id, k)),
chunks AS MATERIALIZED (
  SELECT doc_id || '_' || (row_number() OVER (PARTITION BY doc_id ORDER BY k, fin) - 1) AS chunk_id,
         doc_id, ord AS doc_ord,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k, fin) - 1 AS INTEGER) AS chunk_index,
         CAST(st AS INTEGER) AS start_char, CAST(en AS INTEGER) AS end_char, {_strip('b')} AS text
  FROM emitted WHERE length({_strip('b')}) >= 50)"""


DOCS = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS t, doc_id AS ord FROM documents"
PAGES = "SELECT CAST(page_id AS VARCHAR) AS doc_id, CAST(html AS VARCHAR) AS t, page_id AS ord FROM pages"
CHUNKS = "WITH RECURSIVE " + _chunk_ctes(DOCS)


def _tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]+')"


POSTINGS = f"""{CHUNKS},
toks AS MATERIALIZED (SELECT chunk_id, doc_id, doc_ord, chunk_index, {_tokens('text')} AS tk FROM chunks),
members AS (SELECT chunk_id, doc_ord, chunk_index, len(tk) AS dl FROM toks),
postings AS MATERIALIZED (
  SELECT term, chunk_id, doc_ord, chunk_index, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT chunk_id, doc_ord, chunk_index, len(tk) AS dl, unnest(tk) AS term FROM toks)
  GROUP BY ALL_KEYS),
corpus AS (SELECT count(*) AS n, sum(dl) AS total, sum(dl)::DOUBLE / count(*) AS avgdl FROM members),
terms AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM terms, corpus),
mean AS (SELECT avg(idf) AS average_idf FROM raw),
weights AS MATERIALIZED (
  SELECT term, df, CASE WHEN idf < 0 THEN 0.25 * average_idf ELSE idf END AS idf FROM raw, mean)""".replace(
    "GROUP BY ALL_KEYS", "GROUP BY term, chunk_id, doc_ord, chunk_index"
)

BENCH = "SELECT item_id AS query_id, text AS question FROM benchmark"
TURNS = "SELECT conv_id * 1000 + turn AS query_id, text AS question FROM conversations WHERE role = 'user'"


def _bm25(questions: str, k: int, pad: bool) -> str:
    """CTEs q and sparse(query_id, rank, chunk_id, score)."""
    pads = """
  UNION ALL
  SELECT q.query_id, m.chunk_id, m.doc_ord, m.chunk_index, 0.0
  FROM q, members m WHERE NOT EXISTS (
    SELECT 1 FROM scored s WHERE s.query_id = q.query_id AND s.chunk_id = m.chunk_id)"""
    return f"""
q AS ({questions}),
qt AS (SELECT query_id, term, count(*) AS qtf
       FROM (SELECT query_id, unnest({_tokens('question')}) AS term FROM q) GROUP BY query_id, term),
scored AS MATERIALIZED (
  SELECT query_id, chunk_id, doc_ord, chunk_index,
         sum(qtf * idf * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
  FROM qt JOIN weights USING (term) JOIN postings USING (term), corpus
  GROUP BY query_id, chunk_id, doc_ord, chunk_index),
every AS (SELECT * FROM scored{pads if pad else ''}),
sparse AS MATERIALIZED (
  SELECT query_id, chunk_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score * 1e9) DESC, doc_ord, chunk_index) AS rank
  FROM every QUALIFY rank <= {k})"""


def _hashed(source: str, key: str, text: str, name: str) -> str:
    """CTE name(key, pos, x): the non-zero entries of the hashed unit vector of each row."""
    return f"""
{name}_sums AS (
  SELECT {key}, CAST(('0x' || substr(md5(term), 1, 7)) AS BIGINT) % 64 AS pos,
         sum(CASE WHEN substr(md5(term), 8, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS w
  FROM (SELECT {key}, unnest({_tokens(text)}) AS term FROM {source}) GROUP BY {key}, pos),
{name} AS MATERIALIZED (
  SELECT {key}, CAST(pos AS INTEGER) AS pos, CAST(w / norm AS FLOAT) AS x
  FROM {name}_sums JOIN (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {name}_sums GROUP BY {key}) USING ({key})
  WHERE w <> 0)"""


DENSE = f"""
{_hashed('chunks', 'chunk_id', 'text', 'cv')},
{_hashed('q', 'query_id', 'question', 'qv')},
dots AS (SELECT query_id, chunk_id, sum(qv.x::DOUBLE * cv.x::DOUBLE) AS dot
         FROM qv JOIN cv USING (pos) GROUP BY query_id, chunk_id),
dense AS MATERIALIZED (
  SELECT q.query_id, m.chunk_id, coalesce(dot, 0.0) AS score,
         row_number() OVER (PARTITION BY q.query_id
                            ORDER BY round(coalesce(dot, 0.0) * 1e9) DESC, doc_ord, chunk_index) AS rank
  FROM q CROSS JOIN members m LEFT JOIN dots d ON d.query_id = q.query_id AND d.chunk_id = m.chunk_id
  QUALIFY rank <= 20)"""


def _fused(k: int) -> str:
    return f"""
merged AS (
  SELECT query_id, chunk_id, d.rank AS dense_rank, s.rank AS sparse_rank,
         coalesce(0.6::DOUBLE / (60 + d.rank), 0) + coalesce(0.4::DOUBLE / (60 + s.rank), 0) AS score
  FROM dense d FULL JOIN sparse s USING (query_id, chunk_id)),
fused AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score * 1e9) DESC,
                               dense_rank NULLS LAST, sparse_rank NULLS LAST) AS rank
  FROM merged QUALIFY rank <= {k}),
hits AS MATERIALIZED (SELECT f.*, c.doc_id, c.text FROM fused f JOIN chunks c USING (chunk_id))"""


def _dedup(threshold: float) -> str:
    """CTE kept(query_id, rank, chunk_id, score, doc_id, text, old_rank): a walk down each list."""
    words = f"list_distinct(list_filter(regexp_split_to_array(lower(text), '{WS}+'), lambda w: w <> ''))"
    return f"""
ws AS MATERIALIZED (SELECT query_id, rank, chunk_id, {words} AS w FROM hits),
alike AS MATERIALIZED (
  SELECT a.query_id, a.rank AS early, b.rank AS late
  FROM ws a JOIN ws b ON a.query_id = b.query_id AND a.rank < b.rank
  WHERE len(a.w) > 0 AND len(b.w) > 0
    AND len(list_intersect(a.w, b.w))::DOUBLE / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= {threshold}),
clash AS MATERIALIZED (
  SELECT query_id, late AS rank, list(early) AS earlier FROM alike GROUP BY query_id, late),
walk AS (
  SELECT query_id, CAST(1 AS BIGINT) AS rank, [CAST(1 AS BIGINT)] AS keep FROM hits WHERE rank = 1
  UNION ALL
  SELECT w.query_id, h.rank,
         CASE WHEN c.earlier IS NOT NULL AND list_has_any(c.earlier, w.keep) THEN w.keep
              ELSE list_append(w.keep, h.rank) END
  FROM walk w JOIN hits h ON h.query_id = w.query_id AND h.rank = w.rank + 1
  LEFT JOIN clash c ON c.query_id = h.query_id AND c.rank = h.rank),
last AS (SELECT query_id, arg_max(keep, rank) AS keep FROM walk GROUP BY query_id),
kept AS MATERIALIZED (
  SELECT h.query_id, row_number() OVER (PARTITION BY h.query_id ORDER BY h.rank) AS rank,
         h.chunk_id, h.score, h.doc_id, h.text
  FROM hits h JOIN last l ON l.query_id = h.query_id AND list_contains(l.keep, h.rank))"""


def _context(limit: int) -> str:
    return f"""
sized AS (
  SELECT query_id, rank, {_strip('text')} AS part,
         sum(length({_strip('text')})) OVER (PARTITION BY query_id ORDER BY rank) AS total FROM kept),
used AS (
  SELECT query_id, rank, CASE WHEN total <= {limit} THEN part
         ELSE substring(part, 1, CAST({limit} - (total - length(part)) AS BIGINT)) END AS part
  FROM sized WHERE total <= {limit} OR {limit} - (total - length(part)) > 50),
ctx AS (
  SELECT q.query_id, q.question,
         coalesce(string_agg(part, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY rank), '') AS context
  FROM q LEFT JOIN used USING (query_id) GROUP BY q.query_id, q.question)"""


def _hybrid(k: int = 20) -> str:
    return f"{POSTINGS}, {_bm25(BENCH, 20, True)}, {DENSE}, {_fused(k)}"


JUDGED = """
rel AS MATERIALIZED (
  SELECT query_id, chunk_id FROM q JOIN chunks ON contains(chunks.text, q.question))"""

METRICS = f"""{_hybrid()}, {JUDGED},
per AS (
  SELECT q.query_id,
    coalesce((SELECT 1.0::DOUBLE / min(rank) FROM fused f JOIN rel r USING (query_id, chunk_id)
              WHERE f.query_id = q.query_id), 0) AS reciprocal_rank,
    coalesce((SELECT count(*)::DOUBLE FROM fused f JOIN rel r USING (query_id, chunk_id)
              WHERE f.query_id = q.query_id AND rank <= 5)
             / nullif((SELECT count(*) FROM rel r WHERE r.query_id = q.query_id), 0), 0) AS recall,
    (SELECT count(*) FROM fused f JOIN rel r USING (query_id, chunk_id)
     WHERE f.query_id = q.query_id AND rank <= 5) / 5.0::DOUBLE AS precision
  FROM q)"""

VECTOR_TOP5 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.e, b.e) AS s FROM v a, v b)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s * 1e9) DESC, vec_id) AS rank,
       vec_id, round(s, 6) AS score
FROM d QUALIFY rank <= 5"""

# Cells by label: the centre is the mean direction, ties in score go to the lower cell.
LABEL_CELLS = """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m
          FROM (SELECT label, unnest(range(1, len(e) + 1)) AS pos, unnest(e) AS x FROM v) GROUP BY label, pos),
centers AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, list(m ORDER BY pos) AS c FROM means GROUP BY label),
near AS (
  SELECT vec_id, cell, row_number() OVER (
    PARTITION BY vec_id ORDER BY round(list_dot_product(e, c) / sqrt(list_dot_product(c, c)), 9) DESC, cell) AS place
  FROM v, centers),
stored AS (SELECT v.vec_id, e, cell FROM v JOIN near ON near.vec_id = v.vec_id AND place = 1)"""


def _probed(nprobe: int) -> str:
    return f"""
  SELECT query_id, vec_id, rank, s FROM (
    SELECT q.vec_id AS query_id, b.vec_id, list_dot_product(q.e, b.e) AS s,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.e, b.e) * 1e9) DESC, b.vec_id) AS rank
    FROM v q JOIN near p ON p.vec_id = q.vec_id AND p.place <= {nprobe} JOIN stored b ON b.cell = p.cell)
  WHERE rank <= 5"""


IVF_TOP5 = f"{LABEL_CELLS} SELECT query_id, rank, vec_id, round(s, 6) AS score FROM ({_probed(3)})"
CELL_SIZES = f"{LABEL_CELLS} SELECT cell, count(*) AS n FROM stored GROUP BY cell"
IVF_RECALL = f"""{LABEL_CELLS},
truth AS ({_probed(1 << 20)}),
found AS (SELECT 3 AS nprobe, * FROM ({_probed(3)}) UNION ALL SELECT 5 AS nprobe, * FROM ({_probed(5)}))
SELECT nprobe, round(avg(hits / 5.0::DOUBLE), 6) AS recall FROM (
  SELECT n.nprobe, truth.query_id, count(found.vec_id) AS hits
  FROM truth CROSS JOIN (VALUES (3), (5)) n(nprobe)
  LEFT JOIN found ON found.nprobe = n.nprobe AND found.query_id = truth.query_id AND found.vec_id = truth.vec_id
  GROUP BY n.nprobe, truth.query_id) GROUP BY nprobe"""

CHUNK_ROWS = f"{CHUNKS} SELECT chunk_id, start_char, end_char, text FROM chunks"
TERM_ROWS = f"{POSTINGS} SELECT term, df, round(idf, 6) AS idf FROM weights"
RANKED = "query_id, rank, chunk_id, round(score, 6) AS score"


# A written file ends with a line feed.
FILE_ROWS = "SELECT doc_id, text || chr(10) AS body, true AS placed FROM documents"


def oracles() -> dict[str, str]:
    url_name = "string_split(url, '/')[-1]"
    url_suffix = f"lower(regexp_extract({url_name}, '(?s)^.+(\\.[^.]+)$', 1))"
    answer = f"coalesce(h.text, 'No relevant documents found.') AS answer"
    return {
        "clean_text": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_clean('text')} AS cleaned FROM documents",
        "strip_pages": f"""SELECT page_id, CAST(length({_strip('CAST(html AS VARCHAR)')}) AS INTEGER) AS n_chars,
            {_clean('CAST(html AS VARCHAR)')} AS cleaned FROM pages""",
        "segments": f"{CHUNKS} SELECT doc_id, CAST(k - 1 AS INTEGER) AS seg_no, x AS segment FROM seg",
        "chunks": f"{CHUNKS} SELECT chunk_id, doc_id, chunk_index, start_char, end_char, text FROM chunks",
        "page_chunks": f"""WITH RECURSIVE {_chunk_ctes(PAGES)}
            SELECT chunk_id, chunk_index, start_char, end_char, text FROM chunks""",
        "chunk_counts": f"{CHUNKS} SELECT doc_id, count(*) AS n_chunks FROM chunks GROUP BY doc_id",
        "source_counts": f"""{CHUNKS} SELECT source, min(doc_ord) AS first_ord, count(*) AS n_chunks
            FROM chunks JOIN (SELECT CAST(doc_id AS VARCHAR) AS doc_id, source FROM documents) USING (doc_id)
            GROUP BY source""",
        "assemble_parts": f"""SELECT conv_id, string_agg(text, {NL} || {NL} ORDER BY turn) AS text
            FROM conversations WHERE text <> '' GROUP BY conv_id""",
        "default_doc_ids": """SELECT conv_id * 1000 + turn AS doc_ord,
            CASE WHEN turn = 0 THEN CAST(conv_id AS VARCHAR) ELSE 'text_' || (conv_id * 1000 + turn) END AS doc_id
            FROM conversations""",
        "metadata_map": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'lang' AS key, lang AS value FROM documents
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source', source FROM documents
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'n_chars', CAST(n_chars AS VARCHAR) FROM documents""",
        "path_parts": f"""SELECT page_id, {url_name} AS filename,
            left({url_name}, CAST(length({url_name}) - length({url_suffix}) AS BIGINT)) AS stem,
            {url_suffix} AS suffix, {url_suffix} IN ('.txt', '.md', '.pdf', '.docx') AS supported FROM pages""",
        "word_sets": f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
            len(list_distinct(list_filter(regexp_split_to_array(lower(text), '{WS}+'), lambda w: w <> ''))) AS n_words
            FROM documents""",
        "tokens": f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i - 1 AS INTEGER) AS pos, tk[i] AS token
            FROM (SELECT doc_id, tk, unnest(range(1, len(tk) + 1)) AS i
                  FROM (SELECT doc_id, {_tokens('text')} AS tk FROM documents))""",
        "postings": f"""{POSTINGS} SELECT term, chunk_id, CAST(tf AS INTEGER) AS tf, CAST(dl AS INTEGER) AS dl
            FROM postings""",
        "term_stats": TERM_ROWS,
        "corpus_stats": f"""{POSTINGS} SELECT n AS n_chunks, CAST(total AS BIGINT) AS total_len,
            round(avgdl, 6) AS avgdl, round(average_idf, 6) AS average_idf FROM corpus, mean""",
        "appended_term_stats": f"{POSTINGS} SELECT term, df FROM terms",
        "bm25_topk": f"{POSTINGS}, {_bm25(BENCH, 20, False)} SELECT {RANKED} FROM sparse",
        "bm25_padded": f"{POSTINGS}, {_bm25(TURNS, 20, True)} SELECT {RANKED} FROM sparse",
        "bm25_by_shard": f"{POSTINGS}, {_bm25(BENCH, 20, False)} SELECT {RANKED} FROM sparse",
        "bm25_work": f"""{POSTINGS}, {_bm25(BENCH, 20, False)}
            SELECT query_id, CAST(sum(df) AS BIGINT) AS matched, true AS bounded FROM qt JOIN terms USING (term) GROUP BY query_id""",
        "dense_topk": VECTOR_TOP5,
        "dense_topk_blocks": VECTOR_TOP5,
        "ivf_full_probe": VECTOR_TOP5,
        "ivf_exact": VECTOR_TOP5,
        "ivf_trained_recall": "SELECT unnest(['nprobe', 'bounds']) AS search, true AS reached, true AS saved",
        "vector_dimensions": """SELECT CAST(len(embedding) AS INTEGER) AS dim, count(*) AS n FROM embeddings
            GROUP BY len(embedding)""",
        "normalized_vectors": """WITH s AS (
              SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings),
            n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM s)
            SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(v[i] / norm, 6) AS x
            FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM n)""",
        "hashed_embeddings": f"""{CHUNKS}, {_hashed('chunks', 'chunk_id', 'text', 'cv')}
            SELECT chunk_id, pos, round(x::DOUBLE, 6) AS x FROM cv""",
        "embed_cache_misses": """SELECT sha256(text) AS key, count(*) AS n FROM documents
            WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en') GROUP BY 1""",
        "embed_cached": f"""WITH {_hashed('documents', 'doc_id', 'text', 'cv')}
            SELECT doc_id, pos, round(x::DOUBLE, 6) AS x FROM cv""",
        "embed_model": """WITH counted AS (
              SELECT doc_id, list_transform(['a', 'e', 'i', ' '],
                lambda c: 1 + length(text) - length(replace(text, c, '')))::DOUBLE[] AS v FROM documents),
            n AS (SELECT doc_id, v, sqrt(list_dot_product(v, v)) AS norm FROM counted)
            SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i - 1 AS INTEGER) AS pos, round(CAST(v[i] / norm AS FLOAT)::DOUBLE, 5) AS x
            FROM (SELECT *, unnest(range(1, 5)) AS i FROM n)""",
        "files_directory": FILE_ROWS,
        "files_list": FILE_ROWS,
        "inline_texts": """SELECT 'text_' || (row_number() OVER (ORDER BY item_id) - 1) AS doc_id,
            row_number() OVER (ORDER BY item_id) - 1 AS doc_ord, text FROM benchmark""",
        "text_keys": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS key FROM documents",
        "dense_chunks": f"{POSTINGS}, q AS ({BENCH}), {DENSE} SELECT {RANKED} FROM dense",
        "hybrid_rrf": f"""{_hybrid()} SELECT query_id, rank, chunk_id, CAST(dense_rank AS INTEGER) AS dense_rank,
            CAST(sparse_rank AS INTEGER) AS sparse_rank, round(score, 6) AS score FROM fused""",
        "dedup_hits": f"{_hybrid()}, {_dedup(0.95)} SELECT {RANKED} FROM kept",
        "dedup_hits_loose": f"{_hybrid()}, {_dedup(0.3)} SELECT {RANKED} FROM kept",
        "context": f"{_hybrid()}, {_dedup(0.95)}, {_context(2000)} SELECT query_id, context FROM ctx",
        "prompt": f"""{_hybrid()}, {_dedup(0.95)}, {_context(1200)}
            SELECT query_id, 'Answer the following question based only on the provided context. '
              || 'If the context does not contain enough information, say ''I don''t know''.' || {NL} || {NL}
              || 'Context:' || {NL} || context || {NL} || {NL} || 'Question: ' || question || {NL} || {NL}
              || 'Answer:' AS prompt FROM ctx""",
        "model_answer": f"""{_hybrid()}, {_dedup(0.95)}, {_context(1200)}, asked AS (
            SELECT query_id, 'Answer the following question based only on the provided context. '
              || 'If the context does not contain enough information, say ''I don''t know''.' || {NL} || {NL}
              || 'Context:' || {NL} || context || {NL} || {NL} || 'Question: ' || question || {NL} || {NL}
              || 'Answer:' AS prompt FROM ctx)
            SELECT query_id, length(prompt) || ':' || right(prompt, 40) AS answer FROM asked""",
        "extractive_answer": f"""{_hybrid()} SELECT q.query_id, q.question, {answer}
            FROM q LEFT JOIN hits h ON h.query_id = q.query_id AND h.rank = 1""",
        "report": f"""{_hybrid()} SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, chunk_id,
            replace(substring(text, 1, 120), {NL}, ' ') AS snippet FROM hits""",
        "source_rows": f"""{_hybrid()} SELECT query_id, CAST(rank AS INTEGER) AS rank, text, chunk_id, doc_id,
            round(score, 6) AS score, replace(substring(text, 1, 300), {NL}, ' ')
              || CASE WHEN length(text) > 300 THEN '…' ELSE '' END AS snippet FROM hits""",
        "hybrid_answer": f"""{_hybrid(5)}, {_dedup(0.95)}
            SELECT q.query_id, q.question, {answer}, coalesce(r.retrieved, '') AS retrieved
            FROM q LEFT JOIN kept h ON h.query_id = q.query_id AND h.rank = 1
            LEFT JOIN (SELECT query_id, string_agg(chunk_id, ',' ORDER BY rank) AS retrieved FROM kept
                       GROUP BY query_id) r ON r.query_id = q.query_id""",
        "bm25_answer": f"""{POSTINGS}, {_bm25(BENCH, 5, True)} SELECT q.query_id, q.question, {answer}
            FROM q LEFT JOIN (SELECT query_id, text FROM sparse JOIN chunks USING (chunk_id) WHERE rank = 1) h
              ON h.query_id = q.query_id""",
        "judgements": f"{CHUNKS}, q AS ({BENCH}), {JUDGED} SELECT query_id, chunk_id FROM rel",
        "retrieval_metrics": f"""{METRICS} SELECT query_id, round(reciprocal_rank, 6) AS reciprocal_rank,
            round(recall, 6) AS recall, round(precision, 6) AS precision FROM per""",
        "mean_metrics": f"""{METRICS} SELECT round(avg(reciprocal_rank), 6) AS mrr, round(avg(recall), 6) AS recall,
            round(avg(precision), 6) AS precision FROM per""",
        "ivf_topk": IVF_TOP5,
        "cell_sizes": CELL_SIZES,
        "ivf_recall": IVF_RECALL,
        "index_append": TERM_ROWS,
        "index_save_load": CHUNK_ROWS,
        "chunk_lookup": f"{CHUNK_ROWS} WHERE chunk_id = '1_0'",
        "index_upgrade": "SELECT 'v_' || vec_id AS chunk_id, true AS in_cell FROM embeddings",
        "stream_ingest": CHUNK_ROWS,
    }
