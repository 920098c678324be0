"""The same queries in SQL, for checking against another engine.

Written independently of the operators: lines are unnested rows, every document
is compared with window functions, models are plain joins.
"""

from __future__ import annotations

from tomeworks.functions.markup import FOOTER_PATTERNS, HEADER_PATTERNS
from tomeworks.functions.text import FUNCTION_WORDS
from tomeworks.operators.eligibility import HAND_PICKED_EXCLUSIONS
from tomeworks.operators.folds import SPLIT_PLANS
from tomeworks.plans import inputs


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _sql(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}" if ctes else select


def _split_case(plan: str) -> str:
    arms = " ".join(
        f"WHEN fold IN ({', '.join(map(str, members))}) THEN '{name}'"
        for name, members in SPLIT_PLANS[plan].items()
    )
    return f"CASE {arms} END"


TOKENS = r"tokens AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\W+')) AS token FROM documents)"
CLEAN = """clean AS (SELECT doc_id, regexp_replace(lower(token), '[.,;_]', '', 'g') AS term FROM tokens),
terms AS (SELECT doc_id, term FROM clean WHERE length(term) > 2 AND NOT regexp_full_match(term, '[0-9]+')
  AND regexp_replace(term, '[0-9.]', '', 'g') NOT IN ('th', 'st'))"""
COUNTS = "counts AS (SELECT doc_id, term, count(*) AS n FROM terms GROUP BY doc_id, term)"
TF = "tf AS (SELECT doc_id, term, n, n / max(n) OVER (PARTITION BY doc_id) AS tf FROM counts)"
DF = "df AS (SELECT term, count(*) AS df FROM counts GROUP BY term)"
ND = "nd AS (SELECT count(DISTINCT doc_id) AS n_docs FROM counts)"
IDF = "idf AS (SELECT term, df, ln(n_docs / df) AS idf FROM df, nd)"
PLAIN_IDF = "idf AS (SELECT term, df, n_docs / df AS idf FROM df, nd)"
TFIDF = "tfidf AS (SELECT doc_id, term, tf, idf, tf * idf AS tfidf FROM tf JOIN idf USING (term))"
_COUNTED = (TOKENS, CLEAN, COUNTS)
_WEIGHTED = (*_COUNTED, TF, DF, ND, IDF, TFIDF)


def _bucket(size: int = 10000) -> str:
    return f"CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % {size} AS INTEGER)"


_BYTES = "list_transform(range(1, strlen(term) + 1), lambda i: CAST('0x' || substr(hex(encode(term)), 2 * i - 1, 2) AS HUGEINT))"
STRING_HASH = f"""steps AS (SELECT term, xor(list_reduce(list_prepend({_BYTES}[1] * 128, {_BYTES}),
    lambda h, b: xor((h * 1000003) % 18446744073709551616, b)), CAST(strlen(term) AS HUGEINT)) AS h FROM df),
hashed AS (SELECT term, CAST(CASE WHEN h = 18446744073709551615 THEN -2 WHEN h >= 9223372036854775808
    THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS hash FROM steps),
placed AS (SELECT term, hash, CAST((hash % 10000 + 10000) % 10000 AS INTEGER) AS bucket FROM hashed)"""


def _sums(source: str, weight: str, size: int = 10000) -> str:
    return (
        f"sums AS (SELECT doc_id, {_bucket(size)} AS bucket, sum({weight}) AS w "
        f"FROM {source} GROUP BY 1, 2)"
    )


META = (
    f"meta AS (SELECT d.doc_id, [{', '.join(inputs.SUBJECT_PARTS[:2])}] || CASE WHEN l.doc_id IS NULL THEN [] "
    f"ELSE [{', '.join(inputs.SUBJECT_PARTS[2:])}] END AS subjects "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)
SUBJECT_ROWS = "subject_rows AS (SELECT doc_id, unnest(subjects) AS subject FROM meta)"
MANIFEST = """manifest AS (SELECT m.doc_id, m.subjects,
  CAST((row_number() OVER (ORDER BY m.doc_id) - 1) % 10 AS INTEGER) AS fold
  FROM meta m WHERE m.doc_id IN (SELECT doc_id FROM counts))"""
TOP = """top AS (SELECT subject, count(*) AS n FROM (SELECT unnest(subjects) AS subject FROM manifest)
  GROUP BY subject ORDER BY n DESC, subject LIMIT 10)"""
_RUN = (*_COUNTED, META, MANIFEST)
RECORD = "'ID=' || doc_id || ',' || array_to_string(subjects, ',')"
RECORDS = f"records AS (SELECT {RECORD} AS value FROM meta)"
LINE = "doc_id || '.tf,' || fold || ',' || " + RECORD


def _labelled(plan: str) -> str:
    return (
        f"labelled AS (SELECT * FROM (SELECT m.doc_id, {_split_case(plan)} AS split, t.subject, "
        "CAST(list_contains(m.subjects, t.subject) AS DOUBLE) AS label FROM manifest m, top t) "
        "WHERE split IS NOT NULL)"
    )


BAYES = """classes AS (SELECT subject, label, count(*) AS n FROM labelled WHERE split = 'train' GROUP BY 1, 2),
priors AS (SELECT subject, label, ln(n + 1) - ln(sum(n) OVER (PARTITION BY subject) + 2) AS pi FROM classes),
class_sums AS (SELECT subject, label, bucket, sum(w) AS w FROM labelled JOIN sums USING (doc_id)
  WHERE split = 'train' GROUP BY 1, 2, 3),
totals AS (SELECT subject, label, sum(w) AS total FROM class_sums GROUP BY 1, 2)"""
def _scores(size: int = 10000) -> str:
    return SCORES.replace("10000", str(size))


SCORES = """scores AS (SELECT l.doc_id, l.split, l.subject, l.label, p.label AS class,
  p.pi + sum(s.w * (ln(coalesce(c.w, 0) + 1) - ln(t.total + 10000))) AS score
  FROM labelled l JOIN priors p ON l.subject = p.subject
  JOIN totals t ON t.subject = p.subject AND t.label = p.label
  JOIN sums s ON s.doc_id = l.doc_id
  LEFT JOIN class_sums c ON c.subject = p.subject AND c.label = p.label AND c.bucket = s.bucket
  GROUP BY l.doc_id, l.split, l.subject, l.label, p.label, p.pi),
predicted AS (SELECT doc_id, split, subject, label, arg_max(class, score) AS prediction
  FROM scores GROUP BY 1, 2, 3, 4)"""


def _bayes(plan: str, size: int = 10000, idf: str = IDF) -> tuple[str, ...]:
    weighted = (*_COUNTED, TF, DF, ND, idf, TFIDF)
    return (*weighted, _sums("tfidf", "tfidf", size), META, MANIFEST, TOP, _labelled(plan), BAYES)


_PREDICTED = (*_bayes("7/2/1"), SCORES)
_CELLS = """cells AS (SELECT subject, split, count(*) AS n_docs,
  count(*) FILTER (label = 1 AND prediction = 1) AS true_pos,
  count(*) FILTER (label = 0 AND prediction = 1) AS false_pos,
  count(*) FILTER (label = 0 AND prediction = 0) AS true_neg,
  count(*) FILTER (label = 1 AND prediction = 0) AS false_neg FROM predicted GROUP BY 1, 2)"""
_MEASURES = """SELECT subject, split, n_docs, true_pos + false_neg AS positives, false_pos + true_neg AS negatives,
  true_pos, false_pos, true_neg, false_neg,
  round((false_pos + false_neg) / n_docs, 6) AS error_rate,
  round((true_pos + true_neg) / n_docs, 6) AS accuracy,
  round(true_pos / nullif(true_pos + false_neg, 0), 6) AS recall,
  round(true_pos / nullif(true_pos + false_pos, 0), 6) AS precision,
  round(true_neg / nullif(true_neg + false_pos, 0), 6) AS specificity"""


def _entries(plan: str, source: str, weight: str) -> str:
    ctes = (*_WEIGHTED, _sums(source, weight), META, MANIFEST, TOP, _labelled(plan))
    select = """SELECT doc_id, split, positives, bucket, round(w, 6) AS w FROM sums JOIN
      (SELECT doc_id, split, coalesce(string_agg(subject, '|' ORDER BY subject) FILTER (label = 1), '') AS positives
       FROM labelled GROUP BY doc_id, split) USING (doc_id)"""
    return _sql(*ctes, select=select)


_FIT = """SELECT subject, setting, train_docs, test_docs, validate_docs, train_positives,
  round(greatest(train_positives / train_docs, 1 - train_positives / train_docs), 6) AS train_majority,
  true AS reaches_majority FROM
  (SELECT subject, count(*) FILTER (split = 'train') AS train_docs, count(*) FILTER (split = 'test') AS test_docs,
   count(*) FILTER (split = 'validate') AS validate_docs,
   count(*) FILTER (split = 'train' AND label = 1) AS train_positives FROM labelled GROUP BY subject)"""


def _fits(settings: list[str], plan: str = "7/2/1", subjects: str = "true") -> str:
    values = ", ".join(f"('{s}')" for s in settings)
    select = f"{_FIT} CROSS JOIN (VALUES {values}) v(setting) WHERE {subjects}"
    return _sql(*_RUN, TOP, _labelled(plan), select=select)


def _embedding_fits(settings: list[str]) -> str:
    """Vectors that come ready-made; their labels are the subjects."""
    run = """manifest AS (SELECT vec_id AS doc_id, [CAST(label AS VARCHAR)] AS subjects,
      CAST((row_number() OVER (ORDER BY vec_id) - 1) % 10 AS INTEGER) AS fold FROM embeddings)"""
    values = ", ".join(f"('{s}')" for s in settings)
    return _sql(run, TOP, _labelled("7/2/1"), select=f"{_FIT} CROSS JOIN (VALUES {values}) v(setting)")


def _embedding_trees(depth: int, select: str) -> str:
    """Trees grown level by level over the ready-made vectors; node i has the children 2i and 2i + 1."""
    run = """manifest AS (SELECT vec_id AS doc_id, [CAST(label AS VARCHAR)] AS subjects,
      CAST((row_number() OVER (ORDER BY vec_id) - 1) % 10 AS INTEGER) AS fold FROM embeddings)"""
    entropy = lambda n, p: (
        f"(CASE WHEN {p} > 0 THEN -({p} / {n}) * log2({p} / {n}) ELSE 0 END"
        f" + CASE WHEN {p} < {n} THEN -(({n} - {p}) / {n}) * log2(({n} - {p}) / {n}) ELSE 0 END)"
    )
    levels = ["at0 AS MATERIALIZED (SELECT doc_id, split, subject, label, 1 AS node FROM labelled)"]
    for k in range(depth + 1):
        levels.append(f"""total{k} AS MATERIALIZED (SELECT subject, node, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS p
          FROM at{k} WHERE split = 'train' AND node >= {2**k} GROUP BY ALL)""")
        if k == depth:
            break
        levels.append(f"""best{k} AS MATERIALIZED (SELECT * FROM (SELECT *, round({entropy("n", "p")} - nl / n * {entropy("nl", "pl")}
            - (n - nl) / n * {entropy("(n - nl)", "(p - pl)")}, 12) AS gain FROM
          (SELECT subject, node, bucket, split_no, cut, n, p, CAST(count(*) FILTER (w <= cut) AS DOUBLE) AS nl,
             CAST(coalesce(sum(label) FILTER (w <= cut), 0) AS DOUBLE) AS pl
           FROM at{k} JOIN total{k} USING (subject, node) JOIN vals USING (doc_id) JOIN cuts USING (bucket)
           WHERE split = 'train' AND p > 0 AND p < n GROUP BY ALL) WHERE nl > 0 AND nl < n) WHERE gain > 0
          QUALIFY row_number() OVER (PARTITION BY subject, node ORDER BY gain DESC, bucket, split_no) = 1)""")
        levels.append(f"""at{k + 1} AS MATERIALIZED (SELECT a.doc_id, split, subject, label,
          CASE WHEN cut IS NULL THEN node ELSE 2 * node + CAST(w > cut AS INTEGER) END AS node
          FROM at{k} a LEFT JOIN best{k} USING (subject, node) LEFT JOIN vals v ON v.doc_id = a.doc_id AND v.bucket = best{k}.bucket)""")
    totals = " UNION ALL ".join(f"SELECT *, {k} AS depth FROM total{k}" for k in range(depth + 1))
    bests = " UNION ALL ".join(f"SELECT subject, node, bucket, cut, gain FROM best{k}" for k in range(depth))
    places = " UNION ALL ".join(f"SELECT *, {k} AS depth FROM at{k}" for k in range(depth + 1))
    return _sql(
        run,
        TOP,
        _labelled("7/2/1"),
        """vals AS MATERIALIZED (SELECT vec_id AS doc_id, generate_subscripts(embedding, 1) - 1 AS bucket,
          CAST(unnest(embedding) AS DOUBLE) AS w FROM embeddings)""",
        """value_lists AS (SELECT bucket, list({'v': w, 'c': c} ORDER BY w) AS l, sum(c) / 5 AS step FROM
          (SELECT bucket, w, CAST(count(*) AS DOUBLE) AS c FROM vals
           WHERE doc_id IN (SELECT doc_id FROM labelled WHERE split = 'train') GROUP BY bucket, w) GROUP BY bucket)""",
        """cut_lists AS (SELECT bucket, CASE WHEN len(l) <= 5
          THEN list_transform(range(1, len(l)), lambda i: (l[i].v + l[i + 1].v) / 2)
          ELSE list_reduce(l[2:], lambda a, x: {'seen': a.seen + x.c, 'before': x.v,
            'goal': CASE WHEN abs(a.seen - a.goal) < abs(a.seen + x.c - a.goal) THEN a.goal + step ELSE a.goal END,
            'found': CASE WHEN abs(a.seen - a.goal) < abs(a.seen + x.c - a.goal)
              THEN list_append(a.found, (a.before + x.v) / 2) ELSE a.found END},
            {'seen': l[1].c, 'before': l[1].v, 'goal': step, 'found': CAST([] AS DOUBLE[])}).found END AS found FROM value_lists)""",
        "cuts AS MATERIALIZED (SELECT bucket, unnest(found) AS cut, generate_subscripts(found, 1) AS split_no FROM cut_lists)",
        *levels,
        f"totals AS ({totals})",
        f"bests AS ({bests})",
        f"places AS ({places})",
        select=select,
    )


_TREE_NODES = """SELECT subject, node, depth, CAST(n AS BIGINT) AS n_docs, CAST(p AS BIGINT) AS positives,
  CASE WHEN p > n - p THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, CAST(bucket AS INTEGER) AS bucket,
  round(cut, 6) AS threshold, round(gain, 6) AS gain FROM totals LEFT JOIN bests USING (subject, node)"""
_TREE_ACCURACIES = """SELECT subject, CAST(places.depth AS VARCHAR) AS setting,
  round(avg(CAST((p > n - p) = (label = 1) AS INTEGER)) FILTER (split = 'train'), 6) AS train_accuracy,
  round(avg(CAST((p > n - p) = (label = 1) AS INTEGER)) FILTER (split = 'test'), 6) AS test_accuracy,
  round(avg(CAST((p > n - p) = (label = 1) AS INTEGER)) FILTER (split = 'validate'), 6) AS validate_accuracy,
  avg(CAST((p > n - p) = (label = 1) AS INTEGER)) FILTER (split = 'train')
    >= greatest(avg(label) FILTER (split = 'train'), 1 - avg(label) FILTER (split = 'train')) - 1e-9 AS reaches_majority
  FROM places JOIN totals USING (subject, node) WHERE places.depth IN (2, 3, 4) GROUP BY ALL"""


# Raw text with markers, its lines, and the marker lines.
MARKED = (
    f"marked AS (SELECT doc_id, doc_id AS seq, {inputs.FILE_NAME} AS file, {inputs.MARKED_TEXT} AS text FROM documents)"
)
LINES = """lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM marked))"""


def _first_line(patterns: list[str]) -> str:
    hits = ", ".join(
        f"min(line_no) FILTER (regexp_matches(line, '{p}'))" for p in patterns
    )
    return f"coalesce({hits})"


MARKS = (
    f"marks AS (SELECT doc_id, {_first_line(HEADER_PATTERNS)} AS header_line, "
    f"{_first_line(FOOTER_PATTERNS)} AS footer_line FROM lines GROUP BY doc_id)"
)
_MARKED = (MARKED, LINES, MARKS)
_BODY = """body AS (SELECT l.doc_id, l.line_no - m.header_line - 1 AS line_no, line, footer_line
  FROM lines l JOIN marks m ON l.doc_id = m.doc_id WHERE l.line_no > m.header_line
  AND (m.footer_line IS NULL OR m.footer_line = 0 OR l.line_no < m.footer_line))"""
_BODY_MD5 = """SELECT m.doc_id, md5(coalesce(string_agg(line, chr(10) ORDER BY line_no), '') ||
  CASE WHEN count(b.line_no) > 0 AND m.footer_line > 0 THEN chr(10) ELSE '' END) AS body_md5
  FROM marks m LEFT JOIN body b ON m.doc_id = b.doc_id WHERE m.header_line IS NOT NULL GROUP BY m.doc_id, m.footer_line"""
_ID_OF_LINE = (
    "regexp_replace(regexp_replace(substr(line, strpos(line, '{m}')), '\\].*', ''), '[^0-9]', '', 'g')"
)


def _book_id(markers: list[str]) -> str:
    arms = ", ".join(
        f"arg_min({_ID_OF_LINE.format(m=m)}, line_no) FILTER (contains(line, '{m}'))" for m in markers
    )
    return f"nullif(coalesce({arms}), '')"


BOOK_IDS = (
    f"book_ids AS (SELECT doc_id, {_book_id(['[EBook', '[Etext', '[eBook'])} AS book_id FROM lines GROUP BY doc_id)"
)


def _status(source: str, key: str, known: str) -> str:
    return f"""statuses AS (SELECT *, CASE WHEN {key} IS NULL THEN 'MISSING_ID'
      WHEN {key} NOT IN ({known}) THEN 'NO_META'
      WHEN row_number() OVER (PARTITION BY {key} ORDER BY doc_id) = 1 THEN 'GOOD' ELSE 'DUPLICATE' END AS status
      FROM {source})"""


_AUDIT = (MARKED, LINES, BOOK_IDS, _status("book_ids", "book_id", "SELECT CAST(doc_id AS VARCHAR) FROM labels"))

LISTING = (
    f"listing AS (SELECT {inputs.LISTING_LINE} AS value FROM documents)",
    "cols AS (SELECT string_split(regexp_replace(value, ' +', ' ', 'g'), ' ') AS c, value FROM listing)",
    """files AS (SELECT c[9] AS file, c[5] AS size_text,
      TRY_CAST(regexp_replace(c[5], '[^0-9.]', '', 'g') AS DOUBLE) AS number FROM cols WHERE contains(value, '.txt'))""",
    """sized AS (SELECT file, size_text, CASE WHEN size_text LIKE '%G' THEN number * 1024
      WHEN size_text LIKE '%M' THEN number WHEN size_text LIKE '%K' THEN number / 1024
      ELSE number / 1048576 END AS size_mb FROM files)""",
)
FILES = f"all_files AS (SELECT doc_id, {inputs.FILE_NAME} AS file FROM documents)"
FIRST_SEEN = """first_seen AS (SELECT term, min(doc_id) AS doc_id FROM counts GROUP BY term),
growth AS (SELECT c.doc_id, c.words, coalesce(f.new, 0) AS new FROM
  (SELECT doc_id, count(*) AS words FROM counts GROUP BY doc_id) c LEFT JOIN
  (SELECT doc_id, count(*) AS new FROM first_seen GROUP BY doc_id) f ON c.doc_id = f.doc_id)"""
PARTS = """arriving AS (SELECT term FROM counts WHERE doc_id % 2 = 1),
known AS (SELECT term, count(*) AS df FROM counts WHERE doc_id % 2 = 0 GROUP BY term)"""

def _histogram(value: str, ctes: tuple[str, ...] = (TOKENS,), source: str = "tokens", where: str = "true") -> str:
    return _sql(*ctes, select=f"SELECT {value} AS token, count(*) AS n FROM {source} WHERE {where} GROUP BY 1")


_VECTORS = (*_WEIGHTED, _sums("tfidf", "tfidf"), META, MANIFEST)

_STATUS_ROWS = _sql(*_AUDIT, select=f"""SELECT s.doc_id || '.txt' AS file, book_id AS doc_key, status, g.fold FROM statuses s LEFT JOIN
      (SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 10 AS INTEGER) AS fold FROM statuses WHERE status = 'GOOD') g
      ON s.doc_id = g.doc_id""")


ORACLES: dict[str, str] = {
    "s1_corpus_text": "SELECT doc_id, length(text) AS n_chars, len(string_split(text, chr(10))) AS n_lines FROM documents",
    "s2_recursive_text_files": """SELECT source, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
      CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines FROM documents GROUP BY source""",
    "s3_lines_with_partition_hint": """SELECT length(line) AS n_chars, count(*) AS n_lines
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
    "s4_manifest_lines": _sql(*_RUN, select="SELECT doc_id, doc_id || '.tf' AS file, fold, array_to_string(subjects, '|') AS subjects FROM manifest"),
    "s5_xml_metadata": _sql(META, select="SELECT doc_id, CAST(generate_subscripts(subjects, 1) - 1 AS INTEGER) AS pos, unnest(subjects) AS subject FROM meta"),
    "s5_many_record_files": _sql(META, select="SELECT doc_id, CAST(generate_subscripts(subjects, 1) - 1 AS INTEGER) AS pos, unnest(subjects) AS subject FROM meta"),
    "s6_saved_features": _sql(*_COUNTED, TF, select="SELECT doc_id, count(*) AS n_top, min(term) AS first_top FROM tf WHERE tf = 1 GROUP BY doc_id"),
    "s7_file_sizes": "SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source",
    "s7_directory_listing": _sql(*LISTING, select="SELECT file, size_text, round(size_mb, 6) AS size_mb FROM sized"),
    "s8_in_memory_names": _histogram("lower(token)", where=f"lower(token) IN ({_quoted(FUNCTION_WORDS)})"),
    "s9_fold_folders": _sql(*_VECTORS, select="SELECT doc_id, fold, count(*) AS n_buckets FROM sums JOIN manifest USING (doc_id) WHERE fold IN (7, 8, 9) GROUP BY 1, 2"),
    "k1_tf_table": _sql(*_COUNTED, select="SELECT doc_id, count(*) AS n_terms, CAST(sum(n) AS BIGINT) AS n_tokens FROM counts GROUP BY doc_id"),
    "k1_versioned_tf": _sql(*_COUNTED, select="SELECT doc_id, count(*) AS n_terms, CAST(sum(n) AS BIGINT) AS n_tokens FROM counts GROUP BY doc_id"),
    "k2_run_manifest": _sql(*_RUN, select=f"SELECT {LINE} AS line FROM manifest"),
    "k3_idf_manifest": _sql(*_RUN, select=f"SELECT {LINE} || ',' AS line FROM manifest ORDER BY doc_id LIMIT 100"),
    "k4_frequency_tables": _sql(*_COUNTED, DF, ND, IDF, select="SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "k5_fold_partitioned_vectors": _sql(*_VECTORS, select="SELECT fold, doc_id, bucket, round(w, 6) AS w FROM sums JOIN manifest USING (doc_id)"),
    "k6_metadata_csv": _sql(META, select=f"""SELECT outcome, count(*) AS n,
      CAST(sum(CASE WHEN outcome = 'written' THEN length({RECORD}) ELSE 0 END) AS BIGINT) AS n_chars FROM (SELECT *,
      CASE WHEN doc_id % 17 = 0 THEN 'unreadable' WHEN doc_id % 19 = 0 THEN 'no_id' ELSE 'written' END AS outcome FROM meta)
      GROUP BY outcome"""),
    "k7_subject_counts": _sql(META, SUBJECT_ROWS, select="SELECT subject, count(*) AS n FROM subject_rows GROUP BY subject"),
    "k8_status_table": _STATUS_ROWS,
    "k8_resumed_audit": _STATUS_ROWS,
    "k9_exclusion_list": _sql(*LISTING, select="SELECT 'TOOBIG' AS reason, file, size_text FROM sized WHERE size_mb > 2.5"),
    "k10_metrics_table": _sql(*_PREDICTED, select="SELECT subject, split, count(*) AS n_docs, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM predicted GROUP BY 1, 2"),
    "k10_metrics_runs": _sql(*_PREDICTED, select="SELECT subject, split, count(*) AS n_docs, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy, split AS run FROM predicted GROUP BY 1, 2"),
    "k10_vector_stats": _sql(*_WEIGHTED, META, MANIFEST, select="SELECT doc_id, fold, 10000 AS buckets, count(*) AS n_words FROM tfidf JOIN manifest USING (doc_id) GROUP BY doc_id, fold"),
    "s5_metadata_ranking": _sql(META, SUBJECT_ROWS, select="SELECT subject, count(*) AS n FROM subject_rows WHERE doc_id % 17 <> 0 GROUP BY subject"),
    "f1_document_id": _sql(MARKED, LINES, BOOK_IDS, select="SELECT doc_id, book_id FROM book_ids"),
    "f2_header_line": _sql(*_MARKED, select="SELECT doc_id, header_line FROM marks"),
    "f3_header_strip": _sql(*_MARKED, select="""SELECT l.doc_id, md5(string_agg(line, chr(10) ORDER BY l.line_no)) AS body_md5
      FROM lines l JOIN marks m ON l.doc_id = m.doc_id WHERE l.line_no > m.header_line GROUP BY l.doc_id"""),
    "f4_footer_line": _sql(*_MARKED, select="SELECT doc_id, footer_line FROM marks"),
    "f5_footer_strip": _sql(*_MARKED, _BODY, select=_BODY_MD5),
    "f6_body_lines": _sql(*_MARKED, _BODY, select="SELECT doc_id, line_no, md5(line) AS line_md5 FROM body WHERE length(line) > 0"),
    "f7_token_cleaning": _sql(TOKENS, CLEAN, select="SELECT term, count(*) AS n FROM terms GROUP BY term"),
    "f8_good_files": _sql(*_AUDIT, select="SELECT doc_id, doc_id || '.txt' AS file FROM statuses WHERE status = 'GOOD' AND doc_id % 29 <> 1"),
    "f9_exclusion_list": _sql(*LISTING, FILES, select=f"""SELECT doc_id, file FROM all_files
      WHERE file NOT IN (SELECT file FROM sized WHERE size_mb > 2.5) AND file NOT IN ({_quoted(HAND_PICKED_EXCLUSIONS)})"""),
    "f10_size_filter": _sql(*LISTING, select="SELECT file, size_text, size_text LIKE '%M' AS by_m_only FROM sized WHERE size_mb > 2.5"),
    "f11_txt_lines": _sql(*LISTING, select="SELECT count(*) AS n_txt FROM files"),
    "f12_document_cap": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "f13_fold_filter": _sql(*_RUN, select="SELECT doc_id, fold FROM manifest WHERE fold < 4"),
    "f14_non_empty": _sql(TOKENS, select="SELECT doc_id, count(*) AS n_tokens FROM tokens WHERE length(token) > 0 GROUP BY doc_id"),
    "f15_subject_label": _sql(META, select="SELECT doc_id, CAST(list_contains(subjects, 'quality:1') AS DOUBLE) AS label FROM meta"),
    "f16_rescale": _sql(*_WEIGHTED, select="SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf FROM tfidf"),
    "f17_listing_projection": _sql(*LISTING, select="SELECT file || ',' || size_text AS record FROM files"),
    "f18_id_normalisation": "SELECT doc_id, CAST(doc_id AS VARCHAR) AS from_about, CAST(doc_id AS VARCHAR) AS from_record, CAST(doc_id AS VARCHAR) AS from_file FROM documents",
    "j1_tf_idf_join": _sql(*_WEIGHTED, select="SELECT doc_id, term, tf, round(idf, 6) AS idf FROM tf JOIN idf USING (term)"),
    "j2_file_status_lookup": _sql(*_AUDIT, select="SELECT doc_id, doc_id || '.txt' AS file, status FROM statuses"),
    "j3_metadata_lookup": "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "j4_metadata_exists": "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents",
    "j5_duplicate_ids": _sql(*_AUDIT, select="SELECT doc_id AS seq, book_id AS doc_key FROM statuses WHERE status = 'DUPLICATE'"),
    "j6_manifest_vectors": _sql(*_COUNTED, TF, _sums("tf", "tf"), META, MANIFEST, select="SELECT doc_id, fold, bucket, round(w, 6) AS w FROM manifest JOIN sums USING (doc_id)"),
    "j7_label_prediction_rows": _sql(*_PREDICTED, select="SELECT doc_id, subject, label, prediction FROM predicted"),
    "j8_docs_by_subject": _sql(*_RUN, TOP, select="SELECT doc_id, fold, subject, CAST(list_contains(subjects, subject) AS DOUBLE) AS label FROM manifest, top"),
    "a1_term_counts": _sql(*_COUNTED, select="SELECT doc_id, term, n FROM counts"),
    "a2_max_term_count": _sql(*_COUNTED, select="SELECT doc_id, max(n) AS max_n FROM counts GROUP BY doc_id"),
    "a3_document_frequency": _sql(*_COUNTED, DF, select="SELECT term, df FROM df"),
    "a4_merged_frequencies": _sql(*_COUNTED, DF, select="SELECT term, df FROM df"),
    "a5_document_count": _sql(*_COUNTED, ND, select="SELECT n_docs FROM nd"),
    "a6_subject_frequency": _sql(*_RUN, select="SELECT subject, count(*) AS n FROM (SELECT unnest(subjects) AS subject FROM manifest) GROUP BY subject"),
    "a7_metadata_terms": _sql(META, RECORDS, select="SELECT term, count(*) AS n FROM (SELECT unnest(string_split(value, ',')) AS term FROM records) WHERE length(term) > 0 GROUP BY term"),
    "a8_status_histogram": _sql(*_AUDIT, select="SELECT status, count(*) AS n FROM statuses GROUP BY status"),
    "a9_audit_totals": _sql(*_AUDIT, select="""SELECT count(*) AS files, count(*) FILTER (status = 'DUPLICATE') AS duplicates,
      count(*) FILTER (status = 'MISSING_ID') AS no_id, count(*) FILTER (status = 'NO_META') AS no_meta FROM statuses"""),
    "a10_bucket_sums": _sql(*_COUNTED, TF, _sums("tf", "tf"), select="SELECT doc_id, bucket, round(w, 6) AS w FROM sums"),
    "a11_confusion_counts": _sql(*_PREDICTED, select="SELECT subject, split, label, prediction, count(*) AS n FROM predicted GROUP BY 1, 2, 3, 4"),
    "a12_accuracy": _sql(*_PREDICTED, select="SELECT subject, split, count(*) AS n_docs, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM predicted GROUP BY 1, 2"),
    "a13_binary_metrics": _sql(*_PREDICTED, _CELLS, select=_MEASURES + " FROM cells"),
    "a14_vocabulary_counts": _sql(*_COUNTED, FIRST_SEEN, select="SELECT doc_id, words, words - new AS already, new FROM growth"),
    "a15_split_sizes": _sql(*_RUN, select=f"SELECT {_split_case('7/2/1')} AS split, count(*) AS n_docs FROM manifest GROUP BY 1"),
    "a16_row_counts": _sql(*LISTING, select="""SELECT 'documents' AS what, count(*) AS n FROM documents
      UNION ALL SELECT 'metadata', count(*) FROM documents UNION ALL SELECT 'listing', count(*) FROM files
      UNION ALL SELECT 'oversize', count(*) FROM sized WHERE size_mb > 2.5"""),
    "w1_cyclic_folds": "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 10 AS INTEGER) AS fold FROM documents",
    "p1_eligible_corpus": _sql(*_AUDIT, MARKS, _BODY, *LISTING, select=f"""SELECT CAST(s.book_id AS BIGINT) AS doc_id, body_md5 FROM statuses s JOIN
      ({_BODY_MD5}) b ON s.doc_id = b.doc_id WHERE status = 'GOOD'
      AND s.doc_id || '.txt' NOT IN (SELECT file FROM sized WHERE size_mb > 2.5)
      AND s.doc_id || '.txt' NOT IN ({_quoted(HAND_PICKED_EXCLUSIONS)})"""),
    "w2_first_copy_status": _sql(
        "digests AS (SELECT doc_id, md5(text) AS doc_key FROM documents)",
        _status("digests", "doc_key", "SELECT doc_key FROM digests WHERE doc_id IN (SELECT doc_id FROM labels)"),
        select="SELECT doc_id AS seq, doc_key, status FROM statuses",
    ),
    "w3_vocabulary_growth": _sql(*_COUNTED, FIRST_SEEN, select="SELECT doc_id, new, CAST(sum(new) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS vocabulary FROM growth"),
    "w4_max_normalised": _sql(*_COUNTED, TF, select="SELECT doc_id, term, tf FROM tf"),
    "o1_top_subjects_of_run": _sql(*_RUN, TOP, select="SELECT subject, n FROM top"),
    "o3_sample_rows": _sql(*_WEIGHTED, select="SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf ORDER BY doc_id, term LIMIT 10"),
    "o2_subject_ranking": _sql(META, SUBJECT_ROWS, select="SELECT subject AS term, count(*) AS n FROM subject_rows GROUP BY 1 ORDER BY n DESC, term"),
    "o2_top_14_terms": _sql(META, SUBJECT_ROWS, select="SELECT subject AS term, count(*) AS n FROM subject_rows GROUP BY 1 ORDER BY n DESC, term LIMIT 14"),
    "u1_union_of_states": _sql(*_COUNTED, PARTS, select="SELECT df, count(*) AS n_rows FROM (SELECT term, df FROM known UNION ALL SELECT term, 1 FROM arriving) GROUP BY df"),
    "u2_known_terms": _sql(*_COUNTED, PARTS, select="SELECT term FROM arriving INTERSECT SELECT term FROM known"),
    "u3_new_terms": _sql(*_COUNTED, PARTS, select="SELECT term FROM arriving EXCEPT SELECT term FROM known"),
    "m1_term_frequency": _sql(*_COUNTED, TF, select="SELECT doc_id, term, n, tf FROM tf"),
    "m2_inverse_frequency": _sql(*_COUNTED, DF, ND, IDF, select="SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "m3_inverse_frequency_no_log": _sql(*_COUNTED, DF, ND, select="SELECT term, df, round(n_docs / df, 6) AS idf FROM df, nd"),
    "m4_tfidf": _sql(*_WEIGHTED, select="SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf"),
    "m4_top_tfidf_terms": _sql(*_WEIGHTED, select="""SELECT doc_id, term, tfidf, CAST(rank AS INTEGER) AS rank FROM
      (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank
       FROM (SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf)) WHERE rank <= 5"""),
    "m5_hash_vectors": _sql(*_WEIGHTED, _sums("tfidf", "tfidf"), select="SELECT doc_id, bucket, round(w, 6) AS w FROM sums"),
    "j1_arriving_vectors": _sql(*_WEIGHTED, _sums("tfidf", "tfidf"), select="SELECT doc_id, bucket, round(w, 6) AS w FROM sums"),
    "m5_hash_vectors_string": _sql(*_WEIGHTED, STRING_HASH, select="""SELECT doc_id, bucket, round(sum(tfidf), 6) AS w
      FROM tfidf JOIN placed USING (term) GROUP BY doc_id, bucket"""),
    "m5_hash_vectors_6000": _sql(*_WEIGHTED, _sums("tfidf", "tfidf", 6000), select="SELECT doc_id, bucket, round(w, 6) AS w FROM sums"),
    "m6_tf_training_set": _entries("4/3/3", "tf", "tf"),
    "m7_tfidf_training_set": _entries("7/2/1", "tfidf", "tfidf"),
    "m8_naive_bayes_model": _sql(*_bayes("7/3"), select="""SELECT t.subject, t.label, b.bucket,
      round(ln(coalesce(c.w, 0) + 1) - ln(t.total + 10000), 6) AS theta
      FROM totals t CROSS JOIN (SELECT DISTINCT bucket FROM class_sums) b
      LEFT JOIN class_sums c ON c.subject = t.subject AND c.label = t.label AND c.bucket = b.bucket"""),
    "m8_naive_bayes_priors": _sql(*_bayes("7/3"), select="SELECT subject, label, round(pi, 6) AS pi FROM priors"),
    "m9_naive_bayes_experiment": _sql(*_bayes("7/3"), SCORES, _CELLS, select=_MEASURES + ", 10000 AS buckets, true AS log_used FROM cells"),
    "m9_naive_bayes_no_log": _sql(*_bayes("7/3", idf=PLAIN_IDF), SCORES, _CELLS, select=_MEASURES + ", 10000 AS buckets, false AS log_used FROM cells"),
    "m9_naive_bayes_6000": _sql(*_bayes("7/3", 6000), _scores(6000), _CELLS, select=_MEASURES + ", 6000 AS buckets, true AS log_used FROM cells"),
    "m10_decision_tree": _fits(["3"], subjects="subject = (SELECT subject FROM top ORDER BY n DESC, subject LIMIT 1)"),
    "m10_embedding_tree_nodes": _embedding_trees(4, _TREE_NODES),
    "m11_embedding_tree_accuracies": _embedding_trees(4, _TREE_ACCURACIES),
    "m10_embedding_trees": _embedding_fits(["2", "3", "4"]),
    "m11_decision_tree_sweep": _fits(["2", "3", "4"]),
    "m11_decision_tree_tf_sweep": _fits([f"{n}/{d}" for n in (10000, 8000, 6000) for d in (2, 3, 4)], "4/3/3"),
    "m12_logistic_regression": _fits(["0.3"]),
    "m12_embedding_regressions": _embedding_fits(["0.01"]),
    "m13_logistic_regression_sweep": _fits(["0.3", "0.1", "0.01", "0.001"]),
    "m13_logistic_regression_tf_sweep": _fits([f"{n}/{r}" for n in (10000, 8000, 6000) for r in ("0.3", "0.01")], "4/3/3"),
    "m14_predictions": _sql(*_PREDICTED, select="SELECT doc_id, split, subject, label, prediction FROM predicted"),
    "m15_alternative_split": _sql(*_RUN, select=f"SELECT doc_id, fold, {_split_case('4/3/3')} AS split FROM manifest"),
    "x1_split_words": _histogram("token"),
    "x2_lower_case": _histogram("lower(token)"),
    "x3_strip_marks": _sql(select="SELECT regexp_replace(piece, '[.,;_]', '', 'g') AS token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS piece FROM documents) GROUP BY 1"),
    "x4_ordinals": _histogram("lower(token)", where="regexp_replace(lower(token), '[0-9.]', '', 'g') IN ('th', 'st')"),
    "x5_length_and_digits": _histogram("token", where="length(token) > 2 AND NOT regexp_full_match(token, '[0-9]+')"),
    "x6_function_words": _sql(*_COUNTED, DF, select=f"SELECT term, df FROM df WHERE term NOT IN ({_quoted(FUNCTION_WORDS)})"),
    "x7_line_search": """SELECT doc_id, count(*) FILTER (contains(line, 'the')) AS with_substring,
      count(*) FILTER (regexp_matches(line, '^[A-Z][a-z]+ ')) AS with_pattern
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
    "x8_cut_at_marker": _sql(MARKED, LINES, select=f"SELECT doc_id, {_book_id(['[Etext'])} AS etext_id FROM lines GROUP BY doc_id"),
    "x9_space_columns": _sql(*LISTING, select="SELECT c[1] AS mode, c[5] AS size_text, c[9] AS file FROM cols"),
    "x10_megabytes": _sql(*LISTING, select="SELECT size_text, round(max(size_mb), 6) AS size_mb FROM sized GROUP BY size_text"),
    "x11_comma_record": _sql(META, RECORDS, select="SELECT value AS record FROM records"),
    "x12_bare_field": "SELECT doc_id, lang FROM documents",
    "x13_md5_bucket": _sql(*_COUNTED, DF, select=f"SELECT term, {_bucket()} AS bucket FROM df"),
    "x13_string_bucket": _sql(*_COUNTED, DF, STRING_HASH, select="SELECT term, hash, bucket FROM placed"),
    "x14_arithmetic": "SELECT doc_id, round(ln(n_chars / (doc_id + 1)), 6) AS log, round(n_chars / (doc_id + 1) * 2.5::DOUBLE, 6) AS product FROM documents",
    "x15_comma_split": _sql(META, RECORDS, select="SELECT field, count(*) AS n FROM (SELECT unnest(string_split(value, ',')) AS field FROM records) GROUP BY field"),
    "t1_running_frequency": _sql(*_COUNTED, DF, select="SELECT term, df FROM df"),
    "t1_running_frequency_stateful": _sql(*_COUNTED, DF, select="SELECT term, df FROM df"),
}
