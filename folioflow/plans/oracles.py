"""The same answers as plain SQL over the given tables, for comparison."""

from __future__ import annotations

from folioflow.functions.chunking import SEPARATORS
from folioflow.functions.text import (
    ERROR_MARKER,
    EXTENSIONS,
    MISSING_EXTENSIONS,
    TRUNCATION_MARKER,
    WHITESPACE,
)
from folioflow.operators.chunks import SWEEP
from folioflow.operators.lifecycle import FAILURE_NOTE
from folioflow.operators.metrics import REPORT_FORMAT, RETRY_FORMAT
from folioflow.plans.fixtures import NOW
from folioflow.plans.queries import CYCLE_TIMES, SMALL_FILE
from folioflow.schemas import FILE_TYPES, STATUSES

SPACES = "(" + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"
SPACE_CLASS = "'[' || " + SPACES + " || ']+'"


def text(value: str) -> str:
    """A string literal whose line breaks survive."""
    quoted = value.replace("'", "''").replace("\n", "'||chr(10)||'")
    return f"('{quoted}')"


def names(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def at(moment) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


MARKER = text(TRUNCATION_MARKER)

DS = f"""ds AS (SELECT doc_id AS id,
  [{names(STATUSES)}][doc_id % 15 + 1] AS status,
  [{names(FILE_TYPES)}][(doc_id + doc_id // 15) % 18 + 1] AS file_type,
  CASE WHEN doc_id % 97 <> 0 THEN 'objects/' || source || '/' || doc_id END AS storage_path,
  CAST(doc_id % 50 AS VARCHAR) AS uploaded_by_user_id,
  CASE WHEN (doc_id // 15) % 5 <> 4 THEN CAST((doc_id // 15) % 5 AS INT) END AS retry_count,
  TIMESTAMP '2024-01-01' + to_minutes(((doc_id * 37) % 1440)::INT) AS updated_at,
  CASE WHEN (doc_id // 15) % 3 <> 0 THEN TIMESTAMP '2024-01-01'
    + to_seconds(((doc_id * 37) % 1440 * 60 - (doc_id % 600 + 1))::INT) END
    AS processing_started_at,
  CASE WHEN doc_id % 2 <> 0 THEN 'note' END AS processing_notes,
  n_chars AS file_size
  FROM documents)"""
CK = """ck AS (SELECT conv_id AS document_id, CAST(turn AS INT) AS chunk_index, text AS content,
  CASE WHEN (conv_id * 31 + turn) % 4 <> 0 THEN (conv_id * 31 + turn) % 500 END AS vec_id
  FROM conversations)"""
CF = """cf AS (SELECT c_custkey AS id,
  CASE WHEN c_custkey % 60 = 0 THEN '0' ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
  ['openai', 'OpenAI', 'vendor_b', 'openai'][c_custkey % 4 + 1] AS default_provider
  FROM customer)"""
PR = """pr AS (SELECT c_custkey * 10 + k AS id, c_custkey AS a_i_configuration_id,
  ['openai', 'OpenAI', 'vendor_b'][k + 1] AS provider, (c_custkey + k) % 4 <> 0 AS is_enabled
  FROM customer CROSS JOIN (VALUES (0), (1), (2)) v(k))"""


def level(source: str, name: str, sep: str, size: int) -> str:
    """One separator level: fold the pieces of every chunk that is still too long."""
    glue = text(sep)
    joined = f"(CASE WHEN acc[-1] = '' THEN p[1] ELSE acc[-1] || {glue} || p[1] END)"
    done = "(CASE WHEN acc[-1] = '' THEN acc[:-2] ELSE acc END)"
    fold = f"""list_reduce(
        list_transform(string_split(c, {glue}), lambda q: [q]),
        lambda acc, p: CASE WHEN length({joined}) <= {size}
          THEN list_append(acc[:-2], {joined}) ELSE list_append({done}, p[1]) END)"""
    return f"""{name} AS (SELECT doc_id, lang, flatten(list_transform(parts, lambda c:
      CASE WHEN length(c) <= {size} THEN [c]
      ELSE list_filter({fold}, lambda r: r <> '') END)) AS parts FROM {source})"""


def chunked(size: int, overlap: int, tag: str = "", source: str = "documents") -> str:
    """CTEs ending in ``chunks{tag}(document_id, chunk_index, content, lang)``."""
    steps = [
        f"l{tag}0 AS (SELECT doc_id, lang, [text] AS parts FROM {source} "
        f"WHERE {strip('text')} <> '')"
    ]
    for i, sep in enumerate(SEPARATORS):
        steps.append(level(f"l{tag}{i}", f"l{tag}{i + 1}", sep, size))
    last = f"l{tag}{len(SEPARATORS)}"
    steps.append(f"""cut{tag} AS (SELECT doc_id, lang, flatten(list_transform(parts, lambda c:
      list_transform(range(0, length(c), {size}), lambda i: substr(c, i + 1, {size})))) AS parts
      FROM {last})""")
    steps.append(f"""led{tag} AS (SELECT doc_id, lang, list_filter(
      list_transform(range(1, len(parts) + 1), lambda i: {strip(
        f"CASE WHEN i = 1 THEN parts[1] ELSE right(parts[i - 1], {overlap}) || ' ' || parts[i] END"
      )}), lambda c: length(c) > 10) AS parts FROM cut{tag})""")
    steps.append(f"""chunks{tag} AS (SELECT doc_id AS document_id,
      CAST(unnest(range(0, len(parts))) AS INT) AS chunk_index, unnest(parts) AS content, lang
      FROM led{tag})""")
    return ",\n".join(steps)


STATS = """COUNT(*) AS n_chunks, MIN(length(content))::INT AS min_chars,
  MAX(length(content))::INT AS max_chars, SUM(length(content))::BIGINT AS total_chars,
  ROUND(SUM(length(content)) / COUNT(*), 6) AS avg_chars"""


def buckets(keys: str, source: str, dim: int) -> str:
    """CTEs ending in ``vec(keys, bucket, value)`` of hashed word counts."""
    return f"""words AS (SELECT {keys}, unnest(regexp_split_to_array({strip('content')},
        {SPACE_CLASS})) AS w FROM {source}),
      hits AS (SELECT {keys},
        CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS INT) AS bucket, COUNT(*) AS n
        FROM words WHERE w <> '' GROUP BY ALL),
      vec AS (SELECT {keys}, bucket, CAST(n / SQRT(SUM(n * n) OVER (PARTITION BY {keys})) AS FLOAT)
        AS value FROM hits)"""


def assembled(limit: int) -> str:
    """CTEs ending in ``pages_text(document_id, text, n_pages)``."""
    part = f"""CASE WHEN length({strip('text')}) >= 50
      THEN chr(10) || '--- Página ' || (turn + 1) || ' ---' || chr(10) || text || chr(10)
      ELSE chr(10) || '--- Página ' || (turn + 1) || ' (OCR) ---' || chr(10)
        || 'scan ' || role || ' ' || text || chr(10) END"""
    return f"""joined AS (SELECT conv_id AS document_id, COUNT(*) AS n_pages,
      {strip(f"string_agg({part}, '' ORDER BY turn)")} AS whole FROM conversations GROUP BY 1),
      pages_text AS (SELECT document_id, n_pages, CASE WHEN length(whole) > {limit}
        THEN substr(whole, 1, {limit}) || {MARKER} ELSE whole END AS text FROM joined)"""


def ext(x: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"(CASE upper({x}) {whens} ELSE 'pdf' END)"


ALL_EXT = {**EXTENSIONS, **MISSING_EXTENSIONS}
OBJECTS = f"""objects AS (SELECT 'objects/' || source || '/' || doc_id AS path,
  strlen(text)::BIGINT AS length, text FROM documents WHERE source <> 'src3')"""


def outcome(limit: int, size: int = SMALL_FILE, tag: str = "") -> str:
    """CTEs (after ``ds``) ending in ``outcomes{tag}``: state, error, text per document."""
    plain = f"{ext('d.file_type', EXTENSIONS)} <> 'pdf'"
    clean = "regexp_replace(regexp_replace(o.text, chr(13) || chr(10), chr(10), 'g'),"
    clean += " chr(13), chr(10), 'g')"
    objects = "" if tag else f"{OBJECTS}, "
    return f"""{objects}judged{tag} AS (SELECT d.id, CASE
        WHEN coalesce(d.storage_path, '') = '' THEN 'no_storage_path'
        WHEN o.path IS NULL THEN 'not_found'
        WHEN o.length > {size} THEN 'too_large'
        WHEN NOT {plain} AND p.text IS NULL THEN 'not_extracted' END AS error,
        {plain} AS plain, CASE WHEN {plain} THEN {clean} ELSE p.text END AS raw
      FROM ds d LEFT JOIN objects o ON o.path = d.storage_path
      LEFT JOIN pages_text p ON p.document_id = d.id),
    outcomes{tag} AS (SELECT id AS document_id, error,
        CASE WHEN error IS NULL THEN 'Processed' ELSE 'TextExtractionFailed' END AS status,
        CASE WHEN error IS NULL AND plain THEN 'utf-8' END AS decoded_as,
        CASE WHEN error IS NULL THEN CASE WHEN length(raw) > {limit}
          THEN substr(raw, 1, {limit}) || {MARKER} ELSE raw END END AS text FROM judged{tag})"""


WHOLE = 10 * 1024 * 1024

LINES = """lines AS (SELECT event_id, CASE event_id % 11
  WHEN 0 THEN '{bad ' || event_type
  WHEN 1 THEN '[' || user_id || ']'
  WHEN 2 THEN '{"StoragePath":"objects/' || event_type || '"}'
  WHEN 3 THEN '{"DocumentId":"' || user_id || '","StoragePath":"objects/x","FileType":"PDF"}'
  WHEN 4 THEN '{"DocumentId":"' || event_type || '","StoragePath":"objects/x"}'
  WHEN 5 THEN '{"DocumentId":' || user_id || ',"StoragePath":""}'
  WHEN 6 THEN '{"DocumentId":' || user_id || ',"StoragePath":"p"} tail'
  WHEN 7 THEN '{"DocumentId":0,"StoragePath":"p"}'
  ELSE ' {"DocumentId": ' || user_id || ', "StoragePath": "objects/' || event_type
    || '", "FileType": 3}' END AS value FROM events),
 fields AS (SELECT event_id, value, json_valid(value) AS ok,
   CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END AS obj,
   CASE WHEN json_valid(value) THEN value->>'DocumentId' END AS did,
   CASE WHEN json_valid(value) THEN value->>'StoragePath' END AS storage_path,
   CASE WHEN json_valid(value) THEN value->>'FileType' END AS file_type FROM lines),
 judged AS (SELECT event_id, value, storage_path, file_type,
   CASE WHEN did <> '0' THEN TRY_CAST(did AS BIGINT) END AS document_id,
   CASE WHEN NOT ok THEN 'bad_json' WHEN NOT obj THEN 'not_an_object'
     WHEN coalesce(did, '') IN ('', '0') THEN 'no_document_id'
     WHEN TRY_CAST(did AS BIGINT) IS NULL THEN 'bad_document_id'
     WHEN coalesce(storage_path, '') = '' THEN 'no_storage_path' END AS reason FROM fields),
 parsed AS (SELECT *, CASE WHEN reason IS NULL THEN 'valid'
   WHEN reason = 'no_storage_path' THEN 'failed' ELSE 'dead_letter' END AS route FROM judged)"""

CANDIDATE = f"""status = 'TextExtractionFailed' AND coalesce(retry_count, 0) < 3
  AND updated_at < {at(NOW)} - INTERVAL 10 MINUTE"""
STUCK = f"status = 'ExtractingText' AND updated_at < {at(NOW)} - INTERVAL 30 MINUTE"
NOTE = text(FAILURE_NOTE.format(now=NOW, attempts=3))
SETTLED = f"""settled AS (SELECT id, coalesce(retry_count, 0) + 1 AS retry_count,
    processing_notes, CASE WHEN storage_path IS NULL OR file_size > 1000
      THEN 'TextExtractionFailed' ELSE 'Processed' END AS outcome FROM ds WHERE {CANDIDATE}),
  final AS (SELECT id, outcome <> 'Processed' AND retry_count >= 3 AS gave_up, outcome,
    retry_count, processing_notes FROM settled)"""

MICROS = "(epoch_us(updated_at) - epoch_us(processing_started_at))"
MEAN = f"""ROUND(coalesce(SUM({MICROS}) FILTER (WHERE status = 'Processed')
  / COUNT(processing_started_at) FILTER (WHERE status = 'Processed') / 1e6, 0.0), 6)"""
FIGURES = f"""COUNT(*) AS total_documents,
  COUNT(*) FILTER (WHERE status = 'Processed') AS processed_documents,
  COUNT(*) FILTER (WHERE status IN ('Failed', 'TextExtractionFailed')) AS failed_documents,
  COUNT(*) FILTER (WHERE status = 'TextExtractionFailed' AND coalesce(retry_count, 0) < 3)
    AS reprocessable_documents,
  {MEAN} AS avg_processing_time_seconds"""
PROGRESS = """COUNT(*) AS total_chunks, COUNT(vec_id) AS chunks_with_embeddings,
  ROUND(CASE WHEN COUNT(*) > 0 THEN COUNT(vec_id) / COUNT(*) * 100 ELSE 0.0 END, 6)
    AS embedding_completion_percent"""

BACKLOG = """backlog AS (SELECT c.document_id, c.chunk_index, c.content, d.uploaded_by_user_id
  FROM ck c JOIN ds d ON d.id = c.document_id WHERE c.vec_id IS NULL)"""
RESOLVED = """resolved AS (SELECT cf.user_id, MIN(pr.id) AS provider_config_id FROM cf
  JOIN pr ON pr.a_i_configuration_id = cf.id AND pr.provider = cf.default_provider
  WHERE pr.is_enabled AND lower(pr.provider) = 'openai' GROUP BY 1)"""
PLAN = f"""plan AS (SELECT b.*, r.provider_config_id,
    CASE WHEN r.provider_config_id IS NOT NULL THEN 'user' ELSE 'none' END AS credential_source,
    CASE WHEN coalesce({strip('b.content')}, '') = '' THEN 'blank'
      WHEN r.provider_config_id IS NULL THEN 'no_credential' ELSE 'ready' END AS embed_status
  FROM backlog b LEFT JOIN resolved r ON r.user_id = b.uploaded_by_user_id)"""

MEANS = """dims AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i,
    unnest(embedding)::DOUBLE AS v FROM embeddings),
  mean_dims AS (SELECT label, i, AVG(v) AS v FROM dims GROUP BY ALL),
  means AS (SELECT label::BIGINT AS query_id, list(v ORDER BY i) AS q FROM mean_dims GROUP BY 1),
  pairs AS (SELECT m.query_id, e.vec_id, list_distance(m.q, e.embedding::DOUBLE[]) AS distance
    FROM means m CROSS JOIN embeddings e)"""
RANKED = """SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, vec_id)
    AS INT) AS rank, vec_id, ROUND(distance, 6) AS distance"""

ACCOUNTS = """doomed AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
    WHERE c_nationkey < 12 EXCEPT SELECT uploaded_by_user_id FROM ds)"""
TOXIC = "toxic AS (SELECT doc_id FROM labels WHERE toxic = 1)"


def cycles() -> str:
    """CTEs for the retry cycles: ``done0..`` per cycle and ``s1..`` the state after each."""
    steps = ["s0 AS (SELECT id, status, coalesce(retry_count, 0) AS retry_count, updated_at,"
             " processing_started_at, processing_notes FROM ds)"]
    for i, now in enumerate(CYCLE_TIMES):
        note = text(FAILURE_NOTE.format(now=now, attempts=3))
        lost = "o.status <> 'Processed' AND s.retry_count + 1 >= 3"
        steps.append(f"""done{i} AS (SELECT s.id, s.retry_count + 1 AS retry_count,
            CASE WHEN {lost} THEN 'Failed' ELSE o.status END AS status,
            CASE WHEN {lost} THEN coalesce(s.processing_notes, '') || {note}
              ELSE s.processing_notes END AS processing_notes
          FROM s{i} s JOIN outcomes o ON o.document_id = s.id
          WHERE s.status = 'TextExtractionFailed' AND s.retry_count < 3
            AND s.updated_at < {at(now)} - INTERVAL 10 MINUTE)""")
        steps.append(f"""s{i + 1} AS (SELECT s.id, coalesce(d.status, s.status) AS status,
            coalesce(d.retry_count, s.retry_count) AS retry_count,
            CASE WHEN d.id IS NULL THEN s.updated_at ELSE {at(now)} END AS updated_at,
            s.processing_started_at,
            coalesce(d.processing_notes, s.processing_notes) AS processing_notes
          FROM s{i} s LEFT JOIN done{i} d USING (id))""")
    return ",\n".join(steps)


def audit_rows(table: str, figures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", {sql} FROM {table}" for column, sql in figures.items()
    )


STATE_COLUMNS = ["id", "status", "file_type", "storage_path", "uploaded_by_user_id", "retry_count",
                 "updated_at", "processing_started_at", "processing_notes", "file_size"]
LISTING = {  # column: (type, nullable, default)
    "file_size": ("bigint", False, "'0'"),
    "file_type": ("string", False, "NULL"),
    "id": ("bigint", False, "NULL"),
    "processing_notes": ("string", True, "''''''"),
    "processing_started_at": ("timestamp_ntz", True, "NULL"),
    "retry_count": ("int", True, "'0'"),
    "status": ("string", False, "'''Uploaded'''"),
    "storage_path": ("string", False, "NULL"),
    "updated_at": ("timestamp_ntz", False, "'now()'"),
    "uploaded_by_user_id": ("string", True, "NULL"),
}


def oracle_sql() -> dict[str, str]:
    main = chunked(1000, 200)
    counted = f"""{DS}, {assembled(WHOLE)}, {outcome(WHOLE)},
        ready AS (SELECT document_id AS doc_id, text, '' AS lang FROM outcomes
          WHERE status = 'Processed'),
        {chunked(1000, 200, source='ready')},
        counts AS (SELECT document_id, COUNT(*) AS n, SUM(length(content)) AS chars
          FROM chunks GROUP BY 1)"""
    processed = f"""WITH {counted}
        SELECT o.document_id, o.status, o.error, {at(NOW)} AS updated_at,
          coalesce(c.n, 0) AS n_chunks, coalesce(c.chars, 0)::BIGINT AS chunk_chars
        FROM outcomes o LEFT JOIN counts c USING (document_id) WHERE o.document_id <> 0"""
    roles = f"""WITH {DS}, {CF}, {PR}, {RESOLVED}, {assembled(WHOLE)}, {outcome(WHOLE)},
        {outcome(WHOLE, WHOLE, '_retry')},
        worked AS (SELECT d.id, coalesce(o.status, d.status) AS status, d.retry_count,
            CASE WHEN o.status IS NULL THEN d.updated_at ELSE {at(CYCLE_TIMES[0])} END AS updated_at,
            CASE WHEN o.status IS NULL THEN d.processing_started_at ELSE {at(CYCLE_TIMES[0])} END
              AS processing_started_at, d.uploaded_by_user_id, o.text
          FROM ds d LEFT JOIN outcomes o ON o.document_id = d.id AND d.id <> 0),
        tried AS (SELECT w.id, coalesce(w.retry_count, 0) + 1 AS retry_count, r.text,
            CASE WHEN r.status <> 'Processed' AND coalesce(w.retry_count, 0) + 1 >= 3
              THEN 'Failed' ELSE r.status END AS status
          FROM worked w JOIN outcomes_retry r ON r.document_id = w.id
          WHERE w.status = 'TextExtractionFailed' AND coalesce(w.retry_count, 0) < 3
            AND w.updated_at < {at(CYCLE_TIMES[1])} - INTERVAL 10 MINUTE),
        final AS (SELECT w.id, coalesce(t.status, w.status) AS status,
            coalesce(t.retry_count, w.retry_count) AS retry_count,
            CASE WHEN t.id IS NULL THEN w.updated_at ELSE {at(CYCLE_TIMES[1])} END AS updated_at,
            w.processing_started_at, w.uploaded_by_user_id, coalesce(t.text, w.text) AS text
          FROM worked w LEFT JOIN tried t USING (id)),
        ready AS (SELECT id AS doc_id, text, '' AS lang FROM final WHERE text IS NOT NULL),
        {chunked(1000, 200, source='ready')},
        ck AS (SELECT c.document_id, CASE WHEN r.provider_config_id IS NOT NULL THEN 1 END AS vec_id
          FROM chunks c JOIN final f ON f.id = c.document_id
          LEFT JOIN resolved r ON r.user_id = f.uploaded_by_user_id)"""
    replaced = f"""WITH good AS (SELECT * FROM documents WHERE doc_id IN
              (SELECT doc_id FROM labels WHERE quality = 1)),
            {chunked(1000, 200, source='good')}, {CK}
            SELECT document_id, chunk_index, content FROM chunks UNION ALL
            SELECT document_id, chunk_index, content FROM ck
            WHERE document_id NOT IN (SELECT document_id FROM chunks)"""
    role_metrics = f"""{roles}, a AS (SELECT {FIGURES} FROM final),
            b AS (SELECT {PROGRESS} FROM ck)
            SELECT {at(CYCLE_TIMES[2])} AS "timestamp", a.*, b.* FROM a CROSS JOIN b"""
    return {
        "four_roles": f"""{roles}, n AS (SELECT document_id, COUNT(*) AS n_chunks,
              COUNT(vec_id) AS n_vectors FROM ck GROUP BY 1)
            SELECT id, status, retry_count, updated_at, coalesce(n_chunks, 0) AS n_chunks,
              coalesce(n_vectors, 0) AS n_vectors FROM final LEFT JOIN n ON n.document_id = id""",
        "four_roles_metrics": role_metrics,
        "metrics_ledger": role_metrics,
        "chunk_documents": f"WITH {main} SELECT document_id, chunk_index, content FROM chunks",
        "chunk_sweep": "WITH "
        + ", ".join(chunked(size, lap, str(i)) for i, (size, lap, _) in enumerate(SWEEP))
        + " ".join(
            f"{'UNION ALL' if i else ''} SELECT document_id, '{name}' AS setting, {STATS}"
            f" FROM chunks{i} GROUP BY 1"
            for i, (_, _, name) in enumerate(SWEEP)
        ),
        "chunk_stats_by_lang": f"WITH {main} SELECT lang, {STATS} FROM chunks GROUP BY 1",
        "chunk_preview": f"""WITH {CK} SELECT document_id, chunk_index,
            CAST(length(content) AS INT) AS n_chars,
            CASE WHEN length(content) > 100 THEN left(content, 100) || '...' ELSE content END
              AS preview FROM ck""",
        "build_chunk_table": f"""WITH {main},
            {buckets('document_id, chunk_index', 'chunks', 768)}
            SELECT c.document_id, c.chunk_index, CAST(length(any_value(c.content)) AS INT) AS n_chars,
              768 AS dim, CAST(COUNT(v.bucket) AS INT) AS n_buckets, {at(NOW)} AS created_at
            FROM chunks c LEFT JOIN vec v USING (document_id, chunk_index) GROUP BY 1, 2""",
        "chunk_replace": replaced,
        "chunk_replace_buckets": replaced,
        "summarize_text": """SELECT doc_id, CASE WHEN length(text) > 1000
            THEN left(text, 1000) || '...' ELSE text END AS summary FROM documents""",
        "truncate_text": f"""SELECT doc_id, CASE WHEN length(text) > 2000
              THEN left(text, 2000) || {MARKER} ELSE text END AS truncated,
            CASE WHEN lang = 'en' AND length(text) > 500 THEN left(text, 500) || {MARKER}
              ELSE text END AS stored FROM documents""",
        "strip_and_blank": f"""SELECT doc_id,
            {strip("chr(12288) || chr(28) || ' ' || text || chr(9) || chr(8195)")} AS stripped,
            {strip("regexp_replace(text, '[a-m]', ' ', 'g')")} = '' AS blank FROM documents""",
        "extraction_error": f"""SELECT doc_id, starts_with(CASE WHEN lang = 'fr'
              THEN '{ERROR_MARKER}: ' || text ELSE text END, '{ERROR_MARKER}') AS is_error
            FROM documents""",
        "file_type_extension": f"""WITH {DS} SELECT id, {ext('file_type', EXTENSIONS)} AS extension,
            {ext('file_type', ALL_EXT)} AS complete_extension, 'pdf' AS numeric_extension FROM ds""",
        "route_extractor": f"""WITH {DS}, e AS (SELECT file_type,
              {ext('file_type', ALL_EXT)} AS extension FROM ds)
            SELECT file_type, extension, CASE WHEN extension = 'pdf' THEN 'pages'
              WHEN extension IN ('png', 'jpg', 'jpeg', 'tiff', 'bmp', 'gif') THEN 'image'
              ELSE 'text' END AS extractor, COUNT(*) AS n FROM e GROUP BY ALL""",
        "decode_bytes": """SELECT doc_id, regexp_replace(regexp_replace(text, chr(13) || chr(10),
              chr(10), 'g'), chr(13), chr(10), 'g') AS text,
            CASE WHEN lang <> 'en' AND regexp_full_match(text, '(?s)[\\x{00}-\\x{FF}]*')
              AND NOT regexp_full_match(text, '(?s)[\\x{00}-\\x{7F}]*')
              THEN 'latin-1' ELSE 'utf-8' END AS decoded_as FROM documents""",
        "assemble_pages": f"WITH {assembled(WHOLE)} SELECT document_id, text, n_pages"
        " FROM pages_text",
        "assemble_pages_limited": f"WITH {assembled(1500)} SELECT document_id, text, n_pages"
        " FROM pages_text",
        "queue_parse": f"WITH {LINES} SELECT event_id, document_id, storage_path, file_type, route,"
        " reason FROM parsed",
        "queue_dead_letter": f"WITH {LINES} SELECT event_id, value, reason FROM parsed"
        " WHERE route = 'dead_letter'",
        "queue_deliverable": f"""WITH {LINES}, best AS (SELECT document_id, storage_path, file_type,
              ROW_NUMBER() OVER (PARTITION BY document_id ORDER BY event_id DESC) AS r FROM parsed WHERE route <> 'dead_letter')
            SELECT document_id, storage_path, file_type FROM best WHERE r = 1""",
        "fetch_outcome": f"""WITH {DS}, {OBJECTS} SELECT d.id AS document_id, o.length,
            CASE WHEN o.length IS NULL THEN 'missing' WHEN o.length > {SMALL_FILE} THEN 'too_large'
              ELSE 'fetched' END AS outcome, md5(o.text) AS digest
            FROM ds d LEFT JOIN objects o ON o.path = d.storage_path""",
        "process_outcome": f"""WITH {DS}, {assembled(WHOLE)}, {outcome(3000)}
            SELECT document_id, status, error, decoded_as, md5(text) AS text_digest,
              CAST(CASE WHEN length(text) > 1000 THEN 1003 ELSE length(text) END AS INT)
                AS summary_chars FROM outcomes""",
        "fetch_stored": f"""WITH {DS}, {OBJECTS} SELECT d.id AS document_id, o.length,
            CASE WHEN o.length IS NULL THEN 'missing' WHEN o.length > {SMALL_FILE} THEN 'too_large'
              ELSE 'fetched' END AS outcome,
            CASE WHEN o.length <= {SMALL_FILE} THEN md5(o.text) END AS digest
            FROM ds d LEFT JOIN objects o ON o.path = d.storage_path""",
        "process_stored": f"""WITH {DS}, {assembled(WHOLE)}, {outcome(3000)}
            SELECT document_id, status, error, decoded_as, md5(text) AS text_digest,
              CAST(CASE WHEN length(text) > 1000 THEN 1003 ELSE length(text) END AS INT)
                AS summary_chars FROM outcomes""",
        "process_outcome_parity": f"""WITH {DS}, {OBJECTS}, judged AS (SELECT CASE
              WHEN coalesce(d.storage_path, '') = '' THEN 'no_storage_path'
              WHEN o.path IS NULL THEN 'not_found'
              WHEN o.length > {SMALL_FILE} THEN 'too_large' END AS error,
              {ext('d.file_type', EXTENSIONS)} = 'pdf' OR o.text = '' AS hollow
            FROM ds d LEFT JOIN objects o ON o.path = d.storage_path)
            SELECT CASE WHEN error IS NULL THEN 'Processed' ELSE 'TextExtractionFailed' END
              AS status, error, CASE WHEN error IS NULL THEN hollow END AS empty_text,
              COUNT(*) AS n FROM judged GROUP BY ALL""",
        "status_merge": f"""WITH {DS}, c AS (SELECT user_id AS id, ts, event_id,
              CASE event_type WHEN 'error' THEN 'TextExtractionFailed'
                WHEN 'purchase' THEN 'Processed' WHEN 'view' THEN 'Queued'
                ELSE 'ExtractingText' END AS status,
              CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS note FROM events),
            l AS (SELECT id, arg_max(status, (ts, event_id)) AS status, MAX(ts) AS ts,
              arg_max(note, (ts, event_id)) FILTER (WHERE note IS NOT NULL) AS note
              FROM c GROUP BY 1)
            SELECT d.id, coalesce(l.status, d.status) AS status,
              coalesce(l.ts, d.updated_at) AS updated_at,
              coalesce(l.note, d.processing_notes) AS processing_notes, d.retry_count
            FROM ds d LEFT JOIN l USING (id)""",
        "vector_text": """SELECT vec_id, CAST(unnest(range(0, len(embedding))) AS INT) AS pos,
            ROUND(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings""",
        "vector_write_back": f"""WITH {CK}, fresh AS (SELECT * FROM ck WHERE vec_id IS NULL),
            {buckets('document_id, chunk_index', 'fresh', 64)},
            n AS (SELECT document_id, chunk_index, COUNT(*) AS n FROM vec GROUP BY ALL)
            SELECT c.document_id, c.chunk_index,
              CAST(CASE WHEN c.vec_id IS NULL THEN 64 ELSE len(e.embedding) END AS INT) AS dim,
              CAST(CASE WHEN c.vec_id IS NULL THEN coalesce(n.n, 0)
                ELSE len(list_filter(e.embedding, lambda v: v <> 0)) END AS INT) AS n_nonzero
            FROM ck c LEFT JOIN embeddings e USING (vec_id)
            LEFT JOIN n USING (document_id, chunk_index)""",
        "insert_defaults": f"""WITH {DS}, k AS (SELECT 'doc_' || id || '.pdf' AS f, updated_at
              FROM ds, range(2))
            SELECT (SELECT MAX(id) FROM ds) + ROW_NUMBER() OVER (ORDER BY substr(md5(f), 1, 4), f)
                AS id, f AS processed_file_name, 'TextExtractionFailed' AS status,
              0 AS retry_count, updated_at, {at(NOW)} AS created_at, '' AS original_file_name,
              0::BIGINT AS file_size, '' AS summary, '' AS processing_notes,
              NULL::VARCHAR AS text_extracted FROM k""",
        "domain_audit": f"""WITH {DS} SELECT 'status' AS "column", status AS value, COUNT(*) AS n,
              status IN ({names(STATUSES)}) AS known FROM ds GROUP BY ALL
            UNION ALL SELECT 'file_type', CASE WHEN id % 7 = 0 THEN 'ODT' ELSE file_type END AS v,
              COUNT(*), v IN ({names(FILE_TYPES)}) FROM ds GROUP BY ALL""",
        "stuck_documents": f"WITH {DS} SELECT id, storage_path, file_type, updated_at FROM ds"
        f" WHERE {STUCK}",
        "stuck_documents_top": f"WITH {DS} SELECT id, storage_path, file_type, updated_at FROM ds"
        f" WHERE {STUCK} ORDER BY updated_at, id LIMIT 10",
        "stuck_to_failed": f"""WITH {DS} SELECT id, CASE WHEN {STUCK} THEN 'TextExtractionFailed'
              ELSE status END AS status, CASE WHEN {STUCK} THEN {at(NOW)} ELSE updated_at END
              AS updated_at FROM ds""",
        "retry_candidates": f"""WITH {DS} SELECT id, storage_path, file_type,
            coalesce(retry_count, 0) AS retry_count, updated_at FROM ds WHERE {CANDIDATE}""",
        "retry_candidates_top": f"""WITH {DS} SELECT id, storage_path, file_type,
            coalesce(retry_count, 0) AS retry_count, updated_at FROM ds WHERE {CANDIDATE}
            ORDER BY updated_at, id LIMIT 10""",
        "retry_increment": f"""WITH {DS} SELECT id,
            CASE WHEN {CANDIDATE} THEN 'ExtractingText' ELSE status END AS status,
            CASE WHEN {CANDIDATE} THEN coalesce(retry_count, 0) + 1 ELSE retry_count END
              AS retry_count,
            CASE WHEN {CANDIDATE} THEN {at(NOW)} ELSE updated_at END AS updated_at FROM ds""",
        "retry_outcome": f"""WITH {DS}, {SETTLED} SELECT id,
            CASE WHEN gave_up THEN 'Failed' ELSE outcome END AS status, retry_count,
            {at(NOW)} AS updated_at, CASE WHEN gave_up THEN coalesce(processing_notes, '') || {NOTE}
              ELSE processing_notes END AS processing_notes FROM final""",
        "cycle_stats": f"""WITH {DS}, {SETTLED} SELECT COUNT(*) AS total_found,
            COUNT(*) FILTER (WHERE outcome = 'Processed') AS reprocessed_successfully,
            COUNT(*) FILTER (WHERE outcome <> 'Processed') AS reprocessing_failed,
            COUNT(*) FILTER (WHERE gave_up) AS permanently_failed FROM final""",
        "exhausted_limbo": f"""WITH {DS} SELECT id, retry_count, updated_at FROM ds
            WHERE status = 'TextExtractionFailed' AND coalesce(retry_count, 0) >= 3""",
        "limbo_to_failed": f"""WITH {DS}, l AS (SELECT *, status = 'TextExtractionFailed'
              AND coalesce(retry_count, 0) >= 3 AS lost FROM ds)
            SELECT id, CASE WHEN lost THEN 'Failed' ELSE status END AS status,
              CASE WHEN lost THEN {at(NOW)} ELSE updated_at END AS updated_at FROM l""",
        "count_documents": f"WITH {DS} SELECT COUNT(*) AS total_documents FROM ds",
        "docs_by_status": f"WITH {DS} SELECT status, COUNT(*) AS n FROM ds GROUP BY 1",
        "failed_by_retry": f"""WITH {DS} SELECT coalesce(retry_count, 0) AS retry_count,
            COUNT(*) AS n FROM ds WHERE status = 'TextExtractionFailed'
            GROUP BY coalesce(retry_count, 0)""",
        "reprocessable": f"""WITH {DS} SELECT COUNT(*) AS reprocessable_documents FROM ds
            WHERE status = 'TextExtractionFailed' AND coalesce(retry_count, 0) < 3""",
        "mean_processing_time": f"WITH {DS} SELECT {MEAN} AS avg_processing_time_seconds FROM ds",
        "total_failed": f"""WITH {DS} SELECT COUNT(*) AS total_failed FROM ds
            WHERE status IN ('Failed', 'TextExtractionFailed')""",
        "status_by_retry": f"""WITH {DS} SELECT status, retry_count, COUNT(*) AS n FROM ds
            WHERE status IN ('Failed', 'TextExtractionFailed') GROUP BY ALL""",
        "embedding_progress": f"WITH {CK} SELECT {PROGRESS} FROM ck",
        "metrics_snapshot": f"""WITH {DS}, {CK}, a AS (SELECT {FIGURES} FROM ds),
            b AS (SELECT {PROGRESS} FROM ck)
            SELECT {at(NOW)} AS "timestamp", a.*, b.* FROM a CROSS JOIN b""",
        "metrics_report": f"""WITH {DS}, {CK}, a AS (SELECT {FIGURES} FROM ds),
            b AS (SELECT {PROGRESS} FROM ck), f AS (SELECT coalesce(retry_count, 0) AS r,
              COUNT(*) AS n FROM ds WHERE status = 'TextExtractionFailed' GROUP BY 1)
            SELECT printf({text(REPORT_FORMAT)}, total_documents, processed_documents,
              failed_documents, reprocessable_documents, avg_processing_time_seconds, total_chunks,
              chunks_with_embeddings, embedding_completion_percent) AS report,
              (SELECT string_agg(printf({text(RETRY_FORMAT)}, n, r), ', ' ORDER BY r) FROM f)
                AS retry_detail FROM a CROSS JOIN b""",
        "status_count_map": f"""WITH {DS}, a AS (SELECT status, COUNT(*) AS n FROM ds GROUP BY 1),
            f AS (SELECT coalesce(retry_count, 0) AS r, COUNT(*) AS n FROM ds
              WHERE status = 'TextExtractionFailed' GROUP BY 1)
            SELECT (SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM a)
                AS status_counts,
              (SELECT string_agg(r || '=' || n, ',' ORDER BY r) FROM f) AS failed_by_retry_count""",
        "embed_hash": f"""WITH {CK}, {buckets('document_id, chunk_index', 'ck', 768)}
            SELECT document_id, chunk_index, bucket, ROUND(value::DOUBLE, 6) AS value FROM vec""",
        "embedding_backlog": f"""WITH {DS}, {CK}, {BACKLOG}
            SELECT document_id, chunk_index, content, uploaded_by_user_id FROM backlog""",
        "embedding_backlog_top": f"""WITH {DS}, {CK}, {BACKLOG}
            SELECT document_id, chunk_index, content, uploaded_by_user_id FROM backlog
            ORDER BY document_id, chunk_index LIMIT 10""",
        "resolve_provider": f"WITH {CF}, {PR}, {RESOLVED} SELECT * FROM resolved",
        "backfill_plan": f"""WITH {DS}, {CK}, {CF}, {PR}, {BACKLOG}, {RESOLVED}, {PLAN}
            SELECT document_id, chunk_index, uploaded_by_user_id, provider_config_id,
              credential_source, embed_status FROM plan""",
        "backfill_vectors": f"""WITH {DS}, {CK}, {CF}, {PR}, {BACKLOG}, {RESOLVED}, {PLAN},
            ready AS (SELECT * FROM plan WHERE embed_status = 'ready'),
            {buckets('document_id, chunk_index', 'ready', 1536)}
            SELECT p.document_id, p.chunk_index, CASE WHEN any_value(p.embed_status) = 'ready'
                THEN 'embedded' ELSE any_value(p.embed_status) END AS embed_status, 1536 AS dim,
              CAST(COUNT(v.bucket) AS INT) AS n_nonzero
            FROM plan p LEFT JOIN vec v USING (document_id, chunk_index) GROUP BY 1, 2""",
        "dimension_audit": """SELECT CAST(len(embedding) AS INT) AS dim, COUNT(*) AS n,
            len(embedding) <> 768 AS unexpected FROM embeddings GROUP BY ALL""",
        "vector_topk": f"WITH {MEANS} {RANKED} FROM pairs QUALIFY rank <= 10",
        "vector_topk_kmeans": f"WITH {MEANS} {RANKED} FROM pairs QUALIFY rank <= 10",
        "vector_topk_codes": f"WITH {MEANS} {RANKED} FROM pairs QUALIFY rank <= 10",
        "vector_codes_recall": """WITH e AS (SELECT COUNT(*) AS n FROM embeddings)
            SELECT COUNT(*) AS n_queries, COUNT(*) * least(any_value(e.n), 10) AS wanted, TRUE AS enough
            FROM embeddings CROSS JOIN e WHERE vec_id % 20 = 0""",
        "vector_topk_ivf": f"""WITH {MEANS}, cells AS (SELECT vec_id, arg_min(query_id, distance)
              AS cell FROM pairs GROUP BY 1),
            probes AS (SELECT a.query_id, b.query_id AS cell FROM means a CROSS JOIN means b
              QUALIFY ROW_NUMBER() OVER (PARTITION BY a.query_id
                ORDER BY list_distance(a.q, b.q), b.query_id) <= 2),
            near AS (SELECT p.* FROM pairs p JOIN cells c USING (vec_id)
              JOIN probes b ON b.query_id = p.query_id AND b.cell = c.cell)
            {RANKED} FROM near QUALIFY rank <= 10""",
        "pk_audit": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
            GROUP BY 1, 2 HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "unique_audit": f"WITH {CF} SELECT user_id, COUNT(*) AS n FROM cf WHERE user_id IS NOT NULL"
        " GROUP BY 1 HAVING COUNT(*) > 1",
        "fk_orphans": f"""WITH {DS}, {CK}, {TOXIC}
            SELECT 'chunk' AS reference, document_id AS key_value, COUNT(*) AS n FROM ck
              WHERE document_id NOT IN (SELECT id FROM ds EXCEPT SELECT doc_id FROM toxic)
              GROUP BY 2
            UNION ALL SELECT 'line', l_orderkey, COUNT(*) FROM lineitem WHERE l_orderkey NOT IN
              (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 2""",
        "cascade_delete": f"""WITH {CK}, {TOXIC} SELECT document_id, chunk_index FROM ck
            WHERE document_id NOT IN (SELECT doc_id FROM toxic)""",
        "cascade_delete_accounts": f"""WITH {DS}, {CF}, {PR}, {ACCOUNTS}
            SELECT id, a_i_configuration_id, provider FROM pr WHERE a_i_configuration_id NOT IN
              (SELECT cf.id FROM cf JOIN doomed ON doomed.id = cf.user_id)""",
        "set_null": f"""WITH {CK}, {TOXIC} SELECT document_id AS id, CASE WHEN document_id NOT IN
              (SELECT doc_id FROM toxic) THEN document_id END AS document_id,
              COUNT(*) AS message_count FROM ck GROUP BY ck.document_id""",
        "restrict_delete": f"""WITH {DS} SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
            WHERE CAST(c_custkey AS VARCHAR) IN (SELECT uploaded_by_user_id FROM ds)""",
        "null_audit": f"WITH {DS} " + audit_rows(
            "ds", {c: f"COUNT(*) - COUNT({c}) AS n_null" for c in STATE_COLUMNS}
        ),
        "length_audit": audit_rows("documents", {
            c: f"CAST(MAX(length({c})) AS INT) AS max_chars,"
            f" COUNT(*) FILTER (WHERE length({c}) > {n}) AS n_too_long"
            for c, n in {"text": 1000, "lang": 2, "source": 4}.items()
        }),
        "decimal_audit": audit_rows("lineitem", {
            c: f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL{t}) IS NULL)"
            " AS n_overflow"
            for c, t in {
                "l_discount": "(5, 4)", "l_quantity": "(5, 4)", "l_extendedprice": "(10, 6)"
            }.items()
        }),
        "required_columns": f"""WITH {DS} SELECT 'retry_count' AS "column", false AS present,
              0::BIGINT AS n_filled UNION ALL
            SELECT 'processing_notes', true, COUNT(processing_notes) FROM ds""",
        "add_columns": f"""WITH {DS} SELECT id, status, processing_notes, 0 AS retry_count
            FROM ds""",
        "schema_listing": f"WITH {DS} " + audit_rows("ds", {
            c: f"'{t}' AS data_type, {str(null).lower()} AS is_nullable,"
            f" CAST({default} AS VARCHAR) AS column_default, COUNT(*) - COUNT({c}) AS n_null"
            for c, (t, null, default) in LISTING.items()
        }),
        "stream_ingest": processed,
        "batch_replayed": processed,
        "stream_dead_letters": """SELECT CASE WHEN event_type = 'error' THEN event_type ELSE props
              END AS value, CASE WHEN event_type = 'error' THEN 'bad_json' ELSE 'no_document_id' END
              AS reason, COUNT(*) AS n FROM events GROUP BY ALL""",
        "stream_stuck": """WITH l AS (SELECT user_id AS id, MAX(ts) AS updated_at, arg_max(
              CASE event_type WHEN 'error' THEN 'TextExtractionFailed'
                WHEN 'purchase' THEN 'Processed' ELSE 'ExtractingText' END, ts) AS status
              FROM events GROUP BY 1)
            SELECT id, 'TextExtractionFailed' AS status, updated_at AS stuck_since
            FROM l WHERE status = 'ExtractingText' AND epoch_ms(updated_at) + 1800000
              < (SELECT epoch_ms(MAX(ts)) FROM events)""",
        "stream_backfill": f"""WITH {DS}, {CK}, {CF}, {PR}, {BACKLOG}, {RESOLVED}, {PLAN}
            SELECT document_id, chunk_index, CASE WHEN embed_status = 'ready' THEN 'embedded'
                ELSE embed_status END AS embed_status, credential_source,
              CASE WHEN embed_status = 'ready' THEN 1536 END AS dim FROM plan""",
        "reprocess_cycle_job": f"WITH {counted}, {cycles()} " + " UNION ALL ".join(
            f"""SELECT {i}::BIGINT AS cycle, d.id, d.status, d.retry_count, d.processing_notes,
              coalesce(c.n, 0) AS n_chunks FROM done{i} d
              LEFT JOIN counts c ON c.document_id = d.id"""
            for i in range(len(CYCLE_TIMES))
        ),
        "levelled_state": """WITH c AS (SELECT user_id AS id, event_id % 40 AS batch, ts, event_id,
              CASE event_type WHEN 'error' THEN 'TextExtractionFailed'
                WHEN 'purchase' THEN 'Processed' WHEN 'view' THEN 'Queued'
                ELSE 'ExtractingText' END AS status,
              CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS note FROM events)
            SELECT id, arg_max(status, (batch, ts, event_id)) AS status,
              arg_max(note, (batch, ts, event_id)) FILTER (WHERE note IS NOT NULL) AS processing_notes,
              arg_max(ts, (batch, ts, event_id)) AS updated_at FROM c GROUP BY 1""",
        "metrics_history": f"WITH {DS}, {CK}, {assembled(WHOLE)}, {outcome(WHOLE)}, {cycles()}, "
        + ", ".join(
            f"m{i} AS (SELECT {at(now)} AS \"timestamp\", {FIGURES} FROM s{i + 1})"
            for i, now in enumerate(CYCLE_TIMES)
        )
        + ", m AS ("
        + " UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(len(CYCLE_TIMES)))
        + """) SELECT "timestamp", processed_documents, failed_documents, reprocessable_documents,
            avg_processing_time_seconds, (SELECT COUNT(vec_id) FROM ck) AS chunks_with_embeddings
            FROM m""",
    }
