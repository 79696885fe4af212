"""The registered queries in SQL, over the same tables.

Built from named blocks (common table expressions) so that each derivation is stated
once. Columns have the names the Spark queries give them.
"""

from __future__ import annotations

import re

# The wording sent to a provider, stated apart from the code under test.
PROMPT_HEADER = (
    "Extract the following fields from this geological survey report as a single JSON object "
    "with keys exactly: mineral, depth_m, lat, lon, grade_g_t, hole_id.\n"
)
PROMPT_FOOTER = "\n\nReturn only the JSON object, nothing else."
HINT_START = "A previous extraction attempt failed validation: "
HINT_END = ". Be precise about field types and value ranges."

_FIELDS = ("mineral", "depth_m", "lat", "lon", "grade_g_t", "hole_id")
_NUMBERS = ("depth_m", "lat", "lon", "grade_g_t")
_LIST = ", ".join(_FIELDS)


def _quoted(value: str) -> str:
    """A text as SQL, with line breaks spelled out."""
    parts = ["'" + part.replace("'", "''") + "'" for part in value.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


_MINERAL = "['Copper', 'Gold', 'Silver', 'Zinc', 'Lithium', 'Nickel'][c % 6 + 1]"

_BLOCKS = {
    # Intake.
    "uploads": """
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS report_id, text, source,
               CASE WHEN text IS NULL OR text = '' THEN 'text is required'
                    WHEN strlen(text) < 20 THEN 'document text too short to be a real report'
               END AS error
        FROM documents""",
    "hashed": """
        SELECT *, CASE WHEN error IS NULL THEN sha256(text) END AS content_hash FROM uploads""",
    "gated": """
        SELECT *, CASE WHEN error IS NOT NULL THEN 'rejected'
                       WHEN row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1
                       THEN 'accepted' ELSE 'duplicate' END AS status
        FROM hashed""",
    # Passages: mark each boundary, split at the marks, strip, number what is left.
    "pieces": r"""
        SELECT CAST(doc_id AS VARCHAR) AS report_id, lang,
               unnest(list_filter(list_transform(string_split(
                   regexp_replace(text, '([.\n])\s+', '\1' || chr(1), 'g'), chr(1)),
                   lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
                   lambda x: x <> '')) AS text,
               generate_subscripts(list_filter(list_transform(string_split(
                   regexp_replace(text, '([.\n])\s+', '\1' || chr(1), 'g'), chr(1)),
                   lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
                   lambda x: x <> ''), 1) - 1 AS chunk_index
        FROM documents""",
    # Passages of the derived reports, cut at the same places.
    "report_pieces": r"""
        SELECT report_id, unnest(list_filter(list_transform(string_split(
                   regexp_replace(text, '([.\n])\s+', '\1' || chr(1), 'g'), chr(1)),
                   lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS text,
               generate_subscripts(list_filter(list_transform(string_split(
                   regexp_replace(text, '([.\n])\s+', '\1' || chr(1), 'g'), chr(1)),
                   lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), 1) - 1
                   AS chunk_index
        FROM reports""",
    # Derived reports.
    "keys": "SELECT o_orderkey AS k, o_custkey AS c FROM orders",
    "facts": f"""
        SELECT k, c, 'RPT-' || k AS report_id,
               CASE WHEN k % 23 = 0 THEN 'Unobtainium' ELSE {_MINERAL} END AS mineral,
               CASE WHEN k % 19 = 0 THEN 50000 ELSE 20 + (13 * k % 381) END AS depth_m,
               CAST((CASE WHEN k % 17 = 0 THEN 407000
                     ELSE -250000 + (37 * c % 500) * 100 + (k % 81) - 40 END) / 10000.0
                    AS DECIMAL(9, 4)) AS lat,
               CAST((-700000 + (53 * c % 400) * 100 + (7 * k % 81) - 40) / 10000.0
                    AS DECIMAL(9, 4)) AS lon,
               CAST((10 + (7 * k % 491)) / 100.0 AS DECIMAL(9, 2)) AS grade_g_t,
               'DH-' || (1 + k % 99) AS hole_id
        FROM keys""",
    "records": f"""
        SELECT k, c, report_id, mineral, hole_id,
               {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in _NUMBERS)}
        FROM facts""",
    "reports": """
        SELECT k, c, report_id,
               'GEOLOGICAL SURVEY REPORT ' || report_id || chr(10) || chr(10)
               || 'Drill hole ' || hole_id || ' intersected ' || grade_g_t || ' g/t ' || mineral
               || ' at a depth of ' || depth_m || 'm. Coordinates recorded at the collar: '
               || lat || ', ' || lon || '.' || chr(10) || chr(10)
               || 'Field notes: core recovery was consistent throughout the interval.' AS text
        FROM facts""",
    "stated": r"""
        SELECT report_id, text,
               nullif(regexp_extract(text, 'g/t (\w+) at a depth of', 1), '') AS mineral,
               TRY_CAST(nullif(regexp_extract(text, 'at a depth of ([-0-9.]+)m', 1), '')
                        AS DOUBLE) AS depth_m,
               TRY_CAST(nullif(regexp_extract(text, 'at the collar: ([-0-9.]+),', 1), '')
                        AS DOUBLE) AS lat,
               TRY_CAST(nullif(regexp_extract(text, 'at the collar: [-0-9.]+, (-?\d+\.\d+)', 1), '')
                        AS DOUBLE) AS lon,
               TRY_CAST(nullif(regexp_extract(text, 'intersected ([-0-9.]+) g/t', 1), '')
                        AS DOUBLE) AS grade_g_t,
               nullif(regexp_extract(text, 'Drill hole (\S+) intersected', 1), '') AS hole_id
        FROM reports""",
    "tested": """
        SELECT *, mineral IN ('Copper', 'Gold', 'Silver', 'Zinc', 'Lithium', 'Nickel')
                  AS mineral_ok,
               depth_m > 0 AND depth_m <= 1000 AS depth_m_ok,
               lat BETWEEN -30 AND -15 AS lat_ok, lon BETWEEN -75 AND -60 AS lon_ok
        FROM stated""",
    "checked": """
        SELECT *, mineral_ok AND depth_m_ok AND lat_ok AND lon_ok AS valid,
               concat_ws('; ',
                   CASE WHEN NOT mineral_ok
                        THEN '''' || mineral || ''' is not a recognized mineral' END,
                   CASE WHEN NOT depth_m_ok
                        THEN 'depth_m=' || depth_m || ' is out of plausible range (0, 1000]' END,
                   CASE WHEN NOT lat_ok
                        THEN 'lat=' || lat || ' outside survey region bounds (-30.0, -15.0)' END,
                   CASE WHEN NOT lon_ok
                        THEN 'lon=' || lon || ' outside survey region bounds (-75.0, -60.0)' END
               ) AS reason
        FROM tested""",
    "valid": f"SELECT report_id, {_LIST} FROM checked WHERE valid",
    # Resolution.
    "sited": """
        SELECT *, round(lat, 2) AS lat_bucket, round(lon, 2) AS lon_bucket FROM valid""",
    "occurrences": """
        SELECT mineral, lat_bucket, lon_bucket, count(*) AS n_reports,
               sum(CAST(depth_m AS DECIMAL(24, 9))) / count(*) AS avg_depth_m,
               sum(CAST(grade_g_t AS DECIMAL(24, 9))) / count(*) AS avg_grade_g_t
        FROM sited GROUP BY ALL""",
    # Site means added up exactly; quotients equal to nine decimals are one number.
    "regions": """
        SELECT mineral, round(lat_bucket, 0) AS region_lat, round(lon_bucket, 0) AS region_lon,
               count(*) AS n_occurrences, CAST(sum(n_reports) AS BIGINT) AS n_source_reports,
               round(CAST(CAST(sum(CAST(avg_depth_m AS DECIMAL(27, 12))) / count(*)
                               AS DECIMAL(24, 9)) AS DOUBLE), 1) AS avg_depth_m,
               round(CAST(CAST(sum(CAST(avg_grade_g_t AS DECIMAL(27, 12))) / count(*)
                               AS DECIMAL(24, 9)) AS DOUBLE), 2) AS avg_grade_g_t
        FROM occurrences GROUP BY ALL""",
    # Records with absent fields.
    "spoilt": """
            SELECT report_id, lat, lon, CASE WHEN k % 11 <> 0 THEN mineral END AS m,
                   CASE WHEN k % 9 <> 0 THEN depth_m END AS d,
                   k % 5 = 0 AS no_grade, k % 6 = 0 AS no_hole
            FROM records""",
    "reasons": """
            SELECT report_id, concat_ws('; ',
                CASE WHEN m IS NULL THEN 'mineral: field required'
                     WHEN m = 'Unobtainium' THEN chr(39) || 'Unobtainium' || chr(39) || ' is not a recognized mineral' END,
                CASE WHEN d IS NULL THEN 'depth_m: field required'
                     WHEN NOT (d > 0 AND d <= 1000)
                     THEN 'depth_m=' || d || ' is out of plausible range (0, 1000]' END,
                CASE WHEN NOT (lat >= -30 AND lat <= -15)
                     THEN 'lat=' || lat || ' outside survey region bounds (-30.0, -15.0)' END,
                CASE WHEN NOT (lon >= -75 AND lon <= -60)
                     THEN 'lon=' || lon || ' outside survey region bounds (-75.0, -60.0)' END,
                CASE WHEN no_grade THEN 'grade_g_t: field required' END,
                CASE WHEN no_hole THEN 'hole_id: field required' END) AS reason
            FROM spoilt""",
    # Derived model outputs, two attempts.
    "answers": f"""
        SELECT *, CASE WHEN k % 29 = 0 THEN 'no object'
                       WHEN k % 31 = 0 THEN '{{"mineral" "Gold"}}'
                       ELSE '{{"mineral": "' || mineral || '", "depth_m": '
                            || CASE WHEN k % 7 = 0 THEN '"' || depth_m || '"'
                                    WHEN k % 11 = 0 THEN 'null'
                                    ELSE CAST(depth_m AS VARCHAR) END
                            || ', "lat": ' || lat || ', "lon": ' || lon
                            || ', "grade_g_t": ' || grade_g_t || ', "hole_id": '
                            || CASE WHEN k % 13 = 0 THEN CAST(1 + k % 99 AS VARCHAR)
                                    ELSE '"' || hole_id || '"' END || '}}' END AS answer_1,
               '{{"mineral": "' || {_MINERAL} || '", "depth_m": ' || depth_m
               || ', "lat": ' || lat || ', "lon": ' || lon || ', "grade_g_t": ' || grade_g_t
               || ', "hole_id": "' || hole_id || '"}}' AS answer_2
        FROM facts""",
    "attempted": """
        SELECT k, report_id, 1 AS attempt, answer_1 AS answer FROM answers
        UNION ALL
        SELECT k, report_id, 2, CASE WHEN k % 2 = 0 THEN answer_2 ELSE answer_1 END FROM answers""",
    "noisy": r"""
        SELECT report_id, attempt, trim(regexp_replace(
                   '<think>draft {' || chr(10) || '}</think>' || chr(10)
                   || 'Here is the extraction:' || chr(10) || '```json' || chr(10) || answer
                   || chr(10) || '```' || chr(10) || 'Let me know if you need anything else.',
                   '(?s)<think>.*?</think>', '', 'g'), chr(10) || ' ') AS output
        FROM attempted""",
    "blocks": r"""
        SELECT *, nullif(regexp_extract(output, '(?s)\{.*\}'), '') AS block FROM noisy""",
    "objects": """
        SELECT report_id, attempt, output, block,
               CASE WHEN json_valid(block) THEN CAST(block AS JSON) END AS v FROM blocks""",
    "typed": f"""
        SELECT report_id, attempt, output, block, v IS NOT NULL AS parsed,
               {", ".join(
                   f"CASE WHEN json_type(v, '$.{f}') = 'VARCHAR' THEN v ->> '$.{f}' END AS {f}"
                   if f not in _NUMBERS
                   else f"TRY_CAST(v ->> '$.{f}' AS DOUBLE) AS {f}" for f in _FIELDS)}
        FROM objects""",
    "problems": f"""
        SELECT *, CASE WHEN block IS NULL
                       THEN 'no JSON object found in model output: ' || left(output, 200)
                       WHEN NOT parsed THEN 'model output is not valid JSON'
                       ELSE concat_ws('; ', {", ".join(
                           f"CASE WHEN {f} IS NULL THEN '{f}: input is not a valid "
                           + ("number" if f in _NUMBERS else "string") + "' END"
                           for f in _FIELDS)}) END AS problems
        FROM typed""",
    "judged": """
        SELECT *, concat_ws('; ', nullif(problems, ''),
                   CASE WHEN mineral NOT IN
                             ('Copper', 'Gold', 'Silver', 'Zinc', 'Lithium', 'Nickel')
                        THEN '''' || mineral || ''' is not a recognized mineral' END,
                   CASE WHEN NOT (depth_m > 0 AND depth_m <= 1000)
                        THEN 'depth_m=' || depth_m || ' is out of plausible range (0, 1000]' END,
                   CASE WHEN lat NOT BETWEEN -30 AND -15
                        THEN 'lat=' || lat || ' outside survey region bounds (-30.0, -15.0)' END,
                   CASE WHEN lon NOT BETWEEN -75 AND -60
                        THEN 'lon=' || lon || ' outside survey region bounds (-75.0, -60.0)' END
               ) AS why
        FROM problems""",
    # The first attempt that passed, or the last one with its reason.
    "outcomes": f"""
        SELECT report_id, CASE WHEN why = '' THEN 'extracted' ELSE 'failed' END AS status,
               attempt AS attempts, nullif(why, '') AS reason,
               {", ".join(f"CASE WHEN why = '' THEN {f} END AS {f}" for f in _FIELDS)}
        FROM judged
        QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY why <> '',
                                   CASE WHEN why = '' THEN attempt ELSE -attempt END) = 1""",
    "matches": f"""
        SELECT t.report_id, status, attempts,
               {", ".join(
                   f"status = 'extracted' AND coalesce(o.{f} = t.{f}, false) AS {f}"
                   if f not in _NUMBERS else
                   f"status = 'extracted' AND coalesce(abs(o.{f} - t.{f}) < 0.01, false) AS {f}"
                   for f in _FIELDS)}
        FROM records t JOIN outcomes o USING (report_id)""",
    "summary": f"""
        SELECT count(*) AS n_reports, count(*) FILTER (status = 'extracted') AS n_extracted,
               round(count(*) FILTER (status = 'extracted') / count(*), 4)
                   AS schema_conformance_rate,
               round(sum({" + ".join(f"CAST({f} AS INT)" for f in _FIELDS)}) / (count(*) * 6), 4)
                   AS field_level_precision,
               round(sum(attempts) / count(*), 2) AS avg_attempts
        FROM matches""",
    "copies": """
        SELECT content_hash, count(*) AS n,
               count(*) FILTER (status = 'accepted') AS n_accepted,
               count(*) FILTER (status = 'duplicate') AS n_duplicate
        FROM gated WHERE error IS NULL GROUP BY content_hash""",
    "measures": """
        SELECT 'validity' AS dimension, 'share_of_texts_accepted_once' AS name,
               avg(CAST(n_accepted = 1 AS INT)) AS measured, 1.0 AS threshold, '' AS detail,
               true AS higher_is_better FROM copies
        UNION ALL SELECT 'validity', 'share_of_repeated_texts_with_one_in',
               avg(CAST(n_duplicate = n - 1 AS INT)), 1.0, '', true FROM copies WHERE n > 1
        UNION ALL SELECT 'validity', 'share_of_short_uploads_rejected',
               avg(CAST(status = 'rejected' AS INT)), 1.0, '', true
               FROM gated WHERE strlen(text) < 20
        UNION ALL SELECT 'validity', 'share_of_outside_latitudes_invalid',
               avg(CAST(NOT valid AS INT)), 1.0, '', true FROM checked WHERE NOT lat_ok
        UNION ALL SELECT 'correctness', 'share_of_failures_after_all_attempts',
               avg(CAST(attempts = 2 AS INT)), 1.0, '', true
               FROM outcomes WHERE status = 'failed'
        UNION ALL SELECT 'correctness', 'share_of_fields_as_labelled', field_level_precision, 0.99, '',
               true FROM summary
        UNION ALL SELECT 'consistency', 'reports_of_the_largest_site', max(n_reports), 2.0,
               'reports of the most reported site', true FROM occurrences
        UNION ALL SELECT 'completeness', 'share_of_uploads_with_a_verdict',
               avg(CAST(status IS NOT NULL AS INT)), 1.0, '', true FROM gated
        UNION ALL SELECT 'completeness', 'reports_lost_to_failed_extraction',
               round(avg(CAST(status = 'failed' AS INT)), 6), 0.25, '', false FROM outcomes""",
    "checks": """
        SELECT dimension, name, CAST(measured AS DOUBLE) AS measured,
               CAST(threshold AS DOUBLE) AS threshold,
               CASE WHEN higher_is_better THEN measured >= threshold
                    ELSE measured <= threshold END AS passed,
               detail, higher_is_better
        FROM measures""",
    # Generated values: 32 bits of a hash of seed, row and field.
    "synthetic": """
        SELECT o_orderkey AS k,
               printf('RPT-%03d', o_orderkey) AS report_id,
               ['Copper', 'Gold', 'Silver', 'Zinc', 'Lithium', 'Nickel'][
                   draw_mineral % 6 + 1] AS mineral,
               CAST(20 + draw_depth_m % 381 AS INTEGER) AS depth_m,
               (-250000 + draw_lat % 50001) / CAST(10000 AS DOUBLE) AS lat,
               (-700000 + draw_lon % 40001) / CAST(10000 AS DOUBLE) AS lon,
               (10 + draw_grade_g_t % 491) / CAST(100 AS DOUBLE) AS grade_g_t,
               'DH-' || (draw_hole_id % 99 + 1) AS hole_id
        FROM (SELECT o_orderkey, """
    + ", ".join(
        f"CAST('0x' || substr(md5('42:' || o_orderkey || ':{f}'), 1, 8) AS BIGINT) AS draw_{f}"
        for f in _FIELDS
    )
    + " FROM orders)",
}


def _reads(sql: str) -> list[str]:
    return [name for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql) if name in _BLOCKS]


def _with_blocks(select: str) -> str:
    """``select`` preceded by the blocks it reads, directly or not."""
    needed: list[str] = []

    def add(names: list[str]) -> None:
        for name in names:
            if name not in needed:
                add(_reads(_BLOCKS[name]))
                needed.append(name)

    add(_reads(select))
    blocks = ",\n".join(f"{name} AS ({_BLOCKS[name]})" for name in needed)
    if not needed:
        return select
    # A select may bring blocks of its own, which come after those it reads.
    own = select.strip().removeprefix("WITH ")
    return f"WITH {blocks}" + (f",\n{own}" if own != select.strip() else f"\n{select}")


_HINTED = f"{_quoted(HINT_START)} || reason || {_quoted(HINT_END)}"
_PROMPT = (
    f"{_quoted(PROMPT_HEADER)} || note || chr(10) || 'Report:' || chr(10) || text"
    f" || {_quoted(PROMPT_FOOTER)}"
)
_WORDS = ("the", "que", "der", "la")
_SCORE = " + ".join(f"(len(regexp_extract_all(lower(text), '{w}')) - 3) ** 2" for w in _WORDS)
_NEAREST = """
    SELECT {columns}, round(distance, 6) AS distance
    FROM (SELECT e.vec_id, e.label, {distance} AS distance,
                 row_number() OVER ({scope} ORDER BY {distance}, e.vec_id) AS rank
          FROM embeddings e, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0) {where})
    WHERE rank <= {k}"""
_L2 = "power(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q AS DOUBLE[])), 2)"
_COSINE = "1 - list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q AS DOUBLE[]))"
_SCORED = "SELECT dimension, round(avg(CAST(passed AS INT)), 4) AS score FROM checks"
_ATTEMPTS = """
    SELECT event_id, {key}, attempts, attempts <= 2 AS allowed
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempts
          FROM events)"""
_LATEST = f"""
    SELECT 'CUST-' || c AS report_id, {_LIST} FROM records
    QUALIFY row_number() OVER (PARTITION BY c ORDER BY k DESC) = 1"""
_SITES = """
    SELECT mineral, lat_bucket, lon_bucket, n_reports FROM occurrences"""

def _embedded(pieces: str, query: str | None = None) -> str:
    """Blocks from passages to the components of their vectors: word, draw, weight, length.

    A query text is one more passage (position -1) that takes no part in the weights.
    """
    asked = f" UNION ALL SELECT NULL, '{query}', -1" if query else ""
    return rf"""
        texts AS (SELECT report_id, text, chunk_index FROM {pieces}{asked}),
        drawn AS (SELECT report_id, chunk_index, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 256 AS dim,
                         CASE WHEN substr(md5(word), 9, 1) >= '8' THEN -1 ELSE 1 END AS sign
                  FROM (SELECT report_id, chunk_index,
                               unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS word FROM texts)),
        weights AS (SELECT dim, CAST(floor(1000 * ln(((SELECT count(*) FROM texts WHERE chunk_index >= 0) + 1) / (n + 1)) + 0.5)
                                     AS BIGINT) AS weight
                    FROM (SELECT dim, count(*) FILTER (chunk_index >= 0) AS n
                          FROM (SELECT DISTINCT report_id, chunk_index, dim FROM drawn) GROUP BY dim)),
        valued AS (SELECT report_id, chunk_index, dim, CAST(sum(sign) * any_value(weight) AS BIGINT) AS v
                   FROM drawn JOIN weights USING (dim) GROUP BY report_id, chunk_index, dim),
        vectors AS (SELECT report_id, chunk_index, dim,
                           round(CAST(v AS DOUBLE) * 16384.0 / sqrt(CAST(length AS DOUBLE)), 0) / 16384.0 AS value
                    FROM (SELECT *, sum(v * v) OVER (PARTITION BY report_id, chunk_index) AS length FROM valued)
                    WHERE v <> 0)"""


def _best_passages(pieces: str, texts: str) -> str:
    """Blocks, then the four nearest passages of each report, in text order."""
    query = "mineral occurrence depth coordinates assay grade drill hole"
    return f"""{_embedded(pieces, query)},
        asked AS (SELECT dim, value AS wanted FROM vectors WHERE chunk_index = -1),
        distances AS (SELECT p.report_id, p.chunk_index, p.text,
                             (SELECT sum(wanted * wanted) FROM asked) + coalesce(d, 0) AS distance
                      FROM {pieces} p LEFT JOIN (
                          SELECT report_id, chunk_index, sum(value * value - 2 * value * coalesce(wanted, 0)) AS d
                          FROM vectors LEFT JOIN asked USING (dim) GROUP BY report_id, chunk_index) USING (report_id, chunk_index)),
        best AS (SELECT * FROM distances QUALIFY row_number() OVER (
                     PARTITION BY report_id ORDER BY distance, chunk_index) <= 4)
        SELECT t.report_id, coalesce(nullif(found, ''), t.text) AS context
        FROM {texts} t LEFT JOIN (SELECT report_id, string_agg(text, ' ' ORDER BY chunk_index) AS found
                                  FROM best GROUP BY report_id) USING (report_id)"""


_KNOWN = """
    SELECT report_id, content_hash,
           CASE WHEN error IS NOT NULL THEN 'rejected'
                WHEN EXISTS (SELECT 1 FROM hashed h
                             WHERE h.source = 'src0' AND h.content_hash = g.content_hash)
                THEN 'duplicate' ELSE status END AS status
    FROM gated g"""

_SELECTS = {
    "intake_status": """
        SELECT report_id, content_hash, status, error,
               CASE status WHEN 'accepted' THEN 200 WHEN 'duplicate' THEN 409 ELSE 400 END
                   AS status_code
        FROM gated""",
    "intake_resent": """
        SELECT report_id, content_hash, status, count(*) AS n_uploads
        FROM (SELECT report_id, content_hash,
                     CASE WHEN error IS NOT NULL THEN 'rejected'
                          WHEN row_number() OVER (PARTITION BY content_hash ORDER BY report_id) = 1
                          THEN 'accepted' ELSE 'duplicate' END AS status
              FROM (SELECT * FROM hashed UNION ALL SELECT * FROM hashed))
        GROUP BY ALL""",
    "intake_summary": "SELECT status, count(*) AS n_uploads FROM gated GROUP BY status",
    "intake_registry": _KNOWN,
    "intake_stream_registry": _KNOWN,
    "accepted_documents": """
        SELECT report_id, text, content_hash FROM gated WHERE status = 'accepted'""",
    "intake_stream": "SELECT content_hash FROM gated WHERE status = 'accepted'",
    "intake_stream_verdicts": "SELECT report_id, content_hash, status FROM gated",
    "chunk_documents": """
        SELECT report_id || '-chunk-' || chunk_index AS id, report_id, chunk_index, text
        FROM pieces""",
    "chunk_stats": """
        SELECT report_id, count(*) AS n_chunks, max(length(text)) AS longest,
               CAST(sum(length(text)) AS BIGINT) AS n_chars
        FROM pieces GROUP BY report_id""",
    "vector_topk_global": _NEAREST.format(
        columns="vec_id, label", distance=_L2, scope="", where="", k=5
    ),
    "vector_topk_where": _NEAREST.format(
        columns="vec_id, label", distance=_L2, scope="", where="WHERE e.label = 3", k=5
    ),
    "vector_topk_scoped": _NEAREST.format(
        columns="vec_id, label, rank", distance=_L2, scope="PARTITION BY e.label", where="", k=4
    ),
    "vector_topk_deep": _NEAREST.format(
        columns="vec_id, label, rank", distance=_L2, scope="PARTITION BY e.label", where="", k=5000
    ),
    "vector_index_exact": _NEAREST.format(
        columns="vec_id, label", distance=_L2, scope="", where="", k=100
    ),
    "vector_index_lists": "SELECT label, count(*) AS n_vectors FROM embeddings GROUP BY label",
    "vector_cosine_scoped": _NEAREST.format(
        columns="vec_id, label, rank",
        distance=_COSINE,
        scope="PARTITION BY e.label",
        where="",
        k=4,
    ),
    "retrieval_context": f"""
        SELECT CAST(d.doc_id AS VARCHAR) AS report_id, coalesce(nullif(found, ''), text) AS context
        FROM documents d LEFT JOIN (
            SELECT report_id, string_agg(text, ' ' ORDER BY chunk_index) AS found
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY report_id ORDER BY {_SCORE}, chunk_index) AS rank
                  FROM pieces WHERE lang <> 'fr')
            WHERE rank <= 4 GROUP BY report_id) h
        ON h.report_id = CAST(d.doc_id AS VARCHAR)""",
    "batch_encoder_hits": f"""
        SELECT report_id || '-chunk-' || chunk_index AS id, rank, distance
        FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY distance, chunk_index)
                        AS rank
              FROM (SELECT report_id, chunk_index,
                           CAST({_SCORE} AS DOUBLE) AS distance FROM pieces))
        WHERE rank <= 4""",
    "vector_upsert": """
        SELECT vec_id, CASE WHEN label = 3 THEN -1 ELSE label END AS label,
               len(embedding) AS dims
        FROM embeddings""",
    "batch_provider_outcomes": """
        SELECT report_id, CASE WHEN valid THEN 'extracted' ELSE 'failed' END AS status,
               CASE WHEN valid THEN 1 ELSE 2 END AS attempts, nullif(reason, '') AS reason,
               CASE WHEN valid THEN mineral END AS mineral
        FROM checked""",
    # Both waves in order of arrival; a hash is let in once, the last text let in under an id stays.
    "document_versions": """
        WITH sent AS (
            SELECT 0 AS wave, doc_id, text FROM documents
            UNION ALL SELECT 1, doc_id, text || ' Corrected in ' || lang FROM documents WHERE lang IS NOT NULL),
        known AS (SELECT *, sha256(text) AS content_hash FROM sent WHERE strlen(text) >= 20),
        let_in AS (SELECT * FROM known
                   QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY wave, doc_id) = 1)
        SELECT CAST(doc_id AS VARCHAR) AS report_id, text, content_hash FROM let_in
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY wave DESC) = 1""",
    "report_files": """
        SELECT CAST(doc_id AS VARCHAR) AS report_id, text || chr(10) AS text FROM documents""",
    "ledger_outcomes": """
        SELECT report_id, CASE WHEN valid THEN 'extracted' ELSE 'failed' END AS status,
               CASE WHEN valid AND CAST(substr(hole_id, 4) AS INT) % 2 = 0 THEN 1 ELSE 2 END AS attempts,
               nullif(reason, '') AS reason, CASE WHEN valid THEN depth_m END AS depth_m
        FROM checked""",
    "embed_documents": f"""
        WITH {_embedded("pieces")}
        SELECT report_id || '-chunk-' || chunk_index AS id, dim, value FROM vectors WHERE value <> 0""",
    "retrieve_passages": f"WITH {_best_passages('report_pieces', 'reports')}",
    "retrieve_document_passages": f"WITH {_best_passages('pieces', 'uploads')}",
    "extract_rules": f"SELECT report_id, {_LIST} FROM stated",
    "extract_step": f"SELECT report_id, {_LIST} FROM stated",
    "validate_records": """
        SELECT report_id, valid, CAST(NOT mineral_ok AS INT) + CAST(NOT depth_m_ok AS INT)
               + CAST(NOT lat_ok AS INT) + CAST(NOT lon_ok AS INT) AS n_errors,
               mineral_ok, depth_m_ok, lat_ok, lon_ok
        FROM checked""",
    "quarantine": "SELECT report_id, reason FROM checked WHERE NOT valid",
    "parse_model_output": f"""
        SELECT report_id, parsed, {_LIST}, problems FROM problems WHERE attempt = 1""",
    "prompt_build": f"""
        SELECT report_id, sha256({_PROMPT.replace("note", "''")}) AS first_prompt,
               sha256({_PROMPT}) AS retry_prompt
        FROM (SELECT report_id, text, CASE WHEN valid THEN ''
                     ELSE 'Note: ' || {_HINTED} || chr(10) END AS note FROM checked)""",
    "retry_outcomes": f"SELECT report_id, status, attempts, reason, {_LIST} FROM outcomes",
    "attempts_per_report": """
        SELECT report_id, attempts + CAST(status = 'failed' AS INT) AS attempts FROM outcomes""",
    "attempt_admission": _ATTEMPTS.format(key="user_id"),
    "attempt_admission_stream": _ATTEMPTS.format(key="CAST(user_id AS VARCHAR) AS report_id"),
    "attempt_counter_stream": """
        SELECT CAST(user_id AS VARCHAR) AS report_id, count(*) AS attempts
        FROM events GROUP BY user_id""",
    "extraction_upsert": _LATEST,
    "extraction_upsert_stream": _LATEST,
    "resolve_occurrences": """
        SELECT mineral, lat_bucket, lon_bucket, n_reports,
               round(avg_depth_m, 6) AS avg_depth_m, round(avg_grade_g_t, 6) AS avg_grade_g_t
        FROM occurrences""",
    "validate_missing_fields": """
        SELECT report_id, reason = '' AS valid, reason FROM reasons""",
    "resolve_links": """
        SELECT mineral, lat_bucket, lon_bucket, unnest(ids) AS report_id
        FROM (SELECT mineral, lat_bucket, lon_bucket, list(report_id) AS ids
              FROM sited GROUP BY ALL)""",
    "resolve_report_lists": "SELECT mineral, lat_bucket, lon_bucket, report_id FROM sited",
    "resolve_stats": """
        SELECT CAST(sum(n_reports) AS BIGINT) AS n_raw_records, count(*) AS n_resolved_occurrences
        FROM occurrences""",
    "occurrences_by_region": "SELECT * FROM regions",
    "resolve_merged": "SELECT * FROM regions",
    "survey_run": """
        SELECT *, (SELECT count(*) FILTER (NOT valid) FROM checked) AS n_denied,
               (SELECT count(DISTINCT text) FROM reports) AS n_texts
        FROM regions""",
    "survey_checks": """
        SELECT 'completeness' AS dimension, 'share_of_uploads_with_a_verdict' AS name, 1.0 AS measured, true AS passed
        UNION ALL SELECT 'validity', 'share_of_uploads_let_in',
               round(count(DISTINCT text) / (2 * count(*)), 6), true FROM reports
        UNION ALL SELECT 'correctness', 'share_of_failures_after_all_attempts', 1.0, true
        UNION ALL SELECT 'completeness', 'share_of_reports_extracted', round(avg(CAST(valid AS INT)), 6),
               avg(CAST(valid AS INT)) >= 0.75 FROM checked
        UNION ALL SELECT 'timeliness', 'seconds_to_resolve', NULL, true""",
    "search_occurrences": f"{_SITES} WHERE mineral = 'Gold'",
    "search_all_occurrences": "SELECT mineral, lat_bucket, lon_bucket, n_reports FROM occurrences",
    "lookup_extraction": f"SELECT report_id, {_LIST} FROM valid WHERE report_id = 'RPT-5'",
    "typed_scan": f"SELECT report_id, {_LIST} FROM records",
    "upload_files": """
        SELECT error, count(*) AS n_uploads, count(DISTINCT content_hash) AS n_texts
        FROM (SELECT error, content_hash FROM hashed
              UNION ALL SELECT 'body is not valid JSON', NULL FROM pages)
        GROUP BY error""",
    "labelled_files": """
        SELECT report_id, text, r.mineral, CAST(r.depth_m AS INTEGER) AS depth_m, r.lat, r.lon,
               r.grade_g_t, r.hole_id
        FROM reports JOIN records r USING (report_id)""",
    "occurrence_files": _SITES,
    "missing_view": """
        SELECT mineral, CAST(sum(n_reports) AS BIGINT) AS n_reports
        FROM occurrences GROUP BY mineral""",
    "eval_fields": "SELECT * FROM matches",
    "eval_summary": "SELECT * FROM summary",
    "evaluation_files": "SELECT * FROM matches",
    "quality_checks": "SELECT * FROM checks",
    "quality_score": f"""
        {_SCORED} GROUP BY dimension
        UNION ALL {_SCORED.replace("dimension", "'overall'", 1)}""",
    "quality_counts": """
        SELECT count(*) FILTER (passed) AS n_passed, count(*) AS n_checks FROM checks""",
    "quality_failed": "SELECT dimension, name, measured FROM checks WHERE NOT passed",
    "quality_files": f"""
        {_SCORED} GROUP BY dimension
        UNION ALL {_SCORED.replace("dimension", "'overall'", 1)}""",
    "synth_reports": f"""
        SELECT report_id,
               'GEOLOGICAL SURVEY REPORT ' || report_id || chr(10) || chr(10)
               || 'Drill hole ' || hole_id || ' intersected ' || grade_g_t || ' g/t ' || mineral
               || ' at a depth of ' || depth_m || 'm. Coordinates recorded at the collar: '
               || lat || ', ' || lon || '.' || chr(10) || chr(10)
               || 'Field notes: core recovery was consistent throughout the interval. '
               || 'Sample was logged by the site geologist and sent for assay confirmation. '
               || 'No significant alteration was observed above ' || (depth_m - 15) || 'm.'
               AS text, {_LIST}
        FROM synthetic""",
    "synth_skew": """
        SELECT event_id, CASE WHEN hot < CAST(0.6 * 4294967296 AS BIGINT) OR n = n_hot
                              THEN pick % n_hot
                              ELSE n_hot + pick % greatest(n - n_hot, 1) END AS item_index
        FROM (SELECT event_id, n, greatest(1, CAST(floor(n * 0.05) AS BIGINT)) AS n_hot,
                     CAST('0x' || substr(md5('42:' || event_id || ':hot'), 1, 8) AS BIGINT) AS hot,
                     CAST('0x' || substr(md5('42:' || event_id || ':pick'), 1, 8) AS BIGINT) AS pick
              FROM events, (SELECT count(*) AS n FROM customer))""",
}

ORACLES = {name: _with_blocks(select) for name, select in _SELECTS.items()}
